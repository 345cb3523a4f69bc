"""Personal data replaced by keyed surrogates of the same kind and format. DataFrame functions only."""

from __future__ import annotations

import secrets
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.ordering import previous_row, split_groups
from tideline.session import discard, materialise

#: The setting that holds the key of the surrogates, and how often a form may try for one of its own.
SECRET = "spark.tideline.surrogates.secret"
ATTEMPTS = 8

# What an entity of each kind looks like, the first that fits counts.
KINDS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "iban": r"[A-Z]{2}\d{2}(?: [A-Z0-9]{4}){3,7}(?: [A-Z0-9]{1,3})?|[A-Z]{2}\d{2}[A-Z0-9]{11,30}",
    "secret": r"AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,}|[0-9a-f]{32,}|[0-9A-F]{32,}",
    "ip": r"(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)",
    "phone": (
        r"(?:\+\d{1,3}[^\p{L}\p{N}]{0,5})?(?:\(\d{2,4}\)[^\p{L}\p{N}]{0,5}|\d{3}[ .-])\d{3}[ .-]?\d{4}"
        r"|\d{10}"
        r"|\+\d{1,3}(?:[ .-]?\d{1,4}){3,5}"
    ),
    "ssn": r"\d{3}-\d{2}-\d{4}",
    "card": r"\d{4}(?:[ -]\d{4}){3}|\d{13,19}",
    "name": (
        r"(?:Mrs|Mr|Ms|Miss|Dr|Prof|Herr|Frau|Señora|Señor|Sra|Sr|Monsieur|Madame|Mme|г-жа|г-н|госпожа|господин)"
        # A mark stands between letters, so that a name and its genitive are one.
        r"\.? \p{Lu}(?:\p{L}|['’-](?=\p{L})(?!s(?!\p{L})))+(?: \p{Lu}(?:\p{L}|['’-](?=\p{L})(?!s(?!\p{L})))+)?"
    ),
}
_BEFORE, _AFTER = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
PATTERN = _BEFORE + "(?:" + "|".join(f"(?:{p})" for p in KINDS.values()) + ")" + _AFTER

# Forms of address, and names to choose from.
MALE = r"^(?:Mr|Herr|Señor|Sr|Monsieur|г-н|господин)\b"
FEMALE = r"^(?:Mrs|Ms|Miss|Frau|Señora|Sra|Madame|Mme|г-жа|госпожа)\b"
NAMES = {
    ("given-m", "latin"): "Adam Alan Anton Bruno Carl David Edgar Felix Frank George Henri Ivan James Leon Louis Marco Noah Oscar Paul Robert Simon Theo Victor Walter".split(),
    ("given-f", "latin"): "Alice Amelia Anna Bella Carla Clara Diana Elena Emma Eva Fiona Grace Helen Irene Julia Laura Lena Maria Nina Olivia Paula Rosa Sara Vera".split(),
    ("given-n", "latin"): "Alex Andrea Ariel Avery Blake Casey Chris Dana Dominique Eden Jamie Jean Jordan Kim Lee Logan Morgan Noel Quinn Robin Sam Sasha Taylor Toni".split(),
    ("family", "latin"): "Abel Baker Berger Blanc Carter Costa Dubois Fischer Garcia Hansen Keller Lambert Marin Moreau Nielsen Parker Reyes Romero Santos Schmid Turner Vidal Weber Young".split(),
    ("given-m", "cyrillic"): "Андрей Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Олег Павел".split(),
    ("given-f", "cyrillic"): "Алла Вера Галина Дарья Елена Инна Лариса Мария Нина Ольга Раиса Юлия".split(),
    ("given-n", "cyrillic"): "Саша Женя Валя Шура Паша Слава Витя Мика Ника Рая Тоня Юра".split(),
    ("family", "cyrillic"): "Бойко Гончар Дашко Ковальчук Левченко Мазур Остапчук Романюк Савчук Ткач Франко Шевчук".split(),
    ("given-m", "greek"): "Άγγελος Βασίλης Γιάννης Δημήτρης Θανάσης Κώστας Λεωνίδας Μιχάλης Νίκος Παύλος Σπύρος Χρήστος".split(),
    ("given-f", "greek"): "Αγγελική Βασιλική Γεωργία Δέσποινα Ελένη Ζωή Ιωάννα Κατερίνα Μαρία Ντίνα Σοφία Χριστίνα".split(),
    ("given-n", "greek"): "Αλέξης Αντώνης Βίκυ Εύη Κρις Λιλή Μάκης Μελίνα Νόνη Ρένη Τόνια Φένια".split(),
    ("family", "greek"): "Αγγέλου Βασιλείου Γεωργίου Δήμου Θεοδώρου Ιωάννου Κωνσταντίνου Λάμπρου Νικολάου Πέτρου Στεφάνου Χρήστου".split(),
    ("given-m", "armenian"): "Արամ Արմեն Գևորգ Դավիթ Հայկ Կարեն Միքայել Նարեկ Սարգիս Տիգրան".split(),
    ("given-f", "armenian"): "Աննա Անահիտ Գայանե Լիլիթ Կարինե Մարիամ Նարինե Շուշան Սիրանուշ Օվսաննա".split(),
    ("given-n", "armenian"): "Ալեքս Արև Արփի Հրաչ Մասիս Մինե Նուռ Սևան Վան Ռիտա".split(),
    ("family", "armenian"): "Աբրահամյան Բաղդասարյան Գրիգորյան Դավթյան Հակոբյան Մանուկյան Պետրոսյան Սարգսյան Վարդանյան Օհանյան".split(),
}
#: Scripts that have names to choose from; a name of another script is made of its own letters.
SCRIPTS = {"cyrillic": r"\p{IsCyrillic}", "greek": r"\p{IsGreek}", "armenian": r"\p{IsArmenian}", "latin": r"\p{IsLatin}"}


def kind_of(entity: Column) -> Column:
    found = F.lit(None).cast("string")
    for kind, pattern in reversed(KINDS.items()):
        found = F.when(entity.rlike(f"^(?:{pattern})$"), F.lit(kind)).otherwise(found)
    return found


def _parts(entity: Column, kind: Column) -> Column:
    """What of an entity is looked up: for a name its given and family names, else one plain form."""
    words = F.split(F.regexp_replace(entity, r"^\S+ ", ""), " ")
    gender = F.when(entity.rlike(MALE), "given-m").when(entity.rlike(FEMALE), "given-f").otherwise("given-n")
    given = F.when(F.size(words) > 1, F.array(F.struct(gender.alias("kind"), F.get(words, F.lit(0)).alias("plain"))))
    family = F.array(F.struct(F.lit("family").alias("kind"), F.element_at(words, -1).alias("plain")))
    plain = (
        F.when(kind.isin("phone", "card", "ssn"), F.regexp_replace(entity, r"\D", ""))
        .when(kind == "iban", F.regexp_replace(entity, " ", ""))
        .when(kind == "email", F.lower(entity))
        .otherwise(entity)
    )
    single = F.array(F.struct(kind.alias("kind"), plain.alias("plain")))
    return F.when(kind == "name", F.when(F.size(words) > 1, F.concat(given, family)).otherwise(family)).otherwise(single)


def _stream(secret: str, kind: Column, plain: Column, attempt: Column, length: Column) -> Column:
    """At least ``length`` pairs of hex digits that only the holder of ``secret`` can tell."""
    message = F.concat_ws("\u0000", kind, plain, attempt.cast("string"))

    def block(number: Column) -> Column:
        inner = F.sha2(F.concat(F.lit(secret), F.lit("\u0001"), message, number.cast("string")).cast("binary"), 256)
        return F.sha2(F.concat(F.lit(secret), F.lit("\u0002"), inner).cast("binary"), 256)

    return F.array_join(F.transform(F.sequence(F.lit(0), F.floor(length / 32).cast("int")), block), "")


def _number(stream: Column, place: Column | int) -> Column:
    """The byte of the stream at a place from 0."""
    at = (F.lit(place) if isinstance(place, int) else place) * 2 + 1
    return F.conv(F.substring(stream, at, F.lit(2)), 16, 10).cast("int")


def _like(text: Column, stream: Column, kept: int = 0) -> Column:
    """``text`` with every digit and letter after the first ``kept`` characters replaced by one of its class."""

    def character(i: Column) -> Column:
        old = F.substring(text, i + 1, F.lit(1))
        drawn = _number(stream, i)
        letter = F.char(F.lit(97) + drawn % 26)
        hexadecimal = text.rlike("^[0-9a-fA-F]{32,}$")
        low = F.when(hexadecimal, F.char(F.lit(97) + drawn % 6)).otherwise(letter)
        return (
            F.when(i < kept, old)
            .when(old.rlike("[0-9]"), (drawn % 10).cast("string"))
            .when(old.rlike("[a-z]"), low)
            .when(old.rlike("[A-Z]"), F.upper(low))
            .otherwise(old)
        )

    return F.array_join(F.transform(F.sequence(F.lit(0), F.length(text) - 1), character), "")


def _luhn(digits: Column) -> Column:
    """The sum that a valid card number has as a multiple of ten."""
    size = F.length(digits)

    def value(i: Column) -> Column:
        digit = F.substring(digits, size - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, digit).when(digit > 4, 2 * digit - 9).otherwise(2 * digit)

    return F.aggregate(F.transform(F.sequence(F.lit(0), size - 1), value), F.lit(0), lambda a, b: a + b)


def _chosen_name(kind: Column, plain: Column, stream: Column, attempt: Column) -> Column:
    """A name from the list for the kind and the script; each further attempt joins one more by a hyphen.

    Where no list has the script, the name's own letters come in another order.
    """
    script = F.lit("other")
    for name, letters in reversed(SCRIPTS.items()):
        script = F.when(plain.rlike(letters), name).otherwise(script)
    found = F.initcap(_shuffled(plain, stream))
    for (k, s), names in NAMES.items():
        joined = F.array_join(F.transform(F.sequence(F.lit(0), attempt.cast("int")), _pick(names, stream)), "-")
        found = F.when((kind == k) & (script == s), joined).otherwise(found)
    return found


def _shuffled(text: Column, stream: Column) -> Column:
    """The characters of ``text`` in the order that the stream gives them."""
    places = F.transform(
        F.sequence(F.lit(0), F.length(text) - 1),
        lambda i: F.struct(_number(stream, i).alias("at"), i.alias("i"), F.substring(text, i + 1, F.lit(1)).alias("c")),
    )
    return F.array_join(F.transform(F.array_sort(places), lambda x: x["c"]), "")


def _pick(names: list[str], stream: Column) -> Callable[[Column], Column]:
    listed = F.array(*[F.lit(n) for n in names])

    def pick(i: Column) -> Column:
        return F.get(listed, (_number(stream, 2 * i) * 256 + _number(stream, 2 * i + 1)) % len(names))

    return pick


def with_surrogate(forms: DataFrame, secret: str, attempt: int) -> DataFrame:
    """``forms (kind, plain)`` with ``form``, the plain form of the surrogate.

    Emails get an address of the same shape in a domain that cannot exist; phone numbers
    keep their first digit and length; cards keep the first digit and the length, and valid
    ones stay valid; the other numbers and secrets keep their classes of characters.
    """
    kind, plain, tries = F.col("kind"), F.col("plain"), F.lit(attempt)
    host_of = F.substring_index(plain, "@", -1)
    # Digests are columns of their own, so that they are worked out once and not for each character.
    streams = forms.withColumns(
        {
            "_stream": _stream(secret, kind, plain, tries, F.length(plain) + 2 * attempt + 8),
            "_host": _stream(secret, F.lit("domain"), host_of, tries, F.lit(8)),
        }
    )
    stream = F.col("_stream")
    email = F.concat(_like(F.substring_index(plain, "@", 1), stream), F.lit("@"), F.substring("_host", 1, 12), F.lit(".example"))
    octets = [(_number(stream, k) % 254 + 1).cast("string") for k in range(4)]
    drawn = streams.withColumn(
        "_drawn",
        F.when(kind == "email", email)
        .when(kind == "ip", F.concat_ws(".", *octets))
        .when(kind.isin("phone", "card"), _like(plain, stream, 1))
        .when(kind == "ssn", F.concat(F.lit("9"), F.substring(_like(plain, stream), 2, 8)))
        .when(kind == "iban", _like(plain, stream, 2))
        .when(kind == "secret", _like(plain, stream))
        .otherwise(_chosen_name(kind, plain, stream, tries)),
    )
    but_last = F.substring("_drawn", F.lit(1), F.length("_drawn") - 1)
    missing = (10 - _luhn(F.concat(but_last, F.lit("0"))) % 10) % 10
    valid = (kind == "card") & (_luhn(plain) % 10 == 0)
    form = F.when(valid, F.concat(but_last, missing.cast("string"))).otherwise(F.col("_drawn"))
    return drawn.withColumn("form", form).drop("_stream", "_host", "_drawn")


def _formatted(entity: Column, kind: Column, forms: Column) -> Column:
    """The surrogate's plain ``forms`` in the format of the entity."""
    first = F.get(forms, F.lit(0))

    def filled(separators: str) -> Column:
        """The entity with its characters but for ``separators`` replaced in turn."""

        def character(i: Column) -> Column:
            old = F.substring(entity, i + 1, F.lit(1))
            before = F.length(F.regexp_replace(F.substring(entity, F.lit(1), i), separators, ""))
            return F.when(old.rlike(separators), old).otherwise(F.substring(first, before + 1, F.lit(1)))

        return F.array_join(F.transform(F.sequence(F.lit(0), F.length(entity) - 1), character), "")

    email = F.when(entity == F.upper(entity), F.upper(first)).otherwise(first)
    name = F.concat_ws(" ", F.substring_index(entity, " ", 1), F.array_join(forms, " "))
    return (
        F.when(kind.isin("phone", "card", "ssn"), filled(r"\D"))
        .when(kind == "iban", filled(" "))
        .when(kind == "email", email)
        .when(kind == "name", name)
        .otherwise(first)
    )


def _other_names(words: Column, forms: Column) -> Column:
    """(old, rank, new) for what else a person of a name's ``words`` may be called in the document, and the surrogates."""

    def called(old: Column, rank: int, new: Column) -> Column:
        return F.struct(old.alias("old"), F.lit(rank).alias("rank"), new.alias("new"))

    family = F.array(called(F.element_at(words, -1), 1, F.element_at(forms, -1)))
    full = called(F.array_join(words, " "), 0, F.array_join(forms, " "))
    given = called(F.get(words, F.lit(0)), 2, F.get(forms, F.lit(0)))
    return F.when(F.size(words) > 1, F.concat(F.array(full, given), family)).otherwise(family)


def _one_each(names: Column) -> Column:
    """The first of the (old, rank, new) of each old name, longer names first."""
    listed = F.array_sort(F.array_distinct(F.flatten(names)))
    first = F.filter(listed, lambda x, i: (i == 0) | (F.get(listed, i - 1)["old"] != x["old"]))
    return F.array_sort(first, lambda a, b: F.length(b["old"]) - F.length(a["old"]))


def assign_surrogates(plain_forms: DataFrame, secret: str) -> DataFrame:
    """``(kind, plain, form)``: a surrogate for each of the distinct ``plain_forms (kind, plain)``.

    Distinct forms of a kind get distinct surrogates, and none gets one that stands in
    the corpus itself. Where two meet, the first in order keeps the surrogate; it and those
    that met a real form try again, ``ATTEMPTS`` times at most.

    A form that is left over then has a format that is full, or nearly so. All forms of such a format
    change places: in a keyed order each gets the form after it, the last gets the first.
    These surrogates are distinct still, and each is a form that is itself replaced wherever it
    stands. A form that is the only one of its format is masked.
    """
    forms = materialise(plain_forms.select("kind", "plain").distinct(), "entities")
    done: list[DataFrame] = []
    open_ = forms
    for attempt in range(ATTEMPTS):
        if open_.isEmpty():
            break
        # Few bytes, but much work for each row: dealt to as many tasks as a shuffle has.
        tasks = int(forms.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        tried = with_surrogate(open_.repartition(tasks, "plain"), secret, attempt)
        taken = reduce(DataFrame.unionByName, [forms.select("kind", F.col("plain").alias("form")), *[d.select("kind", "form") for d in done]])
        free = tried.join(taken, ["kind", "form"], "left_anti")
        first = free.groupBy("kind", "form").agg(F.min("plain").alias("plain"))
        done.append(materialise(first.select("kind", "plain", "form"), "surrogates"))
        left = materialise(open_.join(done[-1], ["kind", "plain"], "left_anti"), "entities")
        if open_ is not forms:
            discard(open_)
        open_ = left
    if not done:
        return forms.withColumn("form", F.col("plain"))
    found = reduce(DataFrame.unionByName, done)
    if open_.isEmpty():
        return found
    full = open_.select("kind", _format(F.col("kind"), F.col("plain")).alias("_format")).distinct()
    format_of = _format(F.col("kind"), F.col("plain"))
    kept = found.withColumn("_format", format_of).join(full, ["kind", "_format"], "left_anti").drop("_format")
    exchanged = _exchanged(forms.withColumn("_format", format_of).join(full, ["kind", "_format"], "left_semi"), secret)
    return kept.unionByName(exchanged)


def _format(kind: Column, plain: Column) -> Column:
    """What a form has in common with those that may stand in its place: its kept characters and the classes of the others."""
    kept = F.when(kind.isin("phone", "card"), 1).when(kind == "iban", 2).otherwise(0)
    rest = F.substring(plain, kept + 1, F.length(plain))
    for letters, mark in (("[0-9]", "9"), (r"\p{Lu}", "A"), (r"\p{L}", "a")):
        rest = F.regexp_replace(rest, letters, mark)
    valid = (kind == "card") & (_luhn(F.when(kind == "card", plain).otherwise(F.lit("0"))) % 10 == 0)
    shape = F.when(kind == "ip", F.lit("")).when(kind.rlike("^(given|family)"), F.lit("")).otherwise(rest)
    return F.concat_ws("|", F.substring(plain, F.lit(1), kept), shape, valid.cast("string"))


def _exchanged(forms: DataFrame, secret: str) -> DataFrame:
    """``forms (kind, _format, plain)`` with the ``form`` that each gets, formats of any size."""
    keys = ["kind", "_format"]
    order = _stream(secret, F.col("kind"), F.col("plain"), F.lit("order"), F.lit(1))
    chunks = split_groups(forms.withColumn("_order", order), keys, ["_order", "plain"])
    paired = previous_row(chunks, keys, ["_order", "plain"], ["plain"], "_before")
    last = chunks.groupBy(*keys).agg(F.max_by("plain", F.struct("_order", "plain")).alias("_last"), F.count("*").alias("_n"))
    masked = F.regexp_replace(F.col("plain"), r"[\p{L}\p{N}]", "x")
    form = F.when(F.col("_n") == 1, masked).otherwise(F.coalesce(F.col("_before.plain"), F.col("_last")))
    return paired.join(last, keys).select("kind", "plain", form.alias("form"))


def _one_gender(parts: DataFrame) -> DataFrame:
    """``parts`` with one kind for each given name, from all that it is addressed by, so that Dr A B and Ms A B stay one person."""
    given = parts.where(F.col("kind").startswith("given-"))
    seen = given.groupBy("plain").agg(F.max(F.col("kind") == "given-m").alias("m"), F.max(F.col("kind") == "given-f").alias("f"))
    settled = F.when(F.col("m") & ~F.col("f"), "given-m").when(F.col("f") & ~F.col("m"), "given-f").otherwise("given-n")
    kinds = seen.select("plain", settled.alias("_settled"), F.lit(True).alias("_given"))
    marked = parts.withColumn("_given", F.col("kind").startswith("given-"))
    joined = marked.join(kinds, ["plain", "_given"], "left")
    return joined.withColumn("kind", F.coalesce("_settled", "kind")).drop("_given", "_settled")


def secret_of(spark: SparkSession) -> str:
    """The session's key, drawn at random and kept in its settings where none is set."""
    known = spark.conf.get(SECRET, None)
    if known is None:
        known = secrets.token_hex(32)
        spark.conf.set(SECRET, known)
    return known


def replace_entities(
    docs: DataFrame,
    secret: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    report: str | None = None,
) -> DataFrame:
    """The rows of ``docs``, entities in ``text`` replaced by surrogates; other columns as they were.

    ``secret`` is the key; without it the setting ``spark.tideline.surrogates.secret`` counts, and where
    that is not set either, a key drawn at random for the session.

    Equal entities get equal surrogates in all documents, also where they are written
    in different ways: numbers are looked up by their digits, emails in lower case, and given and family names
    each on their own, so that Mr A B and Mr B stay one family. Names keep the form of address, its gender and
    the script; a given name that goes with both genders, or with none, gets a name for either, everywhere.
    Numbers keep their punctuation. Names are found by a form of address; the full, family and given
    names of those found are replaced in all the document, with and without one.

    ``report`` names a column for the list of (kind, entities) counts. NULL and blank
    texts, and texts without entities, stay as they are (with an empty list). Repeated rows and NULL ids give a row
    each; an empty table gives none. An entity that much of the corpus shares is looked up once for
    each document, by a join whose hot keys AQE splits.
    """
    secret = secret_of(docs.sparkSession) if secret is None else secret
    body = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    found = docs.where(F.col(text_col).rlike(PATTERN)).select(
        F.col(id_col).alias("_id"),
        body.alias("_body"),
        F.explode(F.array_distinct(F.regexp_extract_all(F.col(text_col), F.lit(PATTERN), F.lit(0)))).alias("entity"),
    )
    entities = materialise(found.withColumn("kind", kind_of(F.col("entity"))), "mentions")
    parts = entities.select("_id", "_body", "entity", F.col("kind").alias("whole"), F.posexplode(_parts(F.col("entity"), F.col("kind"))).alias("at", "part"))
    parts = _one_gender(parts.select("_id", "_body", "entity", "whole", "at", "part.kind", "part.plain"))
    forms = assign_surrogates(parts, secret)
    looked_up = (
        parts.join(forms, ["kind", "plain"])
        .groupBy("_id", "_body", "entity", "whole")
        .agg(F.sort_array(F.collect_set(F.struct("at", "form", "plain"))).alias("forms"))
    )
    replaced = looked_up.select(
        "_id",
        "_body",
        "entity",
        _formatted(F.col("entity"), F.col("whole"), F.col("forms.form")).alias("new"),
        F.when(F.col("whole") == "name", _other_names(F.col("forms.plain"), F.col("forms.form"))).alias("names"),
    )
    maps = replaced.groupBy("_id", "_body").agg(
        F.map_from_entries(F.collect_list(F.struct("entity", "new"))).alias("_map"), _one_each(F.collect_list("names")).alias("_names")
    )
    maps = maps.select(
        "_id",
        "_body",
        "_map",
        F.map_from_arrays(F.col("_names.old"), F.col("_names.new")).alias("_names"),
        F.when(
            F.size("_names") > 0, F.concat(F.lit(f"{_BEFORE}(?:"), F.array_join("_names.old", "|"), F.lit(f"){_AFTER}"))
        ).alias("_calls"),
    )
    text = F.col(f"d.{text_col}")
    calls = F.col("m._calls")

    def renamed(piece: Column) -> Column:
        """What stands between entities, with surrogates for the names that the document's people go by."""
        called = F.concat(F.regexp_extract_all(piece, calls, F.lit(0)), F.array(F.lit("")))
        return F.array_join(
            F.zip_with(
                F.split(piece, calls, -1), called, lambda p, e: F.concat(p, F.coalesce(F.element_at(F.col("m._names"), e), F.lit("")))
            ),
            "",
        )

    between = F.split(text, PATTERN, -1)
    pieces = F.when(calls.isNotNull(), F.transform(between, renamed)).otherwise(between)
    mentioned = F.concat(F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)), F.array(F.lit("")))
    new = F.array_join(
        F.zip_with(pieces, mentioned, lambda p, e: F.concat(p, F.coalesce(F.element_at(F.col("m._map"), e), F.lit("")))), ""
    )
    mark = "_body"
    while mark in docs.columns:
        mark += "_"
    joined = docs.withColumn(mark, body).alias("d").join(
        maps.alias("m"), F.col(f"d.{id_col}").eqNullSafe(F.col("m._id")) & (F.col(f"d.{mark}") == F.col("m._body")), "left"
    )
    shown = [
        F.when(F.col("m._map").isNotNull(), new).otherwise(text).alias(c) if c == text_col else F.col(f"d.{c}") for c in docs.columns
    ]
    if report:
        names = list(KINDS)
        called = F.flatten(F.transform(between, lambda p: F.regexp_extract_all(p, calls, F.lit(0))))
        called = F.when(calls.isNotNull(), F.transform(called, lambda _: F.lit("name"))).otherwise(F.array().cast("array<string>"))
        kinds = F.concat(F.transform(F.filter(mentioned, lambda e: e != ""), kind_of), called)
        counted = F.filter(
            F.transform(
                F.array(*[F.lit(k) for k in names]),
                lambda k: F.struct(k.alias("kind"), F.size(F.filter(kinds, lambda x: x == k)).alias("entities")),
            ),
            lambda c: c["entities"] > 0,
        )
        empty = F.array().cast("array<struct<kind:string,entities:int>>")
        shown.append(F.when(F.col("m._map").isNotNull(), counted).otherwise(empty).alias(report))
    return joined.select(*shown)
