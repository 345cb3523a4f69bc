"""Mixing sources to target weights: whole epochs first, then weighted sampling without replacement."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.texts import WORD
from tideline.session import materialise

#: Weights of the sources in order of their names, and again from the first.
WEIGHTS = (3, 1, 2)
#: The mix's size as a share of all words, and how often a source may be repeated.
SHARE = 1.5
MOST_EPOCHS = 2
#: Passes that fill what a pass has left of a source's budget with documents that still fit.
PASSES = 4
#: Sampling keys are cut into so many bins, and each bin into as many again.
BINS = 1024
LEAST_QUALITY = 0.05

_NOT_LETTERS = "\t\n\x0b\x0c\r !\"#$%&'()*+,-./0123456789:;<=>?@[\\]^_`{|}~"


def n_words(text: Column) -> Column:
    """The number of stretches between ASCII white space; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def quality_weight(text: Column) -> Column:
    """The share of letters among the text's characters, at least ``LEAST_QUALITY``."""
    letters = F.length(F.translate(text, _NOT_LETTERS, ""))
    share = letters / F.nullif(F.length(text), F.lit(0))
    return F.greatest(F.lit(LEAST_QUALITY), F.coalesce(share, F.lit(0.0)))


def sampling_key(id_col: Column, text: Column, weight: Column, seed: int = 0) -> Column:
    """An exponential key at rate ``weight``: in ascending order of it, documents come as if
    drawn one after another with chances in proportion to their weights. It depends on the id
    and the text only, so reruns agree."""
    hashed = F.shiftrightunsigned(F.xxhash64(F.lit(seed), id_col, text), 11)
    return -F.log((hashed + F.lit(0.5)) / F.lit(float(1 << 53))) / weight


def _measured(docs: DataFrame, id_col: str, text_col: str, source_col: str, quality_col: str | None) -> dict[str, Column]:
    text = F.col(text_col)
    weight = F.greatest(F.lit(LEAST_QUALITY), F.coalesce(F.col(quality_col).cast("double"), F.lit(0.0))) if quality_col else quality_weight(text)
    return {
        "size": n_words(text),
        "key": sampling_key(F.col(id_col), text, weight),
        # NULL apart from every name.
        "name": F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")),
    }


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """``(name, source_size, target, copies, room)`` from ``sizes (name, source_size)``, a row for each source.

    ``share`` of all words goes to the sources by weight; none gets more than
    ``MOST_EPOCHS`` times its size, and what that leaves goes to the others by weight.
    With the sources in order of size over weight, those before some point stand at their
    bound, and the others have one level of words for each unit of weight.
    """
    named = Window.orderBy(F.col("name") == "", "name")
    place = F.pmod(F.row_number().over(named) - 1, F.lit(len(weights)))
    ranked = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place + 1))
    ranked = ranked.withColumn("bound", MOST_EPOCHS * F.col("source_size").cast("double"))
    ranked = ranked.withColumn("ratio", F.col("bound") / F.col("weight"))
    fill = Window.orderBy("ratio", "name")
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    before = F.sum("bound").over(fill.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("bound")
    left = F.sum("weight").over(fill.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    leveled = ranked.withColumn("level", (total - before) / left)
    free = F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "name", "level"))
    level = F.min(free).over(everything)["level"]
    target = F.coalesce(F.least(F.col("bound"), level * F.col("weight")), F.col("bound"))
    copies = F.coalesce(F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0))
    return (
        leveled.withColumn("target", target)
        .withColumn("copies", copies.cast("long"))
        .withColumn("room", F.col("target") - F.col("copies") * F.col("source_size"))
        .select("name", "source_size", "target", "copies", "room")
    )


def _bin() -> tuple[Column, Column]:
    along = F.col("key") / (1 + F.col("key")) * BINS
    first = F.floor(along)
    return first, F.floor((along - first) * BINS)


def _cuts(rows: DataFrame, rooms: DataFrame) -> DataFrame:
    """``(name, cut, used)``: the largest key up to which a source's ``rows (name, size, key)`` fit its room.

    Sums of bins, then of the bins of the one bin in which the room ends, then of the
    keys of the one bin in that: no task sorts a source, however large it is.
    """
    first, second = _bin()
    rows = rows.join(rooms.select("name", "room"), "name").where("room > 0")
    rows = rows.withColumn("first", first).withColumn("second", second)
    taken = []
    open_ = None
    for level in (["first"], ["first", "second"], ["first", "second", "key"]):
        inside = rows if open_ is None else rows.join(open_, ["name", *level[:-1]])
        base = F.lit(0).cast("long") if open_ is None else F.min("before")
        sums = inside.groupBy("name", *level).agg(
            F.sum("size").alias("size"), F.max("key").alias("last"), F.min("room").alias("room"), base.alias("before")
        )
        along = Window.partitionBy("name").orderBy(level[-1])
        sums = sums.withColumn("through", F.col("before") + F.sum("size").over(along))
        sums = materialise(sums, "bins")
        taken.append(sums.where("through <= room").groupBy("name").agg(F.max("last").alias("cut"), F.max("through").alias("used")))
        over = sums.where("through > room").withColumn("before", F.col("through") - F.col("size"))
        nearest = F.min(F.struct(F.col(level[-1]).alias("_at"), *[F.col(c).alias(c) for c in level], "before"))
        open_ = over.groupBy("name").agg(nearest.alias("o")).select("name", *[F.col(f"o.{c}").alias(c) for c in level], "o.before")
    return reduce(DataFrame.unionByName, taken).groupBy("name").agg(F.max("cut").alias("cut"), F.max("used").alias("used"))


def mixing_rules(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """One row for each source: what ``source_targets`` gives, and ``rules``, a list of (largest size, largest key).

    A document of ``rows (name, size, key)`` is drawn if it meets one of the rules. The
    first takes documents in order of their keys until the next would not fit; each
    later one goes on through those that are no larger than what is left.
    """
    sizes = rows.groupBy("name").agg(F.sum("size").alias("source_size"))
    rules = materialise(source_targets(sizes, weights, share), "targets")
    rules = rules.withColumn("rules", F.array().cast("array<struct<size:double,key:double>>"))
    for _ in range(PASSES):
        open_rows = rows.join(rules.select("name", "rules", "room"), "name").where(~drawn() & (F.col("size") <= F.col("room")))
        cuts = _cuts(open_rows.select("name", "size", "key"), rules.select("name", "room"))
        rule = F.array(F.struct(F.col("room").alias("size"), F.col("cut").alias("key")))
        rules = materialise(
            rules.join(cuts, "name", "left").select(
                "name",
                "source_size",
                "target",
                "copies",
                (F.col("room") - F.coalesce("used", F.lit(0))).alias("room"),
                F.when(F.col("cut").isNull(), F.col("rules")).otherwise(F.concat("rules", rule)).alias("rules"),
            ),
            "rules",
        )
    return rules


def drawn() -> Column:
    return F.exists("rules", lambda r: (F.col("size") <= r["size"]) & (F.col("key") <= r["key"]))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    quality_col: str | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken, copies``.

    ``size`` is the number of words, ``target`` the source's share of the mix, ``taken``
    the words that the mix takes of the document: its size times ``copies``. A source
    whose target is above its size has whole epochs first; the rest is drawn by
    exponential keys at the rate of the document's quality (a column, or else the share of letters).

    NULL texts have size 0; NULL sources are one source, last in order; NULL ids count
    like any other. Documents of size 0 are copied with the whole epochs and may be drawn, which
    takes no words. Rows alike in id and text have one key and are drawn together or not at all.
    An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), *[c.alias(n) for n, c in _measured(docs, id_col, text_col, source_col, quality_col).items()])
    rows = materialise(rows, "sizes")
    rules = mixing_rules(rows.select("name", "size", "key"), weights, share)
    copies = F.col("copies") + drawn().cast("long")
    return rows.join(rules, "name").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), copies.alias("copies")
    )


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    quality_col: str | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
) -> DataFrame:
    """The rows of ``docs``, each as often as ``mix`` has copies of it, columns as they were."""
    measured = _measured(docs, id_col, text_col, source_col, quality_col)
    rows = materialise(docs.select(*[c.alias(n) for n, c in measured.items()]), "sizes")
    rules = mixing_rules(rows, weights, share)
    packed = docs.select(F.struct(*docs.columns).alias("row"), *[c.alias(n) for n, c in measured.items()])
    copies = F.col("copies") + drawn().cast("long")
    repeated = packed.join(rules, "name").select("row", F.explode(F.array_repeat(F.lit(0), copies.cast("int"))).alias("copy"))
    return repeated.select("row.*")
