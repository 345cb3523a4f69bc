"""Weighted SimHash fingerprints, and the search for those within a Hamming radius by permuted block tables.

DataFrame functions only.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.session import materialise

BITS = 64
#: A term's votes: the bytes of its words, at most this many, so that short common words count for little.
MOST_WEIGHT = 15
#: Terms summed in 16-bit lanes before the sums go to wider ones; 2048 x 15 is below half of what 16 bits
#: hold, so that the highest lane stays clear of the sign.
CHUNK_SHIFT = 11
#: The fingerprint is cut into blocks; a table is sorted by the bits of three of them.
BLOCK_WIDTHS = (11, 11, 11, 11, 10, 10)
RADIUS = 3

_SPACE = " \t\n\x0b\x0c\r"


def _shift(value: Column, bits: int) -> Column:
    return F.shiftrightunsigned(value, bits) if bits else value


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def fingerprints(texts: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """``keys`` and ``fingerprint`` (a signed long) for each of the distinct ``keys`` of ``texts``.

    Terms are pairs of neighbouring words of the lower-cased text, and the last word
    alone. Each casts its weight for or against every bit by its hash; a bit is set if
    more is cast for it than against it. A text without words has fingerprint 0. The
    votes for four bits share one sum, so a text of any length is summed in its task in
    sixteen numbers for every 2048 terms, and only those are shuffled.
    """
    trimmed = F.btrim(F.lower(F.col(text_col)), F.lit(_SPACE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[ \t-\r]+"))
    split = texts.select(*keys, words.alias("_words"))
    pairs = F.arrays_zip(F.col("_words").alias("a"), F.slice("_words", 2, F.greatest(F.size("_words"), F.lit(0))).alias("b"))
    terms = split.select(*keys, F.posexplode_outer(pairs).alias("_at", "_term"))
    hashed = terms.select(
        *keys,
        F.shiftright(F.coalesce("_at", F.lit(0)), CHUNK_SHIFT).alias("_chunk"),
        F.xxhash64("_term.a", "_term.b").alias("_hash"),
        F.least(
            F.lit(MOST_WEIGHT),
            F.coalesce(F.octet_length("_term.a"), F.lit(0)) + F.coalesce(F.octet_length("_term.b"), F.lit(0)),
        )
        .cast("long")
        .alias("_weight"),
    )
    lanes = F.lit(0x0001000100010001)
    narrow = hashed.groupBy(*keys, "_chunk").agg(
        F.sum("_weight").alias("_all"),
        *[F.sum(_shift(F.col("_hash"), j).bitwiseAND(lanes) * F.col("_weight")).alias(f"_s{j}") for j in range(16)],
    )
    half = F.lit(0x0000FFFF0000FFFF)
    wide = narrow.groupBy(*keys).agg(
        F.sum("_all").alias("_all"),
        *[F.sum(_shift(F.col(f"_s{j}"), 16 * k).bitwiseAND(half)).alias(f"_w{j}_{k}") for j in range(16) for k in range(2)],
    )
    print_ = F.lit(0).cast("long")
    for bit in range(BITS):
        lane, j = divmod(bit, 16)
        count = _shift(F.col(f"_w{j}_{lane % 2}"), 32 * (lane // 2)).bitwiseAND(F.lit(0xFFFFFFFF))
        print_ = print_.bitwiseOR(F.when(2 * count > F.col("_all"), F.lit(_signed(1 << bit))).otherwise(F.lit(0)).cast("long"))
    return wide.select(*keys, print_.alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """The share of equal bits of two fingerprints."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def hexadecimal(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def block_masks(widths: tuple[int, ...] = BLOCK_WIDTHS, radius: int = RADIUS) -> list[int]:
    """One mask for each table: the bits of all blocks but ``radius`` of them."""
    starts = [sum(widths[:k]) for k in range(len(widths))]
    blocks = [((1 << w) - 1) << s for w, s in zip(widths, starts, strict=True)]
    return [_signed(sum(chosen)) for chosen in combinations(blocks, len(blocks) - radius)]


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(fingerprint, near, distance)``: all distinct ``prints (fingerprint)`` within ``radius`` of each of ``queries (fingerprint)``.

    Two fingerprints that differ in ``radius`` bits agree in all blocks but that many, so
    they meet in at least one of the tables; a pair is given by the first table it meets in.
    """
    masks = block_masks(radius=radius)

    def tables(rows: DataFrame, name: str) -> DataFrame:
        entries = F.array(
            *[F.struct(F.lit(t).alias("table"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("bits")) for t, m in enumerate(masks)]
        )
        return rows.select(F.col("fingerprint").alias(name), F.inline(entries))

    differ = F.col("fingerprint").bitwiseXOR(F.col("near"))
    first = F.coalesce(*[F.when(differ.bitwiseAND(F.lit(m)) == 0, F.lit(t)) for t, m in enumerate(masks)])
    ours = tables(queries.select("fingerprint").distinct(), "fingerprint")
    theirs = tables(prints.select("fingerprint").distinct(), "near").withColumnsRenamed({"table": "table_", "bits": "bits_"})
    met = (F.col("table") == F.col("table_")) & (F.col("bits") == F.col("bits_"))
    found = ours.join(theirs, met & (F.bit_count(differ) <= radius) & (first == F.col("table")))
    return found.select("fingerprint", "near", F.bit_count(differ).alias("distance"))


def following(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (distinct in ``order``) with the ``order`` columns of the next row as ``next_...``; the first follows the last.

    Rows are cut into ranges that are written down with their numbers; inside a range
    the next row is looked up by a window, and the first row of each range, one for
    each task, links the ranges.
    """
    ranges = materialise(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    own = F.struct(*order)
    firsts = ranges.groupBy("_range").agg(F.min(own).alias("_first"))
    across = Window.orderBy("_range")
    everything = Window.partitionBy()
    linked = firsts.select(
        "_range", F.coalesce(F.lead("_first").over(across), F.min("_first").over(everything)).alias("_after")
    )
    inside = Window.partitionBy("_range").orderBy(*order)
    following_ = F.coalesce(F.col("_next"), F.col("_after"))
    return (
        ranges.withColumn("_next", F.lead(own).over(inside))
        .join(linked, "_range")
        .select(*rows.columns, *[following_[c].alias(f"next_{c}") for c in order])
    )


def compare_edits(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 100, radius: int = RADIUS
) -> DataFrame:
    """One row per document, its fingerprint, and how like it those of an edit and of the next document are.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (longs), near_edited, near_next, n_within``.
    The edit replaces the last quarter (rounded down) of a text's characters by the first
    as many of the next document in ascending id order; the first follows the last.
    ``n_within`` counts the other documents within ``radius`` of the fingerprint, for
    rows whose id is divisible by ``every``, and is NULL for others.

    NULL counts as an empty text. A NULL id comes first in order. Documents of one id are in
    order of their texts' hashes; rows alike in id and text are one document, and each gets its row.
    A table of one document follows itself; an empty one gives no rows.
    """
    # Columns without NULLs, so that all joins and groups below share one way to deal out the texts.
    key = ["present", "id", "hash"]
    text = F.coalesce(F.col(text_col), F.lit(""))
    number = F.coalesce(F.col(id_col).cast("long"), F.lit(0))
    base = docs.select(F.col(id_col).isNotNull().alias("present"), number.alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    sizes = base.select(*key, F.length("text").alias("n_chars")).groupBy(*key).agg(F.max("n_chars").alias("n_chars"), F.count("*").alias("n_rows"))
    order = materialise(following(sizes, key), "order")

    whole = base.dropDuplicates(key)
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    wanted = order.select(*[F.col(f"next_{c}").alias(c) for c in key], *[F.col(c).alias(f"for_{c}") for c in key], "n_chars")
    heads = whole.join(wanted, key).select(
        *[F.col(f"for_{c}").alias(c) for c in key], "n_chars", F.substring("text", F.lit(1), quarter).alias("head")
    )
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars") - quarter), F.col("head"))
    both = (
        whole.join(heads, key)
        .select(*key, "text", edited.alias("edited"))
        .withColumn("sha", F.sha2(F.col("edited").cast("binary"), 256))
    )
    versions = both.select(
        *key,
        F.inline(
            F.array(
                F.struct(F.lit("").alias("sha"), F.col("text").alias("text")), F.struct(F.col("sha"), F.col("edited").alias("text"))
            )
        ),
    )
    prints = materialise(fingerprints(versions, [*key, "sha"]), "fingerprints")
    own = prints.where("sha = ''").select(*key, "fingerprint")
    edits = prints.where("sha <> ''").select(*key, F.col("sha").alias("edited_sha256"), F.col("fingerprint").alias("edited_fingerprint"))
    after = own.select(*[F.col(c).alias(f"next_{c}") for c in key], F.col("fingerprint").alias("next_fingerprint"))
    joined = order.join(own, key).join(edits, key).join(after, [f"next_{c}" for c in key])
    joined = materialise(joined.withColumn("doc_id", F.when(F.col("present"), F.col("id"))), "compared")
    asked = (F.col("doc_id") % every) == 0
    counts = joined.groupBy("fingerprint").agg(F.sum("n_rows").alias("n"))
    near = (
        within_radius(joined.where(asked), counts, radius)
        .join(counts.withColumnRenamed("fingerprint", "near"), "near")
        .groupBy("fingerprint")
        .agg((F.sum("n") - 1).alias("n_within"))
    )
    return (
        joined.join(near, "fingerprint", "left")
        .select(
            "doc_id",
            F.col("n_chars").cast("long").alias("n_chars"),
            "edited_sha256",
            "fingerprint",
            "edited_fingerprint",
            likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
            likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
            F.when(asked, F.col("n_within")).alias("n_within"),
            F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_rows"))).alias("_row"),
        )
        .drop("_row")
    )
