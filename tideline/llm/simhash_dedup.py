"""SimHash near-duplicates by ball hashing: fingerprints meet half-way in the variants they share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_digest

from tideline.llm.components import connected_components
from tideline.llm.texts import each_text
from tideline.session import materialise

BITS = 64
SEED = 42
#: Shingles whose bits are counted at a time, so that a long text needs little memory.
CHUNK = 1 << 15


def fingerprint(text: bytes, words_per_shingle: int = 3) -> int:
    """The signed 64-bit fingerprint of one text; 0 for a text without words."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < words_per_shingle:
        shingles: Iterable[bytes] = [b" ".join(words)]
        total = 1
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(words_per_shingle)), strict=False))
        total = len(words) - words_per_shingle + 1
    digests = map(xxh64_digest, shingles, repeat(SEED))
    counts = np.zeros(BITS, dtype=np.int64)
    for start in range(0, total, CHUNK):
        size = min(CHUNK, total - start)
        raw = b"".join(next(digests) for _ in range(size)) if total > CHUNK else b"".join(digests)
        bits = np.unpackbits(np.frombuffer(raw, dtype=np.uint8).reshape(size, BITS // 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > total).tobytes(), "big", signed=True)


def with_fingerprint(
    docs: DataFrame, text: str = "text", name: str = "fingerprint", words: int = 3, keep: list[str] | None = None
) -> DataFrame:
    """The columns ``keep`` (all by default) and the fingerprint of ``text`` as a signed long called ``name``."""
    keep = docs.columns if keep is None else keep
    if name in keep:
        raise ValueError(f"there is a column {name} already")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(x, words) for x in each_text(batch.column(text))]
            yield batch.select(keep).append_column(name, pa.array(prints, pa.int64()))

    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(name, T.LongType())])
    return docs.mapInArrow(add, schema)


def hexadecimal(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def ball(fingerprint: Column, radius: int) -> Column:
    """Every 64-bit value that differs from ``fingerprint`` in ``radius`` bits or fewer."""
    masks = [0]
    for size in range(1, radius + 1):
        masks += [sum(1 << bit for bit in chosen) for chosen in combinations(range(BITS), size)]
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    if radius == 1:
        flips = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), k))
        return F.transform(F.concat(F.array(F.lit(0).cast("long")), flips), lambda m: m.bitwiseXOR(fingerprint))
    return F.transform(F.array(*[F.lit(m).cast("long") for m in signed]), lambda m: m.bitwiseXOR(fingerprint))


def fingerprint_components(prints: DataFrame, radius: int = 2) -> DataFrame:
    """``(fingerprint, root)``: the component of each of the distinct ``prints (fingerprint)``.

    Two fingerprints within an even ``radius`` share a value at most half the radius
    away from both, and two that share such a value are within the radius. So each is
    sent to all values in its half-radius ball, and those that meet at a value are
    chained in order; a chain never misses a member of a component and adds no link
    that is not there, which a count of the differing bits verifies. A value is met by at most as
    many fingerprints as a ball has members (65 for radius 2), however large a group is.
    """
    if radius % 2:
        raise ValueError("the radius must be even")
    variants = prints.select("fingerprint", F.explode(ball(F.col("fingerprint"), radius // 2)).alias("variant"))
    met = Window.partitionBy("variant").orderBy("fingerprint")
    links = (
        variants.select("fingerprint", F.lag("fingerprint").over(met).alias("other"))
        .where(F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("other"))) <= radius)
        .select(F.col("fingerprint").alias("a"), F.col("other").alias("b"))
    )
    roots = connected_components(links)
    return prints.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root")
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 2) -> DataFrame:
    """One row per document: ``doc_id, fingerprint (long), component_id, kept``.

    Documents link where their fingerprints differ in ``radius`` bits or fewer.
    ``component_id`` is the smallest id reachable by links and ``kept`` marks the
    document that bears it. NULL and blank texts have fingerprint 0 and link like any
    other. Repeated rows give a row each, with the same values. A NULL id takes part in links and is
    never a component id; a component of NULL ids only has none. An empty table gives no rows.
    """
    return _labelled(docs, id_col, text_col, radius).drop("root")


def _labelled(docs: DataFrame, id_col: str, text_col: str, radius: int) -> DataFrame:
    """``near_duplicates`` with ``root``, which only the documents of one component share."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    prints = materialise(with_fingerprint(texts, keep=["doc_id"]), "fingerprints")
    heads = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("head"))
    roots = materialise(fingerprint_components(heads.select("fingerprint"), radius), "roots")
    named = roots.join(heads, "fingerprint")
    components = named.groupBy("root").agg(F.min("head").alias("component_id"))
    labels = roots.join(components, "root").select("fingerprint", "component_id", "root")
    return prints.join(labels, "fingerprint").select(
        "doc_id", "fingerprint", "component_id", "root", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept")
    )


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 2) -> DataFrame:
    """The rows of ``docs`` without near-duplicates, columns as they were.

    Of each component one row stays: that with the smallest id, then the smallest fingerprint, then the first in
    column order. Without any id in a component the fingerprint decides.
    """
    columns = docs.columns
    name = "fingerprint"
    while name in columns:
        name += "_"
    # False before true, so that a NULL id comes last.
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fingerprint")
    stay = _labelled(docs, id_col, text_col, radius).groupBy("root").agg(F.min(order).alias("first"))
    stay = stay.select(F.col("first.doc_id").alias(f"{name}id"), F.col("first.fingerprint").alias(name))
    marked = with_fingerprint(docs, text_col, name)
    kept = marked.alias("d").join(
        stay.alias("s"),
        F.col(f"d.{id_col}").eqNullSafe(F.col(f"s.{name}id")) & (F.col(f"d.{name}") == F.col(f"s.{name}")),
        "left_semi",
    )
    order = [F.col(c) for c, t in docs.dtypes if "map" not in t and "variant" not in t]
    rank = F.row_number().over(Window.partitionBy(id_col, name).orderBy(*order))
    ranked = kept.withColumn(f"{name}rank", rank)
    return ranked.where(F.col(f"{name}rank") == 1).select(*columns)
