"""Token ids of a corpus in packed binary segments, written in document order and read back."""

from __future__ import annotations

import os
import unicodedata
import zlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.piece_cache import PieceCache

#: Ids of one block, and how many ids a segment has before it is closed at a document's end.
BLOCK = 1024
SEGMENT = 1 << 16
#: The share of a block's ids that the packed width must hold; the others are exceptions.
SHARE = 0.95

# Patched frame of reference.


def pack(ids: np.ndarray, share: float = SHARE, block: int = BLOCK) -> bytes:
    """One segment: the number of ids and of blocks, the byte where each block starts, and the blocks.

    A block has its minimum, the width that holds ``share`` of the differences to it,
    the differences packed at that width, and the positions and values of those that
    need more. All numbers are little-endian and unsigned.
    """
    full = len(ids) // block * block
    bodies = _packed(ids[:full].reshape(-1, block), share) if full else []
    if full < len(ids):
        bodies += _packed(ids[full:].reshape(1, -1), share)
    lengths = [len(b) for b in bodies]
    starts = np.cumsum([0, *lengths[:-1]]) if bodies else []
    head = np.array([len(ids), block, len(bodies), *starts], dtype="<u4")
    return head.tobytes() + b"".join(bodies)


def _packed(blocks: np.ndarray, share: float) -> list[bytes]:
    """The bodies of blocks of one size; those of one width are packed together."""
    blocks = blocks.astype(np.uint32, copy=False)
    low = blocks.min(axis=1)
    rest = blocks - low[:, None]
    needed = np.frexp(rest.astype(np.float64))[1]
    place = max(0, int(np.ceil(share * blocks.shape[1])) - 1)
    widths = np.partition(needed, place, axis=1)[:, place]
    outside = needed > widths[:, None]
    bodies: list[bytes] = [b""] * len(blocks)
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        kept = np.where(outside[rows], 0, rest[rows]).astype("<u2" if width <= 16 else "<u4")
        bits = np.unpackbits(kept.view(np.uint8).reshape(*kept.shape, -1), axis=2, bitorder="little", count=max(1, width))
        packed = np.packbits(bits[:, :, :width].reshape(len(rows), -1), axis=1, bitorder="little")
        for row, body in zip(rows.tolist(), packed, strict=True):
            out = np.flatnonzero(outside[row])
            head = np.array([low[row], width, len(out)], dtype="<u4").tobytes()
            bodies[row] = head + body.tobytes() + out.astype("<u4").tobytes() + rest[row, out].astype("<u4").tobytes()
    return bodies


def unpack(segment: bytes, first: int = 0, end: int | None = None) -> np.ndarray:
    """The ids from ``first`` to ``end``; only the blocks they stand in are read."""
    total, block, blocks = np.frombuffer(segment, dtype="<u4", count=3)
    end = int(total) if end is None else min(end, int(total))
    if first >= end:
        return np.zeros(0, dtype=np.uint32)
    block = int(block)
    starts = np.frombuffer(segment, dtype="<u4", count=int(blocks), offset=12)
    base = 12 + 4 * int(blocks)
    numbers = list(range(first // block, (end - 1) // block + 1))
    found = np.zeros((len(numbers), block), dtype=np.uint32)
    of_width: dict[tuple[int, int], list[tuple[int, int, int, int]]] = {}
    for row, k in enumerate(numbers):
        size = min(block, int(total) - k * block)
        low, width, n_out = (int(x) for x in np.frombuffer(segment, dtype="<u4", count=3, offset=base + int(starts[k])))
        of_width.setdefault((size, width), []).append((row, low, base + int(starts[k]) + 12, n_out))
    for (size, width), parts in of_width.items():
        # Blocks of one size and width are unpacked together.
        packed = (size * width + 7) // 8
        # Zeros behind each block, as a number is cut out of the whole bytes it may lie over.
        over = (width + 14) // 8
        raw = np.zeros((len(parts), packed + over), dtype=np.uint8)
        raw[:, :packed] = np.frombuffer(b"".join(segment[at : at + packed] for _, _, at, _ in parts), dtype=np.uint8).reshape(len(parts), packed)
        first_bit = np.arange(size) * width
        byte, wide = first_bit >> 3, np.uint32 if width <= 25 else np.uint64
        rest = np.zeros((len(parts), size), dtype=wide)
        for k in range(over):
            rest |= raw[:, byte + k].astype(wide) << wide(8 * k)
        rest = ((rest >> (first_bit & 7).astype(wide)) & wide((1 << width) - 1)).astype(np.uint32)
        for (row, low, at, n_out), values in zip(parts, rest, strict=True):
            out = np.frombuffer(segment, dtype="<u4", count=2 * n_out, offset=at + packed)
            values[out[:n_out]] = out[n_out:]
            found[row, :size] = values + np.uint32(low)
    return found.ravel()[first % block :][: end - first]


# Encoding.


@cache
def _uncommon() -> regex.Pattern:
    """Characters whose class (letter, number, space, other) may differ between versions of Unicode."""

    def kind(category: str, char: str) -> str:
        return category[0] if category[0] in "LN" else "space" if char.isspace() else "other"

    old = unicodedata.ucd_3_2_0
    common = [
        c
        for c in map(chr, range(0x3400))
        if old.category(c) != "Cn"
        and kind(old.category(c), c) == kind(unicodedata.category(c), c)
        and (not c.isspace() or c in "\t\n\v\f\r ")
        and c not in "\x1c\x1d\x1e\x1f\x85\u180e\u200b"
    ]
    listed = "".join(regex.escape(c, special_only=False) if ord(c) < 128 else c for c in common)
    return regex.compile(f"[^{listed}\u4e00-\u9fa5\uac00-\ud7a3]")


@cache
def _plain_bytes() -> bytes:
    """The characters up to U+00FF that are not uncommon, one byte each."""
    return bytes(c for c in range(256) if not _uncommon().search(chr(c)))


def _is_common(text: str) -> bool:
    try:
        return not text.encode("latin-1").translate(None, _plain_bytes())
    except UnicodeEncodeError:
        return _uncommon().search(text) is None


#: A space before white space; of common characters no other is white space.
_ODD_SPACES = tuple(" " + c for c in " \t\n\v\f\r")


#: Words of a text that is looked up by itself, and characters of texts that are looked up together.
_LONG, _TOGETHER = 1 << 16, 1 << 18


class ByteEncoder:
    """The ids that a byte-level ``tokenizers`` file gives, common words encoded once.

    The library cuts a text into pieces that are encoded on their own, and it always cuts
    before a space that something visible follows. So a text is looked up by the words
    between such spaces, and the library gets the words that are new in one text. Where no word has a
    space inside, the ids that start with one tell where words begin; otherwise a
    special token stands between words, which the library never merges over. A text with a special token's string,
    or with characters that libraries may class differently, goes through the library whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.library = Tokenizer.from_file(path)
        special = {i: t.content for i, t in self.library.get_added_tokens_decoder().items() if t.special}
        if not special:
            raise ValueError("a tokenizer without special tokens has none to put between words")
        self.between = next(iter(special.items()))
        self.special = tuple(special.values())
        space = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(" ")[0][0]
        known = self.library.get_vocab()
        self.starts = np.zeros(max(known.values()) + 1, dtype=bool)
        self.starts[[number for token, number in known.items() if token.startswith(space)]] = True
        self.words = PieceCache(self._words, pieces=900_000, ids=9_000_000)

    def _library(self, text: str) -> np.ndarray:
        (found,) = self.library.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, dtype=np.uint32)

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word with a space before it has, and the ids."""
        joined = " ".join(words)
        if joined.count(" ") == len(words) - 1 and "" not in words:
            found = self._library(" " + joined)
            places = np.flatnonzero(self.starts[found])
            if len(places) == len(words):
                return np.diff(places, append=len(found)), found
        number, mark = self.between
        found = self._library(" " + f"{mark} ".join(words))
        ends = np.append(np.flatnonzero(found == number), len(found))
        return np.diff(ends, prepend=-1) - 1, found[found != number]

    def _cut(self, text: str) -> list[str] | None:
        """What stands before the first word with a space, and the words; None for a text that goes through whole."""
        if any(mark in text for mark in self.special) or not _is_common(text):
            return None
        if text.endswith(" ") or any(pair in text for pair in _ODD_SPACES):
            return regex.split(r" (?=\S)", text)
        return text.split(" ")

    def ids(self, text: str) -> np.ndarray:
        return self.ids_of([text])[0]

    def ids_of(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text. The texts' words are looked up together; a long text's words some at a time."""
        cuts = [self._cut(text) for text in texts]
        firsts = self.library.encode_batch_fast([c[0] if c else t for c, t in zip(cuts, texts, strict=True)], add_special_tokens=False)
        heads = [np.array(f.ids, dtype=np.uint32) for f in firsts]
        short = [c[1:] if c and len(c) <= _LONG else [] for c in cuts]
        tails = self.words.ids_of(short)
        tails = [self.words.ids(c[1:]) if c and len(c) > _LONG else t for c, t in zip(cuts, tails, strict=True)]
        return [np.concatenate([h, t]) if len(t) else h for h, t in zip(heads, tails, strict=True)]


@cache
def encoder(path: str) -> ByteEncoder:
    """One encoder for each worker process."""
    return ByteEncoder(path)


def _some_together(texts: Iterable[str]) -> Iterator[list[str]]:
    """Texts in order, ``_TOGETHER`` characters or one longer text at a time."""
    some, size = [], 0
    for text in texts:
        if some and size + len(text) > _TOGETHER:
            yield some
            some, size = [], 0
        some.append(text)
        size += len(text)
    if some:
        yield some


# Files.


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Write the ids of all documents in ascending id order to ``folder``.

    Each file is one shard, a stretch of the order, and holds its segments in order:
    the ids of whole documents packed by ``pack``, with the documents' ids, their
    numbers of tokens, and the segment's first position in the shard. A shard's number is
    its place in the order. The end id follows every document; a NULL text is
    an empty one; NULL ids come first; documents of one id are in order of their texts' hashes and texts.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    texts = texts.withColumn("hash", F.xxhash64("text"))
    ordered = texts.repartitionByRange("doc_id", "hash").sortWithinPartitions("doc_id", "hash", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoder(tokenizer)
        shard, start, number = TaskContext.get().partitionId(), 0, 0
        doc_ids, counts, parts = [], [], []

        def segment() -> pa.RecordBatch:
            nonlocal start, number, doc_ids, counts, parts
            rows = {
                "shard": pa.array([shard], pa.int32()),
                "segment": pa.array([number], pa.int64()),
                "start": pa.array([start], pa.int64()),
                "doc_ids": pa.array([doc_ids], pa.list_(pa.int64())),
                "counts": pa.array([counts], pa.list_(pa.int64())),
                "ids": pa.array([pack(np.concatenate(parts))], pa.binary()),
            }
            start, number = start + sum(counts), number + 1
            doc_ids, counts, parts = [], [], []
            return pa.RecordBatch.from_arrays(list(rows.values()), list(rows))

        size = 0
        end = np.array([end_id], dtype=np.uint32)
        for batch in batches:
            ids = iter(batch.column("doc_id").to_pylist())
            for texts in _some_together(text.as_py() or "" for text in batch.column("text")):
                for found in encoding.ids_of(texts):
                    doc_ids.append(next(ids))
                    counts.append(len(found) + 1)
                    parts += [found, end]
                    size += counts[-1]
                    if size >= SEGMENT:
                        yield segment()
                        size = 0
        if parts:
            yield segment()

    packed = ordered.select("doc_id", "text").mapInArrow(
        encode, "shard int, segment long, start long, doc_ids array<long>, counts array<long>, ids binary"
    )
    packed.write.parquet(folder)


_SCHEMA = "shard int, segment long, start long, doc_ids array<long>, counts array<long>, ids binary"


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` and, if asked for, ``ids``, from the files of ``write_tokens``.

    ``start`` counts the ids of all documents before; the sizes of the shards before
    come from one row for each file. ``ids_crc32`` is over little-endian unsigned 32-bit ids.
    """
    files = spark.read.schema(_SCHEMA).parquet(folder)
    sizes = files.groupBy("shard").agg(
        F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, n: a + n)).alias("n")
    )
    before, bases = 0, []
    for shard, n in sorted(tuple(row) for row in sizes.collect()):
        bases.append((shard, before))
        before += n

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.array(row["counts"], dtype=np.int64)
                ends = np.cumsum(counts)
                ids = np.split(unpack(row["ids"]).astype("<u4"), ends[:-1])
                columns = {
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "shard": pa.array([row["shard"]] * len(counts), pa.int32()),
                    "start": pa.array(row["start"] + ends - counts),
                    "n_tokens": pa.array(counts),
                    "ids_crc32": pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array(ids, pa.list_(pa.uint32())).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = "doc_id long, shard int, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    found = files.mapInArrow(decode, schema)
    if not bases:
        return found.drop("shard")
    bases_df = spark.createDataFrame(bases, "shard int, base long")
    joined = found.join(F.broadcast(bases_df), "shard")
    return joined.select(
        "doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids
    )
