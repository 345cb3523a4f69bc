"""SentencePiece encoding that keeps every piece's place in the source text, and decoding."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache, cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.piece_cache import PieceCache

SPACE = "▁"
_SPACE = SPACE.encode()
#: Pieces of a text between a space and the next one; a text is read with one space before it.
_SEGMENT = re.compile(" +[^ ]*")


class CharacterMap:
    """The compiled map of a model's normaliser: a double-array trie over UTF-8 and the replacements.

    The blob has the trie's size in bytes, its 32-bit units, and the replacements, each ended by a zero byte.
    """

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob, dtype="<u4", count=size // 4, offset=4).tolist() if blob else []
        self.replacements = blob[4 + size :]

    def longest(self, text: bytes, start: int) -> tuple[int, bytes] | None:
        """The length of the longest key that stands at ``start``, and what replaces it."""
        units = self.units
        if not units:
            return None
        found = None
        node = _offset(units[0])
        for at in range(start, len(text)):
            node ^= text[at]
            if node >= len(units) or (units[node] & 0x800000FF) != text[at]:
                break
            unit = units[node]
            node ^= _offset(unit)
            if unit >> 8 & 1:
                found = at + 1 - start, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        length, at = found
        return length, self.replacements[at : self.replacements.index(b"\0", at)]


def _offset(unit: int) -> int:
    return (unit >> 10) << ((unit & 0x200) >> 6)


class PieceModel:
    """A SentencePiece model with byte fallback, as a library object and as tables."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        self.library = SentencePieceProcessor(model_file=path)
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        self.rules = proto.normalizer_spec
        self.map = CharacterMap(self.rules.precompiled_charsmap)
        if not proto.trainer_spec.byte_fallback:
            raise ValueError("only models with byte fallback place every piece")
        kinds = proto.SentencePiece.Type
        self.lengths = np.array(
            [
                1 if p.type == kinds.BYTE else len(p.piece.encode()) if p.type == kinds.NORMAL else 0
                for p in proto.pieces
            ],
            dtype=np.int64,
        )
        # Merges never reach over a space if no piece has one after another character, so
        # what stands between spaces can be encoded on its own, and once for all its places.
        self.by_segment = (
            proto.trainer_spec.model_type == 2
            and not self.map.units
            and self.rules.add_dummy_prefix
            and self.rules.escape_whitespaces
            and not self.rules.remove_extra_whitespaces
            and not any(re.search(f"[^{SPACE}]{SPACE}", p.piece) or p.type == kinds.USER_DEFINED for p in proto.pieces)
        )
        self.single = self.library.piece_to_id(SPACE)
        self.pieces = PieceCache(self._segments)

    def _segments(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each segment has, and the ids."""
        found = self.library.encode([s[1:] for s in segments], num_threads=1)
        found = [ids if s != " " else [self.single] for s, ids in zip(segments, found, strict=True)]
        count = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return count, np.fromiter(chain.from_iterable(found), dtype=np.uint32, count=int(count.sum()))

    def ids(self, text: str) -> np.ndarray:
        """The ids of a text, with begin and end ids."""
        if text and self.by_segment and SPACE not in text:
            segments = (m.group() for m in _SEGMENT.finditer(" " + text)) if len(text) >= 1 << 20 else _SEGMENT.findall(" " + text)
            inner = self.pieces.ids(segments)
        else:
            inner = np.array(self.library.encode(text), dtype=np.uint32)
        ends = np.array([self.library.bos_id(), self.library.eos_id()], dtype=np.uint32)
        return np.concatenate([ends[:1], inner, ends[1:]])

    def normalised(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised text, and for each of its bytes and its end the byte of the source it comes from."""
        if not text:
            return b"", np.zeros(1, dtype=np.int64)
        if self.by_segment:
            source = np.frombuffer(text, dtype=np.uint8)
            width = np.where(source == 32, len(_SPACE), 1)
            origin = np.repeat(np.arange(len(text), dtype=np.int32), width)
            ends = np.zeros(len(_SPACE), dtype=np.int32), np.array([len(text)], dtype=np.int32)
            return _SPACE + text.replace(b" ", _SPACE), np.concatenate([ends[0], origin, ends[1]])
        return self._mapped(text)

    def _mapped(self, text: bytes) -> tuple[bytes, np.ndarray]:
        trim, escape = self.rules.remove_extra_whitespaces, self.rules.escape_whitespaces
        out, origin = bytearray(), []
        spaced = trim
        at = 0
        while at < len(text):
            found = self.map.longest(text, at)
            length = found[0] if found else _character(text, at)
            put = found[1] if found else text[at : at + length]
            if spaced:
                put = put.lstrip(b" ")
            if put and not out and self.rules.add_dummy_prefix:
                first = _SPACE if escape else b" "
                out += first
                origin += [at] * len(first)
            if put:
                spaced = trim and put.endswith(b" ")
                put = put.replace(b" ", _SPACE) if escape else put
                out += put
                origin += [at] * len(put)
            at += length
        space = _SPACE if escape else b" "
        while trim and out.endswith(space):
            del out[-len(space) :]
            del origin[-len(space) :]
        return bytes(out), np.array([*origin, len(text)], dtype=np.int64)

    def spans(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end byte in the source for every id; begin and end ids have empty spans."""
        _, origin = self.normalised(text.encode())
        ends = np.cumsum(self.lengths[ids])
        return origin[ends - self.lengths[ids]], origin[ends]

    @cached_property
    def size(self) -> int:
        return len(self.lengths)


def _character(text: bytes, at: int) -> int:
    lead = text[at]
    return min(len(text) - at, 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4)


@cache
def model(path: str) -> PieceModel:
    """One model for each worker process."""
    return PieceModel(path)


_OUTPUTS = {
    "n_tokens": ("long", pa.int64()),
    "ids": ("array<int>", pa.list_(pa.int32())),
    "first_byte": ("array<int>", pa.list_(pa.int32())),
    "end_byte": ("array<int>", pa.list_(pa.int32())),
    "n_bytes": ("long", pa.int64()),
    "decoded": ("string", pa.string()),
    "ids_sha256": ("string", pa.string()),
    "spans_sha256": ("string", pa.string()),
    "decoded_sha256": ("string", pa.string()),
}
#: Bytes of texts whose results are held before they are handed on.
BATCH_BYTES = 2 << 20


def _column(name: str, values: list) -> pa.Array:
    kind = _OUTPUTS[name][1]
    if not pa.types.is_list(kind):
        return pa.array(values, kind)
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    flat = np.concatenate([np.zeros(0, dtype=np.int32), *values]).astype(np.int32, copy=False)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def encode_pieces(
    docs: DataFrame,
    model_file: str,
    outputs: tuple[str, ...] = ("n_tokens", "ids", "first_byte", "end_byte", "decoded"),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: its id as ``doc_id`` and the ``outputs`` asked for.

    ``ids`` are those of the library, with begin and end ids; ``first_byte`` and
    ``end_byte`` give each one's bytes in the UTF-8 source, so that the spans follow
    one another from the first byte to the last (``n_bytes``) but for white space that
    the model's rules drop; pieces of one replaced character share its start.
    ``decoded`` is the library's decoding of the ids. The digests are over little-endian
    unsigned 32-bit ids, all first bytes and then all end bytes in the same form, and the decoded text in UTF-8.
    NULL is encoded as an empty text; repeated rows and NULL ids give a row each; an empty table gives none.

    A task holds the results of ``BATCH_BYTES`` of text, or of one longer text, at a time.
    """
    unknown = set(outputs) - set(_OUTPUTS)
    if unknown:
        raise ValueError(f"no such outputs: {sorted(unknown)}")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    spanned = {"first_byte", "end_byte", "n_bytes", "spans_sha256"} & set(outputs)
    decoding = {"decoded", "decoded_sha256"} & set(outputs)

    def encoded(pieces: PieceModel, text: str) -> dict:
        ids = pieces.ids(text)
        made = {"n_tokens": len(ids), "ids": ids}
        if spanned:
            made["first_byte"], made["end_byte"] = first, end = pieces.spans(text, ids)
            made["n_bytes"] = int(end[-1] - first[0])
            if "spans_sha256" in outputs:
                made["spans_sha256"] = hashlib.sha256(np.concatenate([first, end]).astype("<u4").tobytes()).hexdigest()
        if decoding:
            made["decoded"] = pieces.library.decode(ids.tolist())
            made["decoded_sha256"] = hashlib.sha256(made["decoded"].encode()).hexdigest()
        if "ids_sha256" in outputs:
            made["ids_sha256"] = hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest()
        return made

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(model_file)
        for batch in batches:
            column, start, held = batch.column("text"), 0, 0
            found: dict[str, list] = {name: [] for name in outputs}
            for k in range(len(batch)):
                text = column[k].as_py() or ""
                made = encoded(pieces, text)
                for name, values in found.items():
                    values.append(made[name])
                held += len(text)
                if held >= BATCH_BYTES or k + 1 == len(batch):
                    ids = batch.column("doc_id").slice(start, k + 1 - start)
                    yield pa.RecordBatch.from_arrays([ids, *[_column(n, v) for n, v in found.items()]], ["doc_id", *outputs])
                    found = {name: [] for name in outputs}
                    start, held = k + 1, 0

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(encode, ", ".join([f"doc_id {kind}", *(f"{n} {_OUTPUTS[n][0]}" for n in outputs)]))
