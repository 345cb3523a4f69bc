"""Fill-in-middle forms of texts, cut between characters, words or lines by ranks in a wavelet matrix."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What marks the prefix, the suffix and the middle.
SENTINELS = ("<P>", "<S>", "<M>")
#: Of a hundred texts, those from here on stay plain, and of the others so many have the suffix first.
PLAIN_FROM = 90
SUFFIX_FIRST = 20

#: A byte's class is a set of these: where a character, a word and a line start.
UNITS = {"character": 1, "word": 2, "line": 4}
_CLASS_BITS = 3


def classes(text: bytes) -> np.ndarray:
    """The class of every byte of a UTF-8 text, from 0 to 7.

    A continuation byte starts nothing, any other byte a character. A word starts at a byte
    that is no ASCII white space and follows one or the text's start; a line starts
    the text, and follows every line feed.
    """
    raw = np.frombuffer(text, dtype=np.uint8)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    first = np.ones(1, dtype=bool)
    after_space = np.concatenate([first, space[:-1]])[: len(raw)]
    after_line = np.concatenate([first, raw[:-1] == 10])[: len(raw)]
    return ((raw & 0xC0) != 0x80) * np.uint8(1) + (~space & after_space) * np.uint8(2) + after_line * np.uint8(4)


class WaveletMatrix:
    """A sequence of small numbers that tells how often each stands before any place.

    Level by level, from the highest bit, numbers whose bit is 0 go before those whose
    bit is 1, in their order. A level keeps its bits, 64 to a word, and how many are set before each word.
    """

    def __init__(self, symbols: np.ndarray, bits: int):
        self.size, self.bits = len(symbols), bits
        self.words: list[np.ndarray] = []
        self.before: list[np.ndarray] = []
        self.zeros: list[int] = []
        now = symbols
        for level in range(bits):
            bit = (now >> (bits - 1 - level)) & 1
            packed = np.packbits(bit, bitorder="little")
            words = np.zeros(len(symbols) // 64 + 1, dtype="<u8")
            words.view(np.uint8)[: len(packed)] = packed
            counts = np.bitwise_count(words)
            self.words.append(words)
            self.before.append(np.cumsum(counts, dtype=np.int64) - counts)
            self.zeros.append(len(now) - int(bit.sum(dtype=np.int64)))
            marked = bit.astype(bool)
            now = np.concatenate([now[~marked], now[marked]])

    def _ones(self, level: int, end: int) -> int:
        """How many bits of a level are set before ``end``."""
        word = end >> 6
        rest = int(self.words[level][word]) & ((1 << (end & 63)) - 1)
        return int(self.before[level][word]) + rest.bit_count()

    def with_bit(self, which: int, end: int) -> int:
        """How many numbers before ``end`` have the bit ``1 << which``: the ranks of all those numbers, added up.

        Numbers that agree in their higher bits stand together on a level, so the ranks of
        all of them are the set bits of a few stretches.
        """
        last = self.bits - 1 - which
        stretches = [(0, end)]
        for level in range(last):
            halves = []
            for start, stop in stretches:
                low, high = self._ones(level, start), self._ones(level, stop)
                halves += [(start - low, stop - high), (self.zeros[level] + low, self.zeros[level] + high)]
            stretches = [s for s in halves if s[0] < s[1]]
        return sum(self._ones(last, stop) - self._ones(last, start) for start, stop in stretches)

    def place(self, which: int, number: int) -> int:
        """Where the number with the bit stands that ``number`` such precede; the size if there is none. Bisection on ranks."""
        low, high = 0, self.size
        while low < high:
            middle = (low + high) // 2
            if self.with_bit(which, middle + 1) > number:
                high = middle
            else:
                low = middle + 1
        return low


class Cutter:
    """The units of one text: how many, and the byte where each starts."""

    def __init__(self, text: bytes, unit: str = "character"):
        self.text, self.which = text, UNITS[unit].bit_length() - 1
        self.matrix = WaveletMatrix(classes(text), _CLASS_BITS)
        self.n = self.matrix.with_bit(self.which, len(text))

    def at(self, units: int) -> int:
        """The byte where the first ``units`` units end; what stands before the first unit is its own."""
        return self.matrix.place(self.which, units) if units else 0

    def characters(self, start: int, end: int) -> int:
        return self.matrix.with_bit(0, end) - self.matrix.with_bit(0, start)


def draws(doc_id: str, seed: int) -> list[int]:
    """Eight numbers of 32 bits from the SHA-256 of seed, colon and id."""
    digest = hashlib.sha256(f"{seed}:{doc_id}".encode()).digest()
    return np.frombuffer(digest, dtype=">u4").tolist()


def transform(text: bytes, numbers: list[int], unit: str = "character", sentinels: tuple[str, str, str] = SENTINELS) -> tuple[str, bytes, int, int, int, int, int]:
    """The form, the output, the number of units, the bytes where prefix and middle end, and the characters of both."""
    cutter = Cutter(text, unit)
    n = cutter.n
    marks = [s.encode() for s in sentinels]
    if not text or any(m in text for m in marks) or numbers[2] % 100 >= PLAIN_FROM:
        return "plain", text, n, 0, 0, 0, 0
    first, last = sorted((numbers[0] % (n + 1), numbers[1] % (n + 1)))
    one, two = cutter.at(first), cutter.at(last)
    prefix, middle, suffix = text[:one], text[one:two], text[two:]
    p, s, m = marks
    form = "spm" if numbers[3] % 100 < SUFFIX_FIRST else "psm"
    out = s + suffix + p + prefix + m + middle if form == "spm" else p + prefix + s + suffix + m + middle
    return form, out, n, one, two, cutter.characters(0, one), cutter.characters(one, two)


def restore(output: bytes, form: str, sentinels: tuple[str, str, str] = SENTINELS) -> bytes:
    """The text that ``transform`` made the output from."""
    if form == "plain":
        return output
    p, s, m = (x.encode() for x in sentinels)
    lead, between = (s, p) if form == "spm" else (p, s)
    first, rest = output.removeprefix(lead).split(between, 1)
    second, middle = rest.split(m, 1)
    prefix, suffix = (second, first) if form == "spm" else (first, second)
    return prefix + middle + suffix


_OUTPUTS = {
    "n": ("long", pa.int64()),
    "form": ("string", pa.string()),
    "prefix_chars": ("long", pa.int64()),
    "middle_chars": ("long", pa.int64()),
    "output": ("string", pa.large_string()),
    "restored": ("string", pa.large_string()),
    "output_sha256": ("string", pa.string()),
    "restored_sha256": ("string", pa.string()),
}
#: Bytes of texts whose results are held before they are handed on.
BATCH_BYTES = 8 << 20


def fill_in_middle(
    docs: DataFrame,
    unit: str = "character",
    seed: int = 1,
    sentinels: tuple[str, str, str] = SENTINELS,
    outputs: tuple[str, ...] = ("n", "form", "prefix_chars", "middle_chars", "output"),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: its id as ``doc_id`` and the ``outputs`` asked for.

    Each whole text is cut twice between units (characters, words or lines), at places drawn from
    its id; a unit has what follows it up to the next, and the first what precedes it. The ``output`` has the
    pieces behind their sentinels, prefix, suffix and middle (``psm``), or suffix, prefix and middle
    (``spm``). Some texts, those that are empty, and those that hold a sentinel stay ``plain``. ``restored`` is
    the text rebuilt from output and form.

    NULL is an empty text. A NULL id draws as an empty one does. Repeated rows give a row
    each, with the same values; an empty table gives none. ``n`` counts units,
    ``prefix_chars`` and ``middle_chars`` code points (NULL where the form is plain).
    """
    unknown = set(outputs) - set(_OUTPUTS)
    if unknown or unit not in UNITS:
        raise ValueError(f"no such outputs or unit: {sorted(unknown)}, {unit}")
    if len(set(sentinels)) != 3 or any(not a or (a != b and a in b) for a in sentinels for b in sentinels):
        raise ValueError("three sentinels are needed, none of which holds another")
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).alias("doc_id"), key.alias("key"), F.col(text_col).alias("text"))

    def rows_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found: dict[str, list] = {name: [] for name in _OUTPUTS}
        start = held = 0

        def part(end: int) -> pa.RecordBatch:
            columns = [pa.array(found[name], _OUTPUTS[name][1]) for name in outputs]
            # Texts as Spark sends them.
            columns = [c.cast(pa.string()) if c.type == pa.large_string() else c for c in columns]
            for values in found.values():
                values.clear()
            return pa.RecordBatch.from_arrays([batch.column("doc_id").slice(start, end - start), *columns], ["doc_id", *outputs])

        keys, column = batch.column("key"), batch.column("text").cast(pa.large_binary())
        for k in range(len(batch)):
            text = column[k].as_py() or b""
            form, out, n, _, _, prefix, middle = transform(text, draws(keys[k].as_py(), seed), unit, sentinels)
            restored = restore(out, form, sentinels) if {"restored", "restored_sha256"} & set(outputs) else b""
            plain = form == "plain"
            made = {
                "n": n,
                "form": form,
                "prefix_chars": None if plain else prefix,
                "middle_chars": None if plain else middle,
                "output": out,
                "restored": restored,
                "output_sha256": hashlib.sha256(out).hexdigest() if "output_sha256" in outputs else None,
                "restored_sha256": hashlib.sha256(restored).hexdigest() if "restored_sha256" in outputs else None,
            }
            for name in outputs:
                found[name].append(made[name])
            held += len(text)
            if held >= BATCH_BYTES:
                yield part(k + 1)
                start, held = k + 1, 0
        if start < len(batch):
            yield part(len(batch))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from rows_of(batch)

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(make, ", ".join([f"doc_id {kind}", *(f"{name} {_OUTPUTS[name][0]}" for name in outputs)]))
