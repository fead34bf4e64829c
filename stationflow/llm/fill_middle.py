"""Fill-in-the-middle: texts cut at unit boundaries and put together in another order."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stationflow.llm.common import appended

#: Character classes and their number in the wavelet matrix; all other characters are class 0.
NEWLINE, BLANK, STOP = 1, 2, 3
LEVELS = 2

#: A unit ends behind each character of one of these classes, and at the end of the text.
UNITS = {"line": (NEWLINE,), "word": (NEWLINE, BLANK), "sentence": (NEWLINE, STOP)}

MARKS = ("<P>", "<S>", "<M>")


def classes(points: np.ndarray) -> np.ndarray:
    """The class of each code point."""
    table = np.zeros(128, np.uint8)
    for kind, characters in ((NEWLINE, "\n"), (BLANK, " \t\v\f\r"), (STOP, ".!?")):
        table[[ord(c) for c in characters]] = kind
    return np.where(points < 128, table[np.minimum(points, 127)], 0).astype(np.uint8)


class RankedBits:
    """A bit vector, packed, with the number of ones before each 64-bit block."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        packed = np.append(packed, np.zeros(16 - len(packed) % 8, np.uint8))  # a whole block follows the last bit
        self.blocks = packed.view("<u8")
        self.before = np.cumsum(np.append(0, np.bitwise_count(self.blocks[:-1])), dtype=np.int64)
        self.zeros = int(len(bits) - np.count_nonzero(bits))

    def ones(self, at: np.ndarray) -> np.ndarray:
        """How many ones precede each place."""
        block, inside = at >> 6, (at & 63).astype(np.uint64)
        low = self.blocks[block] & ((np.uint64(1) << inside) - np.uint64(1))
        return self.before[block] + np.bitwise_count(low)


class WaveletMatrix:
    """A sequence of small numbers, one bit vector for each bit, highest first; each is in the order
    of a stable sort by the bits above it."""

    def __init__(self, symbols: np.ndarray, levels: int = LEVELS):
        self.levels = []
        for level in reversed(range(levels)):
            bits = (symbols >> level & 1).astype(bool)
            self.levels.append((level, RankedBits(bits)))
            symbols = np.concatenate([symbols[~bits], symbols[bits]])

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How many of ``symbol`` precede each place."""
        low, high = np.zeros_like(at), at
        for level, bits in self.levels:
            if symbol >> level & 1:
                low, high = bits.zeros + bits.ones(low), bits.zeros + bits.ones(high)
            else:
                low, high = low - bits.ones(low), high - bits.ones(high)
        return high - low

    def count(self, symbols: Sequence[int], at: np.ndarray) -> np.ndarray:
        """How many of any of ``symbols`` precede each place: their ranks added up."""
        return sum(self.rank(s, at) for s in symbols)

    def locate(self, symbols: Sequence[int], wanted: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The first place in [low, high] that ``wanted`` of ``symbols`` precede, by bisection."""
        low, high = low.copy(), high.copy()
        while np.any(low < high):
            middle = (low + high) >> 1
            enough = self.count(symbols, middle) >= wanted
            low, high = np.where(enough | (low == high), low, middle + 1), np.where(enough, middle, high)
        return low


def cuts(texts: list[str], draws: np.ndarray, unit: str = "line") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text its number of units and the places, in characters, where the prefix and the
    middle end: after as many units as the draws (two for each text), modulo the units and one."""
    symbols = UNITS[unit]
    kinds = classes(np.frombuffer("".join(texts).encode("utf-32-le"), "<u4"))
    matrix = WaveletMatrix(kinds)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    first = matrix.count(symbols, starts)
    whole = matrix.count(symbols, ends) - first
    last = np.append(kinds, 0)[np.maximum(ends - 1, 0)]
    units = whole + ((sizes > 0) & ~np.isin(last, symbols))
    ordered = np.sort(draws % (units + 1)[:, None], axis=1)
    # The end of a text is the end of its last unit, closed or not.
    places = [np.where(k > whole, ends, matrix.locate(symbols, np.minimum(k, whole) + first, starts, ends)) - starts for k in ordered.T]
    return units, places[0], places[1]


def fill_in_middle(
    docs: DataFrame, doc_id: Column, text: str = "text", seed: int = 7, rate: int = 100, spm_rate: int = 50,
    unit: str = "line", marks: Sequence[str] = MARKS, out: str = "fim",
) -> DataFrame:
    """Add a struct ``out``: ``n`` units, ``form``, ``output``, ``prefix_chars``, ``middle_chars``.

    Two cuts fall behind units drawn by a hash of seed and id, so reruns agree: prefix, middle and
    suffix. ``psm`` writes prefix, suffix, middle, each behind its mark, ``spm`` suffix, prefix,
    middle; of a hundred texts ``rate`` are rewritten, ``spm_rate`` of those as ``spm``. A text that
    is empty or holds a mark stays as it is: form ``plain``, no lengths.

    The characters of a step of texts are one wavelet matrix over character classes. Ranks at the
    texts' ends count their units, bisection on ranks finds both cuts of all texts at once; three
    classes are two bits a character. One pass, no shuffle, whole texts.

    A null text is empty, a null id draws like an empty one, equal ids draw alike. An empty table
    gives no rows; other columns stay, one called ``out`` is replaced. Invalid UTF-8 is read with
    replacement characters."""
    if any(not m or m[0] in "".join(x[1:] for x in marks) for m in marks) or len(set(marks)) < 3:
        raise ValueError("marks must be different and begin with a character that no mark holds later on")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    drawn = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]
    p, s, m = marks

    def rewritten(column: pa.Array, *numbers: pa.Array) -> pa.Array:
        texts = [(t or b"").decode("utf-8", "replace") for t in column.to_pylist()]
        draws = np.stack([np.asarray(h) for h in numbers], axis=1)
        units, prefix, middle = cuts(texts, draws[:, :2], unit)
        forms, outputs = [], []
        for t, a, b, (_, _, h3, h4) in zip(texts, prefix.tolist(), middle.tolist(), draws.tolist()):
            plain = not t or h3 % 100 >= rate or any(mark in t for mark in marks)
            forms.append("plain" if plain else "spm" if h4 % 100 < spm_rate else "psm")
            if plain:
                outputs.append(t)
            elif forms[-1] == "psm":
                outputs.append("".join((p, t[:a], s, t[b:], m, t[a:b])))
            else:
                outputs.append("".join((s, t[b:], p, t[:a], m, t[a:b])))
        none = np.array([f == "plain" for f in forms])
        lengths = [pa.array(prefix, mask=none), pa.array(middle - prefix, mask=none)]
        return pa.StructArray.from_arrays(
            [pa.array(units), pa.array(forms, pa.string()), pa.array(outputs, pa.string()), *lengths], ["n", "form", "output", "prefix_chars", "middle_chars"]
        )

    kind = "struct<n: bigint, form: string, output: string, prefix_chars: bigint, middle_chars: bigint>"
    return appended(docs, out, kind, rewritten, F.col(f"`{text}`").cast("binary"), *drawn)


def restored(output: Column, form: Column, marks: Sequence[str] = MARKS) -> Column:
    """The text that an output of ``fill_in_middle`` was made of; null if either is null."""
    p, s, m = marks
    ahead = lambda x, mark: F.substring_index(x, mark, 1)
    behind = lambda x, mark: F.substr(x, F.length(ahead(x, mark)) + F.lit(len(mark) + 1))
    psm = F.concat(ahead(behind(output, p), s), behind(output, m), ahead(behind(output, s), m))
    spm = F.concat(ahead(behind(output, p), m), behind(output, m), ahead(behind(output, s), p))
    return F.when(form == "plain", output).when(form == "psm", psm).when(form == "spm", spm)
