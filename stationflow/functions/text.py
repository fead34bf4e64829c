"""Text expressions: dates in questions, chunking, word sequences."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, functions as F

# Date patterns in order of trial, with their formats.
DATE_PATTERNS = [
    (r"\d{2}/\d{2}/\d{4}", "dd/MM/yyyy"),
    (r"\d{4}-\d{2}-\d{2}", "yyyy-MM-dd"),
    (r"\d{2}-\d{2}-\d{4}", "dd-MM-yyyy"),
]

# What a text is split at, coarsest first; the empty one splits into characters.
SEPARATORS = ["\n\n", "\n", " ", ""]

#: What Python's ``str.strip`` takes off.
BLANKS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once a row, however often the body mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _joined(pieces: Column, first: Column, count: Column) -> Column:
    """``count`` pieces in one text, fewer where they end. Reads only these (``slice`` copies all)."""
    return F.array_join(F.transform(F.sequence(first, first + count - 1), lambda i: F.get(pieces, i)), "")


def first_date(text: Column) -> Column:
    """The date named in a text, by the first pattern that gives a valid one."""
    found = [
        F.try_to_date(F.nullif(F.regexp_extract(text, f"({pattern})", 1), F.lit("")), fmt)
        for pattern, fmt in DATE_PATTERNS
    ]
    return F.coalesce(*found)


def date_or_unknown(text: Column) -> Column:
    return F.coalesce(F.date_format(first_date(text), "yyyy-MM-dd"), F.lit("unknown"))


def words(text: Column) -> Column:
    """Lower-case words: runs of letters, digits and underscores."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}_]+"), lambda w: w != "")


def word_runs(text: Column, longest: int) -> Column:
    """All runs of 1 to ``longest`` consecutive words, each once."""

    def runs(tokens: Column, n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(tokens) - (n - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, n), " "))

    return let(words(text), lambda tokens: F.array_distinct(F.concat(*[runs(tokens, n) for n in range(1, longest + 1)])))


def _plain_letters() -> tuple[str, str]:
    """Letters with accents of the Latin blocks, and the letters that are left without them."""
    bare = {"đ": "d", "ø": "o", "ł": "l", "ħ": "h", "ŧ": "t", "ı": "i"}  # fixed values: they have no accent to take off
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        first = unicodedata.normalize("NFD", chr(code))[0]
        if first != chr(code) and first.isascii():
            bare[chr(code)] = first
    return "".join(bare), "".join(bare.values())


def folded(text: Column) -> Column:
    """Lower case without accents, whether they are part of a letter or follow it."""
    return F.regexp_replace(F.translate(F.lower(text), *_plain_letters()), r"\p{Mn}+", "")


def deletions(text: Column, most: Column, limit: int) -> Column:
    """The text and all it becomes by taking out up to ``most`` characters, each once. Two texts that
    ``most`` edits turn into one another have one of these in common. ``limit`` bounds ``most``."""

    def shorter(t: Column) -> Column:
        cuts = F.sequence(F.lit(1), F.length(t))
        rest = F.transform(cuts, lambda i: F.concat(F.left(t, i - 1), F.substring(t, i + 1, F.length(t))))
        return F.when(F.length(t) > 0, rest).otherwise(F.array().cast("array<string>"))

    found = last = F.array(text)
    for round_ in range(1, limit + 1):
        last = F.array_distinct(F.flatten(F.transform(last, shorter)))
        found = F.when(most >= round_, F.concat(found, last)).otherwise(found)
    return F.array_distinct(found)


def fixed_chunks(text: Column, size: int = 1000, overlap: int = 10) -> Column:
    """Pieces of ``size`` characters, each starting ``size - overlap`` after the last. The text is cut
    into steps once and chunks are put together from them, in time linear in its length."""
    step = size - overlap
    last = F.floor((F.greatest(F.length(text) - overlap, F.lit(1)) - 1) / step).cast("int")
    span = F.lit(1 - (-overlap // step))
    steps = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{step}}}"), F.lit(0))
    chunks = let(steps, lambda s: F.transform(F.sequence(F.lit(0), last), lambda k: F.left(_joined(s, k, span), F.lit(size))))
    return F.when(F.length(text) > 0, chunks).otherwise(F.array().cast("array<string>"))


def _pieces(text: str, separator: str) -> list[str]:
    """Split before each separator, which stays at the head of its piece."""
    if not separator:
        return list(text)
    head, *rest = text.split(separator)
    return [p for p in [head, *(separator + r for r in rest)] if p]


def _pack(pieces: list[str], size: int, overlap: int) -> Iterator[str]:
    """Join neighbours up to ``size``; the next chunk repeats a tail of at most ``overlap``."""
    start, length = 0, 0
    for i, piece in enumerate(pieces):
        if length + len(piece) > size and start < i:
            yield "".join(pieces[start:i])
            while start < i and (length > overlap or length + len(piece) > size):
                length -= len(pieces[start])
                start += 1
        length += len(piece)
    if start < len(pieces):
        yield "".join(pieces[start:])


def split_recursive(text: str, size: int = 1000, overlap: int = 10, separators: list[str] = SEPARATORS) -> list[str]:
    """Chunks of at most ``size``, cut at the coarsest separator that makes them fit. This is the plain
    form for one text; ``recursive_chunks`` does the same for a column."""
    position = next((i for i, s in enumerate(separators) if s == "" or s in text), len(separators) - 1)
    finer = separators[position + 1 :]
    chunks: list[str] = []
    fitting: list[str] = []

    def flush() -> None:
        chunks.extend(c for c in (packed.strip() for packed in _pack(fitting, size, overlap)) if c)
        fitting.clear()

    for piece in _pieces(text, separators[position]):
        if len(piece) < size:
            fitting.append(piece)
            continue
        flush()
        chunks.extend(split_recursive(piece, size, overlap, finer) if finer else [piece])
    flush()
    return chunks


#: Pieces that are packed with one state.
_BLOCK = 256


def _span(first: Column, count: Column, whole: bool) -> Column:
    return F.array(F.struct(first.alias("first"), count.alias("count"), F.lit(whole).alias("whole")))


def _tail(lengths: Column, before: Column, piece: Column, size: int, overlap: int) -> Column:
    """``count, length`` of the pieces before one that its chunk repeats: as many of the last ones as
    have at most ``overlap`` characters and leave room for the piece."""
    none = F.struct(F.lit(0).alias("count"), F.lit(0).alias("length"), F.lit(True).alias("open"))
    if not overlap:
        return none

    def taken(t: Column, at: Column) -> Column:
        total = t["length"] + F.get(lengths, at)
        fits = t["open"] & (total <= overlap) & (total + piece <= size)
        grown = F.struct((t["count"] + 1).alias("count"), total.alias("length"), F.lit(True).alias("open"))
        return F.when(fits, grown).otherwise(F.struct(t["count"].alias("count"), t["length"].alias("length"), F.lit(False).alias("open")))

    return F.aggregate(F.sequence(before - 1, F.greatest(before - overlap, F.lit(0)), F.lit(-1)), none, taken)


def _spans(lengths: Column, size: int, overlap: int) -> Column:
    """The chunks that pieces of these lengths are packed into, as ``first, count, whole``: runs of
    pieces, or (``whole``) one that doesn't fit and is to be cut further.

    ``aggregate`` copies its state at each step, so the chunks found so far aren't part of it but for
    those of the block of pieces at hand."""

    def state(at: Column, start: Column, length: Column, spans: Column) -> Column:
        return F.struct(at.alias("at"), start.alias("start"), length.alias("length"), spans.alias("spans"))

    def step(s: Column, n: Column) -> Column:
        at, start, length, spans = s["at"], s["start"], s["length"], s["spans"]
        closed, own = F.concat(spans, _span(start, at - start, False)), _span(at, F.lit(1), True)
        alone = F.when(start < at, F.concat(closed, own)).otherwise(F.concat(spans, own))
        packed = let(
            _tail(lengths, at, n, size, overlap), lambda t: state(at + 1, at - t["count"], t["length"] + n, closed)
        )
        return (
            F.when(n >= size, state(at + 1, at + 1, F.lit(0), alone))
            .when((length + n > size) & (start < at), packed)
            .otherwise(state(at + 1, start, length + n, spans))
        )

    none = F.array().cast("array<struct<first:int,count:int,whole:boolean>>")
    total = F.size(lengths)

    def block(s: Column, first: Column) -> Column:
        pieces = F.transform(F.sequence(first, F.least(first + _BLOCK, total) - 1), lambda i: F.get(lengths, i))
        inside = F.aggregate(pieces, state(s["at"], s["start"], s["length"], none), step)
        return let(inside, lambda i: state(i["at"], i["start"], i["length"], F.concat(s["spans"], i["spans"])))

    blocks = F.sequence(F.lit(0), total - 1, F.lit(_BLOCK))
    done = F.aggregate(blocks, state(F.lit(0), F.lit(0), F.lit(0), none), block)

    def closed(s: Column) -> Column:
        last = _span(s["start"], s["at"] - s["start"], False)
        return F.when(s["start"] < s["at"], F.concat(s["spans"], last)).otherwise(s["spans"])

    return F.when(total > 0, let(done, closed)).otherwise(none)


def _level(text: Column, separators: Sequence[str], size: int, overlap: int) -> Column:
    """Chunks of a text by its pieces at the first separator; pieces that don't fit go a level down. A
    level whose separator the text lacks has one piece, which fits or goes down, so none is skipped."""
    separator, *finer = separators
    if not separator:
        return fixed_chunks(text, size, overlap)
    parts = F.split(text, re.escape(separator), -1)
    headed = F.transform(parts, lambda p, k: F.when(k == 0, p).otherwise(F.concat(F.lit(separator), p)))

    def packed(pieces: Column) -> Column:
        def chunk(s: Column) -> Column:
            run = F.array(_joined(pieces, s["first"], s["count"]))
            return F.when(s["whole"], _level(F.get(pieces, s["first"]), finer, size, overlap)).otherwise(run)

        return F.flatten(let(F.transform(pieces, F.length), lambda n: F.transform(_spans(n, size, overlap), chunk)))

    return let(F.filter(headed, lambda p: p != ""), packed)


def recursive_chunks(size: int = 1000, overlap: int = 10) -> Callable[[Column], Column]:
    """A column function: whole texts in, arrays of chunks out, as ``split_recursive`` cuts them, built
    from array functions only. A null or empty text has no chunks; a chunk of white space is none."""

    def chunk(text: Column) -> Column:
        cut = F.when(F.length(text) < size, F.array(text)).otherwise(_level(text, SEPARATORS, size, overlap))
        found = F.transform(cut, lambda c: F.btrim(c, F.lit(BLANKS)))
        return F.coalesce(F.filter(found, lambda c: c != ""), F.array().cast("array<string>"))

    return chunk
