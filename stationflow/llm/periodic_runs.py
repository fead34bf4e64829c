"""Periodic runs of words: where a text repeats itself with a fixed period, and the text without them."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stationflow.llm.common import U64, appended, mix

#: Periods up to this many words are found by comparing the text with itself at that lag.
SHORT = 8

#: A run is a stretch of at least LEAST words and TIMES periods.
LEAST, TIMES = 6, 4

RUN = "struct<start: bigint, length: bigint, period: bigint>"


def lag_stretches(ids: np.ndarray, lag: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of every longest stretch whose words equal those ``lag`` words on."""
    same = np.flatnonzero(ids[lag:] == ids[:-lag])
    if not len(same):
        return same, same
    breaks = np.flatnonzero(np.diff(same) > 1)
    first, last = same[np.append(0, breaks + 1)], same[np.append(breaks, len(same) - 1)]
    return first, last - first + 1 + lag


def window_minima(hashes: np.ndarray, width: int) -> np.ndarray:
    """The places that are the leftmost minimum of some window of ``width`` hashes, a power of two."""
    low, at, done = hashes, np.arange(len(hashes)), 1
    while done < width and len(low) > done:
        right = low[done:] < low[:-done]
        low, at = np.where(right, low[done:], low[:-done]), np.where(right, at[done:], at[:-done])
        done *= 2
    return at[np.diff(at, prepend=-1) > 0]


def paired_minimizers(hashes: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Each minimizer and its distance to the next one with the same hash, where that distance is
    in (scale / 2, scale]; one pair for each minimizer at most."""
    found = window_minima(hashes, scale // 2)
    found = found[np.argsort(hashes[found], kind="stable")]
    near = (hashes[found[1:]] == hashes[found[:-1]]) & (np.diff(found) > scale // 2) & (np.diff(found) <= scale)
    return found[:-1][near], np.diff(found)[near]


def agreement(ids: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The longest stretch of places around ``at``, as (first, end), whose words equal those ``lag``
    on. Compared in pieces that double, so it costs what it covers."""
    end, size, most = at, 64, len(ids) - lag
    while end < most:
        stop = min(end + size, most)
        odd = np.flatnonzero(ids[end:stop] != ids[end + lag : stop + lag])
        end = end + int(odd[0]) if len(odd) else stop
        if len(odd):
            break
        size *= 2
    first, size = at, 64
    while first:
        start = max(0, first - size)
        odd = np.flatnonzero(ids[start:first] != ids[start + lag : first + lag])
        first = start + int(odd[-1]) + 1 if len(odd) else start
        if len(odd):
            break
        size *= 2
    return first, end


def seeded_stretches(ids: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of stretches with periods above SHORT, by minimizers at every scale.

    At scale k, a power of two, each place has the hash of its k words. In a run of period q in
    (k/2, k] equal hashes lie whole periods apart, as the k words hold a period or more, and windows
    of k/2 places choose the same minimum one period on; so each run has a minimizer whose next
    equal one is q on. Such pairs are extended on the words themselves. ``sizes`` are the texts'
    words and their end mark; texts too short for a scale leave the array before it."""
    out, scale = [], 1
    hashes = mix(ids.astype(np.int64).view(U64) + U64(0x9E3779B97F4A7C15))
    place, text = np.arange(len(ids)), np.repeat(np.arange(len(sizes)), sizes)
    while True:
        long = sizes[text[: len(hashes)]] > (TIMES // 2) * 2 * scale
        if not long.any():
            return out
        hashes, place, text = hashes[long], place[: len(long)][long], text[: len(long)][long]
        with np.errstate(over="ignore"):
            hashes = mix(hashes[:-scale] * U64(0xD6E8FEB86659FD93) + hashes[scale:])
        scale *= 2
        if scale <= SHORT:
            continue
        at, lags = paired_minimizers(hashes, scale)
        covered: dict[int, int] = defaultdict(int)
        for i in np.argsort(at, kind="stable"):
            spot, lag = int(place[at[i]]), int(lags[i])
            if spot < covered[lag]:
                continue
            first, end = agreement(ids, spot, lag)
            covered[lag] = max(end, spot + 1)
            out.append((first, end + lag - first, lag))


def find_runs(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All runs, as rows of start, length and smallest period, ordered by start and period.

    ``ids`` are the words of several texts as numbers, each text followed by a number found nowhere
    else; ``sizes`` counts a text's numbers. A run is a stretch of at least LEAST words and TIMES
    periods that neither neighbour continues. A stretch is also found by multiples of its period;
    it has the same ends then, and the smallest period stays."""
    found = []
    for lag in range(1, min(SHORT, len(ids) - 1) + 1):
        start, length = lag_stretches(ids, lag)
        found.append(np.stack([start, length, np.full(len(start), lag)], axis=1))
    found.append(np.array(seeded_stretches(ids, sizes), np.int64).reshape(-1, 3))
    runs = np.concatenate(found)
    runs = runs[runs[:, 1] >= np.maximum(LEAST, TIMES * runs[:, 2])]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    runs = runs[np.append(True, np.any(np.diff(runs[:, :2], axis=0) != 0, axis=1))[: len(runs)]]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def described(texts: pa.Array) -> pa.Array:
    """The struct of ``collapse_runs`` for each of some texts."""
    split = [(t or b"").split() for t in texts.to_pylist()]
    codes: dict[bytes, int] = {}
    numbers: list[int] = []
    for k, found in enumerate(split):
        numbers += [codes.setdefault(w, len(codes)) for w in found]
        numbers.append(-1 - k)
    ids, sizes = np.array(numbers, np.int64), np.array([len(s) + 1 for s in split], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    runs = find_runs(ids, sizes)
    edges = np.bincount(runs[:, 0] + runs[:, 2], minlength=len(ids)) - np.bincount(runs[:, 0] + runs[:, 1], minlength=len(ids))
    gone = np.cumsum(edges) > 0
    bounds = np.searchsorted(runs[:, 0], np.append(starts, ends[-1:]))
    runs[:, 0] -= np.repeat(starts, np.diff(bounds))
    kept = []
    for found, start, first, last in zip(split, starts, bounds[:-1], bounds[1:]):
        if last > first:
            found = [found[i] for i in np.flatnonzero(~gone[start : start + len(found)])]
        kept.append(b" ".join(found).decode("utf-8", "replace"))
    spans = pa.StructArray.from_arrays([pa.array(runs[:, i]) for i in range(3)], ["start", "length", "period"])
    listed = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), spans)
    return pa.StructArray.from_arrays([pa.array(sizes - 1), listed, pa.array(kept, pa.string())], ["n_words", "runs", "collapsed"])


def collapse_runs(docs: DataFrame, text: str = "text", out: str = "periodic") -> DataFrame:
    """Add a struct ``out``: ``n_words``, ``runs`` (start, length and period in words, from 0, by
    start and then period) and ``collapsed``, the words without those that any run repeats after
    its first period, joined by one space.

    Multi-scale minimizers: a run's window minima come again one period on, so each scale pairs a
    minimizer with the next equal one and extends the pair both ways on the words; periods of at
    most SHORT words are found by comparing at each lag. Whole texts, one pass, no shuffle. A
    worker holds a step of texts of about a megabyte, or one longer text at some fifteen times its
    size; work is n log n in a text's words, however repetitive.

    A null, empty or blank text has no words, no runs and an empty ``collapsed``. Runs may overlap;
    equal ones cannot occur. Repeated rows are treated alike, an empty table gives no rows, other
    columns stay as they are and a column that is already called ``out`` is replaced. Invalid UTF-8
    is read with replacement characters."""
    kind = f"struct<n_words: bigint, runs: array<{RUN}>, collapsed: string>"
    return appended(docs, out, kind, described, F.col(f"`{text}`").cast("binary"))
