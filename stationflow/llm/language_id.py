"""Language identification by averaged hashed subword embeddings and a linear softmax."""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from stationflow.llm.common import U64, in_small_batches, mix, steps, unit, utf8, wider

#: Lengths, in bytes, of the subwords; a word's ends count as one byte each.
GRAMS = (2, 3, 4, 5)
BUCKET_BITS = 15
#: The same hash to more bits says which longer subwords a language's training texts held.
SEEN_BITS, LONG_GRAM = 18, 4
#: Neutral subwords that count in every mean: a text of few subwords gets an undecided score.
NEUTRAL = 8

#: The share of seen subwords that a text without any is granted.
DOUBT = 0.75

_SEPARATES = np.ones(256, bool)
_SEPARATES[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False


def subwords(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes of SEEN_BITS bits of all subwords of lower-cased texts from ``utf8``, each one's text, and
    where those of at least LONG_GRAM bytes begin. A subword is 2 to 5 bytes of one word; bytes other
    than letters separate words and stand for their ends."""
    apart = _SEPARATES[data]
    plain = np.where(apart, np.uint8(32), data).astype(U64)
    inner = np.concatenate([[0], np.cumsum(apart)])  # separators before each byte
    owner = np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(bounds))
    found, of, short = [], [], 0
    for n in GRAMS:
        size = len(data) - n + 1
        if size < 1:
            continue
        code = np.full(size, U64(n))
        for k in range(n):
            code = (code << U64(8)) | plain[k : k + size]
        # No separator inside, and a letter somewhere.
        whole = inner[n - 1 : n - 1 + size] == inner[1 : size + 1]
        whole &= ~(apart[:size] & apart[n - 1 :]) if n == 2 else whole
        whole &= owner[:size] == owner[n - 1 :]
        at = np.flatnonzero(whole)
        found.append((mix(code[at]) >> U64(64 - SEEN_BITS)).astype(np.int32))
        of.append(owner[at])
        short += len(at) if n < LONG_GRAM else 0
    if not found:
        return np.zeros(0, np.int32), np.zeros(0, np.int32), 0
    return np.concatenate(found), np.concatenate(of), short


@dataclass(frozen=True)
class LanguageModel:
    """``table``: for each bucket its embedding times the softmax weights, so that a text's logits
    are the mean of its subwords' rows (and of some neutral ones). ``seen``: for each longer subword
    the languages, as bits, whose training texts held it. ``accept``: the weights that turn the share
    of seen subwords and the log odds of the softmax into the chance that the text is in the
    language at all; below ``least`` a prediction is rejected. ``kept`` and ``caught`` are the shares
    of right texts kept and of negatives rejected in calibration."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    seen: np.ndarray
    accept: np.ndarray
    least: float
    kept: float = 1.0
    caught: float = 0.0

    def logits(self, hashes: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
        buckets = hashes >> (SEEN_BITS - BUCKET_BITS)
        number = np.bincount(owner, minlength=texts)[:, None] + NEUTRAL
        sums = [np.bincount(owner, self.table[buckets, k], minlength=texts) for k in range(self.table.shape[1])]
        return np.stack(sums, axis=1) / number + self.bias

    def coverage(self, hashes: np.ndarray, owner: np.ndarray, short: int, best: np.ndarray) -> np.ndarray:
        """The share of each text's longer subwords that its predicted language was seen to hold. A few
        count in of which DOUBT are seen, so that a text of a word or two is not rejected for that."""
        hashes, owner = hashes[short:], owner[short:]
        word, bit = np.divmod(best[owner], 64)
        hits = (self.seen[word, hashes] >> bit.astype(U64)) & U64(1)
        texts = len(best)
        return (np.bincount(owner, hits.astype(float), minlength=texts) + NEUTRAL * DOUBT) / (np.bincount(owner, minlength=texts) + NEUTRAL)

    def judged(self, hashes: np.ndarray, owner: np.ndarray, short: int, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Predicted language, its score, and what acceptance depends on."""
        scores = _softmax(self.logits(hashes, owner, texts) / self.temperature)
        best = scores.argmax(axis=1)
        return best, scores.max(axis=1), self.evidence(hashes, owner, short, scores, best)

    def evidence(self, hashes: np.ndarray, owner: np.ndarray, short: int, scores: np.ndarray, best: np.ndarray) -> np.ndarray:
        top = scores.max(axis=1)
        odds = np.log(np.maximum(top, 1e-9)) - np.log(np.maximum(1 - top, 1e-9))
        return np.stack([np.ones(len(top)), self.coverage(hashes, owner, short, best), odds], axis=1)

    def chance(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-evidence @ self.accept))


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-5, rounds: int = 30) -> np.ndarray:
    """Weights of a logistic regression by Newton steps, both classes of the same weight."""
    w = np.zeros(x.shape[1])
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (share * (p - y)) + ridge * w
        curve = (x * (share * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w - np.linalg.solve(curve, slope)
    return w


# Where the lower-case letters of some other scripts begin.
SCRIPTS = (0x3B1, 0x430, 0x561, 0x5D0, 0x627, 0x905, 0x10D0, 0x3042)


def negatives(texts: list[str], rng: np.random.Generator) -> list[str]:
    """Texts of no language, made of texts: each once with the letters of every word shuffled, once
    with its letters replaced by those of another script."""
    out = []
    for text in texts:
        out.append(" ".join("".join(rng.permutation(list(w))) for w in text.split()))
        script = int(rng.choice(SCRIPTS))
        out.append("".join(chr(script + ord(c) % 26) if c.isalpha() else c for c in text.lower()))
    return out


def labelled_sample(docs: DataFrame, doc_id: Column, text: Column, lang: Column, per_language: int, seed: int) -> DataFrame:
    """At most ``per_language`` rows of each language, by a hash of the id; rows without a text or
    language are left out. By their languages' counts, only about four times as many rows as are
    wanted leave their tasks, however large the table."""
    rows = docs.select(text.alias("text"), lang.alias("lang"), F.xxhash64(F.lit(seed), doc_id).alias("_h"), F.xxhash64(text).alias("_t"))
    rows = rows.where("text is not null and lang is not null")
    counts = rows.groupBy("lang").agg(F.count("*").alias("_all"))  # a row for each language of the model
    near = unit(F.col("_h"), F.col("_t")) * F.col("_all") < 4 * per_language
    first = F.row_number().over(Window.partitionBy("lang").orderBy(unit(F.col("_h"), F.col("_t")), "_h", "_t"))
    return rows.join(F.broadcast(counts), "lang").where(near).withColumn("_n", first).where(F.col("_n") <= per_language).select("text", "lang")


def fit(texts: list[str], langs: list[str], dim: int = 16, epochs: int = 12, rate: float = 0.5, batch: int = 32, seed: int = 5, keep: float = 0.999, catch: float = 0.95, margin: float = 4.0) -> LanguageModel:
    """Stochastic gradient descent in numpy on whole texts; without any, every text is ``und``.

    A fifth of the texts is held back (a language whose texts would all be is learned from them
    too). On them, and on fragments of four words of them, as short texts are the hard ones,
    the temperature is fitted, to targets a little below certainty so that it has a finite best
    value. Rejection is calibrated against negatives made of the same texts: shuffled letters,
    other scripts, and each language in turn as one that is not known. The chance that is asked for
    is what ``catch`` of the negatives fail, but never more than what ``keep`` of the right
    predictions pass with ``margin`` log odds to spare, nor than one half: clean texts come first."""
    languages = sorted(set(langs))
    if not languages:
        return LanguageModel([], np.zeros((1 << BUCKET_BITS, 1)), np.zeros(1), 1.0, np.zeros((1, 1 << SEEN_BITS), U64), np.zeros(3), 0.0)
    order = np.random.default_rng(seed).permutation(len(texts))
    target = np.array([languages.index(x) for x in langs])[order]
    # Each text's different buckets, their shares and its longer subwords, one text after the other in
    # flat arrays: freed ones go back to the system, many small ones would not.
    buckets, shares, longer = array("i"), array("d"), array("i")
    grams, seens = [0], [0]
    for i in order:
        data, bounds = utf8(pa.array([texts[i].lower()], pa.large_string()))
        hashes, _, short = subwords(data, bounds)
        found, count = np.unique(hashes >> (SEEN_BITS - BUCKET_BITS), return_counts=True)
        buckets.frombytes(found.astype(np.int32).tobytes())
        shares.frombytes((count / (count.sum() + NEUTRAL)).tobytes())
        longer.frombytes(np.unique(hashes[short:]).tobytes())
        grams.append(len(buckets))
        seens.append(len(longer))
    buckets, shares, longer = np.asarray(buckets), np.asarray(shares), np.asarray(longer)
    held = max(1, len(texts) // 5)
    alone = ~np.isin(target[:held], target[held:])
    train = np.concatenate([np.flatnonzero(alone), np.arange(held, len(texts))])
    rng = np.random.default_rng(seed + 1)
    embed = rng.normal(0, 1.0 / dim, (1 << BUCKET_BITS, dim))
    out, bias = np.zeros((dim, len(languages))), np.zeros(len(languages))
    for epoch in range(epochs):
        rng.shuffle(train)
        step = rate * (1 - epoch / epochs)
        for at in range(0, len(train), batch):
            part = train[at : at + batch]
            ids = np.concatenate([buckets[grams[i] : grams[i + 1]] for i in part])
            share = np.concatenate([shares[grams[i] : grams[i + 1]] for i in part])
            row = np.repeat(np.arange(len(part)), [grams[i + 1] - grams[i] for i in part])
            hidden = np.stack([np.bincount(row, embed[ids, d] * share, minlength=len(part)) for d in range(dim)], axis=1)
            error = _softmax(hidden @ out + bias)
            error[np.arange(len(part)), target[part]] -= 1
            back = error @ out.T
            out -= step * hidden.T @ error
            bias -= step * error.mean(axis=0)
            np.subtract.at(embed, ids, (step * 8) * share[:, None] * back[row])
    seen = np.zeros((-(-len(languages) // 64), 1 << SEEN_BITS), U64)
    for i in train:
        word, bit = divmod(int(target[i]), 64)
        seen[word, longer[seens[i] : seens[i + 1]]] |= U64(1 << bit)
    model = LanguageModel(languages, (embed @ out).astype(np.float64), bias, 1.0, seen, np.zeros(3), 0.0)

    checked = [texts[i] for i in order[:held]]
    for i in range(held):
        found = checked[i].split()
        at = int(rng.integers(0, max(1, len(found) - 3)))
        checked.append(" ".join(found[at : at + 4]))
    answer = np.concatenate([target[:held], target[:held]])
    logits = np.concatenate([model.logits(*found[:2], n) for *found, n in _parts(checked)])
    model = replace(model, temperature=fitted_temperature(logits, answer))
    good, bad, done = [], [], 0
    for hashes, owner, short, n in _parts(checked):
        scores, own = logits[done : done + n] / model.temperature, answer[done : done + n]
        best = scores.argmax(axis=1)
        good.append((model.evidence(hashes, owner, short, _softmax(scores), best), best == own))
        if len(languages) > 1:
            scores[np.arange(n), own] = -np.inf
            bad.append(model.evidence(hashes, owner, short, _softmax(scores), scores.argmax(axis=1)))
        done += n
    for hashes, owner, short, n in _parts(negatives(checked, rng)):
        bad.append(model.judged(hashes, owner, short, n)[2])
    good, right = (np.concatenate(x) for x in zip(*good))
    good, bad = good[right] if right.any() else good, np.concatenate(bad)  # of so few that none is right, all count
    weights = logistic(np.concatenate([good, bad]), np.concatenate([np.ones(len(good)), np.zeros(len(bad))]))
    model = replace(model, accept=weights)
    passed, failed = float(np.quantile(good @ weights, 1 - keep)), float(np.quantile(bad @ weights, catch))
    least = float(1 / (1 + np.exp(-min(0.0, passed - margin, failed))))
    return replace(model, least=least, kept=float(np.mean(model.chance(good) >= least)), caught=float(np.mean(model.chance(bad) < least)))


def _parts(texts: list[str], budget: int = 1 << 17) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """``subwords`` and the number of texts of one slice after the other."""
    batch = pa.record_batch([pa.array([t.lower() for t in texts], pa.string())], ["text"])
    for part in steps(batch, budget=budget):
        yield *subwords(*utf8(part.column(0))), part.num_rows


TEMPERATURES = np.geomspace(0.002, 20, 120)


def fitted_temperature(logits: np.ndarray, answer: np.ndarray) -> float:
    """The temperature under which the answers are likeliest, an answer being held for right with a
    chance of (n + 1) / (n + 2) only."""
    n, k = logits.shape
    wanted = np.full((n, k), 1 / (n + 2) / max(1, k - 1))
    wanted[np.arange(n), answer] = (n + 1) / (n + 2)
    return float(min(TEMPERATURES, key=lambda t: -(wanted * np.log(_softmax(logits / t) + 1e-300)).sum()))


def fit_on(docs: DataFrame, doc_id: Column, text: Column, lang: Column, per_language: int = 400, seed: int = 5) -> LanguageModel:
    """Fit on a bounded sample, ``per_language`` rows of each language, which goes to the driver."""
    rows = labelled_sample(docs, doc_id, text, lang, per_language, seed).collect()
    rows = sorted((r["lang"], zlib.crc32(r["text"].encode()), r["text"]) for r in rows)
    return fit([r[2] for r in rows], [r[0] for r in rows], seed=seed)


def identify(docs: DataFrame, text: str, model: LanguageModel, prefix: str = "lang_") -> DataFrame:
    """Add ``<prefix>pred`` (a learned language; ``und`` for a null text or one without a letter),
    ``<prefix>score`` (0 to 1; 0 for und) and ``<prefix>rejected``: und, or a text that is unlikely to
    be in the predicted language at all. Whole texts, one narrow pass; other columns stay, but for
    those of the same names, which are replaced. Ties go to the first language by code point.
    Repeated rows are treated alike, an empty table gives no rows; a text of few letters is judged
    as undecided, by what little it has."""
    added = [prefix + n for n in ("pred", "score", "rejected")]
    rows = docs.drop(*added)
    place, names = rows.columns.index(text), [*rows.columns, *added]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2^15 buckets x languages

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part in steps(batch, names[place], 1 << 17):
                column = pc.fill_null(part.column(place), "")
                letters = np.asarray(pc.match_substring_regex(column, r"\p{L}").cast(pa.uint8())).astype(bool) & bool(known.languages)
                hashes, owner, short = subwords(*utf8(pc.utf8_lower(column.cast(pa.large_string()))))
                best, top, evidence = known.judged(hashes, owner, short, part.num_rows)
                top = np.where(letters, top, 0.0)
                named = pa.array(known.languages + ["und"]).take(pa.array(np.where(letters, best, len(known.languages))))
                arrays = [*part.columns, named, pa.array(top), pa.array(~letters | (known.chance(evidence) < known.least))]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return in_small_batches(rows).mapInArrow(predicted, wider(rows.schema, **dict(zip(added, ("string", "double", "boolean")))))
