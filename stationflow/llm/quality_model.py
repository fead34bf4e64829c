"""Quality scores without labels: overlapping heuristics vote, expectation-maximisation weighs the
votes, and a hashed linear scorer learns their posterior."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from stationflow.llm.common import SPACES, U64, hashed_words, in_small_batches, let, mix, steps, unit, utf8, wider, words
from stationflow.llm.quality_rules import STOP_WORDS

BUCKET_BITS = 14
#: Neutral features that count in every mean: a short text stays near the base rate.
NEUTRAL = 8
ODD = "#*$%&|<>{}=\\~^_"


@dataclass(frozen=True)
class Labeller:
    """Votes 1 (good) where ``good`` holds, 0 (bad) where ``bad`` holds, else abstains. Both are SQL
    expressions of the measures below."""

    name: str
    good: str
    bad: str


#: Each labeller knows one side of a text, and they overlap: what one calls bad, others see too.
#: Most only know bad texts; a text that nobody calls bad is judged by those that know good ones.
LABELLERS = (
    Labeller("symbols", "false", "try_divide(n_symbols, n_words) > 0.1"),
    Labeller("odd_words", "false", "try_divide(n_odd, n_words) > 0.1"),
    Labeller("exclamations", "false", "try_divide(n_exclaims, n_words) > 0.2"),
    Labeller("capitals", "false", "try_divide(n_capitals, n_chars) > 0.2"),
    Labeller("variety", "false", "n_words >= 20 and try_divide(n_different, n_words) < 0.5 and n_different < 30"),
    Labeller("runs", "false", "try_divide(n_runs, n_words) > 0.1"),
    Labeller("word_length", "false", "try_divide(n_chars, n_words) not between 2 and 14"),
    Labeller("stop_words", "try_divide(n_stop_words, n_words) > 0.1", "n_words >= 10 and try_divide(n_stop_words, n_words) < 0.03"),
    Labeller("sentences", "try_divide(n_ends, n_words) >= 0.02", "n_words >= 40 and n_ends = 0"),
)


def measured(text: Column) -> Column:
    """What the labellers look at, as a struct; a null text is empty."""
    text = F.coalesce(text, F.lit(""))
    number = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
    fewer = lambda chars: (F.length(text) - F.length(F.translate(text, chars, ""))).cast("double")
    stops = sorted(set(STOP_WORDS))

    def of(found: Column) -> Column:
        return F.struct(
            F.size(found).cast("double").alias("n_words"),
            F.length(F.translate(text, SPACES, "")).cast("double").alias("n_chars"),
            fewer(ODD).alias("n_symbols"),
            fewer("!").alias("n_exclaims"),
            number(r"\p{Lu}").alias("n_capitals"),
            F.size(F.array_distinct(found)).cast("double").alias("n_different"),
            F.size(F.filter(found, lambda w: F.length(F.translate(w, ODD, "")) < F.length(w))).cast("double").alias("n_odd"),
            F.size(F.filter(found, lambda w: w.isin(*stops))).cast("double").alias("n_stop_words"),
            F.size(F.filter(found, lambda w: w.endswith(".") | w.endswith("?"))).cast("double").alias("n_ends"),
            F.size(F.filter(found, lambda w, k: F.get(found, k + 1) == w)).cast("double").alias("n_runs"),
        )

    return let(words(F.lower(text)), of)


def votes(docs: DataFrame, doc_id: Column, text: Column, labellers: Sequence[Labeller] = LABELLERS) -> DataFrame:
    """``doc_id, votes``: 1, 0 or -1 (abstains; so does whatever a text without words leaves
    undefined) of each labeller. One projection."""
    rows = docs.select(doc_id.alias("doc_id"), measured(text).alias("_m")).select("doc_id", "_m.*")
    vote = lambda x: F.when(F.expr(x.bad), 0).when(F.expr(x.good), 1).otherwise(-1)
    return rows.select("doc_id", F.array(*[vote(x) for x in labellers]).alias("votes"))


@dataclass(frozen=True)
class LabelModel:
    """``prior`` of good, and for each labeller the chance of its votes (bad, good, abstains) given
    a bad and a good text: ``chance[labeller, truth, vote]``."""

    prior: float
    chance: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        logs = np.log(self.chance)
        good, bad = np.log(self.prior), np.log1p(-self.prior)
        for k in range(patterns.shape[1]):
            bad, good = bad + logs[k, 0, patterns[:, k]], good + logs[k, 1, patterns[:, k]]
        return 1 / (1 + np.exp(np.clip(bad - good, -500, 500)))

    def accuracy(self) -> np.ndarray:
        """Of each labeller, where it doesn't abstain."""
        right = (1 - self.prior) * self.chance[:, 0, 0] + self.prior * self.chance[:, 1, 1]
        wrong = (1 - self.prior) * self.chance[:, 0, 1] + self.prior * self.chance[:, 1, 0]
        return right / (right + wrong)


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100, smooth: float = 1.0) -> LabelModel:
    """Fit the label model to all texts' votes, given as different patterns (votes -1, 0, 1) and how
    often each occurs. It starts from labellers that rarely call a good text bad, which settles which of
    the two classes is the good one."""
    patterns = np.where(patterns < 0, 2, patterns)
    labellers = patterns.shape[1]
    model = LabelModel(0.9, np.tile(np.array([[0.3, 0.1, 0.6], [0.003, 0.4, 0.597]]), (labellers, 1, 1)))
    for _ in range(rounds if len(patterns) else 0):
        good = model.posterior(patterns)
        chance = np.empty((labellers, 2, 3))
        for truth, weight in enumerate((counts * (1 - good), counts * good)):
            for k in range(labellers):
                chance[k, truth] = np.bincount(patterns[:, k], weight, minlength=3) + smooth
        chance /= chance.sum(axis=2, keepdims=True)
        prior = float((counts @ good + smooth) / (counts.sum() + 2 * smooth))
        moved = abs(prior - model.prior) + np.abs(chance - model.chance).max()
        model = LabelModel(prior, chance)
        if moved < 1e-9:
            break
    return model


def label_model(voted: DataFrame) -> LabelModel:
    """From all rows: only the different patterns of votes, at most 3^labellers, reach the driver. Of
    no rows comes what it starts from."""
    found = sorted(voted.groupBy("votes").count().collect(), key=lambda r: r["votes"])
    patterns = np.array([r["votes"] for r in found], int).reshape(len(found), len(LABELLERS))
    return expectation_maximisation(patterns, np.array([r["count"] for r in found], float))


def features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each text's words, of their shapes (letters, capitals, digits, others, with repeats
    joined) and of words that repeat the one before them, and each one's text."""
    found, before = hashed_words(data, bounds)
    kind = np.full(256, 9, np.uint8)
    kind[97:123], kind[65:91], kind[48:58], kind[128:] = 1, 2, 3, 1
    kind[33:48] = np.arange(10, 25)
    kind[[32, 9, 10, 11, 12, 13]] = 32
    shape = kind[data]
    fresh = np.concatenate([[True], shape[1:] != shape[:-1]]) if len(shape) else np.zeros(0, bool)
    kept = np.concatenate([[0], np.cumsum(fresh)])
    shapes, also = hashed_words(np.where(shape[fresh] == 32, 32, shape[fresh] + 32).astype(np.uint8), kept[bounds])
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(before))
    owners = np.repeat(np.arange(len(bounds) - 1), np.diff(also))
    again = np.flatnonzero((found[1:] == found[:-1]) & (owner[1:] == owner[:-1])) + 1 if len(found) else np.zeros(0, int)
    hashes = [found, mix(shapes ^ U64(0xABCDEF)), np.zeros(len(again), U64)]
    return (np.concatenate(hashes) >> U64(64 - BUCKET_BITS)).astype(np.int32), np.concatenate([owner, owners, owner[again]])


@dataclass(frozen=True)
class Scorer:
    """A linear scorer of the mean of hashed features and some neutral ones."""

    weights: np.ndarray
    bias: float

    def score(self, buckets: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
        number = np.bincount(owner, minlength=texts) + NEUTRAL
        return 1 / (1 + np.exp(-np.clip(np.bincount(owner, self.weights[buckets], minlength=texts) / number + self.bias, -50, 50)))


def fit_scorer(texts: list[str], target: np.ndarray, epochs: int = 40, rate: float = 4.0, seed: int = 3) -> Scorer:
    """Logistic regression on the posterior labels by adaptive gradient descent."""
    rows = [np.unique(features(*utf8(pa.array([t], pa.large_string())))[0], return_counts=True) for t in texts]
    weights, scale, bias = np.zeros(1 << BUCKET_BITS), np.full(1 << BUCKET_BITS, 1e-8), 0.0
    rng = np.random.default_rng(seed)
    for epoch in range(epochs if rows else 0):
        for part in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // 64)):
            ids = np.concatenate([rows[i][0] for i in part])
            share = np.concatenate([rows[i][1] / (rows[i][1].sum() + NEUTRAL) for i in part])
            of = np.repeat(np.arange(len(part)), [len(rows[i][0]) for i in part])
            error = 1 / (1 + np.exp(-(np.bincount(of, weights[ids] * share, minlength=len(part)) + bias))) - target[part]
            slope = np.bincount(ids, share * error[of], minlength=len(weights)) / len(part)
            scale += slope * slope
            weights -= rate * (1 - epoch / epochs) * slope / np.sqrt(scale)
            bias -= 0.5 * (1 - epoch / epochs) * float(error.mean())
    return Scorer(weights, bias)


def fit_on(docs: DataFrame, doc_id: Column, text: Column, sample: int = 4000, seed: int = 3) -> tuple[LabelModel, Scorer]:
    """The label model sees the votes on all texts; the scorer is fitted on ``sample`` of them, by a
    hash of the id, which go to the driver with their posterior labels."""
    model = label_model(votes(docs, doc_id, text))
    drawn = docs.select(text.alias("text"), F.xxhash64(F.lit(seed), doc_id).alias("_h"), F.xxhash64(text).alias("_t")).where("text is not null")
    # Only about twice as many rows as are wanted leave their tasks, however large the table.
    chance = unit(F.col("_h"), F.col("_t"))
    drawn = drawn.where(chance * drawn.count() < 2 * sample).orderBy(chance, "_h", "_t").limit(sample)
    rows = votes(drawn, F.col("text"), F.col("text")).collect()
    rows.sort(key=lambda r: r["doc_id"])
    cast = np.array([r["votes"] for r in rows], int).reshape(len(rows), len(LABELLERS))
    return model, fit_scorer([r["doc_id"] for r in rows], model.posterior(np.where(cast < 0, 2, cast)))


def score_quality(docs: DataFrame, text: str, scorer: Scorer, out: str = "quality_score") -> DataFrame:
    """Add ``out``, 0 to 1: the scorer's chance that the whole text is good. A null text is empty;
    an empty one has the scorer's base rate. A column of that name is replaced."""
    rows = docs.drop(out)
    place, names = rows.columns.index(text), [*rows.columns, out]
    shared = docs.sparkSession.sparkContext.broadcast(scorer)  # 2^14 numbers

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, names[place]):
                column = pc.fill_null(part.column(place), "").cast(pa.large_string())
                scores = shared.value.score(*features(*utf8(column)), part.num_rows)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores)], names)

    return in_small_batches(rows).mapInArrow(scored, wider(rows.schema, **{out: "double"}))
