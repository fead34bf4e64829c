"""A forest whose trees have vectors in their leaves: one fit for several outputs at once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from math import exp

from pyspark.sql import Column, DataFrame, functions as F

from stationflow.operators.learning import FEATURES, OUTPUTS, label_encoder, recursive_forecast
from stationflow.session import durable

#: Features are compared in millionths, outputs are summed in 1024ths: sums of whole numbers do not
#: depend on their order, so equal splits tie exactly and reruns agree.
FEATURE_UNITS, OUTPUT_UNITS = 1e6, 1024

#: A split has to beat its node by this share.
LEAST_GAIN = 1e-9


def poisson_steps(most: int = 8) -> list[float]:
    """The distribution function of a Poisson variable of mean 1, for drawing how often a tree sees
    a row."""
    terms = [exp(-1.0)]
    for k in range(1, most):
        terms.append(terms[-1] / k)
    return [sum(terms[: k + 1]) for k in range(most)]


def drawn(*parts: str) -> str:
    """SQL of a number in [0, 1) that only depends on the parts, which are SQL of texts."""
    return f"(conv(substring(md5(concat_ws(':', {', '.join(parts)})), 1, 8), 16, 10) / 4294967296D)"


def numbers(values: Sequence[float | int], kind: str) -> str:
    """SQL of a constant array; written as text, so that one literal carries it."""
    return f"cast(split('{','.join(map(repr, values))}', ',') as array<{kind}>)"


def units(value: str, size: float) -> str:
    return f"floor(cast({value} as double) * {float(size)}D + 0.5D)"


@dataclass
class VectorForest:
    """Trees over binned features: ``splits[tree, node]`` is (feature, last bin to the left), node n
    has the children 2n and 2n + 1, and ``totals[tree, node]`` is (rows, sums of all outputs)."""

    features: list[str]
    outputs: int
    trees: int
    depth: int
    bins: int
    low: list[float]
    high: list[float]
    splits: dict[tuple[int, int], tuple[int, int]] = field(default_factory=dict)
    totals: dict[tuple[int, int], tuple[int, list[int]]] = field(default_factory=dict)

    @property
    def _size(self) -> int:
        return 2 << self.depth

    # Expressions are SQL text: a forecast of seven days applies two forests a day, and text is
    # parsed at once where columns would be put together call by call.

    def codes(self) -> str:
        """Bin numbers of all features; values outside of the fitted range fall in the outer bins."""
        found = []
        for name, low, high in zip(self.features, self.low, self.high):
            share = f"(cast({units(f'`{name}`', FEATURE_UNITS)} as double) - ({low!r}D)) / ({high - low!r}D)"
            found.append(f"greatest(0, least({self.bins - 1}, cast(floor({share} * {self.bins}) as int)))" if high > low else "0")
        return f"array({', '.join(found)})"

    def nodes(self, codes: str, levels: int) -> str:
        """The node of each tree that a row reaches within so many levels."""
        trees = f"sequence(0, {self.trees - 1})"
        if levels == 0 or not self.splits:
            return f"transform({trees}, tree -> 1)"
        chosen = [self.splits.get(divmod(i, self._size), (-1, 0)) for i in range(self.trees * self._size)]
        feature, last = (f"get({numbers([c[k] for c in chosen], 'int')}, tree * {self._size} + node)" for k in (0, 1))
        step = f"if({feature} < 0, node, 2 * node + if(get({codes}, {feature}) > {last}, 1, 0))"
        return f"transform({trees}, tree -> aggregate(sequence(1, {levels}), 1, (node, level) -> {step}))"

    def predict(self, df: DataFrame, out: str) -> DataFrame:
        """Add the array ``out`` of all outputs: the mean over the trees of their leaves' means."""
        means = []
        for k in range(self.outputs):
            known = (self.totals.get(divmod(i, self._size)) for i in range(self.trees * self._size))
            values = numbers([t[1][k] / t[0] / OUTPUT_UNITS if t else 0.0 for t in known], "double")
            leaves = f"transform(_leaves, (node, tree) -> get({values}, tree * {self._size} + node))"
            means.append(f"aggregate({leaves}, 0D, (a, x) -> a + x) / {self.trees}D")
        reached = df.selectExpr("*", f"{self.codes()} as _codes").selectExpr("*", f"{self.nodes('_codes', self.depth)} as _leaves")
        return reached.selectExpr(*[f"`{c}`" for c in df.columns], f"array({', '.join(means)}) as `{out}`")


def fit_vector_forest(
    rows: DataFrame, features: Sequence[str], outputs: Sequence[Column], key: Column,
    trees: int = 10, depth: int = 4, bins: int = 64, min_rows: int = 5, share: float = 0.5, seed: int = 42,
) -> VectorForest:
    """Fit trees that split for all outputs together.

    A split is worth the sum over outputs of what it takes from their variance, each in units of the
    output's variance over all rows. One aggregation a level counts and sums the outputs by tree,
    node, feature and bin; at most trees x 2^level x features x bins rows leave it whatever the
    number of rows, windows over the bins of a feature find the best split, and one row a node
    reaches the driver. Rows are drawn by a hash of ``key`` (a Poisson number of times a tree), and
    a node considers a hashed ``share`` of the features, so a fit can be repeated. Of equal splits
    the first feature and bin wins. Null features or outputs are an error."""
    features = list(features)
    measured = rows.select(key.alias("_key"), *features, *[F.floor(y.cast("double") * float(OUTPUT_UNITS) + 0.5).cast("long").alias(f"_y{k}") for k, y in enumerate(outputs)])
    ys = [F.col(f"_y{k}") for k in range(len(outputs))]
    ends = [F.expr(f"{f}(cast({units(f'`{c}`', FEATURE_UNITS)} as double))") for c in features for f in ("min", "max")]
    wide = lambda y: y.cast("decimal(19,0)")
    whole = measured.agg(F.count("*"), *ends, *[f for y in ys for f in (F.sum(wide(y)), F.sum(wide(y) * wide(y)))]).first()
    count, whole = whole[0], whole[1:]
    if not count:
        raise ValueError("there are no rows to fit a forest on")
    low, high = list(whole[0 : 2 * len(features) : 2]), list(whole[1 : 2 * len(features) : 2])
    sums = [int(x) for x in whole[2 * len(features) :]]
    spread = [count * s2 - s * s for s, s2 in zip(sums[::2], sums[1::2])]
    weight = [float(count * count) / float(v) if v else 0.0 for v in spread]
    forest = VectorForest(features, len(outputs), trees, depth, bins, low, high)

    chance = drawn(f"'{seed}'", "'row'", "cast(tree as string)", "cast(_key as string)")
    steps = ", ".join(f"{c!r}D" for c in poisson_steps())
    times = f"transform(transform(sequence(0, {trees - 1}), tree -> {chance}), u -> size(filter(array({steps}), c -> u >= c)))"
    binned = measured.select(F.expr(forest.codes()).alias("codes"), F.expr(times).alias("times"), F.array(*ys).alias("y"))
    binned = durable(binned, "forest-rows")

    names = [f"s{k}" for k in range(len(outputs))]
    total = ["sum(w) as n", *[f"sum(w * y[{k}]) as {s}" for k, s in enumerate(names)]]
    for level in range(depth + 1):
        placed = binned.selectExpr("codes", "y", "times", f"posexplode({forest.nodes('codes', level)}) as (tree, node)")
        placed = placed.selectExpr("codes", "y", "tree", "node", "times[tree] as w").where(f"w > 0 and node >= {1 << level}")
        if level == depth:
            found = placed.groupBy("tree", "node").agg(*map(F.expr, total)).withColumn("best", F.lit(None).cast("struct<feature: int, bin: int>"))
        else:
            spots = placed.selectExpr("tree", "node", "w", "y", "posexplode(codes) as (feature, bin)")
            found = _best_splits(spots.groupBy("tree", "node", "feature", "bin").agg(*map(F.expr, total)), names, weight, min_rows, share, seed)
        for row in found.collect():  # a row for each node of this level
            at = row["tree"], row["node"]
            forest.totals[at] = row["n"], [row[s] for s in names]
            if row["best"]:
                forest.splits[at] = -row["best"]["feature"], -row["best"]["bin"]
    return forest


def _best_splits(histogram: DataFrame, names: list[str], weight: list[float], min_rows: int, share: float, seed: int) -> DataFrame:
    """Each node's totals and its best split, with feature and bin negated so that the first wins."""
    alone = "partition by tree, node, feature"
    columns = ["n", *names]
    sides = histogram.selectExpr(
        "tree", "node", "feature", "bin",
        *[f"sum({c}) over ({alone} order by bin rows unbounded preceding) as l_{c}" for c in columns],
        *[f"sum({c}) over ({alone}) as t_{c}" for c in columns],
    )
    sides = sides.selectExpr("*", *[f"t_{c} - l_{c} as r_{c}" for c in columns])
    square = lambda side, s: f"cast({side}_{s} as double) * cast({side}_{s} as double) / {side}_n"
    gain = " + ".join(f"{w!r}D * ({square('l', s)} + {square('r', s)})" for s, w in zip(names, weight))
    base = " + ".join(f"{w!r}D * ({square('t', s)})" for s, w in zip(names, weight))
    asked = drawn(f"'{seed}'", "'split'", *(f"cast({c} as string)" for c in ("tree", "node", "feature"))) + f" < {float(share)}D"
    rated = sides.selectExpr("*", f"case when l_n >= {min_rows} and r_n >= {min_rows} and {asked} then {gain} end as gain", f"{base} as base")
    better = f"case when gain > base * {1 + LEAST_GAIN!r}D then struct(gain, -feature as feature, -bin as bin) end"
    return rated.groupBy("tree", "node").agg(*[F.expr(f"first(t_{c}) as {c}") for c in columns], F.expr(f"max({better}) as best"))


@dataclass
class VectorForecaster:
    """One forest for all eight outputs, and one over the outputs whose own outputs are the shares of
    the condition labels; everything it does is a built-in expression."""

    regions: object
    regressor: VectorForest
    classifier: VectorForest
    labels: list[str]

    def encode(self, df: DataFrame) -> DataFrame:
        return self.regions.transform(df)

    def regress(self, df: DataFrame) -> DataFrame:
        found = self.regressor.predict(df, "_found")
        return found.selectExpr(*[f"`{c}`" for c in df.columns], *[f"_found[{k}] as {out}" for k, out in enumerate(OUTPUTS)])

    def step(self, df: DataFrame) -> DataFrame:
        known = self.regress(df)
        shares = self.classifier.predict(known, "_shares").withColumn("_labels", F.array(*map(F.lit, self.labels)))
        named = "get(_labels, cast(array_position(_shares, array_max(_shares)) - 1 as int)) as predicted_condition"
        return shares.selectExpr(*[f"`{c}`" for c in known.columns], named)

    def forecast(self, features: DataFrame, horizon: int = 7) -> DataFrame:
        return recursive_forecast(self.encode(features), self.step, horizon)


def fit_multi_output(
    training: DataFrame, regions: DataFrame | None = None, trees: int = 10, depth: int = 4, seed: int = 42, **options: float
) -> VectorForecaster:
    """Fit on ``training_table`` rows: one regression fit for all outputs, one for the conditions.

    Region codes come from ``regions``, the dimension, which also has regions without history; from
    the training rows if not given."""
    training = durable(training, "training")
    encoder = label_encoder(training if regions is None else regions, "region", "region_enc")
    rows = encoder.transform(training)
    key = F.concat_ws("|", "province_id", "weather_date")
    regressor = fit_vector_forest(rows, FEATURES, [F.col(c) for c in OUTPUTS], key, trees, depth, seed=seed, **options)
    labels = sorted(r[0] for r in training.select("condition").distinct().collect())  # a handful of conditions
    hits = [(F.col("condition") == label).cast("int") for label in labels]
    classifier = fit_vector_forest(rows, [*OUTPUTS, "region_enc"], hits, key, trees, depth, seed=seed + 1, **options)
    return VectorForecaster(encoder, regressor, classifier, labels)
