"""Metrics over declared semantic models, as groupBy/agg plans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


@dataclass(frozen=True)
class Entity:
    name: str
    kind: str  # primary or foreign
    expr: str


@dataclass(frozen=True)
class Dimension:
    name: str
    kind: str  # categorical or time
    expr: str | None = None
    grain: str = "day"


@dataclass(frozen=True)
class Measure:
    name: str
    agg: str  # average, max, min, sum or count
    expr: str | None = None


@dataclass(frozen=True)
class SemanticModel:
    """Entities, dimensions and measures of one table."""

    name: str
    entities: tuple[Entity, ...] = ()
    dimensions: tuple[Dimension, ...] = ()
    measures: tuple[Measure, ...] = ()
    time_dimension: str | None = None
    primary_entity: str | None = None

    def entity(self, name: str) -> Entity | None:
        return next((e for e in self.entities if e.name == name), None)

    def dimension(self, name: str) -> Dimension | None:
        return next((d for d in self.dimensions if d.name == name), None)

    def measure(self, name: str) -> Measure | None:
        return next((m for m in self.measures if m.name == name), None)


@dataclass(frozen=True)
class Metric:
    """``simple``: one measure; ``ratio``: numerator over denominator metric; ``derived``: a
    bundle of input metrics, or ``expr`` over them."""

    name: str
    kind: str = "simple"
    measure: str | None = None
    numerator: str | None = None
    denominator: str | None = None
    inputs: tuple[str, ...] = ()
    expr: str | None = None
    label: str = ""


@dataclass(frozen=True)
class SavedQuery:
    name: str
    metrics: tuple[str, ...]
    group_by: tuple[str, ...]


GRAINS = ("day", "week", "month", "quarter", "year")


class SemanticLayer:
    """Models, metrics and the tables they stand on."""

    def __init__(self, models: Sequence[SemanticModel], metrics: Sequence[Metric], tables: Mapping[str, DataFrame]):
        self.models = {m.name: m for m in models}
        self.metrics = {m.name: m for m in metrics}
        self.tables = tables

    def query(self, names: Sequence[str], group_by: Sequence[str] = (), where: str | None = None) -> DataFrame:
        """The metrics by the given dimensions, in one aggregation for each model they come from.

        A dimension is ``name``, ``entity__name`` (the dimension table is joined when the entity
        is foreign), ``metric_time``, or a time dimension with ``__month`` and the like appended.

        With measures of several models each model is aggregated alone and the results, at most one
        row a group and model, are full joined on the dimensions, a NULL equal to a NULL: no row is
        multiplied, and a group that one model lacks has NULL metrics of that model. Dimensions and
        ``where`` must be known to every model.
        """
        measures = list(dict.fromkeys(m for n in names for m in self._measures_of(n)))
        parts = [self._aggregated(model, held, group_by, where) for model, held in self._models_of(measures)]
        grouped = reduce(lambda a, b: self._joined_groups(a, b, group_by), parts)
        for name in names:
            grouped = self._with_metric(grouped, name)
        outputs = dict.fromkeys(out for n in names for out in self._outputs_of(n))
        return grouped.select(*group_by, *outputs)

    def _aggregated(self, model: SemanticModel, measures: Sequence[str], group_by: Sequence[str], where: str | None) -> DataFrame:
        df, keys = self._grouped(model, group_by)
        if where:
            df = df.where(where)
        outputs = [(m, self._aggregate(df, model.measure(m))) for m in measures]
        return df.groupBy(*[c.alias(k) for k, c in keys]).agg(*[c.alias(f"_{m}") for m, c in outputs])

    @staticmethod
    def _joined_groups(left: DataFrame, right: DataFrame, group_by: Sequence[str]) -> DataFrame:
        """Full join of two models' groups. Without dimensions each side is one row, joined by a constant."""
        on = list(group_by) or ["_one"]
        if not group_by:
            left, right = (df.withColumn("_one", F.lit(1)) for df in (left, right))
        right = right.withColumnsRenamed({c: f"_other_{c}" for c in on})
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_other_{c}")) for c in on])
        # A missing side's keys are NULL as a NULL group's are, so each side is marked.
        joined = left.withColumn("_here", F.lit(True)).join(right, same, "full")
        keys = [F.when(F.col("_here"), F.col(c)).otherwise(F.col(f"_other_{c}")).alias(c) for c in on]
        values = [c for c in [*left.columns, *right.columns] if c not in on and not c.startswith("_other_")]
        return joined.select(*keys, *values)

    def run_saved(self, saved: SavedQuery) -> DataFrame:
        return self.query(saved.metrics, saved.group_by)

    def _measures_of(self, name: str) -> list[str]:
        metric = self.metrics[name]
        if metric.kind == "simple":
            return [metric.measure]
        parts = [metric.numerator, metric.denominator] if metric.kind == "ratio" else metric.inputs
        return [m for part in parts for m in self._measures_of(part)]

    def _outputs_of(self, name: str) -> list[str]:
        """A derived metric without an expression stands for its inputs."""
        metric = self.metrics[name]
        return list(metric.inputs) if metric.kind == "derived" and not metric.expr else [name]

    def _with_metric(self, df: DataFrame, name: str) -> DataFrame:
        """Add the metric's column, after those of the metrics it is made of."""
        metric = self.metrics[name]
        if metric.kind == "simple":
            return df.withColumn(name, F.col(f"_{metric.measure}"))
        parts = [metric.numerator, metric.denominator] if metric.kind == "ratio" else metric.inputs
        for part in parts:
            df = self._with_metric(df, part)
        if metric.kind == "ratio":
            top, bottom = (F.col(p).cast("double") for p in parts)
            return df.withColumn(name, F.try_divide(top, bottom))
        return df.withColumn(name, F.expr(metric.expr)) if metric.expr else df

    def _models_of(self, measures: Sequence[str]) -> list[tuple[SemanticModel, list[str]]]:
        """The models to aggregate and what each gives: one that has all measures, if any has, else
        each measure's first model."""
        for model in self.models.values():
            if all(model.measure(m) for m in measures):
                return [(model, list(measures))]
        held: dict[str, list[str]] = {}
        for m in measures:
            owner = next((model.name for model in self.models.values() if model.measure(m)), None)
            if owner is None:
                raise ValueError(f"no model has the measure {m}")
            held.setdefault(owner, []).append(m)
        return [(self.models[name], ms) for name, ms in held.items()]

    def _aggregate(self, df: DataFrame, measure: Measure) -> Column:
        value = F.expr(measure.expr or measure.name)
        if measure.agg == "sum":
            kind = df.select(value.alias("v")).schema["v"].dataType
            return F.sum(value.cast("int") if isinstance(kind, T.BooleanType) else value)
        return {"average": F.avg, "max": F.max, "min": F.min, "count": F.count}[measure.agg](value)

    def _grouped(self, model: SemanticModel, group_by: Sequence[str]) -> tuple[DataFrame, list[tuple[str, Column]]]:
        df, keys, joined = self.tables[model.name], [], {}
        for name in group_by:
            path, grain = self._split_grain(name)
            entity_name, _, local = path.rpartition("__")
            if path == "metric_time":
                local, entity_name = model.time_dimension, ""
            if entity_name and entity_name != model.primary_entity and not self._is_own(model, entity_name):
                owner = self._owner(entity_name, local)
                prefix = f"_{entity_name}_"
                if entity_name not in joined:
                    df = self._join_entity(df, model, owner, entity_name, prefix)
                    joined[entity_name] = owner
                column = F.col(prefix + local)
                dimension = owner.dimension(local)
            else:
                dimension = model.dimension(local)
                if dimension is None:
                    raise KeyError(f"{model.name} has no dimension {local}")
                column = F.expr(dimension.expr or dimension.name)
            if dimension.kind == "time":
                column = F.to_date(F.date_trunc(grain or dimension.grain, column))
            keys.append((name, column))
        return df, keys

    @staticmethod
    def _split_grain(name: str) -> tuple[str, str | None]:
        head, _, last = name.rpartition("__")
        return (head, last) if head and last in GRAINS else (name, None)

    @staticmethod
    def _is_own(model: SemanticModel, entity_name: str) -> bool:
        entity = model.entity(entity_name)
        return entity is not None and entity.kind == "primary"

    def _owner(self, entity_name: str, dimension: str) -> SemanticModel:
        for model in self.models.values():
            entity = model.entity(entity_name)
            if entity is not None and entity.kind == "primary" and model.dimension(dimension):
                return model
        raise KeyError(f"no model has {dimension} with primary entity {entity_name}")

    def _join_entity(self, df: DataFrame, model: SemanticModel, owner: SemanticModel, name: str, prefix: str) -> DataFrame:
        """Left join the owner's dimensions; its entity is unique, so no row is multiplied."""
        key = F.expr(model.entity(name).expr)
        dims = self.tables[owner.name].select(
            F.expr(owner.entity(name).expr).alias(f"{prefix}key"),
            *[F.expr(d.expr or d.name).alias(prefix + d.name) for d in owner.dimensions],
        )
        return df.withColumn(f"{prefix}own", key).join(dims, F.col(f"{prefix}own") == F.col(f"{prefix}key"), "left")


def time_spine(spark: SparkSession, start: str = "2020-01-01", days: int = 5000) -> DataFrame:
    """Consecutive days, one row each."""
    return spark.range(days).select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("date_day"))


def fill_days(metric: DataFrame, spine: DataFrame, day: str, keys: DataFrame | None = None) -> DataFrame:
    """A metric by day with a row for every spine day, for each row of ``keys`` if given.

    Days of the metric that the spine lacks, and a NULL day, stay as they are: the spine adds rows
    and takes none away. ``keys`` is a short list of distinct group values; each gets its own copy
    of the spine by an exploded array of days, so no join without keys is needed.
    """
    if keys is None:
        return spine.withColumnRenamed("date_day", day).join(metric, day, "full")
    bounds = spine.agg(F.min("date_day").alias("_a"), F.max("date_day").alias("_b")).first()
    days = F.explode(F.sequence(F.lit(bounds["_a"]), F.lit(bounds["_b"]))).alias(day)
    on = [*keys.columns, day]
    spread = keys.select("*", days)
    held = metric.withColumnsRenamed({c: f"_m_{c}" for c in on})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_m_{c}")) for c in on])
    joined = spread.withColumn("_spread", F.lit(True)).join(held, same, "full")
    own = [F.when(F.col("_spread").isNotNull(), F.col(c)).otherwise(F.col(f"_m_{c}")).alias(c) for c in on]
    return joined.select(*own, *[c for c in metric.columns if c not in on])
