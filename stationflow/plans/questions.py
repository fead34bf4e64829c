"""Answering a table of questions by joins against the facts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stationflow.functions.scalar import as_date
from stationflow.functions.text import deletions, first_date, folded, word_runs, words
from stationflow.operators.relational import preview

FACT_COLUMNS = ["avg_temperature", "max_temperature", "min_temperature", "sum_precipitation", "avg_humidity", "condition"]


def extract_places(
    questions: DataFrame, places: DataFrame, name: str = "province_name", key: str = "question_id"
) -> DataFrame:
    """Each question with the longest place name in it, or NULL.

    Names are matched as runs of whole words by an equi-join, so that ``N_1`` is not found inside
    ``N_10`` and no question is compared with every place. Ties go to the first name in order.
    The questions, which are short, are read once: their columns go along with the runs that are
    names, as ``_best_named`` has it.
    """
    gazetteer = places.select(F.array_join(words(F.col(name)), " ").alias("run"), F.col(name).alias("place")).distinct()
    longest = gazetteer.agg(F.max(F.size(F.split("run", " ")))).first()[0] or 1
    rank = F.struct((-F.length("place")).alias("len"), F.col("place")).alias("best")
    named = gazetteer.select(F.col("run").alias("_run"), rank)
    best = _best_named(_with_runs(questions, word_runs(F.col("question"), longest)), questions.columns, named)
    return best.select(*questions.columns, F.col("_best.place").alias("place"))


def _with_runs(questions: DataFrame, runs: Column) -> DataFrame:
    """A row for each run of a question's words, and one without a run that keeps the question. Questions
    are dealt out by all their columns, copies of one are one."""
    none = F.array(F.lit(None).cast("string"))
    dealt = questions.repartition(*questions.columns).distinct()
    return dealt.select("*", F.explode(F.concat(none, F.coalesce(runs, none))).alias("_run"))


def _best_named(asked: DataFrame, columns: Sequence[str], named: DataFrame) -> DataFrame:
    """Each question with the smallest ``best`` of its runs, or NULL, as ``_best``.

    Of the runs only those that ``named`` has go on to the grouping, which sorts, besides the row that
    keeps the question. Questions were dealt out, so a task sorts its share of them, and not what a file
    that cannot be split holds; with a broadcast no second exchange is needed."""
    kept = asked.join(named, "_run", "left").where(F.col("_run").isNull() | F.col("best").isNotNull())
    return kept.groupBy(*columns).agg(F.min("best").alias("_best"))


#: Edits that are forgiven in a name of so many characters, shorter ones none.
FORGIVEN = ((5, 1), (10, 2))


def _forgiven(length: Column, allowed: Sequence[tuple[int, int]]) -> Column:
    return F.greatest(F.lit(0), *[F.when(length >= least, F.lit(edits)) for least, edits in allowed])


def find_places(
    questions: DataFrame,
    places: DataFrame,
    name: str = "province_name",
    text: str = "question",
    allowed: Sequence[tuple[int, int]] = FORGIVEN,
) -> DataFrame:
    """Each question with the place that it names, as people type names: without accents, or with a
    letter wrong, missing or too many. Adds ``place`` and ``edits`` (0: as it stands but for case and
    accents), both NULL where no name is near.

    A run of whole words names a place if so few edits turn one into the other as ``allowed`` grants
    a name of that length, and their digits agree (``N_1`` is not a misspelt ``N_2``). Fewest edits
    win, then the longest name, then the first in order. The runs of all questions are compared
    once each, however often they are asked: runs and names meet by equality of what deletions leave
    of them, so no run is held against every name, and the edit distance of those that meet is exact.
    Questions, which are short, go along with their runs; one without a key keeps its row. Rows that
    are equal in all columns are one row; empty and null questions name nothing.
    """
    most = max((edits for _, edits in allowed), default=0)
    run_of = lambda c: F.array_join(words(folded(c)), " ")
    names = places.select(run_of(F.col(name)).alias("name"), F.col(name).alias("place")).where("name <> ''").distinct()
    names = names.withColumn("most", _forgiven(F.length("name"), allowed))
    longest = names.agg(F.max(F.size(F.split("name", " ")))).first()[0] or 1

    # A run may be shorter than a name that it means by as many characters as are forgiven; a blank
    # that is missing or too many changes the number of its words by one for each.
    asked = _with_runs(questions, word_runs(folded(F.col(text)), longest + most))
    runs = asked.where("_run <> ''").select(F.col("_run").alias("run")).distinct()
    runs = runs.withColumn("most", _forgiven(F.length("run") + most, allowed))

    def left(df: DataFrame, column: str) -> DataFrame:
        """A row for each hash of what deletions leave."""
        rest = deletions(F.col(column), F.col("most"), most)
        return df.withColumn("left", F.explode(F.transform(rest, lambda r: F.xxhash64(r))))

    near = left(runs, "run").drop("most").join(left(names, "name"), "left")
    near = near.withColumn("edits", F.levenshtein("run", "name"))
    digits = lambda c: F.regexp_replace(c, r"[^0-9]", "")
    near = near.where((F.col("edits") <= F.col("most")) & (digits("run") == digits("name")))
    rank = F.struct(F.col("edits"), (-F.length("place")).alias("len"), F.col("place"))
    best = near.groupBy(F.col("run").alias("_run")).agg(F.min(rank).alias("best"))
    named = _best_named(asked, questions.columns, best)
    return named.select(*questions.columns, F.col("_best.place").alias("place"), F.col("_best.edits").alias("edits"))


# Words that put a question without a date into the past or the future.
PAST_WORDS, FUTURE_WORDS = r"(?i)\b(was|were|past|yesterday|history)\b", r"(?i)\b(will|forecast|tomorrow|next)\b"


def with_kind(questions: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """A date decides between past and forecast; without one its words do, else it is about now."""
    text, day = F.col("question"), first_date(F.col("question"))
    undated = F.when(text.rlike(PAST_WORDS), "past").when(text.rlike(FUTURE_WORDS), "forecast").otherwise("current")
    kind = F.when(day.isNull(), undated).when(day <= as_date(as_of), "past").otherwise("forecast")
    return questions.withColumn("day", day).withColumn("kind", kind)


def answers(current: DataFrame, past: DataFrame, forecast: DataFrame, provinces: DataFrame) -> DataFrame:
    """The three facts under one shape, keyed by kind, place and day."""
    names = provinces.select("province_id", F.col("province_name").alias("place"))
    now = current.join(names, "province_id").select(
        F.lit("current").alias("kind"),
        "place",
        F.lit(None).cast("date").alias("day"),
        F.col("temperature_celsius").alias("avg_temperature"),
        F.col("temperature_celsius").alias("max_temperature"),
        F.col("temperature_celsius").alias("min_temperature"),
        F.col("precipitation_mm").alias("sum_precipitation"),
        F.col("humidity_percent").cast("double").alias("avg_humidity"),
        F.col("weather_condition").alias("condition"),
    )
    history = past.join(names, "province_id").select(
        F.lit("past").alias("kind"), "place", F.col("weather_date").alias("day"), *FACT_COLUMNS
    )
    ahead = forecast.join(names, "province_id").select(
        F.lit("forecast").alias("kind"),
        "place",
        F.col("predicted_date").alias("day"),
        F.col("avg_temperature_c").alias("avg_temperature"),
        F.col("max_temperature_c").alias("max_temperature"),
        F.col("min_temperature_c").alias("min_temperature"),
        F.col("total_precip_mm").alias("sum_precipitation"),
        "avg_humidity",
        F.col("predicted_condition").alias("condition"),
    )
    return now.unionByName(history).unionByName(ahead)


def answer_questions(asked: DataFrame, facts: DataFrame, first: int = 3) -> DataFrame:
    """All questions joined with the facts; a question without an answer stays, flagged.

    A question about now or about a day has one row. One about the past or the future without a day
    has the ``first`` days that are known of the place, and in ``remaining`` how many more there are.
    ``answer_day`` is the fact's day, ``row`` numbers a question's rows.

    The facts, small beside the questions, are unique by (kind, place, day). Questions without a place
    have no answer and don't take part in the join. A question asked very often makes its own side
    skewed, which adaptive execution splits; both sides are shuffled by (kind, place, day).
    """
    placed, nowhere = asked.where("place is not null"), asked.where("place is null")
    undated = F.col("day").isNull() & (F.col("kind") != "current")
    facts = facts.withColumnsRenamed({"kind": "f_kind", "place": "f_place", "day": "answer_day"})
    dated = facts.withColumn("row", F.lit(1)).withColumn("remaining", F.lit(0).cast("long"))
    known = preview(facts.where("answer_day is not null"), ["f_kind", "f_place"], [F.asc("answer_day")], first)
    place = (F.col("kind") == F.col("f_kind")) & (F.lower("place") == F.lower("f_place"))
    found = placed.where(~undated).join(dated, place & F.col("day").eqNullSafe(F.col("answer_day")), "left")
    several = placed.where(undated).join(known, place, "left")
    answered = found.unionByName(several).withColumn("not_found", F.col("row").isNull()).drop("f_kind", "f_place")
    return answered.unionByName(nowhere.withColumn("not_found", F.lit(True)), allowMissingColumns=True)
