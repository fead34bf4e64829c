"""What finding places sorts of questions."""

import pytest

from stationflow.plans import questions as qa


@pytest.mark.parametrize("search", [qa.extract_places, qa.find_places])
def test_words_that_are_no_place_are_not_sorted(spark, search):
    """Many long questions in one partition: what a task sorts is a share of them, not of their words."""
    filler = "array_join(transform(sequence(1, 40), i -> concat('w', id * 40 + i)), ' ')"
    asked = spark.range(0, 4000, 1, 1).selectExpr("id as question_id", f"concat(if(id % 2 = 0, 'Alpha ', ''), {filler}) as question")
    places = spark.createDataFrame([("Alpha",), ("Beta",)], "province_name string")
    found = search(asked, places)
    assert {r.place: r["count"] for r in found.groupBy("place").count().collect()} == {"Alpha": 2000, None: 2000}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    grouping = [line for line in plan.splitlines() if "Aggregate" in line and "min(" in line][0]
    below = plan[plan.index(grouping) :].splitlines()[1:3]
    assert any("Filter" in line and "isnotnull" in line for line in below), plan
    assert "RepartitionByExpression" in plan


@pytest.mark.parametrize("search", [qa.extract_places, qa.find_places])
def test_questions_without_words_or_keys_keep_their_row(spark, search):
    asked = spark.createDataFrame([(None,), ("",), ("?!",), ("in Alpha",), ("in Alpha",), ("Alpha Beach or Alpha",)], "question string")
    places = spark.createDataFrame([("Alpha",), ("Alpha Beach",), (None,)], "province_name string")
    found = {(r.question, r.place) for r in search(asked, places).collect()}
    assert found == {(None, None), ("", None), ("?!", None), ("in Alpha", "Alpha"), ("Alpha Beach or Alpha", "Alpha Beach")}


def test_answers_sort_a_share_of_the_questions(spark):
    """The questions that are answered come dealt out, from one partition, before their words are."""
    asked = spark.range(0, 100, 1, 1).selectExpr("id as question_id", "'weather in Alpha' as question")
    places = spark.createDataFrame([("Alpha",)], "province_name string")
    plan = qa.with_kind(qa.extract_places(asked, places), "2024-01-30")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("RepartitionByExpression")
