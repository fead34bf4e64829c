"""Mixing, sharding and quality rules."""

import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import Window, functions as F

from stationflow.llm.mixing import drawn_counts, located, mix_sources, numbered_draws, permuted
from stationflow.llm.quality_rules import quality_rules
from stationflow.llm.queries import QUERIES
from stationflow.llm.sharding import balanced_shards, range_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights, share=1.5, cap=2.0):
    """Shares by weight, capped, the excess reshared until none is above."""
    total, full = share * sum(sizes.values()), set()
    while True:
        rest = total - sum(cap * sizes[s] for s in full)
        free = {s: weights[s] for s in sizes if s not in full}
        target = {s: rest * w / sum(free.values()) for s, w in free.items()}
        over = {s for s, t in target.items() if t > cap * sizes[s]}
        if not over:
            return target | {s: cap * sizes[s] for s in full}
        full |= over


def test_permutation_and_inverse(spark):
    for n in (1, 2, 7, 1000):
        at = permuted(F.col("id"), F.lit(n).cast("long"), F.lit(3), F.lit("s"))
        back = permuted(F.col("p"), F.lit(n).cast("long"), F.lit(3), F.lit("s"), inverse=True)
        rows = spark.range(n).withColumn("p", at).withColumn("back", back).collect()
        assert sorted(r["p"] for r in rows) == list(range(n))
        assert all(r["back"] == r["id"] for r in rows)
    assert [r["p"] for r in sorted(rows, key=lambda r: r["id"])] != list(range(n))


@pytest.mark.parametrize("kind", ["odd", "more"])
def test_mix_meets_its_targets(spark, folder, odd_rows, kind):
    rows = QUERIES["op3_mixing"](spark, f"{folder}/{kind}").collect()
    sizes = Counter({r[3]: 0 for r in odd_rows})
    for r in odd_rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    target = brute_targets(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    source = defaultdict(set)
    for r in odd_rows:
        source[r[0]].add(r[3])
    assert len(rows) == len(odd_rows)
    taken = Counter()
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        s = next(s for s in source[r["doc_id"]] if sizes[s] == r["source_size"])
        assert r["target"] == pytest.approx(target[s])
        taken[s] += r["taken"]
    for s, t in target.items():
        assert abs(taken[s] - t) <= 1
    again = QUERIES["op3_mixing"](spark, f"{folder}/{kind}").collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_spans_fill_shards_with_blocks(spark, odd):
    mix = mix_sources(odd, F.col("doc_id"), F.col("source"), F.regexp_count("text", F.lit(WORD.pattern)), block=64, slots_per_shard=16)
    spans = mix.spans.collect()
    filled, blocks = Counter(), {}
    for s in spans:
        filled[s["shard"], s["slot"]] += s["length"]
        blocks.setdefault((s["shard"], s["slot"]), set()).add((s["_src"], s["epoch"], s["block"]))
    assert max(filled.values()) <= 64
    assert all(len(b) == 1 for b in blocks.values())  # a slot is one block
    assert len({b for v in blocks.values() for b in v}) == len(blocks)  # no block twice in a round
    assert {s for s, _ in filled} == set(range(max(s for s, _ in filled) + 1))


def test_shard_counts_are_multinomial_and_slots_meet_the_totals(spark):
    sources = spark.createDataFrame([(0, 30_000), (1, 9_000), (2, 1), (3, 961), (4, 0)], "_src int, _draws long")
    sources = sources.withColumn("_before", F.coalesce(F.sum("_draws").over(Window.orderBy("_src").rowsBetween(-100, -1)), F.lit(0)))
    total, per = 39_962, 400
    counts = drawn_counts(spark, sources, total, per, seed=5).cache()
    rows = counts.collect()
    by_shard = defaultdict(dict)
    for r in rows:
        by_shard[r["shard"]][r["_src"]] = r["_n"]
    assert [sum(by_shard[k].values()) for k in sorted(by_shard)] == [400] * 99 + [362]
    for src, draws in ((0, 30_000), (1, 9_000), (3, 961)):
        p = draws / total
        spread = sum((by_shard[k].get(src, 0) - per * p) ** 2 for k in range(99)) / (per * p * (1 - p))
        assert 60 < spread < 145  # chi-square of 99 degrees: mean 99, deviation 14
    # Independent between shards: neighbours' counts don't go together.
    c = [by_shard[k].get(0, 0) - per * 30_000 / total for k in range(99)]
    assert abs(sum(a * b for a, b in zip(c, c[1:]))) < 0.35 * sum(a * a for a in c)

    slots = numbered_draws(counts, sources, total, seed=5).collect()
    drawn, held = defaultdict(list), defaultdict(list)
    for r in slots:
        drawn[r["_src"]].append(r["_draw"])
        held[r["shard"]].append(r["slot"])
    assert {s: len(d) for s, d in drawn.items()} == {0: 30_000, 1: 9_000, 2: 1, 3: 961}
    assert all(sorted(d) == list(range(len(d))) for d in drawn.values())
    assert all(sorted(held[k]) == list(range(400 if k < 99 else 362)) for k in range(100))
    after = Counter((r["shard"], r["_src"]) for r in slots)
    moved = sum(abs(after[k, s] - by_shard[k].get(s, 0)) for k in range(100) for s in range(4)) / 2
    assert moved <= 4 * total**0.5  # few slots pass to other sources


def test_places_find_their_stretch(spark):
    sizes = [3, 0, 700, 1, 1, 256, 0, 90]
    starts = [sum(sizes[:i]) for i in range(len(sizes))]
    line = spark.createDataFrame([(i, s, n) for i, (s, n) in enumerate(zip(starts, sizes))], "_src int, _from long, _n long")
    rows = located(spark.range(sum(sizes)), "id", line, "src", "first").collect()
    want = {starts[i] + j: (i, starts[i]) for i, n in enumerate(sizes) for j in range(n)}
    assert {r["id"]: (r["src"], r["first"]) for r in rows} == want


def test_mix_of_nothing(spark, folder):
    assert QUERIES["op3_mixing"](spark, f"{folder}/none").count() == 0


def test_range_of_counts_splitters(spark):
    splitters = [-5, 0, 3, 4, 90]
    rows = spark.createDataFrame([(x,) for x in (None, -9, -5, 2, 3, 4, 89, 90, 91)], "x long").select(range_of(F.col("x"), splitters)).collect()
    assert [r[0] for r in rows] == [0, 0, 1, 2, 3, 4, 4, 5, 5]


@pytest.mark.parametrize("kind", ["odd", "more"])
def test_shards_are_even_and_slots_gapless(spark, folder, odd_rows, kind):
    rows = QUERIES["op4_sharding"](spark, f"{folder}/{kind}").collect()
    want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in odd_rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_hot_key_is_subdivided(spark):
    docs = spark.range(4000).withColumn("key", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")))
    rows = balanced_shards(docs, F.col("id"), (F.col("id") % 50 + 1).cast("long"), F.col("key"), shards=8, ranges=32).collect()
    bytes_ = Counter()
    for r in rows:
        bytes_[r["shard"]] += r["size"]
    assert len(rows) == 4000 and set(bytes_) == set(range(8))
    assert max(bytes_.values()) - min(bytes_.values()) <= 100


def test_shards_of_nothing(spark, folder):
    assert QUERIES["op4_sharding"](spark, f"{folder}/none").count() == 0


def brute_measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


@pytest.mark.parametrize("kind", ["odd", "more"])
def test_quality_measures(spark, folder, odd_rows, kind):
    rows = QUERIES["op7_quality_rules"](spark, f"{folder}/{kind}").collect()
    got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in rows)
    assert got == Counter((r[0], *brute_measures(r[1])) for r in odd_rows)
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])


def test_rules_keep_other_columns(spark):
    docs = spark.createDataFrame([("a b " * 60, 5, "x"), (None, None, None)], "text string, n_words int, _m string")
    rows = quality_rules(docs).collect()
    assert [(r["n_words"], r["_m"]) for r in rows] == [(5, "x"), (None, None)]
    assert rows[0]["quality"]["n_words"] == 120 and rows[1]["quality"]["base_failed"]


def test_rules_agree_with_the_labels(spark):
    folder = "/root/testdata/sf0.01"
    kept = QUERIES["op7_quality_rules"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    found = {(r["quality"], r["base_failed"], r["kept"]): r["count"] for r in kept.groupBy("quality", "base_failed", "kept").count().collect()}
    assert found.get((0, False, True), 0) == 0
    assert found.get((1, False, False), 0) <= 0.02 * found[1, False, True]


def test_native_plans_have_no_python(spark, folder):
    for name in ("op3_mixing", "op4_sharding", "op7_quality_rules"):
        plan = QUERIES[name](spark, f"{folder}/odd")._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
