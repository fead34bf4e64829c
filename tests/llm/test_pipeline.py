"""The pipeline, stage by stage, against brute force, and on odd documents."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from stationflow.llm import components, language_id, mixing, near_dedup
from stationflow.session import durable
from test_line_dedup import brute as lines_kept
from test_native import WORD, brute_targets
from test_near_dedup import brute as classes
from test_packing import direct


def rows_of(frame):
    return [r.asDict() for r in frame.collect()]


def stages(spark, folder):
    """The rows before the first stage and after each."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs]
    for name, stage in pipeline.STAGES:
        docs = durable(stage(spark, docs, folder), f"test-{name}")
        out.append(docs)
    return out


def subsequence(part, whole):
    whole = iter(whole)
    return all(w in whole for w in part)


def check_mix(before, after):
    sizes, words = Counter(), {}
    for r in before:
        words[r["doc_id"]] = WORD.findall(r["text"] or "")
        sizes[r["source"]] += len(words[r["doc_id"]])
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    target = brute_targets(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    taken, used, texts = Counter(), Counter(), {r["doc_id"]: r["text"] for r in before}
    for r in after:
        found = WORD.findall(r["text"])
        assert found and subsequence(found, words[r["doc_id"]]) and r["n_chars"] == len(r["text"])
        if len(found) == len(words[r["doc_id"]]):
            assert r["text"] == texts[r["doc_id"]]
        taken[r["source"]] += len(found)
        used[r["doc_id"]] += 1
    assert max(used.values()) <= 2
    assert all(abs(taken[s] - t) <= 1 for s, t in target.items())


def pieces(rows):
    tokenizer, want = direct(), Counter()
    for r in rows:
        ids = np.array(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0], "<u4")
        for k, at in enumerate(range(0, len(ids), 2048)):
            cut = ids[at : at + 2048]
            want[r["doc_id"], k, at, len(cut), zlib.crc32(cut.tobytes())] += 1
    return want


def packed(rows):
    ends = Counter()
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends[r["sequence_id"]]
        ends[r["sequence_id"]] += r["length"]
    assert not ends or max(ends.values()) <= 2048 and len(ends) <= sum(ends.values()) / 2048 + 2
    return Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)


def test_stages_equal_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    frames = stages(spark, folder)
    first, known, lines, near, mixed, sequences = map(rows_of, frames)
    columns = list(first[0])
    assert all(list(r) == columns for rows in (known, lines, near, mixed) for r in rows)

    model = language_id.fit_on(frames[0], F.col("doc_id"), F.col("text"), F.col("lang"))
    rejected = {r["doc_id"] for r in language_id.identify(frames[0], "text", model).collect() if r["lang_rejected"]}
    assert sorted(map(str, known)) == sorted(str(r) for r in first if r["doc_id"] not in rejected)
    assert len(known) > 0.97 * len(first)

    kept = {d: t for d, _, _, t in lines_kept([(r["doc_id"], r["text"]) for r in known])}
    assert {r["doc_id"]: r["text"] for r in lines} == kept
    assert all(r["n_chars"] == len(r["text"]) for r in lines)

    roots = classes([(r["doc_id"], r["text"]) for r in lines])
    assert sorted(map(str, near)) == sorted(str(r) for r in lines if roots[r["doc_id"]] == r["doc_id"])
    check_mix(near, mixed)
    assert packed(sequences) == pieces(mixed)
    assert packed(rows_of(pipeline.run(spark, folder))) == pieces(mixed)  # reruns agree


@pytest.mark.parametrize("kind", ["odd", "more"])
def test_odd_documents(spark, folder, kind):
    frames = stages(spark, f"{folder}/{kind}")
    assert all(f.columns == frames[0].columns for f in frames[:-1])
    first, known, lines, near, mixed, sequences = map(rows_of, frames)
    assert {r["doc_id"] for r in known} >= {None, 4, 5, 6, *range(100, 125)}
    assert not {r["doc_id"] for r in known} & {1, 2, 3, 9}
    held = Counter(r["doc_id"] for r in near)
    assert held[4] == 1 and held[5] == 0 and held[None] == 1  # copies go, and rows that repeat
    assert len(near) == len({r["text"] for r in lines})
    assert packed(sequences) == pieces(mixed)


def test_no_documents(spark, folder):
    assert [f.count() for f in stages(spark, f"{folder}/none")] == [0] * 6


def test_stages_are_those_asked_for():
    names = [name for name, _ in pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "near_dedup", "mixing", "packing"] and pipeline.ORACLE_SQL is None


def test_a_hot_source_and_group_of_copies(spark):
    """A third of all rows are copies of one text, in one source."""
    base = " ".join(f"word{i} of" for i in range(40))
    rows = [(i, base if i % 3 == 0 else f"{base} {i} " + " ".join(f"t{i}x{k}" for k in range(60)), "en", "hot" if i % 3 == 0 else f"s{i % 4}", 0) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    near = pipeline.near_dedup(spark, docs, "").collect()
    assert sum(r["source"] == "hot" for r in near) == 1 and len(near) == 201
    mixed = rows_of(pipeline.mixing(spark, docs, ""))
    by_source = defaultdict(int)
    for r in mixed:
        by_source[r["source"]] += len(WORD.findall(r["text"]))
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1]))
    target = brute_targets(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes))})
    assert all(abs(by_source[s] - t) <= 1 for s, t in target.items())


def test_near_dedup_sees_through_a_repeated_line(spark):
    """One of two near-duplicates repeats a line; line dedup, which needs three documents, leaves it."""
    rows = []
    for g in range(40):
        base = "\n".join(" ".join(f"w{g}x{i}" for i in range(at, at + 15)) for at in range(0, 150, 15))
        line = " ".join(f"again{g}x{i}" for i in range(20))
        rows += [(2 * g, base), (2 * g + 1, base + f"\n{line}" * 1000)]
    rows = [(i, text, "en", "s", len(text)) for i, text in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    lines = durable(pipeline.line_dedup(spark, docs, ""), "test-lines")
    assert {r["doc_id"]: r["text"] for r in lines.collect()} == {r[0]: r[1] for r in rows}
    assert sorted(r["doc_id"] for r in pipeline.near_dedup(spark, lines, "").collect()) == list(range(0, 80, 2))


def test_language_stage_drops_foreign_texts(spark):
    from test_models import FOREIGN

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    foreign = spark.createDataFrame([(10**9 + i, t, None, "x", len(t)) for i, t in enumerate(FOREIGN.values())], docs.schema)
    kept = durable(pipeline.language_id(spark, docs.unionByName(foreign), ""), "test-foreign")
    assert kept.where(f"doc_id >= {10**9}").count() == 0
    assert kept.count() > 0.98 * docs.where("text rlike '[a-zA-Z]'").count()


def test_no_query_reads_many_tables_at_once(spark, monkeypatch):
    """All that a query reads or gathers first is under way at the same time, and the driver holds
    what each of them needs: ten reads at most, whatever the stage, and no second pass for nothing."""
    reads, passes = [], []

    def leaves(frame):
        reads.append(frame._jdf.queryExecution().optimizedPlan().collectLeaves().size())
        return frame

    for module in (near_dedup, components, mixing, pipeline):
        monkeypatch.setattr(module, "durable", lambda df, label: durable(leaves(df), label))
    monkeypatch.setattr(near_dedup, "components", lambda links: passes.append(1) or components.components(links))
    base = " ".join(f"word{i}" for i in range(60))
    rows = [(i, base if i < 3 else " ".join(f"t{i}x{k}" for k in range(60)), "en", f"s{i % 3}", 0) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    near = durable(leaves(pipeline.near_dedup(spark, docs, "")), "test-near")
    assert near.count() == 28 and len(passes) == 1
    leaves(pipeline.mixing(spark, near, ""))
    assert max(reads) <= 10, reads
