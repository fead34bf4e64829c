import random

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from stationflow.functions import text
from stationflow.operators import retrieval as ret, vectors as vec
from stationflow.plans import questions as qa


def test_recursive_split_prefers_coarse_separators():
    paragraphs = "a" * 600 + "\n\n" + "b" * 600 + "\n\n" + "c" * 300
    assert text.split_recursive(paragraphs) == ["a" * 600, "b" * 600 + "\n\n" + "c" * 300]


def test_recursive_split_repeats_a_short_tail():
    words = " ".join(f"w{i:03d}" for i in range(12))  # pieces of 5 characters
    assert text.split_recursive(words, size=20, overlap=10) == [
        "w000 w001 w002 w003", "w002 w003 w004 w005", "w004 w005 w006 w007", "w006 w007 w008 w009", "w008 w009 w010 w011"
    ]


def test_recursive_split_falls_back_to_characters():
    chunks = text.split_recursive("x" * 2500)
    assert [len(c) for c in chunks] == [1000, 1000, 520]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["x", "x", "x", " ", "\n", "\n\n"]), max_size=300), st.integers(11, 40))
def test_recursive_split_covers_the_text(parts, size):
    value = "".join(chr(0x4E00 + i) if p == "x" else p for i, p in enumerate(parts))  # no character twice
    chunks = text.split_recursive(value, size=size, overlap=10)
    assert all(0 < len(c) <= size and c == c.strip() for c in chunks)
    at = 0
    for chunk in chunks:  # in order, overlapping by at most 10, with only white space left out
        found = value.index(chunk)
        assert at - 10 <= found and not value[at:found].strip()
        at = found + len(chunk)
    assert not value[at:].strip()


def test_recursive_split_on_spark_keeps_whole_texts(spark):
    long = " ".join(str(random.Random(1).random()) for _ in range(20000))
    df = spark.createDataFrame([(1, long), (2, None), (3, "")], "id int, t string")
    rows = {r.id: r.c for r in df.select("id", text.recursive_chunks()(F.col("t")).alias("c")).collect()}
    assert rows[2] == [] and rows[3] == [] and sum(map(len, rows[1])) >= len(long) - len(rows[1])


def _random_text(rng):
    """Blanks, words, accents and pairs of 16-bit units in runs of many lengths."""
    kinds = ["ab", "é", "\U0001f600", " ", "\n", "\n\n", "\t", "\u00a0", "word", "x" * 30, "y" * 130]
    weights = [rng.random() ** 2 for _ in kinds]
    return "".join(rng.choices(kinds, weights, k=rng.randrange(120)))


def test_recursive_chunks_equal_the_plain_form(spark):
    rng = random.Random(6)
    texts = [*(_random_text(rng) for _ in range(600)), "", " \n ", "\n\n\n\n\n", "x" * 100, "x" * 101, " " * 300]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string").repartition(8)
    for size, overlap in ((100, 10), (40, 0), (30, 12), (11, 10), (21, 20)):
        for row in df.select("t", text.recursive_chunks(size, overlap)(F.col("t")).alias("c")).collect():
            assert row.c == text.split_recursive(row.t, size, overlap), (row.t, size, overlap)


def test_recursive_chunks_of_the_documents_equal_the_plain_form(spark):
    """``chunk_recursive_rows`` as it stands, for which there is no SQL; no Python runs in it."""
    folder = "/root/testdata/sf0.01"
    chunks = entry_point.queries()["chunk_recursive_rows"](spark, folder)
    assert "Python" not in chunks._jdf.queryExecution().toString()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    want = {(i, n, c) for i, t in texts.items() for n, c in enumerate(text.split_recursive(t) if t else [])}
    got = [(r.doc_id, r.chunk_no, r.chunk_text) for r in chunks.collect()]
    assert len(got) == len(want) and set(got) == want


def test_fixed_chunks(spark):
    df = spark.createDataFrame([("abcdefghij" * 3,), ("ab",), ("",), (None,)], "t string")
    out = [r[0] for r in df.select(text.fixed_chunks(F.col("t"), 12, 2)).collect()]
    assert out[0] == ["abcdefghijab", "abcdefghijab", "abcdefghij"]
    assert out[1:] == [["ab"], [], []]


def test_dates_in_pattern_order(spark):
    cases = {
        "on 23/07/2025 or 2024-01-01": "2025-07-23",
        "on 2024-01-01 or 05-06-2023": "2024-01-01",
        "on 05-06-2023": "2023-06-05",
        "on 31/02/2024": "unknown",
        "tomorrow": "unknown",
    }
    df = spark.createDataFrame([(k,) for k in cases], "q string")
    got = {r.q: r.d for r in df.select("q", text.date_or_unknown(F.col("q")).alias("d")).collect()}
    assert got == cases


def test_longest_place_wins_and_missing_places_stay(spark):
    places = spark.createDataFrame([("Nam Dinh",), ("Nam",), ("Ha Noi",), ("N_1",), ("N_10",)], "province_name string")
    asked = ["rain in NAM DINH, tonight?", "rain in ha  noi", "and N_10?", "and n_1.", "Hanoi?", None]
    df = spark.createDataFrame(list(enumerate(asked)), "question_id int, question string")
    got = {r.question_id: r.place for r in qa.extract_places(df, places).collect()}
    assert got == {0: "Nam Dinh", 1: "Ha Noi", 2: "N_10", 3: "N_1", 4: None, 5: None}


def test_places_as_people_type_them(spark):
    names = ["Hà Nội", "Đà Nẵng", "Hồ Chí Minh", "Thừa Thiên Huế", "Nam Định", "N_12345", "N_12346", "Hue"]
    places = spark.createDataFrame([(n,) for n in names + ["Hà Nội", None, ""]], "province_name string")
    asked = {
        "rain in HA NOI?": ("Hà Nội", 0), "in Ha\u0300 No\u0323\u0302i": ("Hà Nội", 0), "hanoi": ("Hà Nội", 1), "da nag now": ("Đà Nẵng", 1),
        "ho chi mihn": ("Hồ Chí Minh", 2), "hochiminh": ("Hồ Chí Minh", 2), "thua thien hue": ("Thừa Thiên Huế", 0), "hue": ("Hue", 0), "hua": (None, None),
        "n_12346": ("N_12346", 0), "n_12347": (None, None), "m_12345": ("N_12345", 1), "nam dinh or ha noj": ("Nam Định", 0), "": (None, None), None: (None, None),
    }
    df = spark.createDataFrame([(i, q, "x") for i, q in enumerate(asked)], "question_id int, question string, name string")
    got = {r.question: (r.place, r.edits) for r in qa.find_places(df, places).collect()}
    assert got == asked
    assert {r.place for r in qa.find_places(df, places.limit(0)).collect()} == {None}
    assert qa.find_places(df.limit(0), places).count() == 0


def test_places_equal_brute_force(spark):
    """Every run of words against every name by its edit distance."""
    rng = random.Random(8)
    names = sorted({"".join(rng.choices("abc ", k=rng.randrange(4, 13))).strip() for _ in range(40)} - {""})
    names = [n for n in names if "  " not in n]
    asked = ["".join(rng.choices("abc ", [3, 3, 3, 1], k=rng.randrange(0, 30))) for _ in range(150)]

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    def best(question):
        words = question.split()
        longest = max(len(n.split()) for n in names) + 2
        runs = {" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)}
        found = [(distance(r, n), -len(n), n) for r in runs for n in names]
        found = [f for f in found if f[0] <= (2 if -f[1] >= 10 else 1 if -f[1] >= 5 else 0)]
        return (min(found)[2], min(found)[0]) if found else (None, None)

    df = spark.createDataFrame(list(enumerate(asked)), "question_id int, question string")
    places = spark.createDataFrame([(n,) for n in names], "province_name string")
    got = {r.question_id: (r.place, r.edits) for r in qa.find_places(df, places).collect()}
    assert got == {i: best(q) for i, q in enumerate(asked)}


def _brute(queries, vectors, k):
    unit = lambda v: np.asarray(v) / np.linalg.norm(v)
    out = set()
    for qid, q in queries:
        scored = sorted((-round(float(unit(q) @ unit(v)), 9), vid) for vid, v in vectors)
        out |= {(qid, vid, rank) for rank, (_, vid) in enumerate(scored[:k], 1)}
    return out


def test_topk_equals_brute_force_in_any_tiling(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(300)]
    vectors = base + [(1000 + i, v) for i, v in base[:40]]  # exact copies tie, so ids decide
    queries = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(25)] + [(99, base[5][1])]
    q = spark.createDataFrame(queries, "query_id long, embedding array<double>")
    v = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(5)
    expected = _brute(queries, vectors, 3)
    for tile in (4096, 64):
        monkeypatch.setattr(vec, "TILE_VECTORS", tile)
        monkeypatch.setattr(vec, "TILE_QUERIES", tile // 8)
        assert {(r.query_id, r.vec_id, r["rank"]) for r in ret.vector_topk(q, v, 3).collect()} == expected


def test_topk_with_text_ids_missing_and_ragged_vectors(spark):
    rows = [("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("c", None), ("d", [1.0, None]), ("e", [1.0]), (None, [1.0, 0.0]), ("f", [0.0, 1.0]), ("g", [float("nan"), 1.0])]
    v = spark.createDataFrame(rows, "vec_id string, embedding array<double>")
    q = spark.createDataFrame([("q", [1.0, 0.0]), ("none", None)], "query_id string, embedding array<double>")
    got = ret.vector_topk(q, v, 5).collect()
    assert sorted((r["rank"], r.vec_id, r.query_id) for r in got) == [(1, "a", "q"), (2, "b", "q"), (3, "f", "q")]
    assert {(r.vec_id, r.reason) for r in ret.unsearchable(v, 2).collect()} == {
        ("c", "no vector"), ("d", "missing component"), ("e", "other dimensions"), (None, "no id"), ("g", "missing component")
    }
    assert ret.vector_topk(q, v.limit(0), 5).count() == ret.vector_topk(q.limit(0), v, 5).count() == 0


def test_topk_of_a_namespace(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0], "a"), (2, [1.0, 0.1], "b")], "vec_id long, embedding array<double>, namespace string")
    q = spark.createDataFrame([(7, [1.0, 0.0])], "query_id long, embedding array<double>")
    assert [r.vec_id for r in ret.vector_topk(q, v, 2, namespace="b").collect()] == [2]


def test_context_defaults_and_fallback(spark):
    matches = spark.createDataFrame(
        [(1, 2, " second ", None, None), (1, 1, "first", "f.pdf", "t")],
        "query_id long, rank int, chunk_text string, file_name string, topic string",
    )
    out = {r.query_id: r for r in ret.assemble_context(spark.createDataFrame([(1,), (2,)], "query_id long"), matches).collect()}
    assert out[1].context == "[f.pdf, topic: t]\nfirst\n\n[Unknown file, topic: General]\nsecond"
    assert out[1].sources == "- Unknown file (topic: General)\n- f.pdf (topic: t)"
    assert out[1].files == "Unknown file, f.pdf"
    assert out[2].context == ret.NO_CONTEXT and out[2].files == ""
    own = ret.assemble_context(spark.createDataFrame([(2,)], "query_id long"), matches, fallback="ask again")
    assert own.first().context == "ask again"


def test_ingesting_chunks_again_gives_the_same_ids(spark):
    docs = spark.createDataFrame([(1, "x" * 2500, "a.pdf")], "doc_id int, text string, source string")
    ids = lambda: [r.id for r in ret.chunk_records(docs, "doc_id", "source", "uploaded_pdf").collect()]
    assert ids() == ids() and len(set(ids())) == 3


PLACES = [("A",), ("B",)]
FACT = "kind string, place string, day date, condition string"


def _asked(spark, questions):
    places = spark.createDataFrame(PLACES, "province_name string")
    frame = spark.createDataFrame(list(enumerate(questions)), "question_id int, question string")
    return qa.with_kind(qa.extract_places(frame, places), "2024-01-30")


def test_words_decide_when_there_is_no_date(spark):
    asked = ["weather in A?", "How was A?", "Forecast for A", "A on 2024-01-01, will it rain?", "A on 2024-02-01", "wasabi in A"]
    assert [r.kind for r in sorted(_asked(spark, asked).collect())] == ["current", "past", "forecast", "past", "forecast", "current"]


def test_undated_questions_have_the_first_rows_and_how_many_more(spark):
    days = [("past", "A", f"2024-01-0{d}", f"p{d}") for d in range(1, 6)] + [("forecast", "A", "2024-02-01", "f"), ("current", "A", None, "now")]
    facts = spark.createDataFrame(days, FACT.replace("date", "string")).withColumn("day", F.col("day").cast("date"))
    asked = ["How was A?", "Forecast for A?", "A now", "A on 2024-01-04", "A on 2024-01-20", "How was B?", "How was it?", "How was a?"]
    rows = qa.answer_questions(_asked(spark, asked), facts).collect()
    got = sorted((r.question_id, r.row, r.condition, r.remaining, r.not_found) for r in rows if r.question_id not in (4, 5, 6))
    assert got == [
        (0, 1, "p1", 2, False), (0, 2, "p2", 2, False), (0, 3, "p3", 2, False), (1, 1, "f", 0, False), (2, 1, "now", 0, False),
        (3, 1, "p4", 0, False), (7, 1, "p1", 2, False), (7, 2, "p2", 2, False), (7, 3, "p3", 2, False),
    ]
    assert all(r.not_found and r.row is None for r in rows if r.question_id in (4, 5, 6)) and len(rows) == 12


def test_questions_are_read_once_for_their_places(spark, tmp_path):
    spark.createDataFrame([(1, "A now")], "question_id int, question string").write.parquet(str(tmp_path / "q"))
    found = qa.extract_places(spark.read.parquet(str(tmp_path / "q")), spark.createDataFrame(PLACES, "province_name string"))
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_history_needs_no_global_sort(spark):
    rows = [(c, t, "user", f"{c}{t}") for c in range(5) for t in (3, 1, 2)] + [(0, 0, "system", "s")]
    history = ret.conversation_history(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string"))
    assert "rangepartitioning" not in history._jdf.queryExecution().executedPlan().toString()
    turns = {}
    for r in history.collect():
        turns.setdefault(r.conv_id, []).append(r.turn)
    assert turns == {c: [1, 2, 3] for c in range(5)}
