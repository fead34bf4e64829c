"""Periodic runs, byte-level BPE and fill-in-the-middle against brute force and the tokenizer library."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from stationflow.llm.byte_bpe import ByteBPE, byte_bpe, decode, encode
from stationflow.llm.fill_middle import UNITS, WaveletMatrix, classes, cuts, fill_in_middle, restored
from stationflow.llm.periodic_runs import collapse_runs, find_runs
from stationflow.llm.queries import ORACLES, QUERIES
from tests_support import brute_collapse, brute_runs, sha

PATH = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TESTDATA = "/root/testdata/sf0.001"


def found_runs(texts):
    """The runs of several lists of words that lie in one array."""
    numbers, sizes, codes = [], [], {}
    for k, words in enumerate(texts):
        numbers += [codes.setdefault(w, len(codes)) for w in words] + [-1 - k]
        sizes.append(len(words) + 1)
    runs = find_runs(np.array(numbers, np.int64), np.array(sizes, np.int64))
    starts = np.cumsum(sizes) - sizes
    out = [[] for _ in texts]
    for start, length, period in runs.tolist():
        k = int(np.searchsorted(starts, start, side="right")) - 1
        out[k].append((start - int(starts[k]), length, period))
    return out


def test_runs_of_small_texts_equal_brute_force():
    rng = random.Random(5)
    texts = [[]]
    for _ in range(500):
        words = [rng.choice("ab") for _ in range(rng.randrange(0, 50))]
        unit = [rng.choice("abc") for _ in range(rng.randrange(1, 12))]
        at = rng.randrange(len(words) + 1)
        texts.append(words[:at] + unit * rng.randrange(0, 7) + unit[: rng.randrange(len(unit))] + words[at:])
    assert found_runs(texts) == [brute_runs(t) for t in texts]


def test_long_periods_and_nested_runs():
    rng = random.Random(6)
    texts = []
    for period in (8, 9, 15, 16, 17, 31, 32, 33, 64, 65, 100, 127, 128, 129):
        unit = [str(rng.randrange(5)) for _ in range(period)]
        for length in (4 * period - 1, 4 * period, 4 * period + 1, 6 * period + period // 2):
            body = (unit * 7)[:length]
            texts.append([f"x{i}" for i in range(rng.randrange(40))] + body + [f"y{i}" for i in range(rng.randrange(40))])
    inner = ["a", "b"] * 5 + ["c"] * 7 + [str(i) for i in range(20)]
    texts.append(inner * 5)
    texts.append(["a"] * 3000)
    for _ in range(4):
        texts.append((inner[: rng.randrange(20, 37)] * 4 + inner)[rng.randrange(5) :])
    assert found_runs(texts) == [brute_runs(t) for t in texts]
    a, b = ["a"], ["a", "b"]
    for _ in range(9):
        a, b = b, b + a
    assert found_runs([b * 5, a * 4 + b]) == [brute_runs(b * 5), brute_runs(a * 4 + b)]


def test_one_very_long_text(spark):
    unit = [f"w{i}" for i in range(5000)]
    words = [f"v{i}" for i in range(1000)] + unit * 5 + unit[:10]
    row = collapse_runs(spark.createDataFrame([(" ".join(words),)], "text string")).first()["periodic"]
    assert [tuple(r) for r in row["runs"]] == [(1000, 25010, 5000)]
    assert row["collapsed"] == " ".join(words[:6000]) and row["n_words"] == len(words)


def planted(doc_id, words):
    if doc_id is None:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def brute_query(rows):
    out = []
    for doc_id, text in rows:
        words = planted(doc_id, WORD.findall(text or ""))
        runs = brute_runs(words)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        figures = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        out.append((doc_id, len(runs), *figures, sha(lines), sha(" ".join(brute_collapse(words, runs)))))
    return out


def same_rows(rows, expected):
    order = lambda found: sorted(map(tuple, found), key=repr)
    assert order(rows) == order(expected)


@pytest.mark.parametrize("kind", ["odd", "more"])
def test_periodic_query_on_odd_rows(spark, folder, odd_rows, kind):
    rows = QUERIES["op11_periodic_runs"](spark, f"{folder}/{kind}")
    assert [f.dataType.simpleString() for f in rows.schema] == ["bigint"] * 6 + ["string"] * 2
    same_rows(rows.collect(), brute_query([(r[0], r[1]) for r in odd_rows]))


def test_periodic_query_on_given_documents(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet").select("doc_id", "text").collect()
    expected = brute_query(docs)
    assert any(r[1] for r in expected) and any(not r[1] for r in expected)
    same_rows(QUERIES["op11_periodic_runs"](spark, TESTDATA).collect(), expected)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


ODD_TEXTS = [
    "", " ", "  \n\n x ", "don't we'll I'M it's", "a\tb\r\n\x0b\x0c\x1c\x1d\x85\xa0　c", "aaaaaaaaaaaaaaaaaaaaaaaa aaa", "\x00\x01�\x7f",
    "naïve Straße 日本語 한국어 привет ١٢٣ ²³ ½", "emoji 👩‍👩‍👧‍👦 🇩🇪", "new letters ꟎࢏Ᲊ \U000323b0 \U00010940x", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>",
    "<|endoftext", "x" * 5000, "ab" * 3000, " " * 999, "=" * 777, "1234567890" * 50,
]


def test_encoding_equals_the_library(library):
    rng = random.Random(7)
    texts = ODD_TEXTS + ["".join(rng.choice("etaoinshr") for _ in range(n)) for n in (50, 400, 60_000)]
    texts += ["".join(chr(rng.choice((rng.randrange(32, 127), rng.randrange(160, 0x2FFF)))) for _ in range(60)) for _ in range(200)]
    model = ByteBPE(PATH)
    for _ in range(2):  # the second time by what is remembered
        found = [np.frombuffer(b, "<u4").tolist() for b in model.encode(texts)]
        assert found == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    flat = [i for ids in found for i in ids]
    bounds = np.cumsum([0, *map(len, found)])
    assert model.decode(np.array(flat), bounds) == texts


def test_every_settled_character_splits_as_the_library_does(library):
    model, points = ByteBPE(PATH), [*range(0x530), *range(0x2000, 0x2070), *range(0x20A0, 0x2C00), *range(0x3000, 0xA000), *range(0xAC00, 0xD7A4)]
    for c in map(chr, points):
        text = f"a{c}1{c}!{c}x"
        assert model.split(text) == [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]


def test_linked_rounds_equal_the_others(monkeypatch):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdet ") for _ in range(rng.randrange(1, 40))).encode() for _ in range(500)]
    model = ByteBPE(PATH)
    expected = model.merge_words(words)
    monkeypatch.setattr("stationflow.llm.byte_bpe.ROUNDS", 1)
    assert model.merge_words(words) == expected
    assert model.merge_words([]) == []


def test_decoding_broken_and_unknown_ids(spark, library):
    lists = [[1, 2, 3], [], None, [None, 5, 10**6, -3, 50256], [222, 98], [447]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "id int, ids array<int>")
    found = [r["decoded"] for r in decode(df, PATH).orderBy("id").collect()]
    clean = [None if x is None else [i for i in x if i is not None and 0 <= i <= 50256] for x in lists]
    assert found == [None if x is None else library.decode(x, skip_special_tokens=False) for x in clean]


def brute_tokens(library, rows):
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        yield doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))


@pytest.mark.parametrize("kind", ["odd", "more", TESTDATA])
def test_bpe_query(spark, folder, library, kind):
    place = kind if kind.startswith("/") else f"{folder}/{kind}"
    rows = QUERIES["op12_byte_bpe"](spark, place)
    docs = spark.read.parquet(f"{place}/documents.parquet").select("doc_id", "text").collect()
    same_rows(rows.collect(), brute_tokens(library, docs))


def test_wavelet_ranks_and_places():
    rng = np.random.default_rng(9)
    for n in (0, 1, 63, 64, 65, 1000):
        symbols = rng.integers(0, 4, n).astype(np.uint8)
        matrix, at = WaveletMatrix(symbols), np.arange(n + 1)
        for s in range(4):
            assert matrix.rank(s, at).tolist() == [int((symbols[:i] == s).sum()) for i in at]
        total = int(np.isin(symbols, (1, 3)).sum())
        places = matrix.locate((1, 3), np.arange(1, total + 1), np.zeros(total, int), np.full(total, n))
        assert places.tolist() == (np.flatnonzero(np.isin(symbols, (1, 3))) + 1).tolist()


@pytest.mark.parametrize("unit,pattern", [("line", r"[^\n]*\n|[^\n]+"), ("word", r"[^\s]*\s|[^\s]+"), ("sentence", r"[^\n.!?]*[\n.!?]|[^\n.!?]+")])
def test_cuts_equal_a_plain_split(unit, pattern):
    rng = random.Random(10)
    texts = ["", "\n", "a", "\n\n", "é\n日本. x!?"] + ["".join(rng.choice("ab \n.é日") for _ in range(rng.randrange(80))) for _ in range(300)]
    draws = np.array([[rng.randrange(2**32), rng.randrange(2**32)] for _ in texts])
    n, first, second = cuts(texts, draws, unit)
    for i, text in enumerate(texts):
        units = re.findall(pattern, text)
        k = sorted(int(d) % (len(units) + 1) for d in draws[i])
        assert (n[i], first[i], second[i]) == (len(units), *[len("".join(units[:j])) for j in k])
    assert set(UNITS) >= {unit} and classes(np.array([10, 955])).tolist() == [1, 0]


def brute_middle(doc_id, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, _, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")):
        return doc_id, len(units), "plain", None, None, sha(text), sha(text)
    form = "spm" if h4 % 100 < 50 else "psm"
    output = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, len(units), form, len(p), len(m), sha(output), sha(text)


@pytest.mark.parametrize("kind", ["odd", "more", TESTDATA])
def test_middle_query(spark, folder, kind):
    place = kind if kind.startswith("/") else f"{folder}/{kind}"
    docs = spark.read.parquet(f"{place}/documents.parquet").select("doc_id", "text").collect()
    same_rows(QUERIES["op13_fill_middle"](spark, place).collect(), [brute_middle(*r) for r in docs])


def test_middle_of_texts_with_marks_and_rates(spark):
    rows = [(i, t) for i, t in enumerate(["a<P>b\n", "x\n<S", "<M\nS>\n<", "P>\nM>", "<M>", None, ""] + [f"line {k}\nnext\n{k}" for k in range(200)])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fim", F.lit(1)).withColumn("_input0", F.lit(2))
    for rate, spm in ((100, 50), (0, 50), (60, 0), (60, 100)):
        found = fill_in_middle(df, F.col("doc_id"), rate=rate, spm_rate=spm)
        assert found.columns == ["doc_id", "text", "_input0", "fim"]
        found = found.withColumn("back", restored(F.col("fim.output"), F.col("fim.form"))).collect()
        assert all(r["back"] == (r["text"] or "") for r in found)
        forms = {r["fim"]["form"] for r in found}
        assert forms == {"plain"} | ({"psm"} if rate and spm < 100 else set()) | ({"spm"} if rate and spm else set())
        assert all(r["fim"]["form"] == "plain" for r in found if r["doc_id"] in (0, 4, 5, 6))
    with pytest.raises(ValueError):
        fill_in_middle(df, F.col("doc_id"), marks=("<P>", "<P", "<<>"))


@pytest.mark.parametrize("name", ["op11_periodic_runs", "op12_byte_bpe", "op13_fill_middle"])
def test_no_documents(spark, folder, name):
    assert QUERIES[name](spark, f"{folder}/none").collect() == []


def test_columns_called_like_the_outputs(spark):
    df = spark.createDataFrame([(1, "a b a b a b a b", 5, 6)], "doc_id long, text string, ids int, periodic int")
    row = encode(collapse_runs(df), PATH).first()
    assert row["periodic"]["collapsed"] == "a b" and row["ids"] == np.frombuffer(byte_bpe(PATH).encode(["a b a b a b a b"])[0], "<u4").tolist()
    assert row["doc_id"] == 1 and "op13_fill_middle" in ORACLES
