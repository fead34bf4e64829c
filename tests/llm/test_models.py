"""Language identification and the quality classifier: held-out accuracy, calibration, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationflow.llm import language_id, quality_model
from stationflow.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    truth = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op8_language_id"](spark, FOLDER).join(truth, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == truth.count() and len(held) > 100
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["rejected"] for r in rows if r["lang"]]) < 0.01


@pytest.mark.parametrize("kind", ["odd", "more"])
def test_language_of_odd_documents(spark, folder, odd_rows, kind):
    rows = QUERIES["op8_language_id"](spark, f"{folder}/{kind}").collect()
    assert len(rows) == len(odd_rows)
    und = {r["doc_id"] for r in rows if r["lang_pred"] == "und"}
    assert und == {1, 2, 3, 9}
    assert all(r["rejected"] and r["score"] == 0 for r in rows if r["lang_pred"] == "und")
    assert {r["lang_pred"] for r in rows} <= {"en", "fr", "und"}


def test_language_without_documents_or_labels(spark, folder, odd):
    assert QUERIES["op8_language_id"](spark, f"{folder}/none").count() == 0
    model = language_id.fit_on(odd.where("lang is null and lang is not null"), F.col("doc_id"), F.col("text"), F.col("lang"))
    assert {r["lang_pred"] for r in language_id.identify(odd, "text", model).collect()} == {"und"}


def test_language_sample_is_bounded(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = language_id.labelled_sample(docs, F.col("doc_id"), F.col("text"), F.col("lang"), 7, 1).groupBy("lang").count().collect()
    assert {r["count"] for r in rows} == {7} and len(rows) == 4


# Text of no learned language, with letters.
FOREIGN = {
    "russian": "Это обычный русский текст о погоде и о людях которые живут в городе",
    "greek": "Αυτό είναι ένα απλό ελληνικό κείμενο για τον καιρό",
    "dutch": "Dit is een gewone Nederlandse tekst over het weer en de mensen die in de stad wonen en werken",
    "italian": "Questa è una semplice frase italiana sul tempo e sulle persone che vivono in città",
    "polish": "To jest zwykły polski tekst o pogodzie i ludziach którzy mieszkają w mieście",
    "japanese": "日本語 の 文章 です これ は 普通 の 文",
    "gibberish": "zqx jkv wwx qqz " * 20,
    "keys": "asdf ghjk qwer zxcv",
    "one long word": "x" * 3000,
}


@pytest.fixture(scope="module")
def language_model(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0")
    return language_id.fit_on(docs, F.col("doc_id"), F.col("text"), F.col("lang"))


def test_foreign_text_is_rejected(spark, language_model):
    strange = spark.createDataFrame(list(FOREIGN.items()), "kind string, text string")
    found = {r["kind"]: r["lang_rejected"] for r in language_id.identify(strange, "text", language_model).collect()}
    assert found == {kind: True for kind in FOREIGN}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 and lang is not null")
    held = language_id.identify(docs, "text", language_model).where("lang_pred <> 'und'")
    assert held.agg(F.avg(F.col("lang_rejected").cast("int"))).first()[0] < 0.01


def test_short_texts_get_the_benefit_of_the_doubt(spark, language_model):
    short = spark.createDataFrame([("x",), ("the",), ("of",), ("le",), ("in the",)], "text string")
    found = language_id.identify(short, "text", language_model)
    assert found.agg(F.max(F.col("lang_rejected").cast("int"))).first()[0] == 0


def test_calibration_is_inside_its_bounds(language_model):
    assert language_id.TEMPERATURES[1] < language_model.temperature < language_id.TEMPERATURES[-2]
    assert 0 < language_model.least <= 0.5 and language_model.kept >= 0.99 and language_model.caught > 0.9


@pytest.mark.parametrize("n", [1, 2, 8, 20, 100])
def test_every_size_is_calibrated(n):
    """Rejection is calibrated whatever the number of texts; ten a language are enough to set gibberish apart."""
    english = "the weather in the city is fine and the people walk along the river with their friends".split()
    german = "das wetter in der stadt ist gut und die leute gehen mit ihren freunden am fluss entlang".split()
    rng = np.random.default_rng(n)
    pick = lambda words: " ".join(rng.permutation(words))
    texts, langs = [pick(german if i % 2 else english) for i in range(n)], ["de" if i % 2 else "en" for i in range(n)]
    model = language_id.fit(texts, langs)
    assert model.least > 0 and language_id.TEMPERATURES[0] <= model.temperature
    data = language_id.utf8(language_id.pa.array(["zqx jkv wwx qqz " * 20, pick(english)], language_id.pa.large_string()))
    chance = model.chance(model.judged(*language_id.subwords(*data), 2)[2])
    assert n < 20 or chance[0] < model.least <= chance[1]


def plain_scores(model, text):
    """Prediction, score and evidence by the definition, one subword at a time."""
    data = bytes(b if 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 else 32 for b in (text.lower() + " ").encode())
    rows, longer = [], []
    for n in language_id.GRAMS:
        for i in range(len(data) - n + 1):
            gram = data[i : i + n]
            if 32 in gram[1:-1] or gram in (b"  ",):
                continue
            code = n
            for b in gram:
                code = (code << 8 | b) % 2**64
            h = int(language_id.mix(np.array([code], np.uint64))[0]) >> (64 - language_id.SEEN_BITS)
            rows.append(model.table[h >> 3])
            longer += [h] if n >= language_id.LONG_GRAM else []
    logits = (sum(rows, np.zeros(len(model.languages))) / (len(rows) + 8) + model.bias) / model.temperature
    scores = np.exp(logits - logits.max()) / np.exp(logits - logits.max()).sum()
    best = int(scores.argmax())
    seen = sum(int(model.seen[0, h]) >> best & 1 for h in longer)
    return model.languages[best], scores[best], (seen + 6) / (len(longer) + 8)


def test_scores_equal_a_plain_recomputation(spark, language_model):
    texts = [r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").where("length(text) between 1 and 800").orderBy("doc_id").limit(25).collect()]
    texts += ["é", "a-b c", "  x  ", FOREIGN["russian"], FOREIGN["dutch"]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    for r in language_id.identify(df, "text", language_model).collect():
        lang, score, covered = plain_scores(language_model, r["text"])
        odds = np.log(max(score, 1e-9)) - np.log(max(1 - score, 1e-9))
        chance = 1 / (1 + np.exp(-np.array([1.0, covered, odds]) @ language_model.accept))
        if r["lang_pred"] != "und":
            assert (r["lang_pred"], r["lang_rejected"]) == (lang, bool(chance < language_model.least))
            assert r["lang_score"] == pytest.approx(score, abs=1e-9)


def test_expectation_maximisation_finds_accuracies():
    rng = np.random.default_rng(2)
    truth, skill = rng.random(20_000) < 0.7, np.array([0.95, 0.9, 0.8, 0.7, 0.6])
    votes = np.where(rng.random((20_000, 5)) < skill, truth[:, None], ~truth[:, None]).astype(int)
    votes[rng.random((20_000, 5)) < 0.2] = -1
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality_model.expectation_maximisation(patterns, counts.astype(float), rounds=500)
    assert np.abs(model.accuracy() - skill).max() < 0.03
    posterior = model.posterior(np.where(votes < 0, 2, votes))
    assert ((posterior > 0.5) == truth).mean() > 0.93


def test_quality_agrees_with_labels_it_never_saw(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = QUERIES["op6_quality_classifier"](spark, FOLDER).join(labels, "doc_id").collect()
    assert np.mean([r["kept"] for r in rows if r["quality"] == 1]) > 0.98
    assert np.mean([not r["kept"] for r in rows if r["quality"] == 0]) > 0.95


@pytest.mark.parametrize("kind", ["odd", "more"])
def test_quality_of_odd_documents(spark, folder, odd_rows, kind):
    rows = QUERIES["op6_quality_classifier"](spark, f"{folder}/{kind}").collect()
    assert len(rows) == len(odd_rows) and all(0 <= r["quality_score"] <= 1 for r in rows)
    assert QUERIES["op6_quality_classifier"](spark, f"{folder}/none").count() == 0
