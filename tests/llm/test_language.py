import zlib

import numpy as np
import pytest

from faresettle.llm import language

SCHEMA = "doc_id long, text string, lang string, source string, score string, o string, n string, rank string, best string"
WORDS = {
    "en": "the and of with this that there house water think where light".split(),
    "de": "der und von mit dieser das haus wasser denken straße größe licht".split(),
    "fr": "le et de avec cette maison eau penser où lumière déjà élève".split(),
}


def rows_of(n, seed=3):
    rng = np.random.default_rng(seed)
    return [(i, " ".join(rng.choice(WORDS[lang], rng.integers(5, 40)).tolist()), lang) for i in range(n) for lang in [list(WORDS)[rng.integers(3)]]]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", "x", "x", "x", "x", "x") for r in rows], SCHEMA)


def is_held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 4 == 2


def test_held_out_texts_get_their_language(spark):
    rows = rows_of(600)
    out = {r["doc_id"]: r for r in language.identify(frame(spark, rows)).collect()}
    assert len(out) == 600
    assert all(out[i]["held_out"] == is_held(i) and 0 <= out[i]["score"] <= 1 for i, _, _ in rows)
    held = [(out[i]["lang_pred"], lang) for i, _, lang in rows if is_held(i)]
    assert len(held) > 100 and sum(a == b for a, b in held) / len(held) > 0.98


def test_held_out_table(sf):
    docs = sf("documents", "0.01")
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    out = language.identify(docs).collect()
    held = [r for r in out if r["held_out"]]
    assert len(out) == len(truth) and len(held) > 150
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.95


def test_held_out_languages_and_other_columns_change_nothing(spark):
    rows = rows_of(200)
    first = sorted(map(tuple, language.identify(frame(spark, rows)).collect()))
    lied = [(i, t, "xx" if is_held(i) else lang) for i, t, lang in rows]
    assert sorted(map(tuple, language.identify(frame(spark, lied).withColumn("source", language.F.lit("t"))).collect())) == first


def test_rows_of_every_kind(spark):
    rows = rows_of(120) + [(1000, None, "en"), (1001, "", "en"), (1002, "12 34 ²!", "en"), (None, "der und das haus", None), (None, "der und das haus", "de"), (None, "der und das haus", "de")]
    rows += [(1003, "maison eau " * 200_000, "fr"), (1004, "é", None)]
    out = language.identify(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    by_id = {r["doc_id"]: r for r in out}
    assert [(by_id[i]["lang_pred"], by_id[i]["score"]) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert by_id[1003]["lang_pred"] == "fr" and by_id[1004]["lang_pred"] in WORDS
    assert [r["lang_pred"] for r in out if r["doc_id"] is None] == ["de"] * 3


@pytest.mark.parametrize("rows", [[], [(1, "text", None)], [(1, None, "en"), (2, "?", "en")]])
def test_nothing_to_learn(spark, rows):
    out = language.identify(frame(spark, rows)).collect()
    assert [(r["doc_id"], r["lang_pred"], r["score"]) for r in out] == [(i, "und", 0.0) for i, _, _ in rows]


def test_one_language(spark):
    out = language.identify(frame(spark, [(i, "some words", "en") for i in range(8)])).collect()
    assert {(r["lang_pred"], r["score"]) for r in out} == {("en", 1.0)}


def test_document_counts_cover_all(spark, sf):
    docs = sf("documents").where("text IS NOT NULL").select("text")
    counts, n = language.document_counts(docs)
    expected = np.zeros(language.BUCKETS, np.int64)
    texts = [r["text"] for r in docs.collect()]
    for text in texts:
        seen = np.unique(np.concatenate(list(language.grams(language.points(text)))))
        expected[seen] += 1
    assert n == len(texts) and (counts == expected).all()


@pytest.mark.parametrize("lot", [50, 1 << 20])
def test_logits_are_products_of_tfidf_and_weights(monkeypatch, lot):
    monkeypatch.setattr(language, "LOT", lot)
    rng = np.random.default_rng(5)
    idf, weights = rng.random(language.BUCKETS), rng.standard_normal((language.BUCKETS, 3))
    model = language.LanguageModel(("a", "b", "c"), idf, weights, np.array([0.1, 0.2, 0.3]))
    texts = ["", "a", "ab", "Ünd so weiter und so fort", "x" * 300, "", "ab cd ef " * 40]
    got = model.logits(texts)
    for text, row in zip(texts, got):
        buckets, values = language.vector(text, idf)
        assert np.allclose(row, values @ weights[buckets] + model.bias, atol=1e-5)


def test_weights_are_sparse_and_temperature_lowers_the_loss(spark):
    rows = rows_of(400)
    model = language.train(frame(spark, rows))
    assert 0 < (model.weights != 0).sum() < 0.2 * model.weights.size
    texts, labels = [t for _, t, _ in rows], np.array([model.langs.index(lang) for _, _, lang in rows])
    plain = language.LanguageModel(model.langs, model.idf, model.weights, model.bias)

    def loss(m):
        return -np.log(m.probabilities(texts)[np.arange(len(labels)), labels]).mean()

    assert loss(language.calibrated(plain, texts, labels)) <= loss(plain)


def test_rare_languages_are_learned(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE", 100)
    rows = rows_of(900) + [(5000 + i, "yksi kaksi kolme neljä viisi " * 3, "fi") for i in range(12)]
    out = language.identify(frame(spark, rows)).collect()
    assert all(r["lang_pred"] == "fi" for r in out if r["doc_id"] >= 5000)
