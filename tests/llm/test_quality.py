import zlib

import numpy as np

from faresettle.llm import quality

LABELS = "doc_id long, quality int, toxic int, text string"


def fold(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_held_out_accuracy(sf):
    docs, labels = sf("documents", "0.1"), sf("labels", "0.1")
    out = quality.score_documents(docs, labels)
    marked = out.join(labels, "doc_id").where("held_out").toPandas()
    assert (marked["held_out"] == marked["doc_id"].map(fold)).all()
    good, bad = (marked.loc[marked["quality"] == q, "score"].to_numpy() for q in (1, 0))
    above = (good[:, None] > bad).mean() + 0.5 * (good[:, None] == bad).mean()
    right = (marked["predicted"] == marked["quality"]).mean()
    assert above > 0.97 and right > 0.95
    assert marked.loc[marked["quality"] == 1, "predicted"].mean() > 0.97


def test_risk_is_not_driven_below_zero():
    """Positives hidden among the unlabelled are called positive though they are never labelled so."""
    rng = np.random.default_rng(0)
    good, bad = rng.normal(2, 1, (2000, 5)), rng.normal(-2, 1, (2000, 5))
    unlabelled = np.concatenate([good[500:], bad])
    model = quality.fit(good[:500], unlabelled, prior=1500 / 3500)
    guess = quality._sigmoid(model._standard(unlabelled) @ model.weights + model.bias) >= 0.5
    assert guess[:1500].mean() > 0.95 and guess[1500:].mean() < 0.05


def test_labels_of_the_held_out_fold_are_not_used(spark, documents):
    rows = [(k, f"plain words number {k} go on and on") if k % 2 else (k, f"### {k} $$$ %%% &&&") for k in range(300)]
    labels = [(k, k % 2, 0, "x") for k in range(0, 240)]
    turned = [(k, 1 - k % 2 if fold(k) else k % 2, 1, "y") for k in range(0, 240)]
    one, other = (
        {r["doc_id"]: r["score"] for r in quality.score_documents(documents(rows), spark.createDataFrame(x, LABELS)).collect()} for x in (labels, turned)
    )
    assert one == other


def test_rows_of_every_kind(spark, documents):
    rows = [(k, f"plain words number {k} go on") for k in range(40)] + [(50, None), (51, ""), (None, "words"), (3, "repeated row"), (3, "repeated row"), (52, "a" * 300_000)]
    labels = spark.createDataFrame([(k, 1, 0, "x") for k in range(20)] + [(1, 0, 0, "x"), (None, 1, 1, None), (5, None, None, None), (2, 1, 1, "x")], LABELS)
    out = quality.score_documents(documents(rows), labels).collect()
    assert len(out) == len(rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out)
    assert len({r["score"] for r in out if r["doc_id"] in (50, 51)}) == 1
    assert [r["held_out"] for r in out if r["doc_id"] is None] == [False]
    assert quality.score_documents(documents([]), labels).count() == 0
    none = quality.score_documents(documents(rows), spark.createDataFrame([], LABELS)).collect()
    assert {r["score"] for r in none} == {0.5}
    kept = quality.keep_good(documents(rows), labels)
    assert kept.columns == documents(rows).columns


def test_features_cover_the_whole_text():
    text = "some words " * 5000
    assert (quality.features(text) != quality.features(text + "### $$$ %%%")).any()
    assert not quality.features(None).any() and not quality.features(" \n").any()


def test_labels_of_every_document(spark, documents):
    rows = [(k, f"plain words number {k} go on and on") if k % 2 else (k, f"### {k} $$$ %%% &&&") for k in range(300)]
    labels = spark.createDataFrame([(k, k % 2, 0, "x") for k in range(300)], LABELS)
    out = quality.score_documents(documents(rows), labels).collect()
    assert sum(r["predicted"] == r["doc_id"] % 2 for r in out) > 285
    assert {r["doc_id"] % 2 for r in quality.keep_good(documents(rows), labels).collect()} == {1}
