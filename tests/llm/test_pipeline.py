import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from faresettle.llm import decontaminate, pieces, quality, secrets, simhash
from faresettle.llm.staging import drop_staged, stage

ROOT = Path(__file__).parents[2]
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before the first stage and after each."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs)
    for name, run in corpus_pipeline.STAGES:
        docs = stage(run(spark, docs, SF), name)
        out.append(docs)
    return out


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "sentencepiece_encoding",
    ]


def test_all_but_the_last_return_documents(stages):
    for before in stages[1:-1]:
        assert before.schema.simpleString() == stages[0].schema.simpleString()


def test_classifier_stage(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scores = quality.score_documents(stages[0], labels)
    good = {r["doc_id"] for r in scores.where("predicted = 1").collect()}
    assert {r["doc_id"] for r in stages[1].collect()} == good
    clean = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    assert len(clean & good) > 0.95 * len(clean)


def test_dedup_stage(stages):
    before = simhash.near_duplicates(stages[1])
    kept = sorted(r["doc_id"] for r in stages[2].collect())
    assert kept == sorted({r["component_id"] for r in before.collect()})
    assert stages[2].exceptAll(stages[1]).count() == 0


def test_decontamination_stage(spark, stages):
    leaks = {r["doc_id"] for r in decontaminate.find_leaks(stages[2], spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert leaks
    assert {r["doc_id"] for r in stages[3].collect()} == {r["doc_id"] for r in stages[2].collect()} - leaks


def test_secrets_stage(stages):
    before = {r["doc_id"]: r["text"] for r in stages[3].collect()}
    after = {r["doc_id"]: r for r in stages[4].collect()}
    assert {i: r["text"] for i, r in after.items()} == {i: secrets.redact(t) for i, t in before.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in after.values())
    assert any("[SECRET]" in r["text"] for r in after.values())


def test_encoding_stage(stages):
    back = pieces.decode_documents(stages[5])
    assert back.exceptAll(stages[4].select("doc_id", "text")).count() == 0
    assert back.count() == stages[4].count()


def test_run_is_its_stages(spark, stages):
    out = corpus_pipeline.run(spark, SF)
    assert out.exceptAll(stages[5]).count() == 0 == stages[5].exceptAll(out).count()


def test_empty_documents(spark, stages):
    docs = stages[0].limit(0)
    for name, run in corpus_pipeline.STAGES:
        docs = stage(run(spark, docs, SF), name)
    assert docs.count() == 0


def test_staged_folders_are_dropped(spark, tmp_path):
    rows = stage(spark.range(5).toDF("x"), "gone")
    path = rows.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    assert Path(path).exists()
    from faresettle.llm import staging

    held = staging._STAGED[spark.sparkContext.applicationId]
    own, others = [p for p in held if "-gone-" in p], [p for p in held if "-gone-" not in p]
    staging._STAGED[spark.sparkContext.applicationId] = own
    assert drop_staged(spark) == len(own) and not Path(path).exists()
    staging._STAGED[spark.sparkContext.applicationId] = others


def test_nothing_else_imports_the_subpackage():
    for path in (ROOT / "faresettle").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert not re.search(r"faresettle\.llm|from \.+llm|import llm", path.read_text()), path
    for path in (ROOT / "faresettle" / "llm").rglob("*.py"):
        assert "localCheckpoint" not in path.read_text() and "except ImportError" not in path.read_text()


def test_rows_of_every_kind_pass_all_stages(spark, sf, tmp_path):
    """Nulls, repeats, ids of two texts, a very long text and clashing names; each stage is held against its operator."""
    names = ["_id", "_row", "bits", "root", "component_id", "n", "score", "word", "held_out", "ids", "quality"]
    docs = sf("documents")
    long = " ".join(r["text"] for r in docs.limit(40).collect() if r["text"]) * 10
    schema = docs.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ")
    first = docs.where("length(text) > 200").first()["text"]
    odd = [
        (None, None, None, None, None), (None, "", "en", "s", 0), (None, first, "en", "s", 1), (None, first, "en", "s", 1), (90001, first, "en", "s", 1),
        (90002, first + " and more of it", "en", "s", 1), (90002, "Another text of the same id.", "en", "s", 1), (90003, long, "en", "s", 1), (90003, long, "en", "s", 1),
        (90004, "x" * 50_000, "en", "s", 1), (90005, None, "en", "s", 0),
    ]
    whole = docs.unionByName(spark.createDataFrame(odd, schema))
    for k, name in enumerate(names):
        whole = whole.withColumn(name, F.lit(str(k)))
    whole.write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("labels", "benchmark"):
        (tmp_path / f"{name}.parquet").symlink_to(f"/root/testdata/sf0.001/{name}.parquet")
    columns, before = whole.columns, stage(spark.read.parquet(str(tmp_path / "documents.parquet")), "odd")
    labels = spark.read.parquet(str(tmp_path / "labels.parquet"))
    expected = [
        lambda d: quality.score_documents(d, labels).where("predicted = 1").count(),
        lambda d: len({(r["component_id"],) for r in simhash.near_duplicates(d).select("component_id").collect()}),
        lambda d: d.count() - decontaminate.find_leaks(d, spark.read.parquet(str(tmp_path / "benchmark.parquet"))).select("doc_id").distinct().count(),
        lambda d: d.count(),
        lambda d: d.count(),
    ]
    for (name, run), n in zip(corpus_pipeline.STAGES, expected):
        after = stage(run(spark, before, str(tmp_path)), name)
        assert after.count() == n(before), name
        if name != "sentencepiece_encoding":
            assert after.columns == columns
            before = after
    assert after.select("ids").where("ids IS NULL").count() == 0
