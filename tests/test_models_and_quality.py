import uuid
from decimal import Decimal

import pytest

from faresettle.catalog.queries import scratch_table
from faresettle.operators import export, quality
from faresettle.operators.setops import union_all
from faresettle.plans import models


def test_daily_rollup_keeps_null_totals(spark):
    sales = spark.sql("SELECT * FROM VALUES (date'2025-08-01', 1.50), (date'2025-08-01', 2.50), "
                      "(date'2025-08-02', NULL), (date'2025-08-02', NULL) AS t(date, amt)")
    rows = {r.date.isoformat(): (r.cnt, r.total_sales) for r in models.recent_sale(sales).collect()}
    assert rows == {"2025-08-01": (2, Decimal("4.00")), "2025-08-02": (2, None)}


def test_model_chain_as_table_and_view(spark):
    first = models.materialize(models.first_model(spark.range(1, 3).toDF("id")), scratch_table(spark), "table")
    second = models.materialize(models.second_model(first), f"second_{uuid.uuid4().hex}", "view")
    assert sorted(r.id for r in first.collect()) == [1, 2]
    assert [r.id for r in second.collect()] == [2]
    failures = quality.failing_models({"first": first, "second": second})
    assert {r.failures for r in failures.collect()} == {0}
    with pytest.raises(ValueError):
        models.materialize(first, "x", "index")


def test_unique_and_not_null(spark):
    frame = spark.createDataFrame([(1,), (2,), (2,), (None,), (None,)], "id int")
    assert [(r.id, r.n) for r in quality.not_unique(frame, "id").collect()] == [(2, 2)]
    assert quality.is_null(frame, "id").count() == 2
    assert models.first_model(frame, drop_null_ids=True).count() == 3
    failures = quality.failing_models({"m": frame, "empty": frame.limit(0)})
    assert {(r.model, r.test): r.failures for r in failures.collect()} == {
        ("m", "unique"): 1, ("m", "not_null"): 2, ("empty", "unique"): 0, ("empty", "not_null"): 0,
    }
    with pytest.raises(quality.DataTestFailed, match="unique"):
        quality.require(quality.not_unique(frame, "id"), "unique id")
    quality.require(quality.not_unique(frame.distinct(), "id"), "unique id")


def test_unions_are_positional(spark):
    left, right = spark.sql("SELECT 1 AS a, 2 AS b"), spark.sql("SELECT 1 AS x, 2 AS a")
    assert union_all([left, right]).columns == ["a", "b"]
    assert union_all([left, right]).count() == 2
    assert union_all([left, right]).distinct().collect() == [(1, 2)]


def test_preview(spark):
    frame = spark.range(100)
    assert [r.id for r in export.preview(frame, 2, "id").collect()] == [0, 1]
    assert export.preview(frame, 2).count() == 2
