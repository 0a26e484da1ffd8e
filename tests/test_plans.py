"""What the physical plans must and must not contain."""

import re
from dataclasses import replace

import pytest

from faresettle.catalog import bindings, queries
from faresettle.operators.classify import TicketCountryRule
from faresettle.operators.details import Details, vat_by_parent
from faresettle.operators.tables import aligned
from faresettle.plans.settlement import SettlementSources, keyed, settlement_report, with_details
from faresettle.session import Staging, runtime_filter_for

SF_DIR = "/root/testdata/sf0.001"


def explained(df, capsys, mode="formatted"):
    capsys.readouterr()
    df.explain(mode)
    return capsys.readouterr().out


@pytest.fixture(scope="module")
def lake(spark):
    """The source tables as files of their own."""
    sources = bindings.settlement_sources(spark, SF_DIR)
    with Staging(spark) as staging:
        staged = {name: staging.write(df, name) for name, df in sources.__dict__.items()}
        tickets = staging.write(bindings.dom_int_stand_in(spark, SF_DIR).tickets, "tickets")
        yield SettlementSources(**staged), TicketCountryRule(tickets)


@pytest.fixture()
def without_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_only_the_counted_parameter_rows_are_broadcast(lake, without_broadcast, capsys):
    plan = explained(settlement_report(lake[0], queries.MONTH_WINDOW, lake[1]), capsys, "simple")
    assert "SortMergeJoin" in plan
    for node in ("CartesianProduct", "Python", "_slot"):
        assert node not in plan
    assert plan.count("BroadcastNestedLoopJoin") == plan.count("BroadcastExchange") == 1


def test_parameters_of_unknown_size_move_no_facts(spark, lake, without_broadcast, capsys):
    """A table whose size Spark can't tell, as from a database, is broadcast all the same; facts are summed before they meet it."""
    unknown = spark.createDataFrame(lake[0].para.rdd, lake[0].para.schema)
    plan = explained(settlement_report(replace(lake[0], para=unknown), queries.MONTH_WINDOW, lake[1]), capsys, "simple")
    join = plan.index("BroadcastNestedLoopJoin")
    assert re.search(r"HashAggregate\(keys=\[Type", plan[join:])


def test_too_many_parameter_rows_are_refused(spark, lake):
    many = spark.range(1001).selectExpr("CAST(id AS INT) AS isoc", "'KRW' AS cutp")
    with pytest.raises(ValueError, match="1000"):
        settlement_report(replace(lake[0], para=many), queries.MONTH_WINDOW, lake[1])


def test_window_and_codes_reach_the_scans(lake, capsys):
    plan = explained(settlement_report(lake[0], queries.MONTH_WINDOW, lake[1]), capsys)
    pushed = "\n".join(re.findall(r"PushedFilters: .*", plan))
    for filter_text in ("GreaterThanOrEqual(dais,1998-08-01)", "LessThanOrEqual(daut,1998-08-31)", "EqualTo(tmft,YR)",
                        "In(vat_type, [FA,TA])"):
        assert filter_text in pushed


def test_scans_read_only_what_they_need(lake, capsys):
    plan = explained(vat_by_parent(lake[0].payt_vatc, "payt_sqnu"), capsys)
    assert "vat_type_deta" in plan
    payments = explained(settlement_report(lake[0], queries.MONTH_WINDOW, lake[1]), capsys)
    issue_scans = [s for s in re.findall(r"ReadSchema: struct<(.*)>", payments) if s.startswith("tdnr:bigint,dais")]
    assert issue_scans == ["tdnr:bigint,dais:date"]


def test_details_are_summed_before_their_shuffle(lake, without_broadcast, capsys):
    details = Details(lake[0].payt_vatc, lake[0].payt_txca, "payt_sqnu").lines()
    plan = explained(details.add_to(lake[0].payt.select("sqnu"), "sqnu"), capsys, "simple")
    assert plan.count("partial_sum(") >= 6
    # payments once, VAT sums once, tax sums once: the joins reuse those partitionings
    assert plan.count("Exchange hashpartitioning") == 3


@pytest.fixture()
def every_scan_is_large(spark):
    key = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "0")
    yield
    spark.conf.set(key, before)


def filtered_columns(plan):
    return set(re.findall(r"might_contain\(Subquery [^,]*, \[[^]]*\], xxhash64\((\w+)#", plan))


def test_runtime_filter_prunes_the_payment_scan(lake, without_broadcast, every_scan_is_large, capsys):
    """At scale the in-window tickets filter the payment scan before its shuffle."""
    plan = explained(settlement_report(lake[0], queries.MONTH_WINDOW, lake[1]), capsys, "simple")
    assert "tdnr" in filtered_columns(plan)


@pytest.mark.parametrize("parents", [1_000, 6_000_000, 50_000_000])
def test_details_are_filtered_at_any_number_of_parents(spark, lake, without_broadcast, every_scan_is_large, capsys, parents):
    """The filter on the detail scans is made for the parents there are, up to the 8 MB that one task can merge."""
    details = Details(lake[0].payt_vatc, lake[0].payt_txca, "payt_sqnu").lines()
    with Staging(spark) as staging, runtime_filter_for(spark, parents):
        headers = staging.write(keyed(lake[0].payt.select("sqnu"), queries.MONTH_WINDOW), "headers")
        plan = explained(with_details(headers, details, queries.MONTH_WINDOW), capsys, "simple")
    assert "payt_sqnu" in filtered_columns(plan)
    sizes = {tuple(map(int, s)) for s in re.findall(r"bloom_filter_agg\(xxhash64\([^)]*\), (\d+), (\d+)", plan)}
    assert sizes == {(parents, min(10 * parents, 2**26))}


def test_filter_settings_are_put_back(spark):
    key = "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems"
    before = spark.conf.get(key)
    with pytest.raises(RuntimeError), runtime_filter_for(spark, 77):
        assert spark.conf.get(key) == "77"
        raise RuntimeError
    assert spark.conf.get(key) == before


def test_loads_gather_rows_by_day(spark, table, capsys):
    """One day's rows meet in few tasks, and Spark may split a large day."""
    rows = spark.table(table)
    plan = explained(aligned(rows, table), capsys, "simple")
    assert re.search(r"Exchange hashpartitioning\(TrxDate#.*REBALANCE_PARTITIONS_BY_COL", plan)
