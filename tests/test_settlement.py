"""The report on small tables, against nested loops in plain Python."""

import random
from collections import Counter, defaultdict
from dataclasses import replace
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from faresettle.functions.windows import DateWindow
from faresettle.operators import quality
from faresettle.operators.classify import ExpressionRule, TicketCountryRule
from faresettle.plans.contract import BASE_MEASURES, REPORT_COLUMNS
from faresettle.plans.settlement import (
    SettlementSources,
    collapsed_groups,
    in_report_order,
    net_total,
    settlement_report,
)
from faresettle.session import Staging

WINDOW = DateWindow.of("2025-08-01", "2025-08-31")
MONEY = "decimal(18,2)"
SCHEMAS = {
    "payt": "sqnu long, tdnr string, peri string, fptp string, cuop string, "
    + ", ".join(f"{c} {MONEY}" for c in "fpam fpaf fptx fptf cort_coam cort_coaf cort_spam cort_spaf vatc vatf".split()),
    "emis": "tdnr string, srci string, dais date",
    "para": "isoc string, cutp string",
    "payt_vatc": f"payt_sqnu long, vat_type string, vat_type_deta string, vatc {MONEY}, vatf {MONEY}",
    "payt_txca": f"payt_sqnu long, tmft string, tmfa {MONEY}, tmff {MONEY}",
    "rmbt": "sqnu long, utnr string, peri string, daut date, srci string, fptp string, cutp string, "
    + ", ".join(f"{c} {MONEY}" for c in "cpvl cpvf tmfa tmff cort_coam cort_coaf cort_spam cort_spaf vatc vatf".split()),
    "rmbt_vatc": f"rmbt_id long, vat_type string, vat_type_deta string, vatc {MONEY}, vatf {MONEY}",
    "rmbt_txca": f"rmbt_id long, tmft string, tmfa {MONEY}, tmff {MONEY}",
}
RULE = ExpressionRule(lambda ticket, isoc: F.when(F.substring(ticket, 1, 1) == isoc, "D").otherwise("I"))


def label(ticket, isoc):
    return "D" if ticket is not None and isoc is not None and ticket[:1] == isoc else "I"


def columns_of(name):
    return [part.strip().split(" ")[0] for part in SCHEMAS[name].replace("(18,2)", "").split(",")]


def frames(spark, tables):
    return SettlementSources(
        **{
            name: spark.createDataFrame([tuple(row.get(c) for c in columns_of(name)) for row in tables.get(name, [])], schema)
            for name, schema in SCHEMAS.items()
        }
    )


def brute_force(tables, window=WINDOW):
    """Row-level joins and sums, exactly as the report defines them."""
    zero = Decimal(0)
    details = {}
    for vat, tax, parent in (("payt_vatc", "payt_txca", "payt_sqnu"), ("rmbt_vatc", "rmbt_txca", "rmbt_id")):
        sums = defaultdict(lambda: defaultdict(Decimal))
        for row in tables.get(vat, []):
            bucket = None
            if row.get("vat_type") == "FA":
                bucket = ("vatcf", "vatff")
            elif row.get("vat_type") == "TA" and "ITYR" in (row.get("vat_type_deta") or ""):
                bucket = ("vatcyr", "vatfyr")
            if bucket and row[parent] is not None:
                sums[row[parent]][bucket[0]] += row.get("vatc") or zero
                sums[row[parent]][bucket[1]] += row.get("vatf") or zero
        for row in tables.get(tax, []):
            if row.get("tmft") == "YR" and row[parent] is not None:
                sums[row[parent]]["yr_tmfa"] += row.get("tmfa") or zero
                sums[row[parent]]["yr_tmff"] += row.get("tmff") or zero
        details[parent] = sums
    groups = defaultdict(lambda: defaultdict(Decimal))

    def add(kind, branch, header, source, day, ticket, ccy, sums):
        values = {**header, **sums.get(header["sqnu"], {})}
        for para in tables.get("para") or [{"isoc": None, "cutp": None}]:
            key = (kind, source, header.get("peri"), day, label(ticket, para["isoc"]), header.get("fptp"), ccy,
                   para["isoc"], para["cutp"])
            for m in BASE_MEASURES:
                tx, coa = getattr(m, branch)
                groups[key][m.name] += values.get(tx) or zero
                groups[key][m.coa_name] += values.get(coa) or zero

    for p in tables.get("payt", []):
        for e in tables.get("emis", []):
            if e["tdnr"] is not None and e["tdnr"] == p["tdnr"] and window.start <= e["dais"] <= window.end:
                add("Sale", "sale", p, e["srci"], e["dais"], p["tdnr"], p.get("cuop"), details["payt_sqnu"])
    for r in tables.get("rmbt", []):
        if window.start <= r["daut"] <= window.end:
            add("Refund", "refund", r, r.get("srci"), r["daut"], r["utnr"], r.get("cutp"), details["rmbt_id"])

    rows = []
    for (kind, source, peri, day, dom, fop, ccy, _, cutp), sums in groups.items():
        row = {"Type": kind, "Source": source, "RptPeriod": peri, "TrxDate": day.isoformat(), "DomInt": dom,
               "FOP": fop, "CCY": ccy, "COA": cutp}
        for suffix, fare_vat in (("", "Vatf"), ("_COA", "VatFare_COA")):
            sign = -1 if kind == "Refund" else 1
            v = {m.name: sign * sums[m.coa_name if suffix else m.name] for m in BASE_MEASURES}
            v["TotalCom"] = v["StdCom"] + v["SupplCom"]
            v["DiscFareNetVAT"] = v["Fare"] - v["SupplCom"] - v["Vatf"]
            v["YRNetVAT"] = v["YR"] - v["VatYR"]
            v["Net"] = v["Fare"] + v["Tax"] - v["StdCom"] - v["SupplCom"] - v["VatCom"]
            row.update({fare_vat if name == "Vatf" else name + suffix: value for name, value in v.items()})
        rows.append(tuple(row[c] for c in REPORT_COLUMNS))
    return rows


def collected(report):
    return Counter(tuple(row) for row in report.collect())


def check(spark, tables, staging=(None, None)):
    sources = frames(spark, tables)
    expected = brute_force(tables)
    assert collected(settlement_report(sources, WINDOW, RULE, distinct=False, staging=staging[0])) == Counter(expected)
    assert collected(settlement_report(sources, WINDOW, RULE, staging=staging[1])) == Counter(set(expected))
    return expected


def payment(sqnu, ticket, fare="10.00", **more):
    return {"sqnu": sqnu, "tdnr": ticket, "peri": "202508", "fptp": "CA", "cuop": "KRW", "fpam": Decimal(fare),
            "fpaf": Decimal(fare) * 2, **more}


def issue(ticket, day=5, source="S1", month=8):
    return {"tdnr": ticket, "srci": source, "dais": date(2025, month, day)}


def refund(sqnu, ticket, value="4.00", day=6, **more):
    return {"sqnu": sqnu, "utnr": ticket, "peri": "202508", "daut": date(2025, 8, day), "srci": "S1", "fptp": "CA",
            "cutp": "KRW", "cpvl": Decimal(value), "cpvf": Decimal(value), **more}


ONE = [{"isoc": "A", "cutp": "KRW"}]


def fares(rows):
    return sorted(row[REPORT_COLUMNS.index("Fare")] for row in rows)


def test_payment_without_issue_in_window_vanishes(spark):
    rows = check(spark, {
        "payt": [payment(1, "A1"), payment(2, "A2"), payment(3, None), payment(4, "A4")],
        "emis": [issue("A1"), issue("A4", month=7), issue(None)], "para": ONE})
    assert fares(rows) == [Decimal("10.00")]


def test_equal_issue_rows_double_the_amounts(spark):
    rows = check(spark, {"payt": [payment(1, "A1")], "emis": [issue("A1"), issue("A1")], "para": ONE})
    assert fares(rows) == [Decimal("20.00")]


def test_details_do_not_multiply_the_payment(spark):
    vat = [{"payt_sqnu": 1, "vat_type": "FA", "vat_type_deta": None, "vatc": Decimal(v), "vatf": Decimal(1)} for v in (1, 2, 3)]
    rows = check(spark, {"payt": [payment(1, "A1")], "emis": [issue("A1")], "para": ONE, "payt_vatc": vat})
    assert rows[0][REPORT_COLUMNS.index("Vatf")] == 6
    assert fares(rows) == [Decimal("10.00")]


def test_without_parameter_row_payments_stay(spark):
    rows = check(spark, {"payt": [payment(1, "A1")], "emis": [issue("A1")], "rmbt": [refund(1, "A1")]})
    assert {row[REPORT_COLUMNS.index("COA")] for row in rows} == {None}
    assert len(rows) == 2


def test_equal_parameter_rows_multiply_the_amounts(spark):
    rows = check(spark, {"payt": [payment(1, "A1")], "emis": [issue("A1")], "para": ONE * 3})
    assert fares(rows) == [Decimal("30.00")]


def test_groups_that_look_alike_collapse(spark):
    tables = {"payt": [payment(1, "X1")], "emis": [issue("X1")],
              "para": [{"isoc": "A", "cutp": "SET"}, {"isoc": "B", "cutp": "SET"}]}
    assert len(check(spark, tables)) == 2
    collapsed = collapsed_groups(frames(spark, tables), WINDOW, RULE).collect()
    assert [row["groups"] for row in collapsed] == [2]


def test_null_details_and_case(spark):
    vat = [
        {"payt_sqnu": 1, "vat_type": "FA", "vatc": None, "vatf": None},
        {"payt_sqnu": 1, "vat_type": "TA", "vat_type_deta": None, "vatc": Decimal(7)},
        {"payt_sqnu": 1, "vat_type": "TA", "vat_type_deta": "ityr", "vatc": Decimal(8)},
        {"payt_sqnu": 1, "vat_type": "TA", "vat_type_deta": "K-ITYR", "vatc": Decimal(9)},
        {"payt_sqnu": None, "vat_type": "FA", "vatc": Decimal(5)},
        {"payt_sqnu": 1, "vat_type": "FA ", "vatc": Decimal(6)},
    ]
    rows = check(spark, {"payt": [payment(1, "A1", fare="0", cort_spam=None)], "emis": [issue("A1")], "para": ONE, "payt_vatc": vat})
    shown = dict(zip(REPORT_COLUMNS, rows[0]))
    assert (shown["Vatf"], shown["VatYR"], shown["SupplCom"]) == (0, 9, 0)


def test_refunds_are_negative(spark):
    rows = check(spark, {"rmbt": [refund(1, "A1", vatc=Decimal(1), tmfa=Decimal(2))], "para": ONE,
                         "rmbt_txca": [{"rmbt_id": 1, "tmft": "YR", "tmfa": Decimal(3)}, {"rmbt_id": 1, "tmft": "XT", "tmfa": Decimal(9)}]})
    shown = dict(zip(REPORT_COLUMNS, rows[0]))
    assert (shown["Fare"], shown["Tax"], shown["YR"], shown["Net"]) == (-4, -2, -3, -5)


def random_tables(seed):
    """Small tables with repeated keys, nulls, and one ticket with a third of all rows."""
    rng = random.Random(seed)
    amount = lambda: None if rng.random() < 0.15 else Decimal(rng.randint(-500, 5000)) / 100
    ticket = lambda: "A-hot" if rng.random() < 0.34 else rng.choice([None, "A1", "A2", "B1", "B2", "C1"])
    code = lambda *values: rng.choice([None, *values])
    header = lambda names: {name: amount() for name in names.split()}
    details = lambda parent, ids: {
        "vat": [{parent: 1 if rng.random() < 0.34 else rng.choice([None, *ids]), "vat_type": code("FA", "TA", "ZZ"),
                 "vat_type_deta": code("K-ITYR-1", "ITYR", "ityr", ""), "vatc": amount(), "vatf": amount()} for _ in range(60)],
        "tax": [{parent: 1 if rng.random() < 0.34 else rng.choice([None, *ids]), "tmft": code("YR", "XT"),
                 "tmfa": amount(), "tmff": amount()} for _ in range(40)],
    }
    ids = range(1, 31)
    payment_details, refund_details = details("payt_sqnu", ids), details("rmbt_id", ids)
    day = lambda: date(2025, rng.choice([7, 8, 8, 8, 9]), rng.randint(1, 28))
    return {
        "payt": [{"sqnu": n, "tdnr": ticket(), "peri": code("202508"), "fptp": code("CA", "CC"), "cuop": code("KRW", "USD"),
                  **header("fpam fpaf fptx fptf cort_coam cort_coaf cort_spam cort_spaf vatc vatf")} for n in ids],
        "emis": [{"tdnr": ticket(), "srci": code("S1", "S2"), "dais": day()} for _ in range(30)],
        "para": [rng.choice([{"isoc": "A", "cutp": "SET"}, {"isoc": "B", "cutp": "SET"}, {"isoc": None, "cutp": None}])
                 for _ in range(rng.randint(0, 4))],
        "payt_vatc": payment_details["vat"], "payt_txca": payment_details["tax"],
        "rmbt": [{"sqnu": n, "utnr": ticket(), "peri": code("202508"), "daut": day(), "srci": code("S1"), "fptp": code("CA"),
                  "cutp": code("KRW"), **header("cpvl cpvf tmfa tmff cort_coam cort_coaf cort_spam cort_spaf vatc vatf")} for n in ids],
        "rmbt_vatc": refund_details["vat"], "rmbt_txca": refund_details["tax"],
    }


@pytest.mark.parametrize("seed", range(6))
def test_random_tables_match_nested_loops(spark, seed):
    check(spark, random_tables(seed))


def test_staged_headers_give_the_same_report(spark):
    with Staging(spark) as one, Staging(spark) as two:
        check(spark, random_tables(7), [one, two])


def test_staged_headers_without_broadcast_give_the_same_report(spark):
    """With the runtime filter in the plan, whatever the size of the scans."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    before = {key: spark.conf.get(key) for key in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        with Staging(spark) as one, Staging(spark) as two:
            check(spark, random_tables(8), [one, two])
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_large_parameter_table_without_broadcast(spark):
    """The parameters are broadcast by their count, whatever the threshold."""
    tables = random_tables(9)
    tables["para"] = [{"isoc": chr(65 + n % 26), "cutp": f"C{n % 40}"} for n in range(200)]
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        check(spark, tables)
    finally:
        spark.conf.set(key, before)


def test_ticket_lookup_rule(spark):
    tables = {"payt": [payment(1, "T1"), payment(2, "T2"), payment(3, "T3")], "emis": [issue("T1"), issue("T2"), issue("T3")], "para": ONE}
    lookup = spark.createDataFrame([("T1", "A"), ("T1", "A"), ("T2", "B")], "ticket string, country string")
    report = settlement_report(frames(spark, tables), WINDOW, TicketCountryRule(lookup))
    assert {(r.DomInt, r.Fare) for r in report.collect()} == {("D", Decimal(10)), ("I", Decimal(20))}


def test_month_equals_the_union_of_its_days(spark):
    sources = frames(spark, random_tables(11))
    month = collected(settlement_report(sources, WINDOW, RULE))
    days = Counter()
    for day in sorted({row[REPORT_COLUMNS.index("TrxDate")] for row in month}):
        days += collected(settlement_report(sources, DateWindow.of(day, day), RULE))
    assert month == days


def test_time_of_day_is_a_group_of_its_own(spark):
    """Days that carry a time form groups that look alike as text, and those
    after midnight of the last day are outside."""
    sources = frames(spark, {"payt": [payment(1, "A1"), payment(2, "A2"), payment(3, "A3")], "para": ONE})
    emis = spark.createDataFrame(
        [("A1", "S1", datetime(2025, 8, 5, 10)), ("A2", "S1", datetime(2025, 8, 5, 11)), ("A3", "S1", datetime(2025, 8, 31, 10))],
        "tdnr string, srci string, dais timestamp")
    sources = SettlementSources(**{**sources.__dict__, "emis": emis, "rmbt": sources.rmbt.withColumn("daut", F.col("daut").cast("timestamp"))})
    assert settlement_report(sources, WINDOW, RULE, distinct=False).count() == 2
    assert settlement_report(sources, WINDOW, RULE).count() == 1


def test_raw_date_variant_and_order(spark):
    tables = {"payt": [payment(1, "A1")], "emis": [issue("A1")], "rmbt": [refund(1, "A1")], "para": ONE}
    raw = settlement_report(frames(spark, tables), WINDOW, RULE, date_as_text=False)
    assert dict(raw.dtypes)["TrxDate"] == "date"
    assert [r.Type for r in in_report_order(raw).collect()] == ["Sale", "Refund"]


def test_identities_and_net_total(spark):
    report = settlement_report(frames(spark, random_tables(12)), WINDOW, RULE)
    assert quality.broken_identities(report).isEmpty()
    total = sum(row.DiscFareNetVAT_COA for row in report.collect())
    assert net_total(report).first().net == total
    spoiled = report.withColumn("Net", F.col("Net") + 1)
    assert quality.broken_identities(spoiled).count() == report.count()
    summary = {row.identity: row.broken for row in quality.identity_summary(spoiled).collect()}
    assert summary["Net"] == report.count() and summary["Net_COA"] == 0


LARGEST = Decimal("9999999999999999.99")


def test_largest_amounts_are_summed_exactly(spark):
    tables = {
        "payt": [payment(k, f"A{k % 3}", str(LARGEST if k % 3 else -LARGEST), fpaf=-LARGEST, vatc=LARGEST, vatf=Decimal("-0.01")) for k in range(1, 30)],
        "emis": [issue(f"A{k}") for k in range(3) for _ in range(1 + 700 * k)],
        "payt_vatc": [{"payt_sqnu": 1 + k % 7, "vat_type": "FA", "vatc": LARGEST, "vatf": -LARGEST} for k in range(40)],
        "rmbt": [refund(k, f"B{k}", str(-LARGEST)) for k in range(20)],
        "rmbt_txca": [{"rmbt_id": k % 4, "tmft": "YR", "tmfa": LARGEST, "tmff": Decimal("-1.01")} for k in range(30)],
        "para": ONE,
    }
    check(spark, tables)


def test_amounts_are_summed_in_whole_numbers(spark, capsys):
    """Sums of decimals, at some microseconds a row and column, took most of the report's time."""
    report = settlement_report(frames(spark, {"para": ONE}), WINDOW, RULE)
    report.explain("formatted")
    plan = capsys.readouterr().out
    first = [line for line in plan.splitlines() if "partial_sum(" in line]
    whole = [line for line in first if "shiftright" in line or "_high" in line]
    # Details of payments and refunds, payments by ticket, facts; last the weighted sums of the groups.
    assert len(whole) == 6 and len(first) == 7


def test_wider_amounts_are_summed_as_they_are(spark):
    tables = {"payt": [payment(1, "A1", "1.25"), payment(2, "A1", "2.50")], "emis": [issue("A1"), issue("A1")], "para": ONE}
    sources = frames(spark, tables)
    wide = {c: F.col(c).cast("decimal(30,4)") for c in ("fpam", "fpaf")}
    rows = settlement_report(replace(sources, payt=sources.payt.withColumns(wide)), WINDOW, RULE).collect()
    assert Counter(map(tuple, rows)) == Counter(brute_force(tables))
