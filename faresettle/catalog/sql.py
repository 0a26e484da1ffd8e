"""Check SQL for the registered queries, in DuckDB's dialect.

Written against the driver tables independently of the Spark plans: row-level
facts first, one grouping after, amounts as DECIMAL(18,2) until the last step.
"""

from __future__ import annotations

from faresettle.operators.roster import GREETING
from faresettle.plans.contract import MEASURES
from faresettle.sources.payloads import DEFAULT_NUMBER, DEFAULT_PEOPLE

MONTH = ("1998-08-01", "1998-08-31")
WEEK = ("1998-08-19", "1998-08-25")
DAY_IN_NEXT_WEEK = "1998-08-27"

_HEADER_AMOUNTS = """
    CAST(o_totalprice AS DECIMAL(18,2)) AS price,
    CAST(o_orderkey % 97 AS DECIMAL(18,2)) AS tax,
    CAST(o_orderkey % 31 AS DECIMAL(18,2)) AS std,
    CAST(NULLIF(o_orderkey % 13, 0) AS DECIMAL(18,2)) AS suppl,
    CAST(o_orderkey % 7 AS DECIMAL(18,2)) AS vat"""

_CREDIT = "WHERE c_acctbal >= 0"

_BINDINGS = f"""
payt AS (
  SELECT o_orderkey AS key, strftime(o_orderdate, '%Y%m') AS period, o_orderpriority AS fop,
    CASE WHEN o_orderstatus = 'O' THEN 'KRW' ELSE 'USD' END AS ccy, {_HEADER_AMOUNTS}
  FROM orders WHERE o_orderstatus <> 'F'),
emis AS (
  SELECT o_orderkey AS key, c_mktsegment AS source, CAST(o_orderdate AS DATE) AS day
  FROM orders JOIN customer ON o_custkey = c_custkey {{credit}}),
rmbt AS (
  SELECT o_orderkey AS key, strftime(o_orderdate, '%Y%m') AS period, o_orderpriority AS fop, 'KRW' AS ccy,
    c_mktsegment AS source, CAST(o_orderdate AS DATE) AS day, {_HEADER_AMOUNTS}
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F'),
lines AS (
  SELECT l_orderkey AS key, CAST(l_quantity AS DECIMAL(18,2)) AS qty,
    CAST(NULLIF(l_quantity, 1) AS DECIMAL(18,2)) AS taxed_qty,
    CASE l_returnflag WHEN 'A' THEN 'FA' WHEN 'N' THEN 'TA' ELSE 'ZZ' END AS vat_type,
    CASE WHEN l_linestatus = 'O' THEN 'K-ITYR-1' ELSE 'OTHER' END AS detail,
    CASE WHEN l_linestatus = 'O' THEN 'YR' ELSE 'XT' END AS tax_code
  FROM lineitem),
vat_sums AS (
  SELECT key, SUM(CASE WHEN vat_type = 'FA' THEN qty ELSE 0 END) AS fare_vat,
    SUM(CASE WHEN vat_type = 'TA' AND contains(detail, 'ITYR') THEN qty ELSE 0 END) AS yr_vat
  FROM lines GROUP BY key),
yr_sums AS (
  SELECT key, SUM(COALESCE(taxed_qty, 0)) AS yr FROM lines WHERE tax_code = 'YR' GROUP BY key),
nations AS (SELECT o_orderkey AS key, c_nationkey AS country FROM orders JOIN customer ON o_custkey = c_custkey)"""

_ONE_PARAMETER = "para AS (SELECT n_nationkey AS isoc, n_name AS cutp FROM nation WHERE n_nationkey = 0)"
_TWO_PARAMETERS = "para AS (SELECT n_nationkey AS isoc, 'SET' AS cutp FROM nation WHERE n_nationkey IN (0, 1))"

# Base sums by report name, over the row columns; the settlement twin is double.
_BASE = {"Fare": "price", "StdCom": "std", "SupplCom": "suppl", "VatCom": "vat", "Tax": "tax",
         "YR": "yr", "Vatf": "fare_vat", "VatYR": "yr_vat"}


def _measures(suffix: str, fare_vat: str, factor: int) -> list[str]:
    total = {name: f"SUM(CAST(sign * {factor} AS DECIMAL(2,0)) * COALESCE({column}, 0))" for name, column in _BASE.items()}
    total["TotalCom"] = f"{total['StdCom']} + {total['SupplCom']}"
    total["DiscFareNetVAT"] = f"{total['Fare']} - {total['SupplCom']} - {total['Vatf']}"
    total["YRNetVAT"] = f"{total['YR']} - {total['VatYR']}"
    total["Net"] = (f"{total['Fare']} + {total['Tax']} - {total['StdCom']}"
                    f" - {total['SupplCom']} - {total['VatCom']}")
    names = {name: f"{name}{suffix}" for name in total} | {"Vatf": fare_vat}
    return [f'CAST({expression} AS DECIMAL(28,2)) AS "{names[name]}"' for name, expression in total.items()]


def bindings(credit_only: bool = False) -> str:
    return _BINDINGS.replace("{credit}", _CREDIT if credit_only else "")


def report(
    window: tuple[str, str] | None = None, two_rows: bool = False, distinct: bool = True, kind: str | None = None, credit_only: bool = False
) -> str:
    """Text of a WITH list: ``report`` with decimal amounts, ``shown`` with double ones. Without a window, all days."""
    days = "WHERE day BETWEEN DATE '{}' AND DATE '{}'".format(*window) if window else ""
    shared = ("CASE WHEN country = isoc THEN 'D' ELSE 'I' END AS label, fop, ccy, isoc, cutp, "
              "price, std, suppl, vat, tax, yr, fare_vat, yr_vat")
    rest = "LEFT JOIN vat_sums USING (key) LEFT JOIN yr_sums USING (key) LEFT JOIN nations USING (key) LEFT JOIN para ON TRUE"
    measures = ",\n    ".join(_measures("", "Vatf", 1) + _measures("_COA", "VatFare_COA", 2))
    doubles = ", ".join(f'CAST("{name}" AS DOUBLE) AS "{name}"' for name in MEASURES)
    only = f"WHERE kind = '{kind}'" if kind else ""
    return f"""{bindings(credit_only)},
{_TWO_PARAMETERS if two_rows else _ONE_PARAMETER},
facts AS (
  SELECT 'Sale' AS kind, 1 AS sign, source, period, day, {shared}
  FROM payt JOIN emis USING (key) {rest}
  UNION ALL
  SELECT 'Refund' AS kind, -1 AS sign, source, period, day, {shared}
  FROM rmbt {rest}),
report AS (
  SELECT {'DISTINCT' if distinct else ''} kind AS "Type", source AS "Source", period AS "RptPeriod",
    strftime(day, '%Y-%m-%d') AS "TrxDate", label AS "DomInt", fop AS "FOP", ccy AS "CCY", cutp AS "COA",
    {measures}
  FROM (SELECT * FROM facts {days}) {only}
  GROUP BY kind, sign, source, period, day, label, fop, ccy, isoc, cutp),
shown AS (
  SELECT "Type", "Source", "RptPeriod", "TrxDate", "DomInt", "FOP", "CCY", "COA", {doubles} FROM report)"""


def _report_query(select: str, with_more: str = "", **options) -> str:
    return f"WITH {report(**options)}{',' if with_more else ''} {with_more}\n{select}"


def _orders_dates(select: str) -> str:
    return f"WITH days AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)\nSELECT o_orderkey, {select} FROM days"


def _week(weeks_back: int) -> str:
    start = f"(d - CAST(((isodow(d) + 4) % 7 + {7 * weeks_back}) AS INTEGER))"
    return f"strftime({start}, '%Y-%m-%d') AS window_start, strftime({start} + 6, '%Y-%m-%d') AS window_end"


_MONTH_START = "CAST(date_trunc('month', d) - INTERVAL 1 MONTH AS DATE)"
_MONTH_END = "CAST(date_trunc('month', d) AS DATE) - 1"

_ROSTER = """
roster AS (
  SELECT c_custkey, c_mktsegment AS craft, c_name AS name, c_acctbal > 5000 AS with_guest, 'NATION_' || c_nationkey AS guest_craft,
    c_acctbal >= 0 AND c_mktsegment <> 'FURNITURE' AS usable FROM customer),
people AS (
  SELECT c_custkey, usable, craft, name FROM roster WHERE usable
  UNION ALL SELECT c_custkey, usable, guest_craft, 'Guest' FROM roster WHERE usable AND with_guest)"""
_DEFAULTS = "defaults(craft, name) AS (VALUES " + ", ".join(f"('{c}', '{n}')" for c, n in DEFAULT_PEOPLE) + ")"
_ALL_PEOPLE = """
everyone AS (
  SELECT c_custkey, craft, name FROM people
  UNION ALL SELECT c_custkey, defaults.craft, defaults.name FROM roster, defaults WHERE NOT usable)"""

_IDENTITIES = {
    "TotalCom": '"StdCom" + "SupplCom"',
    "DiscFareNetVAT": '"Fare" - "SupplCom" - "Vatf"',
    "YRNetVAT": '"YR" - "VatYR"',
    "Net": '"Fare" + "Tax" - "StdCom" - "SupplCom" - "VatCom"',
    "TotalCom_COA": '"StdCom_COA" + "SupplCom_COA"',
    "DiscFareNetVAT_COA": '"Fare_COA" - "SupplCom_COA" - "VatFare_COA"',
    "YRNetVAT_COA": '"YR_COA" - "VatYR_COA"',
    "Net_COA": '"Fare_COA" + "Tax_COA" - "StdCom_COA" - "SupplCom_COA" - "VatCom_COA"',
}


def check_sql() -> dict[str, str]:
    whole = _report_query("SELECT * FROM shown")
    start, end = MONTH
    in_month = f"\"TrxDate\" BETWEEN '{start}' AND '{end}'"
    identities = " UNION ALL ".join(
        f"SELECT '{name}' AS identity, COUNT(*) AS checked, COUNT(*) FILTER (\"{name}\" <> {follows}) AS broken,"
        f" CAST(SUM({follows}) AS DOUBLE) AS total FROM report"
        for name, follows in _IDENTITIES.items())
    per_day = 'COUNT(*) AS "rows", CAST(SUM("Net_COA") AS DOUBLE) AS net'
    promoted = _report_query(
        f"""SELECT 'final' AS "table", "TrxDate", {per_day} FROM report WHERE {in_month} GROUP BY ALL
        UNION ALL SELECT 'recent', "TrxDate", {per_day} FROM report WHERE NOT {in_month} GROUP BY ALL""")
    windows = f"""days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders),
        windows AS (SELECT DISTINCT strftime(s, '%Y%m%d') || '_' || strftime(e, '%Y%m%d') AS window_key, s, e FROM (
        SELECT {_MONTH_START} AS s, {_MONTH_END} AS e FROM days UNION ALL
        SELECT d - CAST(((isodow(d) + 4) % 7 + 7) AS INTEGER), d - CAST(((isodow(d) + 4) % 7 + 1) AS INTEGER) FROM days))"""
    layouts = "(VALUES ('plain'), ('by_source')) AS layouts(layout)"
    first_half = f"(NOT ({in_month}) OR \"TrxDate\" <= '{start[:8]}15')"
    return {
        "settlement_report": whole,
        "settlement_report_credit": _report_query("SELECT * FROM shown", credit_only=True),
        "settlement_report_month": _report_query("SELECT * FROM shown", window=MONTH),
        "settlement_report_staged": _report_query("SELECT * FROM shown", window=MONTH),
        "weekly_report": _report_query("SELECT * FROM shown", window=WEEK),
        "settlement_landed": _report_query("SELECT * FROM shown", window=MONTH),
        "settlement_backfill": _report_query(
            "SELECT window_key, shown.* FROM shown JOIN windows ON \"TrxDate\" BETWEEN strftime(s, '%Y-%m-%d') AND strftime(e, '%Y-%m-%d')",
            with_more=windows),
        "settlement_sale": _report_query("SELECT * FROM shown", kind="Sale", distinct=False),
        "settlement_refund": _report_query("SELECT * FROM shown", kind="Refund", distinct=False),
        "settlement_by_domint": _report_query(
            'SELECT "Type", "DomInt", CAST(SUM("Fare") AS DOUBLE) AS fare, CAST(SUM("Net") AS DOUBLE) AS net, COUNT(*) AS "rows"'
            " FROM report GROUP BY ALL"),
        "settlement_hidden_key": _report_query("SELECT * FROM shown", two_rows=True, distinct=False),
        "settlement_collapsed": _report_query(
            'SELECT "Type", "TrxDate", "Source", "DomInt", "FOP", "CCY", "Fare", "groups" FROM'
            ' (SELECT *, COUNT(*) AS "groups" FROM shown GROUP BY ALL HAVING COUNT(*) > 1)', two_rows=True, distinct=False),
        "settlement_identities": _report_query(identities),
        "union_distinct": _report_query("SELECT * FROM shown", two_rows=True),
        "report_net_total": _report_query('SELECT CAST(SUM("DiscFareNetVAT_COA") AS DOUBLE) AS net FROM report'),
        "report_file_net_total": _report_query('SELECT CAST(SUM("DiscFareNetVAT_COA") AS DOUBLE) AS net FROM report'),
        "vat_by_parent": f"""WITH {bindings()} SELECT key AS payt_sqnu, CAST(fare_vat AS DOUBLE) AS vatcf,
            CAST(2 * fare_vat AS DOUBLE) AS vatff, CAST(yr_vat AS DOUBLE) AS vatcyr, CAST(2 * yr_vat AS DOUBLE) AS vatfyr FROM vat_sums""",
        "yr_tax_by_parent": f"""WITH {bindings()} SELECT key AS payt_sqnu, CAST(yr AS DOUBLE) AS yr_tmfa,
            CAST(2 * yr AS DOUBLE) AS yr_tmff FROM yr_sums""",
        "filter_date_window": f"""WITH {bindings()} SELECT key AS tdnr, source AS srci, strftime(day, '%Y-%m-%d') AS dais
            FROM emis WHERE day BETWEEN DATE '{start}' AND DATE '{end}'""",
        "filter_date_text": f"""WITH {bindings()} SELECT key AS tdnr, source AS srci, strftime(day, '%Y-%m-%d') AS dais
            FROM emis WHERE day BETWEEN DATE '{start}' AND DATE '{end}'""",
        "join_parameter_row": f"""WITH {bindings()}, {_TWO_PARAMETERS}
            SELECT key AS sqnu, isoc, cutp, CAST(price AS DOUBLE) AS fpam FROM payt LEFT JOIN para ON TRUE""",
        "join_payment_issue": f"""WITH {bindings(credit_only=True)} SELECT key AS tdnr, fop AS fptp, source AS srci,
            strftime(day, '%Y-%m-%d') AS dais, CAST(price AS DOUBLE) AS fpam FROM payt JOIN emis USING (key)""",
        "join_vat_agg": f"""WITH {bindings()} SELECT key AS sqnu, CAST(fare_vat AS DOUBLE) AS vatcf,
            CAST(2 * fare_vat AS DOUBLE) AS vatff, CAST(yr_vat AS DOUBLE) AS vatcyr, CAST(2 * yr_vat AS DOUBLE) AS vatfyr
            FROM payt LEFT JOIN vat_sums USING (key)""",
        "join_yr_agg": f"""WITH {bindings()} SELECT key AS sqnu, CAST(yr AS DOUBLE) AS yr_tmfa, CAST(2 * yr AS DOUBLE) AS yr_tmff
            FROM payt LEFT JOIN yr_sums USING (key)""",
        "recent_sale": """SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, COUNT(*) AS cnt,
            CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_sales FROM orders GROUP BY 1""",
        "preview_limit": f"""WITH {bindings()} SELECT key AS tdnr, source AS srci, strftime(day, '%Y-%m-%d') AS dais
            FROM emis ORDER BY key LIMIT 2""",
        "fmt_trx_date": _orders_dates("strftime(d, '%Y-%m-%d') AS \"TrxDate\""),
        "window_prev_month": _orders_dates(
            f"strftime({_MONTH_START}, '%Y-%m-%d') AS window_start, strftime({_MONTH_END}, '%Y-%m-%d') AS window_end"),
        "window_wed_tue": _orders_dates(_week(1)),
        "window_wed_tue_delta": _orders_dates(_week(3)),
        "window_override": _orders_dates(
            f"strftime({_MONTH_START}, '%Y-%m-%d') AS window_start, strftime(d, '%Y-%m-%d') AS window_end"),
        "window_key": _orders_dates(
            f"strftime({_MONTH_START}, '%Y%m%d') || '_' || strftime({_MONTH_END}, '%Y%m%d') AS window_key"),
        "src_parquet_window": whole,
        "src_csv_semicolon": whole,
        "write_parquet_window": whole,
        "export_users_csv": "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment, c_acctbal FROM customer",
        "load_append_parquet": whole,
        "load_append_csv": whole,
        "load_csv_quarantine": _report_query(
            f"""SELECT CASE WHEN "Type" = 'Sale' AND {in_month} THEN 'bad' ELSE 'loaded' END AS outcome, "Type", COUNT(*) AS "rows"
            FROM shown GROUP BY ALL"""),
        "stream_recent_drops": whole,
        "delete_range": _report_query(f"SELECT * FROM shown WHERE NOT {in_month}"),
        "window_replace": whole,
        "delete_range_rows": _report_query(f"SELECT shown.*, layout FROM shown, {layouts} WHERE NOT {in_month}"),
        "window_replace_rows": _report_query(f"SELECT shown.*, layout FROM shown, {layouts}"),
        "window_replace_switched": _report_query(f"SELECT * FROM shown WHERE {first_half}"),
        "dq_gate": _report_query(
            f"""SELECT 'good' AS batch, 'loaded' AS test, COUNT(*) AS n FROM shown
            UNION ALL SELECT 'bad', 'loaded', COUNT(*) FROM shown WHERE NOT {in_month}
            UNION ALL SELECT 'bad', 'Net', COUNT(*) FROM shown WHERE {in_month} AND "Type" = 'Sale'
            UNION ALL SELECT 'bad', 'not_null Type', COUNT(*) FROM shown WHERE {in_month} AND "Type" = 'Refund' AND "FOP" = '1-URGENT' HAVING COUNT(*) > 0"""),
        "window_replace_external": _report_query(f"SELECT * FROM shown WHERE NOT ({in_month}) OR \"TrxDate\" <= '{start[:8]}15'"),
        "promote_final": promoted,
        "monthly_settlement": promoted,
        "src_literal_rows": """SELECT vat_type, COUNT(*) AS lines FROM lineitem
            JOIN (VALUES ('A', 'FA'), ('N', 'TA'), ('R', 'ZZ')) AS t(flag, vat_type) ON l_returnflag = flag GROUP BY vat_type""",
        "src_json_people": """SELECT c_custkey, CAST(1 AS DOUBLE) AS number,
            CAST(CASE WHEN c_acctbal > 5000 THEN 2 ELSE 1 END AS DOUBLE) AS listed, c_name AS first_name FROM customer""",
        "src_json_files": f"""WITH {_DEFAULTS}
            SELECT 'landed' AS folder, CAST(COUNT(*) OVER (PARTITION BY c_nationkey) AS DOUBLE) AS number, c_mktsegment AS craft, c_name AS name
            FROM customer UNION ALL SELECT 'nothing', CAST({DEFAULT_NUMBER} AS DOUBLE), craft, name FROM defaults""",
        "src_json_fallback": f"""WITH {_ROSTER} SELECT c_custkey, CAST(CASE WHEN usable THEN 1 ELSE {DEFAULT_NUMBER} END AS DOUBLE) AS number,
            CAST(CASE WHEN usable THEN 1 + CAST(with_guest AS INTEGER) ELSE {len(DEFAULT_PEOPLE)} END AS DOUBLE) AS listed,
            CASE WHEN usable THEN name ELSE '{DEFAULT_PEOPLE[0][1]}' END AS first_name FROM roster""",
        "src_json_variant": """SELECT c_custkey, ['ok', 'ok', 'number is not whole', 'no number', 'people is not a list', 'person without name or craft',
            'not json', 'not json'][c_custkey % 8 + 1] AS outcome, CASE WHEN c_custkey % 8 < 2 THEN CAST(1 AS DOUBLE) END AS number,
            CASE WHEN c_custkey % 8 < 2 THEN c_name END AS name, CASE WHEN c_custkey % 8 = 0 THEN '{"id":' || c_custkey || '}' END AS station,
            CASE WHEN c_custkey % 8 = 0 THEN CAST(c_nationkey AS VARCHAR) END AS seat FROM customer""",
        "roster_explode": """SELECT c_custkey, c_mktsegment AS craft, c_name AS name FROM customer
            UNION ALL SELECT c_custkey, 'NATION_' || c_nationkey, 'Guest' FROM customer WHERE c_acctbal > 5000""",
        "roster_lines": f"""WITH {_ROSTER}, {_DEFAULTS}, {_ALL_PEOPLE}
            SELECT c_custkey, name || ' is currently in space flying on the ' || craft || '! {GREETING}' AS line FROM everyone""",
        "roster_count_check": f"""WITH {_ROSTER} SELECT c_custkey, 1 AS number, 2 AS listed FROM roster WHERE usable AND with_guest""",
        "model_first": "SELECT o_orderkey AS id FROM orders UNION ALL SELECT c_custkey FROM customer",
        "model_first_not_null": """SELECT id % 5 AS id FROM (SELECT o_orderkey AS id FROM orders UNION ALL SELECT c_custkey FROM customer)
            WHERE id % 5 <> 0""",
        "model_second": "SELECT id FROM (SELECT o_orderkey AS id FROM orders UNION ALL SELECT c_custkey FROM customer) WHERE id = 2",
        "model_second_view": "SELECT id FROM (SELECT o_orderkey AS id FROM orders UNION ALL SELECT c_custkey FROM customer) WHERE id = 2",
        "dq_unique": """SELECT id, COUNT(*) AS n FROM (SELECT o_orderkey AS id FROM orders UNION ALL SELECT c_custkey FROM customer)
            GROUP BY id HAVING COUNT(*) > 1""",
        "dq_not_null": f"WITH {bindings()} SELECT key AS sqnu FROM payt WHERE suppl IS NULL",
        "dq_models": """WITH first AS (SELECT o_orderkey AS id FROM orders UNION ALL SELECT c_custkey FROM customer),
            repeated AS (SELECT id FROM first GROUP BY id HAVING COUNT(*) > 1)
            SELECT 'first' AS model, 'unique' AS test, COUNT(*) AS failures FROM repeated
            UNION ALL SELECT 'first', 'not_null', COUNT(*) FROM first WHERE id IS NULL
            UNION ALL SELECT 'second', 'unique', COUNT(*) FROM repeated WHERE id = 2
            UNION ALL SELECT 'second', 'not_null', COUNT(*) FROM first WHERE id = 2 AND id IS NULL""",
    }
