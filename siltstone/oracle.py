"""DuckDB SQL for the registered queries, written against the provided tables.

Every text is one statement over a shared chain of common table expressions:
``b_*`` are the raw deliveries, ``r_*`` the same rows with the rule that rejects
them, ``s_*`` Silver, ``f`` the fact.
"""

from __future__ import annotations

from siltstone.config import SOURCES
from siltstone.sources.testdata import duckdb_sql

NAMES = list(SOURCES)

_DATE_RE = r"^[0-9]{4}-(1[0-2]|0?[1-9])-(3[01]|[12][0-9]|0?[1-9])$"


def _date(c: str) -> str:
    return f"CASE WHEN regexp_matches(trim({c}), '{_DATE_RE}') THEN TRY_CAST(trim({c}) AS DATE) END"


def _int(c: str) -> str:
    return f"CASE WHEN regexp_matches(trim({c}), '^[+-]?[0-9]+$') THEN TRY_CAST(trim({c}) AS BIGINT) END"


def _dec(c: str) -> str:
    return f"TRY_CAST(trim({c}) AS DECIMAL(12,2))"


def _required(*cols: str) -> list[tuple[str, str, str]]:
    return [("VR-10", f"coalesce(trim({c}), '') = ''",
             f"'Required field ''{c}'' is missing or blank'") for c in cols]


def _bad(rule: str, col: str, cond: str, what: str) -> tuple[str, str, str]:
    return (rule, cond, f"'{col} ''' || {col} || ''' is not a valid {what}'")


def _orphan(col: str, parent: str, key: str) -> tuple[str, str, str]:
    return ("VR-02", f"trim({col}) NOT IN (SELECT {key} FROM s_{parent})",
            f"'{col} ''' || {col} || ''' does not exist in silver.{parent}'")


_RULES = {
    "supplier_master": [
        *_required("supplier_id", "supplier_name", "country", "contract_start_date",
                   "performance_tier"),
        _bad("VR-10", "contract_start_date", f"({_date('contract_start_date')}) IS NULL", "date"),
    ],
    "medicine_catalogue": [
        *_required("medicine_id", "medicine_name", "category", "unit_of_measure",
                   "shelf_life_days"),
        _bad("VR-03", "shelf_life_days", f"coalesce({_int('shelf_life_days')}, 0) <= 0",
             "positive integer"),
    ],
    "purchase_orders": [
        *_required("po_id", "supplier_id", "medicine_id", "order_date", "quantity", "total_cost",
                   "currency"),
        _orphan("supplier_id", "supplier_master", "supplier_id"),
        _orphan("medicine_id", "medicine_catalogue", "medicine_id"),
        _bad("VR-03", "order_date", f"({_date('order_date')}) IS NULL", "date"),
        _bad("VR-03", "quantity", f"coalesce({_int('quantity')}, 0) <= 0", "positive integer"),
        _bad("VR-03", "total_cost", f"coalesce({_dec('total_cost')}, -1) < 0",
             "non-negative number"),
    ],
    "shipment_records": [
        *_required("shipment_id", "po_id", "warehouse_id", "eta", "transport_company", "status"),
        _orphan("po_id", "purchase_orders", "po_id"),
        _bad("VR-04", "eta", f"({_date('eta')}) IS NULL", "date"),
        ("VR-04", f"trim(actual_arrival) <> '' AND ({_date('actual_arrival')}) IS NULL",
         "'actual_arrival ''' || trim(actual_arrival) || ''' is present but not a valid date'"),
        ("VR-06", f"({_date('actual_arrival')}) < ({_date('eta')})",
         "'actual_arrival ''' || actual_arrival || ''' is before eta ''' || eta || ''''"),
    ],
    "warehouse_inventory": [
        *_required("warehouse_id", "medicine_id", "quantity_on_hand", "expiry_date",
                   "batch_number"),
        _orphan("medicine_id", "medicine_catalogue", "medicine_id"),
        _bad("VR-08", "quantity_on_hand", f"({_int('quantity_on_hand')}) IS NULL", "integer"),
        ("VR-07", f"({_int('quantity_on_hand')}) < 0",
         f"'quantity_on_hand ' || CAST({_int('quantity_on_hand')} AS VARCHAR) || ' is negative'"),
        _bad("VR-08", "expiry_date", f"({_date('expiry_date')}) IS NULL", "date"),
    ],
}

_TYPED = {
    "supplier_master": "trim(supplier_id) AS supplier_id, trim(supplier_name) AS supplier_name, "
    "trim(country) AS country, nullif(trim(contact_email), '') AS contact_email, "
    f"{_date('contract_start_date')} AS contract_start_date, "
    "trim(performance_tier) AS performance_tier",
    "medicine_catalogue": "trim(medicine_id) AS medicine_id, "
    "trim(medicine_name) AS medicine_name, trim(category) AS category, "
    "trim(unit_of_measure) AS unit_of_measure, "
    f"CAST({_int('shelf_life_days')} AS INT) AS shelf_life_days",
    "purchase_orders": "trim(po_id) AS po_id, trim(supplier_id) AS supplier_id, "
    f"trim(medicine_id) AS medicine_id, {_date('order_date')} AS order_date, "
    f"CAST({_int('quantity')} AS INT) AS quantity, {_dec('total_cost')} AS total_cost, "
    "trim(currency) AS currency",
    "shipment_records": "trim(shipment_id) AS shipment_id, trim(po_id) AS po_id, "
    f"trim(warehouse_id) AS warehouse_id, {_date('eta')} AS eta, "
    f"{_date('actual_arrival')} AS actual_arrival, "
    "trim(transport_company) AS transport_company, trim(status) AS status",
    "warehouse_inventory": "trim(warehouse_id) AS warehouse_id, "
    "trim(medicine_id) AS medicine_id, trim(batch_number) AS batch_number, "
    f"CAST({_int('quantity_on_hand')} AS INT) AS quantity_on_hand, "
    f"{_date('expiry_date')} AS expiry_date",
}


def _rule_ctes(name: str) -> list[tuple[str, str]]:
    spec = SOURCES[name]
    rules = " ".join(f"WHEN {cond} THEN '{rule}'" for rule, cond, _ in _RULES[name])
    texts = " ".join(f"WHEN {cond} THEN {text}" for _, cond, text in _RULES[name])
    key, order = ", ".join(f"trim({k})" for k in spec.natural_key), ", ".join(spec.columns)
    return [
        (f"b_{name}", duckdb_sql(name)),
        (f"r_{name}", f"SELECT *, CASE {rules} END AS rule_id, CASE {texts} END AS "
                      f"rule_description FROM b_{name}"),
        (f"v_{name}", f"SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn "
                      f"FROM r_{name} WHERE rule_id IS NULL"),
        (f"s_{name}", f"SELECT {_TYPED[name]} FROM v_{name} WHERE rn = 1"),
    ]


_FACT = """
    SELECT sr.shipment_id, po.supplier_id, po.medicine_id, sr.warehouse_id,
           sup.country AS country_name, po.order_date, sr.eta, sr.actual_arrival,
           po.quantity, po.total_cost, po.currency,
           CASE WHEN sr.actual_arrival IS NOT NULL
                THEN greatest(sr.actual_arrival - sr.eta, 0) END AS delay_days,
           CASE WHEN sr.actual_arrival IS NULL THEN FALSE
                ELSE sr.actual_arrival - sr.eta > 3 END AS is_delayed,
           sr.status
    FROM s_shipment_records sr
    JOIN s_purchase_orders po ON po.po_id = sr.po_id
    JOIN s_supplier_master sup ON sup.supplier_id = po.supplier_id
    JOIN s_medicine_catalogue med ON med.medicine_id = po.medicine_id"""

_PERFORMANCE = """
    SELECT sup.supplier_name, sup.performance_tier, f.country_name,
           count(*) AS total_shipments,
           CAST(sum(CASE WHEN f.is_delayed THEN 1 ELSE 0 END) AS BIGINT) AS delayed_shipments,
           round(CAST(100.0 * sum(CASE WHEN f.is_delayed THEN 1 ELSE 0 END) AS DOUBLE)
                 / count(*), 1) AS delay_rate_pct,
           round(avg(f.delay_days), 1) AS avg_delay_days,
           CAST(sum(f.total_cost) AS DOUBLE) AS total_procurement_cost
    FROM f JOIN s_supplier_master sup USING (supplier_id)
    GROUP BY 1, 2, 3"""

_DETAILS = """
    SELECT f.shipment_id, sup.supplier_name, sup.performance_tier, f.country_name,
           med.medicine_name, med.category AS medicine_category, f.warehouse_id,
           CAST(f.order_date AS VARCHAR) AS order_date, CAST(f.eta AS VARCHAR) AS eta_date,
           CAST(f.actual_arrival AS VARCHAR) AS actual_arrival_date,
           f.quantity, CAST(f.total_cost AS DOUBLE) AS total_cost, f.currency,
           CAST(f.delay_days AS INT) AS delay_days, f.is_delayed, f.status,
           CAST(year(f.eta) AS INT) AS eta_year, CAST(month(f.eta) AS INT) AS eta_month,
           CAST(quarter(f.eta) AS INT) AS eta_quarter, monthname(f.eta) AS eta_month_name
    FROM f JOIN s_supplier_master sup USING (supplier_id)
    JOIN s_medicine_catalogue med USING (medicine_id)"""

_EXPIRY = """
    SELECT inv.warehouse_id, med.medicine_name, med.category, inv.batch_number,
           inv.quantity_on_hand, CAST(inv.expiry_date AS VARCHAR) AS expiry_date,
           CAST(inv.expiry_date - DATE '1998-01-01' AS INT) AS days_until_expiry,
           CASE WHEN inv.expiry_date < DATE '1998-01-01' THEN 'Expired'
                WHEN inv.expiry_date - DATE '1998-01-01' <= 90 THEN 'At Risk (within 90 days)'
                ELSE 'OK' END AS expiry_status
    FROM s_warehouse_inventory inv JOIN s_medicine_catalogue med USING (medicine_id)"""

_QUARANTINE = " UNION ALL ".join(
    f"""SELECT '{n}' AS target_table, rule_id, rule_description,
               {" || '|' || ".join(SOURCES[n].natural_key)} AS row_key
        FROM r_{n} WHERE rule_id IS NOT NULL"""
    for n in NAMES
)

_CTES = [
    *[c for n in NAMES for c in _rule_ctes(n)],
    ("f", _FACT),
    ("days", "SELECT order_date AS d FROM s_purchase_orders UNION ALL SELECT eta FROM "
             "s_shipment_records UNION ALL SELECT actual_arrival FROM s_shipment_records"),
    ("years", "SELECT least(year(min(d)), 2003) AS first_year, "
              "greatest(year(max(d)), 2004) AS last_year FROM days"),
    ("details", _DETAILS),
    ("performance", _PERFORMANCE),
    ("q", _QUARANTINE),
    ("log", duckdb_sql("ingest_log")),
    ("runs", "SELECT run_id, count(*) AS n, max(ingested_at) AS last_at FROM log GROUP BY 1"),
]


def sql(body: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in _CTES) + "\n" + body


def _per_source(body: str) -> str:
    return " UNION ALL ".join(body.format(n=n) for n in NAMES)


def _bronze_columns(name: str) -> str:
    return ", ".join(SOURCES[name].columns)


def _silver_plain(name: str) -> str:
    """Silver rows with dates as text and money as DOUBLE."""
    out = []
    for c in _TYPED_COLUMNS[name]:
        if c in ("contract_start_date", "order_date", "eta", "actual_arrival", "expiry_date"):
            out.append(f"CAST({c} AS VARCHAR) AS {c}")
        elif c == "total_cost":
            out.append("CAST(total_cost AS DOUBLE) AS total_cost")
        else:
            out.append(c)
    return f"SELECT {', '.join(out)} FROM s_{name}"


_TYPED_COLUMNS = {n: list(SOURCES[n].columns) for n in NAMES}


def _check(category: str, check_id: str, description: str, status: str, severity: str,
           details: str) -> str:
    return (f"'{category}' AS check_category, '{check_id}' AS check_id, "
            f"{description} AS description, {status} AS status, {severity} AS severity, "
            f"CAST({details} AS VARCHAR) AS details")


def _freshness(source: str, hours: str, table: str) -> str:
    return "SELECT " + _check(
        "freshness", "FRESH-01", f"'{source} ingested within 26h window'",
        "CASE WHEN h <= 26 THEN 'PASS' ELSE 'FAIL' END",
        "CASE WHEN h <= 26 THEN 'INFO' ELSE 'WARNING' END",
        f"json_object('source', '{source}', 'hours_since_last_ingest', h, 'threshold_hours', 26)",
    ) + f" FROM (SELECT {hours} AS h FROM {table})"


def _hours_to(at: str) -> str:
    return (f"round(date_diff('microsecond', max(ingested_at), TIMESTAMP '{at}') / 3.6e9, 2)")


def _deviation(source: str, threshold: str, target: str, where: str = "TRUE") -> str:
    pct = "abs(today - a) / a * 100"
    return "SELECT " + _check(
        "completeness", "COMPLETE-01",
        f"'{source} row count within {threshold}% of trailing average'",
        f"CASE WHEN {pct} <= {threshold} THEN 'PASS' ELSE 'FAIL' END",
        f"CASE WHEN {pct} <= {threshold} THEN 'INFO' ELSE 'WARNING' END",
        f"json_object('source', '{source}', 'today_count', today, 'historical_avg', round(a, 1), "
        f"'deviation_pct', round({pct}, 1), 'threshold_pct', "
        + (f"CAST({threshold} AS DOUBLE)" if "." in threshold else threshold) + ")",
    ) + f""" FROM (SELECT
        (SELECT n FROM runs WHERE run_id = {target}) AS today,
        (SELECT CAST(sum(n) AS DOUBLE) / count(*) FROM runs
         WHERE run_id <> {target} AND {where}) AS a)"""


_NEWEST = "(SELECT run_id FROM log ORDER BY ingested_at DESC, run_id DESC LIMIT 1)"
_WEEK = "last_at >= TIMESTAMP '2024-01-24 00:00:00'"


def _no_history(name: str) -> str:
    return "SELECT " + _check(
        "completeness", "COMPLETE-01",
        f"'{name} row count deviation (insufficient history)'", "'PASS'", "'INFO'",
        f"json_object('source', '{name}', 'today_count', (SELECT count(*) FROM b_{name}), "
        "'historical_avg', NULL)")


def _uniqueness(name: str, prefix: str, label: str) -> str:
    key = SOURCES[name].natural_key
    cols = ", ".join(key)
    text = " || '|' || ".join(key)
    return "SELECT " + _check(
        "uniqueness", "UNIQUE-01",
        f"'silver.{label}.{'+'.join(key)} has no duplicate natural keys'",
        "CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END",
        "CASE WHEN n = 0 THEN 'INFO' ELSE 'CRITICAL' END",
        f"json_object('table', '{label}', 'duplicate_count', n, 'duplicate_keys', ks)",
    ) + f""" FROM (SELECT count(*) AS n,
        coalesce(list(k ORDER BY k) FILTER (WHERE rk <= 10), []) AS ks
        FROM (SELECT k, row_number() OVER (ORDER BY k) AS rk
              FROM (SELECT {text} AS k FROM {prefix}_{name} GROUP BY {cols}
                    HAVING count(*) > 1)))"""


_CONSISTENCY = "SELECT " + _check(
    "consistency", "CONSIST-01",
    "'silver.shipment_records count matches gold.fact_shipment count'",
    "CASE WHEN s = g THEN 'PASS' ELSE 'FAIL' END",
    "CASE WHEN s = g THEN 'INFO' ELSE 'CRITICAL' END",
    "json_object('silver_shipment_count', s, 'gold_fact_shipment_count', g, 'difference', s - g)",
) + (" FROM (SELECT (SELECT count(*) FROM s_shipment_records) AS s, "
     "(SELECT count(*) FROM f) AS g)")

_SINGLE = [n for n in NAMES if len(SOURCES[n].natural_key) == 1]


def _suite(hours: str, names: list[str]) -> str:
    parts = []
    for n in NAMES:
        parts += [_freshness(n, f"CAST({hours} AS DOUBLE)", "(SELECT 1)"), _no_history(n)]
    parts += [_uniqueness(n, "s", n) for n in names]
    return " UNION ALL ".join([*parts, _CONSISTENCY])


_SUITE = _suite("1", _SINGLE)
_LATE = _suite("48", NAMES)

_SUMMARY = """SELECT count(*) AS total,
    count(*) FILTER (WHERE status = 'PASS') AS passed,
    count(*) FILTER (WHERE status <> 'PASS') AS failed,
    count(*) FILTER (WHERE status = 'FAIL' AND severity = 'CRITICAL') AS critical,
    count(*) FILTER (WHERE status = 'FAIL' AND severity = 'WARNING') AS warning"""


def _zero(pairs: list[tuple[str, str]]) -> str:
    """Constraints that hold on loaded tables: the expected violations are none,
    counted from the same chain where a count is possible."""
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS constraint_name, CAST(({v}) AS BIGINT) AS violations"
        for t, c, v in pairs)


def _constraints(kind: str) -> str:
    from siltstone.plans.quality import CHECKS, FOREIGN_KEYS, NOT_NULL, UNIQUE

    added = {"bronze_id", "validated_at"}
    fact_of = {"order_date_key": "order_date", "eta_date_key": "eta",
               "actual_arrival_date_key": "actual_arrival", "supplier_key": "supplier_id",
               "medicine_key": "medicine_id", "warehouse_key": "warehouse_id",
               "country_key": "country_name", "shipment_key": "shipment_id"}

    def rel(table: str) -> str:
        layer, name = table.split(".")
        return f"s_{name}" if layer == "silver" else "f"

    if kind == "null":
        return _zero([
            (t, f"{c} not null",
             "0" if c in added else
             f"SELECT count(*) FROM {rel(t)} WHERE {fact_of.get(c, c) if t[0] == 'g' else c} IS NULL")
            for t, cols in NOT_NULL.items() for c in cols])
    if kind == "check":
        return _zero([
            (t, n, f"SELECT count(*) FROM ({_SUITE}) WHERE NOT ({p})" if t[0] == "q" else
             f"SELECT count(*) FROM {rel(t)} WHERE NOT ({p})")
            for t, tests in CHECKS.items() for n, p in tests.items()])
    if kind == "unique":
        def dup(table: str, keys: tuple[str, ...]) -> str:
            if table.startswith("silver") or table == "gold.fact_shipment":
                cols = ", ".join(keys)
                return (f"SELECT count(*) FROM (SELECT {cols} FROM {rel(table)} GROUP BY {cols} "
                        "HAVING count(*) > 1)")
            return "0"
        return _zero([(t, f"unique ({', '.join(k)})", dup(t, k)) for t, k in UNIQUE.items()])

    def orphans(table: str, fk: str, parent: str, pk: str) -> str:
        if table.startswith("silver"):
            return (f"SELECT count(*) FROM {rel(table)} WHERE {fk} NOT IN "
                    f"(SELECT {pk} FROM {rel(parent)})")
        if parent == "gold.dim_date":
            return (f"SELECT count(*) FROM f WHERE year({fact_of[fk]}) "
                    "NOT BETWEEN (SELECT first_year FROM years) AND (SELECT last_year FROM years)")
        return "0"
    return _zero([(t, f"{fk} references {p}", orphans(t, fk, p, pk))
                  for t, fk, p, pk in FOREIGN_KEYS])


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    for n in NAMES:
        q[f"bronze_{n}"] = f"SELECT {_bronze_columns(n)}, 'landing-1' AS run_id FROM b_{n}"
        q[f"silver_{n}"] = _silver_plain(n)
    q["bronze_row_ids"] = _per_source(
        "SELECT '{n}' AS source, count(*) AS row_count, count(*) AS distinct_ids, "
        "TRUE AS all_positive FROM b_{n}")
    q["ingest_load_metrics"] = _per_source(
        "SELECT 'landing-1' AS run_id, '{n}' AS source, '{n}_raw' AS bronze_table, "
        "count(*) AS rows_loaded FROM b_{n}")
    q["rows_of_run"] = _per_source(
        "SELECT '{n}_raw' AS bronze_table, count(*) AS row_count FROM b_{n}")
    for n in ("supplier_master", "warehouse_inventory"):
        q[f"csv_source_{n}"] = f"SELECT {_bronze_columns(n)} FROM b_{n}"
    for n in ("purchase_orders", "shipment_records"):
        q[f"json_source_{n}"] = f"SELECT {_bronze_columns(n)} FROM b_{n}"
    q["silver_stream_purchase_orders"] = _silver_plain("purchase_orders")

    count = "(SELECT count(*) FROM {}{{n}}{})"
    passed = count.format("s_", "")
    bad = count.format("r_", " WHERE rule_id IS NOT NULL")
    copies = count.format("v_", " WHERE rn > 1")
    ok = count.format("v_", "")
    q["silver_outcomes"] = _per_source(
        f"SELECT '{{n}}' AS source, {passed} AS rows_passed, {bad} AS rows_quarantined, "
        f"{copies} AS rows_skipped_duplicate")
    # The second load sees its own delivery and the copies skipped by the first.
    q["silver_second_load_outcomes"] = _per_source(
        f"SELECT '{{n}}' AS source, CAST(0 AS BIGINT) AS rows_passed, "
        f"{bad} AS rows_quarantined, {ok} + {copies} AS rows_skipped_duplicate")
    q["unprocessed_rows"] = _per_source(
        f"SELECT '{{n}}' AS source, {copies} AS row_count")
    q["quarantine_vr09_duplicates"] = (
        "SELECT target_table, rule_id, count(*) AS row_count FROM (SELECT target_table, rule_id "
        "FROM q UNION ALL " + _per_source("SELECT '{n}', 'VR-09' FROM v_{n} WHERE rn > 1")
        + ") GROUP BY 1, 2")
    q["quarantine_rows"] = (
        "SELECT target_table AS source_name, target_table, rule_id, rule_description, row_key, "
        "'landing-1' AS landing_run, 'silver-1' AS load_run FROM q")
    q["quarantine_by_rule"] = (
        "SELECT target_table, rule_id, count(*) AS row_count FROM q GROUP BY 1, 2")
    q["quarantine_by_rule_and_day"] = (
        "SELECT rule_id, '1998-01-01' AS quarantined_on, count(*) AS row_count FROM q GROUP BY 1")
    q["quarantine_of_purchase_orders"] = (
        f"SELECT rule_id, {_bronze_columns('purchase_orders')} FROM r_purchase_orders "
        "WHERE rule_id IS NOT NULL")
    q["orphan_supplier_ids"] = (
        "SELECT supplier_id, count(*) AS row_count FROM b_purchase_orders WHERE supplier_id "
        "NOT IN (SELECT supplier_id FROM s_supplier_master) GROUP BY 1")

    q["dim_date"] = """
        SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, CAST(d AS VARCHAR) AS full_date,
               CAST(day(d) AS INT) AS day_of_month, CAST(month(d) AS INT) AS month,
               monthname(d) AS month_name, CAST(quarter(d) AS INT) AS quarter,
               CAST(year(d) AS INT) AS year, CAST(isodow(d) - 1 AS INT) AS day_of_week,
               dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend
        FROM (SELECT CAST(unnest(generate_series(
                  CAST(make_date(first_year, 1, 1) AS TIMESTAMP),
                  CAST(make_date(last_year, 12, 31) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
              FROM years)"""
    q["calendar_keeps_all"] = " UNION ALL ".join(
        f"SELECT '{s}' AS step, count(*) AS n FROM f WHERE {c}" for s, c in (
            ("fact", "TRUE"), ("details", "TRUE"), ("months", "TRUE"),
            ("arrived", "actual_arrival IS NOT NULL")))
    q["dim_supplier_versions"] = """
        SELECT supplier_id, supplier_name,
               performance_tier || CASE WHEN v = 2 AND k % 3 = 0 THEN '+' ELSE '' END
                 AS performance_tier,
               CASE WHEN v = 1 THEN '1997-01-01' ELSE '1998-01-01' END AS valid_from,
               CASE WHEN v = 1 AND k % 3 = 0 AND k NOT IN (8, 9) THEN '1997-12-31' END AS valid_to,
               NOT (v = 1 AND k % 3 = 0) AS is_current,
               CAST(CASE WHEN k = 9 THEN 1 ELSE v END AS INT) AS version
        FROM (SELECT *, CAST(right(supplier_id, 1) AS INT) AS k FROM s_supplier_master),
             (VALUES (1), (2)) AS t(v)
        WHERE (v = 1 AND k <> 9) OR (v = 2 AND k % 3 = 0)"""
    q["csv_columns_in_any_order"] = """
        SELECT CASE WHEN right(supplier_id, 1) IN ('1', '3', '5', '7', '9') THEN 'odd' ELSE 'even' END AS folder,
               count(*) AS row_count, count(*) AS named_ids, count(*) AS tiers
        FROM b_supplier_master GROUP BY 1"""
    q["csv_quoted_line_breaks"] = """
        SELECT medicine_id, medicine_name || CASE WHEN right(medicine_id, 1) IN ('1', '4', '7')
                   THEN chr(10) || '"no, 2",' || chr(10) ELSE '' END AS medicine_name,
               category, unit_of_measure, shelf_life_days
        FROM b_medicine_catalogue"""
    first, all_six = (", ".join(SOURCES["supplier_master"].columns[:n]) for n in (5, 6))
    q["csv_bad_records"] = f"""
        SELECT CASE WHEN k IN ('1', '2', '3') THEN 'kept' ELSE 'read' END AS outcome,
               CASE k WHEN '1' THEN concat_ws(',', {first}) WHEN '2' THEN concat_ws(',', {all_six}, 'x')
                      WHEN '3' THEN concat_ws(',', {all_six}, '', 'x') ELSE concat_ws(',', {all_six}) END AS record,
               TRUE AS has_place
        FROM (SELECT *, right(supplier_id, 1) AS k FROM b_supplier_master)"""
    q["json_array_source"] = f"SELECT {_bronze_columns('medicine_catalogue')} FROM b_medicine_catalogue"
    q["json_one_large_array"] = """
        SELECT * REPLACE (currency || CASE WHEN right(po_id, 1) IN ('1', '3') THEN '"},{[\\' ELSE '' END AS currency)
        FROM b_purchase_orders"""
    q["source_formats"] = " UNION ALL ".join(
        f"SELECT '{f}' AS format, count(*) AS row_count, count(*) AS named_ids, 'read' AS outcome FROM b_supplier_master "
        f"UNION ALL SELECT '{f}, absent', 0, 0, 'FileNotFoundError'" for f in ("csv", "json", "parquet")
    ) + " UNION ALL SELECT 'xml', 0, 0, 'KeyError' UNION ALL SELECT 'xml, absent', 0, 0, 'FileNotFoundError'"
    q["stock_levels_by_settings"] = """
        SELECT CASE WHEN quantity_on_hand < 100 THEN 'Below Min'
                    WHEN quantity_on_hand > 10000 THEN 'Above Max' ELSE 'OK' END AS stock_status,
               count(*) AS row_count, TRUE AS all_sources FROM s_warehouse_inventory GROUP BY 1"""
    q["landed_source_files"] = ("SELECT count(*) AS row_count, count(*) AS rows_with_file, "
                                "TRUE AS several_files FROM b_medicine_catalogue")
    q["views_after_reloads"] = "SELECT * FROM details"
    q["silver_outcomes_any_order"] = q["silver_outcomes"]
    q["dim_country"] = ("SELECT DISTINCT country AS country_name, CAST(NULL AS VARCHAR) AS "
                        "risk_tier FROM s_supplier_master")
    q["dim_supplier"] = ("SELECT supplier_id, supplier_name, country AS country_name, "
                         "performance_tier FROM s_supplier_master")
    q["dim_medicine"] = "SELECT * FROM s_medicine_catalogue"
    q["dim_warehouse"] = ("SELECT DISTINCT warehouse_id, CAST(NULL AS VARCHAR) AS region, "
                          "CAST(NULL AS BIGINT) AS country_key FROM s_shipment_records")
    sizes = {"dim_country": "(SELECT DISTINCT country FROM s_supplier_master)",
             "dim_supplier": "s_supplier_master", "dim_medicine": "s_medicine_catalogue",
             "dim_warehouse": "(SELECT DISTINCT warehouse_id FROM s_shipment_records)",
             "fact_shipment": "f"}
    q["surrogate_keys"] = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, count(*) AS distinct_keys FROM {r}"
        for t, r in sizes.items())
    key = "CAST(strftime({}, '%Y%m%d') AS INT)"
    q["fact_shipment"] = f"""
        SELECT shipment_id, supplier_id, medicine_id, warehouse_id, country_name,
               {key.format('order_date')} AS order_date_key, {key.format('eta')} AS eta_date_key,
               {key.format('actual_arrival')} AS actual_arrival_date_key, quantity,
               CAST(total_cost AS DOUBLE) AS total_cost, currency,
               CAST(delay_days AS INT) AS delay_days, is_delayed, status FROM f"""
    q["fact_partial_upsert"] = """
        SELECT shipment_id, quantity, CAST(delay_days AS INT) AS delay_days,
               coalesce(delay_days > 5, FALSE) AS is_delayed, 'Closed' AS status,
               FALSE AS new_key FROM f
        UNION ALL SELECT 'NEW-' || shipment_id, quantity + 1, CAST(delay_days AS INT), TRUE,
               'Closed', TRUE FROM f WHERE delay_days > 5"""
    week = "eta BETWEEN DATE '1997-04-07' AND DATE '1997-04-13'"
    late = f"{week} AND delay_days > 5"
    n = f"(SELECT count(*) FROM f) + (SELECT count(*) FROM f WHERE {late})"
    q["fact_merge_of_a_week"] = f"""
        SELECT shipment_id, quantity, CASE WHEN {week} THEN 'Closed' ELSE status END AS status,
               TRUE AS others_kept, {n} AS summed FROM f
        UNION ALL SELECT 'NEW-' || shipment_id, quantity + 1, 'Closed', TRUE, {n} FROM f WHERE {late}"""
    q["dim_type1_upsert"] = """
        SELECT b.supplier_id, upper(b.supplier_name) AS supplier_name,
               'New ' || b.performance_tier AS performance_tier,
               CASE WHEN s.supplier_id IS NOT NULL THEN TRUE END AS kept_key
        FROM b_supplier_master b LEFT JOIN s_supplier_master s USING (supplier_id)"""
    q["insert_if_absent_values"] = (
        "SELECT DISTINCT medicine_id FROM b_medicine_catalogue WHERE medicine_id NOT IN "
        "(SELECT medicine_id FROM s_medicine_catalogue)")

    q["vw_shipment_details"] = "SELECT * FROM details"
    q["vw_supplier_performance"] = "SELECT * FROM performance"
    q["vw_medicine_expiry_risk"] = _EXPIRY
    q["views_through_sql"] = (
        "SELECT 'shipment_details' AS view_name, count(*) AS row_count FROM details UNION ALL "
        "SELECT 'supplier_performance', count(*) FROM performance UNION ALL "
        f"SELECT 'medicine_expiry_risk', count(*) FROM ({_EXPIRY})")
    q["supplier_table"] = "SELECT * EXCLUDE (avg_delay_days) FROM performance"
    q["kpi_totals"] = """
        SELECT count(*) AS total_shipments,
               count(*) FILTER (WHERE is_delayed) AS delayed_shipments,
               CAST(sum(total_cost) AS DOUBLE) AS total_procurement_cost,
               CAST(count(*) FILTER (WHERE NOT is_delayed) AS DOUBLE) / nullif(count(*), 0)
                 AS on_time_delivery_rate FROM f"""
    q["kpi_totals_of_the_fact"] = q["kpi_totals"]
    q["delayed_by_country"] = ("SELECT country_name, count(*) FILTER (WHERE is_delayed) AS "
                               "delayed_shipments FROM f GROUP BY 1 ORDER BY 2 DESC, 1")
    q["cost_by_country"] = ("SELECT country_name, CAST(sum(total_cost) AS DOUBLE) AS "
                            "total_procurement_cost FROM f GROUP BY 1 ORDER BY 2 DESC, 1")
    q["volume_by_month"] = ("SELECT eta_year, eta_month, count(*) AS total_shipments "
                            "FROM details GROUP BY 1, 2 ORDER BY 1, 2")
    q["shipments_by_supplier"] = (
        "SELECT supplier_id, count(*) AS total_shipments FROM f GROUP BY 1")
    q["delayed_in_quarter"] = (
        "SELECT * FROM details WHERE is_delayed AND eta_year = 1997 AND eta_quarter = 2")
    q["stock_levels"] = """
        SELECT warehouse_id, medicine_id, batch_number, quantity_on_hand,
               CASE WHEN quantity_on_hand < 100 THEN 'Below Min'
                    WHEN quantity_on_hand > 10000 THEN 'Above Max' ELSE 'OK' END AS stock_status
        FROM s_warehouse_inventory"""

    q["check_freshness"] = " UNION ALL ".join(
        _freshness("events", _hours_to(at), "log")
        for at in ("2024-01-31 10:00:00", "2024-02-02 00:00:00"))
    day = "'run-2024-01-15'"
    q["check_row_count_deviation"] = " UNION ALL ".join([
        _deviation("newest", "30", _NEWEST), _deviation("named", "30", day),
        _deviation("trailing", "30", _NEWEST, _WEEK), _deviation("strict", "0.001", day)])
    q["latest_run"] = f"SELECT {_NEWEST} AS run_id"
    q["run_counts"] = "SELECT run_id, n AS run_count FROM runs"
    q["rows_in_run"] = f"SELECT count(*) AS row_count FROM log WHERE run_id = {day}"
    mean = "SELECT CAST(sum(n) AS DOUBLE) / count(*) AS historical_avg FROM runs WHERE run_id <> "
    q["average_of_other_runs"] = mean + day
    q["average_of_trailing_runs"] = f"{mean}{day} AND {_WEEK}"
    q["latest_ingest_per_source"] = (
        "SELECT source_file, CAST(max(ingested_at) AS VARCHAR) AS last_ingested_at "
        "FROM log GROUP BY 1")
    q["check_uniqueness_silver"] = " UNION ALL ".join(_uniqueness(n, "s", n) for n in NAMES)
    q["check_uniqueness_bronze"] = " UNION ALL ".join(
        _uniqueness(n, "b", f"{n}_raw") for n in NAMES)
    q["duplicate_order_ids"] = ("SELECT po_id, count(*) AS occurrence_count FROM "
                                "b_purchase_orders GROUP BY 1 HAVING count(*) > 1")
    q["check_consistency"] = _CONSISTENCY
    q["check_suite"] = f"SELECT 'quality-1' AS run_id, * FROM ({_SUITE})"
    q["check_summary"] = f"{_SUMMARY} FROM ({_SUITE})"
    q["check_summary_late"] = f"{_SUMMARY} FROM ({_LATE})"
    q["check_failures"] = (
        "SELECT upper(check_category) AS category, check_id, severity, description, details "
        f"FROM ({_LATE}) WHERE status = 'FAIL'")
    q["check_trend"] = " UNION ALL ".join(
        f"SELECT '{day}' AS checked_on, status, count(*) AS check_count "
        f"FROM ({suite}) WHERE check_id = 'FRESH-01' GROUP BY 2"
        for day, suite in (("1998-01-01", _SUITE), ("1998-01-03", _LATE)))
    q["quality_report_lines"] = f"""
        SELECT unnest([
            'Total checks: ' || total || '   Passed: ' || passed || '   Failed: ' || failed,
            'Critical failures: ' || critical || '   Warnings: ' || warning,
            'All quality checks passed. No issues detected.']) AS line
        FROM ({_SUMMARY} FROM ({_SUITE}))"""
    q["whole_run_from_files"] = f"""
        SELECT o.*, (SELECT CASE o.source {' '.join(
            f"WHEN '{n}' THEN (SELECT count(*) FROM b_{n})" for n in NAMES)} END) AS rows_loaded,
               CASE WHEN source = 'shipment_records' THEN (SELECT count(*) FROM f) END AS gold_rows
        FROM ({q["silver_outcomes"]}) o"""
    for kind in ("null", "check", "unique", "fk"):
        q[f"constraints_{kind}"] = _constraints(kind)
    q["constraints_on_raw_orders"] = f"""
        SELECT * FROM (WITH raw AS (SELECT *, {_int('quantity')} AS qty, {_dec('total_cost')} AS cost
                     FROM b_purchase_orders) """ + _zero([
        ("raw", "q not null", "SELECT count(*) FROM raw WHERE qty IS NULL"),
        ("raw", "c not null", "SELECT count(*) FROM raw WHERE cost IS NULL"),
        ("raw", "po_id not null", "SELECT count(*) FROM raw WHERE po_id IS NULL"),
        ("raw", "quantity > 0", "SELECT count(*) FROM raw WHERE NOT (qty > 0)"),
        ("raw", "total_cost >= 0", "SELECT count(*) FROM raw WHERE NOT (cost >= 0)"),
        ("raw", "unique (po_id)",
         "SELECT count(*) FROM (SELECT po_id FROM raw GROUP BY 1 HAVING count(*) > 1)"),
        ("raw", "supplier_id references silver.supplier_master",
         "SELECT count(*) FROM raw WHERE supplier_id NOT IN "
         "(SELECT supplier_id FROM s_supplier_master)"),
    ]) + ")"
    return {name: sql(body) for name, body in q.items()}
