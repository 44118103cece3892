from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from siltstone.functions import metrics, text


def values(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def check(spark, schema, make, cases):
    """One query over all (input, expected) pairs; ``make`` builds the tested column."""
    rows = [x if isinstance(x, tuple) else (x,) for x, _ in cases]
    got = [v for (v,) in values(spark, rows, schema, make)]
    assert got == [want for _, want in cases]


X = F.col


def test_strip_removes_every_kind_of_white_space(spark):
    check(spark, "x string", text.strip("x"), [
        ("  a b ", "a b"), ("\t a \n", "a"), ("\x1f\xa0a\u3000", "a"), ("", ""), (None, None),
        (" ", ""), ("é", "é"), ("é ", "é"), ("a\x7f", "a\x7f"), ("x\u00a0", "x")])


def test_strip_agrees_with_python_on_every_blank_character(spark):
    blanks = [chr(i) for i in range(0x11000) if chr(i).isspace()]
    got = values(spark, [(b + "x" + b,) for b in blanks], "x string", text.strip("x"))
    assert {g[0] for g in got} == {"x"}


def test_blank_helpers(spark):
    check(spark, "x string", text.is_empty(text.strip("x")), [
        (None, True), ("", True), (" \t", True), ("a", False), (" a", False)])
    check(spark, "x string", F.nullif(text.strip("x"), F.lit("")), [
        (None, None), (" ", None), (" a ", "a")])


def test_parse_date(spark):
    check(spark, "x string", text.to_date(text.strip("x")), [
        ("2025-01-05", dt.date(2025, 1, 5)), (" 2025-1-5 ", dt.date(2025, 1, 5)),
        ("2025-01- 5", dt.date(2025, 1, 5)), ("2024-02-29", dt.date(2024, 2, 29)),
        ("2025-02-29", None), ("2025-02-30", None), ("2025", None), ("2025-01", None),
        ("2025-01-05 10:00:00", None), ("2025/01/05", None), ("20250105", None), ("", None),
        ("0000-01-01", None), ("2025-13-01", None), ("12025-01-01", None), (None, None)])


def test_parse_int(spark):
    check(spark, "x string", text.to_int(text.strip("x")), [
        ("5", 5), (" +5 ", 5), ("-3", -3), ("1_000", 1000), ("007", 7), ("5.0", None),
        ("x", None), ("", None), ("1__0", None), ("_1", None), ("1e3", None),
        ("3000000000", 3000000000), ("99999999999999999999", None), (None, None)])


def test_parse_decimal(spark):
    check(spark, "x string", text.to_decimal(text.strip("x")).cast("string"), [
        ("1.005", "1.01"), ("1e3", "1000.00"), (".5", "0.50"), ("5.", "5.00"), ("-2", "-2.00"),
        ("1_000.50", "1000.50"), ("nan", None), ("inf", None), ("1,5", None), ("", None),
        ("10000000000", None), ("9999999999.99", "9999999999.99"), (None, None)])


def test_sign_is_taken_before_rounding(spark):
    check(spark, "x string", text.is_negative(X("x")), [
        ("-0.001", True), ("-0", False), ("0", False), ("x", False), (None, False)])


def test_delay_days_and_flag(spark):
    eta = dt.date(2026, 3, 10)
    rows = [(eta, dt.date(2026, 3, 10)), (eta, dt.date(2026, 3, 8)), (eta, dt.date(2026, 3, 15)),
            (eta, None), (eta, dt.date(2026, 3, 13)), (eta, dt.date(2026, 3, 14))]
    late = metrics.delay_days(F.col("e"), F.col("a"))
    got = values(spark, rows, "e date, a date", late, metrics.is_delayed(late, 3))
    assert got == [(0, False), (0, False), (5, True), (None, False), (3, False), (4, True)]


def test_date_key_is_null_safe(spark):
    got = values(spark, [(dt.date(2025, 1, 5),), (None,)], "d date", metrics.date_key(F.col("d")))
    assert got == [(20250105,), (None,)]


def test_expiry_status(spark):
    check(spark, "d int", metrics.expiry_status(X("d")), [
        (-1, "Expired"), (0, "At Risk (within 90 days)"), (90, "At Risk (within 90 days)"),
        (91, "OK")])


def test_stock_status(spark):
    check(spark, "q int", metrics.stock_status(X("q"), 100, 10000), [
        (99, "Below Min"), (100, "OK"), (10000, "OK"), (10001, "Above Max")])


def test_percent_rounds_half_up_and_guards_zero(spark):
    got = values(spark, [(1, 8), (1, 0), (0, 3), (2, 3)], "a bigint, b bigint",
                 metrics.percent(F.col("a"), F.col("b")))
    assert got == [(12.5,), (None,), (0.0,), (66.7,)]


def test_freshness_window(spark):
    check(spark, "h double", metrics.within_freshness_window(X("h"), 26), [
        (26.0, True), (25.9, True), (26.1, False), (72.0, False)])


def test_deviation(spark):
    check(spark, "t bigint, a double", metrics.row_count_deviation_pct(X("t"), X("a")), [
        ((200, 200.0), 0.0), ((250, 200.0), 25.0), ((100, 200.0), 50.0), ((0, 150.0), 100.0),
        ((5, 0.0), None), ((5, None), None)])


def test_tolerance(spark):
    check(spark, "p double", metrics.within_deviation_tolerance(X("p"), 30), [
        (30.0, True), (15.0, True), (45.0, False)])


def test_hours_since(spark):
    rows = [(dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2, 2, 0, 18))]
    got = values(spark, rows, "a timestamp, b timestamp",
                 metrics.hours_since(F.col("a"), F.col("b")))
    assert got == [(26.01,)]
