from __future__ import annotations

import json
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from siltstone.config import SOURCES, PipelineConfig, SourceSpec, load_config
from siltstone.operators.keys import next_base
from siltstone.sources import records
from siltstone.sources.bronze import add_audit_columns, ingest_all, land, load_metrics, rows_of_run
from siltstone.sources.lake import SNAPSHOTS, Lake
from siltstone.sources.readers import SOURCE_FILE, bad_records, read_source

CSV = SourceSpec("supplier_master", ("supplier_id", "supplier_name", "contact_email"),
                 ("supplier_id",))
JSON = SourceSpec("purchase_orders", ("po_id", "supplier_id", "quantity"), ("po_id",),
                  file_format="json")


@pytest.fixture
def csv_file(tmp_path):
    p = tmp_path / "s.csv"
    p.write_text("supplier_id,supplier_name,contact_email\nSUP-0001,Acme,a@x.org\n"
                 "SUP-0002,\"Be, \"\"Q\"\"\",\n")
    return replace(CSV, path=str(p))


@pytest.fixture
def json_file(tmp_path):
    p = tmp_path / "o.json"
    p.write_text(json.dumps([{"po_id": "PO-1", "supplier_id": "SUP-1", "quantity": 5000},
                             {"po_id": "PO-2", "supplier_id": None, "quantity": 1.5}], indent=1))
    return replace(JSON, path=str(p))


def values(df):
    return [tuple(r) for r in df.drop(SOURCE_FILE).collect()]


def test_csv_is_all_text_and_blanks_stay(spark, csv_file):
    df = read_source(spark, csv_file)
    assert df.first()[SOURCE_FILE].endswith("/s.csv")
    assert {t for _, t in df.dtypes} == {"string"}
    assert values(df) == [("SUP-0001", "Acme", "a@x.org"), ("SUP-0002", 'Be, "Q"', "")]


def test_csv_columns_bind_by_name(spark, tmp_path):
    p = tmp_path / "r.csv"
    p.write_text("contact_email,supplier_id\nq@x.org,S1\n")
    assert values(read_source(spark, replace(CSV, path=str(p)))) == [("S1", None, "q@x.org")]


def test_json_array_is_all_text(spark, json_file):
    df = read_source(spark, json_file)
    assert {t for _, t in df.dtypes} == {"string"}
    assert sorted(values(df)) == [("PO-1", "SUP-1", "5000"), ("PO-2", None, "1.5")]


def test_json_lines(spark, tmp_path):
    p = tmp_path / "o.jsonl"
    p.write_text('{"po_id":"PO-1","quantity":1.50}\n{"po_id":"PO-2"}\n')
    df = read_source(spark, replace(JSON, path=str(p), options={"multiLine": "false"}))
    assert values(df) == [("PO-1", None, "1.50"), ("PO-2", None, None)]


BROKEN = "supplier_id,supplier_name,contact_email\n"


def test_csv_keeps_line_breaks_inside_quotes(spark, tmp_path):
    """Windows and Unix line ends, doubled quotes at a break, a stray quote inside a field."""
    rows = [("S1", "one\ntwo", "a"), ("S2", 'x ""\n",\r\n""', ""), ("S3", "5\" pipe", "plain"), ("S4", "\n\n", "\n"),
            ("S5", "", "last")]
    text = BROKEN + "".join(
        f'{a},5" pipe,{c}\r\n' if "pipe" in b else '{},"{}","{}"\n'.format(a, b.replace('"', '""'), c) for a, b, c in rows)
    p = tmp_path / "b.csv"
    p.write_bytes(text.encode())
    assert sorted(values(read_source(spark, replace(CSV, path=str(p))))) == sorted(rows)


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2500")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_csv_line_breaks_across_splits(spark, tmp_path, small_splits):
    """Records of several splits, one much longer than a split, in two files of other columns."""
    rng = random.Random(5)
    for f, columns in enumerate((CSV.columns, CSV.columns[::-1])):
        want, lines = [], [",".join(columns)]
        for i in range(250):
            name = "".join(rng.choice(['"', "\n", ",", "a", "bc", " "]) for _ in range(rng.choice([0, 3, 30])))
            row = {"supplier_id": f"S{i}", "supplier_name": "\nlong " * 1000 if i == 120 else name, "contact_email": "x" * (i % 5)}
            want.append(tuple(row[c] for c in CSV.columns))
            lines.append(",".join('"' + row[c].replace('"', '""') + '"' for c in columns))
        (tmp_path / f"{f}.csv").write_bytes("\n".join(lines).encode())
        spec = replace(CSV, path=str(tmp_path / f"{f}.csv"))
        assert records.pieces(spark, [spec.path], "\n").rdd.getNumPartitions() > 5
        assert sorted(values(read_source(spark, spec))) == sorted(want)
    assert read_source(spark, replace(CSV, path=str(tmp_path))).count() == 500


@pytest.mark.parametrize("line", ["S1,x", "S1,x,,", "S1,x,a,b", "S1", '"a",b,c,,,"x"'])
def test_csv_records_of_other_lengths_stop_the_read_or_are_kept(spark, tmp_path, line):
    p = tmp_path / "b.csv"
    p.write_text(f'{BROKEN}S0,good,g\n"S9","two\nlines",g\n{line}\nS2,good,g\n')
    spec = replace(CSV, path=str(p))
    with pytest.raises(Exception, match="other fields than its header"):
        read_source(spark, spec).collect()
    spec = replace(spec, options={"badRecords": "keep"})
    assert sorted(r[0] for r in values(read_source(spark, spec))) == ["S0", "S2", "S9"]
    bad = bad_records(spark, spec).collect()
    assert [(r.line, r.record) for r in bad] == [(5, line)] and bad[0].source_file.endswith("b.csv")
    assert bad_records(spark, replace(CSV, path=str(p), options={"badRecords": "keep"})).count() == 1
    with pytest.raises(ValueError, match="badRecords"):
        read_source(spark, replace(spec, options={"badRecords": "drop"}))


@pytest.mark.parametrize("text", ['S1,x,"open', 'S1,"two\nlines",a\nS2,"never, closed\nS3,x,y\n'])
def test_csv_that_ends_inside_quotes_is_refused(spark, tmp_path, text):
    p = tmp_path / "b.csv"
    p.write_text(BROKEN + text)
    with pytest.raises(ValueError, match="ends inside quotes"):
        read_source(spark, replace(CSV, path=str(p)))


def test_csv_headers(spark, tmp_path):
    p = tmp_path / "h.csv"
    p.write_bytes(b"\xef\xbb\xbfcontact_email,supplier_id\r\nq@x.org,S1\r\n\r\n")
    assert values(read_source(spark, replace(CSV, path=str(p)))) == [("S1", None, "q@x.org")]
    for header in ("supplier_id,colour", "supplier_id,supplier_id"):
        p.write_text(f"{header}\nS1,x\n")
        with pytest.raises(ValueError, match="columns"):
            read_source(spark, replace(CSV, path=str(p)))
    p.write_text("supplier_id;supplier_name;contact_email\nS1;a,b;\n")
    assert values(read_source(spark, replace(CSV, path=str(p), options={"sep": ";"}))) == [("S1", "a,b", "")]
    p.write_text(BROKEN)
    assert values(read_source(spark, replace(CSV, path=str(p)))) == []


def test_landing_keeps_bad_records(spark, tmp_path):
    p = tmp_path / "b.csv"
    p.write_text(f"{BROKEN}S0,good,g\nS1,x\n")
    spec = replace(CSV, path=str(p), options={"badRecords": "keep"})
    lake = Lake(spark, str(tmp_path / "lake"))
    assert ingest_all(lake, PipelineConfig(sources=(spec,)), "r1").first().rows_loaded == 1
    assert [(r.source, r.line, r.record, r.run_id) for r in lake.read("bronze", "bad_records").collect()] == [
        (CSV.name, 3, "S1,x", "r1")]


OBJECTS = [{"po_id": f"P{i}", "supplier_id": ['plain', '"},{[\\', "}", '\\"', "{", None, "a\nb", "é😀"][i % 8],
            "quantity": [5000, 1.5, {"a": [{"b": "}"}, {"c": "{\\"}]}, [1, {"x": {}}], True, None][i % 6]}
           for i in range(600)]


@pytest.mark.parametrize("indent", [None, 1])
def test_json_array_is_read_by_many_tasks(spark, tmp_path, small_splits, indent):
    p = tmp_path / "o.json"
    p.write_text(json.dumps(OBJECTS, indent=indent))
    assert records.pieces(spark, [str(p)], "}").rdd.getNumPartitions() > 5
    got = {r[0]: r[1:] for r in values(read_source(spark, replace(JSON, path=str(p))))}
    assert len(got) == len(OBJECTS)
    for o in OBJECTS:
        supplier, quantity = got[o["po_id"]]
        assert supplier == o["supplier_id"]
        assert (None if quantity is None else json.loads(quantity)) == o["quantity"]


@pytest.mark.parametrize("text", ['{"po_id": "P1"}', '[{"po_id": "P1"}', '[{"po_id": "P1"} {"po_id": "P2"}]', '[{"po_id": "P1}]',
                                  '[{"po_id": "P1"}] x', '[{"po_id": "P1"}, 5]', "[1, 2]", '[{"po_id": P1}]', "no json",
                                  '[{"po_id": "P1"}][{"po_id": "P2"}]'])
def test_what_is_no_json_array_is_refused(spark, tmp_path, text):
    p = tmp_path / "o.json"
    p.write_text(text)
    with pytest.raises(Exception, match="o.json|MALFORMED_RECORD|Malformed"):
        read_source(spark, replace(JSON, path=str(p))).collect()


def test_empty_json_arrays(spark, tmp_path):
    (tmp_path / "a.json").write_text(" [ ] \n")
    (tmp_path / "b.json").write_text('[{"po_id": "P1"}]')
    (tmp_path / "c.json").write_text("")
    assert values(read_source(spark, replace(JSON, path=str(tmp_path)))) == [("P1", None, None)]


def test_missing_file_and_unknown_format(spark, csv_file, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_source(spark, replace(CSV, path=str(tmp_path / "none.csv")))
    with pytest.raises(KeyError):
        read_source(spark, replace(csv_file, file_format="xml"))


def test_audit_columns(spark, csv_file):
    df = add_audit_columns(read_source(spark, csv_file), "f.csv", "run-1")
    assert "ingested_at" not in df.columns
    assert [tuple(r) for r in df.select("source_file", "run_id").distinct().collect()] == [
        ("f.csv", "run-1")]


def test_landing_appends_runs_with_unique_ids(spark, csv_file, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    df = read_source(spark, csv_file)
    assert land(lake, df, csv_file, "r1") == 2
    assert land(lake, df, csv_file, "r2") == 2
    rows = lake.read("bronze", "supplier_master_raw", csv_file.bronze_schema)
    got = rows.select("bronze_id", "run_id", "source_file").collect()
    assert len({r.bronze_id for r in got}) == 4
    assert {r.source_file.removeprefix("file:") for r in got} == {csv_file.path}
    by_run = {run: [r.bronze_id for r in got if r.run_id == run] for run in ("r1", "r2")}
    assert max(by_run["r1"]) < min(by_run["r2"])
    assert rows_of_run(lake, [csv_file], "r1").first().row_count == 2
    assert load_metrics(lake, "r2").first().rows_loaded == 2


def test_a_landed_run_cannot_be_overwritten(spark, csv_file, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    df = read_source(spark, csv_file)
    land(lake, df, csv_file, "r1")
    with pytest.raises(ValueError):
        land(lake, df, csv_file, "r1")


def test_half_landed_run_is_replaced_and_its_ids_are_not_reused(spark, csv_file, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    df = read_source(spark, csv_file)
    # A run that wrote rows and died before it was logged.
    stray = add_audit_columns(df, "f", "r1").withColumns(
        {"bronze_id": F.lit(5).cast("long"), "ingested_at": F.current_timestamp()})
    lake.put_partition(stray, "bronze", "supplier_master_raw", run_id="r1")
    land(lake, df, csv_file, "r2")
    land(lake, df, csv_file, "r1")
    ids = [r.bronze_id for r in
           lake.read("bronze", "supplier_master_raw", csv_file.bronze_schema).collect()]
    assert len(ids) == len(set(ids)) == 4 and 5 not in ids


def test_next_base_opens_a_fresh_block():
    assert next_base(None) == 1
    for top in (1, 2**33 - 1, 2**33, 3 * 2**33 + 7):
        base = next_base(top)
        assert base > top and base % 2**33 == 0


def test_missing_source_stops_the_run_before_any_write(spark, csv_file, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    lost = replace(JSON, path=str(tmp_path / "none.json"))
    with pytest.raises(FileNotFoundError):
        ingest_all(lake, PipelineConfig(sources=(csv_file, lost)), "r1")
    assert not lake.exists("bronze", "supplier_master_raw")


def test_snapshots(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    for i in range(3):
        row = [(i, "x", None)]
        lake.replace(spark.createDataFrame(
            row, "country_key long, country_name string, risk_tier string"), "gold", "dim_country")
    assert [r.country_key for r in lake.read("gold", "dim_country").collect()] == [2]
    assert lake.expire("gold", "dim_country") == ["v=00000001"]
    # A snapshot whose list of folders was never put in place is not there yet.
    pointers = tmp_path / "lake/gold/dim_country" / SNAPSHOTS
    (pointers / "00000003").unlink()
    assert [r.country_key for r in lake.read("gold", "dim_country").collect()] == [1]
    # Folders of which none was committed are no table, and no empty one either.
    (pointers / "00000002").unlink()
    assert not lake.exists("gold", "dim_country")
    with pytest.raises(RuntimeError):
        lake.read("gold", "dim_country")


def test_a_commit_is_one_rename(spark, tmp_path):
    """An append is seen whole or not at all, and two writers cannot commit one number."""
    lake = Lake(spark, str(tmp_path / "lake"))
    rows = [spark.createDataFrame([(i, f"c{i}", None)], "country_key long, country_name string, risk_tier string")
            for i in range(3)]
    lake.replace(rows[0], "gold", "dim_country")
    lake.append_to_current(rows[1], "gold", "dim_country")
    pointer = tmp_path / "lake/gold/dim_country" / SNAPSHOTS / "00000002"
    assert pointer.read_text().split() == ["v=00000001", "v=00000002"]
    # A writer that died after its data and before its commit leaves a folder nobody reads,
    # and whose number is not used again.
    rows[2].write.parquet(str(tmp_path / "lake/gold/dim_country/v=00000003"))
    assert sorted(r.country_key for r in lake.read("gold", "dim_country").collect()) == [0, 1]
    lake.append_to_current(rows[2], "gold", "dim_country")
    assert lake.current_paths("gold", "dim_country")[-1].endswith("v=00000004")
    assert sorted(r.country_key for r in lake.read("gold", "dim_country").collect()) == [0, 1, 2]
    # Expiring keeps folders that a kept snapshot still lists.
    assert lake.expire("gold", "dim_country", keep=1) == ["v=00000003"]
    assert lake.read("gold", "dim_country").count() == 3

def test_config(tmp_path):
    cfg = load_config()
    assert (cfg.delay_threshold_days, cfg.expiry_warning_days) == (3, 90)
    assert (cfg.min_stock_units, cfg.max_stock_units) == (100, 10000)
    assert (cfg.freshness_max_age_hours, cfg.row_count_deviation_threshold_pct) == (26, 30)
    assert [s.name for s in cfg.sources] == list(SOURCES)
    with pytest.raises(FileNotFoundError):
        load_config(tmp_path / "none.yaml")
    p = tmp_path / "c.json"
    p.write_text(json.dumps({
        "shipment_delay": {"delay_threshold_days": 5},
        "internal_sources": [{"name": "returns", "file_format": "csv", "path": "r.csv",
                              "columns": ["a", "b"], "natural_key": ["a"]}]}))
    cfg = load_config(p)
    assert cfg.delay_threshold_days == 5 and cfg.sources[0].bronze_table == "returns_raw"
