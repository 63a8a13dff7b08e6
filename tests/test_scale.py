"""Steps whose cost must follow the input: one de-duplication, one join, cells cut without the parser."""

import datetime as dt

from pyspark.sql import functions as F

from shiftlake.functions.dates import first_kept_values, first_values
from shiftlake.operators.dedup import keep_first
from shiftlake.params import CSV_QUOTE, CSV_SEP
from shiftlake.sources import fixture_files, raw_csv, records
from shiftlake.sources import fixtures as FX

ROWS = "id long, k string, a string, b string, c string, at struct<n:int>"


def _never(df):
    """The same columns; reading any row fails."""
    return df.where(F.raise_error(F.lit("de-duplicated")).cast("boolean"))


def test_first_values_are_told_without_the_deduplication(spark):
    rows = spark.createDataFrame([(1, "x", None, "b1", None, (1,)), (None, None, "a2", "b2", None, (2,)), (1, "x", "a3", None, None, (3,))], ROWS)
    assert first_kept_values(rows, _never(rows), ["id", "k"], ["a", "b", "c"], "at") == {"a": "a2", "b": "b1", "c": None}


def test_first_value_of_a_dropped_row_does_not_count(spark):
    for other in (1, None):  # null keys are one key, too
        rows = spark.createDataFrame([(other, "x", None, "b1", None, (1,)), (other, "x", "dropped", "b2", None, (2,)), (2, "x", "kept", None, None, (3,))], ROWS)
        kept = keep_first(rows, ["id", "k"], "at")
        told = first_kept_values(rows, kept, ["id", "k"], ["a", "b", "c"], "at")
        assert told == first_values(kept, ["a", "b", "c"], "at") == {"a": "kept", "b": "b1", "c": None}


def test_first_values_of_no_rows(spark):
    rows = spark.createDataFrame([], ROWS)
    assert first_kept_values(rows, rows, ["id"], ["a"], "at") == {"a": None}


def _tables(spark, folder, files=1):
    day = dt.datetime(1996, 1, 1)
    rows = spark.range(400).select(
        F.col("id").alias("l_orderkey"), (F.col("id") * 7).alias("l_partkey"), F.col("id").alias("l_suppkey"), (F.col("id") % 7 + 1).cast("int").alias("l_linenumber"),
        F.lit(8.0).alias("l_quantity"), F.lit(1.5).alias("l_extendedprice"), F.lit(0.05).alias("l_discount"), F.lit(0.02).alias("l_tax"), F.lit("R").alias("l_returnflag"))
    rows.coalesce(files).write.parquet(f"{folder}/lineitem.parquet")
    when = F.when(F.col("id") != 3, F.lit(day).cast("timestamp_ntz") + F.make_dt_interval((F.col("id") * 5).cast("int")))
    spark.range(400).select(F.col("id").alias("o_orderkey"), (F.col("id") % 9).alias("o_custkey"), when.alias("o_orderdate")).write.parquet(f"{folder}/orders.parquet")
    spark.range(9).select(F.col("id").alias("c_custkey"), F.lit("n").alias("c_name"), F.lit(1).alias("c_nationkey"), F.lit(5.0).alias("c_acctbal"), F.lit("S").alias("c_mktsegment")).write.parquet(f"{folder}/customer.parquet")
    spark.range(3).select(F.col("id").alias("s_suppkey"), F.lit("s").alias("s_name")).write.parquet(f"{folder}/supplier.parquet")
    return str(folder)


def test_one_file_table_is_not_dealt_out_by_cores(spark, tmp_path):
    d = _tables(spark, tmp_path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = FX.timesheets_raw(spark, d)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "REPARTITION_BY_NUM" not in plan
    assert plan.count("Exchange hashpartitioning") == 2  # one for each side of the join


def test_raw_timesheets_are_joined_once_and_in_order(spark, tmp_path, monkeypatch):
    d, written = _tables(spark, tmp_path), []
    dealt = fixture_files._dealt
    monkeypatch.setattr(fixture_files, "_dealt", lambda df, *order: written.append(order) or dealt(df, *order))
    raw = fixture_files._write_all(spark, d)
    assert len(written) == 2  # employees, all timesheets
    rows = raw_csv.accepted(raw_csv.extract_timesheets(spark, raw, keep_rejects=True)).orderBy("_ingest").collect()
    expected = FX.timesheets_raw(spark, d).where("scheduled_start_datetime is not null").orderBy("_ingest").collect()
    assert [(r.client_employee_id, r.scheduled_start_datetime) for r in rows] == [(str(r.client_employee_id), str(r.scheduled_start_datetime)) for r in expected]
    assert len(rows) == 399


def test_plain_records_are_cut_as_the_parser_cuts_them(spark):
    lines = ["a|b|c", "", "|", "||", "a", "a| b |\t", "é|\u00a0x", "a|b|c|d", "a|b|c|", 'x|"q|r"|y', 'a"b|c', "a\rb|c", "|||||", " |NA", "#|a", "\\|\\n"]
    schema = "_c0 string, _c1 string, _c2 string, _raw string"
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, record string")
    plain = raw_csv._is_plain(F.col("record"), 3)
    chosen = df.where(plain)
    assert {r.record for r in df.where(~plain).collect()} == {"a|b|c|d", "a|b|c|", 'x|"q|r"|y', 'a"b|c', "a\rb|c", "|||||"}
    parts = F.split("record", r"\|", -1)
    by_cut = chosen.select("i", *[F.nullif(F.get(parts, F.lit(k)), F.lit("")) for k in range(3)])
    by_parser = chosen.select("i", F.from_csv("record", F.lit(schema), {**raw_csv._CSV, "multiLine": "true"}).alias("x")).select("i", "x._c0", "x._c1", "x._c2")
    assert sorted(map(tuple, by_cut.collect()), key=str) == sorted(map(tuple, by_parser.collect()), key=str)


def test_only_crossed_splits_are_read_for_pieces(spark, tmp_path):
    text = "a|b\n" + "".join(f'{i}|"one\ntwo {i}"\n' if i % 50 == 0 else f"{i}|plain\n" for i in range(20000))
    (tmp_path / "big.csv").write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        found = records.catalogue(spark, [str(tmp_path / "big.csv")], CSV_SEP, CSV_QUOTE, str(tmp_path / "cat"))
        n = found.splits.where("crossed").count()
        assert 0 < n < found.n_splits / 2
        assert records.assembled(spark, [str(tmp_path / "big.csv")], found, CSV_SEP, CSV_QUOTE).count() == 20000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
