"""Files, tables, streams and the refresh job."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from vendorlens.operators import ids, profile, summary
from vendorlens.operators.dedupe import drop_duplicate_rows
from vendorlens.plans.refresh import cleaned_of, mart_of, refresh
from vendorlens.sources import files, jdbc, tables
from vendorlens.sources.retail import raw_table
from vendorlens.sources.schemas import MART_SCHEMA, RAW_SCHEMAS, column_types
from vendorlens.sources.shared import shared_dir, stage
from vendorlens.streaming.ingest import ingest_new_files

SMALL = "/root/testdata/sf0.001"


def same(a, b) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture(scope="module")
def raw(spark):
    return {name: stage(raw_table(spark, SMALL, name), name) for name in RAW_SCHEMAS}


@pytest.fixture(scope="module")
def csv_folder(raw, tmp_path_factory):
    """The raw tables as one CSV file each, every row of sales delivered twice."""
    folder = tmp_path_factory.mktemp("csv")
    for name, df in raw.items():
        frame = (df.unionAll(df) if name == "sales" else df).toPandas()
        frame.to_csv(folder / f"{name}.csv", index=False)
    (folder / "notes.txt").write_text("not a table")
    return str(folder)


def test_refresh_from_files_twice(spark, raw, csv_folder):
    first = stage(refresh(spark, csv_folder, "refresh_test"), "first")
    again = refresh(spark, csv_folder, "refresh_test")
    assert same(first, again)
    assert same(first, mart_of(cleaned_of(raw)))
    assert tables.list_tables(spark, "refresh_test") == sorted([*RAW_SCHEMAS, "clean_data", "vendor_sales_summary"])
    assert spark.table("refresh_test.sales").count() == raw["sales"].count()
    assert dict(again.dtypes) == column_types(MART_SCHEMA)
    profit = F.round(F.col("TotalSalesDollars") - F.col("TotalPurchaseDollars"), 2)
    assert again.where(F.abs(F.col("GrossProfit") - profit) > 0.006).isEmpty()


def test_csv_round_trip_keeps_types_and_blanks(spark, raw, csv_folder, tmp_path):
    for name in ("purchases", "vendor_invoice", "begin_inventory"):
        read = files.read_table_file(spark, f"{csv_folder}/{name}.csv")
        assert read.dtypes == raw[name].dtypes
        assert same(read, raw[name])
    files.write_csv(raw["purchase_prices"], str(tmp_path / "purchase_prices.csv"))
    assert same(files.read_table_file(spark, str(tmp_path / "purchase_prices.csv")), raw["purchase_prices"])


def test_missing_marks_and_bad_numbers(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a,b\n1,"x ""y"", z"\nNA,null\n')
    rows = files.typed(files.read_landing(spark, str(path)), "a bigint, b string").collect()
    assert [tuple(r) for r in rows] == [(1, 'x "y", z'), (None, None)]
    path.write_text("a,b\nseven,x\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        files.typed(files.read_landing(spark, str(path)), "a bigint, b string").collect()


def test_landing_inference_and_names(spark, tmp_path):
    path = tmp_path / "other.csv"
    path.write_text("a,b\n1,x\n")
    assert files.read_landing(spark, str(path)).dtypes == [("a", "string"), ("b", "string")]
    assert files.read_table_file(spark, str(path)).dtypes == [("a", "int"), ("b", "string")]
    (tmp_path / "deeper").mkdir()
    (tmp_path / "deeper" / "hidden.csv").write_text("a\n1\n")
    (tmp_path / "notes.txt").write_text("text")
    (tmp_path / "_temporary").mkdir()
    assert [files.table_name_of(f) for f in files.csv_tables(spark, str(tmp_path))] == ["deeper", "other"]
    (tmp_path / "deeper.csv").write_text("a\n1\n")
    with pytest.raises(ValueError, match="two inputs"):
        files.csv_tables(spark, str(tmp_path))
    assert files.table_name_of("/x/vendor_invoice.csv") == "vendor_invoice"
    found = files.read_landing(spark, str(path)).select(files.table_name_column(F.input_file_name())).first()[0]
    assert found == "other"


@pytest.mark.parametrize("row", ["1,x,surplus", "1", '1,"two\nlines"'])
def test_rows_of_another_width_fail(spark, tmp_path, row):
    path = tmp_path / "t.csv"
    path.write_text(f"a,b\n0,y\n{row}\n")
    with pytest.raises(Exception, match="MALFORMED"):
        files.typed(files.read_landing(spark, str(path)), "a bigint, b string").collect()


def test_line_breaks_in_quotes(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a,b\n1,"two\nlines"\n')
    assert files.read_landing(spark, str(path), lines_in_quotes=True).first()["b"] == "two\nlines"


def test_written_folders_load_back(spark, raw, tmp_path):
    tables.create_database(spark, "folders_test")
    files.write_csv(raw["vendor_invoice"].repartition(3), str(tmp_path / "vendor_invoice.csv"))
    files.write_csv(raw["purchase_prices"].repartition(2), str(tmp_path / "purchase_prices"))
    assert files.ingest_directory(spark, str(tmp_path), "folders_test") == ["purchase_prices", "vendor_invoice"]
    assert same(spark.table("folders_test.vendor_invoice"), raw["vendor_invoice"])
    assert same(spark.table("folders_test.purchase_prices"), raw["purchase_prices"])


def test_every_region_counts(spark, tmp_path):
    """Inventories have a row for each region there is."""
    six = spark.read.parquet(f"{SMALL}/region.parquet").select("r_regionkey", "r_name")
    six.unionAll(spark.createDataFrame([(70, "MOON")], six.schema)).write.parquet(str(tmp_path / "region.parquet"))
    spark.read.parquet(f"{SMALL}/part.parquet").limit(1).write.parquet(str(tmp_path / "part.parquet"))
    found = raw_table(spark, str(tmp_path), "begin_inventory").collect()
    assert len(found) == 6 and {r.Store for r in found} == {0, 1, 2, 3, 4, 70}


def test_a_failed_write_leaves_the_table(spark):
    tables.create_database(spark, "atomic_test")
    good = spark.range(10).withColumnRenamed("id", "k")
    tables.save_table(good, "atomic_test.t")
    bad = good.withColumn("k", F.when(F.col("k") == 7, F.raise_error(F.lit("broken"))).otherwise(F.col("k")).cast("bigint"))
    with pytest.raises(Exception, match="broken"):
        tables.save_table(bad, "atomic_test.t", guard=good)
    assert spark.table("atomic_test.t").count() == 10
    tables.save_table(spark.table("atomic_test.t").where("k < 4"), "atomic_test.t")  # reads what it replaces
    assert spark.table("atomic_test.t").count() == 4
    tables.save_table(good.withColumn("more", F.lit("x")), "atomic_test.t")
    assert spark.table("atomic_test.t").columns == ["k", "more"]


def test_landing_table_is_empty_text(spark):
    tables.create_database(spark, "landing_test")
    df = spark.createDataFrame([(1, 2.0)], "a int, b double")
    tables.create_landing_table(df, "landing_test.t")
    assert spark.table("landing_test.t").dtypes == [("a", "string"), ("b", "string")]
    assert spark.table("landing_test.t").isEmpty()


def test_tables(spark):
    tables.create_database(spark, "tables_test")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, t string")
    assert tables.save_table(df, "tables_test.t") == 2
    assert tables.save_table(df, "tables_test.t", "append") == 2
    assert tables.load_table(spark, "tables_test.t").count() == 4
    assert tables.save_table(df, "tables_test.t") == 2
    with pytest.raises(ValueError, match="no rows"):
        tables.save_table(df.where("k > 5"), "tables_test.t")
    assert tables.load_table(spark, "tables_test.t").count() == 2  # left as it was
    with pytest.raises(ValueError, match="mode"):
        tables.save_table(df, "tables_test.t", "replace")
    with pytest.raises(ValueError, match="empty"):
        tables.create_database(spark, "")


def test_sql_over_named_tables(spark, raw):
    tables.register_views(raw)
    found = spark.sql("SELECT VendorNumber, sum(Freight) AS f FROM vendor_invoice GROUP BY VendorNumber")
    assert same(found.select("VendorNumber", F.col("f").cast("double").alias("FreightCost")),
                summary.freight_summary(raw["vendor_invoice"]))


def test_typed_append(spark):
    tables.create_database(spark, "typed_test")
    df = spark.createDataFrame([("7", 1)], "k string, extra int")
    tables.append_conformed(df, "typed_test.t", "k bigint")
    tables.append_conformed(df, "typed_test.t", "k bigint")
    assert [r.k for r in spark.table("typed_test.t").collect()] == [7, 7]
    tables.create_table(spark, "typed_test.mart")
    assert dict(spark.table("typed_test.mart").dtypes) == column_types(MART_SCHEMA)


def test_jdbc_options(spark):
    assert [jdbc.write_partitions(n) for n in (0, 200_000, 1_000_000)] == [4, 4, 5]
    assert jdbc.write_partitions(10**9, ceiling=64) == 64
    options = jdbc.jdbc_options("jdbc:x://h/db", "t", "u", "p", "d.Driver")
    assert options == {"url": "jdbc:x://h/db", "dbtable": "t", "user": "u", "password": "p", "driver": "d.Driver"}
    assert jdbc.jdbc_writer(spark.range(3), options, 5) is not None
    ranges = jdbc.read_options("PODate", "2024-01-01", "2024-12-31", 8)
    assert ranges == {"partitionColumn": "PODate", "lowerBound": "2024-01-01", "upperBound": "2024-12-31", "numPartitions": "8"}
    assert jdbc.jdbc_reader(spark, options, "PODate", "2024-01-01", "2024-12-31", 8) is not None
    with pytest.raises(ValueError, match="partition"):
        jdbc.read_options("k", "0", "9", 0)


def test_parallel_write_bounds_its_connections(spark, monkeypatch):
    asked = []

    class Writer:
        def save(self):
            asked.append("saved")

    monkeypatch.setattr(jdbc, "jdbc_writer", lambda df, options, partitions: asked.append(partitions) or Writer())
    monkeypatch.setattr(jdbc, "ROWS_PER_PARTITION", 10)
    assert jdbc.append_jdbc(spark.range(95), {}) == 95
    assert jdbc.append_jdbc(spark.range(2_000), {}) == 2_000
    assert asked == [9, "saved", jdbc.MAX_CONNECTIONS, "saved"]


def test_stream_adds_each_file_once(spark, raw, tmp_path):
    frame = raw["sales"].toPandas()
    inbox, target, progress = (str(tmp_path / d) for d in ("inbox", "target", "progress"))
    os.mkdir(inbox)

    def deliver(name, part):
        part.to_csv(f"{inbox}/{name}.csv", index=False)
        return ingest_new_files(spark, inbox, "sales", target, progress, per_batch=1)

    assert deliver("a", frame[:1000]) == 1000
    assert deliver("b", frame[1000:1500]) == 500
    assert ingest_new_files(spark, inbox, "sales", target, progress) == 0
    assert deliver("c", frame[1500:]) == len(frame) - 1500
    assert same(spark.read.parquet(target), raw["sales"])


def test_stream_counts_beyond_its_progress_reports(spark, raw, tmp_path):
    frame = raw["purchase_prices"].toPandas()
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    for i in range(6):
        frame[i : i + 1].to_csv(inbox / f"{i}.csv", index=False)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        added = ingest_new_files(spark, str(inbox), "purchase_prices", str(tmp_path / "t"), str(tmp_path / "p"), per_batch=1)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert added == 6


def test_stream_checks_headers(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "a.csv").write_text("Wrong,Names\n1,2\n")
    with pytest.raises(Exception):
        ingest_new_files(spark, str(inbox), "purchase_prices", str(tmp_path / "t"), str(tmp_path / "p"))


def test_ids(spark):
    df = spark.range(0, 1000, numPartitions=7).withColumnRenamed("id", "x")
    sparse = ids.add_surrogate_id(df)
    assert sparse.select("spark_id").distinct().count() == 1000
    dense = ids.add_dense_id(df)
    assert sorted(r.spark_id for r in dense.collect()) == list(range(1, 1001))
    assert dense.select("x").distinct().count() == 1000


def test_staging_uses_the_named_folder(spark):
    staged = stage(spark.range(3), "three")
    assert all(shared_dir(spark) in f for f in staged.inputFiles())
    assert staged.count() == 3


def test_profiles(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (2, "a")], "k int, t string")
    found = {r.column: (r.type, r.row_count, r.nulls) for r in profile.column_profile(df).collect()}
    assert found == {"k": ("int", 3, 0), "t": ("string", 3, 1)}
    assert profile.distinct_values(df, "t").count() == 2
    assert profile.distinct_count(df, "t", "n").first().n == 1
    assert [tuple(r) for r in profile.top_counts(df, "k").collect()] == [(2, 2), (1, 1)]
    assert profile.preview(df, 2).count() == 2
    assert profile.rows_of(df, "k", 2).count() == 2


def test_duplicates_removed_once_stay_removed(spark, raw):
    twice = raw["vendor_invoice"].unionAll(raw["vendor_invoice"])
    once = drop_duplicate_rows(twice)
    assert same(once, raw["vendor_invoice"])
    assert same(drop_duplicate_rows(once), once)
