"""The summary of large tables is made slice by slice, and what a slice shuffled is gone before the next one."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from vendorlens.operators import deliveries, summary, vendors
from vendorlens.plans import incremental, queries, refresh, slices
from vendorlens.plans.workspace import Workspace
from vendorlens.sources import shared, tables, versions
from vendorlens.sources.tables import create_database, database_folder

from .compare import difference
from .test_mart import invoice, listed, purchase, sale, table
from .test_round_four import star
from .test_versions import delivered, first_rows, full


def shuffle_files(spark) -> list[str]:
    places = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return [f for place in places for _, _, files in os.walk(place) for f in files if f.startswith("shuffle_")]


def raw_tables(spark):
    """Products without a Brand, with several names and prices, sold by several vendors, and repeated rows."""
    some = range(1, 31)
    bought = [purchase(vendor=b % 4, brand=b, quantity=b) for b in some] + [purchase(vendor=1, brand=3, name="B")] * 2
    return {name: table(spark, name, *rows) for name, rows in {
        "purchases": bought + [purchase(brand=None), purchase(vendor=None, brand=5), purchase(brand=77)],
        "purchase_prices": [listed(brand=b) for b in some] + [listed(brand=3, price="99.00"), listed(brand=3, price="99.00"), listed(brand=None)],
        "sales": [sale(vendor=b % 4, brand=b) for b in some if b % 3] + [sale(vendor=1, brand=3), sale(brand=None), sale(vendor=None, brand=5)],
        "vendor_invoice": [invoice(v) for v in (0, 1, 1, 3)] + [invoice(None)],
    }.items()}


def same_rows(a, b) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture
def star_folder(spark, tmp_path):
    read = star(spark)
    for name in ("part", "supplier", "region", "orders", "lineitem"):
        read(name).coalesce(1).write.parquet(str(tmp_path / "star" / f"{name}.parquet"))
    return str(tmp_path / "star")


@pytest.fixture
def large(monkeypatch):
    """Tables of any size are large."""
    monkeypatch.setattr(slices, "SLICE_BYTES", 1)
    monkeypatch.setattr(slices, "SLICES", 3)


@pytest.fixture
def stored(monkeypatch):
    """Folders that are written to, one entry for each write."""
    found, store = [], shared.store

    def kept(df, path, add=False):
        found.append(path.rsplit("/", 1)[-1].split("-")[0] if "/v-" not in path else path.split("/")[-2])
        store(df, path, add)

    monkeypatch.setattr(shared, "store", kept)
    monkeypatch.setattr(tables, "store", kept)
    return found


def test_staged_rows_leave_no_shuffle_files(spark):
    before = set(shuffle_files(spark))
    rows = shared.stage(spark.range(5_000).groupBy((F.col("id") % 700).alias("k")).agg(F.sum("id").alias("s")), "sums")
    until = time.time() + 10
    while (left := set(shuffle_files(spark)) - before) and time.time() < until:
        time.sleep(0.2)  # they are removed in the background
    assert not left and rows.count() == 700


def test_staging_keeps_the_sessions_setting(spark):
    shared.stage(spark.range(3), "three")
    assert spark.conf.get(shared.FREE_KEY) == "false"
    spark.conf.set(shared.FREE_KEY, "true")
    try:
        shared.stage(spark.range(3), "three")
        assert spark.conf.get(shared.FREE_KEY) == "true"
    finally:
        spark.conf.unset(shared.FREE_KEY)


@pytest.mark.parametrize("count", [2, 5])
def test_slices_are_the_whole_summary(spark, monkeypatch, count):
    raw = raw_tables(spark)
    monkeypatch.setattr(slices, "slice_count", lambda *_: count)
    whole = summary.vendor_sales_summary(*[raw[n] for n in ("purchases", "purchase_prices", "sales", "vendor_invoice")])
    parts = shared.stage_parts(slices.summary_slices(raw), "parts")
    assert whole.count() > 30 and same_rows(whole, parts)


def test_slices_by_bytes_of_files(spark, tmp_path, monkeypatch):
    spark.range(1_000).write.parquet(str(tmp_path / "t"))
    scan, empty = spark.read.parquet(str(tmp_path / "t")), spark.createDataFrame([], "id bigint")
    assert slices.slice_count(scan, empty) == slices.slice_count(empty) == 1
    size = sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    monkeypatch.setattr(slices, "SLICE_BYTES", size // 3 + 1)
    assert slices.slice_count(scan) == 3
    assert slices.slice_count(scan.dropDuplicates(), empty) == 3
    assert slices.slice_count(*[scan] * 9) == slices.SLICES


def test_mart_of_large_tables_is_made_in_slices(spark, star_folder, large, stored):
    ws = Workspace(spark, star_folder)
    points = vendors.brand_scatter_points(ws.brands(), 500_000.0)
    assert stored.count("mart") == slices.SLICES and "vendor_invoice" not in stored
    assert not {"purchases", "sales", "purchase_prices"} & ws._staged.keys()  # only the mart needed them
    assert points.count() > 0 and ws["purchases"].count() == 200


def test_large_and_small_tables_give_the_same_mart(spark, star_folder, monkeypatch):
    small = Workspace(spark, star_folder)
    found = small.summary(), small.cleaned(), small.mart()
    monkeypatch.setattr(slices, "SLICE_BYTES", 1)
    monkeypatch.setattr(slices, "SLICES", 2)
    for one in (Workspace.summary, Workspace.cleaned, Workspace.mart):
        ws = Workspace(spark, star_folder)
        assert same_rows(one(ws), found[(Workspace.summary, Workspace.cleaned, Workspace.mart).index(one)])
    assert {"purchases", "vendor_invoice"} <= small._staged.keys()


def test_raw_tables_that_were_staged_before_stay(spark, star_folder, large):
    ws = Workspace(spark, star_folder)
    sales = ws["sales"]
    ws.summary()
    assert sales.count() == 200 and "sales" in ws._staged and "purchases" not in ws._staged


def test_names_come_from_a_summary_in_slices(spark, star_folder, large, stored):
    ws = Workspace(spark, star_folder)
    assert queries._QUERIES["distinct_brand_names"](ws).count() == 40
    assert stored.count("summary") == slices.SLICES


def test_sorted_summary_in_slices(spark, star_folder, large, stored):
    rows = queries._QUERIES["vendor_sales_summary"](Workspace(spark, star_folder)).collect()
    assert stored.count("summary") == slices.SLICES
    totals = [r.TotalPurchaseDollars for r in rows]
    assert len(rows) == 120 and totals == sorted(totals, reverse=True)


def test_appended_mart_of_large_tables(spark, star_folder, large, stored):
    found = queries._QUERIES["appended_mart"](Workspace(spark, star_folder))
    assert stored.count("mart") == slices.SLICES and found.count() == 120


def test_refresh_in_slices(spark, star_folder, large, stored):
    ws = Workspace(spark, star_folder)
    mart = queries._refresh(ws)
    assert stored.count("clean_data") == slices.SLICES
    assert same_rows(mart, ws.mart()) and mart.count() == 120


def test_refresh_that_stops_in_a_slice_leaves_nothing(spark, star_folder, large, tmp_path, monkeypatch):
    create_database(spark, "stops_in_slice", str(tmp_path / "db"))
    ws, store, done = Workspace(spark, star_folder), tables.store, []

    def stops(df, path, add=False):
        done.append(path)
        if len(done) == 3:
            raise RuntimeError("stopped")
        store(df, path, add)

    monkeypatch.setattr(tables, "store", stops)
    with pytest.raises(RuntimeError, match="stopped"):
        refresh.refresh_tables(spark, ws, "stops_in_slice")
    assert len(set(done)) == 1 and not shared.exists(spark, done[0])
    assert versions.current(spark, database_folder(spark, "stops_in_slice")).number == 0
    spark.sql("DROP DATABASE stops_in_slice CASCADE")


def test_added_rows_in_slices(spark, tmp_path, monkeypatch):
    """Two deliveries, the second with rows that came before: each table is written slice by slice, and no delivery stays."""
    written, store = [], incremental.store
    monkeypatch.setattr(incremental, "slice_count", lambda *_: 3)
    monkeypatch.setattr(incremental, "store", lambda df, path, add: written.append(path.split("/")[-2]) or store(df, path, add))
    kept = lambda: {f for f, *_ in shared.entries(spark, shared.application_dir(spark)) if "/delivery-" in f}
    before, seen, part = kept(), [], incremental.summary_of_totals
    monkeypatch.setattr(incremental, "summary_of_totals", lambda *totals: seen.append(kept() - before) or part(*totals))
    place, rows = str(tmp_path / "db"), first_rows()
    incremental.add_rows(spark, place, delivered(spark, **rows))
    more = {"purchases": [purchase(brand=3, quantity=4), purchase(brand=9), purchase(brand=1), purchase(brand=None)],
            "sales": [sale(brand=3), sale(brand=5)], "vendor_invoice": [invoice(2), invoice(3)], "purchase_prices": [listed(brand=9)]}
    after = incremental.add_rows(spark, place, delivered(spark, **more))
    both = {name: rows[name] + more[name] for name in rows}
    assert difference(incremental.mart_of_version(spark, after).toPandas(), full(spark, both)) is None
    assert all(written.count(name) == 6 for name in ("purchases", "sales_totals", "vendor_invoice", "vendor_invoice_totals", "summary"))
    assert seen == [set()] * 6 and kept() == before


def test_added_rows_release_large_raw_tables(spark, star_folder, large):
    ws = Workspace(spark, star_folder)
    rows = queries._refresh_added(ws)
    assert not set(ws._staged) & {"purchases", "sales", "vendor_invoice"}
    assert same_rows(rows, ws.mart()) and rows.count() == 120


def test_fingerprints_of_older_indexes_are_known(spark, monkeypatch):
    rows = spark.range(20).selectExpr("id", "string(id) AS t")
    assert {len(r.fingerprint) for r in deliveries.marked(rows).collect()} == {16}
    with monkeypatch.context() as patched:
        patched.setattr(deliveries, "BYTES", 32)
        older = shared.stage(deliveries.marked(rows.where("id < 15")), "older").select("fingerprint", "bucket")
    assert {len(r.fingerprint) for r in older.collect()} == {32}
    assert sorted(r.id for r in deliveries.unseen(deliveries.marked(rows), older).collect()) == [15, 16, 17, 18, 19]
