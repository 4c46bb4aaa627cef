"""Versions that change together, and the refresh for added rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vendorlens.operators import deliveries, ids, stats
from vendorlens.operators.modes import modes
from vendorlens.operators.skew import spread_join
from vendorlens.plans import incremental, refresh
from vendorlens.sources import files, versions
from vendorlens.sources.schemas import RAW_SCHEMAS
from vendorlens.sources.tables import create_database, load_table

from .compare import difference
from .test_mart import invoice, listed, purchase, sale, table

KINDS = {"purchases": purchase, "purchase_prices": listed, "sales": sale, "vendor_invoice": invoice}


def delivered(spark, **rows):
    return {name: table(spark, name, *found) for name, found in rows.items()}


def first_rows():
    return {
        "purchases": [purchase(brand=b) for b in range(6)], "purchase_prices": [listed(brand=b) for b in range(6)],
        "sales": [sale(brand=b) for b in range(0, 6, 2)], "vendor_invoice": [invoice(1), invoice(2)]}


def full(spark, rows):
    tables = {name: table(spark, name, *found).dropDuplicates() for name, found in rows.items()}
    return refresh.mart_of(refresh.cleaned_of(tables)).toPandas()


def test_added_rows_give_the_mart_of_a_full_rebuild(spark, tmp_path, monkeypatch):
    place, rows = str(tmp_path / "db"), first_rows()
    version = incremental.add_rows(spark, place, delivered(spark, **rows))
    assert difference(incremental.mart_of_version(spark, version).toPandas(), full(spark, rows)) is None
    more = {
        "purchases": [purchase(brand=3, quantity=4), purchase(brand=9), purchase(brand=1)],  # the last one came before
        "sales": [sale(brand=3), sale(brand=5)], "vendor_invoice": [invoice(2), invoice(3)], "purchase_prices": [listed(brand=9)]}
    before = incremental.mart_of_version(spark, version)
    read = []  # of rows delivered before only the fingerprints are read
    real = versions.Manifest.read

    def noted(self, session, name, ddl):
        if self.number and name in RAW_SCHEMAS:
            read.append(ddl)
        return real(self, session, name, ddl)

    monkeypatch.setattr(versions.Manifest, "read", noted)
    after = incremental.add_rows(spark, place, delivered(spark, **more))
    both = {name: rows[name] + more.get(name, []) for name in rows}
    assert difference(incremental.mart_of_version(spark, after).toPandas(), full(spark, both)) is None
    assert read == [deliveries.INDEX_SCHEMA] * 4
    assert len(before.collect()) == 6  # a reader of the earlier version goes on
    same = incremental.add_rows(spark, place, delivered(spark, **more))  # delivered again
    assert difference(incremental.mart_of_version(spark, same).toPandas(), full(spark, both)) is None


def test_a_stopped_run_leaves_the_version_before(spark, tmp_path, monkeypatch):
    place, rows = str(tmp_path / "db"), first_rows()
    version = incremental.add_rows(spark, place, delivered(spark, **rows))
    want = incremental.mart_of_version(spark, version).toPandas()
    for step in ("clean_summary", "vendor_features", "commit"):
        def stop(*_, **__):
            raise RuntimeError("stopped")

        with monkeypatch.context() as patched:
            patched.setattr(incremental, step, stop)
            with pytest.raises(RuntimeError, match="stopped"):
                incremental.add_rows(spark, place, delivered(spark, purchases=[purchase(brand=2, quantity=7)]))
        found = versions.current(spark, place)
        assert found == version and difference(incremental.mart_of_version(spark, found).toPandas(), want) is None


def test_one_writer_commits(spark, tmp_path):
    place = str(tmp_path / "db")
    before = versions.current(spark, place)
    first = versions.commit(spark, place, before, {"a": ("x",)})
    with pytest.raises(versions.Conflict):
        versions.commit(spark, place, before, {"a": ("y",)})
    assert versions.current(spark, place) == first and first.tables == {"a": ("x",)}


def test_vacuum_keeps_what_late_versions_name(spark, tmp_path):
    place, found = str(tmp_path / "db"), []
    version = versions.current(spark, place)
    for i in range(4):
        found.append(versions.new_folder(place, "t"))
        spark.range(i + 1).write.parquet(found[-1])
        version = versions.commit(spark, place, version, {"t": (found[0], found[-1]) if i else (found[0],)})
    assert versions.vacuum(spark, place) == [found[1]]
    assert versions.current(spark, place).read(spark, "t", "id bigint").count() == 5


def test_pair_belongs_together_at_every_step(spark, monkeypatch, tmp_path):
    """A refresh that stops before or after the manifest leaves clean rows and mart of one version."""
    create_database(spark, "pair_test", str(tmp_path / "pair"))
    tables = delivered(spark, **first_rows())
    refresh.refresh_tables(spark, tables, "pair_test")
    more = {**tables, "purchases": tables["purchases"].unionByName(table(spark, "purchases", purchase(brand=8))),
            "purchase_prices": tables["purchase_prices"].unionByName(table(spark, "purchase_prices", listed(brand=8)))}
    reader = refresh.load_pair(spark, "pair_test")[1]

    def stop(*_, **__):
        raise RuntimeError("stopped")

    for step, rows in (("commit", 6), ("publish", 7)):
        with monkeypatch.context() as patched:
            patched.setattr(refresh, step, stop)
            with pytest.raises(RuntimeError, match="stopped"):
                refresh.refresh_tables(spark, more, "pair_test")
        clean, mart = refresh.load_pair(spark, "pair_test")
        assert clean.count() == mart.count() == rows
    refresh.publish(spark, "pair_test")
    assert load_table(spark, "pair_test.vendor_sales_summary").count() == load_table(spark, "pair_test.clean_data").count() == 7
    assert reader.count() == 6
    spark.sql("DROP DATABASE pair_test CASCADE")


def test_fingerprints_tell_rows_apart(spark):
    df = spark.createDataFrame([(None, "null"), ("null", None), (None, None), ("a", "b"), ("ab", ""), ("a", "b")], "x string, y string")
    assert deliveries.marked(df).select("fingerprint").distinct().count() == 5
    turned = df.select("y", "x")
    assert deliveries.marked(turned).join(deliveries.marked(df), "fingerprint", "left_semi").count() == 5
    known = deliveries.marked(df.where("x IS NULL")).select("fingerprint", "bucket")
    assert {r.x for r in deliveries.unseen(deliveries.marked(df), known).collect()} == {"null", "a", "ab"}


def test_heavy_keys_are_spread(spark):
    """A third of the rows on one key, without adaptive execution: no task gets twice the rows of the median one."""
    rows = spark.range(90_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("Brand"), "id")
    prices = spark.range(90_000).select(F.col("id").alias("Brand"), (F.col("id") * 2).alias("Price"))
    prices = prices.unionByName(prices.where("Brand = 0").withColumn("Price", F.lit(7)))
    kept = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spread_join(rows, prices, "Brand")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        plain, found = rows.join(prices, "Brand"), joined
        assert found.count() == plain.count() and found.exceptAll(plain).isEmpty()
    finally:
        for c, v in kept.items():
            spark.conf.set(c, v)
    assert len(sizes) == 8 and max(sizes) < 2 * sorted(sizes)[4]


def test_spread_join_of_missing_keys(spark):
    rows = spark.createDataFrame([(1, "a"), (None, "b"), (1, "c")], "k int, v string")
    other = spark.createDataFrame([(1, "x"), (None, "y"), (2, "z")], "k int, w string")
    assert sorted(map(tuple, spread_join(rows, other, "k").collect())) == [(1, "a", "x"), (1, "c", "x")]
    assert spread_join(rows.limit(0), other, "k").count() == 0


def test_dense_ids_from_places(spark, tmp_path):
    spark.range(1_000).repartition(7).write.parquet(str(tmp_path / "t"))
    scan = spark.read.parquet(str(tmp_path / "t"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("ids only", "")
    found = ids.add_dense_id(scan)
    assert len(tracker.getJobIdsForGroup("ids only")) == 0
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    rows = found.collect()
    assert sorted(r.spark_id for r in rows) == list(range(1, 1_001)) and len({r.id for r in rows}) == 1_000
    assert rows == ids.add_dense_id(scan).collect()


def test_correlation_far_from_zero(spark):
    random = np.random.default_rng(4)
    x = random.normal(size=4_000)
    frame = pd.DataFrame({"a": 1e9 + x, "b": 1e9 + 0.5 * x + random.normal(size=4_000), "c": [1e9] * 4_000, "d": x})
    frame.loc[::7, "d"] = None
    df = spark.createDataFrame(frame).repartition(9)
    found = {(r.a, r.b): r.r for r in stats.correlation_matrix(df).collect()}
    want = frame.sub([1e9, 1e9, 0, 0]).corr()
    for (a, b), r in found.items():
        assert (r is None) if "c" in (a, b) else r == pytest.approx(want.loc[a, b], abs=1e-6)
    plan = stats.correlation_matrix(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("LocalTableScan") + plan.count("Scan ExistingRDD") <= 1


def test_parts_that_disagree_get_the_joined_type(spark, tmp_path):
    parts = ["n,m,d,b,t\n1,2,2024-01-02,true,x\n2,NA,,false,1\n", "n,m,d,b,t\n3.5,1e3,2024-01-03 04:05:06,TRUE,2\n", "n,m,d,b,t\nNaN,,,,\n"]
    (tmp_path / "p").mkdir()
    for i, text in enumerate(parts):
        (tmp_path / "p" / f"{i}.csv").write_text(text)
    found = files.read_inferred(spark, str(tmp_path / "p"))
    assert dict(found.dtypes) == {"n": "double", "m": "double", "d": "timestamp", "b": "boolean", "t": "string"}
    assert found.where("n IS NULL").count() == 1 and found.count() == 4
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "0.csv").write_text("a,b\n")
    assert dict(files.read_inferred(spark, str(tmp_path / "e")).dtypes) == {"a": "string", "b": "string"}


@pytest.mark.parametrize("kept", [2, 5, 4096])
def test_modes_by_frequent_items(spark, kept):
    """A clear mode, a flat column, ties, zeros of both signs, texts, a column of one value and one of none."""
    random = np.random.default_rng(7)
    rows = []
    for i in range(3_000):
        rows.append((
            7.5 if i % 3 == 0 else float(random.integers(1, 900)), float(i), float(i % 4), -0.0 if i % 2 else 0.0, None if i % 5 else float("nan"),
            f"t{i % 50}" if i % 4 else "often", None))
    df = spark.createDataFrame(rows, "clear double, flat double, tie double, zero double, none double, t string, u string").repartition(6)
    found = {r.column: r.number if r.text is None else r.text for r in modes(df, kept).collect()}
    assert found == {"clear": 7.5, "flat": 0.0, "tie": 0.0, "zero": 0.0, "t": "often"}


def test_only_open_columns_are_counted_in_full(spark):
    df = spark.range(4_000).select(F.when(F.col("id") % 2 == 0, 1.0).otherwise(F.col("id").cast("double")).alias("clear"))
    text = modes(df, 16)._jdf.queryExecution().toString()
    assert "array_contains" in text
    assert [(r.column, r.number) for r in modes(df, 16).collect()] == [("clear", 1.0)]


def test_raw_schemas_have_totals():
    assert {t.table for t in incremental.TOTALS} < set(RAW_SCHEMAS) and KINDS.keys() == {t.table for t in incremental.TOTALS}
