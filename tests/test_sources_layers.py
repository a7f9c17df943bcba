import os
import time
from datetime import datetime

import pytest
from conftest import SF, plan_of, rows
from pyspark.sql import functions as F

from stratalake import session
from stratalake.operators.schema import SchemaMismatch
from stratalake.plans import layers, racing, reports
from stratalake.plans.specs import SILVER
from stratalake.registry.landing import sales_landing, source
from stratalake.sources import catalog, files, sinks

CIRCUITS = 'circuitId,name,alt\n1,"Albert, Park",10\n2,Sepang,\\N\n'


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as out:
        out.write(text)


def test_csv_variants(spark, folder):
    put(f"{folder}/a/circuits.csv", CIRCUITS)
    put(f"{folder}/b/circuits.csv", CIRCUITS)
    raw = files.read_csv_raw(spark, f"{folder}/*/*.csv")
    assert raw.columns == ["_c0", "_c1", "_c2"] and raw.count() == 6
    path = f"{folder}/a/circuits.csv"
    assert [t for _, t in files.read_csv(spark, path).dtypes] == ["string"] * 3
    assert files.read_csv(spark, path, infer=True).dtypes == [("circuitId", "int"), ("name", "string"), ("alt", "string")]
    marked = files.read_csv(spark, path, infer=True, null_marker=files.NULL_MARKER)
    assert marked.dtypes[2] == ("alt", "int") and rows(marked, "name", "alt") == [("Albert, Park", 10), ("Sepang", None)]
    declared = files.read_csv(spark, path, schema="circuitId bigint, name string, alt string")
    assert declared.dtypes[0] == ("circuitId", "bigint")


def test_manifest_and_ingest(spark, folder):
    put(f"{folder}/in/circuits.csv", CIRCUITS)
    spark.range(5).repartition(2).write.option("header", True).csv(f"{folder}/in/seasons.csv")
    put(f"{folder}/in/notes.txt", "x")
    manifest = files.landing_manifest(spark, f"{folder}/in")
    assert sorted(manifest) == ["circuits", "seasons"]
    stamp = F.lit(datetime(2024, 1, 1))
    written = layers.ingest_csv(spark, manifest, f"{folder}/bronze", stamp=stamp)
    assert spark.read.parquet(written["circuits"]).columns == ["circuitId", "name", "alt", "bronze_ingestion"]
    counts = layers.verify_tables(spark, f"{folder}/bronze", ["circuits", "seasons", "missing"])
    assert rows(counts) == [("circuits", 2), ("missing", None), ("seasons", 5)]


def test_ingest_fails_loudly(spark, folder):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        layers.ingest_parquet(spark, {"x": f"{folder}/nothing"}, f"{folder}/bronze")


def test_path_scan_inventory_and_stats(spark, folder):
    spark.range(100).repartition(4).write.parquet(f"{folder}/t")
    assert files.read_path_sql(spark, f"{folder}/t").count() == 100
    inventory = files.file_inventory(spark, f"{folder}/t")
    assert inventory.count() == 4 and "content" not in plan_of(inventory)
    stats = files.file_stats(spark.read.parquet(f"{folder}/t"))
    assert rows(stats.agg(F.count("*"), F.sum("rows"))) == [(4, 100)]


def test_parameters_are_bound_not_spliced(spark):
    df = spark.createDataFrame([("x' OR 'a' = 'a",), ("y",)], "v string")
    got = reports.parameter_sql(spark, "SELECT v FROM {t} WHERE v = :v", {"v": "x' OR 'a' = 'a"}, t=df)
    assert rows(got) == [("x' OR 'a' = 'a",)]


def test_view_is_expanded_when_read(spark, folder):
    sinks.publish_overwrite(spark.range(3), "view_base", folder)
    view = reports.register_view(spark, "some_view", "SELECT id * 2 AS twice FROM view_base")
    assert rows(view) == [(0,), (2,), (4,)]
    sinks.publish_overwrite(spark.range(1), "view_base", folder)
    assert rows(spark.table("some_view")) == [(0,)]
    spark.sql("DROP VIEW some_view")
    spark.sql("DROP TABLE view_base")


def test_plans_prune_and_push(spark):
    orders = source(spark, SF, "orders")
    plan = plan_of(orders.where("o_totalprice > 1000").select("o_orderkey"))
    assert "GreaterThan(o_totalprice,1000.0)" in plan and "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan
    assert "TakeOrderedAndProject" in plan_of(reports.preview(orders, ["o_orderkey"]))


def test_run_layers_with_declared_types(spark, folder):
    """Default 32-bit ids, wide table included, second run over the same folders."""
    landing = sales_landing(spark, SF)
    for name in SILVER:
        landing[name].write.parquet(f"{folder}/landing/{name}.parquet")
    stamp = F.lit(datetime(2024, 1, 1))
    gold = layers.run_layers(spark, f"{folder}/landing", f"{folder}/lake", stamp, reproducible_ids=True)
    assert set(gold) == {
        "DimCurrency", "DimCustomer", "DimDate", "DimGeography", "DimProduct", "DimPromotion", "DimSalesReason",
        "DimSalesTerritory", "FactInternetSales", "ft_agg_product_day",
    }
    first = {n: rows(spark.read.parquet(p)) for n, p in gold.items()}
    assert all(first.values())
    assert spark.read.parquet(gold["FactInternetSales"]).schema["SalesOrderDetailID"].dataType.simpleString() == "int"
    again = layers.run_layers(spark, f"{folder}/landing", f"{folder}/lake", stamp, reproducible_ids=True)
    assert first == {n: rows(spark.read.parquet(p)) for n, p in again.items()}
    wide = layers.build_gold(spark, f"{folder}/lake/silver", f"{folder}/gold2", wide_table=True)
    assert spark.read.parquet(wide["OneBigTable"]).count() > 0


def test_failing_run_leaves_the_last_tables(spark, folder):
    spark.createDataFrame([(1, "a")], "id int, v string").write.parquet(f"{folder}/one")
    spark.createDataFrame([(1, "b")], "id int, v string").write.parquet(f"{folder}/two")
    layers.ingest_parquet(spark, {"t": f"{folder}/one"}, f"{folder}/bronze", stamp_column=None)
    broken = lambda s, path: s.read.parquet(path).withColumn("v", F.raise_error(F.lit("broken")))
    with pytest.raises(Exception, match="broken"):
        layers.ingest(spark, {"t": f"{folder}/two"}, f"{folder}/bronze", broken, stamp_column=None)
    assert rows(spark.read.parquet(sinks.current_path(spark, f"{folder}/bronze/t"))) == [(1, "a")]
    layers.ingest_parquet(spark, {"t": f"{folder}/two"}, f"{folder}/bronze", stamp_column=None)
    assert rows(spark.read.parquet(sinks.current_path(spark, f"{folder}/bronze/t"))) == [(1, "b")]
    assert len(sinks.superseded_paths(spark, f"{folder}/bronze/t")) == 1


def test_scale_settings():
    small, large = session.scale_conf(600_000, 8), session.scale_conf(100 * 10**12, 4000)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert int(large["spark.sql.shuffle.partitions"]) > 400_000


def test_scratch_follows_the_cluster_setting(spark, folder):
    base = spark.conf.get("spark.checkpoint.dir")
    a, b = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert a.startswith(base) and a != b


def test_catalog_tables(spark):
    catalog.create_database(spark, "demo")
    catalog.create_database(spark, "demo")
    catalog.create_table(spark.range(3), "demo.t")
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        catalog.create_table(spark.range(3), "demo.t")
    catalog.replace_table(spark.createDataFrame([("a", 1)], "nome string, idade int"), "demo.t")
    catalog.append_table(spark.createDataFrame([(2, "b")], "idade int, nome string"), "demo.t")
    with pytest.raises(SchemaMismatch):
        catalog.append_table(spark.createDataFrame([("x", "y")], "idade string, nome string"), "demo.t")
    assert rows(spark.table("demo.t")) == [("a", 1), ("b", 2)]
    with pytest.raises(Exception, match="SCHEMA_NOT_EMPTY|not empty"):
        catalog.drop_database(spark, "demo")
    catalog.drop_table(spark, "demo.t")
    catalog.drop_database(spark, "demo", cascade=True)
    assert not spark.catalog.databaseExists("demo")


def test_csv_and_layers_are_written_compressed(spark, folder):
    df = spark.createDataFrame([(1, "a,\"b\"", 1.5), (2, None, None)], "a int, t string, d double")
    sinks.write_csv(df, f"{folder}/in/t.csv", files.NULL_MARKER)
    assert all(n.endswith(".csv.gz") for n in os.listdir(f"{folder}/in/t.csv") if n.startswith("part"))
    manifest = files.landing_manifest(spark, f"{folder}/in")
    assert rows(files.read_csv(spark, manifest["t"], infer=True, null_marker=files.NULL_MARKER)) == rows(df)
    ids = spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("rowguid"))
    ids.coalesce(1).write.option("compression", "snappy").parquet(f"{folder}/snappy")
    path = sinks.publish_path(ids.coalesce(1), f"{folder}/table")
    size = {p: files.file_inventory(spark, p).agg(F.sum("length")).first()[0] for p in (path, f"{folder}/snappy")}
    assert size[path] < 0.7 * size[f"{folder}/snappy"]
    assert rows(spark.read.parquet(path)) == rows(ids)


def test_racing_sends_a_lookup_by_the_bytes_of_its_rows(spark, folder, monkeypatch):
    """Drivers whose texts compress to almost nothing: their files are under the limit of a broadcast, their rows are not."""
    lines = spark.range(20_000)
    made = {
        "results": lines.select(F.col("id").alias("resultId"), (F.col("id") % 50 + 11).alias("raceId"), (F.col("id") % 5000).alias("driverId"), (F.col("id") % 7 + 11).alias("constructorId"), F.lit(12).alias("position"), F.lit(1.5).alias("points")),
        "races": spark.range(11, 61).select(F.col("id").alias("raceId"), F.lit(2020).alias("year"), F.lit(12).alias("circuitId")),
        "circuits": spark.range(12, 13).select(F.col("id").alias("circuitId"), F.lit("Sepang").alias("name")),
        "drivers": spark.range(5000).select(F.col("id").alias("driverId"), F.rpad(F.lit("d"), 400, "d").alias("driverRef")),
        "constructors": spark.range(11, 18).select(F.col("id").alias("constructorId")),
        "constructor_results": spark.range(11, 18).select(F.col("id").alias("constructorId"), F.col("id").alias("raceId")),
    }
    columns = {"results": racing._RESULT_COLUMNS.values(), "races": racing._RACE_COLUMNS, "circuits": racing._CIRCUIT_COLUMNS.values(), "drivers": racing._DRIVER_COLUMNS.values(), "constructors": racing._CONSTRUCTOR_COLUMNS.values(), "constructor_results": racing._CONSTRUCTOR_RESULT_COLUMNS.values()}
    for name, df in made.items():
        whole = df.withColumns({c: F.lit(1) for c in columns[name] if c not in df.columns and c != "bronze_ingestion"})
        sinks.write_csv(whole, f"{folder}/in/{name}.csv", files.NULL_MARKER)
    plans = {}
    publish = sinks.publish_path

    def spied(df, root, *more):
        if root.endswith("gold/race_results"):
            df.collect()
            plans[root] = plan_of(df)
        return publish(df, root, *more)

    monkeypatch.setattr(layers, "publish_path", spied)
    limit = "spark.sql.autoBroadcastJoinThreshold"
    with session.settings(spark, {limit: "300k"}):
        gold = layers.run_racing(spark, files.landing_manifest(spark, f"{folder}/in"), f"{folder}/lake", F.lit(datetime(2024, 1, 1)))
        assert spark.conf.get(limit) == "300k"
    drivers = [line for line in next(iter(plans.values())).split("== Initial Plan ==")[0].splitlines() if "named_driver" in line and "Join" in line]
    assert drivers and not any("Broadcast" in line for line in drivers)
    assert spark.read.parquet(gold["race_results"]).count() == 20_000
    assert spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None) is None


def files_below(folder, part):
    return [f for d, _, names in os.walk(folder) for f in names if part in f]


def test_publishing_without_the_former_folder(spark, folder):
    kept = [sinks.publish_path(spark.range(n), f"{folder}/kept") for n in (3, 4)]
    assert all(os.path.isdir(p) for p in kept)
    last = [sinks.publish_path(spark.range(n), f"{folder}/t", keep_former=False) for n in (3, 4, 5)][-1]
    again = sinks.publish_path(spark.read.parquet(last).where("id > 0"), f"{folder}/t", keep_former=False)
    assert sinks.current_path(spark, f"{folder}/t") == again and spark.read.parquet(again).count() == 4
    assert [n for n in os.listdir(f"{folder}/t") if n != sinks.CURRENT] == [os.path.basename(again)]
    with pytest.raises(Exception, match="broken"):
        sinks.publish_path(spark.range(1).select(F.raise_error(F.lit("broken"))), f"{folder}/t", keep_former=False)
    assert spark.read.parquet(sinks.current_path(spark, f"{folder}/t")).count() == 4


def test_shuffle_files_go_with_the_write(spark, folder):
    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0]
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = len(files_below(local, "shuffle_")), spark.conf.get(cleanup, None)
    with session.settings(spark, session.run_settings(spark)):
        sinks.publish_path(spark.range(10_000).groupBy((F.col("id") % 999).alias("k")).count(), f"{folder}/t")
    assert len(files_below(local, "shuffle_")) <= before and spark.conf.get(cleanup, None) == setting
    assert spark.read.parquet(sinks.current_path(spark, f"{folder}/t")).agg(F.sum("count")).first()[0] == 10_000


def test_layers_are_written_with_differences(spark, folder):
    ids = spark.range(0, 2_000_000, 7, 1).select(F.col("id").cast("decimal(19,4)").alias("amount"), F.concat(F.lit("SO"), "id").alias("name"), "id")
    ids.write.option("compression", sinks.COMPRESSION).parquet(f"{folder}/first")
    path = sinks.publish_path(ids, f"{folder}/t")
    size = {p: files.file_inventory(spark, p).agg(F.sum("length")).first()[0] for p in (path, f"{folder}/first")}
    assert size[path] < 0.85 * size[f"{folder}/first"]
    assert spark.read.parquet(path).exceptAll(ids).isEmpty() and spark.read.parquet(path).count() == ids.count()


def test_large_tables_run_alone(spark, folder):
    for name, n in (("a", 10), ("b", 200_000), ("c", 300_000), ("d", 20)):
        spark.range(n).select(F.rand().alias("x")).write.parquet(f"{folder}/{name}")
    running, most = set(), {}

    def job(name):
        running.add(name)
        time.sleep(0.3)
        most[name] = max(most.get(name, 0), len(running))
        running.discard(name)
        return name, None

    done = layers.each_large_alone(job, spark, {n: f"{folder}/{n}" for n in "abcd"}, 4)
    assert sorted(n for n, _ in done) == list("abcd") and most["b"] == most["c"] == 1
