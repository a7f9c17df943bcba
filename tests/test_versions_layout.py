import glob
import time
from datetime import datetime

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from stratalake.functions import year_month
from stratalake.operators import layout, synth, versions
from stratalake.operators.schema import SchemaMismatch
from stratalake.plans import reports
from stratalake.sources import files, sinks

def stamp():
    return F.lit(datetime(2024, 1, 1))


def users(spark, *names):
    return spark.createDataFrame([(n, i) for i, n in enumerate(names)], "nome string, idade int")


def test_versions_append_overwrite_and_time_travel(spark, folder):
    path = f"{folder}/users"
    assert versions.newest_version(spark, path) is None
    assert versions.write_version(users(spark, "a"), path, stamp=stamp()) == 0
    assert versions.write_version(users(spark, "b", "c"), path, stamp=stamp()) == 1
    assert versions.write_version(users(spark, "z"), path, operation="overwrite", stamp=stamp()) == 2
    assert versions.write_version(users(spark, "y"), path, stamp=stamp()) == 3
    states = [[r[0] for r in rows(versions.as_of(spark, path, n), "nome")] for n in range(4)]
    assert states == [["a"], ["a", "b", "c"], ["z"], ["y", "z"]]
    assert rows(versions.as_of(spark, path)) == rows(versions.as_of(spark, path, 3))
    assert versions.as_of(spark, path).columns == ["nome", "idade"]
    history = [(r.version, r.operation, r.row_count) for r in versions.history(spark, path).orderBy("version").collect()]
    assert history == [(0, "append", 1), (1, "append", 2), (2, "overwrite", 1), (3, "append", 1)]
    with pytest.raises(ValueError):
        versions.write_version(users(spark, "x"), path, operation="merge")


def test_repeated_version_replaces_itself(spark, folder):
    path = f"{folder}/users"
    versions.write_version(users(spark, "a"), path, version=0)
    versions.write_version(users(spark, "a"), path, version=0)
    assert versions.as_of(spark, path).count() == 1


def test_version_without_rows_and_with_other_columns(spark, folder):
    path = f"{folder}/users"
    versions.write_version(users(spark, "a", "b"), path, stamp=stamp())
    assert versions.write_version(users(spark, "a").limit(0), path, operation="overwrite", stamp=stamp()) == 1
    assert versions.as_of(spark, path).count() == 0 and versions.as_of(spark, path, 0).count() == 2
    assert versions.write_version(spark.createDataFrame([("c", True)], "nome string, ativo boolean"), path) == 2
    assert versions.write_version(spark.createDataFrame([("d", 1.5)], "nome string, nota double"), path) == 3
    assert rows(versions.as_of(spark, path), "nome", "idade", "ativo", "nota") == [("c", None, True, None), ("d", None, None, 1.5)]
    assert versions.as_of(spark, path, 0).columns == ["nome", "idade"]
    with pytest.raises(SchemaMismatch):
        versions.write_version(spark.createDataFrame([("e", "x")], "nome string, ativo string"), path)
    assert versions.write_version(spark.createDataFrame([(7,)], "nome int"), path, operation="overwrite") == 4
    assert rows(versions.as_of(spark, path)) == [(7,)]
    history = [(r.version, r.operation, r.row_count) for r in versions.history(spark, path).orderBy("version").collect()]
    assert history == [(0, "append", 2), (1, "overwrite", 0), (2, "append", 1), (3, "append", 1), (4, "overwrite", 1)]
    with pytest.raises(ValueError, match="another operation"):
        versions.write_version(users(spark, "a"), path, version=4)


def test_unreadable_log_is_no_new_table(spark, folder):
    path = f"{folder}/users"
    versions.write_version(users(spark, "a"), path)
    spark.read.text(f"{path}/_operation=append/_version=0")  # the data is there
    for log in glob.glob(f"{path}/_log/*.parquet"):
        with open(log, "wb") as file:
            file.write(b"broken")
    with pytest.raises(Exception):
        versions.write_version(users(spark, "b"), path)


def test_old_version_reads_only_its_folders(spark, folder):
    df = users(spark, *"abcdefghij").withColumn("insercao_id", F.col("idade"))
    path = versions.write_batches(df, f"{folder}/t", "insercao_id")
    early = versions.as_of(spark, path, 2)
    assert "PartitionFilters: [isnotnull(_version" in plan_of(early)
    assert files.file_stats(spark.read.parquet(path).where("_version <= 2")).count() == 3
    assert rows(reports.batch_summary(versions.as_of(spark, path), "insercao_id")) == [(10, 9)]
    assert early.count() == 3


def test_month_folders_are_pruned(spark, folder):
    sales = synth.generate_sales(spark, 2000)
    whole = sinks.overwrite_table(sales, f"{folder}/whole")
    parts = sinks.write_partitioned(spark.read.parquet(whole), f"{folder}/parts", ["ano_mes"])
    found = reports.month_filter(spark.read.parquet(parts), "2023-03")
    assert "PartitionFilters: [isnotnull(ano_mes" in plan_of(found)
    assert files.file_stats(found).count() == 1
    assert found.count() == reports.month_filter(spark.read.parquet(whole), "2023-03").count() > 0


def test_hot_folder_is_written_by_several_tasks(spark, folder):
    """A folder far above the advisory size is split; small ones stay one file each."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        skewed = spark.range(60000).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("d"), F.col("id") % 5)).alias("m"),
            F.md5(F.col("id").cast("string")).alias("v"),
        )
        path = sinks.write_partitioned(skewed.repartition(8), f"{folder}/s", ["m"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(f"{path}/m=hot/*.parquet")) > 1
    assert spark.read.parquet(path).count() == 60000


def test_compaction(spark, folder):
    many, few = f"{folder}/many", f"{folder}/few"
    spark.range(4000).repartition(40).write.parquet(many)
    size = files.file_inventory(spark, many).agg(F.sum("length")).first()[0]
    assert "Exchange" not in plan_of(layout.packed(spark, many, size // 2))
    layout.compact(spark, many, few, target_bytes=size // 2)
    assert len(glob.glob(f"{many}/*.parquet")) == 40 and len(glob.glob(f"{few}/*.parquet")) <= 3
    assert rows(spark.read.parquet(few).agg(F.count("*"), F.sum("id"))) == [(4000, 7998000)]
    folders = f"{folder}/by"
    spark.range(400).withColumn("p", F.col("id") % 4).repartition(10).write.partitionBy("p").parquet(folders)
    layout.compact(spark, folders, f"{folder}/by2", partition_by=["p"])
    assert len(glob.glob(f"{folder}/by2/*/*.parquet")) == 4
    root = f"{folder}/published"
    first = sinks.publish_path(spark.range(100).repartition(10), root)
    second = layout.compact_published(spark, root)
    assert sinks.current_path(spark, root) == second and len(glob.glob(f"{second}/*.parquet")) == 1
    assert spark.read.parquet(first).count() == spark.read.parquet(second).count() == 100


def test_compaction_keeps_the_order_within_files(spark, folder):
    spark.range(4000).repartitionByRange(8, "id").sortWithinPartitions("id").write.parquet(f"{folder}/sorted")
    layout.compact(spark, f"{folder}/sorted", f"{folder}/one", target_bytes=1 << 30)
    ids = [r.id for r in spark.read.parquet(f"{folder}/one").collect()]
    assert sum(b < a for a, b in zip(ids, ids[1:])) <= 7 and sorted(ids) == list(range(4000))


def spans(spark, path, column):
    """Least and greatest value of each file."""
    return (
        spark.read.parquet(path)
        .groupBy(F.col("_metadata.file_path"))
        .agg(F.min(column).alias("lo"), F.max(column).alias("hi"), F.count("*").alias("n"))
        .collect()
    )


def test_clustering_one_column_with_a_hot_value(spark, folder):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 50).otherwise(F.col("id") % 100).alias("c"), "id").repartition(8)
    path = f"{folder}/c"
    layout.cluster(df, "c", 9).write.parquet(path)
    got = spans(spark, path, "c")
    assert sum(1 for r in got if r.lo <= 10 <= r.hi) <= 2
    assert sum(r.n for r in got) == 9000 and max(r.n for r in got) < 2500  # the hot value fills several files
    assert sum(1 for r in got if r.lo <= 50 <= r.hi) >= 3


def test_clustering_several_columns(spark, folder):
    df = spark.range(8000).select(
        (F.col("id") % 100).alias("a"),
        F.concat(F.lit("k"), F.lpad((F.col("id") * 37 % 101).cast("string"), 3, "0")).alias("b"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") * 11 % 300).cast("int")).alias("d"),
    )
    path = f"{folder}/z"
    layout.cluster(df.repartition(8), ["a", "b"], 16).write.parquet(path)
    for column, value in (("a", 13), ("b", "k050")):
        touched = sum(1 for r in spans(spark, path, column) if r.lo <= value <= r.hi)
        assert touched <= 9, column
    assert rows(spark.read.parquet(path).groupBy().agg(F.sum("a"), F.countDistinct("b"))) == [(396000, 101)]
    assert layout.cluster(df, ["d", "a"], 4).count() == 8000
    assert layout.bits_for(400_000, 2) == 11 and layout.bits_for(1, 3) == 1


def test_clustering_by_long_text_and_large_ids(spark, folder):
    """Text that begins alike and ids beyond the whole numbers of a double, with missing values."""
    df = spark.range(4000).select(
        F.concat(F.lit("https://example.org/some/long/path/"), F.lpad(((F.col("id") * 37) % 4000).cast("string"), 6, "0")).alias("url"),
        F.when(F.col("id") % 10 != 0, F.col("id") + F.lit(2**60)).alias("big"),
    )
    df.repartition(16).write.parquet(f"{folder}/before")
    layout.cluster(df, ["url", "big"], 16).write.parquet(f"{folder}/after")
    layouts = {name: f"{folder}/{name}" for name in ("before", "after")}
    for condition in (F.col("url") < "https://example.org/some/long/path/000100", F.col("big") < F.lit(2**60 + 100)):
        found = {r.layout: r for r in layout.layout_report(spark, layouts, condition).collect()}
        assert found["before"].files_hit == found["before"].files == 16
        assert found["after"].files_hit <= 8 and found["after"].rows_hit == found["before"].rows_hit >= 90
        assert found["after"].bytes > 0
    borders = layout.range_borders(df, ["url", "big"], 6).first()
    assert len(borders.b1) == 63 and list(borders.b1) == sorted(set(borders.b1)) and list(borders.b0) == sorted(borders.b0)


def test_z_order_plans_do_not_grow_with_the_files(spark):
    df = spark.range(5000).select("id", (F.col("id") % 70).alias("a"), F.col("id").cast("string").alias("t"))
    sizes = {}
    for files in (64, 4096, 500_000):
        started = time.perf_counter()
        sizes[files] = len(plan_of(layout.cluster(df, ["a", "t"], files)))
        assert time.perf_counter() - started < 20
    assert max(sizes.values()) < 1.4 * min(sizes.values())  # a small table is not sampled


def test_z_values_interleave_the_ranges(spark):
    df = spark.range(64).select((F.col("id") % 8).alias("a"), F.floor(F.col("id") / 8).alias("b"), F.when(F.col("id") > 9, F.col("id")).alias("n"))
    for r in layout.with_z_value(df, ["a", "b"], 3, "z").collect():
        assert r.z == sum(((r.a >> i & 1) << 2 * i) | ((r.b >> i & 1) << (2 * i + 1)) for i in range(3))
    assert {r.z for r in layout.with_z_value(df, ["n"], 4, "z").where("n IS NULL").collect()} == {0}
    assert layout.with_z_value(df.limit(0), ["a"], 4, "z").count() == 0
    assert {r.z for r in layout.with_z_value(df.select(F.lit(None).cast("int").alias("x")), ["x"], 4, "z").collect()} == {0}


def test_value_filter_reaches_the_scan(spark, folder):
    path = f"{folder}/f"
    layout.cluster(synth.generate_sales(spark, 500), "categoria", 4).write.parquet(path)
    plan = plan_of(reports.category_filter(spark.read.parquet(path), "Livros", "categoria").select("valor"))
    assert "EqualTo(categoria,Livros)" in plan and "ReadSchema: struct<categoria:string,valor:double>" in plan


def test_generated_shares(spark):
    base = spark.range(20000)
    for sales in (synth.generate_sales(spark, 20000), synth.synthetic_sales(base, synth.hashed_draws(F.col("id")))):
        share = {r.categoria: r.total_vendas / 20000 for r in reports.category_totals(sales, "categoria", "valor").collect()}
        for name, want in zip(synth.CATEGORIES, (0.20, 0.32, 0.288, 0.1536, 0.0384)):
            assert abs(share[name] - want) < 0.015
        low, high, months = sales.agg(F.min("valor"), F.max("valor"), F.countDistinct("ano_mes")).first()
        assert 0 <= low and high < 1000 and months == 24
    again = synth.synthetic_sales(base.repartition(7), synth.hashed_draws(F.col("id")))
    assert rows(again.agg(F.sum(F.col("valor").cast("decimal(20,10)")))) == rows(sales.agg(F.sum(F.col("valor").cast("decimal(20,10)"))))
    assert rows(sales.select((year_month(F.col("data_venda")) == F.col("ano_mes")).alias("ok")).distinct()) == [(True,)]


def test_filters_skip_row_groups(spark, folder):
    """Ids spread over all files: a lookup reads few row groups where they have filters, all of them elsewhere."""
    df = spark.range(200_000).select(F.xxhash64("id").alias("key"), F.col("id").alias("v")).repartition(4, "v")
    sinks.write_with_filters(df, f"{folder}/with", {"key": 10_000}, group_bytes=64 * 1024)
    df.write.option("parquet.block.size", 64 * 1024).parquet(f"{folder}/without")
    wanted = [r.key for r in df.where("v IN (5, 77777)").collect()]
    read = {name: layout.scanned(spark.read.parquet(f"{folder}/{name}").where(F.col("key").isin(wanted))) for name in ("with", "without")}
    assert read["with"]["rows"] < 0.1 * 200_000 < 0.5 * 200_000 < read["without"]["rows"]
    assert rows(spark.read.parquet(f"{folder}/with").where(F.col("key").isin(wanted)), "v") == [(5,), (77777,)]
    absent = spark.read.parquet(f"{folder}/with").where("key = 12345")
    assert layout.scanned(absent)["rows"] < 0.05 * 200_000 and absent.count() == 0


def test_versions_below_zero_are_kept(spark, folder):
    batches = spark.createDataFrame([(1, -2), (2, -1), (3, 0)], "a int, n int")
    path = versions.write_batches(batches, f"{folder}/v", "n", stamp())
    assert rows(versions.as_of(spark, path), "a") == [(1,), (2,), (3,)]
    assert rows(versions.as_of(spark, path, -1), "a") == [(1,), (2,)]


@pytest.mark.parametrize("columns", ["id", ["id", "b"]])
def test_clustering_bounds_what_a_task_sorts(spark, folder, columns):
    """More files than asked for where a file would have its task sort too much; rows stay, ranges stay narrow."""
    df = spark.range(4000).select("id", (F.col("id") * 37 % 101).alias("b"), F.repeat(F.lit("x"), 1000).alias("text"), F.array("id").alias("held"))
    assert 4_000_000 < layout.row_bytes(df) < 5_000_000
    layout.cluster(df.repartition(4), columns, 2, sorted_bytes=512 * 1024).write.parquet(f"{folder}/c")
    got = spans(spark, f"{folder}/c", "id")
    assert len(got) >= 8 and max(r.n for r in got) <= 1200
    assert sum(1 for r in got if r.lo <= 1234 <= r.hi) <= (2 if columns == "id" else 6)
    assert spark.read.parquet(f"{folder}/c").exceptAll(df).isEmpty() and sum(r.n for r in got) == 4000
    layout.cluster(df, columns, 2).write.parquet(f"{folder}/few")
    assert len(spans(spark, f"{folder}/few", "id")) == 2
    assert layout.row_bytes(df.limit(0)) == 0
