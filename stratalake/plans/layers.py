"""Bronze, silver and gold runs over a folder of landing tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.joins import sized
from stratalake.plans import racing, star
from stratalake.plans.silver import clean, clean_sifted
from stratalake.plans.specs import SILVER
from stratalake.session import measured_broadcasts, run_settings, scratch_path, settings
from stratalake.sources.files import NULL_MARKER, file_inventory, read_csv, stamped, table_counts
from stratalake.sources.sinks import current_path, publish_path, table_path

PARALLEL_TABLES = 8

# silver tables whose key is also the key their gold readers look them up by
GOLD_UNIQUE = frozenset(name for name, spec in SILVER.items() if len(spec.keys) == 1)


def ingest(
    spark: SparkSession,
    files: Mapping[str, str],
    target: str,
    read: Callable[[SparkSession, str], DataFrame],
    stamp: Column | None = None,
    stamp_column: str | None = "bronze_ingestion",
    parallel: int = PARALLEL_TABLES,
    keep_former: bool = True,
) -> dict[str, str]:
    """One target table per landing file; the first failure stops the run with its error.

    Every table is written to a fresh folder and then switched to, so a run that fails leaves the tables
    of the last run readable. Returns the folders. Without ``keep_former`` a table's former folder goes after the switch.
    """
    def load(item: tuple[str, str]) -> tuple[str, str]:
        name, path = item
        df = read(spark, path)
        if stamp_column:
            df = stamped(df, stamp_column, stamp)
        return name, publish_path(df, f"{target}/{name}", keep_former)

    return dict(each(load, files.items(), parallel))


def ingest_csv(spark: SparkSession, files: Mapping[str, str], target: str, **options) -> dict[str, str]:
    """Bronze tables from CSV files with a header, types inferred."""
    return ingest(spark, files, target, lambda s, p: read_csv(s, p, infer=True), **options)


def ingest_parquet(spark: SparkSession, files: Mapping[str, str], target: str, **options) -> dict[str, str]:
    """Bronze tables from Parquet files, as they are."""
    return ingest(spark, files, target, lambda s, p: s.read.parquet(p), **options)


def each(job: Callable, items: Iterable, parallel: int) -> list:
    """Run independent table jobs side by side so small tables do not leave executors idle."""
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return list(pool.map(job, items))


def each_large_alone(job: Callable, spark: SparkSession, paths: Mapping[str, str], parallel: int) -> list:
    """``job`` for each of the names of ``paths``, tables with more than a tenth of all bytes one at a time.

    Such a table occupies the executors by itself, and the shuffle files of two need not lie on their disks at once."""
    sizes = dict(each(lambda name: (name, file_inventory(spark, paths[name]).agg(F.sum("length")).first()[0] or 0), paths, parallel))
    large = [name for name in paths if sizes[name] * 10 > sum(sizes.values())]
    return each(job, [name for name in paths if name not in large], parallel) + each(job, large, 1)


def build_silver(
    spark: SparkSession,
    bronze: str,
    silver: str,
    stamp: Column | None = None,
    wide: bool = False,
    reproducible_ids: bool = False,
    parallel: int = PARALLEL_TABLES,
    keep_former: bool = True,
) -> dict[str, str]:
    """All declared silver tables from their bronze tables."""
    paths = {name: current_path(spark, f"{bronze}/{name}") for name in SILVER}

    def one(name: str) -> tuple[str, str]:
        landed = spark.read.parquet(paths[name])
        rows = clean(landed, SILVER[name], stamp, reproducible_ids, wide)
        return name, publish_path(rows, f"{silver}/{name}", keep_former)

    return dict(each_large_alone(one, spark, paths, parallel))


def build_silver_sifted(
    spark: SparkSession,
    bronze: str,
    silver: str,
    refused: str,
    stamp: Column | None = None,
    wide: bool = False,
    reproducible_ids: bool = False,
    parallel: int = PARALLEL_TABLES,
) -> dict[str, dict[str, int]]:
    """As ``build_silver``, with the rows that break a rule published below ``refused``; returns the counts of each table."""
    def one(name: str) -> tuple[str, dict[str, int]]:
        landed = spark.read.parquet(current_path(spark, f"{bronze}/{name}"))
        rows, bad, counts = clean_sifted(landed, SILVER[name], scratch_path(spark, "sifted"), stamp, reproducible_ids, wide)
        publish_path(bad, f"{refused}/{name}")
        publish_path(rows, f"{silver}/{name}")
        return name, counts

    return dict(each(one, list(SILVER), parallel))


def gold_plans(
    tables: Mapping[str, DataFrame], wide: bool = False, unique: frozenset[str] = GOLD_UNIQUE
) -> dict[str, Callable[[], DataFrame]]:
    """Dimensions and fact by name, each built from stored silver tables."""
    plans: dict[str, Callable[[], DataFrame]] = {
        name: lambda name=name: star.renamed_dimension(tables, name, unique, wide)
        for name in ("DimCurrency", "DimPromotion", "DimSalesReason", "DimSalesTerritory")
    }
    plans["DimCustomer"] = lambda: star.dim_customer(tables, unique, wide)
    plans["DimDate"] = lambda: star.dim_date(tables)
    plans["DimGeography"] = lambda: star.dim_geography(tables, unique, wide)
    plans["DimProduct"] = lambda: star.dim_product(tables, unique, wide)
    plans["FactInternetSales"] = lambda: star.fact_internet_sales(tables, unique, wide, stored=True)
    return plans


def build_gold(
    spark: SparkSession,
    silver: str,
    gold: str,
    wide: bool = False,
    wide_table: bool = False,
    parallel: int = PARALLEL_TABLES,
    keep_former: bool = True,
) -> dict[str, str]:
    """Dimensions and fact from silver, then the daily aggregate from the written gold tables."""
    tables = {name: sized(spark.read.parquet(current_path(spark, f"{silver}/{name}"))) for name in SILVER}
    plans = gold_plans(tables, wide)
    if wide_table:
        plans["OneBigTable"] = lambda: star.one_big_table(tables, GOLD_UNIQUE, wide)

    def one(name: str) -> tuple[str, str]:
        return name, publish_path(plans[name](), f"{gold}/{name}", keep_former)

    written = dict(each(one, list(plans), parallel))
    daily = star.agg_product_day(
        spark.read.parquet(written["FactInternetSales"]), sized(spark.read.parquet(written["DimProduct"])), wide
    )
    written["ft_agg_product_day"] = publish_path(daily, f"{gold}/ft_agg_product_day", keep_former)
    return written


def run_layers(
    spark: SparkSession,
    src: str | Mapping[str, str],
    dst: str,
    stamp: Column | None = None,
    wide: bool = False,
    reproducible_ids: bool = False,
    keep_former: bool = True,
) -> dict[str, str]:
    """Bronze, silver and gold in order; returns the gold locations.

    ``src`` is a folder with ``<table>.parquet`` entries or a mapping of table to path. Without ``keep_former`` the folder
    of a table's last run goes once the table is switched, for callers who know that nobody reads it any more.
    """
    files = src if isinstance(src, Mapping) else {name: f"{src}/{name}.parquet" for name in SILVER}
    with settings(spark, run_settings(spark)):
        ingest_parquet(spark, files, f"{dst}/bronze", stamp_column=None, keep_former=keep_former)
        build_silver(spark, f"{dst}/bronze", f"{dst}/silver", stamp, wide, reproducible_ids, keep_former=keep_former)
        return build_gold(spark, f"{dst}/silver", f"{dst}/gold", wide, keep_former=keep_former)


RACING_TABLES = ("results", "races", "circuits", "drivers", "constructors", "constructor_results")


def run_racing(spark: SparkSession, files: Mapping[str, str], dst: str, stamp: Column | None = None) -> dict[str, str]:
    """Racing tables from CSV files, whose missing values read ``\\N``, to silver and gold; returns the gold folders."""
    bronze = ingest(
        spark, {name: files[name] for name in RACING_TABLES}, f"{dst}/bronze",
        lambda s, path: read_csv(s, path, infer=True, null_marker=NULL_MARKER), stamp=stamp,
    )
    raw = {name: spark.read.parquet(path) for name, path in bronze.items()}
    plans = {
        "results": lambda: racing.silver_results(raw["results"], racing.driver_positions(raw["results"]), stamp),
        "races": lambda: racing.silver_races(raw["races"], stamp),
        "circuits": lambda: racing.silver_circuits(raw["circuits"]),
        "drivers": lambda: racing.silver_drivers(raw["drivers"], stamp),
        "constructors": lambda: racing.silver_constructors(raw["constructors"], stamp),
        "constructor_results": lambda: racing.silver_constructor_results(raw["constructor_results"], stamp),
    }
    with settings(spark, measured_broadcasts(spark)):
        paths = dict(each(lambda name: (name, publish_path(plans[name](), f"{dst}/silver/{name}")), list(plans), PARALLEL_TABLES))
        silver = {name: spark.read.parquet(path) for name, path in paths.items()}
        gold = {
            "race_results": racing.race_results(silver["results"], silver["races"], silver["circuits"], silver["drivers"]),
            "points_by_driver": racing.points_by_driver(raw["results"], raw["drivers"], raw["constructors"]),
        }
        return {name: publish_path(rows, f"{dst}/gold/{name}") for name, rows in gold.items()}


def verify_tables(spark: SparkSession, root: str, names: Iterable[str]) -> DataFrame:
    """Row count of every listed table; a table that does not exist is reported, not skipped."""
    found: dict[str, DataFrame | None] = {}
    for name in names:
        try:
            found[name] = spark.read.parquet(table_path(spark, f"{root}/{name}"))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            found[name] = None
    return table_counts(found)
