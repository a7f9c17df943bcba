"""Racing tables: silver projections, results with circuits and drivers, points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.operators.joins import lookup_join, semi_join
from stratalake.sources.files import stamped


def driver_positions(results: DataFrame, above: int = 10) -> DataFrame:
    """Distinct (driver, position) pairs with a numeric position greater than ``above``.

    Text positions that are not numbers become NULL and drop out.
    """
    position = F.col("position").try_cast("int")
    return (
        results.where(position > above)
        .select(F.col("driverId").alias("driver_id"), position.alias("position_int"))
        .distinct()
    )


# Silver column names (new name: source name).
_RESULT_COLUMNS = {
    "result_id": "resultId",
    "race_id": "raceId",
    "driver_id": "driverId",
    "constructor_id": "constructorId",
    "number": "number",
    "grid": "grid",
    "position": "position",
    "positionText": "positionText",
    "position_order": "positionOrder",
    "points": "points",
    "laps": "laps",
    "time": "time",
    "milliseconds": "milliseconds",
    "fastestLap": "fastestLap",
    "rank": "rank",
    "fastestLapTime": "fastestLapTime",
    "fastestLapSpeed": "fastestLapSpeed",
    "bronze_ingestion": "bronze_ingestion",
}
_CIRCUIT_COLUMNS = {
    "circuit_id": "circuitId",
    "circuit_ref": "circuitRef",
    "circuit_name": "name",
    "location": "location",
    "country": "country",
    "lat": "lat",
    "lng": "lng",
    "alt": "alt",
    "bronze_ingestion": "bronze_ingestion",
}
_CONSTRUCTOR_RESULT_COLUMNS = {
    "constructor_results_id": "constructorResultsId",
    "race_id": "raceId",
    "constructor_id": "constructorId",
    "points": "points",
    "status": "status",
    "bronze_ingestion": "bronze_ingestion",
}
_DRIVER_COLUMNS = {
    "driver_id": "driverId",
    **{c: c for c in ("driverRef", "number", "code", "forename", "surname", "dob", "url", "nationality")},
}
_CONSTRUCTOR_COLUMNS = {
    "constructor_id": "constructorId",
    **{c: c for c in ("constructorRef", "name", "nationality", "url")},
}
_RACE_COLUMNS = (
    "raceId", "year", "round", "circuitId", "name", "date", "time", "url",
    "fp1_date", "fp1_time", "fp2_date", "fp2_time", "fp3_date", "fp3_time",
    "quali_date", "quali_time", "sprint_date", "sprint_time", "bronze_ingestion",
)


def _renamed(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select([F.col(old).alias(new) for new, old in columns.items()])


def silver_results(results: DataFrame, pairs: DataFrame, stamp: Column | None = None) -> DataFrame:
    """Results of the drivers in ``pairs``; a driver listed with several positions counts once."""
    wanted = results.withColumn("__driver", F.col("driverId").try_cast("bigint"))
    kept = semi_join(wanted, pairs, "__driver", "driver_id")
    rows = _renamed(kept, _RESULT_COLUMNS).withColumns(
        {"position_order": F.col("position_order").cast("int"), "rank": F.col("rank").try_cast("int")}
    )
    return stamped(rows, "silver_ingestion", stamp)


def silver_circuits(circuits: DataFrame, above: int = 10) -> DataFrame:
    return _renamed(circuits.where(F.col("circuitId") > above), _CIRCUIT_COLUMNS)


def silver_constructor_results(results: DataFrame, stamp: Column | None = None, above: int = 10) -> DataFrame:
    kept = results.where(F.col("constructorId") > above)
    return stamped(_renamed(kept, _CONSTRUCTOR_RESULT_COLUMNS), "silver_ingestion", stamp)


def silver_drivers(drivers: DataFrame, stamp: Column | None = None) -> DataFrame:
    return stamped(_renamed(drivers, _DRIVER_COLUMNS), "silver_ingestion", stamp)


def silver_constructors(constructors: DataFrame, stamp: Column | None = None) -> DataFrame:
    return stamped(_renamed(constructors, _CONSTRUCTOR_COLUMNS), "silver_ingestion", stamp)


def silver_races(races: DataFrame, stamp: Column | None = None) -> DataFrame:
    return stamped(races.select(*_RACE_COLUMNS), "silver_ingestion", stamp)


def race_results(
    results: DataFrame,
    races: DataFrame,
    circuits: DataFrame,
    drivers: DataFrame,
) -> DataFrame:
    """Result lines with year, circuit and driver name (silver tables in, inner joins).

    Races meet their circuits first, at race grain (circuits are unique by id); result lines then
    make two joins.
    """
    venues = races.select("raceId", "year", "circuitId").join(
        circuits.select("circuit_id", "circuit_name"), F.col("circuitId") == F.col("circuit_id"), "inner"
    )
    venues = venues.select("raceId", "year", "circuit_name")
    names = drivers.select(F.col("driver_id").alias("named_driver"), F.col("driverRef").alias("driver_name"))
    lines = results.select("race_id", "driver_id", "position", "bronze_ingestion")
    joined = lookup_join(lines, venues, "race_id", "raceId", "inner")
    joined = lookup_join(joined, names, "driver_id", "named_driver", "inner")
    return joined.select(
        "race_id", "year", "circuit_name", "driver_id", "driver_name", "position", "bronze_ingestion"
    )


def race_winners(rows: DataFrame, position: str = "1") -> DataFrame:
    return rows.where(F.col("position") == position)


def points_by_driver(results: DataFrame, drivers: DataFrame, constructors: DataFrame) -> DataFrame:
    """Points per driver name over results whose driver and constructor are known, most first.

    Points are summed per (driver, constructor) before either join. Both joins are inner and
    multiply only by repeated lookup rows, which the later sums carry through unchanged.
    """
    pairs = results.groupBy(F.col("driverId").alias("driver"), F.col("constructorId").alias("constructor")).agg(
        F.sum("points").alias("points")
    )
    known = pairs.join(
        constructors.select(F.col("constructorId").alias("known_constructor")),
        F.col("constructor") == F.col("known_constructor"),
        "inner",
    )
    per_driver = known.groupBy("driver").agg(F.sum("points").alias("points"))
    return (
        per_driver.join(drivers.select("driverId", "driverRef"), F.col("driver") == F.col("driverId"), "inner")
        .groupBy("driverRef")
        .agg(F.sum("points").alias("points_driver"))
        .orderBy(F.col("points_driver").desc())
    )


def laps_of_years(laps: DataFrame, races: DataFrame, first: int, last: int) -> DataFrame:
    """Laps of races held in the years ``first`` to ``last``, without repeating a lap."""
    return semi_join(laps, races.where(F.col("year").between(first, last)), "raceId", "raceId")


def laps_with_year(laps: DataFrame, races: DataFrame, first: int, last: int) -> DataFrame:
    """The same laps with the year of their race, for a one-pass export by year."""
    years = races.where(F.col("year").between(first, last)).select(F.col("raceId").alias("race"), "year")
    return lookup_join(laps, years.distinct(), "raceId", "race", "inner").drop("race")
