"""One entry per operator: callables ``(spark, sf_dir) -> DataFrame`` over the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake import functions as fn
from stratalake.operators import change, joins, layout, schema, synth, touched, versions
from stratalake.operators.dedup import latest_per_key
from stratalake.operators.quality import BROKEN, keep_valid
from stratalake.plans import incremental, layers, racing, reports, star
from stratalake.plans.silver import clean, clean_sifted, with_optional_rules
from stratalake.plans.specs import SILVER
from stratalake.registry.landing import STAMP, racing_landing, sales_landing, sales_staged, source
from stratalake.session import scratch_path
from stratalake.sources import buckets, catalog, files, sinks
from stratalake.streaming import files as arrivals
from stratalake.streaming import late, schema_log

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def _stamp():
    return F.lit(STAMP).cast("timestamp")


# ---------------------------------------------------------------- ingest and sinks


@query
def ingest_csv_raw(spark, sf):
    path = scratch_path(spark, "csv")
    # three files, and each repeats the header line, which is read as data
    source(spark, sf, "customer").repartition(3).write.option("header", True).csv(path)
    return files.read_csv_raw(spark, path)


@query
def ingest_csv_infer(spark, sf):
    path = scratch_path(spark, "csv")
    source(spark, sf, "orders").write.option("header", True).csv(path)
    declared = schema.ddl(
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice decimal(19,4), "
        "o_orderdate timestamp, o_orderpriority string"
    )
    return schema.conform(files.read_csv(spark, path, infer=True), declared)


@query
def ingest_csv_header(spark, sf):
    path = scratch_path(spark, "csv")
    source(spark, sf, "part").write.option("header", True).csv(path)
    return files.read_csv(spark, path)


@query
def ingest_glob(spark, sf):
    path = scratch_path(spark, "glob")
    customers = source(spark, sf, "customer").withColumn("folder", F.col("c_mktsegment"))
    customers.write.partitionBy("folder").option("header", True).csv(path)
    rows = files.read_csv(spark, f"{path}/*/*.csv", infer=True)
    declared = schema.ddl(
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal decimal(19,4), c_mktsegment string"
    )
    return schema.conform(rows, declared)


_NAMED = {
    "nation": ("n_nationkey", "n_name"),
    "customer": ("c_custkey", "c_name"),
    "supplier": ("s_suppkey", "s_name"),
    "part": ("p_partkey", "p_name"),
    "orders": ("o_orderkey", "o_orderpriority"),
}


@query
def ingest_manifest(spark, sf):
    root = scratch_path(spark, "landing")
    for table in _NAMED:
        source(spark, sf, table).write.option("header", True).csv(f"{root}/in/{table}.csv")
    manifest = files.landing_manifest(spark, f"{root}/in")
    written = layers.ingest_csv(spark, manifest, f"{root}/bronze", stamp=_stamp())
    return files.union_all(
        spark.read.parquet(path).select(
            F.lit(name).alias("table_name"), F.col(_NAMED[name][0]).cast("bigint").alias("id"),
            F.col(_NAMED[name][1]).alias("name"), F.date_format("bronze_ingestion", "yyyy-MM-dd").alias("day"),
        )
        for name, path in written.items()
    )


@query
def bronze_parquet(spark, sf):
    target = scratch_path(spark, "bronze")
    written = layers.ingest_parquet(spark, {"orders": f"{sf}/orders.parquet"}, target, stamp=_stamp())
    return spark.read.parquet(written["orders"])


@query
def path_scan(spark, sf):
    return files.read_path_sql(spark, f"{sf}/customer.parquet")


@query
def write_modes(spark, sf):
    path = sinks.create_table(source(spark, sf, "customer"), scratch_path(spark, "modes"))
    sinks.overwrite_table(source(spark, sf, "customer").select("c_custkey", "c_nationkey"), path)
    more = source(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("c_nationkey"), F.col("s_suppkey").alias("c_custkey")
    )
    sinks.append_by_name(more, path)
    return spark.read.parquet(path)


@query
def schema_merge(spark, sf):
    path = scratch_path(spark, "merge")
    orders = source(spark, sf, "orders")
    closed = orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey")
    open_ = orders.where("o_orderstatus <> 'F'").select("o_orderkey", "o_custkey", "o_orderpriority")
    closed.write.parquet(f"{path}/batch=1")
    open_.write.parquet(f"{path}/batch=2")
    return files.read_parquet(spark, path, merge_schema=True)


@query
def overwrite_schema_merge(spark, sf):
    """Orders replaced by their priorities; the columns of the former table stay, empty."""
    path = sinks.create_table(source(spark, sf, "orders").select("o_orderkey", "o_custkey"), scratch_path(spark, "merge"))
    priorities = source(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return spark.read.parquet(sinks.overwrite_merging(priorities, path))


@query
def empty_table_append(spark, sf):
    """An empty table with declared types and months as folders, filled by name."""
    path = sinks.create_empty(spark, scratch_path(spark, "empty"), "id bigint, amount decimal(19,4), mes string", ["mes"])
    rows = source(spark, sf, "orders").select(
        fn.year_month(F.col("o_orderdate")).alias("mes"), F.col("o_totalprice").cast("decimal(19,4)").alias("amount"),
        F.col("o_orderkey").alias("id"),
    )
    rows.write.mode("append").partitionBy("mes").parquet(path)
    return spark.read.schema("id bigint, amount decimal(19,4), mes string").parquet(path)


@query
def catalog_tables(spark, sf):
    """A database with a table that is created, appended to, replaced and dropped; rows after each step."""
    name = f"db_{uuid.uuid4().hex}"
    catalog.create_database(spark, name)
    customers = source(spark, sf, "customer").select("c_custkey", "c_nationkey")
    steps = []

    def seen(step):
        rows = spark.table(f"{name}.people").groupBy("c_nationkey").agg(F.count("*").alias("n"))
        path = scratch_path(spark, "seen")
        rows.select(F.lit(step).alias("step"), "c_nationkey", "n").write.parquet(path)
        steps.append(spark.read.parquet(path))

    catalog.create_table(customers, f"{name}.people")
    seen("created")
    catalog.append_table(source(spark, sf, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_nationkey").alias("c_nationkey")), f"{name}.people")
    seen("appended")
    catalog.replace_table(customers.withColumn("c_nationkey", F.col("c_nationkey") + 100), f"{name}.people")
    seen("replaced")
    catalog.drop_table(spark, f"{name}.people")
    catalog.drop_database(spark, name)
    return files.union_all(steps)


@query
def schema_rejects(spark, sf):
    """What the schema checks say to tables that do not fit, one row for each."""
    orders = source(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    fits = "o_orderkey bigint, o_custkey bigint, o_orderstatus string"
    cases = {
        "fits": fits,
        "fewer": "o_orderkey bigint, o_custkey bigint",
        "order": "o_custkey bigint, o_orderkey bigint, o_orderstatus string",
        "type": "o_orderkey bigint, o_custkey bigint, o_orderstatus int",
    }
    path = sinks.create_table(orders, scratch_path(spark, "rejects"))

    def appended(df):
        try:
            sinks.append_by_name(df, path)
        except schema.SchemaMismatch:
            return True
        return False

    found = [
        (name, schema.positional_difference(orders, schema.ddl(text)) is not None, schema.exact_difference(orders, schema.ddl(text)) is not None)
        for name, text in cases.items()
    ]
    bad = [appended(orders.drop("o_custkey")), appended(orders.withColumn("o_orderkey", F.lit("x")))]
    rows = spark.createDataFrame(found, "declared string, by_place boolean, by_name boolean")
    kept = spark.read.parquet(path).agg(F.count("*").alias("n")).scalar()
    return rows.withColumns({"append_refused": F.lit(all(bad)), "rows_left": kept})


@query
def append_by_name(spark, sf):
    path = scratch_path(spark, "append")
    customers = source(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    sinks.create_table(customers, path)
    more = source(spark, sf, "nation").select(
        F.col("n_name").alias("c_name"), F.col("n_regionkey").alias("c_nationkey"), F.col("n_nationkey").alias("c_custkey")
    )
    sinks.append_by_name(more, path)
    return spark.read.parquet(path)


@query
def export_by_year(spark, sf):
    racing_tables = racing_landing(spark, sf)
    laps = racing_tables["results"].select("resultId", "raceId", "driverId", "laps")
    path = scratch_path(spark, "years")
    sinks.export_slices(racing.laps_with_year(laps, racing_tables["races"], 1996, 1998), path, "year")
    return spark.read.parquet(path)


@query
def ingest_stamp(spark, sf):
    return files.stamped(source(spark, sf, "supplier"), stamp=_stamp())


@query
def param_sql(spark, sf):
    return reports.parameter_sql(
        spark,
        "SELECT o_orderkey, o_custkey, :label AS label FROM {orders} "
        "WHERE o_orderpriority = :priority AND o_totalprice >= :least",
        {"label": "checked", "priority": "1-URGENT", "least": 250000},
        orders=source(spark, sf, "orders"),
    )


# ---------------------------------------------------------------- cleaning


@query
def conform_schema(spark, sf):
    declared = schema.ddl(
        "l_orderkey bigint, l_linenumber int, l_quantity smallint, l_extendedprice decimal(19,4), "
        "l_discount decimal(10,4), l_shipdate timestamp, l_returnflag string"
    )
    return schema.conform(source(spark, sf, "lineitem"), declared)


@query
def default_fill(spark, sf):
    customers = sales_landing(spark, sf)["sales_customer"]
    return customers.select(
        "CustomerID",
        fn.filled(F.col("StoreID"), F.lit(0)).alias("StoreID"),
        fn.filled(F.col("ModifiedDate").cast("timestamp"), _stamp()).alias("ModifiedDate"),
        fn.filled(F.col("rowguid"), fn.stable_uuid(F.col("CustomerID"))).alias("rowguid"),
    )


@query
def uuid_fill(spark, sf):
    customers = sales_landing(spark, sf)["sales_customer"]
    ids = customers.select("CustomerID", fn.filled(F.col("rowguid"), fn.random_uuid()).alias("rowguid"))
    return ids.select("CustomerID", F.length("rowguid").alias("id_length"))


@query
def account_number(spark, sf):
    customers = sales_landing(spark, sf)["sales_customer"]
    return customers.select(
        "CustomerID", fn.account_number(F.col("AccountNumber"), F.col("CustomerID")).alias("AccountNumber")
    )


@query
def try_cast_null(spark, sf):
    results = racing_landing(spark, sf)["results"]
    return results.select(
        "resultId",
        F.col("position").try_cast("int").alias("position"),
        F.col("rank").try_cast("int").alias("rank"),
        F.col("time").try_cast("int").alias("time"),
    )


@query
def quality_rules(spark, sf):
    orders = sales_landing(spark, sf)["sales_salesorderheader"]
    return keep_valid(orders, SILVER["sales_salesorderheader"].rules).select("SalesOrderID", "RevisionNumber", "Status", "Freight")


@query
def quality_rules_nullable(spark, sf):
    offers = sales_landing(spark, sf)["sales_specialoffer"]
    return keep_valid(offers, SILVER["sales_specialoffer"].rules).select("SpecialOfferID", "DiscountPct", "MinQty", "MaxQty")


@query
def dedup_latest(spark, sf):
    return latest_per_key(source(spark, sf, "orders"), "o_custkey", "o_orderdate")


@query
def dedup_composite(spark, sf):
    return latest_per_key(source(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")


@query
def order_total(spark, sf):
    orders = sales_landing(spark, sf)["sales_salesorderheader"]
    total = fn.order_total(F.col("SubTotal"), F.col("TaxAmt"), F.col("Freight"))
    return orders.select("SalesOrderID", "RevisionNumber", total.alias("TotalDue"))


@query
def line_total_silver(spark, sf):
    lines = sales_landing(spark, sf)["sales_salesorderdetail"]
    total = fn.line_total_silver(F.col("UnitPrice"), F.col("UnitPriceDiscount"), F.col("OrderQty"))
    return lines.select("SalesOrderDetailID", "OrderQty", "UnitPrice", total.alias("LineTotal"))


@query
def quality_rules_optional(spark, sf):
    """Products under their optional rules as well."""
    spec = with_optional_rules(SILVER["production_product"])
    return clean(sales_landing(spark, sf)[spec.name], spec, _stamp(), reproducible_ids=True, wide=True)


def _silver(name: str) -> Query:
    def run(spark, sf):
        return clean(sales_landing(spark, sf)[name], SILVER[name], _stamp(), reproducible_ids=True, wide=True)

    return run


SILVER_KEYS = {
    {"sales_salesorderdetail": "silver_lineitem", "sales_salesorderheader": "silver_orders"}.get(
        name, f"silver_{name.split('_', 1)[1]}"
    ): name
    for name in SILVER
}
_QUERIES.update({key: _silver(name) for key, name in SILVER_KEYS.items()})


def _sifted(spark, sf):
    """For each silver table: its name, the refused rows and the observed counts."""
    landing = sales_landing(spark, sf)

    def one(name):
        _, refused, counts = clean_sifted(landing[name], SILVER[name], scratch_path(spark, "sifted"), _stamp(), reproducible_ids=True, wide=True)
        return name, refused, counts

    for name in SILVER:
        landing[name]  # opened here, so that the threads only read
    return layers.each(one, list(SILVER), layers.PARALLEL_TABLES)


@query
def quarantine_rows(spark, sf):
    """Rows that the rules of the silver tables refuse, with the rules they broke."""
    return files.union_all(
        refused.select(
            F.lit(name).alias("table_name"), F.concat_ws("|", *[F.col(k).cast("string") for k in SILVER[name].keys]).alias("key"),
            F.array_join(BROKEN, "; ").alias("broken"),
        )
        for name, refused, _ in _sifted(spark, sf)
    )


@query
def quarantine_counts(spark, sf):
    """Rows, kept rows, refused rows and rows that broke each rule, as observed while the tables were written."""
    found = [(name, what, n) for name, _, counts in _sifted(spark, sf) for what, n in counts.items()]
    return spark.createDataFrame(found, "table_name string, what string, n bigint")


# ---------------------------------------------------------------- star schema


def _renamed(name: str) -> Query:
    return lambda spark, sf: star.renamed_dimension(sales_landing(spark, sf), name, wide=True)


_QUERIES.update(
    {
        "dim_rename": _renamed("DimPromotion"),
        "dim_currency": _renamed("DimCurrency"),
        "dim_sales_reason": _renamed("DimSalesReason"),
        "dim_sales_territory": _renamed("DimSalesTerritory"),
    }
)


@query
def dim_date(spark, sf):
    return star.dim_date(sales_landing(spark, sf))


@query
def dim_product(spark, sf):
    return star.dim_product(sales_landing(spark, sf), wide=True)


@query
def dim_customer(spark, sf):
    return star.dim_customer(sales_landing(spark, sf), wide=True)


@query
def dim_geography(spark, sf):
    return star.dim_geography(sales_landing(spark, sf), wide=True)


@query
def fact_sales(spark, sf):
    return star.fact_internet_sales(sales_staged(spark, sf), wide=True)


@query
def fact_bucketed(spark, sf):
    """The fact from orders and lines in buckets of the order id: neither is shuffled for deduplication or their join."""
    root = scratch_path(spark, "buckets")
    tables = dict(sales_staged(spark, sf))
    made = []
    for name in ("sales_salesorderheader", "sales_salesorderdetail"):
        made.append(f"{name}_{uuid.uuid4().hex}")
        tables[name] = buckets.publish_bucketed(tables[name], made[-1], root, "SalesOrderID", 16)
    fact = star.fact_internet_sales(tables, wide=True, by_order=True)
    for table in made:
        catalog.drop_table(spark, table)  # external tables: their files stay
    return fact


@query
def one_big_table(spark, sf):
    return star.one_big_table(sales_staged(spark, sf), wide=True)


@query
def agg_product_day(spark, sf):
    tables = sales_staged(spark, sf)
    fact = star.fact_internet_sales(
        tables, wide=True, columns=["ProductKey", "OrderDateKey", "OrderQty", "LineTotal"]
    )
    return star.agg_product_day(fact, star.dim_product(tables, wide=True), wide=True)


_VIEW_FACT = [
    "SalesOrderID", "SalesOrderDetailID", "OrderDateKey", "DueDateKey", "ShipDateKey", "CustomerKey",
    "OrderQty", "UnitPrice", "LineTotal", "ProductKey",
]


@query
def vw_internet_sales(spark, sf):
    tables = sales_staged(spark, sf)
    fact = star.fact_internet_sales(tables, wide=True, columns=_VIEW_FACT)
    return reports.internet_sales_view(fact, star.dim_product(tables, wide=True))


# ---------------------------------------------------------------- reports


@query
def sales_by_year(spark, sf):
    tables = sales_staged(spark, sf)
    fact = star.fact_internet_sales(tables, wide=True, columns=["ProductKey", "OrderDateKey", "LineTotal"])
    return reports.sales_by_year(fact, star.dim_product(tables, wide=True), star.dim_date(tables))


@query
def sales_by_category(spark, sf):
    tables = sales_staged(spark, sf)
    fact = star.fact_internet_sales(tables, wide=True, columns=["ProductKey", "LineTotal"])
    return reports.sales_by_category(fact, star.dim_product(tables, wide=True))


@query
def monthly_avg(spark, sf):
    orders = source(spark, sf, "orders").select("o_orderdate", F.col("o_totalprice").cast("decimal(19,4)").alias("price"))
    return reports.monthly_average(orders, "o_orderdate", "price").select("mes", F.col("media").cast("decimal(19,4)").alias("media"))


@query
def year_month(spark, sf):
    orders = source(spark, sf, "orders")
    return orders.groupBy(fn.year_month(F.col("o_orderdate")).alias("ano_mes")).agg(F.count("*").alias("orders"))


@query
def points_by_driver(spark, sf):
    tables = racing_landing(spark, sf)
    points = racing.points_by_driver(tables["results"], tables["drivers"], tables["constructors"])
    return points.withColumn("points_driver", F.col("points_driver").cast("decimal(38,4)"))


def _race_rows(spark, sf):
    tables = racing_landing(spark, sf)
    pairs = racing.driver_positions(tables["results"])
    return racing.race_results(
        racing.silver_results(tables["results"], pairs, _stamp()),
        racing.silver_races(tables["races"], _stamp()),
        racing.silver_circuits(tables["circuits"]),
        racing.silver_drivers(tables["drivers"], _stamp()),
    )


@query
def race_results(spark, sf):
    return _race_rows(spark, sf)


@query
def race_winners(spark, sf):
    return racing.race_winners(_race_rows(spark, sf))


@query
def racing_silver_results(spark, sf):
    tables = racing_landing(spark, sf)
    pairs = racing.driver_positions(tables["results"])
    return racing.silver_results(tables["results"], pairs, _stamp())


@query
def racing_silver_circuits(spark, sf):
    return racing.silver_circuits(racing_landing(spark, sf)["circuits"])


@query
def racing_silver_constructor_results(spark, sf):
    return racing.silver_constructor_results(racing_landing(spark, sf)["constructor_results"], _stamp())


@query
def racing_silver_drivers(spark, sf):
    return racing.silver_drivers(racing_landing(spark, sf)["drivers"], _stamp())


@query
def racing_silver_constructors(spark, sf):
    return racing.silver_constructors(racing_landing(spark, sf)["constructors"], _stamp())


@query
def racing_silver_races(spark, sf):
    return racing.silver_races(racing_landing(spark, sf)["races"], _stamp())


@query
def semi_join_in(spark, sf):
    tables = racing_landing(spark, sf)
    laps = tables["results"].select("resultId", "raceId", "driverId", "laps")
    return racing.laps_of_years(laps, tables["races"], 1997, 1997)


@query
def distinct_pairs(spark, sf):
    return racing.driver_positions(racing_landing(spark, sf)["results"])


@query
def category_totals(spark, sf):
    lines = source(spark, sf, "lineitem").select("l_returnflag", F.col("l_extendedprice").cast("decimal(19,4)").alias("amount"))
    totals = reports.category_totals(lines, "l_returnflag", "amount")
    return totals.withColumn("total_valor", F.col("total_valor").cast("decimal(38,2)"))


@query
def table_counts(spark, sf):
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "absent")
    return layers.verify_tables(spark, sf, [f"{n}.parquet" for n in names])


@query
def preview(spark, sf):
    return reports.preview(source(spark, sf, "orders"), ["o_orderkey"], 10)


# ---------------------------------------------------------------- changes and versions


@query
def insert_rows(spark, sf):
    accounts = source(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    more = source(spark, sf, "supplier").select(
        (-F.col("s_suppkey") - 1).alias("c_custkey"), F.col("s_nationkey").alias("c_nationkey"), F.col("s_name").alias("c_name")
    )
    return change.insert_rows(accounts, more)


@query
def create_rows(spark, sf):
    """Rows made on the driver, as a small lookup: how urgent each order is, and the orders of each urgency."""
    names = [("1-URGENT", 5), ("2-HIGH", 4), ("3-MEDIUM", 3), ("9-NEVER", None)]
    ranks = spark.createDataFrame(names, "priority string, urgency int")
    orders = source(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("orders"))
    return joins.lookup_join(orders, ranks, "o_orderpriority", "priority", "full")


def _accounts(spark, sf):
    """Customers with some unknown (NULL) segments."""
    segment = F.when(F.col("c_nationkey") != 3, F.col("c_mktsegment"))
    return source(spark, sf, "customer").select(
        "c_custkey", F.col("c_acctbal").cast("decimal(19,4)").alias("balance"), segment.alias("segment")
    )


@query
def update_where(spark, sf):
    doubled = {"balance": F.col("balance") * 2, "segment": F.lit("BUILD")}
    return change.update_where(_accounts(spark, sf), "segment = 'BUILDING'", doubled)


@query
def delete_where(spark, sf):
    return change.delete_where(_accounts(spark, sf), "segment = 'BUILDING'")


def _merge_sides(spark, sf):
    target = source(spark, sf, "customer").select(
        F.when(F.col("c_nationkey") != 3, F.col("c_custkey")).alias("id"),
        F.col("c_acctbal").cast("decimal(19,4)").alias("balance"),
        F.col("c_mktsegment").alias("note"),
    )
    key = F.when(F.col("s_nationkey") % 2 == 0, F.col("s_suppkey")).otherwise(-1 - F.col("s_suppkey"))
    changes = source(spark, sf, "supplier").select(
        F.when(F.col("s_nationkey") != 5, key).alias("id"),
        F.col("s_acctbal").cast("decimal(19,4)").alias("balance"),
        F.lit("changed").alias("note"),
        F.col("s_name").alias("agent"),
    )
    return target, changes


@query
def merge_upsert(spark, sf):
    return change.merge(*_merge_sides(spark, sf), "id")


@query
def merge_delete_missing(spark, sf):
    return change.merge(*_merge_sides(spark, sf), "id", delete_missing="balance < 0")


@query
def merge_partitioned(spark, sf):
    """Orders of some months get a new status; only their folders are rewritten. Folder names look like
    numbers (``01``), and orders of August have none."""
    path = scratch_path(spark, "months")
    month = F.when(F.month("o_orderdate") != 8, F.date_format("o_orderdate", "MM"))
    orders = source(spark, sf, "orders").select("o_orderkey", "o_orderstatus", month.alias("mes"))
    sinks.write_partitioned(orders, path, ["mes"])
    some = orders.where("o_orderkey % 2 = 0 AND (mes IN ('01', '11') OR mes IS NULL)")
    change.merge_partitions(path, some.withColumn("o_orderstatus", F.lit("X")), "o_orderkey", "mes")
    return spark.read.schema("o_orderkey bigint, o_orderstatus string, mes string").parquet(path)


@query
def merge_files(spark, sf):
    """The upsert of ``merge_upsert`` on a table in files, of which only those with matched keys are written anew."""
    target, changes = _merge_sides(spark, sf)
    root = scratch_path(spark, "touched")
    touched.create(target, root, "id", 24)
    touched.merge_files(spark, root, changes, "id")
    return touched.read(spark, root)


@query
def merge_files_delete(spark, sf):
    target, changes = _merge_sides(spark, sf)
    root = scratch_path(spark, "touched")
    touched.create(target, root, "id", 24)
    touched.merge_files(spark, root, changes, "id", delete_missing="balance < 0")
    return touched.read(spark, root)


@query
def change_files(spark, sf):
    """Orders in files: some are updated, some deleted, some merged in, some replaced by key, one change upon the other."""
    root = scratch_path(spark, "touched")
    orders = source(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(19,4)").alias("price"))
    touched.create(orders, root, ["o_orderkey"], 32)
    touched.update_files(spark, root, "o_orderkey % 1000 < 20", {"price": F.col("price") * 2, "o_orderstatus": F.lit("U")})
    touched.delete_files(spark, root, "o_orderkey % 1000 BETWEEN 15 AND 30")
    more = orders.where("o_orderkey % 1000 BETWEEN 25 AND 40").withColumn("note", F.lit("merged"))
    touched.merge_files(spark, root, more, "o_orderkey")
    gone = orders.where("o_orderkey % 1000 BETWEEN 38 AND 44")
    again = gone.where("o_custkey % 2 = 0").withColumns({"o_orderstatus": F.lit("R"), "note": F.lit("replaced")})
    touched.replace_rows(spark, root, gone.select("o_orderkey"), again)
    return touched.read(spark, root)


@query
def publish_overwrite(spark, sf):
    root = scratch_path(spark, "publish")
    table = f"published_{uuid.uuid4().hex}"
    sinks.publish_overwrite(_accounts(spark, sf), table, root)
    location = sinks.publish_overwrite(change.delete_where(spark.table(table), "balance < 0"), table, root)
    catalog.drop_table(spark, table)  # an external table: its files stay
    return spark.read.parquet(location)


def _order_batches(spark, sf):
    """Orders as yearly batches 0, 1, 2, ..."""
    orders = source(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    return orders.withColumn("insercao_id", F.year("o_orderdate") - 1995)


@query
def append_batches(spark, sf):
    path = versions.write_batches(_order_batches(spark, sf), scratch_path(spark, "batches"), "insercao_id", _stamp())
    return spark.read.parquet(path).select("o_orderkey", "insercao_id", F.col(versions.VERSION).alias("version"))


@query
def batch_summary(spark, sf):
    path = versions.write_batches(_order_batches(spark, sf), scratch_path(spark, "batches"), "insercao_id", _stamp())
    return reports.batch_summary(spark.read.parquet(path), "insercao_id")


def _versioned(spark, sf):
    batches = _order_batches(spark, sf)
    path = versions.write_batches(batches, scratch_path(spark, "versions"), "insercao_id", _stamp())
    versions.write_version(batches.where("o_orderkey < 0"), path, operation="overwrite", stamp=_stamp())
    versions.write_version(batches.where("o_orderstatus = 'F'"), path, stamp=_stamp())
    wider = source(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    versions.write_version(wider.where("o_orderstatus = 'O'"), path, stamp=_stamp())
    return path


@query
def as_of_version(spark, sf):
    """Before an overwrite, right after one without rows, and after appends of which the last adds a column."""
    path = _versioned(spark, sf)
    emptied = versions.newest_version(spark, path) - 2
    early = versions.as_of(spark, path, 3).withColumn("as_of", F.lit("version 3"))
    empty = versions.as_of(spark, path, emptied).withColumn("as_of", F.lit("emptied"))
    now = versions.as_of(spark, path).withColumn("as_of", F.lit("now"))
    states = early.unionByName(empty).unionByName(now, allowMissingColumns=True)
    return states.select("as_of", "o_orderkey", "o_orderstatus", "o_custkey")


@query
def version_history(spark, sf):
    return versions.history(spark, _versioned(spark, sf))


# ---------------------------------------------------------------- layout


@query
def partition_prune(spark, sf):
    path = scratch_path(spark, "months")
    orders = source(spark, sf, "orders").withColumn("ano_mes", fn.year_month(F.col("o_orderdate")))
    sinks.write_partitioned(orders, path, ["ano_mes"])
    return reports.month_filter(spark.read.parquet(path), "1997-03")


@query
def compact_files(spark, sf):
    path = scratch_path(spark, "compact")
    source(spark, sf, "lineitem").repartition(40).write.parquet(f"{path}/many")
    return spark.read.parquet(layout.compact(spark, f"{path}/many", f"{path}/few"))


@query
def zorder_layout(spark, sf):
    path = scratch_path(spark, "cluster")
    layout.cluster(source(spark, sf, "lineitem"), "l_returnflag", 8).write.parquet(path)
    return reports.category_filter(spark.read.parquet(path), "R", "l_returnflag")


@query
def zorder_layout_columns(spark, sf):
    path = scratch_path(spark, "cluster")
    layout.cluster(source(spark, sf, "lineitem"), ["l_partkey", "l_shipdate"], 8).write.parquet(path)
    return spark.read.parquet(path)


@query
def layout_report(spark, sf):
    """Whether a narrow range is found in fewer than half of the files, before and after clustering, for
    text that begins alike and for ids that a double cannot tell apart."""
    root = scratch_path(spark, "report")
    rows = source(spark, sf, "orders").select(
        F.concat(F.lit("https://example.org/orders/by/customer/"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("url"),
        (F.col("o_orderkey") + F.lit(2**60)).alias("id"),
    )
    rows.repartition(24).write.parquet(f"{root}/spread")
    layout.cluster(rows, ["url", "id"], 24).write.parquet(f"{root}/clustered")
    layouts = {name: f"{root}/{name}" for name in ("spread", "clustered")}
    low = F.lit("https://example.org/orders/by/customer/000000010")
    conditions = {"url": F.col("url") < low, "id": F.col("id") < F.lit(2**60 + 60)}
    return files.union_all(
        layout.layout_report(spark, layouts, condition).select(
            "layout", F.lit(name).alias("column_name"), "rows_hit", (F.col("files_hit") * 2 < F.col("files")).alias("narrow")
        )
        for name, condition in conditions.items()
    )


@query
def bloom_lookup(spark, sf):
    """Orders of a few customers from files that all span the same customers."""
    orders = source(spark, sf, "orders").repartition(24, "o_orderkey")
    path = sinks.write_with_filters(orders, scratch_path(spark, "filters"), {"o_custkey": 10_000})
    return spark.read.parquet(path).where(F.col("o_custkey").isin(1, 17, 60, 101, 1234))


@query
def file_stats(spark, sf):
    rows = files.file_stats(source(spark, sf, "lineitem"))
    return rows.select(F.element_at(F.split("file_path", "/"), -1).alias("file_name"), "rows")


@query
def synth_range(spark, sf):
    """Sales for every key from the first order to the last, by draws that depend on the key, beside the real order if there is one."""
    orders = source(spark, sf, "orders")
    first, last = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    keys = spark.range(first, last + 1)
    sales = synth.synthetic_sales(keys, synth.hashed_draws(F.col("id")), keep=["id"]).withColumn("valor", F.col("valor").cast("decimal(19,4)"))
    known = orders.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").cast("decimal(19,4)").alias("price"), "o_orderstatus")
    return sales.join(known, "id", "left")


@query
def synth_sales(spark, sf):
    orders = source(spark, sf, "orders")
    return synth.synthetic_sales(orders, synth.hashed_draws(F.col("o_orderkey")))


# ---------------------------------------------------------------- streaming


def _event_drops(spark, sf):
    events = source(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    cut = F.lit("2024-01-15").cast("timestamp")
    return events.where(F.col("ts") < cut), events.where(F.col("ts") >= cut)


@query
def stream_append(spark, sf):
    root = scratch_path(spark, "stream")
    for drop in _event_drops(spark, sf):
        drop.write.mode("append").parquet(f"{root}/in")
        stream = arrivals.file_stream(spark, f"{root}/in", drop.schema)
        arrivals.append_stream(stream, f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out")


@query
def stream_upsert_latest(spark, sf):
    """The newer half of the events arrives first; the older half then overwrites it."""
    root = scratch_path(spark, "upsert")
    older, newer = _event_drops(spark, sf)
    columns = ["user_id", F.col("ts").alias("process_date"), "event_id", "event_type"]
    for drop in (newer.select(columns), older.select(columns)):
        writer = drop.write.mode("append").option("header", True)
        writer.option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(f"{root}/in")
        stream = arrivals.file_stream(spark, f"{root}/in", drop.schema, "csv")
        arrivals.upsert_stream(stream, f"{root}/out", f"{root}/checkpoint", "user_id", stamp=_stamp())
    return arrivals.current_rows(spark, f"{root}/out", "user_id")


@query
def stream_schema_evolve(spark, sf):
    """The second drop has a column more; rows of the first drop have it empty."""
    root = scratch_path(spark, "evolve")
    older, newer = _event_drops(spark, sf)
    columns = ["event_id", F.col("ts").alias("process_date"), "event_type"]
    drops = {"one": older.select(columns), "two": newer.select(*columns, "props")}
    for name, drop in drops.items():
        drop.write.mode("append").parquet(f"{root}/in/{name}")
        tracked = schema_log.track(spark, f"{root}/in/{name}", f"{root}/schema", "parquet")
        stream = arrivals.file_stream(spark, f"{root}/in/*", tracked)
        arrivals.upsert_stream(stream, f"{root}/out", f"{root}/checkpoint", "event_id", stamp=_stamp())
    return arrivals.current_rows(spark, f"{root}/out", "event_id")


@query
def stream_csv_evolve(spark, sf):
    """CSV drops, types found in their values: the second adds a column and turns whole numbers to fractions."""
    root = scratch_path(spark, "csv-evolve")
    older, newer = _event_drops(spark, sf)
    whole = F.col("event_id") % 100
    drops = {
        "one": older.select((F.col("event_id") % 500).alias("key"), F.col("ts").alias("process_date"), whole.alias("val")),
        "two": newer.select(
            (F.col("event_id") % 500).alias("key"), F.col("ts").alias("process_date"), (whole + 0.5).alias("val"), "event_type"
        ),
    }
    for name, drop in drops.items():
        writer = drop.write.mode("append").option("header", True)
        writer.option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(f"{root}/in/{name}")
        tracked = schema_log.track(spark, f"{root}/in/{name}", f"{root}/schema", "csv")
        stream = arrivals.file_stream(spark, f"{root}/in/*", tracked, "csv")
        arrivals.upsert_stream(stream, f"{root}/out", f"{root}/checkpoint", "key", stamp=_stamp())
    rows = arrivals.current_rows(spark, f"{root}/out", "key")
    return rows.withColumns({"key": F.col("key").cast("bigint"), "val": F.col("val").cast("double")})


@query
def stream_upsert_fold(spark, sf):
    """Three drops with a fold and a restart between them; the last drop is older than what it replaces."""
    root = scratch_path(spark, "fold")
    older, newer = _event_drops(spark, sf)
    third = F.col("event_id") % 3
    drops = (newer.where(third == 0), newer.where(third != 0), older)
    for number, drop in enumerate(drops):
        drop.select("user_id", F.col("ts").alias("process_date"), "event_id").write.mode("append").parquet(f"{root}/in")
        for _ in range(2):  # the second start finds nothing new
            stream = arrivals.file_stream(spark, f"{root}/in", "user_id bigint, process_date timestamp, event_id bigint")
            arrivals.upsert_stream(stream, f"{root}/out", f"{root}/checkpoint", "user_id", stamp=_stamp())
        if number < 2:
            arrivals.fold_batches(spark, f"{root}/out", "user_id", buckets=8)
    return arrivals.current_rows(spark, f"{root}/out", "user_id")


@query
def stream_bounded(spark, sf):
    """One drop of 40 files, drained in batches of bounded bytes; files of finished batches move to an archive."""
    root = scratch_path(spark, "bounded")
    events = source(spark, sf, "events")
    events.repartition(40).write.parquet(f"{root}/in")
    total = files.file_inventory(spark, f"{root}/in").agg(F.sum("length")).first()[0]
    stream = arrivals.file_stream(spark, f"{root}/in", events.schema, max_bytes=max(1, total // 6), archive=f"{root}/archive", listed_files=100)
    arrivals.append_stream(stream, f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out")


def late_arrivals(spark, sf):
    """Three drops of events with repeated rows and rows that come days too late, drained one by one; the folder of the two tables."""
    root = scratch_path(spark, "late")
    events = source(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    drops = (
        "ts < '2024-01-10' AND event_id % 4 <> 3",
        "(ts >= '2024-01-10' AND ts < '2024-01-20') OR (event_id % 4 = 3 AND ts < '2024-01-10') OR (ts < '2024-01-10' AND event_id % 5 = 0)",
        "ts >= '2024-01-20' OR event_id % 7 = 0",
    )
    for condition in drops:
        drop = events.where(condition)
        drop.unionAll(drop.where("event_id % 11 = 0")).repartition(3).write.mode("append").parquet(f"{root}/in")
        for _ in range(2):  # the second start finds nothing new
            stream = arrivals.file_stream(spark, f"{root}/in", events.schema)
            late.dedup_stream(stream, f"{root}/out", f"{root}/checkpoint", "event_id", "ts", "2 days")
    return f"{root}/out"


@query
def stream_first_rows(spark, sf):
    return late.first_rows(spark, late_arrivals(spark, sf))


@query
def stream_late_rows(spark, sf):
    return late.late_rows(spark, late_arrivals(spark, sf))


@query
def stream_csv_any_order(spark, sf):
    """CSV drops with columns in other orders, added ones among them, and values that turn to fractions."""
    root = scratch_path(spark, "csv-names")
    events = source(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    key, date, whole = (F.col("event_id") % 500).alias("key"), F.col("ts").alias("process_date"), F.col("event_id") % 100
    drops = (
        ("ts < '2024-01-11'", [key, date, whole.alias("val")]),
        ("ts >= '2024-01-11' AND ts < '2024-01-21'", [whole.alias("val"), "event_type", key, date]),
        ("ts >= '2024-01-21'", [date, "event_type", F.col("user_id").alias("user"), key, (whole + 0.5).alias("val")]),
    )
    for number, (condition, columns) in enumerate(drops):
        writer = events.where(condition).select(columns).repartition(2).write.option("header", True)
        writer.option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(f"{root}/in/{number}")
        tracked = schema_log.track_by_name(spark, f"{root}/in/{number}", f"{root}/schema")
        stream = schema_log.stream_by_name(spark, f"{root}/in/*", tracked, f"{root}/schema")
        arrivals.upsert_stream(stream, f"{root}/out", f"{root}/checkpoint", "key", stamp=_stamp())
    rows = arrivals.current_rows(spark, f"{root}/out", "key")
    return rows.withColumns({"key": F.col("key").cast("bigint"), "val": F.col("val").cast("double"), "user": F.col("user").cast("bigint")})


def growing_folds(spark, sf):
    """Ten drops of events, each folded into a base whose folders are bounded; the table's folder."""
    root = scratch_path(spark, "growth")
    events = source(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("process_date"), "user_id", "event_type")
    for number in range(10):
        part = events.where(F.col("event_id") % 10 == number)
        again = events.where((F.col("event_id") % 10 == number - 1) & (F.col("event_id") % 3 == 0)).withColumn("event_type", F.lit("again"))
        part.unionByName(again).write.mode("append").parquet(f"{root}/in")
        arrivals.upsert_stream(arrivals.file_stream(spark, f"{root}/in", events.schema), f"{root}/out", f"{root}/checkpoint", "event_id", stamp=_stamp())
        arrivals.fold_batches(spark, f"{root}/out", "event_id", buckets=1, folder_bytes=FOLD_BYTES)
    return f"{root}/out"


#: Bytes of a folder in the query of growing folds: small, so that test tables split too.
FOLD_BYTES = 64 * 1024


@query
def stream_fold_growth(spark, sf):
    return arrivals.current_rows(spark, growing_folds(spark, sf), "event_id")


# ---------------------------------------------------------------- whole run


def _layer_run(spark, sf):
    root = scratch_path(spark, "layers")
    landing = sales_landing(spark, sf)
    for name in landing:
        landing[name].write.options(**sinks.LAYER_OPTIONS).parquet(f"{root}/landing/{name}.parquet")
    for _ in range(2):
        gold = layers.run_layers(
            spark, f"{root}/landing", f"{root}/lake", stamp=_stamp(), wide=True, reproducible_ids=True, keep_former=False
        )
    return gold


@query
def run_layers(spark, sf):
    """Landing to gold on disk, twice onto one target, then the category report over the written gold tables."""
    gold = _layer_run(spark, sf)
    return reports.sales_by_category(
        spark.read.parquet(gold["FactInternetSales"]), spark.read.parquet(gold["DimProduct"])
    )


def increments(spark, sf):
    """A lake that takes two drops in. The second has 1 % of the orders with their lines, later revisions of other
    orders, and some customers, products and offers that lines of the first refer to already."""
    root = scratch_path(spark, "increments")
    second = {
        "sales_salesorderheader": "SalesOrderID % 100 = 7 OR (RevisionNumber = 2 AND SalesOrderID % 10 = 3)",
        "sales_salesorderdetail": "SalesOrderID % 100 = 7",
        "sales_customer": "CustomerID % 97 = 5",
        "production_product": "ProductID % 89 = 4",
        "sales_specialoffer": "SpecialOfferID % 31 = 2",
    }
    landing = sales_landing(spark, sf)
    for name in landing:
        late = F.expr(second.get(name, "false"))
        landing[name].where(~F.coalesce(late, F.lit(False))).write.options(**sinks.LAYER_OPTIONS).parquet(f"{root}/one/{name}.parquet")
        if name in second:
            landing[name].where(late).write.options(**sinks.LAYER_OPTIONS).parquet(f"{root}/two/{name}.parquet")
    lake = incremental.Lake(spark, f"{root}/lake", wide=True)
    incremental.take_in(lake, {name: f"{root}/one/{name}.parquet" for name in landing}, _stamp())
    rewritten = incremental.take_in(lake, {name: f"{root}/two/{name}.parquet" for name in second}, _stamp())
    return lake, rewritten


@query
def run_increments(spark, sf):
    """The daily aggregate after two drops, of which the second costs its own keys: as if all had come at once."""
    lake, _ = increments(spark, sf)
    return touched.read(spark, lake.gold(incremental.DAILY))


@query
def run_racing(spark, sf):
    """Racing tables written as CSV with ``\\N`` for missing values, then bronze, silver and gold."""
    root = scratch_path(spark, "racing")
    landing = racing_landing(spark, sf)
    for name in layers.RACING_TABLES:
        sinks.write_csv(landing[name].drop("bronze_ingestion"), f"{root}/{name}.csv", files.NULL_MARKER)
    gold = layers.run_racing(spark, files.landing_manifest(spark, root), f"{root}/lake", _stamp())
    return spark.read.parquet(gold["race_results"])


@query
def salted_lookup(spark, sf):
    """Supplier names for lines of which a third, equal rows among them, name one supplier."""
    hot = F.when(F.col("l_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("l_suppkey"))
    lines = source(spark, sf, "lineitem").select(
        (F.col("l_orderkey") % 50).alias("l_group"), "l_linenumber", hot.cast("bigint").alias("l_suppkey")
    )
    suppliers = source(spark, sf, "supplier").select("s_suppkey", "s_name")
    pieces = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = joins.hot_values(lines, "l_suppkey", pieces)
    return joins.salted_join(lines, suppliers, "l_suppkey", "s_suppkey", "left", named, pieces)
