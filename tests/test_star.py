"""Gold plans on hand-made tables: traps that the generated tables do not hold."""

from datetime import datetime
from decimal import Decimal

import pytest
from conftest import SF, plan_of, rows
from pyspark.sql import functions as F

from stratalake.operators.dedup import is_unique, latest_per_key
from stratalake.plans import racing, reports, star
from stratalake.plans.specs import SILVER
from stratalake.registry.landing import sales_staged

D = [datetime(2020, 1, d) for d in range(1, 10)]


def table(spark, name, *records):
    """Records as dicts; columns that are not given are NULL."""
    schema = SILVER[name].schema
    data = [tuple(r.get(c) for c in schema.names) for r in records]
    return spark.createDataFrame(data, schema)


@pytest.fixture
def tables(spark):
    def line(order, key, product, offer=1, qty=2, price="10", discount="0.1", day=D[0]):
        return dict(
            SalesOrderID=order, SalesOrderDetailID=key, ProductID=product, SpecialOfferID=offer, OrderQty=qty,
            UnitPrice=Decimal(price), UnitPriceDiscount=Decimal(discount), LineTotal=Decimal("18"), ModifiedDate=day,
        )

    def order(key, online, day=D[0], customer=1, territory=1):
        return dict(
            SalesOrderID=key, RevisionNumber=1, OrderDate=D[0], DueDate=D[1], ShipDate=None, OnlineOrderFlag=online,
            CustomerID=customer, TerritoryID=territory, SubTotal=Decimal(1), TaxAmt=Decimal(1), Freight=Decimal(1),
            TotalDue=Decimal(3), ModifiedDate=day,
        )

    return {
        "sales_salesorderheader": table(
            spark, "sales_salesorderheader",
            order(1, 1), order(2, 1), order(2, 0, D[1]), order(3, 0), order(3, 1, D[1]), order(4, 1, customer=9, territory=9),
        ),
        "sales_salesorderdetail": table(
            spark, "sales_salesorderdetail",
            line(1, 10, 1), line(1, 11, 99, offer=99),  # unknown product and offer
            line(2, 20, 1),  # latest header row is offline
            line(3, 30, 1), line(3, 30, 1, qty=5, day=D[1]),  # the later row of the line counts
            line(4, 40, 1), line(77, 70, 1),  # unknown customer and territory; unknown order
            line(1, 12, 1, qty=0), line(1, 13, 1, price="0"), line(1, 14, 1, qty=3), line(1, 14, 1, qty=0, day=D[1]),
        ),
        "production_product": table(
            spark, "production_product",
            dict(ProductID=1, Name="bolt", ProductNumber="B1", ProductSubcategoryID=5, ProductModelID=3, ModifiedDate=D[0]),
            dict(ProductID=1, Name="bolt2", ProductNumber="B1", ProductSubcategoryID=5, ProductModelID=3, ModifiedDate=D[1]),
            dict(ProductID=2, Name="nut", ProductNumber="N1", ModifiedDate=D[0]),
        ),
        "production_productsubcategory": table(
            spark, "production_productsubcategory", dict(ProductSubcategoryID=5, ProductCategoryID=6, Name="fixings", ModifiedDate=D[0])
        ),
        "production_productcategory": table(
            spark, "production_productcategory",
            dict(ProductCategoryID=6, Name="hardware", ModifiedDate=D[0]), dict(ProductCategoryID=6, Name="parts", ModifiedDate=D[1]),
        ),
        "production_productmodel": table(spark, "production_productmodel", dict(ProductModelID=3, Name="M", ModifiedDate=D[0])),
        "sales_customer": table(spark, "sales_customer", dict(CustomerID=1, ModifiedDate=D[0])),
        "sales_specialoffer": table(spark, "sales_specialoffer", dict(SpecialOfferID=1, ModifiedDate=D[0])),
        "sales_salesterritory": table(spark, "sales_salesterritory", dict(TerritoryID=1, Name="North", ModifiedDate=D[0])),
        "person_person": table(
            spark, "person_person", dict(BusinessEntityID=1, FirstName=None, LastName="L", ModifiedDate=D[0])
        ),
    }


def test_fact(tables):
    fact = star.fact_internet_sales(tables)
    got = rows(fact, "SalesOrderID", "SalesOrderDetailID", "ProductKey", "CustomerKey", "PromotionKey", "SalesTerritoryKey", "OrderQty")
    assert got == [
        ("1", 10, 1, 1, 1, 1, 2),
        ("1", 11, None, 1, None, 1, 2),
        ("3", 30, 1, 1, 1, 1, 5),
        ("4", 40, 1, None, 1, None, 2),
    ]
    assert [(f.name, f.dataType) for f in fact.schema] == [(f.name, f.dataType) for f in star.gold_schema("FactInternetSales")]
    assert fact.where("SalesOrderDetailID = 10").first().LineTotal == Decimal("19.000000")


def test_fact_columns_do_not_change_lines(tables):
    some = star.fact_internet_sales(tables, columns=["SalesOrderDetailID", "LineTotal"])
    whole = star.fact_internet_sales(tables)
    assert rows(some) == rows(whole, "SalesOrderDetailID", "LineTotal")


def test_plans_without_broadcasts(spark):
    """What a cluster does for lookups that are too large to broadcast: nothing is counted or read twice."""
    tables = sales_staged(spark, SF)
    builds = [
        lambda: star.fact_internet_sales(tables, wide=True),
        lambda: star.one_big_table(tables, wide=True),
        lambda: star.dim_product(tables, wide=True),
        lambda: star.dim_geography(tables, wide=True),
    ]
    small = [rows(build()) for build in builds]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert [rows(build()) for build in builds] == small
        plan = plan_of(builds[0]())
        view = reports.internet_sales_view(builds[0](), star.dim_product(tables, wide=True))
        moved = [line for line in plan_of(view).split("\n") if "Exchange hashpartitioning(OrderDate" in line]
        by_join = reports.internet_sales_view(builds[0](), star.dim_product(tables, wide=True), star.dim_date(tables))
        assert not moved and rows(view) == rows(by_join)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "BroadcastExchange" not in plan


def test_unique_tables_skip_deduplication(tables):
    once = {n: t.dropDuplicates([SILVER[n].keys[-1]]) if n != "sales_salesorderheader" else t for n, t in tables.items()}
    plan = star.dim_product(once, unique=set(once))._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan


def test_dim_product_repeats_for_repeated_category(tables):
    got = rows(star.dim_product(tables), "ProductKey", "ProductName", "ModelName", "SubcategoryName", "CategoryName")
    assert got == [(1, "bolt2", "M", "fixings", "hardware"), (1, "bolt2", "M", "fixings", "parts"), (2, "nut", None, None, None)]


def test_one_big_table(tables):
    got = rows(
        star.one_big_table(tables), "SalesOrderDetailID", "ProductName", "ProductCategoryName", "TerritoryName", "CustomerName", "LineTotal"
    )
    # the wide table keeps lines of zero quantity or price; the category is the latest one; no first name, no full name
    assert [r[0] for r in got] == [10, 11, 12, 13, 14, 30, 40]
    assert got[0] == (10, "bolt2", "parts", "North", None, Decimal("18.000000"))
    assert got[1][1] is None and got[-1][3] is None


def test_agg_product_day_keeps_unknown_products(tables):
    fact = star.fact_internet_sales(tables)
    got = rows(star.agg_product_day(fact, star.dim_product(tables)), "ProductID", "ProductCategoryName", "TotalOrderQty", "TotalLineTotal")
    assert got == [
        (1, "hardware", 9, Decimal("87.000000")),
        (1, "parts", 9, Decimal("87.000000")),
        (None, None, 2, Decimal("19.000000")),
    ]


def test_reports_sum_like_a_plain_join(tables):
    fact, product = star.fact_internet_sales(tables), star.dim_product(tables)
    date = star.dim_date(tables)
    plain = (
        fact.join(product.where("CategoryName IS NOT NULL"), "ProductKey")
        .groupBy("CategoryName", "ProductName").agg(F.sum("LineTotal"))
    )
    assert rows(reports.sales_by_category(fact, product)) == rows(plain)
    by_year = reports.sales_by_year(fact, product, date)
    assert [tuple(r)[:2] for r in by_year.collect()] == [(2020, "hardware"), (2020, "parts")]
    assert reports.internet_sales_view(fact, product, date).count() == 6


def test_customer_join_keys_are_parameters(spark):
    people = {
        "sales_customer": table(spark, "sales_customer", dict(CustomerID=1, PersonID=2, AccountNumber="A", ModifiedDate=D[0])),
        "person_person": table(
            spark, "person_person",
            dict(BusinessEntityID=1, FirstName="one", ModifiedDate=D[0]), dict(BusinessEntityID=2, FirstName="two", ModifiedDate=D[0]),
        ),
        "person_address": table(spark, "person_address", dict(AddressID=5, ModifiedDate=D[0])),
        "person_emailaddress": table(
            spark, "person_emailaddress",
            dict(BusinessEntityID=1, EmailAddressID=1, EmailAddress="old", ModifiedDate=D[0]),
            dict(BusinessEntityID=1, EmailAddressID=2, EmailAddress="new", ModifiedDate=D[1]),
        ),
        "person_personphone": table(spark, "person_personphone"),
    }
    columns = ("CustomerKey", "GeographyKey", "FirstName", "EmailAddress", "Phone")
    assert rows(star.dim_customer(people), *columns) == [(1, None, "one", "new", None)]
    assert rows(star.dim_customer(people, person_on="PersonID", contact_on="PersonID"), *columns) == [(1, None, "two", None, None)]


def test_racing_positions_and_winners(spark):
    results = spark.createDataFrame(
        [(1, "12"), (1, "12"), (1, "15"), (2, "\\N"), (3, "1"), (4, None), (5, "11")], "driverId bigint, position string"
    )
    pairs = racing.driver_positions(results)
    assert rows(pairs) == [(1, 12), (1, 15), (5, 11)]
    assert rows(racing.race_winners(results)) == [(3, "1")]


def test_points_multiply_like_a_plain_join(spark):
    results = spark.createDataFrame([(1, 1, 5), (1, 2, 7), (2, 1, 1), (9, 1, 1)], "driverId int, constructorId int, points int")
    drivers = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "driverId int, driverRef string")
    makers = spark.createDataFrame([(1,), (1,)], "constructorId int")
    got = racing.points_by_driver(results, drivers, makers).collect()
    assert [tuple(r) for r in got] == [("a", 10), ("b", 4)]


def test_stored_lines_move_for_deduplication_only_if_ids_repeat(spark, tables, folder):
    name, key = "sales_salesorderdetail", "SalesOrderDetailID"
    lines = latest_per_key(tables[name], key)
    again = lines.where(f"{key} IS NOT NULL").withColumns({"OrderQty": F.lit(7).cast("smallint"), "SalesOrderID": F.col("SalesOrderID") + 0})
    for kind, stored in (("once", lines), ("twice", lines.unionByName(again))):
        stored.write.parquet(f"{folder}/{kind}")
        given = {**tables, name: spark.read.parquet(f"{folder}/{kind}")}
        assert is_unique(given[name], key) == (kind == "once")
        made = star.fact_internet_sales(given, {"sales_salesorderheader"}, stored=True)
        assert (f"partition by: [{key}" in spark_plan(made) or f"windowspecdefinition({key}" in spark_plan(made)) == (kind == "twice")
        assert rows(made) == rows(star.fact_internet_sales(given, {"sales_salesorderheader"})) and made.count() > 0
    assert not is_unique(spark.createDataFrame([(1,), (None,), (None,)], "k int"), "k")
    assert is_unique(spark.createDataFrame([(1,), (None,)], "k int"), "k")


def spark_plan(df):
    return df._jdf.queryExecution().analyzed().toString()
