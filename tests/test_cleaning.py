from datetime import datetime
from decimal import Decimal

import pytest
from conftest import SF, plan_of, rows
from pyspark.errors import ArithmeticException, NumberFormatException
from pyspark.sql import functions as F

from stratalake import functions as fn
from stratalake.operators import quality
from stratalake.operators.dedup import latest_per_key
from stratalake.operators.quality import keep_valid
from stratalake.operators.schema import (
    SchemaMismatch,
    conform,
    ddl,
    exact_difference,
    positional_difference,
    require_schema,
    wide_keys,
)
from stratalake.plans import layers
from stratalake.plans.silver import clean, clean_sifted, with_optional_rules
from stratalake.plans.specs import SILVER
from stratalake.registry.landing import sales_landing
from stratalake.sources.sinks import current_path

DAY = [datetime(2020, 1, d) for d in range(1, 10)]
STAMP = datetime(2024, 1, 1)


def detail(spark, *lines):
    schema = (
        "SalesOrderID int, SalesOrderDetailID int, CarrierTrackingNumber string, OrderQty smallint, ProductID int, "
        "SpecialOfferID int, UnitPrice decimal(19,4), UnitPriceDiscount decimal(19,4), rowguid string, "
        "ModifiedDate timestamp"
    )
    full = [(o, d, None, q, 1, 1, Decimal(p), Decimal(s), g, m) for o, d, q, p, s, g, m in lines]
    return spark.createDataFrame(full, schema)


def test_latest_is_deterministic_on_ties(spark):
    data = [(1, DAY[0], "a"), (1, DAY[1], "b"), (1, DAY[1], "c"), (1, DAY[1], None), (2, None, "x"), (2, DAY[0], "y")]
    df = spark.createDataFrame(data, "k int, ModifiedDate timestamp, v string")
    for parts in (1, 3, 6):
        assert rows(latest_per_key(df.repartition(parts), "k"), "k", "v") == [(1, "c"), (2, "y")]


def test_latest_keeps_one_row_for_the_null_key(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (3, 1)], "k int, o int")
    assert rows(latest_per_key(df, "k", "o")) == [(3, 1), (None, 2)]


def test_latest_reduces_before_the_shuffle(spark):
    plan = plan_of(latest_per_key(spark.range(100).selectExpr("id % 3 AS k", "id AS o"), "k", "o"))
    assert "row_number(), 1, Partial" in plan and "row_number(), 1, Final" in plan


def test_rules_run_before_dedup(spark):
    """The latest row is invalid, so the older valid one is kept."""
    df = detail(spark, (1, 1, 5, "10", "0", "g", DAY[0]), (1, 1, 0, "10", "0", "g", DAY[1]))
    got = clean(df, SILVER["sales_salesorderdetail"], F.lit(STAMP))
    assert rows(got, "OrderQty", "ModifiedDate") == [(5, DAY[0])]


def test_fills(spark):
    df = detail(spark, (1, 1, 1, "10", "0.1", None, None), (1, 2, 1, "10", "0", "g", DAY[0]))
    spec = SILVER["sales_salesorderdetail"]
    got = clean(df, spec, F.lit(STAMP), reproducible_ids=True)
    again = clean(df.repartition(3), spec, F.lit(STAMP), reproducible_ids=True)
    assert rows(got) == rows(again)
    first, second = sorted(got.collect(), key=lambda r: r.SalesOrderDetailID)
    assert first.ModifiedDate == STAMP and len(first.rowguid) == 36
    assert second.rowguid == "g"
    random = clean(df, spec, F.lit(STAMP)).where("SalesOrderDetailID = 1").first()
    assert len(random.rowguid) == 36


def test_missing_stamp_counts_as_newest(spark):
    df = detail(spark, (1, 1, 1, "10", "0", "g", DAY[0]), (1, 1, 2, "10", "0", "h", None))
    assert rows(clean(df, SILVER["sales_salesorderdetail"], F.lit(STAMP)), "OrderQty") == [(2,)]


def test_null_operand_drops_unless_tolerated(spark):
    df = spark.createDataFrame([(1, None), (-1, 2), (2, -2), (3, 3)], "a int, b int")
    assert rows(keep_valid(df, ["a >= 0", "b >= 0"]), "a") == [(3,)]
    assert rows(keep_valid(df, ["a >= 0", "b >= 0 OR b IS NULL"]), "a") == [(1,), (3,)]
    assert keep_valid(df, []).count() == 4


def test_optional_product_rules_are_off_by_default():
    spec = SILVER["production_product"]
    assert spec.rules == () and len(with_optional_rules(spec).rules) == 10


def test_two_line_totals_differ(spark):
    df = spark.createDataFrame([(Decimal("10.0000"), Decimal("0.1000"), 3)], "p decimal(19,4), d decimal(19,4), q smallint")
    got = df.select(
        fn.line_total_silver(F.col("p"), F.col("d"), F.col("q")), fn.line_total_gold(F.col("p"), F.col("d"), F.col("q"))
    )
    assert tuple(got.first()) == (Decimal("27.000000"), Decimal("29.000000"))
    assert [f.dataType.simpleString() for f in got.schema] == ["decimal(38,6)"] * 2


def test_order_total_missing_part_is_zero(spark):
    df = spark.createDataFrame([(Decimal(1), None), (Decimal(1), Decimal(2))], "a decimal(19,4), b decimal(19,4)")
    assert rows(df.select(fn.order_total(F.col("a"), F.col("b")))) == [(Decimal("0.000000"),), (Decimal("3.000000"),)]


def test_text_values(spark):
    df = spark.createDataFrame([(7, None, "A", None), (8, "AC8", "A", "B")], "id int, acc string, f string, l string")
    got = df.select(fn.account_number(F.col("acc"), F.col("id")), fn.full_name(F.col("f"), F.col("l")))
    assert rows(got) == [("AC8", "A B"), ("AW000000007", None)]


def test_calendar_edges(spark):
    days = [datetime(2021, 1, 3), datetime(2021, 1, 4), datetime(2020, 12, 31), datetime(2018, 12, 31), datetime(2020, 7, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d timestamp")
    columns = fn.calendar_columns(F.col("d"))
    got = {r[0]: tuple(r)[1:] for r in df.select("d", *columns.values()).collect()}
    for day, values in got.items():
        iso = day.isocalendar()
        assert values[0] == iso.weekday and values[4] == iso.week
        assert values[1] == day.strftime("%A") and values[5] == day.strftime("%B")
        assert values[9] == (1 if day.month <= 6 else 2)


def test_conform_is_strict_and_try_cast_is_not(spark):
    df = spark.createDataFrame([("1",), ("\\N",), ("",)], "a string")
    with pytest.raises(NumberFormatException):
        conform(df, ddl("a int")).collect()
    assert rows(df.select(F.col("a").try_cast("int").alias("a"))) == [(1,), (None,), (None,)]
    big = spark.createDataFrame([(2**40,)], "OrderID bigint")
    with pytest.raises(ArithmeticException):
        conform(big, ddl("OrderID int")).collect()
    assert conform(big, wide_keys(ddl("OrderID int"))).first()[0] == 2**40


def test_decimal_rounding_at_the_boundary(spark):
    df = spark.createDataFrame([(Decimal("1.23455"), Decimal("0.1234565"))], "a decimal(19,5), b decimal(19,7)")
    assert tuple(conform(df, ddl("a decimal(19,4), b decimal(38,6)")).first()) == (Decimal("1.2346"), Decimal("0.123457"))


def test_schema_checks(spark):
    declared = ddl("a int, b decimal(19,4)")

    def empty(text):
        return spark.createDataFrame([], text)

    assert positional_difference(empty("a int, b decimal(10,2)"), declared) is None
    assert "b" in exact_difference(empty("a int, b decimal(10,2)"), declared)
    swapped = empty("b decimal(19,4), a int")
    assert positional_difference(swapped, declared) and exact_difference(swapped, declared) is None
    extra = empty("a int, b decimal(19,4), c int")
    assert positional_difference(extra, declared) and exact_difference(extra, declared) is None
    assert exact_difference(empty("a int"), declared)
    with pytest.raises(SchemaMismatch, match="orders"):
        require_schema(swapped, declared, table="orders")


def test_every_spec_cleans_empty_input(spark):
    for spec in SILVER.values():
        got = clean(spark.createDataFrame([], spec.schema), spec)
        assert got.schema.names == spec.schema.names and set(spec.keys) <= set(spec.schema.names)
    assert got.count() == 0


def test_refused_rows_and_counts_come_from_one_pass(spark, folder):
    df = spark.createDataFrame([(1, 5, "x"), (2, -5, "y"), (3, None, "x"), (4, 5, None), (5, -1, None)], "k int, n int, t string")
    rules = {"positive": "n > 0", "known": F.col("t").isin("x", "y")}
    counts = quality.sift(df, rules, f"{folder}/sifted")
    assert counts == {"rows": 5, "kept": 1, "refused": 4, "positive": 3, "known": 2}
    assert rows(quality.kept_rows(df, f"{folder}/sifted")) == [(1, 5, "x")]
    refused = quality.refused_rows(df, f"{folder}/sifted")
    assert {r.k: r[quality.BROKEN] for r in refused.collect()} == {2: ["positive"], 3: ["positive"], 4: ["known"], 5: ["positive", "known"]}
    assert rows(quality.kept_rows(df, f"{folder}/sifted")) == rows(quality.keep_valid(df, rules.values()))
    assert quality.sift(df, [], f"{folder}/all") == {"rows": 5, "kept": 5, "refused": 0}
    assert quality.sift(df.limit(0), ["n > 0"], f"{folder}/none")["rows"] == 0 and quality.refused_rows(df, f"{folder}/none").count() == 0


def test_sifted_silver_is_the_same_silver(spark, folder):
    landing = sales_landing(spark, SF)
    spec = SILVER["sales_specialoffer"]
    moment = F.lit(STAMP).cast("timestamp")
    silver, refused, counts = clean_sifted(landing[spec.name], spec, f"{folder}/s", moment, reproducible_ids=True, wide=True)
    assert rows(silver) == rows(clean(landing[spec.name], spec, moment, reproducible_ids=True, wide=True))
    assert refused.count() == counts["refused"] > 0 and counts["rows"] == landing[spec.name].count()


def test_silver_layer_with_refused_rows(spark, folder):
    landing = sales_landing(spark, SF)
    for name in landing:
        landing[name].write.parquet(f"{folder}/landing/{name}.parquet")
    layers.ingest_parquet(spark, {name: f"{folder}/landing/{name}.parquet" for name in landing}, f"{folder}/bronze", stamp_column=None)
    counts = layers.build_silver_sifted(spark, f"{folder}/bronze", f"{folder}/silver", f"{folder}/refused", F.lit(STAMP).cast("timestamp"), True, True)
    assert set(counts) == set(SILVER) and all(c["rows"] == c["kept"] + c["refused"] for c in counts.values())
    published = spark.read.parquet(current_path(spark, f"{folder}/refused/sales_salesorderheader"))
    assert published.count() == counts["sales_salesorderheader"]["refused"] > 0 and quality.BROKEN in published.columns
