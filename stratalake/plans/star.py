"""Gold layer: dimensions, internet sales fact, wide table and daily aggregate.

Functions take a mapping of silver tables by name. ``unique`` names the tables known to be
unique on the key used here (published silver tables are); those skip deduplication, which
saves a shuffle each. Dimensions that hang off the order header join it at order grain, so
only the product and offer lookups move order lines.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratalake.functions.calendar import calendar_columns
from stratalake.functions.money import line_total_gold
from stratalake.functions.values import full_name
from stratalake.operators.dedup import is_unique, latest_per_key
from stratalake.operators.joins import lookup_join, sized
from stratalake.operators.schema import conform, ddl, exact_difference, require_schema, wide_keys

Tables = Mapping[str, DataFrame]

# Gold table schemas.
GOLD_SCHEMAS = {
    "DimCurrency": "CurrencyKey string, CurrencyAlternateKey string, CurrencyName string",
    "DimCustomer": "CustomerKey int, GeographyKey int, CustomerAlternateKey string, Title string, "
    "FirstName string, MiddleName string, LastName string, NameStyle int, EmailAddress string, Phone string",
    "DimDate": "DateKey timestamp, FullDateAlternateKey timestamp, DayNumberOfWeek int, "
    "EnglishDayNameOfWeek string, DayNumberOfMonth int, DayNumberOfYear int, WeekNumberOfYear int, "
    "EnglishMonthName string, MonthNumberOfYear int, CalendarQuarter int, CalendarYear int, "
    "CalendarSemester int",
    "DimGeography": "GeographyKey int, City string, StateProvince string, CountryRegion string, PostalCode string",
    "DimProduct": "ProductKey int, ProductAlternateKey string, ProductName string, ModelName string, "
    "SubcategoryName string, CategoryName string, ProductSubcategoryKey int, ProductCategoryKey int",
    "DimPromotion": "PromotionKey int, PromotionAlternateKey int, EnglishPromotionName string, "
    "DiscountPct decimal(10,4), EnglishPromotionType string, StartDate timestamp, EndDate timestamp, MinQty int",
    "DimSalesReason": "SalesReasonKey int, SalesReasonName string, SalesReasonType string",
    "DimSalesTerritory": "SalesTerritoryKey int, SalesTerritoryAlternateKey int, SalesTerritoryRegion string, "
    "SalesTerritoryCountry string, SalesTerritoryGroup string",
    "FactInternetSales": "ProductKey int, OrderDateKey timestamp, DueDateKey timestamp, ShipDateKey timestamp, "
    "CustomerKey int, PromotionKey int, SalesTerritoryKey int, SalesOrderID string, SalesOrderDetailID int, "
    "RevisionNumber smallint, OrderQty int, UnitPrice decimal(19,4), UnitPriceDiscount decimal(19,4), "
    "LineTotal decimal(38,6)",
    "ft_agg_product_day": "ProductID int, OrderDate date, ProductName string, ProductCategoryName string, "
    "ProductSubcategoryName string, TotalOrderQty bigint, TotalLineTotal decimal(38,6)",
    "OneBigTable": "SalesOrderID int, SalesOrderDetailID int, OrderDate timestamp, DueDate timestamp, "
    "SubTotal decimal(19,4), TaxAmt decimal(19,4), Freight decimal(19,4), TotalDue decimal(38,6), "
    "LineTotal decimal(38,6), OrderQty int, UnitPrice decimal(19,4), UnitPriceDiscount decimal(19,4), "
    "ProductName string, ProductNumber string, ProductCategoryName string, ProductSubcategoryName string, "
    "TerritoryName string, CustomerName string",
}

# Source table, key and column renames of the dimensions that only rename.
_RENAMED = {
    "DimCurrency": (
        "sales_currency",
        "CurrencyCode",
        {"CurrencyKey": "CurrencyCode", "CurrencyAlternateKey": "CurrencyCode", "CurrencyName": "Name"},
    ),
    "DimPromotion": (
        "sales_specialoffer",
        "SpecialOfferID",
        {
            "PromotionKey": "SpecialOfferID",
            "PromotionAlternateKey": "SpecialOfferID",
            "EnglishPromotionName": "Description",
            "DiscountPct": "DiscountPct",
            "EnglishPromotionType": "Type",
            "StartDate": "StartDate",
            "EndDate": "EndDate",
            "MinQty": "MinQty",
        },
    ),
    "DimSalesReason": (
        "sales_salesreason",
        "SalesReasonID",
        {"SalesReasonKey": "SalesReasonID", "SalesReasonName": "Name", "SalesReasonType": "ReasonType"},
    ),
    "DimSalesTerritory": (
        "sales_salesterritory",
        "TerritoryID",
        {
            "SalesTerritoryKey": "TerritoryID",
            "SalesTerritoryAlternateKey": "TerritoryID",
            "SalesTerritoryRegion": "Name",
            "SalesTerritoryCountry": "CountryRegionCode",
            "SalesTerritoryGroup": "Group",
        },
    ),
}


def gold_schema(name: str, wide: bool = False) -> StructType:
    schema = ddl(GOLD_SCHEMAS[name])
    return wide_keys(schema) if wide else schema


def _finish(df: DataFrame, name: str, wide: bool) -> DataFrame:
    schema = gold_schema(name, wide)
    return require_schema(conform(df, schema), schema, exact_difference, name)


def _latest(tables: Tables, name: str, key: str, columns: list[str], unique: Collection[str]) -> DataFrame:
    """The wanted columns of the latest row per key; only those columns are shuffled."""
    columns = list(dict.fromkeys([key, *columns]))
    table = tables[name]
    if name in unique:
        return table.select(columns)
    return latest_per_key(table.select([*columns, "ModifiedDate"]), key).select(columns)


def _known(tables: Tables, name: str, key: str, alias: str, unique: Collection[str]) -> DataFrame:
    """The existing keys of a table. Which row is the latest does not matter for existence."""
    keys = tables[name].select(F.col(key).alias(alias))
    return keys if name in unique else keys.distinct()


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[f"{prefix}{c}" for c in df.columns])


def renamed_dimension(tables: Tables, name: str, unique: Collection[str] = (), wide: bool = False) -> DataFrame:
    source, key, columns = _RENAMED[name]
    rows = _latest(tables, source, key, list(columns.values()), unique)
    return _finish(rows.select([F.col(f"`{old}`").alias(new) for new, old in columns.items()]), name, wide)


def dim_customer(
    tables: Tables,
    unique: Collection[str] = (),
    wide: bool = False,
    person_on: str = "CustomerID",
    address_on: str = "CustomerID",
    contact_on: str = "CustomerID",
) -> DataFrame:
    """Customers with their person, address, e-mail and phone.

    All four lookups use the customer id by default, as existing reports expect; the ``..._on``
    arguments name another customer column. All sides meet on one key, so the shuffle of
    each deduplication also serves its join.
    """
    def contact(name: str, column: str) -> DataFrame:
        # silver is unique on a longer key here, so this always needs the latest row
        return _prefixed(_latest(tables, name, "BusinessEntityID", [column], ()), f"{column}_")

    customer = tables["sales_customer"].select(
        *dict.fromkeys(["CustomerID", "AccountNumber", person_on, address_on, contact_on])
    )
    person = _prefixed(
        _latest(
            tables,
            "person_person",
            "BusinessEntityID",
            ["Title", "FirstName", "MiddleName", "LastName", "NameStyle"],
            unique,
        ),
        "p_",
    )
    address = _known(tables, "person_address", "AddressID", "GeographyKey", unique)
    email = contact("person_emailaddress", "EmailAddress")
    phone = contact("person_personphone", "PhoneNumber")
    joined = (
        customer.join(person, F.col(person_on) == F.col("p_BusinessEntityID"), "inner")
        .join(address, F.col(address_on) == F.col("GeographyKey"), "left")
        .join(email, F.col(contact_on) == F.col("EmailAddress_BusinessEntityID"), "left")
        .join(phone, F.col(contact_on) == F.col("PhoneNumber_BusinessEntityID"), "left")
    )
    rows = joined.select(
        F.col("CustomerID").alias("CustomerKey"),
        "GeographyKey",
        F.col("AccountNumber").alias("CustomerAlternateKey"),
        F.col("p_Title").alias("Title"),
        F.col("p_FirstName").alias("FirstName"),
        F.col("p_MiddleName").alias("MiddleName"),
        F.col("p_LastName").alias("LastName"),
        F.col("p_NameStyle").alias("NameStyle"),
        F.col("EmailAddress_EmailAddress").alias("EmailAddress"),
        F.col("PhoneNumber_PhoneNumber").alias("Phone"),
    )
    return _finish(rows, "DimCustomer", wide)


def dim_date(tables: Tables) -> DataFrame:
    """One row per order time that occurs; attributes are computed after the distinct."""
    days = tables["sales_salesorderheader"].select(F.col("OrderDate").cast("timestamp").alias("DateKey")).distinct()
    return _finish(days.withColumns(date_attributes("DateKey")), "DimDate", False)


def date_attributes(moment: str) -> dict[str, Column]:
    """Columns of the date dimension as functions of its key, so that rows which hold the key need no join."""
    return {"FullDateAlternateKey": F.col(moment), **calendar_columns(F.col(moment))}


def dim_geography(tables: Tables, unique: Collection[str] = (), wide: bool = False) -> DataFrame:
    """Addresses with state and country; an address without either is left out."""
    states = _prefixed(
        _latest(tables, "person_stateprovince", "StateProvinceID", ["Name", "CountryRegionCode"], unique), "s_"
    )
    countries = _prefixed(_latest(tables, "person_countryregion", "CountryRegionCode", ["Name"], unique), "c_")
    places = states.join(countries, F.col("s_CountryRegionCode") == F.col("c_CountryRegionCode"), "inner")
    address = _latest(tables, "person_address", "AddressID", ["City", "PostalCode", "StateProvinceID"], unique)
    located = lookup_join(address, places, "StateProvinceID", "s_StateProvinceID", "inner")
    rows = located.select(
        F.col("AddressID").alias("GeographyKey"),
        "City",
        F.col("s_Name").alias("StateProvince"),
        F.col("c_Name").alias("CountryRegion"),
        "PostalCode",
    )
    return _finish(rows, "DimGeography", wide)


def _with_hierarchy(
    product: DataFrame, tables: Tables, unique: Collection[str], unique_category: bool
) -> DataFrame:
    """Products with subcategory and category columns ``s_...`` and ``c_...``."""
    subcategory = _prefixed(
        _latest(tables, "production_productsubcategory", "ProductSubcategoryID", ["Name", "ProductCategoryID"], unique),
        "s_",
    )
    if unique_category:
        category = _latest(tables, "production_productcategory", "ProductCategoryID", ["Name"], unique)
    else:
        category = tables["production_productcategory"].select("ProductCategoryID", "Name")
    rows = lookup_join(product, subcategory, "ProductSubcategoryID", "s_ProductSubcategoryID")
    return lookup_join(rows, _prefixed(category, "c_"), "s_ProductCategoryID", "c_ProductCategoryID")


def dim_product(tables: Tables, unique: Collection[str] = (), wide: bool = False) -> DataFrame:
    """Products with model, subcategory and category names.

    Categories are not deduplicated: a category stored twice repeats its products.
    """
    product = _latest(
        tables,
        "production_product",
        "ProductID",
        ["ProductNumber", "Name", "ProductSubcategoryID", "ProductModelID"],
        unique,
    )
    model = _prefixed(_latest(tables, "production_productmodel", "ProductModelID", ["Name"], unique), "m_")
    joined = lookup_join(product, model, "ProductModelID", "m_ProductModelID")
    joined = _with_hierarchy(joined, tables, unique, unique_category=False)
    rows = joined.select(
        F.col("ProductID").alias("ProductKey"),
        F.col("ProductNumber").alias("ProductAlternateKey"),
        F.col("Name").alias("ProductName"),
        F.col("m_Name").alias("ModelName"),
        F.col("s_Name").alias("SubcategoryName"),
        F.col("c_Name").alias("CategoryName"),
        F.col("s_ProductSubcategoryID").alias("ProductSubcategoryKey"),
        F.col("s_ProductCategoryID").alias("ProductCategoryKey"),
    )
    return _finish(rows, "DimProduct", wide)


# Read in this order everywhere: equal modification times are settled left to right, and fact
# and wide table must settle them alike.
_HEADER_COLUMNS = ["RevisionNumber", "OnlineOrderFlag", "OrderDate", "DueDate", "CustomerID", "TerritoryID"]
_LINE_COLUMNS = ["SalesOrderID", "ProductID", "SpecialOfferID", "OrderQty", "UnitPrice", "UnitPriceDiscount"]


def _online_headers(tables: Tables, extra: list[str], unique: Collection[str]) -> DataFrame:
    """Orders whose LATEST row is an online order: deduplicate first, then filter."""
    latest = _latest(tables, "sales_salesorderheader", "SalesOrderID", [*_HEADER_COLUMNS, *extra], unique)
    online = latest.where(F.col("OnlineOrderFlag") == 1).drop("OnlineOrderFlag")
    return online.withColumnRenamed("SalesOrderID", "OrderKey")


def _lines(tables: Tables, extra: list[str], unique: Collection[str], by_order: bool = False) -> DataFrame:
    # deduplicated on the line id alone, a shorter key than silver's, hence never in `unique`
    # unless the caller knows line ids to be unique across orders
    columns = [*_LINE_COLUMNS, *extra]
    if by_order and "sales_salesorderdetail" not in unique:
        wanted = tables["sales_salesorderdetail"].select("SalesOrderDetailID", *columns, "ModifiedDate")
        return latest_per_key(wanted, ["SalesOrderID", "SalesOrderDetailID"]).drop("ModifiedDate")
    return _latest(tables, "sales_salesorderdetail", "SalesOrderDetailID", columns, unique)


def fact_internet_sales(
    tables: Tables,
    unique: Collection[str] = (),
    wide: bool = False,
    columns: Sequence[str] | None = None,
    by_order: bool = False,
    stored: bool = False,
) -> DataFrame:
    """Order lines of online orders with their dimension keys (NULL when a dimension row is missing).

    A key lookup never adds or drops a line, so with ``columns`` only the lookups behind
    the requested columns run. ``by_order`` says that a line id belongs to one order: lines are then
    deduplicated within their order, so tables bucketed by the order id (``sources.buckets``) meet without a shuffle.
    ``stored`` says that the tables are files: jobs run beforehand tell whether line ids repeat, so that lines have to move for
    it, and which keys are few enough to send to all.
    """
    if stored and is_unique(tables["sales_salesorderdetail"], "SalesOrderDetailID"):
        unique = {*unique, "sales_salesorderdetail"}
    schema = gold_schema("FactInternetSales", wide)
    if columns is not None:
        schema = StructType([schema[c] for c in columns])

    def keyed(rows: DataFrame, table: str, key: str, alias: str) -> DataFrame:
        if alias not in schema.names:
            return rows
        known = _known(tables, table, key, alias, unique)
        return lookup_join(rows, sized(known) if stored else known, key, alias)

    online = _online_headers(tables, ["ShipDate"], unique)
    orders = keyed(online, "sales_customer", "CustomerID", "CustomerKey")
    orders = keyed(orders, "sales_salesterritory", "TerritoryID", "SalesTerritoryKey")
    lines = _lines(tables, [], unique, by_order).where((F.col("OrderQty") > 0) & (F.col("UnitPrice") > 0))
    sales = lookup_join(lines, orders, "SalesOrderID", "OrderKey", "inner")
    sales = keyed(sales, "production_product", "ProductID", "ProductKey")
    sales = keyed(sales, "sales_specialoffer", "SpecialOfferID", "PromotionKey")
    rows = sales.withColumnsRenamed(
        {"OrderDate": "OrderDateKey", "DueDate": "DueDateKey", "ShipDate": "ShipDateKey"}
    ).withColumn(
        "LineTotal", line_total_gold(F.col("UnitPrice"), F.col("UnitPriceDiscount"), F.col("OrderQty"))
    )
    return require_schema(conform(rows, schema), schema, exact_difference, "FactInternetSales")


def one_big_table(
    tables: Tables, unique: Collection[str] = (), wide: bool = False, person_on: str = "CustomerID"
) -> DataFrame:
    """Online order lines with order amounts, product names, territory and customer name."""
    online = _online_headers(tables, ["SubTotal", "TaxAmt", "Freight", "TotalDue", person_on], unique)
    territory = _prefixed(_latest(tables, "sales_salesterritory", "TerritoryID", ["Name"], unique), "t_")
    person = _prefixed(_latest(tables, "person_person", "BusinessEntityID", ["FirstName", "LastName"], unique), "p_")
    orders = lookup_join(online, territory, "TerritoryID", "t_TerritoryID")
    orders = lookup_join(orders, person, person_on, "p_BusinessEntityID")
    product = _latest(
        tables, "production_product", "ProductID", ["Name", "ProductNumber", "ProductSubcategoryID"], unique
    )
    named = _with_hierarchy(product, tables, unique, unique_category=True).withColumnRenamed("ProductID", "ProductKey")
    lines = _lines(tables, ["LineTotal"], unique)
    sales = lookup_join(lines, orders, "SalesOrderID", "OrderKey", "inner")
    sales = lookup_join(sales, named, "ProductID", "ProductKey")
    rows = sales.withColumns(
        {
            "ProductName": F.col("Name"),
            "ProductCategoryName": F.col("c_Name"),
            "ProductSubcategoryName": F.col("s_Name"),
            "TerritoryName": F.col("t_Name"),
            "CustomerName": full_name(F.col("p_FirstName"), F.col("p_LastName")),
        }
    )
    return _finish(rows, "OneBigTable", wide)


def agg_product_day(fact: DataFrame, product: DataFrame, wide: bool = False) -> DataFrame:
    """Quantity and amount per product and day.

    Lines are summed per product and day before the product lookup, so a product that
    holds a third of the lines reaches the join as one row per day. The final grouping
    keeps a product listed several times apart by its names.
    """
    daily = fact.groupBy(
        F.col("ProductKey").alias("ProductID"), F.to_date("OrderDateKey").alias("OrderDate")
    ).agg(F.sum("OrderQty").alias("qty"), F.sum("LineTotal").alias("amount"))
    return named_days(daily, product, wide)


def named_days(daily: DataFrame, product: DataFrame, wide: bool = False) -> DataFrame:
    """The daily aggregate of ``daily`` (ProductID, OrderDate, qty, amount) with the products' names."""
    names = product.select(
        F.col("ProductKey"),
        "ProductName",
        F.col("CategoryName").alias("ProductCategoryName"),
        F.col("SubcategoryName").alias("ProductSubcategoryName"),
    )
    rows = (
        daily.join(names, F.col("ProductID") == F.col("ProductKey"), "left")
        .groupBy("ProductID", "OrderDate", "ProductName", "ProductCategoryName", "ProductSubcategoryName")
        .agg(
            F.sum("qty").cast("bigint").alias("TotalOrderQty"),
            F.sum("amount").cast("decimal(38,6)").alias("TotalLineTotal"),
        )
    )
    return _finish(rows, "ft_agg_product_day", wide)
