"""The sales and racing source tables, derived by Spark from the TPC-H-like test tables.

Each entry is plain SQL that Spark and DuckDB both run; ``{orders}`` and the like stand for
the test tables. All rows of the test tables are used. Open orders get
a second, later header revision, some values break the integrity rules on purpose, and e-mail, phone,
currency and reason tables repeat their keys so that deduplication has work to do.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from stratalake.plans.specs import SILVER

STAMP = "2024-01-01 00:00:00"

_HEADER = """
SELECT o_orderkey AS SalesOrderID, CAST({revision} AS SMALLINT) AS RevisionNumber,
  o_orderdate AS OrderDate, o_orderdate + INTERVAL 12 DAY AS DueDate,
  CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_orderdate + INTERVAL 7 DAY END AS ShipDate,
  CAST(CASE WHEN o_orderkey % 23 = 0 THEN 9 WHEN o_orderstatus = 'O' THEN 1 WHEN o_orderstatus = 'P' THEN 5
    ELSE 8 END AS SMALLINT) AS Status,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN {online} ELSE {offline} END AS OnlineOrderFlag,
  'SO' || CAST(o_orderkey AS STRING) AS SalesOrderNumber, CAST(NULL AS STRING) AS PurchaseOrderNumber,
  'A' || CAST(o_custkey AS STRING) AS AccountNumber, o_custkey AS CustomerID,
  CASE WHEN o_orderkey % 3 = 0 THEN o_custkey % 17 END AS SalesPersonID,
  o_custkey % 27 AS TerritoryID, o_custkey AS BillToAddressID, o_custkey AS ShipToAddressID,
  1 + o_orderkey % 5 AS ShipMethodID, CAST(NULL AS BIGINT) AS CreditCardID,
  CAST(NULL AS STRING) AS CreditCardApprovalCode, CAST(NULL AS BIGINT) AS CurrencyRateID,
  CAST(o_totalprice AS DECIMAL(19,4)) AS SubTotal,
  CAST(CAST(o_totalprice AS DECIMAL(19,4)) * 0.08 AS DECIMAL(19,4)) AS TaxAmt,
  CAST(CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN -1 ELSE o_custkey % 50 END
    AS DECIMAL(19,4)) AS Freight,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE md5('soh' || CAST(o_orderkey AS STRING)) END AS rowguid,
  {modified} AS ModifiedDate
FROM {{orders}}
"""

SALES = {
    "person_address": """
SELECT c_custkey AS AddressID, c_name || ' street' AS AddressLine1, CAST(NULL AS STRING) AS AddressLine2,
  'City ' || CAST(c_custkey % 100 AS STRING) AS City, CAST(c_nationkey + 1 AS BIGINT) AS StateProvinceID,
  lpad(CAST(c_custkey % 100000 AS STRING), 5, '0') AS PostalCode,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE md5('adr' || CAST(c_custkey AS STRING)) END AS rowguid,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE TIMESTAMP '2019-05-01 00:00:00' END AS ModifiedDate
FROM {customer}""",
    "person_countryregion": """
SELECT 'C' || CAST(r_regionkey AS STRING) AS CountryRegionCode, r_name AS Name,
  TIMESTAMP '2019-01-01 00:00:00' AS ModifiedDate
FROM {region}""",
    "person_emailaddress": """
SELECT o_custkey AS BusinessEntityID, o_orderkey % 3 AS EmailAddressID,
  'u' || CAST(o_custkey AS STRING) || '.' || CAST(o_orderkey % 7 AS STRING) || '@example.org' AS EmailAddress,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE md5('eml' || CAST(o_orderkey AS STRING)) END AS rowguid,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderdate END AS ModifiedDate
FROM {orders}""",
    "person_person": """
SELECT c_custkey AS BusinessEntityID,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'IN' WHEN 'AUTOMOBILE' THEN 'SC' WHEN 'MACHINERY' THEN 'XX'
    WHEN 'HOUSEHOLD' THEN 'EM' ELSE 'GC' END AS PersonType,
  0 AS NameStyle, CASE WHEN c_custkey % 3 = 0 THEN 'Dr.' END AS Title,
  CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE 'First' || CAST(c_custkey AS STRING) END AS FirstName,
  CAST(NULL AS STRING) AS MiddleName, c_mktsegment AS LastName, CAST(NULL AS STRING) AS Suffix,
  CAST(c_nationkey % 4 AS INT) AS EmailPromotion, CAST(NULL AS STRING) AS AdditionalContactInfo,
  '<d>' || CAST(c_nationkey AS STRING) || '</d>' AS Demographics,
  md5('per' || CAST(c_custkey AS STRING)) AS rowguid,
  TIMESTAMP '2018-03-01 00:00:00' AS ModifiedDate
FROM {customer}""",
    "person_personphone": """
SELECT o_custkey AS BusinessEntityID, '555-010' || CAST(o_orderkey % 7 AS STRING) AS PhoneNumber,
  1 + o_orderkey % 3 AS PhoneNumberTypeID, o_orderdate AS ModifiedDate
FROM {orders}""",
    "person_stateprovince": """
SELECT CAST(n_nationkey + 1 AS BIGINT) AS StateProvinceID, 'S' || CAST(n_nationkey AS STRING) AS StateProvinceCode,
  CASE WHEN n_nationkey % 9 = 8 THEN 'C9' ELSE 'C' || CAST(n_regionkey AS STRING) END AS CountryRegionCode,
  n_nationkey % 2 = 0 AS IsOnlyStateProvinceFlag, n_name AS Name, CAST(n_nationkey AS BIGINT) AS TerritoryID,
  CAST(NULL AS STRING) AS rowguid, TIMESTAMP '2019-01-01 00:00:00' AS ModifiedDate
FROM {nation}""",
    "production_product": """
SELECT p_partkey AS ProductID, p_name AS Name, 'PN-' || CAST(p_partkey AS STRING) AS ProductNumber,
  p_size % 2 = 0 AS MakeFlag, p_size % 3 = 0 AS FinishedGoodsFlag,
  CASE WHEN p_size % 4 = 0 THEN NULL ELSE substr(p_name, 1, 4) END AS Color,
  CAST(p_size * 10 AS SMALLINT) AS SafetyStockLevel, CAST(p_size AS SMALLINT) AS ReorderPoint,
  CAST(CAST(p_retailprice AS DECIMAL(19,4)) * 0.5 AS DECIMAL(19,4)) AS StandardCost,
  CAST(p_retailprice AS DECIMAL(19,4)) AS ListPrice, CAST(p_size AS STRING) AS Size,
  'CM' AS SizeUnitMeasureCode, 'G' AS WeightUnitMeasureCode,
  CAST(p_size * 1.25 AS DECIMAL(8,2)) AS Weight, p_size % 5 AS DaysToManufacture,
  CASE WHEN p_size % 7 = 0 THEN NULL ELSE 'R' END AS ProductLine, 'H' AS Class, CAST(NULL AS STRING) AS Style,
  CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE CAST(substr(p_brand, 7, 3) AS BIGINT) END AS ProductSubcategoryID,
  CAST(p_size AS BIGINT) AS ProductModelID, TIMESTAMP '1994-01-01 00:00:00' AS SellStartDate,
  CASE WHEN p_size % 6 = 0 THEN TIMESTAMP '2002-01-01 00:00:00' END AS SellEndDate,
  CAST(NULL AS TIMESTAMP) AS DiscontinuedDate,
  CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE md5('prd' || CAST(p_partkey AS STRING)) END AS rowguid,
  TIMESTAMP '2019-01-01 00:00:00' AS ModifiedDate
FROM {part}""",
    "production_productcategory": """
SELECT DISTINCT CAST(CASE p_type WHEN 'ECONOMY' THEN 0 WHEN 'LARGE' THEN 1 WHEN 'MEDIUM' THEN 2
    WHEN 'PROMO' THEN 3 WHEN 'SMALL' THEN 4 ELSE 5 END AS BIGINT) AS ProductCategoryID, p_type AS Name,
  CAST(NULL AS STRING) AS rowguid, TIMESTAMP '2019-01-01 00:00:00' AS ModifiedDate
FROM {part}""",
    "production_productdescription": """
SELECT p_partkey AS ProductDescriptionID, p_name || ' by ' || p_brand AS Description,
  CAST(NULL AS STRING) AS rowguid, TIMESTAMP '2019-01-01 00:00:00' AS ModifiedDate
FROM {part}""",
    "production_productmodel": """
SELECT CAST(p_size AS BIGINT) AS ProductModelID, 'Model ' || CAST(p_size AS STRING) AS Name,
  CAST(NULL AS STRING) AS CatalogDescription, p_name AS Instructions,
  md5('mod' || CAST(p_partkey AS STRING)) AS rowguid,
  CASE WHEN p_partkey % 2 = 0 THEN TIMESTAMP '2019-01-01 00:00:00' ELSE TIMESTAMP '2020-01-01 00:00:00' END
    AS ModifiedDate
FROM {part}""",
    "production_productsubcategory": """
SELECT CAST(substr(p_brand, 7, 3) AS BIGINT) AS ProductSubcategoryID,
  CAST(substr(p_brand, 7, 3) AS BIGINT) % 7 AS ProductCategoryID, p_brand AS Name,
  md5('sub' || CAST(p_partkey AS STRING)) AS rowguid, TIMESTAMP '2019-01-01 00:00:00' AS ModifiedDate
FROM {part}""",
    "sales_currency": """
SELECT substr(c_mktsegment, 1, 3) AS CurrencyCode, c_mktsegment || ' ' || CAST(c_nationkey AS STRING) AS Name,
  CASE WHEN c_custkey % 2 = 0 THEN TIMESTAMP '2019-01-01 00:00:00' ELSE TIMESTAMP '2020-01-01 00:00:00' END
    AS ModifiedDate
FROM {customer}""",
    "sales_customer": """
SELECT c_custkey AS CustomerID, c_custkey AS PersonID, CAST(NULL AS BIGINT) AS StoreID,
  CAST(c_nationkey AS BIGINT) AS TerritoryID,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'AC' || CAST(c_custkey AS STRING) END AS AccountNumber,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE md5('cus' || CAST(c_custkey AS STRING)) END AS rowguid,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE TIMESTAMP '2019-05-01 00:00:00' END AS ModifiedDate
FROM {customer}""",
    "sales_salesorderdetail": """
SELECT l_orderkey AS SalesOrderID, l_orderkey * 8 + l_linenumber AS SalesOrderDetailID,
  l_returnflag || '-' || l_linestatus AS CarrierTrackingNumber,
  CAST(CASE WHEN l_quantity = 50 THEN 0 ELSE l_quantity END AS SMALLINT) AS OrderQty,
  CASE WHEN l_partkey % 97 = 0 THEN -1 ELSE l_partkey END AS ProductID, l_suppkey AS SpecialOfferID,
  CAST(l_extendedprice AS DECIMAL(19,4)) AS UnitPrice, CAST(l_discount AS DECIMAL(19,4)) AS UnitPriceDiscount,
  CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE md5('sod' || CAST(l_partkey AS STRING)) END AS rowguid,
  l_shipdate AS ModifiedDate
FROM {lineitem}""",
    "sales_salesorderheader": "\nUNION ALL\n".join(
        [
            _HEADER.format(revision="1", online="1", offline="0", modified="o_orderdate"),
            _HEADER.format(revision="2", online="0", offline="1", modified="o_orderdate + INTERVAL 30 DAY")
            + "WHERE o_orderstatus = 'P'",
        ]
    ),
    "sales_salesreason": """
SELECT CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4
    ELSE 5 END AS BIGINT) AS SalesReasonID, event_type AS Name,
  'Reason ' || CAST(user_id % 10 AS STRING) AS ReasonType, ts AS ModifiedDate
FROM {events}""",
    "sales_salesterritory": """
SELECT CAST(n_nationkey AS BIGINT) AS TerritoryID, n_name AS Name,
  'C' || CAST(n_regionkey AS STRING) AS CountryRegionCode, r_name AS TerritoryGroup,
  CAST(n_nationkey * 1000.5 AS DECIMAL(19,4)) AS SalesYTD, CAST(n_nationkey * 900.25 AS DECIMAL(19,4)) AS SalesLastYear,
  CAST(CASE WHEN n_nationkey = 7 THEN -1 WHEN n_nationkey = 8 THEN NULL ELSE 0 END AS DECIMAL(19,4)) AS CostYTD,
  CAST(0 AS DECIMAL(19,4)) AS CostLastYear, CAST(NULL AS STRING) AS rowguid,
  TIMESTAMP '2019-01-01 00:00:00' AS ModifiedDate
FROM {nation} AS n JOIN {region} AS r ON n_regionkey = r_regionkey""",
    "sales_specialoffer": """
SELECT s_suppkey AS SpecialOfferID, s_name || ' offer' AS Description,
  CAST((s_suppkey % 30) * 0.01 AS DECIMAL(10,4)) AS DiscountPct,
  CASE WHEN s_nationkey % 2 = 0 THEN 'Volume' ELSE 'Seasonal' END AS Type, 'Reseller' AS Category,
  TIMESTAMP '1996-06-01 00:00:00' AS StartDate,
  CASE WHEN s_suppkey % 13 = 0 THEN TIMESTAMP '1996-01-01 00:00:00' ELSE TIMESTAMP '2001-12-31 00:00:00' END AS EndDate,
  s_nationkey - 2 AS MinQty,
  CASE WHEN s_suppkey % 3 = 0 THEN NULL WHEN s_suppkey % 7 = 0 THEN -5 ELSE s_nationkey END AS MaxQty,
  CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE md5('off' || CAST(s_suppkey AS STRING)) END AS rowguid,
  TIMESTAMP '2019-01-01 00:00:00' AS ModifiedDate
FROM {supplier}""",
}

# chr(92) || 'N' is the text \N that marks a missing value in the racing files
RACING = {
    "results": """
SELECT l_orderkey * 8 + l_linenumber AS resultId, l_orderkey AS raceId, l_partkey AS driverId,
  CASE WHEN l_suppkey % 5 = 0 THEN l_suppkey + 100000000000 ELSE l_suppkey END AS constructorId,
  CAST(l_tax * 100 AS INT) AS number, l_linenumber AS grid,
  CASE WHEN l_returnflag = 'R' THEN chr(92) || 'N' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS position,
  CASE WHEN l_returnflag = 'R' THEN 'R' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS positionText,
  CAST(l_linenumber AS STRING) AS positionOrder, CAST(l_quantity AS DECIMAL(19,4)) AS points,
  CAST(l_quantity AS INT) AS laps, l_linestatus AS time, CAST(l_extendedprice AS DECIMAL(19,4)) AS milliseconds,
  l_linenumber AS fastestLap,
  CASE WHEN l_linestatus = 'F' THEN chr(92) || 'N' ELSE CAST(l_linenumber AS STRING) END AS rank,
  l_linestatus AS fastestLapTime, CAST(l_quantity AS STRING) AS fastestLapSpeed,
  l_shipdate AS bronze_ingestion
FROM {lineitem}""",
    "races": """
SELECT o_orderkey AS raceId, CAST(extract(year FROM o_orderdate) AS INT) AS year,
  CAST(o_orderkey % 20 AS INT) AS round, o_custkey AS circuitId, o_orderpriority AS name, o_orderdate AS date,
  o_orderstatus AS time, 'http://example.org/' || CAST(o_orderkey AS STRING) AS url,
  CAST(NULL AS STRING) AS fp1_date, CAST(NULL AS STRING) AS fp1_time, CAST(NULL AS STRING) AS fp2_date,
  CAST(NULL AS STRING) AS fp2_time, CAST(NULL AS STRING) AS fp3_date, CAST(NULL AS STRING) AS fp3_time,
  CAST(NULL AS STRING) AS quali_date, CAST(NULL AS STRING) AS quali_time, CAST(NULL AS STRING) AS sprint_date,
  CAST(NULL AS STRING) AS sprint_time, o_orderdate AS bronze_ingestion
FROM {orders}""",
    "circuits": """
SELECT c_custkey AS circuitId, lower(c_name) AS circuitRef, c_name AS name, c_mktsegment AS location,
  CAST(c_nationkey AS STRING) AS country, CAST(c_acctbal AS DECIMAL(19,4)) AS lat,
  CAST(-c_acctbal AS DECIMAL(19,4)) AS lng,
  CASE WHEN c_nationkey % 4 = 0 THEN chr(92) || 'N' ELSE CAST(c_nationkey AS STRING) END AS alt,
  'http://example.org/c/' || CAST(c_custkey AS STRING) AS url, TIMESTAMP '2024-01-01 00:00:00' AS bronze_ingestion
FROM {customer}""",
    "drivers": """
SELECT p_partkey AS driverId, lower(p_name) AS driverRef, CAST(p_size AS STRING) AS number,
  substr(p_name, 1, 3) AS code, p_name AS forename, p_brand AS surname, CAST(NULL AS STRING) AS dob,
  'http://example.org/d/' || CAST(p_partkey AS STRING) AS url, p_type AS nationality
FROM {part}""",
    "constructors": """
SELECT s_suppkey AS constructorId, lower(s_name) AS constructorRef, s_name AS name,
  CAST(s_nationkey AS STRING) AS nationality, 'http://example.org/k/' || CAST(s_suppkey AS STRING) AS url
FROM {supplier}""",
    "constructor_results": """
SELECT l_orderkey * 8 + l_linenumber AS constructorResultsId, l_orderkey AS raceId, l_suppkey AS constructorId,
  CAST(l_quantity AS DECIMAL(19,4)) AS points, l_returnflag AS status, l_shipdate AS bronze_ingestion
FROM {lineitem}""",
}

_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def derived(sources: Mapping[str, DataFrame], sql: str) -> DataFrame:
    used = {t: sources[t] for t in _TABLES if "{" + t + "}" in sql}
    return next(iter(used.values())).sparkSession.sql(sql, **used)


def duckdb_sql(sql: str) -> str:
    return sql.format(**{t: t for t in _TABLES})


class Sources(dict):
    """Test tables by name; each is opened once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._open = lambda table: source(spark, sf_dir, table)

    def __missing__(self, table: str) -> DataFrame:
        self[table] = self._open(table)
        return self[table]


class Landing(Mapping[str, DataFrame]):
    """Derived tables by name, built when asked for. ``computed`` adds the silver amounts."""

    def __init__(self, spark: SparkSession, sf_dir: str, texts: Mapping[str, str], computed: bool = False):
        self._texts, self._computed = texts, computed
        self._built: dict[str, DataFrame] = {}
        self._sources = Sources(spark, sf_dir)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def _build(self, name: str) -> DataFrame:
        df = derived(self._sources, self._texts[name])
        if "TerritoryGroup" in df.columns:
            df = df.withColumnRenamed("TerritoryGroup", "Group")
        if self._computed:
            df = df.withColumns({c: build() for c, build in SILVER[name].computed.items()})
        return df

    def __iter__(self):
        return iter(self._texts)

    def __len__(self):
        return len(self._texts)


def sales_landing(spark: SparkSession, sf_dir: str) -> Landing:
    return Landing(spark, sf_dir, SALES)


def sales_staged(spark: SparkSession, sf_dir: str) -> Landing:
    """Landing tables with the computed silver columns, as gold input."""
    return Landing(spark, sf_dir, SALES, computed=True)


def racing_landing(spark: SparkSession, sf_dir: str) -> Landing:
    return Landing(spark, sf_dir, RACING)
