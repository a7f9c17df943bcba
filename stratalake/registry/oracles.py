"""DuckDB SQL with the same result as each registered query, over the same test tables."""

from __future__ import annotations

import re

from stratalake.plans.specs import SILVER
from stratalake.plans.star import GOLD_SCHEMAS
from stratalake.registry.landing import RACING, SALES, STAMP, duckdb_sql

_STAMP = f"TIMESTAMP '{STAMP}'"


def _with(ctes: dict[str, str], final: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in ctes.items()) + "\n" + final


def _land(*names: str) -> dict[str, str]:
    texts = {**SALES, **RACING}
    out = {}
    for name in names:
        text = duckdb_sql(texts[name])
        if "TerritoryGroup" in text:
            text = f'SELECT * RENAME (TerritoryGroup AS "Group") FROM ({text})'
        out[name] = text
    return out


def _latest(source: str, keys: str, order: str, ties: str, columns: str = "*") -> str:
    """First row per key: greatest ``order``, then greatest ties, missing values last."""
    ranking = ", ".join(f"{c.strip()} DESC NULLS LAST" for c in [order, *ties.split(",")] if c.strip())
    return (
        f"SELECT {columns} FROM {source} "
        f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {ranking}) = 1"
    )


def _columns(declared: str) -> dict[str, str]:
    """Column types of a declared schema, ids widened to 64 bits."""
    found = re.findall(r"`?(\w+)`? (\w+(?:\(\d+,\d+\))?)", declared)
    return {n: "bigint" if t == "int" and n.endswith(("ID", "Key")) else t for n, t in found}


def _casts(declared: str, source: str) -> str:
    casts = ", ".join(f'CAST("{n}" AS {t}) AS "{n}"' for n, t in _columns(declared).items())
    return f"SELECT {casts} FROM {source}"


def _gold(name: str, source: str) -> str:
    return _casts(GOLD_SCHEMAS[name], source)


# ---------------------------------------------------------------- silver

_UUID = (
    "substr(md5({k}), 1, 8) || '-' || substr(md5({k}), 9, 4) || '-' || substr(md5({k}), 13, 4) || '-' || "
    "substr(md5({k}), 17, 4) || '-' || substr(md5({k}), 21, 12)"
)

_KEYS = {
    "person_address": "AddressID",
    "person_countryregion": "CountryRegionCode",
    "person_emailaddress": "BusinessEntityID, EmailAddressID",
    "person_person": "BusinessEntityID",
    "person_personphone": "BusinessEntityID, PhoneNumber, PhoneNumberTypeID",
    "person_stateprovince": "StateProvinceID",
    "production_product": "ProductID",
    "production_productcategory": "ProductCategoryID",
    "production_productdescription": "ProductDescriptionID",
    "production_productmodel": "ProductModelID",
    "production_productsubcategory": "ProductSubcategoryID",
    "sales_currency": "CurrencyCode",
    "sales_customer": "CustomerID",
    "sales_salesorderdetail": "SalesOrderID, SalesOrderDetailID",
    "sales_salesorderheader": "SalesOrderID",
    "sales_salesreason": "SalesReasonID",
    "sales_salesterritory": "TerritoryID",
    "sales_specialoffer": "SpecialOfferID",
}

_VALID = {
    "person_person": "EmailPromotion >= 0 AND EmailPromotion <= 2 "
    "AND PersonType IN ('GC', 'SP', 'EM', 'IN', 'VC', 'SC')",
    "sales_salesorderdetail": "OrderQty > 0 AND UnitPrice >= 0 AND UnitPriceDiscount >= 0",
    "sales_salesorderheader": "SubTotal >= 0 AND TaxAmt >= 0 AND Freight >= 0 AND Status >= 0 AND Status <= 8",
    "sales_salesterritory": "SalesYTD >= 0 AND SalesLastYear >= 0 AND CostYTD >= 0 AND CostLastYear >= 0",
    "sales_specialoffer": "DiscountPct >= 0 AND EndDate >= StartDate AND MinQty >= 0 "
    "AND (MaxQty >= 0 OR MaxQty IS NULL)",
}

_LINE_TOTAL = (
    "CAST(CAST(UnitPrice AS DECIMAL(18,4)) * CAST(1 - UnitPriceDiscount AS DECIMAL(10,4)) * OrderQty AS DECIMAL(38,6))"
)
_TOTAL_DUE = "CAST(COALESCE(SubTotal + TaxAmt + Freight, 0) AS DECIMAL(38,6))"
_ACCOUNT = "COALESCE(AccountNumber, 'AW' || printf('%09d', CustomerID))"

_COMPUTED = {
    "sales_salesorderdetail": f"*, {_LINE_TOTAL} AS LineTotal",
    "sales_salesorderheader": f"*, {_TOTAL_DUE} AS TotalDue",
    "sales_customer": f"* REPLACE ({_ACCOUNT} AS AccountNumber)",
}


_OPTIONAL_PRODUCT = (
    "SafetyStockLevel > 0 AND ReorderPoint > 0 AND StandardCost >= 0 AND ListPrice >= 0 AND DaysToManufacture >= 0 "
    "AND (upper(Class) IN ('H', 'M', 'L') OR Class IS NULL) AND (upper(ProductLine) IN ('R', 'M', 'T', 'S') OR ProductLine IS NULL) "
    "AND (upper(Style) IN ('U', 'M', 'W') OR Style IS NULL) AND (Weight > 0 OR Weight IS NULL) "
    "AND (SellEndDate >= SellStartDate OR SellEndDate IS NULL)"
)


def _silver_ctes(name: str, out: str = "clean", valid: str | None = None) -> dict[str, str]:
    declared = SILVER[name].columns
    names = list(_columns(declared))
    keys = [k.strip() for k in _KEYS[name].split(",")]
    ties = ", ".join(f'"{c}"' for c in names if c not in keys and c != "ModifiedDate")
    filled = f"{name}_filled"
    base = f"SELECT * REPLACE (COALESCE(ModifiedDate, {_STAMP}) AS ModifiedDate) FROM {name}"
    ctes = _land(name)
    ctes[filled] = f"SELECT {_COMPUTED.get(name, '*')} FROM ({base})"
    latest = _latest(f"(SELECT * FROM {filled} WHERE {valid or _VALID.get(name, 'TRUE')})", _KEYS[name], "ModifiedDate", ties)
    if "rowguid" in names:
        key_text = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
        latest = f"SELECT * REPLACE (COALESCE(rowguid, {_UUID.format(k=key_text)}) AS rowguid) FROM ({latest})"
    ctes[out] = _casts(declared, f"({latest})")
    return ctes


def _silver(name: str) -> str:
    return _with(_silver_ctes(name), "SELECT * FROM clean")


# ---------------------------------------------------------------- gold

_LINE_TIES = "SalesOrderID, ProductID, SpecialOfferID, OrderQty, UnitPrice, UnitPriceDiscount"
_HEADER_TIES = "RevisionNumber, OnlineOrderFlag, OrderDate, DueDate, CustomerID, TerritoryID"
_GOLD_TOTAL = "CAST(OrderQty * UnitPrice - UnitPrice * UnitPriceDiscount AS DECIMAL(38,6))"


def _order_ctes() -> dict[str, str]:
    header = f"(SELECT *, {_TOTAL_DUE} AS TotalDue FROM sales_salesorderheader)"
    detail = f"(SELECT *, {_LINE_TOTAL} AS LineTotal FROM sales_salesorderdetail)"
    return {
        **_land("sales_salesorderheader", "sales_salesorderdetail"),
        "h": "SELECT * FROM ("
        + _latest(header, "SalesOrderID", "ModifiedDate", _HEADER_TIES + ", ShipDate")
        + ") WHERE OnlineOrderFlag = 1",
        "d": _latest(detail, "SalesOrderDetailID", "ModifiedDate", _LINE_TIES),
    }


def _fact_ctes() -> dict[str, str]:
    return {
        **_order_ctes(),
        **_land("production_product", "sales_customer", "sales_specialoffer", "sales_salesterritory"),
        "joined": f"""
SELECT p.ProductID AS ProductKey, h.OrderDate AS OrderDateKey, h.DueDate AS DueDateKey, h.ShipDate AS ShipDateKey,
  c.CustomerID AS CustomerKey, o.SpecialOfferID AS PromotionKey, t.TerritoryID AS SalesTerritoryKey, h.SalesOrderID,
  d.SalesOrderDetailID, h.RevisionNumber, d.OrderQty, d.UnitPrice, d.UnitPriceDiscount, {_GOLD_TOTAL} AS LineTotal
FROM d JOIN h USING (SalesOrderID)
LEFT JOIN (SELECT DISTINCT ProductID FROM production_product) p ON d.ProductID = p.ProductID
LEFT JOIN (SELECT DISTINCT CustomerID FROM sales_customer) c ON h.CustomerID = c.CustomerID
LEFT JOIN (SELECT DISTINCT SpecialOfferID FROM sales_specialoffer) o ON d.SpecialOfferID = o.SpecialOfferID
LEFT JOIN (SELECT DISTINCT TerritoryID FROM sales_salesterritory) t ON h.TerritoryID = t.TerritoryID
WHERE d.OrderQty > 0 AND d.UnitPrice > 0""",
        "fact": _gold("FactInternetSales", "joined"),
    }


def _product_ctes() -> dict[str, str]:
    names = (
        "production_product",
        "production_productsubcategory",
        "production_productcategory",
        "production_productmodel",
    )
    return {
        **_land(*names),
        "p": _latest(
            "production_product", "ProductID", "ModifiedDate", "ProductNumber, Name, ProductSubcategoryID, ProductModelID"
        ),
        "s": _latest("production_productsubcategory", "ProductSubcategoryID", "ModifiedDate", "Name, ProductCategoryID"),
        "m": _latest("production_productmodel", "ProductModelID", "ModifiedDate", "Name"),
        "product_rows": """
SELECT p.ProductID AS ProductKey, p.ProductNumber AS ProductAlternateKey, p.Name AS ProductName, m.Name AS ModelName,
  s.Name AS SubcategoryName, k.Name AS CategoryName, s.ProductSubcategoryID AS ProductSubcategoryKey,
  s.ProductCategoryID AS ProductCategoryKey
FROM p LEFT JOIN s ON p.ProductSubcategoryID = s.ProductSubcategoryID
LEFT JOIN production_productcategory k ON s.ProductCategoryID = k.ProductCategoryID
LEFT JOIN m ON p.ProductModelID = m.ProductModelID""",
        "product": _gold("DimProduct", "product_rows"),
    }


_DATE = {
    "dates": """
SELECT DISTINCT OrderDate AS DateKey, OrderDate AS FullDateAlternateKey, isodow(OrderDate) AS DayNumberOfWeek,
  dayname(OrderDate) AS EnglishDayNameOfWeek, day(OrderDate) AS DayNumberOfMonth,
  dayofyear(OrderDate) AS DayNumberOfYear, week(OrderDate) AS WeekNumberOfYear,
  monthname(OrderDate) AS EnglishMonthName, month(OrderDate) AS MonthNumberOfYear,
  quarter(OrderDate) AS CalendarQuarter, year(OrderDate) AS CalendarYear,
  CASE WHEN month(OrderDate) <= 6 THEN 1 ELSE 2 END AS CalendarSemester
FROM sales_salesorderheader""",
    "date_rows": _gold("DimDate", "dates"),
}


def _renamed(table: str, key: str, ties: str, columns: str, name: str) -> str:
    ctes = {**_land(table), "rows": _latest(table, key, "ModifiedDate", ties, columns)}
    return _with(ctes, _gold(name, "rows"))


def _dimensions() -> dict[str, str]:
    out = {
        "dim_currency": _renamed(
            "sales_currency", "CurrencyCode", "Name",
            "CurrencyCode AS CurrencyKey, CurrencyCode AS CurrencyAlternateKey, Name AS CurrencyName", "DimCurrency",
        ),
        "dim_rename": _renamed(
            "sales_specialoffer", "SpecialOfferID", "Description",
            "SpecialOfferID AS PromotionKey, SpecialOfferID AS PromotionAlternateKey, "
            "Description AS EnglishPromotionName, DiscountPct, Type AS EnglishPromotionType, StartDate, EndDate, MinQty",
            "DimPromotion",
        ),
        "dim_sales_reason": _renamed(
            "sales_salesreason", "SalesReasonID", "Name, ReasonType",
            "SalesReasonID AS SalesReasonKey, Name AS SalesReasonName, ReasonType AS SalesReasonType", "DimSalesReason",
        ),
        "dim_sales_territory": _renamed(
            "sales_salesterritory", "TerritoryID", "Name",
            "TerritoryID AS SalesTerritoryKey, TerritoryID AS SalesTerritoryAlternateKey, "
            'Name AS SalesTerritoryRegion, CountryRegionCode AS SalesTerritoryCountry, "Group" AS SalesTerritoryGroup',
            "DimSalesTerritory",
        ),
        "dim_date": _with({**_land("sales_salesorderheader"), **_DATE}, "SELECT * FROM date_rows"),
        "dim_product": _with(_product_ctes(), "SELECT * FROM product"),
    }
    out["dim_customer"] = _with(
        {
            **_land("sales_customer", "person_person", "person_address", "person_emailaddress", "person_personphone"),
            "e": _latest("person_emailaddress", "BusinessEntityID", "ModifiedDate", "EmailAddress"),
            "f": _latest("person_personphone", "BusinessEntityID", "ModifiedDate", "PhoneNumber"),
            "rows": """
SELECT c.CustomerID AS CustomerKey, a.AddressID AS GeographyKey, c.AccountNumber AS CustomerAlternateKey, p.Title,
  p.FirstName, p.MiddleName, p.LastName, p.NameStyle, e.EmailAddress, f.PhoneNumber AS Phone
FROM sales_customer c JOIN person_person p ON c.CustomerID = p.BusinessEntityID
LEFT JOIN person_address a ON c.CustomerID = a.AddressID
LEFT JOIN e ON c.CustomerID = e.BusinessEntityID
LEFT JOIN f ON c.CustomerID = f.BusinessEntityID""",
        },
        _gold("DimCustomer", "rows"),
    )
    out["dim_geography"] = _with(
        {
            **_land("person_address", "person_stateprovince", "person_countryregion"),
            "rows": """
SELECT a.AddressID AS GeographyKey, a.City, s.Name AS StateProvince, r.Name AS CountryRegion, a.PostalCode
FROM person_address a JOIN person_stateprovince s ON a.StateProvinceID = s.StateProvinceID
JOIN person_countryregion r ON s.CountryRegionCode = r.CountryRegionCode""",
        },
        _gold("DimGeography", "rows"),
    )
    return out


def _wide_table() -> str:
    return _with(
        {
            **_order_ctes(),
            **_land(
                "production_product", "production_productsubcategory", "production_productcategory",
                "sales_salesterritory", "person_person",
            ),
            "s": _latest(
                "production_productsubcategory", "ProductSubcategoryID", "ModifiedDate", "Name, ProductCategoryID"
            ),
            "rows": """
SELECT h.SalesOrderID, d.SalesOrderDetailID, h.OrderDate, h.DueDate, h.SubTotal, h.TaxAmt, h.Freight, h.TotalDue,
  d.LineTotal, d.OrderQty, d.UnitPrice, d.UnitPriceDiscount, p.Name AS ProductName, p.ProductNumber,
  k.Name AS ProductCategoryName, s.Name AS ProductSubcategoryName, t.Name AS TerritoryName,
  c.FirstName || ' ' || c.LastName AS CustomerName
FROM d JOIN h ON d.SalesOrderID = h.SalesOrderID
LEFT JOIN production_product p ON d.ProductID = p.ProductID
LEFT JOIN s ON p.ProductSubcategoryID = s.ProductSubcategoryID
LEFT JOIN production_productcategory k ON s.ProductCategoryID = k.ProductCategoryID
LEFT JOIN sales_salesterritory t ON h.TerritoryID = t.TerritoryID
LEFT JOIN person_person c ON h.CustomerID = c.BusinessEntityID""",
        },
        _gold("OneBigTable", "rows"),
    )


_BY_CATEGORY = """
SELECT CategoryName AS Categoria, ProductName AS Produto, SUM(LineTotal) AS TotalVendas
FROM fact JOIN product ON fact.ProductKey = product.ProductKey
WHERE CategoryName IS NOT NULL GROUP BY CategoryName, ProductName ORDER BY CategoryName, TotalVendas DESC"""


def _gold_reports() -> dict[str, str]:
    fact = {**_fact_ctes(), **_product_ctes()}
    return {
        "fact_sales": _with(_fact_ctes(), "SELECT * FROM fact"),
        "one_big_table": _wide_table(),
        "agg_product_day": _with(
            fact,
            """
SELECT f.ProductKey AS ProductID, CAST(OrderDateKey AS DATE) AS OrderDate, ProductName,
  CategoryName AS ProductCategoryName, SubcategoryName AS ProductSubcategoryName,
  CAST(SUM(OrderQty) AS BIGINT) AS TotalOrderQty, SUM(LineTotal) AS TotalLineTotal
FROM fact f LEFT JOIN product p ON f.ProductKey = p.ProductKey GROUP BY 1, 2, 3, 4, 5""",
        ),
        "sales_by_category": _with(fact, _BY_CATEGORY),
        "sales_by_year": _with(
            {**fact, **_DATE},
            """
SELECT CalendarYear AS Ano, CategoryName AS Categoria, ProductName AS Produto, SUM(LineTotal) AS TotalVendas
FROM fact JOIN product ON fact.ProductKey = product.ProductKey JOIN date_rows ON OrderDateKey = DateKey
WHERE CategoryName IS NOT NULL GROUP BY 1, 2, 3 ORDER BY 1, 2, 4 DESC""",
        ),
        "vw_internet_sales": _with(
            {**fact, **_DATE},
            """
SELECT f.SalesOrderID, f.SalesOrderDetailID, f.OrderDateKey AS order_date, f.DueDateKey AS due_date,
  f.ShipDateKey AS ship_date, f.CustomerKey, f.OrderQty, f.UnitPrice, f.LineTotal,
  p.ProductAlternateKey AS product_code, p.ProductName AS product_name, p.ModelName AS model,
  p.SubcategoryName AS subcategory, p.CategoryName AS category, FullDateAlternateKey AS full_date,
  EnglishDayNameOfWeek AS day_of_week, EnglishMonthName AS month_name, CalendarYear AS year, CalendarQuarter AS quarter
FROM fact f JOIN product p ON f.ProductKey = p.ProductKey JOIN date_rows ON f.OrderDateKey = DateKey""",
        ),
        "run_layers": _layer_run(),
        "run_increments": _increments(),
    }


def _layer_ctes() -> dict[str, str]:
    """Silver rules and deduplication first, then the fact and product dimension over silver."""
    silver = {
        "sales_salesorderheader": "h_all",
        "sales_salesorderdetail": "d",
        "production_product": "p",
        "production_productsubcategory": "s",
        "production_productcategory": "k",
    }
    ctes: dict[str, str] = {}
    for name, out in silver.items():
        ctes.update(_silver_ctes(name, out))
    ctes["fact"] = f"""
SELECT p.ProductID AS ProductKey, h.OrderDate AS OrderDateKey, d.OrderQty, {_GOLD_TOTAL} AS LineTotal
FROM d JOIN (SELECT * FROM h_all WHERE OnlineOrderFlag = 1) h ON d.SalesOrderID = h.SalesOrderID
LEFT JOIN p ON d.ProductID = p.ProductID WHERE d.OrderQty > 0 AND d.UnitPrice > 0"""
    ctes["product"] = """
SELECT p.ProductID AS ProductKey, p.Name AS ProductName, k.Name AS CategoryName, s.Name AS SubcategoryName
FROM p LEFT JOIN s ON p.ProductSubcategoryID = s.ProductSubcategoryID
LEFT JOIN k ON s.ProductCategoryID = k.ProductCategoryID"""
    return ctes


def _layer_run() -> str:
    return _with(_layer_ctes(), _BY_CATEGORY)


def _increments() -> str:
    """Drops leave no trace: the daily aggregate over all rows at once."""
    days = {
        "days": """
SELECT f.ProductKey AS ProductID, CAST(OrderDateKey AS DATE) AS OrderDate, ProductName, CategoryName AS ProductCategoryName,
  SubcategoryName AS ProductSubcategoryName, sum(OrderQty) AS TotalOrderQty, sum(LineTotal) AS TotalLineTotal
FROM fact f LEFT JOIN product p ON f.ProductKey = p.ProductKey GROUP BY ALL"""
    }
    return _with({**_layer_ctes(), **days}, _gold("ft_agg_product_day", "days"))


# ---------------------------------------------------------------- racing

_POSITION = "TRY_CAST(position AS INTEGER)"


def _racing() -> dict[str, str]:
    pairs = (
        f"SELECT DISTINCT driverId AS driver_id, {_POSITION} AS position_int FROM results WHERE {_POSITION} > {{n}}"
    )
    results = {
        **_land("results"),
        "pairs": pairs.format(n=10),
        "silver_results": f"""
SELECT resultId AS result_id, raceId AS race_id, driverId AS driver_id, constructorId AS constructor_id, number, grid,
  position, positionText, CAST(positionOrder AS INTEGER) AS position_order, points, laps, time, milliseconds,
  fastestLap, TRY_CAST(rank AS INTEGER) AS rank, fastestLapTime, fastestLapSpeed, bronze_ingestion,
  {_STAMP} AS silver_ingestion
FROM results WHERE driverId IN (SELECT driver_id FROM pairs)""",
    }
    lines = {
        **results,
        **_land("races", "circuits", "drivers"),
        "race_rows": """
SELECT r.race_id, y.year, c.name AS circuit_name, r.driver_id, v.driverRef AS driver_name, r.position,
  r.bronze_ingestion
FROM silver_results r JOIN races y ON r.race_id = y.raceId
JOIN (SELECT * FROM circuits WHERE circuitId > 10) c ON y.circuitId = c.circuitId
JOIN drivers v ON r.driver_id = v.driverId""",
    }
    laps = "SELECT resultId, raceId, driverId, laps"
    return {
        "race_results": _with(lines, "SELECT * FROM race_rows"),
        "run_racing": _with(
            lines,
            "SELECT * REPLACE (CASE WHEN position = chr(92) || 'N' THEN NULL ELSE position END AS position, "
            f"{_STAMP} AS bronze_ingestion) FROM race_rows",
        ),
        "race_winners": _with(lines, "SELECT * FROM race_rows WHERE position = '1'"),
        "racing_silver_results": _with(results, "SELECT * FROM silver_results"),
        "racing_silver_circuits": _with(
            _land("circuits"),
            "SELECT circuitId AS circuit_id, circuitRef AS circuit_ref, name AS circuit_name, location, country, lat, "
            "lng, alt, bronze_ingestion FROM circuits WHERE circuitId > 10",
        ),
        "racing_silver_constructor_results": _with(
            _land("constructor_results"),
            "SELECT constructorResultsId AS constructor_results_id, raceId AS race_id, constructorId AS constructor_id, "
            f"points, status, bronze_ingestion, {_STAMP} AS silver_ingestion FROM constructor_results "
            "WHERE constructorId > 10",
        ),
        "racing_silver_drivers": _with(
            _land("drivers"),
            "SELECT driverId AS driver_id, driverRef, number, code, forename, surname, dob, url, nationality, "
            f"{_STAMP} AS silver_ingestion FROM drivers",
        ),
        "racing_silver_constructors": _with(
            _land("constructors"),
            "SELECT constructorId AS constructor_id, constructorRef, name, nationality, url, "
            f"{_STAMP} AS silver_ingestion FROM constructors",
        ),
        "racing_silver_races": _with(_land("races"), f"SELECT *, {_STAMP} AS silver_ingestion FROM races"),
        "points_by_driver": _with(
            _land("results", "drivers", "constructors"),
            """
SELECT driverRef, SUM(points) AS points_driver FROM results r JOIN drivers d ON r.driverId = d.driverId
JOIN constructors c ON r.constructorId = c.constructorId GROUP BY driverRef ORDER BY SUM(points) DESC""",
        ),
        "distinct_pairs": _with(_land("results"), pairs.format(n=10)),
        "semi_join_in": _with(
            _land("results", "races"),
            f"{laps} FROM results WHERE raceId IN (SELECT raceId FROM races WHERE year = 1997)",
        ),
        "export_by_year": _with(
            _land("results", "races"),
            "SELECT resultId, results.raceId, driverId, laps, year FROM results "
            "JOIN races ON results.raceId = races.raceId WHERE year BETWEEN 1996 AND 1998",
        ),
        "try_cast_null": _with(
            _land("results"),
            f"SELECT resultId, {_POSITION} AS position, TRY_CAST(rank AS INTEGER) AS rank, "
            "TRY_CAST(time AS INTEGER) AS time FROM results",
        ),
    }


# ---------------------------------------------------------------- ingest, cleaning, changes, layout, streams

_CUSTOMER = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
_YEAR = "CAST(year(o_orderdate) - 1995 AS INTEGER)"
_EVENT_CUT = "TIMESTAMP '2024-01-15 00:00:00'"


def _draw(i: int) -> str:
    digest = f"substr(md5(CAST(o_orderkey AS VARCHAR) || ':{i}'), 1, 8)"
    return f"(CAST('0x' || {digest} AS BIGINT) / 4294967296.0::DOUBLE)"


_ACCOUNTS = (
    "SELECT c_custkey, CAST(c_acctbal AS DECIMAL(19,4)) AS balance, "
    "CASE WHEN c_nationkey <> 3 THEN c_mktsegment END AS segment FROM customer"
)
_MERGE = {
    "t": "SELECT CASE WHEN c_nationkey <> 3 THEN c_custkey END AS id, CAST(c_acctbal AS DECIMAL(19,4)) AS balance, "
    "c_mktsegment AS note FROM customer",
    "s": "SELECT CASE WHEN s_nationkey <> 5 THEN CASE WHEN s_nationkey % 2 = 0 THEN s_suppkey ELSE -1 - s_suppkey END "
    "END AS id, CAST(s_acctbal AS DECIMAL(19,4)) AS balance, 'changed' AS note, s_name AS agent FROM supplier",
    "kept": "SELECT t.*, CAST(NULL AS VARCHAR) AS agent FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.id = t.id)",
}


def _counts(names: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS table_name, count(*) AS row_count FROM {table}" for label, table in names.items()
    )


#: Events as they arrive in three drops, a part of each drop twice, each with the greatest time of the drops before less two days.
_LATE = {
    "arrived": """
SELECT event_id, ts, event_type, 0 AS drop FROM events WHERE ts < TIMESTAMP '2024-01-10' AND event_id % 4 <> 3
UNION ALL SELECT event_id, ts, event_type, 1 FROM events
WHERE (ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20') OR (event_id % 4 = 3 AND ts < TIMESTAMP '2024-01-10')
  OR (ts < TIMESTAMP '2024-01-10' AND event_id % 5 = 0)
UNION ALL SELECT event_id, ts, event_type, 2 FROM events WHERE ts >= TIMESTAMP '2024-01-20' OR event_id % 7 = 0""",
    "seen": "SELECT d.drop, date_trunc('millisecond', max(ts)) - INTERVAL 2 DAY AS watermark FROM (SELECT DISTINCT drop FROM arrived) d "
    "LEFT JOIN arrived a ON a.drop < d.drop GROUP BY d.drop",
    "judged": "SELECT a.*, watermark FROM (SELECT * FROM arrived UNION ALL SELECT * FROM arrived WHERE event_id % 11 = 0) a "
    "JOIN seen ON a.drop = seen.drop",
}


def _quarantine() -> str:
    """Refused rows of the tables that have rules, with the texts of those that are not true."""
    ctes, parts = {}, []
    for name, spec in SILVER.items():
        if spec.rules:
            ctes.update({n: t for n, t in _silver_ctes(name, f"{name}_clean").items() if n != f"{name}_clean"})
            broken = ", ".join(f"CASE WHEN NOT coalesce(({rule}), false) THEN '{rule.replace(chr(39), 2 * chr(39))}' END" for rule in spec.rules)
            key = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in spec.keys)
            parts.append(
                f"SELECT '{name}' AS table_name, {key} AS key, array_to_string(list_filter([{broken}], lambda x: x IS NOT NULL), '; ') AS broken "
                f"FROM {name}_filled WHERE NOT coalesce(({_VALID[name]}), false)"
            )
    return _with(ctes, " UNION ALL ".join(parts))


def _quarantine_counts() -> str:
    ctes, parts = {}, []
    for name, spec in SILVER.items():
        ctes.update({n: t for n, t in _silver_ctes(name, f"{name}_clean").items() if n != f"{name}_clean"})
        valid = f"coalesce(({_VALID.get(name, 'TRUE')}), false)"
        counted = {"rows": "TRUE", "kept": valid, "refused": f"NOT {valid}"} | {rule: f"NOT coalesce(({rule}), false)" for rule in spec.rules}
        for what, condition in counted.items():
            parts.append(f"SELECT '{name}' AS table_name, '{what.replace(chr(39), 2 * chr(39))}' AS what, count(*) FILTER (WHERE {condition}) AS n FROM {name}_filled")
    return _with(ctes, " UNION ALL ".join(parts))


#: Update, delete, merge and replacement one upon the other, by the remainder of the order key.
_CHANGE_FILES = """
WITH o AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(19,4)) AS price, o_orderkey % 1000 AS r FROM orders
), changed AS (
  SELECT o_orderkey, o_custkey, CASE WHEN r < 20 THEN 'U' ELSE o_orderstatus END AS o_orderstatus,
    CAST(CASE WHEN r < 20 THEN price * 2 ELSE price END AS DECIMAL(19,4)) AS price, CAST(NULL AS VARCHAR) AS note, r
  FROM o WHERE NOT r BETWEEN 15 AND 30
)
SELECT * EXCLUDE (r) FROM changed WHERE NOT r BETWEEN 25 AND 40 AND NOT r BETWEEN 38 AND 44
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, price, 'merged' FROM o WHERE r BETWEEN 25 AND 37
UNION ALL SELECT o_orderkey, o_custkey, 'R', price, 'replaced' FROM o WHERE r BETWEEN 38 AND 44 AND o_custkey % 2 = 0
"""


def _plain() -> dict[str, str]:
    lines = "SELECT {c} FROM lineitem"
    sale = {
        "sales": f"""
SELECT CAST(DATE '2022-01-01' + CAST(floor({_draw(0)} * 729) AS INTEGER) AS DATE) AS data_venda,
  CASE WHEN {_draw(1)} < 0.2::DOUBLE THEN 'Eletrônicos' WHEN {_draw(2)} < 0.4::DOUBLE THEN 'Roupas'
    WHEN {_draw(3)} < 0.6::DOUBLE THEN 'Alimentos' WHEN {_draw(4)} < 0.8::DOUBLE THEN 'Livros'
    ELSE 'Brinquedos' END AS categoria,
  {_draw(5)} * 1000 AS valor FROM orders""",
    }
    header = _land("sales_salesorderheader")
    events_cast = "event_id, ts AS process_date, event_type"
    return {
        "ingest_csv_raw": "SELECT "
        + ", ".join(f"'{c}' AS _c{i}" for i, c in enumerate(_CUSTOMER))
        + " FROM range(3) UNION ALL SELECT "
        + ", ".join(f"CAST({c} AS VARCHAR)" for c in _CUSTOMER)
        + " FROM customer",
        "ingest_csv_infer": "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(19,4)) AS "
        "o_totalprice, o_orderdate, o_orderpriority FROM orders",
        "ingest_csv_header": "SELECT "
        + ", ".join(
            f"CAST({c} AS VARCHAR) AS {c}" for c in ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
        )
        + " FROM part",
        "ingest_glob": "SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(19,4)) AS c_acctbal, "
        "c_mktsegment FROM customer",
        "ingest_manifest": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, CAST({key} AS BIGINT) AS id, {name} AS name, '2024-01-01' AS day FROM {t}"
            for t, key, name in (
                ("nation", "n_nationkey", "n_name"), ("customer", "c_custkey", "c_name"), ("supplier", "s_suppkey", "s_name"),
                ("part", "p_partkey", "p_name"), ("orders", "o_orderkey", "o_orderpriority"),
            )
        ),
        "bronze_parquet": f"SELECT *, {_STAMP} AS bronze_ingestion FROM orders",
        "path_scan": "SELECT * FROM customer",
        "write_modes": "SELECT c_custkey, c_nationkey FROM customer UNION ALL SELECT s_suppkey, s_nationkey FROM supplier",
        "schema_merge": "SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS "
        "o_orderpriority, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS batch FROM orders",
        "append_by_name": "SELECT c_custkey, c_name, c_nationkey FROM customer UNION ALL "
        "SELECT n_nationkey, n_name, n_regionkey FROM nation",
        "ingest_stamp": f"SELECT *, {_STAMP} AS bronze_ingestion FROM supplier",
        "param_sql": "SELECT o_orderkey, o_custkey, 'checked' AS label FROM orders "
        "WHERE o_orderpriority = '1-URGENT' AND o_totalprice >= 250000",
        "conform_schema": lines.format(
            c="l_orderkey, l_linenumber, CAST(l_quantity AS SMALLINT) AS l_quantity, "
            "CAST(l_extendedprice AS DECIMAL(19,4)) AS l_extendedprice, CAST(l_discount AS DECIMAL(10,4)) AS l_discount, "
            "l_shipdate, l_returnflag"
        ),
        "default_fill": _with(
            _land("sales_customer"),
            f"SELECT CustomerID, COALESCE(StoreID, 0) AS StoreID, COALESCE(ModifiedDate, {_STAMP}) AS ModifiedDate, "
            f"COALESCE(rowguid, {_UUID.format(k='CAST(CustomerID AS VARCHAR)')}) AS rowguid FROM sales_customer",
        ),
        "uuid_fill": _with(
            _land("sales_customer"),
            "SELECT CustomerID, CAST(COALESCE(length(rowguid), 36) AS INTEGER) AS id_length FROM sales_customer",
        ),
        "account_number": _with(
            _land("sales_customer"), f"SELECT CustomerID, {_ACCOUNT} AS AccountNumber FROM sales_customer"
        ),
        "quality_rules": _with(
            header,
            f"SELECT SalesOrderID, RevisionNumber, Status, Freight FROM sales_salesorderheader "
            f"WHERE {_VALID['sales_salesorderheader']}",
        ),
        "quality_rules_nullable": _with(
            _land("sales_specialoffer"),
            f"SELECT SpecialOfferID, DiscountPct, MinQty, MaxQty FROM sales_specialoffer "
            f"WHERE {_VALID['sales_specialoffer']}",
        ),
        "dedup_latest": _latest(
            "orders", "o_custkey", "o_orderdate", "o_orderkey, o_orderstatus, o_totalprice, o_orderpriority"
        ),
        "dedup_composite": _latest(
            "lineitem",
            "l_orderkey, l_linenumber",
            "l_shipdate",
            "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus",
        ),
        "order_total": _with(
            header, f"SELECT SalesOrderID, RevisionNumber, {_TOTAL_DUE} AS TotalDue FROM sales_salesorderheader"
        ),
        "line_total_silver": _with(
            _land("sales_salesorderdetail"),
            f"SELECT SalesOrderDetailID, OrderQty, UnitPrice, {_LINE_TOTAL} AS LineTotal FROM sales_salesorderdetail",
        ),
        "monthly_avg": "SELECT CAST(month(o_orderdate) AS INTEGER) AS mes, "
        "CAST(CAST(SUM(CAST(o_totalprice AS DECIMAL(19,4))) AS DOUBLE) / COUNT(*) AS DECIMAL(19,4)) AS media "
        "FROM orders GROUP BY mes ORDER BY mes",
        "year_month": "SELECT strftime(o_orderdate, '%Y-%m') AS ano_mes, COUNT(*) AS orders FROM orders GROUP BY 1",
        "category_totals": "SELECT l_returnflag AS categoria, COUNT(*) AS total_vendas, "
        "CAST(round(SUM(CAST(l_extendedprice AS DECIMAL(19,4))), 2) AS DECIMAL(38,2)) AS total_valor "
        "FROM lineitem GROUP BY 1",
        "table_counts": _counts(
            {
                f"{n}.parquet": n
                for n in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
            }
        )
        + " UNION ALL SELECT 'absent.parquet', NULL",
        "preview": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 10",
        "insert_rows": "SELECT c_custkey, c_name, c_nationkey FROM customer UNION ALL "
        "SELECT -s_suppkey - 1, s_name, s_nationkey FROM supplier",
        "update_where": _with(
            {"a": _ACCOUNTS},
            "SELECT c_custkey, CASE WHEN segment = 'BUILDING' THEN CAST(balance * 2 AS DECIMAL(19,4)) ELSE balance END "
            "AS balance, CASE WHEN segment = 'BUILDING' THEN 'BUILD' ELSE segment END AS segment FROM a",
        ),
        "delete_where": _with({"a": _ACCOUNTS}, "SELECT * FROM a WHERE segment IS NULL OR segment <> 'BUILDING'"),
        "merge_upsert": _with(_MERGE, "SELECT * FROM kept UNION ALL SELECT * FROM s"),
        "merge_delete_missing": _with(
            _MERGE, "SELECT * FROM kept WHERE balance >= 0 OR balance IS NULL UNION ALL SELECT * FROM s"
        ),
        "change_files": _CHANGE_FILES,
        "merge_partitioned": "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 AND month(o_orderdate) IN (1, 8, 11) THEN 'X' "
        "ELSE o_orderstatus END AS o_orderstatus, CASE WHEN month(o_orderdate) <> 8 THEN strftime(o_orderdate, '%m') END AS mes "
        "FROM orders",
        "publish_overwrite": _with({"a": _ACCOUNTS}, "SELECT * FROM a WHERE balance >= 0 OR balance IS NULL"),
        "append_batches": f"SELECT o_orderkey, {_YEAR} AS insercao_id, {_YEAR} AS version FROM orders",
        "batch_summary": f"SELECT COUNT(*) AS total_linhas, MAX({_YEAR}) AS ultima_insercao FROM orders",
        "as_of_version": "SELECT 'version 3' AS as_of, o_orderkey, o_orderstatus, NULL::BIGINT AS o_custkey FROM orders "
        f"WHERE {_YEAR} <= 3 UNION ALL SELECT 'now', o_orderkey, o_orderstatus, "
        "CASE WHEN o_orderstatus = 'O' THEN o_custkey END FROM orders WHERE o_orderstatus IN ('F', 'O')",
        "version_history": f"""
WITH newest AS (SELECT MAX({_YEAR}) AS v FROM orders),
marks AS (
  SELECT {_YEAR} AS version, 'append' AS operation, 1 AS n FROM orders
  UNION ALL SELECT v + 1, 'overwrite', 0 FROM newest
  UNION ALL SELECT v + 2, 'append', 1 FROM orders, newest WHERE o_orderstatus = 'F'
  UNION ALL SELECT v + 3, 'append', 1 FROM orders, newest WHERE o_orderstatus = 'O')
SELECT version, operation, CAST(SUM(n) AS BIGINT) AS row_count, {_STAMP} AS first_stamp, {_STAMP} AS last_stamp
FROM marks GROUP BY version, operation""",
        "partition_prune": "SELECT *, strftime(o_orderdate, '%Y-%m') AS ano_mes FROM orders "
        "WHERE strftime(o_orderdate, '%Y-%m') = '1997-03'",
        "compact_files": "SELECT * FROM lineitem",
        "zorder_layout": "SELECT * FROM lineitem WHERE l_returnflag = 'R'",
        "zorder_layout_columns": "SELECT * FROM lineitem",
        "layout_report": """
SELECT layout, column_name, CAST(CASE column_name WHEN 'url' THEN (SELECT count(*) FROM orders WHERE o_custkey < 10)
  ELSE (SELECT count(*) FROM orders WHERE o_orderkey < 60) END AS BIGINT) AS rows_hit, layout = 'clustered' AS narrow
FROM (VALUES ('spread'), ('clustered')) a(layout), (VALUES ('url'), ('id')) b(column_name)""",
        "file_stats": "SELECT 'lineitem.parquet' AS file_name, COUNT(*) AS rows FROM lineitem",
        "synth_sales": _with(sale, "SELECT *, strftime(data_venda, '%Y-%m') AS ano_mes FROM sales"),
        "synth_range": _with(
            {
                "base": "SELECT range AS o_orderkey FROM range((SELECT min(o_orderkey) FROM orders), (SELECT max(o_orderkey) + 1 FROM orders))",
                "sales": sale["sales"].replace("FROM orders", "FROM base").replace("SELECT ", "SELECT o_orderkey AS id, ", 1),
            },
            "SELECT s.* REPLACE (CAST(valor AS DECIMAL(19,4)) AS valor), strftime(data_venda, '%Y-%m') AS ano_mes, "
            "CAST(o_totalprice AS DECIMAL(19,4)) AS price, o_orderstatus FROM sales s LEFT JOIN orders ON id = o_orderkey",
        ),
        "create_rows": "SELECT o_orderpriority, orders, priority, urgency FROM (SELECT o_orderpriority, count(*) AS orders FROM orders "
        "GROUP BY o_orderpriority) o FULL JOIN (VALUES ('1-URGENT', 5), ('2-HIGH', 4), ('3-MEDIUM', 3), ('9-NEVER', NULL)) r(priority, urgency) "
        "ON o_orderpriority = priority",
        "bloom_lookup": "SELECT * FROM orders WHERE o_custkey IN (1, 17, 60, 101, 1234)",
        "stream_bounded": "SELECT * FROM events",
        "stream_first_rows": _with(
            _LATE,
            "SELECT event_id, ts, event_type FROM judged WHERE NOT coalesce(ts <= watermark, false) GROUP BY ALL",
        ),
        "stream_late_rows": _with(
            _LATE,
            "SELECT event_id, ts, event_type, watermark AS missed_watermark FROM judged WHERE ts <= watermark",
        ),
        "stream_csv_any_order": _with(
            {
                "arrived": "SELECT event_id % 500 AS key, ts AS process_date, "
                "event_id % 100 + CASE WHEN ts >= TIMESTAMP '2024-01-21' THEN 0.5 ELSE 0 END AS val, "
                "CASE WHEN ts >= TIMESTAMP '2024-01-11' THEN event_type END AS event_type, "
                'CASE WHEN ts >= TIMESTAMP \'2024-01-21\' THEN user_id END AS "user", '
                "CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 0 WHEN ts < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END AS batch FROM events",
                "newest": _latest("arrived", "key", "batch", 'process_date, val, event_type, "user"'),
            },
            f'SELECT key, process_date, CAST(val AS DOUBLE) AS val, event_type, "user", {_STAMP} AS ingestion_date FROM newest',
        ),
        "stream_fold_growth": "SELECT event_id, ts AS process_date, user_id, "
        f"CASE WHEN event_id % 10 < 9 AND event_id % 3 = 0 THEN 'again' ELSE event_type END AS event_type, {_STAMP} AS ingestion_date FROM events",
        "quarantine_rows": _quarantine(),
        "quarantine_counts": _quarantine_counts(),
        "stream_append": "SELECT * FROM events",
        "stream_csv_evolve": _with(
            {
                "arrived": "SELECT event_id % 500 AS key, ts AS process_date, "
                f"event_id % 100 + CASE WHEN ts >= {_EVENT_CUT} THEN 0.5 ELSE 0 END AS val, "
                f"CASE WHEN ts >= {_EVENT_CUT} THEN event_type END AS event_type, "
                f"CASE WHEN ts >= {_EVENT_CUT} THEN 1 ELSE 0 END AS batch FROM events",
                "newest": _latest("arrived", "key", "batch", "process_date, val, event_type"),
            },
            f"SELECT key, process_date, CAST(val AS DOUBLE) AS val, event_type, {_STAMP} AS ingestion_date FROM newest",
        ),
        "stream_upsert_fold": _with(
            {
                "arrived": "SELECT user_id, ts AS process_date, event_id, "
                f"CASE WHEN ts < {_EVENT_CUT} THEN 2 WHEN event_id % 3 = 0 THEN 0 ELSE 1 END AS batch FROM events",
                "newest": _latest("arrived", "user_id", "batch", "process_date, event_id"),
            },
            f"SELECT user_id, process_date, event_id, {_STAMP} AS ingestion_date FROM newest",
        ),
        "overwrite_schema_merge": "SELECT o_orderkey, NULL::BIGINT AS o_custkey, o_orderpriority FROM orders",
        "empty_table_append": "SELECT o_orderkey AS id, CAST(o_totalprice AS DECIMAL(19,4)) AS amount, "
        "strftime(o_orderdate, '%Y-%m') AS mes FROM orders",
        "catalog_tables": """
WITH people AS (SELECT c_nationkey FROM customer), more AS (SELECT * FROM people UNION ALL SELECT s_nationkey FROM supplier)
SELECT 'created' AS step, c_nationkey, count(*) AS n FROM people GROUP BY c_nationkey
UNION ALL SELECT 'appended', c_nationkey, count(*) FROM more GROUP BY c_nationkey
UNION ALL SELECT 'replaced', c_nationkey + 100, count(*) FROM people GROUP BY c_nationkey""",
        "schema_rejects": "SELECT declared, by_place, by_name, true AS append_refused, (SELECT count(*) FROM orders) AS rows_left "
        "FROM (VALUES ('fits', false, false), ('fewer', true, false), ('order', true, false), ('type', true, true)) "
        "t(declared, by_place, by_name)",
        "stream_upsert_latest": _with(
            {
                "arrived": "SELECT user_id, ts AS process_date, event_id, event_type, "
                f"CASE WHEN ts < {_EVENT_CUT} THEN 1 ELSE 0 END AS batch FROM events",
                "newest": _latest("arrived", "user_id", "batch", "process_date, event_id"),
            },
            f"SELECT user_id, process_date, event_id, event_type, {_STAMP} AS ingestion_date FROM newest",
        ),
        "stream_schema_evolve": f"SELECT {events_cast}, CASE WHEN ts >= {_EVENT_CUT} THEN props END AS props, "
        f"{_STAMP} AS ingestion_date FROM events",
        "quality_rules_optional": _with(
            _silver_ctes("production_product", valid=_OPTIONAL_PRODUCT), "SELECT * FROM clean"
        ),
        "salted_lookup": "SELECT l_orderkey % 50 AS l_group, l_linenumber, "
        "CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l.l_suppkey END AS l_suppkey, s_suppkey, s_name FROM lineitem l "
        "LEFT JOIN supplier ON CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l.l_suppkey END = s_suppkey",
    }


#: Queries that reach the rows of another one in another way.
_SAME_ROWS = {"fact_bucketed": "fact_sales", "merge_files": "merge_upsert", "merge_files_delete": "merge_delete_missing"}


def sql_by_query() -> dict[str, str]:
    short = {"sales_salesorderdetail": "silver_lineitem", "sales_salesorderheader": "silver_orders"}
    silver = {short.get(n, f"silver_{n.split('_', 1)[1]}"): _silver(n) for n in SILVER}
    texts = {**_plain(), **silver, **_dimensions(), **_gold_reports(), **_racing()}
    return texts | {name: texts[other] for name, other in _SAME_ROWS.items()}
