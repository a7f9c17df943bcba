"""Declared silver tables: keys, schemas, integrity rules and computed columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratalake.functions.money import line_total_silver, order_total
from stratalake.functions.values import account_number
from stratalake.operators.schema import ddl


@dataclass(frozen=True)
class TableSpec:
    name: str
    keys: tuple[str, ...]
    columns: str
    rules: tuple[str, ...] = ()
    computed: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    optional_rules: tuple[str, ...] = ()

    @property
    def schema(self) -> StructType:
        return ddl(self.columns)


def _total_due() -> Column:
    return order_total(F.col("SubTotal"), F.col("TaxAmt"), F.col("Freight"))


def _line_total() -> Column:
    return line_total_silver(F.col("UnitPrice"), F.col("UnitPriceDiscount"), F.col("OrderQty"))


def _account() -> Column:
    return account_number(F.col("AccountNumber"), F.col("CustomerID"))


# Table and column names, column types, keys, code sets and bounds of the
# sales data model. Every rowguid is filled with a uuid and every ModifiedDate with the
# run's stamp when missing; that rule needs no entry here.
_SPECS = (
    TableSpec(
        "person_address",
        ("AddressID",),
        "AddressID int, AddressLine1 string, AddressLine2 string, City string, StateProvinceID int, "
        "PostalCode string, rowguid string, ModifiedDate timestamp",
    ),
    TableSpec(
        "person_countryregion",
        ("CountryRegionCode",),
        "CountryRegionCode string, Name string, ModifiedDate timestamp",
    ),
    TableSpec(
        "person_emailaddress",
        ("BusinessEntityID", "EmailAddressID"),
        "BusinessEntityID int, EmailAddressID int, EmailAddress string, rowguid string, ModifiedDate timestamp",
    ),
    TableSpec(
        "person_person",
        ("BusinessEntityID",),
        "BusinessEntityID int, PersonType string, NameStyle int, Title string, FirstName string, "
        "MiddleName string, LastName string, Suffix string, EmailPromotion int, "
        "AdditionalContactInfo string, Demographics string, rowguid string, ModifiedDate timestamp",
        rules=(
            "EmailPromotion BETWEEN 0 AND 2",
            "PersonType IN ('GC', 'SP', 'EM', 'IN', 'VC', 'SC')",
        ),
    ),
    TableSpec(
        "person_personphone",
        ("BusinessEntityID", "PhoneNumber", "PhoneNumberTypeID"),
        "BusinessEntityID int, PhoneNumber string, PhoneNumberTypeID int, ModifiedDate timestamp",
    ),
    TableSpec(
        "person_stateprovince",
        ("StateProvinceID",),
        "StateProvinceID int, StateProvinceCode string, CountryRegionCode string, "
        "IsOnlyStateProvinceFlag boolean, Name string, TerritoryID int, rowguid string, ModifiedDate timestamp",
    ),
    TableSpec(
        "production_product",
        ("ProductID",),
        "ProductID int, Name string, ProductNumber string, MakeFlag boolean, FinishedGoodsFlag boolean, "
        "Color string, SafetyStockLevel smallint, ReorderPoint smallint, StandardCost decimal(19,4), "
        "ListPrice decimal(19,4), Size string, SizeUnitMeasureCode string, WeightUnitMeasureCode string, "
        "Weight decimal(8,2), DaysToManufacture int, ProductLine string, Class string, Style string, "
        "ProductSubcategoryID int, ProductModelID int, SellStartDate timestamp, SellEndDate timestamp, "
        "DiscontinuedDate timestamp, rowguid string, ModifiedDate timestamp",
        optional_rules=(
            "SafetyStockLevel > 0",
            "ReorderPoint > 0",
            "StandardCost >= 0",
            "ListPrice >= 0",
            "DaysToManufacture >= 0",
            "upper(Class) IN ('H', 'M', 'L') OR Class IS NULL",
            "upper(ProductLine) IN ('R', 'M', 'T', 'S') OR ProductLine IS NULL",
            "upper(Style) IN ('U', 'M', 'W') OR Style IS NULL",
            "Weight > 0 OR Weight IS NULL",
            "SellEndDate >= SellStartDate OR SellEndDate IS NULL",
        ),
    ),
    TableSpec(
        "production_productcategory",
        ("ProductCategoryID",),
        "ProductCategoryID int, Name string, rowguid string, ModifiedDate timestamp",
    ),
    TableSpec(
        "production_productdescription",
        ("ProductDescriptionID",),
        "ProductDescriptionID int, Description string, rowguid string, ModifiedDate timestamp",
    ),
    TableSpec(
        "production_productmodel",
        ("ProductModelID",),
        "ProductModelID int, Name string, CatalogDescription string, Instructions string, rowguid string, "
        "ModifiedDate timestamp",
    ),
    TableSpec(
        "production_productsubcategory",
        ("ProductSubcategoryID",),
        "ProductSubcategoryID int, ProductCategoryID int, Name string, rowguid string, ModifiedDate timestamp",
    ),
    TableSpec(
        "sales_currency",
        ("CurrencyCode",),
        "CurrencyCode string, Name string, ModifiedDate timestamp",
    ),
    TableSpec(
        "sales_customer",
        ("CustomerID",),
        "CustomerID int, PersonID int, StoreID int, TerritoryID int, AccountNumber string, rowguid string, "
        "ModifiedDate timestamp",
        computed={"AccountNumber": _account},
    ),
    TableSpec(
        "sales_salesorderdetail",
        ("SalesOrderID", "SalesOrderDetailID"),
        "SalesOrderID int, SalesOrderDetailID int, CarrierTrackingNumber string, OrderQty smallint, "
        "ProductID int, SpecialOfferID int, UnitPrice decimal(19,4), UnitPriceDiscount decimal(19,4), "
        "LineTotal decimal(38,6), rowguid string, ModifiedDate timestamp",
        rules=("OrderQty > 0", "UnitPrice >= 0", "UnitPriceDiscount >= 0"),
        computed={"LineTotal": _line_total},
    ),
    TableSpec(
        "sales_salesorderheader",
        ("SalesOrderID",),
        "SalesOrderID int, RevisionNumber smallint, OrderDate timestamp, DueDate timestamp, "
        "ShipDate timestamp, Status smallint, OnlineOrderFlag int, SalesOrderNumber string, "
        "PurchaseOrderNumber string, AccountNumber string, CustomerID int, SalesPersonID int, "
        "TerritoryID int, BillToAddressID int, ShipToAddressID int, ShipMethodID int, CreditCardID int, "
        "CreditCardApprovalCode string, CurrencyRateID int, SubTotal decimal(19,4), TaxAmt decimal(19,4), "
        "Freight decimal(19,4), TotalDue decimal(38,6), rowguid string, ModifiedDate timestamp",
        rules=("SubTotal >= 0", "TaxAmt >= 0", "Freight >= 0", "Status BETWEEN 0 AND 8"),
        computed={"TotalDue": _total_due},
    ),
    TableSpec(
        "sales_salesreason",
        ("SalesReasonID",),
        "SalesReasonID int, Name string, ReasonType string, ModifiedDate timestamp",
    ),
    TableSpec(
        "sales_salesterritory",
        ("TerritoryID",),
        "TerritoryID int, Name string, CountryRegionCode string, `Group` string, SalesYTD decimal(19,4), "
        "SalesLastYear decimal(19,4), CostYTD decimal(19,4), CostLastYear decimal(19,4), rowguid string, "
        "ModifiedDate timestamp",
        rules=("SalesYTD >= 0", "SalesLastYear >= 0", "CostYTD >= 0", "CostLastYear >= 0"),
    ),
    TableSpec(
        "sales_specialoffer",
        ("SpecialOfferID",),
        "SpecialOfferID int, Description string, DiscountPct decimal(10,4), Type string, Category string, "
        "StartDate timestamp, EndDate timestamp, MinQty int, MaxQty int, rowguid string, "
        "ModifiedDate timestamp",
        rules=(
            "DiscountPct >= 0",
            "EndDate >= StartDate",
            "MaxQty >= 0 OR MaxQty IS NULL",
            "MinQty >= 0",
        ),
    ),
)

SILVER: dict[str, TableSpec] = {spec.name: spec for spec in _SPECS}
