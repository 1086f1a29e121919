"""Canonical columns, types and the fixed names the sales data model is built on."""

from __future__ import annotations

from pyspark.sql import types as T

UNITS = T.DecimalType(12, 2)
# Amounts of a file as they are read, and as they are summed.
AMOUNT = T.DoubleType()
SUMMED = "decimal(38,6)"
MONEY = T.DecimalType(14, 2)
PRICE = T.DecimalType(10, 4)
MARGIN = T.DecimalType(6, 4)
SCORE = T.DecimalType(5, 2)

SALES_SCHEMA = T.StructType(
    [
        T.StructField("retailer", T.StringType()),
        T.StructField("retailer_id", T.LongType()),
        T.StructField("invoice_date", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("beverage_brand", T.StringType()),
        T.StructField("product", T.StringType()),
        T.StructField("price_per_unit", PRICE),
        T.StructField("units_sold", UNITS),
        T.StructField("total_sales", MONEY),
        T.StructField("operating_profit", MONEY),
        T.StructField("operating_margin", T.StringType()),
    ]
)

# Source header (lower case) -> canonical column.
HEADER_ALIASES = {
    "retailer": "retailer",
    "retailer id": "retailer_id",
    "invoice date": "invoice_date",
    "date": "invoice_date",
    "region": "region",
    "state": "state",
    "city": "city",
    "beverage brand": "beverage_brand",
    "product": "product",
    "price per unit": "price_per_unit",
    "units sold": "units_sold",
    "total sales": "total_sales",
    "operating profit": "operating_profit",
    "operating margin": "operating_margin",
}

# Business role -> accepted headers, best first.
ROLE_CANDIDATES = {
    "region": ["region", "zone", "area", "state", "province", "territory"],
    "date": ["invoice_date", "date", "periode", "month"],
    "sales": ["total_sales", "sales", "revenue", "ventes", "ca"],
    "units": ["units_sold", "qty", "quantity", "volume"],
    "profit": ["operating_profit", "profit"],
    "margin": ["operating_margin", "margin"],
    "product": ["product", "beverage_brand", "produit", "sku", "brand"],
}

# A numeric column whose name contains one of these may not be negative.
SALES_NAME_PARTS = [
    "sale", "vente", "revenue", "qty", "amount", "ca", "total", "volume", "units",
]

# Date layouts, tried in this order. A two-digit month/day layout
# would add nothing to M/d/yyyy, which reads 04/05/2024 already.
DATE_FORMATS = ["yyyy-MM-dd", "M/d/yyyy", "dd/MM/yyyy"]

# Layouts that free date texts are also read in.
FREE_DATE_FORMATS = ["yyyy/MM/dd", "yyyyMMdd", "MMM d, yyyy", "MMMM d, yyyy", "d MMM yyyy", "d MMMM yyyy", "dd-MM-yyyy", "dd.MM.yyyy"]

# Texts of a file that stand for a missing value.
NULL_TEXTS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
              "NULL", "NaN", "None", "n/a", "nan", "null"]

# Defaults, thresholds, states and labels.
UNKNOWN = "Unknown"
FALLBACK_DATE = "2023-01-01"
DEFAULT_COUNTRY = "USA"
DQ_THRESHOLD = 80
BATCH_SIZE = 100
PASSED = "PASSED"
BLOCKED = "BLOCKED"
SEGMENT_LABELS = ["Premium", "Standard", "Basique"]
