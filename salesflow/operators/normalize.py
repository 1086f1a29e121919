"""Header normalisation, role detection and text normalisation of raw records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow import schema as S
from salesflow.functions import parsing as P


def normalize_headers(df: DataFrame) -> DataFrame:
    """Trim and lower-case the headers and rename the known ones; other columns are kept.

    When two headers lead to the same name, the first one in file order is kept.
    """
    taken: dict[str, str] = {}
    for header in df.columns:
        plain = header.strip().lower()
        taken.setdefault(S.HEADER_ALIASES.get(plain, plain), header)
    return df.select(*[P.quoted(header).alias(name) for name, header in taken.items()])


def detect_roles(columns: list[str], required: tuple[str, ...] = ()) -> dict[str, str]:
    """Map each business role to the first column whose header fits; unmatched roles are left out."""
    by_name = {c.lower().strip().replace(" ", "_"): c for c in columns}
    roles = {}
    for role, names in S.ROLE_CANDIDATES.items():
        match = next((by_name[n] for n in names if n in by_name), None)
        if match is not None:
            roles[role] = match
    missing = [r for r in required if r not in roles]
    if missing:
        raise ValueError(f"no column found for role(s) {', '.join(missing)} among {columns}")
    return roles


def by_role(df: DataFrame, required: tuple[str, ...] = ()) -> DataFrame:
    """The role columns of a file under their role names."""
    return df.select(*[P.quoted(c).alias(role) for role, c in detect_roles(df.columns, required).items()])


def cast_numbers(df: DataFrame, columns: list[str], dtype=S.AMOUNT) -> DataFrame:
    return df.withColumns({c: P.to_number(P.quoted(c), dtype) for c in columns})


def fill_texts(df: DataFrame) -> DataFrame:
    """Defaults of the descriptive columns: a product without a name takes its brand's."""
    return df.withColumns(
        {
            "region": P.text_or_unknown(F.col("region")),
            "product": P.text_or_unknown(F.col("product"), F.col("beverage_brand")),
            "beverage_brand": F.coalesce(F.col("beverage_brand"), F.lit("")),
            "retailer": P.text_or_unknown(F.col("retailer")),
        }
    )


def add_month(df: DataFrame, date_column: str) -> DataFrame:
    """Parsed date and month key of a text or date column."""
    parsed = P.to_date(P.quoted(date_column))
    return df.withColumn("_date_parsed", parsed).withColumn("mois", P.month_key(F.col("_date_parsed")))


def calendar_features(df: DataFrame, day: str = "date_vente") -> DataFrame:
    """Month, year and weekday (Monday is 0)."""
    return df.withColumns(
        {"month_num": F.month(day), "year_num": F.year(day), "day_of_week": F.weekday(day)}
    )


def to_records(df: DataFrame, margin_unit: str = "percent") -> DataFrame:
    """Raw records under canonical headers turned into typed sales records.

    Missing columns become NULL; a missing or unreadable date takes the fallback date.
    """
    have = set(df.columns)

    def raw(name: str):
        return P.quoted(name) if name in have else F.lit(None).cast("string")

    typed = {
        "date_vente": P.to_date_or(raw("invoice_date")),
        "region": raw("region"),
        "product": raw("product"),
        "beverage_brand": raw("beverage_brand"),
        "retailer": raw("retailer"),
        "units_sold": P.to_number(raw("units_sold"), S.UNITS),
        "total_sales": P.to_number(raw("total_sales"), S.MONEY),
        "price_per_unit": P.to_number(raw("price_per_unit"), S.PRICE),
        "operating_profit": P.to_number(raw("operating_profit"), S.MONEY),
        "operating_margin": P.to_ratio(raw("operating_margin"), margin_unit),
    }
    rest = [c for c in df.columns if c not in typed and c != "invoice_date"]
    return df.select(*[P.quoted(c) for c in rest], *[e.alias(c) for c, e in typed.items()])
