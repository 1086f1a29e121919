"""The registered queries in plain SQL, for comparison in another engine."""

from __future__ import annotations

FEED = """
feed AS (
  SELECT *, cast(total_sales * operating_margin AS decimal(14,2)) AS operating_profit FROM (
    SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderkey // 25 AS batch_no,
           cast(l_shipdate AS date) AS date_vente, r_name AS region, p_name AS product,
           p_brand AS beverage_brand, c_name AS retailer,
           cast(l_quantity AS decimal(12,2)) AS units_sold,
           cast(cast(l_extendedprice AS decimal(14,2)) * (1 - cast(l_discount AS decimal(4,2)))
                AS decimal(14,2)) AS total_sales,
           cast(p_retailprice AS decimal(10,4)) AS price_per_unit,
           cast(cast(l_discount AS decimal(6,4)) + cast(l_tax AS decimal(6,4)) AS decimal(6,4))
             AS operating_margin
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    JOIN part ON l_partkey = p_partkey))"""

DIRTY = FEED + """,
dirty AS (
  SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey, batch_no, date_vente,
         CASE WHEN batch_no % 10 <> 0 THEN region END AS region, product, beverage_brand, retailer,
         CASE WHEN batch_no % 10 = 0 THEN NULL
              WHEN batch_no % 10 = 3 AND o_orderkey % 2 = 0 THEN -units_sold
              ELSE units_sold END AS units_sold,
         CASE WHEN batch_no % 10 = 1 THEN NULL
              WHEN o_orderkey % 997 = 5 THEN cast(total_sales * 100 AS decimal(14,2))
              ELSE total_sales END AS total_sales,
         price_per_unit, operating_margin, operating_profit
  FROM feed, unnest(range(CASE WHEN o_orderkey % 50 = 7 THEN 2 ELSE 1 END)) AS copies(copy_no))"""

TEXT = FEED + """,
raw AS (
  SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey, retailer,
         CASE o_orderkey % 5
              WHEN 0 THEN strftime(date_vente, '%Y-%m-%d')
              WHEN 1 THEN strftime(date_vente, '%-m/%-d/%Y')
              WHEN 2 THEN CASE WHEN day(date_vente) > 12 THEN strftime(date_vente, '%d/%m/%Y')
                               ELSE strftime(date_vente, '%Y-%m-%d') END
              WHEN 3 THEN 'n/a' END AS invoice_date,
         CASE WHEN o_orderkey % 11 <> 2 THEN region END AS region,
         CASE WHEN o_orderkey % 11 <> 3 THEN beverage_brand END AS beverage_brand,
         CASE WHEN o_orderkey % 11 NOT IN (3, 4) THEN product END AS product,
         CASE WHEN o_orderkey % 11 = 5 THEN 'n/a' ELSE cast(units_sold AS varchar) END AS units_sold,
         CASE WHEN o_orderkey % 11 = 6 THEN 'n/a' ELSE cast(total_sales AS varchar) END AS total_sales,
         cast(cast(operating_margin * 100 AS decimal(6,2)) AS varchar) || '%' AS operating_margin
  FROM feed),
parsed AS (
  SELECT *, cast(coalesce(try_strptime(invoice_date, '%Y-%m-%d'), try_strptime(invoice_date, '%m/%d/%Y'),
                          try_strptime(invoice_date, '%d/%m/%Y')) AS date) AS date_parsed,
         try_cast(units_sold AS decimal(14,2)) AS units, try_cast(total_sales AS decimal(14,2)) AS sales
  FROM raw)"""

WIDE = TEXT + """,
wide AS (
  SELECT * EXCLUDE (units, sales), try_cast(units_sold AS double) AS units, try_cast(CASE
    WHEN o_orderkey % 499 = 5 THEN '20000000000000.125'
    WHEN contains(total_sales, '.') THEN total_sales || (o_orderkey % 10)
    ELSE total_sales END AS double) AS sales FROM parsed),
wide_ok AS (SELECT DISTINCT * FROM wide WHERE sales >= 0 AND units >= 0 AND region IS NOT NULL)"""

KEYS = "o_orderkey, l_linenumber, l_partkey, l_suppkey"
TEXTS = "batch_no, date_vente, region, product, beverage_brand, retailer"
AMOUNTS = """cast(units_sold AS double) AS units_sold, cast(total_sales AS double) AS total_sales,
  cast(price_per_unit AS double) AS price_per_unit, cast(operating_margin AS double) AS operating_margin,
  cast(operating_profit AS double) AS operating_profit"""
ALL = f"{KEYS}, {TEXTS}, {AMOUNTS}"
MONTH = "strftime(date_vente, '%Y-%m')"


def mean(column: str) -> str:
    return f"cast(sum({column}) AS double) / count({column})"


def rounded_mean(column: str, scale: int) -> str:
    """Half away from zero on the exact quotient, for sums that are not negative."""
    step = 10**scale
    units = f"cast(sum({column}) * {step} AS hugeint)"
    return f"cast((2 * {units} + count({column})) // (2 * count({column})) AS double) / {step}"


# ── star ─────────────────────────────────────────────────────────────────────
def bucket(key: str) -> str:
    return f"cast('0x' || substr(md5({key}), 1, 3) AS bigint)"


def members(source: str, key: str, order: str) -> str:
    """Ids ranked inside 4096 hash buckets."""
    return (
        f"SELECT *, (row_number() OVER (PARTITION BY {bucket(key)} ORDER BY {order}) - 1) * 4096"
        f" + {bucket(key)} + 1 AS id FROM ({source})"
    )


REGION_IDS = members(
    "SELECT DISTINCT r_name AS name FROM region UNION SELECT 'Unknown'", "name", "name"
)
PRODUCT_IDS = members(
    "SELECT DISTINCT p_name AS name, p_brand AS brand FROM part", "name || '|' || brand", "name, brand"
)
RETAILER_IDS = members("SELECT DISTINCT c_name AS name FROM customer", "name", "name")

# ── scores ───────────────────────────────────────────────────────────────────
def rounded(value: str, digits: int = 2) -> str:
    """Rounded by the true binary value, half to even."""
    return f"cast(format('{{:.{digits}f}}', {value}) AS double)"


def share(good: str) -> str:
    return rounded(f"cast({good} AS double) / count(*) * 100")


RULES = f"""
  {share('count(units_sold)')} AS no_null_units_sold,
  {share('count(total_sales)')} AS no_null_total_sales,
  {share('count(region)')} AS no_null_region,
  {share('count(*) FILTER (WHERE coalesce(total_sales, 0) >= 0)')} AS positive_sales,
  {share('count(*) FILTER (WHERE coalesce(units_sold, 0) >= 0)')} AS positive_units"""
OVERALL = rounded("(no_null_units_sold + no_null_total_sales + no_null_region + positive_sales + positive_units"
                  " + no_duplicate_rows) / 6")


def scores(source: str) -> str:
    return f"""
rules AS (
  SELECT a.*, {rounded('(1 - cast(total_rows - n_distinct AS double) / total_rows) * 100')} AS no_duplicate_rows
  FROM (SELECT batch_no, count(*) AS total_rows, {RULES} FROM {source} GROUP BY batch_no) a
  JOIN (SELECT batch_no, count(*) AS n_distinct FROM (SELECT DISTINCT * FROM {source}) GROUP BY batch_no) d
    USING (batch_no)),
scored AS (
  SELECT *, CASE WHEN dq_score >= 80 THEN 'PASSED' ELSE 'BLOCKED' END AS status FROM (
    SELECT *, {OVERALL} AS dq_score FROM rules))"""


SCORED = f"WITH {DIRTY}, {scores('dirty')}"
RULE_NAMES = [
    "no_null_units_sold", "no_null_total_sales", "no_null_region", "positive_sales", "positive_units",
    "no_duplicate_rows",
]
LOG_FIGURES = """total_rows,
  cast(floor(total_rows * dq_score / 100) AS bigint) AS passed_rows,
  cast(floor(total_rows * (1 - dq_score / 100)) AS bigint) AS failed_rows, dq_score, status"""
LOG = "\nUNION ALL ".join(
    f"SELECT 'ventes-' || batch_no AS batch_id, batch_no, {LOG_FIGURES}, '{r}' AS rule, {r} AS score FROM scored"
    for r in RULE_NAMES
)

EVENTS = """
sales AS (
  SELECT event_id AS seq, CASE WHEN event_type <> 'error' THEN event_type END AS region,
         cast(user_id AS varchar) AS retailer,
         cast(json_extract_string(props, '$.k') AS decimal(12,2)) AS units_sold,
         CASE WHEN event_id % 7 = 3 THEN -cast(value AS decimal(14,2)) ELSE cast(value AS decimal(14,2)) END
           AS total_sales,
         cast(0 AS bigint) AS source_partition, event_id // 100 AS batch_no, ts
  FROM events)"""
EVENT_COLUMNS = """seq, region, retailer, cast(units_sold AS double) AS units_sold,
  cast(total_sales AS double) AS total_sales"""

# ── dataset checks ───────────────────────────────────────────────────────────
FEED_COLUMNS = [c.strip() for c in f"{KEYS}, {TEXTS}".split(",")] + [
    "units_sold", "total_sales", "price_per_unit", "operating_profit", "operating_margin",
]
GUARDED = ["units_sold", "total_sales"]
NULL_SHARE = "cast(count(*) - count({c}) AS double) / count(*) * 100"
NULL_RATES = "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, {rounded(NULL_SHARE.format(c=c), 1)} AS null_rate,"
    f" {NULL_SHARE.format(c=c)} > 30 AS too_high FROM dirty"
    for c in FEED_COLUMNS
)
NEGATIVES = "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} < 0) AS negatives FROM dirty" for c in GUARDED
)
CHECKS = f"""
facts AS (SELECT count(*) AS n FROM dirty),
uniques AS (SELECT count(*) AS n FROM (SELECT DISTINCT * FROM dirty)),
rates AS ({NULL_RATES}),
negs AS ({NEGATIVES}),
empty AS (SELECT count(*) AS n FROM dirty WHERE {' AND '.join(f'{c} IS NULL' for c in FEED_COLUMNS)}),
checks AS (
  SELECT 'no_empty_rows' AS name, n = 0 AS passed, n || ' lignes vides' AS detail FROM empty
  UNION ALL SELECT 'no_duplicates', facts.n = uniques.n, (facts.n - uniques.n) || ' doublons' FROM facts, uniques
  UNION ALL SELECT 'min_rows', n >= 10, n || ' lignes' FROM facts
  UNION ALL SELECT 'null_rate_ok', count(*) = 0,
    CASE WHEN count(*) = 0 THEN 'OK' ELSE 'Colonnes >30% null: {{'
      || string_agg('''' || column_name || ''': ' || null_rate, ', ') || '}}' END FROM rates WHERE too_high
  UNION ALL SELECT 'positive_values', count(*) = 0,
    CASE WHEN count(*) = 0 THEN 'OK' ELSE '['
      || string_agg('''' || column_name || ': ' || negatives || ' valeurs négatives''', ', '
                    ORDER BY column_name DESC) || ']' END FROM negs WHERE negatives > 0)"""

# ── cleaning ─────────────────────────────────────────────────────────────────
VALID = "units_sold >= 0 AND total_sales >= 0 AND region IS NOT NULL"


def fenced(name: str, source: str, column: str, k: float) -> str:
    return f"""
{name}_q AS (SELECT quantile_cont(cast({column} AS double), 0.25) AS q1,
                    quantile_cont(cast({column} AS double), 0.75) AS q3 FROM {source}),
{name} AS (SELECT s.* FROM {source} s, {name}_q
           WHERE cast({column} AS double) BETWEEN q1 - {k} * (q3 - q1) AND q3 + {k} * (q3 - q1))"""


KPI_MONTHLY = f"""
SELECT {MONTH} AS mois, region, product,
       coalesce(cast(sum(total_sales) AS double), 0) AS ca_total,
       coalesce(cast(sum(operating_profit) AS double), 0) AS profit_total,
       coalesce(cast(sum(units_sold) AS double), 0) AS unites_total,
       {mean('price_per_unit')} AS panier_moyen, {mean('operating_margin')} AS marge_moyenne,
       count(*) AS nb_transactions, {mean('operating_margin')} * 100 AS marge_pct
FROM {{source}} WHERE region IS NOT NULL AND product IS NOT NULL AND date_vente IS NOT NULL GROUP BY 1, 2, 3"""

REGION_STATS = f"""
SELECT region, mois, cast(sum(sales) AS double) AS total_sales, {rounded_mean('sales', 2)} AS avg_sales,
       count(*) AS count_transactions, cast(min(sales) AS double) AS min_sales,
       cast(max(sales) AS double) AS max_sales
FROM {{source}} GROUP BY region, mois"""

GLOBAL = f"""
SELECT count(*) AS total_transactions, cast(sum(total_sales) AS double) AS ca_total,
       cast(sum(operating_profit) AS double) AS profit_total,
       {mean('operating_margin')} * 100 AS marge_moyenne_pct, {mean('units_sold')} AS panier_moyen_unites,
       min(date_vente) AS date_debut, max(date_vente) AS date_fin FROM {{source}}"""

# ── split and features ───────────────────────────────────────────────────────
TIES = f"{KEYS}, units_sold, total_sales"
SPLIT = f"""
split AS (
  SELECT *, row_number() OVER (PARTITION BY region ORDER BY date_vente,
              substr(md5(concat_ws('|', {TIES})), 1, 4), {TIES})
            <= greatest(1, cast(floor(count(*) OVER (PARTITION BY region) * cast(0.8 AS double)) AS bigint))
              AS is_train
  FROM feed)"""
CALENDAR = """cast(month({d}) AS integer) AS month_num, cast(year({d}) AS integer) AS year_num,
  cast(isodow({d}) - 1 AS integer) AS day_of_week"""
FEATURES = f"""
features AS (
  SELECT retailer, cast(sum(total_sales) AS double) AS ca_total, count(*) AS nb_transactions,
         {mean('operating_margin')} AS marge_moy FROM feed GROUP BY retailer)"""


def scaled(column: str) -> str:
    return (
        f"round(CASE WHEN stddev_pop({column}) OVER () = 0 THEN 0 ELSE"
        f" ({column} - avg({column}) OVER ()) / stddev_pop({column}) OVER () END, 6) AS {column}"
    )


STAR_COLUMNS = f"""{KEYS}, date_vente, {AMOUNTS}, region, product, beverage_brand AS brand"""

JSON_TEXTS = ["date_vente", "region", "product", "beverage_brand", "retailer"]
JSON = " || ',' || ".join(
    f"""'"{c}":"' || {c} || '"'""" if c in JSON_TEXTS else f"""'"{c}":' || {c}"""
    for c in [c.strip() for c in f"{KEYS}, {TEXTS}".split(",")]
    + ["units_sold", "total_sales", "price_per_unit", "operating_profit", "operating_margin"]
)

ORACLE: dict[str, str] = {
    "csv_scan": f"WITH {FEED} SELECT {ALL} FROM feed",
    "header_normalize": f"""WITH {TEXT} SELECT {KEYS}, retailer, invoice_date, region, beverage_brand, product,
        units_sold, total_sales, operating_margin FROM raw""",
    "role_detect": f"""WITH {TEXT} SELECT region, invoice_date AS date, total_sales AS sales,
        units_sold AS units, operating_margin AS margin, product FROM raw""",
    "event_publish": f"""WITH {FEED} SELECT '{{' || {JSON}
        || ',"batch_id":"run-1","event_time":"2024-01-01T00:00:00.000"}}' AS value FROM feed""",
    "event_ingest": f"WITH {FEED} SELECT {ALL}, 'run-1' AS batch_id FROM feed",
    "clean_export": f"""WITH {TEXT},
        ok AS (SELECT DISTINCT * FROM parsed WHERE sales >= 0 AND units >= 0 AND region IS NOT NULL),
        {fenced('kept', 'ok', 'sales', 1.5)}
        SELECT {KEYS}, retailer AS _retailer_, invoice_date, region, beverage_brand, product,
          cast(units AS double) AS units_sold, cast(sales AS double) AS total_sales, operating_margin FROM kept""",
    "csv_quoted": f"""WITH {FEED} SELECT {KEYS}, cast(total_sales AS double) AS total_sales,
        CASE WHEN l_linenumber % 3 = 0 THEN 'The "' || retailer || '", Ltd'
             ELSE retailer || chr(10) || 'branch ' || l_linenumber END AS retailer FROM feed""",
    "csv_inferred": """SELECT o_orderkey AS key, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey END AS gaps,
        cast(o_orderkey + CASE WHEN o_orderkey % 101 = 5 THEN 0.25 ELSE 0 END AS double) AS widened,
        cast(o_orderkey * CASE WHEN o_orderkey % 103 = 7 THEN 100 ELSE 1 END AS double) AS floating,
        CASE WHEN o_orderkey % 107 = 11 THEN 'n.v.' ELSE cast(o_orderkey AS varchar) END AS mixed,
        cast(o_orderdate AS date) AS day, cast(NULL AS varchar) AS empty, 'a "' || o_orderstatus || '", b' AS quoted FROM orders""",
    "csv_type_profile": """WITH texts AS (SELECT unnest([
          {'column': 'key', 'v': k}, {'column': 'gaps', 'v': CASE WHEN o_orderkey % 3 <> 0 THEN k END},
          {'column': 'widened', 'v': k || CASE WHEN o_orderkey % 101 = 5 THEN '.25' ELSE '' END},
          {'column': 'floating', 'v': k || CASE WHEN o_orderkey % 103 = 7 THEN 'e2' ELSE '' END},
          {'column': 'mixed', 'v': CASE WHEN o_orderkey % 107 = 11 THEN 'n.v.' ELSE k END},
          {'column': 'day', 'v': strftime(o_orderdate, '%Y-%m-%d')}, {'column': 'empty', 'v': NULL},
          {'column': 'quoted', 'v': 'a "' || o_orderstatus || '", b'}], recursive := true)
          FROM (SELECT *, cast(o_orderkey AS varchar) AS k FROM orders)),
        shapes AS (SELECT *, regexp_full_match(v, '[0-9]+([.][0-9]+)?') AS plain FROM texts)
        SELECT "column", count(v) AS n, count(*) FILTER (regexp_full_match(v, '[0-9]+')) AS n_whole, count(*) FILTER (plain) AS n_plain,
          count(*) FILTER (try_cast(v AS double) IS NOT NULL) AS n_double, count(*) FILTER (try_strptime(v, '%Y-%m-%d') IS NOT NULL) AS n_date,
          max(CASE WHEN plain THEN length(regexp_extract(v, '^0*([0-9]*)', 1)) END) AS digits,
          max(CASE WHEN plain THEN length(regexp_extract(v, '[.]([0-9]*)$', 1)) END) AS scale FROM shapes GROUP BY "column\"""",
    "file_export_wide": f"""WITH {WIDE}, {fenced('kept', 'wide_ok', 'sales', 1.5)}
        SELECT {KEYS}, units AS units_sold, sales AS total_sales FROM kept""",
    "file_region_wide": f"""WITH {WIDE}, {fenced('kept', 'wide_ok', 'sales', 1.5)},
        f AS (SELECT region, cast(sales AS decimal(38,6)) AS sales, strftime(date_parsed, '%Y-%m') AS mois FROM kept)
        SELECT region, mois, cast(round(sum(sales), 2) AS double) AS total_sales,
          cast((2 * cast(sum(sales) * 1000000 AS hugeint) + 10000 * count(*)) // (20000 * count(*)) AS double) / 100 AS avg_sales,
          count(*) AS count_transactions, cast(round(min(sales), 2) AS double) AS min_sales,
          cast(round(max(sales), 2) AS double) AS max_sales FROM f GROUP BY region, mois""",
    "fact_load": f"""WITH {DIRTY}, r AS ({REGION_IDS}), p AS ({PRODUCT_IDS}), c AS ({RETAILER_IDS})
        SELECT {KEYS}, date_vente, r.id AS region_id, p.id AS produit_id, c.id AS retailer_id, {AMOUNTS},
          100 AS dq_score, {MONTH} AS mois
        FROM dirty JOIN r ON coalesce(region, 'Unknown') = r.name
        JOIN p ON product = p.name AND beverage_brand = p.brand JOIN c ON retailer = c.name""",
    "dq_log": f"{SCORED} {LOG}",
    "numeric_cast": f"""WITH {TEXT} SELECT {KEYS}, cast(units AS double) AS units_sold,
        cast(sales AS double) AS total_sales FROM parsed""",
    "numeric_cast_wide": f"WITH {WIDE} SELECT {KEYS}, units AS units_sold, sales AS total_sales FROM wide",
    "percent_parse": f"""WITH {TEXT} SELECT {KEYS},
        cast(cast(cast(replace(operating_margin, '%', '') AS decimal(12,6)) / 100 AS decimal(6,4)) AS double)
          AS operating_margin FROM raw""",
    "text_defaults": f"""WITH {TEXT} SELECT {KEYS}, coalesce(region, 'Unknown') AS region,
        coalesce(product, beverage_brand, 'Unknown') AS product, coalesce(beverage_brand, '') AS beverage_brand,
        coalesce(retailer, 'Unknown') AS retailer FROM raw""",
    "date_parse_fallback": f"""WITH {TEXT} SELECT {KEYS},
        coalesce(date_parsed, date '2023-01-01') AS date_vente FROM parsed""",
    "date_parse_multi": f"""WITH {TEXT} SELECT {KEYS}, date_parsed,
        strftime(date_parsed, '%Y-%m') AS mois FROM parsed""",
    "drop_incomplete": f"""WITH {DIRTY} SELECT {ALL} FROM dirty
        WHERE units_sold IS NOT NULL AND total_sales IS NOT NULL AND region IS NOT NULL""",
    "non_negative": f"WITH {DIRTY} SELECT {ALL} FROM dirty WHERE units_sold >= 0 AND total_sales >= 0",
    "dedupe": f"WITH {DIRTY} SELECT DISTINCT {ALL} FROM dirty",
    "iqr_exact": f"""WITH {DIRTY}, {fenced('a', 'dirty', 'units_sold', 3)}, {fenced('b', 'a', 'total_sales', 3)}
        SELECT {ALL} FROM b""",
    "iqr_exact_15": f"WITH {DIRTY}, {fenced('a', 'dirty', 'total_sales', 1.5)} SELECT {ALL} FROM a",
    "calendar_features": f"WITH {FEED} SELECT {KEYS}, date_vente, {CALENDAR.format(d='date_vente')} FROM feed",
    "forecast_eligible": f"""WITH {FEED}, n AS (SELECT retailer, count(*) AS n_rows FROM feed GROUP BY retailer)
        SELECT retailer, n_rows, greatest(1, cast(floor(n_rows * cast(0.8 AS double)) AS bigint)) AS n_train
        FROM n WHERE n_rows >= 30""",
    "dim_upsert": f"""WITH
        old AS ({members("SELECT DISTINCT p_name AS name, p_brand AS brand FROM part WHERE p_size < 25",
                         "name || '|' || brand", "name, brand")}),
        new AS ({members('''SELECT DISTINCT p_name AS name, p_brand AS brand FROM part
                            EXCEPT SELECT name, brand FROM old''', "name || '|' || brand", "name, brand")})
        SELECT id AS produit_id, name AS product_name, brand AS beverage_brand, cast(NULL AS varchar) AS category
        FROM old UNION ALL
        SELECT id + (SELECT max(id) FROM old), name, brand, NULL FROM new""",
    "star_join": f"WITH {FEED} SELECT {STAR_COLUMNS}, retailer FROM feed",
    "star_join_left": f"""WITH {FEED} SELECT {STAR_COLUMNS},
        CASE WHEN retailer NOT LIKE '%7' THEN retailer END AS retailer FROM feed""",
    "kpi_monthly": f"WITH {DIRTY} {KPI_MONTHLY.format(source='dirty')}",
    "kpi_region_month": f"""WITH {TEXT}, f AS (SELECT region, sales, strftime(date_parsed, '%Y-%m') AS mois
        FROM parsed) {REGION_STATS.format(source='f')}""",
    "kpi_trend": f"""WITH {TEXT} SELECT strftime(date_parsed, '%Y-%m') AS mois,
        cast(sum(sales) AS double) AS total_sales, count(*) AS count_transactions,
        {rounded_mean('sales', 2)} AS avg_sales FROM parsed GROUP BY 1""",
    "view_region_month": f"""WITH {FEED} SELECT {MONTH} AS mois, region, product AS produit,
        beverage_brand AS marque, cast(sum(units_sold) AS double) AS total_unites,
        cast(sum(total_sales) AS double) AS total_ca, {mean('price_per_unit')} AS prix_moyen,
        cast(sum(operating_profit) AS double) AS total_profit, {mean('operating_margin')} * 100 AS marge_pct
        FROM feed GROUP BY 1, 2, 3, 4""",
    "view_global_kpis": f"WITH {DIRTY} {GLOBAL.format(source='dirty')}",
    "report_global_kpis": f"WITH {FEED} {GLOBAL.format(source='feed')}",
    "report_sales_by_region": f"""WITH {FEED} SELECT region, cast(sum(total_sales) AS double) AS ca,
        cast(sum(units_sold) AS double) AS unites FROM feed GROUP BY region ORDER BY ca DESC, region""",
    "report_monthly_by_region": f"""WITH {FEED} SELECT {MONTH} AS mois, region,
        cast(sum(total_sales) AS double) AS ca FROM feed GROUP BY 1, 2 ORDER BY 1, 2""",
    "report_top_products": f"""WITH {FEED} SELECT product, beverage_brand AS brand,
        cast(sum(total_sales) AS double) AS ca, cast(sum(units_sold) AS double) AS unites
        FROM feed GROUP BY 1, 2 ORDER BY sum(total_sales) DESC, product, brand LIMIT 10""",
    "report_margin_by_region": f"""WITH {FEED} SELECT region,
        cast((200000000 * cast(sum(operating_margin) * 10000 AS hugeint) // (10000 * count(*)) + 10000)
             // 20000 AS double) / 100 AS marge_pct FROM feed GROUP BY region ORDER BY marge_pct DESC, region""",
    "report_sales_by_month": f"""WITH {FEED} SELECT {MONTH} AS mois, cast(sum(total_sales) AS double) AS ca_total
        FROM feed GROUP BY 1 ORDER BY 1""",
    "report_dq_history": f"""{SCORED} SELECT 'ventes-' || batch_no AS batch_id, dq_score, status, total_rows
        FROM scored ORDER BY batch_no DESC LIMIT 20""",
    "distinct_regions": f"WITH {DIRTY} SELECT DISTINCT region FROM dirty",
    "retailer_features": f"WITH {FEED}, {FEATURES} SELECT * FROM features",
    "dq_rules": f"{SCORED} SELECT batch_no, total_rows, {', '.join(RULE_NAMES)} FROM scored",
    "dq_score": f"{SCORED} SELECT batch_no, total_rows, dq_score, status FROM scored",
    "dq_gate": f"""{SCORED} SELECT {ALL} FROM dirty
        WHERE batch_no IN (SELECT batch_no FROM scored WHERE status = 'PASSED')""",
    "dq_rejects": f"""{SCORED} SELECT {ALL} FROM dirty
        WHERE batch_no IN (SELECT batch_no FROM scored WHERE status = 'BLOCKED')""",
    "dq_dataset_checks": f"WITH {DIRTY}, {CHECKS} SELECT name, passed, detail FROM checks",
    "dq_null_rates": f"WITH {DIRTY} {NULL_RATES}",
    "dq_negative_columns": f"WITH {DIRTY} {NEGATIVES}",
    "dq_dataset_score": f"""WITH {DIRTY}, {CHECKS}
        SELECT cast(round_even(100.0 * count(*) FILTER (WHERE passed) / 5, 0) AS integer) AS dq_score,
          round_even(100.0 * count(*) FILTER (WHERE passed) / 5, 0) >= 80 AS passed,
          'no_duplicates, positive_values' AS failed_checks
        FROM checks HAVING list_sort(list(name) FILTER (WHERE NOT passed)) = ['no_duplicates', 'positive_values']""",
    "stream_gate": f"""WITH {EVENTS}, {scores('sales')} SELECT {EVENT_COLUMNS}, source_partition, batch_no FROM sales
        WHERE batch_no IN (SELECT batch_no FROM scored WHERE status = 'PASSED')""",
    "stream_scores": f"""WITH {EVENTS}, {scores('sales')} SELECT 'ventes-0-' || batch_no AS batch_id,
        cast(0 AS bigint) AS source_partition, batch_no, {LOG_FIGURES} FROM scored""",
    "dq_event_identity": f"""WITH e AS (SELECT event_id FROM events UNION ALL
          SELECT event_id FROM events WHERE event_id % 450 = 7)
        SELECT event_id // 100 AS batch_no, count(*) AS total_rows,
          {rounded('(1 - cast(count(*) - count(DISTINCT event_id) AS double) / count(*)) * 100')} AS no_duplicate_rows
        FROM e GROUP BY 1""",
    "stream_dedupe": f"WITH {EVENTS} SELECT {EVENT_COLUMNS} FROM sales",
    "train_test_split": f"""WITH {FEED}, {SPLIT} SELECT region, date_vente, {KEYS},
        cast(units_sold AS double) AS units_sold, cast(total_sales AS double) AS total_sales, is_train FROM split""",
    "retailer_features_scaled": f"""WITH {FEED}, {FEATURES}
        SELECT retailer, {scaled('ca_total')}, {scaled('nb_transactions')}, {scaled('marge_moy')} FROM features""",
    "segments_nearest": f"""WITH {FEED} SELECT DISTINCT retailer, true AS is_nearest, true AS falling,
        'Premium,Standard,Basique' AS labels FROM feed""",
    "forecast_bounds": f"""WITH {FEED} SELECT region, true AS within FROM feed GROUP BY region HAVING count(*) >= 10""",
    "forecast_training": f"""WITH {FEED}, {SPLIT} SELECT region, is_train, {CALENDAR.format(d='date_vente')},
        count(*) AS n_sales, cast(sum(total_sales) AS double) AS sum_sales,
        cast(sum(cast(total_sales * total_sales AS decimal(38,4))) AS double) AS sum_squares,
        {mean('total_sales')} AS mean_sales
        FROM split GROUP BY region, is_train, month_num, year_num, day_of_week""",
    "forecast_rmse_exact": f"""WITH {FEED}, {SPLIT}, means AS (
          SELECT region, cast(sum(total_sales) AS double) / count(*) AS predicted FROM split WHERE is_train GROUP BY region)
        SELECT region, round(sqrt(avg((cast(total_sales AS double) - predicted) ** 2)), 4) AS rmse
        FROM split JOIN means USING (region) WHERE NOT is_train GROUP BY region""",
    "forecast_frame": f"""WITH {FEED}, ahead AS (
          SELECT region, step, cast(max(date_vente) + to_months(cast(step AS integer)) AS date) AS date_vente
          FROM feed, unnest(range(1, 4)) AS s(step) GROUP BY region, step)
        SELECT region, cast(step AS integer) AS step, date_vente, {CALENDAR.format(d='date_vente')} FROM ahead""",
    "job_monthly_kpi": f"""WITH {DIRTY},
        ok AS (SELECT * REPLACE (coalesce(region, 'Unknown') AS region) FROM dirty
               WHERE units_sold >= 0 AND total_sales >= 0),
        {fenced('a', 'ok', 'units_sold', 3)}, {fenced('b', 'a', 'total_sales', 3)}
        {KPI_MONTHLY.format(source='b')}""",
    "job_region_kpi": f"""WITH {DIRTY}, ok AS (SELECT DISTINCT * FROM dirty WHERE {VALID}),
        {fenced('kept', 'ok', 'total_sales', 1.5)},
        f AS (SELECT region, total_sales AS sales, {MONTH} AS mois FROM kept)
        {REGION_STATS.format(source='f')}""",
    "job_gate_report": f"""{SCORED} SELECT coalesce(region, 'Unknown') AS region,
        cast(sum(total_sales) AS double) AS ca, cast(sum(units_sold) AS double) AS unites
        FROM dirty WHERE batch_no IN (SELECT batch_no FROM scored WHERE status = 'PASSED') GROUP BY 1""",
}

#: The views kept by slices return what the plain ones do.
ORACLE |= {"kept_region_month": ORACLE["view_region_month"], "kept_global_kpis": ORACLE["view_global_kpis"],
           "kept_sales_by_month": ORACLE["report_sales_by_month"]}
