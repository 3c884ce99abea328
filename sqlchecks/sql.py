"""Building blocks of the checking SQL (DuckDB dialect).

The statements compute with whole cents and integer division, so their rounding
is exact and independent of the engine under test.
"""

# Same bindings of the generated tables as the Spark adapter, written as views.
PRELUDE = """
WITH customer_master AS (
  SELECT c_custkey AS Customer_ID,
         CASE c_custkey % 2 WHEN 0 THEN 'F' ELSE 'M' END AS Gender,
         CASE WHEN c_acctbal < 0 THEN '0-17' WHEN c_acctbal < 1500 THEN '18-25'
              WHEN c_acctbal < 3000 THEN '26-35' WHEN c_acctbal < 4500 THEN '36-45'
              WHEN c_acctbal < 6000 THEN '46-50' WHEN c_acctbal < 8000 THEN '51-55'
              ELSE '55+' END AS Age,
         c_mktsegment AS Occupation, r_name AS City_Category,
         CASE c_nationkey % 5 WHEN 4 THEN '4+' ELSE CAST(c_nationkey % 5 AS VARCHAR) END AS Stay,
         CASE c_custkey % 3 WHEN 0 THEN 1 ELSE 0 END AS Marital_Status
  FROM customer, nation, region
  WHERE c_nationkey = n_nationkey AND n_regionkey = r_regionkey
), product_master AS (
  SELECT 'P' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS Product_ID,
         p_type AS Product_Category, CAST(p_retailprice AS DECIMAL(10,2)) AS price,
         CAST(CAST(p_retailprice AS DECIMAL(10,2)) * 100 AS BIGINT) AS price_cents,
         s_nationkey AS storeID, n_name AS storeName,
         s_suppkey AS supplierID, s_name AS supplierName
  FROM part, supplier, nation
  WHERE s_suppkey = p_partkey % (SELECT count(*) FROM supplier) AND s_nationkey = n_nationkey
), transactional_data AS (
  SELECT l_orderkey AS orderID, o_custkey AS Customer_ID,
         'P' || lpad(CAST(l_partkey AS VARCHAR), 8, '0') AS Product_ID,
         CAST(l_quantity AS INTEGER) AS quantity, CAST(o_orderdate AS DATE) AS order_date
  FROM lineitem, orders WHERE l_orderkey = o_orderkey
), sold AS (
  SELECT *, CAST(quantity AS BIGINT) * price_cents AS cents,
         CAST(year(order_date) AS INTEGER) AS y, CAST(month(order_date) AS INTEGER) AS mon,
         CAST(quarter(order_date) AS INTEGER) AS qtr,
         strftime(order_date, '%Y-%m') AS ym,
         CASE WHEN isodow(order_date) > 5 THEN 'Weekend' ELSE 'Weekday' END AS day_type,
         CASE WHEN month(order_date) BETWEEN 3 AND 5 THEN 'Spring'
              WHEN month(order_date) BETWEEN 6 AND 8 THEN 'Summer'
              WHEN month(order_date) BETWEEN 9 AND 11 THEN 'Fall' ELSE 'Winter' END AS season
  FROM transactional_data JOIN product_master USING (Product_ID)
), sold_to AS (
  SELECT * FROM sold JOIN customer_master USING (Customer_ID)
), latest AS (
  SELECT max(order_date) AS day FROM transactional_data
)"""

LATEST_YEAR = "y = (SELECT year(day) FROM latest)"

ORDERS = "count(DISTINCT orderID) AS {}"
BUYERS = "count(DISTINCT Customer_ID) AS {}"
UNITS = "CAST(sum(quantity) AS BIGINT) AS {}"


def statement(body: str) -> str:
    """A query over the prelude; ``body`` may open with ``, name AS (…)``."""
    return PRELUDE + body


def half_up(numerator: str, denominator: str) -> str:
    """Integer quotient rounded half away from zero (positive denominator)."""
    n, d = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)"
    return f"(CASE WHEN {n} < 0 THEN -1 ELSE 1 END * ((2 * abs({n}) + {d}) // (2 * {d})))"


def decimal(units: str, digits: int, precision: int = 20) -> str:
    """Integer ``units`` of 10^-digits as a decimal."""
    unit = "0." + "0" * (digits - 1) + "1"
    return f"CAST(CAST({units} AS DECIMAL(30,0)) * {unit} AS DECIMAL({precision},{digits}))"


def money(cents: str) -> str:
    return decimal(cents, 2)


def revenue(name: str, where: str | None = None) -> str:
    source = "cents" if where is None else f"CASE WHEN {where} THEN cents ELSE 0 END"
    return f"{money(f'sum({source})')} AS {name}"


def mean(total: str, n: str, name: str) -> str:
    return f"{money(half_up(total, n))} AS {name}"


MEAN_LINE = mean("sum(cents)", "count(cents)", "avg_per_transaction")
PER_BUYER = mean("sum(cents)", "count(DISTINCT Customer_ID)", "avg_per_customer")


def percent(part: str, whole: str, digits: int) -> str:
    """NULL unless ``whole`` is positive."""
    scale = 10 ** digits
    quotient = half_up(f"({part}) * {100 * scale}", whole)
    return f"CASE WHEN {whole} > 0 THEN CAST({quotient} AS DOUBLE) / {float(scale)} END"


def share(part: str, whole: str) -> str:
    return f"coalesce({percent(part, whole, 1)}, 0.0)"


def mean_growth(now: str, before: str, absolute: bool = False) -> str:
    """Average of ratios kept to six decimals, as a percentage to two."""
    ratio = f"CASE WHEN {before} > 0 THEN {half_up(f'({now} - {before}) * 1000000', before)} END"
    if absolute:
        ratio = f"abs({ratio})"
    quotient = half_up(f"sum({ratio})", f"(count({ratio}) * 100)")
    return f"CASE WHEN count({ratio}) > 0 THEN CAST({quotient} AS DOUBLE) / 100.0 END"


def listed(value: str, listing: list[str]) -> str:
    items = ", ".join(f"'{v}'" for v in listing)
    return f"list_position([{items}], {value})"
