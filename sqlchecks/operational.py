"""Checking SQL for the reports over the operational tables."""

from sqlchecks.sql import (BUYERS, LATEST_YEAR, MEAN_LINE, ORDERS, PER_BUYER, UNITS, decimal,
                        half_up, listed, mean, mean_growth, money, percent, revenue, share,
                        statement)

ORD, CUST, QTY = (x.format(n) for x, n in [
    (ORDERS, "total_orders"), (BUYERS, "unique_customers"), (UNITS, "total_quantity")])
AGES = "list_position(['0-17','18-25','26-35','36-45','46-50','51-55','55+'], Age)"
CITIES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
OCCUPATIONS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
SEASONS = ["Spring", "Summer", "Fall", "Winter"]
RECENT = "order_date > (SELECT day - INTERVAL 6 MONTH FROM latest)"


def _profile(key: str, total: str = "total_purchase", alias: str | None = None) -> str:
    return f"""SELECT {key} AS {alias or key}, {CUST}, {ORD}, {revenue(total)}, {MEAN_LINE},
      {PER_BUYER} FROM sold_to GROUP BY {key}"""


def _top_in_group(keys, group, tie, k, metrics, out, rank, source="sold", where="true"):
    """Rank groups by revenue inside ``group`` and keep the first k."""
    return f""", g AS (SELECT {keys}, sum(cents) AS c{metrics} FROM {source} WHERE {where}
        GROUP BY {keys}),
      r AS (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY c DESC, {tie}) AS {rank}
        FROM g)
      SELECT {out} FROM r WHERE {rank} <= {k}"""


def _changes(keys, group, order, where, value="cents", extra=""):
    return f""", g AS (SELECT {keys}, sum(cents) AS now{extra} FROM sold WHERE {where}
        GROUP BY {keys}),
      p AS (SELECT *, lag(now) OVER (PARTITION BY {group} ORDER BY {order}) AS before FROM g)"""


def statements(full_year: int) -> dict[str, str]:
    y = f"y = {full_year}"
    found: dict[str, str] = {}

    # best sellers
    found["q01_years"] = "SELECT DISTINCT CAST(year(order_date) AS INTEGER) AS year FROM transactional_data"
    found["q01_month_daytype_top5"] = _top_in_group(
        "y, mon, day_type, Product_ID, Product_Category", "y, mon, day_type",
        "Product_ID, Product_Category", 5, "",
        f"""y AS year, mon AS month, day_type, Product_ID, Product_Category,
            {money('c')} AS total_revenue, CAST(rnk AS INTEGER) AS rnk""", "rnk", where=LATEST_YEAR)
    found["q01_year_daytype_top5"] = _top_in_group(
        "day_type, Product_ID, Product_Category", "day_type", "Product_ID, Product_Category", 5, "",
        f"""day_type, Product_ID, Product_Category, {money('c')} AS total_revenue,
            CAST(rnk AS INTEGER) AS rnk""", "rnk", where=LATEST_YEAR)
    found["q11_month_daytype_top5"] = _top_in_group(
        "mon, ym, day_type, Product_ID, Product_Category", "mon, day_type",
        "Product_ID, Product_Category", 5, f", {QTY}, {ORDERS.format('order_count')}",
        f"""ym AS month_year, day_type, CAST(rk AS INTEGER) AS revenue_rank, Product_ID,
            Product_Category, {money('c')} AS total_revenue, total_quantity, order_count""",
        "rk", where=LATEST_YEAR)
    found["q11_daytype_top10"] = _top_in_group(
        "day_type, Product_ID, Product_Category", "day_type", "Product_ID, Product_Category", 10,
        f", {ORD}", f"""day_type, Product_ID, Product_Category, {money('c')} AS total_revenue,
            total_orders""", "rk", where=LATEST_YEAR)
    found["q11_daytype_gap_top10"] = f""", g AS (
        SELECT Product_ID, Product_Category, sum(cents) AS c,
               sum(cents) FILTER (day_type = 'Weekend') AS we,
               sum(cents) FILTER (day_type = 'Weekday') AS wd
        FROM sold WHERE {LATEST_YEAR} GROUP BY ALL)
      SELECT Product_ID, Product_Category, {money('we')} AS weekend_revenue,
             {money('wd')} AS weekday_revenue, {money('c')} AS total_revenue,
             {money('abs(we - wd)')} AS difference,
             if(we > wd, 'Weekend', 'Weekday') AS bias
      FROM g WHERE we > 0 AND wd > 0 ORDER BY abs(we - wd) DESC, Product_ID LIMIT 10"""

    # demographics
    found["q02_gender_age_city"] = f"""SELECT Gender, Age, City_Category, {ORD}, {QTY},
        {revenue('total_purchase_amount')},
        {mean('sum(cents)', 'count(cents)', 'avg_purchase_per_transaction')}
      FROM sold_to GROUP BY ALL"""
    found["q02_by_gender"] = found["q07_by_gender"] = _profile("Gender")
    found["q02_by_age"] = _profile("Age")
    found["q02_by_city"] = _profile("City_Category")
    cells = ", ".join(revenue("city_" + c.lower().replace(" ", "_"), f"City_Category = '{c}'")
                      for c in CITIES)
    cells += ", " + revenue("city_other", "City_Category IS NULL OR City_Category NOT IN ("
                            + ", ".join(f"'{c}'" for c in CITIES) + ")")
    found["q02_gender_city_pivot"] = f"""SELECT Gender, {cells}, {revenue('total_purchase')}
      FROM sold_to GROUP BY Gender"""
    found["q04_gender_age_quarter"] = f"""SELECT Gender, Age, qtr AS quarter, {CUST}, {ORD}, {QTY},
        {revenue('total_purchase')}, {MEAN_LINE} FROM sold_to WHERE {y} GROUP BY ALL"""

    # occupation and category
    found["q03_occ_category"] = f"""SELECT Occupation, Product_Category, {ORD}, {QTY},
        {revenue('total_sales')}, {mean('sum(cents)', 'count(cents)', 'avg_sale_per_transaction')}
      FROM sold_to GROUP BY ALL"""
    found["q03_by_occ"] = _profile("Occupation", "total_sales")
    found["q03_by_category"] = f"""SELECT Product_Category, {ORD}, {QTY}, {revenue('total_sales')},
        {MEAN_LINE}, {mean('sum(cents)', 'count(DISTINCT Product_ID)', 'avg_per_product')}
      FROM sold GROUP BY ALL"""
    found["q03_top10_occ_category"] = f"""SELECT Occupation, Product_Category, {revenue('total_sales')}
      FROM sold_to GROUP BY ALL ORDER BY sum(cents) DESC, 1, 2 LIMIT 10"""
    cells = ", ".join(revenue("occ_" + o.lower(), f"Occupation = '{o}'") for o in OCCUPATIONS)
    cells += ", " + revenue("occ_other", "Occupation IS NULL OR Occupation NOT IN ("
                            + ", ".join(f"'{o}'" for o in OCCUPATIONS) + ")")
    found["q03_top_category_matrix"] = f""", best AS (
        SELECT Product_Category FROM sold GROUP BY 1 ORDER BY sum(cents) DESC, 1 LIMIT 5)
      SELECT Product_Category, {cells} FROM sold_to SEMI JOIN best USING (Product_Category)
      GROUP BY 1"""
    found["q05_top5_occ_per_category"] = _top_in_group(
        "Product_Category, Occupation", "Product_Category", "Occupation", 5,
        f", {ORD}, {QTY}, {CUST}",
        f"""Product_Category, Occupation, total_orders, total_quantity,
            {money('c')} AS total_sales, unique_customers, CAST(rk AS INTEGER) AS sales_rank""",
        "rk", source="sold_to")
    found["q05_category_totals"] = _top_in_group(
        "Product_Category, Occupation", "Product_Category", "Occupation", 5, "",
        f"Product_Category, {money('sum(c)')} AS category_total", "rk",
        source="sold_to") + " GROUP BY 1"
    found["q05_top10_occ"] = f"""SELECT Occupation,
        count(DISTINCT Product_Category) AS categories_purchased, {CUST}, {ORD},
        {revenue('total_sales')}, {MEAN_LINE}
      FROM sold_to GROUP BY 1 ORDER BY sum(cents) DESC, 1 LIMIT 10"""
    found["q05_diversity"] = f"""SELECT Occupation,
        count(DISTINCT Product_Category) AS categories_count, {revenue('total_sales')}
      FROM sold_to GROUP BY 1"""

    # the last six months
    label = "if(Marital_Status = 0, 'Single', 'Married') AS marital_status"
    found["q06_date_range"] = """SELECT min(order_date) AS min_date, max(order_date) AS max_date
      FROM transactional_data"""
    found["q06_monthly"] = f"""SELECT City_Category, {label}, ym AS month_year, {ORD}, {CUST}, {QTY},
        {revenue('total_purchase')}
      FROM sold_to WHERE {RECENT} GROUP BY City_Category, sold_to.Marital_Status, ym"""
    found["q06_summary"] = f"""SELECT City_Category, {label}, {CUST}, {ORD}, {QTY},
        {revenue('total_purchase')}, {MEAN_LINE}, {PER_BUYER}
      FROM sold_to WHERE {RECENT} GROUP BY City_Category, sold_to.Marital_Status"""
    found["q06_city_marital_pivot"] = f""", g AS (
        SELECT coalesce(City_Category, 'TOTAL') AS City_Category,
               sum(if(Marital_Status = 0, cents, 0)) AS s, sum(if(Marital_Status = 0, 0, cents)) AS m
        FROM sold_to WHERE {RECENT} GROUP BY ROLLUP (City_Category))
      SELECT City_Category, {money('s')} AS single, {money('m')} AS married,
             {money('s + m')} AS total, {share('s', '(s + m)')} AS pct_single,
             {share('m', '(s + m)')} AS pct_married FROM g"""

    # stay and gender
    found["q07_stay_gender"] = f"""SELECT Stay AS stay_duration, Gender, {CUST}, {ORD}, {QTY},
        {revenue('total_purchase')}, {MEAN_LINE}, {PER_BUYER} FROM sold_to GROUP BY Stay, Gender"""
    found["q07_by_stay"] = _profile("Stay", alias="stay_duration")
    found["q07_stay_gender_pivot"] = f""", g AS (
        SELECT Stay, Gender, {half_up('sum(cents)', 'count(DISTINCT Customer_ID)')} AS a
        FROM sold_to GROUP BY 1, 2),
      h AS (SELECT Stay, coalesce(sum(a) FILTER (Gender = 'F'), 0) AS f,
                   coalesce(sum(a) FILTER (Gender = 'M'), 0) AS m FROM g GROUP BY 1)
      SELECT Stay AS stay_duration, {money('f')} AS female, {money('m')} AS male,
             {money('abs(m - f)')} AS difference,
             CASE sign(m - f) WHEN 1 THEN 'Male' WHEN -1 THEN 'Female' ELSE 'Equal' END
               AS higher_spender FROM h"""
    found["q07_top_stay"] = f"""SELECT Stay AS stay_duration, {BUYERS.format('customers')}, {PER_BUYER}
      FROM sold_to GROUP BY Stay ORDER BY avg_per_customer DESC, 1 LIMIT 1"""
    found["q07_top_gender"] = f"""SELECT Gender, {PER_BUYER} FROM sold_to GROUP BY 1
      ORDER BY avg_per_customer DESC, 1 LIMIT 1"""

    # cities
    found["q08_top5_city_per_category"] = f""", g AS (
        SELECT Product_Category, City_Category, {ORD}, {CUST}, {QTY}, sum(cents) AS c
        FROM sold_to GROUP BY 1, 2),
      r AS (SELECT *, sum(c) OVER (PARTITION BY Product_Category) AS w,
                   row_number() OVER (PARTITION BY Product_Category
                                      ORDER BY c DESC, City_Category) AS rk FROM g)
      SELECT Product_Category, City_Category, total_orders, unique_customers, total_quantity,
             {money('c')} AS total_revenue, CAST(rk AS INTEGER) AS revenue_rank,
             {percent('c', 'w', 2)} AS pct_of_category FROM r WHERE rk <= 5"""
    found["q08_city_summary"] = f""", g AS (
        SELECT City_Category, count(DISTINCT Product_Category) AS categories_sold, {CUST}, {ORD},
               sum(cents) AS c, {MEAN_LINE} FROM sold_to GROUP BY 1
        UNION ALL SELECT 'TOTAL', NULL, NULL, NULL, sum(cents), NULL FROM sold_to)
      SELECT City_Category, categories_sold, unique_customers, total_orders,
             {money('c')} AS total_revenue, avg_per_transaction,
             {share('c', '(SELECT sum(cents) FROM sold_to)')} AS pct_of_total FROM g"""

    # growth
    growth = percent("now - before", "before", 2)
    found["q09_mom_growth"] = _changes(
        "Product_Category, ym", "Product_Category", "ym", LATEST_YEAR, extra=f", {ORD}") + f"""
      , q AS (SELECT *, {growth} AS growth_pct, lag(ym) OVER (PARTITION BY Product_Category
                ORDER BY ym) AS prev_month FROM p)
      SELECT Product_Category, ym AS month_year, {money('now')} AS monthly_revenue, total_orders,
             {money('before')} AS prev_month_revenue, prev_month, growth_pct,
             CASE WHEN growth_pct IS NULL THEN '-' WHEN growth_pct > 10 THEN 'UP'
                  WHEN growth_pct > 0 THEN 'up' WHEN growth_pct < -10 THEN 'DOWN'
                  WHEN growth_pct < 0 THEN 'down' ELSE 'flat' END AS trend FROM q"""
    found["q09_avg_growth"] = _changes(
        "Product_Category, ym", "Product_Category", "ym", LATEST_YEAR) + f"""
      , q AS (SELECT Product_Category, count(*) AS months_analyzed,
                     {mean_growth('now', 'before')} AS avg_growth_pct,
                     {money('sum(now)')} AS total_revenue FROM p GROUP BY 1)
      SELECT *, CASE WHEN avg_growth_pct IS NULL THEN '-' WHEN avg_growth_pct > 5 THEN 'Strong Growth'
                     WHEN avg_growth_pct > 0 THEN 'Moderate Growth'
                     WHEN avg_growth_pct > -5 THEN 'Slight Decline' ELSE 'Declining' END
               AS performance FROM q"""
    found["q12_store_qoq"] = _changes(
        "storeID, storeName, qtr", "storeID", "qtr, storeName", y, extra=f", {ORD}, {CUST}") + f"""
      , q AS (SELECT *, {growth} AS growth_rate_pct, lag(qtr) OVER (PARTITION BY storeID
                ORDER BY qtr, storeName) AS pq FROM p)
      SELECT storeID, storeName, 'Q' || qtr AS quarter_label, {money('now')} AS quarterly_revenue,
             total_orders, unique_customers, {money('before')} AS prev_quarter_revenue,
             'Q' || pq AS prev_quarter, growth_rate_pct,
             CASE WHEN growth_rate_pct IS NULL THEN 'Baseline' WHEN growth_rate_pct > 10 THEN 'Strong'
                  WHEN growth_rate_pct > 0 THEN 'Growth' WHEN growth_rate_pct > -10 THEN 'Decline'
                  ELSE 'Sharp' END AS trend FROM q"""
    found["q12_store_avg_growth"] = _changes(
        "storeID, storeName, qtr", "storeID", "qtr, storeName", y) + f"""
      , q AS (SELECT storeID, storeName, count(*) AS quarters_with_data,
                     {money('sum(now)')} AS total_revenue,
                     {mean_growth('now', 'before')} AS avg_growth_rate FROM p GROUP BY 1, 2)
      SELECT *, CASE WHEN avg_growth_rate IS NULL THEN 'Insufficient Data'
                     WHEN avg_growth_rate > 15 THEN 'Excellent' WHEN avg_growth_rate > 5 THEN 'Good'
                     WHEN avg_growth_rate > 0 THEN 'Moderate'
                     WHEN avg_growth_rate > -5 THEN 'Needs Attention' ELSE 'Critical' END
               AS rating FROM q"""
    pair = "storeID, storeName, supplierID, supplierName"
    months = _changes(f"{pair}, ym", "storeID, supplierID", "ym, storeName, supplierName", "true")
    found["q15_mom_change"] = months + f"""
      , q AS (SELECT *, {growth} AS pct_change, lag(ym) OVER (PARTITION BY storeID, supplierID
                ORDER BY ym, storeName, supplierName) AS prev_month FROM p)
      SELECT {pair}, ym AS month_year, {money('now')} AS monthly_revenue,
             {money('before')} AS prev_revenue, prev_month, pct_change,
             CASE WHEN pct_change IS NULL THEN 'Baseline' WHEN abs(pct_change) > 50 THEN 'EXTREME'
                  WHEN abs(pct_change) > 25 THEN 'HIGH' WHEN abs(pct_change) > 10 THEN 'Moderate'
                  ELSE 'Stable' END AS volatility FROM q"""
    found["q15_top20_volatile"] = months + f"""
      , q AS (SELECT {pair}, count(*) AS months_count, {money('sum(now)')} AS total_revenue,
                     {mean_growth('now', 'before', True)} AS avg_volatility,
                     max({percent('abs(now - before)', 'before', 2)}) AS max_volatility
              FROM p GROUP BY {pair} HAVING count(*) > 1)
      SELECT *, CASE WHEN avg_volatility > 30 THEN 'HIGH' WHEN avg_volatility > 15 THEN 'Medium'
                     ELSE 'Low' END AS risk_level
      FROM q ORDER BY avg_volatility DESC NULLS LAST, storeID, supplierID LIMIT 20"""
    found["q15_top10_stable"] = months + f"""
      , q AS (SELECT {pair}, count(*) AS months_count, {money('sum(now)')} AS total_revenue,
                     {mean_growth('now', 'before', True)} AS avg_volatility
              FROM p GROUP BY {pair} HAVING count(*) > 3)
      SELECT * FROM q WHERE avg_volatility IS NOT NULL
      ORDER BY avg_volatility, storeID, supplierID LIMIT 10"""

    # age and day type
    found["q10_age_daytype"] = f"""SELECT Age, day_type, {CUST}, {ORD}, {QTY},
        {revenue('total_sales')}, {MEAN_LINE} FROM sold_to WHERE {LATEST_YEAR} GROUP BY ALL"""
    found["q10_age_daytype_crosstab"] = f""", g AS (
        SELECT Age, sum(if(day_type = 'Weekend', cents, 0)) AS we,
               sum(if(day_type = 'Weekday', cents, 0)) AS wd
        FROM sold_to WHERE {LATEST_YEAR} GROUP BY ROLLUP (Age))
      SELECT coalesce(Age, 'TOTAL') AS Age, {money('we')} AS weekend_sales,
             {money('wd')} AS weekday_sales, {money('we + wd')} AS total_sales,
             {share('we', '(we + wd)')} AS weekend_pct, {share('wd', '(we + wd)')} AS weekday_pct,
             CASE WHEN Age IS NULL THEN NULL WHEN we > wd THEN 'Weekend'
                  WHEN wd > we THEN 'Weekday' ELSE 'Equal' END AS higher FROM g"""
    found["q10_top3"] = f"""SELECT Age, day_type, {revenue('total_sales')} FROM sold_to
      WHERE {LATEST_YEAR} GROUP BY 1, 2 ORDER BY sum(cents) DESC, 1, 2 LIMIT 3"""

    # stores and suppliers
    found["q13_store_supplier_product"] = f"""SELECT {pair}, Product_ID, Product_Category, {ORD},
        {QTY}, {revenue('total_sales')} FROM sold GROUP BY ALL"""
    found["q13_subtotals"] = f"""SELECT {pair}, 'supplier' AS level, {revenue('total_sales')}
      FROM sold GROUP BY {pair}
      UNION ALL SELECT storeID, storeName, NULL, NULL, 'store', {revenue('total_sales')}
      FROM sold GROUP BY 1, 2"""
    found["q13_top3_suppliers"] = _top_in_group(
        pair, "storeID", "supplierID, supplierName, storeName", 3,
        ", count(DISTINCT Product_ID) AS products_sold",
        f"""{pair}, {money('c')} AS total_sales, products_sold,
            CAST(rk AS INTEGER) AS sales_rank""", "rk")

    # seasons
    found["q14_product_season"] = f"""SELECT Product_ID, Product_Category, season,
        {revenue('total_sales')}, {QTY}, {ORD} FROM sold GROUP BY ALL"""
    found["q14_best_season"] = _top_in_group(
        "Product_Category, season", "Product_Category", listed("season", SEASONS), 1, "",
        f"Product_Category, season, {money('c')} AS total_sales", "rk")
    cells = ", ".join(revenue(f"{s.lower()}_sales", f"season = '{s}'") for s in SEASONS)
    found["q14_category_season_crosstab"] = f"""SELECT Product_Category, {cells},
        {revenue('total_sales')} FROM sold GROUP BY 1"""

    # baskets
    visits = """, v AS (SELECT DISTINCT Customer_ID, order_date, {item} AS item FROM {source}),
      pairs AS (SELECT a.item AS i1, b.item AS i2, count(*) AS times
        FROM v a JOIN v b ON a.Customer_ID = b.Customer_ID AND a.order_date = b.order_date
         AND a.item < b.item GROUP BY 1, 2)"""
    top = visits.format(item="Product_ID", source="transactional_data") + """
      , top AS (SELECT i1 AS product_1, x.Product_Category AS category_1, i2 AS product_2,
                z.Product_Category AS category_2, times AS times_bought_together
         FROM pairs JOIN product_master x ON i1 = x.Product_ID
                    JOIN product_master z ON i2 = z.Product_ID
         WHERE times > 1 ORDER BY times DESC, i1, i2 LIMIT 20)"""
    found["q16_product_pairs"] = top + " SELECT * FROM top"
    found["q16_bundles"] = top + """
      SELECT CAST(row_number() OVER (ORDER BY times_bought_together DESC, product_1, product_2)
               AS INTEGER) AS bundle, * FROM top
      ORDER BY times_bought_together DESC, product_1, product_2 LIMIT 5"""
    found["q16_category_pairs"] = visits.format(item="Product_Category", source="sold") + f"""
      , top AS (SELECT * FROM pairs ORDER BY times DESC, i1, i2 LIMIT 15)
      SELECT i1 AS category_1, i2 AS category_2, times AS times_bought_together,
             CAST({half_up('times * 1000', '(SELECT max(times) FROM pairs)')} AS DOUBLE) / 10.0
               AS affinity_score FROM top"""
    found["q16_same_category"] = f""", g AS (
        SELECT Customer_ID, order_date, Product_Category, count(DISTINCT Product_ID) AS n
        FROM sold GROUP BY 1, 2, 3 HAVING n > 1)
      SELECT Product_Category, count(*) AS multi_product_sessions,
             CAST({half_up('sum(n) * 100', 'count(*)')} AS DOUBLE) / 100.0
               AS avg_products_per_session,
             max(n) AS max_products_in_session FROM g GROUP BY 1"""

    # yearly rollup
    found["q17_rollup"] = f"""SELECT storeName, supplierName, Product_ID,
        CASE GROUPING(storeName, supplierName, Product_ID) WHEN 0 THEN 'product'
          WHEN 1 THEN 'supplier' WHEN 3 THEN 'store' ELSE 'all' END AS level,
        {revenue('total_revenue')}, {QTY}, {ORD}
      FROM sold WHERE {LATEST_YEAR} GROUP BY ROLLUP (storeName, supplierName, Product_ID)"""
    found["q17_store_summary"] = f"""SELECT storeName, count(DISTINCT supplierID) AS supplier_count,
        count(DISTINCT Product_ID) AS product_count, {ORD}, {QTY}, {revenue('total_revenue')}
      FROM sold WHERE {LATEST_YEAR} GROUP BY 1
      UNION ALL SELECT 'TOTAL', NULL, NULL, NULL, NULL, {revenue('total_revenue')}
      FROM sold WHERE {LATEST_YEAR}"""

    # halves of a year
    def half(n):
        return f"mon {'<=' if n == 1 else '>'} 6"

    columns = ", ".join(
        f"""CAST(sum(if({half(n)}, quantity, 0)) AS BIGINT) AS h{n}_quantity,
            sum(if({half(n)}, cents, 0)) AS c{n},
            count(DISTINCT if({half(n)}, orderID, NULL)) AS h{n}_orders""" for n in (1, 2))
    found["q18_h1_h2"] = f""", g AS (
        SELECT Product_ID, Product_Category, {columns}, {UNITS.format('yearly_quantity')},
               {revenue('yearly_revenue')}, {ORDERS.format('yearly_orders')}
        FROM sold WHERE {y} GROUP BY 1, 2)
      SELECT * EXCLUDE (c1, c2), {money('c1')} AS h1_revenue, {money('c2')} AS h2_revenue,
             CASE WHEN c1 = 0 AND c2 = 0 THEN 'No Sales' WHEN c1 = 0 THEN 'H2 Only'
                  WHEN c2 = 0 THEN 'H1 Only' WHEN 10 * c2 > 12 * c1 THEN 'H2 Strong'
                  WHEN 10 * c1 > 12 * c2 THEN 'H2 Weak' ELSE 'Stable' END AS trend FROM g"""
    found["q18_category_h1_h2"] = f""", g AS (
        SELECT Product_Category, sum(if(mon <= 6, cents, 0)) AS a, sum(if(mon > 6, cents, 0)) AS b
        FROM sold WHERE {y} GROUP BY ROLLUP (Product_Category))
      SELECT coalesce(Product_Category, 'TOTAL') AS Product_Category, {money('a')} AS h1_revenue,
             {money('b')} AS h2_revenue, {money('a + b')} AS yearly_revenue,
             {share('a', '(a + b)')} AS h1_pct, {share('b', '(a + b)')} AS h2_pct,
             CASE WHEN Product_Category IS NULL THEN NULL
                  WHEN 10 * (b - a) > a + b THEN 'H2 Stronger'
                  WHEN 10 * (a - b) > a + b THEN 'H1 Stronger' ELSE 'Balanced' END
               AS performance FROM g"""
    found["q18_gap_top20"] = f""", g AS (
        SELECT Product_ID, Product_Category, sum(if(mon <= 6, cents, 0)) AS a,
               sum(if(mon > 6, cents, 0)) AS b FROM sold WHERE {y} GROUP BY 1, 2)
      SELECT Product_ID, Product_Category, {money('a')} AS h1_revenue, {money('b')} AS h2_revenue,
             {money('abs(a - b)')} AS difference, if(a > b, 'H1', 'H2') AS stronger_half
      FROM g WHERE least(a, b) > 0 AND 2 * greatest(a, b) > 3 * least(a, b)
      ORDER BY abs(a - b) DESC, Product_ID LIMIT 20"""

    # spikes
    days = """, d AS (SELECT Product_ID, Product_Category, order_date, sum(cents) AS c,
          CAST(sum(quantity) AS BIGINT) AS daily_quantity,
          count(DISTINCT orderID) AS daily_orders FROM sold GROUP BY 1, 2, 3),
      s AS (SELECT Product_ID, count(*) AS n, sum(c) AS t, stddev_pop(c / 100.0) AS sd
            FROM d GROUP BY 1 HAVING n >= 5),
      x AS (SELECT *, c * n > 2 * t AS high, c * n > 3 * t AS extreme
            FROM d JOIN s USING (Product_ID))"""
    average = f"{decimal(half_up('t * 10000', 'n'), 6, 24)} AS avg_daily_revenue"
    spikes = days + f"""
      , top AS (SELECT Product_ID, Product_Category, order_date,
             dayname(order_date) AS day_of_week, {money('c')} AS daily_revenue, daily_quantity,
             daily_orders, {average}, round(sd, 4) AS stddev_revenue,
             CAST({half_up('c * n * 100', 't')} AS DOUBLE) / 100.0 AS multiple_of_avg,
             if(extreme, 'EXTREME SPIKE (3x+)', 'HIGH SPIKE (2x-3x)') AS spike_classification
        FROM x WHERE high
        ORDER BY multiple_of_avg DESC, Product_ID, order_date LIMIT 50)"""
    found["q19_spikes"] = spikes + " SELECT * FROM top"
    found["q19_spike_class_counts"] = spikes + """
      SELECT spike_classification, count(*) AS spike_count FROM top GROUP BY 1"""
    found["q19_extreme_first5"] = spikes + """
      SELECT Product_ID, Product_Category, order_date, daily_revenue, multiple_of_avg FROM top
      WHERE spike_classification LIKE 'EXTREME%'
      ORDER BY multiple_of_avg DESC, Product_ID, order_date LIMIT 5"""
    found["q19_spike_frequency"] = days + f"""
      , f AS (SELECT Product_ID, Product_Category, n AS days_with_sales, t, n,
                     count(*) FILTER (high) AS spike_count, max(c) AS most
              FROM x GROUP BY ALL)
      SELECT Product_ID, Product_Category, days_with_sales, spike_count,
             CAST({half_up('spike_count * 1000', 'n')} AS DOUBLE) / 10.0 AS spike_pct,
             {average}, {money('most')} AS max_daily_revenue
      FROM f WHERE spike_count > 0
      ORDER BY spike_count DESC, Product_ID, Product_Category LIMIT 20"""
    found["q19_spike_by_weekday"] = days + f"""
      SELECT dayname(order_date) AS day_of_week, count(*) AS total_days,
             count(*) FILTER (high) AS spike_days,
             CAST({half_up('(count(*) FILTER (high)) * 10000', 'count(*)')} AS DOUBLE) / 100.0
               AS spike_pct FROM x GROUP BY 1"""

    # quarterly view
    view = f""", view AS (
        SELECT storeID, storeName, y AS sales_year, qtr AS sales_quarter,
               y || '-Q' || qtr AS year_quarter, {ORD}, {CUST}, {QTY}, {revenue('total_sales')},
               {mean('sum(cents)', 'count(cents)', 'avg_order_value')},
               count(DISTINCT Product_ID) AS products_sold,
               count(DISTINCT supplierID) AS suppliers_involved
        FROM sold GROUP BY storeID, storeName, y, qtr)"""
    found["q20_store_quarterly"] = found["q20_stored_quarters"] = view + " SELECT * FROM view"
    found["q20_preview"] = view + """ SELECT * FROM view
      ORDER BY storeName, sales_year, sales_quarter, storeID LIMIT 20"""
    found["q20_store_totals"] = view + """
      SELECT storeName, CAST(sum(total_sales) AS DECIMAL(20,2)) AS total_revenue FROM view
      GROUP BY storeID, storeName ORDER BY total_revenue DESC, storeName, storeID LIMIT 10"""
    found["q20_quarter_trend"] = view + """
      SELECT year_quarter, CAST(sum(total_sales) AS DECIMAL(20,2)) AS quarterly_total,
             CAST(sum(total_orders) AS BIGINT) AS total_orders FROM view GROUP BY 1"""
    found["q20_best_quarter"] = view + """
      , r AS (SELECT *, row_number() OVER (PARTITION BY storeID
                ORDER BY total_sales DESC, sales_year, sales_quarter, storeName) AS rn FROM view)
      SELECT storeName, year_quarter, total_sales FROM r WHERE rn = 1
      ORDER BY total_sales DESC, storeName, storeID LIMIT 10"""
    return {name: statement(" " + body) for name, body in found.items()}
