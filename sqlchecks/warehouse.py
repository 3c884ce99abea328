"""Checking SQL for the warehouse build, the star reports and the enriched rows."""

from sqlchecks.sql import decimal, half_up, money, percent, revenue, statement

PRODUCT = "Product_ID AS product_id, Product_Category AS product_category"


def statements(full_year: int, sample_order: int) -> dict[str, str]:
    y = f"y = {full_year}"
    found: dict[str, str] = {}

    found["e01_dim_customer"] = """SELECT DISTINCT Customer_ID AS customer_id, Gender AS gender,
        Age AS age, Occupation AS occupation, City_Category AS city_category, Stay AS stay_years,
        if(Marital_Status = 1, 'Married', 'Single') AS marital_status FROM customer_master"""
    found["e02_dim_product"] = f"SELECT DISTINCT {PRODUCT}, price FROM product_master"
    found["e03_dim_store"] = """SELECT DISTINCT storeID AS store_id, storeName AS store_name
      FROM product_master"""
    found["e04_dim_supplier"] = """SELECT DISTINCT supplierID AS supplier_id,
      supplierName AS supplier_name FROM product_master"""
    found["e05_dim_date"] = """SELECT DISTINCT order_date AS full_date,
        CAST(day(order_date) AS INTEGER) AS day, mon AS month, qtr AS quarter, y AS year,
        day_type AS weekday_flag FROM sold"""
    found["e06_fact_sales"] = """SELECT Customer_ID AS customer_id,
        if(Marital_Status = 1, 'Married', 'Single') AS marital_status, Product_ID AS product_id,
        price, storeID AS store_id, supplierID AS supplier_id, order_date AS full_date,
        day_type AS weekday_flag, quantity, CAST(quantity * price AS DECIMAL(12,2)) AS revenue
      FROM sold_to"""
    sizes = [("dim_customer", "SELECT DISTINCT Customer_ID FROM customer_master"),
             ("dim_product", "SELECT DISTINCT Product_ID FROM product_master"),
             ("dim_store", "SELECT DISTINCT storeID FROM product_master"),
             ("dim_supplier", "SELECT DISTINCT supplierID FROM product_master"),
             ("dim_date", "SELECT DISTINCT order_date FROM transactional_data")]
    found["e07_surrogate_keys"] = " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, count(*) AS row_count, count(*) AS distinct_keys,
            CAST(1 AS BIGINT) AS first_key, count(*) AS last_key FROM ({rows})"""
        for name, rows in sizes) + """
      UNION ALL SELECT 'fact_sales', count(*), count(*), NULL, NULL FROM sold_to"""
    found["e08_duplicate_keys"] = " UNION ALL ".join(
        f"""SELECT '{table}' AS table_name, CAST({key} AS VARCHAR) AS key_value,
            count(*) AS copies FROM {table} GROUP BY {key} HAVING copies > 1"""
        for table, key in [("customer_master", "Customer_ID"), ("product_master", "Product_ID"),
                           ("transactional_data", "orderID")])
    found["e09_orphans"] = " UNION ALL ".join(
        f"""SELECT '{table}' AS parent_table, count(*) AS orphan_rows
            FROM transactional_data ANTI JOIN {table} USING ({key})"""
        for table, key in [("customer_master", "Customer_ID"), ("product_master", "Product_ID")])

    # the first loads of the registry: two thirds of the customers, other products, and days before the middle
    early = {"dim_customer": "Customer_ID % 3 <> 0", "dim_product": "storeID % 4 <> 1",
             "dim_store": "storeID % 4 <> 1", "dim_supplier": "storeID % 4 <> 1",
             "dim_date": "order_date < DATE '1998-05-15'"}
    found["e10_persistent_keys"] = " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, b AS members_before, a AS members_after, b AS kept_keys,
            a AS distinct_keys, CASE WHEN a > b THEN b + 1 END AS first_new_key
            FROM (SELECT (SELECT count(*) FROM ({rows} WHERE {early[name]})) AS b,
                         (SELECT count(*) FROM ({rows})) AS a)"""
        for name, rows in sizes)
    first_lines = "SELECT orderID, order_date, count(*) AS n FROM transactional_data GROUP BY ALL"
    found["e11_enforced_load"] = " UNION ALL ".join(
        f"""SELECT '{table}' AS table_name, count(*) AS given_rows, count(*) AS accepted_rows,
            CAST(0 AS BIGINT) AS accepted_units, CAST(0 AS BIGINT) AS rejected_rows FROM {table}"""
        for table in ("customer_master", "product_master")) + f"""
      UNION ALL SELECT 'transactional_data', CAST(sum(n) AS BIGINT), count(*),
        (SELECT CAST(sum(f.q) AS BIGINT) FROM (SELECT min({{'line': l_linenumber, 'part': l_partkey,
         'q': CAST(l_quantity AS INTEGER)}}) AS f FROM lineitem GROUP BY l_orderkey)), CAST(sum(n - 1) AS BIGINT) FROM ({first_lines})"""
    found["e12_rejected_rows"] = f"""SELECT 'orderID is repeated' AS rule,
        CAST(year(order_date) AS INTEGER) AS order_year, CAST(sum(n - 1) AS BIGINT) AS rejected_rows,
        count(*) AS orders FROM ({first_lines}) WHERE n > 1 GROUP BY ALL"""

    def total(keys, name, where="true", tail=""):
        return f"SELECT {keys}, {revenue(name)} FROM sold_to WHERE {where} GROUP BY ALL {tail}"

    found["d01_top5_products"] = total(
        f"y AS year, mon AS month, day_type AS weekday_flag, {PRODUCT}", "total_revenue",
        tail="ORDER BY sum(cents) DESC, 1, 2, 3, 4, 5 LIMIT 5")
    found["d02_demographics"] = total(
        "Gender AS gender, Age AS age, City_Category AS city_category", "purchase_amount")
    found["d03_occ_category"] = total(
        "Occupation AS occupation, Product_Category AS product_category", "total_sales")
    found["d04_quarter_gender_age"] = total(
        "qtr AS quarter, Gender AS gender, Age AS age", "purchase_amount", y)
    found["d05_top5_occ_category"] = total(
        "Occupation AS occupation, Product_Category AS product_category", "sales",
        tail="ORDER BY sum(cents) DESC, 1, 2 LIMIT 5")
    found["d06_city_marital"] = total(
        """y AS year, mon AS month, City_Category AS city_category,
           if(Marital_Status = 1, 'Married', 'Single') AS marital_status""",
        "purchase_amount", f"{y} AND mon > 7")
    found["d07_avg_stay_gender"] = f"""SELECT Stay AS stay_years, Gender AS gender,
        {decimal(half_up('sum(cents) * 10000', 'count(cents)'), 6, 24)} AS avg_purchase_amount
      FROM sold_to GROUP BY Stay, sold_to.Gender"""
    found["d08_top5_city_category"] = total(
        "City_Category AS city_category, Product_Category AS product_category",
        "purchase_amount", tail="ORDER BY sum(cents) DESC, 1, 2 LIMIT 5")
    found["d09_monthly_growth"] = f""", g AS (
        SELECT mon, Product_Category, sum(cents) AS c FROM sold_to WHERE {y} GROUP BY 1, 2)
      SELECT a.mon AS month, a.Product_Category AS product_category,
             {money('a.c')} AS current_sales, {money('b.c')} AS previous_sales,
             {percent('a.c - b.c', 'b.c', 2)} AS growth_percentage
      FROM g a LEFT JOIN g b ON a.Product_Category = b.Product_Category AND b.mon + 1 = a.mon"""
    found["d10_age_weekday"] = total("Age AS age, day_type AS weekday_flag", "total_sales")
    found["d11_top5_products_2016"] = total(
        f"mon AS month, day_type AS weekday_flag, {PRODUCT}", "total_revenue", y,
        "ORDER BY sum(cents) DESC, 1, 2, 3, 4 LIMIT 5")
    found["d12_store_quarter"] = total("storeName AS store_name, qtr AS quarter", "revenue", y)
    found["d13_store_supplier_category"] = total(
        "storeName AS store_name, supplierName AS supplier_name, Product_Category AS product_category",
        "total_sales")
    found["d14_season"] = f"""SELECT Product_ID AS product_id, Product_Category AS product_category,
        season, qtr AS quarter, {revenue('total_sales')} FROM sold_to
      GROUP BY Product_ID, sold_to.Product_Category, mon, season, qtr"""
    found["d15_store_supplier_growth"] = f""", g AS (
        SELECT storeName, supplierName, mon, sum(cents) AS c FROM sold_to GROUP BY 1, 2, 3)
      SELECT a.storeName AS store_name, a.supplierName AS supplier_name, a.mon AS month,
             b.mon AS prev_month, {money('a.c')} AS current_monthly_total_sales,
             {money('b.c')} AS previous_month_total_sales, {money('a.c - b.c')} AS difference,
             {percent('a.c - b.c', 'b.c', 2)} AS percentage
      FROM g a LEFT JOIN g b ON a.storeName = b.storeName AND a.supplierName = b.supplierName
                            AND b.mon + 1 = a.mon"""
    found["d16_pairs"] = """SELECT a.Product_ID AS product_1, b.Product_ID AS product_2,
        count(*) AS product_bought_together
      FROM transactional_data a JOIN transactional_data b
        ON a.orderID = b.orderID AND a.Product_ID < b.Product_ID
      GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 5"""
    found["d17_rollup"] = f"""SELECT storeName AS store_name, supplierName AS supplier_name,
        Product_Category AS product_category,
        CASE GROUPING(storeName, supplierName, Product_Category) WHEN 0 THEN 'category'
          WHEN 1 THEN 'supplier' WHEN 3 THEN 'store' ELSE 'all' END AS level,
        {revenue('total_sales')}
      FROM sold_to GROUP BY ROLLUP (storeName, supplierName, sold_to.Product_Category)"""
    found["d18_half_year"] = f"""SELECT {PRODUCT}, {revenue('first_half_revenue', 'mon <= 6')},
        {revenue('second_half_revenue', 'mon > 6')},
        CAST(sum(quantity) AS BIGINT) AS total_quantity FROM sold_to GROUP BY 1, 2"""
    found["d19_daily_flag"] = f""", g AS (
        SELECT Product_ID, sum(cents) AS c, count(DISTINCT order_date) AS n FROM sold_to GROUP BY 1),
      h AS (SELECT *, {half_up('c * 10', 'n')} AS a FROM g)
      SELECT Product_ID AS product_id, {money('c')} AS total_sales,
             {decimal('a', 3, 24)} AS avg_daily_sales,
             {decimal('2 * a', 3, 24)} AS twice_daily_avg_sales,
             CASE WHEN c * 10 > 2 * a THEN 1 ELSE 0 END AS flag FROM h"""
    found["d20_store_quarterly"] = total(
        "storeName AS store_name, y AS year, qtr AS quarter", "total_sales")

    enriched = """SELECT orderID AS order_id, order_date, quantity, Customer_ID AS customer_id,
        Gender AS gender, Age AS age, Occupation AS occupation, City_Category AS city_category,
        Stay AS stay_years, Marital_Status AS marital_status, Product_ID AS product_id,
        Product_Category AS product_category, price, storeID AS store_id,
        supplierID AS supplier_id, storeName AS store_name, supplierName AS supplier_name,
        CAST(quantity * price AS DECIMAL(12,2)) AS total_amount FROM sold_to"""
    found["s01_stream_enrich"] = found["s10_replayed"] = enriched
    found["s09_late_customers"] = f"SELECT *, customer_id % 3 = 0 AS late FROM ({enriched})"
    found["s02_enrich_stats"] = """SELECT count(*) AS received,
        (SELECT count(*) FROM sold_to) AS joined,
        count(*) - (SELECT count(*) FROM sold_to) AS dropped FROM transactional_data"""
    found["s03_unmatched"] = """SELECT orderID, t.Customer_ID, t.Product_ID, quantity, order_date,
        CASE WHEN c.Customer_ID IS NULL AND p.Product_ID IS NULL THEN 'customer and product'
             WHEN c.Customer_ID IS NULL THEN 'customer' ELSE 'product' END AS missing
      FROM transactional_data t LEFT JOIN customer_master c ON c.Customer_ID = t.Customer_ID
        LEFT JOIN product_master p ON p.Product_ID = t.Product_ID
      WHERE c.Customer_ID IS NULL OR p.Product_ID IS NULL"""
    trend = f"SELECT ym AS month, {revenue('revenue')} FROM sold_to GROUP BY 1"
    found["s04_enriched_reports"] = found["x04_monthly_trend"] = trend
    found["x01_top_customers"] = f"""SELECT Customer_ID AS customer_id, Gender AS gender, Age AS age,
        {revenue('total_spent')} FROM sold_to GROUP BY ALL ORDER BY sum(cents) DESC, 1 LIMIT 10"""
    found["x02_city_gender"] = f"""SELECT City_Category AS city_category, Gender AS gender,
        count(*) AS orders, {revenue('revenue')} FROM sold_to GROUP BY ALL"""
    found["x03_category_by_age"] = """SELECT Age AS age, Product_Category AS product_category,
        count(*) AS purchases FROM sold_to GROUP BY ALL"""
    found["x05_order_lookup"] = f"""SELECT * FROM ({enriched}) WHERE order_id = {sample_order}
      ORDER BY product_id, quantity LIMIT 10"""
    found["x06_row_counts"] = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
        for t in ["customer_master", "product_master", "transactional_data"])
    for n, name in enumerate(["top_customers", "city_gender", "category_by_age", "monthly_trend"], 1):
        found[f"s{n + 4:02}_running_{name}"] = found[f"x{n:02}_{name}"]
        if n < 4:
            found[f"s04_{name}"] = found[f"x{n:02}_{name}"]
    return {name: statement(" " + body) for name, body in found.items()}
