"""Reports by customer attributes: gender, age, city, stay, marital status, occupation."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.functions import calendar as cal
from tillwise.functions.labels import AGE_GROUPS, STAY_YEARS, larger_of, listed_order
from tillwise.functions.money import MONEY, mean_money, share_or_zero
from tillwise.operators import metrics as m
from tillwise.operators.crosstab import crosstab, values_of, with_total_row
from tillwise.operators.ranking import top_k
from tillwise.tables import RetailTables

# Domains that cross-tabs list when the caller names no others.
CITIES = ["A", "B", "C"]
GENDERS = ["F", "M"]
SINGLE, MARRIED = "Single", "Married"


def age_order():
    return listed_order(F.col("Age"), AGE_GROUPS)


def stay_order(column: str = "stay_duration"):
    return listed_order(F.col(column), STAY_YEARS)


def spending_profile(sales: DataFrame, key, total: str = "total_purchase") -> DataFrame:
    """Customers, orders, revenue, revenue per line and per customer by one attribute."""
    counts = m.counted_lines(sales, [key], unique_customers="Customer_ID", total_orders="orderID")
    each = mean_money(F.col("amount_cents"), F.col("unique_customers")).alias("avg_per_customer")
    return counts.select(key, "unique_customers", "total_orders", m.added_revenue(total), m.added_mean(), each)


def gender_age_city(t: RetailTables) -> DataFrame:
    keys = ["Gender", "Age", "City_Category"]
    return (t.sold_to().groupBy(*keys)
            .agg(m.orders(), m.units(), m.revenue("total_purchase_amount"),
                 m.mean_amount("avg_purchase_per_transaction"))
            .orderBy(*keys))


def by_gender(t: RetailTables) -> DataFrame:
    return spending_profile(t.sold_to(), "Gender")


def by_age(t: RetailTables) -> DataFrame:
    return spending_profile(t.sold_to(), "Age").orderBy(age_order())


def by_city(t: RetailTables) -> DataFrame:
    return spending_profile(t.sold_to(), "City_Category").orderBy("City_Category")


def gender_by_city(t: RetailTables, cities=CITIES) -> DataFrame:
    """Revenue by gender and city; ``cities=None`` takes those of the customer master."""
    if cities is None:
        cities = values_of(t.customers, "City_Category")
    return crosstab(t.sold_to(), "Gender", "City_Category", cities, "city_",
                    lambda where: m.revenue("x", where), "total_purchase").orderBy("Gender")


def gender_age_quarter(t: RetailTables, year: int = 2020) -> DataFrame:
    sales = t.sold_to(cal.year_condition(t.transactions, year))
    return (sales.groupBy("Gender", "Age", F.quarter("order_date").alias("quarter"))
            .agg(m.buyers(), m.orders(), m.units(), m.revenue("total_purchase"), m.mean_amount())
            .orderBy("Gender", age_order(), "quarter"))


# --- the last six months by city and marital status ---

def date_range(t: RetailTables) -> DataFrame:
    return t.transactions.agg(F.min("order_date").alias("min_date"),
                              F.max("order_date").alias("max_date"))


def _recent(t: RetailTables, months: int) -> DataFrame:
    status = F.when(F.col("Marital_Status") == 0, SINGLE).otherwise(MARRIED)
    return (t.sold_to(cal.last_months_condition(t.transactions, months))
            .withColumn("marital_label", status))


def city_marital_monthly(t: RetailTables, months: int = 6) -> DataFrame:
    # grouped by the flag: a NULL flag stays apart from 1 although both read "Married"
    return (_recent(t, months)
            .groupBy("City_Category", "Marital_Status", "marital_label",
                     cal.month_start(F.col("order_date")).alias("month_start"))
            .agg(m.orders(), m.buyers(), m.units(), m.revenue("total_purchase"))
            .select("City_Category", F.col("marital_label").alias("marital_status"),
                    cal.month_label(F.col("month_start")).alias("month_year"), "total_orders",
                    "unique_customers", "total_quantity", "total_purchase")
            .orderBy("City_Category", "marital_status", "month_year"))


def city_marital_summary(t: RetailTables, months: int = 6) -> DataFrame:
    return (_recent(t, months)
            .groupBy("City_Category", "Marital_Status", "marital_label")
            .agg(m.buyers(), m.orders(), m.units(), m.revenue("total_purchase"),
                 m.mean_amount(), m.revenue_per("Customer_ID", "avg_per_customer"))
            .orderBy("City_Category", "Marital_Status")
            .select("City_Category", F.col("marital_label").alias("marital_status"),
                    "unique_customers", "total_orders", "total_quantity", "total_purchase",
                    "avg_per_transaction", "avg_per_customer"))


def city_by_marital(t: RetailTables, months: int = 6) -> DataFrame:
    table = (_recent(t, months).groupBy("City_Category")
             .agg(m.revenue("single", F.col("marital_label") == SINGLE),
                  m.revenue("married", F.col("marital_label") == MARRIED)))
    table = with_total_row(table, "City_Category", ["single", "married"])
    total = (F.col("single") + F.col("married")).cast(MONEY)
    return (table.withColumn("total", total)
            .withColumn("pct_single", share_or_zero(F.col("single"), F.col("total")))
            .withColumn("pct_married", share_or_zero(F.col("married"), F.col("total")))
            .orderBy("is_total", "City_Category").drop("is_total"))


# --- length of stay and gender ---

def _stays(t: RetailTables) -> DataFrame:
    return t.sold_to().withColumnRenamed("Stay_In_Current_City_Years", "stay_duration")


def stay_gender(t: RetailTables) -> DataFrame:
    return (_stays(t).groupBy("stay_duration", "Gender")
            .agg(m.buyers(), m.orders(), m.units(), m.revenue("total_purchase"),
                 m.mean_amount(), m.revenue_per("Customer_ID", "avg_per_customer"))
            .orderBy(stay_order(), "Gender"))


def by_stay(t: RetailTables) -> DataFrame:
    return spending_profile(_stays(t), "stay_duration").orderBy(stay_order())


def stay_by_gender(t: RetailTables) -> DataFrame:
    """Spending per customer, women against men, by length of stay (unknown ones last)."""
    def per_customer(gender):
        cents = F.when(F.col("Gender") == gender, F.col("amount_cents"))
        who = F.when(F.col("Gender") == gender, F.col("Customer_ID"))
        return F.coalesce(mean_money(F.sum(cents), F.count_distinct(who)), F.lit(0).cast(MONEY))

    women, men = F.col("female"), F.col("male")
    return (_stays(t).groupBy("stay_duration")
            .agg(per_customer("F").alias("female"), per_customer("M").alias("male"))
            .withColumn("difference", F.abs(men - women).cast(MONEY))
            .withColumn("higher_spender", larger_of(men, "Male", women, "Female"))
            .orderBy(stay_order()))


def top_stay(t: RetailTables) -> DataFrame:
    spending = _stays(t).groupBy("stay_duration").agg(
        m.buyers("customers"), m.revenue_per("Customer_ID", "avg_per_customer"))
    return top_k(spending, [F.desc("avg_per_customer"), "stay_duration"], 1)


def top_gender(t: RetailTables) -> DataFrame:
    spending = t.sold_to().groupBy("Gender").agg(m.revenue_per("Customer_ID", "avg_per_customer"))
    return top_k(spending, [F.desc("avg_per_customer"), "Gender"], 1)


# --- age and day type ---

def _days(t: RetailTables, year: int | None) -> DataFrame:
    return (t.sold_to(cal.year_condition(t.transactions, year))
            .withColumn("day_type", cal.day_type(F.col("order_date"))))


def age_day_type(t: RetailTables, year: int | None = None) -> DataFrame:
    return (_days(t, year).groupBy("Age", "day_type")
            .agg(m.buyers(), m.orders(), m.units(), m.revenue("total_sales"), m.mean_amount())
            .orderBy(age_order(), F.desc("day_type")))


def age_by_day_type(t: RetailTables, year: int | None = None) -> DataFrame:
    weekend = F.col("day_type") == cal.WEEKEND
    table = (_days(t, year).groupBy("Age")
             .agg(m.revenue("weekend_sales", weekend), m.revenue("weekday_sales", ~weekend),
                  m.revenue("total_sales")))
    table = with_total_row(table, "Age", ["weekend_sales", "weekday_sales", "total_sales"])
    on_weekend, on_weekday = F.col("weekend_sales"), F.col("weekday_sales")
    return (table
            .withColumn("weekend_pct", share_or_zero(on_weekend, F.col("total_sales")))
            .withColumn("weekday_pct", share_or_zero(on_weekday, F.col("total_sales")))
            .withColumn("higher", F.when(~F.col("is_total"), larger_of(
                on_weekend, cal.WEEKEND, on_weekday, cal.WEEKDAY)))
            .orderBy("is_total", age_order()).drop("is_total"))


def top_age_day_types(t: RetailTables, year: int | None = None, k: int = 3) -> DataFrame:
    sales = _days(t, year).groupBy("Age", "day_type").agg(m.revenue("total_sales"))
    return top_k(sales, [F.desc("total_sales"), "Age", "day_type"], k)


# --- occupation and product category ---

def occupation_category(t: RetailTables) -> DataFrame:
    return (t.sold_to().groupBy("Occupation", "Product_Category")
            .agg(m.orders(), m.units(), m.revenue("total_sales"),
                 m.mean_amount("avg_sale_per_transaction"))
            .orderBy("Occupation", F.desc("total_sales"), "Product_Category"))


def by_occupation(t: RetailTables) -> DataFrame:
    return (spending_profile(t.sold_to(), "Occupation", "total_sales")
            .orderBy(F.desc("total_sales"), "Occupation"))


def top_occupation_categories(t: RetailTables, k: int = 10) -> DataFrame:
    sales = t.sold_to().groupBy("Occupation", "Product_Category").agg(m.revenue("total_sales"))
    return top_k(sales, [F.desc("total_sales"), "Occupation", "Product_Category"], k)


def category_by_occupation(t: RetailTables, occupations=None, k: int = 5) -> DataFrame:
    """Revenue matrix of the best-selling categories against occupations (None: those of the
    customer master).

    Categories rank by revenue over all transactions, buyers known or not.
    """
    if occupations is None:
        occupations = values_of(t.customers, "Occupation")
    best = top_k(t.sold().groupBy("Product_Category").agg(m.revenue("sales")),
                 [F.desc("sales"), "Product_Category"], k)
    sales = t.sold_to().join(best.select("Product_Category"), "Product_Category", "left_semi")
    return crosstab(sales, "Product_Category", "Occupation", list(occupations), "occ_",
                    lambda where: m.revenue("x", where)).orderBy("Product_Category")


def top_occupations_overall(t: RetailTables, k: int = 10) -> DataFrame:
    counts = m.counted_lines(
        t.sold_to(), ["Occupation"], categories_purchased="Product_Category",
        unique_customers="Customer_ID", total_orders="orderID")
    sales = counts.select("Occupation", "categories_purchased", "unique_customers", "total_orders",
                          m.added_revenue("total_sales"), m.added_mean())
    return top_k(sales, [F.desc("total_sales"), "Occupation"], k)


def occupation_diversity(t: RetailTables) -> DataFrame:
    counts = m.counted_lines(t.sold_to(), ["Occupation"],
                             categories_count="Product_Category")
    return (counts.select("Occupation", "categories_count", m.added_revenue("total_sales"))
            .orderBy(F.desc("categories_count"), F.desc("total_sales"), "Occupation"))
