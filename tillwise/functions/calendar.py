"""Calendar attributes and date-range conditions."""

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labels of calendar attributes and the order in which reports list them.
WEEKEND, WEEKDAY = "Weekend", "Weekday"
SEASONS = ["Spring", "Summer", "Fall", "Winter"]
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
PREFERRED_STORE_YEAR = 2017

# folder column of transactions that are stored by year
STORED_YEAR = "order_year"


def day_type(day: Column) -> Column:
    # 1 is Sunday and 7 is Saturday
    return F.when(F.dayofweek(day).isin(1, 7), WEEKEND).otherwise(WEEKDAY)


def season(month: Column) -> Column:
    """March to May is spring, and so on; everything else, a missing month too, is winter."""
    spring, summer, fall, winter = SEASONS
    return (F.when(month.between(3, 5), spring).when(month.between(6, 8), summer)
            .when(month.between(9, 11), fall).otherwise(winter))


def month_start(day: Column) -> Column:
    """First of the month: a cheap integer key to group by before labelling."""
    return F.trunc(day, "month")


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def day_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def first_half(day: Column) -> Column:
    return F.month(day) <= 6


def in_year(day: Column, year: int) -> Column:
    """Half-open range instead of ``year(day) = y``: only the range reaches the scan."""
    return (day >= F.lit(dt.date(year, 1, 1))) & (day < F.lit(dt.date(year + 1, 1, 1)))


def stored_by_year(transactions: DataFrame) -> bool:
    return STORED_YEAR in transactions.columns


def latest_day(transactions: DataFrame) -> Column:
    """Latest order date as a scalar subquery: no driver round trip, and bounds built
    on it still prune the scan at run time. Where transactions are stored by year,
    only the last year's folder is read for it."""
    if stored_by_year(transactions):
        last = transactions.agg(F.max(STORED_YEAR)).scalar()
        transactions = transactions.where(F.col(STORED_YEAR) == last)
    return transactions.agg(F.max("order_date")).scalar()


def _in_folders(transactions: DataFrame, condition: Column, first: Column | int,
                last: Column | int) -> Column:
    """Add the bound on the folder column of transactions that are stored by year."""
    if not stored_by_year(transactions):
        return condition
    return condition & F.col(STORED_YEAR).between(first, last)


def year_condition(transactions: DataFrame, year: int | None) -> Column:
    """Rows of ``year``, or of the latest year in the data when it is None."""
    day = F.col("order_date")
    if year is not None:
        return _in_folders(transactions, in_year(day, year), year, year)
    latest = latest_day(transactions)
    return _in_folders(transactions, day >= F.trunc(latest, "year"),
                       F.year(latest), F.year(latest))


def preferred_year_condition(transactions: DataFrame, preferred: int) -> Column:
    """Rows of ``preferred`` if the data has that year, else of the latest year."""
    year = (F.col(STORED_YEAR) if stored_by_year(transactions)
            else F.year("order_date"))
    chosen = transactions.agg(
        F.coalesce(F.max(F.when(year == preferred, year)), F.max(year))).scalar()
    day, start = F.col("order_date"), F.make_date(chosen, F.lit(1), F.lit(1))
    within = (day >= start) & (day < F.add_months(start, 12))
    return _in_folders(transactions, within, chosen, chosen)


def last_months_condition(transactions: DataFrame, months: int) -> Column:
    """Strictly after ``months`` before the latest date (month ends are clamped)."""
    latest = latest_day(transactions)
    start = F.add_months(latest, -months)
    return _in_folders(transactions, F.col("order_date") > start, F.year(start), F.year(latest))
