"""The reports by key.

``operational`` reads the three operational tables, ``star`` the written
warehouse, ``enriched`` the enriched transactions. Years are arguments of the
reports; ``year=None`` means the latest year in the data.
"""

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame

from tillwise.plans import (affinity, assortment, enriched, shoppers, spikes, stores, star,
                            trends, warehouse)

Report = Callable[..., DataFrame]


def operational(cities=None, occupations=None, full_year: int | None = None,
                quarterly_year: int = 2020) -> dict[str, Report]:
    """Reports over ``RetailTables``; ``full_year`` serves those that compare parts of a year."""
    return {
        "q01_years": assortment.years,
        "q01_month_daytype_top5": assortment.top_by_month_day_type,
        "q01_year_daytype_top5": assortment.top_by_day_type,
        "q02_gender_age_city": shoppers.gender_age_city,
        "q02_by_gender": shoppers.by_gender,
        "q02_by_age": shoppers.by_age,
        "q02_by_city": shoppers.by_city,
        "q02_gender_city_pivot": partial(shoppers.gender_by_city, cities=cities),
        "q03_occ_category": shoppers.occupation_category,
        "q03_by_occ": shoppers.by_occupation,
        "q03_by_category": assortment.by_category,
        "q03_top10_occ_category": shoppers.top_occupation_categories,
        "q03_top_category_matrix": partial(
            shoppers.category_by_occupation, occupations=occupations),
        "q04_gender_age_quarter": partial(shoppers.gender_age_quarter, year=quarterly_year),
        "q05_top5_occ_per_category": assortment.top_occupations_per_category,
        "q05_category_totals": assortment.top_occupation_totals,
        "q05_top10_occ": shoppers.top_occupations_overall,
        "q05_diversity": shoppers.occupation_diversity,
        "q06_date_range": shoppers.date_range,
        "q06_monthly": shoppers.city_marital_monthly,
        "q06_summary": shoppers.city_marital_summary,
        "q06_city_marital_pivot": shoppers.city_by_marital,
        "q07_stay_gender": shoppers.stay_gender,
        "q07_by_stay": shoppers.by_stay,
        "q07_by_gender": shoppers.by_gender,
        "q07_stay_gender_pivot": shoppers.stay_by_gender,
        "q07_top_stay": shoppers.top_stay,
        "q07_top_gender": shoppers.top_gender,
        "q08_top5_city_per_category": assortment.top_cities_per_category,
        "q08_city_summary": assortment.city_summary,
        "q09_mom_growth": trends.category_month_growth,
        "q09_avg_growth": trends.category_mean_growth,
        "q10_age_daytype": shoppers.age_day_type,
        "q10_age_daytype_crosstab": shoppers.age_by_day_type,
        "q10_top3": shoppers.top_age_day_types,
        "q11_month_daytype_top5": assortment.month_day_type_detail,
        "q11_daytype_top10": assortment.day_type_leaders,
        "q11_daytype_gap_top10": assortment.day_type_gap,
        "q12_store_qoq": partial(trends.store_quarter_growth, year=full_year),
        "q12_store_avg_growth": partial(trends.store_mean_growth, year=full_year),
        "q13_store_supplier_product": stores.supplier_products,
        "q13_subtotals": stores.supplier_subtotals,
        "q13_top3_suppliers": stores.top_suppliers,
        "q14_product_season": assortment.product_seasons,
        "q14_best_season": assortment.best_season,
        "q14_category_season_crosstab": assortment.category_by_season,
        "q15_mom_change": trends.pair_month_change,
        "q15_top20_volatile": trends.most_volatile_pairs,
        "q15_top10_stable": trends.most_stable_pairs,
        "q16_product_pairs": affinity.product_pairs,
        "q16_category_pairs": affinity.category_pairs,
        "q16_same_category": affinity.same_category_visits,
        "q16_bundles": affinity.bundles,
        "q17_rollup": stores.yearly_rollup,
        "q17_store_summary": stores.store_summary,
        "q18_h1_h2": partial(assortment.product_halves, year=full_year),
        "q18_category_h1_h2": partial(assortment.category_halves, year=full_year),
        "q18_gap_top20": partial(assortment.half_gap, year=full_year),
        "q19_spikes": spikes.spikes,
        "q19_spike_class_counts": spikes.spike_class_counts,
        "q19_extreme_first5": spikes.first_extreme_spikes,
        "q19_spike_frequency": spikes.spike_frequency,
        "q19_spike_by_weekday": spikes.spikes_by_weekday,
        "q20_store_quarterly": stores.store_quarters,
        "q20_preview": stores.quarterly_preview,
        "q20_store_totals": stores.store_totals,
        "q20_quarter_trend": stores.quarter_trend,
        "q20_best_quarter": stores.best_quarters,
        "d16_pairs": star.order_pairs,
        "e01_dim_customer": warehouse.customer_rows,
        "e02_dim_product": warehouse.product_rows,
        "e03_dim_store": warehouse.store_rows,
        "e04_dim_supplier": warehouse.supplier_rows,
        "e05_dim_date": warehouse.date_rows,
        "e08_duplicate_keys": warehouse.duplicates,
        "e09_orphans": warehouse.orphan_counts,
        "x06_row_counts": warehouse.row_counts,
    }


def star_schema(demographic_year: int = star.DEMOGRAPHIC_YEAR, growth_year: int = star.GROWTH_YEAR,
                recent_year: int = star.RECENT_YEAR) -> dict[str, Report]:
    """Reports over a built ``Warehouse``."""
    return {
        "e06_fact_sales": warehouse.fact_resolved,
        "e07_surrogate_keys": warehouse.key_report,
        "d01_top5_products": star.top_products,
        "d02_demographics": star.demographics,
        "d03_occ_category": star.occupation_category,
        "d04_quarter_gender_age": partial(star.quarter_gender_age, year=demographic_year),
        "d05_top5_occ_category": star.top_occupation_category,
        "d06_city_marital": partial(star.city_marital, year=recent_year),
        "d07_avg_stay_gender": star.mean_by_stay_gender,
        "d08_top5_city_category": star.top_city_category,
        "d09_monthly_growth": partial(star.category_month_growth, year=growth_year),
        "d10_age_weekday": star.age_weekday,
        "d11_top5_products_2016": partial(star.top_products_of_year, year=growth_year),
        "d12_store_quarter": partial(star.store_quarters_of_year, year=recent_year),
        "d13_store_supplier_category": star.store_supplier_category,
        "d14_season": star.product_month_season,
        "d15_store_supplier_growth": star.store_supplier_growth,
        "d17_rollup": star.rollup,
        "d18_half_year": star.product_halves,
        "d19_daily_flag": star.daily_flag,
        "d20_store_quarterly": star.store_quarterly,
    }


def enriched_rows(order_id: int) -> dict[str, Report]:
    """Reports over enriched transactions."""
    return {
        "x01_top_customers": enriched.top_customers,
        "x02_city_gender": enriched.city_gender,
        "x03_category_by_age": enriched.category_by_age,
        "x04_monthly_trend": enriched.monthly_trend,
        "x05_order_lookup": partial(enriched.order_lookup, order_id=order_id),
    }
