"""The BI charts over the marts, as queries.

Each chart groups a mart and computes its metric over all groups.  A report
that shows a bounded number of rows passes ``limit`` (``CHART_ROW_LIMITS``):
the rows are then the first of a total order, so the cut is deterministic;
without it every group is returned, unsorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hiremart.constants import CHART_ROW_LIMITS as LIMITS  # noqa: F401  (for reports)
from hiremart.functions.columns import safe_ratio

def _report(df: DataFrame, limit: int | None, *order) -> DataFrame:
    return df if limit is None else df.orderBy(*order).limit(limit)


FLOAT_DIGITS = 6   # means of means depend on summation order: report 6 decimals


def fixed_point_mean(x: str, digits: int = FLOAT_DIGITS):
    """Mean of a DOUBLE column taken in exact fixed point.

    Each value is rounded half-up to ``10^-digits`` as an integer, the integers
    are summed exactly (DECIMAL(38,0), order-independent), and one division
    gives the mean.  Unlike a floating-point ``avg`` the result does not depend
    on how rows are spread over partitions.
    """
    scale = float(10 ** digits)
    units = F.floor(F.col(x) * F.lit(scale) + F.lit(0.5)).cast("decimal(38,0)")
    return F.sum(units).cast("double") / (F.count(units).cast("double") * F.lit(scale))


def bi_avg_salary(m1: DataFrame, limit: int | None = None) -> DataFrame:
    """Unweighted mean of the mart's mean salaries by role × currency."""
    return _report(m1.groupBy("industry_name", "currency")
                   .agg(fixed_point_mean("salary_avg").alias("salary_avg_avg")), limit,
                   F.col("salary_avg_avg").desc_nulls_last(), "industry_name", "currency")


def bi_currency_share(m5: DataFrame, limit: int | None = None) -> DataFrame:
    """Vacancies by role × currency, normalised per role (row contribution)."""
    agg = (m5.groupBy("industry_name", "currency")
           .agg(F.sum("vacancies_cnt").cast("long").alias("vacancies_cnt_sum")))
    total = F.sum("vacancies_cnt_sum").over(Window.partitionBy("industry_name"))
    return _report(agg.select("industry_name", "currency", "vacancies_cnt_sum",
                              safe_ratio(F.col("vacancies_cnt_sum"), total).alias("contribution")), limit,
                   F.col("vacancies_cnt_sum").desc(), "industry_name", "currency")


def bi_currency_pivot(m5: DataFrame, currencies=None) -> DataFrame:
    """C2 as the stacked-bar matrix: one row per role, one share column per currency.

    Without ``currencies`` Spark first finds the distinct labels (a tiny
    aggregate) and names the columns after them in sorted order.
    """
    share = bi_currency_share(m5)
    return (share.groupBy("industry_name").pivot("currency", currencies)
            .agg(F.first("contribution")))


def bi_heatmap(m2: DataFrame, limit: int | None = None) -> DataFrame:
    """Vacancies by role × area."""
    return _report(m2.groupBy("industry_name", "area_name")
                   .agg(F.sum("vacancies_cnt").cast("long").alias("vacancies_cnt_sum")), limit,
                   F.col("vacancies_cnt_sum").desc(), "industry_name", F.col("area_name").asc_nulls_last())


def bi_trend_line(m3: DataFrame, limit: int | None = None) -> DataFrame:
    """C4: monthly vacancies per role (time grain one month); a limit keeps the newest months."""
    return _report(m3.groupBy(F.trunc("month", "MM").alias("month"), "industry_name")
                   .agg(F.sum("vacancies_cnt").cast("long").alias("vacancies_cnt_sum")), limit,
                   F.col("month").desc(), "industry_name")


def bi_top_table(m4: DataFrame, limit: int = LIMITS["top_table"]) -> DataFrame:
    """The raw top-employers table, largest counts first (a global top-k)."""
    return (m4.select("industry_name", "area_name", "currency", "employer_name",
                      "vacancies_cnt", "salary_avg")
            .orderBy(F.col("vacancies_cnt").desc(), F.col("salary_avg").desc_nulls_last(),
                     "industry_name", F.col("area_name").asc_nulls_last(), "currency",
                     "employer_name")
            .limit(limit))
