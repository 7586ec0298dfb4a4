"""Data marts over the star schema (M-a..M-d, M1-M5).

"Industry" in the marts is the vacancy's *primary professional role*: the
text-minimum role id among its roles.  Measures are exact: salary points are
DECIMAL, sums are exact, and a mean is ``CAST(sum AS DOUBLE) / count``.
Every aggregate is one ``groupBy().agg()`` (partial aggregation before the
shuffle); per-group totals, lags and top-k are windows over the *aggregated*
rows, whose count is bounded by the number of groups, not by the facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hiremart.constants import TOP_EMPLOYERS_K
from hiremart.functions.columns import currency_label, month_start, safe_ratio, salary_point


def primary_role(bridge: DataFrame, roles: DataFrame) -> DataFrame:
    """M-a: ``(vacancy_id, industry_id)`` with the text-minimum known role id."""
    known = roles.select("role_id")
    return (bridge.select("vacancy_id", "role_id").join(known, "role_id")
            .groupBy("vacancy_id").agg(F.min("role_id").alias("industry_id")))


def star(fact: DataFrame, bridge: DataFrame, roles: DataFrame, areas: DataFrame,
         employers: DataFrame | None = None) -> DataFrame:
    """M-d: facts ⋈ primary role ⋈ role name, ⟕ area (an unknown area is kept).

    Output: ``vacancy_id, employer_sk, month, industry_id, industry_name,
    area_id, area_name, currency, salary_point``.  With ``employers`` the
    fact's employer version is also looked up (left join on the surrogate
    key): ``employer_id, employer_name`` are set only while that version is
    current, which is what the top-employer mart needs.  Dimension sides are
    broadcast only when Spark measures them below its threshold.
    """
    vmap = primary_role(bridge, roles)
    names = roles.select(F.col("role_id").alias("industry_id"),
                         F.col("role_name").alias("industry_name"))
    # what the output needs of a fact, made before its rows are shuffled
    f = fact.select("vacancy_id", "employer_sk", "area_id", month_start("published_date").alias("month"),
                    currency_label("salary_currency").alias("currency"),
                    salary_point("salary_from", "salary_to").alias("salary_point"))
    out = f.join(vmap, "vacancy_id")
    extra = []
    if employers is not None:
        cur = (employers.filter(F.col("is_current"))
               .select("employer_sk", "employer_id", "employer_name"))
        out = out.join(cur, "employer_sk", "left")
        extra = ["employer_id", "employer_name"]
    # names last: rows that are shuffled to their employer do not carry them
    out = out.join(names, "industry_id").join(areas.select("area_id", "area_name"), "area_id", "left")
    return out.select("vacancy_id", "employer_sk", "month", "industry_id", "industry_name",
                      "area_id", "area_name", "currency", "salary_point", *extra)


def _count() -> Column:
    return F.count(F.lit(1)).cast("long")


def _with_salary() -> Column:
    return F.count_if(F.col("salary_point").isNotNull()).cast("long")


def exact_mean(x: str) -> Column:
    """Mean of the non-NULL values as DOUBLE from an exact sum (NULL if none)."""
    c = F.col(x)
    return F.when(F.count(c) > 0, F.sum(c).cast("double") / F.count(c))


def mart_salary(s: DataFrame) -> DataFrame:
    """M1: month × role × area × currency — counts and min/avg/max salary point."""
    return (s.groupBy("month", "industry_id", "industry_name", "area_id", "area_name", "currency")
            .agg(_count().alias("vacancies_cnt"),
                 _with_salary().alias("vacancies_with_salary_cnt"),
                 F.min("salary_point").alias("salary_min"),
                 exact_mean("salary_point").alias("salary_avg"),
                 F.max("salary_point").alias("salary_max")))


def mart_regions(s: DataFrame) -> DataFrame:
    """M2: role × area — counts, mean salary and the area's share of the role."""
    agg = (s.groupBy("industry_id", "industry_name", "area_id", "area_name")
           .agg(_count().alias("vacancies_cnt"),
                _with_salary().alias("vacancies_with_salary_cnt"),
                exact_mean("salary_point").alias("salary_avg")))
    return regions_share(agg)


def regions_share(agg: DataFrame) -> DataFrame:
    """The areas' shares of their role, from the groups' counts."""
    total = F.sum("vacancies_cnt").over(Window.partitionBy("industry_id"))
    return agg.select("industry_id", "industry_name", "area_id", "area_name", "vacancies_cnt",
                      "vacancies_with_salary_cnt",
                      safe_ratio(F.col("vacancies_cnt"), total).alias("share_in_industry"),
                      "salary_avg")


def mart_trends(s: DataFrame) -> DataFrame:
    """M3: month × role — count and change against the previous *present* month."""
    agg = (s.groupBy("month", "industry_id", "industry_name")
           .agg(_count().alias("vacancies_cnt")))
    return trends_change(agg)


def trends_change(agg: DataFrame) -> DataFrame:
    """Each month's change against the role's previous present month."""
    prev = F.lag("vacancies_cnt").over(Window.partitionBy("industry_id").orderBy("month"))
    return (agg.withColumn("_prev", prev)
            .select("month", "industry_id", "industry_name", "vacancies_cnt",
                    (F.col("vacancies_cnt") - F.col("_prev")).alias("mom_abs"),
                    F.when(F.col("_prev").isNull() | (F.col("_prev") == 0), F.lit(None).cast("double"))
                    .otherwise(F.col("vacancies_cnt").cast("double") / F.col("_prev") - F.lit(1.0))
                    .alias("mom_pct")))


def mart_top_employers(s: DataFrame, employers: DataFrame | None = None,
                       k: int = TOP_EMPLOYERS_K) -> DataFrame:
    """M4: top-``k`` employers per role × area × currency.

    Only facts whose employer version is still current count: either
    ``employers`` is joined here, or ``s`` is a star built with employers
    (current ``employer_id`` set, else NULL).  Ranked by count desc, mean
    salary desc (NULLs last), employer id asc (a total order).
    ``row_number() <= k`` lets Spark insert a group-limit before the shuffle,
    so a huge group never travels whole.
    """
    if employers is None:
        based = s.filter(F.col("employer_id").isNotNull())
    else:
        cur = (employers.filter(F.col("is_current"))
               .select("employer_sk", "employer_id", "employer_name"))
        based = s.join(cur, "employer_sk")
    agg = (based
           .groupBy("industry_id", "industry_name", "area_id", "area_name",
                    "employer_id", "employer_name", "currency")
           .agg(_count().alias("vacancies_cnt"),
                _with_salary().alias("vacancies_with_salary_cnt"),
                exact_mean("salary_point").alias("salary_avg")))
    return top_employers(agg, k)


def top_employers(agg: DataFrame, k: int) -> DataFrame:
    """The first ``k`` employers of each role × area × currency."""
    w = (Window.partitionBy("industry_id", "area_id", "currency")
         .orderBy(F.col("vacancies_cnt").desc(), F.col("salary_avg").desc_nulls_last(),
                  F.col("employer_id").asc()))
    return (agg.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") <= k).drop("_rn"))


def mart_currency(s: DataFrame) -> DataFrame:
    """M5: role × area × currency — count and share within (role, area).

    The window partition groups a NULL area with itself (null-safe total).
    """
    agg = (s.groupBy("industry_id", "industry_name", "area_id", "area_name", "currency")
           .agg(_count().alias("vacancies_cnt")))
    return currency_share(agg)


def currency_share(agg: DataFrame) -> DataFrame:
    """The currencies' shares within their role and area."""
    total = F.sum("vacancies_cnt").over(Window.partitionBy("industry_id", "area_id"))
    return agg.select("industry_id", "industry_name", "area_id", "area_name", "currency",
                      "vacancies_cnt",
                      safe_ratio(F.col("vacancies_cnt"), total).alias("currency_share"))
