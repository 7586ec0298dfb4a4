"""The marts kept incrementally (M1-M5): mergeable partial aggregates.

One row per month, role, area, currency and employer version holds the count, the
count and sum of salary points, and their extremes.  A run adds its facts and moves
the facts whose primary role changed (their group's measures are subtracted, which
sums allow); a group whose least or greatest salary left it gets its extremes again from
its own facts.  The five marts are aggregates over the partials: names come from
the dimensions as they are, and a closed employer version simply no longer joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hiremart.constants import TOP_EMPLOYERS_K
from hiremart.functions.columns import currency_label, month_start, salary_point
from hiremart.operators import marts

KEYS = ["month", "industry_id", "area_id", "currency", "employer_sk"]


def leaves() -> Column:
    """Whether a row of ``movements`` leaves the group that its fact was in."""
    before = F.col("_old_role")
    return F.col("_was_loaded") & before.isNotNull() & ~F.array_min("role_ids").eqNullSafe(before)


def movements(rows: DataFrame) -> DataFrame:
    """Signed star rows of a run: ``rows`` are the postings it wrote, with ``loaded`` (the
    fact's measures or NULL), ``role_ids`` (all roles ever linked), ``_was_loaded`` and
    ``_old_role`` (the primary role before the run)."""
    now, before = F.array_min("role_ids"), F.col("_old_role")
    moved = ~now.eqNullSafe(before)
    plus = F.col("loaded").isNotNull() & now.isNotNull() & (~F.col("_was_loaded") | moved)
    minus = leaves()
    entry = lambda sign, role: F.struct(F.lit(sign).alias("sign"), role.alias("industry_id"))
    signed = rows.select("loaded", F.explode(F.filter(F.array(
        F.when(plus, entry(1, now)), F.when(minus, entry(-1, before))), lambda e: e.isNotNull())).alias("_e"))
    return signed.select(
        F.col("_e.sign").alias("sign"), month_start(F.col("loaded.published_date")).alias("month"),
        F.col("_e.industry_id").alias("industry_id"), F.col("loaded.area_id").alias("area_id"),
        currency_label(F.col("loaded.salary_currency")).alias("currency"),
        F.col("loaded.employer_sk").alias("employer_sk"),
        salary_point(F.col("loaded.salary_from"), F.col("loaded.salary_to")).alias("salary_point"))


def merge(partials: DataFrame, moves: DataFrame) -> DataFrame:
    """``partials`` after ``moves``: groups left empty go; ``_open`` marks groups whose extreme left."""
    sp, sign = F.col("salary_point"), F.col("sign")
    none = F.lit(None).cast(partials.schema["salary_min"].dataType)
    came, out = F.when(sign > 0, sp), F.when(sign < 0, sp)
    # each movement as a group of its own, so that one aggregate (and one shuffle) takes both
    delta = moves.select(
        *KEYS, sign.cast("long").alias("vacancies_cnt"),
        F.when(sp.isNotNull(), sign).otherwise(0).cast("long").alias("vacancies_with_salary_cnt"),
        (sp * sign).cast(partials.schema["salary_sum"].dataType).alias("salary_sum"),
        came.alias("salary_min"), came.alias("salary_max"), out.alias("_out_min"), out.alias("_out_max"))
    both = partials.select(*KEYS, "vacancies_cnt", "vacancies_with_salary_cnt", "salary_sum", "salary_min", "salary_max",
                           none.alias("_out_min"), none.alias("_out_max")).unionByName(delta)
    total = both.groupBy(*KEYS).agg(
        F.sum("vacancies_cnt").alias("vacancies_cnt"),
        F.sum("vacancies_with_salary_cnt").alias("vacancies_with_salary_cnt"),
        F.sum("salary_sum").cast(partials.schema["salary_sum"].dataType).alias("salary_sum"),
        F.min("salary_min").alias("salary_min"), F.max("salary_max").alias("salary_max"),
        F.min("_out_min").alias("_out_min"), F.max("_out_max").alias("_out_max"))
    left = F.coalesce((F.col("_out_min") <= F.col("salary_min")) | (F.col("_out_max") >= F.col("salary_max")), F.lit(False))
    return total.where("vacancies_cnt > 0").withColumn("_open", left).drop("_out_min", "_out_max")


def reopened(groups: DataFrame, fact: DataFrame, bridge: DataFrame, roles: DataFrame) -> DataFrame:
    """The open ``groups`` with their extremes taken again from their own facts."""
    g = groups.select(*KEYS)
    f = fact.select("vacancy_id", month_start("published_date").alias("month"), "area_id",
                    currency_label("salary_currency").alias("currency"), "employer_sk",
                    salary_point("salary_from", "salary_to").alias("salary_point"))
    alike = [k for k in KEYS if k != "industry_id"]
    some = g.select(*alike).distinct()
    near = f.join(some, [f[k].eqNullSafe(some[k]) for k in alike], "left_semi")
    star = near.join(marts.primary_role(bridge.join(near.select("vacancy_id"), "vacancy_id", "left_semi"), roles), "vacancy_id")
    ends = star.groupBy(*KEYS).agg(F.min("salary_point").alias("_lo"), F.max("salary_point").alias("_hi"))
    on = [groups[k].eqNullSafe(ends[k]) for k in KEYS]
    return groups.join(ends, on, "left").select(
        *[groups[c] for c in (*KEYS, "vacancies_cnt", "vacancies_with_salary_cnt", "salary_sum")],
        F.col("_lo").alias("salary_min"), F.col("_hi").alias("salary_max"))


def labelled(partials: DataFrame, roles: DataFrame, areas: DataFrame) -> DataFrame:
    """Partials with the role's and (where known) the area's present name."""
    names = roles.select(F.col("role_id").alias("industry_id"), F.col("role_name").alias("industry_name"))
    return partials.join(names, "industry_id").join(areas.select("area_id", "area_name"), "area_id", "left")


def _count() -> Column:
    return F.sum("vacancies_cnt").cast("long").alias("vacancies_cnt")


def _with_salary() -> Column:
    return F.sum("vacancies_with_salary_cnt").cast("long").alias("vacancies_with_salary_cnt")


def _mean() -> Column:
    n = F.sum("vacancies_with_salary_cnt")
    return F.when(n > 0, F.sum("salary_sum").cast("double") / n).alias("salary_avg")


def mart_salary(p: DataFrame) -> DataFrame:
    """M1 from labelled partials."""
    return (p.groupBy("month", "industry_id", "industry_name", "area_id", "area_name", "currency")
            .agg(_count(), _with_salary(), F.min("salary_min").alias("salary_min"), _mean(),
                 F.max("salary_max").alias("salary_max")))


def mart_regions(p: DataFrame) -> DataFrame:
    """M2 from labelled partials."""
    return marts.regions_share(p.groupBy("industry_id", "industry_name", "area_id", "area_name")
                               .agg(_count(), _with_salary(), _mean()))


def mart_trends(p: DataFrame) -> DataFrame:
    """M3 from labelled partials."""
    return marts.trends_change(p.groupBy("month", "industry_id", "industry_name").agg(_count()))


def mart_top_employers(p: DataFrame, employers: DataFrame, k: int = TOP_EMPLOYERS_K) -> DataFrame:
    """M4 from labelled partials: only groups of employer versions that are current."""
    cur = employers.filter(F.col("is_current")).select("employer_sk", "employer_id", "employer_name")
    agg = (p.join(cur, "employer_sk")
           .groupBy("industry_id", "industry_name", "area_id", "area_name", "employer_id", "employer_name", "currency")
           .agg(_count(), _with_salary(), _mean()))
    return marts.top_employers(agg, k)


def mart_currency(p: DataFrame) -> DataFrame:
    """M5 from labelled partials."""
    return marts.currency_share(p.groupBy("industry_id", "industry_name", "area_id", "area_name", "currency").agg(_count()))


def all_marts(partials: DataFrame, roles: DataFrame, areas: DataFrame, employers: DataFrame,
              top_k: int = TOP_EMPLOYERS_K) -> dict[str, DataFrame]:
    """The five marts of one state of the partials and dimensions."""
    p = labelled(partials, roles, areas)
    return {"salary": mart_salary(p), "regions": mart_regions(p), "trends": mart_trends(p),
            "top_employers": mart_top_employers(p, employers, top_k), "currency": mart_currency(p)}
