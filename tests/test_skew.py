"""A hot key holding a third of the input: results stay whole and exact."""

import datetime as dt

from pyspark.sql import functions as F

from hiremart.operators import marts
from hiremart.plans import warehouse

T1 = dt.datetime(2025, 2, 1)
N = 3000


def _items(spark):
    k = F.col("id")
    hot = (k % 3 == 0)
    emp_id = F.when(hot, F.lit(1)).otherwise(k % 200 + 2).cast("string")
    item = F.struct(
        k.cast("string").alias("id"), F.lit("v").alias("name"),
        F.struct(F.lit("1").alias("id"), F.lit("A").alias("name")).alias("area"),
        F.struct(emp_id.alias("id"), F.concat(F.lit("E"), emp_id).alias("name"),
                 F.lit("u").alias("alternate_url"),
                 (k % 2 == 0).cast("string").alias("trusted")).alias("employer"),
        F.concat(F.lit("2025-01-"), F.lpad((k % 28 + 1).cast("string"), 2, "0"),
                 F.lit("T10:00:00Z")).alias("published_at"),
        F.struct(F.lit("100").alias("from"), F.lit(None).cast("string").alias("to"),
                 F.lit("RUR").alias("currency"), F.lit(None).cast("string").alias("gross")).alias("salary"),
        F.array(F.struct(F.lit("7").alias("id"), F.lit("seven").alias("name"))).alias("professional_roles"),
        F.array().cast("array<struct<id:string,name:string>>").alias("specializations"))
    return spark.range(1, N + 1).select(F.lit(0).alias("_page"), F.col("id").cast("int").alias("_pos"),
                                        item.alias("item"))


def test_hot_employer_cycle_and_top_k(spark):
    wh = warehouse.build(spark, [(_items(spark), T1)])
    assert wh.fact_vacancy.count() == N
    cur = wh.dim_employer.filter("is_current")
    assert cur.count() == cur.select("employer_id").distinct().count() == 201
    hot = cur.filter("employer_id = 1").first()
    # latest publication (2025-01-28) then greatest vacancy id decides the attributes
    latest = max(i for i in range(3, N + 1, 3) if i % 28 == 27)
    assert hot["trusted"] == (latest % 2 == 0)
    star = marts.star(wh.fact_vacancy, wh.bridge_role, wh.dim_role, wh.dim_area, wh.dim_employer)
    top = marts.mart_top_employers(star, k=5).collect()
    assert len(top) == 5 and top[0]["employer_id"] == 1 and top[0]["vacancies_cnt"] == N // 3
    m1 = marts.mart_salary(star)
    assert m1.agg(F.sum("vacancies_cnt")).first()[0] == N
