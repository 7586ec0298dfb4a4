"""Independent SQL twins of the registered queries, for DuckDB.

They recompute every expected result straight from the driver's tables with
plain SQL (CTEs, joins, window functions) — no JSON round trip, no SCD2
machinery — using the same fixed stand-in mapping as
``hiremart.sources.driver`` and the same fixed run parameters as
``hiremart.plans.fixture_runs``.
"""

from __future__ import annotations

# Fixed parameters, equal to hiremart.plans.fixture_runs / sources.driver.
RUN_1_AT = "TIMESTAMP '1998-08-01 00:00:00'"
RENEWED = " (renewed)"
RUN_2_AT = "TIMESTAMP '2001-09-01 00:00:00'"
URL_PREFIX = "https://jobs.example.org/employer/"
MOVED_PREFIX = "https://sites.example.com/"

# --------------------------------------------------------------- stand-in ----
POSTINGS = f"""
src AS (
  SELECT o.o_orderkey AS k, o.o_orderpriority, o.o_orderstatus, o.o_orderdate,
         o.o_totalprice, c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal, n.n_name
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
postings AS (
  SELECT
    k AS vacancy_id,
    o_orderpriority AS name,
    CAST(o_orderdate AS DATE) AS published_date,
    CAST(o_orderdate AS DATE) + to_hours(CASE k % 3 WHEN 0 THEN 9 WHEN 1 THEN 17 ELSE 12 END)
      AS published_at,
    CASE WHEN k % 11 = 0 THEN NULL ELSE CAST(c_nationkey AS BIGINT) END AS area_id,
    CASE WHEN k % 11 = 0 THEN NULL ELSE n_name END AS area_name,
    CASE WHEN k % 13 = 0 THEN NULL ELSE c_custkey END AS employer_id,
    CASE WHEN k % 13 = 0 THEN NULL ELSE c_name END AS employer_name,
    CASE WHEN k % 13 = 0 OR c_custkey IS NULL THEN NULL
         ELSE '{URL_PREFIX}' || CAST(c_custkey AS VARCHAR) END AS alternate_url,
    CASE WHEN k % 13 = 0 OR c_custkey IS NULL THEN NULL ELSE o_orderstatus = 'F' END AS trusted,
    CASE WHEN k % 5 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS salary_from,
    CASE WHEN k % 3 = 0 THEN NULL
         ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) + CAST(c_acctbal AS DECIMAL(18,2))
                   AS DECIMAL(18,2)) END AS salary_to,
    CASE k % 4 WHEN 0 THEN 'RUR' WHEN 1 THEN 'USD' WHEN 2 THEN '' ELSE NULL END AS salary_currency,
    o_orderpriority = '1-URGENT' AS salary_gross
  FROM src
),
role_pairs AS (
  SELECT DISTINCT l.l_orderkey AS vacancy_id,
         regexp_extract(p.p_brand, '#(\\d+)', 1) AS role_id, p.p_brand AS role_name
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
),
sphere_pairs AS (
  SELECT DISTINCT l.l_orderkey AS vacancy_id, CAST(s.s_nationkey AS VARCHAR) AS sphere_id
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
)"""

# facts: every posting with an employer id and a date (run 1 + run 2 together)
FACTS = """
facts AS (
  SELECT * FROM postings WHERE employer_id IS NOT NULL AND employer_name IS NOT NULL
    AND published_date IS NOT NULL
),
-- a posting's primary role: of its named roles the one whose id sorts first as text
roles_of AS (
  SELECT vacancy_id, role_id, role_name FROM role_pairs SEMI JOIN postings USING (vacancy_id)
  WHERE role_id <> ''
),
dim_role AS (SELECT role_id, max(role_name) AS role_name FROM roles_of GROUP BY role_id),
primary_roles AS (
  SELECT vacancy_id, role_id, max(role_name) OVER (PARTITION BY role_id) AS role_name FROM roles_of
  QUALIFY row_number() OVER (PARTITION BY vacancy_id ORDER BY role_id) = 1
),
dim_area AS (
  SELECT area_id, area_name FROM postings WHERE area_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY area_id
    ORDER BY published_at DESC NULLS LAST, vacancy_id DESC NULLS LAST) = 1
),
-- one row per fact that has a role, with everything the marts count by
counted AS (
  SELECT facts.* EXCLUDE (area_name), dim_area.area_name, role_id AS industry_id, role_name AS industry_name,
         datetrunc('month', published_date)::DATE AS month,
         CASE WHEN salary_currency <> '' THEN salary_currency ELSE 'UNKNOWN' END AS currency,
         (coalesce(salary_from, salary_to) + coalesce(salary_to, salary_from))::DECIMAL(20,3)
           * 0.5::DECIMAL(2,1) AS salary_point
  FROM facts JOIN primary_roles USING (vacancy_id) LEFT JOIN dim_area USING (area_id)
)"""


# employer versions after the two runs (SCD2 without the machinery)
EMPLOYERS = f"""
staged1 AS (
  SELECT employer_id, employer_name, alternate_url, trusted FROM (
    SELECT *, row_number() OVER (PARTITION BY employer_id
                                 ORDER BY published_at DESC NULLS LAST, vacancy_id DESC NULLS LAST) AS rn
    FROM postings WHERE employer_id IS NOT NULL AND employer_name IS NOT NULL
      AND published_at < {RUN_1_AT}) WHERE rn = 1
),
staged2 AS (
  SELECT employer_id, employer_name, alternate_url, trusted FROM (
    SELECT *, row_number() OVER (PARTITION BY employer_id
                                 ORDER BY published_at DESC NULLS LAST, vacancy_id DESC NULLS LAST) AS rn
    FROM postings WHERE employer_id IS NOT NULL AND employer_name IS NOT NULL) WHERE rn = 1
),
changed AS (
  SELECT s1.employer_id FROM staged1 s1 JOIN staged2 s2 ON s1.employer_id = s2.employer_id
  WHERE s1.employer_name IS DISTINCT FROM s2.employer_name
     OR s1.alternate_url IS DISTINCT FROM s2.alternate_url
     OR s1.trusted IS DISTINCT FROM s2.trusted
),
dim_employer AS (
  SELECT employer_id, employer_name, alternate_url, trusted, {RUN_1_AT} AS valid_from,
         CASE WHEN employer_id IN (SELECT employer_id FROM changed) THEN {RUN_2_AT}
              ELSE TIMESTAMP '9999-12-31 00:00:00' END AS valid_to,
         employer_id NOT IN (SELECT employer_id FROM changed) AS is_current, 1 AS version
  FROM staged1
  UNION ALL
  SELECT employer_id, employer_name, alternate_url, trusted, {RUN_2_AT} AS valid_from,
         TIMESTAMP '9999-12-31 00:00:00' AS valid_to, TRUE AS is_current, 2 AS version
  FROM staged2
  WHERE employer_id IN (SELECT employer_id FROM changed)
     OR employer_id NOT IN (SELECT employer_id FROM staged1)
),
fact_ver AS (
  SELECT f.*,
         CASE WHEN f.published_at < {RUN_1_AT} THEN 1
              WHEN f.employer_id IN (SELECT employer_id FROM changed)
                OR f.employer_id NOT IN (SELECT employer_id FROM staged1) THEN 2
              ELSE 1 END AS version
  FROM facts f
)"""

FEED_AT = "TIMESTAMP '2001-09-01 00:10:00'"
EMPLOYER_FEED = f"""
feed AS (
  SELECT c.c_custkey AS employer_id, c.c_name AS employer_name,
         CASE WHEN c.c_custkey % 7 = 0 THEN '{MOVED_PREFIX}' ELSE '{URL_PREFIX}' END
           || CAST(c.c_custkey AS VARCHAR) AS alternate_url,
         n.n_name AS area_name,
         CAST(CAST(trunc(abs(c.c_acctbal)) AS BIGINT) % 100 AS INTEGER) AS open_vacancies
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
cur_emp AS (SELECT * FROM dim_employer WHERE is_current),
fchanged AS (
  SELECT f.employer_id FROM feed f JOIN cur_emp c ON f.employer_id = c.employer_id
  WHERE f.employer_name IS DISTINCT FROM c.employer_name
     OR f.alternate_url IS DISTINCT FROM c.alternate_url
),
dim_after_feed AS (
  SELECT employer_id, employer_name, alternate_url, trusted, valid_from,
         CASE WHEN is_current AND employer_id IN (SELECT employer_id FROM fchanged)
              THEN {FEED_AT} ELSE valid_to END AS valid_to,
         is_current AND employer_id NOT IN (SELECT employer_id FROM fchanged) AS is_current
  FROM dim_employer
  UNION ALL
  SELECT employer_id, employer_name, alternate_url, CAST(NULL AS BOOLEAN) AS trusted,
         {FEED_AT} AS valid_from, TIMESTAMP '9999-12-31 00:00:00' AS valid_to, TRUE AS is_current
  FROM feed
  WHERE employer_name IS NOT NULL
    AND (employer_id IN (SELECT employer_id FROM fchanged)
         OR employer_id NOT IN (SELECT employer_id FROM cur_emp))
)"""

DICTIONARY = """
dict AS (
  SELECT CAST(r.r_regionkey AS VARCHAR) AS industry_id, r.r_name AS industry_name,
         CAST(n.n_nationkey AS VARCHAR) AS sphere_id, n.n_name AS sphere_name
  FROM region r LEFT JOIN nation n ON n.n_regionkey = r.r_regionkey
)"""

EVENTS_SPLIT = "TIMESTAMP '2024-01-15 00:00:00'"
LATEST_EVENT = """
SELECT user_id, event_id, ts, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts {d}, event_id {d}) AS rn
  FROM events) WHERE rn = 1
"""


def with_ctes(*parts: str, body: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n" + body


MEAN = "CASE WHEN COUNT({x}) > 0 THEN CAST(SUM({x}) AS DOUBLE) / COUNT({x}) END"
RATIO = "CASE WHEN {b} = 0 THEN NULL ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END"
DIM_EMP_COLS = "employer_id, employer_name, alternate_url, trusted, valid_from, valid_to, is_current"

MART_SALARY_BODY = f"""
SELECT month, industry_id, industry_name, area_id, area_name, currency, COUNT(*) AS vacancies_cnt,
       COUNT(salary_point) AS vacancies_with_salary_cnt, MIN(salary_point)::DECIMAL(22,3) AS salary_min,
       {MEAN.format(x='salary_point')} AS salary_avg, MAX(salary_point)::DECIMAL(22,3) AS salary_max
FROM counted GROUP BY ALL
"""

# shares: each group's count over the window total of its counts
MART_REGIONS_CTE = f"""
m2 AS (
  SELECT industry_id, industry_name, area_id, area_name, COUNT(*) AS vacancies_cnt,
         COUNT(salary_point) AS vacancies_with_salary_cnt,
         COUNT(*)::DOUBLE / SUM(COUNT(*)) OVER (PARTITION BY industry_id) AS share_in_industry,
         {MEAN.format(x='salary_point')} AS salary_avg
  FROM counted GROUP BY industry_id, industry_name, area_id, area_name
)"""

MART_TRENDS_CTE = """
m3 AS (
  SELECT month, industry_id, industry_name, COUNT(*) AS vacancies_cnt,
         COUNT(*) - LAG(COUNT(*)) OVER step AS mom_abs,
         COUNT(*)::DOUBLE / LAG(COUNT(*)) OVER step - 1.0 AS mom_pct
  FROM counted GROUP BY month, industry_id, industry_name
  WINDOW step AS (PARTITION BY industry_id ORDER BY month)
)"""

MART_CURRENCY_CTE = """
m5 AS (
  SELECT industry_id, industry_name, area_id, area_name, currency, COUNT(*) AS vacancies_cnt,
         COUNT(*)::DOUBLE / SUM(COUNT(*)) OVER (PARTITION BY industry_id, area_id) AS currency_share
  FROM counted GROUP BY industry_id, industry_name, area_id, area_name, currency
)"""


def mart_top_cte(k: int, employers: str = "dim_employer", versions: str = "fact_ver") -> str:
    """Top employers over the facts whose employer version is still current."""
    return f"""
m4 AS (
  SELECT industry_id, industry_name, area_id, area_name, c.employer_id, e.employer_name, currency,
         COUNT(*) AS vacancies_cnt, COUNT(salary_point) AS vacancies_with_salary_cnt,
         {MEAN.format(x='salary_point')} AS salary_avg
  FROM counted c JOIN (SELECT vacancy_id, version FROM {versions}) v USING (vacancy_id)
  JOIN {employers} e ON e.is_current AND e.employer_id = c.employer_id AND e.version = v.version
  GROUP BY industry_id, industry_name, area_id, area_name, c.employer_id, e.employer_name, currency
  QUALIFY row_number() OVER (PARTITION BY industry_id, area_id, currency
    ORDER BY COUNT(*) DESC, salary_avg DESC NULLS LAST, c.employer_id) <= {k}
)"""


STAR = (POSTINGS, FACTS)
STAR_EMP = (POSTINGS, FACTS, EMPLOYERS)


def sql() -> dict[str, str]:
    q: dict[str, str] = {}
    # ---------------------------------------------------------------- sources
    q["src_paged_items"] = """
SELECT o_orderkey // 100 AS page,
       CAST(row_number() OVER (PARTITION BY o_orderkey // 100 ORDER BY o_orderkey) - 1 AS INTEGER) AS pos,
       o_orderkey AS vacancy_id, o_orderpriority AS name
FROM orders"""
    q["src_employer_pages"] = """
SELECT c_custkey // 100 AS page,
       CAST(row_number() OVER (PARTITION BY c_custkey // 100 ORDER BY c_custkey) - 1 AS INTEGER) AS pos,
       c_custkey AS employer_id, c_name AS name
FROM customer"""
    head = with_ctes(POSTINGS, """
head AS (SELECT o_orderkey AS vacancy_id, o_orderpriority AS name FROM orders)""", body="{body}")
    q["enrich_details"] = head.replace("{body}", """
SELECT h.vacancy_id, CAST(COALESCE(r.n, -1) AS INTEGER) AS n_roles,
       CAST(COALESCE(s.n, -1) AS INTEGER) AS n_specs
FROM head h
LEFT JOIN (SELECT vacancy_id, COUNT(*) AS n FROM role_pairs GROUP BY vacancy_id) r
  ON r.vacancy_id = h.vacancy_id
LEFT JOIN (SELECT vacancy_id, COUNT(*) AS n FROM
           (SELECT DISTINCT l.l_orderkey AS vacancy_id, s.s_nationkey
            FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
            JOIN nation n ON s.s_nationkey = n.n_nationkey) GROUP BY vacancy_id) s
  ON s.vacancy_id = h.vacancy_id""")
    q["enrich_fallback"] = head.replace("{body}", "SELECT vacancy_id, name FROM head")
    # ------------------------------------------------------------------ sinks
    q["upsert_lww"] = LATEST_EVENT.format(d="DESC")
    q["insert_ignore"] = LATEST_EVENT.format(d="ASC")
    q["upsert_document"] = f"""
SELECT CAST(user_id AS VARCHAR) AS _id, event_id, event_type FROM ({LATEST_EVENT.format(d="DESC")})"""
    q["upsert_composite_key"] = with_ctes(DICTIONARY, body="SELECT * FROM dict")
    q["flatten_hierarchy"] = q["upsert_composite_key"]
    q["src_dictionary"] = q["upsert_composite_key"]
    q["composite_doc_key"] = with_ctes(DICTIONARY, body="""
SELECT industry_id || ':' || COALESCE(sphere_id, '') AS _id, industry_id, sphere_id,
       COALESCE(sphere_name, industry_name) AS doc_name,
       industry_id || ':' || COALESCE(sphere_id, '') AS doc_id
FROM dict""")
    q["full_refresh"] = with_ctes(*STAR, body=MART_SALARY_BODY)
    q["upsert_scd1"] = with_ctes(*STAR, body="SELECT area_id, area_name FROM dim_area")
    q["dim_area"] = q["upsert_scd1"]
    # ---------------------------------------------------------------- flatten
    q["flatten_postings"] = with_ctes(POSTINGS, body="""
SELECT vacancy_id AS id, name, area_name, employer_name, published_at FROM postings""")
    q["flatten_employers"] = with_ctes(POSTINGS, FACTS, EMPLOYERS, EMPLOYER_FEED, body="""
SELECT employer_id AS id, employer_name AS name, area_name, open_vacancies,
       alternate_url AS site_url FROM feed""")
    q["upsert_naive"] = with_ctes(POSTINGS, body="""
SELECT vacancy_id AS id, name, area_name, employer_name,
       CAST(published_date + INTERVAL 12 HOUR AS TIMESTAMP) AS published_at FROM postings""")
    renewed = f"name || CASE WHEN vacancy_id % 7 = 0 THEN '{RENEWED}' ELSE '' END AS name"
    q["copies_postings_naive"] = with_ctes(POSTINGS, body=f"""
SELECT vacancy_id AS id, {renewed}, area_name, employer_name,
       CAST(published_date + INTERVAL 12 HOUR AS TIMESTAMP) AS published_at FROM postings""")
    q["copies_postings_documents"] = with_ctes(POSTINGS, body=f"""
SELECT CAST(vacancy_id AS VARCHAR) AS _id, {renewed}, employer_id FROM postings""")
    q["src_pages_by_file_time"] = with_ctes(POSTINGS, body=f"SELECT vacancy_id AS id, {renewed} FROM postings")
    raised = "CAST(open_vacancies + CASE WHEN employer_id % 3 = 0 THEN 100 ELSE 0 END AS INTEGER) AS open_vacancies"
    feed = with_ctes(POSTINGS, FACTS, EMPLOYERS, EMPLOYER_FEED, body="{body}")
    q["copies_employers_naive"] = feed.replace("{body}", f"""
SELECT employer_id AS id, employer_name AS name, area_name, {raised}, alternate_url AS site_url FROM feed""")
    q["copies_employers_documents"] = feed.replace("{body}", f"""
SELECT CAST(employer_id AS VARCHAR) AS _id, {raised} FROM feed""")
    both = f"""
SELECT * FROM dict UNION
SELECT CAST(r_regionkey AS VARCHAR), r_name || '{RENEWED}', NULL, NULL FROM region"""
    q["copies_industries_naive"] = with_ctes(DICTIONARY, body=both)
    q["copies_industries_documents"] = with_ctes(DICTIONARY, body=f"""
SELECT industry_id || ':' || COALESCE(sphere_id, '') AS _id, industry_id, sphere_id,
       industry_id || ':' || COALESCE(sphere_id, '') AS doc_id, COALESCE(sphere_name, industry_name) AS doc_name
FROM ({both})""")
    q["naive_timestamp"] = """
SELECT o_orderkey AS vacancy_id,
       CAST(CAST(o_orderdate AS DATE) + INTERVAL 12 HOUR AS TIMESTAMP) AS published_naive
FROM orders"""
    q["json_roundtrip"] = with_ctes(POSTINGS, body="""
SELECT p.vacancy_id, p.employer_id, p.area_id, p.salary_from, p.salary_to, p.salary_currency,
       p.salary_gross, p.trusted,
       CAST(COALESCE(r.n, -1) AS INTEGER) AS n_roles, CAST(COALESCE(s.n, -1) AS INTEGER) AS n_specs
FROM postings p
LEFT JOIN (SELECT vacancy_id, COUNT(*) AS n FROM role_pairs GROUP BY vacancy_id) r
  ON r.vacancy_id = p.vacancy_id
LEFT JOIN (SELECT vacancy_id, COUNT(*) AS n FROM sphere_pairs GROUP BY vacancy_id) s
  ON s.vacancy_id = p.vacancy_id""")
    # -------------------------------------------------------------------- DDS
    q["dim_date"] = with_ctes(POSTINGS, body="""
SELECT CAST(d AS DATE) AS date_key, CAST(year(d) AS INTEGER) AS year,
       CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
       CAST(dayofweek(d) AS INTEGER) AS day_of_week, CAST(week(d) AS INTEGER) AS week
FROM (SELECT unnest(generate_series(MIN(published_date), MAX(published_date), INTERVAL 1 DAY)) AS d
      FROM postings)""")
    q["stage_employers"] = with_ctes(*STAR_EMP, body="SELECT * FROM staged2")
    q["scd2_expire"] = with_ctes(*STAR_EMP, body=f"""
SELECT employer_id, employer_name, alternate_url, trusted, {RUN_1_AT} AS valid_from,
       CASE WHEN employer_id IN (SELECT employer_id FROM changed) THEN {RUN_2_AT}
            ELSE TIMESTAMP '9999-12-31 00:00:00' END AS valid_to,
       employer_id NOT IN (SELECT employer_id FROM changed) AS is_current
FROM staged1""")
    q["scd2_insert"] = with_ctes(*STAR_EMP, body=f"""
SELECT employer_id, employer_name, alternate_url, trusted, {RUN_1_AT} AS valid_from,
       TIMESTAMP '9999-12-31 00:00:00' AS valid_to, TRUE AS is_current
FROM staged1
UNION ALL
SELECT employer_id, employer_name, alternate_url, trusted, {RUN_2_AT} AS valid_from,
       TIMESTAMP '9999-12-31 00:00:00' AS valid_to, TRUE AS is_current
FROM staged2 WHERE employer_id NOT IN (SELECT employer_id FROM staged1)""")
    q["scd2_full"] = with_ctes(*STAR_EMP, body=f"SELECT {DIM_EMP_COLS} FROM dim_employer")
    q["scd2_tracked_subset"] = with_ctes(*STAR_EMP, EMPLOYER_FEED,
                                         body=f"SELECT {DIM_EMP_COLS} FROM dim_after_feed")
    same_run = EMPLOYER_FEED.replace(FEED_AT, RUN_2_AT)
    q["scd2_feed_same_run"] = with_ctes(*STAR_EMP, same_run, body=f"""
SELECT {DIM_EMP_COLS}, CAST(1 AS BIGINT) AS rows_of_key FROM dim_after_feed""")
    q["mart_top_employers_after_feed"] = with_ctes(*STAR_EMP, same_run, """
kept_versions AS (
  SELECT * FROM dim_employer WHERE is_current AND employer_id NOT IN (SELECT employer_id FROM fchanged)
)""", mart_top_cte(20, employers="kept_versions"), body="SELECT * FROM m4")
    q["raw_lossless"] = with_ctes(POSTINGS, body="""
SELECT p.vacancy_id, CASE WHEN p.salary_gross THEN 'true' ELSE 'false' END AS premium,
       CAST(COALESCE(r.n, 0) AS INTEGER) AS responses, p.name AS label, p.salary_from
FROM postings p LEFT JOIN (SELECT vacancy_id, COUNT(*) AS n FROM role_pairs GROUP BY vacancy_id) r
  ON r.vacancy_id = p.vacancy_id""")
    q["stream_one_trigger"] = with_ctes(POSTINGS, body=f"""
SELECT vacancy_id AS id, CASE WHEN published_at < {RUN_1_AT} THEN name ELSE 'draft' END AS name, employer_name
FROM postings""")
    q["fact_incremental"] = with_ctes(*STAR_EMP, body=f"""
SELECT vacancy_id, name, employer_id,
       CASE version WHEN 1 THEN {RUN_1_AT} ELSE {RUN_2_AT} END AS employer_version,
       area_id, published_date, salary_from, salary_to, salary_currency, salary_gross,
       CASE WHEN published_at < {RUN_1_AT} THEN {RUN_1_AT} ELSE {RUN_2_AT} END AS created_at
FROM fact_ver""")
    q["stream_cycles"] = q["fact_incremental"]
    q["bridge_explode"] = with_ctes(POSTINGS, body="""
SELECT vacancy_id, sphere_id FROM sphere_pairs
WHERE sphere_id <> '' AND vacancy_id IN (SELECT vacancy_id FROM postings)""")
    q["dim_role"] = with_ctes(POSTINGS, body="""
SELECT role_id, role_name FROM (
  SELECT r.role_id, r.role_name, row_number() OVER (PARTITION BY r.role_id
         ORDER BY p.published_at DESC NULLS LAST, p.vacancy_id DESC NULLS LAST,
                  r.role_name DESC NULLS LAST) AS rn
  FROM role_pairs r JOIN postings p ON p.vacancy_id = r.vacancy_id
  WHERE r.role_id <> '') WHERE rn = 1""")
    q["bridge_role"] = with_ctes(POSTINGS, body="""
SELECT vacancy_id, role_id FROM role_pairs
WHERE role_id <> '' AND vacancy_id IN (SELECT vacancy_id FROM postings)""")
    q["fact_snapshot"] = with_ctes(*STAR_EMP, EMPLOYER_FEED, body="""
SELECT f.employer_id, DATE '2001-09-01' AS snapshot_date, f.area_name, f.open_vacancies,
       f.alternate_url AS site_url
FROM feed f JOIN dim_after_feed d ON d.employer_id = f.employer_id AND d.is_current""")
    q["dim_industry"] = with_ctes(DICTIONARY, body="""
SELECT industry_id, MAX(industry_name) AS industry_name FROM dict
WHERE industry_id IS NOT NULL GROUP BY industry_id""")
    q["dim_sphere"] = with_ctes(DICTIONARY, body="""
SELECT sphere_id, sphere_name, industry_id FROM (
  SELECT sphere_id, sphere_name, industry_id, row_number() OVER (PARTITION BY sphere_id
         ORDER BY sphere_name DESC NULLS LAST, industry_id DESC NULLS LAST) AS rn
  FROM dict WHERE sphere_id IS NOT NULL) WHERE rn = 1""")
    # --------------------------------------------------------------------- DQ
    q["dq_row_counts"] = with_ctes(*STAR, body="""
SELECT 'row_counts' AS "check", ods_total, ods_eligible, dds_count,
       CASE WHEN ods_eligible = 0 THEN 'SKIP' WHEN ods_eligible <> dds_count THEN 'FAIL'
            ELSE 'PASS' END AS status
FROM (SELECT (SELECT COUNT(*) FROM postings) AS ods_total,
             (SELECT COUNT(*) FROM postings WHERE employer_id IS NOT NULL) AS ods_eligible,
             (SELECT COUNT(*) FROM facts) AS dds_count)""")
    q["dq_null_keys"] = with_ctes(*STAR, body="""
SELECT 'null_keys' AS "check", COUNT(*) FILTER (WHERE published_date IS NULL) AS invalid_count,
       CASE WHEN COUNT(*) FILTER (WHERE published_date IS NULL) > 0 THEN 'FAIL' ELSE 'PASS' END
         AS status
FROM facts""")
    q["dq_date_range"] = with_ctes(*STAR, body="""
SELECT 'date_range' AS "check", MIN(published_date) AS min_date, MAX(published_date) AS max_date,
       COUNT(*) FILTER (WHERE published_date < DATE '2000-01-01') AS too_old,
       COUNT(*) FILTER (WHERE published_date > DATE '2001-09-01') AS in_future,
       CASE WHEN COUNT(*) FILTER (WHERE published_date < DATE '2000-01-01'
                                     OR published_date > DATE '2001-09-01') > 0
            THEN 'FAIL' ELSE 'PASS' END AS status
FROM facts""")
    q["dq_foreign_keys"] = with_ctes(*STAR_EMP, body="""
SELECT relation, orphans, CASE WHEN orphans > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM (
  SELECT 'fact_vacancy.employer_sk' AS relation,
         (SELECT COUNT(*) FROM fact_ver v WHERE NOT EXISTS (
            SELECT 1 FROM dim_employer e
            WHERE e.employer_id = v.employer_id AND e.version = v.version)) AS orphans
  UNION ALL
  SELECT 'fact_vacancy.area_id',
         (SELECT COUNT(*) FROM facts f WHERE f.area_id IS NOT NULL
            AND f.area_id NOT IN (SELECT area_id FROM dim_area))
  UNION ALL
  SELECT 'fact_vacancy.published_date',
         (SELECT COUNT(*) FROM facts f WHERE f.published_date < (SELECT MIN(published_date) FROM postings)
            OR f.published_date > (SELECT MAX(published_date) FROM postings))
  UNION ALL
  SELECT 'bridge_role.role_id',
         (SELECT COUNT(*) FROM role_pairs b WHERE b.role_id <> ''
            AND b.vacancy_id IN (SELECT vacancy_id FROM postings)
            AND b.role_id NOT IN (SELECT role_id FROM dim_role)))""")
    # ------------------------------------------------------------------ marts
    q["primary_role"] = with_ctes(*STAR, body="SELECT vacancy_id, role_id AS industry_id FROM primary_roles")
    q["salary_point"] = with_ctes(*STAR, body="""
SELECT vacancy_id,
       CASE WHEN salary_from IS NOT NULL AND salary_to IS NOT NULL
            THEN CAST(CAST(salary_from + salary_to AS DECIMAL(20,3)) * 0.5 AS DECIMAL(22,3))
            ELSE CAST(COALESCE(salary_from, salary_to) AS DECIMAL(22,3)) END AS salary_point
FROM facts""")
    q["currency_label"] = with_ctes(*STAR, body="""
SELECT vacancy_id, COALESCE(NULLIF(salary_currency, ''), 'UNKNOWN') AS currency FROM facts""")
    q["star_join"] = with_ctes(*STAR, body="""
SELECT vacancy_id, month, industry_id, industry_name, area_id, area_name, currency,
       salary_point::DECIMAL(22,3) AS salary_point
FROM counted""")
    q["mart_salary"] = with_ctes(*STAR, body=MART_SALARY_BODY)
    q["mart_regions"] = with_ctes(*STAR, MART_REGIONS_CTE, body="SELECT * FROM m2")
    q["mart_trends"] = with_ctes(*STAR, MART_TRENDS_CTE, body="SELECT * FROM m3")
    q["mart_top_employers"] = with_ctes(*STAR_EMP, mart_top_cte(20), body="SELECT * FROM m4")
    q["mart_top_employers_k3"] = with_ctes(*STAR_EMP, mart_top_cte(3), body="SELECT * FROM m4")
    q["mart_currency"] = with_ctes(*STAR, MART_CURRENCY_CTE, body="SELECT * FROM m5")
    for m in ("salary", "regions", "trends", "top_employers", "currency"):
        q[f"mart_{m}_from_partials"] = q[f"mart_{m}"]
    q["mart_partials"] = with_ctes(*STAR_EMP, body=f"""
SELECT month, industry_id, area_id, currency, c.employer_id,
       CASE v.version WHEN 1 THEN {RUN_1_AT} ELSE {RUN_2_AT} END AS employer_version,
       COUNT(*) AS vacancies_cnt, COUNT(salary_point) AS vacancies_with_salary_cnt,
       SUM(salary_point)::DECIMAL(38,3) AS salary_sum, MIN(salary_point)::DECIMAL(22,3) AS salary_min,
       MAX(salary_point)::DECIMAL(22,3) AS salary_max
FROM counted c JOIN (SELECT vacancy_id, version FROM fact_ver) v USING (vacancy_id) GROUP BY ALL""")
    q["batch_changes"] = with_ctes(*STAR, body=f"""
SELECT p.vacancy_id, coalesce(p.published_at < {RUN_1_AT}, false) AS replaced,
       NOT coalesce(p.published_at < {RUN_1_AT}, false) AND f.vacancy_id IS NOT NULL AS new_fact,
       CASE WHEN p.published_at < {RUN_1_AT} THEN 0 ELSE coalesce(r.n, 0) END AS new_roles
FROM postings p LEFT JOIN facts f USING (vacancy_id)
LEFT JOIN (SELECT vacancy_id, COUNT(DISTINCT role_id) AS n FROM roles_of GROUP BY 1) r USING (vacancy_id)""")
    q["dq_observed"] = with_ctes(*STAR, body=f"""
SELECT 'row_counts' AS "check",
       CASE WHEN e = 0 THEN 'SKIP' WHEN e <> n THEN 'FAIL' ELSE 'PASS' END AS status,
       '{{"ods_total":' || t || ',"ods_eligible":' || e || ',"dds_count":' || n || '}}' AS metrics
FROM (SELECT COUNT(*) AS t, COUNT(employer_id) AS e, (SELECT COUNT(*) FROM facts) AS n FROM postings)
UNION ALL SELECT 'null_keys', 'PASS', '{{"invalid_count":0}}'
UNION ALL
SELECT 'date_range', CASE WHEN o + l > 0 THEN 'FAIL' ELSE 'PASS' END,
       '{{"min_date":"' || a || '","max_date":"' || b || '","too_old":' || o || ',"in_future":' || l || '}}'
FROM (SELECT MIN(published_date) AS a, MAX(published_date) AS b,
             COUNT(*) FILTER (WHERE published_date < DATE '2000-01-01') AS o,
             COUNT(*) FILTER (WHERE published_date > DATE '2001-09-01') AS l FROM facts)
UNION ALL
SELECT 'rejected_postings', 'PASS', '{{"fetched":' || (COUNT(*) + COUNT(*) FILTER (WHERE published_at < {RUN_1_AT}))
       || ',"rejected":0}}' FROM postings""")
    q["enrich_fallback_taken"] = with_ctes(*STAR, body="""
SELECT vacancy_id, name, published_date, 0::BIGINT AS n_roles FROM facts""")
    q["load_with_details"] = q["bridge_role"]
    # --------------------------------------------------------------------- BI
    q["bi_avg_salary"] = with_ctes(*STAR, f"m1 AS ({MART_SALARY_BODY})", body="""
SELECT industry_name, currency, CAST(SUM(CAST(floor(salary_avg * 1000000.0 + 0.5) AS DECIMAL(38,0))) AS DOUBLE)
         / (CAST(COUNT(salary_avg) AS DOUBLE) * 1000000.0) AS salary_avg_avg FROM m1
GROUP BY industry_name, currency""")
    share = """
c2s AS (
  SELECT industry_name, currency, SUM(vacancies_cnt)::BIGINT AS vacancies_cnt_sum,
         SUM(vacancies_cnt)::DOUBLE / SUM(SUM(vacancies_cnt)) OVER (PARTITION BY industry_name) AS contribution
  FROM m5 GROUP BY industry_name, currency
)"""
    q["bi_currency_share"] = with_ctes(*STAR, MART_CURRENCY_CTE, share, body="""
SELECT * FROM c2s""")
    q["bi_currency_pivot"] = with_ctes(*STAR, MART_CURRENCY_CTE, share, body="""
SELECT industry_name,
       MAX(CASE WHEN currency = 'RUR' THEN contribution END) AS "RUR",
       MAX(CASE WHEN currency = 'UNKNOWN' THEN contribution END) AS "UNKNOWN",
       MAX(CASE WHEN currency = 'USD' THEN contribution END) AS "USD"
FROM c2s GROUP BY industry_name""")
    q["bi_heatmap"] = with_ctes(*STAR, MART_REGIONS_CTE, body="""
SELECT industry_name, area_name, CAST(SUM(vacancies_cnt) AS BIGINT) AS vacancies_cnt_sum
FROM m2 GROUP BY industry_name, area_name""")
    q["bi_trend_line"] = with_ctes(*STAR, MART_TRENDS_CTE, body="""
SELECT CAST(date_trunc('month', month) AS DATE) AS month, industry_name,
       CAST(SUM(vacancies_cnt) AS BIGINT) AS vacancies_cnt_sum
FROM m3 GROUP BY 1, industry_name""")
    q["bi_top_table"] = with_ctes(*STAR_EMP, mart_top_cte(20), body="""
SELECT industry_name, area_name, currency, employer_name, vacancies_cnt, salary_avg FROM m4
ORDER BY vacancies_cnt DESC, salary_avg DESC NULLS LAST, industry_name, area_name NULLS LAST,
         currency, employer_name LIMIT 100""")
    # -------------------------------------------------------------- benchmark
    q["bench_counts"] = with_ctes(POSTINGS, DICTIONARY, body="""
SELECT 'vacancies' AS table_name, COUNT(*) AS row_count FROM postings
UNION ALL SELECT 'employers', COUNT(*) FROM customer
UNION ALL SELECT 'salary_industries', COUNT(*) FROM dict""")
    q["bench_by_area"] = with_ctes(POSTINGS, body="""
SELECT area_name, COUNT(*) AS cnt FROM postings GROUP BY area_name""")
    q["bench_by_nested_path"] = with_ctes(POSTINGS, body="""
SELECT employer_name, COUNT(*) AS cnt FROM postings GROUP BY employer_name""")
    q["bench_by_json_key"] = """
SELECT json_extract_string(props, '$.k') AS k, COUNT(*) AS cnt FROM events GROUP BY 1"""
    q["duration_stats"] = """
SELECT event_type, COUNT(value) AS runs, MIN(value * 1000.0) AS min_ms,
       floor(AVG(value * 1000.0) * 1000000.0 + 0.5) / 1000000.0 AS avg_ms, MAX(value * 1000.0) AS max_ms,
       floor(CASE WHEN COUNT(value) > 1 THEN stddev_pop(value * 1000.0) ELSE 0.0 END * 1000000.0 + 0.5) / 1000000.0 AS std_ms
FROM events GROUP BY event_type"""
    q["mean_of_means"] = """
SELECT event_type, floor(AVG(avg_ms) * 1000000.0 + 0.5) / 1000000.0 AS mean_of_means, COUNT(*) AS n_items FROM (
  SELECT event_type, user_id, AVG(value * 1000.0) AS avg_ms
  FROM events GROUP BY event_type, user_id)
GROUP BY event_type"""
    return q
