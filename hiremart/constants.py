"""Fixed values.

These values must equal the reference's for the results to match; they are
stated here once, plainly, and imported where used.
"""

import datetime as _dt

# ---- Fixed values --------------------------------------------------------
UNKNOWN_LABEL = "UNKNOWN"                      # empty/NULL currency; NULL role name
END_OF_TIME = _dt.datetime(9999, 12, 31)       # valid_to of a current SCD2 version
TOP_EMPLOYERS_K = 20                           # employers kept per role × area × currency
MAX_DETAIL_ITEMS = 200                         # search rows replaced by their detail records
#: Columns that order the landed documents by arrival: fetch, page of it, position on the page.
ARRIVAL = ("_fetch", "_page", "_pos")
PAGE_SIZE = 100                                # items per search / list page
DQ_MIN_DATE = "2000-01-01"                     # earliest plausible publication date
CHILD_ARRAYS = ("industries", "spheres", "areas")   # dictionary child arrays, first non-empty wins
DOC_ID_SEPARATOR = ":"                         # composite document id "industry:sphere"
CHART_ROW_LIMITS = {                           # row limits of the five charts
    "avg_salary": 1000,
    "currency_share": 1000,
    "heatmap": 5000,
    "trend_line": 10000,
    "top_table": 100,
}
