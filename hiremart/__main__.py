"""Command line: one scheduled run of the warehouse job.

    python -m hiremart run --postings <dir> --employers <dir> \\
        --industries <file-or-dir> --warehouse <dir> --run-id N \\
        --now 2025-01-01T00:00:00 --as-of 2025-01-01

(on a cluster: ``spark-submit --py-files hiremart.zip hiremart/__main__.py run …``)

``--postings`` / ``--employers``: landed page documents (JSON lines
``{"page": n, "items": [...]}``); ``--industries``: the dictionary as one JSON
array.  Prints the data-quality rows and exits non-zero when a check failed.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from hiremart import schemas
from hiremart.session import build_session


def _parse(argv):
    p = argparse.ArgumentParser(prog="hiremart")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="one scheduled run: ODS → DDS → marts → DQ")
    r.add_argument("--postings", required=True)
    r.add_argument("--employers", required=True)
    r.add_argument("--industries", required=True)
    r.add_argument("--details", default=None, help="landed detail records that replace the search rows")
    r.add_argument("--warehouse", required=True)
    r.add_argument("--run-id", type=int, required=True)
    r.add_argument("--now", required=True, help="ISO timestamp of the run (UTC)")
    r.add_argument("--as-of", required=True, help="snapshot day, YYYY-MM-DD")
    r.add_argument("--top-k", type=int, default=None)
    r.add_argument("--ods-buckets", type=int, default=64,
                   help="hash buckets of the ODS tables; fixed per warehouse, ~a few hundred MB each")
    r.add_argument("--master", default=None)
    r.add_argument("--profile", default="cluster", choices=["cluster", "local"])
    return p.parse_args(argv)


def main(argv=None, spark=None) -> int:
    from hiremart.constants import TOP_EMPLOYERS_K
    from hiremart.plans.scheduled_run import run_scheduled
    from hiremart.session import configure
    from hiremart.sources import landing

    a = _parse(argv)
    spark = configure(spark) if spark is not None else build_session(a.master, profile=a.profile)
    state = run_scheduled(
        spark,
        postings=landing.read_paged_items(spark, a.postings, schemas.POSTING_PAGE),
        employers=landing.read_paged_items(spark, a.employers, schemas.EMPLOYER_PAGE),
        industries=landing.read_dictionary(spark, a.industries, schemas.INDUSTRY_DOC),
        warehouse_path=a.warehouse, run_id=a.run_id,
        now=dt.datetime.fromisoformat(a.now), as_of=dt.date.fromisoformat(a.as_of),
        top_k=a.top_k or TOP_EMPLOYERS_K, ods_buckets=a.ods_buckets,
        details=landing.read_paged_items(spark, a.details, schemas.POSTING_PAGE) if a.details else None)
    checks = state.checks.collect()          # a dozen one-row checks
    for row in checks:
        print(f"{row['check']}\t{row['status']}\t{row['metrics']}")
    return 1 if any(r["status"] == "FAIL" for r in checks) else 0


if __name__ == "__main__":
    sys.exit(main())
