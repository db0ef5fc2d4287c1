"""End to end, like the original job: CSV -> clean -> Parquet -> catalogue -> report.

Usage: python tools/run_report.py [sf_dir] [group ...]

The driver tables hold no petition CSV, so the RAW rows are projected from
them and landed as CSV first; everything after that is the library's normal
path.  Scratch data goes under ``spark.checkpoint.dir`` (a fresh temporary
folder only when unset, as on a single machine).
"""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from petitionlens.operators import row_count  # noqa: E402
from petitionlens.plans.ingest import ingest, run_catalogue  # noqa: E402
from petitionlens.plans.report import report  # noqa: E402
from petitionlens.session import ensure_shared_dir, local_session  # noqa: E402
from petitionlens.sources import raw_petitions  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    groups = tuple(sys.argv[2:]) or ("basic", "additional", "task", "timing")
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    root = f"{ensure_shared_dir(spark, tempfile.mkdtemp(prefix='petitionlens-report-'))}/report-{os.getpid()}"
    raw_petitions(spark, sf_dir).write.option("header", True).option("escape", '"').csv(f"{root}/landing")
    table = ingest(spark, f"{root}/landing", f"{root}/petitions")
    print(f"{row_count(table).first()[0]} records in the clean table.")
    params = {"cert_state_year_count": {"state": "AMERICA"}}
    print(report(run_catalogue(table, groups, params=params), groups))
    spark.stop()


if __name__ == "__main__":
    main()
