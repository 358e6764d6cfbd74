"""python -m tests.check_oracle SF_DIR [query ...]: compare and print one line each."""

from __future__ import annotations

import sys

import __spark_entry__ as entry
from tests.compare import report
from tests.conftest import local_session

if __name__ == "__main__":
    sf_dir, names = sys.argv[1], sys.argv[2:]
    chosen = {k: v for k, v in entry.queries().items() if not names or k in names}
    failed = report(local_session(), sf_dir, chosen, entry.oracle_sql())
    print("failed:", failed or "none")
