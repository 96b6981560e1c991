"""Write docs/PLANS.md: the static physical plan (AQE off, so the shape is
visible before run-time re-planning) of the main jobs at sf0.1.

Usage: python tests/show_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

JOBS = ["user_post_statistics", "user_grade", "merge_last_wins", "search_index",
        "issue_board", "catalogue_weapon"]


def main():
    from quartermaster.session import local_session
    import __spark_entry__ as e
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    out = ["# Physical plans of the main jobs", "",
           f"Static plans (AQE off) at `{os.path.basename(sf)}`, from `tests/show_plans.py`. "
           "Expression ids removed, long lines cut.", ""]
    for name in JOBS:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            e.queries()[name](spark, sf).explain()
        lines = [re.sub(r"#\d+L?", "", ln)[:170] for ln in buf.getvalue().splitlines() if ln.strip()]
        out += [f"## {name}", "", "```", *lines, "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
