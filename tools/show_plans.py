"""Write the executed (final AQE) plans of the core queries to PLANS.md.

    python tools/show_plans.py [--sf-dir DIR] [--out PLANS.md]

The upload job is shown without its materialisation points so that the whole
job is one plan; attribute ids are stripped and long lines cut.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _clean(plan: str, width: int = 170) -> str:
    plan = plan.split("+- == Initial Plan ==")[0]
    plan = re.sub(r"#\d+L?", "", plan)
    plan = re.sub(r", \[plan_id=\d+\]", "", plan)
    plan = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\], ", "", plan)
    return "\n".join(line[:width] for line in plan.splitlines())


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--out", default="PLANS.md")
    args = ap.parse_args()
    from upcheck.session import get_session
    from upcheck.plans import catalog as c
    from upcheck.plans.upload_job import process_upload

    # no broadcasts: the plans that large inputs get
    spark = get_session("local[8]", shuffle_partitions=16, extra_conf={
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    cases = {
        "q_reconciled (clean rows of the reconciliation)": lambda: c.q_reconciled(spark, args.sf_dir),
        "q_conflict_audit (one-pass conflict audit)": lambda: c.q_conflict_audit(spark, args.sf_dir),
        "q_quarantine_strict (token validation, id-level quarantine)":
            lambda: c.q_quarantine_strict(spark, args.sf_dir),
        "upload job: final clean rows (the one wide join, over the landed table)":
            lambda: process_upload(*c.ab_inputs(spark, args.sf_dir), c.AB_PRESET).clean,
        "upload job: audit (narrow read of the flagged rows)":
            lambda: process_upload(*c.ab_inputs(spark, args.sf_dir), c.AB_PRESET).audit,
    }

    parts = [f"# Executed plans ({args.sf_dir}, local[8], AQE final plans)\n",
             "Generated by `tools/show_plans.py` with broadcasts off, as at scale.\n"]
    for title, make in cases.items():
        df = make()
        df.collect()
        parts.append(f"## {title}\n\n```\n{_clean(df._jdf.queryExecution().executedPlan().toString())}\n```\n")
    with open(args.out, "w") as f:
        f.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()
