"""Write PLANS.md: for every catalogue query, the physical plan's shuffle,
broadcast, scan and join counts (from ``explain``), plus the scan's pushed
filters and read schema of the headline queries.

    python scripts/plan_report.py [sf_dir]
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from matchforge.plans.catalog import queries  # noqa: E402
from matchforge.plans.checked import CHECKED  # noqa: E402
from matchforge.plans.explain import plan_summary, plan_text  # noqa: E402
from matchforge.plans.landed import LANDED  # noqa: E402
from matchforge.session import build_session  # noqa: E402

# Queries whose builders run jobs (writes, fits) before returning; their
# returned plan is a read of the written result.
EAGER = {"csv_all_string_cast", "append_if_absent", "incremental_load", "star_load",
         "model_score"} | {f.__name__ for f in (*LANDED, *CHECKED)}
DETAIL = ["performance_single_pass", "performance_union_agg", "performance_table",
          "first_wins_dedupe", "roster_online", "ml_features"]


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    qs = queries()
    lines = ["# Physical plans", "",
             f"Generated by `scripts/plan_report.py` at `{sf_dir}` (pre-AQE plan tree; AQE may",
             "turn a sort-merge join into a broadcast join at run time and reuses identical",
             "exchanges, so a scan listed twice can run once).", "",
             "| query | exchanges | broadcasts | scans | sort-merge joins | python evals |",
             "|---|---|---|---|---|---|"]
    for name in qs:
        if name in EAGER:
            continue
        s = plan_summary(qs[name](spark, sf_dir))
        lines.append(f"| `{name}` | {s['exchanges']} | {s['broadcasts']} | {s['scans']} | "
                     f"{s['sort_merge_joins']} | {s['python_evals']} |")
    lines += ["", "Builders that write before returning (their plan is a read of the "
              "result): " + ", ".join(f"`{n}`" for n in sorted(EAGER)) + ".", ""]
    for name in DETAIL:
        text = plan_text(qs[name](spark, sf_dir))
        tree = text.split("\n\n", 1)[0]
        scans = re.findall(r"(PushedFilters: .*|ReadSchema: .*)", text)
        lines += [f"## `{name}`", "", "```", tree.strip(), "```", ""]
        if scans:
            lines += ["Scans:", ""] + [f"- `{s}`" for s in scans] + [""]
    (ROOT / "PLANS.md").write_text("\n".join(lines) + "\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
