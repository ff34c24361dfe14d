"""Plan checks from ``DataFrame.explain`` output: how many shuffles, scans,
broadcasts and Python evaluations a query's physical plan holds."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def plan_summary(df: DataFrame) -> dict[str, int]:
    """Counts of operators in the (pre-AQE) physical plan tree."""
    text = plan_text(df, "formatted")
    tree = text.split("\n\n", 1)[0]
    def count(pattern):
        return len(re.findall(pattern, tree))
    return {
        "exchanges": count(r"\bExchange\b"),
        "broadcasts": count(r"BroadcastExchange"),
        "scans": count(r"Scan (parquet|csv|json)"),
        "sort_merge_joins": count(r"SortMergeJoin"),
        "python_evals": count(r"(ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|"
                              r"MapInPandas)"),
    }
