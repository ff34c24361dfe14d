"""Quality rules as weak supervision.

Each rule votes good (1), bad (-1) or abstains (0) on a document. Expectation
maximisation over a two-class latent model estimates, for each rule, how often
it votes each way on good and on bad documents (its accuracies) and how common
good documents are; a document is kept if its posterior probability of being
good is at least one half. No rule decides alone and none must be passed.

The votes of R rules have at most 3^R patterns, so the model is fitted on the
count of each pattern over *all* documents: one map-side combined aggregation,
whose result has that proven bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchforge.llm.common import by_bytes, id_text, ship, stage
from matchforge.llm.words import codes_of, line_counts, per_doc, repeat_words, split_words

SYMBOLS = "[#*$%&|<>]"

#: name: (feature, votes bad if it is ... , votes good if it is ...); between them it abstains.
RULES = {
    "length": ("n_words", ("<", 10), (">=", 40)),
    "word_length": ("mean_word", ("out", 2.5, 12.0), ("in", 3.0, 9.0)),
    "symbols": ("symbol_share", (">", 0.1), ("<", 0.02)),
    "line_repeats": ("dup_line_share", (">", 0.3), ("<", 0.1)),
    "window_repeats": ("repeat_share", (">", 0.2), ("<", 0.05)),
    "symbol_runs": ("run_share", (">", 0.05), ("<", 0.01)),
    "odd_words": ("odd_share", (">", 0.2), ("<", 0.05)),
    "letters": ("alpha_share", ("<", 0.7), (">", 0.9)),
    "capitals": ("upper_share", (">", 0.5), ("<", 0.2)),
    "variety": ("distinct_share", ("<", 0.2), (">", 0.35)),
    "sentence_ends": ("marks_per_word", (">", 0.6), ("<", 0.4)),
}
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SCHEMA = "id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, votes string"


def features(text: pa.Array) -> dict[str, np.ndarray]:
    """Base counts and rule features of whole texts (null: empty)."""
    n = len(text)
    text = pc.fill_null(text, "")
    doc, words = split_words(text)
    code, distinct = codes_of(words)
    count = lambda pattern: pc.count_substring_regex(text, pattern).to_numpy(zero_copy_only=False).astype(np.int64)
    chars = pc.utf8_length(distinct).to_numpy(zero_copy_only=False).astype(np.int64)
    alpha = pc.match_substring_regex(distinct, r"\p{L}").to_numpy(zero_copy_only=False).astype(np.int64)
    odd = pc.match_substring_regex(distinct, r"[^\p{L}\p{M}\p{N}.,;:!?'\"()-]").to_numpy(zero_copy_only=False).astype(np.int64)
    lines, dup_lines, _, _ = line_counts(text)
    f = {"n_words": per_doc(doc, n), "word_chars": per_doc(doc, n, chars[code]), "n_symbols": count(SYMBOLS),
         "n_dup_lines": dup_lines, "n_repeat_words": repeat_words(doc, code, n)}
    w = np.maximum(f["n_words"], 1)
    pairs = np.unique(doc * (len(distinct) + 1) + code)
    kinds = per_doc(pairs // (len(distinct) + 1), n)
    letters = pc.utf8_length(pc.replace_substring_regex(distinct, r"\P{L}", "")).to_numpy(zero_copy_only=False).astype(np.int64)
    capitals = pc.utf8_length(pc.replace_substring_regex(distinct, r"\P{Lu}", "")).to_numpy(zero_copy_only=False).astype(np.int64)
    f |= {
        "mean_word": f["word_chars"] / w,
        "symbol_share": f["n_symbols"] / w,
        "dup_line_share": dup_lines / np.maximum(lines, 1),
        "repeat_share": f["n_repeat_words"] / w,
        "alpha_share": per_doc(doc, n, alpha[code]) / w,
        "upper_share": per_doc(doc, n, capitals[code]) / np.maximum(per_doc(doc, n, letters[code]), 1),
        # Long texts repeat words anyway: the share is taken of what 200 words could show.
        "distinct_share": kinds / np.minimum(w, 200),
        "run_share": count(SYMBOLS + "{2,}") / w,
        "odd_share": per_doc(doc, n, odd[code]) / w,
        "marks_per_word": count(r"[.!?;:,]") / w,
    }
    return f


def vote(f: dict[str, np.ndarray]) -> np.ndarray:
    """(documents, rules) votes in -1, 0, 1."""
    test = {"<": lambda x, a: x < a, ">": lambda x, a: x > a, ">=": lambda x, a: x >= a,
            "in": lambda x, a, b: (x >= a) & (x <= b), "out": lambda x, a, b: (x < a) | (x > b)}
    return np.stack([np.where(test[bad[0]](f[x], *bad[1:]), -1, np.where(test[good[0]](f[x], *good[1:]), 1, 0))
                     for x, bad, good in RULES.values()], axis=1)


def fit(votes: np.ndarray, count: np.ndarray, rounds: int = 200) -> dict[str, np.ndarray]:
    """Expectation maximisation on vote patterns with their counts.

    Start: rules are better than chance and most documents are good. Dirichlet
    pseudo-counts (a thousandth of the rows, 1 at least) keep every estimate
    inside (0, 1), also for a rule that never votes.
    """
    total = max(float(count.sum()), 1.0)
    pseudo = max(1.0, total / 1000)
    start = np.array([[0.4, 0.2, 0.4], [0.01, 0.09, 0.9]])  # class bad, good: votes bad, none, good
    theta = np.repeat(start[None], votes.shape[1], axis=0)
    good = 0.85
    cell = votes + 1
    for _ in range(rounds):
        post = posterior(votes, {"theta": theta, "good": good})
        new = np.empty_like(theta)
        for y, weight in ((1, post * count), (0, (1 - post) * count)):
            for r in range(votes.shape[1]):
                seen = np.bincount(cell[:, r], weights=weight, minlength=3) + pseudo * start[y]
                new[r, y] = seen / seen.sum()
        good_new = (float((post * count).sum()) + 0.85 * pseudo) / (total + pseudo)
        moved = max(np.abs(new - theta).max(), abs(good_new - good))
        theta, good = new, good_new
        if moved < 1e-9:
            break
    return {"theta": theta, "good": good}


def posterior(votes: np.ndarray, model: dict) -> np.ndarray:
    """Probability that a document with these votes is good."""
    cell, theta, good = votes + 1, model["theta"], model["good"]
    r = np.arange(votes.shape[1])
    log_good = np.log(good) + np.log(theta[r, 1, cell]).sum(axis=1)
    log_bad = np.log(1 - good) + np.log(theta[r, 0, cell]).sum(axis=1)
    return 1 / (1 + np.exp(np.clip(log_bad - log_good, -700, 700)))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_bytes(batches):
        f = features(batch.column("txt"))
        votes = np.array(["".join(row) for row in np.array(list("-0+"))[vote(f) + 1]], dtype=object)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), *(pa.array(f[c]) for c in BASE), pa.array(votes, type=pa.string())],
            ["id", *BASE, "votes"])


def _votes(patterns: list[str]) -> np.ndarray:
    return np.array([["-0+".index(c) - 1 for c in p] for p in patterns], dtype=np.int64).reshape(len(patterns), len(RULES))


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base counts, base_failed, kept, p_quality, votes) for every row.

    base_failed: under 10 words, or over a fifth of the words in repeated
    5-word windows; such a document is never kept. Else kept says whether the
    posterior is 0.5 or more. Null text counts as empty (and fails); null ids
    and repeated rows stay as they are; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    scanned = stage(id_text(docs, id_col, text_col).mapInArrow(_scan, SCHEMA), "quality")
    seen = scanned.groupBy("votes").count().collect()  # at most 3^rules rows
    rows = []
    if seen:
        votes, count = _votes([r["votes"] for r in seen]), np.array([r["count"] for r in seen], dtype=float)
        post = posterior(votes, fit(votes, count))
        rows = [(r["votes"], float(p)) for r, p in zip(seen, post)]
    table = spark.createDataFrame(rows, "votes string, p_quality double")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (scanned.join(F.broadcast(table), "votes").withColumn("base_failed", failed)
            .select(F.col("id").alias("doc_id"), *BASE, "base_failed",
                    (~F.col("base_failed") & (F.col("p_quality") >= 0.5)).alias("kept"), "p_quality", "votes"))


def keep_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns. Rows that
    share an id share a fate: all stay if one of them is kept. Rows with a null
    id go if none such is kept."""
    good = (quality_verdicts(docs, id_col, text_col).where("kept")
            .select(F.col("doc_id").alias("_kept_id")).distinct())
    return docs.join(good, docs[id_col].cast("long").eqNullSafe(good["_kept_id"]), "left_semi")
