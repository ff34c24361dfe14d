"""Toxicity scores: gradient-boosted trees over dense features, calibrated.

Features of a text are densities of a lexicon, how near its words stand to a
second-person word, and rates of capitals, punctuation and obfuscation. The
lexicon (words and word beginnings, with their log-odds) is learned from
labelled texts, cross-fitted in two halves so that the trees never see a text
under a lexicon that its own label shaped. A third part of the labelled rows,
unseen by lexicon and trees, fits the isotonic calibration.

Fitting uses at most ``TRAIN_ROWS`` labelled rows of each class (those of least
hash of their id); that sample is the only thing broadcast and its bound does
not depend on the data. Scoring is one pass over all documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchforge.llm.common import by_bytes, crc_mod, id_text, ship, stage
from matchforge.llm.words import codes_of, per_doc, split_words

#: Labelled rows of each class that are used, at most.
TRAIN_ROWS = 12_000
#: Lexicon entries, at most, and labelled texts that an entry must be in.
LEXICON, LEAST_TEXTS = 5_000, 8
#: Length of word beginnings, longest first.
BEGIN = (6, 5, 4)
STRONG = 2.0
NEAR = 5

# Second-person words of English, German, French and Spanish.
SECOND_PERSON = """you your yours yourself u ur du dich dir dein deine euch ihr tu te toi ton ta tes vous votre vos
tú ti usted ustedes tus vosotros""".split()
# Characters written for letters.
LOOKALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}

FEATURES = ["strong_share", "strong_count", "odds_share", "odds_max", "weak_share", "near_you", "you_share",
            "capital_share", "capital_words", "mark_rate", "shout_rate", "obfuscated_share", "obfuscated_strong",
            "stretched_share", "log_words"]


def normal_words(distinct: pa.Array) -> tuple[pa.Array, pa.Array]:
    """(letters of each word, lower-case, look-alikes undone; whether something
    other than letters stood inside)."""
    w = pc.utf8_lower(distinct)
    w = pc.replace_substring_regex(w, r"^[^\p{L}\p{N}@$]+|[^\p{L}\p{N}]+$", "")
    inside = pc.match_substring_regex(w, r"\p{L}[^\p{L}\p{M}'’-]+\p{L}|[0-9@$]\p{L}{2}")
    for a, b in LOOKALIKE.items():
        w = pc.replace_substring(w, a, b)
    return pc.replace_substring_regex(w, r"[^\p{L}]", ""), inside


def entries(letters: pa.Array) -> list[pa.Array]:
    """For each word, its lexicon entries: the word itself as ``=word``, then
    its beginnings as ``<begin``, longest first (null: too short)."""
    size = pc.utf8_length(letters)
    out = [pc.if_else(pc.greater(size, 2), pc.binary_join_element_wise("=", letters, ""), pa.scalar(None, pa.string()))]
    for k in BEGIN:
        out.append(pc.if_else(pc.greater(size, k), pc.binary_join_element_wise("<", pc.utf8_slice_codeunits(letters, 0, k), ""),
                              pa.scalar(None, pa.string())))
    return out


def features(text: pa.Array, lexicon: dict[str, float]) -> np.ndarray:
    """(texts, features); nulls and empty texts have zeros."""
    n = len(text)
    text = pc.fill_null(text, "")
    doc, words = split_words(text)
    code, distinct = codes_of(words)
    letters, inside = normal_words(distinct)
    keys = pa.array(list(lexicon), type=pa.string())
    value = np.array(list(lexicon.values()) + [0.0])
    odds, open_ = np.zeros(len(distinct)), np.ones(len(distinct), dtype=bool)
    for e in entries(letters):  # the most specific entry that the lexicon has
        at = pc.fill_null(pc.index_in(e, value_set=keys, skip_nulls=True), len(lexicon)).to_numpy(zero_copy_only=False)
        use = open_ & (at < len(lexicon))
        odds[use] = value[at[use]]
        open_ &= ~use
    flag = lambda a: pc.fill_null(a, False).to_numpy(zero_copy_only=False).astype(bool)
    hidden, you = flag(inside), flag(pc.is_in(letters, value_set=pa.array(SECOND_PERSON)))
    upper = pc.utf8_length(pc.replace_substring_regex(distinct, r"\P{Lu}", "")).to_numpy(zero_copy_only=False)
    alpha = pc.utf8_length(pc.replace_substring_regex(distinct, r"\P{L}", "")).to_numpy(zero_copy_only=False)
    stretched = flag(pc.match_substring_regex(letters, "|".join(c * 3 for c in "abcdefghijklmnopqrstuvwxyz")))
    w_odds, strong = odds[code], odds[code] > STRONG
    count = per_doc(doc, n)
    words_ = np.maximum(count, 1)
    total = lambda x: np.bincount(doc, weights=x, minlength=n)
    marks = lambda p: pc.count_substring_regex(text, p).to_numpy(zero_copy_only=False)
    # A strong word is near a second-person word of its own text.
    you_at = np.flatnonzero(you[code])
    near = np.zeros(len(code), dtype=bool)
    if len(you_at):
        i = np.arange(len(code))
        right = np.searchsorted(you_at, i)
        for j in (np.minimum(right, len(you_at) - 1), np.maximum(right - 1, 0)):
            near |= (np.abs(you_at[j] - i) <= NEAR) & (doc[you_at[j]] == doc)
    top = np.zeros(n)
    np.maximum.at(top, doc, w_odds)
    letters_ = np.maximum(total(alpha[code]), 1)
    cols = {
        "strong_share": total(strong) / words_, "strong_count": np.log1p(total(strong)),
        "odds_share": total(w_odds) / words_, "odds_max": top, "weak_share": total(w_odds > 1) / words_,
        "near_you": total(strong & near) / words_, "you_share": total(you[code]) / words_,
        "capital_share": total(upper[code]) / letters_, "capital_words": total((upper == alpha)[code] & (alpha[code] > 1)) / words_,
        "mark_rate": marks(r"\pP") / words_, "shout_rate": marks(r"[!?]") / words_,
        "obfuscated_share": total(hidden[code]) / words_, "obfuscated_strong": np.log1p(total(hidden[code] & strong)),
        "stretched_share": total(stretched[code]) / words_, "log_words": np.log1p(count)}
    return np.stack([cols[c] for c in FEATURES], axis=1)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labelled texts -> for each entry, how many texts of each half and label
    have it (of this batch)."""
    for batch in by_bytes(batches):
        doc, words = split_words(batch.column("txt"))
        code, distinct = codes_of(words)
        if not len(code):
            continue
        cell = (batch.column("half").to_numpy(zero_copy_only=False) * 2 + batch.column("label").to_numpy(zero_copy_only=False)).astype(np.int64)
        seen: Counter = Counter()
        for e in entries(normal_words(distinct)[0]):
            entry, known = codes_of(e.drop_null())
            of = np.full(len(distinct), -1)
            of[pc.is_valid(e).to_numpy(zero_copy_only=False)] = entry
            ok = of[code] >= 0
            pair = np.unique(doc[ok] * max(len(known), 1) + of[code][ok])  # once for each text
            at = (pair % max(len(known), 1)) * 4 + cell[pair // max(len(known), 1)]
            full = np.bincount(at, minlength=len(known) * 4).reshape(-1, 4)
            for name, row in zip(known.to_pylist(), full.tolist()):
                seen[name] = row
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), type=pa.string()), *(pa.array([r[k] for r in seen.values()], type=pa.int64()) for k in range(4))],
            ["entry", "c0", "c1", "c2", "c3"])


def _lexicon(rows: list, halves: tuple[int, ...], texts: dict[tuple[int, int], int]) -> dict[str, float]:
    """Entries whose texts (of these halves) are toxic more often, with the
    log of how much more often."""
    bad = sum(texts.get((h, 1), 0) for h in halves)
    good = sum(texts.get((h, 0), 0) for h in halves)
    scored = []
    for r in rows:
        g, b = sum(r[1 + 2 * h] for h in halves), sum(r[2 + 2 * h] for h in halves)
        if g + b >= LEAST_TEXTS // (3 - len(halves)):
            odds = float(np.log((b + 0.5) / (bad + 1)) - np.log((g + 0.5) / (good + 1)))
            if odds > 1:
                scored.append((odds * b ** 0.5, r[0], odds))
    return {name: odds for _, name, odds in sorted(scored, reverse=True)[:LEXICON]}


def _feature_rows(lexicons: dict[int, dict[str, float]], keep: list[str]):
    """Features of each text under the lexicon of its half (-1: the only)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches):
            half = batch.column("half").to_numpy(zero_copy_only=False) if "half" in batch.schema.names else np.full(batch.num_rows, -1)
            x = np.zeros((batch.num_rows, len(FEATURES)))
            for h, lexicon in lexicons.items():
                rows = np.flatnonzero(half == h)
                if len(rows):
                    x[rows] = features(batch.column("txt").take(pa.array(rows)), lexicon)
            f = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), f], [*keep, "f"])
    return run


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_id: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Labels are learned from rows whose crc32(id as text) mod 5 is not 0; the
    rest is held out. Null labels and labels without a document are left out;
    of repeated labels of one id the greatest counts. Null and empty texts have
    zero features and get the score of such; null ids get a score too. If a
    class has no labelled text, nothing can be told apart: every score is the
    labelled share of class 1 (0 without labels). An empty table gives an empty
    result.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = id_text(docs, id_col, text_col)
    known = (labels.select(F.col(label_id).cast("long").alias("lid"), F.col(label_col).cast("int").alias("label"))
             .where("lid is not null and label in (0, 1)").groupBy("lid").agg(F.max("label").alias("label"))
             .where(crc_mod(F.col("lid"), 5) != 0).withColumn("h", F.xxhash64("lid")))
    sample = known.where("label = 0").orderBy("h").limit(TRAIN_ROWS).unionByName(
        known.where("label = 1").orderBy("h").limit(TRAIN_ROWS))
    # Halves 0 and 1 teach lexicon and trees, half 2 calibrates.
    sample = sample.withColumn("half", F.element_at(F.array(*map(F.lit, (0, 1, 2))), F.pmod(F.shiftright("h", 7), F.lit(3)).cast("int") + 1))
    texts = stage(rows.join(F.broadcast(sample.select("lid", "label", "half")), rows["id"] == F.col("lid")).select(
        "id", "txt", "label", "half"), "toxic-sample")
    held = crc_mod(F.col("id"), 5) == 0
    size = {(r["half"], r["label"]): r["count"] for r in texts.groupBy("half", "label").count().collect()}  # six rows
    if not all(size.get((h, y)) for h in (0, 1, 2) for y in (0, 1)):
        share = sum(n for (_, y), n in size.items() if y) / max(sum(size.values()), 1)
        return rows.select(F.col("id").alias("doc_id"), held.alias("held_out"), F.lit(float(share)).alias("score"),
                           F.lit(int(share >= 0.5)).alias("predicted"))
    counts = (texts.where("half < 2").mapInArrow(_counts, "entry string, c0 long, c1 long, c2 long, c3 long")
              .groupBy("entry").agg(*(F.sum(f"c{k}").alias(f"c{k}") for k in range(4)))
              .where(f"c0 + c1 + c2 + c3 >= {LEAST_TEXTS // 2} and c1 + c3 >= 3")
              .withColumn("w", (F.col("c1") + F.col("c3")) / (F.col("c0") + F.col("c2") + 1))
              .orderBy(F.desc(F.col("w") * F.sqrt(F.col("c1") + F.col("c3"))), "entry").limit(4 * LEXICON)
              .drop("w").collect())
    whole = _lexicon(counts, (0, 1), size)
    lexicons = {0: _lexicon(counts, (1,), size), 1: _lexicon(counts, (0,), size), 2: whole}
    trained = stage(texts.mapInArrow(_feature_rows(lexicons, ["label", "half"]), "label int, half int, f array<double>"),
                    "toxic-features").withColumn("features", array_to_vector("f")).withColumn("label", F.col("label").cast("double"))
    trees = GBTClassifier(maxIter=20, maxDepth=4, stepSize=0.2, seed=7, checkpointInterval=-1).fit(trained.where("half < 2"))
    raw = vector_to_array("rawPrediction")[1]
    # The sample has more of class 1 than the labels have: weights undo that.
    truth = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    drawn = {y: sum(n for (_, z), n in size.items() if z == y) for y in (0, 1)}
    weight = F.when(F.col("label") == 1, truth[1] / drawn[1]).otherwise(truth[0] / drawn[0])
    calibrated = IsotonicRegression(featuresCol="raw", weightCol="weight").fit(
        trees.transform(trained.where("half = 2")).select("label", raw.alias("raw"), weight.alias("weight")))
    scored = rows.mapInArrow(_feature_rows({-1: whole}, ["id"]), "id long, f array<double>").withColumn("features", array_to_vector("f"))
    out = calibrated.transform(trees.transform(scored).select("id", raw.alias("raw")))
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("prediction")))
    return out.select(F.col("id").alias("doc_id"), held.alias("held_out"), score.alias("score"),
                      (score >= 0.5).cast("int").alias("predicted"))
