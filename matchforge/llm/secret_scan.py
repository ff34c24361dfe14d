"""Secret scan with a random forest against false positives.

A candidate is a run of 16 or more key-like characters; a word may hold several. The
forest judges it by its length, its character transitions, how much of it the
corpus's own words cover, whether it stands in a path, and its neighbouring
words. It is trained on labelled findings; ``seed_labels`` derives such labels
from known key formats and from shapes that are surely none.

Everything is DataFrame expressions and MLlib: candidates are found by array
expressions inside the scan (no row per word), the dictionary is one map-side
combined count whose result has at most 26^3 rows, and joins are on candidate
values, of which there are few.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchforge.llm.common import id_text, stage

#: Labelled rows of each class that the forest is fitted on, at most.
TRAIN_ROWS = 20_000
#: Occurrences that make a word part of the dictionary.
DICTIONARY_COUNT = 20

SPACE = r"[\x20\x09-\x0D]+"
RUN = r"[A-Za-z0-9+/_-]{16,}={0,2}"
KEY_WORDS = "passw|pwd|secret|token|api|key|auth|cred|bearer|private"
NOT_WORDS = "sha|md5|commit|checksum|digest|uuid|example|dummy|sample|test"
FEATURES = ["length", "digit_share", "upper_share", "distinct_share", "class_changes", "vowel_share",
            "vowel_changes", "coverage", "in_path", "assigned", "near_key", "near_other", "quoted"]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, pos, run, word, before2, before, front, after, value): every key-like
    run of every word, ``run`` being its place among the word's runs.

    ``word`` is the run with the text up to the runs beside it, ``front`` what of
    that is in front. The neighbours are the words beside; between the runs of
    one word they are the runs beside. So a row's size follows its run's, and a
    word of many runs is not copied for each.
    """
    words = id_text(docs, id_col, text_col).select("id", F.split(F.coalesce("txt", F.lit("")), SPACE).alias("w"))
    near = lambda a, i: F.coalesce(F.get(a, i), F.lit(""))
    found = words.select("id", F.filter(
        F.transform("w", lambda x, i: F.when(
            (F.octet_length(x) >= 16) & x.rlike(RUN),
            F.struct(i.cast("int").alias("pos"), x.alias("word"), near("w", i - 2).alias("left2"),
                     near("w", i - 1).alias("left"), near("w", i + 1).alias("right")))),
        lambda s: s.isNotNull()).alias("c")).where(F.size("c") > 0)
    runs = found.select("id", F.inline("c")).select(
        "id", "pos", "left2", "left", "right", F.regexp_extract_all("word", F.lit(RUN), F.lit(0)).alias("runs"),
        F.split("word", RUN).alias("gaps"))  # a gap in front of each run and one behind the last
    return runs.select("id", "pos", F.inline(F.transform("runs", lambda v, i: F.struct(
        i.cast("int").alias("run"), F.concat(F.get("gaps", i), v, F.get("gaps", i + 1)).alias("word"),
        F.when(i == 0, F.col("left2")).when(i == 1, F.col("left")).otherwise(near("runs", i - 2)).alias("before2"),
        F.when(i == 0, F.col("left")).otherwise(near("runs", i - 1)).alias("before"), F.get("gaps", i).alias("front"),
        F.when(i == F.size("runs") - 1, F.col("right")).otherwise(near("runs", i + 1)).alias("after"), v.alias("value")))))


def dictionary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               least: int = DICTIONARY_COUNT) -> DataFrame:
    """(gram): three-letter strings of the words that the corpus uses at least
    ``least`` times; at most 26^3 rows."""
    words = id_text(docs, id_col, text_col).select(F.explode(F.split(F.lower("txt"), r"[^a-z]+")).alias("w"))
    often = words.where((F.octet_length("w") >= 3) & (F.octet_length("w") <= 12)).groupBy("w").count().where(F.col("count") >= least)
    return often.select(F.explode(_grams(F.col("w"))).alias("gram")).distinct()


def _grams(c):
    return F.when(F.length(c) >= 3, F.transform(F.sequence(F.lit(1), F.length(c) - 2), lambda i: F.substring(c, i, F.lit(3)))
                  ).otherwise(F.array().cast("array<string>"))


def featured(found: DataFrame, grams: DataFrame) -> DataFrame:
    """``found`` with the forest's features as double columns."""
    values = found.select("value").distinct()
    covered = (values.select("value", F.explode(_grams(F.lower("value"))).alias("gram"))
               .join(F.broadcast(grams.withColumn("known", F.lit(1))), "gram", "left")
               .groupBy("value").agg(F.avg(F.coalesce("known", F.lit(0))).alias("coverage")))
    v, n = F.col("value"), F.length("value")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(v, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "9")
    low = F.lower(v)
    count = lambda c, p: F.regexp_count(c, F.lit(p))
    context = F.lower(F.concat_ws(" ", "before2", "before", "front"))
    lead = F.concat(F.when(F.col("run") > 0, F.col("before")).otherwise(""), "front")  # of the same word
    return (found.join(covered, "value")
            .withColumn("length", n)
            .withColumn("digit_share", count(v, "[0-9]") / n)
            .withColumn("upper_share", count(v, "[A-Z]") / n)
            .withColumn("distinct_share", F.size(F.array_distinct(F.split(v, ""))) / n)
            .withColumn("class_changes", count(kinds, "(?=a[^a]|A[^A]|9[^9])") / n)
            .withColumn("vowel_share", count(low, "[aeiou]") / n)
            .withColumn("vowel_changes", count(low, "(?=[aeiou][^aeiou]|[^aeiou][aeiou])") / n)
            .withColumn("in_path", (F.col("word").rlike(r"[/\\].*[/\\]|^https?:|\.[a-z]{2,4}$")).cast("int"))
            .withColumn("assigned", (((F.col("run") == 0) & F.col("before").rlike("[=:]$")) | lead.rlike("[=:]\\\\?[\"']?$")).cast("int"))
            .withColumn("near_key", context.rlike(KEY_WORDS).cast("int"))
            .withColumn("near_other", context.rlike(NOT_WORDS).cast("int"))
            .withColumn("quoted", F.col("word").rlike("[\"']").cast("int"))
            .withColumns({c: F.col(c).cast("double") for c in FEATURES}))


def seed_labels(found: DataFrame) -> DataFrame:
    """Labelled findings (featured rows plus label): 1 for known key formats
    and for mixed values assigned to a key word, 0 for values of letters or of
    digits only without a key word, and for names (no digits, and a key word
    inside). The rest stays unlabelled."""
    v, mixed = F.col("value"), F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]")
    known = v.rlike("^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36}|^xox[abprs]-|^sk_live_|^AIza[0-9A-Za-z_-]{35}$")
    plain = ~v.rlike("[0-9]") | ~v.rlike("[A-Za-z]")
    label = (F.when(known | ((F.col("near_key") == 1) & (F.col("assigned") == 1) & mixed), 1.0)
             .when((plain & (F.col("near_key") == 0)) | (~v.rlike("[0-9]") & F.lower(v).rlike(KEY_WORDS)), 0.0))
    return found.withColumn("label", label).where("label is not null")


def fit_forest(labelled: DataFrame, rows: int = TRAIN_ROWS):
    """Random forest on at most ``rows`` labelled rows of each class (those of
    least hash); None if a class has no rows."""
    keep = labelled.select("label", *FEATURES, F.xxhash64("value", "before", "after").alias("h"))
    parts = [keep.where(F.col("label") == y).orderBy("h").limit(rows) for y in (0.0, 1.0)]
    train = stage(parts[0].unionByName(parts[1]), "secret-train")
    if train.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=20, maxDepth=6, seed=7)
    return forest.fit(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(train))


def scan_secrets(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id",
                 text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """(doc_id, pos, run, value, score, is_secret): every candidate of every row,
    pos being the place of its word among the row's white-space separated parts
    and run its place among the word's key-like runs.

    ``labelled``: findings as ``featured`` gives them, with a label 0 or 1;
    without it, ``seed_labels`` of the documents themselves. If one class has no
    labelled row, no forest can be fitted: then known formats and assigned key
    words score 1 and the rest 0. Null texts hold nothing; null ids and repeated
    rows are kept; an empty table gives an empty result.
    """
    found = stage(featured(stage(candidates(docs, id_col, text_col), "secret-words"),
                           dictionary(docs, id_col, text_col)), "secret-candidates")
    forest = fit_forest(seed_labels(found) if labelled is None else labelled)
    if forest is None:
        sure = seed_labels(found).where("label = 1").select("value").distinct().withColumn("sure", F.lit(1.0))
        scored = found.join(sure, "value", "left").withColumn("score", F.coalesce("sure", F.lit(0.0)))
    else:
        scored = forest.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)).withColumn(
            "score", vector_to_array("probability")[1])
    return scored.select(F.col("id").alias("doc_id"), "pos", "run", "value", "score",
                         (F.col("score") >= threshold).alias("is_secret"))


def redact_secrets(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id",
                   text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found secret replaced by ``mark``; all rows and
    columns stay. Rows that share an id lose the secrets of any of them."""
    secret = (scan_secrets(docs, labelled, id_col, text_col).where("is_secret")
              .groupBy(F.col("doc_id").alias("_secret_id")).agg(F.sort_array(F.collect_set("value"), asc=False).alias("_secrets")))
    return docs.join(secret, docs[id_col].cast("long").eqNullSafe(secret["_secret_id"]), "left").withColumn(
        text_col, F.aggregate(F.coalesce("_secrets", F.array().cast("array<string>")), F.col(text_col),
                              lambda t, v: F.replace(t, v, F.lit(mark)))).select(*docs.columns)
