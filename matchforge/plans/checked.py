"""Queries that make single steps of model, load and page parsing checkable by
SQL, each over whole tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchforge.operators.load import append_if_absent, load_model, load_star, save_model, write_parquet
from matchforge.operators.model import (best_candidate, cross_validate, feature_table, fit, merged, moments, parse_requests,
                                        sample_candidates, scaler_of, score, with_folds)
from matchforge.operators.aggregates import surrogate_key
from matchforge.operators.project import features_without, name_positionally
from matchforge.plans.fixture_views import table
from matchforge.session import scratch_path
from matchforge.sources.documents import profiles
from matchforge.sources.files import read_parquet
from matchforge.staging import stage

FEATURES = ["quantity", "price", "discount", "tax"]


def _training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines as training rows: outcome 1 for returned lines."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"), F.col("l_discount").alias("discount"),
                     F.col("l_tax").alias("tax"), (F.col("l_returnflag") == "R").cast("int").alias("outcome_id"))


def standardise_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population-standardised features of every line (four decimals)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("quantity"),
                                                 F.col("l_extendedprice").alias("price"), F.col("l_discount").alias("discount"))
    cols = ["quantity", "price", "discount"]
    z = scaler_of(merged(moments(li, cols), cols), cols).transform(li)
    return z.select("l_orderkey", "l_linenumber", *[F.round(f"{c}_z", 4).alias(f"{c}_z") for c in cols])


def fold_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each class in each of the three folds."""
    return with_folds(_training(spark, sf_dir), 3, seed=7).groupBy("outcome_id", "_fold").agg(
        F.count(F.lit(1)).alias("n")).withColumnRenamed("_fold", "fold")


def candidate_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-validated accuracy (three decimals) of a seeded sample of the grid
    and the best of it. A line counts as won if it has more than 25 pieces,
    turned round for returned ones without tax: a fit must put its boundary
    between 25 and 26, and C = 0 has no score."""
    turned = (F.col("outcome_id") == 1) & (F.col("tax") == 0)
    rows = _training(spark, sf_dir).withColumn("outcome_id", ((F.col("quantity") > 25) != turned).cast("int")).drop("price", "tax")
    scores = cross_validate(rows, sample_candidates(7), seed=7)
    best = best_candidate({c: None if s is None else round(s, 3) for c, s in scores.items()})
    return spark.createDataFrame([(c, None if s is None else round(s, 3), c == best) for c, s in scores.items()],
                                 "c double, accuracy double, best boolean")


def fit_stationarity(spark: SparkSession, sf_dir: str, c_value: float = 0.5) -> DataFrame:
    """Gradient of the penalised mean loss at the fitted weights, per feature
    and for the intercept: zero to four decimals if the fit minimises it."""
    rows = _training(spark, sf_dir)
    model = fit(rows, c_value, features=FEATURES)
    lr = model.stages[-1]
    w, n = lr.coefficients.toArray(), rows.count()
    z = model.stages[0].transform(rows)
    margin = reduce(lambda a, b: a + b, [F.lit(float(x)) * F.col(f"{c}_z") for x, c in zip(w, FEATURES)]) + F.lit(float(lr.intercept))
    miss = 1 / (1 + F.exp(-margin)) - F.col("outcome_id")
    grads = z.agg(*[F.avg(miss * F.col(f"{c}_z")).alias(c) for c in FEATURES], F.avg(miss).alias("intercept"))
    penalty = {c: float(x) / (c_value * n) for c, x in zip(FEATURES, w)}
    pairs = [F.struct(F.lit(c).alias("term"), F.abs(F.round(F.col(c) + F.lit(penalty.get(c, 0.0)), 4)).alias("gradient"))
             for c in [*FEATURES, "intercept"]]
    return grads.select(F.inline(F.array(*pairs)))


def score_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A saved pipeline with fixed coefficients scores every line sent as a
    JSON request; some requests lack a field and some do not parse."""
    key = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    li = table(spark, sf_dir, "lineitem").withColumn("key", key)
    whole = F.to_json(F.struct(F.col("l_quantity").alias("quantity"), F.col("l_tax").alias("tax")))
    request = (F.when(F.col("l_orderkey") % 17 == 0, F.lit("garbage"))
               .when(F.col("l_orderkey") % 19 == 0, F.to_json(F.struct(F.col("l_quantity").alias("quantity")))).otherwise(whole))
    rule = SQLTransformer(statement="SELECT *, CAST(0.1 * quantity - 20 * tax - 1.5 > 0 AS DOUBLE) AS prediction FROM __THIS__")
    path = scratch_path(spark, "fixed-model")
    save_model(Pipeline(stages=[rule]).fit(spark.range(1).select(F.lit(0.0).alias("quantity"), F.lit(0.0).alias("tax"))), path)
    model: PipelineModel = load_model(path)
    rows = parse_requests(li.select("key", request.alias("request")), "request", ["quantity", "tax"])
    return score(model, rows, keep=["key"], features=["quantity", "tax"])


def feature_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact with dimension written as the feature file, read back; label apart,
    features named by position."""
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("champion_id"), F.col("l_orderkey").alias("match_id"), F.col("l_quantity").alias("kills"),
        F.col("l_tax").alias("gold"), (F.col("l_returnflag") == "R").cast("int").alias("outcome_id"))
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("champion_id"), F.col("p_name").alias("champion_name"),
                                            F.col("p_size").alias("attack"))
    path = f"{scratch_path(spark, 'features')}.parquet"
    write_parquet(feature_table(li, p), path)
    rows = read_parquet(spark, path)
    return name_positionally(rows.select(*features_without(rows, "outcome_id")), "f1", "f2", "f3")


def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a star load reports per table, for a first and a second load of
    the same batches."""
    from matchforge.plans.catalog import star_batches
    db = f"mf_counts_{uuid.uuid4().hex[:12]}"
    batches, at = star_batches(spark, sf_dir), scratch_path(spark, db)
    first, second = (load_star(spark, db, batches, location=at) for _ in range(2))
    return spark.createDataFrame([(t, int(first[t]), int(second[t])) for t in first], "table string, first long, second long")


def append_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with two unique keys appended in key order to the open ones among
    them: a row is skipped if either key is taken by then. The keys are made
    from a row's place among the others: within a run of places that no open
    order breaks, neighbours conflict through one key or the other, so that
    whether a row stays depends on the whole run before it."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    o = surrogate_key(o, ["o_orderkey"], "place").select(
        "o_orderkey", "status", F.floor(F.col("place") / 2).cast("long").alias("left_key"), F.floor((F.col("place") + 1) / 2).cast("long").alias("right_key"))
    o, path = stage(o, "two-keys-rows"), scratch_path(spark, "two-keys")
    o.filter("status = 'P'").write.parquet(path)
    append_if_absent(o.unionByName(o), path, [["left_key"], ["right_key"]], ["o_orderkey"])
    return spark.read.parquet(path)


def profile_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile tables with attributes, inner tags, entities and a second table,
    built from all pages; pages of ids divisible by 7 have no table."""
    p = table(spark, sf_dir, "pages")
    html = F.when(F.col("page_id") % 7 == 0, F.lit("<p>no table</p>")).otherwise(F.concat(
        F.lit('<div><table class="info">\n<tr class="a"><th scope="row"><b>Name</b></th><td><a href="/x">Page &amp; '), F.col("page_id"),
        F.lit('</a></td></tr>\n<tr><td> Birthplace </td>\n<td><img src="f.png"> '), F.get(F.split("url", "/"), 2),
        F.lit("&nbsp;&lt;eu&gt;</td></tr><tr><td>alone</td></tr><tr><td>Name</td><td>second</td></tr></table>"
              "<table><tr><td>Birthplace</td><td>other</td></tr></table></div>")))
    pages = p.select(F.col("page_id").alias("DT_RowId"), html.alias("html"))
    return profiles(pages, ["Name", "Birthplace"]).select("DT_RowId", F.col("Name").alias("name"), F.col("Birthplace").alias("birthplace"))


def append_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders up to 1997 in a target partitioned by month; the orders from
    December 1997 on are appended, and read only the months they name."""
    month = F.date_format("o_orderdate", "yyyy-MM")
    o = table(spark, sf_dir, "orders").select("o_orderkey", month.alias("month"), "o_custkey")
    path = scratch_path(spark, "append-months")
    o.where("month < '1998-01'").withColumn("src", F.lit("target")).repartition("month").write.partitionBy("month").parquet(path)
    append_if_absent(o.where("month >= '1997-12'").withColumn("src", F.lit("batch")), path, [["o_orderkey"]], partition_by=["month"])
    schema = "o_orderkey long, o_custkey long, src string, month string"  # or months are read as days
    return spark.read.schema(schema).parquet(path)


def many_keyed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pages whose words name a pair each, with the following word
    as its value: far more distinct keys than a pivot may have. Each page's
    pairs as one map, shown as (doc_id, key, value)."""
    from matchforge.sources.documents import kv_map
    pages = table(spark, sf_dir, "documents").select("doc_id", "text")
    wide = kv_map(pages, "doc_id", "text", r"([a-z]+) ([a-z]+)")
    return wide.select("doc_id", F.explode("pairs").alias("key", "value"))


CHECKED = [append_by_month, many_keyed_pages, standardise_features, fold_sizes, candidate_scores, fit_stationarity, score_requests, feature_file, load_counts,
           append_two_keys, profile_pages]

CHECKED_SQL = {
    "append_by_month": """
SELECT o_orderkey, o_custkey, if(m < '1998-01', 'target', 'batch') AS src, m AS month
FROM (SELECT *, strftime(o_orderdate, '%Y-%m') AS m FROM orders)
""",
    "many_keyed_pages": """
WITH p AS (SELECT doc_id, unnest(regexp_extract_all(text, '([a-z]+) ([a-z]+)', 1)) AS key,
                  unnest(regexp_extract_all(text, '([a-z]+) ([a-z]+)', 2)) AS value,
                  unnest(range(len(regexp_extract_all(text, '([a-z]+) ([a-z]+)', 1)))) AS ord FROM documents)
SELECT doc_id, key, arg_min(value, ord) AS value FROM p GROUP BY doc_id, key
""",
    "standardise_features": """
WITH s AS (SELECT avg(l_quantity) mq, stddev_pop(l_quantity) sq, avg(l_extendedprice) mp, stddev_pop(l_extendedprice) sp,
                  avg(l_discount) md, stddev_pop(l_discount) sd FROM lineitem)
SELECT l_orderkey, l_linenumber, round((l_quantity - mq) / sq, 4) AS quantity_z, round((l_extendedprice - mp) / sp, 4) AS price_z,
       round((l_discount - md) / sd, 4) AS discount_z FROM lineitem, s
""",
    "fold_sizes": """
SELECT outcome_id, CAST(k % 3 AS INTEGER) AS fold, count(*) AS n FROM (
  SELECT CAST(l_returnflag = 'R' AS INTEGER) AS outcome_id, row_number() OVER (PARTITION BY l_returnflag = 'R') - 1 AS k FROM lineitem)
GROUP BY ALL
""",
    # the candidates are the sample that seed 7 draws from the grid
    "candidate_scores": """
SELECT c, CASE WHEN c > 0 THEN a END AS accuracy, c = 0.5 AS best FROM (VALUES (0.0::DOUBLE), (0.5::DOUBLE), (1.0::DOUBLE), (2.5::DOUBLE), (3.0::DOUBLE), (3.5::DOUBLE), (4.0::DOUBLE), (4.5::DOUBLE)) v(c),
  (SELECT round(avg(CAST((l_quantity > 25) = ((l_quantity > 25) <> (l_returnflag = 'R' AND l_tax = 0)) AS INTEGER)), 3) AS a FROM lineitem)
""",
    "fit_stationarity": "SELECT unnest(['quantity', 'price', 'discount', 'tax', 'intercept']) AS term, 0.0::DOUBLE AS gradient",
    "score_requests": """
WITH r AS (SELECT l_orderkey * 10 + l_linenumber AS key,
                  if(l_orderkey % 17 = 0 OR l_orderkey % 19 = 0, NULL, CAST(0.1 * l_quantity - 20 * l_tax - 1.5 > 0 AS INTEGER)) AS p
           FROM lineitem)
SELECT key, p AS prediction, CASE p WHEN 1 THEN 'win' WHEN 0 THEN 'loss' END AS predicted FROM r
""",
    "feature_file": "SELECT l_quantity AS f1, l_tax AS f2, p_size AS f3 FROM lineitem LEFT JOIN part ON l_partkey = p_partkey",
    # Open orders stay. Of the others, those that share no key with an open one
    # form runs of neighbours, in which every second row stays.
    "append_two_keys": """
WITH o AS (SELECT *, place // 2 AS left_key, (place + 1) // 2 AS right_key FROM (
        SELECT o_orderkey, o_orderstatus AS status, row_number() OVER (ORDER BY o_orderkey) AS place FROM orders)),
t AS (SELECT * FROM o WHERE status = 'P'),
b AS (SELECT * FROM o WHERE status <> 'P' AND left_key NOT IN (SELECT left_key FROM t) AND right_key NOT IN (SELECT right_key FROM t)),
r AS (SELECT *, place - row_number() OVER (ORDER BY place) AS run FROM b),
k AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY place) AS nth FROM r)
SELECT o_orderkey, status, left_key, right_key FROM t UNION ALL
SELECT o_orderkey, status, left_key, right_key FROM k WHERE nth % 2 = 1
""",
    "profile_pages": """
SELECT page_id AS "DT_RowId", if(page_id % 7 = 0, NULL, 'Page & ' || page_id) AS name,
       if(page_id % 7 = 0, NULL, string_split(url, '/')[3] || ' <eu>') AS birthplace FROM pages
""",
}


def checked_sql(timeline: str, fact: str) -> dict[str, str]:
    """The SQL above, with ``load_counts`` over the timeline view's fact."""
    return CHECKED_SQL | {"load_counts": "WITH " + timeline + ", perf AS (" + fact + """)
SELECT t AS "table", n AS first, CAST(0 AS BIGINT) AS second FROM (
  SELECT 'country' AS t, count(*) AS n FROM nation UNION ALL SELECT 'role', count(*) FROM region
  UNION ALL SELECT 'champion', count(*) FROM part UNION ALL SELECT 'streamer', count(*) FROM customer
  UNION ALL SELECT 'summoner', count(DISTINCT user_id) FROM events UNION ALL SELECT 'match', count(*) FROM longm
  UNION ALL SELECT 'outcome', 2 UNION ALL SELECT 'performance', count(*) FROM perf)
"""}
