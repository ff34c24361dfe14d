"""Spark side of the query catalogue: one builder per operator group, each
reading the driver's tables (whole tables) from ``sf_dir``.

Every builder returns a lazy DataFrame; builders that exercise a sink write
into the shared folder (``spark.checkpoint.dir``) first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchforge.functions.scalar import (day_key, encode_outcome, int_from_text,
                                         long_from_text, map_lookup_by_position,
                                         micros_since_epoch, position_in, split_piece)
from matchforge.operators import facts
from matchforge.operators.aggregates import (first_wins, key_violations, latest,
                                             surrogate_key)
from matchforge.operators.filters import drop_any_null, roster_predicate
from matchforge.operators.joins import (fk_orphans, inner_lookup, left_enrich, outer_join)
from matchforge.operators.load import append_if_absent, write_csv
from matchforge.operators.project import drop_cols, rename, select_as
from matchforge.plans import fixture_views as V
from matchforge.plans.checked import CHECKED
from matchforge.plans.landed import LANDED
from matchforge.session import scratch_path
from matchforge.sources.documents import kv_wide
from matchforge.sources.files import literal_table, read_csv_text
from matchforge.params import OUTCOME_DIM

Builder = Callable[[SparkSession, str], DataFrame]


def _t(spark, sf_dir, name):
    return V.table(spark, sf_dir, name)


# -- performance fact over the timeline view ----------------------------------

def _ref(spark, sf_dir):
    return V.reference_tables(spark, sf_dir)


def performance_table(spark, sf_dir):
    r = _ref(spark, sf_dir)
    return facts.performance_chain(r["champion"], r["kd"], r["scores"], r["wards"],
                                   r["outcomes"], V.VIEW_CUTOFFS)


def performance_union_agg(spark, sf_dir):
    """The union-aggregate rewrite; its own aggregation checks that every input
    is unique on the key."""
    r = _ref(spark, sf_dir)
    return facts.performance(r["champion"], r["kd"], r["scores"], r["wards"],
                             r["outcomes"], V.VIEW_CUTOFFS, strategy="union")


def performance_single_pass(spark, sf_dir):
    tl = V.timeline_view(_t(spark, sf_dir, "events"))
    return V.performance_single_pass(tl, V.VIEW_CUTOFFS)


def nested_event_counts(spark, sf_dir):
    """The nested-timeline operators run over documents built in-row from
    events; same counts as the flat view."""
    return V.nested_event_counts(_t(spark, sf_dir, "events"))


def nested_match_outcome(spark, sf_dir):
    return V.nested_match_outcome(_t(spark, sf_dir, "events"))


def nested_chosen_champion(spark, sf_dir):
    return V.nested_chosen_champion(_t(spark, sf_dir, "events"))


def kill_death_single_pass(spark, sf_dir):
    return facts.kills_deaths_single_pass(_ref(spark, sf_dir)["kd"], V.VIEW_CUTOFFS)


def ward_counts(spark, sf_dir):
    return facts.ward_counts(_ref(spark, sf_dir)["wards"], V.VIEW_CUTOFFS)


def snapshot_at_cutoff(spark, sf_dir):
    return _ref(spark, sf_dir)["scores"]


def match_outcome(spark, sf_dir):
    return _ref(spark, sf_dir)["outcomes"]


def duration_minutes(spark, sf_dir):
    from matchforge.operators.dims import match_dim
    tl = V.timeline_view(_t(spark, sf_dir, "events"))
    return match_dim(V.long_matches(tl).select("match_id", "duration"))


# -- roster, links, casts, projections -----------------------------------------

def _roster_view(spark, sf_dir):
    """customer ⋈ nation ⋈ region in the roster's shape. TPC-H fixes nation
    at 25 rows and region at 5 at every scale, so both are broadcast."""
    c = _t(spark, sf_dir, "customer")
    n = _t(spark, sf_dir, "nation")
    r = _t(spark, sf_dir, "region")
    j = (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
          .join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey")))
    return j.select(
        F.col("c_custkey").alias("DT_RowId"), F.col("c_name").alias("plug"),
        F.col("c_nationkey").alias("roleNum"), F.col("n_name").alias("role"),
        F.col("c_mktsegment").alias("rankHigh"), F.col("c_acctbal").alias("onlineNum"),
        F.col("r_name").alias("home"), F.col("c_mktsegment").alias("current"))


ROSTER_OUT = ["DT_RowId", "plug", "roleNum", "role", "rankHigh", "onlineNum"]


def roster_filter(spark, sf_dir, mode="all"):
    v = _roster_view(spark, sf_dir)
    return v.filter(roster_predicate("EUROPE", "BUILDING", mode=mode)).select(*ROSTER_OUT)


def roster_online(spark, sf_dir):
    return roster_filter(spark, sf_dir, mode="online")


def split_link(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", split_piece("url", "/", -2).alias("link"))


def csv_all_string_cast(spark, sf_dir):
    """lineitem through CSV interchange: written with a header, read back with
    every column as text, float-looking text cast to int (truncating), then a
    cutoff on the cast value."""
    cols = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag"]
    path = scratch_path(spark, "csv-interchange")
    write_csv(_t(spark, sf_dir, "lineitem").select(*cols), path)
    text = read_csv_text(spark, path, cols)
    return text.select(
        long_from_text("l_orderkey").alias("l_orderkey"),
        int_from_text("l_linenumber").alias("l_linenumber"),
        int_from_text("l_quantity").alias("quantity"),
        int_from_text("l_extendedprice").alias("price"),
        "l_returnflag")


def select_rename_drop(spark, sf_dir):
    s = _t(spark, sf_dir, "supplier")
    step = select_as(s, {"supplier_id": "s_suppkey", "supplier_name": "s_name",
                         "s_nationkey": "s_nationkey", "balance": "s_acctbal"})
    step = drop_cols(step, "style")                   # absent: a no-op
    step = rename(step, {"s_nationkey": "nation_id"})
    return step.select("supplier_name", "supplier_id", "nation_id", "balance")


# -- outcome dimension and encoding --------------------------------------------

def _status_as_outcome():
    """Order status as a match result: finished -> 'win', open -> 'loss'."""
    return (F.when(F.col("o_orderstatus") == "F", "win")
            .when(F.col("o_orderstatus") == "O", "loss")
            .otherwise(F.col("o_orderstatus")))


def outcome_encode(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return o.select("o_orderkey", encode_outcome(_status_as_outcome()).alias("outcome_id"))


def literal_outcome_dim(spark, sf_dir):
    """Encoded orders joined to the literal outcome dimension (two rows)."""
    dim = literal_table(spark, OUTCOME_DIM, "outcome_id INT, outcome_name STRING")
    enc = outcome_encode(spark, sf_dir)
    return enc.join(F.broadcast(dim), ["outcome_id"], "left") \
              .select("o_orderkey", "outcome_id", "outcome_name")


# -- top-1, outer joins, enrichment --------------------------------------------

def latest_match_per_player(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    top = latest(o, ["o_custkey"], ["o_orderdate", "o_orderkey"],
                 ["o_orderdate", "o_orderkey", "o_orderstatus"])
    return top.select("o_custkey", "o_orderkey",
                      day_key("o_orderdate").alias("o_orderdate"),
                      "o_orderstatus")


def streamer_outer_join(spark, sf_dir):
    """Roster part (all suppliers) ⟗ profile part (all customers). The supplier
    keys are shifted by ten, so either side has rows without a partner."""
    s = _t(spark, sf_dir, "supplier")
    c = _t(spark, sf_dir, "customer")
    n = _t(spark, sf_dir, "nation")
    part1 = s.select((F.col("s_suppkey") - 10).alias("DT_RowId"), F.col("s_name").alias("plug"),
                     F.col("s_nationkey").alias("roleNum"))
    part2 = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("DT_RowId"), F.col("c_name").alias("Name"),
        F.col("n_name").alias("Birthplace"))
    j = outer_join(part1, part2, ["DT_RowId"])
    return j.select(F.col("DT_RowId").alias("streamer_id"),
                    F.col("plug").alias("streamer_name"), F.col("Name").alias("real_name"),
                    F.col("Birthplace").alias("birth_place"),
                    F.col("roleNum").cast("int").alias("role_id"))


def summoner_outer_join(spark, sf_dir):
    """Line counts of all orders ⟗ all orders with their keys shifted by ten, so
    either side has rows without a partner."""
    li = _t(spark, sf_dir, "lineitem")
    o = _t(spark, sf_dir, "orders")
    part1 = li.groupBy(F.col("l_orderkey").alias("account_name")).agg(
        F.count(F.lit(1)).alias("line_count"))
    part2 = o.select((F.col("o_orderkey") + 10).alias("account_name"),
                     F.col("o_custkey").alias("streamer_id"))
    j = outer_join(part1, part2, ["account_name"])
    return j.select("account_name", "line_count", "streamer_id")


def ml_features(spark, sf_dir):
    """Fact (lineitem) ⟕ dimension (part), then the ids dropped."""
    li = _t(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("match_id"), F.col("l_partkey").alias("champion_id"),
        "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    p = _t(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("champion_id"), F.col("p_name").alias("champion_name"),
        F.col("p_size").alias("attack"), F.col("p_retailprice").alias("defense"),
        F.length("p_type").alias("magic"))
    return left_enrich(li, p, ["champion_id"]).drop(
        "champion_id", "performance_id", "match_id", "summoner_id", "champion_name")


def enrich_inner_lookup(spark, sf_dir):
    d = _t(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return inner_lookup(d, _t(spark, sf_dir, "labels"), ["doc_id"])


def drop_any_null_q(spark, sf_dir):
    d = _t(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return drop_any_null(d.join(_t(spark, sf_dir, "labels"), ["doc_id"], "left"))


# -- loading ---------------------------------------------------------------------

def first_wins_dedupe(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    out = first_wins(li, ["l_orderkey", "l_linenumber"],
                     ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"])
    return out.withColumn("l_shipdate", day_key("l_shipdate"))


def append_if_absent_q(spark, sf_dir):
    """Target = orders before 1996 (tagged 'target'); append all orders
    (tagged 'batch'); keys already present are skipped."""
    o = _t(spark, sf_dir, "orders")
    cols = ["o_orderkey", "o_custkey", "o_orderstatus"]
    path = scratch_path(spark, "append-target")
    early = F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")
    o.filter(early).select(*cols, F.lit("target").alias("src")).write.parquet(path)
    append_if_absent(o.select(*cols, F.lit("batch").alias("src")), path, [["o_orderkey"]])
    return spark.read.parquet(path)


def fk_orphans_q(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return fk_orphans(o, "o_orderkey", _t(spark, sf_dir, "lineitem"), "l_orderkey")


def key_violations_q(spark, sf_dir):
    return key_violations(_t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def surrogate_key_q(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    out = surrogate_key(o, ["o_orderdate", "o_orderkey"], "serial_id")
    return out.withColumn("o_orderdate", day_key("o_orderdate"))


# -- nested values ------------------------------------------------------------------

def json_props(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    k = F.from_json("props", V.PROPS_SCHEMA)["k"]
    return e.groupBy(k.alias("k")).agg(F.count(F.lit(1)).alias("n"))


def explode_nested(spark, sf_dir):
    """Two-level nesting built in-row (text -> lines -> words) and exploded
    back, as frames -> events."""
    c = _t(spark, sf_dir, "conversations")
    nested = c.select("conv_id", "turn", F.transform(
        F.split("text", "\n"), lambda line: F.split(line, " ")).alias("lines"))
    lines = nested.select("conv_id", "turn", F.posexplode("lines").alias("line_no", "words"))
    words = lines.select("conv_id", "turn", "line_no",
                         F.posexplode("words").alias("word_no", "word"))
    return words.withColumns({"line_no": F.col("line_no") + 1, "word_no": F.col("word_no") + 1})


def array_position_lookup(spark, sf_dir):
    """Position of the page's language code among the URL's path pieces
    (1-based, 0 when absent), then a lookup of that piece in a map keyed by
    stringified position."""
    p = _t(spark, sf_dir, "pages")
    parts = F.split("url", "/")
    staged = p.select("page_id", F.regexp_extract("html", '<html lang="([^"]*)"', 1).alias("lang"),
                      parts.alias("parts"))
    by_pos = F.map_from_arrays(
        F.transform(F.sequence(F.lit(1), F.size("parts")), lambda i: i.cast("string")),
        F.col("parts"))
    staged = staged.select("page_id", "lang", position_in("parts", "lang").alias("lang_pos"),
                           by_pos.alias("by_pos"))
    return staged.select("page_id", "lang", "lang_pos",
                         map_lookup_by_position("by_pos", "lang_pos").alias("segment"))


def map_values_rows(spark, sf_dir):
    """Per part, a catalog-shaped map entry; map values exploded to rows."""
    p = _t(spark, sf_dir, "part")
    entry = F.struct(
        F.col("p_partkey").cast("string").alias("key"), F.col("p_name").alias("name"),
        F.struct(F.col("p_size").alias("attack"),
                 F.floor(F.col("p_retailprice") / 100).cast("int").alias("defense"),
                 F.length("p_name").alias("magic")).alias("info"))
    catalog = p.select(F.create_map(F.concat_ws(":", "p_brand", "p_partkey"), entry).alias("data"))
    from matchforge.sources.documents import champion_table
    return champion_table(catalog)


def union_missing_columns(spark, sf_dir):
    s = _t(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"))
    c = _t(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"))
    return s.unionByName(c, allowMissingColumns=True)


# -- model -----------------------------------------------------------------------

def _champion_dim(spark, sf_dir):
    """A champion dimension derived from part (one row per part key)."""
    p = _t(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("champion_id"),
                    F.col("p_name").alias("champion_name"),
                    F.col("p_size").alias("attack"),
                    F.floor(F.col("p_retailprice") / 100).cast("int").alias("defense"),
                    F.length("p_name").alias("magic"))


def model_score(spark, sf_dir, seed: int = 7):
    """Performance ⟕ champion -> seeded 3-fold search over C -> refit -> model
    saved to and loaded from the shared folder -> every (match, player) sent
    as a JSON request record -> predicted outcome word. Rows-only check."""
    from matchforge.operators.load import load_model, save_model
    from matchforge.staging import stage
    from matchforge.operators.model import feature_columns, parse_requests, score, tune_and_fit
    perf = performance_single_pass(spark, sf_dir).select(
        "match_id", "puuid", "champion_id", F.col("no_kills").alias("kills"),
        F.col("no_deaths").alias("deaths"), F.col("gold_at_10").alias("gold"),
        F.col("minions_at_10").alias("minions"), F.col("xp_at_10").alias("xp"),
        F.col("ward_count").alias("wards"), "outcome_id")
    table = stage(left_enrich(perf, _champion_dim(spark, sf_dir), ["champion_id"]), "ml-table")
    # The feature table of the source: ids and names dropped, label kept.
    training = table.drop("champion_id", "match_id", "puuid", "champion_name")
    result = tune_and_fit(training, seed=seed)
    path = scratch_path(spark, "model")
    save_model(result.model, path)
    model = load_model(path)
    features = feature_columns(training)
    requests = table.select("match_id", "puuid", "outcome_id",
                            F.to_json(F.struct(*features)).alias("request"))
    rows = parse_requests(requests, "request", features)
    return score(model, rows, keep=["match_id", "puuid", "outcome_id"], features=features)


# -- star schema load ---------------------------------------------------------------

def star_batches(spark, sf_dir) -> dict:
    """The eight star tables from the driver's tables: performance and match
    from the timeline view of events; summoners are the event users, streamers
    the customers, countries the nations, roles the regions, champions the
    parts; the outcome dimension is the literal one."""
    from matchforge.operators.dims import match_dim, outcome_dim, performance_for_load
    cust = _t(spark, sf_dir, "customer")
    nation = _t(spark, sf_dir, "nation")
    region = _t(spark, sf_dir, "region")
    users = _t(spark, sf_dir, "events").select("user_id").distinct()
    tl = V.timeline_view(_t(spark, sf_dir, "events"))
    return {
        "country": nation.select(F.col("n_name").alias("country_name")),
        "role": region.select(F.col("r_regionkey").alias("role_id"),
                              F.col("r_name").alias("role_name")),
        "champion": _champion_dim(spark, sf_dir),
        "streamer": cust.join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey).select(
            F.col("c_custkey").alias("streamer_id"),
            F.col("c_name").alias("streamer_name"), F.col("c_name").alias("real_name"),
            F.col("n_name").alias("birth_country"), F.col("n_regionkey").alias("role_id")),
        "summoner": users.join(cust, users.user_id == cust.c_custkey, "left").select(
            F.col("user_id").cast("string").alias("puuid"), F.col("c_name").alias("account_name"),
            F.col("c_custkey").alias("streamer_id")),
        "match": match_dim(V.long_matches(tl).select("match_id", "duration")),
        "outcome": outcome_dim(spark),
        "performance": performance_for_load(V.performance_single_pass(tl)),
    }


def star_load(spark, sf_dir):
    """All eight tables validated, then appended parents first into a fresh
    database in the shared folder; the performance table is read back with
    its serial ids."""
    import uuid
    from matchforge.operators.load import load_star
    db = f"mf_star_{uuid.uuid4().hex[:12]}"
    load_star(spark, db, star_batches(spark, sf_dir), location=scratch_path(spark, db))
    return spark.table(f"{db}.performance")


# -- incremental load ---------------------------------------------------------------

def incremental_load(spark, sf_dir):
    """Events land in two overlapping waves (the first half of the month, then
    the whole month); a file stream appends each micro-batch to the target,
    skipping event ids already there. The target ends up with every event
    once."""
    from matchforge.streaming.incremental import run_incremental_load
    ev = _t(spark, sf_dir, "events")
    landing = scratch_path(spark, "landing")
    cut = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    ev.filter(cut).write.mode("append").parquet(landing)
    ev.write.mode("append").parquet(landing)
    target = run_incremental_load(
        spark, landing, ev.schema, scratch_path(spark, "events-target"),
        scratch_path(spark, "events-stream-ckpt"), ["event_id"], max_files_per_trigger=4)
    return target.select("event_id", "user_id", "event_type", "value", "props",
                         micros_since_epoch("ts").alias("ts_us"))


KV_PATTERN = r"<(title|h1)>([^<]*)<"


def kv_pivot(spark, sf_dir):
    return kv_wide(_t(spark, sf_dir, "pages"), "page_id", "html", ["h1", "title"], KV_PATTERN)


def kv_pivot_dynamic(spark, sf_dir):
    """Keys discovered from the data become columns (explode, then
    ``groupBy(page_id).pivot(key)``, first occurrence wins)."""
    from matchforge.sources.documents import kv_pivot_dynamic as pivot
    return pivot(_t(spark, sf_dir, "pages"), "page_id", "html", KV_PATTERN)


def queries() -> dict[str, Builder]:
    return {
        "performance_table": performance_table,
        "performance_union_agg": performance_union_agg,
        "performance_single_pass": performance_single_pass,
        "kill_death_single_pass": kill_death_single_pass,
        "nested_event_counts": nested_event_counts,
        "nested_match_outcome": nested_match_outcome,
        "nested_chosen_champion": nested_chosen_champion,
        "ward_counts": ward_counts,
        "roster_filter": roster_filter,
        "roster_online": roster_online,
        "split_link": split_link,
        "csv_all_string_cast": csv_all_string_cast,
        "select_rename_drop": select_rename_drop,
        "literal_outcome_dim": literal_outcome_dim,
        "outcome_encode": outcome_encode,
        "duration_minutes": duration_minutes,
        "snapshot_at_cutoff": snapshot_at_cutoff,
        "match_outcome": match_outcome,
        "latest_match_per_player": latest_match_per_player,
        "streamer_outer_join": streamer_outer_join,
        "summoner_outer_join": summoner_outer_join,
        "ml_features": ml_features,
        "enrich_inner_lookup": enrich_inner_lookup,
        "first_wins_dedupe": first_wins_dedupe,
        "append_if_absent": append_if_absent_q,
        "fk_orphans": fk_orphans_q,
        "key_violations": key_violations_q,
        "surrogate_key": surrogate_key_q,
        "json_props": json_props,
        "explode_nested": explode_nested,
        "array_position_lookup": array_position_lookup,
        "map_values_rows": map_values_rows,
        "union_missing_columns": union_missing_columns,
        "kv_pivot": kv_pivot,
        "kv_pivot_dynamic": kv_pivot_dynamic,
        "drop_any_null": drop_any_null_q,
        "model_score": model_score,
        "incremental_load": incremental_load,
        "star_load": star_load,
    } | {f.__name__: f for f in (*LANDED, *CHECKED)}
