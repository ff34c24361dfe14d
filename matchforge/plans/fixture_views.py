"""The driver's test tables seen through the source pipeline's shapes.

Timeline view over ``events`` (one calendar day = one match):

  match_id = date of ``ts`` as 'yyyy-MM-dd'      puuid = ``user_id``
  off      = milliseconds since midnight         pos   = user_id % 10 + 1
  k        = ``props.k`` parsed from JSON

Role mapping of event types onto timeline events:

  purchase -> kill:   killerId = pos, victimId = the next position
  error    -> death:  killerId = 0 (environment), victimId = pos
  click    -> ward placed:    wardType set, creatorId = pos
  view     -> ward destroyed: wardType set, creatorId = the next position,
                              killerId = pos when k < 50
  signup   -> nothing

Snapshot of a player at a time = their first event at or after it:
totalGold = k, minionsKilled = floor(value), xp = seconds since midnight.
Chosen champion = ``k`` of the player's first event of the day.
Winning team = 100 when the day's last event has an even ``k``, else 200.

A day spans 24 hours instead of a match's ~30 minutes, so the time cutoffs are
scaled by 60: snapshot and minimum duration at 36,000,000 ms, events before
36,006,000 ms. Per-match tables are staged and broadcast only if that copy is
proven small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchforge.functions.scalar import day_key, offset_ms_since_day, win_loss
from matchforge.operators.aggregates import first_at_or_after, first_wins
from matchforge.operators.joins import sized_broadcast
from matchforge.staging import stage
from matchforge.params import BLUE_TEAM, DEFAULT_CUTOFFS, RED_TEAM

VIEW_CUTOFFS = DEFAULT_CUTOFFS.scaled(60)
PROPS_SCHEMA = "k INT"

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def timeline_view(events: DataFrame) -> DataFrame:
    """tl: match_id, puuid, off, event_id, event_type, value, k, pos."""
    return events.select(
        day_key("ts").alias("match_id"),
        F.col("user_id").alias("puuid"),
        offset_ms_since_day("ts").alias("off"),
        "event_id", "event_type", "value",
        F.from_json("props", PROPS_SCHEMA)["k"].alias("k"),
        (F.col("user_id") % 10 + 1).cast("int").alias("pos"),
    )


def match_stats(tl: DataFrame) -> DataFrame:
    """Per match: duration (last event's offset) and winning team (from the
    last event by (off, event_id))."""
    last = F.max_by(F.col("k"), F.struct("off", "event_id"))
    return tl.groupBy("match_id").agg(
        F.max("off").alias("duration"),
        F.when(last % 2 == 0, F.lit(BLUE_TEAM)).otherwise(F.lit(RED_TEAM))
        .alias("winning_team"))


def long_matches(tl: DataFrame, cutoffs=VIEW_CUTOFFS) -> DataFrame:
    return match_stats(tl).filter(F.col("duration") >= cutoffs.min_duration)


def staged_matches(tl: DataFrame, cutoffs=VIEW_CUTOFFS) -> DataFrame:
    """The per-match table, computed once; broadcast in joins only if that copy
    is proven small."""
    return sized_broadcast(stage(long_matches(tl, cutoffs), "matches"))


def in_long_matches(df: DataFrame, matches: DataFrame) -> DataFrame:
    """Rows of long-enough matches."""
    return df.join(matches.select("match_id"), ["match_id"], "left_semi")


def attributed_events(tl: DataFrame, *extra: str) -> DataFrame:
    """tl rows in the flattened timeline-event shape (see module docstring),
    plus any ``extra`` tl columns passed through."""
    et, pos, k = F.col("event_type"), F.col("pos"), F.col("k")
    nxt = (pos % 10 + 1).cast("int")
    null_int = F.lit(None).cast("int")
    return tl.select(
        "match_id", "puuid", "pos", *extra,
        (F.when(et == "purchase", "CHAMPION_KILL").when(et == "error", "CHAMPION_KILL")
         .when(et == "click", "WARD_PLACED").when(et == "view", "WARD_KILL")
         .otherwise(F.upper(et))).alias("type"),
        F.col("off").alias("timestamp"),
        F.when(et.isin("click", "view"), F.lit("YELLOW_TRINKET")).alias("wardType"),
        F.when(et == "click", pos).when(et == "view", nxt).otherwise(null_int)
        .alias("creatorId"),
        F.when(et == "purchase", pos).when(et == "error", F.lit(0))
        .when((et == "view") & (k < 50), pos).otherwise(null_int).alias("killerId"),
        F.when(et == "purchase", nxt).when(et == "error", pos).otherwise(null_int)
        .alias("victimId"),
    )


def snapshot_rows(tl: DataFrame, cutoffs=VIEW_CUTOFFS) -> DataFrame:
    first = first_at_or_after(tl, ["match_id", "puuid"], "off", cutoffs.snapshot_at,
                              ["off", "event_id"], ["off", "event_id", "k", "value"])
    return first.select(
        "match_id", "puuid",
        F.col("k").alias("gold_at_10"),
        F.floor("value").cast("int").alias("minions_at_10"),
        (F.col("off") / 1000).cast("int").alias("xp_at_10"))


def champion_rows(tl: DataFrame) -> DataFrame:
    first = first_wins(tl.select("match_id", "puuid", "off", "event_id", "k"),
                       ["match_id", "puuid"], ["off", "event_id"])
    return first.select("match_id", "puuid", F.col("k").alias("champion_id"))


def outcome_rows(tl: DataFrame, matches: DataFrame) -> DataFrame:
    """(match_id, puuid, outcome) for every player of every long match."""
    pairs = tl.groupBy("match_id", "puuid").agg(F.max("pos").alias("pos"))
    return pairs.join(matches.select("match_id", "winning_team"), ["match_id"], "inner").select(
        "match_id", "puuid", win_loss("winning_team", "pos").alias("outcome"))


def reference_tables(spark: SparkSession, sf_dir: str, cutoffs=VIEW_CUTOFFS) -> dict:
    """The six per-player tables of the source pipeline, derived from events
    and restricted to long-enough matches."""
    return reference_tables_from(table(spark, sf_dir, "events"), cutoffs)


def reference_tables_from(events: DataFrame, cutoffs=VIEW_CUTOFFS) -> dict:
    from matchforge.operators.flatten import kill_rows, ward_rows
    view = timeline_view(events)
    matches = staged_matches(view, cutoffs)
    tl = stage(in_long_matches(view, matches), "timeline")  # restricted once, read by all six
    ev = attributed_events(tl)
    return {
        "tl": tl,
        "wards": ward_rows(ev),
        "kd": kill_rows(ev),
        "scores": snapshot_rows(tl, cutoffs),
        "champion": champion_rows(tl),
        "outcomes": outcome_rows(tl, matches),
        "match_info": matches.select("match_id", "duration"),
    }


def performance_single_pass(tl: DataFrame, cutoffs=VIEW_CUTOFFS) -> DataFrame:
    """The performance fact in one scan of the events.

    One ``groupBy(match_id, puuid)`` computes every per-player part: the three
    counts as ``count_if`` with the same predicates the row tables use, the
    chosen champion and the snapshot as ``min_by``, and the player's last
    event. Those per-player rows are staged: a second aggregate gives each
    match's duration and winning team, and both sides of the join back read the
    copy, so the events are scanned once whatever plan the join gets. Same rows
    as the six-input chain.
    """
    from matchforge.functions.scalar import encode_outcome
    from matchforge.operators.facts import INT_COLS, PERFORMANCE_COLS
    from matchforge.operators.filters import involved, ward_participant

    ev = attributed_events(tl, "event_id", "k", "value")
    early = F.col("timestamp") < cutoffs.event_before
    order = F.struct(F.col("timestamp"), F.col("event_id"))
    is_kd = involved("pos", "killerId", "victimId")
    snap_order = F.when(F.col("timestamp") >= cutoffs.snapshot_at, order)
    per_player = ev.groupBy("match_id", "puuid").agg(
        F.count_if(early & is_kd & (F.col("killerId") == F.col("pos"))).alias("no_kills"),
        F.count_if(early & is_kd & (F.col("victimId") == F.col("pos"))).alias("no_deaths"),
        F.count_if(early & ward_participant("pos", "wardType", "creatorId", "killerId")
                   .isNotNull()).alias("ward_count"),
        F.min_by("k", order).alias("champion_id"),
        F.min_by(F.struct("k", "value", "timestamp"), snap_order).alias("snap"),
        F.max("pos").alias("pos"),
        F.max(F.struct(F.col("timestamp"), F.col("event_id"), F.col("k"))).alias("last"))
    per_player = stage(per_player, "per-player")
    per_match = per_player.groupBy("match_id").agg(F.max("last").alias("last")).select(
        "match_id", F.col("last.timestamp").alias("duration"),
        F.when(F.col("last.k") % 2 == 0, F.lit(BLUE_TEAM)).otherwise(F.lit(RED_TEAM))
        .alias("winning_team")).filter(F.col("duration") >= cutoffs.min_duration)
    out = per_player.join(sized_broadcast(per_match), ["match_id"], "inner").select(
        "match_id", "puuid", "champion_id", "no_kills", "no_deaths",
        F.col("snap.k").alias("gold_at_10"),
        F.floor("snap.value").alias("minions_at_10"),
        (F.col("snap.timestamp") / 1000).cast("int").alias("xp_at_10"),
        "ward_count",
        encode_outcome(win_loss("winning_team", "pos")).alias("outcome_id"))
    out = out.withColumns({c: F.col(c).cast("int") for c in INT_COLS})
    return out.select(*PERFORMANCE_COLS).fillna(0, subset=INT_COLS)


def timeline_documents(tl: DataFrame, cutoffs=VIEW_CUTOFFS, days: DataFrame | None = None) -> DataFrame:
    """Timeline-shaped documents built in-row, one per event (no grouping):

      metadata.matchId      = the day
      metadata.participants = ten slots, the player's id at their position and
                              placeholder ids ('npc-<day>-<slot>') elsewhere
      info.frames           = [the event's frame, a closing frame at the day's
                              duration holding a GAME_END event with the day's
                              winning team] (both from the per-day table)

    The documents have the landed timeline schema, so the nested operators
    (flatten, attribution, ward and kill rows) run on them unchanged. Several
    documents share a match, which composes for the event counts.
    """
    from matchforge import schemas as S
    ev = attributed_events(tl, "event_id")
    if days is None:
        days = sized_broadcast(stage(match_stats(tl), "match-stats"))
    ev = ev.join(days, ["match_id"], "inner")
    slots = F.transform(F.sequence(F.lit(1), F.lit(10)), lambda i: F.when(
        i == F.col("pos"), F.col("puuid").cast("string")).otherwise(
        F.concat(F.lit("npc-"), F.col("match_id"), F.lit("-"), i.cast("string"))))
    event = F.struct(F.col("type"), F.col("timestamp").cast("long").alias("timestamp"),
                     F.col("wardType"), F.col("creatorId"), F.col("killerId"),
                     F.col("victimId"), F.lit(None).cast("int").alias("winningTeam"))
    pf_type = S.TIMELINE_FRAME["participantFrames"].dataType.simpleString()
    ev_type = S.TIMELINE_FRAME["events"].dataType.simpleString()
    no_frames = F.lit(None).cast(pf_type)
    frames = F.array(
        F.struct(F.col("timestamp").cast("long").alias("timestamp"),
                 F.array(event).cast(ev_type).alias("events"),
                 no_frames.alias("participantFrames")),
        F.struct(F.col("duration").cast("long").alias("timestamp"),
                 F.array(F.struct(
                     F.lit("GAME_END").alias("type"),
                     F.col("duration").cast("long").alias("timestamp"),
                     F.lit(None).cast("string").alias("wardType"),
                     F.lit(None).cast("int").alias("creatorId"),
                     F.lit(None).cast("int").alias("killerId"),
                     F.lit(None).cast("int").alias("victimId"),
                     F.col("winning_team").cast("int").alias("winningTeam"))).cast(ev_type)
                 .alias("events"),
                 no_frames.alias("participantFrames")))
    return ev.select(
        F.struct(F.col("match_id").alias("matchId"), slots.alias("participants"))
        .alias("metadata"),
        F.struct(frames.alias("frames")).alias("info"))


def nested_event_counts(events: DataFrame, cutoffs=VIEW_CUTOFFS) -> DataFrame:
    """Kills, deaths and wards per (match, player) computed by the nested
    operators on ``timeline_documents``: match_id, puuid (string),
    no_kills, no_deaths, ward_count, for pairs with any positive count."""
    from matchforge.operators.flatten import attributed_events as nested_events
    from matchforge.operators.flatten import event_counts
    tl = timeline_view(events)
    docs = timeline_documents(tl, cutoffs)
    players = events.select(F.col("user_id").cast("string").alias("puuid")).distinct()
    counts = event_counts(nested_events(docs, players, cutoffs), cutoffs)
    return counts.filter((F.col("no_kills") + F.col("no_deaths") + F.col("ward_count")) > 0)


def detail_documents(tl: DataFrame) -> DataFrame:
    """Match-detail documents built in-row, one per (match, player) row of the
    chosen-champion table: match_id, info.participants = [{puuid, championId}]."""
    champs = champion_rows(tl)
    return champs.select(
        "match_id",
        F.struct(F.array(F.struct(F.col("puuid").cast("string").alias("puuid"),
                                  F.col("champion_id").alias("championId")))
                 .alias("participants")).alias("info"))


def player_documents(tl: DataFrame, days: DataFrame) -> DataFrame:
    """``timeline_documents`` for one event per (match, player), the first: what
    the headers of a match need, without a document per event."""
    one = first_wins(tl, ["match_id", "puuid"], ["off", "event_id"])
    return timeline_documents(one.select(*tl.columns), days=days)


def _docs_and_players(events: DataFrame, cutoffs=VIEW_CUTOFFS):
    tl = timeline_view(events)
    players = events.select(F.col("user_id").cast("string").alias("puuid")).distinct()
    return tl, player_documents(tl, sized_broadcast(stage(match_stats(tl), "match-stats"))), players


def nested_match_outcome(events: DataFrame, cutoffs=VIEW_CUTOFFS) -> DataFrame:
    """(match_id, puuid, outcome) by the nested operators: the last event of
    each document's last frame gives the winning team. There is one document
    per (match, player)."""
    from matchforge.operators.flatten import outcome_rows as nested_outcomes
    _, docs, players = _docs_and_players(events, cutoffs)
    return nested_outcomes(docs, players, cutoffs)


def nested_chosen_champion(events: DataFrame, cutoffs=VIEW_CUTOFFS) -> DataFrame:
    """(match_id, puuid, champion_id) by the nested operators: the tracked
    players of the timeline documents looked up in the match details."""
    from matchforge.operators.flatten import chosen_champion, tracked_participants
    tl, docs, players = _docs_and_players(events, cutoffs)
    tracked = tracked_participants(docs, players, cutoffs)
    return chosen_champion(in_long_matches(detail_documents(tl), staged_matches(tl, cutoffs)), tracked)
