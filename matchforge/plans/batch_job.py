"""The whole hourly job over landed documents, as one function per step:
extract (flatten landed documents), transform (dimensions and the
performance fact), load (validated append to the star schema) and the model
(feature table, tuning, refit, saved model).

Orchestration (scheduling, retries) is left to whatever runs this; each step
is idempotent, so re-running an hour is safe.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchforge.operators import dims
from matchforge.operators.facts import split_incomplete
from matchforge.operators.filters import in_region
from matchforge.operators.flatten import (extract_tables, latest_matches, of_matches, one_per_match,
                                          performance_from_timelines)
from matchforge.operators.load import load_star, save_model, write_parquet
from matchforge.operators.model import feature_table, tune_and_fit
from matchforge.sources import documents as D
from matchforge.staging import stage


@dataclass
class Landed:
    """Paths of the landed documents of one run."""

    roster: str
    profiles: str          # JSON lines {DT_RowId, html}
    feeds: str
    summoners: str
    timelines: str
    details: str
    champions: str
    headers: str           # match lists: {puuid, match_id, queue_id, started_at}


def extract(spark: SparkSession, landed: Landed, mode: str = "all",
            profile_keys=("Name", "Birthplace"), region: str | None = None) -> dict[str, DataFrame]:
    """Flatten one run's landed documents. Each tracked player counts in the
    latest ranked-solo match of their match list; ``region`` optionally
    restricts the accounts."""
    # Every source is parsed once into the shared folder; records that do not
    # parse go to a rejects table instead of vanishing or turning into nulls.
    rejected: dict[str, DataFrame] = {}

    def documents(source: str, path: str, schema, multiline: bool = False) -> DataFrame:
        good, rejected[source] = D.read_json_with_rejects(spark, path, schema, multiline)
        return good
    roster = D.roster(documents("roster", landed.roster, D.S.ROSTER, True), mode)
    pages = documents("profiles", landed.profiles, D.S.PROFILE_PAGE)
    profiles = D.profiles(pages.join(roster.select("DT_RowId"), ["DT_RowId"], "left_semi"),
                          list(profile_keys))
    feeds = documents("feeds", landed.feeds, D.S.MATCH_FEED)
    accounts = D.latest_accounts(
        feeds.join(roster.select("DT_RowId"), ["DT_RowId"], "left_semi"))
    accounts = in_region(accounts, region)
    summoners = D.summoners(documents("summoners", landed.summoners, D.S.SUMMONER), accounts)
    headers = documents("headers", landed.headers, D.S.MATCH_HEADER)
    tracked = summoners.select("puuid").filter(F.col("puuid").isNotNull()).distinct()
    players = stage(latest_matches(headers.join(tracked, ["puuid"], "left_semi")), "players")
    timelines = documents("timelines", landed.timelines, D.S.TIMELINE)
    details = documents("details", landed.details, D.S.MATCH_DETAIL)
    catalogs = documents("champions", landed.champions, D.S.CHAMPION_CATALOG, True)
    rejects = None
    for source, bad in rejected.items():
        rows = bad.select(F.lit(source).alias("source"), F.lit("unparsable").alias("reason"), "raw")
        rejects = rows if rejects is None else rejects.unionByName(rows)
    # only tracked matches' documents are shuffled and staged
    timelines = stage(one_per_match(of_matches(timelines, "metadata.matchId", players), "metadata.matchId"), "timelines")
    details = stage(one_per_match(of_matches(details, "match_id", players), "match_id"), "details")
    out = extract_tables(timelines, details, players)
    out.update(roster=roster, profiles=profiles, accounts=accounts, summoners=summoners,
               champions=D.champion_rows(catalogs),
               timelines=timelines, details=details, players=players, rejects=rejects)
    return out


def transform(spark: SparkSession, ex: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The eight star tables, and under ``incomplete`` the performances that
    still lack their match detail or outcome (they are not loaded)."""
    perf = performance_from_timelines(ex["timelines"], ex["details"], ex["players"], fill_zero=False)
    complete, incomplete = split_incomplete(stage(perf, "performance"))
    return {
        "incomplete": incomplete,
        "country": dims.country_dim(ex["profiles"]),
        "role": dims.role_dim(ex["roster"]),
        "champion": dims.champion_dim(ex["champions"]),
        "streamer": dims.streamer_dim(ex["roster"], ex["profiles"]),
        "summoner": dims.summoner_dim(ex["summoners"], ex["accounts"]),
        "match": dims.match_dim(ex["match_info"]),
        "outcome": dims.outcome_dim(spark),
        "performance": dims.performance_for_load(complete),
    }


def load(spark: SparkSession, tables: dict[str, DataFrame], db: str,
         location: str | None = None) -> dict[str, int]:
    return load_star(spark, db, tables, location)


def train(spark: SparkSession, db: str, feature_path: str, model_path: str, seed: int = 0):
    """Feature table from the stored star tables, then search, refit, save."""
    ml = feature_table(spark.table(f"{db}.performance"), spark.table(f"{db}.champion"))
    write_parquet(ml, feature_path)
    result = tune_and_fit(spark.read.parquet(feature_path), seed=seed)
    save_model(result.model, model_path)
    return result


def run(spark: SparkSession, landed: Landed, db: str, location: str | None = None,
        mode: str = "all", model_dir: str | None = None, seed: int = 0) -> dict:
    """One hourly run: extract, transform, load; then train when ``model_dir``
    is given. Returns the rows appended per table (and the tuning result)."""
    ex = extract(spark, landed, mode)
    tables = transform(spark, ex)
    appended = load(spark, tables, db, location)
    out = {"appended": appended, "rejects": ex["rejects"].count(), "incomplete": tables["incomplete"].count()}
    if model_dir:
        result = train(spark, db, f"{model_dir.rstrip('/')}/features.parquet",
                       f"{model_dir.rstrip('/')}/model", seed)
        out["best_c"], out["cv_accuracy"] = result.best_c, result.best_score
    return out


def main(argv=None) -> dict:
    """``python -m matchforge.plans.batch_job --roster ... --db ...``"""
    import argparse
    import json

    p = argparse.ArgumentParser(description="hourly match-telemetry load")
    for name in ("roster", "profiles", "feeds", "summoners", "timelines", "details",
                 "champions", "headers"):
        p.add_argument(f"--{name}", required=True, help=f"landed {name} (JSON)")
    p.add_argument("--db", required=True)
    p.add_argument("--location", default=None, help="database folder (shared storage)")
    p.add_argument("--mode", default="all", choices=["all", "online"])
    p.add_argument("--model-dir", default=None)
    p.add_argument("--seed", type=int, default=0)
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("matchforge-hourly").getOrCreate()
    landed = Landed(a.roster, a.profiles, a.feeds, a.summoners, a.timelines, a.details,
                    a.champions, a.headers)
    out = run(spark, landed, a.db, a.location, a.mode, a.model_dir, a.seed)
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main()
