"""The whole job on golden landed documents: extract -> transform -> load,
twice (the second run appends nothing)."""

import json

from matchforge.plans import batch_job as B
from matchforge.sources.documents import read_json_with_rejects
from matchforge import schemas as S
from tests import golden as G


def _land(workdir):
    def dump(name, obj):
        path = f"{workdir}/{name}.json"
        with open(path, "w") as f:
            json.dump(obj, f)
        return path
    roster = dump("roster", G.ROSTER)
    profiles = G.write_lines(f"{workdir}/profiles.json",
                             [{"DT_RowId": i, "html": h} for i, h in G.PROFILE_PAGES])
    feeds = G.write_lines(f"{workdir}/feeds.json", G.FEEDS + [
        {"DT_RowId": "6", "data": [{"card_data": {"account_name": "acc6",
                                                  "account_server": "EUW"}}]}])
    summoners = G.write_lines(f"{workdir}/summoners.json", [
        {"account_name": "acc1", "puuid": "A2"}, {"account_name": "acc6", "puuid": "A7"},
        {"account_name": "nobody", "puuid": "Z9"}])
    # later matches of the tracked players: N1 in another queue, which does not
    # count; O1 earlier than M1, so M1 stays the latest; M1 landed twice
    other, old = (json.loads(json.dumps(G.M1)) for _ in range(2))
    other["metadata"]["matchId"], old["metadata"]["matchId"] = "N1", "O1"
    timelines = G.write_lines(f"{workdir}/timelines.json", G.TIMELINES + [other, old, G.M1])
    headers = G.write_lines(f"{workdir}/headers.json", [
        {"puuid": p, "match_id": m, "queue_id": q, "started_at": t}
        for p in ("A2", "A7", "Z9") for m, q, t in (("M1", 420, 50), ("N1", 400, 90), ("O1", 420, 10))])
    with open(timelines, "a") as f:
        f.write('{"metadata": {"matchId": "BROKEN", \n')      # a truncated record
    details = G.write_lines(f"{workdir}/details.json", G.DETAILS)
    champions = dump("catalog", {"data": {
        "X": {"key": "11", "name": "Eleven", "info": {"attack": 1, "defense": 2, "magic": 3}},
        "Y": {"key": "22", "name": "TwentyTwo", "info": {"attack": 3, "defense": 2, "magic": 1}}}})
    return B.Landed(roster, profiles, feeds, summoners, timelines, details, champions, headers)


def test_extract_transform_load_twice(spark, workdir):
    landed = _land(workdir)
    ex = B.extract(spark, landed)
    assert [r.source for r in ex["rejects"].collect()] == ["timelines"]
    tables = B.transform(spark, ex)
    perf = {(r.match_id, r.summoner_id, r.kills, r.deaths, r.wards, r.outcome_id)
            for r in tables["performance"].collect()}
    assert perf == {("M1", "A2", 1, 2, 2, 1), ("M1", "A7", 1, 1, 1, 0)}
    db = "mf_job_test"
    first = B.load(spark, tables, db, location=f"{workdir}/db")
    assert first["performance"] == 2 and first["outcome"] == 2
    second = B.load(spark, B.transform(spark, B.extract(spark, landed)), db)
    assert all(n == 0 for n in second.values())
    assert B.extract(spark, landed, region="EUNE")["players"].count() == 0
    ids = sorted(r.performance_id for r in spark.table(f"{db}.performance").collect())
    assert ids == [1, 2]


def test_rejects_go_to_side_table(spark, workdir):
    path = f"{workdir}/feeds_bad.json"
    with open(path, "w") as f:
        f.write(json.dumps(G.FEEDS[0]) + "\n{not json\n")
    good, rejects = read_json_with_rejects(spark, path, S.MATCH_FEED)
    assert good.count() == 1
    assert [r.raw for r in rejects.collect()] == ["{not json"]


def test_scoring_stream(spark, workdir):
    from matchforge.operators.model import fit
    from matchforge.streaming.incremental import start_scoring_stream
    rows = [(float(i % 7), float(i % 3), i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, outcome_id INT")
    model = fit(df, 1.0)
    import os
    os.makedirs(f"{workdir}/req", exist_ok=True)
    G.write_lines(f"{workdir}/req/r1.json", [{"a": 1.0, "b": 2.0}, {"a": 6.0, "b": 0.0}])
    q = start_scoring_stream(spark, model, f"{workdir}/req", ["a", "b"], f"{workdir}/scored",
                             f"{workdir}/scored_ckpt")
    q.awaitTermination()
    out = spark.read.parquet(f"{workdir}/scored").collect()
    assert len(out) == 2 and {r.predicted for r in out} <= {"win", "loss"}


def test_command_line_run(spark, workdir):
    landed = _land(workdir)
    args = []
    for name in ("roster", "profiles", "feeds", "summoners", "timelines", "details", "champions",
                 "headers"):
        args += [f"--{name}", getattr(landed, name)]
    out = B.main(args + ["--db", "mf_cli_test", "--location", f"{workdir}/clidb"])
    assert out["appended"]["performance"] == 2 and out["rejects"] == 1
    again = B.main(args + ["--db", "mf_cli_test"])
    assert all(n == 0 for n in again["appended"].values())
