import pytest
from pyspark.sql import functions as F

from matchforge import schemas as S
from matchforge.sources.documents import kv_map
from matchforge.sources.quarantine import open_records, quarantine, record_id, replay

GOOD = '{"puuid":"A","match_id":"M1","queue_id":420,"started_at":1}'
NEEDED = ["match_id", "puuid"]


def _rejects(spark, *rows):
    return spark.createDataFrame(list(rows), "source string, reason string, raw string")


def _open(spark, path):
    return sorted((r.source, r.reason, r.attempts, r.raw) for r in open_records(spark, path).collect())


def test_replay_stores_repaired_records_and_counts_attempts(spark, workdir):
    path, merged = f"{workdir}/q", []
    assert _open(spark, path) == []
    quarantine(_rejects(spark, ("headers", "unparsable", GOOD[:-1]), ("headers", "unparsable", "{x"), ("headers", "unparsable", "{x"),
                        ("feeds", "unparsable", "{x")), path, 1)
    repairs = spark.createDataFrame([(GOOD[:-1], GOOD)], "raw string, value string").select(record_id().alias("record_id"), "value")

    def merge(usable):
        merged.extend((r.match_id, r.puuid, r.attempts) for r in usable.collect())
    n = replay(spark, path, "headers", S.MATCH_HEADER, NEEDED, 2, merge, repairs)
    assert n == {"repaired": 1, "failed": 1} and merged == [("M1", "A", 2)]
    assert _open(spark, path) == [("feeds", "unparsable", 1, "{x"), ("headers", "unparsable", 2, "{x")]
    # A repaired record is not tried again; one that lands broken again is open again.
    assert replay(spark, path, "headers", S.MATCH_HEADER, NEEDED, 3, merge) == {"repaired": 0, "failed": 1}
    quarantine(_rejects(spark, ("headers", "unparsable", GOOD[:-1])), path, 4)
    assert _open(spark, path)[1:] == [("headers", "unparsable", 3, GOOD[:-1]), ("headers", "unparsable", 3, "{x")]


def test_a_replay_that_dies_is_run_again(spark, workdir):
    path, seen = f"{workdir}/q", []
    quarantine(_rejects(spark, ("headers", "no match_id", '{"puuid":"A"}'), ("headers", "unparsable", "")), path, 1)
    repairs = spark.createDataFrame([('{"puuid":"A"}', GOOD)], "raw string, value string").select(record_id().alias("record_id"), "value")

    def dies(usable):
        seen.append(usable.count())
        raise RuntimeError("lost")
    with pytest.raises(RuntimeError, match="lost"):
        replay(spark, path, "headers", S.MATCH_HEADER, NEEDED, 2, dies, repairs)
    assert [r[2] for r in _open(spark, path)] == [1, 1]
    for _ in range(2):  # the same attempt twice counts once
        replay(spark, path, "headers", S.MATCH_HEADER, NEEDED, 2, lambda usable: seen.append(usable.count()), repairs)
    assert seen == [1, 1, 0] and _open(spark, path) == [("headers", "unparsable", 2, "")]


def test_map_of_pairs_equals_a_plain_loop(spark):
    texts = ["a=1 b=2 a=3 c=4 b=5", "", None, "z=9", " ".join(f"k{i % 700}={i}" for i in range(3000))]
    pages = spark.createDataFrame(list(enumerate(texts)), "id int, html string")
    got = {r.id: r.pairs for r in kv_map(pages, "id", "html", r"(\w+)=(\w+)").collect()}
    for i, text in enumerate(texts):
        want = None if text is None else {}
        for pair in (text or "").split():
            want.setdefault(*pair.split("="))
        assert got[i] == want


def test_more_keys_than_a_pivot_may_have(spark):
    spark.conf.set("spark.sql.pivotMaxValues", "3")
    try:
        pages = spark.range(10).select("id", F.concat(F.lit("key"), "id", F.lit("=v"), "id").alias("html"))
        assert sum(len(r.pairs) for r in kv_map(pages, "id", "html", r"(\w+)=(\w+)").collect()) == 10
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")
