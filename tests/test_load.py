import pytest
from pyspark.sql import functions as F

from matchforge.operators.aggregates import first_wins, key_violations, surrogate_key
from matchforge.operators.load import (LoadError, append_if_absent, create_star_tables,
                                       load_star, new_rows, star_exists)


def test_append_if_absent_twice_is_once(spark, workdir):
    target = f"{workdir}/t"
    spark.createDataFrame([(1, "a"), (2, "b")], "k INT, v STRING").write.parquet(target)
    batch = spark.createDataFrame([(2, "B"), (3, "c"), (3, "z"), (4, "d")], "k INT, v STRING")
    append_if_absent(batch, target, [["k"]], order=["v"])
    first = sorted(tuple(r) for r in spark.read.parquet(target).collect())
    append_if_absent(batch, target, [["k"]], order=["v"])
    second = sorted(tuple(r) for r in spark.read.parquet(target).collect())
    assert first == second == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]


def test_append_null_key_is_an_error(spark, workdir):
    batch = spark.createDataFrame([(None, "x")], "k INT, v STRING")
    with pytest.raises(LoadError):
        append_if_absent(batch, f"{workdir}/t2", [["k"]])


def test_first_wins_ignores_input_order(spark):
    rows = [(1, 5, "x"), (1, 3, "y"), (1, 3, "a"), (2, 1, "q")]
    a = spark.createDataFrame(rows, "k INT, o INT, v STRING")
    b = spark.createDataFrame(list(reversed(rows)), "k INT, o INT, v STRING").repartition(3)
    ra = {tuple(r) for r in first_wins(a, ["k"], ["o"]).collect()}
    rb = {tuple(r) for r in first_wins(b, ["k"], ["o"]).collect()}
    assert ra == rb == {(1, 3, "a"), (2, 1, "q")}


def test_key_violations(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (None, 3)], "a INT, b INT")
    got = {tuple(r) for r in key_violations(df, ["a", "b"]).collect()}
    assert got == {("duplicate", 1, 1, 2), ("null_key", None, None, 1)}


def test_surrogate_key_dense_in_order(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("x")).repartition(5)
    out = surrogate_key(df, ["x"], "sid", start=100, partitions=4).collect()
    pairs = sorted((r.x, r.sid) for r in out)
    assert [s for _, s in pairs] == list(range(101, 1101))


def test_new_rows_multiple_unique_keys(spark):
    target = spark.createDataFrame([(1, "m", "s", 5)], "id INT, m STRING, s STRING, c INT")
    batch = spark.createDataFrame([(2, "m", "s", 5), (3, "m", "s", 6)], "id INT, m STRING, s STRING, c INT")
    got = {tuple(r) for r in new_rows(batch, target, [["id"], ["m", "s", "c"]]).collect()}
    assert got == {(3, "m", "s", 6)}


def _star_batches(spark):
    return {
        "country": spark.createDataFrame([("Spain",), ("Spain",)], "country_name STRING"),
        "role": spark.createDataFrame([(1, "Top")], "role_id INT, role_name STRING"),
        "champion": spark.createDataFrame([(11, "X", 1, 2, 3)],
                                          "champion_id INT, champion_name STRING, attack INT, "
                                          "defense INT, magic INT"),
        "streamer": spark.createDataFrame([(1, "one", "Jane", "Spain", 1)],
                                          "streamer_id INT, streamer_name STRING, "
                                          "real_name STRING, birth_country STRING, role_id INT"),
        "summoner": spark.createDataFrame([("A2", "acc1", 1)],
                                          "puuid STRING, account_name STRING, streamer_id INT"),
        "match": spark.createDataFrame([("M1", 20)], "match_id STRING, duration INT"),
        "outcome": spark.createDataFrame([(0, "loss"), (1, "win")],
                                         "outcome_id INT, outcome_name STRING"),
        "performance": spark.createDataFrame(
            [("M1", "A2", 11, 1, 2, 3000, 60, 4000, 2, 1),
             ("M1", "A2", 11, 9, 9, 9, 9, 9, 9, 1)],
            "match_id STRING, summoner_id STRING, champion_id INT, kills INT, deaths INT, "
            "gold INT, minions INT, xp INT, wards INT, outcome_id INT"),
    }


def test_star_load_idempotent_and_validated(spark):
    db = "mf_star_test"
    assert create_star_tables(spark, db) is True
    assert star_exists(spark, db) and create_star_tables(spark, db) is False
    counts = load_star(spark, db, _star_batches(spark))
    assert counts["country"] == 1 and counts["performance"] == 1
    perf = spark.table(f"{db}.performance").collect()
    assert [(r.performance_id, r.kills) for r in perf] == [(1, 1)]
    again = load_star(spark, db, _star_batches(spark))
    assert all(v == 0 for v in again.values())
    # an orphan foreign key aborts the whole load: nothing is appended anywhere
    bad = _star_batches(spark)
    bad["match"] = spark.createDataFrame([("M9", 30)], "match_id STRING, duration INT")
    bad["performance"] = spark.createDataFrame(
        [("M9", "NOPE", 11, 0, 0, 0, 0, 0, 0, 1)],
        "match_id STRING, summoner_id STRING, champion_id INT, kills INT, deaths INT, "
        "gold INT, minions INT, xp INT, wards INT, outcome_id INT")
    with pytest.raises(LoadError):
        load_star(spark, db, bad)
    spark.catalog.refreshTable(f"{db}.match")
    assert spark.table(f"{db}.match").count() == 1


def test_fk_levels_put_parents_first():
    from matchforge import schemas as S
    from matchforge.operators.load import fk_levels
    levels = fk_levels()
    where = {t: i for i, level in enumerate(levels) for t in level}
    assert sorted(where) == sorted(S.STAR_LOAD_ORDER)
    for child, spec in S.STAR_KEYS.items():
        for parent, _ in spec.get("fk", {}).values():
            assert where[parent] < where[child]


def test_null_summoner_key_aborts_before_any_append(spark):
    db = "mf_star_null_key"
    batches = _star_batches(spark)
    batches["summoner"] = spark.createDataFrame([("A2", "acc1", 1), (None, "lost", 1)],
                                                "puuid STRING, account_name STRING, "
                                                "streamer_id INT")
    with pytest.raises(LoadError, match="summoner: null"):
        load_star(spark, db, batches)
    assert spark.table(f"{db}.country").count() == 0


def test_two_unique_keys_insert_like_a_row_by_row_insert(spark, workdir):
    """Rows 0 and 2 stay: row 1 loses its b to row 0, which frees a=2."""
    batch = spark.createDataFrame([(0, 1, "x"), (1, 2, "x"), (2, 2, "y")], "o INT, a INT, b STRING")
    got = sorted(tuple(r) for r in new_rows(batch, None, [["a"], ["b"]], ["o"]).collect())
    assert got == [(0, 1, "x"), (2, 2, "y")]
    # A row that the target rejects frees its other key as well.
    target = spark.createDataFrame([(9, 9, "x")], "o INT, a INT, b STRING")
    assert [r.o for r in new_rows(batch, target, [["a"], ["b"]], ["o"]).collect()] == [2]
    target.write.parquet(f"{workdir}/two")
    append_if_absent(batch, f"{workdir}/two", [["a"], ["b"]], ["o"])
    assert sorted(r.o for r in spark.read.parquet(f"{workdir}/two").collect()) == [2, 9]


def test_two_unique_keys_equal_brute_force(spark):
    import random
    r = random.Random(5)
    rows = [(i, r.randint(0, 12), r.randint(0, 12)) for i in range(60)]
    kept, a, b = [], set(), set()
    for o, x, y in rows:
        if x not in a and y not in b:
            kept.append((o, x, y))
            a.add(x)
            b.add(y)
    df = spark.createDataFrame(rows, "o INT, a INT, b INT").repartition(4)
    assert sorted(map(tuple, new_rows(df, None, [["a"], ["b"]], ["o"]).collect())) == kept


def test_surrogate_key_without_exchange_reuse(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/orders.parquet").select("o_orderkey", "o_orderdate")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        out = surrogate_key(df, ["o_orderdate", "o_orderkey"], partitions=12)
        n, ids, low, high = out.agg(F.count("*"), F.countDistinct("serial_id"), F.min("serial_id"), F.max("serial_id")).first()
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    assert (ids, low, high) == (n, 1, n)


def test_half_made_database_is_completed(spark, workdir):
    spark.sql(f"CREATE DATABASE mf_half LOCATION '{workdir}/half'")
    assert create_star_tables(spark, "mf_half") is False
    assert spark.catalog.tableExists("mf_half.performance")


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from matchforge import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}
    monkeypatch.setattr(session, "_context", lambda s: Context())

    class Session:
        class conf:
            @staticmethod
            def get(key, default=None):
                return default
    with pytest.raises(RuntimeError):
        session.shared_dir(Session())


def _kept_by_inserts(rows, keys, order):
    taken, kept = [set() for _ in keys], []
    for r in sorted(rows, key=order):
        mine = [tuple(r[i] for i in k) for k in keys]
        if all(None in m or m not in t for m, t in zip(mine, taken)):
            kept.append(r)
            for m, t in zip(mine, taken):
                t.add(m)
    return sorted(kept, key=str)


def test_several_keys_equal_row_by_row_inserts(spark):
    """As one ordered pass and by components, against inserts one by one."""
    import random

    from matchforge.operators.load import insert_or_skip
    for seed, one_task in [(1, 1000), (2, 0), (3, 0)]:
        r = random.Random(seed)
        rows = [(i, r.choice([None, *range(25)]), r.randint(0, 20), r.choice("abcdefghijklmnop")) for i in range(150)]
        df = spark.createDataFrame(rows, "o int, a int, b int, c string").repartition(4)
        got = insert_or_skip(df, [["a"], ["b", "c"], ["c", "a"]], ["o"], one_task_rows=one_task)
        assert sorted(map(tuple, got.collect()), key=str) == _kept_by_inserts(rows, [[1], [2, 3], [3, 1]], lambda x: x[0])


def test_components_follow_long_chains(spark):
    from matchforge.operators.load import conflict_components
    rows = spark.range(300).selectExpr("id AS _nth", "id div 2 AS a", "(id + 1) div 2 AS b").where("_nth <> 100")
    got = dict(map(tuple, conflict_components(rows, [["a"], ["b"]]).collect()))
    assert set(got.values()) == {0, 101} and got[99] == 0 and got[299] == 101


def test_a_chain_of_ten_thousand_rows_takes_few_jobs(spark):
    from matchforge.operators.load import insert_or_skip
    tracker, group = spark.sparkContext.statusTracker(), "chain-of-rows"
    chain = spark.range(10_000).selectExpr("id AS o", "id div 2 AS a", "(id + 1) div 2 AS b")
    spark.sparkContext.setJobGroup(group, group)
    try:
        kept = sorted(r.o for r in insert_or_skip(chain, [["a"], ["b"]], ["o"]).collect())
    finally:
        spark.sparkContext.setJobGroup("default", "default")
    assert kept == list(range(0, 10_000, 2))
    assert len(tracker.getJobIdsForGroup(group)) < 30


def _star_state(spark, db):
    from matchforge import schemas as S
    from matchforge.operators.load import refresh_star
    refresh_star(spark, db)
    return {n: sorted(map(tuple, spark.table(f"{db}.`{n}`").collect())) for n in S.STAR_LOAD_ORDER}


def test_a_load_killed_between_two_appends_shows_nothing(spark, monkeypatch):
    """Readers see the old state in all eight tables; the rerun shows the new
    one in all of them, and what the killed load left is gone."""
    from matchforge.operators import load as module
    db = "mf_star_killed"
    load_star(spark, db, _star_batches(spark))
    before = _star_state(spark, db)
    more = _star_batches(spark)
    more["country"] = spark.createDataFrame([("Spain",), ("Peru",)], "country_name STRING")
    more["champion"] = spark.createDataFrame([(12, "Y", 1, 2, 3)], more["champion"].schema)
    more["match"] = spark.createDataFrame([("M2", 30)], more["match"].schema)
    more["performance"] = spark.createDataFrame([("M2", "A2", 12, 4, 4, 4, 4, 4, 4, 0)], more["performance"].schema)
    append = module.append_load

    def killed(rows, db, name, load_id):
        if name == "performance":
            raise RuntimeError("killed")
        append(rows, db, name, load_id)
    monkeypatch.setattr(module, "append_load", killed)
    with pytest.raises(RuntimeError, match="killed"):
        load_star(spark, db, more)
    monkeypatch.setattr(module, "append_load", append)
    left = spark.table(f"{db}.match_rows").select("load_id").distinct().count()
    assert left == 2 and _star_state(spark, db) == before
    # ... nor if it dies after the last append, before it is published.
    monkeypatch.setattr(module, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        load_star(spark, db, more)
    monkeypatch.undo()
    assert _star_state(spark, db) == before
    counts = load_star(spark, db, more)
    after = _star_state(spark, db)
    assert {n for n, c in counts.items() if c} == {"country", "champion", "match", "performance"}
    assert [r[:4] for r in after["performance"]] == [(1, "M1", "A2", 11), (2, "M2", "A2", 12)]
    assert after["country"] == [("Peru",), ("Spain",)]
    for name in ("country", "performance"):  # no row of the two killed loads
        assert spark.table(f"{db}.{name}_rows").select("load_id").distinct().count() == 2
    assert spark.table(f"{db}.loads").count() == 2


def test_measures_of_a_staged_copy(spark):
    """Two jobs at most: the write and one pass over the copy. A model that is
    fitted later in the same session can still be applied."""
    from matchforge.operators.model import fit, score
    from matchforge.staging import stage_measured
    tracker, group = spark.sparkContext.statusTracker(), "measured-copy"
    spark.sparkContext.setJobGroup(group, group)
    try:
        copy, seen = stage_measured(spark.range(1000).selectExpr("id", "nullif(id % 10, 3) AS k"), "seen",
                                    rows=F.count(F.lit(1)), nulls=F.count_if(F.col("k").isNull()), low=F.min("k"))
    finally:
        spark.sparkContext.setJobGroup("default", "default")
    assert seen == {"rows": 1000, "nulls": 100, "low": 0} and copy.count() == 1000
    assert len(tracker.getJobIdsForGroup(group)) <= 3
    _, none = stage_measured(spark.range(5).where("false"), "none", rows=F.count(F.lit(1)), low=F.min("id"))
    assert none == {"rows": 0, "low": None}
    rows = spark.createDataFrame([(float(i % 7), i % 2) for i in range(60)], "a DOUBLE, outcome_id INT")
    assert score(fit(rows, 1.0), rows, features=["a"]).count() == 60


def test_an_append_reads_the_batch_s_month_and_key_range(spark, workdir):
    from matchforge.operators import load as module
    path = f"{workdir}/months"
    rows = spark.range(3000).selectExpr("id AS k", "concat('2024-', lpad(id div 1000 + 1, 2, '0')) AS month", "'old' AS v")
    rows.repartition("month").write.partitionBy("month").parquet(path)
    batch = spark.range(1990, 2010).selectExpr("id + 5 AS k", "'2024-' || lpad((id + 5) div 1000 + 1, 2, '0') AS month", "'new' AS v").where("k >= 2000")
    late = spark.createDataFrame([(3001, "2024-03", "new"), (2999, "2024-03", "new"), (3001, "2024-03", "zz")], "k long, month string, v string")
    batch = batch.unionByName(late)
    seen = batch.agg(*[c.alias(n) for n, c in module.key_range([["k"]]).items()]).first().asDict()
    read = module.within_partitions(module.within_range(spark.read.parquet(path), [["k"]], seen), batch, ["month"])
    assert all("month=2024-03" in f for f in _files_read(read)) and seen == {"min_k": 2000, "max_k": 3001}
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,2000)" in plan and "LessThanOrEqual(k,3001)" in plan
    append_if_absent(batch, path, [["k"]], ["v"], partition_by=["month"])
    after = {r.k: (r.month, r.v) for r in spark.read.parquet(path).collect()}
    assert len(after) == spark.read.parquet(path).count() == 3001
    assert after[2999] == ("2024-03", "old") and after[3001] == ("2024-03", "new")


def _files_read(df):
    """Files that the scan of a filtered partitioned table selects."""
    return [r.f for r in df.select(F.input_file_name().alias("f")).distinct().collect()]


def test_partitions_beyond_the_list_and_null_ones(spark, workdir, monkeypatch):
    from matchforge.operators import load as module
    target = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "k int, p string")
    target.write.partitionBy("p").parquet(f"{workdir}/p")
    target = spark.read.parquet(f"{workdir}/p")
    batch = spark.createDataFrame([(9, "a"), (2, None)], "k int, p string")
    assert sorted(r.k for r in module.within_partitions(target, batch, ["p"]).collect()) == [1, 2]
    assert sorted(r.k for r in module.within_partitions(target, batch.dropna(), ["p"]).collect()) == [1]
    monkeypatch.setattr(module, "LISTED_PARTITIONS", 0)
    assert sorted(r.k for r in module.within_partitions(target, batch, ["p"]).collect()) == [1, 2]


def test_keys_of_other_types_are_not_narrowed(spark):
    from matchforge.operators.load import within_range
    target = spark.createDataFrame([(1.5,), (2.5,)], "k double")
    assert within_range(target, [["k"]], {"min_k": 9.0, "max_k": 9.0}).count() == 2
