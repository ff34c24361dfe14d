"""Properties over generated inputs (hypothesis): first-wins ignores input
order, append twice = once, chain = union-aggregate, counts add up."""

import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from matchforge.operators import facts
from matchforge.operators.aggregates import first_wins
from matchforge.operators.load import new_rows

SETTINGS = settings(max_examples=int(os.environ.get("MF_EXAMPLES", "8")), deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

rows_st = st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3), st.sampled_from("abc")),
                   min_size=1, max_size=25)


@SETTINGS
@given(rows=rows_st, parts=st.integers(1, 4))
def test_first_wins_is_order_free(spark, rows, parts):
    a = spark.createDataFrame(rows, "k INT, o INT, v STRING")
    b = spark.createDataFrame(list(reversed(rows)), "k INT, o INT, v STRING").repartition(parts)
    got_a = sorted(tuple(r) for r in first_wins(a, ["k"], ["o"]).collect())
    got_b = sorted(tuple(r) for r in first_wins(b, ["k"], ["o"]).collect())
    expect = sorted(min((o, v, k) for k2, o, v in rows if k2 == k) for k in {r[0] for r in rows})
    assert got_a == got_b == sorted((k, o, v) for o, v, k in expect)


@SETTINGS
@given(target=rows_st, batch=rows_st)
def test_insert_or_skip_matches_sequential_inserts(spark, target, batch):
    schema = "k INT, o INT, v STRING"
    t = first_wins(spark.createDataFrame(target, schema), ["k"], ["o"])
    b = spark.createDataFrame(batch, schema)
    added = new_rows(b, t, [["k"]], ["o", "v"], small_batch_rows=None)
    have = {r.k for r in t.collect()}
    expect = {}
    for k, o, v in sorted(batch, key=lambda r: (r[1], r[2])):
        if k not in have and k not in expect:
            expect[k] = (k, o, v)
    assert sorted(tuple(r) for r in added.collect()) == sorted(expect.values())
    again = new_rows(b, t.unionByName(added), [["k"]], ["o", "v"])
    assert again.count() == 0


kd_st = st.lists(st.tuples(st.sampled_from(["m1", "m2"]), st.sampled_from(["p", "q"]),
                           st.integers(1, 3), st.integers(0, 3), st.integers(0, 3),
                           st.integers(0, 700000)), max_size=30)


@SETTINGS
@given(kd=kd_st, champs=st.lists(st.tuples(st.sampled_from(["m1", "m2", "m3"]),
                                           st.sampled_from(["p", "q", "r"]),
                                           st.integers(1, 9)), max_size=6))
def test_chain_equals_union_and_counts_add_up(spark, kd, champs):
    kd_df = spark.createDataFrame(kd, "match_id STRING, puuid STRING, main INT, killerId INT, "
                                      "victimId INT, timestamp LONG")
    champ = first_wins(spark.createDataFrame(champs, "match_id STRING, puuid STRING, "
                                                     "champion_id INT"),
                       ["match_id", "puuid"], ["champion_id"])
    empty_scores = spark.createDataFrame([], "match_id STRING, puuid STRING, gold_at_10 INT, "
                                             "minions_at_10 INT, xp_at_10 INT")
    empty_wards = spark.createDataFrame([], "match_id STRING, puuid STRING, timestamp LONG")
    empty_out = spark.createDataFrame([], "match_id STRING, puuid STRING, outcome STRING")
    args = (champ, kd_df, empty_scores, empty_wards, empty_out)
    chain = sorted(tuple(r) for r in facts.performance_chain(*args).collect())
    union = sorted(tuple(r) for r in facts.performance_union(*args).collect())
    assert chain == union
    early = [r for r in kd if r[5] < 600100]
    assert sum(r[3] for r in chain) == sum(1 for r in early if r[2] == r[3])
    assert sum(r[4] for r in chain) == sum(1 for r in early if r[2] == r[4])


def _events(spark, rows):
    import datetime as dt
    base = dt.datetime(2024, 1, 1)
    data = [(i, base + dt.timedelta(days=d, milliseconds=ms), u, et, float(v), f'{{"k": {k}}}')
            for i, (d, ms, u, et, v, k) in enumerate(rows)]
    return spark.createDataFrame(
        data, "event_id LONG, ts TIMESTAMP_NTZ, user_id LONG, event_type STRING, "
              "value DOUBLE, props STRING")


event_st = st.lists(st.tuples(
    st.integers(0, 2),                                              # day
    st.sampled_from([0, 35_999_999, 36_000_000, 36_005_999, 36_006_000, 50_000_000,
                     86_399_999]),                                  # ms since midnight
    st.integers(0, 12),                                             # user
    st.sampled_from(["click", "view", "purchase", "error", "signup"]),
    st.integers(0, 40), st.integers(0, 99)), min_size=1, max_size=40)


@SETTINGS
@given(rows=event_st)
def test_three_performance_plans_agree_on_generated_events(spark, rows):
    from matchforge.plans import fixture_views as V
    ev = _events(spark, rows)
    r = V.reference_tables_from(ev)
    args = (r["champion"], r["kd"], r["scores"], r["wards"], r["outcomes"], V.VIEW_CUTOFFS)
    chain = sorted(tuple(x) for x in facts.performance_chain(*args).collect())
    union = sorted(tuple(x) for x in facts.performance_union(*args).collect())
    single = sorted(tuple(x) for x in V.performance_single_pass(V.timeline_view(ev)).collect())
    assert chain == union == single
    long_days = {d for d, ms, *_ in rows if ms >= 36_000_000 and
                 max(m for dd, m, *_ in rows if dd == d) >= 36_000_000}
    assert {m for m, *_ in chain} <= {f"2024-01-0{d + 1}" for d in long_days}


@SETTINGS
@given(rows=event_st)
def test_nested_documents_count_like_the_flat_view(spark, rows):
    from pyspark.sql import functions as F

    from matchforge.plans import fixture_views as V
    ev = _events(spark, rows)
    r = V.reference_tables_from(ev)
    kd = facts.kills_deaths_single_pass(r["kd"], V.VIEW_CUTOFFS)
    wards = facts.ward_counts(r["wards"], V.VIEW_CUTOFFS)
    flat = kd.join(wards, ["match_id", "puuid"], "full").fillna(0).filter(
        (F.col("no_kills") + F.col("no_deaths") + F.col("ward_count")) > 0)
    want = sorted((m, str(p), k, d, w) for m, p, k, d, w in
                  flat.select("match_id", "puuid", "no_kills", "no_deaths", "ward_count").collect())
    got = sorted(tuple(x) for x in V.nested_event_counts(ev).select(
        "match_id", "puuid", "no_kills", "no_deaths", "ward_count").collect())
    assert got == want


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 1000)), min_size=1,
                     max_size=60, unique=True),
       parts=st.integers(1, 6), start=st.integers(0, 50))
def test_surrogate_keys_dense_and_ordered(spark, rows, parts, start):
    from matchforge.operators.aggregates import surrogate_key
    df = spark.createDataFrame(rows, "d INT, k INT").repartition(3)
    out = sorted((r.sid, r.d, r.k) for r in
                 surrogate_key(df, ["d"], "sid", start=start, partitions=parts).collect())
    assert [s for s, _, _ in out] == list(range(start + 1, start + len(rows) + 1))
    assert [(d, k) for _, d, k in out] == sorted(rows)     # order by d, then the rest


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 4), st.integers(0, 6), st.integers(0, 9)),
                     min_size=1, max_size=40))
def test_latest_and_key_violations_match_brute_force(spark, rows):
    from matchforge.operators.aggregates import key_violations, latest
    df = spark.createDataFrame(rows, "c INT, d INT, o INT").repartition(2)
    got = {tuple(r) for r in latest(df, ["c"], ["d", "o"]).collect()}
    want = {(c, *max((d, o) for cc, d, o in rows if cc == c)) for c in {r[0] for r in rows}}
    assert got == want
    viol = {tuple(r) for r in key_violations(df, ["c", "d"]).collect()}
    counts = {}
    for c, d, _ in rows:
        counts[(c, d)] = counts.get((c, d), 0) + 1
    assert viol == {("duplicate", c, d, n) for (c, d), n in counts.items() if n > 1}
