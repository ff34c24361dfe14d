"""Plan shape and cross-plan equality on the driver's smallest tables."""

from matchforge.plans import catalog as C
from matchforge.plans.explain import plan_summary
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_three_performance_plans_agree(spark):
    a = _rows(C.performance_table(spark, SF_SMALL))
    b = _rows(C.performance_union_agg(spark, SF_SMALL))
    c = _rows(C.performance_single_pass(spark, SF_SMALL))
    assert a == b == c and len(a) > 0


def test_single_pass_shuffles_least(spark):
    chain = plan_summary(C.performance_table(spark, SF_SMALL))
    union = plan_summary(C.performance_union_agg(spark, SF_SMALL))
    single = plan_summary(C.performance_single_pass(spark, SF_SMALL))
    assert single["exchanges"] < union["exchanges"] < chain["exchanges"]
    assert union["sort_merge_joins"] == 0
    assert all(p["python_evals"] == 0 for p in (chain, union, single))


def test_single_pass_scans_the_events_once(spark):
    """The per-player rows are staged; the final plan reads no events."""
    from matchforge.plans.explain import plan_text
    assert "events.parquet" not in plan_text(C.performance_single_pass(spark, SF_SMALL))


def test_union_rejects_an_input_that_repeats_a_key(spark):
    import pytest

    from matchforge.operators import facts
    from matchforge.plans import fixture_views as V
    r = V.reference_tables(spark, SF_SMALL)
    with pytest.raises(Exception, match="repeats a"):
        facts.performance_union(r["champion"].unionByName(r["champion"]), r["kd"], r["scores"], r["wards"],
                                r["outcomes"], V.VIEW_CUTOFFS).collect()


def test_scan_prunes_columns_and_pushes_filters(spark):
    from matchforge.plans.explain import plan_text
    text = plan_text(C.roster_online(spark, SF_SMALL))
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_nationkey:int," \
           "c_acctbal:double,c_mktsegment:string>" in text
    assert "PushedFilters: [IsNotNull(c_mktsegment), IsNotNull(c_acctbal)" in text


def test_counts_never_exceed_events(spark):
    perf = C.performance_single_pass(spark, SF_SMALL)
    kd = C.kill_death_single_pass(spark, SF_SMALL)
    tot = perf.groupBy().sum("no_kills", "no_deaths").first()
    tot_kd = kd.groupBy().sum("no_kills", "no_deaths").first()
    assert tuple(tot) == tuple(tot_kd)


def test_no_registered_query_runs_python_per_row(spark):
    """Every lazy catalogue plan stays JVM-side: no Python UDF or pandas
    evaluation node (builders that write first are checked through tests of
    their operators)."""
    from matchforge.plans.checked import CHECKED
    from matchforge.plans.landed import LANDED
    eager = {"csv_all_string_cast", "append_if_absent", "incremental_load", "star_load",
             "model_score"} | {f.__name__ for f in (*LANDED, *CHECKED)}
    for name, build in C.queries().items():
        if name in eager:
            continue
        assert plan_summary(build(spark, SF_SMALL))["python_evals"] == 0, name
