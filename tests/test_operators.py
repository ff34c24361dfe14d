"""Small operators: projections, casts, reject split, dims, sinks."""

from pyspark.sql import functions as F

from matchforge.operators.dims import match_dim, outcome_dim, role_dim, summoner_dim
from matchforge.operators.filters import (before, in_region, ranked_solo,
                                          same_value, split_rejects)
from matchforge.operators.joins import fk_orphans, outer_chain, row_count_at_most, sized_broadcast
from matchforge.operators.load import write_csv, write_parquet
from matchforge.operators.project import (cast_int, drop_cols, features_without,
                                          name_positionally, rename, select_as)
from matchforge.sources.files import literal_table, read_csv_text, read_parquet, read_table


def test_projection_helpers(spark):
    df = spark.createDataFrame([("1", "599999.0", "x")], "_c0 STRING, t STRING, v STRING")
    out = select_as(df, {"ts": "t", "val": "v"})
    assert out.columns == ["ts", "val"]
    assert cast_int(out, ["ts"], from_text=True).first().ts == 599999
    assert drop_cols(df, "_c0", "style").columns == ["t", "v"]
    assert rename(df, {"t": "timestamp"}).columns == ["_c0", "timestamp", "v"]
    assert name_positionally(df, "a", "b", "c").columns == ["a", "b", "c"]
    assert features_without(df, "v") == ["_c0", "t"]


def test_filters_and_rejects(spark):
    df = spark.createDataFrame([(1, 1, 600099, 420, "EUW"), (2, 3, 600100, 400, "NA"),
                                (3, None, 599999, 420, "EUW")],
                               "k INT, m INT, ts LONG, queueId INT, region STRING")
    assert before(df, "ts", 600100).count() == 2
    assert same_value(df, "k", "m").count() == 1
    assert ranked_solo(df).count() == 2
    assert in_region(df, "EUW").count() == 2 and in_region(df, None).count() == 3
    good, bad = split_rejects(df, F.col("m") > 0)
    assert good.count() == 2 and bad.count() == 1       # null verdict is a reject


def test_dims(spark):
    roster = spark.createDataFrame([("2.0", "Jungle"), ("x", "Coach")], "roleNum STRING, role STRING")
    assert [tuple(r) for r in role_dim(roster).collect()] == [(2, "Jungle"), (None, "Coach")]
    info = spark.createDataFrame([("1", "M1", "1200000")], "_c0 STRING, match_id STRING, duration STRING")
    assert [tuple(r) for r in match_dim(info).collect()] == [("M1", 20)]
    assert {tuple(r) for r in outcome_dim(spark).collect()} == {(0, "loss"), (1, "win")}
    summ = spark.createDataFrame([("P1", "acc1"), ("P2", "acc2")], "puuid STRING, account_name STRING")
    acc = spark.createDataFrame([("acc1", "7"), ("acc9", "8")], "account_name STRING, DT_RowId STRING")
    got = {tuple(r) for r in summoner_dim(summ, acc).collect()}
    assert got == {("P1", "acc1", 7), ("P2", "acc2", None), (None, "acc9", 8)}


def test_joins(spark):
    a = spark.createDataFrame([(1, "a")], "k INT, x STRING")
    b = spark.createDataFrame([(2, "b")], "k INT, y STRING")
    c = spark.createDataFrame([(1, "c")], "k INT, z STRING")
    got = {tuple(r) for r in outer_chain([a, b, c], ["k"]).collect()}
    assert got == {(1, "a", None, "c"), (2, None, "b", None)}
    assert row_count_at_most(a, 1) and not row_count_at_most(a.union(a), 1)
    assert sized_broadcast(a, 5).count() == 1
    child = spark.createDataFrame([(1,), (5,), (None,)], "fk INT")
    assert [r.fk for r in fk_orphans(child, "fk", a, "k").collect()] == [5]


def test_sinks_and_sources(spark, workdir):
    df = literal_table(spark, [(1, "x"), (2, "y")], "id INT, v STRING")
    path = f"{workdir}/t.parquet"
    write_parquet(df, path)
    assert path.endswith("/t.parquet") and read_parquet(spark, path).count() == 2
    write_csv(df, f"{workdir}/csv")
    text = read_csv_text(spark, f"{workdir}/csv")
    assert dict(text.dtypes) == {"id": "string", "v": "string"}
    spark.sql("CREATE DATABASE IF NOT EXISTS mf_src_test")
    df.write.mode("overwrite").saveAsTable("mf_src_test.t")
    assert read_table(spark, "mf_src_test", "t").columns == ["id", "v"]


def test_broadcast_budget_shrinks_with_width(spark):
    from matchforge.operators.joins import row_width_estimate
    narrow = spark.createDataFrame([(1,)], "k INT")
    wide = spark.createDataFrame([(1, "a", [1])], "k INT, s STRING, a ARRAY<INT>")
    assert row_width_estimate(narrow) == 8 and row_width_estimate(wide) == 8 + 32 + 128
    plan = sized_broadcast(wide, max_rows=10, max_bytes=100)       # budget 0 -> 1 row
    assert plan.count() == 1
