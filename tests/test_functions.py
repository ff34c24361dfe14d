from pyspark.sql import functions as F

from matchforge.functions.scalar import (ceil_minutes, encode_outcome, int_from_text,
                                         label_word, map_lookup_by_position, position_in,
                                         split_piece, win_loss)
from tests import golden as G


def test_win_loss_truth_table(spark):
    df = spark.createDataFrame(G.OUTCOME_CASES + [(None, 1, None)],
                               "wt INT, pos INT, expected STRING")
    got = df.select(win_loss("wt", "pos").alias("o"), "expected").collect()
    assert all(r.o == r.expected for r in got)


def test_encode_outcome_case_without_default(spark):
    df = spark.createDataFrame([("win",), ("loss",), ("draw",), (None,)], "o STRING")
    assert [r[0] for r in df.select(encode_outcome("o")).collect()] == [1, 0, None, None]


def test_int_from_float_text_truncates(spark):
    df = spark.createDataFrame([("599999.0",), ("600100.0",), ("12.7",), ("x",)], "s STRING")
    assert [r[0] for r in df.select(int_from_text("s")).collect()] == [599999, 600100, 12, None]


def test_ceil_minutes(spark):
    df = spark.createDataFrame([(600000,), (600001,), (1799999,)], "d LONG")
    assert [r[0] for r in df.select(ceil_minutes("d")).collect()] == [10, 11, 30]


def test_split_piece_second_to_last(spark):
    df = spark.createDataFrame([("<a href='https://x/p/1'>One</a>",), ("no quote",)], "s STRING")
    assert [r[0] for r in df.select(split_piece("s", "'")).collect()] == ["https://x/p/1", None]


def test_position_and_map_lookup(spark):
    df = spark.createDataFrame([(["a", "b", "c"], "b"), (["a"], "z")], "arr ARRAY<STRING>, v STRING")
    df = df.withColumn("pos", position_in("arr", "v"))
    m = F.create_map(F.lit("2"), F.lit("second"))
    got = df.select("pos", map_lookup_by_position(m, "pos").alias("x")).collect()
    assert [(r.pos, r.x) for r in got] == [(2, "second"), (0, None)]


def test_label_word(spark):
    df = spark.createDataFrame([(1.0,), (0.0,)], "p DOUBLE")
    assert [r[0] for r in df.select(label_word("p")).collect()] == ["win", "loss"]


def test_scale_settings_for_100tb():
    from matchforge.session import scale_settings
    s = scale_settings(100 * (1 << 40), 8000)
    assert int(s["spark.sql.shuffle.partitions"]) == 409600
    assert s["spark.sql.adaptive.skewJoin.enabled"] == "true"
