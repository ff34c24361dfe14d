"""Column expressions. Built-in Spark functions only: everything stays in
whole-stage codegen, no Python runs per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from matchforge.params import BLUE_TEAM, MS_PER_MINUTE, OUTCOME_DIM, RED_TEAM, TEAM_SIZE

__all__ = [
    "col_of", "int_from_text", "long_from_text", "ceil_minutes", "split_piece", "round_time",
    "position_in", "map_lookup_by_position", "win_loss", "encode_outcome",
    "label_word", "offset_ms_since_day", "day_key", "micros_since_epoch",
]


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_from_text(c) -> Column:
    """Cast text such as ``'599999.0'`` to int, truncating; bad text becomes null.

    A plain ``cast('int')`` raises on ``'599999.0'`` under ANSI mode.
    """
    return col_of(c).try_cast("double").try_cast("int")


def long_from_text(c) -> Column:
    """Cast id text to a 64-bit integer: plain digits exactly, float-looking
    text (``'12.0'``) truncated; bad text becomes null."""
    x = col_of(c)
    return F.coalesce(x.try_cast("long"), x.try_cast("double").try_cast("long"))


def ceil_minutes(ms) -> Column:
    """Milliseconds to whole minutes, rounded up, as int."""
    return F.ceil(col_of(ms) / F.lit(MS_PER_MINUTE)).cast("int")


def split_piece(c, sep: str, index: int = -2) -> Column:
    """Piece ``index`` (1-based, negative from the end) of ``c`` split on the
    literal ``sep``; null when there are too few pieces."""
    pattern = "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)
    return F.try_element_at(F.split(col_of(c), pattern), F.lit(index))


def round_time(c) -> Column:
    return F.round(col_of(c)).cast("long")


def position_in(array_col, value) -> Column:
    """1-based position of ``value`` in the array; 0 when absent."""
    return F.array_position(col_of(array_col), col_of(value)).cast("int")


def map_lookup_by_position(map_col, pos) -> Column:
    """Look a map keyed by stringified positions up by an int position."""
    return F.try_element_at(col_of(map_col), col_of(pos).cast("string"))


def win_loss(winning_team, pos) -> Column:
    """'win' if the player's side (the first or the last five positions) is the
    winning team's, else 'loss', unknown team codes included; null for a null
    team."""
    team = col_of(winning_team)
    own = F.when(col_of(pos) <= TEAM_SIZE, BLUE_TEAM).otherwise(RED_TEAM)
    return F.when(team.isNotNull(), F.when(team == own, "win").otherwise("loss"))


def encode_outcome(outcome) -> Column:
    """Id of the outcome's word in the outcome dimension; null for any other."""
    codes = F.create_map(*[F.lit(x) for i, word in OUTCOME_DIM for x in (word, i)])
    return F.try_element_at(codes, col_of(outcome)).cast("int")


def label_word(prediction) -> Column:
    return F.when(col_of(prediction) == 1, "win").otherwise("loss")


def offset_ms_since_day(ts) -> Column:
    """Wall-clock milliseconds since midnight of a timestamp_ntz, truncated.

    Built from the clock fields, which do not depend on the session time zone
    (a difference of casted timestamps would shift by an hour on a
    daylight-saving day in a non-UTC session)."""
    t = col_of(ts)
    millis = F.floor(F.extract(F.lit("SECOND"), t) * 1000).cast("long")
    return (F.hour(t).cast("long") * 3600000 + F.minute(t).cast("long") * 60000 + millis)


def micros_since_epoch(ts) -> Column:
    """Exact microseconds since 1970-01-01 of a timestamp_ntz, from its date
    and clock fields (time-zone free)."""
    t = col_of(ts)
    days = F.datediff(t.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    micros = (F.extract(F.lit("SECOND"), t) * 1000000).cast("long")
    return (days * 86400000000 + F.hour(t).cast("long") * 3600000000
            + F.minute(t).cast("long") * 60000000 + micros)


def day_key(ts) -> Column:
    """'yyyy-MM-dd' of a timestamp_ntz (time-zone free)."""
    return col_of(ts).cast("date").cast("string")
