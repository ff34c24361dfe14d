"""Filters and predicates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchforge.functions.scalar import col_of
from matchforge.params import BASIC_ROLES, RANKED_SOLO_QUEUE

ROSTER_MODES = ("all", "online")


def roster_predicate(home: str, current: str, roles: Iterable[int] = BASIC_ROLES,
                     mode: str = "all", home_col: str = "home",
                     current_col: str = "current", role_col: str = "roleNum",
                     online_col: str = "onlineNum") -> Column:
    """Conjunctive equality + IN list; mode ``online`` adds ``onlineNum > 0``.

    Any other mode is an error (the source returned nothing silently).
    """
    if mode not in ROSTER_MODES:
        raise ValueError(f"unknown roster mode {mode!r}; expected one of {ROSTER_MODES}")
    pred = ((F.col(home_col) == home) & (F.col(current_col) == current)
            & F.col(role_col).isin(list(roles)))
    if mode == "online":
        pred = pred & (F.col(online_col) > 0)
    return pred


def before(df: DataFrame, col: str, cutoff: int) -> DataFrame:
    """Event cutoff: keep ``col < cutoff`` (strict)."""
    return df.filter(F.col(col) < cutoff)


def same_value(df: DataFrame, a: str, b: str) -> DataFrame:
    """Column-to-column predicate ``a = b``."""
    return df.filter(F.col(a) == F.col(b))


def involved(pos, killer, victim) -> Column:
    """Killer or victim is the player, and both keys are present."""
    p, k, v = col_of(pos), col_of(killer), col_of(victim)
    return k.isNotNull() & v.isNotNull() & ((k == p) | (v == p))


def ward_participant(pos, ward_type, creator, killer) -> Column:
    """Participant a ward event is credited to, with priority: the creator if
    it is the player, else the killer if it is; null when neither."""
    p, w, c, k = col_of(pos), col_of(ward_type), col_of(creator), col_of(killer)
    return (F.when(w.isNotNull() & (c == p), c)
            .when(w.isNotNull() & (k == p), k))


def drop_any_null(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.na.drop(how="any", subset=subset)


def split_rejects(df: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    """Keep rows passing ``ok``; the rest (including a null verdict) go to a
    rejects frame instead of vanishing."""
    verdict = F.coalesce(ok, F.lit(False))
    return df.filter(verdict), df.filter(~verdict)


def ranked_solo(df: DataFrame, queue_col: str = "queueId", queue: int = RANKED_SOLO_QUEUE) -> DataFrame:
    return df.filter(F.col(queue_col) == queue)


def in_region(df: DataFrame, region: str | None, region_col: str = "region") -> DataFrame:
    """Optional region filter; ``None`` keeps every region."""
    return df if region is None else df.filter(F.col(region_col) == region)
