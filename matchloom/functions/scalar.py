"""Derived fields, recodes, truncation, rounding and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

REASON_LIMIT = 500
PREVIEW_LIMIT = 60


def winner_of(team1: Column, team2: Column, score1: Column, score2: Column) -> Column:
    """Team with the higher score; a tie goes to ``team2``, a missing score to null."""
    decided = score1.isNotNull() & score2.isNotNull()
    return F.when(decided & (score1 > score2), team1).when(decided, team2)


def loser_of(winner: Column, team1: Column, team2: Column) -> Column:
    """The other team, or null when the winner is neither of the two."""
    return F.when(winner == team1, team2).when(winner == team2, team1)


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def clip(text: Column, limit: int = REASON_LIMIT) -> Column:
    return F.substring(text, 1, limit)


def preview(text: Column, limit: int = PREVIEW_LIMIT) -> Column:
    """Short form for listings: empty for null, an ellipsis where text was cut."""
    shown = F.coalesce(text, F.lit(""))
    return F.when(F.length(shown) > limit, F.concat(F.substring(shown, 1, limit), F.lit("..."))).otherwise(shown)


def exact_mean(value: Column, places: int = 2, *, scale: int) -> Column:
    """Mean rounded half away from zero, as an aggregate.

    ``scale`` is the number of decimal places the values have; the caller knows
    it, and further places would be rounded off. Summing decimals is exact, so the
    result does not depend on the order in which partial sums are merged.
    """
    total = F.sum(value.cast(f"decimal(28,{scale})"))
    count = F.count(value)
    return F.round(total / F.when(count > 0, count), places).cast("double")


def surrogate_key(*parts: Column) -> Column:
    """Deterministic text key over a natural key, nulls included."""
    return F.md5(F.concat_ws("-", *[F.coalesce(p.cast("string"), F.lit("<null>")) for p in parts]))


def recode_up(status: Column) -> Column:
    """Older status names to the current set."""
    return F.when(status == "pending", "discovered").otherwise(status)


def recode_down(status: Column) -> Column:
    """Current status names to the older set."""
    return (F.when(status.isin("dead", "partial"), "failed")
             .when(status == "discovered", "pending").otherwise(status))


def fixed(value: Column, places: int = 2) -> Column:
    return F.format_string(f"%.{places}f", value)


def all_present(*columns: Column) -> Column:
    """True when every required field has a value."""
    present = columns[0].isNotNull()
    for column in columns[1:]:
        present = present & column.isNotNull()
    return present
