"""Top / bottom member filters and manual orders.

One aggregate per member holds the ranking metric (over all rows or the
filtered ones), the shown metric (over the filtered ones) and the number of
filtered rows; ``orderBy(...).limit(n)`` over it runs as a per-partition top-n
and a final merge (TakeOrderedAndProject). The input is read and shuffled once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratocast.operators.measures import _m


def _metric(name: str, c: Column) -> Column:
    if name == "average":
        return F.avg(c)
    if name == "range":
        return F.max(c) - F.min(c)
    raise ValueError(f"unknown metric {name!r}")


def top_members(
    df: DataFrame,
    parameter,
    n: int,
    end: str = "top",
    value: str = "average",
    rank_by: str = "average",
    scope: str = "global",
    condition: Column | None = None,
    member: str = "city",
) -> DataFrame:
    """``(city, value)`` for the ``n`` members with the highest
    (``end="top"``) or lowest (``"bottom"``) metric; ties go to the smaller name.

    ``condition`` is the view's filter (month, country). ``scope="global"``
    ranks members before it applies, so a view can show fewer than n members;
    ``"filtered"`` ranks after it. ``rank_by`` chooses the ranking metric and
    ``value`` the shown one (the "consistent cities" view ranks by average and
    shows the range).
    """
    if scope not in ("global", "filtered"):
        raise ValueError(f"unknown scope {scope!r}")
    c = F.col(_m(parameter).mean)
    shown = F.lit(True) if condition is None else F.coalesce(condition, F.lit(False))
    if scope == "filtered":
        df, shown = df.where(shown), F.lit(True)
    per = df.groupBy(member).agg(
        _metric(rank_by, c).alias("_rank"), _metric(value, F.when(shown, c)).alias("value"), F.count_if(shown).alias("_shown")
    )
    rank = F.col("_rank").desc() if end == "top" else F.col("_rank").asc()
    chosen = per.where(F.col("_rank").isNotNull()).orderBy(rank, F.col(member).asc()).limit(n)
    order = F.col("value").desc() if value == "average" and end == "top" else F.col("value").asc()
    return chosen.where(F.col("_shown") > 0).select(member, "value").orderBy(order, F.col(member).asc())


# T4 / T5 ----------------------------------------------------------------------
def manual_order(c: Column | str, order: Sequence[str]) -> Column:
    """Position of ``c`` in a fixed list (1-based; 0 when absent)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.array_position(F.array(*[F.lit(v) for v in order]), col)
