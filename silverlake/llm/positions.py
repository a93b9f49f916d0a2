"""The place of each row in its group, with no group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silverlake.llm.base import stored


def in_order(rows: DataFrame, by: Sequence[str], mark: str) -> DataFrame:
    """``rows`` dealt out by ranges of ``by`` (nulls first), sorted and stored.

    ``mark`` grows along the whole order: the part's number above bit 33, the place in it below. Rows
    that are equal in ``by`` fall into one part; end ``by`` with a column that tells them apart.
    """
    spread = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    return stored(spread.select("*", F.monotonically_increasing_id().alias(mark)), "in-order")


def numbered(rows: DataFrame, group: str, mark: str, position: str, size: str) -> DataFrame:
    """Rows of ``in_order(rows, [group, ...], mark)`` with their place in the group and its size.

    A group's rows in one part are neighbours there, so the place is the number of the group's rows in
    earlier parts plus that in this part. Only a row for each group and part is grouped and windowed;
    the join's key is the two together, so a group of any size is spread over its parts.
    """
    part = F.shiftright(mark, 33)
    pieces = rows.groupBy(F.col(group).alias("__group"), part.alias("__part")).agg(
        F.min(mark).alias("__first"), F.count(F.lit(1)).alias("__rows")
    )
    earlier = Window.partitionBy("__group").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(
        "__group",
        "__part",
        (F.coalesce(F.sum("__rows").over(earlier), F.lit(0)) - F.col("__first")).alias("__shift"),
        F.sum("__rows").over(Window.partitionBy("__group")).alias(size),
    )
    pieces = stored(pieces, "pieces")
    same = F.col(group).eqNullSafe(F.col("__group")) & (part == F.col("__part"))
    return rows.join(pieces, same).select(
        *[c for c in rows.columns if c != mark], (F.col(mark) + F.col("__shift")).alias(position), size
    )
