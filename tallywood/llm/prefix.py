"""Running totals over groups of any size."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hash_piece(hashed: Column, bits: int) -> Column:
    """The top ``bits`` (1 to 30) of a 64-bit hash: ordered pieces of its range."""
    return F.shiftrightunsigned(hashed, 64 - bits).cast("int")


def piece_bits(rows: int, rows_per_piece: int) -> int:
    return min(30, max(1, math.ceil(math.log2(max(1, rows) / rows_per_piece))))


def running_totals(
    rows: DataFrame, group: Sequence[str], piece: str, order: Sequence[str], amounts: dict[str, str]
) -> DataFrame:
    """``rows`` plus ``amounts`` (new column: summed column), totals of the rows before.

    A row's total covers the rows of its ``group`` that come before it in the
    order ``piece, *order``.  Only one piece of a group is ever sorted in one
    task; pieces meet as one total each, so a group may hold any share of the
    rows as long as its pieces stay small.  Group and piece are never NULL.
    """
    keys = [*group, piece]
    totals = rows.groupBy(*keys).agg(*[F.sum(a).alias(f"all_{n}") for n, a in amounts.items()])
    pieces_before = Window.partitionBy(*group).orderBy(piece).rowsBetween(
        Window.unboundedPreceding, -1
    )
    rows_before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = totals.select(
        *keys,
        *[
            F.coalesce(F.sum(f"all_{n}").over(pieces_before), F.lit(0)).alias(f"start_{n}")
            for n in amounts
        ],
    )
    return (
        rows.join(starts, keys)
        .withColumns(
            {
                n: F.col(f"start_{n}") + F.coalesce(F.sum(a).over(rows_before), F.lit(0))
                for n, a in amounts.items()
            }
        )
        .drop(*[f"start_{n}" for n in amounts])
    )
