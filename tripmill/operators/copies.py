"""A multiset as distinct rows with a count, and back.

Grouping by every column folds identical rows on the map side first, so however many
copies a row has, each map task sends at most one of them through the shuffle. A window
over the same key would send them all to one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

LIGHT = 256
BLOCK = 10_000


def fold_copies(rows: DataFrame, copies: str = "copies") -> DataFrame:
    """Distinct rows (nulls equal) with the number of copies of each."""
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias(copies))


def unfold_copies(
    folded: DataFrame,
    copies: str = "copies",
    number: str | None = None,
    light: int = LIGHT,
    block: int = BLOCK,
) -> DataFrame:
    """Every row repeated ``copies`` times, none for 0; ``number`` names a 1-based counter.

    Up to ``light`` copies are produced where the row is. A row with more is cut into
    blocks which are spread over all shuffle partitions, so no task emits a hot row alone.
    """
    counter = number or "_number"
    columns = [c for c in folded.columns if c != copies]
    few = folded.where(F.col(copies).between(1, light)).select(
        *columns, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(copies))).alias(counter)
    )
    blocks = folded.where(F.col(copies) > light).select(
        *columns,
        copies,
        F.explode(F.expr(f"sequence(0L, ({copies} - 1) div {block})")).alias("_block"),
    )
    # An explicit partition number keeps AQE from merging the few, heavy block rows.
    partitions = int(folded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = blocks.repartition(partitions, "_block", *columns).select(
        *columns,
        F.explode(
            F.expr(f"sequence(_block * {block} + 1, least({copies}, (_block + 1) * {block}))")
        ).alias(counter),
    )
    rows = few.unionByName(many)
    return rows if number else rows.drop(counter)
