"""Positions and running totals over an ordered key without a global (single-task) window.

A plain ``Window.orderBy(key)`` moves every row into one task. Here the rows are range-partitioned by
Spark, sorted inside their partition and written once; a partition is a block, its id is stored with
the row, and a recomputed stage reads the same blocks. One count or sum per block becomes an offset:

* ``dense_ids`` numbers the rows of a block where they are written and adds the rows before the block;
* ``running_totals`` range-partitions by (group, key), so a group that holds most rows lies in many
  blocks, and adds the sums of the group's earlier blocks to a window inside (group, block);
* ``block_offsets`` gives the sums before each block where the caller's rows already lie in blocks.

The tables of offsets have one row per block (and, for totals, one more per group that starts inside
a block): their windows see at most as many rows as the session has shuffle partitions. Nothing is sampled
or collected by this module, and no array grows with the rows.

Groups are compared as one struct, so a NULL group is a group like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

_KEY, _GROUP, _BLOCK, _SUPER, _AT = "_ff_key", "_ff_group", "_ff_block", "_ff_super", "_ff_at"
#: Blocks whose offsets are summed by one window task where the caller has the blocks.
SUPER_BLOCK = 1024
#: monotonically_increasing_id: the partition above this bit, the row below.
_ROW_BITS = 33


def dense_ids(df: DataFrame, order: Sequence[str | Column], name: str = "position", start: int = 1,
              blocks: int | None = None) -> DataFrame:
    """df plus ``name``: start, start + 1, .. in the order given (which should be unique; ties are in any order)."""
    ranged = df.repartitionByRange(blocks, *order) if blocks else df.repartitionByRange(*order)
    held = materialise(ranged.sortWithinPartitions(*order).withColumn(_AT, F.monotonically_increasing_id()), "positions")
    block = F.shiftright(_AT, _ROW_BITS)
    sizes = held.groupBy(block.alias(_BLOCK)).agg(F.count(F.lit(1)).alias("_ff_n"))
    before = sizes.select(_BLOCK, (F.sum("_ff_n").over(Window.orderBy(_BLOCK)) - F.col("_ff_n")).alias("_ff_before"))
    row = F.col(_AT).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (held.withColumn(_BLOCK, block).join(F.broadcast(before), _BLOCK)  # one row per written partition
            .select(*df.columns, (row + F.col("_ff_before") + F.lit(start)).alias(name)))


def running_totals(df: DataFrame, order_col: str, value_cols: Sequence[str],
                   group_cols: Sequence[str] = (), *, descending: bool = False,
                   blocks: int | None = None, prefix: str = "cum_", totals: bool = False) -> DataFrame:
    """Add ``cum_<v>`` = sum of ``v`` over rows of the same group whose key is at or
    before the current one (inclusive). The order key must be unique within a group
    (aggregate to distinct keys first). With ``totals``, also ``tot_<v>`` = the group's
    sum, taken from the block table (no extra pass over the data). ``blocks`` sets the number of range
    partitions (default: the session's)."""
    group_cols, value_cols = list(group_cols), list(value_cols)
    key = -F.col(order_col) if descending else F.col(order_col)
    base = df.withColumn(_KEY, key).withColumn(_GROUP, F.struct(F.lit(0).alias("_"), *group_cols))
    ranged = base.repartitionByRange(blocks, _GROUP, _KEY) if blocks else base.repartitionByRange(_GROUP, _KEY)
    withb = materialise(ranged.withColumn(_BLOCK, F.spark_partition_id().cast("long")), "prefix")

    part = [f"_ff_s_{v}" for v in value_cols]
    sums = withb.groupBy(_GROUP, _BLOCK).agg(*[F.sum(v).alias(p) for v, p in zip(value_cols, part)])
    joined = withb.join(_offsets(sums, value_cols, part, totals), [_GROUP, _BLOCK])

    wr = Window.partitionBy(_GROUP, _BLOCK).orderBy(_KEY).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = joined.withColumns({f"{prefix}{v}": F.col(f"_ff_o_{v}") + F.sum(v).over(wr) for v in value_cols})
    return out.drop(_KEY, _GROUP, _BLOCK, *[f"_ff_o_{v}" for v in value_cols])


def _offsets(sums: DataFrame, value_cols: list, part: list, totals: bool) -> DataFrame:
    """(group, block, _ff_o_<v>, tot_<v>): what lies before each block of a group (at most one row per range partition)."""
    whole = Window.partitionBy(_GROUP)
    before = whole.orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(_GROUP, _BLOCK, *[F.coalesce(F.sum(p).over(before), F.lit(0)).alias(f"_ff_o_{v}") for v, p in zip(value_cols, part)],
                       *([F.sum(p).over(whole).alias(f"tot_{v}") for v, p in zip(value_cols, part)] if totals else []))


def block_offsets(df: DataFrame, block: str, value: str, name: str) -> DataFrame:
    """(block, name): the sum of ``value`` over all rows of the blocks before, one row per block. Any number of blocks:
    offsets of super blocks, and of the blocks of a super block."""
    sums = df.groupBy(block).agg(F.sum(value).alias("_ff_s")).withColumn(_SUPER, F.expr(f"{block} div {SUPER_BLOCK}"))
    before = lambda w: F.coalesce(F.sum("_ff_s").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    supers = sums.groupBy(_SUPER).agg(F.sum("_ff_s").alias("_ff_s")).select(_SUPER, before(Window.orderBy(_SUPER)).alias("_ff_a"))
    inner = sums.select(_SUPER, block, before(Window.partitionBy(_SUPER).orderBy(block)).alias("_ff_b"))
    return inner.join(supers, _SUPER).select(block, (F.col("_ff_a") + F.col("_ff_b")).alias(name))
