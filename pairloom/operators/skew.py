"""Skew-safe building blocks.

A plain ``Window.partitionBy(g)`` sends every row of a group to one task.
When one group may hold a third of all rows (one language, one label, one
repeated lead phrase), that task becomes the whole job.  The helpers here
keep such groups split:

* ``ordered_prefix`` range-partitions on (group, order), so the range
  partitioner cuts a hot group into many blocks; each block computes local
  running sums, a tiny per-block table (one row per (group, block)) turns
  them into global offsets, and a join on (group, block) adds them back.
* ``salted_join`` spreads a hot join key of a large side over ``salts``
  reducers and replicates the other side that many times.

The order passed to ``ordered_prefix`` should be total (add a unique
tie-breaker): tied rows get different positions in an arbitrary order.
"""

from __future__ import annotations

from functools import reduce

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.session import checkpoint_dir


def _cols(cols):
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def ordered_prefix(df: DataFrame, group_cols: list[str], order_cols: list,
                   values: dict[str, Column] | None = None,
                   totals: bool = True, partitions: int | None = None) -> DataFrame:
    """Running (inclusive) sums of ``values`` within each group, in order.

    ``values`` maps output name -> numeric Column; by default a 1-based
    position ``pos``.  With ``totals`` each sum's group total is added as
    ``<name>_total``.  Group columns may be NULL (matched null-safely).

    Rows are carried whole, so rows that tie in (group, order) keep one
    position each: n rows in, n rows out.
    """
    values = values or {"pos": F.lit(1)}
    names = list(values)
    tmp = df.select("*", *[values[n].cast("long").alias(f"__v_{n}") for n in names])
    keys = [F.col(g) for g in group_cols] + _cols(order_cols)
    if partitions:
        ranged = tmp.repartitionByRange(partitions, *keys)
    else:
        ranged = tmp.repartitionByRange(*keys)
    # Both branches below (local sums, block totals) must see the same block
    # of every row.  Two evaluations of a range exchange may sample different
    # bounds, and a cached copy is not guaranteed to be picked up by both
    # branches, so the block-tagged rows are written once (as Parquet in the
    # session's checkpoint folder) and both read that, each its own columns.
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/ordered/{uuid.uuid4().hex}"
    ranged = ranged.withColumn("__blk", F.spark_partition_id())
    ranged.write.parquet(path)
    ranged = spark.read.schema(ranged.schema).parquet(path)

    w_local = (Window.partitionBy(*group_cols, "__blk").orderBy(*_cols(order_cols))
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.select("*", *[F.sum(f"__v_{n}").over(w_local).alias(f"__l_{n}") for n in names])

    blocks = ranged.groupBy(*group_cols, "__blk").agg(*[F.sum(f"__v_{n}").alias(f"__b_{n}") for n in names])
    w_blk = Window.partitionBy(*group_cols).orderBy("__blk")
    offs = blocks.select(
        *[F.col(g).alias(f"__g_{i}") for i, g in enumerate(group_cols)],
        F.col("__blk").alias("__oblk"),
        *[F.coalesce(F.sum(f"__b_{n}").over(w_blk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"__o_{n}")
          for n in names],
        *([F.sum(f"__b_{n}").over(Window.partitionBy(*group_cols)).alias(f"{n}_total") for n in names] if totals else []),
    )
    cond = [F.col("__blk") == F.col("__oblk")] + [
        F.col(g).eqNullSafe(F.col(f"__g_{i}")) for i, g in enumerate(group_cols)
    ]
    joined = local.join(offs, reduce(lambda a, b: a & b, cond), "inner")
    out = joined.select(
        *df.columns,
        *[(F.col(f"__o_{n}") + F.col(f"__l_{n}")).alias(n) for n in names],
        *([F.col(f"{n}_total") for n in names] if totals else []),
    )
    return out


def salted_join(big: DataFrame, small: DataFrame, on: list[str], salt_col: str,
                how: str = "inner", salts: int = 16) -> DataFrame:
    """Equi-join where a single key of ``big`` may be very hot.

    Rows of ``big`` get salt ``pmod(xxhash64(salt_col), salts)``; ``small`` is
    replicated once per salt, so each hot key is handled by ``salts``
    reducers instead of one.
    """
    b = big.withColumn("__salt", F.pmod(F.xxhash64(F.col(salt_col)), F.lit(salts)).cast("int"))
    s = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return b.join(s, on=on + ["__salt"], how=how).drop("__salt")
