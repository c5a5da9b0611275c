"""Global order operators that never funnel a whole table through one task.

``Window.orderBy(...)`` without ``partitionBy`` plans ``Exchange
SinglePartition``: fine for a dimension of a few rows, fatal for an
author table of billions.  The helpers below compute the same exact numbers
distributed, by one path at every size:

1. range-partition on the order (Spark samples the bounds) into as many
   partitions as the size of the plan's inputs asks for, and sort each;
2. number the rows (or sum their weights) inside each partition as they
   stream by, and cut the lineage with one reliable checkpoint, so both uses
   below see the *same* partition assignment (bounds are sampled per
   execution);
3. per-partition totals are tiny (one row per partition): their exclusive
   running sum is each partition's offset, joined back by broadcast.

No row is shuffled again after step 1.  Ranks with ties and quantiles first
collapse equal values with a ``groupBy(value).count()`` (map-side partial
aggregation), so one value holding a third of all rows costs one row, not a
third of the data in a task.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from bibliospark.operators.joins import null_safe_join
from bibliospark.session import ensure_checkpoint_dir, ship_package, written_once

_PID = "_bs_pid"
_MID = "_bs_mid"
_LOCAL = "_bs_local"
_OFF = "_bs_off"
_W = "_bs_w"

OrderSpec = str | tuple[str, str] | Column

# Bytes of input files per range partition.
PARTITION_BYTES = 64 << 20
_UNKNOWN_BYTES = 1 << 50   # Spark's stand-in for an unknown size is larger


def range_partitions(df: DataFrame) -> int:
    """Range partitions for ``df``: its input files' size over
    ``PARTITION_BYTES``, at least one per core; where an input's size is not
    known to the planner, at least ``spark.sql.shuffle.partitions``."""
    spark = df.sparkSession
    least, size = max(2, spark.sparkContext.defaultParallelism), 0
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    for i in range(leaves.size()):
        n = int(leaves.apply(i).stats().sizeInBytes())
        if n < _UNKNOWN_BYTES:
            size += n
        else:
            least = max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return max(least, -(-size // PARTITION_BYTES))


def sort_col(spec: OrderSpec) -> Column:
    """``"c"`` (asc, nulls first as Spark), ``("c", "desc_nulls_first")`` or a Column."""
    if isinstance(spec, Column):
        return spec
    if isinstance(spec, str):
        return F.col(spec).asc_nulls_first()
    name, how = spec
    return getattr(F.col(name), how)()


def spec_name(spec: OrderSpec) -> str:
    if isinstance(spec, str):
        return spec
    if isinstance(spec, tuple):
        return spec[0]
    raise TypeError("value columns must be named, not Column expressions")


def _offsets(df: DataFrame, totals: DataFrame) -> DataFrame:
    """Exclusive running sum over partition totals (one row per partition)."""
    rows = sorted((r[_PID], r["_t"]) for r in totals.collect())
    acc, out = 0, []
    for pid, t in rows:
        out.append((pid, acc))
        acc += t
    schema = f"{_PID} int, {_OFF} bigint"
    small = df.sparkSession.createDataFrame(out, schema)
    return F.broadcast(small)  # size = number of partitions, bounded


def global_row_number(df: DataFrame, order: Sequence[OrderSpec], name: str = "row_number",
                      start: int = 1) -> DataFrame:
    """Exact ``row_number() over (order by ...)`` for a *total* order.

    The caller must make the order total (append a unique key), as for any
    reproducible row numbering."""
    cols = [sort_col(s) for s in order]
    ensure_checkpoint_dir(df.sparkSession)
    tagged = (
        df.repartitionByRange(range_partitions(df), *cols)
        .sortWithinPartitions(*cols)
        # upper 31 bits: partition index, lower 33: position within it
        .withColumn(_MID, F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    pid = F.shiftright(F.col(_MID), 33).cast("int")
    totals = tagged.groupBy(pid.alias(_PID)).agg(F.count(F.lit(1)).alias("_t"))
    local = F.col(_MID).bitwiseAND(F.lit((1 << 33) - 1))
    return (
        tagged.withColumn(_PID, pid)
        .join(_offsets(df, totals), _PID)
        .withColumn(name, (F.col(_OFF) + local + F.lit(start)).cast("bigint"))
        .drop(_PID, _MID, _OFF)
    )


def _running_sums(batches):
    """Appends the partition's id and the running sum of the last column
    before each row; streams, whatever the partition's size."""
    pid, before = TaskContext.get().partitionId(), 0
    for batch in batches:
        w = batch.column(batch.num_columns - 1).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        upto = before + np.cumsum(w)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(w), pid, np.int32)), pa.array(upto - w)],
            names=[*batch.schema.names, _PID, _LOCAL],
        )
        before = int(upto[-1]) if len(w) else before


def global_prefix_sum(df: DataFrame, order: Sequence[OrderSpec], weight, name: str = "prefix",
                      inclusive: bool = False) -> DataFrame:
    """Exact running sum of ``weight`` over a total order (exclusive by default).

    Meant for narrow tables (value, count): they pass through Arrow once."""
    cols = [sort_col(s) for s in order]
    w = weight if isinstance(weight, Column) else F.col(weight)
    ensure_checkpoint_dir(df.sparkSession)
    ship_package(df.sparkSession)
    ordered = (
        df.withColumn(_W, w.cast("bigint"))
        .repartitionByRange(range_partitions(df), *cols)
        .sortWithinPartitions(*cols)
    )
    schema = StructType([*ordered.schema.fields, StructField(_PID, IntegerType()), StructField(_LOCAL, LongType())])
    tagged = ordered.mapInArrow(_running_sums, schema).checkpoint(eager=True)
    totals = tagged.groupBy(_PID).agg(F.sum(_W).alias("_t"))
    own = F.coalesce(F.col(_W), F.lit(0)) if inclusive else F.lit(0)
    return (
        tagged.join(_offsets(df, totals), _PID)
        .withColumn(name, (F.col(_OFF) + F.col(_LOCAL) + own).cast("bigint"))
        .drop(_PID, _LOCAL, _OFF, _W)
    )


def global_rank(df: DataFrame, order: Sequence[OrderSpec], name: str = "rank", dense: bool = False) -> DataFrame:
    """Exact ``rank()`` (or ``dense_rank()``) over an unpartitioned order.

    Equal values are collapsed first (partial aggregation), ranked as a
    prefix sum of their multiplicities, and joined back null-safely."""
    keys = [spec_name(s) for s in order]
    # the input (often a join + aggregation) is read by the collapse and by the join back
    df = written_once(df, "rank-input")
    values = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_bs_n"))
    if dense:
        ranked = global_row_number(values, order, name)
    else:
        ranked = global_prefix_sum(values, order, "_bs_n", "_bs_before").withColumn(name, F.col("_bs_before") + 1)
    return null_safe_join(df, ranked.select(*keys, name), keys)


def quantiles_by_group(counts: DataFrame, probs: Sequence[float]) -> dict:
    """Per ``g`` of ``counts`` (g, v, n): its exact continuous quantiles.

    ``counts`` has one row per group and distinct value.  Only the values at
    2 x len(probs) positions of each group reach the driver."""
    pref = written_once(global_prefix_sum(counts, ["g", "v"], "n", "before"), "quantile-positions")
    groups = {r.g: (r.start, r.total) for r in
              pref.groupBy("g").agg(F.min("before").alias("start"), F.sum("n").alias("total")).collect()}
    wanted = {}
    for g, (_, total) in groups.items():
        places = {int(p * (total - 1)) for p in probs}
        wanted[g] = sorted(places | {min(x + 1, total - 1) for x in places})
    hit = F.lit(False)
    for g, places in wanted.items():
        for x in places:
            at = groups[g][0] + x
            hit = hit | ((F.col("g") == F.lit(g)) & (F.col("before") <= at) & (F.col("before") + F.col("n") > at))
    found = {}
    for r in pref.filter(hit).collect():
        for x in wanted[r.g]:
            if r.before <= groups[r.g][0] + x < r.before + r.n:
                found[r.g, x] = r.v
    out = {}
    for g, (_, total) in groups.items():
        out[g] = []
        for p in probs:
            h = p * (total - 1)
            low, high = found[g, int(h)], found[g, min(int(h) + 1, total - 1)]
            out[g].append(low + (h - int(h)) * (high - low))
    return out


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float]) -> list[float | None]:
    """Exact continuous quantiles (linear interpolation, = ``quantile_cont``
    / pandas ``describe``) of a numeric column, nulls ignored."""
    values = df.select(F.lit("x").alias("g"), F.col(col).cast("double").alias("v")).dropna()
    counts = values.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    return quantiles_by_group(counts, probs).get("x", [None for _ in probs])


def top_k(df: DataFrame, order: Sequence[OrderSpec], n: int) -> DataFrame:
    """``ORDER BY ... LIMIT n`` -- planned as TakeOrderedAndProject (bounded heap
    per partition).  Add a unique key to ``order`` for reproducible ties."""
    return df.orderBy(*[sort_col(s) for s in order]).limit(n)


def sample_n(df: DataFrame, n: int, seed: int, key: Sequence[str]) -> DataFrame:
    """Repeatable random sample of exactly ``min(n, count)`` rows: order by the
    MD5 of seed and key, take ``n`` (distributed top-k)."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))
    return (
        df.withColumn("_bs_h", h)
        .orderBy(F.col("_bs_h"), *[F.col(k) for k in key])
        .limit(n)
        .drop("_bs_h")
    )
