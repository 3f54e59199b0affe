"""Ordered operations: row positions, running values, neighbours, batches.

A window without a partition, or over a group that holds a large part of the table, is one task.
Here the rows are range-partitioned by group and order instead, ties told apart by a hash of the
row, and a checkpoint fixes the placement. Windows run within each part of a group; what a part
needs from the parts before it is one carried row. Only groups that lie in several parts have
one, at most two for each partition, so the carried rows are broadcast. ``following`` counts the
groups and spreads only the large ones.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from momentloom.session import ensure_checkpoint_dir

POSITION_BITS = 33
#: Rows of a group that one task may sort; groups with more are spread over partitions.
WHOLE_GROUP = 100_000


def row_index(df: DataFrame, keys: Sequence[str], name: str = "row_id") -> tuple[DataFrame, int]:
    """Number the rows 0..n-1 in the order of ``keys``, which together must be unique; also n.

    One range shuffle; ties in the first key are split by the next. The checkpoint fixes which
    row is in which partition, so that the counts and the numbers agree even when an executor is
    lost in between. The offsets are one row per partition.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys).checkpoint(eager=True)
    marked = placed.select("*", F.monotonically_increasing_id().alias("_place"))
    part = F.shiftright(F.col("_place"), POSITION_BITS)
    counts = marked.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")).collect()
    offsets, seen = [], 0
    for row in sorted(counts, key=lambda r: r["_part"]):
        offsets.append((row["_part"], seen))
        seen += row["_n"]
    small = F.broadcast(spark.createDataFrame(offsets, "_part bigint, _offset bigint"))
    position = F.col("_place").bitwiseAND(F.lit(2**POSITION_BITS - 1))
    numbered = marked.withColumn("_part", part).join(small, "_part", "left")
    return numbered.select(*df.columns, (F.col("_offset") + position).alias(name)), seen


def with_row_index(df: DataFrame, keys: Sequence[str], name: str = "row_id") -> DataFrame:
    """The rows of ``row_index`` alone."""
    return row_index(df, keys, name)[0]


@dataclass(frozen=True)
class Parts:
    """Rows placed in the order of group and ``order``; ``_part`` is the place, ``_tie`` splits ties."""

    rows: DataFrame
    by: str
    order: str

    def window(self):
        return Window.partitionBy("_part", self.by).orderBy(self.order, "_tie")

    def carried(self, values: Mapping[str, tuple[Column, Column, str]]) -> DataFrame:
        """The rows with values from the other parts of their group, null where there are none.

        Each value has an aggregate of a part, an aggregate over the column ``_summary`` of parts,
        and the parts meant: ``before``, ``next`` or ``all``.
        """
        parts = self.rows.groupBy("_part", self.by).agg(*[v[0].alias(f"_summary_{name}") for name, v in values.items()])
        order = Window.partitionBy(self.by).orderBy("_part")
        frames = {
            "before": order.rowsBetween(Window.unboundedPreceding, -1),
            "next": order.rowsBetween(1, 1),
            "all": Window.partitionBy(self.by),
        }
        made = [v[1](F.col(f"_summary_{name}")).over(frames[v[2]]).alias(name) for name, v in values.items()]
        several = parts.select("_part", F.col(self.by).alias("_group"), F.count(F.lit(1)).over(frames["all"]).alias("_parts"), *made).where("_parts > 1")
        small = F.broadcast(several.drop("_parts").withColumnRenamed("_part", "_at"))
        same = (F.col("_part") == F.col("_at")) & F.col(self.by).eqNullSafe(F.col("_group"))
        return self.rows.join(small, same, "left").drop("_at", "_group")


def _told_apart(df: DataFrame) -> DataFrame:
    """The rows with ``_tie``, a hash of the row."""
    told = [c for c, kind in df.dtypes if "map<" not in kind]
    return df.withColumn("_tie", F.xxhash64(*told))


def place(df: DataFrame, by: str, order: str) -> Parts:
    """Spread the rows over partitions in the order of ``by`` and ``order``, null groups first.

    Rows that agree in both are ordered by a hash of the row, so the result does not depend on the
    input's order, and a group or a tied value of any size spreads over as many partitions as it needs.
    """
    ensure_checkpoint_dir(df.sparkSession)
    keys = [by, order, "_tie"]
    placed = _told_apart(df).repartitionByRange(*keys).sortWithinPartitions(*keys).checkpoint(eager=True)
    return Parts(placed.withColumn("_part", F.spark_partition_id()), by, order)


def _running(df: DataFrame, by: str, order: str, value: Column, local, combine, join, name: str, include: bool) -> DataFrame:
    """A running value over each group: within the part, joined with what earlier parts carry."""
    parts = place(df, by, order)
    frame = parts.window().rowsBetween(Window.unboundedPreceding, 0 if include else -1)
    rows = parts.carried({"_carry": (local(value), combine, "before")})
    return rows.select(*df.columns, join(local(value).over(frame), F.col("_carry")).alias(name))


def _sum_of(a: Column, b: Column) -> Column:
    """The sum of two values of which either may be missing."""
    return F.when(a.isNull() & b.isNull(), None).otherwise(F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))


def running_total(df: DataFrame, by: str, order: str, value: str, name: str = "running_total") -> DataFrame:
    """Sum of ``value`` from the first row of the group to this one."""
    return _running(df, by, order, F.col(value), F.sum, F.sum, _sum_of, name, True)


def running_max(df: DataFrame, by: str, order: str, value: str, name: str = "running_max", include: bool = True) -> DataFrame:
    """Largest ``value`` so far, this row included or not."""
    return _running(df, by, order, F.col(value), F.max, F.max, F.greatest, name, include)


def step_number(df: DataFrame, by: str, order: str, name: str = "step") -> DataFrame:
    """Number the rows of each group from 1."""
    return _running(df, by, order, F.lit(1), F.count, F.sum, _sum_of, name, True)


def following(df: DataFrame, by: str, order: str, cols: Sequence[str], prefix: str = "next_") -> DataFrame:
    """The next row's values of ``cols``, null on the last row of a group.

    Groups are counted first. One of up to ``WHOLE_GROUP`` rows is sorted by one task, which takes one shuffle for all of
    them and leaves them dealt by group; only larger ones are spread by ``place``.
    """
    ensure_checkpoint_dir(df.sparkSession)
    packed = F.struct(*[F.col(c) for c in cols])
    sizes = df.groupBy(by).agg(F.count(F.lit(1)).alias("_rows"))
    large = sizes.where(F.col("_rows") > WHOLE_GROUP).select(F.col(by).alias("_group")).checkpoint(eager=True)
    if large.isEmpty():
        rows = _following_whole(df, by, order, packed)
    else:
        same = F.col(by).eqNullSafe(F.col("_group"))
        small = _following_whole(df.join(F.broadcast(large), same, "left_anti"), by, order, packed)
        rows = small.unionByName(_following_spread(df.join(F.broadcast(large), same, "left_semi"), by, order, packed))
    return rows.select(*df.columns, *[F.col("_next")[c].alias(f"{prefix}{c}") for c in cols])


def _following_whole(df: DataFrame, by: str, order: str, packed: Column) -> DataFrame:
    """``_next`` where each group fits one task."""
    return _told_apart(df).select(*df.columns, F.lead(packed).over(Window.partitionBy(by).orderBy(order, "_tie")).alias("_next"))


def _following_spread(df: DataFrame, by: str, order: str, packed: Column) -> DataFrame:
    """``_next`` where a group lies in several parts."""
    parts = place(df, by, order)
    first = F.min_by(packed, F.struct(order, "_tie"))
    rows = parts.carried({"_carry": (first, F.first, "next")})
    # The part's last row alone takes the carried one; a row before it has its own next row.
    return rows.select(*df.columns, F.coalesce(F.lead(packed).over(parts.window()), "_carry").alias("_next"))


def running_best(df: DataFrame, by: str, step: str, value: str, start: float = 10.0) -> DataFrame:
    """The steps that set a new best: strictly above every earlier value and above ``start``."""
    seen = running_max(df, by, step, value, "_before", include=False)
    bar = F.greatest(F.coalesce(F.col("_before").cast("double"), F.lit(float(start))), F.lit(float(start)))
    return seen.where(F.col(value) > bar).select(by, step, F.col(value).alias("best"))


def final_best(df: DataFrame, by: str, step: str, value: str, start: float = 10.0) -> DataFrame:
    """The last of the running bests: the largest value above ``start``, the earliest on ties.

    A plain grouped aggregate, combined before the shuffle; no window is needed for the end state.
    """
    pair = F.struct(F.col(value).alias("best"), F.col(step).alias("last_improvement"))
    return (
        df.where(F.col(value) > F.lit(float(start)))
        .groupBy(by)
        .agg(F.min_by(pair, F.struct(-F.col(value), F.col(step))).alias("_b"))
        .select(by, "_b.*")
    )


def every_kth(df: DataFrame, step: str, k: int, remainder: int = 0) -> DataFrame:
    """The steps whose number leaves ``remainder`` when divided by ``k``."""
    return df.where(F.pmod(F.col(step), F.lit(k)) == remainder)


def batch_number(index: Column | str, size: int) -> Column:
    """Mini-batch of a zero-based index; the last batch may be shorter."""
    index = F.col(index) if isinstance(index, str) else index
    return F.floor(index / F.lit(size)).cast("bigint")


def row_range(indexed: DataFrame, low: int, high: int, index: str = "row_id") -> DataFrame:
    """Rows number ``low`` to ``high``, counted from 1 and both included."""
    return indexed.where((F.col(index) >= low - 1) & (F.col(index) < high))


def indexed_series(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """A column's value against its position from 1: the data behind a line or stem plot."""
    numbered = with_row_index(df.select(*dict.fromkeys([*keys, col])), keys)
    return numbered.select((F.col("row_id") + 1).alias("position"), col)


def cumulative_ratio(df: DataFrame, value: str, order: str, by: str | None = None) -> DataFrame:
    """Running share of the group's total, or of the table's without ``by``. Null groups are a group."""
    parts = place(df if by else df.withColumn("_all", F.lit(0)), by or "_all", order)
    frame = parts.window().rowsBetween(Window.unboundedPreceding, 0)
    rows = parts.carried({"_carry": (F.sum(value), F.sum, "before"), "_whole": (F.sum(value), F.sum, "all")})
    own = F.sum(value).over(Window.partitionBy("_part", parts.by))
    ratio = F.try_divide(_sum_of(F.sum(value).over(frame), F.col("_carry")), F.coalesce("_whole", own))
    return rows.select(*df.columns, ratio.alias("cumulative_ratio"))


def head(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in the order of ``keys``, sorted.

    A top-n per task and one merge of n rows per task. ``long_head`` is for an n too large for a task.
    """
    return df.orderBy(*keys).limit(n)


def long_head(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in the order of unique ``keys``, in no order, spread over tasks."""
    return row_range(with_row_index(df, keys, "_place"), 1, n, "_place").drop("_place")


def top_k(df: DataFrame, score: str, k: int, tie: str) -> DataFrame:
    """The ``k`` rows with the highest score; ``tie`` decides between equals.

    One task merges k rows of every other; for a k too large for that, ``long_head`` on the negated score.
    """
    return df.orderBy(F.col(score).desc(), tie).limit(k)


def best(df: DataFrame, metric: str, order: str, smallest: bool = True) -> DataFrame:
    """The best candidate; the earliest in ``order`` on ties. One aggregate, no sort."""
    score = F.col(metric).cast("double")
    rank = F.struct(score if smallest else -score, F.col(order))
    scored = df.where(score.isNotNull() & ~F.isnan(score))
    winner = scored.agg(F.min_by(F.struct("*"), rank).alias("winner"))
    return winner.where(F.col("winner").isNotNull()).select("winner.*")
