"""Train/test splits and folds as columns. Nothing is copied; a split is a value per row.

Positions are a zero-based ``index`` column: a dense key the table already has, or the result of
``with_row_index``. From there on every fold is a projection without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from momentloom.functions.scalars import HASH_SPACE, seeded_hash
from momentloom.operators.ordered import row_index


def _check(n: int, k: int) -> None:
    if k <= 1:
        raise ValueError("the number of folds must be greater than 1")
    if n < k:
        raise ValueError(f"{n} rows cannot fill {k} folds")


def block_size(n: int, k: int) -> int:
    """Rows per contiguous block, rounded up. Too few rows may fill fewer than k blocks."""
    _check(n, k)
    size = -(-n // k)
    filled = -(-n // size)
    if filled < k:
        raise ValueError(f"{n} rows in blocks of {size} fill only {filled} of {k} folds")
    return size


def contiguous_block(index: Column | str, n: int, k: int) -> Column:
    """Block 0..k-1 of ceil(n/k) neighbouring rows; the last block may be shorter."""
    index = F.col(index) if isinstance(index, str) else index
    return F.floor(index / F.lit(block_size(n, k))).cast("int")


def even_fold(index: Column | str, n: int, k: int) -> Column:
    """Unshuffled fold 0..k-1 of neighbouring rows whose sizes differ by at most one."""
    _check(n, k)
    index = F.col(index) if isinstance(index, str) else index
    small, longer = divmod(n, k)
    edge = longer * (small + 1)
    later = F.lit(longer) + F.floor((index - edge) / F.lit(small))
    return F.when(index < edge, F.floor(index / F.lit(small + 1))).otherwise(later).cast("int")


def hashed_fold(key: Column | str, k: int, seed: int) -> Column:
    """Shuffled fold 0..k-1 by seeded hash: sizes vary a little, and no row moves."""
    return F.floor(seeded_hash(key, seed) * F.lit(k) / F.lit(float(HASH_SPACE))).cast("int")


def shuffled_fold(df: DataFrame, key: str, k: int, seed: int, name: str = "fold") -> DataFrame:
    """Shuffled folds of equal size, through the rank of the hash."""
    ranked, n = _shuffled(df, key, seed, "_rank")
    return ranked.select(*df.columns, even_fold("_rank", n, k).alias(name))


def shuffle_order(df: DataFrame, key: str, seed: int, name: str = "position") -> DataFrame:
    """Each row's place 0..n-1 in a seeded random order. Hash values spread evenly over tasks."""
    return _shuffled(df, key, seed, name)[0]


def _shuffled(df: DataFrame, key: str, seed: int, name: str) -> tuple[DataFrame, int]:
    """The rows of ``shuffle_order`` and their number."""
    hashed = df.withColumn("_hash", seeded_hash(key, seed))
    ranked, n = row_index(hashed, ["_hash", key], name)
    return ranked.drop("_hash"), n


def is_train(key: Column | str, fraction: float, seed: int) -> Column:
    """A seeded random split without a shuffle; the sizes are approximate."""
    return seeded_hash(key, seed) < F.lit(int(round(fraction * HASH_SPACE)))


def train_test_split(df: DataFrame, key: str, fraction: float, seed: int, exact: bool = False) -> DataFrame:
    """Add ``split`` = train / test. With ``exact`` the train part has round(fraction * n) rows."""
    if not exact:
        return df.withColumn("split", F.when(is_train(key, fraction, seed), "train").otherwise("test"))
    ranked, n = _shuffled(df, key, seed, "_rank")
    wanted = int(n * fraction + 0.5)
    mark = F.when(F.col("_rank") < wanted, "train").otherwise("test")
    return ranked.select(*df.columns, mark.alias("split"))


def split_at_last(indexed: DataFrame, condition: Column, index: str = "row_id") -> DataFrame:
    """Train on every row up to the last one that satisfies the condition, test on the rest.

    This equals ``split_where`` only when the rows are sorted so that the condition holds first.
    """
    last = indexed.select(F.coalesce(F.max(F.when(condition, F.col(index))), F.lit(-1))).scalar()
    return indexed.withColumn("split", F.when(F.col(index) <= last, "train").otherwise("test"))


def split_where(df: DataFrame, condition: Column) -> DataFrame:
    """Train on the rows that satisfy the condition, test on the others; no order needed."""
    return df.withColumn("split", F.when(condition, "train").otherwise("test"))


def _roles(df: DataFrame, pairs: Column) -> DataFrame:
    """One output row per (split, role) that a row takes part in."""
    return df.select("*", F.inline(pairs))


def _pair(split: Column, role: str) -> Column:
    return F.struct(split.cast("int").alias("split"), F.lit(role).alias("role"))


def train_blocks(indexed: DataFrame, n: int, k: int, index: str = "row_id") -> DataFrame:
    """Split i trains on block i alone; every row is in one split."""
    block = contiguous_block(index, n, k)
    return _roles(indexed, F.array(_pair(block + 1, "train")))


def independent_cv(indexed: DataFrame, n: int, k: int, index: str = "row_id") -> DataFrame:
    """Split i trains on block i and validates on the next block, the last on the first.

    The training sets are disjoint. Every row is in two splits, whatever k is.
    """
    block = contiguous_block(index, n, k)
    before = F.pmod(block - 1, F.lit(k))
    return _roles(indexed, F.array(_pair(block + 1, "train"), _pair(before + 1, "val")))


def standard_test_block(index: Column | str, n: int, k: int) -> Column:
    """The one split (1..k) a row is tested in, or 0 for the n mod k rows that never are.

    Blocks have n div k rows, and split i tests block i counted from 0, the last split block 0.
    """
    _check(n, k)
    index = F.col(index) if isinstance(index, str) else index
    block = F.floor(index / F.lit(n // k))
    tested = F.when(block == 0, F.lit(k)).otherwise(block)
    return F.when(block >= k, F.lit(0)).otherwise(tested).cast("int")


def leftover(n: int, k: int) -> int:
    """Rows that standard_cv never tests."""
    _check(n, k)
    return n % k


def standard_cv(indexed: DataFrame, n: int, k: int, index: str = "row_id") -> DataFrame:
    """Split i tests one block and trains on all other rows; every row is in k splits.

    A fit should rather filter on ``standard_test_block``, which copies nothing.
    """
    tested = standard_test_block(index, n, k)
    splits = F.sequence(F.lit(1), F.lit(k))
    role = lambda i: F.struct(i.alias("split"), F.when(i == tested, "test").otherwise("train").alias("role"))
    return _roles(indexed, F.transform(splits, role))


def sample_k(df: DataFrame, key: str, k: int, seed: int) -> DataFrame:
    """``k`` rows without replacement: those with the smallest hashes, in their order.

    One task merges k rows of every other; ``large_sample`` is for a k too large for that.
    """
    return df.orderBy(seeded_hash(key, seed), key).limit(k)


def large_sample(df: DataFrame, key: str, k: int, seed: int) -> DataFrame:
    """The same rows by their place in the shuffled order, spread over tasks; ``key`` must be unique."""
    return shuffle_order(df, key, seed, "_place").where(F.col("_place") < k).drop("_place")
