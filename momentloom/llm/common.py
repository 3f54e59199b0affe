"""What the operators share: reading tables, cutting lineage, the fold of held-out documents."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Size of an Arrow batch. Texts can be long; this much of them fits beside a model in a Python worker, and a batch
#: has one row at least.
BATCH_BYTES = "1m"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table, read with batches small enough for long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it.

    Where the setting is missing, a local session takes a folder beside its warehouse. A cluster
    without the setting is an error, since its executors share no local folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith(("local[", "local")) or "cluster" in spark.sparkContext.master:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_checkpoints")


def kept(df: DataFrame) -> DataFrame:
    """The same rows on reliable storage, with the lineage cut: a lost executor costs only its own tasks."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``kept`` for many narrow rows: as columns, which take a fraction of the room where values of a row repeat in the next."""
    path = os.path.join(shared_folder(df.sparkSession), f"stored-{uuid.uuid4()}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def splittable(df: DataFrame) -> DataFrame:
    """``kept`` for the small side of a join on the key that it was grouped by.

    Straight from the aggregate, the join would take over its partitioning, and adaptive execution could not split
    the rows of a hot key on the other side. Read from storage, both sides are dealt anew, and it can.
    """
    return kept(df)


def held_out(doc_id: str | Column) -> Column:
    """True for the quarter of documents that no model may learn from; a null id is not held out."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sampled(df: DataFrame, by: list[str], bound: int, key: str) -> DataFrame:
    """About ``bound`` rows of each group at most, chosen by a hash of ``key``: the same rows on every run.

    The counts come from one narrow scan. A group within the bound stays whole; null keys are left out.
    Groups are few (languages, labels): their shares become a literal condition.
    """
    counts = df.groupBy(*by).agg(F.count("*").alias("n")).collect()
    unit = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    share = F.lit(0.0)
    for row in counts:
        same = F.lit(True)
        for name in by:
            same = same & F.col(name).eqNullSafe(F.lit(row[name]))
        share = F.when(same, F.lit(min(1.0, bound / row["n"]))).otherwise(share)
    return df.where(F.col(key).isNotNull() & (unit < share))
