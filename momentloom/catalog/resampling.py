"""Train/test splits and fold schemes."""

from __future__ import annotations

from pyspark.sql import functions as F

from momentloom.catalog.common import significant
from momentloom.catalog.ordering import BY_DATE, counted_orders
from momentloom.catalog.registry import analysis
from momentloom.catalog.sqltext import hash32, rs
from momentloom.operators import splits
from momentloom.sources.tables import load

FOLDS = 8


def _summary(df, *by):
    return significant(df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min("row_id").alias("first_row"), F.max("row_id").alias("last_row"), F.sum("o_totalprice").alias("total")))


SUMMARY = f"count(*) as n, min(row_id)::bigint as first_row, max(row_id)::bigint as last_row, {rs('sum(o_totalprice)')} as total"


@analysis("R1", f"select o_orderkey, case when {hash32('o_orderkey', 444)} < 2147483648 then 'train' else 'test' end as split from orders")
def half_split(spark, folder):
    return splits.train_test_split(load(spark, folder, "orders").select("o_orderkey"), "o_orderkey", 0.5, 444)


@analysis(
    "R1 O5",
    f"""select o_orderkey, case when row_number() over (order by {hash32('o_orderkey', 1515)}, o_orderkey) <= (select floor(count(*)*0.7e0 + 0.5e0) from orders) then 'train' else 'test' end as split from orders""",
)
def exact_seventy_split(spark, folder):
    return splits.train_test_split(load(spark, folder, "orders").select("o_orderkey"), "o_orderkey", 0.7, 1515, exact=True)


@analysis(
    "R2",
    f"select case when o_orderdate < timestamp '2000-01-01 00:00:00' then 'train' else 'test' end as split, count(*) as n, {rs('avg(o_totalprice)')} as mean from orders group by 1",
)
def split_by_date(spark, folder):
    parts = splits.split_where(load(spark, folder, "orders"), F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    return significant(parts.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.avg("o_totalprice").alias("mean")))


@analysis(
    "R3 W3",
    f"""with s as (select ((count(*) + {FOLDS - 1}) // {FOLDS}) as size from orders)
    select (row_id // size + 1)::int as split, 'train' as role, {SUMMARY} from {BY_DATE}, s group by 1""",
)
def training_blocks(spark, folder):
    rows, n = counted_orders(spark, folder)
    return _summary(splits.train_blocks(rows, n, FOLDS), "split", "role")


@analysis(
    "R4 W4",
    f"""with s as (select ((count(*) + {FOLDS - 1}) // {FOLDS}) as size from orders), b as (select *, row_id // size as block from {BY_DATE}, s)
    select (block + 1)::int as split, 'train' as role, o_orderkey from b union all
    select ((block + {FOLDS - 1}) % {FOLDS} + 1)::int as split, 'val' as role, o_orderkey from b""",
)
def independent_cv_rows(spark, folder):
    rows, n = counted_orders(spark, folder)
    return splits.independent_cv(rows, n, FOLDS).select("split", "role", "o_orderkey")


@analysis(
    "R5",
    f"""with s as (select count(*) // {FOLDS} as size from orders), b as (select *, row_id // size as block from {BY_DATE}, s), i as (select unnest(range(1, {FOLDS + 1})) as split)
    select split::int as split, case when block = split % {FOLDS} then 'test' else 'train' end as role, {SUMMARY} from b, i group by 1, 2""",
)
def standard_cv_parts(spark, folder):
    rows, n = counted_orders(spark, folder)
    return _summary(splits.standard_cv(rows, n, FOLDS), "split", "role")


@analysis(
    "R5",
    f"""with s as (select count(*) // 7 as size from orders) select (case when row_id // size >= 7 then 0 when row_id // size = 0 then 7 else row_id // size end)::int as tested_in, {SUMMARY}
    from {BY_DATE}, s group by 1""",
)
def standard_cv_leftover(spark, folder):
    rows, n = counted_orders(spark, folder)
    return _summary(rows.withColumn("tested_in", splits.standard_test_block("row_id", n, 7)), "tested_in")


@analysis(
    "R6",
    f"""with s as (select count(*) as c, count(*) // 10 as small, count(*) % 10 as longer from orders)
    select (case when row_id < longer*(small+1) then row_id // (small+1) else longer + (row_id - longer*(small+1)) // small end)::int as fold, {SUMMARY} from {BY_DATE}, s group by 1""",
)
def unshuffled_folds(spark, folder):
    rows, n = counted_orders(spark, folder)
    return _summary(rows.withColumn("fold", splits.even_fold("row_id", n, 10)), "fold")


@analysis("R7", f"select o_orderkey, floor({hash32('o_orderkey', 123)}*10/4294967296e0)::int as fold from orders")
def shuffled_folds(spark, folder):
    return load(spark, folder, "orders").select("o_orderkey", splits.hashed_fold("o_orderkey", 10, 123).alias("fold"))


@analysis(
    "R7 O5",
    f"""with r as (select o_orderkey, row_number() over (order by {hash32('o_orderkey', 123)}, o_orderkey) - 1 as i from orders), s as (select count(*) // 7 as small, count(*) % 7 as longer from orders)
    select o_orderkey, (case when i < longer*(small+1) then i // (small+1) else longer + (i - longer*(small+1)) // small end)::int as fold from r, s""",
)
def equal_shuffled_folds(spark, folder):
    return splits.shuffled_fold(load(spark, folder, "orders").select("o_orderkey"), "o_orderkey", 7, 123)
