"""Row positions, running values, neighbours, batches, samples, top lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from momentloom.catalog.common import rounded, significant
from momentloom.catalog.profiles import SPIRAL_SQL
from momentloom.catalog.registry import analysis
from momentloom.catalog.sqltext import hash32, rd, rs
from momentloom.operators import ordered, profile, sequences, splits
from momentloom.plans.screening import screen_univariate
from momentloom.sources import generate
from momentloom.sources.tables import load


def counted_orders(spark, folder):
    """Orders numbered by date, then key, and how many there are."""
    return ordered.row_index(load(spark, folder, "orders").select("o_orderdate", "o_orderkey", "o_totalprice"), ["o_orderdate", "o_orderkey"])


def indexed_orders(spark, folder):
    return counted_orders(spark, folder)[0]


BY_DATE = "(select o_orderkey, o_orderdate, o_totalprice, row_number() over (order by o_orderdate, o_orderkey) - 1 as row_id from orders)"


@analysis("W9", f"select (row_id + 1)::bigint as position, o_totalprice from {BY_DATE}".replace("o_orderdate, o_orderkey) - 1", "o_orderkey) - 1"))
def price_by_position(spark, folder):
    return ordered.indexed_series(load(spark, folder, "orders"), ["o_orderkey"], "o_totalprice")


@analysis("P5 A3", f"select count(*) as n, {rd('avg(o_totalprice)', 4)} as mean, {rd('stddev_samp(o_totalprice)', 4)} as std from {BY_DATE} where row_id < 100")
def first_hundred_rows(spark, folder):
    part = ordered.row_range(indexed_orders(spark, folder), 1, 100)
    return rounded(part.agg(F.count(F.lit(1)).alias("n"), F.avg("o_totalprice").alias("mean"), F.stddev_samp("o_totalprice").alias("std")), 4)


@analysis("O1", "select o_orderkey, o_custkey, o_totalprice from orders order by o_orderkey limit 3")
def first_rows(spark, folder):
    return ordered.head(load(spark, folder, "orders"), ["o_orderkey"], 3).select("o_orderkey", "o_custkey", "o_totalprice")


@analysis(
    "O2 X1",
    f"select * from (select 'l_quantity' as feature, {rd('regr_r2(l_extendedprice, l_quantity)', 9)} as r2 from lineitem union all "
    f"select 'l_discount', {rd('regr_r2(l_extendedprice, l_discount)', 9)} from lineitem union all select 'l_tax', {rd('regr_r2(l_extendedprice, l_tax)', 9)} from lineitem) "
    "order by r2 desc, feature limit 2",
)
def two_best_features(spark, folder):
    scores = rounded(screen_univariate(load(spark, folder, "lineitem"), "l_extendedprice", ["l_quantity", "l_discount", "l_tax"]), 9)
    return ordered.top_k(scores, "r2", 2, "feature")


@analysis(
    "O3",
    f"select o_orderpriority, {rd('avg(o_totalprice)', 4)} as mean_price from orders group by 1 order by mean_price, o_orderpriority limit 1",
)
def best_candidate(spark, folder):
    means = load(spark, folder, "orders").groupBy("o_orderpriority").agg(F.avg("o_totalprice").alias("mean_price"))
    return ordered.best(rounded(means, 4), "mean_price", "o_orderpriority")


@analysis("O4", f"select o_orderkey, o_totalprice from orders order by {hash32('o_orderkey', 99)}, o_orderkey limit 50")
def sample_of_fifty(spark, folder):
    return splits.sample_k(load(spark, folder, "orders"), "o_orderkey", 50, 99).select("o_orderkey", "o_totalprice")


@analysis("O5", f"select o_orderkey, row_number() over (order by {hash32('o_orderkey', 444)}, o_orderkey) - 1 as position from orders")
def shuffled_positions(spark, folder):
    return splits.shuffle_order(load(spark, folder, "orders").select("o_orderkey"), "o_orderkey", 444)


@analysis(
    "W1",
    f"""select user_id, event_id, {rd('sum(value) over (partition by user_id order by ts) / sum(value) over (partition by user_id)', 8)} as cumulative_ratio from events""",
)
def cumulative_event_share(spark, folder):
    table = load(spark, folder, "events").select("user_id", "event_id", "ts", "value")
    return rounded(ordered.cumulative_ratio(table, "value", "ts", by="user_id").select("user_id", "event_id", "cumulative_ratio"), 8)


EPOCHS = "(select user_id, event_id, value, row_number() over (partition by user_id order by ts) as epoch from events)"


def event_epochs(spark, folder):
    """Each user's events numbered in time order, as the epochs of a training log."""
    table = load(spark, folder, "events").select("user_id", "ts", "value")
    return ordered.step_number(table, "user_id", "ts", "epoch")


@analysis(
    "W5",
    f"""select user_id, epoch, value as best from (select *, max(value) over (partition by user_id order by epoch rows between unbounded preceding and 1 preceding) as before from {EPOCHS})
    where value > greatest(coalesce(before, 10e0), 10e0)""",
)
def running_best_values(spark, folder):
    return ordered.running_best(event_epochs(spark, folder), "user_id", "epoch", "value")


@analysis(
    "W5 O3",
    f"""select user_id, any_value(value) as best, min(epoch) as last_improvement from (select *, max(value) over (partition by user_id) as top from {EPOCHS})
    where value = top and value > 10e0 group by user_id""",
)
def final_best_values(spark, folder):
    return ordered.final_best(event_epochs(spark, folder), "user_id", "epoch", "value")


@analysis(
    "W6 W5",
    f"""select user_id, epoch, {rd('best', 4)} as best from (select user_id, row_number() over (partition by user_id order by ts) as epoch,
    max(value) over (partition by user_id order by ts) as best from events) where epoch % 5 = 0""",
)
def log_every_fifth_step(spark, folder):
    """Each user's events are the epochs of a log; the best value so far is logged at every fifth."""
    table = load(spark, folder, "events").select("user_id", "ts", "value")
    best = ordered.running_max(table, "user_id", "ts", "value", "best")
    epochs = ordered.step_number(best, "user_id", "ts", "epoch").select("user_id", F.col("epoch").cast("bigint").alias("epoch"), "best")
    return rounded(ordered.every_kth(epochs, "epoch", 5), 4)


@analysis("W7", f"select (row_id // 512)::bigint as batch, count(*) as n, {rs('sum(o_totalprice)')} as total from {BY_DATE} group by 1")
def mini_batches(spark, folder):
    batch = ordered.batch_number("row_id", 512).alias("batch")
    made = indexed_orders(spark, folder).groupBy(batch)
    return significant(made.agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total")))


@analysis(
    "W2 R2",
    f"""with c as (select max(row_id) as cut from {BY_DATE} where o_orderdate < timestamp '2000-01-01 00:00:00')
    select case when row_id <= cut then 'train' else 'test' end as split, count(*) as n, min(row_id)::bigint as first_row, max(row_id)::bigint as last_row, {rs('avg(o_totalprice)')} as mean
    from {BY_DATE}, c group by 1""",
)
def split_at_last_early_row(spark, folder):
    parts = splits.split_at_last(indexed_orders(spark, folder), F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    return significant(
        parts.groupBy("split").agg(
            F.count(F.lit(1)).alias("n"), F.min("row_id").alias("first_row"), F.max("row_id").alias("last_row"), F.avg("o_totalprice").alias("mean")
        )
    )


@analysis(
    "W8 L8",
    f"""with p as {SPIRAL_SQL}, n as (select *, lead(x) over w as nx, lead(y) over w as ny from p window w as (partition by seq_id order by step))
    select seq_id, count(*) as n_points, {rd('sum(x*ny - nx*y)')} as signed_area, {rd('avg((x*ny - nx*y)/sqrt((x*x+y*y)*(nx*nx+ny*ny)))')} as mean_turn,
    {rd('sum(sqrt(pow(nx-x,2)+pow(ny-y,2)))')} as path_length from n group by seq_id""",
)
def spiral_features(spark, folder):
    return rounded(sequences.sequence_features(generate.spirals(load(spark, folder, "customer"), "c_custkey", 40)))


@analysis(
    "W8",
    """select user_id, event_id, lead(event_id) over (partition by user_id order by ts) as next_event_id, lead(event_type) over (partition by user_id order by ts) as next_event_type from events""",
)
def next_events(spark, folder):
    table = load(spark, folder, "events").select("user_id", "ts", "event_id", "event_type")
    return ordered.following(table, "user_id", "ts", ["event_id", "event_type"]).select("user_id", "event_id", "next_event_id", "next_event_type")
