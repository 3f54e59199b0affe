"""Every metric, measured on fixed rules over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from momentloom.catalog.arrays import DIGITS, E, dense_sql, fixed_layer, softmax_sql
from momentloom.catalog.common import FLAGS, LOGITS_SQL, RULE_SQL, SCORE_SQL, logits_expression, rounded, rule_predictions, score_expression
from momentloom.catalog.ordering import BY_DATE, indexed_orders
from momentloom.catalog.registry import analysis
from momentloom.catalog.sqltext import rd
from momentloom.functions import arrays
from momentloom.operators import metrics
from momentloom.operators.ordered import batch_number
from momentloom.sources.tables import load

RULED = f"(select *, l_returnflag as y, {RULE_SQL} as pred from lineitem)"
GUESS_SQL = "(900e0 + 0.05e0*p_partkey + 2e0*p_size)"


def _guess():
    return F.lit(900.0) + 0.05 * F.col("p_partkey") + 2.0 * F.col("p_size")


@analysis(
    "M1 M2",
    f"""select p_type, {rd(f'1e0 - sum(pow(p_retailprice - {GUESS_SQL}, 2))/(var_pop(p_retailprice)*count(*))')} as r2, {rd(f'sqrt(avg(pow(p_retailprice - {GUESS_SQL}, 2)))')} as rms,
    {rd(f'avg(pow(p_retailprice - {GUESS_SQL}, 2))')} as mse from part group by 1""",
)
def regression_metrics(spark, folder):
    y = "p_retailprice"
    made = load(spark, folder, "part").groupBy("p_type")
    return rounded(
        made.agg(
            metrics.r_squared(y, _guess()).alias("r2"), metrics.rms(y, _guess()).alias("rms"), metrics.mean_squared_error(y, _guess()).alias("mse")
        )
    )


_true_p = f"(({softmax_sql('z')})[case l_returnflag when 'A' then 1 when 'N' then 2 else 3 end])"


@analysis("M3", f"select l_linestatus, {rd(f'avg(-ln(greatest({_true_p}, 2.220446049250313e-16)))')} as cross_entropy from (select *, {LOGITS_SQL} as z from lineitem) group by 1")
def cross_entropy_of_flags(spark, folder):
    rows = load(spark, folder, "lineitem").withColumn("p", arrays.softmax(logits_expression()))
    p_true = F.element_at("p", F.array_position(F.array(*[F.lit(v) for v in FLAGS]), F.col("l_returnflag")).cast("int"))
    return rounded(rows.groupBy("l_linestatus").agg(metrics.cross_entropy(p_true).alias("cross_entropy")))


_z = ["l_discount*10e0", "l_tax*10e0", "l_quantity/50e0"]
_lse = "ln(" + " + ".join(f"exp({z})" for z in _z) + ")"


@analysis(
    "M4",
    f"select l_linestatus, {rd(f'''avg({_lse} - case l_returnflag when 'A' then {_z[0]} when 'N' then {_z[1]} else {_z[2]} end)''')} as cross_entropy from lineitem group by 1",
)
def logit_cross_entropy_of_flags(spark, folder):
    place = F.array_position(F.array(*[F.lit(v) for v in FLAGS]), F.col("l_returnflag")) - 1
    made = load(spark, folder, "lineitem").groupBy("l_linestatus")
    return rounded(made.agg(metrics.logit_cross_entropy(logits_expression(), place).alias("cross_entropy")))


@analysis(
    "M5 M8",
    f"""select l_linestatus, {rd('avg(-(y*ln(p) + (1e0-y)*ln(1e0-p)))')} as binary_cross_entropy, {rd('avg(((p > 0.5e0) = (y = 1))::int)')} as accuracy
    from (select l_linestatus, (l_returnflag = 'R')::int as y, {SCORE_SQL} as p from lineitem) group by 1""",
)
def binary_scores(spark, folder):
    rows = load(spark, folder, "lineitem").select("l_linestatus", (F.col("l_returnflag") == "R").cast("int").alias("y"), score_expression().alias("p"))
    return rounded(
        rows.groupBy("l_linestatus").agg(metrics.binary_cross_entropy("y", "p").alias("binary_cross_entropy"), metrics.threshold_accuracy("y", "p").alias("accuracy"))
    )


_hit = "(pred = 'R' and y = 'R')::int"
_tp, _fp, _fn, _tn = (f"count(*) filter (pred {a} 'R' and y {b} 'R')::double" for a, b in (("=", "="), ("=", "<>"), ("<>", "="), ("<>", "<>")))


@analysis(
    "M6 M7 M10 M11 M12 M13 M14",
    f"""select l_linestatus, count(*) as n, {rd('avg((pred = y)::int)')} as accuracy, {rd('avg((pred <> y)::int)')} as misclassification, count(*) filter (pred = 'R' and y <> 'R') as false_positives,
    {rd(f'{_tp}/({_tp}+{_fp})')} as precision, {rd(f'{_tp}/({_tp}+{_fn})')} as recall, {rd(f'2*{_tp}/(2*{_tp}+{_fp}+{_fn})')} as f1, {rd(f'{_fp}/({_fp}+{_tn})')} as fpr
    from {RULED} group by 1""",
)
def label_metrics(spark, folder):
    return rounded(rule_predictions(spark, folder).groupBy("l_linestatus").agg(*metrics.binary_report("y", "pred", "R")))


@analysis(
    "M9",
    f"""with l as (select unnest(['A','N','R']) as v), c as (select pred, y, count(*) as n from {RULED} group by 1, 2)
    select p.v as predicted, t.v as truth, coalesce(c.n, 0)::bigint as n from l p cross join l t left join c on c.pred = p.v and c.y = t.v""",
)
def flag_confusion(spark, folder):
    return metrics.confusion_matrix(rule_predictions(spark, folder), "y", "pred", FLAGS)


@analysis("M7 M9", f"select {rd('avg((pred = y)::int)')} as accuracy from {RULED}")
def accuracy_both_ways(spark, folder):
    """The accuracy from the confusion matrix, which must equal the one from the rows."""
    return rounded(metrics.accuracy_from_confusion(metrics.confusion_matrix(rule_predictions(spark, folder), "y", "pred", FLAGS)))


@analysis("A14", f"select y as class, count(*) filter (pred = y) as tp, count(*) as total, {rd('avg((pred = y)::int)')} as recall from {RULED} group by 1")
def recall_of_flags(spark, folder):
    return rounded(metrics.recall_by_class(rule_predictions(spark, folder), "y", "pred"))


@analysis("M15", f"select count(*) as n_classes, {rd('avg(r)')} as balanced_accuracy from (select y, avg((pred = y)::int) as r from {RULED} group by 1)")
def balanced_accuracy_of_flags(spark, folder):
    return rounded(metrics.balanced_accuracy(rule_predictions(spark, folder), "y", "pred"))


_status = "case when o_totalprice > 200000e0 then 'F' when o_totalprice > 100000e0 then 'O' else 'P' end"


def _batched_orders(spark, folder):
    table = load(spark, folder, "orders")
    guess = F.when(F.col("o_totalprice") > 200000.0, "F").when(F.col("o_totalprice") > 100000.0, "O").otherwise("P")
    # Order keys are dense from 0 and so serve as the row index.
    return table.select(batch_number("o_orderkey", 512).alias("batch"), F.col("o_orderstatus").alias("y"), guess.alias("pred"))


@analysis(
    "M16 W7",
    f"""select count(*) as n_batches, {rd('avg(b)')} as balanced_accuracy from (select batch, avg(r) as b from
    (select o_orderkey // 512 as batch, o_orderstatus, avg(({_status} = o_orderstatus)::int) as r from orders group by 1, 2) group by 1)""",
)
def batch_mean_balanced_accuracy(spark, folder):
    return rounded(metrics.mean_batch_balanced_accuracy(_batched_orders(spark, folder), "batch", "y", "pred"))


@analysis(
    "M17 A16",
    f"""select epoch, count(*) as n_batches, {rd('sum(loss)')} as loss, {rd('avg(acc)')} as accuracy from (select year(o_orderdate)::int as epoch, o_orderkey // 512 as batch,
    avg(pow(o_totalprice/100000e0 - 1.5e0, 2)) as loss, avg(({_status} = o_orderstatus)::int) as acc from orders group by 1, 2) group by 1""",
)
def epoch_losses(spark, folder):
    table = load(spark, folder, "orders")
    guess = F.when(F.col("o_totalprice") > 200000.0, "F").when(F.col("o_totalprice") > 100000.0, "O").otherwise("P")
    rows = table.select(
        F.year("o_orderdate").alias("epoch"),
        batch_number("o_orderkey", 512).alias("batch"),
        F.pow(F.col("o_totalprice") / 100000.0 - 1.5, F.lit(2.0)).alias("loss"),
        (guess == F.col("o_orderstatus")).alias("right"),
    )
    return rounded(metrics.epoch_summary(rows, "epoch", "batch", F.col("loss"), F.col("right")))


@analysis(
    "M18 F15",
    f"""with s as (select vec_id, label, {dense_sql('embedding', 64, 10)} as a from embeddings)
    select vec_id, (list_position(a, list_max(a)) - 1)::int as prediction, (list_position(a, list_max(a)) - 1 = label) as hit from s""",
)
def most_probable_classes(spark, folder):
    scored = load(spark, folder, "embeddings").select("vec_id", "label", arrays.softmax(fixed_layer("embedding", 64, 10)).alias("p"))
    picked = scored.select("vec_id", "label", metrics.most_probable("p", DIGITS).alias("prediction"))
    return picked.select("vec_id", "prediction", (F.col("prediction") == F.col("label")).alias("hit"))


def _member(m):
    return arrays.softmax(fixed_layer("embedding", 64, 10, shift=m))


MEMBERS = 4
_member_rows = " union all ".join(
    f"select vec_id, label, {m} as member, c, {f'exp(z)/sum(exp(z)) over (partition by vec_id)'} as p from (select vec_id, label, unnest({dense_sql('embedding', 64, 10, m)}) as z, unnest(range(10)) as c from embeddings)"
    for m in range(MEMBERS)
)


@analysis("A17", f"with r as ({_member_rows}) select vec_id, c::int as class, {rd('avg(p)')} as probability from r group by 1, 2")
def ensemble_probabilities(spark, folder):
    table = load(spark, folder, "embeddings")
    rows = table.select("vec_id", F.explode(F.array(*[_member(m) for m in range(MEMBERS)])).alias("probs"))
    mean = metrics.ensemble_mean(rows, ["vec_id"], "probs", 10)
    return rounded(mean.select("vec_id", F.posexplode("probs").alias("class", "probability")))


@analysis(
    "A15",
    f"select o_orderpriority, count(*) as n_folds, {rd('avg(m)', 3)} as mean, {rd('3*stddev_samp(m)', 3)} as three_sigma from "
    "(select o_orderpriority, o_orderstatus, avg(o_totalprice) as m from orders group by 1, 2) group by 1",
)
def interval_over_folds(spark, folder):
    means = load(spark, folder, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.avg("o_totalprice").alias("m"))
    return rounded(metrics.fold_interval(means, ["o_orderpriority"], "m"), 3)
