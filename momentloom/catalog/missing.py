"""The same operators on rows with nulls: documents beside their labels, which most of them lack."""

from __future__ import annotations

from pyspark.sql import functions as F

from momentloom.catalog.common import rounded
from momentloom.catalog.registry import analysis
from momentloom.catalog.sqltext import rd
from momentloom.operators import metrics, ordered, profile
from momentloom.plans.screening import screen_univariate_star
from momentloom.sources.tables import load

LABELLED = "(select doc_id, n_chars, lang, quality, toxic, (lang = 'en')::int as y from documents left join labels using (doc_id))"


def labelled(spark, folder):
    docs = load(spark, folder, "documents").select("doc_id", "n_chars", "lang", (F.col("lang") == "en").cast("int").alias("y"))
    return docs.join(load(spark, folder, "labels"), "doc_id", "left")


@analysis(
    "M6 M7 M8 M10",
    f"""select lang, count(quality) as n_scored, count(*) - count(quality) as n_not_scored, {rd('avg((quality = y)::int)')} as accuracy,
    {rd('avg((quality <> y)::int)')} as misclassification from {LABELLED} group by 1""",
)
def scores_with_missing_predictions(spark, folder):
    missing = metrics.not_scored("y", "quality")
    return rounded(labelled(spark, folder).groupBy("lang").agg(
        (F.count(F.lit(1)) - missing).alias("n_scored"), missing.alias("n_not_scored"), metrics.accuracy("y", "quality").alias("accuracy"),
        metrics.misclassification_rate("y", "quality").alias("misclassification"),
    ))


@analysis(
    "M9 M7",
    f"""select quality as predicted, y as truth, count(*) as n from {LABELLED} group by 1, 2
    union all select 2, 2, 0 union all select 2, 0, 0 union all select 0, 2, 0""",
)
def confusion_with_missing_predictions(spark, folder):
    """Zeros for a level that does not occur, and rows of their own for missing labels."""
    return metrics.confusion_matrix(labelled(spark, folder), "y", "quality", [0, 2])


@analysis(
    "M15 M16",
    f"""with r as (select y, avg((quality = y)::int) as r from {LABELLED} where quality is not null group by 1)
    select count(*) as n_classes, {rd('avg(r)')} as balanced_accuracy from r""",
)
def balance_with_missing_predictions(spark, folder):
    return rounded(metrics.balanced_accuracy(labelled(spark, folder), "y", "quality"))


@analysis(
    "W1",
    f"""select doc_id, quality, {rd('sum(n_chars) over (partition by quality order by doc_id) / sum(n_chars) over (partition by quality)', 8)} as cumulative_ratio from {LABELLED}""",
)
def shares_with_a_null_group(spark, folder):
    """Documents without a label are a group of their own and keep their rows."""
    rows = labelled(spark, folder).select("doc_id", "quality", F.col("n_chars").cast("double").alias("n_chars"))
    return rounded(ordered.cumulative_ratio(rows, "n_chars", "doc_id", by="quality").select("doc_id", "quality", "cumulative_ratio"), 8)


@analysis(
    "X1",
    " union all ".join(f"select '{x}' as feature, {rd(f'regr_r2(n_chars, {x})', 9)} as r2 from {LABELLED}" for x in ("y", "quality", "toxic")),
)
def screen_with_missing_features(spark, folder):
    """Every feature uses the rows where it is known, whichever table it comes from."""
    docs = load(spark, folder, "documents").select("doc_id", "n_chars", (F.col("lang") == "en").cast("int").alias("y"))
    return rounded(screen_univariate_star(docs, "doc_id", "n_chars", ["y"], load(spark, folder, "labels"), "doc_id", ["quality", "toxic"]), 9)


@analysis("A6", f"select count(*) filter (quality is null) as n_null, 0::bigint as n_nan, 0::bigint as n_infinite from {LABELLED}")
def values_without_a_bin(spark, folder):
    return profile.left_out(labelled(spark, folder), "quality")
