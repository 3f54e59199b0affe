"""Tables and small rules that several analyses share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from momentloom.functions.scalars import round_digits, round_significant
from momentloom.sources.tables import load

# A fixed classifier, so that every metric has something to measure: the return flag read off the
# discount alone.
RULE_SQL = "case when l_discount > 0.05e0 then 'R' when l_quantity > 25e0 then 'N' else 'A' end"


def rule_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with the truth ``y`` and the rule's answer ``pred``."""
    rule = F.when(F.col("l_discount") > 0.05, "R").when(F.col("l_quantity") > 25.0, "N").otherwise("A")
    return load(spark, folder, "lineitem").select("*", F.col("l_returnflag").alias("y"), rule.alias("pred"))


# A fixed score of "R" in (0, 1).
SCORE_SQL = "(1e0/(1e0+exp(-(l_discount*20e0 - l_tax*15e0 - 0.4e0))))"


def score_expression():
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("l_discount") * 20.0 - F.col("l_tax") * 15.0 - 0.4)))


# Fixed class probabilities of the three return flags: raw scores first.
LOGITS_SQL = "[l_discount*10e0, l_tax*10e0, l_quantity/50e0]"
FLAGS = ["A", "N", "R"]


def logits_expression():
    return F.array(F.col("l_discount") * 10.0, F.col("l_tax") * 10.0, F.col("l_quantity") / 50.0)


def text_measures(spark: SparkSession, folder: str) -> DataFrame:
    """Counts over the whole text of each document."""

    def occurrences(character: str):
        return F.length("text") - F.length(F.replace("text", F.lit(character), F.lit("")))

    return load(spark, folder, "documents").select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        occurrences(" ").cast("double").alias("n_spaces"),
        occurrences("\n").cast("double").alias("n_lines"),
        occurrences("e").cast("double").alias("n_e"),
        (occurrences(".") + occurrences(",")).cast("double").alias("n_marks"),
    )


def _counted(characters: str) -> str:
    return f"(length(text) - length(translate(text, {characters}, '')))::double"


TEXT_SQL = f"""(select doc_id, n_chars::double as n_chars, {_counted("' '")} as n_spaces,
  {_counted("chr(10)")} as n_lines, {_counted("'e'")} as n_e, {_counted("'.,'")} as n_marks from documents)"""


def rounded(df: DataFrame, digits: int = 6, **others: int) -> DataFrame:
    """Round every double column; a keyword names a column with its own number of decimals."""
    return df.select(*[round_digits(c, others.get(c, digits)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def significant(df: DataFrame, digits: int = 8) -> DataFrame:
    """Round every double column to significant digits."""
    return df.select(*[round_significant(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
