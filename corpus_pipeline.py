"""A pipeline over the documents: language, near duplicates, benchmark passages, secrets, tokens.

Every stage takes ``(spark, docs, folder)`` and works on all rows that the one before it kept. ``run`` writes each
result to the shared folder and reads it again. All stages but the last return the columns of ``docs``, extra ones
included; their own columns take names that the table does not use. Null ids and texts pass as the stages say; empty
tables give empty results.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from momentloom.llm import bpe, langid, minhash, queries, secrets, spaced
from momentloom.llm.common import held_out, shared_folder, table


def _free(docs: DataFrame, name: str) -> str:
    """The name, lengthened until no column of the table has it."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in a known language. Null texts, texts without a letter and texts like no language go."""
    learned = docs.where(~held_out("doc_id"))
    model, counts = langid.fit(learned, "text", "lang", "doc_id"), langid.fit_counts(learned, "text", "lang", "doc_id")
    told, known = _free(docs, "_language"), _free(docs, "_familiar")
    found = docs.withColumn(told, langid.predict(F.col("text"), model)).withColumn(known, langid.familiar(F.col("text"), counts))
    return found.where((F.col(told)["lang"] != langid.UNKNOWN) & F.col(known)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each class of near duplicates: that of the least id. Rows with a null id stay."""
    gone = minhash.near_texts(docs, "doc_id", "text").where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that overlap no benchmark item. A row is told by id and text, so null ids are judged too."""
    found = spaced.overlaps(docs, "doc_id", "text", table(spark, folder, "benchmark"), "item_id", "text")
    key = _free(docs, "_key")
    marked = docs.withColumn(key, spaced.document_key("doc_id", "text"))
    return marked.join(found.select(F.col("doc_key").alias(key)).distinct(), key, "left_anti").select(*docs.columns)


def secret_spans(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, with each secret replaced by a mark, and ``n_chars`` counted anew where there was one."""
    model = secrets.fit(docs, "text", "doc_id")
    text = F.coalesce("text", F.lit(""))
    base, spans = _free(docs, "_base"), _free(docs, "_spans")
    found = docs.withColumn(base, secrets.base_spans(text))
    found = found.withColumn(spans, secrets.spans(text, F.col(base), model))
    found = found.withColumn("text", secrets.redact(F.col("text"), F.col(spans)))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        found = found.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return found.select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The token ids of every text and the digest of the text decoded from them; a null text counts as empty."""
    found = docs.select("doc_id", bpe.encode(F.coalesce("text", F.lit("")), queries.TOKENIZER).alias("ids"))
    decoded = F.sha2(bpe.decode(F.col("ids"), queries.TOKENIZER).cast("binary"), 256)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", decoded.alias("decoded_sha256"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secret_spans),
    ("tokens", tokens),
]

# Three of the stages rest on models or hashes that SQL cannot express; tests/llm compares each with a brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """The stages one after another on ``documents``; the results between them are the caller's to remove."""
    docs = table(spark, folder, "documents")
    place = f"{shared_folder(spark)}/pipeline-{uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        path = f"{place}/{i}-{name}"
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
