"""The registered queries over the corpus tables, each one operator with its production parameters."""

from __future__ import annotations

from hashlib import sha256
from uuid import uuid4

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from momentloom.llm import bpe, langid, lattice, minhash, quality, ranked, repeats, secrets, spaced, toxicity, variants, warc, wrappers
from momentloom.llm.common import held_out, shared_folder, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


NEAR_TEXTS_SQL = """with recursive d as (select doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}_]+') as w from documents),
  s as (select doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end) as g from d),
  n as (select doc_id, count(*) as n from s group by 1),
  c as (select a.doc_id as x, b.doc_id as y, count(*) as k from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
  l as (select x, y from c join n p on p.doc_id = x join n q on q.doc_id = y where k / (p.n + q.n - k)::double >= 0.8e0),
  reach as (select doc_id as node, doc_id as root from documents union select l.x, reach.root from reach join l on l.y = reach.node),
  r as (select node, min(root) as class_id from reach group by 1), m as (select x, count(*) as n from l group by 1)
  select node as doc_id, class_id, coalesce(m.n, 0)::bigint as n_links, node = class_id as kept from r left join m on m.x = node"""

NEAR_VECTORS_SQL = """with recursive v as (select vec_id, label, embedding::double[] as e from embeddings),
  l as (select a.vec_id as x, b.vec_id as y from v a join v b on a.label = b.label and a.vec_id <> b.vec_id
    where list_cosine_similarity(a.e, b.e) >= 0.98e0),
  reach as (select vec_id as node, vec_id as root from v union select l.x, reach.root from reach join l on l.y = reach.node),
  r as (select node, min(root) as root from reach group by 1), m as (select x, count(*) as n from l group by 1)
  select node as vec_id, coalesce(m.n, 0)::bigint as n_links, root as component_id, node = root as kept from r left join m on m.x = node"""

# Base32 from the hexadecimal digest: five digits of the one are four of the other.
WARC_SQL = """with p as (select page_id, coalesce(html, '') as h from pages),
  s as (select page_id, octet_length(encode(h))::bigint as n, sha1(h) as x from p),
  d as (select page_id, n, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(x, (1 + 5 * (i // 4))::int, 5))::bigint >> (15 - 5 * (i % 4))::int) & 31) + 1)::int, 1)), '') as g from s),
  m as (select g, max(page_id) as head from d group by 1)
  select page_id, n as payload_bytes, g as payload_digest, case when page_id = head then 'response' else 'revisit' end as record_type,
    case when page_id <> head then head end as refers_to from d join m using (g)"""

# The given pages have one layout: headline and paragraphs in an article, which may be cut off, and few references.
WRAPPERS_SQL = r"""with a as (select page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)(</article>|$)', 1, 's') as a from pages),
  b as (select page_id, url, list_transform(regexp_split_to_array(a, '</?(?:h1|p)>'), lambda x: trim(regexp_replace(
    replace(replace(replace(replace(replace(regexp_replace(x, '<br>', ' ', 'g').regexp_replace('</?[a-z][^>]*>', '', 'g'),
      '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', chr(39)), '&amp;', '&'), '\s+', ' ', 'g'))) as b from a),
  t as (select page_id, url, array_to_string(list_filter(b, lambda x: x <> ''), chr(10)) as text from b)
  select page_id, url, text, length(text)::bigint as n_chars from t"""

RANKED_SQL = """with d as (select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as t from documents),
  l as (select doc_id, len(t)::bigint as n, t from d where len(t) > 0),
  g as (select count(*)::bigint as n_docs, sum(n)::bigint as n_all from l),
  tf as (select doc_id, term, count(*)::bigint as tf from (select doc_id, unnest(t) as term from l) group by 1, 2),
  df as (select term, count(*)::bigint as df from tf group by 1),
  q as (select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from benchmark),
  s as (select item_id, tf.doc_id, sum(floor(1000 * ln((2 * n_docs + 2)::double / (2 * df + 1)::double))::bigint
      * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_all))))::bigint as score
    from q join df using (term) join tf using (term) join l on l.doc_id = tf.doc_id cross join g group by 1, 2),
  r as (select item_id, row_number() over (partition by item_id order by score desc, doc_id) as rank, doc_id, score from s where score > 0)
  select item_id, rank::int as rank, doc_id, score from r where rank <= 10"""


def op1_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Class and number of links of every document at a Jaccard similarity of 0.8 on runs of five words."""
    return minhash.near_texts(table(spark, folder, "documents"), "doc_id", "text")


def op2_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of secrets in every document, those of the patterns counted and digested."""
    docs = table(spark, folder, "documents")
    model = secrets.fit(docs, "text", "doc_id")
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    found = found.withColumn("base", secrets.base_spans(F.col("t")))
    found = found.withColumn("every", secrets.spans(F.col("t"), F.col("base"), model))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secrets.joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secrets.joined(F.col("every")).alias("spans"),
    )


def op3_lattice(spark: SparkSession, folder: str) -> DataFrame:
    """Links, component and representative of every vector, within labels, at a cosine of 0.98."""
    return lattice.near_vectors(table(spark, folder, "embeddings"), "vec_id", "embedding", "label")


def token_digests(ids: Column, path: str = TOKENIZER) -> Column:
    """Number and digest of token ids, and the digest of the text that they decode to."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(series: pd.Series) -> pd.DataFrame:
        decode = bpe.tokenizer(path).decode
        arrays = [np.asarray(x, dtype="<u4") for x in series]
        return pd.DataFrame({
            "n_tokens": [len(x) for x in arrays],
            "ids_sha256": [sha256(x.tobytes()).hexdigest() for x in arrays],
            "decoded_sha256": [sha256(decode(x).encode()).hexdigest() for x in arrays],
        })

    return digests(ids)


def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document and the text decoded from them, as digests."""
    docs = table(spark, folder, "documents")
    found = token_digests(bpe.encode(F.coalesce("text", F.lit("")), TOKENIZER))
    return docs.select("doc_id", found.alias("t")).select("doc_id", "t.*")


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = table(spark, folder, "documents")
    model = langid.fit(docs.where(~held_out("doc_id")), "text", "lang", "doc_id")
    found = docs.select("doc_id", held_out("doc_id").alias("held_out"), langid.predict(F.col("text"), model).alias("p"))
    return found.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to WARC archives and read back through their capture index.

    The archives go to a folder of their own on shared storage, which is the caller's to remove.
    """
    pages = table(spark, folder, "pages")
    place = f"{shared_folder(spark)}/warc-{uuid4().hex}"
    warc.write_archives(pages, "page_id", "url", "html", place)
    warc.write_index(spark, place)
    keys = pages.select(warc.capture_key(F.col("url"), F.col("page_id").cast("long")).alias("key"))
    return warc.look_up(spark, place, keys).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The quality of every document, learned from labels of documents that are not held out."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = quality.fit(docs, "doc_id", "text", labels.where(~held_out("doc_id")), "doc_id", "quality")
    found = docs.select("doc_id", held_out("doc_id").alias("held_out"), quality.score(F.col("text"), model).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op8_wrappers(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page, by the wrapper of its host."""
    pages = table(spark, folder, "pages").select("page_id", "url", "html", wrappers.host_of(F.col("url")).alias("host"))
    found = wrappers.with_wrappers(pages, wrappers.infer(pages, "url", "html"), "host")
    found = found.select("page_id", "url", wrappers.main_text(F.col("html"), F.col("wrapper")).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """The expected severity of every document, learned from labels of documents that are not held out."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.fit(docs, "doc_id", "text", labels.where(~held_out("doc_id")), "doc_id", "toxic")
    found = docs.select("doc_id", held_out("doc_id").alias("held_out"), toxicity.severity(F.col("text"), model).alias("t"))
    return found.select("doc_id", "held_out", "t.severity", "t.grade", "t.toxic")


def op10_spaced_seeds(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that overlap a benchmark item in 13 words or more with at most a fifth substituted."""
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return spaced.overlaps(docs, "doc_id", "text", items, "item_id", "text").drop("doc_key")


def op11_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Words that occur five times or more, each with the frequent form that it is a variant of."""
    found = variants.group_variants(variants.vocabulary(table(spark, folder, "documents"), "doc_id", "text"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op12_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the bytes that lie in a string of 400 bytes which starts at a second place too."""
    found = repeats.mark_repeats(table(spark, folder, "documents"), "doc_id", "text", 400)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["high"] - s["low"])
    return found.select(
        "doc_id",
        F.octet_length("bytes").cast("long").alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2(repeats.without_spans(F.col("bytes"), F.col("spans")), 256).alias("kept_sha256"),
    )


def op13_ranked(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return ranked.search(table(spark, folder, "documents"), "doc_id", "text", table(spark, folder, "benchmark"), "item_id", "text", 10)


QUERIES = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_secrets": op2_secrets,
    "op3_lattice": op3_lattice,
    "op4_warc": op4_warc,
    "op5_bpe": op5_bpe,
    "op6_language": op6_language,
    "op7_quality": op7_quality,
    "op8_wrappers": op8_wrappers,
    "op9_toxicity": op9_toxicity,
    "op10_spaced_seeds": op10_spaced_seeds,
    "op11_variants": op11_variants,
    "op12_repeats": op12_repeats,
    "op13_ranked": op13_ranked,
}
SQL: dict[str, str] = {
    "op1_ngram_jaccard": NEAR_TEXTS_SQL,
    "op3_lattice": NEAR_VECTORS_SQL,
    "op4_warc": WARC_SQL,
    "op8_wrappers": WRAPPERS_SQL,
    "op13_ranked": RANKED_SQL,
}
