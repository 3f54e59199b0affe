"""A quality score from compression: texts that compress better with a dictionary of good texts are good.

Two zstandard dictionaries are trained, one from good and one from bad labelled texts. A text is cut into blocks of
``CHUNK`` bytes, every block is compressed with both, and the difference of the total sizes over their sum, the
normalised compressed-size difference, says which kind the text resembles. A logistic curve over this
difference and the mean compressed size of a byte, fitted on labelled texts that no dictionary has seen, makes
it a probability. Whole texts are compressed, in blocks because a long text otherwise becomes its own dictionary.

Null and empty texts get the share of good texts among those of the fit; so does every text if only one label
was seen, and 0.5 if none was. Rows with a null label or id teach nothing; repeated rows teach as often as they
occur. ``score`` is a column function: other columns of a table keep their names and values.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from momentloom.llm.common import kept, sampled

CHUNK = 1024
LEVEL = 3
DICTIONARY = 110 << 10
#: Labelled texts of either kind that the model learns from, about, and blocks for a dictionary.
PER_LABEL = 4_000
BLOCKS = 6_000
#: Weight of the pull of the curve towards zero.
RIDGE = 1e-3


@dataclass(frozen=True)
class Model:
    """Dictionaries of bad and good texts, the curve's weights, and the share of good texts."""

    bad: bytes
    good: bytes
    weights: tuple[float, ...]
    share: float


def blocks(text: str) -> list[bytes]:
    raw = text.encode()
    return [raw[i : i + CHUNK] for i in range(0, len(raw), CHUNK)]


@lru_cache(maxsize=4)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=data, write_content_size=False, write_dict_id=False, level=LEVEL)


def _dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; the samples themselves where they are too few to train one."""
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY:]


def measures(texts: list[str], bad: bytes, good: bytes) -> np.ndarray:
    """The normalised difference and the compressed size of a byte; zeros for an empty text."""
    with_bad, with_good = _compressor(bad), _compressor(good)
    out = np.zeros((len(texts), 2))
    for i, text in enumerate(texts):
        parts = blocks(text)
        if parts:
            a, b = sum(len(with_bad.compress(p)) for p in parts), sum(len(with_good.compress(p)) for p in parts)
            out[i] = (a - b) / (a + b), (a + b) / (2 * sum(map(len, parts)))
    return out


def _terms(m: np.ndarray) -> np.ndarray:
    difference, density = 10 * m[:, 0], m[:, 1]
    return np.stack([np.ones(len(m)), difference, density, density**2, difference * density], axis=1)


def _curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic curve, by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(len(w))
        w += np.linalg.solve(hessian, x.T @ (y - p) - RIDGE * w)
    return w


def fit(docs: DataFrame, doc_id: str, text: str, labels: DataFrame, label_id: str, label: str, bound: int = PER_LABEL) -> Model:
    """A model from about ``bound`` texts labelled 1 and as many labelled 0; half of them train the dictionaries.

    The sample of labels has a stated size, so it is broadcast; the documents are read once and not shuffled.
    """
    marks = labels.select(F.col(label_id).alias("k"), F.col(label).cast("int").alias("y")).where("y in (0, 1)")
    marks = sampled(marks, ["y"], bound, "k")
    texts = docs.select(F.col(doc_id).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    rows = kept(texts.join(F.broadcast(marks), "k")).withColumn("half", F.pmod(F.xxhash64(F.col("k").cast("string"), F.lit("half")), F.lit(2)))

    def cut(batches):
        for batch in batches:
            for y, t in zip(batch["y"], batch["t"]):
                parts = blocks(t)
                yield pd.DataFrame({"y": y, "part": parts, "i": np.arange(len(parts))})

    parts = rows.where("half = 0").select("y", "t").mapInPandas(cut, "y int, part binary, i int")
    parts = sampled(parts.withColumn("pick", F.concat_ws(":", F.sha1("part"), "i")), ["y"], BLOCKS, "pick")
    samples = parts.select("y", "part", "pick").orderBy("pick").collect()
    dictionaries = [_dictionary([bytes(r["part"]) for r in samples if r["y"] == y]) for y in (0, 1)]
    if not all(dictionaries):
        seen = [r["y"] for r in marks.select("y").distinct().collect()]
        return Model(b"", b"", (), sum(seen) / len(seen) if seen else 0.5)

    def measure(batches):
        for batch in batches:
            m = measures(batch["t"].tolist(), *dictionaries)
            yield pd.DataFrame({"y": batch["y"], "a": m[:, 0], "b": m[:, 1]})

    told = rows.where("half = 1").select("y", "t").mapInPandas(measure, "y int, a double, b double")
    told = np.array([(r["y"], r["a"], r["b"]) for r in told.orderBy("y", "a", "b").collect()]).reshape(-1, 3)
    if not len(told):
        return Model(b"", b"", (), 0.5)
    weights = _curve(_terms(told[:, 1:]), told[:, 0])
    return Model(*dictionaries, tuple(weights.tolist()), float(told[:, 0].mean()))


def score(text: Column, model: Model) -> Column:
    """The probability that a text is good, from 0 to 1."""

    @F.pandas_udf("double")
    def probability(texts: pd.Series) -> pd.Series:
        texts = texts.fillna("").tolist()
        out = np.full(len(texts), model.share)
        if model.weights:
            p = 1 / (1 + np.exp(-np.clip(_terms(measures(texts, model.bad, model.good)) @ np.array(model.weights), -30, 30)))
            out = np.where([bool(t) for t in texts], p, out)
        return pd.Series(out)

    return probability(text)
