"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from a seed and its code point. An n-gram of letters is
bound into one vector: the i-th letter's vector is rotated by i places, and the rotated vectors are
multiplied. A text's vector is the sum over its n-grams, a language's prototype the sum of the unit vectors of
its training texts. A text belongs to the language whose prototype has the largest cosine with it.

Letters are taken in lower case; every run of other characters counts as one blank, which is a letter of its own.
A text that is null or has no letter is ``und`` with score 0, and so is every text where no language was
learned. Ties go to the first language in order. Very long texts are taken whole, repeated rows get the same
answer, and rows with a null language or key teach nothing. ``predict`` is a column function, so other columns keep
their names and values.

The largest cosine says which language is nearest, not whether the text is in it: the noise of the vectors, 1/32, is as
large as the cosines of short texts. ``familiar`` tells that by the n-grams themselves, without noise: a text is in a
learned language if its cosine with the language's n-gram counts is above 0 and not below the quantile ``LOW`` of
stretches of the same length class in that language's own training texts.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from momentloom.llm.common import sampled

DIMENSIONS = 1024
GRAM = 3
SEED = 20
BLANK = 32
UNKNOWN = "und"
#: Training texts of a language at most: enough for a stable prototype, and independent of the corpus.
PER_LANGUAGE = 4_000
#: Codes up to which a table is used to number n-grams, instead of sorting them.
TABLE = 1 << 23
#: Texts that are worked on together, which bounds the n-gram vectors held at a time.
SLICE = 64

#: Share of a language's own stretches of a length that may lie below its threshold.
LOW = 0.005
#: Bits of an n-gram's code for each letter.
LETTER_BITS = 21


@lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


@lru_cache(maxsize=100_000)
def _letter_vector(code: int) -> np.ndarray:
    return (np.random.default_rng([SEED, code]).integers(0, 2, DIMENSIONS, dtype=np.int8) * 2 - 1).astype(np.int8)


def _letters(text: str) -> np.ndarray:
    """Code points of the letters with one blank for each run of others, and one at both ends."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), dtype="<i4")
    codes = np.where(_is_letter()[codes], codes, BLANK)
    blank = codes == BLANK
    return codes[~(blank & np.r_[False, blank[:-1]])]


def vectors(texts: list[str]) -> np.ndarray:
    """One bundled vector for each text; zeros where a text has no letter."""
    parts = [_vectors(texts[i : i + SLICE]) for i in range(0, len(texts), SLICE)]
    return np.concatenate(parts) if parts else np.zeros((0, DIMENSIONS), dtype=np.float32)


def _vectors(texts: list[str]) -> np.ndarray:
    out = np.zeros((len(texts), DIMENSIONS), dtype=np.float32)
    codes = [_letters(t) for t in texts]
    sizes = np.array([len(c) for c in codes], dtype=np.int64)
    if not len(texts) or sizes.max() < GRAM:
        return out
    every = np.concatenate(codes)
    present = np.zeros(0x110000, dtype=bool)
    present[every] = True
    alphabet = np.flatnonzero(present)
    number = np.zeros(0x110000, dtype=np.int64)
    number[alphabet] = np.arange(len(alphabet))
    letter = number[every]
    grams = np.zeros(len(letter) - GRAM + 1, dtype=np.int64)
    for i in range(GRAM):
        grams = grams * len(alphabet) + letter[i : len(letter) - GRAM + 1 + i]
    if len(alphabet) ** GRAM <= TABLE:
        used = np.zeros(len(alphabet) ** GRAM, dtype=bool)
        used[grams] = True
        distinct = np.flatnonzero(used)
        place = np.zeros(len(used), dtype=np.int64)
        place[distinct] = np.arange(len(distinct))
        index = place[grams]
    else:
        distinct, index = np.unique(grams, return_inverse=True)
    base = np.stack([_letter_vector(int(c)) for c in alphabet])
    bound = np.ones((len(distinct), DIMENSIONS), dtype=np.int8)
    for i in range(GRAM):
        digit = distinct // len(alphabet) ** (GRAM - 1 - i) % len(alphabet)
        bound *= np.roll(base, i, axis=1)[digit]
    bound = bound.astype(np.float32)
    start = 0
    for k, size in enumerate(sizes.tolist()):
        if size >= GRAM:
            counts = np.bincount(index[start : start + size - GRAM + 1], minlength=len(distinct))
            here = np.flatnonzero(counts)
            out[k] = counts[here].astype(np.float32) @ bound[here]
        start += size
    return out


def _unit(v: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(v, axis=-1, keepdims=True)
    return np.divide(v, norm, out=np.zeros_like(v), where=norm > 0)


@dataclass(frozen=True)
class Profiles:
    """The languages in order and a unit prototype for each: a few kilobytes per language."""

    languages: tuple[str, ...]
    prototypes: np.ndarray


def fit(df: DataFrame, text: str, lang: str, key: str, bound: int = PER_LANGUAGE) -> Profiles:
    """Prototypes from about ``bound`` texts of each language at most, chosen by a hash of ``key``."""
    data = sampled(df.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).alias("l")).where("l is not null"), ["l"], bound, "k")

    def sums(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            unit = _unit(vectors(batch["t"].fillna("").tolist()).astype(np.float64))
            for language, rows in batch.groupby("l").indices.items():
                total[language] = total.get(language, 0.0) + unit[rows].sum(axis=0)
        for language, v in total.items():
            yield pd.DataFrame({"l": language, "i": np.arange(DIMENSIONS), "v": v})

    rows = data.select("t", "l").mapInPandas(sums, "l string, i int, v double").groupBy("l", "i").agg(F.sum("v").alias("v")).collect()
    languages = tuple(sorted({r["l"] for r in rows}))
    prototypes = np.zeros((len(languages), DIMENSIONS))
    for r in rows:
        prototypes[languages.index(r["l"]), r["i"]] = r["v"]
    return Profiles(languages, _unit(prototypes).astype(np.float32))


def answers(texts: list[str | None], model: Profiles) -> pd.DataFrame:
    """The language of each text and the cosine with its prototype, 0 where that is negative."""
    bundles = vectors([t or "" for t in texts])
    lettered = np.array([bool(t) and any(map(str.isalpha, t)) for t in texts], dtype=bool)
    if not model.languages:
        return pd.DataFrame({"lang": [UNKNOWN] * len(texts), "score": np.zeros(len(texts))})
    cosine = _unit(bundles) @ model.prototypes.T
    best = cosine.argmax(axis=1) if len(texts) else np.zeros(0, dtype=np.int64)
    names = np.array(model.languages, dtype=object)[best]
    score = np.clip(cosine[np.arange(len(texts)), best].astype(np.float64), 0.0, 1.0)
    return pd.DataFrame({"lang": np.where(lettered, names, UNKNOWN), "score": np.where(lettered, score, 0.0)})


def predict(text: Column, model: Profiles) -> Column:
    """``struct<lang, score>`` of a text column."""

    @F.pandas_udf("lang string, score double")
    def language(texts: pd.Series) -> pd.DataFrame:
        return answers([None if t is None else t for t in texts], model)

    return language(text)


@dataclass(frozen=True)
class Counts:
    """N-grams in order, their weights in each language, and least cosines by language and length class."""

    grams: np.ndarray
    weights: np.ndarray
    least: np.ndarray


def _grams(text: str | None) -> np.ndarray:
    """The codes of a text's n-grams in order, none where it has no letter."""
    letters = _letters(text or "").astype(np.int64)
    if len(letters) < GRAM:
        return letters[:0]
    codes = np.zeros(len(letters) - GRAM + 1, dtype=np.int64)
    for i in range(GRAM):
        codes = (codes << LETTER_BITS) | letters[i : len(codes) + i]
    return codes


def _unit_counts(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, counts = np.unique(grams, return_counts=True)
    return distinct, counts / max(1e-12, float(np.linalg.norm(counts)))


def _cosines(grams: np.ndarray, model: Counts) -> np.ndarray:
    """The cosine of a stretch of n-grams with each language."""
    distinct, shares = _unit_counts(grams)
    at = np.minimum(np.searchsorted(model.grams, distinct), len(model.grams) - 1)
    return model.weights[:, at] @ np.where(model.grams[at] == distinct, shares, 0.0)


def _length_class(n: int) -> int:
    return int(n).bit_length() - 1


def fit_counts(df: DataFrame, text: str, lang: str, key: str, bound: int = PER_LANGUAGE, low: float = LOW) -> Counts | None:
    """Weights and least cosines from the same texts as ``fit``; None where no language was learned.

    Each training text gives one stretch for each power of two up to its length. A class with too few stretches for
    the quantile takes the threshold of the next shorter one. Where no language has enough texts for any threshold, as in
    tables of a few rows, all are -1: nothing can be told to be in no language.
    """
    data = sampled(df.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).alias("l")).where("l is not null"), ["l"], bound, "k").select("t", "l")

    def sums(batches):
        for batch in batches:
            for language, texts in batch.groupby("l")["t"]:
                pairs = [_unit_counts(_grams(t)) for t in texts.dropna()]
                if pairs:
                    distinct, index = np.unique(np.concatenate([g for g, _ in pairs]), return_inverse=True)
                    yield pd.DataFrame({"l": language, "g": distinct, "v": np.bincount(index, np.concatenate([n for _, n in pairs]), len(distinct))})

    found = data.mapInPandas(sums, "l string, g long, v double").groupBy("l", "g").agg(F.sum("v").alias("v")).toPandas()
    if found.empty:
        return None
    languages = sorted(set(found["l"]))
    grams, at = np.unique(found["g"].to_numpy(), return_inverse=True)
    weights = np.zeros((len(languages), len(grams)))
    weights[np.searchsorted(languages, found["l"].to_numpy(dtype=str)), at] = found["v"]
    weights = _unit(weights)
    model = Counts(grams, weights, np.zeros((len(languages), 1)))

    def stretches(batches):
        for batch in batches:
            rows = []
            for language, t in zip(batch["l"], batch["t"]):
                codes = _grams(t)
                for c in range(_length_class(len(codes)) + 1):
                    n = 1 << c
                    start = int(codes.sum() + c) % (len(codes) - n + 1)
                    rows.append((language, c, float(_cosines(codes[start : start + n], model)[languages.index(language)])))
            yield pd.DataFrame(rows, columns=["l", "c", "v"]).astype({"c": "int32", "v": "float64"})

    known = data.where(F.col("l").isin(languages)).mapInPandas(stretches, "l string, c int, v double")
    told = {(r["l"], r["c"]): r for r in known.groupBy("l", "c").agg(F.count("*").alias("n"), F.percentile("v", F.lit(low)).alias("v")).collect()}
    if not any(r["n"] * low >= 1 for r in told.values()):
        return Counts(grams, weights, np.full((len(languages), 1), -1.0))
    least = np.zeros((len(languages), 1 + max(c for _, c in told)))
    for i, language in enumerate(languages):
        for c in range(least.shape[1]):
            r = told.get((language, c))
            least[i, c] = r["v"] if r and r["n"] * low >= 1 else least[i, c - 1] if c else 0.0
    return Counts(grams, weights, least)


def is_familiar(text: str | None, model: Counts) -> bool:
    """Whether a text is in any of the learned languages."""
    grams = _grams(text)
    if not len(grams):
        return False
    cosines, least = _cosines(grams, model), model.least[:, min(_length_class(len(grams)), model.least.shape[1] - 1)]
    return bool(((cosines >= least) & ((cosines > 0) | (least < 0))).any())


def familiar(text: Column, model: Counts | None) -> Column:
    """Whether each text of a column is in any of the learned languages: false for null and where none was learned."""

    @F.pandas_udf("boolean")
    def known(texts: pd.Series) -> pd.Series:
        return pd.Series([model is not None and is_familiar(t, model) for t in texts], dtype=bool)

    return known(text)
