"""Secrets in texts: three fixed patterns, and strings that look random to a pair of Markov models.

``spans(text, model)`` gives every span as ``array<struct<start, kind, end>>``, in order of start and then of
kind, in code points with the end left out. The kinds are those of ``KINDS``: ``assign``, ``access`` and ``hex``
come from patterns; ``random`` are further strings of characters as keys have them whose transitions are
likelier under the model of random strings than under that of ordinary identifiers and words, by more than
``THRESHOLD`` per character. Random spans never overlap one of the others.

``fit`` counts both models' transitions. The labelled samples are the documents themselves: values that the
patterns find are samples of random strings, all other runs of key characters are ordinary ones.

Everything is built-in column functions; other columns of a table are not touched. A null or empty text has no
span, and ``redact`` leaves it as it is. Texts of any length are searched whole, in time that grows with their length and,
where spans are many, with the square of their number; repeated rows give the same
spans, and a table without rows gives none and leaves both models at their priors.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns that are asked for, with the least length of what each must hold.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"  # a run of 32 or more: what is left of [0-9a-f]+ once shorter runs are dropped
KEYWORD = r"(?i)password|passwd|secret|token|api_?key"
ASSIGN_LEAST, ACCESS_LEAST = 8, 16
KINDS = ("assign", "access", "hex", "random")

#: Strings that the models judge, and those that they learn from.
CANDIDATE = r"[A-Za-z0-9+/_-]{16,}={0,2}"
SAMPLE = r"[A-Za-z0-9+/_-]{6,}={0,2}"
#: Mean log-likelihood ratio of a transition from which on a candidate is reported.
THRESHOLD = 1.0
#: Characters that keys are made of, and pseudo-counts spread over them for each preceding character. A random
#: string may hold any transition, so its prior weighs much; that of ordinary strings weighs little.
ALPHABET = 66
PRIOR_RANDOM, PRIOR_ORDINARY = 200.0, 1.0
#: Documents that the models learn from, about; a bounded sample chosen by hash.
SAMPLE_DOCUMENTS = 20_000

SPAN = "array<struct<start:int,kind:int,end:int>>"


@dataclass(frozen=True)
class Ratios:
    """Log-likelihood ratios of the transitions between 128 characters, row by row."""

    values: tuple[float, ...]

    def column(self) -> Column:
        return F.split(F.lit(",".join(f"{v:.6f}" for v in self.values)), ",").cast("array<double>")


def _found(text: Column, kind: int, pattern: str, group: int, least: int, wanted=None) -> Column:
    """Spans of the matches whose group has ``least`` characters, from the pieces between the matches.

    ``wanted`` is a condition on a whole match, told from its string alone.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    steps = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), matches.alias("all"), values.alias("value"))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["all"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        fits = F.length(x["value"]) >= least
        out = F.when(fits if wanted is None else fits & wanted(x["all"]), F.array_append(state["out"], span)).otherwise(state["out"])
        return F.struct(end.alias("at"), out.alias("out"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))
    return F.aggregate(steps, begin, step, lambda s: s["out"])


def _where(text: Column, pattern: str, spans: Column) -> Column:
    return F.when(F.rlike(text, F.lit(pattern)), spans).otherwise(F.array().cast(SPAN))


def base_spans(text: Column) -> Column:
    """Spans of the three patterns, in order of start and kind."""
    found = [
        _where(text, KEYWORD, _found(text, 0, ASSIGN, 2, ASSIGN_LEAST)),
        _where(text, ACCESS, _found(text, 1, ACCESS, 0, ACCESS_LEAST)),
        _where(text, HEX, _found(text, 2, HEX, 0, 0)),
    ]
    return F.array_sort(F.concat(*found))


def _pairs(string: Column, ascii_only: bool = True) -> Column:
    """A number for each two neighbouring characters. The string is split once: cutting it at each place walks it anew."""
    code = lambda c: F.ascii(c) if ascii_only else F.ascii(c) % 128
    codes = F.array(F.transform(F.split(string, ""), code))
    both = lambda c: F.zip_with(F.slice(c, 1, F.size(c) - 1), F.slice(c, 2, F.size(c) - 1), lambda a, b: a * 128 + b)
    return F.element_at(F.transform(codes, both), 1)


def _ratio(string: Column, ratios: Column) -> Column:
    """Mean log-likelihood ratio of the transitions of a string, in time linear in its length."""
    total = F.aggregate(_pairs(string), F.lit(0.0), lambda sum_, pair: sum_ + F.element_at(ratios, pair + 1))
    return total / (F.length(string) - 1)


def random_spans(text: Column, base: Column, model: Ratios, threshold: float = THRESHOLD) -> Column:
    """Spans of the candidates that look random and overlap no span of ``base``."""
    ratios = model.column()
    strings = F.array_distinct(F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)))
    random = lambda s: _ratio(s, ratios) > threshold
    free = lambda span: ~F.exists(base, lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"]))
    found = F.filter(_found(text, 3, CANDIDATE, 0, 0, random), free)
    return F.when(F.exists(strings, random), found).otherwise(F.array().cast(SPAN))


def spans(text: Column, base: Column, model: Ratios, threshold: float = THRESHOLD) -> Column:
    """All spans; ``base`` is the column that ``base_spans`` gave for the text."""
    return F.array_sort(F.concat(base, random_spans(text, base, model, threshold)))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, separated by commas."""
    kind = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind(s), s["start"], s["end"])), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each run of overlapping spans replaced by one mark."""

    def step(state: Column, s: Column) -> Column:
        gap = F.substr(text, state["at"] + 1, s["start"] - state["at"])
        out = F.when(s["start"] >= state["at"], F.concat(state["out"], gap, F.lit(mark))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), out.alias("out"))

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = lambda s: F.concat(s["out"], F.substr(text, s["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, begin, step, rest)).otherwise(text)


def fit(df: DataFrame, text: str, key: str, bound: int = SAMPLE_DOCUMENTS) -> Ratios:
    """The ratios of both models, from about ``bound`` documents; rows with a null key are left out."""
    total = max(1, df.select(F.count(key)).first()[0])
    unit = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("secrets")), F.lit(1 << 30)) / float(1 << 30)
    docs = df.where(F.col(key).isNotNull() & (unit < min(1.0, bound / total))).select(F.coalesce(text, F.lit("")).alias("t"))
    t = F.col("t")
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace(t, ASSIGN, " "), ACCESS, " "), HEX, " ")
    value = F.filter(F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= ASSIGN_LEAST)
    others = F.concat(F.regexp_extract_all(t, F.lit(ACCESS), F.lit(0)), F.regexp_extract_all(t, F.lit(HEX), F.lit(0)))
    labelled = F.array(
        F.struct(F.lit(True).alias("random"), F.concat(value, others).alias("strings")),
        F.struct(F.lit(False).alias("random"), F.regexp_extract_all(rest, F.lit(SAMPLE), F.lit(0)).alias("strings")),
    )
    strings = docs.select(F.explode(labelled).alias("l")).select("l.random", F.explode("l.strings").alias("s"))
    strings = strings.groupBy("random", "s").agg(F.count("*").alias("n")).where("length(s) > 1")
    # A string counts once, however often its copies occur.
    pairs = strings.select("random", F.explode(_pairs(F.col("s"), ascii_only=False)).alias("pair"))
    counts = {(r["random"], r["pair"]): r["n"] for r in pairs.groupBy("random", "pair").agg(F.count("*").alias("n")).collect()}

    def chance(kind: bool, prior: float) -> list[float]:
        out = []
        for a in range(128):
            row = [counts.get((kind, a * 128 + b), 0) for b in range(128)]
            out += [(n + prior / ALPHABET) / (sum(row) + prior) for n in row]
        return out

    both = zip(chance(True, PRIOR_RANDOM), chance(False, PRIOR_ORDINARY))
    return Ratios(tuple(log(r / o) for r, o in both))
