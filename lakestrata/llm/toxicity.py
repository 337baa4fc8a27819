"""Toxic passages: maximum-scoring segments over token log-odds.

A token's score is the log-odds of its rate in toxic against other texts, under
a Dirichlet prior that follows the token's rate in all texts, less two standard
errors; what is then too small to matter counts as nothing. A
word that has none is scored by the longest of its first letters that has, so
inflected forms are known by their stem. Every token costs ``DRIFT``, so a text
without toxic words has a falling total.

One linear scan finds all maximal segments, those that no longer or shorter one
beats. In text that is not toxic the scores of such segments fall off
exponentially (the extreme-value law of local scores): ``K`` segments a token
reach zero, and of these ``exp(-rate * s)`` reach the score s. Both are measured
on labelled texts whose own words did not make the scores. A segment that is
expected less than ``MOST_EXPECTED`` times in a text of that length is a passage;
the text's evidence is the least probability of its best r segments' sum, over
all r, and a logistic curve fitted to the evidence makes it a score.

Everything is learned from all labelled rows of the folds, each distinct text
once. Texts that agree in every character but have different labels count as
toxic.

Defined results: a NULL text counts as empty and has no evidence; a repeated row
is scored each time; texts of any length are read whole; without labelled rows
of both kinds every text gets the share of toxic ones, or 0.5 without any; an
empty table gives an empty result. Only the identifier and the text are read. A
column of ``keep`` named like one of the results is replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, replace
from math import lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.llm.common import Batches, crc32_of, cut_lineage, pylist, text_of
from lakestrata.llm.decontaminate import WORD
from lakestrata.operators.joins import broadcast_if_small

FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
# Weight of the prior as a share of all tokens.
PRIOR = 0.05
# Standard errors that log-odds are brought closer to zero by, and the least that then count.
ERRORS, LEAST_ODDS = 2.0, 0.5
DRIFT = 0.5
STEMS = (4, 5, 6, 7, 8)
MOST_EXPECTED = 0.01
# Tails start from so many segments that fall off at rate 1, the rate of log-odds.
TAIL_PRIOR = 10
# Known forms that are sent to every task; more are joined to the words.
SENT_FORMS = 1_000_000
# Labelled texts that are sent to every task; more are joined by shuffle.
SENT_LABELS = 1_000_000
# Forms a task counts before it hands them on.
HELD_FORMS = 1_000_000
EVIDENCE_STEP, MOST_EVIDENCE = 0.25, 500.0

_ASCII_WORD = re.compile(r"[0-9A-Za-z]+")
PASSAGE = "struct<start:int,end:int,score:double,expected:double>"


def _word_pattern(text: str) -> re.Pattern:
    return _ASCII_WORD if text.isascii() else WORD


def words_of(text: str) -> list[str]:
    """The words of a text in lower case, in order."""
    found = _word_pattern(text).findall(text)
    return "\n".join(found).lower().split("\n") if found else []


def forms_of(word: str) -> list[str]:
    """What a word is known by: itself, then its stems from the longest."""
    return [word, *(word[:n] + "*" for n in reversed(STEMS) if n < len(word))]


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments as (start, end, score), end exclusive.

    Neighbours of the same sign are taken together first; the rest is the
    linear algorithm on running totals: a new positive run joins the nearest
    earlier segment that begins at a lower total and does not end at a higher one.
    """
    positive = scores > 0
    if not positive.any():
        return []
    turns = np.flatnonzero(np.diff(positive)) + 1
    bounds = np.r_[0, turns, len(scores)]
    sums = np.add.reduceat(scores, bounds[:-1])
    total = 0.0
    # Per segment: place, end, total before it, total after it, and the nearest
    # earlier segment with a lower total before it.
    found: list[tuple[int, int, float, float, int]] = []
    for start, end, gain in zip(bounds[:-1].tolist(), bounds[1:].tolist(), sums.tolist()):
        before, total = total, total + gain
        if gain <= 0:
            continue
        while True:
            lower = len(found) - 1
            while lower >= 0 and found[lower][2] >= before:
                lower = found[lower][4]
            if lower < 0 or found[lower][3] >= total:
                found.append((start, end, before, total, lower))
                break
            start, before = found[lower][0], found[lower][2]
            del found[lower:]
    return [(s, e, after - before) for s, e, before, after, _ in found]


@dataclass(frozen=True)
class Model:
    """``forms`` is the table of scored forms (form, odds); ``sent`` the same
    by form, where there are few enough."""

    forms: DataFrame | None
    sent: dict[str, float] | None
    tail_rate: float = 1.0
    tail_k: float = 1e-6
    intercept: float = 0.0
    slope: float = 0.0

    def expected(self, n_words: int, segment: float) -> float:
        """Segments of this score or more in a harmless text of that length."""
        return self.tail_k * n_words * float(np.exp(-self.tail_rate * segment))


def evidence(n_words: int, segments: list[float], tail_rate: float, tail_k: float) -> float:
    """Minus the log of the least probability of a sum of the best r segments."""
    if not segments:
        return 0.0
    best = np.sort(np.asarray(segments))[::-1]
    r = np.arange(1, len(best) + 1)
    total = np.cumsum(tail_rate * best - log(tail_k * n_words))
    ways = np.array([lgamma(k + 1) + lgamma(k) for k in r.tolist()])
    # The approximation holds for sums that are large against their number.
    holds = total > r * (r + 1) if len(r) > 1 else total > 0
    minus_log = np.where(holds, total - (r - 1) * np.log(np.maximum(total, 1e-9)) + ways, 0.0)
    return float(max(0.0, total[0], minus_log.max()))


class _Scorer:
    """Scores of words; keeps those of the words it met lately."""

    def __init__(self, odds: dict[str, float]):
        self.odds, self.seen = odds, {}

    def __call__(self, words: list[str]) -> np.ndarray:
        seen = self.seen
        if len(seen) > 500_000:
            seen.clear()
        for word in set(words).difference(seen):
            seen[word] = next((self.odds[f] for f in forms_of(word) if f in self.odds), 0.0) - DRIFT
        return np.fromiter(map(seen.__getitem__, words), dtype=float, count=len(words))


# --- learning ---------------------------------------------------------------

def learned_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text_hash, toxic, half, copies): one identifier per distinct
    labelled text outside the held-out fold, and the rows that repeat it under
    that identifier. Only 64-bit hashes of texts are shuffled."""
    learned = crc32_of("doc_id") % FOLDS != HELD_OUT
    marks = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & learned)
        .groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    )
    texts = (
        docs.where(F.col("doc_id").isNotNull() & learned).select("doc_id", F.xxhash64(text_of()).alias("text_hash"))
        .groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("copies"))
    )
    return (
        texts.join(marks, "doc_id").groupBy("text_hash")
        .agg(F.min(F.struct("doc_id", "copies")).alias("first"), F.max("toxic").alias("toxic"))
        .select("first.doc_id", "text_hash", "toxic", F.pmod(F.xxhash64("text_hash"), F.lit(2)).cast("int").alias("half"), "first.copies")
    )


_COUNTS = ["toxic0", "other0", "toxic1", "other1"]


def _count_forms(batches: Batches) -> Batches:
    counts: list[Counter] = [Counter() for _ in _COUNTS]

    def rows():
        forms = set().union(*counts)
        for at in range(0, len(forms), 50_000):
            part = list(forms)[at:at + 50_000] if len(forms) > 50_000 else list(forms)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.string()), *(pa.array([c[f] for f in part], pa.int64()) for c in counts)],
                names=["form", *_COUNTS],
            )
        for c in counts:
            c.clear()

    for batch in batches:
        for toxic, half, text in zip(*(pylist(batch, c) for c in ("toxic", "half", "text"))):
            words = set(words_of(text))
            counts[2 * half + 1 - toxic].update({f for w in words for f in forms_of(w)})
        if sum(map(len, counts)) >= HELD_FORMS:
            yield from rows()
    yield from rows()


def log_odds(counts: DataFrame, toxic: Column, other: Column) -> DataFrame:
    """(form, odds) of the forms whose log-odds are large enough even when
    ``ERRORS`` standard errors are taken off; what is left is their score."""
    counted = counts.select("form", toxic.cast("double").alias("t"), other.cast("double").alias("o"))
    whole = ~F.col("form").endswith("*")
    totals = counted.where(whole).agg(F.sum("t").alias("t"), F.sum("o").alias("o")).first()
    n_t, n_o = totals["t"] or 0.0, totals["o"] or 0.0
    if not n_t or not n_o:
        return counted.where(F.lit(False)).select("form", F.lit(0.0).alias("odds"))
    prior = PRIOR * (F.col("t") + F.col("o"))
    whole_prior = PRIOR * (n_t + n_o)

    def logit(n: Column, total: float) -> Column:
        # A stem can stand in more places than there are words of one class.
        return F.log((n + prior) / F.greatest(F.lit(total + whole_prior) - n - prior, F.lit(1.0)))

    odds = logit(F.col("t"), n_t) - logit(F.col("o"), n_o)
    error = F.sqrt(1 / (F.col("t") + prior) + 1 / (F.col("o") + prior))
    sure = F.signum("odds") * (F.abs("odds") - ERRORS * F.col("error"))
    return (
        counted.where((F.col("t") + F.col("o")) > 0).select("form", odds.alias("odds"), error.alias("error"))
        .where(F.abs("odds") - ERRORS * F.col("error") >= LEAST_ODDS).select("form", sure.alias("odds"))
    )


def _sent(forms: DataFrame, most: int) -> dict[str, float] | None:
    """The forms by name, unless there are more than ``most``."""
    got = forms.limit(most + 1).toArrow()
    if got.num_rows > most:
        return None
    return dict(zip(got.column(0).to_pylist(), got.column(1).to_pylist()))


def _curve(rows: list[tuple[float, float, int]]) -> tuple[float, float]:
    """Logistic curve through (evidence, toxic, number), by Newton steps."""
    x, y, n = (np.array(c, dtype=float) for c in zip(*rows))
    ones, zeros = float((n * y).sum()), float((n * (1 - y)).sum())
    # Targets a little inside 0 and 1 keep the curve finite where evidence separates.
    target = np.where(y > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    design, beta = np.stack([np.ones_like(x), x], axis=1), np.array([log((ones + 1) / (zeros + 1)), 0.0])
    ridge = np.diag([1e-6, 1e-3])
    loss = lambda b: float((n * np.logaddexp(0, design @ b) - n * target * (design @ b)).sum() + b @ ridge @ b / 2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -50, 50)))
        gradient = design.T @ (n * (p - target)) + ridge @ beta
        step = np.linalg.solve(design.T @ (design * (n * np.maximum(p * (1 - p), 1e-9))[:, None]) + ridge, gradient)
        size = 1.0
        while loss(beta - size * step) > loss(beta) and size > 1e-6:
            size /= 2
        beta = beta - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def train(docs: DataFrame, labels: DataFrame, *, sent_forms: int = SENT_FORMS) -> Model:
    """Learn scores, tail and curve from all labelled texts of the folds."""
    texts = cut_lineage(learned_texts(docs, labels), "toxic_texts")
    shares = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, other = shares.get(1, 0), shares.get(0, 0)
    if not toxic or not other:
        rate = (toxic + 1e-9) / (toxic + other + 2e-9)
        return Model(None, {}, intercept=float(np.clip(log(rate / (1 - rate)), -20, 20)))
    source = docs.where(crc32_of("doc_id") % FOLDS != HELD_OUT).select(
        "doc_id", F.xxhash64(text_of()).alias("text_hash"), text_of().alias("text")
    )
    found = source.join(broadcast_if_small(texts, SENT_LABELS), ["doc_id", "text_hash"])
    # Rows that repeat, if there are any, are shuffled to be taken once.
    if not texts.where("copies > 1").isEmpty():
        found = found.where("copies = 1").unionByName(found.where("copies > 1").dropDuplicates(["doc_id", "text_hash"]))
    chosen = found.select("toxic", "half", "text")
    counts = cut_lineage(
        chosen.mapInArrow(_count_forms, "form string, " + ", ".join(f"{c} long" for c in _COUNTS))
        .groupBy("form").agg(*[F.sum(c).alias(c) for c in _COUNTS]),
        "toxic_forms",
    )
    # Each half is scored by the words of the other one.
    halves = [cut_lineage(log_odds(counts, F.col(f"toxic{h}"), F.col(f"other{h}")), "half_forms") for h in (1, 0)]
    measured = []
    for half, forms in enumerate(halves):
        model = Model(forms, _sent(forms, sent_forms))
        measured.append(_segments(chosen.where(F.col("half") == half).select("toxic", "text"), model))
    segments = cut_lineage(measured[0].unionByName(measured[1]), "toxic_segments")
    tail = segments.where("toxic = 0").agg(
        F.sum(F.size("segments")).alias("m"), F.sum("n_words").alias("n"),
        F.round(F.sum(F.aggregate("segments", F.lit(0.0), lambda a, s: a + s)), 6).alias("s"),
    ).first()
    tail_rate = (tail["m"] + TAIL_PRIOR) / ((tail["s"] or 0.0) + TAIL_PRIOR)
    tail_k = (tail["m"] + 1) / (tail["n"] + 1)

    def bins(batches: Batches) -> Batches:
        for batch in batches:
            x = [
                min(MOST_EVIDENCE, round(evidence(n, s, tail_rate, tail_k) / EVIDENCE_STEP) * EVIDENCE_STEP)
                for n, s in zip(pylist(batch, "n_words"), pylist(batch, "segments"))
            ]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()), batch.column(0)], names=["x", "toxic"])

    rows = segments.mapInArrow(bins, "x double, toxic int").groupBy("x", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()
    intercept, slope = _curve(sorted((r["x"], r["toxic"], r["n"]) for r in rows))
    forms = cut_lineage(log_odds(counts, F.col("toxic0") + F.col("toxic1"), F.col("other0") + F.col("other1")), "toxic_odds")
    return Model(forms, _sent(forms, sent_forms), tail_rate, tail_k, intercept, max(slope, 0.0))


# --- scoring ----------------------------------------------------------------

def _with_odds(source: DataFrame, forms: DataFrame) -> DataFrame:
    """``source`` with ``_odds``, the scored forms of each row's words.

    For tables of forms too large to send: words are joined with them by
    shuffle, each distinct word of a row once.
    """
    numbered = cut_lineage(source.withColumn("_row", F.monotonically_increasing_id()), "numbered")

    def split(batches: Batches) -> Batches:
        for batch in batches:
            for row, text in zip(pylist(batch, "_row"), pylist(batch, "text")):
                held = list({f for w in set(words_of(text)) for f in forms_of(w)})
                for at in range(0, len(held), 50_000):
                    part = held[at:at + 50_000]
                    yield pa.RecordBatch.from_arrays([pa.array([row] * len(part), pa.int64()), pa.array(part)], names=["_row", "form"])

    words = numbered.select("_row", "text").mapInArrow(split, "_row long, form string")
    known = words.join(forms, "form").groupBy("_row").agg(F.collect_list(F.struct("form", "odds")).alias("_odds"))
    return numbered.join(known, "_row", "left").drop("_row")


def _apply(source: DataFrame, model: Model, one: Callable, columns: list[tuple[str, str, pa.DataType]]) -> DataFrame:
    """Every row of ``source`` without ``text``, with what ``one`` makes of the
    text and the scorer of its words."""
    kept = [f for f in source.schema if f.name != "text"]
    out = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), *(f"{n} {k}" for n, k, _ in columns)])
    joined = model.sent is None
    sent = None if joined else source.sparkSession.sparkContext.broadcast(model.sent)

    def run(batches: Batches) -> Batches:
        scorer = None if joined else _Scorer(sent.value)
        for batch in batches:
            texts = pylist(batch, "text")
            if joined:
                odds = [_Scorer({r["form"]: r["odds"] for r in rows or []}) for rows in pylist(batch, "_odds")]
            else:
                odds = [scorer] * len(texts)
            results = list(zip(*map(one, texts, odds))) or [[] for _ in columns]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(f.name)) for f in kept),
                 *(pa.array(list(values), kind) for values, (_, _, kind) in zip(results, columns))],
                names=[*(f.name for f in kept), *(n for n, _, _ in columns)],
            )

    if joined:
        source = _with_odds(source, model.forms)
    return source.mapInArrow(run, out)


def _segments(chosen: DataFrame, model: Model) -> DataFrame:
    def one(text: str, scorer: _Scorer):
        words = words_of(text)
        return len(words), [score for _, _, score in maximal_segments(scorer(words))]

    return _apply(chosen, model, one, [
        ("n_words", "long", pa.int64()), ("segments", "array<double>", pa.list_(pa.float64())),
    ])


def score(docs: DataFrame, model: Model, *, keep: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """The columns ``keep`` of every row with ``score``, ``predicted`` and
    ``passages``: start and end in code points, score, and how many such
    passages a harmless text of that length is expected to hold."""
    results = ("score", "predicted", "passages")
    names = [c for c in keep if c not in results]
    source = docs.select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(names)], text_of().alias("text"))
    plain = replace(model, forms=None, sent=None)

    def one(text: str, scorer: _Scorer):
        words = words_of(text)
        found = maximal_segments(scorer(words))
        x = min(MOST_EVIDENCE, evidence(len(words), [s for _, _, s in found], plain.tail_rate, plain.tail_k))
        value = 1 / (1 + float(np.exp(-np.clip(plain.intercept + plain.slope * x, -50, 50))))
        passages = [(a, b, s, plain.expected(len(words), s)) for a, b, s in found]
        passages = [p for p in passages if p[3] < MOST_EXPECTED]
        if passages:
            places = [m.span() for m in _word_pattern(text).finditer(text)]
            passages = [{"start": places[a][0], "end": places[b - 1][1], "score": s, "expected": e} for a, b, s, e in passages]
        return value, int(value >= threshold), passages

    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())]))
    scored = _apply(source, model, one, [
        ("score", "double", pa.float64()), ("predicted", "int", pa.int32()), ("passages", f"array<{PASSAGE}>", kind),
    ])
    return scored.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(names)], *results)
