"""Quality classifier: histogram gradient-boosted trees over document statistics.

``document_statistics`` turns a text into fixed numbers, ``fit`` grows the
trees on binned statistics, and ``Forest`` keeps all trees in flat arrays that
numpy walks for a whole batch at a time.

Defined results: a NULL text counts as empty and is scored like any text; a
repeated row is scored each time; without labelled rows every text gets the
score 0.5; an empty table gives an empty result. Columns other than the
identifier and the text are never read, so their names do not matter.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakestrata.llm.common import Batches, crc32_of, pylist, record_batch, text_of, utf32

# Labelled rows that are learned from: the bound on what reaches the driver.
TRAIN_ROWS = 20_000
FOLDS = 5
THRESHOLD = 0.3

STATISTICS = [
    "log_chars", "log_words", "upper", "digit", "space", "non_ascii", "punctuation", "symbol", "pipe", "exclamation",
    "word_length", "word_length_spread", "distinct_words", "repeated_next", "top_word", "capitalised",
    "ends_in_letter", "sentence_ends", "log_lines", "line_length", "repeated_lines", "longest_word",
]


def _character_groups() -> np.ndarray:
    """Class of each code point below 256: bit set of the character groups."""
    groups = np.zeros(256, dtype=np.uint8)
    for code in range(256):
        char = chr(code)
        groups[code] = (
            1 * char.isupper() | 2 * char.isdigit() | 4 * char.isspace() | 8 * (code > 127)
            | 16 * (char in ".,;:'\"()?-") | 32 * (char in "#$%&*@^~=<>{}[]\\_+/`") | 64 * (char == "|") | 128 * (char == "!")
        )
    return groups


CHARACTER_GROUPS = _character_groups()


def document_statistics(text: str) -> list[float]:
    """The numbers a text is judged by, in the order of ``STATISTICS``."""
    codes = utf32(text)
    n = max(len(codes), 1)
    kinds = CHARACTER_GROUPS[np.minimum(codes, 255)]
    counts = np.bincount(kinds, minlength=256)
    share = [counts[(np.arange(256) & bit) > 0].sum() / n for bit in (1, 2, 4, 8, 16, 32, 64, 128)]
    words = text.split()
    nw = len(words)
    if nw:
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=nw)
        frequency = Counter(words)
        word = [
            lengths.mean(), lengths.std(), len(frequency) / nw,
            sum(map(str.__eq__, words, words[1:])) / nw, max(frequency.values()) / nw,
            sum(w[0].isupper() for w in words) / nw, sum(w[-1].isalpha() for w in words) / nw,
            sum(w[-1] == "." for w in words) / nw,
        ]
        longest = float(lengths.max())
    else:
        word, longest = [0.0] * 8, 0.0
    lines = [line for line in text.split("\n") if line.strip()]
    nl = len(lines)
    line = [np.log1p(nl), len(text) / max(nl, 1), 1 - len(set(lines)) / nl if nl else 0.0]
    return [float(x) for x in [np.log1p(len(text)), np.log1p(nw), *share, *word, *line, np.log1p(longest)]]


@dataclass(frozen=True)
class Forest:
    """All trees in flat arrays; a leaf points at itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root, dtype=np.int32)
            for _ in range(self.depth):
                goes_left = x[rows, self.feature[node]] <= self.threshold[node]
                node = np.where(goes_left, self.left[node], self.right[node])
            total += self.value[node]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.raw(x), -30, 30)))


def _split(g, h, binned, rows, n_bins, l2, min_weight):
    """Best (gain, feature, bin) of one node, from histograms of all features."""
    n_features = binned.shape[1]
    keys = (binned[rows] + np.arange(n_features) * n_bins).ravel()
    size = n_features * n_bins
    hg = np.bincount(keys, weights=np.repeat(g[rows], n_features), minlength=size).reshape(n_features, n_bins)
    hh = np.bincount(keys, weights=np.repeat(h[rows], n_features), minlength=size).reshape(n_features, n_bins)
    gl, hl = hg.cumsum(axis=1), hh.cumsum(axis=1)
    total_g, total_h = gl[0, -1], hl[0, -1]
    gr, hr = total_g - gl, total_h - hl
    gain = gl**2 / (hl + l2) + gr**2 / (hr + l2) - total_g**2 / (total_h + l2)
    gain[(hl < min_weight) | (hr < min_weight)] = 0
    best = int(gain.argmax())
    return float(gain.flat[best]), best // n_bins, best % n_bins


def fit(
    x: np.ndarray, y: np.ndarray, *, trees: int = 60, depth: int = 4, rate: float = 0.15,
    bins: int = 64, l2: float = 1.0, min_weight: float = 1.0, min_gain: float = 1e-6,
) -> Forest:
    """Grow trees on the logistic loss; statistics are cut at their quantiles."""
    empty = np.zeros(0, dtype=np.int32)
    if not len(y):
        return Forest(empty, empty.astype(float), empty, empty, empty.astype(float), empty, depth, 0.0)
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T)], axis=1)
    rate_of_ones = (y.sum() + 1) / (len(y) + 2)
    bias = float(np.log(rate_of_ones / (1 - rate_of_ones)))
    raw = np.full(len(y), bias)
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def add() -> int:
        node = len(feature)
        feature.append(0), threshold.append(np.inf), left.append(node), right.append(node), value.append(0.0)
        return node

    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        root = add()
        roots.append(root)
        level = [(root, np.arange(len(y)))]
        for step in range(depth + 1):
            following = []
            for node, rows in level:
                gain, f, b = (0.0, 0, 0) if step == depth else _split(g, h, binned, rows, bins, l2, min_weight)
                if gain <= min_gain or b >= len(edges[f]):
                    value[node] = float(-rate * g[rows].sum() / (h[rows].sum() + l2))
                    raw[rows] += value[node]
                    continue
                feature[node], threshold[node] = f, float(edges[f][b])
                goes_left = binned[rows, f] <= b
                left[node], right[node] = add(), add()
                following += [(left[node], rows[goes_left]), (right[node], rows[~goes_left])]
            level = following
    return Forest(
        np.array(feature, np.int32), np.array(threshold), np.array(left, np.int32), np.array(right, np.int32),
        np.array(value), np.array(roots, np.int32), depth, bias,
    )


def _statistics_of(batches: Batches, schema: pa.Schema) -> Batches:
    for batch in batches:
        yield record_batch({
            "doc_id": batch.column(0), "quality": batch.column(1),
            "statistics": [document_statistics(t) for t in pylist(batch, "text")],
        }, schema)


def train(docs: DataFrame, labels: DataFrame, *, max_rows: int = TRAIN_ROWS) -> Forest:
    """Fit on at most ``max_rows`` labelled texts outside the held-out fold.

    The rows with the smallest hash of their identifier are taken, so the
    sample does not depend on file order. Only their statistics reach the
    driver. A text labelled twice counts with its larger label.
    """
    learned = (
        labels.where(F.col("quality").isNotNull() & (crc32_of("doc_id") % FOLDS != 0))
        .groupBy("doc_id").agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    )
    chosen = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(learned), "doc_id")
    schema = pa.schema([("doc_id", pa.int64()), ("quality", pa.int64()), ("statistics", pa.list_(pa.float64()))])
    rows = (
        chosen.select(F.col("doc_id").cast("long"), F.col("quality").cast("long"), "text")
        .mapInArrow(lambda it: _statistics_of(it, schema), "doc_id long, quality long, statistics array<double>")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "statistics").limit(max_rows).collect()
    )
    x = np.array([r["statistics"] for r in rows], dtype=float).reshape(len(rows), len(STATISTICS))
    return fit(x, np.array([float(r["quality"] > 0) for r in rows]))


def score(docs: DataFrame, forest: Forest, *, keep: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """The columns ``keep`` of every row with its ``score`` and ``predicted``.

    A column of ``keep`` with one of these two names is replaced.
    """
    keep = [c for c in keep if c not in ("score", "predicted")]
    source = docs.select(*[F.col(f"`{c}`") for c in keep], text_of().alias("_scored_text"))
    out = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1]), "score double, predicted int"])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            x = np.array([document_statistics(t) for t in pylist(batch, "_scored_text")], dtype=float)
            values = forest.score(x.reshape(batch.num_rows, len(STATISTICS)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(values), pa.array((values >= threshold).astype(np.int32))],
                names=[*batch.schema.names[:-1], "score", "predicted"],
            )

    return source.mapInArrow(run, out)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows the classifier accepts, columns unchanged."""
    forest = train(docs, labels)
    names = docs.columns
    plain = docs.select(*[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(names)], text_of().alias("text"))
    scored = score(plain, forest, keep=[f"_c{i}" for i in range(len(names))])
    return scored.where(F.col("predicted") == 1).select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(names)])
