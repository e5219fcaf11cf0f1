"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text is cut into bins at quantiles. Boosting goes round the
features in turn: a tree of three leaves over the feature's bins is fitted to the
gradient of the logistic loss and added, damped, to the feature's lookup
table. The pairs of features that explain most of what is left get tables of
their own, boosted the same way by trees of two levels. A score is the sigmoid of an
intercept and one table entry per feature and pair.

The model is fitted on at most `bound` labelled rows, chosen by a hash of the
doc_id; every row is scored, from its whole text.

Defined results: a null or empty text has all features 0; labels that are null
or contradict each other for an id are left out; a table without usable labels or
with one label only scores every row by its prior (0.5 without any);
repeated rows get equal scores; an empty table gives an empty result. Input
columns named like a result column are replaced, others kept; features are taken from
whole texts of any length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelmart.llm.common import doc_key, quoted, without

# Labelled rows the model is fitted on at most.
BOUND = 20_000
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS = 120, 40
PAIRS = 8
RATE = 0.15
# Weight that pulls leaves towards 0.
RIDGE = 2.0

FEATURES = (
    "log_words",
    "log_chars",
    "word_chars",
    "upper_letters",
    "symbols",
    "digits",
    "word_repeats_previous",
    "distinct_words",
    "most_frequent_word",
    "words_without_letters",
    "words_ending_in_symbols",
    "repeated_lines",
    "log_line_chars",
    "character_entropy",
    "sentence_words",
    "capital_words",
)

_SENTENCE_END = re.compile(r"[.!?]+(?=\s|$)")
_SYMBOL_END = re.compile(r"[^\w\s.,;:'\")]+(?=\s|$)")
_CAPITAL = re.compile(r"(?:^|(?<=\s))[^\W\d_a-zß-öø-ÿ]")
_CODES = 1 << 12


def _class_table() -> np.ndarray:
    """For code points below _CODES: 1 letter, 2 upper-case letter, 4 digit, 8 white space."""
    marks = lambda c: c.isalpha() + 2 * c.isupper() + 4 * c.isdigit() + 8 * c.isspace()
    return np.array([marks(chr(i)) for i in range(_CODES)], np.uint8)


_CLASSES = _class_table()


def features(text: str | None) -> list[float]:
    """The features of one text, in the order of FEATURES."""
    text = text or ""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    # Code points beyond the table count as lower-case letters.
    kinds = _CLASSES[np.minimum(codes, _CODES - 1)] if codes.max() < _CODES else np.where(codes < _CODES, _CLASSES[np.minimum(codes, _CODES - 1)], 1)
    tally = np.bincount(kinds, minlength=16)
    has = lambda bit: int(sum(tally[k] for k in range(16) if k & bit))
    letters, spaces = has(1), has(8)
    shown = max(1, len(codes) - spaces)
    seen = np.bincount(np.minimum(codes, _CODES - 1)[(kinds & 8) == 0])
    share = seen[seen > 0] / shown
    n, counts = len(words), Counter(words)
    lines = [line for line in text.split("\n") if line.strip()]
    return [
        float(np.log1p(n)),
        float(np.log1p(len(codes))),
        shown / n,
        has(2) / max(1, letters),
        (shown - letters - has(4)) / shown,
        has(4) / shown,
        sum(map(str.__eq__, words, words[1:])) / n,
        len(counts) / n,
        max(counts.values()) / n,
        sum(1 for w in counts.elements() if not any(map(str.isalnum, w))) / n if tally[0] else 0.0,
        len(_SYMBOL_END.findall(text)) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        float(np.log1p(len(codes) / max(1, len(lines)))),
        float(-(share * np.log2(share)).sum()),
        n / max(1, len(_SENTENCE_END.findall(text))),
        len(_CAPITAL.findall(text)) / n,
    ]


@dataclass
class Model:
    """Cuts and lookup tables; `score` is vectorised over rows."""

    intercept: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for k, table in enumerate(self.tables):
            total += table[np.searchsorted(self.cuts[k], x[:, k], side="right")]
        if self.pairs:
            coarse = [np.searchsorted(cuts, x[:, k], side="right") for k, cuts in enumerate(self.pair_cuts)]
            for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
                total += table[coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """At most bins - 1 distinct quantiles; values above a cut's lie right of it."""
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(g, h):
    return g * g / (h + RIDGE)


def _leaf_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values per bin of the best tree of up to three leaves."""
    spans = [(0, len(g))]
    for _ in range(2):
        best = (1e-9, None)
        for a, b in spans:
            if b - a < 2:
                continue
            gl, hl = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
            gt, ht = g[a:b].sum(), h[a:b].sum()
            gains = _gain(gl, hl) + _gain(gt - gl, ht - hl) - _gain(gt, ht)
            at = int(np.argmax(gains))
            if gains[at] > best[0]:
                best = (gains[at], (a, a + at + 1, b))
        if best[1] is None:
            break
        a, m, b = best[1]
        spans.remove((a, b))
        spans += [(a, m), (m, b)]
    out = np.zeros(len(g))
    for a, b in spans:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best cut along one axis followed by one cut of each side along the other."""
    best, out = 0.0, np.zeros_like(g)
    for turned in (False, True):
        gg, hh = (g.T, h.T) if turned else (g, h)
        whole = _gain(gg.sum(), hh.sum())
        for cut in range(1, gg.shape[0]):
            gain, value = -whole, np.zeros_like(gg)
            for rows in (slice(0, cut), slice(cut, None)):
                sg, sh = gg[rows].sum(axis=0), hh[rows].sum(axis=0)
                gl, hl = np.cumsum(sg)[:-1], np.cumsum(sh)[:-1]
                if not len(gl):
                    gain += _gain(sg.sum(), sh.sum())
                    value[rows] = sg.sum() / (sh.sum() + RIDGE)
                    continue
                gains = _gain(gl, hl) + _gain(sg.sum() - gl, sh.sum() - hl)
                at = int(np.argmax(gains))
                gain += gains[at]
                value[rows, : at + 1] = gl[at] / (hl[at] + RIDGE)
                value[rows, at + 1 :] = (sg.sum() - gl[at]) / (sh.sum() - hl[at] + RIDGE)
            if gain > best:
                best, out = float(gain), (value.T if turned else value)
    return best, out


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Boost the tables on rows x (float) with labels y (0 or 1)."""
    if not len(y) or y.min() == y.max():
        prior = 0.5 if not len(y) else (y.sum() + 1) / (len(y) + 2)
        return Model(intercept=float(np.log(prior / (1 - prior))))
    width = x.shape[1]
    prior = y.mean()
    model = Model(intercept=float(np.log(prior / (1 - prior))))
    model.cuts = [_cuts(x[:, k], BINS) for k in range(width)]
    binned = [np.searchsorted(model.cuts[k], x[:, k], side="right") for k in range(width)]
    model.tables = [np.zeros(len(model.cuts[k]) + 1) for k in range(width)]
    total = np.full(len(y), model.intercept)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for k in range(width):
            g, h = slopes()
            size = len(model.tables[k])
            step = RATE * _leaf_tree(np.bincount(binned[k], g, size), np.bincount(binned[k], h, size))
            model.tables[k] += step
            total += step[binned[k]]
    model.pair_cuts = [_cuts(x[:, k], PAIR_BINS) for k in range(width)]
    coarse = [np.searchsorted(model.pair_cuts[k], x[:, k], side="right") for k in range(width)]
    size = lambda k: len(model.pair_cuts[k]) + 1

    def grids(a, b):
        g, h = slopes()
        cell = coarse[a] * size(b) + coarse[b]
        shape = (size(a), size(b))
        return np.bincount(cell, g, shape[0] * shape[1]).reshape(shape), np.bincount(cell, h, shape[0] * shape[1]).reshape(shape)

    ranked = sorted(((_pair_tree(*grids(a, b))[0], a, b) for a in range(width) for b in range(a + 1, width)), reverse=True)
    model.pairs = [(a, b) for gain, a, b in ranked[:PAIRS] if gain > 0]
    model.pair_tables = [np.zeros((size(a), size(b))) for a, b in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (a, b), table in zip(model.pairs, model.pair_tables, strict=True):
            step = RATE * _pair_tree(*grids(a, b))[1]
            table += step
            total += step[coarse[a], coarse[b]]
    return model


def may_teach(doc_id: Column | str = "doc_id") -> Column:
    return doc_key(doc_id) % 3 != 1


def training_rows(docs: DataFrame, labels: DataFrame, bound: int = BOUND) -> DataFrame:
    """Features and labels of at most `bound` rows that may teach, by hash of the doc_id."""
    usable = labels.where(may_teach() & F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    one = usable.groupBy("doc_id").agg(F.min("quality").alias("y"), F.max("quality").alias("other")).where("y = other").select("doc_id", "y")
    # Bounded by a parameter, so its broadcast is.
    chosen = F.broadcast(one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound))
    texts = docs.select("doc_id", "text").join(chosen, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "y", "x"])

    kinds = dict(texts.dtypes)
    found = texts.select("doc_id", "y", "text").mapInArrow(run, f"doc_id {kinds['doc_id']}, y {kinds['y']}, x array<double>")
    return found.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("x")).limit(bound)


def train(docs: DataFrame, labels: DataFrame, bound: int = BOUND) -> Model:
    rows = training_rows(docs, labels, bound).toArrow()
    x = np.array(rows.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
    return fit(x, rows.column("y").to_numpy().astype(float))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with `score` (higher: better) and `predicted` (1 if score >= 0.5)."""
    kept = without(docs, "score", "predicted")
    at = kept.columns.index("text")
    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(text) for text in batch.column(at).to_pylist()], float).reshape(-1, len(FEATURES))
            score = model.score(x)
            added = [pa.array(score), pa.array((score >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "score", "predicted"])

    return kept.mapInArrow(run, schema)


def good_documents(docs: DataFrame, labels: DataFrame, bound: int = BOUND) -> DataFrame:
    """The rows of `docs` that the classifier trained on `labels` accepts, columns as given."""
    marked = docs.select(F.struct(*(F.col(quoted(c)) for c in docs.columns)).alias("row"), "text")
    passed = scored(marked, train(docs, labels, bound)).where("predicted = 1")
    return passed.select("row.*")
