"""Quality classifier: a generalised additive model with pairwise interactions (operator 8).

Each feature is cut into bins at quantiles of a bounded labelled sample. Boosting goes round the features in turn:
a shallow tree on one feature's bins takes a small step along the gradient of the log loss, and its leaf values are
added to that feature's lookup table. When the main effects are done, the pairs that explain most of what is left get
two-dimensional tables in the same way. A score is a sum of table entries: one bin search and one addition for each
feature and pair, over whole arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom.llm.learn import batch_texts, held_out, labelled, sigmoid
from webloom.llm.outliers import _line_counts
from webloom.llm.storage import arrow_map
from webloom.llm.words import U64, Words, free_name, mix, slices

#: Labelled rows to learn from, about; bins; boosting rounds for main effects and pairs; step; pairs kept.
TRAIN_ROWS, BINS, ROUNDS, PAIR_ROUNDS, STEP, PAIRS = 20_000, 32, 150, 60, 0.15, 5
#: Rows of a leaf at least, and the weight of the prior towards zero in a leaf.
LEAF_ROWS, RIDGE = 20, 5.0
THRESHOLD = 0.3

FEATURES = ("log_words", "word_length", "longest_word", "symbols", "pipes", "bangs", "digits", "upper", "commas_stops",
            "dup_lines", "words_per_line", "repeat_next", "distinct", "repeat_windows", "non_ascii")


def _byte_class(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_CLASSES = {"symbols": _byte_class("#*$%&<>"), "pipes": _byte_class("|"), "bangs": _byte_class("!?"),
            "digits": _byte_class("0123456789"), "upper": _byte_class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
            "commas_stops": _byte_class(",.;:")}


def features(data: np.ndarray, offs: np.ndarray, texts: list[str]) -> np.ndarray:
    """One row of FEATURES for each text of a slice; an empty text gives zeros."""
    w, n = Words(data, offs), len(offs) - 1
    words = np.maximum(w.count, 1).astype(float)
    h = w.hashes()
    size = (w.end - w.start).astype(float)

    def by_row(values: np.ndarray) -> np.ndarray:
        upto = np.concatenate([[0.0], np.cumsum(values)])
        return upto[w.first[1:]] - upto[w.first[:-1]]

    def in_text(mask: np.ndarray) -> np.ndarray:
        upto = np.concatenate([[0], np.cumsum(mask)])
        return (upto[offs[1:]] - upto[offs[:-1]]).astype(float)

    out = {"log_words": np.log1p(w.count), "word_length": by_row(size) / words}
    longest = np.zeros(n)
    np.maximum.at(longest, w.row, size)
    out["longest_word"] = np.log1p(longest)
    for name, mask in _CLASSES.items():
        out[name] = in_text(mask[data]) / words
    out["upper"] = out["upper"] * words / np.maximum(by_row(size), 1)
    out["non_ascii"] = in_text(data >= 0x80) / np.maximum(by_row(size), 1)
    lines = np.array([_line_counts(t) for t in texts], float).reshape(n, 2)
    out["dup_lines"] = lines[:, 1] / np.maximum(lines[:, 0], 1)
    out["words_per_line"] = np.log1p(w.count / np.maximum(lines[:, 0], 1))
    follows = np.zeros(len(h))
    if len(h) > 1:
        follows[1:] = (h[1:] == h[:-1]) & (w.row[1:] == w.row[:-1])
    out["repeat_next"] = by_row(follows) / words

    def new_share(at_rows: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Distinct values over values, by row (1 without values)."""
        key = mix(values ^ (at_rows.astype(U64) * U64(0x9E3779B97F4A7C15)))
        _, first = np.unique(key, return_index=True)
        total = np.bincount(at_rows, minlength=n)
        return np.where(total > 0, np.bincount(at_rows[first], minlength=n) / np.maximum(total, 1), 1.0)

    out["distinct"] = new_share(w.row, h)
    at, win = w.windows(4)
    out["repeat_windows"] = 1 - new_share(w.row[at], win)
    return np.column_stack([out[f] for f in FEATURES])


class AdditiveModel:
    """Intercept, a table for each feature and a table for each kept pair."""

    def __init__(self, cuts: list[np.ndarray], intercept: float, tables: list[np.ndarray], pairs: list[tuple[int, int, np.ndarray]]):
        self.cuts, self.intercept, self.tables, self.pairs = cuts, intercept, tables, pairs

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(c, x[:, k], "right") for k, c in enumerate(self.cuts)]) if len(x) \
            else np.zeros((0, len(self.cuts)), int)

    def score(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        z = np.full(len(x), self.intercept)
        for k, table in enumerate(self.tables):
            z += table[b[:, k]]
        for p, q, table in self.pairs:
            z += table[b[:, p], b[:, q]]
        return sigmoid(z)


def _value(g: np.ndarray | float, h: np.ndarray | float):
    return g / (h + RIDGE)


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf value for each bin of a tree of ``depth`` cuts deep, from sums of gradient, hessian and rows by bin."""
    out = np.full(len(g), _value(g.sum(), h.sum()))
    if depth and len(g) > 1:
        gl, hl, nl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
        gr, hr, nr = g.sum() - gl, h.sum() - hl, n.sum() - nl
        gain = np.where((nl >= LEAF_ROWS) & (nr >= LEAF_ROWS), gl * gl / (hl + RIDGE) + gr * gr / (hr + RIDGE), -1.0)
        k = int(gain.argmax())
        if gain[k] > g.sum() ** 2 / (h.sum() + RIDGE) + 1e-9:
            out = np.concatenate([_tree(g[:k + 1], h[:k + 1], n[:k + 1], depth - 1), _tree(g[k + 1:], h[k + 1:], n[k + 1:], depth - 1)])
    return out


def _corner(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Best cut of both sides of a pair into four leaves: (gain over one leaf, value of each cell)."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    def quads(c):
        a = c[:-1, :-1]
        return a, c[:-1, -1:] - a, c[-1:, :-1] - a, c[-1, -1] - c[:-1, -1:] - c[-1:, :-1] + a
    parts = list(zip(quads(cg), quads(ch), strict=True))
    gain = sum(x * x / (y + RIDGE) for x, y in parts)
    if not gain.size:
        return 0.0, np.zeros_like(g)
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    out = np.empty_like(g)
    v = [_value(x[i, j], y[i, j]) for x, y in parts]
    out[:i + 1, :j + 1], out[:i + 1, j + 1:], out[i + 1:, :j + 1], out[i + 1:, j + 1:] = v
    return float(gain[i, j] - g.sum() ** 2 / (h.sum() + RIDGE)), out


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Cyclic boosting on a sample in memory. Without rows, or with one class, the model is its intercept."""
    share = (y.sum() + 1.0) / (len(y) + 2.0)
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.zeros(0) for k in range(x.shape[1])]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    model = AdditiveModel(cuts, float(np.log(share / (1 - share))), tables, [])
    if not len(x) or y.min() == y.max():
        return model
    b, z = model.bins(x), np.full(len(y), model.intercept)
    rows = [np.bincount(b[:, k], minlength=len(t)) for k, t in enumerate(tables)]
    for _ in range(ROUNDS):
        for k, t in enumerate(tables):
            p = sigmoid(z)
            step = STEP * _tree(np.bincount(b[:, k], y - p, len(t)), np.bincount(b[:, k], p * (1 - p), len(t)), rows[k])
            t += step
            z += step[b[:, k]]
    p = sigmoid(z)
    g, h = y - p, p * (1 - p)
    ranked = []
    for i in range(len(tables)):
        for j in range(i + 1, len(tables)):
            shape = (len(tables[i]), len(tables[j]))
            cell = b[:, i] * shape[1] + b[:, j]
            gain, _ = _corner(*(np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in (g, h)))
            ranked.append((-gain, i, j))
    model.pairs = [(i, j, np.zeros((len(tables[i]), len(tables[j])))) for _, i, j in sorted(ranked)[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for i, j, t in model.pairs:
            p = sigmoid(z)
            cell = b[:, i] * t.shape[1] + b[:, j]
            _, leaf = _corner(*(np.bincount(cell, v, t.size).reshape(t.shape) for v in (y - p, p * (1 - p))))
            t += STEP * leaf
            z += STEP * leaf[b[:, i], b[:, j]]
    return model


def _by_slice(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, np.ndarray]]:
    data, offs = batch_texts(batch, column)
    for i, j in slices(offs):
        texts = [t.as_py() or "" for t in batch.column(column).slice(i, j - i)]
        yield i, j, features(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], texts)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          folds: int = 5, rest: int = 0, train_rows: int = TRAIN_ROWS) -> AdditiveModel:
    """Features of about ``train_rows`` labelled documents outside the held-out fold are made by Spark; the sample of
    numbers (a row of FEATURES each) is fitted on the driver."""
    chosen = labelled(labels, docs, label_col, folds, rest, train_rows, id_col, text_col)
    schema = "id string, y int, x array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, x in _by_slice(batch, 2):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(list(x), pa.list_(pa.float64()))],
                                                 names=["id", "y", "x"])

    got = arrow_map(chosen.select(F.col("id").cast("string"), "y", "text"), run, schema).toArrow().sort_by("id")
    x = np.array(got["x"].to_pylist(), float).reshape(-1, len(FEATURES))
    return fit(x, got["y"].to_numpy().astype(float))


def score(docs: DataFrame, model: AdditiveModel, text_col: str = "text", as_col: str = "score") -> DataFrame:
    """``docs`` with a column of scores, every other column as it was.

    A null or empty text is scored like a text of no words. Repeated rows get equal scores; an empty table stays
    empty. A column that is called like ``as_col`` already is kept, and the score gets underscores before its name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    name = free_name(docs.columns, as_col)
    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema, T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, x in _by_slice(batch, at):
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(shared.value.score(x))], names=schema.names)

    return arrow_map(docs, run, schema)


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            folds: int = 5, rest: int = 0) -> DataFrame:
    """One row for each row of ``docs``: id, held_out, score (higher: label 1 likelier), predicted (1 from 0.3 on)."""
    model = train(docs, labels, id_col, text_col, folds=folds, rest=rest)
    out = score(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), model)
    return out.select(F.col("id").alias(id_col), held_out("id", folds, rest).alias("held_out"), "score", predicted(F.col("score")).alias("predicted"))


def predicted(score_col: Column) -> Column:
    return (score_col >= THRESHOLD).cast("int")
