"""Counterfactually regularised toxicity classifier (operator 9).

A logistic model over the presence of hashed words and character runs. Besides log loss and ridge it is fitted with a
penalty on score changes: in labelled sentences that name a group, the identity term is swapped for others of its kind,
and the squared change of the linear score is pressed towards zero. A neutral mention of one group thus scores like
the same sentence about another, and group names carry no weight of their own.
"""

from __future__ import annotations

import collections
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom.llm.gam import predicted
from webloom.llm.learn import Chars, batch_texts, held_out, labelled, sigmoid
from webloom.llm.storage import arrow_map, saved
from webloom.llm.words import slices, text_bytes

#: Labelled rows to learn from, about; hashed features; features kept; ridge; counterfactual penalty; texts that a
#: weight needs; steps.
TRAIN_ROWS, BITS, KEPT, RIDGE, FAIRNESS, PULL, STEPS = 20_000, 22, 4_096, 1e-5, 1.0, 3.0, 400
#: A kept feature is in this many sampled texts at least; parts that the sample is read in.
MIN_TEXTS, SAMPLE_PARTS = 5, 12
RUNS = (5, 7)

# Identity terms by kind; terms of one kind stand in for each other.
IDENTITY = (
    ("women", "men", "girls", "boys"), ("woman", "man", "girl", "boy"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"), ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"), ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "foreigners", "natives"), ("old", "young"), ("disabled", "deaf", "blind"),
    ("frauen", "männer", "mädchen", "jungen"), ("christen", "muslime", "juden", "hindus"),
    ("femmes", "hommes", "filles", "garçons"), ("chrétiens", "musulmans", "juifs", "hindous"),
    ("mujeres", "hombres", "niñas", "niños"), ("cristianos", "musulmanes", "judíos", "hindúes"),
)
_KIND = {t: (k, i) for k, kind in enumerate(IDENTITY) for i, t in enumerate(kind)}
_TERM = re.compile(r"(?<![^\W\d_])(?:" + "|".join(sorted(map(re.escape, _KIND), key=len, reverse=True)) + r")(?![^\W\d_])", re.IGNORECASE)


def text_features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hashed feature) of a slice, repeats included: whole words, and runs of 5 and 7 characters inside words
    (a word's leading space counts as a character)."""
    c = Chars(data, offs)
    p, rows, feats = c.points, [], []
    letter = p != 32
    if len(p):
        start = letter.copy()
        start[1:] &= ~letter[:-1] | (c.row[1:] != c.row[:-1])
        begin = np.flatnonzero(start)
        mixed = (p.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        # order matters: each character's hash is turned by its place in the word
        place = np.arange(len(p)) - begin[np.maximum(np.cumsum(start) - 1, 0)] if len(begin) else np.zeros(len(p), int)
        mixed *= (2 * place.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9) | np.uint64(1)
        if len(begin):
            sums = np.add.reduceat(np.where(letter, mixed, np.uint64(0)), begin)
            rows.append(c.row[begin])
            feats.append(((sums ^ (sums >> np.uint64(31))) * np.uint64(0x94D049BB133111EB) >> np.uint64(64 - BITS)).astype(np.int64))
        gaps = np.concatenate([[0], np.cumsum(~letter)])
        for n in RUNS:
            if len(p) >= n:
                r, h = c.grams(n)
                inside = np.flatnonzero(c.row[:len(p) - n + 1] == c.row[n - 1:])
                inner = gaps[inside + n] - gaps[inside + 1] == 0  # a space may only come first
                rows.append(r[inner])
                feats.append((h[inner] >> np.uint32(32 - BITS)).astype(np.int64))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(feats)


def _presence(rows: np.ndarray, feats: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, kept feature) pairs; ``place`` maps a hashed feature to its number or -1."""
    at = place[feats]
    on = at >= 0
    key = np.unique(rows[on] * np.int64(KEPT) + at[on])
    return key // KEPT, key % KEPT


def swapped(text: str) -> list[tuple[str, str]]:
    """(sentence, the same with one identity term swapped): every mention of the text, every other term of its kind."""
    out: list[tuple[str, str]] = []
    for sentence in re.split(r"(?<=[.!?])\s+|\n", text) if _TERM.search(text) else ():
        for m in _TERM.finditer(sentence):
            k, i = _KIND[m.group().lower()]
            for other in IDENTITY[k][:i] + IDENTITY[k][i + 1:]:
                out.append((sentence, sentence[:m.start()] + other + sentence[m.end():]))
    return out


def _term_features(word: str, behind: bool, place: np.ndarray, known: dict) -> dict[int, int]:
    """Kept features of one word with their number; ``behind``: letters stand before it, so its space counts."""
    if (word, behind) not in known:
        feats = text_features(*text_bytes(pa.array(["q " + word if behind else word])))[1]
        if behind:  # without those of the letter that stands for what is before
            lone = text_features(*text_bytes(pa.array(["q"])))[1]
            feats = np.delete(feats, np.flatnonzero(feats == lone[0])[:1])
        at = place[feats]
        values, n = np.unique(at[at >= 0], return_counts=True)
        known[word, behind] = dict(zip(values.tolist(), n.tolist(), strict=True))
    return known[word, behind]


def swap_changes(text: str, place: np.ndarray, known: dict) -> list[tuple[int, ...]]:
    """For each swap of ``swapped`` the kept features that it takes from the sentence (-1 - feature) and brings to it.

    Features lie inside words, so a swap changes those of the term alone: a sentence is read once, whatever its length
    and the number of its mentions.
    """
    out: list[tuple[int, ...]] = []
    for sentence in re.split(r"(?<=[.!?])\s+|\n", text) if _TERM.search(text) else ():
        mentions = list(_TERM.finditer(sentence))
        if not mentions:
            continue
        at = place[text_features(*text_bytes(pa.array([sentence])))[1]]
        values, n = np.unique(at[at >= 0], return_counts=True)
        have = dict(zip(values.tolist(), n.tolist(), strict=True))
        first = next((k for k, c in enumerate(sentence) if c.isalpha()), 0)
        for m in mentions:
            word, behind = m.group().lower(), m.start() > first
            old = _term_features(word, behind, place, known)
            k, i = _KIND[word]
            for other in IDENTITY[k][:i] + IDENTITY[k][i + 1:]:
                new = _term_features(other, behind, place, known)
                gone = [-1 - f for f, c in old.items() if have.get(f, 0) == c and f not in new]
                come = [f for f in new if f not in have]
                out.append(tuple(sorted(gone + come)))
    return out


class ToxicityModel:
    """Weights of the kept features. ``place`` finds a kept feature by its hash."""

    def __init__(self, kept: np.ndarray, weights: np.ndarray, intercept: float):
        self.kept, self.weights, self.intercept = kept, weights, intercept
        self.place = np.full(1 << BITS, -1, np.int32)
        self.place[kept] = np.arange(len(kept))

    def score(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        rows, at = _presence(*text_features(data, offs), self.place)
        return sigmoid(self.intercept + np.bincount(rows, self.weights[at], len(offs) - 1))


def _features_of(texts: list[str], place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data, offs = text_bytes(pa.array(texts, pa.string()))
    return _presence(*text_features(data, offs), place)


def fit(rows: np.ndarray, at: np.ndarray, y: np.ndarray, n_features: int, swaps: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray],
        fairness: float = FAIRNESS) -> tuple[np.ndarray, float]:
    """Weights and intercept by accelerated proximal gradient steps on

    log loss + RIDGE |w|^2 + fairness * mean((score(sentence) - score(swapped sentence))^2) + PULL / n * |w|_1.

    (rows, at): presence pairs of the texts; swaps: (pair number, feature, +1 or -1) triples and the weight of each pair;
    the mean is by weight, and the pairs of one text have a weight of one together, however many they are.
    The 1-norm keeps only weights that more than about PULL texts speak for.
    """
    n = len(y)
    share = (y.sum() + 1.0) / (n + 2.0)
    w, c = np.zeros(n_features), float(np.log(share / (1 - share)))
    if not n_features:
        return w, c
    pair, feat, sign, weight = swaps
    weight = weight / max(weight.sum(), 1e-12)

    def smooth(v: np.ndarray) -> np.ndarray:
        """Gradient of ridge and counterfactual penalty."""
        out = 2 * RIDGE * v
        if len(weight):
            change = weight * np.bincount(pair, sign * v[feat], len(weight))
            out += 2 * fairness * np.bincount(feat, sign * change[pair], n_features)
        return out

    u = np.ones(n_features)  # largest curvature, by power steps; the log loss curves by a quarter at most
    for _ in range(30):
        u /= np.linalg.norm(u)
        u = np.bincount(at, np.bincount(rows, u[at], n)[rows], n_features) / (4 * n) + smooth(u)
    step = 1 / (1.05 * np.linalg.norm(u) + 0.25)
    v, cv, t = w, c, 1.0
    for _ in range(STEPS):
        d = (sigmoid(cv + np.bincount(rows, v[at], n)) - y) / n
        new = v - step * (np.bincount(at, d[rows], n_features) + smooth(v))
        new = np.sign(new) * np.maximum(np.abs(new) - step * PULL / n, 0.0)
        new_c, after = cv - step * d.sum(), (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, cv = new + (t - 1) / after * (new - w), new_c + (t - 1) / after * (new_c - c)
        w, c, t = new, new_c, after
    return w, c


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          folds: int = 4, rest: int = 2, train_rows: int = TRAIN_ROWS, fairness: float = FAIRNESS) -> ToxicityModel:
    """Two passes of Spark over about ``train_rows`` labelled documents outside the held-out fold: counts of texts by
    feature and label choose the KEPT features that tell most, then the presence pairs of those (and the swapped
    sentences) come to the driver, where the model is fitted."""
    chosen = labelled(labels, docs, label_col, folds, rest, train_rows, id_col, text_col).select(F.col("id").cast("string").alias("id"), "y", "text")
    everything = np.arange(1 << BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 << BITS), np.int32)
        texts = [0, 0]
        for batch in batches:
            y = batch.column(1).to_numpy(zero_copy_only=False) > 0
            data, offs = batch_texts(batch, 2)
            for i, j in slices(offs):
                rows, feats = text_features(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                key = np.unique(rows * np.int64(1 << BITS) + feats)
                rows, feats = key >> BITS, key & ((1 << BITS) - 1)
                for label in (0, 1):
                    np.add.at(total[label], feats[y[i:j][rows] == label], 1)
                    texts[label] += int((y[i:j] == label).sum())
        seen = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(seen, -1)), pa.array(np.append(total[0][seen].astype(np.int64), texts[0])), pa.array(np.append(total[1][seen].astype(np.int64), texts[1]))],
                                         names=["f", "n0", "n1"])

    # the sample is bounded and read twice, so it is written once, in a few parts: each part sends one row for each
    # feature it has seen
    chosen = saved(chosen.repartition(SAMPLE_PARTS))
    got = arrow_map(chosen, count, "f long, n0 long, n1 long").groupBy("f").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    sums = got.filter(F.col("f") < 0).first()
    n0, n1 = (sums.n0, sums.n1) if sums else (0, 0)
    if not n0 or not n1:
        return ToxicityModel(everything[:0], np.zeros(0), float(np.log((n1 + 1.0) / (n0 + 1.0))))
    # information that a feature's presence gives about the label
    def entropy(a, b):
        p = a / (a + b)
        return -F.when(p > 0, p * F.log2(p)).otherwise(0.0) - F.when(p < 1, (1 - p) * F.log2(1 - p)).otherwise(0.0)

    a, b = F.col("n1").cast("double"), F.col("n0").cast("double")
    with_f, without = (a + b) / (n0 + n1), F.lit(1.0) - (a + b) / (n0 + n1)
    gain = entropy(F.lit(float(n1)), F.lit(float(n0))) - with_f * entropy(a, b) - without * entropy(n1 - a + 1e-9, n0 - b + 1e-9)
    best = got.filter((F.col("f") >= 0) & (F.col("n0") + F.col("n1") >= MIN_TEXTS)).orderBy(gain.desc(), "f").limit(KEPT).select("f").collect()
    kept = np.array(sorted(r.f for r in best), np.int64)
    empty = ToxicityModel(kept, np.zeros(len(kept)), 0.0)
    place = docs.sparkSession.sparkContext.broadcast(empty.place)

    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = batch_texts(batch, 2)
            for i, j in slices(offs):
                rows, at = _presence(*text_features(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]), place.value)
                cut = np.searchsorted(rows, np.arange(j - i + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i),
                     pa.array([at[cut[k]:cut[k + 1]].astype(np.int32) for k in range(j - i)], pa.list_(pa.int32()))], names=["id", "y", "at"])

    def changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What each swap does to the kept features, with the swap's share of its text."""
        known: dict = {}
        for batch in batches:
            for text in batch.column(0):
                made = swap_changes(text.as_py() or "", place.value, known)
                same = collections.Counter(made)
                if same:
                    yield pa.RecordBatch.from_arrays([pa.array(list(map(list, same)), pa.list_(pa.int32())), pa.array([n / len(made) for n in same.values()])],
                                                     names=["change", "weight"])

    table = arrow_map(chosen, presence, "id string, y int, at array<int>").toArrow().sort_by("id")
    lists = table["at"].combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    rows, at = np.repeat(np.arange(len(sizes)), sizes), lists.flatten().to_numpy().astype(np.int64)
    # swaps that change the same kept features are one, with their weights added: their number follows the features
    made = arrow_map(chosen.select("text"), changes, "change array<int>, weight double").groupBy("change").agg(F.sum("weight").alias("weight")).orderBy("change").toArrow()
    lists = made["change"].combine_chunks()
    sizes, codes = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy().astype(np.int64)
    swaps = (np.repeat(np.arange(len(sizes)), sizes), np.where(codes < 0, -1 - codes, codes), np.where(codes < 0, -1.0, 1.0), made["weight"].to_numpy())
    w, c = fit(rows, at, (table["y"].to_numpy() > 0).astype(float), len(kept), swaps, fairness)
    return ToxicityModel(kept, w, c)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 4, rest: int = 2) -> DataFrame:
    """One row for each row of ``docs``: id, held_out, score (higher: label 1 likelier), predicted (1 from 0.3 on).

    Whole texts are scored; a null or empty text has the score of the intercept. Repeated rows get equal scores,
    other columns are not read, an empty table gives an empty table. Without labels of both kinds the score is
    their smoothed share.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col, text_col, folds=folds, rest=rest))
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = batch_texts(batch, 2)
            for i, j in slices(offs):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i),
                                                  pa.array(shared.value.score(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]))], names=schema.names)

    out = arrow_map(docs.select(id_col, held_out(id_col, folds, rest).alias("h"), F.col(text_col).cast("string")), run, schema)
    return out.withColumn("predicted", predicted(F.col("score")))
