"""Held-out split, bounded training samples and text arrays shared by the classifiers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.llm.words import text_bytes

U32 = np.uint32


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id is in no fold (null)."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))


def held_out(id_col: str, folds: int, rest: int) -> Column:
    """True where the id falls in the held-out fold; a null id is not held out, and is not learned from either."""
    return F.coalesce(fold(id_col, folds) == rest, F.lit(False))


def sample(rows: DataFrame, id_col: str, at_most: int, by: str | None = None) -> DataFrame:
    """Rows whose id hash falls under a rate that leaves about ``at_most`` rows (of each value of ``by``).

    The rate comes from a count of all rows, the choice from the id alone: no sort, no shuffle of rows, and the
    same rows at every run. A null id is never chosen.
    """
    u = (F.pmod(F.xxhash64(F.lit("train"), F.col(id_col)), F.lit(1 << 30)) / float(1 << 30))
    rows = rows.filter(F.col(id_col).isNotNull())
    if by is None:
        n = rows.count()
        return rows.filter(u < at_most / max(n, 1))
    counts = {r[by]: r["count"] for r in rows.groupBy(by).count().collect()}
    if not counts:
        return rows
    rate = F.lit(0.0)
    for value, n in sorted(counts.items()):
        rate = F.when(F.col(by) == value, at_most / n).otherwise(rate)
    return rows.filter(u < rate)


def labelled(labels: DataFrame, docs: DataFrame, label: str, folds: int, rest: int, at_most: int,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(text, y) of about ``at_most`` labelled documents outside the held-out fold.

    The chosen (id, label) pairs are the broadcast side: their number is the documented bound of the sample.
    An id with several labels takes the largest; null labels are no labels.
    """
    chosen = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y")) \
        .filter(F.col("y").isNotNull() & (fold("id", folds) != rest))
    chosen = sample(chosen, "id", at_most).groupBy("id").agg(F.max("y").alias("y"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), "id").select("id", "text", "y")


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Simple lower-case form of each code point below 0x600, and whether a code point is a letter."""
    low = np.arange(0x110000, dtype=U32)
    for c in range(0x600):
        got = chr(c).lower()
        if len(got) == 1:
            low[c] = ord(got)
    letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return low, letter


_kept: dict[str, tuple[np.ndarray, np.ndarray]] = {}


class Chars:
    """Code points of one slice of texts: lower-cased letters; every run of others is kept as single spaces (32)."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        if "tables" not in _kept:
            _kept["tables"] = _tables()
        low, letter = _kept["tables"]
        lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), U32)
        is_letter = letter[points]
        first = lead[offs]
        keep = is_letter.copy()
        if len(points):
            keep[1:] |= is_letter[:-1]  # the first other character after a letter stands as a space
        upto = np.concatenate([[0], np.cumsum(keep)])
        self.first = upto[first]  # n + 1 offsets by row
        self.points = np.where(is_letter, low[points], U32(32))[keep]
        self.row = np.repeat(np.arange(len(offs) - 1), np.diff(self.first))
        letters = np.concatenate([[0], np.cumsum(is_letter)])
        self.letters = letters[first[1:]] - letters[first[:-1]]

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, 32-bit hash) of every run of ``n`` code points inside a row."""
        p = self.points
        if len(p) < n:
            return np.zeros(0, np.int64), np.zeros(0, U32)
        h = np.full(len(p) - n + 1, n * 0x9E3779B1 & 0xFFFFFFFF, U32)
        for k in range(n):
            h = (h ^ p[k:len(p) - n + 1 + k]) * U32(0x85EBCA6B)
            h ^= h >> U32(15)
        inside = self.row[:len(p) - n + 1] == self.row[n - 1:]
        return self.row[:len(p) - n + 1][inside], (h * U32(0xC2B2AE35))[inside]


def batch_texts(batch: pa.RecordBatch, column: int) -> tuple[np.ndarray, np.ndarray]:
    return text_bytes(batch.column(column))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))
