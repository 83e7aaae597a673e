"""Language identification by multinomial naive Bayes over hashed character n-grams (operator 7)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom.llm.learn import Chars, batch_texts, fold, held_out, sample
from webloom.llm.storage import arrow_map
from webloom.llm.words import slices

BUCKET_BITS, ORDERS, SMOOTHING = 16, (1, 2, 3), 0.5
#: Documents of each language to learn from, about; languages that the broadcast matrix may have at most.
TRAIN_DOCS, MAX_LANGS = 5_000, 512


def buckets(chars: Chars) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every n-gram of a slice, rows ascending within each order."""
    got = [chars.grams(n) for n in ORDERS]
    return np.concatenate([r for r, _ in got]), np.concatenate([h >> np.uint32(32 - BUCKET_BITS) for _, h in got])


class NaiveBayes:
    """Log priors and a (language, bucket) matrix of log probabilities."""

    def __init__(self, langs: list[str], docs: np.ndarray, counts: np.ndarray):
        self.langs = langs
        self.prior = np.log(docs / max(docs.sum(), 1)) if langs else np.zeros(0)
        total = counts.sum(axis=1, keepdims=True) + SMOOTHING * counts.shape[1]
        self.logp = (np.log(counts + SMOOTHING) - np.log(total)).astype(np.float32)

    def score(self, chars: Chars, n_rows: int) -> np.ndarray:
        """Log joint probabilities, one row for each text: n-gram hits gathered from the matrix and summed by row."""
        out = np.tile(self.prior, (n_rows, 1))
        for n in ORDERS:
            rows, h = chars.grams(n)
            if len(rows):
                own, starts = np.unique(rows, return_index=True)
                at = h >> np.uint32(32 - BUCKET_BITS)
                for k in range(len(self.langs)):
                    out[own, k] += np.add.reduceat(self.logp[k][at].astype(np.float64), starts)
        return out


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          folds: int = 5, rest: int = 0, train_docs: int = TRAIN_DOCS) -> NaiveBayes:
    """Counts of whole texts, summed by Spark; rows of the held-out fold, without language or without text are left out.

    ``train_docs`` bounds the sample of each language (about that many, chosen by a hash of the id).
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")) \
        .filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold("id", folds) != rest))
    chosen = sample(rows, "id", train_docs, "lang").select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        texts: dict[str, int] = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            data, offs = batch_texts(batch, 1)
            for i, j in slices(offs):
                rows, at = buckets(Chars(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]))
                for lang in dict.fromkeys(langs[i:j]):
                    on = langs[i:j] == lang
                    total.setdefault(lang, np.zeros(1 << BUCKET_BITS, np.int64))
                    total[lang] += np.bincount(at[on[rows]], minlength=1 << BUCKET_BITS)
                    texts[lang] = texts.get(lang, 0) + int(on.sum())
        for lang, c in total.items():
            seen = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * (len(seen) + 1)), pa.array(np.append(seen, -1)), pa.array(np.append(c[seen], texts[lang]))],
                                             names=["lang", "bucket", "n"])

    got = arrow_map(chosen, count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    langs = sorted(r.lang for r in got.select("lang").distinct().collect())
    if len(langs) > MAX_LANGS:
        raise ValueError(f"{len(langs)} languages; the matrix that is broadcast is bounded to {MAX_LANGS}")
    table = got.toArrow() if langs else None  # at most langs * (buckets + 1) rows
    counts, n_docs = np.zeros((len(langs), 1 << BUCKET_BITS)), np.zeros(len(langs))
    if table is not None:
        row = np.searchsorted(np.array(langs, object), np.array(table["lang"].to_pylist(), object))
        at, n = table["bucket"].to_numpy(), table["n"].to_numpy()
        n_docs[row[at < 0]] = n[at < 0]
        counts[row[at >= 0], at[at >= 0]] = n[at >= 0]
    return NaiveBayes(langs, n_docs, counts)


def predict(docs: DataFrame, model: NaiveBayes, id_col: str = "doc_id", text_col: str = "text",
            folds: int = 5, rest: int = 0) -> DataFrame:
    """One row for each row of ``docs``: id, held_out, lang_pred, score.

    The score is the posterior probability of the predicted language. A null or empty text, or one without a
    letter, is ``und`` with score 0; so is every text where nothing could be learned. Equal posteriors go to the
    first language by name. Only the text is read for a prediction; repeated rows give repeated rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("held_out", T.BooleanType()),
                           T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nb = shared.value
        for batch in batches:
            data, offs = batch_texts(batch, 2)
            for i, j in slices(offs):
                chars = Chars(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                known = (chars.letters > 0) & bool(nb.langs)
                best, score = np.zeros(j - i, int), np.zeros(j - i)
                if nb.langs:
                    joint = nb.score(chars, j - i)
                    best = joint.argmax(axis=1)
                    score = 1.0 / np.exp(joint - joint.max(axis=1, keepdims=True)).sum(axis=1)
                names = [nb.langs[b] if k else "und" for b, k in zip(best, known, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(names, pa.string()),
                                                  pa.array(np.where(known, score, 0.0))], names=schema.names)

    return arrow_map(docs.select(id_col, held_out(id_col, folds, rest).alias("h"), F.col(text_col).cast("string")), run, schema)
