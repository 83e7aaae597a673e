"""Quality rules by robust multivariate outliers (operator 5).

Every text gives a vector of transformed statistics. For each (lang, source) a minimum covariance determinant
estimate is found by concentration steps run as Spark aggregations over all rows: distances under the
current estimate, the quantile of them that holds the core share, then mean and covariance of the core. Moments of
the core of all rows, with the weight of a few rows, are added to those of each group, so that the estimate of a group
goes over smoothly from that of all rows to its own, at any size. As they widen the spread along the way from the
group to all rows, a text at the centre of a group of n has a squared distance of about PRIOR_ROWS / n at most.
A text whose Mahalanobis distance exceeds a chi-square quantile is rejected.

The text is read once; the vectors (a few numbers for each row) are written to the shared folder and every
step works on them. A step moves only sums (partial aggregates) and estimates of groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom.llm.storage import arrow_map, saved
from webloom.llm.words import Words, slices, text_bytes

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
WINDOW, MIN_WORDS, REPEAT_PERCENT = 8, 20, 30

FEATURES = ("mean_word", "symbol_rate", "dup_line_rate", "repeat_rate", "line_length")
P = len(FEATURES)
#: Share of a group that forms the core; steps; least standard deviation of each feature; rejecting quantile.
CORE, STEPS = 0.75, 6
FLOOR = (0.12, 0.04, 0.1, 0.05, 0.2)
CUTOFF_P = 1e-8
#: Rows of the core of all rows that each group's core is joined by, as a weight.
PRIOR_ROWS = P
#: Groups whose estimates (30 numbers each) are broadcast; more are joined.
BROADCAST_GROUPS = 20_000

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True


def _line_counts(text: str) -> tuple[int, int]:
    """(lines with a word, those of them equal to an earlier line)."""
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(lines), len(lines) - len(set(lines))


def statistics(data: np.ndarray, offs: np.ndarray, texts: list[str]) -> dict[str, np.ndarray]:
    """Word and line counts of one slice, one entry for each row."""
    w, n = Words(data, offs), len(offs) - 1
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points begun
    per_word = lead[w.end] - lead[w.start]
    sums = np.concatenate([[0], np.cumsum(per_word)])
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    at, h = w.windows(WINDOW)
    repeated = np.zeros(len(w.start) + 1, np.int64)
    if len(at):
        rows = w.row[at]
        order = np.lexsort((h, rows))
        same = (h[order][1:] == h[order][:-1]) & (rows[order][1:] == rows[order][:-1])
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        np.add.at(repeated, at[twice], 1)
        np.add.at(repeated, at[twice] + WINDOW, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(repeated[:-1]) > 0)])
    lines = np.array([_line_counts(t) for t in texts], np.int64).reshape(n, 2)
    return {"n_words": w.count, "word_chars": sums[w.first[1:]] - sums[w.first[:-1]],
            "n_symbols": symbols[offs[1:]] - symbols[offs[:-1]], "n_dup_lines": lines[:, 1],
            "n_repeat_words": covered[w.first[1:]] - covered[w.first[:-1]], "n_lines": lines[:, 0]}


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    keep: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """id, the ``keep`` columns as strings, and COUNTS of every whole text. A null text counts as empty."""
    fields = [T.StructField("id", docs.schema[id_col].dataType), *(T.StructField(f"g{k}", T.StringType()) for k in range(len(keep)))]
    schema = T.StructType(fields + [T.StructField(c, T.LongType()) for c in COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = text_bytes(batch.column(1))
            for i, j in slices(offs):
                own = data[offs[i]:offs[j]]
                texts = [t.as_py() or "" for t in batch.column(1).slice(i, j - i)]
                got = statistics(own, offs[i:j + 1] - offs[i], texts)
                rest = [batch.column(k).slice(i, j - i) for k in (0, *range(2, batch.num_columns))]
                yield pa.RecordBatch.from_arrays(rest + [pa.array(got[c].astype(np.int64)) for c in COUNTS], names=schema.names)

    cols = [F.col(id_col), F.col(text_col).cast("string"), *(F.col(c).cast("string") for c in keep)]
    return arrow_map(docs.select(*cols), run, schema)


def transforms() -> list:
    """FEATURES from COUNTS: lengths through a logarithm, the symbol rate through asin(sqrt), repetition as it is."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    lines = F.greatest(F.col("n_lines"), F.lit(1)).cast("double")
    rate = lambda x: F.asin(F.sqrt(F.least(F.lit(1.0), x)))
    return [F.log1p(F.col("word_chars") / words), rate(F.col("n_symbols") / words), F.col("n_dup_lines") / lines,
            F.col("n_repeat_words") / words, F.log1p(words / lines)]


def chi2_quantile(p_upper: float, df: int) -> float:
    """Chi-square quantile with upper tail ``p_upper`` (bisection on the series of the incomplete gamma)."""
    from math import exp, lgamma, log

    def lower(x: float) -> float:
        a, z = df / 2, x / 2
        term = total = 1 / a
        for k in range(1, 2000):
            term *= z / (a + k)
            total += term
            if term < total * 1e-16:
                break
        return total * exp(a * log(z) - z - lgamma(a))

    lo, hi = 1e-9, 1e4
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if 1 - lower(mid) > p_upper else (lo, mid)
    return lo


def consistency(core: float) -> float:
    """Factor that makes the covariance of the core of normal data match that of all of it."""
    q = chi2_quantile(1 - core, P)
    lo_tail = 1.0  # P(chi2_{p+2} <= q) by the recurrence of the incomplete gamma
    from math import exp, lgamma, log
    lo_tail = core - exp((P / 2) * log(q / 2) - q / 2 - lgamma(P / 2 + 1))
    return core / lo_tail


def _sums(where: Column | None = None) -> list:
    """Count, sums and sums of products of the features, over the core where given."""
    take = (lambda c: c) if where is None else (lambda c: F.when(where, c))
    x = [F.col(f"x{k}") for k in range(P)]
    out = [F.count(take(F.lit(1))).alias("n")] + [F.sum(take(x[k])).alias(f"s{k}") for k in range(P)]
    return out + [F.sum(take(x[a] * x[b])).alias(f"q{a}_{b}") for a in range(P) for b in range(a, P)]


EST = T.ArrayType(T.DoubleType(), False)


def moments(est: list[float], scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Mean of the features and of their products in the core that an estimate was made from."""
    mean = np.array(est[:P])
    cov = (np.linalg.inv(np.array(est[P:]).reshape(P, P)) - np.diag(np.array(FLOOR) ** 2)) / scale
    return mean, cov + np.outer(mean, mean)


def _estimates(sums: DataFrame, keys: list[str], scale: float, prior: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """Mean and inverse covariance (row by row, in one array) of each group from its sums and PRIOR_ROWS of ``prior``."""
    floor = np.array(FLOOR)
    more, (first, second) = (0, (np.zeros(P), np.zeros((P, P)))) if prior is None else (PRIOR_ROWS, prior)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = {n: np.array(batch.column(n).to_pylist(), float) for n in batch.schema.names if n not in keys}
            out = []
            for i in range(batch.num_rows):
                n = max(cols["n"][i] + more, 1.0)
                mean = (np.array([cols[f"s{k}"][i] for k in range(P)]) + more * first) / n
                cov = np.empty((P, P))
                for a in range(P):
                    for b in range(a, P):
                        cov[a, b] = cov[b, a] = (cols[f"q{a}_{b}"][i] + more * second[a, b]) / n - mean[a] * mean[b]
                cov = cov * scale + np.diag(floor ** 2)
                out.append([*mean.tolist(), *np.linalg.inv(cov).ravel().tolist()])
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array(cols["n"].astype(np.int64)), pa.array(out, pa.list_(pa.field("element", pa.float64(), False)))],
                                             names=[*keys, "n", "est"])

    schema = T.StructType([sums.schema[k] for k in keys] + [T.StructField("n", T.LongType()), T.StructField("est", EST)])
    return arrow_map(sums, run, schema)


def distance(est: Column) -> Column:
    """Squared Mahalanobis distance of the features under an estimate."""
    d = [F.col(f"x{k}") - est[k] for k in range(P)]
    return sum((d[a] * d[b] * est[P + a * P + b] for a in range(P) for b in range(P)), F.lit(0.0))


def mcd(vectors: DataFrame, group: str | None, prior: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """Concentration steps from the coordinate-wise median and spread; one row (group, n, est) for each group."""
    keys = [group] if group else []
    mid = [F.percentile_approx(f"x{k}", [0.5], 10_000)[0].alias(f"m{k}") for k in range(P)]
    low = [F.percentile_approx(f"x{k}", [0.16, 0.84], 10_000).alias(f"r{k}") for k in range(P)]
    start = vectors.groupBy(*keys).agg(F.count("*").alias("n"), *mid, *low)
    spread = [F.greatest((F.col(f"r{k}")[1] - F.col(f"r{k}")[0]) / 2, F.lit(FLOOR[k])) for k in range(P)]
    inv = [(1 / (spread[a] * spread[a])) if a == b else F.lit(0.0) for a in range(P) for b in range(P)]
    est = start.select(*keys, "n", F.array(*(F.col(f"m{k}").cast("double") for k in range(P)), *inv).alias("est"))
    for _ in range(STEPS):
        est = saved(est)
        few = few_groups(est)
        joined = with_estimate(vectors, est, keys, few)
        near = joined.withColumn("d", distance(F.col("est")))
        cut = near.groupBy(*keys).agg(F.percentile_approx("d", F.lit(CORE), 10_000).alias("cut"))
        core = with_estimate(near.drop("est", "n"), cut, keys, few)
        sums = core.groupBy(*keys).agg(*_sums(F.col("d") <= F.col("cut")))
        est = _estimates(sums, keys, consistency(CORE), prior)
    sizes = vectors.groupBy(*keys).agg(F.count("*").alias("n"))
    return saved(est.drop("n").join(sizes, keys)) if keys else saved(est)


def few_groups(est: DataFrame) -> bool:
    """Whether the rows of ``est``, one a group, may be broadcast."""
    return est.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS


def with_estimate(rows: DataFrame, est: DataFrame, keys: list[str], few: bool) -> DataFrame:
    """``rows`` with the columns of their group's estimate; without keys that is one row, taken as literals.

    ``few`` estimates are broadcast: rows are not dealt by group, so a group that holds most rows is in no one task.
    """
    if keys:
        return rows.join(F.broadcast(est) if few else est, keys)
    one = est.first()
    return rows.withColumns({f.name: F.lit(None if one is None else one[f.name]).cast(f.dataType) for f in est.schema})


def robust_outliers(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    group_cols: tuple[str, ...] = ("lang", "source"), cutoff_p: float = CUTOFF_P) -> DataFrame:
    """One row for each row of ``docs``: id, counts, base_failed, distance, kept.

    Base rules reject texts of fewer than 20 words and texts of which over 30 % of the words stand in a repeated
    window. The estimate is made from rows that pass them, the verdict is given to those alone. Null group values
    form groups of their own; a group of any size has its own estimate (see ``PRIOR_ROWS``). A null or empty text fails the base rules. Repeated rows each count and get their row. Constant statistics are safe:
    every variance has a floor. An empty table gives an empty table.
    """
    base = text_statistics(docs, id_col, text_col, group_cols)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    group = F.xxhash64(*(F.struct(F.col(f"g{k}")) for k in range(len(group_cols)))) if group_cols else F.lit(0).cast("long")
    rows = saved(base.select("id", group.alias("grp"), *COUNTS, failed.alias("base_failed"),
                             *(x.cast("double").alias(f"x{k}") for k, x in enumerate(transforms()))))
    vectors = rows.filter(~F.col("base_failed")).select("grp", *(f"x{k}" for k in range(P)))
    whole = mcd(vectors, None).first()
    prior = moments(whole["est"], consistency(CORE)) if whole is not None and whole["n"] else None
    each = mcd(vectors, "grp", prior).select("grp", "est")
    judged = rows.join(F.broadcast(each) if few_groups(each) else each, "grp", "left").withColumn("distance", F.sqrt(F.greatest(F.lit(0.0), distance(F.col("est")))))
    keep = ~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= chi2_quantile(cutoff_p, P) ** 0.5)
    return judged.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", keep.alias("kept"), "distance")
