"""URL filter (operator 11): rules first, gradient-boosted trees on lexical features for the rest.

A URL that a rule decides is a labelled URL. Its features are numbers read off the string (lengths, depth, digit
ratios, entropies, parameters) and statistics of its suffixes: how many labelled URLs share the top-level label, the
last two labels, the ending of the path, its first directory, or that behind the last two labels, and which part of
them is blocked. Trees of a fixed depth are grown one after the other on the gradient of the log loss, over histograms
of binned features, from a bounded sample of the distinct labelled URLs. Scoring walks all trees over whole arrays.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.llm.learn import sigmoid
from webloom.llm.storage import arrow_map
from webloom.llm.words import slices, text_bytes

#: Distinct labelled URLs to learn from, about; trees, their depth, step, bins, rows of a leaf at least, prior weight.
TRAIN_URLS, TREES, DEPTH, STEP, BINS, LEAF_ROWS, RIDGE = 20_000, 80, 3, 0.2, 64, 20, 5.0
#: Hashed buckets of suffixes (a fixed size of the table that is broadcast) and the weight of the overall share in each.
BUCKETS, PRIOR = 1 << 14, 10.0
SUFFIXES = ("top_label", "two_labels", "ending", "directory", "two_labels_directory")
FEATURES = ("url_length", "host_length", "path_length", "query_length", "labels", "depth", "digits", "host_digits", "path_digits",
            "url_entropy", "host_entropy", "hyphens", "escapes", "parameters", "fragment",
            *(f"{s}_{what}" for s in SUFFIXES for what in ("blocked", "seen")))
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


class Rule:
    """``allow`` or ``block`` for a host and its subdomains where the path begins with ``path``."""

    def __init__(self, verdict: str, text: str):
        if verdict not in ("allow", "block") or "/" not in text or text.startswith("/"):
            raise ValueError(f"not a rule: {verdict} {text}")
        self.verdict, self.text = verdict, text
        self.host, self.path = text[:text.index("/")], text[text.index("/"):]

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path behind the first ``://``; both '' where there is none or the URL is null."""
    u = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substr(u, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def ruled(urls: DataFrame, rules: Sequence[Rule], url_col: str = "url") -> DataFrame:
    """``urls`` with _url, _host, _path, _rule and _ruled: the longest rule that fits (ties: the smaller text).

    Rules are an option of the job, tested one after the other in each row: no join and no shuffle.
    """
    host, path = host_and_path(F.col(url_col))
    df = urls.withColumns({"_url": F.coalesce(F.col(url_col).cast("string"), F.lit("")), "_host": host, "_path": path})
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), [-ord(c) for c in r.text])):  # the last test is asked first
        fits = r.fits(F.col("_host"), F.col("_path"))
        rule, verdict = F.when(fits, F.lit(r.text)).otherwise(rule), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return df.withColumns({"_rule": rule, "_ruled": verdict})


def _suffix(name: str) -> Column:
    host, path = F.col("_host"), F.col("_path")
    if name == "top_label":
        return F.substring_index(host, ".", -1)
    if name == "two_labels":
        return F.substring_index(host, ".", -2)
    first = F.regexp_extract(path, "^/[^/]*/", 0)
    if name == "directory":
        return first
    if name == "two_labels_directory":
        return F.concat(F.substring_index(host, ".", -2), first)
    return F.regexp_extract(path, r"(\.[^./]*|/)$", 1)


def _bucket(name: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(name), _suffix(name)), F.lit(BUCKETS)).cast("int")


def _lengths(offs: np.ndarray) -> np.ndarray:
    return np.diff(offs).astype(float)


def _sums(mask: np.ndarray, offs: np.ndarray) -> np.ndarray:
    upto = np.concatenate([[0], np.cumsum(mask)])
    return (upto[offs[1:]] - upto[offs[:-1]]).astype(float)


def _entropy(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Bits a byte of each string; 0 for an empty one."""
    n = len(offs) - 1
    row = np.repeat(np.arange(n), np.diff(offs))
    cell, count = np.unique(row * 256 + data, return_counts=True)
    size = np.maximum(np.diff(offs), 1)
    share = count / size[cell // 256]
    return np.bincount(cell // 256, -share * np.log2(share), n)


def features(url: pa.Array, host: pa.Array, path: pa.Array, buckets: Sequence[np.ndarray], table: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each URL. ``table``: (blocked share, log of number) of each suffix bucket."""
    n = len(url)
    (ud, uo), (hd, ho), (pd, po) = (text_bytes(c) for c in (url, host, path))
    query = pc.replace_substring_regex(pc.replace_substring_regex(url, r"(?s)#.*$", ""), r"(?s)^[^?]*\??", "")
    qd, qo = text_bytes(query)
    per = {"url_length": np.log1p(_lengths(uo)), "host_length": _lengths(ho), "path_length": np.log1p(_lengths(po)),
           "query_length": np.log1p(_lengths(qo)), "labels": _sums(hd == ord("."), ho), "depth": _sums(pd == ord("/"), po),
           "digits": _sums(_DIGIT[ud], uo) / np.maximum(_lengths(uo), 1), "host_digits": _sums(_DIGIT[hd], ho),
           "path_digits": _sums(_DIGIT[pd], po) / np.maximum(_lengths(po), 1), "url_entropy": _entropy(ud, uo),
           "host_entropy": _entropy(hd, ho), "hyphens": _sums(hd == ord("-"), ho), "escapes": _sums(ud == ord("%"), uo),
           "parameters": _sums(qd == ord("="), qo), "fragment": np.minimum(_sums(ud == ord("#"), uo), 1)}
    for name, b in zip(SUFFIXES, buckets, strict=True):
        per[f"{name}_blocked"], per[f"{name}_seen"] = table[b, 0], table[b, 1]
    return np.column_stack([per[f] for f in FEATURES]) if n else np.zeros((0, len(FEATURES)))


class BoostedTrees:
    """Cuts of each feature, the log odds to start from, and trees as arrays (feature and bin of each inner node,
    value of each leaf; node k has children 2k + 1 and 2k + 2)."""

    def __init__(self, cuts: list[np.ndarray], start: float):
        self.cuts, self.start = cuts, start
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(c, x[:, k], "right") for k, c in enumerate(self.cuts)]).astype(np.int64) if len(x) \
            else np.zeros((0, len(self.cuts)), np.int64)

    @staticmethod
    def leaf(tree: tuple[np.ndarray, np.ndarray, np.ndarray], b: np.ndarray) -> np.ndarray:
        feature, cut, value = tree
        node, rows = np.zeros(len(b), np.int64), np.arange(len(b))
        for _ in range(DEPTH):
            node = 2 * node + 1 + (b[rows, feature[node]] > cut[node])
        return value[node - (len(feature))]

    def score(self, x: np.ndarray) -> np.ndarray:
        b, z = self.bins(x), np.full(len(x), self.start)
        for tree in self.trees:
            z += self.leaf(tree, b)
        return sigmoid(z)


def _grow(b: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One tree, level by level: each node takes the cut of the largest gain over all features' histograms."""
    inner, width = (1 << DEPTH) - 1, b.shape[1]
    feature, cut = np.zeros(inner, np.int64), np.full(inner, BINS, np.int64)  # a node without a cut sends all rows left
    node, rows = np.zeros(len(b), np.int64), np.arange(len(b))
    cell = b + np.arange(width) * BINS
    for level in range(DEPTH):
        base, nodes = (1 << level) - 1, 1 << level
        at = ((node - base)[:, None] * (width * BINS) + cell).ravel()
        shape = (nodes, width, BINS)
        gs, hs, ns = (np.bincount(at, np.repeat(v, width), nodes * width * BINS).reshape(shape).cumsum(2) for v in (g, h, np.ones(len(b))))
        gl, hl, nl = gs[:, :, :-1], hs[:, :, :-1], ns[:, :, :-1]
        gt, ht, nt = gs[:, :, -1:], hs[:, :, -1:], ns[:, :, -1:]
        gain = gl ** 2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE) - gt ** 2 / (ht + RIDGE)
        gain = np.where((nl >= LEAF_ROWS) & (nt - nl >= LEAF_ROWS), gain, 0.0).reshape(nodes, -1)
        best = gain.argmax(1)
        good = gain[np.arange(nodes), best] > 1e-9
        feature[base:base + nodes] = np.where(good, best // (BINS - 1), 0)
        cut[base:base + nodes] = np.where(good, best % (BINS - 1), BINS)
        node = 2 * node + 1 + (b[rows, feature[node]] > cut[node])
    leaf = node - inner
    value = STEP * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + RIDGE)
    return feature, cut, value


def fit(x: np.ndarray, y: np.ndarray) -> BoostedTrees:
    """Boosting on a sample in memory. Without rows, or with one class, the model is the share of blocked URLs."""
    share = (y.sum() + 1.0) / (len(y) + 2.0)
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.zeros(0) for k in range(x.shape[1])]
    model = BoostedTrees(cuts, float(np.log(share / (1 - share))))
    if not len(x) or y.min() == y.max():
        return model
    b, z = model.bins(x), np.full(len(y), model.start)
    for _ in range(TREES):
        p = sigmoid(z)
        tree = _grow(b, y - p, p * (1 - p))
        model.trees.append(tree)
        z += model.leaf(tree, b)
    return model


class UrlModel:
    """Trees and the table of suffix statistics."""

    def __init__(self, trees: BoostedTrees, table: np.ndarray):
        self.trees, self.table = trees, table


def _columns() -> list[Column]:
    return [F.col("_url"), F.col("_host"), F.col("_path"), *[_bucket(s).alias(s) for s in SUFFIXES]]


def _by_slice(batch: pa.RecordBatch, first: int, table: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """Features of rows i to j, from the columns of ``_columns`` that begin at ``first``."""
    _, offs = text_bytes(batch.column(first))
    for i, j in slices(offs, 1 << 18):
        part = [batch.column(first + k).slice(i, j - i) for k in range(3 + len(SUFFIXES))]
        yield i, j, features(*part[:3], [c.to_numpy(zero_copy_only=False) for c in part[3:]], table)


def suffix_table(labelled: DataFrame) -> np.ndarray:
    """(blocked share, log of number) of each bucket, counted over all rows of (_host, _path, y)."""
    counts = labelled.select("y", F.explode(F.array(*[_bucket(s) for s in SUFFIXES])).alias("b")) \
        .groupBy("b").agg(F.count("*").alias("n"), F.sum("y").alias("blocked")).toArrow()
    n, blocked = np.zeros(BUCKETS), np.zeros(BUCKETS)
    at = counts["b"].to_numpy()
    n[at], blocked[at] = counts["n"].to_numpy(), counts["blocked"].to_numpy()
    overall = (blocked.sum() + 1) / (n.sum() + 2)
    return np.column_stack([(blocked + PRIOR * overall) / (n + PRIOR), np.log1p(n)])


def train(labelled: DataFrame, train_urls: int = TRAIN_URLS, url_col: str = "url", label_col: str = "y") -> UrlModel:
    """Model of (url, 0/1) rows, 1 for blocked. A URL that stands in many rows is learned from once (with the larger
    label); null URLs and labels are left out. Suffixes are counted over all distinct URLs; about ``train_urls`` of
    them, chosen by a hash of the URL, give the rows of numbers that the trees are grown on."""
    rows = labelled.select(F.col(url_col).cast("string").alias("_url"), F.col(label_col).cast("int").alias("y")).dropna() \
        .groupBy("_url").agg(F.max("y").alias("y"))
    host, path = host_and_path(F.col("_url"))
    rows = rows.withColumns({"_host": host, "_path": path})
    table = suffix_table(rows)
    u = F.pmod(F.xxhash64(F.lit("train"), F.col("_url")), F.lit(1 << 30)) / float(1 << 30)
    chosen = rows.filter(u < train_urls / max(rows.count(), 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, x in _by_slice(batch, 1, table):
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(i, j - i), batch.column(0).slice(i, j - i),
                                                  pa.array(list(x), pa.list_(pa.float64()))], names=["url", "y", "x"])

    got = arrow_map(chosen.select("y", *_columns()), run, "url string, y int, x array<double>").toArrow().sort_by("url")
    x = np.array(got["x"].to_pylist(), float).reshape(-1, len(FEATURES))
    return UrlModel(fit(x, got["y"].to_numpy().astype(float)), table)


def judge(pages: DataFrame, rules: Sequence[Rule], model: UrlModel | None = None, id_col: str = "page_id", url_col: str = "url",
          train_urls: int = TRAIN_URLS) -> DataFrame:
    """One row for each row of ``pages``: id, host, path, rule, verdict, score.

    The verdict is the rule's, else ``block`` where the model's score is over 0.5. Without a ``model`` it is learned
    from the URLs that the rules decide; where they decide none, or all alike, every other URL gets the verdict of the
    share that is blocked (no labels: allow). A null or unparsable URL has empty host and path, no rule, and is scored
    as it stands. Null ids and repeated rows are kept, equal URLs get equal verdicts, an empty table gives no rows,
    further columns are not read; URLs may have any length.
    """
    own = ruled(pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("u")), rules, "u")
    if model is None:
        decided = own.filter(F.col("_ruled").isNotNull())
        model = train(decided.select("_url", (F.col("_ruled") == "block").cast("int").alias("y")), train_urls, "_url")
    shared = pages.sparkSession.sparkContext.broadcast(model)
    kind = dict(own.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, x in _by_slice(batch, 3, shared.value.table):
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*part.columns[:3], part.column(4), part.column(5), pa.array(shared.value.trees.score(x))],
                                                 names=["id", "_rule", "_ruled", "_host", "_path", "score"])

    out = arrow_map(own.select("id", "_rule", "_ruled", *_columns()), run, f"id {kind}, _rule string, _ruled string, _host string, _path string, score double")
    verdict = F.coalesce("_ruled", F.when(F.col("score") > 0.5, F.lit("block")).otherwise(F.lit("allow")))
    return out.select(F.col("id").alias(id_col), F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"),
                      verdict.alias("verdict"), "score")
