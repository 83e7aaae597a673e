"""Operators 11, 12 and 13 against plain versions."""

import collections
import itertools
import re
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from webloom.llm import audit, collocations, queries, url_trees

from .conftest import PROSE, table

SF = "/root/testdata/sf0.001"
RULES = [url_trees.Rule(*r) for r in queries.URL_RULES]


def by_sql(sql, **frames):
    con = duckdb.connect()
    for name, df in frames.items():
        con.register(f"_{name}", df.toArrow())
        con.execute(f"CREATE TABLE {name} AS SELECT * FROM _{name}")
    got = con.sql(sql)
    return got.columns, sorted(map(str, got.fetchall()))


def by_spark(df, columns):
    return sorted(str(tuple(r)) for r in df.select(*columns).collect())


# ------------------------------------------------------------------ 11

def plain_rule(url):
    """(host, path, rule, verdict) as the contract says it."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for verdict, text in queries.URL_RULES:
        h, p = text[:text.index("/")], text[text.index("/"):]
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(text) > len(best[1])):
            best = verdict, text
    return host, path, best and best[1], best and best[0]


def test_url_rules_and_whole_table(spark):
    want = {r.page_id: plain_rule(r.url) for r in table("sf0.001", "pages").itertuples()}
    rows = queries.op11_url_trees(spark, SF).collect()
    assert len(rows) == len(want) and {r.verdict for r in rows} <= {"allow", "block"}
    for r in rows:
        host, path, rule, verdict = want[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule) and 0 <= r.score <= 1
        assert r.verdict == (verdict or ("block" if r.score > 0.5 else "allow"))


URLS = [None, "", "no scheme", "http://EXAMPLE.org/es/x", "http://a.example.org/es", "http://example.org/en/12?es/#x", "http://x.com/fr/",
        "http://notexample.org/es/1", "http://org", "http://org/", "http://org?x=/", "http://a.b.com/de/9", "//x.com/de/", "a://b://x.com/de/",
        "http://x.com:80/de/", "http://ÜÖ.com/de/é", "http://x.com/de/" + "a" * 300_000, "http://x.com/\n/de/"]


def test_url_edges(spark):
    rows = [(None if k % 5 == 0 else k, u, "h", 1.0, "r") for k, u in enumerate(URLS + URLS)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, host string, score double, _rule string")
    got = url_trees.judge(df, RULES).collect()
    assert collections.Counter((r.host, r.path, r.rule) for r in got) == collections.Counter(plain_rule(u)[:3] for u in URLS + URLS)
    assert url_trees.judge(df.limit(0), RULES).count() == 0
    assert {r.verdict for r in url_trees.judge(df.filter("url is null"), RULES).collect()} == {"allow"}


def test_trees_learn_held_out_urls(spark):
    own = url_trees.ruled(spark.read.parquet("/root/testdata/sf0.1/pages.parquet"), RULES).filter(F.col("_ruled").isNotNull()) \
        .select("url", (F.col("_ruled") == "block").cast("int").alias("y"), (F.pmod(F.crc32("url"), F.lit(4)) == 0).alias("held"))
    model = url_trees.train(own.filter("not held"))
    got = url_trees.judge(own.filter("held").select(F.col("y").alias("page_id"), "url"), [], model).collect()
    right = sum((r.verdict == "block") == (r.page_id == 1) for r in got)
    share = sum(r.page_id for r in got) / len(got)
    assert right / len(got) > 0.9 > max(share, 1 - share)


def test_a_tree_takes_the_best_cut():
    rng = np.random.default_rng(3)
    x = rng.random((4000, 3))
    y = ((x[:, 1] > 0.5) ^ (x[:, 2] > 0.7)).astype(float)
    model = url_trees.fit(x, y)
    assert ((model.score(x) > 0.5) == (y > 0)).mean() > 0.98
    b = model.bins(x)
    p = np.full(len(y), y.mean())
    feature, cut, _ = url_trees._grow(b, y - p, p * (1 - p))

    def gain(k, c):
        left = b[:, k] <= c
        return sum((y[s] - y.mean()).sum() ** 2 / ((p * (1 - p))[s].sum() + url_trees.RIDGE) for s in (left, ~left) if s.sum() >= url_trees.LEAF_ROWS)
    best = max((gain(k, c), k, c) for k in range(3) for c in range(url_trees.BINS - 1))
    assert gain(feature[0], cut[0]) == pytest.approx(best[0])


def test_a_hot_url_is_learned_from_once(spark):
    rows = [("http://hot.com/x", 1)] * 3000 + [(f"http://s{k}.net/{k}", k % 2) for k in range(400)]
    model = url_trees.train(spark.createDataFrame(rows, "url string, y int"), train_urls=300)
    assert model.table[:, 1].max() < np.log(500)


# ------------------------------------------------------------------ 12

def plain_phrases(rows, least, within, top):
    counts, words = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for n in range(1, 5):
                for i in range(len(w) - n + 1):
                    counts[lang, tuple(w[i:i + n])] += 1
    out = []
    for lang in words:
        found = []
        for (x, p), a in counts.items():
            if x != lang or len(p) < 2 or a < least:
                continue
            if any(y == lang and len(q) > len(p) and f >= least and 100 * f >= within * a
                   and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for (y, q), f in counts.items() if f >= least):
                continue
            cuts = []
            for k in range(1, len(p)):
                left, right = counts[lang, p[:k]], counts[lang, p[k:]]
                cuts.append((int(Fraction(2_000_000 * a, left + right)), k, left, right))
            score, _, left, right = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, words[lang], -score))
    return sorted(out, key=str)


COLS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def phrases(df):
    return sorted((tuple(r) for r in df.select(*COLS).collect()), key=str)


@pytest.mark.parametrize("shard_words", [7, 500, 2_000_000])
def test_phrases_against_plain_counting(spark, frame, edge_docs, shard_words):
    rows = [(r.lang, r.text) for r in table("sf0.001", "documents").head(60).itertuples()]
    rows += [("xx", "Ab c\td. ab C d;ab c d\nab c"), ("xx", "a a a a a a a"), (None, "a a a a a"), ("und", "a a a a"), ("yy", None), ("yy", " ,. ")]
    docs = frame([(k, t, lang) for k, (lang, t) in enumerate(rows)])
    got = collocations.collocations(docs, least=3, top=40, shard_words=shard_words, cells=1 << 12, block=1 << 9)
    assert phrases(got) == plain_phrases(rows, 3, 80, 40)


def test_phrases_of_edge_rows(frame, edge_docs, empty_docs):
    rows = [(r.lang, r.text) for r in edge_docs.collect()]
    docs = edge_docs.withColumns({"rank": F.lit(1), "f": F.lit("x"), "phrase": F.lit(None).cast("string")})
    assert phrases(collocations.collocations(docs, least=5)) == plain_phrases(rows, 5, 80, 2000)
    assert collocations.collocations(empty_docs).count() == 0


def test_phrases_against_sql(spark):
    got = queries.op12_fm_collocations(spark, "/root/testdata/sf0.01")
    columns, want = by_sql(collocations.ORACLE_SQL, documents=spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert by_spark(got, columns) == want and len(want) > 100


def test_index_steps_against_plain_search():
    rng = np.random.default_rng(5)
    text = np.concatenate([rng.integers(0, 6, 400), [0]])
    index, seq = collocations.FMIndex(text), text.tolist()
    for length, lo, hi, back in index.phrases(collocations.DEPTH):
        want = collections.Counter(tuple(seq[i:i + length]) for i in range(len(seq) - length + 1) if 0 not in seq[i:i + length])
        got = {}
        for a, b, c in zip(lo, hi, back, strict=True):
            places = sorted(index.sa[a:b])
            phrase = tuple(seq[places[0]:places[0] + length])
            assert all(tuple(seq[p:p + length]) == phrase for p in places)
            assert sorted(index.back_sa[c:c + b - a] - (length - 1)) == places  # the backward interval has the same occurrences
            got[phrase] = b - a
        assert got == want


def test_cells_round_trip():
    rng = np.random.default_rng(2)
    for at in ([0], [1 << 20], [65535, 65536, 131072, (1 << 20) - 1], [983_039], np.unique(rng.integers(0, 1 << 20, 50)), np.arange(5000)):
        at = np.array(at)
        n = rng.integers(1, 30, len(at)).astype(np.uint8)
        counts, want = np.zeros((1 << 20) + 1, int), np.zeros((1 << 20) + 1, int)
        np.add.at(counts, *collocations._unpacked(memoryview(collocations._packed(at.astype(np.uint32), n))))
        want[at] = n
        assert (counts == want).all()


# ------------------------------------------------------------------ 13

def test_audit_against_sql(spark):
    frames = {t: spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels")}
    columns, want = by_sql(audit.ORACLE_SQL, **frames)
    assert by_spark(queries.op13_filter_audit(spark, "/root/testdata/sf0.01"), columns) == want


def plain_audit(docs, labels):
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    bad = {i for i, _, x in labels if x == 1 and i is not None}
    rows = []
    for i, t, s in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t or "")) > 5 * len(t or ""),
                 "D": bool(re.search(r"[#$%&*|]", t or "")), "E": i is not None and i > first[t or ""]}
        rows.append((s or "", i, {f for f in fails if fails[f]}))
    out, shapley = {}, collections.Counter()
    for part in {r[0] for r in rows}:
        for order in itertools.permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                now = [r for r in left if f in r[2]]
                redundant = sum(f in r[2] for r in gone)
                left, gone = [r for r in left if f not in r[2]], gone + now
                shapley[part, f] += len(now)
                out[part, "".join(order), step] = [len(left), len(now), redundant, sum(r[0] == part and r[2] == {f} for r in rows),
                                                   sum(r[1] in good for r in now), sum(r[1] in bad for r in now)]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


@pytest.mark.parametrize("blocks", [1, 4096])
def test_audit_of_edge_rows(spark, edge_docs, blocks):
    labels = [(1, 1, 0), (1, 0, 1), (7, None, 1), (None, 1, 1), (4, 1, None)]
    docs = edge_docs.unionByName(edge_docs.filter("doc_id = 4").withColumn("doc_id", F.lit(99))) \
        .withColumns({"part": F.lit("clash"), "mask": F.lit(3), "n": F.lit(5), "id": F.lit("x")})
    got = audit.audit(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), max_blocks=blocks)
    want = plain_audit([(r.doc_id, r.text, r.source) for r in docs.collect()], labels)
    assert {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
            for r in got.collect()} == want


def test_audit_of_nothing(spark, empty_docs):
    assert audit.audit(empty_docs, spark.createDataFrame([], "doc_id bigint, quality int, toxic int")).count() == 0


def test_prepass_never_clears_a_repeat(spark):
    texts = [f"{PROSE} {k // 2}" for k in range(3000)] + [f"only {k}" for k in range(3000)]
    h = spark.createDataFrame([(t,) for t in texts], "t string").select(F.xxhash64("t").alias("h"), "t")
    possible = audit.possible_repeats(h.select("h"))
    got = {r.t for r in h.filter(possible("h")).collect()}
    assert got >= set(texts[:3000]) and len(got - set(texts[:3000])) < 150  # most unique texts are cleared
    crowded = audit.possible_repeats(h.select("h"), max_blocks=1)
    assert {r.t for r in h.filter(crowded("h")).collect()} >= set(texts[:3000])
