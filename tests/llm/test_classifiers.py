"""Operators 7, 8 and 9: held-out accuracy, parts against plain versions, what is learned from, edge cases."""

import collections
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from webloom.llm import gam, langid, learn, queries, toxicity
from webloom.llm.words import Words, text_bytes

from .conftest import PROSE, table

SF = "/root/testdata/sf0.01"


def auc(score, y):
    rank = np.argsort(np.argsort(score, kind="stable"), kind="stable")
    return (rank[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() - 1) / 2) / ((y == 1).sum() * (y == 0).sum())


def fold(ident, n):
    return zlib.crc32(str(ident).encode()) % n


def test_language_held_out(spark):
    lang = table("sf0.01", "documents").set_index("doc_id").lang
    rows = queries.op7_char_ngram_bayes(spark, SF).collect()
    assert len(rows) == len(lang) and all(r.held_out == (fold(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r.lang_pred == lang[r.doc_id] for r in rows if r.held_out]
    assert sum(held) / len(held) > 0.97


def test_naive_bayes_against_a_plain_sum(frame):
    rows = [(k, t, lang) for k, (t, lang) in enumerate([("ab ba", "x"), ("abba!", "x"), ("cd  DC", "y"), ("été", "y"), ("ab", "x"), ("zz zz", None), (None, "y")] * 4)]
    model = langid.train(frame(rows))
    counts = collections.defaultdict(collections.Counter)
    n_docs = collections.Counter()

    def grams(text):
        c = learn.Chars(*text_bytes(pa.array([text])))
        return langid.buckets(c)[1].tolist()

    for k, t, lang in rows:
        if lang and t is not None and fold(k, 5) != 0:
            counts[lang].update(grams(t))
            n_docs[lang] += 1
    assert model.langs == sorted(counts)
    for text in ("ab", "dcd été", "q"):
        want = [math.log(n_docs[x] / sum(n_docs.values())) + sum(math.log((counts[x][g] + 0.5) / (sum(counts[x].values()) + 0.5 * 65536)) for g in grams(text)) for x in model.langs]
        got = model.score(learn.Chars(*text_bytes(pa.array([text]))), 1)[0]
        assert np.allclose(got, want, atol=1e-4)


def test_language_edges(spark, edge_docs, empty_docs, frame):
    model = langid.train(edge_docs, folds=5)
    rows = langid.predict(edge_docs, model).collect()
    assert len(rows) == 10 and all((r.lang_pred, r.score) == ("und", 0.0) for r in rows if r.doc_id in (2, 3, 5))
    assert langid.predict(empty_docs, langid.train(empty_docs)).count() == 0
    assert {r.lang_pred for r in langid.predict(edge_docs, langid.train(empty_docs)).collect()} == {"und"}
    assert langid.predict(frame([(1, "123 ?!", "en")]), model).first().lang_pred == "und"


@pytest.mark.parametrize(("name", "label", "folds", "rest", "least"), [("op8_quality_gam", "quality", 5, 0, 0.99), ("op9_fair_toxicity", "toxic", 4, 2, 0.85)])
def test_scores_held_out(spark, name, label, folds, rest, least):
    labels = table("sf0.1", "labels").set_index("doc_id")[label]
    rows = queries.QUERIES[name](spark, "/root/testdata/sf0.1").collect()
    assert all(r.held_out == (fold(r.doc_id, folds) == rest) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels.index]
    score, y = map(np.array, zip(*held, strict=True))
    assert len(rows) == 10_000 and auc(score, y) > least


def test_held_out_labels_do_not_matter(frame):
    rng = random.Random(1)
    docs = [(k, " ".join(rng.choice(["good", "fine", "bad!!", "##"]) for _ in range(30))) for k in range(300)]
    labels = [(k, int("bad" in t), int("##" in t)) for k, t in docs]
    schema = "doc_id bigint, quality int, toxic int"
    for make, folds, rest in ((gam.quality, 5, 0), (toxicity.toxicity, 4, 2)):
        other = [(k, 1 - a, 1 - b) if fold(k, folds) == rest else (k, a, b) for k, a, b in labels]
        one, two = (sorted((r.doc_id, r.score) for r in make(frame(docs), frame(x, schema)).collect()) for x in (labels, other))
        assert one == two


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = gam.fit(x[:3000], y[:3000])
    assert (model.pairs[0][0], model.pairs[0][1]) == (0, 1)
    assert auc(model.score(x[3000:]), y[3000:]) > 0.95
    by_hand = [model.intercept + sum(t[np.searchsorted(c, v, "right")] for t, c, v in zip(model.tables, model.cuts, row, strict=True))
               + sum(t[np.searchsorted(model.cuts[p], row[p], "right"), np.searchsorted(model.cuts[q], row[q], "right")] for p, q, t in model.pairs) for row in x[:20]]
    assert np.allclose(model.score(x[:20]), 1 / (1 + np.exp(-np.array(by_hand))))
    assert gam.fit(x[:5], np.ones(5)).score(x[:2]).tolist() == [6 / 7] * 2


def test_classifier_edges(frame, edge_docs, empty_docs):
    labels = frame([(1, 1, 0), (1, 0, 1), (4, 0, 0), (6, 1, 1), (7, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    for make in (gam.quality, toxicity.toxicity):
        rows = make(edge_docs, labels).collect()
        assert len(rows) == 10 and all(0 <= r.score <= 1 for r in rows)
        assert make(empty_docs, labels).count() == 0
        assert len({r.score for r in make(edge_docs, labels.limit(0)).collect()}) == 1
    kept = gam.score(edge_docs, gam.train(edge_docs, labels))
    assert kept.columns == [*edge_docs.columns, "_score"] and kept.drop("_score").exceptAll(edge_docs).count() == 0


def test_identity_swaps():
    got = toxicity.swapped("Nothing. Some Women spoke! The women left.")
    assert [a for a, _ in got] == ["Some Women spoke!"] * 3 + ["The women left."] * 3
    assert got[0][1] == "Some men spoke!" and toxicity.swapped("womenfolk") == []
    text = "A christian met a muslim. Two women and a gay man."
    assert collections.Counter(s for s, _ in toxicity.swapped(text)) == {"A christian met a muslim.": 10, "Two women and a gay man.": 3 + 4 + 3}
    assert len(toxicity.swapped("men. " * 3000)) == 9000


def test_counterfactual_penalty_takes_weight_off_group_names(frame):
    """A group that is named in toxic texts more often must not make a neutral mention score higher."""
    rng = random.Random(3)
    filler = ["garden", "river", "music", "market", "window", "bread", "story", "winter", "paper", "bridge"]
    docs, labels = [], []
    for k in range(1500):
        bad = rng.random() < 0.4
        group = "muslim" if rng.random() < (0.7 if bad else 0.15) else rng.choice(["christian", "hindu", "buddhist"])
        words = [rng.choice(filler) for _ in range(12)] + [f"the {group} neighbour"] + (["vermin"] if bad and rng.random() < 0.8 else [])
        rng.shuffle(words)
        docs.append((k, " ".join(words) + "."))
        labels.append((k, int(bad)))
    docs, labels = frame(docs), frame(labels, "doc_id bigint, toxic int")

    def gap(fairness):
        model = toxicity.train(docs, labels, fairness=fairness)
        a, b, bad = (model.score(*text_bytes(pa.array([f"music and the {g} neighbour with bread{x}."])))[0] for g, x in (("muslim", ""), ("hindu", ""), ("hindu", " vermin")))
        return a - b, bad

    plain, fair = gap(0.0), gap(10.0)
    assert plain[0] > 0.1 and abs(fair[0]) < plain[0] / 4 and fair[1] > 0.8


def test_changes_of_swaps_are_those_of_swapped_sentences():
    rng = random.Random(8)
    place = np.random.default_rng(0).permutation(1 << toxicity.BITS).astype(np.int64) % (3 * toxicity.KEPT)
    place = np.where(place < toxicity.KEPT, place, -1).astype(np.int32)
    words = ["Women", "men", "old", "older", "boys,", "womenfolk", "musulmanes", "the", "é", "12", "young!", "gay-men", "girls.", "\n", "jews?", "-"]
    for _ in range(300):
        text = " ".join(rng.choices(words, k=rng.randrange(14)))
        want = []
        for pair in toxicity.swapped(text):
            _, at = toxicity._features_of([pair[0]], place)
            _, then = toxicity._features_of([pair[1]], place)
            want.append(tuple(sorted([-1 - f for f in set(at.tolist()) - set(then.tolist())] + list(set(then.tolist()) - set(at.tolist())))))
        assert toxicity.swap_changes(text, place, {}) == want, text


def test_penalty_gradient_is_that_of_weighted_swaps(frame):
    """Every text counts once in the penalty, whatever number of swaps it has; equal changes are added up."""
    rng = np.random.default_rng(1)
    rows, at = np.repeat(np.arange(60), 3), rng.integers(0, 8, 180)
    key = np.unique(rows * 8 + at)
    rows, at, y = key // 8, key % 8, (rng.random(60) > 0.5).astype(float)
    many = (np.array([0, 0, 1, 1, 2, 2]), np.array([0, 1, 0, 1, 2, 3]), np.array([1.0, -1, 1, -1, 1, -1]), np.array([0.5, 0.5, 1.0]))
    few = (np.array([0, 0, 1, 1]), np.array([0, 1, 2, 3]), np.array([1.0, -1, 1, -1]), np.array([1.0, 1.0]))
    a, b = toxicity.fit(rows, at, y, 8, many, 5.0), toxicity.fit(rows, at, y, 8, few, 5.0)
    assert np.allclose(a[0], b[0]) and np.isclose(a[1], b[1])
    # at the optimum of the smooth part no small step lowers the plain objective
    def loss(w, c):
        z = c + np.bincount(rows, w[at], 60)
        p = 1 / (1 + np.exp(-z))
        fair = np.mean([(w[0] - w[1]) ** 2, (w[2] - w[3]) ** 2])
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)) + toxicity.RIDGE * (w ** 2).sum() + 5.0 * fair + toxicity.PULL / 60 * np.abs(w).sum()
    least = loss(*b)
    assert all(loss(b[0] + d * np.eye(8)[k], b[1]) >= least - 1e-7 for k in range(8) for d in (-1e-3, 1e-3))


def test_word_hashes_and_windows_are_those_of_a_plain_split():
    import re
    rng = random.Random(2)
    texts = ["".join(rng.choice("abAB \n\té日") for _ in range(rng.randrange(60))) for _ in range(50)] + ["", None, " ", PROSE]
    data, offs = text_bytes(pa.array(texts, pa.string()))
    w = Words(data, offs, lower=True)
    split = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in texts]
    assert w.count.tolist() == [len(s) for s in split]
    flat = [x for s in split for x in s]
    assert len(set(zip(flat, w.hashes().tolist(), strict=True))) == len(set(flat)) == len(set(w.hashes().tolist()))
    at, h = w.windows(5, whole_short=True)
    plain = [(k, tuple(s[i:i + 5])) for k, s in enumerate(split) for i in range(max(len(s) - 4, min(len(s), 1)))]
    assert w.row[at].tolist() == [k for k, _ in plain]
    assert len(set(zip((p for _, p in plain), h.tolist(), strict=True))) == len({p for _, p in plain}) == len(set(h.tolist()))
