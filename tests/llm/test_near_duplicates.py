"""Operator 2 against counting all shared shingles; DivideSkip against plain counting; components against union-find."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from webloom.llm import ngram_join as N
from webloom.llm import queries
from webloom.llm.components import components

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORDS.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(docs):
    sets = [(i, shingles(t)) for i, t in docs]
    parent = list(range(len(sets)))

    def find(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    lists = collections.defaultdict(list)
    for k, (_, s) in enumerate(sets):
        shared = collections.Counter()
        for x in s:
            shared.update(lists[x])
            lists[x].append(k)
        for j, n in shared.items():
            if 100 * n >= 80 * (len(s) + len(sets[j][1]) - n):
                parent[find(k)] = find(j)
    least = {}
    for k, (i, s) in enumerate(sets):
        least[find(k)] = min(least.get(find(k), i), i)
    return sorted((i, len(s), least[find(k)] if s else i) for k, (i, s) in enumerate(sets))


def result(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert result(queries.op2_ngram_jaccard(spark, "/root/testdata/sf0.001")) == brute(docs)


@pytest.mark.parametrize(("part_rows", "seed"), [(50_000, 1), (7, 2), (7, 3)])
def test_groups_of_edited_copies(frame, monkeypatch, part_rows, seed):
    """Many copies with edits of all strengths around the threshold, without and with salted lists."""
    monkeypatch.setattr(N, "PART_ROWS", part_rows)
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    docs, ident = [], 0
    for _ in range(6):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(30, 160))]
        for _ in range(25):
            words = list(base)
            for _ in range(rng.randrange(0, 6)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                words = words[rng.randrange(4):] + [rng.choice(vocabulary) for _ in range(rng.randrange(8))]
            docs.append((ident := ident + 1, " ".join(words)))
    docs += [(ident + k, t) for k, t in enumerate(["a b c", "A b\tC", "a b", "", None, "a b c d e", "a b c d e f"], 1)]
    rng.shuffle(docs)
    assert result(N.near_duplicates(frame(docs))) == brute(docs)


def quoting_texts(trials, seed):
    """For each trial a text, a near copy of it, and a longer text that holds it."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(5000)]
    docs = []
    for k in range(trials):
        x = [rng.choice(vocabulary) for _ in range(100)]
        y = list(x)
        y[-rng.randrange(1, 4)] = "other"
        more = [rng.choice(vocabulary) for _ in range((60, 200)[k % 2])]
        docs += [" ".join(t) for t in (x, y, more[:30] + x + more[30:])]
    return list(enumerate(docs, 1))


def test_lists_led_by_a_text_of_unlike_size(frame):
    docs = quoting_texts(30, 5)
    want = brute(docs)
    assert sum(i != c for i, _, c in want) >= 30
    assert result(N.near_duplicates(frame(docs))) == want


def test_stars_connect_every_pair_that_a_list_allows():
    """Joining the two nodes of each STAR row joins the nodes of every pair that sizes and places allow."""
    rng = np.random.default_rng(6)
    for _ in range(300):
        size = rng.integers(1, 14, rng.integers(1, 8))
        group = np.repeat(np.arange(len(size)), size)
        rows = np.zeros(len(group), N.POSTING)
        rows["node"], rows["n"] = rng.permutation(len(rows)), rng.integers(20, rng.choice([30, 60, 200]), len(rows))
        rows["at"], rows["pop"] = rng.integers(0, 65535 // 5, len(rows)), rng.integers(0, 3, len(rows))
        n = rows["n"].astype(np.int64)
        a, b = np.triu_indices(len(rows), 1)
        allowed = (group[a] == group[b]) & N._may_link(n[a], rows["at"][a], n[b], rows["at"][b])
        live = N._live_lists(rows, group)
        assert set(np.flatnonzero(live)) == set(group[a[allowed]])
        root = list(range(len(rows)))
        stars, _ = N._leaders(rows, group, live)
        for x, y in zip(stars["leader"].tolist(), stars["node"].tolist(), strict=True):
            root = [root[x] if r == root[y] else r for r in root]
        node = rows["node"]
        assert all(root[x] == root[y] for x, y in zip(node[a[allowed]], node[b[allowed]], strict=True))


def test_packed_values_hold_whole_lists(frame, monkeypatch):
    """Short near copies, which share one list or two, packed into values of one row where lists allow."""
    monkeypatch.setattr(N, "PACKED_ROWS", 1)
    rng = random.Random(8)
    docs = []
    for k in range(150):
        words = [f"t{k}x{i}" for i in range(rng.randrange(9, 14))]
        docs += [" ".join(t) for t in (words, ["f", *words[1:]], [*words[:-1], "b"])]
    docs = list(enumerate(docs, 1))
    assert result(N.near_duplicates(frame(docs))) == brute(docs)
    for _ in range(200):
        group = np.repeat(np.arange(7) * 2, rng.randrange(1, 6))[rng.randrange(3):]
        cuts = N._cuts(group, size := rng.randrange(1, 9))
        assert [i for i, _ in cuts] + [len(group)] == [0] + [j for _, j in cuts]
        assert all(group[j - 1] != group[j] for _, j in cuts[:-1]) and all(j - i < size + 6 for i, j in cuts)


def test_divide_skip_counts_like_a_plain_merge():
    rng = random.Random(4)
    for _ in range(200):
        m, n = rng.randrange(1, 40), rng.randrange(1, 30)
        lists = [sorted(rng.sample(range(m), rng.randrange(0, m + 1))) for _ in range(n)]
        need = [rng.randrange(1, n + 2) for _ in range(m)]
        counts = collections.Counter(x for one in lists for x in one)
        assert N.divide_skip(lists, need) == sorted((k, c) for k, c in counts.items() if c >= need[k])


def test_search_is_decided_by_divide_skip(monkeypatch):
    rng = np.random.default_rng(11)
    pool = np.unique(rng.integers(0, 1 << 63, 400).astype(np.uint64))
    query = np.sort(rng.choice(pool, 60, replace=False))
    sets = []
    for _ in range(200):  # from copies with a few members changed to unlike sets, of several sizes
        own = rng.choice(query, rng.integers(30, 61), replace=False)
        sets.append(np.unique(np.concatenate([own, rng.choice(pool, rng.integers(0, 12))])))
    need = [int(N.least_overlap(len(query), len(s))) for s in sets]
    shared = [len(np.intersect1d(query, s)) for s in sets]
    expected = [k for k, c in enumerate(shared) if c >= need[k]]
    assert 0 < len(expected) < len(sets)
    assert N.search(query, sets) == expected
    merged, plain = [], N.divide_skip
    monkeypatch.setattr(N, "divide_skip", lambda lists, need: merged.append(sum(map(len, lists))) or plain(lists, need)[1:])
    assert len(N.search(query, sets)) == len(expected) - 1  # nothing beside it decides
    assert merged == [sum(shared)]
    assert N.search(query, []) == []


@pytest.mark.parametrize("block_members", [1, 50])
def test_blocks_end_at_many_members(frame, monkeypatch, block_members):
    monkeypatch.setattr(N, "BLOCK_MEMBERS", block_members)
    rng = random.Random(5)
    base = [f"w{rng.randrange(50)}" for _ in range(40)]
    docs = [(k, " ".join(base + [f"x{j}" for j in range(k % 4)])) for k in range(30)]
    assert result(N.near_duplicates(frame(docs))) == brute(docs)


def test_thresholds_are_the_contract():
    for a in range(1, 120):
        for b in range(1, 120):
            t = N.least_overlap(a, b)
            assert 100 * t >= 80 * (a + b - t) and not 100 * (t - 1) >= 80 * (a + b - t + 1)
        assert N.prefix(a) == a - min(s for s in range(a + 1) if 10 * s >= 8 * a) + 1


def test_cells_count_every_shingle(monkeypatch):
    """Packed and added up again, the counts of all cells are those of a plain count, whatever the ranges and flushes."""
    rng = np.random.default_rng(0)
    for ranges, bits, flush in ((1, 8, 50), (7, 12, 1 << 22), (64, 27, 1000), (211, 27, 1 << 22)):
        monkeypatch.setattr(N, "CELL_BITS", bits)
        monkeypatch.setattr(N, "CELLS", 1 << bits)
        monkeypatch.setattr(N, "FLUSH", flush)
        sets = [np.unique(rng.integers(0, 1 << 64, 300, np.uint64)) for _ in range(20)] + [np.array([0, 5, (1 << 64) - 1], np.uint64)] * 300
        cells = N.Cells(ranges)
        packed = [v for s in sets for v in cells.add(s)] + cells.settle()
        got = collections.Counter()
        for r, v in packed:
            at, count = N.unpack_cells(v)
            assert 0 <= at.min() and at.max() < cells.width and 0 <= r < ranges
            got.update(dict(zip((at + r * cells.width).tolist(), count.tolist(), strict=True)))
        want = collections.Counter(int(x) >> (64 - bits) for s in sets for x in s)
        assert got == want and cells.settle() == []


def test_fullest_cells_are_listed(spark, frame, monkeypatch):
    """What is frequent is listed with its count; at most LISTED cells are, the fullest first."""
    docs = [(k, f"alpha beta gamma delta epsilon own{k} x{k} y{k}") for k in range(200)] + [(1000 + k, f"some other words that meet z{k}") for k in range(50)]

    def listed():
        first = N.documents_and_counts(frame(docs), "doc_id", "text", 64)
        return N.frequent(first.filter("packed is not null"), first.filter("packed is null").agg({"n": "sum"}).first()[0], 64, 8)

    keys, counts = listed()
    assert sorted(counts.tolist()) == [50, 200] and (np.diff(keys.astype(np.int64)) > 0).all()
    common = next(N.shingle_sets(pa.array(["alpha beta gamma delta epsilon"])))[1]
    assert N.count_of(common, (keys, counts)).tolist() == [200] and N.count_of(common ^ np.uint64(1 << 63), (keys, counts)).tolist() == [0]
    monkeypatch.setattr(N, "LISTED", 1)
    assert listed()[1].tolist() == [200]


def test_components(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (200, 201)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 130)} | {200: 200, 201: 200}


def test_edges(edge_docs, empty_docs):
    rows = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in N.near_duplicates(edge_docs).collect()), key=str)
    by_id = collections.defaultdict(list)
    for i, n, c in rows:
        by_id[i].append((n, c))
    assert len(rows) == 10 and by_id[2] == [(0, 2)] and by_id[3] == [(0, 3)] and by_id[5] == [(0, 5)]
    assert by_id[1] == [(20, 1)] * 2 and by_id[None] == [(20, 1)] and sorted(by_id[7]) == [(1, 7), (20, 1)]
    assert N.near_duplicates(empty_docs).count() == 0
    kept = N.one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 5, 6, 7]
    assert N.one_of_each(empty_docs).count() == 0


def test_near_copies_with_null_ids(frame):
    """A null id takes part in links: near copies of a row with an id, and of each other."""
    rng = random.Random(9)
    one, two = ([rng.choice("abcdefgh") + str(rng.randrange(500)) for _ in range(60)] for _ in range(2))
    docs = frame([(5, " ".join(one)), (None, " ".join([*one, "end"])), (None, " ".join(["start", *one])),
                  (None, " ".join(two)), (None, " ".join([*two, "end"])), (8, " ".join(reversed(one)))])
    rows = N.near_duplicates(docs).collect()
    assert sorted(((r.doc_id, r.component_id) for r in rows), key=str) == sorted([(5, 5), (None, 5), (None, 5), (None, None), (None, None), (8, 8)], key=str)
    assert len({r.group for r in rows}) == 3
    kept = N.one_of_each(docs).collect()
    assert sorted((r.doc_id for r in kept), key=str) == [5, 8, None]
