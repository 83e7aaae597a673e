"""Operators 3, 4, 5 and 6 against plain versions."""

import collections
import math
import random
import re
import struct
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from webloom.llm import decontam, hash_tree, outliers, pii, queries

from .conftest import PROSE, table

SF = "/root/testdata/sf0.001"


def plain_shard(root, key):
    """The leaf of a key, node by node."""
    def draw(node):
        seed = xxhash.xxh64(node.name.encode(), 42).intdigest()
        h = xxhash.xxh64(struct.pack("<q", key), seed).intdigest() >> 11 if key is not None else seed >> 11
        return -math.log((h + 0.5) / (1 << 53)) / node.total()
    while root.children:
        root = min((c for c in root.children if c.total() > 0), key=draw)
    return root.shard


def test_shards_against_plain_descent(spark):
    docs = table("sf0.001", "documents").set_index("doc_id").text
    now, then = hash_tree.tree(40), hash_tree.tree(41, base=40)
    slots = collections.defaultdict(list)
    for r in queries.op3_hash_tree_shards(spark, SF).collect():
        raw = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 16, zlib.crc32(raw), "key")
        assert (r.shard, r.grown_shard) == (plain_shard(now, r.doc_id), plain_shard(then, r.doc_id))
        assert r.grown_shard in (r.shard, 40)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_a_weight_moves_rows_only_through_its_subtree():
    before, after = hash_tree.tree(40), hash_tree.tree(40, {13: 3.0})
    moved = [(plain_shard(before, k), plain_shard(after, k)) for k in range(6000)]
    assert all(b // 8 == 1 for a, b in moved if a != b)  # into the region of shard 13 only
    assert all(b == 13 or a // 8 != b // 8 or a // 4 != b // 4 for a, b in moved if a != b)
    assert collections.Counter(b for _, b in moved)[13] > 2 * collections.Counter(a for a, _ in moved)[13]


def test_shares_follow_weights():
    got = collections.Counter(plain_shard(hash_tree.tree(8, {0: 3.0, 1: 0.0}), k) for k in range(9000))
    assert 1 not in got and abs(got[0] / 9000 - 3 / 9) < 0.03 and abs(got[5] / 9000 - 1 / 9) < 0.02


@pytest.mark.parametrize("base", [3, 8, 40])
def test_growing_on_places_rows_where_it_said(frame, base):
    docs = frame([(k, "x") for k in range(1500)])
    at = [{r.doc_id: (r.shard, r.grown_shard) for r in hash_tree.place(docs, n, base=base).collect()} for n in range(base, base + 4)]
    for n, (now, then) in enumerate(zip(at, at[1:], strict=False), base):
        assert all(then[k][0] == now[k][1] and then[k][0] in (now[k][0], n) for k in now)
        assert any(s == n for s, _ in then.values())
    assert at[0] == {r.doc_id: (r.shard, r.grown_shard) for r in hash_tree.place(docs, base).collect()}


def test_shard_edges(edge_docs, empty_docs):
    rows = hash_tree.place(edge_docs, 40).collect()
    assert len(rows) == 10 and {r.size for r in rows if r.doc_id in (2, 3)} == {16}
    assert len({(r.shard, r.slot) for r in rows}) == 10
    assert hash_tree.place(empty_docs, 40).count() == 0


def plain_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = collections.defaultdict(list)
    for k in range(len(words) - 7):
        windows[tuple(words[k:k + 8])].append(k)
    covered = {k + j for at in windows.values() if len(at) > 1 for k in at for j in range(8)}
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_outlier_statistics_and_base_rules(spark):
    docs = table("sf0.001", "documents").set_index("doc_id").text
    rows = queries.op5_robust_outliers(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = plain_statistics(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and not (r.base_failed and r.kept)


def test_outliers_reject_bad_and_keep_clean(spark):
    labels = table("sf0.01", "labels").set_index("doc_id").quality
    rows = [r for r in queries.op5_robust_outliers(spark, "/root/testdata/sf0.01").collect() if r.doc_id in labels.index and not r.base_failed]
    good, bad = [r.kept for r in rows if labels[r.doc_id] == 1], [r.kept for r in rows if labels[r.doc_id] == 0]
    assert sum(good) / len(good) > 0.99 and sum(bad) / len(bad) < 0.2


def test_outlier_edges(edge_docs, empty_docs):
    rows = outliers.robust_outliers(edge_docs).collect()
    assert len(rows) == 10 and all(not r.kept and r.n_words == 0 for r in rows if r.doc_id in (2, 3, 5))
    assert all(r.kept for r in rows if r.doc_id == 1)
    assert outliers.robust_outliers(empty_docs).count() == 0


def test_small_sources_have_their_own_estimate(frame):
    """Texts on one line are kept in a source of any size, and a bad text among them is not."""
    rng = random.Random(2)
    prose = lambda n, line: "".join(rng.choice("abcdefgh") * rng.randrange(1, 4) + rng.choice("xyz") + str(rng.randrange(50)) + ("\n" if k % line == line - 1 else " ") for k in range(n))
    rows = [(k, prose(rng.randrange(60, 200), rng.randrange(8, 14)), "en", "wrapped") for k in range(600)]
    for size in (1, 2, 5, 6, 30, 60):
        rows += [(1000 * (size + 1) + k, prose(rng.randrange(900, 1100), 10_000), "en", f"one-line {size}") for k in range(size)]
    rows += [(1, "### $$ %% && ** || << >> " * 2 + " ".join(f"#{k}$%&" for k in range(400)), "en", f"one-line {size}") for size in (30, 60)]
    got = outliers.robust_outliers(frame(rows)).collect()
    assert [r.kept for r in got if r.doc_id == 1 and r.n_words > 400] == [False] * 2
    assert all(r.kept for r in got if r.doc_id >= 2000)


def test_many_groups_are_joined_with_equal_verdicts(spark, monkeypatch):
    few = {r.doc_id: r for r in queries.op5_robust_outliers(spark, SF).collect()}
    monkeypatch.setattr(outliers, "BROADCAST_GROUPS", 1)
    many = {r.doc_id: r for r in queries.op5_robust_outliers(spark, SF).collect()}
    assert few.keys() == many.keys()
    for k, r in few.items():
        assert r.kept == many[k].kept
        assert r.distance == pytest.approx(many[k].distance, rel=1e-6)


def test_chi_square_quantiles():
    assert abs(outliers.chi2_quantile(0.05, 5) - 11.0705) < 1e-3 and abs(outliers.chi2_quantile(0.001, 5) - 20.515) < 1e-3


def plain_distance(pattern, text):
    """Least edit distance of the pattern to any stretch of the text."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for k, p in enumerate(pattern, 1):
            new.append(min(row[k] + 1, new[-1] + 1, row[k - 1] + (p != c)))
        row, best = new, min(best, new[-1])
    return best


def test_bit_parallel_distance():
    rng = random.Random(1)
    for _ in range(200):
        p, t = ("".join(rng.choice("abc ") for _ in range(rng.randrange(1, n))) for n in (40, 90))
        assert decontam.best_match(decontam.masks(p), len(p), t)[0] == plain_distance(p, t)


def test_edit_matching_against_plain_distance(spark, frame):
    rng = random.Random(2)
    items = [(i, t) for i, t in table("sf0.001", "benchmark").itertuples(index=False)][:8] + [(90, "short one"), (91, None), (92, ""), (93, "!!!")]
    docs = [(0, None), (1, ""), (2, "Short... ONE"), (3, "a short one"), (4, "shorter ones are no match, nor ashort one")]
    for k, (_, t) in enumerate(items[:8]):
        for edits in (0, 5, 18, 22, 24, 30, 60):
            words = list(t)
            for _ in range(edits):
                at, kind = rng.randrange(len(words)), rng.randrange(3)
                words[at:at + 1] = [] if kind == 0 else [rng.choice("abcdefgh")] if kind == 1 else [words[at], rng.choice("xyz")]
            docs.append((len(docs), PROSE + " " + "".join(words) + " " + PROSE))
    got = {(r.doc_id, r.item_id): r.distance for r in decontam.contaminated_pairs(frame(docs), frame(items, "item_id bigint, text string")).collect()}
    want = {(2, 90): 0, (3, 90): 0}
    for i, text in docs:
        for j, item in items[:8]:
            p = decontam.normalise(item)
            d = plain_distance(p, decontam.normalise(text or "")) if text else len(p)
            if d <= int(len(p) * decontam.RATE):
                want[i, j] = d
    assert got == want and any(d > 9 for d in want.values())
    clean = decontam.clean_documents(frame(docs), frame(items, "item_id bigint, text string"))
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in docs} - {i for i, _ in want}


def test_short_items_against_every_run_of_words(frame):
    """Items of a few words inside texts: least distance to a run of whole words."""
    rng = random.Random(4)
    short = ["What is the capital of France?", "two plus two", "Paris", "Name a noble gas", "how many legs has a spider"]
    docs = ["We asked: what is the capital of France? Nobody knew.", "whatis the capitol of france", "is it Paris or parish", "comparisons", "two plus two is four", "two and two",
            "what is the capital of the france", "a nobel gas"]
    for _ in range(120):
        words = decontam.normalise(rng.choice(short)).split(" ")
        text = list(" ".join(rng.choices(["red", "x", "is", "the"], k=rng.randrange(4)) + words + rng.choices(["two", "b"], k=rng.randrange(3))))
        for _ in range(rng.randrange(5)):
            at = rng.randrange(len(text))
            text[at:at + 1] = rng.choice([[], [rng.choice("abc ")], [text[at], rng.choice("xy ")]])
        docs.append("".join(text))
    want = {}
    for i, doc in enumerate(docs):
        words = decontam.normalise(doc).split(" ")
        for j, item in enumerate(short):
            p = decontam.normalise(item)
            runs = [" ".join(words[a:b]) for a in range(len(words)) for b in range(a + 1, len(words) + 1)]
            d = min(whole_distance(p, r) for r in runs)
            if d <= int(len(p) * decontam.RATE):
                want[i, j] = d
    got = decontam.contaminated_pairs(frame(list(enumerate(docs))), frame(list(enumerate(short)), "item_id bigint, text string"))
    assert {(r.doc_id, r.item_id): r.distance for r in got.collect()} == want
    assert want[0, 0] == 0 and want[1, 0] == 2 and (3, 2) not in want and (2, 2) in want


def whole_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_item_ids_called_like_document_ids(frame):
    items = frame([(7, PROSE)], "doc_id bigint, text string")
    got = decontam.contaminated_pairs(frame([(1, PROSE), (2, "x")]), items, item_col="doc_id")
    assert got.columns == ["doc_id", "_doc_id", "distance", "match_end"] and [tuple(r)[:3] for r in got.collect()] == [(1, 7, 0)]


def test_many_copies_of_an_item_take_linear_time():
    matcher = decontam.Matcher([(1, PROSE)])
    wrong = PROSE.replace("quick", "quack")
    import time
    took = []
    for n in (300, 2400):
        start = time.time()
        assert matcher.matches(f"{wrong} " * n)[0][1] == 1
        took.append(time.time() - start)
    assert took[1] < 20 * took[0] + 0.5


def test_decontamination_blocks_and_edges(frame, edge_docs, empty_docs, monkeypatch):
    items = frame([(k, f"item {k} " + PROSE[k:]) for k in range(12)] + [(5, PROSE), (6, PROSE)], "item_id bigint, text string")
    whole = sorted(map(tuple, decontam.contaminated_pairs(edge_docs, items).collect()), key=str)
    monkeypatch.setattr(decontam, "item_blocks", lambda *a, f=decontam.item_blocks: f(*a, block_chars=300))
    assert sorted(map(tuple, decontam.contaminated_pairs(edge_docs, items).collect()), key=str) == whole
    assert {r[0] for r in whole} == {1, None, 7, 4}
    assert decontam.contaminated_pairs(empty_docs, items).count() == 0
    assert decontam.contaminated_pairs(edge_docs, items.limit(0)).count() == 0
    assert decontam.clean_documents(edge_docs, items.limit(0)).count() == 10
    assert decontam.clean_documents(edge_docs, items).columns == edge_docs.columns


CASES = [("mail a.b@x.org now", "email"), ("call +1 (017) 555-7713 now", "phone"), ("at 97.51.17.173 now", "ipv4"),
         ("pay 4111 1111 1111 1111 now", "card"), ("id 123-45-6789 now", "ssn"), ('token = "0b96a8c8d79c4a5085c919698889f59b72ab7bb6" now', "secret"),
         ("to GB29 NWBK 6016 1331 9268 19 now", "iban"), ("by Anna Schmidt now", "given-latin-f"), ("Иван Петров", "surname-cyrillic")]


@pytest.mark.parametrize(("text", "kind"), CASES)
def test_surrogates_keep_type_and_format(text, kind):
    made, n = pii.replace(text, b"k", {})
    assert made != text and n >= 1 and kind in {m[2] for m in pii.mentions(text)}
    if not kind.startswith(("given", "surname")):
        assert len(made) == len(text) and {m[2] for m in pii.mentions(made)} == {kind}
        assert [c.isdigit() for c in made] == [c.isdigit() for c in text] or kind == "secret"
    assert pii.replace(text, b"k", {}) == (made, n) and pii.replace(text, b"other", {})[0] != made


def test_many_mentions_and_a_taken_count_column(frame):
    import time
    start = time.time()
    got = pii.mentions(" ".join(f"u{k}.x@mail{k % 7}.org" for k in range(60_000)))
    assert len(got) == 60_000 and time.time() - start < 15
    out = pii.pseudonymise(frame([(1, "a.b@x.org", "n")], "doc_id bigint, text string, n_found string"), "k", count_col="n_found")
    assert out.columns == ["doc_id", "text", "n_found", "_n_found"] and out.first()._n_found == 1 and out.first().n_found == "n"


def test_gender_script_case_and_checksum():
    made = pii.replace("Peter Braun, Елена Смирнова, 4111111111111111, Mrs. Smith-Jones", b"k", {})[0]
    names = re.findall(r"[^\W\d]+", made)
    assert names[0] in pii.GIVEN["latin-m"] and names[2] in pii.GIVEN["cyrillic-f"] and pii.script(names[3]) == "cyrillic"
    assert pii.luhn(re.search(r"\d{16}", made)[0]) and re.search(r"Mrs\. [A-Z][a-z]+-[A-Z][a-z]+$", made)


def test_clean_texts_stay():
    for text in (PROSE, "version 2.0. CC BY-NC 4.0. in 1999, 3.14 and 12-30", "", "Anna. Peter said 12345 Maria", "a@b", "1.2.3.4.5"):
        assert pii.replace(text, b"k", {}) == (text, 0)


@pytest.mark.parametrize("limit", [pii.BROADCAST_ROWS, 0])
def test_coreference_and_distinctness(frame, monkeypatch, limit):
    """Short numbers collide and must be drawn again; both ways of giving redrawn entities back agree."""
    monkeypatch.setattr(pii, "BROADCAST_ROWS", limit)
    monkeypatch.setattr(pii, "surrogate", lambda key, kind, value, attempt=0, f=pii.surrogate:
                        f"{int(f(key, 'phone', value, attempt)) % 97:010d}" if kind == "phone" else f(key, kind, value, attempt))
    phones = [f"{k:03d}-555-{k:04d}" for k in range(30)]
    docs = [(k, f"call {p} or {phones[k // 2]} again {p}", None, "s") for k, p in enumerate(phones)] + [(99, None), (98, "")]
    # the patched draws live on the driver only, so the mapping is checked on the entity table
    found = frame([("phone", re.sub(r"\D", "", p)) for p in phones], "kind string, value string")
    local = [(k, v, 0, pii.surrogate(b"k", k, v)) for k, v in map(tuple, found.collect())]
    assert len({r[3] for r in local}) < 30
    out = {r.doc_id: r for r in pii.pseudonymise(frame(docs), "k", count_col="n").collect()}
    assert out[99].text is None and (out[98].text, out[98].n, out[99].n) == ("", 0, 0)
    seen = {}
    for k, p in enumerate(phones):
        a, b, c = re.findall(r"\d{3}-\d{3}-\d{4}", out[k].text)
        assert a == c and seen.setdefault(p, a) == a and out[k].n == 3 and seen.get(phones[k // 2], b) == b
    assert len(set(seen.values())) == 30 and not set(seen.values()) & set(phones)


def test_assign_draws_again_until_distinct(spark, frame):
    """IPv4 addresses of one-digit octets have few surrogates, so first draws collide."""
    values = [f"{a}.{b}.{c}.{d}" for a in (1, 2) for b in (3, 4) for c in range(1, 10) for d in range(1, 10)]
    rows = pii.assign(frame([("ipv4", v) for v in values], "kind string, value string"), "k").collect()
    assert sorted(r.value for r in rows) == sorted(values) and len({r.made for r in rows}) == len(values)
    assert not {r.made for r in rows} & set(values) and any(r.attempt for r in rows)


def test_closed_formats_never_run_out(spark, frame):
    """Entities that fill a closed format, or leave few surrogates in it."""
    values = [("ipv4", ".".join(f"{k:04d}")) for k in range(10_000)] + [("email", f"{c}@x.de") for c in "abcdefghijklmnopqrstuvwxyz"]
    values += [("secret", "-" * 12), ("secret", "_" * 12)] + [("phone", f"{k:05d}") for k in range(0, 100_000, 97)]
    rows = pii.assign(frame(values, "kind string, value string"), "k").collect()
    assert sorted((r.kind, r.value) for r in rows) == sorted(values) and len({(r.kind, r.made) for r in rows}) == len(values)
    assert not {(r.kind, r.made) for r in rows} & set(values)
    assert all(pii.mentions(f"at {r.made} now")[0][2] == r.kind for r in rows if r.kind in ("ipv4", "email"))
    assert pii.written("phone", "+1 23 45", "678901") == "+6 78 901"


@pytest.mark.parametrize("limit", [pii.BROADCAST_ROWS, 0])
def test_redrawn_entities_reach_the_texts(spark, frame, monkeypatch, limit):
    monkeypatch.setattr(pii, "BROADCAST_ROWS", limit)
    values = [f"{a}.{b}.{c}.{d}" for a in (1, 2) for b in (3, 4) for c in range(1, 10) for d in range(1, 10)]
    docs = frame([(k, f"host {v} up, {v} down") for k, v in enumerate(values)])
    made = [set(re.findall(r"\d+\.\d+\.\d+\.\d+", r.text)) for r in pii.pseudonymise(docs, "k").collect()]
    assert all(len(m) == 1 for m in made) and len(set.union(*made)) == len(values) and not set.union(*made) & set(values)


def test_pii_query_and_edges(spark, edge_docs, empty_docs):
    docs = table("sf0.01", "documents").set_index("doc_id").text
    rows = queries.op4_surrogates(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(docs)
    for r in rows:
        old = docs[r.doc_id]
        for pattern in (r"[\w.]+@[\w.]+\w", r"(?<!\d)\d{16}(?!\d)", r"\+1 \(\d+\) \d+-\d+", r"\d+\.\d+\.\d+\.\d+", r"(?<=[nN] = \")[0-9a-fA-F]{40}"):
            assert not set(re.findall(pattern, old)) & set(re.findall(pattern, r.text))
        assert (r.n_entities == 0) == (r.text == old)
    out = pii.pseudonymise(edge_docs, "k")
    assert out.columns == edge_docs.columns and out.exceptAll(edge_docs).count() == 0
    assert pii.pseudonymise(empty_docs, "k", count_col="n").count() == 0
