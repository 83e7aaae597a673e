"""N-gram Jaccard join by T-occurrence search (operator 2).

A document's set holds 64-bit hashes of its distinct word 5-grams. Two sets of a and b members link when they share
at least T = ceil(4 (a + b) / 9) of them, which is a Jaccard similarity of 0.8.

1. One pass gives each document its set size and a digest of its set (equal sets are one *node* from here on), and
   counts all shingles in a fixed number of cells (leading bits of the hash). Spark adds the counts up by range of
   cells; the fullest cells, a bounded number, are broadcast. They order shingles only: any order gives the same links.
2. Inverted lists. A set is ordered by (count, hash), so that its shingles with long lists come last. Two sets that link
   share one of the first n - ceil(4n/5) + 1 of each, so only these short lists are built: postings are dealt by
   shingle, and a list that a large share of all documents is in is dealt in salted parts.
3. In each list the member that is made of the commonest shingles leads, and members whose size or place does not let
   them link with it have a leader for each band of sizes; every node is searched against its best leader. That settles groups of copies with one search for each member, not one for each pair.
4. Components of the links so far are found. Only lists that still hold members of different components go on: pairs of
   members of different components whose sizes and places in the order allow T, and whose counts by hash bucket do,
   are searched as well.
5. A search is DivideSkip: the whole sets of a block of candidates are turned into inverted lists; of the lists of the
   query's members the longest are put aside, the short ones are heap-merged with skips, and those candidates that can
   still reach T are looked up in the long lists by binary search. Only this decides which candidates link.

Sets are fetched for the nodes that have candidates only: their documents are picked by a Bloom filter of bounded size
while the text is read, so that the texts of other documents are not shuffled.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm.components import components
from webloom.llm.storage import arrow_map, saved
from webloom.llm.words import U64, Words, free_name, mix, slices, text_bytes

SHINGLE = 5
#: Cells that shingles are counted in; shingles counted at once; cells broadcast with their counts at most; count from which one is.
CELL_BITS, FLUSH, LISTED, LEAST_COUNT = 27, 1 << 22, 1 << 20, 4
CELLS = 1 << CELL_BITS
#: Members of a part of a salted list, about; candidates searched together, and members of their sets from which a search begins.
PART_ROWS, BLOCK, BLOCK_MEMBERS = 50_000, 128, 1 << 20
#: Postings of a packed value, about; a list is never cut.
PACKED_ROWS = 1 << 18
BLOOM_BITS = 1 << 26
#: Dropped rows whose keys may be broadcast; more are joined.
BROADCAST_ROWS = 1_000_000
MU = 0.0085  # DivideSkip's cost ratio

POSTING = np.dtype([("h", "<u8"), ("node", "<i8"), ("n", "<u4"), ("at", "<u2"), ("pop", "<u2")])
STAR = np.dtype([("leader", "<i8"), ("node", "<i8"), ("ln", "<u4"), ("n", "<u4"), ("pop", "<u4"), ("tried", "<u4")])
#: Bounds of size bands: sets of one band may link by size, sets of bands that are not neighbours may not.
BANDS = [1]
while BANDS[-1] < 1 << 32:
    BANDS.append(BANDS[-1] * 5 // 4 + 1)


def least_overlap(a, b):
    """Shared members that sets of a and b need: 100 * shared >= 80 * union."""
    return -(-4 * (a + b) // 9)


def prefix(n):
    """Members, in the common order, of which linked sets share one."""
    return n - (-(-4 * n // 5)) + 1


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, ascending distinct shingle hashes) of every text of a batch that has a word. A-Z count as a-z."""
    data, offs = text_bytes(column)
    for i, j in slices(offs):
        w = Words(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], lower=True)
        at, h = w.windows(SHINGLE, whole_short=True)
        cut = np.searchsorted(w.row[at], np.arange(j - i + 1))
        for k in range(j - i):
            if cut[k] < cut[k + 1]:
                yield i + k, np.unique(h[cut[k]:cut[k + 1]])


def digest(members: np.ndarray) -> int:
    """64-bit digest of a set."""
    total = np.add.reduce(mix(members ^ U64(0x5851F42D4C957F2D)))
    return int(mix(np.array([total ^ U64(len(members))], U64)).view(np.int64)[0])


class Cells:
    """Counts of shingles by cell, the leading bits of their hash, as values that hold about a byte for each cell.

    A cell's count is at least that of any of its shingles. A value is cut for each range of cells, so that ranges are
    added up apart; ``waiting`` is emptied at FLUSH shingles, so a task's size does not matter.
    """

    def __init__(self, ranges: int):
        self.width, self.waiting, self.n = -(-CELLS // ranges), [], 0

    def add(self, members: np.ndarray) -> list[tuple[int, bytes]]:
        self.waiting.append(cell_of(members).astype("<u4"))
        self.n += len(members)
        return self.settle() if self.n >= FLUSH else []

    def settle(self) -> list[tuple[int, bytes]]:
        """(range, packed cells and counts) of what waits."""
        if not self.n:
            return []
        cells, counts = np.unique(np.concatenate(self.waiting), return_counts=True)
        self.waiting, self.n = [], 0
        cut = np.searchsorted(cells, np.arange(0, CELLS + self.width, self.width))
        return [(r, pack_cells(cells[i:j] - np.uint32(r * self.width), counts[i:j])) for r, (i, j) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)) if i < j]


def cell_of(members: np.ndarray) -> np.ndarray:
    return members >> U64(64 - CELL_BITS)


def pack_cells(cells: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending cells as steps of a byte each (255: the step is in the list that follows), then the counts over 1."""
    step = np.diff(cells, prepend=np.uint32(0))
    far, many = step >= 255, np.flatnonzero(counts > 1)
    return b"".join([np.array([len(cells), far.sum(), len(many)], "<u4").tobytes(), step[far].astype("<u4").tobytes(), many.astype("<u4").tobytes(),
                     counts[many].astype("<u4").tobytes(), np.where(far, 255, step).astype(np.uint8).tobytes()])


def unpack_cells(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, far, many = np.frombuffer(packed, "<u4", 3).tolist()
    wide = np.frombuffer(packed, "<u4", far + 2 * many, 12)
    step = np.frombuffer(packed, np.uint8, n, 12 + 4 * len(wide)).astype(np.int64)
    step[step == 255] = wide[:far]
    counts = np.ones(n, np.int64)
    counts[wide[far:far + many]] = wide[far + many:]
    return np.cumsum(step), counts


def count_of(h: np.ndarray, listed: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Count of the cell of each shingle, 0 where it is not listed."""
    keys, counts = listed
    if not len(keys):
        return np.zeros(len(h), np.int64)
    cells = cell_of(h)
    at = np.minimum(np.searchsorted(keys, cells), len(keys) - 1)
    return np.where(keys[at] == cells, counts[at], 0)


def _deal(parts: np.ndarray, rows: np.ndarray, n_parts: int) -> Iterator[tuple[int, bytes]]:
    """(part, bytes of its rows) for each part that has rows."""
    order = np.argsort(parts, kind="stable")
    rows = rows[order]
    cut = np.searchsorted(parts[order], np.arange(n_parts + 1))
    for p in range(n_parts):
        if cut[p] < cut[p + 1]:
            yield p, rows[cut[p]:cut[p + 1]].tobytes()


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)


def _whole(batches: Iterator[pa.RecordBatch], column: int, dtype: np.dtype) -> np.ndarray:
    """All packed rows that a task gets."""
    found = [np.frombuffer(v.as_buffer(), dtype) for b in batches for v in b.column(column)]
    return np.concatenate(found) if found else np.zeros(0, dtype)


def documents_and_counts(docs: DataFrame, id_col: str, text_col: str, ranges: int) -> DataFrame:
    """Rows (id, text_hash, n, node, part, packed): a row for each document, and packed counts of cells by range of cells."""
    schema = "id long, text_hash long, n long, node long, part int, packed binary"
    names, types = ["id", "text_hash", "n", "node", "part", "packed"], [pa.int64()] * 4 + [pa.int32(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = Cells(ranges)
        for batch in batches:
            n, node = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for row, members in shingle_sets(batch.column(1)):
                n[row], node[row] = len(members), digest(members)
                if full := cells.add(members):
                    yield _batch([(None, None, None, None, *v) for v in full], names, types)
            none = pa.nulls(batch.num_rows, pa.int32()), pa.nulls(batch.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n), pa.array(node), *none], names=names)
        yield _batch([(None, None, None, None, *v) for v in cells.settle()], names, types)

    text = F.col(text_col).cast("string")
    return arrow_map(docs.select(F.col(id_col).cast("long"), text, F.xxhash64(text)), run, schema)


def frequent(packed: DataFrame, total: int, ranges: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(ascending cells, counts over the mean) of the fullest cells, LISTED at most.

    The least count stands clear of chance (four deviations over the mean) and comes from a histogram of the counts, so
    that as many as fit are listed; a cell that holds more than 1 / LISTED of all shingles always is.
    """
    width, mean = -(-CELLS // ranges), total / CELLS
    least = max(LEAST_COUNT, math.ceil(mean + 4 * math.sqrt(mean)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, counts = None, np.zeros(width, np.int64)

        def full() -> pa.RecordBatch:
            on = np.flatnonzero(counts >= least)
            return pa.RecordBatch.from_arrays([pa.array(on + part * width), pa.array(counts[on])], names=["h", "c"])

        for batch in batches:
            for p, v in zip(*batch.columns, strict=True):
                if p.as_py() != part:
                    if part is not None:
                        yield full()
                        counts[:] = 0
                    part = p.as_py()
                cells, own = unpack_cells(v.as_py())
                counts[cells] += own
        if part is not None:
            yield full()

    top = 4096
    merged = saved(arrow_map(packed.select("part", "packed").repartition(parts, "part").sortWithinPartitions("part"), run, "h long, c long"))
    bins = {r.c: r["count"] for r in merged.groupBy(F.least(F.col("c") - least, F.lit(top)).alias("c")).count().collect()}
    held, over = 0, top + 1
    for c in sorted(bins, reverse=True):
        held += bins[c]
        if held > LISTED:
            break
        over = c
    if over > top and bins:  # more cells than are listed stand that far out: those that hold more than 1 / LISTED of all
        over = max(top, -(-total // LISTED) - least)
    got = merged.filter(F.col("c") >= least + over).toArrow()
    keys, counts = got["h"].to_numpy().astype(U64), got["c"].to_numpy() - int(mean)
    order = np.argsort(keys)
    return keys[order], counts[order]


def postings(docs: DataFrame, text_col: str, listed: tuple[np.ndarray, np.ndarray], parts: int) -> DataFrame:
    """(part, packed POSTING rows) of the short lists of every text; equal sets count once in a task."""
    shared = docs.sparkSession.sparkContext.broadcast(listed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        rows, held = [], 0

        def flush() -> pa.RecordBatch:
            got = np.concatenate(rows)
            return _batch(list(_deal(list_part(got["h"], got["node"], shared.value, parts), got, parts)), ["part", "packed"], [pa.int32(), pa.binary()])

        for batch in batches:
            for _, members in shingle_sets(batch.column(0)):
                node, n = digest(members), len(members)
                if node in seen:
                    continue
                seen.add(node)
                count = count_of(members, shared.value)
                own = prefix(n)
                order = np.lexsort((members, count))[:own]
                one = np.empty(own, POSTING)
                one["h"], one["node"], one["n"] = members[order], node, n
                one["at"] = np.arange(own) * 65535 // n  # rounded down: a place is never taken for a later one
                one["pop"] = int((count > 0).sum()) * 65535 // n
                rows.append(one)
                held += own
            if held > 1 << 18:
                yield flush()
                rows, held = [], 0
        if rows:
            yield flush()

    return arrow_map(docs.select(F.col(text_col).cast("string")), run, "part int, packed binary")


def salt(h: np.ndarray, node: np.ndarray, listed: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Part of its list that a posting is in: 0, or one of count / PART_ROWS for a long list."""
    many = np.maximum(1, -(-count_of(h, listed) // PART_ROWS))
    return (mix(node.view(U64)) % many.astype(U64)).astype(np.int64)


def list_part(h: np.ndarray, node: np.ndarray, listed: tuple[np.ndarray, np.ndarray], parts: int) -> np.ndarray:
    return (mix(h + salt(h, node, listed).astype(U64) * U64(0x9E3779B97F4A7C15)) % U64(parts)).astype(int)


def _may_link(n1, at1, n2, at2):
    """Whether sets that first meet at these places can reach T: sizes fit, and enough members follow."""
    left = np.minimum(n1 - (at1.astype(np.int64) * n1 // 65535), n2 - (at2.astype(np.int64) * n2 // 65535))
    return (5 * np.minimum(n1, n2) >= 4 * np.maximum(n1, n2)) & (left >= least_overlap(n1, n2))


def _largest_partner(n, at):
    """Size up to which a set may link with others that it first meets at this place."""
    return 9 * (n - (at * n // 65535)) // 4 - n


def _live_lists(rows: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For each list whether sizes and places allow any pair of its members."""
    n = rows["n"].astype(np.int64)
    order = np.lexsort((n, group))
    n, at, g = n[order], rows["at"][order].astype(np.int64), group[order]
    most, base = _largest_partner(n, at), g << 34
    before = np.minimum(np.searchsorted(base + n, base + most, "right"), np.arange(len(n)))  # earlier ones that this one may link
    best = np.concatenate([[-1], np.maximum.accumulate(base + most)])[before]
    out = np.zeros(group.max() + 1, bool)
    out[g[best >= base + n]] = True
    return out


def _last_of(group: np.ndarray) -> np.ndarray:
    """Places at which an ascending group number ends."""
    return np.flatnonzero(np.append(group[1:] != group[:-1], True))


def _cuts(group: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Bounds of runs of whole groups, of about ``size`` rows each."""
    if not len(group):
        return []
    ends = _last_of(group) + 1
    ends = np.unique(ends[np.searchsorted(ends, np.minimum(np.arange(size, len(group) + size, size), len(group)))])
    return list(zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True))


def _stars(leader: np.ndarray, member: np.ndarray) -> np.ndarray:
    """STAR rows; ``tried`` is 0 where sizes or places do not allow the pair, which is then never searched."""
    out = np.empty(len(leader), STAR)
    out["leader"], out["node"], out["ln"], out["n"], out["pop"] = leader["node"], member["node"], leader["n"], member["n"], leader["pop"]
    out["tried"] = _may_link(leader["n"].astype(np.int64), leader["at"], member["n"].astype(np.int64), member["at"])
    return out[out["leader"] != out["node"]]


def _leaders(rows: np.ndarray, group: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(STAR rows, places in ``rows`` of all leaders) of whole lists.

    The member of the commonest shingles leads the list. Members that cannot link with it have a leader for each band of
    sizes. Pairs that connect the leaders of neighbouring bands, or of a band and the list, are rows as well: if both
    nodes of every row of a list are in one component, so are both nodes of every pair that the list allows.
    """
    order = np.lexsort((rows["node"], rows["pop"], group))
    last = order[_last_of(group[order])]
    lead = np.zeros(group.max() + 1, np.int64)
    lead[group[last]] = last
    n, leader = rows["n"].astype(np.int64), rows[lead[group]]
    on = _may_link(leader["n"].astype(np.int64), leader["at"], n, rows["at"])
    stars = [_stars(leader[on], rows[on])]
    own = on | (rows["node"] == leader["node"])
    rest = np.flatnonzero(~own & live[group])
    if not len(rest):
        return np.unique(stars[0]), last
    low, high = np.full(len(lead), np.iinfo(np.int64).max), np.zeros(len(lead), np.int64)  # sizes that the list's leader stands for
    np.minimum.at(low, group[own], n[own])
    np.maximum.at(high, group[own], n[own])
    band = np.searchsorted(BANDS, n[rest], "right")
    rest = rest[order := np.lexsort((rows["node"][rest], rows["pop"][rest], band, group[rest]))]
    key = (group[rest] << 8) + band[order]
    ends = _last_of(key)
    starts = np.append(0, ends[:-1] + 1)
    heads = rest[ends]
    stars.append(_stars(rows[np.repeat(heads, ends - starts + 1)], rows[rest]))
    least, most = np.minimum.reduceat(n[rest], starts), np.maximum.reduceat(n[rest], starts)
    near = (4 * least <= 5 * high[group[heads]]) & (5 * most >= 4 * low[group[heads]])
    stars.append(_stars(leader[heads[near]], rows[heads[near]]))
    near = np.flatnonzero((key[ends][1:] == key[ends][:-1] + 1) & (4 * least[1:] <= 5 * most[:-1]))
    x, y = rows[heads[near]], rows[heads[near + 1]]
    first = (x["pop"] > y["pop"]) | ((x["pop"] == y["pop"]) & (x["node"] > y["node"]))
    stars.append(_stars(np.where(first, x, y), np.where(first, y, x)))
    return np.unique(np.concatenate(stars)), np.concatenate([last, heads])


def lists_with_leaders(dealt: DataFrame, listed: tuple[np.ndarray, np.ndarray], parts: int) -> DataFrame:
    """Rows (kind, part, packed) from whole parts of lists: kind 0, STAR rows; kind 1, postings of lists that allow a pair
    and of salted lists; kind 2, postings of the leaders of salted lists."""
    shared = dealt.sparkSession.sparkContext.broadcast(listed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = _whole(batches, 1, POSTING)
        if len(got):
            got = got[np.lexsort((got["node"], got["h"]))]
            once = np.ones(len(got), bool)  # equal sets of several tasks become one
            once[1:] = (got["h"][1:] != got["h"][:-1]) | (got["node"][1:] != got["node"][:-1])
            got = got[once]
            s = salt(got["h"], got["node"].copy(), shared.value)
            if s.any():
                got, s = got[order := np.lexsort((got["node"], s, got["h"]))], s[order]
            new = np.ones(len(got), bool)
            new[1:] = (got["h"][1:] != got["h"][:-1]) | (s[1:] != s[:-1])
            group = np.cumsum(new) - 1
            size = np.bincount(group)
            salted = count_of(got["h"], shared.value) > PART_ROWS
            keep = (size[group] > 1) | salted
            got, group, salted = got[keep], group[keep], salted[keep]
        if not len(got):
            return
        live = _live_lists(got, group)
        star, lead = _leaders(got, group, live)
        rows = [(0, 0, star.tobytes())] if len(star) else []
        tops = np.unique(got[lead[salted[lead]]])
        on = live[group] | salted
        got, group = got[on], group[on]
        rows += [(1, 0, got[i:j].tobytes()) for i, j in _cuts(group, PACKED_ROWS)]
        rows += [(2, p, b) for p, b in _deal((mix(tops["h"]) % U64(parts)).astype(int), tops, parts)]
        yield _batch(rows, ["kind", "part", "packed"], [pa.int32(), pa.int32(), pa.binary()])

    return arrow_map(dealt.repartition(parts, "part"), run, "kind int, part int, packed binary")


def leaders_of_salted(tops: DataFrame, parts: int) -> DataFrame:
    """STAR rows between the leaders of the parts of each salted list."""
    nothing = (np.zeros(0, U64), np.zeros(0, np.int64))
    return lists_with_leaders(tops, nothing, parts).filter("kind = 0")


def unpack_stars(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for v in batch.column(0):
                got = np.frombuffer(v.as_buffer(), STAR)
                yield pa.RecordBatch.from_arrays([pa.array(got[c].astype(np.int64)) for c in STAR.names], names=list(STAR.names))

    return arrow_map(rows.select("packed"), run, "leader long, node long, ln long, n long, pop long, tried long")


class Bloom:
    """Membership of longs with four bits each; false positives only. Of fixed size, so it can be broadcast."""

    def __init__(self, bits: int = BLOOM_BITS):
        self.mask, self.words = U64(bits - 1), np.zeros(bits // 64, U64)

    def places(self, values: np.ndarray) -> np.ndarray:
        a, b = mix(values.view(U64) ^ U64(0x2545F4914F6CDD1D)), mix(values.view(U64) + U64(0x632BE59BD9B4E019))
        return np.concatenate([(a + U64(k) * b) & self.mask for k in range(4)])

    def has(self, values: np.ndarray) -> np.ndarray:
        if not len(values):
            return np.zeros(0, bool)
        at = self.places(values)
        return ((self.words[(at >> U64(6)).astype(np.int64)] >> (at & U64(63))) & U64(1)).reshape(4, -1).all(axis=0)


def bloom_of(values: DataFrame) -> Bloom:
    """Bloom filter of a column of longs: bits are set in the tasks and or-ed by Spark; at most BLOOM_BITS / 64 words."""
    out = Bloom()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Bloom()
        for batch in batches:
            at = own.places(batch.column(0).drop_null().to_numpy())
            np.bitwise_or.at(own.words, (at >> U64(6)).astype(np.int64), U64(1) << (at & U64(63)))
        on = np.flatnonzero(own.words)
        yield pa.RecordBatch.from_arrays([pa.array(on), pa.array(own.words[on].view(np.int64))], names=["w", "bits"])

    got = arrow_map(values.coalesce(64), run, "w long, bits long").groupBy("w").agg(F.bit_or("bits").alias("bits")).toArrow()
    out.words[got["w"].to_numpy()] = got["bits"].to_numpy().view(U64)
    return out


def divide_skip(lists: list[list[int]], need: list[int]) -> list[tuple[int, int]]:
    """(candidate, count) of the candidates that are in ``need[candidate]`` of the lists at least.

    ``lists``: ascending candidate numbers. The longest lists are put aside; the others are merged by a heap of their
    heads, and lists whose heads cannot reach the smallest need skip ahead by binary search; a candidate that could
    reach its own need with all long lists is looked up in these.
    """
    lists = sorted((x for x in lists if x), key=len)
    t = max(1, min(need, default=1))
    if len(lists) < t:
        return []
    aside = min(t - 1, int(t / (MU * math.log2(max(2, len(lists[-1]))) + 1)))
    short, long = lists[:len(lists) - aside], lists[len(lists) - aside:]
    t -= aside
    at = [0] * len(short)
    heap = [(x[0], k) for k, x in enumerate(short)]
    heapq.heapify(heap)
    out = []
    while heap:
        top, popped = heap[0][0], []
        while heap and heap[0][0] == top:
            popped.append(heapq.heappop(heap)[1])
        if len(popped) >= t:
            count = len(popped)
            if count + len(long) >= need[top]:
                for x in long:
                    p = bisect_left(x, top)
                    count += p < len(x) and x[p] == top
                if count >= need[top]:
                    out.append((top, count))
            ahead = top + 1
        else:
            while heap and len(popped) < t - 1:
                popped.append(heapq.heappop(heap)[1])
            if not heap:
                break  # fewer lists are left than a candidate needs
            ahead = max(heap[0][0], top + 1)
        for k in popped:
            at[k] = bisect_left(short[k], ahead, at[k])
            if at[k] < len(short[k]):
                heapq.heappush(heap, (short[k][at[k]], k))
    return out


class Inverted:
    """Inverted lists over the whole sets of a block: the ascending numbers of the sets that hold each shingle."""

    def __init__(self, sets: list[np.ndarray]):
        members = np.concatenate(sets) if sets else np.zeros(0, U64)
        order = np.argsort(members, kind="stable")
        self.members, self.sets = members[order], np.repeat(np.arange(len(sets), dtype=np.int32), [len(s) for s in sets])[order]

    def lists(self, query: np.ndarray) -> list[list[int]]:
        """The list of each member of the query that has one."""
        low, high = np.searchsorted(self.members, query, "left"), np.searchsorted(self.members, query, "right")
        on = low < high
        return [self.sets[i:j].tolist() for i, j in zip(low[on].tolist(), high[on].tolist(), strict=True)]


def search(query: np.ndarray, sets: list[np.ndarray]) -> list[int]:
    """Numbers of the sets that link with the query: a T-occurrence search by DivideSkip over inverted lists. No overlap
    is counted before it; which sets reach their T is known from its merge and its probes alone."""
    return sorted(k for k, _ in divide_skip(Inverted(sets).lists(query), [int(least_overlap(len(query), len(s))) for s in sets]))


def sketch(members: np.ndarray) -> bytes:
    """Members by hash bucket. Sets share at most the sum of the smaller counts of each bucket."""
    return np.bincount((members >> U64(56)).astype(np.int64), minlength=256).astype("<u4").tobytes()


def _row_hash(ident: Column, text_hash: Column) -> Column:
    """Number by which a node's document is found again, one for a null id too."""
    return F.xxhash64(ident, text_hash)


def _of_nodes(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, text_col: str, id_col: str, make) -> DataFrame:
    """(node, made) of each node of ``pairs``, ``make`` applied to its set; other texts are not shingled or shuffled."""
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    bloom = docs.sparkSession.sparkContext.broadcast(bloom_of(nodes.join(wanted, "node").select("row")))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(bloom.value.has(batch.column(0).to_numpy())))
            for k in range(0, batch.num_rows, 64):
                rows = [(digest(m), make(m)) for _, m in shingle_sets(batch.column(1).slice(k, 64))]
                yield _batch(rows, ["node", "made"], [pa.int64(), pa.binary()])

    text = F.col(text_col).cast("string")
    got = arrow_map(docs.select(_row_hash(F.col(id_col).cast("long"), F.xxhash64(text)), text), sets, "node long, made binary")
    # dealt by node once: joins by node read the same shuffle
    return got.join(wanted, "node", "left_semi").groupBy("node").agg(F.first("made").alias("made"))


def possible(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """Those of ``pairs`` whose sketches allow the shared members they need. No pair that links is lost."""
    made = saved(_of_nodes(pairs, docs, nodes, text_col, id_col, sketch))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 1024):
                part = batch.slice(k, 1024)
                x, y = (np.array([np.frombuffer(v.as_buffer(), "<u4") for v in part.column(c)], np.int64).reshape(-1, 256) for c in (2, 3))
                on = np.minimum(x, y).sum(axis=1) >= least_overlap(x.sum(axis=1), y.sum(axis=1))
                yield part.select(["a", "b"]).filter(pa.array(on))

    both = pairs.join(made.select(F.col("node").alias("a"), F.col("made").alias("x")), "a") \
        .join(made.select(F.col("node").alias("b"), F.col("made").alias("y")), "b").select("a", "b", "x", "y")
    return arrow_map(both, run, "a long, b long")


def verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, text_col: str, id_col: str, parts: int) -> DataFrame:
    """Those of ``pairs`` (a, b: nodes) that link. Each query ``a`` searches its candidates in blocks."""
    found = _of_nodes(pairs, docs, nodes, text_col, id_col, lambda m: m.tobytes()).withColumnRenamed("made", "members")
    order = F.pmod(F.xxhash64("b"), F.greatest(F.lit(1), F.ceil(F.col("size") / BLOCK)))
    sizes = pairs.groupBy("a").agg(F.count("*").alias("size"))
    dealt = pairs.join(sizes, "a").select("a", "b", order.cast("long").alias("block"))
    members = dealt.join(found.withColumnRenamed("node", "b"), "b").select("a", "block", "b", "members")
    queries = dealt.select("a", "block").distinct().join(found.withColumnRenamed("node", "a"), "a").select("a", "block", F.lit(None).cast("long").alias("b"), "members")
    rows = queries.unionByName(members).repartition(parts, "a", "block").sortWithinPartitions("a", "block", F.col("b").asc_nulls_first())

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, query, ids, block, held = None, None, [], [], 0

        def settle() -> pa.RecordBatch:
            links = search(query, block) if query is not None and block else []
            return _batch([(key[0], ids[k]) for k in links], ["a", "b"], [pa.int64(), pa.int64()])

        for batch in batches:
            for a, blk, b, m in zip(*(batch.column(c) for c in range(4)), strict=True):
                if (a.as_py(), blk.as_py()) != key:
                    if key is not None:
                        yield settle()
                    key, query, ids, block, held = (a.as_py(), blk.as_py()), None, [], [], 0
                got = np.frombuffer(m.as_py(), "<u8")
                if not b.is_valid:
                    query = got
                else:
                    ids.append(b.as_py())
                    block.append(got)
                    held += len(got)
                    if len(block) == 4 * BLOCK or held >= BLOCK_MEMBERS:
                        yield settle()
                        ids, block, held = [], [], 0
        if key is not None:
            yield settle()

    return arrow_map(rows, look, "a long, b long")


def open_pairs(kept: DataFrame, stars: DataFrame, comps: DataFrame, listed: tuple[np.ndarray, np.ndarray], parts: int) -> DataFrame:
    """Pairs (a < b) of members of different components that a list brings together and sizes and places allow.

    A list whose STAR rows, tried or not, each join nodes of one component needs no more; the others are known by the
    rows whose nodes ended in different components. Parts of a salted list are dealt pairwise, so no task holds a list.
    """
    label = comps.select("node", "comp")
    split = stars.join(label, "node", "left").withColumn("c1", F.coalesce("comp", "node")).drop("comp") \
        .join(label.withColumnRenamed("node", "leader"), "leader", "left").withColumn("c2", F.coalesce("comp", "leader")).filter("c1 <> c2")
    bloom = kept.sparkSession.sparkContext.broadcast(bloom_of(split.select("leader").unionByName(split.select(F.col("node").alias("leader")))))
    shared = kept.sparkSession.sparkContext.broadcast(listed)

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for v in batch.column(0):
                got = np.frombuffer(v.as_buffer(), POSTING)
                hit = bloom.value.has(got["node"].copy())
                many = np.maximum(1, -(-count_of(got["h"], shared.value) // PART_ROWS))
                lists, which = np.unique(got["h"], return_inverse=True)
                on = (np.bincount(which, hit, len(lists)) > 0)[which] | (many > 1)
                got, many = got[on], many[on]
                own = salt(got["h"], got["node"].copy(), shared.value)
                yield pa.RecordBatch.from_arrays([pa.array(got["h"].view(np.int64) if got["h"].flags["C_CONTIGUOUS"] else got["h"].copy().view(np.int64)),
                                                  *(pa.array(got[c].astype(np.int64)) for c in ("node", "n", "at")), pa.array(own), pa.array(many)],
                                                 names=["h", "node", "n", "at", "own", "many"])

    rows = arrow_map(kept.select("packed"), suspects, "h long, node long, n long, at long, own long, many long")
    rows = rows.join(label, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("many") - 1)))
    rows = rows.select("h", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "n", "at", "comp", "own")
    dealt = rows.repartition(parts, "h", "i", "j").sortWithinPartitions("h", "i", "j", "n")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: np.ndarray | None = None
        for batch in batches:
            got = np.column_stack([batch.column(c).to_numpy() for c in range(8)])
            if rest is not None:
                got = np.vstack([rest, got])
            new = np.append(True, (got[1:, :3] != got[:-1, :3]).any(axis=1))
            starts = np.flatnonzero(new)
            rest = got[starts[-1]:]
            yield from _pairs(got[:starts[-1]], starts[:-1])
        if rest is not None:
            yield from _pairs(rest, np.zeros(1, int))

    return arrow_map(dealt, pairs, "a long, b long").distinct()


def _pairs(rows: np.ndarray, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Allowed pairs across components of each list part, by distance in the part's order by size: all rows meet the
    next row, then those that still can meet the one after it, and so on."""
    if not len(starts):
        return
    end = np.repeat(np.append(starts[1:], len(rows)), np.diff(np.append(starts, len(rows))))
    _, i, j, node, n, place, comp, own = rows.T
    at, d, out, held = np.arange(len(rows)), 1, [], 0
    while len(at := at[at + d < end[at]]) and len(at := at[4 * n[at + d] <= 5 * n[at]]):
        o = at + d
        on = (comp[o] != comp[at]) & _may_link(n[at], place[at], n[o], place[o]) & ((i[at] == j[at]) | (own[o] != own[at]))
        if on.any():
            x, y = node[at[on]], node[o[on]]
            out.append(np.column_stack([np.minimum(x, y), np.maximum(x, y)]))
            held += len(x)
        if held > 100_000:
            yield _long_pairs(out)
            out, held = [], 0
        d += 1
    if out:
        yield _long_pairs(out)


def _long_pairs(out: list[np.ndarray]) -> pa.RecordBatch:
    got = np.unique(np.vstack(out), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(got[:, 0]), pa.array(got[:, 1])], names=["a", "b"])


def parts_of(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, n_shingles, component_id (smallest id reachable by links, itself included),
    group (a number of the component; null for empty sets) and text_hash.

    A null text, or one without words, has an empty set and is linked with nothing; a text of 1 to 4 words has its
    whole sequence as its one shingle. Repeated rows are copies like any other. A null id takes part in links but is
    no component's id unless the component has no other. Other columns are not read. An empty table gives an
    empty table. Sets are told apart by 64-bit hashes.
    """
    parts = parts_of(docs.sparkSession)
    ranges = min(max(64, parts), 4096)
    first = saved(documents_and_counts(docs, id_col, text_col, ranges))
    rows = first.filter("packed is null").select("id", "text_hash", "n", "node")
    total = rows.agg(F.sum("n")).first()[0] or 0
    listed = frequent(first.filter("packed is not null"), total, ranges, parts)
    nodes = rows.filter("n > 0").groupBy("node").agg(F.min("id").alias("rep"), F.min(_row_hash(F.col("id"), F.col("text_hash"))).alias("row"))
    dealt = saved(lists_with_leaders(postings(docs, text_col, listed, parts), listed, parts))
    salted = saved(leaders_of_salted(dealt.filter("kind = 2").select("part", "packed"), parts))
    stars = saved(unpack_stars(dealt.filter("kind = 0").unionByName(salted)).distinct())
    best = stars.filter("tried = 1").groupBy("node").agg(F.max(F.struct("pop", "leader")).alias("m")).select(F.col("m.leader").alias("a"), F.col("node").alias("b"))
    links = saved(verified(saved(best), docs, nodes, text_col, id_col, parts))
    comps = components(links)
    more = saved(open_pairs(dealt.filter("kind = 1"), stars, comps, listed, parts)
                 .join(best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"))
    if not more.isEmpty():
        more = saved(possible(more, docs, nodes, text_col, id_col))
        comps = components(links.unionByName(verified(more, docs, nodes, text_col, id_col, parts)))
    labels = nodes.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    names = labels.groupBy("comp").agg(F.min("rep").alias("component"))
    named = labels.join(names, "comp").select("node", "comp", "component")
    empty = F.col("n") == 0
    return rows.join(named, "node", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(empty, F.col("id")).otherwise(F.col("component")).alias("component_id"),
        F.when(~empty, F.col("comp")).alias("group"), "text_hash")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near duplicates, all columns as they were: of each group the row with the smallest
    (id, text hash) stays (a null id last), of rows that are equal in both one. Texts without a word all stay.

    The dropped (id, text hash) pairs are broadcast while they are few, and joined beyond that.
    """
    marks = saved(near_duplicates(docs, id_col, text_col).filter("n_shingles > 0").select(F.col(id_col).cast("long").alias("i"), F.col("text_hash").alias("h"), "group"))
    first = marks.groupBy("group").agg(F.min(F.struct(F.col("i").isNull().alias("z"), "i", "h")).alias("k"))
    split = marks.groupBy("group", "i", "h").count().join(first, "group")
    stays = F.col("i").eqNullSafe(F.col("k.i")) & (F.col("h") == F.col("k.h"))
    gone, again = (saved(split.filter(c).select("i", "h").distinct()) for c in (~stays, stays & (F.col("count") > 1)))
    row_i, row_h = F.col(id_col).cast("long"), F.xxhash64(F.col(text_col).cast("string"))

    def among(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        few = keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
        return rows.join(F.broadcast(keys) if few else keys, row_i.eqNullSafe(F.col("i")) & (row_h == F.col("h")), how)

    kept = among(docs, gone, "left_anti")
    if again.isEmpty():
        return kept
    own_h = free_name(docs.columns, "text_hash")
    once = among(kept, again, "left_semi").withColumn(own_h, row_h).dropDuplicates([id_col, own_h]).drop(own_h)
    return among(kept, again, "left_anti").unionByName(once)
