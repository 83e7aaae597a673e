"""Benchmark decontamination by pigeonhole edit matching (operator 6).

A test item of m characters (normalised) may differ by k = m / 10 edits. It is split into k + 1 pieces: whatever the
edits, one piece stays whole. All pieces of all items are found in one pass over a text by an Aho-Corasick automaton.
A hit is verified with Myers' bit-parallel distance from the piece upwards: items are halved into budgets that add up
to one less than their parent's, so the half that holds the hit is tried first over a short window, and only a hit that
survives every level is matched against the whole item.

The items are a stated query set matched against every text, in blocks of bounded size, each broadcast.
"""

from __future__ import annotations

import bisect
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from webloom.llm.storage import arrow_map
from webloom.llm.words import free_name

#: Edits that an item may differ by, as a share of its characters; characters from which an item may lie anywhere in a
#: text (a shorter one must begin and end with words, as short strings occur inside others); item characters of a block,
#: about.
RATE, LEAST, BLOCK_CHARS = 0.1, 40, 4_000_000

_WORD = re.compile(r"\w+")


def normalise(text: str) -> str:
    """Lower-case words (letters, digits, underscores) with one space between them."""
    return " ".join(_WORD.findall(text.lower()))


def masks(pattern: str) -> dict[str, int]:
    """For each character the positions of the pattern that hold it, as bits."""
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


def best_match(bits: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """(least edit distance of the pattern to any stretch of ``text``, end of the first such stretch)."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, m, 0
    get = bits.get
    for at, c in enumerate(text, 1):
        eq = get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
            if score < best:
                best, end = score, at
        ph, mh = ph << 1 & full, mh << 1 & full
        pv = mh | (full & ~(xv | ph))
        mv = ph & xv
    return best, end


def match_at_words(bits: dict[str, int], m: int, text: str, start: int, budget: int) -> tuple[int, int]:
    """(least edit distance of the pattern to a stretch from ``start`` to the end of a word, that end); m + 1 if none
    is near. The same recurrence as ``best_match`` with the start held fixed."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end, size = full, 0, m, m + 1, 0, len(text)
    for at in range(start, min(size, start + m + budget)):
        eq = bits.get(text[at], 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        score += 1 if ph & top else -1 if mh & top else 0
        ph, mh = (ph << 1 | 1) & full, mh << 1 & full
        pv = mh | (full & ~(xv | ph))
        mv = ph & xv
        if score < best and (at + 1 == size or text[at + 1] == " ") and text[at] != " ":
            best, end = score, at + 1
    return best, end


class Node:
    """A stretch of an item with its budget of edits; a leaf (budget 0) is a piece that must be found whole."""

    __slots__ = ("bits", "budget", "end", "parent", "start")

    def __init__(self, start: int, end: int, budget: int, parent: Node | None):
        self.start, self.end, self.budget, self.parent, self.bits = start, end, budget, parent, None


def leaves(start: int, end: int, budget: int, parent: Node | None = None) -> Iterator[Node]:
    """Leaves of the halving tree: children's budgets add up to one less than their parent's."""
    node = Node(start, end, budget, parent)
    if budget == 0:
        yield node
        return
    left = (budget - 1) // 2
    cut = start + (end - start) * (left + 1) // (budget + 1)
    yield from leaves(start, cut, left, node)
    yield from leaves(cut, end, budget - 1 - left, node)


class Matcher:
    """All items of a block. Items are (id, text) pairs; texts that normalise to nothing match nothing."""

    def __init__(self, items: list[tuple], rate: float = RATE):
        import ahocorasick

        self.items, self.rate, pieces = [], rate, {}
        for ident, text in items:
            norm = normalise(text or "")
            if not norm:
                continue
            self.items.append((ident, norm))
            for leaf in leaves(0, len(norm), int(len(norm) * rate)):
                pieces.setdefault(norm[leaf.start:leaf.end], []).append((len(self.items) - 1, leaf))
        self.finder = ahocorasick.Automaton()
        for piece, where in pieces.items():
            self.finder.add_word(piece, (len(piece), where))
        if pieces:
            self.finder.make_automaton()

    def matches(self, text: str) -> list[tuple]:
        """(item id, distance, end in the normalised text) of each item that is in the text within its budget."""
        norm = normalise(text)
        if not self.items or not norm:
            return []
        best: dict[int, tuple[int, int]] = {}
        done: dict[int, list[int]] = {}  # starts of accepted matches, in order
        for last, (size, where) in self.finder.iter(norm):
            at = last + 1 - size
            for k, leaf in where:
                if best.get(k, (1, 0))[0] == 0:
                    continue
                item = self.items[k][1]
                begin, node, got = at - leaf.start, leaf, (0, 0)
                budget = int(len(item) * self.rate)
                if len(item) < LEAST:
                    got = self._short(item, leaf, norm, begin, budget)
                    if got[0] <= budget and (k not in best or got < best[k]):
                        best[k] = got
                    continue
                near = done.setdefault(k, [])
                place = bisect.bisect_left(near, begin - budget)
                if place < len(near) and near[place] <= begin + budget:
                    continue  # an accepted match already covers every alignment of this hit
                while node.parent is not None:
                    node = node.parent
                    if node.bits is None:
                        node.bits = masks(item[node.start:node.end])
                    # the whole item is matched over twice the margin, which covers the alignments of hits near by
                    margin = node.budget * (1 if node.parent else 2)
                    lo = max(0, begin + node.start - margin)
                    got = best_match(node.bits, node.end - node.start, norm[lo:begin + node.end + margin])
                    got = (got[0], lo + got[1])
                    if got[0] > node.budget:
                        break
                else:
                    if leaf.parent is None:
                        got = (0, last + 1)
                    bisect.insort(near, begin)
                    if k not in best or got < best[k]:
                        best[k] = got
        return [(self.items[k][0], d, end) for k, (d, end) in sorted(best.items())]

    @staticmethod
    def _short(item: str, leaf: Node, norm: str, begin: int, budget: int) -> tuple[int, int]:
        """Best match of a short item from the words that begin within the budget of the hit's alignment."""
        root = leaf
        while root.parent is not None:
            root = root.parent
        if root.bits is None:
            root.bits = masks(item)
        starts = [at for at in range(max(0, begin - budget), min(len(norm), begin + budget + 1)) if at == 0 or norm[at - 1] == " "]
        return min((match_at_words(root.bits, len(item), norm, at, budget) for at in starts), default=(budget + 1, 0))


def item_blocks(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple]]:
    """The items in blocks of about ``block_chars`` characters, each block small enough to broadcast."""
    items = benchmark.select(F.col(item_col).alias("i"), F.col(text_col).cast("string").alias("t")).filter(F.col("t").isNotNull())
    total = items.agg(F.sum(F.length("t"))).first()[0] or 0
    n = max(1, math.ceil(total / block_chars))
    part = F.pmod(F.xxhash64("i", "t"), F.lit(n))
    for k in range(n):
        block = items.filter(part == k).distinct().collect()
        if block:
            yield sorted(((r.i, r.t) for r in block), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc id, item id, distance, match_end) for each row of ``docs`` and each item that its whole text holds.

    ``match_end`` counts characters of the normalised text. Null and empty texts, and items without a word, match
    nothing; equal items each give their row, repeated rows of ``docs`` too. Items shorter than LEAST characters have
    the same budget but must begin and end with words. Other columns are not read; a name that occurs twice in the
    result (both ids called alike) gets underscores before it. An empty table on either side gives an empty result.
    """
    spark = docs.sparkSession
    schema, kinds = T.StructType([]), (docs.schema[id_col].dataType, benchmark.schema[item_col].dataType, T.IntegerType(), T.LongType())
    for name, kind in zip((id_col, item_col, "distance", "match_end"), kinds, strict=True):
        schema = schema.add(free_name(schema.names, name), kind)
    out = spark.createDataFrame([], schema)
    for block in item_blocks(benchmark, item_col, item_text_col):
        found = _match(docs.select(id_col, F.col(text_col).cast("string").alias("text")), block, schema)
        out = out.unionByName(found)
    return out


def _match(rows: DataFrame, block: list[tuple], schema: T.StructType) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value)
        for batch in batches:
            ids, hits = [], []
            for k, text in enumerate(batch.column(1)):
                for hit in matcher.matches(text.as_py() or ""):
                    ids.append(k)
                    hits.append(hit)
            kinds = [to_arrow_type(schema[1].dataType), pa.int32(), pa.int64()]
            columns = [pa.array([h[c] for h in hits], kinds[c]) for c in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ids, pa.int64())), *columns], names=schema.names)

    return arrow_map(rows, run, schema)


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                    item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item, all columns as they were. Edge cases as in ``contaminated_pairs``."""
    out, at, columns = docs, docs.columns.index(text_col), docs.columns
    for block in item_blocks(benchmark, item_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value)
            for batch in batches:
                yield batch.filter(pa.array([not matcher.matches(t.as_py() or "") for t in batch.column(at)], pa.bool_()))

        out = arrow_map(out, run, docs.schema)
    return out.select(*columns)
