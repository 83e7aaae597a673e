"""Phrase collocation mining (operator 12) with an FM-index for each shard of words.

A shard is a run of pieces as word ids, with 0 between pieces. Its index is the Burrows-Wheeler transform in an order
of four words' depth, in both reading directions; a phrase is an interval of rows in each. Extending a phrase by a
word to the left is one step in the forward transform (the rows of its interval that have that word before them, moved
by the word's offset and rank) and narrows the backward interval by the words that sort before it; the backward
transform then tells what follows. All phrases of one length are extended at once, as arrays.

1. Every shard enumerates its phrases of one to four words and hands on the cells of their hashes with local counts.
   Added up, a cell under the least count proves that no phrase in it is frequent.
2. Every shard enumerates again, extends only phrases in full cells, and hands on those phrases with exact counts.
3. Counts are summed over shards; cuts, extensions and ranks are joins and aggregates of the frequent phrases.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webloom.llm.storage import arrow_map, new_folder
from webloom.llm.words import _LOWER, U64, Words, mix, slices, text_bytes

#: Words of the longest phrase, least count of a candidate, share of its count that a longer candidate must reach to
#: replace it (percent), phrases of each language returned.
DEPTH, LEAST, WITHIN, TOP = 4, 30, 80, 2_000
#: Words of a shard (about); words beyond its end and before its start that serve as context only.
SHARD_WORDS, AFTER, BEFORE = 400_000, DEPTH, 1
#: Cells of the counting sketch and of one block of it; one bit a cell is broadcast (16 MB). In a corpus that fills
#: them all nothing is ruled out early and more phrases are summed; results stay the same.
CELLS, BLOCK = 1 << 27, 1 << 20

_SEP = np.zeros(256, bool)
_SEP[[ord(c) for c in ".,;:!?"]] = True
_SEP[0x0A:0x0E] = True
_GAP = _SEP.copy()
_GAP[[0x20, 0x09]] = True
_STEP = [mix(np.array([0xC0110C + k], U64))[0] | U64(1) for k in range(DEPTH)]


class Pieces(Words):
    """Lower-cased words of a slice, and for each word whether it opens a piece."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        self.data, self.offs, self.n, self._lower = _LOWER[data], offs, len(offs) - 1, False
        inside = ~_GAP[data]
        before, after = np.ones(len(data), bool), np.ones(len(data), bool)
        before[1:], after[:-1] = ~inside[:-1], ~inside[1:]
        inner = offs[1:-1]
        inner = inner[(inner > 0) & (inner < len(data))]
        before[inner], after[inner - 1] = True, True
        self.start = np.flatnonzero(inside & before)
        self.end = np.flatnonzero(inside & after) + 1
        self.first = np.searchsorted(self.start, offs)
        self.row = np.repeat(np.arange(self.n), np.diff(self.first))
        seps = np.concatenate([[0], np.cumsum(_SEP[data])])
        self.opens = np.ones(len(self.start), bool)
        if len(self.start) > 1:
            self.opens[1:] = (seps[self.start[1:]] != seps[self.end[:-1]]) | (self.row[1:] != self.row[:-1])


class FMIndex:
    """Word ids of a shard (0 between pieces) in both reading directions, in an order of DEPTH words.

    ``phrases`` walks all phrases of one length after the other. Rows of equal order may stand in any order among
    themselves: an interval is a set of rows, and a step looks only at how many rows before it have a word.
    """

    def __init__(self, text: np.ndarray, both: bool = True):
        self.text, self.n = text, len(text)
        self.sa, self.bwt = self._transform(text, 1)
        back = self._transform(text, -1) if both else None
        self.back_sa, self.back_bwt = back if back else (None, None)
        self.offset = np.concatenate([[0], np.cumsum(np.bincount(text))])  # C: rows that begin with a smaller word
        # rows by (word before, row): where a step to the left takes them; those behind a 0 are left out
        self.moved = np.argsort((self.bwt << 32) | np.arange(self.n))[self.offset[1]:]

    @staticmethod
    def _transform(text: np.ndarray, way: int) -> tuple[np.ndarray, np.ndarray]:
        """(position of each row, word before it) where rows read forwards (1) or backwards (-1)."""
        t = text if way == 1 else text[::-1]
        n = len(t)
        ahead = np.concatenate([t, np.zeros(DEPTH, t.dtype)]).astype(np.int64)
        pair = (ahead[:-1] << 32) | ahead[1:]
        order = np.argsort(pair)
        rank = np.empty(len(pair), np.int64)
        ranked = pair[order]
        rank[order] = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
        sa = np.argsort((rank[:n] << 32) | rank[2:n + 2])
        bwt = t[sa - 1]  # the word before the first one is the 0 at the end
        return (sa, bwt) if way == 1 else (n - 1 - sa, bwt)

    def phrases(self, depth: int, wanted: Callable[[np.ndarray, int], np.ndarray] | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(length, start and end rows, start rows of the backward interval) for each length up to ``depth``.

        ``wanted(positions, length)``: which phrases (by the position of one occurrence) are handed on and extended.
        """
        word = np.arange(1, len(self.offset) - 1)
        lo, hi = self.offset[word], self.offset[word + 1]
        full = hi > lo
        lo, hi = lo[full], hi[full]
        back = lo.copy()
        for length in range(1, depth + 1):
            if wanted is not None and len(lo):
                keep = wanted(self.sa[lo], length)
                lo, hi, back = lo[keep], hi[keep], back[keep]
            yield length, lo, hi, back
            if length < depth:
                lo, hi, back = self._extend_left(lo, hi, back)

    def _extend_left(self, lo: np.ndarray, hi: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Intervals of all phrases of one word more before those given (ascending ``lo``).

        The row with rank k of its word before it goes to row offset + k: ``moved`` lists the rows by where they go,
        so the rows that one interval and one word have in common lie together there, and begin at offset + Occ.
        """
        size = hi - lo
        owner = np.full(self.n, -1, np.int32)
        owner[np.repeat(lo - np.cumsum(size) + size, size) + np.arange(int(size.sum()))] = np.repeat(np.arange(len(lo), dtype=np.int32), size)
        own = owner[self.moved]
        at = np.flatnonzero(own >= 0)
        own, at = own[at], at + self.offset[1]  # rows behind a 0 go to the first rows, which no phrase begins
        if not len(at):
            return lo[:0], hi[:0], back[:0]
        word = self.bwt[self.moved[at - self.offset[1]]]
        first = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (word[1:] != word[:-1])]))
        count = np.diff(np.append(first, len(at)))
        start, own = at[first], own[first]
        if self.back_sa is None:
            return start, start + count, start
        # in the backward interval rows with a smaller word before them come first, and those with none before all
        by = np.argsort(own, kind="stable")
        upto = np.cumsum(count[by]) - count[by]
        opens = np.concatenate([[True], own[by][1:] != own[by][:-1]])
        inside = upto - upto[opens][np.cumsum(opens) - 1]
        extended = np.bincount(own, count, len(lo)).astype(np.int64)
        shift = np.empty(len(own), np.int64)
        shift[by] = inside
        return start, start + count, back[own] + (size - extended)[own] + shift


class Shard:
    """Index over words ``a`` to ``b`` of a slice, with what is needed to count and to name phrases."""

    def __init__(self, p: Pieces, hashes: np.ndarray, a: int, b: int, both: bool):
        self.p, self.a, self.b = p, a, b
        begin, end = max(0, a - BEFORE), min(len(hashes), b + AFTER)
        opens = p.opens[begin:end].copy()
        opens[:1] = True
        _, ids = np.unique(hashes[begin:end], return_inverse=True)
        place = np.arange(end - begin) + np.cumsum(opens) - 1
        text = np.zeros(place[-1] + 2, np.int64)
        text[place] = ids + 1
        self.hash = np.zeros(len(text) + DEPTH, U64)
        self.hash[place] = hashes[begin:end]
        self.word = np.zeros(len(text), np.int64)
        self.word[place] = np.arange(begin, end)
        self.own = np.zeros(len(text), bool)
        self.own[place[a - begin:b - begin]] = True
        self.index = FMIndex(text, both)
        self.owned = np.concatenate([[0], np.cumsum(self.own[self.index.sa])])

    def hashes(self, at: np.ndarray, length: int) -> np.ndarray:
        total = np.zeros(len(at), U64)
        for k in range(length):
            total += self.hash[at + k] * _STEP[k]
        return mix(total ^ (U64(length) << U64(56)))

    def counts(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Occurrences that begin with one of the shard's own words."""
        return self.owned[hi] - self.owned[lo]

    def neighbours(self, length: int, lo: np.ndarray, hi: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Own occurrences with a word of the piece before them, and with one behind them."""
        i = self.index
        left = np.concatenate([[0], np.cumsum(self.own[i.sa] & (i.bwt > 0))])
        begins = np.maximum(i.back_sa - (length - 1), 0)
        right = np.concatenate([[0], np.cumsum(self.own[begins] & (i.back_bwt > 0))])
        return left[hi] - left[lo], right[back + hi - lo] - right[back]


def _shards(batch: pa.RecordBatch, both: bool, shard_words: int) -> Iterator[tuple[Shard, list[str]]]:
    """Shards of a batch (lang, text) with the language of each row."""
    data, offs = text_bytes(batch.column(1))
    langs = ["und" if x is None else x for x in batch.column(0).to_pylist()]
    seed = {x: np.frombuffer(hashlib.blake2b(x.encode(), digest_size=8).digest(), U64)[0] for x in set(langs)}
    of_row = np.array([seed[x] for x in langs], U64)
    for i, j in slices(offs, shard_words * 6):
        p = Pieces(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
        if len(p.start):
            hashes = mix(p.hashes() ^ of_row[i:j][p.row])
            for a in range(0, len(hashes), shard_words):
                yield Shard(p, hashes, a, min(a + shard_words, len(hashes)), both), langs[i:j]


def _sketch(shard_words: int, least: int, cells: int, block: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Cells of all phrases of a shard with local counts, in blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, _ in _shards(batch, False, shard_words):
                at, counts = [], []
                for length, lo, hi, _ in shard.index.phrases(DEPTH):
                    n = shard.counts(lo, hi)
                    lo, n = lo[n > 0], n[n > 0]
                    at.append((shard.hashes(shard.index.sa[lo], length) % U64(cells)).astype(np.int64))
                    counts.append(np.minimum(n, least).astype(np.uint8))
                cell, n = np.concatenate(at), np.concatenate(counts)
                order = np.argsort(cell)
                cell, n = cell[order], n[order]
                own, first = np.unique(cell // block, return_index=True)
                cuts = [*first, len(cell)]
                low = (cell % block).astype(np.uint32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(own.astype(np.int32)),
                    pa.array([_packed(low[x:y], n[x:y]) for x, y in zip(cuts, cuts[1:], strict=False)], pa.binary())], names=["block", "cells"])
    return run


def _packed(cell: np.ndarray, n: np.ndarray) -> bytes:
    """Sorted cells as steps of two bytes (a larger step is spread over rows of count 0) and counts of one byte."""
    step = np.diff(cell.astype(np.int64), prepend=0)
    wide = step >> 16
    if wide.any():
        again = wide + 1
        last = np.cumsum(again) - 1
        steps, counts = np.full(int(again.sum()), 65535, np.int64), np.zeros(int(again.sum()), np.uint8)
        steps[last], counts[last] = step - wide * 65535, n
        over = steps > 65535  # up to 15 more than 65,535 times the spread rows
        if over.any():
            extra = np.flatnonzero(over)
            steps, counts = np.insert(steps, extra, 65535), np.insert(counts, extra, 0)
            steps[extra + np.arange(1, len(extra) + 1)] -= 65535
        step, n = steps, counts
    return np.uint32(len(step)).tobytes() + step.astype(np.uint16).tobytes() + n.astype(np.uint8).tobytes()


def _unpacked(raw: memoryview) -> tuple[np.ndarray, np.ndarray]:
    size = int(np.frombuffer(raw, np.uint32, 1)[0])
    return np.cumsum(np.frombuffer(raw, np.uint16, size, 4).astype(np.int64)), np.frombuffer(raw, np.uint8, size, 4 + 2 * size)


def _full_cells(least: int, block_cells: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows sorted by block -> one row a block: the cells whose counts add up to ``least`` or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counts = None, np.zeros(block_cells, np.uint16)

        def done() -> pa.RecordBatch:
            at = np.flatnonzero(counts >= least).astype(np.uint32)
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([at.tobytes()], pa.binary())], names=["block", "cells"])
        for batch in batches:
            for block, cells in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if block != now:
                    if now is not None:
                        yield done()
                    now, counts = block, np.zeros(block_cells, np.uint16)
                at, n = _unpacked(memoryview(cells.as_buffer()))
                np.add.at(counts, at, n)
                np.minimum(counts, least, out=counts)
        if now is not None:
            yield done()
    return run


def frequent_phrases(docs: DataFrame, least: int = LEAST, text_col: str = "text", lang_col: str = "lang",
                     shard_words: int = SHARD_WORDS, cells: int = CELLS, block: int = BLOCK) -> DataFrame:
    """``(lang, phrase, size, f, left_words, right_words)``: every phrase of one to four words that occurs ``least``
    times or more in its language, with how many of its occurrences have a word before and behind them in the piece;
    and a row of size 0 for each language with its number of words."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    counted = arrow_map(texts, _sketch(shard_words, least, cells, block), "block int, cells binary")
    full = arrow_map(counted.repartition("block").sortWithinPartitions("block"), _full_cells(least, block), "block int, cells binary").toArrow()
    bits = np.zeros(cells // 8, np.uint8)
    for b, row in zip(full["block"].to_pylist(), full["cells"], strict=True):
        at = np.frombuffer(row.as_buffer(), np.uint32).astype(np.int64) + b * block
        np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
    shared = spark.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, langs in _shards(batch, True, shard_words):
                yield _named(shard, langs, shared.value, cells)

    local = arrow_map(texts, run, "lang string, phrase string, size int, f long, left_words long, right_words long")
    total = local.groupBy("lang", "phrase", "size").agg(*[F.sum(c).alias(c) for c in ("f", "left_words", "right_words")])
    return total.filter((F.col("size") == 0) | (F.col("f") >= least))


def _named(shard: Shard, langs: list[str], bits: np.ndarray, cells: int) -> pa.RecordBatch:
    """Phrases of a shard in full cells, with their words."""
    p, names = shard.p, {}
    cols: list[list] = [[] for _ in range(6)]

    def wanted(at: np.ndarray, length: int) -> np.ndarray:
        cell = (shard.hashes(at, length) % U64(cells)).astype(np.int64)
        return (bits[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1

    raw = p.data.tobytes()

    def name(word: int, key: int) -> str:
        got = names.get(key)
        if got is None:
            got = names[key] = raw[p.start[word]:p.end[word]].decode("utf-8", "replace")
        return got

    text, row = shard.index.text, p.row
    for length, lo, hi, back in shard.index.phrases(DEPTH, wanted):
        n = shard.counts(lo, hi)
        on = n > 0
        left, right = shard.neighbours(length, lo, hi, back)
        at = shard.index.sa[lo[on]]
        words = [shard.word[at + k].tolist() for k in range(length)]
        keys = [text[at + k].tolist() for k in range(length)]
        parts = [[name(w, x) for w, x in zip(ws, xs, strict=True)] for ws, xs in zip(words, keys, strict=True)]
        cols[0] += [langs[r] for r in row[shard.word[at]].tolist()]
        cols[1] += [" ".join(x) for x in zip(*parts, strict=True)]
        cols[2] += [length] * len(at)
        for k, v in ((3, n), (4, left), (5, right)):
            cols[k] += v[on].tolist()
    rows = row[shard.a:shard.b]
    for r, n in zip(*(x.tolist() for x in np.unique(rows, return_counts=True)), strict=True):
        for k, v in enumerate((langs[r], "", 0, n, 0, 0)):
            cols[k].append(v)
    kinds = (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                      names=["lang", "phrase", "size", "f", "left_words", "right_words"])


def _wide(c: str) -> Column:
    return F.col(c).cast("decimal(20,0)")


def collocations(docs: DataFrame, least: int = LEAST, within: int = WITHIN, top: int = TOP, text_col: str = "text",
                 lang_col: str = "lang", shard_words: int = SHARD_WORDS, cells: int = CELLS, block: int = BLOCK) -> DataFrame:
    """The ``top`` phrases of two to four words of each language: lang, rank, phrase, a, l, r, n, score, left_words,
    right_words.

    Words and pieces: A-Z in lower case, pieces end at ``[.,;:!?]`` and at line ends, words are parted by spaces and
    tabs. A null text is empty; a null language is ``und``. A language whose phrases are all rare has no rows, an
    empty table gives none. Ties go by count, then by the phrase's bytes. Repeated rows count each time; a text of any
    length is cut into shards that overlap by the words a phrase needs; other columns are not read. Words are told
    apart inside a shard by 64-bit hashes, phrases across shards by their text; scores are exact (decimals).
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "frequent-phrases")
    frequent_phrases(docs, least, text_col, lang_col, shard_words, cells, block).write.parquet(folder)
    table = spark.read.parquet(folder)
    words = F.split("phrase", " ")
    cand = table.filter("size >= 2").withColumnRenamed("f", "a")
    # a longer candidate contains this one: one word more is enough to ask for, as it is at least as frequent
    longer = table.filter("size >= 3").select("lang", "f", F.explode(F.array(
        F.array_join(F.slice(words, F.lit(1), F.col("size") - 1), " "), F.array_join(F.slice(words, F.lit(2), F.col("size") - 1), " "))).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    cand = cand.join(longer, ["lang", "phrase"], "left") \
        .filter(F.col("longer").isNull() | (_wide("longer") * 100 < _wide("a") * within)).drop("longer")
    cut = cand.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    first = F.array_join(F.slice(words, F.lit(1), F.col("k")), " ")
    rest = F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " ")
    cut = cut.select("*", first.alias("first"), rest.alias("rest"))
    part = table.filter("size between 1 and 3")
    cut = cut.join(part.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"]) \
        .join(part.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    score = F.expr("(cast(a as decimal(20,0)) * 2000000BD) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    best = cut.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r", "a", "left_words", "right_words")).alias("x")).select("lang", "phrase", "x.*")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    total = table.filter("size = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"),
        "left_words", "right_words")


#: The same by counting every phrase of every piece.
ORACLE_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(regexp_extract_all(t, '[^.,;:!?\x0A-\x0D]+')) AS piece FROM d)),
g AS (SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k, i > 1 AS has_left, i + k - 1 < len(w) AS has_right
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (VALUES (1), (2), (3), (4)) s(k) WHERE len(w) >= k)),
f AS (SELECT lang, phrase, k, count(*) AS f, count(*) FILTER (has_left) AS left_words, count(*) FILTER (has_right) AS right_words
  FROM g GROUP BY ALL),
tot AS (SELECT lang, sum(len(w)) AS n FROM p GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k BETWEEN 2 AND 4 AND f >= 30),
inner_part AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, f FROM
  (SELECT lang, w, f, m, unnest(range(1, k - m + 2)) AS i FROM c, (VALUES (2), (3)) s(m) WHERE m < k)),
drops AS (SELECT DISTINCT c.lang, c.phrase FROM c JOIN inner_part i ON c.lang = i.lang AND c.phrase = i.phrase
  WHERE CAST(100 AS HUGEINT) * i.f >= CAST(80 AS HUGEINT) * c.f),
kept AS (SELECT * FROM c ANTI JOIN drops USING (lang, phrase)),
cuts AS (SELECT lang, phrase, f AS a, left_words, right_words, j, array_to_string(w[1:j], ' ') AS x, array_to_string(w[j + 1:k], ' ') AS y
  FROM (SELECT *, unnest(range(1, k)) AS j FROM kept)),
scored AS (SELECT cuts.*, l.f AS l, r.f AS r, (CAST(2000000 AS HUGEINT) * a) // (CAST(l.f AS HUGEINT) + r.f) AS score
  FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = x JOIN f r ON r.lang = cuts.lang AND r.phrase = y),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT ranked.lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score, left_words, right_words
FROM ranked JOIN tot ON ranked.lang = tot.lang WHERE rank <= 2000
"""
