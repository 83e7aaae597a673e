"""Filter interaction audit (operator 13): what five filters remove in every order of application.

1. One pass over the texts gives a narrow table in the shared folder: id, hash of the text, part, and a mask of the
   filters A to D that the text fails.
2. A counting Bloom filter over the hashes: each task counts the cells of its own texts, the counts are added up by
   block of cells, and a text with a cell that no other text has counted is unique for certain.
3. Only possible repeats are shuffled as whole texts, for the smallest id of each exact text.
4. The repeat flag joins the narrow table, labels join the rows counted by id, part and mask, and all that follows are
   sums over the 32 masks: a prefix of an order leaves the rows whose mask has no bit of the prefix.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.llm.storage import arrow_map, new_folder, ship
from webloom.llm.words import U64, mix

FILTERS = "ABCDE"
WORD = r"[^\x20\x09-\x0D]+"
#: Cells of a block (four 16-bit parts of a hash choose cells in it), cells for each text, and blocks at most: the
#: filter that is broadcast has one bit a cell, so 32 MB at most. Beyond that size more texts count as possible
#: repeats and are shuffled; results stay the same.
BLOCK, CELLS_A_TEXT, MAX_BLOCKS = 1 << 16, 12, 1 << 12
#: Texts that a task counts before it hands on their cells.
HELD = 1 << 20


def text_mask(text: Column) -> Column:
    """Bits 0 to 3: the text fails A (under 50 words), B (100 * distinct words < 65 * words), C (100 * capitals > 5 *
    code points), D (holds one of #$%&*|). A null is an empty text."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    words = F.regexp_extract_all(t, F.lit(WORD), 0)
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(t) - F.length(F.translate(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    fails = [n < 50, distinct.cast("long") * 100 < n.cast("long") * 65,
             capitals.cast("long") * 100 > F.length(t).cast("long") * 5, t.rlike(r"[#$%&*|]")]
    out = F.lit(0)
    for k, f in enumerate(fails):
        out = out + F.when(f, 1 << k).otherwise(0)
    return out


def _cells(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, four cells in it) of each hash."""
    a, b = mix(h ^ U64(0x5851F42D4C957F2D)), mix(h + U64(0x14057B7EF767814F))
    cells = np.stack([(b >> U64(s)) & U64(BLOCK - 1) for s in (0, 16, 32, 48)], 1)
    return (a % U64(blocks)).astype(np.int32), cells.astype(np.uint16)


def _count_cells(blocks: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Cells of a task's hashes by block, each at most twice (from two on, more says nothing new)."""
    def packed(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        block, cells = _cells(np.concatenate(held).view(U64), blocks)
        at, n = np.unique(np.repeat(block.astype(np.int64), 4) * BLOCK + cells.reshape(-1), return_counts=True)
        at = np.repeat(at, np.minimum(n, 2))
        own, first = np.unique(at // BLOCK, return_index=True)
        parts = np.split((at % BLOCK).astype(np.uint16), first[1:])
        yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array([p.tobytes() for p in parts], pa.binary())],
                                         names=["block", "cells"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False))
            if sum(map(len, held)) >= HELD:
                yield from packed(held)
                held = []
        yield from packed(held)
    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block -> one row a block: bits of the cells that were counted twice or more."""
    now, counts = None, np.zeros(BLOCK, np.uint8)

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([np.packbits(counts >= 2, bitorder="little").tobytes()], pa.binary())],
                                          names=["block", "bits"])
    for batch in batches:
        for block, cells in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if block != now:
                if now is not None:
                    yield done()
                now, counts = block, np.zeros(BLOCK, np.uint8)
            n = np.bincount(np.frombuffer(cells.as_buffer(), np.uint16), minlength=BLOCK)
            counts = np.minimum(counts + n, 2).astype(np.uint8)
    if now is not None:
        yield done()


def possible_repeats(hashes: DataFrame, max_blocks: int = MAX_BLOCKS) -> Callable[[Column], Column]:
    """A test on hashes (the one column of ``hashes``): False for hashes that certainly occur once only."""
    spark = hashes.sparkSession
    blocks = max(1, min(max_blocks, math.ceil(hashes.count() * CELLS_A_TEXT / BLOCK)))
    counted = arrow_map(hashes, _count_cells(blocks), "block int, cells binary")
    merged = arrow_map(counted.repartition("block").sortWithinPartitions("block"), _merge, "block int, bits binary").toArrow()
    bits = np.zeros((blocks, BLOCK // 8), np.uint8)
    for block, row in zip(merged["block"].to_pylist(), merged["bits"], strict=True):
        bits[block] = np.frombuffer(row.as_buffer(), np.uint8)
    shared = spark.sparkContext.broadcast(bits)
    ship(spark)

    @F.arrow_udf("boolean")
    def possible(h: pa.Array) -> pa.Array:
        block, cells = _cells(h.to_numpy(zero_copy_only=False).view(U64), blocks)
        hit = np.ones(len(h), bool)
        for k in range(4):
            c = cells[:, k].astype(np.int64)
            hit &= (shared.value[block, c >> 3] >> (c & 7).astype(np.uint8)) & 1 == 1
        return pa.array(hit)

    return possible


def masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
          max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """``(id, part, mask)`` for each row: the filters that it fails, A in bit 0 to E in bit 4."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    folder = new_folder(spark, "filter-masks")
    docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                text_mask(F.col(text_col)).alias("mask")).write.parquet(folder)
    narrow = spark.read.parquet(folder)
    possible = possible_repeats(narrow.select("h"), max_blocks)
    texts = docs.select(F.col(id_col).alias("id"), text.alias("t")).filter(F.col("id").isNotNull()).filter(possible(F.xxhash64("t")))
    first = texts.groupBy("t").agg(F.min("id").alias("id")).select("id", F.xxhash64("t").alias("h"), F.lit(True).alias("is_first"))
    # rows of one id, text and part are one row from here on, with their number
    rows = narrow.groupBy("id", "h", "part", "mask").agg(F.count("*").alias("n")).withColumn("maybe", possible("h"))
    unique = rows.filter(~F.col("maybe") | F.col("id").isNull()).select("id", "part", "mask", "n")
    asked = rows.filter(F.col("maybe") & F.col("id").isNotNull()).join(first, ["id", "h"], "left")
    repeat = F.when(F.col("is_first").isNull(), 1 << 4).otherwise(0)
    return unique.unionByName(asked.select("id", "part", (F.col("mask") + repeat).alias("mask"), "n"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
          max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """One row for each part, order of the five filters and step.

    Columns: part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley. A null
    text is empty, a null part ''. E compares ids: rows of equal text fail it where a smaller id has that text, so
    repeated rows of the smallest id all pass, and a null id neither fails nor counts as smaller. An id with several
    labels is good (toxic) if one of them says so; null labels and null ids say nothing. An empty table gives no rows;
    further columns are not read, so their names cannot clash. Very long texts are rows like others.
    """
    rows = masks(docs, id_col, text_col, part_col, max_blocks).groupBy("id", "part", "mask").agg(F.sum("n").alias("n"))
    marks = labels.select(F.col(id_col).alias("id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic")) \
        .filter(F.col("id").isNotNull()).groupBy("id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    cells = rows.join(marks, "id", "left").groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
    return _orders(cells)


def _orders(cells: DataFrame) -> DataFrame:
    """Sums over masks -> rows of all orders and steps."""
    mask, n = F.col("mask"), F.col("n")
    measures = {"left": n, "good_left": F.when(F.col("good"), n).otherwise(0), "toxic_left": F.when(F.col("toxic"), n).otherwise(0)}
    # element s: rows that pass every filter of the subset s
    sums = [F.array(*[F.sum(F.when(mask.bitwiseAND(s) == 0, v).otherwise(0)) for s in range(32)]).alias(name) for name, v in measures.items()]
    only = F.array(*[F.sum(F.when(mask == 1 << k, n).otherwise(0)) for k in range(5)]).alias("only")
    by_part = cells.groupBy("part").agg(*sums, only)

    def share(k: int) -> Column:
        """Removed by filter k, summed over the 120 orders: |S|! (4 - |S|)! orders have the set S before it."""
        out = F.lit(0).cast("long")
        for s in range(32):
            if not s >> k & 1:
                size = bin(s).count("1")
                out = out + F.lit(math.factorial(size) * math.factorial(4 - size)) * (F.get("left", F.lit(s)) - F.get("left", F.lit(s | 1 << k)))
        return out

    by_part = by_part.withColumn("shares", F.array(*[share(k) for k in range(5)]))
    orders = F.array(*[F.lit("".join(p)) for p in itertools.permutations(FILTERS)])
    steps = by_part.withColumn("filter_order", F.explode(orders)) \
        .select("*", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("step"))

    def bit(letter: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1), F.ascii(letter) - 65)
    letters = F.split(F.substr("filter_order", F.lit(1), F.col("step") - 1), "")
    before = F.aggregate(F.filter(letters, lambda x: x != ""), F.lit(0), lambda s, x: s.bitwiseOR(bit(x)))
    at = F.substr("filter_order", F.col("step"), F.lit(1))
    steps = steps.withColumns({"before": before, "after": before.bitwiseOR(bit(at)), "own": bit(at), "k": F.ascii(at) - 65})
    removed = F.get("left", "before") - F.get("left", "after")
    return steps.select(
        "part", "filter_order", "step", F.get("left", "after").alias("kept"), removed.alias("removed"),
        (F.get("left", F.lit(0)) - F.get("left", "own") - removed).alias("redundant"), F.get("only", "k").alias("unique_fails"),
        (F.get("good_left", "before") - F.get("good_left", "after")).alias("good_lost"),
        (F.get("toxic_left", "before") - F.get("toxic_left", "after")).alias("toxic_lost"), F.get("shares", "k").alias("shapley"))


#: The same rows by plain counting: every document, every order.
ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS first_id FROM d),
f AS (SELECT doc_id, part,
  CASE WHEN len(words) < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
  + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END
  + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
  + CASE WHEN coalesce(doc_id > first_id, false) THEN 16 ELSE 0 END AS mask FROM w),
lab AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
cell AS (SELECT part, mask, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, count(*) AS n
  FROM f LEFT JOIN lab USING (doc_id) GROUP BY ALL),
letter AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(x, b)),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM letter a, letter b, letter c, letter d, letter e WHERE a.b + b.b + c.b + d.b + e.b = 31
  AND len(list_distinct([a.b, b.b, c.b, d.b, e.b])) = 5),
steps AS (SELECT filter_order, CAST(s AS INTEGER) AS step, bits[s] AS own, CAST(coalesce(list_sum(bits[1:s - 1]), 0) AS INTEGER) AS before
  FROM orders, range(1, 6) r(s)),
res AS (SELECT part, filter_order, step, own,
  sum(CASE WHEN mask & (before | own) = 0 THEN n ELSE 0 END) AS kept,
  sum(CASE WHEN mask & before = 0 AND mask & own <> 0 THEN n ELSE 0 END) AS removed,
  sum(CASE WHEN mask & before <> 0 AND mask & own <> 0 THEN n ELSE 0 END) AS redundant,
  sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
  sum(CASE WHEN mask & before = 0 AND mask & own <> 0 THEN n * good ELSE 0 END) AS good_lost,
  sum(CASE WHEN mask & before = 0 AND mask & own <> 0 THEN n * toxic ELSE 0 END) AS toxic_lost
  FROM cell, steps GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM res
"""
