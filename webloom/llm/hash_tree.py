"""Sharding by a hierarchical weighted hash tree (operator 3).

Shards are leaves of a tree of regions, racks and shards. A row descends from the root: at each level
every child draws ``-ln(u) / weight`` with u from a hash of (child, key), and the smallest draw wins, so a
child gets rows in proportion to its weight. A child's draws depend on no other child: changing one weight
moves rows only into or out of that subtree at its level, and inside the subtrees below nothing moves
but what depends on a weight that changed.

Law ``key``: the key and the tree decide alone, so equal rows of any order or layout get equal shards. A new
shard joins as a region of its own (or any subtree of its own), which takes rows only into itself.

Everything is DataFrame expressions: about (regions + racks + shards of one rack) hashes for each row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RACK_SHARDS, REGION_RACKS = 4, 2


@dataclass(frozen=True)
class Node:
    """A region, rack or shard. ``weight`` counts for leaves; an inner node weighs what its leaves weigh."""

    name: str
    weight: float = 1.0
    children: tuple[Node, ...] = field(default=())
    shard: int = -1

    def total(self) -> float:
        return sum(c.total() for c in self.children) if self.children else self.weight


def tree(n_shards: int, weights: dict[int, float] | None = None, base: int | None = None) -> Node:
    """Shards 0 .. n - 1 in racks of four and regions of two racks.

    ``base``: shards from this number on were added later; each is a region and rack of its own, so that
    growing from ``base`` moves rows only into the new shards.
    """
    w = lambda s: (weights or {}).get(s, 1.0)
    leaf = lambda s: Node(f"shard{s}", w(s), (), s)
    base = n_shards if base is None else min(base, n_shards)
    racks = [Node(f"rack{r}", children=tuple(leaf(s) for s in range(r * RACK_SHARDS, min(base, (r + 1) * RACK_SHARDS))))
             for r in range(-(-base // RACK_SHARDS))]
    regions = [Node(f"region{g}", children=tuple(racks[g * REGION_RACKS:(g + 1) * REGION_RACKS]))
               for g in range(-(-len(racks) // REGION_RACKS))]
    later = [Node(f"region-of-shard{s}", children=(Node(f"rack-of-shard{s}", children=(leaf(s),)),)) for s in range(base, n_shards)]
    return Node("root", children=(*regions, *later))


def _levels(root: Node) -> list[list[list[tuple[str, float, int]]]]:
    """Level by level, for each node of the level above, its live children as (name, weight, number at their level).

    Leaves carry their shard instead of a number. All leaves stand at one depth.
    """
    out, above = [], [root]
    while above and above[0].children:
        here, table = [], []
        for node in above:
            kids = []
            for c in node.children:
                if c.total() > 0:
                    kids.append((c.name, float(c.total()), len(here) if c.children else c.shard))
                    here.append(c)
            if not kids:
                raise ValueError(f"{node.name} has no child of positive weight")
            table.append(kids)
        out.append(table)
        above = here
    return out


def descend(root: Node, key: Column) -> Column:
    """The shard of a key: at each level the child with the smallest ``-ln(u) / weight``, u from 53 hash bits of
    (child, key)."""
    at = F.lit(0)
    for table in _levels(root):
        kids = F.array(*(F.array(*(F.struct(F.lit(n).alias("name"), F.lit(w).alias("weight"), F.lit(i).alias("to"))
                                   for n, w, i in row)) for row in table))
        draws = F.transform(F.get(kids, at), lambda c: F.struct(
            (-F.log((F.shiftrightunsigned(F.xxhash64(c["name"], key), 11).cast("double") + 0.5) / float(1 << 53)) / c["weight"]).alias("draw"),
            c["to"].alias("to")))
        at = F.array_min(draws)["to"]
    return at


def place(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text",
          weights: dict[int, float] | None = None, slot_buckets: int | None = None, base: int | None = None) -> DataFrame:
    """One row for each row of ``docs``: id, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is UTF-8 bytes of the text (null: none) plus 16; ``text_crc32`` of a null text is that of empty
    bytes. ``base`` is the number of shards that the tree was first laid out for (see ``tree``; by default all): a
    store that began with 40 shards and has 41 is placed by n_shards=41, base=40, and then each row's shard is the
    grown_shard of before, at any number of added shards. ``slot`` numbers the rows of a shard without a gap from 0, by bucket of the id's hash and then by id:
    a bucket is one sort of a bounded share of a shard, and the offsets come from a small table of counts,
    so no task sees a whole shard. A null id is a key like any other; repeated rows get the same shard and
    slots of their own. Other columns are not read. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    buckets = slot_buckets or max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    key = F.col("id")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("n"), F.crc32(F.encode(text, "UTF-8")).alias("crc"))
    base = n_shards if base is None else base
    grown = tree(n_shards + 1, weights, base=min(base, n_shards))
    rows = rows.select("id", (F.col("n") + 16).alias("size"), "crc", descend(tree(n_shards, weights, base), key).alias("shard"),
                       descend(grown, key).alias("grown"),
                       F.pmod(F.xxhash64(F.lit("slot"), key), F.lit(buckets)).cast("int").alias("bucket"))
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("shard").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))
    own = Window.partitionBy("shard", "bucket").orderBy("id", "size", "crc")
    # offsets: at most n_shards * buckets rows of three numbers, whatever the table holds
    return rows.withColumn("within", F.row_number().over(own) - 1) \
        .join(F.broadcast(offsets), (F.col("shard") == F.col("s")) & (F.col("bucket") == F.col("b"))) \
        .select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("key").alias("law"), "shard",
                (F.col("before") + F.col("within")).cast("long").alias("slot"), F.col("grown").alias("grown_shard"))
