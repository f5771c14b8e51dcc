"""Sharding by a consistent-hash ring with virtual nodes and bounded loads, in
DataFrame functions only.

Each shard has VIRTUAL_NODES points on a ring, each document the point of its
key (its doc_id); a document's home is the shard of the next point clockwise.
A shard takes no more than its share: documents beyond it continue clockwise
to the next shard with room. The shares add up to the number of documents and
differ by one at most, so the law is ``rows``: counts at most one apart,
whatever the keys. With one more shard, most documents stay: those that the
new points take, and those that overflow otherwise, move.

How: documents are put in ring order by one range shuffle of four small
columns (no text). Everything else works on the ring's arcs, a table bounded
by shards x VIRTUAL_NODES: how many documents each arc holds, how many its
home takes, and where the rest go, as intervals of ranks in the arc. These
are joined back by broadcast, so no arc, source or key is gathered in a task:
a third of all rows with one key is split over range partitions by row number.

Defined cases: a null doc_id is one key like any other, equal keys share a
point and are told apart by text checksum, size and row; a null text has size
16 and checksum 0. Fewer documents than shards leave shards empty. An empty
table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ferry.llm.common import global_rank, table

SHARDS = 40
VIRTUAL_NODES = 64
# Size of a document besides its text.
OVERHEAD_BYTES = 16
# The ring has 2^60 places; its cells, one row each in a broadcast, narrow the
# search for a document's arc to a few points.
CELL_BITS = 12


def place(key: Column) -> Column:
    """Place on the ring: the first 60 bits of the key's MD5."""
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def ring(spark: SparkSession, shards: int, virtual_nodes: int) -> DataFrame:
    """The ring's points in order: arc (0-based), place, shard."""
    n = F.lit(virtual_nodes)
    points = spark.range(shards * virtual_nodes, numPartitions=1).select(
        F.floor(F.col("id") / n).cast("int").alias("shard"),
        place(F.concat_ws(":", F.lit("shard"), F.floor(F.col("id") / n), F.col("id") % n)).alias("place"),
    )
    w = W.orderBy("place", "shard")
    return points.withColumn("arc", F.row_number().over(w) - 1).select("arc", "place", "shard")


def _cells(points: DataFrame) -> DataFrame:
    """For each cell of the ring, the points before it and the points in it."""
    cells = points.sparkSession.range(1 << CELL_BITS, numPartitions=1).withColumnRenamed("id", "cell")
    own = points.groupBy(F.shiftright("place", 60 - CELL_BITS).alias("cell")).agg(
        F.array_sort(F.collect_list("place")).alias("points")
    )
    own = cells.join(own, "cell", "left").withColumn("points", F.coalesce("points", F.array().cast("array<long>")))
    w = W.orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    return own.withColumn("base", F.coalesce(F.sum(F.size("points")).over(w), F.lit(0)))


def _intervals(points: DataFrame, loads: DataFrame, shards: int) -> DataFrame:
    """Where each arc's documents go: arc, ranks lo <= rank < hi in ring order,
    shard, and the slot of rank lo in that shard.

    Documents past the last point belong to an arc of their own, whose home
    is the first point's shard. One row for each arc that holds documents and
    one for each part of an arc's overflow: bounded by the ring.
    """
    n_arcs = points.select((F.max("arc") + 1).alias("n_arcs"))
    last = points.where("arc = 0").crossJoin(n_arcs).select(F.col("n_arcs").alias("arc"), "shard")
    arcs = points.select("arc", "shard").unionByName(last).join(loads, "arc", "left").fillna(0, ["n"])
    total = F.sum("n").over(W.partitionBy())
    room = F.floor(total / shards) + (F.col("shard") < total % shards).cast("long")
    earlier = F.sum("n").over(W.partitionBy("shard").orderBy("arc").rowsBetween(W.unboundedPreceding, -1))
    start = F.sum("n").over(W.orderBy("arc").rowsBetween(W.unboundedPreceding, -1))
    zero = F.lit(0).cast("long")
    arcs = arcs.select("*", room.alias("room"), F.coalesce(earlier, zero).alias("ahead"), F.coalesce(start, zero).alias("start"))
    arcs = arcs.withColumn("home", F.greatest(zero, F.least(F.col("n"), F.col("room") - F.col("ahead"))))
    # One row holds the whole ring as arrays; a fold lets each arc's overflow
    # walk on clockwise through the shards, in the order it meets them.
    whole = arcs.agg(
        F.array_sort(F.collect_list(F.struct("arc", "shard", "n", "home", "start"))).alias("arcs"),
    )
    taken = arcs.groupBy("shard").agg((F.max("room") - F.sum("home")).alias("left"))
    left = taken.agg(F.array_sort(F.collect_list(F.struct("shard", "left"))).alias("x")).select(
        F.col("x.left").alias("room")
    )
    one = whole.crossJoin(left).withColumn("shards", F.expr("slice(transform(arcs, x -> x.shard), 1, size(arcs) - 1)"))
    one = one.withColumn("twice", F.concat("shards", "shards"))
    one = one.withColumn(
        "overflow",
        F.expr(
            """transform(filter(arcs, x -> x.n > x.home), x -> named_struct(
                 'arc', x.arc, 'lo', x.start + x.home, 'need', x.n - x.home,
                 'walk', array_distinct(slice(twice, x.arc % size(shards) + 2, size(shards)))))"""
        ),
    )
    fold = """
      aggregate(overflow,
        named_struct('room', room, 'parts',
          cast(array() as array<struct<arc: int, lo: bigint, hi: bigint, shard: int>>)),
        (acc, o) -> aggregate(o.walk,
          named_struct('room', acc.room, 'parts', acc.parts, 'need', o.need, 'lo', o.lo),
          (b, s) -> if(b.need = 0 or b.room[s] = 0, b, named_struct(
            'room', transform(b.room, (x, j) -> if(j = s, x - least(b.need, x), x)),
            'parts', concat(b.parts, array(named_struct(
              'arc', o.arc, 'lo', b.lo, 'hi', b.lo + least(b.need, b.room[s]), 'shard', s))),
            'need', b.need - least(b.need, b.room[s]),
            'lo', b.lo + least(b.need, b.room[s]))),
          b -> named_struct('room', b.room, 'parts', b.parts)),
        acc -> acc.parts)"""
    homes = "transform(filter(arcs, x -> x.home > 0), x -> named_struct('arc', x.arc, 'lo', x.start, 'hi', x.start + x.home, 'shard', x.shard))"
    parts = one.select(F.explode(F.expr(f"{homes}")).alias("p"), F.lit(0).alias("moved")).unionByName(
        one.select(F.explode(F.expr(fold)).alias("p"), F.lit(1).alias("moved"))
    )
    w = W.partitionBy("shard").orderBy("moved", "lo").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("p.*", "moved")
    return parts.withColumn("slot", F.coalesce(F.sum(F.col("hi") - F.col("lo")).over(w), zero))


def bounded_ring(docs: DataFrame, shards: int = SHARDS, virtual_nodes: int = VIRTUAL_NODES) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and ``moved``
    (whether the document overflowed its home shard)."""
    spark = docs.sparkSession
    points = ring(spark, shards, virtual_nodes)
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD_BYTES).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).alias("text_crc32"),
        place(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("place"),
        F.monotonically_increasing_id().alias("_row"),
    )
    cell = F.shiftright("place", 60 - CELL_BITS)
    # 2^CELL_BITS rows and shards x virtual_nodes points: bounded by the ring
    rows = rows.withColumn("cell", cell).join(F.broadcast(_cells(points)), "cell")
    rows = rows.withColumn(
        "arc", (F.col("base") + F.size(F.filter("points", lambda p: p < F.col("place")))).cast("int")
    ).drop("cell", "base", "points")
    order = [F.col(c) for c in ("place", "doc_id", "text_crc32", "size", "_row")]
    rows = global_rank(rows, order, "_rank")
    loads = rows.groupBy("arc").agg(F.count(F.lit(1)).alias("n"))
    parts = _intervals(points, loads, shards).withColumnRenamed("arc", "_arc")
    inside = (F.col("arc") == F.col("_arc")) & (F.col("_rank") >= F.col("lo")) & (F.col("_rank") < F.col("hi"))
    return rows.join(F.broadcast(parts), inside).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("slot") + F.col("_rank") - F.col("lo")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        (F.col("moved") == 1).alias("moved"),
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bounded_ring(table(spark, sf_dir, "documents").select("doc_id", "text"))
