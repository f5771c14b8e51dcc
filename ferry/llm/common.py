"""Helpers shared by the operators: table readers, words, reliable
checkpoints, a distributed global rank and connected components."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.session import shared_dir

# Fixed value: the characters that separate words, [\x20\x09-\x0D].
BREAK = "[\\x20\\x09-\\x0D]"
WORD_BREAK = BREAK + "+"
WORD = "[^\\x20\\x09-\\x0D]+"
# Rows buffered by a task before it works on them: bounds its memory whatever
# the size of an Arrow batch or of a partition. One text is never split.
CHUNK_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quoted(name: str) -> str:
    """A column's name as SQL takes it, whatever its characters."""
    return "`" + name.replace("`", "``") + "`"


def unused(taken: list[str], *names: str) -> list[str]:
    """The names, each lengthened until no taken one equals it (case aside)."""
    seen, out = {t.lower() for t in taken}, []
    for name in names:
        while name.lower() in seen:
            name += "_"
        seen.add(name.lower())
        out.append(name)
    return out


def words_of(text: Column) -> Column:
    """Words of a text as an array (null text: no words)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), lambda w: w != F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often body uses it."""
    return F.transform(F.array(value), body)[0]


_HELD: dict[str, object] = {}


def worker_cache(name: str, make: Callable[[], object]):
    """An object that a worker process keeps between tasks. It keeps one at a
    time: an operator that comes after another finds the memory free."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = make()
    return _HELD[name]


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the cluster's shared folder."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished steps. Spark deletes them when the
    driver has collected the plans that made them, which a job of many small
    steps would not come to by itself before it ends."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def map_rows(df: DataFrame, make: Callable[[], Callable[[dict], dict]], schema: str, limit: int = CHUNK_BYTES) -> DataFrame:
    """``mapInArrow`` in chunks of at most about ``limit`` bytes, one row at least.

    ``make()`` runs once per task and returns a function from a dict of column
    lists to a dict of output column lists (in the order of ``schema``).
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructField, StructType, _parse_datatype_string

    given = _parse_datatype_string(schema)
    arrow, names = to_arrow_schema(given), df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for chunk in chunks(batches, limit):
            out = work(dict(zip(names, (c.to_pylist() for c in chunk.columns), strict=True)))
            if out is not None:
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], names=sent)

    sent = given.names
    if all(n.isidentifier() for n in names):
        return df.mapInArrow(run, schema)
    # mapInArrow looks its columns up by name, which dots and backticks defeat
    sent = [f"c{i}" for i in range(len(sent))]
    numbered = StructType([StructField(n, f.dataType) for n, f in zip(sent, given.fields, strict=True)])
    return df.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(run, numbered).toDF(*given.names)


def chunks(batches: Iterator[pa.RecordBatch], limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        step = max(1, int(batch.num_rows * limit / max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def global_rank(df: DataFrame, order: list[Column], rank: str) -> DataFrame:
    """``df`` with its 0-based rank in the order, without a one-task window.

    A range shuffle sorts the rows; each row gets its index in its partition
    and the counts of the partitions before it, a table with one row per
    partition, are added. The sorted rows are checkpointed once, so a lost
    executor cannot move rows between partitions. ``order`` must decide all
    ties that matter.
    """
    mid, part = "_mid", "_part"
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = checkpointed(rows.withColumn(mid, F.monotonically_increasing_id()))
    low = F.lit((1 << 33) - 1)
    rows = rows.withColumn(part, F.shiftright(F.col(mid), 33)).withColumn(mid, F.col(mid).bitwiseAND(low))
    return rows.join(F.broadcast(before(rows, part)), part).withColumn(
        rank, F.col(mid) + F.col("_before")
    ).drop(mid, part, "_before")


def before(rows: DataFrame, part: str, size: Column | None = None) -> DataFrame:
    """Per partition number, the rows (or sum of ``size``) of all partitions
    before it. One row per partition, so the window and its broadcast are
    bounded by the number of partitions."""
    from pyspark.sql import Window as W

    n = rows.groupBy(part).agg((F.count(F.lit(1)) if size is None else F.sum(size)).alias("_n"))
    w = W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    return n.select(part, F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (columns a, b, long): rows (node,
    component) with the smallest reachable node, for every node of an edge.

    Large-star and small-star rounds: every round links each node's
    neighbours to the smallest one, so the number of rounds grows with the
    logarithm of the longest path. Each star is a partial minimum and a join
    that adaptive execution can split, so a hot node does not sit in one
    task; every round is checkpointed. ``max_rounds`` guards against an
    endless loop only: it raises, never returns a half result.
    """
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    e = checkpointed(e)
    last = None
    for _ in range(max_rounds):
        # large star: neighbours larger than u go to the smallest of u and its neighbours
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        e2 = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: u and its smaller neighbours go to the smallest
        least = e2.groupBy("a").agg(F.min("b").alias("m"))
        e3 = e2.join(least, "a").select(F.col("b").alias("v"), "m", "a")
        e3 = e3.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
        e = checkpointed(e3.where("a <> b").distinct())
        now = e.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if now == last:
            release(edges.sparkSession)
            leaves = e.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
            roots = e.select("b").distinct().join(
                e.select(F.col("a").alias("b")), "b", "left_anti"
            )
            return leaves.unionByName(roots.select(F.col("b").alias("node"), F.col("b").alias("component")))
        last = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
