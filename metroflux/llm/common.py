"""Helpers shared by the training-data operators: staged tables, Arrow mapping, connected components."""

from __future__ import annotations

import contextlib
import ctypes
import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from metroflux.session import checkpoint_dir

#: Bytes of the rows that go to a Python worker at once.
BATCH_BYTES = 4 << 20
#: Folders written by this driver, for ``drop_staged``.
STAGED: list[str] = []


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs a re-read of the table, not a
    recomputation of what made it.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    STAGED.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession, since: int = 0, keep: int = 0) -> None:
    """Remove the staged folders of this driver from number ``since`` on, once their results are written; the last ``keep`` stay."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while len(STAGED) > since + keep:
        path = jvm.org.apache.hadoop.fs.Path(STAGED.pop(since))
        path.getFileSystem(conf).delete(path, True)


def tokenizer_path(name: str) -> str:
    """A tokenizer file: a path as given, or the name of an installed public vocabulary."""
    if os.path.exists(name):
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


#: Owner and value of the worker's table, and whether the task at work has asked for it.
_TABLE: list = [None, None, False]


def worker_table(owner, make: Callable[[], object]):
    """The Python worker's table of ``owner``, made once.

    Workers are reused by the stages of an application; one table is held at a time, and none beyond a task
    that has not asked for it, so a worker's memory is that of its present stage, not of all before it.
    """
    if _TABLE[0] != owner:
        _TABLE[:] = None, None, True
        _TABLE[:] = owner, make(), True
    _TABLE[2] = True
    return _TABLE[1]


def give_back() -> None:
    """Drops a table that the finished task did not use, and returns what the allocators hold to the system."""
    if not _TABLE[2]:
        _TABLE[:] = None, None, False
    _TABLE[2] = False
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def bound_batches(spark: SparkSession) -> None:
    """Holds the session's Arrow batches to ``BATCH_BYTES``, unless it has a limit of its own.

    Spark's 64 MB stand several times a task: vectors that double as they grow in the JVM, the message, and its
    copy in the Python worker.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))


def map_rows(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str,
             rows: int = 512) -> DataFrame:
    """``mapInArrow`` that hands ``fn`` slices of at most ``rows`` rows of bounded batches, so memory follows the slice."""
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                yield fn(batch.slice(start, rows))
        give_back()
    return df.mapInArrow(run, schema)


def connected_components(edges: DataFrame, label: str = "components", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b); component = smallest id reachable.

    Large-star / small-star: each round links every node to the smallest node
    of its neighbourhood, until the edges are stars.  Each round is two joins on
    a node with a map-side pre-aggregated minimum; a hub's rows are split by
    AQE's skew join.  Rounds are written to the shared folder.  Empty edges give
    an empty result; self edges and NULL ends are ignored.
    """
    e = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
              f"{label}-edges")
    before = None
    for _ in range(max_rounds):
        # large-star: neighbours above u move to the least of u's neighbourhood
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        # small-star: neighbours below u, and u itself, move to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        # Counted in the write itself: a round is one job.
        seen = Observation()
        e = stage(small.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")), f"{label}-round")
        now = seen.get
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each run of equal ``keys`` in a sorted stream; runs are bounded, so is what is held."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if held:
            table = pa.concat_tables([*held, table]).combine_chunks()
        change = np.zeros(table.num_rows, bool)
        for k in keys:
            c = table.column(k).to_numpy()
            change[1:] |= c[1:] != c[:-1]
        at = [0, *np.flatnonzero(change).tolist()]
        for a, b in zip(at, at[1:]):
            yield table.slice(a, b - a)
        held = [table.slice(at[-1])]
    yield from held


def deal_blocks(rows: DataFrame, key: str, block: int) -> DataFrame:
    """Deals each key's rows into cells that together compare own rows with others, and others with others.

    ``rows`` has ``key``, ``id`` and ``own`` (boolean).  Cells are numbered by kind, i, j: kind 0 holds
    block i of the own rows and block j of the others, kind 1 blocks i and j of the others.  A block has
    about ``block`` rows, so no cell grows with its key; keys without others are dropped.  The result is
    partitioned and sorted by the cell.
    """
    own = F.col("own")
    sizes = (rows.groupBy(key).agg(F.count_if(own).alias("n_own"), F.count_if(~own).alias("n_other"))
             .where("n_other > 0").select(key, F.ceil(F.col("n_own") / block).cast("int").alias("g"),
                                          F.ceil(F.col("n_other") / block).cast("int").alias("h")))
    g, h = F.col("g"), F.col("h")
    mine = F.pmod(F.xxhash64("id"), F.greatest(F.when(own, g).otherwise(h), F.lit(1))).cast("int")
    cell = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
    others = F.sequence(F.lit(0), h - 1)
    cells = F.when(own, F.transform(others, lambda q: cell(0, mine, q))).otherwise(F.concat(
        F.when(g > 0, F.transform(F.sequence(F.lit(0), F.greatest(g - 1, F.lit(0))), lambda p: cell(0, p, mine)))
        .otherwise(F.slice(F.transform(others, lambda q: cell(0, mine, q)), 1, 0)),
        F.transform(others, lambda q: cell(1, F.least(mine, q), F.greatest(mine, q)))))
    return (rows.join(sizes, key).withColumn("cell", F.explode(cells)).select(*rows.columns, "cell.kind", "cell.i", "cell.j")
            .repartition(key, "kind", "i", "j").sortWithinPartitions(key, "kind", "i", "j"))
