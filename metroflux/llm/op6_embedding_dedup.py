"""Embedding near-duplicates by sorted projection passes.

Each pass hashes every vector to the signs of ``KEY_BITS`` random projections and
orders all vectors by that bit string; close vectors agree in long prefixes and
land near each other.  Every vector is compared, in double precision, with the
``WINDOW`` vectors after it, and the verified pairs of all passes are united.

A pass finds every pair that agrees in its leading ``prefix_bits``: a prefix of at most
``WINDOW`` + 1 vectors lies within the window, and the vectors of a fuller prefix, as dense
regions make them, are counted in Spark and compared with each other in blocks of
bounded size, which give a forest of their links.  The number of passes follows from the bits,
and those from the number of vectors, so that a pair at the threshold itself agrees in
one of the passes with probability ``RECALL``, however the vectors lie.  Only vectors that share
a full prefix are compared beyond the window; that costs the square of the group.

Equal vectors are one class throughout.  The windows find the components; the
links inside a component are then counted in full: members within half the
threshold angle of its first vector are linked with each other by the triangle
inequality and only counted, the others are compared in blocks of bounded size.

Defined results: vectors that are NULL, empty, zero or hold NULL or non-finite
components link with nothing; vectors of different lengths never link; repeated
rows count as vectors; a NULL id gets a NULL component and is kept; an empty table gives
no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metroflux.llm.common import connected_components, deal_blocks, runs, stage

COSINE, WINDOW, RECALL, KEY_BITS = 0.9, 64, 0.995, 63
#: Rows of a block of the sorted order, of a block side inside a component, and inside a full prefix.
BLOCK, CELL, WIDE_CELL = 2048, 512, 2048


def prefix_bits(n: int) -> int:
    """Leading bits that leave half a window of vectors to a prefix where they are spread out."""
    return max(1, math.ceil(math.log2(max(n, 2) / (WINDOW / 2))))


def passes_for(n: int) -> int:
    """Passes in one of which a pair at the threshold agrees in the leading bits with probability RECALL."""
    found = (1 - math.acos(COSINE) / math.pi) ** prefix_bits(n)
    return max(4, math.ceil(math.log(1 - RECALL) / math.log(1 - found)))


def projections(length: int, turn: int) -> np.ndarray:
    return np.random.default_rng([length, turn]).standard_normal((length, KEY_BITS))


def as_matrix(column: pa.Array) -> np.ndarray:
    """Binary float64 vectors of one length."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), "<f8").reshape(len(rows), -1)


def units(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, length, unit): unit is the normalised vector as float64 bytes, NULL where it cannot link."""
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, lengths = [], []
            for v in batch.column(1).to_pylist():
                x = np.array(v, np.float64) if v and None not in v else np.zeros(0)
                top = np.abs(x).max() if len(x) and np.isfinite(x).all() else 0.0
                if top:
                    x = x / top  # keeps the squares of very large or small components in range
                    x = (x / np.sqrt((x * x).sum())) + 0.0
                units.append(x.astype("<f8").tobytes() if top else None)
                lengths.append(len(x))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int32()), pa.array(units, pa.binary())],
                                             ["vec_id", "length", "unit"])

    return src.mapInArrow(run, "vec_id long, length int, unit binary")


def keys(classes: DataFrame, passes: int) -> DataFrame:
    """(pass, length, key, id) of every class in every pass; key orders like its bit string."""
    weights = 1 << np.arange(KEY_BITS - 1, -1, -1, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lengths = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for length in np.unique(lengths).tolist():
                own = np.flatnonzero(lengths == length)
                x = as_matrix(batch.column(2).take(pa.array(own)))
                for turn in range(passes):
                    key = ((x @ projections(length, turn)) > 0) @ weights
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(own), turn, np.int32)), pa.array(np.full(len(own), length, np.int32)),
                         pa.array(key), pa.array(ids[own])], ["pass", "length", "key", "id"])

    return classes.select("id", "length", "unit").mapInArrow(run, "pass int, length int, key long, id long")


def star_links(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (first, member) that connect what the symmetric matrix ``hit`` connects, one a member at most."""
    left = hit.any(1)
    a, b = [], []
    for first in range(len(hit)):
        if not left[first]:
            continue
        seen = np.zeros(len(hit), bool)
        new = np.array([first])
        seen[first] = True
        while len(new):
            reach = hit[new].any(0) & ~seen
            seen |= reach
            new = np.flatnonzero(reach)
        left &= ~seen
        seen[first] = False
        b.append(np.flatnonzero(seen))
        a.append(np.full(len(b[-1]), first))
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, int), np.zeros(0, int))


def tree_links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the links (a, b) those that join what the ones before them have not joined."""
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while root.get(x, x) != x:
            root[x] = x = root.get(root[x], root[x])
        return x

    keep = np.zeros(len(a), bool)
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = top(x), top(y)
        if x != y:
            root[x] = y
            keep[k] = True
    return a[keep], b[keep]


def full_prefix_pairs(placed: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) that connect the vectors of each prefix with more members than a window holds.

    ``placed`` has pass, length, prefix and id.  A link is a pair within the threshold, or joins two that such pairs join.
    """
    group = ["pass", "length", "prefix"]
    full = (placed.groupBy(*group).agg(F.count("*").alias("n")).where(F.col("n") > WINDOW + 1)
            .select(*group, F.ceil(F.col("n") / WIDE_CELL).cast("int").alias("h"), F.monotonically_increasing_id().alias("key")))
    rows = (placed.join(stage(full, "projection-full"), group)
            .select("key", "id", F.lit(False).alias("own"), F.pmod(F.xxhash64("id"), F.col("h")).cast("int").alias("side"))
            .join(classes.select("id", "unit"), "id").select("key", "id", "own", "side", "unit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, ["key", "kind", "i", "j"]):
            x, ids, side = as_matrix(t.column("unit").combine_chunks()), t.column("id").to_numpy(), t.column("side").to_numpy()
            hit = x @ x.T >= COSINE
            np.fill_diagonal(hit, False)
            if t.column("i")[0].as_py() != t.column("j")[0].as_py():
                hit &= side[:, None] != side[None, :]  # pairs of one block have their own cell
            a, b = star_links(hit)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(ids[a], ids[b])), pa.array(np.maximum(ids[a], ids[b]))], ["a", "b"])

    return deal_blocks(rows, "key", WIDE_CELL).mapInArrow(run, "a long, b long")


def window_pairs(classes: DataFrame, passes: int, bits: int) -> DataFrame:
    """Links (a, b) that connect the neighbours within the threshold in each pass's order, and those of its full prefixes."""
    order = ["pass", "length", "key", "id"]
    n = max(2, int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = stage(keys(classes, passes).repartitionByRange(n, *order).sortWithinPartitions(*order)
                   .select("length", "pass", "id", F.shiftright("key", KEY_BITS - bits).alias("prefix"),
                           F.monotonically_increasing_id().alias("at")), "projection-order")
    # Rank = rows of the partitions before + place in the partition; one row a partition, so small at any size.
    part = F.shiftright("at", 33)
    before = (placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
              .select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before")))
    ranked = (placed.withColumn("part", part).join(F.broadcast(before), "part")
              .withColumn("rank", F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))))
    block, place = F.floor(F.col("rank") / BLOCK), F.col("rank") % BLOCK
    # The first WINDOW rows of a block also end the block before.
    both = F.when((place < WINDOW) & (block > 0), F.array(block, block - 1)).otherwise(F.array(block))
    blocks = (ranked.select("length", "pass", "rank", "id", F.explode(both).alias("block"))
              .join(classes.select("id", "unit"), "id").repartition("block").sortWithinPartitions("block", "rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, ["block"]):
            ids, own = t.column("id").to_numpy(), t.column("length").to_numpy().astype(np.int64) << 32 | t.column("pass").to_numpy()
            for start in np.flatnonzero(np.diff(own, prepend=-1)).tolist():
                stop = start + int((own == own[start]).sum())  # sorted: one pass and length lie together
                x, i = as_matrix(t.column("unit").slice(start, stop - start).combine_chunks()), ids[start:stop]
                hits = [(hit, hit + d) for d in range(1, min(WINDOW, len(x) - 1) + 1)
                        if len(hit := np.flatnonzero(np.einsum("ij,ij->i", x[:-d], x[d:]) >= COSINE))]
                if hits:
                    a, b = tree_links(*(np.concatenate(side) for side in zip(*hits)))
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(i[a], i[b])), pa.array(np.maximum(i[a], i[b]))], ["a", "b"])

    return blocks.mapInArrow(run, "a long, b long").union(full_prefix_pairs(placed, classes)).distinct()


def link_counts(members: DataFrame) -> DataFrame:
    """(id, links): linked vectors of other classes in the same component; ``members`` has component, id, copies, unit."""
    first = members.where("id = component").select("component", F.col("unit").alias("pivot"))
    half = math.cos(math.acos(COSINE) / 2 - 1e-7)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [float(np.frombuffer(u, "<f8") @ np.frombuffer(p, "<f8")) >= half
                   for u, p in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(own, pa.bool_())],
                                             ["component", "id", "copies", "unit", "own"])

    rows = stage(members.join(first, "component").select("component", "id", "copies", "unit", "pivot")
                 .mapInArrow(near, "component long, id long, copies long, unit binary, own boolean"), "projection-members")
    core = rows.where("own").groupBy("component").agg(F.sum("copies").alias("n"))
    inside = rows.where("own").join(core, "component").select("id", (F.col("n") - F.col("copies")).alias("links"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, ["component", "kind", "i", "j"]):
            x, ids, copies, own = (as_matrix(t.column("unit").combine_chunks()), t.column("id").to_numpy(),
                                   t.column("copies").to_numpy(), t.column("own").to_numpy())
            kind, i, j = (t.column(c)[0].as_py() for c in ("kind", "i", "j"))
            if kind == 0:
                left, right = np.flatnonzero(own), np.flatnonzero(~own)
                hit = x[left] @ x[right].T >= COSINE
                out = [(left, hit @ copies[right]), (right, hit.T @ copies[left])]
            else:
                # Others against others: each ordered pair is counted in the cell of its two blocks, once.
                side = t.column("side").to_numpy()
                hit = x @ x.T >= COSINE
                hit &= (side[:, None] != side[None, :]) if i != j else ~np.eye(len(x), dtype=bool)
                out = [(np.arange(len(x)), hit @ copies)]
            for at, n in out:
                yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(n.astype(np.int64))], ["id", "links"])

    # deal_blocks deals a row by this hash; which of a cell's two blocks it is of tells the sides apart.
    others = rows.groupBy("component").agg(F.ceil(F.count_if(~F.col("own")) / CELL).cast("int").alias("h"))
    sided = (rows.join(others, "component")
             .withColumn("side", F.pmod(F.xxhash64("id"), F.greatest("h", F.lit(1))).cast("int")).drop("h"))
    more = deal_blocks(sided, "component", CELL).mapInArrow(run, "id long, links long")
    return inside.union(more).groupBy("id").agg(F.sum("links").alias("links"))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Query op6: (vec_id, n_links, component_id, kept) per row."""
    made = stage(units(vectors, id_col, vec_col), "projection-units")
    linked = made.where("unit is not null and vec_id is not null")
    classes = stage(linked.groupBy("length", "unit").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
                    .select("length", "unit", "first", "copies", F.monotonically_increasing_id().alias("id")),
                    "projection-classes")
    n = classes.count()
    pairs = window_pairs(classes, passes_for(n), min(prefix_bits(n), KEY_BITS))
    components = stage(connected_components(pairs, "projection-components").withColumnRenamed("node", "id"),
                       "projection-components")
    members = components.join(classes.select("id", "copies", "unit", "first"), "id")
    links = link_counts(members.drop("first"))
    least = members.groupBy("component").agg(F.min("first").alias("least"))
    of_class = (classes.join(components, "id", "left").join(least, "component", "left").join(links, "id", "left")
                .select("length", "unit", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
                        F.coalesce("least", "first").alias("least")))
    own = F.col("unit").isNotNull() & F.col("vec_id").isNotNull()
    return (made.join(of_class, ["length", "unit"], "left")
            .select("vec_id", F.when(own, F.col("links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
                    F.when(own, F.col("least")).otherwise(F.col("vec_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))
