"""Best-fit packing of tokenised documents into sequences, by large-item matching.

Documents become items of at most ``CAPACITY`` tokens; only longer ones are cut.
Items above a third of the capacity fit at most two to a bin and are paired
greedily: the largest left with the largest that still fits beside it.  Smaller
items then go, largest first, into the smallest gap that holds them.

Sizes are integers up to the capacity, so the whole packing follows from how
many items there are of each size.  That histogram (at most ``CAPACITY`` rows) is
all the driver sees; it answers with a plan of runs - so many items of a size, in
such bins, at such an offset - whose length is bounded by the capacity, not by the
number of documents.  Spark numbers the items of each size and looks their
places up in the plan.

Defined results: NULL text is empty (one closing id); repeated rows are packed
each; equal sizes are interchangeable; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metroflux.llm import tokens
from metroflux.llm.common import map_rows, stage

CAPACITY, END_ID = 2048, 0
#: Items of a size are numbered in so many buckets, so that no size is one task's.
BUCKETS = 512


def cut_pieces(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones after a first that holds the rest."""
    first = length % capacity or min(length, capacity)
    bounds = [0, *range(first, length + 1, capacity)]
    return [(a, b - a) for a, b in zip(bounds, bounds[1:])]


def pieces(docs: DataFrame, vocabulary: str = tokens.VOCABULARY, capacity: int = CAPACITY,
           id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document: its ids, then ``END_ID``."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:5 + with_ids]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        close = END_ID.to_bytes(4, "little")
        coded = tokens.encoder(vocabulary).encode(batch.column(1).to_pylist())
        for doc, ids in zip(batch.column(0).to_pylist(), coded):
            ids += close
            for k, (start, length) in enumerate(cut_pieces(len(ids) // 4, capacity)):
                part = ids[4 * start:4 * (start + length)]
                rows.append((doc, k, start, length, zlib.crc32(part), part))
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(cols[i], types[i]) for i in range(len(names))], names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return map_rows(src, run, schema)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (size, first rank, items, items per bin, first bin, offset in the bin) of the packing.

    Item number r of a run lies in bin ``first bin + r // per_bin`` at ``offset + (r % per_bin) * size``.
    A group of equal bins is filled or split as a whole.  A bin takes items of at most
    sqrt(2 * capacity) different sizes, and each (size, group) makes at most two runs, so the
    plan has at most about capacity**1.5 * 6 short rows, whatever the number of items.
    """
    left = {s: n for s, n in histogram.items() if n}
    used: dict[int, int] = defaultdict(int)
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> (first bin, bins)
    runs, bins = [], 0

    def put(size, items, per_bin, first, offset):
        runs.append((size, used[size], items, per_bin, first, offset))
        used[size] += items

    large = sorted((s for s in left if 3 * s > capacity), reverse=True)
    for s in large:
        while left[s]:
            t = next((t for t in large if t <= min(s, capacity - s) and left[t] > (t == s)), None)
            if t is None:
                n = left[s]
                put(s, n, 1, bins, 0)
                left[s] = 0
                gaps[capacity - s].append((bins, n))
            elif t == s:
                n = left[s] // 2
                put(s, 2 * n, 2, bins, 0)
                left[s] -= 2 * n
                gaps[capacity - 2 * s].append((bins, n))
            else:
                n = min(left[s], left[t])
                put(s, n, 1, bins, 0)
                put(t, n, 1, bins, s)
                left[s] -= n
                left[t] -= n
                gaps[capacity - s - t].append((bins, n))
            bins += n

    for s in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        n, gap = left[s], s
        while n:
            # After a group is filled, what remains of its gap is below s: never looked at again for this size.
            while gap < capacity and not gaps[gap]:
                gap += 1
            if gaps[gap]:
                first, count = gaps[gap].pop()
            else:
                gap = capacity
                first, count = bins, -(-n // (capacity // s))
                bins += count
            each = gap // s
            full = min(count, n // each)
            if full:
                put(s, full * each, each, first, capacity - gap)
                gaps[gap - each * s].append((first, full))
                n -= full * each
            if n and full < count:
                put(s, n, n, first + full, capacity - gap)
                gaps[gap - n * s].append((first + full, 1))
                full, n = full + 1, 0
            if full < count:
                gaps[gap].append((first + full, count - full))
    return runs


def place(items: DataFrame, capacity: int = CAPACITY, buckets: int = BUCKETS) -> DataFrame:
    """Adds (sequence_id, offset) to ``items``, which has doc_id, piece, length and ids_crc32.

    ``items`` is read three times: give it as a written table.
    """
    spark = items.sparkSession
    dealt = items.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    counts = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = spark.createDataFrame(
        plan(histogram, capacity),
        "length long, first_rank long, items long, per_bin long, first_bin long, first_offset long")
    before = counts.select("length", "bucket", (F.sum("n").over(
        Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        - F.col("n")).alias("before"))
    rank = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = (dealt.withColumn("rank", rank).join(before, ["length", "bucket"])
              .withColumn("rank", F.col("before") + F.col("rank") - 1))
    # The plan's size is bounded by the capacity (see plan), so it may be broadcast at any input size.
    at = F.col("rank") - F.col("first_rank")
    return (ranked.join(F.broadcast(runs), (ranked["length"] == runs["length"]) & (at >= 0) & (at < F.col("items")))
            .select(*[ranked[c] for c in items.columns],
                    (F.col("first_bin") + F.floor(at / F.col("per_bin"))).cast("long").alias("sequence_id"),
                    (F.col("first_offset") + F.pmod(at, F.col("per_bin")) * ranked["length"]).cast("long").alias("offset")))


def pack(docs: DataFrame, vocabulary: str = tokens.VOCABULARY, capacity: int = CAPACITY,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Query op3: every piece with its sequence and place in it.

    Texts are tokenised once; the piece table (a few dozen bytes a piece) is
    written and used for the histogram, the numbering and the result.
    """
    made = stage(pieces(docs, vocabulary, capacity, id_col, text_col), "packing-pieces")
    return place(made, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def sequences(docs: DataFrame, vocabulary: str = tokens.VOCABULARY, capacity: int = CAPACITY,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(sequence_id, ids, doc_ids): the packed token sequences themselves, at most ``capacity`` ids each."""
    made = stage(pieces(docs, vocabulary, capacity, id_col, text_col, with_ids=True), "packing-ids")
    part = F.struct("offset", "doc_id", "ids")
    return (place(made, capacity).groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("parts"))
            .select("sequence_id",
                    F.aggregate("parts", F.lit(b"").cast("binary"), lambda acc, p: F.concat(acc, p["ids"])).alias("ids"),
                    F.transform("parts", lambda p: p["doc_id"]).alias("doc_ids")))
