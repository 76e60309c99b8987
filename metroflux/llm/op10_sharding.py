"""Sharding along a Hilbert curve over several metadata dimensions.

Three dimensions (language, source, size) are quantised to levels by approximate
quantiles over all rows, each row gets its index on the Hilbert curve through the
level cube, rows are sorted by that index, and the order is cut into runs of
equal row counts.  Rows close in all dimensions lie in the same or neighbouring
shards, so filters on any of them skip files.  Everything is DataFrame functions.

Whole strings are ranked: distinct values are counted, their counts cumulated in the
order of the values (a range sort with partition offsets), and the level borders are at
most 31 values, whatever the number of distinct ones.  Law ``rows``: shard counts differ by at most one.  Ties on the
curve are ordered by id, text checksum and row number, so one hot value, or one row
repeated, is spread over as many tasks and shards as its rows need; equal texts need not share a shard.

Defined results: NULL values of a dimension form its lowest level; NULL text has
size 1 and checksum 0; repeated rows are placed each; an empty table gives no rows;
with fewer rows than shards the last shards are empty; other columns, whatever their names, are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metroflux.llm.common import stage

SHARDS, BITS, DIMENSIONS = 8, 5, 3
ACCURACY = 20_000


def curve_tables(n: int = DIMENSIONS) -> tuple[list[int], list[int]]:
    """For each state and corner (bit j: dimension j in the upper half): the corner's place, and the next state.

    A state is an entry corner e and a direction d.  Within a cube the corners are visited in Gray-code order,
    rotated and reflected by the state; each sub-cube's entry and direction follow from where its neighbours lie.
    """
    corners, full = 1 << n, (1 << n) - 1
    turn = lambda v, k: ((v << k % n) | (v >> (n - k % n))) & full
    place_of = {i ^ (i >> 1): i for i in range(corners)}
    place, following = [], []
    for state in range(corners * n):
        e, d = divmod(state, n)
        for corner in range(corners):
            w = place_of[turn(corner ^ e, n - (d + 1) % n)]
            last = (w - 1) & ~1
            entry = 0 if w == 0 else last ^ (last >> 1)
            odd = w if w % 2 else w - 1
            across = 0 if w == 0 else (odd ^ (odd + 1)).bit_length() - 1
            place.append(w)
            following.append((e ^ turn(entry, d + 1)) * n + (d + across + 1) % n)
    return place, following


def hilbert_index(levels: list[Column], bits: int = BITS) -> Column:
    """Index on the curve of a cell given by its level in each dimension (0 to 2**bits - 1)."""
    n = len(levels)
    place, following = (F.array(*map(F.lit, t)) for t in curve_tables(n))
    bit = lambda c, i: F.pmod(F.floor(c / F.pow(F.lit(2.0), i)), F.lit(2)).cast("int")
    corners = F.transform(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)),
                          lambda i: sum((bit(c, i) * (1 << j) for j, c in enumerate(levels)), F.lit(0)))

    def step(state: Column, corner: Column) -> Column:
        at = state["state"] * (1 << n) + corner + 1
        return F.struct((state["index"] * (1 << n) + F.element_at(place, at)).alias("index"),
                        F.element_at(following, at).alias("state"))

    start = F.struct(F.lit(0).cast("long").alias("index"), F.lit(0).alias("state"))
    return F.aggregate(corners, start, step)["index"]


def string_borders(rows: DataFrame, column: str, levels: int) -> list[str]:
    """The least value of each level but the first, of ``levels`` that hold about equally many rows; NULLs do not count."""
    parts = max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    counted = stage(rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
                    .repartitionByRange(parts, "value").sortWithinPartitions("value")
                    .withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)), "hilbert-values")
    sums = counted.groupBy("part").agg(F.sum("n").alias("n"))  # one row a partition
    total = F.sum("n").over(Window.partitionBy())
    offsets = sums.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"), total.alias("total"))
    inside = F.sum("n").over(Window.partitionBy("part").orderBy("at")) - F.col("n")
    placed = counted.withColumn("inside", inside).join(F.broadcast(offsets), "part")
    level = F.floor((F.col("before") + F.col("inside")) * levels / F.col("total"))
    found = placed.groupBy(level.alias("level")).agg(F.min("value").alias("value")).where("level > 0").collect()
    return sorted((r["value"] for r in found), key=str.encode)


def quantised(rows: DataFrame, numbers: list[str], strings: list[str], bits: int = BITS) -> DataFrame:
    """Replaces each column by its level among 2**bits quantiles of all rows; 0 for NULL."""
    fractions = [k / (1 << bits) for k in range(1, 1 << bits)]
    bounds = rows.agg(*[F.percentile_approx(d, fractions, ACCURACY).alias(d) for d in numbers]).first()
    borders = {d: [F.lit(int(c)).cast("long") for c in sorted(set(bounds[d] or []))] for d in numbers}
    for d in strings:
        borders[d] = [F.lit(v) for v in string_borders(rows, d, 1 << bits)]

    def level(d: str, cuts: list[Column]) -> Column:
        value = F.col(d)
        # A number's level counts the cuts below it, a string's also the one it equals.
        below = F.filter(F.array(*cuts), (lambda c: c < value) if d in numbers else (lambda c: c <= value))
        return F.when(value.isNotNull(), F.size(below)).otherwise(F.lit(0))

    return rows.withColumns({d: level(d, cuts) if cuts else F.lit(0) for d, cuts in borders.items()})


def place(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", source_col: str = "source", carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, *carry) of every row."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
                       F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
                       F.col(lang_col).cast("string").alias("__lang"), F.col(source_col).cast("string").alias("__source"),
                       (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("__size"),
                       *[F.col(c).alias(f"__{i}") for i, c in enumerate(carry)])
    dims = ["__lang", "__source", "__size"]
    order = ["__curve", "doc_id", "text_crc32", "__row"]
    parts = max(2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = stage(quantised(rows, ["__size"], ["__lang", "__source"])
                   .withColumns({"__curve": hilbert_index([F.col(d) for d in dims]), "__row": F.monotonically_increasing_id()}).drop(*dims)
                   .repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("__row")
                   .withColumn("__at", F.monotonically_increasing_id()), "hilbert-order")
    # Rank = rows of the partitions before + place in the partition; one row a partition, so small at any size.
    counts = placed.groupBy(F.shiftright("__at", 33).alias("__part")).agg(F.count("*").alias("__n"))
    before = counts.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    total = placed.count()
    least, more = divmod(total, shards)
    wide = more * (least + 1)  # rows in the shards that take one more
    rank = F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    ranked = (placed.withColumn("__part", F.shiftright("__at", 33)).join(F.broadcast(before), "__part")
              .withColumn("__rank", rank))
    r = F.col("__rank")
    shard = F.when(r < wide, F.floor(r / (least + 1))).otherwise(more + F.floor((r - wide) / max(least, 1)))
    slot = F.when(r < wide, r % (least + 1)).otherwise((r - wide) % max(least, 1))
    return ranked.select("doc_id", "size", "text_crc32", shard.cast("int").alias("shard"), slot.cast("long").alias("slot"),
                         *[F.col(f"__{i}").alias(c) for i, c in enumerate(carry)])


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, carry: tuple[str, ...] = ("text", "lang", "source")) -> None:
    """The rows as Parquet in one folder per shard, each in curve order, split into files by slot."""
    (place(docs, shards, carry=carry).repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


def sharded(docs: DataFrame) -> DataFrame:
    """Query op10: the placement under law ``rows``."""
    return place(docs).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                              F.lit(None).cast("int").alias("grown_shard"))
