"""MinHash near-duplicates by a multi-index Hamming join.

Every text becomes a set of five-word shingles, a signature of ``SYMBOLS`` minima
of ``BITS`` bits that is indexed, and a longer one of ``WIDE`` minima of eight bits
that is compared.  Two texts of similarity s differ in about (1 - s) of the
symbols; pairs at the threshold of ``percent`` stay within ``Limits.distance`` and
``Limits.wide`` differing symbols but for a chance below 1e-5 each (binomial tail;
it falls fast above).  Indexed signatures are split into ``Limits.chunks`` chunks; by
the pigeonhole principle two within the distance differ in at most one symbol of
some chunk, so each chunk is indexed once per symbol left out, and every such
pair meets under some key.

What meets is not paired all against all:

1. Texts of one shingle set are one class; only one row of it goes on.
2. Each class is compared with the smallest class it meets under any key (a star),
   first by signature, then on full shingle sets; confirmed links give components.
2. Keys that still hold several components get forests: within a block of bounded
   size the nearest pairs that join different components are taken up, each pair
   of components once, as in Kruskal's algorithm.  That is a link fewer than there are
   components, not one a pair.  An eighth of the keys joins most of a group.
   Components are settled after each round, from the labels so far and the new links.
3. What is then left in different components under one key are pairs whose nearest
   was rejected.  All of them are compared by signature, in blocks; the rows of the
   largest component meet only the others.  A pair is taken up under the first key that
   its signatures share, once in all.  What passes travels packed, many pairs in a row, to
   where the two blocks of texts meet that hold them; a text goes once to each pair of
   blocks, not once to each pair of texts, and only a forest of the confirmed links comes back.

Every pair within the signature distance is thus confirmed, rejected, or already
in one component.

Defined results: NULL, empty or blank texts have no shingles and link with
nothing; fewer than five words make one shingle; repeated rows and equal texts
share a component; a NULL id gets a NULL component and is kept; an empty table
gives no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroflux.llm.common import connected_components, deal_blocks, map_rows, runs, stage, worker_table

WORDS, PERCENT = 5, 85
#: The pipeline's stage links from here on.
STAGE_PERCENT = 80
SYMBOLS, BITS, WIDE = 64, 16, 256
#: Chance that a pair at the threshold is beyond a signature's distance.
MISSED = 1e-5
#: Forest rounds, by the share of the keys they look under: slot % share == 0.
ROUNDS = (8,)
#: Rows of one side of a block of the comparisons.
BLOCK = 512
#: Shingles of the sets of a block of texts: 8 MB.
BLOCK_SHINGLES = 1 << 20
WORD_TABLE = 60_000


class Limits(NamedTuple):
    """Signature distances of a threshold, and how many chunks make their pigeonhole."""

    percent: int
    distance: int
    wide: int
    chunks: int

    @classmethod
    def of(cls, percent: int) -> Limits:
        def beyond(n: int) -> int:
            p = 1 - percent / 100
            tail, d = 1.0, -1
            while tail >= MISSED:
                d += 1
                tail -= comb(n, d) * p**d * (1 - p)**(n - d)
            return d
        distance = beyond(SYMBOLS)
        return cls(percent, distance, beyond(WIDE), distance // 2 + 1)

    def chunk_of(self) -> np.ndarray:
        """Each symbol's chunk; distance < 2 * chunks, so some chunk has at most one difference."""
        return np.repeat(np.arange(self.chunks), [len(c) for c in np.array_split(np.arange(SYMBOLS), self.chunks)])


def _constants(seed: int, n: int) -> np.ndarray:
    """Odd 64-bit numbers from a fixed seed."""
    return np.random.default_rng(seed).integers(0, 2**64, n, dtype=np.uint64) | np.uint64(1)


PLACE = _constants(1, WORDS)
SCALE, SHIFT = (_constants(k, WIDE).astype(np.uint32) for k in (2, 3))
AT_SYMBOL, OF_KEY = _constants(4, SYMBOLS), _constants(5, SYMBOLS)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class WordHashes(dict):
    """64-bit hashes of words, bounded."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = h
        return h


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, and white space \x20 \x09-\x0D only
    if not words:
        return np.empty(0, np.uint64)
    table = worker_table("word hashes", WordHashes)
    if len(table) > WORD_TABLE:
        table.clear()
    h = np.fromiter(map(table.__getitem__, words), np.uint64, len(words))
    width = min(WORDS, len(words))
    n = len(words) - width + 1
    total = np.full(n, np.uint64(width))
    for k in range(width):
        total += h[k:k + n] * PLACE[k]
    return np.unique(mix(total))


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, sig, wide): set_a and set_b identify the shingle set; the others pack minima."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingles(t) for t in batch.column(1).to_pylist()]
        size = np.fromiter(map(len, sets), np.int64, len(sets))
        some = np.flatnonzero(size)
        sig, wide = np.zeros((len(sets), SYMBOLS), "<u2"), np.zeros((len(sets), WIDE), np.uint8)
        if len(some):
            flat = (np.concatenate([sets[i] for i in some]) >> np.uint64(32)).astype(np.uint32)
            at = np.concatenate([[0], np.cumsum(size[some])[:-1]])
            for k in range(WIDE):
                least = mix(np.minimum.reduceat(flat * SCALE[k] + SHIFT[k], at).astype(np.uint64))
                wide[some, k] = least & np.uint64(255)
                if k < SYMBOLS:
                    sig[some, k] = least >> np.uint64(64 - BITS)
        ends = list(map(set_digest, sets))
        pair = np.frombuffer(b"".join(ends), "<i8").reshape(-1, 2)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(size), pa.array(pair[:, 0].copy()), pa.array(pair[:, 1].copy()),
             pa.array([r.tobytes() for r in sig], pa.binary()), pa.array([r.tobytes() for r in wide], pa.binary())],
            ["doc_id", "n_shingles", "set_a", "set_b", "sig", "wide"])

    return map_rows(src, run, "doc_id long, n_shingles long, set_a long, set_b long, sig binary, wide binary")


def set_digest(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def own_texts(rows: DataFrame) -> DataFrame:
    """(id, text) of the ``rows`` (id, set_a, set_b, text) whose text has that set: an id may repeat with other texts."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        want = [np.array(x, "<i8").tobytes() for x in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
        same = [set_digest(shingles(t)) == w for t, w in zip(batch.column(3).to_pylist(), want)]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(3)], ["id", "text"]).filter(pa.array(same, pa.bool_()))

    return map_rows(rows.select("id", "set_a", "set_b", "text"), run, "id long, text string")


def unpack(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, SYMBOLS)


def unpack_wide(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, WIDE)


def chunk_keys(sig: np.ndarray, chunk_of: np.ndarray) -> np.ndarray:
    """The keys of each signature: its chunk without one symbol, for every symbol."""
    term = mix(sig.astype(np.uint64) + AT_SYMBOL)
    starts = np.flatnonzero(np.diff(chunk_of, prepend=-1))
    return mix(np.add.reduceat(term, starts, axis=1)[:, chunk_of] - term + OF_KEY).view(np.int64)


def first_shared(differs: np.ndarray, chunk_of: np.ndarray) -> np.ndarray:
    """The first key that two signatures under a common key share, from where they differ."""
    starts = np.flatnonzero(np.diff(chunk_of, prepend=-1))
    chunk = (np.add.reduceat(differs, starts, axis=1, dtype=np.int64) <= 1).argmax(1)
    inside = differs & (chunk_of == chunk[:, None])
    return np.where(inside.any(1), inside.argmax(1), starts[chunk])


def index(classes: DataFrame, limits: Limits) -> DataFrame:
    """(key, id, slot) rows of every class; slot numbers a signature's keys."""
    chunk_of = limits.chunk_of()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = chunk_keys(unpack(batch.column(1)), chunk_of)
        ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), SYMBOLS)
        slots = np.tile(np.arange(SYMBOLS, dtype=np.int8), len(keys))
        return pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(ids), pa.array(slots)], ["key", "id", "slot"])

    return map_rows(classes.select("id", "sig"), run, "key long, id long, slot byte", rows=2048)


def near(pairs: DataFrame, classes: DataFrame, limits: Limits) -> DataFrame:
    """The pairs (a, b) whose signatures are within the distance."""
    both = (pairs.join(classes.select(F.col("id").alias("a"), F.col("wide").alias("wide_a")), "a")
            .join(classes.select(F.col("id").alias("b"), F.col("wide").alias("wide_b")), "b")
            .select("a", "b", "wide_a", "wide_b"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        apart = (unpack_wide(batch.column(2)) != unpack_wide(batch.column(3))).sum(1)
        return pa.RecordBatch.from_arrays(list(batch.columns[:2]), ["a", "b"]).filter(pa.array(apart <= limits.wide))

    return map_rows(both, run, "a long, b long", rows=4096)


def confirmed(pairs: DataFrame, texts: DataFrame, limits: Limits) -> DataFrame:
    """The pairs whose full shingle sets reach the threshold; ``texts`` has id and text."""
    both = (pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
            .select("a", "b", "text_a", "text_b"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        known: dict[int, np.ndarray] = {}

        def of(i, text):
            if i not in known:
                known[i] = shingles(text)
            return known[i]

        keep = []
        for a, b, x, y in zip(*(c.to_pylist() for c in batch.columns)):
            x, y = of(a, x), of(b, y)
            shared = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * shared >= limits.percent * (len(x) + len(y) - shared))
        return pa.RecordBatch.from_arrays(list(batch.columns[:2]), ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return map_rows(both, run, "a long, b long", rows=256)


def forest(ids: np.ndarray, comp: np.ndarray, wide: np.ndarray, left: np.ndarray, right: np.ndarray, most: int):
    """Pairs (a, b) of a block that join its components: the nearest first, none within what is joined already."""
    a, b, apart = [], [], []
    for r in right.tolist():
        some = left[comp[left] != comp[r]]
        far = (wide[some] != wide[r]).sum(1)
        ok = far <= most
        if not ok.any():
            continue
        # Of each other component only the nearest row can be taken up for this row.
        some, far = some[ok], far[ok]
        order = np.lexsort((some, far, comp[some]))
        some, far = some[order], far[order]
        first = np.flatnonzero(np.diff(comp[some], prepend=comp[some[0]] - 1))
        a.append(np.full(len(first), r))
        b.append(some[first])
        apart.append(far[first])
    if not a:
        return [], []
    a, b, apart = map(np.concatenate, (a, b, apart))
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while root.get(x, x) != x:
            root[x] = x = root.get(root[x], root[x])
        return x

    out_a, out_b = [], []
    for k in np.lexsort((b, a, apart)).tolist():
        x, y = top(int(comp[a[k]])), top(int(comp[b[k]]))
        if x != y:
            root[x] = y
            out_a.append(int(ids[a[k]]))
            out_b.append(int(ids[b[k]]))
    return out_a, out_b


def cells(rows: DataFrame) -> DataFrame:
    """``rows`` (key, id, component, ...) dealt into blocks; a key's largest component meets only its other rows."""
    largest = (rows.groupBy("key", "component").agg(F.count("*").alias("n")).groupBy("key")
               .agg(F.max(F.struct("n", "component"))["component"].alias("largest")))
    return deal_blocks(rows.join(largest, "key").withColumn("own", F.col("component") == F.col("largest"))
                       .drop("largest"), "key", BLOCK)


def cell_runs(batches: Iterator[pa.RecordBatch]):
    """(table, ids, components, wide signatures, rows of the left side, rows of the right side) of each cell."""
    for t in runs(batches, ["key", "kind", "i", "j"]):
        own = t.column("own").to_numpy()
        left = np.flatnonzero(own) if t.column("kind")[0].as_py() == 0 else np.arange(len(own))
        yield t, t.column("id").to_numpy(), t.column("component").to_numpy(), unpack_wide(t.column("wide")), left, np.flatnonzero(~own)


def forest_pairs(rows: DataFrame, limits: Limits) -> DataFrame:
    """Pairs (a, b) of the forests of all blocks of the rows' keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids, comp, wide, left, right in cell_runs(batches):
            a, b = forest(ids, comp, wide, left, right, limits.wide)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    pairs = cells(rows).mapInArrow(run, "a long, b long")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


#: The two blocks of texts that a pair belongs to.
MEETING = ["family_a", "block_a", "family_b", "block_b"]


def open_pairs(rows: DataFrame, limits: Limits) -> DataFrame:
    """(*MEETING, pairs): all pairs of different components within the distance, packed as 64-bit ids.

    ``rows`` has key, id, component, sig, wide, family and block.  A pair comes once, under its first shared key.
    """
    chunk_of = limits.chunk_of()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, ids, comp, wide, left, right in cell_runs(batches):
            sig, key, found = unpack(t.column("sig")), t.column("key")[0].as_py(), []
            for r in right.tolist():
                some = left[comp[left] != comp[r]]
                some = some[(wide[some] != wide[r]).sum(1) <= limits.wide]
                if len(some):
                    some = some[chunk_keys(sig[r:r + 1], chunk_of)[0][first_shared(sig[some] != sig[r], chunk_of)] == key]
                    found.append(np.stack([np.full(len(some), r), some], 1))
            pairs = np.concatenate(found) if found else np.zeros((0, 2), int)
            if not len(pairs):
                continue
            home = np.stack([t.column("family").to_numpy(), t.column("block").to_numpy().astype(np.int64)], 1)
            # The lesser home first; pairs of one meeting travel together.
            swap = (home[pairs[:, 0], 0] > home[pairs[:, 1], 0]) | ((home[pairs[:, 0], 0] == home[pairs[:, 1], 0])
                                                                   & (home[pairs[:, 0], 1] > home[pairs[:, 1], 1]))
            pairs[swap] = pairs[swap][:, ::-1]
            met, of = np.unique(np.concatenate([home[pairs[:, 0]], home[pairs[:, 1]]], 1), axis=0, return_inverse=True)
            of = of.ravel()
            order = np.argsort(of, kind="stable")
            packed = [ids[pairs[own]].astype("<i8").tobytes() for own in np.split(order, np.flatnonzero(np.diff(of[order])) + 1)]
            columns = [pa.array(met[:, k]) for k in range(4)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(packed, pa.binary())], [*MEETING, "pairs"])

    schema = "family_a long, block_a long, family_b long, block_b long, pairs binary"
    return cells(rows).mapInArrow(run, schema)


def confirmed_forest(packed: DataFrame, homes: DataFrame, texts: DataFrame, limits: Limits) -> DataFrame:
    """Links (a, b) that connect what the ``packed`` pairs connect on full shingle sets; ``homes`` has id, family and block."""
    packed = stage(packed, "minhash-packed")
    sides = (packed.select(*MEETING).distinct()
             .select(*MEETING, F.explode(F.array_distinct(F.array(
                 F.struct(F.col("family_a").alias("family"), F.col("block_a").alias("block")),
                 F.struct(F.col("family_b").alias("family"), F.col("block_b").alias("block"))))).alias("side"))
             .select(*MEETING, "side.family", "side.block"))
    held = (sides.join(homes, ["family", "block"]).join(texts, "id")
            .select(*MEETING, F.lit(0).alias("kind"), "id", "text", F.lit(None).cast("binary").alias("pairs")))
    asked = packed.select(*MEETING, F.lit(1).alias("kind"), F.lit(None).cast("long").alias("id"), F.lit(None).cast("string").alias("text"), "pairs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, MEETING):
            a, b = linked(t.column("id").to_pylist(), t.column("text").to_pylist(), [p for p in t.column("pairs").to_pylist() if p], limits)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return held.union(asked).repartition(*MEETING).sortWithinPartitions(*MEETING, "kind").mapInArrow(run, "a long, b long")


def linked(ids: list, texts: list, packed: list[bytes], limits: Limits) -> tuple[list[int], list[int]]:
    """A forest of the packed pairs that reach the threshold."""
    if not packed:
        return [], []
    pairs = np.unique(np.frombuffer(b"".join(packed), "<i8").reshape(-1, 2), axis=0)
    wanted = set(pairs.ravel().tolist())
    sets = {i: shingles(text) for i, text in zip(ids, texts) if i in wanted}
    # Shingles numbered within the block: one row of flags then gives a text's overlap with any other.
    sizes = [len(x) for x in sets.values()]
    number = np.unique(np.concatenate(list(sets.values())), return_inverse=True)[1].ravel()
    local = dict(zip(sets, np.split(number, np.cumsum(sizes)[:-1])))
    flags, root = np.zeros(int(number.max(initial=0)) + 1, bool), {}

    def top(x: int) -> int:
        while root.get(x, x) != x:
            root[x] = x = root.get(root[x], root[x])
        return x

    out_a, out_b, marked = [], [], None
    for a, b in pairs.tolist():
        x, y = top(a), top(b)
        if x == y:
            continue
        if a != marked:
            if marked is not None:
                flags[local[marked]] = False
            flags[local[a]] = True
            marked = a
        shared = int(flags[local[b]].sum())
        if 100 * shared >= limits.percent * (len(local[a]) + len(local[b]) - shared):
            root[x] = y
            out_a.append(a)
            out_b.append(b)
    return out_a, out_b


def mixed_rows(shared: DataFrame, labels: DataFrame, classes: DataFrame, share: int = 1) -> DataFrame:
    """Rows (key, id, component, sig, wide, family, block) of the keys that hold several components; of every ``share``-th key of a signature."""
    grouped = labels.withColumnRenamed("node", "id")
    held = stage(shared.where(F.col("slot") % share == 0).select("key", "id").join(grouped, "id", "left")
                 .withColumn("component", F.coalesce("component", "id")), "minhash-held")
    mixed = (held.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
             .where("low <> high").select("key"))
    return held.join(mixed, "key").join(classes.select("id", "sig", "wide", "family", "block"), "id")


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The components (node, component) of settled ``labels`` with new ``links``, which they replace."""
    links = stage(links, "minhash-links")
    if links.isEmpty():
        return labels
    stars = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return connected_components(stars.union(links.select("a", "b")), "minhash-components")


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, component, component_id, kept) per row; component tells groups of one least id apart."""
    limits = Limits.of(percent)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sigs = stage(signatures(source), "minhash-signatures")
    classes = stage(sigs.where("n_shingles > 0 and doc_id is not null").groupBy("set_a", "set_b")
                    .agg(F.min(F.struct("doc_id", "sig", "wide")).alias("least"), F.min("n_shingles").alias("n_shingles"))
                    .select("set_a", "set_b", F.monotonically_increasing_id().alias("id"), F.col("least.doc_id").alias("first"),
                            "n_shingles", F.col("least.sig").alias("sig"), F.col("least.wide").alias("wide")), "minhash-classes")
    keyed = index(classes, limits)
    stars = keyed.groupBy("key").agg(F.min("id").alias("least"), F.count("*").alias("n")).where("n > 1")
    shared = stage(keyed.join(stars.drop("n"), "key"), "minhash-shared")
    # Texts of the classes that share a key with another: all that any confirmation below reads.
    met = shared.select("id").distinct().join(classes.select("id", "first", "set_a", "set_b"), "id")
    texts = stage(own_texts(source.join(met, source["doc_id"] == met["first"]).dropDuplicates(["doc_id", "id", "text"])),
                  "minhash-texts")

    star = shared.where("id <> least").groupBy("id").agg(F.min("least").alias("a")).withColumnRenamed("id", "b")
    # A class is at home with the smallest class it meets; a family's blocks are bounded in rows and in bytes of their sets.
    lone = shared.select("id").distinct().join(star.withColumnRenamed("b", "id"), "id", "left").withColumn("family", F.coalesce("a", "id"))
    met_classes = lone.select("id", "family").join(classes.select("id", "n_shingles", "sig", "wide"), "id")
    sizes = met_classes.groupBy("family").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).alias("h"))
    homed = stage(met_classes.join(sizes, "family").withColumn("block", F.pmod(F.xxhash64("id"), F.col("h"))).drop("h"), "minhash-homes")
    components = connected_components(confirmed(near(star.select("a", "b"), classes, limits), texts, limits), "minhash-components")
    for share in ROUNDS:
        new = forest_pairs(mixed_rows(shared, components, homed, share), limits)
        components = joined(components, confirmed(new, texts, limits))
    left = open_pairs(mixed_rows(shared, components, homed), limits)
    components = joined(components, confirmed_forest(left, homed.select("id", "family", "block"), texts, limits))
    of_set = (classes.select("set_a", "set_b", "id", "first")
              .join(components.withColumnRenamed("node", "id"), "id", "left")
              .withColumn("component", F.coalesce("component", "id")))
    least = of_set.groupBy("component").agg(F.min("first").alias("least"))
    of_set = of_set.join(least, "component").select("set_a", "set_b", "component", "least")
    return (sigs.join(of_set, ["set_a", "set_b"], "left")
            .select("doc_id", "n_shingles", "set_a", "set_b", "component",
                    F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("least"))
                    .otherwise(F.col("doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """Query op4: (doc_id, n_shingles, component_id, kept) per row."""
    return judged(docs, id_col, text_col, percent).select("doc_id", "n_shingles", "component_id", "kept")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = STAGE_PERCENT) -> DataFrame:
    """One row of ``docs`` per near-duplicate group, all columns unchanged (the pipeline's stage).

    The row of the group's smallest id stays; of the group's rows that repeat this id one
    stays, that of the least shingle set and hash.  An id's texts of different groups are
    judged each, and so are its texts without words.  Rows without an id all stay.
    """
    cols = docs.columns
    kept = (judged(docs, id_col, text_col, percent).where("kept and doc_id is not null").groupBy("doc_id", "component")
            .agg(F.min(F.struct("set_a", "set_b")).alias("least"))
            .select(F.col("doc_id").alias("id"), "least.set_a", "least.set_b"))
    held = docs.where(F.col(id_col).cast("long").isNotNull()).select(
        F.struct(*[docs[c] for c in cols]).alias("row"), docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ends = b"".join(set_digest(shingles(t)) for t in batch.column(2).to_pylist())
        pair = np.frombuffer(ends, "<i8").reshape(-1, 2)
        return pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(pair[:, 0].copy()), pa.array(pair[:, 1].copy())],
                                          ["row", "id", "set_a", "set_b"])

    schema = f"row {held.schema['row'].dataType.simpleString()}, id long, set_a long, set_b long"
    named = (map_rows(held, run, schema).join(kept, ["id", "set_a", "set_b"])
             .groupBy("id", "set_a", "set_b").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row.*"))
    return named.unionByName(docs.where(F.col(id_col).cast("long").isNull())).select(*cols)
