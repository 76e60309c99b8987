"""Quality rules: word and line statistics, and zstandard compression bands.

Repetitive text compresses too well and random text too badly.  A document is
compressed whole, and again in fixed chunks so that a bad passage cannot hide in
(nor a long document be judged only by) its total; the last chunk ends with the text.
What is usual depends on the length, so the band of the whole ratio is a curve over
the UTF-8 length.  The lower limit is half of what ordinary English prose has at that
length: legal and technical texts with recurring phrases, and scripts of several bytes
a letter, lie between.  The upper limit is that of English prose (license texts, cut to the
length) plus about 0.07: from 2 KB on it lies below random letters (0.58 to 0.60), from 5 KB below
hexadecimal words (0.52 to 0.53), from 40 KB below random numbers (0.46); shorter ones cannot be told
from names, lists and short texts.  Scripts of several bytes a letter have more chance in a
byte left by the coder, so texts of ``WIDE_BYTES`` bytes a character or more have limits of their own,
below random ideographs and base64 (0.75).

Defined results: NULL or empty text has no words, ratio NULL, and fails the base
rule; text of any length is read whole; repeated rows are judged each; an empty table gives no rows;
other columns, whatever their names, are not read.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroflux.llm.common import map_rows

#: Fixed values of the base rule.
MIN_WORDS, MAX_REPEAT_PERCENT, SYMBOLS, SPACES = 50, 50, "#*$%&|<>", " \t\n\v\f\r"
LEVEL, CHUNK_BYTES = 3, 2048
#: Whole-document ratio by log2 of the length in bytes: knots, lowest and highest allowed ratio.
LENGTH_LOG2 = (7.0, 8.0, 9.0, 9.5, 10.0, 10.5, 11.0, 12.0, 13.0, 14.0, 15.0, 17.0)
LOWEST = (0.400, 0.350, 0.300, 0.280, 0.260, 0.250, 0.240, 0.215, 0.200, 0.185, 0.175, 0.165)
HIGHEST = (1.100, 0.850, 0.750, 0.710, 0.685, 0.655, 0.590, 0.545, 0.500, 0.475, 0.455, 0.430)
HIGHEST_WIDE = (1.100, 0.900, 0.820, 0.780, 0.750, 0.720, 0.700, 0.660, 0.630, 0.610, 0.590, 0.570)
WIDE_BYTES = 1.5
#: A chunk's band, and the share of chunks that may lie outside it.
CHUNK_LOWEST, CHUNK_HIGHEST, CHUNKS_OUT = 0.24, 0.73, 0.1

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "ratio double, n_chunks long, n_chunks_out long")


@functools.lru_cache(maxsize=1)
def compressor() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found twice or more."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    # Pairs are renumbered first, so the code of three stays below 2**63 at any vocabulary.
    _, pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)
    _, window, found = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    again = found[window] > 1
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k:len(words) - 2 + k] |= again
    return int(covered.sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


def measure(text: str | None) -> tuple:
    if not text:
        return 0, 0, 0, 0, 0, None, 0, 0
    raw = text.encode()
    words = raw.split()  # bytes split at exactly \x20 and \x09-\x0D
    pack = compressor().compress
    starts = [*range(0, len(raw) - CHUNK_BYTES + 1, CHUNK_BYTES)]
    if starts and len(raw) % CHUNK_BYTES:
        starts.append(len(raw) - CHUNK_BYTES)
    out = sum(not CHUNK_LOWEST <= len(pack(raw[i:i + CHUNK_BYTES])) / CHUNK_BYTES <= CHUNK_HIGHEST for i in starts)
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
            duplicate_lines(text), repeated_words(words), len(pack(raw)) / len(raw), len(starts), out)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of measures per document; a single pass without a shuffle."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      F.octet_length(F.col(text_col).cast("string")).cast("long").alias("n_bytes"),
                      F.length(F.col(text_col).cast("string")).cast("long").alias("n_points"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        cols = zip(*map(measure, batch.column(1).to_pylist()))
        types = [pa.int64()] * 5 + [pa.float64()] + [pa.int64()] * 2
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types)), *batch.columns[2:]],
            [c.split()[0] for c in SCHEMA.split(", ")] + ["n_bytes", "n_points"])

    return map_rows(src, run, SCHEMA + ", n_bytes long, n_points long")


def band(knots: tuple, values: tuple, x: F.Column) -> F.Column:
    """Linear interpolation between knots, level beyond them."""
    out = F.lit(values[-1])
    for (a, b), (u, v) in reversed(list(zip(zip(knots, knots[1:]), zip(values, values[1:])))):
        out = F.when(x < b, F.lit(u) + (x - a) * ((v - u) / (b - a))).otherwise(out)
    return F.when(x < knots[0], F.lit(values[0])).otherwise(out)


def judge(stats: DataFrame) -> DataFrame:
    """Adds base_failed, the band's limits and kept."""
    x = F.log2(F.greatest(F.col("n_bytes"), F.lit(1)))
    wide = F.col("n_bytes") >= WIDE_BYTES * F.col("n_points")
    return (stats
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
            .withColumn("lowest", band(LENGTH_LOG2, LOWEST, x)).withColumn(
                "highest", F.when(wide, band(LENGTH_LOG2, HIGHEST_WIDE, x)).otherwise(band(LENGTH_LOG2, HIGHEST, x)))
            .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("ratio").between(F.col("lowest"), F.col("highest")), F.lit(False))
                        & (F.col("n_chunks_out") <= CHUNKS_OUT * F.col("n_chunks"))))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Query op5: measures and verdict per document."""
    return judge(statistics(docs, id_col, text_col)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "ratio", "n_chunks", "n_chunks_out")


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is kept, all columns unchanged (the pipeline's stage).

    The verdict is computed beside each row, so no key is needed and repeated
    rows or NULL ids stay as they are.
    """
    cols = docs.columns
    held = docs.select(F.struct(*[docs[c] for c in cols]).alias("row"), docs[text_col].cast("string").alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).to_pylist()
        rows = [(len((t or "").encode()), *measure(t), len(t or "")) for t in texts]
        pick = lambda k, t: pa.array([r[k] for r in rows], t)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pick(0, pa.int64()), pick(1, pa.int64()), pick(5, pa.int64()), pick(6, pa.float64()),
             pick(7, pa.int64()), pick(8, pa.int64()), pick(9, pa.int64())],
            ["row", "n_bytes", "n_words", "n_repeat_words", "ratio", "n_chunks", "n_chunks_out", "n_points"])

    schema = (f"row {held.schema['row'].dataType.simpleString()}, n_bytes long, n_words long, n_repeat_words long, "
              "ratio double, n_chunks long, n_chunks_out long, n_points long")
    return judge(map_rows(held, run, schema)).where("kept").select("row.*")
