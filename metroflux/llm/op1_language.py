"""Language identification with a blended-spectrum string kernel.

The kernel of two texts counts the character n-grams (lengths 1 to ``LONGEST``)
that occur in both, presence only, divided by the geometric mean of their own
counts.  It is approximated by Nystroem landmarks: a text is described by its
kernel values with ``LANDMARKS`` sampled texts, and one-versus-rest kernel ridge
regression on them gives a score per language.  Prediction is a matrix product of
a batch's n-gram presence with the landmarks', and one more with the weights.

Learning reads only text and language of labelled rows outside the held-out fold
(crc32 of the id's text modulo ``FOLDS`` is 0); a bounded sample of about
``SAMPLE`` rows, spread evenly over the languages, is enough and is a parameter.
Whole texts are read in learning and prediction.

Defined results: a text that is NULL or has no letter is ``und`` with score 0; a
NULL id is not held out and not learned from; repeated rows are predicted each;
without any labelled row all texts are ``und``.  Equal scores: first language in
alphabetical order.  An empty table gives no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import functools
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metroflux.llm.common import map_rows

LONGEST, FOLDS = 3, 5
SAMPLE, LANDMARKS, RIDGE = 4000, 192, 1e-3
UNDETERMINED = "und"
#: n-grams are numbered by a hash of so many bits.
BITS = 20
#: The pipeline's stage rejects texts whose best language scores less.
LEAST_SCORE = 0.3
PLACES = np.random.default_rng(11).integers(0, 2**64, (LONGEST, LONGEST), dtype=np.uint64) | np.uint64(1)


class Model(NamedTuple):
    languages: list[str]
    column: np.ndarray  # n-gram number -> column of presence, or their count
    presence: np.ndarray  # n-grams x landmarks, divided by the root of each landmark's count
    weights: np.ndarray  # landmarks x languages
    bias: np.ndarray


@functools.lru_cache(maxsize=1)
def letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str | None) -> np.ndarray | None:
    """Numbers of the n-grams of a text, repeats included; None without a letter.

    Lower-cased; whatever is not a letter counts as a space, and a space is added at both ends.
    """
    c = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le"), "<u4")
    letter = letters()[c]
    if not letter.any():
        return None
    c = np.where(letter, c, 32).astype(np.uint64)
    out = []
    for n in range(1, LONGEST + 1):
        total = c[:len(c) - n + 1] * PLACES[n - 1, 0]
        for k in range(1, n):
            total = total + c[k:len(c) - n + 1 + k] * PLACES[n - 1, k]
        total ^= total >> np.uint64(29)
        out.append((total * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS))
    return np.concatenate(out).astype(np.int32)


class Presence:
    """Distinct n-grams of texts, with one reused table of flags."""

    def __init__(self):
        self.flags = np.zeros(1 << BITS, bool)

    def distinct(self, text: str | None) -> np.ndarray | None:
        g = grams(text)
        if g is None:
            return None
        self.flags[g] = True
        out = np.flatnonzero(self.flags)
        self.flags[out] = False
        return out


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def kernel(rows: list[np.ndarray | None], column: np.ndarray, presence: np.ndarray) -> np.ndarray:
    """Normalised kernel values of texts (their distinct n-grams; None: zeros) with the landmarks."""
    x = np.zeros((len(rows), presence.shape[0] + 1), np.float32)
    size = np.ones(len(rows), np.float32)
    for i, g in enumerate(rows):
        if g is not None:
            x[i, column[g]] = 1
            size[i] = len(g)
    return (x[:, :-1] @ presence) / np.sqrt(size)[:, None]


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample: int = SAMPLE, landmarks: int = LANDMARKS) -> Model:
    """Learn from labelled rows outside the held-out fold.

    The sample takes about sample / languages rows of each language by a hash of the id, without a
    shuffle; its texts stay on the executors, which return n-gram numbers of the landmarks and kernel
    values of the sample.
    """
    spark = docs.sparkSession
    src = (docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang"))
           .where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()
                  & ~held_out(F.col("doc_id"))))
    count = {r["lang"]: r["n"] for r in src.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(count)
    if not languages:
        return Model([], np.zeros(1 << BITS, np.int32), np.zeros((0, 0), np.float32), np.zeros((0, 0)), np.zeros(0))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31)) / float(1 << 31)
    shares = spark.createDataFrame([(k, sample / len(count) / n, landmarks / len(count) / n) for k, n in count.items()],
                                   "lang string, share double, landmark_share double")
    taken = (src.join(F.broadcast(shares), "lang").withColumn("place", place).where("place < share")
             .select("lang", "text", (F.col("place") < F.col("landmark_share")).alias("landmark")))

    def numbers(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = Presence()
        rows = [found.distinct(t) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([None if g is None else g.tobytes() for g in rows], pa.binary())],
                                          ["lang", "grams"])

    marks = [np.frombuffer(bytes(r["grams"]), np.int64) for r in
             map_rows(taken.where("landmark").select("lang", "text"), numbers, "lang string, grams binary").collect()
             if r["grams"] is not None]
    known = np.unique(np.concatenate(marks)) if marks else np.zeros(0, np.int64)
    column = np.full(1 << BITS, len(known), np.int32)
    column[known] = np.arange(len(known))
    presence = np.zeros((len(known), len(marks)), np.float32)
    for j, g in enumerate(marks):
        presence[column[g], j] = 1 / np.sqrt(len(g))
    shared = spark.sparkContext.broadcast((column, presence))

    def values(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = Presence()
        k = kernel([found.distinct(t) for t in batch.column(1).to_pylist()], *shared.value)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in k], pa.binary())], ["lang", "values"])

    rows = map_rows(taken.select("lang", "text"), values, "lang string, values binary", rows=64).collect()
    k = np.array([np.frombuffer(bytes(r["values"]), np.float32) for r in rows], np.float64).reshape(len(rows), len(marks))
    y = np.where(np.array([r["lang"] for r in rows])[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    # Nystroem features: kernel values times the inverse root of the landmarks' own kernel.
    own = np.array([[presence[:, j].astype(np.float64) @ presence[:, i] for i in range(len(marks))] for j in range(len(marks))])
    values_, vectors = np.linalg.eigh(own.reshape(len(marks), len(marks)))
    keep = values_ > 1e-8 * max(values_.max(initial=0), 1e-12)
    root = vectors[:, keep] / np.sqrt(values_[keep])
    phi = k @ root
    mean, level = phi.mean(0), y.mean(0)
    centred = phi - mean
    solved = np.linalg.solve(centred.T @ centred + RIDGE * len(rows) * np.eye(centred.shape[1]), centred.T @ (y - level))
    return Model(languages, column, presence, root @ solved, level - mean @ solved)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row.  The model is broadcast: landmarks times their n-grams."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        best, score = classify(batch.column(1).to_pylist(), shared.value)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(best), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return (map_rows(src, run, "doc_id long, lang_pred string, score double", rows=64)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"))


def classify(texts: list[str | None], model: Model) -> tuple[list[str], list[float]]:
    """Language and score (the decision value from -1..1 carried to 0..1) of each text."""
    found = Presence()
    rows = [found.distinct(t) for t in texts]
    if not model.languages:
        return [UNDETERMINED] * len(texts), [0.0] * len(texts)
    decision = kernel(rows, model.column, model.presence) @ model.weights + model.bias
    best = decision.argmax(1)
    score = np.clip((decision[np.arange(len(rows)), best] + 1) / 2, 0, 1)
    return ([UNDETERMINED if g is None else model.languages[b] for g, b in zip(rows, best)],
            [0.0 if g is None else float(s) for g, s in zip(rows, score)])


def identify(docs: DataFrame) -> DataFrame:
    """Query op1: learn on the rows outside the held-out fold and predict all."""
    return predict(docs, fit(docs))


def keep_identified(docs: DataFrame, text_col: str = "text", least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` whose text has a language, all columns unchanged (the pipeline's stage).

    Rejected: no letter, or no language that scores ``least``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs))
    held = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[text_col].cast("string").alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        best, score = classify(batch.column(1).to_pylist(), shared.value)
        keep = [b != UNDETERMINED and s >= least for b, s in zip(best, score)]
        return pa.RecordBatch.from_arrays([batch.column(0)], ["row"]).filter(pa.array(keep, pa.bool_()))

    return map_rows(held, run, f"row {held.schema['row'].dataType.simpleString()}", rows=64).select("row.*")
