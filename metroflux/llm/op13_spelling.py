"""Spelling variants of one edit, grouped under their most frequent form, by pivotal grams.

Bigrams are ordered from rare to frequent over the vocabulary.  A word's prefix are
its ``PREFIX`` rarest bigrams with all that tie with the last of them; two disjoint
ones among them are its pivots.  One edit breaks at most one of two disjoint
bigrams, and of two near words the one whose prefix ends at the rarer bigram has
all its surviving pivots in the other's prefix.  So each pair is found by looking
up one word's pivots among the other's prefix.

The position limits follow from where the edit is.  With pivots p < q, either it
lies at q or behind, and all before q is equal and stands at the same place from
the start; or at p or before, and all behind p stands at the same place from the
end; or between, and both sides are equal.  What must be equal is part of the key, so
a word has three keys as pivots, and a few per place of its prefix as partner.
Dynamic programming along the word picks the two pivots whose keys are expected to
be rarest, by the bigram frequencies.  The table of bigrams is bounded by the
alphabet (90 letters, 8,100 bigrams).

Candidates are verified inside the join by their edit distance; pairs found under
several keys are merged.  No pair is dropped, so links are exact.  Roots are found
by doubling: each form is at least ten times as frequent as the word before, so
chains have at most log10 of the largest count.

Defined results: NULL and empty texts have no words; a NULL document id counts as
empty text before the colon; repeated rows count each; among equally frequent forms the
first in code-point order is taken; an empty table gives no rows; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroflux.llm.common import map_rows, stage

LEAST, OCCURRENCES, RATIO = 7, 2, 10
#: Bigrams of a prefix: at least 3, of which two are disjoint; more make the pivots rarer and the partners' keys more.
PREFIX = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", noise: bool = True) -> DataFrame:
    """(word, n): runs of letters of at least ``LEAST`` code points that occur at least ``OCCURRENCES`` times.

    With ``noise``, a run whose crc32 with its document id is divisible by 31 first loses one code point.
    """
    lower = F.translate(F.col(text_col).cast("string"), UPPER, LOWER)
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(lower, F.lit(f"[a-zÀ-ÿ]{{{LEAST},}}"), 0)).alias("run"))
    if noise:
        h, run = F.col("h"), F.col("run")
        at = (h % F.length(run)).cast("int")
        runs = (runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
                .select(F.when(h % 31 == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run))))
                        .otherwise(run).alias("run")).where(F.length("run") >= LEAST))
    return runs.groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n")).where(F.col("n") >= OCCURRENCES)


def gram_counts(words: DataFrame) -> dict[str, int]:
    """How often each bigram stands in the words; a space stands for both ends.  At most a few thousand entries."""
    whole = F.concat(F.lit(" "), F.col("word"), F.lit(" "))
    grams = F.transform(F.sequence(F.lit(1), F.length("word") + 1), lambda i: F.substring(whole, i, F.lit(2)))
    return {r[0]: r[1] for r in words.select(F.explode(grams).alias("gram")).groupBy("gram").agg(F.count("*").alias("n")).collect()}


class Grams:
    """Ranks of bigrams from rare to frequent, and how likely a text is by them."""

    def __init__(self, counts: dict[str, int]):
        inner = sorted((n, g) for g, n in counts.items() if " " not in g)
        self.rank = {g: k for k, (_, g) in enumerate(inner)}
        ahead, behind = {}, {}
        for g, n in counts.items():
            ahead[g[0]] = ahead.get(g[0], 0) + n
            behind[g[1]] = behind.get(g[1], 0) + n
        self.forward = {g: math.log(n / ahead[g[0]]) for g, n in counts.items()}
        self.backward = {g: math.log(n / behind[g[1]]) for g, n in counts.items()}

    def prefix(self, word: str) -> tuple[int, list[int]]:
        """The rank at which the word's prefix ends, and the places of its bigrams."""
        ranks = [self.rank[word[i:i + 2]] for i in range(len(word) - 1)]
        last = sorted(ranks)[min(PREFIX, len(ranks)) - 1]
        return last, [i for i, r in enumerate(ranks) if r <= last]

    def pivots(self, word: str, places: list[int]) -> tuple[int, int]:
        """The two disjoint places of least expected matches: what stands before the second, and behind the first."""
        n = len(word)
        before, after = [0.0] * (n + 1), [0.0] * (n + 1)  # log likelihood of word[:i], word[i:]
        whole = f" {word} "
        for i in range(n):
            before[i + 1] = before[i] + self.forward[whole[i:i + 2]]
        for i in range(n, 0, -1):
            after[i - 1] = after[i] + self.backward[whole[i:i + 2]]
        best, least, first, of_first, waiting = (places[0], places[-1]), math.inf, -1, math.inf, 0
        for q in places:
            while places[waiting] + 2 <= q:  # the best first pivot among those that end before q
                p = places[waiting]
                cost = math.exp(after[p + 2])
                if cost < of_first:
                    first, of_first = p, cost
                waiting += 1
            if first >= 0 and of_first + math.exp(before[q]) < least:
                best, least = (first, q), of_first + math.exp(before[q])
        return best


def pivot_keys(word: str, p: int, q: int) -> list[str]:
    return ["<" + word[:q], ">" + word[p + 2:], "=" + word[:p + 2] + " " + word[q:]]


def partner_keys(word: str, places: list[int]) -> list[str]:
    """The keys under which a word can hold another's surviving pivots, one of them at one of its places."""
    return ([f"<{word[:q]}" for q in range(places[0] + 2, len(word))] + [f">{word[p:]}" for p in range(1, places[-1] + 1)]
            + [f"={word[:p + 2]} {word[q:]}" for p in places for q in places if q >= p + 2])


def keyed(words: DataFrame, grams: Grams, keys_of: Callable[[Grams, str, list[int]], list[str]]) -> DataFrame:
    """(key, word, n, last) rows: the word's keys as 64-bit hashes, and the rank at which its prefix ends."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, lasts, of = [], [], []
        for i, word in enumerate(batch.column(0).to_pylist()):
            last, places = grams.prefix(word)
            found = keys_of(grams, word, places)
            keys += [xxhash.xxh3_64_intdigest(k) for k in found]
            of.append(len(found))
            lasts.append(last)
        at = np.repeat(np.arange(len(of)), of)
        return pa.RecordBatch.from_arrays([pa.array(np.array(keys, np.uint64).view(np.int64)), batch.column(0).take(pa.array(at)),
                                           batch.column(1).take(pa.array(at)), pa.array(np.array(lasts, np.int32)[at])],
                                          ["key", "word", "n", "last"])

    return map_rows(words.select("word", "n"), run, "key long, word string, n long, last int", rows=2048)


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, other, other_n): every ordered pair of words of distance one; ``words`` has word and n, each word once."""
    grams = Grams(gram_counts(words))
    pivots = keyed(words, grams, lambda g, w, places: pivot_keys(w, *g.pivots(w, places))).select(
        "key", F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("last").alias("a_last"))
    partners = keyed(words, grams, lambda g, w, places: partner_keys(w, places)).select(
        "key", F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("last").alias("b_last"))
    a, b = F.col("a"), F.col("b")
    found = (pivots.join(partners, (pivots["key"] == partners["key"])
                         & ((F.col("a_last") < F.col("b_last")) | ((F.col("a_last") == F.col("b_last")) & (a < b)))
                         & (F.abs(F.length(a) - F.length(b)) <= 1) & (F.levenshtein(a, b, 1) == 1))
             .select("a", "a_n", "b", "b_n").dropDuplicates(["a", "b"]))
    return found.select(F.explode(F.array(
        F.struct(a.alias("word"), b.alias("other"), F.col("b_n").alias("other_n")),
        F.struct(b.alias("word"), a.alias("other"), F.col("a_n").alias("other_n")))).alias("pair")).select("pair.*")


def roots(forms: DataFrame, most: int) -> DataFrame:
    """(word, root) of the words that have a form: the last one reached by following forms.  ``most`` is the largest count."""
    at = stage(forms.select("word", F.col("form").alias("root")), "spelling-forms")
    chain = max(1, math.ceil(math.log(max(most, 1), RATIO)))
    for _ in range(math.ceil(math.log2(chain))):
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        at = stage(at.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "spelling-roots")
    return at


def variants(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of a vocabulary (word, n)."""
    best = (near_pairs(words).groupBy("word")
            .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("minus"), F.col("other"))).alias("best")))
    form = F.when(-F.col("best.minus") >= RATIO * F.col("n"), F.col("best"))
    found = stage(words.join(best, "word", "left")
                  .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), form["other"].alias("form"),
                          (-form["minus"]).alias("form_n")), "spelling-found")
    most = found.agg(F.max("n")).first()[0] or 1
    return (found.join(roots(found.where("form is not null"), most), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def spelling_variants(docs: DataFrame) -> DataFrame:
    """Query op13: the variants of the whole texts' words."""
    return variants(stage(vocabulary(docs), "spelling-words"))
