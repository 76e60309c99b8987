"""Edit-aware token counts: a segment tree of pre-token runs per document.

A document's leaves are runs of pre-tokens; each tree node holds the characters
and tokens below it.  An edit finds its leaves by descending the character sums,
re-encodes only the text of the leaves it touches (and a neighbour where the
edit moved a pre-token border), and updates the sums on the paths to the root.

Leaves start at a space that a non-space follows, where the vocabulary's split
always has a border, so leaf counts add up to the count of the whole text.
Special tokens' strings count as ordinary text.

Defined results: NULL text is empty (0 tokens, no leaves); edits are applied in
array order, each in the coordinates left by the one before; positions and
lengths beyond the text are clipped; NULL edits or NULL fields change nothing (a
NULL insertion inserts nothing); texts and edits of any length are handled whole; repeated
rows are counted each; an empty table gives no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroflux.llm import tokens
from metroflux.llm.common import map_rows

#: Characters after which a leaf is closed at the next border.
LEAF_CHARS = 256
#: A leaf that an edit makes longer than so many of them is cut again at its borders.
LARGE = 2
TREE = "leaf_chars array<int>, leaf_tokens array<int>"
EDITS = "array<struct<at:bigint,remove:bigint,insert:string>>"


def leaf_starts(text: str, size: int = LEAF_CHARS) -> list[int]:
    """Start of each leaf: 0, then the first border at least ``size`` characters after the last start."""
    starts, at = [0] if text else [], 0
    while (m := tokens.CUT.search(text, at + size)) is not None:
        at = m.start()
        starts.append(at)
    return starts


def starts_leaf(text: str) -> bool:
    return tokens.CUT.match(text) is not None


class SegmentTree:
    """Character and token sums over the leaves, in arrays of a power of two; leaf i sits at ``width + i``."""

    def __init__(self, chars: list[int], counts: list[int]):
        self.leaves = len(chars)
        self.width = 1 << max(0, (self.leaves - 1).bit_length())
        self.chars = [0] * self.width + chars + [0] * (self.width - self.leaves)
        self.counts = [0] * self.width + counts + [0] * (self.width - self.leaves)
        for i in range(self.width - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.counts[i] = self.counts[2 * i] + self.counts[2 * i + 1]

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at`` (the last one with text for the end) and its start."""
        i, start = 1, 0
        at = min(at, self.chars[1] - 1)
        while i < self.width:
            i *= 2
            if at - start >= self.chars[i]:
                start += self.chars[i]
                i += 1
        return i - self.width, start

    def put(self, leaf: int, chars: int, count: int) -> None:
        i = self.width + leaf
        self.chars[i], self.counts[i] = chars, count
        while i > 1:
            i //= 2
            self._sum(i)


class Document:
    """A text with its tree; ``encode`` gives the token counts of texts."""

    def __init__(self, text: str, chars: list[int], counts: list[int], encode):
        self.tree, self.encode, self.reencoded = SegmentTree(chars, counts), encode, 0
        self.parts, at = [], 0
        for n in chars:
            self.parts.append(text[at:at + n])
            at += n

    def edit(self, at: int, remove: int, insert: str) -> None:
        """Replace ``remove`` characters at ``at`` by ``insert``, re-encoding only what that touches."""
        edit_all([(self, at, remove, insert)], self.encode)

    def touch(self, at: int, remove: int, insert: str) -> tuple[int, int, list[str]] | None:
        """First and last leaf that the edit touches and the texts to be put in their place; None if it changes nothing."""
        total = self.tree.chars[1] if self.parts else 0
        at = min(max(at, 0), total)
        stop = min(at + max(remove, 0), total)
        if stop == at and not insert:
            return None
        if not total:
            self.parts, self.tree = [""], SegmentTree([0], [0])
            first, start, last, last_start = 0, 0, 0, 0
        else:
            first, start = self.tree.find(at)
            last, last_start = self.tree.find(max(at, stop - 1))
        head = self.parts[first][:at - start]
        text = head + insert + self.parts[last][stop - last_start:]
        # Boundary context: the text must start at a border, else it joins the leaf with text before it.
        while first and not starts_leaf(text):
            first -= 1
            text = self.parts[first] + text
        self.reencoded += len(text)
        return first, last, _cut(text) if len(text) > LARGE * LEAF_CHARS else [text]

    def put(self, first: int, last: int, pieces: list[str], counts: list[int]) -> None:
        """Put ``pieces``, with their token counts, in the place of the leaves ``first`` to ``last``."""
        if len(pieces) > last - first + 1:
            # More leaves than the edit freed: the tree is built anew, empty ones left out.
            rows = [(p, n) for p, n in zip(self.parts, self.tree.counts[self.tree.width:])]
            rows[first:last + 1] = zip(pieces, counts)
            rows = [(p, n) for p, n in rows if p]
            self.parts = [p for p, _ in rows]
            self.tree = SegmentTree([len(p) for p in self.parts], [n for _, n in rows])
            return
        for leaf in range(first, last + 1):
            k = leaf - first
            self.parts[leaf] = pieces[k] if k < len(pieces) else ""
            self.tree.put(leaf, len(self.parts[leaf]), counts[k] if k < len(pieces) else 0)

    @property
    def count(self) -> int:
        return self.tree.counts[1] if self.parts else 0

    @property
    def text(self) -> str:
        return "".join(self.parts)


def edit_all(edits: list[tuple[Document, int, int, str]], encode) -> None:
    """One edit of each of many documents; all that they touch is encoded in one call."""
    touched = [(d, t) for d, *e in edits if (t := d.touch(*e)) is not None]
    counts = iter(encode([p for _, (_, _, pieces) in touched for p in pieces]) if touched else ())
    for d, (first, last, pieces) in touched:
        d.put(first, last, pieces, [next(counts) for _ in pieces])


def _counter(vocabulary: str):
    encoder = tokens.encoder(vocabulary, False)
    return lambda texts: [len(x) // 4 for x in encoder.encode(texts)]


def _cut(text: str) -> list[str]:
    starts = leaf_starts(text)
    return [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)])]


def build(docs: DataFrame, vocabulary: str = tokens.VOCABULARY, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(doc_id, text, leaf_chars, leaf_tokens): the tree's leaves, to be kept beside each text."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        leaves = [_cut(t or "") for t in batch.column(1).to_pylist()]
        counts = iter(_counter(vocabulary)([x for row in leaves for x in row]))
        ints = pa.list_(pa.int32())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([[len(x) for x in row] for row in leaves], ints),
             pa.array([[next(counts) for _ in row] for row in leaves], ints)],
            ["doc_id", "text", "leaf_chars", "leaf_tokens"])

    return map_rows(src, run, f"doc_id long, text string, {TREE}", rows=256)


def apply_edits(trees: DataFrame, vocabulary: str = tokens.VOCABULARY) -> DataFrame:
    """(doc_id, text, tree, n_tokens_before, n_tokens, reencoded_chars) after each row's ``edits``.

    ``trees`` has the columns of ``build`` and edits (array of at, remove,
    insert).  The tree of the result is that of the edited text, so edits can go on from it.
    """
    src = trees.select("doc_id", "text", "leaf_chars", "leaf_tokens", F.col("edits").cast(EDITS).alias("edits"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        count, rows = _counter(vocabulary), []
        ids, texts, chars, counts, scripts = (c.to_pylist() for c in batch.columns)
        docs = [Document(t or "", c or [], n or [], count) for t, c, n in zip(texts, chars, counts)]
        before = [d.count for d in docs]
        scripts = [(d, [e for e in edits or [] if e is not None and e["at"] is not None and e["remove"] is not None])
                   for d, edits in zip(docs, scripts)]
        # The rows' first edits together, then their second ones, and so on.
        k = 0
        while scripts := [(d, edits) for d, edits in scripts if k < len(edits)]:
            edit_all([(d, edits[k]["at"], edits[k]["remove"], edits[k]["insert"] or "") for d, edits in scripts], count)
            k += 1
        for doc, d, n in zip(ids, docs, before):
            kept = [i for i, p in enumerate(d.parts) if p]
            rows.append((doc, d.text, [len(d.parts[i]) for i in kept],
                         [d.tree.counts[d.tree.width + i] for i in kept], n, d.count, d.reencoded))
        ints, long = pa.list_(pa.int32()), pa.int64()
        types = [long, pa.string(), ints, ints, long, long, long]
        names = ["doc_id", "text", "leaf_chars", "leaf_tokens", "n_tokens_before", "n_tokens", "reencoded_chars"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return map_rows(src, run, f"doc_id long, text string, {TREE}, n_tokens_before long, n_tokens long, "
                              "reencoded_chars long", rows=256)


def revisions(trees: DataFrame) -> DataFrame:
    """Adds the edit scripts of a revision: a replacement, a deletion and an insertion placed by the id's hash.

    The stand-in for an edit log, which the tables do not have; it makes ``edits`` and nothing else.
    """
    place = lambda k: F.pmod(F.xxhash64(F.col("doc_id"), F.lit(k)), F.length(F.coalesce("text", F.lit(""))) + 1)
    edit = lambda at, remove, insert: F.struct(at.alias("at"), F.lit(remove).cast("bigint").alias("remove"), F.lit(insert).alias("insert"))
    return trees.withColumn("edits", F.array(edit(place(1), 7, "revised"), edit(place(2), 25, ""),
                                             edit(place(3), 0, " a new sentence.")))


def counts(docs: DataFrame, vocabulary: str = tokens.VOCABULARY) -> DataFrame:
    """Query op7: tokens of every text before and after its revision, with the edited text's digest."""
    return apply_edits(revisions(build(docs, vocabulary)), vocabulary).select(
        "doc_id", "n_tokens_before", "n_tokens", "reencoded_chars",
        F.length("text").cast("long").alias("n_chars"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"))
