"""BPE encoding and decoding by speculation and verification.

A word is first cut greedily into its longest vocabulary entries.  BPE yields
exactly those tokens when every token is what BPE makes of its own characters
and no adjacent pair would have been joined across its border while the two
tokens were being built.  Both conditions are tested with array operations over
all new words of a batch at once; only words that fail are merged step by step.

The text pipeline is that of ``word_bpe_49k.json``: special tokens are cut out of
the raw text, the rest is NFC-normalised and lower-cased, split into words
(white space dropped), and the last byte of each word carries ``</w>``.  No rule
looks across white space, so each white-space-free chunk is encoded on its own
and remembered in a bounded per-worker table.

Defined results: NULL text is empty (no ids, decoded ''); texts of any length
are encoded whole; an unknown id raises.
"""

from __future__ import annotations

import functools
import heapq
import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroflux.llm.common import map_rows, tokenizer_path
from metroflux.llm.tokens import byte_characters

VOCABULARY = "word_bpe_49k.json"
#: Entries of the per-worker chunk table (emptied when full) and longest chunk kept in it.
TABLE_ENTRIES = 400_000
TABLE_CHUNK = 64
NEVER = np.iinfo(np.int64).max
#: The vocabulary's word pattern, with white space as Unicode's White_Space.
SPACE = r"\t-\r \x85\xa0  -     　"
WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")
NOT_SPACE = regex.compile(rf"[^{SPACE}]+")
#: Characters from here on are normalised and split by the library, whose Unicode tables decide.
LIBRARY_FROM = "ɐ"
RARE = regex.compile(rf"[{LIBRARY_FROM}-\U0010ffff]")
CONTROL = regex.compile(r"[\x1c-\x1f]")


class IntTable:
    """A fixed map from non-negative integers to integers with array lookups (open addressing)."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(len(keys)).bit_length() + 2)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, -1, np.int64)
        left, at = np.arange(len(keys)), self.slot(keys)
        while len(left):
            free = np.flatnonzero(self.keys[at] == -1)
            slots, first = np.unique(at[free], return_index=True)
            placed = free[first]
            self.keys[slots], self.values[slots] = keys[left[placed]], values[left[placed]]
            rest = np.ones(len(left), bool)
            rest[placed] = False
            left, at = left[rest], (at[rest] + 1) & (len(self.keys) - 1)

    def slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, key: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where there is none."""
        at = self.slot(key)
        there = self.keys[at]
        out = np.where(there == key, self.values[at], -1)
        live = np.flatnonzero((there != key) & (there != -1))
        at = at[live]
        while len(live):
            at = (at + 1) & (len(self.keys) - 1)
            there = self.keys[at]
            hit = there == key[live]
            out[live[hit]] = self.values[at[hit]]
            go = ~hit & (there != -1)
            live, at = live[go], at[go]
        return out


class WordBpe:
    """Tables of one vocabulary, with encoding of words (bytes) and decoding of ids."""

    #: The symbol after a word's last byte, and the longest word merged by rows of a matrix.
    END, ROW = 256, 48

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.library = Tokenizer.from_file(path)
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.strings: list[str | None] = [None] * size
        for s, i in {**vocab, **self.special}.items():
            self.strings[i] = s
        self.special_cut = (regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
                            if self.special else None)
        self.byte_of = {c: b for b, c in enumerate(byte_characters())}

        # Trie of the entries' bytes; a final entry ends with END.  Edges: node << 9 | symbol -> node.
        edges: dict[int, int] = {}
        token_at = [-1]
        for s, i in vocab.items():
            final = s.endswith(suffix)
            node = 0
            for c in [*(self.byte_of[c] for c in (s[:-len(suffix)] if final else s)), *[self.END] * final]:
                key = node << 9 | c
                if key not in edges:
                    edges[key] = len(token_at)
                    token_at.append(-1)
                node = edges[key]
            token_at[node] = i
        self.trie = IntTable(np.array(list(edges), np.int64), np.array(list(edges.values()), np.int64))
        self.token_at = np.array(token_at, np.int64)
        root = [token_at[edges[b]] for b in range(256)]
        self.inner = np.array(root, np.int64)
        self.final = np.array([token_at[edges[edges[b] << 9 | self.END]] for b in range(256)], np.int64)

        merges: dict[int, int] = {}
        self.made = np.full(size, -1, np.int64)
        self.left, self.right = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.product = np.zeros(len(spec["model"]["merges"]), np.int64)
        odd = np.zeros(size, bool)
        for rank, (x, y) in enumerate(spec["model"]["merges"]):
            a, b, t = vocab[x], vocab[y], vocab[x + y]
            if a << 32 | b in merges:
                continue
            merges[a << 32 | b], self.product[rank] = rank, t
            # More than one way to a token, or parts made after it: left to exact merging.
            odd[t] |= self.made[t] >= 0 or max(self.made[a], self.made[b]) >= rank
            self.made[t], self.left[t], self.right[t] = rank, a, b
        self.merges = merges
        self.pairs = IntTable(np.array(list(merges), np.int64), np.array(list(merges.values()), np.int64))
        # A token holds when its parts hold and its own last merge is the first to cross their border.
        tokens = np.argsort(self.made, kind="stable")
        tokens = tokens[self.made[tokens] >= 0]
        crossing = np.zeros(size, bool)
        crossing[tokens] = self.apart(self.left[tokens], self.right[tokens], self.made[tokens])
        self.sound = ~odd
        for t in tokens.tolist():
            self.sound[t] &= crossing[t] and self.sound[self.left[t]] and self.sound[self.right[t]]

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        rank = self.pairs.get(a << 32 | b)
        return np.where(rank < 0, NEVER, rank)

    def apart(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge (of a rank under ``before``) joins a and b across their border.

        Walks back in time: the later of the two tokens' last merges is undone
        (the right one on a tie, as equal merges run from left to right), and the
        parts then at the border must not have had an earlier merge.
        """
        ok = np.ones(len(a), bool)
        live = np.arange(len(a))
        a, b = a.astype(np.int64), b.astype(np.int64)
        limit = np.full(len(a), NEVER) if before is None else before.astype(np.int64)
        while len(live):
            joined = self.rank_of(a, b) < limit
            ok[live[joined]] = False
            of_a, of_b = self.made[a], self.made[b]
            keep = ~joined & (np.maximum(of_a, of_b) >= 0)
            live, a, b, of_a, of_b = live[keep], a[keep], b[keep], of_a[keep], of_b[keep]
            undo_b = of_b >= of_a
            limit = np.where(undo_b, of_b + 1, of_a)
            a, b = np.where(undo_b, a, self.right[a]), np.where(undo_b, self.left[b], b)
        return ok

    def propose(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match of all words at once: the tokens and the word of each.

        ``text`` holds each word's bytes followed by END (at ``ends``).
        """
        n = len(text)
        word_end = np.repeat(ends, ends - starts + 1)
        length, token = np.zeros(n, np.int64), np.full(n, -1, np.int64)
        live = np.flatnonzero(text != self.END)
        node, depth = np.zeros(len(live), np.int64), 0
        while len(live):
            at = live + depth
            inside = at <= word_end[live]
            live, node, at = live[inside], node[inside], at[inside]
            node = self.trie.get(node << 9 | text[at])
            go = node >= 0
            live, node, at = live[go], node[go], at[go]
            depth += 1
            here = self.token_at[node]
            # An entry may not stop just before END: the last byte's token is a final one.
            hit = (here >= 0) & (at + 1 != word_end[live])
            length[live[hit]], token[live[hit]] = depth, here[hit]
        marked = np.zeros(n, bool)
        at, stop = starts.copy(), ends
        while len(at):
            marked[at] = True
            at = at + length[at]
            more = at < stop
            at, stop = at[more], stop[more]
        cut = np.flatnonzero(marked)
        return token[cut], np.searchsorted(starts, cut, side="right") - 1

    def merge(self, word: bytes) -> list[int]:
        """Exact merging of one word: the lowest rank first, leftmost first, with a heap over a linked list."""
        ids = [int(self.inner[c]) for c in word[:-1]] + [int(self.final[word[-1]])]
        n, rank = len(ids), self.merges.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.product[r]), -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank(ids[i] << 32 | ids[k])) is not None:
                    heapq.heappush(heap, (r, i, ids[i], ids[k]))
            if (p := before[i]) >= 0 and (r := rank(ids[p] << 32 | ids[i])) is not None:
                heapq.heappush(heap, (r, p, ids[p], ids[i]))
        return [t for t in ids if t >= 0]

    def merge_rows(self, ids: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Exact merging of many words, one per row of ``ids`` (padded with -1); lengths are updated in place."""
        rows, width = ids.shape
        at = np.arange(width)

        def ranks(a, b):
            r = np.full(len(a), NEVER)
            both = np.flatnonzero((a >= 0) & (b >= 0))
            r[both] = self.rank_of(a[both], b[both])
            return r

        rank = np.full((rows, width), NEVER)
        rank[:, :-1] = ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(rows, width - 1)
        live = np.arange(rows)
        while len(live):
            here = rank[live]
            j = here.argmin(axis=1)
            least = here[np.arange(len(live)), j]
            go = least < NEVER
            live, j, least, here = live[go], j[go], least[go], here[go]
            if not len(live):
                break
            # Drop the column after j, put the product at j, and rank its two new pairs.
            take = np.minimum(at + (at > j[:, None]), width - 1)
            own = np.take_along_axis(ids[live], take, 1)
            own[:, -1] = -1
            one = np.arange(len(live))
            own[one, j] = self.product[least]
            take = np.minimum(at + (at >= j[:, None]), width - 1)
            here = np.take_along_axis(here, take, 1)
            here[:, -1] = NEVER
            here[one, j] = ranks(own[one, j], own[one, np.minimum(j + 1, width - 1)])
            here[one[j == width - 1], width - 1] = NEVER
            prior = np.flatnonzero(j > 0)
            here[prior, j[prior] - 1] = ranks(own[prior, j[prior] - 1], own[prior, j[prior]])
            ids[live], rank[live] = own, here
            length[live] -= 1
        return ids

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids (as bytes) of each word: proposals, one check of all adjacent pairs, exact merging of failures."""
        if not words:
            return []
        size = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
        ends = starts + size
        text = np.full(int(ends[-1]) + 1, self.END, np.int64)
        bytewise = np.ones(len(text), bool)
        bytewise[ends] = False
        text[bytewise] = np.frombuffer(b"".join(words), np.uint8)
        flat, owner = self.propose(text, starts, ends)
        failed = np.zeros(len(words), bool)
        failed[owner[~self.sound[flat]]] = True
        if len(flat) > 1:
            inside = np.flatnonzero(owner[1:] == owner[:-1])
            pairs, where = np.unique(flat[inside] << 32 | flat[inside + 1], return_inverse=True)
            fits = self.apart(pairs >> 32, pairs & 0xFFFFFFFF)
            failed[owner[inside[~fits[where]]]] = True
        buffer = flat.astype("<u4").tobytes()
        bounds = (np.searchsorted(owner, np.arange(len(words) + 1)) * 4).tolist()
        out = [buffer[a:b] for a, b in zip(bounds, bounds[1:])]
        bad = np.flatnonzero(failed)
        for low, high in ((1, 8), (9, 16), (17, self.ROW)):
            some = bad[(size[bad] >= low) & (size[bad] <= high)]
            if not len(some):
                continue
            at = np.arange(high)
            there = at < size[some, None]
            symbols = text[np.where(there, starts[some, None] + at, 0)]
            ids = np.where(there, self.inner[np.where(there, symbols, 0)], -1)
            last = size[some] - 1
            ids[np.arange(len(some)), last] = self.final[text[ends[some] - 1]]
            length = size[some].copy()
            ids = self.merge_rows(ids, length).astype("<u4")
            buffer = ids.tobytes()
            for k, i, n in zip(range(0, len(buffer), 4 * high), some.tolist(), length.tolist()):
                out[i] = buffer[k:k + 4 * n]
        for i in bad[size[bad] > self.ROW].tolist():
            out[i] = np.array(self.merge(words[i]), "<u4").tobytes()
        return out

    def words_of(self, chunk: str) -> list[bytes]:
        """Words of a chunk without white space or special tokens, in UTF-8."""
        if not chunk.isascii():
            if RARE.search(chunk):
                clean = self.library.normalizer.normalize_str(chunk)
                return [bytes(map(self.byte_of.__getitem__, w))
                        for w, _ in self.library.pre_tokenizer.pre_tokenize_str(clean)]
            chunk = unicodedata.normalize("NFC", chunk)
        chunk = chunk.lower()
        return [chunk.encode()] if chunk.isalpha() else [w.encode() for w in WORD.findall(chunk)]

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each white-space-free chunk."""
        parts: list[list] = []  # per chunk: ids of special tokens and words in order
        for chunk in chunks:
            if self.special_cut and "<|" in chunk:
                row: list = []
                for piece in self.special_cut.split(chunk):
                    row.extend([self.special[piece]] if piece in self.special else self.words_of(piece) if piece else [])
                parts.append(row)
            else:
                parts.append(self.words_of(chunk))
        words = list({x for row in parts for x in row if type(x) is bytes})
        coded = dict(zip(words, self.encode_words(words)))
        coded.update((i, i.to_bytes(4, "little")) for i in self.special.values())
        return [coded[row[0]] if len(row) == 1 else b"".join([coded[x] for x in row]) for row in parts]


class Encoder:
    """Encodes texts through a bounded table of chunks already encoded."""

    def __init__(self, bpe: WordBpe, entries: int = TABLE_ENTRIES):
        self.bpe, self.entries, self.table = bpe, entries, {}

    @staticmethod
    def chunks(text: str) -> list[str]:
        """White-space-free chunks; lower-cased at once where neither normalisation nor special tokens may matter."""
        if not (RARE.search(text) or "<|" in text):
            text = text.lower()
        return NOT_SPACE.findall(text) if CONTROL.search(text) else text.split()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        split = [self.chunks(t) if t else [] for t in texts]
        if len(self.table) > self.entries:
            self.table = {}
        known = self.table
        new = list(set().union(*split).difference(known)) if split else []
        coded = dict(zip(new, self.bpe.encode_chunks(new)))
        if any(len(c) > TABLE_CHUNK for c in new):
            both = known | coded
            known.update((c, x) for c, x in coded.items() if len(c) <= TABLE_CHUNK)
            known = both
        else:
            known.update(coded)
        return [b"".join(map(known.__getitem__, chunks)) for chunks in split]

    def decode(self, ids: bytes) -> str:
        """Token strings joined by one space: what a vocabulary without a decoder gives, special tokens kept."""
        return " ".join(map(self.bpe.strings.__getitem__, memoryview(ids).cast("I")))


@functools.lru_cache(maxsize=4)
def encoder(vocabulary: str) -> Encoder:
    """The worker's encoder of a vocabulary, built once."""
    return Encoder(WordBpe(tokenizer_path(vocabulary)))


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text",
           decode: bool = False) -> DataFrame:
    """(doc_id, ids[, decoded]) per row: ids as little-endian unsigned 32-bit integers in a binary column.

    One pass without a shuffle; repeated rows are encoded each.  ``decode=True``
    also decodes the ids in the same pass.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        enc = encoder(vocabulary)
        ids = enc.encode(batch.column(1).to_pylist())
        out = [batch.column(0), pa.array(ids, pa.binary())]
        if decode:
            out.append(pa.array([enc.decode(x) for x in ids], pa.string()))
        return pa.RecordBatch.from_arrays(out, ["doc_id", "ids", "decoded"][:len(out)])

    return map_rows(src, run, "doc_id long, ids binary" + ", decoded string" * decode, rows=256)


def decode(coded: DataFrame, vocabulary: str = VOCABULARY, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, decoded) of a binary id column; NULL ids decode to ''."""
    src = coded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        enc = encoder(vocabulary)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([enc.decode(x or b"") for x in batch.column(1).to_pylist()], pa.string())],
            ["doc_id", "decoded"])

    return map_rows(src, run, "doc_id long, decoded string", rows=256)


def digests(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Query op2: token count and digests of the ids and of the text decoded from them."""
    return encode(docs, vocabulary, decode=True).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
