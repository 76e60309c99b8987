"""Ids of byte-level BPE texts, as the tokenizers library gives them, through a bounded table of chunks.

The vocabulary's split never puts a space that precedes a non-space character
anywhere but at the start of a piece, and makes a line break between two
non-space characters a piece of its own.  So a text may be cut at both, and
equal chunks need encoding only once.  Where the vocabulary's merges are its
ids in order, unknown chunks go to tiktoken built from the same file, which
gives the same ids in a fraction of the time; otherwise, and for texts that hold
a special token's string, to the tokenizers library.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

from metroflux.llm.common import tokenizer_path, worker_table

VOCABULARY = "byte_bpe_50k.json"
TABLE_ENTRIES = 100_000
TABLE_CHUNK = 64
CUT = re.compile(r" (?=\S)")
#: First character of a key: text as it stands; a word after a line break.  Other keys are words after a space (both without
#: white space or control characters, so they sort above a space).
RAW, BREAK = "\x01", "\n"


def byte_characters() -> list[str]:
    """The printable stand-in of each byte: itself where printable, else the next free one from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(free)) for b in range(256)]


class ChunkEncoder:
    """``specials``: whether a special token's string in a text becomes its id (the library's default)."""

    def __init__(self, path: str, specials: bool = True, entries: int = TABLE_ENTRIES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = not specials
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = [t["content"] for t in spec["added_tokens"]] if specials else []
        self.whole = re.compile("|".join(map(re.escape, special))) if special else None
        self.entries, self.table = entries, {}
        self.line_break = np.array(self.library.encode("\n", add_special_tokens=False).ids, "<u4").tobytes()
        self.quick = self._quick(spec)

    @staticmethod
    def _quick(spec: dict):
        """tiktoken's encoder of the same vocabulary, if its ids are the order of its merges."""
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        if (spec["pre_tokenizer"] != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
                or spec["normalizer"] or any(vocab.get(a + b) != 256 + k for k, (a, b) in enumerate(merges))):
            return None
        import public_tokenizers
        import tiktoken
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        ranks = {bytes(byte_of[c] for c in s): i for s, i in vocab.items() if i < 256 + len(merges)}
        return tiktoken.Encoding("chunks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _encode(self, texts: list[str]) -> list[bytes]:
        if self.quick:
            return [np.array(self.quick.encode_ordinary(t), "<u4").tobytes() for t in texts]
        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _encode_keys(self, keys: list[str]) -> dict[str, bytes]:
        """Ids of each key's text; words go to the encoder as one text, joined by line breaks, as do the first words of lines."""
        words = [k for k in keys if k > " "]
        marked = [k for k in keys if k < " "]
        first = [k for k in marked if k[0] == BREAK]
        raw = [k for k in marked if k[0] == RAW]
        out = dict(zip(raw, self._encode([k[1:] for k in raw])))
        if len(self.line_break) == 4:
            if words:
                buffer, ends = self._line_breaks(" " + "\n ".join(words))
                out.update((w, buffer[a + 4:b]) for w, a, b in zip(words, [-4, *ends], [*ends, len(buffer)]))
            if first:
                # These keys begin with their line break, and so do their ids.
                buffer, starts = self._line_breaks("".join(first))
                out.update((k, buffer[a:b]) for k, a, b in zip(first, starts, [*starts[1:], len(buffer)]))
        else:
            out.update(zip(words, self._encode([" " + w for w in words])))
            out.update((k, self.line_break + x) for k, x in zip(first, self._encode([k[1:] for k in first])))
        return out

    def _line_breaks(self, text: str) -> tuple[bytes, list[int]]:
        """The text's ids and the byte offset of each line break among them."""
        buffer = self._encode([text])[0]
        at = np.flatnonzero(np.frombuffer(buffer, "<u4") == np.frombuffer(self.line_break, "<u4")[0])
        return buffer, (4 * at).tolist()

    @staticmethod
    def keys(text: str) -> list[str]:
        """Keys of the text's chunks in order."""
        # A text that starts with a space and a word, as those cut from a longer one do, has no raw start.
        out: list[str] = []
        led = text[:1] == " "
        mark = "" if led else RAW
        for line in text[led:].split("\n"):
            if not line or line[0] == " " or line[-1] == " " or "  " in line or not line.isprintable():
                first, *rest = CUT.split(text)
                return [RAW + first, *[c if " " not in c and c.isprintable() else RAW + " " + c for c in rest]]
            parts = line.split(" ")
            parts[0] = mark + parts[0]
            out += parts
            mark = BREAK
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text (None: empty)."""
        split = [[] if not t or (self.whole and self.whole.search(t)) else self.keys(t) for t in texts]
        if len(self.table) > self.entries:
            self.table = {}
        new = self._encode_keys(list(set().union(*split).difference(self.table)))
        self.table.update(new)
        out = [b"".join(map(self.table.__getitem__, s)) if s else self._whole(t) if t else b""
               for t, s in zip(texts, split)]
        # Long chunks seldom come again: they are held for this call only.
        for key in new:
            if len(key) > TABLE_CHUNK:
                del self.table[key]
        return out


def encoder(vocabulary: str, specials: bool = True) -> ChunkEncoder:
    """The worker's encoder of a vocabulary, built once."""
    return worker_table(("encoder", vocabulary, specials), lambda: ChunkEncoder(tokenizer_path(vocabulary), specials))
