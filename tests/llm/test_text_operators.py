"""Language ID, BPE, packing, quality rules and token counts on small inputs."""

import hashlib
import pathlib
import random
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from metroflux.llm import op1_language, op2_bpe, op3_packing, op5_quality, op7_token_counts, tokens
from metroflux.llm.common import read_table
from tests.conftest import SMOKE
from tests.llm.helpers import EN, FR, clashing, empty_documents, odd_documents


@pytest.fixture(scope="module")
def docs(spark):
    return read_table(spark, SMOKE, "documents").unionByName(odd_documents(spark))


def texts(df):
    return [(r.doc_id, r.text or "") for r in df.collect()]


def test_bpe_equals_the_library(spark, docs):
    t = Tokenizer.from_file(public_tokenizers.path(op2_bpe.VOCABULARY))
    t.no_truncation()
    t.no_padding()
    want = Counter()
    for i, text in texts(docs):
        ids = t.encode(text, add_special_tokens=False).ids
        back = t.decode(ids, skip_special_tokens=False)
        want[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
             hashlib.sha256(back.encode()).hexdigest()] += 1
    got = Counter(tuple(r) for r in op2_bpe.digests(clashing(docs, "ids", "decoded")).collect())
    assert got == want


def test_bpe_words_equal_exact_merging():
    bpe = op2_bpe.encoder(op2_bpe.VOCABULARY).bpe
    rng = np.random.default_rng(2)
    parts = [s[:-4].encode() for s in bpe.strings if s and s.endswith("</w>") and s.isascii()]
    words = [b"".join(parts[k] for k in rng.integers(0, len(parts), rng.integers(1, 7))) for _ in range(3000)]
    for word, ids in zip(words, bpe.encode_words(words)):
        assert np.frombuffer(ids, "<u4").tolist() == bpe.merge(word)


def test_bpe_round_trip_of_ids(spark, docs):
    coded = op2_bpe.encode(docs)
    back = op2_bpe.decode(coded).count()
    assert back == docs.count() and op2_bpe.encode(empty_documents(spark)).count() == 0


def test_chunked_ids_equal_the_library(docs):
    enc = tokens.encoder(tokens.VOCABULARY)
    many = [t for _, t in texts(docs)] + ["a  b", " a", "a \n b", "x\n\ny", "é  z", "it's <|endoftext|>  ok", "\t\tq "]
    for text, ids in zip(many, enc.encode(many)):
        assert np.frombuffer(ids, "<u4").tolist() == enc.library.encode(text, add_special_tokens=False).ids


def test_plan_packs_every_item_once_and_tightly():
    rng = np.random.default_rng(3)
    for cap in (12, 100, 2048):
        sizes = Counter(np.minimum(cap, 1 + rng.exponential(cap * rng.choice([.1, .4]), 800).astype(int)).tolist())
        bins, seen = defaultdict(list), Counter()
        for size, first, items, per, bin_, at in op3_packing.plan(sizes, cap):
            assert first == seen[size]
            seen[size] += items
            for k in range(items):
                bins[bin_ + k // per].append((at + k % per * size, size))
        assert seen == sizes
        for parts in bins.values():
            end = 0
            for at, size in sorted(parts):
                assert at == end
                end += size
            assert end <= cap
        least = -(-sum(s * n for s, n in sizes.items()) // cap)
        assert len(bins) <= 1.25 * least + 1


def test_large_items_pair_at_most_twice():
    runs = op3_packing.plan({700: 3, 1000: 2, 1400: 1, 1: 5}, 2048)
    per_bin = Counter()
    for size, _, items, per, first, _ in runs:
        for k in range(items):
            per_bin[first + k // per] += 3 * size > 2048
    assert max(per_bin.values()) == 2


def test_packing_covers_all_pieces(spark, docs):
    got = op3_packing.pack(clashing(docs, "length", "bucket", "rank", "size")).collect()
    enc = Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY))
    want = Counter()
    for i, text in texts(docs):
        ids = np.array([*enc.encode(text, add_special_tokens=False).ids, 0], "<u4")
        for k, (start, n) in enumerate(op3_packing.cut_pieces(len(ids))):
            want[i, k, start, n, zlib.crc32(ids[start:start + n].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        end = 0
        for at, n in sorted(parts):
            assert at == end
            end += n
        assert end <= 2048
    assert op3_packing.pack(empty_documents(spark)).count() == 0


def test_packed_sequences_hold_the_ids(spark):
    docs = odd_documents(spark)
    seqs = op3_packing.sequences(docs).collect()
    total = sum(r.length for r in op3_packing.pieces(docs).collect())
    assert sum(len(r.ids) // 4 for r in seqs) == total and max(len(r.ids) // 4 for r in seqs) <= 2048


def brute_quality(text):
    import re
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    found = Counter(zip(words, words[1:], words[2:]))
    covered = {k + d for k in range(len(words) - 2) if found[tuple(words[k:k + 3])] > 1 for d in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def test_quality_base_equals_brute_force(spark, docs):
    docs = docs.unionByName(spark.createDataFrame(
        [(100, "a b c\na b c\n\n x | y # z w \x0b q a b c", "en", "s", 1), (101, "p q", "en", "s", 1)], docs.schema))
    want = Counter((r.doc_id, *brute_quality(r.text)) for r in docs.collect())
    rows = op5_quality.quality(clashing(docs, "ratio", "kept")).collect()
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows)
    assert got == want and not any(r.kept and r.base_failed for r in rows)


def test_quality_rejects_repetitive_and_random_text(spark):
    rng = np.random.default_rng(1)
    noise = " ".join("".join(map(chr, rng.integers(33, 127, 9))) for _ in range(900))
    prose = " ".join("".join(rng.choice(["an", "er", "th", "ou", "st", "in", "re", "ly"], rng.integers(1, 5))) for _ in range(900))
    near_same = " ".join(f"limited offer{k} today" for k in range(400))
    rows = spark.createDataFrame([(1, noise), (2, prose), (3, near_same), (4, None)], "doc_id long, text string")
    kept = {r.doc_id: r.kept for r in op5_quality.quality(rows).collect()}
    assert (kept[1], kept[3], kept[4]) == (False, False, False) and 2 in kept
    assert op5_quality.keep_good(empty_documents(spark)).count() == 0


def test_quality_bands_decide_on_each_kind_of_chance(spark):
    rng = random.Random(1)
    letters = lambda n: " ".join("".join(rng.choices(string.ascii_lowercase, k=rng.randint(3, 9))) for _ in range(n // 7))
    bad = {1: letters(3000), 2: letters(40_000), 3: " ".join("%016x" % rng.getrandbits(64) for _ in range(1200)),
           4: " ".join(str(rng.randint(0, 10**9)) for _ in range(6000)), 5: " ".join("".join(rng.choices(string.printable[:62] + "+/", k=60)) for _ in range(80)),
           6: " ".join("".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(12)) for _ in range(200)),
           7: "\n".join(f"2026-01-01 00:00:{k % 60:02d} INFO server started step {k}" for k in range(500))}
    syllables = {8: ["ка", "но", "ро", "сти", "пере", "ли", "во", "ть"], 9: ["an", "er", "th", "ou", "st", "in", "re", "ly", "é", "ç"]}
    good = {k: " ".join("".join(rng.choices(v, k=rng.randint(1, 4))) for _ in range(1500)) for k, v in syllables.items()}
    rows = spark.createDataFrame([*bad.items(), *good.items()], "doc_id long, text string")
    got = {r.doc_id: (r.base_failed, r.kept) for r in op5_quality.quality(rows).collect()}
    assert not any(got[k][0] for k in range(1, 7)) and [got[k][1] for k in range(1, 8)] == [False] * 7
    assert [got[k][1] for k in good] == [True, True]
    assert sorted(r.doc_id for r in op5_quality.keep_good(rows).collect()) == [8, 9]


NATURAL = sorted({p.resolve() for p in pathlib.Path("/usr/share/common-licenses").glob("*") if p.resolve().stat().st_size > 3000})


@pytest.mark.skipif(not NATURAL, reason="no English files on this machine")
def test_quality_keeps_natural_texts(spark):
    rows = [(k, p.read_text()) for k, p in enumerate(NATURAL)]
    rows += [(1000 * (j + 1) + k, t[:n]) for j, n in enumerate((1200, 2500, 5000)) for k, t in rows]
    got = op5_quality.quality(spark.createDataFrame(rows, "doc_id long, text string")).where("not base_failed").collect()
    assert len(got) > 2 * len(NATURAL) and [(r.doc_id, r.ratio) for r in got if not r.kept] == []


@pytest.mark.skipif(not NATURAL, reason="no English files on this machine")
def test_quality_finds_a_bad_passage_anywhere(spark):
    rng = np.random.default_rng(2)
    noise = "".join(map(chr, rng.integers(33, 127, 2000)))
    good = NATURAL[0].read_text()[:8192]
    rows = [(1, good + noise), (2, noise + good), (3, good[:4096] + noise + good[4096:]), (4, good), (5, good[:5000])]
    out = {r.doc_id: r for r in op5_quality.quality(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [out[k].kept for k in range(1, 6)] == [False, False, False, True, True]
    assert out[1].n_chunks == 5 and out[5].n_chunks == 3 and out[4].n_chunks == 4


def test_language_accuracy_on_the_held_out_fold(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    got = op1_language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.where("lang = lang_pred").count() / got.count() > 0.98
    folds = got.select("doc_id").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in folds)


def test_language_of_odd_texts(spark):
    docs = odd_documents(spark, [(20 + k, (EN if k % 2 else FR) * 2 + f"{k}", "en" if k % 2 else "fr", "s", 1) for k in range(40)]
                         + [(99, "12 34 !!", "en", "s", 1)])
    model = op1_language.fit(docs, sample=400, landmarks=40)
    got = op1_language.predict(clashing(docs, "score", "held_out"), model).collect()
    by = defaultdict(list)
    for r in got:
        assert 0 <= r.score <= 1
        by[r.doc_id].append(r)
    assert all(by[i][0].lang_pred == "und" and by[i][0].score == 0 for i in (2, 3, 4, 99))
    assert len(by[7]) == 2 and by[6][0].lang_pred == "fr" and by[1][0].lang_pred == "en" and by[None][0].held_out is False
    none = op1_language.identify(docs.withColumn("lang", F.lit(None).cast("string"))).select("lang_pred").distinct().collect()
    assert [r.lang_pred for r in none] == ["und"]
    assert op1_language.identify(empty_documents(spark)).count() == 0


def test_edited_counts_equal_a_full_count():
    enc = tokens.encoder(tokens.VOCABULARY, False)
    count = op7_token_counts._counter(tokens.VOCABULARY)
    rng = np.random.default_rng(5)
    bits = ["the", "ing", " ", "  ", "\n", "é", "...", "'s", "12", "<|endoftext|>", "\t", "word "]
    for _ in range(150):
        text = "".join(rng.choice(bits, rng.integers(0, 700)))
        leaves = op7_token_counts._cut(text)
        doc = op7_token_counts.Document(text, list(map(len, leaves)), count(leaves) if leaves else [], count)
        for _ in range(5):
            at, drop, put = int(rng.integers(0, len(text) + 2)), int(rng.choice([0, 1, 9, 900])), str(rng.choice(["", " x", "abc", "\n"]))
            doc.edit(at, drop, put)
            at = min(at, len(text))
            text = text[:at] + put + text[at + drop:]
            assert doc.text == text
            assert doc.count == len(enc.library.encode(text, add_special_tokens=False).ids)


def test_a_large_insertion_is_cut_into_leaves_again():
    count = op7_token_counts._counter(tokens.VOCABULARY)
    text = "some words of a text " * 200
    leaves = op7_token_counts._cut(text)
    doc = op7_token_counts.Document(text, list(map(len, leaves)), count(leaves), count)
    big = "an insertion of many words " * 10_000
    doc.edit(1000, 0, big)
    text = text[:1000] + big + text[1000:]
    before = doc.reencoded
    for k in range(50):
        doc.edit(5000 * k, 3, "xyz")
        text = text[:5000 * k] + "xyz" + text[5000 * k + 3:]
    assert doc.text == text and doc.reencoded - before < 50 * 4 * op7_token_counts.LEAF_CHARS
    assert max(map(len, doc.parts)) <= 2 * op7_token_counts.LARGE * op7_token_counts.LEAF_CHARS
    assert doc.count == len(tokens.encoder(tokens.VOCABULARY, False).library.encode(text, add_special_tokens=False).ids)


def recorded(monkeypatch):
    """An encoder of its own and the list of texts that it hands on to the vocabulary's encoder."""
    enc, seen = tokens.ChunkEncoder(tokens.tokenizer_path(tokens.VOCABULARY), False), []
    encode = enc._encode
    monkeypatch.setattr(enc, "_encode", lambda texts: seen.extend(texts) or encode(texts))
    return enc, seen


def test_words_of_leaves_and_lines_are_encoded_together(monkeypatch):
    enc, seen = recorded(monkeypatch)
    rng = np.random.default_rng(11)
    many = [" ".join("".join(rng.choice(list("abcdeé,"), rng.integers(1, 9))) + ("\n" if k % 9 == 0 else "") for k in range(900))
            .replace("\n ", "\n") for _ in range(4)]
    leaves = [x for t in many for x in op7_token_counts._cut(t)]
    assert len(leaves) > 40 and sum(x[0] == " " for x in leaves) == len(leaves) - 4
    for text, ids in zip(leaves, enc.encode(leaves)):
        assert np.frombuffer(ids, "<u4").tolist() == enc.library.encode(text, add_special_tokens=False).ids
    # The words, the first words of lines, and the start of each whole text.
    assert len(seen) <= 2 + 4
    # Text off the plain form is cut at its borders; its plain words are still encoded together.
    seen.clear()
    enc.encode(["\ta  b " + " ".join(f"x{k}" for k in range(500))])
    assert len(seen) <= 3


def test_ids_of_odd_chunks_equal_the_library():
    enc = tokens.encoder(tokens.VOCABULARY, False)
    rng = np.random.default_rng(12)
    bits = ["a", "word", "é", "'s", "12", "...", " ", " ", " x", "  ", "\n", "\n\n", "\t", "\u00a0", "\u3000", "\u200b", "\x01", "\x1c",
            "中文", "z" * 70, "<|endoftext|>", "\r\n"]
    many = ["".join(rng.choice(bits, rng.integers(1, 14))) for _ in range(4000)]
    for text, ids in zip(many, enc.encode(many)):
        assert np.frombuffer(ids, "<u4").tolist() == enc.library.encode(text, add_special_tokens=False).ids
    assert all(len(k) <= tokens.TABLE_CHUNK for k in enc.table)


def test_rows_edits_are_encoded_together():
    count, calls = op7_token_counts._counter(tokens.VOCABULARY), []

    def encode(texts):
        calls.append(len(texts))
        return count(texts)

    def documents():
        for k in range(40):
            text = f"text number {k} of some words " * (k * 3)
            leaves = op7_token_counts._cut(text)
            yield op7_token_counts.Document(text, list(map(len, leaves)), count(leaves) if leaves else [], encode)

    together, alone = list(documents()), list(documents())
    for at, drop, put in ((0, 7, "revised"), (900, 25, ""), (40, 0, " a new sentence."), (5, 0, "big words " * 400), (3, 0, ""), (0, 10 ** 6, "")):
        calls.clear()
        op7_token_counts.edit_all([(d, at, drop, put) for d in together], encode)
        assert len(calls) <= 1
        for d in alone:
            d.edit(at, drop, put)
        for d, e in zip(together, alone):
            assert (d.text, d.count, d.parts, d.tree.counts, d.reencoded) == (e.text, e.count, e.parts, e.tree.counts, e.reencoded)


def test_edited_counts_query(spark, docs):
    rows = op7_token_counts.counts(clashing(docs, "edits", "leaf_chars")).collect()
    assert len(rows) == docs.count()
    enc = tokens.encoder(tokens.VOCABULARY, False)
    full = Counter((i, len(enc.library.encode(t, add_special_tokens=False).ids)) for i, t in texts(docs))
    assert Counter((r.doc_id, r.n_tokens_before) for r in rows) == full
    trees = op7_token_counts.revisions(op7_token_counts.build(docs))
    for r in op7_token_counts.apply_edits(trees).collect():
        assert r.n_tokens == len(enc.library.encode(r.text, add_special_tokens=False).ids) == sum(r.leaf_tokens)
    odd = trees.limit(3).withColumn("edits", F.expr("array(null, named_struct('at', null, 'remove', 1L, 'insert', 'x'), "
                                                    "named_struct('at', -5L, 'remove', -1L, 'insert', null))"))
    assert all(r.n_tokens == r.n_tokens_before for r in op7_token_counts.apply_edits(odd).collect())
    assert op7_token_counts.counts(empty_documents(spark)).count() == 0
