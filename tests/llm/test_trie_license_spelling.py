"""Prefix trie, license rules and spelling variants against brute force, and their SQL against the queries."""

import collections
import hashlib
import random
import re
import zlib

import pytest

from metroflux.llm import op11_prefix_trie, op12_licenses, op13_spelling, queries
from metroflux.llm.common import read_table
from tests.conftest import SMOKE
from tests.llm.helpers import clashing, empty_documents, odd_documents
from tests.oracle_check import compare, duck

TO_LOWER = str.maketrans(op12_licenses.UPPER, op12_licenses.LOWER)
CONVERSATION = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, name):
    r = compare(spark, duck(SMOKE), name, queries.queries()[name], queries.oracle_sql()[name], SMOKE)
    assert r["ok"], r.get("why")


# ---- prefix trie

def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]


def signed(h):
    return tuple(int.from_bytes(bytes.fromhex(h[i:i + 16]), signed=True) for i in (0, 16))


def said(rows):
    by = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            by[c].append(((t is not None, t or 0), signed(digest(r or "", x or "")), (r or "", x or "")))
    return {c: [y[2] for y in sorted(v)] for c, v in by.items()}


def trie(paths):
    """Brute force: rows of the trie of {conv_id: sequence}."""
    members = collections.defaultdict(list)
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            members[tuple(paths[c][:d])].append(c)
    children = collections.Counter(k[:-1] for k in members if k)
    saved, leaves = collections.Counter(), collections.Counter()
    for k, m in members.items():
        value = (len(m) - 1) * len(re.findall(op11_prefix_trie.WORD, k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            saved[k[:d]] += value
            leaves[k[:d]] += not children[k]
    return sorted((m[0], len(k), members[k[:-1]][0] if k else -1, len(m), children[k], leaves[k], saved[k],
                   hashlib.sha256(",".join(str(c) for c in m if len(paths[c]) == len(k)).encode()).hexdigest()) for k, m in members.items())


def rebuilt(paths):
    out = {}
    for c in paths:
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = paths.get(c - c % 20, [])[:h] + paths[c][h:]
    return out


def rows_of(df):
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.select(*cols).collect())


def test_trie_of_odd_and_long_conversations(spark):
    rng = random.Random(5)
    rows = [(c, t, "user", rng.choice(["a b", "c", ""])) for c in range(60) for t in range(rng.randrange(1, 5))]
    rows += [(100 + c, t, "user", f"w {t}") for c in range(3) for t in range(70 + c)]  # many blocks, shared to the end
    rows += [(200, t, "user", "same words here") for t in range(300)]
    rows += [(300, None, None, None), (300, None, "user", "late"), (300, 0, "user", None), (300, 0, "user", None), (None, 1, "user", "lost"),
             (-7, 3, "x", "y z"), (-20, 1, "é", "z"), (301, 5, "user", "y")]
    df = spark.createDataFrame(rows, CONVERSATION).repartition(5)
    paths = said(rows)
    assert rows_of(op11_prefix_trie.rebuilt_trie(clashing(df, "t", "pos", "block", "h"))) == trie(rebuilt(paths))
    assert rows_of(op11_prefix_trie.prefix_trie(df)) == trie(paths)


def test_trie_of_one_conversation_over_spans(spark, monkeypatch):
    monkeypatch.setattr(op11_prefix_trie, "SPAN", 3)
    rows = [(c, t, "user", f"w{t % 7} x") for c in (1, 2) for t in range(120 + c)]
    df = spark.createDataFrame(rows, CONVERSATION)
    assert rows_of(op11_prefix_trie.prefix_trie(df)) == trie(said(rows))


def test_trie_with_a_hot_node_packs_its_ids(spark, monkeypatch):
    monkeypatch.setattr(op11_prefix_trie, "PACK", 7)
    rows = [(c, 0, "user", "hello there") for c in range(500)] + [(c, 1, "bot", "x") for c in range(0, 500, 3)]
    got = rows_of(op11_prefix_trie.prefix_trie(spark.createDataFrame(rows, CONVERSATION)))
    assert got == trie(said(rows))


def test_trie_of_nothing(spark):
    assert op11_prefix_trie.rebuilt_trie(spark.createDataFrame([], CONVERSATION)).count() == 0
    assert op11_prefix_trie.rebuilt_trie(spark.createDataFrame([(None, 1, "a", "b")], CONVERSATION)).count() == 0


# ---- licenses

RULES = op12_licenses.signature_rules()


def normal(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(TO_LOWER))


def scan(text, rules=RULES):
    """Brute force of one text: the query's columns after doc_id, and the intervals that stay."""
    w = normal(text)
    places = collections.defaultdict(list)
    for phrase, label in op12_licenses.BASE.items():
        p = phrase.split()
        places[label] += [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
    places = {k: v for k, v in places.items() if v}
    flat = [i for v in places.values() for i in v]
    line = " " + "".join(x + " " for x in w)
    found = [(r["tier"], r["rule"], line.count(" ", 0, m.start()), line.count(" ", 0, m.end()), r["label"], op12_licenses.WEIGHTS[r["tier"]])
             for r in rules if r["keyword"] in line for m in re.finditer(r["regex"], line)]

    def better(e, d):
        return (e is not d and e[2] <= d[2] and e[3] >= d[3]
                and (e[0] < d[0] or e[0] == d[0] and (e[3] - e[2] > d[3] - d[2] or e[2:4] == d[2:4] and e[1] < d[1])))

    kept = [d for d in found if not any(better(e, d) for e in found)]
    return ((len(w), len(flat), min(flat, default=None), max(flat, default=None), ",".join(sorted(places)),
             ",".join(sorted({*places, *(d[4] for d in kept)})), max((d[5] for d in kept), default=0.0)),
            sorted((d[1], d[2], d[3]) for d in kept))


TEXTS = [
    ("Permission is hereby granted, free of charge, to any person obtaining a copy\n * of this", "mit"),
    ("# SPDX-License-Identifier: GPL-2.0-or-later", "gpl-2.0-or-later"),
    ("// Licensed under GPLv3. cc by cc by cc-by-sa 4.0", "cc-by,cc-by-sa-4.0,gpl-3.0"),
    ("under CC BY-NC-SA 4.0 and the MIT License (BSD 3-clause), Copyright (c) 2004 2005 X. Apache 2", "apache-2.0,bsd-3-clause,cc-by,cc-by-nc-sa-4.0,copyright,mit"),
    ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.', "apache-2.0"),
    ("GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", "gpl,gpl-2.0-or-later"),
    ("All rights reserved. ALL\nRIGHTS -- reserved? all rights, reserved", "reserved"), ("calls rights reserved, accc bye, mit freundlichen", ""),
    ("Mozilla Public License 2.0 10", "mpl"), ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ("é cc BY 中文 all rights reserved cc", "cc-by,reserved"), (None, ""), ("", ""), (" \n\t\x00 ", ""),
]


def test_license_labels_and_intervals_equal_brute_force(spark):
    rows = [(i, t) for i, (t, _) in enumerate(TEXTS)] + [(None, TEXTS[0][0]), (3, TEXTS[3][0])]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"), "words", "row", "found", "label")
    got = collections.Counter(tuple(r) for r in op12_licenses.licenses(df).collect())
    assert got == collections.Counter((i, *scan(t)[0]) for i, t in rows)
    assert {r.doc_id: r.labels for r in op12_licenses.licenses(df).where("doc_id is not null").collect()} == {i: want for i, (_, want) in enumerate(TEXTS)}
    spans = collections.defaultdict(list)
    for r in op12_licenses.detections(df.where("doc_id <> 3")).collect():
        spans[r.doc_id].append((r.rule, r.start, r.end))
    assert {i: sorted(v) for i, v in spans.items()} == {i: scan(t)[1] for i, t in rows if i not in (3, None) and scan(t)[1]}


def test_licenses_of_the_table_and_of_odd_rows(spark):
    docs = read_table(spark, SMOKE, "documents").select("doc_id", "text").union(odd_documents(spark).select("doc_id", "text"))
    got = collections.Counter(tuple(r) for r in op12_licenses.licenses(docs).collect())
    assert got == collections.Counter((r.doc_id, *scan(r.text)[0]) for r in docs.collect())
    assert op12_licenses.licenses(empty_documents(spark)).count() == 0


def test_many_detections_in_one_long_text(spark):
    text = "Licensed under the Apache License, Version 2.0. cc by 4.0 all rights reserved\n" * 20_000
    r = op12_licenses.licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (r.n_words, r.n_base, r.first_word, r.last_word, r.labels) == (300_000, 40_000, 8, 299_997, "apache-2.0,cc-by,cc-by-4.0,reserved")


def test_rules_are_ordered_and_gated():
    assert len(RULES) > 300 and [r["tier"] for r in RULES] == sorted(r["tier"] for r in RULES)
    for r in RULES:
        assert not re.search(r["regex"], " "), r
    for label, keyword, body in op12_licenses.SENTENCES:
        assert keyword in body  # the gate lets its own sentence through


# ---- spelling

def vocabulary(rows):
    n = collections.Counter()
    for d, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(TO_LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += len(w) >= 7
    return {w: k for w, k in n.items() if k >= 2}


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def grouped(v):
    near = {w: [x for x in v if one_apart(w, x)] for w in v}
    form = {}
    for w in v:
        best = min(near[w], key=lambda x: (-v[x], x), default=None)
        if best is not None and v[best] >= 10 * v[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w
    return {(w, form.get(w), root(w), v[w], len(near[w]), v[form[w]] if w in form else None) for w in v}


def found(df):
    got = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_variants_equal_brute_force_on_dense_words(spark):
    rng = random.Random(11)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(7, 10))) for _ in range(900)}
    counts = {w: rng.choice([2, 3, 25, 400, 5000]) for w in words}
    got = found(op13_spelling.variants(spark.createDataFrame(sorted(counts.items()), "word string, n long")))
    assert got == grouped(counts)
    assert any(f and r != f for _, f, r, *_ in got)  # chains are followed


def test_variants_of_repetitive_words(spark):
    words = ["a" * 7, "a" * 8, "a" * 9, "aaaabaaa", "abababab", "babababa", "ababababa", "zzzzzzzz", "zzzzzzzy", "yzzzzzzz", "zzzzyzzz", "z" * 40, "z" * 41]
    counts = {w: 2 + 30 ** (i % 3) for i, w in enumerate(words)}
    assert found(op13_spelling.variants(spark.createDataFrame(sorted(counts.items()), "word string, n long"))) == grouped(counts)


def test_words_of_odd_documents(spark):
    text = "Straße straßen STRASSEN überall überalł wörter-WÖRTERN naïveté çédille × ÷abcdefg "
    docs = odd_documents(spark, [(i, text * 2, "de", "s", 1) for i in range(40)])
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    df = clashing(docs, "word", "run", "n", "key")
    assert {(r.word, r.n) for r in op13_spelling.vocabulary(df).collect()} == set(vocabulary(rows).items())
    assert found(op13_spelling.spelling_variants(df)) == grouped(vocabulary(rows))
    assert op13_spelling.spelling_variants(empty_documents(spark)).count() == 0
