"""Near-duplicate operators against brute force."""

import re
from collections import Counter

import numpy as np
import pytest

from metroflux.llm import op4_minhash, op6_embedding_dedup
from metroflux.llm.common import connected_components, read_table
from tests.conftest import SMOKE
from tests.llm.helpers import clashing, empty_documents, odd_documents


def components(n, links):
    up = list(range(n))

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        up[top(a)] = top(b)
    return [top(k) for k in range(n)]


def shingles(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return frozenset()
    return frozenset(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4)))


def brute_near(rows, percent=85):
    """Expected (doc_id, n_shingles, component_id, kept) rows."""
    sets = [shingles(t) for _, t in rows]
    ok = [k for k, (i, _) in enumerate(rows) if sets[k] and i is not None]
    links = [(a, b) for x, a in enumerate(ok) for b in ok[x + 1:]
             if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    top, least = components(len(rows), links), {}
    for k in ok:
        least[top[k]] = min(least.get(top[k], rows[k][0]), rows[k][0])
    out = []
    for k, (i, _) in enumerate(rows):
        comp = least[top[k]] if k in set(ok) else i
        out.append((i, len(sets[k]), comp, True if i is None else i == comp))
    return Counter(out)


@pytest.fixture(scope="module")
def family():
    """A chain of edits, a large group of near copies with strangers, and texts just below the threshold."""
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list("abcdefghij"), rng.integers(2, 7)))
    rows, base = [], [word() for _ in range(140)]
    for k in range(60):
        w = list(base)
        for at in rng.integers(0, 140, k // 6):
            w[at] = word()
        rows.append((1000 + k, " ".join(w)))
    chain = [word() for _ in range(90)]
    for k in range(12):
        chain = chain[1:] + [word()]
        rows.append((2000 - k, " ".join(chain)))
    rows += [(3000, "one two three"), (3001, "One TWO three"), (3002, "one two four"), (3003, rows[0][1])]
    return rows


def test_near_duplicates_equal_brute_force(spark, family):
    odd = [(r.doc_id, r.text) for r in odd_documents(spark).collect()]
    smoke = [(r.doc_id + 10_000, r.text) for r in read_table(spark, SMOKE, "documents").collect()]
    rows = family + odd + smoke + [(1, family[3][1])]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"), "id", "key", "component", "sig")
    got = Counter(tuple(r) for r in op4_minhash.near_duplicates(df).collect())
    assert got == brute_near(rows)


@pytest.mark.parametrize("percent", [70, 80, 85, 90])
def test_pairs_within_the_distance_share_a_key(percent):
    rng, limits = np.random.default_rng(4), op4_minhash.Limits.of(percent)
    chunk_of = limits.chunk_of()
    assert limits.distance < 2 * limits.chunks and len(set(chunk_of)) == limits.chunks
    for _ in range(100):
        a = rng.integers(0, 1 << 16, (1, op4_minhash.SYMBOLS)).astype(np.uint16)
        b = a.copy()
        b[0, rng.choice(op4_minhash.SYMBOLS, limits.distance, replace=False)] ^= 1
        x, y = op4_minhash.chunk_keys(a, chunk_of)[0], op4_minhash.chunk_keys(b, chunk_of)[0]
        first = op4_minhash.first_shared(a != b, chunk_of)[0]
        assert x[first] == y[first] and (x != y)[:first].all()


def test_near_duplicates_without_rows_or_links(spark):
    assert op4_minhash.near_duplicates(empty_documents(spark)).count() == 0
    one = spark.createDataFrame([(5, "a b c d e f")], "doc_id long, text string")
    assert [tuple(r) for r in op4_minhash.near_duplicates(one).collect()] == [(5, 2, 5, True)]


def test_keep_first_leaves_one_of_each_group(spark, family):
    df = spark.createDataFrame([*family, family[0], (None, family[0][1])], "doc_id long, text string")
    for percent in (80, 85):
        want = {i for (i, _, _, kept) in brute_near(family, percent) if kept}
        got = [r.doc_id for r in op4_minhash.keep_first(df, percent=percent).collect()]
        assert sorted(i for i in got if i is not None) == sorted(want) and got.count(None) == 1
    assert op4_minhash.STAGE_PERCENT == 80


def test_rows_sent_to_confirmation_grow_with_the_group(spark, monkeypatch):
    """A family of copies with a few words changed, many pairs of which lie below the threshold, however they fall apart."""
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefghij"), rng.integers(2, 7)))
    base, sent = [word() for _ in range(300)], []
    pairwise, packed = op4_minhash.confirmed, op4_minhash.confirmed_forest

    def counted(pairs, texts, limits):
        sent[-1] += pairs.count()
        return pairwise(pairs, texts, limits)

    def counted_forest(left, homes, texts, limits):
        sent[-1] += left.count()
        out = packed(left, homes, texts, limits)
        sent[-1] += out.count()
        return out

    monkeypatch.setattr(op4_minhash, "confirmed", counted)
    monkeypatch.setattr(op4_minhash, "confirmed_forest", counted_forest)
    for size in (150, 600):
        rows = []
        for k in range(size):
            w = list(base)
            for at in rng.integers(0, 300, int(rng.integers(0, 6))):
                w[at] = word()
            rows.append((k, " ".join(w)))
        sent.append(0)
        got = Counter(tuple(r) for r in op4_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
        assert got == brute_near(rows)
    assert sent[1] < 6 * sent[0]


def test_small_blocks_confirm_the_same_links(spark, family, monkeypatch):
    monkeypatch.setattr(op4_minhash, "BLOCK", 16)
    monkeypatch.setattr(op4_minhash, "ROUNDS", ())
    df = spark.createDataFrame(family, "doc_id long, text string")
    assert Counter(tuple(r) for r in op4_minhash.near_duplicates(df).collect()) == brute_near(family)


def test_keep_first_judges_each_text_of_an_id(spark):
    copied, new, other = ("".join(f"{w}{k} " for k in range(30)) for w in "xyz")
    rows = [(3, copied, 1), (5, copied, 2), (5, new, 3), (5, new, 3), (5, other, 4), (5, new + "end", 5), (6, "", 6), (6, other + "end", 7)]
    got = [tuple(r) for r in op4_minhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string, set_a long")).collect()]
    assert sorted((i, t.split()[0] if t else "") for i, t, _ in got) == [(3, "x0"), (5, "y0"), (5, "z0"), (6, "")] and set(got) <= set(rows)


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 200 + k) for k in range(50)] + [(7, 7), (300, 299)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(41)) and all(got[200 + k] == 100 for k in range(50)) and got[300] == got[299] == 299


def vectors(rng):
    base = rng.standard_normal((40, 16))
    rows = [base[k % 8] + 0.12 * rng.standard_normal(16) for k in range(150)] + [base[k] for k in range(8, 40)]
    rows += [rows[0] * 3.5, rows[0], rows[1]]
    out = [(k, [float(np.float32(x)) for x in v]) for k, v in enumerate(rows)]
    n = len(out)
    return out + [(n, None), (n + 1, [0.0] * 16), (n + 2, [float("nan")] + [1.0] * 15), (n + 3, []), (n + 4, [1.0] * 3),
                  (n + 5, [2.0] * 3), (None, out[0][1]), (n + 6, [1e300] * 16), (n + 7, [None] + [1.0] * 15), (0, out[0][1])]


def test_embedding_links_equal_brute_force(spark):
    rows = vectors(np.random.default_rng(6))
    df = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "unit", "id", "length")
    unit = []
    for i, v in rows:
        x = np.array([np.float64(np.float32(c)) for c in v]) if v and None not in v else np.zeros(0)
        fine = len(x) and np.isfinite(x).all() and x.any() and i is not None
        unit.append(x / np.linalg.norm(x) if fine else None)
    near = [(a, b) for a in range(len(rows)) for b in range(len(rows)) if a != b and unit[a] is not None and unit[b] is not None
            and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.9]
    top, least, degree = components(len(rows), near), {}, Counter(a for a, _ in near)
    for k, (i, _) in enumerate(rows):
        if unit[k] is not None:
            least[top[k]] = min(least.get(top[k], i), i)
    want = Counter((i, degree[k], i if unit[k] is None else least[top[k]],
                    True if i is None else i == (i if unit[k] is None else least[top[k]])) for k, (i, _) in enumerate(rows))
    assert Counter(tuple(r) for r in op6_embedding_dedup.near_duplicates(df).collect()) == want


def units_of(rng, n, length):
    x = rng.standard_normal((n, length))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize("cone", [0.7, 0.8])
def test_links_in_a_dense_third_are_found(spark, cone):
    """A third of the vectors lie in a cone of one mutual cosine; pairs at 0.92 are planted in it and outside."""
    rng, n, length = np.random.default_rng(9), 6000, 48
    axis = units_of(rng, 1, length)[0]
    spread = units_of(rng, n - n // 3, length)
    aside = rng.standard_normal((n // 3, length))
    aside -= np.outer(aside @ axis, axis)
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    x = np.concatenate([np.sqrt(cone) * axis + np.sqrt(1 - cone) * aside, spread])
    planted = np.concatenate([np.arange(200), np.arange(n // 3, n // 3 + 200)])
    turn = units_of(rng, len(planted), length)
    turn -= (turn * x[planted]).sum(1)[:, None] * x[planted]
    turn /= np.linalg.norm(turn, axis=1, keepdims=True)
    x = np.concatenate([x, 0.92 * x[planted] + np.sqrt(1 - 0.92**2) * turn]).astype(np.float32).astype(np.float64)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    got = {r.vec_id: r.n_links for r in op6_embedding_dedup.near_duplicates(
        spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")).collect()}
    want = near.sum(1)
    assert len(got) == len(x) and all(got[k] <= want[k] for k in got)
    dense = np.concatenate([np.arange(n // 3), np.arange(n, n + 200)])
    assert sum(got[k] for k in dense.tolist()) >= 0.97 * want[dense].sum() > 300
    assert sum(got.values()) >= 0.97 * want.sum()


def test_embeddings_without_rows(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert op6_embedding_dedup.near_duplicates(none).count() == 0
