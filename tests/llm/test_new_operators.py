"""Operators 11 to 13 against brute force on small tables with the edges they must bear."""

import hashlib
import math
import re

import numpy as np
import pytest

from shelfcast.llm import codes, cover, lexical

VEC = "vec_id long, embedding array<float>, label int, code string"


def lloyd(rows, parts=2, entries=3, rounds=2):
    """Plain Lloyd on integer parts, as the contract states it."""
    kept = [(i, v, lab) for i, v, lab in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0, [math.floor(4096 * x) for x in r[1]]))
    if not kept:
        return {}, hashlib.sha256(b"").hexdigest()
    ints = [[math.floor(4096 * float(x)) for x in v] for _, v, _ in kept]
    width = len(ints[0])
    ints = [(k, x) for k, x in zip(kept, ints, strict=True) if len(x) == width]
    cut = [width * p // parts for p in range(parts + 1)]
    books = [[x[cut[p] : cut[p + 1]] for _, x in ints[:entries]] for p in range(parts)]

    def near(p, piece):
        d = [sum((a - b) ** 2 for a, b in zip(e, piece, strict=True)) for e in books[p]]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p in range(parts):
            sums = {}
            for _, x in ints:
                piece = x[cut[p] : cut[p + 1]]
                e, _ = near(p, piece)
                s = sums.setdefault(e, [0] * len(piece) + [0])
                for j, v in enumerate(piece):
                    s[j] += v
                s[-1] += 1
            for e, s in sums.items():
                books[p][e] = [v // s[-1] for v in s[:-1]]
    out = {}
    for (i, _, lab), x in ints:
        found = [near(p, x[cut[p] : cut[p + 1]]) for p in range(parts)]
        out.setdefault(i, []).append(("".join(f"{e:02x}" for e, _ in found), sum(d for _, d in found), lab))
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    return out, digest


ODD_VECTORS = [
    (5, [0.5, -0.25, 0.125, 0.0], 1, "x"),
    (1, [0.1, 0.2, -0.3, 0.4], 1, "x"),
    (3, [0.1, 0.2, -0.3, 0.4], None, "x"),
    (3, [0.1, 0.2, -0.3, 0.4], None, "x"),
    (2, None, 1, "x"),
    (4, [float("nan"), 0.0, 0.0, 0.0], 2, "x"),
    (6, [0.0, None, 0.0, 0.0], 2, "x"),
    (7, [-0.9, 0.9, -0.7, 0.6], 2, "x"),
    (8, [0.0, 0.0, 0.0, 0.0], 2, "x"),
    (9, [0.3, 0.3, 0.3, 0.31], 2, "x"),
    (None, [0.2, 0.2, 0.2, 0.2], 2, "x"),
]


def test_codes_equal_plain_lloyd(spark):
    df = spark.createDataFrame(ODD_VECTORS, VEC)
    got = codes.compress(df, parts=2, entries=3, rounds=2).collect()
    want, digest = lloyd([(i, v, lab) for i, v, lab, _ in ODD_VECTORS], parts=2, entries=3, rounds=2)
    assert len(got) == sum(len(v) for v in want.values()) == 8
    by_label = {}
    for rows in want.values():
        for _, err, lab in rows:
            by_label[lab] = by_label.get(lab, 0) + err
    for r in got:
        code, err, lab = want[r.vec_id][0]
        assert (r.code, r.error, r.label_error, r.codebooks_sha256) == (code, err, by_label[lab], digest)


def test_codes_empty_and_fewer_rows_than_entries(spark):
    assert codes.compress(spark.createDataFrame([], VEC)).collect() == []
    two = spark.createDataFrame([(1, [0.1] * 16, 0, ""), (2, [0.2] * 16, 0, "")], VEC)
    got = sorted(codes.compress(two).collect())
    assert [(r.vec_id, r.code, r.error) for r in got] == [(1, "00" * 8, 0), (2, "01" * 8, 0)]


def terms(text):
    return re.findall(lexical.TERM, (text or "").translate(str.maketrans(lexical.UPPER, lexical.LOWER)))


def brute_rank(docs, items, k):
    toks = [terms(t) for _, t in docs]
    n_docs, n_terms = sum(1 for t in toks if t), sum(len(t) for t in toks)
    out = []
    for item_id, text in {(i, t) for i, t in items}:
        asked = terms(text)
        scored = []
        for (doc_id, _), t in zip(docs, toks, strict=True):
            m = 75 + (25 * len(t) * n_docs) // n_terms if n_terms else 0
            s = 0
            for term in asked:
                tf = t.count(term)
                if tf:
                    df = sum(1 for u in toks if term in u)
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                    s += w * ((10**9 * tf) // (1000 * tf + 12 * m))
            if s > 0:
                scored.append((-s, doc_id is None, doc_id or 0, s, doc_id))
        scored.sort()
        out += [(item_id, r + 1, d, s) for r, (_, _, _, s, d) in enumerate(scored[:k])]
    return sorted(out, key=str)


def test_lexical_equals_brute_force(spark):
    words = "alpha beta gamma delta Epsilon zeta eta theta iota kappa".split()
    rng = np.random.default_rng(3)
    docs = [(i, " ".join(rng.choice(words, rng.integers(1, 30)))) for i in range(60)]
    docs += [(60, None), (61, ""), (62, "ALPHA alpha-ALPHA; ünïcode"), (62, "ALPHA alpha-ALPHA; ünïcode"), (None, "beta beta")]
    items = [(1, "alpha beta beta"), (2, "ünïcode"), (3, "nothing here"), (3, "nothing here"), (4, None), (5, "theta.kappa,zeta")]
    got = lexical.rank(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), k=5
    ).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute_rank(docs, items, 5)


def test_lexical_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.rank(empty, items).collect() == []
    assert lexical.rank(spark.createDataFrame([(1, "a")], "doc_id long, text string"), items.limit(0)).collect() == []


def test_range_max_and_search():
    impacts = np.array([3, 9, 9, 1, 7, 2, 9], dtype=np.int64)
    rmq = lexical.RangeMax(impacts)
    for a in range(7):
        for b in range(a + 1, 8):
            assert rmq.best(a, b) == a + int(np.argmax(impacts[a:b]))
    docs = np.arange(7)
    assert lexical.search([(2, docs, rmq)], 7, 3) == [(1, 18), (2, 18), (6, 18)]


def brute_links(rows, threshold=0.98):
    ok = []
    for i, v, lab in rows:
        good = i is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v)
        if good:
            a = np.array(v, dtype=np.float64)
            top = np.abs(a).max()
            good = top > 0
        ok.append((i, lab, (a / top) / np.linalg.norm(a / top) if good else None))
    links, parent = [0] * len(ok), list(range(len(ok)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, (_, la, ua) in enumerate(ok):
        for y, (_, lb, ub) in enumerate(ok):
            if x < y and ua is not None and ub is not None and la == lb and float(ua @ ub) >= threshold:
                links[x] += 1
                links[y] += 1
                a, b = find(x), find(y)
                if a != b:
                    parent[max(a, b)] = min(a, b)
    groups = {}
    for x, (i, _, _) in enumerate(ok):
        if i is not None:
            groups.setdefault(find(x), []).append(i)
    found = [(i, links[x], min(groups[find(x)]) if ok[x][2] is not None else i) for x, (i, _, _) in enumerate(ok)]
    return sorted(found, key=str)


def test_cover_equals_brute_force_with_small_nodes(spark):
    rng = np.random.default_rng(7)
    base = rng.standard_normal((4, 8))
    rows = []
    for n in range(120):
        b = base[n % 4] + rng.standard_normal(8) * (0.02 if n % 3 else 0.6)
        rows.append((n, [float(x) for x in b], n % 2))
    rows += [(200, rows[0][1], 0), (201, rows[0][1], 0), (202, [1e200] * 8, 1), (203, [1e-200] * 8, 1), (204, [1.0] * 8, 1)]
    rows += [(205, [0.0] * 8, 1), (206, None, 1), (207, [1.0] * 7 + [float("inf")], 1), (208, [1.0] * 8, None), (None, [1.0] * 8, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted([(r.vec_id, r.n_links, r.component_id) for r in cover.near_duplicates(df, leaf=6, fanout=3).collect()], key=str)
    assert got == brute_links(rows)
    kept = {r.vec_id: r.kept for r in cover.near_duplicates(df, leaf=6, fanout=3).collect()}
    assert kept[202] is True and kept[203] is False and kept[None] is True


def test_cover_empty(spark):
    assert cover.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []
