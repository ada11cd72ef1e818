import random
import re

import numpy as np
import pytest
import xxhash

from quern.llm import line_dedup, simhash

SMALL = "/root/testdata/sf0.001"


def near(a, b):
    """Words differ by one insertion, deletion or replacement at most."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i:] == b[i + 1 :] or a[i + 1 :] == b[i + 1 :]


def brute(docs, min_words=5):
    first, out, rows = {}, {}, []
    for doc, text in docs:
        for no, raw in enumerate((text or "").split("\n")):
            line = re.sub(r"^\s+|\s+$", "", raw, flags=re.A)
            if line:
                rows.append((doc, no, line))
    for doc, no, line in rows:
        key = (-1 if doc is None else doc, no)
        first[line] = min(first.get(line, key), key)
    words = {line: re.split(r"\s+", line, flags=re.A) for line in first}
    by_len = {}
    for line in first:
        by_len.setdefault(len(words[line]), []).append(line)
    gone = {}
    for line in first:
        n = len(words[line])
        if n >= min_words:
            ahead = [first[o] for k in (n - 1, n, n + 1) for o in by_len.get(k, []) if first[o] < first[line] and near(words[o], words[line])]
            if ahead:
                gone[line] = min(ahead)
    for doc, no, line in rows:
        key = (-1 if doc is None else doc, no)
        out[key] = "exact" if key != first[line] else "near" if line in gone else "keep"
    return out


def verdicts(df):
    return {(-1 if r.doc_id is None else r.doc_id, r.no): r.verdict for r in line_dedup.line_verdicts(df).collect()}


def test_lines_match_brute_force(spark):
    rng = random.Random(1)
    words = ["a", "b", "c", "d", "e", "f"]
    docs = [(i, "\n".join(" ".join(rng.choice(words) for _ in range(rng.randint(0, 8))) for _ in range(6))) for i in range(60)]
    base = [rng.choice(words) + str(k) for k in range(1001)]
    for i in range(60, 80):
        w = list(base[: rng.choice([150, 999, 1000, 1001])])
        at = rng.randrange(len(w))
        w[at : at + rng.randint(0, 1)] = [f"new{i}"] * rng.randint(0, 1)
        docs.append((i, " ".join(w)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute(docs)
    assert verdicts(df) == want
    assert {"exact", "near", "keep"} <= set(want.values())


def test_lines_of_small_tables(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert verdicts(df) == brute([(r.doc_id, r.text) for r in df.collect()])


def test_line_edges(spark, edge_docs, no_docs):
    got = verdicts(edge_docs)
    assert got == brute([(r.doc_id, r.text) for r in edge_docs.collect()])
    assert line_dedup.line_report(no_docs).count() == 0
    kept = line_dedup.dedup_lines(edge_docs)
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count()
    assert {r.doc_id: r.text for r in kept.collect() if r.doc_id == 5} == {5: ""}


def test_hot_template(spark):
    df = spark.range(2000).selectExpr("id AS doc_id", "concat('page number ', id, ' of this very long report') AS text")
    r = line_dedup.line_report(df).collect()
    assert sum(x.n_near for x in r) == 1999


def slow_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", text)
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def reachable(items, bits=3):
    up = {i: i for i, _ in items}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, x in items:
        for b, y in items:
            if a < b and (x ^ y).bit_count() <= bits:
                p, q = find(a), find(b)
                up[max(p, q)] = min(p, q)
    return {i: find(i) for i, _ in items}


def test_simhash_matches_brute_force(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    fps = {i: slow_fingerprint(t) for i, t in rows}
    want = reachable(list(fps.items()))
    got = simhash.simhash_components(df).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{fps[i]:016x}", want[i]) for i in fps}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_trees_lose_no_pair(spark, seed):
    """Random, clustered and chained fingerprints, through deep trees with small leaves."""
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**64, 400, dtype=np.uint64)
    close = base[:100] ^ (np.uint64(1) << rng.integers(0, 64, 100).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 100).astype(np.uint64))
    chain = [np.uint64(0)]
    for k in range(40):
        chain.append(chain[-1] ^ np.uint64(7 << k))
    dense = np.uint64(0xABCDEF) ^ (np.uint64(1) << np.arange(64, dtype=np.uint64))
    fps = np.unique(np.concatenate([base, close, np.array(chain, np.uint64), dense]))
    rows = [(int(np.int64(f)), i) for i, f in enumerate(fps.view(np.int64))]
    links = simhash.near_links(spark.createDataFrame(rows, "fp long, id long"), leaf=16).collect()
    want = reachable([(i, f & (2**64 - 1)) for f, i in rows])
    up = {i: i for _, i in rows}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for r in links:
        p, q = find(r.a), find(r.b)
        up[max(p, q)] = min(p, q)
    assert {i: find(i) for _, i in rows} == want
    assert len(links) < 4 * len(rows)  # forests, not pairs


@pytest.mark.parametrize("depth", [3, 8])
def test_every_near_pair_meets_in_a_leaf(depth):
    """One of the two is at home there, whatever the boundaries."""
    for seed in range(4):
        rng = np.random.default_rng(seed)
        x = rng.integers(0, 2**32, 3000, dtype=np.uint32)
        y = np.where(rng.random(3000) < 0.1, x, x ^ (np.uint32(1) << rng.integers(0, 32, 3000).astype(np.uint32)))
        tree = simhash.fit_tree(x[:500], depth, seed)
        at = [{}, {}]
        for side, half in enumerate((x, y)):
            for row, leaf, home in zip(*simhash.route(half, *tree)):
                at[side].setdefault(int(row), {})[int(leaf)] = at[side].get(int(row), {}).get(int(leaf), False) or bool(home)
        for i in range(3000):
            both = at[0][i].keys() & at[1][i].keys()
            assert any(at[0][i][k] or at[1][i][k] for k in both)


def test_leaf_splits(spark):
    rng = np.random.default_rng(5)
    fps = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    fps[1500:] = fps[:1500] ^ (np.uint64(1) << rng.integers(0, 64, 1500).astype(np.uint64))
    for shift in (0, 32):
        half = (fps >> np.uint64(shift)).astype(np.uint32)
        forest = simhash._Forest(len(fps))
        simhash.search_leaf(fps, half, np.arange(3000), np.arange(0), 3, forest, np.random.default_rng(1))
        near_half = np.bitwise_count(half[:1500] ^ half[1500:]) <= 1
        assert all(forest.label[i] == forest.label[i + 1500] for i in np.flatnonzero(near_half))


def test_components_of_a_long_chain(spark):
    links = spark.range(60).selectExpr("id AS a", "id + 1 AS b").union(spark.range(5).selectExpr("100 + id AS a", "100 AS b"))
    got = {r.id: r.component for r in simhash.components(links).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {100 + i: 100 for i in range(1, 5)}


def test_simhash_edges(spark, edge_docs, no_docs):
    got = simhash.simhash_components(edge_docs).collect()
    assert len(got) == edge_docs.count()
    by = {(r.doc_id, r.fingerprint): r.component_id for r in got}
    zero = "0" * 16
    assert by[(1, zero)] == by[(2, zero)] == by[(3, zero)] == by[(None, zero)] == 1
    assert {r.component_id for r in got if r.doc_id in (4, 5)} == {4}
    assert simhash.simhash_components(no_docs).count() == 0


def test_null_ids_bridge(spark, monkeypatch):
    """A fingerprint that only a row without an id has links two others."""
    prints = {"a": 1, "b": 7, "c": 63, "d": 0xFFFF << 40, "e": 1 << 50 | 0xFFFF}
    monkeypatch.setattr(simhash, "fingerprint", lambda t, k: prints[t])
    df = spark.createDataFrame([(2, "a"), (None, "b"), (1, "c"), (None, "e"), (4, "d"), (3, "d")], "doc_id long, text string")
    got = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.simhash_components(df).collect()}
    hexed = {t: f"{v:016x}" for t, v in prints.items()}
    assert got == {(2, hexed["a"]): 1, (None, hexed["b"]): 1, (1, hexed["c"]): 1, (None, hexed["e"]): None, (4, hexed["d"]): 3, (3, hexed["d"]): 3}


def test_near_dedup_is_by_row(spark):
    """One id with two texts: the one without a copy stays."""
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    df = spark.createDataFrame([(3, b, 1), (5, a, 2), (5, b, 3), (None, a, 4), (None, None, 5), (7, None, 6)], "doc_id long, text string, h long")
    assert sorted(r.h for r in simhash.near_dedup(df).collect()) == [1, 2, 4, 5, 6]
    assert simhash.near_dedup(df).columns == df.columns and simhash.near_dedup(df.limit(0)).count() == 0


def test_rows_that_share_an_id(spark):
    """Different texts under one id, or none: each row loses its own lines only."""
    rows = [(1, "one line that is here first\nkept a"), (2, "kept b\none line that is here first"), (2, "kept c\nkept d"), (None, "x y z\nkept e"), (None, "kept f\nx y z"), (None, "kept g\nkept h")]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.text for r in got) == sorted(["one line that is here first\nkept a", "kept b", "kept c\nkept d", "x y z\nkept e", "kept f", "kept g\nkept h"])


def test_many_rows_without_an_id(spark):
    """Their lines are looked up by text: time grows with the rows, not with their square."""
    df = spark.range(20_000).selectExpr("CAST(NULL AS LONG) AS doc_id", "concat('page number ', id, ' of this very long report') AS text")
    r = {x.verdict: x["count"] for x in line_dedup.line_verdicts(df).groupBy("verdict").count().collect()}
    assert r == {"near": 19_999, "keep": 1}
