"""Components of the Jaccard join against brute force over all pairs."""

import random
import re

import numpy as np
import pytest

from newsatlas.llm import ngram_join
from newsatlas.llm.components import components
from newsatlas.llm.ngram_join import boundary, jaccard_groups, needed, subset_keys


def grams(text, n=4):
    own = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(own[i : i + n]) for i in range(max(1, len(own) - n + 1))} if own else set()


def brute(rows, percent=85):
    sets = [(d, grams(t)) for d, t in rows]
    parent = {d: d for d, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by_gram = {}
    for i, (_, own) in enumerate(sets):
        for g in own:
            by_gram.setdefault(g, []).append(i)
    pairs = set()
    for i, (_, own) in enumerate(sets):
        for j in {j for g in own for j in by_gram[g] if j > i}:
            pairs.add((i, j))
    for i, j in pairs:
        (a, x), (b, y) = sets[i], sets[j]
        if 100 * len(x & y) >= percent * len(x | y) and d_ok(a, b):
            ra, rb = root(a), root(b)
            parent[max(ra, rb)] = min(ra, rb)
    return sorted((d, len(own), root(d)) for d, own in sets)


def d_ok(a, b):
    return a is not None and b is not None


def ours(frame):
    return sorted(tuple(r) for r in jaccard_groups(frame).collect())


def test_whole_table(result, documents):
    expected = brute([r[:2] for r in documents])
    found = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in result("op10_ngram_join"))
    assert found == expected
    assert any(d != c for d, _, c in expected)


def made(seed, n=160):
    """Short and long texts, with chains of small edits."""
    rng = random.Random(seed)
    rows, texts = [], []
    for i in range(n):
        if texts and rng.random() < 0.6:
            own = rng.choice(texts).split()
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                where = rng.randint(0, len(own))
                kind = rng.random()
                own = own[:where] + ([f"n{rng.randint(0, 99)}"] if kind < 0.5 else []) + own[where + (kind > 0.3) :]
        else:
            own = [rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(rng.choice([1, 3, 5, 9, 14, 20, 27, 40, 90]))]
        texts.append(" ".join(own) or "x")
        rows.append((rng.randint(0, 10**9) * 1000 + i, texts[-1]))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_made_texts(docs, seed):
    rows = made(seed)
    assert ours(docs(rows).repartition(5)) == brute(rows)


def test_divided_lists(docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "LIST_ROWS", 3)
    monkeypatch.setattr(ngram_join, "LOCAL_ROWS", 2)
    rows = made(3, 60)
    assert ours(docs(rows).repartition(4)) == brute(rows)


def test_edges(docs):
    base = " ".join(f"w{i}" for i in range(50))
    rows = [
        (1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE\ttwo"), (6, "one"), (7, base), (8, base + " tail"), (9, base.upper()),
        (10, " ".join(f"v{i}" for i in range(30_000))), (11, " ".join(f"v{i}" for i in range(29_000))), (12, "a a a a a a a a a"), (13, "a a a a"),
        (14, base), (14, base),
    ]
    assert ours(docs(rows)) == brute(rows)
    found = {r["doc_id"]: r["component_id"] for r in jaccard_groups(docs([(None, base), (3, base), (2, base)])).collect()}
    assert found == {None: None, 3: 2, 2: 2}
    assert ours(docs([])) == []


def test_many_near_copies(docs):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(250):
        own = list(base)
        own[rng.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(own)))
    assert {c for _, _, c in ours(docs(rows).repartition(6))} == {0}


def test_linked_light_sets_share_a_subset():
    rng = np.random.default_rng(4)
    for size in range(1, 20):
        x = rng.integers(0, 1 << 62, size).astype(np.uint64)
        keys = set(subset_keys(x, 85).tolist())
        for gone in range(size - needed(size, 85) + 1):
            assert keys & set(subset_keys(np.sort(x[gone:]), 85).tolist())


def test_boundary_follows_cost():
    assert boundary(0.0, 85) == 6 and boundary(10.0, 85) == 13 and boundary(1e9, 85) == 26


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(5, 300), (300, 7), (9, 9), (None, 3)]
    found = components(spark.createDataFrame(chain, "a long, b long")).collect()
    expected = {i: 100 for i in range(100, 161)} | {5: 5, 7: 5, 300: 5}
    assert {r["node"]: r["component"] for r in found} == expected and len(found) == len(expected)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_linked_members_by_brute_force():
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 40, 300)
    sets = [np.unique(np.where(rng.random(300) < rng.choice([0.02, 0.05, 0.3]), rng.integers(0, 1 << 40, 300), base)).astype(np.uint64) for _ in range(90)]
    sets += [np.unique(rng.integers(0, 60, 40)).astype(np.uint64) for _ in range(20)]
    first = list(range(len(sets)))
    changed = True
    while changed:
        changed = False
        for i, x in enumerate(sets):
            for j, y in enumerate(sets):
                both = len(np.intersect1d(x, y))
                if 100 * both >= 85 * (len(x) + len(y) - both) and first[j] < first[i]:
                    first[i], changed = first[j], True
    assert ngram_join.linked_members(sets, 85).tolist() == first


def test_overlapping_pieces_apart(docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "MEET_ROWS", 5)
    rows = made(6, 80)
    assert ours(docs(rows).repartition(4)) == brute(rows)


def test_bitmaps_exclude_no_linked_set():
    rng = np.random.default_rng(2)
    excluded = 0
    for _ in range(300):
        n = int(rng.integers(1, 400))
        x = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        y = np.unique(np.where(rng.random(len(x)) < rng.choice([0.0, 0.05, 0.1, 0.5]), rng.integers(0, 1 << 62, len(x)).astype(np.uint64), x))
        y = np.concatenate([y, rng.integers(0, 1 << 62, int(rng.integers(0, n // 8 + 1))).astype(np.uint64)])
        a, b = (np.frombuffer(ngram_join.bitmap(s), np.uint8) for s in (x, y))
        w = min(len(a), len(b))
        maybe = ngram_join.possible(ngram_join.folded(a, w), len(x), ngram_join.folded(b, w)[None], np.array([len(y)]), 85)[0]
        both = len(np.intersect1d(x, y))
        assert maybe or 100 * both < 85 * (len(x) + len(y) - both)
        excluded += not maybe
    assert excluded > 50


def test_one_id_with_several_texts(docs):
    rng = random.Random(12)
    text = lambda: [f"w{rng.randrange(10_000)}" for _ in range(60)]
    near = lambda own: " ".join(own[:-1] + ["other"])
    a, b, c, d = (text() for _ in range(4))
    rows = [(5, " ".join(a)), (5, " ".join(b)), (7, near(b)), (6, near(a)), (9, " ".join(c)), (8, " ".join(c)), (8, " ".join(d)), (11, near(d)), (12, " ".join(text()))]
    assert ours(docs(rows)) == brute(rows)
    assert {r[0]: r[2] for r in ours(docs(rows))} == {5: 5, 6: 5, 7: 5, 8: 8, 9: 8, 11: 8, 12: 12}


def test_node_filter_admits_all_nodes(spark):
    nodes = spark.range(0, 50_000, 7).toDF("node")
    made_ = ngram_join.node_filter(nodes.repartition(5))
    inside = np.arange(0, 50_000, 7)
    assert ngram_join.admitted(inside, made_).all()
    assert ngram_join.admitted(np.arange(100_000, 200_000), made_).mean() < 0.02
    assert not ngram_join.admitted(inside, ngram_join.node_filter(nodes.filter("false"))).any()
