"""Benchmark decontamination against a brute-force version."""

import hashlib
import random
import re

import pytest

from newsatlas.llm import decontaminate
from newsatlas.llm.decontaminate import benchmark_hits


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)], lower


def brute(rows, items, window=10):
    keys = {}
    for item, text in items:
        places, lower = words(text)
        own = [lower[a:b] for a, b in places]
        for i in range(max(1, len(own) - window + 1) if own else 0):
            keys.setdefault(tuple(own[i : i + window]), set()).add(item)
    out = []
    for doc_id, text in rows:
        places, lower = words(text)
        own = [lower[a:b] for a, b in places]
        hit, found = set(), set()
        for size in {len(k) for k in keys}:
            for i in range(len(own) - size + 1):
                if (key := tuple(own[i : i + size])) in keys:
                    hit.update(range(i, i + size))
                    found |= keys[key]
        spans, at = [], sorted(hit)
        for i in at:
            if spans and spans[-1][1] == i:
                spans[-1][1] = i + 1
            else:
                spans.append([i, i + 1])
        spans = [(a, b - a, places[a][0], places[b - 1][1]) for a, b in spans]
        out.append((doc_id, len(own), len(hit), sorted(str(f) for f in found if f is not None), spans))
    return sorted(out, key=repr)


def ours(docs, items, **more):
    found = benchmark_hits(docs, items, **more).collect()
    return sorted(((r[0], r[1], r[2], r[3], [tuple(s) for s in r[4]]) for r in found), key=repr)


@pytest.fixture
def items(spark):
    return lambda rows: spark.createDataFrame([(*r, 1, "x") for r in rows], "item_id string, text string, doc_id long, spans string")


def test_whole_table(result, documents, duck):
    items = duck.execute("SELECT item_id, text FROM benchmark").fetchall()
    expected = {
        d: (n, hit, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), hit > 0)
        for d, n, hit, ids, _ in brute([r[:2] for r in documents], items)
    }
    columns = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert {r["doc_id"]: tuple(r[c] for c in columns) for r in result("op11_decontamination")} == expected
    assert any(v[-1] for v in expected.values())


@pytest.mark.parametrize("most_bytes", [2_000_000, 300])
def test_made_texts(docs, items, most_bytes):
    rng = random.Random(3)
    word = lambda: rng.choice(["a", "b", "Ab", "é", "ÀB", "7", "ß9", "日本"])
    tests = [(str(i % 25) if i else None, " ".join(word() for _ in range(rng.choice([0, 1, 3, 9, 10, 11, 30])))) for i in range(40)]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(rng.randint(0, 5)):
            own = rng.choice(tests)[1].split()
            a = rng.randint(0, len(own))
            parts.append(rng.choice([" ", "\n--", "..."]).join(own[a : a + rng.randint(1, 25)]))
            parts.append(" ".join(f"x{rng.randint(0, 9)}" for _ in range(rng.randint(0, 6))))
        rows.append((rng.choice([i, 5, None]), rng.choice(["", "¿"]) + rng.choice([", ", "\t"]).join(parts).upper()))
    rows += [(None, None), (3, ""), (3, " .,-"), (4, "\x00\x7f")]
    tests += [("none", None), ("empty", ""), ("signs", "?!")]
    tests = [t for t in tests if len((t[1] or "").split()) != 1]
    assert ours(docs(rows), items(tests), most_bytes=most_bytes) == brute(rows, tests)


def test_long_items_in_pieces_and_texts_in_segments(docs, items, monkeypatch):
    rng = random.Random(4)
    item = [f"q{rng.randint(0, 5000)}" for _ in range(4000)]
    text = []
    for _ in range(30):
        a = rng.randint(0, 3900)
        text += item[a : a + rng.randint(5, 60)] + ["z"] * rng.randint(0, 20)
    monkeypatch.setattr(decontaminate, "SEGMENT", 100)
    automaton = decontaminate.Automaton([("i", [w.encode() for w in item])], 10)
    n, spans, seen = automaton.scan(" ".join(text).encode())
    expected = brute([(1, " ".join(text))], [("i", " ".join(item))])[0]
    assert (n, sum(b - a for a, b in decontaminate.merged(spans)), sorted(seen)) == expected[1:4]
    assert ours(docs([(1, " ".join(text))]), items([("i", " ".join(item))]), most_bytes=5000) == [expected]


def test_empty_tables_and_own_types(spark, docs, items):
    assert ours(docs([]), items([("a", "b c")])) == []
    assert ours(docs([(1, "b c")]), items([])) == [(1, 2, 0, [], [])]
    tests = spark.createDataFrame([(10, "b c"), (9, "c")], "item_id int, text string")
    assert ours(docs([(1, "A b-C")]), tests) == [(1, 3, 2, ["10", "9"], [(1, 2, 2, 5)])]


def test_other_window(docs, items):
    tests = [("a", "one two three four")]
    assert ours(docs([(1, "x two three y one")]), items(tests), window=2) == brute([(1, "x two three y one")], tests, 2)
    with pytest.raises(ValueError):
        benchmark_hits(docs([]), items([]), window=0)
