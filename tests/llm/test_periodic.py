"""Periodic runs against a brute-force version."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from newsatlas.llm.periodic import Paths, periodic_runs, runs_in, runs_of, suffix_automaton


def brute(words, least=6, periods=4):
    """Every period by comparing all words that far apart; runs with a smaller one left out."""
    out, n = [], len(words)
    numbers = {}
    words = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    for q in range(1, n // periods + 1):
        same = np.concatenate([[0], words[q:] == words[:-q], [0]])
        edges = np.flatnonzero(np.diff(same))
        for i, j in zip(edges[::2].tolist(), edges[1::2].tolist()):
            length = j - i + q
            if length >= max(least, periods * q):
                own = words[i : i + length]
                if not any((own[d:] == own[:-d]).all() for d in range(1, q)):
                    out.append((i, length, q))
    return sorted(out)


def collapse(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def made(rng, size, letters, longest):
    words = []
    while len(words) < size:
        period = [rng.choice(letters) for _ in range(rng.randint(1, longest))]
        words += (period * rng.randint(1, 7))[: rng.randint(1, 6 * longest)]
        words += [rng.choice(letters) for _ in range(rng.randint(0, 4))]
    return words


def test_runs_of_made_words():
    rng = random.Random(1)
    for _ in range(500):
        words = made(rng, rng.randint(0, 60), "abc"[: rng.randint(1, 3)], 12)
        expected = brute(words)
        assert runs_of(words) == expected
        assert runs_in([[w.encode() for w in words], [], [b"x"]]) == [expected, [], []]
    for _ in range(20):
        words = made(rng, 800, [str(i) for i in range(30)], 80)
        assert runs_in([[w.encode() for w in words]] * 2) == [brute(words)] * 2


def test_other_thresholds():
    words = made(random.Random(2), 300, "ab", 9)
    assert runs_of(words, 4, 3) == brute(words, 4, 3) == runs_in([[w.encode() for w in words]], 4, 3)[0]
    with pytest.raises(ValueError):
        periodic_runs(None, periods=2)


def test_automaton_and_paths():
    words = made(random.Random(3), 200, "ab", 7)
    link, length, prefixes = suffix_automaton(words)
    distinct = {tuple(words[i:j]) for i in range(len(words)) for j in range(i + 1, len(words) + 1)}
    assert sum(length[s] - length[link[s]] for s in range(1, len(link))) == len(distinct)
    paths, last = Paths(link), {}
    for i, state in enumerate(prefixes):
        met = paths.access(state, i)
        node, before = state, []
        while node >= 0:
            before.append((node, last.get(node, -1)))
            last[node] = i
            node = link[node]
        # The deepest node of each stretch of one colour, from the state up.
        deepest = [b for k, b in enumerate(before) if k == 0 or before[k - 1][1] != b[1]]
        assert {c: n for n, c in reversed(met) if c >= 0} == {c: n for n, c in reversed(deepest) if c >= 0}


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_whole_table(result, documents):
    found = {r["doc_id"]: r for r in result("op13_periodic_runs")}
    assert len(found) == len(documents)
    seen = 0
    for doc_id, text, *_ in documents:
        words = planted(doc_id, split(text))
        runs, r = brute(words), found[doc_id]
        best = min(runs, key=lambda x: (-x[1] * 10**9 // x[2], x[0], x[2]), default=(None,) * 3)
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        lines = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
        assert r["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(" ".join(collapse(words, runs)).encode()).hexdigest()
        seen += bool(runs)
    assert seen > 5


def test_edges(docs):
    texts = ["a b " * 4, None, "", " \t\n", "a " * 5, "a " * 6, "x", " ".join(map(str, range(900))) + " " + "p q r " * 40]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (5, texts[5]), (5, "b")]
    expected = sorted(
        ((i, len(split(t)), brute(split(t)), " ".join(collapse(split(t), brute(split(t))))) for i, t in rows), key=repr
    )
    found = periodic_runs(docs(rows)).collect()
    assert sorted(((r[0], r[1], [tuple(x) for x in r[2]], r[3]) for r in found), key=repr) == expected
    assert periodic_runs(docs([])).collect() == []


def test_very_long_text(docs):
    words = [f"v{i}" for i in range(3000)] + [f"w{i % 7000}" for i in range(40_000)] + ["z"] * 9
    [r] = periodic_runs(docs([(1, " ".join(words))])).collect()
    assert [tuple(x) for x in r["runs"]] == [(3000, 40_000, 7000), (43_000, 9, 1)]
    assert len(r["collapsed_text"].split()) == 3000 + 7000 + 1
