"""Spelling variants against a brute-force version."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from newsatlas.llm import spelling
from newsatlas.llm.spelling import near_words, roots, spelling_variants, vocabulary


def words_of(rows, one_in=199, least=5):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if one_in and doc_id is not None and h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= least}


def near(words):
    """All words one edit away, by deleting a letter, or holding one open."""
    holes = {}
    for w in words:
        for i in range(len(w)):
            holes.setdefault((w[:i], w[i + 1 :]), set()).add(w)
    out = {w: set() for w in words}
    for w in words:
        for i in range(len(w)):
            out[w] |= holes[w[:i], w[i + 1 :]] - {w}
            if (less := w[:i] + w[i + 1 :]) in out:
                out[w].add(less)
                out[less].add(w)
    return out


def brute(words):
    found, out = near(words), {}
    form = {}
    for w, n in words.items():
        best = min(found[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (n, len(found[w]), form[w], words.get(form[w]), root)
    return out


def ours(frame):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in frame.collect()}


@pytest.fixture
def table(spark):
    return lambda words: spark.createDataFrame([(w, n, "x", 1) for w, n in words.items()], "word string, n long, near string, length int")


def made(rng, size, letters="abéÿ", lengths=(1, 9)):
    words = {}
    while len(words) < size:
        w = "".join(rng.choice(letters) for _ in range(rng.randint(*lengths)))
        words[w] = rng.choice([5, 6, 25, 30, 125, 130, 700, 4000])
    return words


def test_whole_table(result, documents):
    expected = brute(words_of([r[:2] for r in documents]))
    rows = result("op12_spelling_variants")
    assert {r["word"]: tuple(r[c] for c in ("n", "n_near", "form", "form_n", "root")) for r in rows} == expected
    assert len(rows) == len(expected) and any(v[1] for v in expected.values())


@pytest.mark.parametrize("bounds", [{}, {"part_words": 100}, {"part_words": 50, "most_bytes": 600}])
def test_made_words(table, bounds):
    words = made(random.Random(7), 1200)
    expected = brute(words)
    assert ours(spelling_variants(table(words), **bounds)) == expected
    assert any(v[4] not in (w, v[2]) for w, v in expected.items())  # chains of forms


def test_ties_long_words_and_empty(spark, table):
    long = "q" * 3000
    words = {"abcdef": 5, "abcdeg": 25, "abcdeh": 25, long: 50, long + "q": 7, long[:-1] + "z": 9, "ébcdef": 5}
    assert ours(spelling_variants(table(words))) == brute(words)
    assert ours(spelling_variants(table({}))) == {}
    odd = spark.createDataFrame([("abcdef", 5), (None, 9), ("", 9), ("ab日def", 50), ("abcdex", None)], "word string, n long")
    assert ours(spelling_variants(odd)) == {"abcdef": (5, 0, None, None, "abcdef")}


def test_pairs_come_once(table):
    words = made(random.Random(8), 400, "ab", (1, 10))
    pairs = [(r["word"], r["near"]) for r in near_words(table(words)).collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(w, v) for w, near_ in near(words).items() for v in near_}


def test_chains(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(9)] + [("x", "w9"), ("y", "z")], "word string, form string")
    assert {tuple(r) for r in roots(forms).collect()} == {(f"w{i}", "w9") for i in range(9)} | {("x", "w9"), ("y", "z")}
    assert roots(forms.filter("false")).collect() == []


def test_vocabulary(docs):
    rows = [(i, "Wörter Strasse straSSE naïveté-naïveté abc×def ÀÉÎÕÜß日本語 kleine") for i in range(400)]
    rows += [(None, "kleine strasse"), (3, None), (3, ""), (7, "kleine"), (7, "x" * 5000)]
    for one_in in (None, 7, 199):
        found = {r["word"]: r["n"] for r in vocabulary(docs(rows), typo_one_in=one_in).collect()}
        assert found == words_of(rows, one_in)


def test_filters_admit_all_words():
    rng = np.random.default_rng(1)
    words = np.unique(rng.choice(spelling.ALPHABET, (20_000, 8)), axis=0)
    h = spelling.word_sums(words)
    parts = spelling.part_of(h, 3)
    blocks = spelling.blocks_for(len(h), 3)
    assert blocks == 512 and spelling.blocks_for(1, 1) == 1 and spelling.blocks_for(10**9, 1) == spelling.PART_BLOCKS
    held = spelling.Filters({8: (3, blocks)}, {(8, p): spelling.zlib.compress(spelling.filter_of(h[parts == p], blocks).tobytes()) for p in range(3)})
    assert held.admits(8, h).tolist() == list(range(len(h)))
    other = spelling.word_sums(rng.choice(spelling.ALPHABET, (200_000, 8)))
    assert len(held.admits(8, other)) < 200
    assert held.admits(9, h).tolist() == []
