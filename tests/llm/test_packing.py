"""Packed sequences: whole tokens, no gaps, no overlaps, and few sequences."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from newsatlas.llm.packing import OpenBins, WordIds, packed
from newsatlas.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def check(rows, texts, tokenizer, length=2048):
    """Every document's pieces are its ids, and every sequence is filled from 0; returns the number of sequences."""
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append(r)
    for places in sequences.values():
        places.sort()
        ends = [0, *(o + n for o, n in places)]
        assert [o for o, _ in places] == ends[:-1] and ends[-1] <= length
    assert set(pieces) == set(texts)
    for doc_id, own in pieces.items():
        ids = np.array(tokenizer.encode(texts[doc_id] or "", add_special_tokens=False).ids + [0], "<u4")
        own.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(-(-len(ids) // length)))
        for k, r in enumerate(own):
            part = ids[k * length : (k + 1) * length]
            assert (r["start"], r["length"], r["ids_crc32"]) == (k * length, len(part), zlib.crc32(part.tobytes()))
    return len(sequences)


def test_whole_table(result, documents, tokenizer):
    rows = result("op2_best_fit_packing")
    number = check(rows, {r[0]: r[1] for r in documents}, tokenizer)
    least = -(-sum(r["length"] for r in rows) // 2048)
    assert number <= 1.02 * least + 2


def test_edges(docs, tokenizer):
    texts = {
        1: None, 2: "", 3: " \n ", 4: "word " * 2047, 5: "word " * 2048, 6: "word " * 9000, 7: "<|endoftext|> a<|endoftext|>b",
        8: "Dont split here é ́x ΑΣ ΑΣ. it's I'LL \x1c \x85 z", 9: "日本語 12345 ½ ²",
    }
    rows = [r.asDict() for r in packed(docs(list(texts.items())).repartition(3), tokenizer_path()).collect()]
    check(rows, texts, tokenizer)


def test_bins_of_tasks_are_joined(docs, tokenizer):
    texts = {i: "word " * 100 for i in range(40)}
    rows = [r.asDict() for r in packed(docs(list(texts.items())).repartition(20), tokenizer_path()).collect()]
    assert check(rows, texts, tokenizer) == 2


def test_repeated_rows_and_null_id(docs):
    rows = packed(docs([(1, "a b"), (1, "a b"), (None, "c")]), tokenizer_path()).collect()
    assert sorted((r["doc_id"] or -1, r["length"]) for r in rows) == [(-1, 2), (1, 3), (1, 3)]


def test_empty_table(docs):
    assert packed(docs([]), tokenizer_path()).collect() == []


def test_best_fit_and_closing():
    bins = OpenBins(10, 2)
    assert bins.put(6) == (0, 0) and bins.put(7) == (1, 0)
    assert bins.put(3) == (1, 7)  # fits both; the fuller one is taken, and closes as it is full
    assert bins.put(9) == (2, 0)
    assert bins.put(8) == (3, 0)  # a third open bin: the fullest, of 9, closes first
    assert bins.put(1) == (3, 8)
    assert bins.put(4) == (0, 6)


def test_words_learnt_together_have_the_ids_they_have_alone(tokenizer):
    rng = np.random.default_rng(3)
    letters = list("abcxyzéßñΣςİıǅﬁ한가日ℌ̈́")
    words = {"".join(rng.choice(letters, rng.integers(1, 9))) for _ in range(4000)} | {"ΑΣ", "İ", "don't", "x1", "é"}
    known = WordIds(tokenizer_path())
    known.learn({w.encode() for w in words})
    for w in words:
        assert np.frombuffer(known.known[w.encode()], "<u4").tolist() == tokenizer.encode(w, add_special_tokens=False).ids, w
