"""Language identification by held-out accuracy, and its edges."""

import zlib

import numpy as np

from newsatlas.llm.language import identified, ngram_buckets, score, train


def test_held_out_accuracy(result, documents):
    lang = {d: language for d, _, language, _ in documents}
    text = {d: t for d, t, _, _ in documents}
    rows = result("op4_language_id")
    assert sorted(r["doc_id"] for r in rows) == sorted(lang)
    good = total = 0
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
        letters = any(map(str.isalpha, text[r["doc_id"]] or ""))
        assert (r["lang_pred"] == "und") == (not letters)
        if r["held_out"] and letters:
            total += 1
            good += r["lang_pred"] == lang[r["doc_id"]]
    assert total and good / total > 0.95


def test_counts_are_right(spark):
    rows = [("Ab a", "x"), ("b", "y"), (None, "x"), ("q", None)]
    model = train(spark.createDataFrame(rows, "text string, lang string"), orders=(1, 2), buckets=1 << 12, smoothing=1.0)
    assert model.classes == ("x", "y")
    total = sum(len(h) for h, _ in ngram_buckets(["Ab a"], (1, 2), 1 << 12))
    assert np.isclose(np.exp(model.logs[:, 0]).sum(), 1)
    assert np.isclose(np.exp(model.logs[:, 0]).max() * (total + (1 << 12)), 1 + 4)  # the space, four times


def test_neighbours_dont_matter():
    a = ngram_buckets(["one two"], (1, 2, 3), 1 << 16)
    b = ngram_buckets(["zzz", "one two", ""], (1, 2, 3), 1 << 16)
    for (h, _), (g, starts) in zip(a, b):
        assert h.tolist() == g[starts[1] : starts[2]].tolist()


def test_edges(spark, docs):
    model = train(spark.createDataFrame([("the the of", "en"), ("der die das", "de")], "text string, lang string"))
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, "THE OF"), (5, "der " * 50_000), (5, "der"), (None, "die"), (6, "²½")]
    found = sorted((r["doc_id"] or -1, r["lang_pred"]) for r in identified(docs(rows), model).collect())
    assert found == [(-1, "de"), (1, "und"), (2, "und"), (3, "und"), (4, "en"), (5, "de"), (5, "de"), (6, "und")]
    assert identified(docs([]), model).collect() == []


def test_no_rows_to_learn_from(spark, docs):
    model = train(spark.createDataFrame([], "text string, lang string"))
    assert [tuple(r) for r in identified(docs([(1, "word")]), model).collect()] == [(1, "und", 0.0)]
    assert score([], model)[0] == []


def plain_buckets(text, orders, buckets):
    """The buckets of a text's n-grams, one by one."""
    mask = (1 << 64) - 1

    def mixed_(h):
        h ^= h >> 31
        h = h * 0xBF58476D1CE4E5B9 & mask
        h ^= h >> 29
        h = h * 0x94D049BB133111EB & mask
        return h ^ (h >> 32)

    block = f" {text.lower()}" + " " * max(orders)
    codes = [c if c >= 128 or 97 <= c <= 122 else 32 for c in map(ord, block)]
    out = []
    for n in orders:
        for i in range(len(codes) - n + 1):
            key = 0
            for c in codes[i : i + n]:
                key = (key * (1 << 21) + c) & mask
            out.append((mixed_(key + n & mask) >> 40) % buckets)
    return out


def test_probabilities_equal_brute_force(result, documents):
    """Every held-out document's posterior, from counts in plain dictionaries."""
    orders, buckets = (1, 2, 3), 1 << 16
    counts, held = {}, []
    for doc_id, text, lang, _ in documents:
        if zlib.crc32(str(doc_id).encode()) % 4 == 2:
            held.append((doc_id, text or ""))
        elif text is not None and lang is not None:
            own = counts.setdefault(lang, {})
            for b in plain_buckets(text, orders, buckets):
                own[b] = own.get(b, 0) + 1
    totals = {lang: sum(own.values()) + 0.5 * buckets for lang, own in counts.items()}
    found = {r["doc_id"]: r for r in result("op4_language_id")}
    short = [h for h in held if len(h[1]) < 2000]
    assert len(short) > 20
    for doc_id, text in short:
        logs = {lang: 0.0 for lang in counts}
        for b in plain_buckets(text, orders, buckets):
            for lang, own in counts.items():
                logs[lang] += np.log((own.get(b, 0) + 0.5) / totals[lang])
        best = max(sorted(logs), key=logs.get)
        if any(map(str.isalpha, text)):
            assert found[doc_id]["lang_pred"] == best
            assert np.isclose(found[doc_id]["score"], 1 / sum(np.exp(v - logs[best]) for v in logs.values()), atol=1e-9)
