"""Quality scores by held-out accuracy, and their edges."""

import zlib

import numpy as np

from newsatlas.llm.quality import FEATURES, fit, quality_scores, scored, statistics


def test_held_out_accuracy(result, documents, duck):
    quality = dict(duck.execute("SELECT doc_id, quality FROM labels").fetchall())
    rows = result("op7_quality")
    assert sorted(r["doc_id"] for r in rows) == sorted(d for d, *_ in documents)
    good, bad = [], []
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
        if r["held_out"] and r["doc_id"] in quality:
            (good if quality[r["doc_id"]] else bad).append(r["predicted"])
    assert np.mean(good) > 0.95 and (len(bad) < 20 or np.mean(bad) < 0.1)


def test_statistics_are_finite():
    for text in (None, b"", b" ", b"a", b"!" * 10_000, b"a b " * 100_000, "ß".encode() * 9, b"\n\n\n", b"x\ny\nx"):
        values = statistics(text)
        assert len(values) == len(FEATURES) and np.isfinite(values).all()


def test_edges(spark, docs):
    rows = [(1, None), (2, ""), (3, "A fine text. It ends."), (3, "A fine text. It ends."), (None, "x"), (4, "w " * 100_000)]
    labels = spark.createDataFrame([(3, 1), (4, 0), (4, 0), (None, 1), (1, None), (2, 7)], "doc_id long, quality int")
    found = quality_scores(docs(rows), labels).collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found)
    none = quality_scores(docs(rows), labels.filter("false")).collect()
    assert all(abs(r["score"] - 0.5) < 1e-9 for r in none)
    assert quality_scores(docs([]), labels).collect() == []


def test_separated_classes(spark):
    rng = np.random.default_rng(3)
    k = len(FEATURES)
    rows = [(i, (rng.normal(size=k) * (1 + 2 * (i % 2)) + 3 * (i % 2)).tolist(), i % 2) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, x array<double>, quality int")
    model = fit(frame)
    right = [(r["score"] > 0.5) == bool(r["doc_id"] % 2) for r in scored(frame, model).collect()]
    assert np.mean(right) > 0.98
    x = np.array([r[1] for r in rows if r[2]])
    assert np.allclose(model.means[1] * model.scale + model.centre, x.mean(axis=0))


def test_scores_equal_brute_force(result, documents, duck):
    """Every document's posterior, from covariances by definition and densities by a solver instead of factors."""
    from newsatlas.llm.quality import SHRINK_TO_DIAGONAL, SHRINK_TO_POOLED

    quality = dict(duck.execute("SELECT doc_id, min(quality) FROM labels WHERE quality IN (0, 1) GROUP BY doc_id").fetchall())
    x = {d: np.array(statistics((t or "").encode() if t is not None else None)) for d, t, *_ in documents}
    learnt = [d for d in x if d in quality and zlib.crc32(str(d).encode()) % 5 != 0]
    own = [np.array([x[d] for d in learnt if quality[d] == c]) for c in (0, 1)]
    assert min(map(len, own)) > 3
    everything = np.concatenate(own)
    centre, scale = everything.mean(axis=0), np.sqrt(np.maximum(everything.var(axis=0), 1e-6))
    own = [(o - centre) / scale for o in own]
    spread = [np.cov(o.T, bias=True) for o in own]
    common = sum(len(o) * s for o, s in zip(own, spread)) / len(everything)
    common = (1 - SHRINK_TO_DIAGONAL) * common + SHRINK_TO_DIAGONAL * np.diag(np.diag(common)) + 0.01 * np.eye(len(FEATURES))
    spread = [(1 - SHRINK_TO_POOLED) * s + SHRINK_TO_POOLED * common + 1e-6 * np.eye(len(FEATURES)) for s in spread]

    def density(z, c):
        d = z - own[c].mean(axis=0)
        prior = np.log((len(own[c]) + 1) / (len(everything) + 2))
        return prior - 0.5 * np.linalg.slogdet(spread[c])[1] - 0.5 * d @ np.linalg.solve(spread[c], d)

    for r in result("op7_quality"):
        z = (x[r["doc_id"]] - centre) / scale
        expected = 1 / (1 + np.exp(np.clip(density(z, 0) - density(z, 1), -700, 700)))
        assert np.isclose(r["score"], expected, atol=1e-6)
