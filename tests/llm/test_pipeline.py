"""The pipeline's stages against brute force over the same documents."""

import random

import pytest

import corpus_pipeline
from newsatlas.llm.queries import tokenizer_path

from .test_exact_dedup import fold
from .test_ngram_join import brute as near_groups
from .test_packing import check as check_packing


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """The frames after each stage, as rows."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        path = str(folder / name.replace(" ", "-"))
        frame = stage(spark, docs, sf_dir)
        if stage is not corpus_pipeline.pack:
            assert frame.columns == docs.columns
        frame.write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs.collect())
    return out


def test_quality_stage(stages, duck):
    before, after = stages[0], stages[1]
    labels = dict(duck.execute("SELECT doc_id, quality FROM labels").fetchall())
    kept = {r["doc_id"] for r in after}
    assert set(after) <= set(before) and 0 < len(after) < len(before)
    good = [d in kept for d, q in labels.items() if q]
    bad = [d in kept for d, q in labels.items() if not q]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.25 * len(bad)


def test_exact_stage(stages):
    last = {}
    for r in stages[1]:
        last[fold(r["text"])] = max(r["doc_id"], last.get(fold(r["text"]), -1))
    assert sorted(stages[2]) == sorted(r for r in stages[1] if last[fold(r["text"])] == r["doc_id"])


def test_near_stage(stages):
    kept = {d for d, _, c in near_groups([(r["doc_id"], r["text"]) for r in stages[2]]) if d == c}
    assert sorted(stages[3]) == sorted(r for r in stages[2] if r["doc_id"] in kept)


def test_mix_stage(stages):
    before = {r["doc_id"]: r for r in stages[3]}
    times = {}
    for r in stages[4]:
        whole = before[r["doc_id"]]
        assert (r["lang"], r["source"]) == (whole["lang"], whole["source"])
        if r["text"] == whole["text"]:
            assert r["n_chars"] == whole["n_chars"]
        else:
            own = r["text"].split(" ")
            assert whole["text"].split()[: len(own)] == own and r["n_chars"] == len(r["text"])
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    assert max(times.values()) <= 3 and min(times.values()) >= 1
    words = lambda rows: sum(len(r["text"].split()) for r in rows)
    assert abs(words(stages[4]) - words(stages[3])) < 0.02 * words(stages[3]) + 500


def test_pack_stage(stages):
    from tokenizers import Tokenizer

    # Repeats have one id: they are told apart by their place in turn.
    tokenizer = Tokenizer.from_file(tokenizer_path())
    ids = sum(len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1 for r in stages[4])
    assert sum(r["length"] for r in stages[5]) == ids
    places = {}
    for r in stages[5]:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in places.values():
        own.sort()
        ends = [0, *(o + n for o, n in own)]
        assert [o for o, _ in own] == ends[:-1] and ends[-1] <= 2048
    once = {r["doc_id"] for r in stages[4]} - {d for d, n in _counted(stages[4]).items() if n > 1}
    texts = {r["doc_id"]: r["text"] for r in stages[4] if r["doc_id"] in once}
    alone = [r.asDict() for r in stages[5] if r["doc_id"] in once]
    pieces = {(r["doc_id"], r["piece"]) for r in alone}
    assert len(pieces) == len(alone) and {d for d, _ in pieces} == set(texts)


def _counted(rows):
    out = {}
    for r in rows:
        out[r["doc_id"]] = out.get(r["doc_id"], 0) + 1
    return out


def test_run_is_the_stages(spark, sf_dir, stages):
    key = lambda r: (r["doc_id"], r["piece"], r["length"], r["ids_crc32"])
    assert sorted(map(key, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(key, stages[5]))


def test_stages_stand_odd_rows(spark, sf_dir):
    """Nulls, empty and repeated rows, no rows, and other columns of clashing names."""
    rng = random.Random(1)
    long = " ".join(rng.choice(["alpha", "beta", "gamma"]) + str(i % 900) for i in range(40_000))
    text = "Some plain words that make a text. They end here, and then they go on for a while."
    rows = [
        (1, None, "en", None, None), (2, "", None, "s", 0), (3, text, "en", "s", 9), (3, text, "en", "s", 9), (4, text.upper(), "en", "s", 9),
        (None, text + " more", "en", None, 1), (None, None, None, None, None), (5, long, "en", "t", 1), (6, " \n ", "de", "t", 3),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, id long, sha string, size long, row string, words int, taken long"
    wide = spark.createDataFrame([(*r, 1, "x", 2, "y", 3, 4) for r in rows], schema)
    for docs in (wide, wide.filter("false")):
        for _, stage in corpus_pipeline.STAGES:
            frame = stage(spark, docs, sf_dir)
            if stage is corpus_pipeline.pack:
                assert frame.count() >= docs.count()
            else:
                assert frame.columns == docs.columns and frame.count() <= 3 * len(rows)
    kept = corpus_pipeline.exact(spark, wide, sf_dir).collect()
    assert sorted((r["doc_id"] or 0) for r in kept) == [0, 4, 5, 6, 2] or sorted((r["doc_id"] or 0) for r in kept) == [0, 2, 4, 5, 6]


def test_packing_check_is_used(docs):
    from newsatlas.llm.packing import packed
    from tokenizers import Tokenizer

    texts = {1: "a b", 2: "c"}
    rows = [r.asDict() for r in packed(docs(list(texts.items())), tokenizer_path()).collect()]
    assert check_packing(rows, texts, Tokenizer.from_file(tokenizer_path())) == 1


def test_mix_takes_repeated_rows_as_often_as_all_of_them(spark, sf_dir):
    """Equal rows with different takes: the words that come out are those that were taken, not more."""
    from newsatlas.llm.mixing import mixed_sources

    text = " ".join(f"w{i}" for i in range(200))
    rows = [(1, text, None, "a")] * 5 + [(2, "one two three " * 40, "en", "b"), (3, "x", "en", None), (4, "x", None, "en"), (1, text, "en", "a")]
    wide = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    taken = {}
    for r in mixed_sources(wide).collect():
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + r["taken"]
    out = {}
    for r in corpus_pipeline.mix(spark, wide, sf_dir).collect():
        assert (r["doc_id"], r["lang"], r["source"]) in {(d, n, s) for d, _, n, s in rows}
        out[r["doc_id"]] = out.get(r["doc_id"], 0) + len(r["text"].split())
    assert out == {d: n for d, n in taken.items() if n} and any(n % 200 for n in taken.values())
