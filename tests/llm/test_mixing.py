"""Targets and takes against plain versions."""

import random
import re

import pytest

from newsatlas.llm.mixing import apportioned, mixed_sources


def count(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, left, free = {}, float(sum(sizes.values())), set(names)
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > most * sizes[s]}
        if not over:
            out.update({s: weight[s] * level for s in free})
            break
        for s in over:
            out[s] = float(most * sizes[s])
            left -= out[s]
        free -= over
    return out


def check(rows, table, near):
    sizes = {}
    for _, text, source in table:
        sizes[source] = sizes.get(source, 0) + count(text)
    expected, taken = targets(sizes), {}
    assert sorted((r["doc_id"], r["size"]) for r in rows) == sorted((d, count(t)) for d, t, _ in table)
    source_of = {d: s for d, _, s in table}
    for r in rows:
        s = source_of[r["doc_id"]]
        assert r["source_size"] == sizes[s] and abs(r["target"] - expected[s]) < 1e-6 * max(1, expected[s])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
    for s, t in expected.items():
        assert abs(taken[s] - t) <= near + 0.01 * t, s


def test_whole_table(result, documents):
    check(result("op8_source_mix"), [(d, t, s) for d, t, _, s in documents], 200)


def test_reruns_agree(spark, result, sf_dir):
    from newsatlas.llm import queries

    again = queries.QUERIES["op8_source_mix"](spark, sf_dir)
    key = lambda r: r["doc_id"]
    assert sorted((r.asDict() for r in again.collect()), key=key) == sorted(result("op8_source_mix"), key=key)


def test_edges(docs):
    table = [
        (1, "a " * 900, "z"), (2, "b " * 20, "a"), (3, None, "a"), (4, "", ""), (5, "c\x0bd\x0ce", None), (6, "d " * 5000, "퟿"),
        (7, "e " * 70, "\U0001f600"), (8, "f g", "Z"),
    ]
    rows = [r.asDict() for r in mixed_sources(docs(table), shard_rows=1, block=1).collect()]
    check(rows, table, 8)


def test_many_shards(docs):
    rng = random.Random(2)
    table = [(i, "w " * rng.randint(0, 60), f"s{i % 3}" if i % 2 else "hot") for i in range(900)]
    rows = [r.asDict() for r in mixed_sources(docs(table), shard_rows=50, block=8).collect()]
    check(rows, table, 150)


def test_repeated_rows_and_empty(docs):
    rows = mixed_sources(docs([(1, "a b c", "x"), (1, "a b c", "x"), (None, "d", "x")]), block=1).collect()
    assert sorted((r["doc_id"] or 0, r["size"], r["taken"]) for r in rows) == [(0, 1, 1), (1, 3, 3), (1, 3, 3)]
    assert mixed_sources(docs([])).collect() == []
    assert [r["taken"] for r in mixed_sources(docs([(1, None, None)])).collect()] == [0]


def highest_quotients(votes, seats):
    given = [0] * len(votes)
    for _ in range(seats):
        best = max(range(len(votes)), key=lambda i: (votes[i] / (2 * given[i] + 1), -i))
        if votes[best] <= 0:
            break
        given[best] += 1
    return given


@pytest.mark.parametrize("seed", range(3))
def test_sainte_lague(spark, seed):
    rng = random.Random(seed)
    rows, expected = [], {}
    for g in range(4):
        votes = [rng.choice([0, 1, rng.randint(1, 30), rng.randint(1, 5000)]) for _ in range(rng.randint(1, 12))]
        seats = rng.choice([0, 1, 7, 200])
        for i, s in enumerate(highest_quotients(votes, seats)):
            rows.append((g, i, votes[i], seats))
            expected[g, i] = s
    frame = spark.createDataFrame(rows, "g int, name int, votes long, seats long")
    found = apportioned(frame, ["g"], "name", "votes", "seats", "won").collect()
    assert {(r["g"], r["name"]): r["won"] for r in found} == expected
