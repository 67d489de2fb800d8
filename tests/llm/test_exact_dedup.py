"""Exact de-duplication, beside the comparison with SQL."""

import hashlib

from newsatlas.llm.exact_dedup import exact_groups


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_edges(docs):
    rows = [
        (1, "Same"), (2, "sAME"), (3, "same "), (4, None), (5, ""), (6, "ÄB"), (7, "äb"), (8, "äB"),
        (9, "x" * 300_000), (10, "X" * 300_000), (11, "twice"), (11, "twice"), (None, "same"), (None, "alone"),
    ]
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(fold(text), []).append(doc_id)
    expected = []
    for doc_id, text in rows:
        members = groups[fold(text)]
        keep = max((m for m in members if m is not None), default=None)
        sha = hashlib.sha256(fold(text).encode()).hexdigest()
        expected.append((doc_id, keep, len(members), keep is None or doc_id == keep, sha))
    found = [tuple(r) for r in exact_groups(docs(rows)).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_many_copies_over_many_tasks(spark, docs):
    rows = [(i, "copy" if i % 3 else f"own {i}") for i in range(300)]
    found = exact_groups(docs(rows).repartition(23)).collect()
    assert {r["keep_id"] for r in found if r["group_size"] > 1} == {299}
    assert sum(r["kept"] for r in found) == 101


def test_empty_table(docs):
    assert exact_groups(docs([])).collect() == []
