"""Substring de-duplication by fixed-block anchors.

Every text of words is divided into blocks of half a window; these are indexed under their hash and probed with every rolling
run of that length. Any window that comes again holds a whole block of its earlier place, so that no repeat is
missed. Around each hit the windows that contain it are compared, which extends hits to maximal exact repeats.

Nothing is paired. A hash needs to be told only whether another place has it, and a window only its earliest place, so
that a passage in a third of all documents costs what any other text of its length does: tasks merge
their own repeats first and send one place for each hash.

Hashes travel as packed arrays, a row for each block of documents and each share of the hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import chunks, mixed, partitions, rolled, ship, word_hashes, words_of

WINDOW = 20
#: Bytes of text in a share, about.
SHARE_BYTES = 64 << 20
_NULL_ID = np.iinfo(np.int64).min  # stands for a null doc_id, before all others


def _planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers byte plane by byte plane: those of small numbers are almost all zero, and compress."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.frombuffer(planes, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)


def pack_places(doc: np.ndarray, pos: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Places, sorted by (doc, pos), as documents, their numbers of places, and gaps between these."""
    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, np.int64)
    gaps = np.diff(pos, prepend=0)
    gaps[first] = pos[first]
    sizes = np.diff(np.append(first, len(doc)))
    return doc[first].astype("<i8").tobytes(), _planes(sizes), _planes(gaps)


def unpack_places(docs: bytes, sizes: bytes, gaps: bytes) -> tuple[np.ndarray, np.ndarray]:
    sizes, gaps = _numbers(sizes), _numbers(gaps)
    total = np.cumsum(gaps)
    first = np.cumsum(sizes) - sizes
    base = total[first] - gaps[first]
    return np.repeat(np.frombuffer(docs, "<i8"), sizes), total - np.repeat(base, sizes)


class Words:
    """The words of some documents, one after the other, in order of (doc_id, text); null ids come first."""

    def __init__(self, rows: list[tuple], keep: bool = False):
        rows = sorted((_NULL_ID if i is None else i, i is not None, t or b"") for i, t in rows)
        split = [words_of(t) for *_, t in rows]
        self.ids = np.array([i for i, *_ in rows], np.int64)
        self.named = [named for _, named, _ in rows]  # the least long is an id too
        self.sizes = np.fromiter(map(len, split), np.int64, len(split))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.split = split if keep else None
        self.hashes = word_hashes([w for words in split for w in words])
        self.owner = np.repeat(np.arange(len(split), dtype=np.int32), self.sizes)
        self.place = np.arange(len(self.hashes)) - self.starts[self.owner]

    def runs(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts, among all words, of the runs of ``n`` words within one document, and their hashes."""
        h = rolled(self.hashes, n)
        at = np.flatnonzero(self.place[: len(h)] + n <= self.sizes[self.owner[: len(h)]])
        return at, h[at]


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A stable order by key, the first place in it of each group, and the groups' sizes."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return order, first, np.diff(np.append(first, len(keys)))


_PARCEL = "share int, kind int, docs binary, sizes binary, gaps binary, keys binary"
_PARCEL_TYPES = pa.schema(
    [("share", pa.int32()), ("kind", pa.int32()), *((c, pa.binary()) for c in ("docs", "sizes", "gaps", "keys"))]
)
_PROBE, _FOUND = 0, 1


def _parcels(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(_PARCEL_TYPES)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PARCEL_TYPES)], schema=_PARCEL_TYPES)


def _shares(share: np.ndarray, kind: int, doc: np.ndarray, pos: np.ndarray, keys: np.ndarray | None) -> list[tuple]:
    """One row for each share of places that are in order of (doc, pos)."""
    order = np.argsort(share.astype(np.int16 if len(share) and share.max() < 1 << 15 else np.int32), kind="stable")
    share, doc, pos = share[order], doc[order], pos[order]
    keys = None if keys is None else keys[order]
    cuts = np.flatnonzero(np.concatenate([[True], share[1:] != share[:-1]])) if len(share) else []
    out = []
    for a, b in zip(cuts, [*cuts[1:], len(share)]):
        out.append((int(share[a]), kind, *pack_places(doc[a:b], pos[a:b]), b"" if keys is None else keys[a:b].tobytes()))
    return out


def doc_share(ids: np.ndarray, shares: int) -> np.ndarray:
    """What ``pmod(xxhash64(doc_id), shares)`` is in Spark, so that places find the share of their document."""
    p1, p2, p3 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
    p4, p5 = np.uint64(0x85EBCA77C2B2AE63), np.uint64(0x27D4EB2F165667C5)
    turned = lambda h, n: (h << np.uint64(n)) | (h >> np.uint64(64 - n))
    h = np.full(len(ids), 42, np.uint64) + p5 + np.uint64(8)
    h = turned(h ^ (turned(ids.astype(np.int64).view(np.uint64) * p2, 31) * p1), 27) * p1 + p4
    h = (h ^ (h >> np.uint64(33))) * p2
    h = (h ^ (h >> np.uint64(29))) * p3
    return (h ^ (h >> np.uint64(32))).view(np.int64) % shares


def _found(ids: np.ndarray, pos: np.ndarray, shares: int) -> list[tuple]:
    """Places, in any order, as rows for their documents' shares."""
    order = np.lexsort((pos, ids))
    return _shares(doc_share(ids[order], shares), _FOUND, ids[order], pos[order], None)


def _probe(block: int, shares: int):
    """Of each block of documents: places whose run comes twice in it, and one place for every run, to be compared."""

    def run(batches):
        for rows in chunks(batches, ["doc_id", "text"], most=6_000_000):
            words = Words(rows)
            at, h = words.runs(block)
            if not len(at):
                continue
            place, ids = words.place[at], words.ids[words.owner[at]]
            order, first, sizes = _grouped(h)
            again = np.zeros(len(at), bool)
            again[order] = np.repeat(sizes > 1, sizes)
            # For each run its first anchor, or its first place if it has none.
            rank = order + (place[order] % block != 0) * len(order)
            sent = np.sort(np.minimum.reduceat(rank, first) % len(order))
            share = (mixed(h[sent] + np.uint64(1)) % np.uint64(shares)).astype(np.int64)
            yield _parcels(
                _found(ids[again], place[again], shares)
                + _shares(share, _PROBE, ids[sent], place[sent], h[sent].astype("<u4"))
            )

    return run


def _hits(block: int, shares: int):
    """Of one task's shares: places whose run another place has too, if one of these is an anchor."""

    def run(batches):
        parts = {"share": [], "doc": [], "pos": [], "key": []}
        for batch in batches:
            for share, kind, docs, sizes, gaps, keys in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == _FOUND:
                    yield _parcels([(share, kind, docs, sizes, gaps, keys)])
                    continue
                doc, pos = unpack_places(docs, sizes, gaps)
                key = np.frombuffer(keys, "<u4").astype(np.uint64) | np.uint64(share << 32)
                for name, a in (("doc", doc), ("pos", pos.astype(np.int32)), ("key", key)):
                    parts[name].append(a)
        if not parts["key"]:
            return
        doc, pos, key = (np.concatenate(parts.pop(n)) for n in ("doc", "pos", "key"))
        order, first, sizes = _grouped(key)
        anchors = np.add.reduceat((pos[order] % block == 0).astype(np.int64), first)
        hit = order[np.repeat((sizes > 1) & (anchors > 0), sizes)]
        yield _parcels(_found(doc[hit], pos[hit].astype(np.int64), shares))

    return run


def _places_by_document(words: Words, found: pa.Table) -> np.ndarray:
    """Which of all words are a place of ``found``; documents of one id are marked alike."""
    marked = np.zeros(len(words.hashes), bool)
    for docs, sizes, gaps in zip(*(found.column(c).to_pylist() for c in ("docs", "sizes", "gaps"))):
        doc, pos = unpack_places(docs, sizes, gaps)
        low, high = np.searchsorted(words.ids, doc, "left"), np.searchsorted(words.ids, doc, "right")
        while len(doc):  # again for further rows of one id
            here = (low < high) & (pos < words.sizes[np.minimum(low, len(words.ids) - 1)])
            marked[words.starts[low[here]] + pos[here]] = True
            low = low + 1
            more = low < high
            doc, pos, low, high = doc[more], pos[more], low[more], high[more]
    return marked


def _rows_of(table: pa.Table) -> list[tuple]:
    return list(zip(table.column("doc_id").to_pylist(), table.column("text").cast(pa.large_binary()).to_pylist()))


def _extend(window: int, block: int, shares: int):
    """Of each share of documents: the windows around its hits, one place for each, and those that come again in it."""

    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        words = Words(_rows_of(docs))
        hits = np.concatenate([[0], np.cumsum(_places_by_document(words, found))]) if found.num_rows else None
        at, h = words.runs(window)
        if hits is None or not len(at):
            return pa.Table.from_batches([_parcels([])])
        near = hits[at + window - block] > hits[at]  # hits at the first places of the window, as many as a block has
        at, h = at[near], h[near]
        # A second hash, of other parts, decides the share, and so adds to what tells windows apart.
        other = mixed(words.hashes[at] + mixed(words.hashes[at + window - 1] ^ h))
        place, ids = words.place[at], words.ids[words.owner[at]]
        order, first, sizes = _grouped(h)  # in order of (doc_id, text, place), so that the first is the earliest
        later = np.ones(len(at), bool)
        later[order[first]] = False
        # Places of rows with one id, each for itself: here only, as other shares have other ids.
        sent = ~later
        share = (mixed(other) % np.uint64(shares)).astype(np.int64)
        return pa.Table.from_batches(
            [
                _parcels(
                    _own_rows(words, at[later], shares) + _shares(share[sent], _PROBE, ids[sent], place[sent], h[sent])
                )
            ]
        )

    return run


def _own_rows(words: Words, at: np.ndarray, shares: int) -> list[tuple]:
    """Found windows; of the documents of one id, all but the first are told apart by their number in ``kind``."""
    owner = words.owner[at]
    number = np.arange(len(words.ids)) - np.searchsorted(words.ids, words.ids, "left")
    out = []
    for n in np.unique(number[owner]):
        own = number[owner] == n
        ids = words.ids[owner[own]]
        out += _shares(doc_share(ids, shares), _FOUND + int(n), ids, words.place[at[own]], None)
    return out


def _later(shares: int):
    """Of one task's shares: the windows whose words another place has earlier."""

    def run(batches):
        parts = {"doc": [], "pos": [], "key": []}
        for batch in batches:
            for share, kind, docs, sizes, gaps, keys in zip(*(c.to_pylist() for c in batch.columns)):
                if kind >= _FOUND:
                    yield _parcels([(share, kind, docs, sizes, gaps, keys)])
                    continue
                doc, pos = unpack_places(docs, sizes, gaps)
                key = np.frombuffer(keys, "<u8") + np.uint64(share) * np.uint64(0x9E3779B97F4A7C15)
                for name, a in (("doc", doc), ("pos", pos.astype(np.int32)), ("key", key)):
                    parts[name].append(a)
        if not parts["key"]:
            return
        doc, pos, key = (np.concatenate(parts.pop(n)) for n in ("doc", "pos", "key"))
        order = np.lexsort((pos, doc, key))
        ordered = key[order]
        again = order[1:][ordered[1:] == ordered[:-1]]
        yield _parcels(_found(doc[again], pos[again].astype(np.int64), shares))

    return run


_RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
        ("kept_text", pa.string()),
    ]
)


def _cut(window: int):
    """Each document of a share without the words of its found windows."""

    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        words = Words(_rows_of(docs), keep=True)
        cover = np.zeros(len(words.hashes) + 1, np.int32)
        number = np.arange(len(words.ids)) - np.searchsorted(words.ids, words.ids, "left")
        for kind, docs_, sizes, gaps in zip(*(found.column(c).to_pylist() for c in ("kind", "docs", "sizes", "gaps"))):
            doc, pos = unpack_places(docs_, sizes, gaps)
            row = np.searchsorted(words.ids, doc) + (kind - _FOUND)
            at = words.starts[row] + pos
            np.add.at(cover, at, 1)
            np.add.at(cover, at + window, -1)
        gone = np.cumsum(cover[:-1]) > 0
        out = []
        for i, own in enumerate(words.split):
            a = words.starts[i]
            mask = gone[a : a + len(own)]
            edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
            spans = [{"start": int(s), "length": int(e - s)} for s, e in zip(edges[::2], edges[1::2])]
            kept = own if not spans else [w for w, g in zip(own, mask.tolist()) if not g]
            doc_id = int(words.ids[i]) if words.named[i] else None
            out.append((doc_id, len(own), int(mask.sum()), spans, b" ".join(kept)))
        columns = list(zip(*out)) if out else [()] * 5
        arrays = [pa.array(c, f.type) for c, f in zip(columns[:4], _RESULT)]
        return pa.Table.from_arrays([*arrays, pa.array(columns[4], pa.binary()).cast(pa.string())], schema=_RESULT)

    return run


def without_repeats(docs: DataFrame, window: int = WINDOW, shares: int | None = None) -> DataFrame:
    """Remove every word that a window of ``window`` consecutive words covers which also starts earlier.

    Returns a row per row of ``docs`` (doc_id long, text string): doc_id, n_words, n_removed, ``spans`` (start and
    length, in words, of what was removed: maximal repeats) and ``kept_text``, the other words joined by one space. Earlier is a smaller doc_id, or
    an earlier start in the same document; windows are judged on the input. Words are ``[^\\x20\\x09-\\x0D]+``, unchanged.

    A null or empty text has no words. A null doc_id stands before all others. Rows of one doc_id are in order of
    their texts, so that of rows that are wholly equal one keeps its words. Other columns are not read; an empty table gives
    no rows. Runs are compared by 64-bit hashes and, through the share they are sent to, by some bits of a second one.

    ``shares`` divides hashes and documents; a task holds one share at a time. By default there is one for each ``SHARE_BYTES`` of text, which is
    measured first, and twice ``spark.sql.shuffle.partitions`` at least. A very long text is held whole, with 40 bytes for each of its words, by the
    task of its share.
    """
    if window % 2:
        raise ValueError("the window must be even: a block is half of it")
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    block = window // 2
    if not shares:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shares = max(2 * partitions(docs.sparkSession), -(-size // SHARE_BYTES))
    hits = (
        rows.mapInArrow(_probe(block, shares), _PARCEL)
        .repartition(shares, "share")
        .mapInArrow(_hits(block, shares), _PARCEL)
        .select("share", "docs", "sizes", "gaps")
    )
    share = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(_NULL_ID))), F.lit(shares)).cast("int")
    by_share = rows.select(share.alias("share"), "doc_id", "text").groupBy("share")
    windows = by_share.cogroup(hits.groupBy("share")).applyInArrow(_extend(window, block, shares), _PARCEL)
    later = windows.repartition(shares, "share").mapInArrow(_later(shares), _PARCEL).select("share", "kind", "docs", "sizes", "gaps")
    return by_share.cogroup(later.groupBy("share")).applyInArrow(
        _cut(window), "doc_id long, n_words long, n_removed long, spans array<struct<start: long, length: long>>, kept_text string"
    )

