"""Exact Jaccard self join of n-gram sets, with one way for small sets and one for large ones.

Two linked sets have at least ``threshold`` of the larger one's n-grams in common. A *light* set is small enough to list
all its subsets of that size, for every size that a partner can ask for: linked light sets share such a subset.
A *heavy* set stands in the inverted lists of its rarest n-grams, just as many that linked sets must meet in one. Sets near the boundary do
both. The boundary is the size up to which subsets cost less than lists, by the lists' expected length.

Sets that are equal are one node. Lists aren't expanded into pairs: each size class has a leader, and every member is
compared with that of its class and of the next one. This alone joins most groups of near copies. Only lists whose members
are still in different components are compared in full then, so that no link between components is lost. What bitmaps of the sets
exclude isn't compared. Comparisons are made where the sets meet, in clusters of bounded size, and give out only the links that join a cluster.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from .common import chunks, mixed, rolled, stored, word_hashes, words_of
from .components import components

SHINGLE, PERCENT = 4, 85
#: Counters that n-grams are counted in, by hash, for the order of rarity.
COUNTERS = 1 << 18
_SLICES = 64
#: Members of a piece of a list, at most; longer lists are divided.
LIST_ROWS = 2048
#: Members of a list in one block of documents from which on they are a piece of their own.
LOCAL_ROWS = 64
#: Sets that are compared in one task, at most, where pieces overlap.
MEET_ROWS = 3072
#: Members that are compared with a leader in one task, about.
TOGETHER = 256
#: Sets of a cluster that have an n-gram, up to which it is counted pair by pair.
FEW = 16


def shingles(text: bytes | None, n: int) -> np.ndarray:
    """The sorted distinct hashes of the n-grams of a text's words, lower-cased in A-Z; one for all words if there are fewer."""
    words = words_of((text or b"").lower())
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(rolled(word_hashes(words), min(n, len(words))))


def needed(size: int, percent: int) -> int:
    """How many of its n-grams a set of this size has in common with any linked set, at least."""
    return -(-size * percent // 100)


def subset_keys(own: np.ndarray, percent: int) -> np.ndarray:
    """Keys of all subsets of a set that a linked set may share with it: of each size from ``needed`` to its own.

    A subset is known by the sum of its mixed hashes, and found by what it leaves out.
    """
    values = mixed(own + np.uint64(0x51ED270B))
    total, size = values.sum(dtype=np.uint64), len(own)
    out = []
    for left_out in range(size - needed(size, percent) + 1):
        sums = total - values[_left_out(size, left_out)].sum(axis=1, dtype=np.uint64)
        out.append(mixed(sums + np.uint64(size - left_out)))
    return np.concatenate(out)


@lru_cache(maxsize=256)
def _left_out(size: int, number: int) -> np.ndarray:
    return np.array(list(combinations(range(size), number)), np.int64).reshape(math.comb(size, number), number)


def bitmap(own: np.ndarray) -> bytes:
    """A bit for the low part of each hash, in twice as many bits as the set has members, or up to four times."""
    places = 64
    while places < 2 * len(own):
        places *= 2
    bits = np.zeros(places, np.uint8)
    bits[(own & np.uint64(places - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def possible(x: np.ndarray, size: int, others: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Which of the sets with bitmaps ``others`` may be linked with that of ``x``; all bitmaps have one length.

    A bit that only one of two sets has stands for a member that only it has: so no linked set is ever excluded.
    """
    alone = np.bitwise_count(x & ~others).sum(axis=1, dtype=np.int64)
    other = np.bitwise_count(~x & others).sum(axis=1, dtype=np.int64)
    both = np.minimum(size - alone, sizes - other)
    return 100 * both >= percent * (size + sizes - both)


def folded(bits: np.ndarray, length: int) -> np.ndarray:
    """Bitmaps (the last axis) of the same sets in fewer bits."""
    while bits.shape[-1] > length:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] | bits[..., half:]
    return bits


def _possible_pairs(percent: int):
    def run(batches):
        for batch in batches:
            good = []
            for x, n, y, m in zip(*(batch.column(c).to_pylist() for c in ("bits", "size", "bits_b", "size_b"))):
                x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
                length = min(len(x), len(y))
                good.append(bool(possible(folded(x, length), n, folded(y, length)[None], np.array([m]), percent)[0]))
            pairs = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"])
            yield pairs.filter(pa.array(good, pa.bool_()))

    return run


def _possible_members(percent: int):
    def run(members: pa.Table) -> pa.Table:
        """The members of a cluster, by the components of what its bitmaps don't exclude; those alone are left out."""
        # A node has a row for each of its document's texts, as a rule one.
        rows = sorted(set(zip(*(members.column(c).to_pylist() for c in ("size", "node", "bits")))))
        sizes, nodes, bits = (list(c) for c in zip(*rows))
        sizes, lengths = np.array(sizes, np.int64), np.array([len(b) for b in bits])
        m = len(nodes)
        near = np.eye(m, dtype=bool)
        by_length = {int(w): np.stack([np.frombuffer(bits[i], np.uint8) for i in np.flatnonzero(lengths == w)]) for w in np.unique(lengths)}
        first = {w: int(np.searchsorted(lengths, w)) for w in by_length}  # sizes and lengths are in one order
        for w, own in by_length.items():
            for v, others in by_length.items():
                if v < w:
                    continue
                others = folded(others, w)
                for i in range(len(own)):
                    a = first[w] + i
                    low, high = max(a + 1, first[v]), int(np.searchsorted(sizes, sizes[a] * 100 // percent, "right"))
                    high = min(high, first[v] + len(others))
                    if low < high:
                        near[a, low:high] = possible(own[i], sizes[a], others[low - first[v] : high - first[v]], sizes[low:high], percent)
        near |= near.T
        component = reached(near)
        several = np.bincount(component, minlength=m)[component] > 1
        key = members.column("cluster")[0].as_py() * 31 + (members.column("part")[0].as_py() or 0)
        key = (key + (1 << 63)) % (1 << 64) - (1 << 63)
        picked = np.flatnonzero(several).tolist()
        return pa.table(
            {
                "cluster": pa.array([nodes[component[i]] for i in picked], pa.int64()),
                "part": pa.array([key] * len(picked), pa.int64()),
                "node": pa.array([nodes[i] for i in picked], pa.int64()),
            }
        )

    return run


def reached(linked: np.ndarray) -> np.ndarray:
    """For each place the first one that a symmetric matrix of links leads to, itself included."""
    m = len(linked)
    rows = max(1, 1_000_000 // m)
    first = np.arange(m)
    while True:
        new = np.concatenate([np.where(linked[i : i + rows], first[None, :], m).min(axis=1) for i in range(0, m, rows)])
        if (new == first).all():
            return first
        first = new


@dataclass(frozen=True)
class Order:
    """A total order of n-grams from rare to frequent, and the boundary. Of a fixed size, whatever the data."""

    counts: np.ndarray
    boundary: int
    percent: int

    def ranked(self, own: np.ndarray) -> np.ndarray:
        return own[np.lexsort((own, self.counts[(own % np.uint64(COUNTERS)).astype(np.int64)]))]


def boundary(expected_list: float, percent: int, most: int = 26) -> int:
    """The largest size up to which listing subsets costs less than meeting ``expected_list`` members in each list."""
    best = 0
    for size in range(1, most + 1):
        spare = size - needed(size, percent)
        light = sum(math.comb(size, left_out) for left_out in range(spare + 1))
        if light > (spare + 1) * (1 + expected_list):
            break
        best = size
    return best


def _summary(n: int):
    def run(batches):
        """(doc_id, size, two halves of the set's digest) per row; at the end the counters, in slices."""
        counts = np.zeros(COUNTERS, np.int64)
        for rows in chunks(batches, ["doc_id", "text"], most=4_000_000):
            out = []
            for doc_id, text in rows:
                own = shingles(text, n)
                np.add.at(counts, (own % np.uint64(COUNTERS)).astype(np.int64), 1)
                digest = np.frombuffer(xxhash.xxh3_128_digest(own.tobytes()), np.int64)
                out.append((doc_id, len(own), int(digest[0]), int(digest[1]), bitmap(own)))
            doc, size, a, b, bits = zip(*out)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(doc, pa.int64()),
                    "size": pa.array(size, pa.int64()),
                    "set_a": pa.array(a, pa.int64()),
                    "set_b": pa.array(b, pa.int64()),
                    "bits": pa.array(bits, pa.binary()),
                    "slice": pa.array([None] * len(out), pa.int32()),
                    "counts": pa.array([None] * len(out), pa.binary()),
                }
            )
        none = pa.array([None] * _SLICES, pa.int64())
        parts = [c.astype("<u4").tobytes() for c in np.split(counts, _SLICES)]
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": none, "size": none, "set_a": none, "set_b": none, "bits": none.cast(pa.string()).cast(pa.binary()),
                "slice": pa.array(range(_SLICES), pa.int32()), "counts": pa.array(parts, pa.binary()),
            }
        )

    return run


def _add_slices(batches):
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for at, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            sums[at] = sums.get(at, 0) + np.frombuffer(counts, "<u4").astype(np.int64)
    for at, counts in sums.items():
        yield pa.RecordBatch.from_pydict({"slice": pa.array([at], pa.int32()), "counts": pa.array([counts.tobytes()], pa.binary())})


_POSTING = "key long, salt int, size int, doc_id long"


def _postings(shared, n: int):
    def run(batches):
        """The places of each set in the lists; a set that comes several times in a block has its first row's only."""
        order = shared.value
        p = order.percent
        for rows in chunks(batches, ["doc_id", "text"], most=4_000_000):
            seen: set[bytes] = set()
            keys, sizes, docs = [], [], []
            for doc_id, text in rows:
                own = shingles(text, n)
                digest = xxhash.xxh3_128_digest(own.tobytes())
                if doc_id is None or not len(own) or digest in seen:
                    continue
                seen.add(digest)
                many = len(own)
                found = [subset_keys(own, p)] if many <= order.boundary else []
                if many >= needed(order.boundary + 1, p):
                    found.append(order.ranked(own)[: many - needed(many, p) + 1])
                for k in found:
                    keys.append(k)
                    sizes.append(np.full(len(k), many))
                    docs.append(np.full(len(k), doc_id))
            if not keys:
                continue
            key, doc = np.concatenate(keys), np.concatenate(docs)
            # How many members a list may have, from the counters: as many salts as keep its shares bounded.
            size = np.concatenate(sizes)
            # A list that has many members here already is a piece of its own, and sends on the ends of its size classes.
            order_ = np.lexsort((doc, size, key))
            key, size, doc = key[order_], size[order_], doc[order_]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            own = np.diff(np.append(first, len(key)))
            salt = np.where(np.repeat(own >= LOCAL_ROWS, own), int(doc.min()) & 0x7FFFFFFF, -1).astype(np.int32)
            ends = []
            for a, n_own in zip(first[own >= LOCAL_ROWS].tolist(), own[own >= LOCAL_ROWS].tolist()):
                starts = [a + i for i in _runs(size[a : a + n_own].tolist(), p)]
                ends += starts + [i - 1 for i in starts[1:]] + [a + n_own - 1]
            ends = np.array(ends, np.int64)
            key, size, doc = (np.concatenate([c, c[ends]]) for c in (key, size, doc))
            salt = np.concatenate([salt, np.full(len(ends), -1, np.int32)])
            yield pa.RecordBatch.from_pydict(
                {
                    "key": pa.array(key.view(np.int64)),
                    "salt": pa.array(salt),
                    "size": pa.array(size, pa.int32()),
                    "doc_id": pa.array(doc, pa.int64()),
                }
            )

    return run


def _lists(percent: int):
    """From rows in order of (key, salt, size, doc_id): each list of two sets at least, as arrays of at most ``LIST_ROWS``.

    Where the next size is too large to be linked with the last one, a new list begins: no link leads across.
    """

    def run(batches):
        yield from _list_rows(batches, percent)

    return run


def _list_rows(batches, percent):
    names = ["key", "salt", "size", "doc_id"]
    rest = None
    for batch in batches:
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
        if rest is not None:
            columns = [np.concatenate(x) for x in zip(rest, columns)]
        key, salt = columns[0], columns[1]
        new = np.flatnonzero((key[1:] != key[:-1]) | (salt[1:] != salt[:-1])) + 1
        last = int(new[-1]) if len(new) else 0
        rest = [c[last:] for c in columns]
        yield from _whole_lists([c[:last] for c in columns], percent)
    if rest is not None:
        yield from _whole_lists(rest, percent)


def _whole_lists(columns, percent):
    key, salt, size, doc = columns
    if not len(key):
        return
    gap = (salt[1:] < 0) & (percent * size[1:].astype(np.int64) > 100 * size[:-1].astype(np.int64))
    first = np.flatnonzero(np.concatenate([[True], gap | (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])]))
    sizes = np.diff(np.append(first, len(key)))
    # A list of one set is of use only if other salts may have more of it.
    used = (sizes > 1) | (salt[first] >= 0)
    pieces = [
        (int(key[a]), int(salt[a]), bool(salt[a] >= 0 or n > LIST_ROWS), size[i : min(i + LIST_ROWS, a + n)], doc[i : min(i + LIST_ROWS, a + n)])
        for a, n in zip(first[used].tolist(), sizes[used].tolist())
        for i in range(a, a + n, LIST_ROWS)
    ]
    if not pieces:
        return
    k, s, m, z, d = zip(*pieces)
    yield pa.RecordBatch.from_pydict(
        {
            "key": pa.array(k, pa.int64()),
            "salt": pa.array(s, pa.int32()),
            "divided": pa.array(m, pa.bool_()),
            "sizes": pa.array(z, pa.list_(pa.int32())),
            "docs": pa.array(d, pa.list_(pa.int64())),
        }
    )


_LIST = "key long, salt int, divided boolean, sizes array<int>, docs array<long>"


def _runs(sizes: list[int], percent: int) -> list[int]:
    """Where the size classes of a sorted list begin: each has what its first member may be linked to."""
    out = [0]
    for i, size in enumerate(sizes):
        if sizes[out[-1]] < needed(size, percent):
            out.append(i)
    return out


def _stars(percent: int):
    def run(batches):
        """Each member with the leader of its class, and the leader with the last member of the class before."""
        for batch in batches:
            edges = set()
            for sizes, docs in zip(batch.column("sizes").to_pylist(), batch.column("docs").to_pylist()):
                starts = _runs(sizes, percent)
                for a, b in zip(starts, [*starts[1:], len(sizes)]):
                    edges.update((d, docs[a]) for d in docs[a + 1 : b])
                    if a and sizes[a - 1] >= needed(sizes[a], percent):
                        edges.add((docs[a], docs[a - 1]))
            a, b = zip(*edges) if edges else ((), ())
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _leaders(percent: int):
    def run(batches):
        """The leaders of divided lists, as members of one list for each key."""
        for batch in batches:
            out = []
            for key, sizes, docs in zip(*(batch.column(c).to_pylist() for c in ("key", "sizes", "docs"))):
                out += [(key, -1, sizes[i], docs[i]) for i in _runs(sizes, percent)]
            columns = zip(*out) if out else [()] * 4
            types = [pa.int64(), pa.int32(), pa.int32(), pa.int64()]
            names = ["key", "salt", "size", "doc_id"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return run


def _in_lists(postings: DataFrame, percent: int) -> DataFrame:
    dealt = postings.repartition("key", "salt").sortWithinPartitions("key", "salt", "size", "doc_id")
    return dealt.mapInArrow(_lists(percent), _LIST)


#: Bits of a filter of nodes for each of them, at most so many in all (32 MB), and bits of one of its pieces.
NODE_BITS, MOST_BITS, PIECE_BITS = 16, 1 << 28, 1 << 16


def _bit_places(nodes: np.ndarray, bits: int) -> np.ndarray:
    """The bits of nodes, a row each, in a filter of a power of two of bits."""
    h = mixed(nodes.astype(np.int64).view(np.uint64))
    return np.stack([(h >> np.uint64(s)) ^ (h << np.uint64(7 * i)) for i, s in enumerate((0, 17, 31, 43))], 1) & np.uint64(bits - 1)


def _filter_pieces(bits: int):
    def run(batches):
        for batch in batches:
            at = np.unique(_bit_places(batch.column("node").to_numpy(zero_copy_only=False), bits))
            piece = (at // np.uint64(PIECE_BITS)).astype(np.int64)
            found = np.unique(piece)
            out = []
            for p in found:
                own = np.zeros(PIECE_BITS, bool)
                own[(at[piece == p] % np.uint64(PIECE_BITS)).astype(np.int64)] = True
                out.append(np.packbits(own, bitorder="little").tobytes())
            yield pa.RecordBatch.from_pydict({"piece": pa.array(found, pa.int64()), "bits": pa.array(out, pa.binary())})

    return run


def _one_piece(rows: pa.Table) -> pa.Table:
    whole = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in rows.column("bits").to_pylist()])
    return pa.table({"piece": rows.column("piece").slice(0, 1), "bits": pa.array([whole.tobytes()], pa.binary())})


def node_filter(nodes: DataFrame) -> np.ndarray:
    """A Bloom filter, as bytes, of rows (node long). It is never larger than ``MOST_BITS``: with very many nodes it admits more others."""
    bits = max(PIECE_BITS, min(MOST_BITS, 1 << (NODE_BITS * nodes.count()).bit_length()))
    pieces = nodes.select("node").mapInArrow(_filter_pieces(bits), "piece long, bits binary")
    out = np.zeros((bits // PIECE_BITS, PIECE_BITS // 8), np.uint8)
    for row in pieces.groupBy("piece").applyInArrow(_one_piece, "piece long, bits binary").toLocalIterator():
        out[row["piece"]] = np.frombuffer(row["bits"], np.uint8)
    return out.ravel()


def admitted(nodes: np.ndarray, filter_: np.ndarray) -> np.ndarray:
    at = _bit_places(nodes, 8 * len(filter_))
    return ((filter_[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


def _compressed(wanted):
    def run(batches):
        """The texts of documents that the filter admits."""
        filter_ = wanted.value

        def chosen():
            for batch in batches:
                keep = admitted(batch.column("doc_id").to_numpy(zero_copy_only=False), filter_)
                if keep.any():
                    yield batch.filter(pa.array(keep))

        for rows in chunks(chosen(), ["doc_id", "text"], most=4_000_000):
            pack = zstandard.ZstdCompressor(level=1)
            yield pa.RecordBatch.from_pydict(
                {
                    "node": pa.array([i for i, _ in rows], pa.int64()),
                    "packed": pa.array([pack.compress(t or b"") for _, t in rows], pa.binary()),
                }
            )

    return run


def _dealt(n: int):
    def run(batches):
        """The set of each document, 48 bits of each hash, once for every cluster that it is in."""
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            out, held = [], 0
            for node, packed, clusters in zip(*(batch.column(c).to_pylist() for c in ("node", "packed", "clusters"))):
                own = shingles(unpack.decompress(packed), n)
                own = own.view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()
                for cluster in clusters:
                    out.append((cluster["cluster"], cluster["part"], node, own))
                    held += len(own)
                    if held > 8_000_000:
                        yield _members(out)
                        out, held = [], 0
            yield _members(out)

    return run


def _members(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    columns = zip(*rows) if rows else [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["cluster", "part", "node", "own"])


def linked_members(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each of some sorted sets the place of the first one that links lead to, itself included.

    Intersections are counted at once: for n-grams in few of the sets by meeting each with the next ones that have it, for the
    others as products of slices of the incidence matrix.
    """
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(m), sizes)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(column, kind="stable")
    owner, column, often = owner[order], column[order], count[column[order]]
    both = np.zeros(m * m, np.int32)
    few = (often > 1) & (often <= FEW)
    light, own = column[few], owner[few]
    for k in range(1, FEW):
        same = np.flatnonzero(light[k:] == light[:-k])
        if not len(same):
            break
        np.add.at(both, own[same] * m + own[same + k], 1)
        np.add.at(both, own[same + k] * m + own[same], 1)
    both = both.reshape(m, m)
    heavy, own = np.unique(column[often > FEW], return_inverse=True)[1], owner[often > FEW]
    width, rows = max(1, 4_000_000 // m), max(1, 1_000_000 // m)
    for start in range(0, int(heavy[-1]) + 1 if len(heavy) else 0, width):
        a, b = np.searchsorted(heavy, [start, start + width])
        incidence = np.zeros((m, int(heavy[b - 1]) - start + 1), np.float32)
        incidence[own[a:b], heavy[a:b] - start] = 1
        for i in range(0, m, rows):
            both[i : i + rows] += (incidence[i : i + rows] @ incidence.T).astype(np.int32)
    linked = np.zeros((m, m), bool)
    for i in range(0, m, rows):
        union = sizes[i : i + rows, None] + sizes[None, :] - both[i : i + rows]
        linked[i : i + rows] = 100 * both[i : i + rows].astype(np.int64) >= percent * union
    del both
    np.fill_diagonal(linked, True)
    return reached(linked)


def _link(percent: int):
    def run(members: pa.Table) -> pa.Table:
        """The links that join the members of one cluster."""
        # A node has a set for each of its document's texts, as a rule one.
        rows = sorted(set(zip(members.column("node").to_pylist(), members.column("own").to_pylist())))
        nodes, own = [n for n, _ in rows], []
        for _, short in rows:
            wide = np.zeros((len(short) // 6, 8), np.uint8)
            wide[:, 2:] = np.frombuffer(short, np.uint8).reshape(-1, 6)
            own.append(wide.view(np.uint64).ravel())
        first = linked_members(own, percent)
        pairs = sorted({(nodes[i], nodes[f]) for i, f in enumerate(first.tolist()) if nodes[f] != nodes[i]})
        a, b = zip(*pairs) if pairs else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _links(rows: DataFrame, members: DataFrame, n: int, percent: int) -> DataFrame:
    """The links in clusters (cluster, part, node) of bounded size. Only texts and sets of the nodes wanted are shuffled."""
    wanted = stored(members.groupBy("node").agg(F.collect_list(F.struct("cluster", "part")).alias("clusters")), "wanted")
    filter_ = rows.sparkSession.sparkContext.broadcast(node_filter(wanted))  # 32 MB at most
    texts = rows.filter("doc_id IS NOT NULL").mapInArrow(_compressed(filter_), "node long, packed binary")
    dealt = texts.join(wanted, "node").mapInArrow(_dealt(n), "cluster long, part long, node long, own binary")
    return dealt.groupBy("cluster", "part").applyInArrow(_link(percent), "a long, b long")


def jaccard_groups(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id), one per row of ``docs`` (doc_id long, text string).

    Texts are lower-cased in A-Z and divided into words ``[^\x20\x09-\x0D]+``; a document's set has the distinct ``n``-grams of its words, or
    all words as one if they are fewer. Two documents are linked when 100 times the size of their intersection is at least ``percent`` times that of
    their union. ``component_id`` is the smallest doc_id that links lead to, itself included.

    Null and empty texts have an empty set and are linked with nothing. A null doc_id takes no part and has a null component_id.
    Repeated rows are reported each. Rows with one id are one document: it is linked with what any of its texts is linked
    with, and they have one component. Other columns are not read, and an empty table gives no rows. n-grams are told apart by 64-bit hashes, and 48 bits of them where two sets are compared.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    summary = stored(
        rows.mapInArrow(_summary(n), "doc_id long, size long, set_a long, set_b long, bits binary, slice int, counts binary"), "sets"
    )
    slices = summary.filter("slice IS NOT NULL").select("slice", "counts").repartition("slice")
    slices = slices.mapInArrow(_add_slices, "slice int, counts binary").collect()  # the counters: of a fixed size
    counts = np.zeros(COUNTERS, np.int64)
    for row in slices:
        counts.reshape(_SLICES, -1)[row["slice"]] = np.frombuffer(row["counts"], np.int64)
    # A set's rarest n-grams are met about as often as those of the rarer half of the counters.
    used = np.sort(counts[counts > 0])
    rare = used[: max(1, len(used) // 2)]
    distinct = max(1.0, float(len(used)))
    order = Order(counts, boundary(float(rare.mean() / max(1.0, distinct / COUNTERS)) if len(rare) else 0.0, percent), percent)
    shared = spark.sparkContext.broadcast(order)

    nodes = summary.filter("slice IS NULL").select("doc_id", "size", "set_a", "set_b")
    equal = nodes.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("node"))
    nodes = stored(nodes.join(equal, ["set_a", "set_b"]).select("doc_id", "size", "node"), "nodes")
    of = nodes.filter("doc_id IS NOT NULL AND size > 0").select("doc_id", "node").distinct()

    def mapped(pairs: DataFrame) -> DataFrame:
        pairs = pairs.join(of.toDF("a", "node_a"), "a").join(of.toDF("b", "node_b"), "b")
        return pairs.filter("node_a != node_b").select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()

    lists = stored(_in_lists(rows.mapInArrow(_postings(shared, n), _POSTING), percent), "lists")
    leaders = _in_lists(lists.filter("divided").mapInArrow(_leaders(percent), _POSTING), percent)
    stars = lists.select("sizes", "docs").union(leaders.select("sizes", "docs"))
    pairs = mapped(stars.mapInArrow(_stars(percent), "a long, b long").distinct())
    bits = summary.filter("doc_id IS NOT NULL").select("doc_id", "size", "bits")
    pairs = pairs.join(bits.toDF("a", "size", "bits"), "a").join(bits.toDF("b", "size_b", "bits_b"), "b")
    pairs = stored(pairs.mapInArrow(_possible_pairs(percent), "a long, b long").distinct(), "pairs")
    # A leader with its members, in clusters of bounded size.
    often = pairs.groupBy("b").agg((F.floor(F.count("*") / F.lit(TOGETHER)) + 1).alias("parts"))
    dealt = pairs.join(often, "b").withColumn("part", F.pmod(F.xxhash64("a"), "parts"))
    own = often.select("b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.col("b").alias("node"))
    clusters = dealt.select("b", "part", F.col("a").alias("node")).union(own).withColumnRenamed("b", "cluster")
    # Texts of one id are texts of one document.
    first = of.groupBy("doc_id").agg(F.min("node").alias("b"), F.count("*").alias("k")).filter("k > 1")
    same = of.withColumnRenamed("node", "a").join(first, "doc_id").filter("a != b").select("a", "b")
    joined = components(_links(rows, clusters, n, percent).union(same))

    # Lists of more than a pair whose members are in several components by now.
    # Of a list that is divided anywhere, all pieces belong together.
    piece = F.xxhash64("key", "salt", F.col("docs")[0])
    divided = lists.filter("divided").select("key", F.lit(True).alias("more")).distinct()
    longer = lists.join(divided, "key", "left").filter(F.col("more") | (F.size("docs") > 2)).withColumn("piece", piece)
    longer = longer.withColumn("key", F.when(F.col("more"), F.col("key")).otherwise(F.col("piece")))
    component = of.join(joined.withColumnRenamed("component", "joined"), "node", "left").select(
        "doc_id", "node", F.coalesce("joined", "node").alias("component")
    )
    pieces = longer.select("key", "piece", F.explode("docs").alias("doc_id")).join(component, "doc_id")
    pieces = pieces.groupBy("key", "piece").agg(
        F.sort_array(F.collect_set("node")).alias("nodes"), F.min("component").alias("least"), F.max("component").alias("most")
    )
    pieces = stored(pieces, "pieces")
    several = pieces.groupBy("key").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    pieces = pieces.join(several.filter("least != most").select("key"), "key", "left_semi").select("key", "piece", "nodes")
    others = pieces.select("key", F.col("piece").alias("other"), F.col("nodes").alias("more"))
    together = pieces.join(others, "key").filter("piece <= other")
    together = together.select(F.sort_array(F.array_union("nodes", "more")).alias("nodes")).filter(F.size("nodes") > 2)
    together = stored(together.distinct(), "together")
    possible_ = together.select(
        F.xxhash64("nodes").alias("cluster"), F.hash("nodes").cast("long").alias("part"), F.explode("nodes").alias("node")
    )
    possible_ = possible_.join(bits.withColumnRenamed("doc_id", "node"), "node").groupBy("cluster", "part")
    possible_ = possible_.applyInArrow(_possible_members(percent), "cluster long, part long, node long")
    possible_ = stored(possible_, "possible")
    # What is left of pieces that overlap is compared as one while it is small enough, so that a set is sent once; beyond
    # that each piece for itself. Where all are in one component already, there is nothing to find.
    meeting = components(possible_.select(F.col("node").alias("a"), F.col("cluster").alias("b")))
    now = joined.withColumnRenamed("component", "joined")
    meeting = meeting.join(now, "node", "left").withColumn("joined", F.coalesce("joined", "node"))
    sizes = meeting.groupBy("component").agg(F.count("*").alias("n"), F.min("joined").alias("least"), F.max("joined").alias("most"))
    meeting = meeting.join(sizes.filter("least != most"), "component").select("component", "node", "n")
    large = meeting.filter(F.col("n") > MEET_ROWS).select("node")
    members = meeting.filter(F.col("n") <= MEET_ROWS).select(
        F.col("component").alias("cluster"), F.lit(None).cast("long").alias("part"), "node"
    )
    members = stored(members.union(possible_.join(large, "node", "left_semi").select("cluster", "part", "node")), "members")
    if not members.isEmpty():
        more = _links(rows, members, n, percent)
        joined = components(joined.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))

    found = nodes.join(joined, "node", "left")
    return found.select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        F.when(F.col("size") == 0, F.col("doc_id"))
        .when(F.col("doc_id").isNotNull(), F.coalesce("component", "node"))
        .alias("component_id"),
    )
