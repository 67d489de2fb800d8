"""Detection of periodic runs: words that repeat with a period, four times or more.

A suffix automaton tells, by the path from a prefix's state to the root, where every suffix of that prefix occurred before. The states on
the path are coloured with the end of their last occurrence, in segments of one colour. Appending a word *accesses* its
path, as link-cut trees do: the segments are met one after the other, cut off below the path, and joined to one of the new colour.
A segment with words up to length L that ended p words earlier says that L words return after p, a square if L >= p; squares
of one period and start are the growing ends of one run. The number of segments grows with n log n.

Building the automaton is plain Python work, so it is spared for texts that need it: a run of period q repeats all its
words, and all its groups of eight words, at distances of q at most, and numpy finds the stretches where that is so.
Words outside them are in no run. Texts are independent; nothing is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import chunks, mixed, rolled, ship, words_of

#: A run has at least this many words and this many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
_GROUP = 8


def suffix_automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix links and greatest lengths of the states, and the state of each prefix. State 0 is the root."""
    link, length, follow, prefixes, last = [-1], [0], [{}], [], 0
    for word in words:
        state = len(link)
        length.append(length[last] + 1)
        link.append(0)
        follow.append({})
        p = last
        while p >= 0 and word not in follow[p]:
            follow[p][word] = state
            p = link[p]
        if p >= 0:
            q = follow[p][word]
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                clone = len(link)
                length.append(length[p] + 1)
                link.append(link[q])
                follow.append(follow[q].copy())
                while p >= 0 and follow[p].get(word) == q:
                    follow[p][word] = clone
                    p = link[p]
                link[q] = link[state] = clone
        prefixes.append(state)
        last = state
    return link, length, prefixes


class Paths:
    """Segments of one colour on the paths of a tree, as splay trees in order of depth.

    ``up`` is a node's parent in its splay tree or, at the root of one, the node that its segment hangs from (-1: none).
    The colour of a segment is kept at the root of its splay tree.
    """

    def __init__(self, parents: list[int]):
        self.up = list(parents)
        self.low = [-1] * len(parents)  # towards the root of the path
        self.high = [-1] * len(parents)
        self.colour = [-1] * len(parents)

    def _rotate(self, x: int) -> None:
        up, low, high = self.up, self.low, self.high
        p = up[x]
        g = up[p]
        if low[p] == x:
            child = low[p] = high[x]
            high[x] = p
        else:
            child = high[p] = low[x]
            low[x] = p
        if child >= 0:
            up[child] = p
        up[p], up[x] = x, g
        if g >= 0:
            if low[g] == p:
                low[g] = x
            elif high[g] == p:
                high[g] = x

    def splay(self, x: int) -> None:
        """Make a node the root of its splay tree, with the colour of that."""
        up, low, high, rotate = self.up, self.low, self.high, self._rotate
        root = x
        while (p := up[root]) >= 0 and (low[p] == root or high[p] == root):
            root = p
        colour = self.colour[root]
        while root != x:
            p = up[x]
            if p == root:
                rotate(x)
                break
            g = up[p]
            done = g == root
            if (low[g] == p) == (low[p] == x):
                rotate(p)
            else:
                rotate(x)
            rotate(x)
            if done:
                break
        self.colour[x] = colour

    def access(self, node: int, colour: int) -> list[tuple[int, int]]:
        """Give the path from ``node`` to the root a colour; the segments met as (deepest node on the path, colour before)."""
        met, below, x = [], -1, node
        high, colours = self.high, self.colour
        while x >= 0:
            self.splay(x)
            met.append((x, colours[x]))
            cut = high[x]
            if cut >= 0:
                colours[cut] = colours[x]  # what hangs below the path is a segment of its own
            high[x] = below
            below, x = x, self.up[x]
        self.splay(node)
        colours[node] = colour
        return met


def runs_of(words: list[int], least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """Maximal runs (start, length, smallest period) of at least ``least`` words and ``periods`` (3 or more) periods, in order.

    That the distance of a segment is the *smallest* period follows from its colour being the last occurrence: a smaller
    one would have been met with the same words later. The segment is as long as the words agree, so a run has one start.
    """
    link, length, prefixes = suffix_automaton(words)
    paths, ends = Paths(link), {}
    for i, state in enumerate(prefixes):
        for node, before in paths.access(state, i):
            if before >= 0:
                p, same = i - before, length[node]
                if same + p >= least and same >= (periods - 1) * p:
                    ends[before - same + 1, p] = i
    return sorted((start, end - start + 1, p) for (start, p), end in ends.items())


def _stretches(at: np.ndarray, least: int) -> np.ndarray:
    """Rows (first, last) of at least ``least`` consecutive numbers among increasing ones."""
    if not len(at):
        return np.zeros((0, 2), np.int64)
    cut = np.flatnonzero(np.diff(at) != 1)
    first, last = at[np.append(0, cut + 1)], at[np.append(cut, len(at) - 1)]
    long = last - first + 1 >= least
    return np.stack([first[long], last[long]], 1)


def candidates(h: np.ndarray, sizes: np.ndarray, least: int, periods: int) -> list[tuple[int, int, int]]:
    """Stretches (text, first word, word after the last) outside which no run has a word, of texts that follow one another.

    Equal words must have equal hashes; others may.
    """
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sizes)), sizes)
    found = []
    longest = int(sizes.max(initial=0))
    for q in range(1, min(_GROUP, longest // periods) + 1):  # short periods: words q apart are compared
        same = np.flatnonzero((h[q:] == h[:-q]) & (owner[q:] == owner[:-q]))
        found.append(_stretches(same, max(least, periods * q) - q) + [0, q])
    if longest >= periods * (_GROUP + 1):
        r = rolled(h, _GROUP)
        at = np.flatnonzero(owner[: len(r)] == owner[_GROUP - 1 :])
        key = r[at] ^ mixed(owner[at].astype(np.uint64))
        order = np.argsort(key, kind="stable")
        again = np.flatnonzero(key[order[1:]] == key[order[:-1]])
        gap = at[order[again + 1]] - at[order[again]]
        at, by_place = at[order[again + 1]], np.argsort(at[order[again + 1]])
        at, gap = at[by_place], gap[by_place]
        most = 2 * _GROUP  # periods above half of it, up to it, at once
        while most // 2 + 1 <= longest // periods:
            q = most // 2 + 1
            inside = _stretches(at[gap <= most], max(least, periods * q) - q - _GROUP + 1)
            found.append(inside + [-most, _GROUP - 1])
            most *= 2
    spans = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
    text = owner[spans[:, 1]] if len(spans) else np.zeros(0, np.int64)
    first = np.maximum(spans[:, 0] - starts[text], 0) if len(spans) else text
    out: list[list[int]] = []
    for t, a, b in sorted(zip(text.tolist(), first.tolist(), (spans[:, 1] - starts[text] + 1).tolist())):
        if out and out[-1][0] == t and a <= out[-1][2]:
            out[-1][2] = max(b, out[-1][2])
        else:
            out.append([t, a, b])
    return [tuple(s) for s in out]


def runs_in(texts: list[list[bytes]], least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> list[list[tuple[int, int, int]]]:
    """The runs of each of some lists of words."""
    out: list[list] = [[] for _ in texts]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    h = np.fromiter((hash(w) for words in texts for w in words), np.int64, int(sizes.sum())).view(np.uint64)
    for t, a, b in candidates(h, sizes, least, periods):
        numbers: dict[bytes, int] = {}
        found = runs_of([numbers.setdefault(w, len(numbers)) for w in texts[t][a:b]], least, periods)
        out[t].extend((a + start, length, p) for start, length, p in found)
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, p in runs:
        gone[start + p] += 1
        gone[start + length] -= 1
    return [w for w, g in zip(words, np.cumsum(gone[:-1]).tolist()) if not g]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_TYPES = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed_text", pa.string())]
)


def _found(least: int, periods: int):
    def run(batches):
        for rows in chunks(batches, ["doc_id", "text"], most=4_000_000):
            texts = [words_of(t) for _, t in rows]
            runs = runs_in(texts, least, periods)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array(map(len, texts), pa.int64()),
                    pa.array([[dict(zip(("start", "length", "period"), r)) for r in own] for own in runs], pa.list_(_RUN)),
                    pa.array([b" ".join(collapsed(w, r)) for w, r in zip(texts, runs)], pa.binary()).cast(pa.string()),
                ],
                schema=_TYPES,
            )

    return run


def periodic_runs(docs: DataFrame, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> DataFrame:
    """Find all maximal runs of at least ``least`` words and ``periods`` (3 or more) periods in each text.

    Returns a row per row of ``docs`` (doc_id long, text string): doc_id, n_words, ``runs`` (start, length and smallest period in words, by start,
    then period) and ``collapsed_text``, the words that no run contains after its first period, joined by one space.
    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged; a run is a longest stretch in which words a period apart are identical.

    A null or empty text has no words, no runs and an empty collapsed text. Rows of one doc_id, or with a null one, are taken
    each for itself; other columns are not read; an empty table gives no rows. A text is handled by one task, as its runs may be as
    long as it is: besides its words a task holds about 700 bytes for each word of one stretch that may be periodic.
    """
    if periods < 3:
        raise ValueError("smallest periods are certain from three periods on")
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        _found(least, periods),
        "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed_text string",
    )
