"""Benchmark decontamination: one automaton over the windows of all test questions and answers.

Texts and items are normalised alike (A-Z lower-cased, words are runs of digits, letters and all signs beyond ASCII). The
automaton of Aho and Corasick has words as its letters: its patterns are the windows of all items, and one scan of a
text's words finds every window that occurs, whatever its length. Normalising keeps every byte in its place, so that word
numbers lead back to places in the original text.

Documents are never shuffled: every task scans its own texts. The items are test sets, not corpora, but they are still
measured first; beyond a bound they are divided into several automata, through which the documents pass one after the other.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import chunks, give_back, ship, words_of

WINDOW = 10
#: Bytes of item text in one automaton; a task's automaton takes about 150 times as much memory at worst.
MOST_BYTES = 2_000_000
#: Bytes of text whose words are held at once.
SEGMENT = 4_000_000

_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def normalised(text: bytes) -> bytes:
    """A-Z lower-cased and a space for every byte outside words; places stay as they are."""
    return text.translate(_PLAIN)


def windows(words: list, size: int) -> Iterator[tuple]:
    """All runs of ``size`` words, or all words if they are fewer; none of no words."""
    if words:
        for i in range(max(1, len(words) - size + 1)):
            yield tuple(words[i : i + size])


class Automaton:
    """The windows of items (id or None, words), and the words they are made of."""

    def __init__(self, items: Iterable[tuple[str | None, list[bytes]]], window: int):
        self.window, self.numbers = window, {}
        found: dict[tuple, set] = {}
        for item, words in items:
            numbered = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words]
            for key in windows(numbered, window):
                found.setdefault(key, set()).add(item)
        self.sizes = [len(key) for key in found]
        self.items = [tuple(i for i in ids if i is not None) for ids in found.values()]
        self.machine = None
        if found:
            self.machine = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
            for i, key in enumerate(found):
                self.machine.add_word(key, i)
            self.machine.make_automaton()

    def scan(self, plain: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, places of windows as (first word, word after the last), and ids of their items.

        The words are held in segments; each starts with the last words of the one before it, so that
        no window is missed between them.
        """
        total, at, before, spans, seen = 0, 0, [], [], set()
        while at < len(plain):
            end = plain.find(b" ", at + SEGMENT) if at + SEGMENT < len(plain) else -1
            end = len(plain) if end < 0 else end
            words = before + plain[at:end].split()
            first = total - len(before)
            if self.machine:
                number = self.numbers.get
                for last, key in self.machine.iter(tuple([number(w, 0) for w in words])):
                    spans.append((first + last + 1 - self.sizes[key], first + last + 1))
                    seen.add(key)
            total, at = first + len(words), end
            before = words[-(self.window - 1) :] if self.window > 1 else []
        return total, spans, {i for key in seen for i in self.items[key]}


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans made one."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def original_places(text: bytes, plain: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code points of the original text, first and after the last, that spans of words cover."""
    inside = np.frombuffer(plain, np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    wanted = np.array(spans, np.int64).reshape(-1, 2)
    begins = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80  # the first byte of each code point
    points = np.concatenate([[0], np.cumsum(begins)])
    return list(zip(points[starts[wanted[:, 0]]].tolist(), points[ends[wanted[:, 1] - 1]].tolist()))


_SPAN = "struct<first: long, end: long>"
_PASS = f"doc_id long, text string, spans array<{_SPAN}>, items array<string>"
_DONE = (
    "doc_id long, n_words long, n_hit long, items array<string>, "
    "spans array<struct<first_word: long, words: long, start: long, end: long>>"
)
_SPAN_TYPE = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
_PASS_TYPES = pa.schema(
    [("doc_id", pa.int64()), ("text", pa.string()), ("spans", _SPAN_TYPE), ("items", pa.list_(pa.string()))]
)
_DONE_TYPES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("items", pa.list_(pa.string())),
        ("spans", pa.list_(pa.struct([(c, pa.int64()) for c in ("first_word", "words", "start", "end")]))),
    ]
)
_LAST: list = []  # key and automaton that this worker built last


def _automaton(key: str, items, window: int) -> Automaton:
    if not _LAST or _LAST[0] != key:
        _LAST[:] = [key, Automaton(((i, words_of(t)) for i, t in items.value), window)]
    return _LAST[1]


def _scan(key: str, items, window: int, last: bool):
    def run(batches):
        automaton = _automaton(key, items, window)
        for rows in chunks(batches, ["doc_id", "text", "spans", "items"]):
            out = []
            for doc_id, text, spans, names in rows:
                plain = normalised(text or b"")
                n, found, seen = automaton.scan(plain)
                spans = merged([(s["first"], s["end"]) for s in spans or ()] + found)
                names = sorted(seen.union(names or ()))
                if last:
                    hit = sum(b - a for a, b in spans)
                    places = original_places(text, plain, spans) if spans else []
                    spans = [
                        {"first_word": a, "words": b - a, "start": s, "end": e} for (a, b), (s, e) in zip(spans, places)
                    ]
                    out.append((doc_id, n, hit, names, spans))
                else:
                    out.append((doc_id, text, [{"first": a, "end": b} for a, b in spans], names))
            columns, schema = zip(*out), _DONE_TYPES if last else _PASS_TYPES
            arrays = [pa.array(c, pa.binary() if f.name == "text" else f.type).cast(f.type) for c, f in zip(columns, schema)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)
        give_back()

    return run


def _pieces(window: int, most: int):
    """Items as normalised pieces of at most ``most`` words, which together have the windows of the whole."""

    def run(batches):
        for rows in chunks(batches, ["item_id", "text"]):
            out = []
            for item, text in rows:
                words = words_of(normalised(text or b""))
                step = most - window + 1
                for i in range(0, max(1, len(words) - window + 1) if words else 0, step):
                    out.append((item, b" ".join(words[i : i + most])))
            ids, texts = zip(*out) if out else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array(texts, pa.binary()).cast(pa.string())], ["item_id", "text"]
            )

    return run


def benchmark_hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, most_bytes: int = MOST_BYTES) -> DataFrame:
    """Find the words of each text that belong to an occurrence of ``window`` consecutive words of an item.

    ``docs`` (doc_id long, text string) gives a row for each of its rows: doc_id, n_words, n_hit (words inside an occurrence), ``items`` (ids, as
    text, in order of code points, of the items with occurring windows) and ``spans`` (stretches of such words: first word,
    number of words, and the code points of the original text from ``start`` up to ``end``).

    Words are runs of ``0-9``, letters and everything beyond ASCII, after A-Z were lower-cased. An item (item_id of any type, text) of fewer words
    than a window, but not none, is one window. A null or empty text has no words, so no hit; a null or empty item has no window. Rows of one
    doc_id are taken each for itself. Rows of one item_id count as one item; a null item_id makes hits, but is not listed. Other
    columns are not read. No items, or no documents, give no hits, or no rows.

    The items' normalised text is counted first; the automata get at most ``most_bytes`` of it each, or a little more, and documents
    pass through as many as are needed, one after the other in the same job. The words of a very long text are
    held 4 MB at a time, beside its bytes.
    """
    if window < 1:
        raise ValueError("a window has one word at least")
    spark = docs.sparkSession
    ship(spark)
    pieces = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    pieces = pieces.mapInArrow(_pieces(window, 1000 + window), "item_id string, text string")
    size = pieces.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    parts = -(-size // most_bytes) or 1
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.lit(None).cast(f"array<{_SPAN}>").alias("spans"),
        F.lit(None).cast("array<string>").alias("items"),
    )
    for i in range(parts):
        held = spark.sparkContext.broadcast([(r[0], r[1].encode()) for r in pieces.filter(part == i).toLocalIterator()])
        last = i == parts - 1
        rows = rows.mapInArrow(_scan(uuid.uuid4().hex, held, window, last), _DONE if last else _PASS)
    return rows
