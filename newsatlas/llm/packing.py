"""Best-fit packing of token sequences with a bounded number of open bins.

Each task packs its own documents in one pass and needs no shuffle. A second pass does the same with the bins that
tasks could not fill, so that many small tasks waste no more than few large ones.
"""

from __future__ import annotations

import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import chunks, ship, stored

LENGTH = 2048
OPEN_BINS = 256
CACHED_WORDS = 300_000
#: New words of letters that the tokenizer gets as one text.
WORDS_TOGETHER = 1024
#: Sequence numbers of a task start at its number times this.
PER_TASK = 1 << 33
#: Tasks whose unfilled bins are packed again together.
TOGETHER = 32


class OpenBins:
    """Online best fit over at most ``most`` open bins, found through a bitset of their free space.

    Bit f of ``bits`` is set while some open bin has f places free, so the best bin for an item of size s is at
    the lowest set bit from s on. When a new bin would be one too many, the fullest closes first.
    """

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.bits, self.open = 0, 0
        self.by_free: dict[int, list[int]] = {}
        self.made = 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        number = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        self.open -= 1
        return number

    def put(self, size: int) -> tuple[int, int]:
        """The bin's number and the place in it of an item; 0 < size <= capacity."""
        fitting = self.bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            if self.open == self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
            number, free = self.made, self.capacity
            self.made += 1
        left = free - size
        if left:
            self.by_free.setdefault(left, []).append(number)
            self.bits |= 1 << left
            self.open += 1
        return number, self.capacity - free


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


_LAST_MARK = re.compile(rb"(?<=[a-z])[.,](?=[ \n]|$)")


def plain_words(text: bytes) -> list[bytes]:
    """Words with the tokens of the text's words, but fewer different ones.

    The tokenizer lower-cases and divides letters from marks, so that A-Z may be lower-cased here, and a
    full stop or comma that ends a word be a word. Where a control string may stand, the text is left as it is.
    """
    if b"<|" in text:
        return text.split()
    return _LAST_MARK.sub(rb" \g<0>", text.lower()).split()


class WordIds:
    """Token ids, as little-endian 32-bit numbers, of a text by its words.

    This is right for tokenizers that lower-case, drop ASCII white space and never join across it, nor letters and marks, as
    the word-end BPE does; a text is then the sequence of its words' ids. Words are cached, within a bound. New words of letters only are
    given to the tokenizer many at once: each ends at its first token that ends a run of letters.
    """

    def __init__(self, path: str, most: int = CACHED_WORDS):
        self.tokenizer, self.most, self.known, self.older = _tokenizer(path), most, {}, {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that end a run of letters
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def learn(self, words: set[bytes]) -> None:
        """Have the ids of all these words. Of the others, those not met for long are forgotten."""
        if len(self.known) > self.most:
            self.known, self.older = {}, self.known
        known, older, new = self.known, self.older, []
        for w in words:
            if w not in known:
                if w in older:
                    known[w] = older[w]
                else:
                    new.append(w)
        texts = [w.decode() for w in new]
        letters = [i for i, t in enumerate(texts) if t.isalpha()]
        others = [i for i, t in enumerate(texts) if not t.isalpha()]
        for start in range(0, len(letters), WORDS_TOGETHER):
            some = letters[start : start + WORDS_TOGETHER]
            ids = np.array(self._encoded([" ".join([texts[i] for i in some])])[0].ids, "<u4")
            cuts = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
            if len(cuts) != len(some):  # a word of them isn't one run of letters once it is normalised
                others += some
                continue
            packed_ids, at = ids.tobytes(), 0
            for i, end in zip(some, cuts):
                known[new[i]] = packed_ids[at:end]
                at = end
        for i, encoded in zip(others, self._encoded([texts[i] for i in others])):
            known[new[i]] = array("I", encoded.ids).tobytes()

    def _encoded(self, texts: list[str]) -> list:
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)

    def rows(self, rows: list[tuple]) -> list[tuple]:
        """Rows (doc_id, text) with the text's ids in its place."""
        out, at = [], 0
        while at < len(rows):  # a few rows at once, so that few new words are held
            some, size = [], 0
            while at < len(rows) and (not some or size < 4_000_000):
                some.append((rows[at][0], plain_words(rows[at][1] or b"")))
                size += len(rows[at][1] or b"")
                at += 1
            self.learn({w for _, words in some for w in words})
            known = self.known.__getitem__
            out += [(doc_id, b"".join(map(known, words))) for doc_id, words in some]
        return out


@lru_cache(maxsize=2)
def _word_ids(path: str) -> WordIds:
    """One for each worker process, so that its tasks share what it has learnt."""
    return WordIds(path)


_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, place long, used long"
_TYPES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        *((c, pa.int64()) for c in ("start", "length", "ids_crc32", "bin", "place", "used")),
    ]
)


def _pack_task(path: str, length: int, most: int, end_id: int):
    ending = np.array([end_id], "<u4").tobytes()

    def pack(batches):
        """Pieces, and at the end a row (bin, used) for each bin that is still open."""
        bins, ids = OpenBins(length, most), _word_ids(path)
        task = TaskContext.get().partitionId() * PER_TASK
        for rows in chunks(batches, ["doc_id", "text"], most=4_000_000):
            out = []
            for doc_id, tokens in ids.rows(rows):
                tokens = memoryview(tokens + ending)
                for k, at in enumerate(range(0, len(tokens), 4 * length)):
                    part = tokens[at : at + 4 * length]
                    number, place = bins.put(len(part) // 4)
                    out.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part), task + number, place, None))
            yield _batch(out)
        yield _batch([(None,) * 5 + (task + n, None, length - f) for f, ns in bins.by_free.items() for n in ns])

    return pack


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(_TYPES)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _TYPES)], schema=_TYPES)


def _repack(length: int, most: int):
    def repack(frame):
        """The open bins of some tasks, fullest first, as items of a best fit."""
        bins = OpenBins(length, most)
        frame = frame.sort_values(["used", "bin"], ascending=[False, True])
        placed = [bins.put(int(u)) for u in frame["used"]]
        first: dict[int, int] = {}
        for (number, _), b in zip(placed, frame["bin"]):
            first.setdefault(number, b)
        frame["sequence_id"] = [first[number] for number, _ in placed]
        frame["shift"] = [place for _, place in placed]
        return frame[["bin", "sequence_id", "shift"]]

    return repack


def packed(
    docs: DataFrame, tokenizer_path: str, length: int = LENGTH, open_bins: int = OPEN_BINS, end_id: int = 0
) -> DataFrame:
    """Pack all documents (doc_id long, text string) into sequences of at most ``length`` tokens.

    Returns a row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. A document is its tokens
    and then ``end_id``; only one longer than ``length`` is cut, into pieces of that length and a rest. Pieces fill a
    sequence from 0 without gaps.

    Null and empty texts are ``end_id`` alone. Repeated rows are packed each by itself. A null doc_id is kept as
    null. An empty table gives no rows. Other columns are not read. A document's tokens are held in memory
    one document at a time. The tokenizer must treat words apart (see ``WordIds``).
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.mapInArrow(_pack_task(tokenizer_path, length, open_bins, end_id), _PIECES)
    both = stored(rows, "pieces")
    pieces = both.filter(F.col("used").isNull())
    # A group has at most the open bins of TOGETHER tasks.
    moved = (
        both.filter(F.col("used").isNotNull())
        .select("bin", "used", F.floor(F.col("bin") / F.lit(PER_TASK * TOGETHER)).alias("tasks"))
        .groupBy("tasks")
        .applyInPandas(_repack(length, open_bins), "bin long, sequence_id long, shift long")
    )
    return pieces.join(moved, "bin", "left").select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        F.coalesce("sequence_id", "bin").alias("sequence_id"),
        (F.col("place") + F.coalesce("shift", F.lit(0))).alias("offset"),
    )
