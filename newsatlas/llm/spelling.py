"""Spelling variants: every word of a vocabulary next to the words that one edit makes of it.

The vocabulary is counted from all documents. Its words lie in blocked Bloom filters, one set of blocks for each word length, divided into
parts; every word's deletions and replacements are generated as arrays of hashes and probe the filters. Only positives become rows: they
meet the vocabulary in an exact join, which removes the false ones. Insertions are the deletions of the other word.

The filters are broadcast within a bound; a vocabulary beyond it takes several passes, each with some of the parts.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import chunks, give_back, mixed, partitions, ship, stored

LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
#: Letters of words are code points below 256, so that a word is a row of bytes in Latin-1.
_LETTERS = bytes([*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)])
_PLAIN = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _LETTERS else 32 for b in range(256))
#: What a word can hold after A-Z were lower-cased.
ALPHABET = np.frombuffer(bytes(sorted(set(_PLAIN) - {32})), np.uint8)
#: A part of a filter has at most so many blocks of 512 bits, fewer where a length has few words; a word sets ``_BITS`` bits of one block.
PART_BLOCKS, _BITS, WORDS_A_BLOCK = 1 << 14, 8, 24
#: Bytes of filters that are broadcast at once.
MOST_BYTES = 64 << 20
_AT_ONCE = 1 << 21


def lower_runs(text: bytes) -> list[bytes]:
    """The maximal runs of letters of a UTF-8 text, A-Z lower-cased, in Latin-1."""
    if not text.isascii():
        text = text.decode().encode("latin-1", "replace")
    return text.translate(_PLAIN).split()


def typos(doc_id: int | None, runs: Counter, one_in: int) -> Counter:
    """Counts after a letter was deleted from some runs, as a hash of document and run decides."""
    start, out = zlib.crc32(f"{doc_id}:".encode()), Counter()
    for run, n in runs.items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % one_in == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        out[run] += n
    return out


_COUNT_TYPES = pa.schema([("word", pa.string()), ("n", pa.int64())])


def _as_words(words: list[bytes]) -> pa.Array:
    return pa.array([w.decode("latin-1") for w in words], pa.string())


def _counts(least_length: int, typo_one_in: int | None):
    """Counts of a task's words, merged in it as far as a bounded table of them goes."""

    def give(total: Counter) -> pa.RecordBatch:
        long = [(w, n) for w, n in total.items() if len(w) >= least_length]
        total.clear()
        words, n = zip(*long) if long else ((), ())
        return pa.RecordBatch.from_arrays([_as_words(words), pa.array(n, pa.int64())], schema=_COUNT_TYPES)

    def run(batches):
        total: Counter = Counter()
        for rows in chunks(batches, ["doc_id", "text"], most=2_000_000):
            if typo_one_in is None:
                for _, text in rows:
                    total.update(lower_runs(text or b""))
            else:
                for doc_id, text in rows:
                    found = Counter(lower_runs(text or b""))
                    total.update(found if doc_id is None else typos(doc_id, found, typo_one_in))
            if len(total) > 300_000:
                yield give(total)
        yield give(total)
        give_back()

    return run


def vocabulary(
    docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, typo_one_in: int | None = None
) -> DataFrame:
    """Words (word, n) of all texts of ``docs`` (doc_id long, text): runs ``[A-Za-z\\u00C0-\\u00FF]+``, A-Z lower-cased.

    With ``typo_one_in`` a run whose crc32 of ``<doc_id>:<run>`` that number divides first loses one of its code points, which
    plants variants; rows with a null doc_id then stay as they are. Null texts have no words.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = rows.mapInArrow(_counts(least_length, typo_one_in), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def letter_hashes(letters: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A number for a letter at a place; a word's hash is the sum of them, so that edits change few terms."""
    return mixed((places.astype(np.uint64) << np.uint64(8)) + letters.astype(np.uint64) + np.uint64(1))


def word_sums(words: np.ndarray) -> np.ndarray:
    """Hashes of words of one length, the rows of a matrix of letters."""
    return letter_hashes(words, np.arange(words.shape[1])).sum(1, dtype=np.uint64)


def part_of(h: np.ndarray, parts: int) -> np.ndarray:
    return ((mixed(h) >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)


def blocks_for(words: int, parts: int) -> int:
    """The blocks of each part of a filter of so many words."""
    return min(PART_BLOCKS, 1 << max(0, (-(-words // (parts * WORDS_A_BLOCK)) - 1).bit_length()))


def _bits(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The block of each hash, and the ``_BITS`` numbers below 512 of its bits."""
    a, b = mixed(h + np.uint64(0x9E37)), mixed(h ^ np.uint64(0xB5297A4D3F84D5B5))
    block = (a >> np.uint64(40)).astype(np.int64) % blocks
    shifts = np.arange(0, 54, 9, dtype=np.uint64)  # six numbers of nine bits each from b, the others from a
    low = np.concatenate([b[..., None] >> shifts, a[..., None] >> shifts[: _BITS - 6]], axis=-1)
    return block, (low & np.uint64(511)).astype(np.int64)


def filter_of(h: np.ndarray, blocks: int) -> np.ndarray:
    """The bits of one part, as 64-bit words, eight a block."""
    out = np.zeros(blocks * 8, np.uint64)
    block, bits = _bits(h, blocks)
    np.bitwise_or.at(out, (block[:, None] * 8 + (bits >> 6)).ravel(), np.uint64(1) << (bits & 63).astype(np.uint64).ravel())
    return out


class Filters:
    """Bloom filters of some parts, by word length; parts that are left out admit nothing.

    ``shapes`` has the number of parts, and of blocks in each, of every length.
    """

    def __init__(self, shapes: dict[int, tuple[int, int]], held: dict[tuple[int, int], bytes]):
        self.shapes, self.held, self.table = shapes, held, None

    def __getstate__(self):
        return self.shapes, self.held

    def __setstate__(self, state):
        self.__init__(*state)

    def of_length(self, length: int) -> tuple[np.ndarray, np.ndarray] | None:
        """Where in an array each part of a length begins (-1: not here), and the array of all."""
        if self.table is None:
            keys = sorted(self.held)
            self.table = {}
            for n in {k[0] for k in keys}:
                own = [k for k in keys if k[0] == n]
                parts, blocks = self.shapes[n]
                begin = np.full(parts, -1, np.int64)
                begin[[p for _, p in own]] = np.arange(len(own)) * blocks * 8
                self.table[n] = begin, np.concatenate([np.frombuffer(zlib.decompress(self.held[k]), np.uint64) for k in own])
        return self.table.get(length)

    def admits(self, length: int, h: np.ndarray) -> np.ndarray:
        """Indexes of the hashes that may be words of this length."""
        own = self.of_length(length)
        if own is None:
            return np.zeros(0, np.int64)
        begin, bits_of = own
        at = begin[part_of(h, len(begin))] if len(begin) > 1 else np.full(len(h), begin[0])
        left = np.flatnonzero(at >= 0)
        block, bits = _bits(h[left], self.shapes[length][1])
        word = at[left] + block * 8
        for k in range(_BITS):  # most hashes are out after a bit or two
            hit = (bits_of[word + (bits[:, k] >> 6)] >> (bits[:, k] & 63).astype(np.uint64)) & np.uint64(1) != 0
            left, word, bits = left[hit], word[hit], bits[hit]
        return left


def positives(words: np.ndarray, filters: Filters, alphabet: np.ndarray):
    """Words of one length, as a matrix of letters: (index of the word, edit) for edits that the filters admit.

    Edits are words of one letter less, and words with one letter replaced by a later one of ``alphabet``; no edit of a word comes twice.
    """
    n, length = words.shape
    terms = letter_hashes(words, np.arange(length))
    total = terms.sum(1, dtype=np.uint64)
    if length > 1 and filters.of_length(length - 1):
        moved = letter_hashes(words[:, 1:], np.arange(length - 1))  # letters after the deleted one
        head = np.cumsum(terms, 1, dtype=np.uint64) - terms
        tail = np.zeros((n, length), np.uint64)
        tail[:, :-1] = np.cumsum(moved[:, ::-1], 1, dtype=np.uint64)[:, ::-1]
        once = np.ones((n, length), bool)  # of equal neighbours the first is deleted
        once[:, 1:] = words[:, 1:] != words[:, :-1]
        row, at = np.nonzero(once)
        for i in filters.admits(length - 1, (head + tail)[row, at]).tolist():
            word = words[row[i]].tobytes()
            yield int(row[i]), word[: at[i]] + word[at[i] + 1 :]
    if filters.of_length(length):
        for place in range(length):
            new = letter_hashes(alphabet, np.full(len(alphabet), place))
            h = (total - terms[:, place])[:, None] + new[None, :]
            row, letter = np.nonzero(alphabet[None, :] > words[:, place][:, None])
            for i in filters.admits(length, h[row, letter]).tolist():
                edit = bytearray(words[row[i]].tobytes())
                edit[place] = alphabet[letter[i]]
                yield int(row[i]), bytes(edit)


def matrices(words: list[bytes], most: int) -> list[np.ndarray]:
    """Words by length, as rows of letters, in matrices of at least one row and about ``most`` letters."""
    by_length: dict[int, list[bytes]] = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    out = []
    for length, own in by_length.items():
        rows = max(1, most // length)
        for i in range(0, len(own), rows):
            out.append(np.frombuffer(b"".join(own[i : i + rows]), np.uint8).reshape(-1, length))
    return out


def _latin(column: pa.Array) -> list[bytes]:
    return [w.encode("latin-1") for w in column.to_pylist()]


def _placed(shapes: dict[int, tuple[int, int]]):
    """Length, part and hash of each word."""

    def run(batches):
        for batch in batches:
            for m in matrices(_latin(batch.column("word")), _AT_ONCE):
                h, length = word_sums(m), m.shape[1]
                yield pa.RecordBatch.from_pydict(
                    {
                        "length": pa.array(np.full(len(h), length), pa.int32()),
                        "part": pa.array(part_of(h, shapes[length][0]), pa.int32()),
                        "h": pa.array(h.view(np.int64)),
                        "letters": pa.array([_letters_of(m)] * len(h), pa.binary()),
                    }
                )

    return run


def _letters_of(m: np.ndarray) -> bytes:
    return np.unique(m).tobytes()


def _built(shapes: dict[int, tuple[int, int]]):
    """The filter of one part, which has a bounded number of words."""

    def run(table: pa.Table) -> pa.Table:
        h = table.column("h").to_numpy().view(np.uint64)
        letters = b"".join(table.column("letters").unique().to_pylist())
        bits = filter_of(h, shapes[table.column("length")[0].as_py()][1])
        return pa.table(
            {
                "length": table.column("length").slice(0, 1),
                "part": table.column("part").slice(0, 1),
                "bits": pa.array([zlib.compress(bits.tobytes(), 1)], pa.binary()),
                "letters": pa.array([bytes(sorted(set(letters)))], pa.binary()),
            }
        )

    return run


def _probe(filters, alphabet: np.ndarray):
    """Edits of the words that the filters admit, with the word and its count."""

    def run(batches):
        held = filters.value
        for batch in batches:
            words, counts = _latin(batch.column("word")), batch.column("n").to_pylist()
            count = dict(zip(words, counts))
            for m in matrices(words, max(1, _AT_ONCE // len(alphabet))):
                found = list(positives(m, held, alphabet))
                own = [m[i].tobytes() for i, _ in found]
                yield pa.RecordBatch.from_pydict(
                    {
                        "edit": _as_words([e for _, e in found]),
                        "word": _as_words(own),
                        "n": pa.array([count[w] for w in own], pa.int64()),
                    }
                )

    return run


def near_words(words: DataFrame, most_bytes: int = MOST_BYTES, part_words: int | None = None) -> DataFrame:
    """Pairs (word, n, near, near_n) of words that one inserted, deleted or replaced letter tells apart, in both directions.

    ``words`` has rows (word, n), a word once, of letters below U+0100. Filters of at most ``most_bytes`` are broadcast at once; beyond
    that the words are probed in several passes. ``part_words`` is the number of words in a part of a filter.
    """
    spark = words.sparkSession
    ship(spark)
    sizes = {r[0]: r[1] for r in words.groupBy(F.char_length("word").alias("length")).agg(F.count("*").alias("n")).collect()}
    part_words = part_words or PART_BLOCKS * WORDS_A_BLOCK
    parts = {length: max(1, -(-n // part_words)) for length, n in sizes.items()}
    shapes = {length: (parts[length], blocks_for(n, parts[length])) for length, n in sizes.items()}
    placed = words.select("word").mapInArrow(_placed(shapes), "length int, part int, h long, letters binary")
    built = placed.groupBy("length", "part").applyInArrow(_built(shapes), "length int, part int, bits binary, letters binary")
    built = stored(built, "filters")
    alphabet = built.agg(F.collect_set("letters")).first()[0]
    alphabet = np.frombuffer(bytes(sorted(set(b"".join(bytes(a) for a in alphabet)))), np.uint8)
    passes = -(-sum(p * blocks * 64 for p, blocks in shapes.values()) // most_bytes) or 1
    group = F.pmod(F.xxhash64("length", "part"), F.lit(passes))
    edits = None
    for i in range(passes):
        held = {(r.length, r.part): bytes(r.bits) for r in built.filter(group == i).drop("letters").toLocalIterator()}
        filters = spark.sparkContext.broadcast(Filters(shapes, held))
        found = words.select("word", "n").mapInArrow(_probe(filters, alphabet), "edit string, word string, n long")
        edits = found if edits is None else edits.union(found)
    exact = words.select(F.col("word").alias("edit"), F.col("n").alias("edit_n"))
    both = F.array(
        F.struct(F.col("word"), F.col("n"), F.col("edit").alias("near"), F.col("edit_n").alias("near_n")),
        F.struct(F.col("edit").alias("word"), F.col("edit_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")),
    )
    return edits.join(exact, "edit").select(F.explode(both).alias("pair")).select("pair.*")


def roots(forms: DataFrame) -> DataFrame:
    """Rows (word, root) for rows (word, form): from each word the forms followed to the last.

    Forms lead to ever larger counts, so they end. Each round settles the words whose form has been settled; a
    word meets only the words it is the form of, of which there are no more than it has near words.
    """
    left = forms
    settled = forms.select(F.col("form").alias("word")).distinct().join(forms.select("word"), "word", "left_anti")
    settled = settled.select("word", F.col("word").alias("root"))
    out = None
    while True:
        up = settled.select(F.col("word").alias("form"), "root")
        settled = stored(left.join(up, "form").select("word", "root"), "roots")
        if settled.isEmpty():
            return settled if out is None else out
        out = settled if out is None else out.union(settled)
        left = left.join(settled.select("word"), "word", "left_anti")


def spelling_variants(words: DataFrame, ratio: int = RATIO, most_bytes: int = MOST_BYTES, part_words: int | None = None) -> DataFrame:
    """Group the words of a :func:`vocabulary`: rows (word, n, n_near, form, form_n, root), one for each word.

    ``n_near`` is the number of words one edit away; ``form`` the one of largest n (ties: smallest in order of code points) if that is at least
    ``ratio`` times the word's n, else null, with ``form_n``; ``root`` the last word that forms lead to, the word itself if it has none.

    ``words`` (word string, n long) has each word once; nulls, empty words, and words with code points from U+0100 are left out, as the vocabulary
    has none; other columns are not read; no words give no rows. A word of L letters has up to 45 L generated edits, made in
    arrays of bounded size, one word at a time if it is very long.
    """
    words = words.select(F.col("word").cast("string").alias("word"), F.col("n").cast("long").alias("n"))
    words = words.filter(F.col("word").rlike("^[\\x{00}-\\x{FF}]+$") & F.col("n").isNotNull())
    words = stored(words, "vocabulary")
    near = near_words(words, most_bytes, part_words)
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near"))).alias("best")
    near = near.groupBy("word").agg(F.count("*").alias("n_near"), best)
    enough = -F.col("best.minus") >= F.col("n") * ratio
    rows = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"),
        F.when(enough, -F.col("best.minus")).alias("form_n"),
    )
    rows = stored(rows, "forms")
    found = roots(rows.filter("form IS NOT NULL").select("word", "form"))
    return rows.join(found, "word", "left").withColumn("root", F.coalesce("root", "word"))
