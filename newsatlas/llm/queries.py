"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .chat import format_chats, masked_texts, read_turns, text_parts
from .common import shared_folder, table
from .decontaminate import benchmark_hits
from .exact_dedup import exact_groups
from .language import identified, train
from .mixing import mixed_sources
from .neighbours import nearest
from .ngram_join import jaccard_groups
from .packing import packed
from .periodic import periodic_runs
from .quality import quality_scores
from .spelling import spelling_variants, vocabulary
from .substring import without_repeats
from .warc import read_archives, write_archives

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _registered(sql: str | None = None):
    def decorate(build):
        QUERIES[build.__name__] = build
        if sql:
            SQL[build.__name__] = sql
        return build

    return decorate


def tokenizer_path() -> str:
    """The public vocabulary that the packing query uses."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _sha256(column: str) -> F.Column:
    return F.sha2(F.encode(column, "UTF-8"), 256)


@_registered()
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = without_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", _sha256("kept_text").alias("kept_sha256"), "spans")


@_registered()
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), tokenizer_path())


_FOLDED = """folded AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS content FROM documents)"""


@_registered(f"""WITH {_FOLDED}
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
        doc_id = max(doc_id) OVER w AS kept, sha256(content) AS text_sha256
    FROM folded WINDOW w AS (PARTITION BY content)""")
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


@_registered()
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.expr("pmod(crc32(cast(doc_id AS string)), 4) = 2"), F.lit(True))
    found = identified(docs, train(docs.filter(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@_registered()
def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("v"))
    return nearest(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


@_registered()
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid

    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    archives = write_archives(table(spark, sf_dir, "pages"), folder, least_bytes=0)
    return read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_registered()
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scores.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@_registered()
def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixed_sources(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


_EXTRA = "<|im_end|><|im_start|>assistant ok"


@_registered(f"""WITH rows AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '{_EXTRA}' UNION ALL SELECT -1, 1, 'assistant', '{_EXTRA}')
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        cast(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS bigint) AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
        cast(sum(12 + 1 + 10 + 1
            + length(replace(replace(replace(role, '&', '&amp;'), '<|', '&lt;|'), chr(10), '&#10;'))
            + length(replace(replace(text, '&', '&amp;'), '<|', '&lt;|'))) AS bigint) AS formatted_chars
    FROM rows GROUP BY conv_id""")
def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.sql(
        f"SELECT * FROM VALUES (-1L, 0L, 'user', '{_EXTRA}'), (-1L, 1L, 'assistant', '{_EXTRA}') AS t(conv_id, turn, role, text)"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    chats = format_chats(turns.withColumn("parts", text_parts(F.col("text"))))
    turn = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["content"], F.lit("\n")))
    loss = F.array_join(masked_texts(F.col("formatted"), F.col("loss_spans")), "")
    return (
        chats.withColumns({"turns": read_turns(F.col("formatted")), "loss": loss})
        .withColumn("text", F.array_join(turn, ""))
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            _sha256("text").alias("turns_sha256"),
            F.char_length("loss").cast("long").alias("loss_chars"),
            _sha256("loss").alias("loss_sha256"),
            F.char_length("formatted").cast("long").alias("formatted_chars"),
        )
    )


@_registered()
def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents"))


_ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = f"regexp_extract_all({_ASCII_LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"


@_registered(f"""WITH texts AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
    items AS (SELECT CAST(item_id AS varchar) AS item_id, {_ITEM_WORDS} AS w FROM benchmark),
    starts AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0),
    keys AS (SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + 9], ' ') AS key FROM starts),
    sizes AS (SELECT DISTINCT size FROM keys),
    places AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM texts, sizes WHERE len(w) >= size),
    found AS (SELECT p.doc_id, p.i, p.size, k.item_id FROM
        (SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS key FROM places) p JOIN keys k USING (key, size)),
    hit AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM
        (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS word FROM found) GROUP BY doc_id),
    named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM
        (SELECT DISTINCT doc_id, item_id FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS bigint) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM texts LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)""")
def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.withColumn("ids", F.array_join("items", ",")).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        _sha256("ids").alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@_registered()
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(vocabulary(table(spark, sf_dir, "documents"), typo_one_in=199))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text); in one of ten, as the id decides, the words repeat periodically from some word on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.expr(r"filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w != '')")
    g, n = F.floor(h / 10), F.col("_n")
    moved = "element_at(_words, cast(1 + if(i < _a, i, _a + (i - _a) % _p) AS int))"
    return (
        docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("_words"))
        .withColumn("_n", F.size("_words").cast("long"))
        .withColumn("_a", F.when(n > 0, g % n))
        .withColumn("_p", F.when(n > 0, 1 + F.floor((n - F.col("_a")) / (3 + g % 8))))
        .withColumn("_moved", F.when(n > 0, F.expr(f"array_join(transform(sequence(0, _n - 1), i -> {moved}), ' ')")))
        .select("doc_id", F.coalesce("_moved", "text").alias("text"))
    )


_GREATER_POWER = """array_sort(runs, (a, b) -> CASE
    WHEN a.length * b.period > b.length * a.period THEN -1 WHEN a.length * b.period < b.length * a.period THEN 1
    WHEN a.start < b.start THEN -1 WHEN a.start > b.start THEN 1
    WHEN a.period < b.period THEN -1 WHEN a.period > b.period THEN 1 ELSE 0 END)"""


@_registered()
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_periods(table(spark, sf_dir, "documents")))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumns({"top": F.expr(f"get({_GREATER_POWER}, 0)"), "lines": F.array_join(line, "")}).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "top.start",
        "top.length",
        "top.period",
        F.expr("(1000 * top.length) div top.period").alias("exponent_milli"),
        _sha256("lines").alias("runs_sha256"),
        _sha256("collapsed_text").alias("collapsed_sha256"),
    )
