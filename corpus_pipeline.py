"""From raw documents to packed training sequences, in five stages that each use one operator.

A stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet and read again as
the next stage's documents. All but the last return the columns of documents, whatever these are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import MapType

from newsatlas.llm.common import stored, table
from newsatlas.llm.exact_dedup import exact_groups
from newsatlas.llm.mixing import mixed_sources
from newsatlas.llm.ngram_join import jaccard_groups
from newsatlas.llm.packing import packed
from newsatlas.llm.quality import quality_scores
from newsatlas.llm.queries import tokenizer_path

#: A document with a lower quality score goes.
LEAST_QUALITY = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that the classifier rejects. A row without an id stays, as no score is its own."""
    scores = quality_scores(docs, table(spark, sf_dir, "labels"))
    return docs.join(scores.filter(F.col("score") < LEAST_QUALITY).select("doc_id"), "doc_id", "left_anti").select(docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: that of the largest id, and of its repeated rows the least."""
    sha = F.sha2(F.encode(_folded(F.coalesce("text", F.lit(""))), "UTF-8"), 256)
    rows = docs.select(F.struct("*").alias("row"), _id(F.col("doc_id").cast("long")).alias("id"), sha.alias("sha"))
    found = exact_groups(docs).groupBy(_id(F.col("doc_id")).alias("id"), F.col("text_sha256").alias("sha"))
    found = found.agg(F.max("kept").alias("kept"), F.count("*").alias("n")).filter("kept")
    rows = rows.join(found, ["id", "sha"])
    again = rows.filter("n > 1").groupBy("id", "sha").agg(F.min("row").alias("row"))
    return rows.filter("n = 1").select("row").union(again.select("row")).select("row.*")


def _id(doc_id):
    """An id as text, in which a null is equal to itself."""
    return F.coalesce(doc_id.cast("string"), F.lit(""))


def _folded(text):
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest id. Rows without an id or words stay."""
    copies = jaccard_groups(docs).filter("doc_id != component_id").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; of one taken in part, its first words, joined by spaces.

    Documents without words are taken no time. If there is a column n_chars, it is right for what is left. Rows that are equal in all columns are
    taken together, as often as the mix takes all of them.
    """
    names = {f"_name_{i}": _row_hash(docs, i) for i in (1, 2)}
    named = docs.withColumns(names)
    takes = mixed_sources(named, carry=tuple(names)).filter("taken > 0").groupBy(*names)
    takes = takes.agg(F.sum("taken").alias("taken"), F.first("size").alias("size"))
    # Of a name, how many rows there are: those that aren't taken count too.
    takes = takes.join(named.groupBy(*names).agg(F.count("*").alias("rows")), list(names))
    rows = named.select(F.struct(*docs.columns).alias("row"), *names).join(takes, list(names))
    once = rows.filter("rows = 1").select("row", "size", "taken")
    # Equal rows become one, and its takes are dealt out in portions, so that no task makes very many copies.
    again = rows.filter("rows > 1").groupBy(*names).agg(F.first("row").alias("row"), F.first("size").alias("size"), F.first("taken").alias("taken"))
    portion = F.col("size") * 1000
    again = again.withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("taken") - 1) / portion).cast("long"))))
    again = again.repartition(*names, "from").select("row", "size", F.least(portion, F.col("taken") - F.col("from") * portion).alias("taken"))
    part = F.col("taken") % F.col("size")
    copies = F.concat(
        F.array_repeat("size", (F.col("taken") / F.col("size")).cast("int")), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<long>"))
    )
    words = F.regexp_extract_all("row.text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    cut = F.array_join(F.slice(words, 1, F.col("words").cast("int")), " ")
    whole = F.col("words") == F.col("size")
    rows = once.unionByName(again).select("row", "size", F.explode(copies).alias("words"))
    row = F.col("row").withField("text", F.when(whole, F.col("row.text")).otherwise(cut))
    rows = rows.select(row.alias("row"), whole.alias("whole"))
    if "n_chars" in docs.columns:
        length = F.when(F.col("whole"), F.col("row.n_chars")).otherwise(F.char_length("row.text").cast(docs.schema["n_chars"].dataType))
        rows = rows.select(F.col("row").withField("n_chars", length).alias("row"))
    return rows.select("row.*")


def _row_hash(docs: DataFrame, seed: int):
    """A hash of all columns, nulls told apart by their places; two of them name a row."""
    columns = [F.col(f"`{f.name}`") for f in docs.schema.fields if not isinstance(f.dataType, MapType)]
    return F.xxhash64(F.lit(seed), *columns, *[c.isNull() for c in columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return packed(docs, tokenizer_path())


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("source mix", mix),
    ("best-fit packing", pack),
]

#: SQL can't express the classifier; the tests follow the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
