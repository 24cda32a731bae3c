"""The corpus pipeline: quality, near copies, repeated passages, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``. All stages but the last return the
columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.near_copies import near_copy_groups
from tidemark.llm.packing import packed
from tidemark.llm.quality import learned, scored
from tidemark.llm.repeats import free_name, without_repeats
from tidemark.llm.ship import ship
from tidemark.session import written

#: Documents scored below this go.
LEAST_QUALITY = 0.3
#: Words in a passage that may not repeat.
PASSAGE = 50


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte network does not reject.

    The network learns from labelled documents that are not held out. Null and empty
    texts are scored like others. Repeated rows are judged alike.
    """
    labels = ship(spark).read.parquet(f"{sf_dir}/labels.parquet")
    score = free_name(docs, "quality")
    kept = scored(docs, learned(docs, labels), score_col=score).where(F.col(score) >= LEAST_QUALITY)
    return kept.select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id (5-word shingles, similarity 0.8).

    Ids come before no id; of repeated rows one stays. Documents without words are no
    copies of each other and all stay.
    """
    ship(spark)
    groups = near_copy_groups(docs.select("doc_id", "text"), width=5, percent=80)
    rows = groups.groupBy("group_id", "doc_id", "row_hash").agg(F.count("*").alias("n"))
    low = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_hash", "n"))
    chosen = rows.where("group_id is not null").groupBy("group_id").agg(low.alias("low")).select("low.*").drop("none")
    wordless = rows.where("group_id is null").select("doc_id", "row_hash", F.lit(1).cast("long").alias("n"))
    name, row, times = (free_name(docs, c) for c in ("kept_id", "kept_row", "kept_n"))
    chosen = chosen.union(wordless).toDF(name, row, times)
    same = docs["doc_id"].eqNullSafe(chosen[name]) & (F.xxhash64(docs["doc_id"], docs["text"]) == chosen[row])
    kept = docs.join(chosen, same)
    once = kept.where(chosen[times] == 1).select(*(docs[c] for c in docs.columns))
    repeated = kept.where(chosen[times] > 1).select(*(docs[c] for c in docs.columns)).dropDuplicates(["doc_id", "text"])
    return once.union(repeated)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of ``PASSAGE`` words or more that stand more than once in the corpus.

    Texts without such passages stay as they are; a text that is nothing else becomes empty.
    ``n_chars`` counts what is left.
    """
    ship(spark)
    kept = without_repeats(docs, "text", PASSAGE)
    if "n_chars" not in kept.columns:
        return kept
    kind = docs.schema["n_chars"].dataType
    return kept.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens as sequences whose lengths are powers of two, a row each."""
    ship(spark)
    return packed(docs)


STAGES = [("quality", quality), ("near_copies", near_copies), ("passages", passages), ("packing", packing)]

#: Learned scores, signatures and tokens are beyond SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = ship(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
