"""From raw documents to packed token windows.

Each stage gets the documents that its predecessor kept, whole, and judges them as its own input; its
result is written as Parquet and read again before the next. Repeated passages are looked for only after
near duplicates have gone, and benchmark passages only in what is left then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tesserae.llm import decontamination, near_copies, packing, quality, suffix_dedup
from tesserae.llm.common import ensure_importable, materialize, table
from tesserae.llm.encode import default_path
from tesserae.session import held_paths, release


#: Every passage of over 50 words has a window of so many words, even if words at its edges run into others.
PASSAGE_WORDS = 45

#: Words whose ids a worker keeps while it packs: fewer than packing alone would, since it has served other stages too.
PACK_CACHE_WORDS = 300_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio, with all columns.

    Null and empty texts have too few words and go; equal rows stay or go together; rows with null doc_ids are judged
    like others; an empty table gives no rows.
    """
    ensure_importable(spark)
    return quality.kept_docs(docs, quality.trusted(spark, sf_dir))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word Jaccard similarities of 0.8 or more link, the one with the least doc_id.

    Equal rows are one; null and empty texts are one group; all columns stay; an empty table gives no rows.
    """
    ensure_importable(spark)
    return near_copies.keep_one(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of PASSAGE_WORDS words or more that occur more than once.

    A text can become empty; a null text stays null; equal rows are copies of each other; all columns stay, n_chars is
    counted anew; an empty table gives no rows.
    """
    ensure_importable(spark)
    return suffix_dedup.clean(docs, PASSAGE_WORDS, 8, "word")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item, with all columns.

    Null and empty texts hold none and stay; equal rows stay or go together; an empty table gives no rows.
    """
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 2048 tokens.

    A null or empty text is one piece, the end id alone; equal rows are packed one by one; an empty table gives no rows.
    """
    ensure_importable(spark)
    return packing.digest(packing.pack(docs, default_path("byte_bpe_50k.json"), cache_words=PACK_CACHE_WORDS))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("passage_dedup", passage_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

#: SQL can't express sorting suffixes, links over several steps or packing; tests follow the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents. What a stage has written besides its result goes once that stands, and the result
    when the next one's does, so that not all tables of a long run are held at once."""
    docs, last = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        before = held_paths()
        docs = materialize(stage(spark, docs, sf_dir), name)
        *inner, result = [p for p in held_paths() if p not in before]
        release(spark, inner + last)
        last = [result]
    return STAGES[-1][1](spark, docs, sf_dir)


def queries():
    return {"pipeline": run}


def oracle_sql():
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
