"""From raw documents to packed training sequences.

Each stage works on all that the stage before it kept, and is written as Parquet in the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagewright.llm import decontaminate, line_dedup, near_texts, packing, quality
from wagewright.llm.common import discard, stored
from wagewright.llm.queries import table, tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects (score below 0.7) go.

    Null and empty texts are judged like any other; repeated rows stay or go together; an empty table stays empty. Like
    all stages but the last it returns the columns of docs, whatever their names.
    """
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go, but for the first; n_chars follows the text.

    All rows stay: a null text stays null, and one whose lines all go becomes empty. Repeated rows are one document.
    """
    kept = line_dedup.dedup_lines(docs).select(*docs.columns)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: that of the smallest id.

    Of repeated rows one stays. Null texts and texts without words are near to each other and to nothing else, so one of
    them stays; rows without an id stay only in groups without any.
    """
    return near_texts.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go.

    Null and empty texts stay; repeated rows stay or go together; without benchmark items everything stays.
    """
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces in sequences of at most 4096 tokens.

    A null text is packed as an empty one, repeated rows as often as they come; an empty table gives no rows.
    """
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("best-fit packing", packing_stage),
]

#: SQL can express neither the classifier nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        made = stage(spark, docs, sf_dir)
        kept = stored(made, name.replace(" ", "-"))
        discard(docs, made)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
