"""Corpus pipeline: quality classifier, line dedup, near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
as the next stage's docs. All but the last return the columns of documents. A stage works on
all rows it is given; nulls, empty texts, repeated rows and empty tables follow the rules in the
operators' docstrings. Rows with a null doc_id pass through every filtering stage but the first, which judges
texts alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillweave.llm import jaccard, line_crf, line_dedup, mixing, packing
from tillweave.llm.shared import fresh, settled


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line CRF scores at its threshold or more; trained on labels.quality."""
    model = line_crf.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return line_crf.accepted(docs, model)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in an earlier document go; n_chars follows the text. Documents stay, if emptied too."""
    out = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars").cast("long")))
    return out.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group that links connect; of rows of one doc_id and text the smallest."""
    keep = settled(jaccard.linked(docs).filter("doc_id = component_id").select("doc_id").distinct())
    kept, row, same = docs.join(keep, "doc_id", "left_semi"), fresh(docs, "row"), fresh(docs, "same")
    unordered = {f.name for f in kept.schema if any(kind in f.dataType.simpleString() for kind in ("map<", "variant"))}
    order = F.struct(*(F.to_json(F.struct(c)) if c in unordered else F.col(c) for c in kept.columns))  # maps have no order
    once = kept.groupBy(F.col("doc_id").alias(fresh(docs, "id")), F.xxhash64("text").alias(same)).agg(F.min_by(F.struct(*kept.columns), order).alias(row))
    return once.select(f"{row}.*").select(*docs.columns).unionByName(docs.filter("doc_id is null"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: not at all, or up to three times."""
    mixed, copy = mixing.mix(docs).filter("mix_copies > 0"), fresh(docs, "copy")
    return mixed.withColumn(copy, F.explode(F.expr("array_repeat(1, mix_copies)"))).select(*docs.columns)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens."""
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return packing.packed(docs, vocabulary)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing to target weights", mixture),
    ("packing", packed_sequences),
]

#: SQL can express neither the CRF nor the packing; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
