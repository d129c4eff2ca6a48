"""A training-data pipeline over the table documents: each stage calls one operator and works on what the last one kept.

1. quality: documents that the classifier rejects (score below one half) go; null and blank texts are scored like any other.
2. lines: fuzzy duplicate lines go, but for their first occurrence; a document that loses all its lines goes with them.
3. near_duplicates: of each component of near duplicates over five-word shingles (SimHash, or a Jaccard similarity of 0.8 or
   more) one document stays.
4. decontamination: documents that hold a benchmark item, also edited, go.
5. tokens: the ids of each text as byte-level BPE, with a check that they decode to the same bytes.

All but the last stage return the columns of documents, whatever they are. Empty input gives empty output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapline.llm import byte_bpe, decontaminate, line_dedup, quality, simhash
from tapline.llm.common import staged, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, score_col="_tl_score").where("_tl_score >= 0.5").select(*docs.columns)


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup_lines(docs)
    emptied = (F.col("n_removed") > 0) & (F.trim("text") == "")
    return done.where(~F.coalesce(emptied, F.lit(False))).select(*docs.columns)


def no_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.first_of_each(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    back = byte_bpe.transcode(docs.select("doc_id", "text"), path, pattern)
    return back.select(
        "doc_id", F.coalesce(F.octet_length("ids") / 4, F.lit(0)).cast("long").alias("n_tokens"), "ids",
        (F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).alias("round_trip"))


STAGES = [
    ("quality", good_quality),
    ("lines", fresh_lines),
    ("near_duplicates", no_near_duplicates),
    ("decontamination", no_benchmark),
    ("tokens", tokens),
]

# The classifier, fingerprint and alignment stages have no form in SQL; tests compare them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage keeps is written to the shared scratch folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
