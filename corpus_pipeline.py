"""Raw documents to token ids: five stages, each over all rows that its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as
the next stage's documents. The last returns the encoded documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierlake import scratch
from tierlake.llm import bpe_automaton, mixing, near_dedup, quality_classifier, queries, secret_scan

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = quality_classifier.train(docs, queries.table(spark, sf_dir, "labels"))
    return quality_classifier.keep_good(docs.select(*COLUMNS), model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.deduplicate(docs.select(*COLUMNS))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets replaced by their kind, lengths brought up to date."""
    clean = secret_scan.redact(docs.select(*COLUMNS), secret_scan.train(docs))
    return clean.withColumn("n_chars", F.char_length("text").cast("bigint"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: not at all, once or twice."""
    return mixing.mix(docs.select(*COLUMNS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text, for each row of the mix."""
    return bpe_automaton.encode_and_decode(docs, queries.WORD_BPE)


STAGES = [
    ("quality classifier", drop_poor),
    ("MinHash near-dedup", drop_near_copies),
    ("secret scans", redact_secrets),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode),
]

# The classifier, the sketches, the field and the automaton are not SQL; a test replays the stages and the library's encoder.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for position, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if position < len(STAGES) - 1:
            docs = scratch.stored(docs, "stage")
    return docs
