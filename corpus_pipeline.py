"""A training corpus from the documents table: identified, without near copies and benchmark items, redacted, and packed.

Each stage takes what the one before kept and decides by itself; all but the last return the columns of documents. Null, empty and
repeated rows are handled as each operator's docstring states: texts without letters leave in the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadpulse.llm import forest, language, packing, pii, templates
from roadpulse.llm.common import Scratch, read_table

TOKENIZER = "word_bpe_49k.json"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents mostly in one language, by a model of the training documents among them."""
    return language.keep_identified(docs, language.train(language.training_rows(docs)))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each class of near copies."""
    return forest.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents without benchmark items."""
    return templates.clean_of(docs, read_table(spark, sf_dir, "benchmark"), whole=True)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in texts; no document goes."""
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences, with their token ids."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path(TOKENIZER), with_ids=True)


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

# Packing and MinHash have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each stored before the next."""
    scratch, docs = Scratch(spark, "pipeline"), read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
