"""From raw documents to token ids: rules, near-duplicates, secrets, mixing, encoding.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows of ``docs``. Its result
is written as Parquet in the shared folder and read again as the input of the next one.
All but the last return the columns of documents.
"""

import public_tokenizers
from pyspark.sql import functions as F

from lexiframe.catalog.registry import table
from lexiframe.llm import bpe, minhash, mixing, repetition, secrets
from lexiframe.sources.scratch import materialise

TOKENIZER = "word_bpe_49k.json"


def quality_rules(spark, docs, sf_dir):
    """Documents that the repetition rules keep."""
    return repetition.keep_good(docs)


def near_dedup(spark, docs, sf_dir):
    """The first document of each group of near-duplicates: five words, 80 % or more."""
    return minhash.keep_first(docs)


def secret_scan(spark, docs, sf_dir):
    """All documents, every secret replaced, with the length that is left."""
    return secrets.redact(docs).withColumn(
        "n_chars", F.coalesce(F.length("text").cast("bigint"), F.col("n_chars"))
    )


def source_mix(spark, docs, sf_dir):
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def token_ids(spark, docs, sf_dir):
    """``(doc_id, n_tokens, ids)`` of each row."""
    return bpe.encode(docs, bpe.read_tokenizer(public_tokenizers.path(TOKENIZER)))


STAGES = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("secret scan", secret_scan),
    ("source mix", source_mix),
    ("token ids", token_ids),
]

#: SQL can't express the suffix rules, the verified components and the encoding.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
