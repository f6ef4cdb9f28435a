"""From raw documents to token ids: five stages that each work on what the last one kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result
to the shared checkpoint folder and reads it again for the next stage.
"""

import uuid

from deskpulse.llm import bpe_tree, mixing, secret_scan, simhash, weak_labels
from deskpulse.llm.common import checkpoint_folder, read

# No stage but the first reads a given table, and none of them can be said in SQL.
ORACLE_SQL = None


def quality(spark, docs, sf_dir):
    """Only documents the weak-label classifier keeps."""
    return weak_labels.keep_good(docs)


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near copies."""
    return simhash.keep_one(docs)


def secrets(spark, docs, sf_dir):
    """All documents, secrets masked."""
    return secret_scan.without_secrets(docs)


def mix(spark, docs, sf_dir):
    """Each document as often as its source's target weight asks for."""
    return mixing.mixed(docs)


def encode(spark, docs, sf_dir):
    """The documents with their byte-level BPE ids in place of the texts."""
    return bpe_tree.encode_texts(docs)


STAGES = [
    ("quality classifier", quality),
    ("simhash near-dedup", near_duplicates),
    ("secret scan", secrets),
    ("mixing to target weights", mix),
    ("byte-level BPE", encode),
]


def run(spark, sf_dir):
    """Token ids of the documents of a folder of tables."""
    docs = read(spark, sf_dir, "documents")
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
