"""Training-data pipeline over `documents`: language, exact copies, near copies, source mix, tokens.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns the next stage's documents, which
`run` writes to the shared folder and reads again. All but the last return the columns of `documents`.
"""

from pyspark.sql import functions as F

from riskweave.llm import bpe, exact_dedup, jaccard, language, mixing, tables
from riskweave.llm.queries import tokenizer

# The mix selects blocks in a seeded order and near copies are components of links: neither is a SQL expression.
ORACLE_SQL = None


def language_id(spark, docs, sf_dir):
    """Documents whose language is identified stay."""
    return language.accepted_documents(spark, docs)


def exact_copies(spark, docs, sf_dir):
    """Of equal texts the document with the largest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark, docs, sf_dir):
    """Of documents linked by a similarity of 0.8 or more on 5-word shingles the smallest doc_id stays."""
    near = jaccard.near_duplicates(spark, docs, k=5, p=80, q=100)
    stays = near.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_id")).distinct()
    return docs.alias("d").join(stays.alias("s"), F.col("d.doc_id").eqNullSafe(F.col("s._id")), "left_semi")


def source_mix(spark, docs, sf_dir):
    """Documents as often as the mix of sources takes them, 0 to 3 times."""
    return mixing.mixed_documents(spark, docs)


def tokens(spark, docs, sf_dir):
    """Token ids of every document, decoded again to check the round trip: doc_id, n_tokens, ids, text_sha256 of the decoded bytes."""
    known, pattern = tokenizer()
    done = bpe.encode(spark, docs, known, pattern, most=1 << 19)  # half the shipped words: the driver holds other stages too
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("text_sha256"))


STAGES = [
    ("language_id", language_id),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("source_mix", source_mix),
    ("tokens", tokens),
]


def run(spark, sf_dir):
    """The last stage's rows for the documents below `sf_dir`."""
    docs = tables.read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = tables.store(spark, stage(spark, docs, sf_dir), name)
    return docs
