"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows of the stage before and returns a
DataFrame that can be written and read as the next one's docs. All but the last return the
columns of documents as they came.
"""

from __future__ import annotations

import public_tokenizers

from amperine.llm import exact, language, minhash, mixing, packing
from amperine.llm.common import stored, table

TOKENIZER = "word_bpe_49k.json"


def language_id(spark, docs, sf_dir):
    """Drops documents whose language is not recognised."""
    return language.keep_recognised(docs, language.fit(language.training_rows(docs)))


def exact_dedup(spark, docs, sf_dir):
    """Keeps of equal texts the one with the largest id."""
    return exact.drop_copies(docs)


def near_dedup(spark, docs, sf_dir):
    """Keeps one document of each group that shares 80 % of its five-word shingles."""
    return minhash.keep_one_each(docs)


def source_mixing(spark, docs, sf_dir):
    """Takes documents, some of them twice, to the target weights of their sources."""
    return mixing.mix(docs)


def best_fit_packing(spark, docs, sf_dir):
    """Places of the token pieces of all documents in sequences."""
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

# Neither the language model nor MinHash nor the tokenizer can be expressed in SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over documents, each written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
