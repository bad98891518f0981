"""Corpus pipeline: stages over ``documents``, each written as Parquet and read by the next one.

Each stage takes ``(spark, docs, sf_dir)`` and works on every row its predecessor
kept. All but the last return the columns of ``documents``:

1. ``language_id``: documents without a known language go;
2. ``exact_dedup``: of equal texts the smallest doc_id stays;
3. ``simhash_near_dedup``: of each group within 4 bits the smallest doc_id stays;
4. ``secret_scan``: found secrets are blanked out of the texts;
5. ``packing``: the texts become token sequences of at most 4096.

``run`` gives the last stage's rows. The language and fingerprint stages cannot
be said in SQL, so ``ORACLE_SQL`` is None and ``tests/llm`` holds ``run`` against
a brute-force version.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ruleforge.llm import exact_dedup, language_id, packing, secrets, simhash
from ruleforge.llm.common import shared_dir, table
from ruleforge.llm.queries import tokenizer_file


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text has letters and is near enough to a language learnt from ``docs``."""
    return language_id.keep_known(docs, language_id.fit(docs))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    return exact_dedup.keep_one(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (4-word shingles, at most 4 bits)."""
    return simhash.keep_first(docs, words=4, radius=4)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with secrets replaced by a mark and ``n_chars`` brought up to date."""
    return secrets.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their sequence and offset."""
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("simhash_near_dedup", near_stage),
    ("secret_scan", secret_stage),
    ("packing", packing_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a Parquet table in the shared folder."""
    top = f"{shared_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        path = f"{top}/{k}-{name}"
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
