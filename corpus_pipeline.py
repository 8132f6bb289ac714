"""The corpus pipeline: toxicity, near-duplicates, decontamination, secrets, packing.

Each stage takes (spark, documents, folder of tables), works on all rows it is given and
returns a DataFrame, which is written as Parquet and read again for the next one. All but the
last return the columns of ``documents``. Nulls are handled as the operators state: a null
text is an empty text, and stays null in what a stage returns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cellwise.llm import contamination, packing, secrets, shingles, toxicity
from cellwise.llm import queries as _operators
from cellwise.llm.spread import importable, table
from cellwise.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine scores below its threshold stay."""
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row stays, of the smallest id that the group has.

    Near are texts whose shingles of five words have a Jaccard similarity of 0.8 or more.
    SimHash fingerprints of these shingles give candidates, min-hash bands the candidates that
    fingerprints cannot, and the sets decide; the four words of ``op6_simhash`` are that
    query's own. A row that repeats an id, or has none, stays or goes by its own text.
    """
    importable(spark)
    return shingles.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item stay."""
    return contamination.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts are replaced, and n_chars follows."""
    importable(spark)
    return secrets.redact(docs, "text", "n_chars")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    importable(spark)
    return packing.pack(docs, public_tokenizers.path(_operators.TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack_sequences),
]

# SQL can express neither a trained model nor a tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


def queries() -> dict:
    return _operators.queries() | {"pipeline": run}


def oracle_sql() -> dict:
    return _operators.oracle_sql() | ({"pipeline": ORACLE_SQL} if ORACLE_SQL else {})
