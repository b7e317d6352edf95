"""A training corpus from raw documents: toxic texts go, near-duplicates go, personal data is masked, the rest is packed.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept, and returns a DataFrame that is written as Parquet and read again as the
next stage's documents.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidelake.llm.bestfit import pack_stage
from tidelake.llm.common import materialize, table
from tidelake.llm.near_copies import keep_one_of_each
from tidelake.llm.pii import redact
from tidelake.llm.toxicity import drop_toxic

STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", keep_one_of_each),
    ("pii", redact),
    ("packing", pack_stage),
]

#: The label model, the graph search and the tokenizer have no SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a data folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
