"""The training-data pipeline: each stage works on what the one before it kept.

Stages take (spark, docs, sf_dir) and return a table; ``run`` writes each as Parquet to the
shared folder and reads it again, so that a lost executor costs no earlier stage. All but the
last return the columns of documents; the last returns the kept documents with their tokens.

Null texts count as empty, and null, empty and blank texts are equal. Rows without a doc_id go by their
text in every stage, but are never near copies of others. Rows that share a doc_id are judged by
their own text, except that near dedup takes them for one document. Rows repeated as a whole are exact
copies. Texts of any length go through whole. An empty table gives an empty result. Columns of any name are
let through; see :func:`encode` for names that the last stage makes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanstream.llm import bpe, decontaminate, exact_dedup, near_dedup, tables, toxicity
from gleanstream.llm.queries import table, vocabulary

#: Toxicity score from which a document goes.
TOXIC = 0.7
#: Near copies share 80 % of their five-word shingles; the 85 % of ``op5_near_dedup`` is that
#: query's own contract. With 40 bands of 5 samples a pair at 0.8 shares no band with
#: probability 1e-7.
NEAR = near_dedup.Plan(percent=80, samples=200, bands=40, slack=0.19, fine_slack=0.08)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"), TOXIC)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_copies(docs, plan=NEAR)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns of the documents, n_tokens, ids_sha256, decoded_sha256 and ids.

    A column of the documents with one of these names, in any case, is called ``input_<name>``,
    with as many ``input_`` as make it unique.
    """
    coded = bpe.encoded(docs, vocabulary(), with_ids=True, with_decoded=False)
    made = ["n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    taken = {name.lower() for name in (*made, *docs.columns)}
    columns = []
    for name in docs.columns:
        new = name
        if name.lower() in made:
            while new.lower() in taken:
                new = f"input_{new}"
            taken.add(new.lower())
        columns.append(F.col("row")[name].alias(new))
    return coded.select(*columns, *made)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("encoding", encode),
]

#: SQL can express neither the scores, the near copies nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = tables.stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
