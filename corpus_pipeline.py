"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and
read again as the next stage's ``docs``. All but the last keep the columns of documents.

1. ``language_id``: documents whose language is rejected go (none, if no row has a language).
2. ``near_duplicates``: one document of each group stays (five words, similarity 0.8).
3. ``personal_data``: personal data is masked in the texts.
4. ``mix``: sources are mixed to their target weights, in training order.
5. ``pack``: documents are tokenised and packed into windows; a row per piece.

An empty table passes through all stages. Rows may repeat and any column may be null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulsegrid.llm import langid, mixing, ngram_join, packing, pii
from pulsegrid.session import scratch_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # numbered names: a column of the documents may be called like one that is added
    plain = [f"c{i}" for i in range(len(docs.columns))]
    model = langid.fit(langid.learnable(docs))
    if not model:  # nothing to learn from is no reason to reject
        return docs
    found = langid.identify(docs.toDF(*plain), model, text_col=plain[docs.columns.index("text")])
    return found.filter("not rejected").select(*plain).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, whole=True)  # no text is cut, so pack gets all of it


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mix", mix),
    ("pack", pack),
]

#: SQL can't express compression, hashing by permutations or the tokenizer; tests hold the
#: stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; stages are written below ``spark.checkpoint.dir``."""
    out = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    root = scratch_path(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, out, sf_dir).write.parquet(path := f"{root}/{i}-{name}")
        out = spark.read.parquet(path)
    return out
