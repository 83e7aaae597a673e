"""The corpus pipeline: quality, near duplicates, decontamination, personal data, tokens.

Each stage takes (spark, docs, sf_dir) and works on every row that the stage before it kept. All but the last return
the columns of ``documents``; between stages the rows are written as Parquet in the shared folder and read again, so
a lost executor costs one stage's tasks at most and no lineage grows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm import bpe, decontam, gam, ngram_join, pii
from webloom.llm.queries import SURROGATE_KEY, tokenizer
from webloom.llm.storage import new_folder
from webloom.llm.words import free_name


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the additive model predicts to be of quality 1 (score from 0.3 on). Without labels all rows stay."""
    labels = _table(spark, sf_dir, "labels")
    name = free_name(docs.columns, "quality_score")
    scored = gam.score(docs, gam.train(docs, labels), as_col=name)
    return scored.filter(F.col(name) >= gam.THRESHOLD).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, and every row that is in none."""
    return ngram_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose whole text holds no benchmark item within its edit budget."""
    return decontam.clean_documents(docs, _table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with surrogates in place of personal data in the text."""
    return pii.pseudonymise(docs, SURROGATE_KEY)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the digest of the text decoded from them, for every row."""
    return bpe.bpe_documents(docs, tokenizer("word_bpe_49k.json"), outputs=("n_tokens", "ids", "decoded_sha256"))


STAGES = [("quality_classifier", quality_classifier), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("personal_data", personal_data), ("tokens", tokens)]

#: Trained models, links between texts and automata are beyond SQL; tests compare run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``."""
    folder = new_folder(spark, "corpus-pipeline")
    docs = _table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        out = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
