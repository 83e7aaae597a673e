"""The queries ``opN_<name>``: each applies one operator to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm import audit, bpe, collocations, decontam, gam, hash_tree, langid, ngram_join, outliers, pii, records, toxicity, url_trees
from webloom.llm.storage import new_folder


#: Key of the surrogates of the query and the pipeline; a production run passes its own secret to ``pii``.
SURROGATE_KEY = "corpus-surrogates"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text written as binary records in id order and read back from the files."""
    folder, shards = new_folder(spark, "token-records"), records.shard_count(spark)
    docs = _table(spark, sf_dir, "documents")
    manifest = records.write_records(docs, folder, tokenizer("byte_bpe_50k.json"), end_id=2, shards=shards)
    return records.read_records(manifest, folder, shards)


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every text under 5-word shingles and a Jaccard similarity of 0.8."""
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of a hash tree, and where each goes with one shard more."""
    return hash_tree.place(_table(spark, sf_dir, "documents"), 40)


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with personal data replaced by keyed surrogates."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, SURROGATE_KEY, count_col="n_entities")


def op5_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word statistics of every text; verdict by base rules and distance from its language and source."""
    return outliers.robust_outliers(_table(spark, sf_dir, "documents"))


def op6_edit_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within its edit budget, with the item and the distance."""
    return decontam.contaminated_pairs(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_char_ngram_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text by naive Bayes over hashed character n-grams."""
    docs = _table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.train(docs))


def op8_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every text by the additive model."""
    return gam.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_fair_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every text by the counterfactually regularised classifier."""
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded by the automaton and decoded from its ids."""
    return bpe.bpe_documents(_table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"),
                             outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


#: The rules of the URL query.
URL_RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))


def op11_url_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page URL by the rules, else by boosted trees learned from the URLs that the rules decide."""
    return url_trees.judge(_table(spark, sf_dir, "pages"), [url_trees.Rule(*r) for r in URL_RULES])


def op12_fm_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of two to four words of each language, counted by an FM-index of each shard."""
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove, in all orders, for each source."""
    return audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_records": op1_token_records,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_hash_tree_shards": op3_hash_tree_shards,
    "op4_surrogates": op4_surrogates,
    "op5_robust_outliers": op5_robust_outliers,
    "op6_edit_decontamination": op6_edit_decontamination,
    "op7_char_ngram_bayes": op7_char_ngram_bayes,
    "op8_quality_gam": op8_quality_gam,
    "op9_fair_toxicity": op9_fair_toxicity,
    "op10_bpe_automaton": op10_bpe_automaton,
    "op11_url_trees": op11_url_trees,
    "op12_fm_collocations": op12_fm_collocations,
    "op13_filter_audit": op13_filter_audit,
}
SQL: dict[str, str] = {"op12_fm_collocations": collocations.ORACLE_SQL, "op13_filter_audit": audit.ORACLE_SQL}
