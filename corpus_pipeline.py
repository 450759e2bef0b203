"""From raw documents to token ids: quality rules, near copies, personal data, mixing, encoding.

``STAGES`` are functions of (spark, docs, sf_dir) that return a DataFrame; each stage's result is
written as Parquet and read again as the next one's ``docs``. All but the last return the columns of
``documents``. SQL cannot express the near-copy, hash-named and tokenizer stages (``ORACLE_SQL`` is None);
tests compare the whole run with a plain version."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.llm import bpe_tree, host_rules, mixing, ngram_join, pii
from pagelode.llm.common import documents, tokenizer_path
from pagelode.session import limit_arrow_batches, materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither fail the base rules nor come from a rejected host."""
    limit_arrow_batches(spark)
    return host_rules.quality_by_host(docs).where("kept").select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    limit_arrow_batches(spark)
    return ngram_join.first_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by the name of its kind."""
    return pii.redacted(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents once for each epoch, cut where a source's budget ends."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of what they decode to."""
    limit_arrow_batches(spark)
    found = bpe_tree.encode_documents(docs.select("doc_id", "source", "text"), tokenizer_path(), whole=True, decoded=False)
    return found.select("doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256", "ids")


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_copies),
    ("personal data", personal_data),
    ("mixing", mixture),
    ("BPE", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
