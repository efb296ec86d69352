"""The corpus pipeline: documents in, packed pieces out, one stage after another."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearspark.llm import decontamination, language_id, ngram_join, packing, personal_data
from clearspark.llm.names import free
from clearspark.llm.tokenizer_files import vocabulary
from clearspark.session import landed


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; a null lang becomes the one found.

    Those that identification rejects go: null texts, texts without a letter, and texts
    that are unlikely even in their nearest language. Landed, so that the texts go to Python
    in batches of bounded bytes.
    """
    names = free(docs.columns, "lang_pred", "score", "rejected")
    found = language_id.identify(docs, language_id.fit(docs), into=tuple(names))
    kept = found.filter(~F.col(names[2])).withColumn("lang", F.coalesce("lang", names[0]))
    return landed(kept.select(*docs.columns), "language-ID")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8): the one with the smallest doc_id, null last.

    Rows are told apart by doc_id and text; of rows with both alike one stays.
    """
    name = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.xxhash64("text", F.col("text").isNull()).alias("hash"))
    groups = ngram_join.near_duplicates(docs.select(name.alias("name"), "text"), key="name")
    first = groups.filter(F.col("name") == F.col("component_id")).select(F.col("name").alias("first")).distinct()
    (own,) = free(docs.columns, "name")
    rows = docs.withColumn(own, name)
    kept = rows.join(first, rows[own].eqNullSafe(first["first"]), "left_semi")
    return kept.dropDuplicates([own]).select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; landed, as those of `keep_languages`."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    (leaks,) = free(docs.columns, "leaks")
    clean = decontamination.with_leaks(docs, items, into=leaks).filter(F.size(leaks) == 0)
    return landed(clean.select(*docs.columns), "benchmark-decontamination")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with labels for personal data and for terms that reveal it; n_chars follows."""
    masked = personal_data.sanitise(docs)
    return masked.withColumn("n_chars", F.coalesce(F.char_length("text").cast("bigint"), "n_chars")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document kept and their places in sequences."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), end_id=1)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", keep_languages),
    ("n-gram Jaccard join", keep_one_of_each),
    ("benchmark decontamination", drop_leaks),
    ("PII", mask_personal_data),
    ("packing", pack),
]

#: Stages whose results are landed already.
LANDED = (keep_languages, drop_leaks)

#: Tokens, language models and windows are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each on the landed result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        if stage not in LANDED:
            docs = landed(docs, name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
