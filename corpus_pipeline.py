"""From raw documents to packed sequences: language, near-duplicates, benchmark passages, secrets, packing.

Every stage takes all that the stage before it kept, decides on the whole texts,
and gives rows with the columns of ``documents``; the last gives packed pieces.

In all stages texts of any length are read whole, an empty table gives no rows,
and columns beside ``doc_id``, ``text``, ``lang`` and ``n_chars`` are carried as
they are, whatever their names (:func:`bundled`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitebooks.llm import decontaminate, language, packing, secrets, simhash
from sitebooks.llm.common import ready
from sitebooks.runtime import materialise

#: Documents whose language has a smaller posterior probability, or none, are rejected.
LEAST_SCORE = 0.5


def bundled(docs: DataFrame) -> DataFrame:
    """``text`` beside all other columns in one, so that names an operator adds cannot clash."""
    others = [F.col(c) for c in docs.columns if c != "text"]
    return docs.select("text", F.struct(*others).alias("__row"))


def unbundled(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col("text") if c == "text" else F.col(f"__row.{c}").alias(c) for c in docs.columns])


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a recognised language; those without letters or with no clear language go.

    Null and empty texts have no letters, so they go; a null ``lang`` teaches
    nothing; rows with a null id are judged like others; repeated rows are
    judged each alike; of equally likely languages the first by name is taken.
    """
    ready(spark)
    model = language.fit(docs.where(~language.held_out(F.col("doc_id"))))
    found = language.predict(bundled(docs), model, carry=["text", "__row"])
    return unbundled(found.where((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)), docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates.

    Null and empty texts are one group; rows with a null id stay; rows that
    repeat an id are one document (:func:`sitebooks.llm.simhash.one_of_each`).
    """
    ready(spark)
    return simhash.one_of_each(docs, simhash.groups(docs.select("doc_id", "text")))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items.

    Null and empty texts have no words and stay, as do rows with a null id;
    repeated rows are judged each alike; null or empty items hit nothing.
    """
    benchmark = ready(spark).read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    found = decontaminate.contamination(bundled(docs), benchmark, carry=["text", "__row"])
    return unbundled(decontaminate.verdict(found).where(~F.col("contaminated")), docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark; ``n_chars`` follows the text.

    A null text stays null, and its ``n_chars`` is null; overlapping secrets
    become one mark; repeated rows and rows with a null id are treated alike.
    """
    ready(spark)
    clean = unbundled(secrets.redacted(bundled(docs)), docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences balanced by attention cost.

    A null or empty text is its end id alone; null ids stay null; repeated rows
    are packed each.
    """
    ready(spark)
    return packing.with_checksums(packing.packed(docs))


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_near_copies),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: Naive Bayes, SimHash and byte-pair ids cannot be said in SQL; a brute-force version tests ``run``.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written to the shared folder and read again by the next."""
    docs = ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
