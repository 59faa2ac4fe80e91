"""From raw documents to token ids: five operators in a row, each on what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.llm import bpe, decontamination, neardup, pii, toxicity
from trackloom.llm.common import materialize, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under one half for toxicity."""
    model = toxicity.train_on(docs, table(spark, sf_dir, "labels"))
    name = next(n for n in ("score", "score_", "score__", "toxicity_score") if n not in docs.columns)
    return toxicity.score(docs, model, name=name).where(F.col(name) < 0.5).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: SimHash and MinHash candidates, five-word shingles, similarity 0.8."""
    return neardup.drop_near_duplicates(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a telling share of benchmark windows."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with personal data masked; ``n_chars`` follows the text."""
    clean = pii.redact(docs, pii.train_on(docs))
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_tokens, token_ids`` and whether the ids decode to the text."""
    coded = bpe.encode_and_check(docs, keep=["doc_id", "lang", "source"])
    return coded.select("doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", "round_trip")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("pii", mask_personal_data),
    ("bpe", encode_tokens),
]

#: Trained models and a vocabulary file take part in the result, which SQL can't express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
