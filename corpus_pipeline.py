"""The corpus pipeline: language ID, line dedup, near-dedup, decontamination and mixing, each written and read again.

Every stage works on all that the one before it kept, and all but the last return the columns of documents:

- language: learns the languages of the stage's own documents and drops those whose text has no letters, or has 80 or more and is like none of them;
- lines: cuts later copies of repeated runs of lines; a document of which nothing is left goes, as its text is all elsewhere;
- copies: keeps the first document of each group of near-duplicates (five-word shingles, similarity 0.8);
- benchmark: drops documents that hold a passage of the benchmark (five-word shingles, similarity 0.8);
- mixture: the documents that the target weights take, with tokens and copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.llm import decontaminate, langid, linedup, mixing, simhash
from caudal.llm.common import read, stored
from caudal.llm.settings import JUDGED_LETTERS, LEAST_LIKENESS, mixture_levels

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    profiles = langid.learn(docs)
    judged = langid.predict(docs, profiles, list(COLUMNS[:1] + COLUMNS[2:]), keep_text=True)
    known, alike = (langid.accepted(F.col("lang_pred"), F.col("score"), None, least) for least in (0.0, LEAST_LIKENESS))
    short = F.length(F.regexp_replace("text", r"\P{L}+", "")) < JUDGED_LETTERS
    return judged.filter(alike | (known & short)).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = linedup.drop_repeated_lines(docs)
    left = (F.size("removed_lines") == 0) | (F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")) != "")
    n_chars = F.when(F.size("removed_lines") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return cut.filter(left).withColumn("n_chars", n_chars).select(*COLUMNS)


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs).select(*COLUMNS)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, mixture_levels())


STAGES = [("language", language), ("lines", lines), ("copies", copies), ("benchmark", benchmark), ("mixture", mixture)]
#: The first stage's vectors have no SQL; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage-{name}")
    return docs
