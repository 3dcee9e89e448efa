"""One named query per operator, over the whole of its table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from knockwatch.llm.collocations import collocations
from knockwatch.llm.conversation_repair import damaged, repair_reports
from knockwatch.llm.decontaminate import contamination
from knockwatch.llm.host_rules import quality_by_host
from knockwatch.llm.html_text import extract_main_text
from knockwatch.llm.license_scan import license_notices
from knockwatch.llm.mixing import mixture
from knockwatch.llm.paragraph_dedup import passage_dedup
from knockwatch.llm.pii import personal_data
from knockwatch.llm.quality_model import quality_scores
from knockwatch.llm.simhash import fingerprint_hex, simhash_components
from knockwatch.llm.toxicity import toxicity_scores
from knockwatch.llm.vector_search import nearest

Query = Callable[[SparkSession, str], DataFrame]

#: Target weights of the mixture: the domain of a source goes by its number, see ``DOMAIN``.
DOMAIN = r"concat('d', coalesce(cast(try_cast(regexp_extract(source, '([0-9]+)$', 1) as int) % 4 as string), 'none'))"
WEIGHTS = {
    "domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1},
    "lang": {"en": 5, "de": 2, "fr": 2, "es": 1},
    "source": {},
}
OTHER_WEIGHT = 1
#: Every vector whose id this divides is a query.
QUERY_EVERY = 20
#: Passages of over 50 words make documents one component.
PASSAGE_WORDS = 51


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents")


def levels() -> dict[str, Column]:
    return {"domain": F.expr(DOMAIN), "lang": F.col("lang"), "source": F.col("source")}


def weights() -> dict[str, Column]:
    def of(name: str, known: dict[str, int]) -> Column:
        value = F.lit(OTHER_WEIGHT)
        for key, weight in known.items():
            value = F.when(F.col(name) == key, weight).otherwise(value)
        return value

    return {name: of(name, known) for name, known in WEIGHTS.items()}


def pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(_documents(spark, sf_dir))


def decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(_documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_notices(_documents(spark, sf_dir)).withColumn("notices", F.to_json("notices"))


def host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return quality_by_host(_documents(spark, sf_dir)).select("doc_id", *counts, "base_failed", "kept")


def mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(_documents(spark, sf_dir), levels(), weights()).drop("text_hash")


def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(_table(spark, sf_dir, "pages"))


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity_scores(_documents(spark, sf_dir), _table(spark, sf_dir, "labels"))
    return found.withColumn("evidence", F.array_join(F.transform("evidence", lambda i: i.cast("string")), ","))


def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_dedup(_documents(spark, sf_dir), passage_words=PASSAGE_WORDS)


def simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(_documents(spark, sf_dir), width=4, max_distance=4)
    return found.select("doc_id", fingerprint_hex(F.col("print")).alias("fingerprint"), "component_id")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    return repair_reports(damaged(turns), turns)


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_documents(spark, sf_dir))


def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_EVERY == 0)


QUERIES: dict[str, Query] = {
    "op1_pii": pii,
    "op2_decontaminate": decontaminate,
    "op3_quality": quality,
    "op4_licenses": licenses,
    "op5_host_rules": host_rules,
    "op6_mixing": mixing,
    "op7_main_text": main_text,
    "op8_toxicity": toxicity,
    "op9_passage_dedup": passages,
    "op10_simhash_dedup": simhash_dedup,
    "op11_conversation_repair": conversations,
    "op12_collocations": phrases,
    "op13_vector_search": neighbours,
}
