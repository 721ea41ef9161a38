"""One query per operator over its whole table, with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trendloom.llm.collocations import collocations
from trendloom.llm.exact_dedup import exact_groups
from trendloom.llm.jaccard_join import linked_documents
from trendloom.llm.language import language_report
from trendloom.llm.html_text import extract_main_text
from trendloom.llm.license_texts import TEMPLATES
from trendloom.llm.licenses import scan_licenses
from trendloom.llm.materialise import materialised, slot_index
from trendloom.llm.mixing import mix_report
from trendloom.llm.oracle import ORACLE_SQL  # noqa: F401
from trendloom.llm.periodic import periodic_runs, planted_periods, run_digest
from trendloom.llm.packing import pack_documents, packing_digest
from trendloom.llm.quality import quality_report
from trendloom.llm.substring_dedup import drop_repeats
from trendloom.llm.url_rules import url_verdicts


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in all documents."""
    return scan_licenses(_read(spark, sf_dir, "documents"), sorted(TEMPLATES.items()))


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on the urls of all pages; labels are those of the documents with the pages' ids."""
    return url_verdicts(_read(spark, sf_dir, "pages"), _read(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality figures and verdicts of all documents."""
    return quality_report(_read(spark, sf_dir, "documents"))


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents."""
    return language_report(_read(spark, sf_dir, "documents"))


def training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token sequences in training order, as they lie in the written shards."""
    return slot_index(materialised(_read(spark, sf_dir, "documents")))


def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of similar texts among all documents."""
    return linked_documents(_read(spark, sf_dir, "documents"))


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that repeat a passage of an earlier one."""
    return drop_repeats(_read(spark, sf_dir, "documents"), with_text=False).select(
        "doc_id", "n_words", "n_removed", "kept_sha256"
    )


def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the weights 1, 2, 3 of their sources."""
    return mix_report(_read(spark, sf_dir, "documents"))


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts among all documents."""
    return exact_groups(_read(spark, sf_dir, "documents"))


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    return packing_digest(pack_documents(_read(spark, sf_dir, "documents")))


def periodic_run_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs in all documents, one in ten of them given a repeated stretch first."""
    return run_digest(periodic_runs(planted_periods(_read(spark, sf_dir, "documents"))))


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return extract_main_text(_read(spark, sf_dir, "pages"))


def collocation_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best 2000 phrase collocations per language over all documents."""
    return collocations(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": license_scan,
    "op2_url_filter": url_filter,
    "op3_quality_rules": quality_rules,
    "op4_ngram_jaccard_join": ngram_jaccard_join,
    "op5_mix_sources": mix_sources,
    "op6_language_id": language_id,
    "op7_training_order": training_order,
    "op8_exact_dedup": exact_dedup,
    "op9_best_fit_packing": best_fit_packing,
    "op10_substring_dedup": substring_dedup,
    "op11_periodic_runs": periodic_run_detection,
    "op12_html_extraction": html_extraction,
    "op13_collocations": collocation_mining,
}
