"""Registered queries of this subpackage, and their DuckDB restatements where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threadcorpus.llm import align, chat, cnn, decontaminate, extract, forest, packing, pii, rules, secrets, spelling, suffix, urls
from threadcorpus.llm.common import table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 100-byte strings removed from all documents."""
    return suffix.digest(suffix.remove_repeats(table(spark, sf_dir, "documents")))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules as weak supervision over all documents."""
    return rules.digest(rules.score(table(spark, sf_dir, "documents")))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wu-Manber search of all documents for the benchmark's windows."""
    return decontaminate.digest(decontaminate.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level convolutional network, fitted on labelled rows that are not held out, over all documents."""
    docs = table(spark, sf_dir, "documents")
    return cnn.score(docs, cnn.fit(docs, table(spark, sf_dir, "labels")))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Block and allow list, and boosted trees, over all pages."""
    return urls.judge(table(spark, sf_dir, "pages"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents: patterns, and what the character network adds."""
    docs = table(spark, sf_dir, "documents")
    return pii.digest(pii.find(docs, pii.fit(docs)))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes and links of all documents whose 5-word shingles are similar to 0.8 or more."""
    return forest.join(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of all documents, with corpus-wide ownership."""
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variable-capacity best-fit packing of all documents."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Budgeted chat windows of all conversations, read back."""
    return chat.digest(chat.format_windows(chat.with_probe(table(spark, sf_dir, "conversations"))))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between the tokens of two tokenizers in all documents, with corpus-wide counts."""
    return align.link(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, the more frequent words one edit away, and where those end."""
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages: by their marks, else without what repeats on their host."""
    return extract.extract(table(spark, sf_dir, "pages"))


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_quality_rules": op2_quality_rules,
    "op3_decontamination": op3_decontamination,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_url_filters": op5_url_filters,
    "op6_pii": op6_pii,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_secret_scan": op8_secret_scan,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_token_alignment": op11_token_alignment,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_html_extraction": op13_html_extraction,
}
ORACLES = {"op3_decontamination": decontaminate.ORACLE, "op12_spelling_variants": spelling.ORACLE,
           "op13_html_extraction": extract.ORACLE}
