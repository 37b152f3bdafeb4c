"""One registered query per corpus operator, over its whole table with production parameters."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import load
from . import archives, decontaminate, grammar, jaccard, language, licenses, lines, packing, passages, phrases, sharding, tries, vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License detections of every document."""
    return licenses.scan(load(spark, sf_dir, "documents"))


ORACLES["op1_license_scan"] = licenses.oracle()


@query
def op2_differencing_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes; equal texts stay together."""
    out = sharding.assign(load(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document from its text, its declared language and its source's prior."""
    docs = load(spark, sf_dir, "documents")
    out = language.judge(docs, "text", F.col("lang"), None, F.col("source"), F.col("doc_id"), keep=["doc_id"])
    return out.select("doc_id", F.col("li_lang").alias("language"), F.col("li_posterior").alias("posterior"),
                      F.col("li_text_posterior").alias("text_posterior"), F.col("li_kept").alias("kept"))


@query
def page_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page from its text, its markup language, its address suffix and its host's prior."""
    pages = load(spark, sf_dir, "pages")
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    text = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>", " "), r"(?s)<[^>]*>", " ")
    pages = pages.select("page_id", text.alias("text"), F.when(host != "", host).alias("host"),
                         F.regexp_extract("html", r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]+)", 1).alias("markup"))
    suffix = F.nullif(F.regexp_extract("host", r"\.([a-z]+)$", 1), F.lit(""))
    out = language.judge(pages, "text", F.col("markup"), suffix, F.col("host"), F.col("page_id"), keep=["page_id"])
    return out.select("page_id", F.col("li_lang").alias("language"), F.col("li_posterior").alias("posterior"),
                      F.col("li_text_posterior").alias("text_posterior"), F.col("li_kept").alias("kept"))


@query
def op4_passage_chaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of a document that an earlier document has, in places of words."""
    return passages.repeats(load(spark, sf_dir, "documents"))


@query
def op5_repair_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token ids written to grammar-compressed files and read back."""
    return grammar.write_and_read(load(spark, sf_dir, "documents"))


@query
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens in sequences of at most 1024."""
    return packing.best_fit(load(spark, sf_dir, "documents"), with_ids=False)


@query
def op7_zip_archive_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record in a ZIP package and read back by range."""
    return archives.write_and_read(load(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op7_zip_archive_reader"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
d AS (SELECT page_id, strlen(t)::BIGINT AS payload_bytes, sha256(t) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY 1)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN f.first_id <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first_id <> d.page_id THEN f.first_id END AS refers_to
FROM d LEFT JOIN f ON f.payload_digest = d.payload_digest AND d.payload_bytes >= 100
"""


@query
def op8_pca_tiled_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its links of cosine 0.95 or more and its component."""
    return vectors.near_duplicates(load(spark, sf_dir, "embeddings"))


@query
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's 4-word shingles and its component of similarity 0.85 or more."""
    return jaccard.near_duplicates(load(spark, sf_dir, "documents"))


@query
def op10_qgram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place of a benchmark item in a document, within the item's edit budget."""
    return decontaminate.matches(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


@query
def op11_burst_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return tries.rebuilt_trie(load(spark, sf_dir, "conversations"))


ORACLES["op11_burst_trie"] = tries.oracle()


@query
def op12_toivonen_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2000 phrases of two and three words that hold together most."""
    return phrases.collocations(load(spark, sf_dir, "documents"))


ORACLES["op12_toivonen_collocations"] = phrases.oracle()


@query
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that five documents or more have, but for the last document that has them."""
    out = lines.drop_common_lines(load(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("line_count").alias("n_lines"), F.col("lines_dropped").alias("n_dropped"),
                      F.sha2("text", 256).alias("kept_sha256"))


ORACLES["op13_line_dedup"] = lines.oracle()
