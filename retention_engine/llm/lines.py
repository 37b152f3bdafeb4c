"""Line dedup in DataFrame functions alone: lines that stand in many documents stay in one of them.

Every line is exploded with its position; its key is the line without white space (``[\\x20\\x09-\\x0D]``) at both ends
and with A-Z lower-cased. Keys of at least ``least_chars`` code points are hashed to 128 bits. Keys are first reduced
to one row a (key, document) and then counted per key, so a line that a third of all documents has is counted by many
tasks. Keys of at least ``least_docs`` documents are common: all their lines go, but those in the document with the
largest id that holds the key. A document is reassembled from the positions of its other lines.

Only hashes and positions are shuffled to find the lines; common keys and the positions to drop are written tables,
joined by broadcast where Spark finds their files small and by a sort-merge join (which adaptive execution splits at a
hot key) where not. Positions are gathered per text, so the group of a document is never larger than its text.

Nulls and edge cases: a null or empty text is one empty line and comes back empty. Rows with the same id are one
document when documents are counted and when its lines are kept, and come back as many rows; rows with a null id are
one document, smaller than all others. Rows that repeat come back each. A text of any length is read whole. An empty
table gives an empty one. Other columns pass through; a column named like one of the results is replaced by it.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What is stripped at both ends of a line (a fixed value of the contract).
BLANKS = " \t\n\x0b\x0c\r"
LEAST_CHARS, LEAST_DOCS = 40, 5


def _digest(value: Column) -> Column:
    return F.unhex(F.md5(value))


def keyed_lines(docs: DataFrame, id_col: str, text_col: str, least_chars: int) -> DataFrame:
    """(id, text_key, pos, key) of every line whose key has at least ``least_chars`` code points."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), _digest(text).alias("text_key"),
                       F.posexplode(F.split(F.translate(text, UPPER, LOWER), "\n", -1)).alias("pos", "line"))
    rows = rows.select("id", "text_key", "pos", F.btrim("line", F.lit(BLANKS)).alias("line"))
    return rows.where(F.length("line") >= least_chars).select("id", "text_key", "pos", _digest(F.col("line")).alias("key"))


def common_keys(lines: DataFrame, least_docs: int) -> DataFrame:
    """(key, n_docs, keeper): keys of at least ``least_docs`` documents and the largest id among these."""
    once = lines.groupBy("key", "id").agg(F.count(F.lit(1)).alias("n"))  # one row a document, dealt by both columns
    return (once.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("keeper"))
            .where(F.col("n_docs") >= least_docs))


def drop_common_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS,
                      least_docs: int = LEAST_DOCS) -> DataFrame:
    """The rows of ``docs`` with the lines that stay in ``text_col``, and ``line_count`` and ``lines_dropped`` (long)."""
    lines = materialize(keyed_lines(docs, id_col, text_col, least_chars), "lines")
    common = materialize(common_keys(lines, least_docs).select("key", "keeper"), "common-lines")
    goes = (lines.join(common, "key").where(~F.col("id").eqNullSafe(F.col("keeper")))
            .groupBy("id", "text_key").agg(F.collect_set("pos").alias("gone")))
    goes = materialize(goes, "lines-to-drop").select(F.col("id").alias("_id"), F.col("text_key").alias("_key"), F.col("gone").alias("_gone"))

    results = ["line_count", "lines_dropped"]
    others = [c for c in docs.columns if c not in (text_col, *results)]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in others], F.lit(None).alias("_none")).alias("_row"), F.col(id_col).alias("_doc"),
                       _digest(text).alias("_text_key"), F.split(text, "\n", -1).alias("_lines"))
    rows = rows.join(goes, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key")), "left")
    stays = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    kept = F.when(F.col("_gone").isNull(), F.col("_lines")).otherwise(F.transform(stays, lambda p: F.get("_lines", p)))
    out = {c: F.col(f"_row.`{c}`") for c in others}
    out[text_col] = F.array_join(kept, "\n")
    return rows.select(*[out[c].alias(c) for c in docs.columns if c in out], F.size("_lines").cast("long").alias("line_count"),
                       F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("lines_dropped"))


def oracle() -> str:
    """Line counts and digests of the reassembled texts in DuckDB SQL, over ``documents``."""
    blanks = " || ".join(f"chr({ord(c)})" for c in BLANKS)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
k AS (SELECT *, trim(translate(line, '{UPPER}', '{LOWER}'), {blanks}) AS key FROM l),
c AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= {LEAST_CHARS} GROUP BY key
      HAVING count(DISTINCT doc_id) + CAST(count(*) > count(doc_id) AS INTEGER) >= {LEAST_DOCS}),
m AS (SELECT k.*, c.key IS NOT NULL AND k.doc_id IS DISTINCT FROM c.keeper AS gone FROM k LEFT JOIN c USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r
"""
