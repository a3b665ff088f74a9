"""Exact deduplication: one row of every group of equal texts stays.

Texts are equal when they are identical after each run of ASCII white space is replaced by one space; NULL counts
as empty. Grouping is by a 128-bit hash, and inside a hash by the text's bytes, so a collision of hashes never
joins different texts.

Defined results
* The row with the smallest id stays. NULL ids come last: a group with NULL ids only has a NULL ``keep_id``,
  and its rows are kept, as nothing tells them apart.
* Rows that repeat an id share that id's decision, and each of them counts in ``group_size``.
* An empty table gives an empty result. Columns other than the id and the text are never read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import BLANKS, stored, whole_text


def normalised(column: str = "text") -> Column:
    return F.regexp_replace(whole_text(column), BLANKS, " ")


def hash128(text: Column) -> Column:
    return F.unhex(F.md5(text))


def text_classes(texts: DataFrame) -> DataFrame:
    """One row per different text: the smallest id and the number of rows. ``texts`` has id, hash and body.

    Equal texts of one task are merged before the shuffle, so a hot text is one row per task.
    """
    return texts.groupBy("hash", "body").agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"))


def exact_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    hashed: Callable[[Column], Column] = hash128,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    The bodies are shuffled once, to be compared; what joins the rows with their group is narrow. Only where two
    bodies do share a hash are bodies joined, for these hashes alone.
    """
    texts = docs.select(F.col(id_column).alias("id"), normalised(text_column).alias("body"))
    texts = texts.select("id", hashed(F.col("body")).alias("hash"), "body")
    digest = F.sha2("body", 256).alias("text_sha256")
    classes = stored(text_classes(texts).select("hash", "keep_id", "group_size", digest), "exact-classes")
    shared = classes.groupBy("hash").agg(F.count("*").alias("bodies")).where("bodies > 1").select("hash")

    if shared.isEmpty():
        rows = texts.select("id", "hash").join(classes, "hash")
    else:
        alone = classes.join(shared, "hash", "left_anti")
        mixed = texts.join(shared, "hash", "left_semi")
        told_apart = text_classes(mixed).select("*", digest)
        rows = (
            texts.select("id", "hash")
            .join(alone, "hash")
            .unionByName(mixed.join(told_apart, ["hash", "body"]).drop("body"))
        )
    return rows.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` without the rows that are copies of a row with a smaller id; its columns as they are. Rows with a
    NULL id are always kept: nothing names them."""
    dropped = exact_groups(docs, id_column, text_column).where("NOT kept AND doc_id IS NOT NULL")
    dropped = dropped.select(F.col("doc_id").alias("id"), F.col("text_sha256").alias("digest")).distinct()
    digest = F.sha2(normalised(text_column), 256)
    whole = docs.select(F.struct("*").alias("doc"), F.col(id_column).alias("id"), digest.alias("digest"))
    return whole.join(dropped, ["id", "digest"], "left_anti").select("doc.*")


def one_row_of_each_text(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of every group of equal texts, its columns as they are: the one with the smallest id. NULL ids come last;
    of rows that share an id, or have none, the one first stored stays."""
    rows = numbered(docs, "exact-rows")
    key = F.sha2(normalised(f"doc.`{text_column}`"), 256)
    marks = rows.select(key.alias("key"), F.col(f"doc.`{id_column}`").alias("id"), "row")
    return only_rows(rows, first_rows(marks))


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """doc, its row as a struct, and row, a number of its own; stored, so that a task that runs again gives the same."""
    return stored(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), name)


def first_rows(marks: DataFrame) -> DataFrame:
    """The number of the first row of every key, from ``marks`` (key, id, row). Rows of one task are merged before the
    shuffle, so a hot key is one row a task."""
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "row")).alias("first")
    return marks.groupBy("key").agg(first).select("first.row")


def only_rows(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    return rows.join(chosen, "row", "left_semi").select("doc.*")


EXACT_SQL = """
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS body FROM documents
), grouped AS (
  SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY body
)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.body) AS text_sha256
FROM texts t JOIN grouped g ON t.body = g.body
"""
