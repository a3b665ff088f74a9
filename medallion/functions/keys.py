"""Key expressions: natural keys, codes and surrogate ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The NULL marker, and how the id is cut from a sha256 hex digest
# (start and length of each run of digits, and the text put in front of it).
NULL_SENTINEL = "__null__"
UUID_RUNS = ((1, 8, ""), (9, 4, "-"), (14, 3, "-5"), (17, 3, "-8"), (20, 12, "-"))


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def normalize_key(value: str | Column) -> Column:
    """Natural key of a category: trimmed text, NULL as the marker. Blank text stays blank, case is kept."""
    return F.coalesce(F.trim(_column(value).cast("string")), F.lit(NULL_SENTINEL))


def normalize_code(value: str | Column) -> Column:
    return F.upper(F.trim(_column(value).cast("string")))


def stable_uuid(namespace: str | Column, *values: str | Column, null_gives_null: bool = False) -> Column:
    """The same UUID-shaped text for the same namespace and values, on every run and every executor.

    A namespace given as text is taken literally; values given as text are column names. A NULL value counts
    as the marker, or makes the id NULL; never wrap the id in a condition for that: inside one, Spark
    computes the digest once per piece. The pieces are cut as bytes: in text, characters would have to be counted.
    """
    texts = [_column(value).cast("string") for value in values]
    if null_gives_null:
        between = [part for text in texts for part in (F.lit("|"), text)]
        digest = F.sha2(F.concat(F.lit(namespace), *between), 256)
    else:
        digest = F.sha2(F.concat_ws("|", F.lit(namespace), *[F.coalesce(t, F.lit(NULL_SENTINEL)) for t in texts]), 256)
    digest = digest.cast("binary")
    pieces: list[Column] = []
    for start, length, lead in UUID_RUNS:
        pieces += [F.lit(bytearray(lead.encode()))] if lead else []
        pieces.append(F.substring(digest, start, length))
    return F.concat(*pieces).cast("string")


def random_uuid() -> Column:
    """A random id. Write the rows down before using them twice: every evaluation gives new values."""
    return F.uuid()
