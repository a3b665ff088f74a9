"""URL filters: allow and block rules for hosts with their subdomains, and for the paths below them.

A host is turned round, label by label, with a dot at its end: ``blog.example.net`` becomes ``net.example.blog.``.
In this canonical order a host and its subdomains are one interval of keys, and the intervals of any two rules are
nested or apart. Hosts and rule starts are sorted together; at every host the latest start carries the stack of
rules it lies in, and those whose interval has not ended are active. A second sweep of the same kind, inside each
active rule host, finds the path prefixes that fit.

Defined results
* A URL that is NULL or has no ``://`` has an empty host and path; no rule fits it.
* The rule whose host and path are longest together wins; between equals the one with the longer host.
* Rules with an empty or NULL host are ignored, a NULL path is empty. Of rules with the same host and path a block
  wins.
* Every row gets one result, repeated rows and NULL ids included. Other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medallion.llm.common import LOWER, UPPER, lower_ascii

SALTS = 32
DEFAULT_VERDICT = "allow"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def top_label(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def key_end(key: Column) -> Column:
    """The first key behind all that start with ``key``: its last dot becomes the next character."""
    return F.concat(F.substr(key, F.lit(1), F.length(key) - 1), F.lit("/"))


def clean_rules(rules: DataFrame) -> DataFrame:
    host, path = lower_ascii(F.col("host")), F.coalesce(F.col("path"), F.lit(""))
    return (
        rules.where(F.length("host") > 0)
        .groupBy(host.alias("rule_host"), path.alias("rule_path"))
        .agg(F.max("verdict").alias("verdict"))
    )


def host_starts(rules: DataFrame) -> DataFrame:
    """One row per rule host: its key and the stack of rule hosts that it lies in, itself included."""
    hosts = rules.select("rule_host").distinct()
    labels = F.split("rule_host", r"\.")
    # As many outer hosts as the host has labels, however many rules there are.
    outer = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    chains = hosts.select("rule_host", F.explode(outer).alias("outer_host"))
    known = hosts.select(F.col("rule_host").alias("outer_host"))
    return (
        chains.join(known, "outer_host")
        .withColumn("end", key_end(host_key(F.col("outer_host"))))
        .groupBy("rule_host")
        .agg(F.collect_list(F.struct("outer_host", "end")).alias("stack"))
        .select(top_label(F.col("rule_host")).alias("top"), host_key(F.col("rule_host")).alias("key"), "stack")
    )


def path_starts(rules: DataFrame) -> DataFrame:
    """One row per rule: the stack of rules of the same host whose path it starts with, itself included."""
    prefixes = F.transform(F.sequence(F.lit(0), F.length("rule_path")), lambda i: F.expr("rule_path").substr(F.lit(1), i))
    chains = rules.select("rule_host", "rule_path", F.explode(prefixes).alias("outer_path"))
    known = rules.select("rule_host", F.col("rule_path").alias("outer_path"), "verdict")
    return (
        chains.join(known, ["rule_host", "outer_path"])
        .groupBy("rule_host", F.col("rule_path").alias("key"))
        .agg(F.collect_list(F.struct("outer_path", "verdict")).alias("stack"))
    )


def sweep(points: DataFrame, starts: DataFrame, group: str, salts: int) -> DataFrame:
    """Add to each point the stack of the latest start at or before its key, inside its group.

    A group's points are dealt over ``salts`` tasks and its starts are copied to each of them: no group, however
    hot, has to be sorted by one task. The window keeps one running value, not the rows.
    """
    salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    begun = starts.select(group, "key", "stack", salt.alias("salt"), F.lit(None).alias("point"))
    dealt = F.pmod(F.xxhash64("point"), F.lit(salts)).cast("int")
    kind = points.schema["point"].dataType
    rows = begun.withColumn("point", F.col("point").cast(kind)).unionByName(
        points.select(group, "key", F.lit(None).cast(starts.schema["stack"].dataType).alias("stack"), "point").withColumn(
            "salt", dealt
        )
    )
    order = Window.partitionBy(group, "salt").orderBy("key", F.col("point").isNotNull())
    swept = rows.withColumn("stack", F.last("stack", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return swept.where("point IS NOT NULL AND stack IS NOT NULL").drop("salt")


def judge_urls(pages: DataFrame, rules: DataFrame, salts: int = SALTS, default: str = DEFAULT_VERDICT) -> DataFrame:
    """page_id, host, path, rule and verdict for every row of ``pages`` (page_id, url) by ``rules`` (host, path,
    verdict). Each different host, and each different host and path, is judged once."""
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rules = clean_rules(rules)
    places = rows.where("host != ''").select("host", "path").distinct()

    hosts = places.select("host").distinct().select(
        top_label(F.col("host")).alias("top"), host_key(F.col("host")).alias("key"), F.struct("host").alias("point")
    )
    inside = sweep(hosts, host_starts(rules), "top", salts).select(
        F.col("point.host").alias("host"), F.explode(F.expr("filter(stack, r -> key < r.end)")).alias("active")
    )
    nested = places.join(inside, "host").select(
        F.col("active.outer_host").alias("rule_host"), F.col("path").alias("key"), F.struct("host", "path").alias("point")
    )
    fits = sweep(nested, path_starts(rules), "rule_host", salts).select(
        "point.host",
        "point.path",
        F.explode(F.expr("filter(stack, r -> startswith(key, r.outer_path))")).alias("rule"),
        "rule_host",
    )
    rule = F.concat("rule_host", "rule.outer_path")
    best = fits.groupBy("host", "path").agg(
        F.max(F.struct(F.length(rule).alias("n"), F.length("rule_host").alias("m"), rule.alias("rule"), "rule.verdict")).alias("best")
    )
    return rows.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )


# The rules of the registered query.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def fixed_rules(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in RULES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS rules(host, path, verdict)")


URLS_SQL = f"""
WITH parts AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), rules(rule_host, rule_path, verdict) AS (
  VALUES {", ".join(str(rule) for rule in RULES)}
), judged AS (
  SELECT p.host, p.path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM (SELECT DISTINCT host, path FROM parts) p JOIN rules r
    ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
  GROUP BY p.host, p.path
)
SELECT p.page_id, p.host, p.path, j.rule, coalesce(j.verdict, '{DEFAULT_VERDICT}') AS verdict
FROM parts p LEFT JOIN judged j ON p.host = j.host AND p.path = j.path
"""
