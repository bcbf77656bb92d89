"""Judges URLs by rules on hosts and paths, as a sorted sweep; DataFrame functions only.

A rule (host, path) has the key ``reversed.host.`` + U+0001 + path: for ``example.com/en/`` that is
``com.example.`` + U+0001 + ``/en/``.  A URL has one such key for its host and for each domain above it.
A rule fits if its key is a prefix of one of them, so it covers an interval of
the sorted keys, and intervals either nest or are apart.

Rules and distinct URLs are sorted together into ranges.  In each range the sweep carries
the stack of rules that were open where the last rule began; the innermost whose
prefix the key still has is the rule that fits.  A range starts with the stack that the last rule
before it left.  Equal URLs are one key, so a hot host only widens ranges that can be cut anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreline.session import materialize, shuffle_partitions

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATOR = "\x01"
STACK = "array<struct<key: string, rule: string, size: int, verdict: string>>"


def host_of(url: Column) -> Column:
    return F.coalesce(
        F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit("")
    )


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def key_of(labels: Column, path: Column) -> Column:
    """The key of a host, given by its labels from the top level down."""
    return F.concat(F.array_join(labels, "."), F.lit("." + SEPARATOR), path)


def labels_of(host: Column) -> Column:
    return F.reverse(F.split(host, r"\.", -1))


def rule_stacks(rules: DataFrame) -> DataFrame:
    """(key, stack): each rule's key with all rules open there, innermost first.

    Rules above a rule on the same host have a shorter path that begins its own, so they are found by
    joining on the prefixes of those lengths that occur.  Of equal rules the one
    whose verdict sorts first holds.  Rules without a host or path are left out.
    """
    own = (
        rules.where("host is not null and host <> '' and path is not null")
        .groupBy(F.translate("host", UPPER, LOWER).alias("host"), "path")
        .agg(F.min("verdict").alias("verdict"))
        .select(
            key_of(labels_of(F.col("host")), F.col("path")).alias("key"),
            F.length(key_of(labels_of(F.col("host")), F.lit(""))).alias("head"),
            F.length("path").alias("n"),
            F.concat("host", "path").alias("rule"),
            "verdict",
        )
    )
    own = materialize(own.withColumn("size", F.length("rule")), "url-rules")
    lengths = own.agg(F.collect_set("n").alias("lengths"))  # one row
    prefixes = own.join(F.broadcast(lengths)).select(
        "key",
        F.explode(F.filter("lengths", lambda m: m <= F.col("n"))).alias("m"),
        "head",
    )
    above = own.select(F.col("key").alias("above"), "rule", "size", "verdict")
    return (
        prefixes.withColumn("above", F.substring("key", F.lit(1), F.col("head") + F.col("m")))
        .join(above, "above")
        .groupBy("key")
        .agg(
            F.reverse(
                F.array_sort(
                    F.collect_list(
                        F.struct(
                            F.length("above").alias("n"),
                            F.struct(F.col("above").alias("key"), "rule", "size", "verdict").alias("r"),
                        )
                    )
                )
            ).alias("open")
        )
        .select("key", F.transform("open", lambda o: o["r"]).alias("stack"))
    )


def judge_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow"
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules``: host, path, verdict.  A rule fits its host and every subdomain, if the URL's path starts with
    its path; the longest (host and path together) wins, on a tie the one with the longer host.  Without one, ``rule`` is null and
    ``verdict`` is ``default``.  A null URL, or one without ``://``, has an empty host
    and path.  Rows may repeat; columns of those four names are replaced.
    """
    spark = pages.sparkSession
    columns = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    # The row travels packed, so that no name of it can clash.
    parsed = pages.select(
        F.struct("*").alias("row"), host_of(F.col(url)).alias("_h"), path_of(F.col(url)).alias("_p")
    )
    stacks = materialize(rule_stacks(rules), "url-stacks")
    # The deepest rule host bounds how many keys a URL needs.  One row.
    depth = stacks.select(
        F.coalesce(
            F.max(F.size(F.split(F.substring_index("key", SEPARATOR, 1), r"\.", -1))) - 1, F.lit(0)
        ).alias("depth")
    )
    labels = labels_of(F.col("_h"))
    wanted = F.least(F.size(labels), F.col("depth"))
    keys = (
        parsed.where("_h <> ''")
        .select("_h", "_p")
        .distinct()
        .join(F.broadcast(depth))
        .where("depth > 0")
        .select("_h", "_p", labels.alias("l"), F.explode(F.sequence(F.lit(1), wanted)).alias("k"))
        .select("_h", "_p", key_of(F.slice("l", F.lit(1), F.col("k")), F.col("_p")).alias("key"))
    )
    events = keys.select("key", "_h", "_p", F.lit(None).cast(STACK).alias("stack")).unionByName(
        stacks.select(
            "key", F.lit("").alias("_h"), F.lit("").alias("_p"), F.col("stack").cast(STACK)
        )
    )
    ranged = materialize(
        events.repartitionByRange(shuffle_partitions(spark), "key").withColumn(
            "range", F.spark_partition_id()
        ),
        "url-ranges",
    )
    # One row per range: what the last rule in it, or in those before, leaves open.
    ends = ranged.groupBy("range").agg(
        F.max_by("stack", F.when(F.col("stack").isNotNull(), F.col("key"))).alias("last")
    )
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("range", F.last("last", ignorenulls=True).over(before).alias("carried"))
    # A rule comes before the URLs of the same key.
    sweep = Window.partitionBy("range").orderBy("key", F.col("stack").isNull())
    best = (
        ranged.join(F.broadcast(carried), "range")
        .withColumn(
            "open",
            F.coalesce(
                F.last("stack", ignorenulls=True).over(
                    sweep.rowsBetween(Window.unboundedPreceding, Window.currentRow)
                ),
                "carried",
            ),
        )
        .where("_h <> ''")
        .select("_h", "_p", F.filter("open", lambda r: F.col("key").startswith(r["key"])).alias("fits"))
        .where(F.size("fits") > 0)
        .select("_h", "_p", F.get("fits", F.lit(0)).alias("r"))
        .groupBy("_h", "_p")
        .agg(
            F.max_by("r", F.struct(F.col("r.size"), F.length(F.substring_index("r.key", SEPARATOR, 1)))).alias("r")
        )
        .select("_h", "_p", "r.rule", "r.verdict")
    )
    decided = materialize(best, "url-verdicts")
    return parsed.join(
        decided.select(
            F.col("_h").alias("_dh"), F.col("_p").alias("_dp"), F.col("rule").alias("_rule"),
            F.col("verdict").alias("_verdict"),
        ),
        (F.col("_h") == F.col("_dh")) & (F.col("_p") == F.col("_dp")),
        "left",
    ).select(
        *[F.col("row")[c].alias(c) for c in columns],
        F.col("_h").alias("host"),
        F.col("_p").alias("path"),
        F.col("_rule").alias("rule"),
        F.coalesce("_verdict", F.lit(default)).alias("verdict"),
    )


SQL = """
WITH parts AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), hosts AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM parts
), split AS (
  SELECT page_id,
    translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
  FROM hosts
), rules(rule_host, rule_path, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), fitting AS (
  SELECT page_id, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    max_by(verdict, length(rule_host || rule_path)) AS verdict
  FROM split JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM split LEFT JOIN fitting USING (page_id)
"""
