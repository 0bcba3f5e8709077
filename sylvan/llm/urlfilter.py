"""URL filters as a sort-merge range join (native DataFrame operations only).

A host is written label by label from the right (``de.example.com`` becomes
``com.example.de.``), so that a host rule is an interval of keys: all keys that
start with the rule's key.  Path rules are intervals of paths within a host
rule.  Such intervals are nested or disjoint.  A sweep over keys and interval
starts in sorted order therefore only has to look at the last interval that
began before a key: the rules active at the key are those members of that
interval's stack (itself and the intervals around it) that are prefixes of the
key.  The sweep is a ``last(stack)`` window over sorted events.

Two sweeps: over the distinct hosts against the rule hosts, then over the
distinct (rule host, path) pairs against that host's path rules.  Each sweep is
dealt out over ``salts`` groups and the rules (not the urls) are repeated in
each, so no host, however frequent, is one task's work.  Rules are joined, not
broadcast, and can be a table of any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sylvan.llm.common import ascii_lower, table

SALTS = 64

#: The rules of the query: (host, path, verdict).
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.substring_index(url, "://", 1)
    after = F.substr(url, F.length(rest) + 4, F.length(url))
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    return F.when(F.instr(url, "://") > 0, ascii_lower(host)).otherwise(F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    rest = F.substring_index(url, "://", 1)
    after = F.substr(url, F.length(rest) + 4, F.length(url))
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.when(F.instr(url, "://") > 0, path).otherwise(F.lit(""))


def host_key(host: Column) -> Column:
    """Labels in reverse order, each followed by a dot; the empty host is the empty key."""
    reverse = F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))
    return F.when(host == "", F.lit("")).otherwise(reverse)


def _with_stack(rules: DataFrame, group: list[str], key: str, value: Column) -> DataFrame:
    """Each distinct rule key with its stack: the values of all rules of its group that are prefixes of it."""
    starts = rules.select(*group, key).distinct()
    prefixes = starts.select(
        *group, F.col(key).alias("_start"),
        F.explode(F.transform(F.sequence(F.lit(0), F.length(key)), lambda n: F.substring(F.col(key), F.lit(1), n))).alias(key))
    return (prefixes.join(rules.select(*group, key, value.alias("_value")), [*group, key])
            .groupBy(*group, "_start").agg(F.array_sort(F.collect_list("_value")).alias("stack"))
            .withColumnRenamed("_start", key))


def _sweep(keys: DataFrame, starts: DataFrame, group: list[str], key: str, salts: int) -> DataFrame:
    """``keys`` with the stack of the last interval that begins at or before the key (null: none)."""
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in keys.columns]), F.lit(salts)).cast("int")
    rest = [c for c in keys.columns if c not in (*group, key)]
    events = keys.select(*group, key, *rest, salt.alias("_salt"), F.lit(1).alias("_kind"))
    copies = starts.select(*group, key, "stack",
                           F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"), F.lit(0).alias("_kind"))
    both = events.unionByName(copies, allowMissingColumns=True)
    order = (Window.partitionBy(*group, "_salt").orderBy(key, "_kind")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (both.withColumn("stack", F.last("stack", ignorenulls=True).over(order))
            .filter(F.col("_kind") == 1).drop("_salt", "_kind"))


def rules_table(spark: SparkSession, rules=None) -> DataFrame:
    rows = list(RULES if rules is None else rules)
    return spark.createDataFrame(rows, "host string, path string, verdict string")


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow",
               salts: int = SALTS) -> DataFrame:
    """All rows of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` of their url.

    A rule (host, path) fits its host and all subdomains if the url's path
    starts with the rule's path (so a rule with path ``/`` does not fit a url
    without any path).  The longest rule text wins; of equally long ones the
    longer host.  If a rule is given twice with different verdicts, ``block``
    holds.  Null urls and urls without ``://`` have empty host and path and the
    default verdict; repeated rows stay repeated; an empty table gives none.
    Columns of ``pages`` named like an output column are replaced.
    """
    outputs = ("host", "path", "rule", "verdict")
    rows = pages.select(*[c for c in pages.columns if c not in outputs],
                        url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    rules = (rules.filter(F.col("host").isNotNull() & F.col("path").isNotNull())
             .groupBy(ascii_lower(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path"))
             .agg(F.max("verdict").alias("verdict"))
             .withColumn("rule_key", host_key(F.col("rule_host"))))

    # First sweep: which rule hosts are active at each distinct host.
    host_starts = _with_stack(rules.select(F.col("rule_key").alias("key")).distinct(), [], "key", F.col("key"))
    hosts = rows.select("host").distinct().withColumn("key", host_key(F.col("host")))
    active = (_sweep(hosts, host_starts, [], "key", salts)
              .select("host", F.explode(F.filter("stack", lambda s: F.startswith(F.col("key"), s))).alias("rule_key")))

    # Second sweep: the path rules of each active rule host.
    value = F.struct(F.length("rule_path").alias("n"), F.col("rule_path").alias("path"),
                     F.length("rule_host").alias("h"), F.col("rule_host").alias("host"), F.col("verdict").alias("verdict"))
    path_starts = _with_stack(rules.withColumnRenamed("rule_path", "path_key").withColumn("rule_path", F.col("path_key")),
                              ["rule_key"], "path_key", value)
    paths = (rows.select("host", "path").distinct().join(active, "host")
             .select("rule_key", F.col("path").alias("path_key"), "host"))
    fits = F.filter("stack", lambda s: F.startswith(F.col("path_key"), s["path"]))
    best = (_sweep(paths, path_starts, ["rule_key"], "path_key", salts)
            .select("host", F.col("path_key").alias("path"), F.try_element_at(F.reverse(fits), F.lit(1)).alias("r"))
            .filter(F.col("r").isNotNull())
            .groupBy("host", "path")
            .agg(F.max(F.struct((F.col("r.n") + F.col("r.h")).alias("n"), F.col("r.h").alias("h"),
                                F.concat("r.host", "r.path").alias("rule"), F.col("r.verdict").alias("verdict"))).alias("b"))
            .select("host", "path", F.col("b.rule").alias("rule"), F.col("b.verdict").alias("verdict")))
    return (rows.join(best, ["host", "path"], "left")
            .withColumn("verdict", F.coalesce("verdict", F.lit(default))))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, rules_table(spark)).select("page_id", "host", "path", "rule", "verdict")


ORACLE = r"""
WITH parts AS (
  SELECT page_id,
         CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages
), urls AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM parts
)
SELECT page_id, host, path,
  CASE WHEN rn THEN 'example.net/en/' WHEN rd THEN 'example.com/de/' WHEN ro THEN 'org/fr/' WHEN rb THEN 'net/' END AS rule,
  CASE WHEN rn THEN 'allow' WHEN rd THEN 'block' WHEN ro THEN 'allow' WHEN rb THEN 'block' ELSE 'allow' END AS verdict
FROM (
  SELECT *,
    (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') AS rn,
    (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') AS rd,
    (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') AS ro,
    (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') AS rb
  FROM urls) AS u
"""

QUERIES = {"op6_url_filters": op6_url_filters}
ORACLES = {"op6_url_filters": ORACLE}
