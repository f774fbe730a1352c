"""URL rules on host and path, as a sort-merge range join.

A rule holds a host and a path. It fits the URLs of its host and of all
subdomains whose path starts with its path, and the longest fitting rule gives
the verdict (length of host and path together; then the longer host). Every URL
gets one canonical key for each host that contains its own: the reversed labels
of that host, then the path. On those keys each rule is one interval, all keys
that start with its own, and intervals are nested or apart. Keys and rules are
sorted together by host and path. The sweep over them carries the last rule
that began, with the stack of rules that it is nested in. A URL pops from the
stack what ended before it, and what is left on top is its rule.

A host may hold a third of all URLs: the keys of each host are counted, those of
one with more than ``keys_per_salt`` are dealt to as many salts as they need, and each
of its salts gets a copy of its rules. Hosts without rules drop out before the sort.
URLs are numbered and stored once, so that a part that is computed again after a
lost executor has the same numbers.

Nulls, and URLs without ``://``, have an empty host and path and get the
default verdict. Repeated rows are judged each. Rules that are repeated count
once; of contrary rules with equal host and path, block wins. Other columns
of the input don't matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import heavy_lookup, literal_table, stored, table

KEYS_PER_SALT = 200_000

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]

ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return literal_table(spark, rules, {"rule_host": "string", "rule_path": "string", "rule_verdict": "string"})


def host_and_path(url: str = "url") -> tuple[F.Column, F.Column]:
    rest = f"if(instr({url}, '://') > 0, substring({url}, instr({url}, '://') + 3), '')"
    host = f"regexp_extract({rest}, '^[^/?#]*', 0)"
    tail = f"substring({rest}, char_length({host}) + 1)"
    path = F.expr(f"coalesce(regexp_extract({tail}, '^[^?#]*', 0), '')")
    return F.coalesce(F.translate(F.expr(host), ASCII_UPPER, ASCII_LOWER), F.lit("")), path


def reversed_labels(host: F.Column) -> F.Column:
    return F.reverse(F.split(host, r"\."))


def nested(rules: DataFrame) -> DataFrame:
    """Rules with a canonical host and the stack of rules of the same host that they lie in, themselves included."""
    one = rules.where("rule_host is not null and rule_path is not null and rule_verdict is not null").groupBy("rule_host", "rule_path").agg(F.max("rule_verdict").alias("rule_verdict"))
    one = one.withColumn("canon", F.array_join(reversed_labels(F.translate("rule_host", ASCII_UPPER, ASCII_LOWER)), "."))
    prefixes = one.select("canon", F.col("rule_path").alias("inner_path"), F.explode(F.expr("transform(sequence(0, char_length(rule_path)), n -> substring(rule_path, 1, n))")).alias("outer_path"))
    outer = one.select("canon", F.col("rule_path").alias("outer_path"), F.struct(F.col("rule_path").alias("path"), F.col("rule_host").alias("host"), F.col("rule_verdict").alias("verdict")).alias("rule"))
    return prefixes.join(outer, ["canon", "outer_path"]).groupBy("canon", "inner_path").agg(F.sort_array(F.collect_list("rule"), asc=False).alias("stack"))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", keys_per_salt: int = KEYS_PER_SALT) -> DataFrame:
    """pages (page_id, url) with host, path, rule and verdict."""
    host, path = host_and_path()
    ruled = nested(rules)
    urls, _ = stored(pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("row", F.monotonically_increasing_id()), "urls")
    urls = urls.withColumn("labels", reversed_labels(F.col("host")))
    # "" stands for the row itself: it meets no rule and keeps URLs without any.
    keys = urls.withColumn("canon", F.explode(F.expr("concat(array(cast(null as string)), transform(sequence(1, size(labels)), n -> array_join(slice(labels, 1, n), '.')))"))).drop("labels")
    met = keys.where("canon is not null").groupBy("canon").agg(F.count("*").alias("n")).join(ruled.select("canon").distinct(), "canon", "left_semi")
    hosts, _ = stored(met.withColumn("salts", F.ceil(F.col("n") / keys_per_salt).cast("int")), "ruled-hosts")
    # Keys without facts have no rule; the row itself stays.
    keys = heavy_lookup(keys, hosts, "canon", "n").where("canon is null or salts is not null")
    salt = F.when(F.col("canon").isNull(), F.pmod(F.xxhash64("row"), F.lit(1 << 20))).otherwise(F.pmod(F.xxhash64("row"), F.col("salts"))).cast("int")
    events = keys.select("canon", "path", F.lit(1).alias("kind"), salt.alias("salt"), "row", "page_id", "host", F.lit(None).cast("array<struct<path:string,host:string,verdict:string>>").alias("begun"))
    begins = ruled.join(hosts, "canon").select("canon", F.col("inner_path").alias("path"), F.lit(0).alias("kind"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(None).cast("long").alias("row"), F.lit(None).cast("long").alias("page_id"), F.lit(None).cast("string").alias("host"), F.col("stack").alias("begun"))
    sweep = Window.partitionBy("canon", "salt").orderBy("path", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = events.unionByName(begins).withColumn("stack", F.last("begun", ignorenulls=True).over(sweep)).where("kind = 1")
    top = F.expr("get(filter(stack, r -> startswith(path, r.path)), 0)")
    found = swept.withColumn("top", top).select("row", "page_id", "host", "path", F.expr("if(top is null, null, struct(char_length(top.host) + char_length(top.path) as n, char_length(top.host) as h, top.host as host, top.path as path, top.verdict as verdict))").alias("best"))
    best = found.groupBy("row").agg(F.first("page_id").alias("page_id"), F.first("host").alias("host"), F.first("path").alias("path"), F.max("best").alias("best"))
    return best.select("page_id", "host", "path", F.expr("concat(best.host, best.path)").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), rule_table(spark, RULES))


OP6_SQL = """
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(coalesce(rest, ''), length(regexp_extract(coalesce(rest, ''), '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM cut
), rules(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block'))
SELECT page_id, any_value(host) AS host, any_value(path) AS path, max_by(h || p, length(h) + length(p)) AS rule, coalesce(max_by(v, length(h) + length(p)), 'allow') AS verdict
FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
GROUP BY page_id
"""
