"""URL filter rules by a sort-merge range join (operator 8); DataFrame functions only.

A host's canonical key is its labels in reverse, each with a dot ("net.example.www.").
A rule's host and all its subdomains are then the keys that begin with the rule's key:
one interval.  Intervals of different hosts are nested or apart, so a sweep over keys in
order keeps a stack of active rules: a rule's start pushes, its end goes back to its
parent's stack.

The sweep runs over distinct hosts and interval boundaries, range-partitioned by key.
Each boundary carries the stack that holds after it, a host takes that of the last
boundary at or below its key (a running ``last`` in its partition), and where a partition
has none before it, the last of an earlier partition (one row per partition).  URLs then
join their host's stack, and the longest rule of the stack whose path begins the URL's path
decides.  The stack of a host is as deep as its rules are, not as there are URLs.

Null URLs and URLs without "://" have empty host and path and fit no rule.  Of rules of
equal length the longer host wins, then "block".  Repeated rules count once, rows of
``urls`` once each; rules with a null or empty host never fit.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finmesh.llm.common import ascii_lower, stored

#: The rules of the registered query.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
RULE_SCHEMA = "host string, path string, verdict string"
STACK = "array<struct<rule:string,path:string,verdict:string,host_length:int>>"


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(__url, instr(__url, '://') + 3)"))
    host = ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def host_key(host: Column) -> Column:
    return F.when(host != "", F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))).otherwise(F.lit(""))


def _boundaries(rules: DataFrame) -> DataFrame:
    """(key, edge, stack): start (edge 0) and end (edge -1) of each rule host's interval, and the stack after it.

    The end of a key is the key with its last dot as the next character, "/"."""
    own = rules.where("host is not null and host <> ''").select(
        ascii_lower(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict").distinct()
    hosts = own.groupBy("host").agg(F.collect_list(F.struct(
        F.concat("host", "path").alias("rule"), "path", "verdict", F.length("host").alias("host_length"))).alias("own")
    ).withColumn("key", host_key(F.col("host")))
    # a host's ancestors among the rules: the rule hosts whose key begins its key
    labels = F.split("key", r"\.")
    above = hosts.select("key", F.posexplode(F.transform(
        F.sequence(F.lit(1), F.size(labels) - 1), lambda k: F.concat(F.array_join(F.slice(labels, 1, k), "."), F.lit(".")))).alias("depth", "above"))
    chains = above.join(hosts.select(F.col("key").alias("above"), "own"), "above").groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("depth", "own"))).alias("chain"))
    stack = F.flatten(F.col("chain.own")).cast(STACK)
    outer = F.flatten(F.slice(F.col("chain.own"), 1, F.size("chain") - 1)).cast(STACK)
    return chains.select("key", F.lit(0).alias("edge"), stack.alias("stack")).unionByName(
        chains.select(F.expr("concat(substring(key, 1, length(key) - 1), '/')").alias("key"), F.lit(-1).alias("edge"), outer.alias("stack")))


def judge(urls: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """(id, host, path, rule, verdict) for each row of ``urls``."""
    host, path = host_and_path(F.col("__url"))
    pages = urls.select(F.col(id_col).alias("__id"), F.col(url_col).alias("__url")).select("__id", host.alias("host"), path.alias("path"))
    hosts = pages.where("host <> ''").select("host").distinct().select(
        host_key(F.col("host")).alias("key"), F.lit(1).alias("edge"), F.lit(None).cast(STACK).alias("stack"), "host")
    events = hosts.unionByName(_boundaries(rules).withColumn("host", F.lit(None).cast("string")))
    # range partitions in key order; equal keys stay together
    events = stored(events.repartitionByRange("key").withColumn("part", F.spark_partition_id()), "url-events")
    last = events.where("stack is not null").groupBy("part").agg(F.max_by("stack", F.struct("key", "edge")).alias("stack"))
    parts = events.groupBy("part").agg(F.lit(1).alias("one")).join(last, "part", "left")
    carried = parts.select("part", F.last("stack", ignorenulls=True).over(       # one row per partition
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    running = Window.partitionBy("part").orderBy("key", "edge").rowsBetween(Window.unboundedPreceding, 0)
    active = events.select("part", "host", F.last("stack", ignorenulls=True).over(running).alias("stack")).where("host is not null").join(
        F.broadcast(carried), "part").select("host", F.coalesce("stack", "carried").alias("stack")).where(F.size("stack") > 0)
    best = F.expr("""array_max(transform(filter(stack, r -> startswith(path, r.path)),
        r -> struct(length(r.rule) as l, r.host_length as h, r.verdict as verdict, r.rule as rule)))""")
    judged = pages.join(active, "host", "left").select("__id", "host", "path", best.alias("best"))
    return judged.select(F.col("__id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"),
                         F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def rules_frame(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(rules, RULE_SCHEMA)
