"""URL filters as a sort-merge range join, with DataFrame functions only.

Keys are canonical: the labels of a host from the last to the first, each in
hexadecimal and closed by ``!``, so a host's key begins with the keys of all
domains above it; a path's key is its hexadecimal form.  What a rule covers is
then an interval of keys, those that begin with its own, and two intervals are
nested or apart.

A sweep sorts rules and URLs by key.  Passing a rule pushes it on the stack of
nested rules; the stack at a URL is that of the last rule before it, less the
rules that have ended, whose key the URL's does not begin with.  The order is
dealt over tasks by ranges, and each range begins with the stack that the one
before it ends with, so neither a host with a third of all URLs nor a large
rule set meets in one task.

There are two sweeps: over hosts (which rule hosts is a URL under), then over
paths below each of these rule hosts.  Equal URLs are judged once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.skew import HOT_ROWS, join_salted
from tessera.session import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The verdict on a URL that no rule fits.
DEFAULT = "allow"


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty if it is null or
    has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.coalesce(lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return host, path


def host_key(host: Column) -> Column:
    labels = F.transform(F.reverse(F.split(host, r"\.", -1)), lambda x: F.concat(F.hex(x), F.lit("!")))
    return F.array_join(labels, "")


def _stacks(starts: DataFrame) -> DataFrame:
    """(key, stack): for each distinct key the keys that it begins with, itself
    included, shortest first."""
    keys = starts.select("key").distinct()
    above = keys.select("key", F.explode(F.sequence(F.lit(1), F.length("key"))).alias("n")).select(
        F.col("key").alias("inner"), F.substring("key", F.lit(1), F.col("n")).alias("key"))
    return (above.join(keys, "key").groupBy("inner")
            .agg(F.sort_array(F.collect_list(F.struct(F.length("key").alias("n"), F.col("key").alias("key")))).alias("stack"))
            .select(F.col("inner").alias("key"), F.col("stack.key").alias("stack")))


def sweep(points: DataFrame, starts: DataFrame, tie: str) -> DataFrame:
    """``points`` (distinct; column ``key`` and others, of which ``tie`` tells
    points of one key apart) with ``stack``: the keys of ``starts`` that the
    point's key begins with, shortest first."""
    stacks = _stacks(starts)
    rest = [c for c in points.columns if c != "key"]
    events = points.select("key", F.lit(1).alias("kind"), *rest).unionByName(
        stacks.select("key", F.lit(0).alias("kind"), "stack"), allowMissingColumns=True)
    # ranges of the sorted order; written down, for both uses must see the same ranges
    dealt = cut_lineage(events.repartitionByRange(F.col("key"), F.col("kind"), F.col(tie))
                        .withColumn("range", F.spark_partition_id()))
    ends = dealt.groupBy("range").agg(F.max_by("stack", F.when(F.col("kind") == 0, F.col("key"))).alias("stack"))
    # one row per range: a few thousand at most, whatever the data
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("range", F.last("stack", ignorenulls=True).over(earlier).alias("stack")).where("stack is not null")
    begun = dealt.unionByName(carried.select("range", "stack", F.lit("").alias("key"), F.lit(-1).alias("kind")),
                              allowMissingColumns=True)
    so_far = Window.partitionBy("range").orderBy("key", "kind", tie).rowsBetween(Window.unboundedPreceding, 0)
    swept = begun.withColumn("stack", F.last("stack", ignorenulls=True).over(so_far)).where("kind = 1")
    active = F.filter(F.coalesce("stack", F.array().cast("array<string>")), lambda k: F.col("key").startswith(k))
    return swept.select("key", *rest, active.alias("stack"))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT, page_id: str = "page_id",
               url: str = "url", hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule (its host and
    path; null if none fits), verdict.

    ``rules`` (host, path, verdict) fit their host and all its subdomains if
    the URL's path begins with theirs.  The longest wins (host and path
    together, then host); of rules with equal host and path ``block`` does.
    Rules with a null host are left out, a null path is empty.  Null URLs have
    empty host and path and, like all URLs without a rule, the default verdict.
    Repeated rows are judged each; further columns are not read."""
    host, path = host_and_path(F.col(url).cast("string"))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    distinct = cut_lineage(rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")))
    rules = (rules.where("host is not null")
             .groupBy(lower_ascii(F.col("host")).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"))
             .agg(F.max_by("verdict", F.col("verdict") == "block").alias("verdict"))
             .withColumn("host_key", host_key(F.col("rule_host")))
             .withColumn("key", F.concat("host_key", F.lit("/"), F.hex("rule_path"))))
    # under which rule hosts
    under = sweep(distinct.select(host_key(F.col("host")).alias("key"), "host", "path"),
                  rules.select(F.col("host_key").alias("key")), "path")
    below = under.select("host", "path", F.explode("stack").alias("host_key")).select(
        F.concat("host_key", F.lit("/"), F.hex("path")).alias("key"), "host", "path")
    # which of their paths: the longest is on top
    fitting = (sweep(below, rules.select("key"), "host").where(F.size("stack") > 0)
               .select("host", "path", F.element_at("stack", -1).alias("key")))
    best = (fitting.join(rules.select("key", "rule_host", "rule_path", "verdict"), "key")
            .groupBy("host", "path").agg(F.max(F.struct(
                (F.length("rule_host") + F.length("rule_path")).alias("length"), F.length("rule_host").alias("host_length"),
                F.concat("rule_host", "rule_path").alias("rule"), "verdict")).alias("best")))
    judged = cut_lineage(distinct.join(best, ["host", "path"], "left").select(
        "host", "path", "n", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")))
    return join_salted(rows, judged, ["host", "path"], "n", hot_rows).select("page_id", "host", "path", "rule", "verdict")


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT, url: str = "url") -> DataFrame:
    """The rows of ``pages`` whose URL is allowed, all columns as they are.
    Verdicts are found per distinct URL, so ``pages`` needs no key."""
    urls = pages.groupBy(F.col(url).cast("string").alias("page_id")).agg(F.count(F.lit(1)).alias("n"))
    bad = judge_urls(urls.select("page_id", F.col("page_id").alias("url")), rules, default).where("verdict = 'block'")
    return pages.join(bad.select(F.col("page_id").alias("__blocked")), F.col(url).cast("string").eqNullSafe(F.col("__blocked")), "left_anti")
