"""URL filters by a sort-merge range join over reversed-host keys.

A rule is a host and the start of a path.  It fits its host and all subdomains,
for urls whose path starts with the rule's; of the rules that fit, the longest
(host and path together, then the longer host) decides.  A rule given with both
verdicts blocks.

With its labels reversed and a dot behind each, a host's key is the start of the
keys of its subdomains, so a rule's host is an interval of sorted keys; below
one host, a rule's path is an interval of sorted paths.  Such intervals are
nested or apart.  In the sorted sweep, the rule before a url's key, and the rules
around that rule (its stack), are all that can be open there; the stack without
those already closed is what fits.  One sweep over hosts finds the rule hosts of
every url, one over paths the longest rule below each.

The sweep is ``ordered_scan``: rules and urls are range-partitioned by key and
row, so a url that a third of the rows share is cut into pieces, and the number
of rules before a key is its running sum.  All of it is DataFrame functions.

Defined results: a null url, or one without ``://``, has an empty host and path
and fits no rule; rules without a host fit nothing; no rules leave every url to
the default; repeated pages are judged alike; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.llm.common import lower_ascii, stored
from salescope.operators.ordered import ordered_scan
from salescope.session import durable

SEPARATOR = "/"  # between host and path of a key; no host contains it
DEFAULT = "allow"


def host_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = lower_ascii(F.regexp_extract(rest, "^[^/?#]*", 0))
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def reversed_host(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def nested(prefixes: DataFrame) -> DataFrame:
    """``(prefix, stack)``: every distinct prefix with the ones that begin it, itself last."""
    unique = prefixes.select("prefix").distinct()
    starts = unique.withColumn("n", F.explode(F.sequence(F.lit(1), F.length("prefix"))))
    starts = starts.select("prefix", F.col("prefix").substr(F.lit(1), F.col("n")).alias("start"))
    found = starts.join(unique.select(F.col("prefix").alias("start")), "start")
    return found.groupBy("prefix").agg(F.array_sort(F.collect_set("start")).alias("stack"))


def sweep(points: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Add ``stack`` to ``points(uid, key, ...)``: the prefixes of its key, shortest first."""
    rules = nested(prefixes)
    lines = points.select("uid", "key", F.lit(0).alias("rule")).unionByName(
        rules.select(F.lit(-1).cast("long").alias("uid"), F.col("prefix").alias("key"), F.lit(1).alias("rule"))
    )
    # A rule stands before the urls that equal it.
    counted = durable(
        ordered_scan(
            lines,
            [F.col("key"), F.col("rule").desc(), F.xxhash64("uid"), F.col("uid")],
            running={"before": F.col("rule").cast("long")},
        )
    )
    numbered = counted.filter("rule = 1").select("before", F.col("key").alias("prefix"))
    stacks = stored(numbered.join(rules, "prefix").select("before", "stack"), "stacks")
    # Spark may split a rule that very many urls follow.
    found = counted.filter("rule = 0 AND before > 0").join(stacks, "before")
    open_ones = F.filter("stack", lambda p: F.col("key").startswith(p))
    return found.select("uid", "key", open_ones.alias("stack")).filter(F.size("stack") > 0)


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` of every row.

    rules  ``(host, path, verdict)`` with verdict ``allow`` or ``block``
    """
    host, path = host_path(F.col("url").cast("string"))
    base = durable(pages.select("page_id", host.alias("host"), path.alias("path")))
    base = base.withColumn("uid", F.monotonically_increasing_id())
    rules = rules.select(
        lower_ascii(F.col("host")).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"), "verdict"
    ).filter("rule_host <> ''")
    rules = rules.groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("verdict"))
    rules = stored(
        rules.withColumn("host_key", reversed_host(F.col("rule_host"))).withColumn(
            "rule_key", F.concat("host_key", F.lit(SEPARATOR), "rule_path")
        ),
        "rules",
    )
    urls = base.select("uid", F.concat(reversed_host(F.col("host")), F.lit(SEPARATOR), F.col("path")).alias("key"))
    hosts = sweep(urls, rules.select(F.col("host_key").alias("prefix")))
    path_of = F.substring(F.col("key"), F.instr("key", SEPARATOR) + 1, F.length("key"))
    below = hosts.select("uid", path_of.alias("path"), F.explode("stack").alias("host_key"))
    paths = below.select("uid", F.concat("host_key", F.lit(SEPARATOR), "path").alias("key"))
    fits = sweep(paths, rules.select(F.col("rule_key").alias("prefix")))
    longest = fits.select("uid", F.try_element_at("stack", F.lit(-1)).alias("rule_key")).join(rules, "rule_key")
    best = longest.groupBy("uid").agg(
        F.max(
            F.struct(
                F.length(F.concat("rule_host", "rule_path")).alias("n"),
                F.length("rule_host").alias("m"),
                "verdict",
                F.concat("rule_host", "rule_path").alias("rule"),
            )
        ).alias("best")
    )
    return base.join(best, "uid", "left").select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
