"""URL rules by a sort-merge range join, in DataFrame functions only.

A host with its labels reversed and closed by slashes (``net/example/``) makes
"this host and all subdomains" a prefix, and a prefix is an interval of sorted
keys: from the prefix itself to the prefix followed by byte FF, which no UTF-8
text holds. Intervals of prefixes nest. Sorting keys and interval ends together
and sweeping over them, the rules active at a key are those of the last interval
end before it; every end carries the stack of rules active after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmill.session import stage


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other letters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url: after the first ``://`` up to ``/ ? #``, then up to ``? #``; else empty."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return lower_ascii(host), path


def host_key(host: Column) -> Column:
    """Labels in reverse order, each closed by a slash, which no host holds."""
    return F.concat_ws("", F.transform(F.reverse(F.split(host, r"\.")), lambda x: F.concat(x, F.lit("/"))))


def nested(rules: DataFrame) -> DataFrame:
    """(key, chain): for each distinct key of ``rules`` the keys that are its prefixes, outermost first.

    Prefixes are looked up by equality, one row per character of a rule; rules only,
    never the rows that are judged.
    """
    keys = rules.select("key").distinct()
    prefixes = keys.select("key", F.explode(F.transform(
        F.sequence(F.lit(0), F.length("key")), lambda n: F.substr(F.col("key"), F.lit(1), n)
    )).alias("prefix"))
    return (
        prefixes.join(keys.select(F.col("key").alias("prefix")), "prefix")
        .groupBy("key").agg(F.array_sort(F.collect_list(F.struct(F.length("prefix").alias("n"), "prefix"))).alias("chain"))
        .select("key", F.col("chain.prefix").alias("chain"))
    )


def sweep(points: DataFrame, rules: DataFrame) -> DataFrame:
    """(key, chain): each distinct ``key`` of points with the rule keys that are its prefixes.

    Keys and interval ends are range-partitioned, so no partition grows with the
    data, and swept inside each partition; what is active at a partition's start is
    the last stack of the partitions before it, one row each.
    """
    chains = nested(rules)
    opens = chains.select(F.encode("key", "UTF-8").alias("at"), F.lit(0).alias("kind"), F.lit(None).cast("string").alias("key"), "chain")
    closes = chains.select(
        F.concat(F.encode("key", "UTF-8"), F.unhex(F.lit("FF"))).alias("at"), F.lit(0).alias("kind"),
        F.lit(None).cast("string").alias("key"), F.slice("chain", F.lit(1), F.size("chain") - 1).alias("chain"),
    )
    keys = points.select("key").distinct().select(
        F.encode("key", "UTF-8").alias("at"), F.lit(1).alias("kind"), "key", F.lit(None).cast("array<string>").alias("chain")
    )
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    events = stage(
        keys.unionAll(opens).unionAll(closes).repartitionByRange(parts, "at", "kind")
        .withColumn("part", F.spark_partition_id()), "sweep-events",
    )
    in_part = Window.partitionBy("part").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    ends = events.where(F.col("chain").isNotNull()).groupBy("part").agg(
        F.max(F.struct("at", "kind", "chain"))["chain"].alias("last")
    )
    # one row per partition: the stack it hands on, carried over those without an event
    carried = (
        events.select("part").distinct().join(ends, "part", "left")
        .select(F.col("part").alias("of_part"), F.last("last", ignorenulls=True).over(
            Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        ).alias("carried"))
    )
    swept = events.withColumn("active", F.last("chain", ignorenulls=True).over(in_part)).where(F.col("kind") == 1)
    none = F.array().cast("array<string>")
    return swept.join(carried, F.col("part") == F.col("of_part")).select(
        "key", F.coalesce("active", "carried", none).alias("chain")
    )


def judge_urls(pages: DataFrame, rules: DataFrame, otherwise: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    ``rules`` has host, path (empty or starting with a slash) and verdict. A rule
    fits its host and all subdomains if the url's path starts with the rule's path;
    an empty rule host fits only an empty url host. The longest fitting rule
    (characters of host and path, then of host) wins; of rules with the same host
    and path the smaller verdict does. Without one the verdict is ``otherwise`` and
    the rule null. Null urls have an empty host and path; repeated pages give
    repeated rows; an empty table gives none.
    """
    host, path = split_url(F.col("url"))
    judged = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rules = (
        rules.select(lower_ascii(F.coalesce("host", F.lit(""))).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"), "verdict")
        .groupBy("rule_host", "rule_path").agg(F.min("verdict").alias("verdict"))
        .withColumn("rule_key", host_key(F.col("rule_host")))
    )
    hosts = judged.select("host").distinct().withColumn("key", host_key(F.col("host")))
    owners = sweep(hosts, rules.select(F.col("rule_key").alias("key")))
    candidates = hosts.join(owners, "key").select("host", F.explode("chain").alias("rule_key"))
    # second sweep: distinct paths below the rule hosts they fit, against the rule paths of those hosts
    below = F.concat("rule_key", F.lit("?"), "path")  # neither part holds a question mark
    wanted = judged.select("host", "path").distinct().join(candidates, "host").select("host", "path", "rule_key", below.alias("key"))
    wanted = stage(wanted, "candidate-rules")
    paths = rules.withColumn("key", F.concat("rule_key", F.lit("?"), "rule_path"))
    found = sweep(wanted, paths).where(F.size("chain") > 0).select("key", F.try_element_at("chain", F.lit(-1)).alias("found"))
    length = F.length(F.concat("rule_host", "rule_path"))
    best = (
        wanted.join(found, "key")
        .join(paths.select(F.col("key").alias("found"), "rule_host", "rule_path", "verdict"), "found")
        .groupBy(F.col("host").alias("h"), F.col("path").alias("p"))
        .agg(F.max(F.struct(length.alias("n"), F.length("rule_host").alias("m"), "rule_host", "rule_path", "verdict")).alias("best"))
    )
    return judged.join(best, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")), "left").select(
        "page_id", "host", "path",
        F.concat("best.rule_host", F.when(F.col("best.rule_path") == "", "/").otherwise(F.col("best.rule_path"))).alias("rule"),
        F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"),
    )
