"""URL filter: a sort-merge range join between page urls and host/path rules.

Hosts become reversed keys ("a.example.net" -> "net.example.a."), so that a rule's host and all its
subdomains are the half-open interval ["net.example.", "net.example/") in byte order ("/" follows "."
and never stands in a host). Paths that begin with a rule's path are an interval, too: from the path
to the path and a byte 255, which no text holds. Intervals nest or are disjoint.

Two sweeps over sorted unions of interval ends and points judge a url. The first goes over distinct
hosts; each end of a rule host's interval carries the stack of rule hosts that are open from there on
(no more than the host has labels), and a host takes the stack that the last end left. The second
goes, for each open rule host, over the paths of the urls below it; each end of a path's interval
carries the innermost rule open from there on, and a path takes the one that the last end left. Of a
url's rule hosts the longest rule wins.

Equal urls are judged once, and hosts, too. The sweeps run in lanes: a first label or rule host with
more than LANE points is dealt over several by hash, and its interval ends, and only its, are repeated in
each. All expressions are DataFrame functions.

Cases: a null url or one without "://" has empty host and path, fits no rule and gets the default
verdict. Repeated rows are judged alike. No rules: all rows get the default. Rules with null host or
path are ignored; repeated rules count once; a rule listed as both block and allow blocks. Input
columns named like a result column are replaced, all others are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import durable, lower_ascii

RESULT = ("host", "path", "rule", "verdict")
LANE = 1 << 20
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_RULE = "struct<size:int,host_size:int,blocks:int,rule:string,verdict:string>"


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, _PARTS, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _key(host: Column, end: str) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(end))


def _sweep(points: DataFrame, ends: DataFrame, by: str, lane: int) -> DataFrame:
    """points (by, key and others) with `open`: the value of the last of the ends (by, key, value) at or before their key."""
    lanes = points.groupBy(by).agg(F.ceil(F.count("*") / lane).cast("int").alias("lanes"))
    dealt = points.join(lanes, by).withColumn("lane", F.pmod(F.xxhash64(*points.columns), F.col("lanes")).cast("int")).withColumn("kind", F.lit(1))
    repeated = ends.join(lanes, by).withColumn("lane", F.explode(F.sequence(F.lit(0), F.col("lanes") - 1))).withColumn("kind", F.lit(0))
    before = Window.partitionBy(by, "lane").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = dealt.unionByName(repeated, allowMissingColumns=True).withColumn("open", F.last("value", ignorenulls=True).over(before))
    return both.where("kind = 1").drop("kind", "lane", "lanes", "value")


def _host_ends(hosts: DataFrame) -> DataFrame:
    """Start and end of each rule host's interval, with the rule hosts open from there on."""
    parts = F.split("host", r"\.")
    above = hosts.select("host", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, n, F.size(parts)), "."))).alias("up"))
    stacks = above.join(hosts.select(F.col("host").alias("up")), "up").groupBy("host").agg(F.collect_list("up").alias("inside")).withColumn("after", F.array_remove("inside", F.col("host")))
    end = lambda mark, stack: stacks.select(F.substring_index("host", ".", -1).alias("label"), _key(F.col("host"), mark).alias("key"), F.struct(F.col(stack).alias("hosts")).alias("value"))
    return end(".", "inside").unionByName(end("/", "after"))


def _path_ends(rules: DataFrame) -> DataFrame:
    """Start and end of each rule path's interval, with the innermost rule of its host open from there on."""
    ups = F.transform(F.sequence(F.lit(0), F.char_length("path") - 1), lambda n: F.left("path", n))
    above = rules.select("host", "path", F.explode(F.when(F.col("path") != "", ups).otherwise(F.array().cast("array<string>"))).alias("up"))
    around = above.join(rules.select("host", F.col("path").alias("up"), "own"), ["host", "up"]).groupBy("host", "path").agg(F.max("own").alias("outer"))
    known = rules.join(around, ["host", "path"], "left")
    start, stop = F.encode("path", "UTF-8"), F.concat(F.encode("path", "UTF-8"), F.lit(b"\xff"))
    end = lambda key, rule: known.select(F.col("host").alias("above"), key.alias("key"), F.struct(F.col(rule).alias("rule")).alias("value"))
    return end(start, "own").unionByName(end(stop, "outer"))


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", lane: int = LANE) -> DataFrame:
    """pages with host, path, rule (text of the longest fitting rule, or null) and verdict.

    rules: host, path, verdict. lane: points of a sweep's lane."""
    kept = [c for c in pages.columns if c.lower() not in RESULT]
    rows = pages.withColumn("__url", F.col(url)).select(*kept, host_of(F.col("__url")).alias("host"), path_of(F.col("__url")).alias("path"))
    blocks = F.max((F.col("verdict") == "block").cast("int")).alias("blocks")
    own = rules.where("host is not null and path is not null").groupBy(lower_ascii(F.col("host")).alias("host"), "path").agg(blocks, F.max_by("verdict", (F.col("verdict") == "block").cast("int")).alias("verdict"))
    size = (F.char_length("host") + F.char_length("path")).cast("int").alias("size")
    own = durable(own.select("host", "path", F.struct(size, F.char_length("host").cast("int").alias("host_size"), "blocks", F.concat("host", "path").alias("rule"), "verdict").cast(_RULE).alias("own")), "rules")

    pairs = rows.select("host", "path").distinct()
    hosts = pairs.select("host").distinct().select(F.substring_index("host", ".", -1).alias("label"), _key(F.col("host"), ".").alias("key"), "host")
    below = _sweep(hosts, _host_ends(own.select("host").distinct()), "label", lane).select("host", F.explode("open.hosts").alias("above"))
    points = durable(pairs.join(below, "host").select("above", F.encode("path", "UTF-8").alias("key"), "host", "path"), "points")
    fits = _sweep(points, _path_ends(own), "above", lane)
    best = fits.where("open.rule is not null").groupBy("host", "path").agg(F.max("open.rule").alias("__best"))
    return rows.join(best, ["host", "path"], "left").select(*kept, "host", "path", F.col("__best.rule").alias("rule"), F.coalesce("__best.verdict", F.lit(default)).alias("verdict"))


#: Rules of the registered query: host, path, verdict.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")


ORACLE = r"""
with parts as (
  select page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path
  from pages),
judged as (
  select page_id, host, path, case
    when (host = 'example.net' or host like '%.example.net') and path like '/en/%' then 'example.net/en/'
    when (host = 'example.com' or host like '%.example.com') and path like '/de/%' then 'example.com/de/'
    when (host = 'org' or host like '%.org') and path like '/fr/%' then 'org/fr/'
    when (host = 'net' or host like '%.net') and path like '/%' then 'net/' end as rule
  from parts)
select page_id, host, path, rule, case when rule in ('net/', 'example.com/de/') then 'block' else 'allow' end as verdict from judged
"""
