"""URL filters by a sort-merge range join.

A rule (host, path) fits its host and all subdomains if the url's path starts with the rule's path; the longest rule wins.
With a host's labels reversed and a dot after each (``com.example.www.``), a rule's host and all its subdomains are the keys that
start with the rule's key: an interval.  Intervals of different rules are nested or apart, never crossing.

Urls and rules are sorted by key.  A task sweeps its stretch of urls: it pushes a rule when its interval begins, pops it when the
key no longer starts with it, and so the stack holds just the rules that fit the host; the path decides among them.
The stretches are bounded by keys of a fixed number of urls, chosen evenly by a hash; a bound holds the page_id (without one,
a hash of the url) too, so a host with a third of all rows is spread over many stretches.  A rule goes to every stretch that its interval
meets: rules that began before are pushed first, like any other.  Bounds affect the layout only, never the result.

Verdict: that of the rule.  Without one, the method's: block a url without host, or with a whole word of a short list in its host (between dots,
hyphens and the port: ``adult-x.org``, not ``spamhaus.org``); else allow.

Edge cases: null urls and urls without ``://`` have empty host and path and no rule; hosts keep port and user part; rows that repeat a
page_id come back each; very long urls are judged whole; rules of equal length and host: block wins; equal length otherwise: the longer
host; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, shuffle_partitions

#: verdict, host, path
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Words that block a host that has one of them, whole, in a label, if no rule fits.
BLOCKED_LABELS = ("adult", "porn", "xxx", "casino", "spam", "malware")
BLOCKED = rf"(^|[.-])({'|'.join(BLOCKED_LABELS)})([.:-]|$)"
#: Urls that are looked at for the bounds of the stretches.
BOUND_ROWS = 8192


def url_host(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))).otherwise(F.lit(""))


def url_path(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_key(host: Column) -> Column:
    """Labels reversed, a dot after each, so that a domain's key starts the key of each of its subdomains."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def stretch_bounds(urls: DataFrame, stretches: int) -> list[tuple[str, int]]:
    """Ascending (key, place): where each stretch but the first begins.  About BOUND_ROWS rows come to the driver."""
    every = max(1, urls.count() // BOUND_ROWS)
    sample = urls.select("key", "place").filter(F.pmod(F.xxhash64("place", "key"), F.lit(every)) == 0).collect()
    rows = sorted((r.key, r.place) for r in sample)
    return sorted({rows[i * len(rows) // stretches] for i in range(1, stretches)}) if rows else []


def after(key: str) -> str:
    """The least string above all that start with the key."""
    return key[:-1] + chr(ord(key[-1]) + 1)


def judge_urls(pages: DataFrame, rules: DataFrame, stretches: int | None = None, column: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict (null without a rule) of every page.  rules: verdict, host, path."""
    stretches = stretches or 2 * shuffle_partitions(pages.sparkSession)
    host, path = url_host(F.col(column)), url_path(F.col(column))
    place = F.coalesce("page_id", F.xxhash64(column))  # deals a hot host over stretches, rows without page_id too
    urls = pages.select("page_id", place.alias("place"), F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path")).withColumn("key", host_key(F.col("host")))
    bounds = stretch_bounds(urls, stretches)
    keys = [k for k, _ in bounds]

    @F.pandas_udf("int")
    def stretch(key: pd.Series, place: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(bounds, (k, i)) for k, i in zip(key, place, strict=True)], dtype="int32")

    @F.pandas_udf("array<int>")
    def meets(key: pd.Series) -> pd.Series:
        """A stretch s holds keys from keys[s - 1] to keys[s], both included."""
        return pd.Series([list(range(bisect_left(keys, k), bisect_right(keys, after(k)) + 1)) for k in key])

    left = urls.withColumn("stretch", stretch("key", "place"))
    right = rules.select("verdict", "host", "path").withColumn("key", host_key(F.col("host"))).withColumn("stretch", F.explode(meets("key")))
    events = left.select("stretch", "key", F.lit(1).alias("kind"), F.col("page_id").cast("string").alias("page_id"), "host", "path", F.lit(None).cast("string").alias("verdict")).unionByName(
        right.select("stretch", "key", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("page_id"), "host", "path", "verdict")
    )
    dealt = events.repartitionById(stretches, F.col("stretch")).sortWithinPartitions("key", "kind")
    return dealt.mapInPandas(sweep, "page_id string, host string, path string, rule string, verdict string").withColumn("page_id", F.col("page_id").cast("long"))


def sweep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted events in, judged urls out.  The stack holds, for each nested host, its rules."""
    stack: list[tuple[str, list[tuple]]] = []
    for frame in frames:
        pages, hosts, paths, rules, verdicts = [], [], [], [], []
        for key, kind, page, host, path, verdict in zip(frame["key"], frame["kind"], frame["page_id"], frame["host"], frame["path"], frame["verdict"], strict=True):
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if kind == 0:
                if not stack or stack[-1][0] != key:
                    stack.append((key, []))
                stack[-1][1].append((len(host) + len(path), len(host), verdict == "block", path, host + path, verdict))
                continue
            best = max((r for _, own in stack for r in own if path.startswith(r[3])), default=None)
            pages.append(page)
            hosts.append(host)
            paths.append(path)
            rules.append(best and best[4])
            verdicts.append(best and best[5])
        yield pd.DataFrame({"page_id": pd.Series(pages, dtype=object), "host": pd.Series(hosts, dtype=object), "path": pd.Series(paths, dtype=object), "rule": pd.Series(rules, dtype=object), "verdict": pd.Series(verdicts, dtype=object)})


def with_verdict(judged: DataFrame) -> DataFrame:
    bad = F.rlike("host", F.lit(BLOCKED))
    own = F.when((F.col("host") == "") | bad, "block").otherwise("allow")
    return judged.withColumn("verdict", F.coalesce("verdict", own))


def rule_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(RULES), "verdict string, host string, path string")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_verdict(judge_urls(read_table(spark, sf_dir, "pages"), rule_table(spark)))


OP4_SQL = rf"""
with r(verdict, host, path) as (values {", ".join(map(str, RULES))}),
u as (select page_id, url, case when contains(url, '://') then substr(url, instr(url, '://') + 3) end as rest from pages),
p as (select page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
 coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path from u),
m as (select page_id, p.host, p.path, arg_max((r.host || r.path, r.verdict), (length(r.host || r.path), length(r.host))) as best
 from p left join r on (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path) group by all)
select page_id, host, path, best[1] as rule,
 coalesce(best[2], case when host = '' or regexp_matches(host, '{BLOCKED}') then 'block' else 'allow' end) as verdict from m
"""
