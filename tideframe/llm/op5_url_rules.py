"""URL rules by a sort-merge range join over reversed hosts.

A host's canonical key is its labels in reverse, each closed by a separator. A rule's host and
all its subdomains are then one interval of keys, and intervals either nest or are disjoint. URLs
are dealt to ranges of (key, salt), whose limits come from a bounded sample; a key that many rows
share is cut by its salt. Each rule goes to every range that its interval meets. Within a range,
rules and URLs are swept in key order while a stack keeps the rules whose interval is open; of
these the longest whose path starts the URL's path decides. A URL that no rule fits is allowed.

Nulls: a null URL and one without `://` have an empty host and path, which no rule fits. Repeated
rows keep their rows. URLs of any length are whole. Rules that agree in host and path count once, block
before allow; of rules that fit, the longest host and path together decides. New columns take names
that no column of pages has in any case. No rules, or an empty table, give no match and no row.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideframe.llm.common import fresh, tidied

#: A character that no host holds, and the one after it, which closes an interval.
SEPARATOR, AFTER = "/", "0"
#: Sampled rows for each range; what the sample sends to the driver is bounded by this and the number of ranges.
SAMPLE = 20
DEFAULT = "allow"


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(rest, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, "[.]")), SEPARATOR), F.lit(SEPARATOR))


def match_urls(pages: DataFrame, rules: DataFrame, url: str = "url", ranges: int | None = None) -> tuple[DataFrame, dict[str, str]]:
    """pages with host, path, rule and verdict; and the new columns' names.

    rules: host, path, verdict (allow or block).
    """
    spark = pages.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = {c: fresh(pages, c) for c in ("host", "path", "rule", "verdict")}
    inner = {c: fresh(pages, f"u_{c}") for c in ("key", "salt", "range", "path", "is_url", "rule", "verdict")}
    key, salt, place = inner["key"], inner["salt"], inner["range"]
    keyed = pages.withColumns({names["host"]: host_of(F.col(url)), names["path"]: path_of(F.col(url)), salt: F.xxhash64(F.monotonically_increasing_id())})
    keyed = keyed.withColumn(key, host_key(F.col(names["host"])))
    sample = keyed.select(key, salt).orderBy(F.xxhash64(salt)).limit(SAMPLE * ranges).collect()
    cuts = sorted((r[0], r[1]) for r in sample)[SAMPLE::SAMPLE]  # range i holds cuts[i - 1] <= (key, salt) < cuts[i]
    schema = [*keyed.columns, place]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_key, at_salt = schema.index(key), schema.index(salt)
        for batch in batches:
            found = [bisect_right(cuts, x) for x in zip(batch.column(at_key).to_pylist(), batch.column(at_salt).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int32())], names=schema)

    def deal_rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = (float("-inf"),)
        for batch in batches:
            for lo, path, rule, verdict in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                first, last = bisect_right(cuts, (lo, *low)), bisect_left(cuts, (lo[:-1] + AFTER, *low))
                n = last - first + 1
                yield pa.RecordBatch.from_arrays([pa.array([lo] * n), pa.array([path] * n), pa.array([rule] * n), pa.array([verdict] * n), pa.array(range(first, last + 1), pa.int32())], names=["key", "path", "rule", "verdict", "range"])

    from pyspark.sql.types import IntegerType, StructField, StructType

    urls = keyed.mapInArrow(tidied(deal), StructType([*keyed.schema.fields, StructField(place, IntegerType())])).withColumn(inner["is_url"], F.lit(1))
    host, path = F.lower("host"), F.col("path")
    ruled = rules.where(F.col("host").isNotNull() & F.col("path").isNotNull()).groupBy(host.alias("host"), path.alias("path")).agg(F.max("verdict").alias("verdict"))
    ruled = ruled.select(host_key(F.col("host")).alias("key"), "path", F.concat("host", "path").alias("rule"), "verdict")
    ruled = ruled.mapInArrow(tidied(deal_rules), "key string, path string, rule string, verdict string, range int")
    ruled = ruled.select(F.col("key").alias(key), F.col("path").alias(inner["path"]), F.col("rule").alias(inner["rule"]), F.col("verdict").alias(inner["verdict"]), F.col("range").alias(place), F.lit(0).alias(inner["is_url"]))
    both = urls.unionByName(ruled, allowMissingColumns=True)
    dealt = both.repartitionById(ranges, F.col(place)).sortWithinPartitions(place, key, inner["is_url"])

    kept = [*pages.columns, names["host"], names["path"]]
    kinds = {f.name: f for f in keyed.schema.fields}
    out_schema = StructType([kinds[c] for c in kept]).add(names["rule"], "string").add(names["verdict"], "string")
    order = dealt.columns
    at = {c: order.index(c) for c in (place, key, inner["is_url"], inner["path"], inner["rule"], inner["verdict"], names["path"])}

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[tuple[str, dict[str, tuple[str, str]], list[int]]] = []  # open intervals: key, rules by path, path lengths from the longest
        here = None
        for batch in batches:
            columns = [batch.column(at[c]).to_pylist() for c in (place, key, inner["is_url"], inner["path"], inner["rule"], inner["verdict"], names["path"])]
            rows, found, verdicts = [], [], []
            for i, (part, k, is_url, rule_path, rule, verdict, url_path) in enumerate(zip(*columns, strict=True)):
                if part != here:
                    here, stack = part, []
                while stack and not k.startswith(stack[-1][0]):
                    stack.pop()
                if not is_url:
                    if not stack or stack[-1][0] != k:
                        stack.append((k, {}, []))
                    _, by_path, lengths = stack[-1]
                    by_path[rule_path] = (rule, verdict)
                    if len(rule_path) not in lengths:
                        lengths.append(len(rule_path))
                        lengths.sort(reverse=True)
                    continue
                best = None
                for _, by_path, lengths in stack:
                    hit = next((x for n in lengths if n <= len(url_path) and (x := by_path.get(url_path[:n]))), None)
                    if hit and (best is None or len(hit[0]) > len(best[0])):
                        best = hit
                rows.append(i)
                found.append(best and best[0])
                verdicts.append(best[1] if best else DEFAULT)
            chosen = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*(chosen.column(order.index(c)) for c in kept), pa.array(found, pa.string()), pa.array(verdicts, pa.string())], names=[*kept, names["rule"], names["verdict"]])

    return dealt.mapInArrow(tidied(sweep), out_schema), names


#: The rules of the query: verdict, host, path.
RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    return match_urls(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"), rules)[0].drop("url")


ORACLE_SQL = f"""
WITH rules(verdict, host, path) AS (VALUES {", ".join(str(r) for r in RULES)}),
parts AS (SELECT page_id,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages)
SELECT page_id, host, path,
  (SELECT arg_max(r.host || r.path, length(r.host || r.path)) FROM rules r WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)) AS rule,
  coalesce((SELECT arg_max(r.verdict, length(r.host || r.path)) FROM rules r WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)), '{DEFAULT}') AS verdict
FROM parts p
"""
