"""Mixing sources to target weights, with DataFrame functions only.

The tree is domain, language, source. A token budget flows down it: each node shares its
allocation among its children by weight; a child cannot take more than MAX_EPOCHS times the tokens
below it, and what it cannot take goes to its siblings by weight. As a node's own limit is that of
all it has below, shortages are made good among siblings first and reach a node's siblings only
when the whole subtree is used up. Sharing is exact in integers: children sorted by limit over
weight are filled until the next would take less than its limit.

A leaf takes its allocation as full epochs and then a prefix of the next: each epoch has an order
of its own, from a seeded digest of the row, and the prefix ends before the row that would pass the
allocation. Rows with the same digest are the same row repeated and are taken together. The prefix
is found by parts: token sums of digest ranges first, then only the range where the cut falls is
sorted, so a hot leaf is never one task. Texts are never shuffled.

Nulls: a null language or source is the node `und`; a null text has 0 tokens; a null id is part of
the digest as empty. An empty table gives an empty result. Weights are positive integers; a name
without one has DEFAULT_WEIGHT. Tokens times a node's summed weights must fit a long; past that
the query stops with an overflow error (ANSI).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideframe.llm.common import WORD_PATTERN, fresh, stored

SEED, MAX_EPOCHS, DEFAULT_WEIGHT = 17, 2, 1
#: The budget as a share of all tokens: numerator and denominator.
SHARE = (6, 10)
DOMAIN_WEIGHTS = {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1}
LANG_WEIGHTS = {"en": 5, "de": 2, "fr": 2, "es": 1}
SOURCE_WEIGHTS: dict[str, int] = {}
LEAF = ["m_domain", "m_lang", "m_source"]


def default_domain(source: Column) -> Column:
    """The number at a source's end, modulo 4; sources without a number are a domain of their own."""
    digits = F.regexp_extract(source, "([0-9]{1,9})$", 1)
    return F.when(digits != "", F.concat(F.lit("domain"), (digits.try_cast("int") % 4).cast("string"))).otherwise("domain_other")


def _weight(name: str, weights: dict[str, int]) -> Column:
    if not weights:
        return F.lit(DEFAULT_WEIGHT).cast("long")
    table = F.create_map(*(F.lit(x) for pair in weights.items() for x in pair))
    return F.coalesce(F.try_element_at(table, F.col(name)), F.lit(DEFAULT_WEIGHT)).cast("long")


def shared_among(children: DataFrame, parents: list[str], name: str, weights: dict[str, int]) -> DataFrame:
    """children (parents, name, most, given: the parent's allocation) with their own allocation as given."""
    by = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    w = children.withColumn("w", _weight(name, weights))
    order = by.orderBy(F.col("most").cast("double") / F.col("w"), name)
    w = w.withColumn("before", F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("most")).withColumn("rest", F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)))
    w = w.withColumn("full", F.col("most") * F.col("rest") <= (F.col("given") - F.col("before")) * F.col("w"))
    w = w.withColumn("left", F.col("given") - F.coalesce(F.sum(F.when(F.col("full"), F.col("most"))).over(by), F.lit(0))).withColumn("among", F.sum(F.when(~F.col("full"), F.col("w"))).over(by))
    part = F.expr("(`left` * w) div among")
    return w.withColumn("given", F.when(F.col("full"), F.col("most")).otherwise(F.least("most", part))).drop("w", "before", "rest", "full", "left", "among")


def allocations(leaves: DataFrame, share: tuple[int, int] = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """leaves (LEAF, tokens, n) with the tokens given to each."""
    d, l, s = LEAF
    leaves = leaves.withColumn("most", F.col("tokens") * max_epochs)
    langs = leaves.groupBy(d, l).agg(F.sum("most").alias("most"))
    domains = langs.groupBy(d).agg(F.sum("most").alias("most"))
    total = leaves.agg(F.least(F.expr(f"sum(tokens) * {share[0]} div {share[1]}"), F.sum("most")).alias("given"))
    domains = shared_among(domains.crossJoin(total), [], d, DOMAIN_WEIGHTS)  # total is one row
    langs = shared_among(langs.join(domains.select(d, "given"), d), [d], l, LANG_WEIGHTS)
    return shared_among(leaves.join(langs.select(d, l, "given"), [d, l]), [d, l], s, SOURCE_WEIGHTS)


def mixed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang", source: str = "source", domain=default_domain, share: tuple[int, int] = SHARE, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> tuple[DataFrame, dict[str, str]]:
    """The selected rows of docs, once for each epoch that takes them, with domain and epoch; and the new columns' names."""
    names = {c: fresh(docs, c) for c in ("domain", "epoch")}
    inner = {c: fresh(docs, c) for c in (*LEAF, "digest", "full", "parts", "cut_part", "cut")}
    node = {"m_domain": domain(F.col(source)), "m_lang": F.coalesce(lang, F.lit("und")), "m_source": F.coalesce(source, F.lit("und"))}
    digest = F.md5(F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")))))
    n_tokens = F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
    slim = stored(docs.select(*(x.alias(c) for c, x in node.items()), digest.alias("digest"), n_tokens.alias("tokens")))

    def ranged(df: DataFrame, d: str, full: str, parts: str) -> tuple[Column, Column]:
        """A row's place in its leaf's next epoch, and the part of the leaf that holds it."""
        order = F.md5(F.concat(F.lit(f"{seed}:"), F.col(full).cast("string"), F.lit(":"), F.col(d)))
        return order, F.floor(F.conv(F.substring(order, 1, 8), 16, 10).cast("long") * F.col(parts) / F.lit(1 << 32))

    leaves = slim.groupBy(*LEAF).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n"))
    given = allocations(leaves, share, max_epochs)
    full = F.when(F.col("tokens") > 0, F.expr("given div tokens")).otherwise(0)
    given = stored(given.select(*LEAF, full.alias("full"), (F.col("given") - full * F.col("tokens")).alias("rest"), F.ceil(F.sqrt("n")).cast("long").alias("parts")))
    placed = slim.join(given, LEAF).where(F.col("full") < max_epochs)
    order, part = ranged(placed, "digest", "full", "parts")
    placed = placed.select(*LEAF, "rest", order.alias("order"), part.alias("part"), "tokens")
    sums = placed.groupBy(*LEAF, "rest", "part").agg(F.sum("tokens").alias("in_part"))
    upto = F.sum("in_part").over(Window.partitionBy(*LEAF).orderBy("part").rowsBetween(Window.unboundedPreceding, 0))
    cut_parts = sums.withColumn("upto", upto).where(F.col("upto") > F.col("rest")).groupBy(*LEAF).agg(F.min("part").alias("cut_part"), F.min_by(F.col("rest") - F.col("upto") + F.col("in_part"), "part").alias("room"))
    inside = placed.join(cut_parts, LEAF).where(F.col("part") == F.col("cut_part"))
    run = F.sum("tokens").over(Window.partitionBy(*LEAF).orderBy("order").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    cuts = inside.withColumn("run", run).groupBy(*LEAF, "cut_part").agg(F.coalesce(F.max(F.when(F.col("run") <= F.col("room"), F.col("order"))), F.lit("")).alias("cut"))
    table = stored(given.select(*LEAF, "full", "parts").join(cuts, LEAF, "left"))  # a row for each leaf: files of known size, so that the planner knows whether to broadcast
    table = table.select(*(F.col(c).alias(inner[c]) for c in [*LEAF, "full", "parts", "cut_part", "cut"]))

    rows = docs.withColumns({inner[c]: x for c, x in node.items()} | {inner["digest"]: digest}).join(table, [inner[c] for c in LEAF])
    order, part = ranged(rows, inner["digest"], inner["full"], inner["parts"])
    taken = F.col(inner["cut_part"]).isNull() | (part < F.col(inner["cut_part"])) | ((part == F.col(inner["cut_part"])) & (order <= F.col(inner["cut"])))
    epochs = F.col(inner["full"]) + F.when((F.col(inner["full"]) < max_epochs) & taken, 1).otherwise(0)
    out = rows.withColumn(names["epoch"], F.explode(F.slice(F.array(*(F.lit(k) for k in range(max_epochs + 1))), F.lit(1), epochs.cast("int"))))
    return out.select(*docs.columns, F.col(inner["m_domain"]).alias(names["domain"]), names["epoch"]), names


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    out, names = mixed(docs)
    return out.select("doc_id", F.col(names["domain"]).alias("domain"), "lang", "source", F.col(names["epoch"]).alias("epoch"))


def _cases(name: str, weights: dict[str, int]) -> str:
    return f"CASE {name} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in weights.items()) + f" ELSE {DEFAULT_WEIGHT} END" if weights else str(DEFAULT_WEIGHT)


def _share_sql(of: str, to: str, parents: str, keys: str, name: str, weights: dict[str, int]) -> str:
    by = f"PARTITION BY {parents}" if parents else ""
    return f"""
{to}_a AS (SELECT *, CAST({_cases(name, weights)} AS BIGINT) AS w FROM {of}),
{to}_b AS (SELECT *, CAST(sum(most) OVER (o ROWS UNBOUNDED PRECEDING) AS BIGINT) - most AS before,
  CAST(sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS rest
  FROM {to}_a WINDOW o AS ({by} ORDER BY most / w, {name})),
{to}_c AS (SELECT *, most * rest <= (given - before) * w AS filled FROM {to}_b),
{to}_d AS (SELECT *, CAST(given - coalesce(sum(most) FILTER (filled) OVER ({by}), 0) AS BIGINT) AS remaining,
  CAST(sum(w) FILTER (NOT filled) OVER ({by}) AS BIGINT) AS among FROM {to}_c),
{to} AS (SELECT {keys}, most, CASE WHEN filled THEN most ELSE least(most, remaining * w // among) END AS given FROM {to}_d)"""


ORACLE_SQL = f"""
WITH docs AS (
  SELECT doc_id, lang, source, coalesce(lang, 'und') AS l, coalesce(source, 'und') AS s,
    CASE WHEN regexp_matches(source, '[0-9]$') THEN 'domain' || CAST(CAST(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS INTEGER) % 4 AS VARCHAR) ELSE 'domain_other' END AS d,
    md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS digest,
    coalesce(len(regexp_extract_all(text, '[^ \\t-\\r]+')), 0) AS tokens
  FROM documents),
leaves AS (SELECT d, l, s, CAST(sum(tokens) AS BIGINT) AS tokens, CAST(sum(tokens) AS BIGINT) * {MAX_EPOCHS} AS most FROM docs GROUP BY ALL),
total AS (SELECT CAST(least(sum(tokens) * {SHARE[0]} // {SHARE[1]}, sum(most)) AS BIGINT) AS given FROM leaves),
domains0 AS (SELECT d, CAST(sum(most) AS BIGINT) AS most, any_value(t.given) AS given FROM leaves, total t GROUP BY d),
{_share_sql("domains0", "domains", "", "d", "d", DOMAIN_WEIGHTS)},
langs0 AS (SELECT d, l, CAST(sum(leaves.most) AS BIGINT) AS most, any_value(domains.given) AS given FROM leaves JOIN domains USING (d) GROUP BY ALL),
{_share_sql("langs0", "langs", "d", "d, l", "l", LANG_WEIGHTS)},
sources0 AS (SELECT d, l, s, leaves.most, langs.given FROM leaves JOIN langs USING (d, l)),
{_share_sql("sources0", "sources", "d, l", "d, l, s", "s", SOURCE_WEIGHTS)},
cut AS (SELECT leaves.d, leaves.l, leaves.s, CASE WHEN tokens > 0 THEN given // tokens ELSE 0 END AS whole,
  given - CASE WHEN tokens > 0 THEN given // tokens ELSE 0 END * tokens AS rest FROM leaves JOIN sources USING (d, l, s)),
ordered AS (SELECT docs.*, whole, rest, md5('{SEED}:' || CAST(whole AS VARCHAR) || ':' || digest) AS place FROM docs JOIN cut USING (d, l, s)),
running AS (SELECT *, sum(tokens) OVER (PARTITION BY d, l, s ORDER BY place RANGE UNBOUNDED PRECEDING) AS upto FROM ordered)
SELECT doc_id, d AS domain, lang, source, CAST(e.epoch AS INTEGER) AS epoch
FROM running, (SELECT unnest(range({MAX_EPOCHS})) AS epoch) e
WHERE e.epoch < whole OR (e.epoch = whole AND upto <= rest)
"""
