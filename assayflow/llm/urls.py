"""URL filter by association rules: combinations of URL tokens, mined by FP-growth, that tell allowed from blocked."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayflow.llm.common import cut_lineage, lower_ascii

#: (host, path, verdict). A rule fits its host and all subdomains if the path starts with its own.
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty for null or without it."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(after_scheme(url), r"^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def tokens_of(url: Column) -> Column:
    """The distinct tokens of a URL: host parts, path parts and query keys; runs of digits count as one token."""
    host = F.transform(F.split(host_of(url), r"\."), lambda x: F.concat(F.lit("h:"), x))
    path = F.transform(F.split(lower_ascii(path_of(url)), "/"), lambda x: F.concat(F.lit("p:"), F.regexp_replace(x, "[0-9]+", "0")))
    query = F.regexp_extract(after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.split(lower_ascii(query), "&"), lambda x: F.concat(F.lit("q:"), F.regexp_extract(x, r"^([^=]*)", 1)))
    return F.array_sort(F.filter(F.array_distinct(F.concat(host, path, keys)), lambda x: F.length(x) > 2))


def listed(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, else null."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, start, verdict in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        chosen = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def mine(labelled: DataFrame, support: float = 0.01, confidence: float = 0.7, most: int = 3) -> DataFrame:
    """Rules from rows of ``tokens`` and ``verdict``: antecedent, verdict, confidence and support.

    FP-growth counts token combinations; rules whose consequent is no verdict, with more than ``most`` tokens,
    or below the confidence are pruned. Support is a share of the rows, so the number of rules does not
    grow with the table.
    """
    items = labelled.select(F.concat(F.col("tokens"), F.array(F.concat(F.lit("v:"), F.col("verdict")))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(items)
    rules = model.associationRules.where((F.size("antecedent") <= most) & F.element_at("consequent", 1).startswith("v:")
                                         & ~F.exists("antecedent", lambda x: x.startswith("v:")))
    return rules.select(F.array_sort("antecedent").alias("antecedent"), F.substring(F.element_at("consequent", 1), 3, 99).alias("verdict"),
                        "confidence", "support")


def judge(pages: DataFrame, url: str = "url", rules: Sequence[tuple[str, str, str]] = RULES, support: float = 0.01,
          confidence: float = 0.7, most: int = 3, default: str = "allow") -> DataFrame:
    """Every row with ``host``, ``path``, ``rule`` and ``verdict``.

    URLs that a listed rule fits carry its verdict and are the labelled rows. For all others, mined rules whose
    tokens all occur in the URL are found through an inverted index (token to rule); the one of the highest confidence
    decides, then support, then fewer tokens, then the tokens by order, then "allow" before "block". Without a
    match the verdict is ``default``. Null URLs and URLs without ``://`` have empty host and path, no
    tokens, and get ``default``. Repeated rows all come back; an empty table, or one without labelled rows, mines
    nothing. Columns named like the new ones are replaced.
    """
    address = F.col("__row").getField(url)
    rows = pages.select(F.struct("*").alias("__row")).withColumns({"host": host_of(address), "path": path_of(address), "tokens": tokens_of(address)})
    rows = rows.withColumn("listed", listed(F.col("host"), F.col("path"), rules))
    labelled = rows.where("listed is not null").select("tokens", F.col("listed.verdict").alias("verdict"))
    mined = mine(labelled, support, confidence, most).withColumn("rule_id", F.array_join("antecedent", " "))
    mined = cut_lineage(mined)
    # Equal token sets are judged once.
    sets = rows.where("listed is null").select("tokens").distinct().where(F.size("tokens") > 0)
    index = mined.select("rule_id", "verdict", "confidence", "support", F.size("antecedent").alias("n"), F.explode("antecedent").alias("token"))
    matched = (sets.select("tokens", F.explode("tokens").alias("token")).join(index, "token")
               .groupBy("tokens", "rule_id", "verdict", "confidence", "support", "n").count().where(F.col("count") == F.col("n")))
    best = matched.groupBy("tokens").agg(F.min(F.struct(-F.col("confidence"), -F.col("support"), "n", "rule_id", "verdict")).alias("best"))
    verdicts = best.select(F.col("tokens").alias("__tokens"), F.col("best.verdict").alias("mined"))
    open_tokens = F.when(F.col("listed").isNull(), F.col("tokens"))
    done = rows.withColumn("__open", open_tokens).join(verdicts, F.col("__open") == F.col("__tokens"), "left")
    kept = [F.col(f"__row.`{c}`") for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    return done.select(*kept, "host", "path", F.col("listed.rule").alias("rule"), F.coalesce("listed.verdict", "mined", F.lit(default)).alias("verdict"))


#: The same in SQL: rules of up to three tokens by self-joins.
SQL = r"""
with u as (
  select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
v as (
  select page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path, regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) as query from u),
w as (
  select *, case when (host = 'www.example.com' or host like '%.www.example.com') and path like '/en/%' then 'www.example.com/en/'
    when (host = 'example.com' or host like '%.example.com') and path like '/en/%' then 'example.com/en/'
    when (host = 'net' or host like '%.net') and path like '/es/%' then 'net/es/'
    when (host = 'net' or host like '%.net') and path like '/fr/%' then 'net/fr/'
    when (host = 'com' or host like '%.com') and path like '/%' then 'com/' end as rule from v),
x as (select *, case when rule in ('example.com/en/', 'net/es/', 'net/fr/') then 'block' when rule is not null then 'allow' end as label from w),
t as (
  select distinct page_id, label, token from (
    select page_id, label, 'h:' || unnest(string_split(host, '.')) as token from x
    union all select page_id, label, 'p:' || regexp_replace(unnest(string_split(lower(path), '/')), '[0-9]+', '0', 'g') from x
    union all select page_id, label, 'q:' || regexp_extract(unnest(string_split(lower(query), '&')), '^([^=]*)', 1) from x) where length(token) > 2),
s as (
  select page_id, label, token as rule_id, 1 as n from t
  union all select a.page_id, a.label, a.token || ' ' || b.token, 2 from t a join t b on a.page_id = b.page_id and a.token < b.token
  union all select a.page_id, a.label, a.token || ' ' || b.token || ' ' || c.token, 3
    from t a join t b on a.page_id = b.page_id and a.token < b.token join t c on c.page_id = b.page_id and b.token < c.token),
f as (
  select rule_id, n, label, count(*) as hits, sum(count(*)) over (partition by rule_id) as alone
  from s where label is not null group by rule_id, n, label),
r as (
  select *, hits / alone as confidence from f
  where hits >= ceil(0.01 * (select count(*) from x where label is not null)) and hits / alone >= 0.7),
m as (
  select s.page_id, r.label, row_number() over (partition by s.page_id order by confidence desc, hits desc, r.n, r.rule_id, r.label) as place
  from s join r using (rule_id) where s.label is null)
select page_id, host, path, rule, coalesce(x.label, m.label, 'allow') as verdict
from x left join (select page_id, label from m where place = 1) m using (page_id)
"""
