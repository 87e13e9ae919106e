"""URL filter: rules first, then the ratio of two character models, in DataFrame expressions only.

Two smoothed variable-order Markov models are counted over the distinct URLs (host and path) that a rule allows and that
a rule blocks: each character given up to ORDER - 1 characters before it, shorter contexts mixed in by Witten-Bell
weights down to a uniform distribution over ALPHABET characters. A URL's score is the log-likelihood difference of the
two models per character. Three in sixteen rule-decided URLs (by md5) are kept from the counts and calibrate the bound: the
middle between the low QUANTILE of the scores of allowed URLs and the high one of blocked URLs, scores rounded to four
digits there, so that the quantiles are of counts of a bounded number of values. A URL that no rule
decides is allowed if its score reaches the bound.

Scale: counting is a partial aggregation over n-grams. The ratios of up to BROADCAST n-grams are broadcast, so the n-grams of a
URL meet their ratios where they are made, and one row for each URL is all that is shuffled; of more n-grams the join is a plain one, whose frequent
keys Spark splits at run time. Both give the same scores. Each distinct URL is scored once and joined back to its pages.

Cases: the path of "http://net" is empty and does not start with that of the rule "net/", which therefore does not fit; a
URL of any length is scored whole, a row for each character; a null URL and one without "://" have an empty host and path, which are scored like others; without an allowed
and a blocked URL to learn from, what no rule decides is allowed; repeated rows are each judged; other columns of pages are passed through, whatever their names, but for those of the names that are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reciprospark.llm.common import fresh, stored, table

RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
ORDER, ALPHABET, QUANTILE = 4, 256, 0.02
#: N-grams whose ratios are broadcast at most: some 20 MB.
BROADCAST = 200_000
#: URLs whose md5 begins with a lower hex digit calibrate.
HELD = "3"
_BEGIN, _END = "\x02", "\x03"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lowered(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return lowered(host), path


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):
        of, _, start = rule.partition("/")
        out = F.when(((host == of) | host.endswith("." + of)) & path.startswith("/" + start), F.lit(rule)).otherwise(out)
    return out


def ratios(grams: DataFrame) -> DataFrame:
    """The log ratio of both models for each n-gram. grams: gram (ORDER characters), good, bad (counts, 0 for unseen)."""
    before = None
    for n in range(1, ORDER + 1):
        own = grams.groupBy(F.substring("gram", ORDER + 1 - n, n).alias("g")).agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
        own = own.withColumn("context", F.substring("g", 1, n - 1))
        seen = own.groupBy("context").agg(*[f(c).alias(a) for c, k, t in (("good", "n_good", "t_good"), ("bad", "n_bad", "t_bad")) for f, a in ((F.sum, k), (lambda x: F.sum((F.col(x) > 0).cast("long")), t))])
        own = own.join(seen, "context")
        if before is None:
            own = own.withColumns({"q_good": F.lit(1.0 / ALPHABET), "q_bad": F.lit(1.0 / ALPHABET)})
        else:
            own = own.withColumn("shorter", F.substring("g", 2, n - 1)).join(before.select(F.col("g").alias("shorter"), F.col("p_good").alias("q_good"), F.col("p_bad").alias("q_bad")), "shorter")

        def mixed(c: str) -> Column:
            total = F.col(f"n_{c}") + F.col(f"t_{c}")
            return F.when(total == 0, F.col(f"q_{c}")).otherwise((F.col(c) + F.col(f"t_{c}") * F.col(f"q_{c}")) / F.greatest(total, F.lit(1)))

        before = own.select("g", mixed("good").alias("p_good"), mixed("bad").alias("p_bad"))
    return before.select(F.col("g").alias("gram"), (F.log("p_good") - F.log("p_bad")).alias("ratio"))


def scores(urls: DataFrame, broadcast: int = BROADCAST) -> DataFrame:
    """urls (key, verdict: of its rule or null; distinct keys) with score."""
    line = F.concat(F.lit(_BEGIN * (ORDER - 1)), F.col("key"), F.lit(_END))
    places = urls.select("key", "verdict", line.alias("line")).select("key", "verdict", "line", F.explode(F.sequence(F.lit(1), F.length("line") - (ORDER - 1))).alias("at"))
    places = places.select("key", F.expr(f"substring(line, at, {ORDER})").alias("gram"), F.when(learned_from(), F.col("verdict")).alias("learn"))
    grams = places.groupBy("gram").agg(*[F.sum((F.coalesce("learn", F.lit("")) == v).cast("long")).alias(c) for c, v in (("good", "allow"), ("bad", "block"))])
    of = stored(ratios(stored(grams, "grams")), "ratios")
    of = F.broadcast(of) if of.count() <= broadcast else of
    return places.select("key", "gram").join(of, "gram").groupBy("key").agg(F.round(F.avg("ratio"), 9).alias("score"))


def learned_from() -> Column:
    return F.substring(F.md5(F.col("key").cast("binary")), 1, 1) >= HELD


ADDED = ("host", "path", "rule", "score", "verdict")


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """pages with host, path, rule, score and verdict; columns with such names are replaced."""
    pages = pages.select(*[c for c in pages.columns if c.lower() not in ADDED])
    own = pages.columns
    host, path = host_and_path(F.col("url"))
    pages = pages.withColumn("host", host).withColumn("path", path)
    pages = pages.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules))
    by_rule = F.lit(None).cast("string")
    for rule, verdict in rules:
        by_rule = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(by_rule)
    key = F.concat("host", "path")
    urls = stored(pages.select(key.alias("key"), by_rule.alias("verdict")).groupBy("key").agg(F.first("verdict").alias("verdict")), "urls")
    found = stored(scores(urls), "scores")
    held = urls.join(found, "key").where(F.col("verdict").isNotNull() & ~learned_from())
    seen = urls.where(learned_from()).agg(*[F.count_if(F.col("verdict") == v).alias(v) for v in ("allow", "block")]).first()
    held = held.groupBy("verdict", F.round("score", 4).alias("score")).agg(F.count("*").alias("n"))
    at = held.agg(*[F.percentile(F.when(F.col("verdict") == v, F.col("score")), F.lit(q), F.col("n")).alias(v) for v, q in (("allow", QUANTILE), ("block", 1 - QUANTILE))]).first()
    ends = [x for x in (at.allow, at.block) if x is not None] or [0.0]
    bound = sum(ends) / len(ends) if seen.allow and seen.block else float("-inf")
    at_key = fresh("key", pages.columns)
    pages = pages.join(found.withColumnRenamed("key", at_key), key == F.col(at_key), "left")
    verdict = F.coalesce(by_rule, F.when(F.col("score") < F.lit(bound), F.lit("block")).otherwise(F.lit("allow")))
    return pages.select(*own, "host", "path", "rule", "score", verdict.alias("verdict"))


def op5_url_filter(spark, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "score")


def _oracle() -> str:
    rule = "null"
    for r, _ in sorted(RULES, key=lambda r: len(r[0])):
        of, _, start = r.partition("/")
        rule = f"case when (host = '{of}' or ends_with(host, '.{of}')) and starts_with(path, '/{start}') then '{r}' else {rule} end"
    verdict = "case " + " ".join(f"when rule = '{r}' then '{v}'" for r, v in RULES) + " end"
    steps, last = [], None
    for n in range(1, ORDER + 1):
        q = f"join p{n - 1} s on s.g = substr(o.g, 2)" if last else ""
        qa, qb = ("s.pa", "s.pb") if last else (f"1.0 / {ALPHABET}", f"1.0 / {ALPHABET}")
        steps.append(f"""o{n} as (select right(gram, {n}) as g, sum(a) as a, sum(b) as b from grams group by 1),
h{n} as (select left(g, {n - 1}) as c, sum(a) as na, sum(b) as nb, count(*) filter (a > 0) as ta, count(*) filter (b > 0) as tb from o{n} group by 1),
p{n} as (select o.g, case when na + ta = 0 then {qa} else (o.a + ta * {qa}) / (na + ta)::double end as pa, case when nb + tb = 0 then {qb} else (o.b + tb * {qb}) / (nb + tb)::double end as pb
from o{n} o join h{n} h on h.c = left(o.g, {n - 1}) {q}),""")
        last = n
    return rf"""
with u as (select page_id, case when position('://' in url) > 0 then substr(url, position('://' in url) + 3) else '' end as rest from pages),
hp as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_UPPER.lower()}') as host, regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') as path from u),
ru as (select *, {rule} as rule from hp),
k as (select distinct host || path as key, {verdict} as v from ru),
kc as (select *, left(md5(key), 1) >= '{HELD}' as learn from k),
pl as (select key, v, learn, substr(repeat(chr(2), {ORDER - 1}) || key || chr(3), unnest(range(1, length(key) + 2)), {ORDER}) as gram from kc),
grams as (select gram, count(*) filter (v = 'allow' and learn) as a, count(*) filter (v = 'block' and learn) as b from pl group by 1),
{chr(10).join(steps)}
sc as (select key, round(avg(ln(pa) - ln(pb)), 9) as score from pl join p{ORDER} on p{ORDER}.g = pl.gram group by key),
bd as (select case when (select count(*) from kc where learn and v = 'allow') > 0 and (select count(*) from kc where learn and v = 'block') > 0
    then (coalesce(qa, qb, 0) + coalesce(qb, qa, 0)) / 2 end as bound from (select quantile_cont(round(score, 4), {QUANTILE}) filter (v = 'allow') as qa, quantile_cont(round(score, 4), {1 - QUANTILE}) filter (v = 'block') as qb from sc join kc using (key) where not learn))
select page_id, host, path, rule, coalesce({verdict}, case when score < bound then 'block' else 'allow' end) as verdict, score
from ru left join sc on sc.key = host || path, bd
"""


ORACLE = _oracle()
