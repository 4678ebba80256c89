"""Url filtering by empirical-Bayes host reputation, in DataFrame operations only.

Labelled pages are outcomes, good or bad, of their host. A host's good share is shrunk towards that of its
registered domain, that one's towards its suffix, that one's towards all pages: each is the mean of a
beta posterior whose prior has the parent's mean and a weight that the spread between the siblings
tells (method of moments on their binomial counts; one weight a level). A page passes if the lower
posterior bound of its host, mean - Z standard deviations, reaches ``THRESHOLD``. Rules, where they fit, decide
before the reputation. A host nobody has labelled has its domain's posterior, and so on up.

A registered domain is one label more than its suffix. A suffix is the longest of ``suffixes`` (such as co.uk) that the host ends with,
else its last label; without that list all hosts under a suffix of two labels share one domain, which only makes their prior coarser.

The host is what lies between the first :// and the next /, ? or #, with A-Z lower-cased; the path runs from there to ? or #.
Null urls and those without :// have an empty host and path; they are a host of their own. Repeated rows each get a verdict. Null
outcomes count as none. Without any outcome every mean is one half. Other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.session import cut

Z = 1.645
THRESHOLD = 0.5
#: (host, path, verdict)
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def _rest(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.expr("substr(url, instr(url, '://') + 3)")).otherwise(F.lit(""))


def with_host(pages: DataFrame, suffixes: tuple[str, ...] = ()) -> DataFrame:
    """page_id, url, host, path, domain (a label more than the suffix), suffix (of the list, else the last label)."""
    rest = F.coalesce(_rest(F.col("url")), F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = pages.select("page_id", "url").withColumns({"host": host, "path": F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)})
    listed = [(F.endswith(F.col("host"), F.lit(f".{x}")) | (F.col("host") == x), x) for x in sorted(suffixes, key=lambda x: (-x.count("."), x))]
    suffix = F.coalesce(*[F.when(fits, x) for fits, x in listed], F.substring_index("host", ".", -1))
    domain = F.coalesce(*[F.when(fits, F.substring_index("host", ".", -x.count(".") - 2)) for fits, x in listed], F.substring_index("host", ".", -2))
    return out.withColumns({"domain": domain, "suffix": suffix})


def rule_for(rules: list[tuple[str, str, str]]) -> Column:
    """The longest fitting rule as a struct (rule, verdict), or null."""
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    known = F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")) for h, p, v in ordered])

    def fits(r: Column) -> Column:
        return ((F.col("host") == r.host) | F.endswith(F.col("host"), F.concat(F.lit("."), r.host))) & F.startswith(F.col("path"), r.path)

    return F.get(F.filter(known, fits), 0) if rules else F.lit(None).cast("struct<rule:string,verdict:string>")


def _weight(table: DataFrame, mean: str) -> float:
    """Weight of a level's prior from the overdispersion of its members' counts around the parent's mean."""
    v = F.greatest(F.col(mean) * (1 - F.col(mean)), F.lit(1e-9))
    row = table.where("n > 0").agg(
        F.sum(F.pow(F.col("k") - F.col("n") * F.col(mean), 2) - F.col("n") * v).alias("over"), F.sum(F.col("n") * (F.col("n") - 1) * v).alias("pairs")
    ).first()
    rho = (row.over or 0.0) / row.pairs if row.pairs else 0.0
    return 1 / min(max(rho, 1e-3), 0.999) - 1


def host_reputation(pages: DataFrame, outcomes: DataFrame, z: float = Z, suffixes: tuple[str, ...] = ()) -> DataFrame:
    """A row per host of pages: host, k good of n labelled pages, mean, bound."""
    seen = with_host(pages, suffixes)
    good = outcomes.where("good is not null").groupBy("page_id").agg(F.min(F.col("good").cast("int")).alias("good"))
    # Counted per host before anything else, so a host with a third of all pages is one row.
    # They are read for every level's weight, so the pages are joined with their outcomes only once.
    counts = cut(
        seen.join(good, "page_id", "left").groupBy("host", "domain", "suffix").agg(F.sum(F.coalesce("good", F.lit(0))).alias("k"), F.count("good").alias("n"))
    )
    by_domain = counts.groupBy("domain", "suffix").agg(F.sum("k").alias("k"), F.sum("n").alias("n"))
    by_suffix = by_domain.groupBy("suffix").agg(F.sum("k").alias("k"), F.sum("n").alias("n"))
    every = by_suffix.agg(F.sum("k").alias("k"), F.sum("n").alias("n")).first()
    m0 = ((every.k or 0) + 1) / ((every.n or 0) + 2)

    def posterior(table: DataFrame, parent: str, name: str) -> tuple[DataFrame, float]:
        w = _weight(table, parent)
        return table.withColumn(name, (F.col("k") + w * F.col(parent)) / (F.col("n") + w)), w

    by_suffix, _ = posterior(by_suffix.withColumn("m0", F.lit(m0)), "m0", "m1")
    by_domain, _ = posterior(by_domain.join(by_suffix.select("suffix", "m1"), "suffix"), "m1", "m2")
    by_host, w = posterior(counts.join(by_domain.select("domain", "suffix", "m2"), ["domain", "suffix"]), "m2", "mean")
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + w + 1))
    return by_host.select("host", "k", "n", "mean", (F.col("mean") - z * deviation).alias("bound"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str, str]] = RULES, z: float = Z, threshold: float = THRESHOLD, suffixes: tuple[str, ...] = ()) -> DataFrame:
    """A row per row of pages: page_id, host, path, rule, verdict."""
    bound = host_reputation(pages, outcomes, z, suffixes).select(F.col("host").alias("h"), "bound")
    judged = with_host(pages).withColumn("r", rule_for(rules)).join(bound, F.col("host") == F.col("h"), "left")
    own = F.when(F.col("bound") >= threshold, "allow").otherwise("block")
    return judged.select("page_id", "host", "path", F.col("r.rule").alias("rule"), F.coalesce("r.verdict", own).alias("verdict"))


def outcomes_by_document(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Outcomes of pages whose url's path names a labelled document by number: good is quality 1 and not toxic."""
    number = F.expr("try_cast(regexp_extract(path, '/([0-9]+)', 1) as bigint)")
    named = with_host(pages).select("page_id", number.alias("doc_id")).where("doc_id is not null")
    known = labels.where("quality is not null and toxic is not null").groupBy("doc_id").agg(F.bool_and((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good"))
    return named.join(known, "doc_id").select("page_id", "good")


#: The same in DuckDB's SQL, with the default rules and thresholds.
ORACLE = r"""
WITH p AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM p),
s AS (SELECT *, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS domain, string_split(host, '.')[-1] AS suffix FROM h),
l AS (SELECT doc_id, bool_and(quality = 1 AND toxic = 0) AS good FROM labels WHERE quality IS NOT NULL AND toxic IS NOT NULL GROUP BY doc_id),
o AS (SELECT s.page_id, min(l.good::INT) AS good FROM s JOIN l ON l.doc_id = TRY_CAST(regexp_extract(path, '/([0-9]+)', 1) AS BIGINT) GROUP BY s.page_id),
c AS (SELECT host, domain, suffix, sum(coalesce(good, 0))::DOUBLE AS k, count(good)::DOUBLE AS n FROM s LEFT JOIN o USING (page_id) GROUP BY ALL),
d AS (SELECT domain, suffix, sum(k) AS k, sum(n) AS n FROM c GROUP BY ALL),
f AS (SELECT suffix, sum(k) AS k, sum(n) AS n, (SELECT (sum(k) + 1) / (sum(n) + 2) FROM c) AS m0 FROM d GROUP BY suffix),
wf AS (SELECT 1 / least(greatest(coalesce(sum((k - n * m0) ** 2 - n * greatest(m0 * (1 - m0), 1e-9)) / nullif(sum(n * (n - 1) * greatest(m0 * (1 - m0), 1e-9)), 0), 0), 1e-3), 0.999) - 1 AS w FROM f WHERE n > 0),
f1 AS (SELECT f.*, (k + w * m0) / (n + w) AS m1 FROM f, wf),
d1 AS (SELECT d.*, m1 FROM d JOIN f1 USING (suffix)),
wd AS (SELECT 1 / least(greatest(coalesce(sum((k - n * m1) ** 2 - n * greatest(m1 * (1 - m1), 1e-9)) / nullif(sum(n * (n - 1) * greatest(m1 * (1 - m1), 1e-9)), 0), 0), 1e-3), 0.999) - 1 AS w FROM d1 WHERE n > 0),
d2 AS (SELECT d1.*, (k + w * m1) / (n + w) AS m2 FROM d1, wd),
c1 AS (SELECT c.*, m2 FROM c JOIN d2 USING (domain, suffix)),
wc AS (SELECT 1 / least(greatest(coalesce(sum((k - n * m2) ** 2 - n * greatest(m2 * (1 - m2), 1e-9)) / nullif(sum(n * (n - 1) * greatest(m2 * (1 - m2), 1e-9)), 0), 0), 1e-3), 0.999) - 1 AS w FROM c1 WHERE n > 0),
c2 AS (SELECT c1.*, w, (k + w * m2) / (n + w) AS mean FROM c1, wc),
b AS (SELECT host, mean - 1.645 * sqrt(mean * (1 - mean) / (n + w + 1)) AS bound FROM c2),
r(rhost, rpath, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
x AS (SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(v, length(rhost || rpath)) AS v
  FROM s JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id)
SELECT s.page_id, s.host, s.path, x.rule, coalesce(x.v, CASE WHEN b.bound >= 0.5 THEN 'allow' ELSE 'block' END) AS verdict
FROM s LEFT JOIN x USING (page_id) LEFT JOIN b ON b.host = s.host
"""
