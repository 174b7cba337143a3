"""URL filter by rules and by an empirical-Bayes reputation of hosts.

Every page has an outcome, good or bad. A host's rate of bad pages is shrunk
towards its registered domain's rate, that towards its suffix's, and that
towards the overall rate, by beta-binomial priors whose strength is estimated
from the spread of the rates at each level (method of moments). A host is
blocked when the lower bound of its posterior exceeds a limit, so a host with
few pages is judged mostly by its relatives.

Domain and suffix come from the host's name, without user and port. Suffix rules
of several labels are a parameter; the longest that ends the name is its suffix,
else the last label, and the domain has one label more. An address is its own
domain and suffix. Outcomes are a parameter, too; by default a page is bad if
marks of one kind fill it.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from admesh.llm.tables import table
from admesh.storage import RunFolder

# Registry suffixes of several labels; any other suffix is a host's last label.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "co.nz", "com.br", "co.in")
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/"))
# A page is bad if marks of one kind take up this share of its code points.
MARKS = (("%%%", "###", "$$$", "***", "&amp;&amp;&amp;"), ("!!",), ("|",))
MARK_SHARE = 0.02
LIMIT = 0.2
Z = 1.645

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """The part after the first ``://`` up to ``/``, ``?`` or ``#``, A-Z lower-cased; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits as a struct ``rule, verdict``, or NULL."""
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, domain, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(start)
        found = F.struct(F.lit(domain + start).alias("rule"), F.lit(verdict).alias("verdict"))
        best = F.when(fits, found).otherwise(best)
    return best


def name_of(host: Column) -> Column:
    """The host without a user before ``@`` and a port after ``:``."""
    return F.regexp_replace(F.regexp_replace(host, r"(?s)^.*@", ""), r":[0-9]*\z", "")


def suffix_and_domain(host: Column, suffixes=SUFFIXES) -> Column:
    """The struct ``suffix, domain`` of a host, by the longest of the suffix rules that fits."""
    name = name_of(host)

    def last(labels):
        return F.substring_index(name, ".", -labels)

    def both(labels):
        return F.struct(last(labels).alias("suffix"), last(labels + 1).alias("domain"))
    out = both(1)
    for labels in sorted({s.count(".") + 1 for s in suffixes}):
        out = F.when(last(labels).isin(*(s for s in suffixes if s.count(".") + 1 == labels)), both(labels)).otherwise(out)
    address = name.rlike(r"^[0-9]+(\.[0-9]+){3}\z") | name.startswith("[")
    return F.when(address, F.struct(name.alias("suffix"), name.alias("domain"))).otherwise(out)


def is_bad(html: Column, marks=MARKS, share: float = MARK_SHARE) -> Column:
    """Whether marks of any one kind fill at least ``share`` of a page; a null page is good."""
    def without(kind):
        rest = html
        for mark in kind:
            rest = F.replace(rest, F.lit(mark), F.lit(""))
        return rest
    bad = F.lit(False)
    for kind in marks:
        bad = bad | (F.length(html) - F.length(without(kind)) >= F.length(html) * share)
    return F.coalesce(bad & (F.length(html) > 0), F.lit(False))


def _shrunk(both: DataFrame) -> DataFrame:
    """Counts ``n, k`` with the parent's rate ``p`` get the posterior ``rate`` and the prior's ``strength``.

    With intraclass correlation rho, the expected sum of ``n * (k / n - p)**2``
    over children is the sum of ``p * (1 - p) * (1 + (n - 1) * rho)``; rho solves
    that and the prior weighs ``1 / rho - 1`` pages. Sums are decimal, so they
    do not depend on the order of rows.
    """
    def total(value: Column) -> Column:
        return F.sum(F.round(value, 9).cast("decimal(38,9)")).cast("double")
    spread = total(F.col("n") * F.pow(F.col("k") / F.col("n") - F.col("p"), 2) - F.col("p") * (1 - F.col("p")))
    room = total(F.col("p") * (1 - F.col("p")) * (F.col("n") - 1))
    rho = F.least(F.lit(0.5), F.greatest(F.lit(0.0001), F.coalesce(spread / F.nullif(room, F.lit(0.0)), F.lit(0.0))))
    strength = both.agg((1 / rho - 1).alias("strength")).scalar()
    return both.withColumn("strength", strength).withColumn(
        "rate", (F.col("k") + F.col("strength") * F.col("p")) / (F.col("n") + F.col("strength")))


def reputation(outcomes: DataFrame, run: RunFolder, limit: float = LIMIT, z: float = Z, suffixes=SUFFIXES) -> DataFrame:
    """``host, n, k, rate, bound, verdict`` from page outcomes ``host, bad``.

    ``n`` pages, ``k`` of them bad, posterior mean and lower bound of the bad
    rate (normal approximation of the posterior beta). A null host or outcome
    counts as empty or good. No outcome gives no rows.
    """
    host = F.coalesce("host", F.lit(""))
    hosts = run.write(
        outcomes.groupBy(host.alias("host"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce("bad", F.lit(False))).alias("k"))
        .withColumn("names", suffix_and_domain(F.col("host"), suffixes)).select("host", "n", "k", "names.*"), "hosts")

    def level(*keys):
        return hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    overall = hosts.agg(F.sum("k") / F.sum("n")).scalar()

    def under(children, parents, parent):
        return children.join(parents.select(parent, F.col("rate").alias("p")), parent)
    suffixes = _shrunk(level("suffix").withColumn("p", overall))
    domains = _shrunk(under(level("domain", "suffix"), suffixes, "suffix"))
    known = _shrunk(under(hosts, domains, "domain"))
    deviation = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n") + F.col("strength") + 1))
    return (
        known.withColumn("bound", F.col("rate") - z * deviation)
        .select("host", "n", "k", "rate", "bound",
                F.when(F.col("bound") > limit, "block").otherwise("allow").alias("verdict"))
    )


def judge_urls(pages: DataFrame, run: RunFolder, rules=RULES, limit: float = LIMIT, suffixes=SUFFIXES,
               bad: Column | None = None) -> DataFrame:
    """Judge each of ``page_id, url, html``: ``page_id, host, path, rule, verdict, bound``.

    ``bad`` is the outcome of a page as an expression over ``pages``, such as a
    classifier's verdict; without it marks in ``html`` decide, see ``is_bad``.
    One row per input row, repeated rows included. A null url, or one without
    ``://``, has an empty host and path and is judged by the reputation of the
    empty host. Other columns are ignored.
    """
    judged = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    outcome = is_bad(F.col("html")) if bad is None else bad
    outcomes = pages.select(host_of(F.col("url")).alias("host"), outcome.alias("bad"))
    known = reputation(outcomes, run, limit, suffixes=suffixes).select("host", "bound", F.col("verdict").alias("method"))
    return (
        judged.join(known, "host", "left")
        .withColumn("best", matching_rule(F.col("host"), F.col("path"), rules))
        .select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                F.coalesce("best.verdict", "method").alias("verdict"), F.round("bound", 6).alias("bound"))
    )


def op5_host_reputation(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's url judged by the rules and by its host's reputation."""
    return judge_urls(table(spark, folder, "pages"), RunFolder(spark))


def _level_sql(name: str, children: str, parents: str, parent: str) -> str:
    return f"""
    {name}_0 AS (SELECT c.*, p.rate AS p FROM {children} c JOIN {parents} p USING ({parent})),
    {name}_1 AS (SELECT 1 / least(0.5, greatest(0.0001, coalesce(
            CAST(sum(CAST(round(n * pow(k / n - p, 2) - p * (1 - p), 9) AS DECIMAL(38, 9))) AS DOUBLE)
            / nullif(CAST(sum(CAST(round(p * (1 - p) * (n - 1), 9) AS DECIMAL(38, 9))) AS DOUBLE), 0), 0))) - 1
        AS strength FROM {name}_0),
    {name} AS (SELECT c.*, strength, (k + strength * p) / (n + strength) AS rate FROM {name}_0 c, {name}_1)"""


ORACLE = r"""
WITH urls AS (
    SELECT page_id, html, url, strpos(coalesce(url, ''), '://') AS cut FROM pages),
split AS (
    SELECT page_id, html,
           CASE WHEN cut = 0 THEN '' ELSE translate(regexp_extract(substr(url, cut + 3), '^[^/?#]*'),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END AS host,
           CASE WHEN cut = 0 THEN '' ELSE regexp_extract(substr(url, cut + 3), '^[^/?#]*([^?#]*)', 1) END AS path
    FROM urls),
outcomes AS (
    SELECT host, coalesce(length(html) > 0 AND (
        length(html) - length(replace(replace(replace(replace(replace(html, '%%%', ''), '###', ''),
            '$$$', ''), '***', ''), '&amp;&amp;&amp;', '')) >= length(html) * 0.02
        OR length(html) - length(replace(html, '!!', '')) >= length(html) * 0.02
        OR length(html) - length(replace(html, '|', '')) >= length(html) * 0.02), false) AS bad
    FROM split),
counts AS (
    SELECT host, count(*)::DOUBLE AS n, count(*) FILTER (bad)::DOUBLE AS k,
           regexp_replace(regexp_replace(host, '(?s)^.*@', ''), ':[0-9]*\z', '') AS name FROM outcomes GROUP BY host),
labels_of AS (
    SELECT *, string_split(name, '.') AS parts, array_to_string(string_split(name, '.')[-2:], '.') AS two,
           regexp_matches(name, '^[0-9]+(\.[0-9]+){3}\z') OR starts_with(name, '[') AS address FROM counts),
hosts AS (
    SELECT host, n, k,
           CASE WHEN address THEN name WHEN two IN ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'co.jp', 'co.nz', 'com.br', 'co.in') THEN array_to_string(parts[-3:], '.') ELSE two END AS domain,
           CASE WHEN address THEN name WHEN two IN ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'co.jp', 'co.nz', 'com.br', 'co.in') THEN two ELSE parts[-1] END AS suffix FROM labels_of),
root AS (SELECT 1 AS root, sum(k) / sum(n) AS rate FROM hosts),
suffix_counts AS (SELECT suffix, 1 AS root, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY suffix),
domain_counts AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY ALL),
""" + ",".join([_level_sql("suffix_rates", "suffix_counts", "root", "root"),
                _level_sql("domain_rates", "domain_counts", "suffix_rates", "suffix"),
                _level_sql("host_rates", "hosts", "domain_rates", "domain")]) + r""",
bounds AS (
    SELECT host, rate - 1.645 * sqrt(rate * (1 - rate) / (n + strength + 1)) AS bound FROM host_rates),
rules(verdict, domain, start) AS (
    VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'),
           ('allow', 'org', '/fr/')),
fits AS (
    SELECT page_id, arg_max(domain || start, length(domain || start)) AS rule,
           arg_max(verdict, length(domain || start)) AS verdict
    FROM split JOIN rules ON (host = domain OR ends_with(host, '.' || domain)) AND starts_with(path, start)
    GROUP BY page_id)
SELECT s.page_id, s.host, s.path, f.rule,
       coalesce(f.verdict, CASE WHEN b.bound > 0.2 THEN 'block' ELSE 'allow' END) AS verdict,
       round(b.bound, 6) AS bound
FROM split s JOIN bounds b USING (host) LEFT JOIN fits f USING (page_id)
"""
