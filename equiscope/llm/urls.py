"""URL filter: written rules first, empirical-Bayes host reputation for the rest.

Reputation.  Labelled pages give each host a count of pages and of bad ones.
Bad rates are shrunk down a tree: corpus -> public suffix -> registered domain
-> host.  At each level the prior of a node is a beta distribution whose mean
is the posterior mean of its parent and whose strength is one number for the
level, estimated from all its nodes by moments: with parent mean m, a node of
n pages and k bad ones has, under a beta-binomial law, an expected squared
deviation ``n m (1 - m) (1 + (n - 1) rho)``, which is solved for ``rho``; the
strength is ``1 / rho - 1``.  A url is blocked when the lower posterior bound
of its host's bad rate (mean minus ``BOUND_SDS`` standard deviations of the
beta posterior) is over ``BLOCK_OVER``.  A host without labelled pages has its
registered domain's posterior as prior, and so on up.

Rules.  A rule is a host, a path prefix and a verdict; it fits its host and
all subdomains where the url's path starts with the prefix.  The longest rule
string that fits decides (of equal lengths, the longer host; then block).

Host and path: from the first ``://`` up to ``/``, ``?``, ``#`` or the end,
A-Z lower-cased; then up to ``?``, ``#`` or the end.

Defined results: a null url, or one without ``://``, has an empty host and
path, fits no rule and is judged by the corpus posterior; repeated pages are
judged alike, and each of their labels counts; null labels do not count;
without labels nothing is blocked by reputation; an empty table gives an
empty result.  All counts are pre-aggregated sums, so a host with a third of
all pages is one row after the map side; the join back to the pages is a
plain equi-join, whose skew Spark splits.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from equiscope.llm.rows import cut_lineage, read

BOUND_SDS = 1.645
BLOCK_OVER = 0.25
#: Strength limits of the priors (in pages), and the strength where a level
#: shows no spread that could be estimated.
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1000.0

# Public suffixes of two labels; any other suffix is one label.
TWO_LABEL_SUFFIXES = [
    "ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.cn", "com.mx",
    "com.tr", "com.tw", "gov.uk", "ne.jp", "net.au", "or.jp", "org.au", "org.uk",
]


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    allow: bool

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = [
    Rule("org", "/", True),
    Rule("example.org", "/es/", False),
    Rule("example.org", "/en/1", False),
    Rule("com", "/fr/", True),
    Rule("com", "/de/", False),
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def deciding_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct (rule, allow) of the rule that decides, else null."""
    first = sorted(rules, key=lambda r: (-len(r.text), -len(r.host), r.allow))
    out = F.lit(None).cast("struct<rule:string,allow:boolean>")
    for r in reversed(first):
        fits = ((host == r.host) | F.endswith(host, F.lit(f".{r.host}"))) & F.startswith(path, F.lit(r.path))
        out = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.allow).alias("allow"))).otherwise(out)
    return out


def levels(host: Column) -> tuple[Column, Column]:
    """(public suffix, registered domain) of a host; the port does not count,
    and an address in digits is its own domain."""
    name = F.regexp_replace(host, ":[0-9]*$", "")
    labels = F.split(name, r"\.")
    n = F.size(labels)
    last_two = F.array_join(F.slice(labels, F.greatest(n - 1, F.lit(1)), 2), ".")
    wide = (n > 1) & last_two.isin(TWO_LABEL_SUFFIXES)
    digits = name.rlike(r"^[0-9.]+$")
    suffix = F.when(digits, "").when(wide, last_two).otherwise(F.element_at(labels, -1))
    size = F.when(wide, 3).otherwise(2)
    domain = F.when(digits, name).otherwise(
        F.array_join(F.slice(labels, F.greatest(n - size + 1, F.lit(1)), size), ".")
    )
    return suffix, domain


def domain_key(suffix: Column, domain: Column) -> Column:
    """The suffix belongs to the key: the host 3.4 (no suffix) and the domain
    3.4 of x.3.4 differ."""
    return F.concat(domain, F.lit("/"), suffix)


def _posteriors(nodes: DataFrame, parents: DataFrame | None, key: str, parent: str | None) -> DataFrame:
    """(key, n, mean, a, b): each node's beta posterior under its parent's
    mean.  ``parents`` None: the corpus, with a flat prior."""
    if parents is None:
        a, b = F.col("k") + 1.0, F.col("n") - F.col("k") + 1.0
        return nodes.select(key, "n", a.alias("a"), b.alias("b"), (a / (a + b)).alias("mean"))
    means = parents.select(F.col(parent), F.col("mean").alias("m"))
    with_m = nodes.join(F.broadcast(means) if parent == "corpus" else means, parent)  # the corpus is one row
    n, k, m = F.col("n"), F.col("k"), F.col("m")
    spread = m * (1 - m)
    over = F.sum(F.pow(k - n * m, 2) - n * spread)
    room = F.sum(n * (n - 1) * spread)
    rho = with_m.agg(F.when(room > 0, over / room).alias("rho"))
    least, most = 1 / (MOST_STRENGTH + 1), 1 / (LEAST_STRENGTH + 1)
    bounded = F.coalesce(F.greatest(F.least("rho", F.lit(most)), F.lit(least)), F.lit(least))
    strength = rho.select((1 / bounded - 1).alias("strength"))  # one row
    s = F.col("strength")
    a, b = s * m + k, s * (1 - m) + n - k
    return with_m.join(F.broadcast(strength)).select(key, "n", a.alias("a"), b.alias("b"), (a / (a + b)).alias("mean"), "m", "strength")


def reputation(outcomes: DataFrame) -> dict[str, DataFrame]:
    """(host, bad boolean) of labelled pages -> posteriors by level.

    Written to the shared folder: one row per labelled host, domain, suffix."""
    suffix, domain = levels(F.col("host"))
    hosts = cut_lineage(
        outcomes.filter("bad is not null").groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("long")).alias("k"))
        .select("host", domain_key(suffix, domain).alias("domain"), suffix.alias("suffix"), F.lit(0).alias("corpus"), "n", "k")
    )
    total = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    corpus = _posteriors(hosts.groupBy("corpus").agg(*total), None, "corpus", None)
    by_suffix = _posteriors(hosts.groupBy("suffix", "corpus").agg(*total), corpus, "suffix", "corpus")
    by_domain = _posteriors(hosts.groupBy("domain", "suffix").agg(*total), by_suffix, "domain", "suffix")
    by_host = _posteriors(hosts, by_domain, "host", "domain")
    return {"corpus": cut_lineage(corpus), "suffix": cut_lineage(by_suffix), "domain": cut_lineage(by_domain), "host": cut_lineage(by_host)}


def lower_bound(a: Column, b: Column) -> Column:
    total = a + b
    return a / total - F.lit(BOUND_SDS) * F.sqrt(a * b / (total * total * (total + 1)))


def judge(pages: DataFrame, outcomes: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """``pages`` (in a struct ``row``) with host, path, rule, verdict,
    n_labelled (of the nearest level that has labels) and bad_bound."""
    host, path = host_and_path(F.col("row").getField(url))
    out = pages.select(F.struct(*[pages[f"`{c}`"] for c in pages.columns]).alias("row"))
    out = out.withColumns({"host": host, "path": path})
    suffix, domain = levels(F.col("host"))
    names = out.groupBy("host").agg(F.lit(1).alias("one")).select("host", domain_key(suffix, domain).alias("domain"), suffix.alias("suffix"), F.lit(0).alias("corpus"))
    found = names
    by = reputation(outcomes)
    for level in ("host", "domain", "suffix", "corpus"):
        at = by[level].select(level, F.struct("a", "b", "n").alias(f"at_{level}"))
        found = found.join(F.broadcast(at) if level == "corpus" else at, level, "left")  # the corpus is one row
    best = F.coalesce("at_host", "at_domain", "at_suffix", "at_corpus")
    bounds = found.select("host", best.getField("n").alias("n_labelled"), lower_bound(best.getField("a"), best.getField("b")).alias("bad_bound"))
    ruled = out.withColumn("decides", deciding_rule(F.col("host"), F.col("path"), rules))
    allowed = F.coalesce(F.col("decides").getField("allow"), F.coalesce(F.col("bad_bound"), F.lit(0.0)) <= BLOCK_OVER)
    return ruled.join(bounds, "host", "left").select(
        "row", "host", "path", F.col("decides").getField("rule").alias("rule"),
        F.when(allowed, "allow").otherwise("block").alias("verdict"),
        F.coalesce("n_labelled", F.lit(0)).cast("long").alias("n_labelled"),
        F.round(F.coalesce("bad_bound", F.lit(0.0)), 6).alias("bad_bound"),
    )


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page is labelled by the row of ``labels`` with its id; it is bad if
    its quality is 0."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    labels = read(spark, sf_dir, "labels").filter("doc_id is not null and quality is not null")
    host, _ = host_and_path(F.col("url"))
    outcomes = pages.join(labels.select("doc_id", (F.col("quality") == 0).alias("bad")), F.col("page_id") == F.col("doc_id"))
    judged = judge(pages, outcomes.select(host.alias("host"), "bad"), RULES)
    return judged.select("row.page_id", "host", "path", "rule", "verdict", "n_labelled", "bad_bound")


_RULE_CASES = " ".join(
    f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') "
    f"THEN '{r.text}:{'allow' if r.allow else 'block'}'"
    for r in sorted(RULES, key=lambda r: (-len(r.text), -len(r.host), r.allow))
)


def _level_sql(name: str, nodes: str, parents: str, key: str, parent: str) -> str:
    """DuckDB text of one level of the shrinkage."""
    least, most = 1 / (MOST_STRENGTH + 1), 1 / (LEAST_STRENGTH + 1)
    return f"""
{name}_m AS (SELECT t.*, p.mean AS m FROM {nodes} t JOIN {parents} p USING ({parent})),
{name}_s AS (SELECT 1 / coalesce(greatest(least(CASE WHEN sum(n * (n - 1) * m * (1 - m)) > 0 THEN
    sum(pow(k - n * m, 2) - n * m * (1 - m)) / sum(n * (n - 1) * m * (1 - m)) END, {most}), {least}), {least}) - 1 AS s FROM {name}_m),
{name}_p AS (SELECT {key}, n, s * m + k AS a, s * (1 - m) + n - k AS b,
    (s * m + k) / (s + n) AS mean FROM {name}_m, {name}_s)"""


ORACLE_SQL = f"""
WITH rest AS (SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
cut AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS h FROM rest),
parsed AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM cut),
named AS (SELECT *, regexp_replace(host, ':[0-9]*$', '') AS name FROM parsed),
split AS (SELECT *, string_split(name, '.') AS l, len(string_split(name, '.')) AS c,
    regexp_matches(name, '^[0-9.]+$') AS digits FROM named),
wide AS (SELECT *, c > 1 AND array_to_string(l[greatest(c - 1, 1):c], '.') IN ({", ".join(repr(s) for s in TWO_LABEL_SUFFIXES)}) AS w FROM split),
leveled AS (SELECT page_id, host, path,
    CASE WHEN digits THEN name ELSE array_to_string(l[greatest(c - (CASE WHEN w THEN 3 ELSE 2 END) + 1, 1):c], '.') END || '/' ||
        CASE WHEN digits THEN '' WHEN w THEN array_to_string(l[greatest(c - 1, 1):c], '.') ELSE l[c] END AS domain,
    CASE WHEN digits THEN '' WHEN w THEN array_to_string(l[c - 1:c], '.') ELSE l[c] END AS suffix, 0 AS corpus FROM wide),
hosts AS (SELECT host, domain, suffix, corpus, count(*)::DOUBLE AS n, sum(CASE WHEN quality = 0 THEN 1 ELSE 0 END)::DOUBLE AS k
    FROM leveled JOIN labels ON page_id = doc_id WHERE quality IS NOT NULL GROUP BY ALL),
corpus_p AS (SELECT corpus, sum(n) AS n, sum(k) + 1 AS a, sum(n) - sum(k) + 1 AS b, (sum(k) + 1) / (sum(n) + 2) AS mean FROM hosts GROUP BY corpus),
suffixes AS (SELECT suffix, corpus, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY ALL),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY ALL),
{_level_sql("suffix", "suffixes", "corpus_p", "suffix", "corpus")},
{_level_sql("domain", "domains", "suffix_p", "domain", "suffix")},
{_level_sql("host", "hosts", "domain_p", "host", "domain")},
best AS (SELECT page_id, host, path, coalesce(h.n, d.n, s.n, c.n) AS n,
    CASE WHEN h.n IS NOT NULL THEN h.a WHEN d.n IS NOT NULL THEN d.a WHEN s.n IS NOT NULL THEN s.a ELSE c.a END AS a,
    CASE WHEN h.n IS NOT NULL THEN h.b WHEN d.n IS NOT NULL THEN d.b WHEN s.n IS NOT NULL THEN s.b ELSE c.b END AS b
    FROM leveled LEFT JOIN host_p h USING (host) LEFT JOIN domain_p d USING (domain)
    LEFT JOIN suffix_p s USING (suffix) LEFT JOIN corpus_p c USING (corpus)),
bounded AS (SELECT *, coalesce(a / (a + b) - {BOUND_SDS} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))), 0.0) AS bound,
    CASE {_RULE_CASES} END AS decides FROM best)
SELECT page_id, host, path, string_split(decides, ':')[1] AS rule,
    coalesce(string_split(decides, ':')[2], CASE WHEN bound <= {BLOCK_OVER} THEN 'allow' ELSE 'block' END) AS verdict,
    coalesce(n, 0)::BIGINT AS n_labelled, round(bound, 6) AS bad_bound
FROM bounded
"""
