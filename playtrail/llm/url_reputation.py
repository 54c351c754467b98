"""URL filters: rules first, then an empirical-Bayes reputation of the host.

A page whose url fits a rule takes the verdict of the longest one. Every other
page is judged by its host. Labelled page outcomes (bad or not) are counted per
host, and the counts are shrunk through beta-binomial priors along
host -> registered domain -> suffix -> all pages: the mean of a level is the
prior mean of the level below, and the strength of that prior follows from how
much the level's groups differ beyond chance (method of moments). A host is
blocked when the lower posterior bound of its share of bad pages passes
``max_bad``; a host without labelled pages is judged by its domain's mean.

Built-in functions only. Pages are counted per host before anything is
shuffled; the reputation comes back by a broadcast whose rows and bytes are
checked, or else by a join on (host, salt) in which a hot host's row is
repeated once per ``HOT_PAGES`` pages.

Defined results: a url that is null or has no ``://`` has the empty host and
path, fits no rule and is judged as the host ``''``; user names and ports belong
to ``host`` but not to the name a reputation is kept for; a page without a
label counts for nothing; several labels of a page count as one, bad if any is;
repeated rows are judged one by one; without any label every mean is 1/2 and
nothing is blocked; an empty table gives no rows; extra columns of either table
are not read; a null page id is carried and has no label.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtrail.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Public suffixes of two labels; any other suffix is the last label.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br",
                      "com.cn", "com.mx", "com.tr", "gov.uk", "ne.jp", "net.au", "or.jp", "org.au", "org.uk")

MAX_BAD = 0.5            # share of bad pages that the lower bound must pass
Z = 1.6448536269514722   # one-sided 95 % point of the normal distribution
STRENGTH = (1.0, 1e6)    # bounds of a prior's strength, in pages
LOOKUP_ROWS, LOOKUP_BYTES = 100_000, 32 << 20
HOT_PAGES = 1_000_000


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, where the path starts with ``path``."""
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the task.
RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
         Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    u = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substr(u, at + F.lit(3))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"\A[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)


def name_parts(host: Column) -> tuple[Column, Column, Column]:
    """Name (no user, no port), registered domain and suffix of a host."""
    name = F.regexp_replace(F.regexp_replace(host, r"(?s)\A.*@", ""), r":[0-9]*\z", "")
    two, three = F.substring_index(name, ".", -2), F.substring_index(name, ".", -3)
    paired = two.isin(*TWO_LABEL_SUFFIXES)
    number = name.rlike(r"\A[0-9.]+\z")
    suffix = F.when(number, F.lit("#")).when(paired, two).otherwise(F.substring_index(name, ".", -1))
    return name, F.when(number, name).when(paired, three).otherwise(two), suffix


def fits(rule: Rule) -> Column:
    """True where ``rule`` fits the columns ``host`` and ``path``."""
    under = (F.col("host") == rule.host) | F.endswith("host", F.lit("." + rule.host))
    return under & F.startswith("path", F.lit(rule.path))


def longest_rule(rules: tuple[Rule, ...], value: str) -> Column:
    """``value`` (``name`` or ``verdict``) of the longest rule that fits, else null.
    ``rules`` is a short list that the caller writes down."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        out = F.when(fits(rule), F.lit(getattr(rule, value))).otherwise(out)
    return out


def _mean(prior: str | float, strength: float) -> Column:
    prior = F.col(prior) if isinstance(prior, str) else F.lit(prior)
    return (F.col("bad") + F.lit(strength) * prior) / (F.col("n") + F.lit(strength))


def _strength(df: DataFrame, prior: Column) -> float:
    """Strength of the beta prior of groups with counts ``n``, ``bad`` and prior
    means ``prior``. Beyond the binomial part, squared deviations grow with
    n (n - 1) times the intraclass correlation rho, and strength = 1 / rho - 1."""
    var = prior * (1 - prior)
    over = F.sum(F.pow(F.col("bad") - F.col("n") * prior, F.lit(2.0)) - F.col("n") * var)
    rho = df.agg((over / F.nullif(F.sum(F.col("n") * (F.col("n") - 1) * var), F.lit(0.0))).alias("rho")).first()["rho"]
    low, high = STRENGTH
    if rho is None or rho <= 1 / (high + 1):
        return high
    return min(high, max(low, 1 / rho - 1))


def host_reputation(hosts: DataFrame) -> DataFrame:
    """Posterior of every host name. ``hosts`` has one row per ``name`` with its
    ``domain``, ``suffix``, ``pages``, ``n`` (labelled pages) and ``bad``. Adds
    ``mean`` and ``bound``, the lower bound of the share of bad pages. Only the
    overall share and the three strengths pass the driver."""
    counts = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    total = hosts.agg(*counts).first()
    m0 = ((total["bad"] or 0) + 1) / ((total["n"] or 0) + 2)
    domains = materialize(hosts.groupBy("domain", "suffix").agg(*counts), "url-domains")
    suffixes = materialize(domains.groupBy("suffix").agg(*counts), "url-suffixes")
    suffixes = suffixes.select("suffix", _mean(m0, _strength(suffixes, F.lit(m0))).alias("m1"))
    domains = materialize(domains.join(suffixes, "suffix"), "url-domain-priors")
    domains = domains.select("domain", "suffix", _mean("m1", _strength(domains, F.col("m1"))).alias("m2"))
    hosts = materialize(hosts.join(domains, ["domain", "suffix"]), "url-host-priors")
    k = _strength(hosts, F.col("m2"))
    hosts = hosts.withColumn("mean", _mean("m2", k))
    spread = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + F.lit(k) + 1))
    return hosts.withColumn("bound", F.col("mean") - F.lit(Z) * spread)


def _with_reputation(pages: DataFrame, rep: DataFrame) -> DataFrame:
    """``mean``, ``bound`` and ``n`` of each page's host name."""
    size = rep.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.octet_length("name") + 64), F.lit(0)).alias("bytes")).first()
    found = rep.select(F.col("name").alias("rep_name"), "n", "mean", "bound", "pages")
    if size["rows"] <= LOOKUP_ROWS and size["bytes"] <= LOOKUP_BYTES:
        return pages.join(F.broadcast(found), F.col("name") == F.col("rep_name"))
    # Hot hosts number at most pages / HOT_PAGES.
    salts = (F.col("pages") / HOT_PAGES).cast("int") + 1
    hot = materialize(found.where(F.col("pages") > HOT_PAGES).select(F.col("rep_name").alias("hot_name"), salts.alias("salts")), "url-hot")
    salted = pages.join(F.broadcast(hot), F.col("name") == F.col("hot_name"), "left").withColumn(
        "salt", F.coalesce(F.pmod(F.xxhash64("page_id", "path"), F.col("salts")).cast("int"), F.lit(0)))
    spread = found.withColumn("rep_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return salted.join(spread, (F.col("name") == F.col("rep_name")) & (F.col("salt") == F.col("rep_salt")))


def url_filter(pages: DataFrame, outcomes: DataFrame, rules: tuple[Rule, ...] = RULES, max_bad: float = MAX_BAD,
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Judge every url. ``outcomes`` has ``page_id`` and the boolean ``bad``.

    Returns page_id, host, path, rule, verdict, and the reputation behind it:
    ``host_labels`` (labelled pages of the host name), ``bad_share`` and
    ``bad_bound`` (posterior mean and lower bound)."""
    host, path = url_parts(F.col(url_col))
    judged = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    name, domain, suffix = name_parts(F.col("host"))
    judged = judged.withColumns({"rule": longest_rule(rules, "name"), "ruled": longest_rule(rules, "verdict"), "name": name})
    marks = outcomes.groupBy(F.col("page_id").alias("mark_id")).agg(F.max(F.col("bad").cast("int")).alias("bad"))
    named = pages.select(F.col(id_col).alias("page_id"), host.alias("host")).select("page_id", name.alias("name"),
                                                                                  domain.alias("domain"), suffix.alias("suffix"))
    labelled = named.join(marks, F.col("page_id") == F.col("mark_id"), "left")
    hosts = materialize(labelled.groupBy("name", "domain", "suffix").agg(
        F.count(F.lit(1)).alias("pages"), F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")), "url-hosts")
    out = _with_reputation(judged, materialize(host_reputation(hosts), "url-reputation"))
    own = F.when(F.col("bound") > F.lit(max_bad), F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"),
                      F.col("n").alias("host_labels"), F.round("mean", 6).alias("bad_share"),
                      F.round("bound", 6).alias("bad_bound"))


def page_outcomes(labels: DataFrame) -> DataFrame:
    """Outcomes by page number from the ``labels`` table: bad if of low quality or toxic."""
    low, toxic = F.col("quality") == 0, F.col("toxic") == 1
    return labels.select(F.col("doc_id").alias("page_id"), F.coalesce(low | toxic, low, toxic).alias("bad")).where("bad is not null")
