"""URL filter: rules first, then the host's reputation, shrunk along host, registered domain and suffix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lookup import dealt_lookup
from ..session import stage_table

RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
#: A page is blocked by reputation if even the upper posterior bound of its share of good pages is below this.
LEAST_GOOD = 0.5
#: Standard deviations of the posterior bound.
BOUND = 1.645
#: Bounds of the prior's strength, in pages.
STRENGTHS = (2.0, 200.0)
#: Public suffixes of more than one label that occur often; a registered domain has one label more.
LONG_SUFFIXES = ("ac.uk", "co.in", "co.jp", "co.nz", "co.uk", "co.za", "com.au", "com.br", "com.cn", "com.mx", "gov.uk", "org.uk")

_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: str | Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, *_LOWER), F.lit(""))


def url_path(url: str | Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null if none does.

    A rule's host fits itself and all hosts that end in a point and it; its path fits paths that start with it.
    """
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, decision in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        text, verdict = F.when(fits, F.lit(rule)).otherwise(text), F.when(fits, F.lit(decision)).otherwise(verdict)
    return text, verdict


def host_name(host: Column) -> Column:
    """The host without user, port and trailing points, under which its pages are counted."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r"(?s)^.*@", ""), r":[0-9]*\z", ""), r"\.+\z", "")


def host_levels(name: Column, long_suffixes: Sequence[str] = LONG_SUFFIXES) -> tuple[Column, Column]:
    """(registered domain, public suffix) of a host name; an address or a name of one label is its own.

    The longest of ``long_suffixes`` that ends the name is its suffix, else its last label.
    """
    labels = F.split(name, r"\.")
    size = F.size(labels)
    tail = lambda n: F.when(size > n, F.array_join(F.slice(labels, size - n + 1, F.lit(n)), ".")).otherwise(name)
    domain, suffix = tail(2), tail(1)
    for n in sorted({x.count(".") + 1 for x in long_suffixes}):
        long = tail(n).isin(*[x for x in long_suffixes if x.count(".") + 1 == n])
        domain, suffix = F.when(long, tail(n + 1)).otherwise(domain), F.when(long, tail(n)).otherwise(suffix)
    address = name.rlike(r"^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+\z") | name.startswith("[")
    return F.when(address, name).otherwise(domain), F.when(address, name).otherwise(suffix)


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, good) for pages whose document is labelled: good if of quality and not toxic; hosts by ``host_name``.

    The last number in a page's path names its document.
    """
    path = url_path("url")
    doc = F.regexp_extract(path, r"([0-9]{1,18})[^0-9]*$", 1)
    known = pages.select(host_name(url_host("url")).alias("host"), F.when(doc != "", doc.cast("long")).alias("doc_id"))
    marks = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id")
    marks = marks.agg(F.min(((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int")).alias("good"))
    return known.filter("host <> '' AND doc_id IS NOT NULL").join(marks, "doc_id").select("host", "good")


def _strength(n: Column, k: Column, mean: Column) -> Column:
    """Pages that the prior of a level is worth: moments of the beta-binomial over the level's groups.

    With shares p_i = k_i / n_i, the weighted variance S = sum n_i (p_i - m)^2 exceeds what sampling alone explains,
    (G - 1) m (1 - m), by as much as the groups differ.
    """
    groups, total = F.count(F.lit(1)), F.sum(n)
    spread = F.sum(n * (k / n - mean) * (k / n - mean))
    chance = F.max(mean * (1 - mean))
    # Null where there is one group only, or none.
    among = F.try_divide(spread - (groups - 1) * chance, total - F.try_divide(F.sum(n * n), total))
    strength = F.when((among > 0) & (chance > 0), chance / among - 1).otherwise(STRENGTHS[1])
    return F.greatest(F.lit(STRENGTHS[0]), F.least(F.lit(STRENGTHS[1]), F.coalesce(strength, F.lit(STRENGTHS[1]))))


def host_reputations(outcomes: DataFrame, long_suffixes: Sequence[str] = LONG_SUFFIXES) -> DataFrame:
    """The levels of every labelled host with its posterior: level, name, a, b.

    The prior of a suffix is the share of good pages of all; that of a domain its suffix's posterior mean; that of a
    host its domain's.  How many pages a prior is worth is estimated per level from how much groups differ.
    """
    domain, suffix = host_levels(F.col("host"), long_suffixes)
    hosts = outcomes.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("k"))
    hosts = stage_table(hosts.select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "k"), "outcomes")
    parts = []
    # One row: the good share of all.
    above = hosts.groupBy().agg(F.sum("k").alias("k"), F.sum("n").alias("n")).select(
        F.lit("").alias("up"), ((F.col("k") + 1) / (F.col("n") + 2)).alias("mean")
    )
    for level, up in (("suffix", F.lit("")), ("domain", F.col("suffix")), ("host", F.col("domain"))):
        groups = hosts.withColumn("up", up).groupBy(level, "up").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
        groups = groups.join(above, "up")
        worth = groups.groupBy().agg(_strength(F.col("n"), F.col("k"), F.col("mean")).alias("strength"))
        worth = worth.withColumn("all", F.lit(level))  # one row
        posterior = groups.withColumn("all", F.lit(level)).join(F.broadcast(worth), "all").select(
            F.lit(level).alias("level"),
            F.col(level).alias("name"),
            (F.col("strength") * F.col("mean") + F.col("k")).alias("a"),
            (F.col("strength") * (1 - F.col("mean")) + F.col("n") - F.col("k")).alias("b"),
        )
        posterior = stage_table(posterior, "reputation")
        parts.append(posterior)
        above = posterior.select(F.col("name").alias("up"), (F.col("a") / (F.col("a") + F.col("b"))).alias("mean"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def judge_pages(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    least_good: float = LEAST_GOOD,
    long_suffixes: Sequence[str] = LONG_SUFFIXES,
) -> DataFrame:
    """One row per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict, level, a, b, bound.

    The longest fitting rule decides.  Other pages are blocked if the upper posterior bound of their host's good
    share, mean plus ``BOUND`` deviations of its beta distribution, is below ``least_good``; a host without labelled
    pages is judged by its domain, then by its suffix, and allowed if that is unknown too.  ``level`` names which of
    these judged, ``a`` and ``b`` are its posterior and ``bound`` the bound, to six places; null if none is known.  They
    are returned for pages with a rule as well.  Hosts are counted without user, port and trailing points, and
    addresses have no domain.  Null urls and urls without ``://`` have empty host and path and are allowed.  Empty
    tables give empty results, no labels no block.

    Posteriors are found per host and looked up by pages dealt to lanes, so that a host with a third of the pages is
    not joined in one task.
    """
    pages = pages.select("page_id", F.col("url").cast("string").alias("url"))
    known = host_reputations(page_outcomes(pages, labels), long_suffixes)
    hosts = pages.select(host_name(url_host("url")).alias("host")).distinct().filter("host <> ''")
    domain, suffix = host_levels(F.col("host"), long_suffixes)
    hosts = hosts.withColumns({"domain": domain, "suffix": suffix})
    for level in ("host", "domain", "suffix"):
        side = known.filter(F.col("level") == level)
        side = side.select(F.col("name").alias(level), F.struct("level", "a", "b").alias(f"_{level}"))
        hosts = hosts.join(side, level, "left")
    best = F.coalesce("_host", "_domain", "_suffix")
    a, b = best.getField("a"), best.getField("b")
    upper = a / (a + b) + BOUND * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    shown = [best.getField("level").alias("level"), *[F.round(c, 6).alias(n) for c, n in ((a, "a"), (b, "b"), (upper, "bound"))]]
    judged = hosts.select("host", F.struct(*shown, (upper < least_good).alias("bad")).alias("judged")).filter(best.isNotNull())
    rows = pages.select("page_id", url_host("url").alias("host"), url_path("url").alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "_ruled": verdict})
    rows = dealt_lookup(rows, stage_table(judged, "judged"), host_name(F.col("host")), "_judged")
    judged_so = F.when(F.col("_judged.bad"), "block").otherwise("allow")
    return rows.select(
        "page_id", "host", "path", "rule", F.coalesce("_ruled", judged_so).alias("verdict"),
        "_judged.level", "_judged.a", "_judged.b", "_judged.bound",
    )
