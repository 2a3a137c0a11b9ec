"""URL filter: host and path rules first, then logistic regression on hashed character n-grams.

The same Spark expressions cut the n-grams of the labelled table and of the corpus. Only the labelled table,
which is small by contract, comes to the driver; the fitted weights go into the plan as one array literal.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.common import ascii_lower

#: Hashed features; a power of 16, as a feature is the first hex digits of the n-gram's MD5.
DIGITS, DIMS = 4, 16**4
SIZES = (3, 4)
#: Most labelled URLs that are fitted.
MOST_LABELS = 10_000
#: The share of unwanted URLs that is expected where the filter works.
SHARE = 0.25

#: A small labelled table of names, by topic. Names of several words are written with and without hyphens.
UNWANTED = {
    "gambling": "grand-casino casino-vegas casinoroyale royal-casino mobile-casino betting-odds bets-today best-bets livebets poker-room pokerstars-club roulette-bonus slots-jackpot freespins win-money winbig lucky-win lotto-winners blackjack-bonus casino-games online-bets betting-bonus bonus-spins poker-bonus jackpot-city slot-machines gamble-now",
    "medicines": "cheap-meds cheapdrugs pills-store discount-pills diet-pills pillsonline viagra-now cialis-shop pharma-deals cheap-tablets no-prescription viagra-pills cheap-viagra cialis-online online-pharmacy pharma-pills weightloss-pills",
    "adult": "adult-dating adulttube adult-cams xxx-videos xxxclips sex-cams sexchat escort-girls porn-clips nude-models hot-adult adult-video xxx-girls sex-girls porn-tube hot-escort nude-cams",
    "advertising": "ads-network popup-ads ad-tracker banner-ads track-clicks clicktrack adserver adserving ads-exchange pixel-track affiliate-ads adserv-net click-ads popads tracker-pixel ad-banner adclicks",
    "link farms": "spam-links bulk-spam mailspam link-farm seo-farm content-farm farmlinks backlink-seller spamblast cheap-traffic free-followers buy-followers spam-mail link-exchange seo-links free-backlinks buy-traffic",
}
WANTED = {
    "news": "news daily-post morning-herald weather sports-report the-tribune local-news headlines press-review world-affairs evening-times magazine",
    "learning": "university school-district library physics chemistry mathematics history-notes education language-course dictionary encyclopedia astronomy lectures",
    "public life": "city-council parliament ministry health-service transport police-station fire-brigade post-office election-results national-archive tax-office environment",
    "culture": "museum theatre orchestra painting literature poetry film-festival music-store photography gallery folk-dance architecture",
    "home": "garden kitchen recipes baking furniture knitting woodwork pottery parenting pet-care bicycle-repair gardening-tips",
    "outdoors": "mountain-club hiking sailing fishing birdwatching camping river-trust national-park football-club athletics horse-riding farm-museum",
    "work": "engineering software-notes open-source data-science accounting hardware-store printing logistics agriculture steel-works shipping construction",
    "travel": "travel-guide train-times airport hotel-review road-map island-ferry city-walks beach-holiday countryside heritage-trail railway-museum tourist-office",
}
PLACES = (
    "https://{}.test/", "http://{}.invalid/index.php", "https://shop.{}.localhost/a/b?q=1", "http://{}-site.test/home",
    "https://{}.city.invalid/~x/page.htm", "http://w3.{}.test:8080/",
)


def labelled_names() -> list[tuple[str, int]]:
    """(name, 1 if unwanted)."""
    return [(x, label) for groups, label in ((UNWANTED, 1), (WANTED, 0)) for names in groups.values() for x in names.split()]


def labelled_urls() -> list[tuple[str, int]]:
    """(url, 1 if unwanted): each name on two kinds of host and path, in turn, so that no kind speaks for a label."""
    return placed(labelled_names())


def placed(names: list[tuple[str, int]]) -> list[tuple[str, int]]:
    return [(PLACES[(2 * k + j) % len(PLACES)].format(x), label) for k, (x, label) in enumerate(names) for j in (0, 1)]


def host(url: Column) -> Column:
    """From the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path(url: Column) -> Column:
    """After the host up to ?, # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Iterable[str]) -> Column:
    """The longest rule that fits host or a domain above it and the path's start, the first of equally long ones; null if none does.

    A row looks up its own domains in a sorted list, so the expression stays the same for any number of rules.
    """
    by_domain: dict[str, list[str]] = {}
    for rule in sorted(set(rules)):
        by_domain.setdefault(rule.partition("/")[0], []).append(rule)
    if not by_domain:
        return F.lit(None).cast("string")
    domains, listed = (F.split(F.lit("\n".join(x)), "\n") for x in (by_domain, map("\t".join, by_domain.values())))
    labels = F.split(host, r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))

    def fitting(domain: Column) -> Column:
        of = F.split(F.element_at(listed, F.array_position(domains, domain).cast("int")), "\t")
        return F.filter(of, lambda r: F.startswith(path, F.concat(F.lit("/"), F.substr(r, F.length(domain) + 2))))

    found = F.flatten(F.transform(F.filter(above, lambda x: F.array_contains(domains, x)), fitting))
    return F.array_min(F.transform(found, lambda r: F.struct((-F.length(r)).alias("n"), r.alias("rule"))))["rule"]


def features(host: Column, path: Column) -> Column:
    """Numbers below DIMS of the character n-grams of ^host$ and of ^path$, each marked with its part, repeats included."""

    def cut(text: Column, mark: str, n: int) -> Column:
        at = F.sequence(F.lit(1), F.greatest(F.char_length(text) - n, F.lit(1)))
        return F.transform(at, lambda i: F.concat(F.lit(mark), F.substring(text, i + 1, F.lit(n))))

    def grams(text: Column, mark: str) -> Column:
        text = F.concat(F.lit(mark + "^"), text, F.lit("$"))
        return F.concat(*[cut(text, mark, n) for n in SIZES])

    return F.transform(F.concat(grams(host, "h"), grams(path, "p")), lambda g: F.conv(F.substring(F.md5(g), 1, DIGITS), 16, 10).cast("int"))


def fit(spark: SparkSession, labelled: Iterable[tuple[str, int]], rounds: int = 500, rate: float = 0.5, l2: float = 1e-3) -> list[float]:
    """DIMS weights and the intercept, by full gradient descent from zero on the labelled table: the same input
    gives the same weights. Weights are rounded to 9 decimals. The intercept is moved from the labelled table's share of unwanted
    URLs to SHARE."""
    labelled = list(labelled)
    if len(labelled) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labelled URLs")
    df = spark.createDataFrame(labelled, "url string, label int")
    return descent(df.select("label", features(host(F.col("url")), path(F.col("url"))).alias("f")).collect(), rounds, rate, l2)


def descent(rows: Iterable[tuple[int, list[int]]], rounds: int = 500, rate: float = 0.5, l2: float = 1e-3) -> list[float]:
    """Weights and intercept from (label, features) of the labelled table."""
    weights, bias = [0.0] * DIMS, 0.0
    points = []
    for label, f in rows:
        count: dict[int, float] = {}
        for x in f:
            count[x] = count.get(x, 0.0) + 1.0 / len(f) ** 0.5
        points.append((label, sorted(count.items())))
    for _ in range(rounds if points else 0):
        grad, off = {}, 0.0
        for label, count in points:
            z = bias + sum(weights[i] * v for i, v in count)
            e = 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - label
            off += e
            for i, v in count:
                grad[i] = grad.get(i, 0.0) + e * v
        for i, g in sorted(grad.items()):
            weights[i] -= rate * (g / len(points) * 20 + l2 * weights[i])
        bias -= rate * off / len(points)
    unwanted = sum(label for label, _ in points)
    if 0 < unwanted < len(points):
        bias += math.log(SHARE / (1 - SHARE)) - math.log(unwanted / (len(points) - unwanted))
    return [round(x, 9) for x in [*weights, bias]]


def score(host: Column, path: Column, weights: list[float]) -> Column:
    """The log-odds of being unwanted."""
    table, f = F.split(F.lit(",".join(map(repr, weights[:DIMS]))), ",").cast("array<double>"), features(host, path)
    total = F.aggregate(f, F.lit(0.0), lambda a, i: a + F.element_at(table, i + 1))
    return F.lit(weights[DIMS]) + total / F.sqrt(F.size(f).cast("double"))


def judge(pages: DataFrame, weights: list[float], allow: Iterable[str], block: Iterable[str], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict ("allow" or "block"), log_odds (null where a rule decides).

    A url that is null or has no :// has empty host and path and is judged by the regression, as every row without
    a rule is: block at log-odds of 0 and more. Urls are judged whole, however long; repeated rows alike; no rows, no rows; other columns are not read.
    """
    allow, block = list(allow), list(block)
    rows = pages.select(pages[id_col].alias("page_id"), host(pages[url_col]).alias("host"), path(pages[url_col]).alias("path"))
    rows = rows.withColumn("rule", matching_rule(F.col("host"), F.col("path"), [*allow, *block]))
    rows = rows.withColumn("log_odds", F.when(F.col("rule").isNull(), score(F.col("host"), F.col("path"), weights)))
    blocked = F.when(F.col("rule").isNotNull(), F.col("rule").isin(block)).otherwise(F.col("log_odds") >= 0)
    return rows.select("page_id", "host", "path", "rule", F.when(blocked, "block").otherwise("allow").alias("verdict"), "log_odds")


def plain_features(url: str) -> list[int]:
    """features() without Spark, from n-grams cut in Python; the url has a ://."""
    import hashlib
    import re

    h, p = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url).groups()
    texts = (("h", f"h^{h.lower()}$"), ("p", f"p^{p}$"))
    grams = [m + t[i : i + n] for m, t in texts for n in SIZES for i in range(1, max(len(t) - n, 1) + 1)]
    return [int(hashlib.md5(g.encode()).hexdigest()[:DIGITS], 16) for g in grams]


def plain_weights(labelled: Iterable[tuple[str, int]]) -> list[float]:
    """fit() without Spark: for the SQL and for tests."""
    return descent((label, plain_features(url)) for url, label in labelled)


def oracle(weights: list[float], allow: Iterable[str], block: Iterable[str]) -> str:
    """The same judgement in DuckDB's SQL, over the view pages."""
    rules = sorted([*allow, *block], key=lambda x: (-len(x), x))

    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    cases = " ".join(
        f"WHEN (host = {quoted(n)} OR ends_with(host, {quoted('.' + n)})) AND starts_with(path, {quoted('/' + p)}) THEN {quoted(r)}" for r in rules for n, _, p in [r.partition("/")]
    )
    grams = ", ".join(
        f"list_transform(range(1, greatest(len({part}) + 3 - {n}, 1) + 1), lambda i: '{mark}' || substring('{mark}^' || {part} || '$', i + 1, {n}))" for part, mark in (("host", "h"), ("path", "p")) for n in SIZES
    )
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH w AS (SELECT string_split('{",".join(map(repr, weights[:DIMS]))}', ',')::DOUBLE[] AS weights),
parts AS (
  SELECT page_id, {lower.format("coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), '')")} AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
ruled AS (SELECT *, CASE {cases} ELSE NULL END AS rule FROM parts),
cut AS (SELECT *, list_transform(flatten([{grams}]), lambda g: ('0x' || substring(md5(g), 1, {DIGITS}))::INTEGER) AS f FROM ruled)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ({", ".join(map(quoted, block))}) THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN {weights[DIMS]!r}::DOUBLE + list_sum(list_transform(f, lambda i: weights[i + 1])) / sqrt(len(f)) >= 0 THEN 'block' ELSE 'allow' END AS verdict
FROM cut, w"""
