"""URL filters: host rules first, then logistic regression on hashed character n-grams.

A url's host and path are cut into character n-grams of 3 to 5 characters (with marks for their
ends, digits read as 0), each n-gram is hashed into one of BUCKETS, and the distinct buckets, scaled
to length 1, are the features. The regression is fitted on a small labelled table of urls, at most
MAX_LABELLED rows of it (those with the smallest hashes). Scoring is one expression of SQL
functions per url with the weights as a constant: nothing is shuffled, and a host that holds a
third of all rows costs nothing extra.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SIZES = (3, 4, 5)
BUCKETS = 1 << 14
MAX_LABELLED = 10_000
REGULARISATION, STEPS = 0.00003, 30
THRESHOLD = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The rules of the registered query, as (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

# The small labelled url table. Each host comes with every path of PATHS; wanted hosts
# also come with unwanted paths. Unwanted: adult, gambling, pills, link farms, trackers, loans.
UNWANTED_HOSTS = """
adult-videos.example www.adult-cams.example adult.example m.adultshop.example xxx-tube.example
porn-hub.example blog.free-porn.example www.sexcams.example hot-sex.example casino-royal.example
www.casino-online.example best-casino.example m.mycasino.example win-big.example lotto-win.example
www.win-money.example blog.instant-win.example bets-online.example www.free-bet.example
m.sport-bets.example livebets.example poker-stars.example www.poker-room.example slots-777.example
blog.roulette.example cheap-meds.example buy-pills.example www.pills-shop.example m.diet-pills.example
viagra-store.example cheap-viagra.example www.cheap-replica.example cheap-loans.example
blog.payday-loan.example www.fast-cash.example spam-links.example m.spam-site.example link-farm.example
seo-farm.example www.content-farm.example farm-links.example ads-server.example blog.adserver.example
www.ads-network.example click-ads.example track-pixel.example www.tracker.example m.click-track.example
ad-track.example popup-ads.example www.clickbait.example free-gift.example adult-fun.example
m.adult-dating.example www.xxx-movies.example blog.xxx-adult.example xxx.example porn-tube.example
www.porn-land.example porn.example m.lotto-play.example www.lotto.example mega-lotto.example
pills-now.example blog.pills.example www.sleeping-pills.example viagra-now.example www.viagra.example
m.poker-night.example poker.example www.casino-night.example casino.example blog.top-bets.example
bets-now.example www.bets.example spam-links-dir.example www.spam-links.example ads-server-cdn.example
m.ads-server.example click-track-go.example blog.click-track.example ads-track.example
""".split()
WANTED_HOSTS = """
news.example blog.garden.example m.weather.example www.library.example museum.example docs.example
wiki.example en.wiki.example recipes.example www.cooking.example school.example university.example
www.science.example journal.example m.forum.example photos.example blog.travel.example hotels.example
maps.example bank.example www.shop.example books.example music.example m.radio.example sport.example
football.example www.tennis.example chess.example health.example blog.hospital.example city.example
www.gov.example law.example energy.example data.example m.code.example dev.example status.example
www.mail.example jobs.example art.example blog.film.example theatre.example m.tition.example
www.heron.example blog.anden.example therest.example thinter.example www.ouration.example
blog.sterin.example mentos.example m.ingent.example atherly.example www.onding.example erthal.example
blog.thistle.example nation.example www.station.example m.motion.example lotion.example
farmers-market.example www.garden-farm.example window.example winter.example blog.trackside.example
adulthood.example m.between.example www.alphabets.example spain.example
""".split()
PATHS = "/ /en/1042 /de/17/ /fr/305.html /es/88 /about /posts/2024/03/ /index.php /a/item_42.html".split()
UNWANTED_PATHS = "/casino-bonus/ /buy-viagra/ /porn/clips /free-bets/ /adult/ /cheap-pills/ /poker/win".split()
#: Urls without host and path are wanted: the rule alone can block them.
NO_PARTS = ["http://"] * 40


@dataclass(frozen=True)
class UrlModel:
    """The fitted regression: one weight per bucket, and the intercept."""
    weights: tuple[float, ...]
    intercept: float


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table above: url, label (1 unwanted)."""
    rows = [(f"http://{h}{p}", 1) for h in UNWANTED_HOSTS for p in PATHS]
    rows += [(f"http://{h}{p}", 1) for h in WANTED_HOSTS[::4] for p in UNWANTED_PATHS]
    rows += [(f"http://{h}{p}", 0) for h in WANTED_HOSTS for p in PATHS]
    rows += [(url, 0) for url in NO_PARTS]
    return spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{u}', {n})" for u, n in rows)
                     + " AS t(url, label)")


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path). Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased.
    Path: from there up to `?`, `#` or the end. A null, or no `://`: both empty."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(
        F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _letters(text: Column) -> Column:
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(
        F.concat(F.lit("^"), F.regexp_replace(text, "[0-9]", "0"), F.lit("$")), ""))


def _grams(letters: str, mark: str) -> Column:
    """Hash buckets of a letter list's n-grams; element access keeps it linear in the length."""
    def of(n: int) -> Column:
        last = F.size(letters) - n + 1
        grams = F.transform(F.sequence(F.lit(0), last - 1), lambda i: F.pmod(
            F.xxhash64(F.lit(mark), F.concat(*[F.get(letters, i + j) for j in range(n)])),
            F.lit(BUCKETS)).cast("int"))
        return F.when(last > 0, grams).otherwise(F.array().cast("array<int>"))
    return F.concat(*[of(n) for n in SIZES])


def features(urls: DataFrame, keep: list[Column]) -> DataFrame:
    """`keep` (aliased columns), host, path and the sorted distinct `buckets` of each url. The
    letter lists come out of a one-element explode, so that Catalyst does not move the split into
    every n-gram."""
    host, path = url_parts(F.col("url").cast("string"))
    cut = urls.select(*keep, host.alias("host"), path.alias("path"))
    names = cut.columns
    cut = cut.select("*", F.explode(F.array(F.struct(
        _letters(F.col("host")).alias("h"), _letters(F.col("path")).alias("p")))).alias("letters"))
    return cut.select(*names, F.array_sort(F.array_distinct(F.concat(
        _grams("letters.h", "h"), _grams("letters.p", "p")))).alias("buckets"))


def fit(labelled: DataFrame) -> UrlModel:
    """Fit on (url, label); at most MAX_LABELLED rows, those with the smallest url hashes. Rows
    with a null url or label are left out. With one label only, the intercept decides."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizerModel, Normalizer

    known = (labelled.filter("url IS NOT NULL AND label IS NOT NULL")
             .orderBy(F.xxhash64("url"), "url", "label").limit(MAX_LABELLED))
    rows = features(known, [F.col("label").cast("double").alias("label")])
    rows = rows.select("label", F.col("buckets").cast("array<string>").alias("buckets")).coalesce(1)
    seen, labels = rows.agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("buckets")))),
                            F.array_sort(F.collect_set("label"))).first()
    if len(labels) < 2 or not seen:
        return UrlModel((0.0,) * BUCKETS, 20.0 if labels == [1.0] else -20.0)
    vectors = CountVectorizerModel.from_vocabulary(seen, inputCol="buckets", outputCol="counts")
    vectors = Normalizer(inputCol="counts", outputCol="features", p=2.0).transform(
        vectors.setBinary(True).transform(rows)).select("label", "features")
    found = LogisticRegression(regParam=REGULARISATION, maxIter=STEPS, standardization=False, tol=1e-5).fit(vectors)
    weights = [0.0] * BUCKETS
    for bucket, weight in zip(seen, found.coefficients.toArray()):
        weights[int(bucket)] = float(weight)
    return UrlModel(tuple(weights), float(found.intercept))


def _score(model: UrlModel) -> Column:
    weights = F.from_json(F.lit(json.dumps(model.weights)), "array<double>")
    total = F.aggregate("buckets", F.lit(0.0), lambda s, b: s + F.get(weights, b))
    linear = F.lit(model.intercept) + F.when(F.size("buckets") > 0, total / F.sqrt(
        F.size("buckets"))).otherwise(0.0)
    return 1 / (1 + F.exp(-linear))


def _fits(rule_host: str, rule_path: str) -> Column:
    host, path = F.col("host"), F.col("path")
    return ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)


def judge_urls(pages: DataFrame, model: UrlModel, rules=RULES, id_col: str = "page_id") -> DataFrame:
    """One row per row of `pages`: id, host, path, rule (host + path of the rule that decides, or
    null), verdict (allow or block), score (0 to 1, the regression's).

    A rule (verdict, host, path) fits its host and all subdomains where the url's path starts with
    the rule's; of several the longest host + path wins, then the longer host, then block. Without
    a rule, a score of THRESHOLD or more is blocked. A null url, or one without `://`, has
    empty parts, no rule and the score of the intercept alone. Repeated rows are judged alike, other
    columns are not read, an empty table gives an empty result. `rules` is configuration, a short
    list that becomes part of the expression.
    """
    scored = features(pages, [F.col(id_col).alias(id_col)]).withColumn("score", _score(model))
    longest = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0] != "block"))
    rule, verdict = F.lit(None).cast("string"), F.when(F.col("score") >= THRESHOLD, "block").otherwise("allow")
    for said, host, path in reversed(longest):
        rule = F.when(_fits(host, path), F.lit(host + path)).otherwise(rule)
        verdict = F.when(_fits(host, path), F.lit(said)).otherwise(verdict)
    return scored.select(id_col, "host", "path", rule.alias("rule"), verdict.alias("verdict"), "score")
