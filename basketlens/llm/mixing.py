"""Mixing sources to target weights by iterative proportional fitting.

The corpus is counted into cells (source, language, topic) of tokens. Every source, language and topic has
a goal of expected tokens: its target share of the tokens wanted in all, and all of its tokens where
it has no more than that (then the others share what is left, in the proportions of their targets).
Raking multiplies the cells' boosts margin by margin until the expected tokens, tokens * min(1, boost), meet
the goals; that is the raking of clipped probabilities in one go: cells kept whole stay at 1 while the
other cells of their margin make up the rest. A document is drawn by a hash of its id and the seed.

A sweep solves each margin exactly, with window sums over the cell table and no join; SWEEPS of them
make a job, whose result is written and tested. Goals that contradict each other end after MAX_JOBS jobs with the
margins as near as they got; `margin_error` says how near, and `margins` reports each value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import topics
from .common import staged

DIMENSIONS = ("source", "lang", "topic")
#: Default targets: present shares to these powers (1 keeps them, 0 makes them equal). A topic's is its
#: share within each language, since topics made of words follow the languages: shares of the whole
#: corpus would contradict the languages' targets.
TEMPERATURE = {"source": 0.7, "lang": 0.7, "topic": 1.0}
#: The expected share of all tokens in the mixture.
KEEP = 0.6
WHOLE = 1e12        # no boost needs to be larger
#: A mixture is settled when each margin is this near to its goal, relative to the goal.
TOLERANCE, SWEEPS, MAX_JOBS = 1e-3, 3, 12
UNKNOWN = "unknown"


def described(docs: DataFrame, keep: list[str] = ()) -> DataFrame:
    """`keep`, the dimensions and the token count of each row; null dimensions become 'unknown'."""
    rows = docs.select("doc_id", "text", *keep, *[
        F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)).alias(f"cell_{c}") for c in ("source", "lang")])
    found = topics.tagged(rows, topics.fit(docs), ["doc_id", *keep, "cell_source", "cell_lang"])
    return (found.withColumnRenamed("cell_source", "source").withColumnRenamed("cell_lang", "lang")
            if not keep else found)


def margin_totals(cells: DataFrame) -> DataFrame:
    """(dim, value, tokens): the margins of the cell table, from one grouping."""
    each = F.explode(F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).alias("value"))
                               for d in DIMENSIONS])).alias("m")
    return (cells.filter("tokens > 0").select(each, "tokens")
            .groupBy("m.dim", "m.value").agg(F.sum("tokens").alias("tokens")))


def _tempered(power: float, total_over) -> Column:
    raised = F.pow(F.col("tokens").cast("double"), F.lit(float(power)))
    return raised / F.sum(raised).over(total_over)


def default_goals(cells: DataFrame, temperature: dict[str, float], wanted: float) -> DataFrame:
    """(dim, value, goal) of tempered shares. Languages come first; a language's goal is dealt to its
    topics by their tempered shares within it."""
    margins = margin_totals(cells)
    power = F.when(F.col("dim") == "source", F.lit(float(temperature["source"]))).otherwise(
        F.lit(float(temperature["lang"])))
    raised = margins.filter("dim <> 'topic'").withColumn(
        "target", F.pow(F.col("tokens").cast("double"), power))
    first = staged(cells.sparkSession, goals(raised.withColumn(
        "target", F.col("target") / F.sum("target").over(Window.partitionBy("dim"))), wanted), "goals")
    langs = first.filter("dim = 'lang'").select(F.col("value").alias("lang"), "goal")
    within = (cells.filter("tokens > 0").groupBy("lang", "topic").agg(F.sum("tokens").alias("tokens"))
              .withColumn("part", _tempered(temperature["topic"], Window.partitionBy("lang"))))
    topic = (within.join(langs, "lang").groupBy(F.lit("topic").alias("dim"), F.col("topic").alias("value"))
             .agg(F.sum("tokens").alias("tokens"), (F.sum(F.col("goal") * F.col("part"))
                                                    / F.lit(wanted)).alias("target")))
    return first.unionByName(goals(topic, wanted))


def goals(targets: DataFrame, wanted: float) -> DataFrame:
    """(dim, value, goal): goal = min(tokens, level * target), with each dimension's level such that
    the goals add up to `wanted`. Every round settles values that keep all their tokens; levels only
    rise, so it ends."""
    spark = targets.sparkSession
    targets = staged(spark, targets, "targets")
    level = {d: wanted for d in DIMENSIONS}

    def leveled(column):
        out = F.lit(0.0)
        for d, x in level.items():
            out = F.when(F.col("dim") == d, F.col("target") * F.lit(float(x))).otherwise(out)
        return column(out)
    while True:
        whole = leveled(lambda goal: goal >= F.col("tokens"))
        sums = targets.groupBy("dim").agg(
            F.sum(F.when(whole, F.col("tokens")).otherwise(0)).alias("whole"),
            F.sum(F.when(whole, 0.0).otherwise(F.col("target"))).alias("open")).collect()
        above = {r["dim"]: (wanted - r["whole"]) / r["open"] if r["open"] > 0 else level[r["dim"]]
                 for r in sums}
        if all(x <= level[d] * (1 + 1e-12) for d, x in above.items()):
            return targets.select("dim", "value", leveled(
                lambda goal: F.least(F.col("tokens").cast("double"), goal)).alias("goal"))
        level |= {d: max(x, level[d]) for d, x in above.items()}


def _sweep(cells: DataFrame) -> DataFrame:
    """One pass over the margins, each solved exactly: the factor f with sum(tokens * min(1, f * boost)) =
    goal. With the k largest boosts clipped the sum is a line in f, and the sum itself is the least of
    these lines, so f is the largest of their solutions."""
    for d in DIMENSIONS:
        margin, tokens = Window.partitionBy(d), F.col("tokens").cast("double")
        ordered = margin.orderBy(F.desc("boost"), *[c for c in DIMENSIONS if c != d])
        clipped = F.coalesce(F.sum(tokens).over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
        others = F.sum(tokens * F.col("boost")).over(
            ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing))
        cells = (cells.withColumn("_clipped", clipped).withColumn("_others", others)
                 .withColumn("_f", F.when(F.col("_others") > 0, (F.col(f"goal_{d}") - F.col("_clipped"))
                                          / F.col("_others")))
                 .withColumn("_f", F.coalesce(F.max("_f").over(margin), F.lit(1.0)))
                 .withColumn("boost", F.least(F.lit(WHOLE), F.col("boost") * F.col("_f")))
                 .drop("_clipped", "_others", "_f"))
    return cells


def expected(cells: DataFrame) -> DataFrame:
    """(dim, value, goal, expected) tokens of every margin value."""
    each = F.explode(F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).alias("value"),
                                        F.col(f"goal_{d}").alias("goal")) for d in DIMENSIONS])).alias("m")
    own = F.col("tokens") * F.least(F.lit(1.0), F.col("boost"))
    return (cells.select(each, own.alias("own")).groupBy("m.dim", "m.value")
            .agg(F.max("m.goal").alias("goal"), F.sum("own").alias("expected")))


def rake(cells: DataFrame, goal: DataFrame, wanted: float) -> tuple[DataFrame, float]:
    """The cells with their `boost`, and the largest miss of a margin, relative to its goal. Cells
    without tokens are left out; values without a goal get boost 0."""
    spark = cells.sparkSession
    now = cells.filter("tokens > 0").select(*DIMENSIONS, "tokens")
    total = now.agg(F.sum("tokens")).first()[0]
    if not total:
        return now.withColumn("boost", F.lit(0.0)), 0.0
    for d in DIMENSIONS:
        own = goal.filter(F.col("dim") == d).select(F.col("value").alias(d), F.col("goal").alias(f"goal_{d}"))
        now = now.join(own, d, "left").withColumn(f"goal_{d}", F.coalesce(f"goal_{d}", F.lit(0.0)))
    now, miss = now.withColumn("boost", F.lit(wanted / total)), 0.0
    for _ in range(MAX_JOBS):
        for _ in range(SWEEPS):
            now = _sweep(now)
        now = staged(spark, now, "raked")
        off = F.abs(F.col("expected") - F.col("goal")) / F.greatest(F.col("goal"), F.lit(1e-9))
        miss = expected(now).agg(F.max(F.when((F.col("goal") > 0) | (F.col("expected") > 0), off)
                                       .otherwise(0.0))).first()[0]
        if miss <= TOLERANCE:
            break
    return now, miss


def chances(rows: DataFrame, rate: float, temperature, targets) -> tuple[DataFrame, float]:
    """The raked cells of described rows, and their margin error. `targets` has (dim, value, target)."""
    spark = rows.sparkSession
    cells = staged(spark, rows.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "cells")
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    wanted = float(rate) * total
    if not total:
        return rake(cells, None, 0.0)
    goal = (default_goals(cells, temperature or TEMPERATURE, wanted) if targets is None
            else goals(margin_totals(cells).join(targets, ["dim", "value"]), wanted))
    return rake(cells, staged(spark, goal, "goals"), wanted)


def draw(doc_id, seed: int):
    """A number in [0, 1) fixed by the id and the seed."""
    return F.pmod(F.xxhash64(doc_id, F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))


def mix(docs: DataFrame, rate: float = KEEP, seed: int = 8, temperature: dict[str, float] | None = None,
        targets: DataFrame | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, source, lang, topic, tokens, probability, selected, margin_error
    (the largest relative miss of a margin, the same in every row).

    `rate` is the expected share of all tokens. Rows without tokens (null, empty, blank text) have
    probability 0. Rows that share an id share the draw. A null id draws like any other value.
    Null sources and languages are the value 'unknown'. Goals that contradict each other give the
    nearest mixture reached. Other columns are not read. An empty table gives an empty result.
    """
    rows = staged(docs.sparkSession, described(docs), "described")
    cells, miss = chances(rows, rate, temperature, targets)
    joined = rows.join(cells.select(*DIMENSIONS, F.least(F.lit(1.0), F.col("boost")).alias("probability")),
                       list(DIMENSIONS), "left")
    p = F.when(F.col("tokens") > 0, F.coalesce("probability", F.lit(0.0))).otherwise(0.0)
    return joined.select("doc_id", *DIMENSIONS, "tokens", p.alias("probability"),
                         (draw(F.col("doc_id"), seed) < p).alias("selected"),
                         F.lit(float(miss)).alias("margin_error"))


def margins(docs: DataFrame, rate: float = KEEP, temperature: dict[str, float] | None = None,
            targets: DataFrame | None = None) -> DataFrame:
    """(dim, value, goal, expected): what each source, language and topic should and will give."""
    rows = staged(docs.sparkSession, described(docs), "described")
    return expected(chances(rows, rate, temperature, targets)[0])


def sample(docs: DataFrame, rate: float = KEEP, seed: int = 8) -> DataFrame:
    """The drawn rows of `docs`, with all their columns."""
    spark = docs.sparkSession
    packed = docs.select("doc_id", "text", "source", "lang", F.struct(*docs.columns).alias("row"))
    tagged = staged(spark, described(packed, ["row"]), "tagged")
    rows = tagged.select("row", F.col("cell_source").alias("source"), F.col("cell_lang").alias("lang"),
                         "topic", "tokens")
    cells, _ = chances(rows, rate, None, None)
    drawn = rows.join(cells.select(*DIMENSIONS, "boost"), list(DIMENSIONS))
    return drawn.filter(draw(F.col("row.doc_id"), seed) < F.col("boost")).select("row.*")
