"""Toxicity: a weighted finite-state grammar over clauses.

A text is read clause by clause. The lexical transducer maps words to symbols: I (an insult, with
a weight), H (a threat), T (a target), N (a negation), R (a reporting word), Q (a quote sign of a pair), or
'o'. Three transducers over these symbols are composed to one machine (``clause_machine``):

  negation   rewrites a match at most REACH words behind an N to its negated form
  reported   rewrites a match behind an R, or inside quotes, to its reported form
  target     weighs the matches: DIRECT words or less from a T more, negated and reported ones less. A T
             may still come, so the machine guesses and a path that guessed wrong is not accepted. An H
             counts only on paths with a T in the clause.

A clause scores its best accepting path; clauses without a match score nothing. The insult
lexicon is learned from labelled rows: whole words and word beginnings (stems, for
inflected forms) that mark toxic documents far more often than others. A logistic
curve with weights of at least 0, fitted on labelled rows that the lexicon was not learned from,
turns the clause scores into a score from 0 to 1, so a stronger clause never lowers it.
The function words of the other symbols are given below.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filled_text, staged
from .shingles import shingle_set
from .transducers import Transducer, build, compose

# Word lists of the grammar.
THREATS = {"kill", "hurt", "destroy", "beat", "punish", "attack", "shoot", "burn", "crush",
           "töten", "vernichten", "schlagen", "tuer", "frapper", "détruire",
           "matar", "golpear", "destruir"}
TARGETS = {"you", "your", "yours", "u", "ur", "he", "she", "they", "them", "him", "her",
           "du", "dich", "dir", "ihr", "euch", "tu", "toi", "te", "vous", "vosotros",
           "usted", "ustedes"}
NEGATIONS = {"not", "no", "never", "neither", "nor", "isn't", "aren't", "wasn't", "don't",
             "nicht", "kein", "keine", "nie", "pas", "jamais", "nunca", "ni"}
REPORTS = {"said", "says", "say", "wrote", "writes", "called", "calls", "quoted", "reported",
           "sagte", "schrieb", "nannte", "dit", "écrit", "appelé", "dijo", "escribió"}
THREAT_WEIGHT, TARGET_FACTOR, NEGATION_FACTOR, REPORT_FACTOR = 6.0, 1.5, 0.0, 0.1
DIRECT, REACH = 4, 3

#: Labelled rows taken. One in CURVE_SHARE of them, by a hash of the id, is for the curve.
TRAIN_ROWS, CURVE_SHARE = 10_000, 4
#: Texts with fewer words count as this long where clause scores are taken per word.
LEAST_WORDS = 50
MIN_FAMILIES, MIN_LOG_ODDS, MAX_CHANCE = 3, 2.0, 1e-6
STEMS = (4, 5, 6)
HELD_OUT_REMAINDER, FOLDS, THRESHOLD = 2, 4, 0.3

WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
QUOTES = "\"“”„«»"
WORD_OR_QUOTE = re.compile(WORD.pattern + f"|[{QUOTES}]")
CLAUSE_END = re.compile(r"[.!?;:\n]+")


def held_out(doc_id):
    """Rows no label may be learned from."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT_REMAINDER


def forms(word: str):
    """A word and its beginnings, as lexicon entries; a beginning ends in '*'."""
    yield word
    for n in STEMS:
        if len(word) > n:
            yield word[:n] + "*"


SYMBOLS = ("I", "H", "T", "N", "R", "Q", "o")
MATCHES = ("I", "H")


def negation_machine() -> Transducer:
    """I and H become i and h up to REACH words behind an N. State: words still in reach."""
    def step(left, symbol):
        if symbol == "Q":
            return [(left, "Q", 1.0)]
        if symbol == "N":
            return [(REACH, "o", 1.0)]
        return [(max(0, left - 1), symbol.lower() if left and symbol in MATCHES else symbol, 1.0)]
    return build(0, SYMBOLS, step, lambda _: True)


def report_machine() -> Transducer:
    """A match behind an R or inside quotes gets an r. State: reported, quoted. Quotes are not passed on."""
    def step(state, symbol):
        said, quoted = state
        if symbol == "Q":
            return [((said, not quoted), "", 1.0)]
        if symbol == "R":
            return [((True, quoted), "o", 1.0)]
        return [(state, symbol + "r" if symbol.upper() in MATCHES and (said or quoted) else symbol, 1.0)]
    return build((False, False), (*SYMBOLS, "i", "h"), step, lambda _: True)


def target_machine() -> Transducer:
    """Factors of the matches. State: words for which the last T is still near, words within which a guessed
    T must come (0: none guessed), whether a threat waits for a T, whether there was a T."""
    marks = {m + r: (NEGATION_FACTOR if m.islower() else 1.0) * (REPORT_FACTOR if r else 1.0)
             for m in ("I", "H", "i", "h") for r in ("", "r")}

    def step(state, symbol):
        near, owed, waits, seen = state
        if symbol == "T":
            return [((DIRECT, 0, False, True), "", 1.0)]
        if owed == 1:           # the last word in which the guessed T could have come
            return []
        near_next, owed_next = max(0, near - 1), max(0, owed - 1)
        if symbol not in marks:
            return [((near_next, owed_next, waits, seen), "", 1.0)]
        factor, threat = marks[symbol], symbol[0] in "Hh"
        waiting = waits or threat and not seen
        out = [((near_next, owed_next, waits, seen), "", 0.0)] if threat else []
        if near:
            return [*out, ((near_next, owed_next, waiting, seen), "", factor * TARGET_FACTOR)]
        return [*out, ((near_next, owed_next, waiting, seen), "", factor),
                ((near_next, owed_next or DIRECT, waiting, seen), "", factor * TARGET_FACTOR)]
    return build((0, 0, False, False), (*marks, "T", "o"), step, lambda s: not s[1] and not s[2])


@cache
def clause_machine() -> Transducer:
    """Negation, then reported speech, then targets, composed."""
    return compose(compose(negation_machine(), report_machine(), SYMBOLS), target_machine(), SYMBOLS)


@dataclass
class Grammar:
    """The lexical transducer (learned weights, given lists) and the curve over clause scores."""

    insults: dict[str, float] = field(default_factory=dict)
    curve: list[float] = field(default_factory=lambda: [-3.0, 2.0, 0.0, 0.0])
    threats: frozenset = frozenset(THREATS)
    targets: frozenset = frozenset(TARGETS)
    negations: frozenset = frozenset(NEGATIONS)
    reports: frozenset = frozenset(REPORTS)

    def __post_init__(self):
        self.memo: dict[str, tuple[str, float]] = {}

    def symbol(self, word: str) -> tuple[str, float]:
        """The lexical transducer: one symbol and its weight for a lower-case word or a quote sign."""
        got = self.memo.get(word)
        if got is None:
            weight = max((self.insults.get(f, 0.0) for f in forms(word)), default=0.0)
            got = (("I", weight) if weight else ("H", THREAT_WEIGHT) if word in self.threats
                   else ("T", 0.0) if word in self.targets else ("N", 0.0) if word in self.negations
                   else ("R", 0.0) if word in self.reports else ("Q", 0.0) if word in QUOTES else ("o", 0.0))
            if len(self.memo) > 100_000:
                self.memo.clear()
            self.memo[word] = got
        return got

    def clause(self, words: list[str]) -> float:
        """The composed transducers over the words and quote signs of one clause. A quote sign without a
        partner is none."""
        symbols = [self.symbol(w) for w in words]
        if not any(s in MATCHES for s, _ in symbols):
            return 0.0
        quotes = [at for at, (s, _) in enumerate(symbols) if s == "Q"]
        if len(quotes) % 2:
            del symbols[quotes[-1]]
        return clause_machine().best(symbols)

    def features(self, text: str) -> tuple[float, float, float]:
        """Largest and summed clause score of a whole text, and the sum per 100 words; as
        logarithms."""
        words = WORD.findall(text.lower())
        symbol = self.symbol
        if not any(symbol(w)[0] in MATCHES for w in set(words)):
            return 0.0, 0.0, 0.0
        best = total = 0.0
        for part in CLAUSE_END.split(text.lower()):
            score = self.clause(WORD_OR_QUOTE.findall(part))
            best, total = max(best, score), total + score
        return (math.log1p(best), math.log1p(total),
                math.log1p(100 * total / max(LEAST_WORDS, len(words))))

    def score(self, text: str) -> float:
        z = self.curve[0] + sum(a * b for a, b in zip(self.curve[1:], self.features(text)))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


TOTAL = ""          # stands for all words of a document


def _entries(wanted: frozenset | None):
    """(entry, family, toxic, words): per document the number of different words that each
    wanted entry (or any) stands for. Near copies mostly have the same family, a MinHash of
    their shingles, and count once."""
    def run(batches):
        for batch in batches:
            columns: tuple[list, ...] = ([], [], [], [])
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shared = shingle_set(text, 3)
                family = int(shared.view(np.int64).min()) if len(shared) else 0
                words = set(WORD.findall(text.lower()))
                own = Counter(f for w in words for f in forms(w) if wanted is None or f in wanted)
                own[TOTAL] = len(words)
                for column, values in zip(columns, (own.keys(), [family] * len(own),
                                                    [y] * len(own), own.values())):
                    column += values
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int32(),
                                                          pa.int64()))],
                names=["entry", "family", "toxic", "words"])
    return run


def _counted(sample: DataFrame, wanted: frozenset | None) -> DataFrame:
    """Per entry: words in toxic documents, words in all, and toxic families."""
    rows = sample.mapInArrow(_entries(wanted), "entry string, family bigint, toxic int, words bigint")
    return (rows.groupBy("entry", "family").agg(F.max("toxic").alias("toxic"),
                                                F.max("words").alias("words"))
            .groupBy("entry").agg(F.sum(F.col("words") * F.col("toxic")).alias("bad"),
                                  F.sum("words").alias("trials"), F.sum("toxic").alias("families")))


def chance(hits: int, trials: int, rate: float) -> float:
    """P(Binomial(trials, rate) >= hits), by its leading terms; 1 where hits are no excess."""
    if hits <= trials * rate:
        return 1.0
    log = (math.lgamma(trials + 1) - math.lgamma(hits + 1) - math.lgamma(trials - hits + 1)
           + hits * math.log(rate) + (trials - hits) * math.log1p(-rate))
    ratio = (trials - hits) * rate / ((hits + 1) * (1 - rate))
    return min(1.0, math.exp(log) / max(1e-9, 1 - ratio))


def _feature_rows(grammar: Grammar):
    def run(batches):
        for batch in batches:
            rows = [grammar.features(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array([r[k] for r in rows], pa.float64()) for k in range(3)], batch.column(1)],
                names=["best", "total", "density", "toxic"])
    return run


def fit_curve(x: np.ndarray, y: np.ndarray, steps: int = 50) -> list[float]:
    """Logistic regression by Newton steps with a small ridge."""
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-3] + [1e-2] * (x.shape[1] - 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge
        step = np.linalg.solve(hessian, x.T @ (y - p) - ridge @ w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return w.tolist()


def fit_rising_curve(x: np.ndarray, y: np.ndarray) -> list[float]:
    """``fit_curve`` with a constant and no negative weight: the most negative column is left out
    until none is."""
    used = list(range(x.shape[1]))
    while True:
        w = fit_curve(np.column_stack([np.ones(len(x)), x[:, used]]), y)
        if not used or min(w[1:]) >= 0:
            break
        used.pop(int(np.argmin(w[1:])))
    found = dict(zip(used, w[1:]))
    return [w[0], *[found.get(k, 0.0) for k in range(x.shape[1])]]


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Grammar:
    """Learn the grammar from at most `train_rows` labelled rows outside the held-out
    fold, the ones with the smallest hash of their id: the lexicon from most of them, the curve from the
    others. Without usable rows of both classes for the lexicon the grammar has its given word lists
    only, without such rows for the curve its given curve. What is collected is bounded by the words of
    these rows."""
    for_curve = F.pmod(F.xxhash64("doc_id", F.lit("curve")), F.lit(CURVE_SHARE)) == 0
    usable = (labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()
                            & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
              .withColumn("for_curve", for_curve))
    # at most train_rows short rows: small enough to send to every task
    sample = staged(docs.sparkSession, docs.select("doc_id", filled_text().alias("text"))
                    .join(F.broadcast(usable), "doc_id")
                    .groupBy("doc_id", F.col("toxic").cast("int").alias("toxic"), "for_curve")
                    .agg(F.min("text").alias("text")).select("text", "toxic", "for_curve"), "toxicity_sample")
    learning, fitting = (sample.filter(c).select("text", "toxic") for c in ("NOT for_curve", "for_curve"))
    # entries of several toxic documents first, then how often the others have these
    common = (_counted(learning.filter("toxic = 1"), None).filter(F.col("families") >= MIN_FAMILIES)
              .select("entry").collect())
    counts = {r["entry"]: r for r in
              _counted(learning, frozenset(r["entry"] for r in common)).collect()}
    total = counts.pop(TOTAL, None)
    if total is None or not 0 < total["bad"] < total["trials"]:
        return Grammar()
    rate = total["bad"] / total["trials"]
    insults = {}
    for entry, r in counts.items():
        clean, all_clean = r["trials"] - r["bad"], total["trials"] - total["bad"]
        odds = (math.log((r["bad"] + 0.5) / (total["bad"] + 1))
                - math.log((clean + 0.5) / (all_clean + 1)))
        if (r["families"] >= MIN_FAMILIES and odds >= MIN_LOG_ODDS
                and chance(r["bad"], r["trials"], rate) < MAX_CHANCE):
            insults[entry] = odds
    grammar = Grammar(insults)
    rows = fitting.mapInArrow(_feature_rows(grammar), "best double, total double, density double, toxic int")
    found = np.array([tuple(r) for r in rows.collect()], dtype=float).reshape(-1, 4)
    if 0 < found[:, 3].sum() < len(found):
        grammar.curve = fit_rising_curve(found[:, :3], found[:, 3])
    return grammar


def _scores(grammar: Grammar):
    def run(batches):
        for batch in batches:
            scores = [grammar.score(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])
    return run


def score_documents(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of `docs`.

    Null and empty texts have no clause and get the curve's lowest score; a null doc_id is
    not held out; repeated rows give repeated results; other columns are not read. Texts
    are read whole; rows are independent of each other.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), filled_text().alias("text"))
    scored = rows.mapInArrow(_scores(grammar), "doc_id bigint, score double")
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False))
                         .alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def _keep(grammar: Grammar, at: int):
    def run(batches):
        for batch in batches:
            keep = [grammar.score(t or "") < THRESHOLD for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))
    return run


def drop_toxic(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """The rows of `docs`, with all columns, whose score is under the threshold."""
    return docs.mapInArrow(_keep(grammar, docs.columns.index("text")), docs.schema)
