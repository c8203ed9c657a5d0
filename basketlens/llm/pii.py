"""Personal data: generators propose spans, boosted trees choose among them.

Base spans (e-mail, ip, card, phone) follow fixed formats and always stay. High-recall
generators propose further, overlapping spans of looser formats: every run of digit groups that can be
a phone or card number, address parts with other signs between them, written-out e-mail
addresses with each possible end. Gradient-boosted trees score the proposals from the shape of the span and
its context, scores are calibrated on held-out proposals, and a threshold per kind is
set for a wanted precision. Of overlapping choices, whatever their kinds, the one with the higher score stays.

Labels need no annotation: checked made-up data and look-alikes are planted in the corpus's texts
(``pii_examples``), and base spans are rewritten in loose formats. Proposals that overlap a planted span
but are not it are negative. The corpus's own proposals have no label and are not learned from. Calibration and
thresholds come from formats that the trees were not fitted on.
"""

from __future__ import annotations

import bisect
import random
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filled_text
from .pii_examples import CUES, TLDS, planted

KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Starting inside a run of digits can't succeed where its start fails.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Loose formats beyond the base ones: runs of digit groups, four address parts, addresses up to each dot.
CHAIN = re.compile(r"(?<![\w.+])\(?[0-9]{1,8}(?:\)? ?[ .\-/_] ?\(?[0-9]{1,8}|\) ?[0-9]{1,8})+(?![\w])")
GROUP = re.compile(r"[0-9]+")
LOOSE_IP = re.compile(r"(?<![\w.])[0-9]{1,3}(?:(?: ?(?:[.,:]|[\[(]\.[\])]|[\[(]dot[\])]) ?| dot )[0-9]{1,3}){3}(?![\w])",
                      re.IGNORECASE)
AT = r" ?(?:[\[({]at[\])}]|@) ?| at "
LOOSE_MAIL = re.compile(rf"(?<![\w.])[A-Za-z0-9._%+-]{{1,64}}(?:{AT})[A-Za-z0-9-]{{1,63}}"
                        r"(?:(?: ?(?:\.|[\[({]dot[\])}]) ?| dot )[A-Za-z0-9-]{2,63}){1,3}", re.IGNORECASE)
MAIL_HINT = re.compile(r"[\[({]at[\])}]|@| at [A-Za-z0-9-]+ ?(?:[\[({]dot[\])}]| dot |\.)", re.IGNORECASE)
DOT = re.compile(r" ?(?:\.|[\[({]dot[\])}]) ?| dot ", re.IGNORECASE)
DIGIT = re.compile(r"[0-9]")

#: Bounds of what is fitted, examples per document, and the wanted precision of the added spans.
TRAIN_DOCS, TRAIN_SPANS, EXAMPLES, PRECISION = 4_000, 30_000, 8, 0.99
TREES, DEPTH, RATE, BINS, LEAST = 80, 4, 0.2, 16, 10


def luhn(digits: str) -> bool:
    total = 0
    for at, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if at % 2:
            n = 2 * n - 9 if n > 4 else 2 * n
        total += n
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def base_emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        else:
            done = max(done, at)        # no start in this run can match
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans by kind as listed, then start."""
    out = [("email", *s) for s in base_emails(text)]
    if not DIGIT.search(text):
        return out
    for m in IP.finditer(text):
        if all(map(_small, m.group().split("."))):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
            out.append(("phone", *m.span()))
    return out


def _digit_runs(text: str):
    """Phone and card proposals: each run of 2 to 7 neighbouring groups with 9 to 15 digits, and each run
    of 3 to 5 groups that passes as a card."""
    for chain in CHAIN.finditer(text):
        groups = [m.span() for m in GROUP.finditer(text, *chain.span())]
        for at, (start, stop) in enumerate(groups):
            start -= start > 0 and text[start - 1] == "(" and text[stop:stop + 1] == ")"
            n = 0
            for many, (a, b) in enumerate(groups[at:at + 7], 1):
                n += b - a
                if n > 19:
                    break
                if many > 1 and n >= 9:
                    if n <= 15:
                        yield "phone", start, b
                    if 3 <= many <= 5 and n >= 13 and luhn("".join(text[x:y] for x, y in groups[at:at + many])):
                        yield "card", start, b


def _mails(text: str):
    """Written-out addresses: one proposal for each dot that can be the last."""
    for m in LOOSE_MAIL.finditer(text):
        dots = list(DOT.finditer(text, m.start(), m.end()))
        for dot, after in zip(dots, [*dots[1:], None]):
            end = after.start() if after else m.end()
            if end > dot.end() and text[dot.end():end].isalpha():
                yield "email", m.start(), end


def proposals(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Loose spans that touch no base span; they may overlap each other, of one kind or several."""
    taken = sorted((s, e) for _, s, e in base)
    starts = np.array([s for s, _ in taken])
    ends = np.maximum.accumulate(np.array([e for _, e in taken])) if taken else starts
    found: list[tuple[str, int, int]] = list(_mails(text)) if MAIL_HINT.search(text) else []
    if DIGIT.search(text):
        found += _digit_runs(text)
        found += [("ip", *m.span()) for m in LOOSE_IP.finditer(text) if all(map(_small, GROUP.findall(m.group())))]
    out = []
    for kind, s, e in found:
        before = np.searchsorted(starts, e) - 1
        if before < 0 or ends[before] <= s:
            out.append((kind, s, e))
    return out


def _cued(kind: str, left: str) -> bool:
    return any(re.search(rf"\b{re.escape(c)}\b", left) for c in CUES[kind])


def describe(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context of a span, as numbers."""
    span, left, right = text[start:end], text[max(0, start - 24):start], text[end:end + 24]
    digits = [c for c in span if "0" <= c <= "9"]
    parts = GROUP.findall(span)
    groups = [len(g) for g in parts]
    numbers = [int(g) for g in parts if len(g) <= 6]
    between = {x for x in re.split(r"[0-9]+", span)[1:-1]}
    low = span.lower()
    last = re.split(r"[^a-z]+", low)[-1] if kind == "email" else ""
    return [
        float(KINDS.index(kind)), float(len(span)), float(len(digits)), float(len(groups)),
        float(max(groups, default=0)), float(min(groups, default=0)),
        float(groups[0] if groups else 0), float(groups[-1] if groups else 0),
        float(groups[1] if len(groups) > 1 else 0), float(max(numbers, default=0)),
        float(len(digits) > 1 and luhn("".join(digits))), float("(" in span), float(span[:1] == "0"),
        float(span[:2] == "00"), float(len(between)), float(sum(1900 <= n < 2040 for n in numbers)),
        float(sum(c in "-/" for c in span)), float("." in span), float("," in span or ":" in span),
        float(span.count(" ")), float("  " in span), float("[" in span or "{" in span or "(" in span),
        float("@" in span or bool(re.search(r"[\[({]at[\])}]", low))),
        float(" dot " in low or bool(re.search(r"[\[({]dot[\])}]", low))),
        float(bool(re.search(r"\.\s", span))), float(any(last == t.split(".")[-1] for t in TLDS)), float(len(last)),
        float(any(c.isupper() for c in span[-4:])), float(len(set(digits))),
        float(sum(c.isdigit() for c in left[-8:])), float(sum(c.isdigit() for c in right[:8])),
        float(sum(c in "|%$#&*=<>{}" for c in left[-8:] + right[:8])), float(_cued(kind, left.lower())),
        float(left[-1:].isspace() or not left),
    ]


def rewritten(text: str, kind: str, start: int, end: int):
    """A base span in a loose format, in its surroundings: (text, start, end) or None."""
    span, left, right = text[start:end], text[max(0, start - 24):start], text[end:end + 24]
    digits = "".join(c for c in span if "0" <= c <= "9")
    if kind == "email":
        local, _, domain = span.partition("@")
        new = f"{local} [at] {domain}" if len(span) % 2 else f"{local} at {domain.replace('.', ' dot ')}"
    elif kind == "ip":
        new = span.replace(".", ", " if len(span) % 2 else " . ")
    elif kind == "card":
        new = ".".join(digits[i:i + 4] for i in range(0, len(digits), 4))
    else:
        tail = digits[-10:]
        new = (f"({tail[:3]}) {tail[3:6]}-{tail[6:]}", f"{tail[:3]}-{tail[3:6]}-{tail[6:]}",
               f"{tail[:3]}.{tail[3:6]}.{tail[6:]}")[len(left.split()) % 3]
    return left + new + right, len(left), len(left) + len(new)


def _edges(values: np.ndarray) -> np.ndarray:
    """Bounds between at most BINS bins: between all values if they are few, else at quantiles."""
    seen = np.unique(values)
    if len(seen) <= BINS:
        return (seen[1:] + seen[:-1]) / 2
    return np.unique(np.quantile(values, np.linspace(0, 1, BINS + 1)[1:-1]))


@dataclass
class Trees:
    """Gradient-boosted trees on binned features, with a calibration per score."""

    edges: list = field(default_factory=list)
    trees: list = field(default_factory=list)
    start: float = 0.0
    calibration: tuple[float, float] = (0.0, 1.0)
    thresholds: dict[str, float] = field(default_factory=dict)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, j], "right")
                                for j, e in enumerate(self.edges)])

    def raw(self, x: np.ndarray) -> np.ndarray:
        binned, out = self.bins(x), np.full(len(x), self.start)
        for tree in self.trees:
            node = np.zeros(len(x), dtype=int)
            for _ in range(DEPTH):
                f, cut = tree[0][node], tree[1][node]
                node = 2 * node + 1 + (binned[np.arange(len(x)), f] > cut)
            out += tree[2][node - (2 ** DEPTH - 1)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        a, b = self.calibration
        return 1 / (1 + np.exp(-np.clip(a + b * self.raw(x), -30, 30)))

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.edges = [_edges(c) for c in x.T]
        binned = self.bins(x)
        rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(rate / (1 - rate)))
        score = np.full(len(y), self.start)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, p * (1 - p) + 1e-6
            feature, cut = np.zeros(2 ** DEPTH - 1, int), np.full(2 ** DEPTH - 1, BINS)
            node = np.zeros(len(y), dtype=int)
            for level in range(DEPTH):
                for n in range(2 ** level - 1, 2 ** (level + 1) - 1):
                    own = np.flatnonzero(node == n)
                    if len(own) < 2 * LEAST:
                        continue
                    best = 1e-6
                    total = g[own].sum() ** 2 / h[own].sum()
                    for j in range(x.shape[1]):
                        b = binned[own, j]
                        gs, hs, ns = (np.cumsum(np.bincount(b, w, BINS))[:-1]
                                      for w in (g[own], h[own], None))
                        ok = (ns >= LEAST) & (len(own) - ns >= LEAST)
                        if not ok.any():
                            continue
                        gain = np.where(ok, gs ** 2 / np.maximum(hs, 1e-9)
                                        + (g[own].sum() - gs) ** 2
                                        / np.maximum(h[own].sum() - hs, 1e-9) - total, -1)
                        if gain.max() > best:
                            best, feature[n], cut[n] = gain.max(), j, int(gain.argmax())
                node = 2 * node + 1 + (binned[np.arange(len(y)), feature[node]] > cut[node])
            leaf = node - (2 ** DEPTH - 1)
            value = RATE * np.bincount(leaf, g, 2 ** DEPTH) / (np.bincount(leaf, h, 2 ** DEPTH) + 1.0)
            self.trees.append((feature, cut, value))
            score += value[leaf]
        return self


def _labelled(text: str, kind: str | None, start: int, end: int):
    """Proposals in or over a planted span, and whether they are it."""
    base = base_spans(text)
    for k, s, e in proposals(text, base):
        if s < end and e > start:
            yield int((k, s, e) == (kind, start, end)), describe(text, k, s, e)


def _training_rows(batches):
    """Rows (doc_id, start, held_out, y, x): examples planted in each text, half of them in the formats for
    the thresholds, and its base spans rewritten."""
    for batch in batches:
        rows: list[tuple] = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rng = random.Random(f"{doc_id}")
            for n in range(EXAMPLES):
                example = planted(rng, text, n % 2 == 1)
                rows += [(doc_id, -1 - n, n % 2, y, x) for y, x in _labelled(*example)]
            for kind, s, e in base_spans(text):
                text2, s2, e2 = rewritten(text, kind, s, e)
                rows += [(doc_id, s, 0, y, x) for y, x in _labelled(text2, kind, s2, e2)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in rows], t) for c, t in enumerate(
                (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.float64())))],
            names=["doc_id", "start", "held_out", "y", "x"])


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS, train_spans: int = TRAIN_SPANS) -> Trees:
    """Fit trees, calibration and thresholds on examples in about `train_docs` documents,
    chosen by the hash of their id, and at most `train_spans` proposals. With fewer than
    two classes nothing is added to the base spans."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), filled_text().alias("text"))
    share = max(1, rows.count() // train_docs)
    some = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0)
    spans = (some.mapInArrow(_training_rows, "doc_id bigint, start bigint, held_out int, y int, x array<double>")
             .orderBy(F.xxhash64("doc_id", "start", "y"), "x").limit(train_spans).collect())
    model = Trees()
    y = np.array([r["y"] for r in spans], dtype=float)
    fold = np.array([r["held_out"] for r in spans], dtype=bool)
    if len(y) < 4 * LEAST or len(set(y[~fold])) < 2 or len(set(y[fold])) < 2:
        return model
    x = np.array([r["x"] for r in spans])
    model.fit(x[~fold], y[~fold])
    from .toxicity import fit_curve

    raw = model.raw(x[fold])
    model.calibration = tuple(fit_curve(np.column_stack([np.ones(len(raw)), raw]), y[fold]))
    p = model.probability(x[fold])
    for at, kind in enumerate(KINDS):
        own = x[fold][:, 0] == at
        order = np.argsort(-p[own], kind="stable")
        hits = np.cumsum(y[fold][own][order])
        good = np.flatnonzero(hits / np.arange(1, len(order) + 1) >= PRECISION)
        if len(good) and hits[good[-1]] >= 5:
            model.thresholds[kind] = max(0.5, float(p[own][order][good[-1]]))
    return model


def added_spans(text: str, base: list, model: Trees) -> list[tuple[str, int, int]]:
    """Proposals over their kind's threshold; of overlapping ones the likeliest."""
    if not model.thresholds:
        return []
    found = [s for s in proposals(text, base) if s[0] in model.thresholds]
    if not found:
        return []
    p = model.probability(np.array([describe(text, *s) for s in found]))
    chosen: list[tuple[str, int, int]] = []
    end_of: list[tuple[int, int]] = []
    for at in np.argsort(-p, kind="stable"):
        kind, s, e = found[at]
        if p[at] >= model.thresholds[kind]:
            k = bisect.bisect(end_of, (s, e))
            if (k == 0 or end_of[k - 1][1] <= s) and (k == len(end_of) or end_of[k][0] >= e):
                end_of.insert(k, (s, e))
                chosen.append((kind, s, e))
    return chosen


def _order(spans):
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def _find(model: Trees):
    def run(batches):
        for batch in batches:
            base_all, all_spans = [], []
            for text in batch.column(1).to_pylist():
                base = base_spans(text)
                base_all.append(base)
                all_spans.append(_order(base + added_spans(text, base, model)))
            listed = lambda x: pa.array(
                [[{"kind": k, "start": s, "end": e} for k, s, e in r] for r in x], SPANS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), listed(base_all), listed(all_spans)],
                names=["doc_id", "base", "spans"])
    return run


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
SPANS_DDL = "array<struct<kind:string,start:bigint,end:bigint>>"


def find_spans(docs: DataFrame, model: Trees) -> DataFrame:
    """doc_id, base spans and all spans of every row, by kind, then start; offsets are
    code points, ends exclusive.

    Null and empty texts have no spans; repeated rows give repeated results; other columns
    are not read. Texts are read whole. Rows are independent of each other.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), filled_text().alias("text"))
    return rows.mapInArrow(_find(model), f"doc_id bigint, base {SPANS_DDL}, spans {SPANS_DDL}")


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; overlaps are joined."""
    out, done = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= done:
            out += [text[done:s], f"[{kind}]"]
        done = max(done, e)
    return "".join(out) + text[done:]


def digest(found: DataFrame) -> DataFrame:
    """Counts of base spans and both span lists written out."""
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
                        F.sha2(text(F.col("base")), 256).alias("base_sha256"),
                        text(F.col("spans")).alias("spans"))
