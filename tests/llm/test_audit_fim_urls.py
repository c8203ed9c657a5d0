"""Source divergence audit, fill-in-middle and url filters against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from basketlens.llm import divergence, fill_middle, url_filter

from .helpers import DOC_SCHEMA, doc_rows, docs, no_docs, prose, tuples

# --- divergence ---------------------------------------------------------------------


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain_audit(rows, min_docs, top=50):
    """The contract read word by word, in Python integers."""
    n, seen, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered(text or ""))
        n[lang, source].update(terms)
        seen[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = {t for t, c in seen[lang].items() if c >= min_docs}
        own = {s: {t: n[lang, s][t] for t in kept} for g, s in groups if g == lang}
        every = {t: sum(c[t] for c in own.values()) for t in kept}

        def shares(c):
            return {t: 1 + 10 ** 9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}
        p, q = {s: shares(c) for s, c in own.items()}, shares(every)
        for s in own:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in own if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda f: (-f[0], f[1].encode()))
                if part == "term":
                    found = found[:top]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found)]
    return sorted(out)


def audit_rows():
    rng = random.Random(9)
    words = [prose(rng, 1) for _ in range(40)] + ["Ünder", "über", "漢字", "A1b", "x-y", "İx", "ſ", "\x00a"]
    rows = []
    for i in range(260):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(0, 25)))
        rows.append((text if i % 11 else None, ["en", "de", None][i % 3], [None, "a", "b", "c"][i % 4]))
    rows += [("", "fr", "only"), ("rare word", "fr", "two"), ("once", "it", "alone")]
    return rows + rows[:5]


@pytest.mark.parametrize("cells,handed", [(4_000_000, 1_000_000), (60, 10)])
def test_audit_equals_brute_force(spark, monkeypatch, cells, handed):
    """Also with shards of a few terms and partial counts handed on early (the latter reaches the
    worker only through a pickled function, so it is called here directly)."""
    monkeypatch.setattr(divergence, "SHARD_CELLS", cells)
    rows = audit_rows()
    frame = spark.createDataFrame([(i, *r, "x", "y") for i, r in enumerate(rows)],
                                  "doc_id bigint, text string, lang string, source string, term string, n string")
    got = tuples(divergence.audit(frame.repartition(5), min_docs=8), "lang", "source", "part", "item",
                 "value", "rank")
    assert got == sorted(plain_audit(rows, 8), key=str)
    monkeypatch.setattr(divergence, "SHARD_ROWS", handed)
    monkeypatch.setattr(divergence, "HANDED_ON", handed)
    full = [tuple(c or "" for c in r) for r in rows]
    batches = [pa.record_batch([pa.array([r[i] for r in full[at:at + 20]]) for i in (1, 2, 0)],
                               names=["lang", "source", "text"]) for at in range(0, len(full), 20)]
    totals = Counter()
    for batch in divergence._partial_counts(iter(batches)):
        for r in batch.to_pylist():
            totals[r["lang"], r["source"], r["term"]] += r["n"]
    want = Counter()
    for text, lang, source in full:
        want.update((lang, source, t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered(text)))
    assert {k: v for k, v in totals.items() if k[2] is not None} == dict(want)


def test_audit_of_awkward_rows(spark):
    got = tuples(divergence.audit(docs(spark), min_docs=3), "lang", "source", "part", "item", "value", "rank")
    assert got == sorted(plain_audit([(r[1], r[2], r[3]) for r in doc_rows()], 3), key=str)
    assert divergence.audit(no_docs(spark)).count() == 0


def test_shares_are_exact():
    import numpy as np

    rng = random.Random(1)
    for _ in range(2000):
        total = rng.randrange(1, 9 * 10 ** 15)
        count = rng.randrange(total + 1)
        assert int(divergence.share(np.array([count]), total)[0]) == 1 + 10 ** 9 * count // total


# --- fill in the middle ---------------------------------------------------------------

def plain_fim(doc_id, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    n = len(units)
    h = hashlib.sha256(("42:" + ("" if doc_id is None else str(doc_id))).encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in range(0, 32, 8))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, n)))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    form = "spm" if h4 % 100 < 80 else "psm"
    out = f"<S>{suf}<P>{pre}<M>{mid}" if form == "spm" else f"<P>{pre}<S>{suf}<M>{mid}"
    return doc_id, n, form, len(pre), len(mid), sha(out), sha(text)


FIM = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


def fim_rows():
    extra = ("x", "y", "z", "r", "q")
    rng = random.Random(3)
    texts = ["<P> a b c", "a <S>", "x <M", "<<S", "P> b <", "  lead", "trail \n\t", "\x0b\x0c", " ", "one",
             "a\x1cb\x85c\xa0d", "é 漢字 🙂 ſ", prose(rng, 9000), "w" * 300_000, "a " * 50_000]
    rows = [(i, t, "en", "s", 1, *extra) for i, t in enumerate(texts * 8)]
    return doc_rows() + rows + rows[3:9] * 3 + [(None, "null id " + prose(rng, 20), None, None, None, *extra)] * 2


@pytest.mark.parametrize("size", [7, fill_middle.CHUNK])
def test_fim_equals_brute_force(spark, size):
    rows = fim_rows()
    frame = spark.createDataFrame(rows, DOC_SCHEMA).repartition(6)
    got = tuples(fill_middle.digests(frame if size > 7 else frame.filter("length(text) < 5000"), size=size), *FIM)
    want = [plain_fim(r[0], r[1]) for r in rows if size > 7 or (r[1] is not None and len(r[1]) < 5000)]
    assert got == sorted(want, key=str)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_fim_texts_come_back(spark):
    rows = fim_rows()
    frame = spark.createDataFrame(rows, DOC_SCHEMA)
    out = fill_middle.transform(frame, size=400)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert (sorted((str(r.doc_id), r.form, sha(r.output)) for r in out.collect())
            == sorted((str(w[0]), w[2], w[5]) for w in (plain_fim(r[0], r[1]) for r in rows)))
    assert tuples(fill_middle.restore(out), "doc_id", "text") == sorted(
        ((r[0], r[1] or "") for r in rows), key=str)


def test_fim_of_an_empty_table(spark):
    assert fill_middle.digests(no_docs(spark)).count() == 0
    assert fill_middle.digests(no_docs(spark)).columns == FIM
    assert fill_middle.transform(no_docs(spark)).count() == 0


def test_chunks_keep_units_whole():
    text = "ab  cd e\n\nfgh  "
    for size in range(1, 20):
        parts = list(fill_middle.chunks(text, 0, len(text), size))
        assert "".join(parts) == text
        ends = {m.end() for m in fill_middle.UNIT.finditer(text)}
        at = 0
        for part in parts:
            at += len(part)
            assert at in ends


# --- urls -------------------------------------------------------------------------------

def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return lowered(host), re.match(r"[^?#]*", rest[len(host):]).group()


def plain_rule(host, path, rules):
    fit = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    return max(fit, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[0] == "block"), default=None)


URLS = ["http://net/", "http://net", "https://a.NET/x", "https://b.example.net/en/1?q=/de/", "http://example.net/en",
        "http://example.com/de/", "http://sub.EXAMPLE.com/de/x#y", "http://notexample.com/de/", "http://x.org/fr/1",
        "http://x.org/FR/1", "http://x.org?u=://y.net/", "nothing", "", None, "://", "a://b://c.net/z", "http://ÄÖ.İ/ä",
        "http://example.com:80/de/", "http://casino-bonus.example.com/en/1", "http://www.newspaper.example.com/en/4",
        "http://x\ny.net/\n/en/", "http://example.com\\de/", "http://user@a.net/p", "http://" + "ab" * 40_000 + ".net/q",
        "http://h.example/" + "long/" * 30_000]


@pytest.fixture(scope="module")
def model(spark):
    return url_filter.fit(url_filter.labelled_urls(spark))


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "h", "p", "r", "s") for i, u in enumerate(urls)],
                                 "page_id bigint, url string, host string, path string, rule string, score string")


def plain_score(model, host, path):
    """The model's probability from the n-grams, with buckets by a table of their hashes."""
    grams = set()
    for mark, text in (("h", host), ("p", path)):
        if text:
            text = "^" + re.sub("[0-9]", "0", text) + "$"
            grams |= {(mark, text[i:i + k]) for k in url_filter.SIZES for i in range(len(text) - k + 1)}
    return grams


def test_urls_equal_brute_force(spark, model):
    import math

    rules = [*url_filter.RULES, ("allow", "a.net", "/x"), ("block", "net", "/en/"), ("allow", "net", "/en/")]
    urls = URLS * 2
    got = {r.page_id: r for r in url_filter.judge_urls(pages(spark, urls), model, rules).collect()}
    parts = [plain_parts(u) for u in urls]
    grams = [plain_score(model, *p) for p in parts]
    every = sorted(set().union(*grams))
    rows = spark.createDataFrame(every, "mark string, gram string").selectExpr(
        "mark", "gram", f"pmod(xxhash64(mark, gram), {url_filter.BUCKETS}) b").collect()
    bucket = {(r.mark, r.gram): r.b for r in rows}
    for i, (host, path) in enumerate(parts):
        row, rule = got[i], plain_rule(host, path, rules)
        assert (row.host, row.path) == (host, path)
        own = sorted({bucket[g] for g in grams[i]})
        linear = model.intercept + (sum(model.weights[b] for b in own) / math.sqrt(len(own)) if own else 0)
        assert row.score == pytest.approx(1 / (1 + math.exp(-linear)), abs=1e-9)
        assert row.rule == (rule and rule[1] + rule[2])
        assert row.verdict == (rule[0] if rule else "block" if row.score >= 0.5 else "allow")
    assert got[11].verdict == got[12].verdict == got[13].verdict == "allow"


def test_urls_of_an_empty_table(spark, model):
    assert url_filter.judge_urls(pages(spark, URLS).limit(0), model).count() == 0


def test_regression_on_hosts_it_has_not_seen(spark, model):
    rng = random.Random(11)
    words = "adult casino poker viagra porn pills bets spam-links ads-server click-track lotto xxx".split()
    bad = [f"http://{rng.choice(['www', 'm', 'blog'])}.{w}-{prose(rng, 1)}.example.com/{lang}/{rng.randrange(9999)}"
           for w in words for lang in ("en", "es")]
    good = [f"http://{prose(rng, 1)}{prose(rng, 1)}.example.com/{rng.choice(['en', 'es', 'fr'])}/{rng.randrange(9999)}"
            for _ in range(300)]
    out = url_filter.judge_urls(pages(spark, bad + good), model, rules=()).collect()
    verdicts = [r.verdict for r in sorted(out, key=lambda r: r.page_id)]
    assert verdicts[:len(bad)].count("block") >= 0.8 * len(bad)
    assert verdicts[len(bad):].count("allow") >= 0.97 * len(good)


def test_fit_with_one_label_only(spark):
    one = spark.createDataFrame([("http://a.example/", 1), (None, 0)], "url string, label int")
    assert url_filter.fit(one).intercept > 0
    assert url_filter.fit(one.limit(0)).intercept < 0
