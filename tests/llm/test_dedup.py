import glob
import hashlib
import os
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from basketlens.llm import common, exact_dedup, graph, near_dedup, substring_dedup
from basketlens.llm.shingles import shingle_set, words

from .helpers import DOC_SCHEMA, WORDS, doc_rows, docs, no_docs, prose, tuples


# --- exact dedup ------------------------------------------------------------------

def test_exact_dedup_equals_grouping_the_texts(spark):
    groups = defaultdict(list)
    for doc_id, text, *_ in doc_rows():
        groups[text or ""].append(doc_id)
    want = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        seen = set()
        for i in ids:
            want.append((i, keep, len(ids), i == keep and i not in seen,
                         hashlib.sha256(text.encode()).hexdigest()))
            seen.add(i)
    got = tuples(exact_dedup.exact_dedup(docs(spark)), "doc_id", "keep_id", "group_size", "kept",
                 "text_sha256")
    assert got == sorted(want, key=str)


def test_exact_dedup_keeps_one_full_row_of_each_text(spark):
    kept = exact_dedup.drop_copies(docs(spark))
    assert kept.columns == docs(spark).columns
    rows = kept.collect()
    assert len({r.text or "" for r in rows}) == len(rows) == len({t or "" for _, t, *_ in doc_rows()})


def test_exact_dedup_of_an_empty_table(spark):
    assert exact_dedup.exact_dedup(no_docs(spark)).count() == 0
    assert exact_dedup.drop_copies(no_docs(spark)).count() == 0


def test_clashing_chunk_identifiers_are_found(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(exact_dedup, "_identifier",
                        lambda c, seed: (F.length(c).cast("bigint"), F.lit(0).cast("bigint")))
    one = spark.createDataFrame([("abc",), ("abd",)], "text string")
    assert exact_dedup.clashing_identifiers(one, 0).count() == 1
    with pytest.raises(ValueError):
        exact_dedup.verified_seed(one)


def test_chunks_put_together_are_the_text(spark):
    rows = docs(spark).selectExpr("coalesce(text, '') AS text")
    from pyspark.sql import functions as F

    joined = rows.select("text", F.array_join(exact_dedup._chunks(F.col("text")), "").alias("j"))
    assert joined.filter("text <> j").count() == 0


# --- near dedup --------------------------------------------------------------------

def brute_components(rows, k, percent):
    sets = []
    for doc_id, text, *_ in rows:
        own = words(text or "")
        size = min(k, len(own))
        sets.append((doc_id, {tuple(own[i:i + size]) for i in range(len(own) - size + 1)}
                     if own else set()))
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            both = len(a & b)
            if a and b and 100 * both >= percent * (len(a) + len(b) - both):
                parent[root(i)] = root(j)
    low = defaultdict(list)
    for i, (doc_id, _) in enumerate(sets):
        if doc_id is not None:
            low[root(i)].append(doc_id)
    out = []
    for i, (doc_id, s) in enumerate(sets):
        label = min(low[root(i)], default=None) if s else doc_id
        out.append((doc_id, len(s), label, doc_id is not None and doc_id == label))
    return sorted(out, key=str)


def test_near_dedup_equals_brute_force(spark):
    for k in (4, 5):
        got = tuples(near_dedup.near_dedup(docs(spark), words=k), "doc_id", "n_shingles",
                     "component_id", "kept")
        assert got == brute_components(doc_rows(), k, 80)


def test_near_dedup_of_a_loose_hot_group(spark, monkeypatch):
    """Many edited copies of one text: some reach the group only through others."""
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    monkeypatch.setattr(near_dedup, "STAR_ROUNDS", 1)
    rng = random.Random(11)
    base = prose(rng, 150).split()
    rows = []
    for i in range(150):
        own = list(base)
        for _ in range(rng.choice((0, 1, 2, 4, 6, 8))):
            own[rng.randrange(len(own))] = rng.choice(WORDS)
        rows.append((i, " ".join(own), "en", "s", 0, *"abcde"))
    rows += [(1000 + i, prose(rng, 80), "en", "s", 0, *"abcde") for i in range(30)]
    got = tuples(near_dedup.near_dedup(spark.createDataFrame(rows, DOC_SCHEMA), words=4), "doc_id",
                 "n_shingles", "component_id", "kept")
    assert got == brute_components(rows, 4, 80)


def test_near_dedup_edges(spark):
    assert near_dedup.near_dedup(no_docs(spark)).count() == 0
    kept = near_dedup.drop_near_copies(docs(spark))
    assert kept.columns == docs(spark).columns and kept.filter("doc_id IS NULL").count() == 0


def test_a_band_that_agrees_in_its_low_bits_only_is_not_shared():
    left = np.arange(128, dtype="<u4") << 8
    right = left.copy()
    right[0] ^= 1 << 16
    side = lambda rid, sig: [(1, rid, rid, sig.tobytes())]
    found = list(near_dedup._open_pairs(side(1, left), side(2, right), near_dedup.fewest_matches(0.8)))
    assert [i.tolist() for i, _, _ in found] == [[0]] and found[0][2].tolist() == [127]


def test_bayes_bounds_rise_and_keep_true_pairs():
    least = near_dedup.fewest_matches(0.8)
    assert list(least) == [32, 64, 96, 128] and least[32] < 0.8 * 32
    rng = np.random.default_rng(1)
    hits = rng.random((20000, 128)) < 0.8
    keep = near_dedup.survivors(hits.astype("u2"), np.ones_like(hits, dtype="u2"), least)
    assert len(keep) == 20000
    assert len(near_dedup.survivors((rng.random((2000, 128)) < 0.4).astype("u2"),
                                    np.ones((2000, 128), "u2"), least)) == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = dict(tuple(r) for r in graph.components(
        spark.createDataFrame(links, "a bigint, b bigint"), "a", "b").collect())
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint"), "a", "b").count() == 0


# --- substring dedup ----------------------------------------------------------------

@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 12), min_size=1, max_size=60), st.integers(2, 9))
def test_compact_windows_are_the_wide_cartesian_nodes(values, width):
    h = np.array(values, dtype=np.uint64)
    want = []
    for i, v in enumerate(values):
        left = i
        while left > 0 and values[left - 1] > v:
            left -= 1
        right = i
        while right + 1 < len(values) and values[right + 1] >= v:
            right += 1
        if right - left + 1 >= width:
            want.append((i, max(left, i - width + 1)))
    assert list(zip(*(x.tolist() for x in substring_dedup.compact_windows(h, width)))) == want


def test_equal_passages_always_share_a_signature():
    rng = random.Random(3)
    for _ in range(30):
        passage = prose(rng, 51)
        a, b = (substring_dedup._tokens(f"{prose(rng, rng.randrange(200))} {passage} "
                                        f"{prose(rng, rng.randrange(200))}") for _ in range(2))
        shared = np.intersect1d(substring_dedup.signatures(a), substring_dedup.signatures(b))
        assert len(shared)
        spans = substring_dedup.passages(a, b)
        assert spans and max(e - s for s, e in spans) >= 51


def test_repeated_passages_against_brute_force(spark):
    rows = [r for r in doc_rows() if r[0] is not None]
    plain = {}
    for doc_id, text, *_ in rows:
        plain[doc_id] = substring_dedup._tokens(text or "")
    want = defaultdict(set)
    for a, x in plain.items():
        for b, y in plain.items():
            if a != b:
                grams = {tuple(y[j:j + 46]) for j in range(len(y) - 45)}
                for i in range(len(x) - 45):
                    if tuple(x[i:i + 46]) in grams:
                        want[a].update(range(i, i + 50))
    got = defaultdict(set)
    for r in substring_dedup.repeated_passages(docs(spark)).collect():
        got[r.doc_id].update(range(r.start_word, r.end_word))
        assert r.removable == (r.first_doc_id < r.doc_id) and r.first_doc_id in plain
    assert set(want) <= set(got)
    for doc_id, places in want.items():
        assert places <= got[doc_id]
    near = {a for a, x in plain.items() for b, y in plain.items()
            if a != b and len(np.intersect1d(x, y)) >= substring_dedup.COMMON}
    assert set(got) <= near


def test_a_passage_may_hold_a_sentence_that_its_partner_repeats():
    rng = random.Random(21)
    line = prose(rng, 15)
    passage = f"{prose(rng, 18)} {line} {prose(rng, 18)}"
    x = substring_dedup._tokens(f"{prose(rng, 30)} {passage} {prose(rng, 20)}")
    y = substring_dedup._tokens(f"{line} {prose(rng, 25)} {line} {prose(rng, 9)} {passage}")
    assert any(s <= 30 and e >= 81 for s, e in substring_dedup.passages(x, y))
    assert any(s <= 64 and e >= 115 for s, e in substring_dedup.passages(y, x))


def test_passages_around_a_frequent_line(spark):
    """Pairs of documents share a passage around a line that all documents have."""
    rng = random.Random(22)
    line, rows = prose(rng, 44), []
    for pair in range(20):
        passage = f"{prose(rng, 4)} {line} {prose(rng, 4)}"
        rows += [(100 + pair, f"{prose(rng, 40)} {passage} {prose(rng, 40)}"),
                 (200 + pair, f"{prose(rng, 20)} {passage} {prose(rng, 60)}")]
    rows += [(i, f"{prose(rng, 60)} {line} {prose(rng, 60)}") for i in (1, 2, 998, 999)]
    got = defaultdict(set)
    for r in substring_dedup.repeated_passages(
            spark.createDataFrame(rows, "doc_id bigint, text string")).collect():
        got[r.doc_id].update(range(r.start_word, r.end_word))
    for pair in range(20):
        assert set(range(40, 92)) <= got[100 + pair] and set(range(20, 72)) <= got[200 + pair]


def plain_alike(x, y):
    """Windows of x that y has nearly alike, by the definition, one window at a time."""
    sd, found = substring_dedup, []
    for i in range(len(x) - sd.WIDTH + 1):
        at_shift = defaultdict(set)
        for k in range(i, i + sd.WIDTH):
            for j in np.flatnonzero(y == x[k]).tolist():
                at_shift[j - k].add(k)
        found.append(any(
            len(own) >= sd.SAME_SHIFT and sd.COMMON <= len(set().union(
                *(v for s, v in at_shift.items() if abs(s - shift) <= sd.DRIFT)))
            for shift, own in at_shift.items()))
    return found


@pytest.mark.parametrize("matches", [40, 1 << 20])
def test_alike_windows_equal_the_definition_however_much_is_looked_at(monkeypatch, matches):
    monkeypatch.setattr(substring_dedup, "MATCHES", matches)
    rng, seen = random.Random(31), 0
    for _ in range(60):
        x = [rng.randrange(rng.choice((3, 60))) for _ in range(rng.randrange(40, 150))]
        y = [t for t in x[rng.randrange(20):] if rng.random() > 0.03] + x[:rng.randrange(1, 30)]
        for _ in range(rng.randrange(8)):
            y.insert(rng.randrange(len(y)), rng.randrange(60))
        x, y = (np.array(t, dtype=np.uint64) for t in (x, y))
        got = substring_dedup.alike_windows(x, y).tolist()
        assert got == plain_alike(x, y)
        seen += any(got) and not all(got)
    assert seen > 5


@pytest.mark.parametrize("line_words", [0, 20])
def test_recall_of_passages_with_a_changed_word(spark, line_words):
    """Passages of 51 to 100 words, a word changed in the middle, in pairs of documents; with a
    line of many documents inside, or without."""
    rng = random.Random(32)
    line, rows = prose(rng, line_words), []
    for pair in range(200):
        n = rng.randrange(51, 101) - line_words
        words = f"{prose(rng, n // 2)} {line} {prose(rng, n - n // 2)}".split()
        changed = list(words)
        changed[len(words) // 2] += "x"
        rows += [(2 * pair + 10, f"{prose(rng, 50)} {' '.join(words)} {prose(rng, 60)}"),
                 (2 * pair + 11, f"{prose(rng, 30)} {' '.join(changed)} {prose(rng, 70)}")]
    rows += [(i, f"{prose(rng, 60)} {line} {prose(rng, 60)}") for i in (1, 2, 998, 999)]
    plain = {i: substring_dedup._tokens(t) for i, t in rows}
    want = {i for i in plain if i >= 10 and i < 990
            and any(plain_alike(plain[i], plain[i + 1 - 2 * (i % 2)]))}
    got = {r.doc_id for r in substring_dedup.repeated_passages(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got <= want and len(want) > 300 and len(got) >= 0.9 * len(want)


def test_documents_alike_around_a_frequent_line_all_meet(spark, monkeypatch):
    """Groups of documents that are alike to each other, not to the smallest documents with the line that
    holds their min-hashes; with chains, where the smallest of a group is alike to one of two only."""
    monkeypatch.setattr(substring_dedup, "BLOCK", 2)
    rng = random.Random(33)
    line, rows, groups = prose(rng, 38), [(i, None) for i in range(1, 9)], []
    for group in range(40):
        words = f"{prose(rng, 8)} {line} {prose(rng, 8)}".split()
        first, second = list(words), list(words)
        first[1 + group % 3] += "x"
        second[-2 - group % 3] += "y"
        ids = [100 + 3 * group + n for n in range(3)]
        groups.append(ids)
        rows += [(i, " ".join(w)) for i, w in zip(ids, (first, words, second))]
    rows = [(i, f"{prose(rng, 60)} {text or prose(rng, 9) + ' ' + line} {prose(rng, 60)}") for i, text in rows]
    plain = {i: substring_dedup._tokens(t) for i, t in rows}
    signs = {i: substring_dedup.signatures(x) for i, x in plain.items()}
    want = defaultdict(list)
    for ids in groups:
        for a in ids:
            for b in ids:
                if a != b and len(np.intersect1d(signs[a], signs[b])) and any(plain_alike(plain[a], plain[b])):
                    want[a].append(b)
    got = defaultdict(list)
    for r in substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect():
        got[r.doc_id].append(r)
    assert len(want) > 100 and set(got) == set(want)
    for a, others in want.items():
        assert {r.first_doc_id for r in got[a]} <= set(others)
        assert any(r.removable for r in got[a]) == (min(others) < a)


def test_rare_tokens_of_a_window_hold_one_of_any_alike_partner():
    rng, sd = random.Random(34), substring_dedup
    members = [np.array([rng.randrange(60) for _ in range(70)], dtype=np.uint64) for _ in range(9)]
    own = members[0]
    members += [np.where(np.arange(70) % 46 < 4, np.uint64(99), own), np.roll(own, 3)]
    values, counts = np.unique(np.concatenate([np.unique(m) for m in members[1:]]), return_counts=True)
    known = np.isin(values, own)
    starts = np.arange(len(own) - sd.WIDTH + 1)
    at, token = sd.rare_tokens(own, starts, values[known], counts[known])
    met = 0
    for other in members[1:]:
        for i in np.flatnonzero(sd.alike_windows(own, other)).tolist():
            met += 1
            assert np.isin(token[at == i], other).any()
    assert met > 20 and all(len(token[at == i]) <= sd.ROOM + 1 for i in starts)


def test_signatures_of_several_documents_are_those_of_each():
    texts = ["", "a", prose(random.Random(1), 70), "A\tb\x0bc \x1c d\u00a0e\u0085f " * 30, prose(random.Random(2), 49),
             prose(random.Random(3), 300), prose(random.Random(4), 50)]
    tokens, ends = substring_dedup._token_rows(pa.array(texts))
    got = sorted(zip(*(c.tolist() for c in substring_dedup.placed_signatures(tokens, ends))))
    want, at = [], 0
    for text, end in zip(texts, ends):
        x = substring_dedup._tokens(text)
        assert x.tolist() == tokens[at:end].tolist()
        want += [(s, a + at, b + at) for s, a, b in zip(*(c.tolist() for c in substring_dedup.placed_signatures(x)))]
        at = end
    assert got == sorted(want)


def test_steps_of_substring_dedup_leave_no_shuffle_files(spark):
    folder = os.environ.get("SPARK_LOCAL_DIRS") or spark.sparkContext.getConf().get("spark.local.dir", "/tmp")

    def files():
        return {f for d in folder.split(",") for f in glob.glob(f"{d}/blockmgr-*/*/shuffle_*")}
    passage = prose(random.Random(8), 60)
    rows = spark.createDataFrame([(i, f"{prose(random.Random(i), 20)} {passage}") for i in range(6)], "doc_id long, text string")
    before, setting = files(), spark.conf.get(common.CLEANUP, None)
    found = substring_dedup.repeated_passages(rows)
    assert not files() - before
    assert spark.conf.get(common.CLEANUP, None) == setting
    assert found.count() == 6


def test_substring_dedup_of_an_empty_table(spark):
    assert substring_dedup.repeated_passages(no_docs(spark)).count() == 0


def test_shingles_of_short_texts():
    assert len(shingle_set("", 4)) == 0 and len(shingle_set("a b", 4)) == 1
    assert shingle_set("A b", 4) == shingle_set("a  B", 4) != shingle_set("a b c", 4)
