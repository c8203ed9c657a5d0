import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from basketlens.llm import chat, mixing, pii, pii_examples, queries, topics, toxicity
from pyspark.sql import functions as F

from .helpers import DOC_SCHEMA, doc_rows, docs, no_docs, prose, tuples

DATA = "/root/testdata/sf0.01"


# --- toxicity -----------------------------------------------------------------------

def test_grammar_weighs_clauses():
    g = toxicity.Grammar({"idiot": 5.0, "lowe*": 4.0}, [-3.0, 2.0, 0.0, 0.0])
    plain = g.features("a word. they met an idiot there.")[0]
    assert g.features("a word. nothing here.") == (0.0, 0.0, 0.0) == g.features("")
    assert g.features("what an idiot there")[0] < g.features("you are an idiot")[0]
    assert g.features("he is not an idiot")[0] < g.features("he is an idiot")[0]
    assert g.features("she said he is an idiot")[0] < g.features("she met an idiot")[0] <= plain
    assert g.features('"idiot" and "idiot"')[0] < g.features("idiot and idiot")[0]
    assert g.symbol("lowest")[0] == "I" and g.symbol("you")[0] == "T"
    assert g.features("i will hurt you")[0] > 0 == g.features("wounds hurt badly")[0]


def every_path(symbols):
    """Best score over all paths through the three machines, one after the other."""
    chain = [toxicity.negation_machine(), toxicity.report_machine(), toxicity.target_machine()]

    def ends(machine, rows):
        paths = [(machine.start, (), 0.0)]
        for symbol, weight in rows:
            paths = [(to, (*written, (out, weight * f)) if out else written, score + weight * f)
                     for state, written, score in paths
                     for to, out, f in machine.arcs.get((state, symbol), ())]
        return [(written, score) for state, written, score in paths if state in machine.finals]
    ((one, _),) = ends(chain[0], symbols)
    ((two, _),) = ends(chain[1], one)
    return max(score for _, score in ends(chain[2], two))


def by_distance(symbols):
    """The clause's score by the rules in words, with places of words instead of states."""
    said, quoted, at, marks, targets, negated = False, False, 0, [], [], -99
    for symbol, weight in symbols:
        if symbol == "Q":
            quoted = not quoted
            continue
        if symbol in "IH":
            marks.append((at, symbol, weight, at - negated <= toxicity.REACH, said or quoted))
        said |= symbol == "R"
        negated = at if symbol == "N" else negated
        targets += [at] if symbol == "T" else []
        at += 1
    total = 0.0
    for at, symbol, weight, no, told in marks:
        if symbol == "I" or targets:
            near = any(abs(at - t) <= toxicity.DIRECT for t in targets)
            total += (weight * (toxicity.TARGET_FACTOR if near else 1) * (toxicity.NEGATION_FACTOR if no else 1)
                      * (toxicity.REPORT_FACTOR if told else 1))
    return total


@pytest.mark.parametrize("negation", [0.0, 0.25])
def test_composed_machine_equals_its_paths_and_its_rules(monkeypatch, negation):
    monkeypatch.setattr(toxicity, "NEGATION_FACTOR", negation)
    machine = toxicity.clause_machine.__wrapped__()
    rng = random.Random(11)
    for _ in range(600):
        symbols = [(s, rng.choice([0.5, 1.0, 4.0]) if s in "IH" else 0.0)
                   for s in rng.choices(toxicity.SYMBOLS, [3, 2, 2, 2, 1, 1, 6], k=rng.randrange(1, 15))]
        want = by_distance(symbols)
        assert machine.best(symbols) == pytest.approx(want), symbols
        assert every_path(symbols) == pytest.approx(want), symbols


@pytest.fixture(scope="module")
def grammar(spark):
    read = lambda t: spark.read.parquet(f"{DATA}/{t}.parquet")
    return toxicity.fit(read("documents"), read("labels"))


def test_negated_and_reported_clauses_score_less(grammar):
    assert min(grammar.curve[1:]) >= 0
    plain, said, no = (grammar.score(t) for t in ("you are an idiot.", "she said you are an idiot.",
                                                  "you are not an idiot."))
    assert plain >= toxicity.THRESHOLD > said > no
    assert grammar.score('"you are an idiot" is what it reads') < toxicity.THRESHOLD
    assert grammar.score("he called them worthless. but you are an idiot") >= toxicity.THRESHOLD
    assert plain >= grammar.score("an idiot") >= grammar.score("")


def test_each_word_list_changes_predictions(grammar):
    built = {"threats": "i will kill you.", "targets": "we will destroy them.", "negations": "you are not an idiot.",
             "reports": "she wrote you are an idiot."}
    for name, text in built.items():
        emptied = toxicity.Grammar(grammar.insults, grammar.curve, **{name: frozenset()})
        assert (grammar.score(text) >= toxicity.THRESHOLD) != (emptied.score(text) >= toxicity.THRESHOLD), name


def test_a_rising_curve_has_no_negative_weight():
    rng = np.random.default_rng(4)
    x = rng.random((400, 3))
    y = (3 * x[:, 0] - 2 * x[:, 1] + rng.normal(0, 0.3, 400) > 0.6).astype(float)
    w = toxicity.fit_rising_curve(x, y)
    assert min(toxicity.fit_curve(np.column_stack([np.ones(400), x]), y)[1:]) < 0 <= min(w[1:]) and w[1] > 1


def test_held_out_fold_is_the_crc_of_the_id(spark):
    import zlib

    got = spark.range(500).select("id", toxicity.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in got)


def test_toxicity_on_held_out_labels(spark):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    rows = queries.op2_toxicity(spark, DATA).join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 50
    agree = sum(r.predicted == r.toxic for r in rows) / len(rows)
    caught = [r.predicted for r in rows if r.toxic == 1]
    assert agree >= 0.9 and sum(caught) >= 0.7 * len(caught)


def test_labels_of_the_held_out_fold_are_not_used(spark):
    read = lambda t: spark.read.parquet(f"{DATA}/{t}.parquet")
    other = read("labels").withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic"))
                                      .otherwise(F.col("toxic")))
    a, b = toxicity.fit(read("documents"), read("labels")), toxicity.fit(read("documents"), other)
    assert a.insults == b.insults and a.curve == pytest.approx(b.curve)


def test_toxicity_edges(spark):
    nothing = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    grammar = toxicity.fit(docs(spark), nothing)
    scored = toxicity.score_documents(docs(spark), grammar)
    assert scored.count() == len(doc_rows())
    assert scored.filter("score < 0 OR score > 1 OR score IS NULL OR held_out IS NULL").count() == 0
    assert toxicity.score_documents(no_docs(spark), grammar).count() == 0
    kept = toxicity.drop_toxic(docs(spark), grammar)
    assert kept.columns == docs(spark).columns and kept.count() == len(doc_rows())


# --- personal data -------------------------------------------------------------------

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub(r"\D", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and sum(
                    sum(map(int, str(int(d) * (1 + i % 2)))) for i, d in enumerate(digits[::-1])) % 10 == 0):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(8)
    pieces = ["a@b.c", "x.y@z-w.co", "1.2.3.4", "300.1.1.1", "4111 1111 1111 1111", "4111-1111", "+1 (555)",
              "+49 30 1234567", " ", "@", ".", "é", "12", "_", "-", "+", "a", "(5)", "0.0.0.0.7.8.9.1"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(14)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_base_spans_of_long_runs_take_linear_time():
    for text in ("a" * 200_000 + "@", "1" * 200_000, "1." * 100_000, "+1" + " " * 200_000, "a@" * 50_000):
        pii.base_spans(text)


def test_added_spans_touch_no_base_span_and_base_spans_stay(spark):
    docs_ = spark.read.parquet(f"{DATA}/documents.parquet")
    model = pii.fit(docs_)
    for row in pii.find_spans(docs_, model).collect():
        base, spans = ([(s.kind, s.start, s.end) for s in x] for x in (row.base, row.spans))
        assert set(base) <= set(spans)
        for _, s, e in set(spans) - set(base):
            assert all(e <= a or s >= b for _, a, b in base)


def test_boosted_trees_learn_rewritten_formats():
    rng = random.Random(1)
    rows = []
    for _ in range(600):
        number = f"+1 ({rng.randrange(200, 999)}) {rng.randrange(100, 999)}-{rng.randrange(1000, 9999)}"
        text = f"{prose(rng, 6)} {number} {prose(rng, 6)}"
        new, s, e = pii.rewritten(text, "phone", text.index("+"), text.index("+") + len(number))
        rows += [(pii.describe(new, *p), 1) for p in pii.proposals(new, []) if p[0] == "phone"]
        noise = f"| {rng.randrange(99)} {rng.randrange(10, 99)} | {rng.randrange(10, 99)}-{rng.randrange(10, 99)} |"
        rows += [(pii.describe(noise, *p), 0) for p in pii.proposals(noise, [])]
    x, y = np.array([r[0] for r in rows]), np.array([float(r[1]) for r in rows])
    half = len(y) // 2
    model = pii.Trees().fit(x[:half], y[:half])
    assert ((model.raw(x[half:]) > 0) == (y[half:] == 1)).mean() > 0.97


@pytest.fixture(scope="module")
def trees(spark):
    return pii.fit(spark.read.parquet(f"{DATA}/documents.parquet"))


@pytest.mark.parametrize("held_out", [False, True])
def test_planted_data_is_found_and_look_alikes_are_not(trees, held_out):
    """Recall and precision of the added spans per kind, in formats fitted on and in others."""
    rng = random.Random(77)
    planted, right, wrong = ({k: 0 for k in pii.KINDS} for _ in range(3))
    for _ in range(2400):
        text, kind, start, end = pii_examples.planted(rng, prose(rng, 40), held_out)
        base = pii.base_spans(text)
        if kind and any(s < end and e > start for _, s, e in base):
            continue
        got = pii.added_spans(text, base, trees)
        if kind:
            planted[kind] += 1
            right[kind] += (kind, start, end) in got
        for span in got:
            wrong[span[0]] += span != (kind, start, end)
    for kind in pii.KINDS:
        assert planted[kind] > 200
        assert right[kind] >= 0.8 * planted[kind], kind
        assert right[kind] >= 0.95 * (right[kind] + wrong[kind]), kind


def test_nothing_is_added_to_plain_prose(spark, trees):
    found = pii.find_spans(spark.read.parquet(f"{DATA}/documents.parquet"), trees)
    assert found.filter("size(spans) > size(base)").count() == 0


def test_of_overlapping_kinds_one_is_chosen(trees):
    text = "ba ra sen card 4111.1111.1111.1111 lo ti vo"
    kinds = {k for k, _, _ in pii.proposals(text, pii.base_spans(text))}
    assert kinds == {"card", "phone"}
    assert pii.added_spans(text, pii.base_spans(text), trees) == [("card", 15, 34)]
    text = "write to john [at] example.com. Tihe 12 men"
    assert pii.added_spans(text, pii.base_spans(text), trees) == [("email", 9, 30)]


def test_made_up_cards_pass_and_failing_ones_do_not():
    rng = random.Random(2)
    for _ in range(200):
        assert pii.luhn("".join(pii_examples.card(rng))) and not pii.luhn("".join(pii_examples.card(rng, False)))
        text, kind, s, e = pii_examples.planted(rng, rng.choice(["", "x", "one two three"]), False)
        assert 0 <= s < e <= len(text)


def test_proposals_of_long_runs_take_little_time():
    for text in ("1 " * 60_000, "a at " * 40_000, "(" * 100_000, "12." * 50_000, "@ " * 50_000):
        pii.proposals(text, [])


def test_pii_query_columns_and_edges(spark):
    got = tuples(pii.digest(pii.find_spans(docs(spark), pii.Trees())), "doc_id", "n_phone", "spans")
    assert got == sorted([(r[0], 0, "") for r in doc_rows()], key=str)
    assert pii.find_spans(no_docs(spark), pii.fit(no_docs(spark))).count() == 0
    assert pii.redact("mail a@b.c now", [("email", 5, 10)]) == "mail [email] now"
    one = spark.createDataFrame([(1, "é a@b.c 1.2.3.4")], "doc_id bigint, text string")
    row = pii.digest(pii.find_spans(one, pii.Trees())).first()
    import hashlib

    assert row.spans == "email:2:7,ip:8:15" and row.n_email == row.n_ip == 1
    assert row.base_sha256 == hashlib.sha256(row.spans.encode()).hexdigest()


# --- chat ------------------------------------------------------------------------------

def plain_chats(rows):
    chats = {}
    for conv, turn, role, text, *_ in set(rows):
        if conv is not None and turn is not None:
            chats.setdefault(conv, []).append((turn, role or "", text or ""))
    chats = {c: tuple(sorted(t)) for c, t in chats.items()}
    out = []
    for conv, own in chats.items():
        same = [c for c, t in chats.items() if t == own]
        longer = any(len(t) > len(own) and t[:len(own)] == own for t in chats.values())
        if conv == min(same) and not longer:
            out.append((conv, len(own), len(same), "".join(
                f"<|{r}|>\n{x}\n<|end|>\n" for _, r, x in own)))
    return sorted(out, key=str)


def test_chats_equal_the_plain_collapse(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK_TURNS", 4)
    rng = random.Random(6)
    rows = []
    for family in range(12):
        turns = [(t, ("user", "assistant")[t % 2], prose(rng, 4) if family % 3 else f"hi {t}")
                 for t in range(rng.randrange(1, 15))]
        for copy in range(5):
            cut = turns[:rng.randrange(1, len(turns) + 1)]
            rows += [(family * 10 + copy, *t, "x", "n") for t in cut]
    rows += [rows[0], rows[1], (None, 0, "user", "lost", "x", "n"), (900, None, "user", "lost", "x", "n"),
             (901, 0, None, None, "x", "n"), (902, 0, "", "", "x", "n")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, x string, n string")
    got = tuples(chat.collapse_and_render(df), "conv_id", "n_turns", "n_copies", "chat")
    assert got == plain_chats(rows)
    assert chat.collapse_and_render(df.limit(0)).count() == 0


# --- mixing ----------------------------------------------------------------------------

def cells_frame(spark, cells):
    return spark.createDataFrame(cells, "source string, lang string, topic string, tokens bigint")


def random_cells(seed):
    rng = random.Random(seed)
    return [(f"s{a}", f"l{b}", f"t{c}", rng.randrange(1, 1000) * (20 if a == 0 else 1))
            for a in range(4) for b in range(3) for c in range(3) if rng.random() < 0.9]


def plain_clipped_raking(cells, goal, wanted, sweeps=400):
    """Every margin's factor by bisection on sum(tokens * min(1, f * boost)) = goal."""
    boost = {c[:3]: wanted / sum(c[3] for c in cells) for c in cells}
    for _ in range(sweeps):
        for k, d in enumerate(mixing.DIMENSIONS):
            for value in {c[k] for c in cells}:
                own = [c for c in cells if c[k] == value]
                low, high = 0.0, 1e9
                for _ in range(200):
                    f = (low * high) ** 0.5 if low else high / 1e6
                    total = sum(c[3] * min(1.0, f * boost[c[:3]]) for c in own)
                    low, high = (f, high) if total < goal[d, value] else (low, f)
                    if high < 1e-9:
                        break
                for c in own:
                    boost[c[:3]] *= high
    return {c: min(1.0, b) for c, b in boost.items()}


@pytest.mark.parametrize("rate", [0.05, 0.6])
def test_raking_equals_a_plain_loop_and_meets_the_margins(spark, monkeypatch, rate):
    """At 0.05 nothing is clipped; at 0.6 some cells are kept whole and the others make up the rest."""
    monkeypatch.setattr(mixing, "TOLERANCE", 1e-7)
    cells = random_cells(7)
    wanted = rate * sum(c[3] for c in cells)
    df = cells_frame(spark, cells)
    goals = mixing.default_goals(df, mixing.TEMPERATURE, wanted)
    goal = {(r.dim, r.value): r.goal for r in goals.collect()}
    for d in mixing.DIMENSIONS:
        assert sum(g for (dim, _), g in goal.items() if dim == d) == pytest.approx(wanted)
    raked, miss = mixing.rake(df, goals, wanted)
    got = {tuple(r[:3]): min(1.0, r.boost) for r in raked.select(*mixing.DIMENSIONS, "boost").collect()}
    assert miss < 1e-6
    assert got == pytest.approx(plain_clipped_raking(cells, goal, wanted, 60), rel=1e-3)
    assert (max(got.values()) == 1.0) == (rate == 0.6)
    for k, d in enumerate(mixing.DIMENSIONS):
        for value in {c[k] for c in cells}:
            assert sum(c[3] * got[c[:3]] for c in cells if c[k] == value) == pytest.approx(
                goal[d, value], rel=1e-5)


def test_goals_keep_small_values_whole(spark):
    targets = spark.createDataFrame([("lang", "a", 10, 0.4), ("lang", "b", 1000, 0.3), ("lang", "c", 50, 0.3)],
                                    "dim string, value string, tokens bigint, target double")
    got = {r.value: r.goal for r in mixing.goals(targets, 500.0).collect()}
    assert got == pytest.approx({"a": 10.0, "b": 440.0, "c": 50.0})


def test_word_clusters_count_rows_that_repeat_an_id_and_text_as_one_document(spark):
    rows = [(1, "a b a"), (1, "a b a"), (2, "a b a"), (None, "b c"), (None, "b c"), (None, "b c"), (3, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = topics._documents(docs)
    assert sorted((r.text, r.copies) for r in found.collect()) == [
        ("", 1), ("", 1), ("a b a", 1), ("a b a", 2), ("b c", 3)]
    spread = found.mapInArrow(topics._spread, "word string, df bigint").groupBy("word").sum("df")
    assert {tuple(r) for r in spread.collect()} == {("a", 2), ("b", 3), ("c", 1)}
    plan = found.filter("copies = 1")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(d" not in plan      # texts that come once are not shuffled


def test_expected_tokens_have_the_target_shares(spark):
    rows = mixing.mix(spark.read.parquet(f"{DATA}/documents.parquet"), rate=0.3).cache()
    have = rows.groupBy("lang").agg(F.sum(F.col("tokens") * F.col("probability")).alias("e"),
                                    F.sum("tokens").alias("t")).collect()
    total, tempered = sum(r.e for r in have), sum(r.t ** 0.7 for r in have)
    for r in have:
        assert r.e / total == pytest.approx(r.t ** 0.7 / tempered, rel=3e-3)
    p = rows.agg(F.max("probability"), F.avg("probability"), F.avg(F.col("selected").cast("int")),
                 F.max("margin_error")).first()
    assert p[0] <= 1.0 and abs(p[1] - p[2]) < 0.06 and p[3] <= mixing.TOLERANCE


def test_a_nearly_empty_value_does_not_thin_out_the_rest(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang", "source")
    tiny = spark.createDataFrame([(10**9, "word " * 20, None, "src1")], rows.schema)
    mixed = mixing.mix(rows.unionByName(tiny)).cache()
    n, kept, tokens, expected = mixed.agg(
        F.count(F.lit(1)), F.sum(F.col("selected").cast("int")), F.sum("tokens"),
        F.sum(F.col("tokens") * F.col("probability"))).first()
    assert kept > 0.5 * n and expected == pytest.approx(mixing.KEEP * tokens, rel=5e-3)
    assert mixed.filter("lang = 'unknown' AND probability > 0.99 AND selected").count() == 1


def test_mixing_edges(spark):
    mixed = mixing.mix(docs(spark)).cache()
    assert mixed.count() == len(doc_rows())
    assert mixed.filter("tokens = 0 AND (selected OR probability > 0)").count() == 0
    assert mixing.mix(no_docs(spark)).count() == 0
    assert mixing.sample(no_docs(spark)).count() == 0
    kept = mixing.sample(docs(spark))
    assert kept.columns == docs(spark).columns
    assert tuples(kept, "doc_id") == tuples(mixed.filter("selected"), "doc_id")


def test_conflicting_targets_end_and_say_so(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_JOBS", 2)
    df = cells_frame(spark, [("a", "x", "t", 5), ("b", "y", "t", 5)])
    goals = spark.createDataFrame([("source", "a", 1.0), ("source", "b", 3.0), ("lang", "x", 3.0),
                                   ("lang", "y", 1.0), ("topic", "t", 4.0)], "dim string, value string, goal double")
    raked, miss = mixing.rake(df, goals, 4.0)
    assert raked.count() == 2 and miss > 0.5
    assert {r.dim for r in mixing.expected(raked).collect()} == set(mixing.DIMENSIONS)
    assert DOC_SCHEMA


def test_topics_follow_the_words(spark):
    rng = random.Random(4)
    fields = [[prose(rng, 1) + str(k) for _ in range(30)] for k in range(3)]
    rows = [(i, " ".join(rng.choice(fields[i % 3]) for _ in range(40))) for i in range(90)] + [(90, None), (91, "qqq")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = topics.fit(frame, topics=3)
    got = {r.doc_id: r.topic for r in topics.tagged(frame, model, ["doc_id"]).collect()}
    assert len({got[i] for i in range(3)}) == 3
    assert all(got[i] == got[i % 3] for i in range(90))
    assert got[90] == "empty" and got[91] == "none"


def test_counts_of_many_texts_share_a_row(spark):
    texts = ["a b a", "", "c", "q", "b " * 300]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(texts), pa.array([1, 1, 2, 1, 1])],
                                       names=["d", "text", "copies"])
    for some in ([batch], [batch.slice(0, 3), batch.slice(3)]):
        rows = list(topics._counted(("a", "b", "c"))(some))
        assert [r.num_rows for r in rows] == [1] * len(some)
        got = {}
        for d, ends, words, weights in topics._weighed(rows, np.array([1.0, 2.0, 3.0])):
            for i, part in enumerate(np.split(np.arange(len(words)), ends[:-1])):
                got[int(d[i])] = dict(zip(words[part].tolist(), weights[part].tolist()))
        a, b = 1 + math.log(2), 2.0
        assert got == {0: pytest.approx({0: a / math.hypot(a, b), 1: b / math.hypot(a, b)}), 2: {2: 1.0}, 4: {1: 1.0}}


def test_topics_are_fitted_on_every_document(spark):
    rows = [(i, f"alpha beta gamma w{i % 7}" + (f" rare{i // 2}" if i < 60 else "")) for i in range(3000)]
    model = topics.fit(spark.createDataFrame(rows, "doc_id long, text string"), topics=3)
    assert {f"rare{i}" for i in range(30)} < set(model.words)
    weight = dict(zip(model.words, model.weight))
    assert weight["alpha"] == pytest.approx(math.log(2), abs=1e-6)
    assert weight["rare0"] == pytest.approx(math.log(1501), abs=1e-6)
