import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from basketlens.llm import bpe, queries, token_files, topk

from .helpers import doc_rows, docs, no_docs, prose, tuples

ALPHABET = "aAbBsStT'  \n\t\x1c\x85\xa0éÉßİΣςǅ１²٣9.!?,漢🙂'll're<|>"


def strange_texts(n=3000):
    rng = random.Random(2)
    out = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(40))) for _ in range(n)]
    return out + ["a<|endoftext|>b <|startoftext|> x", "   ", " a  b ", "a \n b", "a\n \nb",
                  "a" * 3000, "word, word. (word), word's", ""]


def test_pair_index_equals_the_library():
    path = queries.tokenizer_path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), bpe.WordCoder(path)
    texts = strange_texts()
    for text, (n, ids, decoded), want in zip(texts, own.block(texts),
                                             library.encode_batch(texts, add_special_tokens=False)):
        assert ids == " ".join(map(str, want.ids)) and n == len(want.ids), text
        assert decoded == library.decode(want.ids, skip_special_tokens=False)


def test_pair_index_with_rules_out_of_order():
    """A merge may make a pair of a lower rank: it goes first, as a plain loop would do."""
    letters = bpe.byte_letters()
    vocab = {c: i for i, c in enumerate([*letters, *(c + bpe.END for c in letters)])}
    rules = ["b c", "a bc", "abc a", "a b", "ab c", "c a"]
    for rule in rules:
        vocab.setdefault(rule.replace(" ", ""), len(vocab))
    index = bpe.PairIndex(vocab, rules)
    rng = random.Random(4)

    def plain(word):
        units = [vocab[c] for c in word[:-1]] + [vocab[word[-1] + bpe.END]]
        while True:
            ranks = [(index.rank.get(x * index.width + y, 10 ** 9), i)
                     for i, (x, y) in enumerate(zip(units, units[1:]))]
            if not ranks or min(ranks)[0] == 10 ** 9:
                return units
            rank, i = min(ranks)
            units[i:i + 2] = [index.rules[rank][2]]
    words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 14))) for _ in range(3000)]
    assert index.encode(words) == [plain(w) for w in words]


def test_bpe_query_columns(spark):
    path = queries.tokenizer_path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for doc_id, text, *_ in doc_rows():
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, len(ids), sha(" ".join(map(str, ids))),
                     sha(library.decode(ids, skip_special_tokens=False))))
    got = tuples(bpe.encode_decode(docs(spark), path, ("ids_sha256", "decoded_sha256")), "doc_id", "n_tokens",
                 "ids_sha256", "decoded_sha256")
    assert got == sorted(want, key=str)
    assert bpe.encode_decode(no_docs(spark), path).count() == 0
    row = bpe.encode_decode(docs(spark), path).filter("n_tokens > 0").first()
    assert len(row.ids) == row.n_tokens


def test_piece_encoder_equals_the_library(monkeypatch):
    path = queries.tokenizer_path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), token_files.PieceEncoder(path)
    monkeypatch.setattr(token_files, "CACHE_PIECES", 500)
    texts = strange_texts()
    for at in range(0, len(texts), 97):
        some = texts[at:at + 97]
        for text, code, want in zip(some, own.encode(some),
                                    library.encode_batch(some, add_special_tokens=False)):
            assert np.frombuffer(code, own.dtype).tolist() == want.ids, text


def test_token_files_round_trip(spark, scratch):
    path = queries.tokenizer_path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    got = token_files.round_trip(docs(spark), path, 2, scratch + "/ids").orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted(
        (r[0] for r in doc_rows()), key=lambda i: (i is not None, i))
    start = 0
    codes = {}
    for doc_id, text, *_ in doc_rows():
        codes.setdefault(doc_id, []).append(
            library.encode(text or "", add_special_tokens=False).ids + [2])
    for row in got:
        crcs = {zlib.crc32(np.array(c, "<u4").tobytes()): len(c) for c in codes[row.doc_id]}
        assert row.start == start and crcs[row.ids_crc32] == row.n_tokens
        start += row.n_tokens
    parts = token_files.read_manifest(spark, scratch + "/ids").orderBy("part").collect()
    flat = np.concatenate([np.fromfile(f"{scratch}/ids/ids-{p.part:05d}.bin", "<u2") for p in parts])
    assert len(flat) == start and [p.base for p in parts] == np.cumsum(
        [0] + [p.n_tokens for p in parts])[:-1].tolist()


def test_token_files_of_an_empty_table(spark, scratch):
    path = queries.tokenizer_path("byte_bpe_50k.json")
    assert token_files.round_trip(no_docs(spark), path, 2, scratch + "/none").count() == 0


@pytest.mark.parametrize("scale", [1.0, 1e12, 1e150])
def test_top_k_equals_brute_force(spark, scale):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=8) * scale).tolist(), 1, "t") for i in range(230)]
    rows += [(i, rows[7][1], 1, "t") for i in range(230, 290)]          # one vector many times
    rows += [(400, None, 1, "t"), (450, [1.0, None] * 4, 1, "t"), (None, rows[0][1], 1, "t"),
             (451, [float("nan")] * 8, 1, "t"), (452, [float("inf")] * 8, 1, "t"),
             (500, [1.0, 2.0], 1, "t"), (501, [3.0, 4.0], 1, "t"), (550, [], 1, "t"),
             (20, rows[3][1], 1, "t"),                                   # a repeated id
             (600, [1e307] * 8, 1, "t"), (601, [-1e307] + [1.0] * 7, 1, "t")]   # finite, but not when scaled
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int, tile string")
    got = tuples(topk.top_k(df, lambda v: v % 50 == 0, shard_rows=40, block_rows=3),
                 "query_id", "rank", "vec_id", "score")
    clean = [(i, [int(np.floor(256 * x)) for x in v]) for i, v, *_ in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(256 * x) for x in v)]
    want = []
    for q, x in clean:
        if q % 50 == 0:
            found = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in clean
                           if i != q and len(x) == len(y))
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(found[:5])]
    want = [(q, k, i, max(-2 ** 63, min(2 ** 63 - 1, s))) for q, k, i, s in want]
    assert got == sorted(want, key=str)


def test_order_keys_sort_as_the_scores_do():
    rng = random.Random(8)
    scores = [0, 1, -1, 255, 256, -256, 2 ** 63, -2 ** 63, 2 ** 4000, -2 ** 4000]
    scores += [rng.choice((-1, 1)) * rng.getrandbits(rng.randrange(1, 200)) for _ in range(3000)]
    assert sorted(scores, key=topk.order_key) == sorted(scores, reverse=True)


def test_top_k_of_few_or_no_rows(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert topk.top_k(spark.createDataFrame([], schema), lambda v: v % 50 == 0).count() == 0
    two = spark.createDataFrame([(0, [1.0]), (1, [2.0])], schema)
    assert tuples(topk.top_k(two, lambda v: v % 50 == 0), "query_id", "rank", "vec_id", "score") == [
        (0, 1, 1, 256 * 512)]


def test_long_texts_are_coded_whole():
    path = queries.tokenizer_path("byte_bpe_50k.json")
    text = prose(random.Random(9), 50_000)
    assert (np.frombuffer(token_files.PieceEncoder(path).encode([text])[0], "<u2").tolist()
            == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids)
