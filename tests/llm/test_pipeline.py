import hashlib
import random

import corpus_pipeline
from tokenizers import Tokenizer

from basketlens.llm import mixing, queries, toxicity
from pyspark.sql import functions as F

from .helpers import no_docs, prose, tuples
from .test_dedup import brute_components

DATA = "/root/testdata/sf0.001"


def test_pipeline_equals_a_plain_version(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    grammar = toxicity.fit(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
    rows = [r for r in docs.collect() if grammar.score(r.text or "") < toxicity.THRESHOLD]
    last = {}
    for r in rows:
        last[r.text] = max(last.get(r.text, r.doc_id), r.doc_id)
    rows = [r for r in rows if last[r.text] == r.doc_id]
    kept = {d for d, _, _, k in brute_components([(r.doc_id, r.text) for r in rows], 5, 80) if k}
    left = spark.createDataFrame([r for r in rows if r.doc_id in kept], docs.schema)
    drawn = left.join(mixing.mix(left, seed=corpus_pipeline.MIXING_SEED).filter("selected")
                      .select("doc_id"), "doc_id").collect()
    library = Tokenizer.from_file(queries.tokenizer_path("word_bpe_49k.json"))
    want = []
    for r in drawn:
        ids = library.encode(r.text, add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), ids))
    assert tuples(corpus_pipeline.run(spark, DATA), "doc_id", "n_tokens", "ids") == sorted(want, key=str)
    assert want


def test_stages_keep_the_columns_and_take_empty_tables(spark):
    empty = no_docs(spark).select(*corpus_pipeline.COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, DATA)
        assert out.count() == 0, name
        if name != "bpe":
            assert out.columns == corpus_pipeline.COLUMNS, name


def test_stages_take_awkward_rows_and_extra_columns(spark):
    from .helpers import docs

    rows = docs(spark).withColumn("extra", F.lit(1))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, rows, DATA)
        assert out.count() > 0, name


def test_unnamed_documents_stay_unless_they_are_near_copies(spark):
    rng = random.Random(12)
    alone, shared, twice = (prose(rng, 80) for _ in range(3))
    rows = [(7, shared), (None, shared + " end"), (None, alone), (None, twice), (None, twice),
            (None, twice.upper() + " More"), (None, "")]
    docs_ = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows],
                                  "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = [tuple(r) for r in corpus_pipeline.drop_near_copies(spark, docs_, DATA)
           .select("doc_id", "text").collect()]
    named = [r for r in got if r[0] is not None]
    assert named == [(7, shared)] and (None, alone) in got and (None, "") in got
    assert len(got) == 4 and sum(t.lower().startswith(twice) for _, t in got) == 1


def test_pipeline_returns_the_digest_of_the_decoded_text(spark):
    docs_ = spark.createDataFrame([(1, "some words here"), (2, "")], "doc_id bigint, text string")
    library = Tokenizer.from_file(queries.tokenizer_path("word_bpe_49k.json"))
    for r in corpus_pipeline.encode(spark, docs_, DATA).join(docs_, "doc_id").collect():
        text = library.decode(library.encode(r.text, add_special_tokens=False).ids)
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
