"""Short benchmark items, the bound of the classifier's sample, columns with clashing names, a codec that was wrong once."""

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from shiftlens.llm import decontaminate, near_dup, rule_ensemble, sentencepiece_bpe
from shiftlens.llm.queries import piece_model

DOCS = "doc_id long, text string"


def test_items_below_five_words_are_found_in_any_text(spark):
    draw = random.Random(3)
    texts = [" ".join(draw.choices("abcdef", k=k)) for k in (0, 1, 2, 3, 4, 5, 7, 30, 64, 400)] + [None, "", "a, b! a"]
    items = ["a", "b c", "c d e", "a b c d", "f f f f", "Z", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    known = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.find_items(docs, known).collect()}
    clean = lambda text: " " + " ".join("".join(c if c.isalnum() else " " for c in (text or "").lower()).split()) + " "
    assert found == {(d, i) for d, text in enumerate(texts) for i, item in enumerate(items) if clean(item).strip() and clean(item) in clean(text)}


def test_rows_keep_columns_that_bear_the_names_of_ours(spark):
    same = "one two three four five six seven eight"
    rows = [(1, same, 7, "x", "c"), (1, same, 8, "y", "d"), (None, "a benchmark item of just seven words", 9, "z", "e"), (3, None, 5, "v", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row_key long, _row string, component_id string")
    kept = near_dup.keep_one(docs)
    assert kept.columns == docs.columns
    left = [tuple(r) for r in kept.collect()]
    assert len(left) == 3 and set(left) <= set(rows)
    items = spark.createDataFrame([(1, "benchmark item of")], "item_id long, text string")
    clean = decontaminate.without_items(docs, items)
    assert clean.columns == docs.columns and sorted(r._row_key for r in clean.collect()) == [5, 7, 8]


def test_the_sample_is_bounded_in_rows(spark, monkeypatch):
    rows = [(1, f"many rows of one key, number {i}", 0, "l") for i in range(500)] + [(k, "other words " * k, 1, "l") for k in range(2, 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _sampled int, label string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 12)], "doc_id long, quality int")
    seen, learn = [], rule_ensemble.learn

    def counted(train, names, fit):
        seen.append((train.count(), train.select("_key").distinct().count()))
        return learn(train, names, fit)

    monkeypatch.setattr(rule_ensemble, "learn", counted)
    for bound in (2, 11):
        scored, _ = rule_ensemble.score_quality(docs, labels, F.lit(False), rule_ensemble.Fit(sample_rows=bound))
        assert scored.count() == len(rows)
    assert seen == [(2, 2), (11, 11)]


def test_the_last_stage_replaces_columns_of_its_names(spark):
    docs = spark.createDataFrame([(1, "some text", "old", 3), (2, None, "old", 4)], "doc_id long, text string, ids string, n_tokens int")
    rows = {r.doc_id: r for r in corpus_pipeline.encoded(spark, docs, "").collect()}
    assert rows[1].n_tokens == len(rows[1].ids) > 2 and rows[2].n_tokens == len(rows[2].ids) and rows[1].round_trip


def test_a_wrong_chunk_is_not_remembered(spark):
    with open(piece_model(), "rb") as file:
        codec = sentencepiece_bpe.Codec(file.read())
    right = codec.encode("hello words").tolist()
    assert codec.fresh_agree()
    chunk = next(c for c in codec.memory if "hello" in c)
    codec.memory[chunk] = np.array([5, 6], "<i4").tobytes()
    codec.fresh.append(chunk)
    assert not codec.fresh_agree()
    assert codec.encode("hello words").tolist() == right and codec.fresh_agree()
