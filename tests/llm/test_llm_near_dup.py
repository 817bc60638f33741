"""Large groups of near copies: the work grows with their size, and no link is lost."""

import random

import pytest
from pyspark.sql import functions as F

from shiftlens.llm import near_dup

SCHEMA = "doc_id long, text string"


def words(rng, n, kinds=5000):
    return [f"w{rng.randrange(kinds)}" for _ in range(n)]


def changed(rng, text, share):
    return [w if rng.random() > share else f"c{rng.randrange(10**9)}" for w in text]


def test_rows_of_a_large_list_grow_with_its_size(spark):
    scheme = near_dup.Scheme()

    def rows(members, strays, components=1):
        nodes = [(i, 0, 7, i % components) for i in range(members)] + [(members + i, 0, 7, members + i) for i in range(strays)]
        return near_dup.lists_to_compare(spark.createDataFrame(nodes, "node long, coordinate int, value long, component long"), scheme).count()

    assert rows(4000, 0) == 0
    assert rows(4000, 5) == 4000 + 5 * (16 + 1)
    assert rows(8000, 5) == 8000 + 5 * (32 + 1)


def test_every_pair_of_components_meets(spark):
    rng = random.Random(2)
    nodes = [(i, 0, 7, rng.choice([0, 0, 0, 1, 2, i])) for i in range(300)]
    grouped = spark.createDataFrame(nodes, "node long, coordinate int, value long, component long")
    met = near_dup.lists_to_compare(grouped, near_dup.Scheme(block=16)).select("pair", "node", "component")
    left, right = met.toDF("pair", "a", "x"), met.toDF("pair", "b", "y")
    pairs = {(r.a, r.b) for r in left.join(right, "pair").where("a < b AND x <> y").distinct().collect()}
    assert pairs == {(a, b) for a, _, _, x in nodes for b, _, _, y in nodes if a < b and x != y}


@pytest.mark.parametrize("block", [256, 16])
def test_groups_of_near_copies_equal_brute_force(spark, block):
    rng, texts = random.Random(3), []
    for size in (400, 150, 60, 30, 5):  # each group drifts away from its first text, so not all are near it
        text = words(rng, 80)
        for _ in range(size):
            texts.append(text if rng.random() < 0.2 else changed(rng, text, 0.02))
            if rng.random() < 0.05:
                text = changed(rng, text, 0.02)
    rng.shuffle(texts)
    sets = [frozenset(zip(t, t[1:], strict=False)) for t in texts]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], SCHEMA)
    got = near_dup.near_duplicates(docs, near_dup.Scheme(shingle_words=2, block=block)).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: find(i) for i in range(len(sets))}


def test_a_group_of_thousands_is_one_component(spark):
    rng = random.Random(4)
    text = words(rng, 100)
    rows = [(i, " ".join([*text, f"end{i}"])) for i in range(5000)] + [(10_000 + i, " ".join(words(rng, 100))) for i in range(20)]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, SCHEMA), near_dup.Scheme(shingle_words=2))
    kept = {r.doc_id for r in got.where(F.col("kept")).collect()}
    assert kept == {0, *range(10_000, 10_020)}


def rows_of_a_group(spark, monkeypatch, texts, scheme):
    """How many rows are compared, and the documents that are kept."""
    counted, compare = [], near_dup.lists_to_compare
    monkeypatch.setattr(near_dup, "lists_to_compare", lambda *a: counted.append(rows := compare(*a)) or rows)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], SCHEMA)
    kept = {r.doc_id for r in near_dup.near_duplicates(docs, scheme).where("kept").collect()}
    monkeypatch.undo()
    return counted[0].count(), kept


def test_rows_of_texts_alike_but_not_near_grow_with_their_number(spark, monkeypatch):
    rng = random.Random(5)
    text = words(rng, 120)
    # Three words of each are its own, so 105 of 120 runs of words are shared: alike in many coordinates, 78 % at most.
    alike = [[f"own{n}" if i in (20, 60, 100) else w for i, w in enumerate(text)] for n in range(1000)]
    few, kept = rows_of_a_group(spark, monkeypatch, alike[:500], near_dup.Scheme(block=64))
    assert kept == set(range(500))
    many, kept = rows_of_a_group(spark, monkeypatch, alike, near_dup.Scheme(block=64))
    assert kept == set(range(1000))
    assert many <= 2.5 * few + 1000  # 68,573 and 241,896 rows while such lists were compared block by block
