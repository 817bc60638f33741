"""Substring dedup against brute force, and the FM-index under it."""

import random

import numpy as np
import pytest

from shiftlens.llm import fm_index, queries, substring_dedup

SCHEMA = "doc_id long, text string, data string, row string, doc string, twin string"


def test_matching_statistics_equal_brute_force():
    rng = random.Random(1)
    for _ in range(150):
        kinds, longest = rng.randrange(1, 6), rng.randrange(1, 6)
        some = lambda least: [rng.randrange(kinds + 1) for _ in range(rng.randrange(least, 15))]  # noqa: E731, B023
        sequences = [some(1) for _ in range(rng.randrange(1, 8))]
        owners = np.array([rng.randrange(5) for _ in sequences])
        index = fm_index.FMIndex(sequences, owners, longest)
        streamed = [some(0) for _ in range(5)] + [[99, *sequences[0]], *sequences[:2]]
        before = np.array([rng.randrange(7) for _ in streamed])
        for words, limit, found in zip(streamed, before, index.matches([index.codes(s) for s in streamed], before), strict=True):
            for i in range(len(words)):
                lengths = range(1, min(longest, len(words) - i) + 1)
                fits = [k for k in lengths if any(o < limit and s[j : j + k] == words[i : i + k] for s, o in zip(sequences, owners, strict=True) for j in range(len(s)))]
                assert found[i] == max(fits, default=0)
        full = index.matches([index.codes(s) for s in streamed], before)
        for longer, found in zip(full, index.matches([index.codes(s) for s in streamed], before, longest), strict=True):
            assert ((found >= longest) == (longer >= longest)).all()  # what is left out stays below the least length


def test_wavelet_tree_ranks():
    symbols = np.random.default_rng(0).integers(0, 37, 500)
    tree = fm_index.WaveletTree(symbols, 37)
    at, sought = np.arange(501).repeat(37), np.tile(np.arange(37), 501)
    assert (tree.rank(sought, at) == [(symbols[:a] == s).sum() for a, s in zip(at, sought, strict=True)]).all()


def kept_by_force(rows, window):
    texts = [(float("inf") if r[0] is None else r[0], (r[1] or "").encode().split()) for r in rows]
    first = {}
    for doc, words in texts:
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            first[key] = min(doc, first.get(key, doc))
    out = []
    for (doc, words), row in zip(texts, rows, strict=True):
        lost = {i + k for i in range(len(words) - window + 1) if first[tuple(words[i : i + window])] < doc for k in range(window)}
        out.append((row[0], len(words), len(lost), b" ".join(w for i, w in enumerate(words) if i not in lost).decode()))
    return sorted(out, key=repr)


def found(docs, window, group):
    left = substring_dedup.first_copies(docs, window, group).collect()
    return sorted(((r.doc_id, r.n_words, sum(s.after - s.first for s in r.spans), r.kept) for r in left), key=repr)


def prose(rng, n, kinds=400):
    return " ".join(f"w{rng.randrange(kinds)}é" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    base, passage = prose(rng, 150), prose(rng, 60)
    texts = [None, "", " \n\t\x0b ", "one", base, base, passage, "x " * 900, "x " * 700, " ".join(base.split())]
    for _ in range(25):  # one passage in ever other surroundings, words cut by other blanks
        texts.append(prose(rng, rng.randrange(0, 60)) + "\t" + passage.replace(" ", "\n") + " " + prose(rng, rng.randrange(0, 60), 3))
    for _ in range(12):
        near = base.split()
        near[rng.randrange(len(near))] = "changed"
        texts.append(" ".join(near))
    texts += [passage + " a " + passage, prose(rng, 80, 2), prose(rng, 20_000) + " " + base]
    order = list(range(len(texts)))
    rng.shuffle(order)
    rows = [(i, texts[at], "a", "b", "c", None) for i, at in enumerate(order)]
    return [*rows, rows[7], rows[20], *[(None, base, None, None, None, None)] * 3, (None, passage + " end", "", "", "", ""), (-5, passage, "", "", "", "")]


@pytest.mark.parametrize("group", [4096, 3, 0])  # 0: every segment is cut into single windows
@pytest.mark.parametrize("window", [50, 17])
def test_substring_dedup_equals_brute_force(spark, rows, window, group):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(docs, window, group) == kept_by_force(rows, window)


def test_copies_of_one_row_are_cut_once(spark):
    rng = random.Random(4)
    text = prose(rng, 120)
    rows = [(None, text)] * 3000 + [(7, text), (9, text + " end")]
    left = substring_dedup.first_copies(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {(r.doc_id, r.kept): r.n for r in left.groupBy("doc_id", "kept").agg({"*": "count"}).toDF("doc_id", "kept", "n").collect()}
    assert got == {(None, ""): 3000, (7, text): 1, (9, "end"): 1}


def test_empty_table_and_short_windows(spark):
    assert substring_dedup.first_copies(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        substring_dedup.first_copies(spark.createDataFrame([], SCHEMA), window=16)


def test_kept_text_of_a_character_cut_in_two(spark, tmp_path):
    rng = random.Random(6)
    passage = prose(rng, 120)
    texts = [passage + "é one", passage + "ü two", passage + "ö three"]  # their first byte is shared, the second is not
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = queries.op2_suffix_array_dedup(spark, str(tmp_path)).collect()
    assert {r.kept for r in rows} == {"\ufffd one", "\ufffd two", "\ufffd three"}
