"""Operators on training data against brute force, on small fixtures with nulls, empty texts, ties and repeated rows."""

import hashlib
import math
import random
import re
import sys
import zlib
from collections import Counter, deque
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
public_tokenizers = pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from shiftlens.llm import (  # noqa: E402
    chat, decontaminate, near_dup, pieces, quality_rules, queries, rule_ensemble, sentencepiece_bpe, sharding,
    suffix_array, suffix_dedup, suffix_tree_lm, token_counts,
)

SCHEMA = "doc_id long, text string, lang string, n_words string, row string"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdeéü") for _ in range(rng.randrange(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Documents with copies, near copies, shared passages, nulls and extra columns that clash with results."""
    rng = random.Random(5)
    base, passage = prose(rng, 120), prose(rng, 90)
    texts = [None, "", "  \n\t ", "word", "Two words", base, base, base.upper(), passage]
    for _ in range(12):
        near = base.split()
        near[rng.randrange(len(near))] = "changed"
        texts.append(" ".join(near))
    texts += [prose(rng, 40) + " " + passage + " " + prose(rng, 30) for _ in range(6)]
    texts += [prose(rng, rng.randrange(1, 200)) for _ in range(20)] + ["x" * 3000, "long " * 3000, "🙂" * 300]
    found = [(i, t, "en", "a", "b") for i, t in enumerate(texts)]
    return [*found, found[9], (None, base, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4).cache()


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(0)
    for trial in range(300):
        s = rng.integers(0, rng.integers(1, 5), rng.integers(1, 40))
        s = np.tile(s, 4) if trial % 9 == 0 else s
        data = bytes(s.tolist())
        order = suffix_array.suffix_array(s)
        assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
        shared, before = suffix_array.permuted_lcp(s, order)
        for j, i in zip(order, order[1:], strict=False):
            n = next((k for k in range(len(data)) if data[i + k : i + k + 1] != data[j + k : j + k + 1] or i + k >= len(data) or j + k >= len(data)), len(data))
            assert (shared[i], before[i]) == (n, j)


def removed_by_force(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        out.append((len(t), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), np.frombuffer(t, np.uint8)[~gone].tobytes()))
    return sorted(out)


@pytest.mark.parametrize("group", [4096, 1])  # 1: every anchor goes the way of a very common one
def test_suffix_dedup_equals_brute_force(docs, rows, group):
    got = suffix_dedup.repeated_bytes(docs, 200, group).collect()
    want = removed_by_force([(r[1] or "").encode() for r in rows], 200)
    assert sorted((r.n_bytes, len(r.spans), bytes(r.kept)) for r in got) == want


@pytest.mark.parametrize("group", [4096, 1])
def test_suffix_dedup_of_doubled_lines_equals_brute_force(spark, group):
    rng, texts = random.Random(8), []
    symbols = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    for _ in range(60):  # a line that stands twice, and a copy without its first instance
        line, rest = symbols(100), symbols(rng.randrange(105, 130))
        texts += [symbols(150) + line + symbols(rng.randrange(5, 30)) + line + rest + symbols(100), symbols(150) + line + rest + symbols(100)]
    texts += ["=" * 500, "=" * 300 + symbols(200)]
    got = suffix_dedup.repeated_bytes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 200, group).collect()
    assert sorted((r.n_bytes, len(r.spans), bytes(r.kept)) for r in got) == removed_by_force([t.encode() for t in texts], 200)


def test_suffix_dedup_keeps_characters_and_columns(spark, docs):
    left = suffix_dedup.without_repeats(docs, 200)
    assert left.columns == docs.columns and left.count() == docs.count()
    assert left.where("doc_id = 0").first().text is None
    assert suffix_dedup.repeated_bytes(empty(spark)).count() == 0


def components_by_force(rows, size, percent):
    sets = []
    for i, text, *_ in rows:
        w = suffix_words(text)
        sets.append((i, frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()))
    root = {i: i for i, _ in sets}
    for _ in sets:
        for i, a in sets:
            for j, b in sets:
                if i is not None and j is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
    return sorted((i, len(s), root[i]) for i, s in sets if i is not None)


def suffix_words(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return [w for w in low.replace("\n", " ").replace("\t", " ").split(" ") if w]


@pytest.mark.parametrize("scheme", [near_dup.Scheme(shingle_words=2), near_dup.Scheme(), near_dup.Scheme(block=2)])
def test_near_duplicates_equal_brute_force(docs, rows, scheme):
    got = near_dup.near_duplicates(docs, scheme)
    named = sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect() if r.doc_id is not None)
    assert named == components_by_force(rows, scheme.shingle_words, scheme.percent)
    lone = got.where("doc_id IS NULL").first()
    assert lone.kept and lone.component_id is None


def test_near_duplicates_of_nothing(spark):
    assert near_dup.near_duplicates(empty(spark)).count() == 0


def test_one_row_of_repeated_rows_and_copies_without_id_keeps_its_text(spark, tmp_path):
    rng = random.Random(21)
    repeated, nameless, alone = (prose(rng, 120) for _ in range(3))
    found = [(4, repeated), (4, repeated), (None, repeated), (9, repeated + " end"), (None, nameless), (None, nameless), (4, alone), (None, None), (5, "")]
    table = spark.createDataFrame([(i, t, len(t or "")) for i, t in found], "doc_id long, text string, n_chars long").repartition(3)
    table.limit(0).selectExpr("doc_id AS item_id", "text").write.parquet(f"{tmp_path}/benchmark.parquet")
    for stage in (corpus_pipeline.near_duplicates, corpus_pipeline.repeated_passages, corpus_pipeline.benchmark_leaks):
        table = stage(spark, table, str(tmp_path))
    assert table.columns == ["doc_id", "text", "n_chars"]
    want = [(4, repeated), (None, nameless), (4, alone), (None, None), (5, "")]
    assert Counter((r.doc_id, r.text) for r in table.collect()) == Counter(want)


def test_quality_rules_columns_and_extremes(spark, docs):
    got = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    assert got[0].base_failed and not got[0].kept and got[0].n_words == 0
    assert not got[[k for k, r in got.items() if r.n_repeat_words >= 3000][0]].kept
    assert quality_rules.keep_good(docs).columns == docs.columns
    assert quality_rules.judge(empty(spark)).count() == 0


def test_items_found_with_changes_at_the_end(spark):
    rng = random.Random(2)
    item = prose(rng, 40).split()
    text = lambda words: f"{prose(rng, 60)} {' '.join(words)} {prose(rng, 50)}"
    cases = [text(item), text([w.upper() for w in item]), text([*item[:38], "x", "y"]), text([*item[:20], "x", *item[21:]]), prose(rng, 90), None, ""]
    found = decontaminate.find_items(
        spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string"),
        spark.createDataFrame([(7, " ".join(item)), (8, None), (9, "")], "item_id long, text string"),
    ).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(0, 7), (1, 7), (2, 7)]
    assert {r.doc_id: round(r.similarity, 3) for r in found} == {0: 1.0, 1: 1.0, 2: round(34 / 38, 3)}


def test_leaks_go_row_by_row(spark):
    rng = random.Random(4)
    item, clean = prose(rng, 40), prose(rng, 90)
    leak = f"{prose(rng, 60)} {item} {prose(rng, 50)}"
    docs = spark.createDataFrame([(1, leak), (1, clean), (None, leak), (None, clean), (2, None)], "doc_id long, text string").repartition(2)
    left = decontaminate.without_items(docs, spark.createDataFrame([(7, item)], "item_id long, text string"))
    assert left.columns == docs.columns
    assert Counter(map(tuple, left.collect())) == Counter([(1, clean), (None, clean), (2, None)])


@pytest.fixture(scope="module")
def model():
    return Path(queries.piece_model()).read_bytes()


def odd_texts():
    rng = random.Random(1)
    made = ["".join(rng.choice(" ab▁éß\n\t\x00<0xA>ﬁ漢 the.,!") for _ in range(rng.randrange(30))) for _ in range(500)]
    return [*made, "", "  ", " ", "</s>", "<s> x", "<0x0A>"]


def test_encoder_equals_library(spark, docs, model):
    own = sentencepiece_bpe.Codec(model)
    for text in odd_texts():
        assert own.encode(text).tolist() == own.vocabulary.library.encode(text, add_bos=True, add_eos=True)
    assert own.fresh_agree()
    for r in sentencepiece_bpe.encode_and_decode(docs, queries.piece_model(), keep_row=True).collect():
        assert r.agrees and r.decoded == (r.row.text or "")


def test_counts_equal_unigram_tokenizer(model):
    tokenizers = pytest.importorskip("tokenizers")
    own = token_counts.Counter(model)
    v = own.vocabulary
    reference = tokenizers.Tokenizer(tokenizers.models.Unigram(list(zip(v.pieces, v.scores, strict=True)), v.unknown, True))
    for text in odd_texts():
        ids = reference.encode("▁" + text.replace(" ", "▁")).ids if text else []
        assert own.count(text) == len(ids)


def test_token_counts_of_rows(spark, docs, model):
    own = token_counts.Counter(model)
    want = Counter((r.doc_id, own.count(r.text or "")) for r in docs.collect())
    got = token_counts.count_tokens(docs.withColumn("n_tokens", F.lit("theirs")), queries.piece_model())
    assert got.columns == ["doc_id", "n_tokens"] and Counter(map(tuple, got.collect())) == want


def test_tokens_and_scores_of_nothing(spark):
    assert token_counts.count_tokens(empty(spark), queries.piece_model()).count() == 0
    assert sentencepiece_bpe.encode_and_decode(empty(spark), queries.piece_model()).count() == 0
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    scored, _ = rule_ensemble.score_quality(empty(spark), labels, F.lit(False))
    assert scored.count() == 0


def test_shards_are_even_and_gapless(spark, docs, rows):
    for shards in (1, 3, 24):
        got = sharding.assign(docs, shards).collect()
        by_shard = Counter(r.shard for r in got)
        assert len(got) == len(rows) and max(by_shard.values()) - (min(by_shard.values()) if len(by_shard) == shards else 0) <= 1
        assert all(sorted(r.slot for r in got if r.shard == s) == list(range(n)) for s, n in by_shard.items())
    assert sharding.assign(empty(spark), 4).count() == 0


def ring_by_force(rows, shards, nodes_a_shard):
    """Shard of each row, and whether it left its node, by a walk along the ring."""
    place = lambda text: int(hashlib.md5(text.encode()).hexdigest()[:8], 16)
    nodes = sorted((place(f"node/{i}"), i % shards) for i in range(shards * nodes_a_shard))
    homes = [[] for _ in nodes]
    for key, crc, size in rows:
        at = place("" if key is None else str(key))
        home = next((i for i, (hi, _) in enumerate(nodes) if at <= hi), 0)
        homes[home].append((at, key is not None, key, crc, size))
    arcs = [hi - nodes[i - 1][0] + (0 if i else 1 << 32) for i, (hi, _) in enumerate(nodes)]
    room = [0] * len(nodes)
    for s in range(shards):
        mine = [i for i, (_, shard) in enumerate(nodes) if shard == s]
        share, upto, given = len(rows) // shards + (s < len(rows) % shards), 0, 0
        for i in mine:
            upto += arcs[i]
            room[i] = share * upto // sum(arcs[j] for j in mine) - given
            given += room[i]
    for start in range(len(nodes)):
        placed, passing = [], deque()
        for i in (*range(start, len(nodes)), *range(start)):
            own = sorted(homes[i], key=lambda r: (r[:2], r[2] or 0, r[3:]))
            placed += [(r[2:], nodes[i][1], False) for r in own[: room[i]]]
            passing.extend(own[room[i] :])
            free = room[i] - len(own)
            while free > 0 and passing:
                placed.append((passing.popleft()[2:], nodes[i][1], True))
                free -= 1
        if not passing:
            return placed
    raise AssertionError("no start")


def test_ring_equals_a_walk_along_it(spark):
    rng = random.Random(12)
    found = [(i if i % 3 else None, "copy" if i % 2 else prose(rng, 5)) for i in range(900)] + [(i, "again") for i in range(40)]
    table = spark.createDataFrame(found, "doc_id long, text string").repartition(7)
    for shards, nodes_a_shard in ((1, 1), (5, 8), (24, 3)):
        got = sharding.assign(table, shards, nodes_a_shard=nodes_a_shard).collect()
        rows = [(i, zlib.crc32(t.encode()), len(t.encode()) + 8) for i, t in found]
        want = ring_by_force(rows, shards, nodes_a_shard)
        assert Counter(((r.doc_id, r.text_crc32, r.size), r.shard, r.moved) for r in got) == Counter(want)


def test_rows_without_id_are_ordered_by_many_tasks(spark):
    rows = spark.range(20_000).selectExpr("CASE WHEN id % 3 = 0 THEN id END AS doc_id", "'same' AS text")
    plan = sharding.assign(rows, 24)._jdf.queryExecution().toString()
    assert not re.search(r"Window.*place", plan)
    parts = sharding.assign(rows, 24).groupBy("shard").count().collect()
    assert len(parts) == 24 and {p["count"] for p in parts} <= {833, 834}


def test_events_fold_and_read_back(spark):
    events = [
        (1, 0, 0, "user", "delta", "hi "), (1, 1, 0, None, "delta", "the&amp;<s>[re]"), (1, 2, 1, "assistant", "delta", "wrong"),
        (1, 3, 2, "user", "delta", "gone"), (1, 4, 1, "assistant", "regenerate", "better"), (1, 5, 1, "assistant", "delta", "!"),
        (1, 6, 2, "user", "delta", "draft"), (1, 7, 2, "user", "edit", None), (None, 0, 0, "assistant", None, "</s>"),
    ]
    log = spark.createDataFrame(events, "conv_id long, seq long, turn long, role string, kind string, text string").repartition(3)
    got = {r.conv_id: r for r in chat.parse(chat.render(chat.fold_events(log))).collect()}
    assert [(m.role, m.text) for m in got[1].messages] == [("user", "hi the&amp;<s>[re]"), ("assistant", "better!"), ("user", "")]
    assert "".join(got[1].loss_texts) == "better!" and got[None].loss_texts == ["</s>"]
    assert chat.render(chat.fold_events(log.limit(0))).count() == 0


def test_language_model_without_states_is_the_base(spark, docs):
    shape = suffix_tree_lm.Shape(context_share=2.0)
    got = suffix_tree_lm.score_texts(docs, F.coalesce(F.col("doc_id"), F.lit(0)) % 5 == 1, shape).collect()
    assert all(math.isclose(r.score, r.base_score, rel_tol=1e-9) for r in got)
    counts = Counter(w for r in docs.collect() if (r.doc_id or 0) % 5 != 1 for w in [*suffix_words(r.text), None])
    total, norm = sum(counts.values()), sum(counts.values()) + 0.5 * (len(counts) + 1)
    for r, text in ((r, t) for r in got for t in [next(x.text for x in docs.collect() if x.doc_id == r.doc_id)] if r.doc_id in (0, 5, 11)):
        want = sum(math.log10((counts[w] + 0.5) / norm) for w in [*suffix_words(text), None])
        assert r.train_tokens == total and math.isclose(r.base_score, want, rel_tol=1e-9)
    assert suffix_tree_lm.score_texts(empty(spark), F.lit(False)).count() == 0


def tree_by_force(texts, trained, shape):
    """Score of each text by a tree over dictionaries of counts."""
    tokens = [[*suffix_words(t), None] for t in texts]
    words, after = Counter(), {1: {}, 2: {}}
    for said in (t for t, yes in zip(tokens, trained, strict=True) if yes):
        words.update(said)
        for i, w in enumerate(said):
            for depth in (1, 2):
                if i >= depth:
                    after[depth].setdefault(tuple(said[i - depth : i]), Counter())[w] += 1
    norm = sum(words.values()) + 0.5 * (len(words) + 1)
    kept = {}

    def probability(context, w):
        while context and context not in kept:
            context = context[1:]
        if not context:
            return (words[w] + 0.5) / norm
        entries, seen, freed = kept[context]
        return ((entries[w] - shape.discount) / seen if w in entries else 0) + freed * probability(context[1:], w)

    for depth in (1, 2):
        for context, counts in after[depth].items():
            seen, entries = sum(counts.values()), {w: n for w, n in counts.items() if n >= shape.edge_least}
            if seen < shape.context_least or not entries or depth == 2 and context[1:] not in kept:
                continue
            shorter = {w: probability(context[1:], w) for w in entries}
            rest, shorter_rest = (max(1 - x, 1e-12) for x in (sum(entries.values()) / seen, sum(shorter.values())))
            gain = sum(n / seen * math.log(n / seen / shorter[w]) for w, n in entries.items()) + rest * math.log(rest / shorter_rest)
            if gain >= shape.divergence:
                kept[context] = entries, seen, 1 - sum(n - shape.discount for n in entries.values()) / seen
    return [sum(math.log10(probability(tuple(said[max(0, i - 2) : i]), w)) for i, w in enumerate(said)) for said in tokens]


@pytest.mark.parametrize("shape", [suffix_tree_lm.Shape(), suffix_tree_lm.Shape(sent_share=1e-2, broadcast_share=1e-2)])
def test_language_model_keeps_rare_contexts_in_a_large_corpus(spark, shape):
    rng = random.Random(11)
    vocabulary = [prose(rng, 1) for _ in range(60)]
    texts = [" ".join(rng.choices(vocabulary, range(60, 0, -1), k=rng.randrange(1, 40))) for _ in range(120)] + [None, "", "once"]
    texts += ["seldom met pair"] * 2 + ["many " * 150_000]  # a context seen twice among so many tokens
    trained = [i % 5 != 1 for i in range(len(texts))]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.score for r in suffix_tree_lm.score_texts(table, F.col("doc_id") % 5 == 1, shape).collect()}
    for i, want in enumerate(tree_by_force(texts, trained, shape)):
        assert math.isclose(got[i], want, rel_tol=1e-9)


def test_language_model_stores_a_few_bytes_a_token(spark, monkeypatch):
    rng, sizes = random.Random(12), []
    words = [f"w{i}" for i in range(5000)]
    texts = [(i, " ".join(rng.choices(words, [1 / (k + 1) for k in range(len(words))], k=400))) for i in range(500)]
    stored = suffix_tree_lm.stored

    def measured(frame):
        out = stored(frame)
        sizes.append(sum(Path(f.removeprefix("file://")).stat().st_size for f in out.inputFiles()))
        return out

    monkeypatch.setattr(suffix_tree_lm, "stored", measured)
    table = spark.createDataFrame(texts, "doc_id long, text string").repartition(2)
    tokens = sum(r.n_tokens for r in suffix_tree_lm.score_texts(table, F.col("doc_id") % 5 == 1).collect())
    assert tokens == 500 * 401 and sum(sizes) < 20 * tokens


def test_quality_classifier_held_out(spark):
    rng = random.Random(3)
    good = [(i, " ".join(rng.choice(["the", "of", "and", prose(rng, 1)]) for _ in range(rng.randrange(20, 80))), 1) for i in range(120)]
    bad = [(i, " ".join(prose(rng, 1) + rng.choice("###$$%%") for _ in range(rng.randrange(20, 80))), 0) for i in range(120, 200)]
    table = spark.createDataFrame([*good, *bad, (900, None, None)], "doc_id long, text string, quality int")
    scored, ensemble = rule_ensemble.score_quality(table.drop("quality"), table.drop("text"), F.col("doc_id") % 3 == 1, rule_ensemble.Fit(trees=4, depth=3))
    got = scored.join(table, "doc_id").where("held_out AND quality IS NOT NULL").collect()
    assert ensemble.rules and np.mean([r.predicted == r.quality for r in got]) > 0.95
    assert all(0 <= r.score <= 1 for r in scored.collect())


def told_by_one_statistic(rng, kind, good):
    """A text whose class shows in one statistic only."""
    pool = ["".join(rng.choice("bcdfgk") for _ in range(5)) for _ in range(12)]
    if kind == "repeated":  # the same twelve words five times, in one order or in others
        return " ".join(w for _ in range(5) for w in (rng.sample(pool, 12) if good else pool))
    mark = {"digits": "7", "stops": "."}[kind]
    return " ".join(w[:4] + (mark if (kind == "stops") == good else "b") for w in rng.choices(pool, k=60))


@pytest.mark.parametrize("kind", ["repeated", "digits", "stops"])
def test_quality_classifier_sees_what_one_statistic_shows(spark, kind):
    rng = random.Random(12)
    rows = [(i, told_by_one_statistic(rng, kind, i % 2 == 1), i % 2) for i in range(160)]
    table = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    scored, _ = rule_ensemble.score_quality(table.drop("quality"), table.drop("text"), F.col("doc_id") % 3 == 1, rule_ensemble.Fit(trees=4, depth=3))
    assert np.mean([r.predicted == r.doc_id % 2 for r in scored.where("held_out").collect()]) > 0.95


def test_digests_of_the_thin_queries(spark, tmp_path):
    texts = [(0, "a" * 5), (1, None)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op5_sentencepiece(spark, str(tmp_path)).collect()}
    ids = pieces.Vocabulary(Path(queries.piece_model()).read_bytes()).library.encode("aaaaa", add_bos=True, add_eos=True)
    assert got[0].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest() and got[0].n_tokens == len(ids)
    assert got[1].n_tokens == 2 and got[1].decoded_sha256 == hashlib.sha256(b"").hexdigest()
