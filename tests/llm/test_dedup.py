"""Sharding, SimHash, suffix, embedding and benchmark operators against brute force."""

import os
import random

import numpy as np
import pytest

from brute import (
    clashing,
    documents,
    leak_details,
    leak_rows,
    shard_rows,
    simhash_rows,
    suffix_rows,
    tuples,
    vector_rows,
)
from tapeloom.llm.components import components
from tapeloom.llm.decontaminate import Statistics, _one, benchmark_leaks, build_index, split_item, without_leaks
from tapeloom.llm.embeddings import vector_groups
from tapeloom.llm.sharding import byte_shards
from tapeloom.llm.simhash import keep_one, simhash_groups
from tapeloom.llm.suffix_dedup import DedupIndex, common_prefixes, suffix_dedup, without_repeats

SF = "/root/testdata/sf0.001"
REAL = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
ODD = [None, "", " \t\n", "a", "Word", "word", "é ß 漢字 🙂", "x " * 30, "\x00\x01", "A" * 3000, "ab" * 900, "ab" * 900]


def prose(seed, count):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghié") for _ in range(rng.randint(1, 9))) for _ in range(count))


def sample():
    """Shared passages, edited and exact copies, inner repeats, odd texts."""
    base, passage = prose(1, 300), prose(2, 90)
    words = base.split()
    edited = [" ".join(words[:k] + ["changed"] + words[k + 1 :]) for k in (3, 120, 250)]
    mixed = [prose(10 + k, 40) + " " + passage + " " + prose(50 + k, 70) for k in range(6)]
    return [base, base, *edited, *mixed, passage + passage, prose(3, 2000), base[5:-7], *ODD]


def rows_of(texts):
    return list(enumerate(texts))


@pytest.mark.parametrize("length,gram,batches", [(400, 128, 4), (400, 64, 4), (60, 20, 3), (60, 20, 1)])
def test_suffix_dedup(spark, length, gram, batches):
    texts = sample()
    got = suffix_dedup(clashing(documents(spark, texts)), length=length, gram=gram, batches=batches)
    assert tuples(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == suffix_rows(rows_of(texts), length)


def test_suffix_dedup_random_cuts(spark):
    rng = random.Random(5)
    pool = [prose(100 + k, 60) for k in range(4)]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(1, 4)):
            p = rng.choice(pool)
            a = rng.randint(0, len(p) // 2)
            parts.append(p[a : a + rng.randint(20, 300)])
        texts.append(rng.choice(["", "#", "é"]).join(parts))
    got = suffix_dedup(documents(spark, texts), length=64, gram=16, stretch=8)
    assert tuples(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == suffix_rows(rows_of(texts), 64)


def test_suffix_dedup_rows_that_repeat_and_null_ids(spark):
    text = prose(7, 100)
    rows = [(1, text), (1, text), (None, text[:450]), (None, None), (2, prose(8, 100)), (2, prose(9, 90))]
    got = tuples(suffix_dedup(documents(spark, rows)), "doc_id", "n_bytes", "n_removed")
    size = len(text.encode())
    assert got.count((1, size, size)) == 2 and len(got) == len(rows)
    assert (None, 0, 0) in got and any(r[0] is None and r[1] == r[2] > 0 for r in got)


def test_suffix_dedup_long_text_in_segments(spark, monkeypatch):
    texts = [prose(20, 900), prose(20, 900)[700:2500], "z" * 5000]
    from tapeloom.llm import suffix_dedup as module

    class Small:
        pass

    chunk = next(module.chunks(__import__("pyarrow").array([texts[0]])))
    monkeypatch.setattr(module, "SEGMENT", 300)
    parts = list(module._segments(chunk, 400))
    starts = [b + p for d, o, b in parts for p in range(len(d) - 399)]
    assert starts == list(range(len(chunk.data) - 399)) and len(parts) > 5
    got = suffix_dedup(documents(spark, texts))
    assert tuples(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == suffix_rows(rows_of(texts))


def test_suffix_stage_keeps_columns_and_valid_text(spark):
    shared = "é" * 300
    docs = documents(spark, ["a" + shared + "b", "cc" + shared + "d", None, "clean"])
    out = without_repeats(docs)
    assert out.columns == docs.columns
    assert tuples(out, "doc_id", "text", "n_chars") == [(0, "ab", 2), (1, "ccd", 3), (2, None, 0), (3, "clean", 5)]


def passages(count, seed=3):
    """Documents with planted passages of ``count`` words, two of each, and clean ones."""
    texts = [f"{prose(seed + k, 60)} {prose(900 + k // 2, count)} {prose(seed + 40 + k, 80)}" for k in range(6)]
    return texts + [prose(seed + 100 + k, 200) for k in range(4)]


@pytest.mark.parametrize("count", [51, 60, 80])
def test_stage_cuts_passages_of_over_50_words(spark, count):
    from corpus_pipeline import cut_repeats

    texts = passages(count)
    # shorter passages stay: 49 words, and one long repeated word
    short = [f"{prose(700 + k, 20)} {prose(990, 45)} {prose(720 + k, 20)} {'y' * 600} {prose(740 + k, 9)}" for k in range(2)]
    docs = clashing(documents(spark, texts + short))
    out = {r.doc_id: r.text for r in cut_repeats(spark, docs, "").collect()}
    for k in range(6):
        assert prose(900 + k // 2, count) not in out[k] and out[k].startswith(prose(3 + k, 60)[:-1])
        assert len(out[k]) <= len(texts[k]) - len(prose(900 + k // 2, count))
    assert [out[k] for k in range(6, 12)] == texts[6:] + short


@pytest.mark.parametrize("min_words", [0, 12])
def test_runs_of_few_words_stay(spark, min_words):
    texts = sample() + passages(20)
    got = suffix_dedup(documents(spark, texts), length=60, gram=24, min_words=min_words, batches=2)
    want = suffix_rows(rows_of(texts), 60, min_words)
    assert tuples(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def test_common_prefixes_of_sorted_suffixes():
    rng = np.random.default_rng(2)
    rows = rng.integers(0, 3, (200, 12)).astype(np.uint8)
    rows = rows[np.lexsort(rows.T[::-1])]
    plain = [0] + [next((k for k in range(12) if a[k] != b[k]), 12) for a, b in zip(rows, rows[1:])]
    assert common_prefixes(rows).tolist() == plain and common_prefixes(rows[:1]).tolist() == [0]


def test_levels_are_stored_and_merged(spark, tmp_path):
    """Batch after batch against what is stored: each as brute force over all texts so far."""
    index = DedupIndex(spark, str(tmp_path / "index"), length=60, gram=20, stretch=8)
    pool = [prose(60 + k, 30) for k in range(4)]
    rng, seen, sizes = random.Random(9), [], []
    for n in range(4):
        batch = [(100 * n + k, prose(1000 + 10 * n + k, 15) + " " + rng.choice(pool) + " " + rng.choice(["", "tail " * 20])) for k in range(8)]
        batch.append((100 * n + 50, None))
        seen += batch
        # a new session of the same index
        index = DedupIndex(spark, str(tmp_path / "index"), length=60, gram=20, stretch=8)
        before = index.store.current().folders
        found = tuples(index.add(documents(spark, batch)), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
        assert found == [r for r in suffix_rows(seen, 60) if r[0] in dict(batch)]
        assert any(r[2] for r in found)
        sizes.append(index.levels)
        # earlier suffixes are kept as they were, not made again
        assert index.store.current().folders["suffixes"][: len(before.get("suffixes", []))] == before.get("suffixes", [])
    assert sizes == [[1], [2], [2, 1], [4]]
    level = index.store.read("level_4")
    assert level.agg({"copies": "sum"}).first()[0] == index.store.read("suffixes").count()


def test_stages_keep_columns_of_any_name(spark):
    rows = [(1, prose(5, 200)), (1, prose(5, 200)), (None, prose(6, 90)), (None, None), (7, "")]
    docs = clashing(documents(spark, rows))
    for stage_of in (without_repeats, keep_one):
        out = stage_of(docs)
        assert out.columns == docs.columns
        assert all(r[c] == "x" for r in out.collect() for c in ("_id", "_key", "_null", "0", "score"))
        assert stage_of(docs.limit(0)).collect() == []
    assert without_repeats(docs).count() == 5 and keep_one(docs).count() == 3
    assert suffix_dedup(docs.limit(0)).collect() == simhash_groups(docs.limit(0)).collect() == []


def test_simhash_of_a_very_long_text(spark):
    rows = [(0, "word " * 300_000), (1, "word " * 300_000), (2, "other")]
    got = {r.doc_id: r.component_id for r in simhash_groups(documents(spark, rows)).collect()}
    assert got == {0: 0, 1: 0, 2: 2}


@REAL
def test_suffix_dedup_test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert tuples(suffix_dedup(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == suffix_rows(rows)


def test_simhash(spark):
    texts = sample()
    got = simhash_groups(clashing(documents(spark, texts)), block=4)
    assert tuples(got, "doc_id", "fingerprint", "component_id") == simhash_rows(rows_of(texts))


@REAL
def test_simhash_test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert tuples(simhash_groups(docs), "doc_id", "fingerprint", "component_id") == simhash_rows(rows)


def test_simhash_stage_keeps_one_of_each_group(spark):
    text = prose(4, 40)
    rows = [(7, text), (3, text), (3, text), (5, prose(5, 40)), (None, ""), (None, None), (9, prose(6, 50))]
    docs = documents(spark, rows)
    out = keep_one(docs)
    assert out.columns == docs.columns
    assert [r[0] for r in tuples(out, "doc_id")] == [3, 5, 9, None]


def test_near_fingerprints_finds_every_distance(spark):
    from tapeloom.llm.simhash import near_fingerprints

    rng = random.Random(9)
    prints = set()
    for _ in range(60):
        p = rng.getrandbits(64)
        prints.add(p)
        for bits in (1, 2, 3, 4):
            q = p
            for b in rng.sample(range(64), bits):
                q ^= 1 << b
            prints.add(q)
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    df = spark.createDataFrame([(s,) for s in signed.values()], "fp long")
    linked = components(near_fingerprints(df, block=8))
    got = {r.node: r.component for r in linked.collect()}
    from brute import least_connected

    want = least_connected(sorted(signed.values()), lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 3)
    assert {k: got.get(k, k) for k in want} == want


def test_components_shapes(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    other = [(5001, 5000), (5000, 5001), (6000, 6000), (None, 4)]
    df = spark.createDataFrame(chain + star + other, "src long, dst long")
    got = {r.node: r.component for r in components(df).collect()}
    assert {got[i] for i in range(301)} == {0} and {got[1000 + i] for i in range(200)} == {1000}
    assert got[5001] == 5000 and got[6000] == 6000
    assert components(df.limit(0)).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_embedding_groups(spark):
    rng = np.random.default_rng(3)
    rows, k = [], 0
    for _ in range(25):
        centre = rng.standard_normal(32)
        for scale in (0.0, 0.05, 0.1, 0.2):
            rows.append((k, [float(np.float32(x)) for x in centre * (1 + scale) + scale * rng.standard_normal(32)]))
            k += 1
    rows += [(k, rows[0][1]), (k + 1, rows[0][1]), (k + 2, None), (k + 3, [0.0] * 32), (k + 4, [float("nan")] * 32)]
    rows += [(k + 5, [None] + [1.0] * 31), (k + 6, []), (k + 7, [1.0, 2.0]), (k + 8, [2.0, 4.0]), (k + 9, [-0.0, 1.0])]
    rows += [(k + 10, [0.0, 1.0]), (k + 11, [float("inf"), 1.0])]
    df = vectors(spark, [(i, v, None) for i, v in rows])
    for block in (4, 1024):
        got = vector_groups(clashing(df), block=block)
        assert tuples(got, "vec_id", "n_links", "component_id") == vector_rows(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.collect())
    assert vector_groups(df.limit(0)).count() == 0


@REAL
def test_embedding_recall_test_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    matrix = np.array([v for _, v in rows], dtype=np.float64)
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    true = int((matrix @ matrix.T >= 0.95).sum()) - len(rows)
    found = sum(r.n_links for r in vector_groups(df).collect())
    assert true >= found >= 0.9 * true


def test_shards(spark):
    texts = sample() * 3
    got = byte_shards(clashing(documents(spark, texts)), 8)
    assert tuples(got, "doc_id", "size", "text_crc32", "shard", "slot") == shard_rows(rows_of(texts))
    assert {(r.law, r.grown_shard) for r in got.collect()} == {("bytes", None)}
    assert byte_shards(documents(spark, texts).limit(0), 8).count() == 0


def test_shards_with_one_hot_id(spark):
    rows = [(None, "n")] * 3 + [(5, "same")] * 200 + [(k, "t" * k) for k in range(50)]
    got = byte_shards(documents(spark, rows), 8).collect()
    size, slots = {}, {}
    for r in got:
        size[r.shard] = size.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(got) == len(rows) and max(size.values()) - min(size.values()) <= 2 * max(r.size for r in got)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


ITEM_TYPE = "item_id long, text string"


def leak_case():
    items = [(k, prose(200 + k, n)) for k, n in enumerate([6, 12, 30, 60, 59, 3])]
    items += [(10, "What is the way? " + prose(300, 20)), (11, None), (12, ""), (13, "...")]
    items += [(14, "echo " * 40), (15, items[2][1])]
    docs = []
    for k, (_, t) in enumerate(items):
        if t:
            docs.append(prose(400 + k, 500) + ". " + t.upper() + " " + prose(500 + k, 700))
            docs.append(" ".join(t.split()[: len(t.split()) * 3 // 5]) + " " + prose(600 + k, 30))
            w = t.split()
            docs.append(" ".join(w[:-1] + ["other"]) + " " + prose(700 + k, 300))
    return items, docs + sample()


def test_benchmark_leaks(spark):
    items, docs = leak_case()
    table = spark.createDataFrame(items, ITEM_TYPE)
    df = clashing(documents(spark, docs))
    want = leak_rows(rows_of(docs), [i for i in items])
    assert len(want) > 15
    assert tuples(benchmark_leaks(df, table), "doc_id", "item_id") == want
    # several indexes change no column
    names = ["doc_id", "item_id", "score", "overlap", "question_overlap", "answer_overlap"]
    near = lambda rows: [tuple(None if v is None else round(v, 9) for v in r) for r in rows]
    whole = near(tuples(benchmark_leaks(df, table), *names))
    assert near(tuples(benchmark_leaks(df, table, index_bytes=700), *names)) == whole
    assert near(leak_details(rows_of(docs), items, want)) == whole
    out = without_leaks(documents(spark, docs), table)
    assert sorted(r.doc_id for r in out.collect()) == sorted(set(range(len(docs))) - {d for d, _ in want})


def test_benchmark_empty_sides(spark):
    items, docs = leak_case()
    table, df = spark.createDataFrame(items, ITEM_TYPE), documents(spark, docs)
    assert benchmark_leaks(df.limit(0), table).count() == 0
    assert benchmark_leaks(df, table.limit(0)).count() == 0
    assert without_leaks(df, table.limit(0)).count() == len(docs)


def test_leaks_are_judged_row_by_row(spark):
    items, docs = leak_case()
    table = spark.createDataFrame(items, ITEM_TYPE)
    leak, clean = next(d for d in docs if leak_rows([(0, d)], items)), prose(4321, 80)
    rows = [(None, leak), (None, clean), (5, leak), (5, clean), (5, clean), (6, None), (7, "")]
    kept = without_leaks(clashing(documents(spark, rows)), table)
    assert sorted((str(r.doc_id), r.text or "") for r in kept.collect()) == sorted(
        [("None", clean), ("5", clean), ("5", clean), ("6", ""), ("7", "")]
    )
    assert kept.columns == clashing(documents(spark, rows)).columns


def test_item_thresholds_are_below_full_scores():
    terms = np.unique(np.concatenate([_one(c) for c in "abcdefgh"]))
    known = Statistics(2, 9.0, 10, terms, np.array([2.0 if t == _one("a")[0] else 1.0 for t in terms]))
    index = build_index([(1, "a b c d e f g h"), (2, "a a a a a a a a a a"), (3, "")], known)
    assert index.ids == [1, 2] and (index.thresholds > 0).all()
    assert split_item("Who? Me.") == ("Who?", " Me.") and split_item("One. Two. Three.") == ("One. Two.", " Three.")


@REAL
def test_benchmark_leaks_test_table(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = leak_rows([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert tuples(benchmark_leaks(docs, items), "doc_id", "item_id") == want
