"""Language model, toxicity and language: exact parts by brute force, models on held-out rows."""

import math
import os
import pickle
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from brute import ascii_words, clashing, documents, tuples
from test_dedup import ODD, REAL, prose, sample
from tapeloom.llm import language_model
from tapeloom.llm import toxicity as tox
from tapeloom.llm.language import languages, temperature
from tapeloom.llm.language_model import OWN, score_texts
from tapeloom.llm.toxicity import CharacterModel, toxicity, without_toxic

SF = "/root/testdata/sf0.01"


def fold(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


def base_scores(rows):
    tokens = {i: ascii_words(t) + [None] for i, t in rows}
    counts = Counter(w for i in tokens if i is None or fold(i, 7) != 2 for w in tokens[i])
    total = sum(counts.values())
    out = []
    for i, found in tokens.items():
        score = sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in found)
        out.append((i, i is not None and fold(i, 7) == 2, len(found), sum(counts[w] > 0 for w in found), total, score))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0))


@pytest.mark.parametrize("head_words", [40, 1 << 18])
def test_base_scores(spark, head_words):
    rows = list(enumerate(sample() * 2)) + [(None, "only here")]
    got = score_texts(clashing(documents(spark, rows)), rounds=1, head_words=head_words)
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"]
    for have, want in zip(tuples(got, *names), base_scores(rows), strict=True):
        assert have[:5] == want[:5] and math.isclose(have[5], want[5], rel_tol=1e-9)


def test_scores_of_repeated_rows_and_nothing(spark):
    docs = documents(spark, [(2, "a b c")] * 3 + [(3, "a b d"), (3, "other text"), (4, None)])
    got = score_texts(docs).collect()
    assert len(got) == 6 and len({r.score for r in got if r.doc_id == 2}) == 1
    assert all(r.score < 0 for r in got)
    assert score_texts(docs.limit(0)).count() == 0
    unseen = [i for i in range(100) if fold(i, 7) == 2][:3]
    alone = score_texts(documents(spark, [(i, "x y") for i in unseen])).collect()
    assert all(r.base_score == 0 and r.n_known == 0 and r.held_out for r in alone)


def test_probabilities_of_different_texts_stay_below_one(spark):
    train = [i for i in range(200) if fold(i, 7) != 2]
    texts = ["a b a c", "b b a", "c a", "d"] * 5
    rows = [(i, texts[k]) for k, i in enumerate(train[:20])]
    asked = [i for i in range(400) if fold(i, 7) == 2]
    one = [(asked[k], w) for k, w in enumerate(["", "a", "b", "c", "d", "never", "a a", "a b", "b a"])]
    got = {r.doc_id: r.score for r in score_texts(documents(spark, rows + one)).collect()}
    assert 0.05 < sum(10 ** got[i] for i, _ in one) < 1


@pytest.mark.parametrize("partitions", [1, 7, 16])
def test_scores_do_not_depend_on_partitions(spark, partitions):
    docs = documents(spark, list(enumerate(sample() * 3)) + [(None, "a b c"), (None, "a b c")])
    # several shards
    want = tuples(score_texts(docs.coalesce(2), shard_tokens=400), "doc_id", "score")
    got = tuples(score_texts(docs.repartition(partitions), shard_tokens=400), "doc_id", "score")
    assert [g[0] for g in got] == [w[0] for w in want]
    assert all(math.isclose(g[1], w[1], rel_tol=1e-9) for g, w in zip(got, want))


def test_word_probabilities_add_up():
    random = np.random.default_rng(1)
    counts = np.sort(random.integers(1, 5000, 700))[::-1].astype(float)
    class_of = language_model.class_of_ranks(counts)
    assert (np.diff(class_of[:700]) >= 0).all() and class_of[700:].tolist() == [language_model.OTHER] * (len(class_of) - 700)
    head = language_model.Head(None, None, None, counts, class_of, 1, int(counts.sum()), 700, 0, 0)
    words = language_model.Words.start(head)
    q = random.normal(size=(3, language_model.DIMENSION))
    at = random.integers(0, len(words.bias), 4000)
    kind = class_of[OWN + at].astype(int) - OWN
    given = random.normal(size=(4000, language_model.DIMENSION))
    seen = words.train(lambda n: given[n], at, kind, np.ones(4000))
    assert seen.sum() == 4000 and np.abs(words.vectors).max() > 0
    s, z = q @ words.vectors.T + words.bias, words.normalisers(q)
    for c in range(language_model.BINS):
        low, high = words.first[c], words.first[c + 1]
        if high > low:
            assert np.allclose(np.log(np.exp(s[:, low:high]).sum(axis=1)), z[:, c], atol=1e-5)


def test_words_in_a_class_follow_their_context():
    """Two contexts, each with its own words: the learned shares come near the true ones."""
    counts = np.concatenate([np.full(OWN, 1000.0), np.full(40, 50.0)])
    head = language_model.Head(None, None, None, counts, language_model.class_of_ranks(counts), 1, 1, 1, 0, 0)
    words = language_model.Words.start(head)
    words.first = np.concatenate([[0], np.full(language_model.BINS, 40)])
    words.log_share = np.full(40, -np.log(40))
    words.bias = words.log_share.copy()
    random = np.random.default_rng(1)
    side = random.integers(0, 2, 60_000)
    q = np.zeros((60_000, language_model.DIMENSION))
    q[:, 0] = 2 * side - 1
    words.train(lambda n: q[n], random.integers(0, 20, 60_000) + 20 * side, np.zeros(60_000, int), np.ones(60_000))
    p = np.exp(q[:2, :1] * words.vectors[:, 0] + words.bias)
    p /= p.sum(axis=1, keepdims=True)
    for k in range(2):
        assert p[k, 20 * side[k] : 20 * side[k] + 20].sum() > 0.9


def test_copies_of_sent_parameters_have_the_usual_type():
    """Tasks get parameters unpickled, with a type object of their own that sends ``np.add.at`` down a slow path."""
    counts = np.full(OWN + 40, 50.0)
    head = language_model.Head(None, None, None, counts, language_model.class_of_ranks(counts), 1, 1, 1, 0, 0)
    model = language_model.LogBilinear.start(np.full(language_model.CLASSES, 1 / language_model.CLASSES))
    words = language_model.Words.start(head)
    sent_model, sent_words = pickle.loads(pickle.dumps((model, words), 5))
    own_model, own_words = sent_model.copy(), sent_words.copy()
    assert all(a.dtype is np.dtype(np.float64) for a in [*own_model.arrays(), own_words.vectors, own_words.bias, own_words.log_share])
    assert own_words.first.dtype is np.dtype(np.int64)
    for a, b in zip([*vars(model).values(), *vars(words).values()], [*vars(own_model).values(), *vars(own_words).values()]):
        assert a is not b and np.array_equal(a, b)


@REAL
def test_model_beats_counts_on_held_out_texts(spark):
    rows = score_texts(spark.read.parquet(f"{SF}/documents.parquet")).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_class_normalisers():
    import numpy as np
    from tapeloom.llm.language_model import CLASSES, LogBilinear

    model = LogBilinear.start(np.full(CLASSES, 1 / CLASSES))
    z = model.normalisers()
    s = model.predicted(np.array([3]), np.array([CLASSES])) @ model.target.T + model.bias
    assert math.isclose(float(np.exp(s - z[3, CLASSES]).sum()), 1.0, rel_tol=1e-9)


@pytest.fixture(scope="module")
def characters(spark):
    text = "you are an idiot and a moron the clown is stupid loser the and you are is not hello worthless " * 50
    return tox.character_model(documents(spark, [text, None, ""]))


@pytest.mark.parametrize(
    "written,meant",
    [("1d10t", "idiot"), ("i d i o t", "idiot"), ("M.O.R.O.N", "moron"), ("l0s3r", "loser"), ("iiidiooot", "idiot"),
     ("stuuupid", "stupid"), ("the c l o w n is", "the clown is"), ("plain words", "plain words"), ("10 000", "10 000")],
)
def test_deobfuscation(characters, written, meant):
    assert characters.deobfuscate(written) == meant
    (chunk,) = tox._restored(pa.array(["before " + written + " after"]), characters)
    assert chunk.text(0).decode() == f"before {meant} after"


def cheapest_reading(model, stretch):
    """Least (cost, reading) over every way to read a stretch, one by one."""
    best = []

    def read(at, a, b, last, total, text):
        if at == len(stretch):
            best.append((total + model.cost[a, b, 0], text))
            return
        c = stretch[at].lower()
        step = lambda s: total + model.cost[a, b, s]
        if c in tox._SYMBOL:
            read(at + 1, b, tox._SYMBOL[c], c, step(tox._SYMBOL[c]), text + c)
            if c == last:
                read(at + 1, a, b, c, total + tox.SQUEEZE, text)
        for letter in tox.LEET.get(c, ""):
            s = tox._SYMBOL[letter]
            read(at + 1, b, s, letter, step(s) + tox.IMITATE, text + letter)
            if letter == last:
                read(at + 1, a, b, letter, total + tox.IMITATE + tox.SQUEEZE, text)
        if c in tox.SEPARATORS:
            read(at + 1, a, b, "", total + tox.DROP, text)
            if b:
                read(at + 1, b, 0, "", step(0), text + " ")
        elif c not in tox._SYMBOL:
            read(at + 1, b, 0, "", step(0) + tox.KEEP_SYMBOL, text + c)

    read(0, 0, 0, "", 0.0, "")
    return min(best)


def test_viterbi_equals_all_readings(characters):
    import random

    draw = random.Random(4)
    for _ in range(150):
        stretch = "".join(draw.choice("1d0it $m.r-o3s@ll") for _ in range(draw.randint(1, 7)))
        cost, text = cheapest_reading(characters, stretch)
        found = characters._restore(stretch)
        again = [c for c, t in [cheapest_reading(characters, stretch)] if t == found]
        assert found == text or not again, (stretch, found, text)


def test_long_stretches_are_restored(characters):
    word = "l0s3r" * 12
    assert len(word) == 60 and characters.deobfuscate(f"a {word} b") == f"a {'loser' * 12} b"
    long = "m0r0n" * 40_000
    assert characters.deobfuscate(long) == "moron" * 40_000


def test_trigrams_stay_inside_texts():
    def counted(texts):
        (found,) = tox._trigrams([pa.record_batch({"text": pa.array(texts)})])
        return dict(zip(found.column("trigram").to_pylist(), found.column("count").to_pylist()))

    one, two = counted(["abc"]), counted(["Œuf"])
    both = counted(["abc", "Œuf"])
    zero = 0
    assert {k: v for k, v in both.items() if k != zero} == {
        k: one.get(k, 0) + two.get(k, 0) for k in {*one, *two} if k != zero
    }
    oe = tox._SYMBOL["œ"]
    assert (0 * tox.SYMBOLS + 0) * tox.SYMBOLS + oe in two


def test_restoring_many_texts_keeps_them_apart(characters):
    texts = ["", None, "1d10t", "ok", "x" * 5000, "i d i o t", " ", "end 1d10t", "é é é é", "aaa " * 300]
    got = [c.text(i).decode() for c in tox._restored(pa.array(texts), characters) for i in range(len(c.lengths))]
    assert got[2] == "idiot" and got[3] == "ok" and got[5] == "idiot" and got[7] == "end idiot"
    assert got[0] == got[1] == "" and len(got) == len(texts)


def toxic_case():
    rows, labels = [], []
    bad = ["idiot", "moron", "stupid", "loser"]
    for k in range(400):
        toxic = k % 4 == 0
        words = prose(k, 60).split()
        if toxic:
            words[k % 50] = bad[k // 4 % 4]
        rows.append((k, " ".join(words)))
        labels.append((k, 1, int(toxic)))
    return rows, labels


LABEL_TYPE = "doc_id long, quality int, toxic int"


def test_toxicity(spark):
    rows, labels = toxic_case()
    extra = [(1000, "you 1d10t there"), (1001, "what a m o r o n he is"), (1002, ""), (1003, None), (1004, "x" * 100_000)]
    docs = clashing(documents(spark, rows + extra))
    table = spark.createDataFrame(labels + [(None, 1, 1), (1002, None, None), (0, 0, 0)], LABEL_TYPE)
    got = {r.doc_id: r for r in toxicity(docs, table).collect()}
    assert len(got) == 405 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    truth = {i: y for i, _, y in labels}
    wrong = [i for i in truth if got[i].predicted != truth[i]]
    assert len([i for i in wrong if fold(i, 4) == 2]) <= 3 and len(wrong) <= 10
    assert got[1000].predicted == got[1001].predicted == 1
    assert got[1002].predicted == got[1003].predicted == got[1004].predicted == 0
    assert all(r.held_out == (fold(i, 4) == 2) for i, r in got.items())
    odd = clashing(documents(spark, rows[:40]))
    first = odd.select("__toxicity", "score", *[f"`{c}`" for c in odd.columns if c not in ("__toxicity", "score")])
    some = without_toxic(first, table)
    assert some.columns == first.columns and {r["__toxicity"] for r in some.collect()} == {"x"}
    kept = without_toxic(documents(spark, rows + extra), table)
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.predicted}
    assert kept.columns == documents(spark, []).columns


def test_toxicity_without_labels_or_texts(spark):
    rows, labels = toxic_case()
    docs, table = documents(spark, rows[:20] + [(None, "id")]), spark.createDataFrame(labels, LABEL_TYPE)
    assert {r.predicted for r in toxicity(docs, table.limit(0)).collect()} == {0}
    assert {r.predicted for r in toxicity(docs, table.where("toxic = 0")).collect()} == {0}
    assert toxicity(docs.limit(0), table).count() == 0


@REAL
def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity(docs, labels).where("held_out").join(labels, "doc_id").collect()
    right = sum(r.predicted == r.toxic for r in rows)
    assert right / len(rows) > 0.95
    assert sum(r.predicted for r in rows if r.toxic) / sum(r.toxic for r in rows) > 0.85


def test_languages(spark):
    lines = {"en": "the cat and the dog with that thing over there", "de": "der hund und die katze über das schöne feld",
             "fr": "le chien est près de la forêt où été déjà"}
    rows = [(k, f"{lines[l].upper() if k % 5 == 0 else lines[l]} {k}", l) for k, l in enumerate(list(lines) * 60)]
    odd = [(900 + k, t, None) for k, t in enumerate([None, "", "123 !?", "漢字", *ODD])]
    df = spark.createDataFrame([(i, t, l, "s", 0) for i, t, l in rows + odd], documents(spark, []).schema)
    got = {r.doc_id: r for r in languages(clashing(df)).collect()}
    assert all(got[i].lang_pred == l for i, _, l in rows)
    assert [got[900 + k].lang_pred for k in range(3)] == ["und"] * 3 and got[903].lang_pred in lines
    assert all(0 <= r.score <= 1 for r in got.values()) and got[900].score == 0
    unlabelled = languages(documents(spark, ["text", None])).collect()
    assert {(r.lang_pred, r.score) for r in unlabelled} == {("und", 0.0)}
    assert languages(df.limit(0)).count() == 0


@REAL
def test_languages_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = languages(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.97


def test_temperature_calibrates():
    import numpy as np

    random = np.random.default_rng(0)
    true = random.normal(0, 1, (4000, 3))
    p = np.exp(true) / np.exp(true).sum(1, keepdims=True)
    labels = np.array([random.choice(3, p=row) for row in p])
    assert 2.5 < temperature(3 * true, labels) < 3.6
