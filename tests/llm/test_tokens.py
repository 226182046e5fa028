"""Token counts and SentencePiece against plain models of both."""

import base64
import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from brute import ascii_words, clashing, documents, tuples
from test_dedup import ODD, sample
from tapeloom.llm.sentencepiece import Codec, decode, encode, encode_digest, encode_texts, parse_model
from tapeloom.llm.token_counts import LongestMatch, token_counts

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
pytestmark = pytest.mark.skipif(not os.path.exists(MODEL), reason="tokenizer files not present")
TEXTS = [*sample(), "  a  b ", " ▁▁x▁ y", "日本語 🙂 ﬁ", "<s> </s> <0x41> <unk>", " ", "a" * 700 + " b"]


def greedy(word, pieces, longest):
    count = at = 0
    while at < len(word):
        at += next(k for k in range(min(longest, len(word) - at), 0, -1) if word[at : at + k] in pieces)
        count += 1
    return count


def test_longest_match_on_random_vocabularies():
    rng = random.Random(4)
    for _ in range(30):
        pieces = {bytes([b]) for b in range(256)}
        pieces |= {bytes(rng.choice(b"abc ") for _ in range(rng.randint(2, 6))) for _ in range(rng.randint(0, 40))}
        automaton = LongestMatch(list(pieces))
        longest = max(map(len, pieces))
        found = [bytes(rng.choice(b"abcd") for _ in range(rng.randint(1, 30))) for _ in range(40)]
        data = np.frombuffer(b"".join(found), dtype=np.uint8)
        ends = np.cumsum([len(w) for w in found])
        got = automaton.counts(data, ends - [len(w) for w in found], ends)
        assert got.tolist() == [greedy(b" " + w, pieces, longest) for w in found]
        assert [automaton.count(b" " + w) for w in found] == got.tolist()


def test_vocabulary_must_be_complete():
    with pytest.raises(ValueError):
        LongestMatch([b"a", b"ab"])


def test_token_counts(spark):
    lines = open(VOCABULARY).read().splitlines()
    pieces = {base64.b64decode(line.split()[0]) for line in lines if line}
    longest = max(map(len, pieces))
    import re

    want = []
    for i, t in enumerate(TEXTS):
        found = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())
        want.append((i, len((t or "").encode()), len(found), sum(greedy(b" " + w, pieces, longest) for w in found)))
    got = token_counts(clashing(documents(spark, TEXTS)), VOCABULARY)
    assert tuples(got, "doc_id", "n_bytes", "n_words", "n_tokens") == want
    assert token_counts(documents(spark, TEXTS).limit(0), VOCABULARY).count() == 0


@pytest.fixture(scope="module")
def reference():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=MODEL)


def test_model_file(reference):
    model = parse_model(open(MODEL, "rb").read())
    size = reference.vocab_size()
    assert model.pieces == [reference.id_to_piece(i) for i in range(size)]
    assert np.allclose(model.scores, [reference.get_score(i) for i in range(size)])
    assert model.byte_fallback and model.unknown == reference.unk_id()


def test_encode_equals_sentencepiece_and_decodes(spark, reference):
    df = clashing(documents(spark, TEXTS))
    rows = {r.doc_id: r for r in encode(df, MODEL).collect()}
    for i, t in enumerate(TEXTS):
        assert rows[i].token_ids == reference.encode(t or ""), t
        assert rows[i].parity and rows[i].round_trip and rows[i].n_tokens == len(rows[i].token_ids)
        assert rows[i].text == t
    digest = {r.doc_id: r for r in encode_digest(df, MODEL).collect()}
    for i in rows:
        assert digest[i].ids_crc32 == zlib.crc32(np.array(rows[i].token_ids, "<i4").tobytes())
    back = decode(encode(documents(spark, TEXTS), MODEL).drop("text"), MODEL)
    assert {r.doc_id: r.text for r in back.collect()} == {i: (t or "").replace("▁", " ") for i, t in enumerate(TEXTS)}
    assert encode(documents(spark, TEXTS).limit(0), MODEL).count() == 0


def test_unigram_models_are_rebuilt():
    from tapeloom.llm.sentencepiece import NORMAL, UNIGRAM, UNKNOWN, PieceModel, build_tokenizer

    model = PieceModel(["<unk>", "▁a", "b", "▁ab"], [0.0, -1.0, -2.0, -1.5], [UNKNOWN, NORMAL, NORMAL, NORMAL], UNIGRAM)
    tokenizer = build_tokenizer(model)
    assert tokenizer.encode(" ab").ids == [3] and tokenizer.encode(" abb").ids == [3, 2]


def test_a_wrong_rebuild_is_told(reference):
    """Ids are those of the rebuilt tokenizer, so a rebuild with a piece missing shows in ids and parity."""
    from tapeloom.llm import sentencepiece as module

    content = open(MODEL, "rb").read()
    good, bad = Codec(content), Codec(content)
    lacking = parse_model(content)
    kept = [m for m in module._merges(lacking) if "".join(m) != "▁the"]
    real, module._merges = module._merges, lambda model: kept
    try:
        bad.tokenizer = module.build_tokenizer(lacking)
    finally:
        module._merges = real
    texts = pa.array(["the end", "no such piece", ""])
    (ids, count, parity, round_trip), = encode_texts(good, texts)
    assert parity.all() and round_trip.all() and ids.tolist() == sum(reference.encode(texts.to_pylist()), [])
    (ids, count, parity, round_trip), = encode_texts(bad, texts)
    assert parity.tolist() == [False, True, True] and round_trip.all()
    assert ids[: count[0]].tolist() != reference.encode("the end")


def test_remembered_units_do_not_change_results(monkeypatch):
    from tapeloom.llm import sentencepiece as module

    content = open(MODEL, "rb").read()
    texts = pa.array(TEXTS)
    first = np.concatenate([x[0] for x in encode_texts(Codec(content), texts)])
    monkeypatch.setattr(module, "REMEMBERED", 3)
    monkeypatch.setattr(module, "CHUNK_BYTES", 50)
    small = np.concatenate([x[0] for x in encode_texts(Codec(content), texts)])
    assert first.tolist() == small.tolist()


def test_units_met_often_stay_remembered(monkeypatch, reference):
    from tapeloom.llm import sentencepiece as module

    monkeypatch.setattr(module, "REMEMBERED", 20)
    monkeypatch.setattr(module, "CHUNK_BYTES", 20)
    texts = [f"the number w{n}x and so on z{n}y" for n in range(60)]
    codec = Codec(open(MODEL, "rb").read())
    learned, learn = [], codec.learn
    codec.learn = lambda names, units: learned.extend(units) or learn(names, units)
    found = list(encode_texts(codec, pa.array(texts)))
    assert np.concatenate([x[0] for x in found]).tolist() == sum(reference.encode(texts), [])
    assert all(x[2].all() and x[3].all() for x in found)
    assert learned.count(" the") == learned.count(" number") == 1
