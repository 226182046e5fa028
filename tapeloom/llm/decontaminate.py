"""Benchmark leaks: a BM25 index of the test items, searched with every training passage.

The index is small and travels to the passages. Contributions of an item's
terms are divided by the item's own threshold, so "above threshold" means a sum
of at least 1 for every item. The threshold is the least score that a passage
can reach which still holds the wanted share of the item's shingles: all of its
terms but the dearest set that so few missing shingles allow to be absent. The
search is therefore lossless; verification by shingles decides.

Search is block-max WAND over a batch of passages at once. A passage whose term
maxima do not add up to 1 has no pivot and is skipped; of the others only those
blocks of items are opened whose block maxima add up to 1; there items are
scored in full.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.common import numbered, shipped
from tapeloom.llm.text import Chunk, chunks, hash_words, mix64, ragged, spans
from tapeloom.plans.staging import stage

SHINGLE = 5
SIMILARITY = 0.8
K1, B = 1.2, 0.75
BLOCK_ITEMS = 16
LEAST_PASSAGE = 256
# bytes of item texts in one index; more items are searched in several indexes, one after another
INDEX_BYTES = 32 << 20
SCORE_CELLS = 1 << 22

_TOKEN = np.zeros(256, dtype=bool)
_TOKEN[48:58] = _TOKEN[97:123] = True
_TOKEN[128:] = True


def _tokens(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and owners of the words of lower-cased texts: runs of a-z, 0-9 and non-ASCII bytes."""
    starts, ends, owner = spans(chunk, _TOKEN[chunk.data])
    return hash_words(chunk.data, starts, ends), owner


def _shingle_hashes(tokens: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` tokens, by its first token."""
    n = len(tokens) - size + 1
    out = np.zeros(max(n, 0), dtype=np.uint64)
    for k in range(size):
        out = mix64((out ^ tokens[k : k + len(out)]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k + 1))
    return out


def _one(text: str) -> np.ndarray:
    chunk = next(chunks(pc.utf8_lower(pa.array([text or ""]))))
    return _tokens(chunk)[0]


def split_item(text: str) -> tuple[str, str]:
    """Question and answer: after the last question mark, else the last sentence is the answer."""
    text = text.strip()
    cut = text.rfind("?") + 1
    if not 0 < cut < len(text):
        ends = [m.end() for m in re.finditer(r"[.!?](?=\s)", text)]
        cut = ends[-1] if ends else len(text)
    return text[:cut], text[cut:]


@dataclass
class ItemIndex:
    """Postings by term in the order of items, their block maxima, and each item's shingles."""

    ids: list
    terms: np.ndarray
    first: np.ndarray
    items: np.ndarray
    weights: np.ndarray
    block_first: np.ndarray
    blocks: np.ndarray
    block_max: np.ndarray
    term_max: np.ndarray
    thresholds: np.ndarray
    shingles: list
    question_shingles: list
    sizes: list
    passage: int

    @property
    def count(self) -> int:
        return len(self.ids)


@dataclass
class Statistics:
    """Of all items: how many have words, their mean and greatest length, and in how many each term is.

    ``terms`` may be those of some items only.
    """

    items: int
    average: float
    longest: int
    terms: np.ndarray
    frequencies: np.ndarray


def build_index(
    items: list[tuple[int, str]], statistics: Statistics, similarity: float = SIMILARITY, shingle: int = SHINGLE
) -> ItemIndex:
    """Index of ``(item_id, text)``; items without any word are left out, they match nothing.

    Scores follow the ``statistics`` of all items, whatever part of them is indexed here.
    """
    ids, words_of, questions = [], [], []
    for item_id, text in sorted(items, key=lambda x: (x[0] is None, x[0] or 0, x[1] or "")):
        question, answer = split_item(text or "")
        q, a = _one(question), _one(answer)
        if len(q) + len(a):
            ids.append(item_id)
            words_of.append(np.concatenate([q, a]))
            questions.append(len(q))
    terms = np.unique(np.concatenate(words_of)) if words_of else np.zeros(0, np.uint64)
    df = statistics.frequencies[np.searchsorted(statistics.terms, terms)]
    counted = [np.unique(np.searchsorted(terms, w), return_counts=True) for w in words_of]
    idf = np.log1p((statistics.items - df + 0.5) / (df + 0.5))
    average = statistics.average
    rows, sizes, prints, question_prints, thresholds = [], [], [], [], []
    for k, (w, q, (term, tf)) in enumerate(zip(words_of, questions, counted)):
        size = min(shingle, len(w))
        all_shingles = _shingle_hashes(w, size)
        allowed = int((1 - similarity) * len(all_shingles) + 1e-9)
        score = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(w) / average))
        # an absent term of frequency f costs at least f shingles: the dearest absence is a knapsack
        order = np.argsort(-score / tf)
        order = order[tf[order] <= allowed]
        room, lost = allowed, 0.0
        for t in order:
            part = min(1.0, room / tf[t])
            lost += part * score[t]
            room -= part * tf[t]
            if room <= 0:
                break
        threshold = (score.sum() - lost) * (1 - 1e-9)
        thresholds.append(threshold)
        rows.append((term, np.full(len(term), k), score / threshold))
        sizes.append(size)
        prints.append(all_shingles)
        question_prints.append(max(0, min(q - size + 1, len(all_shingles))))
    term = np.concatenate([r[0] for r in rows]) if rows else np.zeros(0, np.int64)
    item = np.concatenate([r[1] for r in rows]) if rows else np.zeros(0, np.int64)
    weight = np.concatenate([r[2] for r in rows]) if rows else np.zeros(0)
    order = np.lexsort((item, term))
    term, item, weight = term[order], item[order], weight[order]
    first = np.searchsorted(term, np.arange(len(terms) + 1))
    block = item // BLOCK_ITEMS
    new = np.flatnonzero((np.diff(term, prepend=-1) != 0) | (np.diff(block, prepend=-1) != 0))
    block_max = np.maximum.reduceat(weight, new) if len(new) else weight
    block_first = np.searchsorted(term[new], np.arange(len(terms) + 1))
    term_max = np.maximum.reduceat(weight, first[:-1]) if len(terms) else weight
    return ItemIndex(
        ids, terms, first, item, weight, block_first, block[new], block_max, term_max, np.array(thresholds),
        prints, question_prints, sizes, max(LEAST_PASSAGE, 2 * statistics.longest),
    )


def _passages(tokens: np.ndarray, owner: np.ndarray, texts: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Half-overlapping passages of ``size`` words: first token, length, owning text."""
    count = np.bincount(owner, minlength=texts)
    begin = np.cumsum(count) - count
    stride = size // 2
    parts = np.where(count == 0, 0, np.maximum(1, -(-(count - stride) // stride)))
    text = np.repeat(np.arange(texts), parts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
    start = begin[text] + nth * stride
    return start, np.minimum(size, begin[text] + count[text] - start), text


def search(index: ItemIndex, tokens: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passages, items and BM25 scores of all pairs at or above the item's threshold."""
    none = np.zeros(0, dtype=np.int64)
    if not index.count or not len(tokens):
        return none, none, np.zeros(0)
    place = np.minimum(np.searchsorted(index.terms, tokens), len(index.terms) - 1)
    known = index.terms[place] == tokens
    out_p, out_i, out_s = [], [], []
    width = -(-index.count // BLOCK_ITEMS)
    step = max(1, SCORE_CELLS // index.count)
    for low in range(0, len(start), step):
        s, n = start[low : low + step], length[low : low + step]
        at = ragged(s, n)
        owner = np.repeat(np.arange(len(s)), n)[known[at]]
        term = place[at][known[at]]
        # distinct terms of each passage
        code = np.unique(owner * len(index.terms) + term)
        owner, term = code // len(index.terms), code % len(index.terms)
        bound = np.bincount(owner, index.term_max[term], minlength=len(s))
        pivot = bound[owner] >= 1
        owner, term = owner[pivot], term[pivot]
        if not len(owner):
            continue
        count = index.block_first[term + 1] - index.block_first[term]
        posting = ragged(index.block_first[term], count)
        cell = np.repeat(owner, count) * width + index.blocks[posting]
        open_block = np.bincount(cell, index.block_max[posting], minlength=len(s) * width) >= 1
        count = index.first[term + 1] - index.first[term]
        posting = ragged(index.first[term], count)
        who = np.repeat(owner, count)
        item = index.items[posting]
        opened = open_block[who * width + item // BLOCK_ITEMS]
        who, item, posting = who[opened], item[opened], posting[opened]
        total = np.bincount(who * index.count + item, index.weights[posting], minlength=1)
        hit = np.flatnonzero(total >= 1)
        out_p.append(hit // index.count + low)
        out_i.append(hit % index.count)
        out_s.append(total[hit] * index.thresholds[hit % index.count])
    if not out_p:
        return none, none, np.zeros(0)
    return np.concatenate(out_p), np.concatenate(out_i), np.concatenate(out_s)


def _leaks(index, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = index.value
        for batch in batches:
            ids, keys = batch.column("doc_id"), batch.column("text_key")
            for chunk in chunks(pc.utf8_lower(batch.column("text"))):
                tokens, owner = _tokens(chunk)
                start, length, text = _passages(tokens, owner, len(chunk.lengths), found.passage)
                rows = []
                for p, i, score in zip(*search(found, tokens, start, length)):
                    passage = tokens[start[p] : start[p] + length[p]]
                    wanted = found.shingles[i]
                    seen = np.isin(wanted, _shingle_hashes(passage, found.sizes[i]))
                    if seen.sum() >= similarity * len(wanted) - 1e-9:
                        cut = found.question_shingles[i]
                        share = lambda x: float(x.mean()) if len(x) else None
                        rows.append(
                            (ids[chunk.first + int(text[p])].as_py(), keys[chunk.first + int(text[p])].as_py(),
                             found.ids[i], float(score), share(seen), share(seen[:cut]), share(seen[cut:]))
                        )
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 3 + [pa.float64()] * 4)],
                        ["doc_id", "text_key", "item_id", "score", "overlap", "question_overlap", "answer_overlap"],
                    )

    return run


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each item and its distinct terms, in the part of the items it belongs to."""
    for batch in batches:
        rows = []
        for part, text in zip(batch.column("part").to_pylist(), batch.column("text").to_pylist()):
            question, answer = split_item(text)
            found = np.concatenate([_one(question), _one(answer)])
            if len(found):
                rows.append((part, len(found), np.unique(found).view(np.int64)))
        columns = [[r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows]]
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "words", "terms"])


def _indexes(items: DataFrame, similarity: float, shingle: int, index_bytes: int) -> Iterator[ItemIndex]:
    """Indexes of about ``index_bytes`` of item texts each; scores follow the statistics of all items."""
    texts = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null").distinct()
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-size // index_bytes)
    dealt = stage(texts.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(parts, 1)))))
    terms = stage(dealt.select("part", "text").mapInArrow(_item_terms, "part long, words long, terms array<long>"))
    count, total, longest = terms.agg(F.count(F.lit(1)), F.sum("words"), F.max("words")).first()
    entries = stage(terms.select("part", F.explode("terms").alias("term")))
    frequencies = stage(entries.groupBy("term").agg(F.count(F.lit(1)).alias("items")))
    for part in range(parts if count else 0):
        # both bounded: about index_bytes of text, and its terms
        own = dealt.where(F.col("part") == part).select("item_id", "text").collect()
        met = frequencies.join(entries.where(F.col("part") == part), "term", "left_semi").toArrow()
        term, df = met.column("term").to_numpy().view(np.uint64), met.column("items").to_numpy().astype(np.float64)
        order = np.argsort(term)
        statistics = Statistics(count, total / count, longest, term[order], df[order])
        yield build_index([tuple(r) for r in own], statistics, similarity, shingle)


def _named(docs: DataFrame) -> DataFrame:
    """Rows by id and a hash of the text, which tells rows apart that share an id."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")


_LEAK_TYPE = (
    "doc_id long, text_key long, item_id long, score double, overlap double, question_overlap double, answer_overlap double"
)


def _found(docs: DataFrame, items: DataFrame, similarity: float, shingle: int, index_bytes: int) -> DataFrame:
    spark = docs.sparkSession
    rows = _named(docs).where("text is not null")
    found = spark.createDataFrame([], _LEAK_TYPE)
    for index in _indexes(items, similarity, shingle, index_bytes):
        shared = spark.sparkContext.broadcast(index)
        found = found.union(rows.mapInArrow(_leaks(shared, similarity), _LEAK_TYPE))
    return found


@shipped
def benchmark_leaks(
    docs: DataFrame,
    items: DataFrame,
    similarity: float = SIMILARITY,
    shingle: int = SHINGLE,
    index_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """``(doc_id, item_id, score, overlap, question_overlap, answer_overlap)`` per leak.

    A document leaks an item if one of its passages holds ``similarity`` or more of
    the item's ``shingle``-word shingles (an item with fewer words is one shingle).
    Passages overlap by half and are twice as long as the longest item, 256 words
    at least. ``overlap`` is over question and answer together; the
    parts are given apart (a shingle that reaches into the answer counts there; a
    part without shingles is null). The best passage of each document and item is
    reported. Null and empty texts, on either side, leak nothing; repeated rows
    and repeated items are reported once per id pair. An item table beyond
    ``index_bytes`` is dealt to several indexes, searched in turn; scores and passages follow all
    items, so the number of indexes changes nothing.
    """
    found = _found(docs, items, similarity, shingle, index_bytes)
    best = F.struct("overlap", "score", "question_overlap", "answer_overlap")
    return found.groupBy("doc_id", "item_id").agg(F.max(best).alias("best")).select(
        "doc_id",
        "item_id",
        *[F.col(f"best.{c}").alias(c) for c in ("score", "overlap", "question_overlap", "answer_overlap")],
    )


@shipped
def without_leaks(
    docs: DataFrame,
    items: DataFrame,
    similarity: float = SIMILARITY,
    shingle: int = SHINGLE,
    index_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """``docs`` without the rows that leak an item.

    A row is judged by its own text: of rows that share an id only those that leak go, and a null id is no obstacle. Null
    and empty texts stay. All columns, whatever their names, are kept as they are; an empty table stays empty.
    """
    # written first: Catalyst then knows its size and broadcasts it only if it is small
    found = _found(docs, items, similarity, shingle, index_bytes)
    leaked = stage(found.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct())
    rows = numbered(docs)
    doc_id, text = (F.col(str(docs.columns.index(c))) for c in ("doc_id", "text"))
    same = doc_id.cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64(text) == F.col("_key"))
    return rows.join(leaked, same, "left_anti").toDF(*docs.columns)
