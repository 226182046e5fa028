"""Removal of long repeated byte strings with a logarithmic family of suffix arrays.

**Sparse suffixes.** Every window of ``length`` bytes elects one anchor inside it:
the start of its ``gram``-byte string with the least hash (leftmost on ties). The
choice depends on the window's bytes alone, so equal windows elect the same place,
and neighbouring windows mostly share their anchor: about one suffix in 170 is
indexed instead of all. Equal windows have anchors whose suffixes agree in
``gram`` bytes or more, so ``gram`` bytes of each suffix are kept and sorted.

**Family of arrays.** A batch of documents becomes a suffix array: its suffixes in byte
order, range-partitioned, equal ones counted. A merge scan walks the batch's array and those of the
levels as one sorted run and takes the common prefix of every two neighbours from their bytes; ``gram``
bytes in common are a match. Levels as large as the batch (sizes are powers of two) are merged
with it into the next level by the same scan. Levels can be kept on disk (``DedupIndex``): a later batch
reads them and not the documents before it.

**Exact windows.** Suffixes with a matched prefix are candidates. A candidate stands
for a run of windows; their union is fingerprinted as a whole, and if it
occurs twice all its windows do. Of candidates whose union is single but whose prefix is
not, the windows are compared one by one, after a coarser step has left out the
stretches whose shared core is single. Fingerprints of windows have 112 bits or more.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm.blocks import whole_groups
from tapeloom.llm.common import numbered, ship, shipped
from tapeloom.llm.text import Chunk, chunks, eight_bytes, mix64, ragged, spans, words
from tapeloom.plans.staging import stage
from tapeloom.sources.versions import VersionedTable

LENGTH = 400
GRAM = 64
BATCHES = 4
# windows compared together in the step between whole candidates and single windows
STRETCH = 16
# a longer text is walked in segments of so many windows
SEGMENT = 1 << 19
# the rows of one prefix are dealt to so many tasks
SPREAD = 16

_BASE = np.uint64(0xD6E8FEB86659FD93)
_BASE_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, name: str, size: int) -> np.ndarray:
    known = _powers.get(name)
    if known is None or len(known) < size:
        steps = np.full(max(size, 1 << 16), base, dtype=np.uint64)
        steps[0] = 1
        known = _powers[name] = np.cumprod(steps)
    return known[:size]


class Prints:
    """Fingerprints of any byte range (8 bytes or more) of a byte array."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        terms = mix64(eight_bytes(data))
        terms *= _power(_BASE, "up", n)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(terms, out=self.sums[1:])
        self.down = _power(_BASE_INVERSE, "down", n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end - 7] - self.sums[start]) * self.down[start])


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _shaped(union: np.ndarray, shift: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Print of a run of windows: its bytes, its place at the anchor and its length."""
    shape = (shift.astype(np.uint64) << np.uint64(32)) | count.astype(np.uint64)
    return mix64(union ^ mix64(shape + _GOLDEN))


def anchors(
    data: np.ndarray, offsets: np.ndarray, length: int, gram: int
) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: text, first window, windows, shift, key, print of their union, anchor.

    First windows and anchors are positions in ``data``. ``shift`` places the first window relative
    to the anchor: equal windows have equal shifts. The key is the print of the suffix's first ``gram`` bytes.
    """
    size = np.diff(offsets)
    windows = np.maximum(size - length + 1, 0)
    starts = ragged(offsets[:-1], windows)
    if not len(starts):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none, none.view(np.uint64), none.view(np.uint64), none
    prints = Prints(data)
    place = np.arange(len(data) - gram + 1)
    grams = prints.of(place, place + gram)
    ranked = (grams & ~np.uint64(0xFFFFFF)) | place.astype(np.uint64)
    least = _sliding_min(ranked, length - gram + 1)[starts]
    anchor = (least & np.uint64(0xFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.diff(anchor, prepend=-1))
    first, anchor = starts[new], anchor[new]
    count = np.diff(np.append(new, len(starts)))
    key = grams[anchor]
    shift = length + first - anchor
    union = prints.of(first, first + count - 1 + length)
    text = np.searchsorted(offsets, first, side="right") - 1
    return text, first, count, shift, key, _shaped(union, shift, count), anchor


def _segments(chunk: Chunk, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """A chunk as (data, offsets, bytes before it in its text); one long text in several segments."""
    if len(chunk.offsets) > 2 or len(chunk.data) < SEGMENT + length:
        yield chunk.data, chunk.offsets, 0
        return
    windows = len(chunk.data) - length + 1
    for low in range(0, windows, SEGMENT):
        part = chunk.data[low : min(low + SEGMENT, windows) + length - 1]
        yield part, np.array([0, len(part)]), low


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


PLACE = ["doc_id", "text_key", "first", "windows", "shift"]
_SUFFIX_TYPE = "doc_id long, text_key int, first int, windows int, shift int, key long, whole long"


def _rows(batch, rows, first, windows, shift, key, whole) -> pa.RecordBatch:
    at = pa.array(rows)
    number = lambda x: pa.array(x.astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id").take(at),
            batch.column("text_key").take(at),
            number(first),
            number(windows),
            number(shift),
            _signed(key),
            _signed(whole),
        ],
        [*PLACE, "key", "whole"],
    )


def _suffixes(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                for data, offsets, before in _segments(chunk, length):
                    text, first, count, shift, key, whole, _ = anchors(data, offsets, length, gram)
                    yield _rows(batch, chunk.first + text, before + first - offsets[text], count, shift, key, whole)

    return run


def _prefixes(length: int, gram: int):
    """The first ``gram`` bytes of every suffix, equal ones of a chunk counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                for data, offsets, _ in _segments(chunk, length):
                    *_, key, _, anchor = anchors(data, offsets, length, gram)
                    if len(anchor):
                        _, place, copies = np.unique(key, return_index=True, return_counts=True)
                        yield _array_rows(data[anchor[place, None] + np.arange(gram)], copies, ["prefix", "copies"])

    return run


def _array_rows(prefixes: np.ndarray, copies: np.ndarray, names: list[str], *more: pa.Array) -> pa.RecordBatch:
    n, gram = prefixes.shape
    ends = pa.py_buffer(np.arange(0, (n + 1) * gram, gram, dtype=np.int32))
    column = pa.BinaryArray.from_buffers(pa.binary(), n, [None, ends, pa.py_buffer(np.ascontiguousarray(prefixes))])
    return pa.RecordBatch.from_arrays([column, pa.array(copies.astype(np.int64)), *more], names)


def common_prefixes(rows: np.ndarray) -> np.ndarray:
    """Bytes that each row of a byte matrix has in common with the row before it (the first: none)."""
    differ = rows[1:] != rows[:-1]
    some = differ.any(axis=1)
    return np.concatenate([[0], np.where(some, differ.argmax(axis=1), rows.shape[1])])


_ARRAY = "prefix binary, copies long, key long, merged long, match boolean"


def _merge_scan(gram: int):
    """Sorted suffixes of a batch and of levels: equal ones become one, with their copies and whether they match.

    ``mine`` marks what goes into the merged level; ``merged`` counts the copies there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["prefix"]):
            column = rows.column("prefix").combine_chunks()
            low = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset]
            data = np.frombuffer(column.buffers()[2], dtype=np.uint8)
            matrix = data[low : low + len(column) * gram].reshape(-1, gram)
            new = np.flatnonzero(common_prefixes(matrix) < gram)
            copies, fresh, mine = (rows.column(c).to_numpy() for c in ("copies", "fresh", "mine"))
            total = np.add.reduceat(copies, new)
            merged = np.add.reduceat(np.where(mine, copies, 0), new)
            match = np.logical_or.reduceat(fresh, new) & (total > 1)
            kept = np.ascontiguousarray(matrix[new])
            starts = np.arange(len(new)) * gram
            key = Prints(kept.ravel()).of(starts, starts + gram)
            names = ["prefix", "copies", "key", "merged", "match"]
            yield _array_rows(kept, total, names, _signed(key), pa.array(merged.astype(np.int64)), pa.array(match))

    return run


class SuffixIndexFamily:
    """Levels of suffix arrays ``(prefix, copies)`` in byte order; level sizes are powers of two in batches.

    With a ``store`` the levels found there are the family's, and every batch is one commit to it.
    """

    def __init__(self, length: int, gram: int, store: VersionedTable | None = None) -> None:
        self.length, self.gram, self.store = length, gram, store
        self.levels: list[tuple[int, DataFrame]] = []
        if store is not None:
            sizes = sorted((int(n.removeprefix("level_")) for n in store.current().folders if n.startswith("level_")), reverse=True)
            self.levels = [(size, store.read(f"level_{size}")) for size in sizes]

    def add(self, texts: DataFrame, append: dict[str, DataFrame] | None = None, last: bool = False) -> DataFrame:
        """Take in a batch ``texts(text)``; returns the keys of the suffixes that match because of it.

        ``append`` names frames that the same commit adds to the store. After the ``last`` batch no level is kept.
        """
        batch = texts.select("text").mapInArrow(_prefixes(self.length, self.gram), "prefix binary, copies long")
        size, popped = 1, []
        while self.levels and self.levels[-1][0] == size:
            popped.append(self.levels.pop())
            size *= 2
        flagged = lambda rows, fresh, mine: rows.select("prefix", "copies", F.lit(fresh).alias("fresh"), F.lit(mine).alias("mine"))
        # sampled for its ranges and then shuffled: written once, tightly
        line = flagged(stage(batch, "zstd"), True, True)
        for _, level in popped:
            line = line.union(flagged(level, False, True))
        for _, level in self.levels:
            line = line.union(flagged(level, False, False))
        ordered = line.repartitionByRange("prefix").sortWithinPartitions("prefix")
        scanned = ordered.mapInArrow(_merge_scan(self.gram), _ARRAY)
        if last and self.store is None:
            return scanned.where("match").select("key")
        scanned = stage(scanned, "zstd")
        level = scanned.where("merged > 0").select("prefix", F.col("merged").alias("copies"))
        if self.store is not None:
            gone = [f"level_{n}" for n, _ in popped]
            self.store.commit(replace={f"level_{size}": level}, append=append, drop=gone)
            level = self.store.read(f"level_{size}")
        self.levels.append((size, level))
        return scanned.where("match").select("key")


def _counted(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups of equal (key, whole) with one of their rows; and the keys that need a closer look.

    A closer look: the key occurs twice or more, and some group has one row.
    """
    groups = stage(
        rows.groupBy("key", "whole").agg(
            F.count(F.lit(1)).alias("copies"), *[F.first(c).alias(c) for c in PLACE]
        )
    )
    single = F.sum((F.col("copies") == 1).cast("long"))
    mixed = groups.groupBy("key").agg(F.sum("copies").alias("all"), single.alias("single"))
    return groups, mixed.where("`all` > 1 and single > 0").select("key")


def _stretches(length: int, stretch: int):
    """The asked windows of each text in runs of ``stretch`` or fewer.

    Runs are cut at multiples of ``stretch`` of the shift, so equal windows are cut
    alike. The key holds the bytes that all ``stretch`` windows of the cell share.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = batch.column("asked")
            counts = np.asarray(asked.value_lengths()).astype(np.int64)
            begin = np.cumsum(counts) - counts
            flat = asked.flatten()
            field = lambda name, at: flat.field(name).to_numpy()[at].astype(np.int64)
            for chunk in chunks(batch.column("text")):
                rows = np.arange(chunk.first, chunk.last)
                at = ragged(begin[rows], counts[rows])
                prints = Prints(chunk.data)
                local = np.repeat(np.arange(len(rows)), counts[rows])
                start = chunk.offsets[local] + field("first", at)
                shift, size = field("shift", at), field("windows", at)
                lead = field("key", at).view(np.uint64)
                cell_first = shift // stretch
                cells = (shift + size - 1) // stretch - cell_first + 1
                owner = np.repeat(np.arange(len(at)), cells)
                cell = ragged(cell_first, cells)
                low = np.maximum(cell * stretch, shift[owner])
                high = np.minimum((cell + 1) * stretch, shift[owner] + size[owner])
                zero = start[owner] - shift[owner]
                core = prints.of(zero + (cell + 1) * stretch - 1, zero + cell * stretch + length)
                key = mix64(core ^ mix64(lead[owner] + cell.astype(np.uint64) * _GOLDEN))
                union = prints.of(zero + low, zero + high - 1 + length)
                yield _rows(
                    batch,
                    rows[local[owner]],
                    zero + low - chunk.offsets[local[owner]],
                    high - low,
                    low,
                    key,
                    _shaped(union, low, high - low),
                )

    return run


def _long_runs(chunk: Chunk, gone: np.ndarray, min_words: int) -> np.ndarray:
    """``gone`` without the runs that touch fewer than ``min_words`` words."""
    low, high, _ = spans(chunk, gone)
    begin, end, _ = words(chunk)
    touched = np.searchsorted(begin, high, side="left") - np.searchsorted(end, low, side="right")
    steps = np.zeros(len(gone) + 1, dtype=np.int64)
    steps[low[touched >= min_words]] += 1
    steps[high[touched >= min_words]] -= 1
    return np.cumsum(steps[:-1]) > 0


def _removed(length: int, with_text: bool, min_words: int = 0):
    """Cut the spans out of each text: counts, digest and, if wanted, what is left of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans_ = batch.column("spans")
            counts = np.asarray(spans_.value_lengths()).astype(np.int64)
            begin = np.cumsum(counts) - counts
            flat = spans_.flatten()
            first, windows = flat.field("first").to_numpy(), flat.field("windows").to_numpy()
            for chunk in chunks(batch.column("text")):
                rows = np.arange(chunk.first, chunk.last)
                at = ragged(begin[rows], counts[rows])
                low = np.repeat(chunk.offsets[:-1], counts[rows]) + first[at]
                steps = np.zeros(len(chunk.data) + 1, dtype=np.int64)
                np.add.at(steps, low, 1)
                np.add.at(steps, low + windows[at] + length - 1, -1)
                gone = np.cumsum(steps[:-1]) > 0
                if min_words:
                    gone = _long_runs(chunk, gone, min_words)
                _, _, owner = spans(chunk, gone)
                runs = np.bincount(owner, minlength=len(rows))
                left = np.concatenate([[0], np.cumsum(~gone)])[chunk.offsets]
                kept = chunk.data[~gone].tobytes()
                texts = [kept[a:b] for a, b in zip(left[:-1].tolist(), left[1:].tolist())]
                at = pa.array(rows)
                columns = [
                    batch.column("doc_id").take(at),
                    batch.column("text_key").take(at),
                    pa.array(chunk.lengths - np.diff(left)),
                    pa.array(runs.astype(np.int64)),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
                ]
                names = ["doc_id", "text_key", "n_removed", "n_spans", "kept_sha256"]
                if with_text:
                    # a cut may fall inside a character: its rest goes too
                    columns.append(pa.array([t.decode("utf-8", "ignore") for t in texts]))
                    names.append("kept")
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _keyed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` with numbered columns and the names of a row (its id or a stand-in, a hash of its text); the texts by name."""
    at = {c: str(docs.columns.index(c)) for c in ("doc_id", "text")}
    rows = numbered(docs).withColumns(
        {
            "_id": F.coalesce(F.col(at["doc_id"]).cast("long"), F.xxhash64(at["text"])),
            "_key": F.hash(at["text"], F.col(at["doc_id"]).isNull()),
        }
    )
    return rows, rows.select(F.col("_id").alias("doc_id"), F.col("_key").alias("text_key"), F.col(at["text"]).alias("text"))


def _check(length: int, gram: int, stretch: int) -> None:
    if not 8 <= gram <= length - stretch or length - stretch < 8:
        raise ValueError("gram must be 8 bytes or more and shorter than length by the stretch")


def _repeated_windows(rows: DataFrame, texts: DataFrame, length: int, stretch: int) -> DataFrame:
    """``(doc_id, text_key, first, windows)``: of candidate suffixes, the runs of windows that occur twice."""
    spans_: DataFrame | None = None
    for step in (stretch, 1, None):
        groups, mixed = _counted(rows)
        twice = groups.where("copies > 1").select("key", "whole")
        whole = rows.join(twice, ["key", "whole"]).select("doc_id", "text_key", "first", "windows")
        spans_ = whole if spans_ is None else spans_.union(whole)
        if step is None:
            break
        wanted = F.struct("first", "windows", "shift", "key")
        # a common passage has many shapes under one key: they are dealt to several tasks
        spread = mixed.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
        dealt = groups.withColumn("_part", F.pmod(F.hash("whole"), F.lit(SPREAD)))
        asked = (
            dealt.join(spread, ["key", "_part"], "left_semi")
            .groupBy("doc_id", "text_key")
            .agg(F.collect_list(wanted).alias("asked"))
        )
        rows = stage(
            texts.join(asked, ["doc_id", "text_key"]).mapInArrow(_stretches(length, step), _SUFFIX_TYPE)
        )
    return spans_


def _in_texts(texts: DataFrame, windows: DataFrame) -> DataFrame:
    spans_ = windows.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("first", "windows")).alias("spans"))
    return texts.join(spans_, ["doc_id", "text_key"])


@shipped
def repeated_spans(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, batches: int = BATCHES, stretch: int = STRETCH
) -> DataFrame:
    """``(doc_id, text_key, text, spans)`` of the texts with windows that also start elsewhere.

    ``spans`` lists runs of such windows as (first, windows); they may overlap.
    """
    _check(length, gram, stretch)
    texts = docs.select("doc_id", "text_key", "text")
    long_enough = texts.where(F.octet_length("text") >= length)
    family = SuffixIndexFamily(length, gram)
    batch = F.pmod(F.hash("doc_id", "text_key"), F.lit(batches))
    matches = [family.add(long_enough.where(batch == n), last=n == batches - 1) for n in range(batches)]
    found = matches[0]
    for more in matches[1:]:
        found = found.union(more)
    # places are found again rather than kept for all suffixes: only those that match are written
    suffixes = long_enough.mapInArrow(_suffixes(length, gram), _SUFFIX_TYPE)
    rows = stage(suffixes.join(stage(found.distinct()), "key", "left_semi"))
    names = rows.select("doc_id", "text_key").distinct()
    texts = stage(texts.join(names, ["doc_id", "text_key"], "left_semi").dropDuplicates(["doc_id", "text_key"]))
    return _in_texts(texts, _repeated_windows(rows, texts, length, stretch))


class DedupIndex:
    """Suffix arrays, suffix places and texts of all batches so far, under one path.

    A batch is compared with itself and with everything before it; the levels are read and merged,
    earlier batches are not indexed again. Earlier batches' own results stay as they were given.
    """

    def __init__(
        self, spark: SparkSession, path: str, length: int = LENGTH, gram: int = GRAM, stretch: int = STRETCH
    ) -> None:
        _check(length, gram, stretch)
        ship(spark)
        self.store = VersionedTable(spark, path)
        self.length, self.gram, self.stretch = length, gram, stretch

    @property
    def levels(self) -> list[int]:
        """Sizes of the stored levels in batches, the largest first."""
        return [size for size, _ in SuffixIndexFamily(self.length, self.gram, self.store).levels]

    def add(self, docs: DataFrame, min_words: int = 0) -> DataFrame:
        """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` of a batch against all batches so far, its own included.

        Ids must be new: a text with the id and text of an earlier row is taken for that row.
        """
        rows, texts = _keyed(docs)
        fresh = stage(texts.where(F.octet_length("text") >= self.length))
        places = stage(fresh.mapInArrow(_suffixes(self.length, self.gram), _SUFFIX_TYPE))
        family = SuffixIndexFamily(self.length, self.gram, self.store)
        found = stage(family.add(fresh, append={"suffixes": places, "texts": fresh}).distinct())
        known, all_texts = self.store.read("suffixes"), self.store.read("texts")
        candidates = stage(known.join(found, "key", "left_semi"))
        names = candidates.select("doc_id", "text_key").distinct()
        held = stage(all_texts.join(names, ["doc_id", "text_key"], "left_semi").dropDuplicates(["doc_id", "text_key"]))
        windows = _repeated_windows(candidates, held, self.length, self.stretch)
        own = held.join(fresh.select("doc_id", "text_key").distinct(), ["doc_id", "text_key"], "left_semi")
        return _digested(docs, rows, _in_texts(own, windows).mapInArrow(_removed(self.length, False, min_words), f"{_CUT_TYPE}, kept_sha256 string"))


def _digested(docs: DataFrame, rows: DataFrame, cut: DataFrame) -> DataFrame:
    cut = cut.withColumnsRenamed({"doc_id": "_id", "text_key": "_key"})
    at = {c: str(docs.columns.index(c)) for c in ("doc_id", "text")}
    text = F.coalesce(F.col(at["text"]), F.lit("")).cast("binary")
    plain = rows.select(
        F.col(at["doc_id"]).alias("doc_id"),
        "_id",
        "_key",
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.sha2(text, 256).alias("_sha"),
    )
    return plain.join(cut, ["_id", "_key"], "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", "_sha").alias("kept_sha256"),
    )


_CUT_TYPE = "doc_id long, text_key int, n_removed long, n_spans long"


@shipped
def suffix_dedup(docs: DataFrame, length: int = LENGTH, min_words: int = 0, **options) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` per row of ``docs``.

    Every byte covered by a ``length``-byte string that also starts anywhere else in
    the table, the same text included, is removed; strings are judged on the input. With
    ``min_words`` maximal runs of such bytes that touch fewer words (runs of bytes other
    than white space) stay. Null counts as the empty text. Rows that repeat are documents of their own, so
    each repeats the other. Other columns are not read; an empty table gives no rows.
    """
    rows, texts = _keyed(docs)
    cut = repeated_spans(texts, length, **options).mapInArrow(
        _removed(length, False, min_words), f"{_CUT_TYPE}, kept_sha256 string"
    )
    return _digested(docs, rows, cut)


@shipped
def without_repeats(docs: DataFrame, length: int = LENGTH, min_words: int = 0, **options) -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text`` and ``n_chars`` counted anew.

    What is cut is what ``suffix_dedup`` removes. No row goes: a text may end up empty, a null text stays. Where a cut
    falls inside a character the rest of the character goes too. Rows that repeat are cut alike; a null id
    is no obstacle; all other columns, whatever their names, are kept as they are; an empty table stays empty.
    """
    rows, texts = _keyed(docs)
    cut = repeated_spans(texts, length, **options).mapInArrow(
        _removed(length, True, min_words), f"{_CUT_TYPE}, kept_sha256 string, kept string"
    )
    cut = stage(cut.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "kept"))
    out = rows.join(cut, ["_id", "_key"], "left")
    found = F.col("kept").isNotNull()
    columns = [F.col(str(n)) for n in range(len(docs.columns))]
    text = docs.columns.index("text")
    columns[text] = F.when(found, F.col("kept")).otherwise(columns[text])
    if "n_chars" in docs.columns:
        chars = docs.columns.index("n_chars")
        now = F.length("kept").cast(docs.schema["n_chars"].dataType)
        columns[chars] = F.when(found, now).otherwise(columns[chars])
    return out.select(*[c.alias(str(n)) for n, c in enumerate(columns)]).toDF(*docs.columns)
