"""Plain models of the operators, straight from their definitions."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

DOC_TYPE = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts):
    """A documents table; ``texts`` are texts or (doc_id, text) pairs."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame([(i, t, None, "s", len(t or "")) for i, t in rows], DOC_TYPE)


def clashing(df):
    """The same rows with extra columns named like those the operators use inside."""
    from pyspark.sql import functions as F

    names = ["score", "__toxicity", "0", "kept", "prefix", "text_id", "ranks", "id", "key", "list", "fp", "_null", "_id", "_key", "_n", "copies", "spans", "text_key", "size", "hash", "vector", "a.b"]
    return df.withColumns({n: F.lit("x") for n in names})


def tuples(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=lambda t: tuple((x is None, x or 0) for x in t))


def least_connected(items, linked):
    """Smallest reachable item for each, over an all-pairs test."""
    parent = {i: i for i in items}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in items:
        for b in items:
            if a < b and linked(a, b):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in items}


def ascii_words(text):
    low = re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def simhash(text, size=3):
    words = ascii_words(text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_rows(rows):
    prints = {i: simhash(t) for i, t in rows}
    near = least_connected(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    return sorted((i, f"{prints[i]:016x}", near[i]) for i in prints)


def suffix_rows(rows, length=400, min_words=0):
    seen = Counter()
    texts = [(i, (t or "").encode()) for i, t in rows]
    for _, b in texts:
        seen.update(hash(b[p : p + length]) for p in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        gone = np.zeros(len(b), dtype=bool)
        for p in range(len(b) - length + 1):
            if seen[hash(b[p : p + length])] > 1:
                gone[p : p + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(int)))
        for low, high in zip(edges[::2], edges[1::2]):
            if len(re.findall(rb"[^\x20\x09-\x0D]+", b[low:high])) < min_words:
                gone[low:high] = False
        kept = np.frombuffer(b, dtype=np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def vector_rows(rows, threshold=0.95):
    ids, good = [], []
    for i, v in rows:
        ids.append(i)
        v = None if v is None or any(x is None for x in v) else np.array(v, dtype=np.float64)
        good.append(None if v is None or not len(v) or not np.isfinite(v).all() or not v.any() else v)

    def cosine(a, b):
        a, b = good[a], good[b]
        if a is None or b is None or len(a) != len(b):
            return False
        return a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold

    n = len(ids)
    links = [sum(cosine(a, b) for b in range(n) if a != b) for a in range(n)]
    least = least_connected(range(n), cosine)
    members = {}
    for a in range(n):
        members.setdefault(least[a], []).append(ids[a])
    return sorted((ids[a], links[a], min(members[least[a]])) for a in range(n))


def shard_rows(rows, shards=8):
    sized = sorted((i, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for i, t in rows)
    total, before, slots, out = sum(s for *_, s in sized), 0, Counter(), []
    for i, crc, s in sized:
        shard = min(shards - 1, (2 * before + s) * shards // (2 * total))
        out.append((i, s, crc, shard, slots[shard]))
        slots[shard] += 1
        before += s
    return sorted(out)


def token(t):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").lower())


def leak_details(rows, items, pairs, size=5):
    """Score and overlaps of the best passage of each leaking pair."""
    known = {i: (t, token(t)) for i, t in items if token(t)}
    # as a table without repeats
    texts = [token(t) for _, t in {(i, t) for i, t in items} if token(t)]
    average, longest = sum(map(len, texts)) / len(texts), max(map(len, texts))
    df = Counter(w for t in texts for w in set(t))
    wide, of, out = max(256, 2 * longest), dict(rows), []
    for doc, item in pairs:
        from tapeloom.llm.decontaminate import split_item

        text, w = known[item]
        n = min(size, len(w))
        wanted = [tuple(w[k : k + n]) for k in range(len(w) - n + 1)]
        cut = max(0, min(len(token(split_item(text)[0])) - n + 1, len(wanted)))
        tf, words, best = Counter(w), token(of[doc]), None
        for k in range(0, max(1, len(words) - wide // 2), wide // 2):
            part = words[k : k + wide]
            have = {tuple(part[j : j + n]) for j in range(len(part) - n + 1)}
            found = [s in have for s in wanted]
            score = sum(
                math.log(1 + (len(texts) - df[x] + 0.5) / (df[x] + 0.5)) * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * len(w) / average))
                for x, c in tf.items() if x in set(part)
            )
            mean = lambda x: sum(x) / len(x) if x else None
            row = (mean(found), score, mean(found[:cut]), mean(found[cut:]))
            best = max(best or row, row, key=lambda r: tuple(-1 if v is None else v for v in r))
        out.append((doc, item, best[1], best[0], best[2], best[3]))
    return out


def leak_rows(rows, items, size=5, share=0.8):
    longest = max([len(token(t)) for _, t in items] or [0])
    wide = max(256, 2 * longest)
    out = set()
    for i, t in rows:
        words = token(t)
        parts = [words[k : k + wide] for k in range(0, max(1, len(words) - wide // 2), wide // 2)]
        runs = {(n, p): {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} for n in range(1, size + 1) for p, w in enumerate(parts)}
        for item, text in items:
            w = token(text)
            n = min(size, len(w))
            wanted = [tuple(w[k : k + n]) for k in range(len(w) - n + 1)] if w else []
            for p in range(len(parts)):
                have = runs.get((n, p), set())
                if wanted and sum(s in have for s in wanted) >= share * len(wanted) - 1e-9:
                    out.add((i, item))
    return sorted(out)
