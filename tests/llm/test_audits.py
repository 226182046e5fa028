"""Divergence of sources, secrets and conversation repair against plain models."""

import base64
import hashlib
import hmac
import itertools
import json
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import clashing
from tapeloom.llm import conversations as conv
from tapeloom.llm.conversations import repair_conversations
from tapeloom.llm.divergence import QuadTree, joint_walk, source_divergence
from tapeloom.llm.secrets import find_secrets, is_private_key, scan_secrets

# --- sources ---------------------------------------------------------------------------------------

DOC = "doc_id long, text string, lang string, source string"


def divergence_rows(rows, min_docs, top):
    rows = [tuple(x or "" for x in r) for r in rows]
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    docs = [(l, s, re.findall(r"[A-Za-z\x80-\U0010ffff]+", low(t))) for t, l, s in rows]
    out = []
    for lang in {l for l, _, _ in docs}:
        seen, whole, groups = Counter(), Counter(), defaultdict(Counter)
        for l, s, terms in docs:
            if l == lang:
                seen.update(set(terms))
                whole.update(terms)
                groups[s].update(terms)
        kept = [t for t in seen if seen[t] >= min_docs]

        def price(counts):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (n + 5 * len(kept)) for t in kept}

        q, p = price(whole), {s: price(c) for s, c in groups.items()}
        for s in groups:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in groups if o != s]
            terms = [(q[t] - p[s][t], t.encode(), t) for t in kept if groups[s][t] and p[s][t] > q[t]]
            out += [(lang, s, "pair", o, -v, r) for r, (v, _, o) in enumerate(sorted(pairs), 1)]
            out += [(lang, s, "term", t, -v, r) for r, (v, _, t) in enumerate(sorted(terms)[:top], 1)]
    return sorted(out)


def collected(df):
    return sorted(tuple(r) for r in df.collect())


def made_docs(n, seed):
    draw = random.Random(seed)
    words = [*"the a of and été straße Ünder x".split(), *(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))]
    rows = []
    for i in range(n):
        lang = draw.choice(["en", "en", "en", "de", None])
        source = f"s{draw.choice([0, 0, 0, 1, 2, 3, 7, 9, 11])}" if i % 17 else None
        own = words[int(source[1:]) * 4 :] if source and i % 3 else words
        text = " ".join(draw.choice(own).title() if draw.random() < 0.2 else draw.choice(own) for _ in range(draw.randint(0, 60)))
        rows.append((text if i % 29 else None, lang, source))
    return rows


@pytest.mark.parametrize("k, levels", [(2, 2), (4, 4), (3, 1)])
def test_divergence_equals_plain_counts(spark, k, levels):
    rows = made_docs(400, 5)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], DOC).repartition(7)
    found = source_divergence(df, min_docs=6, top=5, k=k, levels=levels)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert collected(found) == divergence_rows(rows, 6, 5)


def test_divergence_edges(spark):
    empty = spark.createDataFrame([], DOC)
    assert collected(source_divergence(empty)) == []
    # no term reaches the bound, a group without terms, a language with one source
    rows = [("one two", "en", "a"), ("", "en", "b"), (None, None, None), ("x" * 300_000 + " one", "fr", "a")] * 2
    df = clashing(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], DOC)).withColumn("term", F.lit(1))
    assert collected(source_divergence(df, min_docs=30)) == divergence_rows(rows, 30, 50)
    assert collected(source_divergence(df, min_docs=2)) == divergence_rows(rows, 2, 50)


def test_quadtree_walk_equals_dense():
    draw = np.random.default_rng(3)
    for k, levels, filled in ((2, 4, 30), (4, 2, 100), (2, 1, 0), (4, 3, 5)):
        side = k**levels
        sides, dense = [], []
        for _ in range(2):
            at = draw.choice(side * side, size=min(filled, side * side), replace=False)
            prices = draw.integers(1, 1000, len(at))
            absent = draw.integers(1, 50, side)
            full = np.repeat(absent[:, None], side, axis=1)
            full[at // side, at % side] = prices
            sides.append((QuadTree(at // side, at % side, prices, k, levels), absent))
            dense.append(full)
        total, seen = joint_walk(sides[0][0], sides[1][0], sides[0][1], sides[1][1], False)
        rest = (side - seen) * np.abs(sides[0][1][:, None] - sides[1][1][None, :])
        assert np.array_equal(total + rest, np.abs(dense[0][:, None, :] - dense[1][None, :, :]).sum(axis=2))
        assert not filled or filled > 50 or seen.min() < side


# --- secrets ---------------------------------------------------------------------------------------


def der(tag, *parts):
    body = b"".join(parts)
    n = len(body)
    head = bytes([n]) if n < 128 else (lambda b: bytes([128 + len(b)]) + b)(n.to_bytes((n.bit_length() + 7) // 8))
    return bytes([tag]) + head + body


def number(draw, size):
    return der(2, bytes([draw.randint(1, 127)]) + draw.randbytes(size - 1))


def keys(draw):
    rsa = der(0x30, der(2, b"\0"), *(number(draw, 64) for _ in range(8)))
    oid = der(6, bytes([42, 134, 72, 134, 247, 13, 1, 1, 1]))
    ec = der(0x30, der(2, b"\1"), der(4, draw.randbytes(32)), der(0xA0, oid), der(0xA1, der(3, b"\0" + draw.randbytes(64))))
    pkcs8 = der(0x30, der(2, b"\0"), der(0x30, oid, der(5)), der(4, rsa))
    sealed = der(0x30, der(0x30, oid, der(0x30, der(4, draw.randbytes(8)))), der(4, draw.randbytes(64)))
    short = der(0x30, der(2, b"\0"), der(0x30, der(6, b"\x2b\x65\x70")), der(4, der(4, draw.randbytes(32))))
    return [rsa, ec, pkcs8, sealed, short]


def ssh_key(draw):
    field = lambda b: len(b).to_bytes(4) + b
    public = field(b"ssh-ed25519") + field(draw.randbytes(32))
    return b"openssh-key-v1\0" + field(b"none") + field(b"none") + field(b"") + (1).to_bytes(4) + field(public) + field(draw.randbytes(136))


def token(header, payload, key=b"k", cut=0):
    part = lambda b: base64.urlsafe_b64encode(b).rstrip(b"=").decode()
    said = f"{part(json.dumps(header).encode())}.{part(json.dumps(payload).encode())}"
    return f"{said}.{part(hmac.digest(key, said.encode(), 'sha256')[cut:])}"


def test_structures_are_found_where_they_stand():
    draw = random.Random(1)
    for raw, kind in [*((k, "key") for k in keys(draw)), (ssh_key(draw), "ssh")]:
        b64 = base64.b64encode(raw).decode()
        lines = "\n".join(b64[i : i + 64] for i in range(0, len(b64), 64))
        for form in (b64, lines, lines.replace("\n", "\r\n"), raw.hex(), raw.hex().upper()):
            for before, after in (("", ""), ("é -----BEGIN KEY-----\n", "\n-----END KEY-----"), ('x="', '"'), ("(", ") more words")):
                found = [s for s in find_secrets(before + form + after) if s[0] not in ("assign", "hex")]
                assert found == [(kind, (len(before), len(before) + len(form)))], (kind, form[:30], before)
    good = token({"alg": "HS256", "typ": "JWT"}, {"sub": "1"})
    assert find_secrets(f"é Bearer {good}.") == [("token", (9, 9 + len(good)))]


def test_broken_structures_are_not_reported():
    draw = random.Random(2)
    for raw in keys(draw):
        assert is_private_key(raw)
        # a byte too few or too many, a changed length, another tag
        for bad in (raw[:-1], raw + b"\0", raw[:1] + bytes([raw[1] ^ 1]) + raw[2:], b"\x31" + raw[1:], b""):
            assert not is_private_key(bad)
            for form in (base64.b64encode(bad).decode(), bad.hex()):
                assert [s for s in find_secrets(form) if s[0] in ("key", "ssh")] == []
    public = der(0x30, der(0x30, der(6, b"\x2a\x03\x04\x05"), der(5)), der(3, b"\0" + draw.randbytes(70)))
    assert not is_private_key(public)
    deep = b""
    for _ in range(3000):
        deep = der(0x30, deep)
    assert not is_private_key(deep)
    bad_ssh = bytearray(ssh_key(draw))
    bad_ssh[-137] ^= 1
    assert find_secrets(base64.b64encode(bytes(bad_ssh)).decode()) == []
    plain = {"alg": "HS256"}
    for text in (
        token(plain, {"a": 1}, cut=1),
        token({"typ": "JWT"}, {"a": 1}),
        token(plain, [1]),
        token(plain, {"a": 1})[:-43],
        "eyJhb.eyJhb.eyJhb",
        "ey." * 50,
    ):
        assert find_secrets(text) == []


def plain_base(text):
    """The base kinds straight from their definition."""
    found = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        found += [("assign", m.span())] * (len(m[2]) >= 8)
    found += [("access", m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [("hex", m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found, key=lambda s: (s[1][0], ["assign", "access", "hex"].index(s[0])))


def test_secret_scans(spark):
    draw = random.Random(4)
    bits = ["password", "Passwd", "SECRET", "toKen", "api_key", "apikey", "Key", "AKIA", "'", '"', " ", ":", "=", "\n", "é", "😀", ".", "ab12", "f" * 31, "0a" * 16, "ABCDEFGH2345", "Zz/+_-="]
    texts = ["".join(draw.choice(bits) for _ in range(draw.randint(0, 25))) for _ in range(1500)]
    key = base64.b64encode(keys(draw)[0]).decode()
    texts += [None, "", "a " * 200_000 + f"token = {'x' * 8}", f"é {key}", f"token={key}", token({"alg": "none-such"}, {})]
    texts += texts[-3:]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    found = {r.doc_id: r for r in scan_secrets(clashing(df)).collect()}
    line = lambda spans: ",".join(f"{k}:{a}:{b}" for k, (a, b) in spans)
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        base, r = plain_base(text or ""), found[i]
        kinds = Counter(k for k, _ in base)
        assert (r.n_assign, r.n_access, r.n_hex) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert r.base_sha256 == hashlib.sha256(line(base).encode()).hexdigest()
        assert r.spans == line(find_secrets(text or "")) and set(line(base).split(",")) <= {*r.spans.split(","), ""}
    assert found[1503].spans == f"key:2:{2 + len(key)}"
    assert found[1504].spans == f"assign:0:{6 + len(key)}"
    assert scan_secrets(df.limit(0)).collect() == []
    assert scan_secrets(df).columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]


# --- conversations ---------------------------------------------------------------------------------

TURN = "conv_id long, turn long, role string, text string"


def cyk(cells):
    """The whole chart: every span from every split."""
    n = len(cells)
    chart = {(i, i + 1): c for i, c in enumerate(cells)}
    for size in range(2, n + 1):
        for i in range(n - size + 1):
            ways = {conv.combine(chart[i, j], chart[j, i + size]) for j in range(i + 1, i + size)}
            assert len(ways) == 1
            chart[i, i + size] = ways.pop()
    return chart[0, n] if n else conv.INSERTIONS


def best_by_search(rows):
    """Least (cost, audit) over all edits of a few rows with up to three insertions at each place."""
    best = None
    inserts = ["", "u", "a", "uu", "ua", "au", "aa", "uau", "aua"]
    options = []
    for initial, fault in rows:
        ways = [("D", "", 3)]
        if fault < 2:
            ways += [("K", initial or "?", fault), ("R", "u", 2 + fault), ("R", "a", 2 + fault)]
        options.append(ways)
    for edits in itertools.product(*options):
        for gaps in itertools.product(inserts, repeat=len(rows) + 1):
            said = gaps[0] + "".join(e[1] + g for e, g in zip(edits, gaps[1:]))
            if not re.fullmatch(r"(s?(ua)+)?", said):
                continue
            audit = "I" * len(gaps[0]) + "".join(e[0] + "I" * len(g) for e, g in zip(edits, gaps[1:]))
            cost = sum(e[2] for e in edits) + 2 * sum(map(len, gaps))
            best = min(best or (cost, audit), (cost, audit))
    return best


def test_cells_give_the_cheapest_repair():
    kinds = list(itertools.product(["s", "u", "a", ""], range(3)))
    for n in range(3):
        for rows in itertools.product(kinds, repeat=n):
            assert conv.cheapest(cyk([conv._ROW[r] for r in rows])) == best_by_search(rows)
    draw = random.Random(3)
    for _ in range(40):
        rows = [draw.choice(kinds) for _ in range(3)]
        assert conv.cheapest(cyk([conv._ROW[r] for r in rows])) == best_by_search(rows)
    for _ in range(20):
        rows = [conv._ROW[draw.choice(kinds)] for _ in range(draw.randint(4, 24))]
        span = conv.Span()
        for c in rows:
            span.add(c, 1, "u", "u", 0)
        flat = span.row("c", 0)
        whole = cyk(rows)
        assert flat[6:] == ([x and x[0] for r in whole for x in r], [x and x[1] for r in whole for x in r])
    one = conv._ROW["u", 2]
    assert conv.power(one, 5) == cyk([one] * 5) and conv.power(one, 0) == conv.NOTHING


def repair_rows(rows):
    """The contract, row by row."""
    kept, ids = defaultdict(list), {r[0] for r in rows}
    for c, turn, role, text in rows:
        show = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{show(c)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept[c] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = []
    for c in ids:
        digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
        lines = sorted(kept[c], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2][:64].encode(), digest(r[2])))
        marks, seen = [], set()
        for _, role, text in lines:
            solid = text.rstrip(" \t\n\x0b\x0c\r")
            fault = 3 if not solid else 2 if (role, text) in seen else 0 if solid[-1] in ".!?" else 1
            seen.add((role, text))
            marks.append((role[:1] if role[:1] in ("s", "u", "a") else "", fault))
        paths = {p: (x[0], x[1]) for p, x in enumerate(conv.INSERTIONS[0]) if x}
        for m in marks:
            step = conv._ROW[m[0], min(m[1], 2)]
            paths = {
                q: min((v[0] + step[p][q][0], v[1] + step[p][q][1]) for p, v in paths.items() if step[p][q])
                for q in range(4)
                if any(step[p][q] for p in paths)
            }
        cost, audit = min(paths[q] for q in (0, 3) if q in paths)
        said, rest, place = [], iter(lines), -(len(audit.replace("D", "")) % 2)
        for letter in audit:
            line = next(rest) if letter != "I" else None
            if letter != "D":
                to = "user" if place % 2 == 0 else "assistant"
                said.append(f"{line[1]}:{line[2]}" if letter == "K" else f"{to}:{line[2] if line else ''}")
                place += 1
        times = [r[0] for r in lines if r[0] is not None]
        pairs = [a[0] + b[0] for a, b in zip(marks, marks[1:])]
        faults = Counter(f for _, f in marks)
        out.append(
            (c, max(times) - min(times) + 1 - len(set(times)) if times else 0, faults[3], faults[2], faults[1],
             sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest("\n".join(said)))
        )
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0))


def repaired(df, **options):
    return sorted((tuple(r) for r in repair_conversations(df, **options).collect()), key=lambda r: (r[0] is None, r[0] or 0))


def made_turns(seed):
    draw = random.Random(seed)
    texts = ["Hello.", "Well!", "no end", "", " \n", None, "Really?  ", "é." * 40, "same."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]
    rows = []
    for c in [*range(60), None]:
        n = draw.choice([0, 1, 2, 5, 9]) if c != 7 else 300
        for t in range(n):
            role = draw.choice(roles) if draw.random() < 0.4 else ["user", "assistant"][t % 2]
            rows.append((c, draw.choice([t, t, t, t + 3, None]), role, draw.choice(texts) if draw.random() < 0.5 else f"{t} is it."))
    return rows + rows[:20] + [(9, 4, "user", "x.")] * 500


@pytest.mark.parametrize("options", [{}, {"span": 3, "fan": 2}])
def test_repair_equals_plain_rules(spark, options):
    rows = made_turns(1)
    df = clashing(spark.createDataFrame(rows, TURN).repartition(6))
    assert repaired(df, **options) == repair_rows(rows)


def test_repair_edges(spark):
    empty = spark.createDataFrame([], TURN)
    assert repaired(empty) == []
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "Hi."), (5, 1, "assistant", "long " * 100_000 + ".")]
    nothing = (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    found = repaired(spark.createDataFrame(rows, TURN))
    assert nothing in found and found == repair_rows(rows)
