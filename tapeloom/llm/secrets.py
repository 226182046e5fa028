"""Secrets in texts: patterns, and candidates whose decoded structure confirms them.

Three base kinds are patterns. Three more are reported only after decoding: ``token`` is a signed token whose
base64url header and payload are JSON objects and whose signature has the length of its algorithm;
``key`` is base64 or hexadecimal whose bytes are one DER element with exactly nested lengths in the shape
of a private key; ``ssh`` is the same with the length-prefixed fields of an OpenSSH private key. Base64 may be
broken into lines.

Texts that cannot hold a kind are left out by one linear match of the whole batch; only the others are walked in Python.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tapeloom.llm.common import shipped

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "token", "key", "ssh")

Span = tuple[int, int]

_ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
# a JSON object begins with a brace and then a quote or white space: "e" and "y" or "w"
_TOKEN = re.compile(r"(?<![A-Za-z0-9_.-])(e[wy][A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)(?![A-Za-z0-9_.-]*[A-Za-z0-9_-])")
# a DER sequence begins with byte 0x30: "M" and one of "A" to "P"
_KEY = re.compile(r"(?<![A-Za-z0-9+/=_-])M[A-P][A-Za-z0-9+/_-]{10}")
_SSH_MAGIC = b"openssh-key-v1\0"
_SSH = re.compile(r"(?<![A-Za-z0-9+/=_-])b3BlbnNzaC1rZXktdjEA")
_HEX_BYTES = re.compile(r"(?<![0-9A-Fa-f])(?:30|6[Ff]70656[Ee]737368)[0-9A-Fa-f]{24,}(?![0-9A-Fa-f])")
_LINES = re.compile(r"[A-Za-z0-9+/_-]+(?:\r?\n[A-Za-z0-9+/_-]+)*={0,2}")
_BREAK = re.compile(r"\r?\n")

# what a text must match for a kind to be looked for (RE2, linear); each is implied by the kind's own pattern
_MAY_HOLD = {
    "assign": r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{8}""",
    "access": r"AKIA[A-Z0-9]{12}",
    "hex": r"[0-9a-f]{32}",
    "token": r"e[wy][A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]",
    "key": r"M[A-P][A-Za-z0-9+/_-]{10}|(?:30|6[Ff]70656[Ee]737368)[0-9A-Fa-f]{24}",
    "ssh": r"b3BlbnNzaC1rZXktdjEA|6[Ff]70656[Ee]737368",
}

# bytes of a signature by algorithm; RSA signatures are as long as the key
_SIGNATURE = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES384": 96, "ES512": 132}
LEAST_SIGNATURE = 16
LEAST_RSA = 64


def _base64url(text: str) -> bytes | None:
    try:
        raw = base64.b64decode(text + "=" * (-len(text) % 4), b"-_", validate=True)
    except (binascii.Error, ValueError):
        return None
    # unused bits of the last character are zero
    return raw if base64.urlsafe_b64encode(raw).rstrip(b"=") == text.encode() else None


def _json_object(text: str) -> dict | None:
    raw = _base64url(text)
    try:
        found = json.loads(raw) if raw else None
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def is_signed_token(header: str, payload: str, signature: str) -> bool:
    """The three parts of a compact signed token."""
    head, sign = _json_object(header), _base64url(signature)
    if head is None or not isinstance(head.get("alg"), str) or sign is None or _json_object(payload) is None:
        return False
    alg = head["alg"]
    if alg in _SIGNATURE:
        return len(sign) == _SIGNATURE[alg]
    return len(sign) >= (LEAST_RSA if alg[:2] in ("RS", "PS") else LEAST_SIGNATURE)


def der_element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, start, end of content) of the element at ``at``; None unless it ends by ``end``."""
    if at + 2 > end or data[at] & 0x1F == 0x1F:
        return None
    size, start = data[at + 1], at + 2
    if size >= 0x80:
        count = size & 0x7F
        if not 1 <= count <= 4 or start + count > end:
            return None
        size = int.from_bytes(data[start : start + count])
        # lengths take the fewest bytes
        if size < 0x80 or size >> 8 * (count - 1) == 0:
            return None
        start += count
    return (data[at], start, start + size) if start + size <= end else None


def der_children(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill ``start`` to ``end`` exactly; constructed ones are filled exactly as well."""
    out, open_ = [], [(start, end, True)]
    while open_:
        at, stop, top = open_.pop()
        while at < stop:
            found = der_element(data, at, stop)
            if found is None:
                return None
            if top:
                out.append(found)
            if found[0] & 0x20:
                open_.append((found[1], found[2], False))
            at = found[2]
    return out


def der_size(data: bytes) -> int | None:
    """Bytes of the sequence that begins ``data`` (its first bytes suffice)."""
    if len(data) < 7 or data[0] != 0x30:
        return None
    found = der_element(data[:7], 0, 1 << 40)
    return found and found[2]


_INT, _OCTETS, _SEQ, _OID, _BITS = 0x02, 0x04, 0x30, 0x06, 0x03


def is_private_key(data: bytes) -> bool:
    """One DER sequence in the shape of a PKCS#1, DSA, SEC1 or (encrypted) PKCS#8 private key."""
    top = der_element(data, 0, len(data)) if data else None
    if top is None or top[0] != _SEQ or top[2] != len(data):
        return False
    parts = der_children(data, top[1], top[2])
    if not parts:
        return False
    tags = [p[0] for p in parts]
    content = lambda p: data[p[1] : p[2]]
    begins_with_oid = lambda p: p[2] - p[1] > 2 and data[p[1]] == _OID
    if any(t == _INT and p[1] == p[2] for t, p in zip(tags, parts)):
        return False
    if tags[0] == _INT:
        version = content(parts[0])
        if tags == [_INT] * 9 or tags == [_INT] * 9 + [_SEQ]:
            return version == (b"\0" if len(tags) == 9 else b"\1")
        if tags == [_INT] * 6:
            return version == b"\0"
        if tags[:2] == [_INT, _OCTETS]:
            return version == b"\1" and tags[2:] in ([], [0xA0], [0xA1], [0xA0, 0xA1]) and len(content(parts[1])) >= 16
        if tags[:3] == [_INT, _SEQ, _OCTETS]:
            rest = tags[3:] in ([], [0xA0], [0xA1], [0x81], [0xA0, 0xA1], [0xA0, 0x81])
            return version in (b"\0", b"\1") and rest and begins_with_oid(parts[1])
        return False
    return tags == [_SEQ, _OCTETS] and begins_with_oid(parts[0]) and len(content(parts[1])) >= 16


def ssh_size(data: bytes) -> int | None:
    """Bytes of the OpenSSH private key that begins ``data``, by its nested lengths; None if they do not fit."""
    if not data.startswith(_SSH_MAGIC):
        return None
    at = len(_SSH_MAGIC)

    def field() -> bytes | None:
        nonlocal at
        size = int.from_bytes(data[at : at + 4])
        if at + 4 > len(data) or at + 4 + size > len(data):
            return None
        at += 4 + size
        return data[at - size : at]

    cipher, kdf, options = field(), field(), field()
    if not cipher or not kdf or options is None or at + 4 > len(data):
        return None
    keys = int.from_bytes(data[at : at + 4])
    at += 4
    for _ in range(keys):
        public = field()
        # a public key begins with its type, again with its length before it
        if public is None or len(public) < 8 or int.from_bytes(public[:4]) > len(public) - 4:
            return None
    private = field()
    return at if keys and private and len(private) % 8 == 0 else None


def _decoded(text: str) -> bytes | None:
    clean = _BREAK.sub("", text).replace("-", "+").replace("_", "/").rstrip("=")
    if len(clean) % 4 == 1:
        return None
    return binascii.a2b_base64(clean + "=" * (-len(clean) % 4))


def _exactly(text: str, start: int, size: int) -> tuple[bytes, int] | None:
    """``size`` bytes decoded from ``start`` and where their base64 ends: at the end of a line or run."""
    need, at = (4 * size + 2) // 3, start
    run = _LINES.match(text, start)
    stop = run.end() if run else start
    for line in re.finditer(r"[A-Za-z0-9+/_-]+", text[start:stop]):
        need -= line.end() - line.start()
        if need <= 0:
            at = start + line.end()
            break
    if need or at == start:
        return None
    raw = _decoded(text[start:at])
    while at < len(text) and text[at] == "=" and at - start < stop - start:
        at += 1
    return (raw, at) if raw is not None and len(raw) == size else None


def _keys(text: str) -> Iterator[tuple[str, Span]]:
    upto = 0
    for found in _KEY.finditer(text):
        size = der_size(_decoded(found[0])) if found.start() >= upto else None
        exact = _exactly(text, found.start(), size) if size else None
        if exact and is_private_key(exact[0]):
            upto = exact[1]
            yield "key", (found.start(), upto)


def _ssh_keys(text: str) -> Iterator[tuple[str, Span]]:
    for found in _SSH.finditer(text):
        run = _LINES.match(text, found.start())[0].rstrip("=")
        # whatever follows in the run, the nested lengths say where the key ends
        clean = _BREAK.sub("", run)
        size = ssh_size(_decoded(clean[: len(clean) - (len(clean) % 4 == 1)]))
        exact = _exactly(text, found.start(), size) if size else None
        if exact:
            yield "ssh", (found.start(), exact[1])


def _hex_keys(text: str) -> Iterator[tuple[str, Span]]:
    for found in _HEX_BYTES.finditer(text):
        if len(found[0]) % 2 == 0:
            raw = bytes.fromhex(found[0])
            if is_private_key(raw):
                yield "key", found.span()
            elif ssh_size(raw) == len(raw):
                yield "ssh", found.span()


def _tokens(text: str) -> Iterator[tuple[str, Span]]:
    for found in _TOKEN.finditer(text):
        if is_signed_token(*found.groups()):
            yield "token", found.span()


def find_secrets(text: str, may_hold: set[str] | frozenset[str] = frozenset(KINDS)) -> list[tuple[str, Span]]:
    """(kind, (start, end)) in code points, by start and then in the order of ``KINDS``."""
    out: list[tuple[str, Span]] = []
    if "assign" in may_hold:
        out += [("assign", m.span()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    if "access" in may_hold:
        out += [("access", m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    if "hex" in may_hold:
        out += [("hex", m.span()) for m in _HEX.finditer(text)]
    if "token" in may_hold:
        out += _tokens(text)
    if "key" in may_hold:
        out += _keys(text)
    if "ssh" in may_hold:
        out += _ssh_keys(text)
    if may_hold & {"key", "ssh"}:
        out += _hex_keys(text)
    return sorted(out, key=lambda s: (s[1][0], KINDS.index(s[0]), s[1][1]))


def _line(spans: list[tuple[str, Span]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, (start, end) in spans)


_ADDED = [
    *[StructField(f"n_{kind}", LongType()) for kind in BASE],
    StructField("base_sha256", StringType()),
    StructField("spans", StringType()),
]
_NONE = hashlib.sha256(b"").hexdigest()


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the findings to rows whose last column is the text, which goes."""
    for batch in batches:
        text = batch.column(batch.num_columns - 1).cast(pa.large_string()).fill_null("")
        may_hold: dict[int, set[str]] = {}
        for kind, pattern in _MAY_HOLD.items():
            for row in pc.indices_nonzero(pc.match_substring_regex(text, pattern)).to_pylist():
                may_hold.setdefault(row, set()).add(kind)
        counts = {kind: [0] * batch.num_rows for kind in BASE}
        digests, lines = [_NONE] * batch.num_rows, [""] * batch.num_rows
        for row, kinds in may_hold.items():
            found = find_secrets(text[row].as_py(), kinds)
            base = [s for s in found if s[0] in BASE]
            for kind, _ in base:
                counts[kind][row] += 1
            digests[row], lines[row] = hashlib.sha256(_line(base).encode()).hexdigest(), _line(found)
        added = [*(pa.array(counts[k], pa.int64()) for k in BASE), pa.array(digests), pa.array(lines)]
        names = [*batch.schema.names[:-1], *(f.name for f in _ADDED)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *added], names)


@shipped
def scan_secrets(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)`` per row of ``docs``.

    ``spans`` lists ``kind:start:end`` in code points, by start and then in the order of ``KINDS``;
    ``base_sha256`` digests the same list of the three base kinds. Null counts as the empty text and gives no spans. Rows
    that repeat are scanned again; other columns are not read; an empty table gives no rows.
    """
    rows = docs.select("doc_id", "text").toDF("0", "1")
    out = StructType([StructField("0", rows.schema["0"].dataType), *_ADDED])
    return rows.mapInArrow(_scan, out).withColumnRenamed("0", "doc_id")
