"""Secret scan by structural confirmation (operator 9).

Plain patterns give the base spans.  On top, strings that may hold encoded
key material are decoded (base64, base64url, hex) and reported only if the
bytes parse: ASN.1 DER with nested lengths that fit, SSH wire fields that
fill the blob, or a signed token whose header names its algorithm.  PEM bodies
may have escaped line ends, as in JSON.  A run that decodes to no key as a whole
(a path, a name and a key joined by _, - or /) is searched for the places where
encoded keys begin.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import struct

import pyarrow as pa
from pyspark.sql import DataFrame

from supplyscope.llm.work import session, text_or_empty

# The base patterns.
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

KINDS = ("assign", "access", "hex", "jwt", "ssh", "der")
ORDER = {k: i for i, k in enumerate(KINDS)}
ENCODED = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
PEM = re.compile(r"-----BEGIN [A-Z0-9 ]+-----([A-Za-z0-9+/=\s\\]+)-----END [A-Z0-9 ]+-----")
#: What stands between the base64 of a PEM body: white space, plain or escaped
#: (once or more often), and the backslash of an escaped slash.
BETWEEN = re.compile(r"\\+[nrt]?|\s")
#: How base64 of a DER sequence, of SSH wire fields and of an OpenSSH key begins.
BEGIN = re.compile(r"(?=M[A-P]|AAAA[A-P][GHWXmn23]|b3BlbnNzaC)")
HEX_RUN = re.compile(r"(?<![0-9a-fA-F])30[0-9a-fA-F]{38,}")
#: Characters of base64 that show a key's outer lengths and algorithm.
GLANCE = 64
#: Least bytes of a key within a run, as ENCODED's least length, and the tags
#: that keys and certificates are made of; chance meets plain lengths too often.
LEAST_INNER = 30
TAGS = frozenset([1, 2, 3, 4, 5, 6, 10, 12, 18, 19, 20, 22, 23, 24, 30, 0x30, 0x31, *range(0xA0, 0xA4), *range(0x80, 0x84)])
JWT = re.compile(r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
#: Hex digits as "h", all else as a space: a fast test for a long hex run.
HEX_BYTES = bytes(104 if chr(c) in "0123456789abcdef" else 32 for c in range(256))
CODE_BYTES = bytes(104 if c < 128 and (chr(c).isalnum() or chr(c) in "+/_-") else 32 for c in range(256))


def der(blob: bytes, depth: int = 0) -> bool:
    """Whether ``blob`` is one or more DER elements whose nested lengths fill
    it exactly; at the top, one SEQUENCE of at least two elements."""
    i, count = 0, 0
    while i < len(blob):
        if i + 2 > len(blob):
            return False
        tag, n, i = blob[i], blob[i + 1], i + 2
        if n >= 0x80:
            width = n & 0x7F
            if not 1 <= width <= 4 or i + width > len(blob) or blob[i] == 0:
                return False
            n, i = int.from_bytes(blob[i:i + width], "big"), i + width
        if i + n > len(blob) or depth == 0 and (tag != 0x30 or i + n != len(blob)):
            return False
        if tag & 0x20 and (depth >= 12 or not der(blob[i:i + n], depth + 1)):
            return False
        if depth == 0 and not elements(blob[i:i + n]) >= 2:
            return False
        i, count = i + n, count + 1
    return count > 0


def elements(blob: bytes) -> int:
    """DER elements that stand side by side in ``blob`` (known to parse)."""
    i = count = 0
    while i + 2 <= len(blob):
        n, i = blob[i + 1], i + 2
        if n >= 0x80:
            width = n & 0x7F
            n, i = int.from_bytes(blob[i:i + width], "big"), i + width
        i, count = i + n, count + 1
    return count


def ssh(blob: bytes) -> bool:
    """Whether length-prefixed fields fill ``blob``, the first an algorithm."""
    if blob.startswith(b"openssh-key-v1\0"):
        return True
    i, fields = 0, []
    while i + 4 <= len(blob):
        n = struct.unpack_from(">I", blob, i)[0]
        if i + 4 + n > len(blob):
            return False
        fields.append(blob[i + 4:i + 4 + n])
        i += 4 + n
    return i == len(blob) and len(fields) >= 2 and bool(re.match(rb"ssh-|ecdsa-|sk-", fields[0]))


def decoded(s: str) -> bytes:
    """Bytes of a base64 or base64url string, empty if it isn't one."""
    s = re.sub(r"\s|=", "", s).replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(s + "=" * (-len(s) % 4), validate=True)
    except (binascii.Error, ValueError):
        return b""


def signed_token(s: str) -> bool:
    """Whether header and payload of ``a.b.c`` are JSON objects and the
    header names an algorithm."""
    try:
        head, body = (json.loads(decoded(x)) for x in s.split(".")[:2])
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(head.get("alg"), str) and isinstance(body, dict)


def key_kind(blob: bytes) -> str | None:
    if len(blob) >= 16 and blob[0] == 0x30 and der(blob):
        return "der"
    if len(blob) >= 16 and blob[:1] in (b"\0", b"o") and ssh(blob):
        return "ssh"
    return None


def inner_der(blob: bytes) -> bool:
    """Whether ``blob`` is DER of a key's tags, an integer or sequence first."""
    def usual(b: bytes) -> bool:
        i = 0
        while i + 2 <= len(b):
            tag, n, i = b[i], b[i + 1], i + 2
            if n >= 0x80:
                width = n & 0x7F
                n, i = int.from_bytes(b[i:i + width], "big"), i + width
            if tag not in TAGS or tag & 0x20 and not usual(b[i:i + n]):
                return False
            i += n
        return True
    if len(blob) < LEAST_INNER or key_kind(blob) != "der":
        return False
    return blob[2 + (blob[1] & 0x7F if blob[1] >= 0x80 else 0)] in (0x02, 0x30) and usual(blob)


def der_size(head: bytes) -> int:
    """Bytes that the DER sequence at the start of ``head`` says it has, 0 if
    that isn't one, or if the elements that open one another at its start
    don't fit."""
    i, end, depth, size = 0, 1 << 40, 0, 0
    while i + 6 <= len(head):
        tag, n, i = head[i], head[i + 1], i + 2
        if n >= 0x80:
            width = n & 0x7F
            if not 1 <= width <= 4 or head[i] == 0:
                return 0
            n, i = int.from_bytes(head[i:i + width], "big"), i + width
        if i + n > end or depth > 12 or depth == 0 and tag != 0x30:
            return 0
        end, depth, size = i + n, depth + 1, size or i + n
        if not tag & 0x20:
            break
    return size


def inner_keys(s: str) -> list[tuple[str, int, int]]:
    """Keys that begin within an encoded run: DER as long as it says, SSH
    fields up to the run's end."""
    out, done = [], 0
    for m in HEX_RUN.finditer(s):
        size = 2 * der_size(bytes.fromhex(m[0][:min(GLANCE, len(m[0]) // 2 * 2)]))
        if 0 < size <= len(m[0]) and inner_der(bytes.fromhex(m[0][:size])):
            out.append(("der", m.start(), m.start() + size))
    for m in BEGIN.finditer(s):
        a = m.start()
        if a < done or any(x <= a < y for _, x, y in out):
            continue
        head = s[a:a + GLANCE]
        head = decoded(head[:len(head) // 4 * 4])
        if s[a] == "M":
            size = der_size(head)
            b = a + -(-size * 4 // 3)
            if size and b <= len(s) and inner_der(decoded(s[a:b])):
                done = b + len(re.match("={0,2}", s[b:b + 2])[0])
                out.append(("der", a, done))
        elif head.startswith(b"openssh-key-v1\0") or re.match(rb"ssh-|ecdsa-|sk-", head[4:]):
            if key_kind(decoded(s[a:])) == "ssh":
                done = len(s)
                out.append(("ssh", a, done))
    return out


def base_spans(text: str, low: str, raw: bytes) -> list[tuple[str, int, int]]:
    out = []
    if any(k in low for k in ("passw", "secret", "token", "api")):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= LEAST_ASSIGN]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    if b"h" * LEAST_HEX in raw.translate(HEX_BYTES):
        out += [("hex", m.start(), m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= LEAST_HEX]
    return out


def confirmed_spans(text: str, raw: bytes) -> list[tuple[str, int, int]]:
    """Spans whose decoded bytes parse as key material or a signed token."""
    out = []
    if "eyJ" in text:
        out += [("jwt", m.start(), m.end()) for m in JWT.finditer(text) if signed_token(m[0])]
    if "-----BEGIN " in text:
        for m in PEM.finditer(text):
            if kind := key_kind(decoded(BETWEEN.sub("", m[1]))):
                out.append((kind, m.start(), m.end()))
    if b"h" * 40 in raw.translate(CODE_BYTES):
        taken = [(a, b) for _, a, b in out]
        for m in ENCODED.finditer(text):
            if any(a <= m.start() < b for a, b in taken):
                continue
            s = m[0]
            blob = bytes.fromhex(s) if len(s) % 2 == 0 and re.fullmatch(r"[0-9a-fA-F]+", s) else decoded(s)
            if kind := key_kind(blob):
                out.append((kind, m.start(), m.end()))
            else:
                out += [(k, m.start() + a, m.start() + b) for k, a, b in inner_keys(s)]
    return out


def scan(text: str) -> tuple[list, list]:
    """(base spans, all spans) of a text, by start, then kind as listed."""
    raw = text.encode()
    by = lambda s: (s[1], ORDER[s[0]])
    base = base_spans(text, text.lower(), raw)
    return sorted(base, key=by), sorted(base + confirmed_spans(text, raw), key=by)


def joined(spans: list) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_assign, n_access, n_hex, n_confirmed,
    base_sha256 (of the base spans) and spans (all), offsets in code points.

    Null and empty texts have no spans; repeated rows and null ids pass
    through; other columns are not read.  Rows are independent: no shuffle,
    one Arrow batch in memory at a time.
    """
    session(docs)

    def run(batches):
        for b in batches:
            found = [scan(t) for t in b.column(1).to_pylist()]
            count = lambda k: pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), count("assign"), count("access"), count("hex"),
                 pa.array([len(every) - len(base) for base, every in found], pa.int64()),
                 pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found], pa.string()),
                 pa.array([joined(every) for _, every in found], pa.string())],
                names=["id", "n_assign", "n_access", "n_hex", "n_confirmed", "base_sha256", "spans"])

    kept = docs.select(docs[id_col].alias("id"), text_or_empty(docs[text_col]).alias("text"))
    kind = kept.schema["id"].dataType.simpleString()
    out = kept.mapInArrow(run, f"id {kind}, n_assign long, n_access long, n_hex long, n_confirmed long, "
                               "base_sha256 string, spans string")
    return out.withColumnRenamed("id", id_col)
