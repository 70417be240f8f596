"""Secret scans by structural confirmation.

Base patterns find assignments, access ids and long hex runs. Candidates that look
like encodings are then *decoded* and parsed: base64, hex and PEM bodies must hold a
DER key structure whose nested lengths add up (or an OpenSSH key container), signed
tokens must have a JSON header naming an algorithm (nested DEEPEST levels at most). Only confirmed structures add spans.
One narrow scan; no shuffle.

Defined cases: a null or empty text has no spans and the digest of the empty string; a
null doc_id is kept; repeated rows give repeated results; a text of any length is
scanned whole; other columns of the input are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import itertools
import json
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from terrapair.llm import _text as T

# Fixed values of the contract: the three base kinds, in the order that breaks ties.
ASSIGN = re.compile(rb"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]{16,}")
HEX = re.compile(rb"[0-9a-f]{24,}")
BASE_KINDS = ("assign", "access", "hex")
MIN_VALUE = 6

# Candidates for structural confirmation.
#: The first of three dotted parts; a header naming an algorithm has 14 characters at least.
SIGNED = re.compile(rb"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{14,}+)={0,2}+(?=(\.([A-Za-z0-9_-]++={0,2}+)\.[A-Za-z0-9_-]*+))")
#: A header is a JSON object; these are the characters its first byte, a brace or a blank, can start with.
HEADER = re.compile(rb"[eICD]")
OBJECT = re.compile(rb"[ \t\r\n]*(?:\{[ \t\r\n]*(?:\"|$)|$)")
#: Three blanks each, as encoded.
BLANKS = re.compile(b"(?:" + b"|".join(base64.b64encode(bytes(x)) for x in itertools.product(b" \t\r\n", repeat=3)) + b")*")
JSON = json.JSONDecoder()
#: Characters that an unfinished part of a JSON text may need: a word, an escape or a number's end.
PART = 16
QUOTED = re.compile(r'"(?:[^"\\]|\\.)*"')
#: Levels that a header is nested in at most.
DEEPEST = 16
#: Runs, also wrapped over lines.
BASE64 = re.compile(rb"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:[ \t]*+(?:\r?\n|\r|\\r\\n|\\n)[ \t]*+[A-Za-z0-9+/_-]++)*+")
BREAK = re.compile(rb"[ \t]*(?:\r?\n|\r|\\r\\n|\\n)[ \t]*")
MIN_BASE64 = 40
ANY_HEX = re.compile(rb"[0-9a-fA-F]{64,}")
PEM = re.compile(rb"-----BEGIN ([A-Z ]*PRIVATE KEY)-----((?:[A-Za-z0-9+/=\s\\:,._]|-(?!----)){16,}?)-----END \1-----")
DEK = re.compile(rb"DEK-Info:\s*[A-Za-z0-9-]+,[0-9A-Fa-f]{16,}")
#: A SEQUENCE of under 128 bytes or with a length field, as encoded.
START64, START_HEX = re.compile(rb"(?=M[A-I])"), re.compile(rb"(?=30[0-8])")
OPENSSH64 = re.compile(rb"b3BlbnNzaC1rZXktdjEA")
OPENSSH = b"openssh-key-v1\x00"
#: Characters that tell whether a container's first field is sane.
OPENSSH_HEAD = 120
#: A keyword is followed by a quote, blanks, then ':' or '='; texts without either need no search.
SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def _der(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, content start and content end of the element at `at`, if its length fits."""
    if at + 2 > end:
        return None
    tag, n, at = data[at], data[at + 1], at + 2
    if n & 0x80:
        k = n & 0x7F
        if not 1 <= k <= 4 or at + k > end:
            return None
        n, at = int.from_bytes(data[at : at + k], "big"), at + k
    return (tag, at, at + n) if at + n <= end else None


def _children(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    out = []
    while at < end:
        x = _der(data, at, end)
        if x is None:
            return None
        out.append(x)
        at = x[2]
    return out


def is_key(data: bytes) -> bool:
    """Does `data` hold a key: PKCS#1, PKCS#8, SEC 1 or subject-public-key DER with nested
    lengths that add up exactly, encrypted PKCS#8 too, or an OpenSSH container with a sane
    first field?"""
    if data.startswith(OPENSSH):
        n = int.from_bytes(data[len(OPENSSH) : len(OPENSSH) + 4], "big")
        return 0 < n <= 64 and len(data) > len(OPENSSH) + 4 + n
    if len(data) < 16 or data[0] != 0x30:
        return False
    top = _der(data, 0, len(data))
    if top is None or top[2] != len(data):
        return False
    inner = _children(data, top[1], top[2])
    if not inner or len(inner) < 2:
        return False
    tags = [x[0] for x in inner]
    if tags[0] == 0x02 and set(tags) == {0x02} and len(tags) >= 2:  # PKCS#1
        return max(x[2] - x[1] for x in inner) >= 16
    if tags[0] == 0x02 and len(tags) >= 3 and tags[1] == 0x30 and tags[2] == 0x04:  # PKCS#8
        algorithm = _children(data, inner[1][1], inner[1][2])
        return bool(algorithm) and algorithm[0][0] == 0x06
    if tags[0] == 0x02 and tags[1] == 0x04:  # SEC 1
        return inner[1][2] - inner[1][1] >= 16
    if tags[0] == 0x30 and tags[1] == 0x03 and len(tags) == 2:  # SubjectPublicKeyInfo
        algorithm = _children(data, inner[0][1], inner[0][2])
        return bool(algorithm) and algorithm[0][0] == 0x06
    if tags == [0x30, 0x04] and inner[1][2] - inner[1][1] >= 16:  # EncryptedPrivateKeyInfo
        algorithm = _children(data, inner[0][1], inner[0][2])
        return bool(algorithm) and [x[0] for x in algorithm] == [0x06, 0x30]
    return False


def decode64(raw: bytes) -> bytes | None:
    raw = raw.rstrip(b"=").translate(bytes.maketrans(b"-_", b"+/"))
    if len(raw) % 4 == 1:
        return None
    try:
        return base64.b64decode(raw + b"=" * (-len(raw) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _unhex(raw: bytes) -> bytes | None:
    return binascii.unhexlify(raw) if len(raw) % 2 == 0 else None


def _header(run: bytes, at: int) -> dict | None:
    """The JSON object that run[at:] encodes, blanks around it.

    It is decoded in growing parts, and given up where a part shows that it can't be one: only
    an object that goes on to the run's end costs as much as the run is long.
    """
    size = 64
    while True:
        body = decode64(run[at : at + size])
        if body is None:
            return None
        try:
            if at + size >= len(run):
                head = json.loads(body)
                return head if isinstance(head, dict) else None
            text = body.decode("utf-8", "replace")
            head, end = JSON.raw_decode(text, len(text) - len(text.lstrip(" \t\r\n")))
        except json.JSONDecodeError as e:
            # a part may end in a word, a number or a string
            if at + size >= len(run) or not e.msg.startswith("Unterminated string") and e.pos < len(text) - PART:
                return None
            bare = QUOTED.sub("", text)
            if bare.count("{") + bare.count("[") - bare.count("}") - bare.count("]") > DEEPEST:
                return None
        except (ValueError, RecursionError):
            return None
        else:
            rest = decode64(run[at + size :]) if not text[end:].strip(" \t\r\n") else None
            return head if rest is not None and not rest.strip(b" \t\r\n") else None
        size *= 2


def _signed(raw: bytes) -> Iterator[tuple[int, int, str]]:
    """Tokens whose header, from any place in its run on, is a JSON object naming an algorithm."""
    upto = 0
    for m in SIGNED.finditer(raw):
        if m.start() < upto or decode64(m[3]) is None:
            continue
        run = m[1]
        blank = [0] * 4  # for each alignment: starts before this differ from one that failed in blanks only
        for x in HEADER.finditer(run):
            at = x.start()
            if at < blank[at % 4]:
                continue
            first = decode64(run[at : at + 12])
            if first is None or not OBJECT.match(first):
                continue
            blank[at % 4] = BLANKS.match(run, at).end()
            # from the last group of blanks on it is the same object
            head = _header(run, max(at, blank[at % 4] - 4))
            if head is not None and isinstance(head.get("alg"), str):
                upto = m.end(2)
                yield m.start() + at, upto, "signed"
                break


def _is_pem(body: bytes) -> bool:
    """A key, or with header lines of encryption anything whole that decodes."""
    lines = re.split(rb"(?:\\r|\\n|\r|\n)+", body)
    headers = b"\n".join(x for x in lines if b":" in x)
    data = decode64(re.sub(rb"\s|\\", b"", b"".join(x for x in lines if b":" not in x)))
    if data is None:
        return False
    if b"ENCRYPTED" in headers and DEK.search(headers):
        return len(data) >= 16 and len(data) % 8 == 0
    return is_key(data)


def _sizes(head: bytes) -> int:
    """Bytes of the SEQUENCE that starts so, 0 if none of a key's forms does."""
    if len(head) < 8 or head[0] != 0x30:
        return 0
    k = head[1] & 0x7F if head[1] & 0x80 else 0
    if k > 4 or head[1] == 0x80:
        return 0
    n = int.from_bytes(head[2 : 2 + k], "big") if k else head[1]
    return n + 2 + k if head[2 + k] in (0x02, 0x30) else 0


def _keys(run: bytes, starts: re.Pattern, decode: Callable[[bytes], bytes | None], per: int) -> Iterator[tuple[int, int]]:
    """(first, end) in `run` of the keys that start anywhere in it. A byte takes `per` / 3 characters.

    A whole structure of another kind, as a certificate, is passed over with what it holds.
    """
    upto = 0
    for m in starts.finditer(run):
        a = m.start()
        if a < upto or not (n := _sizes(decode(run[a : a + 4 * per]) or b"")):
            continue
        b = a - (-n * per // 3)
        if b > len(run) or (data := decode(run[a:b])) is None:
            continue
        if is_key(data):
            upto = b
            yield a, b
        elif n >= 100 and (top := _der(data, 0, n)) and top[2] == n and _children(data, top[1], n):
            upto = b


def _keys64(raw: bytes) -> Iterator[tuple[int, int, str]]:
    for m in BASE64.finditer(raw):
        run, gaps = m[0], []
        if cut := list(BREAK.finditer(run)):
            at = 0
            for x in cut:
                at += x.end() - x.start()
                gaps.append((x.end() - at, at))
            run = BREAK.sub(b"", run)
        if len(run) < MIN_BASE64:
            continue
        place = [0, *(p for p, _ in gaps)]
        more = [0, *(g for _, g in gaps)]
        found = list(_keys(run, START64, decode64, 4))
        for x in OPENSSH64.finditer(run):
            end = min(len(run) - ((len(run) - x.start()) % 4 == 1), x.start() + OPENSSH_HEAD)
            data = decode64(run[x.start() : end])
            if data is not None and is_key(data):
                found.append((x.start(), len(run)))
                break
        for a, b in found:
            first = m.start() + a + more[bisect_right(place, a) - 1]
            end = m.start() + b - 1 + more[bisect_right(place, b - 1) - 1] + 1
            yield first, end + len(re.match(rb"={0,2}", raw[end : end + 2])[0]), "key64"


def scan(raw: bytes) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(base spans, added spans) of one UTF-8 text, as byte offsets (start, end, kind)."""
    base: list[tuple[int, int, str]] = []
    if b"=" in raw or b":" in raw:
        base += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(raw) if m.end(2) - m.start(2) >= MIN_VALUE]
    if b"AKIA" in raw:
        base += [(m.start(), m.end(), "access") for m in ACCESS.finditer(raw)]
    base += [(m.start(), m.end(), "hex") for m in HEX.finditer(raw)]
    added: list[tuple[int, int, str]] = []
    if b"." in raw:
        added += _signed(raw)
    if b"-----BEGIN " in raw:
        added += [(m.start(), m.end(), "pem") for m in PEM.finditer(raw) if _is_pem(m[2])]
    added += _keys64(raw)
    for m in ANY_HEX.finditer(raw):
        added += [(m.start() + a, m.start() + b, "keyhex") for a, b in _keys(m[0], START_HEX, _unhex, 6)]
    order = {k: i for i, k in enumerate(BASE_KINDS)}
    base.sort(key=lambda x: (x[0], order[x[2]]))
    return base, added


def _points(raw: bytes, spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Byte offsets to code points."""
    if not spans or raw.isascii():
        return spans
    at = {0: 0}
    before = 0
    for x in sorted({p for s in spans for p in s[:2]}):
        at[x] = at[before] + len(raw[before:x].decode("utf-8", "replace"))
        before = x
    return [(at[a], at[b], k) for a, b, k in spans]


def _join(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def _map(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in T.slices(batches):
        data, off = T.buffers(T.column(batch, "text"))
        raw = data.tobytes()
        rows = []
        for i in range(batch.num_rows):
            text = raw[off[i] : off[i + 1]]
            base, added = scan(text)
            both = _points(text, base + added)
            base, added = both[: len(base)], both[len(base) :]
            kinds = [k for _, _, k in base]
            digest = hashlib.sha256(_join(base).encode()).hexdigest()
            rows.append((*map(kinds.count, BASE_KINDS), digest, _join(sorted(both, key=lambda x: x[0]))))
        cols = list(zip(*rows))
        yield pa.record_batch(
            [T.column(batch, "doc_id"), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string()), pa.array(cols[4], pa.string())],
            names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
        )


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: counts of the base kinds, the digest of the base spans, and all spans
    as ``kind:start:end`` in code points (end exclusive)."""
    return docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text").mapInArrow(_map, SCHEMA)
