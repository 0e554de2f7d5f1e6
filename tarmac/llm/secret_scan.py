"""Secret scan with structural confirmation.

Three plain patterns report by their looks. Beyond them, candidates in base64,
base64url or hex are decoded and reported only when their bytes parse: DER
private keys with every nested length exact, OpenSSH key blobs with every
length-prefixed field in place, PEM blocks around either, and signed tokens
whose header names an algorithm.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import free_name, with_columns_from_text

#: Kinds in the order in which spans with the same start are listed; the first three are the plain patterns.
KINDS = ("assign", "access", "hex", "pem", "token", "der", "ssh")
BASE_KINDS = KINDS[:3]
SPANS = "array<struct<kind:string,start:int,end:int>>"
REDACTED = "[REDACTED]"

_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
# fixed pattern; ASCII letters of the words in either case only
_ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX_RUN = re.compile(r"[0-9a-f]{24,}")
_ANY_HEX = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){32,}(?![0-9A-Fa-f])")
_CHAR = "[A-Za-z0-9+/_-]"
# what may part the lines of one key: blanks, line ends also as \n and \r, quotes, marks of quoted or commented lines
_GAP = r"(?:\\+[nr]|[\s\"'>#*\\])"
# what a DER sequence or the OpenSSH magic starts with
_KEY_START = re.compile(rf"(?:(?<!{_CHAR})|(?<=\\[nr]))(?=M|b3BlbnNzaC){_CHAR}{{40,}}")
_CHAIN = re.compile(rf"{_GAP}++|({_CHAR}++(?:{_GAP}++{_CHAR}++)*+)={{0,2}}")
_RUN = re.compile(rf"{_GAP}++|({_CHAR}++)")
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]{0,40}PRIVATE KEY)-----((?:(?!-----(?:BEGIN|END) ).)*+)-----END \1-----", re.DOTALL)
_ESCAPED_END = re.compile(r"\\+[nr]")
_ENCRYPTED = re.compile(r"Proc-Type:\s*4\s*,\s*ENCRYPTED")
# the headers of an encrypted block may stand on one line with its body
_ENCRYPTED_HEADERS = re.compile(rf"{_ENCRYPTED.pattern}|DEK-Info:\s*[A-Za-z0-9-]+\s*(?:,\s*[0-9A-Fa-f]+)?")
_HEADER_LINE = re.compile(r"^.*:.*$", re.MULTILINE)
_GAPS = re.compile(rf"{_GAP}+")
_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
_MARKS = bytes(104 if chr(b) in "0123456789abcdef" else 98 if chr(b).isalnum() and b < 128 or chr(b) in "+/_-" else 32 for b in range(256))


def _length(data: bytes, at: int) -> tuple[int, int] | None:
    """(start, end) of the DER value whose length octets begin at ``at``; None where they are not the shortest form or run over."""
    if at >= len(data):
        return None
    first, at = data[at], at + 1
    if first >= 0x80:
        octets = first & 0x7F
        if not 1 <= octets <= 4 or at + octets > len(data) or data[at] == 0:
            return None
        first, at = int.from_bytes(data[at : at + octets], "big"), at + octets
        if first < 0x80:
            return None
    return (at, at + first) if at + first <= len(data) else None


def der_items(data: bytes, depth: int = 0) -> list[tuple[int, bytes]] | None:
    """(tag, content) of consecutive DER values that fill the bytes exactly, constructed ones checked inside."""
    out, at = [], 0
    while at < len(data):
        tag = data[at]
        span = _length(data, at + 1)
        if span is None or tag & 0x1F == 0x1F or depth > 12:
            return None
        content = data[span[0] : span[1]]
        if tag & 0x20 and der_items(content, depth + 1) is None:
            return None
        out.append((tag, content))
        at = span[1]
    return out


def is_der_private_key(data: bytes) -> bool:
    """One DER sequence shaped as an RSA, DSA, EC, PKCS #8 or encrypted PKCS #8 private key."""
    outer = der_items(data)
    if not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    items = der_items(outer[0][1]) or []
    tags = [tag for tag, _ in items]
    if len(tags) < 2:
        return False
    if tags == [0x30, 0x04]:  # encrypted: algorithm, octets
        return bool((der_items(items[0][1]) or [(0, b"")])[0][0] == 0x06)
    if tags[0] != 0x02 or items[0][1] not in (b"\0", b"\1"):
        return False
    if tags[1] == 0x04:  # EC: version 1, octets, perhaps curve and public key
        return items[0][1] == b"\1" and len(items[1][1]) >= 16 and set(tags[2:]) <= {0xA0, 0xA1}
    if tags[1] == 0x30:  # PKCS #8: version, algorithm, octets
        algorithm = der_items(items[1][1]) or [(0, b"")]
        return len(tags) >= 3 and tags[2] == 0x04 and algorithm[0][0] == 0x06
    return len(tags) in (6, 9) and set(tags) == {0x02} and len(items[1][1]) >= 32


def is_ssh_private_key(data: bytes) -> bool:
    """An OpenSSH key blob: magic, cipher, kdf, its options, key count, public and private parts, nothing left over."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at, fields = len(magic), 0
    while at + 4 <= len(data):
        if fields == 3:  # the number of keys stands among the fields
            if int.from_bytes(data[at : at + 4], "big") < 1:
                return False
            at, fields = at + 4, fields + 1
            continue
        end = at + 4 + int.from_bytes(data[at : at + 4], "big")
        if end > len(data):
            return False
        at, fields = end, fields + 1
    return fields >= 6 and at == len(data)


def _decoded(text: str) -> bytes:
    plain = text.replace("-", "+").replace("_", "/").rstrip("=")
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return b""


def _key_kind(data: bytes) -> str | None:
    return "der" if is_der_private_key(data) else "ssh" if is_ssh_private_key(data) else None


def _claimed(coded: str, at: int) -> int:
    """Bytes that the DER sequence or OpenSSH blob whose base64 begins at ``at`` says it has; 0 for anything else."""

    def number(first: int, size: int) -> int:
        part = _decoded(coded[at + first // 3 * 4 : at - (-(first + size) // 3) * 4])[first % 3 :][:size]
        return int.from_bytes(part, "big") if len(part) == size else len(coded)

    if coded[at] == "M":
        octets = number(1, 1)
        if octets < 0x80:
            return 2 + octets
        octets &= 0x7F
        return 2 + octets + number(2, octets) if 1 <= octets <= 4 else 0
    end = len("openssh-key-v1\0")
    for _ in range(3):
        end += 4 + number(end, 4)
    keys, end = number(end, 4), end + 4
    while keys >= 0 and end < len(coded):
        end, keys = end + 4 + number(end, 4), keys - 1
    return end


def _bare_keys(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of base64 keys on one line or wrapped over several.

    Runs of base64 with nothing but gaps between them are joined once; the length
    that a key states says at the end of which run it must end.
    """
    starts = [m.start() for m in _KEY_START.finditer(text)]
    found = []
    for chain in _CHAIN.finditer(text, starts[0]) if starts else ():
        if chain[1] is None or chain.end() - chain.start() < 40:
            continue
        runs = [m for m in _RUN.finditer(text, chain.start(1), chain.end(1)) if m[1]]
        coded = "".join(m[1] for m in runs)
        ends = list(accumulate(len(m[1]) for m in runs))
        for k in range(len(runs)):
            start, at = runs[k].start(), ends[k] - len(runs[k][1])
            place = bisect_left(starts, start)
            if place == len(starts) or starts[place] != start:
                continue
            end = at - (-_claimed(coded, at) * 4 // 3)
            last = bisect_left(ends, end, k)
            for upto in {k, last} if last < len(ends) and ends[last] == end else {k}:
                kind = _key_kind(_decoded(coded[at : ends[upto]]))
                if kind:
                    found.append((kind, start, chain.end() if upto == len(runs) - 1 else runs[upto].end()))
    return found


def is_signed_token(header: str, payload: str) -> bool:
    """The header decodes to a JSON object that names an algorithm, the payload to something."""
    try:
        head = json.loads(_decoded(header))
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(head.get("alg"), str) and bool(head["alg"]) and bool(_decoded(payload))


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, end exclusive, by start and then kind.

    Plain kinds: leftmost non-overlapping matches, those too short dropped after
    matching. Confirmed kinds do not repeat what lies inside a PEM block.
    """
    spans: list[tuple[str, int, int]] = []
    lower = text.lower()
    if any(word in lower for word in _WORDS):
        spans += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    marks = text.encode("utf-8", "replace").translate(_MARKS)
    if b"h" * 24 in marks:
        spans += [("hex", *m.span()) for m in _HEX_RUN.finditer(text)]
    blocks = []
    if "PRIVATE KEY-----" in text:
        for m in _PEM.finditer(text):
            body = _ESCAPED_END.sub("\n", m[2])
            data = _decoded(_GAPS.sub("", _HEADER_LINE.sub("", _ENCRYPTED_HEADERS.sub("", "\n".join(body.splitlines())))))
            if _key_kind(data) or data and _ENCRYPTED.search(body):
                spans.append(("pem", *m.span()))
                blocks.append(m.span())
    if "eyJ" in text:
        spans += [("token", *m.span()) for m in _TOKEN.finditer(text) if is_signed_token(m[1], m[2])]
    if b"b" * 40 in marks.replace(b"h", b"b"):
        found = [(k, (a, b)) for k, a, b in _bare_keys(text)]
        for m in _ANY_HEX.finditer(text):
            if m[0].startswith(("30", "6f70656e", "6F70656E")):
                found.append((_key_kind(bytes.fromhex(m[0])), m.span()))
        spans += [(k, *at) for k, at in found if k and not any(a <= at[0] < b for a, b in blocks)]
    return sorted(set(spans), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """The other columns and ``spans``: an array of (kind, start, end) in place of the text.

    Null and empty texts have no spans. Whole texts are searched.
    """

    def run(column: pa.Array) -> list[pa.Array]:
        found = [[{"kind": k, "start": a, "end": b} for k, a, b in find_spans(x or "")] for x in column.to_pylist()]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        return [pa.array(found, kind)]

    return with_columns_from_text(docs, text, {"spans": SPANS}, run)


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Counts of the plain kinds, the SHA-256 of their spans, and all spans as text."""

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return found.select(
        doc_id,
        *(F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in BASE_KINDS),
        F.sha2(span_text(of(*BASE_KINDS)), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )


def redacted(text: str) -> str:
    """The text with every run of touching or overlapping spans replaced by ``REDACTED``."""
    out, at, end = [], 0, 0
    for _, a, b in find_spans(text):
        if a >= end:
            out += [text[at:a], REDACTED]
        at = end = max(end, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """All rows and columns, secrets blotted out and the length column set anew; nulls stay null."""

    def run(column: pa.Array) -> list[pa.Array]:
        texts = [None if x is None else redacted(x) for x in column.to_pylist()]
        lengths = [None if x is None else len(x) for x in texts]
        return [pa.array(texts, pa.string()), pa.array(lengths, pa.int64())]

    name = free_name(docs.columns, "_text")
    held = docs.withColumnRenamed(text, name)
    out = with_columns_from_text(held, name, {text: "string", n_chars: "bigint"}, run)
    return out.select(*docs.columns)
