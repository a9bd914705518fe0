"""Secret scan with structural confirmation.

Three base patterns report by shape alone. Beyond them, every run that could be base64, base64url or
hex is decoded and reported only if its bytes parse as what they claim to be: nested DER lengths
that fill the whole value in the form of a private key (PKCS#1, PKCS#8, SEC1, DSA), the nested lengths
of an OpenSSH private key, or a signed token whose header and payload are JSON objects and whose
header names an algorithm. A run is tried at every place where one of these could begin, since
paths, names and prefixes (/ _ - + 0x) run into it, and an armoured body may hold its line ends as
escapes. Random text does not parse, so these reports need no score.

A span is (kind, start, end) in code points, end exclusive. Kinds, in the order used for equal
starts: ``assign``, ``access``, ``hex`` (base), ``jwt``, ``key`` (confirmed).

Edge rows: null counts as empty; an empty text has no spans, zero counts and the digest of the
empty string; repeated rows, repeated or null ids give one output row each; other columns are
ignored by ``scan`` and kept by ``redact``.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tillstream.llm.texts import steps, strings

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "jwt", "key")

# The base patterns. A run shorter than its kind's minimum can be left out of the match itself
# where that changes no other match: an access key or hex run ends where its characters end.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                     r"([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_MIN_VALUE, _MIN_ACCESS = 12, 18

# Header segments of signed tokens, from the first place that could open a JSON object ({" or { and
# white space), and the two segments behind. A segment is passed over as a whole, so long ones cost no
# more than their length.
_HEADER = re.compile(r"e[yw][A-Za-z0-9+/_-]*+(?=(\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++={0,2})?)")
_OPENING = re.compile(r"e[yw]")
# Runs worth decoding, and armoured blocks whose body runs over several lines.
_RUN = re.compile(r"[A-Za-z0-9+/_-]{24,}(?:\.[A-Za-z0-9_-]+){0,2}={0,2}")
_ARMOUR = re.compile(r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----([A-Za-z0-9+/=\s\\]+)-----END ")
# What stands between lines of an armoured body: white space, or its escape in JSON and the like.
_BREAKS = re.compile(r"\s+|\\+[nrt]|\\+(?=/)")
_HEX_DIGITS = re.compile(r"[0-9a-fA-F]{48,}")
# Where a key may begin inside a run: a SEQUENCE of 16 bytes or more, the OpenSSH magic, or an armoured
# key that is itself base64.
_KEY_BASE64 = re.compile(r"M[B-I]|b3BlbnNzaC1rZXkt|LS0tLS1CRUdJTi")
_KEY_HEX = re.compile(r"30(?=[1-8])|6[fF]70656[eE]7373682[dD]6[bB]65792[dD]")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Spans of the three base patterns, leftmost and non-overlapping within each kind."""
    found = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text)
             if m.end(2) - m.start(2) >= _MIN_VALUE]
    found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)
              if m.end() - m.start() >= _MIN_ACCESS]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return found


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tags and values of the DER items that fill ``data`` exactly, else None."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > len(data):
                return None
            size = int.from_bytes(data[at:at + width])
            at += width
            if size < 0x80:
                return None  # DER wants the short form here
        if at + size > len(data):
            return None
        items.append((tag, data[at:at + size]))
        at += size
    return items


_INTEGER, _OCTETS, _OID, _SEQUENCE = 0x02, 0x04, 0x06, 0x30
# Object identifiers of encryption under a password: 1.2.840.113549.1.5 and 1.2.840.113549.1.12.1.
_PASSWORD_BASED = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))


def is_der_key(data: bytes) -> bool:
    """A single SEQUENCE in the form of a private key, its nested lengths adding up."""
    if len(data) < 32 or data[0] != _SEQUENCE:
        return False
    outer = der_items(data)
    inner = der_items(outer[0][1]) if outer and len(outer) == 1 else None
    if inner and [tag for tag, _ in inner] == [_SEQUENCE, _OCTETS]:  # encrypted PKCS#8
        algorithm = der_items(inner[0][1])
        return bool(algorithm) and algorithm[0][0] == _OID and algorithm[0][1].startswith(_PASSWORD_BASED)
    if not inner or inner[0][0] != _INTEGER or len(inner[0][1]) != 1:
        return False
    tags = [tag for tag, _ in inner]
    if len(tags) >= 9 and set(tags[:9]) == {_INTEGER}:
        return True  # PKCS#1: version, modulus, exponents, primes, coefficients
    if tags == [_INTEGER] * 6:
        return inner[0][1] == b"\x00"  # DSA: version, p, q, g, public and private value
    if tags[1:3] == [_SEQUENCE, _OCTETS]:
        algorithm = der_items(inner[1][1])
        return bool(algorithm) and algorithm[0][0] == _OID  # PKCS#8
    return tags[1:2] == [_OCTETS] and inner[0][1] == b"\x01" and len(inner[1][1]) >= 16  # SEC1


_SSH_MAGIC = b"openssh-key-v1\x00"


def ssh_key_size(read: Callable[[int, int], bytes], total: int) -> int:
    """Bytes of the OpenSSH private key (cipher, KDF, options, key count, public keys, private part) at
    the beginning of ``total`` bytes, or -1. ``read`` gives some bytes at a place: only lengths are."""
    if read(0, len(_SSH_MAGIC)) != _SSH_MAGIC:
        return -1

    def string(at: int) -> int:
        if at < 0 or at + 4 > total:
            return -1
        end = at + 4 + int.from_bytes(read(at, 4))
        return end if end <= total else -1

    at = len(_SSH_MAGIC)
    for _ in range(3):
        at = string(at)
    if at < 0 or at + 4 > total:
        return -1
    keys, at = int.from_bytes(read(at, 4)), at + 4
    if not 1 <= keys <= 16:
        return -1
    for _ in range(keys + 1):
        at = string(at)
    return at


def is_ssh_key(data: bytes) -> bool:
    return ssh_key_size(lambda at, n: data[at:at + n], len(data)) == len(data) > 0


def unbase64(run: str) -> bytes | None:
    """Bytes of a base64 or base64url run, padded or not; None if it is neither."""
    bare = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(bare) % 4 == 1:
        return None
    try:
        return base64.b64decode(bare + "=" * (-len(bare) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _json_object(segment: str) -> dict | None:
    data = unbase64(segment)
    if not data or data.lstrip()[:1] != b"{":
        return None
    try:
        value = json.loads(data)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def is_signed_token(run: str) -> bool:
    parts = run.rstrip("=").split(".")
    if len(parts) != 3:
        return False
    header = _json_object(parts[0])
    return bool(header) and isinstance(header.get("alg"), str) and _json_object(parts[1]) is not None


def token_spans(text: str) -> list[Span]:
    """Signed tokens, wherever in their first segment the header begins."""
    found = []
    for m in _HEADER.finditer(text):
        if not m[1] or _json_object(m[1].rstrip("=").split(".")[1]) is None:
            continue
        segment, starts = m[0], []
        # A place decodes to the end of what its alignment decodes to, and one object at most ends there.
        for phase in range(4):
            data = unbase64(segment[phase:]) or b""
            at = _last_object(data.decode("latin-1")) if data.rstrip()[-1:] == b"}" else -1
            if at >= 0 and at % 3 == 0:
                starts.append(phase + at // 3 * 4)
        for start in sorted(starts):
            if _OPENING.match(segment, start) and is_signed_token(segment[start:] + m[1]):
                found.append(("jwt", m.start() + start, m.end(1)))
                break
    return found


_MARKS = re.compile(r'\\++(["{}\[\]])?|["{}\[\]]')


def _last_object(text: str) -> int:
    """Where a JSON object would begin that ends with the text's last brace, or -1. Read backwards, quotes
    and brackets tell: a quote behind an odd number of backslashes is inside a string."""
    marks = [(m.end() - 1, m[0][-1]) for m in _MARKS.finditer(text)
             if m[0][0] != "\\" or m[1] and (len(m[0]) % 2 or m[1] != '"')]
    depth, inside = 0, False
    for at, mark in reversed(marks):
        if mark == '"':
            inside = not inside
        elif not inside:
            depth += 1 if mark in "}]" else -1
            if depth <= 0:
                return at if mark == "{" and depth == 0 else -1
    return -1


def _is_key(data: bytes | None) -> bool:
    return bool(data) and (is_der_key(data) or is_ssh_key(data))


def _der_size(head: bytes | None) -> int:
    """Bytes of the SEQUENCE that begins with ``head`` (eight bytes or more), by its length; -1 if
    it does not open with an INTEGER of one byte or a SEQUENCE, as every key does."""
    if not head or len(head) < 8 or head[0] != _SEQUENCE:
        return -1
    width = head[1] & 0x7F if head[1] & 0x80 else 0
    if width > 4 or head[1] == 0x80 or (
            head[2 + width:4 + width] != b"\x02\x01" and head[2 + width] != _SEQUENCE):
        return -1
    return 2 + width + (int.from_bytes(head[2:2 + width]) if width else head[1])


def _base64_keys(body: str) -> Iterator[tuple[int, int]]:
    """Keys in a run of base64 or base64url, from any place in it to its end or to a character that
    may also be a separator (/ _ - +). The length at the place says where a key ends."""
    at, armoured = 0, set()
    for m in _KEY_BASE64.finditer(body):
        start = m.start()
        if start < at:
            continue
        if body[start] == "L":
            if start % 4 not in armoured and _is_armoured_key(unbase64(body[start:])):
                yield start, len(body)
                return
            armoured.add(start % 4)
            continue
        if body[start] == "M":
            size = _der_size(unbase64(body[start:start + 12]))
        else:
            def read(place: int, n: int, start: int = start) -> bytes:
                group = place // 3
                some = body[start + group * 4:start + -(-(place + n) // 3) * 4]
                return (unbase64(some[:len(some) - (len(some) % 4 == 1)]) or b"")[place - group * 3:][:n]

            size = ssh_key_size(read, (len(body) - start) * 3 // 4)
        end = start + (4 * size + 2) // 3
        if size < 0 or end > len(body) or end < len(body) and body[end] not in "/_-+":
            continue
        if _is_key(unbase64(body[start:end])):
            yield start, end
            at = end


def _is_armoured_key(data: bytes | None) -> bool:
    found = _ARMOUR.search((data or b"").decode("latin-1"))
    return bool(found) and _is_key(unbase64(_BREAKS.sub("", found[1])))


def _hex_keys(body: str) -> Iterator[tuple[int, int]]:
    """Keys in a stretch of hex digits, from any place in it to its end."""
    for m in _KEY_HEX.finditer(body):
        start = m.start()
        if (len(body) - start) % 2 or body[start] == "3" and _der_size(
                bytes.fromhex(body[start:start + 16])) * 2 != len(body) - start:
            continue
        if _is_key(bytes.fromhex(body[start:])):
            yield start, len(body)
            return


def confirmed_spans(text: str) -> list[Span]:
    """Spans of candidates whose decoded structure parses."""
    found = token_spans(text)
    for m in _ARMOUR.finditer(text):
        if _is_key(unbase64(_BREAKS.sub("", m[1]))):
            found.append(("key", m.start(1), m.end(1)))
    for m in _RUN.finditer(text):
        run = m[0]
        if is_signed_token(run):
            found.append(("jwt", m.start(), m.end()))
            continue
        bare = run.rstrip("=")
        at = m.start()
        for body in bare.split("."):
            for h in _HEX_DIGITS.finditer(body):
                found += [("key", at + h.start() + start, at + h.start() + end)
                          for start, end in _hex_keys(h[0])]
            for start, end in _base64_keys(body):
                # Padding belongs to a key that ends the run.
                whole = at + end == m.start() + len(bare)
                found.append(("key", at + start, m.end() if whole else at + end))
            at += len(body) + 1
    return list(dict.fromkeys(found))


def in_order(spans: list[Span]) -> list[Span]:
    """By start, then kind as listed, then end; a span found twice is one."""
    return sorted(set(spans), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Id, counts of the base kinds, digest of the base spans, all spans as text and as structs."""
    id_type = docs.schema[id_column].dataType.simpleString()
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()),
                                    ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, "text"):
            texts = strings(step["text"])
            base = [in_order(base_spans(t)) for t in texts]
            every = [in_order(b + confirmed_spans(t)) for t, b in zip(texts, base)]
            columns = {"id": step["id"]}
            for kind in BASE:
                columns[f"n_{kind}"] = pa.array(
                    [sum(s[0] == kind for s in spans) for spans in base], pa.int64())
            columns["base_sha256"] = pa.array(
                [hashlib.sha256(written(spans).encode()).hexdigest() for spans in base])
            columns["spans"] = pa.array([written(spans) for spans in every], pa.string())
            columns["found"] = pa.array(
                [[dict(zip(("kind", "start", "end"), s)) for s in spans] for spans in every],
                span_type)
            yield pa.RecordBatch.from_pydict(columns)

    return (docs.selectExpr(f"`{id_column}` AS id", f"`{text_column}` AS text")
            .mapInArrow(run, f"id {id_type}, n_assign long, n_access long, n_hex long, "
                             "base_sha256 string, spans string, "
                             "found array<struct<kind:string,start:int,end:int>>")
            .withColumnRenamed("id", id_column))


def blank_out(text: str, spans: list[Span]) -> str:
    """The text with each stretch of overlapping spans replaced by ``[kind]`` of its first."""
    pieces, at = [], 0
    for kind, start, end in in_order(spans):
        if start >= at:
            pieces += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*pieces, text[at:]])


def redact(docs: DataFrame, text_column: str = "text",
           length_column: str | None = None) -> DataFrame:
    """The same rows and columns, reported stretches replaced in the text; ``length_column``, if
    named, is set to the new length of texts that changed. Null texts stay null."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, text_column):
            texts = step[text_column].to_pylist()
            spans = [base_spans(t) + confirmed_spans(t) if t else [] for t in texts]
            if any(spans):
                clean = [blank_out(t, s) if s else t for t, s in zip(texts, spans)]
                at = step.schema.get_field_index(text_column)
                step = step.set_column(at, step.schema.field(at),
                                       pa.array(clean, step.schema.field(at).type))
                if length_column:
                    at = step.schema.get_field_index(length_column)
                    lengths = [len(t) if s else n for t, s, n in
                               zip(clean, spans, step[length_column].to_pylist())]
                    step = step.set_column(at, step.schema.field(at),
                                           pa.array(lengths, step.schema.field(at).type))
            yield step

    return docs.mapInArrow(run, schema)
