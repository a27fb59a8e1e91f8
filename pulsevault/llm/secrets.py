"""Secret scan with structural confirmation.

Three base patterns (assignments, access keys, long hex runs) are reported as they match. Further candidates, runs of base64
or hex and dotted tokens, are decoded and reported only if their content parses: a DER SEQUENCE whose nested lengths close
exactly and which starts like a private or public key, an OpenSSH key blob whose length-prefixed fields fill it, or a signed
token whose header is a JSON object that names an algorithm. Line ends may be escaped (a backslash and n or r, as in JSON and
env strings); base64 may be of either alphabet, and wrapped over lines of which the first has 16 characters at least.

Time is linear in the length of a text: every run of characters is tried from its start or from a line's start only.

One pass over whole texts inside Arrow batches, no shuffle. Spans are in code points, end exclusive.

Rows: null text is empty and gives no spans; null or repeated doc_ids give a row each; an empty table gives an empty result;
other columns are ignored by scan() and kept by redacted()."""

from __future__ import annotations

import base64
import binascii
import hashlib
import itertools
import json
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import map_rows, short_batches

#: Kinds in the order of ties; the first three are the base.
KINDS = ("assign", "access", "hex", "der", "ssh", "jwt")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")  # runs are taken whole, so asking for 32 equals dropping shorter ones
_ANY_HEX = re.compile(r"[0-9A-Fa-f]{64,}")
_END = r"[ \t]*(?:\r?\n|\r|(?:\\+[nr])+)[ \t]*"
_LINE_END = re.compile(_END)
_LONG = re.compile(r"[A-Za-z0-9+/_-]{16}")
#: Lines of base64 in both alphabets.
_BASE64 = [re.compile(f"[A-Za-z0-9{c}]{{16,}}(?:{_END}[A-Za-z0-9{c}]+)*={{0,2}}") for c in ("+/", "_-")]
_PEM_HEAD = re.compile(r"-----BEGIN ([A-Z0-9 ]+)-----")
_PEM_BODY = re.compile(r"[A-Za-z0-9+/=\s\\]+")
_ESCAPES = re.compile(r"\\+[nrt]|[\s\\]")
#: The header of a token, a whole run of its characters that two more dotted parts follow. Every run is tried once only.
_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{11,}+)(?=\.([A-Za-z0-9_-]*+)\.([A-Za-z0-9_-]*+))")
_TO_PLAIN = str.maketrans("-_", "+/")
_SSH_MAGIC = b"openssh-key-v1\x00"
_SSH_NAME = re.compile(rb"(ssh|ecdsa|sk)-[a-z0-9@.-]+")


#: Elements that a sequence of a key holds at most; keys of all kinds and certificates have about ten. A start that claims more is
#: given up there, so that each costs a bounded time.
_MOST_ITEMS = 32


def der_items(data: bytes, at: int = 0, end: int | None = None) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the elements that fill data[at:end] exactly, else None."""
    end, out = len(data) if end is None else end, []
    while at < end:
        if at + 2 > end or len(out) == _MOST_ITEMS:
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size & 0x80:
            k = size & 0x7F
            if not 1 <= k <= 4 or at + k > end:
                return None
            size, at = int.from_bytes(data[at : at + k], "big"), at + k
        if at + size > end:
            return None
        out.append((tag, at, at + size))
        at += size
    return out


def is_der_key(data: bytes) -> bool:
    """A SEQUENCE that fills data and holds a key: integers (the version and numbers of a key), or an algorithm sequence
    with its identifier beside a bit or octet string; nested sequences must close too."""
    outer = der_items(data)
    if not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    parts = der_items(data, *outer[0][1:])
    if not parts or len(parts) < 2:
        return False
    for tag, a, b in parts:
        if tag in (0x30, 0x31, 0xA0, 0xA1) and der_items(data, a, b) is None:
            return False
    tags = [t for t, _, _ in parts]
    if tags.count(0x02) >= 2 and set(tags[:2]) == {0x02}:
        return True  # numbers of an RSA or DSA key
    if tags[:2] == [0x02, 0x04]:
        return True  # version and octets of an elliptic-curve key
    algorithm = next((p for p in parts if p[0] == 0x30), None)
    names = der_items(data, *algorithm[1:]) if algorithm else None
    return bool(names) and names[0][0] == 0x06 and bool({0x03, 0x04} & set(tags))


def is_ssh_blob(data: bytes) -> bool:
    """Length-prefixed fields that start with a key type and fill data, or the container of a private key."""
    if bytes(data[: len(_SSH_MAGIC)]) == _SSH_MAGIC:
        at = len(_SSH_MAGIC)
        for _ in range(3):  # cipher, derivation, its options
            if at + 4 > len(data):
                return False
            at += 4 + int.from_bytes(data[at : at + 4], "big")
        return at + 4 <= len(data)
    at, fields = 0, []
    while at + 4 <= len(data) and len(fields) <= _MOST_FIELDS:
        size = int.from_bytes(data[at : at + 4], "big")
        fields.append(data[at + 4 : at + 4 + size])
        at += 4 + size
    return at == len(data) and len(fields) >= 2 and bool(_SSH_NAME.fullmatch(fields[0]))


def _decoded(text: str) -> bytes | None:
    try:
        return base64.b64decode(text + "=" * (-len(text.rstrip("=")) % 4) if not text.endswith("=") else text, validate=True)
    except (binascii.Error, ValueError):
        return None


def is_jwt(token: str) -> bool:
    head = token.partition(".")[0]
    try:
        data = json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except (binascii.Error, ValueError, RecursionError):
        return False
    return isinstance(data, dict) and isinstance(data.get("alg"), str)


def _key_kind(data: bytes | None) -> str | None:
    if not data:
        return None
    return "der" if data[0] == 0x30 and is_der_key(data) else "ssh" if is_ssh_blob(data) else None


_MOST_FIELDS = 64  # of a key blob; certificates have about 14


def _key_sizes(data: memoryview) -> list[int]:
    """Numbers of bytes, the largest first, after which a key that starts data may end. Only lengths are looked at."""
    most = len(data)

    def number(i: int, size: int) -> int:
        return int.from_bytes(data[i : i + size], "big")

    if most and data[0] == 0x30:  # a SEQUENCE
        first = number(1, 1)
        k = first & 0x7F if first & 0x80 else 0
        size = 2 + k + (number(2, k) if k <= 4 else most) if k else 2 + first
        return [size] if 6 <= size <= most else []
    pos, out, private = 0, [], bytes(data[:3]) == b"ope"
    if private:
        out.append(most)
        pos = len(_SSH_MAGIC)
        for _ in range(3):  # cipher, derivation, its options
            if pos + 4 > most:
                return out
            pos += 4 + number(pos, 4)
        if pos + 4 > most:
            return out
        n = number(pos, 4)
        pos += 4
    for _ in range(min(n + 1, _MOST_FIELDS) if private else _MOST_FIELDS):  # public keys, then the private part
        if pos + 4 > most:
            break
        pos += 4 + number(pos, 4)
        if not private and pos <= most:
            out.append(pos)
    return [pos, *out] if private and pos < most else out if private else out[::-1]


def _is_ssh_head(data: bytes) -> bool:
    size = int.from_bytes(data[:4], "big")
    return data.startswith(_SSH_MAGIC) or bool(_SSH_NAME.match(data[4:44])) and size < 256


def _base64_keys(text: str, m: re.Match) -> list[tuple[int, int, str]]:
    """Spans of the keys in lines of base64. A key starts at a line's start and ends at a line's end."""
    ends = [(e.start(), e.end()) for e in _LINE_END.finditer(text, m.start(), m.end())]
    starts, stops = [m.start(), *[b for _, b in ends]], [*[a for a, _ in ends], m.end()]
    if m.start() and text[m.start() - 1] == "\\" and text[m.start()] in "nr":
        starts[0] += 1  # the letter belongs to an escaped line end
    run = "".join(text[a:b] for a, b in zip(starts, stops, strict=True)).rstrip("=").translate(_TO_PLAIN)
    firsts = [0, *itertools.accumulate(b - a for a, b in zip(starts, stops, strict=True))]
    firsts[-1] = len(run)
    place = {at: j for j, at in enumerate(firsts[1:])}  # characters up to a line's end
    read: dict[int, memoryview] = {}  # the run decoded once from each of its first four places; keys are parts of that
    out, i = [], 0
    while i < len(starts):
        at, found = firsts[i], None
        head = run[at : at + 64]
        ssh = head.startswith(("AAAA", "b3Bl")) and _is_ssh_head(_decoded(head[: len(head) // 4 * 4]) or b"")
        data = memoryview(b"")
        if ssh or head.startswith("M"):
            if at % 4 not in read:
                rest = run[at % 4 :]
                read[at % 4] = memoryview(_decoded(rest[: len(rest) - (len(rest) % 4 == 1)]) or b"")
            data = read[at % 4][at // 4 * 3 :]
        for size in _key_sizes(data) if len(data) else []:
            need = -(-4 * size // 3)
            if need >= 40 and at + need in place and (kind := _key_kind(data[:size])):
                found = place[at + need]
                out.append((starts[i], stops[found], kind))
                break
        i = i + 1 if found is None else found + 1
    return out


def _tokens(text: str) -> list[tuple[int, int, str]]:
    """Spans of signed tokens: three dotted parts of which the first is a header, or ends with one that starts with eyJ."""
    out = []
    for m in _TOKEN.finditer(text):
        at, end = m.span()
        if at and text[at - 1] == "\\" and text[at] in "nr":
            at += 1  # the letter belongs to an escaped line end
        for start in dict.fromkeys((at, text.find("eyJ", at, end))):
            if start >= 0 and end - start >= 11 and is_jwt(text[start:end]):
                out.append((start, m.end(3), "jwt"))
                break
    return out


def _pem_keys(text: str) -> list[tuple[int, int, str]]:
    """Spans of keys between BEGIN and END lines. What lies between has no dash, so the next one must be that of END."""
    out, at = [], text.find("-----BEGIN ")
    while at >= 0:
        head = _PEM_HEAD.match(text, at)
        start = head.end() if head else at + 11
        if head:
            dash = text.find("-", start)
            tail = f"-----END {head[1]}-----"
            if dash > start and text.startswith(tail, dash) and _PEM_BODY.fullmatch(text, start, dash):
                if kind := _key_kind(_decoded(_ESCAPES.sub("", text[start:dash]))):
                    out.append((at, dash + len(tail), kind))
        at = text.find("-----BEGIN ", start)
    return out


def spans_of(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind as listed in KINDS."""
    if not text:
        return []
    out = [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    for m in _ANY_HEX.finditer(text):
        if kind := _key_kind(bytes.fromhex(m[0][: len(m[0]) // 2 * 2])):
            out.append((m.start(), m.end(), kind))
    out += _pem_keys(text)
    if _LONG.search(text):
        for pattern in _BASE64:
            for m in pattern.finditer(text):
                out += _base64_keys(text, m)
    out += _tokens(text)
    return sorted(set(out), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_confirmed (spans of the other kinds), base_sha256, spans."""
    counts = ["n_assign", "n_access", "n_hex", "n_confirmed"]
    arrow = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in counts], ("base_sha256", pa.string()), ("spans", pa.string())])

    def make():
        base = KINDS[:3]

        def work(batch: pa.RecordBatch) -> dict:
            out = {f.name: [] for f in arrow}
            out["doc_id"] = batch.column(0)
            for text in batch.column(1).to_pylist():
                spans = spans_of(text)
                kinds = [k for _, _, k in spans]
                for name, kind in zip(counts, base, strict=False):
                    out[name].append(kinds.count(kind))
                out["n_confirmed"].append(sum(k not in base for k in kinds))
                out["base_sha256"].append(hashlib.sha256(joined([s for s in spans if s[2] in base]).encode()).hexdigest())
                out["spans"].append(joined(spans))
            return out

        return work

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), make, "doc_id long, " + ", ".join(f"{c} long" for c in counts) + ", base_sha256 string, spans string", arrow)


def redact(text: str | None, mark: str = "[SECRET]") -> str | None:
    """text with every span, overlapping ones merged, replaced by `mark`."""
    spans = spans_of(text)
    if not spans:
        return text
    out, at = [], 0
    for a, b, _ in spans:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


@F.pandas_udf(StringType())
def _redacted(text: pd.Series) -> pd.Series:
    return pd.Series([redact(t) for t in text], dtype=object)


def redacted(docs: DataFrame) -> DataFrame:
    """docs with the secrets in `text` replaced; all rows and columns stay, n_chars follows where docs has it."""
    short_batches(docs.sparkSession)
    out = docs.withColumn("text", _redacted("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return out.select(*docs.columns)
