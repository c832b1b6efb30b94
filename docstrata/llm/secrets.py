"""Secrets in text: patterns, and candidates whose decoded structure proves what they are.

Three plain patterns report by themselves. Base64 and hexadecimal runs are decoded, and reported only if what comes
out is built like a key: a DER private key, encrypted or not, whose nested lengths add up, an OpenSSH key whose fields do,
a PEM text with one of these, or a signed token whose header names its algorithm. Base64 may be wrapped in lines, and
line breaks may be escaped.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from docstrata.llm.common import documents, with_result

# The plain patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 8, 16, 32

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "jwt", "pem", "der", "openssh")
ORDER = {kind: place for place, kind in enumerate(KINDS)}

HEX_RUN = re.compile(r"[0-9a-f]{%d,}" % HEX_LEAST)
TOKEN = re.compile(r"\beyJ[\w-]+\.[\w-]+\.[\w-]*", re.A)
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]{0,40}PRIVATE KEY)-----((?:[^-]|-(?!----))*)-----END \1-----")
#: A line break as it is, or as JSON and program text have it.
BREAK = r"[ \t]*(?:\r?\n|\\+r\\+n|\\+n)[ \t]*"
ESCAPED = re.compile(r"\\+[nrt]")
HEADER = re.compile(r"[A-Za-z][\w-]*:.*(?:\n[ \t]+\S.*)*", re.A)
CIPHERED = re.compile(r"Proc-Type:[ \t]*4,[ \t]*ENCRYPTED[ \t]*\r?\n(?:.*\n)*?DEK-Info:[ \t]*[\w-]+,[ \t]*(?:[0-9A-Fa-f]{2})+", re.A)
#: A run of base64 is looked at from so many characters; no key is shorter.
RUN_LEAST = 40
RUN = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % RUN_LEAST)
LINES = re.compile(r"[A-Za-z0-9+/_-]{%d,}(?:%s[A-Za-z0-9+/_-]+)+={0,2}" % (RUN_LEAST, BREAK))
LINE = re.compile(r"(?:%s)?([A-Za-z0-9+/_-]+)" % BREAK)
HEX_KEY = re.compile(r"(?:[0-9a-fA-F]{2}){%d,}" % RUN_LEAST)

#: How base64 shows that a PEM text begins, at each of the three places a byte can have.
PEM_MARK = b"-----BEGIN "
PEM_MARKS = tuple(base64.b64encode(bytes(k) + PEM_MARK)[k + (k > 0) : (k + len(PEM_MARK)) * 8 // 6].decode() for k in range(3))

SEQUENCE, INTEGER, OCTETS, IDENTIFIER = 0x30, 0x02, 0x04, 0x06
#: Password-based encryption of PKCS #5 and #12; a digest's length at most, which is wrapped in the same way under other algorithms.
BY_PASSWORD = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
DIGEST_MOST = 64
CONSTRUCTED = 0x20
DEEPEST = 16
OPENSSH = b"openssh-key-v1\0"


def _header(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the value at ``at``, if its length fits before ``end``."""
    if at + 2 > end:
        return None
    tag, size = data[at], data[at + 1]
    at += 2
    if size >= 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4 or at + n > end:
            return None
        size, at = int.from_bytes(data[at : at + n], "big"), at + n
    return (tag, at, at + size) if at + size <= end else None


def _fits(data: bytes, at: int, end: int, depth: int = 0) -> bool:
    """Whether values fill ``at`` to ``end`` without a rest, at every level of nesting."""
    while at < end:
        value = _header(data, at, end)
        if value is None or depth > DEEPEST or (value[0] & CONSTRUCTED and not _fits(data, value[1], value[2], depth + 1)):
            return False
        at = value[2]
    return True


def is_der_key(data: bytes) -> bool:
    """One sequence that begins with a small version number, holds a key and whose lengths all fit."""
    outer = _header(data, 0, len(data))
    if outer is None or outer[0] != SEQUENCE or outer[2] != len(data):
        return False
    version = _header(data, outer[1], outer[2])
    if version is None or version[0] != INTEGER or version[2] - version[1] != 1 or data[version[1]] > 3:
        return False
    body = _header(data, version[2], outer[2])
    return body is not None and body[0] in (SEQUENCE, INTEGER, OCTETS) and _fits(data, outer[1], outer[2])


def is_encrypted_key(data: bytes) -> bool:
    """One sequence of an algorithm and the encrypted key."""
    outer = _header(data, 0, len(data))
    if outer is None or outer[0] != SEQUENCE or outer[2] != len(data):
        return False
    method = _header(data, outer[1], outer[2])
    name = _header(data, method[1], method[2]) if method and method[0] == SEQUENCE else None
    body = _header(data, method[2], outer[2]) if name and name[0] == IDENTIFIER else None
    if body is None or body[0] != OCTETS or body[2] != outer[2] or not _fits(data, outer[1], outer[2]):
        return False
    return data[name[1] : name[2]].startswith(BY_PASSWORD) or body[2] - body[1] > DIGEST_MOST


def openssh_end(data: bytes) -> int | None:
    """Where a key ends: after the magic text, three names, a count of keys, and as many public parts and one private part that fit."""
    if not data.startswith(OPENSSH):
        return None
    at = len(OPENSSH)

    def field() -> bool:
        nonlocal at
        size = int.from_bytes(data[at : at + 4], "big") if at + 4 <= len(data) else len(data)
        at += 4 + size
        return at <= len(data)

    if not all(field() for _ in range(3)) or at + 4 > len(data):
        return None
    keys, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    return at if 1 <= keys <= 64 and all(field() for _ in range(keys + 1)) else None


def is_openssh_key(data: bytes) -> bool:
    return openssh_end(data) is not None


def key_kind(data: bytes) -> str | None:
    return "openssh" if is_openssh_key(data) else "der" if is_der_key(data) or is_encrypted_key(data) else None


def is_pem_body(body: str) -> bool:
    """Whether what stands between the lines of a PEM block is a key; header lines before it are skipped."""
    lines = ESCAPED.sub("\n", body).replace("\\/", "/") if "\\" in body else body
    ciphered = CIPHERED.search(lines) is not None
    data = decoded(HEADER.sub("", lines) if ":" in lines else lines)
    if not data:
        return False
    # Under these two headers the bytes are encrypted as a whole, in blocks of a cipher.
    return key_kind(data) is not None or ciphered and len(data) >= RUN_LEAST and len(data) % 8 == 0


def pem_end(data: bytes) -> int | None:
    """Where the last confirmed PEM key of decoded bytes ends."""
    return max((m.end() for m in PEM.finditer(data.decode("latin-1")) if is_pem_body(m[2])), default=None)


def wrapped_keys(block: str) -> list[tuple[int, int, str]]:
    """Start, end and kind of keys in base64 that is wrapped in lines. A key begins and ends with a line, padding aside."""
    lines = [m.span(1) for m in LINE.finditer(block)]
    body = "".join(block[a:b] for a, b in lines)
    at, places = 0, []
    for a, b in lines:
        places.append(at)
        at += b - a
    marked = sorted(m.start() for mark in PEM_MARKS for m in re.finditer(re.escape(mark), body))
    found, reached = [], 0
    for k, (start, end) in enumerate(lines):
        if places[k] < reached or end - start < RUN_LEAST:
            continue
        head = decoded(body[places[k] : places[k] + 24]) or b""
        outer, size, kind = _header(head + bytes(8), 0, 1 << 40), None, "der"
        if head.startswith(OPENSSH):
            size, kind = openssh_end(decoded_part(body[places[k] :])), "openssh"
        elif outer is not None and outer[0] == SEQUENCE:
            size = outer[2]
        elif any(places[k] <= p < places[k] + end - start for p in marked):
            size, kind = pem_end(decoded_part(body[places[k] :])), "pem"
        if not size or (most := places[k] + (size * 8 + 5) // 6) > len(body):
            continue
        last = max(i for i in range(k, len(lines)) if places[i] < most)
        # A PEM text may be followed by its line break, which takes a few characters more.
        if kind != "pem" and most != places[last] + lines[last][1] - lines[last][0]:
            continue
        if kind != "der" or key_kind(decoded_part(body[places[k] : most])[:size]):
            stop = lines[last][1]
            found.append((start, stop + len(block[stop : stop + 2]) - len(block[stop : stop + 2].lstrip("=")), kind))
            reached = most
    return found


def decoded_part(body: str) -> bytes:
    """Base64 without padding, whatever its length; a last lone character says nothing."""
    return decoded(body[: len(body) - (len(body) % 4 == 1)]) or b""


def decoded(run: str) -> bytes | None:
    """Base64 of either alphabet, padded or not; None if it is none."""
    body = "".join(run.split()).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def is_signed_token(run: str) -> bool:
    """A header that names its algorithm, and claims, both JSON objects."""
    try:
        header, claims = (json.loads(decoded(part) or b"") for part in run.split(".")[:2])
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str) and isinstance(claims, dict)


def may_be_key(run: str) -> bool:
    """From its first bytes: whether decoding all of a run is worth it."""
    head = decoded(run[:24])
    if head is None:
        return False
    if head.startswith(OPENSSH):
        return True
    outer = _header(head + bytes(8), 0, 1 << 40)
    return outer is not None and outer[0] == SEQUENCE and len(run.rstrip("=")) * 3 // 4 == outer[2]


def find_secrets(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base and added spans as (start, place of the kind in KINDS, end), sorted; code points, end exclusive."""
    if not text:
        return [], []
    base = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    base += [(m.start(), 2, m.end()) for m in HEX_RUN.finditer(text)]
    added = []
    if "eyJ" in text:
        added += [(m.start(), ORDER["jwt"], m.end()) for m in TOKEN.finditer(text) if is_signed_token(m[0])]
    pems = []
    if "PRIVATE KEY-----" in text:
        for m in PEM.finditer(text):
            if is_pem_body(m[2]):
                pems.append((m.start(), ORDER["pem"], m.end()))
    added += pems
    runs = []
    for m in RUN.finditer(text):
        # The letter of an escaped line break is none of the run's.
        low = m.start() + (m[0][0] in "nrt" and text[m.start() - 1 : m.start()] == "\\")
        run = text[low : m.end()]
        if may_be_key(run) and (data := decoded(run)) and (kind := key_kind(data)):
            runs.append((low, ORDER[kind], m.end()))
        elif any(mark in run for mark in PEM_MARKS) and pem_end(decoded_part(run.rstrip("="))):
            runs.append((low, ORDER["pem"], m.end()))
    for m in LINES.finditer(text):
        low = m.start() + (m[0][0] in "nrt" and text[m.start() - 1 : m.start()] == "\\")
        for start, end, kind in wrapped_keys(text[low : m.end()]):
            if (span := (low + start, ORDER[kind], low + end)) not in runs:
                runs = [r for r in runs if not (span[0] <= r[0] and r[2] <= span[2])] + [span]
    added += [r for r in runs if not any(start <= r[0] < end for start, _, end in pems)]
    for m in HEX_KEY.finditer(text):
        if PEM_MARK.hex() in m[0].lower() and pem_end(bytes.fromhex(m[0])):
            added.append((m.start(), ORDER["pem"], m.end()))
        if m[0][:2] == "30" or m[0].startswith(OPENSSH[:4].hex()):
            if kind := key_kind(bytes.fromhex(m[0])):
                added.append((m.start(), ORDER[kind], m.end()))
    return sorted(base), sorted(added)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan_text(text: str | None) -> tuple[int, int, int, str, str]:
    base, added = find_secrets(text)
    counts = [sum(kind == k for _, kind, _ in base) for k in range(len(BASE_KINDS))]
    return *counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(sorted({*base, *added}))


def redacted_text(text: str | None, mark: str = "[redacted]") -> str | None:
    """The text with its secrets replaced. A bare hexadecimal run proves nothing and stays."""
    base, added = find_secrets(text)
    out, at, reached = [], 0, -1
    for start, _, end in sorted(s for s in [*base, *added] if s[1] != ORDER["hex"]):
        if start >= reached:
            out += [text[at:start], mark]
        at = reached = max(reached, end)
    return "".join([*out, text[at:]]) if out else text


FIELDS = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def _scan(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([scan_text(t) for t in texts], columns=[f.split()[0] for f in FIELDS.split(", ")])


def _redacted(texts: pd.Series) -> pd.Series:
    return pd.Series([redacted_text(t) for t in texts], dtype=object)


def scan_secrets(docs: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a struct of counts and spans; also returns that struct's name.

    Null and empty texts have no spans: counts of 0, the checksum of nothing, an empty list. Each row is looked
    at by itself, so repeated rows and other columns don't matter, and no data moves.
    """
    return with_result(docs, text, _scan, FIELDS, "secrets")


def redact(docs: DataFrame, text: str = "text", size: str | None = "n_chars") -> DataFrame:
    """Every row, its text without secrets and ``size`` counted anew where the text changed. Null texts stay null."""
    found, name = with_result(docs, text, _redacted, "string", "redacted")
    if size in docs.columns:
        changed = ~F.col(f"`{name}`").eqNullSafe(F.col(f"`{text}`"))
        count = F.length(F.col(f"`{name}`")).cast(docs.schema[size].dataType)
        found = found.withColumn(size, F.when(changed, count).otherwise(F.col(f"`{size}`")))
    return found.withColumn(text, F.col(f"`{name}`")).select(*(f"`{c}`" for c in docs.columns))


def op9_structural_secrets(spark, sf_dir: str) -> DataFrame:
    found, name = scan_secrets(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", f"{name}.*")
