"""Secret scans: keyword prefilter, anchored expressions near its hits, checksum validation.

An Aho-Corasick automaton finds keywords in one pass; an expression is tried only at a hit, anchored
there, in the order of the hits, which gives the same leftmost non-overlapping matches as a search of
the whole text.  Runs of hexadecimal digits have no keyword: they are found from the gaps between
other characters.  Tokens that carry a checksum are reported only if it holds.

Defined cases: a null text is empty and has no spans; null ids pass through; repeated rows are scanned
one by one; an empty table gives an empty result; extra columns are ignored by ``scan_secrets`` and
kept by ``redacted_documents``.  Rows are independent: no shuffle, memory bounded by an Arrow batch.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import joined_spans, small_batches

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "github", "npm", "jwt", "slack", "stripe", "private_key")

_FLAGS = re.ASCII | re.IGNORECASE
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", _FLAGS
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_GITHUB = re.compile(r"gh[pousr]_([0-9A-Za-z]{36})(?![0-9A-Za-z])")
_NPM = re.compile(r"npm_([0-9A-Za-z]{36})(?![0-9A-Za-z])")
_JWT = re.compile(r"eyJ[A-Za-z0-9_-]{5,}\.[A-Za-z0-9_-]{5,}\.[A-Za-z0-9_-]{16,}")
_SLACK = re.compile(r"xox[abeoprs]-[0-9A-Za-z-]{10,}")
_STRIPE = re.compile(r"[sr]k_live_[0-9A-Za-z]{16,}")
_KEY = re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----")

_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def base62_crc(body: str) -> str:
    """CRC-32 of ``body`` in six base-62 digits, as token issuers append it."""
    n, out = zlib.crc32(body.encode("ascii")), ""
    for _ in range(6):
        n, r = divmod(n, 62)
        out = _DIGITS[r] + out
    return out


def _checked(m: re.Match) -> bool:
    return base62_crc(m[1][:30]) == m[1][30:]


def _jwt_header(m: re.Match) -> bool:
    part = m[0].split(".", 1)[0]
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except (binascii.Error, ValueError, TypeError):
        return False


#: Keyword, kind, expression, accepting test; keywords are in lower case.
_RULES = (
    *((k, "assign", _ASSIGN, lambda m: len(m[2]) >= 8) for k in ("password", "passwd", "secret", "token", "apikey", "api_key")),
    ("akia", "access", _ACCESS, lambda m: len(m[0]) >= 16),
    *((f"gh{c}_", "github", _GITHUB, _checked) for c in "pousr"),
    ("npm_", "npm", _NPM, _checked),
    ("eyj", "jwt", _JWT, _jwt_header),
    *((f"xox{c}-", "slack", _SLACK, lambda m: True) for c in "abeoprs"),
    ("sk_live_", "stripe", _STRIPE, lambda m: True),
    ("rk_live_", "stripe", _STRIPE, lambda m: True),
    ("-----begin ", "private_key", _KEY, lambda m: True),
)

_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


@lru_cache(1)
def _automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for i, rule in enumerate(_RULES):
        a.add_word(rule[0], i)
    a.make_automaton()
    return a


@lru_cache(1)
def _is_hex() -> np.ndarray:
    lut = np.zeros(128, bool)
    lut[[ord(c) for c in "0123456789abcdef"]] = True
    return lut


def _hex_runs(text: str) -> list[tuple[int, int]]:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    other = np.flatnonzero(~_is_hex()[np.minimum(codes, 127)])  # U+007F is no digit
    edges = np.concatenate(([-1], other, [len(codes)]))
    at = np.flatnonzero(np.diff(edges) > 32)
    return [(int(edges[i]) + 1, int(edges[i + 1])) for i in at]


def find_secrets(text: str | None) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) in code points, base kinds and added kinds, unordered."""
    if not text:
        return []
    lower = text.lower()
    if len(lower) != len(text):
        lower = text.translate(_ASCII_LOWER)
    found = [("hex", s, e) for s, e in _hex_runs(text)]
    hits = sorted({(end - len(_RULES[i][0]) + 1, _RULES[i][1], i) for end, i in _automaton().iter(lower)})
    over: dict[str, int] = {}
    for start, kind, i in hits:
        if start < over.get(kind, 0):
            continue
        _, _, pattern, accepted = _RULES[i]
        if m := pattern.match(text, start):
            over[kind] = m.end()
            if accepted(m):
                found.append((kind, start, m.end()))
    return found


def _scan(batches):
    for b in batches:
        rows = [find_secrets(t) for t in b.column(1).to_pylist()]
        base = [joined_spans([s for s in r if s[0] in BASE], KINDS) for r in rows]
        counts = [[sum(s[0] == k for s in r) for r in rows] for k in BASE]
        yield pa.RecordBatch.from_arrays(
            [
                b.column(0),
                *(pa.array(c, pa.int64()) for c in counts),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in base], pa.string()),
                pa.array([joined_spans(r, KINDS) for r in rows], pa.string()),
            ],
            ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
        )


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: counts of the base kinds, digest of the base spans, all spans."""
    small_batches(docs.sparkSession)
    only = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = only.schema["doc_id"].dataType.simpleString()
    return only.mapInArrow(
        _scan, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def redact(text: str | None) -> str | None:
    """``text`` with every span of a secret replaced by ``[SECRET]``; overlapping spans count as one."""
    spans = sorted((s, e) for _, s, e in find_secrets(text))
    if not spans:
        return text
    out, at = [], 0
    for s, e in spans:
        if s >= at:
            out += [text[at:s], "[SECRET]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redacted_documents(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """All rows and columns; ``text`` without secrets, ``n_chars`` (where there is one) of the new text."""
    small_batches(docs.sparkSession)
    names = docs.columns

    def run(batches):
        for b in batches:
            columns, at = list(b.columns), names.index(text)
            new = [redact(t) for t in b.column(at).to_pylist()]
            columns[at] = pa.array(new, b.schema.field(at).type)
            if n_chars in names:
                n = names.index(n_chars)
                old = b.column(at).to_pylist()
                was = b.column(n).to_pylist()
                columns[n] = pa.array(
                    [w if x is y or x == y else len(x) for w, x, y in zip(was, new, old)], b.schema.field(n).type
                )
            yield pa.RecordBatch.from_arrays(columns, schema=b.schema)

    return docs.mapInArrow(run, docs.schema)
