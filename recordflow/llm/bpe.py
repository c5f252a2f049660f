"""Byte-level BPE encoding and decoding of whole texts.

A long text is cut into overlapping chunks; each chunk is pre-tokenised on its own, and neighbours are
stitched at the first pre-token boundary of their overlap from which both agree: a match depends only on
what follows its start, so two scans that share a boundary stay together.  The pieces between stitches are
encoded one by one, and decoding concatenates the raw bytes of the ids.  A run without any boundary in
an overlap is joined with what follows, whatever its length.

Defined cases: a null text is empty, and an empty text has no ids; null ids pass through; repeated rows are
encoded one by one; an empty table gives an empty result; extra columns are ignored.  Rows are independent:
no shuffle, memory bounded by an Arrow batch and the largest text.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: Characters of a chunk's own part, and of the part that it shares with the next.
CHUNK, OVERLAP = 2_048, 256


@lru_cache(4)
def encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(4)
def _pretokens(pattern: str):
    import regex

    return regex.compile(pattern)


def _starts(find, text: str, start: int, end: int) -> list[int]:
    """Starts of the pre-tokens of text[start:end] scanned on its own; the last ones may be bent by the cut."""
    at = [m.start() + start for m in find.finditer(text[start:end])]
    return at if end == len(text) else at[:-2]


def _meeting(text: str, left: list[int], right: list[int], after: int) -> int | None:
    """The first boundary past ``after`` that both scans have; from there on both are the same scan.

    No cut follows white space: what ends a piece must not change how its last white space is split.
    """
    ours = set(left)
    return next((p for p in right if p > after and p in ours and not text[p - 1].isspace()), None)


def stitched(text: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[str]:
    """Pieces of ``text`` that may be encoded one by one: every cut is a pre-token boundary of the whole."""
    if len(text) <= chunk + overlap:
        return [text] if text else []
    find, size = _pretokens(pattern), len(text)
    starts = range(0, size, chunk)
    scans = [_starts(find, text, s, min(s + chunk + overlap, size)) for s in starts]
    cuts, left = [0], scans[0]
    for start, scan in zip(starts[1:], scans[1:]):
        if left is None:  # the neighbour never met the whole text's scan: go on from the last cut
            left = _starts(find, text, cuts[-1], min(start + overlap, size))
        both = _meeting(text, left, scan, start)
        if both is not None:
            cuts.append(both)
        left = scan if both is not None else None
    return [text[a:b] for a, b in zip(cuts, [*cuts[1:], size])]


def encode(text: str, path: str, pattern: str) -> np.ndarray:
    enc = encoding(path, pattern)
    parts = [enc.encode_to_numpy(p, allowed_special=set(), disallowed_special=()) for p in stitched(text, pattern)]
    return np.concatenate(parts).astype("<u4") if parts else np.empty(0, "<u4")


def decode(ids: np.ndarray, path: str, pattern: str) -> bytes:
    return encoding(path, pattern).decode_bytes(ids.tolist())


def encoded(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: doc_id, ids (array of int), the decoded bytes."""
    return _run(docs, path, pattern, id_col, text, digests=False)


def encoded_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return _run(docs, path, pattern, id_col, text, digests=True)


def _run(docs, path, pattern, id_col, text, digests):
    small_batches(docs.sparkSession)
    only = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = only.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            ids = [encode(t or "", path, pattern) for t in b.column(1).to_pylist()]
            if digests:
                columns = [
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(decode(x, path, pattern)).hexdigest() for x in ids], pa.string()),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            else:
                columns = [
                    pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())),
                    pa.array([decode(x, path, pattern) for x in ids], pa.binary()),
                ]
                names = ["doc_id", "ids", "decoded"]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], names)

    out = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded binary"
    return only.mapInArrow(run, f"doc_id {kind}, {out}")
