"""Identities, digests and fingerprints."""

import hashlib
import json

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def short_id(prefix: str, *parts: Column, size: int = 20) -> Column:
    """A prefixed, shortened SHA-1 of the parts."""
    return F.concat(F.lit(prefix), F.substring(F.sha1(F.concat_ws("|", *parts)), 1, size))


def request_digest(**parts: Column) -> Column:
    """SHA-256 of the named parts as compact JSON with sorted keys."""
    return F.sha2(F.to_json(F.struct(*[parts[k].alias(k) for k in sorted(parts)]), {"ignoreNullFields": "false"}), 256)


def json_size(*parts: Column) -> Column:
    """Bytes of the parts as compact JSON."""
    return F.octet_length(F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})).cast("long")


@F.pandas_udf(T.StringType())
def canonical_json_sha1(x: pd.Series) -> pd.Series:
    """SHA-1 of a JSON text in canonical form: sorted keys, no blanks; null where it does not parse."""

    def one(t):
        try:
            return hashlib.sha1(json.dumps(json.loads(t), sort_keys=True, separators=(",", ":")).encode()).hexdigest()
        except (TypeError, ValueError):
            return None

    return x.map(one)


@F.pandas_udf(T.StringType())
def simhash64(x: pd.Series) -> pd.Series:
    """Majority bits of BLAKE2b-8 over 3-word shingles, repeats included, ties set; empty under 25 words."""
    def one(t):
        w = (t or "").split()
        if len(w) < 25:
            return ""
        h = b"".join(
            hashlib.blake2b(" ".join(w[i : i + 3]).encode(), digest_size=8).digest() for i in range(len(w) - 2)
        )
        bits = np.unpackbits(np.frombuffer(h, np.uint8).reshape(-1, 8), axis=1).sum(0)
        return np.packbits(bits * 2 >= len(w) - 2).tobytes().hex()

    return pd.Series([one(t) for t in x])


def hamming(a: Column, b: Column) -> Column:
    """Differing bits of two 16-digit fingerprints; 0 where one is missing."""
    as_long = lambda c: F.conv(F.nullif(c, F.lit("")), 16, -10).cast("long")
    return F.coalesce(F.bit_count(as_long(a).bitwiseXOR(as_long(b))), F.lit(0)).cast("int")
