"""Media columns: interleaved document sequences with payloads resolved by digest.

``interleaved`` parses HTML into an ordered array of text and media-reference structs; a reference keeps its
position and caption.  ``stored`` writes payloads losslessly as 8-bit grey PNG images of 64 samples a row, keyed by the
digest of the stored form; ``resolved`` joins references with what is read back from that table.

Defined cases: a null or empty text is a payload of 64 zero bytes with ``n_bytes`` 0; null or broken HTML is an empty
or best-effort sequence; a reference without a stored payload keeps null media columns; null ids pass
through; repeated rows stay, and equal payloads share one digest, whose features are kept once; an empty table gives
an empty result; extra columns are ignored.  Payloads are never shuffled: only digests and features are joined.
"""

from __future__ import annotations

import hashlib
import html as _html
import struct
import zlib
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, written

WIDTH = 64
_MAGIC = b"\x89PNG\r\n\x1a\n"
_SCHEME = "sha256:"


# --- stored form -------------------------------------------------------------------------------------------


def padded(data: bytes) -> bytes:
    return data + bytes(-len(data) % WIDTH or (0 if data else WIDTH))


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_png(payload: bytes) -> bytes:
    """``payload`` (a positive multiple of 64 bytes) as a grey image, one sample a byte."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    raw = np.zeros((len(rows), WIDTH + 1), np.uint8)  # the first byte of a row names its filter: none
    raw[:, 1:] = rows
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return _MAGIC + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(raw.tobytes(), 6)) + _chunk(b"IEND", b"")


def from_png(data: bytes) -> np.ndarray:
    """The samples of an image that ``to_png`` wrote, rows by 64; raises on a damaged one."""
    if data[:8] != _MAGIC:
        raise ValueError("not a PNG image")
    at, body, size = 8, [], None
    while at < len(data):
        (n,) = struct.unpack_from(">I", data, at)
        kind, part = data[at + 4 : at + 8], data[at + 8 : at + 8 + n]
        if zlib.crc32(kind + part) != struct.unpack_from(">I", data, at + 8 + n)[0]:
            raise ValueError("damaged image")
        if kind == b"IHDR":
            size = struct.unpack(">IIBBBBB", part)
        elif kind == b"IDAT":
            body.append(part)
        at += 12 + n
    if size is None or size[0] != WIDTH or size[2:] != (8, 0, 0, 0, 0):
        raise ValueError("not an image of this form")
    raw = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(size[1], WIDTH + 1)
    if raw[:, 0].any():
        raise ValueError("row filters are not used in this form")
    return raw[:, 1:]


def feature(samples: np.ndarray) -> str:
    """Mean and deviation of the samples, and an average hash over 8 by 8 cells."""
    bands = np.array_split(np.arange(len(samples)), 8)
    cells = np.array([samples[b].mean(0).reshape(8, 8).mean(1) if len(b) else np.zeros(8) for b in bands])
    bits = (cells > cells.mean()).ravel()
    code = int("".join("01"[int(x)] for x in bits), 2)
    return f"{samples.mean():.4f}:{samples.std():.4f}:{code:016x}"


# --- interleaved sequences ---------------------------------------------------------------------------------

SEQUENCE = "array<struct<position:int,kind:string,text:string,ref:string,caption:string>>"
_SKIP = {"script", "style", "noscript", "template", "head"}
_BLOCK = {
    "p", "div", "article", "section", "figure", "figcaption", "ul", "ol", "li", "table", "tr", "td", "th", "nav",
    "h1", "h2", "h3", "h4", "h5", "h6", "br", "hr", "header", "footer", "main", "aside", "blockquote", "pre", "body",
}
_MEDIA = {"img", "video", "audio", "source", "embed", "iframe"}


class _Sequence(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.items: list[dict] = []
        self.text: list[str] = []
        self.skip = 0
        self.head = False
        self.figures: list[int] = []
        self.caption: list[str] | None = None

    def flush(self):
        text = " ".join("".join(self.text).split())
        self.text = []
        if text:
            self.items.append({"kind": "text", "text": text, "ref": None, "caption": None})

    def handle_starttag(self, tag, attrs):
        if tag == "head":
            self.head = True
        elif tag in _SKIP:
            self.skip += 1
        elif tag == "body" or tag in _BLOCK or tag in _MEDIA:
            self.head = self.head and self.skip > 0  # a head may end without a tag
        if tag in _BLOCK:
            self.flush()
        if tag == "figure":
            self.figures.append(len(self.items))
        if tag == "figcaption":
            self.caption = []
        a = dict(attrs)
        if tag in _MEDIA and a.get("src") and not self.skip and not self.head:
            self.flush()
            self.items.append({"kind": "media", "text": None, "ref": a["src"], "caption": a.get("alt") or None})

    def handle_startendtag(self, tag, attrs):
        if tag not in _SKIP:  # nothing is inside
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag == "head":
            self.head = False
        elif tag in _SKIP and self.skip:
            self.skip -= 1
        if tag == "figcaption" and self.caption is not None:
            caption, self.caption = " ".join("".join(self.caption).split()), None
            for x in self.items[self.figures[-1] if self.figures else len(self.items) :]:
                if x["kind"] == "media" and caption:
                    x["caption"] = caption
        if tag in _BLOCK:
            self.flush()
        if tag == "figure" and self.figures:
            self.figures.pop()

    def handle_data(self, data):
        if self.skip or self.head:
            return
        (self.text if self.caption is None else self.caption).append(data)


def sequence(markup: str | None) -> list[dict]:
    """Ordered text and media structs of a page; positions count from 0."""
    p = _Sequence()
    p.feed(markup or "")
    p.close()
    p.flush()
    return [{"position": i, **x} for i, x in enumerate(p.items)]


_SEQUENCE_PA = pa.list_(
    pa.struct([("position", pa.int32()), *((c, pa.string()) for c in ("kind", "text", "ref", "caption"))])
)


def interleaved(pages: DataFrame, id_col: str = "page_id", html: str = "html") -> DataFrame:
    """One row a page: its id and ``sequence``."""
    small_batches(pages.sparkSession)
    only = pages.select(F.col(f"`{id_col}`"), F.col(f"`{html}`"))

    def run(batches):
        for b in batches:
            rows = [sequence(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, _SEQUENCE_PA)], [id_col, "sequence"])

    kind = only.schema[0].dataType.simpleString()
    return only.mapInArrow(run, f"`{id_col}` {kind}, sequence {SEQUENCE}")


def references(sequences: DataFrame, id_col: str) -> DataFrame:
    """One row a media reference: id, position, caption, digest (null for references of other schemes)."""
    items = sequences.select(F.col(f"`{id_col}`"), F.explode("sequence").alias("x")).where("x.kind = 'media'")
    digest = F.when(F.startswith("x.ref", F.lit(_SCHEME)), F.expr(f"substring(x.ref, {len(_SCHEME) + 1})"))
    return items.select(F.col(f"`{id_col}`"), "x.position", "x.caption", digest.alias("digest"))


FEATURES = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def _features(batches):
    for b in batches:
        rows = []
        for media in b.column(1).to_pylist():
            samples = from_png(media)
            payload = samples.tobytes()
            rows.append((
                len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media),
                hashlib.sha256(media).hexdigest(), feature(samples),
            ))
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
        cols = list(zip(*rows)) if rows else [[]] * 6
        names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))], ["digest", *names]
        )


def resolved(refs: DataFrame, media: DataFrame) -> DataFrame:
    """``refs`` with the features of the payloads that ``media`` (digest, media) stores; unresolved ones keep nulls."""
    small_batches(media.sparkSession)
    read = media.select("digest", "media").mapInArrow(_features, f"digest string, {FEATURES}")
    return refs.join(read.dropDuplicates(["digest"]), "digest", "left")


def _pages(batches):
    """Texts to pages that show the text's payload, and the payloads' stored forms."""
    for b in batches:
        out = []
        for text in b.column(1).to_pylist():
            data = (text or "").encode("utf-8", "surrogatepass")
            media = to_png(padded(data))
            digest = hashlib.sha256(media).hexdigest()
            caption = _html.escape(f"{len(data)} bytes")
            page = f'<article><figure><img src="{_SCHEME}{digest}"><figcaption>{caption}</figcaption></figure></article>'
            out.append((len(data), page, digest, media))
        kinds = (pa.int64(), pa.string(), pa.string(), pa.binary())
        cols = list(zip(*out)) if out else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))],
            ["doc_id", "n_bytes", "html", "digest", "media"],
        )


def text_media(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Stores every text as media, then resolves each document's reference from the stored table."""
    small_batches(docs.sparkSession)
    only = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = only.schema["doc_id"].dataType.simpleString()
    pages = only.mapInArrow(_pages, f"doc_id {kind}, n_bytes long, html string, digest string, media binary")
    store = written(pages, "media")
    # a row is a page: ids may repeat or be null, so sequence and size travel together
    rows = store.select(F.struct("doc_id", "n_bytes").alias("row"), "html")
    refs = references(interleaved(rows, "row", "html"), "row")
    names = [x.split()[0] for x in FEATURES.split(", ")]
    return resolved(refs, store).select("row.doc_id", "row.n_bytes", *names, "caption", "position")
