"""Media columns: payloads stored as lossless WebP pictures, read back, and described by features of their pixels.

A payload is the text's UTF-8 bytes, filled up with bytes 255 to a positive multiple of 576. A picture row is 192 opaque
pixels of three bytes, so a payload is a whole number of rows; every `PICTURE_ROWS` rows are a WebP file, the payload's
files follow one another, and texts of any length are stored whole. Files are made and read by `webp_batch`, many at once.

Null text is an empty payload of 576 bytes 255; ids may be null or repeat; repeated texts give equal values; an empty
table gives an empty table; further input columns are ignored. The work is per row: no shuffle, and a task holds one row's
bytes, or a slice of shorter ones, and the arrays of `BATCH_PIXELS` pixels at a time.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame

from . import webp, webp_batch
from .common import pick, utf8

UNIT, ROW_PIXELS = 576, 192
PICTURE_ROWS = webp_batch.MOST_PIXELS // ROW_PIXELS
#: Pixels, and pictures, that are coded together at most, and bytes of texts from which batches are made.
BATCH_PIXELS, BATCH_PICTURES, SLICE_BYTES = 500_000, 2000, 8 << 20


def padded(data: bytes) -> bytes:
    return data + b"\xff" * (UNIT - len(data) % UNIT if len(data) % UNIT or not data else 0)


def in_batches(items: list, pixels: list[int], work: Callable[[list], list]) -> list:
    """`work` of the items in groups of bounded size. Pictures of like size go together, as they take as many steps."""
    out: list = [None] * len(items)
    group, held = [], 0

    def finish() -> None:
        for k, made in zip(group, work([items[k] for k in group]), strict=True):
            out[k] = made

    for k in sorted(range(len(items)), key=pixels.__getitem__):
        if group and (held + pixels[k] > BATCH_PIXELS or len(group) == BATCH_PICTURES):
            finish()
            group, held = [], 0
        group.append(k)
        held += pixels[k]
    if group:
        finish()
    return out


def to_media(payloads: list[bytes]) -> list[bytes]:
    """Payloads, whole rows long, as WebP files."""
    rows = [np.frombuffer(p, np.uint8).reshape(-1, ROW_PIXELS, 3) for p in payloads]
    every = [r[y : y + PICTURE_ROWS] for r in rows for y in range(0, len(r), PICTURE_ROWS)]
    made = iter(in_batches(every, [len(p) * ROW_PIXELS for p in every], webp_batch.encode_many))
    return [b"".join(next(made) for _ in range(0, len(r), PICTURE_ROWS)) for r in rows]


def from_media(media: list[bytes]) -> list[np.ndarray]:
    """The pixel arrays (rows, 192, 3) of stored files."""
    streams = [webp.streams(m) for m in media]
    every = [s for own in streams for s in own]
    read = iter(in_batches(every, [webp.pixels_of(s) for s in every], webp_batch.decode_many))
    return [np.concatenate([next(read)[:, :, 1:] for _ in own]) for own in streams]


def features(pixels: np.ndarray) -> str:
    """Size, mean of each channel in thousandths, and the shares of 16 brightness classes in per mille, in hex."""
    n = pixels.size // 3
    means = pixels.reshape(-1, 3).sum(axis=0, dtype=np.int64) * 1000 // n
    classes = np.bincount(pixels.reshape(-1) >> 4, minlength=16) * 1000 // (3 * n)
    return f"{pixels.shape[1]}x{pixels.shape[0]};" + ",".join(map(str, means)) + ";" + "".join(f"{c:03x}" for c in classes)


def groups_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows again, in slices of `SLICE_BYTES` or of one longer text."""
    for batch in batches:
        first, size = 0, 0
        for k, n in enumerate(pa.compute.binary_length(batch.column(1)).fill_null(0).to_pylist()):
            if k > first and size + n > SLICE_BYTES:
                yield batch.slice(first, k - first)
                first, size = k, 0
            size += max(n, UNIT)
        yield batch.slice(first)


def media_columns(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep_media: bool = False, keep_pixels: bool = False) -> DataFrame:
    """Sizes, hashes and features of each stored text; `media` and `pixels` (row-major bytes) on request."""
    rows = pick(docs, doc_id=id_col, text=text_col)
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    extra = ["media"] * keep_media + ["pixels"] * keep_pixels

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups_of(batches):
            made = []
            texts = list(utf8(batch, "text"))
            stored = to_media([padded(text) for text in texts])
            for text, media, pixels in zip(texts, stored, from_media(stored), strict=True):
                payload = pixels.tobytes()
                made.append((len(text), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest(), features(pixels), *[media] * keep_media, *[payload] * keep_pixels))
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), *[pa.binary()] * len(extra)]
            columns = list(zip(*made, strict=True)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]], names + extra)

    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return rows.mapInArrow(store, schema + "".join(f", {c} binary" for c in extra))
