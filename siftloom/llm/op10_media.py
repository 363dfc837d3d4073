"""Media columns: Netpbm and BMP images as binary columns.

Images are decoded to numpy arrays, resized by exact area averages taken from an integral image, and
written as NPY tiles with difference hashes.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftloom.session import materialize, private, table

#: Width in samples of the images that hold payloads; payloads are multiples of it.
WIDTH = 64
#: Edge of the NPY tile, and the difference hash's grid (rows, columns).
TILE, HASH_GRID = 16, (8, 9)


def encode_pgm(image: np.ndarray) -> bytes:
    """Binary 8-bit PGM of a 2-d uint8 array."""
    height, width = image.shape
    return b"P5\n%d %d\n255\n" % (width, height) + image.astype(np.uint8).tobytes()


def _header(data: bytes, n: int) -> tuple[list[bytes], int]:
    """The first ``n`` fields of a Netpbm image and where the last one ends; comments run from # to the line's end."""
    fields: list[bytes] = []
    at = 0
    while len(fields) < n:
        while data[at : at + 1].isspace():
            at += 1
        if data[at : at + 1] == b"#":
            at = data.index(b"\n", at) + 1
            continue
        end = at
        while end < len(data) and not data[end : end + 1].isspace() and data[end : end + 1] != b"#":
            end += 1
        if end == at:
            raise ValueError("header of a Netpbm image ends early")
        fields.append(data[at:end])
        at = end
    return fields, at


def decode_netpbm(data: bytes) -> np.ndarray:
    """Array of a Netpbm image, plain or binary: bitmaps (P1, P4; black is 0, white 255), grey (P2, P5) in 2-d, colour (P3, P6) in 3-d.

    Samples are 8 bits, or 16 where the largest is over 255; of other largest values than 255 and 65535 they are scaled to those.
    """
    kind = data[:2]
    if kind not in (b"P1", b"P2", b"P3", b"P4", b"P5", b"P6"):
        raise ValueError(f"not a Netpbm image: {kind!r}")
    bitmap, colour = kind in (b"P1", b"P4"), kind in (b"P3", b"P6")
    fields, at = _header(data, 3 if bitmap else 4)
    width, height, most = int(fields[1]), int(fields[2]), 1 if bitmap else int(fields[3])
    if width < 1 or height < 1 or not 0 < most < 65536:
        raise ValueError(f"a Netpbm image of {width} x {height} samples up to {most}")
    n = width * height * (3 if colour else 1)
    if kind == b"P4":
        stride = -(-width // 8)
        rows = np.frombuffer(data, dtype=np.uint8, count=stride * height, offset=at + 1).reshape(height, stride)
        return np.where(np.unpackbits(rows, axis=1)[:, :width], 0, 255).astype(np.uint8)
    if kind in (b"P5", b"P6"):
        samples = np.frombuffer(data, dtype=">u2" if most > 255 else np.uint8, count=n, offset=at + 1)
    else:
        body = re.sub(rb"#[^\n]*", b"", data[at:])
        # the digits of a plain bitmap may stand without space
        words = list(re.sub(rb"\s+", b"", body)[:n].decode("ascii")) if bitmap else body.split()[:n]
        if len(words) < n:
            raise ValueError("a plain Netpbm image ends early")
        samples = np.array(words, dtype=np.int64)
        if samples.min() < 0:
            raise ValueError("a negative sample")
    if samples.max() > most:
        raise ValueError(f"a sample over {most}")
    if bitmap:
        return np.where(samples, 0, 255).astype(np.uint8).reshape(height, width)
    top = 255 if most <= 255 else 65535
    if most != top:
        samples = np.rint(samples.astype(np.float64) * top / most)
    samples = samples if samples.dtype in (np.uint8, np.dtype(">u2")) else samples.astype(np.uint8 if top == 255 else ">u2")
    return samples.reshape((height, width, 3) if colour else (height, width))


def encode_bmp(image: np.ndarray) -> bytes:
    """8-bit grey BMP of a 2-d uint8 array: rows from the bottom up, each padded to four bytes."""
    height, width = image.shape
    stride = (width + 3) // 4 * 4
    rows = np.zeros((height, stride), dtype=np.uint8)
    rows[:, :width] = image[::-1]
    palette = np.zeros((256, 4), dtype=np.uint8)
    palette[:, :3] = np.arange(256, dtype=np.uint8)[:, None]
    start = 14 + 40 + palette.nbytes
    head = struct.pack("<2sIHHI", b"BM", start + rows.nbytes, 0, 0, start)
    info = struct.pack("<IiiHHIIiiII", 40, width, height, 1, 8, 0, rows.nbytes, 2835, 2835, 256, 0)
    return head + info + palette.tobytes() + rows.tobytes()


def decode_bmp(data: bytes) -> np.ndarray:
    """Array of an uncompressed BMP: 2-d for 1, 4 or 8 bits with a grey palette, else 3-d in red, green, blue order; 16 bits are five for each
    colour, scaled to eight, and of 32 bits the last eight are left out."""
    if data[:2] != b"BM":
        raise ValueError("not a BMP")
    (start,) = struct.unpack_from("<I", data, 10)
    size, width, height, _, bits, packing = struct.unpack_from("<IiiHHI", data, 14)
    masks = struct.unpack_from("<III", data, 54) if packing == 3 else None
    plain = packing == 0 or (packing == 3 and (bits, masks) in ((32, (0xFF0000, 0xFF00, 0xFF)), (16, (0x7C00, 0x3E0, 0x1F))))
    if not plain or bits not in (1, 4, 8, 16, 24, 32):
        raise ValueError(f"BMP of {bits} bits, compression {packing}, isn't read")
    if width < 1 or not height:
        raise ValueError(f"a BMP of {width} x {height} samples")
    stride = (width * bits + 31) // 32 * 4
    rows = np.frombuffer(data, dtype=np.uint8, count=stride * abs(height), offset=start).reshape(abs(height), stride)
    rows = rows[::-1] if height > 0 else rows
    if bits in (24, 32):
        return rows[:, : width * bits // 8].reshape(abs(height), width, bits // 8)[:, :, 2::-1]
    if bits == 16:
        packed = np.ascontiguousarray(rows).view("<u2")[:, :width].astype(np.uint32)
        return np.stack([((packed >> s & 31) * 255 + 15) // 31 for s in (10, 5, 0)], axis=2).astype(np.uint8)
    if bits == 8:
        index = rows[:, :width]
    elif bits == 4:
        index = np.stack([rows >> 4, rows & 15], axis=2).reshape(abs(height), -1)[:, :width]
    else:
        index = np.unpackbits(rows, axis=1)[:, :width]
    (used,) = struct.unpack_from("<I", data, 46)
    palette = np.frombuffer(data, dtype=np.uint8, count=4 * (used or 1 << bits), offset=14 + size).reshape(-1, 4)
    if index.max() >= len(palette):
        raise ValueError("a colour that the palette doesn't have")
    if (palette[:, 0] == palette[:, 1]).all() and (palette[:, 1] == palette[:, 2]).all():
        return palette[:, 0][index]
    return palette[:, 2::-1][index]


def decode(data: bytes) -> np.ndarray:
    return decode_bmp(data) if data[:2] == b"BM" else decode_netpbm(data)


def area_resize(image: np.ndarray, rows: int, columns: int) -> np.ndarray:
    """Exact means over a grid of equal areas, as float64; grey of a colour image is the mean of its planes.

    Sums come from an integral image; cells that cut pixels take the cut part of them, by linear
    interpolation of the integral. Samples of 16 bits count as 257ths.
    """
    grey = image.astype(np.float64) if image.ndim == 2 else image.astype(np.float64).mean(axis=2)
    if image.dtype.itemsize == 2:
        grey = grey / 257
    total = np.zeros((grey.shape[0] + 1, grey.shape[1] + 1))
    total[1:, 1:] = grey.cumsum(axis=0).cumsum(axis=1)

    def cut(values: np.ndarray, parts: int) -> np.ndarray:
        edges = np.arange(parts + 1) * ((len(values) - 1) / parts)
        low = np.minimum(edges.astype(int), len(values) - 2)
        share = (edges - low).reshape(-1, *[1] * (values.ndim - 1))
        return values[low] * (1 - share) + values[low + 1] * share

    at = cut(cut(total, rows).T, columns).T
    cell = grey.shape[0] / rows * (grey.shape[1] / columns)
    return (at[1:, 1:] - at[:-1, 1:] - at[1:, :-1] + at[:-1, :-1]) / cell


def difference_hash(image: np.ndarray) -> str:
    """64 bits in hex: whether each cell of the grid is brighter than its right neighbour, by over a millionth."""
    small = area_resize(image, *HASH_GRID)
    return np.packbits(small[:, :-1] > small[:, 1:] + 1e-6).tobytes().hex()


def npy_tile(image: np.ndarray, edge: int = TILE) -> bytes:
    """The image's area-resized uint8 tile as the bytes of an NPY file."""
    out = io.BytesIO()
    np.save(out, np.rint(area_resize(image, edge, edge)).clip(0, 255).astype(np.uint8))
    return out.getvalue()


def payload_image(data: bytes) -> np.ndarray:
    """Bytes, padded with zeros to a positive multiple of WIDTH, as rows of WIDTH samples."""
    size = max(1, -(-len(data) // WIDTH)) * WIDTH
    return np.frombuffer(data.ljust(size, b"\0"), dtype=np.uint8).reshape(-1, WIDTH)


def store_texts(docs: DataFrame, text: str = "text", media: str = "media") -> DataFrame:
    """Adds n_bytes and ``media``: the UTF-8 payload as a grey image, BMP or PGM by the parity of the payload's CRC.

    A null or empty text is a payload of 64 zeros. Equal texts have equal images. Other columns stay,
    but for those named n_bytes and ``media``.
    """

    @F.pandas_udf("n_bytes long, media binary")
    def stored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            raw = [(t or "").encode("utf-8") for t in texts.where(texts.notna(), "")]
            images = [payload_image(x) for x in raw]
            yield pd.DataFrame({"n_bytes": [len(x) for x in raw], "media": [encode_bmp(i) if zlib.crc32(i) % 2 else encode_pgm(i) for i in images]})

    keep = [c for c in docs.columns if c not in ("n_bytes", media)]
    (own,) = private(docs, "_stored")
    return docs.select(*keep, stored(F.col(text)).alias(own)).select(*keep, f"{own}.n_bytes", F.col(f"{own}.media").alias(media))


def media_features(stored: DataFrame, media: str = "media") -> DataFrame:
    """Decodes ``media`` and adds payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, dhash, tile (NPY bytes) and error.

    The payload is the decoded array's bytes in row order. A null image gives nulls; one that can't be read gives its size and hash and says in ``error`` why.
    Columns of those names are replaced.
    """
    made = ("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "dhash", "tile", "error")

    def features(data: bytes | None) -> tuple:
        if data is None:
            return (None,) * len(made)
        data = bytes(data)
        own = len(data), hashlib.sha256(data).hexdigest()
        try:
            image = decode(data)
        except (ValueError, struct.error) as e:  # whatever a damaged image brings
            return (None, None, None, *own, None, None, str(e))
        payload = np.ascontiguousarray(image).tobytes()
        return (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), *own, difference_hash(image), npy_tile(image), None)

    @F.pandas_udf("payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, dhash string, tile binary, error string")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for images in batches:
            yield pd.DataFrame([features(x) for x in images], columns=list(made)).astype({k: "Int64" for k in ("payload_bytes", "tail_crc32", "media_bytes")})

    keep = [c for c in stored.columns if c not in made]
    (own,) = private(stored, "_features")
    return stored.select(*keep, read(F.col(media)).alias(own)).select(*keep, *(F.col(f"{own}.{c}").alias(c) for c in made))


def op10_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    stored = materialize(store_texts(docs).select("doc_id", "n_bytes", "media"), "media")
    return media_features(stored).select(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256",
        F.concat(F.lit("dhash:"), "dhash").alias("feature"), F.sha2("tile", 256).alias("tile_sha256"),
    )


QUERIES = {"op10_media_columns": op10_media_columns}
SQL: dict[str, str] = {}
