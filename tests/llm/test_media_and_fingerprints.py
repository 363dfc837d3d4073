"""Images of every kind and damaged ones, resizing and hashes against plain loops; fingerprints of edited long paragraphs and of the query against sets."""

import hashlib
import io
import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftloom.llm import op7_fingerprints as prints
from siftloom.llm import op10_media as media

SF = "/root/testdata/sf0.001"
R = np.random.default_rng(8)


def bmp(bits, pixels, palette=None, top_down=False, packing=0):
    """A BMP of rows of index or colour values, packed by plain loops."""
    height, width = len(pixels), len(pixels[0])
    rows = []
    for row in pixels if top_down else pixels[::-1]:
        if bits < 8:
            text = "".join(format(int(x), f"0{bits}b") for x in row)
            text += "0" * (-len(text) % 8)
            raw = bytes(int(text[i : i + 8], 2) for i in range(0, len(text), 8))
        elif bits == 8:
            raw = bytes(int(x) for x in row)
        elif bits == 16:
            raw = b"".join(struct.pack("<H", int(r) << 10 | int(g) << 5 | int(b)) for r, g, b in row)
        else:
            raw = b"".join(bytes([int(b), int(g), int(r)]) + b"\xff" * (bits // 8 - 3) for r, g, b in row)
        rows.append(raw + b"\0" * (-len(raw) % 4))
    colours = b"".join(bytes([b, g, r, 0]) for r, g, b in palette or [])
    masks = struct.pack("<III", 0xFF0000, 0xFF00, 0xFF) if packing == 3 else b""
    start = 54 + len(colours) + len(masks)
    body = b"".join(rows)
    return struct.pack("<2sIHHI", b"BM", start + len(body), 0, 0, start) + struct.pack("<IiiHHIIiiII", 40, width, -height if top_down else height, 1, bits, packing, 0, 0, 0, len(palette or []), 0) + masks + colours + body


def test_bmp_kinds():
    grey = [(i * 17,) * 3 for i in range(16)]
    odd = [(i, 255 - i, 7) for i in range(16)]
    for bits in (1, 4, 8):
        index = R.integers(0, min(16, 1 << bits), (5, 13))
        n = min(16, 1 << bits)
        assert (media.decode(bmp(bits, index, grey[:n])) == np.array([g[0] for g in grey])[index]).all()
        assert (media.decode(bmp(bits, index, odd[:n], top_down=True)) == np.array(odd)[index]).all()
    for bits, packing in ((24, 0), (32, 0), (32, 3)):
        pixels = R.integers(0, 256, (4, 7, 3))
        assert (media.decode(bmp(bits, pixels, packing=packing)) == pixels).all()
    five = R.integers(0, 32, (3, 5, 3))
    assert (media.decode(bmp(16, five)) == np.rint(five * 255 / 31)).all()
    image = R.integers(0, 256, (6, 9)).astype(np.uint8)
    assert (media.decode(media.encode_bmp(image)) == image).all()


def test_netpbm_kinds():
    bits = R.integers(0, 2, (3, 11))
    want = np.where(bits, 0, 255)
    assert (media.decode(b"P1 # c\n11 3\n" + b"\n".join("".join(map(str, r)).encode() for r in bits)) == want).all()
    packed = b"".join(bytes([int("".join(map(str, r[:8])), 2), int("".join(map(str, r[8:])) + "00000", 2)]) for r in bits)
    assert (media.decode(b"P4\n11 3\n" + packed) == want).all()
    grey = R.integers(0, 256, (4, 6))
    assert (media.decode(b"P2\n6 4 # w h\n255\n" + b" ".join(str(x).encode() for x in grey.ravel())) == grey).all()
    colour = R.integers(0, 256, (2, 3, 3)).astype(np.uint8)
    assert (media.decode(b"P6 3 2 255\n" + colour.tobytes()) == colour).all() and (media.decode(b"P3 3 2 255 " + b" ".join(str(x).encode() for x in colour.ravel())) == colour).all()
    wide = R.integers(0, 65536, (2, 4)).astype(">u2")
    got = media.decode(b"P5 4 2 65535\n" + wide.tobytes())
    assert (got == wide).all() and (media.decode(b"P5 4 2 15\n" + bytes(range(8))) == np.arange(8).reshape(2, 4) * 17).all()
    assert np.allclose(media.area_resize(got, 2, 4), wide / 257)


def test_resize_and_hash():
    for shape in ((7, 10), (3, 64), (64, 3), (1, 1), (5, 4, 3)):
        image = R.integers(0, 256, shape).astype(np.uint8)
        grey = image.astype(float) if image.ndim == 2 else image.mean(axis=2)
        h, w = grey.shape
        rows, columns = 4, 6
        want = np.zeros((rows, columns))
        for i in range(rows):
            for j in range(columns):
                for y in range(h):
                    for x in range(w):
                        dy = max(0, min(y + 1, (i + 1) * h / rows) - max(y, i * h / rows))
                        dx = max(0, min(x + 1, (j + 1) * w / columns) - max(x, j * w / columns))
                        want[i, j] += grey[y, x] * dy * dx
        assert np.allclose(media.area_resize(image, rows, columns), want / (h / rows * w / columns))
    falling = np.tile(np.arange(90, 0, -1, dtype=np.uint8), (8, 1))
    assert media.difference_hash(falling) == "f" * 16 and media.difference_hash(falling[:, ::-1]) == "0" * 16
    tile = np.load(io.BytesIO(media.npy_tile(falling)))
    assert tile.shape == (16, 16) and tile.dtype == np.uint8 and tile[0, 0] > tile[0, -1]


def test_damaged_images(spark):
    good = media.encode_pgm(np.full((2, 64), 7, dtype=np.uint8))
    rows = [(0, good), (1, None), (2, b""), (3, b"P5\n64"), (4, good[:-1]), (5, b"BM"), (6, b"P7 x"), (7, b"P5 0 3 255\n"), (8, b"P2 1 1 9 10"), (9, b"P2 1 1 9 -1"), (10, b"P5 a b c\n"), (11, bmp(8, [[3]], [(0, 0, 0)])), (12, bmp(24, [[(1, 2, 3)]])[:-9]), (13, b"P2 2 2 9 1 x 3 4"), (14, b"# no end")]
    df = spark.createDataFrame([(i, None if x is None else bytearray(x), "mine") for i, x in rows], "i int, media binary, error string")
    got = {r.i: r for r in media.media_features(df).collect()}
    assert len(got) == len(rows) and got[0].error is None and got[0].payload_bytes == 128 and got[1].media_bytes is None and got[1].error is None
    assert all(got[i].error and got[i].payload_sha256 is None and got[i].dhash is None and got[i].media_bytes == len(x) for i, x in rows[2:])


def test_media_query(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    kinds = set()
    for r in media.op10_media_columns(spark, SF).collect():
        raw = texts[r.doc_id].encode()
        payload = raw.ljust(max(1, -(-len(raw) // 64)) * 64, b"\0")
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        kinds.add(r.media_bytes - len(payload) > 1000)
    assert kinds == {True, False}


def test_words_put_into_a_long_paragraph():
    r = random.Random(1)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 9))) for _ in range(400)]
    text = " ".join(words)
    for changed in ("first " + text, " ".join([*words[:200], "middle", *words[200:]]), text + " last", " ".join(words[3:])):
        near = prints.likeness([prints.digests(text)], [prints.digests(changed)])[0]
        assert near >= 0.8
    assert prints.likeness([prints.digests(text)], [prints.digests(text.replace(" ", "  "))])[0] < 1
    spaced = [p for p in prints.paragraphs("a  b\tc " * 60)]
    assert "".join("".join(spaced).split()) == "abc" * 60 and "a  b\tc" in spaced[0]


def test_fingerprint_query(spark):
    docs = sorted(((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()), reverse=True)
    got = {r.doc_id: r for r in prints.op7_fingerprints(spark, SF).collect()}

    def like(a, b):
        x, y = set(prints.digests(a).tolist()), set(prints.digests(b).tolist())
        return len(x & y) / len(x | y) if x | y else 1.0

    for i, (d, t) in enumerate(docs):
        after = docs[(i + 1) % len(docs)][1]
        k = len(t) // 3
        edited = t[: len(t) - k] + after[:k]
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == pytest.approx(like(t, edited)) and r.near_next == pytest.approx(like(t, after))
        own, new = prints.fingerprints([prints.digests(t), prints.digests(edited)])
        assert (r.fingerprint, r.edited_fingerprint) == (own, new)
