import hashlib
import io
import struct
import zlib
from collections import Counter

import numpy as np
import pytest

from lumenlink.llm import common, media, queries


def slow(doc_id, text):
    raw = (text or "").encode()
    payload = raw + b" " * (-len(raw) % 192)
    payload = payload or b" " * 192
    rows = [payload[i : i + 192] for i in range(0, len(payload), 192)]
    if zlib.crc32(payload) % 2:
        upside = b"".join(b"".join(r[i : i + 3][::-1] for i in range(0, 192, 3)) for r in rows[::-1])
        stored = b"BM" + struct.pack("<IHHIIiiHHIIiiII", 54 + len(payload), 0, 0, 54, 40, 64, len(rows), 1, 24, 0, len(payload), 2835, 2835, 0, 0) + upside
    else:
        stored = b"P6\n64 %d\n255\n" % len(rows) + payload
    return doc_id, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(stored), hashlib.sha256(stored).hexdigest(), -(-len(rows) // 64)


def told(r):
    return *tuple(r)[:7], r.n_tiles


def test_query_is_brute_force(spark, sf):
    want = Counter(slow(r.doc_id, r.text) for r in common.table(spark, sf, "documents").collect())
    got = queries.op6_media(spark, sf).collect()
    assert Counter(map(told, got)) == want and len({r.media_bytes - r.payload_bytes for r in got} & {54}) == 1


def test_awkward_rows(awkward, awkward_rows, nothing):
    out = media.text_media(awkward, keep_media=True).collect()
    assert Counter(map(told, out)) == Counter(slow(r[0], r[1]) for r in awkward_rows)
    for r in out:
        image = media.decode(r.media)
        assert hashlib.sha256(r.media).hexdigest() == r.media_sha256 and r.feature.split(":")[0] == media.difference_hash(image)
        assert len(r.tiles) == r.n_tiles and hashlib.sha256(b"".join(r.tiles)).hexdigest() == r.tiles_sha256
        assert (np.concatenate([np.load(io.BytesIO(t)) for t in r.tiles]) == image).all()
    assert media.text_media(nothing).collect() == []


def test_area_means():
    rng = np.random.default_rng(0)
    for h, w, a, b in [(6, 9, 2, 3), (7, 5, 3, 4), (1, 64, 8, 9), (50, 3, 8, 9), (8, 8, 8, 8)]:
        image = rng.integers(0, 256, (h, w, 3), dtype=np.uint8)
        big = image.repeat(a, axis=0).repeat(b, axis=1)
        want = big.reshape(a, h, b, w, 3).mean(axis=(1, 3))
        assert np.allclose(media.area_resize(image, a, b), want)


@pytest.mark.parametrize("shape", [(1, 1, 3), (5, 7, 3), (64, 64, 3), (3, 130, 3)])
def test_round_trips(shape):
    image = np.random.default_rng(1).integers(0, 256, shape, dtype=np.uint8)
    assert (media.decode(media.encode_bmp(image)) == image).all()
    assert (media.decode(media.encode_netpbm(image)) == image).all()
    assert (media.decode(media.encode_netpbm(image[:, :, :1])) == image[:, :, :1]).all()
    tiles = media.npy_tiles(image, 32)
    back = np.concatenate([np.concatenate([np.load(io.BytesIO(t)) for y, _, t in tiles if y == row], axis=1) for row in range(-(-shape[0] // 32))])
    assert (back == image).all() and (media.from_tiles(tiles) == image).all()


def test_plain_and_packed_netpbm():
    assert (media.decode(b"P2 # comment\n3 2\n255\n1 2 3\n4 5 6\n")[:, :, 0] == [[1, 2, 3], [4, 5, 6]]).all()
    assert (media.decode(b"P3\n1 1\n255\n9 8 7\n")[0, 0] == [9, 8, 7]).all()
    assert (media.decode(b"P1\n3 1\n1 0 1\n")[0, :, 0] == [0, 255, 0]).all()
    assert (media.decode(b"P4\n9 1\n" + bytes([0b10100000, 0b10000000]))[0, :, 0] == [0, 255, 0, 255, 255, 255, 255, 255, 0]).all()
    wide = media.decode(b"P5\n2 1\n65535\n" + struct.pack(">HH", 300, 65535))
    assert wide[0, :, 0].tolist() == [300, 65535]


def test_palette_and_top_down_bmp():
    head = struct.pack("<2sIHHIIiiHHIIiiII", b"BM", 0, 0, 0, 62, 40, 3, -2, 1, 1, 0, 0, 0, 0, 2, 0)
    data = head + bytes([1, 2, 3, 0, 9, 8, 7, 0]) + bytes([0b01000000, 0, 0, 0, 0b10100000, 0, 0, 0])
    assert (media.decode(data)[:, :, 0] == [[3, 7, 3], [7, 3, 7]]).all()


def test_bad_images_give_null_tiles(spark, tmp_path):
    good = media.encode_netpbm(np.zeros((70, 70, 3), np.uint8))
    rows = [(1, good), (2, b"junk"), (3, None), (4, b""), (5, b"P6\n9 9\n255\nxx"), (6, b"BM"), (7, b"P5\n0 0\n255\n")]
    df = spark.createDataFrame(rows, "id long, image binary")
    out = media.images_to_tiles(df, "id", "image", 64).collect()
    assert Counter(r.id for r in out) == {1: 4, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1, 7: 1} and all((r.npy is None) == (r.id != 1) for r in out)
    media.write_tiles(df, "id", "image", f"file://{tmp_path}/tiles")
    assert spark.read.parquet(f"file://{tmp_path}/tiles").count() == 10
