import hashlib
import zlib

import numpy as np
import pytest

from lexmill.llm import media
from tests.llm import cases


@pytest.mark.parametrize("compression", [media.STORED, media.LZW, media.DEFLATE, media.PACKBITS])
@pytest.mark.parametrize("predictor", [1, 2])
@pytest.mark.parametrize("tile,big", [(0, False), (16, True)])
def test_round_trip(compression, predictor, tile, big):
    rng = np.random.default_rng(1)
    pages = [rng.integers(0, 4, (37, 50), np.uint8), rng.integers(0, 60000, (20, 33, 3)).astype(np.uint16), np.zeros((300, 70), np.uint8)]
    blob = media.write_tiff(pages, compression, predictor, rows_per_strip=7, tile=tile, big_endian=big)
    got = [p for p, _ in media.pages(blob)]
    assert len(got) == 3
    for a, b in zip(pages, got):
        assert np.array_equal(a.reshape(b.shape), b)


@pytest.mark.parametrize("data", [b"", b"a", b"aaaa" * 100, bytes(range(256)) * 40, b"abcabcabd" * 2000])
def test_codecs(data):
    assert media.unpack_bits(media.pack_bits(data)) == data
    assert media.lzw_decode(media.lzw_encode(data)) == data


def by_hand(width, height, compression, strip, order="<", rows=None, count=None):
    """A one-page TIFF written field by field."""
    import struct

    fields = [(256, 3, width), (257, 3, height), (258, 3, 8), (259, 3, compression), (262, 3, 1), (273, 4, 8), (277, 3, 1), (278, 3, rows or height), (279, 4, len(strip) if count is None else count)]
    if width > 65535:
        fields = [(t, 4 if t in (256, 257, 278) else k, v) for t, k, v in fields]
    body = strip + b"\0" * (len(strip) & 1)
    entries = b"".join(struct.pack(order + "HHI", t, k, 1) + (struct.pack(order + "HH", v, 0) if k == 3 else struct.pack(order + "I", v)) for t, k, v in fields)
    return (b"II*\0" if order == "<" else b"MM\0*") + struct.pack(order + "I", 8 + len(body)) + body + struct.pack(order + "H", len(fields)) + entries + b"\0" * 4


@pytest.mark.parametrize("order", "<>")
def test_files_written_by_hand(order):
    # the published examples of PackBits and of LZW
    packed = bytes.fromhex("FEAA0280002AFDAA0380002A22F7AA")
    plain = bytes.fromhex("AAAAAA80002AAAAAAAAA80002A22" + "AA" * 10)
    ((page, _),) = media.pages(by_hand(24, 1, media.PACKBITS, packed, order))
    assert page.tobytes() == plain
    bits = "".join(f"{code:09b}" for code in (256, 7, 258, 8, 8, 258, 6, 6, 257))
    strip = int(bits.ljust(-(-len(bits) // 8) * 8, "0"), 2).to_bytes(-(-len(bits) // 8), "big")
    ((page, _),) = media.pages(by_hand(3, 3, media.LZW, strip, order))
    assert page.tobytes() == bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])


def test_files_that_claim_too_much(spark):
    huge = by_hand(4_194_304, 4_194_304, media.STORED, b"abcd")
    bomb = by_hand(1000, 1, media.DEFLATE, zlib.compress(bytes(50_000_000)))
    lies = by_hand(60_000, 60_000, media.LZW, b"ab", count=4_000_000_000)
    wrong = bytearray(zlib.compress(b"x" * 100))
    wrong[-1] ^= 1  # a checksum that does not hold
    df = spark.createDataFrame([(1, huge), (2, bomb), (3, lies), (4, by_hand(100, 1, media.DEFLATE, bytes(wrong)))], "id long, media binary")
    got = {r.id: r for r in media.tiff_pages(df).collect()}
    assert len(got) == 4 and all(got[k].error and got[k].samples is None for k in (1, 3, 4))
    assert got[2].error is None and got[2].samples == bytes(1000)


def test_planar_pages():
    page = np.arange(2 * 6 * 5, dtype=np.uint8).reshape(2, 6, 5)
    blob = media.write_tiff([page.reshape(12, 5)], media.STORED, 1, rows_per_strip=6)
    tags = next(media.directories(blob)) | {media.HEIGHT: [6], media.SAMPLES: [2], media.PLANAR: [2]}
    assert np.array_equal(media.read_page(blob, tags), np.moveaxis(page, 0, -1))


def test_pages_operator(spark):
    two = media.write_tiff([np.ones((3, 4), np.uint8), np.zeros((2, 2), np.uint8)])
    rows = [(1, two), (2, None), (3, b""), (4, b"not a tiff"), (5, two[:40]), (1, two)]
    df = spark.createDataFrame(rows, "id long, media binary").selectExpr("*", "1 AS page", "2 AS key")
    got = media.tiff_pages(df).collect()
    assert sorted((r.id, r.page) for r in got) == [(1, 0), (1, 0), (1, 1), (1, 1), (4, -1), (5, -1)]
    assert all(r.error for r in got if r.page == -1)
    assert media.tiff_pages(df.limit(0)).count() == 0


def test_a_failing_page_keeps_the_others(spark):
    import numpy as np

    planes = [np.full((4, 5), k, np.uint8) for k in range(10)]
    blob = bytearray(media.write_tiff(planes))
    tags = list(media.directories(bytes(blob)))
    blob[tags[6][media.STRIP_OFFSETS][0]] ^= 0xFF  # the strip is no deflate stream any more
    lost = bytes(blob[: tags[9][media.STRIP_OFFSETS][0]])  # the last page and its directory are cut off
    df = spark.createDataFrame([(1, bytes(blob)), (2, lost)], "id long, media binary")
    got = {(r.id, r.page): r for r in media.tiff_pages(df).collect()}
    assert set(got) == {(1, k) for k in range(10)} | {(2, k) for k in (*range(9), -1)}
    assert {k for k, r in got.items() if r.error} == {(1, 6), (2, 6), (2, -1)}
    assert all(r.samples == bytes([r.page]) * 20 for r in got.values() if not r.error)


def test_digests(spark):
    df = cases.frame(spark, [*cases.texts(), "y" * 3_000_000])
    for r, d in zip(sorted(media.digests(df).collect(), key=lambda r: r.doc_id), sorted(df.collect(), key=lambda r: r.doc_id)):
        b = (d.text or "").encode()
        padded = b.ljust(max(1, -(-len(b) // 576)) * 576, b"\xff")
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(b), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-32:]))
    assert media.digests(cases.empty(spark)).count() == 0
