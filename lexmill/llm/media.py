"""Operator 10, media columns: TIFF files in a binary column become one row per page.

`tiff_pages` walks the image directories of each file, decodes its strips or tiles (stored,
PackBits, LZW or deflate), undoes the horizontal predictor and emits one row per page.
`write_tiff` is the inverse that queries and tests use. Everything is per row: no shuffle, and a
task holds one file at a time.

A page is allocated only if its strips or tiles can hold so many samples, and none is decoded beyond
its own size, so a damaged file costs no more memory than its bytes allow.

Defined results: a null or empty file gives no page; a page that cannot be decoded gives a row with
the reason in `error`, and directories that cannot be read any further one with page -1; repeated rows give repeated pages; the caller's
other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import struct
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.tables import as_bytes

#: Tag numbers, field types and compression schemes of TIFF 6.0 (fixed values).
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC = 256, 257, 258, 259, 262
STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_COUNTS, PLANAR = 273, 277, 278, 279, 284
PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS = 317, 322, 323, 324, 325
STORED, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
FIELD = {1: "B", 3: "H", 4: "I"}
#: Codes of 12 bits, and bytes that a byte of each scheme can stand for at most.
LZW_CODES = 4096
EXPANSION = {STORED: 1, PACKBITS: 64, LZW: LZW_CODES, DEFLATE: 1032, OLD_DEFLATE: 1032}

PAGE_SCHEMA = "width int, height int, samples_per_pixel int, bits int, compression int, samples binary, error string"


# --- codecs -------------------------------------------------------------------------------------


def unpack_bits(data: bytes, most: int = sys.maxsize) -> bytes:
    out, i, size = [], 0, 0
    while i < len(data) and size < most:
        n = data[i]
        size += n + 1 if n < 128 else (257 - n) % 129
        if n < 128:
            out.append(data[i + 1 : i + 2 + n])
            i += n + 2
        elif n > 128:
            out.append(data[i + 1 : i + 2] * (257 - n))
            i += 2
        else:
            i += 1
    return b"".join(out)


def pack_bits(data: bytes) -> bytes:
    """Runs of three or more equal bytes are repeated; the rest is literal."""
    a = np.frombuffer(data, np.uint8)
    if not len(a):
        return b""
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(a)) + 1, [len(a)]])
    out, literal = [], 0
    for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if e - s < 3:
            continue
        for k in range(literal, s, 128):
            part = data[k : min(k + 128, s)]
            out.append(bytes([len(part) - 1]) + part)
        for k in range(s, e, 128):
            n = min(128, e - k)
            out.append(bytes([257 - n, data[k]]) if n > 1 else bytes([0, data[k]]))
        literal = e
    for k in range(literal, len(data), 128):
        part = data[k : k + 128]
        out.append(bytes([len(part) - 1]) + part)
    return b"".join(out)


def lzw_decode(data: bytes, most: int = sys.maxsize) -> bytes:
    """MSB-first codes of 9 to 12 bits; 256 clears, 257 ends; the width grows one code early."""
    out: list[bytes] = []
    table: list[bytes] = []
    width, have, bits, last, size = 9, 0, 0, b"", 0
    roots = [bytes([k]) for k in range(256)] + [b"", b""]
    for byte in data:
        bits = (bits << 8) | byte
        have += 8
        if have < width:
            continue
        have -= width
        code = bits >> have
        bits &= (1 << have) - 1
        if code == 257:
            break
        if code == 256:
            table, width, last = roots.copy(), 9, b""
            continue
        if not table:
            raise ValueError("LZW data has no clear code")
        if code < len(table):
            entry = table[code]
        elif code == len(table) and last:
            entry = last + last[:1]
        else:
            raise ValueError("LZW code out of range")
        out.append(entry)
        size += len(entry)
        if size >= most:
            break
        if last and len(table) < LZW_CODES:
            table.append(last + entry[:1])
            width = min(12, (len(table) + 1).bit_length())
        last = entry
    return b"".join(out)


def lzw_encode(data: bytes) -> bytes:
    out = bits = have = 0
    done = bytearray()
    table: dict[bytes, int] = {}

    def put(code: int, width: int) -> None:
        nonlocal bits, have
        bits = (bits << width) | code
        have += width
        while have >= 8:
            have -= 8
            done.append(bits >> have)
            bits &= (1 << have) - 1

    width, following = 9, 258
    put(256, width)
    table = {bytes([k]): k for k in range(256)}
    prefix = b""
    for k in range(len(data)):
        longer = prefix + data[k : k + 1]
        if longer in table:
            prefix = longer
            continue
        put(table[prefix], width)
        table[longer] = following
        following += 1
        prefix = data[k : k + 1]
        if following >= 4094:
            put(256, width)
            table, width, following = {bytes([k]): k for k in range(256)}, 9, 258
        else:
            width = min(12, following.bit_length())
    if prefix:
        put(table[prefix], width)
        following += 1
        width = min(12, following.bit_length())
    put(257, width)
    if have:
        done.append((bits << (8 - have)) & 255)
    return bytes(done)


def inflate(data: bytes, most: int) -> bytes:
    return zlib.decompressobj().decompress(data, most + 1)  # one more, so that a stream of that size ends and is checked


def as_stored(data: bytes, most: int) -> bytes:
    return data[:most]


#: Each takes a strip or tile and the bytes that it should give at most (a few more may come).
DECODERS = {STORED: as_stored, LZW: lzw_decode, DEFLATE: inflate, OLD_DEFLATE: inflate, PACKBITS: unpack_bits}
ENCODERS = {STORED: bytes, LZW: lzw_encode, DEFLATE: lambda b: zlib.compress(b, 1), PACKBITS: pack_bits}


# --- reading ------------------------------------------------------------------------------------


def directories(blob: bytes) -> Iterator[dict[int, list[int]]]:
    """The integer fields of each image directory, in file order."""
    order = {b"II": "<", b"MM": ">"}.get(blob[:2])
    if order is None or len(blob) < 8 or struct.unpack(order + "H", blob[2:4])[0] != 42:
        raise ValueError("not a TIFF")
    at, seen = struct.unpack(order + "I", blob[4:8])[0], set()
    while at:
        if at in seen:
            raise ValueError("image directories form a loop")
        seen.add(at)
        (n,) = struct.unpack_from(order + "H", blob, at)
        fields = {}
        for k in range(n):
            tag, kind, count = struct.unpack_from(order + "HHI", blob, at + 2 + 12 * k)
            if kind not in FIELD:
                continue
            form = f"{order}{count}{FIELD[kind]}"
            place = at + 10 + 12 * k
            if struct.calcsize(form) > 4:
                (place,) = struct.unpack_from(order + "I", blob, place)
            fields[tag] = list(struct.unpack_from(form, blob, place))
        fields[-1] = [int(order == ">")]
        yield fields
        (at,) = struct.unpack_from(order + "I", blob, at + 2 + 12 * n)


def read_page(blob: bytes, tags: dict[int, list[int]]) -> np.ndarray:
    """The samples of one page as (height, width, samples per pixel)."""
    one = lambda tag, default: tags.get(tag, [default])[0]
    width, height, bits, spp = one(WIDTH, 0), one(HEIGHT, 0), one(BITS, 8), one(SAMPLES, 1)
    scheme, predictor, planar = one(COMPRESSION, STORED), one(PREDICTOR, 1), one(PLANAR, 1)
    if scheme not in DECODERS or bits not in (8, 16) or predictor not in (1, 2):
        raise ValueError(f"unsupported: compression {scheme}, {bits} bits, predictor {predictor}")
    kind = np.dtype(np.uint8 if bits == 8 else (">u2" if tags[-1][0] else "<u2"))
    tiled = TILE_OFFSETS in tags
    offsets, counts = (tags[TILE_OFFSETS], tags[TILE_COUNTS]) if tiled else (tags[STRIP_OFFSETS], tags[STRIP_COUNTS])
    tall = one(TILE_HEIGHT, 0) if tiled else min(one(ROWS_PER_STRIP, height), height)
    wide = one(TILE_WIDTH, 0) if tiled else width
    if not (width and height and tall and wide):
        raise ValueError("empty page")
    down, across = -(-height // tall), -(-width // wide)
    planes, deep = (spp, 1) if planar == 2 else (1, spp)
    if len(offsets) < planes * down * across:
        raise ValueError("too few strips or tiles")
    if height * width * spp * kind.itemsize > EXPANSION[scheme] * min(sum(counts), len(counts) * len(blob)):
        raise ValueError("more samples than the data can hold")
    page = np.zeros((height, width, spp), kind)
    for k in range(planes * down * across):
        plane, rest = divmod(k, down * across)
        y, x = rest // across * tall, rest % across * wide
        rows = tall if tiled else min(tall, height - y)
        need = rows * wide * deep * kind.itemsize
        data = DECODERS[scheme](blob[offsets[k] : offsets[k] + counts[k]], need)
        if len(data) < need:
            raise ValueError("short strip or tile")
        part = np.frombuffer(data[:need], kind).reshape(rows, wide, deep)
        if predictor == 2:
            part = np.cumsum(part, axis=1, dtype=kind.newbyteorder("="))
        h, w = min(rows, height - y), min(wide, width - x)
        page[y : y + h, x : x + w, slice(plane, plane + 1) if planar == 2 else slice(None)] = part[:h, :w]
    return page


def pages(blob: bytes) -> Iterator[tuple[np.ndarray, int]]:
    """The samples and compression scheme of each page."""
    for tags in directories(blob):
        yield read_page(blob, tags), tags.get(COMPRESSION, [STORED])[0]


#: What damaged or unsupported files raise.
ERRORS = (ValueError, KeyError, IndexError, MemoryError, OverflowError, struct.error, zlib.error)


def page_rows(blob: bytes) -> Iterator[tuple[int, np.ndarray | None, int | None, str | None]]:
    """(page, samples, compression scheme, error) of each page; a page that fails has its error alone,
    page -1 says that the directories cannot be read any further."""
    walk, n = directories(blob), 0
    while True:
        try:
            tags = next(walk, None)
        except ERRORS as e:
            yield -1, None, None, str(e)[:200] or type(e).__name__
            return
        if tags is None:
            return
        try:
            row = n, read_page(blob, tags), tags.get(COMPRESSION, [STORED])[0], None
        except ERRORS as e:
            row = n, None, None, str(e)[:200] or type(e).__name__
        yield row
        n += 1


# --- writing ------------------------------------------------------------------------------------


def write_tiff(planes: list[np.ndarray], compression: int = DEFLATE, predictor: int = 2, rows_per_strip: int = 114, tile: int = 0, big_endian: bool = False) -> bytes:
    """8- or 16-bit pages of (height, width) or (height, width, samples), in strips or square tiles."""
    order = ">" if big_endian else "<"
    body, at, link = [(b"MM\0*" if big_endian else b"II*\0") + b"\0\0\0\0"], 8, 4
    links: list[tuple[int, int]] = []
    for page in planes:
        page = page.reshape(*page.shape[:2], -1)
        height, width, spp = page.shape
        kind = page.dtype.newbyteorder(order)
        step_y, step_x = (tile, tile) if tile else (min(rows_per_strip, height), width)
        offsets, counts = [], []
        for y in range(0, height, step_y):
            for x in range(0, width, step_x):
                part = page[y : y + step_y, x : x + step_x]
                if tile:
                    part = np.pad(part, ((0, tile - part.shape[0]), (0, tile - part.shape[1]), (0, 0)))
                if predictor == 2:
                    part = np.concatenate([part[:, :1], np.diff(part, axis=1)], axis=1)
                data = ENCODERS[compression](part.astype(kind).tobytes())
                offsets.append(at)
                counts.append(len(data))
                data += b"\0" * (len(data) & 1)
                body.append(data)
                at += len(data)
        bits = page.dtype.itemsize * 8
        fields = {WIDTH: [width], HEIGHT: [height], BITS: [bits] * spp, COMPRESSION: [compression], PHOTOMETRIC: [1 if spp < 3 else 2], SAMPLES: [spp], PLANAR: [1], PREDICTOR: [predictor]}
        fields |= {TILE_WIDTH: [tile], TILE_HEIGHT: [tile], TILE_OFFSETS: offsets, TILE_COUNTS: counts} if tile else {STRIP_OFFSETS: offsets, ROWS_PER_STRIP: [step_y], STRIP_COUNTS: counts}
        entries = b""
        for tag, values in sorted(fields.items()):
            data = struct.pack(f"{order}{len(values)}I", *values)
            if len(data) > 4:
                body.append(data)
                data, at = struct.pack(order + "I", at), at + len(data)
            entries += struct.pack(order + "HHI", tag, 4, len(values)) + data
        links.append((link, at))
        directory = struct.pack(order + "H", len(fields)) + entries + b"\0\0\0\0"
        body.append(directory)
        link = at + len(directory) - 4
        at += len(directory)
    out = bytearray(b"".join(body))
    for place, target in links:
        struct.pack_into(order + "I", out, place, target)
    return bytes(out)


# --- operator -----------------------------------------------------------------------------------


def tiff_pages(df: DataFrame, key: str = "id", blob: str = "media") -> DataFrame:
    """(key, page, width, height, samples_per_pixel, bits, compression, samples, error) for each page."""
    key_type = dict(df.dtypes)[key]

    def run(batches):
        for batch in batches:
            for one_key, data in zip(batch.column(0), batch.column(1)):
                rows, data = [], data.as_py()
                for n, page, scheme, error in page_rows(data) if data else ():
                    if page is None:
                        rows.append((n, None, None, None, None, None, None, error))
                    else:
                        h, w, spp = page.shape
                        rows.append((n, w, h, spp, page.dtype.itemsize * 8, scheme, page.tobytes(), None))
                if rows:
                    names = ["page", "width", "height", "samples_per_pixel", "bits", "compression", "samples", "error"]
                    types = [pa.int32()] * 6 + [pa.binary(), pa.string()]
                    cols = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                    yield pa.RecordBatch.from_arrays([pa.array([one_key.as_py()] * len(rows), batch.schema.field(0).type), *cols], names=["key", *names])

    out = df.select(F.col(key).alias("key"), F.col(blob).alias("blob")).mapInArrow(run, f"key {key_type}, page int, {PAGE_SCHEMA}")
    return out.withColumnRenamed("key", key)


# --- the query's digests ------------------------------------------------------------------------

#: Bytes of a row of samples, and rows of a page at most: a page holds 1 MB.
ROW, PAGE_ROWS = 576, 1820


def stored(text: bytes) -> bytes:
    """A text's bytes as a TIFF of 8-bit samples, padded with 255 to a positive multiple of ROW."""
    size = max(1, -(-len(text) // ROW)) * ROW
    grid = np.frombuffer(text.ljust(size, b"\xff"), np.uint8).reshape(-1, ROW)
    return write_tiff([grid[k : k + PAGE_ROWS] for k in range(0, len(grid), PAGE_ROWS)])


def digests(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Stores each text as a TIFF, reads its pages back and returns a row of digests.

    The same page walk as tiff_pages, kept inside the task so that no pixel is shuffled.
    """
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]

    def run(batches):
        for batch in batches:
            rows = []
            for data in batch.column(1):
                data = data.as_py()
                blob = stored(data)
                found = []
                for _, page, _, error in page_rows(blob):
                    if page is None:
                        raise ValueError(error)
                    found.append(page)
                payload = b"".join(p.tobytes() for p in found)
                samples = np.frombuffer(payload, np.uint8)
                feature = f"pages={len(found)};height={sum(p.shape[0] for p in found)};sum={int(samples.sum(dtype=np.int64))};edges={int(np.count_nonzero(np.diff(samples)))};distinct={int(np.count_nonzero(np.bincount(samples)))}"
                rows.append((len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(blob), hashlib.sha256(blob).hexdigest(), feature))
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows), types))], names=["key", *names])

    out = df.select(F.col(key).alias("key"), as_bytes(text).alias("text")).mapInArrow(run, f"key {dict(df.dtypes)[key]}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
    return out.withColumnRenamed("key", key)
