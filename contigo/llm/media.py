"""TIFF columns: a reader that gives one row per page, and a writer of the same formats.

The reader walks the chain of image directories (classic TIFF, both byte orders), gathers
strips or tiles, decodes none, LZW (5), deflate (8, 32946) and PackBits (32773), undoes the
horizontal predictor (2) and crops tiles to the page. Samples of 8 and 16 bits, any number
per pixel, chunky or planar. The writer makes the same kinds; ``text_image`` stores bytes as
8-bit grey pages, 64 wide.

Edge cases: null content gives one row with page -1 and error "no content"; what isn't a
TIFF, is cut off, loops, says of a page that it is larger than ``MOST_PAGE`` bytes or uses another
kind of compression gives the pages before the fault and then a row with page -1 and the fault;
no part is unpacked further than its page needs. Repeated rows and rows with equal or null ids give
their pages each; very long texts become many pages; an empty table gives no rows; other columns
aren't read.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, text_docs

NONE, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
#: Bytes of each field type of the format.
_TYPE_SIZE = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}
#: Bytes of a page above which its header isn't believed.
MOST_PAGE = 1 << 30
_TAGS = {"width": 256, "height": 257, "bits": 258, "compression": 259, "photometric": 262, "strip_at": 273, "samples": 277, "rows": 278, "strip_size": 279, "planar": 284, "predictor": 317, "tile_width": 322, "tile_height": 323, "tile_at": 324, "tile_size": 325}


class TiffError(ValueError):
    pass


# ---- compression


def packbits_decode(data: bytes, most: int = 1 << 62) -> bytes:
    """most: bytes after which decoding may stop, as in all decoders here."""
    out, at, n, size = [], 0, len(data), 0
    while at < n and size < most:
        c = data[at]
        at += 1
        if c < 128:
            if at + c + 1 > n:
                raise TiffError("PackBits data is cut off")
            out.append(data[at : at + c + 1])
            at += c + 1
            size += c + 1
        elif c > 128:
            if at >= n:
                raise TiffError("PackBits data is cut off")
            out.append(data[at : at + 1] * (257 - c))
            at += 1
            size += 257 - c
    return b"".join(out)


_RUN = re.compile(rb"(.)\1{2,127}", re.DOTALL)


def packbits_encode(data: bytes) -> bytes:
    out, at = [], 0

    def literal(part: bytes) -> None:
        for k in range(0, len(part), 128):
            some = part[k : k + 128]
            out.append(bytes([len(some) - 1]) + some)

    for m in _RUN.finditer(data):
        literal(data[at : m.start()])
        out.append(bytes([257 - (m.end() - m.start())]) + m[1])
        at = m.end()
    literal(data[at:])
    return b"".join(out)


def lzw_decode(data: bytes, most: int = 1 << 62) -> bytes:
    """Most significant bit first, codes grow one entry early, as the format asks."""
    first = [bytes([k]) for k in range(256)] + [b"", b""]
    table, out, width, old = list(first), [], 9, None
    bits, have, done = 0, 0, 0
    for byte in data:
        if done >= most:
            break
        bits = (bits << 8 | byte) & 0xFFFFFFFF
        have += 8
        if have < width:
            continue
        have -= width
        code = bits >> have & (1 << width) - 1
        if code == 257:
            return b"".join(out)
        if code == 256:
            table, width, old = list(first), 9, None
            continue
        if old is None:
            if code > 255:
                raise TiffError("LZW data starts with a code that isn't known")
            old = table[code]
            out.append(old)
            continue
        if code < len(table):
            new = table[code]
        elif code == len(table):
            new = old + old[:1]
        else:
            raise TiffError("LZW code that isn't known")
        out.append(new)
        done += len(new)
        table.append(old + new[:1])
        old = new
        size = len(table)
        width = 9 if size < 511 else 10 if size < 1023 else 11 if size < 2047 else 12
    return b"".join(out)


def lzw_encode(data: bytes) -> bytes:
    codes: list[tuple[int, int]] = [(256, 9)]
    table = {bytes([k]): k for k in range(256)}
    size, width, prefix = 258, 9, b""
    for k in range(len(data)):
        longer = prefix + data[k : k + 1]
        if longer in table:
            prefix = longer
            continue
        codes.append((table[prefix], width))
        table[longer] = size
        size += 1
        width = 9 if size < 512 else 10 if size < 1024 else 11 if size < 2048 else 12
        if size == 4094:
            codes.append((256, width))
            table = {bytes([k]): k for k in range(256)}
            size, width = 258, 9
        prefix = data[k : k + 1]
    if prefix:
        codes.append((table[prefix], width))
        size += 1
        width = 9 if size < 512 else 10 if size < 1024 else 11 if size < 2048 else 12
    codes.append((257, width))
    number = length = 0
    out = []
    for code, w in codes:
        number, length = number << w | code, length + w
        if length >= 64:
            rest = length % 8
            out.append((number >> rest).to_bytes(length // 8, "big"))
            number, length = number & (1 << rest) - 1, rest
    pad = -length % 8
    return b"".join(out) + (number << pad).to_bytes((length + pad) // 8, "big")


def inflate(data: bytes, most: int = 1 << 62) -> bytes:
    return zlib.decompressobj().decompress(data, most)


_DECODE = {NONE: lambda data, most: bytes(data[:most]), LZW: lzw_decode, DEFLATE: inflate, OLD_DEFLATE: inflate, PACKBITS: packbits_decode}
_ENCODE = {NONE: bytes, LZW: lzw_encode, DEFLATE: lambda x: zlib.compress(x, 1), OLD_DEFLATE: lambda x: zlib.compress(x, 1), PACKBITS: packbits_encode}


# ---- reading


def directories(data: bytes) -> Iterator[tuple[str, dict[int, tuple]]]:
    """Byte order and tags of each image directory."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or len(data) < 8 or struct.unpack_from(order + "H", data, 2)[0] != 42:
        raise TiffError("not a TIFF")
    at, seen = struct.unpack_from(order + "I", data, 4)[0], set()
    while at:
        if at in seen:
            raise TiffError("the directories loop")
        seen.add(at)
        try:
            n = struct.unpack_from(order + "H", data, at)[0]
            tags = {}
            for k in range(n):
                tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * k)
                size = _TYPE_SIZE.get(kind, 0) * count
                if kind not in (1, 3, 4):
                    continue
                place = at + 10 + 12 * k if size <= 4 else struct.unpack_from(order + "I", data, at + 10 + 12 * k)[0]
                if place + size > len(data):
                    raise TiffError("a tag is cut off")
                tags[tag] = struct.unpack_from(f"{order}{count}{ {1: 'B', 3: 'H', 4: 'I'}[kind] }", data, place)
            following = struct.unpack_from(order + "I", data, at + 2 + 12 * n)[0]
        except struct.error as e:
            raise TiffError("a directory is cut off") from e
        yield order, tags
        at = following


def _page(data: bytes, order: str, tags: dict[int, tuple]) -> dict:
    def tag(name: str, default=None):
        value = tags.get(_TAGS[name])
        if value is None and default is None:
            raise TiffError(f"tag {_TAGS[name]} is missing")
        return value if value is not None else default

    width, height, samples = tag("width")[0], tag("height")[0], tag("samples", (1,))[0]
    bits, codec, predictor, planar = tag("bits", (1,)), tag("compression", (1,))[0], tag("predictor", (1,))[0], tag("planar", (1,))[0]
    if len(set(bits)) > 1 or bits[0] not in (8, 16):
        raise TiffError(f"samples of {bits} bits")
    if codec not in _DECODE:
        raise TiffError(f"compression {codec}")
    if predictor not in (1, 2):
        raise TiffError(f"predictor {predictor}")
    kind = np.dtype(np.uint8 if bits[0] == 8 else order + "u2")
    planes, deep = (samples, 1) if planar == 2 else (1, samples)
    tiled = _TAGS["tile_at"] in tags
    if tiled:
        w, h = tag("tile_width")[0], tag("tile_height")[0]
        places, sizes = tag("tile_at"), tag("tile_size")
    else:
        w, h = width, min(tag("rows", (height,))[0], height)
        places, sizes = tag("strip_at"), tag("strip_size")
    if not (w and h and width and height):
        raise TiffError("an empty page")
    if width * height * samples * kind.itemsize > MOST_PAGE or w * h * samples * kind.itemsize > MOST_PAGE:
        raise TiffError("a page too large to believe")
    across, down = -(-width // w), -(-height // h)
    if len(places) < planes * across * down or len(sizes) < len(places):
        raise TiffError("parts of the page are missing")
    out = np.zeros((planes, height, width, deep), kind)
    for k in range(planes * across * down):
        p, y, x = k // (across * down), k // across % down * h, k % across * w
        rows = h if tiled else min(h, height - y)
        if places[k] + sizes[k] > len(data):
            raise TiffError("a part of the page is cut off")
        need = rows * w * deep * kind.itemsize
        try:
            raw = _DECODE[codec](data[places[k] : places[k] + sizes[k]], need)
        except zlib.error as e:
            raise TiffError(f"deflate: {e}") from e
        if len(raw) < need:
            raise TiffError("a part of the page is short")
        part = np.frombuffer(raw, kind, rows * w * deep).reshape(rows, w, deep)
        if predictor == 2:
            part = np.cumsum(part, axis=1, dtype=kind.newbyteorder("="))
        out[p, y : y + rows, x : x + w] = part[: height - y, : width - x]
    pixels = out[0] if planes == 1 else np.moveaxis(out[..., 0], 0, -1)
    return {"width": width, "height": height, "samples": samples, "bits": bits[0], "compression": codec, "pixels": np.ascontiguousarray(pixels.astype(kind.newbyteorder("<"))).tobytes()}


def read_tiff(data: bytes) -> Iterator[dict]:
    """The pages, pixels as chunky little-endian samples."""
    for order, tags in directories(data):
        yield _page(data, order, tags)


# ---- writing


def write_tiff(pages: list[np.ndarray], codec: int = DEFLATE, predictor: int = 1, tile: tuple[int, int] | None = None, rows: int = 256, order: str = "<", planar: bool = False) -> bytes:
    """Pages of shape (height, width) or (height, width, samples), uint8 or uint16, as strips of so many rows or tiles (width, height)."""
    out = [(b"II" if order == "<" else b"MM") + struct.pack(order + "HI", 42, 0)]
    size, link = 8, (0, 4)  # link: the piece and place where the next directory's place goes
    for page in pages:
        page = page if page.ndim == 3 else page[..., None]
        height, width, samples = page.shape
        bits = page.dtype.itemsize * 8
        kind = page.dtype.newbyteorder(order)
        places, sizes = [], []
        w, h = tile or (width, min(rows, height))
        for plane in np.split(page, samples, axis=2) if planar else [page]:
            for y in range(0, height, h):
                for x in range(0, width, w):
                    part = plane[y : y + h, x : x + w]
                    if tile:
                        whole = np.zeros((h, w, part.shape[2]), part.dtype)
                        whole[: part.shape[0], : part.shape[1]] = part
                        part = whole
                    if predictor == 2:
                        part = np.concatenate([part[:, :1], part[:, 1:] - part[:, :-1]], axis=1)
                    lines = part.astype(kind)
                    # PackBits packs each row of pixels apart
                    data = b"".join(packbits_encode(x.tobytes()) for x in lines) if codec == PACKBITS else _ENCODE[codec](lines.tobytes())
                    places.append(size)
                    sizes.append(len(data))
                    data += b"\0" * (len(data) % 2)
                    out.append(data)
                    size += len(data)
        tags = [(256, 4, [width]), (257, 4, [height]), (258, 3, [bits] * samples), (259, 3, [codec]), (262, 3, [1 if samples < 3 else 2]), (277, 3, [samples]), (284, 3, [2 if planar else 1]), (317, 3, [predictor])]
        tags += [(322, 4, [w]), (323, 4, [h]), (324, 4, places), (325, 4, sizes)] if tile else [(273, 4, places), (278, 4, [h]), (279, 4, sizes)]
        entries, more, after = b"", b"", size + 2 + 12 * len(tags) + 4
        for tag, form, values in sorted(tags):
            raw = struct.pack(f"{order}{len(values)}{'H' if form == 3 else 'I'}", *values)
            if len(raw) <= 4:
                value = raw.ljust(4, b"\0")
            else:
                value = struct.pack(order + "I", after + len(more))
                more += raw + b"\0" * (len(raw) % 2)
            entries += struct.pack(order + "HHI", tag, form, len(values)) + value
        piece, place = link
        out[piece] = out[piece][:place] + struct.pack(order + "I", size) + out[piece][place + 4 :]
        directory = struct.pack(order + "H", len(tags)) + entries + b"\0\0\0\0" + more
        link = (len(out), 2 + len(entries))
        out.append(directory)
        size += len(directory)
    return b"".join(out)


WIDTH, PAGE_ROWS = 64, 1024


def text_image(payload: bytes) -> bytes:
    """Bytes (a positive multiple of 64) as a lossless TIFF: grey pages 64 wide. A check sum of the bytes, and not their number, picks
    the kind of file: LZW, PackBits or deflate in strips, or deflate in tiles, deflate with the predictor."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    pages = [rows[k : k + PAGE_ROWS] for k in range(0, len(rows), PAGE_ROWS)]
    kind = zlib.crc32(payload) % 4
    if kind < 2:
        return write_tiff(pages, (LZW, PACKBITS)[kind])
    return write_tiff(pages, DEFLATE, predictor=2, tile=(WIDTH, 64) if kind == 3 else None)


def image_feature(pages: list[dict]) -> str:
    """Pages, rows, mean, deviation and an 8 x 8 average hash of grey pages that continue each other."""
    x = np.frombuffer(b"".join(p["pixels"] for p in pages), np.uint8).reshape(-1, pages[0]["width"])
    edges = np.linspace(0, len(x), 9).astype(int)
    block = np.array([x[a : max(b, a + 1)].mean(axis=0, dtype=np.float64) if a < len(x) else np.zeros(x.shape[1]) for a, b in zip(edges[:-1], edges[1:])])
    small = block.reshape(8, 8, -1).mean(axis=2)
    bits = np.packbits((small > small.mean()).ravel())
    return f"pages={len(pages)};rows={len(x)};mean={x.mean(dtype=np.float64):.4f};sd={x.std(dtype=np.float64):.4f};hash={bits.tobytes().hex()}"


# ---- Spark


def _pages(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["width", "height", "samples", "bits", "compression"]
    types = [pa.int64(), pa.int32(), *[pa.int32()] * 5, pa.binary(), pa.string()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["id", "page", *names, "pixels", "error"])

    for batch in batches:
        rows, size = [], 0
        for key, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            k = 0
            try:
                if not content.is_valid:
                    raise TiffError("no content")
                for p in read_tiff(content.as_py()):
                    rows.append((key, k, *(p[n] for n in names), p["pixels"], None))
                    k, size = k + 1, size + len(p["pixels"])
                    if size > 16_000_000:
                        yield batch_of(rows)
                        rows, size = [], 0
            except (TiffError, struct.error, ValueError, MemoryError) as e:
                rows.append((key, -1, None, None, None, None, None, None, str(e)))
        if rows:
            yield batch_of(rows)


def tiff_pages(media: DataFrame, id_column: str, content: str) -> DataFrame:
    """id, page, width, height, samples, bits, compression, pixels, error of each page of TIFFs in a binary column."""
    schema = "id long, page int, width int, height int, samples int, bits int, compression int, pixels binary, error string"
    return media.select(F.col(id_column).cast("long").alias("id"), F.col(content).alias("content")).mapInArrow(_pages, schema)


def _text_media(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            data = text.as_buffer().to_pybytes()
            stored = text_image(data.ljust(max(64, -(-len(data) // 64) * 64), b"\0"))
            pages = list(read_tiff(stored))
            payload = b"".join(p["pixels"] for p in pages)
            rows.append((doc_id, len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(stored), hashlib.sha256(stored).hexdigest(), image_feature(pages)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def op2_media_tiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = text_docs(read_table(spark, sf_dir, "documents")).select("doc_id", F.col("text").cast("binary").alias("text"))
    return docs.mapInArrow(_text_media, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
