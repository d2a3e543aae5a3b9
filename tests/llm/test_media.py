import hashlib
import itertools
import random
import struct
import zlib

import numpy as np
import pytest

from contigo.llm import media


@pytest.mark.parametrize("codec, predictor, tile, order, planar", list(itertools.product([media.NONE, media.LZW, media.DEFLATE, media.PACKBITS], [1, 2], [None, (16, 32)], "<>", [False, True])))
def test_round_trip(codec, predictor, tile, order, planar):
    rng = np.random.default_rng(1)
    pages = [rng.integers(0, 256, (70, 45), np.uint8), np.repeat(rng.integers(0, 9, (33, 10, 3), np.uint8), 5, axis=1), rng.integers(0, 1 << 16, (20, 17, 2)).astype(np.uint16)]
    got = list(media.read_tiff(media.write_tiff(pages, codec, predictor, tile, 16, order, planar)))
    assert len(got) == 3
    for p, g in zip(pages, got):
        assert (g["height"], g["width"]) == p.shape[:2] and g["pixels"] == p.astype(p.dtype.newbyteorder("<")).tobytes()


def test_codecs():
    rng = random.Random(1)
    for n in [0, 1, 2, 127, 128, 129, 511, 3000, 20000]:
        for alphabet in (1, 2, 30, 256):
            data = bytes(rng.randrange(alphabet) for _ in range(n))
            assert media.packbits_decode(media.packbits_encode(data)) == data
            assert media.lzw_decode(media.lzw_encode(data)) == data
    # the format's own example of PackBits
    assert media.packbits_decode(bytes.fromhex("feaa0280002afdaa0380002a22f7aa")) == bytes.fromhex("aaaaaa80002aaaaaaaaa80002a22aaaaaaaaaaaaaaaaaaaa")
    # codes 256 7 258 8 8 258 6 6 257 of the format's description of LZW
    codes = "".join(f"{c:09b}" for c in (256, 7, 258, 8, 8, 258, 6, 6, 257))
    assert media.lzw_decode(int(codes.ljust(88, "0"), 2).to_bytes(11, "big")) == bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])


def test_rows_and_faults(spark):
    good = media.write_tiff([np.zeros((3, 4), np.uint8), np.ones((2, 2), np.uint8)], media.LZW)
    loop = bytearray(media.write_tiff([np.zeros((3, 4), np.uint8)]))
    at = struct.unpack_from("<I", loop, 4)[0]
    struct.pack_into("<I", loop, at + 2 + 12 * struct.unpack_from("<H", loop, at)[0], at)
    rows = [(1, good), (2, None), (3, b""), (4, b"GIF89a"), (5, good[:-20]), (6, bytes(loop)), (7, good), (7, good)]
    df = spark.createDataFrame(rows, "k long, data binary").selectExpr("k", "data", "'x' AS page")
    got = [(r.id, r.page, r.error) for r in media.tiff_pages(df, "k", "data").collect()]
    assert [g[:2] for g in got if g[0] in (1, 7)] == [(1, 0), (1, 1), (7, 0), (7, 1), (7, 0), (7, 1)]
    assert {g[0]: g[2] for g in got if g[1] == -1}.keys() == {2, 3, 4, 5, 6}
    assert media.tiff_pages(df.limit(0), "k", "data").count() == 0


def test_text_media(spark, tmp_path):
    texts = [None, "", "a", "é" * 32, "x" * 64, "word " * 90, "ab c" * 900, "long text, " * 9000, "long text, " * 9000]
    spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_bytes int").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in media.op2_media_tiff(spark, str(tmp_path)).collect()}
    for i, t in enumerate(texts):
        data = (t or "").encode()
        payload = data + b"\0" * ((-len(data) % 64) or (0 if data else 64))
        r = rows[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    assert rows[7].media_sha256 == rows[8].media_sha256 and rows[7].feature == rows[8].feature and "pages=2" in rows[7].feature


def test_every_codec_meets_every_size(spark, tmp_path):
    """The kind of file hangs on a check sum, so short and long texts use each codec; all come back whole."""
    rng = random.Random(2)
    texts = ["".join(rng.choice("abc de") for _ in range(n)) for n in [40] * 12 + [3000] * 12 + [90_000] * 12]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for r in media.op2_media_tiff(spark, str(tmp_path)).collect():
        data = texts[r.doc_id].encode()
        assert r.payload_sha256 == hashlib.sha256(data + b"\0" * (-len(data) % 64)).hexdigest()
    seen = set()
    for t in texts:
        data = t.encode()
        for page in itertools.islice(media.read_tiff(media.text_image(data + b"\0" * (-len(data) % 64))), 1):
            seen.add((len(t), page["compression"]))
    assert seen == set(itertools.product([40, 3000, 90_000], [media.LZW, media.PACKBITS, media.DEFLATE]))


def test_hostile_files_stay_small():
    bomb = media.write_tiff([np.zeros((64, 64), np.uint8)], media.DEFLATE)
    packed = zlib.compress(bytes(1 << 24))
    assert len(media.inflate(packed, 4096)) == 4096 and len(media.packbits_decode(b"\x81\0" * 10_000, 4096)) < 4096 + 128
    wide = bytearray(bomb)
    at = struct.unpack_from("<I", wide, 4)[0]
    struct.pack_into("<I", wide, at + 2 + 8, 1 << 31)
    with pytest.raises(media.TiffError, match="too large"):
        list(media.read_tiff(bytes(wide)))
