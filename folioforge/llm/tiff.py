"""TIFF columns: a reader that gives one row per page, and a writer of 8-bit grey images.

The reader walks the chain of image directories (either byte order), decodes strips or tiles that are stored plainly, with
PackBits, LZW or deflate, undoes horizontal differencing, and puts the parts together to one array of samples per page.

Defined cases: null media give no rows; media that are not TIFF, are cut short, or use something not supported give a row with
the reason in ``error`` and no samples, pages read before it stay; a directory that is met twice ends the chain; other columns
of the input travel only if named in ``keep``.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_size, table, texts_of

# Fixed values of the format: tags, field sizes, compression schemes.
WIDTH, LENGTH, BITS, COMPRESSION, PHOTOMETRIC, STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_COUNTS, PLANAR = 256, 257, 258, 259, 262, 273, 277, 278, 279, 284
PREDICTOR, TILE_WIDTH, TILE_LENGTH, TILE_OFFSETS, TILE_COUNTS = 317, 322, 323, 324, 325
FIELD_SIZE = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8, 13: 4, 16: 8, 17: 8, 18: 8}
FIELD_CODE = {1: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 13: "I", 16: "Q", 17: "q", 18: "Q"}
NONE, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
NAMES = {"none": NONE, "lzw": LZW, "deflate": DEFLATE, "packbits": PACKBITS}


class Malformed(ValueError):
    """What makes an image unreadable."""


def unpack_bits(data: bytes, most: int) -> bytes:
    out, i = bytearray(), 0
    while i < len(data) and len(out) < most:
        n = data[i]
        if n < 128:
            out += data[i + 1 : i + 2 + n]
            i += 2 + n
        elif n > 128:
            out += data[i + 1 : i + 2] * (257 - n)
            i += 2
        else:
            i += 1
    return bytes(out[:most])


def pack_bits(data: bytes) -> bytes:
    """Runs of three or more bytes are written as runs, what lies between as it is."""
    a = np.frombuffer(data, np.uint8)
    if not len(a):
        return b""
    edge = np.flatnonzero(np.diff(a)) + 1
    out, plain = bytearray(), bytearray()

    def literal() -> None:
        for k in range(0, len(plain), 128):
            part = plain[k : k + 128]
            out.append(len(part) - 1)
            out.extend(part)
        plain.clear()

    for i, j in zip([0, *edge.tolist()], [*edge.tolist(), len(a)], strict=True):
        if j - i < 3:
            plain += data[i:j]
            continue
        literal()
        while j - i > 0:
            n = min(128, j - i)
            if n == 1:
                plain += data[i : i + 1]
            else:
                out += bytes([257 - n, data[i]])
            i += n
    literal()
    return bytes(out)


def lzw_decode(data: bytes, most: int) -> bytes:
    """Codes of 9 to 12 bits, highest bit first, growing one code early; 256 clears, 257 ends."""
    base = [bytes([k]) for k in range(256)] + [b"", b""]
    words, width, out, size = list(base), 9, [], 0
    held = bits = 0
    last: bytes | None = None
    for byte in data:
        held, bits = held << 8 | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits
        held &= (1 << bits) - 1
        if code == 256:
            words, width, last = list(base), 9, None
            continue
        if code == 257:
            break
        if last is None:
            if code > 255:
                raise Malformed("LZW: a string code follows a clear code")
            word = words[code]
        else:
            if code > len(words):
                raise Malformed("LZW: a code is not defined yet")
            word = words[code] if code < len(words) else last + last[:1]
            if len(words) < 4096:
                words.append(last + word[:1])
        out.append(word)
        size += len(word)
        if size >= most:
            break
        last = word
        width = 9 if len(words) < 511 else 10 if len(words) < 1023 else 11 if len(words) < 2047 else 12
    return b"".join(out)[:most]


def lzw_encode(data: bytes) -> bytes:
    out, held, bits = bytearray(), 0, 0
    words: dict[bytes, int] = {}
    width, following = 9, 258

    def put(code: int) -> None:
        nonlocal held, bits
        held, bits = held << width | code, bits + width
        while bits >= 8:
            bits -= 8
            out.append(held >> bits & 255)
        held &= (1 << bits) - 1

    put(256)
    word = b""
    for k in range(len(data)):
        more = word + data[k : k + 1]
        if len(more) == 1 or more in words:
            word = more
            continue
        put(words[word] if len(word) > 1 else word[0])
        words[more] = following
        following += 1
        width = 9 if following < 512 else 10 if following < 1024 else 11 if following < 2048 else 12
        word = data[k : k + 1]
        if following == 4094:
            put(words[word] if len(word) > 1 else word[0])
            word = b""
            put(256)
            words, width, following = {}, 9, 258
    if word:
        put(words[word] if len(word) > 1 else word[0])
        following += 1
        width = 9 if following < 512 else 10 if following < 1024 else 11 if following < 2048 else 12
    put(257)
    if bits:
        out.append(held << (8 - bits) & 255)
    return bytes(out)


def _decode(data: bytes, how: int, size: int) -> bytes:
    if how == NONE:
        got = data[:size]
    elif how == PACKBITS:
        got = unpack_bits(data, size)
    elif how == LZW:
        got = lzw_decode(data, size)
    elif how in (DEFLATE, OLD_DEFLATE):
        try:
            got = zlib.decompressobj().decompress(data, size) if size else b""
        except zlib.error as e:
            raise Malformed(f"deflate: {e}") from e
    else:
        raise Malformed(f"compression {how} is not supported")
    if len(got) < size:
        raise Malformed(f"a part has {len(got)} of {size} bytes")
    return got


class Tiff:
    """Walks the image directories of a file; classic and 64-bit files, either byte order."""

    def __init__(self, data: bytes):
        self.data = data
        if data[:4] in (b"II*\0", b"MM\0*"):
            self.order, self.wide = "<" if data[:2] == b"II" else ">", False
        elif data[:4] in (b"II+\0", b"MM\0+"):
            self.order, self.wide = "<" if data[:2] == b"II" else ">", True
        else:
            raise Malformed("not a TIFF file")

    def number(self, at: int, code: str) -> int:
        try:
            return struct.unpack_from(self.order + code, self.data, at)[0]
        except struct.error as e:
            raise Malformed("the file ends within a directory") from e

    def directories(self) -> Iterator[dict[int, tuple]]:
        at, seen = self.number(8, "Q") if self.wide else self.number(4, "I"), set()
        while at and at not in seen:
            seen.add(at)
            n = self.number(at, "Q" if self.wide else "H")
            at += 8 if self.wide else 2
            step, room = (20, 8) if self.wide else (12, 4)
            if at + n * step > len(self.data):
                raise Malformed("the file ends within a directory")
            tags = {}
            for k in range(n):
                field = at + k * step
                tag, kind, count = self.number(field, "H"), self.number(field + 2, "H"), self.number(field + 4, "Q" if self.wide else "I")
                if kind in FIELD_CODE:
                    size, place = FIELD_SIZE[kind] * count, field + (12 if self.wide else 8)
                    place = place if size <= room else self.number(place, "Q" if self.wide else "I")
                    if place + size > len(self.data):
                        raise Malformed(f"the values of tag {tag} lie outside the file")
                    tags[tag] = struct.unpack_from(f"{self.order}{count}{FIELD_CODE[kind]}", self.data, place)
            yield tags
            at = self.number(at + n * step, "Q" if self.wide else "I")

    def page(self, tags: dict[int, tuple]) -> dict:
        """Size, layout and samples of one directory's image; samples lie in rows, of a pixel next to each other."""
        one = lambda tag, default=None: tags[tag][0] if tags.get(tag) else default
        width, height, samples, how = one(WIDTH), one(LENGTH), one(SAMPLES, 1), one(COMPRESSION, NONE)
        bits = tags.get(BITS, (1,))
        if not width or not height:
            raise Malformed("a page has no size")
        if set(bits) not in ({8}, {16}):
            raise Malformed(f"samples of {bits} bits are not supported")
        item = np.dtype(f"{self.order}u{bits[0] // 8}")
        planes = samples if one(PLANAR, 1) == 2 else 1
        deep = samples // planes
        tiled = TILE_OFFSETS in tags
        offsets, counts = (tags.get(t, ()) for t in ((TILE_OFFSETS, TILE_COUNTS) if tiled else (STRIP_OFFSETS, STRIP_COUNTS)))
        w, h = (one(TILE_WIDTH), one(TILE_LENGTH)) if tiled else (width, min(one(ROWS_PER_STRIP, height), height))
        if not w or not h:
            raise Malformed("a part has no size")
        across, down = -(-width // w), -(-height // h)
        if len(offsets) < across * down * planes or len(counts) < len(offsets):
            raise Malformed("parts are missing")
        predictor = one(PREDICTOR, 1)
        if predictor not in (1, 2):
            raise Malformed(f"predictor {predictor} is not supported")
        if across * down * planes == 1 and w == width and h == height:
            out = self._part(offsets[0], counts[0], how, item, h, w, deep, predictor)
        else:
            # a file cannot claim more samples than its parts can hold: rows are only set aside as parts are decoded
            bands = []
            for y in range(0, height, h):
                rows = h if tiled else min(h, height - y)
                band = np.zeros((min(rows, height - y), width, samples), item)
                for p in range(planes):
                    for x in range(0, width, w):
                        k = (p * down + y // h) * across + x // w
                        part = self._part(offsets[k], counts[k], how, item, rows, w, deep, predictor)
                        band[:, x : x + w, p * deep : (p + 1) * deep] = part[: height - y, : width - x]
                bands.append(band)
            out = np.concatenate(bands)
        return {
            "width": width, "height": height, "samples_per_pixel": samples, "bits": bits[0], "compression": how, "predictor": predictor,
            "parts": across * down * planes, "tiled": tiled, "pixels": out.astype(item.newbyteorder("<")).tobytes(),
        }

    def _part(self, at: int, n: int, how: int, item: np.dtype, h: int, w: int, deep: int, predictor: int) -> np.ndarray:
        if at + n > len(self.data):
            raise Malformed("a part lies outside the file")
        if h * w * deep * item.itemsize > 2**31 or h * w * deep * item.itemsize > 2000 * n + 4096:
            raise Malformed("a part is larger than its bytes can be")  # no scheme here packs tighter than about 1 to 1,400
        a = np.frombuffer(_decode(self.data[at : at + n], how, h * w * deep * item.itemsize), item).reshape(h, w, deep)
        return np.cumsum(a, axis=1, dtype=item.newbyteorder("=")) if predictor == 2 else a


def encode_grey(pages: list[tuple[bytes, int]], compression: str = "deflate", predictor: int = 1, rows_per_strip: int = 1024, tile: tuple[int, int] | None = None, order: str = "<") -> bytes:
    """A TIFF file of 8-bit grey pages, each given as its samples and its width. Strips, or tiles of (width, height)."""
    how = NAMES[compression]
    out = bytearray((b"II*\0" if order == "<" else b"MM\0*") + b"\0\0\0\0")
    link = 4
    for samples, width in pages:
        a = np.frombuffer(samples, np.uint8).reshape(-1, width)
        height = len(a)
        w, h = tile or (width, max(1, min(rows_per_strip, height)))
        offsets, counts = [], []
        for y in range(0, height, h):
            for x in range(0, width, w):
                part = a[y : y + h, x : x + w]
                if tile:
                    part = np.pad(part, ((0, h - part.shape[0]), (0, w - part.shape[1])))
                if predictor == 2:
                    part = np.diff(part, axis=1, prepend=np.uint8(0))
                raw = part.tobytes()
                raw = zlib.compress(raw, 1) if how == DEFLATE else lzw_encode(raw) if how == LZW else b"".join(pack_bits(r.tobytes()) for r in part) if how == PACKBITS else raw
                offsets.append(len(out))
                counts.append(len(raw))
                out += raw + b"\0" * (len(raw) % 2)
        fields = [(WIDTH, 4, [width]), (LENGTH, 4, [height]), (BITS, 3, [8]), (COMPRESSION, 3, [how]), (PHOTOMETRIC, 3, [1]), (SAMPLES, 3, [1])]
        fields += [(TILE_WIDTH, 4, [w]), (TILE_LENGTH, 4, [h]), (TILE_OFFSETS, 4, offsets), (TILE_COUNTS, 4, counts)] if tile else [(STRIP_OFFSETS, 4, offsets), (ROWS_PER_STRIP, 4, [h]), (STRIP_COUNTS, 4, counts)]
        if predictor != 1:
            fields.append((PREDICTOR, 3, [predictor]))
        rows = []
        for tag, kind, values in sorted(fields):
            raw = struct.pack(f"{order}{len(values)}{FIELD_CODE[kind]}", *values)
            if len(raw) > 4:
                place = struct.pack(order + "I", len(out))
                out += raw
            else:
                place = raw.ljust(4, b"\0")
            rows.append(struct.pack(order + "HHI", tag, kind, len(values)) + place)
        struct.pack_into(order + "I", out, link, len(out))
        out += struct.pack(order + "H", len(rows)) + b"".join(rows)
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


def features(pixels: bytes) -> str:
    """Range, mean, spread and entropy of the samples, and their mean step to the next one."""
    a = np.frombuffer(pixels, np.uint8)
    if not len(a):
        return "empty"
    n = np.bincount(a, minlength=256)
    p = n[n > 0] / len(a)
    mean = float(np.dot(np.arange(256), n)) / len(a)
    var = float(np.dot((np.arange(256) - mean) ** 2, n)) / len(a)
    step = float(np.abs(np.diff(a.astype(np.int16))).mean()) if len(a) > 1 else 0.0
    return f"min={int(np.flatnonzero(n)[0])};max={int(np.flatnonzero(n)[-1])};mean={mean:.4f};sd={var**0.5:.4f};entropy={float(-(p * np.log2(p)).sum()):.4f};step={step:.4f}"


PAGE_SCHEMA = "page int, width bigint, height bigint, samples_per_pixel int, bits int, compression int, predictor int, parts bigint, tiled boolean, pixels binary, feature string, error string"
_PAGE_ARROW = pa.schema(
    [("page", pa.int32()), ("width", pa.int64()), ("height", pa.int64()), ("samples_per_pixel", pa.int32()), ("bits", pa.int32()), ("compression", pa.int32()), ("predictor", pa.int32()), ("parts", pa.int64()), ("tiled", pa.bool_()), ("pixels", pa.binary()), ("feature", pa.string()), ("error", pa.string())]
)


def read_pages(data: bytes) -> list[dict]:
    """The pages of a file, numbered from 0; a last row with ``error`` where it can't be read on."""
    rows: list[dict] = []
    try:
        tiff = Tiff(data)
        for tags in tiff.directories():
            page = tiff.page(tags)
            rows.append({"page": len(rows), **page, "feature": features(page["pixels"])})
    except Malformed as e:
        rows.append({"page": len(rows), "error": str(e)})
    return rows


def tiff_pages(media: DataFrame, media_column: str = "media", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per page of each TIFF: the columns ``keep`` and those of PAGE_SCHEMA."""
    kept = ", ".join(f"`{c}` {media.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, media_column, 2_000_000):
            rows, of = [], []
            for k, data in enumerate(batch.column(batch.schema.get_field_index(media_column)).to_pylist()):
                pages = [] if data is None else read_pages(data)
                rows += pages
                of += [k] * len(pages)
            left = [batch.column(batch.schema.get_field_index(c)).take(pa.array(of, pa.int32())) for c in keep]
            right = [pa.array([r.get(f.name) for r in rows], f.type) for f in _PAGE_ARROW]
            yield pa.RecordBatch.from_arrays(left + right, names=[*keep, *_PAGE_ARROW.names])

    return media.select(*keep, media_column).mapInArrow(run, f"{kept}, {PAGE_SCHEMA}")


#: How texts are stored: (compression, predictor, tile). The checksum of the bytes chooses, so that equal texts have equal files.
FORMS = (("lzw", 2, (64, 64)), ("packbits", 1, None), ("deflate", 2, (64, 64)), ("deflate", 2, None), *[("deflate", 1, None)] * 12)


def text_to_tiff(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", row_bytes: int = 64, forms: tuple = FORMS) -> DataFrame:
    """Each text's UTF-8 bytes, filled up with zeros to whole rows (one at least), as a one-page grey TIFF: doc_id, n_bytes, media."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, "text"):
            n, media = [], []
            for text in texts_of(batch, "text"):
                raw = text.encode()
                n.append(len(raw))
                raw = raw.ljust(max(1, -(-len(raw) // row_bytes)) * row_bytes, b"\0")
                compression, predictor, tile = forms[zlib.crc32(raw) % len(forms)]
                media.append(encode_grey([(raw, row_bytes)], compression, predictor, tile=tile))
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("id")), pa.array(n, pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).mapInArrow(run, f"doc_id {kind}, n_bytes bigint, media binary")


def op4_tiff_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document stored as a TIFF and read back: digests of what was read and of what was stored, and features."""
    pages = tiff_pages(text_to_tiff(table(spark, sf_dir, "documents")), keep=("doc_id", "n_bytes", "media"))
    return pages.select(
        "doc_id",
        "n_bytes",
        F.octet_length("pixels").cast("bigint").alias("payload_bytes"),
        F.sha2("pixels", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(pixels, -64, 64)")).alias("tail_crc32"),
        F.octet_length("media").cast("bigint").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
    )
