"""Python data sources for rasters, polygons and paged JSON, without native libraries.

``register(spark)`` makes three formats known: ``raster`` reads and writes GeoTIFF (striped,
uncompressed or deflate, geographic or projected), a row for each band and strip or, with
``metadata``, for each file; ``polygons`` reads shapes of type polygon; ``json_pages`` follows
``next`` links between files.
"""

from __future__ import annotations

import glob
import json
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from rasterloom.session import ship_package

RASTER = "path string, event string, band int, row0 int, w int, h int, bands int, minx double, maxy double, res_x double, res_y double, nodata double, data array<float>"
_TYPES = {1: ("B", 1), 2: ("s", 1), 3: ("H", 2), 4: ("I", 4), 12: ("d", 8), 16: ("Q", 8)}


def read_tags(raw: bytes) -> dict[int, tuple]:
    """The first directory of a TIFF file."""
    e = {b"II": "<", b"MM": ">"}[raw[:2]]
    if struct.unpack_from(e + "H", raw, 2)[0] != 42:
        raise ValueError("not a classic TIFF file")
    at = struct.unpack_from(e + "I", raw, 4)[0]
    out = {0: (e,)}
    for k in range(struct.unpack_from(e + "H", raw, at)[0]):
        tag, kind, n = struct.unpack_from(e + "HHI", raw, at + 2 + 12 * k)
        if kind not in _TYPES:
            continue
        code, size = _TYPES[kind]
        where = at + 2 + 12 * k + 8
        if n * size > 4:
            where = struct.unpack_from(e + "I", raw, where)[0]
        out[tag] = (raw[where : where + n],) if code == "s" else struct.unpack_from(f"{e}{n}{code}", raw, where)
    return out


def layout(tags: dict[int, tuple]) -> dict:
    scale, tie = tags.get(33550, (1.0, 1.0, 0.0)), tags.get(33922, (0.0,) * 6)
    nodata = tags.get(42113, (b"",))[0].split(b"\0")[0].strip()
    return {"w": tags[256][0], "h": tags[257][0], "bands": tags.get(277, (1,))[0], "minx": float(tie[3] - tie[0] * scale[0]), "maxy": float(tie[4] + tie[1] * scale[1]), "res_x": float(scale[0]), "res_y": float(scale[1]), "nodata": float(nodata) if nodata else None}


def strips(raw: bytes, tags: dict[int, tuple]) -> Iterator[tuple[int, int, np.ndarray]]:
    """``band, first row, values`` of each strip."""
    x = layout(tags)
    bits, kind, per, planar = tags[258][0], tags.get(339, (1,))[0], tags.get(278, (x["h"],))[0], tags.get(284, (1,))[0]
    dtype = np.dtype(tags[0][0] + {(32, 3): "f4", (64, 3): "f8", (8, 1): "u1", (16, 1): "u2", (16, 2): "i2", (32, 1): "u4", (32, 2): "i4"}[bits, kind])
    if tags.get(259, (1,))[0] not in (1, 8, 32946) or tags.get(317, (1,))[0] != 1 or 273 not in tags:
        raise ValueError("only striped files without compression or with deflate and no predictor are read")
    each = -(-x["h"] // per)
    for k, (at, n) in enumerate(zip(tags[273], tags[279])):
        part = raw[at : at + n]
        if tags.get(259, (1,))[0] != 1:
            part = zlib.decompress(part)
        row0 = (k % each) * per
        rows = min(per, x["h"] - row0)
        a = np.frombuffer(part, dtype)
        if planar == 2 or x["bands"] == 1:
            yield k // each + 1, row0, a[: rows * x["w"]]
        else:
            for b in range(x["bands"]):
                yield b + 1, row0, a[: rows * x["w"] * x["bands"]].reshape(-1, x["bands"])[:, b]


def write_tiff(path: str, bands: np.ndarray, minx: float, maxy: float, res_x: float, res_y: float, nodata: float | None, epsg: int = 4326) -> None:
    """``bands`` is (band, row, column), float32 or uint8; one deflate strip for each band, under another name until it is whole."""
    n, h, w = bands.shape
    kind = 3 if bands.dtype.kind == "f" else 1
    data = [zlib.compress(np.ascontiguousarray(b).astype(b.dtype.newbyteorder("<")).tobytes()) for b in bands]
    at, offsets = 8, []
    for d in data:
        offsets.append(at)
        at += len(d)
    code = 3072 if epsg != 4326 else 2048
    keys = (1, 1, 0, 2, 1024, 0, 1, 1 if epsg != 4326 else 2, code, 0, 1, epsg)
    tags = [(256, 4, (w,)), (257, 4, (h,)), (258, 3, (bands.itemsize * 8,) * n), (259, 3, (8,)), (262, 3, (1,)), (273, 4, tuple(offsets)), (277, 3, (n,)), (278, 4, (h,)), (279, 4, tuple(map(len, data))), (284, 3, (2,)), (339, 3, (kind,) * n)]
    tags += [(33550, 12, (res_x, res_y, 0.0)), (33922, 12, (0.0, 0.0, 0.0, minx, maxy, 0.0)), (34735, 3, keys)]
    if nodata is not None:
        tags.append((42113, 2, f"{nodata:g}".encode() + b"\0"))
    body, extra = b"", b""
    base = at + 2 + 12 * len(tags) + 4
    for tag, t, v in tags:
        raw = v if t == 2 else struct.pack(f"<{len(v)}{_TYPES[t][0]}", *v)
        count = len(v)
        if len(raw) > 4:
            body += struct.pack("<HHII", tag, t, count, base + len(extra))
            extra += raw + b"\0" * (len(raw) % 2)
        else:
            body += struct.pack("<HHI", tag, t, count) + raw.ljust(4, b"\0")
    part = f"{path}.part"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(part, "wb") as f:
        f.write(struct.pack("<2sHI", b"II", 42, at) + b"".join(data) + struct.pack("<H", len(tags)) + body + b"\0" * 4 + extra)
    os.replace(part, path)


def _files(options: dict, pattern: str) -> list[str]:
    path = options["path"].removeprefix("file://")
    return sorted(glob.glob(os.path.join(path, "**", pattern), recursive=True)) if os.path.isdir(path) else sorted(glob.glob(path))


class _File(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options: dict, pattern: str, rows) -> None:
        self.options, self.pattern, self.rows = dict(options), pattern, rows

    def partitions(self) -> list[InputPartition]:
        return [_File(p) for p in _files(self.options, self.pattern)] or [_File("")]

    def read(self, partition: _File) -> Iterator[tuple]:
        if partition.path:
            yield from self.rows(partition.path, self.options)


def raster_rows(path: str, options: dict) -> Iterator[tuple]:
    """Damaged files give one row with zero bands, so that a check can find them."""
    event = os.path.basename(os.path.dirname(path))
    try:
        with open(path, "rb") as f:
            raw = f.read()
        tags = read_tags(raw)
        x = layout(tags)
    except (ValueError, KeyError, struct.error):
        yield (path, event, 0, 0, 0, 0, 0, None, None, None, None, None, None)
        return
    place = (x["w"], x["h"], x["bands"], x["minx"], x["maxy"], x["res_x"], x["res_y"], x["nodata"])
    if options.get("metadata", "false").lower() == "true":
        yield (path, event, 0, 0, *place, None)
        return
    for band, row0, values in strips(raw, tags):
        yield (path, event, band, row0, *place, values.astype(float).tolist())


class RasterSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "raster"

    def schema(self) -> str:
        return RASTER

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options, "*.tif", raster_rows)

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return RasterWriter(dict(self.options))


class RasterWriter(DataSourceWriter):
    """Rows ``name, bands, h, w, minx, maxy, res_x, res_y, nodata, mask, data`` to one file each; ``data`` is band by band."""

    def __init__(self, options: dict) -> None:
        self.path = options["path"].removeprefix("file://")

    def write(self, rows: Iterator) -> WriterCommitMessage:
        for r in rows:
            a = np.array(r.data, np.float32).reshape(r.bands, r.h, r.w)
            write_tiff(os.path.join(self.path, f"{r.name}.tif"), a.astype(np.uint8) if r.mask else a, r.minx, r.maxy, r.res_x, r.res_y, None if r.mask else r.nodata)
        return WriterCommitMessage()


def shape_rows(path: str, options: dict) -> Iterator[tuple]:
    """``path, poly_id, rings``, with ids from a number field of the attribute table if ``id`` names one, else the record's number."""
    ids = None
    if field := options.get("id"):
        with open(os.path.splitext(path)[0] + ".dbf", "rb") as f:
            d = f.read()
        n, head, size = struct.unpack_from("<IHH", d, 4)
        at = 1
        for k in range((head - 33) // 32):
            name, width = d[32 + 32 * k : 43 + 32 * k].split(b"\0")[0].decode(), d[48 + 32 * k]
            if name == field:
                ids = [int(float(d[head + size * j + at : head + size * j + at + width].decode().strip() or -1)) for j in range(n)]
            at += width
    with open(path, "rb") as f:
        raw = f.read()
    at, k = 100, 0
    while at < len(raw):
        size = struct.unpack_from(">I", raw, at + 4)[0] * 2
        rings = []
        if struct.unpack_from("<I", raw, at + 8)[0] in (5, 15, 25):
            parts, points = struct.unpack_from("<II", raw, at + 44)
            starts = [*struct.unpack_from(f"<{parts}I", raw, at + 52), points]
            xy = np.frombuffer(raw, "<f8", points * 2, at + 52 + 4 * parts).reshape(-1, 2).tolist()
            rings = [[(x, y) for x, y in xy[a:b]] for a, b in zip(starts, starts[1:])]
        yield (path, ids[k] if ids else k, rings)
        at, k = at + 8 + size, k + 1


class PolygonSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "polygons"

    def schema(self) -> str:
        return "path string, poly_id long, rings array<array<struct<x:double,y:double>>>"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options, "*.shp", shape_rows)


def page_rows(path: str, options: dict) -> Iterator[tuple]:
    """Pages from the first file on, each page's ``next`` naming the file after it; a page that can't be read ends the listing."""
    seen, page = set(), 0
    while path and path not in seen:
        seen.add(path)
        try:
            with open(path, encoding="utf-8") as f:
                body = f.read()
            after = json.loads(body).get("next")
        except (OSError, ValueError):
            return
        yield (page, path, body)
        path, page = os.path.join(os.path.dirname(path), after) if after else "", page + 1


class PageSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "json_pages"

    def schema(self) -> str:
        return "page int, path string, body string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options, "page_0.json", page_rows)


def register(spark: SparkSession) -> None:
    """Make the three formats known to a session and their code to its workers."""
    ship_package(spark)
    for s in (RasterSource, PolygonSource, PageSource):
        spark.dataSource.register(s)


def listing(spark: SparkSession, path: str, pattern: str = "*.tif"):
    """``folder_name, name, length`` of the files below ``path``, empty ones included, which Spark's own file sources skip.

    Names and sizes come from the file system's listing, as in Spark's file index; no
    file is opened.
    """
    from fnmatch import fnmatch

    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    found, rows = root.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(root, True), []
    while found.hasNext():
        f = found.next()
        name = f.getPath().getName()
        if fnmatch(name, pattern):
            rows.append((f.getPath().getParent().getName(), name, f.getLen()))
    return spark.createDataFrame(rows, "folder_name string, name string, length long")
