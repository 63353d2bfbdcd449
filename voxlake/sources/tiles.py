"""Image planes by REST as a Python data source, one partition a plane and tile, and PNG stacks."""

from __future__ import annotations

import json
import struct
import urllib.error
import urllib.parse
import urllib.request
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .tiff import decode_tiff


def decode_png(data: bytes) -> np.ndarray:
    """Height x width (x channels) of an 8- or 16-bit PNG without interlace or palette."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG file")
    at, body, head = 8, b"", None
    while at < len(data):
        size, name = struct.unpack(">I4s", data[at : at + 8])
        chunk = data[at + 8 : at + 8 + size]
        if name == b"IHDR":
            head = struct.unpack(">IIBBBBB", chunk)
        elif name == b"IDAT":
            body += chunk
        at += 12 + size
    width, height, depth, colour, _, _, interlace = head
    channels = {0: 1, 2: 3, 4: 2, 6: 4}.get(colour)
    if channels is None or interlace or depth not in (8, 16):
        raise ValueError("unsupported PNG")
    step = channels * depth // 8
    raw = np.frombuffer(zlib.decompress(body), np.uint8).reshape(height, 1 + width * step)
    out = np.zeros((height, width * step), np.uint8)
    above = np.zeros(width * step, np.uint8)
    for i, line in enumerate(raw):
        kind, row = line[0], line[1:]
        if kind == 0:
            above = row
        elif kind == 2:
            above = row + above
        elif kind == 1:
            above = np.add.accumulate(row.reshape(-1, step), axis=0, dtype=np.uint8).ravel()
        else:
            now = np.zeros_like(row)
            for k in range(len(row)):
                a, b = int(now[k - step]) if k >= step else 0, int(above[k])
                c = int(above[k - step]) if k >= step else 0
                if kind == 3:
                    guess = (a + b) // 2
                else:
                    p = a + b - c
                    guess = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
                now[k] = (int(row[k]) + guess) & 0xFF
            above = now
        out[i] = above
    pixels = out.view(">u2").astype(np.uint16) if depth == 16 else out
    return pixels.reshape(height, width, channels)[..., 0] if channels == 1 else pixels.reshape(height, width, channels)


def encode_png(pixels: np.ndarray) -> bytes:
    """An 8- or 16-bit PNG of one or three channels."""
    depth, colour = pixels.dtype.itemsize * 8, 2 if pixels.ndim == 3 else 0
    flat = pixels.astype(pixels.dtype.newbyteorder(">")).reshape(pixels.shape[0], -1).view(np.uint8)
    body = zlib.compress(np.hstack([np.zeros((len(flat), 1), np.uint8), flat]).tobytes())
    chunk = lambda name, x: struct.pack(">I", len(x)) + name + x + struct.pack(">I", zlib.crc32(name + x))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", pixels.shape[1], pixels.shape[0], depth, colour, 0, 0, 0)) + chunk(b"IDAT", body) + chunk(b"IEND", b"")


def unpack_labels(pixels: np.ndarray) -> np.ndarray:
    """Labels from three channels: first + 256 second + 65536 third."""
    return pixels.astype(np.int64) if pixels.ndim == 2 else pixels[..., 0] + 256 * pixels[..., 1].astype(np.int64) + 65536 * pixels[..., 2].astype(np.int64)


def read_png_stack(spark: SparkSession, path: str, *, glob: str = "*.png") -> DataFrame:
    """(z, y, x, value) of PNG planes whose names hold x_y_z, as 0001_0002_0003.png."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    return png_voxels(files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content"))


def png_voxels(planes: DataFrame) -> DataFrame:
    """(z, y, x, value) of PNG tiles (name, content) whose names end in x_y_z."""
    place = r"(\d+)_(\d+)_(\d+)\.png$"
    named = planes.where(F.col("name").rlike(place)).select(*[F.regexp_extract("name", place, i + 1).cast("long").alias(c) for i, c in enumerate("xyz")], "content")

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                v = unpack_labels(decode_png(row["content"]))
                y, x = np.indices(v.shape)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(v.size, row["z"])), pa.array(y.ravel() + row["y"]), pa.array(x.ravel() + row["x"]), pa.array(v.ravel().astype(np.int64))], names=["z", "y", "x", "value"])

    return named.mapInArrow(run, "z long, y long, x long, value long")


#: Voxels in an Arrow batch.
BATCH = 1 << 18


class PlaneTile(InputPartition):
    def __init__(self, z: int, y: int, x: int, height: int, width: int):
        self.z, self.y, self.x, self.height, self.width = z, y, x, height, width


class TileReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[PlaneTile]:
        """Of the box that the options name; what they leave out is the channel's extent as the server tells it."""
        names = ("x", "y", "z", "width", "height", "depth")
        told = {} if all(n in self.options for n in names) else channel_extent(self.options["url"], self.options["channel"])
        x, y, z, w, h, d = (int(self.options[n] if n in self.options else told.get(n, 0)) for n in names)
        side = int(self.options.get("tile", 2048))
        return [PlaneTile(k, j, i, min(side, y + h - j), min(side, x + w - i)) for k in range(z, z + d) for j in range(y, y + h, side) for i in range(x, x + w, side)]

    def read(self, part: PlaneTile):
        keys = ("experiment", "sample", "dataset", "channel", "resolution")
        query = {k: self.options[k] for k in keys if k in self.options}
        query |= {"x": part.x, "y": part.y, "z": part.z, "width": part.width, "height": part.height, "format": self.options.get("format", "png"), "view": "grayscale"}
        with urllib.request.urlopen(f"{self.options['url'].rstrip('/')}/data?{urllib.parse.urlencode(query)}", timeout=float(self.options.get("timeout", 60))) as got:  # an HTTP error raises
            body = got.read()
        v = decode_tiff(body)[0] if query["format"] in ("tif", "tiff") else unpack_labels(decode_png(body))
        y, x = (a.ravel() for a in np.indices(v.shape))
        for k in range(0, v.size, BATCH):
            cells = [np.full(len(y[k : k + BATCH]), part.z), part.y + y[k : k + BATCH], part.x + x[k : k + BATCH], v.ravel()[k : k + BATCH].astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], names=["z", "y", "x", "value"])


class TileSource(DataSource):
    """spark.read.format("voxel-tiles").option("url", ...).option("x", ...)...: voxels of a channel's box, one partition a plane and tile, as PNG or (format: tif) TIFF."""

    @classmethod
    def name(cls) -> str:
        return "voxel-tiles"

    def schema(self) -> str:
        return "z long, y long, x long, value long"

    def reader(self, schema) -> TileReader:
        return TileReader(dict(self.options))


def channel_extent(url: str, channel: str) -> dict:
    """A channel's metadata (extents and data type) as the server tells it."""
    with urllib.request.urlopen(f"{url.rstrip('/')}/channel?{urllib.parse.urlencode({'channel': channel})}", timeout=60) as got:
        return json.loads(got.read())


def local_extent(index: dict) -> tuple[int, int, int]:
    """Width, height and depth of a local tile channel's JSON index."""
    return index["n_columns"] * index["tile_width"], index["n_rows"] * index["tile_height"], len(index["sections"])
