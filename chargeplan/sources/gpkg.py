"""GeoPackage as a Spark data source: SQLite tables with WKB geometries, read by ranges of row ids and written by one task.

Geometry columns come as struct<type string, points array<array<struct<x, y>>>, srs int>: one ring or line in ``points`` for
each part, one point for a point. Predicates =, <, <=, >, >= and null tests on plain columns go into the SQL.
"""

from __future__ import annotations

import os
import sqlite3
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

GEOMETRY = "struct<type:string,points:array<array<struct<x:double,y:double>>>,srs:int>"
_ENVELOPE = (0, 32, 48, 48, 64)
_KINDS = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon", 7: "GeometryCollection"}


def parse_wkb(raw: bytes, at: int = 0) -> tuple[str, list[list[dict]], int]:
    """(type, parts, end) of a geometry; z and m are read over."""
    order = "<" if raw[at] == 1 else ">"
    (kind,) = struct.unpack_from(f"{order}I", raw, at + 1)
    at += 5
    extra = (kind >> 31 & 1) + (kind >> 30 & 1)
    kind &= 0x0FFFFFFF
    extra += {0: 0, 1: 1, 2: 1, 3: 2}[kind // 1000]
    kind %= 1000
    width = 2 + extra

    def line(n):
        nonlocal at
        values = struct.unpack_from(f"{order}{n * width}d", raw, at)
        at += 8 * n * width
        return [{"x": values[i], "y": values[i + 1]} for i in range(0, len(values), width)]

    def count():
        nonlocal at
        (n,) = struct.unpack_from(f"{order}I", raw, at)
        at += 4
        return n

    if kind == 1:
        return "Point", [line(1)], at
    if kind == 2:
        return "LineString", [line(count())], at
    if kind == 3:
        return "Polygon", [line(count()) for _ in range(count())], at
    parts = []
    for _ in range(count()):
        _, own, at = parse_wkb(raw, at)
        parts += own
    return _KINDS[kind], parts, at


def parse_blob(raw: bytes | None) -> dict | None:
    """A GeoPackage geometry blob: magic GP, version, flags, reference system, envelope, WKB."""
    if raw is None:
        return None
    if raw[:2] != b"GP":
        raise ValueError("not a GeoPackage geometry")
    flags = raw[3]
    (srs,) = struct.unpack_from("<i" if flags & 1 else ">i", raw, 4)
    if flags & 16:
        return {"type": "Empty", "points": [], "srs": srs}
    kind, parts, _ = parse_wkb(raw, 8 + _ENVELOPE[flags >> 1 & 7])
    return {"type": kind, "points": parts, "srs": srs}


def make_blob(geometry: dict | None) -> bytes | None:
    if geometry is None:
        return None
    kind, parts = geometry["type"], geometry["points"]
    coords = lambda p: b"".join(struct.pack("<2d", q["x"], q["y"]) for q in p)
    line = lambda p: struct.pack("<I", len(p)) + coords(p)
    head = lambda k: struct.pack("<BI", 1, k)
    if kind == "Point":
        body = head(1) + coords(parts[0][:1])
    elif kind == "LineString":
        body = head(2) + line(parts[0])
    elif kind == "Polygon":
        body = head(3) + struct.pack("<I", len(parts)) + b"".join(map(line, parts))
    elif kind == "MultiLineString":
        body = head(5) + struct.pack("<I", len(parts)) + b"".join(head(2) + line(p) for p in parts)
    elif kind == "MultiPoint":
        body = head(4) + struct.pack("<I", len(parts)) + b"".join(head(1) + coords(p) for p in parts)
    else:
        body = head(6) + struct.pack("<I", len(parts)) + b"".join(head(3) + struct.pack("<I", 1) + line(p) for p in parts)
    return b"GP" + struct.pack("<BBi", 0, 1, geometry.get("srs") or 0) + body


class Rows(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


_TYPES = (("INT", "long"), ("BOOL", "boolean"), ("REAL", "double"), ("DOUBLE", "double"), ("FLOAT", "double"), ("BLOB", "binary"))


def _connect(path: str, encoding: str | None = None) -> sqlite3.Connection:
    db = sqlite3.connect(f"file:{path}?mode=ro", uri=True)
    if encoding:
        db.text_factory = lambda raw: raw.decode(encoding)
    return db


def _layout(options: dict) -> tuple[str, list[tuple[str, str]], str | None]:
    """Layer, (column, kind) and the geometry column."""
    with _connect(options["path"]) as db:
        layers = db.execute("SELECT table_name, column_name FROM gpkg_geometry_columns ORDER BY table_name").fetchall()
        layer = options.get("layer") or layers[0][0]
        geometry = dict(layers).get(layer)
        columns = []
        for _, name, kind, *_ in db.execute(f'PRAGMA table_info("{layer}")'):
            columns.append((name, "geometry" if name == geometry else next((t for word, t in _TYPES if word in kind.upper()), "string")))
    return layer, columns, geometry


_OPS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


class GpkgReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.options, self.names, self.where, self.values = options, schema.names, [], []
        self.layer, columns, self.geometry = _layout(options)
        self.kinds = dict(columns)

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name not in self.kinds or self.kinds[name] == "geometry":
                yield f
            elif type(f) in _OPS and isinstance(f.value, (int, float, str)):
                self.where.append(f'"{name}" {_OPS[type(f)]} ?')
                self.values.append(f.value)
            elif isinstance(f, (IsNull, IsNotNull)):
                self.where.append(f'"{name}" IS {"NOT " * isinstance(f, IsNotNull)}NULL')
            else:
                yield f

    def partitions(self):
        with _connect(self.options["path"]) as db:
            low, high = db.execute(f'SELECT min(rowid), max(rowid) FROM "{self.layer}"').fetchone()
        if low is None:
            return [Rows(0, 0)]
        step = max(1, -(-(high - low + 1) // int(self.options.get("partitions", 4))))
        return [Rows(a, a + step) for a in range(low, high + 1, step)]

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        columns = ", ".join(f'"{n}"' for n in self.names)
        where = " AND ".join(["rowid >= ?", "rowid < ?", *self.where])
        geometry = pa.struct([("type", pa.string()), ("points", pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))), ("srs", pa.int32())])
        kinds = {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string(), "geometry": geometry}
        schema = pa.schema([(n, kinds[self.kinds[n]]) for n in self.names])
        with _connect(self.options["path"], self.options.get("encoding")) as db:
            found = db.execute(f'SELECT {columns} FROM "{self.layer}" WHERE {where}', [partition.low, partition.high, *self.values])
            while rows := found.fetchmany(4096):
                data = []
                for n, values in zip(self.names, zip(*rows, strict=True), strict=True):
                    kind = self.kinds[n]
                    convert = parse_blob if kind == "geometry" else (lambda v: None if v is None else bool(v)) if kind == "boolean" else (lambda v: v)
                    data.append(pa.array([convert(v) for v in values], schema.field(n).type))
                yield pa.RecordBatch.from_arrays(data, schema=schema)


class GpkgSource(DataSource):
    """Options: path, layer (the first), encoding (utf-8), partitions (4)."""

    @classmethod
    def name(cls) -> str:
        return "gpkg"

    def schema(self) -> str:
        return ", ".join(f"`{n}` {GEOMETRY if k == 'geometry' else k}" for n, k in _layout(dict(self.options))[1])

    def reader(self, schema: StructType) -> GpkgReader:
        return GpkgReader(dict(self.options), schema)


def read_gpkg(spark: SparkSession, path: str, **options) -> DataFrame:
    spark.dataSource.register(GpkgSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    reader = spark.read.format("gpkg").option("path", path)
    for k, v in options.items():
        reader = reader.option(k, str(v))
    return reader.load()


def write_gpkg(df: DataFrame, path: str, layer: str, geometry: str = "geometry", srs: int = 3035) -> None:
    """One file, rows streamed to the driver partition by partition: SQLite has one writer. For exports of bounded results."""
    kinds = {"bigint": "INTEGER", "int": "INTEGER", "double": "REAL", "float": "REAL", "boolean": "BOOLEAN", "binary": "BLOB"}
    plain = [(n, kinds.get(k, "TEXT")) for n, k in df.dtypes if n != geometry and n.lower() != "fid"]  # rows are numbered anew
    if os.path.exists(path):
        os.remove(path)
    with sqlite3.connect(path) as db:
        db.execute("PRAGMA application_id = 0x47504B47")
        db.execute("CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT, srs_id INTEGER PRIMARY KEY, organization TEXT, organization_coordsys_id INTEGER, definition TEXT, description TEXT)")
        db.execute("INSERT INTO gpkg_spatial_ref_sys VALUES (?, ?, 'EPSG', ?, 'undefined', '')", (f"EPSG:{srs}", srs, srs))
        db.execute("CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT, identifier TEXT, description TEXT, last_change TEXT, min_x REAL, min_y REAL, max_x REAL, max_y REAL, srs_id INTEGER)")
        db.execute("INSERT INTO gpkg_contents (table_name, data_type, identifier, srs_id) VALUES (?, 'features', ?, ?)", (layer, layer, srs))
        db.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT, geometry_type_name TEXT, srs_id INTEGER, z INTEGER, m INTEGER)")
        db.execute("INSERT INTO gpkg_geometry_columns VALUES (?, ?, 'GEOMETRY', ?, 0, 0)", (layer, geometry, srs))
        columns = ", ".join(f'"{n}" {k}' for n, k in plain)
        db.execute(f'CREATE TABLE "{layer}" (fid INTEGER PRIMARY KEY AUTOINCREMENT, "{geometry}" BLOB{", " * bool(plain)}{columns})')
        names = ", ".join(f'"{n}"' for n, _ in [(geometry, ""), *plain])
        insert = f'INSERT INTO "{layer}" ({names}) VALUES ({", ".join("?" * (len(plain) + 1))})'
        text = lambda v: v if v is None or isinstance(v, (int, float, str, bytes)) else str(v)
        for row in df.toLocalIterator(prefetchPartitions=True):
            db.execute(insert, [make_blob(row[geometry].asDict(recursive=True) if row[geometry] is not None else None), *[text(row[n]) for n, _ in plain]])
    db.close()
