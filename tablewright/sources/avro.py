"""Avro files as a Spark data source, for sessions without Spark's own Avro package.

    spark.dataSource.register(AvroSource)
    spark.read.format("tablewright_avro").load("/data/events")

A file is a header (schema, codec, sync marker) and blocks of records, each followed by the marker.
Large files are cut into splits of ``splitBytes`` (64 MB): a split begins at the first marker in it
and ends with the block that reaches beyond it, so tasks read a file side by side. Blocks are
decoded one at a time into Arrow batches of at most ``BATCH_ROWS`` rows.

The schema is that of the first file, or the one given to the reader: its columns are looked up by
name in every file, the others are passed over, and those a file does not have are null. Nested
records, arrays, maps, enums, fixed and logical types are read. A union with null makes a nullable
value; int with long is a long, float with double a double; any other union is a struct with a field
``member0``, ``member1``, ... for each branch. Codecs: null, deflate, snappy, bzip2, xz, zstandard.
"""

from __future__ import annotations

import bz2
import datetime
import decimal
import json
import lzma
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tablewright.sources.filesystems import data_files, resolve

MAGIC = b"Obj\x01"
SYNC_BYTES = 16
SPLIT_BYTES = 64 * 1024 * 1024
BATCH_ROWS = 10_000
_SCAN_BYTES = 1 << 20

Reader = Callable[["Cursor"], Any]


class Cursor:
    """Decoded bytes and the place reached in them."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def long(self) -> int:
        data, at = self.data, self.at
        byte = data[at]
        at += 1
        value, shift = byte & 0x7F, 7
        while byte & 0x80:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
        self.at = at
        return (value >> 1) ^ -(value & 1)

    def take(self, size: int) -> bytes:
        start = self.at
        self.at = start + size
        if self.at > len(self.data):
            raise ValueError("an Avro block ends within a value")
        return self.data[start : self.at]

    def bytes(self) -> bytes:
        return self.take(self.long())

    def number(self, form: struct.Struct) -> float:
        return form.unpack(self.take(form.size))[0]


_FLOAT, _DOUBLE = struct.Struct("<f"), struct.Struct("<d")
_EPOCH_DAY = datetime.date(1970, 1, 1).toordinal()

# Avro's primitive types, their Spark types and how their values are read.
_PRIMITIVES: dict[str, tuple[T.DataType, Reader]] = {
    "null": (T.NullType(), lambda c: None),
    "boolean": (T.BooleanType(), lambda c: c.take(1) != b"\0"),
    "int": (T.IntegerType(), Cursor.long),
    "long": (T.LongType(), Cursor.long),
    "float": (T.FloatType(), lambda c: c.number(_FLOAT)),
    "double": (T.DoubleType(), lambda c: c.number(_DOUBLE)),
    "bytes": (T.BinaryType(), Cursor.bytes),
    "string": (T.StringType(), lambda c: c.bytes().decode()),
}


@dataclass(frozen=True)
class Decoder:
    """Spark type of an Avro type, and how a value is read; passing over is reading and forgetting."""

    kind: T.DataType
    read: Reader
    nullable: bool = False


def decoder(schema: Any, known: dict[str, Any] | None = None, space: str = "", wanted: T.DataType | None = None) -> Decoder:
    """Decoder of an Avro schema; ``wanted`` leaves out the record fields it does not name."""
    known = {} if known is None else known
    if isinstance(schema, list):
        return _union(schema, known, space, wanted)
    if isinstance(schema, str):
        if schema in _PRIMITIVES:
            return Decoder(*_PRIMITIVES[schema])
        name = schema if schema in known else f"{space}.{schema}"
        if name not in known:
            raise ValueError(f"the Avro schema names an unknown type {schema!r}")
        if known[name] is None:
            raise ValueError(f"the Avro type {name!r} contains itself, which no table column can")
        return decoder(*known[name], wanted)
    kind = schema["type"]
    if isinstance(kind, (dict, list)):
        return decoder(kind, known, space, wanted)
    if kind in ("record", "error", "enum", "fixed"):
        name, space = _full_name(schema, space)
        known[name] = None
        made = _record(schema, known, space, wanted) if kind in ("record", "error") else _named(schema)
        known[name] = (schema, dict(known), space)
        return made
    if kind == "array":
        element = wanted.elementType if isinstance(wanted, T.ArrayType) else None
        item = decoder(schema["items"], known, space, element)
        return Decoder(T.ArrayType(item.kind, item.nullable), lambda c: _blocks(c, item.read))
    if kind == "map":
        value = decoder(schema["values"], known, space, wanted.valueType if isinstance(wanted, T.MapType) else None)
        pair = _pair(value.read)
        return Decoder(T.MapType(T.StringType(), value.kind, value.nullable), lambda c: _blocks(c, pair))
    return _logical(schema, decoder(kind, known, space, wanted))


def _full_name(schema: dict, space: str) -> tuple[str, str]:
    name = schema["name"]
    if "." in name:
        return name, name.rpartition(".")[0]
    space = schema.get("namespace", space)
    return (f"{space}.{name}" if space else name), space


def _named(schema: dict) -> Decoder:
    if schema["type"] == "enum":
        symbols = list(schema["symbols"])
        return Decoder(T.StringType(), lambda c: symbols[c.long()])
    size = int(schema["size"])
    return _logical(schema, Decoder(T.BinaryType(), lambda c: c.take(size)))


def _pair(value: Reader) -> Reader:
    return lambda c: (c.bytes().decode(), value(c))


def _blocks(c: Cursor, read: Reader) -> list:
    """Items come in blocks with their number; a negative one is followed by the block's bytes."""
    items = []
    while count := c.long():
        if count < 0:
            count = -count
            c.long()
        items += [read(c) for _ in range(count)]
    return items


def _record(schema: dict, known: dict, space: str, wanted: T.DataType | None) -> Decoder:
    named = {f.name: f.dataType for f in wanted.fields} if isinstance(wanted, T.StructType) else None
    steps, fields = [], []
    for field in schema["fields"]:
        name = field["name"]
        kept = named is None or name in named
        one = decoder(field["type"], known, space, named.get(name) if named else None)
        steps.append((name if kept else None, one.read))
        if kept:
            fields.append(T.StructField(name, one.kind, one.nullable))

    def read(c: Cursor) -> dict:
        row = {}
        for name, step in steps:
            value = step(c)
            if name is not None:
                row[name] = value
        return row

    return Decoder(T.StructType(fields), read)


def _union(branches: list, known: dict, space: str, wanted: T.DataType | None) -> Decoder:
    real = [b for b in branches if b != "null"]
    nullable = len(real) < len(branches)
    if not real:
        return Decoder(T.NullType(), lambda c: c.long() and None, True)
    if len(real) == 1:
        one = decoder(real[0], known, space, wanted)
        readers = [one.read if b != "null" else (lambda c: None) for b in branches]
        return Decoder(one.kind, lambda c: readers[c.long()](c), nullable)
    for pair, wide in (({"int", "long"}, "long"), ({"float", "double"}, "double")):
        if all(isinstance(b, str) for b in real) and set(real) == pair:
            readers = [_PRIMITIVES[b][1] for b in branches]
            return Decoder(_PRIMITIVES[wide][0], lambda c: readers[c.long()](c), nullable)
    parts = [decoder(b, known, space) for b in real]
    members = iter(range(len(real)))
    places = [None if b == "null" else next(members) for b in branches]

    def read(c: Cursor) -> dict | None:
        place = places[c.long()]
        return None if place is None else {f"member{place}": parts[place].read(c)}

    fields = [T.StructField(f"member{i}", part.kind, True) for i, part in enumerate(parts)]
    return Decoder(T.StructType(fields), read, nullable)


def _logical(schema: dict, base: Decoder) -> Decoder:
    """Logical types; one that does not fit its base type is ignored, as the format asks."""
    name, read = schema.get("logicalType"), base.read
    if name == "date" and base.kind == T.IntegerType():
        return Decoder(T.DateType(), lambda c: datetime.date.fromordinal(read(c) + _EPOCH_DAY))
    if base.kind == T.LongType() and name in _TIMES:
        kind, factor = _TIMES[name]
        return Decoder(kind, lambda c: read(c) * factor)  # microseconds, which is what Arrow takes
    if name == "decimal" and base.kind == T.BinaryType() and 0 < schema.get("precision", 0) <= 38:
        precision, scale = schema["precision"], schema.get("scale", 0)

        def unscaled(c: Cursor) -> decimal.Decimal:
            return decimal.Decimal(int.from_bytes(read(c), "big", signed=True)).scaleb(-scale)

        return Decoder(T.DecimalType(precision, scale), unscaled)
    return base


# Logical types of points in time, with their Spark types and microseconds.
_TIMES = {
    "timestamp-millis": (T.TimestampType(), 1000), "timestamp-micros": (T.TimestampType(), 1),
    "local-timestamp-millis": (T.TimestampNTZType(), 1000), "local-timestamp-micros": (T.TimestampNTZType(), 1),
}


# --- container files --------------------------------------------------------------------


def _snappy(data: bytes) -> bytes:
    """A raw snappy block begins with the length of its content; a checksum follows it."""
    size = shift = 0
    for byte in data:
        size |= (byte & 0x7F) << shift
        shift += 7
        if byte < 0x80:
            break
    content = pa.decompress(data[:-4], decompressed_size=size, codec="snappy", asbytes=True)
    if zlib.crc32(content) != int.from_bytes(data[-4:], "big"):
        raise ValueError("an Avro block does not fit its checksum")
    return content


def _zstandard(data: bytes) -> bytes:
    return pa.CompressedInputStream(pa.BufferReader(data), "zstd").read()


# Codec names of the format.
_CODECS: dict[str, Callable[[bytes], bytes]] = {
    "null": lambda data: data, "deflate": lambda data: zlib.decompress(data, -15), "snappy": _snappy,
    "bzip2": bz2.decompress, "xz": lzma.decompress, "zstandard": _zstandard,
}


@dataclass(frozen=True)
class Header:
    schema: Any
    codec: str
    sync: bytes
    size: int


def read_header(file) -> Header:
    """Header of an open file."""
    file.seek(0)
    data = file.read(_SCAN_BYTES)
    while True:
        try:
            return _header(data)
        except (IndexError, ValueError) as error:
            more = file.read(len(data))
            if not more or not data.startswith(MAGIC):
                raise ValueError("not an Avro file, or its header is cut off") from error
            data += more


def _header(data: bytes) -> Header:
    c = Cursor(data)
    if c.take(len(MAGIC)) != MAGIC:
        raise ValueError("not an Avro file")
    facts = dict(_blocks(c, _pair(Cursor.bytes)))
    sync = c.take(SYNC_BYTES)
    codec = facts.get("avro.codec", b"null").decode()
    if codec not in _CODECS:
        raise ValueError(f"the Avro codec {codec!r} is not known")
    return Header(json.loads(facts["avro.schema"]), codec, sync, c.at)


def blocks(file, header: Header, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """Row number and content of the blocks that begin in ``[start, end)``."""
    at = header.size if start <= header.size else _next_block(file, header.sync, start)
    while at is not None and at < end:
        file.seek(at)
        lead = file.read(20)
        if not lead:
            return
        c = Cursor(lead)
        rows, size = c.long(), c.long()
        file.seek(at + c.at)
        content = file.read(size)
        if len(content) < size or file.read(SYNC_BYTES) != header.sync:
            raise ValueError("an Avro block is cut off or not followed by the sync marker")
        yield rows, _CODECS[header.codec](content)
        at += c.at + size + SYNC_BYTES


def _next_block(file, sync: bytes, start: int) -> int | None:
    """Place behind the first sync marker that ends at or after ``start``."""
    at = start - SYNC_BYTES
    held = b""
    file.seek(at)
    while data := file.read(_SCAN_BYTES):
        held += data
        found = held.find(sync)
        if found >= 0:
            return at + found + SYNC_BYTES
        at += len(held) - SYNC_BYTES + 1
        held = held[1 - SYNC_BYTES :]
    return None


# --- the data source --------------------------------------------------------------------


def spark_schema(schema: Any) -> T.StructType:
    """Spark schema of an Avro schema; one that is not a record is a column ``value``."""
    made = decoder(schema)
    if isinstance(made.kind, T.StructType):
        return made.kind
    return T.StructType([T.StructField("value", made.kind, made.nullable)])


def arrow_type(kind: T.DataType) -> pa.DataType:
    """Arrow type that Spark reads as ``kind``."""
    if isinstance(kind, T.StructType):
        return pa.struct([pa.field(f.name, arrow_type(f.dataType), f.nullable) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return pa.list_(arrow_type(kind.elementType))
    if isinstance(kind, T.MapType):
        return pa.map_(pa.string(), arrow_type(kind.valueType))
    if isinstance(kind, T.DecimalType):
        return pa.decimal128(kind.precision, kind.scale)
    return _ARROW[type(kind)]


# Arrow types of Spark types.
_ARROW = {
    T.NullType: pa.null(), T.BooleanType: pa.bool_(), T.IntegerType: pa.int32(), T.LongType: pa.int64(),
    T.FloatType: pa.float32(), T.DoubleType: pa.float64(), T.BinaryType: pa.binary(), T.StringType: pa.string(),
    T.DateType: pa.date32(), T.TimestampType: pa.timestamp("us", "UTC"), T.TimestampNTZType: pa.timestamp("us"),
}


def record_batches(
    contents: Iterator[tuple[int, bytes]], schema: Any, wanted: T.StructType
) -> Iterator[pa.RecordBatch]:
    """Rows of decoded blocks as batches with the columns of ``wanted``."""
    made = decoder(schema, wanted=wanted)
    plain = not isinstance(made.kind, T.StructType)
    kinds = {f.name: arrow_type(f.dataType) for f in wanted.fields}
    own = {} if plain else {f.name for f in made.kind.fields}
    rows: list = []

    def batch() -> pa.RecordBatch:
        columns = []
        for name, kind in kinds.items():
            values = rows if plain else [row[name] for row in rows] if name in own else [None] * len(rows)
            columns.append(pa.array(values, kind))
        return pa.RecordBatch.from_arrays(columns, names=list(kinds))

    for count, content in contents:
        c = Cursor(content)
        for _ in range(count):
            rows.append(made.read(c))
            if len(rows) == BATCH_ROWS:
                yield batch()
                rows.clear()
    if rows:
        yield batch()


@dataclass
class Split(InputPartition):
    path: str
    start: int
    end: int


class AvroSource(DataSource):
    """Options: ``path``; ``splitBytes``, the size of a split; ``pathEnding``, by default ``.avro``."""

    @classmethod
    def name(cls) -> str:
        return "tablewright_avro"

    def _files(self) -> list[tuple[str, int]]:
        files = data_files(self.options["path"], tuple(self.options.get("pathEnding", ".avro").split(",")))
        if not files:
            raise FileNotFoundError(f"no avro file in: {self.options['path']}")
        return files

    def schema(self) -> T.StructType:
        system, inside = resolve(self._files()[0][0])
        with system.open_input_file(inside) as file:
            return spark_schema(read_header(file).schema)

    def reader(self, schema: T.StructType) -> AvroReader:
        return AvroReader(self._files(), schema, int(self.options.get("splitBytes", SPLIT_BYTES)))


class AvroReader(DataSourceReader):
    def __init__(self, files: list[tuple[str, int]], schema: T.StructType, split_bytes: int):
        self.files, self.schema, self.split_bytes = files, schema, max(1, split_bytes)

    def partitions(self) -> list[Split]:
        return [
            Split(path, start, min(start + self.split_bytes, size))
            for path, size in self.files
            for start in range(0, size, self.split_bytes)
        ]

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        system, inside = resolve(partition.path)
        with system.open_input_file(inside) as file:
            header = read_header(file)
            found = blocks(file, header, partition.start, partition.end)
            yield from record_batches(found, header.schema, self.schema)
