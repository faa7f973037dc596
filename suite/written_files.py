"""Avro and Excel files made by Spark tasks from the supplied tables, as inputs of the readers."""

from __future__ import annotations

import json
import struct
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from io import BytesIO
from uuid import uuid4
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame

from tablewright.sources.filesystems import resolve

_BOOK = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_RELATIONS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def zigzag(value: int) -> bytes:
    value = (value << 1) ^ (value >> 63)
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    out.append(value)
    return bytes(out)


def _sized(data: bytes) -> bytes:
    return zigzag(len(data)) + data


def encoded(schema, value) -> bytes:
    """A value in Avro's binary form; unions take ``(branch, value)``, or None for their null."""
    if isinstance(schema, list):
        branch, inner = (schema.index("null"), None) if value is None else value
        return zigzag(branch) + encoded(schema[branch], inner)
    kind = schema["type"] if isinstance(schema, dict) else schema
    if kind == "record":
        return b"".join(encoded(f["type"], value[f["name"]]) for f in schema["fields"])
    if kind == "array":
        return (zigzag(len(value)) + b"".join(encoded(schema["items"], v) for v in value) if value else b"") + b"\0"
    if kind == "map":
        pairs = b"".join(_sized(k.encode()) + encoded(schema["values"], v) for k, v in value.items())
        return (zigzag(-len(value)) + _sized(pairs) if value else b"") + b"\0"
    if kind == "enum":
        return zigzag(schema["symbols"].index(value))
    simple = {
        "null": lambda v: b"", "boolean": lambda v: bytes([v]), "int": zigzag, "long": zigzag, "bytes": _sized,
        "float": struct.Struct("<f").pack, "double": struct.Struct("<d").pack, "string": lambda v: _sized(v.encode()),
        "fixed": bytes,
    }
    return simple[kind](value)


def avro_file(schema, rows: Iterable, codec: str = "deflate", block_rows: int = 500) -> bytes:
    """An Avro container file."""
    pack = {"null": bytes, "deflate": lambda data: zlib.compress(data, 6, -15)}[codec]
    sync = uuid4().bytes
    facts = {"avro.schema": json.dumps(schema).encode(), "avro.codec": codec.encode()}
    head = b"".join(_sized(k.encode()) + _sized(v) for k, v in facts.items())
    out = [b"Obj\x01", zigzag(len(facts)), head, b"\0", sync]
    rows = [encoded(schema, row) for row in rows]
    for at in range(0, len(rows), block_rows):
        some = rows[at : at + block_rows]
        out += [zigzag(len(some)), _sized(pack(b"".join(some))), sync]
    return b"".join(out)


def xlsx_file(rows: Iterable[list], sheet: str = "Sheet1", first_row: int = 1, first_column: int = 0) -> bytes:
    """A workbook with one sheet; texts are shared strings, floats and ints numbers."""
    strings: dict[str, int] = {}

    def cell(place: str, value) -> str:
        if value is None:
            return ""
        if isinstance(value, bool):
            return f'<c r="{place}" t="b"><v>{int(value)}</v></c>'
        if isinstance(value, (int, float)):
            return f'<c r="{place}"><v>{value!r}</v></c>'
        return f'<c r="{place}" t="s"><v>{strings.setdefault(value, len(strings))}</v></c>'

    lines = []
    for r, row in enumerate(rows, first_row):
        cells = "".join(cell(f"{chr(65 + first_column + i)}{r}", value) for i, value in enumerate(row))
        lines.append(f'<row r="{r}">{cells}</row>')
    shared = "".join(f'<si><t xml:space="preserve">{escape(text)}</t></si>' for text in strings)
    parts = {
        "xl/workbook.xml": f'<workbook xmlns="{_BOOK}" xmlns:r="{_RELATIONS}"><sheets>'
        f'<sheet name="{escape(sheet)}" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        f'<Relationship Id="rId1" Type="{_RELATIONS}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{_BOOK}"><sheetData>{"".join(lines)}</sheetData></worksheet>',
        "xl/sharedStrings.xml": f'<sst xmlns="{_BOOK}">{shared}</sst>',
    }
    out = BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in parts.items():
            archive.writestr(name, text)
    return out.getvalue()


def write_files(df: DataFrame, path: str, ending: str, make, rows_a_file: int = 50_000) -> str:
    """Write ``make(names, rows)`` for every ``rows_a_file`` rows of each partition below ``path``."""
    names = df.columns

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, inside = resolve(path)
        system.create_dir(inside, recursive=True)
        held = pd.DataFrame(columns=names)
        for frame in [*frames, None]:
            held = held if frame is None else pd.concat([held, frame]) if len(held) else frame
            while len(held) >= rows_a_file or (frame is None and len(held)):
                some, held = held.iloc[:rows_a_file], held.iloc[rows_a_file:]
                rows = [[None if pd.isna(v) else v for v in row] for row in some.itertuples(index=False, name=None)]
                with system.open_output_stream(f"{inside}/part-{uuid4().hex}{ending}") as file:
                    file.write(make(names, rows))
                yield pd.DataFrame({"n": [len(rows)]})

    df.mapInPandas(write, "n long").agg({"n": "sum"}).collect()
    return path
