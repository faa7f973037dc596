"""Excel workbooks (xlsx) as a Spark data source, for sessions without an Excel package.

    spark.dataSource.register(ExcelSource)
    spark.read.format("tablewright_excel").option("header", True).load("/data/prices")

A workbook is a zip archive: the sheet is streamed row by row out of it, its shared strings are read
beforehand. Archives can not be entered in the middle, so a file is a task; a sheet has at most
1,048,576 rows. Options:

* ``header`` (false): the first row of the range names the columns, else ``_c0``, ``_c1``, ...;
* ``dataAddress`` (``A1``): ``'Sheet name'!B2`` or ``B2:D90``, where the range begins and may end.
  Without a sheet it is the first one; without an end it goes on to the last cell of its first row;
* ``inferSchema`` (false): types from all rows of the first file. Else every column is text.

Rows without any value in the range are left out, empty cells are null. As text, whole numbers have
no decimal point and dates are ``yyyy-MM-dd`` or ``yyyy-MM-dd HH:mm:ss``. With a schema given to the
reader, columns are found by name under a header and by place without one; values that do not fit
are null. Old binary workbooks (xls) are refused.
"""

from __future__ import annotations

import datetime
import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from typing import Any
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tablewright.sources.avro import arrow_type
from tablewright.sources.filesystems import data_files, resolve

BATCH_ROWS = 10_000

# XML name spaces, and the built-in number formats that show dates.
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
_TIME_FORMATS = {*range(18, 23), *range(45, 48)}


@dataclass(frozen=True)
class Address:
    """Sheet and range; rows and columns count from 0, an open end is None."""

    sheet: str | None
    row: int
    column: int
    last_row: int | None
    last_column: int | None


def parse_address(text: str) -> Address:
    sheet, mark, cells = text.rpartition("!")
    name = sheet.strip("'").replace("''", "'") if mark else None
    found = re.fullmatch(r"\$?([A-Z]+)\$?([0-9]+)(?::\$?([A-Z]+)\$?([0-9]+))?", (cells or "A1").upper())
    if not found:
        raise ValueError(f"not a data address: {text!r}")
    column, row, last_column, last_row = found.groups()
    last = (int(last_row) - 1, _column_index(last_column)) if last_row else (None, None)
    return Address(name, int(row) - 1, _column_index(column), *last)


def _column_index(letters: str) -> int:
    index = 0
    for letter in letters:
        index = index * 26 + ord(letter) - ord("A") + 1
    return index - 1


def _shows_date(code: str) -> tuple[bool, bool]:
    """Whether a number format shows dates or times, and whether times."""
    bare = re.sub(r'"[^"]*"|\\.|_.|\*.|\[(?![hms]+\])[^\]]*\]', "", code.lower())
    if "general" in bare:
        return False, False
    return bool(re.search("[ymdhs]", bare)), bool(re.search("[hs]", bare))


class Workbook:
    """An open workbook: sheets, shared strings and the styles that make numbers dates."""

    def __init__(self, file):
        try:
            self.archive = zipfile.ZipFile(file)
        except zipfile.BadZipFile as error:
            raise ValueError("not an xlsx workbook; old binary workbooks (xls) are not read") from error
        self.parts = set(self.archive.namelist())
        book = self._tree("xl/workbook.xml")
        targets = {
            one.get("Id"): one.get("Target") for one in self._tree("xl/_rels/workbook.xml.rels")
        }
        self.sheets = {
            one.get("name"): _part_name(targets[one.get(_RELATION)]) for one in book.iter(f"{_MAIN}sheet")
        }
        properties = book.find(f"{_MAIN}workbookPr")
        from_1904 = properties is not None and properties.get("date1904") in ("1", "true")
        self.epoch = datetime.datetime(1904, 1, 1) if from_1904 else datetime.datetime(1899, 12, 30)
        self.dates = self._dates()
        self.strings = self._strings()

    def _tree(self, part: str) -> ElementTree.Element:
        with self.archive.open(part) as stream:
            return ElementTree.parse(stream).getroot()

    def _strings(self) -> list[str]:
        """Shared strings; phonetic hints in them are no text."""
        found = []
        if "xl/sharedStrings.xml" in self.parts:
            with self.archive.open("xl/sharedStrings.xml") as stream:
                for item in _elements(stream, f"{_MAIN}si"):
                    found.append(_text(item))
        return found

    def _dates(self) -> list[tuple[bool, bool]]:
        """Per cell style, whether it shows dates and whether times."""
        if "xl/styles.xml" not in self.parts:
            return []
        styles = self._tree("xl/styles.xml")
        own = {int(one.get("numFmtId")): _shows_date(one.get("formatCode", "")) for one in styles.iter(f"{_MAIN}numFmt")}
        built_in = {i: (True, i in _TIME_FORMATS) for i in _DATE_FORMATS}
        formats = styles.find(f"{_MAIN}cellXfs")
        listed = [] if formats is None else [int(one.get("numFmtId", 0)) for one in formats]
        return [own.get(i, built_in.get(i, (False, False))) for i in listed]

    def rows(self, sheet: str | None) -> Iterator[tuple[int, dict[int, Any]]]:
        """Number and values of every row that the sheet holds, by column."""
        if sheet is not None and sheet not in self.sheets:
            raise ValueError(f"no sheet {sheet!r}; there are {sorted(self.sheets)}")
        part = self.sheets[sheet] if sheet is not None else next(iter(self.sheets.values()))
        row_at = -1
        with self.archive.open(part) as stream:
            for row in _elements(stream, f"{_MAIN}row"):
                row_at = int(row.get("r")) - 1 if row.get("r") else row_at + 1
                values, at = {}, -1
                for cell in row.iter(f"{_MAIN}c"):
                    place = cell.get("r")
                    at = _column_index(place.rstrip("0123456789")) if place else at + 1
                    value = self._value(cell)
                    if value is not None:
                        values[at] = value
                yield row_at, values

    def _value(self, cell: ElementTree.Element) -> Any:
        kind = cell.get("t", "n")
        if kind == "inlineStr":
            inline = cell.find(f"{_MAIN}is")
            return None if inline is None else _text(inline)
        text = cell.findtext(f"{_MAIN}v")
        if text is None or kind == "e" or (text == "" and kind != "str"):
            return None
        if kind == "s":
            return self.strings[int(text)]
        if kind == "b":
            return text.strip() in ("1", "true")
        if kind == "str":
            return text
        if kind == "d":
            return datetime.datetime.fromisoformat(text.removesuffix("Z"))
        number = float(text)
        style = int(cell.get("s", 0))
        if style < len(self.dates) and self.dates[style][0]:
            return self._date(number, self.dates[style][1])
        return int(number) if number.is_integer() and abs(number) < 1e15 else number

    def _date(self, serial: float, timed: bool) -> datetime.datetime | datetime.date:
        # Days before March 1900 are one off, as the format has a 29 February 1900.
        early = self.epoch.year == 1899 and serial < 60
        moment = self.epoch + datetime.timedelta(days=serial + early)
        moment = (moment + datetime.timedelta(microseconds=500)).replace(microsecond=0) if moment.microsecond > 999_000 else moment
        whole = moment.replace(microsecond=moment.microsecond // 1000 * 1000)
        return whole if timed or whole.time() != datetime.time() else whole.date()


def _part_name(target: str) -> str:
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def _text(element: ElementTree.Element) -> str:
    """Text of a string item: its own and that of its runs."""
    parts = [element, *element.findall(f"{_MAIN}r")]
    return "".join(t.text or "" for part in parts for t in part.findall(f"{_MAIN}t"))


def _elements(stream, tag: str) -> Iterator[ElementTree.Element]:
    """Elements of a stream one by one; those handled are dropped from the tree."""
    parents = []
    for event, element in ElementTree.iterparse(stream, events=("start", "end")):
        if event == "start":
            parents.append(element)
            continue
        parents.pop()
        if element.tag == tag:
            yield element
            if parents:
                parents[-1].remove(element)


def table_rows(book: Workbook, address: Address, header: bool) -> Iterator[list]:
    """The names of the columns, then the values of each row of the range."""
    width = None
    for at, values in book.rows(address.sheet):
        if at < address.row or (address.last_row is not None and at > address.last_row):
            continue
        last = address.last_column if address.last_column is not None else width
        inside = {k - address.column: v for k, v in values.items() if k >= address.column and (last is None or k <= last)}
        if not inside:
            continue
        if width is None:
            width = address.column + max(inside) if address.last_column is None else address.last_column
            size = width - address.column + 1
            yield _names(inside if header else {}, size)
            if header:
                continue
        yield [inside.get(i) for i in range(size)]
    if width is None:
        yield []


def _names(cells: dict[int, Any], size: int) -> list[str]:
    """Column names; a repeated one gets its place behind it."""
    names: list[str] = []
    for i in range(size):
        name = as_text(cells[i]) if i in cells else f"_c{i}"
        names.append(name if name not in names else f"{name}{i}")
    return names


def as_text(value: Any) -> str | None:
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, datetime.datetime):
        return value.isoformat(" ")
    return value.isoformat() if isinstance(value, datetime.date) else repr(value)


def converted(value: Any, kind: T.DataType) -> Any:
    """The value as ``kind``, null where it does not fit."""
    if value is None or isinstance(kind, T.StringType):
        return as_text(value)
    try:
        if isinstance(kind, T.BooleanType):
            return value if isinstance(value, bool) else {"true": True, "false": False}.get(as_text(value).strip().lower())
        if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            moment = datetime.datetime.fromisoformat(as_text(value).strip())
            return moment.date() if isinstance(kind, T.DateType) else moment
        if isinstance(value, (datetime.date, bool)):
            return None
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            return float(value)
        bits = {T.IntegerType: 31, T.LongType: 63}[type(kind)]
        whole = int(value) if not isinstance(value, float) else int(value) if value.is_integer() else None
        return whole if whole is not None and -(1 << bits) <= whole < 1 << bits else None
    except (ValueError, OverflowError):
        return None


def inferred(rows: Iterator[list]) -> T.StructType:
    """Types that hold every value: bigint, double, boolean, date, timestamp, else text."""
    names = next(rows)
    kinds: list[set[type]] = [set() for _ in names]
    for row in rows:
        for seen, value in zip(kinds, row):
            if value is not None:
                seen.add(type(value))
    return T.StructType([T.StructField(name, _kind_of(seen)) for name, seen in zip(names, kinds)])


def _kind_of(seen: set[type]) -> T.DataType:
    choices = [
        ({int}, T.LongType()), ({int, float}, T.DoubleType()), ({bool}, T.BooleanType()), ({datetime.date}, T.DateType()),
        ({datetime.date, datetime.datetime}, T.TimestampNTZType()),
    ]
    fitting = [kind for types, kind in choices if seen and seen <= types]
    return fitting[0] if fitting else T.StringType()


# --- the data source --------------------------------------------------------------------


def _flag(options, name: str) -> bool:
    return str(options.get(name, "false")).lower() == "true"


@dataclass
class File(InputPartition):
    path: str


class ExcelSource(DataSource):
    """Options as in the text of the module, and ``pathEnding``, by default ``.xlsx,.xlsm``."""

    @classmethod
    def name(cls) -> str:
        return "tablewright_excel"

    def _files(self) -> list[str]:
        endings = tuple(self.options.get("pathEnding", ".xlsx,.xlsm").split(","))
        files = [path for path, _ in data_files(self.options["path"], endings)]
        if not files:
            raise FileNotFoundError(f"no xlsx file in: {self.options['path']}")
        return files

    def _rows(self, path: str) -> Iterator[list]:
        address = parse_address(self.options.get("dataAddress", "A1"))
        system, inside = resolve(path)
        with system.open_input_file(inside) as file:
            yield from table_rows(Workbook(file), address, _flag(self.options, "header"))

    def schema(self) -> T.StructType:
        rows = self._rows(self._files()[0])
        if _flag(self.options, "inferSchema"):
            return inferred(rows)
        return T.StructType([T.StructField(name, T.StringType()) for name in next(rows)])

    def reader(self, schema: T.StructType) -> ExcelReader:
        return ExcelReader(self._files(), schema, partial(self._rows), _flag(self.options, "header"))


class ExcelReader(DataSourceReader):
    def __init__(self, files: list[str], schema: T.StructType, rows_of, header: bool):
        self.files, self.schema, self.rows_of, self.header = files, schema, rows_of, header

    def partitions(self) -> list[File]:
        return [File(path) for path in self.files]

    def read(self, partition: File) -> Iterator[pa.RecordBatch]:
        rows = self.rows_of(partition.path)
        names = next(rows)
        fields = self.schema.fields
        # By name under a header; by place without one, as a column then has no name of its own.
        places = [names.index(f.name) if f.name in names else None for f in fields] if self.header else [
            i if i < len(names) else None for i in range(len(fields))
        ]
        held: list[list] = []
        for row in rows:
            held.append(row)
            if len(held) == BATCH_ROWS:
                yield self._batch(held, places)
                held = []
        if held:
            yield self._batch(held, places)

    def _batch(self, rows: list[list], places: list[int | None]) -> pa.RecordBatch:
        columns = []
        for field, place in zip(self.schema.fields, places):
            values = [None if place is None else converted(row[place], field.dataType) for row in rows]
            columns.append(pa.array(values, arrow_type(field.dataType)))
        return pa.RecordBatch.from_arrays(columns, names=[f.name for f in self.schema.fields])
