import bz2
import datetime
import decimal
import io
import lzma
import zipfile
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import types as T

import tablewright as tw
from suite.written_files import avro_file, encoded, xlsx_file
from tablewright.sources import avro, excel
from tablewright.sources.filesystems import data_files, resolve
from tests.conftest import rows

EVERYTHING = {
    "type": "record", "name": "Row", "namespace": "shop", "fields": [
        {"name": "id", "type": "long"},
        {"name": "small", "type": ["null", "int"]},
        {"name": "flag", "type": "boolean"},
        {"name": "ratio", "type": "float"},
        {"name": "amount", "type": ["double", "null"]},
        {"name": "raw", "type": "bytes"},
        {"name": "name", "type": ["null", "string"]},
        {"name": "kind", "type": {"type": "enum", "name": "Kind", "symbols": ["NEW", "OLD"]}},
        {"name": "code", "type": {"type": "fixed", "name": "Code", "size": 3}},
        {"name": "tags", "type": {"type": "array", "items": ["null", "string"]}},
        {"name": "counts", "type": {"type": "map", "values": "long"}},
        {"name": "place", "type": ["null", {"type": "record", "name": "Place", "fields": [
            {"name": "city", "type": "string"}, {"name": "last", "type": ["null", "Kind"]}]}]},
        {"name": "other_place", "type": ["null", "Place"]},
        {"name": "either", "type": ["null", "string", "boolean"]},
        {"name": "wide", "type": ["int", "null", "long"]},
        {"name": "day", "type": {"type": "int", "logicalType": "date"}},
        {"name": "at", "type": ["null", {"type": "long", "logicalType": "timestamp-millis"}]},
        {"name": "local", "type": {"type": "long", "logicalType": "local-timestamp-micros"}},
        {"name": "price", "type": {"type": "bytes", "logicalType": "decimal", "precision": 9, "scale": 2}},
        {"name": "odd", "type": {"type": "string", "logicalType": "unheard-of"}},
    ],
}

KIND = EVERYTHING["fields"][7]["type"]
PLACE = EVERYTHING["fields"][11]["type"][1]
# Named types are spelled out for the encoder, which does not look names up.
SPELLED = {**EVERYTHING, "fields": [dict(f) for f in EVERYTHING["fields"]]}
SPELLED["fields"][11]["type"] = ["null", {**PLACE, "fields": [PLACE["fields"][0], {"name": "last", "type": ["null", KIND]}]}]
SPELLED["fields"][12]["type"] = SPELLED["fields"][11]["type"]


def row(i):
    return {
        "id": i * (-1) ** i * 10**10, "small": None if i % 3 == 0 else (1, -i), "flag": i % 2 == 0, "ratio": i / 4,
        "amount": (0, i / 3) if i % 4 else (1, None), "raw": bytes([i % 256]) * (i % 5), "name": (1, f"\xfc {i}"),
        "kind": ["NEW", "OLD"][i % 2], "code": b"abc", "tags": [(1, "x"), None][: i % 3], "counts": {f"k{j}": j for j in range(i % 3)},
        "place": (1, {"city": f"c{i}", "last": (1, "OLD") if i % 2 else None}), "other_place": None,
        "either": [None, (1, "text"), (2, True)][i % 3], "wide": [(0, 5), (1, None), (2, 1 << 40)][i % 3], "day": i - 5,
        "at": (1, 1_700_000_000_123 + i), "local": -1_000_000 + i, "price": (i - 300).to_bytes(4, "big", signed=True), "odd": "o",
    }


@pytest.fixture
def everything(tmp_path):
    (tmp_path / "part-0.avro").write_bytes(avro_file(SPELLED, [row(i) for i in range(400)], "null", 37))
    (tmp_path / "_SUCCESS").write_bytes(b"")
    return str(tmp_path)


def test_every_type(spark, everything):
    df = tw.read_dataset(spark, everything, "avro")
    assert dict(df.dtypes)["place"] == "struct<city:string,last:string>"
    assert dict(df.dtypes)["either"] == "struct<member0:string,member1:boolean>"
    got = {r["id"]: r.asDict(recursive=True) for r in df.collect()}
    assert len(got) == 400
    for i in (0, 1, 2, 3, 4, 5, 399):
        r = got[row(i)["id"]]
        assert r["small"] == (None if i % 3 == 0 else -i) and r["flag"] == (i % 2 == 0) and r["ratio"] == i / 4
        assert r["amount"] == (i / 3 if i % 4 else None) and r["raw"] == bytes([i % 256]) * (i % 5) and r["name"] == f"\xfc {i}"
        assert r["kind"] == ["NEW", "OLD"][i % 2] and r["code"] == b"abc" and r["tags"] == ["x", None][: i % 3]
        assert r["counts"] == {f"k{j}": j for j in range(i % 3)} and r["other_place"] is None
        assert r["place"] == {"city": f"c{i}", "last": "OLD" if i % 2 else None}
        assert r["either"] == [None, {"member0": "text", "member1": None}, {"member0": None, "member1": True}][i % 3]
        assert r["wide"] == [5, None, 1 << 40][i % 3] and r["day"] == datetime.date(1970, 1, 1) + datetime.timedelta(i - 5)
        assert r["local"] == datetime.datetime(1970, 1, 1) + datetime.timedelta(microseconds=i - 1_000_000)
        assert r["price"] == decimal.Decimal(i - 300) / 100 and r["odd"] == "o"
    instants = df.selectExpr("id", "unix_millis(at) AS at").collect()
    assert {r["id"]: r["at"] for r in instants} == {row(i)["id"]: 1_700_000_000_123 + i for i in range(400)}


@pytest.mark.parametrize("split", [100, 1500, 10_000_000])
def test_splits_hold_every_row_once(spark, everything, split):
    df = tw.read_dataset(spark, everything, "avro", {"splitBytes": split}, schema="id long")
    (_, size), = data_files(everything, (".avro",))
    assert df.rdd.getNumPartitions() == -(-size // split)
    assert sorted(r["id"] for r in df.collect()) == sorted(row(i)["id"] for i in range(400))
    if split == 1500:
        held = df.rdd.glom().map(len).collect()
        assert sum(n > 0 for n in held) > 3


def test_every_byte_as_the_limit_of_a_split(everything):
    (path, size), = data_files(everything, (".avro",))
    with open(path, "rb") as file:
        header = avro.read_header(file)
        whole = list(avro.blocks(file, header, 0, size))
        assert sum(n for n, _ in whole) == 400 and len(whole) == 11
        for cut in range(0, size, 7):
            assert [*avro.blocks(file, header, 0, cut), *avro.blocks(file, header, cut, size)] == whole


def test_given_schema_picks_and_adds_columns(spark, everything):
    df = tw.read_dataset(spark, everything, "avro", schema="name string, missing int, place struct<last: string>")
    assert df.columns == ["name", "missing", "place"]
    assert {(r["missing"], r["place"]["last"]) for r in df.collect()} == {(None, None), (None, "OLD")}


def test_codecs(tmp_path):
    plain = avro_file("long", range(100), "null", 30)
    header = avro.read_header(io.BytesIO(plain))
    content = b"".join(encoded("long", i) for i in range(30))
    checksum = zlib.crc32(content).to_bytes(4, "big")
    packed = {
        "null": content, "deflate": zlib.compress(content)[2:-4], "bzip2": bz2.compress(content), "xz": lzma.compress(content),
        "zstandard": pa.compress(content, codec="zstd", asbytes=True),
        "snappy": pa.compress(content, codec="snappy", asbytes=True) + checksum,
    }
    assert set(packed) == set(avro._CODECS)
    for codec, data in packed.items():
        assert avro._CODECS[codec](data) == content
    with pytest.raises(ValueError, match="checksum"):
        avro._snappy(packed["snappy"][:-1] + b"\0")
    assert header.schema == "long" and avro.spark_schema("long") == T.StructType([T.StructField("value", T.LongType(), False)])


def test_schema_that_is_no_record(spark, tmp_path):
    (tmp_path / "a.avro").write_bytes(avro_file("long", range(100), "deflate", 30))
    (tmp_path / "b.avro").write_bytes(avro_file("long", [], "deflate"))
    df = tw.read_dataset(spark, str(tmp_path), "avro")
    assert rows(df) == rows(spark.range(100).toDF("value"))


def test_broken_avro_files(spark, tmp_path):
    good = avro_file("long", range(1000), "null", 100)
    (tmp_path / "cut.avro").write_bytes(good[:-20])
    with pytest.raises(Exception, match="cut off"):
        tw.read_dataset(spark, str(tmp_path), "avro").collect()
    with pytest.raises(ValueError, match="not an Avro file"):
        avro.read_header(io.BytesIO(b"PAR1"))
    with pytest.raises(ValueError, match="contains itself"):
        avro.decoder({"type": "record", "name": "R", "fields": [{"name": "r", "type": ["null", "R"]}]})
    with pytest.raises(ValueError, match="unknown type"):
        avro.decoder("Nothing")
    with pytest.raises(FileNotFoundError):
        tw.read_dataset(spark, str(tmp_path / "none"), "avro")


def test_paths():
    assert resolve("/a/b")[1] == resolve("file:///a/b")[1] == resolve("file:/a/b")[1] == "/a/b"
    with pytest.raises(ValueError, match="read from"):
        resolve("viewfs://x/a")


# --- Excel ------------------------------------------------------------------------------


TABLE = [["id", "name", "price", "ok"], [1, "a & b", 2.5, True], [2, None, 3.0, False], [30, " s ", 1e-7, None]]


def written(path, rows_, **options):
    path.write_bytes(xlsx_file(rows_, **options))
    return str(path)


def test_text_columns(spark, tmp_path):
    written(tmp_path / "a.xlsx", TABLE)
    df = tw.read_dataset(spark, str(tmp_path), "xlsx", {"header": True})
    assert df.dtypes == [(name, "string") for name in TABLE[0]]
    assert rows(df) == [("1", "a & b", "2.5", "true"), ("2", None, "3", "false"), ("30", " s ", "1e-07", None)]


def test_types_found_and_given(spark, tmp_path):
    path = written(tmp_path / "a.xlsx", TABLE)
    df = tw.read_dataset(spark, path, "excel", {"header": True, "inferSchema": True})
    assert df.dtypes == [("id", "bigint"), ("name", "string"), ("price", "double"), ("ok", "boolean")]
    assert rows(df)[0] == (1, "a & b", 2.5, True)
    given = tw.read_dataset(spark, path, "excel", {"header": True}, schema="price int, gone string, id int, name double")
    assert rows(given) == [(None, None, 1, None), (None, None, 30, None), (3, None, 2, None)]


def test_address_and_no_header(spark, tmp_path):
    path = written(tmp_path / "a.xlsx", TABLE, sheet="My Sheet", first_row=4, first_column=2)
    options = {"dataAddress": "'My Sheet'!C4", "header": True}
    assert tw.read_dataset(spark, path, "excel", options).columns == TABLE[0]
    part = tw.read_dataset(spark, path, "excel", {"dataAddress": "'My Sheet'!D5:E6"})
    assert part.columns == ["_c0", "_c1"] and rows(part) == [(None, "3"), ("a & b", "2.5")]
    named = tw.read_dataset(spark, path, "excel", {"dataAddress": "D5:E6"}, schema="a string, b double")
    assert rows(named) == [(None, 3.0), ("a & b", 2.5)]
    with pytest.raises(Exception, match="no sheet"):
        tw.read_dataset(spark, path, "excel", {"dataAddress": "Other!A1"}).collect()


def test_many_files_are_many_tasks(spark, tmp_path):
    for i in range(3):
        written(tmp_path / f"{i}.xlsx", [["a", "b"], *[[i, j] for j in range(25_000 if i else 0)]])
    df = tw.read_dataset(spark, str(tmp_path), "excel", {"header": True}, schema="a int, b int")
    assert df.rdd.getNumPartitions() == 3
    assert df.groupBy("a").count().orderBy("a").collect() == [(1, 25_000), (2, 25_000)]


def workbook(sheet, styles="", strings="", properties=""):
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        relation = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
        archive.writestr("xl/workbook.xml", f'<workbook {main} {relation}>{properties}<sheets><sheet name="S" sheetId="1" r:id="r1"/></sheets></workbook>')
        archive.writestr("xl/_rels/workbook.xml.rels", '<R><Relationship Id="r1" Target="/xl/worksheets/s.xml"/></R>')
        archive.writestr("xl/worksheets/s.xml", f"<worksheet {main}><sheetData>{sheet}</sheetData></worksheet>")
        if styles:
            archive.writestr("xl/styles.xml", f"<styleSheet {main}>{styles}</styleSheet>")
        if strings:
            archive.writestr("xl/sharedStrings.xml", f"<sst {main}>{strings}</sst>")
    return excel.Workbook(io.BytesIO(out.getvalue()))


def values(book):
    return [list(cells.items()) for _, cells in book.rows(None)]


def test_cell_types_dates_and_styles():
    styles = (
        '<numFmts><numFmt numFmtId="164" formatCode="[$-409]yyyy\\-mm\\-dd hh:mm"/><numFmt numFmtId="165" formatCode="0.0&quot;days&quot;"/></numFmts>'
        '<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs>'
    )
    strings = "<si><t>one</t></si><si><r><t>two </t></r><r><t>runs</t></r><rPh><t>no</t></rPh></si>"
    sheet = (
        '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c><c r="AA1" t="inlineStr"><is><t>in</t></is></c></row>'
        '<row><c><v>4.0</v></c><c s="1"><v>45292</v></c><c s="2"><v>45292.75</v></c><c s="3"><v>7.5</v></c></row>'
        '<row r="7"><c r="B7" t="b"><v>1</v></c><c r="C7" t="e"><v>#N/A</v></c><c r="D7" t="str"><f>A1</f><v>made</v></c><c r="E7" s="1"/></row>'
        '<row r="8"><c r="A8" s="1"><v>59</v></c><c r="B8" s="1"><v>61</v></c></row>'
    )
    day, moment = datetime.date(2024, 1, 1), datetime.datetime(2024, 1, 1, 18)
    book = workbook(sheet, styles, strings)
    assert values(book) == [
        [(0, "one"), (2, "two runs"), (26, "in")], [(0, 4), (1, day), (2, moment), (3, 7.5)], [(1, True), (3, "made")],
        [(0, datetime.date(1900, 2, 28)), (1, datetime.date(1900, 3, 1))],
    ]
    assert [at for at, _ in book.rows("S")] == [0, 1, 6, 7]
    late = workbook('<row r="1"><c s="1"><v>0</v></c></row>', styles, properties='<workbookPr date1904="1"/>')
    assert values(late) == [[(0, datetime.date(1904, 1, 1))]]


def test_addresses():
    assert excel.parse_address("'It''s'!$B$2:AA10") == excel.Address("It's", 1, 1, 9, 26)
    assert excel.parse_address("Sheet1!") == excel.Address("Sheet1", 0, 0, None, None)
    with pytest.raises(ValueError, match="address"):
        excel.parse_address("A1:B")


def test_names_and_empty_tables(spark, tmp_path):
    path = written(tmp_path / "a.xlsx", [["x", None, "x", 4], [None] * 4, [1, 2, 3, 4]])
    df = tw.read_dataset(spark, path, "excel", {"header": True})
    assert df.columns == ["x", "_c1", "x2", "4"] and rows(df) == [("1", "2", "3", "4")]
    (tmp_path / "b.xls").write_bytes(b"\xd0\xcf\x11\xe0")
    with pytest.raises(ValueError, match="xls"):
        excel.Workbook(io.BytesIO(b"\xd0\xcf\x11\xe0"))
