"""Dictionaries, hierarchy, composition, XML both ways and the landing stream."""

import pytest
from pyspark.sql import functions as F

from edispark.operators import convert, dictionary, hierarchy, read
from edispark.plans import compose
from edispark.sources import xml
from edispark.sources.idoc import write_idoc
from edispark.streaming.landing import stream_raw

from .test_records import FLIGHT, RULE_TYPE, RULES, control, data

CONTROL_ONLY = '<EDI_DC40 SEGMENT="1"><DOCNUM>0000000000000008</DOCNUM><MANDT>001</MANDT></EDI_DC40>'


@pytest.fixture
def rules(spark):
    return spark.createDataFrame(RULES, RULE_TYPE).coalesce(1)


@pytest.fixture
def flight(tmp_path):
    path = tmp_path / "flight.idoc"
    path.write_bytes(b"".join(FLIGHT))
    return str(path)


def test_offsets_ignore_given_ones(spark):
    df = spark.createDataFrame([("S", 2, "B", 99, 4, ""), ("S", 1, "A", 99, 3, "CHAR"), ("S", 3, "C", 99, None, "X")], RULE_TYPE).coalesce(1)
    got = dictionary.offsets(spark, df).orderBy("field_pos").collect()
    assert [(r.field_name, r.offset, r.length, r.datatype) for r in got] == [("A", 0, 3, "CHAR"), ("B", 3, 4, None), ("C", 7, 0, "X")]


def test_validate(spark, rules):
    assert dictionary.validate(spark, rules).count() == 0
    bad = spark.createDataFrame([("S1", 1, "A", 0, 10, ""), ("S1", 2, "B", 5, 10, ""), ("S1", 3, "C", 995, 20, "")], RULE_TYPE).coalesce(1)
    got = dictionary.validate(spark, bad).orderBy("field_name").collect()
    assert [(r.field_name, r.problem) for r in got] == [("B", "overlaps the previous field"), ("C", "field exceeds SDATA(1000)")]
    three = spark.createDataFrame([("S", 1, "A", 990, 20, ""), ("S", 1, "B", 991, 20, "")], RULE_TYPE).coalesce(1)
    assert [r.problem for r in dictionary.validate(spark, three).where("field_name = 'B'").collect()] == ["field exceeds SDATA(1000)", "overlaps the previous field", "duplicate field_pos in segment"]


def test_sources_of_dictionaries(spark, rules, tmp_path):
    rules.createOrReplaceTempView("own_rules")
    assert dictionary.resolve(spark, "own_rules").count() == 4 and dictionary.resolve(spark, "(SELECT * FROM own_rules)").count() == 4
    rules.write.mode("overwrite").option("header", True).csv(str(tmp_path / "d.csv"))
    assert dictionary.rules(spark, str(tmp_path / "d.csv")).schema["offset"].dataType.typeName() == "long"
    rules.write.parquet(str(tmp_path / "d.parquet"))
    assert dictionary.offsets(spark, str(tmp_path / "d.parquet")).count() == 4
    rules.write.json(str(tmp_path / "d.json"))
    assert dictionary.offsets(spark, str(tmp_path / "d.json")).count() == 4
    for hostile in ("foo; DROP TABLE bar", "x WHERE 1=1"):
        with pytest.raises(ValueError, match="not a file path"):
            dictionary.resolve(spark, hostile)


def test_from_fields(spark, flight):
    df = spark.sql("SELECT array(named_struct('segmenttyp', 'E1NEW', 'FIELDNAME', 'AIRLINEID', 'FIELD_POS', '000001', 'BYTE_FIRST', '000000', 'EXTLEN', '000003')) AS f")
    out = df.select(F.inline(dictionary.from_fields(df, "f", "T", "", "620")))
    row = out.first()
    assert (row.segnam, row.field_pos, row.offset, row.length, row.datatype, row.mandatory, row.segdef) == ("E1NEW", 1, 0, 3, None, False, None)
    assert read.read_segment(spark, flight, "E1NEW", out).first().airlineid == "LH"
    none = spark.sql("SELECT cast(null AS array<struct<FIELDNAME: string>>) AS f")
    assert none.select(dictionary.from_fields(none, "f", "T", "", "620")).first()[0] == []


def test_hierarchy(spark):
    levels = [1, 2, 3, 2, 3, 1, 3]
    df = spark.createDataFrame([(1, k, lvl) for k, lvl in enumerate(levels)], "doc int, ord int, hlevel int")
    got = hierarchy.renumber(df, ["doc"]).orderBy("ord").collect()
    assert [r.psgnum for r in got] == [0, 1, 2, 1, 4, 0, 4] and [r.segnum for r in got] == [1, 2, 3, 4, 5, 6, 7]


def test_compose_gives_the_same_bytes(spark, rules, tmp_path):
    head = spark.createDataFrame([(1, "EDI_DC40", "001", "0000000000000008", "BOOKING01", "BOOKING", "20260701")], "doc int, tabnam string, mandt string, docnum string, idoctyp string, mestyp string, credat string")
    segments = spark.createDataFrame([(1, 1, "E1CRE", 1, 8), (1, 2, "E1NEW", 2, 8)], "doc int, ord int, segnam string, hlevel int, no long")
    values = spark.createDataFrame([(1, 2, "AIRLINEID", "LH"), (1, 2, "CONNECTID", "0400"), (1, 2, "FLIGHTDATE", "20260715"), (1, 2, "PASSNAME", "MUELLER")], "doc int, ord int, field_name string, value string")
    body = compose.data_records(spark, segments, values, rules, ["doc"], "001", "no")
    out = str(tmp_path / "composed.idoc")
    write_idoc(compose.file_order(compose.control_records(head, ["doc"]), body, ["doc"]), out)
    want = [FLIGHT[0], FLIGHT[1], data("E1NEW", 2, 1, 2, b"LH 040020260715".ljust(40) + b"MUELLER")]
    assert open(out, "rb").read() == b"".join(want)


def test_flat_to_xml_and_back(spark, rules, tmp_path):
    whole = [FLIGHT[0], FLIGHT[1], data("E1NEW", 2, 1, 2, b"LH 040020260715".ljust(40) + b"MUELLER & <Co>")]
    path = tmp_path / "in.idoc"
    path.write_bytes(b"".join(whole))
    text = convert.to_xml(spark, str(path), rules).first().xml
    assert text.startswith('<?xml version="1.0" encoding="utf-8"?>\n<BOOKING01>\n  <IDOC BEGIN="1">\n    <EDI_DC40 SEGMENT="1">\n      <TABNAM>EDI_DC40</TABNAM>\n')
    assert "      <E1CRE SEGMENT=\"1\">\n        <E1NEW SEGMENT=\"1\">\n          <AIRLINEID>LH</AIRLINEID>\n" in text and "MUELLER &amp; &lt;Co&gt;" in text
    assert text.endswith("        </E1NEW>\n      </E1CRE>\n  </IDOC>\n</BOOKING01>\n")
    again = tmp_path / "out.xml"
    again.write_text(text)
    back = convert.xml_to_records(spark, str(again), rules).orderBy("record_index").collect()
    assert [bytes(r.raw_record) for r in back] == whole
    assert [(r.record_type, r.document_key) for r in back] == [("C", 1), ("D", 1), ("D", 1)]
    assert read.read_control(spark, str(again)).first().idoctyp == "BOOKING01"
    with pytest.raises(Exception, match="is IDoc-XML: use"):
        read.read(spark, str(again)).collect()
    rows = convert.read_xml(spark, str(again)).where("seq > 0").collect()
    assert {(r.segnam, r.hlevel) for r in rows} == {("E1CRE", 1), ("E1NEW", 2)} and [(r.field_name, r.value) for r in rows if r.segnam == "E1CRE"] == [("", "")]


def test_several_documents(spark, rules, tmp_path):
    path = tmp_path / "two.idoc"
    path.write_bytes(b"".join([control(), FLIGHT[1], control("0000000000000009"), FLIGHT[1], FLIGHT[2]]))
    one = tmp_path / "one.xml"
    one.write_text(convert.to_xml(spark, str(path), rules, one_root=True).first().xml)
    back = convert.xml_to_records(spark, str(one), rules).orderBy("record_index").collect()
    assert [(r.document_key, r.record_index, r.record_type) for r in back] == [(1, 0, "C"), (1, 1, "D"), (2, 2, "C"), (2, 3, "D"), (2, 4, "D")]
    assert convert.to_xml(spark, str(path), rules, by_document=True).count() == 2
    assert convert.to_xml(spark, str(path), rules).first().xml.count("<BOOKING01>") == 2


def test_parse_rules():
    raw = f"<T><IDOC>{CONTROL_ONLY}<S1 SEGMENT='1'><A>1</A><S2><B>2</B></S2><C>3</C></S1><E/></IDOC></T>".encode()
    doc = xml.parse(raw)[0]
    # a parent has all its fields, also those behind a child segment; an element without children or mark is a segment at the top
    assert [(s.name, s.level, s.fields) for s in doc.segments] == [("S1", 1, [("A", "1"), ("C", "3")]), ("S2", 2, [("B", "2")]), ("E", 1, [])]
    assert xml.lookup(doc.control, "docnum") == "0000000000000008" and xml.lookup(doc.control, "none") == ""
    assert len(xml.parse(f"<idoc>{CONTROL_ONLY}</idoc>".encode())) == 1
    for bad in (b"<a><b></a>", b"not xml at all", b"<a/>", b"<T><IDOC/></T>", b"<!DOCTYPE a [<!ENTITY x 'y'>]><IDOC>&x;</IDOC>"):
        with pytest.raises(xml.XmlError):
            xml.parse(bad)


def test_landing(spark, flight, tmp_path):
    out = str(tmp_path / "table")
    stream_raw(spark, str(tmp_path)).writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(out).count() == 3


def test_hierarchy_has_no_deepest_level(spark):
    levels = list(range(1, 21)) + [5, 6, 20, None]
    df = spark.createDataFrame([(1, k, lvl) for k, lvl in enumerate(levels)], "doc int, ord int, hlevel int")
    got = [r.psgnum for r in hierarchy.renumber(df, ["doc"]).orderBy("ord").collect()]
    want = [max((j + 1 for j in range(k) if lvl is not None and levels[j] == lvl - 1), default=0) for k, lvl in enumerate(levels)]
    assert got == want and got[:20] == list(range(20))


def test_deep_xml():
    n = 5000
    raw = f"<T><IDOC>{CONTROL_ONLY}{'<S SEGMENT=' + chr(34) + '1' + chr(34) + '>'}".encode()
    raw += b'<S SEGMENT="1">' * (n - 1) + b"<A>1</A>" + b"</S>" * n + b"</IDOC></T>"
    doc = xml.parse(raw)[0]
    assert [s.level for s in doc.segments] == list(range(1, n + 1)) and doc.segments[-1].fields == [("A", "1")]


def test_sql_forms(spark, rules, tmp_path):
    dictionary.register(spark)
    bad = spark.createDataFrame([("S1", 1, "A", 0, 10, ""), ("S1", 2, "B", 5, 10, ""), ("S1", 3, "C", 995, 20, ""), ("S2", 1, "D", -1, 0, None), ("S2", 1, "E", 0, 5, None)], RULE_TYPE)
    bad.createOrReplaceTempView("bad_rules")
    for name, function in (("dict_offsets", dictionary.offsets), ("dict_validate", dictionary.validate)):
        one, two = spark.sql(f"SELECT * FROM sap_idoc_{name}(TABLE(bad_rules))"), function(spark, bad.coalesce(1))
        assert one.dtypes == two.dtypes and sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))
    row = spark.sql("SELECT inline(d) FROM (SELECT sap_idoc_dict_from_fields(array(named_struct('a','E1','b','X','c','000001','d','000000','e','000003','f','CHAR','g','','h','')), 'T', '', '620') AS d)").first()
    assert (row.idoctyp, row.segnam, row.field_pos, row.offset, row.length, row.mandatory) == ("T", "E1", 1, 0, 3, False)


def test_xml_kinds(spark, rules, flight, tmp_path):
    path = str(tmp_path / "a.xml")
    rules.write.parquet(str(tmp_path / "rules.parquet"))
    open(path, "w").write(convert.to_xml(spark, flight, rules).first().xml)
    one = spark.read.format("idoc").option("kind", "xml").load(path).drop("filename")
    assert sorted(map(repr, one.collect())) == sorted(map(repr, convert.read_xml(spark, path).collect()))
    two = spark.read.format("idoc").options(kind="records", dict=str(tmp_path / "rules.parquet")).load(path)
    cols = ["document_key", "record_index", "record_type", "raw_record"]
    assert sorted(map(repr, two.select(cols).collect())) == sorted(map(repr, convert.xml_to_records(spark, path, rules).select(cols).collect()))


def test_export(spark, tmp_path):
    kind = "array<struct<SEGMENTTYP:string,FIELDNAME:string,FIELD_POS:string,BYTE_FIRST:string,EXTLEN:string>>"
    raw = spark.createDataFrame([(("620",), [("E1", "X", "000001", "000000", "000003")], [("E1", "E1000")])], f"PE_HEADER struct<RELEASED:string>, PT_FIELDS {kind}, PT_SEGMENTS array<struct<SEGMENTTYP:string,SEGMENTDEF:string>>")
    for form in ("csv", "parquet"):
        dictionary.export([("T1", "", raw), ("T2", "ZX", raw)], str(tmp_path / form), form)
        got = [spark.read.format(form).option("header", True).load(str(tmp_path / form / f"{t}.dict")).first() for t in ("T1", "T2")]
        assert [(r.idoctyp, r.segnam, r.segdef, int(r.length)) for r in got] == [("T1", "E1", "E1000", 3), ("T2", "E1", "E1000", 3)]


def test_describe(spark):
    from edispark.functions.describe import describe

    names = {r.name for r in describe(spark).where("description <> ''").collect()}
    assert {"read_raw", "read_xml", "to_xml", "xml_to_records", "offsets", "validate", "write_idoc", "renumber", "stream_raw", "zero_pad"} <= names


def test_xml_is_parsed_a_document_at_a_time():
    """Chunks of any size give the documents of the whole, each as soon as it has ended; a root that is an IDOC is one."""
    own = f"<IDOC>{CONTROL_ONLY}<S1 SEGMENT='1'><A>1</A><S2><B>2</B></S2></S1></IDOC>"
    raw = ("<T>x<OTHER/>" + own * 50 + "</T>").encode()
    assert all(list(xml.documents(raw[k : k + n] for k in range(0, len(raw), n))) == xml.parse(raw) for n in (1, 7, 1000)) and len(xml.parse(raw)) == 50
    assert len(xml.parse(f"<IDOC>{own}{own}</IDOC>".encode())) == 2 and len(xml.parse(own.encode())) == 1
    taken = []

    def blocks():
        for k in range(0, len(raw), 500):
            taken.append(k)
            yield raw[k : k + 500]

    assert next(xml.documents(blocks())).segments[0].name == "S1" and len(taken) < 5


def test_write_xml(spark, flight, rules, tmp_path):
    """Files of whole documents, compressed, with no empty file; they read as what the flat file holds."""
    out = tmp_path / "out"
    convert.write_xml(spark, [flight], rules, str(out), compression="zstd")
    assert [f.name.endswith(".xml.zst") for f in out.iterdir()] == [True]
    one = tmp_path / "one.xml"
    one.write_text(convert.to_xml(spark, flight, rules, one_root=True).first().xml)
    want, back = ([tuple(r)[:4] for r in convert.xml_to_records(spark, str(p), rules).orderBy("record_index").collect()] for p in (one, out))
    assert back == want and len(back) == 3 and read.read_control(spark, str(out)).count() == 1
    assert convert.read_xml(spark, str(out)).where("field_name = 'PASSNAME'").first().value == "MUELLER"
