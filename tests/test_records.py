"""Framing, readers, sink and encoders on a small document."""

import os
import random

import pytest
from pyspark.sql import functions as F

from edispark.functions import encode
from edispark.functions.layout import CONTROL_FIELDS, CONTROL_LEN, DATA_FIELDS, DATA_LEN, framing_of, placed
from edispark.operators import read
from edispark.sources.framing import FramingError, detect, looks_like_xml, records
from edispark.sources.idoc import write_idoc


def control(docnum="0000000000000008", idoctyp="BOOKING01"):
    own = {"TABNAM": "EDI_DC40", "MANDT": "001", "DOCNUM": docnum, "IDOCTYP": idoctyp, "MESTYP": "BOOKING", "CREDAT": "20260701"}
    return b"".join(own.get(n, "").encode().ljust(k) for n, k in CONTROL_FIELDS)


def data(segnam, segnum, psgnum, hlevel, sdata=b""):
    head = segnam.encode().ljust(30) + b"001" + b"0000000000000008" + b"%06d%06d%02d" % (segnum, psgnum, hlevel)
    return head + sdata.ljust(1000)


FLIGHT = [control(), data("E1CRE", 1, 0, 1), data("E1NEW", 2, 1, 2, b"LH 04002026071500000042Y".ljust(40) + b"MUELLER".ljust(25) + b"Mr")]
RULES = [("E1NEW", 1, "AIRLINEID", 0, 3, "CHAR"), ("E1NEW", 2, "CONNECTID", 3, 4, "NUMC"), ("E1NEW", 3, "FLIGHTDATE", 7, 8, ""), ("E1NEW", 4, "PASSNAME", 40, 25, "CHAR")]
RULE_TYPE = "segnam string, field_pos int, field_name string, offset int, length int, datatype string"


@pytest.fixture
def flight(tmp_path):
    path = tmp_path / "flight.idoc"
    path.write_bytes(b"".join(FLIGHT))
    return str(path)


@pytest.fixture
def rules(spark):
    return spark.createDataFrame(RULES, RULE_TYPE).coalesce(1)


def chunked(raw, n):
    return (raw[k : k + n] for k in range(0, len(raw), n))


def test_layouts_are_contiguous():
    assert sum(n for _, n in CONTROL_FIELDS) == CONTROL_LEN and sum(n for _, n in DATA_FIELDS) == DATA_LEN
    assert placed(DATA_FIELDS)[-1] == ("SDATA", 63, 1000) and len(CONTROL_FIELDS) == 36


@pytest.mark.parametrize("end", [b"", b"\n", b"\r\n"])
@pytest.mark.parametrize("size", [1, 7, 523, 524, 525, 1063, 4096, 10**6])
def test_splitting_does_not_depend_on_chunks(end, size):
    raw = b"".join(r + end for r in FLIGHT * 2)
    got = list(records(chunked(raw, size)))
    assert [g[:3] for g in got] == [(1, 0, "C"), (1, 1, "D"), (1, 2, "D"), (2, 3, "C"), (2, 4, "D"), (2, 5, "D")]
    assert [g[3] for g in got] == FLIGHT * 2


def test_last_line_may_lack_its_end():
    assert len(list(records([b"\n".join(FLIGHT)]))) == 3


def test_truncated_and_malformed():
    cut = b"".join(FLIGHT)[:-500]
    with pytest.raises(FramingError, match="framing"):
        list(records([cut]))
    assert len(list(records([cut], lenient=True))) == 2
    with pytest.raises(FramingError):
        list(records([b"short"], lenient=True))
    assert list(records([])) == []
    bad = FLIGHT[0] + b"\n" + FLIGHT[1][:500] + b"\n"
    with pytest.raises(FramingError, match="got 500 bytes, expected 1063"):
        list(records([bad]))
    assert len(list(records([bad], lenient=True))) == 2


def test_random_bytes_never_break_a_lenient_scan():
    r = random.Random(1)
    for k in range(200):
        raw = bytes(r.randrange(256) for _ in range(r.randrange(530, 3000)))
        raw = b"EDI_DC" + raw if k % 3 == 0 else raw
        for kind in ("fixed", "lf", "crlf"):
            list(records(chunked(raw, 700), kind, lenient=True))


def test_detection():
    assert detect(FLIGHT[0] + b"E1") == "fixed" and detect(FLIGHT[0] + b"\nE") == "lf" and detect(FLIGHT[0] + b"\r\n") == "crlf"
    assert looks_like_xml(b"\xef\xbb\xbf \n<a>") and not looks_like_xml(b"EDI_DC40")
    assert framing_of("CONTIGUOUS") == "fixed" and framing_of("Newline") == "lf"
    with pytest.raises(ValueError):
        framing_of("odd")


def test_read(spark, flight):
    rows = read.read(spark, flight).orderBy("segnum").collect()
    assert [(r.segnam, r.segnum, r.psgnum, r.hlevel, len(r.sdata)) for r in rows] == [("E1CRE", "000001", "000000", "01", 1000), ("E1NEW", "000002", "000001", "02", 1000)]
    one = read.read_control(spark, flight).first()
    assert (one.tabnam, one.docnum, one.idoctyp, one.serial) == ("EDI_DC40", "0000000000000008", "BOOKING01", "")
    raw = read.read_raw(spark, flight, filename=True).orderBy("record_index").collect()
    assert [(r.record_type, len(r.raw_record)) for r in raw] == [("C", 524), ("D", 1063), ("D", 1063)] and raw[0].filename == flight


def test_read_segment_and_fields(spark, flight, rules):
    row = read.read_segment(spark, flight, "E1NEW", rules).first()
    assert (row.airlineid, row.connectid, row.flightdate, row.passname) == ("LH", "0400", "20260715", "MUELLER")
    assert read.read_segment(spark, flight, "E1NEW", rules).columns == ["document_key", "segnum", "airlineid", "connectid", "flightdate", "passname"]
    rows = read.read_fields(spark, flight, rules).collect()
    assert len(rows) == 5 and {(r.field_name, r.value) for r in rows if r.segnam == "E1NEW"} >= {("PASSNAME", "MUELLER")}
    assert [r.field_pos for r in rows if r.segnam == "E1CRE"] == [None] and {r.datatype for r in rows if r.field_name == "FLIGHTDATE"} == {None}
    assert read.read_fields(spark, flight, rules, include_unknown=False).count() == 4


def test_read_segment_errors(spark, flight, rules):
    with pytest.raises(ValueError, match="no fields for segment 'e1new'"):
        read.read_segment(spark, flight, "e1new", rules)
    wide = spark.createDataFrame([("E1NEW", 1, "A", 990, 20, "")], RULE_TYPE)
    with pytest.raises(ValueError, match="out of SDATA bounds"):
        read.read_segment(spark, flight, "E1NEW", wide)
    with pytest.raises(ValueError, match="required column 'offset'"):
        read.read_fields(spark, flight, wide.drop("offset"))


def test_repeated_field_names_get_numbers(spark, flight):
    twice = spark.createDataFrame([("E1NEW", 1, "A", 0, 3, ""), ("E1NEW", 2, "A", 3, 4, "")], RULE_TYPE)
    assert read.read_segment(spark, flight, "E1NEW", twice).columns[2:] == ["a", "a_1"]


def test_lenient_short_record_fails_only_where_it_is_sliced(spark, tmp_path):
    path = tmp_path / "short.idoc"
    path.write_bytes(FLIGHT[0] + b"\n" + FLIGHT[1][:500] + b"\n")
    assert read.read_raw(spark, str(path), lenient=True).count() == 2
    with pytest.raises(Exception, match="too short"):
        read.read(spark, str(path), lenient=True).collect()


def test_encodings(spark, tmp_path, rules):
    path = tmp_path / "l1.idoc"
    path.write_bytes(FLIGHT[0] + data("E1NEW", 1, 0, 1, b"".ljust(40) + b"M\xfcller"))
    assert read.read_segment(spark, str(path), "E1NEW", rules, encoding="ISO-8859-1").first().passname == "Müller"


def test_paths(spark, tmp_path):
    for name in ("b", "a"):
        (tmp_path / f"{name}.idoc").write_bytes(b"".join(FLIGHT))
    assert read.read_control(spark, str(tmp_path / "*.idoc")).count() == 2
    assert read.read_control(spark, [str(tmp_path / "*.idoc"), str(tmp_path / "a.idoc")]).count() == 3
    with pytest.raises(FileNotFoundError, match="no files match the pattern"):
        read.read_raw(spark, str(tmp_path / "*.none"))
    with pytest.raises(FileNotFoundError, match="missing.idoc"):
        read.read_raw(spark, str(tmp_path / "missing.idoc"))
    (tmp_path / "empty.idoc").write_bytes(b"")
    assert read.read_raw(spark, str(tmp_path / "empty.idoc")).count() == 0


@pytest.mark.parametrize("framing,size", [("fixed", 2650), ("lf", 2653), ("crlf", 2656)])
def test_round_trip(spark, flight, tmp_path, framing, size):
    out = str(tmp_path / "out.idoc")
    write_idoc(read.read_raw(spark, flight).orderBy("record_index").select("raw_record"), out, framing)
    assert os.path.getsize(out) == size
    again = read.read_raw(spark, out).orderBy("record_index").collect()
    assert [bytes(r.raw_record) for r in again] == FLIGHT


def test_sink_keeps_a_global_order(spark, tmp_path):
    out = str(tmp_path / "many.idoc")
    df = spark.range(3000).select(F.col("id"), encode.encode_data_record(F.lit("E1"), F.lit("001"), F.col("id"), F.lit(1), F.lit(0), F.lit(1), F.lit("")).alias("r")).repartition(7)
    write_idoc(df.orderBy("id").select("r"), out)
    raw = open(out, "rb").read()
    assert [int(raw[k * 1063 + 33 : k * 1063 + 49]) for k in range(3000)] == list(range(3000))


def test_sink_checks(spark, tmp_path):
    out = str(tmp_path / "x.idoc")
    with pytest.raises(Exception, match="record is 8 bytes; expected 524"):
        write_idoc(spark.createDataFrame([("tooshort",)], "r string"), out)
    assert not os.path.exists(out)
    write_idoc(spark.createDataFrame([("tooshort",), (None,)], "r string"), out, validate=False)
    assert open(out, "rb").read() == b"tooshort"
    with pytest.raises(Exception, match="exactly one"):
        write_idoc(spark.createDataFrame([("a", "b")], "r string, s string"), out)
    with pytest.raises(Exception, match="unknown option"):
        spark.createDataFrame([("a",)], "r string").write.format("idoc").mode("overwrite").option("odd", "1").save(out)


def test_zero_pad(spark):
    cases = [(2, 6, "000002"), (8, 16, "0" * 15 + "8"), (0, 2, "00"), (123, 2, "23"), (-5, 3, "000"), (None, 2, "00")]
    df = spark.createDataFrame([(n,) for n, _, _ in cases], "n long")
    for n, width, want in cases:
        assert df.where(F.col("n").eqNullSafe(F.lit(n))).select(encode.zero_pad(F.col("n"), width)).first()[0] == want


def test_encode_sdata(spark):
    df = spark.createDataFrame([([0, 3, 2], [3, 4, 2], ["LH", "0400", "ab"])], "o array<long>, n array<long>, v array<string>")
    text = df.select(encode.encode_sdata(F.col("o"), F.col("n"), F.col("v"))).first()[0]
    assert len(text) == 1000 and text[:8] == "LHab400 "
    encode.register(spark)
    assert df.select(F.expr("sap_idoc_encode_sdata(o, n, v)")).first()[0] == text
    for o, n, v in (([0], [2000], ["a"]), ([2**63 - 1], [1], ["a"]), ([900], [200], ["a"]), ([-1], [1], ["a"]), ([0, 1], [1], ["a"])):
        bad = spark.createDataFrame([(o, n, v)], df.schema)
        with pytest.raises(Exception, match="encode_sdata"):
            bad.select(encode.encode_sdata(F.col("o"), F.col("n"), F.col("v"))).collect()
    none = spark.createDataFrame([(None, None, None)], df.schema)
    assert none.select(encode.encode_sdata(F.col("o"), F.col("n"), F.col("v"))).first()[0] == " " * 1000


def test_encoding_counts_bytes(spark):
    got = spark.range(1).select(encode.padded(F.lit("Mü"), 2)).first()[0]
    assert bytes(got) == b"M\xc3"


def test_sql_functions(spark):
    encode.register(spark)
    row = spark.sql("SELECT sap_idoc_params('MATMAS05') p, sap_idoc_params('ORDERS05', 'ZEXT', '3') q, sap_idoc_params('A', version => '2') r, sap_idoc_encode_control(array('EDI_DC40')) c, sap_idoc_version('x') v").first()
    assert tuple(row.p) == ("MATMAS05", "", "4") and tuple(row.q) == ("ORDERS05", "ZEXT", "3") and row.r.PI_VERSION == "2" and len(row.c) == 524 and row.v == "edispark x"


def test_view_over_the_source(spark, flight):
    read.read_raw(spark, flight)
    spark.sql(f"CREATE OR REPLACE TEMP VIEW flight_view USING idoc OPTIONS (path '{flight}', framing 'fixed')")
    assert spark.sql("SELECT count(*) FROM flight_view WHERE record_type = 'D'").first()[0] == 2


@pytest.mark.parametrize("end", [b"", b"\n", b"\r\n"])
def test_large_files_are_read_in_parts(spark, tmp_path, monkeypatch, end):
    from edispark.sources import idoc

    path = tmp_path / "large.idoc"
    path.write_bytes(b"".join(r + end for r in FLIGHT * 50))
    whole = [tuple(r) for r in read.read_raw(spark, str(path)).orderBy("record_index").collect()]
    monkeypatch.setattr(idoc, "SPLIT", 10_000)
    monkeypatch.setattr(idoc, "LEAST_PART", 10_000)
    df = read.read_raw(spark, str(path))
    assert df.rdd.getNumPartitions() > 5 and [tuple(r) for r in df.orderBy("record_index").collect()] == whole
    assert whole[-1][:2] == (50, 149)
    path.write_bytes(b"".join(r + end for r in FLIGHT * 50)[:-700])
    with pytest.raises(Exception, match="framing|malformed"):
        read.read_raw(spark, str(path)).collect()
    assert read.read_raw(spark, str(path), lenient=True).count() == (149 if not end else 150)


def test_lenient_files_in_parts_read_as_whole(spark, tmp_path, monkeypatch):
    """Records short and long of their length, whose sum is right, and a line without its end."""
    from edispark.sources import idoc

    lines = [(r[:-1] if k == 7 else r + b"x" if k == 80 else r) for k, r in enumerate(FLIGHT * 50)]
    cases = {"lf": b"\n".join(lines), "crlf": b"\r\n".join(lines), "stops": b"\n".join([*lines[:90], b"y" * 5000, *lines[90:]])}
    for name, raw in cases.items():
        (tmp_path / f"{name}.idoc").write_bytes(raw + b"\n")
    whole = {name: [tuple(r) for r in read.read_raw(spark, str(tmp_path / f"{name}.idoc"), lenient=True).orderBy("record_index").collect()] for name in cases}
    assert len(whole["lf"]) == len(whole["crlf"]) == 150 and len(whole["stops"]) == 90
    monkeypatch.setattr(idoc, "SPLIT", 8_000)
    monkeypatch.setattr(idoc, "LEAST_PART", 8_000)
    for name in cases:
        df = read.read_raw(spark, str(tmp_path / f"{name}.idoc"), lenient=True)
        assert df.rdd.getNumPartitions() > 5 and [tuple(r) for r in df.orderBy("record_index").collect()] == whole[name]
        with pytest.raises(Exception, match="malformed terminated IDoc record #7: got 1062 bytes"):
            read.read_raw(spark, str(tmp_path / f"{name}.idoc")).collect()


def test_format_takes_folders_globs_and_kinds(spark, tmp_path, rules):
    (tmp_path / "in").mkdir()
    for name in ("a", "b"):
        (tmp_path / "in" / f"{name}.idoc").write_bytes(b"".join(FLIGHT))
    (tmp_path / "in" / "c.txt").write_bytes(b"".join(FLIGHT))
    read.read_raw(spark, str(tmp_path / "in" / "a.idoc"))  # registers the format
    rules.write.option("header", True).csv(str(tmp_path / "rules"))

    def rows(path, **options):
        view = ", ".join(f"{k} '{v}'" for k, v in {"path": f"{tmp_path}/{path}", **options}.items())
        spark.sql(f"CREATE OR REPLACE TEMP VIEW v USING idoc OPTIONS ({view})")
        return spark.sql("SELECT * FROM v")

    assert rows("in").count() == 9 and rows("in/*.idoc").count() == 6 and rows("in/{a,c}.*").count() == 6 and rows("i[n]/b.idoc").count() == 3
    for path in ("in/*.none", "none.idoc"):
        with pytest.raises(Exception, match="no files match|no such file"):
            rows(path).count()
    own, folder = str(tmp_path / "in/a.idoc"), str(tmp_path / "rules")
    pairs = [
        (rows("in/a.idoc", kind="control"), read.read_control(spark, own, filename=True)),
        (rows("in/a.idoc", kind="data"), read.read(spark, own, filename=True)),
        (rows("in/a.idoc", kind="segment", segnam="E1NEW", dict=folder), read.read_segment(spark, own, "E1NEW", rules, filename=True)),
        (rows("in/a.idoc", kind="fields", dict=folder), read.read_fields(spark, own, rules, filename=True)),
        (rows("in/a.idoc", kind="fields", dict=folder, include_unknown="false"), read.read_fields(spark, own, rules, include_unknown=False, filename=True)),
    ]
    for one, two in pairs:
        assert one.columns == two.columns and one.dtypes == two.dtypes and sorted(map(repr, one.collect())) == sorted(map(repr, two.collect())) != []
    for bad in ({"kind": "odd"}, {"kind": "segment", "dict": folder}, {"kind": "fields"}, {"kind": "segment", "segnam": "NONE", "dict": folder}):
        with pytest.raises(Exception, match="unknown kind|needs the option|no fields for segment"):
            rows("in/a.idoc", **bad).count()


def test_other_records_are_dropped_where_they_are_cut(spark, flight):
    from edispark.sources.idoc import raw_scan

    assert raw_scan(spark, flight, only="C").count() == 1 and raw_scan(spark, flight, only="D").count() == 2
    only = raw_scan(spark, flight, only="D", segnam="E1NEW").collect()
    assert [(r.document_key, r.record_index) for r in only] == [(1, 2)]


def test_sink_replaces_and_refuses(spark, tmp_path):
    df = spark.createDataFrame([(r,) for r in FLIGHT], "r binary").coalesce(1)
    for out in (str(tmp_path / "x.idoc"), f"file://{tmp_path}/y.idoc"):
        for n in (1, 2):
            write_idoc(df.union(df) if n == 2 else df, out)
            assert os.path.getsize(out.removeprefix("file://")) == n * 2650
        write_idoc(df, out, single=False)
        assert os.path.isdir(out.removeprefix("file://"))
        write_idoc(df, out)
        assert os.path.isfile(out.removeprefix("file://"))
    assert sorted(os.listdir(tmp_path)) == ["x.idoc", "y.idoc"]
    with pytest.raises(ValueError, match="no file system for 'ftp:'"):
        write_idoc(df, "ftp://host/x.idoc")
    with pytest.raises(Exception, match="no file system for 'foo:'"):
        df.write.format("idoc").mode("overwrite").save("foo://host/x.idoc")


def test_paths_that_only_spark_opens(spark, flight, tmp_path):
    """A mount table: no task can open these paths itself."""
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.mine.link./in", f"file://{tmp_path}")
    assert [bytes(r.raw_record) for r in read.read_raw(spark, "viewfs://mine/in/flight.idoc").orderBy("record_index").collect()] == FLIGHT
    assert read.read_control(spark, "viewfs://mine/in/*.idoc").count() == 1


def test_records_are_not_shuffled_by_segment(spark, flight, rules):
    """A dictionary whose size Spark cannot tell, as one made of rows, still goes to the tasks and not the records to it."""
    df = read.read_fields(spark, flight, rules)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and df.count() == 5


@pytest.mark.parametrize("codec,end", [("zstd", ".zst"), ("gzip", ".gz")])
def test_compressed_parts_roll_at_documents(spark, tmp_path, rules, codec, end):
    """A folder of compressed files, each of whole documents, gives the records that were written, also as a stream or through Spark alone."""
    from edispark.streaming.landing import stream_raw

    df = spark.createDataFrame([(r,) for r in FLIGHT * 40], "r binary").coalesce(1)
    read.read_raw(spark, _flat(tmp_path / "one"))  # registers the format
    out = tmp_path / "in" / "parts"
    df.write.format("idoc").mode("overwrite").options(layout="parts", compression=codec, roll=20_000).save(str(out))
    files = sorted(out.iterdir())
    # a file is ended by the first document of the next batch of rows; here all rows are one batch or more
    assert all(f.name.endswith(f".idoc{end}") for f in files) and sum(f.stat().st_size for f in files) < 2650 * 40 / 5
    got = [bytes(r.raw_record) for r in read.read_raw(spark, str(out), filename=True).orderBy("filename", "record_index").collect()]
    assert got == FLIGHT * 40
    table = str(tmp_path / "table")
    stream_raw(spark, str(out)).writeStream.format("parquet").option("path", table).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(table).count() == 120
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.zipped.link./in", f"file://{tmp_path}/in")
    assert read.read_raw(spark, "viewfs://zipped/in/parts").count() == 120
    with pytest.raises(Exception, match="needs layout 'parts'"):
        write_idoc(df, str(tmp_path / "x"), compression=codec)


def _flat(path):
    path.write_bytes(b"".join(FLIGHT))
    return str(path)


def test_whole_documents(spark, rules):
    """Documents in any order of rows: numbers, parents, widths and order, with a document without segments."""
    from edispark.plans import compose

    field = "fields array<struct<n:string,v:string>>"
    segments = spark.createDataFrame([(2, 7, "E1NEW", 2, [("PASSNAME", "MUELLER"), ("AIRLINEID", "LH")]), (2, 3, "E1CRE", 1, []), (1, 5, "E1CRE", 1, None)], f"doc long, ord long, segnam string, hlevel int, {field}")
    controls = spark.createDataFrame([(d, "EDI_DC40", f"{d:016d}") for d in (3, 2, 1)], "doc long, tabnam string, docnum string")
    got = [bytes(r.raw_record) for r in compose.whole_documents(spark, controls, segments, rules, ["doc"], "001", "doc", ordered=True).collect()]
    assert [len(r) for r in got] == [524, 1063, 524, 1063, 1063, 524] and [r[:6] == b"EDI_DC" for r in got] == [True, False, True, False, False, True]
    assert [r[33:63] for r in got if r[:6] != b"EDI_DC"] == [b"000000000000000100000100000001", b"000000000000000200000100000001", b"000000000000000200000200000102"]
    assert got[4][63:] == (b"LH".ljust(40) + b"MUELLER").ljust(1000)
    # what is sorted is short: records get their width behind the last exchange and sort
    plan = compose.whole_documents(spark, controls, segments, rules, ["doc"], "001", "doc")._jdf.queryExecution().sparkPlan().toString()
    assert "1063" not in plan.split("Sort", 1)[1] and plan.count("hashpartitioning") <= 3


def test_shuffles_of_a_write_are_removed(spark, tmp_path):
    import time

    def shuffled():
        folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs())
        return {f"{d}/{n}" for top in folders for d, _, names in os.walk(top.toString()) for n in names if n.startswith("shuffle_")}

    before = shuffled()
    df = spark.range(3000).select(encode.encode_control(F.array(F.lit("EDI_DC40"), F.lit("001"), F.col("id").cast("string"))).alias("r"), "id")
    write_idoc(df.repartition(4, "id").select("r"), str(tmp_path / "x"), single=False)
    until = time.time() + 10
    while (left := shuffled() - before) and time.time() < until:
        time.sleep(0.1)
    assert not left and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert read.read_raw(spark, str(tmp_path / "x")).count() == 3000


def test_a_number_that_is_the_key_is_not_shuffled(spark, rules):
    from edispark.plans import compose

    controls = spark.createDataFrame([(7,)], "doc long")
    segments = spark.createDataFrame([(7, 9, 1, "E1CRE", 1)], "doc long, other long, ord int, segnam string, hlevel int").withColumn("fields", F.array().cast("array<struct<n:string,v:string>>"))
    for name, number in (("doc", b"%016d" % 7), ("other", b"%016d" % 9), (None, b"%016d" % 0)):
        got = [bytes(r.raw_record) for r in compose.whole_documents(spark, controls, segments, rules, ["doc"], "001", name).collect()]
        assert [r[33:49] for r in got if len(r) == DATA_LEN] == [number]
