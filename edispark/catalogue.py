"""Queries over the driver's tables and the SQL that states the same results.

The tables hold no IDocs, so files are composed from them: one with a document for each hundred keys of customers
and suppliers, under a nation; a folder of files with a document for each customer and the orders; and
one with a document for each order and its items. Each query reads such a file (or a variant of it)
through the operator it is named after. No document grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edispark.functions import encode
from edispark.functions.layout import CONTROL_FIELDS, DATA_LEN
from edispark.operators import convert, dictionary, read
from edispark.plans import compose
from edispark.shipping import shared_dir
from edispark.sources.idoc import local, register, write_idoc
from edispark.streaming.landing import stream_raw

_MADE: dict[tuple, str | list[str]] = {}
#: Keys of customers and suppliers that share a document.
DOC_KEYS = 100
#: Items are composed in so many turns, so that the disk holds the shuffled rows of one turn only.
TURNS = 4

LAYOUT = [
    ("E1NAT", 1, "NATION", 25), ("E1NAT", 2, "REGION", 25),
    ("E1CUS", 1, "CUSTKEY", 10), ("E1CUS", 2, "NAME", 25), ("E1CUS", 3, "SEGMENT", 10), ("E1CUS", 4, "CENTS", 15),
    ("E1SUP", 1, "SUPPKEY", 10), ("E1SUP", 2, "NAME", 25),
    ("E1ORD", 1, "ORDERKEY", 12), ("E1ORD", 2, "STATUS", 1), ("E1ORD", 3, "DAY", 8), ("E1ORD", 4, "PRIORITY", 15), ("E1ORD", 5, "CENTS", 15),
    ("E1ITM", 1, "PARTKEY", 12), ("E1ITM", 2, "QUANTITY", 6), ("E1ITM", 3, "CENTS", 15), ("E1ITM", 4, "FLAG", 1), ("E1ITM", 5, "DAY", 8),
]


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lengths(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(s, p, n, k, "CHAR") for s, p, n, k in LAYOUT], "segnam string, field_pos int, field_name string, length int, datatype string").coalesce(1)


def layout(spark: SparkSession) -> DataFrame:
    return dictionary.offsets(spark, lengths(spark))


def _cents(c: str):
    return F.round(F.col(c) * 100).cast("long").cast("string")


def _segments(df: DataFrame, segnam: str, hlevel: int, **fields) -> DataFrame:
    pairs = [F.struct(F.lit(n).alias("n"), v.cast("string").alias("v")) for n, v in fields.items()]
    own = F.array(*pairs) if pairs else F.array().cast("array<struct<n:string,v:string>>")
    return df.select("doc", "ord", F.lit(segnam).alias("segnam"), F.lit(hlevel).alias("hlevel"), own.alias("fields"))


def nation_segments(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Controls and segments with their values: a nation, a hundred keys of customers and suppliers, and a tag below each supplier."""
    nation, region = _t(spark, sf_dir, "nation"), _t(spark, sf_dir, "region")
    n = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select("n_nationkey", "n_name", "r_name")
    docs = _t(spark, sf_dir, "customer").select(F.floor(F.col("c_custkey") / DOC_KEYS).cast("long").alias("doc")).distinct()
    n = docs.join(n, F.col("doc") % 25 == F.col("n_nationkey")).select("doc", "n_name", "r_name")
    controls = n.select(
        "doc", F.lit("EDI_DC40").alias("tabnam"), F.lit("001").alias("mandt"), encode.zero_pad(F.col("doc"), 16).alias("docnum"), F.lit("2").alias("direct"),
        F.lit("NATIONS01").alias("idoctyp"), F.col("r_name").alias("mestyp"), F.col("n_name").alias("sndprn"),
    )
    big = F.lit(1_000_000_000_000)
    c = _t(spark, sf_dir, "customer").select(F.floor(F.col("c_custkey") / DOC_KEYS).cast("long").alias("doc"), (big + F.col("c_custkey") * 2).alias("ord"), "*")
    s = _t(spark, sf_dir, "supplier").select(F.floor(F.col("s_suppkey") / DOC_KEYS).cast("long").alias("doc"), (big * 2 + F.col("s_suppkey") * 2).alias("ord"), "*")
    n = n.withColumn("ord", F.lit(1).cast("long"))
    segments = [
        _segments(n, "E1NAT", 1, NATION=F.col("n_name"), REGION=F.col("r_name")),
        _segments(c, "E1CUS", 2, CUSTKEY=encode.zero_pad(F.col("c_custkey"), 10), NAME=F.col("c_name"), SEGMENT=F.col("c_mktsegment"), CENTS=_cents("c_acctbal")),
        _segments(s, "E1SUP", 2, SUPPKEY=encode.zero_pad(F.col("s_suppkey"), 10), NAME=F.col("s_name")),
        _segments(s.withColumn("ord", F.col("ord") + 1), "E1TAG", 3),
    ]
    return controls, segments[0].union(segments[1]).union(segments[2]).union(segments[3])


def _records(spark: SparkSession, controls: DataFrame, segments: DataFrame, ordered: bool = False) -> DataFrame:
    return compose.whole_documents(spark, controls, segments, layout(spark), ["doc"], "001", "doc", ordered)


def _once(spark: SparkSession, key: tuple, make):
    key = (spark.sparkContext.applicationId, *key)
    if key not in _MADE:
        _MADE[key] = make()
    return _MADE[key]


def nations_file(spark: SparkSession, sf_dir: str, framing: str = "fixed", end: str = ".idoc") -> str:
    def make() -> str:
        path = shared_dir(spark, f"nations-{framing}") + end
        write_idoc(_records(spark, *nation_segments(spark, sf_dir), ordered=True), path, framing)
        return path

    return _once(spark, ("nations", sf_dir, framing, end), make)


def orders_file(spark: SparkSession, sf_dir: str) -> str:
    """A document for each customer with a segment for each order."""

    def make() -> str:
        c = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("doc"), "*")
        controls = c.select("doc", F.lit("EDI_DC40").alias("tabnam"), F.lit("001").alias("mandt"), encode.zero_pad(F.col("doc"), 16).alias("docnum"), F.lit("ORDERS01").alias("idoctyp"))
        # order keys begin at 0, so the customer's own segment stands before that
        head = c.select("doc", F.lit(-1).cast("long").alias("ord"), "c_custkey", "c_name", "c_mktsegment", "c_acctbal")
        o = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("ord"), "*")
        segments = _segments(head, "E1CUS", 1, CUSTKEY=encode.zero_pad(F.col("c_custkey"), 10), NAME=F.col("c_name"), SEGMENT=F.col("c_mktsegment"), CENTS=_cents("c_acctbal")).union(
            _segments(o, "E1ORD", 2, ORDERKEY=encode.zero_pad(F.col("o_orderkey"), 12), STATUS=F.col("o_orderstatus"), DAY=F.date_format("o_orderdate", "yyyyMMdd"), PRIORITY=F.col("o_orderpriority"), CENTS=_cents("o_totalprice"))
        )
        path = shared_dir(spark, "orders")
        write_idoc(_records(spark, controls, segments), path, single=False, compression="zstd")
        return path

    return _once(spark, ("orders", sf_dir), make)


def item_records(spark: SparkSession, sf_dir: str, turn: int) -> DataFrame:
    """A document for each order that has items, a segment for each of these below the order's own; those of one turn."""

    def now(df: DataFrame, key: str) -> DataFrame:
        return df.where(F.pmod(F.xxhash64(key), F.lit(TURNS)) == turn)

    line = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    i = now(_t(spark, sf_dir, "lineitem"), "l_orderkey").select(F.col("l_orderkey").alias("doc"), F.struct(F.lit(1).alias("item"), *line).alias("ord"), "*")
    first = F.struct(F.lit(0).alias("item"), *[F.lit(None).cast(i.schema[c].dataType).alias(c) for c in line])
    o = now(_t(spark, sf_dir, "orders"), "o_orderkey").join(i.select(F.col("doc").alias("o_orderkey")).distinct(), "o_orderkey").select(F.col("o_orderkey").alias("doc"), first.alias("ord"), "*")
    controls = o.select("doc", F.lit("EDI_DC40").alias("tabnam"), F.lit("001").alias("mandt"), encode.zero_pad(F.col("doc"), 16).alias("docnum"), F.lit("ITEMS01").alias("idoctyp"))
    segments = _segments(o, "E1ORD", 1, ORDERKEY=encode.zero_pad(F.col("o_orderkey"), 12), STATUS=F.col("o_orderstatus"), DAY=F.date_format("o_orderdate", "yyyyMMdd"), PRIORITY=F.col("o_orderpriority"), CENTS=_cents("o_totalprice")).union(
        _segments(i, "E1ITM", 2, PARTKEY=encode.zero_pad(F.col("l_partkey"), 12), QUANTITY=F.col("l_quantity").cast("long"), CENTS=_cents("l_extendedprice"), FLAG=F.col("l_returnflag"), DAY=F.date_format("l_shipdate", "yyyyMMdd"))
    )
    return _records(spark, controls, segments)


def items_files(spark: SparkSession, sf_dir: str, framing: str = "fixed") -> list[str]:
    """The items as folders of files, one for each turn."""

    def make() -> list[str]:
        paths = [shared_dir(spark, f"items-{framing}") for _ in range(TURNS)]
        for turn, path in enumerate(paths):
            write_idoc(item_records(spark, sf_dir, turn), path, framing, single=False, compression="zstd")
        return paths

    return _once(spark, ("items", sf_dir, framing), make)


def xml_file(spark: SparkSession, sf_dir: str) -> str:
    """The orders as a folder of IDoc-XML files of whole documents."""

    def make() -> str:
        path = shared_dir(spark, "orders-xml")
        convert.write_xml(spark, orders_file(spark, sf_dir), layout(spark), path, compression="zstd")
        return path

    return _once(spark, ("xml", sf_dir), make)


# ---- queries ----


def read_raw_counts(spark, sf_dir):
    return read.read_raw(spark, nations_file(spark, sf_dir)).groupBy("document_key", "record_type").agg(F.count("*").alias("n"), F.sum(F.octet_length("raw_record")).cast("long").alias("n_bytes"))


def read_control(spark, sf_dir):
    return read.read_control(spark, nations_file(spark, sf_dir))


def read_data(spark, sf_dir):
    df = read.read(spark, nations_file(spark, sf_dir))
    return df.select("document_key", "docnum", "segnum", "segnam", "psgnum", "hlevel", "mandt", F.length("sdata").alias("width"), F.rtrim("sdata").alias("sdata"))


def read_segment_customers(spark, sf_dir):
    return read.read_segment(spark, nations_file(spark, sf_dir), "E1CUS", layout(spark))


def read_segment_items(spark, sf_dir):
    return read.read_segment(spark, orders_file(spark, sf_dir), "E1ORD", layout(spark)).drop("document_key")


def read_fields_long(spark, sf_dir):
    # segments without rules have a null position; 0 stands for it here, as engines differ in how they hand nullable integers on
    return read.read_fields(spark, nations_file(spark, sf_dir), layout(spark)).withColumn("field_pos", F.coalesce("field_pos", F.lit(0)))


def read_fields_known(spark, sf_dir):
    return read.read_fields(spark, nations_file(spark, sf_dir), layout(spark), include_unknown=False).groupBy("segnam", "field_name").agg(F.count("*").alias("n"), F.max("value").alias("largest"))


def dict_offsets(spark, sf_dir):
    return dictionary.offsets(spark, lengths(spark))


BROKEN = [("S1", 1, "A", 0, 10), ("S1", 2, "B", 5, 10), ("S1", 3, "C", 995, 20), ("S2", 1, "D", -1, 0), ("S2", 1, "E", 0, 5)]


def dict_validate(spark, sf_dir):
    return dictionary.validate(spark, spark.createDataFrame(BROKEN, "segnam string, field_pos int, field_name string, offset int, length int").coalesce(1))


FIELDS = [("E1CUS", "CUSTKEY", "000001", "000000", "000010", "NUMC", "KEY", "Customer"), ("E1CUS", "NAME", "000002", "000010", "000025", "CHAR", "NAME", "Name")]
_FIELD_TYPE = "array<struct<SEGMENTTYP:string,FIELDNAME:string,FIELD_POS:string,BYTE_FIRST:string,EXTLEN:string,DATATYPE:string,ROLLNAME:string,DESCRP:string>>"


def dict_from_fields(spark, sf_dir):
    df = spark.createDataFrame([(FIELDS,)], f"fields {_FIELD_TYPE}")
    return df.select(F.inline(dictionary.from_fields(df, "fields", "CUST01", "", "620")))


def dict_transform(spark, sf_dir):
    df = spark.createDataFrame([(("620",), FIELDS, [("E1CUS", "E1CUS000"), ("E1CUS", "E1CUS001")])], f"PE_HEADER struct<RELEASED:string>, PT_FIELDS {_FIELD_TYPE}, PT_SEGMENTS array<struct<SEGMENTTYP:string,SEGMENTDEF:string>>")
    return dictionary.dictionary(df, {"PI_IDOCTYP": "CUST01", "PI_CIMTYP": "ZX"})


def dict_params(spark, sf_dir):
    encode.register(spark)
    return spark.sql("SELECT n_name, p.PI_IDOCTYP AS idoctyp, p.PI_CIMTYP AS cimtyp, p.PI_VERSION AS version FROM (SELECT n_name, sap_idoc_params(n_name) AS p FROM {t})", t=_t(spark, sf_dir, "nation"))


def encode_sdata(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    parts = F.array(F.col("c_custkey").cast("string"), F.col("c_name"), F.col("c_mktsegment"))
    return c.select("c_custkey", F.rtrim(encode.encode_sdata(F.array(*map(F.lit, (0, 10, 20))), F.array(*map(F.lit, (10, 25, 12))), parts)).alias("sdata"))


def encode_data_record(spark, sf_dir):
    s = _t(spark, sf_dir, "supplier")
    raw = encode.encode_data_record(F.lit("E1SUP"), F.lit("001"), F.col("s_suppkey"), F.col("s_suppkey") % 1_000_000, F.lit(0), F.lit(2), F.col("s_name"))
    return s.select("s_suppkey", F.octet_length(raw).alias("n_bytes"), F.rtrim(raw.cast("string")).alias("record"))


def encode_control(spark, sf_dir):
    n = _t(spark, sf_dir, "nation")
    raw = encode.encode_control(F.array(F.lit("EDI_DC40"), F.lit("001"), F.col("n_nationkey").cast("string"), F.col("n_name")))
    return n.select("n_nationkey", F.octet_length(raw).alias("n_bytes"), F.rtrim(raw.cast("string")).alias("record"))


def sql_encoders(spark, sf_dir):
    encode.register(spark)
    return spark.sql(
        "SELECT c_custkey, rtrim(sap_idoc_encode_sdata(array(0L, 10L), array(10L, 25L), array(cast(c_custkey as string), c_name))) AS sdata, "
        "octet_length(sap_idoc_encode_data_record('E1CUS', '001', c_custkey, 1L, 0L, 1L, c_name)) AS n_bytes, octet_length(sap_idoc_encode_control(array('EDI_DC40'))) AS c_bytes FROM {t}",
        t=_t(spark, sf_dir, "customer"),
    )


def hierarchy(spark, sf_dir):
    return read.read(spark, nations_file(spark, sf_dir)).select("document_key", "segnam", F.col("segnum").cast("long").alias("segnum"), F.col("psgnum").cast("long").alias("psgnum"), F.col("hlevel").cast("long").alias("hlevel"))


def read_xml(spark, sf_dir):
    """Fields of all files; documents are numbered by file, so the number in a segment's file says nothing here."""
    return convert.read_xml(spark, xml_file(spark, sf_dir)).where("segnam <> 'EDI_DC40'").drop("document_key")


def read_xml_control(spark, sf_dir):
    return read.read_control(spark, xml_file(spark, sf_dir)).select("tabnam", "mandt", "docnum", "idoctyp", "mestyp", "sndprn")


def _digest(df):
    """A digest of each record, with what its head says."""
    text = F.col("raw_record").cast("string")
    return df.select("record_type", F.when(F.col("record_type") == "D", F.substring(text, 34, 16)).otherwise(F.substring(text, 14, 16)).alias("docnum"), F.sha2("raw_record", 256).alias("digest"))


def xml_to_records(spark, sf_dir):
    """Every record made from the XML, by a digest of its bytes."""
    return _digest(convert.xml_to_records(spark, xml_file(spark, sf_dir), layout(spark)))


def flat_xml_flat(spark, sf_dir):
    """Records of flat files that do not come back as they were from the XML made of them, and the number that do."""
    back = _digest(convert.xml_to_records(spark, xml_file(spark, sf_dir), layout(spark))).withColumn("side", F.lit(1))
    flat = _digest(read.read_raw(spark, orders_file(spark, sf_dir))).withColumn("side", F.lit(-1))
    each = back.union(flat).groupBy("record_type", "docnum", "digest").agg(F.sum("side").alias("left"), F.count("*").alias("n"))
    return each.groupBy("record_type").agg(F.sum(F.abs("left")).alias("n_different"), F.sum("n").alias("n_both"))


def to_xml(spark, sf_dir):
    """A digest of each document's whole text."""
    df = convert.to_xml(spark, orders_file(spark, sf_dir), layout(spark), by_document=True)
    return df.select(F.regexp_extract("xml", "<DOCNUM>([0-9]*)</DOCNUM>", 1).alias("docnum"), F.length("xml").alias("n_chars"), F.sha2("xml", 256).alias("digest"))


def read_items(spark, sf_dir):
    """Every item of every order as named columns, with the number of the order's document from the records."""
    return read.read_segment(spark, items_files(spark, sf_dir), "E1ITM", layout(spark)).drop("document_key")


def items_hierarchy(spark, sf_dir):
    return read.read(spark, items_files(spark, sf_dir)).select("docnum", "segnam", F.col("segnum").cast("long").alias("segnum"), F.col("psgnum").cast("long").alias("psgnum"), F.col("hlevel").cast("long").alias("hlevel"))


def items_fields(spark, sf_dir):
    df = read.read_fields(spark, items_files(spark, sf_dir), layout(spark), include_unknown=False)
    return df.groupBy("segnam", "field_name").agg(F.count("*").alias("n"), F.sum(F.length("value")).cast("long").alias("n_chars"), F.min("value").alias("least"), F.max("value").alias("largest"))


def lenient_truncated(spark, sf_dir):
    """Files with line ends whose records all lack their last byte: a strict scan refuses them, a lenient one gives them."""

    def make() -> list[str]:
        paths = [shared_dir(spark, "truncated") for _ in range(TURNS)]
        # cut as they are composed: a whole copy beside the truncated one would take as much disk again
        raw = F.col("raw_record")
        short = F.when(F.octet_length(raw) == DATA_LEN, F.substring(raw, 1, DATA_LEN - 1)).otherwise(raw)
        for turn, path in enumerate(paths):
            write_idoc(item_records(spark, sf_dir, turn).select(short), path, "lf", validate=False, single=False, compression="zstd")
        return paths

    df = read.read_raw(spark, _once(spark, ("truncated", sf_dir), make), lenient=True)
    return df.groupBy("record_type", F.octet_length("raw_record").alias("n_bytes")).agg(F.count("*").alias("n"))


def sql_views(spark, sf_dir):
    """Control records, segments and fields through SQL views alone."""
    register(spark)
    path = shared_dir(spark, "rules")
    layout(spark).coalesce(1).write.option("header", True).csv(path)
    for name, options in {"c": "kind 'control'", "s": f"kind 'segment', segnam 'E1CUS', dict '{path}'", "f": f"kind 'fields', dict '{path}'"}.items():
        spark.sql(f"CREATE OR REPLACE TEMP VIEW idoc_{name} USING idoc OPTIONS (path '{nations_file(spark, sf_dir)}', {options})")
    return spark.sql(
        "SELECT c.docnum, c.mestyp, count(DISTINCT s.segnum) AS customers, max(s.name) AS last_name, max(f.value) AS nation FROM idoc_c c JOIN idoc_s s USING (document_key) "
        "JOIN idoc_f f ON f.document_key = c.document_key AND f.segnam = 'E1NAT' AND f.field_name = 'NATION' GROUP BY c.docnum, c.mestyp"
    )


def dict_sql(spark, sf_dir):
    """Offsets and problems by table functions in SQL."""
    dictionary.register(spark)
    return spark.sql(
        "SELECT segnam, field_name, offset, length, problem FROM sap_idoc_dict_validate(TABLE(SELECT * FROM {b})) UNION ALL SELECT segnam, field_name, offset, length, '' FROM sap_idoc_dict_offsets(TABLE(SELECT * FROM {l}))",
        b=spark.createDataFrame(BROKEN, "segnam string, field_pos int, field_name string, offset int, length int"), l=lengths(spark),
    )


def validate_recipe(spark, sf_dir):
    """The checks of a dictionary as plain SQL over it, which counts a repeated position once."""
    return spark.sql(
        "WITH d AS (SELECT * FROM {b}), o AS (SELECT *, lag(offset + length) OVER (PARTITION BY segnam ORDER BY field_pos, offset) AS before FROM d) "
        "SELECT segnam, field_name, 'offset<0 or length<=0' AS problem FROM d WHERE offset < 0 OR length <= 0 UNION ALL "
        "SELECT segnam, field_name, 'field exceeds SDATA(1000)' FROM d WHERE offset + length > 1000 UNION ALL "
        "SELECT segnam, field_name, 'overlaps the previous field' FROM o WHERE offset < before UNION ALL "
        "SELECT segnam, cast(field_pos AS string), 'duplicate field_pos in segment' FROM d GROUP BY segnam, field_pos HAVING count(*) > 1",
        b=spark.createDataFrame(BROKEN, "segnam string, field_pos int, field_name string, offset int, length int"),
    )


def _framed(framing):
    def query(spark, sf_dir):
        df = read.read(spark, nations_file(spark, sf_dir, framing), framing=None)
        return df.select("document_key", "segnum", "segnam", F.rtrim("sdata").alias("sdata"))

    return query


def multi_file(spark, sf_dir):
    paths = [nations_file(spark, sf_dir), nations_file(spark, sf_dir, "lf")]
    return read.read_control(spark, [*paths, paths[0]]).groupBy("docnum").agg(F.count("*").alias("n"))


def filename_column(spark, sf_dir):
    path = nations_file(spark, sf_dir)
    return read.read(spark, path, filename=True).groupBy((F.col("filename") == local(path)).alias("own_file"), "segnam").agg(F.count("*").alias("n"))


def latin_1(spark, sf_dir):
    """UTF-8 bytes of an umlaut read as Latin-1 are two characters; read as they are, one."""

    def make() -> str:
        path = shared_dir(spark, "latin") + ".idoc"
        n = _t(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("doc"), F.concat(F.lit("Ü"), "n_name").alias("name"))
        head = n.select("doc", F.lit(0).cast("long").alias("ord"), encode.encode_control(F.array(F.lit("EDI_DC40"))).alias("raw_record"))
        body = n.select("doc", F.lit(1).cast("long").alias("ord"), encode.encode_data_record(F.lit("E1NAT"), F.lit("001"), F.col("doc"), F.lit(1), F.lit(0), F.lit(1), F.col("name")).alias("raw_record"))
        write_idoc(compose.file_order(head, body, ["doc"]), path)
        return path

    path = _once(spark, ("latin", sf_dir), make)
    one = read.read_segment(spark, path, "E1NAT", layout(spark)).select("document_key", F.col("nation").alias("plain"))
    two = read.read_segment(spark, path, "E1NAT", layout(spark), encoding="latin-1").select("document_key", F.length("nation").alias("latin_length"))
    return one.join(two, "document_key")


def write_parts(spark, sf_dir):
    """Every record of the orders files, whichever part holds it, by a digest of its bytes."""
    return _digest(read.read_raw(spark, orders_file(spark, sf_dir)))


def stream_landing(spark, sf_dir):
    """Files that land in a folder, read as a stream into a table: every record by a digest of its bytes."""
    out, folder = shared_dir(spark, "landed"), orders_file(spark, sf_dir)
    stream = stream_raw(spark, folder).writeStream.format("parquet").option("path", out).option("checkpointLocation", shared_dir(spark, "landing-state"))
    stream.trigger(availableNow=True).start().awaitTermination()
    return _digest(spark.read.parquet(out))


QUERIES = {
    f.__name__: f
    for f in (
        read_raw_counts, read_control, read_data, read_segment_customers, read_segment_items, read_fields_long, read_fields_known, dict_offsets, dict_validate, dict_from_fields,
        dict_transform, dict_params, encode_sdata, encode_data_record, encode_control, sql_encoders, hierarchy, read_xml, read_xml_control, xml_to_records, to_xml, flat_xml_flat, read_items, items_hierarchy, items_fields, lenient_truncated, sql_views, dict_sql, validate_recipe, multi_file,
        filename_column, latin_1, write_parts, stream_landing,
    )
} | {"framing_lf": _framed("lf"), "framing_crlf": _framed("crlf")}

# ---- SQL ----

_SEGS = f"""
with n as (select doc, n_name, r_name from (select distinct c_custkey::bigint // {DOC_KEYS} as doc from customer) join nation on doc % 25 = n_nationkey join region on n_regionkey = r_regionkey),
seg as (
  select doc, 0 as kind, 0::bigint as key, 0 as sub, 'E1NAT' as segnam, 1 as hlevel, rpad(n_name, 25, ' ') || rpad(r_name, 25, ' ') as sdata from n
  union all select c_custkey // {DOC_KEYS}, 1, c_custkey, 0, 'E1CUS', 2, lpad(c_custkey::varchar, 10, '0') || rpad(c_name, 25, ' ') || rpad(c_mktsegment, 10, ' ') || rpad(round(c_acctbal * 100)::bigint::varchar, 15, ' ') from customer
  union all select s_suppkey // {DOC_KEYS}, 2, s_suppkey, 0, 'E1SUP', 2, lpad(s_suppkey::varchar, 10, '0') || rpad(s_name, 25, ' ') from supplier
  union all select s_suppkey // {DOC_KEYS}, 2, s_suppkey, 1, 'E1TAG', 3, '' from supplier),
num as (select *, row_number() over (partition by doc order by kind, key, sub)::bigint as segnum from seg),
hier as (select *, case hlevel when 1 then 0 when 2 then 1 else segnum - 1 end::bigint as psgnum, doc + 1 as document_key from num)
"""
_DICT_ROWS = ", ".join(f"('{s}', {p}, '{n}', {k})" for s, p, n, k in LAYOUT)
_DICT = f"d as (select segnam, pos::bigint as field_pos, name as field_name, coalesce(sum(len) over (partition by segnam order by pos rows between unbounded preceding and 1 preceding), 0)::bigint as off, len::bigint as len from (values {_DICT_ROWS}) t(segnam, pos, name, len))"
_FRAMED = _SEGS + "select document_key, lpad(segnum::varchar, 6, '0') as segnum, segnam, rtrim(sdata) as sdata from hier"
_BLANK_CONTROL = ", ".join(f"'' as {n.lower()}" for n, _ in CONTROL_FIELDS if n not in ("TABNAM", "MANDT", "DOCNUM", "DIRECT", "IDOCTYP", "MESTYP", "SNDPRN"))
# the orders: a document for each customer, its own segment first
_ORDERS = """
with seg as (
  select c_custkey::bigint as doc, -1::bigint as ord, 'E1CUS' as segnam, 1 as hlevel, lpad(c_custkey::varchar, 10, '0') || rpad(c_name, 25, ' ') || rpad(c_mktsegment, 10, ' ') || rpad(round(c_acctbal * 100)::bigint::varchar, 15, ' ') as sdata,
    [('CUSTKEY', lpad(c_custkey::varchar, 10, '0')), ('NAME', c_name), ('SEGMENT', c_mktsegment), ('CENTS', round(c_acctbal * 100)::bigint::varchar)] as fields from customer
  union all select o_custkey, o_orderkey, 'E1ORD', 2, lpad(o_orderkey::varchar, 12, '0') || rpad(o_orderstatus, 1, ' ') || strftime(o_orderdate, '%Y%m%d') || rpad(o_orderpriority, 15, ' ') || rpad(round(o_totalprice * 100)::bigint::varchar, 15, ' '),
    [('ORDERKEY', lpad(o_orderkey::varchar, 12, '0')), ('STATUS', o_orderstatus), ('DAY', strftime(o_orderdate, '%Y%m%d')), ('PRIORITY', o_orderpriority), ('CENTS', round(o_totalprice * 100)::bigint::varchar)] from orders),
num as (select *, row_number() over (partition by doc order by ord)::bigint as segnum, lpad(doc::varchar, 16, '0') as docnum from seg),
rec as (
  select 'D' as record_type, docnum, rpad(rpad(segnam, 30, ' ') || '001' || docnum || lpad(segnum::varchar, 6, '0') || case hlevel when 1 then '000000' else '000001' end || lpad(hlevel::varchar, 2, '0') || sdata, 1063, ' ') as raw from num
  union all select 'C', lpad(c_custkey::varchar, 16, '0'), rpad('EDI_DC40  001' || lpad(c_custkey::varchar, 16, '0') || rpad('', 10, ' ') || 'ORDERS01', 524, ' ') from customer)
"""
_ITEMS = """
with i as (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice)::bigint as ord from lineitem),
o as (select * from orders where o_orderkey in (select l_orderkey from lineitem))
"""
ORACLE_SQL = {
    "read_raw_counts": _SEGS + "select document_key, 'D' as record_type, count(*) as n, (count(*) * 1063)::bigint as n_bytes from hier group by all union all select doc + 1, 'C', 1, 524 from n",
    "read_control": _SEGS + f"select doc + 1 as document_key, 'EDI_DC40' as tabnam, '001' as mandt, lpad(doc::varchar, 16, '0') as docnum, '2' as direct, 'NATIONS01' as idoctyp, r_name as mestyp, substr(n_name, 1, 10) as sndprn, {_BLANK_CONTROL} from n",
    "read_data": _SEGS + "select document_key, lpad(doc::varchar, 16, '0') as docnum, lpad(segnum::varchar, 6, '0') as segnum, segnam, lpad(psgnum::varchar, 6, '0') as psgnum, lpad(hlevel::varchar, 2, '0') as hlevel, '001' as mandt, 1000::int as width, rtrim(sdata) as sdata from hier",
    "read_segment_customers": _SEGS + "select document_key, lpad(segnum::varchar, 6, '0') as segnum, lpad(c_custkey::varchar, 10, '0') as custkey, c_name as name, c_mktsegment as segment, round(c_acctbal * 100)::bigint::varchar as cents from hier join customer on segnam = 'E1CUS' and key = c_custkey",
    "read_segment_items": "select lpad((1 + row_number() over (partition by o_custkey order by o_orderkey))::varchar, 6, '0') as segnum, lpad(o_orderkey::varchar, 12, '0') as orderkey, o_orderstatus as status, strftime(o_orderdate, '%Y%m%d') as day, o_orderpriority as priority, round(o_totalprice * 100)::bigint::varchar as cents from orders",
    "read_fields_long": _SEGS.rstrip() + f", {_DICT} " + "select document_key, lpad(segnum::varchar, 6, '0') as segnum, lpad(psgnum::varchar, 6, '0') as psgnum, lpad(hlevel::varchar, 2, '0') as hlevel, hier.segnam, coalesce(field_pos, 0)::int as field_pos, field_name, case when field_name is not null then 'CHAR' end as datatype, case when field_name is null then rtrim(sdata) else rtrim(substr(sdata, off + 1, len)) end as value from hier left join d on hier.segnam = d.segnam",
    "read_fields_known": _SEGS.rstrip() + f", {_DICT} " + "select hier.segnam, field_name, count(*) as n, max(rtrim(substr(sdata, off + 1, len))) as largest from hier join d on hier.segnam = d.segnam group by all",
    "dict_offsets": f"with {_DICT} select segnam, field_pos, field_name, off as \"offset\", len as length, 'CHAR' as datatype from d",
    "dict_validate": "select segnam, field_name, \"offset\"::bigint as \"offset\", length::bigint as length, problem from (values ('S1', 'B', 5, 10, 'overlaps the previous field'), ('S1', 'C', 995, 20, 'field exceeds SDATA(1000)'), ('S2', 'D', -1, 0, 'offset<0 or length<=0'), ('S2', 'E', 0, 5, 'duplicate field_pos in segment')) t(segnam, field_name, \"offset\", length, problem)",
    "dict_from_fields": "select 'CUST01' as idoctyp, '' as cimtyp, '620' as release, 'E1CUS' as segnam, null::varchar as segdef, p::int as field_pos, f as field_name, o::int as \"offset\", l::int as length, t as datatype, e as data_element, x as description, false as mandatory from (values (1, 'CUSTKEY', 0, 10, 'NUMC', 'KEY', 'Customer'), (2, 'NAME', 10, 25, 'CHAR', 'NAME', 'Name')) v(p, f, o, l, t, e, x)",
    "dict_transform": "select 'CUST01' as idoctyp, 'ZX' as cimtyp, '620' as release, 'E1CUS' as segnam, 'E1CUS000' as segdef, p::int as field_pos, f as field_name, o::int as \"offset\", l::int as length, t as datatype, e as data_element, x as description, false as mandatory from (values (1, 'CUSTKEY', 0, 10, 'NUMC', 'KEY', 'Customer'), (2, 'NAME', 10, 25, 'CHAR', 'NAME', 'Name')) v(p, f, o, l, t, e, x)",
    "dict_params": "select n_name, n_name as idoctyp, '' as cimtyp, '4' as version from nation",
    "encode_sdata": "select c_custkey, rtrim(substr(rpad(c_custkey::varchar, 10, ' ') || rpad(c_name, 25, ' '), 1, 20) || rpad(c_mktsegment, 12, ' ') || substr(rpad(c_custkey::varchar, 10, ' ') || rpad(c_name, 25, ' '), 33)) as sdata from customer",
    "encode_data_record": "select s_suppkey, 1063::int as n_bytes, rtrim(rpad('E1SUP', 30, ' ') || '001' || lpad(s_suppkey::varchar, 16, '0') || lpad((s_suppkey % 1000000)::varchar, 6, '0') || '000000' || '02' || s_name) as record from supplier",
    "encode_control": "select n_nationkey, 524::int as n_bytes, rtrim(rpad('EDI_DC40', 10, ' ') || '001' || rpad(n_nationkey::varchar, 16, ' ') || substr(n_name, 1, 4)) as record from nation",
    "sql_encoders": "select c_custkey, rtrim(rpad(c_custkey::varchar, 10, ' ') || rpad(c_name, 25, ' ')) as sdata, 1063::int as n_bytes, 524::int as c_bytes from customer",
    "hierarchy": _SEGS + "select document_key, segnam, segnum, psgnum, hlevel::bigint as hlevel from hier",
    "read_xml": _ORDERS + "select segnum as seq, segnam, hlevel::int as hlevel, f[1] as field_name, f[2] as value from (select segnum, segnam, hlevel, unnest(fields) as f from num) where f[2] <> ''",
    "read_xml_control": _ORDERS + "select 'EDI_DC40' as tabnam, '001' as mandt, docnum, 'ORDERS01' as idoctyp, '' as mestyp, '' as sndprn from rec where record_type = 'C'",
    "xml_to_records": _ORDERS + "select record_type, docnum, sha256(raw) as digest from rec",
    "to_xml": _ORDERS.rstrip() + r""",
own as (select *, repeat(' ', 4 + 2 * hlevel) as pad from num),
body as (select docnum, ord, segnam, hlevel, pad || '<' || segnam || ' SEGMENT="1">' || chr(10) || coalesce(list_aggregate(list_transform(list_filter(fields, lambda f: f[2] <> ''), lambda f: pad || '  <' || f[1] || '>' || replace(replace(replace(f[2], '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</' || f[1] || '>' || chr(10)), 'string_agg', ''), '') as open from own),
docs as (select docnum, string_agg(open || case when hlevel = 2 then '        </E1ORD>' || chr(10) else '' end, '' order by ord) as inner_text from body group by docnum),
texts as (select docnum, '<?xml version="1.0" encoding="utf-8"?>' || chr(10) || '<ORDERS01>' || chr(10) || '  <IDOC BEGIN="1">' || chr(10) || '    <EDI_DC40 SEGMENT="1">' || chr(10) || '      <TABNAM>EDI_DC40</TABNAM>' || chr(10)
  || '      <MANDT>001</MANDT>' || chr(10) || '      <DOCNUM>' || docnum || '</DOCNUM>' || chr(10) || '      <IDOCTYP>ORDERS01</IDOCTYP>' || chr(10) || '    </EDI_DC40>' || chr(10)
  || inner_text || '      </E1CUS>' || chr(10) || '  </IDOC>' || chr(10) || '</ORDERS01>' || chr(10) as xml from docs)
select docnum, length(xml)::int as n_chars, sha256(xml) as digest from texts""",
    "multi_file": _SEGS + "select lpad(doc::varchar, 16, '0') as docnum, 3::bigint as n from n",
    "filename_column": _SEGS + "select true as own_file, segnam, count(*) as n from hier group by all",
    "latin_1": "select n_nationkey::bigint + 1 as document_key, 'Ü' || n_name as plain, (length(n_name) + 2)::int as latin_length from nation",
    "write_parts": _ORDERS + "select record_type, docnum, sha256(raw) as digest from rec",
    "stream_landing": _ORDERS + "select record_type, docnum, sha256(raw) as digest from rec",
    "flat_xml_flat": _ORDERS + "select record_type, 0::bigint as n_different, 2 * count(*) as n_both from rec group by record_type",
    "read_items": _ITEMS + "select lpad((ord + 1)::varchar, 6, '0') as segnum, lpad(l_partkey::varchar, 12, '0') as partkey, l_quantity::bigint::varchar as quantity, round(l_extendedprice * 100)::bigint::varchar as cents, l_returnflag as flag, strftime(l_shipdate, '%Y%m%d') as day from i",
    "items_hierarchy": _ITEMS + "select lpad(o_orderkey::varchar, 16, '0') as docnum, 'E1ORD' as segnam, 1::bigint as segnum, 0::bigint as psgnum, 1::bigint as hlevel from o union all select lpad(l_orderkey::varchar, 16, '0'), 'E1ITM', ord + 1, 1, 2 from i",
    "items_fields": _ITEMS.rstrip() + """,
f as (select 'E1ORD' as segnam, unnest(['ORDERKEY', 'STATUS', 'DAY', 'PRIORITY', 'CENTS']) as field_name, unnest([lpad(o_orderkey::varchar, 12, '0'), o_orderstatus, strftime(o_orderdate, '%Y%m%d'), o_orderpriority, round(o_totalprice * 100)::bigint::varchar]) as value from o
  union all select 'E1ITM', unnest(['PARTKEY', 'QUANTITY', 'CENTS', 'FLAG', 'DAY']), unnest([lpad(l_partkey::varchar, 12, '0'), l_quantity::bigint::varchar, round(l_extendedprice * 100)::bigint::varchar, l_returnflag, strftime(l_shipdate, '%Y%m%d')]) from i)
select segnam, field_name, count(*) as n, sum(length(value))::bigint as n_chars, min(value) as least, max(value) as largest from f group by all""",
    "lenient_truncated": _ITEMS + "select 'C' as record_type, 524::int as n_bytes, count(*) as n from o union all select 'D', 1062, (select count(*) from o) + count(*) from i",
    "sql_views": _SEGS + "select lpad(doc::varchar, 16, '0') as docnum, r_name as mestyp, count(*) as customers, max(c_name) as last_name, n_name as nation from n join hier using (doc) join customer on segnam = 'E1CUS' and key = c_custkey group by doc, r_name, n_name",
    "dict_sql": f"with {_DICT} select segnam, field_name, off as \"offset\", len as length, '' as problem from d union all select segnam, field_name, \"offset\"::bigint, length::bigint, problem from (values ('S1', 'B', 5, 10, 'overlaps the previous field'), ('S1', 'C', 995, 20, 'field exceeds SDATA(1000)'), ('S2', 'D', -1, 0, 'offset<0 or length<=0'), ('S2', 'E', 0, 5, 'duplicate field_pos in segment')) t(segnam, field_name, \"offset\", length, problem)",
    "validate_recipe": "select * from (values ('S1', 'B', 'overlaps the previous field'), ('S1', 'C', 'field exceeds SDATA(1000)'), ('S2', 'D', 'offset<0 or length<=0'), ('S2', '1', 'duplicate field_pos in segment')) t(segnam, field_name, problem)",
    "framing_lf": _FRAMED,
    "framing_crlf": _FRAMED,
}
