"""Between flat records and IDoc-XML."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edispark.functions.encode import encode_control, encode_data_record, encode_sdata_bytes
from edispark.functions.layout import CONTROL_FIELDS, CONTROL_LEN, DATA_FIELDS, DATA_LEN, SDATA_LEN, placed, slice_of
from edispark.operators import dictionary
from edispark.operators.read import checked
from edispark.shipping import ship
from edispark.sources import xml
from edispark.sources.idoc import files_of, raw_scan, sized_files, write_idoc, xml_segments
from edispark.sources.stores import codec_of

RULE_LIST = "array<struct<field_pos:bigint,_ord:bigint,field_name:string,offset:bigint,length:bigint>>"


def _layout(spark: SparkSession, dict_source) -> DataFrame:
    """``segnam, rules``: each segment's rules in order."""
    each = F.struct("field_pos", "_ord", "field_name", "offset", "length")
    rules = dictionary.rules(spark, dict_source)
    return dictionary.beside(rules.groupBy("segnam").agg(F.array_sort(F.collect_list(each)).alias("rules")))


def read_xml(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``document_key, seq, segnam, hlevel, field_name, value``; the control record is seq 0.

    A segment without fields gives one row with empty name and value.
    """
    none = F.array(F.struct(*[F.lit("").alias(c) for c in "nvu"]))
    fields = F.when((F.col("seq") > 0) & (F.size("fields") == 0), none).otherwise(F.col("fields"))
    rows = xml_segments(spark, path).select("document_key", "seq", "segnam", "hlevel", F.explode(fields).alias("f"))
    return rows.select("document_key", "seq", "segnam", "hlevel", F.col("f.n").alias("field_name"), F.col("f.v").alias("value"))


def _value(fields, upper_name):
    """The first value of a name in upper case among fields with ``u``, their names in upper case; empty if absent."""
    return F.coalesce(F.get(F.filter(fields, lambda f: f["u"] == upper_name), F.lit(0))["v"], F.lit(""))


def xml_to_records(spark: SparkSession, path: str | list[str], dict_source) -> DataFrame:
    """``document_key, record_index, record_type, raw_record`` (and ``filename``) of IDoc-XML files.

    One pass over the files; the dictionary goes to every task.
    """
    files = files_of(spark, path)
    segments = xml_segments(spark, files)
    if len(files) < spark.sparkContext.defaultParallelism:
        # few files are parsed by few tasks; their segments are encoded by all
        segments = segments.repartition(_tasks(spark), "filename", "document_key", "seq")
    df = segments.join(_layout(spark, dict_source), "segnam", "left")
    fields = F.col("fields")
    control = encode_control(F.array(*[_value(fields, F.lit(n)) for n, _ in CONTROL_FIELDS]))
    rules = F.coalesce(F.col("rules"), F.array().cast(RULE_LIST))
    sdata = encode_sdata_bytes(F.transform(rules, lambda r: r["offset"]), F.transform(rules, lambda r: r["length"]), F.transform(rules, lambda r: _value(fields, F.upper(r["field_name"]))))
    number = F.when(F.col("docnum") == "", F.lit(0)).otherwise(F.col("docnum").cast("long"))
    data = encode_data_record(F.col("segnam"), F.col("mandt"), number, F.col("seq"), F.col("psgnum"), F.col("hlevel"), sdata)
    head = F.col("seq") == 0
    return df.select(
        "document_key", (F.col("first_index") + F.col("seq")).alias("record_index"), F.when(head, "C").otherwise("D").alias("record_type"), F.when(head, control).otherwise(data).alias("raw_record"), "filename"
    )


def _tasks(spark: SparkSession) -> int:
    """Partitions of rows that cost more time than their bytes tell: as many as a shuffle has, at least one for each core."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


#: Bytes of flat records in one task of those that put documents together, about; compressed files count as so many times their size.
TASK_BYTES, COMPRESSED = 256 << 20, 24


def documents_xml(spark: SparkSession, path: str | list[str], dict_source) -> DataFrame:
    """``filename, document_key, kind, xml``: the root element's name and the IDOC element of each document of flat files."""
    ship(spark)
    at = {n: (o, k) for n, o, k in placed(DATA_FIELDS)}
    idoctyp = next((o, k) for n, o, k in placed(CONTROL_FIELDS) if n == "IDOCTYP")
    head = F.col("record_type") == "C"
    raw = raw_scan(spark, path).withColumn("_r", checked(F.col("raw_record"), F.when(head, CONTROL_LEN).otherwise(DATA_LEN)))
    own = F.rtrim(slice_of(F.col("_r"), *at["SEGNAM"]).cast("string"))
    hlevel = F.trim(slice_of(F.col("_r"), *at["HLEVEL"]).cast("string"))
    level = F.when(head, 0).when(hlevel == "", 1).otherwise(F.coalesce(hlevel.try_cast("int"), F.lit(1)))
    df = raw.select("filename", "document_key", "record_index", "_r", head.alias("head"), F.when(head, "EDI_DC40").otherwise(own).alias("segnam"), level.alias("level"))
    df = df.join(_layout(spark, dict_source), "segnam", "left")
    control = F.array(*[F.struct(F.lit(n).alias("n"), F.rtrim(slice_of(F.col("_r"), o, w).cast("string")).alias("v")) for n, o, w in placed(CONTROL_FIELDS)])

    def cut(r):
        inside = (r["offset"] >= 0) & (r["length"] >= 0) & (r["offset"] + r["length"] <= SDATA_LEN)
        text = F.rtrim(F.substring(F.col("_r"), (r["offset"] + at["SDATA"][0] + 1).cast("int"), r["length"].cast("int")).cast("string"))
        return F.struct(r["field_name"].alias("n"), F.when(inside, text).otherwise(F.lit("")).alias("v"))

    fields = F.when(F.col("head"), control).otherwise(F.transform(F.coalesce("rules", F.array().cast(RULE_LIST)), cut))
    # each record's own lines are text before any Python sees them; only the ends of segments depend on their neighbours
    pad = F.repeat(F.lit(" "), F.when(F.col("head"), 6).otherwise(F.lit(6) + F.col("level") * 2).cast("int"))
    escaped = F.transform(F.filter(fields, lambda f: f["v"] != ""), lambda f: F.concat(pad, F.lit("<"), f["n"], F.lit(">"), _escaped(f["v"]), F.lit("</"), f["n"], F.lit(">\n")))
    rows = df.select("filename", "document_key", "record_index", "segnam", "level", F.array_join(escaped, "").alias("lines"), F.when(F.col("head"), F.rtrim(slice_of(F.col("_r"), *idoctyp).cast("string"))).alias("kind"))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents from rows in their order; one document is held at a time."""
        own, out, stack, kind = None, [], xml.OpenSegments(), ""
        made: list[tuple] = []

        def close() -> None:
            if own is not None:
                made.append((*own, kind or "IDOC", "".join([*out, *stack.leave(1), xml.IDOC_END])))

        def batch() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*made, strict=True), (pa.string(), pa.int64(), pa.string(), pa.string()), strict=True)]
            made.clear()
            return pa.RecordBatch.from_arrays(columns, ["filename", "document_key", "kind", "xml"])

        for rows in batches:
            for filename, document, _, name, level, lines, k in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                if own != (filename, document):
                    close()
                    own, out, kind = (filename, document), [xml.IDOC_HEAD, xml.IDOC_CONTROL_END], ""
                if level == 0:
                    out[1], kind = lines + xml.IDOC_CONTROL_END, k
                else:
                    out += [*stack.leave(level), stack.enter(name, level), lines]
            if made:
                yield batch()
        close()
        if made:
            yield batch()

    n_bytes = sum(n * (COMPRESSED if codec_of(f) else 1) for f, n in sized_files(spark, path))
    ordered = rows.repartition(max(_tasks(spark), n_bytes // TASK_BYTES), "filename", "document_key").sortWithinPartitions("filename", "document_key", "record_index")
    return ordered.mapInArrow(emit, "filename string, document_key long, kind string, xml string")


def _escaped(text):
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(sign), F.lit(name))
    return text


def write_xml(spark: SparkSession, path: str | list[str], dict_source, folder: str, compression: str | None = None) -> None:
    """A folder of well-formed IDoc-XML files of the documents of flat files, a file for each task; a task holds one document at a time."""

    def framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = False
        for batch in batches:
            if batch.num_rows and not some:
                some = True
                yield pa.RecordBatch.from_arrays([pa.array([f"{xml.HEAD}<IDOCS>\n"])], ["xml"])
            yield batch
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(["</IDOCS>\n"])], ["xml"])

    texts = documents_xml(spark, path, dict_source).select("xml").mapInArrow(framed, "xml string")
    write_idoc(texts, folder, validate=False, single=False, compression=compression, extension="xml")


def to_xml(spark: SparkSession, path: str | list[str], dict_source, by_document: bool = False, one_root: bool = False) -> DataFrame:
    """One row ``xml`` for each file, with one root element for each document as the flat file holds them.

    A file's text is one value, up to 2 GB; of larger files take ``by_document``, or ``write_xml`` for files.

    ``by_document`` gives a well-formed text for each document instead, and scales with their number.
    ``one_root`` wraps a file's documents in one element, which makes a text of several well-formed.
    """
    docs = documents_xml(spark, path, dict_source)
    rooted = F.concat(F.lit("<"), F.col("kind"), F.lit(">\n"), F.col("xml"), F.lit("</"), F.col("kind"), F.lit(">\n"))
    if by_document:
        return docs.select("filename", "document_key", F.concat(F.lit(xml.HEAD), rooted).alias("xml"))
    files = docs.withColumn("xml", F.col("xml") if one_root else rooted).groupBy("filename").agg(F.array_sort(F.collect_list(F.struct("document_key", "xml"))).alias("d"))
    body = F.array_join(F.transform("d", lambda d: d["xml"]), "")
    return files.select(F.concat(F.lit(xml.HEAD), F.lit("<IDOCS>\n"), body, F.lit("</IDOCS>\n")).alias("xml") if one_root else F.concat(F.lit(xml.HEAD), body).alias("xml"))
