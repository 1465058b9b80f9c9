"""Readers over the raw record scan: slicing, decoding and trimming are Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edispark.functions.layout import CONTROL_FIELDS, CONTROL_LEN, DATA_FIELDS, DATA_LEN, SDATA_LEN, decoded, placed, slice_of
from edispark.operators import dictionary
from edispark.sources.idoc import raw_scan

Paths = str | list[str]


def checked(raw: Column, least: int | Column) -> Column:
    """The record, or an error where a lenient scan has let a short one through."""
    return F.when(F.octet_length(raw) >= least, raw).otherwise(F.raise_error(F.concat(F.lit("record is too short: "), F.octet_length(raw).cast("string"), F.lit(" bytes"))).cast("binary"))


def _ends(df: DataFrame, columns: list, filename: bool | None) -> DataFrame:
    return df.select(*columns, *(["filename"] if filename else []))


def read_raw(spark: SparkSession, path: Paths, framing: str | None = None, lenient: bool | None = False, encoding: str | None = None, filename: bool | None = False) -> DataFrame:
    """``document_key, record_index, record_type, raw_record[, filename]``; exact bytes. ``encoding`` changes nothing."""
    return _ends(raw_scan(spark, path, framing, lenient), ["document_key", "record_index", "record_type", "raw_record"], filename)


def data_records(raw: DataFrame) -> DataFrame:
    """Data records with their header fields as text and ``sdata`` as bytes."""
    at = {n: (o, k) for n, o, k in placed(DATA_FIELDS)}
    df = raw.where("record_type = 'D'").withColumn("_r", checked(F.col("raw_record"), DATA_LEN))
    heads = [F.rtrim(slice_of(F.col("_r"), *at[n]).cast("string")).alias(n.lower()) for n in ("DOCNUM", "SEGNUM", "SEGNAM", "PSGNUM", "HLEVEL", "MANDT")]
    return df.select("document_key", "record_index", "filename", *heads, slice_of(F.col("_r"), *at["SDATA"]).alias("sdata"))


def read(spark: SparkSession, path: Paths, framing: str | None = None, lenient: bool | None = False, encoding: str | None = None, filename: bool | None = False) -> DataFrame:
    """``document_key, docnum, segnum, segnam, psgnum, hlevel, mandt, sdata[, filename]``; ``sdata`` keeps its blanks."""
    df = data_records(raw_scan(spark, path, framing, lenient, only="D")).withColumn("sdata", decoded(F.col("sdata"), encoding))
    return _ends(df, ["document_key", "docnum", "segnum", "segnam", "psgnum", "hlevel", "mandt", "sdata"], filename)


def control_columns(raw: DataFrame, encoding: str | None = None) -> DataFrame:
    df = raw.where("record_type = 'C'").withColumn("_r", checked(F.col("raw_record"), CONTROL_LEN))
    return df.select("document_key", *[F.rtrim(decoded(slice_of(F.col("_r"), o, k), encoding)).alias(n.lower()) for n, o, k in placed(CONTROL_FIELDS)], "filename")


def read_control(spark: SparkSession, path: Paths, framing: str | None = None, lenient: bool | None = False, encoding: str | None = None, filename: bool | None = False) -> DataFrame:
    """``document_key`` and the 36 control fields; flat files and IDoc-XML alike."""
    df = control_columns(raw_scan(spark, path, framing, lenient, xml_control=True, only="C"), encoding)
    return _ends(df, [c for c in df.columns if c != "filename"], filename)


def read_segment(spark: SparkSession, path: Paths, segnam: str, dict_source, framing: str | None = None, lenient: bool | None = False, encoding: str | None = None, filename: bool | None = False) -> DataFrame:
    """``document_key, segnum`` and a column for each field of one segment type, in dictionary order.

    The dictionary's few rows for the segment are read when the plan is made, as they name the columns.
    A field name that occurs again gets ``_1``, ``_2`` and so on.
    """
    rules = dictionary.rules(spark, dict_source).where(F.col("segnam") == segnam).orderBy("field_pos", "_ord").collect()
    if not rules:
        raise ValueError(f"dictionary has no fields for segment '{segnam}'")
    columns, seen = [], {}
    for r in rules:
        o, n = r["offset"], r["length"]
        if o is None or n is None or o < 0 or n < 0 or o + n > SDATA_LEN:
            raise ValueError(f"field '{r['field_name']}' offset/length out of SDATA bounds")
        name = (r["field_name"] or "").lower()
        seen[name] = seen.get(name, -1) + 1
        columns.append(F.rtrim(decoded(slice_of(F.col("sdata"), o, n), encoding)).alias(f"{name}_{seen[name]}" if seen[name] else name))
    df = data_records(raw_scan(spark, path, framing, lenient, only="D", segnam=segnam)).where(F.col("segnam") == segnam)
    return _ends(df, ["document_key", "segnum", *columns], filename)


def read_fields(spark: SparkSession, path: Paths, dict_source, framing: str | None = None, lenient: bool | None = False, encoding: str | None = None, filename: bool | None = False, include_unknown: bool | None = True) -> DataFrame:
    """A row for each record and dictionary field; segments the dictionary lacks give one row with their trimmed data.

    A dictionary of usual size goes to every task, so that the records are not shuffled.
    """
    keep = include_unknown is None or include_unknown
    rules = dictionary.rules(spark, dict_source)
    bad = (F.col("offset") < 0) | (F.col("length") < 0) | (F.col("offset") + F.col("length") > SDATA_LEN)
    first = rules.where(bad).orderBy("segnam", "field_pos").first()
    if first is not None:
        raise ValueError(f"field '{first['field_name']}' offset/length out of SDATA bounds")
    data = data_records(raw_scan(spark, path, framing, lenient, only="D"))
    both = data.join(dictionary.beside(rules), "segnam", "left" if keep else "inner")
    known = F.col("_ord").isNotNull()
    cut = F.substring(F.col("sdata"), (F.col("offset") + 1).cast("int"), F.col("length").cast("int"))
    value = F.rtrim(decoded(F.when(known, cut).otherwise(F.col("sdata")), encoding))
    return _ends(
        both,
        ["document_key", "segnum", "psgnum", "hlevel", "segnam", F.col("field_pos").cast("int").alias("field_pos"), "field_name", F.nullif("datatype", F.lit("")).alias("datatype"), value.alias("value")],
        filename,
    )
