"""Segment dictionaries: where they come from, offsets, validation, and normalising field lists."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn

from edispark.functions.layout import SDATA_LEN
from edispark.shipping import ship
from edispark.sources.kinds import struct_of

_NAME = re.compile(r'^[A-Za-z0-9_.$"`]+$')


def resolve(spark: SparkSession, source: DataFrame | str) -> DataFrame:
    """A dictionary from a DataFrame, a csv, parquet or json path, a query in parentheses, or a table or view name."""
    if isinstance(source, DataFrame):
        return source
    if source.endswith(".csv"):
        return spark.read.csv(source, header=True, inferSchema=True)
    if source.endswith(".parquet"):
        return spark.read.parquet(source)
    if source.endswith(".json"):
        return spark.read.json(source)
    if "(" in source:
        return spark.sql(source if re.match(r"\s*(select|with|values|table)\b", source, re.IGNORECASE) else f"SELECT * FROM {source}")
    if "/" in source or "\\" in source:
        return spark.read.csv(source, header=True, inferSchema=True)
    if not _NAME.match(source):
        raise ValueError(f"'{source}' is not a file path, a valid table/view name, or a relation expression")
    return spark.table(source.replace('"', "`"))


def _columns(df: DataFrame, needed: list[str]) -> None:
    have = {c.lower() for c in df.columns}
    for c in needed:
        if c not in have:
            raise ValueError(f"dictionary is missing the required column '{c}'")


def rules(spark: SparkSession, source: DataFrame | str) -> DataFrame:
    """``segnam, field_pos, field_name, offset, length, datatype`` and ``_ord``, a number in the order of the source."""
    df = resolve(spark, source)
    _columns(df, ["segnam", "field_pos", "field_name", "offset", "length"])
    kind = F.col("datatype") if "datatype" in {c.lower() for c in df.columns} else F.lit(None)
    return df.select(
        F.col("segnam").cast("string"), F.col("field_pos").cast("long"), F.col("field_name").cast("string"), F.col("offset").cast("long"), F.col("length").cast("long"),
        kind.cast("string").alias("datatype"), F.monotonically_increasing_id().alias("_ord"),
    )


#: A dictionary of so many rows at most goes whole to every task.
BROADCAST_ROWS = 500_000


def beside(rows: DataFrame) -> DataFrame:
    """A dictionary's rows for a join with records: its segments are few, so that a shuffle by them would put most records into one task.

    The rows are counted before they are sent; a larger dictionary is left to Spark's own choice.
    """
    return F.broadcast(rows) if rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else rows


def _filled(spark: SparkSession, source, with_offset: bool) -> DataFrame:
    df = resolve(spark, source)
    _columns(df, ["segnam", "field_pos", "field_name", "length"] + ["offset"] * with_offset)
    have = {c.lower() for c in df.columns}

    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in have else F.lit("").alias(c)

    def number(c: str) -> Column:
        return F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")).alias(c)

    columns = [text("segnam"), number("field_pos"), text("field_name"), number("length"), text("datatype")] + [number("offset")] * with_offset
    return df.select(*columns, F.monotonically_increasing_id().alias("_ord"))


def offsets(spark: SparkSession, source: DataFrame | str) -> DataFrame:
    """Fields with offsets as running sums of the lengths before them in their segment."""
    w = Window.partitionBy("segnam").orderBy("field_pos", "_ord").rowsBetween(Window.unboundedPreceding, -1)
    df = _filled(spark, source, False)
    return df.select("segnam", "field_pos", "field_name", F.coalesce(F.sum("length").over(w), F.lit(0)).alias("offset"), "length", F.nullif("datatype", F.lit("")).alias("datatype"))


def validate(spark: SparkSession, source: DataFrame | str) -> DataFrame:
    """``segnam, field_name, offset, length, problem``, a row for each problem; none for a sound dictionary."""
    w = Window.partitionBy("segnam").orderBy("field_pos", "_ord")
    end = F.col("offset") + F.col("length")
    df = _filled(spark, source, True).withColumn("_prev", F.lag(end).over(w)).withColumn("_nth", F.row_number().over(Window.partitionBy("segnam", "field_pos").orderBy("_ord")))
    problems = F.array(
        F.when((F.col("offset") < 0) | (F.col("length") <= 0), "offset<0 or length<=0"),
        F.when(end > SDATA_LEN, f"field exceeds SDATA({SDATA_LEN})"),
        F.when((F.col("_prev") >= 0) & (F.col("offset") < F.col("_prev")), "overlaps the previous field"),
        F.when(F.col("_nth") > 1, "duplicate field_pos in segment"),
    )
    return df.select("segnam", "field_name", "offset", "length", F.explode(F.array_compact(problems)).alias("problem"))


DICT_TYPE = (
    "struct<idoctyp:string,cimtyp:string,release:string,segnam:string,segdef:string,field_pos:int,field_name:string,offset:int,length:int,"
    "datatype:string,data_element:string,description:string,mandatory:boolean>"
)


def _entry(df: DataFrame, fields: str, f: Column, idoctyp: Column, cimtyp: Column, release: Column, segdef: Column) -> Column:
    """A dictionary row from one element of a field list; names match in any case and missing ones are null."""
    names = {x.name.lower(): x.name for x in df.select(fields).schema[0].dataType.elementType.fields}

    def get(name: str, kind: str) -> Column:
        got = f[names[name.lower()]] if name.lower() in names else F.lit(None)
        # numbers come as text with leading zeros
        return (F.expr("cast(null as int)") if name.lower() not in names else got.cast("string").try_cast("int")) if kind == "int" else got.cast("string")

    columns = [
        ("idoctyp", idoctyp), ("cimtyp", cimtyp), ("release", release), ("segnam", get("SEGMENTTYP", "string")), ("segdef", segdef), ("field_pos", get("FIELD_POS", "int")),
        ("field_name", get("FIELDNAME", "string")), ("offset", get("BYTE_FIRST", "int")), ("length", get("EXTLEN", "int")), ("datatype", get("DATATYPE", "string")),
        ("data_element", get("ROLLNAME", "string")), ("description", get("DESCRP", "string")), ("mandatory", F.lit(False)),
    ]
    return F.struct(*[c.alias(n) for n, c in columns]).cast(DICT_TYPE)


def from_fields(df: DataFrame, fields: str, idoctyp: str, cimtyp: str, release: str) -> Column:
    """An array of dictionary rows from the field list in column ``fields`` of ``df``; null gives an empty array."""
    given = (F.lit(idoctyp), F.lit(cimtyp), F.lit(release), F.lit(None).cast("string"))
    return F.coalesce(F.transform(F.col(fields), lambda f: _entry(df, fields, f, *given)), F.array().cast(f"array<{DICT_TYPE}>"))


def dictionary(raw: DataFrame, params: dict[str, str]) -> DataFrame:
    """The 13-column dictionary from the result of a type read: ``PE_HEADER``, ``PT_FIELDS``, ``PT_SEGMENTS``.

    The caller fetches that result; ``params`` are PI_IDOCTYP and PI_CIMTYP as for the fetch.
    """
    one = raw.select("PE_HEADER", F.posexplode("PT_FIELDS").alias("_pos", "_f"), "PT_FIELDS")
    given = (F.lit(params["PI_IDOCTYP"]), F.lit(params.get("PI_CIMTYP", "")), F.col("PE_HEADER.RELEASED").cast("string"), F.lit(None).cast("string"))
    fields = one.select(_entry(raw, "PT_FIELDS", F.col("_f"), *given).alias("d")).select("d.*").drop("segdef")
    segments = raw.select(F.posexplode("PT_SEGMENTS").alias("p", "s")).groupBy(F.col("s.SEGMENTTYP").alias("segnam")).agg(F.min_by("s.SEGMENTDEF", "p").alias("segdef"))
    out = fields.join(segments, "segnam", "left")
    return out.select("idoctyp", "cimtyp", "release", "segnam", "segdef", "field_pos", "field_name", "offset", "length", "datatype", "data_element", "description", "mandatory").orderBy("segnam", "field_pos")


# ---- SQL forms ----


def _ordered_by_segment(columns: str) -> AnalyzeResult:
    return AnalyzeResult(schema=struct_of(columns), partitionBy=[PartitioningColumn("segnam")], orderBy=[OrderingColumn("field_pos")])


def _lower(row) -> dict:
    return {k.lower(): v for k, v in row.asDict().items()}


class OffsetsOf:
    """``SELECT * FROM sap_idoc_dict_offsets(TABLE(fields))``: one segment after another, in any number of tasks."""

    def __init__(self):
        self.at = 0

    @staticmethod
    def analyze(rows: AnalyzeArgument) -> AnalyzeResult:
        return _ordered_by_segment("segnam string, field_pos long, field_name string, offset long, length long, datatype string")

    def eval(self, row):
        r = _lower(row)
        n = int(r["length"] or 0)
        yield r["segnam"] or "", int(r["field_pos"] or 0), r["field_name"] or "", self.at, n, r.get("datatype") or None
        self.at += n


class ProblemsOf:
    """``SELECT * FROM sap_idoc_dict_validate(TABLE(dictionary))``: a row for each problem."""

    def __init__(self):
        self.end, self.seen = None, set()

    @staticmethod
    def analyze(rows: AnalyzeArgument) -> AnalyzeResult:
        return _ordered_by_segment("segnam string, field_name string, offset long, length long, problem string")

    def eval(self, row):
        r = _lower(row)
        o, n, pos = int(r["offset"] or 0), int(r["length"] or 0), int(r["field_pos"] or 0)
        wrong = [
            (o < 0 or n <= 0, "offset<0 or length<=0"), (o + n > SDATA_LEN, f"field exceeds SDATA({SDATA_LEN})"),
            (self.end is not None and self.end >= 0 and o < self.end, "overlaps the previous field"), (pos in self.seen, "duplicate field_pos in segment"),
        ]
        for bad, problem in wrong:
            if bad:
                yield r["segnam"] or "", r["field_name"] or "", o, n, problem
        self.end = o + n
        self.seen.add(pos)


def register(spark: SparkSession, prefix: str = "sap_idoc_") -> None:
    """The dictionary functions for SQL: two table functions and one over a field list (eight strings in the order of the names)."""
    ship(spark)
    spark.udtf.register(f"{prefix}dict_offsets", udtf(OffsetsOf))
    spark.udtf.register(f"{prefix}dict_validate", udtf(ProblemsOf))
    names = ("SEGMENTTYP", "FIELDNAME", "FIELD_POS", "BYTE_FIRST", "EXTLEN", "DATATYPE", "ROLLNAME", "DESCRP")
    given = f"f ARRAY<STRUCT<{', '.join(f'{n}: STRING' for n in names)}>>"
    values = (
        "'idoctyp', idoctyp, 'cimtyp', cimtyp, 'release', release, 'segnam', x.SEGMENTTYP, 'segdef', cast(null as string), 'field_pos', try_cast(x.FIELD_POS as int), 'field_name', x.FIELDNAME, "
        "'offset', try_cast(x.BYTE_FIRST as int), 'length', try_cast(x.EXTLEN as int), 'datatype', x.DATATYPE, 'data_element', x.ROLLNAME, 'description', x.DESCRP, 'mandatory', false"
    )
    body = f"cast(coalesce(transform(f, x -> named_struct({values})), array()) as array<{DICT_TYPE}>)"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}dict_from_fields({given}, idoctyp STRING, cimtyp STRING, release STRING) RETURNS ARRAY<{DICT_TYPE}> RETURN {body}")


def export(types: list[tuple[str, str, DataFrame]], folder: str, form: str = "csv") -> None:
    """A dictionary for each (basic type, extension, result of its type read; see ``dictionary``) as csv or parquet under ``folder/<type>.dict``."""
    if form not in ("csv", "parquet"):
        raise ValueError("the form of an export is csv or parquet")
    for idoctyp, cimtyp, raw in types:
        out = dictionary(raw, {"PI_IDOCTYP": idoctyp, "PI_CIMTYP": cimtyp}).coalesce(1).write.mode("overwrite")
        (out.option("header", True) if form == "csv" else out).format(form).save(f"{folder}/{idoctyp}.dict")
