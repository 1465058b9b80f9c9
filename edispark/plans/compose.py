"""Compose records from relational data: numbering, slicing by a dictionary, encoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edispark.functions.encode import encode_control, encode_data_record, encode_sdata_bytes
from edispark.functions.layout import CONTROL_FIELDS, CONTROL_LEN
from edispark.operators import dictionary
from edispark.operators.hierarchy import renumber


def control_records(controls: DataFrame, document: list[str]) -> DataFrame:
    """``document..., ord = 0, raw_record`` from rows whose columns are named like control fields, in any case."""
    have = {c.lower(): c for c in controls.columns}
    values = [F.col(have[n.lower()]).cast("string") if n.lower() in have else F.lit("") for n, _ in CONTROL_FIELDS]
    return controls.select(*document, F.lit(0).cast("long").alias("ord"), encode_control(F.array(*values)).alias("raw_record"))


def data_records(spark: SparkSession, segments: DataFrame, values: DataFrame, dict_source, document: list[str], mandt: str = "", docnum: str | None = None) -> DataFrame:
    """``document..., ord, raw_record`` from segments and their field values.

    ``segments`` has the document columns, ``ord``, ``segnam`` and ``hlevel`` (and the number in ``docnum``);
    ``values`` has the document columns, ``ord``, ``field_name`` and ``value``. Numbers and parents are derived.
    """
    given = values.groupBy(*document, "ord").agg(F.collect_list(F.struct(F.col("field_name").alias("n"), F.col("value").alias("v"))).alias("fields"))
    df = _sliced(spark, renumber(segments, document).join(given, [*document, "ord"], "left"), dict_source)
    number = F.col(docnum) if docnum else F.lit(0)
    return df.select(*document, F.col("ord").cast("long").alias("ord"), encode_data_record(F.col("segnam"), F.lit(mandt), number, F.col("segnum"), F.col("psgnum"), F.col("hlevel"), F.col("sdata")).alias("raw_record"))


def _sliced(spark: SparkSession, segments: DataFrame, dict_source) -> DataFrame:
    """Segments with ``sdata``, the bytes of their ``fields`` (an array of names ``n`` and values ``v``) where the dictionary puts them."""
    rules = dictionary.rules(spark, dict_source).groupBy("segnam").agg(F.array_sort(F.collect_list(F.struct("field_pos", "_ord", "field_name", "offset", "length"))).alias("rules"))
    df = segments.join(dictionary.beside(rules), "segnam", "left")
    own = F.coalesce("rules", F.array().cast("array<struct<field_pos:bigint,_ord:bigint,field_name:string,offset:bigint,length:bigint>>"))
    fields = F.coalesce("fields", F.array().cast("array<struct<n:string,v:string>>"))

    def value(r):
        return F.coalesce(F.get(F.filter(fields, lambda f: f["n"] == r["field_name"]), F.lit(0))["v"].cast("string"), F.lit(""))

    sdata = encode_sdata_bytes(F.transform(own, lambda r: r["offset"]), F.transform(own, lambda r: r["length"]), F.transform(own, value))
    return df.withColumn("sdata", sdata).drop("rules")


def whole_documents(spark: SparkSession, controls: DataFrame, segments: DataFrame, dict_source, document: list[str], mandt: str = "", docnum: str | None = None, ordered: bool = False) -> DataFrame:
    """``raw_record`` of whole documents, each in one partition and in its order; ``ordered`` gives the order of all documents too.

    ``controls`` is as for ``control_records``; ``segments`` is as for ``data_records`` with any type of ``ord`` and the
    values as ``fields``, an array of structs ``n`` and ``v``. What is shuffled and sorted is a record without the blanks at its
    end, once by document (and once more by range where ``ordered``); records get their width last.
    """
    # a number that is the document's own key is not shuffled twice
    number = F.col(docnum).cast("long") if docnum and docnum not in document else F.lit(None).cast("long")
    ord_type = segments.schema["ord"].dataType
    body = _sliced(spark, segments, dict_source)
    body = body.select(*document, F.lit(True).alias("_data"), "ord", "segnam", F.col("hlevel").cast("long").alias("hlevel"), number.alias("_number"), _short(F.col("sdata")).alias("_bytes"))
    head = control_records(controls, document)
    head = head.select(*document, F.lit(False).alias("_data"), F.lit(None).cast(ord_type).alias("ord"), F.lit("").alias("segnam"), F.lit(0).cast("long").alias("hlevel"), F.lit(None).cast("long").alias("_number"), _short(F.col("raw_record")).alias("_bytes"))
    # the control record is number 0 at level 0, and so the parent of the segments at level 1
    rows = renumber(head.unionByName(body), document, ["_data", "ord"], counted=F.col("_data"))
    keys = [*document, "_data", "segnum"]
    rows = rows.orderBy(*keys) if ordered else rows.sortWithinPartitions(*keys)
    own = F.col(docnum).cast("long") if docnum in document else F.col("_number") if docnum else F.lit(0).cast("long")
    data = encode_data_record(F.col("segnam"), F.lit(mandt), own, F.col("segnum"), F.col("psgnum"), F.col("hlevel"), F.col("_bytes"))
    return rows.select(F.when(F.col("_data"), data).otherwise(F.rpad(F.col("_bytes"), CONTROL_LEN, F.unhex(F.lit("20")))).alias("raw_record"))


def _short(raw: Column) -> Column:
    """Bytes without the blanks at their end."""
    return F.rtrim(raw.cast("string")).cast("binary")


def file_order(controls: DataFrame, data: DataFrame, document: list[str]) -> DataFrame:
    """Control and data records in the order of a file, as the one column that the sink takes."""
    return controls.unionByName(data).orderBy(*document, "ord").select("raw_record")
