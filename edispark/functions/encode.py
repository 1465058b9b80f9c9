"""Fixed-width encoders as Column expressions; all padding and cutting counts bytes."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from edispark.functions.layout import CONTROL_FIELDS, SDATA_LEN

_BLANK = "X'20'"


def _col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def padded(text: Column, length: int) -> Column:
    """The text's bytes, cut or filled with blanks on the right; null is empty."""
    return F.rpad(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), length, F.unhex(F.lit("20")))


def zero_pad(number, width: int) -> Column:
    """Digits with leading zeros; negative and null are 0, and too wide keeps the low digits."""
    s = F.greatest(F.coalesce(_col(number).cast("long"), F.lit(0)), F.lit(0)).cast("string")
    return F.right(F.lpad(s, F.greatest(F.lit(width), F.length(s)), F.lit("0")), F.lit(width))


def _sdata_sql(offsets: str, lengths: str, values: str) -> str:
    o, n, v = f"coalesce({offsets}, array())", f"coalesce({lengths}, array())", f"coalesce({values}, array())"
    # pieces beyond the record are an error before any of them is placed
    bad = f"exists(arrays_zip(transform({o}, x -> coalesce(x, 0L)), transform({n}, x -> coalesce(x, 0L))), p -> p['0'] < 0 or p['1'] < 0 or p['0'] > {SDATA_LEN} or p['1'] > {SDATA_LEN} - p['0'])"
    body = (
        f"aggregate(arrays_zip(transform({o}, x -> cast(coalesce(x, 0L) as int)), transform({n}, x -> cast(coalesce(x, 0L) as int)), transform({v}, x -> coalesce(x, ''))), "
        f"rpad(X'', {SDATA_LEN}, {_BLANK}), (a, p) -> if(p['1'] = 0, a, overlay(a placing rpad(cast(p['2'] as binary), p['1'], {_BLANK}) from p['0'] + 1 for p['1'])))"
    )
    return (
        f"case when size({o}) <> size({n}) or size({o}) <> size({v}) then raise_error('encode_sdata: offsets, lengths and values differ in number') "
        f"when {bad} then raise_error('encode_sdata: offset/length out of SDATA bounds') else {body} end"
    )


def encode_sdata_bytes(offsets: Column, lengths: Column, values: Column) -> Column:
    """1000 bytes with each value at its offset; later ones overwrite earlier ones."""
    one = F.array(F.struct(offsets.cast("array<bigint>").alias("o"), lengths.cast("array<bigint>").alias("n"), values.cast("array<string>").alias("v")))
    return F.element_at(F.transform(one, lambda s: _placed(s["o"], s["n"], s["v"])), 1)


def _placed(o: Column, n: Column, v: Column) -> Column:
    o = F.transform(F.coalesce(o, F.array().cast("array<bigint>")), lambda x: F.coalesce(x, F.lit(0).cast("long")))
    n = F.transform(F.coalesce(n, F.array().cast("array<bigint>")), lambda x: F.coalesce(x, F.lit(0).cast("long")))
    v = F.transform(F.coalesce(v, F.array().cast("array<string>")), lambda x: F.coalesce(x, F.lit("")))
    pieces = F.zip_with(F.zip_with(o, n, lambda a, b: F.struct(a.alias("o"), b.alias("n"))), v, lambda p, x: F.struct(p["o"].alias("o"), p["n"].alias("n"), x.alias("v")))
    bad = F.exists(pieces, lambda p: (p["o"] < 0) | (p["n"] < 0) | (p["o"] > SDATA_LEN) | (p["n"] > F.lit(SDATA_LEN) - p["o"]))
    blank = F.unhex(F.lit("20"))

    def put(a: Column, p: Column) -> Column:
        own = F.rpad(p["v"].cast("binary"), p["n"].cast("int"), blank)
        return F.when(p["n"] == 0, a).otherwise(F.overlay(a, own, (p["o"] + 1).cast("int"), p["n"].cast("int")))

    whole = F.aggregate(pieces, F.rpad(F.lit("").cast("binary"), SDATA_LEN, blank), put)
    uneven = (F.size(o) != F.size(n)) | (F.size(o) != F.size(v))
    return (
        F.when(uneven, F.raise_error(F.lit("encode_sdata: offsets, lengths and values differ in number")).cast("binary"))
        .when(bad, F.raise_error(F.lit("encode_sdata: offset/length out of SDATA bounds")).cast("binary"))
        .otherwise(whole)
    )


def encode_sdata(offsets: Column, lengths: Column, values: Column) -> Column:
    return encode_sdata_bytes(offsets, lengths, values).cast("string")


def encode_data_record(segnam, mandt, docnum, segnum, psgnum, hlevel, sdata) -> Column:
    """A data record of 1063 bytes; ``sdata`` is text or bytes."""
    body = _col(sdata)
    raw = F.coalesce(body.cast("binary"), F.lit("").cast("binary"))
    numbers = [zero_pad(x, w).cast("binary") for x, w in ((docnum, 16), (segnum, 6), (psgnum, 6), (hlevel, 2))]
    return F.concat(padded(_col(segnam), 30), padded(_col(mandt), 3), *numbers, F.rpad(raw, SDATA_LEN, F.unhex(F.lit("20"))))


def encode_control(values: Column) -> Column:
    """A control record of 524 bytes from up to 36 values in layout order."""
    return F.concat(*[padded(F.get(values, F.lit(k)), n) for k, (_, n) in enumerate(CONTROL_FIELDS)])


def params(idoctyp, cimtyp="", version="4") -> Column:
    return F.struct(_col(idoctyp).alias("PI_IDOCTYP"), _col(cimtyp).alias("PI_CIMTYP"), _col(version).alias("PI_VERSION"))


def version(tag: str = "") -> str:
    return f"edispark {tag}"


def register(spark: SparkSession, prefix: str = "sap_idoc_") -> None:
    """The scalar functions for SQL, as temporary SQL functions that Catalyst inlines."""
    control = ", ".join(f"rpad(cast(coalesce(get(v, {k}), '') as binary), {n}, {_BLANK})" for k, (_, n) in enumerate(CONTROL_FIELDS))

    def digits(name: str, width: int) -> str:
        s = f"cast(greatest(coalesce({name}, 0L), 0L) as string)"
        return f"cast(right(lpad({s}, greatest({width}, length({s})), '0'), {width}) as binary)"

    def text(name: str, width: int) -> str:
        return f"rpad(cast(coalesce({name}, '') as binary), {width}, {_BLANK})"

    record = ", ".join([text("segnam", 30), text("mandt", 3), digits("docnum", 16), digits("segnum", 6), digits("psgnum", 6), digits("hlevel", 2), text("sdata", SDATA_LEN)])
    made = {
        f"{prefix}encode_sdata(o ARRAY<BIGINT>, n ARRAY<BIGINT>, v ARRAY<STRING>) RETURNS STRING": f"cast({_sdata_sql('o', 'n', 'v')} as string)",
        f"{prefix}encode_data_record(segnam STRING, mandt STRING, docnum BIGINT, segnum BIGINT, psgnum BIGINT, hlevel BIGINT, sdata STRING) RETURNS BINARY": f"concat({record})",
        f"{prefix}encode_control(v ARRAY<STRING>) RETURNS BINARY": f"concat({control})",
        f"{prefix}params(idoctyp STRING, cimtyp STRING DEFAULT '', version STRING DEFAULT '4') RETURNS STRUCT<PI_IDOCTYP: STRING, PI_CIMTYP: STRING, PI_VERSION: STRING>": "named_struct('PI_IDOCTYP', idoctyp, 'PI_CIMTYP', cimtyp, 'PI_VERSION', version)",
        f"{prefix}version(tag STRING) RETURNS STRING": "concat('edispark ', tag)",
    }
    for head, body in made.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
