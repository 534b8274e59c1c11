"""Rescue-mode JSON parsing: never fail, never coerce silently.

Each line is parsed once into ``map<string, variant>``.  A field is taken only when
its JSON type fits the declared column type exactly (an integer fits a double
column; ``250.7`` or ``"3.5"`` does not fit a bigint/double column and is *not*
coerced, nor is a number beyond a double's range).  Rescued values are written anew as
JSON, so a number's text may change (``250.0`` becomes ``250``).  Unknown keys (including wrong-case ones), mistyped values, and whole
lines that are not a JSON object (broken JSON, arrays, scalars, duplicate keys)
go to ``_rescued_data`` as JSON text.  Blank lines are skipped.

Most lines need none of this.  A line is plain if ``from_json`` reads it without a bad
record, its keys are declared and differ, and no value can be of another type than it
seems; its fields are then those of ``from_json``.  Only the others are parsed as variant.

All of it is built-in expressions (parsing runs in the JVM), so it is a
narrow map-only step that works the same in batch and streaming.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketflow.schemas import RESCUE_COLUMN


def _fits(type_name: Column, dtype: T.DataType) -> Column:
    """Does a variant value whose ``schema_of_variant`` is ``type_name`` fit ``dtype``?  JSON null always fits."""
    if isinstance(dtype, T.StringType):
        ok = type_name == "STRING"
    elif isinstance(dtype, (T.LongType, T.IntegerType)):
        ok = type_name == "BIGINT"
    elif isinstance(dtype, T.DoubleType):
        ok = type_name.isin("BIGINT", "DOUBLE") | type_name.startswith("DECIMAL")
    elif isinstance(dtype, T.BooleanType):
        ok = type_name == "BOOLEAN"
    else:  # pragma: no cover - only the four raw types are declared
        raise TypeError(f"unsupported raw type {dtype}")
    return ok | (type_name == "VOID")


#: from_json takes single quotes and NaN by default, variant parsing does not.
_STRICT = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
#: Text that may stand for a number (an infinite one comes in quotes), boolean, object or array that ``from_json`` took as a string.
_MAYBE_NO_STRING = r"^(?:-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?$|true$|false$|[\[{\"])"
_FIRST = list('-0123456789tf[{"')  # looked at first: cheaper than the pattern
#: Longer lines go by way of variants, which have a limit of size.
_PLAIN_BYTES = 1 << 20


def _plain(line: Column, keys: Column, read: Column, schema: T.StructType) -> Column:
    """Is a line an object of declared keys, each at most once, with values of just the declared types?

    Doubtful lines count as not plain: strings that look like another type, a double that is
    zero (of either sign) or not finite, and lines too long for a variant.
    """
    declared = reduce(lambda a, b: a + b, [F.array_contains(keys, f.name).cast("int") for f in schema.fields])
    ok = [read["_bad"].isNull(), declared == F.size(keys), F.octet_length(line) <= _PLAIN_BYTES]
    for f in schema.fields:
        if isinstance(f.dataType, T.StringType):
            ok.append(~F.coalesce(F.substring(read[f.name], 1, 1).isin(*_FIRST) & read[f.name].rlike(_MAYBE_NO_STRING), F.lit(False)))
        elif isinstance(f.dataType, T.DoubleType):
            ok.append(F.coalesce((F.abs(read[f.name]) > 0) & (F.abs(read[f.name]) < float("inf")), F.lit(True)))
        elif not isinstance(f.dataType, (T.LongType, T.BooleanType)):
            ok.append(F.lit(False))
    return F.coalesce(reduce(lambda a, b: a & b, ok), F.lit(False))


def rescue_json(lines: DataFrame, schema: T.StructType, value_col: str = "value",
                keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON-lines text -> typed columns of ``schema`` + ``_rescued_data`` (+ ``keep`` columns).

    CASE branches are lazy: of plain lines only the keys and the typed fields are read.
    Of the others each declared field's JSON type is inspected once, and the rescue JSON
    is only built for lines that have an unknown or mistyped key.
    """
    text = F.col(value_col)
    m, read, plain = F.col("_m"), F.col("_read"), F.col("_plain")
    names = [f.name for f in schema.fields]
    with_bad = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    parsed = (
        lines.filter(text.rlike(r"\S"))
        .select(text.alias("_line"), *keep, F.from_json(text, with_bad, _STRICT).alias("_read"))
        .select("*", _plain(F.col("_line"), F.json_object_keys("_line"), read, schema).alias("_plain"))
        .select("*", F.when(~plain, F.try_variant_get(F.try_parse_json("_line"), "$", "map<string,variant>")).alias("_m"))
    )
    probed = parsed.select("*", *[F.schema_of_variant(m[n]).alias(f"_t{i}") for i, n in enumerate(names)])

    fits = [_fits(F.col(f"_t{i}"), f.dataType) for i, f in enumerate(schema.fields)]
    fits = [ok & ~F.coalesce(F.abs(F.try_variant_get(m[f.name], "$", "double")) == float("inf"), F.lit(False)) if isinstance(f.dataType, T.DoubleType) else ok
            for ok, f in zip(fits, schema.fields)]
    values = [
        F.when(plain, read[f.name]).when(ok, F.try_variant_get(m[f.name], "$", f.dataType.simpleString())).cast(f.dataType).alias(f.name)
        for ok, f in zip(fits, schema.fields)
    ]
    # a missing key probes as NULL: neither a value nor a mismatch
    mistyped = F.array_compact(F.array(*[F.when(~ok, F.lit(f.name)) for ok, f in zip(fits, schema.fields)]))
    unknown = F.array_except(F.map_keys(m), F.array(*[F.lit(n) for n in names]))
    rescue_keys = F.concat(mistyped, unknown)
    rescued = (
        F.when(plain, F.lit(None).cast("string"))
        .when(m.isNull(), F.col("_line"))
        .when(F.size(rescue_keys) > 0, F.to_json(F.map_filter(m, lambda k, v: F.array_contains(rescue_keys, k))))
        .otherwise(F.lit(None).cast("string"))
    )
    return probed.select(*values, rescued.alias(RESCUE_COLUMN), *keep)
