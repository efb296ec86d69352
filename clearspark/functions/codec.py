"""Strict JSON decode and encode of the log records.

A record decodes to a struct whose absent or null fields hold the zero value of
their type ("" or 0), or to NULL when it is unparseable: not one JSON object, or
any known field of the wrong type. Unknown fields are ignored.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearspark import schemas

_ACCEPTED = {"string": ("STRING", "VOID"), "bigint": ("BIGINT", "VOID")}


def _kind(variant: Column) -> Column:
    """JSON type name of a variant; an absent value counts as null."""
    return F.coalesce(F.schema_of_variant(variant), F.lit("VOID"))


def _is_object(variant: Column) -> Column:
    kind = _kind(variant)
    return kind.startswith("OBJECT") | (kind == "VOID")


def _well_typed(variant: Column, schema: T.StructType) -> Column:
    """True when `variant` is an object (or null) whose known fields have their declared types."""
    checks = _is_object(variant)
    for field in schema.fields:
        inner = F.try_variant_get(variant, f"$.{field.name}", "variant")
        if isinstance(field.dataType, T.StructType):
            checks = checks & _well_typed(inner, field.dataType)
        elif isinstance(field.dataType, T.ArrayType):
            checks = checks & _well_typed_array(inner, field.dataType.elementType)
        else:
            checks = checks & _kind(inner).isin(*_ACCEPTED[field.dataType.simpleString()])
    return checks


def _well_typed_array(variant: Column, element: T.DataType) -> Column:
    items = F.try_variant_get(variant, "$", "array<variant>")
    if isinstance(element, T.StructType):
        valid = F.forall(items, lambda item: _well_typed(item, element))
    else:
        valid = F.forall(
            items, lambda item: _kind(item).isin(*_ACCEPTED[element.simpleString()])
        )
    return (_kind(variant) == "VOID") | F.coalesce(valid, F.lit(False))


def zero_filled(record: Column, schema: T.StructType) -> Column:
    """The record with zero values in place of absent fields, in declared order."""
    fields = []
    for field in schema.fields:
        inner = record.getField(field.name)
        if isinstance(field.dataType, T.StructType):
            value = zero_filled(inner, field.dataType)
        elif isinstance(field.dataType, T.ArrayType):
            element = field.dataType.elementType
            value = F.coalesce(inner, F.array().cast(field.dataType))
            if isinstance(element, T.StructType):
                value = F.transform(value, lambda item: zero_filled(item, element))
        elif isinstance(field.dataType, T.LongType):
            value = F.coalesce(inner, F.lit(0).cast("bigint"))
        else:
            value = F.coalesce(inner, F.lit(""))
        fields.append(value.alias(field.name))
    return F.struct(*fields)


# By kind of field, how its type may read in the type text of a record.
_ACCEPTED_TEXT = {
    "text": "STRING|VOID",
    "long": "BIGINT|VOID",
    "object": "OBJECT<|VOID",
    "objects": "ARRAY<OBJECT<|ARRAY<VOID|VOID",
    "texts": "ARRAY<STRING|ARRAY<VOID|VOID",
}


def _field_kind(kind: T.DataType) -> str:
    if isinstance(kind, T.ArrayType):
        return _field_kind(kind.elementType) + "s"
    if isinstance(kind, T.StructType):
        return "object"
    return "long" if isinstance(kind, T.LongType) else "text"


def _names(schema: T.StructType, wanted: str) -> set[str]:
    """Names of the fields of one kind, at any depth."""
    found = set()
    for field in schema.fields:
        if _field_kind(field.dataType) == wanted:
            found.add(field.name)
        inner = getattr(field.dataType, "elementType", field.dataType)
        if isinstance(inner, T.StructType):
            found |= _names(inner, wanted)
    return found


def _plainly_typed(kind: Column, schema: T.StructType) -> Column:
    """True when no known name occurs with a wrong type anywhere in a record's type text.

    One look at one text settles nearly every record. It may say no where an unknown
    nested object reuses a known name; `_well_typed` then decides.
    """
    plain = kind.startswith("ARRAY<OBJECT<")
    for text_type, accepted in _ACCEPTED_TEXT.items():
        names = _names(schema, text_type)
        if names:
            plain = plain & ~kind.rlike(
                rf"[< ]({'|'.join(sorted(names))}): (?!{accepted})"
            )
    return plain


def _rarely(value: Column, test: Callable[[Column], Column]) -> Column:
    """A test kept out of generated code: inlined, its bulk would leave the common path uncompiled."""
    return F.exists(F.array(value), test)


def bind(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is computed once per row.

    The optimizer copies a computed column into every later filter and projection that
    uses it, which would repeat an expensive parse many times. It leaves a column
    alone that it must take for non-deterministic; the condition here always holds.
    """
    return rows.withColumn(name, F.when(F.spark_partition_id() >= 0, value))


# Reading as strictly as the wire format asks; a malformed record is kept aside whole.
_STRICT = {
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
    "columnNameOfCorruptRecord": "_malformed",
}


def _simple_text(text: Column, schema: T.StructType) -> Column:
    """True for text that can only be one flat, well-typed object, if it is JSON at all.

    One pass from brace to brace: each key is followed by a string without escapes or by
    null, a known integer by digits or null. Saying no costs only time.
    """
    if any(not isinstance(f.dataType, (T.StringType, T.LongType)) for f in schema.fields):
        return F.lit(False)
    longs = "|".join(sorted(_names(schema, "long")))
    plain = r'[^"\\{}]*+"'
    # With no known integers the key of one is a pattern that nothing matches.
    long_key = rf'(?:{longs})"' if longs else "(?!)"
    of_long = rf"{long_key}\s*+:\s*+(?:-?[0-9]++|null)"
    of_text = rf'(?!{long_key}){plain}\s*+:\s*+(?:"{plain}|null)'
    # The loop is possessive, which Java runs without a stack frame for each field.
    fields = rf'(?:\s*+"(?:{of_long}|{of_text})\s*+(?:,|(?=}})))*+'
    return text.rlike(rf"\A[ \t\r\n]*+\{{{fields}\s*+}}[ \t\r\n]*+\z")


def with_decoded(
    rows: DataFrame, schema: T.StructType, name: str, value: str = "value"
) -> DataFrame:
    """Adds the record in `value` as a struct, NULL when it is unparseable."""
    text = F.col(value).cast("string")
    # Inside brackets the parser must reach the closing one, so text after the
    # record is an error; on its own the parser would stop at the first object.
    wrapped = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    bare = F.rtrim(text, F.lit(" \t\r\n"))
    closed = bare.endswith("}") | bare.endswith("null")
    element = F.try_variant_get("_json", "$[0]", "variant")
    single = element.isNotNull() & F.try_variant_get("_json", "$[1]", "variant").isNull()
    read_as = T.StructType([*schema.fields, T.StructField("_malformed", T.StringType())])
    staged = (
        rows.withColumn("_simple", F.coalesce(_simple_text(text, schema), F.lit(False)))
        .withColumn("_json", F.when(~F.col("_simple") & closed, wrapped))
        .select(
            *rows.columns,
            "_simple",
            F.schema_of_variant("_json").alias("_kind"),
            F.when(single, F.col("_json")).alias("_json"),
            F.from_json(text, read_as, _STRICT).alias("_typed"),
        )
    )
    checked = F.col("_json").isNotNull() & (
        _plainly_typed(F.col("_kind"), schema)
        | _rarely(
            F.col("_json"),
            lambda j: _well_typed(F.try_variant_get(j, "$[0]", "variant"), schema),
        )
    )
    valid = F.when(F.col("_simple"), F.col("_typed._malformed").isNull()).otherwise(checked)
    filled = F.when(valid, zero_filled(F.col("_typed"), schema))
    return bind(staged, name, filled).drop("_simple", "_json", "_kind", "_typed")


def with_trade(rows: DataFrame, value: str = "value") -> DataFrame:
    return with_decoded(rows, schemas.TRADE, "trade", value)


def with_batch(rows: DataFrame, value: str = "value") -> DataFrame:
    return with_decoded(rows, schemas.BATCH, "batch", value)


def with_dead_letter(rows: DataFrame, value: str = "value") -> DataFrame:
    return with_decoded(rows, schemas.DEAD_LETTER, "dead_letter", value)


def with_raw_trades(rows: DataFrame, data: str = "data") -> DataFrame:
    """Adds `raws`, the raw trades in a variant; NULL when it is no array of raw trades."""
    kind = T.ArrayType(schemas.RAW_TRADE)
    staged = rows.select(
        *rows.columns,
        F.schema_of_variant(data).alias("_kind"),
        F.try_variant_get(data, "$", kind.simpleString()).alias("_typed"),
    )
    valid = F.col(data).isNotNull() & (
        _plainly_typed(F.col("_kind"), schemas.RAW_TRADE)
        | _rarely(F.col(data), lambda j: _well_typed_array(j, schemas.RAW_TRADE))
    )
    filled = F.transform(
        F.coalesce("_typed", F.array().cast(kind)),
        lambda item: zero_filled(item, schemas.RAW_TRADE),
    )
    return bind(staged, "raws", F.when(valid, filled)).drop("_kind", "_typed")


def encode(record: Column, schema: T.StructType) -> Column:
    """JSON text with the declared field order; empty fields are written, not left out."""
    ordered = F.struct(*[record.getField(f.name).alias(f.name) for f in schema.fields])
    return F.to_json(ordered, {"ignoreNullFields": "false"})


def encode_trade(record: Column) -> Column:
    return encode(record, schemas.TRADE)


def encode_batch(record: Column) -> Column:
    return encode(record, schemas.BATCH)


def encode_dead_letter(record: Column) -> Column:
    return encode(record, schemas.DEAD_LETTER)
