"""Strict JSON decode and encode as column expressions (no UDF).

Decoding follows a default object mapper bound to a fixed record type: a value is accepted only if
it is one JSON object whose keys all belong to the record (case-sensitive) and whose string fields
hold scalars. Scalars of other types (numbers, booleans) become their text, numbers as they were sent (``1.50``,
``1e3``). Everything else is set aside with a reason, and the job goes on.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt"

# Parser options matching a default object mapper: no single quotes, no NaN/Infinity, no comments,
# no unquoted names, no leading zeros.
STRICT_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
    "allowComments": "false",
    "allowUnquotedFieldNames": "false",
    "allowNumericLeadingZeros": "false",
}

# Reasons a record is set aside (fixed values of the reject report).
REASON_NULL = "null value"
REASON_BLANK = "empty text"
REASON_MALFORMED = "not a JSON object"
REASON_UNKNOWN_FIELD = "unknown field"
REASON_NESTED = "object or array in a text field"
REASON_REQUIRED = "required field missing"
REASONS = (REASON_NULL, REASON_BLANK, REASON_MALFORMED, REASON_UNKNOWN_FIELD, REASON_NESTED, REASON_REQUIRED)


def _text(col: Column) -> Column:
    return col.cast("string")


def _looks_nested(text: Column) -> Column:
    # from_json hands back nested values of a string field as their raw JSON text, which starts
    # with a bracket. Only such values pay for the second (variant) parse below.
    return text.startswith("{") | text.startswith("[")


def _variant_is_scalar(variant: Column) -> Column:
    return F.coalesce(~F.schema_of_variant(variant).rlike("^(OBJECT|ARRAY)"), F.lit(True))


def _field_ok(value: Column, name: str, dtype: T.DataType, parsed: Column) -> Column:
    field = parsed[name]
    doc = F.try_parse_json(value)
    if isinstance(dtype, T.StringType):
        sub = F.try_variant_get(doc, f"$.{name}", "variant")
        return F.when(field.isNull() | ~_looks_nested(field), F.lit(True)).otherwise(
            _variant_is_scalar(sub))
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StringType):
        elems = F.try_variant_get(doc, f"$.{name}", "array<variant>")
        # any element starting with a bracket (elements joined by a control character)
        suspicious = F.array_join(field, "\u0001").rlike("(^|\u0001)[\\[{]")
        return F.when(field.isNull() | ~suspicious, F.lit(True)).otherwise(
            F.coalesce(F.forall(elems, lambda e: e.isNull() | _variant_is_scalar(e)), F.lit(True)))
    return F.lit(True)


# A number or string token of a JSON array, and the inside of an array of scalars.
_TOKEN = r'"(?:[^"\\]|\\.)*"|[^,\s\[\]]+'
_INSIDE = r'((?:"(?:[^"\\]|\\.)*"|[^\]"])*)'


def _reformatted(text: Column) -> Column:
    """The parser may have written this number anew: fractions, exponents, and a zero that may have had a sign."""
    return text.rlike(r"^(-?[0-9]*\.[0-9]|-?[0-9]+(\.[0-9]+)?E|\"-?Infinity|0$)")


def _same_number(token: Column, text: Column) -> Column:
    return token.rlike(r"^-?[0-9]") & (token.cast("double") == F.translate(text, '"', "").cast("double"))


def _as_sent(value: Column, name: str, dtype: T.DataType, field: Column) -> Column:
    """The field with its numbers as they stand in the text; looked up there only where the parser changes them.

    The key's last place counts, as in the parse. Inside a string its quotes would be escaped, and an accepted
    record has no objects in it, so what matches is the key itself."""
    key = rf'(?s)^.*"{name}"\s*:\s*'
    if isinstance(dtype, T.StringType):
        token = F.regexp_extract(value, key + r"(-?[0-9][-+.0-9eE]*)", 1)
        return F.when(_reformatted(field) & _same_number(token, field), token).otherwise(field)
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StringType):
        tokens = F.regexp_extract_all(F.regexp_extract(value, key + r"\[" + _INSIDE + r"\]", 1), F.lit(_TOKEN), 0)
        sent = F.zip_with(field, tokens, lambda f, t: F.when(_reformatted(f) & _same_number(t, f), t).otherwise(f))
        # the check is one pattern over the joined elements; only then are the tokens looked up
        some = F.array_join(field, "\u0001").rlike(r"(^|\u0001)(-?[0-9]*\.[0-9]|-?[0-9]+(\.[0-9]+)?E|\"-?Infinity|0(\u0001|$))")
        return F.when(some & (F.size(field) == F.size(tokens)), sent).otherwise(field)
    return field


def _staged(df: DataFrame, schema: T.StructType, value_col: str, required: tuple[str, ...],
            keep: tuple[str, ...]) -> DataFrame:
    """``keep..., _raw, _rec, _reason``: the text, its parse and why it is rejected (or null)."""
    parse_schema = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    names = [f.name for f in schema.fields]
    # The parse gets its own projection and the checks refer to its result column: the optimizer
    # does not inline a costly expression that is referenced several times, so each row is
    # parsed once and the (codegen-friendly) checks run on the parsed struct.
    value, parsed = F.col("_raw"), F.col("_rec")
    raw = df.select(*[F.col(k) for k in keep], _text(F.col(value_col)).alias("_raw"))
    with_rec = raw.select("*", F.from_json(value, parse_schema, STRICT_OPTIONS).alias("_rec"))
    # lambda-free checks keep the projection in whole-stage codegen
    keys_ok = F.size(F.array_except(F.json_object_keys(value),
                                    F.array(*[F.lit(n) for n in names]))) == 0
    nested_ok = reduce(lambda a, b: a & b,
                       [_field_ok(value, f.name, f.dataType, parsed) for f in schema.fields],
                       F.lit(True))
    required_ok = reduce(lambda a, b: a & b, [parsed[r].isNotNull() for r in required], F.lit(True))
    reason = (F.when(value.isNull(), F.lit(REASON_NULL))
              .when(F.trim(value) == "", F.lit(REASON_BLANK))
              .when(parsed.isNull() | parsed[CORRUPT].isNotNull(), F.lit(REASON_MALFORMED))
              .when(~F.coalesce(keys_ok, F.lit(False)), F.lit(REASON_UNKNOWN_FIELD))
              .when(~nested_ok, F.lit(REASON_NESTED))
              .when(~required_ok, F.lit(REASON_REQUIRED)))
    return with_rec.select("*", reason.alias("_reason"))


def decode_json(df: DataFrame, schema: T.StructType, value_col: str = "value",
                required: tuple[str, ...] = (), keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Decode ``value_col`` (string or UTF-8 binary) into ``schema``.

    Returns ``(accepted, rejected)``. ``accepted`` has the schema's columns (plus ``keep``);
    ``rejected`` has ``keep``, the raw ``value`` text and a ``reason``. Each parses the text once
    per row (the variant parse only runs for values that look nested).
    ``required`` names fields that must be present and not null.
    """
    staged = _staged(df, schema, value_col, required, keep)
    # Split with a generator over a 0- or 1-element array rather than a filter: a filter on
    # ``_reason`` would be pushed below this projection with the parse inlined once per reference.
    # A generator is not pushed through, so the text is parsed once per row.
    accepted = staged.select(
        *[F.col(k) for k in keep],
        F.explode(F.when(F.col("_reason").isNull(), F.array(F.col("_rec"))))
        .alias("_ok"), "_raw").select(*[F.col(k) for k in keep], *[
            _as_sent(F.col("_raw"), f.name, f.dataType, F.col("_ok")[f.name]).alias(f.name) for f in schema.fields])
    rejected = staged.select(
        *[F.col(k) for k in keep],
        F.explode(F.when(F.col("_reason").isNotNull(),
                         F.array(F.struct(F.col("_raw").alias("value"),
                                          F.col("_reason").alias("reason")))))
        .alias("_bad")).select(*[F.col(k) for k in keep], "_bad.value", "_bad.reason")
    return accepted, rejected


def decode_json_report(df: DataFrame, schema: T.StructType, value_col: str = "value",
                       required: tuple[str, ...] = (), keep: tuple[str, ...] = (), reason: str = "reason",
                       raw: str | None = None) -> DataFrame:
    """One row per input: ``keep``, the schema's fields (null when rejected) and the ``reason``
    (null when accepted) -- both outcomes from a single parse. ``raw`` names a column for the text of a
    rejected record."""
    staged = _staged(df, schema, value_col, required, keep)
    ok = F.col("_reason").isNull()
    text = [F.when(~ok, F.col("_raw")).alias(raw)] if raw else []
    return staged.select(*[F.col(k) for k in keep],
                         *[F.when(ok, _as_sent(F.col("_raw"), f.name, f.dataType, F.col("_rec")[f.name])).alias(f.name)
                           for f in schema.fields],
                         F.col("_reason").alias(reason), *text)


def encode_json(*cols: str | Column) -> Column:
    """JSON text of the record made of ``cols``; null fields are written as ``null``."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def to_topic_rows(df: DataFrame, cols: list[str] | None = None, key: str | None = "record",
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """Topic layout ``(key, value)`` for a record DataFrame.

    ``key="record"`` writes the whole record's JSON as the key too (the source's sink serialises the
    key with the record serialiser); a column name keys by that column's text; ``None`` leaves
    the key empty. ``keep`` names columns carried along (the time and position of the trigger).
    """
    cols = cols or df.columns
    value = encode_json(*cols)
    if key == "record":
        key_col = value
    elif key is None:
        key_col = F.lit(None).cast("string")
    else:
        key_col = F.col(key).cast("string")
    return df.select(key_col.alias("key"), value.alias("value"), *keep)
