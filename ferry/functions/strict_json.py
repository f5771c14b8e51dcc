"""Strict JSON -> typed record, with a reason for every reject.

Plain ``from_json`` accepts trailing text and several documents, turns a
nested object inside a string field into its JSON text, and returns a
struct of nulls (not null) for garbage. The classifier below closes those
gaps with built-ins only, so it stays a JVM-side projection with no shuffle
and no Python on the data path:

* the payload is wrapped as ``{"w":[[{"_n":K}],[<payload>\\n],[{"_n":K}]]}``,
  with K a hash of the payload itself, and parsed once. A payload that closes
  the wrapper and opens another would have to hold its own hash in front of
  it, so trailing text, a second document, a scalar or an array always shows;
* every record field is read as ``variant`` so its JSON type is known;
* typed fields are converted from the variant afterwards;
* a number in a string field is kept as it is written: the payload's numbers
  are put in quotes and read as strings, only where the variant may say it otherwise;
* a payload nested deeper than the reader goes is read again without the values
  of unknown keys, which are skipped at any depth;
* a corrupt-record column catches partial results: with
  ``spark.sql.json.enablePartialResults`` (on by default) a syntax error
  inside one field's value only nulls that field and parsing goes on, so
  without it ``{"id":[1,{"a":null ],"name":"x"}`` would look valid.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.functions.decode import payload_text
from ferry.schemas import as_struct

# Fixed values. Status names, in the order the first matching test wins.
STATUSES = (
    "bad_utf8",
    "null_payload",
    "too_deep",
    "too_large",
    "malformed",
    "empty",
    "json_null",
    "nested_field",
    "bad_field",
    "ok",
)

# Fixed value: the time format the reference configures for date fields.
DEFAULT_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ssZ"

_NONCE = "_n"
_CORRUPT = "_corrupt"
# Spark's variant holds at most this many bytes; a longer payload that does not
# parse is reported as too large, as it cannot be told from a malformed one.
VARIANT_BYTES = 128 << 20
# The JSON reader's limits on one string and one number are lifted: the payload
# bounds both. Its limit on nesting (1,000) stays where fields are read, as the
# reader recurses there and a deeper document can exhaust the stack of the
# executor's thread; where values are skipped or copied as text, it does not.
_LIMITS = {"maxStringLen": str(2**31 - 1), "maxNumLen": str(2**31 - 1)}
_ANY_DEPTH = {"maxNestingDepth": str(2**31 - 1)}

# JSON's tokens, for payloads that the reader accepts. Every repetition is
# possessive: one pass, no backtracking, no recursion.
_STRING = r"""(?:"(?:[^"\\]++|\\.)*+"|'(?:[^'\\]++|\\.)*+')"""
_COMMENT = r"(?:/\*(?:[^*]++|\*(?!/))*+\*/|//[^\n\r]*+)"
_NUMBER = r"""(?:-?[0-9][^\s,:\[\]{}"'/]*+)"""
_WORD = r"""(?:(?:-(?![0-9])|[^\s,:\[\]{}"'/0-9-])[^\s,:\[\]{}"'/]*+)"""
# what stands before a number that is a value, and the number
_TO_NUMBER = rf"(?s)\G((?:[\s,:\[\]{{}}]++|{_STRING}|{_COMMENT}|{_WORD}|{_NUMBER}(?=\s*+:))*+)({_NUMBER})"
# what stands before a string that is a value, its quote and the rest of it
_TO_STRING = (
    rf"""(?s)\G((?:[^"'/]++|{_COMMENT}|{_STRING}(?=\s*+:))*+)"""
    r"""(?:(")((?:[^"\\]++|\\.)*+")|(')((?:[^'\\]++|\\.)*+'))"""
)
# A payload with fewer brackets outside strings does not reach the limit on nesting.
_BRACKETS = 990
_MANY_BRACKETS = rf"""(?s)^(?:(?:[^"'/\[{{]++|{_STRING}|{_COMMENT})*+[\[{{]){{{_BRACKETS}}}+"""


def _wrapper_schema(record: T.StructType, key: str = "w") -> T.StructType:
    cell = T.StructType(
        [T.StructField(_NONCE, T.StringType(), True)]
        + [T.StructField(f.name, T.VariantType(), True) for f in record.fields]
    )
    return T.StructType(
        [
            T.StructField(key, T.ArrayType(T.ArrayType(cell, True), True), True),
            T.StructField(_CORRUPT, T.StringType(), True),
        ]
    )


def _texts(fields: list[T.StructField]) -> T.StructType:
    """The fields as strings, one level down, beside the corrupt-record column."""
    strings = T.StructType([T.StructField(f.name, T.StringType(), True) for f in fields])
    return T.StructType([T.StructField("t", strings, True), T.StructField(_CORRUPT, T.StringType(), True)])


def _flat(fields: list[T.StructField]) -> Column:
    """A payload of the record's fields alone, from ``_m``: their values as text,
    strings marked S and numbers N. What an object or array holds is left out;
    anything else but true and false is a literal that no field takes."""
    parts = []
    for f in fields:
        x = F.col("_m.t")[f.name]
        quoted = F.to_json(F.struct(F.substring(x, 2, 2**31 - 1).alias("v")))
        shown = (
            F.when(x.startswith("S"), F.substr(quoted, F.lit(6), F.length(quoted) - 6))
            .when(x.startswith("N"), F.substring(x, 2, 2**31 - 1))
            .when(x.startswith("{"), F.lit("{}"))
            .when(x.startswith("["), F.lit("[]"))
            .when(x.isin("true", "false"), x)
            .otherwise(F.lit("NaN"))
        )
        parts.append(F.when(x.isNotNull(), F.concat(F.lit(json.dumps(f.name) + ":"), shown)))
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


_NO_NUMBERS = "double('NaN'), double('Infinity'), double('-Infinity')"


def _q(name: str) -> str:
    """A name as a quoted SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def _plain(decimal: str) -> str:
    """Decimal text without trailing zeros, as the variant writes it."""
    return f"CASE WHEN instr({decimal}, '.') > 0 THEN rtrim('.', rtrim('0', {decimal})) ELSE {decimal} END"


def _rewritten(v: str, kind: str) -> str:
    """Whether a variant may say a number otherwise than the payload does."""
    return f"({kind} = 'DOUBLE' OR startswith({kind}, 'DECIMAL') OR {kind} = 'BIGINT' AND (_zeros OR CAST({v} AS BIGINT) = 0))"


def _typed_sql(v: str, kind: str, text: str, dtype: T.DataType) -> tuple[str, str]:
    """(value, lossless) SQL for one field read as variant ``v`` of JSON kind
    ``kind``. The value is null where it does not convert; ``lossless`` tells
    whether a value that converts still says the same. ``text`` is the field's
    number as the payload writes it.

    ``_fmt`` is a literal column holding the time format (no user text is
    spliced into SQL)."""
    if isinstance(dtype, T.StringType):
        # Numbers and booleans are accepted into string fields, as text: numbers as
        # they are written. The literals NaN, Infinity and -Infinity are no JSON
        # numbers: none is kept.
        number = f"get(regexp_extract_all({text}, '^-?[0-9].*$', 0), 0)"
        return f"CASE WHEN {_rewritten(v, kind)} THEN {number} ELSE CAST({v} AS STRING) END", "true"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        # only JSON strings can hold a time; skipping the others avoids a failed parse each
        parsed = f"CASE WHEN {kind} = 'STRING' THEN try_to_timestamp(CAST({v} AS STRING), _fmt) END"
        if isinstance(dtype, T.TimestampNTZType):
            parsed = f"CAST({parsed} AS TIMESTAMP_NTZ)"
        return parsed, "true"
    if not isinstance(dtype, T.AtomicType):
        raise TypeError(f"record fields must be atomic types, got {dtype.simpleString()}")
    got = f"try_variant_get({v}, '$', '{dtype.simpleString()}')"
    if isinstance(dtype, T.BooleanType):
        return f"CASE WHEN {kind} IN ('BOOLEAN', 'STRING') THEN {got} END", "true"
    numeric = f"({kind} IN ('BIGINT', 'DOUBLE') OR startswith({kind}, 'DECIMAL'))"
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        # an integer must come back; a fraction is the nearest double by nature
        same = f"""CASE WHEN {kind} <> 'STRING' AND CAST({{got}} AS DOUBLE) IN ({_NO_NUMBERS}) OR {{got}} IN ('Infinity', '-Infinity') THEN false
            WHEN {kind} = 'BIGINT' THEN coalesce({{got}} < double('9223372036854775807')
            AND TRY_CAST({{got}} AS BIGINT) = try_variant_get({v}, '$', 'bigint'), false)
            WHEN {kind} RLIKE '^DECIMAL[(][0-9]+,0[)]$'
            THEN coalesce(TRY_CAST({{got}} AS DECIMAL(38,0)) = try_variant_get({v}, '$', 'decimal(38,0)'), false) ELSE true END"""
        return f"CASE WHEN {numeric} OR {kind} = 'STRING' THEN {got} END", same
    if isinstance(dtype, T.NumericType):
        # text keeps its value: nothing but zeros may be beyond the decimal's digits
        said = "true"
        if isinstance(dtype, T.DecimalType):
            wide = f"DECIMAL(38,{38 - (dtype.precision - dtype.scale)})"
            said = f"""coalesce(TRY_CAST(CAST({v} AS STRING) AS {wide}) = {{got}}, false)
                AND NOT CAST({v} AS STRING) RLIKE '[.][0-9]{{{dtype.scale}}}[0-9]*[1-9][0-9]*[ ]*$'"""
        same = f"""CASE WHEN startswith({kind}, 'DECIMAL') THEN CAST({v} AS STRING) = {_plain('CAST({got} AS STRING)')}
            WHEN {kind} = 'DOUBLE' THEN try_variant_get({v}, '$', 'double') = CAST({{got}} AS DOUBLE)
            WHEN {kind} = 'STRING' THEN {said} ELSE true END"""
        return f"CASE WHEN {numeric} OR {kind} = 'STRING' THEN {got} END", same
    return f"CASE WHEN {kind} = 'STRING' THEN {got} END", "true"


def _guarded(w: str) -> str:
    """Whether a parsed wrapper holds both its guards and an array between them."""
    return f"""coalesce(size({w}) = 3 AND size({w}[0]) = 1 AND size({w}[2]) = 1
             AND {w}[0][0].{_NONCE} = _nonce AND {w}[2][0].{_NONCE} = _nonce
             AND {w}[1] IS NOT NULL, false)"""


def classify(
    df: DataFrame,
    schema: T.StructType | str,
    value: str = "value",
    *,
    json_options: Mapping[str, str] | None = None,
    timestamp_format: str = DEFAULT_TIMESTAMP_FORMAT,
    status: str = "status",
    record: str = "record",
) -> DataFrame:
    """Decode and strictly parse ``value`` against ``schema``.

    Returns ``df`` with ``value`` as text, plus ``status`` (one of
    ``STATUSES``) and ``record`` (a struct of the schema; null unless the
    status is ``ok``). Keys match case-sensitively, unknown keys are ignored,
    missing keys give null and the last duplicate key wins. Extra Jackson
    options (``allowUnquotedFieldNames``, ``allowComments``...) pass through
    ``json_options``; single quotes are accepted by default.

    The status and field expressions are written as Spark SQL expression
    text: the same Catalyst expressions, built by the JVM parser in a few
    calls instead of about a thousand Python-to-JVM round trips - which
    matters because a ``foreachBatch`` job builds this plan every batch.
    """
    schema = as_struct(schema)
    own = {status, record, "_p", "_p0", "_fmt", "_raw_null", "_nonce", "_g", "_m", "_flat", "_text"}
    own |= {f"_{x}{i}" for i in range(len(schema.fields)) for x in "ktv"}
    taken = own & set(df.columns)
    if taken:
        raise ValueError(f"classify adds columns {sorted(taken)} that the input already has; rename them first")
    if _NONCE in schema.fieldNames():
        raise ValueError(f"a record field cannot be named {_NONCE}: the parser's wrapper uses it")
    is_binary = isinstance(df.schema[value].dataType, T.BinaryType)
    others = [F.col(_q(c)) for c in df.columns if c != value]

    # Null-ness of the raw bytes must be read before ``value`` becomes text.
    staged = df.select(
        *others,
        payload_text(df, value).alias(value),
        F.col(_q(value)).isNull().alias("_raw_null") if is_binary else F.lit(None).cast("boolean").alias("_raw_null"),
    ).select("*", F.sha2(F.col(_q(value)), 256).alias("_nonce"))
    options = {**_LIMITS, **dict(json_options or {}), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    guard = [F.lit('[{"_n":"'), F.col("_nonce"), F.lit('"}]')]
    payload = F.col(_q(value))

    def wrapped(text: Column, key: str = "w") -> Column:
        # the line break ends a comment, where the options allow one
        return F.concat(F.lit(f'{{"{key}":['), *guard, F.lit(",["), text, F.lit("\n],"), *guard, F.lit("]}"))

    staged = staged.select("*", F.from_json(wrapped(payload), _wrapper_schema(schema), options).alias("_p0"))
    # Rows that may fail for their depth only: _g tells whether the payload is one
    # object, all its values skipped; _m has the fields' values as text.
    many = F.col("_p0")[_CORRUPT].isNotNull() & (F.octet_length(payload) >= 2 * _BRACKETS) & payload.rlike(_MANY_BRACKETS)
    any_depth = {**options, **_ANY_DEPTH}
    staged = staged.select(
        "*", F.when(many, F.from_json(wrapped(payload, "g"), _wrapper_schema(T.StructType(), "g"), any_depth)).alias("_g")
    )
    marked = F.regexp_replace(F.regexp_replace(payload, _TO_STRING, "$1$2$4S$3$5"), _TO_NUMBER, '$1"N$2"')
    one = f"_g.{_CORRUPT} IS NULL AND {_guarded('_g.g')} AND size(_g.g[1]) = 1 AND _g.g[1][0] IS NOT NULL"
    staged = staged.select(
        "*",
        F.when(
            F.expr(one), F.from_json(F.concat(F.lit('{"t":'), marked, F.lit("\n}")), _texts(schema.fields), any_depth)
        ).alias("_m"),
    ).select("*", F.when(F.col("_m").isNotNull() & F.col("_m")[_CORRUPT].isNull(), _flat(schema.fields)).alias("_flat"))
    again = F.from_json(wrapped(F.col("_flat"), "f"), _wrapper_schema(schema, "f"), options).cast(_wrapper_schema(schema))
    staged = staged.select(
        "*",
        F.when(F.col("_flat").isNotNull(), again).otherwise(F.col("_p0")).alias("_p"),
        F.lit(timestamp_format).alias("_fmt"),
    )

    val = _q(value)
    raw_null = "_raw_null" if is_binary else f"{val} IS NULL"
    doc = "get(get(_p.w, 1), 0)"
    # Kinds and converted values are columns of their own, each used more than
    # once after: Catalyst then computes them once.
    fields = list(enumerate(schema.fields))
    kinds = staged.select(
        "*",
        *[F.expr(f"{doc}.{_q(f.name)}").alias(f"_v{i}") for i, f in fields],
    ).select("*", *[F.expr(f"schema_of_variant(_v{i})").alias(f"_k{i}") for i, f in fields])
    # Read only where a string field holds a number that the variant may say otherwise.
    strings = [(i, f) for i, f in fields if isinstance(f.dataType, T.StringType)]
    leading = str(options.get("allowNumericLeadingZeros", "")).lower() == "true"
    zeros = "true" if leading else "false"
    if strings:
        need = F.expr(" OR ".join(f"coalesce({_rewritten(f'_v{i}', f'_k{i}')}, false)" for i, _ in strings).replace("_zeros", zeros))
        quoted = F.regexp_replace(F.coalesce("_flat", payload), _TO_NUMBER, '$1"$2"')
        lexemes = F.from_json(F.concat(F.lit('{"t":'), quoted, F.lit("\n}")), _texts([f for _, f in strings]), any_depth)
        kinds = kinds.select("*", F.when(need, lexemes).alias("_text"))
    typed = []
    for i, f in fields:
        got, lossless = _typed_sql(f"_v{i}", f"_k{i}", f"_text.t.{_q(f.name)}", f.dataType)
        typed.append((i, f, got.replace("_zeros", zeros), lossless.replace("{got}", f"_t{i}")))
    converted = kinds.select("*", *[F.expr(f"CAST({g} AS {f.dataType.simpleString()})").alias(f"_t{i}") for i, f, g, _ in typed])
    nested = " OR ".join(
        f"coalesce(startswith(_k{i}, 'OBJECT') OR startswith(_k{i}, 'ARRAY'), false)" for i, _ in fields
    ) or "false"
    bad = " OR ".join(
        f"coalesce(_k{i} <> 'VOID' AND (_t{i} IS NULL OR NOT ({lossless})), false)" for i, _, _, lossless in typed
    ) or "false"
    state = f"""CASE
        WHEN NOT {raw_null} AND {val} IS NULL THEN 'bad_utf8'
        WHEN {raw_null} THEN 'null_payload'
        WHEN _m.{_CORRUPT} IS NOT NULL THEN 'too_deep'
        WHEN _p.{_CORRUPT} IS NOT NULL AND octet_length({val}) > {VARIANT_BYTES} THEN 'too_large'
        WHEN _p.{_CORRUPT} IS NOT NULL OR NOT {_guarded('_p.w')} THEN 'malformed'
        WHEN size(_p.w[1]) = 0 THEN 'empty'
        WHEN size(_p.w[1]) > 1 THEN 'malformed'
        WHEN {doc} IS NULL THEN 'json_null'
        WHEN {nested} THEN 'nested_field'
        WHEN {bad} THEN 'bad_field'
        ELSE 'ok' END"""
    with_status = converted.select("*", F.expr(state).alias(status))
    rec = F.when(F.col(_q(status)) == "ok", F.struct(*[F.col(f"_t{i}").alias(f.name) for i, f in fields]))
    keep = [F.col(_q(c)) for c in df.columns] + [F.col(_q(status))]  # input order, value now text
    return with_status.select(*keep, rec.alias(record))
