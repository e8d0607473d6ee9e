"""Rows as JSON messages and back."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from cabstand.functions.clock import stamp_text

_WHOLE = {"byte", "tinyint", "short", "smallint", "int", "integer", "long", "bigint"}
_REAL = {"float", "double"}


def to_message(df: DataFrame, name: str = "value") -> DataFrame:
    """One JSON object per row, time columns as text, NULLs kept."""
    columns = [
        (stamp_text(F.col(f.name)) if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) else F.col(f.name))
        .alias(f.name)
        for f in df.schema.fields
    ]
    return df.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias(name))


def typed(text: Column, type_name: str) -> Column:
    """Text to a declared type, NULL when it does not fit.

    Whole numbers may arrive as ``1.0`` and missing numbers as ``NaN``; ``1.5`` is no whole number.
    """
    kind = type_name.lower()
    if kind in _WHOLE:
        exact = text.try_cast("decimal(38,9)")
        return F.coalesce(text.try_cast(kind), F.when(exact == F.floor(exact), exact.try_cast(kind)))
    if kind in _REAL:
        return F.nullif(text.try_cast(kind), F.lit(float("nan")).cast(kind))
    return text.try_cast(kind)


def _fields(raw: Column, names: list[str]) -> Column:
    """The named fields of a JSON object as texts, read in one parse."""
    return F.from_json(raw, ", ".join(f"`{name}` string" for name in names))


def _fields_any_case(raw: Column, names: list[str]) -> Column:
    """The same struct when a name is spelled in another case.

    The object is parsed once, into a one-element array; the lambda binds it for all look-ups.
    """
    parsed = F.from_json(raw, "map<string,string>")
    opened = F.array(
        F.struct(F.transform(F.map_keys(parsed), lambda k: F.lower(k)).alias("k"), F.map_values(parsed).alias("v"))
    )

    def found(entry: Column, name: str) -> Column:
        place = F.array_position(entry["k"], name.lower()).cast("int")
        return F.when(place > 0, F.try_element_at(entry["v"], place)).alias(name)

    return F.transform(opened, lambda entry: F.struct(*[found(entry, name) for name in names]))[0]


def decode_messages(
    df: DataFrame, columns: Mapping[str, str], value: str = "value", unknown_fields: str = "reject"
) -> DataFrame:
    """Typed columns of a JSON object, plus ``raw`` and ``error`` (NULL for a good message).

    Field names match without regard to letter case. A message is bad when it is no JSON object, a
    field does not fit its type, or (``unknown_fields="reject"``) it has an undeclared field. A
    missing field is NULL. Nothing raises: one bad message must not stop a stream.
    """
    if unknown_fields not in ("reject", "ignore"):
        raise ValueError("unknown_fields is 'reject' or 'ignore'")
    names = list(columns)
    raw = F.col(value).cast("string")
    # The key listing does not know the token NaN, the full parser does.
    keys = F.coalesce(F.json_object_keys(raw), F.map_keys(F.from_json(raw, "map<string,string>")))
    listed = df.select(raw.alias("raw"), F.array_except(keys, F.array(*[F.lit(n) for n in names])).alias("_odd"))
    # Spelled as declared is the common case and is read straight into a struct.
    plain = F.array_size("_odd") == 0
    opened = listed.select(
        "raw",
        "_odd",
        F.when(plain, _fields(F.col("raw"), names))
        .when(~plain, _fields_any_case(F.col("raw"), names))
        .alias("_f"),
    )
    texts = {name: F.col("_f").getField(name) for name in names}
    # Values and texts side by side: each cast is done once and serves the value and its check.
    cast = opened.select("raw", "_odd", "_f", *[typed(texts[n], k).alias(n) for n, k in columns.items()])

    def misfit(name: str, kind: str) -> Column:
        bad = F.col(name).isNull() & texts[name].isNotNull()
        if kind.lower() in _WHOLE | _REAL:
            bad = bad & (F.lower(F.btrim(texts[name], F.lit('"'))) != "nan")
        return F.when(bad, F.lit(f"type:{name}"))

    problems = [misfit(n, k) for n, k in columns.items()]
    if unknown_fields == "reject":
        known = F.array(*[F.lit(n.lower()) for n in names])
        extra = F.array_except(F.transform("_odd", lambda k: F.lower(k)), known)
        listing = F.concat(F.lit("unknown:"), F.array_join(extra, ","))
        problems.append(F.when((F.size("_odd") > 0) & (F.size(extra) > 0), listing))
    error = F.when(F.col("_odd").isNull(), F.lit("not a JSON object")).otherwise(
        F.nullif(F.concat_ws("; ", *problems), F.lit(""))
    )
    return cast.select(*names, "raw", error.alias("error"))
