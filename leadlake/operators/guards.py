"""Tolerate missing input columns; serialise complex columns.

Every guard is decided on the driver from ``df.columns`` / ``df.schema``
(metadata only), so the plan never branches per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    MapType,
    NullType,
    NumericType,
    StringType,
    StructType,
    VariantType,
)


def has_column(df: DataFrame, name: str) -> bool:
    return name in df.columns


def _is_complex(dtype: DataType) -> bool:
    return isinstance(dtype, (StructType, ArrayType, MapType))


def json_text(df: DataFrame, name: str) -> Column:
    """JSON text of column ``name``: text as it is, a struct, map, array or VARIANT serialised;
    a NULL string when the column is absent.  Other types are an error."""
    if not has_column(df, name):
        return F.lit(None).cast("string")
    dtype = df.schema[name].dataType
    if isinstance(dtype, (StringType, NullType)):
        return F.col(name).cast("string")
    if _is_complex(dtype) or isinstance(dtype, VariantType):
        return F.to_json(F.col(name))
    raise TypeError(f"column {name} is {dtype.simpleString()}; JSON text, a struct or a VARIANT is needed")


def _leaf_text(value: Column, dtype: DataType) -> Column:
    """A value as the text it has in JSON (dates and times in ISO form)."""
    if isinstance(dtype, (StringType, BooleanType, NumericType, NullType)):
        return value.cast("string")
    if _is_complex(dtype) or isinstance(dtype, VariantType):
        return F.to_json(value)
    return F.get_json_object(F.to_json(F.struct(value.alias("v"))), "$.v")


def conform(value: Column, dtype: DataType, wanted: DataType) -> Column:
    """``value`` of type ``dtype`` projected onto ``wanted``, field by field: structs by field
    name (NULL where a field is absent), arrays element by element, leaves cast.  What does
    not fit is NULL, as when JSON is parsed.  No detour through JSON text."""
    if isinstance(wanted, StructType):
        if not isinstance(dtype, StructType):
            return F.lit(None).cast(wanted)
        have = {f.name: f.dataType for f in dtype.fields}
        fields = [
            (conform(value.getField(f.name), have[f.name], f.dataType) if f.name in have
             else F.lit(None).cast(f.dataType)).alias(f.name) for f in wanted.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(wanted, ArrayType):
        if not isinstance(dtype, ArrayType):
            return F.lit(None).cast(wanted)
        return F.transform(value, lambda x: conform(x, dtype.elementType, wanted.elementType))
    if isinstance(wanted, StringType):
        return _leaf_text(value, dtype)
    if isinstance(wanted, MapType) or _is_complex(dtype):
        return F.from_json(F.to_json(value), wanted) if isinstance(dtype, (MapType, StructType)) and isinstance(
            wanted, MapType) else F.lit(None).cast(wanted)
    return value.try_cast(wanted)


def safe_struct(df: DataFrame, name: str, schema: StructType) -> Column:
    """Column ``name`` (JSON text, a native struct or a VARIANT) read with ``schema``; a
    NULL struct when it is absent."""
    dtype = df.schema[name].dataType if has_column(df, name) else None
    if isinstance(dtype, StructType):
        return conform(F.col(name), dtype, schema)
    if isinstance(dtype, VariantType):
        return F.try_variant_get(F.col(name), "$", schema.simpleString())
    return F.from_json(json_text(df, name), schema)


def safe_scalar(df: DataFrame, name: str, dtype: DataType | str = "string") -> Column:
    """Column cast to ``dtype`` (string by default), or a typed NULL when absent."""
    return F.col(name).cast(dtype) if has_column(df, name) else F.lit(None).cast(dtype)


def ensure_column(df: DataFrame, name: str, dtype: DataType | str = StringType()) -> DataFrame:
    """C4: add ``name`` as a typed NULL when absent; leave an existing column untouched."""
    if has_column(df, name):
        return df
    return df.withColumn(name, F.lit(None).cast(dtype))


def ensure_columns(df: DataFrame, names: dict[str, DataType | str]) -> DataFrame:
    missing = [F.lit(None).cast(t).alias(n) for n, t in names.items() if not has_column(df, n)]
    return df.select("*", *missing) if missing else df


def parse_or_null(df: DataFrame, name: str, schema: StructType) -> DataFrame:
    """Replace column ``name`` (JSON text, a native struct or a VARIANT) by its struct of
    ``schema`` in place; when the column is absent, add it as a NULL of that type."""
    if has_column(df, name):
        return df.withColumn(name, safe_struct(df, name, schema))
    return df.withColumn(name, F.lit(None).cast(schema))


def complex_to_json(df: DataFrame) -> DataFrame:
    """Struct, array and map columns -> JSON text; other columns untouched.
    One projection, column order kept."""
    cols = [
        F.to_json(F.col(f"`{f.name}`")).alias(f.name) if _is_complex(f.dataType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return df.select(*cols)
