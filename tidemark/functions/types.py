"""Declared column types of a source database and the Spark types that hold them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import types as T

# Source type name -> Spark type.
TYPES: dict[str, T.DataType] = {
    "int": T.IntegerType(),
    "integer": T.IntegerType(),
    "bigint": T.LongType(),
    "smallint": T.ShortType(),
    "tinyint": T.ShortType(),
    "bit": T.BooleanType(),
    "money": T.DecimalType(19, 4),
    "smallmoney": T.DecimalType(10, 4),
    "float": T.DoubleType(),
    "real": T.FloatType(),
    "varchar": T.StringType(),
    "char": T.StringType(),
    "nvarchar": T.StringType(),
    "nchar": T.StringType(),
    "text": T.StringType(),
    "ntext": T.StringType(),
    "date": T.DateType(),
    "datetime": T.TimestampNTZType(),
    "datetime2": T.TimestampNTZType(),
    "smalldatetime": T.TimestampNTZType(),
    "time": T.TimeType(6),
    "binary": T.BinaryType(),
    "varbinary": T.BinaryType(),
    "image": T.BinaryType(),
    "uniqueidentifier": T.StringType(),
}
DECIMAL_NAMES = ("decimal", "numeric")
MAX_PRECISION = 38


def spark_type(
    name: str, precision: int | None = None, scale: int | None = None, strict: bool = True
) -> T.DataType:
    """Spark type of a declared type.

    Not ``strict``, an unknown type is read as text and a decimal without size as (18, 0).
    """
    key = name.strip().lower()
    if key in DECIMAL_NAMES:
        if precision is None or scale is None:
            if strict:
                raise ValueError(f"{name} needs precision and scale")
            precision, scale = precision or 18, scale or 0
        if not 0 <= scale <= precision <= MAX_PRECISION or precision < 1:
            raise ValueError(f"{name}({precision},{scale}) is not a valid decimal size")
        return T.DecimalType(precision, scale)
    if key in TYPES:
        return TYPES[key]
    if strict:
        raise ValueError(f"unsupported type: {name}")
    return T.StringType()


def spark_schema(declared: Mapping[str, Mapping], strict: bool = True) -> T.StructType:
    """Schema from column -> {data_type, precision, scale, is_nullable}, in order."""
    return T.StructType(
        [
            T.StructField(
                column,
                spark_type(info["data_type"], info.get("precision"), info.get("scale"), strict),
                info.get("is_nullable", True),
            )
            for column, info in declared.items()
        ]
    )
