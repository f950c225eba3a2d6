"""Types of Arrow functions, built without a session so that modules can be imported anywhere."""

from __future__ import annotations

from pyspark.sql import types as T

SIMPLE = {"string": T.StringType(), "long": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "array<string>": T.ArrayType(T.StringType())}


def struct(columns: str) -> T.StructType:
    """A struct of "name kind, name kind, ..."."""
    pairs = (x.split(" ") for x in columns.split(", "))
    return T.StructType([T.StructField(name, SIMPLE[kind]) for name, kind in pairs])
