"""Schemas of the record at each stage. Column order matters: lines are read by position."""

from __future__ import annotations

from pyspark.sql import types as T

# Names, order and types of the employee record.
EMPLOYEE = T.StructType(
    [
        T.StructField("emp_id", T.IntegerType(), False),
        T.StructField("emp_name", T.StringType(), False),
        T.StructField("department", T.StringType()),
        T.StructField("salary", T.DecimalType(10, 2)),
        T.StructField("hire_date", T.DateType()),
    ]
)

# The same record as the catalog table declares it.
CATALOG_EMPLOYEE = T.StructType(
    [
        T.StructField("emp_id", T.IntegerType()),
        T.StructField("emp_name", T.StringType()),
        T.StructField("department", T.StringType()),
        T.StructField("salary", T.DoubleType()),
        T.StructField("hire_date", T.DateType()),
    ]
)

# What a lookup answers for one key.
LOOKUP_ANSWER = T.StructType(
    [
        T.StructField("exists", T.BooleanType()),
        T.StructField("emp_id", T.IntegerType()),
        T.StructField("emp_name", T.StringType()),
        T.StructField("department", T.StringType()),
    ]
)

# The five-field record seen through the ``orders`` table; keys need 64 bits there.
ORDER_RECORD = T.StructType(
    [
        T.StructField("rec_id", T.LongType()),
        T.StructField("rec_name", T.StringType()),
        T.StructField("rec_group", T.StringType()),
        T.StructField("amount", T.DecimalType(12, 2)),
        T.StructField("rec_date", T.DateType()),
    ]
)


def compat_schema(schema: T.StructType) -> T.StructType:
    """The types a record has after the line parser: 32-bit int, double, everything else text."""

    def narrowed(kind: T.DataType) -> T.DataType:
        if isinstance(kind, T.IntegralType):
            return T.IntegerType()
        if isinstance(kind, (T.DecimalType, T.FractionalType)):
            return T.DoubleType()
        return T.StringType()

    return T.StructType([T.StructField(f.name, narrowed(f.dataType)) for f in schema])
