"""CSV through Spark's reader, strict unless told otherwise."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T


def read_csv(spark: SparkSession, path: str | list[str], types: dict[str, str] | T.StructType | None = None,
             strict: bool = True, delim: str = ",", missingstring: str = "", header: bool = True,
             dateformat: str | None = None, timestampformat: str | None = None, quote: str = '"',
             multiline: bool = False, encoding: str = "UTF-8") -> DataFrame:
    """Rows of CSV files.

    ``types`` is a full schema, or types for some columns; the others are
    inferred from the data (one extra pass: give a schema for large inputs).
    A value that does not fit its type raises when the rows are read, or
    becomes null with ``strict=False``.
    """
    reader = (spark.read.option("header", header).option("sep", delim).option("nullValue", missingstring)
              .option("quote", quote).option("escape", quote).option("multiLine", multiline)
              .option("encoding", encoding).option("mode", "FAILFAST" if strict else "PERMISSIVE")
              .option("enforceSchema", "false").option("preferDate", "true")
              .option("timestampNTZFormat", timestampformat or "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"))
    if dateformat:
        reader = reader.option("dateFormat", dateformat)
    if isinstance(types, T.StructType):
        return reader.schema(types).csv(path)
    inferred = reader.option("inferSchema", "true").option("prefersDecimal", "false").csv(path).schema
    hints = dict(types or {})
    unknown = [n for n in hints if n not in inferred.names]
    if unknown:
        raise ValueError(f"types names unknown columns: {', '.join(unknown)}")
    fields = []
    for field in inferred.fields:
        dtype = T.DataType.fromDDL(hints[field.name]) if field.name in hints else field.dataType
        if isinstance(dtype, T.TimestampType):
            dtype = T.TimestampNTZType()
        if isinstance(dtype, T.IntegerType) and field.name not in hints:
            dtype = T.LongType()
        fields.append(T.StructField(field.name, dtype))
    return reader.schema(T.StructType(fields)).csv(path)
