"""What types the columns of landed Parquet files have, told from their footers, and files read by them.

A writer that guesses types from values gives one column other types in other files: whole numbers where nothing was missing,
no type at all where everything was. Read with one schema, the first such file stops a load and every load after it.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Files as Spark's binaryFile source gives them.
FILES = "path string, modificationTime timestamp, length bigint, content binary"
#: Footers beyond this are taken for damage.
LARGEST_FOOTER = 64 << 20
NANOS = "nanoseconds"

_WHOLE = ("tinyint", "smallint", "int", "bigint")
_FRACTIONAL = ("float", "double")
#: By declared type, what a file may hold instead: what the declared type can say as well.
ACCEPTED = {
    "double": {*_WHOLE, *_FRACTIONAL},
    "bigint": {*_WHOLE, *_FRACTIONAL},
    "int": {*_WHOLE, *_FRACTIONAL},
    "string": {"string", *_WHOLE},
    "timestamp": {"timestamp", "timestamp_ntz", NANOS},
    "date": {"date", "timestamp", "timestamp_ntz"},
    "boolean": {"boolean"},
}


def footer(content: Column) -> Column:
    """The footer of a Parquet file with its length and magic, cut out before anything else sees the bytes."""
    size = F.hex(F.substring(content, -8, 4))  # the last byte counts most
    digits = F.concat(*[F.substring(size, at, 2) for at in (7, 5, 3, 1)])
    length = F.least(F.coalesce(F.conv(digits, 16, 10).cast("bigint"), F.lit(0)), F.lit(LARGEST_FOOTER)) + 8
    return F.substring(content, (-length).cast("int"), length.cast("int"))


def _kind(kind: pa.DataType) -> str | None:
    """The Spark type that a column is read as; "" for a column without values."""
    if pa.types.is_dictionary(kind):
        kind = kind.value_type
    if pa.types.is_null(kind):
        return ""
    if pa.types.is_timestamp(kind):
        return NANOS if kind.unit == "ns" else "timestamp" if kind.tz else "timestamp_ntz"
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        return "string"
    named = {"int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint", "bool": "boolean"}
    return named.get(str(kind), {"float": "float", "double": "double", "date32[day]": "date"}.get(str(kind)))


def _told(tail: bytes, declared: dict[str, str]) -> tuple[str | None, str | None]:
    """The types of the declared columns that a file has (as JSON), or what is wrong with it."""
    try:
        columns = pq.read_metadata(pa.BufferReader(b"PAR1" + tail)).schema
        fields = columns.to_arrow_schema()
    except (pa.ArrowException, OSError) as error:
        return None, f"no Parquet footer: {error}"
    old_times = {c.path for c in map(columns.column, range(len(columns))) if c.physical_type == "INT96"}
    kinds = {f.name: "timestamp" if f.name in old_times else _kind(f.type) for f in fields if f.name in declared}
    for name, kind in kinds.items():
        if kind is None or (kind and kind not in ACCEPTED.get(declared[name], {declared[name]})):
            return None, f"{name}: {fields.field(name).type} instead of {declared[name]}"
    return json.dumps({n: k for n, k in sorted(kinds.items()) if k}), None


def landed_types(files: DataFrame, schema: T.StructType) -> DataFrame:
    """Per file of (path, content): path, types (JSON) or problem. Only footers leave the scan."""
    declared = {f.name: f.dataType.simpleString() for f in schema}

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = [_told(tail.as_py() or b"", declared) for tail in batch.column("footer")]
            types, problems = zip(*told, strict=True) if told else ((), ())
            columns = [batch.column("path"), pa.array(types, pa.string()), pa.array(problems, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["path", "types", "problem"])

    return files.select("path", footer(F.col("content")).alias("footer")).mapInArrow(tell, "path string, types string, problem string")


def read_as(spark: SparkSession, root: str, paths: Iterable[str], types: str, schema: T.StructType) -> DataFrame:
    """Files with the same `types`, below `root`, in the declared columns. A column that the files lack is null unless it is
    named by their folders; a number that the declared type can't hold is null."""
    kinds: dict[str, str] = json.loads(types)
    read = T.StructType.fromDDL(", ".join(f"`{n}` {'bigint' if k == NANOS else k}" for n, k in kinds.items())) if kinds else T.StructType()
    folders = [f for f in schema if f.name not in kinds]
    rows = spark.read.schema(T.StructType([*read.fields, *folders])).option("basePath", root).parquet(*paths)

    def declared(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if kinds.get(field.name) == NANOS:
            column = F.timestamp_micros(F.floor(column / 1000))
        return column.try_cast(field.dataType).alias(field.name)

    return rows.select(*map(declared, schema.fields))
