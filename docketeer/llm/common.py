"""What the training-data operators share: table reading, writes to the shared folder, Arrow mapping."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketeer.sources.shared import shared_path, written  # noqa: F401  operators take them from here

#: Rows of text handed on in one Arrow batch; bounds what a Python worker holds beside its input.
ROWS_OUT = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS_OUT) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_text(df: DataFrame, keep: list[str], text: str, fields: str, make: Callable[[list[str]], list]) -> DataFrame:
    """keep columns of df plus fields, which make() computes from the texts of a slice (null: empty), column by column.

    make is called once per slice of ROWS_OUT texts and returns one list (or Arrow array) per field.
    """
    source = df.select(*keep, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text"))
    schema = source.select(*keep).schema
    for field in _fields(fields):
        schema = schema.add(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow_schema = to_arrow_schema(schema)
        for part in slices(batches):
            texts = part.column(len(keep)).to_pylist()
            columns = [part.column(i) for i in range(len(keep))]
            made = make(texts)
            for value, field in zip(made, list(arrow_schema)[len(keep):], strict=True):
                columns.append(value if isinstance(value, pa.Array) else pa.array(value, field.type))
            yield pa.RecordBatch.from_arrays([c.cast(f.type) if c.type != f.type else c for c, f in zip(columns, arrow_schema, strict=True)], schema=arrow_schema)

    return source.mapInArrow(run, schema)


def _fields(ddl: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl).fields


def crc32_mod(column, divisor: int):
    """crc32 of the column as text (null: the empty text), modulo divisor."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(divisor))
