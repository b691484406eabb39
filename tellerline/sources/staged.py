"""Staged JSON folders as streaming sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerline.operators.rescue import parse_lines
from tellerline.schemas import CORRUPT_COLUMN, RESCUE_COLUMN, staged_schema


def read_staged(
    spark: SparkSession, stage_root: str, folder: str, max_files: int = 20, corrupt_column: bool = False, rescue: bool = False
) -> DataFrame:
    """New files of a staged folder with its declared schema.

    A malformed line is a row of NULLs, a field of the wrong type is NULL and
    undeclared fields are dropped. ``corrupt_column=True`` keeps the text of
    such lines in ``_corrupt_record``. ``rescue=True`` keeps undeclared and wrongly typed fields in the VARIANT
    ``_rescued`` (see ``parse_lines``); only lines that are no object are malformed then. ``_ingest_ts`` and ``_ingest_file`` tell
    where a row came from, ``_size`` and ``_block`` how large that file is and where in it the row's split begins.
    """
    schema, path = staged_schema(folder), f"{stage_root}/{folder}"
    if rescue:
        lines = _located(spark.readStream.option("maxFilesPerTrigger", max_files).text(path))
        return parse_lines(lines, "value", schema, RESCUE_COLUMN, CORRUPT_COLUMN if corrupt_column else None)
    if corrupt_column:
        schema = type(schema)(list(schema.fields)).add(CORRUPT_COLUMN, "string")
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    return _located(reader.json(path))


def _located(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "_ingest_ts": F.col("_metadata.file_modification_time"),
            "_ingest_file": F.col("_metadata.file_path"),
            "_size": F.col("_metadata.file_size"),
            "_block": F.col("_metadata.file_block_start"),
        }
    )
