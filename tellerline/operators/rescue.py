"""Fields of JSON lines that their declared columns do not hold."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FIELDS = "map<string,variant>"


def _left_out(fields: Column, read: Column, schema: StructType) -> Column:
    """The fields of an object that are undeclared, or whose value the declared column could not take."""

    def lost(value: Column, field) -> Column:
        missing = ~F.is_variant_null(value) & read.getField(field.name).isNull()
        if not isinstance(field.dataType, StructType):
            return missing
        inner = _left_out(F.try_variant_get(value, "$", FIELDS), read.getField(field.name), field.dataType)
        return missing | F.coalesce(F.size(inner) > 0, F.lit(False))

    def kept(name: Column, value: Column) -> Column:
        declared = [(name == field.name, lost(value, field)) for field in schema]
        return reduce(lambda chain, test: chain.when(*test), declared[1:], F.when(*declared[0])).otherwise(True)

    return F.map_filter(fields, kept)


def parse_lines(lines: DataFrame, text: str, schema: StructType, rescued: str, corrupt: str | None = None) -> DataFrame:
    """JSON lines as the columns of ``schema``, and as one VARIANT what those do not hold; the column ``text`` goes.

    ``rescued`` is an object of the undeclared fields, and of the declared ones whose value has another type; a struct with
    such a field is there as a whole. Without any it is NULL. A line that is no JSON object, or names a field
    twice, is there as its text; ``corrupt`` names a column for that text instead. Blank lines are no rows.
    """
    whole = lines.where(F.trim(text) != "")
    parsed = whole.withColumns({"_read": F.from_json(text, schema), "_fields": F.from_json(text, FIELDS)})
    twice = F.size(F.array_distinct(F.map_keys("_fields"))) < F.size(F.map_keys("_fields"))
    broken = F.col("_fields").isNull() | twice
    left = parsed.withColumns({"_broken": broken, "_left": _left_out(F.col("_fields"), F.col("_read"), schema)})
    found = F.when(~F.col("_broken") & (F.size("_left") > 0), F.to_variant_object("_left"))
    line = F.when(F.col("_broken"), F.col(text))
    columns = {rescued: found, corrupt: line} if corrupt else {rescued: F.coalesce(found, line.cast("variant"))}
    declared = [F.col("_read").getField(f.name).alias(f.name) for f in schema]
    along = [c for c in lines.columns if c != text]
    return left.select(*declared, *along, *[value.alias(name) for name, value in columns.items()])
