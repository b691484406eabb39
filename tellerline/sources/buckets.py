"""Key buckets that grow: a full one is split in two by the next bit of its keys' hash.

A table starts with ``key_buckets`` buckets. Bucket ``b`` splits into two whose numbers follow from ``b`` and the number of
buckets at the start, so the only thing to remember is which were split: a side table, added to in the same publish that moves
the rows. The numbers of buckets that were never split stay, and their files are not touched.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerline.functions.columns import NULL_KEY_BUCKET, has_null
from tellerline.params import JobConfig
from tellerline.schemas import BUCKET_COLUMN, TableSpec, splits_of
from tellerline.sources import files
from tellerline.sources.publish import publish, recover
from tellerline.sources.tables import ensure_buckets, read_physical, table_path

#: Bits of a 32-bit hash; bucket numbers are that wide, too.
BITS = 31


def _depth(bucket: int, start: int) -> int:
    """How many splits led to a bucket. Those of one start are numbered like the nodes of a binary tree, from 1."""
    return (bucket // start + 1).bit_length() - 1


def deepest(start: int) -> int:
    """Splits after which bucket numbers, or the hash's bits, are used up."""
    return BITS - start.bit_length() - 1


def ancestors(bucket: int, start: int) -> Iterator[int]:
    """The buckets whose splits led to a bucket, its parent first."""
    node, first = bucket // start + 1, bucket % start
    while bucket >= 0 and node > 1:
        node //= 2
        yield start * (node - 1) + first


def bucket_column(keys: Sequence[str], start: int, split: Iterable[int] = ()) -> Column:
    """A key's bucket: of those along its path the first that was not split. Equals ``key_bucket`` where none was."""
    split = list(split)
    hashed = F.hash(*keys).cast("long")
    first = F.pmod(hashed, F.lit(start))
    rest = F.floor((hashed - first) / F.lit(start)).cast("long")

    def numbered(node: Column) -> Column:
        return first + F.lit(start) * (node - F.lit(1))

    def further(node: Column, depth: Column) -> Column:
        """A child of a node that was split. One that was not stays, so those that were are as deep as there were steps."""
        bit = F.call_function("shiftright", rest, depth).bitwiseAND(F.lit(1).cast("long"))
        return F.when(numbered(node).isin(split), node * F.lit(2) + bit).otherwise(node)

    node = F.lit(1).cast("long")
    if split:
        steps = max(_depth(bucket, start) for bucket in split) + 1
        node = F.aggregate(F.array(*map(F.lit, range(steps))), node, further)
    return F.when(has_null(keys), F.lit(NULL_KEY_BUCKET)).otherwise(numbered(node)).cast("int")


def split_of(spark: SparkSession, config: JobConfig, spec: TableSpec) -> list[int]:
    """The buckets of a table that were split, fewer than it has buckets."""
    side = splits_of(spec)
    if not files.matches(spark, f"{table_path(config, side)}/part-*"):
        return []
    return [r[0] for r in read_physical(spark, config, side).distinct().collect()]


def bucket_of(spark: SparkSession, config: JobConfig, spec: TableSpec) -> Column:
    """The column of a stored table's buckets, as of now; for its writer, once it has recovered the table."""
    return bucket_column(spec.keys, config.key_buckets, split_of(spark, config, spec))


def _to_split(stored: DataFrame, spec: TableSpec, rows: int, start: int, split: Sequence[int]) -> list[int]:
    """The buckets to split until none has more than ``rows`` open rows, parents first: of each level those that are too full are counted."""
    opened = stored.where("current") if "current" in spec.partition_by else stored
    keyed = opened.where(F.col(BUCKET_COLUMN) != NULL_KEY_BUCKET).select(BUCKET_COLUMN, *spec.keys)
    found: list[int] = []
    bucket = F.col(BUCKET_COLUMN)
    while True:
        sizes = keyed.groupBy(bucket.alias("bucket")).count()
        full = [r[0] for r in sizes.where(F.col("count") > rows).collect() if _depth(r[0], start) < deepest(start)]
        if not full:
            return found
        if not found:
            keyed = keyed.where(bucket.isin(full))
        found += full
        bucket = bucket_column(spec.keys, start, [*split, *found])


def split_buckets(spark: SparkSession, config: JobConfig, spec: TableSpec, rows: int) -> list[int]:
    """Split buckets until none has more than ``rows`` open rows; returns those that were split.

    All splits are settled from counts first, by level, and published in one step: a row is moved once however often its bucket
    is split, and of buckets that stay only the counts are read. Rows of one key stay together, and rows without a key are
    never moved. For the table's writer: not beside its job.
    """
    recover(spark, config, spec)
    ensure_buckets(spark, config, spec)
    start, split = config.key_buckets, split_of(spark, config, spec)
    stored = read_physical(spark, config, spec)
    found = _to_split(stored, spec, rows, start, split)
    if not found:
        return []
    among = set(found)
    full = [b for b in found if not among.intersection(ancestors(b, start))]
    column = bucket_column(spec.keys, start, [*split, *found])
    moved = stored.where(F.col(BUCKET_COLUMN).isin(full)).withColumn(BUCKET_COLUMN, column)
    values = [full if c == BUCKET_COLUMN else [True, False] for c in spec.partition_by]
    noted = spark.createDataFrame([(b,) for b in found], splits_of(spec).schema)
    publish(spark, config, spec, product(*values), None, moved.select(*spec.physical_schema.names), [(splits_of(spec), noted)])
    return found
