import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang); with columns that clash with the operators' own."""

    def make(rows, partitions=3, extra=True):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, SCHEMA).repartition(partitions)
        if not extra:
            return df
        clashing = ("score", "predicted", "fp", "root", "key", "shard", "slot", "size", "label", "quality", "_cell", "y")
        return df.selectExpr("*", *[f"'x' AS {c}" for c in clashing])

    return make


@pytest.fixture
def labels(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")

    return make
