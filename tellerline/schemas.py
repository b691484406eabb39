"""Declared schemas of the staged files and of every layer table.

Nothing is inferred: staged files are read with these schemas and each write is
conformed to the declared columns first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType


def _struct(*fields: tuple[str, object]) -> StructType:
    schema = StructType()
    for name, data_type in fields:
        schema = schema.add(name, data_type)
    return schema


# Field names and types are the data contract, including the
# spelling "withdrawl".
CITY_STATE_ZIP = _struct(("city", "string"), ("state", "string"), ("zip", "string"))

STAGED = {
    "atm_customers": _struct(
        ("customer_id", "long"),
        ("card_number", "long"),
        ("checking_savings", "string"),
        ("first_name", "string"),
        ("last_name", "string"),
        ("customer_since_date", "date"),
        ("preferred", "integer"),
    ),
    "atm_locations": _struct(
        ("atm_id", "long"),
        ("city_state_zip", CITY_STATE_ZIP),
        ("pos_capability", "string"),
        ("offsite_or_onsite", "string"),
        ("bank", "string"),
    ),
    "atm_visits": _struct(
        ("visit_id", "long"),
        ("customer_id", "long"),
        ("atm_id", "long"),
        ("withdrawl_or_deposit", "string"),
        ("amount", "long"),
        ("fraud_report", "string"),
        ("transaction_ts", "timestamp"),
        ("date", "date"),
    ),
}

# Where a bronze row came from. Customers and locations carry no event time, so
# these are the only order in which two versions of a key can be ranked.
INGEST_COLUMNS = (("_ingest_ts", "timestamp"), ("_ingest_file", "string"))

CORRUPT_COLUMN = "_corrupt_record"
RESCUE_COLUMN = "_rescued"
BUCKET_COLUMN = "key_bucket"


@dataclass(frozen=True)
class TableSpec:
    """One layer table: declared columns plus how its files are laid out.

    ``partition_by`` may name layout columns that are not declared columns
    (``key_bucket``), and ``ordered`` tables store which delivery a row came from;
    readers of the table hide those.
    """

    layer: str
    name: str
    schema: StructType
    partition_by: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    ordered: bool = False

    @property
    def bucketed(self) -> bool:
        return BUCKET_COLUMN in self.partition_by

    @property
    def physical_schema(self) -> StructType:
        """Declared columns, then the hidden ones: a row's delivery and its bucket."""
        schema = StructType(list(self.schema.fields))
        for column, data_type in INGEST_COLUMNS if self.ordered else ():
            schema = schema.add(column, data_type)
        return schema.add(BUCKET_COLUMN, "integer") if self.bucketed else schema


def staged_schema(folder: str) -> StructType:
    """Read schema of one staged folder."""
    try:
        return STAGED[folder]
    except KeyError:
        known = ", ".join(sorted(STAGED))
        raise ValueError(f"no staged schema for folder {folder!r}; known folders: {known}") from None


def _bronze(name: str, partition_by: tuple[str, ...] = ()) -> TableSpec:
    schema = StructType(list(STAGED[name].fields))
    for column, data_type in INGEST_COLUMNS:
        schema = schema.add(column, data_type)
    return TableSpec("bronze", name, schema, partition_by)


BRONZE_CUSTOMERS = _bronze("atm_customers")
BRONZE_LOCATIONS = _bronze("atm_locations")
BRONZE_VISITS = _bronze("atm_visits", ("date",))

# Open and closed versions live in different partitions, so a merge reads and
# rewrites open rows only and history is added to, unless a version arrives late.
SILVER_CUSTOMERS = TableSpec(
    "silver",
    "atm_customers",
    _struct(
        ("customer_id", "long"),
        ("card_number", "long"),
        ("checking_savings", "string"),
        ("first_name", "string"),
        ("last_name", "string"),
        ("customer_since_date", "date"),
        ("preferred", "integer"),
        ("current", "boolean"),
        ("effective_date", "date"),
        ("end_date", "date"),
        ("load_ts", "timestamp"),
        ("update_ts", "timestamp"),
    ),
    partition_by=("current", BUCKET_COLUMN),
    keys=("customer_id",),
    ordered=True,
)

SILVER_LOCATIONS = TableSpec(
    "silver",
    "atm_locations",
    _struct(
        ("atm_id", "long"),
        ("city", "string"),
        ("state", "string"),
        ("zip", "string"),
        ("pos_capability", "string"),
        ("offsite_or_onsite", "string"),
        ("bank", "string"),
        ("load_ts", "date"),
    ),
    partition_by=(BUCKET_COLUMN,),
    keys=("atm_id",),
    ordered=True,
)

SILVER_VISITS = TableSpec(
    "silver",
    "atm_visits",
    _struct(
        ("visit_id", "long"),
        ("customer_id", "long"),
        ("atm_id", "long"),
        ("withdrawl_or_deposit", "string"),
        ("amount", "long"),
        ("fraud_report", "string"),
        ("transaction_ts", "timestamp"),
        ("transaction_dt", "date"),
        ("load_ts", "timestamp"),
    ),
    partition_by=("transaction_dt",),
    keys=("visit_id",),
    cluster_by=("customer_id",),
    ordered=True,
)

GOLD_DAILY = TableSpec(
    "gold",
    "daily_transaction_summary_by_bank",
    _struct(
        ("transaction_dt", "date"),
        ("bank", "string"),
        ("total_withdrawls", "long"),
        ("total_deposits", "long"),
        ("create_ts", "timestamp"),
        ("update_ts", "timestamp"),
    ),
    partition_by=("transaction_dt",),
    keys=("transaction_dt", "bank"),
)

GOLD_MONTHLY = TableSpec(
    "gold",
    "monthly_customer_transaction_summary",
    _struct(
        ("transaction_month", "integer"),
        ("customer_id", "long"),
        ("total_withdrawls", "long"),
        ("total_deposits", "long"),
        ("create_ts", "timestamp"),
        ("update_ts", "timestamp"),
    ),
    partition_by=("transaction_month",),
    keys=("transaction_month", "customer_id"),
    cluster_by=("customer_id",),
)

# Side tables, which jobs keep beside a table and SQL users do not see. Each is written in
# the same step as its table.
VISIT_KEYS = TableSpec(
    "silver",
    "atm_visits_keys",
    _struct(("transaction_dt", "date"), ("words", "long"), ("word", "long"), ("bits", "long")),
    cluster_by=("words", "word"),
)

# Deliveries of a customer that repeated the version before them.
CUSTOMER_REPEATS = TableSpec(
    "silver",
    "atm_customers_repeats",
    _struct(("customer_id", "long")),
    partition_by=(BUCKET_COLUMN,),
    keys=("customer_id",),
    ordered=True,
)

LAYER_TABLES = {
    "bronze": (BRONZE_VISITS, BRONZE_CUSTOMERS, BRONZE_LOCATIONS),
    "silver": (SILVER_CUSTOMERS, SILVER_LOCATIONS, SILVER_VISITS),
    "gold": (GOLD_DAILY, GOLD_MONTHLY),
}

# Totals of a day and ATM with how many amounts they are made of, so that amounts can be taken back.
DAILY_BY_ATM = TableSpec(
    "gold",
    "daily_by_atm",
    _struct(
        ("transaction_dt", "date"),
        ("atm_id", "long"),
        ("visits", "long"),
        ("total_withdrawls", "long"),
        ("n_withdrawls", "long"),
        ("total_deposits", "long"),
        ("n_deposits", "long"),
    ),
    partition_by=("transaction_dt",),
    keys=("transaction_dt", "atm_id"),
)

# Which batches of changes those totals hold.
DAILY_BATCHES = TableSpec("gold", "daily_by_atm_batches", _struct(("query_id", "string"), ("batch_id", "long")))

CHANGE_COLUMN = "_change"
BEFORE, AFTER = "before", "after"


def changes_of(spec: TableSpec) -> TableSpec:
    """The side table that holds what merges took out of a table and put into it."""
    schema = StructType(list(spec.physical_schema.fields)).add(CHANGE_COLUMN, "string").add("_change_ts", "timestamp")
    return TableSpec(spec.layer, f"{spec.name}_changes", schema)



def splits_of(spec: TableSpec) -> TableSpec:
    """The side table that names the buckets of a table that were split."""
    return TableSpec(spec.layer, f"{spec.name}_splits", _struct(("bucket", "long")))


SIDE_TABLES = {SILVER_VISITS.name: (VISIT_KEYS,), SILVER_CUSTOMERS.name: (CUSTOMER_REPEATS,), GOLD_DAILY.name: (DAILY_BY_ATM, DAILY_BATCHES)}

# Columns whose change opens a new customer version. checking_savings and
# customer_since_date are deliberately not among them.
TRACKED_CUSTOMER_COLUMNS = ("card_number", "preferred", "first_name", "last_name")
