"""Names the replicated system fixes, and the sizes the jobs run with."""

from __future__ import annotations

# Fixed values of the replicated system. -------------------------------------
# Tables whose presence is tracked in the catalog snapshot.
SNAPSHOT_TABLES = (
    "resp_questions",
    "categories",
    "statuses",
    "resp_list",
    "all_data",
    "surv_options",
    "lexical_themes",
    "new_action_plans",
    "new_action_plan_items",
)

# Tables loaded in full for every flagged tenant.
FULL_LOAD_TABLES = (
    "categories",
    "benchmarks",
    "emerge",
    "resp_list",
    "resp_questions",
    "surv_options",
    "surv_questions",
    "prefill_data",
    "all_data",
    "managers_tree",
    "segments",
    "users",
    "lexical_themes",
    "lexical_keywords",
    "category_qid",
    "settings",
    "benchmark_data",
    "ss_user_apps",
    "statuses",
)

# Columns that identify a row within one tenant's table.
MERGE_KEYS = {
    "emerge": ("sequence",),
    "lexical_themes": ("sequence",),
    "resp_list": ("seq",),
    "surv_options": ("sequence",),
    "surv_questions": ("qid",),
    "benchmarks": ("seq",),
    "category_qid": ("sequence",),
    "users": ("username",),
    "prefill_data": ("sequence",),
    "new_action_plans": ("id",),
    "new_action_plan_items": ("id",),
}

# First letters a shard of tenants may be restricted to.
TENANT_INITIALS = ("P", "S", "K", "L", "I", "G", "H", "O")

# Places of the tenant and the table in a landing path, counted from 1.
SCHEMA_POSITION = 2
TABLE_POSITION = 3

# Tenants handled together in one run.
TENANT_BATCH = 50

# The source's own catalog schema, and the type of rows that are not tables.
SYSTEM_SCHEMA = "information_schema"
VIEW_TYPE = "VIEW"

# What a warehouse says when a string does not fit its column.
TOO_LONG_MESSAGE = "is too long and would be truncated"
# End of fixed values. --------------------------------------------------------

# Spark types for the data types a warehouse's column catalog names. Numbers
# follow their precision and scale; without these they stay text.
DATA_TYPES = {
    "smallint": "smallint",
    "int": "int",
    "integer": "int",
    "bigint": "bigint",
    "double": "double",
    "datetime": "timestamp_ntz",
    "float": "double",
    "boolean": "boolean",
    "text": "string",
    "varchar": "string",
    "date": "date",
    "time": "string",
    "timestamp_ntz": "timestamp_ntz",
    "timestamp_ltz": "timestamp",
    "timestamp_tz": "timestamp",
    "binary": "binary",
    "variant": "string",
    "object": "string",
    "array": "string",
}
NUMBER_TYPES = ("number", "decimal", "numeric")
SIZE_COLUMNS = ("numeric_precision", "numeric_scale")

# A side of a join is broadcast only when its measured size is below this.
BROADCAST_BYTES = 64 * 1024 * 1024

# The size a stored file should have; far smaller ones are put together.
FILE_BYTES = 128 * 1024 * 1024

# More shuffle partitions than this cost the driver more than they save.
MAX_SHUFFLE_PARTITIONS = 100_000

# Touched partitions are put into a static partition filter up to this many.
MAX_PARTITION_LIST = 10_000

# Up to this many, their folders are looked up one by one, and the table's others are not listed.
MAX_FOLDER_LIST = 1_000

# Landing files one run of a batch job applies; their names pass through the driver.
MAX_RUN_FILES = 10_000
