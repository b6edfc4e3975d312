"""Names and order of the columns the library adds to a table.

Fixed values: these names and their order are part of the stored tables.
"""

from __future__ import annotations

from pyspark.sql import types as T

NK = "NK"
JOB = "DWSJOB"
UNIACT = "DWSUNIACT"
AUTO = "DWSAUTO"
ARCHIVE = "DWSARCHIVE"
ACT = "DWSACT"
KEY_HASH = "DWSKEYHASH"
VALUE_HASH = "DWSVALHASH"

DIM_LINEAGE = (NK, JOB, UNIACT, ARCHIVE, ACT)
FACT_LINEAGE = (JOB, AUTO, ARCHIVE, ACT)
HASHES = (KEY_HASH, VALUE_HASH)

# every name the library may add, in the order a mirror shows them
ADDED = (NK, JOB, UNIACT, AUTO, ARCHIVE, ACT, KEY_HASH, VALUE_HASH)
NOT_NULL = (NK, JOB, KEY_HASH, VALUE_HASH)

INSERT, UPDATE, DELETE, STATIONARY = "I", "U", "D", "S"


def lineage(table_type: str) -> tuple[str, ...]:
    """Lineage columns of a dimension or a fact table, in storage order."""
    return DIM_LINEAGE if table_type == "dim" else FACT_LINEAGE


def added_field(name: str) -> T.StructField:
    return T.StructField(name, T.StringType(), name not in NOT_NULL)


def is_added(name: str) -> bool:
    return name.upper() in ADDED
