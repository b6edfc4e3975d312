"""Change capture between full table snapshots, on Spark."""

from changecapture.config import ConfigError, TableConfig
from changecapture.functions.hashing import add_hashes, key_hash, value_hash
from changecapture.functions.wrap import unwrap
from changecapture.operators.classify import (
    assign_nk,
    changed_keys,
    classify,
    classify_changed,
    deleted,
    delta_of,
    extract_delta,
    inserted,
    mirror_of,
    new_side,
    old_side,
    outer_join_keys,
    stationary,
    updated,
)
from changecapture.operators.digests import differing, digests
from changecapture.operators.fields import FieldSets, narrow, project
from changecapture.operators.guards import (
    DuplicateKeys,
    action_counts,
    dedupe,
    duplicate_keys,
    require_unique,
)
from changecapture.operators.mutate import mutate
from changecapture.operators.payload import attach_new_payload, attach_old_payload
from changecapture.plans.batch import BatchFailed, DeltaStep, PartitionStep, replay, run_batch
from changecapture.plans.build import (
    BuildResult,
    JobAlreadyFinished,
    build_delta,
    create_objects,
    run,
)
from changecapture.plans.compaction import IncompletePeriod, compact_delta, drop_rolled
from changecapture.plans.history import history, replay_at_once
from changecapture.plans.landing import land_hashed
from changecapture.sources.ingest import ingest_jdbc, land_partition, read_jdbc
from changecapture.sources.read import read_landing, read_snapshot, read_table
from changecapture.tables.catalog import (
    add_partition,
    add_partitions,
    create_landing,
    create_link,
    create_mirror,
    drop_partition,
    link_view,
    link_view_sql,
    list_partitions,
    mirror_ddl,
    refresh,
)
from changecapture.tables.claims import ClaimLost, TableBusy
from changecapture.tables.periods import job_statistics, read_delta
from changecapture.tables.store import append_delta, swap_mirror, write_dataset, write_mirror

__all__ = [name for name in dir() if not name.startswith("_")]
