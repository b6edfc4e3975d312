"""Match a hashed snapshot with the mirror, label every row and stamp its lineage.

One full outer join on the key hash carries both payloads; every later step is a
projection or a filter over its result. Key hashes are unique on both sides (see
``guards``), so the join's partitions are even and no row is paired twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changecapture import columns as C
from changecapture.config import ConfigError, TableConfig
from changecapture.functions.encoding import framed, framed_literal, quoted
from changecapture.functions.hashing import identity, match_columns

NEW, OLD = "new_", "old_"

# rank of a row among those of its key, and the labels of second copies on either side
RANK = "__copy"
NEW_COPY, OLD_COPY = "copy in snapshot", "copy in mirror"


def _new(name: str) -> Column:
    return F.col(quoted(NEW + name))


def _old(name: str) -> Column:
    return F.col(quoted(OLD + name))


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(quoted(c)).alias(prefix + c) for c in df.columns])


def outer_join_keys(new: DataFrame, old: DataFrame, cfg: TableConfig) -> DataFrame:
    """Full outer join of two hashed sides; columns come out as ``new_*`` and ``old_*``.

    The join key is the key hash; for short hashes also the key columns, so that two
    keys with the same hash stay apart.
    """
    on = None
    for name in match_columns(cfg, new):
        same = _new(name) == _old(name) if name == C.KEY_HASH else _new(name).eqNullSafe(_old(name))
        on = same if on is None else on & same
    return _prefixed(new, NEW).join(_prefixed(old, OLD), on, "full_outer")


def label() -> Column:
    """I, D, S or U of a joined pair."""
    return (
        F.when(_old(C.KEY_HASH).isNull(), C.INSERT)
        .when(_new(C.KEY_HASH).isNull(), C.DELETE)
        .when(_new(C.VALUE_HASH) == _old(C.VALUE_HASH), C.STATIONARY)
        .otherwise(C.UPDATE)
    )


def assign_nk(cfg: TableConfig, key: Column, job: Column | None = None) -> Column:
    """Surrogate key of a row that is new in this job (or in ``job``), shaped like a UUID.

    It follows from the table's scope, key and job. A retried task therefore repeats it, and a key
    that was deleted and returns under a later job gets a new one.
    """
    seed = F.concat(
        F.lit(framed_literal(cfg.nk_scope)),
        framed(key, T.StringType()),
        F.lit(framed_literal(cfg.job_id)) if job is None else framed(job, T.StringType()),
    )
    shaped = F.md5(seed)
    for at in (9, 14, 19, 24):
        shaped = F.overlay(shaped, F.lit("-"), F.lit(at), F.lit(0))
    return shaped


def ranked(df: DataFrame, names: list[str], repeats: bool = True) -> DataFrame:
    """Number the rows of each key and keep two at most.

    Window and join ask for the same partitions and order, so the join that follows reuses
    both, and of a hot key a task passes on two rows. Where no ``repeats`` are to be expected
    the copies of a key are not looked for before the shuffle, which spares a sort of all rows.
    """
    window = Window.partitionBy(*[F.col(quoted(n)) for n in names]).orderBy(F.lit(1))
    # the planner limits each task's rows beforehand if it is told the limit as it stands
    limited = F.col(RANK) <= 2 if repeats else F.col(RANK) + 0 <= 2
    return df.withColumn(RANK, F.row_number().over(window)).where(limited)


def _payload_columns(new: DataFrame, cfg: TableConfig) -> list[str]:
    skipped = set(cfg.partition_columns) - set(cfg.keys) if not cfg.inline else set()
    skipped.add(RANK)
    return [c for c in new.columns if not C.is_added(c) and c.lower() not in skipped]


def _link_columns(cfg: TableConfig) -> list[str]:
    """Source partition columns a link row points with."""
    if cfg.inline:
        return []
    return [c for c in cfg.partition_columns if c not in cfg.keys]


def _check_sides(new: DataFrame, old: DataFrame, wanted: list[str], cfg: TableConfig) -> None:
    """Both sides must have the same columns, of the same types, in any order."""
    have = {f.name.lower(): f.dataType.simpleString() for f in old.schema.fields}
    types = {f.name.lower(): f.dataType.simpleString() for f in new.schema.fields}
    for name in wanted:
        low = name.lower()
        if low not in have:
            raise ConfigError(f"{cfg.table}: the mirror has no column {name}")
        if low in types and types[low] != have[low]:
            raise ConfigError(
                f"{cfg.table}: column {name} is {types[low]} in the snapshot "
                f"and {have[low]} in the mirror"
            )
    known = {name.lower() for name in wanted}
    known.add(RANK)
    lost = [c for c in old.columns if not C.is_added(c) and c.lower() not in known]
    if lost:
        raise ConfigError(f"{cfg.table}: the snapshot has no column {', '.join(lost)}")


def _first_load(new: DataFrame, cfg: TableConfig) -> DataFrame:
    stamps = {
        C.JOB: F.lit(cfg.job_id),
        C.UNIACT: F.lit(None).cast("string"),
        C.AUTO: F.lit("N"),
        C.ARCHIVE: F.lit("N"),
        C.ACT: F.lit(C.INSERT),
    }
    if cfg.table_type == "dim":
        stamps[C.NK] = assign_nk(cfg, identity(cfg, new))
    return new.select(
        *[stamps[n].alias(n) for n in C.lineage(cfg.table_type)],
        *[F.col(n) for n in C.HASHES],
        *[F.col(quoted(c)) for c in _payload_columns(new, cfg)],
        *[F.lit(cfg.partition_value(c)).alias(c) for c in _link_columns(cfg)],
    )


def classify(new: DataFrame, old: DataFrame | None, cfg: TableConfig) -> DataFrame:
    """Every row of either side, labelled and stamped.

    ``new`` is a hashed snapshot (``add_hashes``), ``old`` the current mirror or link
    rows, None on the very first load. The result has the lineage columns, both hashes
    and the payload (inline), or the key and source partition columns (link). Inserted
    and updated rows show the new side, deleted and stationary rows the old side:
    columns excluded from the hashes therefore keep their old values on ``S`` rows.

    Keys must be unique on either side; ``build_delta`` makes sure of it. Sides that were
    ``ranked`` may hold a key twice: its second copies come out under labels of their own.
    """
    if old is None:
        return _first_load(new, cfg)

    new_rows, old_rows = _sides(new, old, cfg)
    act = label()
    if RANK in old_rows.columns:
        act = F.when(_old(RANK) > 1, OLD_COPY).otherwise(act)
    if RANK in new_rows.columns:
        act = F.when(_new(RANK) > 1, NEW_COPY).otherwise(act)
    pairs = outer_join_keys(new_rows, old_rows, cfg).withColumn(C.ACT, act)
    return _stamped(pairs, new_rows, old_rows, cfg)


def changed_keys(new: DataFrame, old: DataFrame, cfg: TableConfig) -> DataFrame:
    """Key hash, label and value hashes of the rows that are not stationary, and what they carry.

    Reads and moves hashes only, however wide the rows are.
    """
    carried = _carried(cfg)
    pairs = outer_join_keys(
        new.select(*C.HASHES),
        old.select(*[F.col(c).alias(c) for c in (*C.HASHES, *carried)]),
        cfg,
    ).withColumn(C.ACT, label())
    return pairs.where(F.col(C.ACT) != C.STATIONARY).select(
        F.coalesce(_old(C.KEY_HASH), _new(C.KEY_HASH)).alias(C.KEY_HASH),
        C.ACT,
        _new(C.VALUE_HASH).alias(NEW + C.VALUE_HASH),
        _old(C.VALUE_HASH).alias(OLD + C.VALUE_HASH),
        *[_old(c).alias(c) for c in carried],
    )


def classify_changed(
    new: DataFrame, old: DataFrame, changes: DataFrame, cfg: TableConfig
) -> DataFrame:
    """The rows of ``classify``, given their ``changed_keys``, without shuffling wide rows.

    ``changes`` should be a written table: from its size the planner chooses the joins. While
    it is small, the rows of the mirror stay where they are read; the changed rows of the
    snapshot are gathered.
    """
    new_rows, old_rows = _sides(new, old, cfg)
    act = F.col(C.ACT)
    gone = changes.where(act.isin(C.UPDATE, C.DELETE)).select(C.KEY_HASH, C.ACT)
    came = changes.where(act.isin(C.INSERT, C.UPDATE)).select(
        C.KEY_HASH, C.ACT, *[F.col(c).alias(OLD + c) for c in changes.columns if c == C.NK]
    )
    kept = (
        _prefixed(old_rows, OLD)
        .join(gone, _old(C.KEY_HASH) == F.col(C.KEY_HASH), "left")
        .where(act.isNull() | (act == C.DELETE))
        .withColumn(C.ACT, F.coalesce(act, F.lit(C.STATIONARY)))
        .drop(C.KEY_HASH)
    )
    fresh = (
        _prefixed(new_rows, NEW)
        .join(came, _new(C.KEY_HASH) == F.col(C.KEY_HASH))
        .drop(C.KEY_HASH)
        .hint("rebalance")
    )
    pairs = kept.unionByName(fresh, allowMissingColumns=True)
    return _stamped(pairs, new_rows, old_rows, cfg)


def _carried(cfg: TableConfig) -> list[str]:
    """Lineage columns a row keeps from its old side."""
    return [C.NK] if cfg.table_type == "dim" else [C.JOB]


def _sides(new: DataFrame, old: DataFrame, cfg: TableConfig) -> tuple[DataFrame, DataFrame]:
    """Both sides cut to the columns a run needs, under the snapshot's names."""
    payload = _payload_columns(new, cfg)
    wanted = [*_carried(cfg), *C.HASHES, *payload, *_link_columns(cfg)]
    _check_sides(new, old, wanted, cfg)
    rank = lambda df: [RANK] if RANK in df.columns else []
    return (
        new.select(*[F.col(quoted(c)) for c in (*C.HASHES, *payload, *rank(new))]),
        old.select(*[F.col(quoted(c)).alias(c) for c in (*wanted, *rank(old))]),
    )


def _stamped(pairs: DataFrame, new: DataFrame, old: DataFrame, cfg: TableConfig) -> DataFrame:
    """Rows of the result from labelled pairs of ``new_*`` and ``old_*`` columns."""
    payload, pointers = _payload_columns(new, cfg), _link_columns(cfg)
    act = F.col(C.ACT)
    fresh = act.isin(C.INSERT, C.UPDATE)
    job = F.lit(cfg.job_id)
    stamps = {
        C.UNIACT: F.lit(None).cast("string"),
        C.AUTO: F.lit("N"),
        C.ARCHIVE: F.when(act == C.DELETE, "Y").otherwise("N"),
        C.ACT: act,
    }
    if cfg.table_type == "dim":
        fresh_nk = assign_nk(cfg, identity(cfg, new, NEW))
        stamps[C.NK] = F.when(act == C.INSERT, fresh_nk).otherwise(_old(C.NK))
        stamps[C.JOB] = job
    else:
        # an unchanged fact stays with the job that last wrote it
        stamps[C.JOB] = F.when(act == C.STATIONARY, _old(C.JOB)).otherwise(job)

    types = {f.name.lower(): f.dataType for f in old.schema.fields}
    return pairs.select(
        *[stamps[n].alias(n) for n in C.lineage(cfg.table_type)],
        F.coalesce(_old(C.KEY_HASH), _new(C.KEY_HASH)).alias(C.KEY_HASH),
        F.when(fresh, _new(C.VALUE_HASH)).otherwise(_old(C.VALUE_HASH)).alias(C.VALUE_HASH),
        *[F.when(fresh, _new(c)).otherwise(_old(c)).alias(c) for c in payload],
        *[
            F.when(fresh, F.lit(cfg.partition_value(c)).cast(types[c]))
            .otherwise(_old(c))
            .alias(c)
            for c in pointers
        ],
    )


def new_side(classified: DataFrame) -> DataFrame:
    """Rows whose current values come from the snapshot."""
    return classified.where(F.col(C.ACT).isin(C.INSERT, C.UPDATE))


def old_side(classified: DataFrame) -> DataFrame:
    """Rows whose current values come from the mirror."""
    return classified.where(F.col(C.ACT).isin(C.DELETE, C.STATIONARY))


def inserted(classified: DataFrame) -> DataFrame:
    return classified.where(F.col(C.ACT) == C.INSERT)


def updated(classified: DataFrame) -> DataFrame:
    return classified.where(F.col(C.ACT) == C.UPDATE)


def deleted(classified: DataFrame) -> DataFrame:
    return classified.where(F.col(C.ACT) == C.DELETE)


def stationary(classified: DataFrame) -> DataFrame:
    return classified.where(F.col(C.ACT) == C.STATIONARY)


def delta_of(classified: DataFrame) -> DataFrame:
    """Inserted, updated and deleted rows."""
    return classified.where(F.col(C.ACT) != C.STATIONARY)


def mirror_of(classified: DataFrame) -> DataFrame:
    """Rows that exist after the run, without their label."""
    return classified.where(F.col(C.ACT) != C.DELETE).drop(C.ACT)


def extract_delta(
    new: DataFrame, old: DataFrame | None, cfg: TableConfig
) -> tuple[DataFrame, DataFrame]:
    """Delta and new mirror of a hashed snapshot, both lazy.

    They share one plan, so using both runs the join twice; ``build_delta`` writes the
    classified rows once instead.
    """
    rows = classify(new, old, cfg)
    return delta_of(rows), mirror_of(rows)
