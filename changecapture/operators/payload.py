"""Give narrow change rows their payload back, by key hash.

For users who keep the delta narrow (labels and hashes) and want the rows of either side
later; the runs of this library carry the payload through their one join instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changecapture import columns as C
from changecapture.config import TableConfig
from changecapture.functions.encoding import quoted
from changecapture.functions.hashing import match_columns
from changecapture.operators.classify import new_side, old_side


_SIDE = "side_"


def _attach(changes: DataFrame, side: DataFrame, cfg: TableConfig) -> DataFrame:
    on = match_columns(cfg, side)
    have = {c.lower() for c in changes.columns}
    payload = [c for c in side.columns if not C.is_added(c) and c.lower() not in have]
    other = side.select(*[F.col(quoted(c)).alias(_SIDE + c) for c in dict.fromkeys(on + payload)])
    same = F.col(C.KEY_HASH) == F.col(_SIDE + C.KEY_HASH)
    for name in on[1:]:
        same = same & F.col(quoted(name)).eqNullSafe(F.col(quoted(_SIDE + name)))
    # no hint: the sizes met at run time decide between a broadcast and a shuffle join
    return changes.join(other, same, "inner").select(
        *[F.col(quoted(c)) for c in changes.columns],
        *[F.col(quoted(_SIDE + c)).alias(c) for c in payload],
    )


def attach_new_payload(changes: DataFrame, snapshot: DataFrame, cfg: TableConfig) -> DataFrame:
    """``I`` and ``U`` rows with the snapshot's payload; ``snapshot`` is hashed."""
    return _attach(new_side(changes), snapshot, cfg)


def attach_old_payload(changes: DataFrame, mirror: DataFrame, cfg: TableConfig) -> DataFrame:
    """``D`` and ``S`` rows with the mirror's payload."""
    return _attach(old_side(changes), mirror, cfg)
