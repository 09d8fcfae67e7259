"""Type-2 history kept up to date: intervals of touched keys only are computed again.

Two tables of a lake belong together, both bucketed by key: every version that
ever arrived, and the intervals. A batch is added to the versions; the keys it
holds are read back from their buckets and their intervals replaced. A version
that arrives late so splits the interval it falls into, whatever was recorded
since, and the result equals a rebuild from all versions.

Buckets that hold a touched key are rewritten in any case. Where a batch is too
large to be broadcast, picking its keys out of the versions and out of the
intervals would shuffle both; the intervals of the touched buckets are then
computed from their versions, which are shuffled once, to where they are written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.incremental import scd2_history
from ..sources.versions import BUCKET, Change, bucketed

PERIOD = "month"
SLICES = 8  # a bucket's intervals are computed and written in so many parts


def _intervals(log: DataFrame, keys: Sequence[str], tracked: Sequence[str], valid_from: str, buckets: int) -> DataFrame:
    """Intervals of versions that carry their bucket, dealt out as they will be written."""
    sliced = log.withColumn("_slice", F.pmod(F.hash(*keys), F.lit(SLICES)))
    return bucketed(scd2_history(sliced, keys, tracked, valid_from, period=PERIOD, place=[BUCKET, "_slice"]), keys, buckets)


def start_history(change: Change, versions: DataFrame, name: str, keys: Sequence[str], tracked: Sequence[str],
                  valid_from: str, buckets: int) -> None:
    """Write ``<name>_versions`` and ``<name>_history`` from the first versions."""
    rows = versions.select(*keys, *tracked, valid_from)
    log = change.write(f"{name}_versions", bucketed(rows, keys, buckets), [BUCKET])
    change.write(f"{name}_history", _intervals(log, keys, tracked, valid_from, buckets), [BUCKET], placed=True)


def merge_versions(change: Change, batch: DataFrame, name: str, keys: Sequence[str], tracked: Sequence[str],
                   valid_from: str, buckets: int) -> list[str]:
    """Add a batch of versions and replace the intervals of its keys; returns the buckets it touches."""
    versions, history = f"{name}_versions", f"{name}_history"
    entry = change.entries[versions]
    rows = bucketed(batch.select(*keys, *tracked, valid_from), keys, buckets).select(*entry.struct.fieldNames())
    run, folders = change.lake.write_run(versions, rows, [BUCKET])
    if not folders:
        return []
    change.add_run(versions, run, folders)
    log = change.read(versions, folders)
    if change.lake.run_bytes(versions, run, folders) > change.lake.broadcast_limit():
        change.rewrite(history, folders, _intervals(log, keys, tracked, valid_from, buckets), placed=True)
        return folders
    staged = change.lake.read_runs(versions, entry, [(run, f) for f in folders])
    touched = staged.select(*keys).distinct()
    log = log.join(touched, [log[k].eqNullSafe(touched[k]) for k in keys], "left_semi")
    change.remove(history, touched, keys, folders)
    change.append(history, bucketed(scd2_history(log, keys, tracked, valid_from, period=PERIOD), keys, buckets))
    return folders
