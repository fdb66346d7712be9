"""Silver as a stream over bronze: upsert per micro-batch, with a checkpoint of its own.

The checkpoint replaces the high-water mark: no row is skipped because it became visible late,
and none is read twice because its batch left nothing in silver. A micro-batch that is run again
after a failure is recognised by its id, which is part of the commit.

With ``delta_runs`` a micro-batch writes its own rows only, whatever buckets their keys are in; see ``sinks.store``. Readers
by catalog name see it once it is folded (``StoredTable.compact``), ``read_table`` at once.
``keep_versions`` expires older versions after each commit, so a stream that never ends does not pile them up.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..contract import TableContract
from ..plans.silver import build_fan_out
from ..sinks import files
from ..sinks.store import Batch, StoredTable


def start_silver(
    bronze: DataFrame,
    contract: TableContract,
    target: StoredTable,
    checkpoint: str,
    available_now: bool = True,
    on_error: str = "fail",
    delta_runs: bool = False,
    keep_versions: int | None = None,
) -> StreamingQuery:
    targets = {target.name: (contract, target)}
    return start_silver_fan_out(bronze, targets, checkpoint, available_now, False, on_error, delta_runs, keep_versions)


def start_silver_fan_out(
    bronze: DataFrame,
    targets: Mapping[str, tuple[TableContract, StoredTable]],
    checkpoint: str,
    available_now: bool = True,
    share_scan: bool = False,
    on_error: str = "fail",
    delta_runs: bool = False,
    keep_versions: int | None = None,
) -> StreamingQuery:
    """Each micro-batch feeds all tables. Over Parquet every table reads its own columns, which
    measures faster than keeping the batch; ``share_scan`` is for sources that are slow to read."""

    def write(batch: DataFrame, batch_id: int) -> None:
        bound = {name: (c, _bound(t, batch, delta_runs and bool(c.primary_keys))) for name, (c, t) in targets.items()}
        build_fan_out(batch, bound, _identified(batch, batch_id, checkpoint), share_scan, on_error)
        if keep_versions is not None:
            for _, table in bound.values():
                if table.exists:
                    table.expire(keep_versions)

    return _start(bronze, write, checkpoint, available_now)


def _bound(target: StoredTable, batch: DataFrame, delta_runs: bool) -> StoredTable:
    """The batch has the stream's own session; the table must be written by the same one."""
    return replace(target, spark=batch.sparkSession, delta_runs=delta_runs or target.delta_runs)


def _identified(batch: DataFrame, number: int, checkpoint: str) -> Batch:
    """Streams write their id into the checkpoint before the first batch runs."""
    text = files.read_text(batch.sparkSession, f"{checkpoint.rstrip('/')}/metadata")
    return Batch(json.loads(text)["id"], number)


def _start(bronze: DataFrame, write, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = bronze.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
