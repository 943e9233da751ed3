"""Updates folded in the stream: what later updates of a key build on is kept as state."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Fold(StatefulProcessor):
    """Applies the updates of a key in order of arrival and hands on the document they make."""

    def __init__(self, key: str, fields: list[tuple[str, bool]], order: list[str], state: T.StructType, unset_nulls: bool, idle_ms: int | None) -> None:
        self.key, self.fields, self.order, self.state = key, fields, order, state
        self.unset_nulls, self.idle_ms = unset_nulls, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.document = handle.getValueState("document", self.state)

    def _applied(self, document: dict, update: Row) -> None:
        for name, is_set in self.fields:
            given = update[name]
            if given is None:
                if self.unset_nulls:
                    document[name] = None
            elif not is_set:
                document[name] = given
            elif len(given):
                held = list(document[name] or [])
                # What the batch fold calls falsy is no item: NULL, "", 0, false.
                held += [x for x in dict.fromkeys(given) if x and x not in held]
                document[name] = held

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        names = [name for name, _ in self.fields]
        document = dict.fromkeys([*names, *self.order])
        if self.document.exists():
            document.update(zip(self.state.names, self.document.get()))
        for update in sorted(rows, key=lambda r: tuple(r[o] for o in self.order)):
            self._applied(document, update)
            document.update({o: update[o] for o in self.order})
        self.document.update(tuple(document[n] for n in self.state.names))
        if self.idle_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        yield Row(**{self.key: key[0], **document})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.document.clear()
        return iter(())

    def close(self) -> None:
        pass


def fold_stream(
    updates: DataFrame, key: str, order: Sequence[str], unset_nulls: bool = True, replace: Sequence[str] = (), idle_ms: int | None = None
) -> DataFrame:
    """A stream of whole documents from a stream of updates: one row per key and micro-batch.

    The documents are those that `fold_updates` makes of all updates up to then, merged into an empty
    table: scalars and the lists in `replace` are set, other lists gain items, NULLs unset. `order` columns
    put the updates of a key in order; what one micro-batch has of a key is sorted in memory, so the
    trigger bounds it. State outlives a restart, as it is part of the checkpoint. It holds what an update may
    leave as it was: with `unset_nulls` only the lists that gain items, for every update sets all else, with a NULL
    too; the document handed on is whole either way. A key without updates
    for `idle_ms` is forgotten: its next document holds only what comes from then on, which a document
    table downstream merges into what it has. The session's state store must be RocksDB
    (`spark.sql.streaming.stateStore.providerClass` = STATE_STORE). Use output mode `update`.
    """
    rest = [f for f in updates.schema.fields if f.name != key and f.name not in order]
    fields = [(f.name, isinstance(f.dataType, T.ArrayType) and f.name not in replace) for f in rest]
    whole = T.StructType([T.StructField(f.name, f.dataType) for f in [*rest, *(updates.schema[o] for o in order)]])
    set_whole = {name for name, is_set in fields if not is_set} if unset_nulls else set()
    kept = T.StructType([f for f in whole.fields if f.name not in set_whole])
    out = T.StructType([T.StructField(key, updates.schema[key].dataType), *whole.fields])
    processor = _Fold(key, fields, list(order), kept, unset_nulls, idle_ms)
    rows = updates.select(key, *whole.names)
    return rows.groupBy(key).transformWithState(processor, out, outputMode="Update", timeMode="None" if idle_ms is None else "ProcessingTime")
