"""Upserts into a relational table through any Python DB-API driver.

Per partition one connection is opened and closed, and rows go in chunks: those whose key the table
has are updated, the others inserted. A batch is first reduced to the newest row per key, so that partitions never
write the same key and a batch that is run again ends in the same table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from itertools import islice

from pyspark.sql import DataFrame

from tideline.functions.records import last_record


CHUNK = 500


def newest_per_key(batch: DataFrame, key: str, values: Sequence[str], order: Sequence[str]):
    newest = batch.groupBy(key).agg(last_record(order, values, "_newest"))
    return newest.select(key, "_newest.*")


def statements(table: str, key: str, values: Sequence[str], mark: str = "?") -> tuple[str, str]:
    """(update, insert) with the driver's placeholder."""
    sets = ", ".join(f"{v} = {mark}" for v in values)
    names = ", ".join([key, *values])
    marks = ", ".join([mark] * (len(values) + 1))
    return (
        f"update {table} set {sets} where {key} = {mark}",
        f"insert into {table} ({names}) values ({marks})",
    )


def known_keys(table: str, key: str, n: int, mark: str = "?") -> str:
    """The query for which of `n` keys the table has."""
    return f"select {key} from {table} where {key} in ({', '.join([mark] * n)})"


def upsert_rows(
    rows: Iterable, connect: Callable, table: str, key: str, values: Sequence[str],
    mark: str = "?", chunk: int = CHUNK,
) -> None:
    """Upsert rows of distinct keys, `chunk` at a time: one look for the known keys, then the updates
    of those and the inserts of the others as one statement each with many rows."""
    update, insert = statements(table, key, values, mark)
    connection = connect()
    try:
        cursor = connection.cursor()
        rows = iter(rows)
        while some := list(islice(rows, chunk)):
            cursor.execute(known_keys(table, key, len(some), mark), [r[key] for r in some])
            known = {found[0] for found in cursor.fetchall()}
            old = [[*[r[v] for v in values], r[key]] for r in some if r[key] in known]
            new = [[r[key], *[r[v] for v in values]] for r in some if r[key] not in known]
            if old:
                cursor.executemany(update, old)
            if new:
                cursor.executemany(insert, new)
        connection.commit()
    finally:
        connection.close()


def upsert_batch(
    connect: Callable, table: str, key: str, values: Sequence[str], order: Sequence[str],
    mark: str = "?", writers: int = 16,
) -> Callable[[DataFrame, int], None]:
    """A writer for `foreachBatch`; `connect` makes a connection on the executor, at most `writers`
    of them at a time. Rows without a key can't be upserted and are left out."""

    def write(batch: DataFrame, batch_id: int) -> None:
        known = batch.filter(batch[key].isNotNull())
        newest = newest_per_key(known, key, values, order)
        newest.repartition(writers, key).foreachPartition(
            lambda rows: upsert_rows(rows, connect, table, key, values, mark)
        )

    return write
