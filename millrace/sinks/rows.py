"""Row-at-a-time output for targets that have no Spark connector."""

from __future__ import annotations

from collections.abc import Callable, Sequence


class RowWriter:
    """Object for ``writeStream.foreach``: one DB-API connection per partition and epoch.

    ``connect`` runs on the executor. Values are passed as bound parameters, never spliced
    into the statement, and NULL stays NULL. Rows go out ``size`` at a time.

    An epoch can be run again. ``record`` is a statement that takes the partition and the
    epoch and fails, or changes no row, if that pair was recorded before; it is part of the
    same transaction as the rows. Without it the statement itself must tolerate repeats.
    """

    def __init__(
        self,
        connect: Callable[[], object],
        statement: str,
        columns: Sequence[str],
        record: str | None = None,
        size: int = 1000,
    ):
        self.connect = connect
        self.statement = statement
        self.columns = list(columns)
        self.record = record
        self.size = size
        self.connection = None
        self.held: list[tuple] = []
        self.fresh = False

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self.connection = self.connect()
        self.held = []
        self.fresh = True
        if self.record is not None:
            cursor = self.connection.cursor()
            cursor.execute(self.record, (partition_id, epoch_id))
            # Nothing recorded: this part of the epoch was committed by an earlier run.
            self.fresh = cursor.rowcount != 0
        return self.fresh

    def process(self, row) -> None:
        self.held.append(tuple(row[name] for name in self.columns))
        if len(self.held) >= self.size:
            self._send()

    def _send(self) -> None:
        if self.held:
            self.connection.cursor().executemany(self.statement, self.held)
            self.held = []

    def close(self, error) -> None:
        if self.connection is None:
            return
        try:
            if error is None and self.fresh:
                self._send()
                self.connection.commit()
            else:
                self.connection.rollback()
        finally:
            self.connection.close()
            self.connection = None
