"""M7: a change log with stored states, for reads of the table as it was at any position.

The log's files carry the bounds of their ``seq``, and the table's state is stored at the end of the file with which
``every`` changes have come since the last one.
A read at position n takes the latest state at or before n and applies the changes after it, whose files are found
by their bounds: at most ``every`` changes and a file's are folded, however long the log has become.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.changes import apply_changes
from ledgerlake.sources import fs
from ledgerlake.sources.filetable import FileTable
from ledgerlake.sources.io import stage_table

#: Changes between two stored states.
EVERY = 10_000_000


class LogArchive:
    def __init__(self, spark: SparkSession, root: str, every: int = EVERY):
        self.spark, self.root, self.every = spark, root.rstrip("/"), every
        self.log = FileTable(spark, f"{self.root}/log")

    def create(self, base: DataFrame, changes_schema: T.StructType) -> LogArchive:
        """An archive of a table that starts as ``base``, before every change."""
        self.log.create(self.spark.createDataFrame([], changes_schema), zones=["seq"])
        self._store(base, None)
        return self

    # ------------------------------------------------------------ states
    def _store(self, state: DataFrame, position: int | None) -> None:
        folder = f"state={uuid.uuid4().hex[:12]}"
        state.write.option("compression", "zstd").parquet(f"{self.root}/{folder}")
        name = "start" if position is None else str(position)
        fs.write_text(self.spark, f"{self.root}/_states/{name}", json.dumps({"folder": folder, "schema": json.loads(state.schema.json())}))

    def states(self) -> list[int]:
        """Positions of the stored states, besides the start."""
        return sorted(int(n) for n in fs.list_names(self.spark, f"{self.root}/_states") if n.lstrip("-").isdigit())

    def _state(self, position: int | None) -> DataFrame:
        c = json.loads(fs.read_text(self.spark, f"{self.root}/_states/{'start' if position is None else position}"))
        return self.spark.read.schema(T.StructType.fromJson(c["schema"])).parquet(f"{self.root}/{c['folder']}")

    # ------------------------------------------------------------ writing
    def append(self, changes: DataFrame) -> None:
        """Add changes, all after those that are there (else it raises), and store the states that are due.  A
        state that is missing, since its writer died, is stored by the next call."""
        changes = stage_table(changes, "changes")
        low, n = changes.agg(F.min("seq"), F.count(F.lit(1))).first()
        last = self.log.files().agg(F.max("hi_seq")).first()[0]
        if n and last is not None and low <= last:
            raise ValueError(f"changes from {low} on were appended after {last}")
        if n:
            # several files a batch, each a range of positions
            self.log.append(changes.repartitionByRange(1 + n // max(1, self.every // 4), "seq").sortWithinPartitions("seq"), as_is=True)
        self._store_due()

    def _store_due(self) -> None:
        """Store the states at the ends of the files with which enough changes have come since the one before."""
        at, came = (self.states() or [None])[-1], 0
        files = self.log.files() if at is None else self.log.files().where(F.col("lo_seq") > at)
        for e in sorted(files.select("hi_seq", "rows").collect()):      # files do not overlap
            came += e.rows
            if came >= self.every:
                self._store(self.as_of(e.hi_seq), e.hi_seq)
                came = 0

    # ------------------------------------------------------------ reading
    def since(self, position: int) -> tuple[int | None, dict]:
        """The state to start from and the range of changes to apply for a read at a position."""
        before = [s for s in self.states() if s <= position]
        at = before[-1] if before else None
        return at, {"seq": (None if at is None else at + 1, position)}

    def as_of(self, position: int) -> DataFrame:
        """The table after all changes up to a position."""
        at, within = self.since(position)
        return apply_changes(self._state(at), self.log.read(within))
