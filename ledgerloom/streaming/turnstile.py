"""A streaming source that lets so many blocks a minute pass, whatever the trigger."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

MINUTE = 60.0


def admitted(log: list[list[float]], now: float, per_minute: int) -> int:
    """How many may pass now when `log` has (time, passes): no span of a minute holds more than per_minute."""
    return max(0, per_minute - int(sum(n for t, n in log if t > now - MINUTE)))


class Turnstile(DataSource):
    """Offsets count the blocks let through since the beginning; each batch gets a row with the number it may take.

    Options: per_minute, and note, a path at which the last minute's passes are kept, so that a restart does not begin a
    new minute.
    """

    @classmethod
    def name(cls) -> str:
        return "turnstile"

    def schema(self) -> str:
        return "passes long"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return TurnstileReader(int(self.options["per_minute"]), self.options["note"])


class TurnstileReader(DataSourceStreamReader):
    def __init__(self, per_minute: int, note: str, clock: Callable[[], float] = time.time):
        self.per_minute, self.note, self.clock = per_minute, note, clock
        self.total, self.log = 0, []
        self._load()

    def _place(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.note) if "://" in self.note or self.note.startswith("file:") else (fs.LocalFileSystem(), self.note)

    def _load(self) -> None:
        where, path = self._place()
        if where.get_file_info(path).is_file:
            with where.open_input_stream(path) as f:
                kept = json.loads(f.read())
            self.total, self.log = kept["total"], kept["log"]

    def _save(self) -> None:
        where, path = self._place()
        where.create_dir(path.rsplit("/", 1)[0], recursive=True)
        with where.open_output_stream(path + ".part") as f:
            f.write(json.dumps({"total": self.total, "log": self.log}).encode())
        where.move(path + ".part", path)

    def initialOffset(self) -> dict:
        return {"passed": 0}

    def latestOffset(self) -> dict:
        now = self.clock()
        self.log = [x for x in self.log if x[0] > now - MINUTE]
        if n := admitted(self.log, now, self.per_minute):
            self.total += n
            self.log.append([now, n])
            self._save()  # before they are used: a crash loses passes and never doubles them
        return {"passed": self.total}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [InputPartition(end["passed"] - start["passed"])]

    def read(self, partition: InputPartition) -> Iterator[tuple[int]]:
        yield (partition.value,)
