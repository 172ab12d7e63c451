"""S1-S4 as a Spark data source: landed payload files, batch and streaming.

    payloads(spark, folder, keys=["NG.RNGWHHD.D"], start="2024-01-01")
    payloads(spark, folder, stream=True)

A landing folder holds ``<key>/<page>.json``: the key is a series id (kind
"series") or a station ("forecast"), the page the first digits of the dates
inside (``2024``, ``2024-01`` or ``2024-01-05``; a name that starts with none is
never skipped). One row per reading:

    series    file, key, page, date, value, corrupt
    forecast  file, key, page, date, temperature, wind_speed, precipitation, corrupt

The options ``keys``, ``start`` and ``end`` reach the listing: only files whose
name can match are opened, and dates outside give no rows. (They are options
because Spark 4.1's filter push-down for Python sources keeps the filters of one
query for later ones on the same frame, which loses rows; filters in a query are
applied by Spark to what the options leave.) A file that is no complete document
gives one row with its reason in ``corrupt`` and fails nothing
(``on_corrupt=raise`` fails the task). Files are dealt to tasks by size.

A stream's offset is the set of files it has taken, held as the newest
modification time with the names that share it, so a restarted query goes on
after the last committed file and a file is read once. A file must not change
after it has landed (write it elsewhere and rename it).

Listing and reading go through pyarrow's file systems: local and shared mounts,
HDFS and object stores.
"""

from __future__ import annotations

import datetime as dt
import json
import math
import re
from collections.abc import Iterator, Sequence

from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

TASK_BYTES = 32 << 20
PERIODS = 14               # of a forecast page, as ``forecast.parse_forecast``
_HEAD = "file string, key string, page string, date date, "
SCHEMAS = {"series": _HEAD + "value double, corrupt string",
           "forecast": _HEAD + "temperature double, wind_speed double, precipitation double, corrupt string"}
_PAGE = re.compile(r"(\d{4})(-\d\d)?(-\d\d)?(?!\d)")


def open_path(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI (file:/x and /x are local)."""
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


class Files(InputPartition):
    def __init__(self, names: list[str]):
        self.names = names


class Wanted:
    """What the options leave of files and dates."""

    def __init__(self, options: dict):
        self.keys = set(json.loads(options["keys"])) if "keys" in options else None
        self.low = dt.date.fromisoformat(options["start"]) if "start" in options else dt.date.min
        self.high = dt.date.fromisoformat(options["end"]) if "end" in options else dt.date.max

    def file(self, key: str, page: str) -> bool:
        if self.keys is not None and key not in self.keys:
            return False
        m = _PAGE.match(page)
        if not m:
            return True
        first = "-".join(m[0].split("-") + ["01", "01"][m[0].count("-"):])
        last = m[0] + ("-12-31", "-31", "")[m[0].count("-")]     # compared as text: no month is longer
        return first <= self.high.isoformat() and last >= self.low.isoformat()

    def date(self, day: dt.date) -> bool:
        return self.low <= day <= self.high


def listed(folder: str) -> list[tuple[str, int, int]]:
    """(name below the folder, bytes, modification time) of its payload files."""
    system, path = open_path(folder)
    found = system.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True))
    cut = len(path.rstrip("/")) + 1
    return sorted((i.path[cut:], i.size, i.mtime_ns or 0) for i in found
                  if i.is_file and i.path.endswith(".json") and i.path[cut:].count("/") == 1)


def _named(name: str) -> tuple[str, str]:
    key, page = name.split("/")
    return key, page.removesuffix(".json")


def _number(value) -> float | None:
    try:
        out = float(value)
    except (TypeError, ValueError):
        return None
    return None if math.isnan(out) else out


def _series(document: dict) -> Iterator[tuple]:
    for reading in document.get("data") or ():
        period, value = reading["period"], _number(reading.get("value"))
        if value is not None:
            yield dt.date.fromisoformat(period if len(period) > 7 else f"{period}-01"), value


def _forecast(document: dict) -> Iterator[tuple]:
    for p in ((document.get("properties") or {}).get("periods") or ())[:PERIODS]:
        wind = re.search(r"\d+", p.get("windSpeed") or "")
        rain = p["probabilityOfPrecipitation"].get("value") if p.get("probabilityOfPrecipitation") else 0
        yield (dt.date.fromisoformat(p["startTime"][:10]), _number(p.get("temperature")), float(wind[0]) if wind else None,
               _number(rain))


_PARSERS = {"series": _series, "forecast": _forecast}


class _Reading:
    """Shared by the batch and the stream reader."""

    def __init__(self, options: dict):
        self.folder, self.kind = options["path"], options.get("kind", "series")
        self.on_corrupt = options.get("on_corrupt", "report")
        if self.kind not in _PARSERS or self.on_corrupt not in ("report", "raise"):
            raise ValueError(f"kind {self.kind!r}, on_corrupt {self.on_corrupt!r}")
        self.wanted = Wanted(options)

    def deal(self, files: Sequence[tuple[str, int, int]]) -> list[Files]:
        """Files whose names can match, in tasks of about TASK_BYTES."""
        out, held, size = [], [], 0
        for name, n, _ in files:
            if self.wanted.file(*_named(name)):
                held.append(name)
                size += n + (1 << 16)        # opening a file costs, too
                if size >= TASK_BYTES:
                    out.append(Files(held))
                    held, size = [], 0
        return out + [Files(held)] * bool(held)

    def rows(self, part: Files) -> Iterator[tuple]:
        system, path = open_path(self.folder)
        width = SCHEMAS[self.kind].count(",") - 4
        for name in part.names:
            head = (name, *_named(name))
            try:
                with system.open_input_stream(f"{path}/{name}") as f:
                    found = list(_PARSERS[self.kind](json.loads(f.read())))
            except (ValueError, KeyError, TypeError, AttributeError) as e:
                if self.on_corrupt == "raise":
                    raise ValueError(f"corrupt payload {name}: {e}") from e
                yield (*head, None, *[None] * width, f"{type(e).__name__}: {e}")
                continue
            for day, *values in found:
                if self.wanted.date(day):
                    yield (*head, day, *values, None)


class PayloadReader(_Reading, DataSourceReader):
    def partitions(self) -> list[Files]:
        return self.deal(listed(self.folder)) or [Files([])]

    def read(self, partition: Files) -> Iterator[tuple]:
        return self.rows(partition)


class PayloadStreamReader(_Reading, DataSourceStreamReader):
    """Offset: {"time": newest modification time taken, "names": the files of
    that time}. A file belongs to a batch if it is newer than the start and not
    newer than the end."""

    def initialOffset(self) -> dict:
        return {"time": -1, "names": []}

    def latestOffset(self) -> dict:
        files = listed(self.folder)
        newest = max((m for _, _, m in files), default=-1)
        return {"time": newest, "names": [n for n, _, m in files if m == newest]}

    @staticmethod
    def _taken(offset: dict, name: str, time: int) -> bool:
        return time < offset["time"] or time == offset["time"] and name in offset["names"]

    def partitions(self, start: dict, end: dict) -> list[Files]:
        return self.deal([f for f in listed(self.folder) if self._taken(end, f[0], f[2]) and not self._taken(start, f[0], f[2])])

    def read(self, partition: Files) -> Iterator[tuple]:
        return self.rows(partition)


class PayloadSource(DataSource):
    """Options: ``path``, ``kind`` (series, forecast), ``keys`` (a JSON list),
    ``start`` and ``end`` (inclusive dates), ``on_corrupt`` (report, raise)."""

    @classmethod
    def name(cls) -> str:
        return "payloads"

    def schema(self) -> str:
        return SCHEMAS[self.options.get("kind", "series")]

    def reader(self, schema) -> PayloadReader:
        return PayloadReader(dict(self.options))

    def streamReader(self, schema) -> PayloadStreamReader:
        return PayloadStreamReader(dict(self.options))


def payloads(spark: SparkSession, folder: str, kind: str = "series", keys: Sequence[str] | None = None,
             start: str | None = None, end: str | None = None, on_corrupt: str = "report", stream: bool = False) -> DataFrame:
    """The readings of a landing folder, as a batch or a streaming frame."""
    spark.dataSource.register(PayloadSource)
    reader = (spark.readStream if stream else spark.read).format("payloads").option("kind", kind).option("on_corrupt", on_corrupt)
    for name, value in (("keys", json.dumps(list(keys)) if keys is not None else None), ("start", start), ("end", end)):
        if value is not None:
            reader = reader.option(name, value)
    return reader.load(folder)


def write_payloads(pages, folder: str, key_col: str = "series_id", page_col: str = "_page", payload_col: str = "payload") -> None:
    """Land payload rows as ``<key>/<page>.json`` files: each is written under a
    hidden name and renamed, so a reader never sees a part of one."""
    key, page, payload = (pages.columns.index(c) for c in (key_col, page_col, payload_col))

    def land(rows: Iterator[Row]) -> None:
        system, path = open_path(folder)
        for r in rows:
            target = f"{path}/{r[key]}/{r[page]}.json"
            system.create_dir(f"{path}/{r[key]}", recursive=True)
            with system.open_output_stream(f"{target}.part") as f:
                f.write((r[payload] or "").encode())
            system.move(f"{target}.part", target)

    pages.foreachPartition(land)
