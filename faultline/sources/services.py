"""Web services as Python data sources: one partition a request (agency and year, or event and station).

A request is a function ``fetch(**request) -> iterable of tuples``; it runs on executors, opens its
connection there at first use, and retries. Without a network the same source reads landed JSON.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from datetime import UTC, datetime
from pathlib import Path
from urllib.parse import quote, urlencode
from urllib.request import urlopen
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Where and from when the catalogue is asked for (fixed values).
BOX = {"minlatitude": 35.0, "maxlatitude": 43.0, "minlongitude": 25.0, "maxlongitude": 45.5}
LEAST_MAGNITUDE, FIRST_YEAR = 3.0, 1990


def year_requests(agencies: list[str], first: int = FIRST_YEAR, last: int | None = None) -> list[dict]:
    """A request for each agency and year, both ends included."""
    last = last or time.gmtime().tm_year
    return [{"agency": a, "year": y} for a in agencies for y in range(first, last + 1)]


def query_url(base: str, year: int, box: dict[str, float] | None = None, least: float = LEAST_MAGNITUDE, form: str = "geojson") -> str:
    """An event web service's query for a calendar year."""
    words = {"format": form, "starttime": f"{year}-01-01", "endtime": f"{year}-12-31", "minmagnitude": least, **(box or BOX)}
    return f"{base}?{urlencode(words)}"


def download(url: str, seconds: float = 60.0) -> bytes:
    with urlopen(url, timeout=seconds) as answer:  # noqa: S310
        return answer.read() if answer.status == 200 else b""  # 204: no events


def _texts(parent: ElementTree.Element, path: str) -> str | None:
    found = parent
    for step in path.split("/"):
        found = next((c for c in found if c.tag.rpartition("}")[2] == step), None)
        if found is None:
            return None
    return (found.text or "").strip() or None


def quakeml_events(content: bytes, source: str) -> list[tuple]:
    """Rows of ``tables.RAW`` of a QuakeML document.

    An event's preferred origin and magnitude count, else its first ones; an event without either is left
    out. Depths come in metres, a missing one is 0; magnitude types are lower-cased, a missing one is empty.
    An empty document has no events.
    """
    rows = []
    for event in ElementTree.fromstring(content).iter() if content.strip() else ():
        if event.tag.rpartition("}")[2] != "event":
            continue
        chosen = {}
        for kind, wish in (("origin", "preferredOriginID"), ("magnitude", "preferredMagnitudeID")):
            every = [c for c in event if c.tag.rpartition("}")[2] == kind]
            chosen[kind] = next((c for c in every if c.get("publicID") == _texts(event, wish)), every[0] if every else None)
        origin, magnitude = chosen["origin"], chosen["magnitude"]
        if origin is None or magnitude is None:
            continue
        number = lambda at, path: float(v) if (v := _texts(at, path)) is not None else None
        at = datetime.fromisoformat((_texts(origin, "time/value") or "").replace("Z", "+00:00"))
        at = at if at.tzinfo else at.replace(tzinfo=UTC)
        rows.append((
            event.get("publicID"), at, number(origin, "latitude/value"), number(origin, "longitude/value"), (number(origin, "depth/value") or 0.0) / 1000.0,
            number(magnitude, "mag/value"), (_texts(magnitude, "type") or "").lower(), source,
        ))
    return rows


def agency_events(bases: dict[str, str], get: Callable[[str], bytes] = download) -> Callable[..., list[tuple]]:
    """The fetch function of event web services (agency: address of its query), for ``service`` with ``tables.RAW``."""

    def fetch(agency: str, year: int) -> list[tuple]:
        return quakeml_events(get(query_url(bases[agency], year, form="xml")), agency)

    return fetch


def kept(folder: str, key: str, fetch: Callable[[str], bytes], ending: str = "xml") -> bytes:
    """What ``fetch`` gives for a key (a station's response), fetched once and kept in a shared folder.

    The file appears whole or not at all, so tasks that fetch the same key at a time do not harm each other.
    """
    name = Path(folder) / f"{quote(key, safe='')}.{ending}"
    if not name.exists():
        content = fetch(key)
        name.parent.mkdir(parents=True, exist_ok=True)
        part = name.with_name(f".{name.name}.{uuid.uuid4().hex}")
        part.write_bytes(content)
        os.replace(part, name)
        return content
    return name.read_bytes()


class Request(InputPartition):
    def __init__(self, value: dict):
        super().__init__(json.dumps(value, sort_keys=True))


class ServiceReader(DataSourceReader):
    def __init__(self, options: dict, fetch: Callable[..., Iterable[tuple]] | None):
        self.requests = json.loads(options.get("requests", "[]"))
        self.tries, self.pause = int(options.get("tries", "3")), float(options.get("pause", "0.5"))
        self.skip = options.get("onFailure", "fail") == "skip"
        self.fetch = fetch

    def partitions(self) -> list[Request]:
        return [Request(r) for r in self.requests]

    def read(self, partition: Request) -> Iterator[tuple]:
        if not self.requests:
            return
        for n in range(self.tries):
            try:
                rows = list(self.fetch(**json.loads(partition.value)))
                break
            except Exception:  # a service may fail in any way; the last try decides
                if n + 1 == self.tries:
                    if self.skip:
                        return
                    raise
                time.sleep(self.pause)
        yield from rows


def service(name: str, columns: str, fetch: Callable[..., Iterable[tuple]]) -> type[DataSource]:
    """A data source class for ``spark.dataSource.register``; options: requests (JSON list), tries, pause, onFailure."""

    class Service(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return columns

        def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
            return ServiceReader(self.options, fetch)

    return Service


GEOJSON = "struct<features:array<struct<id:string,properties:struct<mag:double,magType:string,place:string,time:bigint,status:string>,geometry:struct<coordinates:array<double>>>>>"


def geojson_events(landed: DataFrame, source: str, column: str = "value") -> DataFrame:
    """Events of landed GeoJSON documents, one row a feature."""
    f = landed.select(F.explode(F.from_json(column, GEOJSON)["features"]).alias("f"))
    at = F.col("f.geometry.coordinates")
    return f.select(
        F.col("f.id").alias("event_id"), F.col("f.properties.mag").alias("magnitude"), F.col("f.properties.magType").alias("mag_type"), F.col("f.properties.place").alias("place"),
        F.get(at, F.lit(0)).alias("longitude"), F.get(at, F.lit(1)).alias("latitude"), F.get(at, F.lit(2)).alias("depth_km"), F.col("f.properties.status").alias("status"),
        F.lit(source).alias("source"), F.timestamp_millis("f.properties.time").alias("time_utc"),
    )


def preferred(origins: DataFrame, key: str = "event_id", flag: str = "preferred", order: str = "place") -> DataFrame:
    """Of each event's origins (or magnitudes) the preferred one, else the first."""
    columns = [c for c in origins.columns if c not in (key, flag, order)]
    return origins.groupBy(key).agg(F.min_by(F.struct(*columns), F.struct(~F.coalesce(flag, F.lit(False)), F.col(order))).alias("o")).select(key, "o.*")


def station_tables(landed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stations and channels of landed inventory rows (network, station, latitude, longitude, elevation, start_date, channels)."""
    from faultline.functions.scalar import has_strong_motion, instrument_type, instrument_types

    codes = F.array_sort(F.array_distinct(F.col("channels.code")))
    stations = landed.select(
        "network", "station", "latitude", "longitude", "elevation", "start_date", F.array_join(codes, ",").alias("channel_codes"), instrument_types(codes).alias("instrument_types"), has_strong_motion(codes).alias("has_strong_motion")
    )
    c = landed.select("network", "station", F.explode("channels").alias("c")).select("network", "station", "c.*")
    return stations, c.withColumnRenamed("code", "channel").withColumn("instrument_type", instrument_type(F.col("channel")))


def enrich_sites(stations: DataFrame, lookup: DataFrame) -> DataFrame:
    """vs30_ms and nehrp_site_class from a landed lookup (station, vs30_ms); values that are no velocity are NULL."""
    from faultline.functions.scalar import site_class

    v = F.when(F.col("vs30_ms") > 0, F.col("vs30_ms"))
    return stations.drop("vs30_ms").join(lookup.select("station", v.alias("vs30_ms")), "station", "left").withColumn("nehrp_site_class", site_class(F.col("vs30_ms")))


def binary_traces(spark: SparkSession, path: str, decode: Callable[[bytes], Iterable[tuple]], glob: str = "*") -> DataFrame:
    """Trace rows of binary files; ``decode`` gives (channel, start in seconds, rate, samples). Files that fail have one row with an error."""
    import pandas as pd

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for name, content in zip(b.path, b.content, strict=True):
                try:
                    rows += [(name, c, pd.Timestamp(s, unit="s"), float(r), list(map(float, x)), None) for c, s, r, x in decode(bytes(content))]
                except Exception as e:  # a file that cannot be read is a row of the report
                    rows.append((name, None, None, None, None, type(e).__name__))
            yield pd.DataFrame(rows, columns=["file", "channel", "start_ts", "sampling_rate_hz", "samples", "error"])

    return files.mapInPandas(run, "file string, channel string, start_ts timestamp, sampling_rate_hz double, samples array<double>, error string")


def candidates_json(df: DataFrame, spark: SparkSession) -> str:
    """Rows (a bounded batch of requests) as the ``requests`` option."""
    return json.dumps([r.asDict() for r in df.collect()], default=str)
