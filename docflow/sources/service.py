"""The literature service as Spark sources.

``spark.read.format("literature")`` deals the pages of a search's cursor to as many partitions as option ``tasks`` says (4), however
many pages there are. The rate limit is the service's, for all tasks together: a task has one client for all its pages, and each
task has start slots of its own (client.SlotLimiter), so that starts are apart over the whole cluster, with retries and after a
task's second attempt, too.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import UTC, date, datetime, timedelta

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..config import Config, Search
from . import client as service

TASKS = 4


class Pages(InputPartition):
    """Every ``of``-th page from ``own`` on, of one cursor or, without one, with a cursor each."""

    def __init__(self, own: int, of: int, places: list[tuple], cursor: service.Cursor | None) -> None:
        super().__init__(own)
        self.own, self.of, self.places, self.cursor = own, of, places, cursor


def tasks_of(options: dict[str, str]) -> int:
    return max(1, int(options.get("tasks", TASKS)))


def connect(options: dict[str, str], own: int = 0, of: int = 1) -> service.Client:
    """A client by options: tool, email, api_key, timeout, retries, rate, url, and folder for answers from files. own and of are those of SlotLimiter."""
    tool, email, key, retries = options.get("tool", "docflow"), options.get("email", ""), options.get("api_key"), int(options.get("retries", "5"))
    if folder := options.get("folder"):
        return service.Client(tool, email or "offline", service.folder_transport(folder), max_retries=0, limiter=service.Unlimited())
    rate = float(options.get("rate") or (service.RATE_WITH_KEY if key else service.RATE))
    transport = service.http_transport(float(options.get("timeout", "30")), f"{tool} (mailto:{email})", options.get("url", service.BASE_URL))
    return service.Client(tool, email, transport, key, retries, limiter=service.SlotLimiter(rate, own, of))


class Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.options = {**options}

    def partitions(self) -> list[Pages]:
        wanted = Search(query=self.options["query"], extra_filter=self.options.get("filter"), max_results=int(self.options.get("max_results", "200")), mindate=self.options.get("mindate"), maxdate=self.options.get("maxdate"))
        of = tasks_of(self.options)
        cursor = service.search(connect(self.options, 0, of), wanted)  # before there are tasks, in the first one's slots
        places = list(service.pages(len(cursor.pmids), int(self.options.get("batch_size", "100"))))
        return [Pages(own, of, places[own::of], cursor) for own in range(of)]

    def read(self, partition: Pages) -> Iterator[tuple]:
        client = connect(self.options, partition.own, partition.of)
        for start, count in partition.places:
            yield start, service.fetch_records(client, partition.cursor, start, count)


class HitStream(DataSourceStreamReader):
    """New hits, day by day: an offset is the last day of publication whose hits have been taken.

    A trigger takes the days after that up to yesterday (or option ``until``), as days that are over get no more hits; the same two offsets
    always ask for the same days, so a batch that is run again has the same pages. Days with more hits together than a search gives
    (option ``max_results``) are asked for in halves; one day with more is an error. Option ``since`` is the first day.
    """

    def __init__(self, options: dict[str, str]) -> None:
        self.options = {**options}

    def initialOffset(self) -> dict:
        return {"day": (date.fromisoformat(self.options["since"]) - timedelta(1)).isoformat()}

    def latestOffset(self) -> dict:
        return {"day": self.options.get("until") or (datetime.now(UTC).date() - timedelta(1)).isoformat()}

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        of = tasks_of(self.options)
        client, first, last = connect(self.options, 0, of), date.fromisoformat(start["day"]) + timedelta(1), date.fromisoformat(end["day"])
        places = [place for window in self._windows(client, first, last) for place in window]
        # A page is dealt with its own window's cursor; its number has the window's first day before its place in the cursor.
        return [Pages(own, of, places[own::of], None) for own in range(of)]

    def _windows(self, client: service.Client, first: date, last: date) -> Iterator[list[tuple]]:
        if first > last:
            return
        wanted = Search(
            query=self.options["query"], extra_filter=self.options.get("filter"), max_results=int(self.options.get("max_results", "200")),
            mindate=f"{first:%Y/%m/%d}", maxdate=f"{last:%Y/%m/%d}",
        )
        cursor = service.search(client, wanted)
        if cursor.count > len(cursor.pmids) >= wanted.max_results:
            if first == last:
                raise service.ServiceError(f"{cursor.count} hits on {first}, {wanted.max_results} at most")
            middle = first + (last - first) // 2
            yield from self._windows(client, first, middle)
            yield from self._windows(client, middle + timedelta(1), last)
        else:
            yield [((first.toordinal() << 24) + start, start, count, cursor) for start, count in service.pages(len(cursor.pmids), int(self.options.get("batch_size", "100")))]

    def read(self, partition: Pages) -> Iterator[tuple]:
        client = connect(self.options, partition.own, partition.of)
        for page, start, count, cursor in partition.places:
            yield page, service.fetch_records(client, cursor, start, count)

    def commit(self, end: dict) -> None:
        return


class LiteratureSource(DataSource):
    """Rows (page, xml): a page's first position in the cursor and its XML; as a stream, pages of new days."""

    @classmethod
    def name(cls) -> str:
        return "literature"

    def schema(self) -> str:
        return "page long, xml binary"

    def reader(self, schema) -> Reader:
        return Reader(dict(self.options))

    def streamReader(self, schema) -> HitStream:
        return HitStream(dict(self.options))


def _given(config: Config, options: dict[str, str]) -> dict[str, str]:
    return {
        "query": config.search.query, "max_results": str(config.search.max_results), "batch_size": str(config.ncbi.batch_size), "tool": config.ncbi.tool, "email": config.ncbi.email,
        "timeout": str(config.ncbi.timeout_s), "retries": str(config.ncbi.max_retries), **({"filter": config.search.extra_filter} if config.search.extra_filter else {}), **options,
    }


def search_pages(spark: SparkSession, config: Config, **options: str) -> DataFrame:
    spark.dataSource.register(LiteratureSource)
    return spark.read.format("literature").options(**_given(config, options)).load()


def stream_pages(spark: SparkSession, config: Config, since: str, **options: str) -> DataFrame:
    """A stream of the pages of hits from day ``since`` on (YYYY-MM-DD), for streaming.arrivals."""
    spark.dataSource.register(LiteratureSource)
    return spark.readStream.format("literature").options(**_given(config, {"since": since, **options})).load()


def article_pages(survivors: DataFrame, batch_size: int = 100, **options: str) -> DataFrame:
    """survivors(pmcid) -> (page, xml), a keyed fetch for each batch of ids, by option ``tasks`` (4) tasks that share the service's rate."""
    of = tasks_of(options)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, held, client = TaskContext.get().partitionId(), [], None
        page = own << 32
        for batch in batches:
            client = client or connect(options, own, of)
            held += batch["pmcid"].tolist()
            while len(held) >= batch_size:
                yield pd.DataFrame({"page": [page], "xml": [service.fetch_articles(client, held[:batch_size])]})
                page, held = page + 1, held[batch_size:]
        if held:
            yield pd.DataFrame({"page": [page], "xml": [service.fetch_articles(client, held)]})

    # A partition by number, and not by hash of the id: there are exactly as many tasks as slots are shared by.
    return survivors.select("pmcid").distinct().repartitionByRange(of, F.xxhash64("pmcid")).mapInPandas(run, "page long, xml binary")
