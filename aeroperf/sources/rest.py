"""Paged REST tables as a Spark data source: one partition a month (or day), pages in a total order, filters sent along.

``fetch`` is the one thing that touches a network: a function of (base, table,
query parameters) to a list of records, given by name as ``module:function``.
Pages are cut from an order, and rows that the order leaves equal may come in
another order with every request: paging over them loses some and repeats
others. So more than one page needs an order that ends in a unique column:
``identity`` columns that follow the date, or an ``order`` of one's own.
"""

from __future__ import annotations

import importlib
import json
import os
import re
import time
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNull, LessThan, LessThanOrEqual, StringContains, StringStartsWith

#: Comparisons whose answer hangs on an order, which the server may see in another way.
ORDERED = (GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)

#: The operators of the query language and their filters; a number of rows that one page has.
OPERATORS = {EqualTo: "eq", GreaterThan: "gt", GreaterThanOrEqual: "gte", LessThan: "lt", LessThanOrEqual: "lte"}
PAGE_ROWS = 10_000
DATE_LIKE = re.compile(r"(^dt_|^dh|date|_time$|timestamp)", re.I)


@dataclass
class Window(InputPartition):
    """Half-open stretches of days that one task reads, one after the other."""

    spans: list[tuple[str, str]]

    def __init__(self, spans: list[tuple[str, str]]):
        self.spans, self.value = spans, tuple(spans)


def months(start: date, end: date) -> Iterator[tuple[date, date]]:
    """Half-open months that cover [start, end), cut to it."""
    at = start
    while at < end:
        after = min(end, date(at.year + at.month // 12, at.month % 12 + 1, 1))
        yield at, after
        at = after


def days(start: date, end: date) -> Iterator[tuple[date, date]]:
    at = start
    while at < end:
        yield at, at + timedelta(days=1)
        at += timedelta(days=1)


def http_fetch(base: str, table: str, params: dict[str, str]) -> list[dict]:
    """Records from ``base/table?params`` with an optional bearer token in ``$REST_TOKEN``."""
    from urllib.parse import urlencode
    from urllib.request import Request, urlopen

    head = {"Accept": "application/json"} | ({"Authorization": f"Bearer {os.environ['REST_TOKEN']}"} if os.environ.get("REST_TOKEN") else {})
    with urlopen(Request(f"{base}/{table}?{urlencode(params)}", headers=head), timeout=180) as r:
        return json.load(r)


def http_count(base: str, table: str, params: dict[str, str]) -> int:
    """Rows that the server says it has: a request for their exact count and none of them, answered in a header."""
    from urllib.parse import urlencode
    from urllib.request import Request, urlopen

    head = {"Prefer": "count=exact", "Range-Unit": "items", "Range": "0-0"} | ({"Authorization": f"Bearer {os.environ['REST_TOKEN']}"} if os.environ.get("REST_TOKEN") else {})
    with urlopen(Request(f"{base}/{table}?{urlencode(params)}", headers=head, method="HEAD"), timeout=180) as r:
        return int(r.headers["Content-Range"].rsplit("/", 1)[1])


def pages(fetch, base: str, table: str, params: dict[str, str], page_rows: int = PAGE_ROWS, tries: int = 4, wait_s: float = 2.0, total: bool = True) -> Iterator[list[dict]]:
    """Pages until an empty one; the offset moves by rows received, so a server's lower cap loses nothing.

    Unless the order is ``total``, a second page with rows raises ValueError.
    """
    at = 0
    while True:
        for left in range(tries - 1, -1, -1):
            try:
                got = fetch(base, table, params | {"offset": str(at), "limit": str(page_rows)})
                break
            except OSError:
                if not left:
                    raise
                time.sleep(wait_s * (tries - left))
        if not got:
            return
        if at and not total:
            raise ValueError(f"{table} has more than one page, and rows of equal {params.get('order', 'order')} may be lost or repeated between pages: name identity columns or a total order")
        yield got
        at += len(got)


class RestSource(DataSource):
    """``spark.read.format("rest").schema(...).options(base=, table=, column=, start=, end=, identity=, order=, fetch=, count=, grain=, tasks=, rename=, text=, stamps=)``.

    ``identity`` lists the columns that tell rows apart (see above); ``count``
    names a function like ``http_count``: each month or day is then compared
    with what the server counts, and one that differs raises ValueError.

    ``grain`` is month or day; ``tasks`` bounds how many requests run at a
    time (a task for each month or day, unless said). ``text`` lists columns
    that are plain text at the server, ``stamps`` those that hold ISO dates or
    times: only filters on these go along, the stamps' comparisons included.
    All others are Spark's, as a number or an array is not to a server what
    its text is to Spark.
    """

    @classmethod
    def name(cls) -> str:
        return "rest"

    def schema(self) -> T.StructType:
        """From the first rows, all strings; a schema of one's own saves the request."""
        got = next(pages(_named(self.options), self.options.get("base", ""), self.options["table"], {}, 5), [])
        return T.StructType([T.StructField(c, T.StringType()) for c in dict.fromkeys(k for r in got for k in r)])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return RestReader(schema, dict(self.options))

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return RestStreamReader(schema, dict(self.options))


def _named(options, what: str = "fetch"):
    module, _, name = options.get(what, "aeroperf.sources.rest:http_fetch").partition(":")
    return getattr(importlib.import_module(module), name)


def _ordered(options: dict) -> tuple[str, bool]:
    """(order to ask for, whether it is said to be total)."""
    listed = [c for c in options.get("identity", "").split(",") if c]
    if options.get("order"):
        return options["order"], True
    return total_order(options["column"], listed, listed), bool(listed)


def span_rows(options: dict, where: dict[str, str], start: str, end: str) -> Iterator[dict]:
    """The rows of a half-open stretch of days, in a total order; compared with the server's count, if one is asked for."""
    column, (order, total), n = options["column"], _ordered(options), 0
    asked = {"and": f"({column}.gte.{start},{column}.lt.{end})"} | where
    for got in pages(_named(options), options.get("base", ""), options["table"], asked | {"order": order}, int(options.get("pagerows", PAGE_ROWS)), int(options.get("tries", 4)), float(options.get("waits", 2.0)), total):
        n += len(got)
        yield from got
    if options.get("count"):
        said = _named(options, "count")(options.get("base", ""), options["table"], asked | {"select": column})
        if said != n:
            raise ValueError(f"{options['table']} from {start} to {end}: {n} rows came, the server counts {said}")


def text(value) -> str | None:
    """A JSON value as the text it is stored as: arrays joined by ``|``, empty ones null, objects as JSON."""
    if value is None or value == []:
        return None
    if isinstance(value, list) and not any(isinstance(x, (list, dict)) for x in value):
        return "|".join(map(str, value))
    return json.dumps(value) if isinstance(value, (list, dict)) else str(value).lower() if isinstance(value, bool) else str(value)


class RestReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.columns, self.options, self.where = [f.name for f in schema.fields], options, {}

    def pushFilters(self, filters):
        """Equalities, lists, prefixes and null tests on text columns go to the server, and comparisons on stamps; all others are Spark's."""
        back = {v: k for k, v in json.loads(self.options.get("rename", "{}")).items()}
        listed = lambda name: {c for c in self.options.get(name, "").split(",") if c}
        words, stamps = listed("text"), listed("stamps")
        plain = lambda v: isinstance(v, str) and "\\" not in v
        for f in filters:
            column = back.get(f.attribute[0], f.attribute[0]) if len(getattr(f, "attribute", ())) == 1 else None
            said = None
            if column in words | stamps:
                if type(f) in OPERATORS and plain(f.value) and (not isinstance(f, ORDERED) or column in stamps):
                    said = f"{OPERATORS[type(f)]}.{f.value}"
                elif isinstance(f, In) and f.value and all(map(plain, f.value)):
                    said = "in.({})".format(",".join('"' + v.replace('"', '\\"') + '"' for v in f.value))
                elif isinstance(f, (StringStartsWith, StringContains)) and plain(f.value):  # a wildcard in it lets more through
                    said = f"like.{'*' * isinstance(f, StringContains)}{f.value}*"
                elif isinstance(f, IsNull):
                    said = "is.null"
            if said and column not in self.where and column != self.options["column"]:
                self.where[column] = said
            yield f  # Spark checks again

    def partitions(self) -> list[InputPartition]:
        cut = days if self.options.get("grain", "month") == "day" else months
        spans = [(a.isoformat(), b.isoformat()) for a, b in cut(date.fromisoformat(self.options["start"]), date.fromisoformat(self.options["end"]))]
        tasks = min(len(spans), int(self.options.get("tasks", len(spans))))
        return [Window(spans[i * len(spans) // tasks : (i + 1) * len(spans) // tasks]) for i in range(tasks)]

    def read(self, partition: Window) -> Iterator[tuple]:
        rename = json.loads(self.options.get("rename", "{}"))
        for start, end in partition.spans:
            for row in span_rows(self.options, self.where, start, end):
                row = {rename.get(k, k): v for k, v in row.items()}
                yield tuple(text(row.get(c)) for c in self.columns)


class RestStreamReader(DataSourceStreamReader):
    """``spark.readStream.format("rest")``: days as they come, each again until it is closed.

    An offset says which day is the first still open, and until when was asked.
    A batch fetches all days that were open at its start, up to now: with
    ``open`` = 1 (the default) today, and, after midnight, yesterday once more.
    So the batch of an offset is always the same days, a batch that is run
    again loses nothing, and a sink that replaces days repeats nothing. The
    column ``_day`` of the schema, if there is one, gets the day, and ``_end`` is
    true for one more row at the end of each day, also of one without rows. A
    day that cannot be fetched fails the batch. ``clock`` names a function of
    ``base`` that says the time in ISO form.
    """

    def __init__(self, schema: T.StructType, options: dict):
        self.columns, self.options = [f.name for f in schema.fields], options

    def initialOffset(self) -> dict:
        return {"open": self.options["start"], "asked": ""}

    def latestOffset(self) -> dict:
        now = _named(self.options, "clock")(self.options.get("base", "")) if self.options.get("clock") else datetime.now(timezone.utc).isoformat()
        first = date.fromisoformat(now[:10]) - timedelta(days=int(self.options.get("open", "1")) - 1)
        return {"open": max(self.options["start"], first.isoformat()), "asked": now}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        first, last = date.fromisoformat(start["open"]), date.fromisoformat(end["asked"][:10])
        spans = [(a.isoformat(), b.isoformat()) for a, b in days(first, last + timedelta(days=1))]
        tasks = min(len(spans), int(self.options.get("tasks", len(spans))))
        return [Window(spans[i * len(spans) // tasks : (i + 1) * len(spans) // tasks]) for i in range(tasks)]

    def read(self, partition: Window) -> Iterator[tuple]:
        rename = json.loads(self.options.get("rename", "{}"))
        for start, end in partition.spans:
            for row in span_rows(self.options, {}, start, end):
                row = {rename.get(k, k): v for k, v in row.items()}
                yield tuple(start if c == "_day" else False if c == "_end" else text(row.get(c)) for c in self.columns)
            if "_end" in self.columns:
                yield tuple({"_day": start, "_end": True}.get(c) for c in self.columns)

    def commit(self, end: dict) -> None:
        pass


def tables(openapi: dict) -> list[str]:
    """Tables that a server's OpenAPI document lists."""
    return sorted(p.strip("/") for p in openapi.get("paths", {}) if p.strip("/") and not p.startswith("/rpc/"))


def date_columns(names: list[str]) -> list[str]:
    return [n for n in names if DATE_LIKE.search(n)]


def total_order(date_column: str, identity: list[str], columns: list[str]) -> str:
    """An order that no two rows share, if the identity columns do: paging over anything less loses and repeats rows."""
    return ",".join(dict.fromkeys([date_column, *[c for c in identity if c in columns]]))


def count_rows(base: str, table: str, column: str, start: str, end: str, count=http_count) -> int:
    """Rows of a half-open window as the server counts them; none of them is sent."""
    return count(base, table, {"and": f"({column}.gte.{start},{column}.lt.{end})", "select": column})


class Fetched(NamedTuple):
    """Fetched days, both read from the one table that they were written to."""

    rows: DataFrame
    days: DataFrame

    def discard(self) -> None:
        """Delete the table, once nothing reads it any more."""
        spark = self.rows.sparkSession
        for name in {f.rsplit("/", 1)[0] for f in self.rows.inputFiles()}:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def day_rows(options: dict, names: list[str], day: str) -> Iterator[tuple]:
    """(day, False, None, values) for each row of a day and (day, True, error, nulls) at its end; a day that fails has no rows."""
    after = (date.fromisoformat(day) + timedelta(days=1)).isoformat()
    rows, error = [], None
    try:
        rows = list(span_rows(options, {}, day, after))
    except (OSError, ValueError) as e:
        error = str(e)
    for r in rows:
        yield (day, False, None, *[text(r.get(c)) for c in names])
    yield (day, True, error, *[None] * len(names))


def fetched(marked: DataFrame) -> Fetched:
    """Rows of days, and a line for each day: day, n, status (ok, empty or failed), error."""
    if "_error" not in marked.columns:
        marked = marked.withColumn("_error", F.lit(None).cast("string"))
    status = F.when(F.max("_error").isNotNull(), "failed").when(F.count("*") == 1, "empty").otherwise("ok")
    lines = marked.groupBy(F.col("_day").alias("day")).agg((F.count("*") - 1).alias("n"), status.alias("status"), F.max("_error").alias("error"))
    return Fetched(marked.where("not _end").drop("_end", "_error"), lines)


def fetch_days(spark, wanted: list[date], base: str, table: str, column: str, schema: str, fetch: str = "aeroperf.sources.rest:http_fetch", tasks: int = 1, tries: int = 4, wait_s: float = 2.0, identity: tuple[str, ...] = (), count: str = "") -> Fetched:
    """(rows, days): the rows of each day with their _day, and one line a day: day, n, status (ok, empty or failed), error.

    A day that fails after ``tries`` has no rows and says so, so that it is
    told from one without traffic; the others go on. A day of more than one
    page fails without ``identity`` columns, and one whose rows are not as many
    as the server's ``count`` says. ``tasks`` bounds the requests that run at a
    time. What came is written once, and rows and lines are read from that.
    """
    from aeroperf.sinks.files import scratch

    names = [f.name for f in T.StructType.fromDDL(schema).fields]
    options = {"base": base, "table": table, "column": column, "fetch": fetch, "tries": str(tries), "waits": str(wait_s), "identity": ",".join(identity), "count": count}

    def run(batches):
        import pandas as pd

        for batch in batches:
            for day in batch["_day"]:
                yield pd.DataFrame(list(day_rows(options, names, day)), columns=["_day", "_end", "_error", *names], dtype=object)

    days_wanted = spark.createDataFrame([(d.isoformat(),) for d in wanted], "_day string").repartition(max(1, min(tasks, len(wanted) or 1)))
    path, kinds = scratch(spark, "fetched"), f"_day string, _end boolean, _error string, {schema}"
    days_wanted.mapInPandas(run, kinds).write.parquet(path)
    return fetched(spark.read.schema(kinds).parquet(path))
