"""From filings to landed documents: inventories, covers and selected documents, fetched on the driver in batches.

The client's limiter is the bottleneck, so a few threads keep it busy and no more requests
than threads are out at a time; every batch lands as Parquet before the next begins. What is
fetched is decided by ``operators.selection`` over what has landed.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlode.operators import selection
from ledgerlode.sources import http

log = logging.getLogger(__name__)

LANDED = "filing_id string, place int, name string, role string, content binary, problem string"
BATCH = 200
#: Place and role of what an inventory is made of.
INDEX, DETAIL = "index", "detail"
FALLBACK = "primary_missing_full_submission_fallback"


class Unselected(ValueError):
    """A document that its plan doesn't select."""


def fetch_document(candidate, client) -> http.Response:
    """The bytes of one selected document (a row with selected, status and url)."""
    if not candidate["selected"] or candidate["status"] != "required":
        raise Unselected("document is not selected for acquisition")
    return client.get(http.checked_url(candidate["url"]))


def in_flight(items: Iterable, work: Callable, workers: int = 4) -> Iterator:
    """``work`` of each item, as they end; never more than ``workers`` at a time, and no item is taken before."""
    if workers < 1:
        raise ValueError("workers must be at least 1")
    with ThreadPoolExecutor(workers) as pool:
        running = set()
        for item in items:
            running.add(pool.submit(work, item))
            if len(running) >= workers:
                done, running = wait(running, return_when=FIRST_COMPLETED)
                yield from (f.result() for f in done)
        yield from (f.result() for f in wait(running).done)


class Progress:
    """Counts and the time that is left, logged at every ``each`` items, every ``seconds`` and at the end."""

    def __init__(self, total: int, each: int = 100, seconds: float = 30, clock: Callable = time.monotonic, say: Callable = log.info):
        self.total, self.each, self.seconds, self.clock, self.say = total, each, seconds, clock, say
        self.done, self.began = 0, clock()
        self.last = self.began

    def step(self, name: str) -> None:
        self.done += 1
        now = self.clock()
        if self.done == self.total or self.done % self.each == 0 or now - self.last >= self.seconds:
            rate = self.done / max(now - self.began, 1e-9) * 3600
            self.say(f"{self.done}/{self.total} rate={rate:.1f}/hour eta={(self.total - self.done) / rate:.1f}h last={name}")
            self.last = now


def land(spark: SparkSession, rows: Iterable[list[tuple]], path: str, size: int = BATCH) -> DataFrame:
    """Appends rows of ``LANDED`` in batches and returns all that has landed."""
    held: list[tuple] = []
    spark.createDataFrame([], LANDED).write.mode("append").parquet(path)
    for some in rows:
        held += some
        if len(held) >= size:
            spark.createDataFrame(held, LANDED).write.mode("append").parquet(path)
            held = []
    if held:
        spark.createDataFrame(held, LANDED).write.mode("append").parquet(path)
    return spark.read.schema(LANDED).parquet(path)


def _directory(filing) -> str:
    return f"https://www.sec.gov/Archives/edgar/data/{int(filing['cik'])}/{filing['accession'].replace('-', '')}/"


def _get(client, url: str, *row) -> tuple:
    """One row of ``LANDED``; a failed request leaves its name and no content."""
    try:
        return (*row, client.get(http.checked_url(url)).body, None)
    except http.FetchError as e:
        return (*row, None, type(e).__name__)


def inventory_of(filing, client) -> list[tuple]:
    """The index and the detail page of a filing; none for one without a primary document."""
    if not filing["primary_document"]:
        return []
    base, key = _directory(filing), filing["filing_id"]
    return [_get(client, f"{base}index.json", key, 0, "index.json", INDEX), _get(client, f"{base}{filing['accession']}-index.html", key, 1, f"{filing['accession']}-index.html", DETAIL)]


def whole_submission(filing, client) -> tuple:
    name = f"{filing['accession']}.txt"
    return _get(client, _directory(filing) + name, filing["filing_id"], -1, name, "full_submission")


def primary_of(filing, client) -> list[tuple]:
    """The primary document, or the whole submission where there is none or it isn't there."""
    if not filing["primary_document"]:
        return [whole_submission(filing, client)]
    row = _get(client, filing["url"], filing["filing_id"], -1, filing["primary_document"], "primary")
    return [row, whole_submission(filing, client)] if row[-1] == "NotFound" else [row]


def directory_path() -> object:
    return F.regexp_replace(selection.directory_url(F.col("cik"), F.col("accession")), "^https://[^/]*", "")


def planned(filings: DataFrame, landed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(candidates, plans) from landed inventories; a filing whose inventory has a problem gets a plan that says so.

    filings: filing_id, cik, accession, form, primary_document; landed: ``LANDED``.
    """
    placed = landed.join(filings.select("filing_id", directory_path().alias("directory")), "filing_id")
    indexed = placed.where(F.col("role") == INDEX).select("filing_id", "directory", "content")
    items = selection.index_lists(indexed.where("content is not null"), ["filing_id"], "content", F.col("directory"))
    details = selection.detail_lists(placed.where((F.col("role") == DETAIL) & F.col("content").isNotNull()), ["filing_id"], "content", F.col("directory"))
    flaws = lambda rows, column, where: rows.select("filing_id", F.explode(F.filter(F.col(column)["problem"], lambda x: x.isNotNull())).alias("problem")).withColumn("problem", F.concat(F.lit(where), "problem"))
    flawed = flaws(items, "items", "index: ").union(flaws(details, "found", "detail: "))
    failed = landed.where(F.col("problem").isNotNull() & ((F.col("role") == INDEX) | (F.col("problem") != "NotFound")) & F.col("role").isin(INDEX, DETAIL)).select("filing_id", F.concat("role", F.lit(": "), "problem").alias("problem"))
    bad = flawed.union(failed).groupBy("filing_id").agg(F.min("problem").alias("problem"))
    good = filings.join(bad.select("filing_id"), "filing_id", "left_anti")
    sheet = selection.sheets(good, items, details)
    rows = selection.candidates(sheet)
    absent = landed.where((F.col("role") == DETAIL) & (F.col("problem") == "NotFound")).select("filing_id")
    plans = selection.plans(sheet, absent)
    none = F.array().cast("array<string>")
    broken = filings.join(bad, "filing_id").select("filing_id", "form", F.lit("failed").alias("status"), none.alias("reasons"), none.alias("selected"), "problem")
    return rows, plans.union(broken)


def acquire(spark: SparkSession, filings: DataFrame, client, root: str, workers: int = 4) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, plans, degraded) of filings, all landed under ``root``: inventories, primaries, then what the refined plans select.

    documents: filing_id, entity_id, filed_date, place, name, role, body, form; degraded:
    filing_id, reason of what a plan selects and couldn't be fetched.
    """
    total = filings.count()
    seen = Progress(total)

    def each(work):
        return lambda filing: work(filing, client)

    def counted(rows):
        for some in rows:
            seen.step(some[0][0] if some else "")
            yield some

    inventories = land(spark, counted(in_flight(filings.toLocalIterator(), each(inventory_of), workers)), f"{root}/inventories")
    rows, plans = planned(filings, inventories)
    rows.write.mode("overwrite").parquet(f"{root}/candidates")
    plans.write.mode("overwrite").parquet(f"{root}/plans")
    rows, plans = spark.read.parquet(f"{root}/candidates"), spark.read.parquet(f"{root}/plans")
    usable = filings.join(plans.where("problem is not null").select("filing_id"), "filing_id", "left_anti")
    firsts = usable.join(rows.where("is_primary").select("filing_id", "url"), "filing_id", "left")
    primaries = land(spark, in_flight(firsts.toLocalIterator(), each(primary_of), workers), f"{root}/primaries")
    covers = primaries.where("role = 'primary' and content is not null").join(filings.select("filing_id", directory_path().alias("directory"), "form"), "filing_id")
    open_plans = plans.where(F.col("form").isin("40-F", "40-F/A") | (F.col("status") != "selected_financial")).select("filing_id")
    tables = selection.cover_rows(covers.join(open_plans, "filing_id", "left_semi"), ["filing_id"], "content", F.col("directory"))
    plans, rows = selection.refine(plans, rows, tables)
    lost = primaries.where("role = 'full_submission'").select("filing_id").join(usable.where("primary_document is not null"), "filing_id", "left_semi").select("filing_id")
    wanted = selection.to_fetch(rows).where("role <> 'primary'")
    others = land(spark, in_flight(wanted.toLocalIterator(), lambda r: [_get(client, r["url"], r["filing_id"], r["place"], r["name"], r["role"])], workers), f"{root}/others")
    landed = primaries.where("content is not null").union(others.where("content is not null"))
    said = F.concat(F.lit("selected_document_fetch_failed:"), "name", F.lit(":"), "problem")
    degraded = lost.select("filing_id", F.lit(FALLBACK).alias("reason")).union(others.where("problem is not null").select("filing_id", said))
    about = filings.select("filing_id", F.col("cik").alias("entity_id"), F.to_date("filed_date").alias("filed_date"), "form")
    documents = landed.join(about, "filing_id").select("filing_id", "entity_id", "filed_date", "place", "name", "role", F.col("content").alias("body"), "form")
    return documents, plans, degraded
