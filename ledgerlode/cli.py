"""Command line: ``download``, ``scan``, ``build`` and ``validate``. Exit codes: 0 done, 1 flaws in the data, 2 wrong use."""

from __future__ import annotations

import argparse
import datetime
import json
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlode import config
from ledgerlode.operators import catalog, samples, validation
from ledgerlode.sources import fetch, http, ingest, universe

#: Folders that no output may overlap.
PROTECTED = ("data/raw", "data/baselines", "baselines", "archive")


def session() -> SparkSession:
    builder = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").config("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    return builder.getOrCreate()


def positive(value: str) -> int:
    if not value.isdigit() or int(value) < 1:
        raise argparse.ArgumentTypeError("value must be a positive integer")
    return int(value)


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="ledgerlode")
    commands = out.add_subparsers(dest="command", required=True)
    get = commands.add_parser("download", help="download raw provider data")
    get.add_argument("--stage", action="append", choices=[*ingest.STAGES, "all"])
    get.add_argument("--start", type=datetime.date.fromisoformat)
    get.add_argument("--end", type=datetime.date.fromisoformat)
    get.add_argument("--tickers")
    get.add_argument("--force", action="store_true")
    get.add_argument("--dry-run", action="store_true")
    get.add_argument("--config", default="config/sources.toml")
    get.add_argument("--secrets", default="config/secrets.toml")
    get.add_argument("--data-dir")
    scan = commands.add_parser("scan", help="list the filings of a cache")
    scan.add_argument("--cache-root", required=True)
    scan.add_argument("--form", action="append", choices=catalog.APPROVED_FORMS)
    scan.add_argument("--filing-id", action="append")
    scan.add_argument("--limit", type=positive)
    scan.add_argument("--out", required=True)
    build = commands.add_parser("build", help="publish samples of a cache's filings, or of landed documents")
    source = build.add_mutually_exclusive_group(required=True)
    source.add_argument("--documents", help="landed documents")
    source.add_argument("--cache-root", help="a cache of submission indexes; documents are fetched")
    build.add_argument("--out", required=True)
    build.add_argument("--work-dir")
    build.add_argument("--form", action="append", choices=catalog.APPROVED_FORMS)
    build.add_argument("--filing-id", action="append")
    build.add_argument("--limit", type=positive)
    build.add_argument("--workers", type=positive, default=4)
    build.add_argument("--resume", action="store_true")
    build.add_argument("--secrets", default="config/secrets.toml")
    check = commands.add_parser("validate", help="check a publication")
    check.add_argument("--out", required=True)
    return out


def chosen(spark: SparkSession, filings: DataFrame, ids: list[str] | None, limit: int | None, order: list[str]) -> DataFrame:
    """The filings of ``ids``, all of which must be there, and the first ``limit`` of them."""
    if ids:
        wanted = spark.createDataFrame([(x,) for x in dict.fromkeys(ids)], "filing_id string")
        unknown = [r[0] for r in wanted.join(filings, "filing_id", "left_anti").limit(5).collect()]
        if unknown:
            raise catalog.CatalogError(f"unknown filings: {', '.join(unknown)}")
        filings = filings.join(wanted, "filing_id", "left_semi")
    return filings if limit is None else filings.orderBy(*order).limit(limit)


def run_scan(spark: SparkSession, a) -> dict:
    found = catalog.scan_cached_filings(spark, a.cache_root, a.form or catalog.DEFAULT_FORMS)
    chosen(spark, found["filings"], a.filing_id, a.limit, ["cik", "accession"]).write.parquet(a.out)
    return {"filings": spark.read.parquet(a.out).count(), "skipped": found["skipped"].count(), "conflicts": found["conflicts"].count()}


def run_build(spark: SparkSession, a, client=None) -> dict:
    work = a.work_dir or f"{a.out}.work"
    validation.apart({"output": a.out, "work directory": work}, [*PROTECTED, *([a.cache_root] if a.cache_root else [])])
    fs, at = validation.hadoop(spark, a.out)
    if fs.exists(at) and len(fs.listStatus(at)) and not a.resume:
        raise validation.SampleError("output path must be absent or empty")
    plans = degraded = filings = None
    if a.documents:
        documents = spark.read.parquet(a.documents)
        documents = documents.join(chosen(spark, documents.select("filing_id").distinct(), a.filing_id, a.limit, ["filing_id"]), "filing_id", "left_semi")
    else:
        found = catalog.scan_cached_filings(spark, a.cache_root, a.form or catalog.DEFAULT_FORMS)["filings"]
        filings = chosen(spark, found, a.filing_id, a.limit, ["cik", "accession"])
        client = client or http.Client(config.load_secrets(Path(a.secrets), "sec_user_agent")["sec_user_agent"])
        landing = f"{work}.landing"
        fetched, where = validation.hadoop(spark, landing)
        if not a.resume:
            fetched.delete(where, True)
        documents, plans, degraded = fetch.acquire(spark, filings, client, f"{landing}/{int(time.time())}", a.workers)
    return samples.build_and_publish(spark, documents, a.out, work, a.resume, plans, degraded, filings)


def run_validate(spark: SparkSession, a) -> dict:
    ids = spark.read.json(f"{a.out}/identities").select(F.col("id").cast("string"))
    return validation.validate_samples(validation.read_samples(spark, f"{a.out}/samples"), validation.read_diagnostics(spark, f"{a.out}/diagnostics"), ids)


def run_download(a, get=None, bars=ingest.yahoo, spark: SparkSession | None = None) -> int:
    """0, or 1 where an item failed. get: bytes of a URL; without it, a paced client."""
    stages = [s for s in ingest.STAGES if not a.stage or "all" in a.stage or s in a.stage]
    if "market" in stages and (a.start is None or a.end is None):
        raise config.ConfigError("the market stage needs --start and --end")
    settings = config.load_settings(Path(a.config), Path(a.data_dir) if a.data_dir else None)
    names = [x.strip().upper() for x in a.tickers.split(",") if x.strip()] if a.tickers else None
    if a.dry_run:
        print(json.dumps({"stages": stages, "tickers": names}))
        return 0
    raw = settings.data_dir / "raw"
    secrets = config.load_secrets(Path(a.secrets), "fred_api_key", "sec_user_agent") if stages != ["market"] or names is None else {}
    if get is None and secrets:
        client = http.Client(secrets["sec_user_agent"])
        get = lambda url: client.get(url).body
    tickers: dict[str, str | None] = dict.fromkeys(names or [])
    if "financials" in stages or names is None:
        spark = spark or session()
        root = str(raw / "sec" / "universe")
        listed = lambda data: universe.listed(universe.rows(spark.createDataFrame([(data,)], "content binary")), list(settings.exchanges)).limit(1).count() > 0
        if not any(Path(root).glob("*.json")):
            universe.fetch(root, settings.universe_url, get, listed)
        rows = universe.listed(universe.rows(universe.snapshots(spark, root)), list(settings.exchanges))
        known = {r.ticker: r.cik10 for r in rows.collect()}  # the list of issuers, a few thousand
        tickers = {t: known[t] for t in (names or sorted(known)) if t in known}
    with ingest.Cache(raw / "sec" / "financials") as filed, ingest.Cache(raw / "fred") as series:

        def market(ticker: str) -> None:
            if ingest.fetch_bars(ticker, a.start, a.end, raw, bars) is None:
                raise ingest.IngestError("empty or failed download")

        def macro(name: str) -> None:
            base = settings.macros.options.get("base_url", "https://api.stlouisfed.org/fred/series/observations")
            failed = ingest.fetch_macros(series, [name], base, secrets["fred_api_key"], get)
            if failed[name]:
                raise ingest.IngestError(failed[name])

        work = {"market": market, "financials": lambda t: ingest.fetch_financials(filed, tickers[t], get), "macros": macro}
        return 1 if ingest.download(settings, stages, tickers, settings.data_dir / ".download_progress", work, a.force) else 0


def main(args: list[str] | None = None) -> int:
    out = parser()
    try:
        a = out.parse_args(args)
        if a.command == "download" and a.start and a.end and a.end < a.start:
            out.error("--end must be on or after --start")
    except SystemExit as e:
        return int(e.code or 0)
    try:
        if a.command == "download":
            return run_download(a)
        result = {"scan": run_scan, "build": run_build, "validate": run_validate}[a.command](session(), a)
    except (catalog.CatalogError, validation.SampleError, config.ConfigError, ingest.IngestError, http.FetchError, OSError) as e:
        print(e, file=sys.stderr)
        return 1
    print(json.dumps(result, sort_keys=True))
    return 0


if __name__ == "__main__":
    sys.exit(main())
