"""Raw payloads into a content-addressed cache: daily bars, company facts with submission indexes, macro series.

Fetching is paced by one limiter, so it runs on the driver, item by item; what Spark does is
to find what is missing (``missing``) and to read what has landed (``catalog``). Each item's
record is written as soon as its bytes are, so a failure loses nothing that was fetched.
"""

from __future__ import annotations

import hashlib
import json
import os
import tempfile
import time
from collections.abc import Callable, Iterable
from datetime import date, datetime, timedelta, timezone
from pathlib import Path
from urllib.parse import urlencode

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlode.sources import progress

HOST = "https://data.sec.gov"


class IngestError(Exception):
    """Items that couldn't be fetched."""


class Cache:
    """``<sha256>.json`` files under a root and a manifest of versions by logical key."""

    def __init__(self, root: Path):
        self.root = Path(root)
        self.root.mkdir(parents=True, exist_ok=True)

        self._held: dict[str, list[dict]] | None = None

    def _manifest(self) -> Path:
        return self.root / "manifest.json"

    def _log(self) -> Path:
        """Versions since the manifest was last written, one a line, so that a put doesn't write all of it again."""
        return self.root / "manifest.log"

    def manifest(self) -> dict[str, list[dict]]:
        """Versions by key, from either layout, with those of the log after them; read once."""
        if self._held is None:
            held = progress.load(self._manifest()).get("resources", {})
            flat = held if isinstance(held, list) else [{"logical_key": k, **v} for k, vs in held.items() for v in (vs if isinstance(vs, list) else [vs]) if isinstance(v, dict)]
            if self._log().exists():
                flat += [json.loads(x) for x in self._log().read_text(encoding="utf-8").splitlines() if x.endswith("}")]  # a line cut short was never said to be done
            self._held = {}
            for r in flat:
                if isinstance(r, dict) and isinstance(r.get("logical_key"), str):
                    self._held.setdefault(r["logical_key"], []).append({k: v for k, v in r.items() if k != "logical_key"})
        return self._held

    def close(self) -> None:
        """Writes the manifest whole and drops the log; readers see all versions then."""
        if self._log().exists():
            progress.save(self._manifest(), {"resources": self.manifest()})
            self._log().unlink()

    def __enter__(self) -> Cache:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def hit(self, key: str, url: str) -> bytes | None:
        """The bytes of the latest version, if it is of this URL and they are as recorded."""
        versions = self.manifest().get(key) or [{}]
        last = versions[-1]
        if last.get("url") != url or not last.get("path"):
            return None
        path = self.root / last["path"]
        data = path.read_bytes() if path.is_file() else b""
        return data if hashlib.sha256(data).hexdigest() == last.get("sha256") else None

    def put(self, key: str, url: str, data: bytes, attempts: int = 1) -> dict:
        """Writes the bytes once and appends a version to the manifest."""
        digest = hashlib.sha256(data).hexdigest()
        path = self.root / f"{digest}.json"
        if not path.exists():
            handle, name = tempfile.mkstemp(dir=self.root)
            with os.fdopen(handle, "wb") as f:
                f.write(data)
            os.replace(name, path)
        record = {"path": path.name, "sha256": digest, "byte_size": len(data), "url": url, "status": "done", "attempts": attempts, "fetched_at_utc": datetime.now(timezone.utc).isoformat()}
        self.manifest().setdefault(key, []).append(record)
        with open(self._log(), "a", encoding="utf-8") as f:
            f.write(json.dumps({"logical_key": key} | record, sort_keys=True) + "\n")
            f.flush()
            os.fsync(f.fileno())
        return record


Fetch = Callable[[str], bytes]


def _cached(cache: Cache, key: str, shown: str, url: str, fetch: Fetch) -> bytes:
    data = cache.hit(key, shown)
    if data is None:
        data = fetch(url)
        json.loads(data)  # what isn't JSON isn't kept
        cache.put(key, shown, data)
    return data


def fetch_financials(cache: Cache, cik10: str, fetch: Fetch) -> list[str]:
    """Facts, the submission index and every page it names; the keys of all that is there then."""
    keys = [f"companyfacts:{cik10}", f"submissions:{cik10}"]
    _cached(cache, keys[0], u := f"{HOST}/api/xbrl/companyfacts/CIK{cik10}.json", u, fetch)
    index = json.loads(_cached(cache, keys[1], u := f"{HOST}/submissions/CIK{cik10}.json", u, fetch))
    for page in dict.fromkeys(f.get("name") for f in index.get("filings", {}).get("files", []) if f.get("name")):
        if "/" in page or page.startswith("."):
            raise IngestError(f"page name {page!r}")
        keys.append(f"submissions-page:{cik10}:{page}")
        _cached(cache, keys[-1], u := f"{HOST}/submissions/{page}", u, fetch)
    return keys


def fetch_macros(cache: Cache, series: Iterable[str], base: str, api_key: str, fetch: Fetch) -> dict[str, str | None]:
    """Observations of each series; None or what went wrong. The key is never stored."""
    out: dict[str, str | None] = {}
    for s in dict.fromkeys(series):
        shown = f"{base}?{urlencode({'series_id': s, 'file_type': 'json'})}"
        try:
            _cached(cache, f"macro:{s}", shown, f"{shown}&{urlencode({'api_key': api_key})}", fetch)
            out[s] = None
        except Exception as e:  # noqa: BLE001  one series doesn't stop the others
            out[s] = type(e).__name__
    return out


def bar_range(start: date, end: date) -> tuple[date, date]:
    """The range to ask for: the end that a user names is part of it."""
    if end < start:
        raise IngestError("the end is before the start")
    return start, end + timedelta(days=1)


class MissingLibrary(IngestError):
    """A provider's library isn't installed."""


def yahoo(ticker: str, start: date, end: date):
    """Daily bars of a ticker from ``start`` up to, not with, ``end``: a pandas table by date."""
    try:
        import yfinance
    except ImportError as e:
        raise MissingLibrary("the yfinance library is needed for daily bars") from e
    bars = yfinance.download(ticker, start=start.isoformat(), end=end.isoformat(), interval="1d", auto_adjust=False, actions=True, threads=False, progress=False)
    if getattr(bars.columns, "nlevels", 1) > 1:
        bars.columns = [str(c[0]) for c in bars.columns]
    return bars


def fetch_bars(ticker: str, start: date, end: date, root: Path, source: Callable = yahoo, retries: int = 3, sleep: Callable = time.sleep) -> Path | None:
    """Writes a ticker's bars of the range as CSV and returns where; None if there are none or every try failed.

    A missing library raises, as no other ticker would fare better.
    """
    first, last = bar_range(start, end)
    path = Path(root) / "yahoo" / ticker.upper() / f"{start.isoformat()}_{end.isoformat()}.csv"
    for attempt in range(max(1, retries)):
        try:
            bars = source(ticker, first, last)
            break
        except MissingLibrary:
            raise
        except Exception:  # noqa: BLE001  whatever the provider raises, the next try may do
            if attempt + 1 < max(1, retries):
                sleep(min(2**attempt, 8))
    else:
        return None
    if bars is None or bars.empty:
        return None
    bars.index.name = "date"
    path.parent.mkdir(parents=True, exist_ok=True)
    bars.to_csv(path, index=True)
    return path


def read_bars(spark: SparkSession, root: str) -> DataFrame:
    """(ticker, date, Open, High, Low, Close, Adj Close, Volume, Dividends, Stock Splits) of all landed CSV files."""
    names = ("Open", "High", "Low", "Close", "Adj Close", "Volume", "Dividends", "Stock Splits")
    files = spark.read.option("header", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").csv(root)
    ticker = F.regexp_extract(F.input_file_name(), r"/yahoo/([^/]+)/[^/]*$", 1)
    value = lambda n: (F.col(f"`{n}`").cast("double") if n in files.columns else F.lit(None).cast("double")).alias(n)
    return files.select(ticker.alias("ticker"), F.to_date(F.substring("date", 1, 10)).alias("date"), *(value(n) for n in names))


def write_bars(bars: DataFrame, path: str) -> None:
    """Bars (ticker, date, ...) as CSV with a header, a folder for each ticker, by date."""
    bars.repartition("ticker").sortWithinPartitions("ticker", "date").write.option("header", True).partitionBy("ticker").mode("overwrite").csv(path)


def missing(wanted: DataFrame, records: DataFrame) -> DataFrame:
    """``wanted`` (logical_key, url) without a latest record of the same URL that is done."""
    last = records.groupBy("logical_key").agg(F.max_by("record", "version").alias("r"))
    good = last.where(F.coalesce("r.status", F.lit("done")) == "done").select("logical_key", F.col("r.url").alias("url"))
    return wanted.join(good, ["logical_key", "url"], "left_anti")


def run(stage: str, items: list[str], state_path: Path, work: Callable[[str], None], force: bool = False) -> list[str]:
    """Does what is pending of ``items`` and returns those that failed; every item's result is saved at once."""
    with progress.Lock(state_path.with_suffix(".lock")):
        state = progress.initialize(state_path, stage, items, force)
        failed = []
        for item in progress.pending(state, stage, items):
            try:
                work(item)
            except Exception as e:  # noqa: BLE001  the next run tries this item again
                failed.append(item)
                progress.mark(state_path, state, stage, item, type(e).__name__)
            else:
                progress.mark(state_path, state, stage, item)
        return failed


STAGES = ("market", "financials", "macros")


def download(settings, stages: list[str], tickers: dict[str, str | None], state_path: Path, work: dict[str, Callable[[str], object]], force: bool = False) -> int:
    """Runs the stages over their items and returns the number of failures.

    tickers: each one's CIK; work: what each stage does with an item (a ticker or a series).
    """
    failed = 0
    for stage in STAGES:
        if stage in stages:
            items = list(settings.macros.options.get("series", [])) if stage == "macros" else list(tickers)
            failed += len(run(stage, items, state_path, work[stage], force))
    return failed
