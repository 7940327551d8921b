"""The list of issuers: cached snapshots, checked rows, exchange filter, and tickers resolved by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def snapshots(spark: SparkSession, root: str) -> DataFrame:
    """(path, content) of cached snapshots whose file name is the sha256 of their bytes."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(root)
    name = F.regexp_extract("path", r"([0-9a-f]{64})\.json$", 1)
    return files.where(F.sha2("content", 256) == name).select("path", "content")


def rows(snapshot: DataFrame, content: str = "content") -> DataFrame:
    """(ticker, cik10, exchange, company_name) from a header and data; short rows and ids that aren't numbers are dropped."""
    schema = "fields array<string>, data array<array<string>>"
    p = snapshot.select(F.from_json(F.col(content).cast("string"), schema).alias("p")).select("p.fields", F.explode("p.data").alias("r"))
    names = F.transform("fields", lambda x: F.lower(F.trim(x)))
    value = lambda *n: F.coalesce(*(F.try_element_at("r", F.nullif(F.array_position(names, k), F.lit(0)).cast("int")) for k in n))
    whole = p.where(F.size("r") >= F.size("fields"))
    found = whole.select(F.upper(F.trim(value("ticker"))).alias("ticker"), F.lpad(value("cik").try_cast("long").cast("string"), 10, "0").alias("cik10"), F.trim(value("exchange")).alias("exchange"), F.trim(value("name", "title")).alias("company_name"))
    return found.where("cik10 is not null and ticker <> ''")


def listed(universe: DataFrame, exchanges: list[str]) -> DataFrame:
    """Issuers on the named exchanges, whatever the letters' case."""
    return universe.where(F.lower("exchange").isin([x.lower() for x in exchanges]))


def overrides(spark: SparkSession, path: str) -> DataFrame:
    """(ticker, cik10) of the object under ``overrides`` in a JSON file, or of the file itself; a broken file has none."""
    raw = spark.read.text(path, wholetext=True)
    held = F.coalesce(F.from_json("value", "overrides map<string,string>")["overrides"], F.from_json("value", "map<string,string>"))
    pairs = raw.select(F.explode(held).alias("ticker", "cik")).select(F.upper(F.trim("ticker")).alias("ticker"), F.trim("cik").alias("cik"))
    return pairs.where(F.col("cik").rlike("^[0-9]{1,10}$") & (F.col("ticker") != "")).select("ticker", F.lpad("cik", 10, "0").alias("cik10"))


def with_overrides(universe: DataFrame, own: DataFrame) -> DataFrame:
    own = own.withColumnRenamed("cik10", "_own")
    return universe.join(own, "ticker", "left").withColumn("cik10", F.coalesce("_own", "cik10")).drop("_own")


def resolve(universe: DataFrame, tickers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The issuers of ``tickers``, and the tickers that nobody has."""
    asked = tickers.select(F.upper(F.trim("ticker")).alias("ticker")).distinct()
    return asked.join(universe, "ticker"), asked.join(universe, "ticker", "left_anti")


def corrected(mapping: DataFrame, own: DataFrame) -> DataFrame:
    """(ticker, cik10) of a mapping with ``own`` corrections; a CIK that only a corrected ticker had leads to that ticker no more.

    Each CIK keeps one ticker: that of a correction where there is one.
    """
    kept = mapping.join(own.select("ticker"), "ticker", "left_anti").join(own.select("cik10"), "cik10", "left_anti")
    return kept.select("ticker", "cik10").union(own.select("ticker", "cik10"))


def fetch(root: str, url: str, get, check) -> str:
    """Fetches the list, asks ``check`` of its bytes whether it holds any issuer, and keeps it under its hash."""
    import hashlib
    from pathlib import Path

    data = get(url)
    if not check(data):
        raise ValueError("the list has no issuer of the exchanges asked for")
    path = Path(root) / f"{hashlib.sha256(data).hexdigest()}.json"
    path.parent.mkdir(parents=True, exist_ok=True)
    if not path.exists():
        path.write_bytes(data)
    return str(path)
