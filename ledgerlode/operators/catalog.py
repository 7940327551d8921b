"""Filing catalogs: cached submission indexes to one row for each filing.

Everything is DataFrame operations: manifests and payloads are parsed from JSON by
declared schemas, parallel arrays unnested after a check of their lengths, versions and
conflicts settled by aggregation, and the next trading session found by an ordered pass
over the calendar, whose rows are days.
"""

from __future__ import annotations

import datetime
import hashlib
import json
import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlode.functions import dates, identity

#: The forms that can be catalogued, and those taken by default.
APPROVED_FORMS = ("10-K", "10-K/A", "10-Q", "10-Q/A", "20-F", "20-F/A", "40-F", "40-F/A", "6-K")
DEFAULT_FORMS = APPROVED_FORMS[:-1]
#: The columns of a submission index that filings are made of, and its other columns.
FIELDS = ("accessionNumber", "filingDate", "reportDate", "acceptanceDateTime", "form", "primaryDocument")
OTHER_FIELDS = ("act", "fileNumber", "filmNumber", "items", "core_type", "size", "isXBRL", "isInlineXBRL", "primaryDocDescription")
MERGED = ("form", "filed_date", "report_date", "primary_document")
#: Where cached files lie by their manifest's older paths, the URLs they come from, and the names of pages.
CACHE_PREFIX = "data/raw/sec/financials/"
SUBMISSIONS_URL = "https://data.sec.gov/submissions/"
PAGE_NAME = r"CIK([0-9]{10})-submissions-([0-9]+)\.json"
#: The ledger's columns.
LEDGER = (
    "filing_id",
    "cik10",
    "accession_number",
    "form",
    "filed_date",
    "report_period_end",
    "acceptance_datetime_raw",
    "acceptance_datetime_utc",
    "effective_visible_session",
    "is_amendment",
    "parent_filing_id",
    "parent_link_source",
    "primary_document_name",
    "scope_status",
    "scope_evidence_json",
    "inventory_status",
    "raw_coverage_status",
    "source_submission_logical_key",
    "source_submission_sha256",
    "source_submission_path",
    "source_submission_locator",
)

_ARRAYS = "struct<" + ",".join(f"{f}:array<string>" for f in FIELDS + OTHER_FIELDS) + ">"
PAYLOAD = "cik string, filings struct<recent:" + _ARRAYS + ",files:array<struct<name:string>>>, fields array<string>, data array<array<string>>, " + ", ".join(f"{f} array<string>" for f in FIELDS + OTHER_FIELDS)
RECORD = "struct<logical_key:string,path:string,sha256:string,byte_size:bigint,url:string,status:string,fetched_at_utc:string,attempts:int>"


class CatalogError(ValueError):
    """An input that the strict reading doesn't accept."""


class ConflictError(CatalogError):
    """Records of one filing whose known values differ."""


def checked_forms(forms) -> tuple[str, ...]:
    if isinstance(forms, str) or not set(forms) <= set(APPROVED_FORMS):
        raise CatalogError(f"forms must be some of {', '.join(APPROVED_FORMS)}")
    return tuple(forms)


def coalesce_rows(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """One row for each key: each column's only present value, or null and conflict where some column has two."""
    held = [identity.missing(F.col(v)) for v in values]
    grouped = rows.groupBy(*keys).agg(F.count("*").alias("n_rows"), *(F.min(h).alias(f"_min_{v}") for v, h in zip(values, held, strict=True)), *(F.max(h).alias(v) for v, h in zip(values, held, strict=True)))
    conflict = F.lit(False)
    for v in values:
        conflict = conflict | F.coalesce(F.col(f"_min_{v}") != F.col(v), F.lit(False))
    marked = grouped.withColumn("conflict", conflict)
    return marked.select(*keys, "n_rows", *(F.when(~F.col("conflict"), F.col(v)).alias(v) for v in values), "conflict")


def latest(rows: DataFrame, keys: list[str], order: str, values: list[str]) -> DataFrame:
    """The row of largest ``order`` for each key; combined before the shuffle."""
    best = F.max_by(F.struct(*values), F.col(order)).alias("best")
    return rows.groupBy(*keys).agg(F.max(order).alias(order), best).select(*keys, order, "best.*")


def pending(rows: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(done, keys, "left_anti")


def next_session(rows: DataFrame, sessions: DataFrame, filed: str, strict: bool = False) -> DataFrame:
    """``rows`` with session: the first of ``sessions`` after ``filed``.

    Only days are compared: the distinct filing days and the sessions go through one
    ordered pass, so its size is that of the calendar, and the result joins by day.
    With ``strict``, a day before the first session or without a later one is an error.
    """
    days = rows.select(F.col(filed).alias("_day")).where(F.col(filed).isNotNull()).distinct().withColumn("_session", F.lit(None).cast("date"))
    both = days.union(sessions.select("session", "session").distinct())
    ordered = Window.orderBy("_day").rangeBetween(1, Window.unboundedFollowing)
    before = Window.orderBy("_day").rangeBetween(Window.unboundedPreceding, 0)
    number = F.datediff("_day", F.lit("1970-01-01"))
    both = both.withColumn("_day_date", F.col("_day")).withColumn("_day", number)
    found = both.select("_day_date", F.min("_session").over(ordered).alias("session"), F.max("_session").over(before).alias("_earlier")).groupBy("_day_date").agg(F.min("session").alias("session"), F.max("_earlier").alias("_earlier"))
    out = rows.join(found, F.col(filed) == F.col("_day_date"), "left")
    if strict:
        bad = F.col(filed).isNotNull() & (F.col("session").isNull() | F.col("_earlier").isNull())
        out = out.withColumn("session", F.when(bad, F.raise_error(F.concat(F.lit("no session around "), F.col(filed).cast("string"))).cast("date")).otherwise(F.col("session")))
    return out.select(*rows.columns, "session")


def increasing(sessions: DataFrame, order: str) -> DataFrame:
    """The sessions that aren't later than the one before them in ``order``; none if the calendar is sound."""
    before = F.lag("session").over(Window.orderBy(order))
    return sessions.withColumn("_before", before).where(F.col("_before") >= F.col("session")).select(*sessions.columns)


def unnest_parallel(rows: DataFrame, keys: list[str], arrays: list[str], strict: bool = True) -> DataFrame:
    """One row for each place of parallel arrays. Ragged arrays raise, or with ``strict`` off give no rows."""
    same = F.lit(True)
    for a in arrays[1:]:
        same = same & F.size(arrays[0]).eqNullSafe(F.size(a))
    zipped = F.arrays_zip(*arrays)
    if strict:
        zipped = F.when(same, zipped).otherwise(F.raise_error(F.lit("arrays differ in length")).cast("array<struct<" + ",".join(f"`{a}`:{rows.schema[a].dataType.elementType.simpleString()}" for a in arrays) + ">>"))
    else:
        rows = rows.where(same)
    return rows.select(*keys, F.posexplode(zipped).alias("place", "_row")).select(*keys, "place", *(F.col("_row")[a].alias(a) for a in arrays))


def manifest_records(spark: SparkSession, path: str) -> DataFrame:
    """(logical_key, version, record) of a manifest that maps keys to versions or lists flat records."""
    raw = spark.read.text(path, wholetext=True)
    as_map = raw.select(F.from_json("value", f"resources map<string,array<{RECORD}>>").alias("m")).select(F.explode("m.resources").alias("logical_key", "versions"))
    as_map = as_map.select("logical_key", F.posexplode("versions").alias("version", "record"))
    flat = raw.select(F.from_json("value", f"resources array<{RECORD}>").alias("m")).select(F.posexplode("m.resources").alias("version", "record"))
    flat = flat.where("record.logical_key is not null").select("record.logical_key", "version", "record")
    return as_map.union(flat).where("record is not null")


def owned_key(key: Column) -> Column:
    """struct<kind, cik, name> of ``submissions:<cik>`` or ``submissions-page:<cik>:<name>``, the CIK as ten digits; null for other keys."""
    part = F.split(key, ":")
    cik, name = identity.cik10(F.try_element_at(part, F.lit(2))), F.try_element_at(part, F.lit(3))
    main = (F.size(part) == 2) & (part[0] == "submissions")
    page = (F.size(part) == 3) & (part[0] == "submissions-page") & (name != "")
    return F.when((main | page) & cik.isNotNull(), F.struct(part[0].alias("kind"), cik.alias("cik"), name.alias("name")))


def safe_path(path: Column) -> Column:
    """Whether a record's path is relative, plain and stays below the cache."""
    return F.coalesce((path != "") & (path != CACHE_PREFIX[:-1]) & ~path.rlike(r"^/|^[A-Za-z]:|\\|\x00|//|/$|(^|/)\.\.?(/|$)"), F.lit(False))


def below_cache(path: Column) -> Column:
    """The path below the cache's root, without the prefix of older manifests."""
    return F.regexp_replace(path, f"^{CACHE_PREFIX}", "")


def verified(spark: SparkSession, records: DataFrame, root: str) -> DataFrame:
    """``records`` with content and problem: null, or why the bytes aren't what the record says.

    Only files that a record names are kept, so where records fit a broadcast the files'
    bytes aren't shuffled; they are hashed where they are read. Nothing is listed on the driver.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    files = files.select(F.regexp_replace("path", r"^.*?" + _quoted(root.rstrip("/")) + "/", "").alias("_path"), "content")
    marked = records.withColumn("_path", below_cache(F.col("record.path")))
    found = marked.join(files, "_path").withColumn("_sha256", F.sha2("content", 256))
    lost = marked.join(files.select("_path"), "_path", "left_anti").select(*marked.columns, F.lit(None).cast("binary").alias("content"), F.lit(None).cast("string").alias("_sha256"))
    out = found.select(*marked.columns, "content", "_sha256").union(lost)
    other_key = F.col("record.logical_key").isNotNull() & (F.col("record.logical_key") != F.col("logical_key")) if "logical_key" in records.columns else F.lit(False)
    problem = (
        F.when(other_key, "other_key")
        .when(~safe_path(F.col("record.path")), "unsafe_path")
        .when(~F.coalesce(F.col("record.status"), F.lit("done")).isin("done"), "not_done")
        .when(~F.coalesce(F.col("record.sha256").rlike("^[0-9a-fA-F]{64}$"), F.lit(False)) | (F.coalesce(F.col("record.byte_size"), F.lit(-1)) < 0) | (F.coalesce(F.col("record.url"), F.lit("")) == ""), "bad_record")
        .when(F.col("content").isNull(), "missing")
        .when((F.col("_sha256") != F.lower("record.sha256")) | (F.octet_length("content") != F.col("record.byte_size")), "changed")
        .when(~F.expr("is_valid_utf8(content)"), "not_text")
    )
    return out.withColumn("problem", problem).drop("_path", "_sha256")


def _quoted(path: str) -> str:
    return re.escape(re.sub(r"^file:/*", "/", path))


def submission_rows(payloads: DataFrame, keys: list[str], content: str, main: Column | None = None) -> DataFrame:
    """(keys, place, FIELDS, OTHER_FIELDS, problem): the filings of each payload, in any of its three shapes.

    A payload has parallel arrays under filings.recent or at the top, or a header and rows;
    where ``main`` holds, only the first. Arrays of different lengths, a header without rows or
    with repeated or empty names, and rows of another width give a row with the problem and no
    filing.
    """
    every = FIELDS + OTHER_FIELDS
    p = payloads.select(*keys, (F.lit(False) if main is None else main).alias("_main"), F.from_json(F.col(content).cast("string"), PAYLOAD, {"mode": "PERMISSIVE"}).alias("p"))
    header, data, page = F.col("p.fields"), F.col("p.data"), ~F.col("_main")
    table = header.isNotNull() & data.isNotNull() & page
    bad_header = (F.size(F.array_distinct(header)) != F.size(header)) | F.exists(header, lambda x: x.isNull() | (x == ""))
    bad_width = F.exists(data, lambda r: r.isNull() | (F.size(r) != F.size(header)))
    problem = F.when(F.col("p").isNull(), "not_json").when((header.isNotNull() != data.isNotNull()) & page, "half_table").when(table & bad_header, "bad_header").when(table & bad_width, "bad_width")
    column = lambda f: F.when(F.array_contains(header, f), F.transform(data, lambda r: F.try_element_at(r, F.array_position(header, f).cast("int"))))
    arrays = F.when(table, F.struct(*(column(f).alias(f) for f in every))).when(page & F.col("p.filings").isNull(), F.struct(*(F.col(f"p.{f}").alias(f) for f in every))).otherwise(F.col("p.filings.recent"))
    wide = p.select(*keys, problem.alias("problem"), arrays.alias("a"))
    sizes = F.array_distinct(F.filter(F.array(*(F.size(f"a.{f}") for f in every)), lambda n: n >= 0))
    needed = F.col(f"a.{FIELDS[0]}").isNull() | F.col(f"a.{FIELDS[1]}").isNull()
    wide = wide.select(*keys, F.coalesce("problem", F.when(needed, "no_rows").when(F.size(sizes) > 1, "ragged")).alias("problem"), "a")
    absent = F.transform(f"a.{FIELDS[0]}", lambda x: F.lit(None).cast("string"))
    filled = wide.select(*keys, "problem", *(F.coalesce(f"a.{f}", absent).alias(f) for f in every))
    zipped = F.when(F.col("problem").isNull(), F.arrays_zip(*every))
    return filled.select(*keys, "problem", F.posexplode_outer(zipped).alias("place", "_r")).select(*keys, "place", *(F.col("_r")[f].alias(f) for f in every), "problem")


def scan_cached_filings(spark: SparkSession, root: str, forms=DEFAULT_FORMS, manifest: str | None = None) -> dict[str, DataFrame]:
    """filings, skipped, conflicts and invalid of all issuers in a cache.

    The latest version of each key counts, and no earlier one stands in for a bad one.
    Rows of other forms are dropped before anything else is asked of them.
    """
    forms = checked_forms(forms)
    records = manifest_records(spark, manifest or f"{root}/manifest.json").withColumn("key", owned_key(F.col("logical_key"))).where("key is not null")
    newest = latest(records, ["logical_key", "key"], "version", ["record"])
    checked = verified(spark, newest, root)
    rows = submission_rows(checked.where("problem is null"), ["logical_key", "key"], "content", F.col("key.kind") == "submissions")
    skipped = checked.where("problem is not null").select("logical_key", "problem").union(rows.where("problem is not null").select("logical_key", "problem"))
    named = rows.where(F.col("problem").isNull() & F.col("form").isin(*forms)).select(F.col("key.cik").alias("cik"), "accessionNumber", "form", "filingDate", "reportDate", "primaryDocument")
    filed, reported = dates.iso_date(F.col("filingDate")), dates.iso_date(F.col("reportDate"))
    good = identity.is_accession(F.col("accessionNumber")) & filed.isNotNull() & (identity.missing(F.col("reportDate")).isNull() | reported.isNotNull())
    named = named.withColumn("good", F.coalesce(good, F.lit(False)))
    rows = named.where("good").select("cik", F.col("accessionNumber").alias("accession"), "form", F.col("filingDate").alias("filed_date"), F.col("reportDate").alias("report_date"), F.col("primaryDocument").alias("primary_document"))
    merged = coalesce_rows(rows, ["cik", "accession"], list(MERGED))
    filings = merged.where("not conflict").select(identity.filing_id(F.col("cik"), F.col("accession")).alias("filing_id"), "cik", "accession", *MERGED)
    return {"filings": filings.orderBy("cik", "accession"), "skipped": skipped, "conflicts": merged.where("conflict").select("cik", "accession"), "invalid": named.where("not good").groupBy("cik").count()}


class Catalog(NamedTuple):
    """An issuer's ledger and what it was made from."""

    ledger: DataFrame
    resources: list[dict]
    diagnostics: list[str]
    status: str
    fingerprint: str


def ordered_sessions(spark: SparkSession, sessions) -> tuple[DataFrame, list[datetime.date]]:
    """Sessions as a table and a list; they must be dates, each later than the one before.

    sessions: a sequence of dates, or a table with session and, where its order is to be
    checked, place.
    """
    if isinstance(sessions, DataFrame):
        if "place" in sessions.columns and increasing(sessions, "place").limit(1).count():
            raise CatalogError("sessions must be strictly increasing")
        return sessions.select("session"), sorted({r.session for r in sessions.select("session").distinct().collect()})
    days = list(sessions)
    if any(isinstance(d, datetime.datetime) or not isinstance(d, datetime.date) for d in days):
        raise CatalogError("sessions must be dates")
    if any(a >= b for a, b in zip(days, days[1:], strict=False)):
        raise CatalogError("sessions must be strictly increasing")
    return spark.createDataFrame([(d,) for d in days], "session date"), days


def _issuer(cik: str | int) -> str:
    token = re.fullmatch(r"(?:(?i:CIK))?([0-9]{1,10})", str(cik).strip()) if isinstance(cik, str | int) and not isinstance(cik, bool) else None
    if not token:
        raise CatalogError("a CIK has 1 to 10 ASCII digits")
    return token[1].zfill(10)


def read_cached_catalog(spark: SparkSession, root: str, cik: str | int, sessions, forms=APPROVED_FORMS, allow_partial: bool = False, manifest: str | None = None) -> Catalog:
    """The ledger of one issuer; any flaw of the input raises.

    Here all rows are merged before forms are chosen, so a conflict in any form and any column
    raises. What the driver holds is one issuer's: its records, page names and sessions.
    """
    forms, cik = checked_forms(forms), _issuer(cik)
    calendar, days = ordered_sessions(spark, sessions)
    records = manifest_records(spark, manifest or f"{root}/manifest.json").withColumn("key", owned_key(F.col("logical_key"))).where(F.col("key.cik") == cik)
    checked = verified(spark, latest(records, ["logical_key", "key"], "version", ["record"]), root).persist()
    try:
        return _ledger(spark, checked, cik, calendar, days, forms, allow_partial)
    finally:
        checked.unpersist()


def _ledger(spark: SparkSession, checked: DataFrame, cik: str, calendar: DataFrame, days: list, forms, allow_partial: bool) -> Catalog:
    p = F.from_json(F.col("content").cast("string"), PAYLOAD)
    held = checked.select("logical_key", F.col("key.kind").alias("kind"), F.col("key.name").alias("name"), "record", "problem", p["cik"].alias("cik"), p["filings"]["files"].alias("files"), p["filings"]["recent"].isNotNull().alias("recent"))
    held = [r.asDict(recursive=True) for r in held.collect()]  # the keys of one issuer
    main = [r for r in held if r["kind"] == "submissions"]
    if len(main) != 1:
        raise CatalogError(f"{len(main)} main submission indexes of {cik}")
    if main[0]["problem"]:
        raise CatalogError(f"{main[0]['logical_key']}: {main[0]['problem']}")
    if main[0]["record"]["url"] != f"{SUBMISSIONS_URL}CIK{cik}.json" or not main[0]["cik"] or _issuer(main[0]["cik"]) != cik:
        raise CatalogError("the main index is of another issuer")
    if main[0]["files"] is None or not main[0]["recent"]:
        raise CatalogError("the main index lacks its filings")
    names = list(dict.fromkeys(f and f["name"] for f in main[0]["files"]))
    if any(not (m := re.fullmatch(PAGE_NAME, n or "")) or m[1] != cik for n in names):
        raise CatalogError("a page of another issuer")
    used, diagnostics = [main[0]], []
    for name in names:
        pages = [r for r in held if r["kind"] == "submissions-page" and r["name"] == name]
        if not pages and allow_partial:
            diagnostics.append(f"missing_historical_page:{name}")
            continue
        if len(pages) != 1:
            raise CatalogError(f"missing page {name}" if not pages else f"{len(pages)} records of page {name}")
        page = pages[0]
        if page["problem"]:
            raise CatalogError(f"{page['logical_key']}: {page['problem']}")
        if page["record"]["url"] != SUBMISSIONS_URL + name or page["cik"] and _issuer(page["cik"]) != cik:
            raise CatalogError(f"page {name} is of another issuer")
        used.append(page)
    rank = spark.createDataFrame([(r["logical_key"], k, r["record"]["path"], r["record"]["sha256"].lower()) for k, r in enumerate(used)], "logical_key string, rank int, path string, sha256 string")
    rows = submission_rows(checked.join(F.broadcast(rank), "logical_key"), ["logical_key", "rank", "path", "sha256"], "content", F.col("rank") == 0)
    flaw = rows.where("problem is not null").select("logical_key", "problem").limit(1).collect()
    if flaw:
        raise CatalogError(f"{flaw[0].logical_key}: {flaw[0].problem}")
    merged = coalesce_rows(rows, ["accessionNumber"], [f for f in FIELDS + OTHER_FIELDS if f != "accessionNumber"])
    first = rows.groupBy("accessionNumber").agg(F.min(F.struct("rank", "place", "logical_key", "sha256", "path")).alias("source"))
    accession = F.col("accessionNumber")
    bad = merged.where(F.col("conflict") | ~identity.is_accession(accession) | F.col("form").isNull()).limit(1).collect()
    if bad:
        raise ConflictError(f"conflict in {bad[0].accessionNumber}") if bad[0].conflict else CatalogError(f"bad row {bad[0].accessionNumber}")
    none = F.lit(None).cast("string")
    raw = identity.missing(F.col("acceptanceDateTime"))
    values = {
        "filing_id": identity.filing_id(F.lit(cik), accession),
        "cik10": F.lit(cik),
        "accession_number": accession,
        "form": F.col("form"),
        "filed_date": dates.iso_date(F.col("filingDate")),
        "report_period_end": dates.iso_date(identity.missing(F.col("reportDate"))),
        "acceptance_datetime_raw": raw,
        "acceptance_datetime_utc": dates.acceptance_utc(raw),
        "is_amendment": F.col("form").endswith("/A"),
        "parent_filing_id": none,
        "parent_link_source": none,
        "primary_document_name": identity.optional_text(F.col("primaryDocument")),
        "scope_status": F.when(F.col("form") == "6-K", "candidate").otherwise("included"),
        "scope_evidence_json": none,
        "inventory_status": F.lit("not_inspected"),
        "raw_coverage_status": F.lit("not_attempted"),
        "source_submission_logical_key": F.col("source.logical_key"),
        "source_submission_sha256": F.col("source.sha256"),
        "source_submission_path": F.col("source.path"),
        "source_submission_locator": F.concat(F.when(F.col("source.rank") == 0, "filings.recent[").otherwise("rows["), F.col("source.place").cast("string"), F.lit("]")),
    }
    found = merged.join(first, "accessionNumber").where(F.col("form").isin(*forms))
    report = identity.missing(F.col("reportDate"))
    wrong = found.where(dates.iso_date(F.col("filingDate")).isNull() | report.isNotNull() & dates.iso_date(report).isNull()).limit(1).collect()
    if wrong:
        raise CatalogError(f"bad date in {wrong[0].accessionNumber}")
    ledger = next_session(found.select(*(v.alias(k) for k, v in values.items())), calendar, "filed_date", strict=True).withColumnRenamed("session", "effective_visible_session")
    status = "partial" if diagnostics else "complete"
    resources = [{"logical_key": r["logical_key"], "sha256": r["record"]["sha256"].lower(), "byte_size": r["record"]["byte_size"]} for r in used]
    mark = fingerprint(cik, forms, resources, status, diagnostics, days)
    return Catalog(ledger.select(*LEDGER).orderBy("filed_date", "accession_number"), [r | {"url": u["record"]["url"], "path": u["record"]["path"]} for r, u in zip(resources, used, strict=True)], diagnostics, status, mark)


def fingerprint(cik: str, forms, resources: list[dict], status: str, diagnostics: list[str], days: list[datetime.date]) -> str:
    """sha256 of the canonical JSON of what a catalog was read from."""
    body = {"cik10": cik, "forms": sorted(forms), "resources": sorted(resources, key=lambda r: r["logical_key"]), "input_status": status, "diagnostics": diagnostics, "xnys_sessions": [d.isoformat() for d in days]}
    return hashlib.sha256(json.dumps(body, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
