import datetime
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from ledgerlode.operators import catalog

DAY = datetime.date
CIK = "0000000042"


PAGE = f"CIK{CIK}-submissions-001.json"


def acc(n):
    return f"{CIK}-24-{n:06d}"


def payload(rows, files=()):
    keys = catalog.FIELDS
    return {"cik": CIK, "filings": {"recent": {k: [r[i] for r in rows] for i, k in enumerate(keys)}, "files": [{"name": f} for f in files]}}


def cache(tmp_path, resources):
    manifest = {}
    for key, versions in resources.items():
        for n, body in enumerate(versions):
            data = body if isinstance(body, bytes) else json.dumps(body).encode()
            name = f"{hashlib.sha256(key.encode()).hexdigest()[:8]}-{n}.json"
            (tmp_path / name).write_bytes(data)
            manifest.setdefault(key, []).append({"path": name, "sha256": hashlib.sha256(data).hexdigest(), "byte_size": len(data), "url": catalog.SUBMISSIONS_URL + (key.split(":")[2] if key.count(":") == 2 else f"CIK{key.split(chr(58))[1]}.json"), "status": "done"})
    (tmp_path / "manifest.json").write_text(json.dumps({"resources": manifest}))
    return str(tmp_path), manifest


ROWS = [
    (acc(1), "2024-01-12", "2023-12-31", "2024-01-12T01:02:03Z", "10-Q", "a.htm"),
    (acc(2), "2024-01-16", "", "2024-01-16T01:02:03", "10-K", ""),
    (acc(3), "2024-01-16", "2023-12-31", "", "8-K", "c.htm"),
]


def sessions(spark, days):
    return spark.createDataFrame([(d,) for d in days], "session date")


def test_coalesce_rows_ignores_order_and_blanks(spark):
    df = spark.createDataFrame([("a", "", "x"), ("a", "1", "x"), ("b", "1", "x"), ("b", "2", "x"), ("c", None, "")], "k string, v string, w string")
    got = {r.k: r for r in catalog.coalesce_rows(df, ["k"], ["v", "w"]).collect()}
    assert (got["a"].v, got["a"].conflict) == ("1", False)
    assert (got["b"].v, got["b"].w, got["b"].conflict) == (None, None, True)
    assert (got["c"].v, got["c"].w, got["c"].conflict) == (None, None, False)


def test_next_session_is_strictly_later(spark):
    days = [DAY(2024, 1, 11), DAY(2024, 1, 12), DAY(2024, 1, 16)]
    df = spark.createDataFrame([(1, DAY(2024, 1, 12)), (2, DAY(2024, 1, 13)), (3, DAY(2024, 1, 16)), (4, None), (5, DAY(2024, 1, 12))], "i int, d date")
    got = {r.i: r.session for r in catalog.next_session(df, sessions(spark, days), "d").collect()}
    assert got == {1: DAY(2024, 1, 16), 2: DAY(2024, 1, 16), 3: None, 4: None, 5: DAY(2024, 1, 16)}
    with pytest.raises(Exception, match="no session"):
        catalog.next_session(df, sessions(spark, days), "d", strict=True).collect()


def test_ragged_arrays(spark):
    df = spark.createDataFrame([(1, ["a"], ["b", "c"])], "k int, x array<string>, y array<string>")
    with pytest.raises(Exception, match="differ in length"):
        catalog.unnest_parallel(df, ["k"], ["x", "y"]).collect()
    assert catalog.unnest_parallel(df, ["k"], ["x", "y"], strict=False).count() == 0


def test_scan_takes_forms_and_counts_bad_rows(spark, tmp_path):
    bad = ("1-2-3", "2024-01-12", "", "", "10-K", "")
    root, _ = cache(tmp_path, {f"submissions:{CIK}": [payload([*ROWS, bad])], "other:1": [{"a": 1}]})
    out = catalog.scan_cached_filings(spark, root)
    assert [(r.accession, r.form, r.report_date) for r in out["filings"].collect()] == [(acc(1), "10-Q", "2023-12-31"), (acc(2), "10-K", None)]
    assert [r["count"] for r in out["invalid"].collect()] == [1]
    assert out["skipped"].count() == 0 and out["conflicts"].count() == 0


def test_scan_never_falls_back_to_an_older_version(spark, tmp_path):
    root, manifest = cache(tmp_path, {f"submissions:{CIK}": [payload(ROWS), payload(ROWS)]})
    (tmp_path / manifest[f"submissions:{CIK}"][1]["path"]).write_bytes(b"{}")
    out = catalog.scan_cached_filings(spark, root)
    assert out["filings"].count() == 0
    assert [r.problem for r in out["skipped"].collect()] == ["changed"]


def test_scan_excludes_conflicts_and_reads_the_table_shape(spark, tmp_path):
    page = {"fields": list(catalog.FIELDS), "data": [[acc(1), "2024-01-12", "2022-12-31", "", "10-Q", ""], [acc(9), "2021-02-25", "", "", "20-F", "z.htm"]]}
    root, _ = cache(tmp_path, {f"submissions:{CIK}": [payload(ROWS, ["p.json"])], f"submissions-page:{CIK}:p.json": [page]})
    out = catalog.scan_cached_filings(spark, root)
    assert [r.accession for r in out["filings"].collect()] == [acc(9), acc(2)] or {r.accession for r in out["filings"].collect()} == {acc(9), acc(2)}
    assert [r.accession for r in out["conflicts"].collect()] == [acc(1)]


def test_submission_shapes_that_are_rejected(spark):
    body = payload(ROWS)
    body["filings"]["recent"]["form"].pop()
    cases = [json.dumps(body), json.dumps({"fields": ["a", "a"], "data": []}), json.dumps({"fields": ["a", "b"], "data": [["1"]]}), "x", "{}"]
    df = spark.createDataFrame(list(enumerate(cases)), "i int, c string")
    got = {r.i: r.problem for r in catalog.submission_rows(df, ["i"], "c").collect()}
    assert got[0] == "ragged" and got[1] == "bad_header" and got[2] == "bad_width" and got[4] == "no_rows" and got[3] in ("not_json", "no_rows")


def test_ledger(spark, tmp_path):
    root, _ = cache(tmp_path, {f"submissions:{CIK}": [payload(ROWS)]})
    days = sessions(spark, [DAY(2024, 1, 11), DAY(2024, 1, 16), DAY(2024, 1, 17)])
    found = catalog.read_cached_catalog(spark, root, "cik42", days)
    rows = found.ledger.collect()
    assert found.ledger.columns == list(catalog.LEDGER)
    assert [(r.accession_number, r.effective_visible_session, r.primary_document_name, r.scope_status) for r in rows] == [(acc(1), DAY(2024, 1, 16), "a.htm", "included"), (acc(2), DAY(2024, 1, 17), None, "included")]
    assert rows[0].acceptance_datetime_utc is not None and rows[1].acceptance_datetime_utc is None and rows[1].acceptance_datetime_raw
    assert rows[0].source_submission_locator == "filings.recent[0]" and found.status == "complete"
    body = {"cik10": CIK, "forms": sorted(catalog.APPROVED_FORMS), "resources": [{k: found.resources[0][k] for k in ("logical_key", "sha256", "byte_size")}], "input_status": "complete", "diagnostics": [], "xnys_sessions": ["2024-01-11", "2024-01-16", "2024-01-17"]}
    assert found.fingerprint == hashlib.sha256(json.dumps(body, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    with pytest.raises(catalog.CatalogError, match="increasing"):
        catalog.read_cached_catalog(spark, root, CIK, [DAY(2024, 1, 16), DAY(2024, 1, 11)])


def test_ledger_fails_closed(spark, tmp_path):
    root, _ = cache(tmp_path, {f"submissions:{CIK}": [payload(ROWS, [PAGE])]})
    days = sessions(spark, [DAY(2024, 1, 11), DAY(2024, 1, 16), DAY(2024, 1, 17)])
    with pytest.raises(catalog.CatalogError, match="missing page"):
        catalog.read_cached_catalog(spark, root, CIK, days)
    found = catalog.read_cached_catalog(spark, root, 42, days, allow_partial=True)
    assert found.status == "partial" and found.diagnostics == [f"missing_historical_page:{PAGE}"]
    with pytest.raises(catalog.CatalogError):
        catalog.checked_forms("10-K")
    with pytest.raises(catalog.CatalogError):
        catalog.checked_forms(["S-1"])


def test_ledger_merges_pages_and_rejects_conflicts(spark, tmp_path):
    page = {"fields": list(catalog.FIELDS), "data": [[acc(1), "2024-01-12", "", "", "10-Q", ""], [acc(9), "2024-01-15", "", "", "6-K", "z.htm"]]}
    root, _ = cache(tmp_path, {f"submissions:{CIK}": [payload(ROWS, [PAGE])], f"submissions-page:{CIK}:{PAGE}": [page]})
    days = [DAY(2024, 1, 11), DAY(2024, 1, 16), DAY(2024, 1, 17)]
    rows = catalog.read_cached_catalog(spark, root, CIK, days).ledger.collect()
    assert [(r.accession_number, r.scope_status, r.source_submission_locator) for r in rows] == [(acc(1), "included", "filings.recent[0]"), (acc(9), "candidate", "rows[1]"), (acc(2), "included", "filings.recent[1]")]
    page["data"][0][4] = "10-K"
    root, _ = cache(tmp_path, {f"submissions:{CIK}": [payload(ROWS, [PAGE])], f"submissions-page:{CIK}:{PAGE}": [page]})
    with pytest.raises(catalog.ConflictError):
        catalog.read_cached_catalog(spark, root, CIK, days)


def test_latest_and_pending(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, n int, v string")
    assert {(r.k, r.n, r.v) for r in catalog.latest(df, ["k"], "n", ["v"]).collect()} == {("a", 2, "y"), ("b", 1, "z")}
    assert {r.k for r in catalog.pending(df, df.where("k = 'a'"), ["k"]).collect()} == {"b"}


def test_owned_keys(spark):
    df = spark.createDataFrame([(f"submissions:{CIK}",), (f"submissions-page:{CIK}:p",), ("submissions:1",), (f"x-submissions:{CIK}",), (f"submissions-page:{CIK}:",)], "k string")
    assert [r.o is not None for r in df.select(catalog.owned_key(F.col("k")).alias("o")).collect()] == [True, True, True, False, False]
