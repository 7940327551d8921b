"""From a cache of submission indexes to published samples, with a client that answers from a table."""

import argparse
import hashlib
import json

import pytest

from ledgerlode import cli
from ledgerlode.operators import catalog, validation
from ledgerlode.sources import http

CIK = "0000000042"
BASE = "https://www.sec.gov/Archives/edgar/data/42/"


def acc(n):
    return f"{CIK}-24-{n:06d}"


def folder(n):
    return f"{BASE}{acc(n).replace('-', '')}/"


class Desk:
    """A client that knows some pages; every other is not there."""

    def __init__(self, pages):
        self.pages, self.asked = pages, []

    def get(self, url):
        self.asked.append(url)
        if url not in self.pages:
            raise http.NotFound(404, url)
        return http.Response(url, 200, {}, self.pages[url])


def inventory(n, files):
    directory = folder(n).removeprefix("https://www.sec.gov")
    index = {"directory": {"name": directory.strip("/"), "item": [{"name": f, "type": "text", "size": ""} for f, *_ in files]}}
    rows = "".join(f"<tr><td>{k}</td><td>{d}</td><td><a href='{f}'>{f}</a></td><td>{t}</td></tr>" for k, (f, t, d) in enumerate(files))
    return {folder(n) + "index.json": json.dumps(index).encode(), f"{folder(n)}{acc(n)}-index.html": f"<table class=tableFile>{rows}</table>".encode()}


def cached(root, rows):
    body = {"cik": CIK, "filings": {"recent": {k: [r[i] for r in rows] for i, k in enumerate(catalog.FIELDS)}, "files": []}}
    data = json.dumps(body).encode()
    root.mkdir()
    (root / "a.json").write_bytes(data)
    record = {"path": "a.json", "sha256": hashlib.sha256(data).hexdigest(), "byte_size": len(data), "url": f"{catalog.SUBMISSIONS_URL}CIK{CIK}.json", "status": "done"}
    (root / "manifest.json").write_text(json.dumps({"resources": {f"submissions:{CIK}": [record]}}))


def test_build_from_a_cache(spark, tmp_path):
    row = lambda n, form, name: (acc(n), "2024-03-01", "", "", form, name)
    cached(tmp_path / "cache", [row(1, "10-K", "a.htm"), row(2, "40-F", "b.htm"), row(3, "10-Q", ""), row(4, "10-K", "gone.htm"), row(5, "10-K", "e.htm"), row(6, "8-K", "f.htm")])
    page = lambda x: f"<html><body><p>{x}</p></body></html>".encode()
    whole = lambda form, x: f"<DOCUMENT>\n<TYPE>{form}\n<TEXT>\n".encode() + page(x) + b"\n</TEXT>\n</DOCUMENT>\n"
    pages = inventory(1, [("a.htm", "10-K", ""), ("a.xsd", "EX-101.SCH", ""), ("lost_lab.xml", "EX-101.LAB", "")]) | inventory(2, [("b.htm", "40-F", ""), ("ex.htm", "EX-99.1", "Exhibit")]) | inventory(4, [("gone.htm", "10-K", "")])
    pages |= {folder(1) + "a.htm": page("Item 1. Business"), folder(1) + "a.xsd": b"<x/>", folder(2) + "ex.htm": page("Note 4 on leases"), folder(2) + "b.htm": b"<html><table><tr><td>99.1</td><td>Annual financial report</td><td><a href='ex.htm'>x</a></td></tr></table></html>"}
    pages |= {f"{folder(3)}{acc(3)}.txt": whole("10-Q", "Quarter"), f"{folder(4)}{acc(4)}.txt": whole("10-K", "Whole")}
    a = argparse.Namespace(documents=None, cache_root=str(tmp_path / "cache"), out=f"{tmp_path}/out", work_dir=f"{tmp_path}/work", form=None, filing_id=None, limit=None, workers=2, resume=False, secrets="")
    result = cli.run_build(spark, a, Desk(pages))
    got = {r.sample_id: [(b.block_type, b.text) for b in r.blocks] for r in validation.read_samples(spark, f"{tmp_path}/out/samples").collect()}
    assert got == {f"{CIK}:{acc(n)}": x for n, x in {1: [("other_context", "Item 1. Business")], 2: [("unknown", "99.1"), ("unknown", "Annual financial report"), ("unknown", "x"), ("note", "Note 4 on leases")], 3: [("unknown", "Quarter")], 4: [("unknown", "Whole")]}.items()}
    said = {r.filing_id[-1]: r for r in validation.read_diagnostics(spark, f"{tmp_path}/out/diagnostics").collect()}
    assert {k: r.coverage_status for k, r in said.items()} == {"1": "partial", "2": "complete", "3": "partial", "4": "partial", "5": "unknown"}
    assert said["1"].degradation == ["selected_document_fetch_failed:lost_lab.xml:NotFound"] and said["4"].degradation == ["primary_missing_full_submission_fallback"]
    assert said["5"].status == "failed" and "index" in said["5"].reason
    assert (result["emitted"], result["failed"], result["total"]) == (4, 1, 5)
    with pytest.raises(validation.SampleError, match="empty"):
        cli.run_build(spark, a, Desk(pages))
    with pytest.raises(catalog.CatalogError, match="unknown"):
        cli.run_build(spark, argparse.Namespace(**vars(a) | {"out": f"{tmp_path}/other", "work_dir": None, "filing_id": ["x"]}), Desk(pages))
