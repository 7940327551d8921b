import datetime
import json


from ledgerlode import cli
from ledgerlode.operators import samples, validation
from ledgerlode.sources import ingest, universe

DAY = datetime.date(2024, 3, 1)
SCHEMA = "filing_id string, entity_id string, filed_date date, place int, name string, role string, body string"
ROWS = [
    ("f1", "e1", DAY, 0, "a.htm", "primary", "<h1>Item 1. Business</h1><p>We sold 1,200 things.</p><table><tr><td>Cash</td><td>1,000</td><td>2,000</td></tr></table>"),
    ("f1", "e1", DAY, 1, "b.htm", "exhibit", "<p>Note 1 on leases</p>"),
    ("f1", "e1", DAY, 2, "c.xsd", "schema", "<schema/>"),
    ("f2", "e2", None, 0, "d.htm", "primary", "<p> </p>"),
    ("f3", "e3", DAY, 0, "e.pdf", "other", "x"),
]


def test_build(spark, tmp_path):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    made, diagnostics = samples.build(docs)
    (row,) = made.collect()
    assert [(b.order_index, b.block_type) for b in row.blocks] == [(0, "other_context"), (1, "unknown"), (2, "financial_statement"), (3, "note")]
    got = {r.filing_id: r for r in diagnostics.collect()}
    assert {k: r.status for k, r in got.items()} == {"f1": "emitted", "f2": "skipped", "f3": "skipped"}
    assert (got["f1"].table_count, got["f1"].block_count, got["f1"].content_status) == (1, 4, "full") and "not_content" in got["f1"].parser_status
    assert samples.resume(docs, diagnostics).count() == 0
    docs.write.parquet(f"{tmp_path}/docs")
    assert cli.main(["build", "--documents", f"{tmp_path}/docs", "--out", f"{tmp_path}/out"]) == 0
    assert cli.main(["validate", "--out", f"{tmp_path}/out"]) == 0
    assert validation.read_samples(spark, f"{tmp_path}/out/samples").count() == 1
    assert cli.main(["build"]) == 2


def test_universe(spark, tmp_path):
    body = json.dumps({"fields": ["CIK", "name", "Ticker", "exchange"], "data": [[1, "One", " abc ", "NYSE"], ["x", "Bad", "bad", "NYSE"], [2, "Two"], [3, "Three", "ddd", "otc"]]}).encode()
    import hashlib

    (tmp_path / f"{hashlib.sha256(body).hexdigest()}.json").write_bytes(body)
    (tmp_path / f"{'0' * 64}.json").write_bytes(b"{}")
    rows = universe.rows(universe.snapshots(spark, str(tmp_path)))
    assert {(r.ticker, r.cik10) for r in rows.collect()} == {("ABC", "0000000001"), ("DDD", "0000000003")}
    assert [r.ticker for r in universe.listed(rows, ["nyse"]).collect()] == ["ABC"]
    (tmp_path / "own.txt").write_text('{"abc": "77", "zzz": "x"}')
    own = universe.with_overrides(rows, universe.overrides(spark, f"{tmp_path}/own.txt"))
    assert {r.ticker: r.cik10 for r in own.collect()} == {"ABC": "0000000077", "DDD": "0000000003"}
    found, unknown = universe.resolve(rows, spark.createDataFrame([("abc",), ("nope",)], "ticker string"))
    assert [r.ticker for r in found.collect()] == ["ABC"] and [r.ticker for r in unknown.collect()] == ["NOPE"]


def test_missing_records(spark):
    wanted = spark.createDataFrame([("a", "u"), ("b", "u"), ("c", "u")], "logical_key string, url string")
    records = spark.createDataFrame([("a", 0, ("p", "s", 1, "u", "done", "t", 1)), ("b", 0, ("p", "s", 1, "u", "done", "t", 1)), ("b", 1, ("p", "s", 1, "v", "done", "t", 1))], "logical_key string, version int, record struct<path:string,sha256:string,byte_size:bigint,url:string,status:string,fetched_at_utc:string,attempts:int>")
    assert sorted(r.logical_key for r in ingest.missing(wanted, records).collect()) == ["b", "c"]
