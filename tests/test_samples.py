import datetime
import os

import pytest
from pyspark.sql import functions as F

from ledgerlode.operators import selection, validation
from ledgerlode.sources import fetch
from ledgerlode.streaming import resume


def make(spark, n, years):
    rows = [(f"s{i:05d}", "e", datetime.date(years[i % len(years)], 1, 2) if years[i % len(years)] else None, [(0, "unknown", "x")]) for i in range(n)]
    return spark.createDataFrame(rows, f"sample_id string, entity_id string, filed_date date, blocks {validation.BLOCKS}")


def test_publish_and_validate(spark, tmp_path):
    samples = make(spark, 1001, [2020, 2021, None])
    ids = samples.select(F.col("sample_id").alias("id"))
    diagnostics = samples.select(F.col("sample_id").alias("filing_id"), F.lit("emitted").alias("status"))
    out = f"{tmp_path}/out"
    for _ in range(2):  # the second replaces the first
        assert validation.publish(spark, samples, diagnostics, ids, out) == {"emitted": 1001, "skipped": 0, "failed": 0, "total": 1001, "rows": 1001}
    assert sorted(x for x in os.listdir(f"{out}/samples") if x.startswith("year")) == ["year=2020", "year=2021", "year=unknown"]
    assert not os.path.exists(f"{out}.staging") and not os.path.exists(f"{out}.backup")


def test_rejections(spark):
    samples = make(spark, 3, [2020])
    ids = samples.select(F.col("sample_id").alias("id"))
    diagnostics = samples.select(F.col("sample_id").alias("filing_id"), F.lit("emitted").alias("status"))
    check = lambda s, d=diagnostics: validation.validate_samples(s, d, ids)
    assert check(samples)["rows"] == 3
    for bad in ("array(named_struct('order_index', 1, 'block_type', 'unknown', 'text', 'x'))", "array(named_struct('order_index', 0, 'block_type', 'odd', 'text', 'x'))", "array(named_struct('order_index', 0, 'block_type', 'unknown', 'text', ' '))"):
        with pytest.raises(validation.SampleError):
            check(samples.withColumn("blocks", F.expr(bad)))
    with pytest.raises(validation.SampleError, match="duplicate"):
        check(samples.union(samples.limit(1)))
    with pytest.raises(validation.SampleError):
        check(samples.limit(2))


def test_nested(spark):
    df = spark.createDataFrame([("a", 2, "t", "y"), ("a", 1, "t", "x"), ("b", 1, "t", "z")], "k string, o int, block_type string, text string")
    got = {r.k: [(b.order_index, b.text) for b in r.blocks] for r in validation.nested(df, ["k"], ["o"]).collect()}
    assert got == {"a": [(0, "x"), (1, "y")], "b": [(0, "z")]}


FILING = "0000000042:0000000042-24-000007"
DIRECTORY = "/Archives/edgar/data/42/000000004224000007/"


def inventory(spark, form, files, absent=False):
    """candidates and plans of one filing; files: (name, type, description), those without a type not in the detail page."""
    import json

    index = json.dumps({"directory": {"name": DIRECTORY, "item": [{"name": n, "type": "text", "size": 1} for n, *_ in files] + [{"name": "index.json"}]}})
    page = "<table class='x tableFile'><tr><th>Seq<th>Description<th>Document<th>Type</tr>" + "".join(f"<tr><td>{k}</td><td>{d or ''}</td><td><a href='/ix?doc={DIRECTORY}{n}'>{n}</a></td><td>{t}</td></tr>" for k, (n, t, d) in enumerate(files) if t) + "</table>"
    filings = spark.createDataFrame([(FILING, "0000000042", FILING[11:], form, files[0][0])], "filing_id string, cik string, accession string, form string, primary_document string")
    landed = [(FILING, 0, "index.json", "index", index.encode(), None), (FILING, 1, "x-index.html", "detail", None if absent else page.encode(), "NotFound" if absent else None)]
    return fetch.planned(filings, spark.createDataFrame(landed, fetch.LANDED))


def cover(spark, rows):
    page = "<html><table>" + "".join(f"<tr><td>{n}</td><td>{t}</td><td>{links}</td></tr>" for n, t, links in rows) + "</table></html>"
    df = spark.createDataFrame([(FILING, page, DIRECTORY)], "filing_id string, content string, d string")
    return selection.cover_rows(df, ["filing_id"], "content", F.col("d"))


def test_plans(spark):
    cases = {
        ("10-K", ("a.htm", "10-K", None), ("ex31.htm", "EX-31", "certification"), ("z_lab.xml", None, None)): ("selected_financial", ["a.htm", "z_lab.xml"]),
        ("6-K", ("c.htm", "6-K", None), ("f.pdf", "EX-99.1", "Q3 Earnings  Release")): ("selected_financial", ["c.htm", "f.pdf"]),
        ("6-K", ("d.htm", "6-K", None), ("x.htm", "EX-99.1", "Material agreement on results of operations")): ("non_financial", ["d.htm"]),
        ("40-F", ("e.htm", "40-F", None), ("ex99.htm", "EX-99.1", "Exhibit")): ("needs_review", ["e.htm"]),
        ("6-K", ("g.htm", "6-K", "Interim report"), ("h.gif", "GRAPHIC", None)): ("selected_financial", ["g.htm"]),
        ("6-K", ("i.htm", "6-K", "Interim report"), ("more.htm", "OTHER", None)): ("needs_review", ["i.htm"]),
        ("20-F", ("j.htm", "20-F", None), ("x", "EX-1", "no financial statements")): ("selected_financial", ["j.htm", "x"]),
    }
    for (form, *files), want in cases.items():
        (plan,) = inventory(spark, form, files)[1].collect()
        assert (plan.status, plan.selected) == want and plan.problem is None, files
    (plan,) = inventory(spark, "6-K", [("c.htm", "6-K", "Annual report")], absent=True)[1].collect()
    assert plan.status == "needs_review" and "404" in plan.reasons[0] or "404" in "".join(plan.reasons)


def test_inventories_that_are_rejected(spark):
    for bad in ("../x", "a%2fb"):
        (plan,) = inventory(spark, "10-K", [("a.htm", "10-K", None), (bad, None, None)])[1].collect()
        assert plan.status == "failed" and plan.problem.startswith("index: filename")
    for href in ("https://example.com/a.htm", "/Archives/edgar/data/43/000000004224000007/a.htm", "javascript:x", DIRECTORY + "a.htm?x=1", "/ix?doc=" + DIRECTORY + "a.htm&y=2", DIRECTORY + "%2e%2e/a.htm"):
        try:
            assert selection.linked_file(href, DIRECTORY) is None
        except selection.InventoryError:
            continue
    assert selection.linked_file("a.htm", DIRECTORY) == selection.linked_file("https://www.sec.gov" + DIRECTORY + "a.htm", DIRECTORY) == selection.linked_file("/ix?doc=" + DIRECTORY + "a.htm", DIRECTORY) == "a.htm"


def test_refined_plans(spark):
    files = [("e.htm", "40-F", None), ("ex99.htm", "EX-99.1", "Exhibit"), ("two.htm", "EX-99.2", "Other")]
    rows, plans = inventory(spark, "40-F", files)
    link = lambda n: f"<a href='{n}'>x</a>"
    both = cover(spark, [("99.1", "Audited annual report", link("ex99.htm")), ("EX-99.2", "Interim <i>financial</i> report", link("two.htm")), ("5", "Financial statements", link("e.htm"))])
    refined, moved = selection.refine(plans, rows, both)
    (got,) = refined.collect()
    assert (got.status, got.selected) == ("selected_financial", ["e.htm", "ex99.htm", "two.htm"])
    assert {r.name for r in selection.to_fetch(moved).collect()} == {"e.htm", "ex99.htm", "two.htm"}
    (got,) = selection.refine(plans, rows, cover(spark, [("99.1", "Annual report, audited", link("ex99.htm"))]))[0].collect()
    assert got.status == "needs_review" and "ex99.htm" in got.selected and any("two.htm" in r for r in got.reasons)
    (got,) = selection.refine(plans, rows, cover(spark, [("99.1", "Financial statements", link("ex99.htm") + link("two.htm"))]))[0].collect()
    assert got.status == "needs_review" and got.selected == ["e.htm"] and any("uniquely" in r for r in got.reasons)
    (got,) = selection.refine(plans, rows, cover(spark, [("99.1", "Financial statements", link("https://example.com/x"))]))[0].collect()
    assert got.problem and got.status == "needs_review"


def test_roles(spark):
    rows = [("EX-101.SCH", "a.xsd", None), ("EX-101.ODD", "a_cal.xml", None), (None, "b_cal.xml", None), ("XML", "x.xml", "EXTRACTED XBRL INSTANCE DOCUMENT"), ("EX-1", "c.htm", None), (None, "d_ref.xml", None), (None, "e_INS.xml", None), (None, "f_tag.xml", None)]
    df = spark.createDataFrame(rows, "t string, n string, d string")
    assert [r.x for r in df.select(selection.xbrl_role(F.col("t"), F.col("n"), F.col("d")).alias("x")).collect()] == ["schema", None, "linkbase", "xbrl_instance", None, None, "xbrl_instance", "linkbase"]


def test_shards_with_another_schema(spark, tmp_path):
    make(spark, 3, [2020]).write.parquet(f"{tmp_path}/good/year=2020")
    assert validation.read_samples(spark, f"{tmp_path}/good").count() == 3
    make(spark, 3, [2020]).withColumn("entity_id", F.lit(1)).write.parquet(f"{tmp_path}/bad/year=2020")
    with pytest.raises(validation.SampleError, match="schema"):
        validation.read_samples(spark, f"{tmp_path}/bad")
    (tmp_path / "bad" / "year=2020" / "part-9.parquet").write_bytes(b"no parquet")
    assert {r.problem for r in validation.shard_problems(spark, f"{tmp_path}/bad").collect()} == {"schema", "unreadable"}


def test_diagnostics_with_a_bad_line(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x.json").write_text('{"filing_id": "a", "status": "emitted"}\n{"filing')
    with pytest.raises(validation.SampleError):
        validation.read_diagnostics(spark, f"{tmp_path}/d")


def test_outputs_stay_apart(tmp_path):
    validation.apart({"output": f"{tmp_path}/a", "work": f"{tmp_path}/b"}, [f"{tmp_path}/c"])
    (tmp_path / "link").symlink_to(tmp_path / "real")
    for paths in ({"o": f"{tmp_path}/a", "w": f"{tmp_path}/a"}, {"o": f"{tmp_path}/c/x"}, {"o": str(tmp_path)}, {"o": "."}, {"o": f"{tmp_path}/link/x"}):
        with pytest.raises(validation.SampleError):
            validation.apart(paths, [f"{tmp_path}/c"])


def test_resume_reads_each_file_once(spark, tmp_path):
    source, state, out = (f"{tmp_path}/{k}" for k in ("in", "state", "out"))
    spark.range(5).write.parquet(source)
    schema = spark.read.parquet(source).schema
    assert resume.drain(spark, source, schema, state, resume.into(out)) >= 1
    assert resume.drain(spark, source, schema, state, resume.into(out)) == 0
    spark.range(5, 8).write.mode("append").parquet(source)
    assert resume.drain(spark, source, schema, state, resume.into(out)) >= 1
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(8))
