"""Plans of many filings: all of a filing is dealt by its id once, and what is parsed isn't left to the tasks that read a narrow table."""

import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from ledgerlode.functions import tags
from ledgerlode.operators import selection
from ledgerlode.plans import filings as plans

DIR = "/root/testdata/sf0.001"


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_refined_plans_deal_each_input_once(spark):
    assert exchanges(plans.QUERIES["q46_refined_plans"](spark, DIR)) <= 12  # 34 before: the candidates were made again for every join


@pytest.mark.parametrize("name", ["q44_plans", "q47_to_fetch", "q43_candidates"])
def test_candidates_are_dealt_by_filing_only(spark, name):
    df = plans.QUERIES[name](spark, DIR)
    text = df._jdf.queryExecution().executedPlan().toString()
    dealt = [x for x in text.splitlines() if "Exchange hashpartitioning" in x and "o_orderkey" not in x]
    assert dealt and not any("name#" in x for x in dealt)


@pytest.mark.parametrize("name", ["q41_index_items", "q42_detail_rows", "q45_cover_rows", "q49_sections", "q53_plain_tables"])
def test_narrow_tables_are_dealt_out(spark, name):
    text = plans.QUERIES[name](spark, DIR)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in text


def test_names_that_come_again(spark):
    index = lambda *items: '{"directory": {"name": "d", "item": [' + ", ".join('{"name": "%s", "type": "t", "size": "%s"}' % x for x in items) + "]}}"
    rows = [("a", index(("x", 1), ("y", 2), ("x", 1))), ("b", index(("x", 1), ("x", 2), ("index.json", 3))), ("c", index(("x", 1))), ("c", index(("z", 3), ("x", 4))), ("d", "[]"), ("d", "no"), ("e", "﻿" + index(("x", 1))), ("f", "﻿﻿" + index(("x", 1)))]
    got = selection.index_items(spark.createDataFrame(rows, "filing_id string, body string"), ["filing_id"], "body").collect()
    assert sorted((r.filing_id, r.name or "", r.place if r.place is not None else -1, r.size or "", r.problem or "") for r in got) == [("a", "x", 0, "1", ""), ("a", "y", 1, "2", ""), ("b", "x", 0, "1", "conflict"), ("c", "x", 0, "1", "conflict"), ("c", "z", 0, "3", ""), ("d", "", -1, "", "not_an_index"), ("e", "x", 0, "1", ""), ("f", "", -1, "", "not_an_index")]


def test_two_detail_rows_of_a_file(spark):
    filings = spark.createDataFrame([("f", "0000000001", "0000000001-24-000001", "10-K", "m.htm")], "filing_id string, cik string, accession string, form string, primary_document string")
    index = spark.createDataFrame([("f", '{"directory": {"name": "d", "item": [{"name": "m.htm"}, {"name": "a.htm"}, {"name": "b.htm"}]}}')], "filing_id string, body string")
    link = lambda n, said: f'<tr><td>1</td><td>{said}</td><td><a href="{n}">{n}</a></td><td>EX-1</td></tr>'
    page = '<table class="tableFile">' + link("a.htm", "z") + link("a.htm", "b") + link("b.htm", "same") + link("b.htm", "same") + link("nav.htm", "n") + "</table>"
    details = selection.detail_lists(spark.createDataFrame([("f", page)], "filing_id string, body string"), ["filing_id"], "body", F.lit("/d/"))
    sheet = selection.sheets(filings, selection.index_lists(index, ["filing_id"], "body"), details)
    got = {r.name: (r.description, r.in_detail, r.conflict, r.is_primary) for r in selection.candidates(sheet).collect()}
    assert got == {"m.htm": (None, False, False, True), "a.htm": ("b", True, True, False), "b.htm": ("same", True, False, False)}
    (plan,) = selection.plans(sheet).collect()
    assert plan.problem == "a file with two detail rows" and plan.selected == ["m.htm"]


class _Calls(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.calls = []

    def handle_starttag(self, tag, attrs):
        self.calls.append(("start", tag, attrs, self.getpos() if tag == "tr" else None))

    def handle_endtag(self, tag):
        self.calls.append(("end", tag))

    def handle_data(self, data):
        if self.calls and self.calls[-1][0] == "data":
            self.calls[-1] = ("data", self.calls[-1][1] + data)
        else:
            self.calls.append(("data", data))


def test_tags_are_told_as_the_library_tells_them():
    parts = ["<tr>", "<TD>", "</td>", "</tr>", "<table class=\"a b\">", "<a href=\"x\">", "</a>", "\n", "text ", "&amp; ", "&lt;b", " > ", "<br/>", "<b", "<!-- c -->", "<a href='q'>", "<a href=\"x&amp;y\">", "<script>", "</script>", "<p\n id=\"é\">", "< tr>", "&", "\r\n", "</td >", "<td x>", "<a\n  HREF=\"u\">"]
    rng = random.Random(3)
    for _ in range(3000):
        source = "".join(rng.choices(parts[: rng.choice((12, len(parts)))], k=rng.randint(0, 12)))
        whole = _Calls()
        whole.feed(source)
        whole.close()
        assert tags.parsed(_Calls, source, frozenset(("tr",))).calls == whole.calls, source


def test_plain_tables_do_not_go_through_the_library(monkeypatch):
    page = '<table class="tableFile">' + '<tr><td>1</td><td><a href="a.htm">a</a></td></tr>' * 3 + "</table>"
    monkeypatch.setattr(HTMLParser, "feed", lambda self, data: pytest.fail("the library read a plain page"))
    assert len(selection.table_rows(page, "tablefile")) == 3


def test_names_safe_at_a_glance_and_nulls(spark):
    from ledgerlode.functions import urls

    names = ["a.htm", "a..b", ".a", "a.", ".", "", "a.htm\n", "a b.htm", "a/b", "a%2e%2eb", "a%zz", "é.htm", "a-b_c.d", None]
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", urls.safe_filename(F.col("n")).alias("s"), selection.clearly_nonfinancial(F.col("n")).alias("f"), selection.generic_exhibit(F.col("n"), F.col("n")).alias("g"))
    got = df.collect()
    assert [r.n for r in got if r.s is not None] == ["a.htm", ".a", "a.", "a b.htm", "é.htm", "a-b_c.d"]
    assert all(r.f is False and r.g is False for r in got)
