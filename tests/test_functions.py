from pyspark.sql import functions as F

from ledgerlode.functions import dates, identity, text, urls


def column(spark, values, expression, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}").select("i", expression(F.col("v")).alias("r"))
    return [r.r for r in sorted(df.collect())]


def test_clean(spark):
    got = column(spark, ["  a​b \t c\r\n\n x  ", "", None, "\xa0", "1 2"], text.clean)
    assert got == ["ab c\n\nx", "", None, "", "1\n2"]


def test_numbers(spark):
    assert column(spark, ["in 2020, $ 1,200.5 and (300) or 48% of a1 b 2c"], text.numbers) == [["2020,", "$1,200.5", "(300)", "48%"]]


def test_block_type(spark):
    got = column(spark, ["Consolidated Balance Sheets and balance sheet", "Note 3 on leases", "Item 7. Discussion", "Plain"], lambda c: text.block_type(c, F.lit("text")))
    assert got == ["financial_statement", "note", "other_context", "unknown"]
    got = column(spark, ["a CASH FLOW of", "footnote 3", "see note 3b", "see note 3, below", "NOTES TO all", "the notes to", "under part iv of", "parts 1", "statements of operations"], lambda c: text.block_type(c, F.lit("text")))
    assert got == ["financial_statement", "unknown", "unknown", "note", "note", "unknown", "other_context", "unknown", "unknown"]
    assert column(spark, ["Plain"], lambda c: text.block_type(c, F.lit("table"))) == ["financial_statement"]


def test_paragraphs(spark):
    got = column(spark, ["\n a\nb\n\n \nc", "", "x"], text.paragraphs)
    assert [[(p.first, p.text) for p in r] for r in got] == [[(2, " a\nb"), (6, "c")], [], [(1, "x")]]


def test_identifiers(spark):
    assert column(spark, ["1", "CIK0000000042", "12345678901", "x", None, " 7 ", "cik42"], identity.cik10) == ["0000000001", "0000000042", None, None, None, "0000000007", "0000000042"]
    assert column(spark, ["0000000001-24-000002", "1-24-2", None], identity.is_accession) == [True, False, False]
    one, two = column(spark, ["", None], lambda c: identity.content_id(c, F.lit(0)))
    assert one == two and len(one) == 32
    assert column(spark, [""], lambda c: identity.content_id(c, F.lit(None)))[0] != one


def test_dates(spark):
    got = column(spark, ["2024-02-29", "2024-2-9", "2024-02-30", "", None], dates.iso_date)
    assert [str(x) if x else None for x in got] == ["2024-02-29", None, None, None, None]
    got = column(spark, ["2024-01-02T03:04:05.000Z", "2024-01-02T03:04:05", "x"], lambda c: dates.acceptance_utc(c).cast("string"))
    assert got == ["2024-01-02 03:04:05", None, None]
    assert column(spark, [1, 2, 5, 9], dates.backoff, "int") == [0.5, 1.0, 8.0, 8.0]


def test_urls(spark):
    cases = {
        "https://www.sec.gov/Archives/a.htm": "ok",
        "http://www.sec.gov/a": "scheme",
        "https://u:p@www.sec.gov/a": "credentials",
        "https://www.sec.gov:8080/a": "port",
        "https://example.com/a": "host",
        "https://www.sec.gov/a?b": "query_or_fragment",
        "https://www.sec.gov/a#b": "query_or_fragment",
        "https://www.sec.gov/%252e%252e/a": "traversal",
        "https://www.sec.gov/%25252525252e/a": "nested_escapes",
        "https://www.sec.gov/a%2": "percent",
        "HTTPS://WWW.SEC.GOV:443/a b": "ok",
        "https://www.sec.gov/a\n": "control_character",
    }
    assert column(spark, list(cases), urls.url_problem) == list(cases.values())
    assert column(spark, ["a.htm", "../a", "%2e%2e", "a%2fb", "", "a..b", "a%", "a%20b"], urls.safe_filename) == ["a.htm", None, None, None, None, None, None, "a%20b"]
