"""Queries for the filing operators, over filings, indexes, pages and documents made of the shared tables.

What is made of a table is made the same way in SQL; the SQL then says by its own rule what
the operator must give.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlode.functions import identity, shapes, urls
from ledgerlode.operators import catalog, markup, samples, selection, validation
from ledgerlode.sources import fetch, universe
from ledgerlode.streaming.resume import shared_folder

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of a narrow table for each task that makes and parses documents of its rows: about 100,000 of them.
NARROW = 2 << 20


def _dealt(spark: SparkSession, sf_dir: str, name: str, key: str, *more: str) -> DataFrame:
    """Columns of a table dealt out by its key: its rows are narrow, and what is made of one and parsed takes far longer than reading it.

    There are as many tasks as a shuffle has, and more where the table is large, so a task's
    share doesn't grow with it.
    """
    rows = _t(spark, sf_dir, name)
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return rows.select(key, *more).repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // NARROW)), key)


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return add


#: Filings, one an order, and their files, six each; ``v`` says what a file is.
_FILINGS = """f AS (SELECT o_orderkey AS k, lpad(CAST(o_custkey + 1 AS VARCHAR), 10, '0') AS cik, lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || '-24-' || lpad(CAST(o_orderkey % 1000000 AS VARCHAR), 6, '0') AS accession,
  ['10-K', '6-K', '40-F', '20-F/A', '10-Q', '6-K'][CAST(o_orderkey % 6 AS INTEGER) + 1] AS form FROM orders),
n AS (SELECT *, cik || ':' || accession AS filing_id FROM f)"""
_FILES = (
    _FILINGS
    + """,
x AS (SELECT *, unnest(range(0, 6)) AS p FROM n),
y AS (SELECT *, CASE WHEN p = 0 THEN 99 ELSE CAST((k * (p + 1) + k // 9 + p) % 9 AS INTEGER) END AS v FROM x),
z AS (SELECT *, CASE v WHEN 99 THEN 'main.htm' WHEN 0 THEN 'ex99-' || p || '.htm' WHEN 1 THEN 'agr-' || p || '.htm' WHEN 2 THEN 'plain-' || p || '.htm' WHEN 3 THEN 'earnings-' || p || '.txt' WHEN 4 THEN 'other-' || p || '.PDF' WHEN 5 THEN 'x-' || p || '.xsd' WHEN 6 THEN 'pic-' || p || '.jpg' WHEN 7 THEN 'mda-' || p || '.htm' ELSE 'data-' || p || '_cal.xml' END AS name,
  CASE v WHEN 99 THEN form WHEN 0 THEN 'EX-99.1' WHEN 1 THEN 'EX-99.2' WHEN 2 THEN 'EX-99.3' WHEN 5 THEN 'EX-101.SCH' WHEN 7 THEN 'GRAPHIC' END AS type,
  CASE v WHEN 99 THEN CASE WHEN k % 4 = 0 THEN 'Annual  Report' END WHEN 0 THEN 'Interim Financial Statements' WHEN 1 THEN 'Credit Agreement' WHEN 7 THEN 'Management''s discussion and analysis' END AS description,
  v <> 8 AND NOT (v = 99 AND k % 11 = 0) AS in_detail FROM y),
c AS (SELECT *, CASE WHEN v = 99 THEN 'primary' WHEN v = 0 THEN 'exhibit' WHEN v = 1 THEN 'non_financial' WHEN v = 2 THEN 'unknown_exhibit' WHEN v = 3 THEN 'weak_name' WHEN v = 4 THEN 'uncertain' WHEN v = 5 THEN 'schema' WHEN v = 6 THEN 'other'
  WHEN v = 7 THEN CASE WHEN form = '6-K' THEN 'uncertain' ELSE 'exhibit' END ELSE 'linkbase' END AS class FROM z)"""
)


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, cik, accession, form, filing_id, primary_document): one filing an order."""
    k = F.col("o_orderkey")
    digits = lambda x, n: F.lpad(x.cast("string"), n, "0")
    forms = F.array(*map(F.lit, ("10-K", "6-K", "40-F", "20-F/A", "10-Q", "6-K")))
    out = _dealt(spark, sf_dir, "orders", "o_orderkey", "o_custkey").select(k.alias("k"), digits(F.col("o_custkey") + 1, 10).alias("cik"), F.concat(digits(k, 10), F.lit("-24-"), digits(k % 1000000, 6)).alias("accession"), F.element_at(forms, (k % 6 + 1).cast("int")).alias("form"))
    return out.withColumn("filing_id", identity.filing_id(F.col("cik"), F.col("accession"))).withColumn("primary_document", F.lit("main.htm"))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filings with files, an array of the six of each: place p, kind v, name, type, description, in_detail."""
    k, form = F.col("k"), F.col("form")

    def one(p, v):
        named = {99: ("main.htm", None), 0: ("ex99-", ".htm"), 1: ("agr-", ".htm"), 2: ("plain-", ".htm"), 3: ("earnings-", ".txt"), 4: ("other-", ".PDF"), 5: ("x-", ".xsd"), 6: ("pic-", ".jpg"), 7: ("mda-", ".htm"), 8: ("data-", "_cal.xml")}
        pick = lambda values: F.coalesce(*(F.when(v == n, x) for n, x in values.items()), F.lit(None).cast("string"))
        name = pick({n: F.lit(a) if b is None else F.concat(F.lit(a), p.cast("string"), F.lit(b)) for n, (a, b) in named.items()})
        kind = pick({99: form, 0: F.lit("EX-99.1"), 1: F.lit("EX-99.2"), 2: F.lit("EX-99.3"), 5: F.lit("EX-101.SCH"), 7: F.lit("GRAPHIC")})
        said = pick({99: F.when(k % 4 == 0, "Annual  Report"), 0: F.lit("Interim Financial Statements"), 1: F.lit("Credit Agreement"), 7: F.lit("Management's discussion and analysis")})
        return F.struct(p.alias("p"), v.alias("v"), name.alias("name"), kind.alias("type"), said.alias("description"), ((v != 8) & ~((v == 99) & (k % 11 == 0))).alias("in_detail"))

    v = lambda p: F.when(p == 0, 99).otherwise(((k * (p + 1) + F.floor(k / 9) + p) % 9).cast("int"))
    return filings(spark, sf_dir).withColumn("files", F.transform(F.sequence(F.lit(0), F.lit(5)), lambda p: urls.let(v(p), lambda x: one(p, x))))


def indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(filing_id, directory, index, detail): the inventory of each filing as it would be fetched, as text."""
    listed = files(spark, sf_dir).withColumn("directory", fetch.directory_path())
    item = lambda f: F.struct(f["name"].alias("name"), F.lit("text.gif").alias("type"), f["p"].cast("string").alias("size"))
    link = lambda f: F.concat(F.lit('<tr><td>'), f["p"].cast("string"), F.lit("</td><td>"), F.coalesce(f["description"], F.lit("")), F.lit('</td><td><a href="'), F.col("directory"), f["name"], F.lit('">'), f["name"], F.lit("</a></td><td>"), F.coalesce(f["type"], F.lit("")), F.lit("</td></tr>"))
    index = F.to_json(F.struct(F.struct(F.substring("directory", 2, 1000).alias("name"), F.concat(F.transform("files", item), F.array(F.struct(F.lit("index.json").alias("name"), F.lit("text.gif").alias("type"), F.lit("").alias("size")))).alias("item")).alias("directory")))
    links = F.transform(F.filter("files", lambda f: f["in_detail"]), link)
    detail = F.concat(F.lit('<table><tr><td><a href="/nav">x</a></td></tr></table><table class="tableFile" summary="Files">'), F.array_join(links, ""), F.lit("</table>"))
    return listed.select("filing_id", "directory", index.alias("index"), detail.alias("detail"))


def sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = indexes(spark, sf_dir)
    items = selection.index_lists(made, ["filing_id"], "index", F.col("directory"))
    details = selection.detail_lists(made, ["filing_id"], "detail", F.col("directory"))
    return selection.sheets(filings(spark, sf_dir), items, details)


@query("q36_owned_key", """WITH k AS (SELECT c_custkey AS id, CASE c_custkey % 6 WHEN 0 THEN 'submissions:' || c_custkey WHEN 1 THEN 'submissions:CIK' || c_custkey WHEN 2 THEN 'submissions-page:' || c_custkey || ':p.json' WHEN 3 THEN 'submissions-page:' || c_custkey || ':' WHEN 4 THEN 'companyfacts:' || c_custkey ELSE 'submissions:' || c_name END AS key FROM customer)
SELECT id, CASE id % 6 WHEN 0 THEN 'submissions' WHEN 1 THEN 'submissions' WHEN 2 THEN 'submissions-page' END AS kind, CASE WHEN id % 6 < 3 THEN lpad(CAST(id AS VARCHAR), 10, '0') END AS cik, CASE WHEN id % 6 = 2 THEN 'p.json' END AS name FROM k""")
def q36(spark, sf_dir):
    c = F.col("c_custkey").cast("string")
    forms = [F.concat(F.lit("submissions:"), c), F.concat(F.lit("submissions:CIK"), c), F.concat(F.lit("submissions-page:"), c, F.lit(":p.json")), F.concat(F.lit("submissions-page:"), c, F.lit(":")), F.concat(F.lit("companyfacts:"), c), F.concat(F.lit("submissions:"), "c_name")]
    keys = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.element_at(F.array(*forms), (F.col("c_custkey") % 6 + 1).cast("int")).alias("key"))
    own = keys.select("id", catalog.owned_key(F.col("key")).alias("o"))
    return own.select("id", "o.kind", "o.cik", "o.name")


@query("q37_safe_path", """WITH p AS (SELECT s_suppkey AS id, CASE s_suppkey % 8 WHEN 0 THEN 'a/' || s_suppkey || '.json' WHEN 1 THEN '/a/' || s_suppkey WHEN 2 THEN 'a/../' || s_suppkey WHEN 3 THEN 'a\\b' WHEN 4 THEN 'data/raw/sec/financials/' || s_suppkey || '.json' WHEN 5 THEN './' || s_suppkey WHEN 6 THEN '' ELSE 'a..b/' || s_suppkey END AS path FROM supplier)
SELECT id, id % 8 IN (0, 4, 7) AS safe, CASE WHEN id % 8 = 4 THEN id || '.json' ELSE path END AS below FROM p""".replace("\\\\", "\\"))
def q37(spark, sf_dir):
    s = F.col("s_suppkey").cast("string")
    forms = [F.concat(F.lit("a/"), s, F.lit(".json")), F.concat(F.lit("/a/"), s), F.concat(F.lit("a/../"), s), F.lit("a\\b"), F.concat(F.lit("data/raw/sec/financials/"), s, F.lit(".json")), F.concat(F.lit("./"), s), F.lit(""), F.concat(F.lit("a..b/"), s)]
    path = F.element_at(F.array(*forms), (F.col("s_suppkey") % 8 + 1).cast("int"))
    return _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), catalog.safe_path(path).alias("safe"), catalog.below_cache(path).alias("below"))


#: Submission payloads: a customer's orders as parallel arrays (main or page), as a table, or ragged.
_PAYLOADS = """o AS (SELECT o_custkey AS c, o_orderkey AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS place, strftime(o_orderdate, '%Y-%m-%d') AS filed FROM orders)"""


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(c, kind, content): four shapes of payload by customer."""
    k = F.col("o_orderkey").cast("string")
    row = F.struct("o_orderkey", F.concat(F.lpad(k, 10, "0"), F.lit("-24-"), F.lpad((F.col("o_orderkey") % 1000000).cast("string"), 6, "0")).alias("a"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"), F.when(F.col("o_orderkey") % 3 == 0, "10-K").otherwise("8-K").alias("f"))
    listed = _t(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c")).agg(F.sort_array(F.collect_list(row)).alias("r"))
    arrays = {"accessionNumber": "a", "filingDate": "d", "form": "f"}
    take = lambda m: lambda x: x[m]
    parts = [F.transform("r", take(m)).alias(n) for n, m in arrays.items()]
    empty = F.transform("r", lambda x: F.lit("")).alias("reportDate")
    short = F.slice(F.transform("r", lambda x: F.lit("")), 1, F.size("r") - 1).alias("reportDate")
    main = F.to_json(F.struct(F.struct(F.struct(*parts, empty).alias("recent")).alias("filings")))
    ragged = F.to_json(F.struct(F.struct(F.struct(*parts, short).alias("recent")).alias("filings")))
    page = F.to_json(F.struct(*parts, empty))
    table = F.to_json(F.struct(F.array(*map(F.lit, arrays)).alias("fields"), F.transform("r", lambda x: F.array(x["a"], x["d"], x["f"])).alias("data")))
    shape = F.col("c") % 4
    return listed.select("c", F.when(shape.isin(0, 3), "submissions").otherwise("submissions-page").alias("kind"), F.when(shape == 0, main).when(shape == 1, page).when(shape == 2, table).otherwise(ragged).alias("content"))


@query(
    "q38_submission_rows",
    f"""WITH {_PAYLOADS} SELECT c, CAST(place AS INTEGER) AS place, lpad(CAST(k AS VARCHAR), 10, '0') || '-24-' || lpad(CAST(k % 1000000 AS VARCHAR), 6, '0') AS accession, filed, CASE WHEN k % 3 = 0 THEN '10-K' ELSE '8-K' END AS form, NULL::VARCHAR AS problem FROM o WHERE c % 4 < 3
UNION ALL SELECT DISTINCT c, NULL, NULL, NULL, NULL, 'ragged' FROM o WHERE c % 4 = 3""",
)
def q38(spark, sf_dir):
    rows = catalog.submission_rows(payloads(spark, sf_dir), ["c", "kind"], "content", F.col("kind") == "submissions")
    return rows.select("c", "place", F.col("accessionNumber").alias("accession"), F.col("filingDate").alias("filed"), "form", "problem")


def cache(spark: SparkSession, sf_dir: str) -> str:
    """A cache of one submission index a nation in the shared folder, its files written by Spark, and its manifest.

    Each nation's customers are filings; of every fifth nation's record the hash is another's, every
    seventh has an older version beside the newest.
    """
    root = f"{shared_folder(spark)}/cache-{uuid.uuid4().hex}"
    c = F.col("c_custkey").cast("string")
    form = F.element_at(F.array(*map(F.lit, ("10-K", "8-K", "20-F"))), (F.col("c_custkey") % 3 + 1).cast("int"))
    date = F.when(F.col("c_custkey") % 10 == 9, "2024-02-30").otherwise("2024-02-28")
    row = F.struct("c_custkey", F.concat(F.lpad(c, 10, "0"), F.lit("-24-000001")).alias("a"), date.alias("d"), form.alias("f"))
    listed = _t(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n")).agg(F.sort_array(F.collect_list(row)).alias("r"))
    part = lambda m, n: F.transform("r", lambda x: x[m]).alias(n)
    body = F.to_json(F.struct(F.struct(F.struct(part("a", "accessionNumber"), part("d", "filingDate"), part("f", "form")).alias("recent")).alias("filings")))
    listed.select("n", body.alias("value")).write.partitionBy("n").text(f"{root}/files")
    landed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").load(f"{root}/files")
    n = F.regexp_extract("path", "/n=([0-9]+)/", 1).cast("int")
    entries = landed.select(n.alias("n"), F.regexp_extract("path", "/files/(.*)$", 1).alias("path"), F.sha2("content", 256).alias("sha256"), F.octet_length("content").cast("long").alias("byte_size"))
    record = F.struct("path", F.when(F.col("n") % 5 == 4, F.sha2(F.col("n").cast("string"), 256)).otherwise(F.col("sha256")).alias("sha256"), "byte_size", F.lit("u").alias("url"), F.lit("done").alias("status"))
    older = F.struct(F.lit("gone.txt").alias("path"), F.lit("").alias("sha256"), F.lit(0).cast("long").alias("byte_size"), F.lit("u").alias("url"), F.lit("done").alias("status"))
    versions = F.when(F.col("n") % 7 == 0, F.array(older, record)).otherwise(F.array(record))
    pairs = entries.select(F.concat(F.lit("submissions:"), F.col("n").cast("string")).alias("key"), versions.alias("v"))
    manifest = pairs.agg(F.to_json(F.struct(F.map_from_entries(F.collect_list(F.struct("key", "v"))).alias("resources"))).alias("value"))  # one row a nation
    manifest.write.text(f"{root}/manifest")
    return root


_SCAN = "s AS (SELECT lpad(CAST(c_nationkey AS VARCHAR), 10, '0') AS cik, lpad(CAST(c_custkey AS VARCHAR), 10, '0') || '-24-000001' AS accession, ['10-K', '8-K', '20-F'][CAST(c_custkey % 3 AS INTEGER) + 1] AS form, c_custkey % 10 = 9 AS bad, c_nationkey % 5 = 4 AS changed FROM customer)"


@query("q39_scan_cache", f"""WITH {_SCAN} SELECT cik || ':' || accession AS filing_id, form, '2024-02-28' AS filed_date, NULL::VARCHAR AS report_date FROM s WHERE NOT bad AND NOT changed AND form <> '8-K'""")
def q39(spark, sf_dir):
    root = cache(spark, sf_dir)
    found = catalog.scan_cached_filings(spark, f"{root}/files", manifest=f"{root}/manifest")
    return found["filings"].select("filing_id", "form", "filed_date", "report_date")


@query("q40_scan_flaws", f"""WITH {_SCAN} SELECT 'skipped' AS flaw, CAST(CAST(cik AS BIGINT) AS VARCHAR) AS key, 1::BIGINT AS n FROM s WHERE changed GROUP BY cik UNION ALL SELECT 'invalid', cik, count(*) FROM s WHERE bad AND NOT changed AND form <> '8-K' GROUP BY cik""")
def q40(spark, sf_dir):
    root = cache(spark, sf_dir)
    found = catalog.scan_cached_filings(spark, f"{root}/files", manifest=f"{root}/manifest")
    skipped = found["skipped"].where("problem = 'changed'").select(F.lit("skipped").alias("flaw"), F.regexp_extract("logical_key", "([0-9]+)$", 1).alias("key"), F.lit(1).cast("long").alias("n"))
    return skipped.union(found["invalid"].select(F.lit("invalid"), "cik", "count"))


@query("q41_index_items", f"""WITH {_FILES} SELECT filing_id, p AS place, name, 'text.gif' AS type, CAST(p AS VARCHAR) AS size, NULL::VARCHAR AS problem FROM z""")
def q41(spark, sf_dir):
    items = selection.index_items(indexes(spark, sf_dir), ["filing_id", "directory"], "index", F.col("directory"))
    return items.select("filing_id", F.col("place").cast("long").alias("place"), "name", "type", "size", "problem")


@query("q42_detail_rows", f"""WITH {_FILES} SELECT filing_id, name, CAST(p AS VARCHAR) AS sequence, type, regexp_replace(description, ' +', ' ', 'g') AS description FROM z WHERE in_detail""")
def q42(spark, sf_dir):
    return selection.detail_rows(indexes(spark, sf_dir), ["filing_id"], "detail", F.col("directory")).select("filing_id", "name", "sequence", "type", "description")


@query(
    "q43_candidates",
    f"""WITH {_FILES} SELECT filing_id, name, class, class IN ('primary', 'exhibit', 'schema', 'linkbase') AS selected,
  CASE WHEN class IN ('primary', 'exhibit', 'schema', 'linkbase') THEN 'required' WHEN class IN ('non_financial', 'other') THEN 'out_of_scope' ELSE 'candidate' END AS status,
  CASE WHEN class IN ('primary', 'exhibit', 'schema', 'linkbase') THEN class ELSE 'other' END AS role, in_detail,
  sha256('["document-v1","' || filing_id || '","https://www.sec.gov/Archives/edgar/data/' || CAST(cik AS BIGINT) || '/' || replace(accession, '-', '') || '/' || name || '"]') AS document_id FROM c""",
)
def q43(spark, sf_dir):
    return selection.candidates(sheets(spark, sf_dir)).select("filing_id", "name", "class", "selected", "status", "role", "in_detail", "document_id")


_PLANS = """g AS (SELECT filing_id, any_value(k) AS k, any_value(form) AS form, count_if(class = 'unknown_exhibit') AS u, count_if(class = 'weak_name') AS w, count_if(class = 'uncertain') AS t, count_if(class = 'non_financial') AS o, count_if(class = 'exhibit') > 0 OR (any_value(k) % 4 = 0 AND any_value(k) % 11 <> 0) AS strong, any_value(k) % 11 <> 0 AS seen,
  count_if(class IN ('primary', 'exhibit', 'schema', 'linkbase')) AS n_selected FROM c GROUP BY filing_id),
r AS (SELECT *, u + w + t + CASE WHEN form = '40-F' AND NOT strong THEN 1 ELSE 0 END + CASE WHEN form = '6-K' AND NOT strong AND (u + w + t > 0 OR o = 0) THEN 1 ELSE 0 END + CASE WHEN seen THEN 0 ELSE 1 END AS n_review,
  o + CASE WHEN form = '6-K' AND NOT strong AND u + w + t = 0 AND o > 0 THEN 1 ELSE 0 END AS n_said FROM g),
s AS (SELECT *, CASE WHEN form IN ('10-K', '10-Q', '20-F/A') THEN 'selected_financial' WHEN n_review > 0 THEN 'needs_review' WHEN strong THEN 'selected_financial' WHEN form = '6-K' THEN 'non_financial' ELSE 'needs_review' END AS status FROM r)"""


@query("q44_plans", f"""WITH {_FILES}, {_PLANS} SELECT filing_id, form, status, CASE WHEN status = 'selected_financial' AND n_review + n_said = 0 THEN 1 ELSE n_review + n_said END AS n_reasons, n_selected FROM s""")
def q44(spark, sf_dir):
    plans = selection.plans(sheets(spark, sf_dir))
    return plans.select("filing_id", "form", "status", F.size("reasons").cast("long").alias("n_reasons"), F.size("selected").cast("long").alias("n_selected"))


def covers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(filing_id, directory, content): covers with a table that links each unknown exhibit under a financial title, and each schema under another."""
    row = lambda f: F.concat(F.lit("<tr><td>Exhibit 99."), f["p"].cast("string"), F.lit("</td><td>"), F.when(f["v"] == 2, "Audited <b>Annual  Report</b>").otherwise("Taxonomy"), F.lit('</td><td><a href="'), f["name"], F.lit('">open</a></td></tr>'))
    body = F.array_join(F.transform(F.filter("files", lambda f: f["v"].isin(2, 5)), row), "")
    made = files(spark, sf_dir).select("filing_id", fetch.directory_path().alias("directory"), body.alias("rows")).where("rows <> ''")
    return made.select("filing_id", "directory", F.concat(F.lit("<html><body><table>"), "rows", F.lit("</table></body></html>")).alias("content"))


@query("q45_cover_rows", f"""WITH {_FILES} SELECT filing_id, '99.' || p AS exhibit, CASE WHEN v = 2 THEN 'Audited Annual Report open' ELSE 'Taxonomy open' END AS title, name, 1 AS cell FROM z WHERE v IN (2, 5)""")
def q45(spark, sf_dir):
    rows = selection.cover_rows(covers(spark, sf_dir), ["filing_id"], "content", F.col("directory"))
    return rows.select("filing_id", "exhibit", "title", F.col("names")[0].alias("name"), "cell")


@query(
    "q46_refined_plans",
    f"""WITH {_FILES}, {_PLANS},
h AS (SELECT s.*, u AS up, CASE WHEN status = 'non_financial' THEN (SELECT count(*) FROM z WHERE z.filing_id = s.filing_id AND v = 5) ELSE 0 END AS unresolved,
  w + t + CASE WHEN seen THEN 0 ELSE 1 END + CASE WHEN u = 0 THEN n_review - u - w - t - CASE WHEN seen THEN 0 ELSE 1 END ELSE 0 END AS left_over FROM s)
SELECT filing_id, CASE WHEN form IN ('10-K', '10-Q', '20-F/A') THEN status WHEN up > 0 AND left_over = 0 AND unresolved = 0 THEN 'selected_financial' WHEN up > 0 OR unresolved > 0 THEN 'needs_review' ELSE status END AS status,
  n_selected + CASE WHEN form IN ('10-K', '10-Q', '20-F/A') THEN 0 ELSE up END AS n_selected FROM h""",
)
def q46(spark, sf_dir):
    plans = selection.plans(sheets(spark, sf_dir), keep=True)
    refined = selection.refined(plans, selection.cover_rows(covers(spark, sf_dir), ["filing_id"], "content", F.col("directory")))
    return refined.select("filing_id", "status", F.size("selected").cast("long").alias("n_selected"))


@query("q47_to_fetch", f"""WITH {_FILES} SELECT filing_id, name, class AS role, CASE WHEN p = 0 THEN -1 ELSE p END AS place FROM c WHERE class IN ('primary', 'exhibit', 'schema', 'linkbase')""")
def q47(spark, sf_dir):
    return selection.to_fetch(selection.candidates(sheets(spark, sf_dir))).select("filing_id", "name", "role", F.col("place").cast("long").alias("place"))


#: Descriptions: a part's type with one of fifty phrases, some financial, some of other papers, some neither.
_SAID = ["Financial Statements", "Consolidated Financial  Statements", "earnings RELEASE", "Results of Operations", "return on equity and assets ratios", "Annual Financial Report", "MD&A", "MD&A for the year ended", "Management's Discussion and Analysis, Q3", "credit agreement and financial statements", "Code of Conduct", "Clawback Policy of the annual report", "power of attorney", "press release", "financial information", "interim report"]
_KEYS = ["financial statements", "consolidated financial statements", "consolidated statements", "interim financial statements", "interim condensed financial statements", "annual report", "quarterly report", "interim report", "financial results", "results of operations", "financial review", "earnings release", "earnings news release", "quarterly earnings", "return on equity and assets ratios", "annual financial report", "financial information"]


def _sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


@query(
    "q23_phrase_rules",
    f"""WITH d AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN '10-Q' ELSE '6-K' END AS form, lower(regexp_replace(p_type || '  ' || {_sql_list(_SAID)}[CAST(p_partkey % 16 AS INTEGER) + 1], ' +', ' ', 'g')) AS said FROM part),
e AS (SELECT *, list_filter({_sql_list(_KEYS)}, lambda x: contains(said, x)) AS found, contains(said, 'credit agreement') OR contains(said, 'code of conduct') OR contains(said, 'clawback policy') AS other,
  (contains(said, 'md&a') OR contains(said, 'management''s discussion and analysis')) AND (form = '10-Q' OR regexp_matches(said, '\\b(q[1-4]|quarter(ly)?|annual|interim|fiscal|year +ended|20[0-9][0-9])\\b')) AS discussed FROM d)
SELECT p_partkey, CASE WHEN other THEN NULL WHEN len(found) > 0 THEN found[1] WHEN discussed THEN 'management''s discussion and analysis in annual/quarterly context' END AS evidence, other AS non_financial FROM e""",
)
def q23(spark, sf_dir):
    said = F.concat("p_type", F.lit("  "), F.element_at(F.array(*map(F.lit, _SAID)), (F.col("p_partkey") % 16 + 1).cast("int")))
    part = _t(spark, sf_dir, "part").select("p_partkey", said.alias("said"), F.when(F.col("p_partkey") % 2 == 0, "10-Q").otherwise("6-K").alias("form"))
    return part.select("p_partkey", selection.strong_evidence(F.col("said"), F.col("form")).alias("evidence"), selection.clearly_nonfinancial(F.col("said")).alias("non_financial"))


@query(
    "q48_xbrl_roles",
    """SELECT p_partkey, CASE p_partkey % 9 WHEN 0 THEN 'schema' WHEN 1 THEN NULL WHEN 2 THEN 'linkbase' WHEN 3 THEN 'xbrl_instance' WHEN 4 THEN 'xbrl_instance' WHEN 5 THEN 'linkbase' WHEN 6 THEN 'xbrl_instance' WHEN 7 THEN NULL ELSE 'schema' END AS role,
  p_partkey % 9 IN (0, 1, 2, 7) AS generic FROM part""",
)
def q48(spark, sf_dir):
    cases = [("EX-101.SCH", "a.txt", None), ("EX-101.ODD", "a_cal.xml", None), ("ex101.pre", "b", None), ("EX - 101.INS", "c", None), ("XML", "d.xml", "EXTRACTED  XBRL instance document "), (None, "e_TAG.xml", None), ("", "f_ins.xml", None), ("EX-31", "g_ref.xml", None), (None, "h.XSD", None)]
    k = (F.col("p_partkey") % 9 + 1).cast("int")
    pick = lambda i: F.element_at(F.array(*(F.lit(c[i]).cast("string") for c in cases)), k)
    return _t(spark, sf_dir, "part").select("p_partkey", selection.xbrl_role(pick(0), pick(1), pick(2)).alias("role"), selection.generic_exhibit(pick(0), pick(1)).alias("generic"))


@query(
    "q18_data_table",
    r"""WITH c AS (SELECT l_orderkey, [CASE WHEN l_orderkey % 5 = 0 THEN 'Item ' || l_linenumber ELSE l_returnflag || l_linenumber END, '(', CASE WHEN l_quantity > 25 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) ELSE '' END, ')', CASE WHEN l_discount > 0.05 AND l_orderkey % 5 > 0 THEN '$ ' || CAST(CAST(l_extendedprice AS BIGINT) AS VARCHAR) ELSE '1999' END, CASE WHEN l_tax > 0.07 THEN '48%' ELSE '(1)' END] AS cells FROM lineitem),
h AS (SELECT l_orderkey, cells, list_filter(cells, lambda x: x NOT IN ('', '$', '%', '(', ')')) AS held FROM c),
n AS (SELECT *, list_filter(held, lambda x: regexp_full_match(x, '[$(]*\s*[-+]?\s*\$?\s*([0-9][0-9,]*(\.[0-9]+)?|\.[0-9]+)\s*%?\s*\)?\s*%?') AND NOT regexp_full_match(x, '(19|20)[0-9][0-9]') AND NOT regexp_full_match(x, '\(?[0-9]{1,2}\)|[0-9]{1,2}\.')) AS numbers FROM h),
r AS (SELECT l_orderkey, len(numbers) AS k, len(list_filter(numbers, lambda x: regexp_matches(x, '^[$(]|%$'))) > 0 AS marked, len(list_filter(held, lambda x: regexp_matches(x, '(?i)^(item|part)\s'))) > 0 AS titled, len(list_filter(cells, lambda x: starts_with(x, '$'))) > 0 AS money, len(list_filter(numbers, lambda x: NOT regexp_full_match(x, '[0-9]{1,3}(-[0-9]{1,3})?'))) = 0 AS pages FROM n)
SELECT l_orderkey, (count_if(k >= 2) > 0 OR count_if(k >= 1) >= 2 OR (count_if(k >= 1) = 1 AND bool_or(marked))) AND NOT (bool_or(titled) AND NOT bool_or(money) AND bool_and(pages)) AS data_table, count(*) AS n_rows FROM r GROUP BY l_orderkey""",
)
def q18(spark, sf_dir):
    n = F.col("l_linenumber").cast("string")
    cells = F.array(
        F.when(F.col("l_orderkey") % 5 == 0, F.concat(F.lit("Item "), n)).otherwise(F.concat("l_returnflag", n)),
        F.lit("("),
        F.when(F.col("l_quantity") > 25, F.col("l_quantity").cast("long").cast("string")).otherwise(""),
        F.lit(")"),
        F.when((F.col("l_discount") > 0.05) & (F.col("l_orderkey") % 5 > 0), F.concat(F.lit("$ "), F.rint("l_extendedprice").cast("long").cast("string"))).otherwise("1999"),
        F.when(F.col("l_tax") > 0.07, "48%").otherwise("(1)"),
    )
    return shapes.data_tables(_t(spark, sf_dir, "lineitem").select("l_orderkey", cells.alias("cells")), ["l_orderkey"], "cells")


_KIND = r"""CASE WHEN regexp_matches(regexp_replace(body, '(?is)<pre\b[^>]*>(.*?)</pre\s*>', ' ', 'g'), '(?i)<t[rd]\b') THEN 'html' WHEN regexp_matches(body, '(?i)<pre\b') AND regexp_matches(body, '(?i)<(!doctype\s+html|html\b|body\b)') THEN 'html_pre'
  WHEN regexp_matches(body, '(?m)^[ \t]*<(PAGE|TABLE|S|C)>[ \t]*\r?$') THEN 'legacy_text' WHEN regexp_matches(body, '(?i)<(!doctype\s+html|html\b|head\b|body\b|div\b|p[\s>]|span\b|table\b|ix:[A-Za-z0-9_.-]+\b)') THEN 'html' ELSE 'legacy_text' END"""
_BODIES = "SELECT 'page' AS origin, page_id AS id, html AS body FROM pages UNION ALL SELECT 'doc', doc_id, CASE doc_id % 5 WHEN 0 THEN '<PAGE>' || chr(10) || text WHEN 1 THEN '<html><pre>' || text || '<td></pre>' WHEN 2 THEN ' <page>' || chr(10) || text WHEN 3 THEN 'x <S> y' || text ELSE '<p>' || text END FROM documents"


@query("q19_payload_kind", f"""SELECT origin, id, {_KIND} AS kind FROM ({_BODIES})""")
def q19(spark, sf_dir):
    pages = _t(spark, sf_dir, "pages").select(F.lit("page").alias("origin"), F.col("page_id").alias("id"), F.col("html").alias("body"))
    forms = [F.concat(F.lit("<PAGE>\n"), "text"), F.concat(F.lit("<html><pre>"), "text", F.lit("<td></pre>")), F.concat(F.lit(" <page>\n"), "text"), F.concat(F.lit("x <S> y"), "text"), F.concat(F.lit("<p>"), "text")]
    docs = _t(spark, sf_dir, "documents").select(F.lit("doc"), "doc_id", F.element_at(F.array(*forms), (F.col("doc_id") % 5 + 1).cast("int")))
    return pages.union(docs).select("origin", "id", markup.payload_kind(F.col("body")).alias("kind"))


#: Envelopes around documents: sound ones, and six ways to be none.
_PAYLOAD = "coalesce(nullif(trim(coalesce(text, ''), chr(10) || ' '), ''), 'x')"


@query(
    "q20_envelopes",
    f"""WITH d AS (SELECT doc_id, {_PAYLOAD} AS body, 48 + length(CAST(doc_id AS VARCHAR)) AS head FROM documents)
SELECT doc_id, CASE doc_id % 8 WHEN 6 THEN 'bare' WHEN 0 THEN 'ok' WHEN 1 THEN 'ok' ELSE 'bad' END AS status, CASE doc_id % 8 WHEN 2 THEN 'no type' WHEN 3 THEN 'repeated header' WHEN 4 THEN 'unsupported header' WHEN 5 THEN 'content after the closing lines' WHEN 7 THEN 'no closing lines' END AS problem,
  CASE WHEN doc_id % 8 < 2 THEN 'EX-13' END AS type, CASE WHEN doc_id % 8 < 2 THEN 'doc' || doc_id || '.txt' END AS filename, CASE WHEN doc_id % 8 < 2 THEN sha256(body || chr(10)) END AS payload_sha256, CASE WHEN doc_id % 8 < 2 THEN head END AS start, CASE WHEN doc_id % 8 < 2 THEN head + octet_length(encode(body)) + 1 END AS "end" FROM d""",
)
def q20(spark, sf_dir):
    body = F.coalesce(F.nullif(F.trim(F.coalesce("text", F.lit("")), F.lit("\n ")), F.lit("")), F.lit("x"))
    d = F.col("doc_id").cast("string")
    head = lambda kind, more="": F.concat(F.lit(f"<DOCUMENT>\n<TYPE>{kind}\n{more}<FILENAME>doc"), d, F.lit(".txt\n<TEXT>\n"))
    tail = F.lit("\n</TEXT>\n</DOCUMENT>\n")
    docs = _t(spark, sf_dir, "documents").withColumn("body", body)
    good = F.concat(head("EX-13"), "body", tail)
    forms = [good, F.concat(good, F.lit(" \n")), F.concat(head(" "), "body", tail), F.concat(head("EX-13", "<type>x\n"), "body", tail), F.concat(head("EX-13", "<COLOR>x\n"), "body", tail), F.concat(good, F.lit("more\n")), F.col("body"), F.concat(head("EX-13"), "body", F.lit("\n</TEXT>\n"))]
    raw = docs.select("doc_id", F.element_at(F.array(*forms), (F.col("doc_id") % 8 + 1).cast("int")).alias("raw"))
    return markup.envelopes(raw, ["doc_id"], "raw").select("doc_id", "status", "problem", F.col("headers")["type"].alias("type"), F.col("headers")["filename"].alias("filename"), F.sha2("payload", 256).alias("payload_sha256"), "start", "end")


@query(
    "q21_url_policy",
    r"""WITH v AS (SELECT page_id, ['ok', 'scheme', 'credentials', 'port', 'host', 'query_or_fragment', 'traversal', 'percent', 'nested_escapes', 'ok', 'traversal', 'control_character'][CAST(page_id % 12 AS INTEGER) + 1] AS problem, url FROM pages)
SELECT 'made' AS origin, page_id, problem FROM v UNION ALL
SELECT 'own', page_id, CASE WHEN url IS NULL OR url = '' OR regexp_matches(url, '[\x00-\x1f\x7f]') THEN 'control_character' WHEN contains(url, '?') OR contains(url, '#') THEN 'query_or_fragment' WHEN regexp_matches(regexp_replace(url, '%[0-9a-fA-F]{2}', '', 'g'), '%') THEN 'percent' WHEN NOT regexp_matches(url, '(?i)^https://') THEN 'scheme'
  WHEN lower(regexp_extract(url, '^[A-Za-z]+://(?:[^/?#@]*@)?([^/?#:]*)', 1)) NOT IN ('data.sec.gov', 'www.sec.gov') THEN 'host' ELSE 'ok' END FROM pages""",
)
def q21(spark, sf_dir):
    made = ["https://www.sec.gov/a/{}", "http://www.sec.gov/{}", "https://u:p@www.sec.gov/{}", "https://data.sec.gov:8080/{}", "https://example.com/{}", "https://www.sec.gov/{}?x", "https://www.sec.gov/%2e%2E/{}", "https://www.sec.gov/%zz{}", "https://www.sec.gov/%25252525252e{}", "HTTPS://DATA.SEC.GOV:443/{}", "https://www.sec.gov/a%252f..%5c{}", "https://www.sec.gov/a\t{}"]
    url = F.replace(F.element_at(F.array(*map(F.lit, made)), (F.col("page_id") % 12 + 1).cast("int")), F.lit("{}"), F.col("page_id").cast("string"))
    pages = _t(spark, sf_dir, "pages")
    return pages.select(F.lit("made").alias("origin"), "page_id", urls.url_problem(url).alias("problem")).union(pages.select(F.lit("own"), "page_id", urls.url_problem(F.col("url"))))


@query(
    "q49_sections",
    """WITH d AS (SELECT c_custkey AS id, c_custkey % 15 AS i FROM customer), b AS (
SELECT id, 0 AS ordinal, 'PART II' AS text, NULL::VARCHAR AS item_code, 1 AS line_start FROM d UNION ALL SELECT id, 1, 'Some words', NULL, 3 FROM d UNION ALL SELECT id, 2, 'Item ' || i || CASE WHEN id % 2 = 0 THEN 'a' ELSE '' END || '. Title', CAST(i AS VARCHAR) || CASE WHEN id % 2 = 0 THEN 'A' ELSE '' END, 5 FROM d
UNION ALL SELECT id, 3, 'One line' || chr(10) || 'item 3 inside', CAST(i AS VARCHAR) || CASE WHEN id % 2 = 0 THEN 'A' ELSE '' END, 6 FROM d UNION ALL SELECT id, 4, 'Item 123', '12', 9 FROM d UNION ALL SELECT id, 5, 'part iv, the end', NULL, 11 FROM d) SELECT * FROM b""",
)
def q49(spark, sf_dir):
    own = F.concat(F.lit("PART II\n\nSome words\n\nItem "), (F.col("c_custkey") % 15).cast("string"), F.when(F.col("c_custkey") % 2 == 0, "a").otherwise(""), F.lit(". Title\nOne line\nitem 3 inside\n\nItem 123\n\npart iv, the end\n"))
    made = _dealt(spark, sf_dir, "customer", "c_custkey").select(F.col("c_custkey").alias("id"), own.alias("content"))
    return markup.block_rows(markup.content(made, ["id"]), ["id"]).select("id", "ordinal", "text", "item_code", "line_start")


@query(
    "q50_html_tables",
    """SELECT n_nationkey AS id, 0 AS ordinal, 'text' AS kind, n_name AS text, '/html/body/h1' AS locator FROM nation UNION ALL
SELECT n_nationkey, 1, 'table', 'Sales' || chr(10) || n_nationkey || ',000（行：Net；列：2020）' || chr(10) || '(7)（行：Net；列：2021）' || chr(10) || '$ 1,000（行：Cost；列：2020）' || chr(10) || '2,000（行：Cost；列：2021）', '/html/body/table[1]' FROM nation UNION ALL
SELECT n_nationkey, 2, 'text', 'left', '/html/body/table[2]/tr/td[1]' FROM nation UNION ALL SELECT n_nationkey, 3, 'text', 'shown', '/html/body/p[3]' FROM nation""",
)
def q50(spark, sf_dir):
    head = "<html><head><style>.gone {display : none} div p.a{color:red}</style><title>t</title></head><body><h1>"
    own = F.concat(F.lit(head), "n_name", F.lit("</h1><table><caption>Sales</caption><tr><th></th><th>2020</th><th>2021</th></tr><tr><td>Net</td><td>"), F.col("n_nationkey").cast("string"), F.lit(",000</td><td>(7)</td></tr><tr><td>Cost</td><td>$ 1,000</td><td>2,000</td></tr></table><table><tr><td>left</td><td style='Display: NONE'>right</td></tr></table><p class='x gone'>no</p><p hidden>no</p><p>shown<script>no</script></p><div aria-hidden='true'><p>no</p></div></body></html>"))
    made = _t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), own.alias("content"))
    return markup.block_rows(markup.content(made, ["id"]), ["id"]).select("id", "ordinal", "kind", "text", "locator")


#: Documents by what becomes of them: (bytes as SQL and as an expression, role, status, kind, diagnostics).
_CASES = [
    ("%PDF-1.7 x", "primary", "unsupported", "pdf", "unsupported_pdf"),
    ("<!DOCTYPE x [<!ENTITY a 'b'>]><html><p>x</p></html>", "primary", "failed", "html", "entity_declaration"),
    ("<html><body><pre>a<table>b</pre></body></html>", "exhibit", "failed", "html_pre", "html_pre_nested_markup"),
    ("<TABLE>\nCash  1,000", "primary", "partial", "legacy_text", "legacy_table_unresolved:unclosed_table:L1"),
    ("<style>p > b {display:none}</style><p>x</p>", "exhibit", "partial", "html", ""),
    ("<DOCUMENT>\nno envelope", "primary", "failed", "unknown", "sec_envelope_invalid"),
    ("<schema/>", "schema", "not_content", "xbrl", ""),
    ("anything", "other", "out_of_scope", "unknown", ""),
    ("plain words", "primary", "full", "legacy_text", ""),
    ("<DOCUMENT>\n<TYPE>10-K\n", "full_submission", "failed", "unknown", "full_submission_unbalanced"),
]


@query("q51_parser_statuses", f"""SELECT s_suppkey AS id, {_sql_list([c[2] for c in _CASES])}[CAST(s_suppkey % 10 AS INTEGER) + 1] AS status, {_sql_list([c[3] for c in _CASES])}[CAST(s_suppkey % 10 AS INTEGER) + 1] AS payload_kind, {_sql_list([c[4] for c in _CASES])}[CAST(s_suppkey % 10 AS INTEGER) + 1] AS diagnostics FROM supplier""")
def q51(spark, sf_dir):
    k = (F.col("s_suppkey") % 10 + 1).cast("int")
    pick = lambda i: F.element_at(F.array(*(F.lit(c[i]) for c in _CASES)), k)
    made = _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), pick(0).alias("content"), pick(1).alias("role"))
    return markup.content(made, ["id"], role=F.col("role"), form=F.lit("10-K")).select("id", "status", "payload_kind", F.array_join("diagnostics", ",").alias("diagnostics"))


@query(
    "q52_full_submissions",
    """SELECT n_nationkey AS id, 0 AS segment, 'full' AS status, n_name AS text FROM nation UNION ALL SELECT n_nationkey, 1, 'out_of_scope', NULL FROM nation
UNION ALL SELECT n_nationkey, 2, 'full', 'Region ' || n_regionkey FROM nation UNION ALL SELECT n_nationkey, 3, 'failed', NULL FROM nation""",
)
def q52(spark, sf_dir):
    part = lambda kind, *body: F.concat(F.lit(f"<DOCUMENT>\n<TYPE>{kind}\n<TEXT>\n"), *body, F.lit("\n</TEXT>\n</DOCUMENT>\n"))
    whole = F.concat(part("10-k", F.lit("<html><body><p>"), "n_name", F.lit("</p></body></html>")), part("EX-99", F.lit("no")), part("EX-13.1", F.lit("Region "), F.col("n_regionkey").cast("string")), F.lit("<DOCUMENT>\n<TEXT>\nx\n</TEXT>\n</DOCUMENT>\n"))
    made = _t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), whole.alias("content"))
    rows = markup.content(made, ["id"], role=F.lit("full_submission"), form=F.lit("10-K"))
    return rows.select("id", "segment", "status", F.get("blocks", F.lit(0))["text"].alias("text"))


@query(
    "q53_plain_tables",
    """WITH c AS (SELECT c_custkey AS id, CAST(c_custkey AS VARCHAR) AS n FROM customer) SELECT id, 0 AS ordinal, 'text' AS kind, 1 AS line_start, 1 AS line_end FROM c UNION ALL
SELECT id, 1, CASE WHEN id % 3 = 0 THEN 'text' ELSE 'table' END, 3, 6 FROM c UNION ALL SELECT id, 2, 'text', 9, 9 FROM c""",
)
def q53(spark, sf_dir):
    n = F.col("c_custkey").cast("string")
    long = "Words before the table that are together over one hundred characters long, so that this line is in no table at all."
    values = F.when(F.col("c_custkey") % 3 == 0, "of the year").otherwise("$ 1,200    (300)")
    own = F.concat(F.lit(long + "\n\n"), F.lit("            2020      2021\nNet        "), n, F.lit("     "), values, F.lit("\nCost       "), n, F.lit("     "), values, F.lit("\nOther      "), n, F.lit("     "), values, F.lit("\n\n\n" + long + "\n"))
    made = _dealt(spark, sf_dir, "customer", "c_custkey").select(F.col("c_custkey").alias("id"), own.alias("content"))
    return markup.block_rows(markup.content(made, ["id"]), ["id"]).select("id", "ordinal", "kind", "line_start", "line_end")


@query(
    "q54_encodings",
    """SELECT p_partkey AS id, ['utf-8', 'utf-8-sig', 'iso-8859-1', 'utf-16-le'][CAST(p_partkey % 4 AS INTEGER) + 1] AS encoding, 'é ' || p_name AS text FROM part""",
)
def q54(spark, sf_dir):
    page = F.concat(F.lit("<html><head><meta charset='iso-8859-1'></head><body><p>é "), "p_name", F.lit("</p></body></html>"))
    bare = F.concat(F.lit("<html><body><p>é "), "p_name", F.lit("</p></body></html>"))
    k = F.col("p_partkey") % 4
    mark = lambda code, x: F.unhex(F.concat(F.lit(code), F.hex(x)))
    # UTF-16 holds zero bytes, which only the encoding rule itself is asked about
    raw = F.when(k == 0, F.encode(bare, "utf-8")).when(k == 1, mark("EFBBBF", F.encode(bare, "utf-8"))).when(k == 2, F.encode(page, "iso-8859-1")).otherwise(mark("FFFE", F.encode(bare, "utf-16le")))
    made = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), raw.alias("content"))
    return markup.decoded_pages(made, ["id"], "content").select("id", "encoding", F.trim(F.regexp_extract("text", "<p>(.*)</p>", 1)).alias("text"))


@query(
    "q55_build_samples",
    """WITH n AS (SELECT n_nationkey AS k, n_name, n_regionkey FROM nation)
SELECT lpad(CAST(k AS VARCHAR), 10, '0') AS filing_id, CASE WHEN k % 5 = 4 THEN 'skipped' ELSE 'emitted' END AS status, CASE WHEN k % 5 = 4 THEN 0 ELSE 4 END AS block_count, CASE WHEN k % 5 = 4 THEN 0 ELSE 1 END AS table_count,
  CASE WHEN k % 5 = 4 THEN 'full' WHEN k % 5 = 3 THEN 'partial' ELSE 'full' END AS content_status, CASE WHEN k % 5 = 4 THEN 'unknown' WHEN k % 5 = 3 OR k % 2 = 1 THEN 'partial' ELSE 'complete' END AS coverage_status,
  CASE WHEN k % 5 = 4 THEN NULL ELSE 'other_context,financial_statement,note,unknown' END AS block_types FROM n""",
)
def q55(spark, sf_dir):
    k = F.col("n_nationkey")
    style = F.when(k % 5 == 3, "<style>a > b {visibility: hidden}</style>").otherwise("")
    main = F.concat(style, F.lit("<h1>Item 1. Business of "), "n_name", F.lit("</h1><table><tr><td>Cash</td><td>1,000</td><td>2,000</td></tr></table>"))
    docs = _t(spark, sf_dir, "nation").withColumn("filing_id", F.lpad(k.cast("string"), 10, "0"))
    row = lambda place, role, body: docs.select("filing_id", F.col("filing_id").alias("entity_id"), F.lit("2024-01-02").cast("date").alias("filed_date"), F.lit(place).alias("place"), F.concat(F.lit("f"), F.lit(str(place))).alias("name"), F.lit(role).alias("role"), body.alias("body"), k.alias("k"))
    full = row(0, "primary", main).union(row(1, "exhibit", F.lit("Note 3 to all\n\nWords"))).where("k % 5 <> 4")
    every = full.union(row(0, "primary", F.lit("<p> </p>")).where("k % 5 = 4")).union(row(2, "schema", F.lit("<x/>"))).drop("k")
    plans = docs.where("n_nationkey % 2 = 0").select("filing_id", F.lit("selected_financial").alias("status"), F.array().cast("array<string>").alias("reasons"))
    made, said = samples.build(every, plans)
    types = made.select(F.col("sample_id").alias("filing_id"), F.array_join(F.transform("blocks", lambda b: b["block_type"]), ",").alias("block_types"))
    return said.join(types, "filing_id", "left").select("filing_id", "status", F.col("block_count").cast("int").alias("block_count"), F.col("table_count").cast("int").alias("table_count"), "content_status", "coverage_status", "block_types")


@query("q07_status_counts", """SELECT CAST(count_if(o_orderstatus = 'F') AS BIGINT) AS emitted, CAST(count_if(o_orderstatus = 'O') AS BIGINT) AS skipped, CAST(count_if(o_orderstatus = 'P') AS BIGINT) AS failed, count(*) AS total FROM orders""")
def q07(spark, sf_dir):
    status = F.element_at(F.create_map(*map(F.lit, ("F", "emitted", "O", "skipped", "P", "failed"))), F.col("o_orderstatus"))
    return validation.status_counts(_t(spark, sf_dir, "orders").select(status.alias("status")))


@query("q56_block_checks", """SELECT lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS sample_id, ['order', 'type', 'blank', 'no_blocks'][CAST(s_suppkey % 6 AS INTEGER)] AS problem FROM supplier WHERE s_suppkey % 6 BETWEEN 1 AND 4""")
def q56(spark, sf_dir):
    k = F.col("s_suppkey") % 6
    block = lambda i, t, x: F.struct(F.lit(i).alias("order_index"), F.lit(t).alias("block_type"), F.lit(x).alias("text"))
    blocks = F.when(k == 1, F.array(block(0, "note", "a"), block(2, "note", "b"))).when(k == 2, F.array(block(0, "odd", "a"))).when(k == 3, F.array(block(0, "note", " "))).when(k == 4, F.array().cast("array<struct<order_index:int,block_type:string,text:string>>")).otherwise(F.array(block(0, "unknown", "a"), block(1, "note", "b")))
    return validation.block_problems(_t(spark, sf_dir, "supplier").select(F.lpad(F.col("s_suppkey").cast("string"), 6, "0").alias("sample_id"), blocks.alias("blocks")))


@query("q57_written_shards", """SELECT coalesce(CAST(year(o_orderdate) AS VARCHAR), 'unknown') AS year, count(*) AS n_rows, true AS small, count(DISTINCT o_orderkey) AS n_ids FROM orders GROUP BY 1""")
def q57(spark, sf_dir):
    path = f"{shared_folder(spark)}/shards-{uuid.uuid4().hex}"
    block = F.array(F.struct(F.lit(0).alias("order_index"), F.lit("unknown").alias("block_type"), F.col("o_orderpriority").alias("text")))
    made = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("sample_id"), F.col("o_custkey").cast("string").alias("entity_id"), F.to_date("o_orderdate").alias("filed_date"), block.alias("blocks"))
    validation.write_samples(made, path)
    back = validation.read_samples(spark, path).withColumn("file", F.input_file_name())
    files = back.groupBy("year", "file").agg(F.count("*").alias("n"), F.count_distinct("sample_id").alias("ids"))
    return files.groupBy(F.col("year").cast("string").alias("year")).agg(F.sum("n").alias("n_rows"), (F.max("n") <= 500).alias("small"), F.sum("ids").alias("n_ids"))


@query("q58_universe", """SELECT upper(s_name) AS ticker, lpad(CAST(CASE WHEN s_suppkey % 10 = 3 THEN s_suppkey + 500 ELSE s_suppkey END AS VARCHAR), 10, '0') AS cik10, lower(n_name) AS exchange FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey = 1 AND s_suppkey % 7 > 0""")
def q58(spark, sf_dir):
    joined = _t(spark, sf_dir, "supplier").join(_t(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    data = F.when(F.col("s_suppkey") % 7 == 0, F.array(F.lit("x"), F.lit("bad"), F.col("s_name"), F.lower("n_name"))).otherwise(F.array(F.col("s_suppkey").cast("string"), F.col("s_name"), F.concat(F.lit(" "), F.lower("s_name")), F.lower("n_name")))
    body = joined.groupBy("n_nationkey").agg(F.to_json(F.struct(F.array(*map(F.lit, ("CIK", "name", "Ticker", "exchange"))).alias("fields"), F.collect_list(data).alias("data"))).alias("content"))
    names = [r[0] for r in _t(spark, sf_dir, "nation").where("n_regionkey = 1").select("n_name").collect()]
    own = _t(spark, sf_dir, "supplier").where("s_suppkey % 10 = 3").select(F.upper("s_name").alias("ticker"), F.lpad((F.col("s_suppkey") + 500).cast("string"), 10, "0").alias("cik10"))
    return universe.with_overrides(universe.listed(universe.rows(body), names), own).select("ticker", "cik10", "exchange")


@query("q59_corrected_mapping", """SELECT upper(s_name) AS ticker, lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS cik10 FROM supplier WHERE s_suppkey % 10 NOT IN (3, 4) UNION ALL SELECT upper(s_name), lpad(CAST(s_suppkey + 1 AS VARCHAR), 10, '0') FROM supplier WHERE s_suppkey % 10 = 3""")
def q59(spark, sf_dir):
    rows = _t(spark, sf_dir, "supplier").select(F.upper("s_name").alias("ticker"), F.lpad(F.col("s_suppkey").cast("string"), 10, "0").alias("cik10"), "s_suppkey")
    own = rows.where("s_suppkey % 10 = 3").select("ticker", F.lpad((F.col("s_suppkey") + 1).cast("string"), 10, "0").alias("cik10"))
    return universe.corrected(rows.drop("s_suppkey"), own)


@query("q60_shapes", r"""WITH c AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE l_partkey % 10 WHEN 0 THEN '$ 1,2' || l_suppkey WHEN 1 THEN '(' || l_suppkey || ')' WHEN 2 THEN '19' || (l_suppkey % 90 + 10) WHEN 3 THEN '.5%' WHEN 4 THEN '--' WHEN 5 THEN 'n/a' WHEN 6 THEN '1,000 (a)' WHEN 7 THEN 'Item ' || (l_suppkey % 20) || 'b. x' WHEN 8 THEN 'Part iv of it' ELSE 'words' END AS cell FROM lineitem)
SELECT DISTINCT cell, regexp_full_match(cell, '[$(]*\s*[-+]?\s*\$?\s*([0-9][0-9,]*(\.[0-9]+)?|\.[0-9]+)\s*%?\s*\)?\s*%?') AND NOT regexp_full_match(cell, '(19|20)[0-9][0-9]|\(?[0-9]{1,2}\)|[0-9]{1,2}\.') AS is_number,
  cell IN ('--', 'n/a') OR regexp_full_match(cell, '\$?\s*\(?\$?\s*([0-9][0-9,]*(\.[0-9]+)?|\.[0-9]+)\s*%?\s*\)?%?(/[0-9]{1,2}/|\s*\([a-z1-9]\))?') AS is_value, CASE WHEN starts_with(cell, 'Part') THEN 'IV' END AS part, CASE WHEN starts_with(cell, 'Item') THEN upper(regexp_extract(cell, '([0-9]+b)', 1)) END AS item FROM c""")
def q60(spark, sf_dir):
    s = F.col("l_suppkey")
    t = s.cast("string")
    cells = [F.concat(F.lit("$ 1,2"), t), F.concat(F.lit("("), t, F.lit(")")), F.concat(F.lit("19"), (s % 90 + 10).cast("string")), F.lit(".5%"), F.lit("--"), F.lit("n/a"), F.lit("1,000 (a)"), F.concat(F.lit("Item "), (s % 20).cast("string"), F.lit("b. x")), F.lit("Part iv of it"), F.lit("words")]
    rows = _t(spark, sf_dir, "lineitem").select(F.element_at(F.array(*cells), (F.col("l_partkey") % 10 + 1).cast("int")).alias("cell")).distinct()
    own = shapes.section_of(F.col("cell"))
    return rows.select("cell", shapes.number_cell(F.col("cell")).alias("is_number"), shapes.value_field(F.col("cell")).alias("is_value"), own["part"].alias("part"), own["item"].alias("item"))


@query("q61_file_names", """SELECT p_partkey, p_partkey % 8 IN (0, 7) AS safe, CASE p_partkey % 8 WHEN 0 THEN 'a%20' || p_partkey || '.htm' WHEN 7 THEN 'it%27s~' || p_partkey || '%2A.htm' END AS encoded FROM part""")
def q61(spark, sf_dir):
    n = F.col("p_partkey").cast("string")
    cases = [F.concat(F.lit("a "), n, F.lit(".htm")), F.concat(F.lit("a.."), n), F.concat(F.lit("b/"), n), F.concat(F.lit("%2e%2e"), n), F.concat(F.lit("%2"), F.lit("z"), n), F.concat(F.lit("c%252fd"), n), F.lit(""), F.concat(F.lit("it's~"), n, F.lit("*.htm"))]
    name = urls.safe_filename(F.element_at(F.array(*cases), (F.col("p_partkey") % 8 + 1).cast("int")))
    return _t(spark, sf_dir, "part").select("p_partkey", name.isNotNull().alias("safe"), urls.encoded(name).alias("encoded"))


@query("q62_resumed", """SELECT o_orderkey FROM orders WHERE o_orderstatus NOT IN ('F', 'O')""")
def q62(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").alias("filing_id"), F.element_at(F.create_map(*map(F.lit, ("F", "emitted", "O", "failed", "P", "running"))), F.col("o_orderstatus")).alias("status"))
    return samples.resume(orders.select("o_orderkey", "filing_id"), orders.select("filing_id", "status")).select("o_orderkey")


@query("q63_content_status", """SELECT l_orderkey, CASE WHEN bool_or(l_returnflag = 'R') THEN 'partial' ELSE 'full' END AS content_status FROM lineitem GROUP BY l_orderkey""")
def q63(spark, sf_dir):
    status = F.element_at(F.create_map(*map(F.lit, ("R", "unsupported", "A", "full", "N", "not_content"))), F.col("l_returnflag"))
    return selection.content_status(_t(spark, sf_dir, "lineitem").select("l_orderkey", status.alias("status")), ["l_orderkey"])


@query("q64_collected_blocks", """SELECT n_nationkey AS id, 0 AS ordinal, 'note' AS block_type, 'See note 2 on ' || n_name AS text, true AS kept FROM nation UNION ALL SELECT n_nationkey, 1, 'unknown', 'Paid $ 1,200.50' || chr(10) || 'and (300)', true FROM nation""")
def q64(spark, sf_dir):
    made = _t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.concat(F.lit("  See   note 2\t on "), "n_name", F.lit("\n\nPaid  $ 1,200.50 \n and (300)\n\n​\n")).alias("content"))
    return markup.collected(markup.content(made, ["id"]), ["id"]).select("id", "ordinal", "block_type", "text", "kept")
