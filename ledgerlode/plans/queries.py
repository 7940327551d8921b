"""One query for each operator of the engine over the shared tables, with the SQL that says the same.

Every query is (Spark callable, DuckDB SQL); the SQL is None where SQL has no such operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlode import cli
from ledgerlode.functions import dates, identity, text, urls
from ledgerlode.operators import catalog, markup, selection, validation
from ledgerlode.plans import filings

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return add


@query(
    "q01_coalesce",
    """SELECT sha256(text) AS text_sha256, count(*) AS n_rows,
  CASE WHEN count(DISTINCT nullif(lang, '')) > 1 OR count(DISTINCT nullif(source, '')) > 1 THEN NULL ELSE max(nullif(lang, '')) END AS lang,
  CASE WHEN count(DISTINCT nullif(lang, '')) > 1 OR count(DISTINCT nullif(source, '')) > 1 THEN NULL ELSE max(nullif(source, '')) END AS source,
  count(DISTINCT nullif(lang, '')) > 1 OR count(DISTINCT nullif(source, '')) > 1 AS conflict
FROM documents GROUP BY 1""",
)
def q01(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("text_sha256"), "lang", "source")
    return catalog.coalesce_rows(docs, ["text_sha256"], ["lang", "source"]).select("text_sha256", "n_rows", "lang", "source", "conflict")


@query(
    "q02_clean",
    r"""SELECT doc_id, regexp_replace(array_to_string(list_transform(string_split_regex(text, '\r\n|[\n\x{b}\x{c}\r\x{1c}\x{1d}\x{1e}\x{85}\x{2028}\x{2029}]'),
  lambda x: trim(regexp_replace(x, '[ \t\x{1f}\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}]+', ' ', 'g'))), chr(10)), '^[\n ]+|[\n ]+$', '', 'g') AS cleaned FROM documents""",
)
def q02(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", text.clean(F.col("text")).alias("cleaned"))


@query("q03_numbers")
def q03(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents")
    return docs.select("doc_id", F.posexplode(text.numbers(F.col("text"))).alias("place", "number"), text.keeps_numbers(F.col("text"), text.clean(F.col("text"))).alias("kept"))


#: The type of a block by its text in lower case; a word ends where no letter, digit or underscore goes on.
_TYPE = r"""CASE WHEN contains(low, 'balance sheet') OR contains(low, 'income statement') OR contains(low, 'cash flow') OR contains(low, 'statement of operations') OR contains(low, 'statement of comprehensive') THEN 'financial_statement'
  WHEN regexp_matches(low, '(^|[^\p{L}\p{N}_])note\s+\d+($|[^\p{L}\p{N}_])') OR starts_with(low, 'notes to') THEN 'note' WHEN regexp_matches(low, '(^|[^\p{L}\p{N}_])(item|part)\s+[0-9ivx]+($|[^\p{L}\p{N}_])') THEN 'other_context' ELSE 'unknown' END"""
#: A phrase that decides a type, or nearly does, put before every other text.
_LEADS = ("", "Consolidated Balance Sheets: ", "see Note 12 on ", "Notes to all ", "under Item 7a or ", "footnote 3 and items 2 ", "(PART IV) ", "Statement of  operations ")
_LEAD = "['" + "', '".join(_LEADS) + "']"


@query(
    "q04_classify",
    f"""WITH b AS (SELECT 'doc' AS origin, CAST(doc_id AS VARCHAR) AS id, lower({_LEAD}[CAST(doc_id % 8 AS INTEGER) + 1] || text) AS low FROM documents
  UNION ALL SELECT 'turn', conv_id || '-' || turn, lower(text) FROM conversations)
SELECT origin, id, {_TYPE} AS block_type FROM b WHERE low IS NOT NULL UNION ALL SELECT origin, id, 'unknown' FROM b WHERE low IS NULL""",
)
def q04(spark, sf_dir):
    lead = F.element_at(F.array(*map(F.lit, _LEADS)), (F.col("doc_id") % 8 + 1).cast("int"))
    docs = _t(spark, sf_dir, "documents").select(F.lit("doc").alias("origin"), F.col("doc_id").cast("string").alias("id"), F.concat(lead, "text").alias("text"))
    turns = _t(spark, sf_dir, "conversations").select(F.lit("turn"), F.concat_ws("-", "conv_id", "turn"), "text")
    return docs.union(turns).select("origin", "id", text.block_type(F.col("text"), F.lit("text")).alias("block_type"))


_LINES = r"string_split_regex(text, '\r\n|[\n\x{b}\x{c}\r\x{1c}\x{1d}\x{1e}\x{85}\x{2028}\x{2029}]')"
_LINE = r"trim(regexp_replace(l, '[ \t\x{1f}\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}]+', ' ', 'g'))"


@query(
    "q05_blocks",
    f"""WITH s AS (SELECT doc_id, unnest({_LINES}) AS l, unnest(range(len({_LINES}))) AS p FROM documents),
c AS (SELECT doc_id, p, {_LINE} AS text FROM s)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY p) - 1 AS INTEGER) AS order_index, {_TYPE.replace("low", "lower(text)")} AS block_type, text
FROM c WHERE text <> ''""",
)
def q05(spark, sf_dir):
    return samples(spark, sf_dir).select("doc_id", F.inline("blocks"))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested sample for each document: ordered, typed, nonblank blocks; a null text has none. No shuffle: a document's lines stay in its row."""
    blocks = F.filter(F.transform(F.split(F.coalesce("text", F.lit("")), text.LINE_END), text.clean_line), lambda x: x != "")
    typed = F.transform(blocks, lambda x, i: F.struct(i.alias("order_index"), text.block_type(x, F.lit("text")).alias("block_type"), x.alias("text")))
    return _t(spark, sf_dir, "documents").select("doc_id", "source", typed.alias("blocks"))


@query(
    "q06_shards",
    """WITH n AS (SELECT coalesce(CAST(year(o_orderdate) AS VARCHAR), 'unknown') AS year, row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderkey) AS n FROM orders)
SELECT year, CAST((n - 1) // 500 AS BIGINT) AS part, count(*) AS n_rows FROM n GROUP BY ALL""",
)
def q06(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", dates.shard_year(F.to_date("o_orderdate")).alias("year"))
    return validation.shard_sizes(orders, "year", 500)


@query(
    "q08_identity_checks",
    """SELECT 'unknown_id' AS problem, doc_id AS id, 1::BIGINT AS n FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)
UNION ALL SELECT 'missing_id', doc_id, 1 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT 'duplicate_id', doc_id, count(*) FROM labels GROUP BY doc_id HAVING count(*) > 1""",
)
def q08(spark, sf_dir):
    return validation.identity_problems(_t(spark, sf_dir, "labels").select(F.col("doc_id").alias("id")), _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("id")))


@query(
    "q09_latest_version",
    """SELECT 'conversation' AS origin, conv_id AS key, max(turn) AS version, max_by(role, turn) AS latest FROM conversations GROUP BY conv_id
UNION ALL SELECT 'user', user_id, max(event_id), max_by(event_type, event_id) FROM events GROUP BY user_id""",
)
def q09(spark, sf_dir):
    turns = catalog.latest(_t(spark, sf_dir, "conversations"), ["conv_id"], "turn", ["role"])
    events = catalog.latest(_t(spark, sf_dir, "events"), ["user_id"], "event_id", ["event_type"])
    return turns.select(F.lit("conversation").alias("origin"), F.col("conv_id").alias("key"), F.col("turn").alias("version"), F.col("role").alias("latest")).union(events.select(F.lit("user"), "user_id", "event_id", "event_type"))


_SESSIONS = "s AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE isodow(o_orderdate) < 6)"


@query(
    "q10_next_session",
    f"""WITH {_SESSIONS} SELECT o_orderkey, CAST(o_orderdate AS DATE) AS filed, (SELECT min(d) FROM s WHERE d > CAST(o_orderdate AS DATE)) AS session FROM orders""",
)
def q10(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("filed"))
    sessions = orders.select(F.col("filed").alias("session")).where(F.weekday("session") < 5).distinct()
    return catalog.next_session(orders, sessions, "filed").select("o_orderkey", "filed", "session")


@query(
    "q11_identifiers",
    """WITH x AS (SELECT CAST(c_custkey AS VARCHAR) AS raw, c_name AS name FROM customer UNION ALL SELECT 'CIK' || s_suppkey, s_name FROM supplier UNION ALL SELECT s_name, s_name FROM supplier),
n AS (SELECT raw, name, CASE WHEN regexp_full_match(raw, '(CIK)?[0-9]{1,10}') THEN lpad(replace(raw, 'CIK', ''), 10, '0') END AS cik FROM x)
SELECT raw, name, cik, CASE WHEN cik IS NOT NULL THEN cik || ':' || cik || '-24-000001' END AS filing FROM n""",
)
def q11(spark, sf_dir):
    customers = _t(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("raw"), F.col("c_name").alias("name"))
    suppliers = _t(spark, sf_dir, "supplier")
    raw = customers.union(suppliers.select(F.concat(F.lit("CIK"), "s_suppkey"), "s_name")).union(suppliers.select("s_name", "s_name"))
    cik = identity.cik10(F.col("raw"))
    return raw.withColumn("cik", cik).withColumn("filing", identity.filing_id(F.col("cik"), F.concat("cik", F.lit("-24-000001"))))


@query("q12_document_id", """SELECT page_id, sha256(CAST(to_json(['document-v1', CAST(page_id AS VARCHAR), url]) AS VARCHAR)) AS document_id FROM pages""")
def q12(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", identity.inventory_document_id(F.col("page_id").cast("string"), F.col("url")).alias("document_id"))


@query("q13_content_id", """SELECT doc_id, substr(sha256(coalesce(CAST(doc_id AS VARCHAR), '') || chr(0) || coalesce(lang, '') || chr(0) || coalesce(source, '')), 1, 32) AS content_id FROM documents""")
def q13(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", identity.content_id(F.col("doc_id"), F.col("lang"), F.col("source")).alias("content_id"))


@query("q14_html_blocks")
def q14(spark, sf_dir):
    pages = _t(spark, sf_dir, "pages").select("page_id", F.col("html").alias("content"))
    return markup.block_rows(markup.content(pages, ["page_id"]), ["page_id"])


@query("q15_visible_text")
def q15(spark, sf_dir):
    pages = _t(spark, sf_dir, "pages").select("page_id", F.col("html").alias("content"))
    parsed = markup.content(pages, ["page_id"])
    return parsed.select("page_id", F.size("blocks").alias("n_blocks"), "covered_chars", "hidden", F.exists("blocks", lambda b: b["text"].contains("track(")).alias("has_script"))


@query("q16_text_blocks")
def q16(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content"))
    return markup.block_rows(markup.content(docs, ["doc_id"]), ["doc_id"])


@query(
    "q16_paragraphs",
    f"""WITH s AS (SELECT doc_id, unnest({_LINES}) AS l, unnest(range(1, len({_LINES}) + 1)) AS p FROM documents),
g AS (SELECT doc_id, p, l, {_LINE} = '' AS blank, count_if({_LINE} = '') OVER (PARTITION BY doc_id ORDER BY p) AS g FROM s)
SELECT doc_id, CAST(min(p) AS INTEGER) AS first, string_agg(l, chr(10) ORDER BY p) AS text FROM g WHERE NOT blank GROUP BY doc_id, g""",
)
def q16p(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", F.inline(text.paragraphs(F.coalesce("text", F.lit("")))))


@query(
    "q22_url_parts",
    r"""SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page,
  nullif(regexp_extract(url, '([^/?#]+)(?:[?#].*)?$', 1), '') AS basename FROM pages""",
)
def q22(spark, sf_dir):
    part = lambda p: F.nullif(F.regexp_extract("url", p, 1), F.lit(""))
    return _t(spark, sf_dir, "pages").select("page_id", urls.url_host(F.col("url")).alias("host"), part("[?&]page=([^&#]*)").alias("page"), part(r"([^/?#]+)(?:[?#].*)?$").alias("basename"))


@query(
    "q24_plan_status",
    """WITH p AS (SELECT l_orderkey, bool_or(l_returnflag = 'R') AS review, bool_or(l_linestatus = 'F') AS strong, ['10-K', '6-K', '40-F'][CAST(l_orderkey % 3 AS INTEGER) + 1] AS form FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, form, CASE WHEN form = '10-K' THEN 'selected_financial' WHEN review THEN 'needs_review' WHEN strong THEN 'selected_financial' WHEN form = '6-K' THEN 'non_financial' ELSE 'needs_review' END AS status FROM p""",
)
def q24(spark, sf_dir):
    form = F.element_at(F.array(*map(F.lit, ("10-K", "6-K", "40-F"))), (F.col("l_orderkey") % 3 + 1).cast("int"))
    plans = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.bool_or(F.col("l_returnflag") == "R").alias("review"), F.bool_or(F.col("l_linestatus") == "F").alias("strong")).withColumn("form", form)
    return plans.select("l_orderkey", "form", selection.plan_status(F.col("form"), F.col("review"), F.col("strong")).alias("status"))


@query(
    "q25_verified_bytes",
    """SELECT 'doc' AS origin, doc_id AS id, sha256(text) AS sha256, octet_length(encode(text)) AS byte_size, n_chars = length(text) AS verified FROM documents
UNION ALL SELECT 'page', page_id, sha256(html), octet_length(encode(html)), true FROM pages""",
)
def q25(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select(F.lit("doc").alias("origin"), F.col("doc_id").alias("id"), F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("long").alias("byte_size"), (F.col("n_chars") == F.length("text")).alias("verified"))
    pages = _t(spark, sf_dir, "pages").select(F.lit("page"), "page_id", F.sha2("html", 256).alias("sha256"), F.octet_length("html").cast("long"), F.lit(True))
    return docs.union(pages)


@query("q27_pending", """SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)""")
def q27(spark, sf_dir):
    done = _t(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return catalog.pending(_t(spark, sf_dir, "documents").select("doc_id", "source"), done, ["doc_id"])


@query("q28_json", """SELECT event_id, json_extract_string(props, '$.' || k) AS value, k AS key FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)""")
def q28(spark, sf_dir):
    props = F.from_json("props", "map<string,string>")
    return _t(spark, sf_dir, "events").select("event_id", F.explode(props).alias("key", "value")).select("event_id", "value", "key")


@query(
    "q29_parallel_arrays",
    """SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS INTEGER) AS place, event_id, event_type FROM events""",
)
def q29(spark, sf_dir):
    listed = F.sort_array(F.collect_list(F.struct("event_id", "event_type")))
    arrays = _t(spark, sf_dir, "events").groupBy("user_id").agg(listed.alias("l")).select("user_id", F.col("l.event_id").alias("event_id"), F.col("l.event_type").alias("event_type"))
    return catalog.unnest_parallel(arrays, ["user_id"], ["event_id", "event_type"])


@query(
    "q30_first_seen",
    """WITH f AS (SELECT user_id, event_type, min(event_id) AS e FROM events GROUP BY ALL) SELECT user_id, string_agg(event_type, ',' ORDER BY e) AS kinds FROM f GROUP BY user_id""",
)
def q30(spark, sf_dir):
    first = _t(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("e"))  # at most one row for each type
    kinds = F.transform(F.sort_array(F.collect_list(F.struct("e", "event_type"))), lambda x: x.event_type)
    return first.groupBy("user_id").agg(F.array_join(kinds, ",").alias("kinds"))


@query(
    "q31_ordered_limit",
    """(SELECT 'order' AS origin, o_orderkey AS id, CAST(o_orderdate AS DATE) AS filed FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100)
UNION ALL (SELECT 'doc', doc_id, NULL FROM documents ORDER BY doc_id LIMIT 50)""",
)
def q31(spark, sf_dir):
    orders = cli.chosen(spark, _t(spark, sf_dir, "orders"), None, 100, ["o_orderdate", "o_orderkey"]).select(F.lit("order").alias("origin"), F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").alias("filed"))
    docs = cli.chosen(spark, _t(spark, sf_dir, "documents"), None, 50, ["doc_id"])
    return orders.union(docs.select(F.lit("doc"), "doc_id", F.lit(None).cast("date")))


@query(
    "q32_strict_dates",
    """WITH r AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%-m-%-d') WHEN 2 THEN strftime(o_orderdate, '%Y-02-30') ELSE '' END AS raw FROM orders)
SELECT o_orderkey, raw, CASE WHEN regexp_full_match(raw, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN TRY_CAST(raw AS DATE) END AS filed,
  CASE WHEN regexp_full_match(raw, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN CAST(TRY_CAST(raw AS DATE) + 1 AS DATE) END AS end_exclusive FROM r""",
)
def q32(spark, sf_dir):
    k, d = F.col("o_orderkey") % 4, F.col("o_orderdate")
    raw = F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "yyyy-M-d")).when(k == 2, F.date_format(d, "yyyy-'02-30'")).otherwise("")
    filed = dates.iso_date(F.col("raw"))
    return _t(spark, sf_dir, "orders").select("o_orderkey", raw.alias("raw")).withColumn("filed", filed).withColumn("end_exclusive", dates.exclusive_end(F.col("filed")))


@query("q33_backoff", """SELECT n_nationkey, CAST(n_nationkey % 8 + 1 AS INTEGER) AS attempt, least(0.5 * pow(2.0, n_nationkey % 8), 8.0)::DOUBLE AS seconds FROM nation""")
def q33(spark, sf_dir):
    attempt = (F.col("n_nationkey") % 8 + 1).cast("int")
    return _t(spark, sf_dir, "nation").select("n_nationkey", attempt.alias("attempt"), dates.backoff(attempt).alias("seconds"))


@query("q34_resume", """SELECT event_type, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id FROM events GROUP BY event_type""")
def q34(spark, sf_dir):
    from ledgerlode.streaming import resume

    return resume.drained(spark, sf_dir).groupBy("event_type").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


@query(
    "q35_fingerprint",
    """WITH h AS (SELECT source, sha256(text) AS h FROM documents), p AS (SELECT source, substr(h, 1, 4) AS k, count(*) AS n, sha256(string_agg(h, ',' ORDER BY h)) AS d FROM h GROUP BY ALL)
SELECT source, CAST(sum(n) AS BIGINT) AS n, sha256(string_agg(d, ',' ORDER BY k)) AS fingerprint FROM p GROUP BY source""",
)
def q35(spark, sf_dir):
    hashed = _t(spark, sf_dir, "documents").select("source", F.sha2("text", 256).alias("h"))
    # digests of digests: no task holds more than 1/65536 of a source, and the second level has at most 65536 rows
    parts = hashed.groupBy("source", F.substring("h", 1, 4).alias("k")).agg(F.count("*").alias("n"), F.sha2(F.array_join(F.sort_array(F.collect_list("h")), ","), 256).alias("d"))
    listed = F.transform(F.sort_array(F.collect_list(F.struct("k", "d"))), lambda x: x.d)
    return parts.groupBy("source").agg(F.sum("n").alias("n"), F.sha2(F.array_join(listed, ","), 256).alias("fingerprint"))


QUERIES |= filings.QUERIES
ORACLE |= filings.ORACLE
