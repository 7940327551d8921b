"""From landed documents to samples: parse, clean, type, number and nest, with a diagnostic for every filing.

documents: filing_id, entity_id, filed_date, place (order in the filing), name, role, body
(text or bytes) and, for full submissions, form. Markup is parsed in one Arrow pass; the rest
is expressions and one shuffle by filing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlode.functions import identity, text
from ledgerlode.operators import markup, validation
from ledgerlode.operators.markup import NO_CONTENT_ROLES, PARSED_ROLES

__all__ = ["NO_CONTENT_ROLES", "PARSED_ROLES", "build", "build_and_publish", "committed", "parsed", "resume"]


def parsed(documents: DataFrame) -> DataFrame:
    """(filing_id, place, segment, status, …, blocks): each document's, or each segment's, parsed content with its blocks cleaned and typed.

    blocks: array of struct<block_type, text, kept>; kept is false where cleaning changed the
    sequence of numbers. Blank blocks are left out.
    """
    name = F.coalesce("name", F.lit("")) if "name" in documents.columns else F.col("place").cast("string")
    form = F.col("form") if "form" in documents.columns else None
    rows = markup.content(documents, ["filing_id", "place"], "body", F.col("role"), form, identity.builder_document_id(F.col("filing_id"), name))
    cleaned = F.filter(F.transform("blocks", lambda b: F.struct(b["kind"].alias("kind"), b["text"].alias("raw"), text.clean(b["text"]).alias("text"))), lambda b: b["text"] != "")
    typed = lambda b: F.struct(text.block_type(b["text"], b["kind"]).alias("block_type"), b["text"].alias("text"), text.keeps_numbers(b["raw"], b["text"]).alias("kept"))
    tables = F.size(F.filter("blocks", lambda b: b["kind"] == "table"))
    return rows.withColumn("table_count", tables).withColumn("blocks", F.transform(cleaned, typed))


def build(documents: DataFrame, plans: DataFrame | None = None, degraded: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """samples and diagnostics. A filing is failed if cleaning changed its numbers, skipped without blocks, else emitted.

    plans: filing_id, status, reasons; degraded: filing_id, reason of what couldn't be
    fetched. Without a plan a filing's coverage is partial.
    """
    row = F.struct("place", "segment", "status", "table_count", "visible_chars", "covered_chars", "blocks")
    listed = F.sort_array(F.collect_list(row))
    grouped = parsed(documents).groupBy("filing_id").agg(listed.alias("rows"))
    flat = F.flatten(F.transform("rows", lambda r: r["blocks"]))
    total = lambda k: F.aggregate("rows", F.lit(0).cast("long"), lambda a, r: a + F.coalesce(r[k], F.lit(0)))
    grouped = grouped.select("filing_id", flat.alias("flat"), F.transform("rows", lambda r: r["status"]).alias("parser_status"), *(total(k).alias(k) for k in ("table_count", "visible_chars", "covered_chars")))
    source = F.struct("place", "name", "role", F.sha2(F.col("body").cast("binary"), 256).alias("sha256"), F.octet_length("body").cast("long").alias("byte_size"))
    sources = F.transform(F.sort_array(F.collect_list(source)), lambda x: F.struct(*(x[k].alias(k) for k in ("name", "role", "sha256", "byte_size"))))
    filings = documents.groupBy("filing_id").agg(F.min("entity_id").alias("entity_id"), F.min("filed_date").alias("filed_date"), F.count("*").alias("n_documents"), sources.alias("sources"))
    whole = filings.join(grouped, "filing_id")
    none = F.array().cast("array<string>")
    if plans is not None:
        whole = whole.join(plans.select("filing_id", F.col("status").alias("plan"), F.col("reasons").alias("why")), "filing_id", "left")
    else:
        whole = whole.withColumn("plan", F.lit(None).cast("string")).withColumn("why", none)
    if degraded is not None:
        whole = whole.join(degraded.groupBy("filing_id").agg(F.sort_array(F.collect_list("reason")).alias("lost")), "filing_id", "left")
    else:
        whole = whole.withColumn("lost", none)
    unplanned = F.col("plan").isNotNull() & (F.col("plan") != "selected_financial")
    degradation = F.concat(F.coalesce("lost", none), F.when(unplanned, F.coalesce("why", none)).otherwise(none))
    flawed = F.exists("parser_status", lambda s: s.isin("partial", "failed", "unsupported"))
    count = F.size("flat").cast("long")
    kept = F.forall("flat", lambda b: b["kept"])
    whole = whole.withColumn("degradation", degradation).withColumn("status", F.when(~kept, "failed").when(count == 0, "skipped").otherwise("emitted")).withColumn("block_count", count)
    whole = whole.withColumn("content_status", F.when(F.size("parser_status") == 0, "unknown").when(flawed | (F.size("degradation") > 0), "partial").otherwise("full"))
    complete = (F.col("plan") == "selected_financial") & (F.col("content_status") == "full")
    coverage = F.when(unplanned, "partial").when(F.col("status") != "emitted", "unknown").when(F.coalesce(complete, F.lit(False)), "complete").otherwise("partial")
    numbered = F.transform("flat", lambda x, i: F.struct(i.alias("order_index"), x["block_type"].alias("block_type"), x["text"].alias("text")))
    samples = whole.where("status = 'emitted'").select(F.col("filing_id").alias("sample_id"), "entity_id", "filed_date", numbered.alias("blocks"))
    reason = F.when(F.col("status") == "failed", "cleaning changed numeric token sequence").when(F.col("status") == "skipped", "no extractable report body")
    diagnostics = whole.select("filing_id", F.col("filing_id").alias("sample_id"), "status", reason.alias("reason"), "sources", "parser_status", "content_status", "degradation", coverage.alias("coverage_status"), "n_documents", "block_count", "table_count", "visible_chars", "covered_chars")
    return samples, diagnostics


FINAL = ("emitted", "skipped", "failed")


def resume(documents: DataFrame, done: DataFrame) -> DataFrame:
    """Documents of filings without a final diagnostic; failed ones are final."""
    final = done.where(F.col("status").isin(*FINAL)) if "status" in done.columns else done
    return documents.join(final.select("filing_id"), "filing_id", "left_anti")


def committed(spark: SparkSession, path: str, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(samples, diagnostics) of an earlier run's committed batches under ``path``, for the filings of ``wanted`` only.

    Each batch is a folder that is there whole or not at all, as the stream's sink writes it; one
    without both parts counts as not done, and a filing without a final status as well.
    """
    schema = f"filing_id string, status string, {validation.SAMPLE.replace(' not null', '')}, diagnostic string"
    rows = spark.read.schema(schema).option("ignoreCorruptFiles", True).parquet(path).where(F.col("status").isin(*FINAL) & F.col("diagnostic").isNotNull())
    rows = rows.join(wanted.select(F.col("id").alias("filing_id")), "filing_id", "left_semi").dropDuplicates(["filing_id"])
    return rows.where("status = 'emitted'").select("sample_id", "entity_id", "filed_date", "blocks"), rows.select("filing_id", "status", "diagnostic")


def commit(samples: DataFrame, diagnostics: DataFrame, path: str) -> None:
    """Appends a batch's filings, each with its sample and diagnostic in one row, so that neither is there without the other."""
    said = diagnostics.select("filing_id", "status", F.to_json(F.struct(*diagnostics.columns)).alias("diagnostic"))
    said.join(samples, F.col("filing_id") == F.col("sample_id"), "left").select("filing_id", "status", "sample_id", "entity_id", "filed_date", "blocks", "diagnostic").write.mode("append").parquet(path)


def unfit(diagnostics: DataFrame, filings: DataFrame, documents: DataFrame, plans: DataFrame | None) -> DataFrame:
    """Failed diagnostics, in the form of ``diagnostics``, of filings whose plan has a problem or of which nothing could be fetched."""
    lost = filings.select("filing_id").distinct().join(documents.select("filing_id").distinct(), "filing_id", "left_anti").withColumn("reason", F.lit("no document could be fetched"))
    if plans is not None:
        bad = plans.where("problem is not null").groupBy("filing_id").agg(F.min("problem").alias("problem"))
        lost = filings.select("filing_id").distinct().join(bad, "filing_id").select("filing_id", F.col("problem").alias("reason")).union(lost.join(bad, "filing_id", "left_anti"))
    known = {"filing_id": F.col("filing_id"), "sample_id": F.col("filing_id"), "status": F.lit("failed"), "reason": F.col("reason"), "content_status": F.lit("unknown"), "coverage_status": F.lit("unknown")}
    empty = {"array": F.array(), "int": F.lit(0), "bigint": F.lit(0)}
    kind = lambda f: f.dataType.simpleString()
    return lost.select(*(known.get(f.name, empty.get(kind(f).split("<")[0], F.lit(None))).cast(f.dataType).alias(f.name) for f in diagnostics.schema))


def build_and_publish(spark: SparkSession, documents: DataFrame, out: str, work: str | None = None, again: bool = False, plans: DataFrame | None = None, degraded: DataFrame | None = None, filings: DataFrame | None = None) -> dict:
    """Builds what isn't committed yet under ``work`` and publishes all of it to ``out``; every one of ``filings`` gets a diagnostic."""
    filings = documents if filings is None else filings
    ids = filings.select(F.col("filing_id").alias("id")).distinct()
    every = documents
    if plans is not None:
        documents = documents.join(plans.where("problem is not null").select("filing_id"), "filing_id", "left_anti")
    work = work or f"{out}.work"
    fs, at = validation.hadoop(spark, work)
    if not again:
        fs.delete(at, True)
    todo = resume(documents, committed(spark, work, ids)[1]) if fs.exists(at) else documents
    samples, diagnostics = build(todo, plans, degraded)
    held = diagnostics.union(unfit(diagnostics, filings, every, plans)).persist()
    try:
        commit(samples, held, work)
    finally:
        held.unpersist()
    samples, said = committed(spark, work, ids)
    parts = said.select(F.from_json("diagnostic", diagnostics.schema).alias("d")).select("d.*")
    result = validation.publish(spark, samples, parts, ids, out)
    fs.delete(at, True)
    return result
