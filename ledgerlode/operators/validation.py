"""Checks of identities, nested samples and shards, and the staged publication of samples."""

from __future__ import annotations

import json
import re
from functools import reduce
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlode.functions.text import BLOCK_TYPES

BLOCKS = "array<struct<order_index:int,block_type:string,text:string>>"
SAMPLE = f"sample_id string not null, entity_id string, filed_date date, blocks {BLOCKS}"


class SampleError(ValueError):
    """Samples that fail a check."""


def identity_problems(found: DataFrame, wanted: DataFrame) -> DataFrame:
    """(problem, id, n): ids that are unknown, missing or repeated in ``found`` against ``wanted``."""
    ids = found.groupBy("id").agg(F.count("*").alias("n"))
    unknown = ids.join(wanted, "id", "left_anti").select(F.lit("unknown_id").alias("problem"), "id", F.lit(1).cast("long").alias("n"))
    missing = wanted.join(ids, "id", "left_anti").select(F.lit("missing_id"), "id", F.lit(1).cast("long"))
    return reduce(DataFrame.union, [unknown, missing, ids.where("n > 1").select(F.lit("duplicate_id"), "id", "n")])


def shard_sizes(rows: DataFrame, year: str, size: int) -> DataFrame:
    """(year, part, n_rows) of shards of ``size`` rows: the counts alone say it, so rows needn't be numbered."""
    n = rows.groupBy(year).agg(F.count("*").alias("n"))
    parts = n.select(year, "n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / size))).alias("part"))
    return parts.select(year, "part", F.least(F.lit(size).cast("long"), F.col("n") - F.col("part") * size).alias("n_rows"))


def block_problems(samples: DataFrame) -> DataFrame:
    """(sample_id, problem) of samples whose blocks aren't numbered from 0, of a known type and nonblank."""
    numbered = F.forall(F.transform("blocks", lambda b, i: b.order_index == i), lambda ok: F.coalesce(ok, F.lit(False)))
    typed = F.forall("blocks", lambda b: F.coalesce(b.block_type.isin(*BLOCK_TYPES), F.lit(False)))
    filled = F.forall("blocks", lambda b: F.coalesce(F.trim(b.text) != "", F.lit(False)))
    problem = F.when(F.col("blocks").isNull() | (F.size("blocks") == 0), "no_blocks").when(~numbered, "order").when(~typed, "type").when(~filled, "blank")
    return samples.select("sample_id", problem.alias("problem")).where("problem is not null")


#: Rows that a task writes for a year, in files of the size asked for.
TASK_ROWS = 20_000


def write_samples(samples: DataFrame, path: str, rows_per_file: int = 500) -> None:
    """Year-partitioned Parquet, at most ``rows_per_file`` rows a file; a year has as many tasks as its rows ask for, dealt by id."""
    dated = samples.withColumn("year", F.coalesce(F.year("filed_date").cast("string"), F.lit("unknown")))
    parts = [(r.year, -(-r["count"] // TASK_ROWS)) for r in dated.groupBy("year").count().collect()]  # a row a year
    salt = F.lit(0)
    if parts:
        tasks = F.create_map(*(F.lit(x) for p in parts for x in p))
        salt = F.pmod(F.xxhash64("sample_id"), F.coalesce(tasks[F.col("year")], F.lit(1)).cast("long"))
    dated.repartition("year", salt).sortWithinPartitions("year", "sample_id").write.option("maxRecordsPerFile", rows_per_file).partitionBy("year").mode("errorifexists").parquet(path)


def shard_problems(spark: SparkSession, path: str) -> DataFrame:
    """(path, problem) of shards that can't be read or whose footer has another schema than samples."""
    wanted = [("sample_id", "string"), ("entity_id", "string"), ("filed_date", "date32[day]"), ("blocks", [("order_index", "int32"), ("block_type", "string"), ("text", "string")])]

    def shape(schema):
        return [(f.name, [(x.name, str(x.type)) for x in f.type.value_type] if pa.types.is_list(f.type) and pa.types.is_struct(f.type.value_type) else str(f.type)) for f in schema]

    def read(batches):
        for batch in batches:
            found = []
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                try:
                    problem = None if shape(pq.read_schema(pa.BufferReader(data.as_buffer()))) == wanted else "schema"
                except (OSError, pa.ArrowException):
                    problem = "unreadable"
                found.append((name, problem))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.string()) for k in (0, 1)], names=["path", "problem"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    return files.select("path", "content").mapInArrow(read, "path string, problem string").where("problem is not null")


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """The samples under ``path``; a shard with another schema raises."""
    bad = shard_problems(spark, path).orderBy("path").limit(1).collect()
    if bad:
        raise SampleError(f"{bad[0].problem} of {bad[0].path}")
    return spark.read.schema(SAMPLE + ", year string").parquet(path)


def read_diagnostics(spark: SparkSession, path: str) -> DataFrame:
    """The diagnostics under ``path``; a line that isn't JSON raises."""
    lines = spark.read.text(path).where("value <> ''")
    if lines.where(F.try_parse_json("value").isNull()).limit(1).count():
        raise SampleError("diagnostics are invalid")
    return spark.read.option("mode", "FAILFAST").json(path)


def hadoop(spark: SparkSession, path: str):
    """The file system of a path and the path, as Hadoop has them."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def apart(paths: dict[str, str], protected: list[str]) -> None:
    """Raises where an output overlaps another one or a protected path, or goes through a link."""
    plain = {k: re.sub(r"^file:/*", "/", v) for k, v in paths.items()}
    for k, v in plain.items():
        if "://" not in v and (link := next((p for p in (Path(v).absolute(), *Path(v).absolute().parents) if p.is_symlink()), None)):
            raise SampleError(f"{k} goes through the link {link}")
    whole = lambda p: p.rstrip("/") if "://" in p else str(Path(p).resolve(strict=False))
    inside = lambda a, b: a == b or a.startswith(b + "/")
    done: list[tuple[str, str]] = []
    for k, v in plain.items():
        own = whole(v)
        if own == whole(".") or any(inside(own, whole(p)) or inside(whole(p), own) for p in protected) or any(own == o for _, o in done):
            raise SampleError(f"{k} {v} overlaps protected data or another output")
        done.append((k, own))


def status_counts(diagnostics: DataFrame) -> DataFrame:
    """One row: how many filings were emitted, skipped and failed, and the total."""
    return diagnostics.agg(*(F.count_if(F.col("status") == k).alias(k) for k in ("emitted", "skipped", "failed")), F.count("*").alias("total"))


def validate_samples(samples: DataFrame, diagnostics: DataFrame, identities: DataFrame) -> dict:
    """Counts of a sound publication; raises at the first flaw.

    samples: sample_id, blocks; diagnostics: filing_id, status; identities: id.
    """
    flaw = block_problems(samples).limit(1).collect()
    if flaw:
        raise SampleError(f"{flaw[0].sample_id}: {flaw[0].problem}")
    ids = samples.select(F.col("sample_id").alias("id"))
    flaw = identity_problems(ids, identities).where("problem <> 'missing_id'").limit(1).collect()
    if not flaw:
        flaw = identity_problems(diagnostics.select(F.col("filing_id").alias("id")), identities).limit(1).collect()
    if flaw:
        raise SampleError(f"{flaw[0].id}: {flaw[0].problem}")
    n = status_counts(diagnostics).first().asDict()
    rows = samples.count()
    if rows != n["emitted"]:
        raise SampleError(f"{rows} samples for {n['emitted']} emitted filings")
    return n | {"rows": rows}


def publish(spark: SparkSession, samples: DataFrame, diagnostics: DataFrame, identities: DataFrame, out: str) -> dict:
    """Writes to a staging folder beside ``out``, validates what was written, then renames it into place.

    Renames go through Hadoop's file system, so any store that Spark writes to will do; an
    earlier publication is put back if the swap fails.
    """
    fs, at = hadoop(spark, out)
    (_, stage), (_, backup) = (hadoop(spark, f"{out}.{k}") for k in ("staging", "backup"))
    fs.delete(stage, True)
    write_samples(samples, f"{out}.staging/samples")
    diagnostics.orderBy("filing_id").write.json(f"{out}.staging/diagnostics")
    identities.select("id").distinct().orderBy("id").write.json(f"{out}.staging/identities")
    written = read_diagnostics(spark, f"{out}.staging/diagnostics")
    result = validate_samples(read_samples(spark, f"{out}.staging/samples"), written, spark.read.json(f"{out}.staging/identities"))
    held = fs.exists(at)
    if held:
        fs.delete(backup, True)
        fs.rename(at, backup)
    if not fs.rename(stage, at):
        if held:
            fs.rename(backup, at)
        raise SampleError(f"can't publish to {out}")
    fs.delete(backup, True)
    return result


def nested(blocks: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``blocks`` (keys, order columns, block_type, text) as one array for each key, numbered from 0."""
    listed = F.sort_array(F.collect_list(F.struct(*order, "block_type", "text")))
    numbered = F.transform(listed, lambda x, i: F.struct(i.alias("order_index"), x.block_type.alias("block_type"), x.text.alias("text")))
    return blocks.groupBy(*keys).agg(numbered.alias("blocks"))


def numbered_blocks(blocks: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return blocks.withColumn("order_index", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)


def canonical(value) -> str:
    """JSON with sorted keys, no spaces, and letters as they are."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
