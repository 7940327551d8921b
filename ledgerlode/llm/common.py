"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import pickle
import tempfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only where that setting is missing (tests, a single machine) a temporary
    folder is made and set.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        if held.isDefined():
            return held.get()
        path = tempfile.mkdtemp(prefix="ledgerlode-")
        spark.sparkContext.setCheckpointDir(path)
    return path


def checkpoint(df: DataFrame, rows: int | None = None) -> DataFrame:
    """A reliable checkpoint in the shared folder; lineage ends there.

    With ``rows``, later stages read it with a task for each so many rows (8 at least), as
    small tables over many shuffle partitions would cost a task and three files for each.
    """
    shared_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    return out if rows is None else out.coalesce(max(8, -(-out.count() // rows)))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` doesn't have in any case."""
    have = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in have:
            n = f"_{n}"
        have.add(n.lower())
        out.append(n)
    return out


def crc_mod(column: str, m: int):
    """crc32 of a column as text, mod ``m``; null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % m


_state: dict = {}


def worker_state(key: tuple, make):
    """What a task's Python worker keeps from one task to the next: ``make()``, made once for a ``key``.

    Workers serve tasks of one stage after the other, so what another key left there is
    dropped first and its memory given back to the system.
    """
    if key not in _state:
        _state.clear()
        release()
        _state[key] = make()
    return _state[key]


def release() -> None:
    """Gives memory that Python, Arrow and the allocator hold unused back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def bounded(batches, state: tuple | None = None):
    """The batches of a task that keeps no state of its own in the worker: another operator's is dropped first."""
    worker_state(state or ("none",), lambda: None)
    yield from batches
    release()


def kept_columns(df: DataFrame, keep: list[str], column: str, added: dict[str, str], kind: str = "string") -> tuple[DataFrame, str]:
    """The ``keep`` columns with ``column`` cast to ``kind`` last, and the schema of ``keep`` with the ``added`` columns.

    A kept column with the name of an added one, in any case, raises, as the result would have two of them.
    """
    clash = {c.lower() for c in keep} & {c.lower() for c in added}
    if clash:
        raise ValueError(f"the result has columns of its own named {', '.join(sorted(clash))}; rename what is kept")
    (last,) = fresh(df.select(*(f"`{c}`" for c in keep)), "text")
    kept = df.select(*(F.col(f"`{c}`") for c in keep), F.col(column).cast(kind).alias(last))
    return kept, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema[:-1]] + [f"{k} {v}" for k, v in added.items()])


def trained(rows: DataFrame, fit):
    """``fit`` of all ``rows``, an Arrow table, in one task: for samples of a stated bound, so that the driver holds only the result.

    ``fit`` isn't called without rows; the result is None then.
    """
    names = rows.columns

    def run(batches):
        held = [b for b in bounded(batches) if b.num_rows]
        model = fit(pa.Table.from_batches(held).rename_columns(names)) if held else None
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    got = [pickle.loads(r.model) for r in rows.coalesce(1).mapInArrow(run, "model binary").collect()]
    return got[0] if got else None
