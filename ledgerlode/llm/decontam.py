"""Benchmark decontamination by winnowing.

For a window of L words, k = L // 2 (5 at L = 10) and w = L - k + 1: of every w
consecutive k-gram hashes the least is kept, on both sides, so any shared span
of w + k - 1 = L words shares a kept fingerprint. Fingerprints of the documents
are looked up in those of the benchmark; each hit is extended to the windows of
L words that hold it, and a window counts if its hash is that of an item's
window. An item of fewer than L words is one window of its own length, with a
fingerprint scheme for that length, so the guarantee holds for it as well.

The benchmark is read in blocks of at most ``block_bytes`` of text, each sent
to the executors as one broadcast (a longer item is a block of its own); tasks
load one block at a time, so memory doesn't grow with the benchmark. Documents
are scanned once and never shuffled.

Null and empty texts have no words: n_words, n_hit and n_items are 0. A null
item id counts as the empty string; repeated items and ids count once. An empty
benchmark marks nothing, an empty table of documents gives no rows and repeated documents
are marked each. Columns to keep may have any name but those that are added; a clash raises
``ValueError``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlode.llm import words as W
from ledgerlode.llm.common import bounded, kept_columns, table

WINDOW = 10
BLOCK_BYTES = 16 << 20


def scheme(length: int) -> tuple[int, int]:
    """(k, w) with k + w - 1 = length."""
    k = max(1, length // 2)
    return k, length - k + 1


def winnow(h: np.ndarray, w: int) -> np.ndarray:
    """Marks every hash that is the least of some w consecutive ones."""
    if len(h) < w:
        return np.zeros(len(h), bool)
    least = h[: len(h) - w + 1].copy()
    for j in range(1, w):
        np.minimum(least, h[j : j + len(least)], out=least)
    top = np.zeros(len(h), np.uint64)  # the largest of the minima of the windows over each place
    for j in range(w):
        np.maximum(top[j : j + len(least)], least, out=top[j : j + len(least)])
    return top == h


def _inside(first: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which of the n - k + 1 k-grams lie in one text; ``first``: where texts' words begin."""
    ok = np.ones(max(0, n - k + 1), bool)
    for j in range(1, k):
        cut = first[(first >= j) & (first < n)] - j
        ok[cut[cut < len(ok)]] = False
    return ok


def build(ids: list[str], texts: pa.Array, window: int) -> list[dict]:
    """The look-up tables of one block, one for each window length in it."""
    h, first = W.word_hashes(*W.utf8(texts))
    n = np.diff(first)
    out = []
    for length in sorted({int(x) for x in np.minimum(n, window)} - {0}):
        k, w = scheme(length)
        rows = np.flatnonzero(n >= window if length == window else n == length)
        prints, grams, owner = [], [], []
        for r in rows:
            own = h[first[r] : first[r + 1]]
            g = W.kgrams(own, k)
            prints.append(g[winnow(g, w)])
            full = np.unique(W.kgrams(own, length))
            grams.append(full)
            owner.append(np.full(len(full), r))
        grams, owner = np.concatenate(grams), np.concatenate(owner)
        order = np.argsort(grams, kind="stable")
        grams, owner = grams[order], owner[order]
        key, at = np.unique(grams, return_index=True)
        out.append({"length": length, "prints": np.unique(np.concatenate(prints)), "key": key, "at": np.append(at, len(owner)), "owner": owner, "ids": ids})
    for x in out:
        bits = np.zeros(1 << 20, bool)
        bits[x["prints"] >> np.uint64(44)] = True
        x["bits"] = bits
    return out


def _find(h: np.ndarray, first: np.ndarray, x: dict, hit: np.ndarray, items: list[set]) -> None:
    """Marks in ``hit`` the words of all occurrences of a table's windows and adds the ids to ``items``."""
    length, (k, w) = x["length"], scheme(x["length"])
    if len(h) < length:
        return
    g = W.kgrams(h, k)
    # k-grams over a border stand in for the largest value, so that each text is winnowed by itself
    g[~_inside(first, k, len(h))] = np.uint64(2**64 - 1)
    near = x["bits"][g >> np.uint64(44)]
    if not near.any():
        return
    place = np.flatnonzero(near & winnow(g, w))
    spot = np.minimum(np.searchsorted(x["prints"], g[place]), len(x["prints"]) - 1)
    place = place[x["prints"][spot] == g[place]]
    if not len(place):
        return
    start = np.unique((place[:, None] - np.arange(length - k + 1)).ravel())
    start = start[(start >= 0) & (start + length <= len(h))]
    row = np.searchsorted(first, start, "right") - 1
    keep = start + length <= first[row + 1]
    start, row = start[keep], row[keep]
    whole = np.zeros(len(start), np.uint64)
    for j in range(length):
        whole = whole * np.uint64(0xD6E8FEB86659FD93) + h[start + j]
    whole = W.mix(whole + np.uint64(length))
    spot = np.minimum(np.searchsorted(x["key"], whole), len(x["key"]) - 1)
    keep = x["key"][spot] == whole
    start, row, spot = start[keep], row[keep], spot[keep]
    for j in range(length):
        hit[start + j] = True
    pairs = np.unique(np.stack([row, spot], 1), axis=0)
    for r, s in pairs:
        items[r].update(x["ids"][o] for o in x["owner"][x["at"][s] : x["at"][s + 1]])


def _blocks(benchmark: DataFrame, window: int, block_bytes: int):
    """Broadcasts, each with the tables of one block of whole items."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct()
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = max(1, -(-2 * size // block_bytes)) if size > block_bytes else 1
    part = F.pmod(F.xxhash64("id", "text"), F.lit(n))
    out = []
    for b in range(n):
        t = (items if n == 1 else items.where(part == b)).toArrow()
        if t.num_rows:
            out.append(spark.sparkContext.broadcast(build(t["id"].to_pylist(), t["text"].combine_chunks(), window)))
    return out


def annotate(docs: DataFrame, benchmark: DataFrame, keep: list[str], window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``keep`` columns of ``docs`` with n_words, n_hit, items (ids, sorted as strings) and hits.

    hits: array of struct<first, last>, the runs of hit words by their index in the text.
    """
    blocks = _blocks(benchmark, window, block_bytes)
    kept, schema = kept_columns(docs, keep, "text", {"n_words": "bigint", "n_hit": "bigint", "items": "array<string>", "hits": "array<struct<first:bigint,last:bigint>>"})

    def run(batches):
        for batch in bounded(batches):
            text = batch.column(batch.num_columns - 1)
            for i, j in W.slices(text):
                h, first = W.word_hashes(*W.utf8(text.slice(i, j - i)))
                hit, items = np.zeros(len(h), bool), [set() for _ in range(j - i)]
                for held in blocks:
                    for x in held.value:
                        _find(h, first, x, hit, items)
                    if len(blocks) > 1:  # one block in memory at a time
                        vars(held).pop("_value", None)  # loaded anew from the executor's copy of the broadcast
                count = np.concatenate([[0], np.cumsum(hit)])
                runs = [_runs(hit[a:b]) if count[b] > count[a] else [] for a, b in zip(first[:-1], first[1:], strict=True)]
                own = [batch.column(c).slice(i, j - i) for c in range(batch.num_columns - 1)]
                own += [pa.array(np.diff(first)), pa.array(count[first[1:]] - count[first[:-1]]), pa.array([sorted(x) for x in items], pa.list_(pa.string())), pa.array(runs, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])))]
                yield pa.RecordBatch.from_arrays(own, names=[*batch.schema.names[:-1], "n_words", "n_hit", "items", "hits"])

    return kept.mapInArrow(run, schema) if blocks else _unmarked(docs, keep)


def _unmarked(docs: DataFrame, keep: list[str]) -> DataFrame:
    """What an empty benchmark gives."""
    n = F.size(F.expr(r"regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+', 0)"))
    return docs.select(*keep, F.when(F.col("text").isNull(), 0).otherwise(n).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"), F.expr("array() :: array<string>").alias("items"), F.expr("array() :: array<struct<first:bigint,last:bigint>>").alias("hits"))


def _runs(hit: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    return [{"first": int(a), "last": int(b) - 1} for a, b in zip(edge[::2], edge[1::2], strict=True)]


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = annotate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = {
    "op7_decontaminate": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
s AS (SELECT DISTINCT least(len(w), 10) AS l FROM b WHERE len(w) > 0),
i AS (SELECT DISTINCT id, l, array_to_string(w[p:p + l - 1], ' ') AS g FROM (SELECT id, w, least(len(w), 10) AS l, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM b WHERE len(w) > 0)),
g AS (SELECT r, p, l, array_to_string(w[p:p + l - 1], ' ') AS g FROM (SELECT r, w, l, unnest(range(1, len(w) - l + 2)) AS p FROM d, s WHERE len(w) >= l)),
m AS (SELECT g.r, g.p, g.l, i.id FROM g JOIN i ON g.g = i.g AND g.l = i.l),
n AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, unnest(range(p, p + l)) AS x FROM m) GROUP BY r),
t AS (SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY id) AS s FROM (SELECT DISTINCT r, id FROM m) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(t.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(t.s, '')) AS items_sha256, coalesce(n.n, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN t USING (r)
"""
}
QUERIES = {"op7_decontaminate": op7_decontaminate}

