"""Quality scores by nearest-neighbour voting in a latent-semantic space.

A text's terms are hashed words, hashed 1- to 3-grams of character classes (upper,
lower, digit, space, line end, each ASCII mark, other), and terms for how much it
repeats words, word pairs and lines. Weighted by log frequency and inverse document
frequency, they are projected on the leading singular vectors of the labelled sample.
Every text takes exact cosine products with all labelled vectors, in blocks, and the
``NEIGHBOURS`` nearest vote with their labels, weighted by a power of the similarity.

At most ``SAMPLE`` labelled texts are used, those of least hash, so the broadcast is
bounded: SAMPLE x DIMS floats and the projection. Texts are scored whole; a task holds
one slice of them.

Null and empty texts are scored as any other, from the terms for repetition alone.
Ties between neighbours go to the earlier labelled vector. Without labels the score
is 0.5. A doc_id with several labels counts with each; repeated rows count once in the
sample and are scored each. An empty table gives no rows. A kept column named ``score`` or
``predicted`` raises ``ValueError``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlode.llm import words as W
from ledgerlode.llm.common import bounded, crc_mod, kept_columns, table, trained

SAMPLE, DIMS, NEIGHBOURS, POWER = 6000, 48, 15, 8
CUT = 0.7
SHAPES, WORDS, LEVELS = 1024, 512, 16
TERMS = SHAPES + WORDS + 3 * (LEVELS + 1)
REPEAT_WEIGHT = 6.0
_CLASS = np.full(256, 38, np.int64)
_CLASS[:128] = 37
_CLASS[0x20], _CLASS[0x0A] = 4, 5
_CLASS[0x30:0x3A], _CLASS[0x41:0x5B], _CLASS[0x61:0x7B] = 3, 1, 2
_marks = [b for b in range(0x21, 0x7F) if not chr(b).isalnum()]
_CLASS[_marks] = 6 + np.arange(len(_marks)) % 31


def _hashed(code: np.ndarray, n: int) -> np.ndarray:
    return ((code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - (n.bit_length() - 1))).astype(np.int64)


_SHAPE_OF = [_hashed(np.arange(40**n) + 7 * 40**3 * n, SHAPES) for n in (1, 2, 3)]


def terms(text: pa.Array) -> np.ndarray:
    """Term weights, float32 of shape (texts, TERMS), before the document frequencies."""
    data, off = W.utf8(text)
    words, first = W.word_hashes(data, off)
    word_term = _hashed(words, WORDS)
    lines_at = np.flatnonzero(data == 0x0A)
    out = np.zeros((len(off) - 1, TERMS), np.float32)
    for r in range(len(out)):
        c = _CLASS[data[off[r] : off[r + 1]]]
        w = words[first[r] : first[r + 1]]
        codes = [c, c[:-1] * 40 + c[1:], (c[:-2] * 40 + c[1:-1]) * 40 + c[2:]]
        shape = sum(np.bincount(t[x], minlength=SHAPES) for t, x in zip(_SHAPE_OF, codes, strict=True))
        out[r, :SHAPES] = np.log1p(1000 * shape / max(1, len(c)))
        out[r, SHAPES : SHAPES + WORDS] = np.log1p(100 * np.bincount(word_term[first[r] : first[r + 1]], minlength=WORDS) / max(1, len(w)))
        cut = lines_at[np.searchsorted(lines_at, off[r]) : np.searchsorted(lines_at, off[r + 1])]
        ends = np.concatenate([[off[r]], cut + 1, [off[r + 1]]])
        lines = [data[a:b].tobytes().strip() for a, b in zip(ends[:-1], ends[1:], strict=True)]
        lines = [x for x in lines if x]
        for k, (n, distinct) in enumerate(((len(w), len(np.unique(w))), (max(0, len(w) - 1), len(np.unique(W.kgrams(w, 2)))), (len(lines), len(set(lines))))):
            place = (1 - distinct / n) * LEVELS if n else 0.0
            low = int(place)
            at = SHAPES + WORDS + k * (LEVELS + 1) + low
            out[r, at] = REPEAT_WEIGHT * (1 - (place - low))
            if low < LEVELS:
                out[r, at + 1] = REPEAT_WEIGHT * (place - low)
    return out


class Model:
    def __init__(self, weight, axes, vectors, labels):
        self.weight, self.axes, self.vectors, self.labels = weight, axes, vectors, labels

    @classmethod
    def fit(cls, x: np.ndarray, labels: np.ndarray) -> Model:
        """``x``, float32 term weights of the labelled texts, is changed in place."""
        weight = np.log((1 + len(x)) / (1 + (x > 0).sum(0))).astype(np.float32) + 1
        x *= weight
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
        _, vector = np.linalg.eigh((x.T @ x).astype(np.float64))
        axes = np.ascontiguousarray(vector[:, ::-1][:, 1 : DIMS + 1], np.float32)  # the first is what all texts share
        v = x @ axes
        return cls(weight, axes, v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9), np.asarray(labels, np.float32))

    def project(self, x: np.ndarray) -> np.ndarray:
        x = x * self.weight
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
        v = x @ self.axes
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        k = min(NEIGHBOURS, len(self.labels))
        for i in range(0, len(x), 256):
            near = self.project(x[i : i + 256]) @ self.vectors.T
            at = np.argpartition(-near, k - 1, axis=1)[:, :k]
            vote = np.maximum(np.take_along_axis(near, at, 1), 1e-3).astype(np.float64) ** POWER
            out[i : i + 256] = (vote * self.labels[at]).sum(1) / vote.sum(1)
        return np.clip(out, 0, 1)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model from the texts of ``docs`` that ``labels`` (doc_id, quality) marks; ``sample`` of them at most."""
    marked = labels.where("doc_id is not null and quality is not null").select("doc_id", F.col("quality").cast("int").alias("quality")).distinct()
    some = marked.withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id", "quality").limit(sample).collect()
    if not some:
        return None
    ids = sorted({r.doc_id for r in some})

    def run(batches):
        for batch in bounded(batches):
            for i, j in W.slices(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array([x.astype("<f4").tobytes() for x in terms(batch.column(1).slice(i, j - i))], pa.binary())], names=["doc_id", "x"])

    texts = docs.where(F.col("doc_id").isin(ids)).select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # a doc_id's further texts come after the first of every other, so they can't crowd those out
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("x"))
    held = texts.mapInArrow(run, "doc_id bigint, x binary").distinct().withColumn("n", nth).orderBy("n", "doc_id", "x")
    by: dict[int, list[int]] = {}
    for r in some:
        by.setdefault(r.doc_id, []).append(r.quality)

    def learn(rows: pa.Table) -> Model:
        pairs = [(i, q) for i, k in enumerate(rows["doc_id"].to_pylist()) for q in by[k]]
        x = np.zeros((len(pairs), TERMS), np.float32)
        for r, (i, _) in enumerate(pairs):
            x[r] = np.frombuffer(rows["x"][i].as_buffer(), "<f4")
        return Model.fit(x, np.array([q for _, q in pairs]))

    return trained(held.select("doc_id", "x").limit(2 * sample), learn)


def assess(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` with score and predicted for the whole ``text``."""
    kept, schema = kept_columns(docs, keep, "text", {"score": "double", "predicted": "int"})
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in bounded(batches):
            text = batch.column(batch.num_columns - 1)
            for i, j in W.slices(text):
                score = sent.value.score(terms(text.slice(i, j - i))) if sent.value else np.full(j - i, 0.5)
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in range(batch.num_columns - 1)), pa.array(score), pa.array((score >= CUT).astype(np.int32))], names=[*batch.schema.names[:-1], "score", "predicted"])

    return kept.mapInArrow(run, schema)


def training(spark: SparkSession, sf_dir: str) -> Model | None:
    """The model of the query and the pipeline: from labelled rows that aren't held out."""
    return fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where(crc_mod("doc_id", 4) != 2))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", crc_mod("doc_id", 4) == 2).select("doc_id", "held_out", "text")
    return assess(docs, training(spark, sf_dir), ["doc_id", "held_out"])


QUERIES = {"op8_quality": op8_quality}
ORACLE: dict[str, str] = {}
