"""Language identification with a blended-spectrum string kernel.

The kernel of two texts is the number of distinct n-grams of one to four lower-cased
characters that both hold, over the geometric mean of each text's own number. N-grams
are hashed to 2**20 places. Nystroem: ``LANDMARKS`` training texts (one of each language
at least) span the feature space, a text's features being its kernel values with them,
whitened by the landmarks' own kernel matrix; one ridge regression for each language is
fitted on these features (one language against the rest). A batch of texts is scored by
matrix products: presence rows of ``ROWS`` texts, for n-grams that landmarks hold, by the
landmarks' presence, in blocks of ``GRAMS`` n-grams, and the kernel values by the weights.

Training reads at most ``TEXTS`` texts of at most ``LONGEST`` characters, as many of each of
the ``LANGS`` most frequent languages and at most ``PER_LANG``, those of least hash and
repeated rows once: a bounded sample. Every text is scored whole, and tasks hold one slice
of texts.

Null texts and texts without a letter (Unicode category L) are ``und`` with score 0. Ties go
to the language that sorts first. Without training rows every text is ``und``. Repeated rows
are scored each; an empty table gives no rows. A kept column named ``lang_pred`` or ``score``
raises ``ValueError``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlode.llm import words as W
from ledgerlode.llm.common import bounded, crc_mod, kept_columns, table, trained

ORDERS = 4
BITS = 20
PER_LANG, LANGS, TEXTS = 250, 256, 16_000
LONGEST = 8_000
LANDMARKS = 160
ROWS, GRAMS = 64, 16_384
RIDGE = 1e-3
_LETTER = regex.compile(r"\p{L}")
_MUL = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def places(text: str) -> np.ndarray:
    """Hashed places of all n-grams of a text, with repeats."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    out, h = [], np.zeros(len(c), np.uint64)
    for n in range(ORDERS):
        if len(c) <= n:
            break
        h = (h[: len(c) - n] if n else h) * _MUL[1] + c[n:] * _MUL[0]
        g = (h + np.uint64(n)) * _MUL[2]
        out.append(((g ^ (g >> np.uint64(29))) * _MUL[3]) >> np.uint64(64 - BITS))
    return np.concatenate(out).astype(np.int64) if out else np.zeros(0, np.int64)


class Model:
    """Landmarks as presence of the n-grams in ``held``, one column each, and the weights of all languages."""

    def __init__(self, langs: list[str], texts: list[str]):
        self.langs = langs
        grams = [np.unique(places(x)) for x in texts]
        self.held = np.unique(np.concatenate(grams))
        self.landmarks = np.zeros((len(self.held), len(texts)), bool)
        for c, g in enumerate(grams):
            self.landmarks[np.searchsorted(self.held, g), c] = True
        self.size = np.array([len(g) for g in grams], np.float64)
        self.weights = None

    def kernel(self, texts: list[str]) -> np.ndarray:
        """The kernel values of texts with all landmarks."""
        out = np.zeros((len(texts), len(self.size)))
        flag = np.zeros(1 << BITS, bool)
        for k in range(0, len(texts), ROWS):
            part = texts[k : k + ROWS]
            rows, n = np.zeros((len(part), len(self.held)), bool), np.zeros(len(part))
            for r, x in enumerate(part):
                flag[places(x)] = True
                rows[r], n[r] = flag[self.held], np.count_nonzero(flag)
                flag[:] = False
            both = np.zeros((len(part), len(self.size)), np.float32)
            for g in range(0, len(self.held), GRAMS):
                both += rows[:, g : g + GRAMS].astype(np.float32) @ self.landmarks[g : g + GRAMS].astype(np.float32)
            out[k : k + len(part)] = both / np.sqrt(np.maximum(n, 1)[:, None] * np.maximum(self.size, 1)[None, :])
        return out

    @classmethod
    def fit(cls, texts: list[str], langs: list[str]) -> Model:
        names = sorted(set(langs))
        rng = np.random.default_rng(7)
        by = {k: rng.permutation([i for i, x in enumerate(langs) if x == k]) for k in names}
        mark = [i for k in names for i in by[k][: max(1, LANDMARKS // len(names))]]
        model = cls(names, [texts[i] for i in mark])
        k = model.kernel(texts)
        value, vector = np.linalg.eigh(k[mark] + 1e-8 * np.eye(len(mark)))
        white = vector / np.sqrt(np.maximum(value, 1e-6))
        x = np.hstack([k @ white, np.ones((len(texts), 1))])
        y = np.where(np.array(langs)[:, None] == np.array(names), 1.0, -1.0)
        solved = np.linalg.solve(x.T @ x + RIDGE * len(x) * np.eye(x.shape[1]) / 10, x.T @ y)
        model.weights = white @ solved[:-1], solved[-1]
        return model

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        known = [i for i, x in enumerate(texts) if x and _LETTER.search(x)]
        lang, score = ["und"] * len(texts), np.zeros(len(texts))
        out = self.kernel([texts[i] for i in known]) @ self.weights[0] + self.weights[1]
        share = np.exp(4 * (out - out.max(1, keepdims=True))) if known else out
        best = share.max(1) / share.sum(1) if known else []
        for r, i in enumerate(known):
            lang[i], score[i] = self.langs[int(out[r].argmax())], best[r]
        return lang, score


def fit(docs: DataFrame, per_lang: int = PER_LANG, texts: int = TEXTS) -> Model | None:
    """A model from a bounded sample of the rows of ``docs`` with doc_id, text and lang."""
    text = F.col("text").cast("string")
    named = docs.where("text is not null and lang is not null and doc_id is not null").select(F.col("lang").cast("string"), "doc_id", F.xxhash64(text).alias("t"), text.alias("text")).where(F.length("text") <= LONGEST)
    names = [r[0] for r in named.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGS).collect()]
    if not names:
        return None
    named = named.where(F.col("lang").isin(names))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "t"))
    some = named.select("lang", "doc_id", "t").distinct().withColumn("n", rank).where(F.col("n") <= min(per_lang, max(1, texts // len(names)))).drop("n").collect()
    ids = sorted({r.doc_id for r in some})
    wanted = docs.sparkSession.createDataFrame(some, named.select("lang", "doc_id", "t").schema)  # TEXTS rows at most
    rows = named.where(F.col("doc_id").isin(ids)).join(F.broadcast(wanted), ["lang", "doc_id", "t"], "left_semi").dropDuplicates(["lang", "doc_id", "t"])

    def learn(t: pa.Table) -> Model | None:
        some = [(x, lang) for lang, x in zip(t["lang"].to_pylist(), t["text"].to_pylist(), strict=True) if _LETTER.search(x)]
        return Model.fit(*map(list, zip(*some, strict=True))) if some else None

    return trained(rows.orderBy("doc_id", "lang", "text").select("lang", "text").limit(min(per_lang * len(names), texts)), learn)


def identify(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` with lang_pred and score for the whole ``text``."""
    kept, schema = kept_columns(docs, keep, "text", {"lang_pred": "string", "score": "double"})
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in bounded(batches):
            text = batch.column(batch.num_columns - 1)
            for i, j in W.slices(text):
                texts = text.slice(i, j - i).to_pylist()
                lang, score = sent.value.predict(texts) if sent.value else (["und"] * len(texts), np.zeros(len(texts)))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in range(batch.num_columns - 1)), pa.array(lang, pa.string()), pa.array(score)], names=[*batch.schema.names[:-1], "lang_pred", "score"])

    return kept.mapInArrow(run, schema)


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(crc_mod("doc_id", 3) != 1))
    return identify(docs.withColumn("held_out", crc_mod("doc_id", 3) == 1).select("doc_id", "held_out", "text"), model, ["doc_id", "held_out"])


QUERIES = {"op3_langid": op3_langid}
ORACLE: dict[str, str] = {}
