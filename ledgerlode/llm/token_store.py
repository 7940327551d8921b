"""Token ids in binary segments with Elias-Fano document boundaries.

Documents are range-partitioned and sorted by doc_id, tokenised, and written as
segments of about ``SEGMENT_IDS`` ids (one whole document at least). A segment is
one self-describing byte string, the file format:

    header   magic "LLTS", version, id width (2 or 4 bytes), low bits l, a spare
             byte, then as 64-bit integers: documents n, ids u
    ids      u little-endian unsigned integers of that width
    low      the low l bits of the n + 1 boundaries, packed
    high     the boundaries' high parts in unary: bit (b_i >> l) + i is set
    samples  the place of every ``SAMPLE``-th set bit, as 32-bit integers

``Segment.boundaries`` is a select on the high part, for any documents at once: it starts
at a sample and counts bits of a few bytes, so no table of 64-bit offsets is needed; the
whole takes about 2 + log2(u / n) bits a document.

Segments are rows of a Parquet table (shard, base, doc_ids, payload) in a shared
folder. Spark's commit protocol writes them, so a lost executor's task is simply
run again; ``base`` is the number of ids in the shard before the segment. The only
thing the driver gathers is one total for each shard, as many as write tasks.

Null texts are empty; an empty document has the end id alone. Rows with equal
doc_id keep their own places, in the order of their text's hash; a null doc_id
comes first. An empty table gives an empty store.
"""

from __future__ import annotations

import json
import re
import struct
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlode.llm import words as W
from ledgerlode.llm.common import bounded, shared_dir, table, worker_state

SEGMENT_IDS = 1 << 20
SAMPLE = 64
#: Documents read from a segment at once.
READ = 1024
#: Words given to the library as one text.
TOGETHER = 100
CACHE = 160 << 20
END_ID = 2
_HEAD = struct.Struct("<4sBBBBqq")
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
#: Set bits of each byte, and the place of its n-th one.
_COUNT = _BITS.sum(1).astype(np.int64)
_NTH = np.array([[*np.flatnonzero(b), *[0] * (8 - b.sum())] for b in _BITS], np.int64)

#: Cuts that the tokenizer's own pre-tokenizer also makes: at white space, and after letters before these marks.
_MARK, _GAP = r".,!?;:%&*#$|()", r" \t\n\r\f\v"
_CHUNK = re.compile(rf"[A-Za-zÀ-ÖØ-öø-ÿ]+(?![^{_MARK}{_GAP}])|[{_MARK}]+(?![^{_GAP}])|[^{_GAP}]+")
_WORD = re.compile(rf"[A-Za-zÀ-ÖØ-öø-ÿ]+|[{_MARK}]+")
#: A normalizer and a pre-tokenizer that leave a lower-case word of ``_WORD`` as it is, but for its bytes' own characters.
_PLAIN = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
)


def pack(lengths: np.ndarray, ids: bytes, width: int) -> bytes:
    """A segment: ``ids`` in a row, ``lengths`` ids for each document."""
    bound = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    n, u = len(lengths), int(bound[-1])
    low = max(0, int(np.log2(max(1, u) / max(1, n))))
    bits = ((bound[:, None] >> np.arange(low)) & 1).astype(np.uint8)
    high = np.zeros((u >> low) + n + 1, np.uint8)
    place = (bound >> low) + np.arange(n + 1)
    high[place] = 1
    return b"".join([_HEAD.pack(b"LLTS", 1, width, low, 0, n, u), ids, np.packbits(bits.ravel(), bitorder="little").tobytes(), np.packbits(high, bitorder="little").tobytes(), place[::SAMPLE].astype("<u4").tobytes()])


class Segment:
    """Reads what ``pack`` has written."""

    def __init__(self, data: bytes):
        magic, version, width, self.low, _, self.n, self.u = _HEAD.unpack_from(data)
        if magic != b"LLTS" or version != 1:
            raise ValueError("not a token segment")
        at = _HEAD.size
        self.ids = np.frombuffer(data, f"<u{width}", self.u, at)
        at += width * self.u
        size = (self.low * (self.n + 1) + 7) // 8
        self._low = np.frombuffer(data, np.uint8, size, at)
        at += size
        size = ((self.u >> self.low) + self.n + 1 + 7) // 8
        self._high = np.frombuffer(data, np.uint8, size, at)
        self._samples = np.frombuffer(data, "<u4", self.n // SAMPLE + 1, at + size)

    def _select(self, i: np.ndarray) -> np.ndarray:
        """Places of the i-th set bits of the high part: from the sample before each, byte by byte."""
        place, left = self._samples[i // SAMPLE].astype(np.int64), i % SAMPLE
        byte = place >> 3
        left = left + _COUNT[self._high[byte] & ((1 << (place & 7)) - 1)]
        todo = np.arange(len(i))
        while len(todo):
            held = _COUNT[self._high[byte[todo]]]
            todo, held = todo[held <= left[todo]], held[held <= left[todo]]
            left[todo] -= held
            byte[todo] += 1
        return byte * 8 + _NTH[self._high[byte], left]

    def boundaries(self, i) -> np.ndarray:
        """Where the documents numbered ``i`` begin; n is the end of the last."""
        i = np.asarray(i, np.int64)
        if len(i) and not (0 <= i.min() and i.max() <= self.n):
            raise IndexError(f"{i.min()} to {i.max()} of {self.n}")
        bit, rest = i * self.low, np.zeros(len(i), np.int64)
        for j in range(self.low):
            rest |= (self._low[(bit + j) >> 3].astype(np.int64) >> ((bit + j) & 7) & 1) << j
        return ((self._select(i) - i) << self.low) | rest

    def boundary(self, i: int) -> int:
        return int(self.boundaries([i])[0])

    def document(self, i: int) -> np.ndarray:
        a, b = self.boundaries([i, i + 1])
        return self.ids[a:b]


class Encoder:
    """The tokenizers library behind a dictionary of chunks of at most ``CACHE`` bytes.

    Texts that hold an added token's string are given to the library whole, as it finds these
    strings before anything else.
    """

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.chunks = W.Chunks(CACHE)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self.lower = "Lowercase" in str(self.tokenizer.normalizer)
        self.words = self._light(path)

    @staticmethod
    def _light(path: str):
        """The tokenizer without the work that changes nothing in lower-case words between spaces; None if its steps aren't known."""
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if (spec["normalizer"], spec["pre_tokenizer"]) != _PLAIN:
            return None
        own = Tokenizer.from_file(path)
        own.normalizer = None
        own.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        return own

    def _case(self, text: str, low: str) -> str:
        """The text in lower case, ``low``, where that is what the tokenizer does to each of its characters anyway."""
        if self.lower and not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return text
        return low if self.lower else text

    def _new(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of distinct chunks. Runs of letters or marks are one word each: many are encoded at once and cut after the ids that end words."""
        kind, out = f"<u{self.width}", {}
        plain = [c for c in chunks if _WORD.fullmatch(c)] if self.ends.any() else []
        if plain:
            lines = [" ".join(plain[i : i + TOGETHER]) for i in range(0, len(plain), TOGETHER)]
            got = self.words.encode_batch_fast([x.lower() for x in lines], add_special_tokens=False) if self.words else self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)
            ids = np.concatenate([np.array(e.ids, np.int64) for e in got])
            cut = (np.flatnonzero(self.ends[ids]) + 1) * self.width
            if len(cut) == len(plain):
                data, cut = ids.astype(kind).tobytes(), cut.tolist()
                out = {c: data[a:b] for c, a, b in zip(plain, [0, *cut], cut, strict=False)}
        rest = [c for c in chunks if c not in out]
        out.update((c, np.array(e.ids, kind).tobytes()) for c, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        whole, cut = [], []
        for i, x in enumerate(texts):
            low = x.lower()
            if any(t in x or t in low for t in self.added):
                whole.append(i)
                cut.append([])
            else:
                cut.append(_CHUNK.findall(self._case(x, low)))
        out = self.chunks.encode(cut, self._new)
        for i in whole:
            out[i] = np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, f"<u{self.width}").tobytes()
        return out


def encoder(path: str) -> Encoder:
    return worker_state(("token store", path), lambda: Encoder(path))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def write(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, segment_ids: int = SEGMENT_IDS) -> None:
    """Encodes ``text`` of all ``docs`` and writes the segments to ``path`` in order of doc_id."""
    tokenizer = tokenizer or default_path()
    kept = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    kept = kept.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")

    def run(batches):
        own, shard, base = encoder(tokenizer), TaskContext.get().partitionId(), 0
        end = np.array([end_id], f"<u{own.width}").tobytes()
        ids, lengths, names, size = [], [], [], 0

        def close():
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([base]), pa.array([names], pa.list_(pa.int64())), pa.array([pack(np.array(lengths), b"".join(ids), own.width)], pa.binary())], names=["shard", "base", "doc_ids", "payload"])

        for batch in batches:
            for i, j in W.slices(batch.column(1)):
                for doc_id, x in zip(batch.column(0).slice(i, j - i).to_pylist(), own.encode(batch.column(1).slice(i, j - i).to_pylist()), strict=True):
                    n = len(x) // own.width + 1
                    if lengths and size + n > segment_ids:
                        yield close()
                        base += size
                        ids, lengths, names, size = [], [], [], 0
                    ids += [x, end]
                    lengths.append(n)
                    names.append(doc_id)
                    size += n
        if lengths:
            yield close()

    kept.mapInArrow(run, "shard int, base bigint, doc_ids array<bigint>, payload binary").write.option("compression", "zstd").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and the ids as little-endian unsigned 32-bit integers, from the segments at ``path``."""
    shards = spark.read.parquet(path)

    total = shards.select("shard", F.substring("payload", 1, _HEAD.size).alias("head")).mapInArrow(_sizes, "shard int, n bigint").groupBy("shard").agg(F.sum("n").alias("n"))
    first, rows = 0, []
    for r in sorted(total.collect()):  # one row for each write task
        rows.append((r.shard, first))
        first += r.n
    starts = spark.createDataFrame(rows, "shard int, first bigint")

    def run(batches):
        for batch in bounded(batches):
            for base, names, data in zip(*(batch.column(k) for k in range(3)), strict=True):
                s = Segment(data.as_py())
                names = pa.array(names.as_py(), pa.int64())
                for i in range(0, s.n, READ):  # some documents at a time: a long one doesn't hold all others' ids in memory
                    b = s.boundaries(np.arange(i, min(s.n, i + READ) + 1))
                    ids = [s.ids[x:y].astype("<u4").tobytes() for x, y in zip(b[:-1], b[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays([names.slice(i, len(ids)), pa.array(base.as_py() + b[:-1]), pa.array(np.diff(b)), pa.array(ids, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])

    placed = shards.join(F.broadcast(starts), "shard").select((F.col("base") + F.col("first")).alias("base"), "doc_ids", "payload")
    return placed.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def _sizes(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([_HEAD.unpack(x.as_py())[-1] for x in batch.column(1)], pa.int64())], names=["shard", "n"])


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/token-store-{uuid.uuid4().hex}"
    write(table(spark, sf_dir, "documents"), path)
    return read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES = {"op1_token_store": op1_token_store}
ORACLE: dict[str, str] = {}

