"""Byte-level BPE encoding and decoding by DuckDB queries inside each task.

Encoding: the pre-tokenizer's pattern cuts a text into pieces. Every piece that
this worker hasn't met yet goes, as the list of its bytes' ids, through a recursive
query: one row for each position joins the merge table with its right neighbour, each
piece's leftmost pair of least rank is contracted, and pieces without a pair
drop out, until none is left. A piece has at most ``LONG`` levels, each shorter by one
than that before, and the shortest is its result. Decoding: rows of ``WIDE`` ids each join the
vocabulary and an aggregation ordered by position puts the bytes together again.

Pieces over ``LONG`` bytes are cut first where no token of the vocabulary matches the
bytes across a place: no contraction can ever cross it, so the parts are encoded
independently. Parts still over ``LONG`` contract all places of the least-ranked pair in
one step, in a recursion keyed by the piece that holds its last level only, from the left, up to the first whose token makes a pair of lower rank with a
neighbour; that is what one place at a time would do, in as many steps as there are ranks
and such places. So a text without any such cut and with very many such places is slow,
but never held more than once.

Texts are first cut where white space follows other text and after letters before some
marks; the pattern never matches across such a place, so these chunks are encoded independently and kept
in a dictionary of at most ``CACHE`` bytes, which is emptied when full. Memory
is bounded by that, by the slice of ``words.slices`` and by the longest text; nothing is
shuffled.

Null and empty texts have no ids. Any text is encoded, with the special tokens'
strings as ordinary text. Repeated rows are encoded each; an empty table gives no rows.
Columns to keep may have any name but those that are added; a clash raises ``ValueError``.
"""

from __future__ import annotations

import base64
import gc
import re
import os
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlode.llm import words as W
from ledgerlode.llm.common import kept_columns, table, worker_state

LONG = 40
CACHE = 160 << 20
#: Bytes of text that are encoded together: each query has to read the whole merge table in every step.
SLICE = 2 << 20
#: Bytes of pieces in one recursive query.
BATCH = 400_000
#: Ids in a row of the query that decodes: the fewer rows, the less there is to order.
WIDE = 8

#: White_Space of Unicode, the pattern's \s; fixed values.
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_LETTERS, _MARK = "A-Za-zÀ-ÖØ-öø-ÿ", r".,!?;:%&*#$|()"
_CHUNK = re.compile(f"[{SPACE}]*(?:[{_LETTERS}]++(?![^{_MARK}{SPACE}])|[^{SPACE}]+)|[{SPACE}]+")
#: Chunks that are one piece.
_WORD = re.compile(f" ?[{_LETTERS}]+")

#: One contraction a piece and step: the key has the rank, then the position.
ONE = """
WITH RECURSIVE s(w, t) AS (
  SELECT w, t FROM pieces
  UNION ALL
  SELECT w, list_concat(t[:(k & 4294967295) - 1], [(k >> 32)::INTEGER], t[(k & 4294967295) + 2:])
  FROM s JOIN (
    SELECT w, min((m.m << 32) | p.i) AS k
    FROM (SELECT w, unnest(t) AS l, unnest(t[2:]) AS n, generate_subscripts(t, 1) AS i FROM s) p JOIN pairs m ON m.lr = (p.l::BIGINT << 32) | p.n
    GROUP BY w) USING (w)
)
SELECT w, t FROM s
"""
#: All places of the least pair: of neighbouring places, each second one, up to the first whose token (``best``)
#: makes a pair of lower rank (a row of ``falls``) with the token before or after it.
ALL = """
WITH RECURSIVE s(w, t) USING KEY (w) AS (
  SELECT w, t FROM pieces
  UNION
  SELECT w, list(CASE WHEN done THEN best ELSE t END ORDER BY i) FILTER (NOT gone) FROM (
    SELECT w, i, t, best, done, coalesce(lag(done) OVER (PARTITION BY w ORDER BY i), false) AS gone FROM (
      SELECT w, i, t, best, place AND i <= coalesce(min(CASE WHEN place AND fall THEN i END) OVER (PARTITION BY w), i) AS done FROM (
        SELECT y.*, place AND (a.m IS NOT NULL OR b.m IS NOT NULL) AS fall FROM (
          SELECT w, i, t, best, place, CASE WHEN lag(place, 2) OVER o THEN best ELSE lag(t) OVER o END AS before, lead(t, 2) OVER o AS after FROM (
            SELECT w, i, t, best, hit AND row_number() OVER (PARTITION BY w, hit, i - c ORDER BY i) % 2 = 1 AS place FROM (
              SELECT w, i, t, best, hit, row_number() OVER (PARTITION BY w, hit ORDER BY i) AS c FROM (
                SELECT w, i, t, best, coalesce(m = best, false) AS hit FROM (
                  SELECT w, i, t, m, min(m) OVER (PARTITION BY w) AS best FROM (
                    SELECT p.w, p.i, p.t, m.m
                    FROM (SELECT w, unnest(t) AS t, unnest(list_append(t[2:], NULL)) AS n, generate_subscripts(t, 1) AS i FROM s) p
                    LEFT JOIN merges m ON p.t = m.l AND p.n = m.r))
                WHERE best IS NOT NULL)))
          WINDOW o AS (PARTITION BY w ORDER BY i)) y
        LEFT JOIN falls a ON a.l = y.before AND a.r = y.best LEFT JOIN falls b ON b.l = y.best AND b.r = y.after)))
  GROUP BY w
)
SELECT w, t FROM s
"""
_DECODE = f"""
SELECT d, string_agg(concat({", ".join(f"v{k}.b" for k in range(WIDE))}), '' ORDER BY p) AS b
FROM ids {" ".join(f"LEFT JOIN vocabulary v{k} ON v{k}.t = t{k}" for k in range(WIDE))} GROUP BY d
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Trie:
    """Which places inside a run of bytes some token of a vocabulary matches across."""

    def __init__(self, tokens):
        tokens = [t for t in tokens if len(t) > 1]
        self.depth = max(map(len, tokens), default=1)
        step = np.uint64(0x9E3779B97F4A7C15)
        hashes = lambda some: np.unique(np.array([self._hash(t) for t in some], np.uint64))
        self.step = step
        self.prefixes = [hashes({t[:k] for t in tokens if len(t) >= k}) for k in range(1, self.depth + 1)]
        self.whole = [hashes({t for t in tokens if len(t) == k}) for k in range(1, self.depth + 1)]

    @staticmethod
    def _hash(token: bytes) -> int:
        h = 0
        for b in token:
            h = (h * 0x9E3779B97F4A7C15 + b + 1) % 2**64
        return h

    @staticmethod
    def _among(h: np.ndarray, known: np.ndarray) -> np.ndarray:
        if not len(known):
            return np.zeros(len(h), bool)
        return known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h

    def cuts(self, piece: bytes) -> list[bytes]:
        """The piece cut at all places that no token matches across; hashes that collide only leave a cut out."""
        data = np.frombuffer(piece, np.uint8).astype(np.uint64) + np.uint64(1)
        n = len(data)
        crossed = np.zeros(n + 1, np.int64)
        at, h = np.arange(n), data.copy()
        for k in range(2, self.depth + 1):
            keep = at + k <= n
            at, h = at[keep], h[keep] * self.step + data[at[keep] + k - 1]
            on = self._among(h, self.prefixes[k - 1])
            at, h = at[on], h[on]
            if not len(at):
                break
            found = at[self._among(h, self.whole[k - 1])]
            np.add.at(crossed, found + 1, 1)
            np.add.at(crossed, found + k, -1)
        edge = [0, *(np.flatnonzero(np.cumsum(crossed)[1:n] == 0) + 1).tolist(), n]
        return [piece[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)]


class Codec:
    """Encodes and decodes with one vocabulary; one DuckDB database in memory for each worker."""

    def __init__(self, path: str):
        import duckdb
        import public_tokenizers
        import regex

        ranks = read_ranks(path)
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        # what doesn't fit goes to files in the task's own temporary folder, which the database removes again
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "256MB", "temp_directory": os.path.join(tempfile.gettempdir(), f"bpe-{os.getpid()}")})
        split = [(ranks[t[:k]], ranks[t[k:]], m) for t, m in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        merges = pa.table(dict(zip("lrm", (pa.array(np.array(x, np.int32)) for x in zip(*split, strict=True)), strict=True)))
        words = pa.table({"t": pa.array(list(ranks.values()), pa.int32()), "b": [t.decode("latin-1") for t in ranks]})  # a byte is one code point
        for name, data in (("merges", merges), ("vocabulary", words)):
            self.db.register("given", data)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.db.unregister("given")
        self.db.execute("CREATE TABLE pairs AS SELECT (l::BIGINT << 32) | r AS lr, m::BIGINT AS m FROM merges")
        self.db.execute("CREATE TABLE falls AS SELECT * FROM merges WHERE m < greatest(l, r)")  # a token's id is its rank
        self.trie = Trie(ranks)
        self.chunks = W.Chunks(CACHE)

    def _query(self, sql: str, **tables) -> pa.Table:
        for k, v in tables.items():
            self.db.register(k, v)
        out = self.db.sql(sql).to_arrow_table()
        for k in tables:
            self.db.unregister(k)
        return out

    def _contract(self, sql: str, pieces: list[bytes]) -> list[bytes]:
        n = np.array([len(x) for x in pieces])
        at = np.concatenate([[0], np.cumsum(n)])
        lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(self.byte[np.frombuffer(b"".join(pieces), np.uint8)]))
        rows = pa.table({"w": pa.array(np.arange(len(n), dtype=np.int32)), "t": lists})
        got = self._query(sql, pieces=rows)
        w, flat = got["w"].to_numpy(), got["t"].combine_chunks()
        off = flat.offsets.to_numpy()
        size = np.diff(off)
        least = n.copy()
        np.minimum.at(least, w, size)
        row = np.empty(len(n), np.int64)
        (last,) = np.nonzero(size == least[w])  # one level for each piece
        row[w[last]] = last
        data = flat.values.to_numpy().astype(np.int32, copy=False).tobytes()
        return [data[a:b] for a, b in zip((off[row] * 4).tolist(), (off[row + 1] * 4).tolist(), strict=True)]

    def pieces(self, found: list[bytes]) -> dict[bytes, bytes]:
        """The ids of distinct pieces, as little-endian 32-bit integers."""
        parts = {x: self.trie.cuts(x) for x in found if len(x) > LONG}
        todo = list({x for x in found if len(x) <= LONG} | {y for x in parts.values() for y in x})
        out: dict[bytes, bytes] = {}
        for sql, some in ((ONE, [x for x in todo if len(x) <= LONG]), (ALL, [x for x in todo if len(x) > LONG])):
            i = 0
            while i < len(some):
                j, size = i, 0
                while j < len(some) and (j == i or size < BATCH):
                    size += len(some[j])
                    j += 1
                out.update(zip(some[i:j], self._contract(sql, some[i:j]), strict=True))
                i = j
        out.update((x, b"".join([out[y] for y in cut])) for x, cut in parts.items())
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian 32-bit integers."""
        on = gc.isenabled()
        gc.disable()  # lists of chunks hold no cycles, and looking for some in them takes long
        try:
            return self.chunks.encode([_CHUNK.findall(x) for x in texts], self._new)
        finally:
            if on:
                gc.enable()

    def _new(self, chunks: list[str]) -> dict[str, bytes]:
        parts = {c: [c.encode()] if _WORD.fullmatch(c) else [p.encode("utf-8", "surrogatepass") for p in self.pattern.findall(c)] for c in chunks}
        known = self.pieces(list({p for x in parts.values() for p in x}))
        return {c: b"".join([known[p] for p in x]) for c, x in parts.items()}

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """The bytes that each list of ids stands for."""
        n = np.array([len(x) for x in ids])
        if not n.sum():
            return [b""] * len(ids)
        rows = -(-n // WIDE)
        end = np.cumsum(rows)
        wide = np.full(end[-1] * WIDE, -1, np.int32)  # no token has this id
        wide[np.repeat((end - rows) * WIDE - np.cumsum(n) + n, n) + np.arange(n.sum())] = np.concatenate(ids)
        columns = {f"t{k}": pa.array(np.ascontiguousarray(wide[k::WIDE])) for k in range(WIDE)}
        got = self._query(_DECODE, ids=pa.table({"d": pa.array(np.repeat(np.arange(len(n), dtype=np.int32), rows)), "p": pa.array(np.arange(end[-1], dtype=np.int32)), **columns}))
        out = [b""] * len(ids)
        for d, b in zip(got["d"].to_pylist(), got["b"].to_pylist(), strict=True):
            out[d] = b.encode("latin-1")
        return out


def codec(path: str) -> Codec:
    return worker_state(("bpe", path), lambda: Codec(path))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _int_lists(ids: list[bytes]) -> pa.Array:
    off = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(np.frombuffer(b"".join(ids), np.int32)))


def encode(docs: DataFrame, keep: list[str], path: str | None = None, decoded: bool = False) -> DataFrame:
    """``keep`` columns of ``docs`` with the ids of ``text``; with ``decoded``, also the bytes these ids decode to."""
    path = path or default_path()
    kept, schema = kept_columns(docs, keep, "text", {"ids": "array<int>"} | ({"decoded": "binary"} if decoded else {}))

    def run(batches):
        own = codec(path)
        for batch in batches:
            text = batch.column(batch.num_columns - 1)
            for i, j in W.slices(text, SLICE):
                ids = own.encode([x or "" for x in text.slice(i, j - i).to_pylist()])
                out = [batch.column(c).slice(i, j - i) for c in range(batch.num_columns - 1)] + [_int_lists(ids)]
                if decoded:
                    out.append(pa.array(own.decode([np.frombuffer(x, np.int32) for x in ids]), pa.binary()))
                yield pa.RecordBatch.from_arrays(out, names=[*batch.schema.names[:-1], "ids", *["decoded"] * decoded])

    return kept.mapInArrow(run, schema)


def decode(rows: DataFrame, keep: list[str], path: str | None = None) -> DataFrame:
    """``keep`` columns of ``rows`` with the bytes that the column ``ids`` decodes to; null ids decode to nothing."""
    path = path or default_path()
    kept, schema = kept_columns(rows, keep, "ids", {"decoded": "binary"}, "array<int>")

    def run(batches):
        own = codec(path)
        for batch in batches:
            ids = [np.array(x or [], np.int32) for x in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(own.decode(ids), pa.binary())], names=[*batch.schema.names[:-1], "decoded"])

    return kept.mapInArrow(run, schema)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode(table(spark, sf_dir, "documents"), ["doc_id"], decoded=True)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {"op6_bpe": op6_bpe}
ORACLE: dict[str, str] = {}
