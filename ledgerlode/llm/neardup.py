"""Near-duplicate classes by DartMinHash.

A text is a weighted set of its shingles of five words (all words, if fewer).
Each element owns a strip of the plane of weight and rank, cut into cells of unit
area; a cell's hash says how many darts (Poisson, mean 1) lie in it, where, and to
which of ``K`` coordinates each belongs. Darts beyond the element's weight or the
document's rank limit don't count; the limit is set so that about K (ln K + 5)
darts count whatever the text's length, and doubled for a text with a coordinate
without a dart. The first dart of each coordinate is the signature, and two
signatures agree in a coordinate with the weighted Jaccard similarity. With all
weights 1, as the query has them, that is the Jaccard similarity of the sets.

Steps: (1) equal word sequences are one node (aggregation, exact). (2) Signatures
fall into ``BANDS`` bands. (3) Each bucket is dealt into blocks of about ``BLOCK`` members, by a
hash of its own, and in a block the signatures' agreements give a spanning forest, with
fewer pairs than members, so pairs grow with the rows and not with the square of a
bucket. (4) These pairs are verified on their whole
shingle sets. (5) Connected components. (6) In buckets that still hold several
components, every pair whose members lie in different ones and whose signatures
agree in ``LEAST_AGREEMENT`` at least is verified, each in the first bucket it shares, and the
links found join the components. The pairs stay inside the task, which gives back links only.
A bucket over ``TILE`` is cut into parts, and each two parts (and each with itself) are a
unit of work, so all its members meet whatever its size; its rows are repeated once a part.

A pair of similarity 0.8 shares a bucket with probability 0.9999, and every pair that shares
one is compared or lies in one component already; measured recall is in the README.

Null texts and texts without words are classes of their own. Rows with a
repeated doc_id each get a row. A class's id is its least doc_id; null ids are
grouped as any other and give a null class only where no row has an id. An empty
table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlode.llm import words as W
from ledgerlode.llm.common import bounded, checkpoint, table

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 5
K = BANDS * ROWS
BLOCK = 512
#: Members of each part of a large bucket where all its pairs are compared.
TILE = 1024
#: Rows of node ids for each task of the later steps.
SMALL = 50_000
#: Signatures of a pair of similarity 0.8 agree in less than this part with probability 1e-7.
LEAST_AGREEMENT = THRESHOLD - 5.5 * math.sqrt(THRESHOLD * (1 - THRESHOLD) / K)

_STEP = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]
_POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(12)])


def _unit(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53


def dart_signatures(ids: np.ndarray, weights: np.ndarray, first: np.ndarray, k: int = K) -> np.ndarray:
    """Signatures, uint64 of shape (sets, k), of weighted sets that lie in a row.

    ids: uint64 elements, distinct in a set; weights: positive; first: where each set
    begins, and the end. Each set needs an element.
    """
    n = len(first) - 1
    out = np.zeros((n, k), np.uint64)
    total = np.add.reduceat(weights, first[:-1]) if n else np.zeros(0)
    todo, limit = np.arange(n), k * (math.log(k) + 5)
    while len(todo):
        size = first[todo + 1] - first[todo]
        at = np.repeat(first[todo], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        own = np.repeat(np.arange(len(todo)), size)
        rank_limit = limit / total[todo]
        key, rank, dart = [], [], []
        for level in range(1 + int(np.log2(weights[at].max() + 1))):
            low, span = 2.0**level - 1, 2.0**level
            on = np.flatnonzero(weights[at] > low)
            cells = np.ceil(rank_limit[own[on]] * span).astype(np.int64)
            e = np.repeat(on, cells)
            r = np.arange(len(e)) - np.repeat(np.cumsum(cells) - cells, cells)
            h = W.mix(ids[at[e]] ^ W.mix(r.astype(np.uint64) * _STEP[0] + np.uint64(level * int(_STEP[1]) % 2**64)))
            count = np.searchsorted(_POISSON, _unit(h), "right")
            for q in range(int(count.max(initial=0))):
                some = np.flatnonzero(count > q)
                d = W.mix(h[some] + np.uint64((q + 1) * int(_STEP[2]) % 2**64))
                where = (r[some] + _unit(W.mix(d + _STEP[3]))) / span
                o = own[e[some]]
                keep = (low + span * _unit(d) < weights[at[e[some]]]) & (where < rank_limit[o])
                d, o = d[keep], o[keep]
                key.append(o * k + (W.mix(d + _STEP[4]) % np.uint64(k)).astype(np.int64))
                rank.append(where[keep])
                dart.append(d)
        key, rank, dart = np.concatenate(key), np.concatenate(rank), np.concatenate(dart)
        best = np.full(len(todo) * k, np.inf)
        np.minimum.at(best, key, rank)
        win = rank == best[key]
        sig = np.zeros(len(todo) * k, np.uint64)
        sig[key[win]] = dart[win]
        full = np.isfinite(best).reshape(-1, k).all(1)
        out[todo[full]] = sig.reshape(-1, k)[full]
        todo, limit = todo[~full], 2 * limit
    return out


def shingles(h: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Distinct shingle hashes of one text's word hashes, sorted."""
    return np.unique(W.kgrams(h, min(size, len(h)))) if len(h) else np.zeros(0, np.uint64)


def _sketch(kept: DataFrame) -> DataFrame:
    """doc_id and text's hash with the word sequence's hash, shingle count, signature (8 bits a coordinate) and bands."""
    schema = "doc_id bigint, h bigint, g bigint, k1 bigint, k2 bigint, sig binary, bands array<bigint>"

    def run(batches):
        for batch in bounded(batches):
            text = batch.column(3)
            for i, j in W.slices(text):
                h, first = W.word_hashes(*W.utf8(text.slice(i, j - i)))
                rows = np.flatnonzero(np.diff(first))
                sets = [shingles(h[first[r] : first[r + 1]]) for r in rows]
                sig = dart_signatures(np.concatenate(sets or [np.zeros(0, np.uint64)]), np.ones(sum(map(len, sets))), np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int64))
                bands = sig.reshape(-1, BANDS, ROWS)
                keys = np.zeros(bands.shape[:2], np.uint64) + np.arange(BANDS, dtype=np.uint64)
                for c in range(ROWS):
                    keys = W.mix(keys * _STEP[0] + bands[:, :, c])
                whole = [[int(W.mix(np.array([(own * W._power(int(s) | 1, len(own) + 1)[1:]).sum()], np.uint64) + np.uint64(len(own))).view(np.int64)[0]) for s in _STEP[2:4]] for own in (h[first[r] : first[r + 1]] for r in rows)]
                small = sig.astype(np.uint8)
                k1, k2, s, b = ([None] * (j - i) for _ in range(4))
                for x, r in enumerate(rows):
                    (k1[r], k2[r]), s[r], b[r] = whole[x], small[x].tobytes(), keys[x].view(np.int64)
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in range(3)), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(s, pa.binary()), pa.array(b, pa.list_(pa.int64()))], names=["doc_id", "h", "g", "k1", "k2", "sig", "bands"])

    return kept.mapInArrow(run, schema)


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted shingle sets have a Jaccard similarity of at least ``THRESHOLD``."""
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    both = 0
    if len(small) >= THRESHOLD * len(large):
        both = int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())
    return both >= THRESHOLD * (len(x) + len(y) - both) - 1e-9


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose shingle sets have a Jaccard similarity of at least ``THRESHOLD``."""

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                keep.append(similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)))
            yield batch.select([0, 1]).filter(pa.array(keep))

    both = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b").select("a", "b", "x", "y")
    return both.mapInArrow(run, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the least node of each connected component, for the nodes of ``edges`` (a, b).

    Large and small stars in turn: every node's larger neighbours, then its smaller ones,
    are linked to its least neighbour, until all links lead to a least node. The driver
    sees only the number and a checksum of the links.
    """
    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    held, before = checkpoint(ordered.distinct(), SMALL), None
    while True:
        now = held.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return held.union(held.select("b", "b").distinct()).toDF("node", "comp")
        before = now
        both = held.union(held.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select("a", F.col("m").alias("b")).union(small.select(F.col("b").alias("a"), F.col("m").alias("b"))).where("a <> b").distinct()
        held = checkpoint(small.coalesce(max(8, held.rdd.getNumPartitions())), SMALL)


def forest(agree: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of agreements of at least ``LEAST_AGREEMENT``.

    It is a maximum spanning forest in which the member that agrees best with all others
    goes before: those that agree with it by ``THRESHOLD`` hang on it, so blocks of one
    group give the same few edges and short paths.
    """
    n = len(agree)
    hub = int(np.where(agree >= LEAST_AGREEMENT, agree, 0).sum(1).argmax())
    close = agree[hub] >= THRESHOLD
    weight = agree.copy()
    weight[hub, close] += 1
    weight[close, hub] += 1
    best, near, todo = weight[hub].copy(), np.full(n, hub), np.ones(n, bool)
    todo[hub] = False
    out = []
    for _ in range(n - 1):
        at = int(np.where(todo, best, -2.0).argmax())
        todo[at] = False
        if best[at] >= LEAST_AGREEMENT:
            out.append((int(near[at]), at))
        closer = todo & (weight[at] > best)
        best[closer], near[closer] = weight[at][closer], at
    return out


def _grouped(batches, width: int):
    """The rows of each run of equal values in the first ``width`` columns, as a table."""
    held, last = [], None
    for batch in batches:
        key = np.stack([batch.column(c).to_numpy() for c in range(width)])
        cut = (np.flatnonzero((np.diff(key) != 0).any(0)) + 1).tolist()
        for i, j in zip([0, *cut], [*cut, key.shape[1]], strict=True):
            if i < j:
                now = tuple(key[:, i])
                if held and now != last:
                    yield pa.Table.from_batches(held)
                    held = []
                last = now
                held.append(batch.slice(i, j - i))
    if held:
        yield pa.Table.from_batches(held)


def _signatures(t: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(t["sig"].to_pylist()), np.uint8).reshape(-1, K)


def _partners(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of the forests of the blocks of (bucket, part, node, sig)."""

    def run(batches):
        for t in _grouped(batches, 2):
            if t.num_rows < 2:
                continue
            node, sig = t["node"].to_numpy(), _signatures(t)
            agree = np.stack([(sig == x).mean(1) for x in sig])
            np.fill_diagonal(agree, -1)
            found = {(min(node[x], node[y]), max(node[x], node[y])) for x, y in forest(agree)}
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

    dealt = members.repartition("bucket", "part").sortWithinPartitions("bucket", "part").select("bucket", "part", "node", "sig")
    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def candidates(bucket: int, left: np.ndarray, right: np.ndarray, comp: np.ndarray, sig: np.ndarray, bands: np.ndarray):
    """For each member r of ``left``, (r, members of ``right``), those that agree best first, that may be its links.

    These lie in another component, agree with it in ``LEAST_AGREEMENT`` at least and share
    no earlier band with it than that of ``bucket``. A pair comes once, also where left and right
    are the same.
    """
    least = LEAST_AGREEMENT * K
    other, theirs = sig[right], comp[right]
    for r in left:
        agree = np.count_nonzero(other == sig[r], axis=1)
        some = (agree >= least) & (theirs != comp[r])
        if left is right:
            some &= right > r
        at = np.flatnonzero(some)
        at = at[np.argsort(-agree[at], kind="stable")]
        at = right[at]
        first = (bands[at] == bands[r]).argmax(1)
        at = at[bands[r][first] == bucket]
        if len(at):
            yield int(r), at


def links(bucket: int, left: np.ndarray, right: np.ndarray, comp: np.ndarray, sig: np.ndarray, bands: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Pairs of candidates with similar sets that join the components as all such pairs do."""
    root = {c: c for c in comp.tolist()}

    def top(c):
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    out = []
    for r, at in candidates(bucket, left, right, comp, sig, bands):
        for c in at.tolist():
            x, y = top(comp[r]), top(comp[c])
            if x != y and similar(sets[r], sets[c]):
                root[max(x, y)] = min(x, y)
                out.append((r, c))
    return out


_UNIT = "bucket bigint, x bigint, y bigint, own bigint, node bigint, comp bigint, sig binary, bands array<bigint>"


def _across(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between components inside the units (bucket, x, y) of ``members``, rows of ``_UNIT``.

    A unit compares its members of part x with those of part y. Sets are fetched only for
    members that have a candidate in their unit.
    """

    def parts(t):
        own, x, y = t["own"].to_numpy(), t["x"][0].as_py(), t["y"][0].as_py()
        left = np.flatnonzero(own == x)
        right = left if x == y else np.flatnonzero(own == y)
        bands = t["bands"].combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
        return t["bucket"][0].as_py(), left, right, t["comp"].to_numpy(), _signatures(t), bands

    def open_members(batches):
        for t in _grouped(batches, 3):
            if t.num_rows > 1:
                some = np.zeros(t.num_rows, bool)
                for r, at in candidates(*parts(t)):
                    some[r] = some[at] = True
                if some.any():
                    yield from t.filter(pa.array(some)).to_batches()

    def linked(batches):
        for t in _grouped(batches, 3):
            own = [np.frombuffer(x.as_buffer(), np.uint64) for c in t["set"].chunks for x in c]
            node = t["node"].to_numpy()
            found = links(*parts(t), own)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(node[[x for x, _ in found]]), pa.array(node[[y for _, y in found]])], names=["a", "b"])

    def dealt(df):
        return df.repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y")

    some = checkpoint(dealt(members).mapInArrow(open_members, _UNIT), SMALL // 5)
    return dealt(some.join(sets, "node").select(*some.columns, "set")).mapInArrow(linked, "a bigint, b bigint").distinct()


def keys(doc_id: str = "doc_id", text: str = "text") -> tuple[Column, Column]:
    """Two 64-bit hashes that name a row by its doc_id and whole text."""
    text = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return F.xxhash64(text).alias("h"), F.xxhash64(F.lit(1), F.col(doc_id).cast("long"), text).alias("g")


def classes(docs: DataFrame) -> DataFrame:
    """One row for each of ``docs``: doc_id, the keys h and g of ``keys``, class_id, n_class (rows of the class) and kept.

    kept marks the class's row with the least doc_id; rows equal in doc_id and text are all marked.
    """
    h, g = keys()
    kept = docs.select(F.col("doc_id").cast("long"), h, g, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sketch = checkpoint(_sketch(kept))
    grouped = sketch.where("k1 is not null").groupBy("k1", "k2").agg(F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "h", "g")).alias("rep"), F.first("sig").alias("sig"), F.first("bands").alias("bands"))
    nodes = checkpoint(grouped.withColumn("node", F.monotonically_increasing_id()), SMALL // 5)

    rows = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    part = F.pmod(F.xxhash64("node", "bucket"), F.ceil(F.col("size") / BLOCK))
    members = checkpoint(rows.join(shared, "bucket").select("bucket", "node", "size", part.alias("part")), SMALL)
    named = nodes.join(members.select("node").distinct(), "node", "left_semi")
    sets = checkpoint(_sets(kept, named), SMALL // 10)
    signed = members.join(named.select("node", "sig"), "node")

    tried = checkpoint(_partners(signed), SMALL)
    comp = checkpoint(components(_verified(tried, sets)), SMALL)
    placed = members.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    mixed = placed.groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("bucket")
    tiles = F.ceil(F.col("size") / TILE)
    units = placed.join(mixed, "bucket").select("bucket", "node", "comp", F.pmod(F.xxhash64("node", "bucket"), tiles).alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1)).alias("other"))
    units = units.select("bucket", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "node", "comp")
    found = _across(units.join(named.select("node", "sig", "bands"), "node").select(*units.columns, "sig", "bands"), sets)
    # only components are linked here: edges become edges of components
    own = comp.select(F.col("node").alias("a"), F.col("comp").alias("x"))
    extra = found.join(own, "a", "left").join(own.toDF("b", "y"), "b", "left").select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b"))
    merged = checkpoint(components(extra), SMALL)
    renamed = comp.join(merged.toDF("comp", "to"), "comp", "left").select("node", F.coalesce("to", "comp").alias("comp"))
    alone = merged.toDF("node", "comp").join(comp, "node", "left_anti")
    comp = checkpoint(renamed.union(alone), SMALL)

    named = nodes.select("k1", "k2", "node", "rep").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = named.groupBy("comp").agg(F.min("rep").alias("rep"))
    named = named.drop("rep").join(least, "comp").select("k1", "k2", "comp", "rep")
    out = sketch.select("doc_id", "h", "g", "k1", "k2").join(named, ["k1", "k2"], "left")
    size = out.where("comp is not null").groupBy("comp").agg(F.count("*").alias("n_class"))
    alone = F.col("comp").isNull()
    best = F.struct(F.isnull("doc_id").alias("none"), "doc_id", "h", "g") == F.col("rep")
    return out.join(size, "comp", "left").select("doc_id", "h", "g", F.when(alone, F.col("doc_id")).otherwise(F.col("rep.doc_id")).alias("class_id"), F.coalesce("n_class", F.lit(1)).alias("n_class"), (alone | best).alias("kept"))


def _sets(kept: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, set): the sorted shingle hashes of the nodes' texts."""
    source = nodes.select("node", F.col("rep.h").alias("h"), F.col("rep.g").alias("g"))
    texts = kept.join(source, ["h", "g"]).dropDuplicates(["h", "g"]).select("node", "text")

    def run(batches):
        for batch in bounded(batches):
            for i, j in W.slices(batch.column(1)):
                h, first = W.word_hashes(*W.utf8(batch.column(1).slice(i, j - i)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array([shingles(h[a:b]).tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary())], names=["node", "set"])

    return texts.mapInArrow(run, "node bigint, set binary")


def op4_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_class")


QUERIES = {"op4_neardup": op4_neardup}
ORACLE: dict[str, str] = {}
