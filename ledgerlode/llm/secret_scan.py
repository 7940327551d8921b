"""Secret scans by grammar inference.

Base matches come from fixed patterns. Their values, as labelled credentials, are
generalised: symbols become classes, each kind's strings a prefix tree with counts, and
states whose outgoing and final frequencies agree by a Hoeffding test, as do those of all
their successors, are merged (red and blue states in order of first visit) to a
probabilistic automaton. Every run of ``LEAST`` or more credential characters that doesn't
overlap a base match, letters only or not, is then scored: its log likelihood under an
automaton, with its end, less that under a model of ordinary runs (pairs of classes, learnt
from such runs of the same texts). A run is added, as kind ``format``, if for an automaton

- that ratio is at least the logarithm of ``ODDS``, the ordinary runs for each credential,
- it is also at least what all but one in a thousand held-out ordinary runs stay under, with
  a margin as wide again as that to the hundredth, and
- its mean for each character is no more than ``TOLERANCE`` under that of all but a twentieth
  of held-out credentials.

Learning counts every distinct credential and every distinct ordinary run of all texts, of any
length, as strings of classes with their numbers. Pairs and ratios of ordinary runs are counted
in all tasks, ratios in steps of 1 / ``STEPS``. The credentials' strings of classes go to one
task, which holds them whole; no tree is built: states are merged over the places of the
strings that wait there, and only places that are numerous enough to fail the test are compared.
A quarter of the credentials and half of the ordinary runs are held out to calibrate. A kind
with fewer than ``ENOUGH`` credentials has no automaton. The automata are all that is broadcast.
Every text is scanned whole.

Null and empty texts have no spans. Without labelled credentials only base matches are
found. Repeated rows are scanned each, and learnt from once; an empty table gives no rows. What
is held out is each fourth credential and every other ordinary run in order of their hashes,
equal hashes ordered by the strings. Spans are code points, the end exclusive. A kept column
named ``found`` raises ``ValueError``.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlode.llm import words as W
from ledgerlode.llm.common import bounded, checkpoint, kept_columns, table, trained

KINDS = ("assign", "access", "hex")
ENOUGH = 20
ALPHA = 0.01
LEAST = 8
ODDS = 10_000
TOLERANCE = 0.5
UNSEEN = 1e-4
STEPS = 1024
#: Bytes of values that a task remembers, so as not to offer them again; forgotten when full.
KNOWN = 32 << 20
#: Values are numbered by ranges of their hashes, 2 ** (32 - RANGE) of each kind.
RANGE = 20

_NAME = "(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
_ASSIGN = re.compile(_NAME + "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile("AKIA[A-Z0-9]{12,}")
_HEX = re.compile("[0-9a-f]{32,}")
_RUN = re.compile("[A-Za-z0-9+/_.=-]{%d,}" % LEAST)
#: Symbol classes: digits, a-f, g-z, A-F, G-Z and each mark; with their sizes.
_CLASS = {c: k for k, s in enumerate(["0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", "+", "/", "_", ".", "=", "-"]) for c in s}
_SIZE = [10, 6, 20, 6, 20, 1, 1, 1, 1, 1, 1]
_LOG_SIZE = np.log(_SIZE)
_CODE = np.zeros(128, np.int64)
for _c, _k in _CLASS.items():
    _CODE[ord(_c)] = _k
_N = len(_SIZE)
#: A character of each class; strings of these stand for all strings of their classes.
_MARK = "0agAG+/_.=-"


def base(text: str) -> list[tuple[int, str, int, str]]:
    """(start, kind, end, value) of all base matches, by kind."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), "assign", m.end(), m[1]) for m in _ASSIGN.finditer(text) if len(m[1]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), "access", m.end(), m[0]) for m in _ACCESS.finditer(text)]
    out += [(m.start(), "hex", m.end(), m[0]) for m in _HEX.finditer(text)]
    return out


def _codes(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all strings in a row, an end (class ``_N``) after each, and where each begins."""
    size = np.array([len(x) + 1 for x in strings], np.int64)
    data = _CODE[np.frombuffer("\n".join([*strings, ""]).encode("ascii"), np.uint8)].astype(np.uint8)
    data[np.cumsum(size) - 1] = _N
    return data, np.cumsum(size) - size


class Automaton:
    """A probabilistic automaton over symbol classes, learnt by state merging.

    ``weights``: how often each string counts. Strings whose next state isn't settled wait
    there, as (place, string); those that wait at a state and class are a tree not built.
    """

    def __init__(self, strings: list[str], alpha: float = ALPHA, weights: list[int] | None = None):
        self.width = math.sqrt(0.5 * math.log(2 / alpha))
        self.data, first = _codes(strings)
        self.weight = np.ones(len(strings)) if weights is None else np.array(weights, np.float64)
        self.next = np.full((1, _N), -1)
        self.count = np.zeros((1, _N + 1))  # of red states: how often each class follows, and the end
        self.waiting: dict[tuple[int, int], list] = {}
        self._enter(0, first, np.arange(len(strings)))
        while self.waiting:
            p, c = key = min(self.waiting)
            blue = self._at(key)
            own = self._follows(*blue)
            for r in np.flatnonzero(~self._differ(own[None], self.count)).tolist():
                if self._alike(r, *blue):
                    break
            else:
                r = len(self.next)
                self.next = np.vstack([self.next, np.full(_N, -1)])
                self.count = np.vstack([self.count, np.zeros(_N + 1)])
            del self.waiting[key]
            self.next[p, c] = r
            self._enter(r, *blue)
        self.states = len(self.next)
        #: Next state, with one more that nothing leaves, and log likelihoods of a character and of the end.
        self.goes = np.vstack([np.where(self.next < 0, self.states, self.next), np.full(_N, self.states)])
        share = np.vstack([self.count / np.maximum(1, self.count.sum(1, keepdims=True)), np.zeros(_N + 1)])
        share = np.log(np.maximum(UNSEEN, share))
        self.step, self.stop = share[:, :_N] - _LOG_SIZE, share[:, _N]
        del self.data, self.weight, self.next, self.count, self.waiting

    def _follows(self, at: np.ndarray, who: np.ndarray, group: np.ndarray | int = 0, groups: int | None = None) -> np.ndarray:
        """How often each class and the end come at the places, by group."""
        n = groups or 1
        out = np.bincount(group * (_N + 1) + self.data[at], self.weight[who], n * (_N + 1)).astype(np.float64).reshape(n, _N + 1)
        return out if groups else out[0]

    def _at(self, key: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
        some = self.waiting[key]
        if len(some) > 1:
            some[:] = [tuple(np.concatenate(x) for x in zip(*some, strict=True))]
        return some[0]

    def _enter(self, r: int, at: np.ndarray, who: np.ndarray) -> None:
        """Strings come to the red state ``r`` and go on to where the next state isn't settled, or to their ends."""
        state = np.full(len(at), r)
        while len(at):
            mark = self.data[at]
            self.count += np.bincount(state * (_N + 1) + mark, self.weight[who], self.count.size).reshape(self.count.shape)
            on = mark < _N
            at, who, state, mark = at[on] + 1, who[on], state[on], mark[on]
            to = self.next[state, mark]
            out = np.flatnonzero(to < 0)
            if len(out):
                key = state[out] * _N + mark[out]
                order = np.argsort(key, kind="stable")
                out, key = out[order], key[order]
                edge = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
                for i, j in zip(edge[:-1], edge[1:], strict=True):
                    self.waiting.setdefault(divmod(int(key[i]), _N), []).append((at[out[i:j]], who[out[i:j]]))
                on = to >= 0
                at, who, to = at[on], who[on], to[on]
            state = to

    def _differ(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the shares of a class or the end differ between rows of ``a`` and ``b``."""
        n, m = a.sum(1, keepdims=True), b.sum(1, keepdims=True)
        return (np.abs(a / n - b / m) > self.width * (1 / np.sqrt(n) + 1 / np.sqrt(m))).any(1)

    def _alike(self, r: int, at: np.ndarray, who: np.ndarray) -> bool:
        """Whether the places behave as the red state ``r`` does, and all that follows them as what follows it.

        A level at a time: each group of places, those after the same classes, has a red state or other places as its
        partner; groups share partners.
        """
        group = np.zeros(len(at), np.int64)
        mate, red = np.zeros(1, np.int64), np.array([r])  # partners of the groups; red states of the partners or -1
        pat, pwho, pgroup = (np.zeros(0, np.int64) for _ in range(3))
        while len(mate):
            a = self._follows(at, who, group, len(mate))
            b = self._follows(pat, pwho, pgroup, len(red))
            b[red >= 0] = self.count[red[red >= 0]]
            if self._differ(a, b[mate]).any():
                return False
            g, c = np.nonzero((a[:, :_N] > 0) & (b[mate, :_N] > 0))
            n, m, to = a[g, c], b[mate[g], c], np.where(red[mate[g]] >= 0, self.next[red[mate[g]], c], -1)
            m[to >= 0] = np.inf  # a red state may lead to one that more strings pass
            can = self.width * (1 / np.sqrt(n) + 1 / np.sqrt(m)) < 1  # others can't differ, nor what follows them
            g, c, to = g[can], c[can], to[can]
            into = np.full((len(mate), _N + 1), -1)
            into[g, c] = np.arange(len(g))
            into = into[group, self.data[at]]
            at, who, group = at[into >= 0] + 1, who[into >= 0], into[into >= 0]
            keys, mate_next = np.unique(np.where(to >= 0, -1 - to, mate[g] * _N + c), return_inverse=True)
            into = np.full(len(red) * (_N + 1), -1)
            p, c = np.divmod(keys[keys >= 0], _N)
            into[p * (_N + 1) + c] = np.flatnonzero(keys >= 0)
            to = into[pgroup * (_N + 1) + self.data[pat]]
            parts = [(pat[to >= 0] + 1, pwho[to >= 0], to[to >= 0])]
            for p, c in zip(p[red[p] >= 0].tolist(), c[red[p] >= 0].tolist(), strict=True):
                x = self._at((int(red[p]), c))
                parts.append((*x, np.full(len(x[0]), into[p * (_N + 1) + c])))
            pat, pwho, pgroup = (np.concatenate(x) for x in zip(*parts, strict=True))
            mate, red = mate_next, np.where(keys < 0, -1 - keys, -1)
        return True

    def score(self, strings: list[str]) -> np.ndarray:
        """Log likelihood of each whole string."""
        return _walk(strings, self.goes, self.step, self.stop)


def _pairs(strings: list[str], weights: list[int] | None = None) -> np.ndarray:
    """How often each class, or the end, follows each, or the start: both are ``_N``."""
    data, first = _codes(strings)
    before = np.concatenate([[_N], data[:-1]])  # an end comes before each start
    weight = None if weights is None else np.repeat(weights, np.diff([*first, len(data)]))
    return np.bincount(before * (_N + 1) + data, weight, (_N + 1) ** 2).reshape(_N + 1, _N + 1)


class Pairs:
    """Ordinary runs: the share of each class after each other, learnt from ``strings`` or their counts of pairs."""

    def __init__(self, strings: list[str] = (), count: np.ndarray | None = None):
        count = 1 + (_pairs(list(strings)) if count is None else count)  # the last state is the start, the last class the end
        share = np.log(count / count.sum(1, keepdims=True))
        self.step, self.stop = share[:, :_N] - _LOG_SIZE, share[:, _N]
        self.goes = np.tile(np.arange(_N), (_N + 1, 1))

    def score(self, strings: list[str]) -> np.ndarray:
        return _walk(strings, self.goes, self.step, self.stop, _N)


def _walk(strings: list[str], goes: np.ndarray, step: np.ndarray, stop: np.ndarray, start: int = 0) -> np.ndarray:
    """Log likelihoods of strings from the state ``start``; strings of like length go together, a character at a time."""
    out = np.zeros(len(strings))
    size = np.array([len(s) for s in strings], np.int64)
    order = np.argsort(-size, kind="stable")
    data = _CODE[np.frombuffer("".join(strings).encode("ascii"), np.uint8)] if strings else np.zeros(0, np.int64)
    first, size = (np.cumsum(size) - size)[order], size[order]
    state = np.full(len(strings), start)
    total = np.zeros(len(strings))
    for k in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -k, "left"))  # strings with a k-th character come first
        c = data[first[:n] + k]
        total[:n] += step[state[:n], c]
        state[:n] = goes[state[:n], c]
    out[order] = total + stop[state]
    return out


def _learn(own: list[str], held: list[str], own_weights: list[int] | None = None, held_weights: list[int] | None = None) -> tuple[Automaton, float]:
    """An automaton of ``own`` strings, and the mean that all but a twentieth of the ``held`` ones have at least."""
    automaton = Automaton(own, weights=own_weights)
    mean = automaton.score(held) / [len(x) + 1 for x in held]
    order = np.argsort(mean, kind="stable")
    upto = np.cumsum(np.array(held_weights or [1] * len(held))[order])
    return automaton, mean[order][np.searchsorted(upto, upto[-1] // 20, "right")]


class Model:
    """The automata of each kind's ``values`` against ``plain``, ordinary runs."""

    def __init__(self, values: dict[str, list[str]], plain: list[str] = ()):
        plain = list(plain)
        self.plain = Pairs(plain[::2])
        self.automata, self.cuts = {}, {}
        for kind, some in sorted(values.items()):
            if len(some) >= ENOUGH:
                self.add(kind, *_learn([x for i, x in enumerate(some) if i % 4], some[::4]))
        if len(plain) >= 4:
            for kind, ratio in self.ratios(plain[1::2]).items():
                self.stay_under(kind, *np.quantile(ratio, [0.99, 0.999]))

    def add(self, kind: str, automaton: Automaton, mean: float) -> None:
        self.automata[kind], self.cuts[kind] = automaton, (mean - TOLERANCE, math.log(ODDS))

    def ratios(self, runs: list[str]) -> dict[str, np.ndarray]:
        """For each kind, the log likelihood of the runs under its automaton less that of ordinary runs."""
        plain = self.plain.score(runs)
        return {kind: automaton.score(runs) - plain for kind, automaton in self.automata.items()}

    def stay_under(self, kind: str, most: float, nearly_all: float) -> None:
        """Sets the least ratio by the hundredth and the thousandth of the held-out ordinary runs."""
        mean, least = self.cuts[kind]
        self.cuts[kind] = mean, max(least, 2 * nearly_all - most)

    def accepts(self, runs: list[str]) -> np.ndarray:
        """Which of the runs some automaton takes for a credential."""
        out = np.zeros(len(runs), bool)
        if not runs or not self.automata:
            return out
        plain, size = self.plain.score(runs), np.array([len(s) + 1 for s in runs])
        for kind, automaton in self.automata.items():
            own, (mean, least) = automaton.score(runs), self.cuts[kind]
            out |= (own / size >= mean) & (own - plain >= least)
        return out

    def more(self, texts: list[str | None], found: list[list]) -> list[list[tuple[int, str, int]]]:
        """For each text, the runs outside its base matches that an automaton accepts."""
        out: list[list] = [[] for _ in texts]
        if not self.automata:
            return out
        runs = list({x for t in texts if t for x in _RUN.findall(t)})
        good = {x for x, ok in zip(runs, self.accepts(runs), strict=True) if ok}
        for i, t in enumerate(texts if good else ()):
            if t:
                out[i] = [(m.start(), "format", m.end()) for m in _RUN.finditer(t) if m[0] in good]
                if out[i]:
                    out[i] = _outside(out[i], sorted((s, e) for s, _, e, *_ in found[i]))
        return out


def _outside(runs: list, taken: list[tuple[int, int]]) -> list:
    """The runs, in order, that don't overlap any of the ``taken`` spans."""
    out, k, reach = [], 0, 0
    for r in runs:
        while k < len(taken) and taken[k][0] < r[2]:
            reach = max(reach, taken[k][1])
            k += 1
        if reach <= r[0]:
            out.append(r)
    return out


def _classes(docs: DataFrame) -> DataFrame:
    """kind ('' for ordinary runs), classes, place, n: the distinct credentials and ordinary runs of ``docs`` by their classes.

    ``place`` is the number of a value among its kind's, by hash and string, mod 4.
    """

    def run(batches):
        known: dict[str, set] = {k: set() for k in (*KINDS, "")}
        size = 0
        for batch in bounded(batches):
            for i, j in W.slices(batch.column(0)):
                new: dict[str, set] = {k: set() for k in known}
                for x in batch.column(0).slice(i, j - i).to_pylist():
                    if not x:
                        continue
                    own = base(x)
                    if not own:
                        new[""].update(_RUN.findall(x))
                        continue
                    for _, k, _, v in own:
                        new[k].add(v)
                    runs = [(m.start(), m[0], m.end()) for m in _RUN.finditer(x)]
                    new[""].update(v for _, v, _ in _outside(runs, sorted((s, e) for s, _, e, _ in own)))
                rows = [(k, v) for k, some in new.items() for v in some - known[k]]
                size += sum(len(v) + 100 for _, v in rows)
                if size > KNOWN:
                    size = 0
                    for some in known.values():
                        some.clear()
                else:
                    for k, v in rows:
                        known[k].add(v)
                yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in rows], pa.string()) for c in (0, 1)], names=["kind", "value"])

    h = F.crc32("value")
    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "kind string, value string").select("kind", "value", h.alias("h"), F.shiftright(h, RANGE).alias("range"))
    number = F.row_number().over(Window.partitionBy("kind", "range").orderBy("h", "value")) % 4
    marks = {c: _MARK[k] for c, k in _CLASS.items()}
    classes = F.translate("value", "".join(marks), "".join(marks.values())).alias("classes")
    # one shuffle serves the numbers, the counts and that no value comes twice
    rows = found.repartition("kind", "range").dropDuplicates(["kind", "range", "h", "value"]).select("kind", "range", classes, number.alias("place"))
    rows = checkpoint(rows.groupBy("kind", "range", "classes", "place").agg(F.count("*").alias("n")), 100_000)
    before, total = [], dict.fromkeys((*KINDS, ""), 0)
    for r in sorted(rows.groupBy("kind", "range").agg(F.sum("n").alias("n")).collect(), key=lambda r: (r.kind, r["range"])):
        before.append((r.kind, r["range"], (total[r.kind] + 3) % 4))  # row numbers begin at 1
        total[r.kind] += r.n
    first = F.broadcast(docs.sparkSession.createDataFrame(before, "kind string, range bigint, first int"))
    return rows.join(first, ["kind", "range"]).select("kind", "classes", ((F.col("place") + F.col("first")) % 4).alias("place"), "n")


def fit(docs: DataFrame) -> Model:
    """A model from all distinct credentials and ordinary runs in ``docs``."""
    found = _classes(docs)
    plain = found.where("kind = ''").select("classes", "n", (F.col("place") % 2 == 1).alias("held"))

    def learn(rows):
        sums: dict[str, tuple[dict, dict]] = {}
        for kind, x, place, n in zip(*(c.to_pylist() for c in rows.columns), strict=True):
            some = sums.setdefault(kind, ({}, {}))[place == 0]
            some[x] = some.get(x, 0) + n
        out = {}
        for kind, (own, held) in sums.items():
            if sum(own.values()) + sum(held.values()) >= ENOUGH:
                own, held = sorted(own), sorted(held)
                out[kind] = _learn(own, held, [sums[kind][0][x] for x in own], [sums[kind][1][x] for x in held])
        return out

    def pairs(batches):
        total = np.zeros((_N + 1, _N + 1))
        for batch in bounded(batches):
            total += _pairs(batch.column(0).to_pylist(), batch.column(1).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], names=["pairs"])

    model = Model({})
    for kind, (automaton, mean) in sorted((trained(found.where("kind <> ''").repartition(1), learn) or {}).items()):
        model.add(kind, automaton, mean)
    if not model.automata:
        return model
    model.plain = Pairs(count=sum(np.array(r.pairs) for r in plain.where("not held").mapInArrow(pairs, "pairs array<double>").collect()).reshape(_N + 1, _N + 1))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def ratios(batches):
        for batch in bounded(batches):
            for kind, ratio in sent.value.ratios(batch.column(0).to_pylist()).items():
                step, at = np.unique(np.round(ratio * STEPS) / STEPS, return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array([kind] * len(step), pa.string()), pa.array(step), pa.array(np.bincount(at, batch.column(1).to_numpy(), len(step)).astype(np.int64))], names=["kind", "ratio", "n"])

    steps = plain.where("held").mapInArrow(ratios, "kind string, ratio double, n bigint").groupBy("kind", "ratio").agg(F.sum("n").alias("n"))
    quantiles = F.percentile("ratio", F.array(F.lit(0.99), F.lit(0.999)), F.col("n"))
    for r in steps.groupBy("kind").agg(quantiles.alias("at"), F.sum("n").alias("n")).where("n > 1").collect():
        model.stay_under(r.kind, *r["at"])
    sent.unpersist()
    return model


def scan(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` with found: array of struct<kind, start, end, base>, by start and kind."""
    kept, schema = kept_columns(docs, keep, "text", {"found": "array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"})
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
    order = {k: i for i, k in enumerate((*KINDS, "format"))}
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in bounded(batches):
            text = batch.column(batch.num_columns - 1)
            for i, j in W.slices(text):
                out, texts = [], text.slice(i, j - i).to_pylist()
                found = [base(x) if x else [] for x in texts]
                for own, new in zip(found, sent.value.more(texts, found), strict=True):
                    rows = [(s, order[k], e, k, True) for s, k, e, _ in own] + [(s, order[k], e, k, False) for s, k, e in new]
                    out.append([{"kind": k, "start": s, "end": e, "base": b} for s, _, e, k, b in sorted(rows)])
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in range(batch.num_columns - 1)), pa.array(out, kind)], names=[*batch.schema.names[:-1], "found"])

    return kept.mapInArrow(run, schema)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = scan(docs, fit(docs), ["doc_id"])
    text = lambda where: F.array_join(F.expr(f"transform({where}, x -> concat_ws(':', x.kind, x.start, x.end))"), ",")
    counts = [F.expr(f"cast(size(filter(found, x -> x.base and x.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(text("filter(found, x -> x.base)"), 256).alias("base_sha256"), text("found").alias("spans"), F.size("found").cast("long").alias("n_spans"))


QUERIES = {"op10_secrets": op10_secrets}
ORACLE: dict[str, str] = {}
