"""Main-text extraction with a recurrent block labeller.

A page's leaves are its runs of text between block-level tags. Each leaf has a vector of
hashed tag-path tokens (tags; of the words of class, id and role those that the rule
knows, as others would be noise), hashed words, and a few
numbers (length, share of text in links, marks, place). A bidirectional LSTM in numpy
reads all leaves of a page in order, so each block is labelled with the whole page as
context; blocks labelled as main text are joined by a space.

There are no labelled pages, so the labeller is trained here on ``PAGES`` pages of least
hash (a bounded sample): a rule on the path gives the labels, and copies of these pages
with other containers (boxes for menus, notices, adverts, comments and so on, drawn from
a fixed list, and articles in plain boxes) teach it layouts that the sample lacks. More
copies put the same article into invented layouts (``_layout``) without telling names:
there the labels follow from the layout, and length, links and neighbours have to do.

Pages are read whole; a task holds one slice of them. Null and empty pages, and pages
without main text, give an empty text. Scripts, styles, comments and form fields aren't
leaves at all. An empty table trains on nothing and gives no rows.
"""

from __future__ import annotations

import html
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlode.llm import words as W
from ledgerlode.llm.common import bounded, kept_columns, table

PAGES, COPIES, LAYOUTS, EPOCHS = 150, 3, 4, 8
PATH, WORD, EXTRA, HIDDEN = 512, 32, 6, 16
WIDTH = PATH + WORD + EXTRA

_BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_RAW = frozenset("script style noscript template textarea title iframe svg head".split())
#: Raw elements that swallow the rest of a page when they aren't closed; others are passed over.
_TO_THE_END = frozenset("script style textarea title".split())
_END = {t: re.compile(rf"</{t}\s*>" if t != "head" else r"</head\s*>|(?=<body)", re.I) for t in _RAW}
_CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[a-z]+")

#: The rule that labels the training pages: containers of text that isn't the article's.
_ASIDE_TAGS = frozenset("nav header footer aside form menu button select option dialog fieldset legend".split())
_ASIDE_WORDS = frozenset("ad ads advert advertisement adverts sponsor sponsored promo promoted banner cookie cookies consent notice notices alert popup modal nav navbar navigation menu breadcrumb breadcrumbs header masthead topbar footer bottom copyright sidebar side aside related share sharing social comment comments reply replies discussion disqus respond newsletter subscribe signup login search form widget pagination pager tags meta".split())
_MAIN_TAGS = frozenset(("article", "main"))
_MAIN_WORDS = frozenset("article content post entry story main".split())
_KNOWN = _ASIDE_WORDS | _MAIN_WORDS
#: Ends of paths that an article's own blocks have as well.
_INNER = (("p",), ("h2",), ("h3",), ("blockquote",), ("blockquote", "p"), ("ul", "li"), ("ol", "li"), ("pre",), ("figure", "figcaption"), ("table", "tbody", "tr", "td"), ("dl", "dd"), ("div",), ("section", "p"), ("header", "h1"))
_BOXES = [(t, w) for t in ("div", "section", "aside", "ul") for w in sorted(_ASIDE_WORDS)] + [(t, "") for t in sorted(_ASIDE_TAGS)]

#: Names and inner paths of invented layouts.
_NEUTRAL = "wrap wrapper page container text body column col left right center inner outer row grid block box site root app field region".split()
_WRAPS = (("div",), ("div",), ("div",), ("section",), ("main",), ("table", "tbody", "tr", "td"), ("table", "tr", "td"), ("center",))
_COMMENTS = (("div comments", "div comment"), ("section comments", "ul", "li"), ("section", "ol commentlist", "li comment"), ("div discussion", "article comment"), ("div replies", "div reply"), ("div respond",))
_SHORT = frozenset("li td dd figcaption h2 h3".split())


def leaves(page: str) -> list[tuple[tuple[str, ...], str, float]]:
    """(path, text, share of the text in links) of each leaf; a path's entries are a tag and its class words."""
    stack: list[tuple[str, str]] = []
    out: list = []
    held: list[str] = []
    link, linked, size = 0, 0, 0

    def close():
        nonlocal linked, size
        if held:
            raw = "".join(held)
            text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
            if text:
                out.append((tuple(x for _, x in stack), text, linked / max(1, size)))
            held.clear()
        linked = size = 0

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.match(page, at)
        at = m.end()
        tag = m[2]
        if tag is None:
            text = m[0]
            if text[0] != "<" or text == "<":
                held.append(text)
                size += len(text)
                if link:
                    linked += len(text)
            continue
        tag, ending = tag.lower(), bool(m[1])
        if tag in _RAW:
            if not ending and not m[3].rstrip().endswith("/"):
                end = _END[tag].search(page, at)
                at = end.end() if end else n if tag in _TO_THE_END else at
            continue
        if tag not in _BLOCK:
            if tag == "a":
                link = max(0, link - 1) if ending else link + 1
            elif tag in _VOID:
                held.append(" ")
            continue
        close()
        link = 0
        if tag in _VOID:
            continue
        if ending:
            k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
            if k is not None:
                del stack[k:]
            continue
        if stack and stack[-1][0] == "p":
            stack.pop()
        if tag in _CLOSED_BY:
            while stack and stack[-1][0] in _CLOSED_BY[tag]:
                stack.pop()
        entry = tag
        if m[3]:
            words = [w for a in _ATTRIBUTE.finditer(m[3]) for w in _PART.findall((a[2] or a[3] or a[4] or "").lower())]
            entry = " ".join([tag, *words])
        stack.append((tag, entry))
    close()
    return out


def rule(path: tuple[str, ...], contained: bool) -> bool:
    """Whether a training leaf is main text; ``contained``: some leaf of its page is in an article or main box."""
    inside = False
    for entry in path:
        tag, *words = entry.split(" ")
        if tag in _MAIN_TAGS or not inside and _MAIN_WORDS & set(words):
            inside = True
        elif tag in _ASIDE_TAGS and not (inside and tag == "header") or _ASIDE_WORDS & set(words):
            return False
    return inside or not contained


def _bucket(token: str) -> int:
    return zlib.crc32(token.encode()) % PATH


_paths: dict[tuple[str, ...], np.ndarray] = {}


def _path(path: tuple[str, ...]) -> np.ndarray:
    v = _paths.get(path)
    if v is None:
        if len(_paths) > 20_000:
            _paths.clear()
        v = np.zeros(PATH, np.float32)
        for k, entry in enumerate(path):
            tag, *words = entry.split(" ")
            v[_bucket(tag)] = 1
            for w in _KNOWN & set(words):
                v[_bucket(f".{w}")] = 1
            if k == len(path) - 1:
                v[_bucket(f"{tag}!")] = 1
        _paths[path] = v
    return v


def vectors(pages: list[list]) -> np.ndarray:
    """Input vectors of all leaves of the pages in a row."""
    flat = [x for p in pages for x in p]
    out = np.zeros((len(flat), WIDTH), np.float32)
    if not flat:
        return out
    h, first = W.word_hashes(*W.utf8(pa.array([x[1] for x in flat], pa.large_string())))
    own, n = np.repeat(np.arange(len(flat)), np.diff(first)), np.maximum(1, np.diff(first))
    counts = np.bincount(own * WORD + (h % np.uint64(WORD)).astype(np.int64), minlength=len(flat) * WORD).reshape(-1, WORD)
    out[:, PATH : PATH + WORD] = 0.3 * counts / np.sqrt(n)[:, None] / np.sqrt(WORD)
    place = np.concatenate([np.linspace(0, 1, len(p)) for p in pages if p])
    for r, (path, text, links) in enumerate(flat):
        out[r, :PATH] = _path(path)
        size = len(text)
        out[r, PATH + WORD :] = (min(1, size / 500), min(1, size / 40), links, min(1, text.count(",") + text.count(".")) / 1, place[r], 1)
    return out


class Labeller:
    """A bidirectional LSTM over leaves with one output for each, which reads the leaf's own vector as well."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        make = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.w = {f"{d}{k}": v for d in "fb" for k, v in (("x", make(WIDTH, 4 * HIDDEN)), ("h", make(HIDDEN, 4 * HIDDEN)))}
        self.w["o"] = make(2 * HIDDEN + WIDTH, 1)

    @staticmethod
    def _sigmoid(z):
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def _pass(self, x: np.ndarray, mask: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """x: (time, pages, 4 HIDDEN), already times the input weights; the hidden states, in order of x."""
        t, n, _ = x.shape
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out = np.zeros((t, n, HIDDEN), np.float32)
        for k in range(t) if d == "f" else range(t - 1, -1, -1):
            z = x[k] + h @ self.w[f"{d}h"]
            i, f, o, g = (self._sigmoid(z[:, :HIDDEN]), self._sigmoid(z[:, HIDDEN : 2 * HIDDEN] + 1), self._sigmoid(z[:, 2 * HIDDEN : 3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN :]))
            m = mask[k][:, None]
            new = f * c + i * g
            if keep is not None:
                keep.append((k, h, c, i, f, o, g, new, m))
            c = m * new
            h = m * o * np.tanh(new)
            out[k] = h
        return out

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        both = []
        for d in "fb":
            states = keep.setdefault(d, []) if keep is not None else None
            both.append(self._pass(x @ self.w[f"{d}x"], mask, d, states))
        joined = np.concatenate([*both, x], 2)
        if keep is not None:
            keep["joined"] = joined
        return self._sigmoid(joined @ self.w["o"])[:, :, 0]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict:
        keep: dict = {}
        error = ((self.forward(x, mask, keep) - y) * mask / mask.sum())[:, :, None].astype(np.float32)
        grad = {"o": np.einsum("tnk,tno->ko", keep["joined"], error)}
        back = error @ self.w["o"].T
        for s, d in enumerate("fb"):
            gx, gh = np.zeros_like(self.w[f"{d}x"]), np.zeros_like(self.w[f"{d}h"])
            dh, dc = 0.0, 0.0
            for k, h, c, i, f, o, g, new, m in reversed(keep[d]):
                th = np.tanh(new)
                dh = (back[k][:, s * HIDDEN : (s + 1) * HIDDEN] + dh) * m
                dc = dc * m + dh * o * (1 - th**2)
                dz = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * th * o * (1 - o), dc * i * (1 - g**2)], 1)
                gx += x[k].T @ dz
                gh += h.T @ dz
                dh, dc = dz @ self.w[f"{d}h"].T, dc * f
            grad[f"{d}x"], grad[f"{d}h"] = gx, gh
        return grad

    def train(self, pages: list[list], labels: list[np.ndarray], epochs: int = EPOCHS, rate: float = 0.02) -> None:
        rng, step = np.random.default_rng(5), 0
        m, v = ({k: np.zeros_like(x) for k, x in self.w.items()} for _ in range(2))
        for epoch in range(epochs):
            order = rng.permutation(len(pages))
            for i in range(0, len(order), 16):
                x, mask, y = _padded([pages[k] for k in order[i : i + 16]], [labels[k] for k in order[i : i + 16]])
                step += 1
                for k, g in self.gradients(x, mask, y).items():
                    g = np.clip(g, -1, 1)
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g * g
                    self.w[k] = (self.w[k] - rate * (1 - epoch / epochs) ** 2 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)

    def label(self, pages: list[list]) -> list[np.ndarray]:
        """Whether each leaf of each page is main text; pages of like length share a pass."""
        out = [np.zeros(0, bool)] * len(pages)
        order = sorted((k for k, p in enumerate(pages) if p), key=lambda k: len(pages[k]))
        i = 0
        while i < len(order):
            j = i + 1
            while j < len(order) and j - i < 128 and (j - i + 1) * len(pages[order[j]]) <= 8192:
                j += 1
            x, mask, _ = _padded([pages[k] for k in order[i:j]], None)
            p = self.forward(x, mask) > 0.5
            for c, k in enumerate(order[i:j]):
                out[k] = p[: len(pages[k]), c]
            i = j
        return out


def _padded(pages: list[list], labels: list[np.ndarray] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = np.array([len(p) for p in pages])
    x = np.zeros((n.max(), len(pages), WIDTH), np.float32)
    mask, y = np.zeros(x.shape[:2], np.float32), np.zeros(x.shape[:2], np.float32)
    own = np.repeat(np.arange(len(pages)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    x[at, own], mask[at, own] = vectors(pages), 1
    if labels is not None:
        y[at, own] = np.concatenate(labels)
    return x, mask, y


def _layout(rng: np.random.Generator, main: list[str], spare: list[str]) -> tuple[list, np.ndarray]:
    """Leaves and labels of a page with the texts ``main`` as article, in a layout drawn by ``rng``, with other boxes around and inside it."""

    def pick(of):
        return of[rng.integers(len(of))]

    def name() -> str:
        kind = rng.random()
        return "" if kind < 0.35 else pick(_NEUTRAL) if kind < 0.7 else "".join(rng.choice(list("abcdefghilmnoprstu"), rng.integers(2, 9)))

    def wrap() -> tuple[str, ...]:
        *outer, last = pick(_WRAPS)
        return (*outer, f"{last} {name()}".strip())

    def some(least: int, most: int) -> str:
        words, n = pick(spare).split(" "), rng.integers(least, most + 1)
        at = rng.integers(max(1, len(words) - n + 1))
        return " ".join(words[at : at + n])

    def box(at: tuple, last: bool) -> list:
        kind = rng.random()
        if kind < 0.4:
            own = (pick(sorted(_ASIDE_TAGS)),) if rng.random() < 0.5 else wrap()
            inner = pick((("ul", "li"), ("ol", "li"), ("p",), ("div",), ("table", "tr", "td"), ()))
            return [((*at, *own, *inner), some(1, 4), float(0.8 + 0.2 * rng.random())) for _ in range(rng.integers(1, 8))]
        if kind < 0.55 and last:
            return [((*at, *pick(_COMMENTS), *pick(((), ("p",), ("div", "p")))), some(2, 40), 0.0) for _ in range(rng.integers(1, 6))]
        if kind < 0.65 and last:
            return [((*at, *wrap()), f"\u00a9 {some(1, 8)}", 0.3 * float(rng.random()))]
        tag, word = pick(_BOXES)
        return [((*at, f"{tag} {word}".strip(), *pick(((), ("p",), ("h3",), ("ul", "li"), ("div", "p")))), some(1, 50), float(rng.random() < 0.3)) for _ in range(rng.integers(1, 4))]

    page = ("html", "body")
    for _ in range(rng.integers(0, 3)):
        page += wrap()
    home = page
    for _ in range(rng.integers(0, 3)):
        home += wrap() if rng.random() < 0.6 else (pick(("article", "main", *(f"div {w}" for w in sorted(_MAIN_WORDS)))),)
    out: list = []
    for _ in range(rng.integers(0, 4)):
        out += [(x, 0) for x in box(page, False)]
    if rng.random() < 0.85:
        out.append((((*home, *pick(((), (), ("header",), ("div title",))), pick(("h1", "h1", "h2"))), some(2, 12), 0.0), 1))
    for text in main:
        inner = ("p",) if rng.random() < 0.6 else pick(_INNER)
        for _ in range(rng.integers(2, 6) if inner[-1] in ("li", "td") else 1):
            words = text.split(" ")
            out.append((((*home, *inner), " ".join(words[: rng.integers(2, 13)]) if inner[-1] in _SHORT else text, 0.3 * float(rng.random() < 0.2)), 1))
        if rng.random() < 0.2:
            tag, word = pick(_BOXES)
            out.append((((*home, f"{tag} {word}".strip()), some(1, 30), float(rng.random() < 0.5)), 0))
    for _ in range(rng.integers(0, 4)):
        out += [(x, 0) for x in box(home if rng.random() < 0.3 else page, True)]
    return [x for x, _ in out], np.array([y for _, y in out], np.float32)


def train(pages: list[str]) -> Labeller | None:
    """A labeller from raw pages, labelled by ``rule``, and copies of them in other containers."""
    rng = np.random.default_rng(11)
    first = [p for p in (leaves(x) for x in pages) if p]
    if not first:
        return None
    spare = [x[1] for p in first for x in p]
    seen = list(first)
    for _ in range(COPIES):
        for p in first:
            new = []
            plain = ("div", f"div {rng.choice(sorted(_MAIN_WORDS))}", "main", "section", "article")[rng.integers(5)]
            for path, text, links in p:
                if rng.random() < 0.15:
                    for box in rng.choice(len(_BOXES), rng.integers(1, 3)):
                        tag, word = _BOXES[box]
                        outer = path[: rng.integers(1, len(path) + 1)] if path else ()
                        inner = ((), ("p",), ("ul", "li"), ("div", "p"))[rng.integers(4)]
                        words = spare[rng.integers(len(spare))].split(" ")
                        cut = int(rng.integers(1, 60))
                        new.append(((*outer, f"{tag} {word}".strip(), *inner), " ".join(words[:cut]), float(rng.random() < 0.3)))
                if path and rng.random() < 0.15:
                    path = (*path[:-1], *_INNER[rng.integers(len(_INNER))])
                new.append((tuple(plain if e.split(" ")[0] == "article" else e for e in path), text, links))
            seen.append(new)
    labels = []
    for p in seen:
        contained = any(rule(path, True) for path, _, _ in p)
        labels.append(np.array([rule(path, contained) for path, _, _ in p], np.float32))
    for k in range(len(first)):
        main = [x[1] for x, y in zip(seen[k], labels[k], strict=True) if y]
        for _ in range(LAYOUTS if main else 0):
            own, y = _layout(rng, main, spare)
            seen.append(own)
            labels.append(y)
    model = Labeller()
    model.train(seen, labels)
    return model


def fit(pages: DataFrame, sample: int = PAGES) -> Labeller | None:
    """Trains on the ``sample`` pages of least hash that are shorter than 64 K characters."""
    short = pages.where("html is not null and length(html) between 1 and 65536").select(F.col("html").cast("string")).withColumn("h", F.xxhash64("html"))
    # hashes first, so that no task offers pages that the sample doesn't take; a repeated page counts once
    least = [r.h for r in short.select("h").distinct().orderBy("h").limit(sample).collect()]
    rows = short.where(F.col("h").isin(least)).dropDuplicates(["h"]).orderBy("h").collect() if least else []
    return train([r.html for r in rows])


def extract(pages: DataFrame, model: Labeller | None, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``pages`` with text, the main text of the whole ``html``."""
    kept, schema = kept_columns(pages, keep, "html", {"text": "string"})
    sent = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in bounded(batches):
            source = batch.column(batch.num_columns - 1)
            for i, j in W.slices(source):
                got = [leaves(x) if x else [] for x in source.slice(i, j - i).to_pylist()]
                marks = sent.value.label(got) if sent.value else [np.zeros(len(p), bool) for p in got]
                text = [" ".join(x[1] for x, keep in zip(p, m, strict=True) if keep) for p, m in zip(got, marks, strict=True)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in range(batch.num_columns - 1)), pa.array(text, pa.string())], names=[*batch.schema.names[:-1], "text"])

    return kept.mapInArrow(run, schema)


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, fit(pages), ["page_id", "url"]).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


QUERIES = {"op9_html": op9_html}
ORACLE: dict[str, str] = {}
