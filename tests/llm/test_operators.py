"""The operators on small tables: nulls, empty and long texts, repeated rows, empty tables, clashing names."""

import re
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerlode.llm import ann, bpe, decontam, html_blocks, langid, neardup, pii, quality, secret_scan, token_store

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
LONG = " ".join(WORDS[(i * 7 + i // 20) % 20] + str(i % 97) for i in range(30000))
COPY = " ".join(WORDS * 4)
ROWS = [(1, None), (2, ""), (3, COPY), (4, COPY + " end"), (5, COPY.upper()), (6, LONG), (7, "short"), (7, "short"), (None, "no id here"), (8, "+1 (499) 555-6503 a@b.c 4111111111111111 and 10.0.0.1")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", 1.0, "s") for i, t in ROWS]
    return spark.createDataFrame(rows, "doc_id bigint, text string, score string, n_words double, lang string").cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("1 = 0")


def test_decontaminate(spark, docs, empty):
    bench = spark.createDataFrame([(10, " ".join(WORDS[:12])), (9, "short"), (None, "no id here"), (11, None), (9, "short")], "item_id bigint, text string")
    got = {(r.doc_id, r.n_words): r for r in decontam.annotate(docs, bench, ["doc_id"]).collect()}
    assert got[(3, 80)].n_hit == 48 and got[(3, 80)]["items"] == ["10"]
    assert got[(7, 1)]["items"] == ["9"] and got[(None, 3)]["items"] == [""] and got[(1, 0)].n_hit == 0
    assert [(h.first, h.last) for h in got[(3, 80)].hits] == [(20 * k, 20 * k + 11) for k in range(4)]
    small = decontam.annotate(docs, bench, ["doc_id"], block_bytes=40)
    assert sorted((r.n_words, r.n_hit, r["items"]) for r in small.collect()) == sorted((r.n_words, r.n_hit, r["items"]) for r in decontam.annotate(docs, bench, ["doc_id"]).collect())
    assert decontam.annotate(empty, bench, ["doc_id"]).count() == 0
    assert {r.n_hit for r in decontam.annotate(docs, bench.where("1 = 0"), ["doc_id"]).collect()} == {0}


def test_neardup(docs, empty):
    rows = neardup.classes(docs).collect()
    assert len(rows) == len(ROWS)
    got = [(r.doc_id, r.class_id) for r in rows]
    assert {c for i, c in got if i in (3, 4, 5)} == {3}
    assert {(i, c) for i, c in got if i not in (3, 4, 5)} == {(1, 1), (2, 2), (6, 6), (7, 7), (8, 8), (None, None)}
    assert neardup.classes(empty).count() == 0


def family(seed, n, spread, shared=200):
    """Texts of one template with own words in its middle, so that similarities lie on both sides of the threshold."""
    import random

    rng = random.Random(seed)
    template = [f"w{i}" for i in range(shared)]
    texts = []
    for k in range(n):
        own = [f"d{k}x{i}" for i in range(rng.randrange(*spread))]
        texts.append(" ".join(template[:100] + own + template[100:]))
    return texts


def brute_classes(texts):
    sets = [set(zip(*(t.split()[i:] for i in range(5)), strict=False)) for t in texts]
    up = list(range(len(texts)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(texts))]


def found_classes(spark, texts):
    rows = neardup.classes(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    return [c for _, c in sorted((r.doc_id, r.class_id) for r in rows)]


def test_neardup_near_threshold(spark):
    texts = family(1, 200, (14, 36))
    assert found_classes(spark, texts) == brute_classes(texts)


def test_neardup_in_cut_buckets(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 8)
    monkeypatch.setattr(neardup, "TILE", 16, raising=False)
    texts = []
    for k in range(12):  # in each family two short texts are linked, and only with each other
        some = family(k, 58, (30, 40)) + family(100 + k, 2, (15, 16))
        some[-2:] = [t.replace("d", "e") for t in some[-2:]]
        texts += [t.replace("w", f"f{k}w").replace("d", f"f{k}d") for t in some]
    assert found_classes(spark, texts) == brute_classes(texts)


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 30)] + [(50, 40), (40, 45)]
    got = {r.node: r.comp for r in neardup.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(31)} | {40: 40, 45: 40, 50: 40}


def test_bpe(docs, empty):
    rows = bpe.encode(docs, ["doc_id"], decoded=True)
    for r in rows.join(docs.select("doc_id", "text"), "doc_id").collect():
        assert bytes(r.decoded) == (r.text or "").encode()
    ids = rows.select("doc_id", "ids")
    assert sorted(bytes(r.decoded) for r in bpe.decode(ids, ["doc_id"]).collect()) == sorted((t or "").encode() for _, t in ROWS)
    assert bpe.encode(empty, ["doc_id"]).count() == 0


def test_token_store(spark, docs, empty, tmp_path):
    token_store.write(docs, f"{tmp_path}/s", segment_ids=50)
    rows = token_store.read(spark, f"{tmp_path}/s").orderBy("start").collect()
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(token_store.default_path())
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 4, 5, 6, 7, 7, 8]
    at = 0
    for r in rows:
        ids = library.encode(dict(ROWS)[r.doc_id] or "", add_special_tokens=False).ids + [2]
        data = b"".join(x.to_bytes(4, "little") for x in ids)
        assert (r.start, r.n_tokens, bytes(r.ids)) == (at, len(ids), data) and zlib.crc32(data) >= 0
        at += len(ids)
    token_store.write(empty, f"{tmp_path}/e")
    assert token_store.read(spark, f"{tmp_path}/e").count() == 0


def brute_pii(t):
    out = [(m.start(), 0, m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        g = [int(x) for x in m[0] if x.isdigit()]
        if 12 <= len(g) <= 19 and sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(g[::-1])) % 10 == 0:
            out.append((m.start(), 2, m.end(), "card"))
    out += [(m.start(), 3, m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= sum(x.isdigit() for x in m[0]) <= 15]
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))


def test_pii_base(spark, empty):
    texts = [None, "", "a@b.c_d@e.f x@y." + "z." * 3000 + "q 1.2.3.4.5.6.7.8 300.1.1.1 000.001.1.0255", "é🎉 +1 (499) 555-6503 4994226020900891 4994-2260-2090-0891 a" * 3, "1 2 " * 3000, "0" * 16 + " " + "5" * 2000, "b" * 2000 + "+12345678+" * 5]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in pii.find(df, ["doc_id"]).collect():
        want = brute_pii(texts[r.doc_id] or "")
        assert ",".join(f"{s.kind}:{s.start}:{s.end}" for s in r.spans if s.base) == want
    assert pii.find(empty, ["doc_id"]).count() == 0


def test_pii_bootstrap(spark):
    """Unseen identifiers: by a pattern of seeds, by one on the right, and by one that only what was found before supports."""
    rows = [f"please call me at +1 (499) 555-{6500 + i} soon" for i in range(8)]
    rows += [f"{w} 10.1.2.{i} answered slowly" for i, w in enumerate(["host", "node", "box", "peer"])]
    rows += [f"please call me at 555-010-99{i}9 soon" for i in range(3)] + [f"my mobile: 555-010-99{i}9" for i in range(3)]
    rows += ["my mobile: 020/7946-0018", "the score was 555-010-8888 today", "version 2.10.433 of it", "see fe80:cd00:0:cde answered", "in 2021/22 and 3.14159 (see 12-345-67)"]
    want = {i: [("phone", "555-010-99%d9" % ((i - 12) % 3))] for i in range(12, 18)} | {18: [("phone", "020/7946-0018")], 21: [("ip", "fe80:cd00:0:cde")]}
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    got = {r.doc_id: [(s.kind, rows[r.doc_id][s.start : s.end]) for s in r.spans if not s.base] for r in pii.find(df, ["doc_id"]).collect()}
    assert {i: x for i, x in got.items() if x} == want
    before = pii.ROUNDS
    try:
        pii.ROUNDS = 1
        assert [r.spans for r in pii.find(df, ["doc_id"]).where("doc_id = 18").collect()] == [[]]
    finally:
        pii.ROUNDS = before


def test_secrets(spark, docs, empty):
    texts = [None, "", 'token = "' + "0af1" * 10 + '"', "AKIA" + "Q2" * 8, "plain"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.found] for r in secret_scan.scan(df, secret_scan.fit(df), ["doc_id"]).collect()}
    assert got == {0: [], 1: [], 2: [("assign", 0, 49), ("hex", 9, 49)], 3: [("access", 0, 20)], 4: []}
    assert secret_scan.scan(empty, secret_scan.fit(empty), ["doc_id"]).count() == 0
    import random

    rng = random.Random(3)
    key = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    rows = [(i, f'plain words here, token="{key()}" and others') for i in range(60)]
    unseen = key()[:30]
    rows += [(100, f"plain words {unseen} here"), (101, "version-2.0.1-release of documents.example.com, 4994226020900891"), (102, "x" * 100000), (103, key() * 2000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.found if not s.base] for r in secret_scan.scan(df, secret_scan.fit(df), ["doc_id"]).collect()}
    assert {i: x for i, x in got.items() if x} == {100: [("format", 12, 42)]}


def test_secrets_are_learnt_from_all(spark):
    """Distinct credentials and ordinary runs beyond any sample, long ones and repeated rows too."""
    import random

    import numpy as np

    rng = random.Random(4)
    draw = lambda marks, n: "".join(rng.choice(marks) for _ in range(n))
    keys = [draw("0123456789abcdef", 32 + i % 9) for i in range(1500)] + [draw("0123456789abcdef", 600) for _ in range(30)]
    runs = [f"Word{i}/{draw('abcxyz', 3 + i % 7)}" for i in range(3000)] + ["x" * 700 + "-end"]
    rows = [(i, f"({k}) ({' '.join(runs[2 * i : 2 * i + 2])})") for i, k in enumerate(keys)] + [(0, f"({keys[0]})")] * 5
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    order = lambda some: sorted(some, key=lambda x: (zlib.crc32(x.encode()), x))
    runs = [x for x in runs if any(x in t.split("(")[-1] for _, t in rows)]
    before = secret_scan.KNOWN
    try:
        for secret_scan.KNOWN in (before, 1000):
            got, want = secret_scan.fit(df), secret_scan.Model({"hex": order(keys)}, order(runs))
            assert list(got.automata) == ["hex"]
            assert np.allclose(got.plain.step, want.plain.step) and np.allclose(got.plain.stop, want.plain.stop)
            assert np.allclose(got.automata["hex"].step, want.automata["hex"].step) and np.allclose(got.automata["hex"].stop, want.automata["hex"].stop)
            assert np.allclose(got.cuts["hex"], want.cuts["hex"], atol=0.01)
    finally:
        secret_scan.KNOWN = before


def test_language_and_quality(spark, docs, empty):
    plain = docs.select("doc_id", "text", "lang")
    got = langid.identify(plain, langid.fit(plain), ["doc_id"]).collect()
    assert len(got) == len(ROWS) and {r.lang_pred for r in got if r.doc_id in (1, 2)} == {"und"} and {r.lang_pred for r in got if r.doc_id == 3} == {"s"}
    assert langid.fit(plain.where("1 = 0")) is None
    assert {r.lang_pred for r in langid.identify(plain, None, ["doc_id"]).collect()} == {"und"}
    labels = spark.createDataFrame([(3, 1), (4, 1), (7, 0), (6, None), (99, 1)], "doc_id bigint, quality int")
    rows = quality.assess(plain, quality.fit(plain, labels), ["doc_id"]).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert quality.fit(plain, labels.where("1 = 0")) is None


def test_training_is_not_filled_by_copies(spark):
    rows = [(1, f"{' '.join(WORDS[:9])} thing", "xx")] * 60 + [(i, f"schön zeit über {WORDS[i]}", "yy") for i in range(2, 8)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert set(langid.fit(df, per_lang=5).langs) == {"xx", "yy"}
    labels = spark.createDataFrame([(1, 1)] * 40 + [(i, 0) for i in range(2, 8)], "doc_id bigint, quality int")
    assert sorted(quality.fit(df, labels, sample=7).labels.tolist()) == [0.0] * 6 + [1.0]


def test_html(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "<p>x"), (3, "<p>x"), (4, "<nav>" * 2000 + "<p>deep")], "page_id bigint, html string")
    rows = html_blocks.extract(df, html_blocks.fit(df), ["page_id"]).collect()
    assert len(rows) == 5 and {r.text for r in rows if r.page_id in (1, 2)} == {""}
    assert html_blocks.extract(df.where("1 = 0"), None, ["page_id"]).count() == 0


def test_nearest_neighbours(spark):
    import numpy as np

    x = np.random.default_rng(8).standard_normal((300, 8)).round(3)
    x[50:150] = x[50]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    odd = [(1000, None), (1001, [0.0] * 8), (1002, [float("nan")] * 8), (1003, [1.0, None] * 4), (1004, [1.0]), (None, [1.0] * 8), (7, rows[7][1])]
    df = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<float>")
    got = ann.search(df, df.where("vec_id % 20 = 0")).collect()
    e = np.array([r[1] for r in rows], np.float32).astype(float)
    hit = 0
    for q in range(0, 300, 20):
        s = e @ e[q]
        want = [i for i in np.lexsort((np.arange(300), -s.round(12))) if i != q][:20]
        own = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r for r, _, _ in own] == list(range(1, 21)) and len({i for _, i, _ in own} - {q}) == 20
        assert [i for _, i, _ in own] == sorted((i for _, i, _ in own), key=lambda i: (-s[i].round(12), i))
        assert max(abs(s[i] - v) for _, i, v in own) < 1e-12
        hit += len({i for _, i, _ in own} & set(want))
    assert hit >= 0.9 * 20 * 15
    assert ann.search(df.where("1 = 0"), df.where("1 = 0")).count() == 0


def test_nearest_neighbours_over_one_block(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    x = rng.standard_normal((6000, 64))
    x[:2000] = rng.standard_normal(64) + 0.3 * x[:2000]
    x[2000:4000] = rng.standard_normal((20, 64))[rng.integers(0, 20, 2000)] + 0.4 * x[2000:4000]
    x = (x * rng.uniform(0.5, 2, (6000, 1))).astype(np.float32)
    assert len(x) > ann.BLOCK
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id bigint, embedding array<float>")
    got = {(r.query_id, r.vec_id) for r in ann.search(df, df.where("vec_id % 30 = 0")).collect()}
    hit = 0
    for q in range(0, 6000, 30):
        s = x.astype(float) @ x[q].astype(float)
        s[q] = -np.inf
        hit += sum((q, int(i)) in got for i in np.argsort(-s, kind="stable")[:20])
    assert hit >= 0.9 * 20 * 200


def test_pipeline(spark, docs, empty, tmp_path):
    import corpus_pipeline as p

    table = docs.select("doc_id", "text", "lang", F.lit("a").alias("source"), F.length("text").cast("bigint").alias("n_chars"), F.lit(1).alias("h"), F.lit(2).alias("predicted"))
    kept = p.one_of_each(spark, table, "")
    assert kept.columns == table.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [None, 1, 2, 3, 6, 7, 8]))
    marked = {r.doc_id: r for r in p.without_pii(spark, table, "").collect()}
    assert marked[8].text == "[PHONE] [EMAIL] [CARD] and [IP]" and marked[8].n_chars == 31 and marked[3].text == COPY
    spark.createDataFrame([(1, " ".join(WORDS[:10]))], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = p.without_benchmark(spark, table, str(tmp_path))
    assert clean.columns == table.columns and 3 not in {r.doc_id for r in clean.collect()} and clean.count() == len(ROWS) - 3
    for f in (p.one_of_each, p.without_pii, p.without_benchmark):
        assert f(spark, table.where("1 = 0"), str(tmp_path)).count() == 0
    assert len(p.STAGES) == 5


def test_pipeline_without_labels(spark, docs, tmp_path):
    import corpus_pipeline as p

    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert p.keep_good(spark, docs, str(tmp_path)).count() == len(ROWS)
    assert p.keep_good(spark, docs.where("1 = 0"), str(tmp_path)).count() == 0
