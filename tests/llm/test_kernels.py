"""The operators' kernels against brute force, without Spark."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from ledgerlode.llm import ann, bpe, decontam, html_blocks, langid, neardup, quality, secret_scan, token_store, words

TEXTS = ["", None, "The cat, the DOG and the bird.", "éà 日本 x_y a1", "!!!", "one", "The cat, the DOG and the bird."]


def plain_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def test_words_follow_the_pattern():
    h, first = words.word_hashes(*words.utf8(pa.array(TEXTS)))
    for t, a, b in zip(TEXTS, first[:-1], first[1:], strict=True):
        assert len(plain_words(t)) == b - a
    flat = [w for t in TEXTS for w in plain_words(t)]
    seen = {}
    for w, x in zip(flat, h.tolist(), strict=True):
        assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


def test_words_in_small_blocks(monkeypatch):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab é.") for _ in range(rng.randrange(60))) for _ in range(200)] + ["x" * 300, "", "y" * 50 + "." + "z" * 90]
    want = words.word_hashes(*words.utf8(pa.array(texts)))
    for size in (1, 7, 64):
        monkeypatch.setattr(words, "BLOCK", size)
        got = words.word_hashes(*words.utf8(pa.array(texts)))
        assert (want[0] == got[0]).all() and (want[1] == got[1]).all()


def test_slices_cover_all_rows():
    col = pa.array(["a" * 10] * 7 + ["b" * 100] + [None, ""])
    parts = list(words.slices(col, 25))
    assert [x for a, b in parts for x in range(a, b)] == list(range(10))


def test_winnowing_guarantee():
    rng = np.random.default_rng(0)
    for w in (1, 3, 6):
        h = rng.integers(0, 20, 200).astype(np.uint64)
        kept = decontam.winnow(h, w)
        for i in range(len(h) - w + 1):
            assert any(kept[j] and h[j] == h[i : i + w].min() for j in range(i, i + w))


def test_segments():
    for lengths in ([1], [5, 1, 1, 9000, 2], list(np.random.default_rng(0).integers(1, 3000, 300))):
        ids = np.random.default_rng(1).integers(0, 49000, sum(lengths)).astype("<u2")
        s = token_store.Segment(token_store.pack(np.array(lengths), ids.tobytes(), 2))
        bound = np.concatenate([[0], np.cumsum(lengths)])
        assert (s.boundaries(np.arange(len(bound))) == bound).all() and [s.boundary(i) for i in range(len(bound))] == bound.tolist()
        with pytest.raises(IndexError):
            s.boundary(len(bound))
        assert (s.document(len(lengths) - 1) == ids[bound[-2] :]).all()
    with pytest.raises(ValueError):
        token_store.Segment(b"nope" + bytes(40))


ODD = ["", "a" * 3000, " \n\n  x  ", "日本語" * 100, "x'll we're  \t\n it'.s 'd.'", "\x1c a\x1f b", "é ́ z a̸ .́", "🎉" * 50, "=====-----" * 40, "<|endoftext|>", "A<|endoftext|> b <|ENDOFTEXT|>c<|startoftext|>", "\x00\x85 \x85y", "İSTANBUL ΑΣ ΣΑΣ. ÀÉ!", "ab" * 300 + "ba" * 100, "a   　b  c"]


def test_token_store_encodes_as_the_library():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(token_store.default_path())
    rng = random.Random(9)
    texts = ODD + ["".join(rng.choice("abcxyz") for _ in range(20000))] + ["".join(chr(rng.choice([32, 97, 65, 0xC9, 0x301, 0x4E00, 0x1F600, 10, 39, 48, 0x130])) for _ in range(400)) for _ in range(5)]
    for text, got in zip(texts, token_store.Encoder(token_store.default_path()).encode(texts), strict=True):
        assert np.frombuffer(got, "<u2").tolist() == library.encode(text, add_special_tokens=False).ids


def test_token_store_gives_words_to_a_light_tokenizer_and_keeps_many():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(token_store.default_path())
    own, rng = token_store.Encoder(token_store.default_path()), random.Random(4)
    letters = [chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)] + list("aeinrstTHE")
    words = ["".join(rng.choice(letters if k % 5 else ".,!?;:%&*#$|()") for _ in range(rng.randint(1, 12))) for k in range(3000)]
    texts = [" ".join(words), "Σ İ 日 " + " ".join(words[:1500])]  # the second isn't put in lower case as a whole
    for text, got in zip(texts, own.encode(texts), strict=True):
        assert np.frombuffer(got, "<u2").tolist() == library.encode(text, add_special_tokens=False).ids
    assert own.words is not None

    asked = []
    own._new = lambda chunks: asked.append(len(chunks)) or {c: b"ab" for c in chunks}
    many = " ".join(f"{k:010d}" for k in range(500_000))
    assert own.encode([many]) == own.encode([many]) == [b"ab" * 500_000]
    assert asked == [500_000, 0]


def test_chunks_stay_in_their_limit():
    held, rng, asked = words.Chunks(3 * (words.Chunks.ENTRY + 2)), random.Random(5), []
    for _ in range(200):
        cut = [[rng.choice("abcdef") for _ in range(rng.randint(0, 4))] for _ in range(rng.randint(0, 3))]
        assert held.encode(cut, lambda new: asked.append(len(new)) or {c: c.upper().encode() for c in new}) == ["".join(x).upper().encode() for x in cut]
        assert held.size == held._bytes(held.held) <= held.limit
    assert 0 in asked


def test_bpe_encodes_as_the_library_and_decodes():
    import public_tokenizers
    import tiktoken

    codec = bpe.Codec(bpe.default_path())
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(bpe.default_path()), special_tokens={})
    rng = random.Random(1)
    texts = ODD + ["".join(chr(rng.choice([32, 97, 98, 0xE9, 0x4E00, 0x1F600, 10, 39, 48])) for _ in range(400)) for _ in range(5)]
    draw = lambda marks, n: "".join(rng.choice(marks) for _ in range(n))
    texts += [draw("abcdefghijklmnopqrstuvwxyz", 20000), draw("abcdefghijklmnopqrstuvwxyz", 1000000), "e" * 20000, "e" * 1000000, "tal" * 3000, draw("acgt", 5000), draw("=-", 3000), draw("0123456789", 2000)]
    texts += [draw("theiandsrly" if k % 2 else "aeiou tns", 700) for k in range(20)]
    ids = [np.frombuffer(x, np.int32) for x in codec.encode(texts)]
    for text, got in zip(texts, ids, strict=True):
        assert got.tolist() == other.encode_ordinary(text)
    assert [x.decode() for x in codec.decode(ids)] == texts


def test_bpe_asks_few_queries_for_many_pieces():
    import gc

    import public_tokenizers
    import tiktoken

    codec = bpe.Codec(bpe.default_path())
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(bpe.default_path()), special_tokens={})
    rng = random.Random(11)
    texts = [" ".join("".join(rng.choice("abcdefghijklßéñ") for _ in range(rng.randint(1, 14))) for _ in range(40000)), "", "a", "é"]
    asked = []
    contract = codec._contract
    codec._contract = lambda sql, pieces: asked.append(sum(map(len, pieces))) or contract(sql, pieces)
    assert [np.frombuffer(x, np.int32).tolist() for x in codec.encode(texts)] == [other.encode_ordinary(x) for x in texts]
    assert gc.isenabled() and sum(asked) > 250_000 and len(asked) == 1


def test_bpe_contracts_a_word_once_whatever_mark_follows():
    import public_tokenizers
    import tiktoken

    codec = bpe.Codec(bpe.default_path())
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(bpe.default_path()), special_tokens={})
    rng = random.Random(12)
    texts = ["".join(rng.choice(["ab", "é", "'s", "'", " ", "  ", "\n", "x1", "7", "日", "\u0301", "ß", *".,!?;:%&*#$|()-"]) for _ in range(60)) for _ in range(300)]
    assert [np.frombuffer(x, np.int32).tolist() for x in codec.encode(texts)] == [other.encode_ordinary(x) for x in texts]
    asked = []
    contract = codec._contract
    codec._contract = lambda sql, pieces: asked.extend(pieces) or contract(sql, pieces)
    for mark in ",;!":
        codec.encode([f"zzzaqüx{mark} zzzaqüx{mark}"])
    assert sorted(x for x in asked if len(x) > 1) == sorted(["zzzaqüx".encode(), " zzzaqüx".encode()])


def test_bpe_decodes_runs_of_any_length():
    codec = bpe.Codec(bpe.default_path())
    held = {i: t for t, i in bpe.read_ranks(bpe.default_path()).items()}
    rng = np.random.default_rng(6)
    ids = [rng.integers(0, len(held), n).astype(np.int32) for n in [0, 1, 7, 8, 9, 0, 0, 15, 16, 17, 1000, 0]]
    assert codec.decode(ids) == [b"".join(held[i] for i in x.tolist()) for x in ids]
    assert codec.decode([]) == [] and codec.decode(ids[:1]) == [b""]


def test_darts_estimate_similarity():
    rng = np.random.default_rng(2)
    for shared, own in ((80, 10), (50, 25), (5, 60)):
        a = rng.integers(0, 2**63, shared + own).astype(np.uint64)
        b = np.concatenate([a[:shared], rng.integers(0, 2**63, own).astype(np.uint64)])
        sig = neardup.dart_signatures(np.concatenate([a, b]), np.ones(2 * len(a)), np.array([0, len(a), 2 * len(a)]), 2000)
        assert abs((sig[0] == sig[1]).mean() - shared / (shared + 2 * own)) < 0.05
    ids = np.array([1, 2, 1, 2], np.uint64)
    sig = neardup.dart_signatures(ids, np.array([3.0, 1.0, 1.0, 3.0]), np.array([0, 2, 4]), 3000)
    assert abs((sig[0] == sig[1]).mean() - 2 / 6) < 0.05


def test_spanning_forest():
    rng = np.random.default_rng(3)
    a = rng.uniform(0, 1, (30, 30))
    a = np.maximum(a, a.T)
    np.fill_diagonal(a, -1)

    def parts(pairs):
        up = list(range(30))

        def find(x):
            while up[x] != x:
                x = up[x]
            return x

        for x, y in pairs:
            up[find(x)] = find(y)
        return {frozenset(i for i in range(30) if find(i) == r) for r in map(find, range(30))}

    whole = [(i, j) for i in range(30) for j in range(i) if a[i, j] >= neardup.LEAST_AGREEMENT]
    tree = neardup.forest(a)
    assert parts(tree) == parts(whole) and len(tree) <= 29


def test_hilbert_is_a_path():
    cell = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    key = ann.hilbert(cell, 3)
    assert sorted(key) == list(range(512))
    walk = cell[np.argsort(key)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_language_model():
    rng = random.Random(4)
    vocabulary = {"xx": ["thing", "other", "whole"], "yy": ["schön", "zeit", "über"]}
    make = lambda k: " ".join(rng.choice(vocabulary[k]) for _ in range(20))
    langs = [k for k in vocabulary for _ in range(30)]
    model = langid.Model.fit([make(k) for k in langs], langs)
    got, score = model.predict([make("xx"), make("yy"), "", None, "123 !", "x"])
    assert got[:5] == ["xx", "yy", "und", "und", "und"] and score[2] == 0 and ((score >= 0) & (score <= 1)).all()
    assert model.predict(["½ ① ²", "9ª"])[0][0] == "und" and model.predict([])[0] == []
    grams = lambda x: {x.lower()[i : i + n] for n in range(1, 5) for i in range(len(x) - n + 1)}
    marks, some = [make("xx"), make("yy"), "short"], [make("xx"), "ÜBER zeit", "", "qqq"]
    want = [[len(grams(a) & grams(b)) / max(1, len(grams(a)) * len(grams(b))) ** 0.5 for b in marks] for a in some]
    assert np.abs(langid.Model(["xx"], marks).kernel(some) - want).max() < 0.01  # places of n-grams may collide


def test_quality_model():
    rng = random.Random(5)
    good = [" ".join(rng.choice("abcdefghij") * rng.randint(2, 6) + rng.choice("klmnop") for _ in range(60)) + "." for _ in range(60)]
    bad = ["SPAM!! " * rng.randint(10, 60) for _ in range(60)]
    model = quality.Model.fit(quality.terms(pa.array(good[:40] + bad[:40])), np.array([1] * 40 + [0] * 40))
    score = model.score(quality.terms(pa.array(good[40:] + bad[40:] + ["", None])))
    x = model.project(quality.terms(pa.array(good[40:] + bad[40:] + ["", None])))
    for own, got in zip(x, score, strict=True):  # exact cosine neighbours, one by one
        near = [(-float(own.astype(np.float64) @ v), i) for i, v in enumerate(model.vectors.astype(np.float64))]
        best = sorted(near)[: quality.NEIGHBOURS]
        vote = [max(1e-3, -s) ** quality.POWER for s, _ in best]
        assert abs(sum(v * model.labels[i] for v, (_, i) in zip(vote, best, strict=True)) / sum(vote) - got) < 1e-4
    assert (score[:20] >= 0.7).all() and (score[20:40] < 0.7).all() and ((score >= 0) & (score <= 1)).all()


def draws(rng, marks, n, size):
    return ["".join(rng.choice(marks) for _ in range(size if isinstance(size, int) else rng.randint(*size))) for _ in range(n)]


LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ordinary(rng, n):
    """Words, numbers, names, versions, dates and addresses, as texts have them."""
    word = lambda: "".join(rng.choice(["an", "the", "er", "tion", "re", "in", "al", "ment", "us", "o"]) for _ in range(rng.randint(2, 6)))
    kinds = [lambda: word() + word(), lambda: word().capitalize() + "-" + word(), lambda: f"{word()}.{word()}.com", lambda: f"{rng.randint(1, 9)}.{rng.randint(0, 99)}.{rng.randint(0, 999)}-{word()}", lambda: f"20{rng.randint(10, 29)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}", lambda: str(rng.randrange(10**15, 10**16)), lambda: f"{word()}/{word()}_{rng.randint(1, 99)}.txt", lambda: word().upper() + word().upper()]
    return [x for x in (rng.choice(kinds)() for _ in range(3 * n)) if len(x) >= secret_scan.LEAST][:n]


def test_automata_separate_unseen_credentials_from_hard_negatives():
    rng = random.Random(6)
    keys = ["AKIA" + x for x in draws(rng, UPPER + "234567", 120, 16)]
    hexes = draws(rng, "0123456789abcdef", 120, 40)
    words = ["sk_" + x for x in draws(rng, LOWER + UPPER + "0123456789", 120, (20, 28))]
    model = secret_scan.Model({"access": keys, "hex": hexes, "assign": words}, ordinary(rng, 4000))
    assert sum(a.states for a in model.automata.values()) < 200
    good = draws(rng, "0123456789abcdef", 100, (16, 31)) + ["sk_" + x for x in draws(rng, LOWER + UPPER + "0123456789", 100, (20, 28))]
    bad = ordinary(rng, 4000)
    recall, wrong = model.accepts(good).mean(), model.accepts(bad).sum()
    assert recall >= 0.85 and wrong == 0, (recall, wrong)
    fine = good[int(model.accepts(good).argmax())]
    text = "see " + fine + " and " + "word " * 5
    assert [[text[s:e] for s, _, e in x] for x in model.more([text, None, ""], [[], [], []])] == [[fine], [], []]
    assert model.more([text], [[(0, "hex", 6, "")]]) == [[]]
    assert not secret_scan.Model({"hex": hexes[:5]}, bad).automata
    assert not secret_scan.Model({}).accepts(good).any()


def test_automaton_walks_as_one_by_one():
    rng = random.Random(8)
    some = draws(rng, "abc12", 60, (3, 9))
    a = secret_scan.Automaton(some)
    for s, got in zip(some, a.score(some), strict=True):
        q, total = 0, 0.0
        for c in s:
            k = secret_scan._CLASS[c]
            total += a.step[q, k]
            q = a.goes[q, k]
        assert abs(total + a.stop[q] - got) < 1e-9


def test_automaton_counts_weights():
    rng = random.Random(5)
    some = draws(rng, "ab1", 300, (8, 9)) + ["key-" + x for x in draws(rng, "0123456789", 200, (4, 6))]
    each = sorted(set(some))
    a, b = secret_scan.Automaton(some), secret_scan.Automaton(each, weights=[some.count(x) for x in each])
    assert a.states == b.states > 1 and np.allclose(a.step, b.step) and np.allclose(a.stop, b.stop)


def test_secret_base_matches():
    text = 'é password: "hunter2hunter2" token=short AKIA' + "A1" * 8 + " " + "0af" * 11 + " toKen = x" + "ſecret=abcdefghij"
    got = secret_scan.base(text)
    assert sorted((k, text[s:e]) for s, k, e, _ in got) == sorted([("assign", 'password: "hunter2hunter2'), ("access", "AKIA" + "A1" * 8), ("hex", "0af" * 11)])


PAGE = "<html><head><title>t</title><style>p{{}}</style></head><body><nav><ul><li><a href=/a>Home</a></li></ul></nav><div class=ad>Buy it now.</div><article><h1>{0} &amp; more</h1><p>{1}<p>{2}</article><footer>&copy; x</footer></body></html>"


def test_leaves():
    got = html_blocks.leaves(PAGE.format("T", "a\n <b>b</b><br>c", "d&nbsp;e") + "<script>if (a<b) x</script> tail < end")
    assert [t for _, t, _ in got] == ["Home", "Buy it now.", "T & more", "a b c", "d e", "© x", "tail < end"]
    assert got[1][0] == ("html", "body", "div ad") and got[0][2] == 1.0


def test_labeller():
    rng = random.Random(7)
    text = lambda: " ".join(rng.choice(["some", "words", "of", "text,", "here."]) for _ in range(rng.randint(3, 40)))
    pages = [PAGE.format(text(), text(), text()) for _ in range(60)]
    model = html_blocks.train(pages[:50])
    for page in pages[50:]:
        found = html_blocks.leaves(page)
        assert [t for (_, t, _), k in zip(found, model.label([found])[0], strict=True) if k] == [t for _, t, _ in found[2:5]]
    assert html_blocks.train([]) is None


def test_html_raw_elements():
    texts = lambda page: [x[1] for x in html_blocks.leaves(page)]
    assert texts("<p>so <math><mi>x</mi></math> <object>is <b>read</b></object></p><p>on") == ["so x is read", "on"]
    assert texts("<p>a<svg><text>b</text></svg></p><noscript>c<p>d") == ["a", "c", "d"]
    assert texts("<p>a<script>b<p>c") == ["a"]
