"""Periodic runs, embedding whitening and BPE coding against brute force and the library."""

import hashlib
import random
import time
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from roadrisk.llm import bpe, runs, whitening

public_tokenizers = pytest.importorskip("public_tokenizers")


# ------------------------------------------------------------ periodic runs

def brute_runs(w, least_length=6, least_exponent=4):
    """Every distance, every stretch of equal pairs; the least period of each stretch."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least_length, least_exponent * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, q, e) for (s, e), q in found.items())


def as_rows(found):
    return [(s, q, e) for s, e, q in found.tolist()]


def made_up_words(r):
    w = [r.randrange(r.choice([1, 2, 2, 3, 5])) for _ in range(r.randint(0, 60))]
    if w and r.random() < .5:
        u = w[:r.randint(1, 12)]
        w = w[:r.randint(0, 10)] + u * r.randint(2, 6) + u[:r.randint(0, len(u))] + w[:r.randint(0, 9)]
    return w


def test_runs_against_brute_force():
    r = random.Random(1)
    for _ in range(1500):
        w, exponent, length = made_up_words(r), r.choice([2, 3, 4]), r.choice([1, 6])
        assert as_rows(runs.find_runs(np.array(w, dtype=np.int64), length, exponent)) == brute_runs(w, length, exponent), w


def test_words_appended_in_any_portions_give_the_same_runs():
    r = random.Random(2)
    for _ in range(500):
        w = made_up_words(r)
        catchers, at = runs.SquareCatchers(), 0
        while at < len(w):
            step = r.randint(1, 7)
            catchers.append(np.array(w[at:at + step], dtype=np.int64))
            at += step
        assert as_rows(catchers.finish()) == brute_runs(w, 1, 2), w


def test_a_deceiving_fingerprint_is_noticed(monkeypatch):
    """Prints that hold one bit only: the words are read again with other ones until all rows are proven."""
    words = np.array(list(range(40)) + [7, 8] * 6, dtype=np.int64)
    want = brute_runs(words.tolist())
    real, calls = runs._mixed, []

    def poor(x):
        calls.append(1)
        return real(x) & np.uint64(1) if len(calls) <= 3 else real(x)

    monkeypatch.setattr(runs, "_mixed", poor)
    assert as_rows(runs.find_runs(words)) == want


@pytest.mark.parametrize("words", [
    np.zeros(300_000), np.tile(np.arange(5000), 60), np.tile(np.array([0] * 999 + [1]), 300), np.arange(300_000)],
    ids=["one word", "long period", "runs in a run", "none"])
def test_long_texts_of_any_kind_stay_fast(words):
    began = time.process_time()
    found = as_rows(runs.find_runs(words.astype(np.int64)))
    assert time.process_time() - began < 20
    if len(np.unique(words)) == len(words):
        assert found == []
    else:
        assert (0, {1: 1, 5000: 5000, 2: 1000}[len(np.unique(words))], len(words)) in found


def brute_report(doc_id, text):
    w = (text or "").encode().split()
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    found = brute_runs(w)
    gone = {i for s, q, e in found for i in range(s + q, e)}
    best = max(((e - s, -s, -q) for s, q, e in found), default=None)
    lines = "".join(f"{s},{e - s},{q}\n" for s, q, e in found)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    four = (None,) * 4 if best is None else (-best[1], best[0], -best[2], 1000 * best[0] // -best[2])
    return (doc_id, len(found), *four, sha(lines.encode()), sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_run_report_on_odd_tables(spark):
    r = random.Random(3)
    texts = [None, "", " \n\t", "a", "a a a a a a", "x " + "b c " * 4, "a b " * 30, " w " * 12, "é 日 " * 9,
             " ".join(["go"] * 3000), "k " * 200 + "l " * 200] + [" ".join(map(str, made_up_words(r))) for _ in range(60)]
    rows = [(i, t, "es", i % 3, "run") for i, t in enumerate(texts)] + [(None, "z z z z z z z", None, None, None)] * 2
    rows += [(10 ** 12 + i, " ".join(str(j % 97) for j in range(400)), "x", 1, None) for i in range(25)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, start int, _h string")
    got = runs.run_report(docs)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr(brute_report(x[0], x[1])) for x in rows)
    assert runs.run_report(docs.limit(0)).collect() == []


# ------------------------------------------------------------ whitening

def orthogonal(d, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))[0].astype(np.longdouble)
    for _ in range(3):
        q = q + q @ (np.eye(d) - q.T @ q) / 2
    return q


@pytest.mark.parametrize("values", [
    list(np.linspace(2, 1, 64)), [5, 5 * (1 - 1e-9), 5 * (1 - 2e-9), 3, 3, 1, 1e-3, 0], [10.0] * 3 + [1 + 1e-10 * i for i in range(40)],
    [2.0], [1.0, 1.0, 1.0], [4.0, 0, 0, 0], list(np.geomspace(1e6, 1e-6, 50))])
def test_refined_eigenvectors(values):
    d, q = len(values), orthogonal(len(values))
    values = np.array(values, dtype=np.longdouble)
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    found, x = whitening.eigen_refined(a)
    scale = float(np.abs(a).max())
    assert np.abs(a @ x - x * found).max() < 1e-16 * scale
    assert np.abs(x.T @ x - np.eye(d)).max() < 1e-13
    assert np.abs(found - np.sort(values)[::-1]).max() < 1e-16 * scale
    q = q[:, np.argsort(-values, kind="stable")]
    gaps = np.diff(np.sort(values)[::-1]) / scale
    for i in range(d):  # vectors with a gap around them are right to double precision, far beyond float32
        if (i == 0 or abs(gaps[i - 1]) > 1e-12) and (i == d - 1 or abs(gaps[i]) > 1e-12):
            assert 1 - abs(float(x[:, i] @ q[:, i])) < 1e-12


def test_products_are_exact():
    r = np.random.default_rng(0)
    for low, high, rows in ((-500, 500, 9000), (-2 ** 30, 2 ** 30, 9000), (-3, 3, 0)):
        z = r.integers(low, high, size=(rows, 3))
        o = z.astype(object)
        assert (whitening.exact_products(z) == (o.T @ o if rows else 0)).all()


def brute_whitening(vectors, scale=256):
    """n, deviations, eigenvalues and whitened vectors by plain numpy over the usable rows."""
    use = [(i, v) for i, v in vectors if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(scale * float(c))) for c in v] for _, v in use], dtype=object)
    fit = np.array(sorted(set(map(tuple, x.tolist()))), dtype=object)
    n, s = len(fit), fit.sum(axis=0)
    z = (fit * n - s).astype(np.float64) / n
    e, u = np.linalg.eigh(z.T @ z / n)
    e, u = e[::-1], u[:, ::-1]
    white = ((x * n - s).astype(np.float64) / n) @ u[:, :4] / np.sqrt(np.maximum(e[:4], 1e-300))
    return [i for i, _ in use], n, ((x * n - s) ** 2).sum(axis=1), e, white


@pytest.fixture(scope="module")
def vectors():
    r = np.random.default_rng(4)
    rows = [(i, (r.normal(size=6) * [5, 3, 2, 1, .5, .1]).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, list(rows[7][1])) for i in range(200)]                         # a hot vector
    rows += [(2000, None), (2001, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2002, [float("nan")] * 6), (2003, [float("inf")] + [0.0] * 5), (2004, [])]
    return rows + [(None, [-0.0, 1 / 256, -1 / 512, 1e-9, -1e-9, 3.0]), (5, list(rows[5][1]))]


def test_whitening_against_numpy(spark, vectors):
    df = spark.createDataFrame([(i, v, "a", 1) for i, v in vectors], "vec_id long, embedding array<float>, component string, _x int")
    got = whitening.whitened(df).toPandas()
    ids, n, deviations, e, white = brute_whitening([(i, v if v is None else [None if c is None else float(np.float32(c)) for c in v])
                                                    for i, v in vectors])
    assert len(got) == 4 * len(ids) and set(got.n) == {n}
    assert got.identity_error.max() < 1e-9
    key = lambda i: -1 if i is None or i != i else int(i)
    want = {}
    for i, d, w in zip(ids, deviations, white):
        want.setdefault(key(i), (d, w))
    signs = np.zeros(4)
    for i, c, d, w, x in got[["vec_id", "component", "deviation", "whitened", "explained"]].itertuples(index=False):
        assert d == want[key(i)][0]
        assert abs(x - e[c - 1] / e.sum()) < 1e-9
        mine = want[key(i)][1][c - 1]
        assert abs(abs(w) - abs(mine)) < 1e-7 * max(1, abs(mine))
        if abs(w) > 1e-3:
            assert signs[c - 1] in (0, np.sign(w * mine))   # one sign for all rows
            signs[c - 1] = np.sign(w * mine)


def test_whitening_of_small_tables(spark):
    schema = "vec_id long, embedding array<double>"
    assert whitening.whitened(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whitened(spark.createDataFrame([(1, None)], schema)).collect() == []
    one = whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect()
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in sorted(one)] == [
        (i, c, 1, 0, None, None, None) for i in (1, 2) for c in (1, 2)]
    # one direction only: the second component has no variance; a vector of another length is dropped
    line = whitening.whitened(spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(5)] + [(9, [1.0])], schema)).collect()
    assert len(line) == 10 and all(r.whitened is None for r in line if r.component == 2)
    assert all(abs(r.explained - 1) < 1e-12 and r.identity_error < 1e-12 for r in line if r.component == 1)


def test_whitening_of_large_entries(spark):
    """Entries beyond what is multiplied as whole numbers, and deviations beyond 64 bits."""
    r = np.random.default_rng(1)
    rows = [(i, (r.normal(size=3) * 1e12).tolist()) for i in range(50)]
    got = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).toPandas()
    _, n, deviations, e, white = brute_whitening(rows)
    assert got.identity_error.max() < 1e-9 and got.deviation.isna().all() and min(deviations) >= 2 ** 63
    for i, c, w in got[["vec_id", "component", "whitened"]].itertuples(index=False):
        assert abs(abs(w) - abs(white[i][c - 1])) < 1e-7


# ------------------------------------------------------------ BPE

@pytest.fixture(scope="module")
def path():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library(path):
    return Tokenizer.from_file(path)


@pytest.fixture(scope="module")
def code(path):
    return bpe.Coder(path)


def ids(text):
    return [int(x) for x in text.split(",")] if text else []


ALPHABET = ["a", "b", "e", "t", "h", " ", "  ", "\n", "\t", "'s", "'ll", "1", "9", "<|endoftext|>", "<|endof", "é", "日本", "🙂", ".", ",",
            "--", "=", "aaaa", "THE", "ing", "́", "\r\n", "\0", "ǅ", "²", "Ⅷ", "​", "﻿", "\x1c", "\x85", "՘", "꟎"]


def test_encoding_and_decoding_equal_the_library(code, library):
    r = random.Random(5)
    texts = ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 25))) for _ in range(6000)]
    texts += ["".join(chr(r.choice([r.randint(97, 110), r.randint(32, 126), r.randint(0, 0xd7ff), r.randint(0xe000, 0x10ffff)]))
                      for _ in range(r.randint(0, 30))) for _ in range(2000)]
    for t in texts:
        want = library.encode(t, add_special_tokens=False).ids
        assert ids(code.encode(t)) == want, repr(t)
        assert code.decode(code.encode(t)) == library.decode(want, skip_special_tokens=False) == t


def test_pretokens_equal_the_library_for_every_sign(code, library):
    signs = [chr(c) for c in [*range(0, 0x3400), *range(0xa000, 0xac00), *range(0xf900, 0x11fff), *range(0x1d000, 0x1fbff)]
             if not 0xd800 <= c < 0xe000]
    for s in signs:
        t = f"a{s}1{s} {s}a"
        assert code.bpe.pretokens(t) == [t[a:z] for _, (a, z) in library.pre_tokenizer.pre_tokenize_str(t)], hex(ord(s))


def test_decoding_of_any_ids_equals_the_library(code, library):
    r = random.Random(6)
    for _ in range(3000):
        some = [r.randrange(50257) if r.random() < .5 else r.randrange(256) for _ in range(r.randint(0, 12))]
        assert code.bpe.decode(some) == library.decode(some, skip_special_tokens=False), some


def test_compatibility_is_what_the_library_merges(code, library):
    """Pairs of tokens against the library's encoding of their joined text."""
    r = random.Random(7)
    plain = [i for i, b in code.bpe.bytes.items() if b.isalpha() and b.isascii()]
    for _ in range(20000):
        a, b = r.choice(plain), r.choice(plain)
        joined = (code.bpe.bytes[a] + code.bpe.bytes[b]).decode()
        assert code.bpe.compatible(a, b) == (library.encode(joined, add_special_tokens=False).ids == [a, b]), joined


@pytest.mark.parametrize("text", ["a" * 400_000, "abcdefghij" * 40_000, " " * 200_000, "ab" * 3 + " \n" * 90_000])
def test_long_pretokens_stay_linear(code, library, text):
    began = time.process_time()
    assert ids(code.encode(text)) == library.encode(text, add_special_tokens=False).ids
    assert time.process_time() - began < 20


def test_coding_of_odd_tables(spark, path, library):
    rows = [(0, None, 1), (1, "", 1), (2, "Hi <|endoftext|> you", 1), (2, "Hi <|endoftext|> you", 1), (None, "é" * 5000, None),
            (3, "the cat " * 30_000, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for i, t, _ in rows:
        e = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(e), sha(",".join(map(str, e))), sha(library.decode(e, skip_special_tokens=False))))
    got = list(map(tuple, bpe.coding_report(docs, path).collect()))
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    coded = bpe.encoded(docs, path)
    assert sorted(len(r.ids) for r in coded.collect()) == sorted(x[1] for x in want)
    back = bpe.decoded(coded, path).collect()
    assert sorted((repr(r.doc_id), r.text) for r in back) == sorted((repr(i), t or "") for i, t, _ in rows)
    assert bpe.coding_report(docs.limit(0), path).collect() == []
    null = spark.createDataFrame([(1, None), (2, [999999])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in bpe.decoded(null, path).collect()} == {1: None, 2: ""}


def test_other_kinds_of_files_are_refused():
    with pytest.raises(ValueError):
        bpe.PrefixBPE(public_tokenizers.path("word_bpe_49k.json"))
