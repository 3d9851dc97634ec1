"""Embedding filters at every dimension and table size; token splices of texts without boundaries."""

import random
import time

import numpy as np
import pytest
from tokenizers import Tokenizer

from roadrisk.llm import embeddings, tokens

public_tokenizers = pytest.importorskip("public_tokenizers")


def pairs_at(dim, cosine, n, seed=0):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = r.normal(size=(n, dim))
    y -= x * (x * y).sum(axis=1, keepdims=True)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    return x, cosine * x + np.sqrt(1 - cosine ** 2) * y


@pytest.mark.parametrize("dim", [2, 3, 4, 8, 11, 12, 16, 64, 384])
@pytest.mark.parametrize("words", [256, 512])
def test_pairs_at_the_bound_share_a_filter(dim, words):
    n = 60 if dim == 384 else 300
    x, y = pairs_at(dim, 0.98, n)
    shared = [len(np.intersect1d(embeddings.passed_filters(a, words), embeddings.passed_filters(b, words))) > 0 for a, b in zip(x, y)]
    assert np.mean(shared) >= (1.0 if dim < embeddings.LOW_DIMENSIONS else 0.95 if dim > 16 else 0.9)


def test_recall_at_larger_tables():
    x, y = pairs_at(64, 0.98, 200)
    for words in (1024, 2048):
        shared = [len(np.intersect1d(embeddings.passed_filters(a, words), embeddings.passed_filters(b, words))) > 0 for a, b in zip(x, y)]
        assert np.mean(shared) >= 0.95


def test_code_words_follow_the_rows():
    assert [embeddings.words_for(n) for n in (0, 16_384, 16_385, 65_536, 65_537, 10 ** 9)] == [256, 256, 512, 512, 1024, 65536]


@pytest.mark.parametrize("dim", [1, 2, 3, 5, 9])
def test_links_in_low_dimensions_equal_brute_force(spark, dim):
    r = np.random.default_rng(dim)
    v = r.normal(size=(150, dim))
    label = r.integers(0, 2, size=150)
    df = spark.createDataFrame([(int(i), v[i].tolist(), int(label[i])) for i in range(150)], "vec_id long, embedding array<double>, label int")
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    comp = np.arange(150)
    while True:
        low = np.minimum(comp, np.where(near, comp[None, :], 150).min(axis=1))
        if (low == comp).all():
            break
        comp = low
    got = {x.vec_id: (x.n_links, x.component_id) for x in embeddings.near_duplicates(df).collect()}
    assert got == {i: (int(near[i].sum()), int(comp[i])) for i in range(150)}


@pytest.fixture(scope="module")
def path():
    return public_tokenizers.path("byte_bpe_50k.json")


def test_short_texts_count_as_the_library_counts(path):
    """The path of every text up to twice the chunk: pieces between proven boundaries, remembered."""
    library = Tokenizer.from_file(path)
    r = random.Random(1)
    signs = ["a", "the", " ", "  ", "\n", "'s", "1", "<|endoftext|>", "é", "日本", ".", ",", "--", " A", "\r\n", "\0", "ing", "x y"]
    texts = ["".join(r.choice(signs) for _ in range(r.randint(0, 40))) for _ in range(3000)] + ["", None, "x" * 60_000]
    count = tokens.counter(path)
    want = [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]
    assert count(texts) == want and count(texts) == want  # also from memory


@pytest.mark.parametrize("text", ["".join(random.Random(3).choice("abcdefgh") for _ in range(800_000)), "a" * 300_000])
def test_texts_without_boundaries_are_not_quadratic(path, text):
    library = Tokenizer.from_file(path)
    began = time.process_time()
    want = len(library.encode(text, add_special_tokens=False).ids)
    once = time.process_time() - began
    began = time.process_time()
    assert tokens.count_spliced(text, library) == want
    assert time.process_time() - began < 8 * once + 2
