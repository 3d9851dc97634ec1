"""Held-out credentials of several formats against ordinary tokens, and the scan over whole tables."""

import random
import string

import numpy as np
import pyarrow.parquet as pq
import pytest

from roadrisk.llm import secrets

MIXED = string.ascii_letters + string.digits
UPPER = string.ascii_uppercase + string.digits


@pytest.fixture(scope="module")
def texts():
    column = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column("text")
    return [t for t in column.to_pylist() if t]


@pytest.fixture(scope="module")
def background(texts):
    counts = sum((secrets.pair_counts(t.encode()) for t in texts), np.zeros(secrets.WIDTH ** 2, dtype=np.int64))
    return secrets.Background(dict(enumerate(counts.tolist())))


def key(r, chars, n):
    return "".join(r.choice(chars) for _ in range(n))


def ordinary(r, words):
    """Names, paths, dates and addresses with digits, of the candidates' length."""
    w, d = lambda: r.choice(words), str(r.randrange(1, 3000))
    made = [w() + w() + w() + d, f"{w()}_{w()}_{d}_{w()}", "".join(w().capitalize() for _ in range(4)) + d,
            f"20{r.randrange(10, 99)}-1{r.randrange(3)}-{r.randrange(10, 28)}T120000Z", f"{w()}.{w()}.v{d}.py", f"{w()}/{w()}/{d}/{w()}",
            f"mail{d}.example.com", f"{w()}-{d}-{w()}-{w()}", w() + d + w().capitalize() + w().capitalize()]
    return [t for t in made if len(t) >= 12]


@pytest.mark.parametrize("make", [
    lambda r: key(r, MIXED, 32), lambda r: key(r, MIXED, 20), lambda r: "ghp_" + key(r, MIXED, 36), lambda r: key(r, MIXED + "+/", 43) + "=",
    lambda r: key(r, UPPER, 24), lambda r: r.choice((key(r, MIXED, 32), "ghp_" + key(r, MIXED, 36), key(r, UPPER, 24)))],
    ids=["base62", "short base62", "prefixed base62", "base64", "upper case", "several"])
def test_held_out_keys_are_found_and_ordinary_tokens_are_not(texts, background, make):
    r = random.Random(11)
    automata = {"assign": secrets.Automaton(sorted(make(r).translate(secrets.SYMBOL) for _ in range(secrets.SAMPLE)))}
    fresh = [make(r) for _ in range(500)]
    assert sum(secrets.accepted(t, automata, background) is not None for t in fresh) >= 450
    words = [w.lower() for t in texts[:200] for w in t.split() if w.isascii() and w.isalpha()]
    others = [t for _ in range(300) for t in ordinary(r, words)]
    assert sum(bool(secrets.like_spans(t, [], automata, background)) for t in others) < len(others) / 100


def test_pair_counts_do_not_depend_on_slices(monkeypatch):
    data = "Ab1+ é xyz_9".encode() * 50
    want = secrets.pair_counts(data)
    plain = np.zeros_like(want)
    codes = data.translate(secrets.CODE_OF)
    for a, b in zip(codes, codes[1:]):
        plain[a * secrets.WIDTH + b] += 1
    assert (want == plain).all() and secrets.pair_counts(b"").sum() == secrets.pair_counts(b"a").sum() == 0
    for size in (1, 7, 599, 600):
        monkeypatch.setattr(secrets, "SLICE", size)
        assert (secrets.pair_counts(data) == want).all()


def test_keys_in_paths_and_assignments_are_read_in_pieces(background):
    r = random.Random(12)
    automata = {"assign": secrets.Automaton(sorted(key(r, MIXED, 32).translate(secrets.SYMBOL) for _ in range(400)))}
    found = key(r, MIXED, 32)
    for text in (f"see /files/{found}/a", f"auth={found}", f"{found}.", f"x.{found}.y"):
        at = text.index(found)
        assert secrets.like_spans(text, [], automata, background) == [(at, at + 32, "like_assign")]
    assert secrets.like_spans(found[:16], [], automata, background) == []  # shorter than every labelled value


def test_scan_learns_whole_values_and_finds_bare_keys(spark, texts):
    """Labelled values train, bare keys of the format are found, prose isn't; longer values than LONGEST are no matter."""
    r = random.Random(13)
    labelled = [(i, f'a line\ntoken = "{key(r, MIXED, 40)}" and more') for i in range(300)]
    labelled.append((300, "secret=" + key(r, MIXED, 100_000)))
    bare = [(1000 + i, f"é once {key(r, MIXED, 40)} was here") for i in range(200)]
    prose = [(2000 + i, t) for i, t in enumerate(texts[:300])]
    docs = spark.createDataFrame(labelled + bare + prose, "doc_id long, text string").selectExpr("*", "1 as pair", "2 as n", "'x' as symbols")
    got = {x["doc_id"]: x for x in secrets.secrets(docs).collect()}
    assert len(got) == 801 and all(got[i]["n_assign"] == 1 for i in range(301))
    assert sum(got[i]["spans"] == "like_assign:7:47" for i, _ in bare) >= 180
    assert sum(got[i]["n_more"] for i, _ in prose) == 0
    assert secrets.learn_automata(docs)["assign"].shortest == 40
