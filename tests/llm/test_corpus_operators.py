"""Dedup, decontamination, mixing, embeddings and language ID against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from roadrisk.llm import common, decontam, embeddings, langid, linededup, mixing, simhash

SF = "/root/testdata/sf0.001"


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, a clashing extra column."""
    long_ = " ".join(f"w{i % 977}x" for i in range(60_000))
    rows = [(1, "one two three four five six", "en", "a", 1), (1, "one two three four five six", "en", "a", 1), (2, None, None, None, None),
            (3, "", "en", None, 0), (None, "nobody owns this line of words at all here", None, "b", 2), (4, long_, "de", "b", 3),
            (5, "\n\n \t\n", "en", "a", 4), (6, "one two three four five six", "en", None, 5), (7, "123 !!", "xx", "b", 1)]
    return docs_of(spark, rows).selectExpr("*", "1 as component", "'z' as h1", "0 as size", "0 as fp", "2 as pos")


def components(n, links):
    label = list(range(n))

    def find(x):
        while label[x] != x:
            label[x] = label[label[x]]
            x = label[x]
        return x
    for a, b in links:
        a, b = sorted((find(a), find(b)))
        label[b] = a
    return [find(x) for x in range(n)]


def test_components(spark):
    r = random.Random(1)
    links = [(i, i + 1) for i in range(0, 200)] + [(1000, 1000 + i) for i in range(300)] + [(r.randrange(300, 900), r.randrange(300, 900)) for _ in range(400)]
    got = {x["node"]: x["component"] for x in common.connected_components(spark.createDataFrame(links, "src long, dst long")).collect()}
    want = components(2000, links)
    assert all(got.get(i, i) == want[i] for i in range(2000))
    assert common.connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


# --- SimHash

def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def test_fingerprint_is_the_plain_one():
    for t in (None, "", " \n", "one", "One two\x0bthree", "a b c d", "É é a b c D e f\x1fg h i j k", " ".join(map(str, range(500)))):
        assert simhash.fingerprint(t) == plain_fingerprint(t)


def test_simhash_groups_against_all_pairs(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for table in (docs, odd.select(*docs.columns)):
        rows = table.select("doc_id", "text").collect()
        got = simhash.near_duplicates(table).collect()
        assert len(got) == len(rows)
        fps = [plain_fingerprint(r["text"]) for r in rows]
        links = [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
        group = components(len(rows), links)
        first = collections.defaultdict(lambda: None)
        for r, g in zip(rows, group):
            if r["doc_id"] is not None:
                first[g] = min(r["doc_id"], first[g]) if first[g] is not None else r["doc_id"]
        want = sorted((str(r["doc_id"]), f"{fp:016x}", str(first[g])) for r, fp, g in zip(rows, fps, group))
        assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in got) == want
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_one_of_each_keeps_a_row_of_every_group(spark):
    """Null and repeated ids do not make different texts one document."""
    r = random.Random(12)
    text = [" ".join(r.choice("abcdefghijklmnopqrstuvwxyz") * 3 + str(r.randrange(99)) for _ in range(80)) for _ in range(9)]
    rows = [(None, text[0]), (None, text[1]), (None, text[1]), (None, text[2]), (1, text[2]), (2, text[3]), (2, text[4]), (2, text[4]),
            (3, text[4]), (4, text[5]), (4, text[6]), (5, text[6]), (None, None), (6, ""), (4, text[7])]
    rows = [(i, t, "en", None, n % 3) for n, (i, t) in enumerate(rows)]
    docs = docs_of(spark, rows).selectExpr("*", "map('k', doc_id) as h1", "'z' as row", "1 as fp")
    out = simhash.one_of_each(docs)
    assert out.columns == docs.columns
    want = [(None, text[0]), (None, text[1]), (1, text[2]), (2, text[3]), (2, text[4]), (4, text[5]), (4, text[6]), (4, text[7]), (6, "")]
    key = lambda x: (str(x[0]), str(x[1]))
    got = sorted(((x["doc_id"], x["text"], x["n_chars"]) for x in out.collect()), key=key)
    assert [x[:2] for x in got] == sorted(want, key=key)
    again = simhash.one_of_each(docs.repartition(5)).collect()
    assert sorted(((x["doc_id"], x["text"], x["n_chars"]) for x in again), key=key) == got


def test_tile_links_keep_every_component():
    r = np.random.default_rng(2)
    base = r.integers(0, 2 ** 63, 40, dtype=np.uint64)
    flips = [np.uint64(0), np.uint64(1), np.uint64(6), np.uint64(1 << 40 | 1 << 3)]
    a = np.unique(np.concatenate([base ^ f ^ (np.uint64(1) << np.uint64(r.integers(0, 63))) for f in flips for _ in range(8)]))
    u, v = simhash.tile_links(a, a, 4)
    place = {int(x): i for i, x in enumerate(a)}
    want = components(len(a), [(i, j) for i in range(len(a)) for j in range(i) if int(a[i] ^ a[j]).bit_count() <= 4])
    assert components(len(a), [(place[int(x)], place[int(y)]) for x, y in zip(u, v)]) == want
    assert len(u) <= 2 * len(a)


# --- decontamination

def plain_words(t):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_contamination(docs, items):
    windows = collections.defaultdict(set)
    for item, text in items:
        w = plain_words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if w and item is not None else 0):
            windows[tuple(w[i:i + n])].add(str(item))
    sizes = {len(w) for w in windows}
    for doc_id, text in docs:
        w, hit, found = plain_words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if items_ := windows.get(tuple(w[i:i + n])):
                    found |= items_
                    hit |= set(range(i, i + n))
        yield (str(doc_id), len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))


@pytest.mark.parametrize("block_bytes", [decontam.BROADCAST_BYTES, 2000])
def test_contamination_against_brute_force(spark, odd, monkeypatch, block_bytes):
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", block_bytes)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(odd.select("doc_id", "text")).unionByName(
        spark.createDataFrame([(900, "We say One, TWO. three! four five six seven eight nine ten eleven"), (901, "be be be be")], "doc_id long, text string"))
    extra = [(1000, "two three four five six seven eight nine ten eleven twelve"), (1001, "Be be"), (1002, None), (1003, "..."), (None, "one"),
             (1004, "be"), (1001, "Be be"), (1005, "eight nine")]
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").unionByName(spark.createDataFrame(extra, "item_id long, text string"))
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in decontam.contamination(docs, bench).collect())
    assert got == sorted(plain_contamination([tuple(r) for r in docs.collect()], [tuple(r) for r in bench.collect()]))
    assert any(r[2] for r in got)
    assert decontam.contamination(docs.limit(0), bench).count() == 0
    assert decontam.contamination(docs, bench.limit(0)).filter("contaminated").count() == 0


# --- line dedup

def plain_line_drops(rows):
    lines = []
    for doc_id, text in sorted((r for r in rows if r[0] is not None and r[1] is not None)):
        lines += [(doc_id, no, tuple(w)) for no, line in enumerate(text.split("\n")) if (w := line.split())]
    unique = sorted({w for _, _, w in lines})
    place = {w: i for i, w in enumerate(unique)}

    def one_edit(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) <= 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    near = [w for w in unique if len(w) >= linededup.NEAR_WORDS]
    group = components(len(unique), [(place[a], place[b]) for i, a in enumerate(near) for b in near[:i] if one_edit(a, b)])
    first, drops = {}, collections.defaultdict(set)
    for doc_id, no, w in lines:
        if first.setdefault(group[place[w]], (doc_id, no)) != (doc_id, no):
            drops[doc_id].add(no)
    return {k: sorted(v) for k, v in drops.items()}


def test_line_drops_against_brute_force(spark, odd):
    r = random.Random(7)
    base = " ".join(r.choice("alpha beta gamma delta rho") for _ in range(12)).split()
    lines = [" ".join(base)]
    for _ in range(60):  # one edit at a time from a line seen before
        w = r.choice(lines).split()
        i = r.randrange(len(w))
        w = r.choice([w[:i] + w[i + 1:], w[:i] + [r.choice("xyz")] + w[i:], w[:i] + [r.choice("uvw")] + w[i + 1:]])
        lines.append("  ".join(w))
    lines += [f"template line with one number {i} and then some more words" for i in range(50)] + ["short line", "short  line", "a a a a a a a a a", "a a a a a a a a"]
    r.shuffle(lines)
    rows = [(100 + i, "\n".join(lines[i * 4:i * 4 + 4])) for i in range(30)]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(odd.select("doc_id", "text")).unionByName(
        spark.createDataFrame(rows, "doc_id long, text string"))
    got = {x["doc_id"]: x["dropped"] for x in linededup.dropped_lines(docs).collect()}
    assert got == plain_line_drops([tuple(x) for x in docs.collect()])
    report = linededup.line_report(odd).collect()
    assert len(report) == odd.count()
    kept = linededup.dedup_lines(odd)
    assert kept.columns == odd.columns
    assert 6 not in [x["doc_id"] for x in kept.collect()] and None in [x["doc_id"] for x in kept.collect()]
    assert linededup.dropped_lines(docs.limit(0)).count() == 0


def test_halves_lose_no_pair():
    """Any two lines one edit apart share a half, and a variant key where needed."""
    r = random.Random(8)
    for n in range(8, 40):
        w = [str(r.random()).encode() for _ in range(n + 1)]
        for i in range(n):
            for other in (w[:i] + w[i + 1:], w[:i] + [b"!"] + w[i + 1:]):
                pre, suf = linededup.half_keys(w)
                pre2, suf2 = linededup.half_keys(other)
                assert {*pre} & {*pre2} or {*suf} & {*suf2}


# --- mixing

def check_mix(rows, limit=2):
    size, target, taken, total = {}, {}, collections.Counter(), 0
    for r in rows:
        assert r["taken"] in [k * r["size"] for k in range(limit + 1)] and len(r["shards"]) == (r["taken"] // r["size"] if r["size"] else 0)
        size[r["source"]], target[r["source"]] = r["source_size"], r["target"]
        taken[r["source"]] += r["taken"]
        total += r["size"]
    assert sum(target.values()) == pytest.approx(1.5 * total)
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None] * (None in size)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    open_ = [s for s in names if target[s] < 2 * size[s]]
    assert all(target[s] <= 2 * size[s] for s in names)
    levels = [target[s] / weight[s] for s in open_]
    assert max(levels) - min(levels) < 1e-6 * max(levels) if levels else True
    assert all(2 * size[s] <= weight[s] * levels[0] + 1e-6 for s in names if s not in open_) if levels else True
    return target, taken


def test_mix_reaches_its_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.mix_counts(docs, block_words=2000, shard_words=80_000).join(docs.select("doc_id", "source"), "doc_id").collect()
    assert len(rows) == docs.count() and max(s for r in rows for s in r["shards"]) >= 4
    target, taken = check_mix(rows)
    for s in target:
        assert abs(taken[s] - target[s]) <= max(30, 0.01 * target[s])


def test_mix_is_repeatable_and_equals_its_counts(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    options = {"block_words": 1000, "shard_words": 25_000}
    counts = common.stored(mixing.mix_counts(docs, **options), "mix")
    assert counts.exceptAll(mixing.mix_counts(docs.repartition(7), **options)).count() == 0
    per_doc = mixing.mix(docs, **options).groupBy("doc_id").agg(F.sum(mixing.size_of(F.col("text"))).alias("taken"))
    assert {r["doc_id"]: r["taken"] for r in per_doc.collect()} == {r["doc_id"]: r["taken"] for r in counts.collect() if r["taken"]}
    odd_rows = mixing.mix_counts(odd.drop("size")).collect()
    assert len(odd_rows) == odd.count() and all(r["taken"] == 0 for r in odd_rows if r["size"] == 0)
    assert mixing.mix_counts(docs.limit(0)).count() == 0


def test_many_repeated_rows_are_one_row(spark):
    docs = docs_of(spark, [(1, "a b c", "en", "s", 5)] * 300 + [(2, "a b", "en", "t", 3)] * 5)
    rows = mixing.mix_counts(docs).withColumn("source", F.when(F.col("doc_id") == 1, "s").otherwise("t")).collect()
    target, taken = check_mix(rows)
    assert all(abs(taken[s] - target[s]) <= 3 for s in target) and len(rows) == 305
    assert mixing.mix(docs).count() == sum(r["taken"] // r["size"] for r in rows)


@pytest.mark.parametrize("long_, place", [(300_000, 0.45), (600_000, 0.3), (900_000, 0.3)])
def test_mix_fills_up_beside_a_very_long_document(spark, long_, place):
    """One source of 1,000,000 words; its very long document lies where the last pass ends."""
    at = spark.range(1000).select("id", mixing.uniform(F.lit(7), F.col("id"), F.lit("s"), F.lit(long_).cast("long")).alias("u"))
    doc_id = min(at.collect(), key=lambda r: abs(r["u"] - place))["id"]
    small = spark.range(1000, 1000 + (1_000_000 - long_) // 50).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), F.lit(50)).alias("text"))
    docs = small.unionByName(spark.createDataFrame([(doc_id, "w " * long_)], "doc_id long, text string")).withColumn("source", F.lit("s"))
    rows = mixing.mix_counts(docs).withColumn("source", F.lit("s")).collect()
    assert len(rows) == docs.count() and {r["source_size"] for r in rows} == {1_000_000}
    taken = check_mix(rows)[1]["s"]
    # All short documents twice is the most that can be had without the long one.
    assert 0 <= 1_500_000 - taken <= max(50, 1_500_000 - (2 * 1_000_000 - long_))
    assert all(s is not None for r in rows for s in r["shards"])


def test_hypergeometric_draws(spark):
    """Means and variances of many draws, and every draw within its bounds."""
    cases = [(100, 30, 50), (10, 10, 4), (10, 0, 4), (1_000_000, 300_000, 500_000), (7, 3, 7), (50, 49, 1)]
    for total, marked, drawn in cases:
        n = 4000
        df = spark.range(n).select(mixing.hypergeometric(*(F.lit(x).cast("long") for x in (total, marked, drawn)), mixing.uniform(F.col("id"), F.lit(total))).alias("x"))
        x = np.array([r[0] for r in df.collect()], dtype=float)
        p = marked / total
        mean, var = drawn * p, drawn * p * (1 - p) * (total - drawn) / max(1, total - 1)
        assert x.min() >= max(0, drawn - total + marked) and x.max() <= min(drawn, marked)
        assert abs(x.mean() - mean) <= 5 * (var / n) ** 0.5 + 1e-9
        assert var == 0 or abs(x.var() / var - 1) < 0.15


def test_splitting_tree_is_exact(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP", 3)  # several groups, so both levels of the tree
    quotas = [5, 0, 40, 7, 100, 1, 23, 8]
    df = spark.createDataFrame(list(enumerate(quotas)), "source_no long, quota long")
    leaves = mixing.deal(df, 7, 3).collect()
    by_source, by_shard = collections.Counter(), collections.Counter()
    for r in leaves:
        assert r["quota"] >= 0
        by_source[r["source_no"]] += r["quota"]
        by_shard[r["shard"]] += r["quota"]
    assert [by_source[i] for i in range(len(quotas))] == quotas
    assert max(by_shard.values()) - min(by_shard.values()) <= 1 and len(by_shard) == 7


# --- embeddings

def test_embedding_links_against_brute_force(spark):
    r = np.random.default_rng(3)
    centre = r.normal(size=(60, 32))
    rows = [(i, (c / np.linalg.norm(c)).tolist(), int(i % 2)) for i, c in enumerate(centre)]
    rows += [(100 + i, (centre[i % 6] / np.linalg.norm(centre[i % 6]) + r.normal(size=32) * 0.02).tolist(), int(i % 6 % 2)) for i in range(150)]
    rows += [(300 + i, rows[0][1], 0) for i in range(40)] + [(400, rows[0][1], 1), (401, rows[0][1], None)]
    rows += [(500, None, 0), (501, [0.0] * 32, 0), (502, [float("nan")] * 32, 0), (503, [float("inf")] + [1.0] * 31, 0), (504, [None] * 32, 0),
             (505, [], 0), (506, [1.0] * 5, 0), (507, [2.0] * 5, 0), (508, [-0.0, 1.0], 0), (509, [0.0, 1.0], 0), (None, rows[0][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("component", F.lit(1))
    got = {x["vec_id"]: x for x in embeddings.near_duplicates(df).collect()}
    assert len(got) == len(rows)
    stored = {x["vec_id"]: x for x in df.collect()}

    def linkable(x):
        e = x["embedding"]
        return x["vec_id"] is not None and x["label"] is not None and bool(e) and all(v is not None and np.isfinite(v) for v in e) and any(e)

    ok = sorted((x for x in stored.values() if linkable(x)), key=lambda x: x["vec_id"])
    unit = [np.array(x["embedding"], dtype=float) / np.linalg.norm(np.array(x["embedding"], dtype=float)) for x in ok]
    links = [(i, j) for i in range(len(ok)) for j in range(i) if ok[i]["label"] == ok[j]["label"] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98]
    n = collections.Counter(k for link in links for k in link)
    assert sum(got[x["vec_id"]]["n_links"] for x in ok) >= 0.97 * 2 * len(links)
    assert all(got[x["vec_id"]]["n_links"] <= n[i] for i, x in enumerate(ok))
    group = components(len(ok), links)
    assert sum(got[x["vec_id"]]["component_id"] == ok[group[i]]["vec_id"] for i, x in enumerate(ok)) >= 0.97 * len(ok)
    for v in (401, 500, 501, 502, 503, 504, 505):
        assert (got[v]["n_links"], got[v]["component_id"], got[v]["kept"]) == (0, v, True)
    assert got[507]["component_id"] == 506 and got[509]["component_id"] == 508 and got[None]["kept"] is False
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_cap_filters_recall_at_the_bound():
    r = np.random.default_rng(4)
    x = r.normal(size=(250, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = r.normal(size=x.shape)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = 0.98 * x + (1 - 0.98 ** 2) ** 0.5 * z
    shared = [len(np.intersect1d(embeddings.passed_filters(a), embeddings.passed_filters(b))) > 0 for a, b in zip(x, y)]
    assert np.mean(shared) >= 0.95
    # list decoding finds exactly the filters whose inner product reaches the threshold
    want = []
    for t, (rot, words, least) in enumerate(embeddings.codes(64)):
        v = x[0] @ rot
        s = (words[0] @ v[:32])[:, None] + (words[1] @ v[32:])[None, :]
        want += (t * embeddings.WORDS ** 2 + np.flatnonzero(s.ravel() >= least)).tolist()
    assert embeddings.passed_filters(x[0]).tolist() == want


# --- language ID

def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = langid.language_id(docs).join(docs.select("doc_id", "lang", F.length("text").alias("chars")), "doc_id").filter("held_out and lang is not null").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) >= 0.985
    assert np.mean([r["lang"] == r["lang_pred"] for r in got if 8 <= r["chars"] < 100]) >= 0.95
    assert np.mean([r["lang"] == r["lang_pred"] for r in got if r["chars"] >= 100]) >= 0.985
    assert all(0 <= r["score"] <= 1 for r in got)
    assert np.mean([r["accepted"] for r in got if r["chars"] >= 8]) >= 0.99


def test_language_id_odd_rows(spark, odd):
    got = {r["doc_id"]: r for r in langid.language_id(odd).collect()}
    assert len(got) == 8
    for k in (2, 3, 5, 7):
        assert got[k]["lang_pred"] == "und" and got[k]["score"] == 0.0 and not got[k]["accepted"]
    assert got[None]["held_out"] is False
    assert langid.language_id(odd.limit(0)).count() == 0
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.language_id(unlabelled).collect()} == {"und"}


# --- pipeline

def test_pipeline_runs_on_odd_and_empty_documents(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for table in (docs, odd.selectExpr(
            "*", "'x' as shards", "1 as accepted", "2 as score", "3 as dropped", "4 as row", "5 as text_hash", "6 as rows", "7 as copies", "8 as _text_in"), docs.limit(0)):
        now = table
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = common.stored(stage(spark, now, SF), name)
            if i < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == table.columns
                assert out.count() <= now.count()
            now = out
        assert now.columns == [*table.columns, "shard", "copy"]
    own = docs.withColumn("shard", F.lit("mine")).withColumn("copy", F.lit("mine"))
    assert corpus_pipeline.mix(spark, own, SF).columns == [*docs.columns, "shard", "copy"]


def test_pipeline_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lines = corpus_pipeline.line_dedup(spark, docs, SF)
    drops = plain_line_drops([(r["doc_id"], r["text"]) for r in docs.collect()])
    want = {}
    for r in docs.collect():
        t = "\n".join(x for i, x in enumerate(r["text"].split("\n")) if i not in drops.get(r["doc_id"], ()))
        if r["doc_id"] not in drops or t.strip():
            want[r["doc_id"]] = t
    assert {r["doc_id"]: r["text"] for r in lines.collect()} == want
    one = corpus_pipeline.simhash_near_dedup(spark, docs, SF)
    assert {r["doc_id"] for r in one.collect()} == {r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    clean = {r["doc_id"] for r in corpus_pipeline.decontamination(spark, docs, SF).collect()}
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert clean == {int(r[0]) for r in plain_contamination([(r["doc_id"], r["text"]) for r in docs.collect()], bench) if not r[5]}
    accepted = {r["doc_id"] for r in corpus_pipeline.language_id(spark, docs, SF).collect()}
    assert accepted == {r["doc_id"] for r in langid.language_id(docs).collect() if r["accepted"]}
