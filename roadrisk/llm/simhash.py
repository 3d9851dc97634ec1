"""SimHash near-duplicates by tiled exact comparison.

A document's fingerprint holds, for each of 64 bits, the majority over the
XXH64 values (seed 42) of its 4-word shingles, repeats included. Fingerprints
link when at most ``RADIUS`` bits differ; documents are grouped by the
connected components of the links.

The search is exact, not a banding heuristic:

* equal fingerprints become one row first, so copies cost nothing;
* each fingerprint goes to a tile, i.e. a part of those with the same
  population count. Two numbers at a distance of at most r have population
  counts at most r apart, so only such tile pairs are compared;
* a tile pair is one row (two packed arrays). Inside it, numpy compares
  sub-tiles by exclusive-or and bit counts, skipping the sub-tiles whose
  population counts of the eight bytes already differ by more than r in sum;
* a tile pair returns a spanning forest of its links, at most one edge for each
  fingerprint, so a dense group of near copies never writes its square.

The comparison still grows with the square of the number of different
fingerprints divided by the two skips; nothing is capped.

Defined results: null and empty texts have the fingerprint zero and link like
any other. Texts under four words hash the whole sequence. Repeated rows give
repeated output rows. An empty table gives an empty result. A null doc_id never
becomes a component id unless its whole component has no other. Very long texts
are hashed whole. The report reads doc_id and text alone; ``one_of_each`` carries all
columns along, whatever their names.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadrisk.llm.common import arrow_map, connected_components, stored

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
TILE_MIN, TILE_MAX, TILES_WANTED = 2048, 65536, 64
SUB = 128            # rows of a sub-tile inside a tile pair
HASHES_AT_ONCE = 65536

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    words = (text or "").encode().translate(LOWER).split()  # splits at 0x20 and 0x09-0x0D only
    if not words:
        return 0
    n = max(1, len(words) - shingle_words + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[min(shingle_words, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, HASHES_AT_ONCE):
        part = zip(starts[at:at + HASHES_AT_ONCE], stops[at:at + HASHES_AT_ONCE])
        h = np.array([digest(joined[a:b], SEED) for a, b in part], dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, keep: list[str], shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """Columns ``keep`` plus fp, the fingerprint as a signed long."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema]

    def make():
        def work(batch):
            fps = np.array([fingerprint(t, shingle_words) for t in batch.column("_text_in").to_pylist()], dtype=np.uint64)
            yield {k: batch.column(k) for k in keep} | {"fp": fps.view(np.int64)}
        return work

    return arrow_map(docs.select(*keep, F.col("text").alias("_text_in")), ", ".join([*fields, "fp long"]), make)


def _byte_counts(v: np.ndarray) -> np.ndarray:
    return np.bitwise_count(v.view(np.uint8).reshape(-1, 8)).astype(np.int16)


def _ordered(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values sorted so that sub-tiles have near byte counts, and the least and
    largest byte counts of each sub-tile."""
    c = _byte_counts(v)
    order = np.lexsort((c[:, 6], c[:, 4], c[:, 2], c[:, 0] + c[:, 1], c[:, :4].sum(axis=1)))
    v, c = v[order], c[order]
    at = np.arange(0, len(v), SUB)
    return v, np.minimum.reduceat(c, at, axis=0), np.maximum.reduceat(c, at, axis=0)


def forest(size: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least label of each of ``size`` nodes under the links i-j."""
    label = np.arange(size)
    while len(i):
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        while True:
            jump = label[label]
            if np.array_equal(jump, label):
                break
            label = jump
        open_ = label[i] != label[j]
        i, j = i[open_], j[open_]
    return label


def tile_links(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges of all links within ``radius`` between the values of a and b."""
    a, lo_a, hi_a = _ordered(a)
    b, lo_b, hi_b = _ordered(b)
    nodes = np.concatenate((a, b))
    label = np.arange(len(nodes))
    for k in range(len(lo_a)):
        gap = np.maximum(np.maximum(lo_a[k] - hi_b, lo_b - hi_a[k]), 0).sum(axis=1)
        near = np.flatnonzero(gap <= radius)
        rows = a[k * SUB:(k + 1) * SUB]
        hit_i, hit_j = [], []
        for s in range(0, len(near), 64):  # at most 64 sub-tiles of b at a time
            cols = (near[s:s + 64, None] * SUB + np.arange(SUB)).ravel()
            cols = cols[cols < len(b)]
            i, j = np.nonzero(np.bitwise_count(rows[:, None] ^ b[cols][None, :]) <= radius)
            hit_i.append(i + k * SUB)
            hit_j.append(cols[j] + len(a))
        if hit_i and sum(map(len, hit_i)):
            i, j = np.concatenate(hit_i), np.concatenate(hit_j)
            i, j = label[i], label[j]
            fresh = i != j
            if fresh.any():
                step = forest(len(nodes), i[fresh], j[fresh])
                label = step[label]
    # Equal values of a and b (a tile against itself) are one node to the caller.
    loose = label != np.arange(len(nodes))
    return nodes[loose], nodes[label[loose]]


def link_edges(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Spanning edges (src, dst) of the links between different values of column fp."""
    spark = fps.sparkSession
    own = stored(fps.select("fp").distinct(), "fingerprints")
    counts = {r["pc"]: r["n"] for r in own.groupBy(F.bit_count("fp").alias("pc")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())  # at most 65 rows reach the driver
    tile = min(TILE_MAX, max(TILE_MIN, total // TILES_WANTED))
    first, tiles = {}, 0
    for pc in range(65):
        first[pc] = tiles
        tiles += -(-counts.get(pc, 0) // tile)
    first[65] = tiles
    if not tiles:
        return spark.createDataFrame([], "src long, dst long")
    starts = F.array(*[F.lit(first[pc]) for pc in range(66)])
    pc = F.bit_count("fp")
    lo, hi = F.element_at(starts, pc + 1), F.element_at(starts, pc + 2)
    last = F.element_at(starts, F.least(pc + radius + 1, F.lit(65)) + 1) - 1  # last tile within the radius
    packed = (own.select("fp", (lo + F.pmod(F.xxhash64("fp"), hi - lo)).alias("tile"), last.alias("last"))
              .groupBy("tile", "last").agg(F.collect_list("fp").alias("a")))
    packed = stored(packed, "tiles")
    # A third of a task's work per pair or less, and a bounded number of pairs in an Arrow batch.
    pairs = sum(first[min(p + radius + 1, 65)] - t for p in range(65) for t in range(first[p], first[p + 1]))
    left = packed.select("a", F.explode(F.sequence("tile", "last")).alias("other"))
    right = packed.select(F.col("tile").alias("other"), F.col("a").alias("b"))
    parts = max(spark.sparkContext.defaultParallelism * 2, int(spark.conf.get("spark.sql.shuffle.partitions")), pairs // 32)
    both = left.join(right.hint("shuffle_merge"), "other").repartition(parts)

    def make():
        def work(batch):
            for a, b in zip(batch.column("a"), batch.column("b")):
                u, v = tile_links(np.asarray(a.values).view(np.uint64), np.asarray(b.values).view(np.uint64), radius)
                if len(u):
                    yield {"src": u.view(np.int64), "dst": v.view(np.int64)}
        return work

    return arrow_map(both.select("a", "b"), "src long, dst long", make)


def with_component(by_fp: DataFrame, fps: DataFrame, radius: int) -> DataFrame:
    """Adds component, the group of column fp."""
    comp = connected_components(link_edges(fps, radius)).withColumnRenamed("node", "fp")
    return by_fp.join(comp, "fp", "left").withColumn("component", F.coalesce("component", "fp"))


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of docs."""
    rows = stored(fingerprints(docs.select("doc_id", "text"), ["doc_id"], shingle_words), "simhash")
    own = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    named = with_component(own, rows, radius)
    low = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    classes = named.join(low, "component").select("fp", "component_id")
    return rows.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows and columns of docs, one row of each group: the one with the least
    doc_id (null last) and, among rows that share it, the least hash of the row. A
    doc_id that is null or repeated does not make different texts one document."""
    # Null and empty texts are in one group anyway. Maps can't be hashed; rows that differ there alone are copies.
    rest = [F.col(f"`{f.name}`") for f in docs.schema if f.name not in ("doc_id", "text") and not re.search(r"\b(map|variant)\b", f.dataType.simpleString())]
    parts = [F.coalesce("text", F.lit("")), F.col("doc_id").isNull(), F.col("doc_id"), *rest]
    key = ["h1", "h2"]
    hashed = docs.select(F.struct("*").alias("row"), "doc_id", "text", F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(1), *parts).alias("h2"))
    fps = stored(fingerprints(hashed, ["doc_id", *key], shingle_words), "simhash")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", *key)
    own = fps.groupBy("fp").agg(F.min(place).alias("first"))
    kept = with_component(own, fps, radius).groupBy("component").agg(F.min("first").alias("first")).select("first.h1", "first.h2")
    # Plain equality on one key, so that one shuffle of the texts serves both steps.
    return hashed.select("row", *key).dropDuplicates(key).join(kept.hint("shuffle_merge"), key, "left_semi").select("row.*")
