"""Benchmark decontamination: a prefix-filtered set join with exact verification.

An item is cut into windows of ``WINDOW`` consecutive words (a shorter item is
one window). A document is contaminated where it holds a whole window, word by
word. The join works on short word shingles:

1. every shingle of every window is counted over all documents (rarity order);
2. a window must be contained whole, so its necessary prefix is its single
   rarest shingle; a window with a shingle that no document has is dropped;
3. documents emit a candidate wherever a prefix shingle occurs, with the words
   around it, and candidates join the windows on the shingle;
4. the position of the shingle in the window bounds where the window can start
   and end (positional and length bounds); the words there are compared exactly.

The documents are read twice and never exploded into all their words. The
shingles to look for reach the tasks as broadcasts of bounded size: beyond
``BROADCAST_BYTES`` they are cut into blocks, each matched against all documents.

Defined results: null and empty texts have no words and no hits. Items without
words, and null item_ids, match nothing; repeated items count once. Rows with
the same doc_id are judged one by one. Empty tables give no hits or no rows. Very
long texts and items are read whole. ``clean_documents`` carries all columns of the
documents along, whatever their names; other columns of the benchmark aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadrisk.llm.common import arrow_map, stored

WINDOW = 10
SHINGLE = 3                      # words in a shingle; windows with fewer words are one shingle
BROADCAST_BYTES = 32 * 2 ** 20   # of shingles in one broadcast
MAX_WORDS = 2 ** 20              # different words in one broadcast: three ids fit one long

# Lower-case A-Z; digits, letters and every byte of a non-ASCII character stay; all else separates.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
                   for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORD_BYTES).split()


def windows_of(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(window, n, items): each different window, its word count and the sorted ids of its items."""
    def make():
        def work(batch):
            ids, out, sizes = [], [], []
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
                w = words_of(text)
                if not w or item is None:
                    continue
                n = min(window, len(w))
                found = {b" ".join(w[i:i + n]).decode() for i in range(len(w) - n + 1)}
                out += found
                ids += [str(item)] * len(found)
                sizes += [n] * len(found)
            yield {"item": ids, "window": out, "n": sizes}
        return work

    rows = arrow_map(benchmark.select("item_id", "text"), "item string, window string, n int", make)
    return rows.groupBy("window", "n").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _shingles(window: Column, n: Column) -> Column:
    """array<struct<shingle, offset>> of a window."""
    w = F.split(window, " ")
    k = F.least(n, F.lit(SHINGLE))
    return F.transform(F.sequence(F.lit(0), n - k), lambda o: F.struct(
        F.array_join(F.slice(w, o + 1, k), " ").alias("shingle"), o.alias("offset")))


class ShingleIndex:
    """Positions of a bounded set of shingles (of one to SHINGLE words) in a list of words."""

    def __init__(self, shingles: list[str]):
        split = [s.encode().split() for s in shingles]
        self.ids = {w: i for i, w in enumerate(sorted({w for s in split for w in s}))}
        self.base = len(self.ids) + 1
        self.keys = {}
        for k in {len(s) for s in split}:
            rows = [(self._key([self.ids[w] for w in s]), i) for i, s in enumerate(split) if len(s) == k]
            rows.sort()
            self.keys[k] = (np.array([r[0] for r in rows], dtype=np.int64), np.array([r[1] for r in rows]))

    def _key(self, ids: list[int]) -> int:
        key = 0
        for i in ids:
            key = key * self.base + i
        return key

    def find(self, words: list[bytes]):
        """Yields (positions, index into the shingles) for each shingle length."""
        get = self.ids.get
        ids = np.fromiter((get(w, -1) for w in words), dtype=np.int64, count=len(words))
        known = ids >= 0
        for k, (keys, index) in self.keys.items():
            if len(ids) < k:
                continue
            m = len(ids) - k + 1
            ok = known[:m].copy()
            for s in range(1, k):
                ok &= known[s:m + s]
            at = np.flatnonzero(ok)
            if not len(at):
                continue
            key = ids[at]
            for s in range(1, k):
                key = key * self.base + ids[at + s]
            spot = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = keys[spot] == key
            if hit.any():
                yield at[hit], index[spot[hit]]


def _blocks(shingles: DataFrame) -> Iterator[list[str]]:
    """The different values of column shingle, one driver-side block of bounded
    size at a time; one empty block if there are none."""
    own = stored(shingles.select("shingle").distinct(), "shingles")
    size = own.agg(F.coalesce(F.sum(F.octet_length("shingle") + 16), F.lit(0)).alias("b"), F.count(F.lit(1)).alias("n")).first()
    n = max(1, -(-size["b"] // BROADCAST_BYTES), -(-size["n"] * SHINGLE // MAX_WORDS))
    for i in range(n):
        yield [r[0] for r in own.filter(F.pmod(F.xxhash64("shingle"), F.lit(n)) == i).sort("shingle").collect()]


def shingle_counts(docs: DataFrame, shingles: DataFrame) -> DataFrame:
    """(shingle, df): occurrences of each shingle over all documents; absent ones have no row."""
    spark, counts = docs.sparkSession, None
    for block in _blocks(shingles):
        shared = spark.sparkContext.broadcast(block)

        def make(shared=shared):
            index = ShingleIndex(shared.value)

            def work(batch):
                total = np.zeros(len(shared.value), dtype=np.int64)
                for text in batch.column("text").to_pylist():
                    for _, which in index.find(words_of(text)):
                        total += np.bincount(which, minlength=len(total))
                some = np.flatnonzero(total)
                yield {"shingle": [shared.value[i] for i in some], "n": total[some]}
            return work

        part = arrow_map(docs.select("text"), "shingle string, n long", make).groupBy("shingle").agg(F.sum("n").alias("df"))
        part = stored(part, "shingle-counts")
        counts = part if counts is None else counts.unionByName(part)
        shared.destroy()
    return counts


def prefix_windows(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(window, n, items, shingle, offset): each window with its rarest shingle."""
    ex = windows.select("window", "n", F.explode(_shingles(F.col("window"), F.col("n"))).alias("s")).select(
        "window", "n", "s.shingle", "s.offset")
    counted = ex.join(shingle_counts(docs, ex), "shingle", "left")
    rarest = counted.groupBy("window").agg(
        F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "shingle", "offset")).alias("r"))
    return (windows.join(rarest.filter(F.col("r.df") > 0), "window")
            .select("window", "n", "items", "r.shingle", "r.offset"))


def candidates(docs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """A head row (pos -1) per document with its word count, and a row for each
    prefix shingle found: its place, and the words that a window around it can reach."""
    spark, rows = docs.sparkSession, None
    text_hash = F.xxhash64("text").alias("text_hash")
    for number, block in enumerate(_blocks(prefixes)):
        shared = spark.sparkContext.broadcast(block)

        def make(shared=shared, heads=number == 0):
            index = ShingleIndex(shared.value)
            reach = WINDOW - 1

            def work(batch):
                ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
                rows: list[tuple] = []
                for r, (text, th) in enumerate(zip(texts, batch.column("text_hash").to_pylist())):
                    w = words_of(text)
                    if heads:
                        rows.append((r, th, len(w), -1, 0, None, None))
                    for at, which in index.find(w):
                        for p, i in zip(at.tolist(), which.tolist()):
                            lo = max(0, p - reach)
                            rows.append((r, th, len(w), p, p - lo, shared.value[i],
                                         b" ".join(w[lo:p + WINDOW]).decode()))
                if rows:
                    cols = list(zip(*rows))
                    yield {"doc_id": ids.take(list(cols[0]))} | dict(zip(
                        ("text_hash", "n_words", "pos", "ctx_pos", "shingle", "ctx"), map(list, cols[1:])))
            return work

        id_type = docs.schema["doc_id"].dataType.simpleString()
        part = stored(arrow_map(docs.select("doc_id", "text", text_hash), f"doc_id {id_type}, text_hash long, n_words long, "
                                "pos int, ctx_pos int, shingle string, ctx string", make), "candidates")
        rows = part if rows is None else rows.unionByName(part)
        shared.destroy()
    return rows


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and text_hash for every row of docs."""
    prefixes = stored(prefix_windows(docs, stored(windows_of(benchmark), "windows")), "prefixes")
    rows = candidates(docs, prefixes)
    first = F.col("ctx_pos") - F.col("offset")       # where the window starts in ctx
    ctx = F.split("ctx", " ")
    hits = (rows.filter("pos >= 0").join(prefixes, "shingle")
            .filter((first >= 0) & (first + F.col("n") <= F.size(ctx)))       # positional and length bounds
            .filter(F.array_join(F.slice(ctx, F.greatest(first, F.lit(0)) + 1, F.col("n")), " ") == F.col("window"))
            .groupBy("doc_id", "text_hash")
            .agg(F.sort_array(F.collect_set(F.struct((F.col("pos") - F.col("offset")).alias("a"),
                                                     (F.col("pos") - F.col("offset") + F.col("n")).alias("z")))).alias("spans"),
                 F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda s, x: F.struct((s["n"] + F.greatest(F.lit(0), x["z"] - F.greatest(x["a"], s["end"]))).alias("n"),
                              F.greatest(s["end"], x["z"]).alias("end")), lambda s: s["n"])
    hits = hits.select(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash"), covered.alias("n_hit"), "items")
    heads = rows.filter("pos < 0").select("doc_id", "text_hash", "n_words")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return (heads.join(hits, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash")), "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.size(items).cast("long").alias("n_items"),
                    F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), "text_hash"))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows and columns of docs that hold no window of the benchmark."""
    bad = contamination(docs, benchmark).filter("contaminated").select(
        F.col("doc_id").alias("_bad_id"), F.col("text_hash").alias("_bad_hash"))
    return docs.join(bad.hint("shuffle_merge"), docs["doc_id"].eqNullSafe(bad["_bad_id"])
                     & (F.xxhash64(docs["text"]) == bad["_bad_hash"]), "left_anti")
