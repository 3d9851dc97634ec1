"""Near-duplicate embeddings by spherical-cap filters.

A filter is a direction; a vector passes it when their inner product reaches a
threshold. The directions are structured: in each of ``TABLES`` randomly rotated
copies of the space, every choice of one code word for the first half of the
coordinates and one for the second is a filter, so W**2 filters need only
2 * W inner products, and a vector is list-decoded to all filters it passes
without trying them one by one. W grows with the root of the counted rows
(``words_for``), so buckets don't grow with the table. Vectors with an angle as small as that of cosine
0.98 nearly always share a filter: over random directions 0.99 of the pairs at
exactly 0.98 do, more above it (tests measure it against brute force).

Vectors that share (label, filter) are compared exactly, in double precision:

* equal vectors of a label are one class with a count, so copies cost one row;
* filters that only one class passes are dropped before any vector moves;
* a bucket is cut into tiles of bounded size, and tiles and tile pairs are
  compared by numpy, many of them in one pack. A pair that shares several filters
  counts in the smallest one only. A pack returns a row per linked class (its
  number of links) and a spanning forest, never the pairs;
* components join the forests.

Codes depend on the dimension, W and a seed alone, not on the vectors, so there is
nothing to fit and every row is indexed.

Below ``LOW_DIMENSIONS`` coordinates the caps of random directions are uneven. There
the filters are the cells of a grid over the first coordinates: a vector passes its own
cell and all cells that a vector at the link bound can lie in, so no pair is missed.

Defined results: a vector that is null, empty, zero, or holds a null or
non-finite component, or has no label or no vec_id, links with nothing; its
component_id is its own vec_id. Vectors of different length never link. Repeated
rows count as other vectors. An empty table gives no rows. Only vec_id, label and
embedding are read, so extra columns of any name are no matter.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadrisk.llm.common import arrow_map, connected_components, ship_code, stored
from roadrisk.llm.simhash import forest

COSINE = 0.98
TABLES, WORDS = 4, 256   # WORDS: at least
ROWS_PER_FILTER = 0.25
PASSED = 32          # filters that a random vector passes on average, all tables together
SEED = 11
TILE = 1024          # classes in a tile
PACK = 16384         # rows of units handled together, on average
LOW_DIMENSIONS = 12
GRID_COORDINATES, GRID_CELL = 6, 0.5


def words_for(rows: int) -> int:
    """Code words per half: the power of two from which a table has a filter per ``ROWS_PER_FILTER`` rows."""
    words = WORDS
    while words * words * ROWS_PER_FILTER < rows:
        words *= 2
    return words


@functools.lru_cache(maxsize=16)
def codes(dim: int, n_words: int = WORDS):
    """(rotation, code words, threshold) per table, the same on every machine."""
    rng = np.random.default_rng([SEED, dim])
    width = -(-dim // 2)
    tables = []
    for _ in range(TABLES):
        rotation = np.linalg.qr(rng.normal(size=(2 * width, 2 * width)))[0][:dim]
        words = rng.normal(size=(2, n_words, width))
        words /= np.linalg.norm(words, axis=2, keepdims=True) * np.sqrt(2)
        probe = rng.normal(size=(64, dim))
        probe = (probe / np.linalg.norm(probe, axis=1, keepdims=True)) @ rotation
        most = len(probe) * PASSED // TABLES
        top = np.full(most, -np.inf)
        for x in probe:  # the largest sums of all probes, one probe at a time
            sums = ((words[0] @ x[:width])[:, None] + words[1] @ x[width:]).ravel()
            top = np.partition(np.concatenate([top, np.partition(sums, -most)[-most:]]), -most)[-most:]
        tables.append((rotation, words, top.min()))
    return tables


def grid_cells(unit: np.ndarray, cosine: float) -> np.ndarray:
    """The grid cells (increasing numbers) in which a vector linked to this one can lie."""
    reach = np.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-9
    x = unit[:GRID_COORDINATES]
    low, high = (np.floor((x + side) / GRID_CELL).astype(np.int64) for side in (-reach, reach))
    out = np.zeros(1, dtype=np.int64)
    for a, z in zip(low + 2 ** 10, high + 2 ** 10):  # 11 bits a coordinate
        out = (out[:, None] * 2 ** 11 + np.arange(a, z + 1)).ravel()
    return np.sort(out)


def passed_filters(unit: np.ndarray, n_words: int = WORDS, cosine: float = COSINE) -> np.ndarray:
    """The filters (increasing numbers) that a unit vector passes."""
    if len(unit) < LOW_DIMENSIONS:
        return grid_cells(unit, cosine)
    out, width = [np.empty(0, dtype=np.int64)], -(-len(unit) // 2)
    for t, (rotation, words, least) in enumerate(codes(len(unit), n_words)):
        x = unit @ rotation
        a, b = words[0] @ x[:width], words[1] @ x[width:]
        b_order = np.argsort(-b)
        b_down = -b[b_order]
        first = np.flatnonzero(a >= least + b_down[0])
        counts = np.searchsorted(b_down, a[first] - least, side="right")
        nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        out.append((t * n_words + np.repeat(first, counts)) * n_words + b_order[nth])
    return np.sort(np.concatenate(out))


def can_link() -> Column:
    e = F.col("embedding").cast("array<double>")
    return F.coalesce(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & e.isNotNull()
        & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(e, lambda x: F.coalesce(x, F.lit(0.0)) != 0), F.lit(False))


def valid_rows(rows: DataFrame) -> DataFrame:
    """vec_id, label, embedding (doubles, no negative zeros) of the rows that can link."""
    return rows.filter(can_link()).select("vec_id", "label", F.transform(
        F.col("embedding").cast("array<double>"), lambda x: x + F.lit(0.0)).alias("embedding"))


def decoded(classes: DataFrame, n_words: int = WORDS, cosine: float = COSINE) -> DataFrame:
    """Adds filters, the sorted filters that each class's vector passes."""
    def make():
        def work(batch):
            found = []
            for v in batch.column("embedding").to_pylist():
                x = np.array(v)
                x = x / np.abs(x).max()     # no overflow in the norm
                found.append(passed_filters(x / np.linalg.norm(x), n_words, cosine).tolist())
            yield {c: batch.column(c) for c in ("class_id", "label", "copies", "embedding")} | {"filters": found}
        return work

    kind = classes.schema["label"].dataType.simpleString()
    return arrow_map(classes.select("class_id", "label", "copies", "embedding"),
                     f"class_id long, label {kind}, copies long, embedding array<double>, filters array<long>", make)


def unit_links(filter_id: int, unit: np.ndarray, ids: np.ndarray, slot: np.ndarray, filters: list[np.ndarray],
               cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Links (positions i, j, ids[i] < ids[j]) between the classes of one bucket,
    or of two of its tiles, that belong to this filter: pairs whose smallest common
    filter it is."""
    near = unit @ unit.T >= cosine
    if np.count_nonzero(near) <= len(ids):  # nothing but the diagonal
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    near &= ids[:, None] < ids[None, :]
    if slot[0] != slot[-1]:  # pairs inside either tile are compared elsewhere
        near &= slot[:, None] != slot[None, :]
    i, j = np.nonzero(near)
    lower = [f[f < filter_id] for f in filters]
    names = np.unique(np.concatenate(lower))
    if len(i) and len(names):
        marks = np.zeros((len(ids), len(names)), dtype=np.float32)
        for r, f in enumerate(lower):
            marks[r, np.searchsorted(names, f)] = 1
        first = (marks @ marks.T)[i, j] == 0
        i, j = i[first], j[first]
    return i, j


def bucket_links(rows: DataFrame, cosine: float) -> DataFrame:
    """(class_id, other, linked): per pack, the linked classes, each with the
    copies of its links, and with the root of its local forest in other.

    A pack holds many units, a unit being a bucket or, of a large bucket, a pair
    of tiles; units are dealt to packs by hash."""
    ship_code(rows.sparkSession)
    schema = "class_id long, other long, linked long"

    def work(key, table):
        import pyarrow as pa

        table = table.sort_by([(c, "ascending") for c in ("label", "filter", "a", "b", "slot", "class_id")]).combine_chunks()
        ids, copies, slot, names = (table.column(c).to_numpy() for c in ("class_id", "copies", "slot", "filter"))
        flat = lambda c: table.column(c).chunk(0).flatten().to_numpy(zero_copy_only=False)
        vectors = flat("embedding").reshape(len(ids), -1)
        unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        ends = np.cumsum(table.column("filters").chunk(0).value_lengths().to_numpy())[:-1]
        filters = np.split(flat("filters"), ends)
        labels = np.unique(table.column("label").to_numpy(zero_copy_only=False), return_inverse=True)[1]
        units = np.stack([labels, names, table.column("a").to_numpy(), table.column("b").to_numpy()])
        cuts = np.flatnonzero((units[:, 1:] != units[:, :-1]).any(axis=0)) + 1
        lefts, rights = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
        for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ids)]):
            if e - s > 1:
                i, j = unit_links(names[s], unit[s:e], ids[s:e], slot[s:e], filters[s:e], cosine)
                if len(i):
                    lefts.append(i + s)
                    rights.append(j + s)
        i, j = np.concatenate(lefts), np.concatenate(rights)
        node, place = np.unique(ids, return_inverse=True)  # a class occurs in several units
        linked = np.bincount(place[i], copies[j], len(node)) + np.bincount(place[j], copies[i], len(node))
        root = forest(len(node), place[i], place[j])
        some = np.flatnonzero(linked)
        return pa.table({"class_id": node[some], "other": node[root[some]], "linked": linked[some].astype(np.int64)})

    return rows.groupBy("dim", "pack").applyInArrow(work, schema)


def near_duplicates(rows: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    valid = valid_rows(rows).withColumn("h1", F.xxhash64("embedding")).withColumn("h2", F.xxhash64(F.lit(1), F.reverse("embedding")))
    key = ["label", "h1", "h2"]
    sets = valid.select("vec_id", *key).groupBy(*key).agg(F.min("vec_id").alias("class_id"), F.count(F.lit(1)).alias("copies"))
    sets = stored(sets, "vector-classes")
    first = (valid.alias("v").join(sets.alias("s").hint("shuffle_merge"),
                                   (F.col("v.vec_id") == F.col("s.class_id")) & (F.col("v.label") == F.col("s.label"))
                                   & (F.col("v.h1") == F.col("s.h1")) & (F.col("v.h2") == F.col("s.h2")))
             .select("class_id", "v.label", "copies", "embedding").dropDuplicates(["class_id", "label", "embedding"]))
    index = stored(decoded(first, words_for(sets.count()), cosine).withColumn("dim", F.size("embedding")), "vector-index")

    passes = index.select("class_id", "label", "dim", F.explode("filters").alias("filter"))
    live = passes.groupBy("label", "dim", "filter").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = (passes.join(live.hint("shuffle_merge"), ["label", "dim", "filter"])
              .groupBy("class_id", "label", "dim").agg(F.collect_list(F.struct("filter", "n")).alias("live")))
    packs = max(1, -(-(live.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]) // PACK))
    moved = index.select("class_id", "label", "dim", "copies", "embedding").join(
        shared.hint("shuffle_merge"), ["class_id", "label", "dim"])
    tiles = F.ceil(F.col("f.n") / TILE).cast("long")
    slot = F.pmod(F.xxhash64("class_id", F.lit(5)), tiles)
    spread = (moved.withColumn("filters", F.array_sort(F.transform("live", lambda x: x["filter"])))
              .withColumn("f", F.explode("live")).withColumn("slot", slot)
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1)))
              .select("label", "dim", F.col("f.filter").alias("filter"), F.least("slot", "other").alias("a"),
                      F.greatest("slot", "other").alias("b"), "class_id", "copies", "slot", "embedding", "filters")
              .withColumn("pack", F.pmod(F.xxhash64("label", "filter", "a", "b"), F.lit(packs))))
    found = stored(bucket_links(spread, cosine), "vector-links")

    counts = found.groupBy("class_id").agg(F.sum("linked").alias("linked"))
    comp = connected_components(found.select(F.col("class_id").alias("src"), F.col("other").alias("dst"))).withColumnRenamed("node", "class_id")
    classes = sets.join(counts, "class_id", "left").join(comp, "class_id", "left").select(
        *key, (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
        F.coalesce("component", "class_id").alias("component_id"))
    linked = valid.select("vec_id", *key).join(classes.hint("shuffle_merge"), key).select("vec_id", "n_links", "component_id")
    rest = rows.filter(~can_link()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))

