"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Every document belongs to a block: a hash bucket of about ``BLOCK_WORDS`` words
of its source, i.e. a piece of a random permutation of the source. A source that
needs t words is drawn in passes over its permuted blocks: whole passes first,
then a last one that leaves out documents longer than its rest and ends within two
blocks, where documents are taken while they fit. Later blocks then fill what is
open, until no document there is short enough.
That gives every source an exact quota of block draws.

The draws are dealt to output shards by a splitting tree. The root holds all
quotas. A node over shards [lo, hi) gives its left half a multivariate
hypergeometric share (what drawing that many blocks without replacement from the
node's quotas gives) and the right half the rest; a leaf holds exact quotas of
one shard. With many sources the tree runs over groups of ``GROUP`` sources
first and then inside each group: given the group totals, the shares inside the
groups are independent, so the result has the same distribution and no row holds
an unbounded vector. Consecutive disjoint ranges of each source's draws then
form the shards, and each shard is ordered by a hash (the local shuffle).

Everything is DataFrame code; the same input and seed give the same mix.
Rows that agree in doc_id, source and size are counted once with a multiplicity,
so a huge group of repeated rows is one row here.

Defined results: a null text has size 0; texts of size 0 are never taken. A null
source is a source of its own, last in order. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadrisk.llm.common import stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5               # of all words
MAX_REPEATS = 2
BLOCK_WORDS = 16384
SUPER = 256               # blocks whose sizes are summed together for the prefix sums
GROUP = 512               # sources in one vector of the tree
SHARD_WORDS = 2 ** 22
KEY = ["doc_id", "source", "size"]
WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(*cols: Column) -> Column:
    """[0, 1) from a hash of the columns."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(2 ** 53))


def numbered(sources: DataFrame) -> DataFrame:
    """source_no 0, 1, .. in code-point order, null last. Ranges of sources are
    counted and offset, so no task holds them all."""
    order = [F.col("source").isNull().asc(), F.col("source").asc()]
    dealt = sources.repartitionByRange(*order).select("*", F.spark_partition_id().alias("_part"))
    dealt = stored(dealt, "sources")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return dealt.withColumn("_in", inside).join(starts, "_part").withColumn(
        "source_no", (F.col("_start") + F.col("_in") - 1).cast("long")).drop("_part", "_in", "_start")


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = MAX_REPEATS) -> DataFrame:
    """Adds target. A source stops at ``repeats`` times its size; what it can't
    take is shared again by weight. Only sums over the open sources reach the driver."""
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    rows = stored(sources.withColumn("weight", w), "weights")
    total = rows.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, full, ratio = 0.0, 0, repeats * F.col("source_size") / F.col("weight")
    while total:
        # Sources whose ceiling is below the level are full; the rest share what is left.
        s = rows.agg(F.sum(F.when(ratio < level, repeats * F.col("source_size"))).alias("taken"), F.count(F.when(ratio < level, 1)).alias("full"),
                     F.sum(F.when(ratio >= level, F.col("weight"))).alias("open")).first()
        if not s["open"] or (level and s["full"] == full):
            break
        level, full = (share * total - (s["taken"] or 0)) / s["open"], s["full"]
    return rows.withColumn("target", F.when(ratio < level, (repeats * F.col("source_size")).cast("double"))
                           .otherwise(F.lit(level) * F.col("weight")))


def with_value(value: Column, f) -> Column:
    """f(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of ``drawn`` draws without replacement out of ``total`` hit one
    of ``marked``: inversion of u over the outcomes mode, mode+1, .., mode-1, ..
    Twelve standard deviations either side are summed; what lies beyond is far
    below the resolution of a double."""
    d = lambda c: c.cast("double")
    none = F.array().cast("array<bigint>")
    p = d(marked) / F.greatest(d(total), F.lit(1.0))
    variance = d(drawn) * p * (1 - p) * (d(total) - d(drawn)) / F.greatest(d(total) - 1, F.lit(1.0))
    bounds = F.struct(
        F.greatest(F.lit(0).cast("long"), drawn - (total - marked)).alias("least"), F.least(drawn, marked).alias("most"),
        F.floor((d(drawn) + 1) * (d(marked) + 1) / (d(total) + 2)).cast("long").alias("mode"),
        (F.ceil(F.sqrt(F.greatest(F.lit(0.0), variance)) * 12) + 12).cast("long").alias("width"))

    def ratio(k):  # of the weight of k to that of k - 1
        return (d(marked) - d(k) + 1) * (d(drawn) - d(k) + 1) / (d(k) * (d(total) - d(marked) - d(drawn) + d(k)))

    def scan(ks, step, stop):
        """s: the sum of weights; k: the first k at which the sum exceeds stop."""
        zero = F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("s"), F.lit(None).cast("long").alias("k"))
        return F.aggregate(ks, zero, lambda a, k: with_value(a["p"] * step(k), lambda w: F.struct(
            w.alias("p"), (a["s"] + w).alias("s"), F.coalesce(a["k"], F.when(a["s"] + w > stop, k)).alias("k"))))

    def ranges(b, mode):
        last, first = F.least(b["most"], mode + b["width"]), F.greatest(b["least"], mode - b["width"])
        return F.struct(mode.alias("mode"), F.when(last > mode, F.sequence(mode + 1, last)).otherwise(none).alias("ups"),
                        F.when(first < mode, F.sequence(mode - 1, first, F.lit(-1).cast("long"))).otherwise(none).alias("downs"))

    def pick(r):
        up, down = lambda stop: scan(r["ups"], ratio, stop), lambda stop: scan(r["downs"], lambda k: 1 / ratio(k + 1), stop)
        never = F.lit(float("inf"))
        return with_value(F.struct(up(never)["s"].alias("high"), down(never)["s"].alias("low")), lambda s: with_value(
            u * (1 + s["high"] + s["low"]), lambda t: F.when(t < 1, r["mode"]).when(
                t - 1 < s["high"], F.coalesce(up(t - 1)["k"], r["mode"])).otherwise(
                F.coalesce(down(t - 1 - s["high"])["k"], r["mode"]))))

    return with_value(bounds, lambda b: with_value(ranges(b, F.least(b["most"], F.greatest(b["least"], b["mode"]))), pick))


def split_tree(roots: DataFrame, shards: int, seed: int) -> DataFrame:
    """Leaves (grp, shard, pos, quota), quotas above zero, of the trees whose roots are rows
    (grp, quotas array<struct<pos, quota>>, caps array<struct<shard, to>>, start): caps are
    the shards that take draws, in order, with the running capacity up to their end, and
    start is the running capacity before the first. A root's capacities sum to its quotas.
    Nodes hold only the quotas and shards that are not zero, so the rows grow with the draws."""
    nodes = roots.select("grp", "quotas", "caps", "start")
    quota = "struct<pos:int,quota:bigint>"
    level = 0
    while 2 ** level < shards:
        half = F.floor(F.size("caps") / 2).cast("int")
        split = F.size("caps") > 1
        lo, hi = F.element_at("caps", 1)["shard"], F.element_at("caps", -1)["shard"] + 1
        mid = F.element_at("caps", F.greatest(half, F.lit(1)))["to"]
        state = F.struct((mid - F.col("start")).alias("n"), F.aggregate("quotas", F.lit(0).cast("long"), lambda a, q: a + q["quota"]).alias("t"),
                         F.array().cast(f"array<{quota}>").alias("out"))

        def step(a, q):  # adds to "out" what one source gets of the draws left, and takes it from "n"
            u = uniform(F.lit(seed), F.col("grp"), F.col("lo"), F.col("hi"), q["pos"])
            return with_value(hypergeometric(a["t"], q["quota"], a["n"], u), lambda x: F.struct(
                (a["n"] - x).alias("n"), (a["t"] - q["quota"]).alias("t"),
                F.concat(a["out"], F.array(F.struct(q["pos"].alias("pos"), x.alias("quota")).cast(quota))).alias("out")))

        nodes = nodes.select("*", lo.alias("lo"), hi.alias("hi"), half.alias("half"), mid.alias("mid"), split.alias("split"))
        left = F.when(F.col("split"), F.aggregate("quotas", state, step, lambda a: a["out"])).otherwise(F.col("quotas"))
        nodes = nodes.withColumn("left", left)
        right = F.zip_with("quotas", "left", lambda q, x: F.struct(q["pos"].alias("pos"), (q["quota"] - x["quota"]).alias("quota")).cast(quota))
        some = lambda quotas: F.filter(quotas, lambda q: q["quota"] > 0)
        child = lambda q, caps, start: F.struct(q.alias("quotas"), caps.alias("caps"), start.alias("start"))
        kids = F.when(F.col("split"), F.array(
            child(some(F.col("left")), F.slice("caps", F.lit(1), F.col("half")), F.col("start")),
            child(some(right), F.slice("caps", F.col("half") + 1, F.size("caps") - F.col("half")), F.col("mid")),
        )).otherwise(F.array(child(F.col("quotas"), F.col("caps"), F.col("start"))))
        nodes = nodes.select("grp", F.explode(kids).alias("c")).select("grp", "c.*")
        level += 1
        if level % 3 == 0:  # bounds the plan, and spreads the nodes as they multiply
            nodes = stored(nodes.repartition("grp", "start"), "tree")
    return nodes.select("grp", F.element_at("caps", 1)["shard"].alias("shard"), F.explode("quotas").alias("q")).select("grp", "shard", "q.*")


def deal(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(source_no, shard, quota above zero) from (source_no, quota): groups of sources first, then inside each group."""
    rows = stored(quotas.filter("quota > 0").select("source_no", "quota", F.floor(F.col("source_no") / GROUP).cast("long").alias("grp")), "quotas")
    vector = lambda pos: F.sort_array(F.collect_list(F.struct(pos.cast("int").alias("pos"), F.col("quota").cast("long").alias("quota"))))
    groups = rows.groupBy("grp").agg(F.sum("quota").alias("quota"))
    # The shards' ends, as even as whole draws allow; a shard without draws is left out.
    total = F.aggregate("quotas", F.lit(0).cast("long"), lambda a, q: a + q["quota"])
    end = lambda k: F.floor(F.col("total") * k / shards).cast("long")
    top = groups.agg(vector(F.col("grp")).alias("quotas")).filter(F.size("quotas") > 0).withColumn("total", total).select(
        F.lit(-1).cast("long").alias("grp"), "quotas", F.transform(
            F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda k: end(k + 1) > end(k)),
            lambda k: F.struct(k.alias("shard"), end(k + 1).alias("to"))).alias("caps"), F.lit(0).cast("long").alias("start"))
    dealt = stored(split_tree(top, shards, seed).select(F.col("pos").cast("long").alias("grp"), "shard", "quota"), "group-shards")
    to = F.sum("quota").over(Window.partitionBy("grp").orderBy("shard"))
    caps = dealt.withColumn("to", to).groupBy("grp").agg(F.sort_array(F.collect_list(F.struct("shard", "to"))).alias("caps"))
    vectors = rows.groupBy("grp").agg(vector(F.col("source_no") % GROUP).alias("quotas"))
    roots = vectors.join(caps, "grp").select("grp", "quotas", "caps", F.lit(0).cast("long").alias("start"))
    leaves = split_tree(roots, shards, seed + 1)
    return leaves.select((F.col("grp") * GROUP + F.col("pos")).alias("source_no"), "shard", "quota")


def fit_of(docs: str, left: str) -> Column:
    """How many rows of each document (array of structs with size and rows), taken in order, fit into ``left`` words."""
    start = F.struct(F.col(left).alias("left"), F.array().cast("array<bigint>").alias("out"))
    return F.aggregate(docs, start, lambda a, x: with_value(
        F.least(x["rows"], F.floor(a["left"] / x["size"])).cast("long"),
        lambda e: F.struct((a["left"] - e * x["size"]).alias("left"), F.concat(a["out"], F.array(e)).alias("out"))),
        lambda a: a["out"])


def block_starts(docs: DataFrame) -> DataFrame:
    """(source_no, block, words, rest, start) of the blocks of docs. Words are those of
    documents no longer than rest; start, the words before the block in its source,
    comes from sums of SUPER blocks, then inside them."""
    words = F.sum(F.when(F.col("size") <= F.col("rest"), F.col("size") * F.col("rows")).otherwise(0))
    blocks = docs.groupBy("source_no", "block").agg(words.alias("words"), F.max("rest").alias("rest"))
    blocks = blocks.withColumn("part", F.floor(F.col("block") / SUPER).cast("long"))
    earlier = lambda *by, order: F.coalesce(F.sum("words").over(Window.partitionBy(*by).orderBy(order).rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    parts = blocks.groupBy("source_no", "part").agg(F.sum("words").alias("words"))
    parts = parts.select("source_no", "part", earlier("source_no", order="part").alias("before_part"))
    blocks = blocks.withColumn("inside", earlier("source_no", "part", order="block")).join(parts, ["source_no", "part"])
    return blocks.select("source_no", "block", "words", "rest", (F.col("before_part") + F.col("inside")).alias("start"))


def tail_of(begun: DataFrame) -> DataFrame:
    """The block that reaches over the rest, and those after it."""
    return begun.filter(F.col("start") + F.col("words") > F.col("rest"))


def tail_fit(docs: DataFrame, begun: DataFrame) -> DataFrame:
    """(source_no, *KEY, part_extra): how many rows of the tail's documents fit, the longest of a block first."""
    left = tail_of(begun).groupBy("source_no").agg((F.max("rest") - F.min("start")).alias("left"))
    return (docs.filter((F.col("size") > 0) & (F.col("size") <= F.col("rest"))).join(tail_of(begun).select("source_no", "block"), ["source_no", "block"])
            .groupBy("source_no").agg(F.collect_list(F.struct("block", (-F.col("size")).alias("by"), "u", *KEY, "rows")).alias("docs"))
            .join(left, "source_no").select("source_no", F.sort_array("docs").alias("docs"), "left")
            .select("source_no", "docs", F.posexplode(fit_of("docs", "left")).alias("at", "part_extra"))
            .select("source_no", F.element_at("docs", F.col("at") + 1).alias("x"), "part_extra")
            .select("source_no", *[F.col(f"x.{k}").alias(k) for k in KEY], "part_extra"))


def still_open(begun: DataFrame, fit: DataFrame) -> DataFrame:
    """(source_no, rest, after): the words that a tail leaves open, and the first block after it."""
    tail = tail_of(begun).groupBy("source_no").agg((F.max("rest") - F.min("start")).alias("left"), (F.max("block") + 1).alias("after"))
    used = fit.groupBy("source_no").agg(F.sum(F.col("size") * F.col("part_extra")).alias("used"))
    return tail.join(used, "source_no").select("source_no", (F.col("left") - F.col("used")).alias("rest"), "after").filter("rest >= 1")


def plan(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = MAX_REPEATS,
         block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: int = 7) -> DataFrame:
    """One row for each different (doc_id, source, size): rows (how many it stands
    for), source_size, target, base (whole passes), extra (how many of the rows the
    last pass takes) and shards (array, pass by pass)."""
    key = KEY
    own = docs.select("doc_id", "source", size_of(F.col("text")).alias("size")).groupBy(*key).agg(F.count(F.lit(1)).alias("rows"))
    own = stored(own, "sizes")
    words = F.sum(F.col("size") * F.col("rows"))
    sources = targets(numbered(own.groupBy("source").agg(words.alias("source_size"))), weights, share, repeats)
    base = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    sources = sources.withColumn("base", base).withColumn("blocks", F.greatest(
        F.lit(1), F.ceil(F.col("source_size") / block_words)).cast("long")).withColumn(
        "rest", F.greatest(F.lit(0.0), F.col("target") - F.col("base") * F.col("source_size")))
    sources = stored(sources, "sources")
    total = sources.agg(F.coalesce(F.sum("target"), F.lit(0.0))).first()[0]
    shards = max(1, -(-int(total) // shard_words))

    named = sources.select(F.col("source").alias("_source"), "source_no", "source_size", "target", "base", "blocks", "rest")
    placed = own.join(named.hint("shuffle_merge"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumn(
        "u", uniform(F.lit(seed), F.col("doc_id"), F.col("source"), F.col("size"))).withColumn(
        "block", F.floor(F.col("u") * F.col("blocks")).cast("long"))
    placed = stored(placed, "placed")

    # A source's last pass ends in its tail. What it leaves open, because documents there
    # are too long, later blocks fill with documents that are short enough.
    blocks = stored(block_starts(placed), "blocks")
    begun = first_begun = blocks.filter((F.col("words") > 0) & (F.col("start") < F.col("rest") + block_words))
    inside = stored(tail_fit(placed, begun), "tail")
    fills, state = [], stored(still_open(begun, inside), "open")
    while (most := state.agg(F.max("rest")).first()[0]) is not None:
        some = (placed.filter((F.col("size") > 0) & (F.col("size") <= most)).drop("rest").join(state.hint("shuffle_merge"), "source_no")
                .filter((F.col("block") >= F.col("after")) & (F.col("size") <= F.col("rest"))))
        some = stored(some, "short")
        begun = stored(block_starts(some).filter(F.col("start") < F.col("rest") + block_words), "begun")
        fit = stored(tail_fit(some, begun), "fill")
        whole = some.join(begun.filter(F.col("start") + F.col("words") <= F.col("rest")).select("source_no", "block"), ["source_no", "block"])
        fills += [fit, whole.select("source_no", *key, F.col("rows").alias("part_extra"))]
        state = stored(still_open(begun, fit), "open")

    # Quotas of block draws, dealt to the shards by the tree; consecutive draws form the shards.
    drawn = first_begun.groupBy("source_no").agg((F.max("block") + 1).alias("n_extra"))
    quotas = sources.join(drawn, "source_no", "left").select(
        "source_no", (F.col("base") * F.col("blocks") + F.coalesce("n_extra", F.lit(0))).alias("quota"))
    to = F.sum("quota").over(Window.partitionBy("source_no").orderBy("shard"))
    draws = (deal(quotas, shards, seed).withColumn("to", to).filter("quota > 0")
             .select("source_no", "shard", F.explode(F.sequence(F.col("to") - F.col("quota"), F.col("to") - 1)).alias("draw"))
             .join(sources.select("source_no", "blocks"), "source_no")
             .groupBy("source_no", (F.col("draw") % F.col("blocks")).alias("block"))
             .agg(F.transform(F.sort_array(F.collect_list(F.struct("draw", "shard"))), lambda x: x["shard"]).alias("shards")))

    same = lambda a, b: reduce(lambda x, y: x & y, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in key])
    full = F.coalesce((F.col("d.size") <= F.col("b.rest")) & (F.col("b.start") + F.col("b.words") <= F.col("b.rest")), F.lit(False))
    extra = F.when(F.col("d.size") == 0, 0).when(full, F.col("d.rows")).otherwise(F.coalesce("i.part_extra", F.lit(0)))
    inside = inside.withColumn("fill_shard", F.lit(None).cast("int"))
    if fills:  # documents from later blocks take the shard of one of the last pass's draws
        late = reduce(DataFrame.unionByName, fills).filter("part_extra > 0").join(drawn, "source_no").join(
            sources.select("source_no", "base"), "source_no").withColumn(
            "block", F.floor(uniform(F.lit(seed + 2), F.col("doc_id"), F.col("source"), F.col("size")) * F.col("n_extra")).cast("long"))
        late = late.join(draws, ["source_no", "block"]).withColumn("fill_shard", F.element_at("shards", F.col("base").cast("int") + 1))
        inside = inside.unionByName(late.select(*inside.columns))
    out = (placed.alias("d").join(blocks.alias("b"), ["source_no", "block"])
           .join(draws.alias("s"), ["source_no", "block"], "left").join(inside.alias("i"), same("d", "i"), "left"))
    shards_of = F.when(F.col("i.fill_shard").isNull(), F.col("s.shards")).otherwise(
        F.concat(F.coalesce("s.shards", F.array().cast("array<int>")), F.array("i.fill_shard")))
    return out.select(*[F.col(f"d.{k}") for k in key], "d.rows", "d.source_size", "d.target", "d.base",
                      extra.cast("long").alias("extra"), shards_of.alias("shards"), "d.u")


def mix_counts(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken and shards (the output shards of its copies) for every row of docs."""
    p = plan(docs, **options).select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("nth"))
    copies = F.col("base") + (F.col("nth") <= F.col("extra")).cast("long")
    copies = F.when(F.col("size") > 0, copies).otherwise(F.lit(0).cast("long"))
    shards = F.slice(F.coalesce("shards", F.array().cast("array<int>")), F.lit(1), copies.cast("int"))
    return p.select("doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), shards.alias("shards"))


def mix(docs: DataFrame, seed: int = 7, **options) -> DataFrame:
    """The mix itself: the rows of docs (all columns), each as often as the mix takes
    it, with shard and copy, ordered at random inside the shards. Columns of docs
    that are called shard or copy give way."""
    p = plan(docs, seed=seed, **options)
    columns = [c for c in docs.columns if c not in ("shard", "copy")]
    rows = docs.select(F.struct(*columns).alias("row"), size_of(F.col("text")).alias("size"))  # so that no name can clash
    p = p.filter((F.col("size") > 0) & (F.col("base") + F.col("extra") > 0)).select(
        F.col("doc_id").alias("p_doc_id"), F.col("source").alias("p_source"), F.col("size").alias("p_size"), "rows", "base", "extra", "shards")
    both = rows.join(p, F.col("row.doc_id").eqNullSafe(F.col("p_doc_id")) & F.col("row.source").eqNullSafe(F.col("p_source"))
                     & (F.col("size") == F.col("p_size")))
    # Repeated rows of which the last pass takes some: at most one group for each source.
    some = (F.col("extra") > 0) & (F.col("extra") < F.col("rows"))
    nth = F.row_number().over(Window.partitionBy("p_doc_id", "p_source", "p_size").orderBy(F.xxhash64("row.text")))
    whole = both.filter(~some).withColumn("copies", F.col("base") + (F.col("extra") > 0).cast("long"))
    partly = both.filter(some).withColumn("copies", F.col("base") + (nth <= F.col("extra")).cast("long"))
    out = whole.unionByName(partly).filter("copies > 0").select(
        "row", "shards", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    mixed = F.xxhash64(F.lit(seed), "row.doc_id", "row.text", "copy")
    out = out.select("row", F.element_at("shards", F.col("copy")).alias("shard"), "copy", mixed.alias("mixed"))
    return out.repartitionByRange("shard", "mixed").sortWithinPartitions("shard", "mixed").select("row.*", "shard", "copy")
