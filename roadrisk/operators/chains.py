"""Chains of connected ways by list ranking.

Two ways are joined where exactly two way ends meet at a point. At a point with one
end, or with three and more, chains end. So every way lies in exactly one chain, and a
chain is a path or a closed ring.

Each way is looked at in both directions; a state (way, direction) has at most one next
state. Pointer jumping ranks all lists at once: in every round each open state takes over
the pointer, the distance and the smallest state of the one it points to, so pointers
reach twice as far. A path of n ways is ranked after log2(n) rounds, whatever the number
of chains; states that have reached their chain's end leave the loop. The two directions
of a path give each way its distances from both ends. When a round ends no state any
more, those left are rings: they go on until every state knows the smallest one of its
ring, the ring is cut there and ranked as a path.

A point is counted by one aggregate (number, smallest and largest end), so a point
where very many ways meet is one row per task in the shuffle. Each round is one join on
distinct keys and a table below the shared folder; the one before it is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadrisk.sources.tables import remove_temporary, run_folder


class _Tables:
    """Tables of this run, dropped when they are no longer read."""

    def __init__(self, spark):
        self.spark = spark
        self.folders: dict[int, str] = {}

    def store(self, df: DataFrame) -> DataFrame:
        folder = run_folder(self.spark, "chains")
        df.write.parquet(folder)
        out = self.spark.read.schema(df.schema).parquet(folder)
        self.folders[id(out)] = folder
        return out

    def move(self, old: DataFrame, new: DataFrame) -> None:
        """``new`` now stands for the table that ``old`` reads."""
        self.folders[id(new)] = self.folders.pop(id(old))

    def drop(self, *tables: DataFrame) -> None:
        folders = [self.folders.pop(id(t)) for t in tables if id(t) in self.folders]
        if folders:
            remove_temporary(*folders)

    def drop_all(self) -> None:
        if self.folders:
            remove_temporary(*self.folders.values())
            self.folders.clear()


# A state is one long: 2 * way + direction (0 forward, 1 backward). The end at which a way is
# left in direction d has the number 2 * way + (1 - d): 0 is its first point, 1 its last.

def way_links(ways: DataFrame) -> DataFrame:
    """(state, next) of ways (way_id, points): the state that follows, NULL at the end of a path."""
    spot = lambda p, side: F.struct((F.col("way_id") * 2 + side).alias("end"), p[0].alias("x"), p[1].alias("y"))
    first, last = F.element_at("points", 1), F.element_at("points", -1)
    placed = F.array(first[0], first[1], last[0], last[1])
    ends = (ways.filter(F.size("points") > 0).filter(F.forall(placed, lambda c: c.isNotNull()))
            .select(F.explode(F.array(spot(first, 0), spot(last, 1))).alias("e")).select("e.*"))
    meeting = (ends.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"), F.min("end").alias("a"), F.max("end").alias("b"))
               .filter(F.col("n") == 2).select("a", "b"))
    other = meeting.unionByName(meeting.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # entered at end 2w (its first point) a way runs forward, at 2w + 1 backward: the state's number is the end's
    states = ways.select(F.explode(F.array(F.col("way_id") * 2, F.col("way_id") * 2 + 1)).alias("state"))
    left_at = F.col("state").bitwiseXOR(F.lit(1).cast("bigint"))
    return states.withColumn("_left", left_at).join(other, F.col("_left") == F.col("a"), "left").select("state", F.col("b").alias("next"))


def rank_lists(links: DataFrame, tables: _Tables) -> tuple[DataFrame, DataFrame]:
    """``links``: (state, next). Returns (state, tail, dist) of the states of paths and (state, low)
    of those of rings, ``low`` being the smallest state of the ring."""
    start = tables.store(links.select("state", F.coalesce("next", "state").alias("ptr"),
                                      F.when(F.col("next").isNull(), 0).otherwise(1).cast("bigint").alias("dist"),
                                      F.coalesce("next", "state").alias("low"), F.col("next").isNull().alias("done")))
    now_table = ended_table = start
    count = start.filter(~F.col("done")).count()
    while count:
        now, ended = now_table.filter(~F.col("done")), ended_table.filter("done")
        # a pointer leads to an open state or to one that has been ranked
        to = now.unionByName(ended).select(F.col("state").alias("_s"), F.col("ptr").alias("_p"), F.col("dist").alias("_d"),
                                           F.col("low").alias("_l"), F.col("done").alias("_e"))
        jumped = tables.store(now.join(to, F.col("ptr") == F.col("_s"))
                              .select("state", F.col("_p").alias("ptr"), (F.col("dist") + F.col("_d")).alias("dist"),
                                      F.least("low", "_l").alias("low"), F.col("_e").alias("done"),
                                      (F.col("_l") < F.col("low")).alias("lower")))
        seen = jumped.agg(F.count_if(~F.col("done")).alias("open"), F.count_if(~F.col("done") & F.col("lower")).alias("lower")).first()
        if seen.open == count and seen.lower == 0:  # none ended, none learned of a smaller state: rings, all known
            return (ended.select("state", F.col("ptr").alias("tail"), "dist"),
                    jumped.select("state", F.least("state", "low").alias("low")))
        before = now_table, ended_table
        jumped_rows = jumped.drop("lower")
        if seen.open < count:
            ended_table = tables.store(ended.unionByName(jumped_rows.filter("done")))
        now_table, kept_jumped, count = jumped_rows, jumped, seen.open
        tables.move(kept_jumped, now_table)
        tables.drop(*[t for t in before if t is not now_table and t is not ended_table])
    return ended_table.filter("done").select("state", F.col("ptr").alias("tail"), "dist"), start.limit(0).select("state", "low")


def road_chains(ways: DataFrame, id_col: str = "way_id", points_col: str = "points") -> DataFrame:
    """One row per way: chain_id (the way it begins with), position (from 0), way_id, backward
    (whether the chain runs through the way against its points), closed, n_ways.

    A path begins at the end with the smaller way id, a ring with its smallest way, forward.
    ``ways``: a unique non-negative id below 2^62 and an array of [x, y] points. Ways without
    points or with a null end coordinate are a chain of their own."""
    tables = _Tables(ways.sparkSession)
    ways = ways.select(F.col(id_col).cast("bigint").alias("way_id"), F.col(points_col).alias("points"))
    links = tables.store(way_links(ways))
    paths, rings = rank_lists(links, tables)
    # cut each ring before its smallest state and rank what is left; the mirrored ring, whose
    # smallest state runs backward, is left out
    ring = rings.filter(F.col("low") % 2 == 0)
    cut = (links.join(ring, "state").select("state", F.when(F.col("next") != F.col("low"), F.col("next")).alias("next")))
    ring_rank = None
    if not rings.isEmpty():
        ring_paths, _ = rank_lists(tables.store(cut), tables)
        sizes = ring_paths.groupBy("tail").agg(F.count(F.lit(1)).alias("n_ways"))
        heads = ring.select("state", "low")
        ring_rank = (ring_paths.join(sizes, "tail").join(heads, "state")
                     .select(F.shiftright("low", 1).alias("chain_id"), (F.col("n_ways") - 1 - F.col("dist")).alias("position"),
                             F.shiftright("state", 1).alias("way_id"), (F.col("state") % 2 == 1).alias("backward"),
                             F.lit(True).alias("closed"), "n_ways"))
    forward = paths.filter(F.col("state") % 2 == 0).select(F.shiftright("state", 1).alias("way_id"), F.shiftright("tail", 1).alias("fw"),
                                                           F.col("dist").alias("fd"))
    backward = paths.filter(F.col("state") % 2 == 1).select(F.shiftright("state", 1).alias("way_id"), F.shiftright("tail", 1).alias("bw"),
                                                            F.col("dist").alias("bd"))
    both = forward.join(backward, "way_id")
    turned = F.col("fw") < F.col("bw")  # going forward leads to the end where the chain begins
    path_rank = both.select(F.least("fw", "bw").alias("chain_id"), F.when(turned, F.col("fd")).otherwise(F.col("bd")).alias("position"),
                            "way_id", turned.alias("backward"), F.lit(False).alias("closed"), (F.col("fd") + F.col("bd") + 1).alias("n_ways"))
    result = path_rank if ring_rank is None else path_rank.unionByName(ring_rank)
    folder = run_folder(ways.sparkSession, "chains-result")
    result.write.parquet(folder)
    tables.drop_all()
    return ways.sparkSession.read.schema(result.schema).parquet(folder)


def chain_points(ways: DataFrame, chains: DataFrame, id_col: str = "way_id", points_col: str = "points") -> DataFrame:
    """The points of the chains in order: chain_id, position, idx (within the way as the chain
    runs), x, y. The first point of every way but a chain's first repeats the one before it and is left out."""
    points = ways.select(F.col(id_col).cast("bigint").alias("way_id"), F.col(points_col).alias("_p")).join(chains, "way_id")
    turned = F.when(F.col("backward"), F.reverse("_p")).otherwise(F.col("_p"))
    return (points.select("chain_id", "position", F.posexplode(turned).alias("idx", "_q"))
            .filter((F.col("position") == 0) | (F.col("idx") > 0))
            .select("chain_id", "position", "idx", F.col("_q")[0].alias("x"), F.col("_q")[1].alias("y")))
