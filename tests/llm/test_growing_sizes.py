"""Steps whose time must grow in proportion: lines taken out of long documents, shards and sources of the mix."""

import collections
import random
import time

from pyspark.sql import functions as F

from roadrisk.llm import linededup, mixing


def test_lines_leave_as_in_a_plain_loop(spark):
    r = random.Random(21)
    rows = [(None, [0]), ("", []), ("", [0]), ("a", [0]), ("a\n", [0]), ("a\n\nb\n", [1]), ("a\nb", [5, 9])]
    rows += [("\n".join(r.choice(("x", "", "é y", "z")) for _ in range(n)), sorted(r.sample(range(n), r.randrange(n + 1)))) for n in range(1, 40)]
    df = spark.createDataFrame(rows, "text string, dropped array<int>")
    got = [x[0] for x in df.select(linededup.without_lines(F.col("text"), F.col("dropped"))).collect()]
    assert got == [None if t is None else "\n".join(line for i, line in enumerate(t.split("\n")) if i not in d) for t, d in rows]


def test_a_document_of_200_000_lines_with_every_second_one_dropped(spark):
    n = 200_000
    df = spark.range(1).select(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: i.cast("string")), "\n").alias("text"),
                               F.sequence(F.lit(0), F.lit(n - 1), F.lit(2)).alias("dropped"))
    start = time.perf_counter()
    text = df.select(linededup.without_lines(F.col("text"), F.col("dropped"))).first()[0]
    assert time.perf_counter() - start < 20
    assert text == "\n".join(str(i) for i in range(1, n, 2))


def test_splitting_tree_over_many_shards_and_sources(spark):
    """2,000 sources with few draws each over 20,000 shards: exact sums, and no row for a quota of zero."""
    sources, shards = 2000, 20_000
    r = random.Random(22)
    quotas = [r.choice((0, 3, 20, 31)) for _ in range(sources)]
    df = spark.createDataFrame(list(enumerate(quotas)), "source_no long, quota long")
    leaves = mixing.deal(df, shards, 3).collect()
    assert all(x["quota"] > 0 for x in leaves) and len(leaves) <= sum(quotas)
    by_source, by_shard = collections.Counter(), collections.Counter()
    for x in leaves:
        by_source[x["source_no"]] += x["quota"]
        by_shard[x["shard"]] += x["quota"]
    assert [by_source[i] for i in range(sources)] == quotas
    ends = [sum(quotas) * k // shards for k in range(shards + 1)]
    assert [by_shard[k] for k in range(shards)] == [b - a for a, b in zip(ends, ends[1:])]
    assert mixing.deal(df.limit(0), shards, 3).count() == 0
