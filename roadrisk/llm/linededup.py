"""Line dedup by a deletion-neighbourhood join.

Lines are compared as sequences of words (white space collapsed). Two lines are
copies when they are equal, or when both have at least ``NEAR_WORDS`` words and
one word inserted, deleted or replaced turns one into the other. Copies form
classes (connected), and only the earliest line of a class, by (doc_id, line
number), is kept; the others leave their documents.

The neighbourhood of a line is the line itself and the line without its i-th
word, each as a hashed key:

* a replaced word: both lines give the same key at the same deleted position, so
  they join on (key, position);
* an inserted word: the longer line without it has the key of the shorter line.

Members of one (key, position) link to its smallest line instead of to each
other, so a template with thousands of fillings costs a row per line, not a pair
per two. Every link is verified by the word edit distance.

Emitting all variants of all lines would multiply the text by the line length,
so lines that can't have a partner are left out first, without loss: of two
lines one edit apart, either the first or the last floor((n-1)/2) words (rounded
down to an even count) agree, n being the shorter length. Only lines that share
such a half with a different line emit variants, and only at the positions that
the shared half leaves open.

Defined results: null and empty texts stay as they are; lines without a word are
never dropped. Rows with the same doc_id count as one document; rows with a null
doc_id neither lose lines nor make others lose them. Repeated lines inside one
document keep the first. An empty table gives an empty result. Very long texts are
read whole, and lines are taken out in linear time. ``dedup_lines`` carries all columns along, whatever
their names; the report reads doc_id and text alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadrisk.llm.common import arrow_map, connected_components, stored

NEAR_WORDS = 8    # shorter lines must be equal
LINES_AT_ONCE = 20000

_ODD = np.uint64(0x9E3779B97F4A7C15)  # an odd multiplier: invertible modulo 2**64
_INVERSE = np.uint64(pow(int(_ODD), -1, 2 ** 64))


def half(n: int) -> int:
    return (n - 1) // 4 * 2


def line_hash(joined: bytes) -> tuple[int, int]:
    """128 bits as two signed longs."""
    h = xxhash.xxh3_128_intdigest(joined)
    return (h >> 64) - 2 ** 63, (h & (2 ** 64 - 1)) - 2 ** 63


def half_keys(words: list[bytes]) -> tuple[list[int], list[int]]:
    """Hashes of the first and of the last half, for the line as the shorter or the longer of a pair."""
    n = len(words)
    sizes = {half(n), half(n - 1)} if n > NEAR_WORDS else {half(n)}
    key = lambda part, seed: xxhash.xxh3_64_intdigest(b" ".join(part), seed) - 2 ** 63
    return [key(words[:k], 2 * k) for k in sorted(sizes)], [key(words[n - k:], 2 * k + 1) for k in sorted(sizes)]


def variants(words: list[bytes]) -> tuple[np.ndarray, int]:
    """Keys of the line without each of its words, and the key of the line."""
    h = np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64)
    with np.errstate(over="ignore"):
        power = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(len(h) - 1, _ODD, np.uint64))), dtype=np.uint64)
        before = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * power, dtype=np.uint64)))
        without = before[:-1] + (before[-1] - before[1:]) * _INVERSE
    return without.view(np.int64), int(before[-1:].view(np.int64)[0])


def word_distance_at_most_one(a: list[bytes], b: list[bytes]) -> bool:
    if abs(len(a) - len(b)) > 1:
        return False
    short, long_ = sorted((a, b), key=len)
    i = next((i for i, (x, y) in enumerate(zip(short, long_)) if x != y), len(short))
    return short[i + (len(a) == len(b)):] == long_[i + 1:]


def occurrences(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, h1, h2, pre, suf): the lines that hold words, hashed; pre
    and suf are half keys, for lines of NEAR_WORDS words or more."""
    def make():
        def work(batch):
            out: list[tuple] = []
            ids = batch.column("doc_id")

            def flush():
                cols = list(zip(*out))
                done = {"doc_id": ids.take(pa.array(cols[0]))} | dict(zip(("line_no", "h1", "h2", "pre", "suf"), map(list, cols[1:])))
                out.clear()
                return done

            for r, text in enumerate(batch.column("text").to_pylist()):
                for no, line in enumerate((text or "").split("\n")):
                    words = line.encode().split()  # at 0x20 and 0x09-0x0D
                    if words:
                        pre, suf = half_keys(words) if len(words) >= NEAR_WORDS else (None, None)
                        out.append((r, no, *line_hash(b" ".join(words)), pre, suf))
                if len(out) >= LINES_AT_ONCE:
                    yield flush()
            if out:
                yield flush()
        return work

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", "text").filter("doc_id is not null and text is not null"),
                     f"doc_id {kind}, line_no int, h1 long, h2 long, pre array<long>, suf array<long>", make)


def near_candidates(lines: DataFrame, classes: DataFrame) -> DataFrame:
    """(doc_id, wanted): per document, the lines to read again: (line_no, h1, by_pre,
    by_suf) of the first occurrence of each line that shares a half with another line."""
    keys = lines.filter("pre is not null").select("h1", F.explode(F.concat(
        F.transform("pre", lambda k: F.struct(k.alias("key"), F.lit(True).alias("is_pre"))),
        F.transform("suf", lambda k: F.struct(k.alias("key"), F.lit(False).alias("is_pre"))))).alias("k")).select("h1", "k.*")
    shared = keys.groupBy("key").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).filter("a <> b").select("key")
    some = keys.join(shared.hint("shuffle_merge"), "key", "left_semi").groupBy("h1").agg(
        F.max("is_pre").alias("by_pre"), F.max(~F.col("is_pre")).alias("by_suf"))
    return (some.join(classes.select("h1", "first.*"), "h1")
            .groupBy("doc_id").agg(F.collect_set(F.struct("line_no", "h1", "by_pre", "by_suf")).alias("wanted")))


def read_again(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h1, line, by_pre, by_suf) of the wanted lines."""
    def make():
        def work(batch):
            out = []
            for text, want in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
                lines = text.split("\n")
                for w in want:
                    line = b" ".join(lines[w["line_no"]].encode().split()) if w["line_no"] < len(lines) else b""
                    if line_hash(line)[0] == w["h1"]:  # rows with the same doc_id may differ
                        out.append((w["h1"], line.decode(), w["by_pre"], w["by_suf"]))
            if out:
                yield dict(zip(("h1", "line", "by_pre", "by_suf"), map(list, zip(*out))))
        return work

    both = docs.select("doc_id", "text").filter("text is not null").join(wanted.hint("shuffle_merge"), "doc_id").select("text", "wanted")
    return arrow_map(both, "h1 long, line string, by_pre boolean, by_suf boolean", make).dropDuplicates(["h1"])


def neighbourhood(lines: DataFrame) -> DataFrame:
    """(key, pos, h1): the variants of each line; pos -1 is the line itself."""
    def make():
        def work(batch):
            keys, places, owners = [], [], []
            for h1, line, pre, suf in zip(*(batch.column(c).to_pylist() for c in ("h1", "line", "by_pre", "by_suf"))):
                words = [w.encode() for w in line.split(" ")]
                without, own = variants(words)
                k, n = half(max(len(words) - 1, NEAR_WORDS)), len(words)
                pos = np.arange(n)
                pos = pos[(pre & (pos >= k)) | (suf & (pos < n - k))]
                keys += [without[pos], np.array([own])]
                places += [pos, np.array([-1])]
                owners.append(np.full(len(pos) + 1, h1))
            yield {"key": np.concatenate(keys), "pos": np.concatenate(places), "h1": np.concatenate(owners)}
        return work

    return arrow_map(lines, "key long, pos int, h1 long", make)


def near_links(lines: DataFrame) -> DataFrame:
    """(src, dst): verified links between lines (column line, hash h1)."""
    around = neighbourhood(lines)
    holes = around.filter("pos >= 0")
    groups = stored(holes.groupBy("key", "pos").agg(F.min("h1").alias("centre"), F.max("h1").alias("last")), "variants")
    replaced = (holes.join(groups.filter("centre <> last").hint("shuffle_merge"), ["key", "pos"])
                .filter("h1 <> centre").select(F.col("h1").alias("src"), F.col("centre").alias("dst")))
    whole = around.filter("pos < 0").select("key", F.col("h1").alias("src"))
    inserted = whole.join(groups.select("key", F.col("centre").alias("dst")).hint("shuffle_merge"), "key").select("src", "dst")
    found = replaced.unionByName(inserted).filter("src <> dst").distinct()

    def make():
        def work(batch):
            ok = [word_distance_at_most_one(a.encode().split(b" "), b.encode().split(b" "))
                  for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())]
            yield {c: batch.column(c).filter(pa.array(ok)) for c in ("src", "dst")}
        return work

    texts = found.join(lines.select(F.col("h1").alias("src"), F.col("line").alias("a")).hint("shuffle_merge"), "src").join(
        lines.select(F.col("h1").alias("dst"), F.col("line").alias("b")).hint("shuffle_merge"), "dst")
    return arrow_map(texts.select("src", "dst", "a", "b"), "src long, dst long", make)


def dropped_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, dropped): the sorted numbers (from 0) of the lines that leave each document."""
    lines = stored(occurrences(docs), "lines")
    place = F.struct("doc_id", "line_no")
    classes = stored(lines.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")), "line-classes")
    again = stored(read_again(docs, near_candidates(lines, classes)), "near-lines")
    near = connected_components(near_links(again)).withColumnRenamed("node", "h1")
    # A class is a set of equal lines or, through near links, of several such sets.
    sets = (classes.join(near.hint("shuffle_merge"), "h1", "left").filter("n > 1 or component is not null")
            .select("h1", "h2", "first", F.coalesce("component", "h1").alias("component"),
                    F.when(F.col("component").isNull(), F.col("h2")).alias("own")))
    first = sets.groupBy("component", "own").agg(F.min("first").alias("class_first"))
    sets = sets.alias("s").join(first.alias("f"), (F.col("s.component") == F.col("f.component"))
                                & F.col("s.own").eqNullSafe(F.col("f.own"))).select("h1", "h2", "class_first")
    return (lines.select("doc_id", "line_no", "h1", "h2").join(sets.hint("shuffle_merge"), ["h1", "h2"])
            .filter(place != F.col("class_first"))
            .groupBy("doc_id").agg(F.sort_array(F.collect_set("line_no")).alias("dropped")))


def line_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines (lines that hold words), n_dropped, dropped (line numbers,
    comma-joined) for every row of docs."""
    word_lines = F.when(F.col("text").isNull(), F.lit(0)).otherwise(
        F.size(F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"\S"))))
    rows = docs.select("doc_id", word_lines.cast("long").alias("n_lines"))
    none = F.array().cast("array<int>")
    return rows.join(dropped_lines(docs), "doc_id", "left").select(
        "doc_id", "n_lines", F.size(F.coalesce("dropped", none)).cast("long").alias("n_dropped"),
        F.array_join(F.coalesce("dropped", none), ",").alias("dropped"))


def without_lines(text: Column, dropped: Column) -> Column:
    """text without the lines of these numbers, in linear time: a hash set leaves the numbers
    that stay, and each is looked up in the lines, which are split once."""
    def kept(lines):
        numbers = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), dropped)
        return F.array_join(F.transform(numbers, lambda i: F.element_at(lines, i + 1)), "\n")

    return F.element_at(F.transform(F.array(F.split(text, "\n", -1)), kept), 1)


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The rows and columns of docs, with the dropped lines gone from text. A
    document that had words and is left without any line goes."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id")  # in a struct, so that no name can clash
    both = rows.join(dropped_lines(docs).hint("shuffle_merge"), "doc_id", "left")
    text = F.when(F.col("dropped").isNull(), F.col("row.text")).otherwise(without_lines(F.col("row.text"), F.col("dropped")))
    out = both.select("row", "dropped", text.alias("text")).filter(F.col("dropped").isNull() | F.col("text").rlike(r"\S"))
    return out.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])
