"""Periodic runs of words, found online by dyadic square catching.

A run is a stretch [start, end) of words with smallest period q (words q apart
are identical) that no neighbouring word extends, at least ``least_exponent``
periods and ``least_length`` words long.

``SquareCatchers`` reads words as they are appended, one or many at a time:

- Every completed block of H = 2, 4, 8 ... (and 1) words that begins at a multiple
  of H is a catcher. It waits for its own words to come back at a distance q of
  2H to 4H (period 1 has catchers of one word). A square of period q is 2q words
  long, so it holds such a block and the block's copy q words later: none is missed.
- An appended word completes one suffix of every length H. The suffix is compared
  with the two catchers of that length whose distance fits: a constant number of
  comparisons a word and level, O(log n) a word in all. Blocks are compared by
  64-bit fingerprints, each made of the two fingerprints of half its length.
- A caught block is extended to the left (by less than H words: beyond that the
  catcher before it has caught the same square) and to the right as far as words
  agree. An extension that reaches the last word stays open and goes on with the
  next append. When it ends, it is a run of period q if it holds a square.
- The same stretch can be caught at a multiple of its period. By Fine and Wilf's
  theorem the stretches are then equal, so the least period of each is kept.

Reported runs are compared word by word at the end; if a fingerprint ever deceived
(about one in 2^64 comparisons does), the words are read again with other ones.

Time is O(n log n) and memory 8 bytes a word and level, at most log2(longest
period) levels, for one text at a time. Short texts share one stream, kept apart
by words that occur once.

Defined results: words are `[^\\x20\\x09-\\x0D]+`; null and empty texts have no words,
no runs and an empty collapsed text. Very long texts are read whole. Repeated rows
each give their own row. An empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadrisk.llm.common import arrow_map

LEAST_LENGTH = 6
LEAST_EXPONENT = 4
STREAM_WORDS = 1 << 16   # texts share a stream until it holds so many words

_U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Growing:
    """An array that grows at its end."""

    def __init__(self):
        self.data = np.empty(0, dtype=_U)
        self.n = 0

    def extend(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.data):
            bigger = np.empty(max(self.n + len(more), 2 * self.n), dtype=_U)
            bigger[:self.n] = self.data[:self.n]
            self.data = bigger
        self.data[self.n:self.n + len(more)] = more
        self.n += len(more)


class SquareCatchers:
    """Online detector of all maximal repetitions with at least two periods.

    ``longest_period`` bounds the periods looked for (None: no bound)."""

    def __init__(self, longest_period: int | None = None, seed: int = 0):
        self.longest = longest_period
        self.seed = seed
        self.n = 0
        self.prints: list[_Growing] = []           # prints[k].data[i]: words i .. i + 2^k - 1
        self.open = np.empty((0, 3), dtype=np.int64)   # start, period, end (= n): still extending
        self.closed: list[np.ndarray] = []

    def append(self, words: np.ndarray) -> None:
        """``words``: int64 names of the next words, equal for equal words."""
        old, self.n = self.n, self.n + len(words)
        self._print(words)
        caught = [self.open, *self._catch(old)]
        found = np.concatenate(caught)
        found[:, 2] = self._extend_right(found[:, 2] - found[:, 1], found[:, 2])
        running = found[:, 2] == self.n
        self.open = found[running]
        self._close(found[~running])

    def finish(self) -> np.ndarray:
        """Rows (start, end, period) by start, then period."""
        self._close(self.open)
        self.open = self.open[:0]
        rows = np.concatenate([np.empty((0, 3), dtype=np.int64), *self.closed])
        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
        first = np.ones(len(rows), dtype=bool)
        first[1:] = (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1])
        rows = rows[first]
        return rows[np.lexsort((rows[:, 2], rows[:, 0]))]

    def _close(self, found: np.ndarray) -> None:
        squares = found[:, 2] - found[:, 0] >= 2 * found[:, 1]
        self.closed.append(found[squares][:, [0, 2, 1]])

    def _print(self, words: np.ndarray) -> None:
        """Fingerprints of all windows that the new words complete."""
        k = 0
        while (1 << k) <= self.n and (self.longest is None or k == 0 or (1 << k) <= self.longest):
            if k == len(self.prints):
                self.prints.append(_Growing())
            level = self.prints[k]
            if k == 0:
                salt = _U(0x9E3779B97F4A7C15 * (2 * self.seed + 1) % 2 ** 64)
                level.extend(_mixed(words.astype(_U) + salt))
            else:
                half, lower = 1 << (k - 1), self.prints[k - 1].data
                a, z = level.n, self.n - (1 << k) + 1
                level.extend(_mixed(lower[a:z] * _U(0xD6E8FEB86659FD93) + lower[a + half:z + half]))
            k += 1

    def _catch(self, old: int) -> list[np.ndarray]:
        """New squares-to-be (start, period, end of the match known so far)."""
        out = []
        longest = self.n if self.longest is None else self.longest
        for level, at_print in enumerate(self.prints):
            size = 1 << level
            if (1 if size == 1 else 2 * size) > longest:
                break
            prints = at_print.data
            p = np.arange(max(0, old - size + 1), self.n - size + 1)
            near = (p // size - 2) * size
            for c in ([p - 1] if level == 0 else []) + [near, near - size]:
                a = int(np.searchsorted(c, 0))      # c never falls
                hit = a + np.flatnonzero(prints[c[a:]] == prints[p[a:]])
                at, back = c[hit], p[hit]
                new = np.ones(len(hit), dtype=bool)
                earlier = at >= size                # caught by the catcher before this one?
                new[earlier] = prints[at[earlier] - size] != prints[back[earlier] - size]
                new &= back - at <= longest
                at, back = at[new], back[new]
                left = self._extend_left(at, back, level)
                out.append(np.stack([at - left, back - at, back + size], axis=1))
        return out

    def _extend_left(self, x: np.ndarray, y: np.ndarray, level: int) -> np.ndarray:
        """Number of equal words before x and y, known to be below 2^level."""
        got = np.zeros(len(x), dtype=np.int64)
        for k in range(level - 1, -1, -1):
            prints, size = self.prints[k].data, 1 << k
            fits = np.flatnonzero(x - got >= size)
            a, b = x[fits] - got[fits] - size, y[fits] - got[fits] - size
            got[fits[prints[a] == prints[b]]] += size
        return got

    def _extend_right(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The end of the equal words from x < y on, as a place to the right of y."""
        y, gap = y.copy(), y - x
        top = len(self.prints) - 1

        def step(k: int, who: np.ndarray) -> np.ndarray:
            prints, size = self.prints[k].data, 1 << k
            who = who[y[who] + size <= self.n]
            who = who[prints[y[who] - gap[who]] == prints[y[who]]]
            y[who] += size
            return who

        going = np.arange(len(y))
        while len(going):           # strides of the longest fingerprints, then ever shorter ones
            going = step(top, going)
        for k in range(top - 1, -1, -1):
            step(k, np.arange(len(y)))
        return y


def _proven(words: np.ndarray, rows: np.ndarray) -> bool:
    """Whether every row is a repetition that no neighbouring word extends."""
    for start, end, q in rows.tolist():
        if not np.array_equal(words[start:end - q], words[start + q:end]):
            return False
        if start and words[start - 1] == words[start - 1 + q] or end < len(words) and words[end] == words[end - q]:
            return False
    return True


def find_runs(words: np.ndarray, least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT,
              longest_text: int | None = None) -> np.ndarray:
    """Runs (start, end, period) of a stream of word names, by start, then period.
    ``longest_text`` bounds the length of a run when the stream holds several texts."""
    longest = (len(words) if longest_text is None else longest_text) // max(2, least_exponent)
    seed = 0
    while True:
        catchers = SquareCatchers(max(1, longest), seed)
        for at in range(0, len(words), STREAM_WORDS):
            catchers.append(words[at:at + STREAM_WORDS])
        rows = catchers.finish()
        length = rows[:, 1] - rows[:, 0]
        rows = rows[(length >= least_length) & (length >= least_exponent * rows[:, 2])]
        if _proven(words, rows):
            return rows
        seed += 1


def _streams(texts: list[bytes]):
    """Groups of texts that share a stream: (their words, places of their first words, word names)."""
    group: list[list[bytes]] = []
    total = 0
    for i, text in enumerate(texts):
        group.append(text.split())  # ASCII white space
        total += len(group[-1]) + 1
        if total >= STREAM_WORDS or i + 1 == len(texts):
            known: dict[bytes, int] = {}
            names = np.empty(total, dtype=np.int64)
            starts, at = [], 0
            for nth, words in enumerate(group):
                starts.append(at)
                names[at:at + len(words)] = [known.setdefault(w, len(known)) for w in words]
                at += len(words) + 1
                names[at - 1] = -1 - nth  # occurs once, so nothing repeats across it
            yield group, starts, names
            group, total = [], 0


def text_runs(texts: list[bytes], least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT):
    """For each text (UTF-8): its runs as rows (start, end, period), and the text collapsed."""
    for group, starts, names in _streams(texts):
        rows = find_runs(names, least_length, least_exponent, max(map(len, group)))
        cut = np.searchsorted(rows[:, 0], [*starts, len(names)])
        for nth, words in enumerate(group):
            own = rows[cut[nth]:cut[nth + 1]] - np.array([starts[nth], starts[nth], 0])
            if len(own):
                steps = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(steps, own[:, 0] + own[:, 2], 1)
                np.add.at(steps, own[:, 1], -1)
                kept = np.flatnonzero(np.cumsum(steps[:-1]) == 0)
                words = [words[i] for i in kept.tolist()]
            yield own, b" ".join(words)


def document_runs(docs: DataFrame, least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT) -> DataFrame:
    """doc_id, runs (array of start, length, period by start, then period; word numbers from 0) and
    ``collapsed``: the words that no run holds after its first period, joined by one space."""
    def make():
        import pyarrow as pa

        def work(batch):
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            found = list(text_runs(texts, least_length, least_exponent))
            rows = np.concatenate([np.empty((0, 3), dtype=np.int64), *[r for r, _ in found]])
            items = pa.StructArray.from_arrays(
                [pa.array(rows[:, 0]), pa.array(rows[:, 1] - rows[:, 0]), pa.array(rows[:, 2])], ["start", "length", "period"])
            ends = np.concatenate([[0], np.cumsum([len(r) for r, _ in found])]).astype(np.int32)
            yield {"doc_id": batch.column("doc_id"), "runs": pa.ListArray.from_arrays(pa.array(ends), items),
                   "collapsed": pa.array([c for _, c in found], type=pa.binary()).cast(pa.string())}
        return work

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", "text"),
                     f"doc_id {kind}, runs array<struct<start: long, length: long, period: long>>, collapsed string", make)


#: Words as a JVM regular expression, the same as in the docstring.
WORDS = r"[^\x20\x09-\x0D]+"


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """The text that query 11 looks at: with h = crc32(doc_id) and g = h div 10, a
    document with h mod 10 = 0 repeats its words from a = g mod n on with the period
    1 + (n - a) div (3 + g mod 8). Others, and documents without an id, stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit(WORDS), 0)
    tail = docs.select("doc_id", "text", h.alias("_h")).withColumn("_w", F.when(F.col("_h") % 10 == 0, words))
    n, g = F.size("_w").cast("long"), F.floor(F.col("_h") / 10)
    a = F.when(n > 0, g % n)
    p = 1 + F.floor((n - a) / (3 + g % 8))
    tail = tail.withColumn("_a", a).withColumn("_p", p)
    index = F.transform(F.sequence(F.lit(0).cast("long"), n - 1),
                        lambda i: F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p")))
    repeated = F.array_join(F.transform(index, lambda i: F.element_at("_w", (i + 1).cast("int"))), " ")
    return tail.select("doc_id", F.when(n > 0, repeated).otherwise(F.col("text")).alias("text"))


def run_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_runs, the longest run (ties: smallest start, then
    period; null without a run) with its exponent in thousandths, and digests of all runs
    and of the collapsed text."""
    found = document_runs(with_periodic_tails(docs))
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return (found.withColumn("_best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_best.start")).alias("start"),
                    F.col("_best.length").alias("length"), (-F.col("_best.period")).alias("period"),
                    F.floor(1000 * F.col("_best.length") / -F.col("_best.period")).alias("exponent_milli"),
                    sha(F.array_join(lines, "")).alias("runs_sha256"), sha(F.col("collapsed")).alias("collapsed_sha256")))
