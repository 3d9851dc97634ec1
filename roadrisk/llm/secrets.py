"""Secret scan with inferred credential grammars.

Three patterns find credentials outright (``assign``, ``access``, ``hex``). What
they match is labelled data: per kind, the values become strings of character
classes, a prefix tree counts them, and states whose outgoing frequencies can't
be told apart (Hoeffding bound) are merged into a probabilistic automaton. All
other long tokens with letters and digits are candidates; each is scored by its
likelihood per symbol under every automaton, against a background: how often one
character class follows another in all text outside the labelled values and outside candidates
whose likelihood is in a kind's range (else keys without a label would pass for ordinary
text), mixed with ``UNSEEN`` parts of random printable text, so that a single odd step
(a digit after a word) can't make a token look like a key. A candidate stays (as ``like_<kind>``)
when it is no shorter than the kind's labelled values, its likelihood is within their
range, and it is clearly above the background. A token that isn't accepted whole is
read again in its pieces between ``=``, ``/`` and ``.`` (``auth=<key>``, paths).

The automata are fitted on a bounded sample: ``SAMPLE`` different values per kind,
chosen by hash, of at most ``LONGEST`` characters each, as whole values. Only class
strings of the values are ever stored, not the values. Everything else, the background
too, reads all texts whole.

Offsets are code points, end exclusive. Matches are leftmost and don't overlap
within a kind; a match that fails its length check is dropped.

Defined results: null and empty texts have no spans; without labelled values there
are no automata and only base spans. Repeated rows each give their own row. An
empty table gives no rows. Only doc_id and text are read, so extra columns of any
name are no matter. Very long texts are read whole, in linear time.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadrisk.llm.common import arrow_map, stored

BASE_KINDS = ("assign", "access", "hex")
RANK = {k: i for i, k in enumerate([*BASE_KINDS, *(f"like_{k}" for k in BASE_KINDS)])}
SAMPLE = 400         # different labelled values per kind
ALPHA = 0.05         # of the Hoeffding bound
LONGEST = 2048       # characters of a labelled value that automata are fitted on
LEAST_RATIO = 0.35   # nats per symbol above the background
UNSEEN = 0.1         # share of random printable text in the background
LOW_SHARE = 0.01     # of the labelled values score below the acceptance level

KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


ASSIGN = re.compile(rf"""(?:{either_case("password")}|{either_case("passwd")}|{either_case("secret")}|{either_case("token")}|{either_case("api")}_?{either_case("key")})"""
                    r"""["']?+\x20*+[:=]\x20*+["']?+([A-Za-z0-9+/_.=-]++)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]++")
HEX = re.compile(r"[0-9a-f]{16,}+")
TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{12,}+")
PIECE = re.compile(r"[A-Za-z0-9+_-]{12,}+=*+")
DIGIT, LETTER = re.compile("[0-9]"), re.compile("[A-Za-z]")

HEX_MARKS = bytes(120 if 48 <= c <= 57 or 97 <= c <= 102 else 32 for c in range(256))
RUN = b"x" * 16

#: Character classes and their share of random printable text.
CLASSES = {"d": "0123456789", "h": "abcdef", "l": "ghijklmnopqrstuvwxyz", "H": "ABCDEF", "U": "GHIJKLMNOPQRSTUVWXYZ",
           "+": "+", "/": "/", "_": "_", "=": "=", "-": "-", ".": "."}
SYMBOL = {ord(c): s for s, cs in CLASSES.items() for c in cs}
CODES = {s: i + 1 for i, s in enumerate(CLASSES)}   # 0: any other character
WIDTH = len(CODES) + 1
CODE_OF = bytes(CODES[SYMBOL[c]] if c in SYMBOL else 0 for c in range(256))
SLICE = 2 ** 20      # bytes whose pairs are counted at once


def base_spans(text: str, data: bytes) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value); data is the text in UTF-8."""
    out = []
    low = data.lower()
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), m.end(), "assign", m[1]) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    if b"AKIA" in data:
        out += [(m.start(), m.end(), "access", m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    if RUN in data.translate(HEX_MARKS):
        out += [(m.start(), m.end(), "hex", m[0]) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], RANK[s[2]]))


def pair_counts(data: bytes) -> np.ndarray:
    """How often each class follows each other one: counts at WIDTH * first + second."""
    codes, counts = np.frombuffer(data.translate(CODE_OF), dtype=np.uint8), np.zeros(WIDTH * WIDTH, dtype=np.int64)
    for at in range(0, len(codes) - 1, SLICE):
        part = codes[at:at + SLICE + 1].astype(np.int16)
        counts += np.bincount(part[:-1] * WIDTH + part[1:], minlength=WIDTH * WIDTH)
    return counts


class Background:
    """Likelihood of ordinary text: classes by the class before, and random printable text."""

    def __init__(self, counts: dict[int, int] | None = None):
        self.log: dict[tuple[str, str], float] = {}
        for before, i in {"": 0, **CODES}.items():
            row = {s: (counts or {}).get(i * WIDTH + j, 0) for s, j in CODES.items()}
            n = sum(row.values())
            for s, k in row.items():
                even = len(CLASSES[s]) / 68
                self.log[before, s] = math.log(UNSEEN * even + (1 - UNSEEN) * (k / n if n else even))

    def likelihood(self, symbols: str) -> float:
        """Log-likelihood per symbol."""
        return sum(self.log[pair] for pair in zip(["", *symbols], symbols)) / max(1, len(symbols))


class Automaton:
    """A probabilistic automaton merged from a prefix tree of labelled strings."""

    def __init__(self, strings: list[str]):
        self.next: list[dict[str, int]] = [{}]
        self.seen: list[Counter] = [Counter()]   # by outgoing symbol; "" is the end
        for s in strings:
            at = 0
            for c in s:
                self.seen[at][c] += 1
                if c not in self.next[at]:
                    self.next[at][c] = len(self.next)
                    self.next.append({})
                    self.seen.append(Counter())
                at = self.next[at][c]
            self.seen[at][""] += 1
        self._merge()
        self.shortest = min(map(len, strings), default=0)
        scores = sorted(self.likelihood(s) for s in strings)
        self.level = scores[int(len(scores) * LOW_SHARE)] if scores else 0.0

    def _alike(self, a: int, b: int) -> bool:
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            na, nb = self.seen[a].total(), self.seen[b].total()
            if not na or not nb:
                continue
            bound = math.sqrt(0.5 * math.log(2 / ALPHA)) * (na ** -0.5 + nb ** -0.5)
            if any(abs(self.seen[a][c] / na - self.seen[b][c] / nb) > bound for c in {*self.seen[a], *self.seen[b]}):
                return False
            stack += [(self.next[a][c], self.next[b][c]) for c in self.next[a].keys() & self.next[b].keys()
                      if self.next[a][c] != self.next[b][c]]
        return True

    def _fold(self, a: int, b: int) -> None:
        """Adds the tree below b to the automaton at a."""
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            self.seen[a] += self.seen[b]
            for c, child in self.next[b].items():
                if c not in self.next[a]:
                    self.next[a][c] = child
                else:
                    stack.append((self.next[a][c], child))

    def _merge(self) -> None:
        settled, queue = [0], [(0, c) for c in sorted(self.next[0])]
        while queue:
            parent, c = queue.pop(0)
            state = self.next[parent][c]
            if state in settled:
                continue
            like = next((s for s in settled if self._alike(s, state)), None)
            if like is None:
                settled.append(state)
            else:
                self.next[parent][c] = like
                self._fold(like, state)
            done = set(settled)
            queue = [(s, k) for s in settled for k in sorted(self.next[s]) if self.next[s][k] not in done]

    def likelihood(self, symbols: str) -> float:
        """Log-likelihood per symbol; symbols never seen in a state cost a fixed floor."""
        at, total = 0, 0.0
        for c in symbols:
            n = self.seen[at].total()
            total += math.log((self.seen[at][c] + 0.01) / (n + 0.12))
            if c not in self.next[at]:
                return -99.0
            at = self.next[at][c]
        return total / max(1, len(symbols))


def candidates(text: str, base) -> list[tuple[int, int, str]]:
    """Long tokens with letters and digits outside the base spans, without full stops at their end."""
    if not DIGIT.search(text):
        return []
    out, at = [], 0
    for m in TOKEN.finditer(text):
        token = m[0].rstrip(".")
        if len(token) >= 12 and DIGIT.search(token) and LETTER.search(token):
            while at < len(base) and base[at][1] <= m.start():
                at += 1
            if not any(s[0] < m.end() and m.start() < s[1] for s in base[max(0, at - 3):at + 3]):
                out.append((m.start(), m.start() + len(token), token))
    return out


def in_range(symbols: str, automata: dict[str, Automaton]) -> tuple[float, str] | None:
    """(likelihood, kind) of the best automaton whose range (least length and likelihood of its labelled values) takes them."""
    scores = ((a.likelihood(symbols), a.level, k) for k, a in sorted(automata.items()) if len(symbols) >= a.shortest)
    return max(((score, k) for score, level, k in scores if score >= level), default=None)


def accepted(token: str, automata: dict[str, Automaton], background: Background = Background()) -> tuple[str, float] | None:
    """(kind, nats per symbol above the background) of the best automaton that takes the token."""
    symbols = token.translate(SYMBOL)
    best = in_range(symbols, automata)
    if best is None:
        return None
    above = best[0] - background.likelihood(symbols)
    return (best[1], above) if above >= LEAST_RATIO else None


def like_spans(text: str, base, automata: dict[str, Automaton], background: Background) -> list[tuple[int, int, str]]:
    """The spans that the automata add: candidates, or the pieces of one that isn't accepted whole."""
    out = []
    for start, end, token in candidates(text, base):
        if hit := accepted(token, automata, background):
            out.append((start, end, f"like_{hit[0]}"))
            continue
        for m in PIECE.finditer(token):
            if len(m[0]) < len(token) and DIGIT.search(m[0]) and LETTER.search(m[0]) and (hit := accepted(m[0], automata, background)):
                out.append((start + m.start(), start + m.end(), f"like_{hit[0]}"))
    return out


def learn_automata(docs: DataFrame) -> dict[str, Automaton]:
    """An automaton per kind, from a bounded sample of the base matches in all docs."""
    def make():
        def work(batch):
            rows = {(kind, xxhash.xxh3_64_intdigest(value) - 2 ** 63, value.translate(SYMBOL))
                    for t in batch.column("text").to_pylist() if t
                    for _, _, kind, match in base_spans(t, t.encode()) if len(value := match.rstrip(".")) <= LONGEST}
            if rows:
                yield dict(zip(("kind", "h", "symbols"), map(list, zip(*sorted(rows)))))
        return work

    rows = stored(arrow_map(docs.select("text"), "kind string, h long, symbols string", make).distinct(), "credentials")
    counts = {r["kind"]: r["n"] for r in rows.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return {}
    limits = F.create_map(*[x for k, n in sorted(counts.items()) for x in (
        F.lit(k), F.lit(min(2 ** 63 - 1, -2 ** 63 + int(2 ** 64 * min(1.0, 4 * SAMPLE / n)))))])
    first = F.row_number().over(Window.partitionBy("kind").orderBy("h", "symbols"))
    sample = (rows.filter(F.col("h") <= limits[F.col("kind")]).withColumn("k", first)
              .filter(F.col("k") <= SAMPLE).select("kind", "symbols").collect())
    return {kind: Automaton(sorted(r["symbols"] for r in sample if r["kind"] == kind)) for kind in sorted(counts)}


def learn_background(docs: DataFrame, automata: dict[str, Automaton]) -> Background:
    """The background of all text outside the base matches and the candidates in a kind's range."""
    shared = docs.sparkSession.sparkContext.broadcast(automata)

    def make():
        def ordinary(text: str) -> bytes:
            data = text.encode()
            base = base_spans(text, data)
            out = sorted([(a, b) for a, b, *_ in base] + [
                (a, b) for a, b, token in candidates(text, base) if in_range(token.translate(SYMBOL), shared.value)])
            if not out:
                return data
            rest, at = [], 0
            for start, end in out:
                rest.append(text[at:max(at, start)])
                at = max(at, end)
            return " ".join([*rest, text[at:]]).encode()

        def work(batch):
            pairs = sum((pair_counts(ordinary(t)) for t in batch.column("text").to_pylist() if t), np.zeros(WIDTH * WIDTH, dtype=np.int64))
            seen = np.flatnonzero(pairs)
            if len(seen):
                yield {"pair": seen.tolist(), "n": pairs[seen].tolist()}
        return work

    counts = arrow_map(docs.select("text"), "pair int, n long", make).groupBy("pair").agg(F.sum("n").alias("n"))
    return Background({r["pair"]: r["n"] for r in counts.collect()})  # at most WIDTH * WIDTH rows


def learn(docs: DataFrame) -> tuple[dict[str, Automaton], Background]:
    automata = learn_automata(docs)
    return automata, learn_background(docs, automata) if automata else Background()


def secrets(docs: DataFrame, learned: tuple[dict[str, Automaton], Background] | None = None) -> DataFrame:
    """doc_id, the number of spans of each base kind, base_sha256, spans and n_more for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs) if learned is None else learned)

    def make():
        def scan(text: str | None):
            text = text or ""
            base = base_spans(text, text.encode())
            more = like_spans(text, base, *shared.value)
            return base, sorted([*(s[:3] for s in base), *more], key=lambda s: (s[0], RANK[s[2]]))

        def joined(spans):
            return ",".join(f"{s[2]}:{s[0]}:{s[1]}" for s in spans)

        def work(batch):
            found = [scan(t) for t in batch.column("text").to_pylist()]
            yield {"doc_id": batch.column("doc_id")} | {
                f"n_{k}": [sum(s[2] == k for s in base) for base, _ in found] for k in BASE_KINDS} | {
                "base_sha256": [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found],
                "spans": [joined(spans) for _, spans in found],
                "n_more": [len(spans) - len(base) for base, spans in found]}
        return work

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", "text"), f"doc_id {kind}, n_assign long, n_access long, n_hex long, "
                     "base_sha256 string, spans string, n_more long", make)
