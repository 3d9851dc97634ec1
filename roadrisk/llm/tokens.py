"""Token counts by overlap resynchronisation.

A text of ordinary length is encoded whole. A huge text is cut into overlapping
chunks that are encoded one by one, with offsets, and spliced:

The tokenizer first cuts special strings and then pre-tokens by a pattern that
scans left to right and keeps no state between matches; merges never cross a
pre-token. So once two encodings both have a pre-token boundary at the same
place, everything after it is the same, as far as both see enough text to the
right. A splice point is such a common boundary that is at least ``GUARD``
characters from the end of the left chunk (longer than any special string and
than the pattern's lookahead). Tokens left of it count from the left chunk,
tokens right of it from the right one. When an overlap holds no common boundary
the chunk that begins there is encoded again from further left (the overlap is
doubled, up to the whole left chunk), and if even that fails the two chunks are
joined and encoded as one.

Counts therefore equal those of the whole text; memory is bounded by the chunk
unless the text has no boundary at all.

The same proof makes ordinary texts cheap. A space before an ASCII letter and
after a printable ASCII character always begins a pre-token: no pattern match
that begins earlier reaches over it, and no special string holds a space. So the
count of a text is the sum over its pieces between such places, and pieces
(mostly single words) repeat: each is encoded by the library once and remembered,
in a table of bounded size.

Defined results: null and empty texts have 0 bytes and 0 tokens. Repeated rows
each give their own row. An empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import functools
import os
import re

import numpy as np
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from roadrisk.llm.common import arrow_map

CHUNK = 32768        # characters
OVERLAP = 512
GUARD = 64
LIMIT = 512          # tokens

PIECES = re.compile(r"(?<=[!-~])(?= [A-Za-z])")   # splits before a space that begins a pre-token
REMEMBERED = 1_000_000  # pieces, in each Python worker
PIECE_CHARS = 64      # longer ones aren't remembered
TEXTS_AT_ONCE = 256


def boundaries(encoding, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (characters of the whole text) at which a pre-token or special
    string begins, and the number of tokens before each."""
    offsets = np.array(encoding.offsets, dtype=np.int64).reshape(-1, 2)
    words = np.array([-1 if w is None else w for w in encoding.word_ids], dtype=np.int64)
    first = np.ones(len(words), dtype=bool)
    first[1:] = (words[1:] != words[:-1]) | (words[1:] < 0)
    at = np.flatnonzero(first)
    starts = offsets[at, 0] + base
    # A byte-level token may begin inside a character; the first token of a pre-token never does.
    return starts, at


def count_spliced(text: str, tokenizer: Tokenizer, chunk: int = CHUNK, overlap: int = OVERLAP, guard: int = GUARD) -> int:
    encode = lambda a, z: tokenizer.encode(text[a:z], add_special_tokens=False)
    total = 0                       # tokens before `done`
    start = done = 0                # the left chunk begins at start; tokens from done on are not counted yet
    end = min(len(text), chunk)
    reach = chunk                   # characters by which a left chunk without a splice point grows
    left = encode(start, end)
    while end < len(text):
        lefts, before = boundaries(left, start)
        tokens_before = dict(zip(lefts.tolist(), before.tolist()))
        wide, joined = overlap, True
        while ((lefts > done) & (lefts <= end - guard)).any():  # else there is nothing to splice at
            begin = max(start + 1, end - wide)
            stop = min(len(text), end + chunk)
            right = encode(begin, stop)
            rights, r_before = boundaries(right, begin)
            # The right chunk's own start is no proof: its scan merely begins there.
            common = np.intersect1d(lefts, rights[rights > begin])
            common = common[(common > done) & (common <= end - guard)]
            if len(common):
                at = int(common[len(common) // 2])
                joined = False
                break
            if begin <= done + 1 or begin == start + 1:
                break
            wide *= 2
        if joined:
            end = min(len(text), end + reach)
            left = encode(start, end)
            reach = end - start     # twice as far each time: few encodings of a text without boundaries
            continue
        reach = chunk
        total += tokens_before[at] - (tokens_before[done] if done > start else 0)
        start, left = begin, right
        done, end = at, stop
    if not done:
        return len(left.ids)
    places, before = boundaries(left, start)
    return total + len(left.ids) - int(before[np.searchsorted(places, done)])


@functools.lru_cache(maxsize=2)  # a worker keeps what it has learned from task to task
def counter(path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
    """A function from a list of texts to their token counts."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    known: dict[str, int] = {}

    def lengths(texts: list[str]) -> list[int]:
        return [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def count_short(texts: list[str]) -> list[int]:
        pieces = [PIECES.split(t) for t in texts]
        new = list({p for ps in pieces for p in ps if p not in known})
        found = dict(zip(new, lengths(new)))
        out = [sum([known[p] if p in known else found[p] for p in ps]) for ps in pieces]
        if len(known) < REMEMBERED:
            known.update((p, n) for p, n in found.items() if len(p) <= PIECE_CHARS)
        return out

    def count(texts: list[str | None]) -> list[int]:
        texts = [t or "" for t in texts]
        short = [t for t in texts if len(t) <= 2 * chunk]
        counts = iter([n for at in range(0, len(short), TEXTS_AT_ONCE) for n in count_short(short[at:at + TEXTS_AT_ONCE])])
        return [next(counts) if len(t) <= 2 * chunk else count_spliced(t, tokenizer, chunk, overlap) for t in texts]

    return count


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row. ``path``: the tokenizer file, present on every machine."""
    def make():
        count = counter(path, chunk, overlap)

        def work(batch):
            texts = batch.column("text").to_pylist()
            n = count(texts)
            yield {"doc_id": batch.column("doc_id"), "n_bytes": [len((t or "").encode()) for t in texts],
                   "n_tokens": n, "over_limit": [x > limit for x in n]}
        return work

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", "text"), f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean", make)
