"""BPE encoding by dynamic programming over prefixes, and decoding.

A merge-rank BPE gives every text exactly one encoding, and a token sequence is that
encoding if and only if each pair of neighbours is compatible: merging the bytes of
the two tokens alone gives these two tokens again. So every prefix of a pre-token has
exactly one possible last token: the one that is a suffix of the prefix and compatible
with the last token of the prefix before it. An Aho-Corasick automaton (the suffix
automaton of the vocabulary) lists all tokens that end at a place in one scan; the
compatible one is stored for each prefix, and the back-pointers from the end give the
ids. Time is linear in the text for a vocabulary with a longest token, also for a
pre-token of millions of letters; the library's merging isn't called.

Compatibility of tokens a, b: while BPE works, the token left of the boundary walks
up the right edge of a's merge tree, the one right of it up the left edge of b's. A
node x lives from its own merge to its parent's. The pair is broken up if some x and y
that meet have a merge of lower rank than those that use up x or y (on equal ranks
the left one comes first, so a tie with x's own merge keeps the pair and a tie with
y's breaks it). Answers are remembered.

Special strings are cut out first, as the library does, then the usual pattern of
byte-level vocabularies finds the pre-tokens. Most of them repeat: their ids are
remembered, in a table of bounded size per Python worker.

Supported files: byte-level BPE without normalizer, whose ids follow the merge order
or not (ranks are read from the merges). Others raise ValueError.

Defined results: null and empty texts have no tokens and decode to an empty text. Very
long texts are read whole. Repeated rows each give their own row; an empty table gives
no rows; extra columns are not read. Decoding an id sequence whose bytes aren't UTF-8
gives replacement characters; null ids decode to null, unknown ids are left out.
"""

from __future__ import annotations

import functools
import hashlib
import json

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from roadrisk.llm.common import arrow_map

#: FIXED: the pre-token pattern of byte-level vocabularies (contractions, words, numbers,
#: other signs, white space).
PRETOKENS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

REMEMBERED = 1_000_000   # pre-tokens, in each Python worker
PRETOKEN_CHARS = 64      # longer ones aren't remembered
REMEMBERED_PAIRS = 2_000_000


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary: printable
    Latin-1 characters stand for themselves, the others for the characters from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    moved = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(moved)}


def _plain(pre: dict) -> bool:
    return pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)


class PrefixBPE:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
               if model.get(k)]
        if model.get("type") != "BPE" or odd or spec["normalizer"] or not _plain(spec["pre_tokenizer"] or {}):
            raise ValueError(f"{path}: not a plain byte-level BPE file {odd}")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: added tokens that depend on their neighbours")
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.splitter = Tokenizer.from_file(path).pre_tokenizer
        self.like: set[str] = set()     # signs that the pattern and the library class alike
        self.unlike: set[str] = set()

        # Merge tree: rank of a pair, the children of a token and the rank that made it.
        self.rank: dict[tuple[int, int], int] = {}
        children: dict[int, tuple[int, int, int]] = {}
        for r, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair = vocab[left], vocab[right]
            self.rank.setdefault(pair, r)
            children.setdefault(vocab[left + right], (*pair, r))
        self.never = never = len(model["merges"])

        def edge(token: int, side: int) -> list[tuple[int, int]]:
            """(node, rank of the merge that uses it up) from the token down its left (0) or right (1) edge."""
            out = [(token, never)]
            while token in children:
                rank = children[token][2]
                token = children[token][side]
                out.append((token, rank))
            return out

        letters = byte_letters()
        codes = {letter: bytes([b]) for b, letter in letters.items()}
        usable = {t: i for t, i in vocab.items() if t not in self.special and all(c in codes for c in t)}
        made = {i for t, i in usable.items() if len(t) == 1 or i in children}
        self.left_edge = {i: edge(i, 0) for i in made}
        self.right_edge = {i: edge(i, 1) for i in made}
        self.length = {i: len(t) for t, i in usable.items()}
        self.bytes = {i: b"".join(map(codes.__getitem__, t)) for t, i in usable.items()}
        self.bytes |= {i: t.encode() for t, i in self.special.items()}
        self.letters = {b: ord(letter) for b, letter in letters.items()}
        self.pairs: dict[tuple[int, int], bool] = {}
        #: Tokens that merging their own bytes gives; the others never occur.
        self.whole = {t: i for t, i in usable.items() if i in made and (len(t) == 1 or self._whole(i))}
        self.automaton = ahocorasick.Automaton()
        for t, i in self.whole.items():
            self.automaton.add_word(t, i)
        self.automaton.make_automaton()

    def _whole(self, token: int) -> bool:
        """Whether merging the token's own bytes gives the token (else it never occurs): no
        merge across its two parts' boundary comes before the one that makes it."""
        (left, rank), (right, _) = self.left_edge[token][1], self.right_edge[token][1]
        return not self._broken(left, right, rank)

    def _broken(self, a: int, b: int, before: int) -> bool:
        """Whether a merge of rank below ``before`` crosses the boundary of a and b."""
        for x, x_used in self.right_edge[a]:
            for y, y_used in self.left_edge[b]:
                r = self.rank.get((x, y))
                if r is not None and r < before and r < x_used and r <= y_used:
                    return True
        return False

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the bytes of a and b gives a, b."""
        known = self.pairs.get((a, b))
        if known is None:
            known = not self._broken(a, b, self.never)
            if len(self.pairs) < REMEMBERED_PAIRS:
                self.pairs[a, b] = known
        return known

    def pretokens(self, text: str) -> list[str]:
        """The library's pre-tokens of a text without special strings.

        The pattern's engine may know other Unicode versions than the library: each sign
        beyond ASCII is compared once, and texts with a sign that the two class
        differently are split by the library itself."""
        if not text.isascii():
            signs = set(text)
            for sign in signs - self.like - self.unlike:
                probe = f"a{sign}1{sign} {sign}a"
                alike = PRETOKENS.findall(probe) == self._split(probe)
                (self.like if alike else self.unlike).add(sign)
            if not signs.isdisjoint(self.unlike):
                return self._split(text)
        return PRETOKENS.findall(text)

    def _split(self, text: str) -> list[str]:
        return [text[a:z] for _, (a, z) in self.splitter.pre_tokenize_str(text)]

    def encode_pretoken(self, pretoken: str) -> list[int]:
        """Ids of one pre-token."""
        letters = pretoken.encode().decode("latin-1").translate(self.letters)
        whole = self.whole.get(letters)
        if whole is not None:
            return [whole]
        n = len(letters)
        last = [0] * (n + 1)      # the last token of each prefix; place 0 is the empty one
        length, pairs, compatible = self.length, self.pairs, self.compatible
        done = -1
        for end, token in self.automaton.iter(letters):
            if end == done:
                continue          # this prefix has its token
            begin = end + 1 - length[token]
            if begin:
                before = last[begin]
                fits = pairs.get((before, token))
                if not (compatible(before, token) if fits is None else fits):
                    continue
            last[end + 1] = token
            done = end
        out = []
        while n > 0:
            token = last[n]
            out.append(token)
            n -= length[token]
        return out[::-1]

    def sections(self, text: str):
        """(text, None) and (special string, its id) in order; of special strings that begin at
        the same place the longest counts."""
        at = 0
        while True:
            found = [(p, -len(s), s) for s in self.special if s and (p := text.find(s, at)) >= 0]
            if not found:
                break
            p, _, s = min(found)
            if p > at:
                yield text[at:p], None
            yield s, self.special[s]
            at = p + len(s)
        if at < len(text):
            yield text[at:], None

    def decode(self, ids) -> str:
        return b"".join([self.bytes.get(i, b"") for i in ids]).decode("utf-8", errors="replace")


class Coder:
    """A ``PrefixBPE`` that remembers the pre-tokens it has met. Ids are kept as decimal
    text, comma-joined: the most compact form for many short sequences."""

    def __init__(self, path: str):
        self.bpe = PrefixBPE(path)
        self.known: dict[str, str] = {}
        self.decimal = {str(i): b for i, b in self.bpe.bytes.items()}

    def encode(self, text: str) -> str:
        """The ids of a text, comma-joined."""
        known = self.known
        parts: list[str] = []
        for section, special in self.bpe.sections(text):
            if special is not None:
                parts.append(str(special))
                continue
            pretokens = self.bpe.pretokens(section)
            ids = list(map(known.get, pretokens))
            if None in ids:
                for at, coded in enumerate(ids):
                    if coded is None:
                        ids[at] = self._learn(pretokens[at])
            parts += ids
        return ",".join(parts)

    def _learn(self, pretoken: str) -> str:
        coded = self.known.get(pretoken)
        if coded is None:
            coded = ",".join(map(str, self.bpe.encode_pretoken(pretoken)))
            if len(pretoken) <= PRETOKEN_CHARS and len(self.known) < REMEMBERED:
                self.known[pretoken] = coded
        return coded

    def decode(self, ids: str) -> str:
        """The text of comma-joined ids."""
        return b"".join(map(self.decimal.__getitem__, ids.split(","))).decode("utf-8", errors="replace") if ids else ""


@functools.lru_cache(maxsize=2)  # a worker keeps what it has learned from task to task
def coder(path: str) -> Coder:
    return Coder(path)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ``ids`` (array of int) of every whole text. ``path``: the tokenizer file, present on every machine."""
    def make():
        import pyarrow as pa

        code = coder(path)

        def work(batch):
            ids = [code.encode(t or "") for t in batch.column("text").to_pylist()]
            flat = [np.array(x.split(",") if x else [], dtype=np.int32) for x in ids]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in flat])]).astype(np.int32)
            yield {"doc_id": batch.column("doc_id"), "ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(flat)))}
        return work

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", "text"), f"doc_id {kind}, ids array<int>", make)


def decoded(coded: DataFrame, path: str) -> DataFrame:
    """doc_id and ``text`` of every row of ids."""
    def make():
        decode = coder(path).bpe.decode

        def work(batch):
            yield {"doc_id": batch.column("doc_id"),
                   "text": [None if x is None else decode(x) for x in batch.column("ids").to_pylist()]}
        return work

    kind = coded.schema["doc_id"].dataType.simpleString()
    return arrow_map(coded.select("doc_id", "ids"), f"doc_id {kind}, text string", make)


def coding_report(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 (the ids' own decoding) in one pass."""
    def sha(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    def make():
        code = coder(path)

        def work(batch):
            out = {"doc_id": batch.column("doc_id"), "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for text in batch.column("text"):  # one text's ids at a time
                ids = code.encode(text.as_py() or "")
                out["n_tokens"].append(ids.count(",") + 1 if ids else 0)
                out["ids_sha256"].append(sha(ids))
                out["decoded_sha256"].append(sha(code.decode(ids)))
            yield out
        return work

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", "text"), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string", make)
