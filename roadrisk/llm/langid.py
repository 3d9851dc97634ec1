"""Language identification by compression.

Each language owns a zstandard raw-content dictionary made of sample texts. A
text is compressed once with each dictionary; the language whose dictionary
gives the fewest bytes wins. The margin between the best and the second best
size is the score; a narrow margin means "rejected". Very short texts are
repeated first, since a few bytes are stored as they are by every dictionary.

The dictionaries are the only thing learned. They come from a bounded sample of
labelled rows (``SAMPLE_DOCS`` texts per language, at most ``PIECE_CHARS``
characters of each, chosen by hash so that a rerun picks the same); everything
else reads every whole text.

Defined results: a null text, or one without a letter, gives ``und`` with score
0 and is rejected. Equal sizes go to the alphabetically first language. Without
any labelled row every text is ``und``. A null lang never trains. Repeated rows
each give their own (equal) row; extra columns are ignored or passed on.
"""

from __future__ import annotations

import re

import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from roadrisk.llm.common import arrow_map

SAMPLE_DOCS = 160      # labelled texts per language that enter its dictionary
PIECE_CHARS = 700      # characters taken of each
CHUNK = 8192           # bytes compressed at a time, so that a long text doesn't become its own dictionary
LEVEL = 5
SHORT = 96             # shorter texts are repeated up to this size: the format has no gain to show on a few bytes
MIN_MARGIN = 0.01      # narrower margins are rejected

NOT_LETTERS = re.compile(r"[\W\d_]+")


def normalized(text: str | None) -> str:
    """Lower-cased letters with single spaces; empty when there is no letter."""
    s = NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    return s if any(c.isalpha() for c in s) else ""


def fit(labelled: DataFrame, key: Column) -> dict[str, bytes]:
    """Dictionary content per language from (text, lang) rows; ``key`` orders them.

    Two passes: a count per language sets a hash sampling rate that leaves a few
    times ``SAMPLE_DOCS`` rows of each language, and the first ``SAMPLE_DOCS`` of
    those by hash are taken. What reaches one task or the driver is therefore
    bounded by the number of languages, whatever their sizes.
    """
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "lang", "text", F.xxhash64(key).alias("h"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return {}
    span = 2 ** 64
    limits = F.create_map(*[x for lang, n in sorted(counts.items()) for x in (
        F.lit(lang), F.lit(min(2 ** 63 - 1, -2 ** 63 + int(span * min(1.0, 6 * SAMPLE_DOCS / n)))))])
    # Texts of some length say more; short ones only fill what is left.
    short = (F.length("text") < PIECE_CHARS // 4).cast("int")
    start = F.greatest(F.lit(1), ((F.length("text") - PIECE_CHARS) / 2).cast("int"))
    w = Window.partitionBy("lang").orderBy("short", "h", "piece")
    picked = (rows.filter((F.col("h") <= limits[F.col("lang")]) & F.col("text").rlike(r"\p{L}"))
              .select("lang", "h", short.alias("short"), F.substring("text", start, F.lit(PIECE_CHARS)).alias("piece"))
              .withColumn("k", F.row_number().over(w)).filter(F.col("k") <= SAMPLE_DOCS))
    found: dict[str, list] = {}
    for r in picked.collect():
        found.setdefault(r["lang"], []).append((r["k"], r["piece"]))
    learned = {lang: " ".join(normalized(p) for _, p in sorted(v)).encode() for lang, v in found.items()}
    return {lang: content for lang, content in sorted(learned.items()) if len(content) >= 8}


def classifier(dictionaries: dict[str, bytes]):
    """text -> (language or None, score)."""
    coders = []
    for lang, content in sorted(dictionaries.items()):
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=LEVEL)
        coders.append((lang, zstandard.ZstdCompressor(
            dict_data=d, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)))

    def predict(text: str | None) -> tuple[str | None, float]:
        data = normalized(text).encode()
        if not data or not coders:
            return None, 0.0
        if len(data) < SHORT:
            data = b" ".join([data] * -(-SHORT // len(data)))
        chunks = [data[i:i + CHUNK] for i in range(0, len(data), CHUNK)]
        sizes = sorted((sum(len(z.compress(c)) for c in chunks), lang) for lang, z in coders)
        if len(sizes) == 1:
            return sizes[0][1], 1.0
        return sizes[0][1], 1.0 - sizes[0][0] / sizes[1][0]

    return predict


def identify(docs: DataFrame, dictionaries: dict[str, bytes], keep: list[str],
             min_margin: float = MIN_MARGIN) -> DataFrame:
    """``row`` (a struct of the columns ``keep``), lang_pred, score and accepted for every row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)
    rows = docs.select(F.struct(*keep).alias("row"), "text")  # in a struct, so that no name can clash
    kind = rows.schema["row"].dataType.simpleString()

    def make():
        predict = classifier(shared.value)

        def work(batch):
            out = [predict(t) for t in batch.column("text").to_pylist()]
            yield {
                "row": batch.column("row"),
                "lang_pred": [lang or "und" for lang, _ in out],
                "score": [score for _, score in out],
                "accepted": [lang is not None and score >= min_margin for lang, score in out]}
        return work

    return arrow_map(rows, f"row {kind}, lang_pred string, score double, accepted boolean", make)


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 4


def fit_documents(documents: DataFrame) -> dict[str, bytes]:
    """Dictionaries from the training folds of a documents table."""
    return fit(documents.filter(fold(F.col("doc_id")) != 2), F.col("doc_id"))


def language_id(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, accepted for every row of documents.
    A null doc_id counts as neither held out nor training."""
    dictionaries = fit_documents(documents)
    rows = documents.select("doc_id", "text", F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"))
    return identify(rows, dictionaries, ["doc_id", "held_out"]).select("row.*", "lang_pred", "score", "accepted")


def accepted_documents(documents: DataFrame) -> DataFrame:
    """The rows of documents (all their columns) that aren't rejected."""
    return identify(documents, fit_documents(documents), documents.columns).filter("accepted").select("row.*")
