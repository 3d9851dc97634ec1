"""Personal data: regular expressions propose spans, checks confirm them, and
words nearby adjust the score.

Four kinds are taken by pattern and check alone (``email``, ``ip``, ``card``,
``phone``): their spans always stay, and the context only moves their score.
Looser patterns propose more kinds (``iban`` with the mod-97 check, ``card13``
with Luhn, ``ssn``, ``phone_local``), which stay when check and context together
reach ``THRESHOLD`` and no span of the first four overlaps them.

Offsets are code points, end exclusive; matches are leftmost and don't overlap
within a kind; a match that fails its check is dropped without another try.
Scans are linear in the text, also for very long runs of one character.

Defined results: null and empty texts have no spans. Repeated rows each give
their own row. An empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame

from roadrisk.llm.common import arrow_map

BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("iban", "card13", "ssn", "phone_local")
RANK = {k: i for i, k in enumerate(BASE_KINDS + MORE_KINDS)}
THRESHOLD = 0.6
AROUND = 48          # characters before and after a span that are searched for context words

START_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "card13": 0.4, "ssn": 0.4, "phone_local": 0.4}
CONTEXT = {
    "email": r"e-?mail|mail|contact|contacto|kontakt|courriel|correo",
    "ip": r"ip|address|host|server|adresse|dirección",
    "card": r"card|credit|debit|visa|mastercard|amex|payment|karte|carte|tarjeta",
    "phone": r"phone|tel|telephone|call|mobile|cell|fax|telefon|téléphone|teléfono",
    "iban": r"iban|account|bank|konto|compte|cuenta",
    "ssn": r"ssn|social|security",
}
CONTEXT |= {"card13": CONTEXT["card"], "phone_local": CONTEXT["phone"]}
AGAINST = re.compile(r"\b(?:version|release|isbn|order|invoice|section|example)\b", re.I)
CONTEXT_RE = {k: re.compile(rf"\b(?:{v})\b", re.I) for k, v in CONTEXT.items()}

EMAIL_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
EMAIL_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)++")
NUMBER = re.compile(r"[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
PHONE_LOCAL = re.compile(r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9.-]?[0-9])")


def luhn(digits: str) -> bool:
    twice = [2 * int(d) - 9 * (d > "4") for d in digits[-2::-2]]
    return (sum(twice) + sum(map(int, digits[::-2]))) % 10 == 0


def mod97(iban: str) -> bool:
    s = iban.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str):
    """Every '@' with a domain after it, extended left over the local part as far
    as the match before it. (Searching from each possible start is quadratic.)"""
    end = at = 0
    while (at := text.find("@", at)) >= 0:
        m = EMAIL_DOMAIN.match(text, at)
        start = at
        while start > end and text[start - 1] in EMAIL_LOCAL:
            start -= 1
        if m and start < at:
            end = m.end()
            yield start, end
            at = end
        else:
            end = max(end, at + 1)  # nothing left of this '@' belongs to a later address
            at += 1


def ips(text: str):
    for run in DOTTED.finditer(text):
        parts = [(m.start(), m.end()) for m in NUMBER.finditer(text, run.start(), run.end())]
        for i in range(0, len(parts) - 3, 4):
            if all(len(p := text[a:b].lstrip("0")) <= 3 and int(p or 0) <= 255 for a, b in parts[i:i + 4]):
                yield parts[i][0], parts[i + 3][1]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(a, b, "email") for a, b in emails(text)] if "@" in text else []
    first = NUMBER.search(text)
    if first:
        found += [(a, b, "ip") for a, b in ips(text)]
        for m in CARD.finditer(text, first.start()):
            if m.end() - m.start() >= 14 and 14 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
                found.append((m.start(), m.end(), "card"))
        if "+" in text:
            found += [(m.start(), m.end(), "phone") for m in PHONE.finditer(text) if 10 <= len(digits_of(m[0])) <= 15]
    return sorted(found, key=lambda s: (s[0], RANK[s[2]]))


def proposals(text: str):
    """Spans of the looser kinds that pass their checks."""
    if not NUMBER.search(text):
        return
    for m in IBAN.finditer(text):
        if mod97(m[0]):
            yield m.start(), m.end(), "iban"
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and len(d := digits_of(m[0])) == 13 and luhn(d):
            yield m.start(), m.end(), "card13"
    yield from ((m.start(), m.end(), "ssn") for m in SSN.finditer(text))
    yield from ((m.start(), m.end(), "phone_local") for m in PHONE_LOCAL.finditer(text))


def score(text: str, span: tuple[int, int, str]) -> float:
    a, b, kind = span
    near = text[max(0, a - AROUND):a] + " | " + text[b:b + AROUND]
    s = START_SCORE[kind] + 0.3 * bool(CONTEXT_RE[kind].search(near)) - 0.3 * bool(AGAINST.search(near))
    return round(min(1.0, max(0.0, s)), 2)


def find(text: str | None) -> list[tuple[int, int, str, float, bool]]:
    """(start, end, kind, score, base) by start, then kind."""
    text = text or ""
    base = base_spans(text)
    out = [(*s, score(text, s), True) for s in base]
    taken, at = sorted((a, b) for a, b, _ in base), 0
    for s in sorted(proposals(text)):
        while at < len(taken) and taken[at][1] <= s[0]:
            at += 1
        overlaps = any(a < s[1] and s[0] < b for a, b in taken[max(0, at - 4):at + 4])
        if not overlaps and (p := score(text, s)) >= THRESHOLD:
            out.append((*s, p, False))
    return sorted(out, key=lambda s: (s[0], RANK[s[2]]))


def joined(spans) -> str:
    return ",".join(f"{s[2]}:{s[0]}:{s[1]}" for s in spans)


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, the number of spans of each base kind, base_sha256, spans, scores and n_more for every row."""
    def make():
        def work(batch):
            found = [find(t) for t in batch.column("text").to_pylist()]
            yield {"doc_id": batch.column("doc_id")} | {
                f"n_{k}": [sum(s[2] == k for s in f) for f in found] for k in BASE_KINDS} | {
                "base_sha256": [hashlib.sha256(joined(s for s in f if s[4]).encode()).hexdigest() for f in found],
                "spans": [joined(f) for f in found],
                "scores": [",".join(f"{s[3]:.2f}" for s in f) for f in found],
                "n_more": [sum(not s[4] for s in f) for f in found]}
        return work

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", "text"), f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, "
                     "base_sha256 string, spans string, scores string, n_more long", make)


def redact(docs: DataFrame) -> DataFrame:
    """doc_id and text, every span replaced by its kind in angle brackets; of
    overlapping spans the first one names the replacement. Null stays null."""
    def clean(text: str | None) -> str | None:
        if text is None:
            return None
        out, at = [], 0
        for a, b, kind, _, _ in find(text):
            if a >= at:
                out += [text[at:a], f"<{kind}>"]
            at = max(at, b)
        return "".join([*out, text[at:]])

    def make():
        return lambda batch: [{"doc_id": batch.column("doc_id"), "text": [clean(t) for t in batch.column("text").to_pylist()]}]

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", "text"), f"doc_id {kind}, text string", make)
