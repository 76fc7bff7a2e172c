"""Personal data: detectors over the text as it stands, and over a text without disguises whose spans are mapped back."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType

from tillstream.llm.batches import slices

KINDS = ("email", "ip", "card", "phone")
# Patterns of the base detectors. Fixed values.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Letters of other scripts that look like Latin ones. Fixed values.
LOOKALIKES = dict(
    zip(
        "АВЕКМНОРСТУХавекмнорстухѕіјԁһԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧαιορυνκ",
        "ABEKMHOPCTYXaBekMHopcTyxsijdhqwABEZHIKMNOPTYXaiopuvk",
        strict=True,
    )
)
# Characters without width, and marks that stand for @ and the full stop.
INVISIBLE = "­​‌‍⁠﻿"
AT_SIGNS = "＠﹫"
STOPS = "。．｡․·∙"
SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8",
    "nine": "9", "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8",
    "neun": "9", "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
LEAST_SPELLED = 4  # digit words in a row that are taken for a number


def _words(names) -> str:
    return "|".join(sorted(names, key=len, reverse=True))


DIGIT_WORD = rf"(?:{_words(SPELLED)})"
DIGITS_SPELLED = re.compile(rf"(?i)\b(?=[zeondtfsuvcqh]){DIGIT_WORD}(?:[ ,.\t-]{{1,3}}{DIGIT_WORD}){{{LEAST_SPELLED - 1},}}\b")
ONE_DIGIT = re.compile(rf"(?i){DIGIT_WORD}")
PLUS_WORD = re.compile(rf"(?i)\bplus[ -]{{1,3}}(?=[0-9]|{DIGIT_WORD}\b)")
# at and dot in brackets or bare. A bare one counts only inside a chain "name at name dot name", or "name at name.name" if
# that does not read like a web site (see ``plain_site``).
OPEN, CLOSE = r"[(\[{<][ \t]{0,2}", r"[ \t]{0,2}[)\]}>]"
BRACKETED = {"@": rf"{OPEN}(?:at|@|arroba|ät){CLOSE}", ".": rf"{OPEN}(?:dot|\.|punkt|point|punto){CLOSE}"}
BRACKETED = {new: (re.compile(rf"(?i){core}"), re.compile(rf"(?i)[ \t]{{0,3}}{core}[ \t]{{0,3}}")) for new, core in BRACKETED.items()}
LABEL = r"[A-Za-z0-9_%+-]{1,64}"
CHAIN = re.compile(
    rf"(?i)(?<![A-Za-z0-9._%+-]){LABEL}(?:(?:\.|[ \t]{{1,3}}dot[ \t]{{1,3}}){LABEL}){{0,5}}"
    rf"(?P<at>[ \t]{{0,3}}@[ \t]{{0,3}}|[ \t]{{1,3}}at[ \t]{{1,3}})"
    rf"[A-Za-z0-9-]{{1,63}}(?:(?:\.|[ \t]{{1,3}}dot[ \t]{{1,3}})[A-Za-z0-9-]{{1,63}}){{1,6}}"
)
DOTTED_NUMBER = re.compile(r"(?i)(?<![0-9.])[0-9]{1,3}(?:(?:\.|[ \t]{1,3}dot[ \t]{1,3})[0-9]{1,3}){3}(?![0-9])")
DOT_WORD = re.compile(r"(?i)[ \t]{1,3}dot[ \t]{1,3}")
# What every match of CHAIN holds, and what every match of DOTTED_NUMBER holds that has a dot word: quicker to look for.
AT_PLACE = re.compile(r"(?i)(?:@|[ \t]at[ \t])[ \t]{0,3}[A-Za-z0-9-]{1,63}(?:\.|[ \t]{1,3}dot[ \t]{1,3})[A-Za-z0-9-]")
NUMBER_PLACE = re.compile(r"(?i)[0-9][ \t]{1,3}dot[ \t]{1,3}[0-9]")
# Words that stand before "at" and the name of a site; none of them is a usual name of a mailbox. Fixed values.
BEFORE_SITES = frozenset(
    "a an and or but not is are was were be been being am it its this that these those here there where who what which he she "
    "they we you i us me him her them ours mine now then just only also even still again more most much all both each back up "
    "out over down in on off away together online live lives living lived located available hosted look looks looked looking "
    "see sees saw seen visit visits visited visiting read reads reading find finds finding found get gets got buy buys bought "
    "sell sells sold book booked order ordered start starts started end ends ended stop stops stopped arrive arrives arrived "
    "meet meets met stay stays stayed work works worked working published posted listed described documented registered "
    "register sign signed login log logged download downloads downloaded click check checked shown shows view viewed viewing "
    "apply join joined subscribe subscribed browse browsing shop shopping go goes going went come comes came".split()
)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d)
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches that do not overlap: the run of name characters before an @, and a domain after it."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        after = at + 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            out.append((start, domain.end()))
            after = last = domain.end()
        else:
            last = max(last, at + 1)
        at = text.find("@", after)
    return out


def detect(text: str) -> list[tuple[int, int, int]]:
    """Base spans as (start, rank of the kind, end), in order."""
    found = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(map(str.isdigit, m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


class Mapped:
    """A text and, for each of its characters, the span of source characters that it stands for."""

    def __init__(self, text: str):
        self.text, self.start, self.end = text, np.arange(len(text)), np.arange(1, len(text) + 1)

    def rewrite(self, changes: list[tuple[int, int, str]]) -> None:
        """Puts another text in place of each (start, end); the changes are in order and do not overlap."""
        if not changes:
            return
        texts, starts, ends, at = [], [], [], 0
        for a, b, new in changes:
            texts += [self.text[at:a], new]
            starts += [self.start[at:a], np.full(len(new), self.start[a] if a < b else 0)]
            ends += [self.end[at:a], np.full(len(new), self.end[b - 1] if a < b else 0)]
            at = b
        self.text = "".join([*texts, self.text[at:]])
        self.start = np.concatenate([*starts, self.start[at:]])
        self.end = np.concatenate([*ends, self.end[at:]])

    def source(self, a: int, b: int) -> tuple[int, int]:
        return int(self.start[a]), int(self.end[b - 1])


@cache
def plain_character(char: str) -> str:
    """The ASCII character that a look-alike stands for; nothing for one without width; else the character itself."""
    if char in INVISIBLE:
        return ""
    if char in AT_SIGNS:
        return "@"
    if char in STOPS:
        return "."
    if char in LOOKALIKES:
        return LOOKALIKES[char]
    if (digit := unicodedata.digit(char, None)) is not None and char.isdecimal():
        return str(digit)
    wide = unicodedata.normalize("NFKC", char)
    return wide if len(wide) == 1 and wide.isascii() and wide.isprintable() else char


def digit_of(word: str) -> str:
    """The digit that a word matched by DIGIT_WORD spells; matching without case also takes these three for i and s."""
    return SPELLED[re.sub("[ıİ]", "i", word).replace("ſ", "s").lower()]


def plain_site(text: str, m: re.Match) -> bool:
    """Whether a match of CHAIN with a bare "at" and without any disguise speaks of a web site, a number or a sentence's end."""
    before = re.split(r"\.", text[m.start() : m.start("at")])[-1].lower()
    labels = text[m.end("at") : m.end()].split(".")
    last = labels[-1]
    return (
        before in BEFORE_SITES
        or (m.start() > 0 and text[m.start() - 1] in "'’")
        or labels[0].lower() == "www"
        or not (len(last) >= 2 and last.isalpha() and (last.islower() or last.isupper()))
        or re.match(r"/|:[0-9]", text[m.end() : m.end() + 2]) is not None
    )


def normalise(text: str) -> Mapped | None:
    """The text without disguises, or None if there is none in it. Each transducer looks for its own passages in every text."""
    out = Mapped(text)
    if not text.isascii():
        plain = {c: new for c in set(text) if c > "\x7f" and (new := plain_character(c)) != c}
        if plain:
            out.rewrite([(m.start(), m.end(), plain[m[0]]) for m in re.finditer(f"[{''.join(map(re.escape, plain))}]", text)])
    changes = []
    for m in DIGITS_SPELLED.finditer(out.text):
        at = m.start()
        for word in ONE_DIGIT.finditer(out.text, m.start(), m.end()):
            if changes and at > m.start():
                changes.append((at, word.start(), ""))
            changes.append((word.start(), word.end(), digit_of(word[0])))
            at = word.end()
    out.rewrite([c for c in changes if c[0] < c[1]])
    out.rewrite([(m.start(), m.end(), "+") for m in PLUS_WORD.finditer(out.text)])
    for new, (core, pattern) in BRACKETED.items():
        if core.search(out.text):
            out.rewrite([(m.start(), m.end(), new) for m in pattern.finditer(out.text)])
    changes = []
    for m in CHAIN.finditer(out.text) if AT_PLACE.search(out.text) else ():
        a, b = m.span("at")
        first, last = out.source(m.start(), m.end())
        if "@" not in m["at"] and not DOT_WORD.search(m[0]) and text[first:last] == m[0] and plain_site(out.text, m):
            continue
        changes += [(d.start(), d.end(), ".") for d in DOT_WORD.finditer(out.text, m.start(), a)]
        changes.append((a, b, "@"))
        changes += [(d.start(), d.end(), ".") for d in DOT_WORD.finditer(out.text, b, m.end())]
    out.rewrite([c for c in changes if out.text[c[0] : c[1]] != c[2]])
    numbers = DOTTED_NUMBER.finditer(out.text) if NUMBER_PLACE.search(out.text) else ()
    out.rewrite([(d.start(), d.end(), ".") for m in numbers for d in DOT_WORD.finditer(out.text, *m.span())])
    return out if out.text != text else None


def spans(text: str) -> tuple[list, list]:
    """Base spans, and those with the spans added that show only without the disguises.

    A span of the normalised text is added if some of it was disguised, and each base span of its kind that its source
    overlaps is a part of it.
    """
    base = detect(text)
    mapped = normalise(text)
    if mapped is None:
        return base, base
    every = list(base)
    for a, kind, b in detect(mapped.text):
        start, end = mapped.source(a, b)
        near = [(s, e) for s, k, e in base if k == kind and s < end and start < e]
        if text[start:end] != mapped.text[a:b] and all(start <= s and e <= end for s, e in near):
            every.append((start, kind, end))
    return base, sorted(set(every))


def masked(text: str, found: list) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become one, named by the first."""
    out, at = [], 0
    for start, kind, end in found:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def shown(found: list) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def find(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), mask: bool = False) -> DataFrame:
    """Adds what is found in each whole text to the ``keep`` columns.

    ``n_email``, ``n_ip``, ``n_card``, ``n_phone`` and ``base_sha256`` are of the base spans, ``spans`` lists all of them
    as kind:start:end, in code points. With ``mask`` a column ``masked`` has the text with all spans replaced (null stays
    null). A null text counts as empty. Each row stands for itself: repeated rows give repeated results.
    """
    schema = docs.select(*keep).schema
    for kind in KINDS:
        schema = schema.add(f"n_{kind}", LongType())
    schema = schema.add("base_sha256", StringType()).add("spans", StringType())
    if mask:
        schema = schema.add("masked", StringType())

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "__text"):
                texts = batch.column("__text").to_pylist()
                both = [spans(t or "") for t in texts]
                columns = [pa.array([sum(s[1] == k for s in base) for base, _ in both], pa.int64()) for k in range(len(KINDS))]
                columns.append(pa.array([hashlib.sha256(shown(base).encode()).hexdigest() for base, _ in both], pa.string()))
                columns.append(pa.array([shown(every) for _, every in both], pa.string()))
                if mask:
                    columns.append(pa.array([t and masked(t, every) for t, (_, every) in zip(texts, both, strict=True)], pa.string()))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=schema.names)

    return docs.select(*keep, docs[text].alias("__text")).mapInArrow(run, schema)
