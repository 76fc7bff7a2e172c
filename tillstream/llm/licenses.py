"""Licence scan: Aho-Corasick over words, and licence expressions evaluated by a shunting-yard parser."""

from __future__ import annotations

import re
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame

from tillstream.llm.batches import slices, text_bytes

# Fixed phrases of the base scan.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Further notices.
NOTICES = {
    "all rights reserved": "all-rights-reserved",
    "apache license version 2 0": "apache-2.0",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "cc0": "cc0",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "eclipse public license": "epl",
    "gnu affero general public license": "agpl",
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu lesser general public license": "lgpl",
    "isc license": "isc",
    "mozilla public license": "mpl",
    "permission is hereby granted free of charge": "mit",
    "released into the public domain": "public-domain",
    "unlicense": "unlicense",
}
TAGS = ("spdx license identifier", "packagelicensedeclared", "packagelicenseconcluded")
# Licence identifiers whose terms allow reuse without conditions on other works, and exceptions that lift such conditions.
PERMISSIVE = {
    "0bsd", "apache-1.1", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "bsl-1.0", "cc-by-3.0", "cc-by-4.0", "cc0-1.0", "isc",
    "mit", "mit-0", "postgresql", "python-2.0", "unlicense", "upl-1.0", "zlib",
}
LIFTING = {"classpath-exception-2.0", "gcc-exception-3.1", "llvm-exception", "linux-syscall-note", "font-exception-2.0"}
BINDING = {"OR": 1, "AND": 2, "WITH": 3}
# How far one kind of evidence proves that a licence applies.
CERTAIN, NOTICE, MENTION = 0.95, 0.8, 0.6
# Bytes of words: digits, a-z and all of other scripts; A-Z become a-z, every other byte becomes a space.
FOLD = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
TOKEN = re.compile(r"[()]|[^\s()]+")
LINE = re.compile(rb"[^\r\n]*")
FIRST_READ = 2000  # bytes of a line that are looked at first; more if the expression goes on
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
SCHEMA = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
    "score double, expressions string, permissive boolean"
)


def parsed(tokens: list[str]) -> tuple[list[str], int, str, int]:
    """The longest expression that the tokens begin with, in postfix order, and the number of its tokens (0 if there is none).

    Also why no more was taken ("" if all was), and at which token that was found: what comes after it has no part in this.
    """
    out, stack, operand, depth = [], [], False, 0
    used = 0
    complete: tuple[int, list] = (0, [])  # of the last place without anything open: how much was out, and the stack

    def result(why: str, at: int):
        return out[: complete[0]] + complete[1][::-1], used, why, at

    for at, token in enumerate(tokens):
        upper = token.upper()
        if upper in BINDING:
            if not operand:
                return result(f"operator {token} without a left side", at)
            while stack and stack[-1] != "(" and BINDING[stack[-1]] >= BINDING[upper]:
                out.append(stack.pop())
            stack.append(upper)
            operand = False
        elif token == "(":
            if operand:
                return result("parenthesis after an identifier", at)
            stack.append(token)
            depth += 1
        elif token == ")":
            if not operand:
                return result("empty parentheses", at)
            if not depth:
                return result("parenthesis that was not opened", at)
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
            depth -= 1
        elif re.fullmatch(r"[A-Za-z0-9.+:-]*[A-Za-z0-9+]", token):
            if operand:
                return result("two identifiers without an operator", at)
            out.append(token.lower())
            operand = True
        else:
            return result(f"no identifier: {token}", at)
        if operand and not depth:
            complete, used = (len(out), list(stack)), at + 1
    return result("" if tokens and used == len(tokens) else "the expression is not complete", len(tokens))


def postfix(expression: str) -> list[str]:
    """The expression's identifiers and operators in postfix order; ValueError if it is not an expression."""
    parts, _, why, _ = parsed(TOKEN.findall(expression))
    if why:
        raise ValueError(why)
    return parts


def permissive(parts: list[str]) -> bool:
    """Whether the licensee can choose terms that are permissive throughout. ``parts``: from ``postfix``."""
    stack = []
    for part in parts:
        if part in BINDING:
            right, left = stack.pop(), stack.pop()
            if part == "OR":
                stack.append((left[0] or right[0], ""))
            elif part == "AND":
                stack.append((left[0] and right[0], ""))
            else:
                stack.append((left[0] or right[1] in LIFTING, ""))
        else:
            stack.append((part in PERMISSIVE, part))
    return stack[0][0]


def expression_after(raw: bytes, place: int) -> list[str]:
    """The longest expression at the start of the line's rest from byte ``place``, in postfix order; else nothing.

    The line is read as far as the expression reaches: twice as much each time that its end may lie beyond what was read.
    """
    size = FIRST_READ
    while True:
        line = LINE.match(raw, place, place + size)[0]
        tokens = TOKEN.findall(line.decode("utf8", "ignore").lstrip(" \t:=\"'"))
        tokens = [t for t in (t if t in "()" else t.rstrip(".,;\"'*/-") for t in tokens) if t]
        parts, _, why, at = parsed(tokens)
        whole = len(line) < size or place + size >= len(raw)
        if whole or (why and at < len(tokens) - 1):  # the last token may be cut
            return parts
        size *= 2


@cache
def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    phrases: dict[str, list] = {}
    for kind, table in (("base", BASE), ("notice", NOTICES), ("tag", dict.fromkeys(TAGS, ""))):
        for phrase, label in table.items():
            phrases.setdefault(phrase, []).append((kind, label))
    for phrase, uses in phrases.items():
        found.add_word(f" {phrase} ", (len(phrase) + 2, uses))
    found.make_automaton()
    return found


def scan(raw: bytes) -> tuple:
    """One text's row of ``SCHEMA``."""
    words = raw.translate(FOLD).split()
    if not words:
        return 0, 0, None, None, "", "", 0.0, "", None
    line = (b" " + b" ".join(words) + b" ").decode("latin-1")
    places, base, labels, doubt, expressions, allowed = [], set(), set(), {}, [], []
    at = word = 0  # the spaces are counted on from the last place
    stops: list[int] = []
    for end, (length, uses) in automaton().iter(line):
        begin = end - length + 1
        word += line.count(" ", at, begin) if begin >= at else -line.count(" ", begin, at)
        at = begin
        for kind, label in uses:
            if kind == "base":
                places.append(word)
                base.add(label)
                doubt[label] = min(doubt.get(label, 1), 1 - MENTION)
            elif kind == "notice":
                labels.add(label)
                doubt[label] = min(doubt.get(label, 1), 1 - NOTICE)
            else:
                last = word + line.count(" ", begin + 1, end)
                stops = stops or [m.end() for m in WORD.finditer(raw)]
                parts = expression_after(raw, stops[last])
                if parts:
                    names = {p for p in parts if p not in BINDING}
                    labels |= names
                    doubt |= dict.fromkeys(names, 1 - CERTAIN)
                    expressions.append(" ".join(parts))
                    allowed.append(permissive(parts))
    sure = 1.0
    for share in doubt.values():
        sure *= share
    return (
        len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
        ",".join(sorted(base | labels)), 1 - sure, ";".join(expressions), all(allowed) if allowed else None,
    )


def license_scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Adds to the ``keep`` columns what the scan finds in each whole text.

    Words are runs of digits, letters a-z (A-Z are folded) and non-ASCII characters. ``n_base`` counts all places of the
    base phrases, overlapping ones too; ``first_word`` and ``last_word`` are the least and the greatest start, null without
    one. ``labels`` holds the base labels, those of further notices and the identifiers of tagged expressions, which
    stand in postfix order in ``expressions``; ``permissive`` tells whether all of them can be met by permissive terms
    (null without any). ``score`` is the probability that a licence applies, were the pieces of evidence independent;
    0 without any. A null text counts as empty. Each row stands for itself: repeated rows give repeated results.
    """
    schema = docs.select(*keep).schema
    for field in _fields():
        schema = schema.add(field)

    def run(batches):
        arrow = None
        for whole in batches:
            for batch in slices(whole, "__text"):
                data, bounds = text_bytes(batch.column("__text"))
                data = data.tobytes()
                found = [scan(data[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                arrow = arrow or [
                    pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.string(), pa.bool_(),
                ]
                columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), arrow, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=schema.names)

    return docs.select(*keep, docs[text].alias("__text")).mapInArrow(run, schema)


def _fields():
    from pyspark.sql.types import StructType

    return StructType.fromDDL(SCHEMA).fields
