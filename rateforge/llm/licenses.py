"""License scans: one Aho-Corasick automaton for notices, a shunting-yard parser for expressions.

Two passes over a whole text, both linear. Notices are found in the word
sequence (A-Z lowered, every other ASCII character a break): the words are
joined by single spaces and the automaton's patterns carry a space at both
ends, so a hit is a run of whole words. Identifier tags are found in the raw
text by the same automaton kind; the expression after a tag is split into ids,
AND, OR, WITH and parentheses, turned into postfix by precedence (WITH, AND,
OR) and evaluated.

Score: the strength of the best evidence, 0 (none) to 1 (a tag whose
expression parses into known licences). openness evaluates the expressions:
AND takes the lesser, OR the greater of its sides, WITH its licence; the least
over a document's findings, null without any.

Defined cases: a null or empty text has 0 words, empty label lists, null places
and score 0; a broken expression labels the known ids it names and counts as
weaker evidence; an expression ends with its line, comment or sentence, but
goes on over lines while a parenthesis is open, and commas part several; repeated rows and null ``doc_id``s are scanned like others;
extra columns are ignored; an empty table gives no rows; overlapping hits all
count.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Base notices: phrase and label.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Further notices of the method.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license version 2 0": "apache-2.0",
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl-3.0",
    "mozilla public license version 2 0": "mpl-2.0",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution 4 0 international": "cc-by-4.0",
    "all rights reserved": "all-rights-reserved",
}
#: Openness of a label, from no reuse (0) to free reuse (1).
OPENNESS = {
    "mit": 1.0, "apache-2": 1.0, "apache-2.0": 1.0, "bsd": 1.0, "bsd-2-clause": 1.0, "bsd-3-clause": 1.0,
    "isc": 1.0, "0bsd": 1.0, "unlicense": 1.0, "cc0-1.0": 1.0, "cc-by-4.0": 1.0, "zlib": 1.0,
    "mpl-2.0": 0.6, "lgpl": 0.6, "lgpl-2.1": 0.6, "lgpl-2.1-only": 0.6, "lgpl-2.1-or-later": 0.6,
    "lgpl-3.0": 0.6, "lgpl-3.0-only": 0.6, "lgpl-3.0-or-later": 0.6, "epl-2.0": 0.6, "cc-by-sa": 0.6, "cc-by-sa-4.0": 0.6,
    "gpl-2.0": 0.4, "gpl-2.0-only": 0.4, "gpl-2.0-or-later": 0.4, "gpl-3.0": 0.4, "gpl-3.0-only": 0.4,
    "gpl-3.0-or-later": 0.4, "agpl-3.0": 0.3, "agpl-3.0-only": 0.3, "agpl-3.0-or-later": 0.3,
    "apache-1.1": 1.0, "artistic-2.0": 1.0, "bsl-1.0": 1.0, "cc-by-3.0": 1.0, "mit-0": 1.0, "ms-pl": 1.0, "ncsa": 1.0,
    "ofl-1.1": 1.0, "postgresql": 1.0, "python-2.0": 1.0, "wtfpl": 1.0, "x11": 1.0,
    "cddl-1.0": 0.6, "cc-by-sa-3.0": 0.6, "epl-1.0": 0.6, "eupl-1.2": 0.6, "lgpl-2.0": 0.6, "lgpl-2.0-only": 0.6,
    "lgpl-2.0-or-later": 0.6, "mpl-1.1": 0.6, "ms-rl": 0.6, "odbl-1.0": 0.6,
    "cecill-2.1": 0.4, "gpl-1.0": 0.4, "gpl-1.0-only": 0.4, "gpl-1.0-or-later": 0.4, "osl-3.0": 0.4,
    "cc-by-nc-nd-4.0": 0.1, "cc-by-nc": 0.2, "cc-by-nc-4.0": 0.2, "cc-by-nc-sa-4.0": 0.2, "cc-by-nd-4.0": 0.1, "all-rights-reserved": 0.0,
}
TAGS = ("spdx-license-identifier:", "license-expression:")
TAG_SCORE, BROKEN_TAG_SCORE, BASE_SCORE, NOTICE_SCORE = 1.0, 0.5, 0.9, 0.7

_BREAKS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_TO_WORDS = bytes(_LOWER[b] if _BREAKS[b] != 32 else 32 for b in range(256))
_TOKEN = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.+\-]*|[^\sA-Za-z0-9()]")
#: What ends an expression: a line, a comment, or a sentence.
_STOP = re.compile(r"\n|\*/|-->|#|;|\.(?=\s|$)")
#: What a comment puts before the text of its next line.
_LEADER = re.compile(r"[ \t]*(?://+|\*(?!/)|#+|--(?!>)|;+|%+)?[ \t]*")
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}


class BrokenExpression(ValueError):
    pass


def to_postfix(tokens: list[str]) -> list[str]:
    """Shunting yard: operands and operators (or, and, with) of an expression in postfix order."""
    out, stack, operand_next = [], [], True
    for token in tokens:
        low = token.lower()
        if low in _PRECEDENCE:
            if operand_next:
                raise BrokenExpression(token)
            while stack and stack[-1] != "(" and _PRECEDENCE[stack[-1]] >= _PRECEDENCE[low]:
                out.append(stack.pop())
            stack.append(low)
            operand_next = True
        elif token == "(":
            if not operand_next:
                raise BrokenExpression(token)
            stack.append(token)
        elif token == ")":
            if operand_next:
                raise BrokenExpression(token)
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                raise BrokenExpression(token)
            stack.pop()
        else:
            if not operand_next or not token[0].isalnum():
                raise BrokenExpression(token)
            out.append(low)
            operand_next = False
    if operand_next or "(" in stack:
        raise BrokenExpression("end")
    return out + stack[::-1]


def evaluate(expression: str) -> tuple[set[str], float]:
    """(licence ids, openness) of an expression; unknown ids have openness 0."""
    stack: list[tuple[set[str], float, bool]] = []  # ids, openness, is a single id
    for item in to_postfix(_TOKEN.findall(expression)):
        if item not in _PRECEDENCE:
            stack.append(({item}, OPENNESS.get(item.removesuffix("+"), 0.0), True))
            continue
        (right, r_open, r_single), (left, l_open, l_single) = stack.pop(), stack.pop()
        if item == "with":
            if not (r_single and l_single):
                raise BrokenExpression("with")
            stack.append(({f"{min(left)} with {min(right)}"}, l_open, False))
        else:
            few, many = sorted((left, right), key=len)
            many |= few  # in place, so that a long expression costs no copies
            stack.append((many, min(l_open, r_open) if item == "and" else max(l_open, r_open), False))
    ids, openness, _ = stack.pop()
    return ids, openness


@lru_cache(maxsize=1)
def _automata() -> tuple[ahocorasick.Automaton, ahocorasick.Automaton]:
    notices, tags = ahocorasick.Automaton(), ahocorasick.Automaton()
    for base, phrases in ((False, NOTICES), (True, BASE)):
        for phrase, label in phrases.items():
            notices.add_word(f" {phrase} ", (len(phrase) + 2, label, base))
    for tag in TAGS:
        tags.add_word(tag, tag)
    notices.make_automaton()
    tags.make_automaton()
    return notices, tags


def _end_of_expression(raw: str, start: int) -> int:
    """Where the expression at ``start`` stops; inside open parentheses it goes on over line ends."""
    at, depth = start, 0
    while True:
        found = _STOP.search(raw, at)
        if not found:
            return len(raw)
        depth += raw.count("(", at, found.start()) - raw.count(")", at, found.start())
        if found.group() != "\n" or depth <= 0:
            return found.start()
        at = _LEADER.match(raw, found.end()).end()


def _expressions(raw: str, ends: Iterator[int]) -> Iterator[str]:
    """The expressions that the tags of a text give.

    The first tag tells where its run stops; tags up to there belong to it. A
    run is parted at its commas. Each part is read from its beginning and from
    each tag in it: the text before a tag is broken, as it holds that tag, and
    names all that the texts of later tags but the last name, so the first and
    the last are enough, which keeps a line of many tags linear.
    """
    run: list[int] = []
    stop = -1

    def texts() -> Iterator[str]:
        tags, begin = run, run[0]
        k = 0
        while begin <= stop:
            comma = raw.find(",", begin, stop)
            end = comma if comma >= 0 else stop
            starts = [begin]
            while k < len(tags) and tags[k] <= end:
                starts.append(tags[k])
                k += 1
            for at in sorted({starts[0], starts[-1]}):
                lines = raw[at:end].split("\n")
                joined = " ".join([lines[0], *(x[_LEADER.match(x).end() :] for x in lines[1:])])
                if joined.strip():
                    yield joined
            begin = end + 1

    for end in ends:
        if end + 1 > stop:
            if run:
                yield from texts()
            run, stop = [], _end_of_expression(raw, end + 1)
        run.append(end + 1)
    if run:
        yield from texts()


def scan(text: str | None) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score, openness) of a whole text."""
    raw = text or ""
    notices, tags = _automata()
    words = raw.encode().translate(_TO_WORDS).split()
    base, found, places = set(), set(), []
    score, openness = 0.0, []
    joined = " " + b" ".join(words).decode() + " "
    starts = None
    for end, (length, label, is_base) in notices.iter(joined):
        found.add(label)
        openness.append(OPENNESS[label])
        score = max(score, BASE_SCORE if is_base else NOTICE_SCORE)
        if is_base:
            if starts is None:  # each word's place in the joined string, behind the leading space
                starts = np.cumsum([1] + [len(w.decode()) + 1 for w in words]).tolist()
            base.add(label)
            places.append(bisect_left(starts, end - length + 2))
    lowered = raw.encode().translate(_LOWER).decode()  # A-Z only: places stay those of the raw text
    for expression in _expressions(raw, (end for end, _ in tags.iter(lowered))):
        try:
            ids, value = evaluate(expression)
            known = all(i.split(" ")[0].removesuffix("+") in OPENNESS for i in ids)
            found |= {i.replace(",", "") for i in ids}
            score = max(score, TAG_SCORE if known else BROKEN_TAG_SCORE)
            openness.append(value)
        except BrokenExpression:
            named = {t.lower() for t in _TOKEN.findall(expression)} & OPENNESS.keys()
            found |= named
            score = max(score, BROKEN_TAG_SCORE if named else 0.0)
            openness += [OPENNESS[t] for t in named]
    return (
        len(words),
        len(places),
        min(places, default=None),
        max(places, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(found)),
        score,
        min(openness, default=None),
    )


_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
     ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
     ("openness", pa.float64())]
)


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [scan(t) for t in batch.column(1).to_pylist()]
        columns = list(zip(*rows)) if rows else [[] for _ in range(8)]
        arrays = [pa.array(c, type=f.type) for c, f in zip(columns, list(_SCHEMA)[1:])]
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *arrays], schema=_SCHEMA)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per document: n_words, n_base, first_word, last_word, base_labels, labels, score, openness."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        _scan_batches,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, openness double",
    )
