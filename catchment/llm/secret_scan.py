"""Secrets in texts: fixed patterns, and literals that reach a sensitive name through assignments.

A lexer reads name-literal pairs of source code and configuration (`name = "x"`, `name: x`, `"name": "x"`, `name => x`,
`name: type = "x"`, `name = other = "x"`).
A literal joined with + or standing behind another name (`key = base`) is followed to where it was written. A literal is
reported when the names it reaches and its own looks score high enough, whatever its length. A name stands for what was
last assigned to it.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchment.llm.common import whole_text

KINDS = ("assign", "access", "hex", "named")
#: The fixed patterns. Runs of hexadecimal digits are maximal, so the shorter ones need not be matched first.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")

_QUOTED = r""""(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'"""
_BARE = r"""[^\s"',;(){}\[\]]+"""
_LITERAL = rf"{_QUOTED}|{_BARE}"
_PAIR = re.compile(rf"""(?P<quote>["']?)\b(?P<name>[A-Za-z_][\w.-]*)(?P=quote)[ \t]*(?P<sign>=>|:=|(?<![=!<>])=(?!=)|:(?!//))[ \t]*(?={_QUOTED}|(?P<bare>[^\s"',;(){{}}\[\]]))""", re.ASCII)
_VALUE = re.compile(_QUOTED, re.ASCII)
_RUN = re.compile(_BARE, re.ASCII)
#: A type between a name and its value, up to its brackets: str, "Secret", typing.Final, readonly string, &'static str.
_TERM = re.compile(rf"""(?:(?:readonly|const|final|static|unsigned)[ \t]+)*+[&*?]*+(?:'[A-Za-z_]\w*[ \t]+)?(?:mut[ \t]+)?(?:[A-Za-z_]\w*+(?:(?:\.|::)[A-Za-z_]\w*+)*+|{_QUOTED}|(?=[<\[]))""", re.ASCII)
TYPES = ("str", "string", "bytes", "bytearray", "char", "any", "object", "none", "null")
_BRACKET = re.compile(r"[-=]>|[<>\[\]\n]")
_BETWEEN = re.compile(r"[?!]?[ \t]*[|&][ \t]*", re.ASCII)
_SET = re.compile(rf"""(?P<loose>[?!]?[ \t]+|[?!])?=(?![=>~])[ \t]*(?={_QUOTED}|(?P<bare>[^\s"',;(){{}}\[\]]))""", re.ASCII)
_SIGN = re.compile("[=:]")
_INNER = re.compile(r"[A-Za-z_][\w.-]*+", re.ASCII)
_MORE = re.compile(rf"[ \t]*\+[ \t]*({_LITERAL})", re.ASCII)
_NAME = re.compile(r"[A-Za-z_][\w.]*\Z", re.ASCII)
#: How telling a name is; the parts of a name are told apart by case, digits and signs.
STEMS = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "token": 0.9, "credential": 0.9, "credentials": 0.9,
    "apikey": 1.0, "accesskey": 1.0, "privatekey": 1.0, "auth": 0.7, "bearer": 0.8, "signature": 0.6, "key": 0.5, "salt": 0.5,
}
PLACEHOLDERS = ("example", "changeme", "change-me", "placeholder", "your", "dummy", "none", "null", "true", "false", "xxxx", "****", "todo")
THRESHOLD = 0.55
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
#: Texts without any of these hold no name of a sensitivity above 0: parts of a name that are joined have only signs between them.
_HINT = re.compile("|".join("[_.-]*".join(stem) for stem in STEMS), re.IGNORECASE | re.ASCII)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, leftmost and without overlaps for each kind."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def sensitivity(name: str) -> float:
    parts = [part.lower() for part in _PARTS.findall(name)]
    joined = [a + b for a, b in zip(parts, parts[1:], strict=False)]
    return max((STEMS.get(part, 0.0) for part in [*parts, *joined]), default=0.0)


class Value:
    """What a name holds: a literal of the text, or values joined. Its text is never built, whatever its length."""

    __slots__ = ("place", "terms", "profile")

    def __init__(self, place: tuple[int, int] | None = None, terms: tuple[Value, ...] = ()) -> None:
        self.place, self.terms = place, terms
        self.profile: Profile | None = None


class Profile(NamedTuple):
    """What the score of a text is made of; `head` and `tail` are as long as a placeholder that stands across a join."""

    size: int
    counts: Counter[str]
    head: str
    tail: str
    refused: bool


_EDGE = max(map(len, PLACEHOLDERS)) - 1


def refused(literal: str) -> bool:
    return " " in literal or any(word in literal.lower() for word in PLACEHOLDERS)


def profile_of(literal: str) -> Profile:
    return Profile(len(literal), Counter(literal), literal[:_EDGE], literal[-_EDGE:], refused(literal))


def joined_profile(one: Profile, other: Profile) -> Profile:
    """The profile of both texts, one after the other."""
    across = one.refused or other.refused or refused(one.tail + other.head)
    return Profile(one.size + other.size, one.counts + other.counts, (one.head + other.head)[:_EDGE], (one.tail + other.tail)[-_EDGE:], across)


def profile(value: Value, text: str) -> Profile:
    """The profile of a value, worked out once for each value that it is made of."""
    waiting = [value]
    while waiting:
        top = waiting[-1]
        if missing := [term for term in top.terms if term.profile is None]:
            waiting += missing
            continue
        waiting.pop()
        if top.profile is None:
            start, end = top.place or (0, 0)
            top.profile = reduce(joined_profile, (term.profile for term in top.terms)) if top.terms else profile_of(text[start:end])
    return value.profile


def looks(its: Profile) -> float:
    """From 0 to 1: long, varied literals of mixed characters look like secrets, words and placeholders don't."""
    if its.size < 8 or its.refused:
        return 0.0
    shares = [n / its.size for n in its.counts.values()]
    entropy = -sum(share * math.log2(share) for share in shares if share > 0)  # a share may be too small for a float
    characters = "".join(its.counts)
    kinds = sum(bool(re.search(kind, characters)) for kind in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(1.0, entropy / 4) * (0.4 if kinds < 2 else 1.0)


def places(value: Value, seen: set[int]) -> Iterator[tuple[int, int]]:
    """Places of the literals a value is made of; values in `seen` have been asked before."""
    waiting = [value]
    while waiting:
        top = waiting.pop()
        if id(top) in seen:
            continue
        seen.add(id(top))
        waiting += top.terms
        if top.place:
            yield top.place


def literal_of(text: str, start: int, end: int) -> tuple[int, int]:
    if text[start] in "\"'" and end - start >= 2:
        return start + 1, end - 1
    while end > start and text[end - 1] == ".":
        end -= 1
    return start, end


def closing(text: str, at: int, ends: dict[int, int]) -> int:
    """Where the bracket at `at` is closed on its line, -1 if nowhere; `ends` keeps what is known."""
    if at not in ends:
        opened: list[int] = []
        for sign in _BRACKET.finditer(text, at):
            if sign[0] == "\n":
                break
            if sign[0] in "<[":
                opened.append(sign.start())
                ends[sign.start()] = -1
            elif sign[0] in ">]" and opened:
                ends[opened.pop()] = sign.end()
                if not opened:
                    break
    return ends[at]


def type_end(text: str, at: int, ends: dict[int, int]) -> int:
    """Where a type annotation that starts at `at` ends, -1 if there is none. It stands on one line."""
    while term := _TERM.match(text, at):
        at = term.end()
        while text[at : at + 1] in ("<", "["):
            if (at := closing(text, at, ends)) < 0:
                return -1
        if not (more := _BETWEEN.match(text, at)):
            return at
        at = more.end()
    return -1


def assigned(text: str, at: int, sign: str, ends: dict[int, int], known: dict[tuple[int, str], int]) -> int:
    """Where the value starts that a name gets: behind its type (`name: type = value`) and further names (`a = b = value`)."""
    passed = []
    while (at, sign) not in known:
        inner = _INNER.match(text, at)
        end = type_end(text, at, ends) if sign == ":" else inner.end() if inner and sign == "=" else -1
        more = _SET.match(text, end) if end >= 0 else None
        # A bare word with = in it is a value (`token=aGVsbG8=x`).
        if not more or (more["bare"] and not more["loose"] and text[end - 1] not in "]>\"'"):
            known[at, sign] = at
            break
        passed.append((at, sign))
        at, sign = more.end(), "="
    for place in passed:
        known[place] = known[at, sign]
    return known[at, sign]


def named_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans of literals that reach a sensitive name.

    In `a: b = "x"` b may be a type or a name, so both a and b get the literal; what b got is not read into `c: b`, where
    it would be a type again. Built-in types and types of several words hold no value.
    """
    if not _HINT.search(text):
        return []
    values: dict[str, Value] = {}
    told: list[Value] = []  # holds on to the values whose ids are in `seen`
    seen: set[int] = set()
    found: set[tuple[int, int]] = set()
    ends: dict[int, int] = {}
    known: dict[tuple[int, str], int] = {}
    typed = (0, 0)  # from where to where the last type stands
    doubtful: set[str] = set()
    at = run = 0

    def value_end(start: int) -> int:
        nonlocal run
        if quoted := _VALUE.match(text, start):
            return quoted.end()
        if start >= run:
            run = _RUN.match(text, start).end()
        return run

    while pair := _PAIR.search(text, at):
        sign, first = pair["sign"], pair.end()
        start = assigned(text, first, sign, ends, known)
        end = at = value_end(start)
        terms = [(start, end)]
        while more := _MORE.match(text, at):
            terms.append(more.span(1))
            at = more.end()
        if start > first:
            # What stands between is read by itself, be it a type or a name.
            at = first
        elif pair["bare"] and (_SET.match(text, end) or _SIGN.search(text, start, end)):
            at = start
        parts = []
        for begin, end in terms:
            name = _NAME.match(text, begin, end)
            held = values.get(name[0]) if name and not (sign == ":" and name[0] in doubtful) else None
            parts.append(held or Value(literal_of(text, begin, end)))
        value = parts[0] if len(parts) == 1 else Value(terms=tuple(parts))
        if not typed[0] <= pair.start("name") < typed[1]:
            values[pair["name"]] = value
            doubtful.discard(pair["name"])
        elif pair.span("name") == typed and pair["name"].lower() not in TYPES:
            values[pair["name"]] = value
            doubtful.add(pair["name"])
        if start > first and sign == ":":
            typed = (first, type_end(text, first, ends))
        weight = sensitivity(pair["name"])
        if weight >= THRESHOLD and weight * looks(profile(value, text)) >= THRESHOLD:
            told.append(value)
            found |= {place for place in places(value, seen) if place[1] > place[0]}
    return sorted((start, 3, end) for start, end in found)


def scan(text: str) -> tuple[int, int, int, str, str]:
    base = base_spans(text)
    counts = Counter(kind for _, kind, _ in base)

    def joined(spans: list[tuple[int, int, int]]) -> str:
        return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)

    everything = sorted({*base, *named_spans(text)})
    return counts[0], counts[1], counts[2], hashlib.sha256(joined(base).encode()).hexdigest(), joined(everything)


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for each row; positions are code points, ends exclusive.

    Whole texts are scanned; NULL and empty texts have no spans. Rows that repeat an id are rows like others, other
    columns are ignored, and an empty table gives no rows.
    """

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scan(text.as_py()) for text in batch.column(1)]
            columns = list(zip(*found, strict=True)) or [[]] * 5
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(scanned, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
