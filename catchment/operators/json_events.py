"""JSON text read value by value: what a report needs of a document, without the document as a tree."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from json.decoder import scanstring

_GAP = re.compile(r"[ \t\n\r]*")
_ATOM = re.compile(r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false|null|NaN|-?Infinity")
#: A key with its colon and a text, where neither has anything to be unescaped.
_KEY = re.compile(r'"([^"\\\x00-\x1f]*)"[ \t\n\r]*:[ \t\n\r]*')
_TEXT = re.compile(r'"([^"\\\x00-\x1f]*)"')
_KINDS = {"true": "bool", "false": "bool", "null": "NoneType"}


class Broken(ValueError):
    """The text is no JSON."""


class Repeated(Exception):
    """An object names a key twice."""


class Value:
    """A value that isn't a container, as its text ends."""

    __slots__ = ("end", "key", "kind", "owner", "said", "size", "start", "text")

    def __init__(self, kind: str, key: str | None, owner: Container | None, start: int, end: int, text: str | None, said: int) -> None:
        self.kind, self.key, self.owner, self.start, self.end, self.text, self.said = kind, key, owner, start, end, text, said
        self.size = None if text is None else len(text)

    @property
    def path(self) -> str:
        """Where the value stands, with positions; asked for before its owner goes on."""
        return place(self.owner, self.key)


class Container:
    """An object or list: what has been read of it, never its members."""

    __slots__ = ("at", "end", "first", "hits", "key", "kind", "lead", "names", "owner", "path", "said", "shape", "size", "start")
    text = None

    def __init__(self, at: int, kind: str, key: str | None, owner: Container | None, start: int) -> None:
        self.at, self.kind, self.key, self.owner, self.start, self.end = at, kind, key, owner, start, start
        self.size = self.said = self.hits = 0
        self.path = place(owner, key)
        #: The path without positions.
        self.shape = "$" if owner is None else f"{owner.shape}.{key}" if owner.kind == "dict" else f"{owner.shape}[]"
        self.names: dict[str, None] | None = {} if kind == "dict" else None
        #: For lists, the first member and the first object among the members.
        self.lead: Container | Value | None = None
        self.first: Container | None = None


def place(owner: Container | None, key: str | None) -> str:
    if owner is None:
        return "$"
    return f"{owner.path}.{key}" if owner.kind == "dict" else f"{owner.path}[{owner.size}]"


def values(text: str, words: tuple[str, ...] = (), scalars: bool = True) -> Iterator[Container | Value]:
    """Every value when it ends, members before what holds them; `said` has a bit for each word in keys and texts below.

    Without `scalars` only objects and lists come, and what the document is where it is neither. Raises Broken where the
    text is no JSON and Repeated where an object repeats a key, maybe after some values.
    """
    gap, atoms, keys, texts = _GAP.match, _ATOM.match, _KEY.match, _TEXT.match

    def spoken(said: str) -> int:
        low, bits = said.lower(), 0
        for number, word in enumerate(words):
            if word in low:
                bits |= 1 << number
        return bits

    def string(at: int) -> tuple[str, int]:
        if text[at : at + 1] != '"':
            raise Broken
        try:
            return scanstring(text, at + 1, True)
        except ValueError as problem:
            raise Broken from problem

    def name_of(owner: Container, at: int) -> tuple[str, int]:
        if found := keys(text, at):
            key, at = found[1], found.end()
        else:
            key, end = string(at)
            end = gap(text, end).end()
            if text[end : end + 1] != ":":
                raise Broken
            at = gap(text, end + 1).end()
        if key in owner.names:
            raise Repeated
        owner.names[key] = None
        if words:
            owner.said |= spoken(key)
        return key, at

    owner: Container | None = None
    key, number, at = None, -1, gap(text, 0).end()
    while True:
        number += 1
        lead = text[at : at + 1]
        start, value, said = at, None, 0
        if lead == "{" or lead == "[":
            value = Container(number, "dict" if lead == "{" else "list", key, owner, at)
            at = gap(text, at + 1).end()
            if text[at : at + 1] != ("}" if lead == "{" else "]"):
                owner = value
                key, at = name_of(owner, at) if lead == "{" else (None, at)
                continue
            at += 1
        else:
            kind, content = "str", None
            if found := texts(text, at):
                content, at = found[1], found.end()
            elif lead == '"':
                content, at = string(at)
            else:
                found = atoms(text, at)
                if not found:
                    raise Broken
                atom, at = found[0], found.end()
                if scalars or owner is None:
                    kind = _KINDS.get(atom) or ("int" if atom.lstrip("-").isdigit() else "float")
            if words and content is not None:
                said = spoken(content)
            if scalars or owner is None:
                value = Value(kind, key, owner, start, at, content, said)
        # The value has ended, and maybe those that hold it.
        while True:
            if value is not None:
                value.end, said = at, value.said
                yield value
            if owner is None:
                if gap(text, at).end() != len(text):
                    raise Broken
                return
            owner.size += 1
            owner.said |= said
            if value is not None and owner.kind == "list":
                if owner.lead is None:
                    owner.lead = value
                if owner.first is None and value.kind == "dict":
                    owner.first = value
            sign = text[at : at + 1]
            if sign not in (",", "}", "]"):
                at = gap(text, at).end()
                sign = text[at : at + 1]
            if sign == ",":
                at = gap(text, at + 1).end()
                key, at = name_of(owner, at) if owner.kind == "dict" else (None, at)
                break
            if sign != ("}" if owner.kind == "dict" else "]"):
                raise Broken
            value, owner, at = owner, owner.owner, at + 1


def read(text: str, report: Callable[[str], list]) -> list:
    """What `report` makes of a document; a repeated key counts once, with its last value.

    A text that is no JSON raises the error of Python's own reader.
    """
    try:
        return report(text)
    except Repeated:
        return report(json.dumps(json.loads(text), ensure_ascii=False))
    except Broken:
        json.loads(text)
        raise


def sample(text: str, value: Container | Value | None) -> str | None:
    """A value as JSON text, spaced evenly."""
    if value is None:
        return None
    piece = text[value.start : value.end]
    try:
        return json.dumps(json.loads(piece), ensure_ascii=False)
    except RecursionError:
        return piece
