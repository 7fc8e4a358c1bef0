"""A composable lexer for JSON text that is read in splits.

What a piece of JSON does to the reader's state can be told without knowing the
state: quotes (those after an odd run of backslashes aside) flip between inside
and outside of strings, and for either start the brackets outside strings close
some of the containers that were open and leave some open. These summaries
compose, so a scan over one small row per split gives each split's true state.

``Summary`` is a split's summary, ``compose`` makes the states of a file's splits,
and ``Cutter`` cuts a split whose state is known into whole members of the
dictionary and the pieces of members that lie across its borders; ``stitch``
joins those. A border behind a comma between two members cuts none.

A split is a run of lines that end with ``SEPARATOR``; the last line of a file
does not.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np

SEPARATOR = b'",'
CHUNK = 1 << 20  # bytes lexed at a time
_OPEN, _CLOSE = b"{[", b"}]"
_BRACKETS = np.zeros(256, bool)
_BRACKETS[list(_OPEN + _CLOSE)] = True
_BLANK = b" \t\r\n"
BOM = b"\xef\xbb\xbf"

Container = tuple[str, str | None]  # the bracket that opened it, and its key in the object around it


class BrokenJson(ValueError):
    """The text is not one JSON document with the dictionary looked for."""


def quotes(data: np.ndarray) -> np.ndarray:
    """Places of the quotes that are not escaped."""
    at = np.flatnonzero(data == 0x22)
    slashes = np.flatnonzero(data == 0x5C)
    if not len(slashes):
        return at
    # a run of backslashes escapes what follows if it has an odd length
    starts = slashes[np.flatnonzero(np.diff(slashes, prepend=-2) != 1)]
    ends = slashes[np.flatnonzero(np.diff(slashes, append=len(data) + 2) != 1)] + 1
    return np.setdiff1d(at, ends[(ends - starts) % 2 == 1], assume_unique=True)


def outside(places: np.ndarray, quote: np.ndarray, inside: bool) -> np.ndarray:
    """Those of the places that lie outside strings, if the text starts ``inside`` one or not."""
    return places[(np.searchsorted(quote, places) + inside) % 2 == 0]


def key_before(text: bytes, at: int, quote: np.ndarray) -> str | None:
    """The key of the value at ``at``; None if it has none, or if its text begins before this text."""
    end = at - 1
    while end >= 0 and text[end] in _BLANK:
        end -= 1
    if end < 0 or text[end] != 0x3A:
        return None
    k = int(np.searchsorted(quote, end)) - 1
    try:
        return json.loads(text[quote[k - 1]:quote[k] + 1], strict=False) if k >= 1 else None
    except ValueError:  # no key: the text is malformed, or read from the wrong start state
        return None


def chunks(lines: list[bytes], more: bool) -> Iterator[bytes]:
    """The lines' text in parts of about ``CHUNK`` bytes, cut behind separators; ``more``: another line follows."""
    held, size = [], 0
    for k, line in enumerate(lines):
        held.append(line)
        size += len(line)
        if size >= CHUNK or k == len(lines) - 1:
            last = k == len(lines) - 1 and not more
            yield SEPARATOR.join(held) + (b"" if last else SEPARATOR)
            held, size = [], 0


class Summary:
    """What a split, less its last separator, does to the reader's state, for a start outside (0) and inside (1) a string."""

    def __init__(self, root: str | None) -> None:
        self.root, self.flips, self.escapes = root, False, False
        self.closed = [0, 0]
        self.opened: list[list[Container]] = [[], []]
        self.begins: list[dict[int, list[int]]] = [{}, {}]  # by relative depth: containers that begin, and objects named root

    def add(self, text: bytes) -> None:
        data = np.frombuffer(text, np.uint8)
        quote, brackets = quotes(data), np.flatnonzero(_BRACKETS[data])
        for start in (0, 1):
            stack = self.opened[start]
            for at in outside(brackets, quote, self.flips ^ bool(start)).tolist():
                if text[at] in _OPEN:
                    made = (chr(text[at]), key_before(text, at, quote))
                    count = self.begins[start].setdefault(len(stack) - self.closed[start], [0, 0])
                    count[0] += 1
                    count[1] += made == ("{", self.root)
                    stack.append(made)
                elif stack:
                    stack.pop()
                else:
                    self.closed[start] += 1
        self.flips ^= bool(len(quote) % 2)
        self.escapes = (len(text) - len(text.rstrip(b"\\"))) % 2 == 1  # the quote that follows, if one does

    def pack(self) -> str:
        return json.dumps([self.flips, self.escapes, self.closed, self.opened, [[[d, *n] for d, n in x.items()] for x in self.begins]])


def compose(file: str, root: str | None, splits: list[tuple[int, str]]) -> list[tuple[int, str, bool]]:
    """(start, state, does a border of it cut a member?) of each split from its (start, summary), in order.

    Fails if the file is not one document with one dictionary.
    """
    states, inside, stack, documents, roots = [], False, [], 0, 0
    depth = 2 if root else 1
    for k, (start, packed) in enumerate(splits):
        torn = bool(states) and (inside or len(stack) > depth) and _within(stack, root)
        states.append({"start": start, "inside": inside, "stack": stack, "begun": documents > 0, "torn": torn, "more": False})
        flips, escapes, closed, opened, begins = json.loads(packed)
        for relative, n, named in begins[inside]:
            documents += n if relative + len(stack) == 0 else 0
            roots += named if relative + len(stack) == 1 else 0
        if closed[inside] > len(stack):
            raise BrokenJson(f"Malformed JSON: a bracket too many in {file}")
        stack = stack[: len(stack) - closed[inside]] + opened[inside]
        inside ^= flips ^ (k < len(splits) - 1 and not escapes)  # a separator follows
    if inside or stack:
        raise BrokenJson(f"Malformed JSON: {file} ends inside a {'string' if inside else 'dictionary'}")
    if documents > 1:
        raise BrokenJson(f"Malformed JSON: a second document in {file}")
    if not documents or (root and roots != 1):
        raise BrokenJson(f"JSON dictionary without its member {root!r}, or with several, in {file}")
    out = []
    for k, state in enumerate(states):
        after = states[k + 1] if k + 1 < len(states) else None
        state |= {"more": after is not None, "cut": bool(after and after["torn"])}
        out.append((state["start"], json.dumps(state), state["torn"] or state["cut"]))
    return out


def _within(stack: list[Container], root: str | None) -> bool:
    """Are we in the dictionary, at whatever depth?"""
    depth = 2 if root else 1
    return len(stack) >= depth and all(kind == "{" for kind, _ in stack[:depth]) and (root is None or stack[1][1] == root)


class Cutter:
    """Cuts one split into the members of its file's dictionary: the top object, or its member ``root``."""

    def __init__(self, file: str, state: str, root: str | None):
        known = json.loads(state)
        self.file, self.root, self.depth = file, root, 2 if root else 1
        self.inside, self.begun, self.more, self.cut = known["inside"], known["begun"], known["more"], known["cut"]
        self.stack: list[Container] = [tuple(c) for c in known["stack"]]
        self.head = known["torn"]  # the first member has begun before this split
        self.held: list[bytes] = []
        self.cuts = int(bool(known["stack"]))

    def fail(self, what: str) -> None:
        raise BrokenJson(f"Malformed JSON: {what} in {self.file}")

    def within(self) -> bool:
        return _within(self.stack, self.root)

    def add(self, text: bytes) -> Iterator[tuple[str, bytes]]:
        """(kind, members) of the next part of the split: ``whole``, or ``head`` for the end of a first member."""
        data = np.frombuffer(text, np.uint8)
        quote = quotes(data)
        brackets = outside(np.flatnonzero(_BRACKETS[data]), quote, self.inside)
        commas = outside(np.flatnonzero(data == 0x2C), quote, self.inside)
        at = 0
        for b in brackets.tolist():
            yield from self._stretch(text, at, b, commas)
            if text[b] in _OPEN:
                self.begun = True
                was = self.within()
                self.stack.append((chr(text[b]), key_before(text, b, quote)))
                if self.within() and not was:
                    self.cuts, self.held = 0, []
                else:
                    self._hold(text[b:b + 1])
            else:
                if not self.stack or _OPEN[_CLOSE.index(text[b])] != ord(self.stack[-1][0]):
                    self.fail("a bracket that closes nothing")
                was = self.within()
                self.stack.pop()
                if was and not self.within():
                    yield from self._end()
                else:
                    self._hold(text[b:b + 1])
            at = b + 1
        yield from self._stretch(text, at, len(text), commas)
        self.inside ^= bool(len(quote) % 2)

    def _hold(self, text: bytes) -> None:
        if text and self.within():
            self.held.append(text)

    def _stretch(self, text: bytes, a: int, b: int, commas: np.ndarray) -> Iterator[tuple[str, bytes]]:
        """Text without brackets outside strings."""
        if not self.stack and text[a:b].removeprefix(BOM if not self.begun else b"").strip(_BLANK):
            self.fail("text outside the document")
        if not self.within():
            return
        if len(self.stack) > self.depth:
            self._hold(text[a:b])
            return
        cut = commas[np.searchsorted(commas, a):np.searchsorted(commas, b)]
        if not len(cut):
            self._hold(text[a:b])
            return
        self.held.append(text[a:cut[0]])
        yield self._member()
        if len(cut) > 1:
            yield "whole", text[cut[0] + 1:cut[-1]]
        self.cuts += len(cut)
        self.held = [text[cut[-1] + 1:b]]

    def _member(self) -> tuple[str, bytes]:
        kind, member = "head" if self.head else "whole", b"".join(self.held)
        if not self.head and not member.strip(_BLANK):
            self.fail("an empty member")
        self.head, self.held = False, []
        return kind, member

    def _end(self) -> Iterator[tuple[str, bytes]]:
        """The dictionary ends: its last member, if it has any."""
        if self.head or self.cuts or b"".join(self.held).strip(_BLANK):
            yield self._member()
        self.held, self.head = [], False

    def close(self) -> Iterator[tuple[str, bytes]]:
        """The member that the split's end cuts: ``tail``, or ``through`` if it also began before."""
        if self.cut:
            yield "through" if self.head else "tail", b"".join(self.held)


def stitch(pieces: list[tuple[int, str, bytes]]) -> list[bytes]:
    """The members that lie across splits, from the (start, kind, text) of a file's splits.

    In a split, the end of a member comes before the beginning of the next.
    """
    order = {"head": 0, "through": 0, "tail": 1}
    out, held = [], []
    for _, kind, text in sorted(pieces, key=lambda p: (p[0], order[p[1]])):
        held.append(text)
        if kind == "head":
            out.append(b"".join(held))
            held = []
    return out
