"""Byte-pair merging and the pre-token split shared by token counting and encoding."""

from __future__ import annotations

import base64
import heapq
import json
import re
import sys
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import regex

#: Code points of text that are split at once; longer texts are cut where a pre-token must begin.
PIECE_CHARS = 1 << 20

#: A space between two non-spaces always begins a pre-token: no alternative of the pattern
#: holds a space anywhere but in front, except runs of white space alone.
_SAFE_CUT = regex.compile(r"(?<=\S) (?=\S)")
_SAFE_CUTS = regex.compile(r"(?<=\S)(?= \S)")

Pair = tuple[bytes, bytes]
_BYTES = [bytes([b]) for b in range(256)]
_NONE = 1 << 60
#: Up to this length a scan for the lowest rank beats a heap.
_SHORT = 200
#: Fewer pieces of a length are merged one by one.
_FEW = 24

_CLASSES = (("L", r"\p{L}", "a"), ("N", r"\p{N}", "1"), ("S", r"\s", " "))


def merge(piece: bytes, pairs: dict[Pair, int]) -> list[bytes]:
    """Merge the neighbours of lowest rank, the leftmost first, until no pair has a rank."""
    parts = [_BYTES[b] for b in piece]
    if len(parts) > _SHORT:
        return _merge_long(parts, pairs)
    get = pairs.get
    ranks = [get(pair, _NONE) for pair in zip(parts, parts[1:])]
    while ranks and (lowest := min(ranks)) != _NONE:
        i = ranks.index(lowest)
        joined = parts[i] + parts.pop(i + 1)
        parts[i] = joined
        del ranks[i]
        if i:
            ranks[i - 1] = get((parts[i - 1], joined), _NONE)
        if i < len(ranks):
            ranks[i] = get((joined, parts[i + 1]), _NONE)
    return parts


class Merger:
    """Ids of many pieces at once, by ranks that are ids; pieces of one length are merged side by side.

    A step merges, in every piece that still has a pair with a rank, the leftmost one of lowest rank. All of them lose one part, so
    they stay of one length.
    """

    def __init__(self, ranks: dict[bytes, int], pairs: dict[Pair, int]):
        self.ranks, self.pairs = ranks, pairs
        keys = np.fromiter((ranks[a] << 32 | ranks[b] for a, b in pairs), np.int64, len(pairs))
        order = np.argsort(keys)
        self.keys = np.append(keys[order], _NONE)
        self.values = np.append(np.fromiter(pairs.values(), np.int64, len(pairs))[order], _NONE)
        self.bytes = np.array([ranks[b] for b in _BYTES], np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.values[at], _NONE)

    def ids(self, pieces: list[bytes]) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(pieces)
        by_size: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = [whole]
            else:
                by_size.setdefault(len(piece), []).append(i)
        for size, places in by_size.items():
            if len(places) < _FEW or size > _SHORT:
                for i in places:
                    out[i] = [self.ranks[t] for t in merge(pieces[i], self.pairs)]
            else:
                self._side_by_side(size, [pieces[i] for i in places], np.array(places), out)
        return out

    def _side_by_side(self, size: int, pieces: list[bytes], places: np.ndarray, out: list[list[int]]) -> None:
        parts = self.bytes[np.frombuffer(b"".join(pieces), np.uint8).reshape(-1, size)]
        rank = self._rank(parts[:, :-1], parts[:, 1:])
        while len(parts):
            at = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(parts), np.int64)
            low = rank[np.arange(len(parts)), at] if rank.shape[1] else np.full(len(parts), _NONE)
            done = low == _NONE
            if done.any():
                for place, ids in zip(places[done].tolist(), parts[done].tolist()):
                    out[place] = ids
                go = ~done
                parts, rank, places, at, low = parts[go], rank[go], places[go], at[go], low[go]
            n, width = parts.shape
            row = np.arange(n)
            parts[row, at] = low
            stays = np.ones((n, width), bool)
            stays[row, at + 1] = False
            parts = parts[stays].reshape(n, width - 1)
            rank = rank[stays[:, 1:]].reshape(n, width - 2)
            some = np.flatnonzero(at > 0)
            rank[some, at[some] - 1] = self._rank(parts[some, at[some] - 1], low[some])
            some = np.flatnonzero(at < width - 2)
            rank[some, at[some]] = self._rank(low[some], parts[some, at[some] + 1])


def _merge_long(parts: list[bytes | None], pairs: dict[Pair, int]) -> list[bytes]:
    """The same by linked list and heap: n log n, for pre-tokens of any length."""
    n = len(parts)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    heap = [(pairs[p], i, *p) for i, p in enumerate(zip(parts, parts[1:])) if p in pairs]
    heapq.heapify(heap)
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if parts[i] != left or j >= n or parts[j] != right:
            continue
        joined = left + right
        parts[i], parts[j] = joined, None
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (joined, parts[k]) in pairs:
                heapq.heappush(heap, (pairs[joined, parts[k]], i, joined, parts[k]))
        h = before[i]
        if h >= 0 and (parts[h], joined) in pairs:
            heapq.heappush(heap, (pairs[parts[h], joined], h, parts[h], joined))
    return [p for p in parts if p is not None]


class _Numbers(dict):
    """Numbers stretches of text as they are first asked for, and notes those that show white space next to a cut."""

    def __init__(self):
        super().__init__()
        self.doubtful: set[str] = set()

    def __missing__(self, key: str) -> int:
        n = self[key] = len(self)
        inner = len(key.strip())
        if inner < len(key) and (not inner or inner < len(key) - 1 or key[0] != " "):
            self.doubtful.add(key)
        return n


class Splitter:
    """Pre-tokens of a text, as the library whose character classes are given would cut them.

    ``fixes`` maps code points that the library and this module's regular expressions put in
    different classes (letters of newer Unicode versions) to a stand-in of the library's class.
    The split is found on the text with stand-ins and cut from the text itself.
    """

    def __init__(self, pattern: str, fixes: dict[int, str]):
        self.pattern = regex.compile(pattern)
        self.fixes = fixes
        self.first_odd = min(fixes, default=0)
        self.odd = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in _runs(fixes)) + "]") if fixes else None

    def pieces(self, text: str) -> Iterator[list[str]]:
        """Lists of pre-tokens that make up the text; each list covers a bounded stretch of it."""
        start, n = 0, len(text)
        while n - start > PIECE_CHARS:
            cut = _SAFE_CUT.search(text, start + PIECE_CHARS)
            if cut is None:
                break
            yield self._split(text[start : cut.start()])
            start = cut.start()
        yield self._split(text[start:] if start else text)

    def units(self, texts: list[str]) -> tuple[list[int], dict[str, int], np.ndarray]:
        """Each text cut where a pre-token must begin: stretches a text, the distinct stretches numbered as they
        appear, and the numbers of all stretches in order.

        Nearly all cuts are at single spaces, so a text is cut at every space first; if a stretch then shows white
        space next to a cut, it is cut anew by the exact rule, and the wrong stretches keep numbers without use.
        """
        number = _Numbers()
        found = []
        for text in texts:  # one text's stretches are held at a time
            cut = [text] if "\0" in text or self._has_odd(text) else text.replace(" ", "\0 ").split("\0")
            codes = np.fromiter(map(number.__getitem__, cut), np.int32, len(cut))
            if len(cut) > 1 and number.doubtful and not number.doubtful.isdisjoint(cut):
                cut = _SAFE_CUTS.split(text)
                codes = np.fromiter(map(number.__getitem__, cut), np.int32, len(cut))
            found.append(codes)
        return list(map(len, found)), number, np.concatenate(found) if found else np.zeros(0, np.int32)

    def _split(self, text: str) -> list[str]:
        if not self._has_odd(text):
            return self.pattern.findall(text)
        return [text[m.start() : m.end()] for m in self.pattern.finditer(text.translate(self.fixes))]

    def _has_odd(self, text: str) -> bool:
        if self.odd is None or text.isascii():
            return False
        if self.first_odd > 0xFF:
            try:
                text.encode("latin-1")
                return False
            except UnicodeEncodeError:
                pass
        return self.odd.search(text) is not None


def _runs(points: dict[int, str]) -> list[tuple[int, int]]:
    """Runs of consecutive code points."""
    runs: list[tuple[int, int]] = []
    for cp in sorted(points):
        if runs and runs[-1][1] == cp - 1:
            runs[-1] = (runs[-1][0], cp)
        else:
            runs.append((cp, cp))
    return runs


def class_fixes(members: Callable[[str, str], set[str]]) -> dict[int, str]:
    """Stand-ins for code points on whose class the library differs.

    ``members(expression, text)`` gives the characters of ``text`` that match the expression in the library.
    """
    everything = "".join(map(chr, (*range(0xD800), *range(0xE000, sys.maxunicode + 1))))
    fixes = {}
    theirs, ours = {}, {}
    for _, expression, stand_in in _CLASSES:
        for c in members(expression, everything):
            theirs[c] = stand_in
        for c in regex.findall(expression, everything):
            ours[c] = stand_in
    for c in theirs.keys() | ours.keys():
        if theirs.get(c, "!") != ours.get(c, "!"):
            fixes[ord(c)] = theirs.get(c, "!")
    return fixes


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary file."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shifted = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(shifted)}


def read_json_vocabulary(content: bytes) -> tuple[list[bytes], dict[Pair, int], list[str]]:
    """Vocabulary strings, pair ranks and special strings of a byte-level BPE file."""
    model = json.loads(content)
    of = byte_letters()

    def raw(token: str) -> bytes:
        return bytes(of[c] for c in token)

    pairs = (m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"])
    ranks = {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}
    for token in model["added_tokens"]:
        if token["single_word"] or token["lstrip"] or token["rstrip"]:
            raise ValueError(f"special token with white space rules: {token['content']}")
    specials = [t["content"] for t in model["added_tokens"]]
    return [raw(t) for t in model["model"]["vocab"]], ranks, specials


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: base64 and a number per line."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}


def pair_ranks(ranks: dict[bytes, int]) -> dict[Pair, int]:
    """The rank of every pair of tokens that joins to a token."""
    return {
        (token[:i], token[i:]): rank
        for token, rank in ranks.items()
        for i in range(1, len(token))
        if token[:i] in ranks and token[i:] in ranks
    }


def read_local(path: str) -> bytes:
    """A vocabulary file of the driver's machine; its content travels with the tasks."""
    with open(path, "rb") as f:
        content = f.read()
    if len(content) > 64 << 20:
        raise ValueError(f"{path} holds {len(content)} bytes; vocabularies over 64 MB are not sent to tasks")
    return content
