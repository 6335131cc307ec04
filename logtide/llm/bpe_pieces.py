"""Cutting texts into cached pieces whose token ids do not depend on what surrounds them.

Byte-level BPE merges inside pre-tokens only. Where every run of white space is one
space or one line break between other characters, a pre-token starts at each space and a
line break is one of its own, so a text is its lines, and a line its first word and its further
words with the space in front. Arrow splits a block of texts into these pieces and numbers the
distinct ones; each distinct piece is looked up in a dictionary once, and numpy puts the
ids together. A text with other white space is one piece.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# White space in any other form than lone spaces and line breaks (a superset of Unicode's).
_ODD = r"[ \n][ \n]|[\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_ODD_HERE = re.compile(re.sub(r"\\x\{(\w+)\}", lambda m: re.escape(chr(int(m[1], 16))), _ODD))
#: Pieces of a generation, and characters up to which a piece is kept.
MOST, LONGEST = 300_000, 64
#: Latin letters after at most one space, and ASCII marks after them: a pre-token each.
_WORD = re.compile(r"( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-&(-/:-@\[-`{-~]*)")


def packed(ids: list[int]) -> bytes:
    """Ids as 32-bit numbers in the machine's byte order (little-endian on all platforms of the libraries used)."""
    return array("I", ids).tobytes()


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies:
    printable Latin-1 characters stand for themselves, the others follow from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


_OF_BYTE = dict(enumerate(byte_characters()))


def pre_tokens(piece: str) -> tuple[str, str] | None:
    """A word and the marks after it, both in byte characters; None for pieces of another form."""
    found = _WORD.fullmatch(piece)
    if not found:
        return None
    word, marks = found.groups()
    return word.encode().decode("latin-1").translate(_OF_BYTE), marks


class Pieces:
    """piece -> packed ids, for the pieces of the last one to two generations.

    A generation ends when it holds ``MOST`` pieces. The one before stays at hand and its pieces
    move on when they come up again, so frequent pieces are encoded once and memory stays bounded.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]]):
        self.encode, self.kept, self.older = encode, {}, {}

    def look_up(self, pieces: list[str]) -> list[bytes]:
        """Packed ids of distinct pieces; those not at hand are encoded in one call."""
        found = list(map(self.kept.get, pieces))
        lacking = [i for i, x in enumerate(found) if x is None]
        unseen = []
        for i in lacking:
            found[i] = self.older.get(pieces[i])
            if found[i] is None:
                unseen.append(i)
        for i, ids in zip(unseen, self.encode([pieces[i] for i in unseen]), strict=True):
            found[i] = ids
        for i in lacking:
            if len(pieces[i]) <= LONGEST:
                if len(self.kept) >= MOST:
                    self.kept, self.older = {}, self.kept
                self.kept[pieces[i]] = found[i]
        return found


class Cutter:
    """Encodes texts; ``encode`` maps pieces to packed ids, ``special`` holds strings with fixed ones."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], special: dict[str, bytes]):
        self.pieces, self.special = Pieces(encode), special
        marks = [re.escape(x) for x in sorted(special, key=len, reverse=True)]
        self.marks = re.compile("(" + "|".join(marks) + ")") if marks else None

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, bounds of each text among them); a null counts as empty."""
        texts = pc.fill_null(texts, "")
        apart = pc.match_substring_regex(texts, _ODD)
        for mark in self.special:
            apart = pc.or_(apart, pc.match_substring(texts, mark))
        apart = apart.to_numpy(zero_copy_only=False)
        if not apart.any():
            return self._plain(texts)
        ids, bounds = self._plain(pc.if_else(pa.array(apart), "", texts))
        sizes, out, done = np.diff(bounds), [], 0
        for i in np.flatnonzero(apart).tolist():
            one = self._marked(texts[i].as_py())
            out += [ids[done:bounds[i]], one]
            done, sizes[i] = bounds[i], len(one)
        out.append(ids[done:])
        return np.concatenate(out), np.append(0, np.cumsum(sizes))

    def _marked(self, text: str) -> np.ndarray:
        """Ids of a text that holds special strings or odd white space."""
        parts = self.marks.split(text) if self.marks else [text]
        odd = _ODD_HERE.search
        out = []
        for i, x in enumerate(parts):
            if i % 2:
                out.append(np.frombuffer(self.special[x], "<u4"))
            elif odd(x):
                out.append(np.frombuffer(self.pieces.encode([x])[0], "<u4"))
            elif x:
                out.append(self._plain(pa.array([x]))[0])
        return np.concatenate(out) if out else np.zeros(0, "<u4")

    def _plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        # With spaces around line breaks, each of them is a piece between two spaces.
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " \n "), " ")
        bounds = split.offsets.to_numpy().astype(np.int64)
        words = split.flatten().dictionary_encode()
        names, code = words.dictionary.to_pylist(), words.indices.to_numpy().astype(np.int64)
        if not len(code):
            return np.zeros(0, "<u4"), bounds
        # The first word of a line has no space in front of it, and a line break is its own piece.
        bare = np.zeros(len(code), bool)
        bare[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
        if "\n" in names:
            breaks = np.flatnonzero(code == names.index("\n"))
            bare[breaks] = True
            after = breaks[breaks + 1 < len(code)] + 1
            bare[after] = True
        code = code * 2 + bare
        used = np.zeros(2 * len(names), bool)
        used[code] = True
        kinds = np.flatnonzero(used)
        pieces = [names[k >> 1] if k & 1 else " " + names[k >> 1] for k in kinds.tolist()]
        found = self.pieces.look_up(pieces)
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), "<u4")
        rank = np.cumsum(used) - 1
        code = rank[code]
        many = size[code]
        ends = np.cumsum(many)
        first = np.cumsum(size) - size
        ids = flat[np.repeat(first[code] - (ends - many), many) + np.arange(int(ends[-1]))]
        return ids, np.append(0, ends)[bounds]
