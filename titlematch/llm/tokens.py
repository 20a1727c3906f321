"""Public tokenizers over many texts: units of text that encode alone.

A text is cut into units at places where the tokenizer's own splitting cuts in
any context, so the ids of a text are the ids of its units one after the other,
and the ids of a unit are asked of the library once and remembered.

* ``spaced`` (byte-level pattern): a unit is a run of white space with the run of
  other characters after it.  The pattern's alternatives never reach from a
  non-space to the space after it, and how they cut a run of white space depends
  only on that run and on whether something follows.
* ``bare`` (white space dropped): a unit is what stands between two spaces or
  line ends.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable, Iterator

# Unicode's White_Space, which the tokenizers' patterns call \s
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACED = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
# letters with marks after them: the two always encode apart
_LETTERS_MARKS = re.compile(r"( ?[A-Za-z]+)([.,;:!?#$%&*|]+)\Z")
# Letters below this are composed already; of them only the dotted capital I
# becomes two characters in lower case.
_LATIN_END, _DOTTED = "\u0250", "\u0130"
# Byte-level vocabularies write a byte as the character of its number where that
# is visible, and the others, in order, from 256 on.
_VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_SIGNS = dict(zip([b for b in range(256) if b not in _VISIBLE], range(256, 512), strict=False))
#: Units a generation remembers, and the longest remembered unit, without and with
#: marks (long words with marks seldom recur, and their parts are remembered).
KNOWN, LONGEST, LONGEST_MARKED = 400_000, 64, 8
#: Texts are cut into units this many characters at a time.
SLICE = 1 << 20


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def spaced(text: str) -> list[str]:
    return _SPACED.findall(text)


def bare(text: str) -> list[str]:
    return text.replace("\n", " ").split(" ")


def slices(text: str, size: int = SLICE) -> Iterator[str]:
    """``text`` in parts that end before a space which follows a non-space, so
    that the units of the parts are the units of the text."""
    a = 0
    while len(text) - a > size:
        b = a + size
        while True:
            b = text.find(" ", b)
            if b < 0 or not text[b - 1].isspace():
                break
            b += 1
        if b < 0:
            break
        yield text[a:b]
        a = b
    yield text[a:] if a else text


class _Known(dict):
    """Values of units, asked for when first met.  Two generations bound it: a
    full dictionary becomes the old one, and what is met again moves over."""

    def __init__(self, ask: Callable[[str], object], lowered: Callable[[str], str]):
        super().__init__()
        self.ask, self.lowered, self.old = ask, lowered, {}

    def __missing__(self, unit: str):
        value = self.old.get(unit)
        if value is None:
            if unit.isalpha():
                value = self.ask(unit)
            elif m := _LETTERS_MARKS.match(unit):
                value = self[m[1]] + self[m[2]]
                if len(unit) > LONGEST_MARKED:
                    return value
            elif (small := self.lowered(unit)) != unit:
                value = self[small]
            else:
                value = self.ask(unit)
        if len(unit) <= LONGEST:
            self[unit] = value
        return value

    def turn(self) -> None:
        if len(self) > KNOWN:
            self.old = dict(self)
            self.clear()


class Encoder:
    """Ids of texts by a tokenizer file, unit by unit."""

    def __init__(self, path: str, units: Callable[[str], list[str]], value: Callable, lower: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.special = [t.content.lower() for t in self.library.get_added_tokens_decoder().values()]
        self.units, self.value, self.lower = units, value, lower
        self.known = _Known(self._ask, self.lowered)

    def lowered(self, text: str) -> str:
        """ASCII text in lower case if the tokenizer lower-cases, so that fewer units
        differ.  The library looks for special strings before it lower-cases, so text
        that has or would get one stays as it is."""
        if not self.lower or not text.isascii():
            return text
        small = text.lower()
        return text if any(s in small for s in self.special) else small

    def _ask(self, unit: str):
        """The value of a unit by the library.  A word of Latin letters (maybe
        after a space, where that counts) is one piece to the tokenizer's
        splitting, and its normaliser does no more than lower-case it; such a word
        is asked of the library's model directly, written in byte-level signs."""
        word = unit[1:] if not self.lower and unit[:1] == " " else unit
        if word.isalpha() and (word.isascii() or (max(word) < _LATIN_END and _DOTTED not in word)):
            piece = unit.lower() if self.lower else unit
            if word is not unit or not word.isascii():
                piece = piece.encode().decode("latin-1").translate(_BYTE_SIGNS)
            return self.value([t.id for t in self.model.tokenize(piece)])
        return self.value(self.library.encode(unit, add_special_tokens=False).ids)

    def values(self, text: str) -> list:
        """The values of the text's units."""
        self.known.turn()
        return list(map(self.known.__getitem__, self.units(self.lowered(text))))

    def each(self, texts: list[str], join: Callable) -> Iterator:
        """``join`` of the values of each text; a very long text goes in parts."""
        for text in texts:
            if len(text) <= SLICE:
                yield join(self.values(text))
            else:
                yield join([join(self.values(part)) for part in slices(text)])


def id_bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, units: Callable, value: Callable, lower: bool = False) -> Encoder:
    """One encoder for each kind and Python worker."""
    key = (path, units.__name__, value.__name__)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, units, value, lower)
    return _ENCODERS[key]
