"""Cut texts into pieces that tokenizers treat independently, and remember their ids.

The pattern of byte-level vocabularies takes a single space together with what
follows it, so a text can be cut before each space that stands alone between
two other characters. A piece then gives the same ids alone as inside the
text. Words repeat, so most pieces are found in memory.
"""

from __future__ import annotations

import re
import string
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import compress
from operator import not_

_CUT = re.compile(r"(?<=\S) (?=\S)")
_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace()]
_ASCII_SPACES = [c for c in _SPACES if c.isascii()]


def odd(text: str) -> bool:
    """Whether white space stands at an end or beside a space."""
    if text[:1].isspace() or text[-1:].isspace():
        return True
    spaces = _ASCII_SPACES if text.isascii() else _SPACES
    return any(c in text and (c + " " in text or " " + c in text) for c in spaces)


def cut(text: str) -> list[str]:
    """Pieces; before each but the first stands one space that is left out here."""
    return _CUT.split(text) if odd(text) else text.split(" ")


# After one of these letters and digits, marks begin a part of their own in byte-level vocabularies.
_BEFORE_MARKS = frozenset(string.ascii_letters + string.digits + "".join(c for c in map(chr, range(0xC0, 0x180)) if c.isalpha()))


def unmarked(piece: str) -> str:
    """A piece without the marks at the end of its first line and what follows them; the whole piece if unsure."""
    line = piece.partition("\n")[0] if "\n" in piece else piece
    word = line.rstrip(string.punctuation)
    return word if word[-1:] in _BEFORE_MARKS and len(word) < len(line) else piece


# Characters of text whose unknown pieces are learned by one call, and of a piece that is remembered.
CHUNK, LONGEST = 4_000_000, 200


class PieceCache:
    """Ids of pieces as bytes, for the pieces seen lately.

    ``encode`` gives the ids of many pieces at once. At most twice ``limit``
    pieces are held: when the newer half is full it becomes the older half.
    With ``marks`` an unknown word is encoded apart from the marks after it,
    for vocabularies that never join the two; the word alone is often known.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], limit: int = 300_000, marks: bool = False):
        self.encode, self.limit, self.marks = encode, limit, marks
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def ids(self, text: str) -> bytes:
        """Ids of a whole text, joined."""
        if not text:
            return b""
        first, *rest = cut(text)
        return self.encode([first])[0] + self._joined(rest)

    def all_ids(self, texts: Sequence[str]) -> Iterator[bytes]:
        """Ids of each text; the unknown pieces of many texts go to the library together."""
        start = 0
        while start < len(texts):
            end, size = start, 0
            while end < len(texts) and size < CHUNK:
                size += len(texts[end])
                end += 1
            yield from self._chunk(texts[start:end])
            start = end

    def _chunk(self, texts: Sequence[str]) -> Iterator[bytes]:
        cuts = [cut(text) if text else [] for text in texts]
        firsts = iter(self.encode([pieces[0] for pieces in cuts if pieces]))
        words = set().union(*[pieces[1:] for pieces in cuts])
        self._learn(words, words.difference(self.new))
        for pieces in cuts:
            yield next(firsts) + b"".join(map(self.new.__getitem__, pieces[1:])) if pieces else b""
        for word in words:
            if len(word) > LONGEST:
                del self.new[word]

    def _joined(self, words: Sequence[str]) -> bytes:
        found = list(map(self.new.get, words))
        if None in found:
            self._learn(words, set(compress(words, map(not_, found))))
            found = map(self.new.__getitem__, words)
        return b"".join(found)

    def _learn(self, words: Iterable[str], missing: set[str]) -> None:
        if len(self.new) + len(missing) > self.limit:
            self.old, self.new = self.new, {}
            missing = set(words)
        unknown = []
        for word in missing:
            known = self.old.get(word)
            if known is None:
                unknown.append(word)
            else:
                self.new[word] = known
        rest = [word for word in unknown if not word.isalpha()] if self.marks else []
        if rest:
            unknown = [word for word in unknown if word.isalpha()]
        self.new.update(zip(unknown, self.encode([" " + word for word in unknown])))
        if rest:
            self._learn_marked(rest)

    def _learn_marked(self, pieces: list[str]) -> None:
        new, old, words = self.new, self.old, list(map(unmarked, pieces))
        unknown = list({word for word in words if word not in new and word not in old})
        found = dict(zip(unknown, self.encode([" " + word for word in unknown])))
        ends = [piece[len(word):] for piece, word in zip(pieces, words)]
        others = list(set(ends) - {""})
        after = dict(zip(others, self.encode(others))) | {"": b""}
        for piece, word, end in zip(pieces, words, ends):
            new[piece] = (found.get(word) or new.get(word) or old[word]) + after[end]
