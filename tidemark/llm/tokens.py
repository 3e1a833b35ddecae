"""Token ids of whole texts by the tokenizers library, with a bounded cache of the pieces between spaces."""

from __future__ import annotations

import functools
import os
import re
import unicodedata
from array import array

import numpy as np

# White space besides space, tab and line ends; a text with any of it is cut with care.
RARE_SPACE = re.compile("[" + "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \t\r\n") + "]")
CUT = re.compile(r"(?<=\S)(?= )")
PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
LONGEST_CACHED = 48
# Different runs of marks that are kept.
TAILS = 10_000


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level tokenizers write for each byte: itself if it is visible, else one from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + at) for at, b in enumerate(hidden)}


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes, equal to ``encode(text, add_special_tokens=False).ids``.

    Both tokenizers used here cut a text before a space that follows a visible character, and what they make of a piece does
    not depend on its neighbours; so pieces are encoded once and kept, up to ``entries`` of them; then the longer half, which
    is the rarer one, is forgotten. A piece of one word and marks goes to the tokenizer's model directly, any
    other piece through the whole tokenizer, and a text with something like a special token is encoded whole.
    """

    def __init__(self, path: str, entries: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.entries = Tokenizer.from_file(path), entries
        self.model = self.tokenizer.model
        # One of the two lower-cases and drops white space, the other one keeps both.
        self.lowers = self.tokenizer.normalizer is not None
        self.spaced = not self.lowers
        self.letters = _byte_letters()
        self.known: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}
        self.marks = [t.content[:2] for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.line_end = self._whole(["\n"])[0]

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _part(self, text: str) -> bytes:
        """Ids of one pre-token."""
        if text.isascii():
            text = "\u0120" + text[1:] if text[0] == " " else text
        else:
            text = "".join(map(self.letters.__getitem__, text.encode()))
        return array("I", [t.id for t in self.model.tokenize(text)]).tobytes()

    def _word(self, word: str, space: bool) -> bytes | None:
        """Ids of a word of letters; the word after a space is likely to be known, or to come again, and is kept."""
        if self.lowers:
            if word.isascii():
                word = word.lower()
            else:
                if "Σ" in word or not (lower := word.lower()).isalpha() or unicodedata.normalize("NFC", word) != word or unicodedata.normalize("NFC", lower) != lower:
                    return None
                word = lower
        elif not space:
            return self._part(word)
        ids = self.known.get(word)
        if ids is None:
            ids = self._part(f" {word}" if self.spaced else word)
            if len(word) <= LONGEST_CACHED:
                self.known[word] = ids
        return ids

    def _tail(self, marks: str) -> bytes:
        """Ids of marks behind a word; there are few of them."""
        ids = self.tails.get(marks)
        if ids is None:
            ids = self._part(marks)
            if len(self.tails) < TAILS:
                self.tails[marks] = ids
        return ids

    def _piece(self, piece: str, space: bool) -> bytes | None:
        """Ids of a piece made of words and marks, None for any other piece."""
        if piece.isalpha():
            return self._word(piece, space)
        out = b""
        for at, part in enumerate(piece.split("\n")):
            word = part.rstrip(PUNCTUATION)
            if at > 1 or not word.isalpha():
                return None
            ids = self._word(word, space and not at)
            if ids is None:
                return None
            out += self.line_end + ids if at else ids
            if len(part) > len(word):
                out += self._tail(part[len(word) :])
        return out

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        found, hard = {}, []
        for piece in pieces:
            ids = self._piece(piece, True)
            if ids is None:
                hard.append(piece)
            else:
                found[piece] = ids
        if hard:
            found.update(zip(hard, self._whole([f" {p}" for p in hard]), strict=True))
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """One bytes object for each text."""
        out = []
        for text in texts:
            if any(mark in text for mark in self.marks):
                out += self._whole([text])
                continue
            if "  " in text or "\n " in text or "\t " in text or "\r " in text or RARE_SPACE.search(text):
                first, *rest = CUT.split(text)
                pieces = [p[1:] for p in rest]
            else:
                first, *pieces = text.split(" ")
            head = b""
            if first:
                head = self._piece(first, False) or self._whole([first])[0]
            parts = list(map(self.known.get, pieces))
            if None in parts:
                found = self._learn({p for p, ids in zip(pieces, parts, strict=True) if ids is None})
                parts = [found[p] if ids is None else ids for p, ids in zip(pieces, parts, strict=True)]
                self.known.update((p, ids) for p, ids in found.items() if len(p) <= LONGEST_CACHED)
                if len(self.known) > self.entries:
                    middle = sorted(map(len, self.known))[len(self.known) // 2]
                    self.known = {p: ids for p, ids in self.known.items() if len(p) < middle}
            out.append(head + b"".join(parts))
        return out


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of this worker; it outlives the task."""
    return Encoder(path)


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)
