"""Token ids of whole texts, with the encodings of words remembered by each Python worker.

Both tokenizers used here treat a text as a row of pieces that do not influence each other: the word tokenizer ends every
piece at white space; the byte tokenizer attaches a single blank to the word that follows and takes a single line feed
between words by itself. Words repeat, so a text is cut at those places and its words are looked up. A word of letters
goes straight to the tokenizer's model, and with plain marks behind it is that word's ids and those of the marks; any other
word, and any text with other white space (several blanks, blanks at the ends of lines, empty lines, tabs), is encoded by
the whole tokenizer. Beyond a number of words those seen last are forgotten.
"""

from __future__ import annotations

import os
from functools import lru_cache
from itertools import islice

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

MOST_REMEMBERED = 400_000
# Unicode white space other than blank and line feed, and the separators that Python counts as white space.
OTHER_WHITE = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0 " + "".join(map(chr, range(0x2000, 0x200B))) + "    　"
PLAIN_MARKS = ".,;:!?#$%&*|"


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_symbols() -> list[str]:
    """The printable character by which byte-level vocabularies write each byte: itself, or the next one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Words(dict):
    """The ids of a word as little-endian unsigned 32-bit numbers; words not seen before are encoded."""

    def __init__(self, tokenizer, before: str, lower: bool):
        self.tokenizer, self.tokenize, self.before, self.lower = tokenizer, tokenizer.model.tokenize, before, lower
        self.symbols = byte_symbols()
        self.start = "".join([self.symbols[b] for b in before.encode()])
        self.raw = [i.to_bytes(4, "little") for i in range(max(tokenizer.get_vocab().values(), default=-1) + 1)]
        self.marks: dict[str, bytes] = {}

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _letters(self, word: str) -> bytes:
        """The ids of Latin letters, which no normalisation changes but lower case (below U+0100 every text is in NFC)."""
        shown = word.lower() if self.lower else word
        if not word.isascii():  # ASCII letters are their own symbols
            shown = "".join([self.symbols[b] for b in shown.encode()])
        return b"".join([self.raw[t.id] for t in self.tokenize(self.start + shown)])

    def __missing__(self, key):
        word = key.decode() if isinstance(key, bytes) else key
        core = word.rstrip(PLAIN_MARKS)
        if not core.isalpha() or not core.isascii() and max(core) > "\xff":
            ids = self._ids(self.before + word)
        elif core == word:
            ids = self._letters(word)
        else:
            marks = word[len(core) :]  # ASCII: as many bytes as characters
            ids = self[key[: -len(marks)]] + (self.marks.get(marks) or self.marks.setdefault(marks, self._ids(marks)))
        self[key] = ids
        return ids

    def forget(self) -> None:
        """Keeps the words seen first, among which the frequent ones are."""
        first = list(islice(self.items(), MOST_REMEMBERED // 2))
        self.clear()
        self.marks.clear()
        self.update(first)


class Encoder:
    """Texts to little-endian unsigned 32-bit ids. ``words_end_pieces``: every piece ends at white space."""

    def __init__(self, path: str, words_end_pieces: bool):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.words_end_pieces = words_end_pieces
        self.first = Words(self.tokenizer, "", words_end_pieces)
        self.later = Words(self.tokenizer, " ", False)
        self.line_end = b"" if words_end_pieces else self.whole("\n")

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        for known in (self.first, self.later):
            if len(known) > MOST_REMEMBERED:
                known.forget()
        if self.words_end_pieces:
            return b"".join(map(self.first.__getitem__, text.encode().split()))  # bytes are split at ASCII white space only
        runs = "  " in text or "\n\n" in text or " \n" in text or "\n " in text
        if runs or text[0].isspace() or text[-1].isspace() or any(c in text for c in OTHER_WHITE):
            return self.whole(text)
        out: list[bytes] = []
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            out.append(self.first[first])
            out.extend(map(self.later.__getitem__, rest))
            out.append(self.line_end)
        return b"".join(out[:-1])


@lru_cache(maxsize=4)
def encoder(path: str, words_end_pieces: bool) -> Encoder:
    return Encoder(path, words_end_pieces)
