"""Token ids of whole texts with the ``tokenizers`` library.

The byte-level pre-tokenizer never joins a space to the character before it, so
a text may be cut before every space that follows a non-space; the pieces are
encoded once and remembered. A piece of letters below U+0250, digits and signs is
split into pre-tokens here, by the pre-tokenizer's published pattern, and each goes
to the tokenizer's BPE model; any other piece, and one with the string of an
added token, goes through the whole tokenizer.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import regex

#: Pieces remembered by one worker, and as many words: about 300 MB when full.
CACHE_SIZE = 1_200_000
#: Below this character letters and numbers are the same in all versions of Unicode in use.
LATIN_END = "\u0250"
#: Fixed value: the pre-tokenizer's pattern.
PRE_TOKENS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Characters on which engines disagree whether they are spaces, and other controls.
ODD = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\xa0\xad]")
#: White space before a space: what ASCII has of it, and the rest.
LOOSE_ASCII = tuple(chr(c) + " " for c in (9, 10, 11, 12, 13, 28, 29, 30, 31, 32))
LOOSE_OTHER = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000] ")


def _byte_alphabet() -> dict[int, str]:
    """Byte-level vocabularies write printable bytes as they are and the others, in order, from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


BYTE_ALPHABET = _byte_alphabet()
_encoders: dict[str, "Encoder"] = {}


def default_vocabulary() -> str:
    """The public byte-level vocabulary of about 50 thousand ids."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(path: str, remember: int = CACHE_SIZE) -> "Encoder":
    """This worker's encoder for a vocabulary file, remembering at most so many pieces."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    _encoders[path].pieces.most = _encoders[path].pieces.words.most = remember
    return _encoders[path]


def _has_loose_space(text: str) -> bool:
    """A space at either end or after other white space."""
    return (text[0] == " " or text[-1] == " " or any(pair in text for pair in LOOSE_ASCII)
            or not text.isascii() and LOOSE_OTHER.search(text) is not None)


class _Words(dict):
    """Ids of pre-tokens as little-endian bytes; unknown ones are encoded on demand."""

    def __init__(self, model, kind: str) -> None:
        self.model, self.kind, self.most = model, kind, CACHE_SIZE

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        if word.isascii() and word.isalpha():
            written = word
        elif word.isascii() and word[0] == " " and word[1:].isalpha():
            written = "\u0120" + word[1:]
        else:
            written = word.encode().decode("latin-1").translate(BYTE_ALPHABET)
        found = self[word] = array(self.kind, [t.id for t in self.model.tokenize(written)]).tobytes()
        return found


class _Pieces(dict):
    """Ids of pieces by what follows their first space; unknown pieces are encoded on demand."""

    def __init__(self, tokenizer, kind: str) -> None:
        self.tokenizer, self.kind, self.words = tokenizer, kind, _Words(tokenizer.model, kind)
        self.added = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
        self.most = CACHE_SIZE

    def __missing__(self, rest: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        found = self[rest] = self.of(" " + rest)
        return found

    def of(self, piece: str) -> bytes:
        if piece.isalpha() if piece[:1] != " " else piece[1:].isalpha():
            return self.words[piece] if piece.isascii() or max(piece) < LATIN_END else self.whole(piece)
        if (not piece.isascii() and max(piece) >= LATIN_END) or ODD.search(piece) or any(a in piece for a in self.added):
            return self.whole(piece)
        return b"".join(map(self.words.__getitem__, PRE_TOKENS.findall(piece)))

    def whole(self, piece: str) -> bytes:
        return array(self.kind, self.tokenizer.encode_batch_fast([piece], add_special_tokens=False)[0].ids).tobytes()


class Encoder:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        small = tokenizer.get_vocab_size() <= 1 << 16
        self.dtype = "<u2" if small else "<u4"
        self.pieces = _Pieces(tokenizer, "H" if small else "I")
        #: Added tokens that reach over spaces: texts with one are not cut.
        self.wide = [t.content for t in tokenizer.get_added_tokens_decoder().values() if t.lstrip or t.rstrip or " " in t.content]

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of ``text``, as of the library's ``encode`` without special tokens; null and empty texts have none."""
        if not text:
            return np.zeros(0, self.dtype)
        if self.wide and any(content in text for content in self.wide):
            return np.frombuffer(self.pieces.whole(text), self.dtype)
        parts = text.split(" ")
        if _has_loose_space(text):
            parts = self._rejoined(parts)
        parts[0] = self.pieces.of(parts[0])
        parts[1:] = map(self.pieces.__getitem__, parts[1:])
        return np.frombuffer(b"".join(parts), self.dtype)

    @staticmethod
    def _rejoined(parts: list[str]) -> list[str]:
        """Pieces that end in white space are joined to the next one; all but the first without their first space."""
        out, open_piece = [], parts[0]
        for part in parts[1:]:
            if open_piece and not open_piece[-1].isspace():
                out.append(open_piece)
                open_piece = " " + part
            else:
                open_piece += " " + part
        out.append(open_piece)
        return [out[0], *[piece[1:] for piece in out[1:]]]
