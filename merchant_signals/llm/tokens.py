"""Token ids of whole texts with the public vocabulary files, each distinct piece encoded once per worker.

``word_bpe_49k`` drops white space before it splits, and none of its tokens spans white space, so a text's ids are
those of its pieces between ASCII white space, one after another.  A piece that NFC could join to its neighbour does
not exist: no composition takes a space.
"""

from __future__ import annotations

import sys
from array import array

if sys.byteorder != "little" or array("I").itemsize != 4:
    raise ImportError("ids are written as little-endian 32-bit integers")

#: Entries of a worker's cache; a full cache becomes the older half, whose entries come back when asked for.
CACHE_ENTRIES = 400_000

_encoders: dict[str, "PieceEncoder"] = {}


def _byte_characters() -> list[str]:
    """The characters that byte-level vocabularies write for bytes: printable Latin-1 ones stand for themselves, the
    others follow from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class _Pieces(dict):
    """Piece -> its ids as little-endian unsigned 32-bit integers; a missing one is encoded and kept."""

    def __init__(self, tokenizer) -> None:
        self.tokenizer, self.model, self.letters = tokenizer, tokenizer.model, _byte_characters()
        self.older: dict[bytes, bytes] = {}

    def __missing__(self, piece: bytes) -> bytes:
        if (ids := self.older.get(piece)) is not None:
            self[piece] = ids
            return ids
        body = piece[:-1] if piece[-1] in b".," else piece
        if body.isalpha():  # ASCII letters: one run, the model alone decides
            ids = array("I", [t.id for t in self.model.tokenize(body.decode().lower())]).tobytes()
            if body is not piece:
                ids += self[piece[-1:]]
        else:
            ids = self._other(piece)
        if len(piece) <= 64:
            self[piece] = ids
        return ids

    def _other(self, piece: bytes) -> bytes:
        text = piece.decode()
        low = text.lower()
        if low.isalpha() and max(text) < "\u0100":  # composed already
            own = "".join([self.letters[b] for b in low.encode()])
            return array("I", [t.id for t in self.model.tokenize(own)]).tobytes()
        if low[:-1].isalpha() and low[-1] in ".," and max(text) < "\u0100":
            return self[piece[:-1]] + self[piece[-1:]]
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


class PieceEncoder:
    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.pieces = _Pieces(Tokenizer.from_file(path))

    def encode(self, text: bytes) -> bytes:
        """The text's ids as little-endian unsigned 32-bit integers."""
        if len(self.pieces) > CACHE_ENTRIES:
            self.pieces.older = dict(self.pieces)
            self.pieces.clear()
        return b"".join(map(self.pieces.__getitem__, text.split()))

    def forget(self) -> None:
        """Give the cache's memory back: workers outlive their tasks."""
        self.pieces.clear()
        self.pieces.older = {}


def encoder(path: str) -> PieceEncoder:
    """The worker's own encoder of a vocabulary file."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def forget() -> None:
    """Empty the caches of this worker's encoders."""
    for e in _encoders.values():
        e.forget()


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def tokenizer_paths() -> tuple[str, str]:
    """The byte-level vocabulary and the sentence pieces that are aligned."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
