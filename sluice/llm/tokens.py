"""Token ids of whole texts by a tokenizers file, with a cache of words.

A byte-level BPE never merges across the pieces its split pattern gives, so the ids of a text are the ids
of its pieces in a row. In texts of Latin letters the pieces are found on the UTF-8 bytes and looked up;
pieces not seen yet go to the tokenizer's model. Any other text, or a tokenizer of another kind, is encoded whole.
"""

from __future__ import annotations

import array
import re
import sys

import numpy as np

DEFAULT_FILE = "byte_bpe_50k.json"
CACHE_PIECES = 700_000

# The split pattern of byte-level tokenizers on UTF-8 bytes, right for texts of ASCII and the
# letters U+00C0 to U+017F, and a search for any other character.
SPLIT = re.compile(
    rb"[ ]?[A-Za-z\x80-\xff]++|'(?:s|t|re|ve|m|ll|d)|[ ]?[0-9]++|[ ]?[^\sA-Za-z0-9\x80-\xff]++|\s+(?!\S)|\s+"
)
OTHER = re.compile("[^\t\n\r -~À-ÖØ-öø-ſ]")


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level tokenizers write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(rest)}


BYTE_LETTERS = _byte_letters()


class Pieces(dict):
    """Ids of pieces met so far; a new piece goes to the tokenizer's model."""

    def __init__(self, model):
        self.model = model

    def __missing__(self, piece: bytes) -> bytes:
        made = self.model.tokenize(piece.decode("latin-1").translate(BYTE_LETTERS))
        self[piece] = ids = array.array("I", [token.id for token in made]).tobytes()
        return ids


_encoders: dict[str, "Encoder"] = {}


def tokenizer_path(name_or_path: str = DEFAULT_FILE) -> str:
    """A file's path as given, or the place of a public tokenizer's file on this machine."""
    if "/" in name_or_path:
        return name_or_path
    import public_tokenizers

    return public_tokenizers.path(name_or_path)


class Encoder:
    """Little-endian 32-bit ids of texts. Strings of special tokens in a text are ordinary text."""

    def __init__(self, path: str):
        import os

        from tokenizers import Tokenizer, models, pre_tokenizers

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        pre, model = self.tokenizer.pre_tokenizer, self.tokenizer.model
        self.by_word = (
            isinstance(pre, pre_tokenizers.ByteLevel)
            and not pre.add_prefix_space
            and self.tokenizer.normalizer is None
            and isinstance(model, models.BPE)
            and sys.byteorder == "little"
        )
        self.pieces = Pieces(model)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.by_word or OTHER.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if len(self.pieces) > CACHE_PIECES:
            self.pieces.clear()
        return b"".join(map(self.pieces.__getitem__, SPLIT.findall(text.encode())))


def encoder(path: str) -> Encoder:
    """The worker's encoder for a file; it lives as long as the worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
