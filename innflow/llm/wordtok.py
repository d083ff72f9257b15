"""Token ids of whole texts by a public word-level BPE file, each distinct pre-token run through BPE once.

The tokenizer file (``word_bpe_49k.json``) composes (NFC), lower-cases,
cuts a text into pre-tokens (contractions, runs of letters, single digits,
runs of other signs; white space is dropped) and runs BPE inside each.
Pre-tokens repeat far more often than texts, so their ids are kept in a
bounded per-worker table; a text's ids are those of its pre-tokens in order.
A full table becomes the older of two, and what is looked up again moves back
from it, so frequent pre-tokens stay and the others go with the next turn.
The tables only save work: ids never depend on what they hold.

The cut is made here only for texts of ASCII and Latin-1 letters, where NFC
is the identity and the letter classes are plain; any other text (and any
text that spells a special token) goes through the tokenizer whole.  Tests
compare both ways with ``Tokenizer.encode``.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

CACHED_PIECES = 400_000
_PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")
# The file's own pre-token pattern for lower-cased plain text is 's|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+. Runs of letters
# are what lies between white space and the others, so only these (a contraction, a digit or a run of signs) are looked for.
_SIGNS = re.compile(r"([^\sa-zß-öø-ÿ](?:(?<=')(?:s|t|re|ve|m|ll|d)|(?<![0-9])[^\sa-z0-9ß-öø-ÿ]*|))")


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a lower-cased plain text, in order."""
    return " ".join(_SIGNS.split(text)).split()


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_signs() -> list[str]:
    """The public byte-level alphabet: printable bytes stand for themselves, the others get U+0100 upwards in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


class _Pieces(dict):
    """pre-token -> its ids as uint32 bytes; a miss looks into the older table, then runs BPE."""

    def __init__(self, model, older: dict[str, bytes]):
        super().__init__()
        self.tokenize = model.tokenize
        self.signs = _byte_signs()
        self.older = older

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            signs = self.signs
            spelled = piece if piece.isascii() else "".join([signs[b] for b in piece.encode()])
            ids = array("I", [t.id for t in self.tokenize(spelled)]).tobytes()
        self[piece] = ids
        return ids


class WordEncoder:
    """``ids(text)`` as a uint32 array, equal to the tokenizer's without added special tokens."""

    def __init__(self, path: str, cached_pieces: int = CACHED_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces = _Pieces(self.tokenizer.model, {})
        self.cached_pieces = cached_pieces
        self.enders: np.ndarray | None = None

    def ids(self, text: str, after: bytes = b"") -> np.ndarray:
        """The text's ids, then those of ``after`` (uint32 bytes)."""
        if _PLAIN.fullmatch(text) is None or any(m in text for m in self.marks):
            return np.frombuffer(array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes() + after, dtype=np.uint32)
        if len(self.pieces) > self.cached_pieces:
            self.pieces.older = {}
            self.pieces = _Pieces(self.tokenizer.model, self.pieces)
        return np.frombuffer(b"".join([*map(self.pieces.__getitem__, pre_tokens(text.lower())), after]), dtype=np.uint32)

    def sentence_enders(self) -> np.ndarray:
        """Flag per id: the token is punctuation that ends a sentence (holds one of . ! ? and no letter or digit)."""
        if self.enders is None:
            vocab = self.tokenizer.get_vocab(with_added_tokens=True)
            flags = np.zeros(max(vocab.values()) + 1, dtype=bool)
            for token, i in vocab.items():
                sign = token.removesuffix("</w>")
                flags[i] = token.endswith("</w>") and any(c in sign for c in ".!?") and not any(c.isalnum() for c in sign)
            self.enders = flags
        return self.enders


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a tokenizer file (loaded once per Python worker)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
