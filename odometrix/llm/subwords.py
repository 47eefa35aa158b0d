"""Subword ids of whole texts, with a bounded per-worker cache of words.

White space is always a boundary for ``word_bpe_49k.json``, so a text's ids are
the ids of its white-space separated words, one after the other. Words are
encoded once per worker and kept (``MAX_WORDS`` at most, then the cache starts
anew: results never hang on it). ``encode_text`` gives the same ids as the
unaltered tokenizer does for the whole text, ``encode`` those of a text whose
special-token strings are ordinary text; tests/llm compares both.
"""

from __future__ import annotations

import re
import struct
import unicodedata
from functools import lru_cache

MAX_WORDS = 600_000
VOCABULARY = "word_bpe_49k.json"

_TAIL = re.compile(rb"(?<=[a-z0-9])[!-/:-@\[-`{-~]+$")
_PLAIN = re.compile(r"[a-z]+")


def tokenizer_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE's printable stand-in for every byte."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in keep]
    return {b: chr(b) for b in keep} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Known(dict):
    """Ids of the words met so far; a missing word is encoded on its lookup."""

    def __init__(self, encode, most: int):
        super().__init__()
        self.encode, self.most = encode, most

    def __missing__(self, word: bytes) -> bytes:
        ids = self.encode(word)
        if len(self) >= self.most:
            self.clear()
        self[word] = ids
        return ids


class WordEncoder:
    """``get(word)``: the little-endian 32-bit ids of one lower-cased word (UTF-8)."""

    def __init__(self, path: str, max_words: int = MAX_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.known = _Known(self._encode, max_words)
        # Strings of the vocabulary that a text may hold as ids of their own.
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.path = path
        self.whole = None

    def _pack(self, ids) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def _one_piece(self, word: str) -> str | None:
        """The word as the byte-level model takes it, if it is one piece: letters
        only, in composed form, lower-cased letter by letter."""
        if _PLAIN.fullmatch(word):
            return word
        if word.isalpha() and unicodedata.is_normalized("NFC", word):
            low = word.lower()
            if low == word or low.isalpha() and low == "".join(c.lower() for c in word):
                return low.encode().decode("latin-1").translate(self.letters)
        return None

    def _encode(self, word: bytes) -> bytes:
        tail = _TAIL.search(word)
        if tail and b"'" not in word:  # letters or digits, then marks: two pieces
            return self.get(word[: tail.start()]) + self.get(tail.group())
        text = word.decode("utf-8", "replace")
        piece = self._one_piece(text)
        if piece is not None:
            return self._pack([t.id for t in self.model.tokenize(piece)])
        return self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def ends_word(self, size: int):
        """Which of the first ``size`` ids close a word."""
        import numpy as np

        names = (self.tokenizer.id_to_token(i) or "" for i in range(size))
        return np.fromiter((t.endswith("</w>") for t in names), bool, size)

    def get(self, word: bytes) -> bytes:
        return self.known[word]

    def encode(self, text: str) -> bytes:
        """The ids of a whole text, as little-endian unsigned 32-bit numbers."""
        return self.encode_words(text.encode("utf-8", "replace").lower().split())

    def encode_words(self, words: list[bytes]) -> bytes:
        """``get`` of all ``words``, one after the other."""
        return b"".join(map(self.known.__getitem__, words))

    def encode_text(self, text: str) -> bytes:
        """The ids that the unaltered tokenizer gives a whole text: as ``encode``,
        but a special token's string in it becomes that token."""
        if not any(s in text for s in self.special):
            return self.encode(text)
        if self.whole is None:
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(self.path)
        return self._pack(self.whole.encode(text, add_special_tokens=False).ids)


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """One encoder per worker process and vocabulary."""
    return WordEncoder(path)
