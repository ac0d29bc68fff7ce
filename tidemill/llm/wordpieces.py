"""Token ids by a public tokenizer, one pre-token at a time with a cache.

The tokenizer drops white space and merges within pre-tokens only, so a text's ids are its pre-tokens' ids
one after another. Words of plain Latin letters, digits and signs are split here as the tokenizer's
own pattern splits them, and each new pre-token goes through the tokenizer's model once; any other
word goes through the whole tokenizer. Both give the ids that the whole text has.
"""

from __future__ import annotations

import re

import numpy as np

#: Letters and digits of Latin-1; in it, composition changes nothing and lower case is one letter for one.
LETTER, DIGIT = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾"
PRE_TOKEN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{DIGIT}]|[^{LETTER}{DIGIT}\\x20\\x09-\\x0D]+")
WHITE = re.compile("[\\x20\\x09-\\x0D]+")
OTHER = re.compile("[^\\x20\\x09-\\x0D!-~¡-¬®-ÿ]")
#: Pre-tokens that a worker remembers; beyond that it starts anew.
CACHE = 1 << 20


class WordTokenizer:
    """encode_bytes(text): the ids as little-endian unsigned 32-bit numbers."""

    _shared: dict[str, WordTokenizer] = {}

    @classmethod
    def shared(cls, path: str | None = None) -> WordTokenizer:
        """One for each Python worker and vocabulary."""
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("word_bpe_49k.json")
        if path not in cls._shared:
            cls._shared[path] = cls(path)
        return cls._shared[path]

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.pieces: dict[str, bytes] = {}
        keep = [*range(33, 127), *range(161, 173), *range(174, 256)]  # the byte alphabet of byte-level vocabularies
        rest = [b for b in range(256) if b not in keep]
        self.alphabet = {b: b for b in keep} | {b: 256 + i for i, b in enumerate(rest)}

    def _piece(self, piece: str) -> bytes:
        if (got := self.pieces.get(piece)) is None:
            mapped = piece.encode().decode("latin-1").translate(self.alphabet)
            got = np.array([t.id for t in self.tok.model.tokenize(mapped)], "<u4").tobytes()
            if len(self.pieces) >= CACHE:
                self.pieces.clear()
            self.pieces[piece] = got
        return got

    def _plain(self, text: str) -> bytes:
        get, piece = self.pieces.get, self._piece
        return b"".join([get(p) or piece(p) for p in PRE_TOKEN.findall(text.lower())])

    def _word(self, word: str) -> bytes:
        if OTHER.search(word) or any(s in word for s in self.special):
            return np.array(self.tok.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        return self._plain(word)

    def encode_bytes(self, text: str) -> bytes:
        if OTHER.search(text) or any(s in text for s in self.special):
            return b"".join([self._word(w) for w in WHITE.split(text) if w])
        return self._plain(text)
