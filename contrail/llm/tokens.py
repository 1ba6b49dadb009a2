"""Token ids of single words, exactly as the tokenizers library gives them for whole texts.

The vocabulary used here cuts a text at white space before anything else: normalisation, contractions and merges never
look across it. So the ids of a text are the ids of its words at ASCII white space, one after the other. Most
words consist of Latin letters, digits and signs; their parts are found by the vocabulary's own pattern and given
straight to the library's merge model. Any other word goes through the library whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import lru_cache

import numpy as np

from contrail.llm.arrays import give_back

CACHED = 500_000  # entries a task keeps (about 100 MB); when full it starts anew, so memory does not grow with the text
PLAIN = re.compile(r"[\x21-\x7eÀ-ÖØ-öø-įı-ſ]+")  # letters that lower-case to one letter, and printable ASCII
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^a-zß-öø-ſ0-9]+")
NO_CACHE_ABOVE = 64  # bytes of a word


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@lru_cache(maxsize=4)
def _library(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@lru_cache(maxsize=1)
def _letters() -> dict[int, str]:
    """Byte-level alphabet: printable bytes stand for themselves, the others for the characters from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}


class Words(dict):
    """Ids by word, as little-endian unsigned 32-bit numbers; remembers a bounded number of words."""

    def __init__(self, path: str):
        super().__init__()
        self.library = _library(path)
        self.special = tuple(t.content for t in self.library.get_added_tokens_decoder().values())
        self.parts: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            plain = part if part.isascii() else part.encode().decode("latin-1").translate(_letters())
            found = np.array([t.id for t in self.library.model.tokenize(plain)], "<u4").tobytes()
            if len(self.parts) >= CACHED:
                self.parts.clear()
            self.parts[part] = found
        return found

    def _word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            return b"".join(map(self._part, PARTS.findall(text.lower())))
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, word: bytes) -> bytes:
        found = self._word(word)
        if len(word) <= NO_CACHE_ABOVE:
            if len(self) >= CACHED:
                self.clear()
            self[word] = found
        return found

    def forget(self) -> None:
        """At the end of a task: its worker may next run something else that needs the memory."""
        self.clear()
        self.parts.clear()

    def text(self, words: Iterable[bytes]) -> bytes:
        return b"".join(map(self.__getitem__, words))


@lru_cache(maxsize=2)
def words_of(path: str) -> Words:
    """One for each worker process and vocabulary."""
    return Words(path)


def unload() -> None:
    """At the end of a task that reads many texts: the vocabulary goes too, and is loaded again by the next task."""
    words_of.cache_clear()
    _library.cache_clear()
    give_back()


@lru_cache(maxsize=2)
def pieces(path: str) -> tuple[bytes, ...]:
    """The id-to-piece table: as many rows as the vocabulary has."""
    library = _library(path)
    size = 1 + max(library.get_vocab(with_added_tokens=True).values())
    return tuple((library.id_to_token(i) or "").encode() for i in range(size))
