"""Token ids of whole texts, by the tokenizers library.

Both supported vocabularies cut a text into pre-tokens at spaces, so the ids
of a text are the ids of its blank-separated chunks in a row. A worker keeps
the ids of chunks it has met (a bounded memo), which leaves the merge loop to
new chunks only. Texts where the cut at blanks is not certain to fall between
pre-tokens, or that contain the text of an added token, are encoded whole.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

MEMO_ENTRIES = 500_000
MEMO_CHUNK_CHARS = 64  # longer chunks are encoded each time, so the memo's size in bytes is bounded

_DOUBLE_BLANK = re.compile(r"\s\s")
_SEPARATORS = re.compile("[\x1c-\x1f]")

# Byte-level vocabularies write a byte that is no printable Latin-1 character
# as the next unused code point from 256 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_CHARS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
BLANK_CHAR = chr(BYTE_CHARS[32])
BARE = "\x00"


class ChunkEncoder:
    """``spaced`` vocabularies keep blanks as part of the following word
    (byte level); the others drop white space and lower-case."""

    def __init__(self, path: str, spaced: bool):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        # both vocabularies look for them in the text as it is, before any normalisation
        self.added = sorted(t.content for t in self.tok.get_added_tokens_decoder().values())
        self.spaced = spaced
        self.tokenize = self.tok.model.tokenize  # of one pre-token; the attribute copies the model, so it is read once
        self.memo = Memo(self.learn, MEMO_ENTRIES // 2)
        self.tails: dict[str, bytes] = {}

    def _encode(self, chunks: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in self.tok.encode_batch_fast(chunks, add_special_tokens=False)]

    def _chunks(self, text: str) -> list[str] | None:
        """Chunks of a text; None: encode it whole. Of a ``spaced``
        vocabulary a chunk stands for a blank and the word after it, and one
        that begins with ``BARE`` for itself."""
        if any(t in text for t in self.added):
            return None
        if not self.spaced:
            return None if _SEPARATORS.search(text) else text.split()
        if BARE in text or _DOUBLE_BLANK.search(text):
            return None
        out: list[str] = []
        for i, line in enumerate(text.split("\n")):
            if i:
                out.append(BARE + "\n")
            words = line.split(" ")
            if words[0]:
                words[0] = BARE + words[0]
                out += words
            else:
                out += words[1:]
        return out

    def _text(self, chunk: str) -> str:
        if not self.spaced:
            return chunk
        return chunk[1:] if chunk[:1] == BARE else " " + chunk

    def learn(self, chunk: str) -> bytes:
        """Ids of a chunk the memo lacks. Letters, or letters and a run of
        stops or commas, are looked up pre-token by pre-token (a pre-token
        never spans letters and punctuation); the rest goes through the whole
        pipeline."""
        spaced = self.spaced
        key = chunk.rstrip(".,")
        word = key[1:] if spaced and key[:1] == BARE else key
        # one pre-token in both vocabularies, unchanged by composition and lower-cased letter by letter
        if not (word.isalpha() and (word.isascii() or (max(word) < "\u0180" and "\u0130" not in word))):
            return self._encode([self._text(chunk)])[0]
        if len(key) < len(chunk):
            return self.memo[key] + self._tail(chunk[len(key):])
        if not spaced:
            word = word.lower()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(BYTE_CHARS)
        if spaced and key[:1] != BARE:
            word = BLANK_CHAR + word
        return array("I", [t.id for t in self.tokenize(word)]).tobytes()

    def _tail(self, tail: str) -> bytes:
        if tail not in self.tails:
            if len(self.tails) > 1000:
                self.tails.clear()
            self.tails[tail] = self._encode([tail])[0]
        return self.tails[tail]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        out, get = [], self.memo.__getitem__
        for text in texts:
            chunks = self._chunks(text)
            out.append(self._encode([text])[0] if chunks is None else b"".join(map(get, chunks)))
        return out


class Memo(dict):
    """Ids of chunks met. At ``limit`` entries it becomes the older half and a
    new one begins, so chunks in use stay."""

    def __init__(self, learn, limit: int):
        self.learn, self.limit, self.older = learn, limit, {}

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            ids = self.learn(chunk)
        if len(chunk) <= MEMO_CHUNK_CHARS:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[chunk] = ids
        return ids


_ENCODERS: dict[tuple[str, bool], ChunkEncoder] = {}


def encoder(path: str, spaced: bool) -> ChunkEncoder:
    """One encoder per worker process and vocabulary."""
    key = (path, spaced)
    if key not in _ENCODERS:
        _ENCODERS[key] = ChunkEncoder(path, spaced)
    return _ENCODERS[key]


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
