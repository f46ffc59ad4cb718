"""Hashed word shingles of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

WORDS = 5

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_PLACE = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        _powers, _inverses = (np.concatenate([[np.uint64(1)], np.full(n, b, np.uint64)]).cumprod(dtype=np.uint64)
                              for b in (_BASE, _INVERSE))
    return _powers[:n], _inverses


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the number of the text it is in."""
    data = [t.encode() for t in texts]
    buf = np.frombuffer(b"\n".join(data) + b"\n", np.uint8)
    blank = (buf == 32) | ((buf >= 9) & (buf <= 13))
    buf = buf + np.where((buf >= 65) & (buf <= 90), np.uint8(32), np.uint8(0))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank]).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    powers, inverses = _tables(len(buf))
    run = np.concatenate([[np.uint64(0)], np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * powers, dtype=np.uint64)])
    hashes = mix((run[ends] - run[starts]) * inverses[starts] + (ends - starts).astype(np.uint64))
    text_ends = np.cumsum([len(d) + 1 for d in data])
    return hashes, np.searchsorted(text_ends, starts, side="right")


def shingle_rows(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, shingle) of every run of ``WORDS`` words, and of the
    whole sequence of a text with fewer words; repeats included."""
    hashes, text = _words(texts)
    n = np.bincount(text, minlength=len(texts))
    k = max(0, len(hashes) - WORDS + 1)
    full = text[:k] == text[WORDS - 1:] if k else np.zeros(0, bool)
    code = np.zeros(k, np.uint64)
    for j in range(WORDS):
        code += hashes[j:j + k] * _PLACE[j]
    out_text, out = [text[:k][full]], [mix(code[full])]
    short = np.flatnonzero((n > 0) & (n < WORDS))
    if len(short):
        first = np.concatenate([[0], np.cumsum(n)])[short]
        code = mix(n[short].astype(np.uint64))
        for j in range(WORDS - 1):
            has = n[short] > j
            code[has] += hashes[first[has] + j] * _PLACE[j]
        out_text.append(short)
        out.append(mix(code))
    return np.concatenate(out_text), np.concatenate(out)


def listed(code: np.ndarray, last: np.ndarray | None) -> np.ndarray:
    """Which shingles are in the sorted list. The list may be far longer than
    the shingles of one slice, so it is searched and not sorted again."""
    if last is None or not len(last):
        return np.zeros(len(code), bool)
    return last[np.minimum(np.searchsorted(last, code), len(last) - 1)] == code


def shingle_sets(texts: list[str], last: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle, place) of the distinct shingles, by text and
    shingle hash; the shingles listed in ``last`` (sorted) come after all
    others of a text. ``place`` counts from 0 in each text."""
    text, code = shingle_rows(texts)
    late = listed(code, last)
    order = np.lexsort((code, late, text))
    text, code = text[order], code[order]
    if len(code):
        new = np.concatenate([[True], (text[1:] != text[:-1]) | (code[1:] != code[:-1])])
        text, code = text[new], code[new]
    first = np.searchsorted(text, text)
    return text, code, np.arange(len(text)) - first
