"""Words of texts as 64-bit hashes with their places, for any set of word bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from twinledger.llm import common


@dataclass(frozen=True)
class Words:
    """Words of some texts in order: hashes, first and end byte of each, and the number of words of each text."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    counts: np.ndarray


def hashed_words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, lower: bool) -> Words:
    """Runs of the bytes that ``is_word`` marks, none of which reaches into the next text; ``lower`` takes A-Z as a-z.

    A hash is a polynomial over random byte values, the same wherever the word stands, made out of prefix sums.
    """
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, none, np.zeros(len(offsets) - 1, np.int64))
    word = is_word[data]
    first = np.zeros(n + 1, dtype=bool)
    first[offsets] = True
    before = np.concatenate([[False], word[:-1]])
    after = np.concatenate([word[1:], [False]])
    starts = np.flatnonzero(word & (~before | first[:n]))
    ends = np.flatnonzero(word & (~after | first[1:])) + 1
    values = common._BYTE_VALUES if lower else common._RANDOM
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values[data] * common._power("up", common.MULTIPLIER, n), out=sums[1:])
    down = common._power("down", pow(common.MULTIPLIER, -1, 2**64), n)
    hashes = common.mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return Words(hashes, starts, ends, np.diff(np.searchsorted(starts, offsets)))
