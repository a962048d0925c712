"""Words of a batch of texts as integers, with pyarrow's vectorised string functions."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(words per text, all words in order), A-Z lower-cased, split at [\\x20\\x09-\\x0D]+.

    pyarrow's ``ascii_*`` functions know exactly these characters. A null text
    has no words.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    offsets = lists.offsets.to_numpy()
    flat = lists.flatten()
    real = pc.not_equal(flat, "")
    kept = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    bounds = kept[offsets - offsets[0]]
    return np.diff(bounds), flat.filter(real)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(words per text, a 64-bit hash of each word in order); no hash is 0."""
    counts, flat = split_words(texts)
    coded = flat.dictionary_encode()
    names = coded.dictionary.to_numpy(zero_copy_only=False)
    hashes = pd.util.hash_array(names, categorize=False) if len(names) else np.empty(0, np.uint64)
    hashes = np.maximum(hashes, np.uint64(1))
    return counts, hashes[coded.indices.to_numpy()] if len(flat) else np.empty(0, np.uint64)


def mixed(a: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the finaliser of MurmurHash3)."""
    a = a ^ (a >> np.uint64(33))
    a = a * np.uint64(0xFF51AFD7ED558CCD)
    a = a ^ (a >> np.uint64(33))
    a = a * np.uint64(0xC4CEB9FE1A85EC53)
    return a ^ (a >> np.uint64(33))


def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ordered pairs."""
    return mixed(a * np.uint64(0x9E3779B97F4A7C15) + mixed(b))
