"""SimHash fingerprints of word shingles, for whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrytally.llm.common import map_arrow

SEED = 42
CHUNK = 1 << 16  # shingles whose bits are counted at once


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """The 64-bit hashes of a text's shingles, in order.

    A-Z are lower-cased, words are separated by ASCII blanks. A text with fewer words than a shingle
    is one shingle; without words there is none.
    """
    w = text.lower().split()
    if not w:
        return np.empty(0, np.uint64)
    runs = zip(*[w[k:] for k in range(shingle)]) if len(w) >= shingle else [w]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(b" ".join(r), SEED) for r in runs), np.uint64)


def simhash(text: bytes, shingle: int, words: int = 1) -> list[int]:
    """The fingerprint of one text in ``words`` signed 64-bit words; 0 without words."""
    return fingerprint(shingle_hashes(text, shingle), words)


def fingerprint(hashes: np.ndarray, words: int = 1) -> list[int]:
    """Bit 1 where over half of the hashes have it, in signed words. Words after the first use a mixture of the hash."""
    if not len(hashes):
        return [0] * words
    out = []
    for word in range(words):
        ones = np.zeros(64, np.int64)
        for at in range(0, len(hashes), CHUNK):
            part = hashes[at:at + CHUNK]
            if word:
                part = (part ^ (part >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15 + 2 * word)
                part ^= part >> np.uint64(29)
            part = part.astype("<u8").view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out.append(int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0]))
    return out


def fingerprinted(docs: DataFrame, keys: dict[str, Column], text: str, shingle: int, words: int = 1) -> DataFrame:
    """``keys`` and the fingerprint ``fp0``, ``fp1`` ... (bigint) of each text; null counts as empty."""
    narrow = docs.select(*[c.alias(n) for n, c in keys.items()], F.coalesce(F.col(text), F.lit("")).cast("binary").alias("__text"))
    names = list(keys)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema if f.name != "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [simhash(t.as_py(), shingle, words) for t in b.column("__text")]
            values = [pa.array([f[i] for f in found], pa.int64()) for i in range(words)]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(n) for n in names], *values], names=[*names, *fingerprint_columns(words)]
            )

    return map_arrow(narrow, run, ", ".join([kept, *[f"{n} bigint" for n in fingerprint_columns(words)]]))


def fingerprint_columns(words: int) -> list[str]:
    return [f"fp{i}" for i in range(words)]
