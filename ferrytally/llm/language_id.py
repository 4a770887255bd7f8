"""Language identification by prediction by partial matching.

For each language a tree of byte contexts of up to ``ORDER`` bytes is counted on at most
``sample`` documents. The code length of a byte comes from the longest context that the tree knows; where
the byte never followed it, an escape is paid and the next shorter context is asked, down to a uniform
code (escape method C). Trees are frozen, so code lengths are worked out once, for every context and byte of the sample, and a
text is scored by looking up all its bytes; a byte that no language knows in its context costs the escapes of every
length. All 256 byte values and all contexts are kept. The language with the shortest code wins; the score is its posterior
probability under equal priors.

Bound, a parameter: documents per language. The model has a row for each run of up to ``ORDER`` + 1 bytes in the sample and a
column for each language. Every whole text is scored.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is every text if nothing
could be learned. Ties go to the first language in alphabetic order. Repeated rows and null ids are rows
like any other; documents without a language or id are not learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrytally.llm.common import map_arrow, table
from ferrytally.llm.labelled import held_out, per_class

ORDER = 3
UNKNOWN = "und"
CHUNK = 1 << 20  # bytes scored at once

#: Bytes after folding: ASCII letters in lower case, all other ASCII a blank, the rest as it is.
_FOLD = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


@dataclass(frozen=True)
class Settings:
    sample: int = 500  # documents per language that are learned from, at most
    held_folds: int = 4
    held_fold: int = 2


def folded(text: str) -> bytes:
    return b" ".join(text.lower().encode("utf-8", "replace").translate(_FOLD).split())


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def _padded(text: str) -> np.ndarray:
    return np.frombuffer(b" " * ORDER + folded(text) + b" ", np.uint8)


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each run of ORDER + 1 bytes occurs, per language and batch."""
    for b in batches:
        parts: dict[str, list[np.ndarray]] = {}
        for text, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist()):
            if text and has_letter(text):
                a = _padded(text).astype(np.uint32)
                parts.setdefault(lang, []).append((a[:-3] << 24) | (a[1:-2] << 16) | (a[2:-1] << 8) | a[3:])
        langs, grams, counts = [], [], []
        for lang, found in parts.items():
            values, n = np.unique(np.concatenate(found), return_counts=True)
            langs.extend([lang] * len(values))
            grams.append(values.astype(np.int64))
            counts.append(n.astype(np.int64))
        yield pa.RecordBatch.from_arrays([
            pa.array(langs, pa.string()), pa.array(np.concatenate(grams) if grams else [], pa.int64()),
            pa.array(np.concatenate(counts) if counts else [], pa.int64()),
        ], names=["lang", "gram", "n"])


@dataclass(frozen=True)
class Model:
    """Frozen trees of all languages. Each of ``levels`` holds the contexts of one length, longest first."""

    languages: list[str] = field(default_factory=list)
    levels: tuple[Level, ...] = ()

    def code_lengths(self, text: str) -> tuple[np.ndarray, int]:
        """Bits per language, and the number of bytes."""
        data = _padded(text)
        total = np.zeros(len(self.languages))
        for at in range(ORDER, len(data), CHUNK):
            s = data[at - ORDER:at + CHUNK].astype(np.uint32)
            runs = (s[:-3] << 24) | (s[1:-2] << 16) | (s[2:-1] << 8) | s[3:]
            for level in self.levels:
                paid, runs = level.paid(runs)
                total += paid
            total += 8.0 * len(runs)
        return total, len(data) - ORDER

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not text or not has_letter(text):
            return UNKNOWN, 0.0
        bits, _ = self.code_lengths(text)
        odds = np.exp2(np.maximum(bits.min() - bits, -1000.0))
        return self.languages[int(bits.argmin())], float(1 / odds.sum())


@dataclass(frozen=True)
class Level:
    """Contexts of one length: what followed them, and what an escape from them costs."""

    mask: int  # the bytes of a run that are the context and the byte after it
    runs: np.ndarray  # sorted; the context and a byte that followed it in any language
    bits: np.ndarray  # (run, language): the whole code length, with the escapes of a language that knows less
    contexts: np.ndarray  # sorted
    escapes: np.ndarray  # (context, language); nothing where a language does not know the context

    def paid(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bits per language of the bytes that are found here and of the escapes, and the runs that go on to shorter contexts."""
        at, known = _found(self.runs, runs & np.uint32(self.mask))
        on = runs[~known]
        context, left = _found(self.contexts, (on & np.uint32(self.mask)) >> np.uint32(8))
        return _summed(self.bits, at[known]) + _summed(self.escapes, context[left]), on


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    return at, (keys[at] == wanted) if len(keys) else np.zeros(len(wanted), bool)


def _summed(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The sum of the rows named, without a copy larger than the table."""
    if len(at) <= len(table):
        return table[at].sum(axis=0, dtype=np.float64)
    return np.bincount(at, minlength=len(table)) @ table.astype(np.float64)


def _level(lang: np.ndarray, gram: np.ndarray, n: np.ndarray, size: int, length: int, shorter: list[Level]) -> Level:
    """Contexts of ``length`` bytes, given the levels of shorter ones, the longest of them first."""
    mask = (1 << 8 * (length + 1)) - 1
    runs, row = np.unique((gram & mask).astype(np.uint32), return_inverse=True)
    contexts, of = np.unique(runs >> np.uint32(8), return_inverse=True)
    counts = np.bincount(row * size + lang, weights=n, minlength=len(runs) * size).reshape(-1, size)
    total, kinds = np.zeros((len(contexts), size)), np.zeros((len(contexts), size))
    np.add.at(total, of, counts)
    np.add.at(kinds, of, counts > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        # A language that does not know a context goes on for nothing.
        escapes = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
        seen = -np.log2(counts / (total + kinds)[of])
    if shorter:
        # Every run of this level has its end in the next shorter one.
        below = shorter[0].bits[np.searchsorted(shorter[0].runs, runs & np.uint32(shorter[0].mask))]
    else:
        below = np.full(counts.shape, 8.0)
    bits = np.where(counts > 0, seen, escapes[of] + below)
    return Level(mask, runs, bits.astype(np.float32), contexts, escapes.astype(np.float32))


def build(rows: list[tuple[str, int, int]]) -> Model:
    """The frozen model from counts of four-byte runs per language."""
    if not rows:
        return Model()
    languages = sorted({r[0] for r in rows})
    number = {name: i for i, name in enumerate(languages)}
    lang = np.array([number[r[0]] for r in rows])
    gram = np.array([r[1] for r in rows], np.int64)
    n = np.array([r[2] for r in rows], np.float64)
    levels: list[Level] = []
    for length in range(ORDER + 1):
        levels.insert(0, _level(lang, gram, n, len(languages), length, levels))
    return Model(languages, tuple(levels))


def learn(docs: DataFrame, settings: Settings = Settings()) -> Model:
    named = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "lang").distinct()
    free = named.filter(~held_out(F.col("doc_id"), settings.held_folds, settings.held_fold))
    chosen = per_class(free, "lang", "doc_id", settings.sample).select(F.col("doc_id").alias("__id"), F.col("lang").alias("__lang"))
    rows = docs.select("doc_id", "lang", "text").join(
        F.broadcast(chosen), (F.col("doc_id") == F.col("__id")) & (F.col("lang") == F.col("__lang"))
    ).select("lang", F.col("text").cast("string").alias("text"))
    counts = map_arrow(rows, _grams, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # Bounded by the byte runs of the sample; the driver holds the model, not texts.
    return build([tuple(r) for r in counts.orderBy("lang", "gram").collect()])


def identified(docs: DataFrame, model: Model, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    # Bounded by the sample: a row for each run of bytes in it, a column for each language.
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, [tuple(vars(level).values()) for level in model.levels]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, levels = shared.value
        known = Model(languages, tuple(Level(*level) for level in levels))
        for b in batches:
            found = [known.predict(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return map_arrow(narrow, run, f"doc_id {kind}, lang_pred string, score double").select(
        "doc_id", held_out(F.col("doc_id"), settings.held_folds, settings.held_fold).alias("held_out"), "lang_pred", "score"
    )


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identified(docs, learn(docs))
