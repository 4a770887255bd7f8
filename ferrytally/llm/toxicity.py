"""Toxicity by a weighted lexicon, matched by Aho-Corasick on folded text.

Folding undoes disguises: case, letters of other scripts that look Latin, and digits or signs that stand for
letters; i and l are one letter, as 1 stands for both. What is not a letter then separates words. Accents tell
words apart in many languages, so they stay; a word without its accents is compared with whole words only.

The lexicon is learned from labelled documents: words, and beginnings of words, that are far more frequent
in toxic documents than in clean ones, beyond chance, and stand after many different words, so that what copies of one text
share is not taken for toxic. Of a word and its beginnings the longest is kept that is found in (almost)
as many toxic documents as the shortest. A term weighs the log ratio of its rates. The density of a text
is the sum of the weights of its terms over its length; the score maps it to 0..1 so that the density that
separates the training documents best scores 0.7. Terms within an exception phrase do not count.

At most ``sample`` labelled documents per class are used to fit; every whole text is scored.

Defined results: null and empty texts score 0. Without toxic or without clean labels the lexicon is empty and all
scores are 0. A document with several labels is toxic if one says so; null labels and ids are not learned from.
Repeated rows are scored alike, each as a row of its own.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrytally.llm.common import map_arrow, table
from ferrytally.llm.labelled import held_out, per_class
from ferrytally.session import materialise

# Letters of other scripts that look like Latin ones, and signs that stand for letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h",
    "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ѵ": "v", "ԝ": "w", "ɡ": "g", "ı": "i", "ӏ": "l",
    "α": "a", "β": "b", "γ": "y", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "σ": "o",
    "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ø": "o", "ł": "l", "đ": "d", "ſ": "s",
}
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s"}
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "class clown", "idiot proof", "pond scum", "sore loser")


class _Folding(dict):
    """Translation table that works itself out, letter by letter."""

    def __missing__(self, code: int):
        char = chr(code).lower()
        char = HOMOGLYPHS.get(char, SIGNS.get(char, char))
        if char == "l":
            char = "i"
        if unicodedata.category(char[0]) in ("Mn", "Me", "Cf"):
            out = None  # marks and invisible signs
        else:
            out = char if char.isalpha() else " "
        self[code] = out
        return out


_FOLDING = _Folding()


def fold(text: str) -> list[str]:
    """The words in lower-case letters, without disguise."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    return text.translate(_FOLDING).split()


def bare(words: list[str]) -> list[str]:
    """The accented words without their accents."""
    return fold(unicodedata.normalize("NFKD", " ".join(w for w in words if not w.isascii())).encode("ascii", "ignore").decode())


@dataclass(frozen=True)
class Settings:
    sample: int = 10_000  # labelled documents per class that the lexicon is learned from, at most
    terms: int = 5_000  # of the lexicon's candidates, at most
    shortest: int = 4
    longest: int = 9
    least_docs: int = 5
    least_evidence: float = 24.0  # of the log-likelihood ratio that a term is as frequent in both classes; chance gives 24 once in a million
    least_weight: float = 2.5  # natural log of the ratio of rates
    least_ratio: float = 3.0  # of the shares of toxic and of clean documents that have a term
    least_places: float = 0.2  # different words before a term, of the toxic documents that have it
    held_folds: int = 3
    held_fold: int = 1
    cut: float = 0.7
    shortest_text: int = 20  # words added to every length, so that one word in a few is no proof
    exceptions: tuple[str, ...] = EXCEPTIONS


@dataclass(frozen=True)
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)  # a term ending in a blank is a whole word
    density: float = 1.0  # weight per word that scores the cut
    settings: Settings = Settings()

    def automaton(self) -> ahocorasick.Automaton | None:
        found = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            found.add_word(" " + term, (len(term) + 1, weight))
        for phrase in self.settings.exceptions:
            whole = f" {' '.join(fold(phrase))} "
            found.add_word(whole, (len(whole), None))
        found.make_automaton()
        return found if len(self.weights) else None

    def densities(self, texts: Iterator[str | None]) -> Iterator[float]:
        """Weight per word of each text."""
        automaton = self.automaton()
        for text in texts:
            words = fold(text or "") if automaton else []
            if not words:
                yield 0.0
                continue
            joined = f" {' '.join(words)} "
            matches = [(end - size + 1, end, weight) for end, (size, weight) in automaton.iter(joined)]
            safe = [(start, end) for start, end, weight in matches if weight is None]
            total = sum(
                weight for start, end, weight in matches
                if weight is not None and not any(a <= start and end <= b for a, b in safe)
            )
            if not joined.isascii():
                plain = f" {' '.join(bare(words))} "
                total += sum(w for end, (_, w) in automaton.iter(plain) if w is not None and plain[end] == " ")
            yield total / (len(words) + self.settings.shortest_text)

    def score(self, density: float) -> float:
        middle = self.density * (1 - self.settings.cut) / self.settings.cut
        return density / (density + middle) if density > 0 else 0.0


def _terms(settings: Settings):
    """The words of each text and their beginnings: how often, and the word before the first of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            terms, places, times, marks = [], [], [], []
            for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
                words = fold(text or "")
                first: dict[str, str] = {}
                for before, w in zip(["", *words], words):
                    first.setdefault(w, before)
                own: dict[str, list] = {"": ["", len(words)]}  # the empty term counts all words
                # A word said over and over counts once for each word before it.
                for w, n in Counter(w for _, w in set(zip(["", *words], words))).items():
                    if len(w) >= settings.shortest:
                        own[w + " "] = [first[w], n]
                        for k in range(settings.shortest, min(settings.longest, len(w)) + 1):
                            own.setdefault(w[:k], [first[w], 0])[1] += n
                terms.extend(own)
                places.extend(p for p, _ in own.values())
                times.extend(n for _, n in own.values())
                marks.extend([toxic] * len(own))
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), pa.array(places, pa.string()), pa.array(times, pa.int64()), pa.array(marks, pa.int64())],
                names=["term", "place", "times", "toxic"],
            )

    return run


def training_rows(docs: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """(text, toxic) of the labelled documents that are learned from; their ids are few and are broadcast."""
    named = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(
        F.max("toxic").cast("bigint").alias("toxic")
    )
    free = named.filter(~held_out(F.col("doc_id"), settings.held_folds, settings.held_fold))
    chosen = per_class(free, "toxic", "doc_id", settings.sample).select(F.col("doc_id").alias("__id"), "toxic")
    return docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("__id")).select("text", "toxic")


def learn(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Lexicon:
    rows = training_rows(docs, labels, settings)
    bad = F.col("toxic") == 1
    placed = map_arrow(rows, _terms(settings), "term string, place string, times bigint, toxic bigint").groupBy("term", "place").agg(
        F.count_if(bad).alias("docs"), F.count_if(~bad).alias("others"), F.coalesce(F.sum(F.when(bad, F.col("times"))), F.lit(0)).alias("bad"),
        F.coalesce(F.sum(F.when(~bad, F.col("times"))), F.lit(0)).alias("good"),
    )
    counted = materialise(placed.groupBy("term").agg(
        F.sum("docs").alias("docs"), F.sum("others").alias("others"), F.sum("bad").alias("bad"), F.sum("good").alias("good"), 
        F.count_if(F.col("docs") > 0).alias("places"),
    ).filter((F.col("docs") >= settings.least_docs) | (F.col("term") == "")))
    every = counted.filter("term = ''").first()
    if not every or not every["bad"] or not every["good"]:
        return Lexicon(settings=settings)
    weight = F.log((F.col("bad") + 0.5) / every["bad"]) - F.log((F.col("good") + 0.5) / every["good"])
    # Twice the log-likelihood ratio of shares that differ to equal ones: more documents admit more terms.
    toxic, clean = float(every["docs"]), float(every["others"])
    both = F.col("docs") + F.col("others")

    def evidence(n: Column, share: float) -> Column:
        return F.when(n > 0, n * F.log(n / (both * share))).otherwise(0.0)

    proof = 2 * (evidence(F.col("docs"), toxic / (toxic + clean)) + evidence(F.col("others"), clean / (toxic + clean)))
    wide = F.col("places") >= F.greatest(F.lit(settings.least_docs), F.col("docs") * settings.least_places)
    more = F.col("docs") / every["docs"] >= settings.least_ratio * F.col("others") / max(every["others"], 1)
    found = counted.filter((F.col("docs") >= settings.least_docs) & (proof >= settings.least_evidence) & wide & more & (F.col("term") != "")).withColumn("weight", weight)
    best = found.filter(F.col("weight") >= settings.least_weight).orderBy(F.desc("docs"), "term").limit(settings.terms).collect()
    lexicon = Lexicon(choose({r["term"]: (r["docs"], r["weight"]) for r in best}), 1.0, settings)
    return Lexicon(lexicon.weights, _calibrated(rows, lexicon), settings)


def choose(candidates: dict[str, tuple[int, float]]) -> dict[str, float]:
    """Of a term and its continuations the longest that almost as many toxic documents have."""
    kept: dict[str, float] = {}
    for term in sorted(candidates, key=len):
        shorter = [term[:k] for k in range(1, len(term)) if term[:k] in kept]
        if not shorter:
            kept[term] = candidates[term][1]
        elif candidates[term][0] >= 0.95 * candidates[shorter[-1]][0]:
            del kept[shorter[-1]]
            kept[term] = candidates[term][1]
    return kept


def _calibrated(rows: DataFrame, lexicon: Lexicon) -> float:
    """The density between those of clean and toxic training texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = list(lexicon.densities(b.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([b.column("toxic"), pa.array(found, pa.float64())], names=["toxic", "density"])

    # At most two classes of ``sample`` numbers.
    found = sorted((r["density"], r["toxic"]) for r in map_arrow(rows, run, "toxic bigint, density double").collect())
    return separating([d for d, _ in found], [t for _, t in found])


def separating(densities: list[float], toxic: list[int]) -> float:
    """The positive density with the best F1 as a lower bound of toxic ones, midway to the next lower; inputs ascend."""
    d, t = np.array(densities), np.array(toxic)
    above = np.cumsum(t[::-1])[::-1]  # toxic ones from here on
    f1 = 2 * above / (np.arange(len(d), 0, -1) + t.sum())
    f1[d <= 0] = 0
    f1[1:][d[1:] == d[:-1]] = 0  # a cut falls between different values
    best = int(f1.argmax())
    if not f1[best]:
        return 1.0
    below = d[best - 1] if best and d[best - 1] > 0 else d[best] / 4
    return float(np.sqrt(below * d[best]))


def scored(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, held_out, score and prediction of every row."""
    settings = lexicon.settings

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = np.array([lexicon.score(d) for d in lexicon.densities(b.column("text").to_pylist())], np.float64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(values)], names=["doc_id", "score"])

    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return map_arrow(narrow, run, f"doc_id {kind}, score double").select(
        "doc_id", held_out(F.col("doc_id"), settings.held_folds, settings.held_fold).alias("held_out"), "score",
        (F.col("score") >= settings.cut).cast("int").alias("predicted"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scored(docs, learn(docs, table(spark, sf_dir, "labels")))
