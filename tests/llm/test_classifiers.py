"""Toxicity, language and licences: held-out accuracy and odd inputs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ferrytally.llm import language_id, licenses, toxicity
from ferrytally.llm.common import table
from tests.llm import odd

LABELS = "doc_id bigint, quality int, toxic int"
INSULTS = ["moron", "scumbag", "loathsome", "vermin"]


@pytest.fixture(scope="module")
def insulted(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(400):
        w = odd.words(rng, rng.randint(30, 120), "abcdefghnrst").split()
        if i % 4 == 0:
            for k in range(0, len(w), 12):
                w[k] = rng.choice(INSULTS)
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(i % 4 == 0)))
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, LABELS)


@pytest.fixture(scope="module")
def lexicon(insulted):
    return toxicity.learn(*insulted)


def test_toxicity_held_out(insulted, lexicon):
    docs, labels = insulted
    got = toxicity.scored(docs, lexicon).join(labels, "doc_id").filter("held_out").collect()
    assert len(got) > 80 and all(r["predicted"] == r["toxic"] for r in got)
    assert all((r["score"] >= 0.7) == bool(r["predicted"]) and 0 <= r["score"] <= 1 for r in got)
    assert set(lexicon.weights) <= {toxicity.fold(w)[0][:k] + e for w in INSULTS for k in range(4, 10) for e in ("", " ")}


@pytest.mark.parametrize("word", ["moron", "MORON", "m0r0n", "mоrоn", "mórón", "m​oron", "ｍｏｒｏｎ"])
def test_disguises(lexicon, word):
    text = f"you {word} and {word} again"
    assert lexicon.score(next(lexicon.densities([text]))) >= 0.7


def test_exceptions_and_length():
    known = toxicity.Lexicon({"trash ": 5.0}, 0.05)
    phrase, bare, long = known.densities(["put it in the trash can", "this is trash", "this is trash" + " word" * 500])
    assert phrase == 0 and bare > 10 * long > 0


def test_toxicity_uses_no_held_out_label(insulted):
    docs, labels = insulted
    settings = toxicity.Settings()
    from pyspark.sql import functions as F

    flipped = labels.withColumn("toxic", F.when(
        toxicity.held_out(F.col("doc_id"), 3, 1), 1 - F.col("toxic")
    ).otherwise(F.col("toxic")))
    assert toxicity.learn(docs, flipped, settings) == toxicity.learn(docs, labels, settings)


def test_toxicity_odd(spark, lexicon):
    got = toxicity.scored(odd.frame(spark), lexicon).collect()
    assert len(got) == len(odd.rows()) and all(r["score"] == 0 for r, o in zip(got, odd.rows()) if not (o[1] or "").strip())
    labels = spark.createDataFrame([(0, 1, 1), (None, 1, 1), (1, 1, None)], LABELS)
    assert toxicity.learn(odd.frame(spark), labels).weights == {}
    nothing = toxicity.learn(odd.empty(spark), spark.createDataFrame([], LABELS))
    assert [r["score"] for r in toxicity.scored(odd.frame(spark), nothing).collect()] == [0.0] * len(odd.rows())
    assert toxicity.scored(odd.empty(spark), nothing).collect() == []


def slow_bits(counts, text, lang):
    """Code length by walking the contexts of every byte, one after the other."""
    data = b"   " + language_id.folded(text) + b" "
    total = 0.0
    for i in range(3, len(data)):
        paid = 0.0
        for order in (3, 2, 1, 0):
            context = data[i - order:i]
            seen = {}
            for (l, gram), n in counts.items():
                g = gram.to_bytes(4, "big")
                if l == lang and g[3 - order:3] == context:
                    seen[g[3]] = seen.get(g[3], 0) + n
            if not seen:
                continue
            whole = sum(seen.values()) + len(seen)
            if data[i] in seen:
                paid -= np.log2(seen[data[i]] / whole)
                break
            paid -= np.log2(len(seen) / whole)
        else:
            paid += 8.0
        total += paid
    return total


def test_code_lengths_are_those_of_the_tree():
    texts = {"en": "the cat sat on the mat and the rat", "de": "der hund und die katze sind müde", "fr": "le chat est là"}
    counts = {}
    for lang, text in texts.items():
        data = b"   " + language_id.folded(text) + b" "
        for i in range(len(data) - 3):
            key = (lang, int.from_bytes(data[i:i + 4], "big"))
            counts[key] = counts.get(key, 0) + 1
    model = language_id.build([(l, g, n) for (l, g), n in counts.items()])
    for text in ("the dog sat", "die müde katze", "zzz qqq", "là", "кот 世"):
        bits, _ = model.code_lengths(text)
        want = [slow_bits(counts, text, lang) for lang in model.languages]
        assert bits == pytest.approx(want, rel=1e-5)


def test_ten_scripts(spark):
    """Every script's bytes are told apart, also those of languages with few documents, and languages of one script."""
    rng = random.Random(21)
    starts = {"el": 0x3b1, "ru": 0x430, "uk": 0x430, "he": 0x5d0, "ar": 0x627, "hi": 0x915, "th": 0xe01, "ka": 0x10d0, "ko": 0xac00, "zh": 0x4e00}
    # A language of twenty words over letters of its script; Ukrainian and Russian share theirs.
    words = {lang: ["".join(chr(start + rng.randrange(16)) for _ in range(rng.randint(2, 6))) for _ in range(20)] for lang, start in starts.items()}
    text = lambda lang, n: " ".join(rng.choice(words[lang]) for _ in range(n))
    rows = [(i, text(lang, 12), lang) for i, lang in enumerate(lang for lang in starts for _ in range(400 if lang == "zh" else 12))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language_id.learn(docs)
    assert model.languages == sorted(starts)
    got = language_id.identified(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert [r["doc_id"] for r in got if r["lang"] != r["lang_pred"]] == []


def test_language_held_out(spark, sf):
    docs = table(spark, sf, "documents")
    got = language_id.identified(docs, language_id.learn(docs)).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.95 * len(got) and len(got) > 20


def test_language_odd(spark):
    docs = odd.frame(spark)
    model = language_id.learn(docs)
    assert set(model.languages) <= {"en", "de"}
    got = language_id.identified(docs, model).collect()
    assert len(got) == len(odd.rows())
    for r, o in zip(got, odd.rows()):
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in o[1] or "")) and 0 <= r["score"] <= 1
    none = language_id.learn(odd.empty(spark))
    assert {r["lang_pred"] for r in language_id.identified(docs, none).collect()} == {"und"}
    assert language_id.identified(odd.empty(spark), none).collect() == []


def test_licences(spark):
    rng = random.Random(9)
    notices = [(f, t) for f, texts in licenses.TEMPLATES.items() for t in texts]
    rows, want = [], []
    for i in range(200):
        lines = [odd.words(rng, rng.randint(5, 30)) for _ in range(4)]
        if i % 3 == 0:
            family, notice = notices[i // 3 % len(notices)]
            at = rng.randrange(4)
            lines[at] = notice.upper() if i % 2 else notice
            want.append((i, at, family))
        rows.append((i, "\n".join(lines)))
    rows += [(900, None), (901, ""), (None, "Released under the MIT License."), (902, "All rights reserved."), (902, "All rights reserved.")]
    want += [(None, 0, "mit"), (902, 0, "all-rights-reserved"), (902, 0, "all-rights-reserved")]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).filter("confirmed").collect()
    assert sorted(((r["doc_id"], r["paragraph"], r["family"]) for r in got), key=str) == sorted(want, key=str)


def test_licences_odd(spark):
    assert licenses.scan(odd.frame(spark)).filter("confirmed").collect() == []
    assert licenses.scan(odd.empty(spark)).collect() == []


def test_a_common_notice_is_reported(spark):
    """The footer of every third document, in more paragraphs than any common word may be in."""
    rng = random.Random(14)
    rows = []
    for i in range(300):
        lines = [odd.words(rng, 12) for _ in range(3)] + (["Released under the MIT License."] if i % 3 == 0 else [])
        rows.append((i, "\n".join(lines)))
    got = licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).filter("confirmed").collect()
    assert sorted((r["doc_id"], r["family"]) for r in got) == [(i, "mit") for i in range(0, 300, 3)]


def test_a_wrapped_notice_is_reported(spark):
    """A notice over several lines, in a run of lines after blank ones; a notice in one line stays one row."""
    rng = random.Random(15)
    rows = [(i, f"{odd.words(rng, 12)}\n{odd.words(rng, 9)}") for i in range(60)]
    gpl, mit = licenses.TEMPLATES["gpl-3.0"][1].split(), licenses.TEMPLATES["mit"][1]
    wrapped = "\n".join(" ".join(gpl[k:k + 7]) for k in range(0, len(gpl), 7))
    rows += [(100, f"{odd.words(rng, 9)}\n\n \n{wrapped}\n\n{odd.words(rng, 9)}"), (101, f"{odd.words(rng, 9)}\n{mit}\n{odd.words(rng, 9)}")]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).filter("confirmed").collect()
    assert sorted((r["doc_id"], r["paragraph"], r["family"]) for r in got) == [(100, 3, "gpl-3.0"), (101, 1, "mit")]


def test_every_document_trains_the_license_model(spark):
    """Beyond the 2,000 documents that once were all it learned from, a line like a notice is common: it is none."""
    rng = random.Random(21)
    ids = [r[0] for r in spark.range(3000).orderBy(F.xxhash64("id"), "id").collect()]
    rows = [(i, odd.words(rng, 8)) for i in ids[:2000]] + [(i, "Released under the MIT label.") for i in ids[2000:]]
    rows.append((5000, "Licensed under CC BY 4.0."))
    got = licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert [(r["doc_id"], r["family"]) for r in got] == [(5000, "cc-by-4.0")]


def test_rare_toxic_words_are_learned(spark):
    """A word in 1.5 % of the toxic documents and in no clean one."""
    rng = random.Random(16)
    rows = [(i, odd.words(rng, 12, "abcdefghnrst")) for i in range(6000)]
    toxic = [i for i in range(6000) if i % 2]
    rare = set(rng.sample(toxic, 45))
    rows = [(i, f"{t} scumbag {odd.words(rng, 5)}" if i in rare else t) for i, t in rows]
    labels = spark.createDataFrame([(i, 1, i % 2) for i, _ in rows], LABELS)
    weights = toxicity.learn(spark.createDataFrame(rows, "doc_id bigint, text string"), labels).weights
    assert weights and all("scumbag".startswith(w.strip()) for w in weights)
