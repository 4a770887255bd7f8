"""Documents that operators must not stumble over, with columns named like their own."""

import random

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, shard int, slot string, fp bigint, "
    "__row string, __weights string, start int, n bigint, rate double, k string"
)


def words(rng, n, letters="abcdefgh"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(n))


def texts():
    rng = random.Random(3)
    base = words(rng, 80)
    other = words(rng, 60)
    passage = words(rng, 50)
    return [
        base, base, base + " tail", other, f"{words(rng, 20)} {passage} {words(rng, 20)}", f"{passage} {words(rng, 30)}",
        f"{words(rng, 9)} {passage}", None, "", "   \n\t ", "one", "one two", "One two", "éß 世界 \U0001f600 ok",
        "loop " * 200, words(rng, 5000), passage, f"{passage} {passage}", "a b c d e", "A\x0bB\x0cC D",
    ]


def rows():
    made = [
        (i, t, ["en", "de", None][i % 3], ["s0", "s0", "s1", None][i % 4], len(t or ""), 1, "x", 2, "r", "w", 3, 4, 0.5, "k")
        for i, t in enumerate(texts())
    ]
    null_ids = [(None, texts()[0], "en", "s0", 1, 1, "x", 2, "r", "w", 3, 4, 0.5, "k"), (None, None, None, None, None, *[None] * 9)]
    return made + null_ids + [made[3], made[3]]


def frame(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
