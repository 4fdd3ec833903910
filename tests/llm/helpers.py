"""Small documents with the awkward rows every operator has to take."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, k long, t string, h string, row int, keys string"
WORDS = "ash birch cedar elm fir hazel larch maple oak pine rowan spruce willow yew alder beech".split()


def frame(spark, texts, ids=None):
    """Documents with extra columns whose names the operators use inside."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en" if t else None, "src", None if t is None else len(t), 1, "t", "h", 2, "keys") for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def awkward() -> list:
    return [None, "", "   ", "\n\t", "a", "a", "word", "é ü ß", "x" * 3000, "la la la la la la la la la la la la la la"]


def corpus(seed: int = 7, n: int = 40) -> list:
    rng = random.Random(seed)
    passage = prose(rng, 30)
    texts = []
    for i in range(n):
        text = prose(rng, rng.randrange(5, 60))
        if i % 3 == 0:
            text += " " + passage + " " + prose(rng, 4)
        if i % 11 == 10:
            text = texts[i - 5]
        if i % 13 == 12:
            words = texts[i - 3].split()
            words[len(words) // 2] = "changed"
            text = " ".join(words)
        texts.append(text)
    return texts + awkward()
