"""Small tables with the awkward cases: nulls, empty and long texts, copies, repeated rows, extra columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, text_key string, digest string, pack string, score string, lang_pred string, component_id string"


def rows(seed: int = 1, n: int = 120):
    rnd = random.Random(seed)
    vocabulary = {"en": ["the", "and", "thing", "water", "Over", "would"], "fr": ["éau", "les", "être", "aux", "ça", "deux"]}
    passage = " ".join(rnd.choice(vocabulary["en"]) + str(rnd.randint(0, 99)) for _ in range(70))
    out = []
    for i in range(n):
        lang = rnd.choice(["en", "fr"])
        text = " ".join(rnd.choice(vocabulary[lang]) + rnd.choice(["", "x", "ing", "s"]) for _ in range(rnd.randint(1, 120)))
        if i % 6 == 1 and out and out[-1][1]:
            words = out[-1][1].split(" ")
            if len(words) > 30:
                words[len(words) // 2] = "changed"
            text, lang = " ".join(words), out[-1][2]
        if i % 10 == 3:
            text = f"{text} {passage} {i}"
        if i % 15 == 4:
            text += f' api_key = "{rnd.getrandbits(80):020x}" AKIA{"ABCD1234" * 2} end'
        out.append([i, text, lang])
    out[7][1] = None
    out[8][1] = ""
    out[9][1] = "12 34 --- 56"
    out[10][2] = None
    out[11][1] = "word " * 20_000
    out[12][1] = "a" * 900
    out[13][1] = out[3][1]
    out[14][1] = "one two"
    out[15][1] = "one  TWO"
    out[16][1] = "it's <|endoftext|> they'r" + "e' ré" * 30
    out.append(list(out[3]))
    return [(i, t, lang, "src", len(t or ""), "k", "t", "d", "p", "s", "l", "c") for i, t, lang in out]


def table(spark, seed: int = 1, n: int = 120):
    return spark.createDataFrame(rows(seed, n), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
