"""A small, awkward table of documents: NULLs in every column, empty and very long texts, ties, repeated rows, odd columns."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, key string, root long, score string, "
          "size string, bits string, block string, kept string, turn string, label string")
EXTRA = ("k", 7, "s", "z", "b", "c", "n", "t", "l")
random.seed(5)
WORDS = ["".join(random.choice("abcdefghijklmnop") for _ in range(random.randint(2, 9))) for _ in range(400)]


def prose(words, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(words))


LONG = "\n".join(prose(300, 100 + i) for i in range(60))
BASE = prose(120, 1)
DOCUMENTS = [
    (1, BASE, "en", "a", 3),
    (2, BASE, "en", "a", 3),
    (2, BASE, "en", "a", 3),
    (3, BASE.replace(" ", "  \t"), "en", None, None),
    (4, None, None, "a", None),
    (5, "", "en", "b", 0),
    (6, " \n\t ", None, None, 1),
    (7, LONG, "en", "b", len(LONG)),
    (8, "x", "fr", "c", 1),
    (9, "??? 123 ...", "fr", "c", 1),
    (None, BASE, "en", "a", 1),
    (None, prose(50, 2), None, "b", 1),
    (None, prose(50, 2), None, "b", 1),
    (10, prose(80, 3) + "\n" + prose(80, 4), "de", "c", 5),
    (11, prose(80, 3) + "\n" + prose(80, 5) + "\n\n" + prose(80, 3), "de", "c", 5),
    (12, prose(90, 6), "de", "d", 5),
    (12, prose(90, 7), "de", "d", 5),
    (13, "日本語のテキスト と Ελληνικά и русский " + prose(20, 8), "el", "é", 5),
]


def documents(spark):
    return spark.createDataFrame([(*d, *EXTRA) for d in DOCUMENTS], SCHEMA).repartition(3)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
