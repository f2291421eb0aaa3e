import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, node string, size int"


@pytest.fixture(scope="session")
def corpus(spark):
    """Documents with copies, near copies, nulls, empty and long texts, two languages, a toxic word, and columns with odd names."""
    r = random.Random(11)
    words = {"en": [a + b for a in "the an wh st er in".split() for b in "ing ed ly or at on".split()], "fr": [a + b for a in "éau que ment les".split() for b in "eux oi ai tion".split()]}
    rows = []
    for k in range(160):
        lang = "en" if k % 3 else "fr"
        t = " ".join(r.choice(words[lang]) for _ in range(r.randrange(5, 60)))
        if k % 4 == 0:
            t += " idiot moron scum"
        if k % 10 in (5, 7):
            t, lang = rows[-1][1] + " more" * (k % 10 == 7), rows[-1][2]
        rows.append((k, t.capitalize(), lang, "s", len(t), "k", None, 1))
    rows += [(200, None, None, None, None, None, None, None), (201, "", "en", "s", 0, "k", "n", 1), (202, " \n ", "en", "s", 3, "k", "n", 1), (203, "12 + 7!", "fr", "s", 6, "k", "n", 1)]
    rows += [(204, "ying " * 9000 + "end", "en", "s", 1, "k", "n", 1), (205, "One two", "en", "s", 1, "k", "n", 1), (206, "one TWO", None, "s", 1, "k", "n", 1)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def nothing(corpus):
    return corpus.limit(0)
