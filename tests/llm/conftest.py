import random

import pytest

from pageflow.llm.common import prepared

CLASHING = "kept boolean, key string, row int, tokens int, chunk int, words int, n_words string, component_id int"


@pytest.fixture(scope="session")
def llm(spark):
    return prepared(spark)


def corpus(seed: int, size: int) -> list[tuple]:
    """(doc_id, text): random prose, near copies, exact copies, shared passages, and every odd case."""
    rnd = random.Random(seed)
    words = [f"w{n}" for n in range(400)]
    base = [" ".join(rnd.choice(words) for _ in range(rnd.randint(30, 120))) for _ in range(size // 4)]
    passage = " ".join(f"p{n}" for n in range(60))
    texts = list(base)
    for text in base:
        own = text.split(" ")
        for at in rnd.sample(range(len(own)), len(own) // rnd.choice((8, 12, 30, 60))):
            own[at] = rnd.choice(words)
        texts += [" ".join(own), text.upper(), passage + "\n" + text if rnd.random() < 0.3 else text + " tail"]
    rows = list(enumerate(texts))
    rows += [(9001, None), (9002, ""), (9003, " \n\t "), (9004, "one"), (9005, "ONE"), (9006, "one two"), (9007, "Und " * 300),
             (9008, "a b " * 100), (None, base[0]), (None, None), (9009, " ".join(f"long{n % 9000}" for n in range(30_000))),
             (9010, "é " * 50 + "  漢字 \x00 x"), (9011, base[1]), (9011, base[1]), (9011, "another text of this id")]
    rnd.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def docs(llm):
    """A function making documents with columns whose names clash."""
    def make(rows):
        schema = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {CLASHING}"
        full = [(n, t, "en", None if n is None else f"s{(n or 0) % 3}", len(t or ""), True, "k", 1, 2, 3, 4, "5", 6) for n, t in rows]
        return llm.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def rows():
    return corpus(5, 80)


@pytest.fixture(scope="session")
def odd(docs, rows):
    return docs(rows).cache()


@pytest.fixture(scope="session")
def none(docs):
    return docs([])


def words_of(text):
    import re
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
