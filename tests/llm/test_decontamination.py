"""Benchmark decontamination against plain Python."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from pageflow.llm import decontamination
from pageflow.llm.decontamination import contamination, decontaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def expected(docs, items, n=10):
    tests = {}
    for name, text in items:
        words = words_of(text)
        size = min(n, len(words))
        for at in range(len(words) - size + 1 if size else 0):
            tests.setdefault(tuple(words[at:at + size]), set()).add(name)
    sizes, out = {len(w) for w in tests}, []
    for name, text in docs:
        words, hit, found = words_of(text), set(), set()
        for size in sizes:
            for at in range(len(words) - size + 1):
                own = tests.get(tuple(words[at:at + size]))
                if own is not None:
                    hit |= set(range(at, at + size))
                    found |= own
        ids = sorted(str(i) for i in found - {None})
        out.append((name, len(words), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


ITEMS = [(7, "Alpha beta, gamma; delta! epsilon zeta eta theta iota kappa lambda mu nu xi"), (7, "another text of item seven one two three four five six"),
         (12, "Short one"), (3, "short ONE"), (30, "é漢 über"), (4, None), (5, ""), (6, " .,- \n"), (None, "nobody knows this item of ten words at all ok"),
         (8, "la " * 15), (9, "kappa lambda mu nu xi omicron pi rho sigma tau"), (9, "kappa lambda mu nu xi omicron pi rho sigma tau")]


def documents():
    rnd = random.Random(3)
    words = [f"w{k}" for k in range(50)] + words_of(ITEMS[0][1])
    rows = [(k, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 80)))) for k in range(60)]
    for k in range(60):
        passage = (rnd.choice([t for _, t in ITEMS if t]) + " ").upper().split(" ")
        at = rnd.randint(0, max(0, len(passage) - 11))
        rows.append((100 + k, f"{rows[k][1]} ({'--'.join(passage[at:at + rnd.randint(8, 14)])}) {rows[59 - k][1]}"))
    return rows + [(200, None), (201, ""), (202, "..."), (None, ITEMS[0][1]), (None, ITEMS[0][1]), (None, None), (203, "short one"), (203, "other"),
                   (204, "la " * 9), (205, "la " * 10), (206, "la " * 40), (207, "ÉÀ über É漢 über"), (208, "é漢 Über"), (209, "é漢 über"),
                   (210, "w1 " * 50_000 + ITEMS[0][1]), (211, "Nobody-knows.this item of ten words\tat all, OK?"), (212, "alpha\x00beta gamma delta epsilon zeta eta theta iota kappa"),
                   (213, "alpha beta gamma delta epsilon zeta eta theta iota kapp")]


@pytest.fixture(scope="module")
def items(llm):
    def make(rows):
        return llm.createDataFrame(rows, "item_id bigint, text string").withColumns(
            {"doc_id": F.lit(1), "spans": F.lit("x"), "words": F.lit(2), "n_words": F.lit("y")})

    return make


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_same_as_plain_python(docs, items):
    assert rows(contamination(docs(documents()), items(ITEMS))) == expected(documents(), ITEMS)


def test_blocks_and_pieces_give_the_same(docs, items, monkeypatch):
    """Test sets over the size sent at once take more passes; long items are cut into overlapping pieces."""
    monkeypatch.setattr(decontamination, "BLOCK", 150)
    monkeypatch.setattr(decontamination, "PIECE", 3)
    assert rows(contamination(docs(documents()), items(ITEMS))) == expected(documents(), ITEMS)


def test_hashes_alone_decide_nothing(docs, items, monkeypatch):
    """With hashes of two bits of the words' numbers, windows clash in the documents, and are told apart by their words."""
    real = decontamination.gram_hashes
    monkeypatch.setattr(decontamination, "gram_hashes", lambda hashes, n: real(hashes, n) >> 40)
    windows = decontamination.Windows([(str(k), words_of(t)) for k, t in ITEMS], 10)
    texts = [t for _, t in documents()]
    monkeypatch.setattr(decontamination, "words_of", words_of)
    windows.ids = {w: k for w, k in windows.ids.items()}
    found = decontamination.scanned(texts, windows)
    assert [(n, sum(b - a for a, b in spans)) for n, spans, _ in found] == [
        (n, hit) for text in texts for _, n, hit, *_ in expected([(0, text)], ITEMS)]


def test_without_documents_or_items(docs, none, items):
    assert rows(contamination(none, items(ITEMS))) == []
    assert rows(contamination(docs(documents()), items([]))) == expected(documents(), [])
    assert rows(contamination(docs(documents()), items([(1, None), (2, "-")]))) == expected(documents(), [])


def test_spans_or_documents_go(docs, items):
    given = [(1, "Keep this. Alpha, beta gamma delta epsilon zeta eta theta iota kappa! And -- this."), (2, None), (3, "clean"), (4, "é short ONE.")]
    cut = dict(map(tuple, decontaminated(docs(given), items(ITEMS)).collect()))
    assert cut == {1: "Keep this. ! And -- this.", 2: None, 3: "clean", 4: "é ."}
    assert sorted(r.doc_id for r in decontaminated(docs(given), items(ITEMS), "documents").collect()) == [2, 3]
    with pytest.raises(ValueError, match="choice"):
        decontaminated(docs(given), items(ITEMS), "words")
