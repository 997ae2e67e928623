import random

import pytest

from govlake.llm import shared


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    shared.ship(spark)


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with the other columns and some that clash."""

    def make(rows, extra=False):
        kind = "doc_id long, text string, lang string, source string, n_chars long"
        data = [(i, t, "en", "src", len(t or "")) for i, t in rows]
        if extra:
            kind += ", fp long, score string, part int, words string, count int, key string, fingerprint int"
            data = [(*r, 1, "x", 2, "y", 3, "z", 4) for r in data]
        return spark.createDataFrame(data, kind)

    return make


@pytest.fixture(scope="session")
def prose():
    """Texts of invented words: some odd ones, copies, near copies and a long one."""
    rnd = random.Random(11)
    bits = "th er on an re he in ed nd ha en es of nt ti le que sch ung ê ß ó".split()
    common = "the of and to in a is it".split()

    def word():
        return rnd.choice(common) if rnd.random() < .35 else "".join(rnd.choices(bits, k=rnd.randint(2, 4)))

    def text(n):
        return " ".join(word() + rnd.choice(["", "", "", ",", ".\n"]) for _ in range(n))

    plain = [text(rnd.randint(5, 120)) for _ in range(60)]
    near = []
    for t in plain[:12]:
        words = t.split(" ")
        words[rnd.randrange(len(words))] = "changed"
        near.append(" ".join(words))
    odd = [None, "", "   \n", "one", "The", "A a A a A a", "x" * 3000, "<|endoftext|> a<|endoftext|>",
           "mixed\x1c\x85 spaces here", "数字と文字 12 🙂", "Ǆ ß İ ª", text(6000)]
    return plain + near + plain[:6] + odd
