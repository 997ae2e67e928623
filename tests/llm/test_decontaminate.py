"""Template windows against a plain version, and re-parameterised questions."""

import pytest

from govlake.llm import decontaminate

ITEM = ("A train leaves the old station with 25 people and then Tom sells 10 kg of pears to Mary "
        "while Tom waits for the next train home today.")


@pytest.fixture(scope="module")
def bench(spark):
    rows = [(1, ITEM), (2, "short but telling words here"), (3, None), (4, ""), (5, "to be"), (6, ITEM.upper())]
    return spark.createDataFrame(rows, "item_id long, text string")


def found(docs, bench):
    return {(r.doc_id, r.item_id): r for r in decontaminate.report(docs, bench).collect()}


def test_values_may_change_but_only_together(docs_of, bench):
    other = ITEM.replace("25", "31").replace("Tom", "Ann").replace("Mary", "Bob").replace("10 kg", "7 km")
    mixed = ITEM.replace("Tom", "Ann", 1).replace("Tom", "Joe")
    got = found(docs_of([(10, f"Before it. {ITEM} After."), (11, f"x {other} y"), (12, mixed), (13, "A train left."),
                         (14, None), (15, ""), (16, "so short but telling words here it is"), (None, ITEM),
                         (10, f"Before it. {ITEM} After.")], extra=True), bench)
    assert got[10, 1].same_values and got[10, 1].coverage > .9
    assert not got[11, 1].same_values and got[11, 1].coverage > .9
    assert (12, 1) not in got
    assert got[16, 2].coverage == 1.0 and (None, 1) in got
    assert {d for d, _ in got} == {10, 11, 16, None}
    assert not any(i in (3, 4, 5) for _, i in got)


def plain_found(text, item):
    words, wanted = text.lower().split(), item.lower().split()
    best = 0
    for diagonal in range(-len(wanted), len(words)):
        covered = set()
        for k in range(len(wanted) - 7):
            at = k + diagonal
            if 0 <= at <= len(words) - 8 and words[at:at + 8] == wanted[k:k + 8]:
                covered |= set(range(k, k + 8))
        best = max(best, len(covered) / len(wanted))
    return best


def test_plain_words_against_brute_force(docs_of, spark, prose):
    clean = [" ".join(w.strip(".,\n").lower() for w in (t or "").split() if w.strip(".,\n").isalpha()) for t in prose]
    items = [(i, " ".join(t.split()[:30])) for i, t in enumerate(clean) if len(t.split()) >= 30][:10]
    docs = [(i, t) for i, t in enumerate(clean)]
    docs += [(500 + i, f"{clean[40]} {' '.join(t.split()[:20 - i])} {clean[41]}") for i, t in items]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {k: r.coverage for k, r in found(docs_of(docs), bench).items()}
    want = {(d, i): c for d, t in docs for i, b in items if (c := plain_found(t, b)) >= .5}
    assert got == pytest.approx(want)


def test_shuffled_join_gives_the_same(docs_of, bench, monkeypatch):
    docs = docs_of([(1, ITEM), (2, f"not here, {ITEM}")])
    wide = found(docs, bench)
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    assert found(docs, bench) == wide and wide


def test_stage_keeps_clean_documents(docs_of, bench, spark):
    docs = docs_of([(1, ITEM), (2, "clean words"), (None, ITEM), (None, "clean too"), (3, None), (2, "clean words")], True)
    kept = decontaminate.keep_clean(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "2", "3", "None"]
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.keep_clean(docs, none).count() == 6
    assert decontaminate.report(docs_of([]), bench).collect() == []


def test_long_lists_of_numbers_and_long_words(docs_of, bench):
    numbers = ",".join(map(str, range(60_000)))
    docs = docs_of([(1, f"{numbers} {ITEM} {numbers}"), (2, "x" * 500_000), (3, "1." * 100_000), (4, "$ " * 50_000 + ITEM)])
    assert {d for d, _ in found(docs, bench)} == {1, 4}


def test_values_of_other_lengths_and_edited_copies(docs_of, bench):
    docs = docs_of([(1, ITEM.replace("Tom", "Ann Lee")), (2, ITEM.replace("25", "1 000")),
                    (3, ITEM.replace("sells 10", "quickly sells 10")), (4, ITEM.replace("old ", "")),
                    (5, ITEM.replace("Tom", "Ann Lee", 1).replace("Tom", "Joe"))])
    got = found(docs, bench)
    assert {d for d, i in got if i == 1} == {1, 2, 3, 4}
    assert all(got[d, 1].coverage > .8 for d in (1, 2, 3, 4))


def test_a_long_passage_counts_whatever_its_share(docs_of, spark):
    words = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(59)]
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    docs = docs_of([(1, f"so {' '.join(words[10:35])} it"), (2, f"so {' '.join(words[10:22])} it")])
    assert {d for d, _ in found(docs, bench)} == {1}


def test_verbatim_copies_of_any_case_place_and_length(docs_of, spark):
    short, sums, han, few = "Copper rivers Sing softly", "What is 12 + 35?", "今天天气很好我们去公园", "Photosynthesis explained"
    rows = [(1, ITEM), (2, short), (3, sums), (4, han), (5, few), (6, "to be"), (7, "12 15 18 21 24 27 30 33 36 39")]
    bench = spark.createDataFrame(rows, "item_id long, text string")
    texts = [ITEM.lower(), ITEM.upper(), ITEM.title(), ITEM.replace(" ", "\n"), f"and then {short} again", sums.lower(),
             f"他说{han}吧", f"on {few}.", "to be or not", "12 15 18 21 24 27 30 33 36 39", "What is 12 + 36?"]
    got = found(docs_of(list(enumerate(texts, start=1))), bench)
    assert set(got) == {(1, 1), (2, 1), (3, 1), (4, 1), (5, 2), (6, 3), (7, 4), (8, 5), (10, 7)}
    assert all(r.same_values and r.coverage == 1.0 for r in got.values())


QUESTIONS = {
    "en": ("Every morning the baker sells 24 loaves to Anna, and in the evening he counts the 17 coins left in the drawer.",
           {"24": "310", "Anna": "Robert", "17": "5"}),
    "de": ("Jeden Morgen verkauft der Bäcker 24 Brote an die Kundin Anna und am Abend zählt der Bäcker die 17 Münzen in der Kasse.",
           {"24": "310", "Anna": "Petra", "17": "5"}),
    "fr": ("Chaque matin le boulanger vend 24 pains à Anna, puis le soir il compte les 17 pièces qui restent dans le tiroir.",
           {"24": "310", "Anna": "Claire", "17": "5"}),
    "es": ("Cada mañana el panadero vende 24 panes a Anna, y por la noche cuenta las 17 monedas que quedan en la caja.",
           {"24": "310", "Anna": "Lucía", "17": "5"}),
}


def test_changed_parameters_are_found_in_every_language(docs_of, spark, prose):
    """All questions with other values, inside other prose; and none where only common words agree."""
    bench = spark.createDataFrame([(i, q) for i, (q, _) in enumerate(QUESTIONS.values())], "item_id long, text string")
    rows = []
    for i, (question, values) in enumerate(QUESTIONS.values()):
        for old, new in values.items():
            question = question.replace(old, new)
        rows += [(i, f"{prose[i]} And so: {question} {prose[i + 1]}"), (100 + i, prose[i]),
                 (200 + i, "und die in der an am und der im ist ein 5 mit dem von zu auf für den")]
    got = found(docs_of(rows), bench)
    assert {(d, i) for d, i in got} == {(i, i) for i in range(4)}
    assert all(not r.same_values and r.coverage >= .5 for r in got.values())


def test_texts_longer_than_a_piece(docs_of, bench, prose):
    """Windows are cut in pieces; an item across the edge of two pieces is found wherever it starts."""
    filler = " ".join(["padding"] * (decontaminate.PIECE - 20))
    docs = [(k, f"{filler} {'more ' * k}{ITEM} {filler}") for k in range(0, 40, 3)]
    assert {d for d, _ in found(docs_of(docs), bench)} == {d for d, _ in docs}


def test_without_the_pair_test_the_same_is_found(docs_of, spark, bench, prose, monkeypatch):
    docs = docs_of([*enumerate(prose), (500, f"{prose[2]} {ITEM}"), (501, "What is 12 + 35 then"), (503, "使用 deep learning模型 of the new kind训练好了"), (502, "今天天气很好我们去公园")])
    more = bench.unionByName(spark.createDataFrame([(9, "12 + 35"), (12, "deep learning模型 of the new kind训练"), (10, "今天天气很好"), (11, " ".join((prose[5] or "x").split()[:20]))],
                                                   bench.schema))
    quick = found(docs, more)
    monkeypatch.setattr(decontaminate, "PAIRS", 0)
    assert found(docs, more) == quick and len(quick) >= 4
