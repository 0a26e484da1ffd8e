import random
from collections import Counter

import numpy as np
import pytest

from faresettle.llm import decontaminate as d

ITEMS = "item_id long, text string, score string, word string"


def benchmark(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], ITEMS)


def make_index(rows):
    words = [d.words_of(t) for _, t in rows if d.words_of(t)]
    counts = Counter(w for x in words for w in set(x))
    return d.Index.build(rows, counts, len(words), max(1.0, sum(map(len, words)) / max(1, len(words))))


def slow_scores(index, terms):
    """The score of every item, adding up all postings."""
    total = np.zeros(len(index.ids))
    for t in terms:
        for k in range(index.begin[t], index.begin[t + 1]):
            total[index.items[k]] += index.impacts[k]
    return total


def random_items(seed, count=90, vocabulary=60):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(vocabulary)]
    return [(k, " ".join(rng.choices(words, weights=range(vocabulary, 0, -1), k=rng.randrange(3, 25)))) for k in range(count)]


@pytest.mark.parametrize("threshold", [0.2, 0.5, 0.9])
def test_block_max_wand_finds_all_above_the_threshold(threshold):
    index = make_index(random_items(1))
    rng = np.random.default_rng(2)
    for _ in range(150):
        terms = rng.choice(len(index.terms), rng.integers(0, 30), replace=False)
        expected = slow_scores(index, terms)
        found = dict(index.retrieve(terms, threshold))
        assert set(found) == set(np.flatnonzero(expected >= threshold - 1e-9).tolist())
        assert all(abs(expected[i] - v) < 1e-9 for i, v in found.items())


def test_windows_are_searched_unless_their_bounds_are_too_low():
    index = make_index(random_items(3))
    rng = random.Random(4)
    texts = [[rng.choice(list(index.terms) + ["none"] * 40) for _ in range(rng.randrange(0, 300))] for _ in range(20)]
    firsts = np.cumsum([0] + [len(t) for t in texts])
    found = {(t, at - firsts[t], item) for t, at, item, _ in index.candidates([w for t in texts for w in t], firsts)}
    expected = set()
    half = index.window // 2
    for t, words in enumerate(texts):
        for at in range(0, max(min(1, len(words)), -(-len(words) // half) * half - half), half):
            terms = sorted({index.terms[w] for w in words[at : at + index.window] if w in index.terms})
            expected |= {(t, at, int(i)) for i in np.flatnonzero(slow_scores(index, terms) >= d.THRESHOLD - 1e-9)}
    assert found == expected


def test_own_text_scores_one():
    rows = random_items(5, 30)
    index = make_index(rows)
    for k, (_, text) in enumerate(rows):
        assert dict(index.retrieve(np.array(sorted({index.terms[w] for w in d.words_of(text)}))))[k] == pytest.approx(1)


@pytest.mark.parametrize(
    ("text", "question", "answer"),
    [
        ("What is it? A cat.", "what is it", "a cat"), ("Name it. Answer: a dog", "name it answer", "a dog"), ("One. Two words. Three here.", "one two words", "three here"),
        ("only one", "only one", ""), ("one sentence.", "one sentence", ""), ("", "", ""),
    ],
)
def test_question_and_answer(text, question, answer):
    assert d.question_and_answer(text) == (question.split(), answer.split())


QUESTION = "Which of the seven rivers of the old kingdom flows backwards every spring? It is the river of glass and salt."


def test_question_and_answer_must_both_be_there(spark, documents):
    question, answer = QUESTION.split("? ")
    filler = " ".join(f"filler{k}" for k in range(500))
    rows = [
        (1, f"{filler} {QUESTION} {filler}"), (2, f"{filler} {question} {filler}"), (3, f"{filler} {answer} {filler}"), (4, QUESTION.upper().replace(" ", "\n")),
        (5, QUESTION.replace("seven", "eight")), (6, filler), (None, QUESTION), (7, None), (8, ""), (1, f"{filler} {QUESTION} {filler}"), (9, f"{filler} " * 100 + QUESTION),
    ]
    items = benchmark(spark, [(70, QUESTION), (71, "Another item with words of its own. And an answer."), (72, None), (73, ""), (None, QUESTION), (70, QUESTION)])
    out = d.find_leaks(documents(rows), items).collect()
    assert sorted((r["doc_id"] or -1, r["item_id"]) for r in out) == [(-1, 70), (1, 70), (1, 70), (4, 70), (9, 70)]
    kept = d.keep_clean(documents(rows), items)
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 5, 6, 7, 8] and kept.columns == documents(rows).columns


def test_empty_tables(spark, documents):
    assert d.find_leaks(documents([]), benchmark(spark, [(1, QUESTION)])).count() == 0
    assert d.find_leaks(documents([(1, "x")]), benchmark(spark, [])).count() == 0
    assert d.find_leaks(documents([(1, "x")]), benchmark(spark, [(1, "?!"), (2, None)])).count() == 0
    assert d.keep_clean(documents([(1, "x")]), benchmark(spark, [])).count() == 1


def test_several_indexes_give_the_same(sf):
    docs, items = sf("documents", "0.01"), sf("benchmark", "0.01")
    one = sorted(tuple(r) for r in d.find_leaks(docs, items).collect())
    many = sorted(tuple(r) for r in d.find_leaks(docs, items, index_words=200).collect())
    assert [x[:2] for x in one] == [x[:2] for x in many] and np.allclose([x[2:] for x in one], [x[2:] for x in many])


def test_table_against_all_pairs(sf):
    """A document leaks an item if it holds its shingles; found by looking at every window of every document for every item."""
    docs, items = sf("documents", "0.01"), sf("benchmark", "0.01")
    found = {(r["doc_id"], r["item_id"]) for r in d.find_leaks(docs, items).collect()}
    parts = [(r["item_id"], *map(d.shingles, d.question_and_answer(r["text"]))) for r in items.collect()]
    expected = set()
    for r in docs.collect():
        words = d.words_of(r["text"])
        held = {size: d.shingles(words, size) for size in range(1, d.SHINGLE_WORDS + 1)}
        for item, *wanted in parts:
            if all(len(s & held[len(next(iter(s)))]) >= d.OVERLAP * len(s) for s in wanted if s):
                expected.add((r["doc_id"], item))
    assert found == expected


def test_edited_copies_of_items_without_a_marked_answer(spark, documents):
    item = " ".join(f"word{k}" for k in range(40)) + ". The end is short here."
    rows = [(1, item.replace("short", "long")), (2, item), (3, " ".join(item.split()[:25])), (4, item.split(". ")[1])]
    out = d.find_leaks(documents(rows), benchmark(spark, [(70, item)])).collect()
    assert sorted(r["doc_id"] for r in out) == [1, 2]
    marked = item.replace(". The", "? The")
    rows = [(1, marked.replace("short", "long")), (2, marked)]
    assert [r["doc_id"] for r in d.find_leaks(documents(rows), benchmark(spark, [(70, marked)])).collect()] == [2]


def test_an_index_grows_with_its_postings():
    rows = [(k, " ".join(f"t{k}x{j}" for j in range(12)) + " common") for k in range(5000)]
    index = make_index(rows)
    assert len(index.terms) == 60_001
    assert sum(x.nbytes for x in vars(index).values() if isinstance(x, np.ndarray)) < 100 * len(index.items)
    words = d.words_of(rows[4321][1])
    assert [(t, i) for t, i, *_ in index.matches(["none " * 50 + rows[4321][1], "common " * 30])] == [(0, 4321)]
    assert not index._met.keys() - {index.terms[w] for w in words}
