import re
from collections import Counter, defaultdict

import pytest

from faresettle.llm import collocations


def brute(rows, least, top, longest=5):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, f in counts.items():
        found = []
        frequent = [p for p in f if f[p] >= least]
        inside = {p[i:j] for p in frequent for i in range(len(p)) for j in range(i + 1, len(p) + 1) if j - i < len(p) and f[p] >= f[p[i:j]]}
        for p in frequent:
            if len(p) == 1 or p in inside:
                continue
            score, _, left, right = min((1000 * f[p] * n[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -f[p], " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def result(frame):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in frame.collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "1 AS prefix", "2 AS word", "3 AS f", "4 AS n", "5 AS part")


EDGES = [
    ("en", "New York, new york. NEW\tyork  new york city! new york city"),
    ("en", "a a a a a a a a"),
    ("en", None),
    (None, "der hund; der hund der hund"),
    ("und", "der hund der hund. Élan vital élan vital"),
    ("fr", ""),
    ("fr", " . ,\n"),
    ("x y", " a  b  b"),
    ("en", "end\n"),
    ("en", "new"),
]


@pytest.mark.parametrize("least", [1, 2, 3])
def test_edges_equal_counting_everything(spark, monkeypatch, least):
    monkeypatch.setattr(collocations, "LEAST", least)
    assert result(collocations.collocations(frame(spark, EDGES))) == brute(EDGES, least, 2000)


def test_small_lots_hot_stripes_and_full_filters_change_nothing(spark, sf, monkeypatch):
    rows = [(r["lang"], r["text"]) for r in sf("documents").collect()]
    expected = brute(rows, 5, 40)
    monkeypatch.setattr(collocations, "LEAST", 5)
    assert result(collocations.collocations(frame(spark, rows), top=40)) == expected
    monkeypatch.setattr(collocations, "LOT_BYTES", 3000)
    monkeypatch.setattr(collocations, "RANK_BLOCK", 50)
    monkeypatch.setattr(collocations, "MOST_BITS", 64)
    monkeypatch.setattr(collocations, "HOT", 1_000_000)
    assert result(collocations.collocations(frame(spark, rows), top=40)) == expected


def test_long_words_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(collocations, "LEAST", 2)
    monkeypatch.setattr(collocations, "LOT_BYTES", 1000)
    rows = [("en", "x" * 100_000 + " tail " + "x" * 100_000 + " tail"), ("en", "to be or not " * 5000)]
    assert result(collocations.collocations(frame(spark, rows))) == brute(rows, 2, 2000)


def test_empty_table(spark):
    assert collocations.collocations(frame(spark, [])).collect() == []


def test_products_beyond_64_bits(spark):
    a = "CAST({} AS DECIMAL(17, 0))"
    big = 10**15 + 7
    value = spark.sql(f"SELECT (CAST(1000 AS DECIMAL(4, 0)) * {a.format(big)} * {a.format(big + 2)}) div ({a.format(big - 1)} * {a.format(3 * big)}) AS v").first()["v"]
    assert value == 1000 * big * (big + 2) // ((big - 1) * 3 * big)
