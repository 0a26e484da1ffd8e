import random
import re
import zlib

import numpy as np
import pytest
import sentencepiece

from faresettle.llm import pieces


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary.load(pieces.MODEL)


def small(words, unknown=-20.0):
    """A vocabulary of given pieces, their scores falling with their place, and the 256 bytes."""
    bytes_of = [bytes([b]) for b in range(256)]
    found = {w: 256 + k for k, w in enumerate(words)}
    scores = {w: -1.0 - 0.37 * k for k, w in enumerate(words)}
    return pieces.Vocabulary(found, scores, bytes_of + [w.encode() for w in words], list(range(256)))


def all_paths(vocabulary, segmenter, text):
    """Scores and ids of every segmentation, best first."""
    text = f" {text}"

    def rest(at):
        if at == len(text):
            yield 0.0, ()
            return
        for end in range(at + 1, len(text) + 1):
            piece = text[at:end]
            if piece in vocabulary.pieces:
                step = vocabulary.scores[piece], (vocabulary.pieces[piece],)
            elif end == at + 1:
                step = segmenter.unknown, tuple(vocabulary.byte_ids[b] for b in piece.encode())
            else:
                continue
            for score, ids in rest(end):
                yield step[0] + score, step[1] + ids

    return sorted(rest(0), key=lambda x: -x[0])


def check(vocabulary, n_best, texts):
    segmenter = pieces.Segmenter(vocabulary, n_best)
    for text, (paths, decoded) in zip(texts, segmenter.encode(texts)):
        expected = all_paths(vocabulary, segmenter, text)
        np.testing.assert_allclose(paths.scores, [s for s, _ in expected[:n_best]])
        every = {ids: score for score, ids in expected}
        got = [tuple(p.tolist()) for p in paths.ids]
        assert len(set(got)) == len(got)
        np.testing.assert_allclose([every[g] for g in got], paths.scores)
        assert decoded and all(vocabulary.decode(p.tolist()) == text for p in paths.ids)


@pytest.mark.parametrize("n_best", [1, 2, 5])
def test_best_paths_among_all(n_best):
    rng = random.Random(n_best)
    words = [" a", "a", "b", " ", "ab", " ab", "ba", "aa", " b", "aba", "bb", "  "]
    texts = ["".join(rng.choice("ab ab\nc") for _ in range(rng.randrange(1, 9))) for _ in range(60)]
    check(small(words), n_best, texts)


def test_pieces_that_cross_words():
    check(small([" a", "a", "b", " ", "a b", " a b", "a\nb"]), 4, ["a b", "a ba b", "a\nb", "ab a b"])


def test_ties_have_one_order():
    tied = small(["a", "aa", " "])
    tied.scores.update({"a": -1.0, "aa": -2.0, " ": -1.0})
    one = [[p.tolist() for p in paths.ids] for paths, _ in pieces.Segmenter(tied, 4).encode(["aaaa", "aa aa"])]
    other = [[p.tolist() for p in paths.ids] for text in ("aaaa", "aa aa") for paths, _ in pieces.Segmenter(tied, 4).encode([text])]
    assert one == other


def test_long_segments_and_rare_characters(vocabulary):
    rng = random.Random(1)
    texts = ["x" * 5000, "".join(chr(rng.choice([0x61, 0xE9, 0x4E2D, 0x1F600, 0x2581, 9, 10, 32, 0])) for _ in range(3000)), "  two  spaces ", "▁", " ▁ ", "\n\n", " "]
    for text, (paths, decoded) in zip(texts, pieces.Segmenter(vocabulary, 3).encode(texts)):
        assert decoded and vocabulary.decode(paths.ids[0].tolist()) == text


def test_best_path_beats_the_library(vocabulary):
    """The library merges greedily; the best path of the lattice is worth as much or more, and both decode alike."""
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    text = "the quick brown fox jumps over the lazy dog"
    ids = library.encode(text)
    (paths, _), = pieces.Segmenter(vocabulary, 2).encode([text])
    assert paths.scores[0] >= sum(library.get_score(i) for i in ids)
    assert library.decode(paths.ids[0].tolist()) == library.decode(ids) == text


def test_memory_is_bounded(vocabulary, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    segmenter = pieces.Segmenter(vocabulary, 2)
    first = [[p.tolist() for p in paths.ids] for _ in range(2) for t in ("one two three four", "five six") for paths, _ in segmenter.encode([t])]
    assert first[:2] == first[2:]


def test_rows_of_every_kind(documents, vocabulary):
    rows = [(1, "hello world"), (1, "hello world"), (None, "x"), (2, None), (3, ""), (4, "é▁\n" * 3000)]
    df = documents(rows)
    out = pieces.encode_documents(df).collect()
    assert len(out) == 6 and all(r["decoded"] for r in out)
    by = {r["doc_id"]: r for r in out}
    assert (by[2]["ids"], by[2]["score"], by[2]["scores"], by[2]["digests"]) == ([], 0.0, [0.0], [zlib.crc32(b"")]) == (by[3]["ids"], by[3]["score"], by[3]["scores"], by[3]["digests"])
    assert by[1]["n_pieces"] == len(by[1]["ids"]) and by[1]["score"] == by[1]["scores"][0]
    texts = {(r["doc_id"], r["text"]) for r in pieces.decode_documents(pieces.encode_documents(df)).collect()}
    assert texts == {(i, t or "") for i, t in rows}
    assert pieces.encode_documents(documents([])).count() == 0


def test_table_round_trip(sf):
    docs = sf("documents")
    out = pieces.encode_documents(docs)
    assert out.where("NOT decoded").count() == 0
    back = pieces.decode_documents(out)
    assert back.exceptAll(docs.select("doc_id", "text")).count() == 0 == docs.select("doc_id", "text").exceptAll(back).count()


@pytest.mark.parametrize("n_best", [1, 3])
@pytest.mark.parametrize("stretch", [3, 20, 1000])
def test_long_segments_in_stretches_equal_whole_ones(vocabulary, monkeypatch, n_best, stretch):
    rng = random.Random(stretch)
    texts = ["x" * 300, "".join(rng.choice("abcdeé漢 ") for _ in range(400)).replace(" ", "th"), "therefore" * 60, "漢字" * 90 + "und" * 30, "ab" * 200]
    whole = pieces.Segmenter(vocabulary, n_best)
    expected = [(p.ids, p.scores, d) for p, d in whole.encode(texts)]
    monkeypatch.setattr(pieces, "STRETCH", stretch)
    monkeypatch.setattr(pieces, "LONG", 100)
    for (paths, decoded), (ids, scores, also) in zip(pieces.Segmenter(vocabulary, n_best).encode(texts), expected):
        assert paths.scores == scores and decoded == also
        assert [p.tolist() for p in paths.ids] == [p.tolist() for p in ids]


def test_unbroken_text_needs_some_bytes_a_character(vocabulary):
    """One word of 100,000 letters: whole, its lattice alone would be 40 MB."""
    import tracemalloc

    segmenter = pieces.Segmenter(vocabulary)
    text = "abcdefghij" * 10_000
    tracemalloc.start()
    (paths, decoded), = segmenter.encode([text])
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert decoded and len(paths.ids) == 3
    assert peak < 25 << 20


def test_all_segmentations_are_returned_and_decode(documents, vocabulary):
    """The ids of each of the n best paths, not the first one's and checksums of the others."""
    rows = [(1, "hello world"), (2, None), (3, "therefore the é\nend"), (4, "a")]
    for row in pieces.encode_documents(documents(rows)).collect():
        text = dict(rows)[row["doc_id"]] or ""
        assert row["segmentations"][0] == row["ids"] and len(row["segmentations"]) == len(row["scores"])
        assert [zlib.crc32(np.array(p, "<i4").tobytes()) for p in row["segmentations"]] == row["digests"]
        assert all(vocabulary.decode(p) == text for p in row["segmentations"])
        assert len({tuple(p) for p in row["segmentations"]}) == len(row["segmentations"]) == (3 if len(text) > 1 else len(text) + 1)


def test_a_segmentation_that_does_not_decode_is_told():
    """Also one that is not the best: each is decoded."""
    wrong = small(["ab", "a", "b", " "])
    wrong.bytes_of[wrong.pieces["a"]] = b"x"
    (paths, decoded), = pieces.Segmenter(wrong, 2).encode(["ab"])
    assert wrong.decode(paths.ids[0].tolist()) == "ab" and not decoded


def test_frequent_segments_are_searched_once(vocabulary, monkeypatch):
    """What many slices hold stays known when a worker has met more segments than it remembers; results are those of a new worker."""
    monkeypatch.setattr(pieces, "REMEMBERED", 40)
    searched, solve = [], pieces.Segmenter.solve
    segmenter = pieces.Segmenter(vocabulary)
    texts = [f"therefore the end {' '.join(f'w{k}x{j}' for j in range(30))}" for k in range(12)]
    for text in texts:
        with monkeypatch.context() as watched:
            watched.setattr(pieces.Segmenter, "solve", lambda self, names: searched.extend(names) or solve(self, names))
            (paths, decoded), = segmenter.encode([text])
        (again, _), = pieces.Segmenter(vocabulary).encode([text])
        assert decoded and paths.scores == again.scores and [p.tolist() for p in paths.ids] == [p.tolist() for p in again.ids]
    assert len(segmenter.known.number) < 100
    assert [sum(name in (word, word.encode()) for name in searched) for word in (" therefore", " the", " end")] == [1, 1, 1]


def test_segments_are_cut_before_spaces_and_around_line_ends(vocabulary):
    texts = ["", "a  b ", "\n\n  b", " ", "x\n", "é\tü  \n 漢字", "\ud800 b", ""]
    names, which, bounds = pieces.Segmenter(vocabulary)._cut([f" {t}".encode("utf-8", "surrogatepass") if t else b"" for t in texts])
    got = [[names[k].decode("utf-8", "surrogatepass") for k in which[low:high]] for low, high in zip(bounds, bounds[1:])]
    assert got == [re.findall(r" *[^ \n]+| +|\n", f" {t}") if t else [] for t in texts]


def test_pieces_without_a_shorter_one_are_found():
    """The beginnings of a piece need not be pieces, and a piece may end where another goes on."""
    check(small(["abab", " ab", "bab", "c"]), 3, ["abab", "ababab", "cababc", "abba"])
