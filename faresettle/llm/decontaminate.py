"""Benchmark decontamination: BM25 over test items by block-max WAND, then question and answer overlap."""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

K1, B = 1.2, 0.75
# A passage is a candidate for an item from this share of the score that the item's own text gets.
THRESHOLD = 0.5
BLOCK_ITEMS = 4
SHINGLE_WORDS = 5
OVERLAP = 0.8
# Words of benchmark items that one index holds; a larger benchmark is searched in several passes.
INDEX_WORDS = 1_000_000
# Words of text that are looked at together.
CHUNK_WORDS = 400_000
# Terms of windows whose block bounds are added up together; sums, and block maxima, that this may take at once.
BOUND_TERMS = 1 << 16
BOUND_CELLS = 1 << 22
WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The words of an item's question and of its answer.

    The answer follows the last "answer:" or question mark, else it is the last sentence; an item of one
    sentence is all question and its answer is empty.
    """
    for mark in (r"(?i)\banswer\s*:", r"\?", r"[.!\n](?=\s*\S)"):
        ends = [m.end() for m in re.finditer(mark, text)]
        if ends and words_of(text[ends[-1] :]) and words_of(text[: ends[-1]]):
            return words_of(text[: ends[-1]]), words_of(text[ends[-1] :])
    return words_of(text), []


def marked_answer(text: str) -> bool:
    """Whether an item says itself where its answer begins."""
    ends = [[m.end() for m in re.finditer(mark, text)][-1:] for mark in (r"(?i)\banswer\s*:", r"\?")]
    return any(words_of(text[:end]) and words_of(text[end:]) for last in ends for end in last)


def shingles(words: list[str], size: int = SHINGLE_WORDS) -> set[tuple[str, ...]]:
    size = min(size, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


@dataclass
class Index:
    """Postings of items by term, in item order, with the largest impact of each term in each block of items that has the term.

    An impact is the term's BM25 weight in the item over the score of the item's own text, so the
    impacts of an item's terms add up to 1 and one threshold serves items of any length.
    """

    ids: np.ndarray
    questions: list[set]
    answers: list[set]
    wholes: list[set]
    terms: dict[str, int]
    begin: np.ndarray
    items: np.ndarray
    impacts: np.ndarray
    block_begin: np.ndarray
    blocks: np.ndarray
    block_most: np.ndarray
    window: int

    @staticmethod
    def build(rows: list[tuple[int, str]], document_counts: dict[str, int], total: int, mean_words: float) -> Index:
        ids, questions, answers, wholes, postings, longest = [], [], [], [], {}, 1
        for item_id, text in rows:
            words = words_of(text)
            if not words:
                continue
            item = len(ids)
            ids.append(item_id)
            question, answer = question_and_answer(text)
            questions.append(shingles(question))
            answers.append(shingles(answer))
            wholes.append(set() if marked_answer(text) else shingles(words))
            longest = max(longest, len(words))
            weights = {}
            for word in dict.fromkeys(words):
                count, seen = words.count(word), document_counts[word]
                idf = math.log(1 + (total - seen + 0.5) / (seen + 0.5))
                weights[word] = idf * count * (K1 + 1) / (count + K1 * (1 - B + B * len(words) / mean_words))
            own = sum(weights.values())
            for word, weight in weights.items():
                postings.setdefault(word, []).append((item, weight / own))
        terms = {word: k for k, word in enumerate(postings)}
        sizes = [len(p) for p in postings.values()]
        flat = [x for p in postings.values() for x in p]
        items, impacts = np.array([i for i, _ in flat], np.int64), np.array([w for _, w in flat])
        begin = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        of, block = np.repeat(np.arange(len(sizes)), sizes), items // BLOCK_ITEMS
        firsts = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (block[1:] != block[:-1])]) if len(items) else np.zeros(0, np.int64)
        above = np.nextafter(impacts.astype(np.float32), np.float32(2))
        most = np.maximum.reduceat(above, firsts) if len(firsts) else above
        block_begin = np.searchsorted(of[firsts], np.arange(len(sizes) + 1)).astype(np.int64)
        return Index(np.array(ids, np.int64), questions, answers, wholes, terms, begin, items, impacts, block_begin, block[firsts], most, 2 * longest)

    @cached_property
    def _met(self) -> dict[int, tuple[list[int], list[float], dict[int, float], float]]:
        return {}

    def postings(self, term: int) -> tuple[list[int], list[float], dict[int, float], float]:
        """Of a term: items, impacts, the largest impact by block and of all; kept once asked for."""
        if term not in self._met:
            held, blocks = slice(self.begin[term], self.begin[term + 1]), slice(self.block_begin[term], self.block_begin[term + 1])
            most = dict(zip(self.blocks[blocks].tolist(), self.block_most[blocks].tolist()))
            self._met[term] = (self.items[held].tolist(), self.impacts[held].tolist(), most, max(most.values()))
        return self._met[term]

    def bounds(self, terms: np.ndarray, of: np.ndarray, count: int) -> np.ndarray:
        """The sums of the terms' largest impacts, a row for each of the `count` windows the terms are `of`, a column for each block."""
        blocks = -(-max(1, len(self.ids)) // BLOCK_ITEMS)
        out, sizes = np.zeros(count * blocks), self.block_begin[terms + 1] - self.block_begin[terms]
        ends, low = np.cumsum(sizes), 0
        while low < len(terms):
            high = max(low + 1, int(np.searchsorted(ends, ends[low] - sizes[low] + BOUND_CELLS, "right")))
            size = sizes[low:high]
            at = np.repeat(self.block_begin[terms[low:high]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            cells = np.repeat(of[low:high] * blocks, size) + self.blocks[at]
            out += np.bincount(cells, self.block_most[at], len(out))
            low = high
        return out.reshape(count, blocks)

    def retrieve(self, query: np.ndarray, threshold: float = THRESHOLD) -> list[tuple[int, float]]:
        """All items that score `threshold` or more for a set of terms, by block-max WAND.

        Cursors stand on the terms' postings. The pivot is the first item at which the largest impacts of the
        cursors up to it reach the threshold. Where the largest impacts in its block don't, the cursors go on to the next
        block in which those of all terms do; else the pivot is scored once all cursors before it stand on it.
        """
        slack = threshold - 1e-9
        # A little lower, as these bounds are added up in single precision.
        open_blocks = np.flatnonzero(self.bounds(query, np.zeros(len(query), np.int64), 1)[0] >= threshold - 1e-4).tolist()
        if not open_blocks:
            return []
        held = [self.postings(t) for t in query.tolist()]
        lists, weights, blocks, most = ([p[k] for p in held] for k in range(4))
        at = [bisect_left(x, open_blocks[0] * BLOCK_ITEMS) for x in lists]
        live, found = [k for k in range(len(lists)) if at[k] < len(lists[k])], []
        while live:
            live.sort(key=lambda k: lists[k][at[k]])
            bound, pivot = 0.0, -1
            for rank, k in enumerate(live):
                bound += most[k]
                if bound >= slack:
                    pivot = rank
                    break
            if pivot < 0:
                break
            item = lists[live[pivot]][at[live[pivot]]]
            while pivot + 1 < len(live) and lists[live[pivot + 1]][at[live[pivot + 1]]] == item:
                pivot += 1
            ahead, block = live[: pivot + 1], item // BLOCK_ITEMS
            place = bisect_left(open_blocks, block)
            if place == len(open_blocks):
                break
            if open_blocks[place] != block:
                target = open_blocks[place] * BLOCK_ITEMS
            elif sum(blocks[k].get(block, 0.0) for k in ahead) < slack:
                # Up to the next cursor's item only these cursors count, and in this block they don't reach.
                after = lists[live[pivot + 1]][at[live[pivot + 1]]] if pivot + 1 < len(live) else len(self.ids)
                target = min((block + 1) * BLOCK_ITEMS, after)
            elif lists[ahead[0]][at[ahead[0]]] == item:
                value = sum(weights[k][at[k]] for k in ahead)
                if value >= slack:
                    found.append((item, value))
                target = item + 1
            else:
                target = item
            # Cursors that lag behind the target go there, those after the pivot too if a block is passed over.
            for k in live if open_blocks[place] != block else ahead:
                if lists[k][at[k]] < target:
                    at[k] = bisect_left(lists[k], target, at[k])
            live = [k for k in live if at[k] < len(lists[k])]
        return found

    def candidates(self, words: list[str], first_of_text: np.ndarray, threshold: float = THRESHOLD) -> Iterator[tuple[int, int, int, float]]:
        """Text, first word of the window, item, score, for every window that reaches the threshold.

        Windows hold `window` words and begin every half window, so every item's text lies whole in one. A window
        is searched only if the block bounds of its terms reach the threshold in some block.
        """
        half = self.window // 2
        terms = np.fromiter(map(self.terms.get, words, repeat(-1)), np.int64, len(words))
        sizes = np.diff(first_of_text)
        # Every text's last half lies in the window before, unless it is the only one.
        windows = np.where(sizes > 0, np.maximum(1, -(-sizes // half) - 1), 0)
        first_window = np.concatenate(([0], np.cumsum(windows)))
        text = np.repeat(np.arange(len(sizes)), sizes)
        known = np.flatnonzero(terms >= 0)
        if not len(known):
            return
        of = text[known]
        in_half = (known - first_of_text[of]) // half
        keys = []
        for back in (0, 1):
            there = (in_half >= back) & (in_half - back < windows[of])
            keys.append((first_window[of[there]] + in_half[there] - back) * len(self.terms) + terms[known[there]])
        keys = np.unique(np.concatenate(keys))
        window, term = keys // len(self.terms), keys % len(self.terms)
        begins = np.flatnonzero(np.r_[True, window[1:] != window[:-1]])
        ends = np.append(begins[1:], len(keys))
        low = 0
        while low < len(begins):
            most = low + max(1, BOUND_CELLS * BLOCK_ITEMS // (len(self.ids) + BLOCK_ITEMS))
            high = max(low + 1, min(most, int(np.searchsorted(ends, begins[low] + BOUND_TERMS, "right"))))
            part = slice(begins[low], ends[high - 1])
            of = np.repeat(np.arange(high - low), ends[low:high] - begins[low:high])
            bounds = self.bounds(term[part], of, high - low).max(1)
            for k in (low + np.flatnonzero(bounds >= threshold - 1e-4)).tolist():
                number = int(window[begins[k]])
                owner = int(np.searchsorted(first_window, number, "right")) - 1
                for item, value in self.retrieve(term[begins[k] : ends[k]], threshold):
                    yield owner, int(first_of_text[owner] + (number - first_window[owner]) * half), item, value
            low = high

    def verify(self, words: list[str], item: int) -> tuple[float, float]:
        """The shares of the item's question and answer shingles that the words hold; an empty answer is held.

        Without a mark the last sentence is a guess at the answer: there the share of all the item's shingles counts for both, if it is more.
        """
        held = {}
        shares = []
        for wanted in (self.questions[item], self.answers[item], self.wholes[item]):
            if not wanted:
                shares.append(1.0 if len(shares) < 2 else 0.0)
                continue
            size = len(next(iter(wanted)))
            held.setdefault(size, shingles(words, size))
            shares.append(len(wanted & held[size]) / len(wanted))
        return (shares[2], shares[2]) if shares[2] > min(shares[:2]) else (shares[0], shares[1])

    def matches(self, texts: list[str | None], threshold: float = THRESHOLD, overlap: float = OVERLAP) -> Iterator[tuple[int, int, float, float, float]]:
        """Text, item id, and the best score, question and answer overlap, for every text that holds an item."""
        begin = 0
        while begin < len(texts):
            words, firsts, stop = [], [0], begin
            while stop < len(texts) and (stop == begin or len(words) < CHUNK_WORDS):
                words += words_of(texts[stop])
                firsts.append(len(words))
                stop += 1
            best: dict[tuple[int, int], tuple[float, float, float]] = {}
            first = np.array(firsts, np.int64)
            for text, at, item, value in self.candidates(words, first, threshold):
                shares = self.verify(words[at : min(at + self.window, firsts[text + 1])], item)
                if min(shares) >= overlap:
                    best[text, item] = max(best.get((text, item), (0.0, 0.0, 0.0)), (value, *shares))
            for (text, item), facts in sorted(best.items()):
                yield begin + text, int(self.ids[item]), *facts
            begin = stop


def indexes(benchmark: DataFrame, index_words: int = INDEX_WORDS) -> Iterator[Index]:
    """Indexes over all items with text, of `index_words` words or one item each; statistics are those of the whole benchmark.

    Items without an id or without words are left out; of rows that repeat an id and a text one counts.
    """
    size = F.regexp_count(F.lower("text"), F.lit(r"[\p{L}\p{N}_]+"))
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    totals = items.agg(F.count("*").alias("n"), F.sum(size.cast("long")).alias("words")).first()
    if not totals["n"]:
        return
    shards = max(1, -(-(totals["words"] or 0) // index_words))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [sorted(set(words_of(t))) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict({"word": pa.array([w for x in words for w in x], pa.string())})

    counts = items.select("text").mapInArrow(counted, "word string").groupBy("word").agg(F.count("*").alias("n"))
    mean = max(1.0, (totals["words"] or 0) / totals["n"])
    for shard in range(shards):
        rows = [(r["item_id"], r["text"]) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == shard).orderBy("item_id", "text").collect()]
        here = sorted({w for _, t in rows for w in words_of(t)})
        found = counts
        if shards > 1 and here:
            found = counts.join(counts.sparkSession.createDataFrame([(w,) for w in here], "word string"), "word", "left_semi")
        yield Index.build(rows, {r["word"]: r["n"] for r in found.collect()}, totals["n"], mean)


MATCH_SCHEMA = "item_id long, score double, question_overlap double, answer_overlap double"


def _matcher(index: Broadcast, threshold: float, overlap: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(index.value.matches(batch.column(1).to_pylist(), threshold, overlap))
            rows = pa.array([x[0] for x in found], pa.int64())
            columns = [pa.array([x[k] for x in found], pa.int64() if k == 1 else pa.float64()) for k in range(1, 5)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), *columns], ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"]
            )

    return run


def find_leaks(
    documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP, index_words: int = INDEX_WORDS
) -> DataFrame:
    """`doc_id`, `item_id`, `score`, `question_overlap`, `answer_overlap`: documents that hold an item's question and answer.

    Every window of every whole text is a query. A match has a BM25 score of `threshold` of the item's own or more, and
    `overlap` or more of the five-word shingles of its question and of its answer (shorter parts: of all
    their words), or of the whole item where no mark shows an answer. A null or empty text holds nothing; a null `doc_id` stays null; repeated documents come out repeated, repeated
    items once; other columns are ignored; an empty table on either side gives no rows.
    """
    schema = f"doc_id long, {MATCH_SCHEMA}"
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spark, out = documents.sparkSession, None
    for index in indexes(benchmark, index_words):
        found = rows.mapInArrow(_matcher(spark.sparkContext.broadcast(index), threshold, overlap), schema)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], schema) if out is None else out


def keep_clean(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """The rows of `documents` whose text holds no item, with all their columns.

    Null and empty texts hold none and stay, null ids are like any other, repeated rows go or stay together, and an empty benchmark keeps every row.
    """
    for index in indexes(benchmark):
        held = documents.sparkSession.sparkContext.broadcast(index)
        documents = documents.where(~_holds_item(held, threshold, overlap)("text"))
    return documents


def _holds_item(index: Broadcast, threshold: float, overlap: float):
    def leaks(texts: pd.Series) -> pd.Series:
        flags = np.zeros(len(texts), bool)
        flags[[x[0] for x in index.value.matches(texts.tolist(), threshold, overlap)]] = True
        return pd.Series(flags)

    return F.pandas_udf(leaks, "boolean")
