"""Collocations by stripes: each prefix keys a counter of next words, and stripes are merged word by word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from faresettle.llm.staging import stage
from faresettle.llm.utf8 import mixed, slices, utf8, word_hashes

LONGEST = 5
LEAST = 100
TOP = 2000
# Texts that one task counts together; it holds a few dozen bytes for each.
LOT_BYTES = 2 << 20
# A prefix with more than this share of all words is hot: its stripe is cut into so many parts by the next word.
HOT = 4096
PARTS = 1024
# Bits per frequent phrase in the filter of the next pass, and bits at most: beyond, more rare phrases pass and are counted.
BITS_A_PHRASE = 16
MOST_BITS = 1 << 27
# Candidates that one task ranks.
RANK_BLOCK = 100_000
RANK_BLOCKS = 16
# Stripes travel in buckets, so many at least, by prefix and part. A bucket of a lot is a text: a line per stripe, with the prefix and then each next word and its
# count, between tabs. Words hold no space, tab or line end.
BUCKETS = 1024

STRIPES = "lang string, bucket int, stripes string"

_KIND = bytes(1 if b in b" \t" else 2 if b in b".,;:!?\n\x0b\x0c\r" else 0 for b in range(256))
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_NEXT = np.uint64(0xC2B2AE3D27D4EB4F)


def phrase_hashes(langs: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """Of phrases given as the hashes of their language and words."""
    h = langs.copy()
    for word in words:
        h = h * _NEXT + word
    return mixed(h)


@dataclass(frozen=True)
class Known:
    """What the pass before found: a filter of frequent phrases, by their hashes, and the hashes of hot ones."""

    bits: int
    filter: np.ndarray
    hot: np.ndarray

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes >> np.uint64(64 - self.bits)
        return (self.filter[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


class Lot:
    """The words of some texts: their numbers in `words`, the piece and the language that each is in."""

    def __init__(self, texts: pa.Array, langs: pa.Array) -> None:
        data, begin = utf8(texts)
        # Tables of bytes are looked up by translate, which makes no wider copy.
        kind = np.frombuffer(data.tobytes().translate(_KIND), np.uint8)
        inside = kind == 0
        first, last, split = inside.copy(), inside.copy(), kind == 2
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        heads = begin[:-1][np.diff(begin) > 0]
        first[heads] = inside[heads]
        last[heads[1:] - 1] = inside[heads[1:] - 1]
        split[heads] = True
        starts = np.flatnonzero(first)
        lengths = np.flatnonzero(last) + 1 - starts
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        letters = data[inside].tobytes().translate(_LOWER)
        spelled = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(letters))
        encoded = spelled.dictionary_encode()
        self.words = encoded.dictionary
        self.ids = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.piece = np.cumsum(split, dtype=np.int32)[starts]
        tongues = langs.dictionary_encode()
        self.langs = tongues.dictionary
        text = np.searchsorted(begin, starts, "right") - 1
        self.lang = tongues.indices.to_numpy(zero_copy_only=False).astype(np.int64)[text]
        self.hashes, self.lang_hashes = word_hashes(self.words), word_hashes(self.langs)

    def phrases(self, size: int, at: np.ndarray) -> np.ndarray:
        return phrase_hashes(self.lang_hashes[self.lang[at]], [self.hashes[self.ids[at + j]] for j in range(size)])

    def starts(self, size: int, known: Known | None) -> np.ndarray:
        """Where phrases of `size` words begin that may be frequent: both phrases of one word less are."""
        at = np.arange(len(self.ids) - size + 1)
        at = at[self.piece[at] == self.piece[at + size - 1]]
        if known is None or not len(at):
            return at
        shorter = np.arange(len(self.ids) - size + 2)
        good = known.holds(self.phrases(size - 1, shorter))
        return at[good[at] & good[at + 1]]

    def stripes(self, size: int, known: Known | None, buckets: int) -> Iterator[pa.RecordBatch]:
        """This lot's stripes of prefixes of `size` - 1 words; with them, for the empty prefix, each language's words (an empty word)."""
        at = self.starts(size, known)
        if not len(at):
            return
        # Phrases are told apart by the numbers of their words, not by hashes.
        codes = self.lang[at]
        for j in range(size):
            prefix = codes
            if codes.max() >= (1 << 62) // len(self.words):
                codes = prefix = pd.factorize(codes)[0].astype(np.int64)
            codes = codes * len(self.words) + self.ids[at + j]
        which, codes = pd.factorize(codes)
        n = np.bincount(which)
        one = np.empty(len(codes), np.int64)
        one[which] = np.arange(len(at))
        prefix, one = prefix[one], at[one]
        nexts, key = self.ids[one + size - 1], self.phrases(size - 1, one)
        hot = np.ones(len(one), bool) if known is None else np.isin(key, known.hot)
        part = np.where(hot, self.hashes[nexts] % np.uint64(PARTS), np.uint64(0))
        bucket = (mixed(key + part) % np.uint64(buckets)).astype(np.int64)
        lang = self.lang[one]
        order = np.lexsort((part, prefix, bucket, lang))
        lang, bucket, prefix, part, one, nexts, n = (x[order] for x in (lang, bucket, prefix, part, one, nexts, n))
        heads = _heads(lang, prefix, part)
        spelled = [self.words.take(pa.array(self.ids[one[heads] + j])) for j in range(size - 1)]
        prefixes = _joined(spelled, " ") if spelled else pa.array([""] * len(heads), pa.large_string())
        entries = _joined([self.words.take(pa.array(nexts)), pa.array(n).cast(pa.large_string())], " ")
        lines = _joined([prefixes, _lists(entries, heads, "\t")], "\t")
        tops = _heads(lang[heads], bucket[heads])
        yield _batch(self.langs.take(pa.array(lang[heads][tops])), bucket[heads][tops], _lists(lines, tops, "\n"))
        if known is None:
            words = pa.array(np.bincount(self.lang, minlength=len(self.langs))).cast(pa.large_string())
            nothing = pa.array([""] * len(words), pa.large_string())
            yield _batch(self.langs, np.zeros(len(words)), _joined([nothing, _joined([nothing, words], " ")], "\t"))


def _heads(*keys: np.ndarray) -> np.ndarray:
    """Where rows begin that differ from the one before in a key."""
    differ = np.zeros(len(keys[0]), bool)
    differ[:1] = True
    for key in keys:
        differ[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(differ)


def _joined(columns: list[pa.Array], mark: str) -> pa.Array:
    return pc.binary_join_element_wise(*columns, pa.scalar(mark, pa.large_string()))


def _lists(values: pa.Array, heads: np.ndarray, mark: str) -> pa.Array:
    """Values from each head to the next one, joined."""
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(np.append(heads, len(values))), values), pa.scalar(mark, pa.large_string()))


def _batch(langs: pa.Array, bucket: np.ndarray, stripes: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([langs.cast(pa.string()), pa.array(bucket, pa.int32()), stripes.cast(pa.string())], ["lang", "bucket", "stripes"])


def lots(batches: Iterator[pa.RecordBatch]) -> Iterator[Lot]:
    """Rows of `lang`, `text` in lots of some bytes; a text longer than that is a lot of its own."""
    held, size = [], 0

    def lot() -> Lot:
        table = pa.Table.from_batches(held).combine_chunks()
        return Lot(*(pa.concat_arrays(table[name].chunks) for name in ("text", "lang")))

    for batch in batches:
        for some in slices(batch, "text", LOT_BYTES):
            data, _ = utf8(some.column("text"))
            if held and size + len(data) > LOT_BYTES:
                yield lot()
                held, size = [], 0
            held.append(some)
            size += len(data)
    if size:
        yield lot()


def merged(texts: DataFrame, size: int, known: Known | None) -> DataFrame:
    """Entries `lang`, `prefix`, `word`, `f` of the stripes of `size` words that come `LEAST` times; an empty word has the language's total.

    Stripes are dealt by language and bucket and merged where they arrive, entry by entry; no task holds a hot stripe.
    """
    spark = texts.sparkSession
    broadcast = spark.sparkContext.broadcast(known)
    buckets = max(BUCKETS, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lot in lots(batches):
            yield from lot.stripes(size, broadcast.value, buckets)
            del lot

    dealt = texts.mapInArrow(emit, STRIPES).repartition("lang", "bucket")
    lines = dealt.select("lang", "bucket", F.explode(F.split("stripes", "\n")).alias("line"))
    fields = lines.select("lang", "bucket", F.split("line", "\t").alias("fields"))
    entries = fields.select("lang", "bucket", F.col("fields")[0].alias("prefix"), F.explode(F.expr("slice(fields, 2, size(fields))")).alias("entry"))
    counted = entries.groupBy("lang", "bucket", "prefix", F.substring_index("entry", " ", 1).alias("word")).agg(
        F.sum(F.substring_index("entry", " ", -1).cast("long")).alias("f")
    )
    return counted.where((F.col("f") >= LEAST) | (F.col("word") == "")).drop("bucket")


def _hash_column() -> F.Column:
    """The hash of `lang` and `phrase`, equal to that of the lots."""

    def hashed(langs: pd.Series, phrases: pd.Series) -> pd.Series:
        words = phrases.str.split(" ")
        flat = word_hashes(pa.array([w for some in words for w in some], pa.string()))
        begin = np.concatenate([[0], np.cumsum(words.str.len())]).astype(np.int64)
        tongues = word_hashes(pa.array(langs, pa.string()))
        out = np.zeros(len(words), np.uint64)
        for n in set(np.diff(begin).tolist()):
            rows = np.flatnonzero(np.diff(begin) == n)
            out[rows] = phrase_hashes(tongues[rows], [flat[begin[rows] + j] for j in range(n)])
        return pd.Series(out.view(np.int64))

    return F.pandas_udf(hashed, "long")("lang", "phrase")


def known_of(frequent: DataFrame, total: int) -> Known | None:
    """The filter and the hot phrases of a pass's frequent phrases, None if there are none. Both have a bound: `MOST_BITS` and `HOT` phrases."""
    hashed = frequent.select("f", _hash_column().alias("h"))
    count = frequent.count()
    if not count:
        return None
    bits = max(6, min(MOST_BITS, BITS_A_PHRASE * count).bit_length())
    slot = F.shiftrightunsigned("h", 64 - bits)
    chunks = hashed.groupBy(F.shiftrightunsigned(slot, 6).alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(h, {64 - bits}) & 63 AS INT))")).alias("set"))
    held = chunks.toArrow()
    filter = np.zeros(1 << (bits - 6), np.uint64)
    filter[held["at"].to_numpy()] = held["set"].to_numpy().view(np.uint64)
    hot = hashed.where(F.col("f") * HOT > total).select("h").toArrow()["h"].to_numpy()
    return Known(bits, filter, hot.view(np.uint64))


def phrase_counts(documents: DataFrame, text_column: str = "text", lang_column: str = "lang") -> tuple[DataFrame, DataFrame]:
    """Frequent phrases `lang`, `phrase`, `size`, `f`, and the words `lang`, `n` of each language.

    A pass per length. From the second on, a phrase is only counted if the two of one word less in it may be frequent, which a frequent one's are.
    """
    lang = F.coalesce(F.col(lang_column).cast("string"), F.lit("und"))
    texts = documents.select(lang.alias("lang"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    found, known, totals, words = [], None, None, 0
    for size in range(1, LONGEST + 1):
        entries = stage(merged(texts, size, known), f"stripes-{size}")
        if size == 1:
            totals = entries.where("word = ''").select("lang", F.col("f").alias("n"))
            words = totals.agg(F.sum("n")).first()[0] or 0
        phrase = F.col("word") if size == 1 else F.concat_ws(" ", "prefix", "word")
        frequent = entries.where("word <> ''").select("lang", phrase.alias("phrase"), F.lit(size).alias("size"), "f")
        found.append(frequent)
        known = known_of(frequent, words) if size < LONGEST else None
        if known is None:
            break
    phrases = found[0]
    for more in found[1:]:
        phrases = phrases.unionByName(more)
    return phrases, totals


def collocations(documents: DataFrame, text_column: str = "text", lang_column: str = "lang", top: int = TOP) -> DataFrame:
    """`lang`, `rank`, `phrase`, `a`, `l`, `r`, `n`, `score`: each language's best phrases of two to `LONGEST` words.

    A phrase comes `a` times, at least `LEAST`; its score is the least over its cuts into a first part (`l` times) and a rest (`r`) of
    1000 a n / (l r), rounded down, exact at any size. Phrases that come no more often than a longer one that holds them are left out. A null
    language is `und`, a null text is empty; texts without words give nothing, repeated rows count each time, other columns are ignored and an empty table gives no
    rows. Ties of score and count are ranked by the phrase's bytes. Texts and words may be of any length.
    """
    phrases, totals = phrase_counts(documents, text_column, lang_column)
    known = phrases.select("lang", "phrase", "f")
    long = phrases.where("size > 1")
    # The stripe of a phrase holds what follows it; cut at the front, the same entries hold what comes before.
    follow = long.groupBy("lang", F.expr("substring_index(phrase, ' ', size - 1)").alias("phrase")).agg(F.max("f").alias("most"))
    lead = long.groupBy("lang", F.expr("substring(phrase, locate(' ', phrase) + 1)").alias("phrase")).agg(F.max("f").alias("most"))
    most = follow.unionByName(lead).groupBy("lang", "phrase").agg(F.max("most").alias("most"))
    kept = long.join(most, ["lang", "phrase"], "left").where("most IS NULL OR most < f").select("lang", "phrase", "size", F.col("f").alias("a"))
    cuts = kept.withColumn("k", F.expr("explode(sequence(1, size - 1))")).withColumn("first", F.expr("substring_index(phrase, ' ', k)"))
    cuts = cuts.withColumn("rest", F.expr("substring(phrase, length(first) + 2)"))
    counted = (
        cuts.join(known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
        .join(known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
        .join(totals, "lang")
    )
    wide = {name: f"CAST({name} AS DECIMAL(17, 0))" for name in "anlr"}
    score = F.expr(f"(CAST(1000 AS DECIMAL(4, 0)) * {wide['a']} * {wide['n']}) div ({wide['l']} * {wide['r']})")
    best = counted.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    scored = stage(best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"), "collocations")
    # A language's candidates are ranked in blocks, and the first of each block against each other.
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    blocks = max(RANK_BLOCKS, -(-scored.count() // RANK_BLOCK))
    dealt = scored.withColumn("block", F.pmod(F.xxhash64("phrase"), F.lit(blocks)))
    first = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "block").orderBy(*order))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
