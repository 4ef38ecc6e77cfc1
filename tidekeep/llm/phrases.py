"""Collocations by best-first growth: words grow to pairs, and the most promising pairs to triples.

The frontier is held in tables, one row per prefix with its count. No phrase grown from a prefix can score more than
1,000,000 * f(prefix) / f(first word): its own count is at most that of the prefix, and so is the count of what its first cut
leaves at least the phrase's own. A wave expands all prefixes of a language whose bound reaches a limit, by counting their
growths where the texts are read; it also counts growths to the left of the pairs that score that much, which may drop them.
Once `top` survivors of a language reach the limit, nothing unexpanded can pass them: the language is settled. For the others
the limit goes down, to 0 if need be. Which words and prefixes a wave asks for reaches the tasks as Bloom filters of bounded
size; what they let through by mistake is counted in vain and falls to the exact counts and joins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blooms import Bits, blocks_for, merged_blocks
from .common import small_batches, stored
from .tokens import Words, mix, utf8
from .windows import windows

LEAST, TOP, COVER, SCALE = 10, 2000, 50, 1_000_000
# Signs that end a piece, and what parts words inside one.
ENDS, GAPS = b".,;:!?\n\x0b\x0c\r", b" \t"
WINDOW = 1 << 20
KEYS_PER_BLOCK, MOST_BLOCKS = 1 << 16, 64
# The first wave asks for this many times `top` of the best-scored pairs, each later one for so many times more.
FIRST, MORE = 2, 8
_BASE = np.uint64(0x9E3779B97F4A7C15)
_ENDS = np.zeros(256, np.int64)
_ENDS[list(ENDS)] = 1


def _joined(*keys: np.ndarray) -> np.ndarray:
    """One key for several in order."""
    out = np.zeros(len(keys[0]), np.uint64)
    with np.errstate(over="ignore"):
        for key in keys:
            out = mix(out * _BASE + key)
    return out


def _text_keys(column: pa.Array) -> np.ndarray:
    """A key of each whole value."""
    data, at = utf8(column)
    out = np.zeros(len(at) - 1, np.uint64)
    full = np.flatnonzero(np.diff(at))
    out[full] = Words(data, at, b"", lower=False).keys()
    return out


class Occurrences:
    """Words of a window of texts: number of each occurrence's distinct (language, word), and whether the next goes on its piece."""

    def __init__(self, data: np.ndarray, at: np.ndarray, langs: pa.Array):
        words = Words(data, at, GAPS + ENDS)
        coded = words.strings(np.arange(len(words))).dictionary_encode()
        spoken = langs.dictionary_encode()
        texts, names = coded.dictionary, spoken.dictionary
        lang = spoken.indices.to_numpy()[words.owners()].astype(np.int64)
        both, self.code, self.count = np.unique(
            lang * max(len(texts), 1) + coded.indices.to_numpy(), return_inverse=True, return_counts=True
        )
        self.word = texts.take(pa.array(both % max(len(texts), 1)))
        self.lang = names.take(pa.array(both // max(len(texts), 1)))
        self.spoken = names, np.bincount(lang, minlength=len(names))
        passed = np.cumsum(_ENDS[words.data])
        owner = words.owners()
        self.goes_on = (owner[1:] == owner[:-1]) & (passed[words.starts[1:]] == passed[words.starts[:-1]])

    def keys(self) -> np.ndarray:
        return _joined(_text_keys(self.lang), _text_keys(self.word))


def _piece_ends(data: np.ndarray) -> np.ndarray:
    return _ENDS[data] == 1


def _read(batch: pa.RecordBatch) -> Iterator[Occurrences]:
    column = batch.column("text")
    data, at = utf8(column)
    for part, inside, first in windows(at, data, _piece_ends, WINDOW):
        yield Occurrences(part, inside, batch.column("lang").slice(first, len(inside) - 1))


def _texts(docs: DataFrame) -> DataFrame:
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    return docs.select(lang, F.col("text").cast("string").alias("text")).where("text is not null")


def _filter(rows: DataFrame, columns: list[str], n: int) -> Bits:
    """The filter of the keys of (lang, word, ...) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang = _text_keys(b.column(0))
            words = [_joined(lang, _text_keys(b.column(i))) for i in range(1, b.num_columns)]
            key = words[0] if len(words) == 1 else _joined(*words)
            yield pa.record_batch([pa.array(key.view(np.int64))], ["k"])

    blocks = blocks_for(n, KEYS_PER_BLOCK, MOST_BLOCKS)
    return Bits(merged_blocks(rows.select("lang", *columns).mapInArrow(run, "k long"), blocks, least=1), blocks)


def count_words(docs: DataFrame) -> DataFrame:
    """lang, word, n; the row of a null word counts all words of the language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in _read(batch):
                names, n = w.spoken
                lang = pa.concat_arrays([w.lang, names]).cast(pa.string())
                word = pa.concat_arrays([w.word.cast(pa.string()), pa.nulls(len(names), pa.string())])
                yield pa.record_batch([lang, word, pa.array(np.concatenate([w.count, n]))], ["lang", "word", "n"])

    counted = _texts(docs).mapInArrow(run, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def count_pairs(docs: DataFrame, words: Bits) -> DataFrame:
    """lang, w1, w2, n of pairs whose words may both be among those of the filter."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in _read(batch):
                known = shared.value.holds(w.keys())[w.code]
                here = np.flatnonzero(w.goes_on & known[:-1] & known[1:])
                width = max(len(w.word), 1)
                both, n = np.unique(w.code[here] * width + w.code[here + 1], return_counts=True)
                a, b = pa.array(both // width), pa.array(both % width)
                yield pa.record_batch(
                    [w.lang.take(a).cast(pa.string()), w.word.take(a).cast(pa.string()), w.word.take(b).cast(pa.string()), pa.array(n)],
                    ["lang", "w1", "w2", "n"],
                )

    counted = _texts(docs).mapInArrow(run, "lang string, w1 string, w2 string, n long")
    return counted.groupBy("lang", "w1", "w2").agg(F.sum("n").alias("n"))


def count_triples(docs: DataFrame, pairs: Bits, prefixes: Bits, suffixes: Bits) -> DataFrame:
    """lang, w1, w2, w3, n of triples whose pairs may both be candidates, the first to be expanded or the second to be covered."""
    shared = docs.sparkSession.sparkContext.broadcast((pairs, prefixes, suffixes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, prefixes, suffixes = shared.value
        for batch in batches:
            for w in _read(batch):
                width, keys = max(len(w.word), 1), w.keys()
                here = np.flatnonzero(w.goes_on)
                both, code = np.unique(w.code[here] * width + w.code[here + 1], return_inverse=True)
                key = _joined(keys[both // width], keys[both % width])
                known, grows, covers = (f.holds(key) for f in (pairs, prefixes, suffixes))
                first = np.flatnonzero(here[1:] == here[:-1] + 1)  # a pair and the next one share a word
                a, b = code[first], code[first + 1]
                wanted = known[a] & known[b] & (grows[a] | covers[b])
                a, last = a[wanted], w.code[here[first + 1][wanted] + 1]
                three, n = np.unique(a * width + last, return_counts=True)
                two, last = both[three // width], pa.array(three % width)
                x, y = pa.array(two // width), pa.array(two % width)
                yield pa.record_batch(
                    [w.lang.take(x).cast(pa.string()), *[w.word.take(i).cast(pa.string()) for i in (x, y, last)], pa.array(n)],
                    ["lang", "w1", "w2", "w3", "n"],
                )

    counted = _texts(docs).mapInArrow(run, "lang string, w1 string, w2 string, w3 string, n long")
    return counted.groupBy("lang", "w1", "w2", "w3").agg(F.sum("n").alias("n"))


def _score(a: str, l: str, r: str) -> Column:
    """floor(1,000,000 * a * a / (l * r)) in whole numbers of 38 digits: counts up to 10^15 are exact."""
    wide = "cast({} as decimal(15,0))".format
    return F.expr(f"(cast({SCALE} as decimal(7,0)) * ({wide(a)} * {wide(a)})) div ({wide(l)} * {wide(r)})")


def _best(rows: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows of each language; tasks drop what cannot be among them before the shuffle."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= n)


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, cover: int = COVER, first: int = FIRST) -> DataFrame:
    """The `top` phrases of two and three words of each language by score: lang, rank, phrase, a, l, r, n, score.

    Of texts in lower case (A-Z only; null: empty) and languages (null: und). Phrases stay inside pieces, occur at least `least`
    times, and are dropped if a longer candidate around them occurs at least `cover` percent as often. The score is that of the
    worst cut, of equal ones the first; ties go to the larger count, then to the phrase. Other columns are not looked at. An
    empty table, or one without words, gives no rows.
    """
    small_batches(docs.sparkSession)
    words = stored(count_words(docs).where((F.col("n") >= least) | F.col("word").isNull()), "words")
    totals = words.where("word is null").select("lang", F.col("n").alias("total"))
    words = words.where("word is not null")
    counted = count_pairs(docs, _filter(words, ["word"], words.count())).where(F.col("n") >= least)
    one, other = (words.select("lang", F.col("word").alias(w), F.col("n").alias(f)) for w, f in (("w1", "l"), ("w2", "r")))
    pairs = counted.withColumnRenamed("n", "a").join(one, ["lang", "w1"]).join(other, ["lang", "w2"])
    pairs = stored(
        pairs.select(
            "lang", "w1", "w2", "a", "l", "r", _score("a", "l", "r").alias("score"),
            F.expr(f"({SCALE} * cast(a as decimal(15,0))) div l").alias("bound"),
        ),
        "pairs",
    )
    candidates = _filter(pairs, ["w1", "w2"], pairs.count())
    asked, open_langs, settled, wave = first * top, totals.select("lang"), [], 0
    while True:
        own = pairs.join(open_langs, "lang", "left_semi")
        # The limit of a language: the score of its last pair asked for, 0 if it has no more pairs.
        lasts = _best(own, asked, F.col("score").desc()).groupBy("lang").agg(F.min("score").alias("low"), F.count("*").alias("k"))
        limits = open_langs.join(lasts, "lang", "left").select(
            "lang", F.when(F.col("k") >= asked, F.col("low")).otherwise(0).alias("limit")
        )
        limits = stored(limits, "limits")
        own = own.join(limits, "lang")
        grown, covered = own.where("bound >= limit"), own.where("score >= limit")
        sizes = own.agg(F.count_if(F.col("bound") >= F.col("limit")), F.count_if(F.col("score") >= F.col("limit"))).first()
        triples = count_triples(
            docs, candidates, _filter(grown, ["w1", "w2"], sizes[0]), _filter(covered, ["w1", "w2"], sizes[1])
        )
        triples = stored(triples.where(F.col("n") >= least).withColumnRenamed("n", "a"), "triples")
        around = triples.select("lang", "w1", "w2", "a").unionByName(
            triples.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a")
        )
        around = around.groupBy("lang", "w1", "w2").agg(F.max("a").alias("longer"))
        whole = covered.join(around, ["lang", "w1", "w2"], "left")
        whole = whole.where(F.coalesce(F.col("longer") * 100 < F.col("a") * cover, F.lit(True)))
        whole = whole.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", "score")
        start, rest = (
            words.select("lang", F.col("word").alias("w1"), F.col("n").alias("l1")),
            words.select("lang", F.col("word").alias("w3"), F.col("n").alias("r2")),
        )
        head = pairs.select("lang", "w1", "w2", F.col("a").alias("l2"))
        tail = pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("r1"))
        cuts = triples.join(head, ["lang", "w1", "w2"]).join(tail, ["lang", "w2", "w3"])
        cuts = cuts.join(start, ["lang", "w1"]).join(rest, ["lang", "w3"])
        cuts = cuts.withColumns({"s1": _score("a", "l1", "r1"), "s2": _score("a", "l2", "r2")})
        early = F.col("s1") <= F.col("s2")
        longer = cuts.join(limits, "lang").select(
            "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
            F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"),
            F.when(early, F.col("r1")).otherwise(F.col("r2")).alias("r"),
            F.least("s1", "s2").alias("score"), "limit",
        ).where("score >= limit").drop("limit")
        best = stored(
            _best(whole.unionByName(longer), top, F.col("score").desc(), F.col("a").desc(), F.col("phrase")), "best"
        )
        full = best.groupBy("lang").agg(F.count("*").alias("k"))
        state = limits.join(full, "lang", "left")
        enough = (F.col("limit") == 0) | (F.coalesce("k", F.lit(0)) >= top)
        settled.append(best.join(state.where(enough).select("lang"), "lang", "left_semi"))
        open_langs = stored(state.where(~enough).select("lang"), "open_languages")
        if open_langs.isEmpty():
            break
        wave += 1
        asked *= MORE
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score"
    )
