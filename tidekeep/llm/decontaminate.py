"""Benchmark passages in documents, found with an FM-index per training shard.

Documents stream through their scan's tasks. A few hundred thousand words at a time become one shard: an FM-index of its words is
built, every benchmark window runs backwards through it at once, and the occurrences are located by sampled suffix positions
and merged into spans per document. Nothing is shuffled, and a task holds one shard.

A window is `size` consecutive words of an item; an item of fewer words, but not none, is one window. Words are runs of
letters, digits and characters beyond ASCII, with A-Z in lower case. Windows do not cross documents. Words are searched by 64-bit
keys, and what is found is compared byte by byte. Windows travel to the tasks
at most `WINDOWS` (window, item) pairs at a time: a larger benchmark takes as many passes as it needs.

Null, empty and wordless texts have no words and no hits. Repeated documents are each searched; repeated items count once by
their id. Items without an id mark words but are not listed. Further columns of documents are kept as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released, small_batches, stored
from .fmindex import FMIndex
from .tokens import NOT_ALNUM, Words, slices, utf8, words_of

WINDOWS = 500_000
SHARD_BYTES = 3 << 20
FOUND = "n_words long, n_hit long, spans array<struct<start:long,stop:long>>, items array<long>"


def _joined(words: Words, here: slice) -> bytes:
    """The bytes of consecutive words, joined by blanks."""
    return b" ".join(words.data[a:b].tobytes() for a, b in zip(words.starts[here], words.ends[here], strict=True))


def windows(benchmark: DataFrame, size: int) -> DataFrame:
    """Distinct windows (keys of their words, 8 bytes each), their words joined by blanks, and item_id."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                words = words_of(part.column("text"), NOT_ALNUM)
                keys, ids, seen = words.keys(), part.column("item_id"), {}
                for k, (at, n) in enumerate(zip(words.first[:-1], words.counts, strict=True)):
                    for i in range(max(0, n - size) + 1 if n else 0):
                        here = slice(at + i, at + min(n, i + size))
                        seen[keys[here].tobytes(), _joined(words, here), k] = None
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([w for w, _, _ in seen], pa.binary()), pa.array([p for _, p, _ in seen], pa.binary()),
                        ids.take(pa.array([k for _, _, k in seen], pa.int64())),
                    ],
                    ["window", "phrase", "item_id"],
                )

    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    return items.mapInArrow(run, "window binary, phrase binary, item_id long").distinct()


class _Phrases:
    def __init__(self, rows: list, size: int):
        by_window: dict[tuple[bytes, bytes], list[int]] = {}
        for window, phrase, item in rows:
            ids = by_window.setdefault((bytes(window), bytes(phrase)), [])
            if item is not None:
                ids.append(item)
        self.lengths = np.array([len(w) // 8 for w, _ in by_window], np.int64)
        self.keys = np.zeros((len(by_window), size), np.uint64)
        for k, (w, _) in enumerate(by_window):
            self.keys[k, : len(w) // 8] = np.frombuffer(w, np.uint64)
        self.phrases = [p for _, p in by_window]
        self.items = [np.array(ids, np.int64) for ids in by_window.values()]


def _search(words: Words, phrases: _Phrases) -> tuple[np.ndarray, list[np.ndarray]]:
    """Which words lie in an occurrence, and the items found in each text."""
    texts = len(words.counts)
    hit, found = np.zeros(len(words), bool), [np.zeros(0, np.int64)] * texts
    if not len(words) or not len(phrases.lengths):
        return hit, found
    known, symbols = np.unique(words.keys(), return_inverse=True)
    place = np.arange(len(words)) + words.owners()
    text = np.full(len(words) + texts, len(known) + 1, np.int32)
    text[place] = symbols + 1
    index = FMIndex(text, len(known) + 1)
    at = np.minimum(np.searchsorted(known, phrases.keys), len(known) - 1)
    there = (known[at] == phrases.keys) | (np.arange(phrases.keys.shape[1]) >= phrases.lengths[:, None])
    asked = np.flatnonzero(there.all(axis=1))
    low, high = index.search(at[asked] + 1, phrases.lengths[asked])
    counts = high - low
    which = np.repeat(asked, counts)
    rows = np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    where = index.locate(rows)
    # Words were found by their keys; what counts is their bytes.
    begin = where - np.searchsorted(words.first + np.arange(texts + 1), where, "right") + 1
    same = [
        _joined(words, slice(b, b + n)) == phrases.phrases[k]
        for b, n, k in zip(begin.tolist(), phrases.lengths[which].tolist(), which.tolist(), strict=True)
    ]
    same = np.array(same, bool)
    where, which = where[same], which[same]
    edge = np.zeros(len(text) + 1, np.int64)
    np.add.at(edge, where, 1)
    np.add.at(edge, where + phrases.lengths[which], -1)
    hit = (np.cumsum(edge[:-1]) > 0)[place]
    owner = np.searchsorted(words.first + np.arange(texts + 1), where, "right") - 1
    pairs = np.unique(np.stack([owner, which]), axis=1) if len(owner) else np.zeros((2, 0), np.int64)
    for k in np.unique(pairs[0]):
        found[k] = np.unique(np.concatenate([phrases.items[w] for w in pairs[1][pairs[0] == k]]))
    return hit, found


def _runs(hit: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last word of each run of hit words within a text."""
    at = np.flatnonzero(hit)
    if not len(at):
        return at, at
    cut = np.flatnonzero((np.diff(at) > 1) | (np.diff(owner[at]) > 0))
    return at[np.append(0, cut + 1)], at[np.append(cut, len(at) - 1)]


def _merged(before: list, now: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted([(s["start"], s["stop"]) for s in before or []] + now):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def _shard(table: pa.Table, phrases: _Phrases) -> pa.Table:
    words = Words(*utf8(table.column("text")), NOT_ALNUM)
    hit, found = _search(words, phrases)
    owner = words.owners()
    if "items" in table.column_names:  # a later pass adds to what the earlier ones found
        before, items = table.column("spans").to_pylist(), table.column("items").to_pylist()
        found = [np.union1d(a, np.array(b or [], np.int64)) for a, b in zip(found, items, strict=True)]
        start = utf8(table.column("text"))[1]
        for k, spans in enumerate(before):
            for s in spans:
                a, b = np.searchsorted(words.starts, [start[k] + s["start"], start[k] + s["stop"]])
                hit[a:b] = True
        table = table.drop_columns(["n_words", "n_hit", "spans", "items"])
    first, last = _runs(hit, owner)
    origin = utf8(table.column("text"))[1][owner[first]] if len(first) else first
    spans = pa.StructArray.from_arrays(
        [pa.array(words.starts[first] - origin, pa.int64()), pa.array(words.ends[last] - origin, pa.int64())],
        ["start", "stop"],
    )
    ends = np.searchsorted(owner[first], np.arange(len(words.counts) + 1)) if len(first) else np.zeros(len(words.counts) + 1, np.int64)
    listed = np.concatenate([[0], np.cumsum([len(x) for x in found])])
    hits = np.bincount(owner[hit], minlength=len(words.counts)) if len(words) else np.zeros(len(words.counts))
    extra = {
        "n_words": pa.array(words.counts, pa.int64()),
        "n_hit": pa.array(hits.astype(np.int64)),
        "spans": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans),
        "items": pa.ListArray.from_arrays(
            pa.array(listed, pa.int32()), pa.array(np.concatenate([*found, np.zeros(0, np.int64)]), pa.int64())
        ),
    }
    for name, column in extra.items():
        table = table.append_column(name, column)
    return table


def mark(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """docs with n_words, n_hit, spans (bytes of the UTF-8 text to remove, merged) and items (ids whose windows occur).

    Columns of docs with these names are replaced.
    """
    spark = docs.sparkSession
    small_batches(spark)
    pairs = stored(windows(benchmark, size), "windows")
    passes = max(1, -(-pairs.count() // WINDOWS))
    out = docs.drop("n_words", "n_hit", "spans", "items").withColumn("text", F.col("text").cast("string"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema) + ", " + FOUND
    for k in range(passes):
        part = pairs.where(F.pmod(F.xxhash64("window", "phrase", "item_id"), F.lit(passes)) == k).collect()
        sent = spark.sparkContext.broadcast(_Phrases(part, size))

        def run(batches, sent=sent):
            held, weight = [], 0
            for batch in batches:
                for x in slices(batch, "text", SHARD_BYTES):
                    held.append(x)
                    weight += len(utf8(x.column("text"))[0])
                    if weight >= SHARD_BYTES // 2:
                        yield from _shard(pa.Table.from_batches(held), sent.value).to_batches()
                        held, weight = [], 0
            if held:
                yield from _shard(pa.Table.from_batches(held), sent.value).to_batches()

        out = out.mapInArrow(released(run), schema)
        if k < passes - 1:
            out = stored(out, "marked")
    return out


def report(marked: DataFrame) -> DataFrame:
    """The digest of each marked document."""
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return marked.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """docs without the passages of the benchmark: each span gives way to one blank. Texts without a hit stay as they are,
    and a document of which no word is left goes. n_chars, where there is one, follows the text.
    """
    clash = {c: f"__own_{c}" for c in docs.columns if c in ("n_words", "n_hit", "spans", "items")}
    marked = mark(docs.withColumnsRenamed(clash), benchmark, size)

    def cut(batches):
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                if spans:
                    data, at, left = text.encode(), 0, []
                    for s in spans:
                        left.append(data[at : s["start"]])
                        at = s["stop"]
                    text = b" ".join([*left, data[at:]]).decode()
                texts.append(text)
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, "text", pa.array(texts, batch.schema.field("text").type))

    left = marked.where("n_hit = 0 or n_hit < n_words").mapInArrow(released(cut), marked.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        left = left.withColumn("n_chars", F.when(F.col("n_hit") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return left.select(*[F.col(clash.get(c, c)).alias(c) for c in docs.columns])
