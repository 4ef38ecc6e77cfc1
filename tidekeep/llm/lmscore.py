"""Document probabilities from subword lattices.

Every segmentation of a word into the pieces of a given vocabulary contributes to its probability (`lattice.py`); bytes stand
in where no piece fits. Piece weights start from the vocabulary's own scores and are re-estimated by expectation maximisation
over the distinct training words of each class of documents (by `lang`, the most frequent classes apart). A word seen in
training is an arc of its own besides: its discounted relative frequency, the rest being shared out by the lattice. A text's
probability is the sum over classes of class weight times the product over its words and its end; its own class is not used.

Word counts cover the whole corpus and are never sent to the driver or broadcast. Documents are dealt into blocks of bounded
bytes. Each block's distinct words are joined with the scored words, and the few rows that come back meet the block's texts
again, so what is shuffled is distinct words per block instead of one row per occurrence. The driver holds one weight per
piece and class.

A null or empty text is its end alone. Without any training row, piece weights are the vocabulary's. Rows without an id count
as training rows. Repeated rows each count. Other columns are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, stored
from .lattice import Lattice, load_pieces
from .quality import fold
from .tokens import SPACES, mix, slices, words_of

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
BLOCK_BYTES = 24 << 20
SLICE = 1 << 20
CLASSES = 8
ROUNDS = 3
DISCOUNT = 0.75
# Weight of the vocabulary's own scores among the expected counts.
PRIOR = 10.0


def _blocks(docs: DataFrame, held: F.Column, classes: list) -> DataFrame:
    """doc_id, text, block and class: the index of the training row's class, -1 for held-out rows."""
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    weight = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n = max(-(-weight // BLOCK_BYTES), spark.sparkContext.defaultParallelism)
    kind = F.lit(len(classes))
    if "lang" in docs.columns:
        for k, c in enumerate(classes):
            kind = F.when(F.col("lang").cast("string").eqNullSafe(F.lit(c)), k).otherwise(kind)
    block = F.pmod(F.xxhash64(F.col("doc_id").cast("long"), text), F.lit(n)).cast("int")
    return docs.select(
        F.col("doc_id").cast("long"), text.alias("text"), block.alias("block"),
        F.when(held, -1).otherwise(kind).cast("int").alias("class"),
    )


def _words(blocks: DataFrame, k: int) -> DataFrame:
    """block, word, c0 … : the distinct words of each block and how often training rows of each class use them."""
    names = [f"c{i}" for i in range(k)]

    def run(table: pa.Table) -> pa.Table:
        kept = {n: [] for n in ("key", "word", "kind", "n")}
        for batch in table.combine_chunks().to_batches():
            for part in slices(batch, "text", SLICE):
                words = words_of(part.column("text"), SPACES)
                kind = part.column("class").to_numpy()[words.owners()]
                keys = words.keys()
                both = keys ^ mix(kind.astype(np.uint64) + np.uint64(2))
                order = np.argsort(both)
                new = np.ones(len(order), bool)
                new[1:] = np.diff(both[order]) != 0
                at = np.flatnonzero(new)
                kept["key"].append(keys[order[at]])
                kept["kind"].append(kind[order[at]])
                kept["n"].append(np.diff(np.append(at, len(order))))
                kept["word"].append(words.strings(order[at]))
        word = pa.chunked_array(kept["word"], pa.large_string()).combine_chunks()
        key, kind, n = (np.concatenate(kept[c]) if kept[c] else np.zeros(0, np.int64) for c in ("key", "kind", "n"))
        key, first, which = np.unique(key, return_index=True, return_inverse=True)
        out = {"block": pa.array(np.full(len(key), table.column("block")[0].as_py()), pa.int32())}
        out["word"] = word.take(pa.array(first)).cast(pa.string())
        for i, name in enumerate(names):
            own = kind == i
            out[name] = pa.array(np.bincount(which[own], weights=n[own], minlength=len(key)).astype(np.int64))
        return pa.table(out)

    schema = "block int, word string, " + ", ".join(f"{n} long" for n in names)
    return blocks.groupBy("block").applyInArrow(run, schema)


class Model:
    """Piece weights of each class, and what is left for them beside the words seen."""

    def __init__(self, pieces: list[bytes], scores: np.ndarray, k: int):
        self.pieces, self.k = pieces, k
        prior = 1 / (2 + np.minimum(-scores, 10.0 * len(pieces)))
        self.prior = prior / prior.sum()
        self.logs = [np.log(self.prior)] * k

    def prepare(self, docs_of: dict[int, int], totals) -> None:
        """docs_of: training documents by class. totals: words and distinct words of each class."""
        known = sum(docs_of.values())
        self.n = [int(totals[f"n{i}"] or 0) + docs_of.get(i, 0) for i in range(self.k)]
        self.left = [min(1.0, DISCOUNT * int(totals[f"v{i}"] or 0) / n) if n else 0.5 for i, n in enumerate(self.n)]
        self.end = [math.log(docs_of[i] / n) if docs_of.get(i) else math.log(0.5) for i, n in enumerate(self.n)]
        self.weight = [math.log(docs_of[i] / known) if docs_of.get(i) else -np.inf for i in range(self.k)]
        if not known:
            self.weight[0] = 0.0


def _gathered(batches, rows: int = 50_000):
    """Batches of a table of words joined into larger ones, which numpy works through with fewer calls."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks()
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def _estimate(model: Model, counts: DataFrame) -> None:
    """Expectation maximisation: a task adds up what it expects of each piece, the driver gets one number per piece and class."""
    spark = counts.sparkSession
    for _ in range(ROUNDS):
        sent = spark.sparkContext.broadcast((model.pieces, model.logs))

        def run(batches, sent=sent):
            pieces, logs = sent.value
            lattice, sums = Lattice(pieces), {}
            for batch in _gathered(batches):
                words = [w.encode() for w in batch.column("word").to_pylist()]
                used = np.stack([batch.column(f"c{i}").to_numpy() > 0 for i in range(len(logs))], axis=1)
                some = np.flatnonzero(used.any(axis=1))
                # One lattice of a word serves all classes that use it.
                found = lattice.expected_each([words[j] for j in some], used[some].astype(float), logs)
                for i, own in enumerate(found):
                    sums[i] = sums.get(i, 0) + own
            for i, s in sums.items():
                at = np.flatnonzero(s > 0)
                kind = pa.array(np.full(len(at), i), pa.int32())
                yield pa.RecordBatch.from_arrays([kind, pa.array(at, pa.int32()), pa.array(s[at])], ["class", "piece", "s"])

        found = counts.mapInArrow(run, "class int, piece int, s double")
        found = found.groupBy("class", "piece").agg(F.sum("s").alias("s")).toArrow()
        model.logs = []
        for i in range(model.k):
            own = found.filter(pa.compute.equal(found.column("class"), i))
            weight = PRIOR * model.prior
            np.add.at(weight, own.column("piece").to_numpy(), own.column("s").to_numpy())
            model.logs.append(np.log(weight / weight.sum()))


def _scored(model: Model, counts: DataFrame) -> DataFrame:
    """word, key, c (in all training rows) and lp: its log probability in each class, as 32-bit floats."""
    sent = counts.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = sent.value
        lattice = Lattice(m.pieces)
        for batch in _gathered(batches):
            words = [w.encode() for w in batch.column("word").to_pylist()]
            spelled = lattice.likelihood(words, m.logs)
            c = np.stack([batch.column(f"c{i}").to_numpy() for i in range(m.k)], axis=1)
            lp = np.zeros(c.shape, np.float32)
            for i in range(m.k):
                lattice_part = math.log(m.left[i]) + spelled[:, i] if m.left[i] else -np.inf
                with np.errstate(divide="ignore"):
                    own = np.log(np.maximum(c[:, i] - DISCOUNT, 0) / max(m.n[i], 1))
                lp[:, i] = np.logaddexp(lattice_part, own)
            key = words_of(batch.column("word"), SPACES).keys()
            yield from pa.table(
                {
                    "word": batch.column("word"),
                    "key": pa.array(key.view(np.int64)),
                    "c": pa.array(c.sum(axis=1)),
                    "lp": pa.array([r.tobytes() for r in lp], pa.binary()),
                }
            ).to_batches(5000)

    return counts.mapInArrow(run, "word string, key long, c long, lp binary")


def scores(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every text.

    Rows of crc32 remainder 1 by 5 teach nothing. base_score is the smoothed unigram of whole words.
    """
    spark = docs.sparkSession
    small_batches(spark)
    held = fold(5) == 1
    classes: list = []
    if "lang" in docs.columns:
        top = docs.where(~held).groupBy(F.col("lang").cast("string").alias("lang")).count()
        classes = [r["lang"] for r in top.orderBy(F.desc("count"), "lang").limit(CLASSES).collect()]
    # Less frequent classes share the last one.
    classes = classes[: CLASSES - 1] if len(classes) == CLASSES else classes[:-1]
    k = len(classes) + 1
    blocks = _blocks(docs, held, classes)
    words = stored(_words(blocks, k), "block-words")
    names = [f"c{i}" for i in range(k)]
    counts = stored(words.groupBy("word").agg(*[F.sum(c).alias(c) for c in names]), "counts")
    seen = sum(F.col(c) for c in names)
    totals = counts.agg(
        F.sum(seen).alias("n"), F.count_if(seen > 0).alias("v"),
        *[F.sum(c).alias(f"n{i}") for i, c in enumerate(names)],
        *[F.count_if(F.col(c) > 0).alias(f"v{i}") for i, c in enumerate(names)],
    ).first()
    docs_of = {r["class"]: r["count"] for r in blocks.where("class >= 0").groupBy("class").count().collect()}
    model = Model(*load_pieces(vocabulary), k)
    # Rare words are where the lattice speaks; a frequent one counts like any other.
    _estimate(model, counts)
    model.prepare(docs_of, totals)
    ends = sum(docs_of.values())
    tokens, distinct = int(totals["n"] or 0) + ends, int(totals["v"] or 0) + (ends > 0)
    small = [model.end, model.weight]

    def run(table: pa.Table, found: pa.Table) -> pa.Table:
        key = found.column("key").to_numpy().view(np.uint64)
        order = np.argsort(key)
        key = key[order]
        c = found.column("c").to_numpy()[order]
        lp = np.frombuffer(b"".join(found.column("lp").to_pylist()), np.float32).reshape(len(order), k)[order]
        base = np.log10((np.append(c, ends) + 0.5) / (tokens + 0.5 * (distinct + 1)))
        parts = []
        for batch in table.combine_chunks().to_batches():
            for part in slices(batch, "text", SLICE):
                words = words_of(part.column("text"), SPACES)
                n, owner = len(words.counts), words.owners()
                at = np.searchsorted(key, words.keys())
                each = np.stack([np.bincount(owner, weights=lp[at, i], minlength=n) for i in range(k)])
                each += (np.array(small[0]) + np.array(small[1]))[:, None]
                parts.append(
                    pa.table(
                        {
                            "doc_id": part.column("doc_id"),
                            "n_tokens": pa.array(words.counts + 1, pa.int64()),
                            "n_known": pa.array(
                                np.bincount(owner, weights=c[at] > 0, minlength=n).astype(np.int64) + (ends > 0), pa.int64()
                            ),
                            "base_score": pa.array(np.bincount(owner, weights=base[at], minlength=n) + base[-1]),
                            "score": pa.array(np.logaddexp.reduce(each, axis=0) / math.log(10)),
                        }
                    )
                )
        return pa.concat_tables(parts) if parts else _EMPTY.empty_table()

    scored = words.select("block", "word").join(_scored(model, counts), "word").select("block", "key", "c", "lp")
    both = blocks.groupBy("block").cogroup(scored.groupBy("block"))
    out = both.applyInArrow(run, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return out.select(
        "doc_id", held.alias("held_out"), "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
        "base_score", "score",
    )


_EMPTY = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
)
