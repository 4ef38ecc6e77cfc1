"""Near-duplicate documents by bottom-k sketches of one hash function.

A document's set holds its distinct word shingles under one 64-bit hash; its sketch is the smallest `SKETCH` values. Two
documents are linked if the Jaccard similarity of their full sets reaches the threshold.

1. Documents with equal sets form a class at once; its smallest id represents it from here on.
2. Inverted lists hold the smallest `LISTED` values of each representative, rarest first, and only as many of them as two
   linked documents need in order to meet in one list. Values held by one document only are never listed.
3. Short lists give their pairs directly. Of long lists that hold the same documents one is kept. They are cut into blocks, and
   tasks pass on spanning forests of what they find, so a list never emits all its pairs. First each block is compared with
   itself; then, in lists that the links so far leave in several components, all blocks with each other, but only documents of
   different components.
4. The overlap of two sketches below their common bound estimates the similarity. Sketches that hold whole sets give it
   exactly; other pairs whose estimate is not far below the threshold are verified on the full sets. Between components this is
   done where the blocks are compared: the documents with such pairs, not the pairs, are passed on, and their full sets are
   compared block by block.

Choosing the listed values and the estimate's margin loses a link with a probability below 1e-6 per pair.

Null or wordless texts have an empty set and are linked with nothing. Rows with the same id are one node, and
of their sets, if they differ, the one with the smallest digest is compared. Rows without an id
are returned with the component of their class. Ties fall to the smaller id. Columns beyond id and text are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import components, released, small_batches, stored
from .tokens import SPACES, shingles, slices, words_of

SKETCH = 256
LISTED = 64
LONG_LIST = 16
BLOCK = 1024
# Bytes of full sets in a block, about.
BLOCK_BYTES = 24 << 20
# Ids sent to every executor at most; more are joined by a shuffle.
BROADCAST_IDS = 1 << 20


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for part in slices(batch, "text"):
        values, counts = shingles(words_of(part.column("text"), SPACES), size)
        yield part, values, np.concatenate([[0], np.cumsum(counts)])


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, set_key (a digest of the whole set) and the sketch as little-endian 64-bit values in order."""

    def run(batches):
        for batch in batches:
            for part, values, at in _sets(batch, size):
                sets = [values[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id"),
                        "n_shingles": pa.array(np.diff(at), pa.int64()),
                        "set_key": pa.array([hashlib.sha1(s.tobytes()).digest() for s in sets], pa.binary()),
                        "sketch": pa.array([s[:SKETCH].tobytes() for s in sets], pa.binary()),
                    }
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, set_key binary, sketch binary"
    )


def _postings(reps: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            lists = [np.frombuffer(s, np.int64)[:LISTED] for s in batch.column("sketch").to_pylist()]
            counts = np.array([len(x) for x in lists], np.int64)
            if counts.sum():
                n = pa.array(np.repeat(counts, counts), pa.int32())
                ids = batch.column("doc_id").take(pa.array(np.repeat(np.arange(len(lists)), counts)))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(lists)), ids, n], ["value", "doc_id", "n"])

    low = reps.select("doc_id", F.substring("sketch", 1, 8 * LISTED).alias("sketch"))
    return low.mapInArrow(run, "value long, doc_id long, n int")


def _needed(n: F.Column, t: float) -> F.Column:
    """Listed values that a document of n of them shares with any document it is linked with."""
    sure = F.ceil(n * t - 1e-9)
    likely = math.floor(LISTED * t - 6 * math.sqrt(LISTED * t * (1 - t)))
    return F.when(n <= LISTED * t, sure).otherwise(F.lit(likely)).cast("int")


def _lists(reps: DataFrame, t: float) -> DataFrame:
    """value, doc_id, size: the inverted lists of two documents or more."""
    postings = _postings(reps)
    often = postings.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    shared = postings.join(often, "value")
    order = Window.partitionBy("doc_id").orderBy("df", "value")
    alone = F.col("n") - F.count("*").over(Window.partitionBy("doc_id"))
    place = alone + F.row_number().over(order)
    kept = shared.withColumn("place", place).where(F.col("place") <= F.col("n") - _needed(F.col("n"), t) + 1)
    kept = stored(kept.select("value", "doc_id"), "postings")
    sizes = kept.groupBy("value").agg(F.count("*").alias("size")).where("size > 1")
    return stored(kept.join(sizes, "value"), "lists")


def _pairwise(a: list[np.ndarray], b: list[np.ndarray], na: np.ndarray, nb: np.ndarray, t: float) -> tuple[np.ndarray, np.ndarray]:
    """For each pair of sketches, the estimated similarity and the margin of an estimate at threshold t (0 where it is exact)."""
    est, margin = np.zeros(len(a)), np.zeros(len(a))
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        whole = na[i] <= SKETCH and nb[i] <= SKETCH
        if not whole:
            bound = min(x[-1] if na[i] > SKETCH else y[-1], y[-1] if nb[i] > SKETCH else x[-1])
            x, y = x[: np.searchsorted(x, bound, "right")], y[: np.searchsorted(y, bound, "right")]
        both = np.concatenate([x, y])
        both.sort()
        common = int(np.count_nonzero(both[1:] == both[:-1]))
        union = len(x) + len(y) - common
        est[i] = common / union
        if not whole:
            total = max(union, (na[i] + nb[i]) / (1 + t))
            margin[i] = 5 * math.sqrt(t * (1 - t) / union * (1 - union / total)) + 1 / union
    return est, margin


def _judge(a, b, na, nb, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs linked for sure, and pairs to be verified."""
    est, margin = _pairwise(a, b, na, nb, percent / 100)
    exact = margin == 0
    return exact & (est >= percent / 100 - 1e-12), ~exact & (est + margin >= percent / 100)


_PAIRS = "a long, b long, sure boolean, est double"


def _u64(values: list[bytes]) -> list[np.ndarray]:
    return [np.frombuffer(v, np.uint64) for v in values]


def _short_pairs(lists: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    short = lists.where(F.col("size") <= LONG_LIST).select("value", "doc_id")
    pairs = (
        short.select("value", F.col("doc_id").alias("a"))
        .join(short.select("value", F.col("doc_id").alias("b")), "value")
        .where("a < b")
        .select("a", "b")
        .distinct()
    )
    side = reps.select("doc_id", "n_shingles", "sketch")
    pairs = pairs.join(side.toDF("a", "na", "sa"), "a").join(side.toDF("b", "nb", "sb"), "b")
    pairs = pairs.where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)

    def run(batches):
        for x in batches:
            sa, sb = _u64(x.column("sa").to_pylist()), _u64(x.column("sb").to_pylist())
            sure, ask = _judge(sa, sb, x.column("na").to_numpy(), x.column("nb").to_numpy(), percent)
            keep = pa.array(sure | ask)
            out = [x.column("a"), x.column("b"), pa.array(sure), pa.array(np.zeros(len(sure)))]
            yield pa.RecordBatch.from_arrays(out, ["a", "b", "sure", "est"]).filter(keep)

    return pairs.mapInArrow(run, _PAIRS)


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Shared values of every left and right sketch, a slab of values at a time."""
    out = np.zeros((len(left), len(right)), np.float32)
    values, at = np.unique(np.concatenate(left), return_inverse=True)
    row = np.repeat(np.arange(len(left)), [len(x) for x in left])
    there = np.concatenate(right)
    col = np.repeat(np.arange(len(right)), [len(x) for x in right])
    where = np.searchsorted(values, there)
    ok = (where < len(values)) & (values[np.minimum(where, len(values) - 1)] == there)
    where, col = where[ok], col[ok]
    used, where = np.unique(where, return_inverse=True)
    slot = np.full(len(values), -1)
    slot[used] = np.arange(len(used))
    at = slot[at]
    row, at = row[at >= 0], at[at >= 0]
    for low in range(0, len(used), 4096):
        x = np.zeros((len(left), 4096), np.float32)
        y = np.zeros((len(right), 4096), np.float32)
        here = (at >= low) & (at < low + 4096)
        x[row[here], at[here] - low] = 1
        here = (where >= low) & (where < low + 4096)
        y[col[here], where[here] - low] = 1
        out += x @ y.T
    return out


def _estimates(left, right, nl: np.ndarray, nr: np.ndarray, t: float) -> tuple[np.ndarray, np.ndarray]:
    """`_pairwise` of every left with every right sketch. Values that two sketches share lie below both their bounds."""
    common = _overlaps(left, right).astype(float)
    last = np.uint64(2**64 - 1)
    bl = np.array([s[-1] if k > SKETCH else last for s, k in zip(left, nl, strict=True)], np.uint64)
    br = np.array([s[-1] if k > SKETCH else last for s, k in zip(right, nr, strict=True)], np.uint64)
    below = np.stack([np.searchsorted(s, br, "right") for s in left])
    below = np.where(br[None, :] < bl[:, None], below, np.array([len(s) for s in left])[:, None])
    other = np.stack([np.searchsorted(s, bl, "right") for s in right], axis=1)
    other = np.where(bl[:, None] < br[None, :], other, np.array([len(s) for s in right])[None, :])
    union = below + other - common
    est = common / union
    total = np.maximum(union, np.add.outer(nl, nr) / (1 + t))
    margin = 5 * np.sqrt(t * (1 - t) / union * (1 - union / total)) + 1 / union
    margin[np.ix_(nl <= SKETCH, nr <= SKETCH)] = 0
    return est, margin


class _Forest:
    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while self.up.setdefault(x, x) != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _long_lists(lists: DataFrame) -> DataFrame:
    """value, doc_id: the long lists, one of those that hold the same documents."""
    rows = lists.where(F.col("size") > LONG_LIST)
    members = rows.groupBy("value").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"),
        F.sum(F.xxhash64("doc_id").cast("decimal(20,0)")).alias("h"), F.bit_xor(F.xxhash64(F.lit("list"), "doc_id")).alias("x"),
    )
    kept = members.groupBy("n", "lo", "hi", "h", "x").agg(F.min("value").alias("value")).select("value")
    return stored(rows.join(kept, "value").select("value", "doc_id", "size"), "long_lists")


def _blocks(rows: DataFrame, blocks: F.Column, diagonal: bool) -> DataFrame:
    """rows dealt to blocks of their list, and to all pairs of blocks i <= j, or to i = j only."""
    rows = rows.withColumn("own", F.pmod(F.xxhash64("doc_id"), blocks).cast("int"))
    if diagonal:
        return rows.withColumns({"i": F.col("own"), "j": F.col("own")})
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return rows.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("other")


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """rows of lists with several components, with the component of each document as label."""
    rows = rows.join(labels.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
    rows = rows.withColumn("label", F.coalesce("component", "doc_id")).drop("component")
    mixed = rows.groupBy("value").agg((F.min("label") != F.max("label")).alias("mixed")).where("mixed")
    return rows.join(mixed.select("value"), "value")


def _sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids and labels of a pair of blocks, and the rows of either side."""
    ids, label, own = (table.column(c).to_numpy() for c in ("doc_id", "label", "own"))
    return ids, label, np.flatnonzero(own == table.column("i")[0].as_py()), np.flatnonzero(own == table.column("j")[0].as_py())


def _apart(ids: np.ndarray, label: np.ndarray, left: np.ndarray, right: np.ndarray, same: bool) -> np.ndarray:
    """Pairs of different labels, each once."""
    pairs = label[left][:, None] != label[right][None, :]
    return pairs & ((ids[left][:, None] < ids[right][None, :]) if same else (ids[left][:, None] != ids[right][None, :]))


def _pairs_table(rows: list[tuple[int, int, bool, float]]) -> pa.Table:
    a, b, sure, est = zip(*rows) if rows else ((), (), (), ())
    return pa.table(
        {"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "sure": pa.array(sure, pa.bool_()), "est": pa.array(est, pa.float64())}
    )


def _block_pairs(rows: DataFrame, reps: DataFrame, percent: int, diagonal: bool) -> DataFrame:
    """a, b, sure. rows: value, doc_id, size, label.

    Inside blocks: forests of the sure pairs, and of those to be verified. Between components (not diagonal): a forest of the
    sure pairs, and each document with a pair to be verified once, as a pair with itself.
    """
    rows = _blocks(rows, F.ceil(F.col("size") / BLOCK).cast("int"), diagonal)
    rows = rows.join(reps.select("doc_id", "n_shingles", "sketch"), "doc_id")
    rows = rows.select("value", "i", "j", "own", "doc_id", "label", "n_shingles", "sketch")

    def run(table: pa.Table) -> pa.Table:
        ids, label, left, right = _sides(table)
        n, sk = table.column("n_shingles").to_numpy(), _u64(table.column("sketch").to_pylist())
        out: list[tuple[int, int, bool, float]] = []
        if len(left) and len(right):
            est, margin = _estimates([sk[k] for k in left], [sk[k] for k in right], n[left], n[right], percent / 100)
            exact = margin == 0
            hit = np.where(exact, est >= percent / 100 - 1e-12, est + margin >= percent / 100)
            hit &= _apart(ids, label, left, right, table.column("i")[0] == table.column("j")[0])
            x, y = np.nonzero(hit)
            est, exact = est[x, y], exact[x, y]
            x, y = left[x], right[y]
            known, asked, doubtful = _Forest(), _Forest(), set()
            for k in np.lexsort((-est, ~exact)):
                p, q = int(label[x[k]]), int(label[y[k]])
                if exact[k]:
                    if not known.join(p, q):
                        continue
                    asked.join(p, q)
                elif diagonal and not asked.join(p, q) or known.root(p) == known.root(q):
                    continue
                elif not diagonal:
                    doubtful.update((int(ids[x[k]]), int(ids[y[k]])))
                    continue
                p, q = int(ids[x[k]]), int(ids[y[k]])
                out.append((min(p, q), max(p, q), bool(exact[k]), float(est[k])))
            out += [(d, d, False, 0.0) for d in sorted(doubtful)]
        return _pairs_table(out)

    found = rows.groupBy("value", "i", "j").applyInArrow(run, _PAIRS)
    return found.groupBy("a", "b").agg(F.max("sure").alias("sure"), F.max("est").alias("est"))


def _whole_pairs(rows: DataFrame, whole: DataFrame, percent: int) -> DataFrame:
    """a, b: forests of the links between components, from full sets. rows: value, doc_id, label; whole: doc_id, whole."""
    rows = rows.join(whole, "doc_id")
    sizes = rows.groupBy("value").agg(F.count("*").alias("n"), F.sum(F.length("whole")).alias("bytes"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int")
    rows = _blocks(rows.join(sizes.select("value", blocks.alias("blocks")), "value"), F.col("blocks"), False)
    rows = rows.select("value", "i", "j", "own", "doc_id", "label", "whole")

    def run(table: pa.Table) -> pa.Table:
        ids, label, left, right = _sides(table)
        out = []
        if len(left) and len(right):
            sets = _u64(table.column("whole").to_pylist())
            n = np.array([len(s) for s in sets])
            common = _overlaps([sets[k] for k in left], [sets[k] for k in right]).astype(np.int64)
            union = np.add.outer(n[left], n[right]) - common
            hit = (100 * common >= percent * union) & _apart(ids, label, left, right, table.column("i")[0] == table.column("j")[0])
            forest = _Forest()
            for x, y in zip(*np.nonzero(hit)):
                p, q = int(left[x]), int(right[y])
                if forest.join(int(label[p]), int(label[q])):
                    out.append((min(int(ids[p]), int(ids[q])), max(int(ids[p]), int(ids[q])), True, 1.0))
        return _pairs_table(out)

    return rows.groupBy("value", "i", "j").applyInArrow(run, _PAIRS).select("a", "b").distinct()


def _whole_sets(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """doc_id and whole, the full set as 64-bit values in order, of the documents with these distinct ids."""
    n = ids.count()
    chosen = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(ids) if n <= BROADCAST_IDS else ids, "doc_id")

    def sets(batches):
        for batch in batches:
            for part, values, at in _sets(batch, size):
                found = [values[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
                digests = pa.array([hashlib.sha1(s).digest() for s in found], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), digests, pa.array(found, pa.binary())], ["doc_id", "set_key", "whole"]
                )

    # Of rows that share an id the set that stands for it elsewhere, too.
    whole = chosen.mapInArrow(released(sets), "doc_id long, set_key binary, whole binary").where("length(whole) > 0")
    one = whole.groupBy("doc_id").agg(F.min(F.struct("set_key", "whole")).alias("w"))
    return stored(one.select("doc_id", "w.whole"), "sets")


def _verify(docs: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs a, b whose full sets reach the threshold."""
    ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
    side = _whole_sets(docs, ids, size)

    def same(batches):
        for x in batches:
            keep = []
            for a, b in zip(_u64(x.column("wa").to_pylist()), _u64(x.column("wb").to_pylist()), strict=True):
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield pa.RecordBatch.from_arrays([x.column("a"), x.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    pairs = pairs.select("a", "b").join(side.toDF("a", "wa"), "a").join(side.toDF("b", "wb"), "b")
    return pairs.mapInArrow(same, "a long, b long")


def _settle(docs: DataFrame, pairs: DataFrame, size: int, percent: int, label: str) -> DataFrame:
    pairs = stored(pairs, label)
    links = pairs.where("sure").select("a", "b")
    return stored(links.unionByName(_verify(docs, pairs.where("not sure"), size, percent)), f"{label}-links")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id a document reaches over links) and kept, a row per row of docs.

    size: words of a shingle; percent: the Jaccard similarity, in hundredths, from which two documents are linked.
    """
    small_batches(docs.sparkSession)
    all_sets = stored(sketches(docs, size), "sketches")
    classes = all_sets.where("n_shingles > 0").groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    classes = stored(classes, "classes")
    shown = classes.where("rep is not null").groupBy(F.col("rep").alias("doc_id")).agg(F.min("set_key").alias("set_key"))
    reps = stored(all_sets.join(shown, ["doc_id", "set_key"]).dropDuplicates(["doc_id"]), "reps")
    # Rows that share an id but not a set tie their classes together.
    tied = all_sets.where("n_shingles > 0 and doc_id is not null").select("doc_id", "set_key").distinct()
    tied = tied.join(classes, "set_key").where("rep <> doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    lists = _lists(reps, percent / 100)
    links = _settle(docs, _short_pairs(lists, reps, percent), size, percent, "short")
    long = _long_lists(lists)
    inside = _block_pairs(long.withColumn("label", F.col("doc_id")), reps, percent, True)
    links = links.unionByName(_settle(docs, inside, size, percent, "inside"))
    across = stored(_block_pairs(_labelled(long, components(links)), reps, percent, False), "across")
    links = links.unionByName(across.where("sure").select("a", "b"))
    doubtful = stored(across.where("not sure").select(F.col("a").alias("doc_id")), "doubtful")
    if not doubtful.isEmpty():
        rows = _labelled(long.join(doubtful, "doc_id", "left_semi"), components(links))
        links = links.unionByName(stored(_whole_pairs(rows, _whole_sets(docs, doubtful, size), percent), "whole"))
    heads = components(links.unionByName(tied))
    out = all_sets.select("doc_id", "n_shingles", "set_key").join(classes, "set_key", "left")
    start = F.when(F.col("n_shingles") > 0, F.coalesce("rep", "doc_id")).otherwise(F.col("doc_id"))
    out = out.withColumn("rep", start).join(heads.withColumnRenamed("node", "rep"), "rep", "left")
    out = out.withColumn("component_id", F.coalesce("component", "rep"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return out.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))
