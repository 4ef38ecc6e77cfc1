"""Collocations, filter audits and packing against brute force, and on nulls, ties, repeats, long texts and empty tables."""

import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidekeep.llm import blooms, bpe, interaction, packing, phrases, windows
from tidekeep.llm.queries import table
from tidekeep.llm.tokens import utf8

SF = "/root/testdata/sf0.001"
# Extra columns with names that the operators use themselves.
EXTRA = "part string, mask int, rank long, score double, item long, `offset` long, w1 string, n long, __hash long"
CLASH = ("p", 1, 2, 3.0, 4, 5, "w", 6, 7)
DOCS = f"doc_id long, text string, lang string, {EXTRA}"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, *CLASH) for r in rows], DOCS)


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# ---- windows and filters


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab .\n", max_size=30), max_size=8), st.integers(1, 12))
def test_windows_hold_every_byte_once_and_cut_only_where_allowed(texts, limit):
    data, at = utf8(pa.array(texts, pa.string()))
    seen, lengths = b"", np.zeros(len(texts), int)
    for part, inside, first in windows.windows(at, data, lambda d: d == ord(" "), limit):
        end = len(seen) + len(part)
        assert end in at or data[end] == ord(" ")
        seen += part.tobytes()
        lengths[first : first + len(inside) - 1] += np.diff(inside)
    assert seen == data.tobytes() and lengths.tolist() == [len(t) for t in texts]


def test_blocks_never_deny_a_key_and_count_across_tasks(spark):
    keys = spark.range(0, 40_000, 1, 8).select(F.xxhash64("id").alias("k"))
    twice = keys.limit(0).union(keys.where("k % 3 = 0")).unionByName(keys).repartition(7)
    for blocks in (1, 5):
        made = blooms.merged_blocks(twice, blocks, least=2)
        placed = keys.withColumn("block", blooms.block_of(F.col("k"), blocks)).join(made, "block")
        found = placed.withColumn("r", blooms.reached(F.col("k"), F.col("words")))
        wrong = found.agg(F.count_if((F.col("k") % 3 == 0) & ~F.col("r")), F.count_if((F.col("k") % 3 != 0) & F.col("r"))).first()
        assert wrong[0] == 0 and wrong[1] < 0.1 * 40_000
        bits = blooms.Bits(blooms.merged_blocks(keys, blocks, least=1), blocks)
        own = np.array([r[0] for r in keys.collect()], np.int64).view(np.uint64)
        assert bits.holds(own).all() and bits.holds(own ^ np.uint64(0x5555555555555555)).mean() < 0.1
    assert blooms.merged_blocks(keys.limit(0), 1, 1).isEmpty()


# ---- 11 collocations


def brute_phrases(rows, least, top, cover=50):
    counts, totals = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", fold(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            own = counts.setdefault(lang, Counter())
            own.update(tuple(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in candidates.items():
            if any(100 * b >= cover * a for q, b in candidates.items() if len(q) > len(p) and p in (q[:2], q[1:])):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def chatter(seed, n, vocabulary):
    rng = np.random.default_rng(seed)
    texts = []
    for _ in range(n):
        words = [vocabulary[min(int(x), len(vocabulary) - 1)] for x in rng.geometric(0.12, rng.integers(0, 60))]
        texts.append("".join(w + [" ", "  ", "\t", ". ", ",", "\n", " "][rng.integers(0, 7)] for w in words))
    return texts


@pytest.mark.parametrize(("least", "top", "first"), [(2, 2000, 2), (3, 5, 1), (2, 40, 1), (1, 7, 1)])
def test_collocations_by_brute_force(spark, least, top, first):
    words = "the THE of red wine New york city über naïve x-y a1 #! Zürich and or not hot dog 中文 be to".split()
    texts = chatter(5, 60, words) + ["New York City. " * 30, "red wine red wine", None, "", " \t\n.,", "one"]
    rows = [(i, t, ["en", "de", None][i % 3]) for i, t in enumerate(texts)]
    rows += [rows[0], rows[1], (None, "red wine, hot dog", "en"), (None, "red wine, hot dog", "en")]
    found = phrases.collocations(docs_of(spark, rows).repartition(5), least=least, top=top, first=first)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == brute_phrases(rows, least, top)


def test_collocations_of_a_long_text_and_of_none(spark, monkeypatch):
    monkeypatch.setattr(phrases, "WINDOW", 4096)
    text = " ".join(f"w{i % 7} w{i % 3}" + "." * (i % 11 == 0) for i in range(30_000)) + " " + "unbroken" * 2000
    rows = [(1, text, "en"), (2, None, "fr"), (3, "", None)]
    found = phrases.collocations(docs_of(spark, rows))
    assert sorted(map(tuple, found.collect())) == brute_phrases(rows, 10, 2000)
    assert phrases.collocations(docs_of(spark, [])).collect() == []
    assert phrases.collocations(docs_of(spark, [(1, "a b", "en")])).collect() == []


def test_scores_are_whole_numbers_beyond_64_bits(spark):
    a, left, right = 4_000_000_000_000, 4_000_000_000_001, 4_000_000_000_003
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(phrases._score("a", "l", "r"))
    assert row.first()[0] == 1_000_000 * a * a // (left * right)


# ---- 12 filter audit


def brute_audit(docs, labels):
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    smallest = {}
    for i, text, _ in docs:
        if i is not None:
            smallest[text or ""] = min(i, smallest.get(text or "", i))
    parts = {}
    for i, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = "".join(
            k
            for k, test in zip(
                "ABCDE",
                (
                    len(words) < 100, 100 * len(set(words)) < 80 * len(words),
                    100 * len(re.findall("[A-Z]", text)) > 10 * len(text), bool(re.search("[#$%&*|]", text)),
                    i is not None and i > smallest[text],
                ),
            )
            if test
        )
        parts.setdefault(lang or "", []).append((failed, i is not None and i in good, i is not None and i in toxic))
    out = []
    for part, rows in parts.items():
        removed_in_all = Counter()
        own = []
        for order in map("".join, permutations("ABCDE")):
            left = rows
            for step, k in enumerate(order, 1):
                before = set(order[: step - 1])
                gone = [r for r in left if k in r[0]]
                left = [r for r in left if k not in r[0]]
                redundant = sum(k in r[0] and bool(before & set(r[0])) for r in rows)
                removed_in_all[k] += len(gone)
                unique = sum(r[0] == k for r in rows)
                own.append((part, order, step, len(left), len(gone), redundant, unique, sum(r[1] for r in gone), sum(r[2] for r in gone), k))
        out += [(*r[:-1], removed_in_all[r[-1]]) for r in own]
    return sorted(out)


def audit_rows(spark):
    long = " ".join(f"word{i}" for i in range(120))
    texts = [
        long, long, long.upper(), long + " #", "short", "short", None, "", " \t", "A" * 300, "same " * 150, long + "\x0bé" * 5,
        ("x" + str(7)) * 400_000, long.replace(" ", " "),
    ]
    rows = [(10 + i, t, ["en", "de", None, ""][i % 4]) for i, t in enumerate(texts)]
    rows += [(5, "short", "de"), (10, long, "en"), (None, long, "en"), (None, "short", None), (30, long, "fr")]
    labels = [(10, 1, 0), (10, 0, 1), (11, 1, 1), (12, 0, 1), (15, 1, None), (5, 1, 1), (None, 1, 1), (99, 1, 1)]
    return rows, labels


@pytest.mark.parametrize("settings_", [{}, {"docs_per_block": 2}, {"docs_per_block": 4, "broadcast_bytes": 0}])
def test_audit_by_brute_force(spark, settings_):
    rows, labels = audit_rows(spark)
    marks = spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, mask string")
    found = interaction.audit(docs_of(spark, rows).repartition(4), marks, **settings_)
    order = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(tuple, found.select(*order).collect())) == brute_audit(rows, labels)


def test_audit_when_hashes_collide(spark, monkeypatch):
    rows, labels = audit_rows(spark)
    real = F.xxhash64
    monkeypatch.setattr(interaction.F, "xxhash64", lambda c: real(F.length(c) % 2))
    found = interaction.audit(docs_of(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    order = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(tuple, found.select(*order).collect())) == brute_audit(rows, labels)


def test_audit_shuffles_no_cleared_text_and_nothing_of_an_empty_table(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert interaction.audit(docs_of(spark, []), labels).collect() == []
    rows = [(i, f"single text {i}", "en") for i in range(500)] + [(900, "single text 3", "en")]
    docs = docs_of(spark, rows)
    read = docs.select(F.col("doc_id").alias("__id"), F.col("text").alias("__text"), F.xxhash64("text").alias("__hash"))
    first = interaction.first_ids(read, read.select("__hash"), 1)
    assert [tuple(r)[1:3] for r in first.where("__copies > 1").collect()] == [("single text 3", 3)]
    assert first.count() < 50
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and plan.index("HashAggregate") < plan.index("BroadcastHashJoin")


# ---- 13 packing


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(packing.default_tokenizer())


def whole_ids(encoder, texts):
    return [e.ids for e in encoder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def encoded(encoder, texts):
    ids, counts = encoder.encode(*utf8(pa.array(texts, pa.string())))
    ends = np.cumsum(counts)
    return [ids[e - c : e].tolist() for e, c in zip(ends, counts)]


ODD = [
    "", " ", "  a", "a  b", "a \n b", "a  b", "a 　b", "   x", "it's John's, isn't it?", "x.\n\n  y", "a\t b", "end ",
    "<|endoftext|> in <|endoftext|>text", "tab\tand\x0bform\x0cfeed", "émile été ÿ", "中文 文字", "1 234,5.6", "a.b c!d", "'s 'll .'s",
    "\x1c a \x85 b", "😀 😀a 😀", "a ́b", ". , ; :", " .a ,b",
]


def test_cut_texts_are_encoded_as_whole_ones(encoder):
    assert encoded(encoder, ODD) == whole_ids(encoder, ODD)
    encoder.window = 7
    try:
        assert encoded(encoder, ODD + ["long " * 50, "x" * 99]) == whole_ids(encoder, ODD + ["long " * 50, "x" * 99])
    finally:
        encoder.window = bpe.WINDOW


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab Zé.,!?'\"sl\n\t\r  　\x85中1 2"), max_size=25), max_size=6))
def test_any_text_is_encoded_as_whole(encoder, texts):
    assert encoded(encoder, texts) == whole_ids(encoder, texts)


def test_a_full_table_of_stretches_changes_nothing():
    small = bpe.Encoder(packing.default_tokenizer(), kept=3)
    texts = ["one two three four five", "five four three two one", "six seven one"]
    for _ in range(2):
        assert encoded(small, texts) == whole_ids(small, texts)
    assert len(small.known) == 3


def test_another_kind_of_tokenizer_gets_whole_texts():
    import public_tokenizers

    other = bpe.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert not other.apart and encoded(other, ODD) == whole_ids(other, ODD)


def check_packing(rows, size):
    by_sequence = {}
    for r in rows:
        assert 1 <= r["length"] <= size
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return by_sequence


def test_packing_holds_every_token_once(spark, encoder):
    texts = [*ODD, "long text " * 3000, "z " * 1022, "z " * 1023, "z " * 1024, None, "repeated", "repeated"]
    rows = [(100 + i, t, "en") for i, t in enumerate(texts)] + [(None, "no id", "en"), (None, "no id", "en"), (100, "twice", "en")]
    docs = docs_of(spark, rows)
    made = packing.pack(packing.pieces(docs)).collect()
    found = Counter()
    for r in made:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"]
    check_packing(made, 1024)
    by_doc = {}
    for r in made:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for i, text in {r[0]: r[1] for r in rows if r[0] not in (None, 100)}.items():
        own = sorted(by_doc[i], key=lambda r: r["piece"])
        ids = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in own]).tolist()
        assert ids == [*whole_ids(encoder, [text or ""])[0], 2]
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert [r["start"] for r in own] == np.cumsum([0, *[r["length"] for r in own]])[:-1].tolist()
        assert all(r["length"] == 1024 for r in own[1:]) and (len(own) == 1) == (len(ids) <= 1024)
    assert len(by_doc[None]) == 2 and len(by_doc[100]) == 2
    slim = packing.digests(docs).collect()
    found.update((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in slim)
    found.subtract((r["doc_id"], r["piece"], r["start"], r["length"], zlib.crc32(r["ids"])) for r in made)
    assert not +found and not -found
    assert packing.digests(docs_of(spark, [])).collect() == []


def test_packing_is_close_to_the_least_number_of_sequences(spark):
    docs = table(spark, SF, "documents")
    rows = packing.digests(docs).collect()
    least = -(-sum(r["length"] for r in rows) // 1024)
    large = sum(r["length"] > 512 for r in rows)
    lengths = sorted((r["length"] for r in rows), reverse=True)
    plain = packing.best_fit([(n, i) for i, n in enumerate(lengths)], 1024)
    assert max(least, large) <= len(check_packing(rows, 1024)) <= len(plain)


@pytest.mark.parametrize("kind", ["even", "tiny", "large", "mixed", "same"])
def test_groups_are_packed_like_one_by_later_rounds(spark, kind):
    rng = np.random.default_rng(4)
    n, size = 3000, 100
    lengths = {
        "even": rng.integers(1, size, n), "tiny": rng.integers(1, 6, n), "large": rng.integers(51, size, n),
        "mixed": np.where(rng.random(n) < 0.3, rng.integers(60, 99, n), rng.integers(1, 30, n)), "same": np.full(n, 34),
    }[kind]
    items = spark.createDataFrame([(i, int(x)) for i, x in enumerate(lengths)], "item long, length long")
    placed = packing.place(items, size, group=600)
    rows = placed.join(items, "item").collect()
    assert len(rows) == n
    used = len(check_packing(rows, size))
    plain = len(packing.best_fit([(int(x), i) for i, x in enumerate(lengths)], size))
    assert used <= plain * 1.02 + 1
    assert all(r["sequence_id"] <= r["item"] for r in rows)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 39), min_size=1, max_size=60), st.integers(0, 9))
def test_exchanges_raise_the_sum_of_squares_and_lose_nothing(lengths, seed):
    rng, size = np.random.default_rng(seed), 40
    bins, at = packing.Bins(size), 0
    starts = []
    order = rng.permutation(len(lengths))
    while at < len(order):  # badly packed on purpose
        own, fill = {}, 0
        while at < len(order) and fill + lengths[order[at]] <= size and rng.random() < 0.8 or not own:
            own.setdefault(lengths[order[at]], []).append(int(order[at]))
            fill += lengths[order[at]]
            at += 1
            if at == len(order):
                break
        starts.append(own)
    for own in starts:
        bins.add(own)
    before = sum(f * f for f in bins.fill)
    bins.improve()
    held = sorted(i for own in bins.items for its in own.values() for i in its)
    assert held == list(range(len(lengths)))
    assert all(sum(n * len(its) for n, its in own.items()) == f <= size for own, f in zip(bins.items, bins.fill))
    assert sum(f * f for f in bins.fill) >= before
    for k, fill in enumerate(bins.fill):
        assert not 0 < fill < size or bins.best(k) is None


def test_pieces_of_any_length():
    counts = np.array([1, 9, 10, 11, 20, 25])
    owner, number, start, length = packing.cut_pieces(counts, 10)
    assert list(zip(owner.tolist(), number.tolist(), start.tolist(), length.tolist())) == [
        (0, 0, 0, 1), (1, 0, 0, 9), (2, 0, 0, 10), (3, 0, 0, 1), (3, 1, 1, 10), (4, 0, 0, 10), (4, 1, 10, 10), (5, 0, 0, 5),
        (5, 1, 5, 10), (5, 2, 15, 10),
    ]
