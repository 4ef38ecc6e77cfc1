"""The training-data operators against brute force, and on nulls, empty and long texts, ties, repeats and empty tables."""

import hashlib
import itertools
import json
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidekeep.llm import chat, decontaminate, fingerprint, licenses, lmscore, mixing, neardup, pii, quality, warc
from tidekeep.llm.common import components, stored
from tidekeep.llm.fmindex import FMIndex
from tidekeep.llm.lattice import Lattice, load_pieces
from tidekeep.llm.queries import table
from tidekeep.llm.tokens import NOT_ALNUM, words_of

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, label int, n_tokens string, items string"


def make(spark, texts, first=0):
    """Documents with extra columns whose names the operators use themselves."""
    rows = [(first + i, t, "en", "s", len(t or ""), 7, "x", "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", fold(text))


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# ---- shared helpers


def test_components(spark):
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 60, (45, 2))] + [(i, i + 1) for i in range(100, 130)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    for node in {x for p in links for x in p}:
        assert found.get(node, node) == root(node)


# ---- 1 personal data


def test_pii_keeps_type_format_and_identity(spark):
    texts = [
        "Mr. John Smith met Mrs. Smith. Call +1 (663) 555-6869 or 663-555-6869. a.b@x.org, A.B@x.org; c@x.org d@x.org",
        "card 4111 1111 1111 1111 and 4111111111111111, ssn 123-45-6789, ip 10.0.0.1 10.0.0.2, "
        'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" Госпожа Иванова',
        "nothing here 12 2.0 1999",
        None,
        "",
        "Mr. John Smith met Mrs. Smith. Call +1 (663) 555-6869 or 663-555-6869. a.b@x.org, A.B@x.org; c@x.org d@x.org",
    ]
    got = by_id(pii.anonymise(make(spark, texts)))
    assert [got[i]["text"] for i in (2, 3, 4)] == texts[2:5] and got[2]["n_entities"] == 0
    assert got[0]["text"] == got[5]["text"] and got[0]["n_chars"] == len(got[0]["text"])
    m = re.fullmatch(
        r"Mr\. (\w+) (\w+) met Mrs\. (\w+)\. Call \+1 \((\d{3})\) (\d{3})-(\d{4}) or (\d{3})-(\d{3})-(\d{4})\. "
        r"(\S+@\S+), (\S+@\S+); (\S+@\S+) (\S+@\S+)",
        got[0]["text"],
    )
    g = m.groups()
    assert g[1] == g[2] != "Smith" and g[3:6] == g[6:9] and g[9] == g[10] and len({g[9], g[11], g[12]}) == 3
    assert g[0] in pii._GIVEN["m latin"]
    n = re.fullmatch(
        r'card (\d{4} \d{4} \d{4} \d{4}) and (\d{16}), ssn (\d{3}-\d{2}-\d{4}), ip ([\d.]+) ([\d.]+), token = "([0-9a-f]{40})" '
        r"Госпожа (\w+)",
        got[1]["text"],
    ).groups()
    assert n[0].replace(" ", "") == n[1] and n[1][0] == "4" and n[3] != n[4]
    assert sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(n[1]))) % 10 == 0
    assert re.fullmatch(r"[Ѐ-ӿ]+", n[6])
    for secret in ("Smith", "555-6869", "4111", "24be6443", "10.0.0.", "x.org", "Иванова"):
        assert all(secret not in (r["text"] or "") for r in got.values())


def test_pii_surrogates_never_collide(spark):
    norms = [(k, f"{a}{b}@x.org" if k == "mail" else f"{a}{b}") for k in ("mail", "secret") for a in "abcdef" for b in "abcdef"]
    known = pii.surrogates(spark.createDataFrame(norms, "kind string, norm string")).collect()
    assert len(known) == len(norms)
    for kind in ("mail", "secret"):
        new = {r["surrogate"] for r in known if r["kind"] == kind}
        assert len(new) == 36 and not new & {n for k, n in norms if k == kind}


def test_pii_blank_fields_are_no_secrets(spark):
    blank = ["Password: ________________", "secret = ----------", "token: ........", "pwd=++++////"]
    got = by_id(pii.anonymise(make(spark, [*blank, "Password: ____x____", "token: +1------"])))
    assert [got[i]["text"] for i in range(4)] == blank and not any(got[i]["n_entities"] for i in range(4))
    assert all(got[i]["n_entities"] == 1 for i in (4, 5))
    assert re.fullmatch(r"Password: ____[a-wyz]____", got[4]["text"]) and re.fullmatch(r"token: \+[02-9]------", got[5]["text"])


def test_pii_used_up_formats_are_widened(spark):
    letters, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    norms = [("secret", f"----{a}----") for a in letters] + [("secret", f"____.___{a}") for a in digits]
    # A phone number, a social security and a card number of few digits stand for used-up formats of fixed length.
    norms += [(kind, a) for kind in ("phone", "ssn") for a in digits] + [("iban", f"DE{a}") for a in digits]
    known = pii.surrogates(spark.createDataFrame(norms, "kind string, norm string")).collect()
    assert len(known) == len(norms)
    for kind in ("secret", "phone", "ssn", "iban"):
        new = {r["surrogate"].lower() for r in known if r["kind"] == kind}
        old = {n.lower() for k, n in norms if k == kind}
        assert len(new) == len(old) and not new & old
    raws = spark.createDataFrame([("123-45-6789", "ssn", "123456789")], "raw string, kind string, norm string")
    raws = raws.select("raw", "kind", F.array(F.struct("kind", "norm")).alias("parts"))
    shown = spark.createDataFrame([("ssn", "123456789", "98765432155555555")], "kind string, norm string, surrogate string")
    assert pii._replacements(raws, shown).first()["replacement"] == "987-65-432155555555"


def test_pii_has_no_python_in_its_plan(spark):
    plan = pii.anonymise(make(spark, ["a@b.org"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and pii.anonymise(empty(spark)).count() == 0


def test_pii_names_of_any_shape_and_wherever_they_stand(spark):
    texts = [
        "Mr. John Smith came. Smith left, and Smithson stayed with John.",
        "Mr. Jean-Luc Picard saw Mrs. Anna O'Neil. O'Neil and Jean-Luc waved.",
        "Mr. J. Smith wrote to Mr. John Ronald Tolkien; Ronald read it.",
        "Dr. Anna Weber met Frau Anna Weber and Herr A. von der Weber.",
        "Dr. Γιώργος Παππάς and Госпожа Анна Иванова. Παππάς spoke.",
        "The smith and john went on. Mr. Speaker.",
        "Mr. Smith's hat, Mr. John's coat",
    ]
    got = {i: r["text"] for i, r in by_id(pii.anonymise(make(spark, texts))).items()}
    for gone in ("Smith ", "John", "Picard", "Jean", "Luc", "O'Neil", "Neil", "Tolkien", "Ronald", "Weber", "Παππάς", "Γιώργος", "Анна"):
        assert all(gone not in got[i] for i in range(5)), gone
    assert "Smithson stayed" in got[0] and got[5].startswith("The smith and john went on. Mr. ")
    smith = re.match(r"Mr\. (\w+) (\w+) came\. (\w+) left, and Smithson stayed with (\w+)\.", got[0]).groups()
    assert smith[1] == smith[2] and smith[0] == smith[3]
    first, second, third, fourth = re.match(r"Mr\. (\w+) (?:\w+) saw Mrs\. (\w+) (\w+)\. (\w+) and \w+ waved\.", got[1]).groups()
    assert third == fourth and got[1].endswith(f"and {first} waved.")
    letter, surname, given, middle, last, again = re.match(
        r"Mr\. (\w)\. (\w+) wrote to Mr\. (\w+) (\w+) (\w+); (\w+) read it\.", got[2]
    ).groups()
    assert letter != "J" and surname == smith[1] and given == smith[0] and middle == again and last not in (given, middle)
    one, two, three, four, five = re.match(r"Dr\. (\w+) (\w+) met Frau (\w+) (\w+) and Herr (?:\w)\. von der (\w+)\.", got[3]).groups()
    assert one == three == second and two == four == five, "one person under two titles"
    assert re.search(r"Dr\. [\u0370-\u03ff\u1f00-\u1fff]+ ([\u0370-\u03ff]+) and .* \1 spoke", got[4])
    assert got[6] == f"Mr. {smith[1]}'s hat, Mr. {got[6].split('Mr. ')[2].split(chr(39))[0]}'s coat"


# ---- 2 near-duplicates


def near_brute(rows, size, percent):
    sets = {}
    for i, t in rows:
        w = words(t)
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return {i: (len(s), root(i), root(i) == i) for i, s in sets.items()}


@pytest.mark.parametrize("long_list, block", [(16, 1024), (2, 7)])
def test_near_duplicates(spark, monkeypatch, long_list, block):
    monkeypatch.setattr(neardup, "LONG_LIST", long_list)
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = np.random.default_rng(5)
    vocabulary = [f"w{k}" for k in range(400)]
    texts = [None, "", "  ", "one two", "One Two", "one two three"]
    common = " ".join(rng.choice(vocabulary, 30))
    for length in (20, 90, 400):
        base = list(rng.choice(vocabulary, length))
        for edits in range(24):
            copy = list(base)
            for k in rng.integers(0, length, edits * length // 150):
                copy[k] = "x" + str(rng.integers(0, 10**6))
            texts.append(" ".join(copy))
        texts.append(common + " " + " ".join(rng.choice(vocabulary, 8)))
    texts += [texts[10], texts[40], "a " * 3000]
    docs = make(spark, texts)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(docs, 3, 85).collect()}
    assert got == near_brute(list(enumerate(texts)), 3, 85)


def test_near_duplicate_margin_follows_the_threshold():
    rng = np.random.default_rng(4)
    values = rng.permutation(np.unique(rng.integers(0, 2**63, 40_000, dtype=np.uint64)))
    cut = len(values) // 10
    a, b = values[:-cut], values[cut:]  # about 0.8 in common
    sketch = [[np.sort(x)[: neardup.SKETCH]] for x in (a, b)]
    n = [np.array([len(x)]) for x in (a, b)]
    for t in (0.8, 0.85):
        for est, margin in (neardup._pairwise(*sketch, *n, t), neardup._estimates(*sketch, *n, t)):
            union = np.unique(np.concatenate([s[0] for s in sketch]))
            union = np.count_nonzero(union <= min(s[0][-1] for s in sketch))
            total = (len(a) + len(b)) / (1 + t)
            want = 5 * np.sqrt(t * (1 - t) / union * (1 - union / total)) + 1 / union
            assert np.allclose(np.ravel(margin), want) and abs(np.ravel(est)[0] - 0.8) < want


def test_near_duplicates_odd_rows(spark):
    assert neardup.near_duplicates(empty(spark)).count() == 0
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, None), (2, "A b c d e f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r[0], r[2], r[3]) for r in neardup.near_duplicates(docs).collect()), key=repr)
    assert got == sorted([(1, 1, True), (1, 1, True), (2, 1, False), (None, 1, False), (None, None, False)], key=repr)


def test_near_duplicates_at_the_threshold_emit_no_pairs(spark, monkeypatch):
    """A group whose pairs mostly lie just around the threshold, in several blocks: whole links, and rows in proportion."""
    rng = np.random.default_rng(11)
    base = [f"w{i}" for i in range(500)]
    texts = []
    for d in range(240):
        own = list(base)
        for i in np.flatnonzero(rng.random(len(own)) < 0.0145):
            own[i] = f"x{d}_{i}"
        texts.append(" ".join(own))
    sets = [{tuple(w[i : i + 3]) for i in range(len(w) - 2)} for w in (t.split() for t in texts)]
    up = list(range(len(texts)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    links = 0
    for a, b in itertools.combinations(range(len(texts)), 2):
        common = len(sets[a] & sets[b])
        if 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
            links += 1
            p, q = root(a), root(b)
            up[max(p, q)] = min(p, q)
    assert 0.05 < links / (240 * 239 / 2) < 0.95
    made = []
    for name in ("_block_pairs", "_whole_pairs"):
        monkeypatch.setattr(
            neardup, name, lambda *args, run=getattr(neardup, name): (made.append(stored(run(*args), "made")) or made[-1])
        )
    monkeypatch.setattr(neardup, "BLOCK", 50)
    got = by_id(neardup.near_duplicates(make(spark, texts), size=3, percent=85))
    assert [got[i]["component_id"] for i in range(len(texts))] == [root(i) for i in range(len(texts))]
    assert len(made) >= 2 and all(df.count() < 30 * len(texts) for df in made)


# ---- 3 fingerprints


def test_fingerprints(spark):
    texts = ["é" * 50, None, "", "abc", "the quick brown fox " * 40, "𝒳yz " * 30, "the quick brown fox " * 40, "z" * 5000, "q"]
    docs = make(spark, texts, first=10).unionByName(make(spark, [texts[4]], first=14))
    rows = fingerprint.fingerprints(docs).collect()
    ordered = sorted([(10 + i, t or "") for i, t in enumerate(texts)] + [(14, texts[4])], key=lambda r: (-r[0], r[1]))
    want = []
    for i, (k, t) in enumerate(ordered):
        after = ordered[(i + 1) % len(ordered)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        own, changed, follow = (fingerprint.fingerprint(x) for x in (t, edited, after))
        same = next((j for j, (a, b) in enumerate(zip(t, after, strict=False)) if a != b), min(len(t), len(after)))
        sha = hashlib.sha256(edited.encode()).hexdigest()
        want.append((k, len(t), sha, str(own), str(changed), fingerprint.likeness(own, changed), fingerprint.likeness(own, follow), same))
    assert sorted(tuple(r) for r in rows) == sorted(want)
    assert fingerprint.fingerprints(empty(spark)).count() == 0
    one = fingerprint.fingerprints(make(spark, ["abcd"])).collect()[0]
    assert one["near_next"] == 1.0 and one["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()


def test_span_equality_and_extension():
    a, b = fingerprint.Prefix("xxabcdefgh"), fingerprint.Prefix("abcdefzz")
    assert a.span(2, 6) == b.span(0, 6) and a.span(2, 7) != b.span(0, 7)
    assert fingerprint.extension(a, 2, b, 0) == 6 and fingerprint.extension(a, 0, b, 0) == 0
    f = fingerprint.fingerprint("some text of a few words")
    assert str(fingerprint.Fingerprint.parse(str(f))) == str(f)


def test_powers_are_made_once_for_texts_of_any_length(monkeypatch):
    made, table_of = [], fingerprint._table

    def counted(*args):
        made.append(args)
        return table_of(*args)

    monkeypatch.setattr(fingerprint, "_table", counted)
    for n in (5, 40_000, 5, 100_000, 5, 20_000, 5):
        fingerprint.fingerprint("ab " * n)
    assert len(made) <= 4


def test_spans_of_texts_longer_than_a_block():
    rng = np.random.default_rng(8)
    text = "".join(map(chr, rng.integers(32, 0x3000, 100_000)))
    x = fingerprint.Prefix(text)

    def want(part):
        return tuple(sum((ord(c) + 1) * pow(b, i, p) for i, c in enumerate(part)) % p for b, p in zip(fingerprint.BASES, fingerprint.PRIMES, strict=True))

    spans = x.spans(fingerprint.SPAN)
    assert len(spans) == len(text) - fingerprint.SPAN + 1
    for edge in (0, 1 << 14, 1 << 15, 1 << 16, 3 << 15, len(text) - fingerprint.SPAN):
        for at in range(max(0, edge - fingerprint.SPAN), min(edge + 2, len(spans))):
            part = text[at : at + fingerprint.SPAN]
            assert x.span(at, fingerprint.SPAN) == want(part)
            assert spans[at] == fingerprint.Prefix(part).spans(fingerprint.SPAN)[0]
    assert x.span(30_000, 50_000) == want(text[30_000:80_000])


# ---- 4 conversations


def test_collapse_against_brute_force(spark):
    rng = np.random.default_rng(1)
    logs = {}
    for k in range(60):
        base = logs[int(rng.integers(0, k))] if k and rng.random() < 0.7 else []
        cut = base[: int(rng.integers(0, len(base) + 1))]
        logs[k] = cut + [("user" if j % 2 else "assistant", str(rng.integers(0, 3))) for j in range(int(rng.integers(1, 4)))]
    logs[60] = [("user", "deep")] * 0 + [("user", str(j)) for j in range(1500)]
    logs[61] = logs[60][:700]
    logs[62] = [(None, None), ("user", "")]
    logs[63] = [("", ""), ("user", None)]
    rows = [(k, t, r, x, "extra") for k, turns in logs.items() for t, (r, x) in enumerate(turns)]
    rows += rows[:20] + [(None, 0, "user", "lost", "extra")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, place string")
    kept = {
        k for k, s in logs.items()
        if not any(o != k and logs[o][: len(s)] == s and (len(logs[o]) > len(s) or o < k) for o in logs)
    }
    got = chat.collapse(df).collect()
    assert {r["conv_id"] for r in got} == kept
    for r in got:
        part = logs[r["conv_id"]][r["first_turn"] : r["first_turn"] + chat.SEGMENT]
        assert r["rendered"] == "".join(f"<|{a or ''}|>\n{b or ''}<|end|>\n" for a, b in part) and r["n_turns"] == len(part)
    assert chat.collapse(df.limit(0)).count() == 0


# ---- 5 quality


def test_quality_on_held_out_rows(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    got = by_id(quality.quality(docs, labels))
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 4 == 2) for k, r in got.items())
    held = [(r["score"], truth[k]) for k, r in got.items() if r["held_out"] and k in truth]
    right = sum((s >= 0.7) == (y == 1) for s, y in held) / len(held)
    assert len(got) == docs.count() and right > 0.95 and all(r["predicted"] == int(r["score"] >= 0.7) for r in got.values())


def test_quality_odd_rows(spark):
    docs = make(spark, [None, "", "a", "word " * 100_000, "x" * 200_000])
    labels = spark.createDataFrame([(0, 1), (1, None), (2, 1), (2, 1)], "doc_id long, quality int")
    rows = quality.quality(docs, labels).collect()
    assert len(rows) == 5 and all(0 <= r["score"] <= 1 for r in rows)
    none = quality.quality(docs, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality.quality(empty(spark), labels).count() == 0
    assert quality.keep_good(docs, labels.limit(0)).schema == docs.schema


# ---- 6 licences


def test_licences(spark):
    texts = [
        "Some prose.\nReleased under the MIT License.\nMore.",
        "This work is licensed under the GNU General Public License, version 3.\nAll rights reserved.",
        "He lost his driving license.\nThe general public may enter.",
        None,
        "",
        "\n\n",
        "Licensed under CC BY-NC 4.0.",
    ]
    docs = table(spark, SF, "documents").select("doc_id", "text")
    rows = [(10**6 + i, t) for i, t in enumerate(texts)]
    got = by_id(licenses.scan(docs.unionByName(spark.createDataFrame(rows, "doc_id long, text string"))))
    assert [got[10**6 + i]["families"] for i in range(7)] == ["mit", "gpl,reserved", "", "", "", "", "cc-by-nc"]
    assert [got[10**6 + i]["n_paragraphs"] for i in range(7)] == [3, 2, 2, 0, 0, 0, 1]
    lines = {"apache": "the Apache License, Version", "mit": "the MIT License", "gpl": "GNU General Public", "cc-by-nc": "CC BY-NC", "reserved": "All rights reserved"}
    for r in docs.collect():
        want = ",".join(sorted(f for f, t in lines.items() if t in (r["text"] or "")))
        assert got[r["doc_id"]]["families"] == want


def test_licences_within_long_lines(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    prose = " ".join(r["text"] for r in docs.orderBy("doc_id").collect() if len(re.findall("(?i)licen|reserved|copyright", r["text"] or "")) == 0)
    prose = [w for w in prose.split() if w]
    notices = {
        "mit": "Released under the MIT License", "cc-by-nc": "Licensed under CC BY-NC 4.0", "cc-by-sa": "Licensed under CC BY-SA 4.0",
        "apache": "Licensed under the Apache License, Version 2.0", "gpl": "licensed under the GNU General Public License, version 3",
        "reserved": "All rights reserved",
    }

    def line(k, chars, *within):
        rows, at = [], (k * 401) % (len(prose) // 2)
        while sum(map(len, rows)) + len(rows) < chars:
            rows.append(prose[(at + len(rows)) % len(prose)])
        for i, t in enumerate(within):
            rows.insert((k * 37 + (i + 1) * len(rows) // (len(within) + 1)) % len(rows), t + ".")
        return " ".join(rows)

    texts, want = [], []
    for k in range(4):
        for chars in (400, 3000, 20_000):
            for f, t in notices.items():
                texts.append(line(len(texts), chars, t))
                want.append([f])
    for a, b in [("mit", "reserved"), ("gpl", "apache"), ("cc-by-nc", "mit")]:
        texts += [line(5, 20_000, notices[a], notices[b]), f"{notices[a]}. {notices[b]}.", line(7, 500, f"{notices[a]}. {notices[b]}")]
        want += [sorted([a, b])] * 3
    plain = [line(k, 20_000) for k in range(5)]
    rows = [(10**6 + i, t) for i, t in enumerate([*texts, *plain])]
    got = by_id(licenses.scan(docs.unionByName(spark.createDataFrame(rows, "doc_id long, text string"))))
    got = [got[10**6 + i] for i in range(len(rows))]
    missed = [(i, w, g["families"]) for i, (w, g) in enumerate(zip(want, got, strict=False)) if g["families"].split(",") != w]
    assert not missed
    assert all(g["n_paragraphs"] == 1 and g["n_licences"] == len(w) for w, g in zip(want, got, strict=False))
    assert not any(g["n_licences"] for g in got[len(texts) :])


def test_runs_have_every_template_whole():
    longest = max(len(re.findall("[a-z0-9]+", t.lower())) for f in licenses.TEMPLATES.values() for t in f)
    assert licenses.OVERLAP >= longest + 2 * licenses.EDGE


def test_licences_without_documents(spark):
    assert licenses.scan(empty(spark)).count() == 0


# ---- 7 lattice


def all_segmentations(word, logs, ids, n):
    """The sum over segmentations by plain recursion."""
    if not word:
        return 1.0
    total = 0.0
    for k in range(1, len(word) + 1):
        if word[:k] in ids:
            total += np.exp(logs[ids[word[:k]]]) * all_segmentations(word[k:], logs, ids, n)
    if not word.startswith(b" "):
        total += np.exp(logs[n + word[0]]) * all_segmentations(word[1:], logs, ids, n)
    return total


def test_lattice_sums_all_segmentations():
    pieces = [b" ", b" a", b"a", b"ab", b"b", b" ab", b"bab", b"c"]
    rng = np.random.default_rng(0)
    logs = np.log(rng.dirichlet(np.ones(len(pieces) + 256)))
    lattice = Lattice(pieces)
    some = [b"a", b"abab", b"cab", b"zz", b"babab", b"\xc3\xa9a"]
    ids = {p: i for i, p in enumerate(pieces)}
    want = [np.log(all_segmentations(b" " + w, logs, ids, len(pieces))) for w in some]
    assert np.allclose(lattice.likelihood(some, [logs])[:, 0], want)
    weights = np.arange(1.0, 7.0)
    counts = lattice.expected(some, weights, logs)
    for p in range(len(logs)):  # the expectation is the derivative of the log likelihood
        moved = logs.copy()
        moved[p] += 1e-5
        slope = (weights @ (lattice.likelihood(some, [moved])[:, 0] - np.array(want))) / 1e-5
        assert abs(slope - counts[p]) < 1e-3


def test_expectations_of_several_weights_at_once():
    pieces = [b" ", b" a", b"a", b"ab", b"b", b" ab", b"bab", b"c"]
    rng = np.random.default_rng(1)
    logs = [np.log(rng.dirichlet(np.ones(len(pieces) + 256))) for _ in range(3)]
    some = [b"a", b"abab", b"cab", b"zz", b"babab", b"bb", b"\xc3\xa9a"]
    weights = rng.integers(0, 3, (len(some), 3)).astype(float)
    weights[:, 2] = 0
    lattice = Lattice(pieces)
    for k, got in enumerate(lattice.expected_each(some, weights, logs)):
        want = sum(w * lattice.expected([x], np.ones(1), logs[k]) for x, w in zip(some, weights[:, k], strict=True) if w)
        assert np.allclose(got, want)


def test_lm_is_trained_for_three_rounds(spark, monkeypatch):
    """The weights are those of three rounds of expectation maximisation over the distinct words of each class."""
    rows = [(i, t, "en" if i % 2 else "de") for i, t in enumerate(["banana bandana", "ananas", "cab cabana"] * 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    monkeypatch.setattr(lmscore.Model, "prepare", lambda m, *a, real=lmscore.Model.prepare: (seen.append(m), real(m, *a))[1])
    lmscore.scores(docs).count()
    pieces, scores = load_pieces(lmscore.VOCABULARY)
    lattice, want = Lattice(pieces), lmscore.Model(pieces, scores, 2)
    train = [r for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 != 1]
    top = sorted(("en", "de"), key=lambda x: (-sum(r["lang"] == x for r in train), x))
    for k, lang in enumerate(top):
        own = sorted({w.encode() for r in train if r["lang"] == lang for w in words(r["text"])})
        logs = want.logs[k]
        for _ in range(3):
            weight = lmscore.PRIOR * want.prior + lattice.expected(own, np.ones(len(own)), logs)
            logs = np.log(weight / weight.sum())
        assert np.allclose(seen[0].logs[k], logs)


def test_lm_scores(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(10**6, None, None), (10**6 + 1, "", "en"), (10**6 + 2, "wort " * 20_000, "xx"), (None, "a", "en")], docs.schema)
    docs = docs.unionByName(odd)
    rows = [(r["doc_id"], words(r["text"])) for r in docs.collect()]
    counts, ends = {}, 0
    for k, w in rows:
        if k is None or zlib.crc32(str(k).encode()) % 5 != 1:
            ends += 1
            for x in w:
                counts[x] = counts.get(x, 0) + 1
    n, v = sum(counts.values()) + ends, len(counts) + 1
    got = by_id(lmscore.scores(docs))
    for k, w in rows:
        r = got[k]
        base = sum(np.log10((c + 0.5) / (n + 0.5 * (v + 1))) for c in [*(counts.get(x, 0) for x in w), ends])
        assert (r["n_tokens"], r["train_tokens"]) == (len(w) + 1, n)
        assert r["n_known"] == sum(x in counts for x in w) + 1 and abs(r["base_score"] - base) < 1e-6 * abs(base)
        assert r["score"] < 0
    assert lmscore.scores(docs.limit(0)).count() == 0


def test_vocabulary_is_a_parameter():
    pieces, scores = load_pieces(lmscore.VOCABULARY)
    assert len(scores) == len(pieces) + 256 and all(p for p in pieces)


# ---- 8 mixing


def test_rates_meet_targets(spark):
    rng = np.random.default_rng(2)
    p, n = rng.dirichlet([0.3, 0.3, 0.3], 500), rng.integers(0, 900, 500)
    members = spark.createDataFrame([(x.tolist(), int(k)) for x, k in zip(p, n, strict=True)], "posterior array<double>, n_tokens long")
    targets = np.array([0.7, 0.25, 0.05]) * n.sum()
    steps = mixing.fit_rates(members, targets)
    rates = mixing._rate(p, steps)
    assert (rates >= 0).all() and np.abs((n * rates) @ p - targets).sum() < 1e-3 * n.sum()


def test_posteriors_against_plain_sums():
    vocabulary, rng = ["ab", ",", "äb", "1", "x"], np.random.default_rng(3)
    weights, start = rng.normal(size=(5, 3)), rng.normal(size=3)
    texts = [None, "", "Ab1_ b, ÄB\täb", "x1 " * 100_000, "no, no", "日本，x", "äb"]
    n, p = mixing.Scorer(vocabulary, weights, start).score(pa.array(texts))
    for i, t in enumerate(texts):
        own = re.findall(r"[a-z\x80-\U0010ffff]+|[^ \t-\r]", fold(t))
        raw = start + sum(weights[j] for j, w in enumerate(vocabulary) if w in own)
        assert n[i] == len(own) and np.allclose(p[i], np.exp(raw) / np.exp(raw).sum())
    assert [len(x) for x in mixing.Scorer([], np.zeros((0, 1)), np.zeros(1)).score(pa.array([], pa.string()))] == [0, 0]


def test_mixing(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    docs = docs.withColumn("posterior", F.lit("old")).withColumn("text", F.when(F.col("doc_id") > 2, F.col("text")))
    out, names = mixing.mix(docs, mixing.labelled_domains(labels, ["toxic"]), {"0": 0.95, "1": 0.05})
    rows = out.collect()
    assert names == ["0", "1"] and len(rows) == docs.count() and all(r["rate"] >= 0 for r in rows)
    total = sum(r["n_tokens"] for r in rows)
    toxic = sum(r["n_tokens"] * r["rate"] * r["posterior"][1] for r in rows)
    assert abs(toxic / total - 0.05) < 1e-3 and all(abs(r["copies"] - r["rate"]) < 1 for r in rows)


def test_mixing_odd_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    domains = mixing.labelled_domains(none, ["quality", "toxic"])
    out, names = mixing.mix(make(spark, [None, "", "a b"]), domains, mixing.TARGETS)
    assert [(r["n_tokens"], r["rate"], r["copies"]) for r in out.orderBy("doc_id").collect()] == [(0, 1, 1), (0, 1, 1), (2, 1, 1)]
    assert mixing.mix(empty(spark), domains, mixing.TARGETS)[0].count() == 0


# ---- 9 WARC


def test_warc_round_trip(spark):
    big = "é<p>\r\n\r\n0\r\n\r\nWARC/1.1" * 4000
    html = [None, "", "x" * 999, "x" * 999, "y" * 1000, "y" * 1000, big, big, "\r\n\r\n", "y" * 1000]
    rows = [(i, f"http://a/{i}\r\nX: y", h) for i, h in enumerate(html)] + [(6, "http://a/6\r\nX: y", big), (None, None, "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    got = sorted((tuple(r) for r in warc.round_trip(pages).collect()), key=repr)
    last = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 1000:
            last[h] = max(i, last.get(h, 0))
    want = []
    for i, _, h in rows:
        to = last.get(h) if i is not None else None
        old = to is not None and i < to
        data = (h or "").encode()
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if old else "response", to if old else None, None))
    assert got == sorted(want, key=repr)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_warc_faults_are_named(spark, tmp_path):
    parts = warc.records(1, "http://a", "q" * 100_000, None)
    lost = warc.records(2, "http://b", "r" * 100_000, None)[:-1]
    hole = warc.records(3, "http://c", "s" * 100_000, None)
    whole = b"\r\n\r\n".join(r for _, _, r in [*reversed(parts), *lost, hole[0], *hole[2:]]) + b"\r\n\r\n"
    (tmp_path / "part-0").write_bytes(whole)
    got = {r["url"]: (r["problem"], r["payload"]) for r in warc.read(spark, str(tmp_path)).collect()}
    assert got["http://a"] == (None, bytearray(b"q" * 100_000))
    assert got["http://b"] == ("the total length differs", None) and got["http://c"] == ("a segment is missing", None)
    assert warc.unchunked(b"3\r\nabc\r\n0\r\n\r\n") == b"abc" and warc.unchunked(b"5\r\nabc\r\n0\r\n\r\n") is None


# ---- 10 benchmark


def test_fm_index_against_scanning():
    rng = np.random.default_rng(1)
    for n, s in ((1, 1), (7, 2), (300, 3), (400, 1)):
        text = rng.integers(1, s + 1, n)
        index = FMIndex(text, s)
        for size in (1, 2, 5):
            phrases = np.array([text[i : i + size] for i in range(max(0, n - size + 1))][:30]).reshape(-1, size)
            low, high = index.search(phrases, np.full(len(phrases), size))
            for k, p in enumerate(phrases):
                want = [i for i in range(n - size + 1) if (text[i : i + size] == p).all()]
                assert sorted(index.locate(np.arange(low[k], high[k])).tolist()) == want


def leak_brute(docs, items, size=10):
    def cut(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(t))

    asked = [(i, tuple(w[k : k + size])) for i, t in items for w in [cut(t)] if w for k in range(max(0, len(w) - size) + 1)]
    out = {}
    for d, t in docs:
        w, hit, found = cut(t), set(), set()
        for i, p in asked:
            for k in range(len(w) - len(p) + 1):
                if tuple(w[k : k + len(p)]) == p:
                    hit |= set(range(k, k + len(p)))
                    found.add(i)
        names = ",".join(sorted(str(i) for i in found if i is not None))
        out[d] = (len(w), len(hit), len(found - {None}), hashlib.sha256(names.encode()).hexdigest(), bool(hit))
    return out


@pytest.mark.parametrize("limit", [500_000, 9])
def test_decontamination(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "WINDOWS", limit)
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 400)
    passage = "one two three four five six seven eight nine ten eleven twelve"
    items = [(1, passage), (2, "Short item"), (10, "short ITEM"), (3, None), (4, "..."), (None, "lone words"), (1, passage)]
    texts = [
        "before " + passage.upper() + ", after", passage[:40], "a short item, a short-item; é lone words", None, "", "!!", passage + " " + passage,
        "x " * 900 + passage + " y" * 900, "short", "item",
    ]
    docs = make(spark, texts)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r[0]: tuple(r)[1:] for r in decontaminate.report(decontaminate.mark(docs, bench)).collect()}
    assert got == leak_brute(list(enumerate(texts)), items)
    left = by_id(decontaminate.decontaminate(docs, bench))
    assert left[0]["text"] == "before  , after" and left[0]["n_chars"] == 15 and 6 not in left
    assert all(left[k]["text"] == texts[k] for k in (1, 3, 4, 5, 8, 9)) and left[0]["items"] == "y"
    assert decontaminate.mark(empty(spark), bench).count() == 0 and decontaminate.mark(docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_words_of_one_key_are_told_apart_by_their_bytes(spark):
    twin = ["a"]
    for _ in range(11):
        twin = [x for c in twin for x in ("ab" if c == "a" else "ba")]
    one = "".join(twin)
    other = one.translate(str.maketrans("ab", "ba"))
    column = pa.array([one, other])
    assert len(set(words_of(column, NOT_ALNUM).keys().tolist())) == 1, "the case this test is about"
    docs = make(spark, [f"x {one} y", f"x {other} y", f"{other} {one}"])
    bench = spark.createDataFrame([(1, one), (2, other + " y")], "item_id long, text string")
    got = by_id(decontaminate.mark(docs, bench))
    assert [(got[i]["n_hit"], got[i]["items"]) for i in range(3)] == [(1, [1]), (2, [2]), (1, [1])]


def test_wrapped_licence_notices(spark):
    notices = {
        "mit": "Permission is hereby granted, free of charge, to any person\nobtaining a copy of this software and associated "
        "documentation\nfiles (the \"Software\"), to deal in the Software without\nrestriction, including the rights to use and copy.",
        "bsd": "# Redistribution and use in source and binary forms,\n# with or without modification, are permitted provided\n"
        "# that the following conditions are met:\n#\n# 1. Redistributions of source code must retain the notice.",
        "gpl": " * This program is free software; you can redistribute\r\n * it and/or modify it under the terms of the GNU\r\n"
        " * General Public License as published by the Free\r\n * Software Foundation.",
        "lgpl": "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General\n"
        "Public License as published by the Free Software\nFoundation; either version 2.1 of the License.",
    }
    docs = table(spark, SF, "documents").select("doc_id", "text")
    first = 1 + docs.agg(F.max("doc_id")).first()[0]
    plain = "The river ran low that\nsummer and the mill stood\nidle until the rain came.\n\nNobody minded the wait."
    rows = [(first + i, f"{plain}\n\n{t}\n\n{plain}") for i, t in enumerate([*notices.values(), "nothing here"])]
    got = by_id(licenses.scan(docs.unionByName(spark.createDataFrame(rows, "doc_id long, text string"))))
    assert [got[first + i]["families"] for i in range(5)] == [*notices, ""]
    cut = spark.createDataFrame([(plain,), ("a\r\nb\n \nc\n***\nd\n" + "e" * 101 + "\nf",), (None,)], "t string")
    cut = [r[0] for r in cut.select(licenses.paragraphs(F.col("t"))).collect()]
    assert cut == [
        ["The river ran low that summer and the mill stood idle until the rain came.", "Nobody minded the wait."],
        ["a b", "c", "***", "d", "e" * 101, "f"], [],
    ]


# ---- the pipeline


def test_pipeline(spark):
    import corpus_pipeline

    docs = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF)
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert after.schema.simpleString() == docs.schema.simpleString()
        ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert {r["doc_id"] for r in after.select("doc_id").collect()} <= ids
    out = corpus_pipeline.run(spark, SF)
    assert 0 < out.count() < table(spark, SF, "documents").count() and out.where("copies < 1").count() == 0
    assert json.dumps(sorted(out.columns))


def test_pipeline_keeps_one_of_each_group(spark):
    import corpus_pipeline

    text = "a b c d e f g h i j k l m n o p"
    rows = [(3, text), (1, text), (1, text), (None, text), (None, text), (5, "other words than these in here"), (6, None), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in corpus_pipeline.near_dedup(spark, docs, SF).collect()), key=repr)
    assert got == sorted([(1, text), (None, text), (5, rows[5][1]), (6, None), (7, "")], key=repr)


def test_pipeline_keeps_different_texts_of_one_id(spark):
    import corpus_pipeline

    text, other = "a b c d e f g h i j k l m n o p", "quite other words stand in this row of the same id"
    rows = [(4, text), (4, other), (4, other), (9, other), (2, text + " q r s t u v w x y z and more besides")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in corpus_pipeline.near_dedup(spark, docs, SF).collect())
    texts = [t for _, t in got]
    assert sorted(texts) == sorted([text, other, rows[4][1]]) and (2, rows[4][1]) in got and (4, text) in got


def test_pipeline_passes_empty_tables_and_null_texts(spark):
    import corpus_pipeline

    docs = table(spark, SF, "documents")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, None, "en", "s", 0), (2, "", "en", "s", 0)], docs.schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
        stage(spark, odd, SF).collect()


def test_targets_without_a_domain_are_named(spark):
    domains = spark.createDataFrame([(i, "x" if i < 4 else "y") for i in range(8)], "doc_id long, domain string")
    docs = make(spark, [f"{'apple pear' if i < 4 else 'iron steel'} {i}" for i in range(8)])
    with pytest.warns(UserWarning, match="no labelled document of z"):
        mixing.mix(docs, domains, {"x": 0.5, "y": 0.25, "z": 0.25})


def test_shrinkage_is_chosen_on_training_folds(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 1, (60, 3)), rng.normal(0.8, 2, (60, 3))])
    rows = [(int(i >= 60), int(i % 4), [float(v) for v in x[i]]) for i in range(120)]
    labelled = spark.createDataFrame(rows, "label int, fold int, x array<double>").repartition(3)
    folds = quality.moments(labelled)
    assert set(folds) == {0, 1, 2, 3}
    whole = quality._added(list(folds.values()))
    assert whole[0][0] == 60 and np.allclose(whole[1][1], x[60:].sum(axis=0)) and np.allclose(whole[1][2], x[60:].T @ x[60:])
    loss = quality._unseen_loss(labelled, folds)
    want = np.zeros(len(quality.SHRINKAGE))
    for k, pair in enumerate(quality.SHRINKAGE):
        for f in range(4):
            model = quality.Discriminant(quality._added([s for g, s in folds.items() if g != f]), *pair)
            for label, part, v in rows:
                if part == f:
                    want[k] += np.logaddexp(0, (-1 if label else 1) * model.log_odds(np.array([v]))[0])
    assert np.allclose(loss, want)
