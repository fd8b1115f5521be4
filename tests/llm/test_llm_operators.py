from __future__ import annotations

import hashlib
import math
import random
import re
import sys
import textwrap
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import plain
from compare import SMALL

from lorebed.llm import chosenpath, components, decontam, fingerprints, job, langid, licences, linededup, pieces, queries, substrings, textblocks, toxicity, urlfilter

DOC = "doc_id long, text string, lang string, source string"
LONG = "word " * 60_000
ODD = [
    (1, None, None, None), (2, "", "en", "s"), (3, "  \n\t ", None, "s"), (4, "same text of some words here", "en", None),
    (5, "same text of some words here", "en", "s"), (5, "same text of some words here", "en", "s"), (None, "no id", "en", "s"),
    (6, LONG, "en", "s"), (7, "Ünïcödé 日本 🙂 ß", "de", "s")
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOC)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load(queries.PIECES_FILE)


def near_copies(seed: int, groups: int = 12, size: int = 9) -> list[tuple]:
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    out = []
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.randint(3, 120))]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append((len(out), " ".join(copy)))
    return out


# ---- blocks


def test_words_and_hashes_of_blocks():
    column = pa.array(["a b", None, "", "  x\ty ", "ab", "a", "b"])
    (first, last, data, offsets), *rest = textblocks.text_blocks(column)
    begin, end, at = textblocks.word_spans(data, offsets)
    assert (first, last, rest) == (0, 7, []) and [bytes(data[a:b]).decode() for a, b in zip(begin, end)] == ["a", "b", "x", "y", "ab", "a", "b"]
    assert at.tolist() == [0, 2, 2, 2, 4, 5, 6, 7]
    h = textblocks.hash_spans(data, begin, end)
    assert h[0] == h[5] and h[1] == h[6] and len(set(h.tolist())) == 5


#: Two words that every polynomial hash modulo 2 ** 64 confuses.
TWINS = ["".join(x["01".index(c)] for c in "".join(str(bin(i).count("1") & 1) for i in range(1024))) for x in ("ab", "ba")]


def test_hashes_of_spans_tell_twins_apart():
    data = np.frombuffer(" ".join(TWINS).encode(), dtype=np.uint8)
    for key in (0, 5):
        a, b = textblocks.hash_spans(data, np.array([0, 1025]), np.array([1024, 2049]), key)
        assert a != b
    assert textblocks.same_spans(
        data, np.array([0, 0, 3]), np.array([1024, 2, 3]), data, np.array([1025, 1, 7]), np.array([2049, 3, 7])
    ).tolist() == [False, False, True]


def test_a_long_span_has_the_hash_of_its_place(monkeypatch):
    rng = np.random.default_rng(3)
    word = rng.integers(0, 256, 5 * textblocks.HASH_BYTES // 2, dtype=np.uint8)
    data = np.concatenate([np.full(9, 32, np.uint8), word, np.full(4, 32, np.uint8)])
    a = textblocks.hash_spans(data, np.array([0, 9]), np.array([3, 9 + len(word)]))[1]
    assert a == textblocks.hash_spans(word, np.array([0]), np.array([len(word)]))[0]
    prime, h = (1 << 31) - 1, 0
    for base in np.random.default_rng(0).integers(1 << 20, prime - 1, 2).tolist():
        total = 0
        for c in reversed(word.tolist()):
            total = (total * base + c + 1) % prime
        h = h << 31 | total
    assert a == textblocks.mix(np.array([h], dtype=np.uint64))[0]


def test_twin_words_in_the_operators(spark, vocabulary):
    """Different words that a weaker hash takes for one: no occurrence, no repeat, and the library's own pieces."""
    import sentencepiece

    docs = spark.createDataFrame([(1, f"{TWINS[1]} tail"), (2, f"{TWINS[0]} tail")], "doc_id long, text string")
    items = spark.createDataFrame([(1, TWINS[0])], "item_id long, text string")
    assert {r.doc_id: r.n_hit for r in decontam.verdicts(docs, items).collect()} == {1: 0, 2: 1}
    assert {r.n_removed for r in substrings.dedup_substrings(docs, window=1, gram=1).collect()} == {1}
    model = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES_FILE)
    made = {r.doc_id: r for r in pieces.encode(docs, vocabulary).collect()}
    assert all(list(made[i + 1].ids) == model.encode(f"{TWINS[1 - i]} tail") and made[i + 1].round_trip for i in (0, 1))


def test_confused_words_are_told_apart(monkeypatch, vocabulary):
    """Whatever the hash confuses, the bytes behind it decide: here it only sees lengths."""
    monkeypatch.setattr(pieces, "hash_spans", lambda data, begin, end: textblocks.mix((end - begin).astype(np.uint64)))
    texts = ["some words have equal many letters", "that were here", "", "abcd efgh  ijkl"]
    fresh = pieces.load(queries.PIECES_FILE)
    (_, _, data, offsets), *_ = textblocks.text_blocks(pa.array(texts))
    ids, at, same = fresh.encode_checked(data, offsets)
    assert same.all() and [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [
        vocabulary.encode(*next(textblocks.text_blocks(pa.array([t])))[2:])[0].tolist() for t in texts
    ]


def test_a_text_beyond_a_block_stays_whole():
    blocks = list(textblocks.text_blocks(pa.array(["x" * 50, "y" * 9, "z" * 9]), 20))
    assert [(a, b) for a, b, _, _ in blocks] == [(0, 1), (1, 3)]


def test_folder_for_stored_tables():
    """A cluster has to name one; a local session gets its own."""
    from types import SimpleNamespace

    def session(master, named=None):
        made = []
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: made[-1] if made else None, setCheckpointDir=made.append)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: named), sparkContext=context)

    assert job.shared_dir(session("spark://x", "/shared/")) == "/shared" and "lorebed-" in job.shared_dir(session("local[2]"))
    with pytest.raises(ValueError):
        job.shared_dir(session("spark://x"))


def test_stored_tables_go_when_discarded(spark):
    import os

    kept = job.stored(spark.range(5).groupBy((F.col("id") % 2).alias("k")).count())
    path = kept._stored_at
    assert kept.count() == 2 and os.path.isdir(path)
    job.discard(kept, spark.range(1))
    assert not os.path.isdir(path)


# ---- 1 and 3: near copies


def held(df, rows):
    got = df.collect()
    assert len(got) == len(rows)
    want = plain.classes(rows)
    by_id = {}
    for i, (k, _) in enumerate(rows):
        members, links = want[i]
        by_id[k] = (min((rows[j][0] for j in members if rows[j][0] is not None), default=None), links)
    for r in got:
        assert (r.class_id, r.n_links) == by_id[r.doc_id], r
    heads = [r for r in got if r["first"]]
    assert len({r.class_id for r in got}) <= len(heads)


@pytest.mark.parametrize("seed", [1, 2])
def test_chosen_path_join(spark, seed):
    rows = near_copies(seed)
    held(chosenpath.near_classes(spark.createDataFrame(rows, "doc_id long, text string")), rows)


def test_chosen_path_splits_large_buckets(spark):
    rows = near_copies(3, groups=3, size=60)
    path = chosenpath.ChosenPath(bucket=8)
    held(chosenpath.near_classes(spark.createDataFrame(rows, "doc_id long, text string"), path=path), rows)


def test_band_join(spark):
    rows = near_copies(4)
    held(fingerprints.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")), rows)


def test_join_of_odd_rows(odd, nothing):
    got = {(r.doc_id, r.key): r for r in chosenpath.near_classes(odd).collect()}
    links = {k: r.n_links for (k, _), r in got.items()}
    assert links == {1: 1, 2: 1, 3: 0, 4: 2, 5: 2, None: 0, 6: 0, 7: 0}
    assert chosenpath.near_classes(nothing).count() == 0
    kept = chosenpath.dedup(odd)
    assert kept.columns == odd.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "4", "6", "7", "None"]


def test_blocks_of_a_large_group(spark):
    base = " ".join(f"v{k}" for k in range(300))
    rows = [(i, base.replace("v7 ", f"x{i} ")) for i in range(40)]
    path = chosenpath.ChosenPath()
    texts = spark.createDataFrame([(i, t, 1) for i, t in rows], "rep long, text string, copies long")
    groups = spark.createDataFrame([(i, 0, len(t)) for i, t in rows], "node long, root long, bytes long")
    for size in ({"block": 8}, {"block_bytes": 5000}):
        counts = {}
        for r in chosenpath.verified(groups, texts, path, **size).collect():
            if r.b is None:
                counts[r.a] = counts.get(r.a, 0) + r.texts
        assert counts == {i: 39 for i in range(40)}


def half_alike(n: int, pairs: int, seed: int) -> list[tuple]:
    """Texts of one large group that share most of their words, and close pairs among them."""
    rng = random.Random(seed)
    base = [f"v{k}" for k in range(200)]
    out = []
    for i in range(n):
        own = list(base)
        for k in rng.sample(range(40), 4):
            own[5 * k : 5 * k + 5] = [f"x{i}_{k}_{j}" for j in range(5)]
        out.append((i, " ".join(own)))
        if i < pairs:
            own[100] = f"z{i}"
            out.append((n + i, " ".join(own)))
    return out


def test_pairs_in_a_large_group_of_half_alike_texts(spark):
    """Nothing in a bucket that doesn't split is left uncompared."""
    rows = half_alike(400, 60, 6)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for depth, bands in ((1, 25), (3, None)):
        path = chosenpath.ChosenPath(bucket=16, depth=depth, slack=0.0)
        held(chosenpath.near_classes(frame, path=path), rows)
    held(chosenpath.near_classes(frame, path=path, candidates=fingerprints.band_links), rows)


def test_blocks_of_a_bucket_meet(spark):
    path = chosenpath.ChosenPath(bucket=5)
    rows = spark.createDataFrame([(b, r) for b, n in ((1, 40), (2, 3)) for r in range(n)], "bucket long, rep long")
    parts = {}
    for r in chosenpath.in_blocks(rows, path).collect():
        parts.setdefault(r.bucket, set()).add(r.rep)
    met = {(a, b) for own in parts.values() for a in own for b in own}
    assert met == {(a, b) for a in range(40) for b in range(40)}


def test_near_copies_beside_clashing_names(spark):
    rows = [(i, "one and the same text of words", "a", "b", "c") for i in range(3)]
    got = chosenpath.dedup(spark.createDataFrame(rows, "doc_id long, text string, key string, __key string, first string"))
    assert [tuple(r) for r in got.collect()] == [rows[0]] and got.columns == ["doc_id", "text", "key", "__key", "first"]
    found = chosenpath.near_classes(spark.createDataFrame(rows, "doc_id long, text string, class_id string, root string, digest string"))
    assert {(r.class_id, r.n_links) for r in found.collect()} == {(0, 2)}


def test_components(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 102), (101, 102)], "a long, b long")
    roots = {r.node: r.root for r in components.components(chain).collect()}
    assert len({roots[i] for i in range(61)}) == 1 and len({roots[i] for i in (100, 101, 102)}) == 1 and len(roots) == 64
    assert components.components(chain.limit(0)).count() == 0


def test_fingerprints_against_plain(spark, docs, texts):
    got = {r.doc_id: r for r in fingerprints.fingerprint(docs).collect()}
    ordered = sorted(texts, reverse=True)
    for i, (k, t) in enumerate(ordered):
        other = ordered[(i + 1) % len(ordered)][1]
        edited = t[: len(t) - len(t) // 2] + other[: len(t) // 2]
        r = got[k]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        a, b = plain.shingles(t), plain.shingles(edited)
        assert abs(r.near_edited - len(a & b) / max(1, len(a | b))) < 0.2
    by_text = {}
    for k, t in texts:
        assert by_text.setdefault(t, got[k].fingerprint) == got[k].fingerprint


def test_fingerprints_of_odd_rows(odd, nothing):
    rows = fingerprints.fingerprint(odd).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(ODD) and got[1].n_chars == 0 and got[1].fingerprint == "" and got[7].n_chars == 14
    assert got[None].n_chars == 5 and fingerprints.fingerprint(nothing).count() == 0
    assert got[4].fingerprint == got[5].fingerprint


def test_likeness_of_fingerprints(spark, docs, texts):
    """The share of equal bytes, less what chance makes equal, from the fingerprints that are shown."""
    got = fingerprints.fingerprint(docs).orderBy(F.desc("doc_id")).collect()
    for i, r in enumerate(got):
        for other, near in ((r.edited_fingerprint, r.near_edited), (got[(i + 1) % len(got)].fingerprint, r.near_next)):
            a, b = bytes.fromhex(r.fingerprint), bytes.fromhex(other)
            want = float(not a and not b) if not a or not b else min(1.0, max(0.0, (sum(x == y for x, y in zip(a, b)) / 128 - 1 / 256) / (1 - 1 / 256)))
            assert near == pytest.approx(want)


def test_fingerprint_query(spark, texts):
    got = {r.doc_id: r for r in queries.op3_fingerprints(spark, SMALL).collect()}
    rows = sorted(texts)
    for i, (members, links) in plain.classes(rows).items():
        r = got[rows[i][0]]
        assert (r.class_id, r.n_links) == (min(rows[j][0] for j in members), links)
    assert len(got) == len(rows)


# ---- 2: toxicity


def test_toxicity_finds_held_out(spark):
    """Two thirds of the labels find most toxic texts of the last third. One in twenty texts labelled toxic has no word of its own to be known by."""
    tables = SMALL.replace("0.001", "0.1")
    big = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text")
    labels = toxicity.graded(spark.read.parquet(f"{tables}/labels.parquet"))
    model = toxicity.fit(big, labels.where("doc_id % 3 <> 0"))
    seen = toxicity.score(big.where("doc_id % 3 = 0"), model).withColumnRenamed("toxic", "found").join(labels, "doc_id").collect()
    right = sum(r.found and r.toxic for r in seen)
    assert right / sum(r.toxic for r in seen) > 0.8 and right / sum(r.found for r in seen) > 0.8
    assert model.thresholds.tolist() == sorted(model.thresholds) and all(0 <= r.severity <= 2 for r in seen)


def test_ordinal_gradient_recovers_order():
    rng = np.random.default_rng(0)
    x = [np.flatnonzero(rng.random(4) < 0.5) for _ in range(4000)]
    weight = np.array([4.0, 2.0, 0.0, -4.0])
    score = np.array([weight[f].mean() if len(f) else 0.0 for f in x]) + rng.logistic(size=4000)
    y = np.searchsorted([-1.0, 0.5, 2.0], score)
    w, theta = toxicity._ordinal(x, y, 4, 4, 0.1, 800)
    assert np.abs(w - weight).max() < 0.5 and np.abs(theta - [-1.0, 0.5, 2.0]).max() < 0.4


def plain_likelihood(x, y, weights, thresholds, penalty):
    """The penalised log likelihood of grades y of rows with features x, term by term."""
    total = -penalty / 2 * sum(w * w for w in weights)
    for own, grade in zip(x, y):
        score = sum(weights[f] for f in own) / max(1, len(own))
        at_least = [1.0, *(1 / (1 + math.exp(t - score)) for t in thresholds), 0.0]
        total += math.log(at_least[grade] - at_least[grade + 1])
    return total


def test_ordinal_fit_is_the_likeliest():
    rng = np.random.default_rng(4)
    x = [np.flatnonzero(rng.random(3) < 0.4) for _ in range(150)]
    y = np.array([min(2, int(rng.poisson(0.3 + len(f) * 0.5))) for f in x])
    w, theta = toxicity._ordinal(x, y, 3, 3, 0.1, 800)
    best = plain_likelihood(x, y, w, theta, 0.1)
    for k in range(5):
        for step in (-0.05, 0.05):
            moved = np.concatenate([w, theta])
            moved[k] += step
            assert plain_likelihood(x, y, moved[:3], moved[3:], 0.1) < best


def test_toxicity_query_against_plain(spark, texts):
    """Every row of the query from the model's weights, by the plain formula over the words and their beginnings."""
    docs_ = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    model = toxicity.fit(docs_, toxicity.graded(spark.read.parquet(f"{SMALL}/labels.parquet")))
    got = {r.doc_id: r for r in queries.op2_toxicity(spark, SMALL).collect()}
    assert len(got) == len(texts)
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hashed = lambda w: int(textblocks.hash_spans(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0])
    mixed = lambda h: int(textblocks.mix(np.array([h & 0xFFFFFFFFFFFFFFFF], dtype=np.uint64))[0])
    known: dict[bytes, set] = {}
    for k, t in texts:
        marks = set()
        for w in {w.encode() for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(low))}:
            if w not in known:
                known[w] = {
                    p for p in (model.place[h >> 64 - model.bits] for h in (hashed(w), *(mixed(hashed(w[:n]) + n) for n in toxicity.PREFIXES if len(w) > n))) if p >= 0
                }
            marks |= known[w]
        score = sum(model.weights[m] for m in marks) / max(1, len(marks))
        at_least = [1 / (1 + math.exp(t - score)) for t in model.thresholds]
        each = [a - b for a, b in zip([1.0, *at_least], [*at_least, 0.0])]
        r = got[k]
        assert (r.p_toxic, r.severity) == (
            pytest.approx(at_least[0]), pytest.approx(sum(g * p for g, p in enumerate(each)))
        ) and each[r.grade] == pytest.approx(max(each)) and r.toxic == (r.p_toxic >= 0.5)


def test_marks_are_beyond_chance():
    having, toxic = np.array([1000.0, 12.0, 12.0, 2.0, 40.0]), np.array([100.0, 12.0, 3.0, 2.0, 9.0])
    assert toxicity._select(2000, 200, having, toxic, 0.01, 12.0).tolist() == [1]
    assert toxicity._select(2000, 200, having[:1], toxic[:1], 0.01, 12.0).tolist() == []


def test_toxicity_of_odd_rows(spark, odd, nothing):
    """A repeated id is one text of the sample; of its labels the largest counts. Without a mark, all texts are alike."""
    labels = spark.createDataFrame([(1, 0), (2, 1), (2, 0), (4, 2), (5, 0), (5, 0), (None, 1), (6, None)], "doc_id long, grade int")
    model = toxicity.fit(odd.withColumn("label", F.lit("own")), labels)
    assert len(model.thresholds) == 2 and not len(model.weights)
    got = toxicity.score(odd.withColumn("toxic", F.lit("old")), model)
    assert got.count() == len(ODD) and dict(got.dtypes)["toxic"] == "boolean" and got.select("severity").distinct().count() == 1
    assert toxicity.fit(nothing, labels) is None and toxicity.score(odd, None).where("toxic").count() == 0 and toxicity.score(nothing, model).count() == 0
    assert {
        tuple(r) for r in toxicity.graded(spark.createDataFrame([(0, 0), (1, 1), (1, 0), (1, None), (None, 0)], "toxic int, quality int")).select("toxic", "quality", "grade").collect()
    } == {(0, 0, 0), (1, 1, 1), (1, 0, 2), (1, None, 1), (None, 0, None)}


# ---- 4: lines


def test_lines_with_variable_fields(spark):
    rows = [(i, f"own line number {i} of document\nuser {i} logged in from 10.0.0.{i} at once\ntext {'abcdefgh'[i]} only here words") for i in range(8)]
    got = {r.doc_id: r for r in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0].text == rows[0][1] and got[0].n_dropped == 0
    assert all("logged in" not in got[i].text and got[i].n_lines == 3 for i in range(1, 8))


def test_lines_that_two_documents_have(spark):
    long, dated, short = "the same notice stands in exactly two documents", "Copyright 2024 by some people of 1 place", "All rights reserved."
    texts = [
        f"{long}\nbegin {short}", f"{long} \n{dated}\nown words of second text", f"{dated}\n{short}\nPage 7",
        f" {short}\nPage 7\nrare words", f"{short}\nPage 7\nrare words"
    ]
    got = [r.text for r in linededup.dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert got == [texts[0], f"{dated}\nown words of second text", f"{short}\nPage 7", "Page 7\nrare words", "Page 7\nrare words"]


def test_exact_lines_against_plain(spark):
    rng = random.Random(4)
    rows = [(i, "\n".join(" ".join(rng.choice(["a", "b", "c2"]) for _ in range(rng.randint(0, 7))) for _ in range(12))) for i in range(60)]
    lines = {k: [" ".join(re.findall(r"[^\x09-\x0D\x20]+", x)) for x in t.split("\n")] for k, t in rows}
    docs_of = {}
    for k, own in lines.items():
        for x in own:
            docs_of.setdefault(x, set()).add(k)
    needed = lambda x: 2 if len(x.split()) > 3 else 3 if x and "2" not in x else 10**9
    got = {r.doc_id: r.n_dropped for r in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), min_docs=10**6).collect()}
    assert got == {k: sum(len(docs_of[x]) >= needed(x) and min(docs_of[x]) < k for x in own) for k, own in lines.items()} and sum(got.values()) > 50


def test_lines_against_plain(spark):
    for seed, (docs_, options) in enumerate(
        [(70, {}), (60, {"min_docs": 2, "similarity": 0.8}), (50, {"min_docs": 4, "depth": 2}), (60, {"exact_docs": None, "min_docs": 2, "depth": 1}), (40, {"min_tokens": 2, "depth": 4, "short_docs": 2})]
    ):
        rng = random.Random(seed)
        line = lambda: " ".join(
            rng.choice("a b c d2 7".split()) if rng.random() < 0.8 else f"r{rng.choice('xyzuvw')}" for _ in range(rng.randint(0, 7))
        )
        rows = [(i, "\n".join(line() for _ in range(rng.randint(1, 9)))) for i in range(docs_)]
        rows += [(900 + i, rng.choice(rows)[1]) for i in range(3)]
        got = {r.doc_id: r for r in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), **options).collect()}
        want = plain.without_lines(rows, **options)
        assert {k: r.n_dropped for k, r in got.items()} == {k: len(v) for k, v in want.items()} and sum(map(len, want.values())) > 3
        assert {k: r.text for k, r in got.items()} == {k: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in want[k]) for k, t in rows}


def test_a_document_counts_once_in_a_leaf(spark):
    """What one document repeats isn't constant for it, and saves no boilerplate elsewhere."""
    for repeats in range(4):
        texts = [
            "\n".join(["alpha beta gamma red one", *(f"alpha beta gamma red {w}" for w in ["two", "three", "four"][:repeats])]),
            "alpha beta gamma blue x", "alpha beta gamma green y"
        ]
        rows = list(enumerate(texts, 1))
        got = [r.n_dropped for r in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()]
        assert got == [0, 1, 1] == [len(v) for v in plain.without_lines(rows).values()]


def test_lines_beside_clashing_names(spark):
    rows = [(i, "one line of five words", "a", "b", "c") for i in range(3)]
    got = linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, __key string, __places string, key string"))
    assert got.columns == ["doc_id", "text", "__key", "__places", "key", "n_lines", "n_dropped"]
    assert [tuple(r)[1:] for r in got.orderBy("doc_id").collect()] == [("one line of five words", "a", "b", "c", 1, 0)] + [("", "a", "b", "c", 1, 1)] * 2


def test_lines_of_odd_rows(odd, nothing):
    got = linededup.dedup_lines(odd.withColumn("n_lines", F.lit("old")), min_docs=2, min_tokens=1)
    rows = {str(r.doc_id): r for r in got.collect()}
    assert got.count() == len(ODD) and rows["1"].text is None and rows["1"].n_lines == 0 and rows["2"].n_lines == 1
    assert rows["4"].n_dropped == 0 and rows["5"].n_dropped == 1 and rows["5"].text == ""
    assert linededup.dedup_lines(nothing).count() == 0


def test_lines_are_cut_after_one_shuffle_of_the_texts(spark):
    """Texts that lose lines and those that don't go through one join, and no text goes to Python after it."""
    same = "the same notice ä stands \U0001f600 in both"
    texts = ["", same, f"{same}\n", f"\n\nown.*|\r\n{same}\r\n\n", f"{same}\n{same}\nlast", None, "\n", f"a\x85b\u2028c\n\t{same} \nz"]
    got = linededup.dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert [(r.text, r.n_lines, r.n_dropped) for r in got.orderBy("doc_id").collect()] == [
        ("", 1, 0), (same, 1, 0), ("", 2, 1), ("\n\nown.*|\r\n\n", 6, 1), ("last", 3, 2), (None, 0, 0), ("\n", 2, 0), ("a\x85b\u2028c\nz", 3, 1)
    ]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(__key") == 2 and "Python" not in plan and "InArrow" not in plan


def test_leaf_of_a_line_against_plain():
    """Lines share a leaf if they have as many tokens and alike first ones; a token with a digit is alike any other."""
    rng = random.Random(8)
    texts = ["\n".join(rng.choice(["", " "]) + rng.choice([" ", "\t", " \x0b"]).join(rng.choice(["a", "b", "é", "c2", "7", "d" * 70000]) for _ in range(rng.randint(0, 5))) for _ in range(rng.randint(1, 6))) for _ in range(60)]
    texts[7] = texts[8] = ""
    for depth in (0, 1, 3):
        leaves, hashed = [], []
        for first, _, data, offsets in textblocks.text_blocks(pa.array(texts)):
            text, place, n, field, leaf = linededup._lines(data, offsets, depth)
            for t, k, size, digit, name in zip(text.tolist(), place.tolist(), n.tolist(), field.tolist(), leaf.tolist()):
                tokens = texts[first + t].split("\n")[k].encode().split()
                assert (size, digit) == (len(tokens), any(c in x for x in tokens for c in b"0123456789"))
                leaves.append((size, *(b"*" if any(c in x for c in b"0123456789") else x for x in tokens[:depth])))
                hashed.append(name)
        assert len(hashed) == sum(t.count("\n") + 1 for t in texts) and len(set(zip(leaves, hashed))) == len(set(leaves)) == len(set(hashed))


# ---- 5: languages


def test_languages_held_out(docs):
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    out = [r for r in got if r.held_out]
    assert out and sum(r.lang == r.lang_pred for r in out) / len(out) > 0.97 and all(0 <= r.score <= 1 for r in got)


def test_languages_against_plain(spark):
    """All at once and a few at a time: the same likeliest language and score as by the plain formula."""
    rng = random.Random(8)
    words = {
        lang: [rng.choice(["ba", "ko", "schö", "ñu", "ré", "th"]) + rng.choice([lang, "xi", "lo"]) for _ in range(12)] for lang in ("aa", "bb", "cc", "dd", "ee")
    }
    made = [
        (" ".join(rng.choice(words[lang]).upper() if rng.random() < 0.2 else rng.choice(words[rng.choice([lang, lang, "aa"])]) for _ in range(rng.randint(0, 40))) + rng.choice(["", "!?", " 12"]), lang) for lang in rng.choices(sorted(words), k=60)
    ]
    made += [(None, "aa"), ("ba", None), ("", "bb"), ("12 !", "cc"), ("x", "dd")]
    number = lambda gram: int(langid.char_grams(np.frombuffer(gram.encode(), np.uint8), np.array([0, len(gram.encode())]), 3, 16)[0][0])
    want = plain.languages(made, [t for t, _ in made], number)
    frame = spark.createDataFrame([(i, *row) for i, row in enumerate(made)], "doc_id long, text string, lang string")
    model = langid.fit(frame)
    for at_once in (64, 2):
        got = langid.predict(frame, model, at_once=at_once).orderBy("doc_id").collect()
        assert [r.lang_pred for r in got] == [lang for lang, _ in want] and [r.score for r in got] == pytest.approx([s for _, s in want])


def test_many_languages(spark):
    frame = spark.createDataFrame(
        [(i, f"text of {chr(97 + i % 26) * 3} {chr(97 + i // 26) * 4}", f"l{i:03}") for i in range(300)],
        "doc_id long, text string, lang string"
    )
    got = langid.predict(frame, langid.fit(frame), at_once=128).collect()
    assert sum(r.lang == r.lang_pred for r in got) > 290


def test_languages_of_odd_rows(spark, odd, nothing):
    got = {r.doc_id: r for r in langid.identify(odd).collect()}
    assert got[1].lang_pred == got[2].lang_pred == got[3].lang_pred == "und" and got[1].score == 0.0
    assert got[6].lang_pred in ("en", "de") and got[None].held_out is False
    assert langid.identify(nothing).count() == 0
    assert {r.lang_pred for r in langid.predict(odd, None).collect()} == {"und"}
    clash = langid.predict(odd.withColumns({"score": F.lit("x"), "__lang": F.lit("y")}), langid.fit(odd))
    assert clash.columns == [*odd.columns, "__lang", "lang_pred", "score"] and dict(clash.dtypes)["score"] == "double" and {r["__lang"] for r in clash.collect()} == {"y"}


# ---- 6: substrings


@pytest.mark.parametrize(("window", "gram"), [(35, 12), (5, 2), (6, 1), (4, 4)])
def test_substrings_against_plain(spark, window, gram):
    rng = random.Random(window)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 60)))) for i in range(150)]
    rows += [(400, "x " * 50), (401, None), (402, ""), (403, "p q " * 30), (405, "\t\n "), (406, " ".join(map(str, range(80))))]
    got = {
        r.doc_id: (r.n_words, r.n_removed, r.text) for r in substrings.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string"), window=window, gram=gram).collect()
    }
    assert got == plain.without_repeats(rows, window)


def test_substring_query(spark, texts):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op6_substring_dedup(spark, SMALL).collect()}
    assert got == {k: (a, b, hashlib.sha256(c.encode()).hexdigest()) for k, (a, b, c) in plain.without_repeats(texts, 35).items()}


def test_substrings_over_several_blocks_of_cells(spark):
    """A text of megabytes, for which the sketch has more than one block."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(SMALL.replace("0.001", "0.01") + "/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_words, r.n_removed, r.text) for r in substrings.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == plain.without_repeats(rows, 35) and sum(len(t.encode()) for _, t in rows) > 8 << 16


def test_substrings_of_odd_rows(odd, nothing):
    got = substrings.dedup_substrings(odd)
    assert got.count() == len(ODD) and got.where("doc_id = 6").first().n_removed == 60_000
    assert substrings.dedup_substrings(nothing).count() == 0


# ---- 7: pieces


def test_pieces_as_the_library(vocabulary, texts):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES_FILE)
    odd_ = [
        "a  b", " x", "x ", "a\nb\t　c", "", "  ", "ﬁ Å①", "aaaaaaaaaaa", "-" * 41 + "  =", " " * 50 + "a", " " * 14, " " * 50 + "①   ",
        "<s> </s> <0x0A> <unk>", "日本語 漢字", "🙂🙂 🙂", "a   ① b"
    ]
    every = odd_ + [t for _, t in texts]
    ids = []
    for _, _, data, offsets in textblocks.text_blocks(pa.array(every)):
        flat, at = vocabulary.encode(data, offsets)
        back, back_at = vocabulary.decode(flat, at)
        assert bytes(back) == bytes(data) and np.array_equal(back_at, offsets)
        ids += [flat[a:b].tolist() for a, b in zip(at, at[1:])]
    assert ids == model.encode(every)


def test_long_words_as_the_library(vocabulary):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES_FILE)
    rng = random.Random(2)
    long = [
        "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABC0123=/+") for _ in range(100_000)), "日本語漢字仮名交じり文" * 2000, "a" * 3000,
        "ab" * 700 + "①" + "-" * 900, *("x" * n for n in range(44, 70))
    ]
    for t in long:
        (_, _, data, offsets), *_ = textblocks.text_blocks(pa.array([t]))
        ids, _, same = vocabulary.encode_checked(data, offsets)
        assert same[0] and ids.tolist() == model.encode(t)


def test_one_piece_is_admissible_at_each_end(vocabulary):
    """So the largest score among the admissible ones, which the lattice keeps, is that piece's."""
    words = ["▁thinking", "▁internat", "▁aaaaaaaa", "▁x=1;y=22"]
    rows = np.array([[ord(c) for c in w] for w in words], dtype=np.uint32)
    last, back = vocabulary.viterbi(rows)
    found = vocabulary.candidates(rows)
    for end in range(1, rows.shape[1] + 1):
        for r in range(len(words)):
            fine = []
            for size in range(1, end + 1):
                piece = found[end, r, size - 1] if size <= found.shape[2] else -1
                if piece >= 0 and (
                    vocabulary.whole[piece] if size == end else vocabulary.admissible(last[end - size, r : r + 1], np.array([piece], dtype=np.int64))[0]
                ):
                    fine.append((int(piece), size))
            assert fine == [(last[end, r], back[end, r])]


def test_two_models_in_one_session(spark, vocabulary, docs):
    """Each keeps its own caches, and takes none along to the tasks."""
    import pickle

    rows = docs.limit(20)
    first = {r.doc_id: list(r.ids) for r in pieces.encode(rows, vocabulary).collect()}
    other = pickle.loads(pickle.dumps(vocabulary))
    assert len(pickle.dumps(vocabulary)) < 12 << 20
    assert first == {r.doc_id: list(r.ids) for r in pieces.encode(rows, other).collect()}
    block = next(textblocks.text_blocks(pa.array(["some words"])))[2:]
    own = vocabulary.encode(*block)[0].tolist()
    for k in range(3):
        # Models that come and go, at addresses that are used again.
        model = pieces.load(queries.PIECES_FILE)
        model.ids = np.roll(model.ids, k)
        assert (model.encode(*block)[0].tolist() == own) == (k == 0)
        del model


def test_pieces_of_odd_rows(odd, nothing, vocabulary):
    made = pieces.encode(odd.withColumn("ids", F.lit("old")), vocabulary)
    rows = made.collect()
    assert len(rows) == len(ODD) and all(r.round_trip for r in rows) and [r.n_tokens for r in rows if r.doc_id == 1] == [0]
    back = pieces.decode(made.drop("text"), vocabulary)
    assert {(r.doc_id, r.text) for r in back.collect()} == {(k, t or "") for k, t, _, _ in ODD}
    assert pieces.encode(nothing, vocabulary).count() == 0


# ---- 8: licences


def test_licence_rules(spark):
    mit = licences.SENTENCES
    texts = [
        "Intro words. Released under the MIT License. More.", "\n".join([mit["mit-grant"] + ".", mit["mit-keep"] + ".", mit["as-is"] + "."]), mit["mit-keep"] + ".", None, "", "THIS WORK IS LICENSED under the GNU General Public License, version 3!",
        ". ".join(mit[k] for k in ("bsd-redistribute", "bsd-source", "bsd-binary")) + ".\nLicensed under CC BY-NC 4.0.", "license " * 50_000,
    ]
    got = [r.licences for r in licences.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert got == ["MIT", "MIT", "", "", "", "GPL-3.0-only", "BSD-2-Clause;CC-BY-NC-4.0", ""]


def test_every_sentence_has_a_cue():
    assert all(any(c in s.lower() for c in licences.CUES) for s in licences.SENTENCES.values())
    assert {i for _, rule in licences.RULES for i in rule} <= set(licences.SENTENCES)


# The licences as their holders publish them, wrapped at a column.
PUBLISHED = {
    "MIT": """MIT License

Copyright (c) 2024 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0""",
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "CC-BY-4.0": """This work is licensed under a Creative Commons Attribution 4.0
International License.""",
    "GPL-2.0-or-later": """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.""",
    "GPL-2.0-only": """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License version 2 as
published by the Free Software Foundation.""",
    "LGPL-2.1-or-later": """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.""",
    "AGPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Affero General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.""",
    "EPL-2.0": """This program and the accompanying materials are made
available under the terms of the Eclipse Public License 2.0
which is available at https://www.eclipse.org/legal/epl-2.0/""",
    "CC0-1.0": """To the extent possible under law, the author(s) have dedicated all copyright
and related and neighboring rights to this software to the public domain
worldwide. This software is distributed without any warranty.""",
    "Zlib": """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
   claim that you wrote the original software.""",
    "BSL-1.0": """Boost Software License - Version 1.0 - August 17th, 2003

Permission is hereby granted, free of charge, to any person or organization
obtaining a copy of the software and accompanying documentation covered by
this license (the "Software") to use, reproduce, display, distribute,
execute, and transmit the Software, and to prepare derivative works of the
Software, and to permit third-parties to whom the Software is furnished to
do so, all subject to the following:""",
    "Unlicense": """This is free and unencumbered software released into the
public domain.""",
}


@pytest.mark.parametrize("shape", ["published", "comment", "crlf", "narrow", "one line"])
def test_licences_as_published(spark, shape):
    change = {
        "published": lambda t: t, "comment": lambda t: "\n".join(" * " + x for x in t.split("\n")), "crlf": lambda t: t.replace("\n", "\r\n"), "one line": lambda t: " ".join(t.split()),
        "narrow": lambda t: "\n\n".join("\n".join(textwrap.wrap(x, 30)) for x in t.split("\n\n")),
    }
    rows = [(name, "Some words before.\n\n" + change[shape](t)) for name, t in PUBLISHED.items()]
    assert {
        r.doc_id: r.licences for r in licences.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    } == {name: name for name in PUBLISHED}


def test_sentences_end_at_blank_lines_and_marks(spark):
    texts = [
        "Released under the\n\nMIT License", "Released under the. MIT License", "Released under the\nMIT License",
        "Not released under the MIT License", "a; Released under the MIT License; b",
        "One. Two\n\nthree\nReleased under the\nMIT License, v. 2"
    ]
    got = [
        (r.licences, r.n_sentences, r.first_sentence) for r in licences.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    ]
    assert got == [("", 2, None), ("", 2, None), ("MIT", 2, 0), ("", 1, None), ("MIT", 1, 0), ("", 6, None)]


def test_licences_of_odd_rows(odd, nothing):
    assert licences.scan(odd).count() == len(ODD) and licences.scan(nothing).count() == 0
    clash = odd.withColumns({"licences": F.lit("x"), "ids": F.lit("y"), "rest": F.lit("z"), "marked": F.lit("w")})
    assert sorted(map(str, licences.scan(clash).collect())) == sorted(map(str, licences.scan(odd).collect()))
    same = [(r.licences, r.n_sentences) for r in licences.scan(odd).where("doc_id = 5").collect()]
    assert len(same) == 2 and same[0] == same[1]
    plan = licences.scan(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ---- 9: benchmark


def test_contamination_against_plain(spark):
    rng = random.Random(9)
    word = lambda: rng.choice("abcd") + rng.choice(["", "é", "1"])
    items = [(i, " ".join(word() for _ in range(rng.randint(0, 20)))) for i in range(12)] + [(None, "one-two"), (7, "again words"), (7, "x" * 30), (20, None)]
    docs_ = [
        (i, " ".join(word() for _ in range(rng.randint(0, 60))) + rng.choice(["", " Again WORDS!", "\n" + items[i % 12][1].upper()])) for i in range(80)
    ] + [(100, None), (101, ""), (102, "One.Two")]
    a, b = spark.createDataFrame(docs_, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = plain.contaminated(docs_, items)
    for size in (1 << 25, 200):
        got = {r.doc_id: (r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in decontam.verdicts(a, b, pass_bytes=size).collect()}
        assert got == want


def test_longest_match(spark):
    item = " ".join(f"t{k}" for k in range(30))
    doc = "x y " + " ".join(f"t{k}" for k in range(3, 25)) + " z"
    r = decontam.verdicts(
        spark.createDataFrame([(1, doc)], "doc_id long, text string"), spark.createDataFrame([(5, item)], "item_id long, text string")
    ).first()
    assert (r.longest, r.longest_item, r.longest_at, list(r.spans)) == (22, "5", 2, [2, 24])


def test_contamination_of_odd_rows(spark, odd, nothing):
    items = spark.createDataFrame([(1, "same text of some words here")], "item_id long, text string")
    kept = decontam.decontaminate(odd.withColumn("items", F.lit("old")), items)
    assert kept.columns == [*odd.columns, "items"] and {r["items"] for r in kept.collect()} == {"old"}
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "6", "7", "None"]
    assert decontam.verdicts(odd, items.limit(0)).where("contaminated").count() == 0 and decontam.verdicts(nothing, items).count() == 0


# ---- 10: urls


def test_rules_and_parts(spark):
    urls = [
        "http://A.example.org/en/1?x", "https://example.org/es/a", "http://x.com/de/", "http://x.com/fr/1#y", "http://x.net/q",
        "https://b.org", None, "no-scheme/x", "://h.org/p", "http://notexample.org/es/", "x?u=http://q.org/a"
    ]
    rows = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = [(r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge(rows).orderBy("page_id").collect()]
    assert got == [
        ("a.example.org", "/en/1", "example.org/en/1", "block"), ("example.org", "/es/a", "example.org/es/", "block"), ("x.com", "/de/", "com/de/", "block"), ("x.com", "/fr/1", "com/fr/", "allow"), ("x.net", "/q", None, "allow"),
        ("b.org", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("h.org", "/p", "org/", "allow"), ("notexample.org", "/es/", "org/", "allow"), ("q.org", "/a", "org/", "allow"),
    ]


def test_distrust_spreads_against_links(spark):
    pages = [
        (1, "http://good.org/a", '<a href="http://friend.net/">'), (2, "http://bad.com/de/", ""), (3, "http://farm.net/1", "<a HREF='//bad.com/de/x'> <a href=/local>"), (4, "http://friend.net/", '<a href="https://bad.com/">'),
        (5, "http://far.net/", '<a href="http://farm.net/z">'), (6, "http://lone.net/", None),
    ]
    rows = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in urlfilter.judge(rows).collect()}
    assert got == {1: "allow", 2: "block", 3: "block", 4: "allow", 5: "block", 6: "allow"}
    seeds = {"trust": {"good.org": 3}, "distrust": {"bad.com": 1, "far.net": 1}}
    frames = [spark.createDataFrame(list(seeds[k].items()), "host string, pages long") for k in ("trust", "distrust")]
    scores = {r.host: r for r in urlfilter.propagate(urlfilter.host_links(urlfilter.judged(rows, urlfilter.RULES)), *frames).collect()}
    # The plain power iteration over the same links; what a host without links can't pass on goes back to the seeds.
    links = {("good.org", "friend.net"), ("farm.net", "bad.com"), ("friend.net", "bad.com"), ("far.net", "farm.net")}
    for kind, edges in (("trust", links), ("distrust", {(b, a) for a, b in links})):
        total = sum(seeds[kind].values())
        start = {h: n / total for h, n in seeds[kind].items()}
        rank = dict(start)
        for _ in range(20):
            new = {}
            for a, b in edges:
                new[b] = new.get(b, 0) + 0.85 * rank.get(a, 0) / sum(x == a for x, _ in edges)
            back = 1 - sum(new.values())
            rank = {h: new.get(h, 0) + back * start.get(h, 0) for h in {*new, *start}}
        assert sum(rank.values()) == pytest.approx(1)
        assert {h: pytest.approx(v) for h, v in rank.items() if v} == {h: r[kind] for h, r in scores.items() if r[kind]}
        assert all(r[f"{kind}_pages"] == pytest.approx(total * r[kind]) for r in scores.values())


def test_a_host_is_judged_by_its_own_pages_too(spark):
    """Without any link the pages that rules decide are all there is: more blocked than allowed ones block the rest of the host."""
    urls = [
        "http://a.com/de/1", "http://a.com/x", "http://b.com/de/1", "http://b.com/fr/1", "http://b.com/x", "http://c.com/x",
        "http://d.com/fr/1", "http://d.com/x"
    ]
    got = [
        r.verdict for r in urlfilter.judge(spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id long, url string, html string")).orderBy("page_id").collect()
    ]
    assert got == ["block", "block", "block", "allow", "allow", "allow", "allow", "allow"]


def test_pages_of_odd_rows(spark):
    long = "<a href='http://t.net/'>" + "x" * 300_000 + "<a href=\"//bad.com/\">"
    pages = [
        (1, "http://q.net/", long, "r"), (1, "http://q.net/", long, "r"), (2, "http://bad.com/de/", "", "r"), (None, None, None, None),
        (3, "http://z.net/", "", "s")
    ]
    rows = spark.createDataFrame(pages, "page_id long, url string, html string, rule string").withColumns(
        {"verdict": F.lit("old"), "by_rule": F.lit("old"), "host": F.lit("old")}
    )
    got = sorted((str(r.page_id), r.host, r.rule, r.verdict) for r in urlfilter.judge(rows).collect())
    assert got == [
        ("1", "q.net", None, "block"), ("1", "q.net", None, "block"), ("2", "bad.com", "com/de/", "block"), ("3", "z.net", None, "allow"),
        ("None", "", None, "allow")
    ]


def test_no_pages(spark):
    assert urlfilter.judge(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_words_of_contract():
    assert re.findall(r"[^\x20\x09-\x0D]+", "a b c") == ["a b", "c"]
