"""Sharding, infilling and clustering, against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from compare import SMALL

from lorebed.llm import centroids, infill, queries, sharding

DOC = "doc_id long, text string, source string"


def digits(text: str) -> list[int]:
    h = hashlib.sha256(text.encode()).hexdigest()
    return [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]


def md5(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()


# ---- sharding


def plain_shards(docs: list[tuple], shards: int, seed: int = 1) -> list[tuple]:
    """(doc_id, text, shard, slot), by sorting each source and then all."""
    strata: dict[str, list] = {}
    for k, t, s in docs:
        strata.setdefault("-" if s is None else f"+{s}", []).append((md5(f"{seed}:{'' if k is None else k}"), md5(t or ""), k, t))
    placed = []
    for name, rows in strata.items():
        offset = int(md5(f"{seed}:{name}")[:8], 16) / 2**32
        placed += [((r + 1 - offset) / len(rows), name, *row) for r, row in enumerate(sorted(rows, key=lambda x: x[:2]))]
    placed.sort(key=lambda x: x[:4])
    out, first = [], {}
    for at, (*_, k, t) in enumerate(placed):
        shard = at * shards // len(placed)
        first.setdefault(shard, at)
        out.append((k, t, shard, at - first[shard]))
    return out


def mixed(n: int, seed: int) -> list[tuple]:
    """A third of all rows from one source, some sources of a few rows, texts and ids that repeat."""
    rng = random.Random(seed)
    sources = ["hot"] * 10 + [f"s{k}" for k in range(15)] + [None, "", "-", "+"]
    docs = [(k, f"text {rng.randrange(n // 2)} ü🙂", rng.choice(sources)) for k in range(n)]
    docs += [(k, None, f"tiny{k}") for k in range(20)] + docs[:9] + docs[:3]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize(("n", "shards"), [(1500, 40), (30, 40), (700, 7)])
def test_shards_against_plain(spark, n, shards):
    docs = mixed(n, n)
    rows = spark.createDataFrame(docs, DOC).repartition(7)
    got = [(r.doc_id, r.size, r.text_crc32, r.shard, r.slot, r.law, r.grown_shard) for r in sharding.shard_documents(rows, shards).collect()]
    want = [
        (k, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), shard, slot, "rows", None) for k, t, shard, slot in plain_shards(docs, shards)
    ]
    assert sorted(got) == sorted(want)


def test_shards_have_the_mixture_and_equal_counts(spark):
    docs = mixed(4000, 5)
    found = sharding.interleave(spark.createDataFrame(docs, DOC), 40).collect()
    each = Counter(r.shard for r in found)
    assert set(each) == set(range(40)) and max(each.values()) - min(each.values()) <= 1
    assert all(sorted(r.slot for r in found if r.shard == k) == list(range(n)) for k, n in each.items())
    whole = Counter(r.source for r in found)
    by = Counter((r.source, r.shard) for r in found)
    assert all(abs(by[s, k] - n / 40) <= 2 + n / 1000 for s, n in whole.items() for k in range(40))
    # Twenty sources of one row each are spread and not all in the middle.
    assert len({r.shard for r in found if str(r.source).startswith("tiny")}) >= 10


def test_another_seed_shuffles_anew(spark):
    rows = spark.createDataFrame(mixed(300, 6), DOC)
    one, two = ({(r.doc_id, r.shard, r.slot) for r in sharding.interleave(rows, 5, seed=s).collect()} for s in (1, 2))
    assert one != two


def test_written_shards(spark, tmp_path):
    docs = mixed(600, 7)
    rows = spark.createDataFrame(docs, DOC)
    path = str(tmp_path / "shards")
    sharding.write_shards(rows, path, shards=6, files=3)
    back = spark.read.parquet(path)
    assert sorted(back.columns) == ["doc_id", "shard", "slot", "source", "text"]
    assert Counter((r.doc_id, r.text, r.source) for r in back.collect()) == Counter(docs)
    # Every file holds consecutive slots in order.
    import pyarrow.parquet as pq

    seen: dict[str, list] = {}
    for file in sorted((tmp_path / "shards").glob("shard=*/*.parquet")):
        slots = pq.ParquetFile(file).read().column("slot").to_pylist()
        assert slots == list(range(slots[0], slots[0] + len(slots)))
        seen.setdefault(file.parent.name, []).extend(slots)
    assert len(seen) == 6 and all(sorted(x) == list(range(len(x))) for x in seen.values())


def test_shards_of_odd_rows(spark):
    odd = [(None, None, None), (None, "", "s"), (1, "x" * 300_000, "s"), (1, "x" * 300_000, "s"), (2, "Ünïcödé 日本 🙂", None)]
    got = sorted((r.size, r.shard, r.slot) for r in sharding.shard_documents(spark.createDataFrame(odd, DOC), 3).collect())
    assert [g[0] for g in got] == [16, 16, 16 + len("Ünïcödé 日本 🙂".encode()), 300_016, 300_016]
    assert sharding.shard_documents(spark.createDataFrame([], DOC)).collect() == []


def test_shards_beside_clashing_names(spark):
    names = ["stratum", "order", "slice", "rank", "before", "total", "fraction", "part", "position", "shard", "slot", "__own_0", "then", "rows", "law", "size"]
    rows = spark.createDataFrame([(k, "t", "ab"[k % 2], *[f"{k}{c}" for c in names]) for k in range(8)], f"{DOC}, " + ", ".join(f"`{c}` string" for c in names))
    found = sharding.interleave(rows, 2)
    assert found.columns == [c for c in rows.columns if c not in ("shard", "slot")] + ["shard", "slot"]
    assert all(r[c] == f"{r.doc_id}{c}" for r in found.collect() for c in names if c not in ("shard", "slot"))
    assert sharding.shard_documents(rows).columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def test_sharding_starts_no_python_worker(spark):
    plan = queries.op11_sharding(spark, SMALL)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "ExistingRDD"))


# ---- fill in the middle


def plain_infill(doc_id, text: str | None, seed: int = 1) -> tuple:
    text = text or ""
    h = digits(f"{seed}:{'' if doc_id is None else doc_id}")
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def texts(n: int, seed: int) -> list[tuple]:
    rng = random.Random(seed)
    letters = "ab <>PSM\n\r\t$\\{}()日本🙂é́ \x00\x85👨‍👩‍👧"
    docs = [(k, "".join(rng.choice(letters) for _ in range(rng.randrange(60)))) for k in range(n)]
    return docs + [(n, None), (n + 1, ""), (None, "no id <M"), (n + 2, "has <P> in it"), (3, "again"), (3, "again"), (n + 3, "<" * 30), (n + 4, "$1$2$3\\1")]


def test_infill_against_plain(spark):
    docs = texts(500, 1)
    found = infill.fill_in_middle(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    got = [tuple(r) for r in found.withColumn("back", infill.restored()).collect()]
    want = [(k, t, *plain_infill(k, t), t or "") for k, t in docs]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {g[3] for g in got} == {"plain", "psm", "spm"}


def test_infill_of_a_long_text(spark):
    """Cuts deep in a text of a million code points, most of two surrogates: no stack is used up."""
    docs = [(k, "🙂b\n" * 400_000) for k in range(6)]
    found = infill.fill_in_middle(spark.createDataFrame(docs, "doc_id long, text string")).withColumn("back", infill.restored())
    for r in found.collect():
        assert (r.n, r.form, r.prefix_units, r.middle_units, r.output) == plain_infill(r.doc_id, docs[0][1]) and r.back == docs[0][1]


def test_infill_by_lines(spark):
    docs = [(k, "".join(f"line {i} of {k}\n" for i in range(k % 9)) + "end" * (k % 2)) for k in range(60)] + [(99, "\n\n\n")]
    found = infill.fill_in_middle(spark.createDataFrame(docs, "doc_id long, text string"), unit=infill.LINE).withColumn("back", infill.restored())
    for r in found.collect():
        lines = [x for x in r.text.split("\n")]
        lines = [x + "\n" for x in lines[:-1]] + [lines[-1]] * bool(lines[-1])
        assert r.n == len(lines) and r.back == r.text
        if r.form == "psm":
            a, b = r.prefix_units, r.prefix_units + r.middle_units
            assert r.output == f"<P>{''.join(lines[:a])}<S>{''.join(lines[b:])}<M>{''.join(lines[a:b])}"


def test_infill_with_other_marks(spark):
    marks = infill.Marks("$1(", "\\[", "^.*")
    docs = [(k, f"some text {k} with $1 and .* and [") for k in range(40)] + [(50, "has $1( itself"), (51, "has \\[ itself")]
    found = infill.fill_in_middle(spark.createDataFrame(docs, "doc_id long, text string"), marks=marks).withColumn("back", infill.restored(marks=marks)).collect()
    assert all(r.back == r.text for r in found) and any(r.output.startswith("$1(") for r in found)
    assert {r.form for r in found if r.doc_id >= 50} == {"plain"}


def test_infill_of_no_rows_and_clashing_names(spark):
    assert infill.fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    rows = spark.createDataFrame([(1, "abc", 7, "x", "y", "z")], "doc_id long, text string, n int, form string, __own_2 string, __hash string")
    (r,) = infill.fill_in_middle(rows).collect()
    assert (r["n"], r["__own_2"], r["__hash"], r["form"]) == (3, "y", "z", plain_infill(1, "abc")[1])


def test_infill_query_restores_every_text(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in queries.op12_infill(spark, SMALL).collect():
        n, form, prefix, middle, output = plain_infill(r.doc_id, docs[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, prefix, middle)
        assert r.output_sha256 == hashlib.sha256(output.encode()).hexdigest() and r.restored_sha256 == hashlib.sha256((docs[r.doc_id] or "").encode()).hexdigest()


# ---- centroids

VEC = "vec_id long, embedding array<float>"


def plain_clusters(rows: list[tuple], k: int = 16, rounds: int = 3, dim: int = 64) -> list[tuple]:
    kept = [(i, [math.floor(float(np.float32(x)) * 64) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    middle = [list(v) for _, v in first]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(middle))
    for _ in range(rounds):
        chosen = [nearest(v)[1] for _, v in kept]
        own = [[v for (_, v), c in zip(kept, chosen) if c == n] for n in range(len(middle))]
        middle = [[sum(x) // len(vs) for x in zip(*vs)] if vs else m for vs, m in zip(own, middle)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = Counter()
    for _, d, n in found:
        inertia[n] += d
    return [(i, n, d, inertia[n], sum(inertia.values()), tuple(middle[n])) for i, d, n in found]


def vectors(n: int, seed: int, dim: int = 64) -> list[tuple]:
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(9, dim))
    return [(k, (middles[k % 9] + rng.normal(size=dim) * 0.3).astype(np.float32).tolist()) for k in range(n)]


ODD_VECTORS = [
    (900, None), (901, []), (902, [0.5] * 63), (903, [0.5] * 65), (904, [0.5] * 63 + [None]), (905, [0.5] * 63 + [float("nan")]),
    (906, [float("inf")] + [0.5] * 63), (907, [-1e5] * 64), (907, [-1e5] * 64), (None, [0.25] * 64), (None, [-0.0001] * 64)
]


@pytest.mark.parametrize("rows", [vectors(400, 1) + ODD_VECTORS, vectors(12, 2), ODD_VECTORS, [(k, [0.1] * 64) for k in range(50)], vectors(60, 3) * 3])
def test_clusters_against_plain(spark, rows):
    found = centroids.cluster(spark.createDataFrame(rows, VEC).repartition(5)).collect()
    assert sorted((tuple(map(str, (r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, tuple(r.centroid)))) for r in found)) == sorted(
        tuple(map(str, x)) for x in plain_clusters(rows)
    )


def test_clusters_of_no_vectors(spark):
    for rows in ([], ODD_VECTORS[:7]):
        found = centroids.cluster(spark.createDataFrame(rows, VEC))
        assert found.collect() == [] and found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]


def test_a_component_beyond_64_bits_is_an_error(spark):
    with pytest.raises(Exception, match="64 bits"):
        centroids.cluster(spark.createDataFrame([(1, [1e30] * 64)], VEC)).collect()


def test_clusters_beside_clashing_names(spark):
    rows = spark.createDataFrame([(i, v, "x", 5) for i, v in vectors(30, 4)], f"{VEC}, cluster string, v int")
    assert {r.vec_id: r.cluster for r in centroids.cluster(rows).collect()} == {x[0]: x[1] for x in plain_clusters(vectors(30, 4))}


@pytest.mark.parametrize(("spread", "largest"), [(1, 3), (50, 40), (10, 10**6), (1, 1)])
def test_search_is_exact_and_ties_go_to_the_smaller_number(spread, largest):
    rng = np.random.default_rng(largest)
    middles = rng.integers(-largest, largest + 1, size=(33, 8)) * spread
    middles[5] = middles[20]
    x = np.concatenate([rng.integers(-largest, largest + 1, size=(3000, 8)) * spread, middles])
    number, distance = centroids.NearestCentroid(middles)(x)
    every = ((x[:, None, :] - middles[None]) ** 2).sum(axis=2)
    assert (distance == every.min(axis=1)).all() and (number == every.argmin(axis=1)).all()


def test_search_passes_over_most_centroids():
    rng = np.random.default_rng(3)
    middles = rng.integers(-40, 40, size=(256, 16)) + rng.integers(-300, 300, size=(256, 1))
    search = centroids.NearestCentroid(middles)
    search(middles[rng.integers(0, 256, 4000)] + rng.integers(-3, 4, size=(4000, 16)))
    assert search.compared < 0.05 * 4000 * 256


def test_cluster_query_against_plain(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    want = {x[0]: (x[1], x[2], x[3], x[4], hashlib.sha256(",".join(map(str, x[5])).encode()).hexdigest()) for x in plain_clusters(rows)}
    assert {r.vec_id: (r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in queries.op13_centroids(spark, SMALL).collect()} == want
