from __future__ import annotations

import itertools
import random
import time

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from lorebed.functions import fuzzy
from lorebed.operators import answers, dedupe, discovery, entities, export, frontier, graph, languages, reports, validate
from lorebed.sources import search, settings, tables
from lorebed.streaming import frontier as stream
from lorebed.vocabulary import FRONTIER_COLUMNS


def clusters(spark, names, merge, review, location_of=None):
    rows = spark.createDataFrame([(i, n, (location_of or {}).get(n, "")) for i, n in enumerate(names)], "_ord long, name string, location string")
    found, pairs = entities.cluster(rows, merge, review)
    return {r.name: r.cluster for r in found.collect()}, pairs.collect()


def test_close_names_merge(spark):
    of, _ = clusters(spark, ["ascend elements", "ascend element", "sk battery america"], 90, 80)
    assert of["ascend elements"] == of["ascend element"] != of["sk battery america"]


def test_near_miss_is_flagged(spark):
    assert clusters(spark, ["hyundai mobis georgia", "hyundai mobis alabama"], 95, 70)[1]


def test_conflicting_locations(spark):
    of, pairs = clusters(spark, ["acme plant", "acme plants"], 90, 80, {"acme plant": "Jackson County", "acme plants": "Coweta County"})
    assert of["acme plant"] != of["acme plants"] and pairs
    of, _ = clusters(spark, ["acme plant", "acme plants"], 90, 80, {"acme plant": "Jackson County"})
    assert of["acme plant"] == of["acme plants"]
    of, pairs = clusters(spark, ["hyundai mobis", "hyundai mobis"], 90, 80, {"hyundai mobis": "Bryan County"})
    assert len(set(of.values())) == 1 and not pairs


def test_a_chain_over_a_name_without_place(spark):
    """The middle one goes to its closer neighbour; the other end, in another county, stays apart and is flagged."""
    names = {"savannah battery plant one": "Bryan County", "savannah battery plant ones": "", "savannah battery plant onesx": "Jackson County"}
    of, pairs = clusters(spark, list(names), 90, 80, names)
    one, ones, onesx = names
    assert of[one] != of[onesx] and of[ones] in (of[one], of[onesx])
    assert {frozenset((p.a, p.b)) for p in pairs} == {frozenset(p) for p in itertools.combinations(names, 2) if of[p[0]] != of[p[1]]}


def one_by_one(names, merge, review, location_of):
    """Pairs in order of their scores, one after the other."""
    import hashlib

    own = {n: i for i, n in enumerate(names)}
    of, mark = {n: n for n in names}, {n: location_of.get(n) or None for n in names}
    scored = [(a, b, fuzzy.token_sort_ratio(a, b)) for a, b in itertools.combinations(sorted(names), 2)]
    for a, b, _ in sorted((p for p in scored if p[2] >= merge), key=lambda p: (-p[2], hashlib.md5(f"{p[0]}\1{p[1]}".encode()).hexdigest())):
        x, y = of[a], of[b]
        if x != y and not (mark[x] and mark[y] and mark[x] != mark[y]):
            mark[x] = mark[x] or mark[y]
            of = {n: x if c == y else c for n, c in of.items()}
    heads = {c: min((n for n in names if of[n] == c), key=own.get) for c in set(of.values())}
    return {n: heads[c] for n, c in of.items()}, {(a, b) for a, b, s in scored if s >= review and of[a] != of[b]}


def test_clusters_of_many_names_with_places(spark):
    rng = random.Random(4)
    part = lambda: "".join(rng.choice(["ba", "ken", "tor", "li", "san"]) for _ in range(rng.randint(2, 4)))
    heads = [f"{part()} {part()}" for _ in range(70)]
    names = sorted({h[:k] + rng.choice("xyz") + h[k + 1 :] for h in heads for k in (1, 3, 5, 6, 8)} | set(heads))[:160]
    rng.shuffle(names)
    places_of = {n: rng.choice([None, "", "Bryan County", "Jackson County", "Coweta County"]) for n in names}
    of, pairs = clusters(spark, names, 88, 80, places_of)
    want, apart = one_by_one(names, 88, 80, places_of)
    assert of == want and {(p.a, p.b) for p in pairs} == apart
    held = {}
    for n, c in of.items():
        held.setdefault(c, set()).update(filter(None, [places_of[n]]))
    assert max(map(len, held.values())) == 1 and len(set(of.values())) < 120


def test_large_components_go_through_rounds(spark):
    """Random links with few different scores: the rounds of joins give what one task gives."""
    rng = random.Random(9)
    links = [(f"n{a:02}", f"n{b:02}", float(rng.randint(88, 92))) for a, b in itertools.combinations(range(40), 2) if rng.random() < 0.06]
    rows = spark.createDataFrame(links, "a string, b string, score double")
    marks = spark.createDataFrame([(f"n{k:02}", rng.choice([None, "A", "B", "C"])) for k in range(40)], "node string, mark string")
    task, rounds = ({(r.node, r.root) for r in graph.agglomerated(rows, marks, most).collect()} for most in (10**6, 0))
    assert task == rounds and len({r for _, r in task}) > 3


def test_blocking_loses_no_pair(spark):
    rng = random.Random(5)
    words = ["acme", "plant", "battery", "georgia", "sk"]
    names = sorted({" ".join(rng.choice(words)[: rng.randint(2, 9)] + rng.choice(["", "s", "x"]) for _ in range(rng.randint(1, 3))) for _ in range(60)})
    got = {(r.a, r.b) for r in entities.similar_pairs(spark.createDataFrame([(n,) for n in names], "name string"), 80).collect()}
    assert got == {(a, b) for a, b in itertools.combinations(names, 2) if fuzzy.token_sort_ratio(a, b) >= 80}


def test_files_in_order(spark, tmp_path):
    """The first row is that of the first file, however large the others are."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("url,title\nu1,first\n")
    (tmp_path / "in" / "b.csv").write_text("url,title\n" + "u1,later\n" * 500 + "u2,b\n")
    (tmp_path / "in" / "c.csv").write_text("url,title\nu2,later\nu3,c\n" + "u1,last\n" * 2000)
    rows = tables.read_csv(spark, str(tmp_path / "in"), ["url", "title"])
    assert [r._ord for r in rows.orderBy("_ord").collect()] == list(range(2504))
    assert {r.url: r.title for r in dedupe.first_of(rows, ["url"], "_ord").collect()} == {"u1": "first", "u2": "b", "u3": "c"}


def test_appended_rows_come_last(spark, tmp_path):
    path, columns = str(tmp_path / "out"), ["url", "title"]
    batches = [[("u1", "old")], [("u1", "new")] * 21 + [("u2", "new")], [("u2", "newest")] * 300 + [("u3", 'x, "y"\nz')]]
    for rows in batches:
        tables.append_csv(spark.createDataFrame(rows, columns).repartition(3), path, columns)
    back = tables.read_csv(spark, path, columns)
    assert {r.url: r.title for r in dedupe.first_of(back, ["url"], "_ord").collect()} == {"u1": "old", "u2": "new", "u3": 'x, "y"\nz'}
    assert back.selectExpr("max(_ord)").first()[0] == 323


def test_a_written_table_keeps_its_order(spark, tmp_path):
    rows = spark.range(5000).selectExpr("id AS _ord", "repeat('x', int(id % 97)) AS text", "id AS n").repartition(9, "text")
    tables.write_csv(rows, str(tmp_path / "csv"), ["n", "text"])
    back = tables.read_csv(spark, str(tmp_path / "csv"), ["n"]).orderBy("_ord").collect()
    assert [int(r.n) for r in back] == list(range(5000)) == [r._ord for r in back]
    tables.write_jsonl(rows, str(tmp_path / "json"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        found = tables.with_order(tables.read_jsonl(spark, str(tmp_path / "json"), "n long"), "place")
        assert found.rdd.getNumPartitions() > 9 and [r.n for r in found.orderBy("place").collect()] == list(range(5000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_file_is_replaced_in_one_step(spark, tmp_path):
    path = tmp_path / "table.csv"
    for n in (3, 1, 5):
        tables.write_csv_file(spark.range(n).selectExpr("id AS _ord", "id AS n"), str(path), ["n"], "_ord")
        assert path.read_bytes() == b"".join(b"%s\r\n" % x for x in [b"n", *(str(k).encode() for k in range(n))])
        assert [int(r.n) for r in tables.read_csv(spark, str(path), ["n"]).orderBy("_ord").collect()] == list(range(n))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["table.csv"]


def test_answers_of_a_model(spark):
    import json

    record = {
        "entity_name": "Acme", "details": 200000000, "overview": None, "confidence_score": "1.7", "facilities": [{"name": "Acme Plant", "county": "Jackson County"}],
        "investment": [{"amount": "$1B", "date": "2020"}], "jobs": [{"hiring_goal": "500", "hiring_areas": "production"}],
        "related_organizations": {"name": "Acme Parent Co", "role": "Parent company"}, "key_facts": "Acme is Georgia's largest widget maker", "aliases": ["ACME Inc", None, 7],
    }
    given = [
        json.dumps({"records": [record, {"confidence_score": "n/a", "key_facts": ["a", "b"]}]}), "```json\n" + json.dumps([record]) + "\n```", "{}", '{"records": null}', '{"records": [', None, "",
        "7", '{"records": {"entity_name": "x"}}', '{"records": [5, null, {"entity_name": true}]}',
    ]
    rows = spark.createDataFrame(list(enumerate(given)), "n long, answer string")
    got = {(r.n, r.place): r for r in answers.records(rows).collect()}
    assert {k: r.reason for k, r in got.items()} == {
        (0, 0): None, (0, 1): None, (1, 0): None, (4, None): "malformed_json", (5, None): "malformed_json", (6, None): "malformed_json", (7, None): "not_an_answer",
        (8, None): "records_not_a_list", (9, 0): "record_not_an_object", (9, 1): "record_not_an_object", (9, 2): None,
    }
    for r in (got[0, 0], got[1, 0]):
        assert (r.details, r.overview, r.confidence_score, r.key_facts, r.aliases) == ("200000000", "", 1.0, [record["key_facts"]], ["ACME Inc", "7"])
        assert (r.facilities[0].name, r.investment[0].amount, r.jobs[0].hiring_areas, r.related_organizations[0].role) == ("Acme Plant", "$1B", ["production"], "Parent company")
    assert (got[0, 1].confidence_score, got[0, 1].key_facts, got[0, 1].facilities, got[9, 2].entity_name) == (0.0, ["a", "b"], [], "true")


def test_counts_of_what_is_written(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id AS _ord", "id % 3 = 0 AS changed")
    counts = tables.observed(rows, lambda new: tables.write_csv(new, str(tmp_path / "t"), ["_ord"], order=None), rows=F.count("*"), changed=F.count_if("changed"))
    assert counts == {"rows": 1000, "changed": 334} and len(tables.read_csv(spark, str(tmp_path / "t"), []).collect()) == 1000


def test_upsert_reads_the_frontier_as_it_lies(spark, tmp_path):
    made = lambda low, high, priority: frontier.from_candidates(
        spark.range(low, high).selectExpr("id AS _ord", "concat('https://x/', id) AS normalized_url", f"'{priority}' AS priority", "'seed' AS source_type", "'' AS discovered_date"), "_ord"
    )
    known = made(0, 200, "high")
    frontier.save_bucketed(known, "bucketed_frontier", str(tmp_path / "b"), 4)
    merged = frontier.upsert_bucketed(spark, "bucketed_frontier", made(190, 210, "low"))
    rows = merged.collect()
    assert len(rows) == 210 and sum(r.inserted for r in rows) == 10 and sum(r.priority == "low" for r in rows) == 20
    side = merged._jdf.queryExecution().executedPlan().toString().split("bucketed_frontier")[0].rsplit("SortMergeJoin", 1)[1]
    assert "Exchange" not in side and "Join" not in side
    spark.sql("DROP TABLE bucketed_frontier")


def test_exact_quartiles_in_rounds(spark):
    import statistics

    rng = random.Random(3)
    data = [(rng.choice([rng.gauss(0, 1), rng.randint(0, 5), 1e9 * rng.random()]), None if k % 5 else k, 7, None) for k in range(3001)]
    rows = spark.createDataFrame([tuple(None if x is None else float(x) for x in r) for r in data], "a double, b double, c double, d double")
    got = {r["column"]: r for r in reports.described(rows, ["a", "b", "c", "d"], buckets=7).collect()}
    for i, name in enumerate("abc"):
        values = [float(r[i]) for r in data if r[i] is not None]
        assert [got[name].q25, got[name].q50, got[name].q75] == pytest.approx(statistics.quantiles(values, n=4, method="inclusive"), rel=1e-12)
        assert (got[name].n, got[name].min, got[name].max) == (len(values), min(values), max(values))
    assert (got["d"].n, got["d"].q50) == (0, None)


def test_crawl_report_shuffles_once(spark):
    rows = spark.createDataFrame([("success", "en", "a", "true"), ("failed", "en", "b", "false"), ("success", None, "a", "false"), (None, "fr", "c", "true")], "crawl_status string, language string, domain string, is_duplicate_content string")
    report = reports.crawl_report(rows)
    assert sorted(map(str, map(tuple, report.collect()))) == sorted(map(str, [
        ("status", "success", 2), ("status", "failed", 1), ("status", None, 1), ("language", "en", 1), ("language", None, 1), ("failed_domain", "b", 1), ("duplicates", "", 2)
    ]))
    assert report._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange ") == 1


def test_few_pairs_of_names_are_compared(spark):
    """Invented names of common syllables: all close pairs, and hardly any others, reach the exact comparison."""
    rng = random.Random(7)
    part = lambda: "".join(rng.choice(["ba", "ken", "tor", "li", "san", "mo", "ri", "del", "ka", "vin"]) for _ in range(rng.randint(2, 4)))
    names = sorted({f"{part()} {part()}" for _ in range(560)})
    names = sorted({*names, *(n[:3] + rng.choice("xyz") + n[4:] for n in names[:40])})
    rows = spark.createDataFrame([(n,) for n in names], "name string")
    compared = entities.candidate_pairs(rows, 80).collect()
    want = {(a, b) for a, b in itertools.combinations(names, 2) if fuzzy.token_sort_ratio(a, b) >= 80}
    assert want <= {(r.a, r.b) for r in compared} and len(want) > 30
    assert len(compared) < 0.05 * len(names) * (len(names) - 1) / 2


@pytest.mark.parametrize("least", [55, 70, 95])
def test_name_pairs_at_any_threshold(spark, least):
    rng = random.Random(least)
    names = sorted({"".join(rng.choice("abcd ") for _ in range(rng.randint(1, 14))).strip() or "a" for _ in range(70)})
    got = {(r.a, r.b) for r in entities.similar_pairs(spark.createDataFrame([(n,) for n in names], "name string"), least).collect()}
    assert got == {(a, b) for a, b in itertools.combinations(names, 2) if fuzzy.token_sort_ratio(a, b) >= least}


def test_profiles_have_places_and_overview(spark):
    schema = "_ord long, entity_name string, entity_type string, supply_chain_category string, key_facts array<string>, source_url string, evidence_text string, confidence_score double, publication_date string, locations array<string>, overview string"
    rows = [(0, "A", "company", "logistics", ["f"], "u", "e", 0.5, "2024-01", ["X"], "short"), (1, "a", "event", "logistics", ["g"], "u", "e", 0.7, "", ["Y", "X"], "longer text"), (2, "b", "event", "x", None, "u", "e", None, None, None, None)]
    of = spark.createDataFrame([("A", "A"), ("a", "A"), ("b", "b")], "name string, cluster string")
    got = {r.canonical_name: r for r in entities.profiles(spark.createDataFrame(rows, schema), of).collect()}
    assert (got["A"].locations, got["A"].overview, got["A"].entity_type, got["A"].publication_date_range) == (["X", "Y"], "longer text", "company", "2024-01")
    assert (got["b"].locations, got["b"].overview) == ([], "")


def test_sizes_of_profiles(spark):
    rows = [
        (0, "A", "t1", "u", "e", ["f", "g"]), (1, "A", "t2", "u", "e", ["g", None, ""]), (2, "B", "t3", "u", None, None), (3, "B", "t3", "u", "", [None]),
        (4, "B", "t3", None, "u", []), (5, "C", None, "u|1:e", "", ["f"]), (6, "C", "t4", "u", "1:e|0:", ["f", "f"]), (7, "D", "t5", "x", "y", ["z"]),
    ]
    kinds = "_ord long, entity_name string, entity_type string, source_url string, evidence_text string, key_facts array<string>"
    records = spark.createDataFrame([(*r, "logistics", 0.5, "") for r in rows], f"{kinds}, supply_chain_category string, confidence_score double, publication_date string")
    names = spark.createDataFrame([("A", "A"), ("B", "A"), ("C", "C")], "name string, cluster string")
    whole = {r.canonical_name: (r.aliases, r.entity_type, len(r.sources), len(r.key_facts)) for r in entities.profiles(records, names).collect()}
    sizes = entities.profile_sizes(records, names)
    assert {r.canonical_name: (r.aliases, r.entity_type, r.n_sources, r.n_facts) for r in sizes.collect()} == whole == {"A": (["A", "B"], "t1", 4, 4), "C": (["C"], None, 2, 1)}
    # The lists of a whole cluster were in one task before.
    plan = sizes._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_set(") == 1 and "collect_list(" not in plan


def test_dates_from_a_side_table(spark):
    rows = spark.createDataFrame([("p1", ""), ("p2", "2024"), ("p3", None)], "page_id string, publication_date string")
    dates = spark.createDataFrame([("p1", "2023-05-01"), ("p1", ""), ("p2", "1999-01-01")], "page_id string, publication_date string")
    assert {tuple(r) for r in entities.with_dates(rows, dates).collect()} == {("p1", "2023-05-01"), ("p2", "2024"), ("p3", "")}
    assert {tuple(r) for r in entities.with_dates(rows.select("page_id"), dates).collect()} == {("p1", "2023-05-01"), ("p2", "1999-01-01"), ("p3", "")}


def test_records_are_cleaned_before_validation(spark):
    orgs = [(" Beta ", "x"), ("", "y"), (None, "z"), ("acme", "self"), ("BETA", "again"), ("Gamma", None)]
    rows = spark.createDataFrame([(" Acme ", orgs), ("Solo", None)], "entity_name string, related_organizations array<struct<name string, role string>>")
    got = {r.entity_name: [(o.name, o.role) for o in r.related_organizations] for r in validate.normalize_records(rows).collect()}
    assert got == {"Acme": [("Beta", "x"), ("Gamma", None)], "Solo": []}


def test_long_lists_of_organizations(spark):
    n = 6000
    orgs = [(f" Org {i % (n // 2)}" if i % 2 else f"ORG {i % (n // 2)} ", str(i)) for i in range(n)]
    rows = spark.createDataFrame([("org 7", orgs), ("None", [])], "entity_name string, related_organizations array<struct<name string, role string>>")
    begun = time.monotonic()
    got = {r.entity_name: [(o.name, o.role) for o in r.related_organizations] for r in validate.normalize_records(rows).collect()}
    # Each name held against all before it took minutes.
    assert time.monotonic() - begun < 30
    assert got == {"org 7": [(f"Org {i}" if i % 2 else f"ORG {i}", str(i)) for i in range(n // 2) if i != 7], "None": []}


def test_organizations_of_a_shared_list(spark):
    kinds = "related_organizations array<struct<name string, role string>>"
    lists = {1: [("Beta ", "x"), ("beta", "y"), (None, "z"), ("  ", "n"), ("ACME", "a"), ("Straße", "s")], 2: [("Gamma", "g"), None, (" gamma", "h")]}
    own = [(" Acme ", 1, [("STRASSE", "o"), ("", "p")]), ("Beta", 1, []), ("Delta", 2, [("delta", "q"), ("Beta", "r")]), ("Delta 2", 2, None), ("Solo", 3, [("gamma", "t")]), ("None", None, [("x", "u")])]
    rows = spark.createDataFrame(own, f"entity_name string, k long, {kinds}")
    shared = spark.createDataFrame(list(lists.items()), f"k long, {kinds}")
    names = lambda found: {r.entity_name: [(o.name, o.role) for o in r.related_organizations] for r in found.collect()}
    whole = spark.createDataFrame([(n, k, (o or []) + lists.get(k, [])) for n, k, o in own], rows.schema)
    got = names(validate.with_shared_organizations(rows, shared, "k"))
    assert got == names(validate.normalize_records(whole))
    assert got["Acme"] == [("STRASSE", "o"), ("Beta", "x")] and got["Delta"] == [("Beta", "r"), ("Gamma", "g")]


def test_failures_of_all_kinds(spark):
    rows = [(0, "p", "u", "A", "e", [], "passed"), (1, "p", "u", "a", "e", [], "passed"), (2, "p", "u", "b", "x", ["r"], "failed")]
    done = spark.createDataFrame(rows, "_ord long, page_id string, source_url string, entity_name string, evidence_text string, rejection_reasons array<string>, validation_status string")
    earlier = spark.createDataFrame([("q", "generation"), ("r", "validation")], "page_id string, failure_stage string")
    passed, failed = validate.split(done, earlier, order="_ord")
    assert [r._ord for r in passed.collect()] == [0]
    assert sorted((r.page_id, r._ord, r.rejection_reasons) for r in failed.collect() if r._ord is not None) == [("p", 1, ["duplicate_record"]), ("p", 2, ["r"])]
    assert [r.page_id for r in failed.collect() if r._ord is None] == ["q"]


def test_requeue_counts_unknown_retries(spark):
    rows = spark.createDataFrame([("failed", None), ("failed", 3), ("failed", 1), ("queued", None)], "status string, retry_count int")
    assert [(r.status, r.retry_count) for r in frontier.requeue_failed(rows).collect()] == [("queued", 1), ("failed", 3), ("queued", 2), ("queued", 0)]
    pages = spark.createDataFrame([("text/html; charset=utf-8",), ("application/pdf",), (None,), (" TEXT/HTML ",)], "content_type string")
    assert frontier.allowed_content(pages).count() == 2


def test_json_cells(spark):
    row = spark.createDataFrame([(0, 5, "", 'a"b', False, [], ["x", None], 0.0)], "a int, b int, c string, d string, e boolean, f array<string>, g array<string>, h double")
    cells = row.select(*[export.json_cell(F.col(c), row.schema[c].dataType).alias(c) for c in row.columns]).first()
    assert list(cells) == ["[]", "5", "[]", '"a\\"b"', "[]", "[]", '["x",null]', "[]"]


def test_limits_of_exports(spark):
    rows = [(k, f"E{k}", [("u1", "t", "d", "e"), ("u2", "t", "d", "e")], "o", ["X"], "", "fresh") for k in range(3)]
    found = spark.createDataFrame(rows, "_ord long, canonical_name string, sources array<struct<source_url string, source_title string, source_domain string, evidence_text string>>, overview string, locations array<string>, publication_date_range string, currency string").withColumn("claim_status", F.lit(""))
    assert export.final_wiki(found, 2).count() == 2 and export.final_wiki(found, 0).count() == 3
    assert export.finetuning(found, 1).count() == 2 and export.sources(found, 3).count() == 3


def test_listing_from_a_to_z(spark):
    rows = spark.createDataFrame([("beta", "x. y", ""), ("Alpha", "", "Z County"), ("alpha", "", "")], "canonical_name string, overview string, county string").withColumn("category", F.lit("c"))
    assert [r.canonical_name for r in export.wiki_lines(rows).collect()] == ["Alpha", "alpha", "beta"]


def test_single_files(spark, tmp_path):
    rows = spark.createDataFrame([(1, 'x,"y"', None), (0, "line\nbreak", "ü")], "_ord int, a string, b string")
    path = str(tmp_path / "t.csv")
    for _ in range(2):
        tables.write_csv_file(rows, path, ["a", "b"], "_ord")
        assert (tmp_path / "t.csv").read_bytes().decode() == 'a,b\r\n"line\nbreak",ü\r\n"x,""y""",\r\n'
    tables.write_csv_file(rows.limit(0), str(tmp_path / "e.csv"), ["a", "b"])
    assert (tmp_path / "e.csv").read_bytes() == b"a,b\r\n"
    tables.write_jsonl_file(rows, str(tmp_path / "t.jsonl"), "_ord")
    assert (tmp_path / "t.jsonl").read_text(encoding="utf-8").splitlines() == ['{"_ord":0,"a":"line\\nbreak","b":"ü"}', '{"_ord":1,"a":"x,\\"y\\"","b":null}']
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")) == ["e.csv", "t.csv", "t.jsonl"]
    back = tables.read_jsonl_typed(spark, str(tmp_path / "t.jsonl"))
    assert dict(back.dtypes)["_ord"] == "bigint" and back.count() == 2
    (tmp_path / "n.csv").write_text("n,s\n1,x\n2,\n")
    typed = tables.read_csv_typed(spark, str(tmp_path / "n.csv"))
    assert dict(typed.dtypes) == {"n": "int", "s": "string"} and typed.where("s IS NULL").count() == 1
    assert [r._ord for r in tables.head(rows, 1).collect()] == [0]


def test_halves_and_shards(spark):
    rows = spark.range(50).selectExpr("CAST(id AS STRING) AS page_id")
    a, b = tables.halves(rows, rows.where("page_id < 20"))
    assert (a.count(), b.count()) == (20, 30)
    shards = [r.s for r in rows.select(tables.shard_of("page_id", 4).alias("s")).collect()]
    assert set(shards) == {0, 1, 2, 3} and shards[7] == int(__import__("hashlib").md5(b"7").hexdigest()[:8], 16) % 4


def test_search_by_post_and_key():
    import io
    import json

    sent = []

    def opener(request):
        sent.append((request.get_method(), request.full_url, dict(request.headers), request.data))
        return io.BytesIO(json.dumps({"data": {"web": [{"title": "T", "url": "", "description": "no url"}, {"title": "T", "url": "http://x", "description": "d"}]}}).encode())

    found = search.http("firecrawl", search.endpoint_for("firecrawl", {"key": "k1"}), opener, **search.FIELDS["firecrawl"])
    assert list(found.results("a b", 5)) == [("T", "http://x", "d", 2, "firecrawl", "a b")]
    method, _, headers, body = sent[0]
    assert method == "POST" and headers["Authorization"] == "Bearer k1" and json.loads(body) == {"query": "a b", "limit": 5}
    request = search.endpoint_for("searxng", {"url": "http://s/", "page": 3}).request("ä b", 5)
    assert request.get_method() == "GET" and request.full_url == "http://s/search?q=%C3%A4+b&format=json&pageno=3"
    assert [p.name for p in search.enabled({"tavily": {"enabled": True, "key": "k"}, "searxng": {"enabled": True, "url": "http://s"}, "ddgs": {"enabled": False}})] == ["searxng", "tavily"]
    with pytest.raises(search.ProviderError):
        search.enabled({"tavily": {"enabled": True}})
    assert search.found_items({"error": "x"}) == [] and search.found_items([{"a": 1}, 2]) == [{"a": 1}]


def test_config_folder(monkeypatch, tmp_path):
    files = {name: {} for name in settings.CONFIG_FILES} | {"search_config": {"max_results_per_query": 4, "providers": {"ddgs": {"url": "u"}}}, "crawler_config": {"max_urls_to_crawl": 7}}
    read = lambda path: files[path.rsplit("/", 1)[1].removesuffix(".yaml")]
    for name in ("TAVILY_API_KEY", "SEARXNG_URL", "DDGS_ENABLED", "MAX_RESULTS_PER_QUERY", "MAX_URLS_TO_CRAWL", "MAX_DISCOVERY_ITERATIONS"):
        monkeypatch.delenv(name, raising=False)
    s = settings.load_dir("c", read)
    assert (s.max_results_per_query, s.max_urls_to_crawl, s.providers) == (4, 7, {"ddgs": {"url": "u"}})
    monkeypatch.setenv("TAVILY_API_KEY", "t")
    monkeypatch.setenv("MAX_RESULTS_PER_QUERY", "9")
    monkeypatch.setenv("MAX_DISCOVERY_ITERATIONS", "2")
    monkeypatch.setenv("DDGS_ENABLED", "yes")
    s = settings.load_dir("c", read)
    assert (s.max_results_per_query, s.max_iterations, s.providers["tavily"]["key"], s.providers["ddgs"]) == (9, 2, "t", {"url": "u", "enabled": True})
    with pytest.raises(FileNotFoundError):
        settings.load_dir(str(tmp_path))
    assert len(settings.ensure_folders(str(tmp_path))) == 7 and (tmp_path / "crawled/html").is_dir()


def test_stage_commands(spark, tmp_path):
    from lorebed import stages

    (tmp_path / "in.csv").write_text("url,normalized_url,domain,title,status\nhttp://A.com/x/,,,T,new\nhttps://a.com/x,,,U,new\n")
    run = lambda name, source, out, *more: stages.main([name, "--in", str(tmp_path / source), "--out", str(tmp_path / out), *more])
    assert run("normalize-urls", "in.csv", "dry", "--dry-run") == 0 and not (tmp_path / "dry").exists()
    assert run("normalize-urls", "in.csv", "a") == 0 and run("deduplicate-urls", "a", "b") == 0
    got = tables.read_csv(spark, str(tmp_path / "b"), ["normalized_url", "domain", "status"]).collect()
    assert sorted((r.normalized_url, r.domain, r.status) for r in got) == [("https://a.com/x", "a.com", "duplicate"), ("https://a.com/x", "a.com", "new")]
    with pytest.raises(SystemExit):
        run("merge-queries", "in.csv", "c", "--iteration", "9")
    with pytest.raises(SystemExit):
        run("followup-queries", "none.csv", "c")


def test_query_and_validation_stages(spark, tmp_path):
    import json

    from lorebed import stages

    run = lambda name, source, out, *more: stages.main([name, "--in", str(tmp_path / source), "--out", str(tmp_path / out), *more])
    (tmp_path / "seed_queries.csv").write_text("query,source_type\nmy query,\n")
    (tmp_path / "seed_companies.csv").write_text("company\nAcme\n")
    (tmp_path / "prior.csv").write_text("query,source_type,iteration,status\nOlder,seed,0,done\nMY QUERY,seed,0,done\n")
    assert run("generate-queries", ".", "q", "--prior", str(tmp_path / "prior.csv")) == 0
    got = tables.read_csv(spark, str(tmp_path / "q"), ["query", "source_type", "iteration", "status"]).orderBy("_ord").collect()
    assert [tuple(r)[:4] for r in got[:2]] == [("Older", "seed", "0", "done"), ("MY QUERY", "seed", "0", "done")] and {r.status for r in got[2:]} == {"new"}
    assert any("Acme" in r.query for r in got) and sum(r.query.casefold() == "my query" for r in got) == 1
    assert run("generate-queries", ".", "q3", "--prior", str(tmp_path / "prior.csv"), "--limit", "3") == 0
    assert [r.query for r in tables.read_csv(spark, str(tmp_path / "q3"), ["query"]).orderBy("_ord").collect()] == [r.query for r in got[:3]]
    (tmp_path / "e.csv").write_text("entity,entity_type\nAcme,company\nMacon,facility\n")
    assert run("followup-queries", "e.csv", "f", "--limit", "2", "--iteration", "1") == 0
    found = tables.read_csv(spark, str(tmp_path / "f"), ["query", "source_type", "iteration", "status"]).orderBy("_ord").collect()
    assert [(r.query, r.source_type, r.iteration, r.status) for r in found] == [('"Acme" "Georgia"', "expansion_company", "1", "new"), ('"Acme" "Georgia" "EV"', "expansion_company", "1", "new")]
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages/p1.json").write_text(json.dumps({"source_url": "u", "page_markdown": "Acme built a plant in Macon."}))
    record = {"page_id": "p1", "source_url": "u", "entity_name": "Acme", "evidence_text": "Acme built a plant", "entity_type": "company", "supply_chain_category": "logistics", "claim_status": "announced", "confidence_score": 0.9}
    (tmp_path / "raw.jsonl").write_text("\n".join(json.dumps(record | more) for more in ({}, {"entity_name": "ACME"}, {"evidence_text": "nothing like it"}, {"page_id": "p2"})))
    (tmp_path / "failed.jsonl").write_text(json.dumps({"page_id": "p0", "failure_stage": "generation"}) + "\n" + json.dumps({"page_id": "p1", "failure_stage": "validation"}))
    for _ in range(2):
        assert run("validate-records", "raw.jsonl", "ok", "--pages", str(tmp_path / "pages"), "--failed", str(tmp_path / "failed.jsonl")) == 0
        assert [r.entity_name for r in spark.read.json(str(tmp_path / "ok")).collect()] == ["Acme"]
        bad = spark.read.json(str(tmp_path / "failed.jsonl")).collect()
        assert sorted(str(r.rejection_reasons) for r in bad) == ["None", "['duplicate_record']", "['unsupported_claim']", "['unsupported_claim']"]
    with pytest.raises(SystemExit):
        run("validate-records", "raw.jsonl", "ok")


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(f"n{i:02}", f"n{i + 1:02}") for i in range(40)] + [("x", "y"), ("z", "z")], "a string, b string")
    assert {r.root for r in graph.connected(chain).collect()} == {"n00", "x"} and graph.connected(chain.limit(0)).count() == 0


def test_first_rows_with_null_keys(spark):
    rows = spark.createDataFrame([(2, None, "a"), (1, None, "b"), (3, "k", "c"), (4, "k", "d")], "_ord int, k string, v string")
    assert sorted((r._ord, r.k, r.v) for r in dedupe.first_of(rows, ["k"], "_ord").collect()) == [(1, None, "b"), (3, "k", "c")]


def test_facts(spark):
    rows = [(0, "https://x.com/1", "Acme", "Acme built a plant.", None), (1, "https://x.com/1", "acme", "Acme  built a plant.", ["old"]), (2, "https://x.com/2", "Acme", "Acme built a plant.", None)]
    df = spark.createDataFrame(rows, "_ord long, source_url string, entity_name string, evidence_text string, rejection_reasons array<string>").withColumn("validation_status", F.lit(""))
    kept, dropped = dedupe.dedupe_facts(df, "_ord")
    assert {r._ord for r in kept.collect()} == {0, 2}
    assert [(r._ord, r.rejection_reasons) for r in dropped.collect()] == [(1, ["old", "duplicate_record"])]


def test_labels(spark):
    df = spark.createDataFrame([(0, "a", "duplicate"), (1, "a", "new"), (2, "", "new"), (3, None, "x"), (4, "b", "crawled")], "_ord long, k string, status string")
    assert {r._ord: r.status for r in dedupe.label_duplicates(df, "k", "_ord").collect()} == {0: "new", 1: "duplicate", 2: "new", 3: "x", 4: "crawled"}


def test_grounding(spark):
    page = "# Georgia Battery Plant\nExample Battery Company announced a $200 million battery materials facility\nin Bryan County, Georgia, creating 350 jobs."
    claims = [
        "Example Battery Company announced a $200 million battery materials facility", "example battery company ANNOUNCED a $200 million\n battery materials facility",
        "Example Battery Company announced a $200 million battery materials facility in Bryan County Georgia creating 350 jobs", "The company opened a gigafactory in Nevada with 5,000 workers.", "",
    ]
    df = spark.createDataFrame([(i, c, page) for i, c in enumerate(claims)], "i long, evidence_text string, page_markdown string")
    assert [r.is_grounded for r in validate.grounded(df).orderBy("i").collect()] == [True, True, True, False, False]


def test_priority_to_status(spark):
    df = spark.createDataFrame([("high",), ("low",), ("skip",), ("",), (None,), ("odd",)], "p string")
    assert [r[0] for r in df.select(frontier.status_for(F.col("p"))).collect()] == ["queued", "needs_review", "rejected", "needs_review", "queued", "needs_review"]


def test_iteration_cap(spark):
    new = spark.createDataFrame([(i, 0, f"q{i % 40}", "s") for i in range(80)], "_ord long, t int, query string, source_type string")
    prior = spark.createDataFrame([("Q1",)], "query string")
    assert [r["query"] for r in discovery.merge_new(new, prior, 1, 5).orderBy("n").collect()] == ["q0", "q2", "q3", "q4", "q5"]
    with pytest.raises(ValueError):
        discovery.merge_new(new, prior, 4)


def test_demotion_keeps_all_sources(spark):
    e = spark.createDataFrame([Row(canonical_name="A", sources=[Row(source_url="u1", evidence_text="good claim"), Row(source_url="u2", evidence_text="zzz qqq")], conflicts_or_uncertainties=None), Row(canonical_name="B", sources=[Row(source_url="u2", evidence_text="none of it")], conflicts_or_uncertainties=["x"])],
                              "canonical_name string, sources array<struct<source_url string, evidence_text string>>, conflicts_or_uncertainties array<string>")
    pages = spark.createDataFrame([("u1", "a good claim here", "p1")], "source_url string, page_markdown string, path string")
    got = {r.canonical_name: r for r in validate.demote_ungrounded(e, pages).collect()}
    assert got["A"].kept and len(got["A"].sources) == 2 and got["A"].conflicts_or_uncertainties == ["Ungrounded sources: u2"]
    assert not got["B"].kept and got["B"].conflicts_or_uncertainties[0] == "x"


def test_components(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 102), (102, 101)], "a long, b long")
    assert {r.node: r.root for r in graph.connected(chain).collect()} == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    assert tables.read_csv(spark, path, ["a", "b"]).count() == 0
    tables.write_csv(spark.createDataFrame([("x\n\"y\"", None, 3)], "a string, b string, z int"), path, ["a", "b", "c"])
    assert [tuple(r) for r in tables.read_csv(spark, path, ["a", "b", "c"]).drop("_ord").collect()] == [("x\n\"y\"", "", "")]


def test_jsonl(spark, tmp_path):
    path = str(tmp_path / "t.jsonl")
    (tmp_path / "t.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n')
    assert [r.a for r in tables.read_jsonl(spark, path, "a int").collect()] == [1, 2]
    (tmp_path / "bad.jsonl").write_text("{oops\n")
    with pytest.raises(Exception):
        tables.read_jsonl(spark, str(tmp_path / "bad.jsonl"), "a int").collect()


def test_markdown(spark):
    page = '---\ntitle: "SK Battery"\nentity_type: company\nsupply_chain_category: battery_materials\npage_id: page_000001\npublication_date: \nsource_url: https://x.com/\ngenerated_from: given\n---\n\n# SK Battery\n\n**Source:** [two\nlines](https://x.com/)\n\n## Facts\n- one\n- two\n\n## Links\n- a — b\n'
    r = tables.parse_markdown(spark.createDataFrame([(page,)], "value string")).first()
    assert (r.title, r.page_id, r.publication_date, r.facts, r.links) == ("SK Battery", "page_000001", "", ["one", "two"], ["a — b"])


def test_search_ranks_have_gaps(spark):
    fixture = [{"title": "a", "url": "u1", "snippet": "s"}, {"title": "b", "url": ""}, {"title": "c", "url": "u3"}]
    got = search.search(spark.createDataFrame([("q",)], "query string"), search.enabled({}, fixture)).collect()
    assert [(r.url, r.rank) for r in got] == [("u1", 1), ("u3", 3)]
    with pytest.raises(search.ProviderError):
        search.enabled({})


def test_settings(monkeypatch):
    monkeypatch.setenv("SEARCH_MOCK", " Yes ")
    monkeypatch.setenv("SEARXNG_URL", "http://s/")
    s = settings.load({"max_urls_to_crawl": 5})
    assert s.search_mock and s.searxng_url == "http://s" and s.max_urls_to_crawl == 5


def test_finetuning(spark):
    schema = "_ord long, canonical_name string, overview string, sources array<struct<source_url string>>, locations array<string>, currency string, publication_date_range string"
    df = spark.createDataFrame([(0, "A", " o ", [("u",)], ["L"], "stale", "2020"), (1, "B", "", [("u",)], None, "", ""), (2, "C", "c", [("",)], None, "", ""), (3, "D", "d", [("",), ("v",)], None, "fresh", "")], schema)
    got = {(r._ord, r.k): r.output for r in export.finetuning(df).collect()}
    assert got == {(0, 0): "o (as of 2020; currency: stale) Source: u", (0, 1): "A operates in L based on the sources. (as of 2020; currency: stale) Source: u", (3, 0): "d Source: v"}


def test_final_wiki_of_partial_entities(spark):
    r = export.final_wiki(spark.createDataFrame([("A", ["x"], None, 0)], "canonical_name string, aliases array<string>, sources array<string>, source_count int")).first()
    assert (r.aliases, r.sources, r.source_count, r.overview) == ('["x"]', "[]", 0, "")


def test_stream_merges_until_done(spark, tmp_path):
    cols = "_ord long, url string, normalized_url string, domain string, priority string, source_type string, query_used string, discovered_date string, notes string"
    for k in range(3):
        spark.createDataFrame([(k, f"u{k % 2}", f"u{k % 2}", "d", "high", "s", "", "2024", "")], cols).coalesce(1).write.parquet(str(tmp_path / f"in/part{k}"))
    schema = spark.read.parquet(str(tmp_path / "in/part0")).schema
    done = stream.run_until_done(spark, str(tmp_path / "in/*"), schema, str(tmp_path / "out"), str(tmp_path / "ck"), files_per_batch=1)
    assert {r.normalized_url for r in done.collect()} == {"u0", "u1"} and done.columns == FRONTIER_COLUMNS


def test_a_streamed_batch_writes_what_it_changes(spark, tmp_path):
    """Three runs equal three upserts; a batch that runs again after a crash changes nothing."""
    import shutil

    schema = "_ord long, url string, normalized_url string, domain string, priority string, source_type string, query_used string, discovered_date string, notes string"
    rng = random.Random(8)
    known = None
    for k in range(3):
        rows = [(i, f"http://u{n}", f"u{n}", "d", rng.choice(["high", "low", None]), f"s{k}", "", "2024", "") for i, n in enumerate(rng.choices(range(30 if k < 2 else 8), k=25))]
        batch = spark.createDataFrame(rows, schema)
        batch.coalesce(1).write.parquet(str(tmp_path / f"in/part{k}"))
        done = stream.run_until_done(spark, str(tmp_path / "in/*"), schema, str(tmp_path / "out"), str(tmp_path / "ck"))
        made = frontier.from_candidates(batch, "_ord")
        merged = [r.asDict() for r in frontier.upsert(made.drop("_ord").limit(0) if known is None else spark.createDataFrame(known, done.schema), made).collect()]
        known = [tuple(r[c] for c in FRONTIER_COLUMNS) for r in merged]
        assert sorted(map(str, known)) == sorted(str(tuple(r)) for r in done.select(*FRONTIER_COLUMNS).collect())
    written = [spark.read.parquet(str(tmp_path / f"out/batch={k}")).count() for k in range(3)]
    assert written[2] <= 8
    # The last batch's commit is lost, and so it runs again.
    shutil.rmtree(tmp_path / "out/batch=2")
    (tmp_path / "ck/commits/2").unlink()
    (tmp_path / "ck/commits/.2.crc").unlink(missing_ok=True)
    again = stream.run_until_done(spark, str(tmp_path / "in/*"), schema, str(tmp_path / "out"), str(tmp_path / "ck"))
    assert sorted(map(str, known)) == sorted(str(tuple(r)) for r in again.select(*FRONTIER_COLUMNS).collect())


def test_mock_extraction_to_validation(spark):
    from lorebed.operators import extract

    pages = [("p1", "# T\n\nMOCK_ENTITY: Example Battery\n\nExample Battery announced a plant.\n"), ("p2", "# T\n\nMOCK_EMPTY\n"), ("p3", "MOCK_ENTITY: Warp\nMOCK_BAD_ENUM\n\nWarp announced.")]
    df = spark.createDataFrame([(k, "https://x.com/", t) for k, t in pages], "page_id string, source_url string, page_markdown string")
    got = {r.page_id: (r.validation_status, list(r.rejection_reasons)) for r in validate.validate(extract.mock_records(df), df).collect()}
    assert got == {"p1": ("passed", []), "p3": ("failed", ["invalid_entity_type", "invalid_category"])}


def test_languages_by_profiles_held_out(spark):
    from compare import SMALL

    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("length(text) >= 40")
    known = languages.profiles(docs.where("doc_id % 2 = 0"))
    found = languages.detect(docs.where("doc_id % 2 = 1"), known).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.language == r.lang for r in found) >= 0.95 * len(found) > 60
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !!"), (4, "x" * 300_000), (5, "日本語")], "doc_id long, text string")
    assert {r.doc_id: r.language for r in languages.detect(odd, known).collect()}.items() >= {1: "unknown", 2: "unknown", 3: "unknown", 5: "unknown"}.items()
    assert languages.detect(odd.limit(0), known).collect() == []


def test_grams_of_a_text_are_ranked_where_it_lies(spark):
    from compare import SMALL

    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("doc_id % 4 = 0").select("doc_id", "text")
    odd = [(-1, None), (-2, ""), (-3, "1 2"), (-4, "x" * 100 + " É𝒜b𝒜 日本 a"), (-5, "abab bab " * 40), (-6, "Straße straẞe ΣΑΣ İi")]
    docs = docs.unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    for size in (5, 300):
        want = languages._ranked(docs, "doc_id", "text", size)
        assert sorted(map(tuple, languages._ranked_alone(docs, "doc_id", "text", size).where("gram <> ''").collect())) == sorted(map(tuple, want.collect()))
    known = languages.profiles(docs.withColumn("lang", F.lit("en")))
    plan = languages.detect(docs, known)._jdf.queryExecution().executedPlan().toString()
    # Each text's words and grams went through three exchanges before, several times the text.
    assert "Window" not in plan and not any("Exchange" in line and ("word#" in line or "gram#" in line) for line in plan.splitlines() if "Broadcast" not in line)


def test_language_by_words(spark):
    from lorebed.functions.language import detect_language

    rows = spark.createDataFrame([(0, "the cat and the dog"), (1, "der Hund und die Katze"), (2, None), (3, "zzz")], "i long, t string")
    assert [r[0] for r in rows.orderBy("i").select(detect_language(F.col("t"))).collect()] == ["en", "de", "unknown", "unknown"]
