"""Queries of validation on a small fixture whose evidence is close to its page, against brute force."""

from __future__ import annotations

import random
from collections import Counter

import pandas as pd
import pytest

from lorebed.functions import fuzzy
from lorebed.plans.queries import QUERIES

PAGES = {
    1: "acme opened a battery plant in bryan county last year",
    2: "the company builds a second line for copper foil in macon",
    3: "Note:  the company built a second line for copper foil in macon, with 90 jobs.\nmore text",
    5: "sk makes cells in commerce and hires two hundred people",
    6: "nothing of the kind is on this page, which is about peaches",
    8: "the port of savannah grows its yard by forty acres",
    9: "Reports say the port of savannah grew its yards by forty acres.",
}


def ratio(a: str, b: str) -> float:
    row = [0] * (len(b) + 1)
    for x in a:
        last, row = row, [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
    return 200 * row[-1] / (len(a) + len(b))


def is_grounded(claim: str, page: str) -> bool:
    claim, page = (" ".join(t.split()).lower() for t in (claim, page))
    n = len(claim)
    return claim in page or any(ratio(claim, page[max(0, i) : i + n]) >= 85 for i in range(1 - n, len(page)) if page[max(0, i) : i + n])


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("fuzzy"))
    rows = [(k, t, "en", "web", 800) for k, t in PAGES.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{out}/documents.parquet")
    turns = [(1, 0, "user", "the plant makes battery cells every day"), (1, 0, "user", "the plant made battery cells every day"), (2, 0, "user", "a plain claim")]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").write.parquet(f"{out}/conversations.parquet")
    return out


def claims() -> list[tuple]:
    """(page, document, line, claim): two of three documents are about their own page, the second of them about the next page too."""
    out = []
    for k, text in PAGES.items():
        for page in {0: [], 1: [k], 2: [k, k + 1]}[k % 3]:
            out += [(page, k, i, claim) for i, claim in enumerate(text.split("\n"))]
    return out


@pytest.fixture(scope="module")
def unsupported():
    """Claims that their page doesn't bear out; a page that isn't there bears out none."""
    return {c[:3] for c in claims() if not is_grounded(c[3], PAGES.get(c[0], "")) and (c[1] + c[2]) % 7 != 3}


def at(row) -> tuple:
    """(page, document, line) from the row's number."""
    whole, line = divmod(row._ord, 10**6)
    page = whole // 2
    return page, page - (whole - 2 * page), line


def test_brute_force_tells_paraphrases(unsupported):
    assert {(3, 2, 0), (9, 8, 0)} & {c[:3] for c in claims()} and not {(3, 2, 0), (9, 8, 0)} & unsupported and (6, 5, 0) in unsupported


def test_reasons(spark, data, unsupported):
    rows = QUERIES["record_validate_reasons"](spark, data).collect()
    assert sorted(map(at, rows)) == sorted(c[:3] for c in claims())
    assert {at(r) for r in rows if "unsupported_claim" in r.reasons} == unsupported


def test_counts_and_totals(spark, data, unsupported):
    rows = QUERIES["record_validate_reasons"](spark, data).collect()
    counts = {tuple(r)[0]: tuple(r)[1] for r in QUERIES["reasons_explode_counts"](spark, data).collect()}
    assert counts["unsupported_claim"] == len(unsupported) and counts == Counter(x for r in rows for x in r.reasons.split(";") if x)
    # By the fixture's numbers: document and line together tell what is wrong with the fields.
    failed = unsupported | {c[:3] for c in claims() if (c[1] + c[2]) % 7 in (3, 5, 6) or (c[1] + c[2]) % 14 == 13}
    totals = QUERIES["validation_totals"](spark, data).first()
    assert (totals.passed, totals.failed, totals.records) == (len(claims()) - len(failed), len(failed), len(claims()))
    assert {int(r.page_id[5:]) for r in QUERIES["bag_union"](spark, data).where("status = 'failed'").collect()} == {c[0] for c in failed}


def test_demotion(spark, data):
    assert {r.canonical_name: (r.kept, r.notes) for r in QUERIES["entity_demotion"](spark, data).collect()} == {"Entity 1": (True, ""), "Entity 2": (True, "")}


def test_few_claims_are_compared(monkeypatch):
    rnd = random.Random(7)
    words = ["".join(rnd.choices("etaoinshrdluéß", k=rnd.randint(2, 9))) for _ in range(300)]
    prose = lambda n: " ".join(rnd.choices(words, k=n))
    pages, claims = [prose(rnd.choice([20, 200, 900])) for _ in range(60)], []
    for k in range(480):
        page = pages[k % 60]
        at, claim = rnd.randrange(len(page)), list(prose(rnd.choice([8, 30, 60])))
        if k % 6 == 0:
            # Close to the page, on either side of the threshold, and also over its ends.
            claim = list(page[at : at + rnd.choice([40, 64, 65, 200])])
            for _ in range(int(len(claim) * rnd.choice([0.05, 0.12, 0.15, 0.2, 0.3]))):
                i = rnd.randrange(len(claim))
                claim[i : i + rnd.choice([0, 1])] = rnd.choice(["", "x", "qz"])
                claim = claim or ["x"]
        claims.append("".join(claim))
    claims[1], claims[2] = None, pages[2] * 2
    pages = [pages[k % 60] for k in range(480)]
    want = [a is not None and fuzzy.partial_ratio(a, b, 85) >= 85 for a, b in zip(claims, pages)]
    compared, exact = [], fuzzy.partial_ratio
    monkeypatch.setattr(fuzzy, "partial_ratio", lambda a, b, cutoff: compared.append(a) or exact(a, b, cutoff))
    got = fuzzy.partial_at_least(85).func(pd.Series(claims), pd.Series(pages))
    assert got.tolist() == want and sum(want) > 20
    # All 479 were compared before.
    assert len(compared) < 120
    assert fuzzy.partial_at_least(40).func(pd.Series(["ab", None]), pd.Series(["b", "c"])).tolist() == [True, False] and fuzzy.partial_at_least(85).func(pd.Series([], dtype=object), pd.Series([], dtype=object)).empty
