"""Selection over all rows by a plain loop and over the short list."""

import random
from datetime import datetime, timedelta

import pytest

from millrace.operators import selection

PREVIEWS = "stratum string, job_id long, title string, company string, hybrid boolean, employment array<string>, seniority string, role_status string, score double, posted_at timestamp"


def made(seed, n):
    rng = random.Random(seed)
    companies = ["hot"] * 30 + [f"c{k}" for k in range(25)]
    rows = []
    for k in range(n):
        row = (k, "Engineer", rng.choice(companies), None, ["Full_Time"], rng.choice(["senior", "staff", "staff", "mid_level", None]), "strong", float(rng.randint(0, 20)), datetime(2024, 1, 1) + timedelta(days=rng.randint(0, 9)))
        for s in rng.sample(["a", "b", "c"], rng.choice([1, 1, 2])):
            rows.append((s, *row))
    return rows


@pytest.mark.parametrize("seed,n,budget,reserve", [(1, 400, 12, 8), (2, 60, 20, 10), (3, 900, 7, 30), (4, 15, 20, 5), (5, 500, 25, 0)])
def test_short_list_is_enough(spark, seed, n, budget, reserve):
    rows = made(seed, n)
    quotas = {"b": budget // 2, "a": budget // 3, "c": budget - budget // 2 - budget // 3}
    found = selection.candidates(spark.createDataFrame(rows, PREVIEWS).repartition(3)).cache()
    whole = sorted((r.asDict() for r in found.collect()), key=lambda r: (-r["score"], -r["posted_at"].timestamp(), r["job_id"]))
    want = selection.choose(whole, quotas, budget, reserve)
    got = [tuple(r) for r in selection.select(found, quotas, budget, reserve).collect()]
    assert sorted(got) == sorted(want)
    picked = [w for w in want if w[1] == "selected"]
    by = {r["job_id"]: r for r in whole}
    assert len(picked) <= budget and sum(by[w[0]]["staff"] for w in picked) <= max(1, int(budget * 0.15))
    assert len({w[0] for w in want}) == len(want)


def test_candidates(spark):
    at = datetime(2024, 1, 1)
    base = ("a", 1, "Engineer", " c ", False, ["full_time"], "senior", "strong", 5.0, at)
    change = lambda **kw: tuple({**dict(zip([c.split()[0] for c in PREVIEWS.split(", ")], base)), **kw}.values())
    rows = [base, change(stratum="b", score=7.0), change(job_id=2, hybrid=True), change(job_id=3, employment=["full_time", "contract"]), change(job_id=4, title=" "), change(job_id=5, company=None), change(job_id=6, role_status="exclude")]
    rows += [change(job_id=7, role_status="weak", seniority="junior"), change(job_id=8, role_status="weak", seniority="Staff"), change(job_id=9), change(job_id=10, title="Sales Engineer"), change(job_id=11, employment=None), change(job_id=None)]
    found = selection.candidates(spark.createDataFrame(rows, PREVIEWS), spark.createDataFrame([(9,), (9,)], "job_id long"), r"\bsales\b")
    got = {r.job_id: (r.company, r.staff, r.score, r.strata) for r in found.collect()}
    assert got == {1: ("c", False, 7.0, ["a", "b"]), 8: ("c", True, 5.0, ["a"]), 11: ("c", False, 5.0, ["a"])}
    assert selection.select(found.limit(0), {"a": 1}, 1, 1).collect() == []
