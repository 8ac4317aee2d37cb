"""Directory batches, requests for sources, versions, ranks and the lifecycle stream against plain loops."""

import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.functions import websites
from millrace.operators import directory, ranks, registry
from millrace.operators.components import connected
from millrace.sources.versions import Conflict, Versions, shared_folder
from millrace.streaming import lifecycle


@pytest.mark.parametrize(
    "name,website,want",
    [
        ("Acme", "acme.com", "https://acme.com"),
        ("Acme", " HTTPS://www.Acme.com/about?x=1 ", "HTTPS://www.Acme.com/about?x=1"),
        ("Acme", "http://acme.com:8080", "http://acme.com:8080"),
        ("Acme", "http://acme.com:0", None),
        ("Acme", "http://acme.com:70000", None),
        ("Acme", "http://acme.com:", None),
        ("Acme", "http://me@acme.com", None),
        ("Acme", "http://acme.com.", None),
        ("Acme", "http://acme", None),
        ("Acme", "http://10 .com", None),
        ("Acme", "http://a.com http://b.com", None),
        ("Acme", "http://a.com/?u=http://b.com", None),
        ("Acme", "ftp://acme.com", None),
        ("Acme", "http://-acme.com", None),
        ("Acme", "", None),
        ("Acme", None, None),
        ("GitHub", "https://github.com/", "https://github.com/"),
        ("GitHub", "https://www.github.com", "https://www.github.com"),
        ("GitHub", "https://github.com/about", None),
        ("Acme", "https://github.com", None),
        ("Acme", "https://acme.github.com", None),
        ("Acme", "https://notgithub.com", "https://notgithub.com"),
        ("Product  Hunt", "producthunt.com", "https://producthunt.com"),
    ],
)
def test_company_website(spark, name, website, want):
    rows = spark.createDataFrame([(name, website)], "name string, website string")
    assert rows.select(websites.company_website(F.col("name"), F.col("website"))).first()[0] == want


@pytest.mark.parametrize(
    "name,domain,want",
    [
        ("Acme Inc", "acme.com", True),
        ("Acme, Inc.", "getacme.io", True),
        ("Inc", "inc.com", True),
        ("Acme Labs", "acmelabs.dev", True),
        ("Acme Labs", "acme.dev", False),
        ("Blue Bird LLC", "ridewithbluebird.com", True),
        ("Acme", "theacme.com", False),
        ("!!!", "acme.com", False),
        (None, "acme.com", False),
    ],
)
def test_name_fits_domain(spark, name, domain, want):
    rows = spark.createDataFrame([(name, domain)], "name string, domain string")
    assert rows.select(websites.name_fits_domain(F.col("name"), F.col("domain"))).first()[0] is want


def test_ranks_and_ranks_within_keys(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["hot", "hot", "a", "b", None]), rng.random(), k) for k in range(500)]
    table = spark.createDataFrame(rows, "k string, x double, n int").repartition(7)
    got = {r.n: r["rank"] for r in ranks.numbered(table, [F.desc("x"), F.col("n")]).collect()}
    assert [n for n, _ in sorted(got.items(), key=lambda i: i[1])] == [n for _, _, n in sorted(rows, key=lambda r: (-r[1], r[2]))]
    within = {r.n: r["rank"] for r in ranks.numbered_within(table, ["k"], [F.col("x"), F.col("n")]).collect()}
    for key in ("hot", "a", "b", None):
        own = [n for k, _, n in sorted(rows, key=lambda r: (r[1], r[2])) if k == key]
        assert [within[n] for n in own] == list(range(1, len(own) + 1))
    assert ranks.numbered(table.limit(0), [F.col("n")]).collect() == []
    plan = ranks.numbered(table, [F.col("n")])._jdf.queryExecution().toString()
    assert "Window" not in plan


def test_connected(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000, k) for k in range(1001, 1200)] + [(k, k + 1) for k in range(2000, 2100)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        if u != v:
            a, b = sorted((root(u), root(v)))
            parent[b] = a
    got = {r.node: r.component for r in connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: root(x) for u, v in edges if u != v for x in (u, v)}


def test_versions(spark):
    versions = Versions(spark, shared_folder(spark, "versions"))
    a, b = spark.range(3), spark.range(5)
    assert versions.latest() == 0 and versions.read() == {}
    assert versions.commit({"a": a, "b": b}) == 1
    assert versions.commit({"a": b}) == 2
    assert {k: v.count() for k, v in versions.read().items()} == {"a": 5, "b": 5}
    assert {k: v.count() for k, v in versions.read(1).items()} == {"a": 3, "b": 5}
    with pytest.raises(Conflict):
        versions.commit({"a": a}, expected=1)
    with pytest.raises(Conflict):
        versions.publish(2, {})
    with pytest.raises(Exception):  # a table fails: nothing is published
        versions.commit({"a": a, "b": b.select(F.raise_error(F.lit("no")).alias("x"), "id")})
    assert versions.latest() == 2 and versions.read()["a"].count() == 5


# The directory.


def plain_domain(website):
    return re.sub(r"^www\.", "", re.match(r"https?://([^/:]+)", website).group(1)) if website else None


def plain_upsert(batch, companies, sources):
    """The rules in the batch's order, with one row after another."""
    claims = {}
    rows = []
    for position, ext, name, website, slug in sorted(batch):
        site = website.strip() if website else None
        rows.append(dict(position=position, ext=ext, name=name, site=site, slug=slug, asked=plain_domain(site)))
        if site:
            claims.setdefault(rows[-1]["asked"], []).append(rows[-1])
    for domain, own in claims.items():
        fits = [r for r in own if re.sub("[^a-z0-9]", "", r["name"].lower()) == domain.split(".")[0]]
        for r in own:
            if len(own) > 1 and not (len(fits) == 1 and r is fits[0]):
                r["site"] = None
    now = {c["id"]: dict(c) for c in companies}
    owner, out = dict(sources), []
    for r in rows:
        domain, folded = plain_domain(r["site"]), " ".join(r["name"].lower().split())
        found, action = owner.get(r["ext"]), "updated"
        if found is None and domain:
            alike = [c for c in now.values() if c["domain"] == domain and c["folded"] == folded]
            if len(alike) == 1 and alike[0]["id"] not in owner.values():
                found, action = alike[0]["id"], "matched"
        refused = r["asked"] is not None and domain is None
        if domain and any(c["domain"] == domain and c["id"] != found for c in now.values()):
            refused, r["site"] = True, None
        if found is None:
            found, action = max(now, default=0) + 1, "created"
            taken = {c["slug"] for c in now.values()}
            base = r["slug"].strip().lower() or f"dir-{r['ext']}"
            names = [base, f"{base}-dir-{r['ext']}", *(f"{base}-dir-{r['ext']}-{k}" for k in range(2, 9))]
            now[found] = dict(id=found, slug=next(s for s in names if s not in taken), website=None)
        c = now[found]
        c.update(name=r["name"], folded=folded, website=r["site"] or c["website"])
        c["domain"] = plain_domain(c["website"])
        owner[r["ext"]] = found
        out.append((r["position"], action, found, c["website"], refused))
    return out, {c["id"]: (c["folded"], c["slug"], c["website"], c["domain"]) for c in now.values()}, owner


@pytest.mark.parametrize("seed", range(8))
def test_directory_is_folded_in_order(spark, seed):
    rng = random.Random(seed)
    domains = [f"d{k}.example" for k in range(12)]
    names = ["Ann", "Bob", "Cy", "D3"]
    site = lambda: rng.choice([None, f"https://{rng.choice(domains)}", f"https://www.{rng.choice(domains)}/x"])
    companies = []
    for k in range(1, 15):
        website, name = site(), rng.choice(names)
        companies.append(dict(id=k, name=name, folded=name.lower(), slug=rng.choice([f"s{k}", f"c{k}"]), website=website, domain=plain_domain(website)))
    known = {f"e{k}": k for k in range(1, 15) if rng.random() < 0.5}
    batch = []
    for p in range(rng.randint(10, 20)):
        ext = f"e{rng.randint(1, 24)}" if rng.random() < 0.7 else f"x{p}"
        batch.append((p * 3, ext, rng.choice(names), site(), rng.choice(["c1", "c2", "S3 ", "", f"n{p}"])))
    table = spark.createDataFrame([(c["id"], c["name"], c["folded"], c["slug"], c["website"], c["domain"], "provisional") for c in companies], directory.COMPANIES)
    sources = [(c, "dir", e, "", "active", None) for e, c in known.items()] + [(1, "other", "e20", "", "active", None)]
    got = directory.upsert(spark.createDataFrame(batch, "position long, external_id string, name string, website string, slug string").repartition(4), table, spark.createDataFrame(sources, directory.SOURCES), "dir", "u/")
    decisions, want, owner = plain_upsert(batch, companies, known)
    rows = got["decisions"].select("position", "action", "company_id", "website", F.col("claimed_domain").isNotNull()).collect()
    assert sorted(map(tuple, rows)) == decisions
    assert {r.company_id: (r.normalized_name, r.slug, r.website, r.primary_domain) for r in got["companies"].collect()} == want
    assert {(r.provider, r.external_id): r.company_id for r in got["sources"].collect()} == {("dir", e): c for e, c in owner.items()} | {("other", "e20"): 1}


def test_directory_without_rows(spark):
    companies, sources = spark.createDataFrame([], directory.COMPANIES), spark.createDataFrame([], directory.SOURCES)
    batch = spark.createDataFrame([], "position long, external_id string, name string, website string, slug string")
    assert all(t.collect() == [] for t in directory.upsert(batch, companies, sources, "dir", "u/").values())


# Requests.


def plain_requests(stored, requests, companies, running):
    now, out = {(s[2], s[3]): dict(id=s[0], owner=s[1], status=s[7], v=s[8]) for s in stored}, []
    for no, action, provider, ext, company, expected, version, *_, reason in sorted(requests):
        key, outcome = ((provider or "").strip().lower(), (ext or "").strip()), None
        s = now.get(key)
        if not key[0] or not key[1]:
            outcome = "blank_identity"
        elif action != "register" and not (reason or "").strip():
            outcome = "no_reason"
        elif action != "register" and not (expected and expected > 0):
            outcome = "no_expected_owner"
        elif action == "reassign" and company is None:
            outcome = "no_target"
        elif action == "register" and company not in companies:
            outcome = "unknown_company"
        elif action == "register" and s is None:
            outcome = "created"
            s = now[key] = dict(id=None, owner=company, status="active", v=1)
        elif action == "register":
            outcome = "updated" if s["owner"] == company else "owner_differs"
        elif s is None:
            outcome = "unknown_source"
        elif s["owner"] != expected:
            outcome = "owner_differs"
        elif version is not None and version != s["v"]:
            outcome = "version_differs"
        elif s["id"] in running:
            outcome = "runs_in_progress"
        elif expected not in companies:
            outcome = "unknown_company"
        elif action == "disable":
            outcome = "already_disabled" if s["status"] == "disabled" else "disabled"
        elif company not in companies:
            outcome = "unknown_target"
        else:
            outcome = "same_owner" if company == s["owner"] else "reassigned"
        if outcome == "disabled":
            s["status"] = "disabled"
        if outcome == "reassigned":
            s["owner"] = company
        if outcome in ("updated", "disabled", "reassigned"):
            s["v"] += 1
        out.append((no, outcome))
    return out, {k: (s["owner"], s["status"], s["v"]) for k, s in now.items()}


@pytest.mark.parametrize("seed", range(4))
def test_requests_for_one_source_follow_each_other(spark, seed):
    rng = random.Random(seed)
    stored = [(k, rng.randint(1, 4), "p", f"b{k}", "board", None, "observation", rng.choice(["active", "disabled"]), 1) for k in range(1, 6)]
    requests = []
    for no in range(120):
        action = rng.choice(["register", "reassign", "reassign", "disable"])
        ext = rng.choice([f"b{rng.randint(1, 8)}"] * 12 + [" b1 ", "", None])
        requests.append((no, action, rng.choice(["p", " P "]), ext, rng.choice([1, 2, 3, 4, 4, 9, None]), rng.choice([1, 2, 3, 4, 0, None, 9]), rng.choice([None, None, 1, 2]), "board", f"u{no}", "observation", rng.choice(["why", "why", " "])))
    found, outcomes = registry.apply_requests(
        spark.createDataFrame(stored, registry.SOURCES), spark.createDataFrame(requests, registry.REQUESTS).repartition(5), spark.createDataFrame([(k,) for k in (1, 2, 3, 4)], "company_id long"), spark.createDataFrame([(3,)], "source_id long")
    )
    want, state = plain_requests(stored, requests, {1, 2, 3, 4}, {3})
    assert sorted((r.request_no, r.outcome) for r in outcomes.collect()) == want
    rows = found.collect()
    assert {(r.provider, r.external_id): (r.company_id, r.status, r.version) for r in rows} == state
    assert sorted(r.source_id for r in rows) == list(range(1, len(rows) + 1))


def test_requests_that_make_no_sense(spark):
    requests = [(1, "merge", "p", "b", 1, 1, None, None, None, "observation", "x"), (2, "register", "p", "b", 1, None, None, None, None, "sometimes", None), (3, None, "p", "b", 1, 1, None, None, None, None, "x")]
    _, outcomes = registry.apply_requests(spark.createDataFrame([], registry.SOURCES), spark.createDataFrame(requests, registry.REQUESTS), spark.range(1, 3).toDF("company_id"), spark.createDataFrame([], "source_id long"))
    assert sorted((r.request_no, r.outcome) for r in outcomes.collect()) == [(1, "unknown_action"), (2, "unsupported_sync_mode"), (3, "unknown_action")]


# The stream.


def plain_lifecycle(runs):
    """runs: source -> list of (complete, {job: hash}) in order; counters by (source, run), and jobs."""
    counters, jobs = {}, {}
    for source, own in runs.items():
        state = {}
        for n, (complete, seen) in enumerate(own, 1):
            c = dict.fromkeys(lifecycle.COUNTERS, 0)
            if complete:
                for job, digest in seen.items():
                    if job not in state:
                        c["jobs_added"] += 1
                    else:
                        c["jobs_unchanged" if state[job][0] == digest else "jobs_updated"] += 1
                        c["jobs_reactivated"] += state[job][2] == "closed"
                    state[job] = (digest, 0, "active")
                for job, (digest, misses, status) in list(state.items()):
                    if job not in seen:
                        c["jobs_missed"] += 1
                        if status == "active":
                            closes = misses + 1 >= 2
                            c["jobs_closed"] += closes
                            state[job] = (digest, misses + 1, "closed" if closes else "active")
            counters[source, n] = tuple(c.values())
        jobs |= {(source, j): s for j, s in state.items()}
    return counters, jobs


def stream(spark, parts, files_a_batch=1000):
    """Each part's rows as files, each taken up by a run of its own; the changes after the last."""
    folder = shared_folder(spark, "stream")
    for rows in parts:
        table = spark.createDataFrame(rows, lifecycle.INPUT)
        lifecycle.append(table, f"{folder}/rows", 2)
        lifecycle.run_once(spark, f"{folder}/rows", f"{folder}/changes", f"{folder}/checkpoint", buckets=3, files_a_batch=files_a_batch)
    return spark.read.schema(lifecycle.OUTPUT).parquet(f"{folder}/changes")


def test_stream_equals_the_rules_whatever_the_order(spark):
    rng = random.Random(7)
    runs = {s: [(rng.random() > 0.2, {f"j{j}": f"h{rng.randint(0, 2)}" for j in range(12) if rng.random() > 0.4}) for _ in range(9)] for s in ("a", "b")}
    runs["a"][4] = (True, {})  # an empty complete snapshot is a miss for all
    rows = [(s, n, None, None, c) for s, own in runs.items() for n, (c, _) in enumerate(own, 1)]
    rows += [(s, n, j, h, None) for s, own in runs.items() for n, (_, seen) in enumerate(own, 1) for j, h in seen.items()]
    # Rows of later runs come before their turn, but each run's own row only after its postings.
    rng.shuffle(rows)
    rows.sort(key=lambda r: r[2] is None)
    cuts = [0, 25, 60, len(rows) - 5, len(rows)]
    changes = stream(spark, [rows[a:b] for a, b in zip(cuts, cuts[1:])], files_a_batch=1)
    counters, jobs = plain_lifecycle(runs)
    assert {(r[0], r[1]): tuple(r)[2:] for r in lifecycle.run_counters(changes).collect()} == counters
    got = {(r.source_id, r.external_job_id): (r.content_hash, r.misses, r.status) for r in lifecycle.current_jobs(changes).collect()}
    assert got == jobs


def test_stream_holds_a_run_until_its_turn_and_refuses_late_rows(spark):
    first = [("a", 2, None, None, True), ("a", 2, "x", "h", None)]
    second = [("a", 1, None, None, True), ("a", 1, "y", "h", None)]
    third = [("a", 1, "z", "h", None), ("a", 3, None, None, False), ("a", 3, "y", "h9", None)]
    assert stream(spark, [first]).collect() == []
    changes = stream(spark, [first, second, third])
    assert {r.run_no: tuple(r)[2:] for r in lifecycle.run_counters(changes).collect()} == {1: (1, 0, 0, 0, 0, 0), 2: (1, 0, 0, 1, 0, 0), 3: (0, 0, 0, 0, 0, 0)}
    assert [(r.run_no, r.external_job_id) for r in changes.where("kind = 'late'").collect()] == [(1, "z")]
    assert sorted((r.external_job_id, r.misses, r.status) for r in lifecycle.current_jobs(changes).collect()) == [("x", 0, "active"), ("y", 1, "active")]


class Calls:
    """A state of its own in memory, which counts the calls that reach it."""

    def __init__(self):
        self.value, self.rows, self.n = None, {}, 0

    def getValueState(self, *_):
        return Calls.__new__(Calls)._like(self)

    getMapState = getValueState

    def _like(self, parent):
        self.value, self.rows, self.parent = None, {}, parent
        return self

    def _called(self):
        self.parent.n += 1

    def get(self):
        self._called()
        return self.value

    def update(self, value):
        self._called()
        self.value = value

    def getValue(self, key):
        self._called()
        return self.rows.get(key)

    def updateValue(self, key, value):
        self._called()
        self.rows[key] = value

    def removeKey(self, key):
        self._called()
        del self.rows[key]

    def iterator(self):
        self._called()
        return iter(list(self.rows.items()))

    def keys(self):
        self._called()
        return iter(list(self.rows))


def test_stream_calls_its_state_by_parts_not_by_postings():
    """Runs whose postings wait for them: what a micro-batch calls does not grow with its postings."""
    import pandas as pd

    counts, made = [], []
    for n in (3000, 12000):
        handle, process = Calls(), lifecycle.Lifecycle()
        process.init(handle)
        columns = [c.split()[0] for c in lifecycle.INPUT.split(", ")]
        for run in (1, 2):
            seen = pd.DataFrame([("a", run, f"j{k}", f"h{k % run}", None) for k in range(n)], columns=columns)
            assert list(process.handleInputRows(("a", 0), iter([seen]), None)) == []
            own = pd.DataFrame([("a", run, None, None, True)], columns=columns)
            found = pd.concat(process.handleInputRows(("a", 0), iter([own]), None))
        made.append(tuple(found[found.kind == "run"][list(lifecycle.COUNTERS)].iloc[0]))
        counts.append(handle.n)
    assert made == [(0, 1500, 1500, 0, 0, 0), (0, 6000, 6000, 0, 0, 0)]
    assert counts[0] == counts[1] < 6 * lifecycle.PARTS


def test_website_patterns_are_not_repeated_for_each_host():
    """An expression is worked out wherever it stands: before, there were 185 patterns in the one and 121 in the other."""
    name, website = F.col("name"), F.col("website")
    for made, most in ((websites.company_website(name, website), 60), (websites.name_fits_domain(name, website), 60)):
        assert str(made).lower().count("regexp") < most
