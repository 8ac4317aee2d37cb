"""Remote eligibility: each rule on own texts, the order of rules, vetoes, bounded lists, and the operator's edge cases."""

from pyspark.sql import functions as F

from millrace.operators import eligibility

US = "Must be a U.S. citizen."
CASES = [
    # status, title, location, description, evidence
    ("remote_unclear", "Engineer", "Remote", None, {}),
    ("global_explicit", "Engineer", "Worldwide Remote", None, {}),
    ("global_explicit", "Engineer", "Lisbon; Remote - Anywhere", None, {}),
    ("restricted_remote", "Engineer", "Remote Global (US, EU)", None, {}),
    ("regional_unconfirmed", "Engineer", "Remote - APAC", None, {}),
    ("restricted_remote", "Engineer", "Remote - Ruritania", None, {}),
    ("no_remote_evidence", "Engineer", "Oslo, Norway", "We are remote-first and have teams across APAC.", {}),
    ("restricted_remote", "Engineer", "Oslo, Norway", "This position is remote for candidates based in Norway.", {}),
    ("onsite_explicit", "Engineer", "Oslo", "Five days on-site.", {}),
    ("onsite_explicit", "Engineer", "Remote", "This role is not remote.", {}),
    ("onsite_explicit", "Engineer", "Remote", None, {"workplace_type": "Hybrid"}),
    ("onsite_explicit", "Engineer", "Remote", None, {"is_remote": False}),
    ("restricted_remote", "Engineer", "Global - Remote", US, {}),
    ("restricted_remote", "Engineer", "Global - Remote", f"<ul><li>{US}</li></ul><h3>Preferred skills</h3>", {}),
    ("global_explicit", "Engineer", "Global - Remote", "Nice to have: U.S. citizenship required by some clients", {}),
    ("global_explicit", "Engineer", "Global - Remote", "U.S. citizenship is required by few and <b>optional</b> here", {}),
    ("restricted_remote", "Engineer", "Global - Remote", "Preferred: knitting.<br>U.S. citizenship required", {}),
    ("restricted_remote", "Engineer", "Worldwide Remote", "We do not hire people in Pakistan.", {}),
    ("restricted_remote", "Engineer", "Remote", "Work from anywhere in Spain.", {}),
    ("restricted_remote", "Engineer (Canada)", "Remote", None, {}),
    ("restricted_remote", "Engineer, Texas", "Remote", None, {}),
    ("restricted_remote", "Backend, EMEA - Remote", "", None, {}),
    ("regional_unconfirmed", "Engineer - Remote Asia", "", None, {}),
    ("remote_unclear", "Engineer, Remote", "", None, {}),
    ("no_remote_evidence", "Remote Sensing Engineer", "", None, {}),
    ("global_explicit", "Engineer - Remote (Worldwide)", "", None, {}),
    ("pakistan_explicit", "Engineer - Remote Pakistan", "", None, {}),
    ("pakistan_explicit", "Engineer", "Remote", "Open to candidates based in Pakistan.", {}),
    ("pakistan_explicit", "Engineer", "Remote", "All applicants must be legally authorized to work in one of the following countries: U.K., Pakistan, U.S.A. We have an office.", {}),
    ("restricted_remote", "Engineer", "Remote", "Candidates must be legally authorised to work in the following countries: France, Peru. Our founder grew up in Pakistan.", {}),
    ("restricted_remote", "Engineer", "Remote", "Candidates must be legally authorised to work in the following countries: France, Peru About us we also sell to Pakistan", {}),
    ("global_explicit", "Engineer", "Remote", "You can work from anywhere in the world.", {}),
    ("remote_unclear", "Engineer", "Remote", "Work from anywhere for up to 20 days per year.", {}),
    ("regional_unconfirmed", "Engineer", "Worldwide Remote", "Core hours are UTC+1 to UTC+4.", {}),
    ("remote_unclear", "Engineer", "Oslo, Norway", None, {"workplace_type": "remote", "scope_kind": "posting_location_unverified", "countries": ["Norway"]}),
    ("restricted_remote", "Engineer", "", None, {"is_remote": True, "countries": ["Norway"]}),
    ("regional_unconfirmed", "Engineer", "", None, {"is_remote": True, "countries": ["Asia"]}),
    ("global_explicit", "Engineer", "Worldwide", None, {"is_remote": True}),
    ("restricted_remote", "Engineer", "Remote", None, {"eligibility": "location applicants must be based in Germany"}),
    ("no_remote_evidence", None, None, None, {}),
]


def _classified(spark, rows):
    schema = "n int, title string, location string, description string, e struct<" + ", ".join(f"{n}: {t}" for n, t in eligibility.EVIDENCE.items()) + ">"
    jobs = spark.createDataFrame([(n, *r[:3], tuple(r[3].get(f) for f in eligibility.EVIDENCE)) for n, r in enumerate(rows)], schema)
    return eligibility.classify(jobs, F.col("title"), F.col("location"), F.col("description"), **{f: F.col(f"e.{f}") for f in eligibility.EVIDENCE})


def test_cases(spark):
    got = {r.n: r[eligibility.STATUS] for r in _classified(spark, [c[1:] for c in CASES]).collect()}
    assert not [(c, got[n]) for n, c in enumerate(CASES) if got[n] != c[0]]


def test_edges(spark):
    long = "We build software. " * 20_000
    rows = [("Engineer", "Remote", long + "Work from anywhere in the world.", {}), ("Engineer", "Remote", long, {}), ("Engineer", "Remote", long, {})]
    assert [r[eligibility.STATUS] for r in _classified(spark, rows).orderBy("n").collect()] == ["global_explicit", "remote_unclear", "remote_unclear"]
    jobs = spark.createDataFrame([("Remote", "x", 1, 2)], "scope string, `a.b c` string, claim int, Remote_Eligibility_Status int")
    out = eligibility.classify(jobs, F.lit("Engineer"), F.col("scope"), F.lit(None))
    assert out.columns == ["scope", "a.b c", "claim", eligibility.STATUS, eligibility.REASON] and out.first()[3] == "remote_unclear"
    assert eligibility.classify(jobs.limit(0), F.lit("a"), F.col("scope"), F.lit(None)).collect() == []
