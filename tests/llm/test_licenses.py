"""License scans: planted notices are found with their spans; alignment against a full table."""

import itertools
import random
import re

import numpy as np
import pytest

from millrace.llm import licenses
from millrace.llm.license_templates import TEMPLATES


def lcs(a, b, low, high):
    """Longest common subsequence within the diagonals low .. high, by the full table."""
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            t[i][j] = max(t[i - 1][j], t[i][j - 1], t[i - 1][j - 1] + 1 if a[i - 1] == b[j - 1] and low <= j - i <= high else 0)
    return t[-1][-1]


@pytest.mark.parametrize("seed", range(30))
def test_align(seed):
    rng = random.Random(seed)
    a, b = [rng.choices(range(5), k=rng.randint(1, 25)) for _ in range(2)]
    n, first, past = licenses.align(np.array(a), np.array(b), -40, 40)
    assert n == lcs(a, b, -99, 99)
    assert not n or (0 <= first < past <= len(b) and lcs(a, b[first:past], -99, 99) == n)
    low, high = sorted(rng.sample(range(-6, 7), 2))
    assert licenses.align(np.array(a), np.array(b), low, high)[0] == lcs(a, b, low, high)


def words(text):
    return licenses._WORD.findall(text.lower().encode())


@pytest.mark.parametrize("name", TEMPLATES)
def test_each_template_alone_and_amid_text(name):
    index, rng = licenses.Index(), random.Random(1)
    for text in TEMPLATES[name]:
        noise = [["".join(rng.choices("bdfgk", k=6)) for _ in range(50)] for _ in range(2)]
        full = " ".join([*noise[0], text, *noise[1]])
        (match,) = index.scan(words(full))
        assert match[0] == name and match[1] == 1.0 and (match[3], match[4]) == (50, 50 + len(words(text)))


def test_edited_text_and_no_false_hits():
    index, rng = licenses.Index(), random.Random(2)
    own = words(TEMPLATES["MIT"][-1])
    edited = list(own)
    for k in range(5, len(edited), 17):
        edited[k] = b"changed"
    edited[60:60] = [b"added"] * 3
    (match,) = index.scan([b"x"] * 20 + edited + [b"y"] * 20)
    assert match[0] == "MIT" and 0.9 < match[1] < 1.0 and match[3] == 20
    assert index.scan(own[: len(own) // 2]) == []
    assert index.scan(rng.choices(own, k=3000)) == []
    assert index.scan([]) == index.scan([b"the"]) == []


def test_unbroken():
    for n in range(1, 13):
        left = next(k for k in range(n + 1) if k >= licenses.COVERAGE * n)
        worst = min(max(map(len, "".join("0" if k in lost else "1" for k in range(n)).split("0"))) for lost in itertools.combinations(range(n), n - left))
        assert licenses.unbroken(n) == worst


@pytest.mark.parametrize("name", TEMPLATES)
def test_edited_short_notices(name):
    """A short notice is found with any one of its other words changed (where 0.8 of them are left), as if every template were aligned everywhere; not with a telling word changed."""
    index, noise = licenses.Index(), [b"bdfgk"] * 20
    for text in TEMPLATES[name]:
        own = words(text)
        telling = {w for w in own if w.decode() in licenses.TELLING.union(re.findall("[0-9a-z]+", name.lower()))}
        for k in range(len(own) if 5 <= len(own) <= licenses.SHORT else 0):
            edited = noise + own[:k] + [b"changed"] + own[k + 1 :] + noise
            found = [m for m in index.scan(edited) if m[2] >= len(own) - 1]
            if own[k] not in telling:
                assert name in {m[0] for m in found}, (text, own[k])
            elif own.count(own[k]) == 1:
                assert (len(own) - 1) not in {m[2] for m in found if m[0] == name and m[1] < 1}, (text, own[k])


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    lines = {
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "Released under the MIT License.": "MIT",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    }
    got = {(r.doc_id, r.license, r.start_char, r.end_char) for r in licenses.scan(docs).collect()}
    want = {(r.doc_id, name, at, at + len(line) - 1) for r in docs.collect() for line, name in lines.items() if (at := r.text.find(line)) >= 0}
    assert want and want <= got
    assert {g[0] for g in got} == {w[0] for w in want}


def test_edge_cases(spark):
    line = "Released under the MIT License."
    rows = [(1, None, 0), (None, f"é {line}", 0), (2, f"{line}\n{line}", 0), (2, f"{line}\n{line}", 0), (3, "", 0), (4, "filler " * 100000 + line, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, match int")
    got = sorted((str(r.doc_id), r.match, r.start_char, r.end_char) for r in licenses.scan(docs).collect())
    twice = [("2", 0, 0, 30)] * 2 + [("2", 1, 32, 62)] * 2
    assert got == sorted([*twice, ("4", 0, 700000, 700030), ("None", 0, 2, 32)])
    assert licenses.scan(docs.limit(0)).collect() == []
