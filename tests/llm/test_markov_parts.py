"""Random parts of runs: against a plain search, and precision and recall on planted keys."""

import hashlib
import random
import re
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))
from conftest import SF_ORACLE, SF_SMALL, spark  # noqa: E402, F401

from distillery.llm import markov_secrets as ms  # noqa: E402


@pytest.fixture(scope="module")
def ratios(spark):  # noqa: F811
    return ms.train(spark.read.parquet(f"{SF_ORACLE}/documents.parquet"))


def best_part(run, ratios, toll):
    codes = [ms.ALPHABET.index(c) for c in run]
    gains = [ratios[a, b] - toll for a, b in zip(codes, codes[1:])]
    return max((sum(gains[i:j + 1]), -i, j) for i in range(len(gains)) for j in range(i, len(gains)))


def test_parts_against_a_plain_search(ratios):
    rng = random.Random(4)
    texts = []
    for _ in range(60):
        runs = ["".join(rng.choice("abcXYZ019/_-=+qzjk") for _ in range(rng.randint(1, 30))) for _ in range(5)]
        texts.append(rng.choice([" ", "\n", " é "]).join(runs))
    got = ms.random_parts(texts, [[] for _ in texts], ratios, 0.3, 12.0)
    for t, parts in zip(texts, got):
        want = []
        for m in re.finditer(f"[{re.escape(ms.ALPHABET)}]+", t):
            if len(m.group()) > 1:
                total, i, j = best_part(m.group(), ratios, 0.3)
                if total >= 12.0:
                    want.append((m.start() - i, m.start() + j + 2))
        assert parts == want
    assert ms.random_parts([], [], ratios) == [] and ms.random_parts(["", "a"], [[], []], ratios) == [[], []]
    assert ms.random_parts(["x" * 5], [[(0, 5)]], ratios) == [[]]


def test_planted_keys(ratios, spark):  # noqa: F811
    rng = random.Random(8)
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").filter("lang = 'en'").limit(40).collect()
    words = sorted({w for r in rows for w in re.findall("[A-Za-z]{2,}", r.text)})
    words += ["get_user", "some-long-name", "README", "api", "v1"]
    alphabets = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
                 "abcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"]
    texts, keys = [], []
    for i in range(400):
        key = "".join(rng.choice(alphabets[i % 4]) for _ in range(24)) if i % 2 else ""
        path = "/".join(rng.choice(words) for _ in range(6))
        start = f"{' '.join(rng.choice(words) for _ in range(20))} {path}{'/' if key else ''}"
        texts.append(f"{start}{key} {' '.join(rng.choice(words) for _ in range(20))} 123e4567-e89b-12d3-a456-426614174000")
        keys.append((len(start), len(start) + len(key)) if key else None)
    found = [[(a, b) for a, k, b in spans if k == 3] for spans in ms.scan_all(texts, ratios)]
    hits = sum(any(min(b, y) - max(a, x) >= 20 and b - a <= 28 for a, b in f) for f, k in zip(found, keys) if k for x, y in [k])
    alarms = sum(bool(f) for f, k in zip(found, keys) if not k)
    print(f"recall {hits / 200:.3f}, texts without a key reported {alarms} of 200")
    assert hits >= 160 and alarms <= 4


def test_query_against_independent_patterns(spark):  # noqa: F811
    """The base part of the whole query, its digest and counts, from patterns written anew."""
    from distillery.llm.queries import op9_secrets

    rows = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}
    assign = re.compile(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
    for r in op9_secrets(spark, SF_SMALL).collect():
        t, spans = rows[r.doc_id], []
        spans += [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m.group(1)) >= 8]
        spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m.group()) >= 16]
        spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m.group()) >= 32]
        said = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[1] == k for s in spans) for k in range(3))
        assert set(said.split(",")) - {""} <= set(r.spans.split(","))
    assert np.isfinite(ms.train(spark.createDataFrame([], "doc_id long, text string"))).all()
