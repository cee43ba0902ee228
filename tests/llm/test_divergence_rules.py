"""Divergence rules against plain Python and hand-made texts."""

import math
import random
import re
import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))
from conftest import spark  # noqa: E402, F401

from distillery.llm import divergence_rules as dr  # noqa: E402
from distillery.llm.common import stored  # noqa: E402

SCHEMA = "doc_id long, text string, lang string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def texts():
    rng = random.Random(3)
    bits = ["a", "bb", "ccc", "É", "ß", "1", "#", "a|b", "\n", "\n", "\t", "\x0b", " ", "  ", "\xa0x", "　", "😀", "a b c", "x\ny"]
    out = [None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "a b c d a b c", "x y\nx y\n x y\n\nx y", "w " * 5000]
    out += [" ".join(rng.choice(bits) for _ in range(rng.randint(0, 90))) for _ in range(200)]
    # many different repeated windows, beyond those that are looked up one by one
    many = [f"w{i}" for i in range(120)]
    return [*out, " ".join(many * 2 + ["end"]), " ".join(many + many[:40])]


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_counts_against_plain_python(spark):  # noqa: F811
    all_ = [(i, t, "en") for i, t in enumerate(texts())] + [(None, "a b", None), (5, "dup", "xx"), (5, "dup", "xx")]
    docs = spark.createDataFrame(all_, SCHEMA).repartition(5)
    got = dr.quality(docs, dr.word_references(docs))
    assert got.columns[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    want = sorted((repr(i), *base(t)) for i, t, _ in all_)
    assert sorted((repr(r[0]), *r[1:7]) for r in rows_of(got)) == want
    assert not any(r.kept and r.base_failed for r in got.collect())


def js(p, q):
    m = [(a + b) / 2 for a, b in zip(p, q)]
    kl = lambda x: sum(a * math.log2(a / c) for a, c in zip(x, m) if a > 0)
    return math.sqrt(max(0.0, (kl(p) + kl(q)) / 2))


def test_distances_and_references(spark):  # noqa: F811
    rng = random.Random(1)
    vocabulary = {"en": "the of and to in is was for on as".split(), "de": "der die und in den von zu das mit sich".split()}
    prose = lambda lang, n: " ".join(rng.choice(vocabulary[lang]) if rng.random() < 0.6 else
                                     "".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))
    docs = [(i, prose(lang, 200), lang) for lang in ("en", "de") for i in range(60)]
    odd = " ".join(f"w{i}***" for i in range(80))
    pairs = [(1000, odd, "en"), (1001, odd, None), (1002, prose("en", 60), None), (1003, prose("en", 120), "xx"), (1004, "short text", "en")]
    df = spark.createDataFrame(docs + pairs, SCHEMA)
    refs = stored(dr.word_references(df, least_words=5_000))
    by = {r.x_lang: r for r in refs.collect()}
    assert set(by) == {"en", "de", None} and set(by["en"].common[:10]) == set(vocabulary["en"])
    for r in by.values():
        assert len(r.common) <= dr.COMMON and len(r.common_part) == len(r.common) + 1 and sum(r.common_part) == pytest.approx(1)
    got = {r.doc_id: r for r in dr.quality(df.filter("doc_id >= 1000 or lang = 'en'"), refs).collect()}
    assert not got[1000].kept and not got[1000].base_failed and not got[1001].kept
    assert got[1000].class_distance > dr.MAX_CLASS_DISTANCE
    assert all(got[i].kept for i in range(60)) and got[1003].kept
    assert got[1004].class_distance is None and got[1004].word_distance is None
    words = Counter(odd.split())
    p = [words[w] / 80 for w in by["en"].common]
    assert got[1000].word_distance == pytest.approx(js([*p, 1 - sum(p)], by["en"].common_part), abs=1e-6)


def test_empty_table_and_clashing_columns(spark):  # noqa: F811
    docs = spark.createDataFrame([(1, "a b c " * 30, "en")], SCHEMA)
    for c in ("x_words", "n_words", "known", "l", "common", "wd", "x_held", "word", "words", "total", "c0", "x_text"):
        docs = docs.withColumn(c, docs.doc_id)
    out = dr.quality(docs, dr.word_references(docs))
    assert out.count() == 1
    kept = dr.quality(docs, dr.word_references(docs), keep=["doc_id", "common", "c0"])
    assert kept.columns[:3] == ["doc_id", "common", "c0"] and kept.first().c0 == 1
    empty = docs.limit(0)
    assert dr.quality(empty, dr.word_references(empty)).collect() == []
    assert dr.quality(docs, dr.word_references(empty)).first().word_distance is None
