"""Token alignment against plain loops over both libraries' whole encodings."""

import hashlib
import os
import random
import sys
from collections import Counter
from pathlib import Path

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parents[1]))
from conftest import SF_SMALL, spark  # noqa: E402, F401

from distillery.llm import token_alignment as ta  # noqa: E402

os.environ["TOKENIZERS_PARALLELISM"] = "false"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_values():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, n = {chr(b): b for b in shown}, 0
    for b in range(256):
        if b not in shown:
            out[chr(256 + n)] = b
            n += 1
    return out


def brute(texts):
    a, b, values = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B), byte_values()
    a.encode_special_tokens = True
    rows, held = [], Counter()
    for t in texts:
        n_a = n_b = 0
        links, groups = [], []
        if t:
            x, y = a.encode(" " + t, add_special_tokens=False), b.encode(t)
            bytes_a = [bytes(values[c] for c in token) for token in x.tokens]
            bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y]
            if b"".join(bytes_a) == b"".join(bytes_b) == (" " + t).encode():
                n_a, n_b = len(x.ids), len(y)
                spans = []
                for some in (bytes_a, bytes_b):
                    at, out = 0, []
                    for s in some:
                        out.append((at, at + len(s)))
                        at += len(s)
                    spans.append(out)
                j0 = 0
                for i, (s, e) in enumerate(spans[0]):
                    while spans[1][j0][1] <= s:
                        j0 += 1
                    j = j0
                    while j < n_b and spans[1][j][0] < e:
                        links.append((x.ids[i], y[j]))
                        j += 1
                i = j = 0
                for end in sorted({e for _, e in spans[0]} & {e for _, e in spans[1]}):
                    left, right = [], []
                    while i < n_a and spans[0][i][1] <= end:
                        left.append(str(x.ids[i]))
                        i += 1
                    while j < n_b and spans[1][j][1] <= end:
                        right.append(str(y[j]))
                        j += 1
                    groups.append(",".join(left) + "|" + ",".join(right))
        rows.append((n_a, n_b, len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
        held.update(set(links))
    best = Counter()
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    return [(*r[:3], len(r[3]), sum(held[p] == best[p[0]] for p in r[3]), sum(held[p] for p in r[3]), r[4]) for r in rows]


def texts():
    rng = random.Random(3)
    bits = ["a", "bc ", " ", "  ", "\n", "'s", "1", "é", "́", "<|endoftext|>", "<s>", "\x1c", "　", "😀", "the ", "!", "\t", "\r", "▁", "\xa0",
            "x\r\n", "hello world", "<0x41>"]
    out = [None, "", " ", "\n", "x", "<unk>", "▁", "a\x00b"]
    out += ["".join(rng.choice(bits) for _ in range(rng.randint(0, 50))) for _ in range(200)]
    return [*out, "word and " * 3000 + "\nend", "x" * 900, out[20], out[20]]


def test_parts_change_nothing():
    a, b = ta.ByteSide(A), ta.PieceSide(B)
    assert b.cuts
    some = texts()
    whole, cut = ta.Aligner(a, b)(some), ta.Aligner(a, b, 30)(some[:150] + ["some words " * 40])
    assert (whole[0][:150] == cut[0][:150]).all() and whole[1][:150] == cut[1][:150]
    n = (whole[2] < 150).sum()
    m = (cut[2] < 150).sum()
    pairs = lambda r, k: sorted(zip(r[2][:k].tolist(), r[3][:k].tolist(), r[4][:k].tolist()))
    assert pairs(whole, n) == pairs(cut, m)


def test_alignment_against_brute_force(spark):  # noqa: F811
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, "some text"), (7, "some text"), (7, "some text")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for c in ("block", "key", "pairs", "docs", "spot", "asker", "n"):
        df = df.withColumn(c, ta.F.lit(1))
    got = ta.align(df, block_chars=2_000).collect()
    want = brute([t for _, t in rows])
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((k, *r)) for (k, _), r in zip(rows, want))


def test_empty_table(spark):  # noqa: F811
    out = ta.align(spark.createDataFrame([], "doc_id string, text string"))
    assert out.collect() == [] and out.columns[0] == "doc_id" and out.columns[-1] == "groups_sha256"


def test_whole_table(spark):  # noqa: F811
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    rows = docs.collect()
    want = {r.doc_id: x for r, x in zip(rows, brute([r.text for r in rows]))}
    assert all(tuple(r)[1:] == want[r.doc_id] for r in ta.align(docs).collect())


def test_block_rows_are_short(monkeypatch):
    monkeypatch.setattr(ta, "ROW_PAIRS", 10)
    some = ["the cat sat on the mat", None, "", "another text, of other words"]
    figures, said, text, pair, times = ta.Aligner(ta.ByteSide(A), ta.PieceSide(B))(some)
    documents, listed = (b.to_pylist() for b in ta._block(7, [(ta.pa.array([1, 2, None, 4]), figures, said, text, pair, times)]))
    assert [(r["block"], r["key"], r["n_a"], len(r["spots"]), r["first"]) for r in documents] == [
        (7, k, f[0], (text == i).sum(), None) for i, (k, f) in enumerate(zip([1, 2, None, 4], figures.tolist()))]
    assert len(listed) > 1 and all(len(r["pairs"]) == len(r["docs"]) <= 10 for r in listed)
    pairs = [p for r in listed for p in r["pairs"]]
    assert pairs == sorted(set(pair.tolist())) and [r["first"] for r in listed] == list(range(0, len(pairs), 10))
    assert [pairs[s] for r in documents for s in r["spots"]] == pair.tolist()


def test_texts_come_in_small_batches(spark):  # noqa: F811
    name, df = "spark.sql.execution.arrow.maxBytesPerBatch", spark.range(200, numPartitions=1).selectExpr("id", "repeat('x', 50000) text")
    before, sizes = spark.conf.get(name, None), lambda batches: (ta.pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches)
    with ta.batches_of(spark, 1_000_000):
        rows = df.mapInArrow(sizes, "n long").collect()
    assert len(rows) > 5 and max(r.n for r in rows) < 2_000_000
    assert spark.conf.get(name, None) == before
