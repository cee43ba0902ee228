"""The operators of distillery.llm against brute force, round trips and held-out accuracy, on
small inputs with nulls, empty and long texts, ties, repeated rows and empty tables."""

import hashlib
import random
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parents[1]))
from conftest import SF_ORACLE, spark  # noqa: E402, F401

from distillery.llm import order_minhash as om  # noqa: E402
from distillery.llm import packing, simhash_links  # noqa: E402
from distillery.llm.common import shared_folder, stored  # noqa: E402
from distillery.llm.components import components  # noqa: E402
from distillery.llm.language_id import Model, held_out, identify, train, viterbi  # noqa: E402
from distillery.llm.line_windows import dedup_lines  # noqa: E402
from distillery.llm.markov_secrets import find_secrets, scan  # noqa: E402
from distillery.llm.markov_secrets import train as train_markov  # noqa: E402
from distillery.llm.mixing import mix  # noqa: E402
from distillery.llm.prefix_forest import nearest  # noqa: E402
from distillery.llm.token_counts import PIECE, Counter, Encoder, spliced, token_counts  # noqa: E402
from distillery.llm.warc import read_warc, transactions, write_warc  # noqa: E402

DOC = "doc_id long, text string"
ROWS = [(1, "a b c"), (2, None), (2, None), (None, "x " * 3000), (5, ""), (6, "Ünï <|endoftext|> cödé\n\n's"), (6, "q")]
BITS = ["a", "bc ", " ", "  ", "\n", "'s", "1", "é", "́", "<|endoftext|>", "<|", "\x1c", "　", "😀", "the ", "!", "ſ"]


def texts(n, size, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) for _ in range(rng.randint(0, size))) for _ in range(n)]


def clash(df):
    return df.withColumn("n", F.lit(1)).withColumn("key", F.lit("k")).withColumn("row_id", F.lit(0))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_token_splices_are_exact(name):
    counter = Counter(public_tokenizers.path(name), 40, 4)
    assert counter.encoder.proven
    whole = Tokenizer.from_file(public_tokenizers.path(name))
    for t in [*texts(150, 120), "x" * 500 + " y" * 300]:
        want = whole.encode(t, add_special_tokens=False).ids
        assert spliced(counter.encoder, t, 20, 4) == want
        assert counter.ids([t])[0] == np.array(want, "<u4").tobytes()


def test_token_counts(spark):  # noqa: F811
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = sorted(map(tuple, token_counts(clash(spark.createDataFrame(ROWS, DOC)), chunk=512).collect()), key=repr)
    n = [(k, len((t or "").encode()), len(whole.encode(t or "", add_special_tokens=False).ids)) for k, t in ROWS]
    assert got == sorted([(*x, x[2] > 512) for x in n], key=repr)
    assert token_counts(spark.createDataFrame([], DOC)).count() == 0


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(1)
    sizes = np.array([4, 1, 6, 3])
    scores = rng.normal(size=(sizes.sum(), 3))
    labels, at = viterbi(scores, sizes, 0.7), 0
    for n in sizes:
        cost = lambda p: sum(scores[at + i, x] for i, x in enumerate(p)) - 0.7 * sum(a != b for a, b in zip(p, p[1:]))  # noqa: E731, B023
        paths = np.stack(np.meshgrid(*[range(3)] * n), -1).reshape(-1, n)
        assert cost(labels[at:at + n]) == pytest.approx(max(map(cost, paths)))
        at += n


def test_language_held_out_accuracy_and_edges(spark):  # noqa: F811
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    model = train(docs, ~held_out())
    rows = identify(docs, model, keep=["doc_id", "lang"]).filter(held_out()).collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.95
    edge = clash(spark.createDataFrame([(1, None), (2, ""), (3, "123 !?"), (None, "the of and that with")], DOC))
    got = {r.doc_id: (r.lang_pred, r.score) for r in identify(edge, model, keep=["doc_id"]).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[None][0] == "en" and 0 < got[None][1] <= 1
    assert identify(edge.limit(0), model, keep=["doc_id"]).count() == 0
    nothing = train(docs.limit(0), F.lit(True))
    assert isinstance(nothing, Model) and {r.lang_pred for r in identify(edge, nothing).collect()} == {"und"}


def test_warc_round_trip(spark):  # noqa: F811
    rows = [(1, "http://a", "x" * 2000), (2, None, "x" * 2000), (3, "u\r\nWARC/1.1\r\n", None), (7, "q", ""), (7, "q", ""),
            (4, "v", "a WARC/1.1\r\nWARC/1.1\r\n" * 99), (5, "w", "ends WARC/1.1"), (6, "y", "é\r\n\r\n\r\n"),
            (None, "z", "x" * 2000), (9, "x", "d" * 3000), (9, "x", "d" * 3000), (8, "x", "d" * 3000), (11, "r", "\r\n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("sha", F.lit("clash"))
    copies, want = defaultdict(list), []
    for k, _, h in rows:
        copies[h or ""].append(k)
    for k, _, h in rows:
        b, last = (h or "").encode(), max((x for x in copies[h or ""] if x is not None), default=None)
        revisit = len(b) >= 1000 and len(copies[h or ""]) > 1 and k != last
        want.append((k, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", last if revisit else None))
    for some, expected in ((pages, want), (pages.limit(0), [])):
        folder = shared_folder(spark)
        write_warc(some, folder)
        records = stored(read_warc(spark, folder))
        got = transactions(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
        assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
        assert records.filter("not complete").count() == 0
    folder = shared_folder(spark)
    write_warc(pages, folder)
    bodies = {bytes(r.payload).decode() for r in read_warc(spark, folder).filter("warc_type = 'response'").collect()}
    assert bodies == {h or "" for _, _, h in rows}


def test_packing_covers_every_token_once(spark):  # noqa: F811
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    many = [(100 + i, "word " * (i * 7 % 97)) for i in range(300)]
    for rows, capacity in ((ROWS, 4096), (many, 256), ([], 4096)):
        pieces = packing.pack_documents(clash(spark.createDataFrame(rows, DOC)), capacity=capacity).collect()
        ids, by_doc, by_sequence = defaultdict(list), defaultdict(list), defaultdict(list)
        for k, t in rows:
            ids[k].append(whole.encode(t or "", add_special_tokens=False).ids + [2])
        for p in pieces:
            by_doc[p.doc_id].append(p)
            by_sequence[p.sequence_id].append(p)
            assert any(len(x) == p.doc_tokens and zlib.crc32(np.array(
                x[p.start:p.start + p.length], "<u4").tobytes()) == p.ids_crc32 for x in ids[p.doc_id])
        assert all(sum(p.length for p in by_doc[k]) == sum(map(len, x)) for k, x in ids.items())
        for seq in by_sequence.values():
            at = 0
            for p in sorted(seq, key=lambda p: p.offset):
                assert p.offset == at
                at += p.length
            assert at <= capacity and (at == capacity or not at & (at - 1))  # no padding


def test_column_generation_reaches_the_bound():
    demand, sizes = np.array([40.0, 60, 30, 20]), np.array([3, 5, 7, 9])
    patterns, x = packing.column_generation(demand, sizes, 16)
    assert (patterns @ sizes <= 16).all() and np.allclose(patterns.T @ x, demand)
    assert x.sum() <= 1.05 * (demand * sizes).sum() / 16


def brute_signature(t):
    if not t:
        return np.zeros(om.PLACES, np.uint16)
    kmer, element, _, count = om._elements([t], om.K)
    kmer, state, size = kmer[:count[0]], element[:count[0]].copy(), om.TUPLE
    if len(kmer) <= size:
        return om._tuple_hash(kmer[None, :], np.array([len(kmer)]))[0].repeat(om.PLACES)
    value, when, i = np.full((len(kmer), om.PLACES), np.inf), np.zeros(len(kmer)), np.arange(len(kmer))
    for _ in range(40 * om.PLACES):
        when = when - np.log1p(-((state >> np.uint64(11)).astype(float) * 2.0 ** -53)) / om.PLACES
        place = (om._mix(state ^ np.uint64(om._ODD)) % np.uint64(om.PLACES)).astype(int)
        value[i, place] = np.minimum(value[i, place], when)
        state = om._mix(state + np.uint64(om._ODD))
    return np.array([om._tuple_hash(kmer[np.sort(np.argsort(value[:, j])[:size])][None, :], np.array([size]))[0]
                     for j in range(om.PLACES)])


def test_order_minhash(spark):  # noqa: F811
    some = ["", "a", "abcdefgh", "a" * 24, *texts(6, 200, 3)]
    assert all((brute_signature(t) == s).all() for t, s in zip(some, om.signatures(some)))
    for rows in (ROWS, [(5, "alone text here")], []):
        order = sorted(((k, t or "") for k, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        want = []
        for i, (k, t) in enumerate(order):
            after, quarter = order[(i + 1) % len(order)][1], len(t) // 4
            edited = t[:len(t) - quarter] + after[:quarter]
            own, other, following = om.signatures([t, edited, after])
            want.append((k, len(t), hashlib.sha256(edited.encode()).hexdigest(), om._hex([own])[0], om._hex([other])[0],
                         float((own == other).mean()), float((own == following).mean())))
        got = om.order_minhash(clash(spark.createDataFrame(rows, DOC)), buckets=3).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_mix_bounds_and_edges(spark):  # noqa: F811
    rows = [(i, "w " * (i % 40), None if i % 9 == 0 else f"s{i % 5}") for i in range(400)] + [(None, None, "s1")] * 2
    docs = clash(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    got = mix(docs, keep=["doc_id", "source"]).collect()
    assert len(got) == len(rows) and all(0 <= r.taken <= 2 * r["size"] for r in got)
    taken, target = defaultdict(int), {r.source: r.target for r in got}
    for r in got:
        taken[r.source] += r.taken
    assert sum(target.values()) == pytest.approx(1.5 * sum(r["size"] for r in got))
    assert all(abs(taken[s] - t) <= 0.02 * t + 20 for s, t in target.items())
    assert sorted(map(repr, mix(docs.repartition(7), keep=["doc_id", "source"]).collect())) == sorted(map(repr, got))
    assert mix(docs.limit(0)).count() == 0


def brute_nearest(rows, every, k):
    rows = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v
            and np.isfinite(np.array(v, float)).all() and np.any(v)]
    out = {}
    for i, v in rows:
        if i % every == 0:
            near = sorted({(-float((w * v).sum()), j) for j, w in rows if j != i})[:k]
            out[i] = [(j, -s) for s, j in near]
    return out


def test_prefix_forest(spark):  # noqa: F811
    odd = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 2.0]), (20, [1.0, 0.0]), (40, None), (60, [0.0, 0.0]), (5, [1.0, None]),
           (80, [float("nan"), 1.0]), (100, [-3.0, 1.0]), (None, [1.0, 1.0]), (1, [1.0, 0.0])]
    schema = "vec_id long, embedding array<float>"
    for rows in (odd, [(i, [1.0, float(i % 3)]) for i in range(200)], []):
        got = defaultdict(list)
        for r in sorted(nearest(clash(spark.createDataFrame(rows, schema)), F.col("vec_id") % 20 == 0, 5, trees=6).collect()):
            got[r.query_id].append((r.vec_id, r.score))
        assert dict(got) == {k: v for k, v in brute_nearest(rows, 20, 5).items() if v}
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_ORACLE}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want, got = brute_nearest(rows, 20, 20), defaultdict(set)
    for r in nearest(spark.createDataFrame(rows, schema), F.col("vec_id") % 20 == 0).collect():
        got[r.query_id].add(r.vec_id)
    assert np.mean([len(got[q] & {i for i, _ in v}) / len(v) for q, v in want.items()]) >= 0.9


def test_line_windows(spark):  # noqa: F811
    rows = [(1, "a\nb\nc\nd"), (2, "x\na\n b \nc\nd\ny"), (3, "\n\n\n\n\n\n"), (4, "a\na\na\na\na"), (5, None), (6, ""),
            (7, "a\nb\nc\nd"), (7, "a\nb\nc\nd"), (None, "a\nb\nc"), (8, "p\nq")]
    got = sorted([(r.doc_id, r.text, r.n_lines, r.n_removed) for r in
                  dedup_lines(clash(spark.createDataFrame(rows, DOC))).collect()], key=repr)
    assert got == sorted([(1, "a\nb\nc\nd", 4, 0), (2, "x\ny", 6, 4), (3, "\n\n\n\n\n\n", 7, 0), (4, "a\na\na\na\na", 5, 0),
                          (5, None, 0, 0), (6, "", 1, 0), (7, "", 4, 4), (7, "", 4, 4), (None, "", 3, 3), (8, "p\nq", 2, 0)],
                         key=repr)
    assert dedup_lines(spark.createDataFrame([], DOC)).count() == 0


def test_secrets(spark):  # noqa: F811
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    ratios = train_markov(docs)
    random_run = "f3A9xK27q0Zb81LmVt5w6D"
    text = f'ok é Password: "abc12345" token=short AKIA{"B7" * 8} {"0a" * 20} {random_run} internationalization_of_words'
    kinds = [(text[a:b], k) for a, k, b in scan(text, ratios)]
    assert ('Password: "abc12345', 0) in kinds and ("AKIA" + "B7" * 8, 1) in kinds and ("0a" * 20, 2) in kinds
    assert (random_run, 3) in kinds and len(kinds) == 4
    rows = [(1, text), (2, None), (3, ""), (None, "plain words only"), (1, text)]
    got = find_secrets(clash(spark.createDataFrame(rows, DOC)), ratios).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert [(r.n_assign, r.n_access, r.n_hex) for r in got if r.doc_id == 1] == [(1, 1, 1)] * 2
    assert all(r.base_sha256 == empty and r.spans == "" for r in got if r.doc_id != 1) and len(got) == 5
    base = ",".join(s for s in next(r.spans for r in got if r.doc_id == 1).split(",") if "markov" not in s)
    assert {r.base_sha256 for r in got if r.doc_id == 1} == {hashlib.sha256(base.encode()).hexdigest()}
    assert find_secrets(spark.createDataFrame([], DOC), ratios).count() == 0


def brute_simhash(t):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else " " if c in "\t\n\x0b\x0c\r" else c
                                for c in t or "").split(" ") if w]
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups_of(values, distance):
    parent = {x: x for x in values}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x in values:
        one = [x ^ (1 << i) for i in range(64)] if distance else []
        two = [x ^ (1 << i) ^ (1 << j) for i in range(64) for j in range(i)] if distance == 2 else []
        for y in [*one, *two]:
            if y in parent:
                parent[find(x)] = find(y)
    return {x: find(x) for x in values}


@pytest.mark.parametrize("distance,crowded", [(0, 128), (1, 4), (2, 4), (2, 128)])
def test_simhash_links_lose_nothing(spark, distance, crowded):  # noqa: F811
    rng = random.Random(1)
    centre, values = rng.getrandbits(64), {rng.getrandbits(64) for _ in range(500)}
    for _ in range(400):
        x = centre
        for _ in range(rng.randint(0, 5)):
            x ^= 1 << rng.randrange(64)
        values.add(x)
    signed = {x - (1 << 64) if x >> 63 else x: x for x in values}
    nodes = stored(spark.createDataFrame([(x,) for x in signed], "fp long"))
    roots = dict(components(simhash_links.links(nodes, distance, crowded)).collect())
    got, want = defaultdict(set), defaultdict(set)
    for s, x in signed.items():
        got[roots.get(s, s)].add(x)
    for x, root in groups_of(values, distance).items():
        want[root].add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_near_duplicates(spark):  # noqa: F811
    rows = [(1, "A b c d"), (2, None), (None, ""), (3, "a b C d"), (3, "a b C d"), (4, "q"), (6, "x\x1cy z w"), (None, "q")]
    docs = clash(spark.createDataFrame(rows, DOC))
    root = groups_of({brute_simhash(t) for _, t in rows}, 2)
    least = defaultdict(list)
    for k, t in rows:
        least[root[brute_simhash(t)]] += [k] if k is not None else []
    want = [(k, f"{brute_simhash(t):016x}", min(least[root[brute_simhash(t)]], default=None)) for k, t in rows]
    got = simhash_links.near_duplicates(docs).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    kept = simhash_links.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(root.values()))
    assert simhash_links.near_duplicates(docs.limit(0)).count() == 0


def test_pipeline_and_registered_oracles(spark):  # noqa: F811
    import duckdb

    import __spark_entry__ as entry
    import corpus_pipeline

    sf = SF_ORACLE.replace("0.01", "0.001")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, docs, sf))
        assert out.columns == names and 0 < out.count()
        docs = out
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() > 0
    for name in ("op3_warc", "op6_mixing", "op8_line_windows"):
        con = duckdb.connect()
        for t in ("documents", "pages"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
        want = con.sql(entry.oracle_sql()[name])
        got = entry.queries()[name](spark, sf).select(*want.columns)
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want.fetchall()))


def test_pieces_end_before_stops_and_latin_texts_are_lowered():
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    from distillery.llm.token_counts import Counter

    texts = ["<|ENDOFTEXT|> Hi, there's", "don't, can't.'S x", "İstanbul, ΣΑΣ. a.b,c!? 1.5, (x), _., ½. ²,", "", None,
             "  a,  b . ,c", "Å, B.́ c;d e?̧f", "<|startoftext|>, x", "x" * 5000 + ", y", "ÉTÉ, Ça: À. ÷, ×.",
             " '’s “Q,” — R."]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        path = public_tokenizers.path(name)
        library, counter = Tokenizer.from_file(path), Counter(path)
        expected = [np.array(library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        assert counter.ids(texts) == expected
        assert counter.ids(texts) == expected  # from the memo


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_plain_words_straight_to_the_merge_model(name):
    """Words of Latin letters, alone, after a space or a line break, among signs: the library's ids."""
    encoder = Encoder(public_tokenizers.path(name))
    draw = random.Random(5)
    texts = ["".join(draw.choice("abcXYZ éÉßÿÀ×÷µªº'sS.,!? \n\t 09ſİıǅ中") for _ in range(draw.randint(1, 60))) for _ in range(3000)]
    counter = Counter(public_tokenizers.path(name), memo_pieces=500)
    for start in range(0, len(texts), 100):  # a small memo: pieces are learnt, kept and forgotten
        some = texts[start:start + 100]
        assert counter.ids(some) == [np.array(x, "<u4").tobytes() for x in encoder.ids(some)]
    assert any(encoder.single.fullmatch(p) for p in PIECE.findall(encoder.folded("déjà vu")))
