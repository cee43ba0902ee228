"""Token ids of batches (not single texts) against the library, for texts with every kind of white
space and control character, and for texts beyond the chunk that is encoded at once."""

import os
import random

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from distillery.llm.token_counts import CHUNK_CHARS, Counter

os.environ["TOKENIZERS_PARALLELISM"] = "false"
NAMES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


def ids(model, t):
    return np.array(model.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("name", NAMES)
def test_batches_over_all_low_code_points(name):
    model = Tokenizer.from_file(public_tokenizers.path(name))
    rng = random.Random(11)
    every = [chr(c) for c in range(1, 0x3001) if not 0xD800 <= c < 0xE000]
    odd = [chr(c) for c in (*range(1, 33), 0x7F, 0x85, 0xA0, 0x1680, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
    plain = ["mail me @0 home (see below)", "the cat's 3rd paw, e.g. that", " @home", "a_b=c;d", "<|endoftext|> x"]
    for _ in range(25):
        counter = Counter(public_tokenizers.path(name))
        batch = [rng.choice(plain)]
        for _ in range(rng.randint(1, 5)):
            batch.append("".join(rng.choice(rng.choice((odd, every, [" ", "@", "the ", "\x1f", "é"]))) for _ in range(rng.randint(1, 25))))
        rng.shuffle(batch)
        assert counter.ids(batch) == [ids(model, t) for t in batch], batch
        assert counter.ids(batch[::-1]) == [ids(model, t) for t in batch[::-1]]  # from the memo


@pytest.mark.parametrize("name", NAMES)
def test_text_beyond_the_chunk(name):
    model = Tokenizer.from_file(public_tokenizers.path(name))
    text = duckdb.sql("SELECT text FROM '/root/testdata/sf0.1/documents.parquet' ORDER BY length(text) DESC LIMIT 1").fetchall()[0][0]
    text = (text * (2 * CHUNK_CHARS // len(text) + 1))
    assert len(text) > 2 * CHUNK_CHARS
    assert Counter(public_tokenizers.path(name)).ids([text, "short"]) == [ids(model, text), ids(model, "short")]
