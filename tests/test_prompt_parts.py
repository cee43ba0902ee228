"""Scoring prompts: what a task holds at once does not grow with its rows or their texts."""

import numpy as np

from distillery.operators import teacher


def test_prompts_are_turned_into_ids_some_at_a_time(spark):
    long = teacher.PART_BYTES // 4
    rows = [(None if i % 7 == 0 else i, str(i % 10) * (long if i % 100 == 0 else i)) for i in range(700)]
    df = spark.createDataFrame(rows, "id long, prompt string").coalesce(1)
    rows_at_once, bytes_at_once = teacher.PART_ROWS, teacher.PART_BYTES

    def tokenizer(texts):
        assert len(texts) <= rows_at_once and sum(map(len, texts)) <= bytes_at_once
        return teacher.code_point_tokenizer(texts)

    seen = teacher.score_prompts(df, teacher.stand_in_teacher, ["id"], max_length=50, tokenizer=tokenizer).collect()
    tell, suffix = teacher.stand_in_teacher(), teacher.code_point_tokenizer([teacher.ASSISTANT_SUFFIX])[0]
    assert [r.id for r in seen] == [r[0] for r in rows]
    for r, (_, text) in zip(seen, rows):
        ids = np.concatenate([teacher.code_point_tokenizer([text[:50]])[0], suffix])
        told = tell([ids])[0]
        assert r.n_ids == len(ids) and abs(r.score - told.get("yes", -10.0) + told.get("no", -10.0)) < 1e-8
