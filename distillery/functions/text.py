"""String / array functions: prompt text, char-level token ids, truncation, truthiness,
metric-key parsing and output-path naming."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from distillery.functions.numeric import _c

# ---- fixed values (must equal the teacher prompt format) ----------------------------
RERANK_SYSTEM_PROMPT = (
    'Judge whether the Document meets the requirements based on the Query and the Instruct '
    'provided. Note that the answer can only be "yes" or "no".'
)
DEFAULT_INSTRUCTION = "Given a web search query, retrieve relevant passages that answer the query"
ASSISTANT_SUFFIX = "<|im_end|>\n<|im_start|>assistant\n<think>\n\n</think>\n\n"
DEFAULT_MAX_TOKENS = 8192
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>\n"
# ------------------------------------------------------------------------------------


def rerank_user_content(query, doc, instruction: str = DEFAULT_INSTRUCTION) -> Column:
    return F.concat(
        F.lit(f"<Instruct>: {instruction}\n<Query>: "), _c(query), F.lit("\n<Document>: "), _c(doc)
    )


def rerank_messages(query, doc, instruction: str = DEFAULT_INSTRUCTION) -> Column:
    """``array<struct<role, content>>``: the fixed system turn and the user turn."""
    return F.array(
        F.struct(F.lit("system").alias("role"), F.lit(RERANK_SYSTEM_PROMPT).alias("content")),
        F.struct(F.lit("user").alias("role"), rerank_user_content(query, doc, instruction).alias("content")),
    )


def rerank_template(query, doc, instruction: str = DEFAULT_INSTRUCTION) -> Column:
    """The whole prompt as the chat template writes it: the system turn and the user turn, each
    between turn marks (no generation prompt: :data:`ASSISTANT_SUFFIX` follows the cut prompt)."""
    turn = lambda role, content: F.concat(F.lit(f"{TURN_START}{role}\n"), content, F.lit(TURN_END))
    return F.concat(turn("system", F.lit(RERANK_SYSTEM_PROMPT)), turn("user", rerank_user_content(query, doc, instruction)))


#: Texts whose ids a Python helper holds at once.
ID_ROWS = 100


def char_token_ids(text) -> Column:
    """Character-level token ids (Unicode code points) of the whole text; none of NULL.

    Stands in for a model tokenizer, as which it runs in Python; any ``array<int>`` id
    column can be fed to :func:`truncate_with_suffix`. Texts are turned some at a time, so
    that a batch's ids are never held at once.
    """
    def codes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for start in range(0, len(batch), ID_ROWS):
                some = batch.slice(start, ID_ROWS).cast(pa.binary()).to_pylist()
                ids = [(x or b"").decode("utf-8", "replace").encode("utf-32-le") for x in some]
                ends = np.cumsum([0, *map(len, ids)]) // 4
                yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4")))

    return F.arrow_udf(codes, "array<int>")(_c(text))


class _Written(dict):
    """Numbers in decimal, each written once."""

    def __missing__(self, number: int) -> str:
        self[number] = said = str(number)
        return said


def ids_md5(ids) -> Column:
    """The MD5 of an ``array<int>`` of token ids, written in decimal and joined by commas (NULL for NULL)."""
    def digests(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        written = _Written()
        for batch in batches:
            for start in range(0, len(batch), ID_ROWS):
                some = [x.values.to_numpy().tolist() if x.is_valid else None for x in batch.slice(start, ID_ROWS)]
                yield pa.array([x if x is None else hashlib.md5(",".join(map(written.__getitem__, x)).encode()).hexdigest()
                                for x in some], pa.string())

    return F.arrow_udf(digests, "string")(_c(ids))


def truncate_with_suffix(ids, max_len: int, suffix_ids) -> Column:
    """``ids[:max_len] ++ suffix``; the suffix is not counted against ``max_len``."""
    if max_len <= 0:
        raise ValueError("max_len must be positive")
    suffix = suffix_ids if isinstance(suffix_ids, Column) else F.array(*[F.lit(int(i)) for i in suffix_ids])
    return F.concat(F.slice(_c(ids), 1, max_len), suffix)


def suffix_token_ids(suffix: str = ASSISTANT_SUFFIX) -> list[int]:
    return [ord(ch) for ch in suffix]


def all_truthy(strings=(), arrays=()) -> Column:
    """Python truthiness for string and array columns: NULL, '' and [] are all false."""
    cond = F.lit(True)
    for c in strings:
        cond = cond & F.coalesce(F.length(_c(c)) > 0, F.lit(False))
    for c in arrays:
        cond = cond & _c(c).isNotNull() & F.coalesce(F.size(_c(c)) > 0, F.lit(False))
    return cond


def metric_name(key) -> Column:
    """Last ``_``-separated token of a metric key: ``test-evaluation_mrr@10`` -> ``mrr@10``."""
    return F.element_at(F.split(_c(key), "_"), -1)


def suffixed_path(path, suffix: str) -> Column:
    """Insert ``suffix`` before the file extension (``a/b.jsonl`` -> ``a/b<suffix>.jsonl``);
    a name without extension gets the suffix appended."""
    p = _c(path)
    has_ext = p.rlike(r"[^/]\.[^./]*$")
    return F.when(has_ext, F.regexp_replace(p, r"([^/])(\.[^./]*)$", f"$1{suffix}$2")).otherwise(
        F.concat(p, F.lit(suffix))
    )
