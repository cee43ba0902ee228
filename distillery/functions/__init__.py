"""Column-level functions. Everything here returns a ``Column`` built from
``pyspark.sql.functions`` so it stays on the JVM side."""

from distillery.functions.numeric import fix_decimals, fix6, fix9
from distillery.functions.vectors import cosine, dot, norm, quantize, to_double_array
from distillery.functions.text import (
    all_truthy,
    char_token_ids,
    metric_name,
    rerank_messages,
    rerank_user_content,
    suffixed_path,
    truncate_with_suffix,
)
from distillery.functions.scoring import (
    kl_divergence_t,
    log_softmax_t,
    logprob_or_floor,
    softmax_t,
    yes_no_logit,
)

__all__ = [
    "fix_decimals", "fix6", "fix9",
    "cosine", "dot", "norm", "quantize", "to_double_array",
    "all_truthy", "char_token_ids", "metric_name", "rerank_messages", "rerank_user_content",
    "suffixed_path", "truncate_with_suffix",
    "kl_divergence_t", "log_softmax_t", "logprob_or_floor", "softmax_t", "yes_no_logit",
]
