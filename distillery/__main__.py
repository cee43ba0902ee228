"""Command line for the file stages: ``python -m distillery <stage> ...``.

Stages: ``score-pairs`` (samples -> teacher-scored pairs), ``create-triplets`` (scored
pairs -> margin triplets), ``soft-labels`` (samples -> soft-label triplets), ``evaluate``
(before/after rank metrics). Scorers / embedders are ``module:function`` references, or
one of the built-in stand-ins (``hashing-cosine``, ``hashing``).
Each stage is one Spark job over all inputs with one output directory per input file.
"""

from __future__ import annotations

import argparse
import importlib

from distillery.session import build_session


def _load(spec: str):
    from distillery.operators import teacher
    from distillery.plans import evaluation

    if spec == "hashing-cosine":
        return evaluation.bi_encoder_scorer(teacher.hashing_embedder())
    if spec == "hashing":
        return teacher.hashing_embedder()
    module, _, name = spec.partition(":")
    return getattr(importlib.import_module(module), name)


def _report(df, path: str | None, order: list[str]) -> None:
    """Reports have a row for each input or metric. They are written to ``path`` as JSONL if given;
    what is printed comes row by row, never whole into the driver."""
    df = df.orderBy(*order)
    if path:
        df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="distillery")
    ap.add_argument("--master", default=None, help="Spark master (default: from the launcher)")
    sub = ap.add_subparsers(dest="stage", required=True)

    s = sub.add_parser("score-pairs")
    s.add_argument("--input-files", nargs="+", required=True)
    s.add_argument("--output-dir", required=True)
    s.add_argument("--output-suffix", default="_scored")
    s.add_argument("--scorer", default="hashing-cosine")
    s.add_argument("--teacher", default=None, help="module:function that loads a log-probability teacher")
    s.add_argument("--tokenizer", default=None, help="module:function from texts to token ids")
    s.add_argument("--batch-size", type=int, default=8)
    s.add_argument("--max-model-len", type=int, default=8192)
    s.add_argument("--task-instruction", default=None)

    t = sub.add_parser("create-triplets")
    t.add_argument("--input-files", nargs="+", required=True)
    t.add_argument("--output-dir", required=True)
    t.add_argument("--output-suffix", default="_margin_sampled")
    t.add_argument("--top-k", type=int, default=8)
    t.add_argument("--num-negatives", type=int, default=4)
    t.add_argument("--strategy", choices=["hard", "random"], default="hard")
    t.add_argument("--quarantine-dir", default=None)

    e = sub.add_parser("soft-labels")
    e.add_argument("--input-files", nargs="+", required=True)
    e.add_argument("--output-dir", required=True)
    e.add_argument("--output-suffix", default="_soft_labels")
    e.add_argument("--embedder", default="hashing")
    e.add_argument("--vector-store", default=None, help="folder of the vectors, shared by all executors and kept between runs")

    v = sub.add_parser("evaluate")
    v.add_argument("--dataset", nargs="+", required=True)
    v.add_argument("--before", required=True)
    v.add_argument("--after", required=True)
    v.add_argument("--domain", default=None)
    v.add_argument("--style", choices=["reranker", "embedding"], default="reranker")
    v.add_argument("--at-k", type=int, default=10)

    for stage in (s, t, e):
        stage.add_argument("--unordered", action="store_true", help="don't keep the input order in the outputs")
        stage.add_argument("--on-clash", choices=["path", "error"], default="path", help="inputs of equal names")
    for stage in (s, t, e, v):
        stage.add_argument("--report", default=None, help="folder to write the report to")
    a = ap.parse_args(argv)
    spark = build_session(a.master, app_name=f"distillery-{a.stage}")
    if a.stage == "score-pairs":
        from distillery.functions.text import DEFAULT_INSTRUCTION
        from distillery.plans.reranker import generate_scored_pair_files
        counts = generate_scored_pair_files(
            spark, a.input_files, a.output_dir, None if a.teacher else _load(a.scorer), a.output_suffix, not a.unordered,
            a.on_clash, teacher_loader=_load(a.teacher) if a.teacher else None,
            tokenizer=_load(a.tokenizer) if a.tokenizer else None, batch_size=a.batch_size,
            max_length=a.max_model_len, instruction=a.task_instruction or DEFAULT_INSTRUCTION)
        _report(counts, a.report, ["output"])
    elif a.stage == "create-triplets":
        from distillery.plans.reranker import create_triplet_files
        _report(create_triplet_files(
            spark, a.input_files, a.output_dir, a.output_suffix, a.top_k, a.num_negatives, a.strategy,
            ordered=not a.unordered, on_clash=a.on_clash, quarantine_dir=a.quarantine_dir), a.report, ["output"])
    elif a.stage == "soft-labels":
        from distillery.plans.embedding import generate_soft_label_files
        from distillery.sources.vectors import VectorStore
        counts, missing = generate_soft_label_files(
            spark, a.input_files, a.output_dir, _load(a.embedder), a.output_suffix,
            VectorStore(spark, a.vector_store) if a.vector_store else None, not a.unordered, a.on_clash)
        _report(counts, a.report, ["output"])
        print(f"triplets without a vector: {missing.count()}")
    else:
        from distillery.plans.evaluation import evaluate_files
        empty = "zero" if a.style == "reranker" else "drop"
        zero_base = "inf" if a.style == "reranker" else "zero"
        rep, cmp = evaluate_files(spark, a.dataset, {"before": _load(a.before), "after": _load(a.after)},
                                  a.domain, a.at_k, empty, zero_base, a.style)
        _report(rep, None, ["domain", "model", "metric"])
        _report(cmp.select("domain", "metric_label", "before_text", "after_text", "abs_text", "rel_text", "direction"),
                a.report, ["domain", "metric_label"])
    spark.stop()


if __name__ == "__main__":
    main()
