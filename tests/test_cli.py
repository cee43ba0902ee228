"""The command line drives the file stages end to end (in-process, shared session)."""

import json
import os

from distillery.__main__ import main


def test_cli_create_triplets(spark, tmp_path, monkeypatch):
    src = tmp_path / "train_logit.jsonl"
    with open(src, "w") as f:
        for i in range(5):
            f.write(json.dumps({"query": "q", "passage": f"p{i}", "score": float(5 - i)}) + "\n")
    monkeypatch.setattr(type(spark), "stop", lambda self: None)  # keep the shared test session
    main(["create-triplets", "--input-files", str(src), "--output-dir", str(tmp_path / "out"),
          "--top-k", "2", "--num-negatives", "2"])
    out = tmp_path / "out" / "output=train_logit_margin_sampled.jsonl"
    rows = [json.loads(l) for f in os.listdir(out) if f.endswith(".json") for l in open(out / f)]
    assert sorted((r["positive"], r["negative"]) for r in rows) == [("p0", "p1"), ("p0", "p2"), ("p1", "p2"), ("p1", "p3")]
