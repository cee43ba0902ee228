"""A table of text vectors, addressed by content, in a folder that all executors share.

A text's address is the SHA-256 of its UTF-8 bytes. Filling the table embeds each distinct
text that has no vector yet, once, and adds the vectors as a new run folder; later stages and
later runs look vectors up by address. Vectors of different models belong in different
folders.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from distillery.operators import teacher
from distillery.session import ensure_checkpoint_dir

SCHEMA = "digest string, embedding array<float>"


def address(text) -> Column:
    """The content address of a text (NULL for NULL)."""
    return F.sha2(F.col(text) if isinstance(text, str) else text, 256)


class VectorStore:
    def __init__(self, spark: SparkSession, path: str | None = None):
        """The table at ``path``; without one, a new folder below ``spark.checkpoint.dir``."""
        if path is None:
            top = ensure_checkpoint_dir(spark)
            if top is None:
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            path = f"{top.rstrip('/')}/vectors-{uuid.uuid4().hex}"
        self.spark, self.path = spark, path.rstrip("/")
        # an empty run, so that there is always something to read
        spark.createDataFrame([], SCHEMA).write.mode("ignore").parquet(f"{self.path}/run=0")

    def rows(self) -> DataFrame:
        """What the runs have added: ``digest, embedding``. Two runs at the same time may both
        add a text's vector."""
        return self.spark.read.schema(SCHEMA).parquet(f"{self.path}/run=*").select("digest", "embedding")

    def table(self) -> DataFrame:
        """``digest, embedding``, unique by digest."""
        return self.rows().groupBy("digest").agg(F.min("embedding").alias("embedding"))

    def fill(self, texts: DataFrame, embedder: Callable[[pd.Series], np.ndarray] | None = None,
             text_col: str = "text") -> None:
        """Embed the texts that have no vector yet, each distinct one once (NULL is none).

        Copies are dropped before the shuffle, texts are shuffled by address, and the anti-join
        needs no text: a text without a vector goes from there straight to the embedder."""
        distinct = texts.select(address(text_col).alias("digest"), F.col(text_col).alias("text")).filter(
            "text is not null").groupBy("digest").agg(F.any_value("text").alias("text"))
        new = distinct.join(self.rows().select("digest"), "digest", "left_anti")
        vectors = teacher.embed_texts(new, embedder, "text", keep_cols=["digest"])
        vectors.write.parquet(f"{self.path}/run={uuid.uuid4().hex}")
