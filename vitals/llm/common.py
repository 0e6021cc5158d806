"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import hashlib
import os
import re
import threading
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals.session import scratch_path

#: ASCII white space, as used by the word and line rules ([\\x20\\x09-\\x0D]).
ASCII_SPACE = " \t\n\x0b\x0c\r"


def shipped(spark: SparkSession) -> SparkSession:
    """Python workers started from now on find this package where the driver
    found it (a cluster gets it with ``--py-files`` or on its own path)."""
    env = spark.sparkContext.environment
    home = str(Path(__file__).resolve().parents[2])
    if home not in (paths := env.get("PYTHONPATH", "").split(os.pathsep)):
        env["PYTHONPATH"] = os.pathsep.join([home, *filter(None, paths)])
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table through Spark's reader (any store Spark can open)."""
    shipped(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written once below ``spark.checkpoint.dir`` and read back:
    later plans start from shared files, so a lost executor costs one task."""
    shipped(df.sparkSession)
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def only(df: DataFrame, **types: str) -> DataFrame:
    """The named columns with their types; any other column of the table, also
    one whose name clashes with a name used inside an operator, is left out."""
    shipped(df.sparkSession)
    return df.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in types.items()])


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


_ONCE: dict = {}
_LOCK = threading.Lock()


def once(key: tuple, make):
    """One object of a kind (``key[0]``) per Python worker, such as a tokenizer or
    a trie: made at first use, and replaced when another key of its kind comes."""
    held = _ONCE.get(key[0])
    if held is None or held[0] != key:
        with _LOCK:
            held = _ONCE.get(key[0])
            if held is None or held[0] != key:
                _ONCE.pop(key[0], None)
                held = _ONCE[key[0]] = (key, make())
    return held[1]


def release(*keep: str) -> None:
    """Drop what ``once`` keeps but for some kinds: a worker that goes on to another stage
    of a pipeline does not hold the tries and tokenizers of the stages before."""
    with _LOCK:
        for kind in [k for k in _ONCE if k not in keep]:
            del _ONCE[kind]
