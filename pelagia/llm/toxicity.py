"""Toxicity: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams.

Features of a text are the distinct hashes of its words, word pairs, pairs with one word between, and of the first bytes of
its words (inflected and compounded forms share those), each present or not.
FTRL-proximal keeps a rate for each coordinate and an L1 threshold, so most weights are exactly zero and the model is a short
list of (index, weight), a broadcast of at most 2^bits entries.

Training reads at most max_rows labelled documents, and of those in the order of their hashes only so many that their texts have
max_chars characters together (two documented bounds); each of `shards` tasks runs FTRL over its share of them, and their weights
are averaged.  Scoring runs over whole texts in the tasks that read them.

Cases: a null or empty text has the bias alone as its score; rows that repeat a doc_id are scored each, and train as one, with the text
of the smallest hash; a doc_id with conflicting labels counts as toxic; rows without doc_id are scored like others; labels that are null
or not 0 / 1 train nothing; without labelled rows of both classes every score is the base rate (0.0 with none); a column named score
is replaced, all others stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pelagia.llm.common import mix64, word_hashes

#: Lengths in bytes of the word beginnings that count as features.
STEMS = (4, 6, 8)
#: Lower case for ASCII letters, blanks for all other ASCII but digits and the apostrophe.
_CLEAN = bytes((c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c == 39 or c > 127 else 32) for c in range(256))


@dataclass(frozen=True)
class Settings:
    bits: int = 20
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 5.0
    l2: float = 1.0
    epochs: int = 6
    shards: int = 1
    max_rows: int = 6_000
    max_chars: int = 64_000_000


@dataclass(frozen=True)
class Model:
    index: np.ndarray
    weight: np.ndarray
    bias: float
    bits: int


def features(text: str | None, bits: int) -> np.ndarray:
    """The hashed features of a text, with repeats."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_CLEAN).split()
    if not words:
        return np.zeros(0, np.int32)
    h = word_hashes(words)
    with np.errstate(over="ignore"):
        pairs = mix64(h[:-1] * np.uint64(3) + h[1:])
        skips = mix64(h[:-2] * np.uint64(5) + h[2:] + np.uint64(1))
        stems = [word_hashes([w[:k] for w in words]) + np.uint64(k) for k in STEMS]
    return (np.concatenate([h, pairs, skips, *stems]) >> np.uint64(64 - bits)).astype(np.int32)


def ftrl(rows: list[tuple[np.ndarray, int]], s: Settings) -> tuple[np.ndarray, np.ndarray, float]:
    """Non-zero coordinates, their weights and the bias, after s.epochs passes."""
    dim = (1 << s.bits) + 1  # the last is the bias, which L1 leaves alone
    z, n = np.zeros(dim), np.zeros(dim)

    def weight(i: np.ndarray) -> np.ndarray:
        over = np.abs(z[i]) - s.l1
        return np.where(over > 0, -np.sign(z[i]) * over / ((s.beta + np.sqrt(n[i])) / s.alpha + s.l2), 0.0)

    bias = lambda: -z[-1] / ((s.beta + np.sqrt(n[-1])) / s.alpha)
    for _ in range(s.epochs):
        for x, y in rows:
            w = weight(x)
            p = 1 / (1 + np.exp(-np.clip(w.sum() + bias(), -35, 35)))
            g = p - y
            root = np.sqrt(n[x])
            z[x] += g - (np.sqrt(n[x] + g * g) - root) / s.alpha * w
            n[x] += g * g
            b, root = bias(), np.sqrt(n[-1])
            z[-1] += g - (np.sqrt(n[-1] + g * g) - root) / s.alpha * b
            n[-1] += g * g
    i = np.flatnonzero(np.abs(z[:-1]) > s.l1)
    return i, weight(i), float(bias())


def train(docs: DataFrame, labels: DataFrame, usable: Column | None = None, settings: Settings = Settings()) -> Model:
    """Fit on the labelled documents that `usable` (a condition on doc_id) admits, at most settings.max_rows of them."""
    s = settings
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    known = (known if usable is None else known.where(usable)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.withColumn("order", F.xxhash64(F.lit("toxic"), "doc_id")).orderBy("order", "doc_id").limit(s.max_rows)
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "order", "toxic")
    once = found.agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("least")).select("doc_id", "order", "toxic", F.col("least.text").alias("text"))
    # One task numbers at most max_rows lengths.
    upto = F.sum(F.coalesce(F.length("text"), F.lit(0)).cast("long")).over(W.orderBy("order", "doc_id"))
    rows = once.withColumn("upto", upto).where(F.col("upto") <= s.max_chars).withColumn("shard", F.pmod("order", F.lit(s.shards)).cast("int"))

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["order", "doc_id"])
        data = [(np.unique(features(t, s.bits)), int(y)) for t, y in zip(group["text"], group["toxic"], strict=True)]
        del group
        i, w, b = ftrl(data, s)
        pos = float(np.mean([y for _, y in data]))
        return pd.DataFrame({"index": np.append(i, [-1, -2]), "weight": np.append(w, [b, pos])})

    # A row for each non-zero weight of each shard, at most shards * 2^bits.
    got = rows.groupBy("shard").applyInPandas(fit, "index long, weight double").groupBy("index").agg(F.sum("weight").alias("w"), F.count("*").alias("n")).toPandas().sort_values("index")
    if got.empty:
        return Model(np.zeros(0, np.int64), np.zeros(0, np.float32), -35.0, s.bits)
    used = int(got.loc[got["index"] == -1, "n"].iloc[0])
    got["w"] /= used
    base = float(got.loc[got["index"] == -2, "w"].iloc[0])
    if base in (0.0, 1.0):
        return Model(np.zeros(0, np.int64), np.zeros(0, np.float32), 35.0 if base else -35.0, s.bits)
    real = got[got["index"] >= 0]
    return Model(real["index"].to_numpy(np.int64), real["w"].to_numpy(np.float32), float(got.loc[got["index"] == -1, "w"].iloc[0]), s.bits)


def scorer(model: Model):
    """Scores of texts: a function over a series of them."""
    weights = np.zeros(1 << model.bits, np.float32)
    weights[model.index] = model.weight

    def score(texts: pd.Series) -> np.ndarray:
        out = np.empty(len(texts))
        for k, t in enumerate(texts):
            x = features(t, model.bits)
            x = x[weights[x] != 0]
            out[k] = model.bias + float(weights[np.unique(x)].sum(dtype=np.float64))
        return 1 / (1 + np.exp(-np.clip(out, -35, 35)))

    return score


def scored(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """docs (or the columns keep of it) with a score.  Only the texts go to Python, and only the scores come back."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = scorer(sent.value)
        for texts in batches:
            yield pd.Series(of(texts))

    names = [c for c in docs.columns if c.lower() != "score"] if keep is None else keep
    return docs.select(*names, score(F.col("text")).alias("score"))
