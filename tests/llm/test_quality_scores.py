"""The quality classifier against its definition: statistics text by text, densities from plain covariances."""

import math
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tierflow.llm import quality
from tierflow.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"
PUNCTUATION = b"!\"#$%&'()*+-/:;<=>?@[\\]^_`{}~"


def plain_statistics(text):
    data = (text or "").encode()
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", data) if w]
    lines = [line for line in data.split(b"\n") if line]
    n, size = len(words), len(data)
    lengths = [len(w) for w in words]
    mean = sum(lengths) / n if n else 0.0
    variance = sum((x - mean) ** 2 for x in lengths) / n if n else 0.0

    def share(found):
        return found / (n + 10)

    def rate(allowed):
        return math.sqrt(sum(b in allowed for b in data) / (size + 100))

    return [
        math.log1p(n), math.log1p(mean), math.log1p(math.sqrt(variance)),
        (len(set(words)) + 10) / (n + 10), share(sum(x <= 3 for x in lengths)),
        math.sqrt(share(sum(65 <= w[0] <= 90 for w in words))),
        math.sqrt(share(sum(w[-1] in PUNCTUATION + b"|" for w in words))), math.log1p(max(lengths, default=0)),
        rate(range(65, 91)), rate(range(48, 58)), rate(b".,"), rate(b"|"), rate(PUNCTUATION), rate(range(128, 256)), rate(b"\n"),
        (len(set(lines)) + 3) / (len(lines) + 3), math.log1p(sum(map(len, lines)) / max(len(lines), 1)), math.log1p(size),
    ]


def plain_scores(x, y, every, shrink=0.1, ridge=0.1, cut=4.0):
    """Scores of the rows ``every`` from the log densities of two normals fitted on ``x`` with labels ``y``."""
    centre, spread = x.mean(axis=0), np.sqrt(np.maximum(x.var(axis=0), 1e-8))

    def scaled(rows):
        return np.clip((rows - centre) / spread, -cut, cut)

    z = scaled(x)
    groups = [z[y == c] for c in (0, 1)]
    covariances = [np.cov(g.T, bias=True) for g in groups]
    pooled = sum(len(g) * c for g, c in zip(groups, covariances)) / len(z)
    diagonal = np.diag(np.maximum(np.diag(pooled), 1e-3))
    log = []
    for g, c in zip(groups, covariances):
        sigma = (1 - shrink - ridge) * c + shrink * pooled + ridge * diagonal
        away = scaled(every) - g.mean(axis=0)
        distance = np.einsum("ij,ij->i", away, np.linalg.solve(sigma, away.T).T)
        log.append(np.log(len(g) / len(z)) - 0.5 * np.linalg.slogdet(sigma)[1] - 0.5 * distance)
    return 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))


def test_statistics(spark):
    texts = [
        None, "", " \n\t ", "a", "One two, two|three!\nOne two\n\nOne two\nÜber 42 (x)", "\v\f\r x\x1fy", "|" * 300, "word " * 4000,
        "é\n" * 70_000, "x" * 1_500_000,
    ]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r["s"] for r in frame.select("i", quality.statistics(F.coalesce("t", F.lit(""))).alias("s")).collect()}
    for i, text in enumerate(texts):
        assert got[i] == pytest.approx(plain_statistics(text), rel=1e-9, abs=1e-7), i


def test_every_score_follows_the_definition(spark):
    documents = pd.read_parquet(f"{DATA}/documents.parquet")
    labels = pd.read_parquet(f"{DATA}/labels.parquet").dropna(subset=["quality"])
    held = documents["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)
    every = np.array([plain_statistics(t) for t in documents["text"]])
    train = documents.assign(at=range(len(documents)))[~held].merge(labels, on="doc_id")
    expected = plain_scores(every[train["at"]], train["quality"].to_numpy(), every)
    got = QUERIES["op4_quality"](spark, DATA).toPandas().set_index("doc_id").loc[documents["doc_id"]]
    assert np.allclose(got["score"], expected, rtol=0, atol=1e-7)
    assert (got["held_out"].to_numpy() == held.to_numpy()).all()
    assert (got["predicted"] == (got["score"] >= 0.3).astype(int)).all()


def test_threshold_tie_counts_as_good():
    scored = pd.DataFrame({"score": [0.3, 0.29999999, 0.3], "quality": [1, 0, 0]})
    assert quality.accuracy(scored) == pytest.approx(2 / 3)


def test_one_class_only_scores_its_share(spark):
    x = [[float(i + j) for j in range(len(quality.NAMES))] for i in range(4)]
    rows = spark.createDataFrame([(v, 1) for v in x], "features array<double>, quality int")
    assert quality.fit(rows).scores(np.array(x)).tolist() == [1.0] * 4
    assert quality.fit(rows.limit(0)).scores(np.array(x)).tolist() == [0.5] * 4
