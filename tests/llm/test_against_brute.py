"""Registered queries against plain Python versions, on whole small tables."""

import hashlib
import re
import zlib

import brute
import numpy as np
import pandas as pd
import pytest
import xxhash

from tierflow.llm import minhash
from tierflow.llm.queries import QUERIES


@pytest.fixture(scope="module")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def middle():
    return "/root/testdata/sf0.01"


def table(sf_dir, name, *columns):
    return list(pd.read_parquet(f"{sf_dir}/{name}.parquet")[list(columns)].itertuples(index=False, name=None))


def result(spark, name, sf_dir):
    return QUERIES[name](spark, sf_dir).toPandas()


def keyed(frame, key, *columns):
    assert frame[key].is_unique
    return {r[0]: tuple(r[1:]) for r in frame[[key, *columns]].itertuples(index=False, name=None)}


def test_op1(spark, middle):
    got = result(spark, "op1_sharding", middle)
    docs = dict(table(middle, "documents", "doc_id", "text"))
    assert len(got) == len(docs) and set(got["law"]) == {"key"}

    def winner(key, shards):
        def time(shard):
            h = xxhash.xxh64_intdigest(shard.to_bytes(4, "little"), xxhash.xxh64_intdigest(key.to_bytes(8, "little"), 42))
            return -np.log(((h >> 11) + 0.5) * 2.0**-53)

        return min(range(shards), key=time)

    for r in got.itertuples():
        raw = (docs[r.doc_id] or "").encode()
        assert (r.size if not callable(r.size) else len(raw) + 1) == len(raw) + 1 and r.text_crc32 == zlib.crc32(raw)
        assert r.shard == winner(r.doc_id, 16) and r.grown_shard == winner(r.doc_id, 17)
        assert r.grown_shard in (r.shard, 16)
    for _, part in got.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))


def test_op2(spark, middle):
    found = result(spark, "op2_decontamination", middle)
    docs, items = table(middle, "documents", "doc_id", "text"), table(middle, "benchmark", "item_id", "text")
    got = keyed(found, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    want = brute.decontaminate(docs, items)
    assert got == want and any(v[4] for v in want.values())
    near = {doc: (len(ids), brute.sha(",".join(ids))) for doc, ids in brute.near_items(docs, items).items()}
    assert keyed(found, "doc_id", "n_near_items", "near_items_sha256") == near


def test_op3(spark, middle):
    got = keyed(result(spark, "op3_substring_dedup", middle), "doc_id", "n_words", "n_removed", "kept_sha256")
    want = brute.remove_repeats(table(middle, "documents", "doc_id", "text"))
    assert got == want and any(v[1] for v in want.values())


def test_op4(spark, middle):
    got = result(spark, "op4_quality", middle)
    assert len(got) == len(table(middle, "documents", "doc_id"))
    assert got["score"].between(0, 1).all() and ((got["score"] >= 0.3) == (got["predicted"] == 1)).all()
    assert all(h == brute.held_out(d, 5) for d, h in zip(got["doc_id"], got["held_out"]))
    labels = pd.read_parquet(f"{middle}/labels.parquet")
    tested = got[got["held_out"]].merge(labels, on="doc_id")
    assert ((tested["predicted"] == tested["quality"]).mean()) > 0.95


def test_op6_base(spark, small):
    got = result(spark, "op6_lm_scoring", small)
    want = brute.base_scores(table(small, "documents", "doc_id", "text"))
    assert len(got) == len(want)
    for r in got.itertuples():
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:3] and r.held_out == brute.held_out(r.doc_id, 10)
        assert r.base_score == pytest.approx(want[r.doc_id][3], rel=1e-9)


def test_op7(spark, small):
    got = keyed(result(spark, "op7_embedding_dedup", small), "vec_id", "n_links", "component_id")
    want = brute.vector_links(table(small, "embeddings", "vec_id", "embedding"))
    assert got == want


def test_op9(spark, middle):
    got = result(spark, "op9_pii", middle).set_index("doc_id")
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    card = re.compile(r"[0-9]([\x20-]?[0-9])+")
    phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    def digits(t):
        return re.sub("[^0-9]", "", t)

    checks = [
        ("email", email, lambda t: True), ("ip", ip, lambda t: all(int(p) <= 255 for p in t.split("."))),
        ("card", card, lambda t: 16 <= len(digits(t)) <= 19 and luhn(digits(t))), ("phone", phone, lambda t: 8 <= len(digits(t)) <= 15),
    ]
    some = 0
    for doc, text in table(middle, "documents", "doc_id", "text"):
        found = [(k, m.start(), m.end()) for k, p, ok in checks for m in p.finditer(text or "") if ok(m.group())]
        listed = [f"{k}:{a}:{b}" for k, a, b in found]
        row = got.loc[doc]
        assert row["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [row[f"n_{k}"] for k, _, _ in checks] == [sum(f[0] == k for f in found) for k, _, _ in checks]
        assert set(listed) <= set(row["spans"].split(","))
        some += len(found)
    assert some


def test_op10(spark, middle):
    got = keyed(result(spark, "op10_minhash", middle), "doc_id", "n_shingles", "component_id")
    want = brute.near_duplicates(table(middle, "documents", "doc_id", "text"))
    assert got == want and len({v[1] for v in want.values()}) < len(want)


@pytest.mark.parametrize("block", [2, 64])
def test_op10_blocks_meet(spark, middle, block):
    """Every two nodes of a bucket in different components are in one group; groups stay small, and small blocks change no result."""
    labels = [k if k % 4 == 0 else 1 for k in range(30)]
    members = spark.createDataFrame([(b, k) for b in (7, 8) for k in range(30 if b == 7 else 3)], "bucket long, node long")
    known = spark.createDataFrame(list(enumerate(labels)), "id long, component long")
    work = minhash._rest_work(members, known, block).toPandas()
    met = set()
    for (bucket, one, two), group in work.groupby(["bucket", "one", "two"]):
        assert len(group) <= (60 if block == 64 else 12)
        left, right = (group[group["block"] == side]["node"] for side in (one, two))
        met |= {(bucket, min(i, j), max(i, j)) for i in left for j in right if labels[i] != labels[j]}
    assert met == {(b, i, j) for b, n in ((7, 30), (8, 3)) for j in range(n) for i in range(j) if labels[i] != labels[j]}

    docs = spark.read.parquet(f"{middle}/documents.parquet")
    got = keyed(minhash.near_duplicates(docs, width=2, block=block).toPandas(), "doc_id", "n_shingles", "component_id")
    assert got == brute.near_duplicates(table(middle, "documents", "doc_id", "text"))
