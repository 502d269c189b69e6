"""Packing, the prefix trie and the divergence audit against plain versions, on whole tables and edge rows."""

import random
import zlib

import brute
import numpy as np
import pandas as pd
import pytest
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tierflow.llm import divergence, packing, prefix_trie
from tierflow.llm.queries import QUERIES, TOKENIZER

FILE = path(TOKENIZER)


def check_places(frame, capacity):
    """Every sequence is filled without gaps and overlaps, up to the capacity."""
    for _, part in frame.sort_values("offset").groupby("sequence_id"):
        ends = part["length"].cumsum()
        assert list(part["offset"]) == [0, *ends[:-1]] and ends.iloc[-1] <= capacity


def wanted_pieces(rows, capacity=1024):
    tokenizer, out = Tokenizer.from_file(FILE), []
    for key, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        cuts = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
        out += [(key, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    return out


def test_op11(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = QUERIES["op11_packing"](spark, sf_dir).toPandas()
    docs = pd.read_parquet(f"{sf_dir}/documents.parquet")
    found = got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)
    assert sorted(found) == sorted(wanted_pieces(zip(docs["doc_id"], docs["text"])))
    check_places(got, 1024)
    assert got["sequence_id"].nunique() <= 1.01 * got["length"].sum() / 1024


def test_packing_edges(spark):
    rows = [(1, None), (2, ""), (3, "x"), (3, "x"), (None, "a<|endoftext|>b"), (4, " \n\t "), (5, "word " * 40000), (6, "y" * 30000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("z") for c in ("piece", "length", "sequence_id", "offset", "ids", "__uid")})
    packed = packing.pack(packing.pieces(docs, FILE, capacity=100), capacity=100)
    frame = packed.toPandas()
    found = frame[["id", "piece", "start", "length", "ids_crc32"]].astype({"id": "Int64"}).itertuples(index=False, name=None)
    want = wanted_pieces(rows, 100)
    assert sorted(map(str, ((None if pd.isna(r[0]) else int(r[0]), *map(int, r[1:])) for r in found))) == sorted(map(str, want))
    check_places(frame, 100)
    whole = packing.sequences(packed).toPandas()
    assert (whole["length"] <= 100).all() and whole["length"].sum() == sum(w[3] for w in want)
    assert packing.pack(packing.pieces(docs.where("doc_id < 0"), FILE)).count() == 0


def test_encoder_equals_the_whole_tokenizer():
    encoder, rnd = packing.Encoder(FILE), random.Random(7)
    signs = ["a", "B", "é", "中", "1", "٣", "'s", "'", "!", " ", " ", "  ", "\n", "\t", "\r\n", "　", "\x1c", "\x85", "​", "᠎", "<|endoftext|>", "😀", "word", "\x00", "́", "'ll"]
    for _ in range(20000):
        text = "".join(rnd.choice(signs) for _ in range(rnd.randint(0, 15)))
        assert encoder.encode(text).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_matching_places_every_piece():
    rnd = random.Random(3)
    for _ in range(300):
        capacity = rnd.choice([3, 7, 10, 16, 31])
        counts = {n: rnd.randint(0, 9) for n in range(1, capacity + 1)}
        filled, ranks = {}, {}
        for length, rank, n, first, each, offset in packing.slots(counts, capacity).tolist():
            for k in range(n):
                ranks.setdefault(length, []).append(rank + k)
                filled.setdefault(first + k // each, []).append((offset + k % each * length, length))
        assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in counts.items() if n and k < capacity}
        for held in filled.values():
            held.sort()
            assert all(a + n == b for (a, n), (b, _) in zip(held, held[1:])) and held[0][0] == 0 and sum(held[-1]) <= capacity
            assert sum(3 * n > capacity for _, n in held) <= 2
        assert sorted(filled) == list(range(len(filled)))


def conversations(seed):
    """Copies, shared heads, long single conversations and long ones that part late."""
    rnd, rows = random.Random(seed), []
    long = [("user", f"w{i} x") for i in range(23)]
    for conv in range(60):
        turns = [(rnd.choice(["user", None, "assistant"]), rnd.choice(["", None, "a b", "c", f"only {conv}"])) for _ in range(rnd.randint(1, 6))]
        if conv % 7 == 3:
            turns = turns[:2] + [("user", f"{conv} {i}") for i in range(rnd.randint(1, 30))]
        if conv % 9 == 4:
            turns = long[:rnd.choice([12, 23, 23])] + turns[:2]
        rows += [(conv, i if i else None, *t) for i, t in enumerate(turns)]
    return [*rows, (-7, 1, "user", "minus"), (1000, 1, "user", "far"), (None, 1, "user", "nobody")]


def trie(turns):
    found = prefix_trie.prefix_trie(*prefix_trie.share_heads(prefix_trie.numbered_turns(turns))).collect()
    out = {(r["conv_id"], r["depth"]): tuple(r)[2:] for r in found}
    assert len(out) == len(found)
    return out


@pytest.mark.parametrize("steps, width", [(8, 256), (1, 4), (2, 8)])
def test_trie_equals_plain_version(spark, monkeypatch, steps, width):
    monkeypatch.setattr(prefix_trie, "STEPS", steps)
    monkeypatch.setattr(prefix_trie, "WIDTH", width)
    rows = conversations(steps)
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(1) for c in ("depth", "a", "words", "place", "path")})
    assert trie(turns) == brute.prefix_trie(rows)


def test_trie_edges(spark):
    rows = [(0, 1, "user", "a"), (20, 1, "x", "only one"), (20, 1, "x", "only one"), (41, 1, None, None), (44, None, "u", "t " * 200000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert trie(turns) == brute.prefix_trie(rows)
    assert trie(turns.where("conv_id < 0")) == {} and trie(turns.withColumn("conv_id", F.lit(None).cast("long"))) == {}


def audit(docs, **options):
    found = divergence.audit(docs, **options).collect()
    out = {(r["lang"], r["source"], r["part"], r["item"]): (r["value"], r["rank"]) for r in found}
    assert len(out) == len(found)
    return out


def test_audit_edges(spark):
    rows = [("alpha beta Alpha é", "x", "s1"), ("alpha beta Alpha é", "x", "s1"), ("alpha beta Alpha é", "x", "s2"), ("beta 3 gamma-ray ÉÉ", "x", None), ("gamma beta", "x", "s3"),
            (None, "x", "empty"), ("", "x", "empty"), ("alpha", None, "s1"), ("rare", "y", "s1"), ("other", "y", "s2"), ("beta " * 5000 + "zeta", "x", "long"), ("zeta alpha", "x", "s2")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").withColumns({c: F.lit("z") for c in ("n", "term", "mark", "sources", "p", "value", "item")})
    for least in (1, 2, 3):
        got = audit(docs, least=least, top=2)
        assert got == brute.divergence(rows, least, 2)
    assert got["y", "s1", "pair", "s2"] == (0, 1)
    assert audit(docs.where("lang = 'none'")) == {}
