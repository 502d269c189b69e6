"""Nulls, empty and long texts, repeated rows, clashing extra columns and empty tables."""

import brute
import pytest
from pyspark.sql import functions as F

from tierflow.llm import chat, ctw, decontamination, embeddings, minhash, mixing, pii, quality, sharding, substrings

LONG = " ".join(f"word{i % 977}x" for i in range(30000))
SHARED = " ".join(f"shared{i}" for i in range(60))
ROWS = [
    (0, "Alpha beta gamma delta.", "s0"), (1, None, "s0"), (2, "", None), (3, " \n\t", "s1"), (4, LONG, "s1"), (5, LONG, "s1"),
    (6, SHARED, "s2"), (7, f"before {SHARED} after", "s2"), (8, "Alpha beta gamma delta.", "s0"), (8, "Alpha beta gamma delta.", "s0"), (None, "nobody", "s0"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    extra = {name: F.lit("x") for name in ("id", "size", "shard", "score", "node", "slot", "uid", "target", "taken", "row", "key", "n_words")}
    return rows.withColumns(extra)


def ids(df):
    return sorted(df.select("doc_id").toPandas()["doc_id"].tolist(), key=str)


OPERATORS = {
    "shards": lambda d: sharding.shard_table(d),
    "mix": lambda d: mixing.mix(d, mixing.word_count(F.col("text"))),
    "quality": lambda d: d.select("doc_id", quality.statistics("text").alias("features")),
    "lm": lambda d: ctw.score(d),
    "substrings": lambda d: substrings.remove_repeats(d),
    "near": lambda d: minhash.near_duplicates(d),
    "leaks": lambda d: decontamination.contaminated(d, d.select(F.col("doc_id").alias("item_id"), "text").where("doc_id = 6")),
    "pii": lambda d: d.select("doc_id", pii.spans("text").alias("found")),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_has_a_result_and_empty_tables_stay_empty(docs, name):
    assert OPERATORS[name](docs).count() == len(ROWS)
    assert OPERATORS[name](docs.where("doc_id < -5")).count() == 0


def test_results_of_the_edge_rows(docs):
    known = docs.where("doc_id IS NOT NULL")
    cut = {r["doc_id"]: r["n_removed"] for r in substrings.remove_repeats(known).collect()}
    assert cut[5] == 30000 and cut[7] == 60 and cut[4] == cut[6] == cut[1] == 0
    near = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(known).collect()}
    assert near == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 6, 8: 0}
    kept = ids(minhash.keep_one(known))
    assert kept == [0, 1, 2, 3, 4, 6]
    items = docs.select(F.col("doc_id").alias("item_id"), "text").where("doc_id = 6")
    assert ids(decontamination.drop_contaminated(known, items)) == [0, 1, 2, 3, 4, 5, 8, 8]
    mixed = mixing.mix(docs, mixing.word_count(F.col("text"))).toPandas()
    assert (mixed["taken"] <= 3 * mixed["size"]).all() and mixed["taken"].sum() <= mixed["size"].sum()


def test_context_tree_equals_its_definition(spark):
    rows = [(i, t) for i, t in enumerate(["abracadabra abba", "Abba cab", "", None, "zebra é", "abra", "cadabra abba", "b", "ab ab ab", "cab", "new text here", "abba"] * 2)]
    got = {r["doc_id"]: r["score"] for r in ctw.score(spark.createDataFrame(rows, "doc_id long, text string"), head_grams=40, head_words=5).collect()}
    want = brute.ctw_scores(rows)
    assert {k: pytest.approx(v, rel=1e-5) for k, v in want.items()} == got


def test_embeddings_edges(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [1.0, 0.1]), (8, [1.0, 0.0, 0.0]), (9, [-1.0, 0.0]), (10, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_duplicates(df, tile_rows=2).collect()}
    assert got == brute.vector_links(rows)
    assert embeddings.near_duplicates(df.where("vec_id < 0")).count() == 0


def test_chat_keeps_every_turn(spark):
    rows = [(1, 0, "user", "a <|im_end|> b <\\| c"), (1, 1, "assistant", "x<"), (1, 2, None, None), (2, None, "ro%0Ale\n", "t"), (None, 0, "assistant", "")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    shown = chat.examples(turns)
    assert shown.count() == 4
    got = {r["conv_id"]: r for r in chat.digest(shown).collect()}
    assert got[1]["turns_sha256"] == brute.sha("user\na <|im_end|> b <\\| c\nassistant\nx<\n\n\n") and got[1]["loss_sha256"] == brute.sha("x<")
    assert got[2]["turns_sha256"] == brute.sha("ro%0Ale\n\nt\n") and got[2]["loss_chars"] == 0 and got[None]["n_turns"] == 1
    assert chat.digest(chat.examples(turns.where("conv_id < 0"))).count() == 0


def test_added_spans_need_evidence():
    found = pii.find_spans("IBAN DE89 3704 0044 0532 0130 00, ssn 123-45-6789, card 378282246310005")
    assert [f[0] for f in found] == ["iban", "card_short", "ssn"]
    assert pii.find_spans("call 123-45-6789") == [] and pii.find_spans("") == []


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "one x two y three"), (2, "one two"), (3, "three far " + "z " * 30 + "one two")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    tests = decontamination.TestSet(items)
    index = decontamination.Index(docs, tests, phrases_only=False)
    found = decontamination.proximity_matches(index, tests, slack=3).join(index.documents, "uid")
    assert [(r["id"], r["start"], r["end"]) for r in found.collect()] == [(1, 0, 5)]


def test_proximity_sweeps_all_postings(spark):
    """Against a plain search, with terms on both sides of the rarest one and repeated terms."""
    import random

    rnd = random.Random(5)
    texts = [(0, "b x a x x b c")] + [(i, " ".join(rnd.choice("aabbccxyz") for _ in range(rnd.randint(0, 25)))) for i in range(1, 60)]
    terms, slack = ("a", "b", "c"), 2
    tests = decontamination.TestSet(spark.createDataFrame([(1, "a b c")], "item_id long, text string"))
    index = decontamination.Index(spark.createDataFrame(texts, "doc_id long, text string"), tests, phrases_only=False)
    got = {}
    for r in decontamination.proximity_matches(index, tests, slack).join(index.documents, "uid").collect():
        got.setdefault(r["id"], set()).add((r["start"], r["end"]))
    counts = {t: sum(text.split().count(t) for _, text in texts) for t in terms}
    rare = min(terms, key=lambda t: (counts[t], terms.index(t)))
    want = {}
    for key, text in texts:
        words = text.split()
        for anchor in (i for i, w in enumerate(words) if w == rare):
            found = [(e - s, s, e) for s in range(anchor + 1) for e in range(anchor + 1, len(words) + 1)
                     if e - s <= len(terms) + slack and words[s] in terms and set(terms) <= set(words[s:e])]
            if found:
                want.setdefault(key, set()).add(min(found)[1:])
    assert got == want and got[0] == {(2, 7)}


@pytest.mark.parametrize("slack", [0, 2, 5])
def test_nearby_windows_through_the_pruned_index(spark, slack):
    """Long, short, repeated and one-word items; documents with their words shuffled, spread or doubled, and without any."""
    import random

    rnd = random.Random(slack)
    vocabulary = [f"t{i}" for i in range(40)]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(n))) for i, n in enumerate([14, 11, 10, 6, 3, 2, 1, 12, 0])] + [(9, "t1 t1 t1"), (10, None), (11, "t1 t1 t1")]
    docs = [(0, None), (1, ""), (2, "??"), (3, "t1 " * 3)]
    for key in range(4, 80):
        words = [rnd.choice([*vocabulary, *(f"u{i}" for i in range(60))]) for _ in range(rnd.randint(0, 30))]
        planted = rnd.choice(items)[1] or ""
        planted = [w for x in planted.split() for w in ([x, "gap"] if rnd.random() < 0.15 else [x])]
        if rnd.random() < 0.5:
            rnd.shuffle(planted)
        docs.append((key, " ".join(words[:9] + planted + words[9:])))
    found = decontamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), slack=slack)
    got = {r["doc_id"]: (sorted(r["items"]), sorted(r["near_items"])) for r in found.collect()}
    near, exact = brute.near_items(docs, items, slack=slack), brute.decontaminate(docs, items)
    assert {k: v[1] for k, v in got.items()} == near and {k: len(v[0]) for k, v in got.items()} == {k: v[2] for k, v in exact.items()}
    assert all(set(a) <= set(b) for a, b in got.values()) and any(set(a) < set(b) for a, b in got.values())
