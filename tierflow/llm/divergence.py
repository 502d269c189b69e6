r"""Source divergence audit: how far the term shares of the sources of a language lie apart.

Identical texts of a language are collapsed into one with its multiplicity per source, so that every text is tokenized
once however often it was copied; counts and document frequencies are weighted by the multiplicities. A bitmap of fixed size
tells the texts that certainly have no copy: they are groups of one and need not be shuffled. Terms are runs of
``[^\x00-\x40\x5B-\x60\x7B-\x7F]`` after lower-casing A-Z. A language keeps the V terms that at least ``least`` of its
documents hold. A group (language, source), and the whole language, gives a kept term with ``count`` occurrences the
share ``1 + floor(10^9 (count + 2) / (N + 2 V))``, N being the sum of its counts. The divergence of shares p and q is
``floor((p - q)^2 / (p + q))``, in integers throughout.

Pairs are evaluated sparsely: terms that neither group has all diverge by the same, terms of one group only are summed
over its distinct shares, and only terms that both have are joined.

Defined cases: null texts, languages and sources count as empty strings; a group without terms takes part with its even
shares; a language without kept terms has pairs of value 0 and no terms; equal values rank by item in UTF-8 order;
repeated rows count as often as they occur; an empty table gives an empty one; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize
from . import packed
from .bitmaps import BITS, bitmap, contains

CHUNK_BYTES = 1 << 22

#: Bytes of terms as they are, A-Z in lower case; a space for all others.
_TERM_BYTES = np.array([b if b >= 0x80 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)], dtype=np.uint8)
SHARE_UNITS = 1_000_000_000


def _rows(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"), (text, "text"))])


def _repeated_rows(flags: np.ndarray):
    def tasks(batches):
        for batch in batches:
            yield batch.filter(pa.array(contains(flags, batch.column(3).to_numpy()))).select([0, 1, 2])

    return tasks


def repeated_texts(rows: DataFrame, bits: int = BITS) -> np.ndarray:
    """A bitmap of fixed size with the hash of every text that its language has more than once; it may hold others too."""
    return bitmap(rows.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1"), F.col("hash"), bits)


def collapse(rows: DataFrame, flags: np.ndarray) -> DataFrame:
    """``(lang, text, sources)``: the flagged texts of a language once, with ``array<struct<source, n>>``.

    Copies are counted in narrow rows by their hash; one of them carries the text to those counts.
    """
    several = rows.select("lang", "source", "text", "hash").mapInArrow(_repeated_rows(flags), "lang string, source string, text string")
    several = several.withColumn("mark", F.unhex(F.md5(F.col("text").cast("binary"))))
    copies = several.groupBy("mark", "lang", "source").agg(F.count("*").alias("n"))
    copies = copies.groupBy("mark", "lang").agg(F.collect_list(F.struct("source", "n")).alias("sources"))
    return several.groupBy("mark", "lang").agg(F.first("text").alias("text")).join(copies, ["mark", "lang"]).select("lang", "text", "sources")


def _sums(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys with the sums of their values."""
    order = np.argsort(keys, kind="stable")
    first = np.flatnonzero(np.r_[True, keys[order][1:] != keys[order][:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[order][first], *[np.add.reduceat(v[order], first) if len(first) else v for v in values]


def _term_rows(flags: np.ndarray | None):
    """Partial counts of the terms of each group, some megabytes of text at a time. With ``flags``, only of texts that are not in them."""
    def tasks(batches):
        for batch in batches:
            if flags is not None:
                batch = batch.filter(pa.array(~contains(flags, batch.column(3).to_numpy())))
            for rows, data, offsets in packed.chunks(batch.column(1), size=CHUNK_BYTES):
                texts = pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(_TERM_BYTES[data]))
                words = pc.split_pattern(texts, " ")
                terms = words.flatten().dictionary_encode()
                codes, row = terms.indices.to_numpy(), np.repeat(np.arange(len(words)), np.diff(words.offsets.to_numpy()))
                size = max(len(terms.dictionary), 1)
                empty = pc.index(terms.dictionary, "").as_py()
                keys, times = _sums((row * size + codes)[codes != empty], np.ones(np.count_nonzero(codes != empty), np.int64))
                row, codes = keys // size, keys % size

                lists = batch.column(2).slice(rows.start, len(words))
                lang, source = (x.dictionary_encode() for x in (batch.column(0).slice(rows.start, len(words)), lists.flatten().field(0)))
                first = lists.offsets.to_numpy() - lists.offsets[0].as_py()
                of_row = np.diff(first)
                copy = np.repeat(first[:-1][row], of_row[row]) + _counted(of_row[row])
                n = lists.flatten().field(1).to_numpy()[copy]
                names = max(len(source.dictionary), 1)
                group = np.repeat(lang.indices.to_numpy()[row].astype(np.int64), of_row[row]) * names + source.indices.to_numpy()[copy]
                keys, n, docs = _sums(group * size + np.repeat(codes, of_row[row]), n * np.repeat(times, of_row[row]), n)
                group, codes = keys // size, keys % size
                yield pa.RecordBatch.from_arrays(
                    [lang.dictionary.take(pa.array(group // names)), source.dictionary.take(pa.array(group % names)), terms.dictionary.take(pa.array(codes)), pa.array(n), pa.array(docs)],
                    ["lang", "source", "term", "n", "docs"],
                )

    return tasks


def _counted(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... inside each run of the given sizes."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", bits: int = BITS) -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences and documents of each term, each text of a language tokenized once."""
    rows = _rows(docs, text, lang, source).withColumn("hash", F.xxhash64("lang", "text"))
    flags = repeated_texts(rows, bits)
    own = F.array(F.struct("source", F.lit(1).cast("long").alias("n"))).alias("sources")
    schema = "lang string, source string, term string, n long, docs long"
    single = rows.select("lang", "text", own, "hash").mapInArrow(_term_rows(flags), schema)
    several = collapse(rows, flags).mapInArrow(_term_rows(None), schema)
    return single.union(several).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """``1 + floor(10^9 (count + 2) / (total + 2 kept))``, exact for any long count; null without kept terms."""
    top = (count + 2).cast("decimal(20,0)") * F.lit(SHARE_UNITS).cast("decimal(10,0)")
    whole = F.call_function("div", top, (total + 2 * kept).cast("decimal(20,0)"))
    return F.when(kept > 0, whole + 1)


def gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def shares(counts: DataFrame, names: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """The groups ``(lang, source, kept, p0)``, p0 the share of an absent term, and their kept terms ``(lang, source, term, p, q)``."""
    term = Window.partitionBy("lang", "term")  # a row for each source
    known = counts.withColumns({"lang_docs": F.sum("docs").over(term), "lang_n": F.sum("n").over(term), "number": F.row_number().over(term.orderBy("source"))})
    known = known.where(F.col("lang_docs") >= least).select("lang", "source", "term", "n", "lang_n", "number")
    known = materialize(known, "known-terms")
    langs = known.groupBy("lang").agg(F.count_if(F.col("number") == 1).alias("kept"), F.sum("n").alias("lang_total"))
    totals = known.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = names.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.fillna(0, ["total", "kept", "lang_total"]).withColumn("p0", share(F.lit(0).cast("long"), F.col("total"), F.col("kept")))
    groups = materialize(groups, "groups")
    known = known.join(groups, ["lang", "source"])
    p = share(F.col("n"), F.col("total"), F.col("kept"))
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))
    return groups.select("lang", "source", "kept", "p0"), known.select("lang", "source", "term", "p0", p.alias("p"), q.alias("q"))


def pair_values(groups: DataFrame, terms: DataFrame) -> DataFrame:
    """``(lang, source, item, value)`` for every two sources of a language, both ways."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select("lang", *[F.col(c).alias(f"{c}_{name}") for c in df.columns if c != "lang"])

    one, two = side(groups, "a"), side(groups, "b")
    absent = gap(F.col("p0_a"), F.col("p0_b"))
    neither = one.join(two, "lang").where("source_a < source_b")
    neither = neither.select("lang", "source_a", "source_b", F.coalesce(F.col("kept_a") * absent, F.lit(0)).alias("value"))

    levels = terms.groupBy("lang", "source", "p0", "p").agg(F.count("*").alias("times"))
    single = side(levels, "a").join(two, "lang").where("source_a <> source_b")
    single = single.select(
        "lang", F.least("source_a", "source_b").alias("source_a"), F.greatest("source_a", "source_b").alias("source_b"),
        (F.col("times_a") * (gap(F.col("p_a"), F.col("p0_b")) - absent)).alias("value"),
    )
    held = terms.drop("q")
    both = held.select("lang", "term", *[F.col(c).alias(f"{c}_a") for c in ("source", "p0", "p")]).join(
        held.select("lang", "term", *[F.col(c).alias(f"{c}_b") for c in ("source", "p0", "p")]), ["lang", "term"]
    ).where("source_a < source_b")
    value = gap(F.col("p_a"), F.col("p_b")) - gap(F.col("p_a"), F.col("p0_b")) - gap(F.col("p0_a"), F.col("p_b")) + absent
    both = both.select("lang", "source_a", "source_b", value.alias("value"))
    summed = [df.groupBy("lang", "source_a", "source_b").agg(F.sum("value").alias("value")) for df in (single, both)]
    whole = neither.union(summed[0]).union(summed[1]).groupBy("lang", "source_a", "source_b").agg(F.sum("value").alias("value"))
    whole = materialize(whole, "pairs")
    back = whole.select("lang", F.col("source_b").alias("source"), F.col("source_a").alias("item"), "value")
    return whole.select("lang", F.col("source_a").alias("source"), F.col("source_b").alias("item"), "value").union(back)


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = 10, top: int = 10) -> DataFrame:
    """``(lang, source, part, item, value, rank)``.

    Part ``pair`` ranks for each group the other sources of its language by divergence; part ``term`` its ``top`` kept
    terms with the largest divergence from the language among those that it has more often.
    """
    rows = docs.select(lang, source, text)
    names = rows.select(F.coalesce(F.col(lang), F.lit("")).alias("lang"), F.coalesce(F.col(source), F.lit("")).alias("source")).distinct()
    counts = materialize(term_counts(rows, text, lang, source), "term-counts")
    groups, terms = shares(counts, names, least)
    terms = materialize(terms, "shares")
    ranks = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    over = terms.where("p > q").select("lang", "source", F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    parts = [("pair", pair_values(groups, terms).withColumn("rank", ranks)), ("term", over.withColumn("rank", ranks).where(F.col("rank") <= top))]
    pair, term = (df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank") for part, df in parts)
    return pair.union(term)
