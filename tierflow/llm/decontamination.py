r"""Benchmark decontamination by a distributed positional inverted index.

Words are runs of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after lower-casing A-Z. A test *window* is ``window`` consecutive
words of an item; an item with fewer words, but not none, is one window. The index holds postings ``(term, document,
position)``; per window the lists of its terms are intersected, each shifted by the term's offset in the window, from the
rarest term on. What is left are exact phrase matches.

A posting is stored if a query can ask for it: its term occurs in a test window (a fixed-size bitmap of term hashes says
so, which may let other terms in, never leave one out), and it lies in a run of such terms at least as long as the
windows are (exact phrases), or in reach of a place where a window's first lead term has its second and third in reach
(proximity; the lead terms of a window are those that the fewest windows have). A window is met *nearby* where all its terms
occur, in any order, within its length plus ``slack`` words; an exact phrase is such a place too.

Defined cases: a null text has no words; items without words match nothing; equal items are hit together; a null item id
is listed as an empty string; rows with equal ids are matched each on its own; empty tables give empty or all-clean
results; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..runtime import materialize
from . import packed
from .bitmaps import BITS, bitmap, contains

WINDOW = 10
SLACK = 2


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, at = packed.word_spans(data, offsets, packed.ALNUM)
    return packed.span_hashes(data, starts, ends), packed.row_starts(at, len(offsets) - 1)


def _window_rows(window: int):
    def tasks(batches):
        for batch in batches:
            items = batch.column(1)
            for rows, data, offsets in packed.chunks(batch.column(0), lower=True):
                terms, bounds = _words(data, offsets)
                size = np.diff(bounds)
                whole = packed.whole_windows(bounds, window)
                short = np.flatnonzero((size > 0) & (size < window))
                first = np.concatenate([whole, bounds[short]])
                row = np.concatenate([np.searchsorted(bounds, whole, side="right") - 1, short])
                length = np.concatenate([np.full(len(whole), window), size[short]])
                if not len(first):
                    continue
                inside = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
                flat = packed.signed(terms[np.repeat(first, length) + inside])
                yield pa.RecordBatch.from_arrays(
                    [items.take(pa.array(row + rows.start)), packed.list_rows(flat, np.r_[0, np.cumsum(length)])], ["item", "terms"]
                )

    return tasks


class TestSet:
    """The windows of the test items: ``windows`` (sid, terms), each word sequence once, and ``items`` (sid, item).

    With ``slack`` an index for proximity searches of up to that slack can leave out what they do not ask for.
    """

    def __init__(self, items: DataFrame, key: str = "item_id", text: str = "text", window: int = WINDOW, bits: int = BITS, slack: int | None = None):
        self.window, self.slack = window, slack
        kind = items.select(key).schema[0].dataType.simpleString()
        rows = items.select(F.col(text).alias("text"), F.col(key).alias("item"))
        found = rows.mapInArrow(_window_rows(window), f"item {kind}, terms array<long>")
        found = materialize(found.withColumn("sid", F.xxhash64("terms")).distinct(), "test-windows")
        self.windows = found.groupBy("sid").agg(F.first("terms").alias("terms"))
        self.items = found.select("sid", F.coalesce(F.col("item").cast("string"), F.lit("")).alias("item")).distinct()
        sizes = found.where(F.size("terms") < window).agg(F.min(F.size("terms"))).first()
        self.shortest = sizes[0] or window
        terms = found.select(F.size("terms").alias("n"), F.explode("terms").alias("term"))
        self.long_terms = bitmap(terms.where(F.col("n") == window), F.col("term"), bits)
        self.short_terms = bitmap(terms.where(F.col("n") < window), F.col("term"), bits)
        self.leads = None if slack is None else self._lead_terms(terms, bits)

    def _lead_terms(self, terms: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Bitmaps of the windows' first lead terms, and of these with the second and with the third (the last one again if there is none)."""
        times = terms.groupBy("term").agg(F.count("*").alias("times"))
        own = self.windows.select("sid", F.explode(F.array_distinct("terms")).alias("term")).join(times, "term")
        own = own.groupBy("sid").agg(F.array_sort(F.collect_list(F.struct("times", "term"))).alias("by"))
        leads = own.select(*[F.element_at("by", F.least(F.lit(k), F.size("by")))["term"].alias(f"t{k}") for k in (1, 2, 3)])
        pairs = [leads.select(F.expr(f"t1 ^ ((t{k} << {k}) | (t{k} >>> {64 - k}))").alias("pair")) for k in (2, 3)]
        return bitmap(leads, F.col("t1"), bits), bitmap(pairs[0].union(pairs[1]), F.col("pair"), bits)


def _in_runs(flags: np.ndarray, bounds: np.ndarray, least: int) -> np.ndarray:
    """The flags that lie in a run of at least ``least`` set flags of one row."""
    if least <= 1 or not flags.any():
        return flags
    edge = np.zeros(len(flags) + 1, dtype=bool)
    edge[bounds[:-1]] = True
    edge = edge[:len(flags)]
    start = np.flatnonzero(flags & (edge | ~np.r_[False, flags[:-1]]))
    stop = np.flatnonzero(flags & np.r_[~flags[1:] | edge[1:], True]) + 1
    long = stop - start >= least
    delta = np.zeros(len(flags) + 1, dtype=np.int32)
    delta[start[long]] += 1
    delta[stop[long]] -= 1
    return np.cumsum(delta[:-1]) > 0


def _in_reach(terms: np.ndarray, bounds: np.ndarray, leads: tuple[np.ndarray, np.ndarray], reach: int) -> np.ndarray:
    """Flags of the words less than ``reach`` from a first lead term that has a second and a third one of its windows as near, all in one row."""
    first, pairs = leads
    at = np.flatnonzero(contains(first, terms))
    for k in (2, 3):
        row = np.searchsorted(bounds, at, side="right") - 1
        low, high = np.maximum(bounds[row], at - reach + 1), np.minimum(bounds[row + 1], at + reach)
        met = np.zeros(len(at), dtype=bool)
        for shift in range(1 - reach, reach):
            other = at + shift
            near = terms[np.where((other >= low) & (other < high), other, at)]
            met |= contains(pairs, terms[at] ^ (near << np.uint64(k) | near >> np.uint64(64 - k)))
        at, low, high = at[met], low[met], high[met]
    delta = np.zeros(len(terms) + 1, dtype=np.int64)
    np.add.at(delta, low, 1)
    np.add.at(delta, high, -1)
    return np.cumsum(delta[:-1]) > 0


def _index_rows(tests: tuple, runs: bool):
    long_terms, short_terms, window, shortest, leads, slack = tests

    def tasks(batches):
        for batch in batches:
            keys = batch.column(1)
            for rows, data, offsets in packed.chunks(batch.column(0), lower=True):
                terms, bounds = _words(data, offsets)
                wanted, brief = contains(long_terms, terms), contains(short_terms, terms)
                near = wanted | brief
                if runs:
                    wanted, brief = _in_runs(wanted, bounds, window), _in_runs(brief, bounds, shortest)
                if leads is not None:
                    near &= _in_reach(terms, bounds, leads, window + slack)
                at = np.flatnonzero(wanted | brief | near if leads is not None else wanted | brief)
                row = np.searchsorted(bounds, at, side="right") - 1
                where = packed.row_starts(row, len(offsets) - 1)
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(rows.start, len(offsets) - 1), pa.array(np.diff(bounds).astype(np.int64)), packed.list_rows(packed.signed(terms[at]), where),
                     packed.list_rows((at - bounds[row]).astype(np.int32), where)],
                    ["id", "n_words", "terms", "positions"],
                )

    return tasks


class Index:
    """The stored index: ``documents`` (uid, id, n_words) and ``postings`` (term, uid, position).

    It answers phrase searches, and proximity searches up to the slack of the test set; with ``phrases_only`` false, of any slack.
    """

    def __init__(self, docs: DataFrame, tests: TestSet, key: str = "doc_id", text: str = "text", phrases_only: bool = True):
        kind = docs.select(key).schema[0].dataType.simpleString()
        rows = docs.select(F.col(text).alias("text"), F.col(key).alias("id"))
        bits = (tests.long_terms, tests.short_terms, tests.window, tests.shortest, tests.leads if phrases_only else None, tests.slack)
        built = rows.mapInArrow(_index_rows(bits, phrases_only), f"id {kind}, n_words long, terms array<long>, positions array<int>")
        stored = materialize(built.withColumn("uid", F.monotonically_increasing_id()), "index")
        self.documents = stored.select("uid", "id", "n_words")
        zipped = F.explode(F.arrays_zip("terms", "positions")).alias("p")
        self.postings = stored.where(F.size("terms") > 0).select("uid", zipped).select(F.col("p.terms").alias("term"), "uid", F.col("p.positions").alias("position"))


def _ranked(index: Index, tests: TestSet) -> DataFrame:
    """``(sid, n, rank, offset, term)``: the terms of each window from the rarest on; windows with a term that has no posting go."""
    counts = index.postings.groupBy("term").agg(F.count("*").alias("times"))
    terms = tests.windows.select("sid", F.size("terms").alias("n"), F.posexplode("terms").alias("offset", "term"))
    terms = terms.join(counts, "term")
    order = Window.partitionBy("sid").orderBy("times", "offset")
    whole = Window.partitionBy("sid")
    ranked = terms.withColumns({"rank": F.row_number().over(order), "found": F.count("*").over(whole)})
    return ranked.where("found = n").select("sid", "n", "rank", "offset", "term")


def phrase_matches(index: Index, tests: TestSet) -> DataFrame:
    """``(sid, uid, start, n)``: every occurrence of a test window in a document."""
    ranked = materialize(_ranked(index, tests), "ranked")
    rarest = ranked.where("rank = 1").join(index.postings, "term")
    found = rarest.select("sid", "n", "uid", (F.col("position") - F.col("offset")).alias("start")).where("start >= 0")
    for rank in (2, 3):  # shifted lists of the next terms, while they cut the candidates most
        following = ranked.where(F.col("rank") == rank).select("sid", "offset", "term")
        asked = found.join(following, "sid", "left").withColumn("position", F.col("start") + F.col("offset"))
        has = asked.where("term IS NOT NULL").join(index.postings, ["term", "uid", "position"], "left_semi")
        found = has.select("sid", "n", "uid", "start").union(asked.where("term IS NULL").select("sid", "n", "uid", "start"))
        found = materialize(found, "intersected")
    done = found.where("n <= 3")
    rest = found.where("n > 3").join(ranked.where("rank > 3").select("sid", "offset", "term"), "sid")
    rest = rest.withColumn("position", F.col("start") + F.col("offset")).join(index.postings, ["term", "uid", "position"])
    rest = rest.groupBy("sid", "n", "uid", "start").agg(F.count("*").alias("found")).where("found = n - 3")
    return done.select("sid", "uid", "start", "n").union(rest.select("sid", "uid", "start", "n"))


def proximity_matches(index: Index, tests: TestSet, slack: int, without: DataFrame | None = None) -> DataFrame:
    """``(sid, uid, start, end)``: places where all terms of a window occur, in any order, within its length plus ``slack`` words.

    For every posting of a window's rarest term: the shortest such place with it (the first of equally short ones). All
    postings in reach are swept, from each of them on the nearest one of every term. Needs an index made for that slack or
    for any; a term that a window has twice may be met by one posting. Pairs ``(sid, uid)`` of ``without`` are not searched.
    """
    ranked = materialize(_ranked(index, tests), "ranked")
    anchor = ranked.where("rank = 1").join(index.postings, "term").select("sid", "n", "uid", F.col("position").alias("anchor"))
    if without is not None:
        anchor = anchor.join(without, ["sid", "uid"], "left_anti")
    reach, width = F.col("n") + F.lit(slack), F.lit(tests.window + slack)
    cell = F.floor(F.col("anchor") / width)
    terms = ranked.select("sid", "term").distinct()
    asked = anchor.join(terms, "sid").withColumn("cell", F.explode(F.sequence(cell - 1, cell + 1)))
    others = index.postings.withColumn("cell", F.floor(F.col("position") / width))
    near = asked.join(others, ["term", "uid", "cell"]).where(F.abs(F.col("position") - F.col("anchor")) < reach)
    near = materialize(near.select("sid", "uid", "anchor", "n", "term", "position"), "near")
    place = ["sid", "uid", "anchor"]
    kinds = terms.groupBy("sid").agg(F.count("*").alias("kinds"))
    whole = near.groupBy(*place).agg(F.count_distinct("term").alias("found")).join(kinds, "sid").where("found = kinds")
    near = materialize(near.join(whole.select(*place), place, "left_semi"), "near-whole")
    starts = near.where(F.col("position") <= F.col("anchor")).select(*place, F.col("position").alias("start"))
    swept = starts.join(near, place).where((F.col("position") >= F.col("start")) & (F.col("position") < F.col("start") + reach))
    nearest = swept.groupBy(*place, "n", "start", "term").agg(F.min("position").alias("position"))
    spans = nearest.groupBy(*place, "n", "start").agg(F.count("*").alias("found"), F.greatest(F.max("position") + 1, F.col("anchor") + 1).alias("end"))
    spans = spans.join(kinds, "sid").where((F.col("found") == F.col("kinds")))
    best = spans.groupBy(*place).agg(F.min(F.struct((F.col("end") - F.col("start")).alias("span"), "start", "end")).alias("best"))
    return best.select("sid", "uid", "best.start", "best.end").distinct()


def _items_of(matches: DataFrame, tests: TestSet, alias: str) -> DataFrame:
    named = matches.join(tests.items, "sid").groupBy("uid")
    return named.agg(F.array_sort(F.collect_set("item")).alias(alias))


def contaminated(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW,
    slack: int | None = None,
) -> DataFrame:
    """``(key, n_words, n_hit, n_items, items, contaminated)`` per row: ``items`` are the ids, as sorted strings, of items with an occurring window.

    With ``slack`` also ``near_items``: the items with a window that is met nearby, those of ``items`` among them.
    """
    tests = TestSet(items, item, item_text, window, slack=slack)
    index = Index(docs, tests, key, text)
    matches = materialize(phrase_matches(index, tests), "matches")
    covered = matches.select("uid", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("position")).distinct()
    hits = covered.groupBy("uid").agg(F.count("*").alias("n_hit"))
    exact = matches.select("sid", "uid").distinct()
    whole = index.documents.join(hits, "uid", "left").join(_items_of(exact, tests, "items"), "uid", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")

    def listed(name: str):
        return F.coalesce(name, F.array().cast("array<string>"))

    columns = [
        F.col("id").alias(key), "n_words", n_hit.alias("n_hit"), F.size(listed("items")).cast("long").alias("n_items"), listed("items").alias("items"),
        (n_hit > 0).alias("contaminated"),
    ]
    if slack is not None:
        exact = materialize(exact, "exact")
        near = proximity_matches(index, tests, slack, without=exact).select("sid", "uid").distinct().union(exact)
        whole = whole.join(_items_of(near, tests, "near_items"), "uid", "left")
        columns.append(listed("near_items").alias("near_items"))
    return whole.select(*columns)


def drop_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows without any hit, columns as they were. Rows with an equal id and an equal text share one verdict."""
    marked = docs.select(F.struct(F.col(key), F.xxhash64(text).alias("mark")).alias("row"), F.col(text).alias("text"))
    found = contaminated(marked, items, "row", "text", window=window).where("contaminated").select("row").distinct()
    same = docs[key].eqNullSafe(found["row"][key]) & (F.xxhash64(docs[text]) == found["row"]["mark"])
    return docs.join(found, same, "left_anti")
