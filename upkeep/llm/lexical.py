"""Ranked lexical search: BM25-like integer scores as inner products, with documents in buckets of equal vector length.

A document is a vector of impacts (what a term's occurrences give), an item a vector of term weights, and a score their inner product. Only
terms of items matter: a bitmap of SLOTS bits of the items' terms, of that size whatever their number, lets the documents'
pass drop others; a term it lets through by chance only makes a vector longer.

Documents are dealt to buckets by the length of their vector, 8 to a doubling; a large bucket is cut into parts. The longest
ones are searched first and give each item a lower bound of its k-th score; then the others. A bucket whose length times the
item's is below the bound is left out (Cauchy-Schwarz). Inside, the item's FOCUS heaviest coordinates are added up, and
a document stays if these, and the product of what both vectors have left, can reach the bound. Survivors are scored
exactly in integers.
"""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from upkeep.llm.cells import block_count, dealt, in_cells, numbered
from upkeep.llm.common import dropped, slices, written

SLOT_BITS = 20
STEPS = 8  # buckets to a doubling of length
DOCUMENTS, TERMS = 4096, 1 << 20  # of a bucket's part, about
ITEMS = 1024  # of a block of items
FOCUS = 8  # coordinates that are added up before bounds decide
FIRST = 16  # the longest 1 / FIRST of the documents give the bounds
SURE = 1 + 1e-9  # doubles bound integers with room for their rounding
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(df: DataFrame, text: str, slots: bytes | None) -> DataFrame:
    """(row, key, n, terms, tf) of (row, key, text): n counts all terms, terms and tf those that `slots` lets through, if given."""

    def count(batches):
        for b in slices(batches, "text", 1 << 20):
            n, terms, tf = [], [], []
            for t in b.column("text").to_pylist():
                found = ("" if t is None else t).encode().translate(_TERM).split()
                n.append(len(found))
                own = Counter(found)
                if slots is not None:
                    own = {w: c for w, c in own.items() if slots[zlib.crc32(w) >> 32 - SLOT_BITS]}
                terms.append(list(own))
                tf.append(list(own.values()))
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("key"), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.binary())), pa.array(tf, pa.list_(pa.int64()))], ["row", "key", "n", "terms", "tf"])

    kind = dict(df.dtypes)["key"]
    return df.select("row", "key", F.col(text).alias("text")).mapInArrow(count, f"row long, key {kind}, n long, terms array<binary>, tf array<long>")


class Bucket:
    """Documents of about one vector length, with the postings of their terms and of those of the items."""

    def __init__(self, docs: pa.Table, items: pa.Table):
        self.docs = docs.sort_by([("key", "ascending"), ("row", "ascending")])  # nulls come last
        lists = self.docs["terms"].combine_chunks()
        of_items = items["terms"].combine_chunks()
        both = pa.concat_arrays([lists.flatten(), of_items.flatten()]).dictionary_encode().indices.to_numpy()
        own = both[: len(lists.flatten())]
        self.item_terms = np.split(both[len(own) :], np.cumsum(np.diff(np.asarray(of_items.offsets)))[:-1])
        by = np.argsort(own, kind="stable")
        at = np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets)))
        self.at, self.impact = at[by], np.asarray(self.docs["impacts"].combine_chunks().flatten())[by]
        self.cut = np.searchsorted(own[by], np.arange(both.max(initial=-1) + 2))
        self.square = np.asarray(self.docs["square"])
        self.length = math.sqrt(self.square.max(initial=0.0))

    def best(self, item: int, weights: np.ndarray, bound: int | None, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, exact scores) of the best k that reach `bound` and are above 0, ties by key."""
        none = np.zeros(0, np.int64)
        terms = self.item_terms[item]
        here = (self.cut[terms + 1] > self.cut[terms]) & (weights > 0)
        terms, weights = terms[here], weights[here]
        if not len(terms) or math.sqrt(float((weights.astype(float) ** 2).sum())) * self.length * SURE < (bound or 1):
            return none, none
        by = np.argsort(-weights, kind="stable")
        posted = [slice(self.cut[t], self.cut[t + 1]) for t in terms[by]]
        weights = weights[by]
        score, seen = np.zeros(len(self.square), np.int64), np.zeros(len(self.square))
        for w, p in zip(weights[:FOCUS], posted[:FOCUS]):
            score[self.at[p]] += w * self.impact[p]
            seen[self.at[p]] += self.impact[p].astype(float) ** 2
        left = math.sqrt(float((weights[FOCUS:].astype(float) ** 2).sum()))
        upper = (score + left * np.sqrt(np.maximum(self.square * SURE - seen, 0))) * SURE
        alive = upper >= (bound or 1)

        def finish(chosen):
            for w, p in zip(weights[FOCUS:], posted[FOCUS:]):
                at = self.at[p]
                inside = chosen[at]
                score[at[inside]] += w * self.impact[p][inside]

        if bound is None and alive.sum() > k:
            guess = np.zeros(len(alive), bool)
            guess[np.argpartition(upper, len(upper) - k)[-k:]] = True
            finish(guess)
            bound = max(int(score[guess].min()), 1)
            alive = (upper >= bound) & ~guess
            finish(alive)
            alive |= guess
        else:
            finish(alive)
        found = np.flatnonzero(alive)
        found = found[score[found] >= (bound or 1)]
        found = found[np.lexsort((found, -score[found]))][:k]
        return found, score[found]


def _searcher(k: int):
    def search(docs: pa.Table, items: pa.Table) -> pa.Table:
        of, found, scores = [], [], []
        if docs.num_rows and items.num_rows:
            bucket = Bucket(docs, items)
            weights = items["weights"].to_pylist()
            for i, bound in enumerate(items["bound"].to_pylist()):
                at, score = bucket.best(i, np.array(weights[i], np.int64), bound, k)
                of.append(np.full(len(at), i))
                found.append(at)
                scores.append(score)
            docs = bucket.docs
        of, found = (pa.array(np.concatenate(x) if x else [], pa.int64()) for x in (of, found))
        return pa.table({"item_row": items["row"].take(of), "item_key": items["key"].take(of), "row": docs["row"].take(found), "key": docs["key"].take(found),
                         "score": pa.array(np.concatenate(scores) if scores else [], pa.int64())})

    return search


def lexical_search(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", k: int = 20) -> DataFrame:
    """(<item_key>, rank, <key>, score): for each item the k documents with the highest score above 0, ties by key, null keys last.

    Terms are runs of digits, letters and what is not ASCII, A-Z as a-z; a null text has none. With N documents that have terms,
    L terms in all, a document's n and tf, a term's df: weight floor(1000 ln((2N + 2) / (2df + 1))), m = 75 + 25nN div L,
    and the score is the sum over the item's terms, repeats included, of weight * (10^9 tf div (1000 tf + 12m)).

    Rows that repeat a key are documents, or items, of their own. An item without terms has no rows, an empty table gives
    an empty table; other columns have no effect.
    """
    spark = docs.sparkSession
    name = lambda c: F.col(f"`{c}`")
    wanted = written(term_counts(numbered(items.select(name(item_key).alias("key"), name(item_text).cast("string").alias("text"))), "text", None), "items")
    slot = F.shiftrightunsigned(F.crc32("term"), 32 - SLOT_BITS).cast("int")
    slots = bytearray(1 << SLOT_BITS)
    for r in wanted.select(F.explode("terms").alias("term")).select(slot.alias("slot")).distinct().toLocalIterator():  # at most as many as slots
        slots[r["slot"]] = 1
    counted = written(term_counts(numbered(docs.select(name(key).alias("key"), name(text).cast("string").alias("text"))), "text", bytes(slots)), "terms")
    total, words, asked = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first() + (wanted.count(),)

    often = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(1000 * F.log((2.0 * total + 2) / (2.0 * F.col("df") + 1))).cast("long")
    weighed = wanted.select("row", F.arrays_zip("terms", "tf").alias("own")).select("row", F.inline("own")).withColumnRenamed("terms", "term").join(often, "term")
    blocks = block_count(asked, ITEMS, 1, ITEMS)
    asks = weighed.select("row", "term", (weight * F.col("tf")).alias("weight")).groupBy("row").agg(F.collect_list(F.struct("term", "weight")).alias("own"))
    asks = asks.join(wanted.select("row", "key"), "row").select("row", "key", F.col("own.term").alias("terms"), F.col("own.weight").alias("weights"), dealt(F.col("row"), blocks).alias("part"))
    asks = written(asks, "asks")

    m = 75 + F.expr(f"(25 * n * {total}L) div {max(words, 1)}L")
    vectors = counted.where(F.size("terms") > 0).withColumn("m", m).select(
        "row", "key", "terms", F.expr("transform(tf, t -> (1000000000L * t) div (1000L * t + 12L * m))").alias("impacts"))
    vectors = vectors.withColumn("square", F.aggregate("impacts", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))).where("square > 0")
    vectors = vectors.withColumn("level", F.floor(F.log2("square") * (STEPS / 2)).cast("int"))
    levels = vectors.groupBy("level").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.size("terms")).alias("terms"))
    longer = Window.orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, -1)
    levels = levels.select("level", F.ceil(F.greatest(F.col("docs") / DOCUMENTS, F.col("terms") / TERMS)).cast("int").alias("parts"), (F.coalesce(F.sum("docs").over(longer), F.lit(0)) * FIRST < F.sum("docs").over(Window.partitionBy())).alias("first"))
    levels = written(levels, "levels")  # a double has at most 2048 * STEPS levels
    block = lambda part: F.col("level").cast("long") * F.lit(1 << 32) + part
    bucketed = vectors.join(F.broadcast(levels), "level").withColumn("block", block(dealt(F.col("row"), F.col("parts")))).select("row", "key", "terms", "impacts", "square", "block", "first")
    bucketed = written(bucketed, "buckets")
    places = levels.select(F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("n"), "level", "first").select(block(F.col("n")).alias("block"), "first")

    kinds = (dict(items.select(name(item_key).alias("k")).dtypes)["k"], dict(docs.select(name(key).alias("k")).dtypes)["k"])
    schema = f"item_row long, item_key {kinds[0]}, row long, key {kinds[1]}, score long"

    def searched(which, asks):
        return in_cells(bucketed.where(which).drop("first"), asks, blocks, places.where(which), _searcher(k), schema)

    order = Window.partitionBy("item_row").orderBy(F.desc("score"), F.asc_nulls_last("key"), "row")
    top = lambda df: df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    first = written(top(searched("first", asks.withColumn("bound", F.lit(None).cast("long")))).drop("rank"), "first")
    bounds = first.groupBy("item_row").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("bound")).withColumnRenamed("item_row", "row")
    asks_on = written(asks.join(bounds, "row", "left"), "bounds")
    best = written(top(first.unionByName(searched("not first", asks_on))).select(
        F.col("item_key").alias(item_key), F.col("rank").cast("int").alias("rank"), F.col("key").alias(key), "score"), "best")
    dropped(wanted, counted, asks, levels, bucketed, first, asks_on)
    return best
