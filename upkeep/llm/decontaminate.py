"""Benchmark passages in documents, by winnowing. DataFrame expressions only.

The fingerprints of a document are the least of each GUARD - GRAM + 1 neighbouring hashes of GRAM words. A span of GUARD
words that an item and a document share has the same least hash in both, so joining the documents' fingerprints with
the different hashes of all items finds each such span, with one row a fingerprint however many items hold it. The whole
windows around these places are then joined with those of the items, so that a stem many items begin with pairs no document
with them. Every hit names a document, an item and the shift between them; along that shift the words are compared and
the runs of equal words extended, so a hash that collides decides nothing.

Items shorter than the window are one window of their own length; for these the documents' runs of just that many words
are joined, one pass for each length that occurs (at most window - 1).
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upkeep.llm.common import keyed, lowered, without, words, written

WINDOW, GRAM = 10, 5
MADE = ("n_words", "n_hit", "n_items", "items", "hit_words", "contaminated")


def _joined(x: str, y: str, ahead: int, n: Column, f) -> Column:
    """f(x[i], y[i + ahead]) for the first n places."""
    n = F.greatest(n, F.lit(0))
    return F.zip_with(F.slice(x, 1, n), F.slice(y, ahead + 1, n), f)


def _with_grams(df: DataFrame, k: int) -> DataFrame:
    """`df` (__a, __b, h: hashes of words) with `g`, a hash of each k neighbours, by doubling.

    Each step is a column of its own, since an expression that is used twice would be computed twice.
    """
    pair = lambda a, b: F.xxhash64(a, b)
    df = df.withColumns({"n": F.size("h"), "p1": F.col("h")})
    span, whole, done = 1, None, 0
    while True:
        if k & span:
            done += span
            if whole is None:
                whole = f"p{span}"
            else:
                df = df.withColumn(f"w{done}", _joined(whole, f"p{span}", done - span, F.col("n") - done + 1, pair))
                whole = f"w{done}"
        if done == k:
            return df.select("__a", "__b", "n", F.col(whole).alias("g"))
        df = df.withColumn(f"p{2 * span}", _joined(f"p{span}", f"p{span}", span, F.col("n") - 2 * span + 1, pair))
        span *= 2


def _winnowed(df: DataFrame, k: int, width: int) -> DataFrame:
    """(__a, __b, print, here): the least of each `width` neighbours of g, of equals the first, each once.

    Hashes are compared by their upper 34 bits with the place below, so that the least names its place.
    """
    df = df.withColumn("m1", F.transform("g", lambda g, i: F.shiftleft(F.shiftright(g, 30), 30).bitwiseOR(i.cast("long"))))
    span = 1
    while span < width:
        step = min(span, width - span)
        df = df.withColumn(f"m{span + step}", _joined(f"m{span}", f"m{span}", step, F.col("n") - k + 2 - span - step, lambda a, b: F.least(a, b)))
        span += step
    places = F.array_distinct(F.transform(f"m{width}", lambda v: v.bitwiseAND(F.lit(2**30 - 1)).cast("int")))
    df = df.select("__a", "__b", "g", places.alias("places"))
    return df.select("__a", "__b", F.explode(F.transform("places", lambda i: F.struct(F.get("g", i).alias("print"), i.alias("here")))).alias("p")).select("__a", "__b", "p.*")


def decontaminate(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """`docs` with `n_words`, `n_hit` (words inside an occurrence of a window of an item), `n_items` and `items` (those
    with occurring windows, as strings in order), `hit_words` (from, upto: runs of hit words) and `contaminated`.

    A window is `window` neighbouring words of an item; an item of fewer words, but not none, is one window. A null text
    has no words, a null item id is left out of `items` only, repeated items count once, an empty table of items leaves all
    clean. Columns named as the new ones, `__a` or `__b` are replaced.
    """
    docs = keyed(without(docs, *MADE), key, text)
    slim = docs.select("__a", "__b", lowered(F.col(f"`{text}`")).alias("t"))
    bench = written(items.select(F.col(f"`{item_key}`").cast("string").alias("item"), words(lowered(F.col(f"`{item_text}`"))).alias("own")).where("size(own) > 0").distinct().withColumn(
        "row", F.sha2(F.concat_ws(" ", F.when(F.col("item").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.base64(F.encode("item", "UTF-8")))), F.array_join("own", " ")), 256)), "items")
    hashed = slim.select("__a", "__b", F.transform(words(F.col("t")), lambda w: F.xxhash64(w)).alias("h"))
    prints = _winnowed(_with_grams(hashed, gram), gram, window - gram + 1)
    hits = _window_shifts(slim, prints, bench.where(F.size("own") >= window), window, gram)
    for n in [r[0] for r in bench.where(F.size("own") < window).select(F.size("own")).distinct().collect()]:  # window - 1 at most
        runs = _with_grams(hashed, n).select("__a", "__b", F.posexplode("g").alias("here", "print"))
        hits = hits.unionByName(_shifts(runs, bench.where(F.size("own") == n), n))
    hits = written(hits.distinct(), "hits")

    least = F.least(F.size("own"), F.lit(window))
    equal = lambda i: F.coalesce(F.get("w", F.col("shift") + i) == F.get("own", i), F.lit(False))
    ends = F.filter(F.sequence(F.lit(-1), F.size("own")), lambda i: (i < 0) | (i >= F.size("own")) | ~equal(i))
    runs = F.zip_with(F.slice("ends", 1, F.size("ends") - 1), F.slice("ends", 2, F.size("ends") - 1),
                      lambda p, q: F.struct((F.col("shift") + p + 1).alias("from"), (F.col("shift") + q - 1).alias("upto")))
    texts = slim.join(hits.select("__a", "__b").distinct(), ["__a", "__b"]).dropDuplicates(["__a", "__b"]).select("__a", "__b", words(F.col("t")).alias("w"))
    aligned = hits.join(texts, ["__a", "__b"]).join(bench, "row").select("__a", "__b", "item", "own", "shift", ends.alias("ends")).select(
        "__a", "__b", "item", F.filter(runs, lambda r: r["upto"] - r["from"] + 1 >= least).alias("runs")).where("size(runs) > 0")
    found = aligned.groupBy("__a", "__b").agg(F.array_sort(F.collect_set("item")).alias("items"), F.array_sort(F.flatten(F.collect_set("runs"))).alias("runs"))
    # Runs in order, merged: each adds what lies after the end so far.
    hit = F.aggregate("runs", F.struct(F.lit(-1).alias("end"), F.lit(0).cast("long").alias("n")), lambda s, r: F.struct(
        F.greatest(s["end"], r["upto"]).alias("end"), (s["n"] + F.greatest(F.lit(0), r["upto"] - F.greatest(s["end"], r["from"] - 1))).alias("n")))
    found = written(found.select("__a", "__b", "items", F.col("runs").alias("hit_words"), hit["n"].alias("n_hit")), "found")
    counted = docs.withColumn("n_words", F.size(words(lowered(F.col(f"`{text}`")))).cast("long"))
    none = F.array().cast("array<string>")
    return counted.join(found, ["__a", "__b"], "left").withColumns({
        "items": F.coalesce("items", none), "n_hit": F.coalesce("n_hit", F.lit(0)), "n_items": F.size(F.coalesce("items", none)).cast("long"),
        "hit_words": F.coalesce("hit_words", F.array().cast("array<struct<from:int,upto:int>>")), "contaminated": F.col("n_hit").isNotNull()}).drop("__a", "__b")


def _item_grams(bench: DataFrame, k: int) -> DataFrame:
    """(row, there, print): the hashes of each k neighbouring words of the items."""
    hashed = bench.select(F.col("row").alias("__a"), F.lit(0).alias("__b"), F.transform("own", lambda w: F.xxhash64(w)).alias("h"))
    return _with_grams(hashed, k).select(F.col("__a").alias("row"), F.posexplode("g").alias("there", "print"))


def _window_shifts(slim: DataFrame, prints: DataFrame, bench: DataFrame, window: int, gram: int) -> DataFrame:
    """(document, row of the item, shift) where a window around one of the document's fingerprints has the hash of an item's window.

    The rows are as many as windows in common, not as fingerprints in common. Texts are read again only where a
    fingerprint is one of an item's.
    """
    known = prints.join(_item_grams(bench, gram).select("print").distinct(), "print", "left_semi")
    places = known.groupBy("__a", "__b").agg(F.collect_set("here").alias("places"))
    near = slim.join(places, ["__a", "__b"]).dropDuplicates(["__a", "__b"]).select("__a", "__b", "places", F.transform(words(F.col("t")), lambda w: F.xxhash64(w)).alias("h"))
    around = F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(F.greatest(p - (window - gram), F.lit(0)), p))))
    near = near.select("__a", "__b", "h", F.filter(around, lambda s: s <= F.size("h") - window).alias("starts"))
    hashes = lambda starts: F.explode(F.transform(starts, lambda s: F.struct(s.alias("at"), F.xxhash64(F.slice("h", s + 1, window)).alias("print"))))
    ours = near.select("__a", "__b", hashes("starts").alias("v")).select("__a", "__b", F.col("v.at").alias("here"), "v.print")
    theirs = bench.select("row", F.transform("own", lambda w: F.xxhash64(w)).alias("h")).withColumn("starts", F.sequence(F.lit(0), F.size("h") - window))
    theirs = theirs.select("row", hashes("starts").alias("v")).select("row", F.col("v.at").alias("there"), "v.print")
    return ours.join(theirs, "print").select("__a", "__b", "row", (F.col("here") - F.col("there")).alias("shift")).distinct()


def _shifts(prints: DataFrame, bench: DataFrame, k: int) -> DataFrame:
    """(document, row of the item, shift) of the items' runs of k words among the documents' hashes. Spark broadcasts the items if they
    are small, by the size of the written table, and else shuffles both sides by hash."""
    return prints.join(_item_grams(bench, k), "print").select("__a", "__b", "row", (F.col("here") - F.col("there")).alias("shift")).distinct()
