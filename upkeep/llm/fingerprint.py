"""Document fingerprints by consistent weighted sampling. DataFrame expressions only.

A text's terms are its words, weighted by how often they stand in it. A term x of weight w draws, from a hash of x and the round,
r and c from the Gamma(2, 1) distribution and b from [0, 1), and gets

    t = floor(ln w / r + b),   ln a = ln c - r (t - b) - r.

The sample is the (x, t) of the least a. Two texts have the same sample with a chance of the sum of the lesser weights
over the sum of the greater ones, their generalised Jaccard similarity. There are ROUNDS such samples, each over all terms;
the share of equal samples estimates the similarity, with a standard error of at most 0.5 / sqrt(ROUNDS).

Candidates depend on the term and its weight alone, so they are drawn once for each (term, weight) of a part of the rows
and passed on to all texts of the part that have it. Within a round, x and t decide ln a, and no two samples share it but by
a chance in 2 ** 50 or so: the least ln a is a plain minimum, and 24 bits of its hash name the sample.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upkeep.llm.common import keyed, search, without, words, written

ROUNDS, NAMES = 64, 2**24 - 1
RANGE_ROWS = 1_000  # documents to a part, about


def signatures(rows: DataFrame, part: str, *keys: str, text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """(part, keys, signature): `rounds` numbers of 24 bits for each row; part and keys name a row.

    If `rows` are partitioned by `part` already, nothing moves: terms are counted and sampled where they are. The
    signature does not depend on the parts. A text without words has itself as its term; null is empty.
    """
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    found = words(F.lower(value))
    terms = rows.select(part, *keys, F.explode(F.when(F.size(found) > 0, found).otherwise(F.array(value))).alias("__word"))
    terms = terms.select(part, *keys, F.xxhash64("__word").alias("__term")).groupBy(part, *keys, "__term").agg(F.count(F.lit(1)).alias("__n"))
    alike = Window.partitionBy(part, "__term", "__n").orderBy("__n")
    terms = _drawn(terms.withColumn("__nth", F.row_number().over(alike)), [part, *keys], rounds)
    whole = alike.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    drawn = terms.select(part, *keys, F.first("__drawn", ignorenulls=True).over(whole).alias("__drawn"))
    least = drawn.groupBy(part, *keys).agg(*[F.min(F.get("__drawn", F.lit(k))).alias(f"__m{k}") for k in range(rounds)])
    return least.select(part, *keys, F.array(*[F.xxhash64(f"__m{k}").bitwiseAND(F.lit(NAMES)).cast("int") for k in range(rounds)]).alias("signature"))


def _drawn(terms: DataFrame, keep: list, rounds: int) -> DataFrame:
    """(keep..., __term, __n, __drawn): ln a of one candidate a round, on the first of the rows that share a term and its weight.

    Written out for each round: Spark compiles plain expressions, but walks through the body of a lambda for each element.
    r and b are columns of their own, since both are used twice.
    """
    first = F.col("__nth") == 1

    def unit(h: Column, at: int) -> Column:
        """A number in (0, 1) from 31 bits of a hash."""
        return (F.shiftrightunsigned(h, at).bitwiseAND(F.lit(2**31 - 1)).cast("double") + 0.5) * F.lit(2.0**-31)

    def hashed(n: int) -> Column:
        return F.xxhash64("__term", F.lit(n))

    def gamma(h: Column) -> Column:
        return -F.log(unit(h, 0) * unit(h, 32))

    r = {f"__r{k}": F.when(first, gamma(hashed(3 * k))) for k in range(rounds)}
    b = {f"__b{k}": F.when(first, unit(hashed(3 * k + 2), 0)) for k in range(rounds)}
    names = [*keep, "__term", "__n"]
    terms = terms.select(*names, "__nth", F.log(F.col("__n").cast("double")).alias("__lnw"), *[c.alias(n) for n, c in {**r, **b}.items()])

    def candidate(k: int) -> Column:
        r, b = F.col(f"__r{k}"), F.col(f"__b{k}")
        return F.log(gamma(hashed(3 * k + 1))) + r * (b - F.floor(F.col("__lnw") / r + b) - 1)

    return terms.select(*names, F.when(first, F.array(*[candidate(k) for k in range(rounds)])).alias("__drawn"))


def as_text(signature: Column) -> Column:
    return F.array_join(F.transform(signature, lambda x: F.lpad(F.lower(F.hex(x)), 6, "0")), "")


def likeness(one: Column, two: Column) -> Column:
    """The share of equal samples."""
    return F.size(F.filter(F.zip_with(one, two, lambda x, y: x == y), lambda same: same)) / F.size(one)


def fingerprint(docs: DataFrame, text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """`docs` with `signature` (array of int) and `fingerprint` (the same in hexadecimal).

    Equal texts have equal fingerprints and are sampled once; null is an empty text. An empty table gives an empty table;
    columns named as the new ones, `__a` or `__b` are replaced.
    """
    docs = keyed(without(docs, "signature", "fingerprint"), text, text)
    parts = max(1, docs.count() // RANGE_ROWS)
    once = docs.select(F.pmod("__a", F.lit(parts)).alias("__part"), "__a", "__b", F.col(f"`{text}`").alias("text"))
    once = once.dropDuplicates(["__a", "__b"]).repartition(parts, "__part")
    made = signatures(once, "__part", "__a", "__b", rounds=rounds).drop("__part")
    return docs.join(made, ["__a", "__b"]).drop("__a", "__b").withColumn("fingerprint", as_text(F.col("signature")))


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(part, row, guest, key, text, next_text): each row with the text of the next one by descending key.

    After the last comes the first; null keys come last; equal keys stand by the text's hash. Rows go to ranges of keys,
    a part each, along with the first row of the next range as a guest, so the texts move once and each next row is
    found in its own part. The result does not depend on where ranges begin.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    n = rows.count()
    parts = max(1, min(n // RANGE_ROWS, 100_000))
    at = rows.agg(F.percentile_approx(F.col("key").cast("long"), [i / parts for i in range(1, parts)] or [0.5], max(10_000, 10 * parts))).first()[0] or []
    bounds = sorted(set(at))
    part = F.when(F.col("key").isNull(), F.lit(-1)).otherwise(search(F.lit(bounds) if bounds else F.array().cast("array<bigint>"), F.col("key").cast("long"), len(bounds)))
    rows = rows.withColumn("part", part)
    top = F.max(F.struct(F.col("key").isNotNull().alias("some"), "key", "hash"))
    tops = written(rows.groupBy("part").agg(top.alias("top")), "tops")  # one row a range, at most 100 001
    order = Window.orderBy(F.desc("part"))
    wrap = F.first("top").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    guests = tops.select(F.col("part").alias("to"), F.coalesce(F.lead("top").over(order), wrap).alias("top")).select("to", "top.key", "top.hash").toDF("to", "k", "h")
    moved = rows.join(F.broadcast(guests), rows["key"].eqNullSafe(guests["k"]) & (rows["hash"] == guests["h"])).groupBy(
        "key", "hash", F.col("to").alias("part")).agg(F.min("text").alias("text"))
    both = rows.withColumn("guest", F.lit(False)).unionByName(moved.withColumn("guest", F.lit(True)))
    both = both.repartition(parts, "part")  # small tasks, so that terms are counted in memory
    own = Window.partitionBy("part").orderBy("guest", F.desc_nulls_last("key"), F.desc("hash"))
    return both.select("part", F.row_number().over(own).alias("row"), "guest", "key", "text", F.lead("text").over(own).alias("next_text"))


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Per row: key, `n_chars`, `edited_sha256`, `signature`, `edited_signature`, `next_signature`.

    The edited text has the first half of the row's text and, for the other half, as many first characters of the next
    row's (`with_next`), or all.
    """
    rows = with_next(docs, key, text)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left("text", n - half), F.left(F.coalesce("next_text", F.lit("")), half))
    rows = rows.select("part", "row", "guest", "key", n.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    both = rows.select("part", "row", F.explode(F.when(F.col("guest"), F.array(F.struct(F.lit(0).alias("kind"), "text"))).otherwise(
        F.array(F.struct(F.lit(0).alias("kind"), "text"), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text"))))).alias("v")).select("part", "row", "v.*")
    made = signatures(both, "part", "row", "kind", rounds=rounds)
    pair = made.groupBy("part", "row").agg(F.max(F.when(F.col("kind") == 0, F.col("signature"))).alias("signature"), F.max(F.when(F.col("kind") == 1, F.col("signature"))).alias("edited_signature"))
    pair = pair.withColumn("next_signature", F.lead("signature").over(Window.partitionBy("part").orderBy("row")))
    info = rows.where(~F.col("guest")).select("part", "row", F.col("key").alias(key), "n_chars", F.sha2("edited", 256).alias("edited_sha256"))
    return info.join(pair, ["part", "row"]).drop("part", "row")
