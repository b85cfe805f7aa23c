"""Near-duplicate documents by Order MinHash and exact shingle similarity.

A text's terms are its runs of `shingle` words, each with the number of its occurrence. Per band a seeded hash ranks
the terms, the `take` least are put in the order in which they stand in the text, and their hash is the band's key. Two
texts share it with about the chance J ** take, and not when the sampled terms are in another order. As many keys are of the
least terms of the set of shingles, whatever their order and number, so that texts with a moved or repeated part meet.
Texts of few terms get keys of single terms besides, since one word more changes all their samples.

Equal word sequences are one node. In a bucket every node is held against the least node: linear, however large the
group. Where a bucket still holds several classes after that, as a common passage makes them, its nodes are joined on
their rarest shingles and every pair that can have `similarity` of them in common is held together (`_rest`). Two texts
of which 0.8 of the shingles are the same share about half of the keys, so that a pair without one is rarer than one in
100 000.

A pair is alike if `similarity` of the different shingles of both are in common. Banded alignment of the words decides
first: an edit changes at most `SHINGLE` shingles of either text, so e edits leave enough in common if e is at most
(1 - similarity) / (1 + similarity) / SHINGLE of the shingles of one text. Pairs that do not align so closely, as those
with a moved part, are counted exactly on the whole texts.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from upkeep.llm.common import dropped, gram_hashes, keyed, mixed, slices, text_bytes, without, written
from upkeep.llm.graph import components

SHINGLE, TAKE, BANDS = 5, 3, 20
BITS = 512  # of a set, a power of two
FEW, SINGLE_BANDS = 16, 8  # texts of at most so many terms get so many keys of one term each
MADE = ("class_id", "class_size", "is_first")
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of texts laid end to end, and the offsets of the texts in them."""
    low = _LOWER[data]
    word = _IS_WORD[low]
    starts = word.copy()
    starts[1:] &= ~word[:-1]
    inner = at[(at > 0) & (at < len(data))]
    starts[inner] |= word[inner]
    start = np.flatnonzero(starts)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    coded = np.where(word, mixed(low.astype(np.uint64) + np.uint64(977)), np.uint64(0))
    # A word's hash is the sum of its letters' codes times powers of an odd base, from the word's start.
    place = np.arange(len(low)) - np.repeat(start, np.diff(np.append(start, len(low)))) if start[0] == 0 else np.arange(len(low) - start[0]) - np.repeat(start - start[0], np.diff(np.append(start, len(low))))
    powers = np.cumprod(np.full(int(place.max()) + 1, 0xD6E8FEB86659FD93, np.uint64), dtype=np.uint64)
    hashes = mixed(np.add.reduceat(coded[start[0] :] * powers[place], start - start[0]))
    return hashes, np.searchsorted(start, at)


def order_keys(words: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The band keys of one text."""
    k = min(SHINGLE, len(words))
    if not k:
        return np.zeros(0, np.int64)
    grams = gram_hashes(words, k)
    by = np.argsort(grams, kind="stable")
    ranked = grams[by]
    fresh = np.append(True, ranked[1:] != ranked[:-1])
    number = np.arange(len(by)) - np.maximum.accumulate(np.where(fresh, np.arange(len(by)), 0))
    terms = grams.copy()
    terms[by] = mixed(ranked + number.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    whole = np.zeros(len(terms), bool)
    whole[by] = fresh  # of equal shingles the first
    least = _least_terms(terms, seeds)
    by_value = least if whole.all() else _least_terms(terms[whole], seeds)
    out = [_band_keys(least, seeds[:BANDS]), _band_keys(np.sort(by_value, axis=1), mixed(seeds[:BANDS]))]
    if whole.sum() <= FEW:
        out.append(mixed(mixed(terms[whole][None, :] ^ seeds[BANDS:, None]).min(axis=1) + seeds[BANDS:]))
    return np.concatenate(out).view(np.int64)


def _least_terms(terms: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """A row a band: the least terms as they stand in the text."""
    take = min(TAKE, len(terms))
    if len(terms) > 20000:  # band by band, so that a very long text needs no wide table
        rows = [np.argpartition(mixed(terms ^ s), take - 1)[:take] for s in seeds[:BANDS]]
        first = np.sort(np.array(rows), axis=1)
    else:
        ranks = mixed(terms[None, :] ^ seeds[:BANDS, None])
        first = np.sort(np.argpartition(ranks, take - 1, axis=1)[:, :take], axis=1) if take < len(terms) else np.tile(np.arange(take), (BANDS, 1))
    return terms[first]


def _band_keys(picked: np.ndarray, key: np.ndarray) -> np.ndarray:
    for j in range(picked.shape[1]):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + picked[:, j])
    return key


def edit_similar(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    """Whether the edit distance of two word sequences is at most (1 - similarity) of the longer one's length."""
    return within_edits(x, y, int((1 - similarity) * max(len(x), len(y)) + 1e-9))


def within_edits(x: np.ndarray, y: np.ndarray, most: int) -> bool:
    """Whether at most `most` words are to be put in, left out or replaced between two sequences."""
    if len(x) > len(y):
        x, y = y, x
    if len(y) - len(x) > most:
        return False
    same = len(x)
    head = np.flatnonzero(x != y[:same])
    head = int(head[0]) if len(head) else same
    x, y = x[head:], y[head:]
    tail = np.flatnonzero(x[::-1] != y[::-1][: len(x)])
    tail = int(tail[0]) if len(tail) else len(x)
    x, y = x[: len(x) - tail], y[: len(y) - tail]
    if not len(x):
        return len(y) <= most
    both, n = np.unique(np.concatenate([x, y]), return_inverse=True)
    of_x, of_y = np.bincount(n[: len(x)], minlength=len(both)), np.bincount(n[len(x) :], minlength=len(both))
    if len(y) - np.minimum(of_x, of_y).sum() > most:  # each word without a partner costs an edit
        return False
    return banded_distance(n[: len(x)].tolist(), n[len(x) :].tolist(), most) <= most


def banded_distance(x: list[int], y: list[int], most: int) -> int:
    """The edit distance of x and y, x not the longer, if it is at most `most`; else a number above.

    Column by column of y, bit b of each integer is row j - most + b of column j, so the band moves along the main
    diagonal. `down` and `up` have the differences between neighbouring rows, `flat` the steps along a diagonal
    that cost nothing; the distance is summed along the diagonal that ends in the last cell.
    """
    ahead = len(y) - len(x)
    places: dict[int, int] = {}
    for i, c in enumerate(x):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << (2 * most + 1)) - 1
    down, up, distance, goal = full ^ ((1 << most) - 1), 0, ahead, most - ahead
    for j, c in enumerate(y, 1):
        equal = places.get(c, 0)
        equal = (equal << (most + 1 - j) if j <= most else equal >> (j - most - 1)) & full
        flat = ((((equal & down) + down) ^ down) | equal | up) & full
        right, left = up | (full & ~(flat | down)), flat & down
        if j > ahead and not flat >> goal & 1:
            distance += 1
            if distance > most:
                return distance
        flat >>= 1
        down, up = left | (full & ~(flat | right)), flat & right
    return distance


def near_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = 0.8) -> DataFrame:
    """`docs` with `class_id` (the least key of its class of near-duplicates), `class_size` (rows) and `is_first` (true
    for one key and text of each class: the least key, then the least hash of the text).

    Classes are connected by pairs that have `similarity` of their different five-word shingles in common; a text of fewer
    words is one shingle. Words are compared with A-Z as a-z; texts without words are alike if their bytes are equal, and a null text is
    empty. Rows that repeat key and text are all marked alike. Null keys come after all others. An empty table gives an
    empty table; columns of `docs` named as the new ones, `__a` or `__b` are replaced.
    """
    docs = keyed(without(docs, *MADE), key, text)
    slim = docs.select("__a", "__b", F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    seeds = mixed(np.arange(1, BANDS + SINGLE_BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def sketch(batches):
        for b in slices(batches, "text", 1 << 20):
            data, at = text_bytes(b.column("text"))
            words, of = word_hashes(data, at)
            nodes, keys = [], []
            for i in range(len(b)):
                own = words[of[i] : of[i + 1]]
                nodes.append(hashlib.blake2b(own.tobytes() if len(own) else b"-" + data[at[i] : at[i + 1]].tobytes(), digest_size=16).digest())
                keys.append(order_keys(own, seeds))
            yield pa.RecordBatch.from_arrays([b.column("__a"), b.column("__b"), pa.array(nodes, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], ["__a", "__b", "node", "bands"])

    rows = written(slim.mapInArrow(sketch, "__a long, __b long, node binary, bands array<long>"), "sketches")
    first = rows.groupBy("node").agg(F.min(F.struct("__a", "__b")).alias("row"), F.first("bands").alias("bands"))
    bands = first.select("node", F.posexplode("bands").alias("band", "bucket"))
    buckets = written(bands.join(bands.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("nodes"), F.min("node").alias("least")).where("nodes > 1"), ["band", "bucket"]), "buckets")
    inside = buckets.select("node").distinct().join(first, "node").select("node", "row.*")
    texts = written(slim.join(inside, ["__a", "__b"]).dropDuplicates(["node"]).select("node", "text"), "texts")

    pairs = written(buckets.where("node <> least").select("node", "least").distinct(), "pairs")
    best = pairs.groupBy("node").agg(F.min("least").alias("least"))
    yes = _alike(best, texts, similarity)
    roots = components(yes)
    more = _apart(pairs.join(best, ["node", "least"], "left_anti"), roots)
    links = yes.unionByName(_alike(more, texts, similarity))
    roots = components(links)
    rest = _rest(buckets, pairs, roots, texts, similarity)
    roots = components(links.unionByName(_alike(rest, texts, similarity)))
    dropped(texts, pairs, buckets)

    classed = rows.select("__a", "__b", "node").join(roots, "node", "left").select("__a", "__b", F.coalesce("root", "node").alias("root"))
    ids = slim.select("__a", "__b", "key").join(classed.distinct(), ["__a", "__b"])
    chief = ids.groupBy("root").agg(
        F.min(F.struct(F.col("key").isNull().alias("none"), "key", "__a", "__b")).alias("chief"), F.count(F.lit(1)).alias("class_size"))
    found = written(ids.select("__a", "__b", "root").distinct().join(chief, "root").select(
        "__a", "__b", F.col("chief.key").alias("class_id"), "class_size",
        ((F.col("__a") == F.col("chief.__a")) & (F.col("__b") == F.col("chief.__b"))).alias("is_first")), "classes")
    return docs.join(found, ["__a", "__b"]).drop("__a", "__b")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = 0.8) -> DataFrame:
    """One row of each class; of rows that repeat key and text, one."""
    marked = near_classes(docs, key, text, similarity).where("is_first").drop(*MADE)
    marked = keyed(marked, key, text)
    again = written(marked.groupBy("__a", "__b").agg(F.count(F.lit(1)).alias("times")).where("times > 1"), "again")
    single = marked.join(again, ["__a", "__b"], "left_anti")
    return single.unionByName(marked.join(again, ["__a", "__b"], "left_semi").dropDuplicates(["__a", "__b"])).drop("__a", "__b")


def _alike(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links (x, y) of the pairs (node, least) that are alike."""

    def verify(batches):
        for b in slices(batches, "one", 1 << 20):
            one, two = (word_hashes(*text_bytes(b.column(c))) for c in ("one", "two"))
            both = ((one[0][one[1][i] : one[1][i + 1]], two[0][two[1][i] : two[1][i + 1]]) for i in range(len(b)))
            keep = [near(x, y, similarity) for x, y in both]
            yield pa.RecordBatch.from_arrays([b.column("x"), b.column("y")], ["x", "y"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(texts.select("node", F.col("text").alias("one")), "node").join(
        texts.select(F.col("node").alias("least"), F.col("text").alias("two")), "least")
    return written(both.select(F.col("node").alias("x"), F.col("least").alias("y"), "one", "two").mapInArrow(verify, "x binary, y binary"), "alike")


def _rooted(df: DataFrame, roots: DataFrame, column: str, name: str) -> DataFrame:
    own = roots.select(F.col("node").alias(column), F.col("root").alias(name))
    return df.join(own, column, "left").withColumn(name, F.coalesce(name, column))


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose ends are in different classes."""
    return _rooted(_rooted(pairs, roots, "node", "r"), roots, "least", "s").where("r <> s").select("node", "least")


def shingle_set(words: np.ndarray) -> np.ndarray:
    """The hashes of a text's shingles in order, each once; a text of fewer words is one shingle."""
    k = min(SHINGLE, len(words))
    return np.unique(gram_hashes(words, k)) if k else np.zeros(0, np.uint64)


def near(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    """Whether two word sequences have `similarity` of their different shingles in common: by alignment if that proves it, else by counting."""
    a, b = shingle_set(x), shingle_set(y)
    enough = int(max(len(a), len(b)) * (1 - similarity) / (1 + similarity) / SHINGLE + 1e-9)
    if min(len(x), len(y)) >= SHINGLE and within_edits(x, y, enough):
        return True
    return shingle_similar(a, b, similarity)


def parity_bits(shingles: np.ndarray) -> np.ndarray:
    """BITS bits of a set, each the parity of the shingles that fall on it. Two sets' bits differ in at most as many places as the sets do."""
    odd = np.bincount((mixed(shingles ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(64 - BITS.bit_length() + 1)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def shingle_similar(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    """Whether two sets of shingles have `similarity` of all in common."""
    if min(len(x), len(y)) < similarity * max(len(x), len(y)) - 1e-9:
        return False
    common = len(np.intersect1d(x, y, assume_unique=True))
    return common >= similarity * (len(x) + len(y) - common) - 1e-9


def _rest(buckets: DataFrame, tried: DataFrame, roots: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Pairs of different classes among the nodes of buckets that still hold several classes: all that can have
    `similarity` of their shingles in common.

    The shingles of a text are ordered by how many nodes have them, ties by hash. Two sets of that similarity share one
    of the first n - ceil(similarity * n) + 1 of each, and what follows the first shared one is long enough for the
    overlap they need. A common passage's shingles come last in this order and are seldom among the first. A pair whose
    parity bits differ in more places than sets of that similarity can is not joined: that leaves out nearly all that are
    less alike, as many edited copies of one text are among each other, and none that is alike.
    """
    rows = written(_rooted(buckets, roots, "node", "root").select("band", "bucket", "node", "root"), "rest")
    several = rows.groupBy("band", "bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("band", "bucket")
    nodes = written(rows.join(several, ["band", "bucket"]).select("node", "root").distinct(), "several")

    def shingles(batches):
        for b in slices(batches, "text", 1 << 18):
            words, of = word_hashes(*text_bytes(b.column("text")))
            sets = [shingle_set(words[of[i] : of[i + 1]]).view(np.int64) for i in range(len(b))]
            sizes = np.array([len(x) for x in sets])
            at = pa.array(np.repeat(np.arange(len(b)), sizes))
            bits = iter([parity_bits(x.view(np.uint64)) for x in sets])
            heads = np.append(True, np.diff(np.repeat(np.arange(len(b)), sizes)) != 0) if sizes.sum() else np.zeros(0, bool)
            bits = pa.array([next(bits) if head else None for head in heads.tolist()], pa.list_(pa.int64()))  # with a node's first shingle only
            yield pa.RecordBatch.from_arrays([b.column("node").take(at), b.column("root").take(at), pa.array(np.concatenate(sets)), pa.array(np.repeat(sizes, sizes)), bits], ["node", "root", "shingle", "size", "bits"])

    grams = written(texts.join(nodes, "node").select("node", "root", "text").mapInArrow(shingles, "node binary, root binary, shingle long, size long, bits array<long>"), "shingles")
    often = grams.groupBy("shingle").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    own = Window.partitionBy("node")
    place = F.col("size") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("often", "shingle")) - 1
    first = grams.join(often, "shingle").withColumn("place", place).where(F.col("place") <= F.col("size") - F.ceil(F.col("size") * similarity - 1e-9))
    first = written(first.select("shingle", "node", "root", "size", (F.col("size") - F.col("place")).alias("left")), "first")
    mixed_ones = first.groupBy("shingle").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("shingle")
    first = first.join(mixed_ones, "shingle").join(grams.where("bits IS NOT NULL").select("node", "bits"), "node")
    first = written(first.select("shingle", "node", "root", "size", "left", *[F.col("bits")[i].alias(f"b{i}") for i in range(BITS // 64)]), "mixed")
    x, y = first.alias("x"), first.alias("y")
    overlap = (F.col("x.size") + F.col("y.size")) * (similarity / (1 + similarity)) - 1e-9
    on = (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.node") > F.col("y.node")) & (F.col("x.root") != F.col("y.root")) & (F.least("x.left", "y.left") >= overlap)
    apart = sum((F.bit_count(F.col(f"x.b{i}").bitwiseXOR(F.col(f"y.b{i}"))) for i in range(BITS // 64)), F.lit(0))
    on &= apart <= (F.col("x.size") + F.col("y.size")) * ((1 - similarity) / (1 + similarity)) + 1e-9
    pairs = x.join(y, on).select(F.col("x.node").alias("node"), F.col("y.node").alias("least")).distinct()
    return written(pairs.join(tried, ["node", "least"], "left_anti"), "near")
