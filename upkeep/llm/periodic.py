"""Periodic runs of words: the places where a text repeats itself without a break.

A run is a stretch with smallest period q that no neighbouring word extends. Its first word s and the word s + q share a
prefix of exactly length - q words, and no place between them shares as much. So the suffixes of a text are sorted, with
the common prefixes of neighbours (LCP), and united to classes by falling LCP, as Kruskal's method unites nodes; each
class keeps its positions in order. When two classes meet, positions that become neighbours and lie within the LCP of
each other seed a run with their distance as its period; a seed whose words before differ is where the run begins.

Classes of one LCP meet one after another, so a pair may be neighbours for a moment only. Then its distance is a multiple
of the period, and the seed of the true one has the same start and length: of those the least period counts.

A text is worked on alone in one task. Sorting takes n log n, and each word changes its class log n times at most.
"""

from bisect import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.common import gram_hashes, mixed, slices, with_fields, without

SLICE = 1 << 20  # bytes of text worked on at once; a longer text comes alone
MADE = ("n_words", "n_runs", "runs", "strongest", "collapsed")
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def suffix_levels(ids: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Ranks of the suffixes of texts laid end to end, each inside its text: level k compares 2 ** k words.

    Equal ranks at a level mean equal words; the last level has no equal ranks. A place is sorted again only as long as
    another one equals it.
    """
    n, sizes = len(ids), np.diff(at)
    end = np.repeat(at[1:], sizes)
    rank = np.repeat(np.arange(len(sizes)), sizes) * (int(ids.max(initial=0)) + 1) + ids
    open_, old = np.arange(n), np.zeros(n, np.int64)
    second, levels, span = rank, [], 1
    rank = np.zeros(n, np.int64)
    while True:
        by = np.lexsort((second, old))
        open_, old, second = open_[by], old[by], second[by]
        fresh = np.ones(len(by), bool)
        fresh[1:] = (old[1:] != old[:-1]) | (second[1:] != second[:-1])
        first = np.maximum.accumulate(np.where(fresh, np.arange(len(by)), 0))
        group = np.ones(len(by), bool)
        group[1:] = old[1:] != old[:-1]
        begun = np.maximum.accumulate(np.where(group, np.arange(len(by)), 0))
        rank[open_] = old + first - begun
        levels.append(rank.astype(np.int32))
        tied = ~fresh
        tied[:-1] |= ~fresh[1:]
        open_ = open_[tied]
        if not len(open_):
            return levels
        ahead = open_ + span
        old, second = rank[open_], np.where(ahead < end[open_], rank[np.minimum(ahead, n - 1)], -1)
        span *= 2


def neighbour_prefixes(levels: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(x, y, LCP) of the suffixes that follow each other in order and share at least `least` words."""
    n, low = len(levels[0]), least.bit_length() - 1
    if len(levels) <= low:
        return (np.zeros(0, np.int64),) * 3
    order = np.empty(n, np.int64)
    order[levels[-1]] = np.arange(n)
    x, y = order[:-1], order[1:]
    near = levels[low][x] == levels[low][y]
    x, y = x[near], y[near]
    length = np.zeros(len(x), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        i, j = x + length, y + length
        inside = (i < n) & (j < n)
        same = inside & (levels[k][np.where(inside, i, 0)] == levels[k][np.where(inside, j, 0)])
        length[same] += 1 << k
    far = length >= least
    return x[far], y[far], length[far]


def kruskal_seeds(x: np.ndarray, y: np.ndarray, lcp: np.ndarray, share: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, distance, LCP) of the positions that become neighbours within LCP / `share` as classes unite."""
    by = np.argsort(-lcp, kind="stable")
    sets: dict[int, list[int]] = {}
    out: list[tuple[int, int, int]] = []
    for a, b, length in zip(x[by].tolist(), y[by].tolist(), lcp[by].tolist()):
        big, small = sets.get(a) or [a], sets.get(b) or [b]
        if len(big) < len(small):
            big, small = small, big
        reach = length // share
        where = [bisect(big, v) for v in small]
        last, following = -1, where[1:]
        following.append(-1)
        for v, i, after in zip(small, where, following):
            if i and i != last and v - big[i - 1] <= reach:
                out.append((big[i - 1], v - big[i - 1], length))
            if i != after and i < len(big) and big[i] - v <= reach:
                out.append((v, big[i] - v, length))
            last = i
        if len(big) == 1:
            sets[big[0]] = big
        if len(small) * 16 > len(big):
            big.extend(small)
            big.sort()  # two sorted runs: one merge
        else:
            for shift, (v, i) in enumerate(zip(small, where)):
                big.insert(i + shift, v)
        for v in small:
            sets[v] = big
    found = np.array(out, np.int64).reshape(-1, 3)
    return found[:, 0], found[:, 1], found[:, 2]


def runs_of(ids: np.ndarray, at: np.ndarray, min_words: int = 24, min_exponent: int = 3) -> np.ndarray:
    """Rows (text, start, length, period) of all runs of texts laid end to end, by text, start and period."""
    none = np.zeros((0, 4), np.int64)
    # The words that the first two periods of a run have in common at least.
    least = -(-min_words * (min_exponent - 1) // min_exponent)
    sizes = np.diff(at)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    if len(ids) <= least:
        return none
    # Texts in which no window of that many words repeats have no run: most stop here.
    grams = gram_hashes(mixed(ids.astype(np.uint64) + np.uint64(1)), least)
    inside = np.flatnonzero(np.arange(len(grams)) + least <= at[1:][doc[: len(grams)]])
    grams = mixed(grams[inside] + doc[inside].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    by = np.argsort(grams, kind="stable")
    again = np.flatnonzero(grams[by][1:] == grams[by][:-1])
    chosen = np.unique(doc[inside[by[again]]])
    if not len(chosen):
        return none
    mask = np.zeros(len(sizes), bool)
    mask[chosen] = True
    ids, at = ids[mask[doc]], np.append(0, np.cumsum(sizes[chosen]))
    i, d, lcp = kruskal_seeds(*neighbour_prefixes(suffix_levels(ids, at), least), min_exponent - 1)
    of = np.searchsorted(at, i, "right") - 1
    begins = (i == at[of]) | (ids[i - 1] != ids[i + d - 1])
    length = lcp + d
    keep = begins & (length >= min_words) & (length >= min_exponent * d)
    rows = np.stack([of, i, length, d], axis=1)[keep]
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1]))]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, 1] != rows[:-1, 1]) | (rows[1:, 2] != rows[:-1, 2])
    rows = rows[first]
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1]))]
    rows[:, 1] -= at[rows[:, 0]]
    rows[:, 0] = chosen[rows[:, 0]]
    return rows


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = 24, min_exponent: int = 3) -> DataFrame:
    """`docs` with `n_words`, `n_runs`, `runs` (start, length, period in words from 0, by start, then period), `strongest`
    (the run of the greatest length / period, compared exactly; ties: least start, then period; null without runs) and
    `collapsed`: the words joined by single blanks, of each run only the first period (null text: empty).

    Words are what stands between blanks and ASCII control blanks (9 to 13). A run has `min_words` words and
    `min_exponent` periods (at least 2) at least. Null texts have no words; rows are worked on one by one, so that repeated rows and null keys
    have no effect; an empty table gives an empty table; columns of `docs` named as the new ones are replaced.
    """
    if min_exponent < 2 or min_words < 2 * min_exponent:
        raise ValueError("a run needs two periods, and min_words twice min_exponent")
    docs = without(docs, *MADE)
    keep = docs.columns
    slim = docs.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("__t"))

    def find(batches):
        for b in slices(batches, "__t", SLICE):
            texts = [t.encode().split() for t in b.column("__t").to_pylist()]  # bytes split at exactly these blanks
            at = np.append(0, np.cumsum([len(t) for t in texts])).astype(np.int64)
            flat = pa.array([w for t in texts for w in t], pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
            rows = runs_of(flat, at, min_words, min_exponent)
            cut = np.searchsorted(rows[:, 0], np.arange(len(texts) + 1))
            runs, best, left = [], [], []
            for n, t in enumerate(texts):
                own = rows[cut[n] : cut[n + 1], 1:].tolist()
                runs.append([{"start": s, "length": m, "period": p} for s, m, p in own])
                # Different quotients of numbers below 2 ** 31 stay different when cut to 64 bits behind the point.
                best.append(max(runs[-1], key=lambda r: ((r["length"] << 64) // r["period"], -r["start"], -r["period"])) if own else None)
                if own:
                    gone = np.zeros(len(t) + 1, np.int32)
                    for s, m, p in own:
                        gone[s + p] += 1
                        gone[s + m] -= 1
                    t = [w for w, g in zip(t, (np.cumsum(gone[:-1]) > 0).tolist()) if not g]
                left.append(b" ".join(t))
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in keep], pa.array(np.diff(at)), pa.array(np.diff(cut).astype(np.int64)), pa.array(runs, pa.list_(_RUN)), pa.array(best, _RUN), pa.array(left, pa.binary()).cast(pa.string())],
                [*keep, *MADE])

    run = "struct<start:bigint,length:bigint,period:bigint>"
    return slim.mapInArrow(find, with_fields(docs.schema, f"n_words long, n_runs long, runs array<{run}>, strongest {run}, collapsed string"))
