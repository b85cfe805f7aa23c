"""Removal of repeated byte strings by suffix sorting.

A string of `min_bytes` that starts at two places has the same bytes around it at both, and so the same least
gram in it: that gram is its anchor. Every window start belongs to one anchor, those of an anchor are neighbours, and
equal windows have equal anchors. So texts are cut at anchors into segments, those whose anchor occurs once are left
out, and the others meet by anchor. There the suffixes that start in the segments' own ranges are sorted in two
stages (`suffix_order`), and the common prefixes of neighbours decide.

An anchor in very many different segments, as in a passage with other text around it each time, is cut finer: into
blocks of 32 starts that meet by all the bytes they have in common, and if that is not enough, into single windows.
No task gets more than SEGMENTS segments of one key, and nothing is dropped.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.common import dropped, gram_hashes, grouped, keyed, slices, text_bytes, with_fields, without, written

GRAM = 32
SEGMENTS = 1000  # different segments of one key in a task; beyond, the key is cut finer
BLOCKS = (32, 1)  # window starts to a block, level by level
SLICE = 1 << 18  # bytes of text worked on at once
SORTED = 1 << 19  # bytes of segments sorted at once, cut at keys
MADE = ("spans", "n_bytes", "n_removed", "n_spans", "kept")


def suffix_order(data: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The positions where `wanted`, in the order of the suffixes there, to `depth` bytes at least.

    Stage one sorts suffixes smaller than their successors. Stage two scans the buckets of first bytes upwards: the
    predecessor of each suffix found, if it is larger than its successor, is the next of its own bucket. Positions
    that stage two needs as successors are sorted along.
    """
    n = len(data)
    text = np.concatenate([data, np.array([0, 255] + [0] * (depth + 16), np.uint8)])
    size = n + 2
    step = text[1 : size + 1].astype(np.int16) - text[:size]
    step[size - 1] = -1
    differs = np.where(step != 0, np.arange(size), size)
    smaller = step[np.minimum.accumulate(differs[::-1])[::-1]] > 0
    need = np.zeros(size, bool)
    need[:n] = wanted
    last = np.flatnonzero(need[:-1] & ~need[1:] & ~smaller[:-1])  # ends of ranges whose successor is missing
    direct = np.flatnonzero(smaller)
    reach = direct[np.searchsorted(direct, last + 1)]
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, last + 1, 1)
    np.add.at(edge, reach + 1, -1)
    need |= np.cumsum(edge[:size]) > 0
    key = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(text, 8)).view(">u8").ravel().astype(np.uint64)

    # Stage one. Positions with equal first bytes and equal windows share a place, so that long repeats need no rounds.
    direct = np.flatnonzero(need & smaller)
    window = gram_hashes(text, depth)[direct]
    by = np.lexsort((window, key[direct]))
    direct, window = direct[by], window[by]
    first = np.ones(len(direct), bool)
    first[1:] = (key[direct[1:]] != key[direct[:-1]]) | (window[1:] != window[:-1])
    heads = np.flatnonzero(first)
    counts = np.diff(np.append(heads, len(direct)))
    order = np.arange(len(heads))
    at = direct[heads]
    fresh = np.ones(len(at), bool)
    fresh[1:] = key[at[1:]] != key[at[:-1]]
    group = np.maximum.accumulate(np.where(fresh, order, 0))  # a group is named by where it begins
    for far in range(8, depth, 8):
        tied = np.zeros(len(order), bool)
        same = group[1:] == group[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        tied = np.flatnonzero(tied)
        if not len(tied):
            break
        ahead = key[at[order[tied]] + far]
        by = np.lexsort((ahead, group[tied]))
        order[tied] = order[tied[by]]
        ahead, old = ahead[by], group[tied]
        fresh = np.append(True, (ahead[1:] != ahead[:-1]) | (old[1:] != old[:-1]))
        group[tied] = np.maximum.accumulate(np.where(fresh, tied, 0))
    spread = np.repeat(heads[order], counts[order]) + _within(counts[order])
    direct = direct[spread]

    # Stage two.
    induced = need & ~smaller
    cuts = np.searchsorted(text[direct], np.arange(257))
    queues: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    for c in range(256):
        waves, wave = queues[c], np.concatenate(queues[c]) if queues[c] else direct[:0]
        queues[c] = []
        waves = [wave]
        while len(wave):
            before = wave[wave > 0] - 1
            wave = before[induced[before] & (text[before] == c)]
            waves.append(wave)
        bucket = np.concatenate([*waves, direct[cuts[c] : cuts[c + 1]]])
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[induced[before] & (text[before] > c)]
        if len(before):
            chars = text[before]
            by = np.argsort(chars, kind="stable")
            before, chars = before[by], chars[by]
            starts = np.flatnonzero(np.append(True, chars[1:] != chars[:-1]))
            for s, e in zip(starts, np.append(starts[1:], len(before))):
                queues[chars[s]].append(before[s:e])
    found = np.concatenate(out) if out else np.zeros(0, np.int64)
    return found[found < n][wanted[found[found < n]]]


def _within(counts: np.ndarray) -> np.ndarray:
    """0 .. c - 1 for each count c, end to end."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Length of the prefix that each suffix of `order` shares with the one before it, up to `most`."""
    if len(order) < 2:
        return np.zeros(len(order), np.int64)
    text = np.concatenate([data, np.zeros(most + 8, np.uint8)])
    x, y, length = order[1:], order[:-1], np.zeros(len(order) - 1, np.int64)
    still = np.arange(len(x))
    key = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(text, 8)).view("<u8").ravel()
    for far in range(0, most, 8):
        if not len(still):
            break
        differ = key[x[still] + far] ^ key[y[still] + far]
        stop = differ != 0
        if stop.any():  # the lowest byte that differs
            low = differ[stop] & (~differ[stop] + np.uint64(1))
            length[still[stop]] = far + (np.log2(low.astype(np.float64)) // 8).astype(np.int64)
            still = still[~stop]
    length[still] = most
    return np.append(0, np.minimum(length, most))


def repeated_starts(segments: list[tuple[bytes, int, int]], size: int) -> list[np.ndarray]:
    """For each (bytes, own starts, copies): whether the `size` bytes from each own start also start elsewhere.

    A segment with copies stands twice in the sorted text; further copies would add nothing.
    """
    parts, owns, at, place = [], [], [], 0
    for raw, n, copies in segments:
        at.append(place)
        for _ in range(1 + (copies > 1)):
            parts.append(raw)
            owns.append((place, n))
            place += len(raw)
    data = np.frombuffer(b"".join(parts), np.uint8)
    wanted = np.zeros(len(data), bool)
    for p, n in owns:
        wanted[p : p + n] = True
    order = suffix_order(data, wanted, size)
    long = common_prefixes(data, order, size) >= size
    long[:-1] |= long[1:].copy()
    twice = np.zeros(len(data), bool)
    twice[order[long]] = True
    return [twice[p : p + n] for p, (_, n, _) in zip(at, segments)]


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def anchors(data: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """(text, hash, first start, starts, anchor) of the anchors of texts laid end to end; positions are in the text."""
    none = np.zeros(0, np.int64)
    if len(data) < size:
        return none, none.astype(np.uint64), none, none, none
    grams = gram_hashes(data, GRAM)
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    width, span = size - GRAM + 1, 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    least = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    ends = at[1:] - size + 1  # of window starts, text by text
    has = ends > at[:-1]
    edge = np.zeros(len(least) + 1, np.int8)
    edge[at[:-1][has]] += 1
    edge[ends[has]] -= 1
    valid = np.cumsum(edge[:-1]) > 0
    fresh = valid.copy()
    fresh[1:] &= (least[1:] != least[:-1]) | ~valid[:-1]
    start = np.flatnonzero(fresh)
    of = np.searchsorted(at, start, "right") - 1
    stop = np.minimum(np.append(start[1:], len(data)), ends[of])
    anchor = least[start]
    return of, grams[anchor], start - at[of], stop - start, anchor - at[of]


def suffix_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", min_bytes: int = 400, whole_letters: bool = False) -> DataFrame:
    """`docs` with `spans` (start, end of the maximal removed runs of bytes), `n_bytes`, `n_removed`, `n_spans`, and
    `kept`, the other bytes.

    A byte goes if a string of `min_bytes` that covers it also starts at another place of any text, the same text
    included. A null text is empty, rows that repeat a text remove each other, ties have no effect, an empty table
    gives an empty table. Columns of `docs` with the names above, `__a` or `__b` are replaced.

    With `whole_letters` a removed run takes along the rest of a letter (of UTF-8) that it would cut, so that `kept` is text.
    """
    if min_bytes < 2 * GRAM:
        raise ValueError(f"min_bytes must be at least {2 * GRAM}")
    docs = keyed(without(docs, *MADE), key, text)
    slim = docs.select("__a", "__b", F.col(f"`{text}`").alias("text"))
    fit = slim.where(F.octet_length("text") >= min_bytes)

    # A slice of texts gives one row an anchor, and below one row a segment, with its places: a key that stands in all
    # texts is as many rows as there are slices.
    def cut(batches):
        for b in slices(batches, "text", SLICE):
            of, h, start, n, _ = anchors(*text_bytes(b.column("text")), min_bytes)
            by = np.argsort(h, kind="stable")
            h, rows = h[by].view(np.int64), pa.array(of[by])
            first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else by
            at = pa.StructArray.from_arrays([b.column("__a").take(rows), b.column("__b").take(rows), pa.array(start[by]), pa.array(n[by])], ["a", "b", "start", "n"])
            yield pa.RecordBatch.from_arrays([pa.array(h[first]), pa.ListArray.from_arrays(pa.array(np.append(first, len(h)), pa.int32()), at)], ["h", "at"])

    cuts = written(fit.mapInArrow(cut, "h long, at array<struct<a:bigint,b:bigint,start:bigint,n:bigint>>"), "anchors")
    often = written(cuts.groupBy("h").agg(F.sum(F.size("at")).alias("times")).where("times > 1").select("h"), "often")
    own = cuts.join(often, "h").select("h", F.inline("at")).groupBy(F.col("a").alias("__a"), F.col("b").alias("__b")).agg(
        F.collect_set(F.struct("start", "n", "h")).alias("cuts"))

    def segment(batches):
        task = TaskContext.get().partitionId() << 32
        for number, b in enumerate(slices(batches, "text", 1 << 21)):
            data, at = text_bytes(b.column("text"))
            raw, seen, rows = data.tobytes(), {}, []
            for i, (a, bb, cuts) in enumerate(zip(*(b.column(c).to_pylist() for c in ("__a", "__b", "cuts")))):
                for c in cuts:
                    s = int(at[i]) + c["start"]
                    part = raw[s : s + c["n"] + min_bytes - 1]
                    sid = hashlib.blake2b(part, digest_size=16).digest()
                    if sid not in seen:
                        seen[sid] = [c["h"], sid, c["n"], 0, part, [], task + number]
                        rows.append(seen[sid])
                    seen[sid][3] += 1
                    seen[sid][5].append({"a": a, "b": bb, "start": c["start"]})
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*rows) if rows else [[]] * 7, _SEGMENT)], _SEGMENT_NAMES)

    places = written(fit.join(own, ["__a", "__b"]).mapInArrow(segment, _SEGMENT_SQL), "segments")
    dropped(cuts, often)
    found = _runs_of_each(_repeats(places.select("h", "sid", "n", "copies", "part"), min_bytes, 0))

    # Places meet their runs by segment and go back to their slice, which gives one row a text.
    def merge(table: pa.Table) -> pa.Table:
        texts: dict[tuple, list] = {}
        for at, runs in zip(table["at"].to_pylist(), table["runs"].to_pylist()):
            for p in at:
                texts.setdefault((p["a"], p["b"]), []).extend((p["start"] + r["lo"], p["start"] + r["hi"] + min_bytes - 1) for r in runs)
        made = []
        for spans in texts.values():
            own = []
            for start, end in sorted(spans):
                if own and start <= own[-1]["end"]:
                    own[-1]["end"] = max(own[-1]["end"], end)
                else:
                    own.append({"start": start, "end": end})
            made.append(own)
        return pa.table([pa.array([k[0] for k in texts], pa.int64()), pa.array([k[1] for k in texts], pa.int64()), pa.array(made, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], ["__a", "__b", "spans"])

    spans = places.select("slice", "sid", "at").join(found, "sid").select("slice", "at", "runs").groupBy("slice").applyInArrow(merge, "__a long, __b long, spans array<struct<start:bigint,end:bigint>>")
    spans = written(spans.groupBy("__a", "__b").agg(F.flatten(F.collect_list("spans")).alias("__found")), "spans")
    dropped(places)
    keep = [c for c in docs.columns if c not in ("__a", "__b")]

    def remove(batches):
        for b in slices(batches, "__t", 1 << 20):
            data, at = text_bytes(b.column("__t"))
            out = []
            for i, found in enumerate(b.column("__found").to_pylist()):
                raw = data[at[i] : at[i + 1]]
                if not found:
                    out.append(([], len(raw), 0, raw.tobytes()))
                    continue
                gone = np.zeros(len(raw) + 1, np.int32)
                for f in found:
                    gone[f["start"]] += 1
                    gone[f["end"]] -= 1
                gone = np.cumsum(gone[:-1]) > 0
                if whole_letters:
                    letter = np.cumsum((raw & 0xC0) != 0x80)  # bytes of one letter have one number
                    gone = np.isin(letter, np.unique(letter[gone]))
                out.append((_runs(gone), len(raw), int(gone.sum()), raw[~gone].tobytes()))
            spans = pa.array([[{"start": s, "end": e} for s, e in o[0]] for o in out], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in keep] + [spans, pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.int64()), pa.array([len(o[0]) for o in out], pa.int64()), pa.array([o[3] for o in out], pa.binary())],
                [*keep, *MADE])

    schema = with_fields(docs.select(*[F.col(f"`{c}`") for c in keep]).schema, "spans array<struct<start:bigint,end:bigint>>, n_bytes long, n_removed long, n_spans long, kept binary")
    joined = docs.join(spans, ["__a", "__b"], "left").select(
        *[F.col(f"`{c}`") for c in keep], F.col("__found"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__t"))
    return joined.mapInArrow(remove, schema)


_SEGMENT_NAMES = ["h", "sid", "n", "copies", "part", "at", "slice"]
_SEGMENT = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64()), ("start", pa.int64())])), pa.int64()]
_SEGMENT_SQL = "h long, sid binary, n long, copies long, part binary, at array<struct<a:bigint,b:bigint,start:bigint>>, slice long"


def _runs_of_each(found: DataFrame) -> DataFrame:
    """(sid, runs): the runs (lo, hi) of each segment as one row."""
    return found.groupBy("sid").agg(F.collect_set(F.struct("lo", "hi")).alias("runs"))


def _repeats(rows: DataFrame, size: int, level: int) -> DataFrame:
    """(sid, lo, hi): runs of own starts of segments that repeat. rows: h, sid, n, copies, part."""
    if level == len(BLOCKS):
        return _sorted(rows, size)
    many = lambda r: written(r.groupBy("h").agg(F.count(F.lit(1)).alias("segments")).where(F.col("segments") > SEGMENTS).select("h"), "hot")
    hot = many(rows)
    if hot.isEmpty():
        return _sorted(rows, size)
    # A segment came from each slice of texts that has it; where a key has very many rows, they are made one.
    once = written(rows.join(hot, "h", "left_semi").groupBy("h", "sid", "n").agg(F.sum("copies").alias("copies"), F.first("part").alias("part")), "once")
    cold, hot = rows.join(hot, "h", "left_anti"), many(once)
    cold = cold.unionByName(once.join(hot, "h", "left_anti"))
    if hot.isEmpty():
        return _sorted(cold, size)
    blocks = written(once.join(hot, "h", "left_semi").mapInArrow(_finer(size, BLOCKS[level]), "h long, sid binary, n long, copies long, part binary, of binary, off long"), "blocks")
    found = _repeats(blocks.where("part is not null").select("h", "sid", "n", "copies", "part"), size, level + 1)
    fine = blocks.select("sid", "of", "off").distinct().join(_runs_of_each(found), "sid").select(
        F.col("of").alias("sid"), "off", F.inline("runs")).select("sid", (F.col("lo") + F.col("off")).alias("lo"), (F.col("hi") + F.col("off")).alias("hi"))
    return _sorted(cold, size).unionByName(fine)


def _finer(size: int, block: int):
    """Segments cut into blocks of `block` starts on a grid that starts at the least gram of the segment's common part."""

    def run(batches):
        for b in slices(batches, "part", 1 << 19):
            seen, rows = {}, []
            for r in b.to_pylist():
                part, n = r["part"], r["n"]
                grid = _grid(part, n, size)
                for q in range(-grid // block, (n - 1 - grid) // block + 1):
                    lo, hi = max(0, grid + q * block), min(n, grid + (q + 1) * block)
                    if lo >= hi:
                        continue
                    own = part[lo : hi + size - 1]
                    core = part[grid + (q + 1) * block - 1 : grid + q * block + size]
                    sid = hashlib.blake2b(own, digest_size=16, salt=b"block").digest()
                    h = int.from_bytes(hashlib.blake2b(core, digest_size=8, salt=q.to_bytes(8, "big", signed=True)).digest(), "big", signed=True)
                    row = [h, sid, hi - lo, r["copies"], None, r["sid"], lo]
                    rows.append(row)
                    if sid in seen:
                        seen[sid][3] += r["copies"]
                    else:
                        seen[sid] = row
                        row[4] = own
            types = [*_SEGMENT[:5], pa.binary(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*rows) if rows else [[]] * 7, types)], ["h", "sid", "n", "copies", "part", "of", "off"])

    return run


def _grid(part: bytes, n: int, size: int) -> int:
    """Where the anchor gram stands: in all own windows, so in the bytes n - 1 .. size; the least there is the anchor."""
    grams = gram_hashes(np.frombuffer(part, np.uint8)[n - 1 : size], GRAM)
    return n - 1 + int(np.argmin(grams >> np.uint64(32)))


def _sorted(rows: DataFrame, size: int) -> DataFrame:
    """Sort the suffixes of the segments of each key; keys are packed to SORTED bytes a sort."""

    def run(batches):
        pack, weight = {}, 0
        for group in grouped(batches, "h"):
            for r in group:
                if r["sid"] in pack:
                    pack[r["sid"]][2] += r["copies"]
                else:
                    pack[r["sid"]] = [r["part"], r["n"], r["copies"]]
                    weight += len(r["part"])
            if weight >= SORTED:
                yield solve(pack)
                pack, weight = {}, 0
        if pack:
            yield solve(pack)

    def solve(pack):
        rows = [(sid, lo, hi) for sid, twice in zip(pack, repeated_starts(list(pack.values()), size)) for lo, hi in _runs(twice)]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows) if rows else [[]] * 3, (pa.binary(), pa.int64(), pa.int64()))], ["sid", "lo", "hi"])

    return rows.repartition("h").sortWithinPartitions("h").mapInArrow(run, "sid binary, lo long, hi long")
