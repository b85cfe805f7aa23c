"""Forests grown level by level: every task counts its rows into the histograms of all trees' open nodes, and the
histograms of a tree are added up and searched for the best splits in a task of their own.

Rows are binned once and written in blocks at one byte a feature (two above 256 bins); no copy of them is kept for each tree. How often
a tree draws a row is a function of the row's key, not of where the row lies, and draws are whole numbers, so the same rows give
the same trees on any number of tasks. Gini impurity, continuous features; a split whose leaves predict the same is taken back, as Spark ML does.
"""

from dataclasses import dataclass

from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upkeep.operators.bounds import new_path, settle
from upkeep.operators.prep import class_weights

CELLS = 20_000_000  # histogram cells of one scan over the rows: 160 MB in a task
CHUNK = 131_072  # rows that a task counts at once
PIECE = 16_384  # rows that are binned, or drawn, at once: what that works on stays in cache
BLOCK = 8_192  # bytes of a block of rows, which Spark moves as one row
MARKED = 8  # nodes of a level up to which a mark for every row is less work than lists of places
LEAST_GAIN = 1e-12  # less is rounding
DATA = ("treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, gain: double, "
        "leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>")
_BEST = "tree int, slot int, total array<long>, feature int, cut int, gain double, near array<long>"


@dataclass
class Binned:
    """Rows as bins: `rows` (bins, label and, for bags, draws or row, as blocks of rows), the cut points of each feature, weights by class."""

    rows: DataFrame
    cuts: list
    weights: list

    @property
    def bins(self):
        return max(len(c) for c in self.cuts) + 1


def _cut_points(max_bins):
    """Cut points of one feature from a sample (feature, x, w): between all values if they are few, else at equal weights."""

    def cut(sample):
        import numpy as np
        import pandas as pd

        x, at = np.unique(sample["x"].to_numpy(), return_inverse=True)
        x = x[~np.isnan(x)]
        middle = (x[:-1] + x[1:]) / 2
        if len(middle) >= max_bins:
            upto = np.bincount(at, sample["w"].to_numpy(), len(x))[: len(x)].cumsum()
            goal = upto[-1] * np.arange(1, max_bins) / max_bins
            after = np.clip(np.searchsorted(upto, goal), 1, len(x) - 1)
            nearer = goal - upto[after - 1] <= upto[after] - goal
            middle = middle[np.unique(np.minimum(after - nearer, len(middle) - 1))]
        return pd.DataFrame({"feature": [sample["feature"].iloc[0]], "cuts": [middle.tolist()]})

    return cut


def binned(train: DataFrame, dims: int, max_bins: int, balanced: bool, seed: int, row: Column, draws=None, bags: bool = True) -> Binned:
    """`train` (features vector, label) as bins, written. `row`, a long, names a row and makes its draws; with
    `draws`, a function from a list of names to a matrix of each tree's draws, it is a string. Without `bags` every tree has every row once.

    Cut points come from a sample of max(max_bins ** 2, 10 000) rows chosen by hash of `row`, as many as Spark ML takes; all rows are binned.
    """
    sizes = {int(r["label"]): (r["n"], r["weight"]) for r in class_weights(train.select("label"), "label").collect()}
    n, weights = sum(s for s, _ in sizes.values()), [float(sizes[c][1]) if c in sizes and balanced else 1.0 for c in range(max(2, max(sizes) + 1))]
    rows = train.select(vector_to_array("features").alias("x"), F.col("label").cast("tinyint").alias("label"), row.alias("row"))
    share = max(max_bins**2, 10_000) / n
    sample = rows if share >= 1 else rows.where(F.pmod(F.xxhash64(F.lit(seed), F.lit("cuts"), "row"), F.lit(2**20)) < share * 2**20)
    weight = F.get(F.array(*[F.lit(w) for w in weights]), F.col("label").cast("int"))
    values = sample.select(F.posexplode("x").alias("feature", "x"), weight.alias("w"))
    found = {r["feature"]: r["cuts"] for r in values.groupBy("feature").applyInPandas(_cut_points(max_bins), "feature int, cuts array<double>").collect()}
    cuts = [found.get(i, []) for i in range(dims)]
    wide = "uint8" if max(len(c) for c in cuts) < 256 else "uint16"
    given = draws is not None
    kept = ["draws" if given else "row"] if bags else []

    def place(batches):
        import numpy as np
        import pyarrow as pa

        for b in gathered(batches, PIECE):
            x = np.asarray(b.column("x").flatten().to_numpy(zero_copy_only=False), np.float64).reshape(b.num_rows, dims)
            own = np.stack([np.searchsorted(c, x[:, i]) for i, c in enumerate(cuts)], axis=1).astype(wide)
            last = [draws(b.column("row").to_pylist()) if given else b.column("row").to_numpy(zero_copy_only=False)[:, None]] if bags else []
            label = b.column("label").to_numpy(zero_copy_only=False)[:, None].astype(np.int8)
            yield pa.RecordBatch.from_arrays(blocks(own, label, *last), ["bins", "label", *kept])

    ddl = ", ".join(f"{c} binary" for c in ("bins", "label", *kept))
    return Binned(settle((rows if bags else rows.drop("row")).mapInArrow(place, ddl)), cuts, weights)


def blocks(*matrices):
    """Matrices with a row for each row as Arrow columns of bytes, BLOCK bytes or so a record: moving rows one by one costs more than counting them."""
    import numpy as np
    import pyarrow as pa

    n, sizes = len(matrices[0]), [m.shape[1] * m.itemsize for m in matrices]
    ends = np.append(np.arange(0, n, max(1, BLOCK // sum(sizes))), n)
    return [
        pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * size).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(m))])
        for m, size in zip(matrices, sizes)
    ]


def matrix(column, kind, width):
    """The rows of such a column."""
    import numpy as np

    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(kind).reshape(-1, width)


def gathered(batches, rows):
    """Batches put together to `rows` rows or more, the last one as it is; empty ones are left out."""
    import pyarrow as pa

    def whole():
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0] if len(held) > 1 else held[0]

    held, n = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            n += b.num_rows
        if n >= rows:
            yield whole()
            held, n = [], 0
    if held:
        yield whole()


def pieces(batches, rows_of):
    """(piece of a batch of blocks, its rows), CHUNK rows or so at most; rows_of tells the rows of a batch."""
    for b in batches:
        if b.num_rows:
            step = max(1, b.num_rows * CHUNK // rows_of(b))
            for start in range(0, b.num_rows, step):
                piece = b.slice(start, step)
                yield piece, rows_of(piece)


def _limits():
    """From which of 65 536 numbers on a Poisson(1) count is 1 or more, 2 or more, ..."""
    import math

    import numpy as np

    upto = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(8)])
    return [int(v) for v in np.round(upto * 65536) if v < 65536]


def _drawn(row, seed):
    """A function giving each tree's draws of the rows: 16 bits of a mixed 64-bit counter, four trees a word."""
    import numpy as np

    limits, words = _limits(), {}
    mixed, spare, beyond = (np.empty(len(row), t) for t in (np.uint64, np.uint64, bool))

    def draws(tree):
        if tree // 4 not in words:
            words.clear()  # trees come in order
            np.add(row.view(np.uint64), np.uint64((seed * 0xD1342543DE82EF95 + (tree // 4 + 1) * 0x9E3779B97F4A7C15) % 2**64), out=mixed)
            for start in range(0, len(row), PIECE):
                z, held = mixed[start : start + PIECE], spare[start : start + PIECE]
                for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, None)):
                    np.right_shift(z, np.uint64(shift), out=held)
                    z ^= held
                    if factor:
                        z *= np.uint64(factor)
            words[tree // 4] = np.ascontiguousarray(mixed.astype("<u8", copy=False).view("<u2").reshape(-1, 4).T)
        bits, times = words[tree // 4][tree % 4], np.zeros(len(row), np.int8)
        for limit in limits:
            np.greater_equal(bits, limit, out=beyond)
            times += beyond.view(np.int8)
        return times

    return draws


def _leading(slots, ways):
    """Which nodes are open or have an open one below them."""
    _, cut, left = ways
    leads = slots >= 0
    for node in range(len(leads) - 1, -1, -1):  # children come after their parent
        if left[node] != node:
            leads[node] |= leads[left[node]] | leads[left[node] + 1]
    return leads


def _held(drawn, ways, slots, leads, columns):
    """(slot, places of its rows) of one tree's open nodes.

    The drawn rows are parted from the root down: first by a mark for every row, which costs the same for few rows as for many, then,
    from nodes of a level of MARKED or so, by lists of places, which one sort of the marked rows gives for all of them.
    """
    import numpy as np

    feature, cut, left = ways
    code, spare, ends, todo = np.zeros(len(drawn), np.uint8), np.empty(len(drawn), np.uint8), [], [(0, drawn)]
    while todo:
        following = []
        for node, marked in todo:
            if slots[node] >= 0 or len(todo) >= MARKED:
                ends.append(node)
                np.multiply(marked.view(np.uint8), np.uint8(len(ends)), out=spare)
                code |= spare
                continue
            far = columns[feature[node]] > cut[node]
            far &= marked
            following += [(child, part) for child, part in ((left[node], marked ^ far), (left[node] + 1, far)) if leads[child]]
        todo = following
    places = np.flatnonzero(code != 0)  # of marks it is quicker than of numbers
    own = code.take(places, mode="clip")  # clip: no place is out of range, and numpy need not look
    upto = np.bincount(own, minlength=len(ends) + 1).cumsum()
    if len(ends) > 1:
        places = places.take(np.argsort(own, kind="stable"), mode="clip")
    todo = [(node, places[upto[i] : upto[i + 1]]) for i, node in enumerate(ends)]
    while todo:
        node, held = todo.pop()
        if not len(held):
            continue
        if slots[node] >= 0:
            yield slots[node], held
            continue
        far = columns[feature[node]].take(held, mode="clip") > cut[node]
        todo += [(child, held.compress(part)) for child, part in ((left[node], ~far), (left[node] + 1, far)) if leads[child]]


def _counted(open_nodes, ways, shape, seed):
    """Counts a task's rows into the histograms of each tree's open nodes: (tree, counts as int32 bytes, by slot, feature, bin and class).

    open_nodes: tree -> (slot of each node or -1, features of each slot); ways: tree -> (feature, last bin to the left, left child) of each
    node, a leaf leading to itself; the right child follows the left one.
    """
    bins, classes, kind = shape
    leads = {t: _leading(slots, ways[t]) for t, (slots, _) in open_nodes.items()}

    def labels(b):
        return matrix(b.column("label"), "int8", 1).ravel()

    def count(chunk, sums):
        import numpy as np

        label = np.concatenate([labels(b) for b in chunk])
        columns = np.ascontiguousarray(np.concatenate([matrix(b.column("bins"), kind, 1).reshape(len(labels(b)), -1) for b in chunk]).T)
        cells = np.multiply(columns, classes, dtype=np.uint16 if bins * classes <= 2**16 else np.int32)
        cells += label.astype(cells.dtype)
        names = chunk[0].schema.names
        if "draws" in names:
            wide = [matrix(b.column("draws"), np.int8, 1).reshape(len(labels(b)), -1) for b in chunk]
            table = np.ascontiguousarray(np.concatenate(wide).T)
            draws = table.__getitem__
        elif "row" in names:
            draws = _drawn(np.concatenate([matrix(b.column("row"), np.int64, 1).ravel() for b in chunk]), seed)
        for tree, (slots, features) in open_nodes.items():
            times = draws(tree) if len(names) > 2 else None
            drawn = np.ones(len(label), bool) if times is None else times.astype(bool)
            for slot, held in _held(drawn, ways[tree], slots, leads[tree], columns):
                w = None if times is None else times.take(held, mode="clip").astype(np.float64)
                for total, feature in zip(sums[tree][slot], features[slot]):
                    total += np.bincount(cells[feature].take(held, mode="clip"), w, bins * classes)

    def scan(batches):
        import numpy as np
        import pyarrow as pa

        sums, chunk, rows = {t: np.zeros((*f.shape, bins * classes)) for t, (_, f) in open_nodes.items()}, [], 0
        for b, n in pieces(batches, lambda b: len(labels(b))):
            chunk.append(b)
            rows += n
            if rows >= CHUNK:
                count(chunk, sums)
                chunk, rows = [], 0
        if rows:
            count(chunk, sums)
        for tree, s in sums.items():
            if s.any():
                yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), pa.array([s.astype(np.int32).tobytes()], pa.binary())], ["tree", "counts"])

    return scan


def _gini(w, total):
    import numpy as np

    with np.errstate(invalid="ignore", divide="ignore"):
        return 1 - (w * w).sum(axis=-1) / (total * total)


def _best(open_nodes, shape, weights):
    """Adds up one tree's histograms and finds the best split of each open node; cut -1 where none lowers the impurity."""
    bins, classes, _ = shape

    def best(table):
        import numpy as np
        import pyarrow as pa

        tree = table["tree"][0].as_py()
        features = open_nodes[tree][1]
        counts = np.zeros((*features.shape, bins, classes), np.int64)
        for p in table["counts"].to_pylist():
            counts += np.frombuffer(p, np.int32).reshape(counts.shape)
        out = {k: [] for k in ("tree", "slot", "total", "feature", "cut", "gain", "near")}
        for slot in range(len(features)):
            upto = counts[slot].cumsum(axis=1)
            total, near = upto[0, -1], upto[:, :-1]
            far = total - near
            wt, wn, wf = total * weights, near * weights, far * weights
            n, ln, rn = wt.sum(), wn.sum(axis=-1), wf.sum(axis=-1)
            with np.errstate(invalid="ignore", divide="ignore"):
                gain = _gini(wt, n) - ln / n * _gini(wn, ln) - rn / n * _gini(wf, rn)
            gain = np.where((near.sum(axis=-1) > 0) & (far.sum(axis=-1) > 0), gain, -1.0)
            f, c = np.unravel_index(np.argmax(gain), gain.shape) if gain.size else (0, 0)
            fine = gain.size > 0 and gain[f, c] > LEAST_GAIN
            for k, v in zip(out, (tree, slot, total.tolist(), int(features[slot, f]), int(c) if fine else -1, float(gain[f, c]) if fine else -1.0, near[f, c].tolist() if fine else [])):
                out[k].append(v)
        types = (pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.int32(), pa.int32(), pa.float64(), pa.list_(pa.int64()))
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), types)})

    return best


def grow(data: Binned, trees: int, max_depth: int, max_features: str, seed: int) -> list:
    """Node rows (tree, node data) of all trees, as Spark ML writes them. One scan over the bins a level, more where the open
    nodes' histograms have more than CELLS cells; only open nodes' best splits reach the driver."""
    import math

    import numpy as np

    dims, classes, bins = len(data.cuts), len(data.weights), data.bins
    each = {"all": dims, "sqrt": math.ceil(math.sqrt(dims))}[max_features]
    shape, weights = (bins, classes, "uint8" if bins <= 256 else "uint16"), np.array(data.weights)
    # of each tree's nodes: draws by class, feature, cut, gain, left child (the right one follows)
    grown = [[[None, 0, -1, -1.0, 0]] for _ in range(trees)]
    going = [(t, 0) for t in range(trees)]
    for level in range(max_depth):
        following, ways = [], {}
        for t in {t for t, _ in going}:
            _, feature, cut, _, left = zip(*grown[t])
            ways[t] = (np.array(feature, np.int64), np.where(np.array(cut) < 0, np.iinfo(shape[2]).max, cut).astype(shape[2]), np.array([at if c >= 0 else i for i, (at, c) in enumerate(zip(left, cut))], np.int64))
        most = max(1, CELLS // (each * bins * classes))
        for start in range(0, len(going), most):
            open_nodes = {}
            for t, node in going[start : start + most]:
                open_nodes.setdefault(t, []).append(node)
            own = dict(open_nodes)
            for t, nodes in own.items():
                slots = np.full(len(ways[t][0]), -1, np.int64)  # an earlier scan of the level has added nodes
                slots[nodes] = np.arange(len(nodes))
                chosen = [np.sort(np.random.default_rng([seed % 2**32, t, node]).choice(dims, each, replace=False)) for node in nodes]
                open_nodes[t] = (slots, np.array(chosen, np.int64))
            counts = data.rows.mapInArrow(_counted(open_nodes, ways, shape, seed), "tree int, counts binary")
            for r in counts.groupBy("tree").applyInArrow(_best(open_nodes, shape, weights), _BEST).collect():
                t, node = r["tree"], own[r["tree"]][r["slot"]]
                grown[t][node][0] = r["total"]
                if r["cut"] >= 0:
                    grown[t][node][1:] = [r["feature"], r["cut"], r["gain"], len(grown[t])]
                    for side in (r["near"], [a - b for a, b in zip(r["total"], r["near"])]):
                        if sum(v > 0 for v in side) > 1:
                            following.append((t, len(grown[t])))
                        grown[t].append([side, 0, -1, -1.0, 0])
        going = sorted(following)
        if not going:
            break
    return [row for t in range(trees) for row in _written(t, grown[t], data.cuts, weights)]


def _written(tree, nodes, cuts, weights):
    """Node rows of a tree, numbered from the root leftwards; a split whose leaves predict the same is a leaf."""
    counts = [[v * float(w) for v, w in zip(n[0] or [0] * len(weights), weights)] for n in nodes]
    predicted = [max(range(len(c)), key=lambda i: (c[i], -i)) for c in counts]
    kept = [False] * len(nodes)
    for i in reversed(range(len(nodes))):  # children come after their parent
        at = nodes[i][4]
        kept[i] = nodes[i][2] >= 0 and (kept[at] or kept[at + 1] or predicted[at] != predicted[at + 1])
    rows, todo, place = [], [(0, None)], {}
    while todo:
        i, parent = todo.pop()
        number = place[i] = len(rows)
        if parent is not None and nodes[parent][4] + 1 == i:
            rows[place[parent]][1]["rightChild"] = number
        total = sum(counts[i])
        impurity = 1 - sum((c / total) ** 2 for c in counts[i]) if total else 0.0
        drawn, feature, cut, gain, left = nodes[i]
        split = (feature, [cuts[feature][cut]], -1) if kept[i] else (-1, [], -1)
        rows.append((tree, {"id": number, "prediction": float(predicted[i]), "impurity": impurity, "impurityStats": counts[i], "rawCount": sum(drawn or [0]),
                            "gain": gain if kept[i] else -1.0, "leftChild": number + 1 if kept[i] else -1, "rightChild": -1, "split": split}))
        if kept[i]:
            todo += [(left + 1, i), (left, i)]
    return rows


_frames = {}  # saved models by settings, for one application


def framed(spark, maker, settings: dict, dims: int, classes: int):
    """(folder of a saved model with these settings, fitted to one row a class; a new path that has its metadata)."""
    slot = (spark.sparkContext.applicationId, maker.__name__, *sorted(settings.items()), dims, classes)
    if slot not in _frames:
        few = spark.createDataFrame([(Vectors.dense([float(c)] * dims), float(c), 1.0) for c in range(classes)], ["features", "label", "weight"])
        frame = new_path(spark)
        maker(**settings).fit(few.coalesce(1)).write().save(frame)
        _frames[slot] = frame
    frame, path = _frames[slot], new_path(spark)
    spark.read.text(f"{frame}/metadata").coalesce(1).write.text(f"{path}/metadata")
    return frame, path


def as_model(spark, rows: list, settings: dict, dims: int, classes: int) -> RandomForestClassificationModel:
    """The Spark ML model of grown trees: their nodes in place of those of a model with the same settings, fitted to one row a class."""
    frame, path = framed(spark, RandomForestClassifier, settings, dims, classes)
    spark.read.parquet(f"{frame}/treesMetadata").coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame(rows, DATA).coalesce(1).write.parquet(f"{path}/data")
    return RandomForestClassificationModel.load(path)


def as_tree(spark, rows: list, settings: dict, dims: int, classes: int) -> DecisionTreeClassificationModel:
    """The same for one tree."""
    _, path = framed(spark, DecisionTreeClassifier, settings, dims, classes)
    spark.createDataFrame(rows, DATA).select("nodeData.*").coalesce(1).write.parquet(f"{path}/data")
    return DecisionTreeClassificationModel.load(path)
