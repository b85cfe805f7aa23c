"""Quality of documents by multiple-instance learning with gated attention, in numpy.

A document is a bag of passages of PASSAGE bytes, all of its bytes. A passage is encoded by counts of hashed byte trigrams, of
trigrams of byte classes, and how concentrated they are, through one learned layer. Gated attention weighs the passages,
a_k ~ exp(w . (tanh(V h_k) * sigmoid(U h_k))), and the weighted sum of their encodings is scored. Only documents have
labels; which passages matter is learned.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.common import slices, text_bytes, with_fields, without

PASSAGE, TRIGRAMS, SHAPES = 512, 512, 256
WIDTH = TRIGRAMS + SHAPES + 2
HIDDEN, GATE = 32, 16
TRAIN_DOCS, TRAIN_BYTES = 4_000, 1 << 18  # the bounded sample: so many labelled documents, each of so many bytes at most
STEPS, BATCH, RATE = 400, 64, 0.004

_CLASS = np.full(256, 15, np.uint32)
for _i, _chars in enumerate([b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r", b".,;:", b"!?", b"'\"-()", b"|", b"#*$%&", b"<>{}[]/\\=_~^`+@"]):
    _CLASS[list(_chars)] = _i
_CLASS[128:] = 11


def passages(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Encodings of the passages of texts laid end to end, and the offsets of the texts in them; an empty text has one."""
    counts = np.maximum(1, -(-np.diff(at) // PASSAGE))
    first = np.append(0, np.cumsum(counts))
    out = np.zeros((first[-1], WIDTH), np.float32)
    if len(data):
        text = np.repeat(np.arange(len(counts)), np.diff(at))
        place = first[text] + (np.arange(len(data)) - at[text]) // PASSAGE
        wide = np.concatenate([data, np.zeros(2, np.uint8)])
        x, y, z = (wide[i : i + len(data)].astype(np.uint32) for i in range(3))
        gram = ((x * np.uint32(0x9E3779B1) + y * np.uint32(0x85EBCA77) + z * np.uint32(0xC2B2AE3D)) >> np.uint32(7)) % np.uint32(TRIGRAMS)
        x, y, z = _CLASS[x], _CLASS[y], _CLASS[z]
        shape = ((x * np.uint32(0x27D4EB2F) + y * np.uint32(0x165667B1) + z * np.uint32(0x9E3779B1)) >> np.uint32(9)) % np.uint32(SHAPES)
        n = first[-1]
        grams = np.bincount(place * TRIGRAMS + gram, minlength=n * TRIGRAMS).reshape(n, TRIGRAMS).astype(np.float32)
        shapes = np.bincount(place * SHAPES + shape, minlength=n * SHAPES).reshape(n, SHAPES).astype(np.float32)
        total = np.maximum(1, grams.sum(1, keepdims=True))
        out[:, :TRIGRAMS] = np.sqrt(grams / total)
        out[:, TRIGRAMS:-2] = np.sqrt(shapes / total)
        out[:, -2] = np.log((grams * grams).sum(1) / (total * total)[:, 0] + 1e-4) / 4
        out[:, -1] = np.log(total[:, 0]) / 6
    return out, first


class Model:
    """Weights of the encoder, the gate and the score."""

    NAMES = ("W", "b", "V", "U", "w", "c", "d")

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        n = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.W, self.b, self.V, self.U, self.w, self.c, self.d = n(WIDTH, HIDDEN), np.zeros(HIDDEN, np.float32), n(HIDDEN, GATE), n(HIDDEN, GATE), n(GATE), n(HIDDEN), np.zeros(1, np.float32)

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict:
        h = np.maximum(0, x @ self.W + self.b)
        t, s = np.tanh(h @ self.V), 1 / (1 + np.exp(-(h @ self.U)))
        e = (t * s) @ self.w
        of = np.repeat(np.arange(len(first) - 1), np.diff(first))
        e = np.exp(e - np.maximum.reduceat(e, first[:-1])[of])
        a = e / np.add.reduceat(e, first[:-1])[of]
        z = np.add.reduceat(a[:, None] * h, first[:-1])
        return {"h": h, "t": t, "s": s, "a": a, "z": z, "of": of, "y": 1 / (1 + np.exp(-(z @ self.c + self.d)))}

    def gradients(self, x: np.ndarray, first: np.ndarray, label: np.ndarray) -> dict:
        f = self.forward(x, first)
        h, t, s, a, of = f["h"], f["t"], f["s"], f["a"], f["of"]
        out = (f["y"] - label) / len(label)
        dz = out[:, None] * self.c
        da = (dz[of] * h).sum(1)
        de = a * (da - np.add.reduceat(a * da, first[:-1])[of])
        dt, ds = de[:, None] * self.w * s * (1 - t * t), de[:, None] * self.w * t * s * (1 - s)
        dh = (a[:, None] * dz[of] + dt @ self.V.T + ds @ self.U.T) * (h > 0)
        return {"W": x.T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ ds, "w": (t * s).T @ de, "c": f["z"].T @ out, "d": out.sum(keepdims=True)}


def train(bags: list[np.ndarray], labels: np.ndarray, steps: int = STEPS, seed: int = 7) -> Model:
    """Adam, a fixed number of steps whatever the size of the sample. Without any bag the model is left untrained."""
    model, r = Model(seed), np.random.default_rng(seed)
    if not bags:
        return model
    mean = float(np.clip(labels.mean(), 0.01, 0.99))
    model.d[:] = np.log(mean / (1 - mean))
    m = {k: (0.0, 0.0) for k in Model.NAMES}
    for i in range(1, steps + 1):
        pick = r.integers(0, len(bags), BATCH)
        first = np.append(0, np.cumsum([len(bags[j]) for j in pick]))
        for k, g in model.gradients(np.concatenate([bags[j] for j in pick]), first, labels[pick]).items():
            w = getattr(model, k)
            g = g + 1e-4 * w
            m[k] = (0.9 * m[k][0] + 0.1 * g, 0.999 * m[k][1] + 0.001 * g * g)
            rate = RATE * min(1, 4 * (1 - i / (steps + 1)))
            setattr(model, k, (w - rate * (m[k][0] / (1 - 0.9**i)) / (np.sqrt(m[k][1] / (1 - 0.999**i)) + 1e-7)).astype(np.float32))
    return model


def fit_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", train_docs: int = TRAIN_DOCS) -> Model:
    """A model from labelled rows: the `train_docs` labels whose keys hash least, of those whose text has TRAIN_BYTES at
    most. Labels are 0 or 1, others are not used; the sample is bounded, so it fits the driver and may be broadcast."""
    chosen = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).alias("__label")).orderBy(F.xxhash64(key), key).limit(train_docs)
    rows = docs.where(F.coalesce(F.octet_length(text), F.lit(0)) <= TRAIN_BYTES).join(F.broadcast(chosen), key).select(key, F.coalesce(F.col(text), F.lit("")).alias("__text"), "__label")

    def encode(batches):
        for b in slices(batches, "__text", 1 << 20):
            x, first = passages(*text_bytes(b.column("__text")))
            yield pa.RecordBatch.from_arrays([pa.array([x[i:j].astype(np.float16).tobytes() for i, j in zip(first, first[1:])], pa.binary()), b.column("__label"), b.column(key)], ["bag", "label", "key"])

    got = sorted(rows.withColumn("__label", F.col("__label").cast("int")).withColumn(key, F.col(key).cast("long")).mapInArrow(encode, "bag binary, label int, key long").collect(), key=lambda r: (r["key"], r["bag"]))
    bags = [np.frombuffer(r["bag"], np.float16).reshape(-1, WIDTH).astype(np.float32) for r in got]
    return train(bags, np.array([r["label"] for r in got], np.float32))


def score_quality(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """`docs` with `score` and `predicted` (1 if the score is `threshold` or more).

    Every byte of a text is in a passage; null is an empty text, which has a score too. Ties and repeated rows have no
    effect, an empty table gives an empty table, columns named as the new ones are replaced.
    """
    docs = without(docs, "score", "predicted")
    keep = docs.columns

    def run(batches):
        for b in slices(batches, text, 1 << 19):
            y = model.forward(*passages(*text_bytes(b.column(text))))["y"].astype(np.float64)
            y = np.round(y, 6)
            yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [pa.array(y), pa.array((y >= threshold).astype(np.int32))], [*keep, "score", "predicted"])

    return docs.mapInArrow(run, with_fields(docs.schema, "score double, predicted int"))
