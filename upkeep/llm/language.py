"""Language of documents by a convolutional network over bytes, in numpy.

Texts, with A-Z as a-z, are cut into windows of WINDOW bytes, the last one filled up with zeros. Each byte has an embedding,
filters of several widths slide over them, the greatest value of each filter in a window is kept, and a softmax layer
gives the languages. A document's probabilities are those of its windows, weighted by their bytes. For scoring, the
embedding and the filters become tables indexed by byte pairs, so a filter of width w costs w / 2 look-ups a byte.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.common import slices, text_bytes, with_fields, without

WINDOW, EMBED, FILTERS, WIDTHS = 256, 8, 8, (2, 4, 6)
TRAIN_DOCS, TRAIN_BYTES = 4_000, 1 << 16  # the bounded sample: so many documents, each of so many bytes at most
STEPS, BATCH, RATE = 500, 64, 0.01
UNKNOWN = "und"
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def windows(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, WINDOW) bytes of texts laid end to end, the offsets of the texts in them, and the bytes of each."""
    sizes = np.diff(at)
    counts = np.maximum(1, -(-sizes // WINDOW))
    first = np.append(0, np.cumsum(counts))
    out = np.zeros(first[-1] * WINDOW, np.uint8)
    text = np.repeat(np.arange(len(counts)), sizes)
    out[first[text] * WINDOW + np.arange(len(data)) - at[text]] = _LOWER[data]
    lengths = np.full(first[-1], WINDOW)
    lengths[first[1:] - 1] = sizes - (counts - 1) * WINDOW
    return out.reshape(-1, WINDOW), first, lengths


class Model:
    def __init__(self, languages: list[str], seed: int = 7):
        r = np.random.default_rng(seed)
        n = lambda *s: (r.standard_normal(s) * 0.3).astype(np.float32)
        self.languages = languages
        self.weights = {"E": n(256, EMBED), "O": n(FILTERS * len(WIDTHS), len(languages)), "o": np.zeros(len(languages), np.float32)}
        self.weights |= {f"C{w}": n(w, EMBED, FILTERS) for w in WIDTHS} | {f"c{w}": np.zeros(FILTERS, np.float32) for w in WIDTHS}

    def tables(self) -> None:
        e = self.weights["E"]
        self.pairs = {w: [(e @ self.weights[f"C{w}"][j])[:, None, :] + (e @ self.weights[f"C{w}"][j + 1])[None, :, :] for j in range(0, w, 2)] for w in WIDTHS}
        self.pairs = {w: [t.reshape(-1, FILTERS) for t in ts] for w, ts in self.pairs.items()}

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The greatest value of each filter in each window, and where it stands."""
        pair = (x[:, :-1].astype(np.int32) << 8) | x[:, 1:]
        tops, places = [], []
        for w in WIDTHS:
            n = WINDOW - w + 1
            y = self.pairs[w][0].take(pair[:, :n], axis=0)
            for j, t in enumerate(self.pairs[w][1:], 1):
                y += t.take(pair[:, 2 * j : 2 * j + n], axis=0)
            tops.append(y.max(1) + self.weights[f"c{w}"])
            places.append(y)
        return np.maximum(0, np.concatenate(tops, 1)), places

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        p = self.pooled(x)[0] @ self.weights["O"] + self.weights["o"]
        p = np.exp(p - p.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)

    def gradients(self, x: np.ndarray, label: np.ndarray) -> dict:
        self.tables()
        top, values = self.pooled(x)
        p = top @ self.weights["O"] + self.weights["o"]
        p = np.exp(p - p.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(label)), label] -= 1
        p /= len(label)
        out = {"O": top.T @ p, "o": p.sum(0), "E": np.zeros_like(self.weights["E"])}
        back = (p @ self.weights["O"].T) * (top > 0)
        for i, w in enumerate(WIDTHS):
            g = back[:, i * FILTERS : (i + 1) * FILTERS]
            at = values[i].argmax(1)
            out[f"c{w}"], c = g.sum(0), np.zeros_like(self.weights[f"C{w}"])
            for j in range(w):
                b = x[np.arange(len(x))[:, None], at + j]
                c[j] = np.einsum("nf,nfe->ef", g, self.weights["E"][b])
                np.add.at(out["E"], b, g[:, :, None] * self.weights[f"C{w}"][j].T[None])
            out[f"C{w}"] = c
        return out


def train(texts: list[bytes], labels: list[str], steps: int = STEPS, seed: int = 7) -> Model:
    """Adam, a fixed number of steps whatever the size of the sample; each batch has the languages in equal parts."""
    model, r = Model(sorted(set(labels)) or [UNKNOWN], seed), np.random.default_rng(seed)
    pools = [[t for t, x in zip(texts, labels) if x == name and t] for name in model.languages]
    pools = [windows(np.frombuffer(b"".join(p), np.uint8), np.append(0, np.cumsum([len(t) for t in p])))[0] if p else np.zeros((1, WINDOW), np.uint8) for p in pools]
    m = {k: (0.0, 0.0) for k in model.weights}
    for i in range(1, steps + 1 if labels else 1):
        which = r.integers(0, len(pools), BATCH)
        x = np.stack([pools[k][r.integers(0, len(pools[k]))] for k in which])
        keep = np.where(r.random(BATCH) < 0.3, r.integers(16, WINDOW, BATCH), WINDOW)  # short texts too
        x = np.where(np.arange(WINDOW) < keep[:, None], x, 0).astype(np.uint8)
        for k, g in model.gradients(x, which).items():
            m[k] = (0.9 * m[k][0] + 0.1 * g, 0.999 * m[k][1] + 0.001 * g * g)
            rate = RATE * min(1, 3 * (1 - i / (steps + 1)))
            model.weights[k] = (model.weights[k] - rate * (m[k][0] / (1 - 0.9**i)) / (np.sqrt(m[k][1] / (1 - 0.999**i)) + 1e-7)).astype(np.float32)
    return model


def fit_language(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", train_docs: int = TRAIN_DOCS) -> Model:
    """A model from the `train_docs` rows whose keys hash least, of those with a text of 1 .. TRAIN_BYTES bytes and a language.

    The sample is bounded, so it fits the driver. Rows are counted first, so that tasks send only a share by hash that is
    ten standard deviations above `train_docs` rows; where keys repeat the sample may be that much smaller.
    """
    size = F.octet_length(text)
    rows = docs.where((size > 0) & (size <= TRAIN_BYTES) & F.col(lang).isNotNull()).select(F.xxhash64(key).alias("h"), F.col(text).alias("t"), F.col(lang).alias("l"))
    share = (train_docs + 10 * train_docs**0.5) / max(1, rows.count())
    cut = min(2**63 - 1, int(share * 2**64) - 2**63)
    got = rows.where(F.col("h") <= F.lit(cut)).orderBy("h", "t", "l").limit(train_docs).collect()
    return train([r["t"].encode() for r in got], [r["l"] for r in got])


def has_letter(data: np.ndarray) -> bool:
    low = _LOWER[data]
    return bool(((low >= 97) & (low <= 122)).any()) or bool((data >= 128).any() and any(c.isalpha() for c in data.tobytes().decode("utf-8", "ignore")))


def identify_language(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with `lang_pred` and `score`, its probability.

    Every byte of a text is in a window. A text that is null or without a letter is `und` with score 0. Ties of
    probability go to the first language by code point; repeated rows have no effect, an empty table gives an empty
    table, columns named as the new ones are replaced.
    """
    docs = without(docs, "lang_pred", "score")
    keep = docs.columns

    def run(batches):
        model.tables()
        for b in slices(batches, text, 1 << 17):
            data, at = text_bytes(b.column(text))
            x, first, lengths = windows(data, at)
            p = np.concatenate([model.probabilities(x[i : i + 256]) for i in range(0, len(x), 256)])
            p = np.add.reduceat(p * lengths[:, None], first[:-1]) / np.maximum(1, np.diff(at))[:, None]
            known = np.array([has_letter(data[i:j]) for i, j in zip(at, at[1:])], bool)
            best = p.argmax(1)
            names = [model.languages[k] if ok else UNKNOWN for k, ok in zip(best, known)]
            score = np.where(known, np.clip(np.round(p[np.arange(len(best)), best], 6), 0, 1), 0.0).astype(np.float64)
            yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [pa.array(names, pa.string()), pa.array(score)], [*keep, "lang_pred", "score"])

    return docs.mapInArrow(run, with_fields(docs.schema, "lang_pred string, score double"))
