"""License notices in whole texts: exact phrases, and short notices with a few wrong letters.

The fuzzy search splits each notice into one piece more than the errors it may have. One piece then stands unchanged in
every place that matches, so exact search for the pieces finds all candidates; the regex library's bounded-error
matching decides in a window around each.
"""

import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.common import slices, text_bytes, with_fields, without

# The phrases and labels that every result has.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Short notices in lower case, the label of each, and the letters that may be wrong, missing or added.
NOTICES = {
    "released under the mit license": ("mit", 2),
    "licensed under the apache license version 2.0": ("apache-2.0", 4),
    "licensed under the gnu general public license": ("gpl", 4),
    "licensed under cc by-nc 4.0": ("cc-by-nc", 2),
    "creative commons attribution": ("cc", 2),
    "mozilla public license": ("mpl", 2),
    "permission is hereby granted free of charge": ("mit", 4),
    "redistribution and use in source and binary forms": ("bsd", 4),
    "all rights reserved": ("reserved", 1),
}
MADE = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True
_NOT = rb"\x00-\x2F\x3A-\x60\x7B-\x7F"
_SPAN = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("errors", pa.int64())]))


def pieces(notice: str, errors: int) -> list[tuple[int, bytes]]:
    """errors + 1 pieces of the notice, which leave nothing out, with their places."""
    cuts = [round(i * len(notice) / (errors + 1)) for i in range(errors + 2)]
    return [(a, notice[a:b].encode()) for a, b in zip(cuts, cuts[1:])]


def _finder(notices: dict):
    """Seed search, and per notice its pattern for bounded errors."""
    seeds: dict[bytes, list[tuple[str, int]]] = {}
    for notice, (_, errors) in notices.items():
        for at, piece in pieces(notice, errors):
            seeds.setdefault(piece, []).append((notice, at))
    fuzzy = {n: regex.compile(rb"(?e)(?:" + regex.escape(n.encode(), special_only=True) + b"){e<=%d}" % e) for n, (_, e) in notices.items()}
    return seeds, fuzzy


def search_notices(raw: bytes, notices: dict, seeds: dict, fuzzy: dict) -> list[tuple[str, int, int, int]]:
    """(label, start, end, errors) in bytes, of the notices in one lower-case text; overlapping spans of a label are one."""
    found = []
    windows: dict[str, list[list[int]]] = {}
    for seed, uses in seeds.items():
        at = raw.find(seed)
        while at >= 0:
            for notice, place in uses:
                slack = notices[notice][1]
                lo, hi = max(0, at - place - slack), at - place + len(notice) + slack
                own = windows.setdefault(notice, [])
                own.append([lo, hi])
            at = raw.find(seed, at + 1)
    for notice, own in windows.items():
        own.sort()
        merged = [own[0]]
        for lo, hi in own[1:]:
            if lo <= merged[-1][1]:
                merged[-1][1] = max(hi, merged[-1][1])
            else:
                merged.append([lo, hi])
        for lo, hi in merged:
            for m in fuzzy[notice].finditer(raw[lo:hi]):
                found.append((notices[notice][0], lo + m.start(), lo + m.end(), sum(m.fuzzy_counts)))
    found.sort()
    spans: list[tuple[str, int, int, int]] = []
    for f in found:
        if spans and spans[-1][0] == f[0] and f[1] < spans[-1][2]:
            spans[-1] = (f[0], spans[-1][1], max(f[2], spans[-1][2]), min(f[3], spans[-1][3]))
        else:
            spans.append(f)
    return spans


def license_scan(docs: DataFrame, text: str = "text", phrases: dict = PHRASES, notices: dict = NOTICES) -> DataFrame:
    """`docs` with what its licence notices are.

    `n_words`; `n_base`, `first_word`, `last_word`, `base_labels` of the exact phrases (word by word, words counted from
    0, null without any); `spans` (label, start, end in bytes of the text in lower case, errors) of the fuzzy
    notices; `labels` of both; `score`, 1 with an exact phrase, else 1 - errors / letters of the best span, 0 without.
    Whole texts are searched. A null text is empty, ties and repeated rows have no effect, columns named as the new ones
    are replaced.
    """
    docs = without(docs, *MADE)
    keep = docs.columns
    seeds, fuzzy = _finder(notices)
    exact = [(label, len(phrase.split()), re.compile(b"(?<![^" + _NOT + b"])" + (b"[" + _NOT + b"]+").join(map(re.escape, phrase.encode().split())) + b"(?![^" + _NOT + b"])")) for phrase, label in phrases.items()]
    hint = {label: phrase.split()[0].encode() for phrase, label in phrases.items()}
    some = re.compile(b"|".join(sorted(map(re.escape, seeds), key=len)))

    def scan(batches):
        for b in slices(batches, text, 1 << 20):
            data, at = text_bytes(b.column(text))
            low = data.tobytes().lower()
            word = _IN_WORD[np.frombuffer(low, np.uint8)]
            starts = word.copy()
            starts[1:] &= ~word[:-1]
            inner = at[(at > 0) & (at < len(data))]
            starts[inner] |= word[inner]
            places = np.flatnonzero(starts)
            upto = np.searchsorted(places, at)
            rows = []
            for i in range(len(b)):
                raw = low[at[i] : at[i + 1]]
                base, spans = [], []
                for label, _, pattern in exact:
                    if hint[label] in raw:
                        base += [(int(np.searchsorted(places, at[i] + m.start()) - upto[i]), label) for m in pattern.finditer(raw)]
                if some.search(raw):
                    spans = search_notices(raw, notices, seeds, fuzzy)
                labels = {label for _, label in base}
                best = max([1 - s[3] / max(1, s[2] - s[1]) for s in spans], default=0.0)
                rows.append((int(upto[i + 1] - upto[i]), len(base), min(base)[0] if base else None, max(base)[0] if base else None, ",".join(sorted(labels)),
                             ",".join(sorted(labels | {s[0] for s in spans})), 1.0 if base else float(best), [dict(zip(("label", "start", "end", "errors"), s)) for s in spans]))
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), _SPAN]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [pa.array(x, t) for x, t in zip(zip(*rows), types)], [*keep, *MADE])

    return docs.mapInArrow(scan, with_fields(docs.schema, "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label:string,start:bigint,end:bigint,errors:bigint>>"))
