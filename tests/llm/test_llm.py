"""The corpus operators against brute force, exact round trips and held-out accuracy, and on odd rows."""

import hashlib
import re
import string
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from upkeep.llm import chat, decontaminate, fingerprint, language, licenses, mixing, neardup, quality, queries, suffix, warc
from upkeep.llm.graph import components

DIR = "/root/testdata/sf0.001"
BIG = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
LONG = " ".join(f"word{i * 7919 % 30011}" for i in range(30000))
# Null key, null text, empty, one word, no word, twice the same row, and a very long text; with columns that clash.
ODD = [(1, None, "a"), (None, "some words of no key", "a"), (2, "", None), (3, "one", "b"), (4, "!!!", "b"), (5, "twice the same row", "b"), (5, "twice the same row", "b"), (6, LONG, None)]
CLASH = "spans int, SIZE int, score int, class_id int, __a int, n_words int, signature int, lang_pred int, target int, kept int, items int, fingerprint int, weight double"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string, source string")
    for c in CLASH.split(", "):
        df = df.withColumn(c.split()[0], F.lit(1))
    return df


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text", "source", "lang")


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


# 1

def brute_repeats(texts, size):
    count = Counter(t[p : p + size] for t in texts for p in range(len(t) - size + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - size + 1):
            if count[t[p : p + size]] > 1:
                gone[p : p + size] = True
        gone = gone[:-1]
        out.append((len(t), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) > 0).sum()), bytes(np.frombuffer(t, np.uint8)[~gone])))
    return out


def test_suffix_order_and_prefixes():
    rng = np.random.default_rng(0)
    for _ in range(100):
        data = rng.integers(97, 97 + rng.choice([1, 2, 20]), 200).astype(np.uint8)
        data[120:160] = data[:40]
        wanted = np.zeros(200, bool)
        wanted[rng.integers(0, 90) : 176] = True
        order = suffix.suffix_order(data, wanted, 24)
        keys = [bytes(data[p : p + 24]) for p in order]
        assert sorted(order) == list(np.flatnonzero(wanted)) and keys == sorted(keys)
        shared = suffix.common_prefixes(data, order, 24)
        for i in range(1, len(order)):
            same = next((j for j in range(24) if keys[i][j] != keys[i - 1][j]), 24)
            assert shared[i] == same


@pytest.mark.parametrize("segments", [2, 1000])
def test_suffix_dedup_equals_brute_force(spark, docs, monkeypatch, segments):
    monkeypatch.setattr(suffix, "SEGMENTS", segments)  # 2: every key is cut finer
    extra = [(10**6 + i, f"{i} " * 30 + LONG[5000:5390] + f" {i * i} " * 20, "x", "en") for i in range(40)] + [(-1, "ab" * 900, "x", "en"), (-2, None, "x", "en")]
    rows = docs.unionByName(spark.createDataFrame(extra, docs.schema)).collect()
    got = {r["doc_id"]: r for r in suffix.suffix_dedup(spark.createDataFrame(rows, docs.schema), min_bytes=200).collect()}
    for r, want in zip(rows, brute_repeats([(r["text"] or "").encode() for r in rows], 200)):
        g = got[r["doc_id"]]
        assert (g["n_bytes"], g["n_removed"], g["n_spans"], bytes(g["kept"])) == want


def test_suffix_dedup_odd_rows(odd):
    got = suffix.suffix_dedup(odd, min_bytes=64)
    rows = {(r["doc_id"], r["n_bytes"], r["n_removed"]) for r in got.collect()}
    assert rows == {(1, 0, 0), (None, 20, 0), (2, 0, 0), (3, 3, 0), (4, 3, 0), (5, 18, 0), (6, len(LONG), 0)}
    assert suffix.suffix_dedup(odd.limit(0), min_bytes=64).count() == 0


# 2

def test_near_classes_hold_all_similar_pairs(spark, docs):
    rows = docs.collect()
    got = {r["doc_id"]: r for r in neardup.near_classes(docs).collect()}
    sets = [set(zip(*[words(r["text"])[i:] for i in range(5)])) for r in rows]
    joined = 0
    for i, a in enumerate(sets):
        for j in range(i):
            alike = bool(a and sets[j]) and len(a & sets[j]) / len(a | sets[j])
            same = got[rows[i]["doc_id"]]["class_id"] == got[rows[j]["doc_id"]]["class_id"]
            joined += same
            assert same or alike < 0.8
            assert not same or alike > 0.2 or words(rows[i]["text"]) == words(rows[j]["text"])
    assert joined > 0
    size = Counter(r["class_id"] for r in got.values())
    assert all(r["class_size"] == size[r["class_id"]] and r["is_first"] == (r["class_id"] == r["doc_id"]) for r in got.values())


def test_edit_similar_equals_dynamic_programming():
    rng = np.random.default_rng(1)
    for _ in range(300):
        x = rng.integers(0, 6, rng.integers(1, 30))
        y = x.copy()
        for _ in range(rng.integers(0, 8)):
            p = rng.integers(0, max(1, len(y)))
            y = [np.insert(y, p, 9), np.delete(y, p) if len(y) > 1 else y, np.concatenate([y[:p], [7], y[p + 1 :]])][rng.integers(0, 3)]
        d = np.arange(len(y) + 1)
        for i in range(len(x)):
            e = d.copy()
            e[0] = i + 1
            for j in range(len(y)):
                e[j + 1] = min(d[j + 1] + 1, e[j] + 1, d[j] + (x[i] != y[j]))
            d = e
        assert neardup.edit_similar(x, y, 0.8) == (d[-1] <= int(0.2 * max(len(x), len(y)) + 1e-9))


def test_near_classes_with_a_common_passage(spark):
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(base[:60] + [f"{k}x{i}" for i in range(60)] + ([f"e{n}"] if n else [])) for k in range(12) for n in range(3)]
    got = neardup.near_classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == {i: i - i % 3 for i in range(36)}


def test_near_odd_rows(odd):
    got = neardup.near_classes(odd)
    assert sorted((r["doc_id"] or 0, r["class_id"] or 0, r["class_size"]) for r in got.collect()) == sorted([(1, 1, 2), (2, 1, 2), (0, 0, 1), (3, 3, 1), (4, 4, 1), (5, 5, 2), (5, 5, 2), (6, 6, 1)])
    assert sorted(r["doc_id"] or 0 for r in neardup.one_of_each(odd).collect()) == [0, 1, 3, 4, 5, 6]
    assert neardup.near_classes(odd.limit(0)).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)]
    got = components(spark.createDataFrame(links, "x long, y long")).collect()
    assert {r["node"]: r["root"] for r in got} == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


# 3

def test_warc_round_trip(spark, tmp_path):
    page = "<p>" + "x" * 200
    rows = [(9, "http://a", page), (3, "http://b\r\nX: y", page), (5, None, page), (4, "u", "small"), (8, "u", "small"), (7, "u", None), (None, "n", page), (None, "n", "no key é" * 20), (3, "http://b", page)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record_type", F.lit(1))
    warc.write_warc(pages, f"{tmp_path}/one", shard_bytes=2000, roll_bytes=700)
    got = warc.read_warc(spark, f"{tmp_path}/one").collect()
    want = Counter()
    for i, _, html in rows:
        raw = (html or "").encode()
        again = html == page and i != 3
        want[(i, len(raw), sha(raw), "revisit" if again else "response", 3 if again else None)] += 1
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == want
    warc.write_warc(pages.repartition(5), f"{tmp_path}/two", shard_bytes=2000, roll_bytes=700)
    read = lambda n: (tmp_path / n / "MANIFEST.jsonl").read_text()
    assert read("one") == read("two") and read("one").count("\n") > 1
    assert not [p for p in (tmp_path / "one").iterdir() if p.name.endswith(".tmp")]
    warc.write_warc(pages.limit(0), f"{tmp_path}/none")
    assert warc.read_warc(spark, f"{tmp_path}/none").count() == 0


# 4

def test_mix(spark, docs):
    got = queries.op4_source_mixing(spark, BIG).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, queries.op4_source_mixing(spark, BIG).collect()))
    names = sorted({r["source"] for r in spark.read.parquet(f"{BIG}/documents.parquet").select("source").distinct().collect()})
    of = {r["doc_id"]: r["source"] for r in spark.read.parquet(f"{BIG}/documents.parquet").collect()}
    size, taken, target, largest = Counter(), Counter(), {}, Counter()
    for r in got:
        s = of[r["doc_id"]]
        size[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
        largest[s] = max(largest[s], r["size"])
        assert r["taken"] % max(1, r["size"]) == 0 and r["taken"] <= 3 * r["size"]
    want, open_ = {}, set(names)
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    while True:
        left = sum(size.values()) - sum(want.values())
        over = [s for s in open_ if left * weight[s] / sum(weight[x] for x in open_) > 3 * size[s]]
        if not over:
            break
        want |= {s: 3 * size[s] for s in over}
        open_ -= set(over)
    want |= {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
    for s in names:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - target[s]) <= largest[s] / 2 + 1


def test_mix_odd_rows(odd):
    got = mixing.mix(odd, quality=odd.select("doc_id", "weight")).collect()
    assert Counter(r["size"] for r in got) == Counter([0, 5, 0, 1, 1, 4, 4, 30000])
    assert {r["source_size"] for r in got if r["source"] is None} == {30000}
    assert mixing.mix(odd.limit(0)).count() == 0


# 5

def test_license_scan_base_and_fuzzy(spark, odd):
    texts = ["CC-BY and cc  by, all rights\nreserved.", "xcc by", "general public licensed", "Released undr the MIT Licence.", "GENERAL PUBLIC LICENSE", "ééall rights reserved", "nothing", None, LONG]
    got = licenses.license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    phrases = {p: tuple(p.split()) for p in licenses.PHRASES}
    for r, t in zip(got, texts):
        w = words(t)
        places = [(i, licenses.PHRASES[p]) for p, q in phrases.items() for i in range(len(w)) if tuple(w[i : i + len(q)]) == q]
        assert (r["n_words"], r["n_base"]) == (len(w), len(places))
        assert (r["first_word"], r["last_word"]) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))
    assert got[3]["labels"] == "mit" and 0.9 < got[3]["score"] < 1 and got[3]["spans"][0]["errors"] == 2
    assert got[6]["score"] == 0 and licenses.license_scan(odd).count() == 8 and licenses.license_scan(odd.limit(0)).count() == 0


def test_fuzzy_search_finds_what_the_whole_scan_finds(docs):
    seeds, fuzzy = licenses._finder(licenses.NOTICES)
    rng = np.random.default_rng(2)
    for r in docs.limit(40).collect():
        raw = bytearray(r["text"].lower().encode()[:3000])
        for notice, (_, errors) in licenses.NOTICES.items():
            bad = bytearray(notice.encode())
            for p in rng.choice(len(bad), errors, replace=False):
                bad[p] = 0x7A
            raw += b" | " + bad
        found = licenses.search_notices(bytes(raw), licenses.NOTICES, seeds, fuzzy)
        whole = {licenses.NOTICES[n][0] for n, p in fuzzy.items() if p.search(bytes(raw))}
        assert {f[0] for f in found} == whole == {x for x, _ in licenses.NOTICES.values()}


# 6

def test_decontaminate_equals_brute_force(spark, docs, odd):
    items = [(1, " ".join(f"Item{i}" for i in range(25))), (2, "short item here"), (3, "Solo"), (4, None), (5, "..."), (None, "no key item of ten words is left out of items"), (1, " ".join(f"Item{i}" for i in range(25)))]
    extra = [(10**6, "x " + " ".join(f"item{i}" for i in range(3, 13)) + " y", "s", "en"), (10**6 + 1, "a short, ITEM here solo solo " + " ".join(f"item{i}" for i in range(9)), "s", "en"), (10**6 + 2, None, "s", "en"),
             (10**6 + 3, " ".join(f"item{i}" for i in range(12)) + " " + " ".join(f"item{i}" for i in range(8, 25)), "s", "en")]
    bench = spark.createDataFrame([(i, t) for i, t in items], "item_id long, text string").unionByName(spark.read.parquet(f"{DIR}/benchmark.parquet").withColumn("item_id", F.col("item_id") + 100))
    all_docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    got = {r["doc_id"]: r for r in decontaminate.decontaminate(all_docs, bench).collect()}
    windows = {}
    for i, t in bench.collect():
        w = words(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(i)
    for r in all_docs.collect():
        w, hit, of = words(r["text"]), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    of |= windows[tuple(w[k : k + n])]
        g = got[r["doc_id"]]
        assert (g["n_words"], g["n_hit"], g["items"], g["contaminated"]) == (len(w), len(hit), sorted(str(x) for x in of if x is not None), bool(hit))
    assert decontaminate.decontaminate(odd, bench).count() == 8 and decontaminate.decontaminate(odd, bench.limit(0)).where("contaminated").count() == 0


# 7

def test_chat_round_trip(spark):
    turns = [(1, 2, "assistant", "b & <t> [/user] </s>"), (1, 1, "user", "a"), (1, 3, "assistant", "again"), (1, None, "us]er", "null turn"), (2, 1, None, None), (2, 1, "assistant", ""), (None, 1, "user", "no key"), (3, 1, "x", "&lt;"), (3, 1, "x", "&lt;")]
    turns += [(4, i, ["user", "assistant"][i // 3 % 2], f"t{i}") for i in range(1000)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(0))
    got = chat.format_chat(df).select("conv_id", "n_turns", "formatted", "segments", chat.read_chat(F.col("formatted")).alias("turns"), chat.masked_text(F.col("segments")).alias("loss")).collect()
    for r in got:
        own = sorted([(t[1] is None, t[1] or 0, t[2] or "", t[3] or "") for t in turns if t[0] == r["conv_id"]])
        assert [tuple(t) for t in r["turns"]] == [t[2:] for t in own] and r["n_turns"] == len(own)
        assert r["loss"] == "".join(t[3] for t in own if t[2] == "assistant")
        assert r["formatted"] == "".join(s["text"] for s in r["segments"])
    assert len(got) == 5 and next(r for r in got if r["conv_id"] == 1)["formatted"].count("[assistant]") == 1
    assert chat.format_chat(df.limit(0)).count() == 0


def test_chat_query(spark):
    got = {r["conv_id"]: r for r in queries.op7_chat_formatting(spark, DIR).collect()}
    rows = {}
    for r in spark.read.parquet(f"{DIR}/conversations.parquet").collect():
        rows.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"] or ""))
    rows[-7] = [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]
    assert set(got) == set(rows)
    for c, own in rows.items():
        own.sort()
        loss = "".join(t for _, role, t in own if role == "assistant")
        assert (got[c]["n_turns"], got[c]["turns_sha256"], got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(own), sha("".join(f"{r}\n{t}\n" for _, r, t in own)), len(loss), sha(loss))


# 8, 10

def test_quality_held_out(spark, odd):
    got = {r["doc_id"]: r for r in queries.op8_quality_classifier(spark, BIG).collect()}
    marks = [(got[r["doc_id"]], r["quality"]) for r in spark.read.parquet(f"{BIG}/labels.parquet").collect() if got[r["doc_id"]]["held_out"]]
    assert len(marks) > 50 and np.mean([g["predicted"] == q for g, q in marks]) > 0.95
    model = quality.Model()
    assert quality.score_quality(odd, model).where("score between 0 and 1").count() == 8 and quality.score_quality(odd.limit(0), model).count() == 0


def test_quality_gradients():
    x, first = quality.passages(*_packed([b"some text " * 90, b"", b"OTHER!! " * 200]))
    model, label = quality.Model(3), np.array([1, 0, 0], np.float32)
    for name in model.NAMES:
        setattr(model, name, getattr(model, name).astype(np.float64))
    loss = lambda: -np.mean([np.log(y if t else 1 - y) for y, t in zip(model.forward(x, first)["y"], label)])
    for name, g in model.gradients(x, first, label).items():
        w = getattr(model, name)
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = w[at]
        w[at] = old + 1e-5
        up = loss()
        w[at] = old - 1e-5
        assert (up - loss()) / 2e-5 == pytest.approx(g[at], rel=1e-2, abs=1e-6)
        w[at] = old


def _packed(texts):
    return np.frombuffer(b"".join(texts), np.uint8), np.append(0, np.cumsum([len(t) for t in texts]))


def test_language_held_out(spark, odd):
    got = {r["doc_id"]: r for r in queries.op10_language_id(spark, BIG).collect()}
    rows = [(got[r["doc_id"]]["lang_pred"], r["lang"]) for r in spark.read.parquet(f"{BIG}/documents.parquet").collect() if got[r["doc_id"]]["held_out"]]
    assert len(rows) > 100 and np.mean([a == b for a, b in rows]) > 0.95
    model = language.train([], [])
    got = language.identify_language(odd, model).collect()
    assert {r["doc_id"]: r["score"] for r in got if r["lang_pred"] == "und"}[4] == 0 and len(got) == 8


# 9

def test_fingerprints(spark, odd, docs):
    rows = docs.select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in queries.op9_weighted_sampling(spark, DIR).collect()}
    order = sorted(rows, key=lambda r: -r["doc_id"])
    errors = []
    for r, n in zip(order, order[1:] + order[:1]):
        half = len(r["text"]) // 2
        edited = r["text"][: len(r["text"]) - half] + n["text"][:half]
        g = got[r["doc_id"]]
        assert g["n_chars"] == len(r["text"]) and g["edited_sha256"] == sha(edited)
        a, b, c = (Counter(re.sub(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ", t.lower()).split()) for t in (r["text"], edited, n["text"]))
        for x, y, near in ((a, b, g["near_edited"]), (a, c, g["near_next"])):
            errors.append(near - sum((x & y).values()) / sum((x | y).values()))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.1
    assert {r["text"]: got[r["doc_id"]]["fingerprint"] for r in rows} == {r["text"]: got[r["doc_id"]]["fingerprint"] for r in reversed(rows)}
    marked = fingerprint.fingerprint(odd).collect()
    assert len(marked) == 8 and len({r["fingerprint"] for r in marked if r["doc_id"] in (1, 2)}) == 1 and fingerprint.fingerprint(odd.limit(0)).count() == 0
    assert fingerprint.edited_fingerprints(odd).count() == 8 and fingerprint.edited_fingerprints(odd.limit(0)).count() == 0


# The pipeline

def test_pipeline(spark, docs):
    import corpus_pipeline as p

    out = {r["doc_id"]: r for r in p.run(spark, DIR).collect()}
    assert 0 < len(out) < docs.count() and sum(r["taken"] for r in out.values()) > 0
    kept = spark.read.parquet(f"{DIR}/documents.parquet")
    assert sorted(p.near_dedup(spark, kept, DIR).columns) == sorted(kept.columns) == sorted(p.suffix_dedup(spark, kept, DIR).columns)
    assert [n for n, _ in p.STAGES] == ["quality classifier", "MinHash near-dedup", "suffix-array dedup", "benchmark decontamination", "mixing sources to target weights"]
    for r in out.values():
        assert r["n_chars"] == len(r["text"])
