"""Operators that compare documents: near duplicates, decontamination, secrets, language model, pipeline."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import DOCS
from tideline.llm import bilinear_lm, decontaminate, graph, near_duplicates, secret_scan
from tideline.session import stage


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(1000, 1040)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    groups = {}
    for x in list(parent):
        groups.setdefault(find(x), []).append(x)
    expected = {x: min(g) for g in groups.values() for x in g}
    found = graph.components(spark.createDataFrame(links, "a bigint, b bigint"))
    assert {r["node"]: r["label"] for r in found.collect()} == expected
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(5)
    items = np.arange(400, dtype=np.uint64) * np.uint64(7919)
    a, b = rng.integers(1, 9, 400), rng.integers(0, 9, 400)
    owner = np.concatenate((np.zeros(400, np.int64), np.ones((b > 0).sum(), np.int64)))
    found = near_duplicates.signatures(owner, np.concatenate((items, items[b > 0])), np.concatenate((a, b[b > 0])), 2, 2000)
    exact = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((found[0] == found[1]).mean() - exact) < 0.04 and (found != 0).all()


def near_copies():
    """A base, many copies with few and with many edits, exact copies and a passage that others share."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(5000)}" for _ in range(150)]
    texts = []
    for k in range(160):
        words = list(base)
        for _ in range(k % 9):
            words[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    passage = base[:60]
    texts += [" ".join(passage + [f"y{rng.randrange(10**6)}" for _ in range(40)]) for _ in range(100)]
    return texts + texts[:5] + [texts[3].upper(), "one two", "one two", "One  Two\n", "", None, "a b a b a b a b a b a b"]


def test_near_duplicates_against_all_pairs(spark):
    texts = near_copies()
    rows = [(k, t, "en", "a", 0) for k, t in enumerate(texts)]
    bags = []
    for t in texts:
        w = (t or "").encode().lower().split()
        bags.append(Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter())
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            shared = (bags[i] & bags[j]).total()
            whole = (bags[i] | bags[j]).total()
            if whole == 0 or shared / whole >= 0.8:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    docs = spark.createDataFrame(rows, DOCS)
    found = {r["doc_id"]: r["class_id"] for r in near_duplicates.classes(docs).collect()}
    assert found == dict(enumerate(label))
    kept = near_duplicates.one_of_each(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == set(label)


def test_near_duplicates_of_odd_rows(docs, empty):
    kept = near_duplicates.one_of_each(docs)
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 3, 6, 7, 8, 9] and kept.columns == docs.columns
    assert near_duplicates.classes(empty).count() == near_duplicates.one_of_each(empty).count() == 0


def sellers(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        now = [i]
        for j, t in enumerate(text, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (c != t)))
        row = now
    return min(row)


def windows_of(item):
    """Folded text, budget and window of an item, by the rule of the docstring."""
    text = b" ".join(item.lower().split())
    w, step, q = decontaminate.WINDOW, decontaminate.STRIDE, decontaminate.Q
    n = max(0, len(text) - w) // step + 1
    parts = [text[k * step : len(text) if k == n - 1 else k * step + w] for k in range(n)]
    return [(p, min(int(len(p) * decontaminate.EDITS), max(0, len(p) - q) // q)) for p in parts]


def test_passages_against_full_alignment():
    """Short and long items, whole and cut, edited, with other white space: what every window's alignment finds, no more."""
    rng = random.Random(2)
    letters = "abcdefghijklmnop"
    words = [bytes(rng.choice(letters.encode()) for _ in range(rng.randint(1, 7))) for _ in range(60)]
    items = [b" ".join(rng.choice(words) for _ in range(rng.choice([1, 4, 20, 60]))) for _ in range(9)]
    index, rows = decontaminate.Items(list(range(9)), items), []
    for k in range(24):
        word = bytearray(rng.choice(items))
        if k % 3 == 0 and len(word) > 220:
            cut = rng.randint(0, len(word) - 210)
            word = word[cut : cut + 210]
        for _ in range(rng.randint(0, len(word) // 12 + 1)):
            at = rng.randrange(len(word) + 1)
            word[at : at + rng.randint(0, 1)] = rng.choice([b"", b"x"])
        if k % 2:
            word = word.replace(b" ", b" \n   ").upper()
        rows.append(b" ".join(rng.choice(words) for _ in range(rng.randint(0, 9))) + b"  " + bytes(word) + b" more\ttext")
    found = {(r, i): cost for r, i, cost, _ in decontaminate.matches(index, rows)}
    expected = {}
    for r, row in enumerate(rows):
        text = b" ".join(row.lower().split())
        for i, item in enumerate(items):
            costs = [c for c, budget in ((sellers(p, text), budget) for p, budget in windows_of(item)) if c <= budget]
            if costs:
                expected[r, i] = min(costs)
    assert found == expected and len(found) > 20


def test_passages_of_an_item_and_other_white_space():
    rng = random.Random(6)
    item = " ".join("".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(2, 9))) for _ in range(70))
    index, n = decontaminate.Items([7], [item.encode()]), len(item)
    texts = [item[: n * 6 // 10], item[n * 4 // 10 :], item[n // 4 : n // 4 + 200], item.replace(" ", "\n    "), item.upper(), item[:120], "other text"]
    rows = [f"Some words before, {t} and after.".encode() for t in texts]
    found = {r: (cost, end) for r, _, cost, end in decontaminate.matches(index, rows)}
    assert set(found) == {0, 1, 2, 3, 4} and all(cost == 0 for cost, _ in found.values())
    upto = " ".join(rows[3][: found[3][1]].decode().split())
    assert upto[-100:] in item


def test_long_repeats_of_one_character():
    ruler = "a heading\n" + "=" * 300 + "\nand a line of text under it, with enough words to tell it from all others in the world"
    index = decontaminate.Items([1], [ruler.encode()])
    found = list(decontaminate.matches(index, [b"=" * 1_000_000, b"x " + ruler.encode()]))
    assert [(r, i, cost) for r, i, cost, _ in found] == [(1, 0, 0)] or {r for r, *_ in found} == {0, 1}


def test_decontamination_of_odd_rows(spark, docs, empty):
    items = [(1, "JUMPS over the lazy dog near\tthe river"), (2, None), (None, "fox"), (4, "nowhere to be found in any text")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.contaminated(docs, benchmark).collect()
    assert sorted((r["doc_id"], r["item_id"] or 0, r["edits"]) for r in found) == [(1, 0, 0), (1, 1, 0), (2, 0, 0), (2, 1, 0)]
    assert {r["doc_id"] for r in decontaminate.clean(docs, benchmark).collect()} == {3, 4, None, 6, 7, 8, 9}
    assert decontaminate.clean(docs, benchmark.where("false")).count() == 10
    assert decontaminate.contaminated(empty, benchmark).count() == 0


ASSIGN = re.compile(
    r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def plain_spans(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


def test_secrets_against_plain_patterns(spark):
    rng = random.Random(4)
    parts = ["é", "token", "TOKEN", "=", ":", " ", '"', "secret", "api_key", "ApiKey", "abcdef", "0123456789abcdef", "AKIA", "ABCD1234", "\n", "ſecret"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 30))) for _ in range(400)] + ["token=token:abcdef"]
    docs = spark.createDataFrame([(k, t, "en", "a", 0) for k, t in enumerate(texts)], DOCS)
    for r in secret_scan.secrets(docs).collect():
        assert r["base_sha256"] == hashlib.sha256(plain_spans(texts[r["doc_id"]]).encode()).hexdigest(), texts[r["doc_id"]]


def test_ownership_parts_copied_from_live(spark, docs, empty):
    shown, own = "examplekey-0000-1111-22", "livekey-9f8e-7d6c-5b4a"
    rows = [(k, f"see {shown} in the manual number {k}", "en", f"s{k}", 0) for k in range(5)]
    rows += [(9, f"mine is {own}, do not tell", "en", "s0", 0), (10, "password=hunter22", "en", None, 0)]
    frame = spark.createDataFrame(rows, DOCS)
    found = {r["doc_id"]: r for r in secret_scan.secrets(frame).collect()}
    assert all(found[k]["spans"] == "" and found[k]["n_copied"] == 1 for k in range(5))
    assert found[9]["spans"] == "owned:8:30" and found[9]["n_live"] == 1 and found[10]["spans"] == "assign:0:17"
    masked = {r["doc_id"]: r for r in secret_scan.without_secrets(frame).collect()}
    assert masked[9]["text"] == "mine is [secret], do not tell" and masked[9]["n_chars"] == 29
    assert shown in masked[0]["text"] and masked[0]["n_chars"] == 0
    odd = secret_scan.without_secrets(docs)
    assert odd.columns == docs.columns and odd.count() == secret_scan.secrets(docs).count() == 10
    assert secret_scan.secrets(empty).count() == secret_scan.without_secrets(empty).count() == 0


def test_language_model(spark, docs, empty, monkeypatch):
    monkeypatch.setattr(bilinear_lm, "FREQUENT", 40)
    rng = random.Random(8)
    rows = [(k, " ".join(rng.choice(["The cat", "a dog", "sees it"]) + f" w{rng.randrange(90)}" for _ in range(60)), "en", "a", 0) for k in range(80)]
    train = spark.createDataFrame(rows, DOCS)
    model = bilinear_lm.train(train)
    assert np.allclose((10.0**model.table).sum(axis=1), 1, atol=1e-4)
    words = lambda t: [*(t or "").encode().lower().split(), b""]
    counts = Counter(w for r in rows for w in words(r[1]))
    total, distinct = counts.total(), len(counts)
    everything = train.select(*DOCS.replace(",", "").split()[::2]).union(docs.select(*DOCS.replace(",", "").split()[::2]))
    found = bilinear_lm.scored(everything, model, [F.col("doc_id"), F.col("text")]).collect()
    assert len(found) == 90
    for r in found:
        listed = words(r["text"])
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in listed)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(listed), sum(w in counts for w in listed), total)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
    trained = {r[1] for r in rows}
    own = [r for r in found if r["text"] in trained]
    assert sum(r["score"] for r in own) > sum(r["base_score"] for r in own)
    assert bilinear_lm.scored(empty, model, [F.col("doc_id")]).count() == 0
    nothing = bilinear_lm.scored(docs, bilinear_lm.train(empty), [F.col("doc_id")]).collect()
    assert len(nothing) == 10 and all(r["n_known"] == 0 for r in nothing)


def test_class_model_beats_smoothed_bigrams_on_held_out_text():
    """Context classes of real texts: the model's score of held-out classes is above that of add-one bigrams."""
    rows = [(r[0], r[1].encode()) for r in duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.01/documents.parquet' WHERE text IS NOT NULL").fetchall()]
    words = lambda row: [*bilinear_lm.words(row), bilinear_lm.END]
    counts = Counter(w for _, row in rows for w in words(row))
    size, end = bilinear_lm.CLASSES, 0
    top = [bilinear_lm.END, *[w for w, _ in counts.most_common(size) if w != bilinear_lm.END]][: size - 40]
    number = {w: k for k, w in enumerate(top)}
    sets = (Counter(), Counter())
    for doc_id, row in rows:
        before, last = end, end
        for word in words(row):
            now = number.get(word, size - 40 + zlib.crc32(word[-2:]) % 40)
            # The nearest token of the context is the lowest digit.
            sets[doc_id % 5 == 0][(before * size + last) * size + now] += 1
            before, last = last, now
    gram, n = (np.array(x) for x in zip(*sets[0].items(), strict=True))
    held, m = (np.array(x) for x in zip(*sets[1].items(), strict=True))
    table = bilinear_lm.fitted(gram, n)
    pairs = np.ones((size, size))
    np.add.at(pairs, (gram // size % size, gram % size), n)
    pairs /= pairs.sum(axis=1, keepdims=True)
    model = (table[held // size, held % size] * m).sum() / m.sum()
    bigrams = (np.log10(pairs[held // size % size, held % size]) * m).sum() / m.sum()
    assert model > bigrams + 0.02


def test_pipeline_stages(spark, docs):
    sf_dir = "/root/testdata/sf0.001"
    rows = docs
    for name, step in corpus_pipeline.STAGES:
        rows = stage(step(spark, rows, sf_dir), name)
        assert rows.columns[: len(docs.columns)] == docs.columns
    found = {r["doc_id"]: r for r in rows.collect()}
    assert set(found) == {None, 1, 6, 8, 9} and found[8]["text"] == "[secret] and [secret] tail [secret]"
    assert all(len(r["ids"]) > 0 for r in found.values())


def test_class_model_learns_every_counted_pair():
    """Few distinct pairs are passed over until they are learned, rare ones beyond their share of all tokens."""
    classes = bilinear_lm.CLASSES
    before, last = np.divmod(np.arange(8 * classes), classes)
    gram = (before * classes + last) * classes + (last + 1) % classes
    n = np.where(last % 16 == 5, 1, 40)
    found = bilinear_lm.fitted(gram, n).reshape(-1)[gram]
    assert found[n == 40].mean() > -0.3 and found[n == 1].mean() > np.log10(1 / n.sum()) + 0.5
    assert np.array_equal(found, bilinear_lm.fitted(gram[::-1], n[::-1]).reshape(-1)[gram])
