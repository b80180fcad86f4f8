"""Spelling variants and periodic runs against plain Python, the quality classifier against held-out labels."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.llm import periodic_runs, quality, spelling


def edits(word, letters):
    """All texts one edit away."""
    out = {word[:k] + word[k + 1 :] for k in range(len(word))}
    out |= {word[:k] + c + word[k + 1 :] for k in range(len(word)) for c in letters}
    out |= {word[:k] + c + word[k:] for k in range(len(word) + 1) for c in letters}
    return out - {word}


def expected_variants(counts):
    letters, out, form = set("".join(counts)), {}, {}
    for word, n in counts.items():
        near = sorted((-counts[x], x) for x in edits(word, letters) & counts.keys())
        form[word] = near[0][1] if near and -near[0][0] >= 10 * n else None
        out[word] = len(near)
    rows = set()
    for word, n in counts.items():
        root = word
        while form[root]:
            root = form[root]
        rows.add((word, form[word], root, n, out[word], counts[form[word]] if form[word] else None))
    return rows


@pytest.mark.parametrize("alphabet, cell", [("abcdeéÿ", 40), ("abÀ", 25), ("abcdefghijklmnop", 10_000)])
def test_variants_are_those_of_all_pairs(spark, alphabet, cell):
    """Many cells and one, few letters (whole leaves of anagrams) and many, chains of forms."""
    rng = random.Random(len(alphabet))
    words = {"".join(rng.choice(alphabet) for _ in range(rng.randint(7, 10))) for _ in range(300)}
    for word in list(words)[:150]:
        words |= set(rng.sample(sorted(edits(word, alphabet)), 3))
    counts = {word: 3 ** rng.randint(0, 12) for word in words}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = spelling.variants(frame, cell=cell).collect()
    assert len(found) == len(counts) and {tuple(r) for r in found} == expected_variants(counts)


def test_large_leaves_of_anagrams_are_told_by_keys():
    rng = random.Random(3)
    known = sorted({"".join(rng.sample("abcdefgh", 8)) for _ in range(600)})
    asked = sorted({rng.choice(sorted(edits(w, "abcx"))) for w in known[:80]} | set(known[:5]))
    cell = spelling.Cell([w.encode() for w in known], [1] * len(known))
    for size in (7, 8, 9):
        same = [w for w in asked if len(w) == size]
        at, to = cell.near(spelling.Words([w.encode() for w in same]))
        pairs = {(same[a], cell.words[b].decode()) for a, b in zip(at, to, strict=True)}
        assert pairs == {(w, x) for w in same for x in edits(w, "abcdefghx") & set(known)} and len(pairs) == len(at)


def test_words_of_documents(spark, docs, empty):
    rows = [(5, "Árbolito árbolito ÁRBOLITO zzzzzzz×x"), (None, "HOUSEHOLD household houſehold"), (6, None), (6, "")]
    frame = spark.createDataFrame(rows, "doc_id int, text string").withColumn("word", F.lit("clash")).withColumn("n", F.lit(0))
    found = {r["word"]: r["n"] for r in spelling.counted_words(frame).collect()}
    assert found == {"Árbolito": 2, "árbolito": 1, "zzzzzzz×x": 1, "household": 2}
    count = Counter()
    for r in docs.collect():
        for run in spelling.re.findall("[A-Za-zÀ-ÿ]+", r["text"] or ""):
            run = run.lower()
            h = zlib.crc32(f"{'null' if r['doc_id'] is None else r['doc_id']}:{run}".encode())
            count[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    words = {r["word"]: r["n"] for r in spelling.counted_words(docs, change=spelling.without_letter).collect()}
    assert words == {w: n for w, n in count.items() if len(w) >= 7}
    nothing = spelling.variants(spelling.counted_words(empty))
    assert nothing.count() == 0 and nothing.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def plain_runs(words):
    """Every stretch of every period; the least period of equal stretches counts."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        at = q
        while at < len(words):
            begin = at
            while at < len(words) and words[at] == words[at - q]:
                at += 1
            if at - begin + q >= max(6, 4 * q):
                found.setdefault((begin - q, at), q)
            at += 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def test_runs_are_those_of_all_periods():
    rng = random.Random(5)
    for _ in range(4000):
        words, size, kinds = [], rng.randint(0, 70), rng.choice([1, 2, 3, 9])
        while len(words) < size:
            if words and rng.random() < 0.4:
                words += words[-rng.randint(1, 14) :] * rng.randint(1, 6)
                del words[len(words) - rng.randint(0, 3) :]
            else:
                words.append(b"%d" % rng.randrange(kinds))
        assert periodic_runs.runs(words) == plain_runs(words)


def test_runs_of_very_long_texts_take_little_time():
    assert periodic_runs.runs([b"x"] * 100_000) == [(0, 100_000, 1)]
    ragged = ([b"a"] * 999 + [b"b"]) * 40
    found = periodic_runs.runs(ragged)
    assert found[0] == (0, 999, 1) and (0, 40_000, 1000) in found and len(found) == 41


def test_runs_of_documents(spark, docs, empty):
    texts = [(k, " ".join(f"w{k * j % 7}" for j in range(40))) for k in range(40)] + [(41, "a\x0b\x1ca\ta a a a"), (42, "ü ü ü ü ü ü b c b c")]
    frame = spark.createDataFrame(texts, "doc_id long, text string").withColumn("runs", F.lit(1)).withColumn("words", F.lit(2))
    frame = frame.unionByName(docs.select("doc_id", "text", F.lit(1).alias("runs"), F.lit(2).alias("words")))
    changed = 0
    for own, rows in zip(frame.collect(), periodic_runs.digests(periodic_runs.with_runs(frame, change=periodic_runs.recurring)).collect(), strict=True):
        words = (own["text"] or "").encode().split()
        n, h = len(words), zlib.crc32(str(own["doc_id"]).encode())
        if own["doc_id"] is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            changed += 1
        if n > 5000:
            continue
        found = plain_runs(words)
        s, size, q = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        gone = {i for s_, n_, q_ in found for i in range(s_ + q_, s_ + n_)}
        text = b" ".join(w for i, w in enumerate(words) if i not in gone)
        lines = "".join(f"{s_},{n_},{q_}\n" for s_, n_, q_ in found).encode()
        digest = (hashlib.sha256(lines).hexdigest(), hashlib.sha256(text).hexdigest())
        assert tuple(rows) == (own["doc_id"], len(found), s, size, q, found and 1000 * size // q or None, *digest, n)
    assert changed > 1
    assert periodic_runs.digests(periodic_runs.with_runs(empty)).count() == 0


def test_features_of_a_text():
    """Words, pairs and n-grams as counted by hand; texts don't see each other."""
    one, owner = quality.features([b"ab cd", b"", "é é".encode()])
    # Two words, a pair, the n-grams of " ab " and " cd " (2 + 1 each), the end.
    assert Counter(owner.tolist()) == {0: 2 + 1 + 6 + 1, 1: 1, 2: 2 + 1 + 2 + 1}
    alone, _ = quality.features([b"ab cd"])
    assert sorted(alone) == sorted(one[owner == 0])
    same = [Counter(quality.features([t])[0].tolist()) for t in (b"ab ab", b"cd cd")]
    assert len(same[0] & same[1]) == 2


def labelled(spark, n):
    rng = random.Random(n)
    good = ["river", "house", "green", "walks", "under", "little", "morning", "and", "the"]
    rows, labels = [], []
    for k in range(n):
        words = [rng.choice(good) for _ in range(rng.randint(0, 60))]
        bad = k % 5 == 3
        if bad:
            words = [w.upper() + "!!" for w in words] if k % 2 else [w for w in words for _ in range(6)]
        rows.append((k, " ".join(words)))
        labels.append((k, int(not bad) if words else 1))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_quality_of_held_out_texts(spark):
    docs, labels = labelled(spark, 900)
    own = labels.where(~quality.held_out()).unionByName(spark.createDataFrame([(None, 1), (7, None), (8, 5)], labels.schema))
    model = quality.train(docs, own)
    found = quality.scored(docs, model, [F.col("doc_id"), quality.held_out().alias("held_out")]).join(labels, "doc_id").collect()
    out = [r for r in found if r["held_out"]]
    assert len(found) == 900 and len(out) > 100
    assert np.mean([r["predicted"] == r["quality"] for r in out]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found)
    again = quality.train(docs.repartition(3), own)
    assert np.array_equal(model.weights, again.weights)


def test_quality_of_odd_rows(spark, docs, empty):
    some = spark.createDataFrame([(1, 1), (1, 1), (8, 1), (77, 0)], "doc_id long, quality int")
    for labels in (some, some.where("false")):
        model = quality.train(docs, labels)
        rows = quality.scored(docs, model, [F.col("doc_id")]).collect()
        assert len(rows) == 10 and all(0 <= r["score"] <= 1 for r in rows)
        same = {r["score"] for r in rows if r["doc_id"] in (1, 2)}
        assert len(same) == 1 and len({r["score"] for r in rows if r["doc_id"] in (3, 4)}) == 1
        assert quality.scored(empty, model, []).count() == 0
    assert {r["score"] for r in rows} == {0.5}
