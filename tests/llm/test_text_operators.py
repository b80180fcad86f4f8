"""Operators that read each text on its own: encoding, HTML, shards, token files, languages, fingerprints."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tideline.llm import fingerprints, html_text, language_id, lexicon_bpe, secret_scan, shards, token_files
from tideline.session import new_path

ODD = "abcXYZéÉßıİŉǅƓ ²½٣_'-.,!\t\n\x0b\x1c\x85\xa0<|>s't're0123456789ñÑÿŸΣςσ́漢😀Ⅷ"


def library(name):
    out = Tokenizer.from_file(public_tokenizers.path(name))
    out.no_truncation()
    out.no_padding()
    return out


def odd_texts(n):
    rng = random.Random(n)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return [*texts, "<|endoftext|>", "a  <|endoftext|> b", "<|startoftext|>x", "two  blanks \n here "]


def test_lexicon_encodes_and_decodes_as_the_library():
    path = public_tokenizers.path(lexicon_bpe.VOCABULARY)
    scheme, texts = lexicon_bpe.Scheme(path), odd_texts(600)
    words = sorted({w.encode() for t in texts[:200] for w in scheme.words(t.encode()) if w not in scheme.special})
    ids = [scheme.merged(w.decode()) for w in words]
    begins = np.concatenate(([0], np.cumsum([len(i) for i in ids])))
    lexicon = {**lexicon_bpe.compiled(words), "ids": np.array(sum(ids, []), np.uint32), "begins": begins}
    encoder, known = lexicon_bpe.Encoder(path, lexicon), library(lexicon_bpe.VOCABULARY)
    found, at = encoder.encode([t.encode() for t in texts])
    for k, text in enumerate(texts):
        expected = known.encode(text, add_special_tokens=False).ids
        assert found[at[k] : at[k + 1]].tolist() == expected, text
        assert encoder.scheme.decoded(expected) == known.decode(expected, skip_special_tokens=False)


def test_lexicon_automaton_is_minimal_and_numbers_its_words():
    words = sorted(f"{a}{b}ing".encode() for a in "abcdefgh" for b in "xyz")
    automaton = lexicon_bpe.Automaton(lexicon_bpe.compiled(words))
    assert len(automaton.final) == 6
    data = np.frombuffer(b"\n".join([*words, b"axin", b"axings", b"q"]) + b"\n", np.uint8)
    end = np.flatnonzero(data == 10)
    begin = np.concatenate(([0], end[:-1] + 1))
    assert automaton.places(data, begin, end).tolist() == [*range(len(words)), -1, -1, -1]


def test_encoded_rows_keep_their_columns(docs, empty):
    rows = lexicon_bpe.encoded(docs).collect()
    known = library(lexicon_bpe.VOCABULARY)
    assert all(r["ids"] == known.encode(r["text"] or "", add_special_tokens=False).ids and r["row"] == "x" for r in rows)
    assert len(rows) == 10 and lexicon_bpe.digests(empty).count() == 0
    back = lexicon_bpe.decoded(lexicon_bpe.encoded(docs.where("doc_id = 1"))).first()
    assert back["decoded"] == known.decode(back["ids"], skip_special_tokens=False)


PAGE = """<html><head><title>No</title><script>var x = "<p>no, no, no, no</p>"</script></head><body>
<div id="header"><a href=x>Home</a></div><div class="main-menu"><ul><li><a href=x>One, two, three, four, five words</a></ul></div>
<div class=wrap><div class="content"><h2>Title &amp; more</h2><p>First   paragraph, with commas, and a length that counts.
<p>Second <b>paragraph</b>, also long enough, and with text.<div class="ad-box">Buy now, cheap, very cheap stuff</div></div>
<div id="comments"><p>Nice article, I liked it, very much, thanks a lot for it all.</div></div>
<form><label>Name</label></form><footer>foot, foot, foot, foot, foot</footer></body></html>"""


def test_main_text_of_a_page():
    assert html_text.main_text(PAGE) == (
        "Title & more First paragraph, with commas, and a length that counts. Second paragraph, also long enough, and with text."
    )


LONG = "".join(f"<p>Paragraph {k}, with commas, and so many words that it counts as a good one.</p>" for k in range(10))


@pytest.mark.parametrize("around", ["<div class=story>{}</div>", "<body>{}</body>", "<div><div>{}</div><ul><li><a href=x>Other page of the site</a></ul></div>"])
def test_main_text_without_an_article_element_is_whole(around):
    """Headings, short sections, lists and short paragraphs beside the best container belong to the article."""
    inner = "<h1>Title</h1><section>" + LONG + "</section><section><p>Short closing paragraph.</p></section><ul><li>One<li>Two</ul><p>End <a href=x>here</a>.</p>"
    found = html_text.main_text(around.format("<div><a href=x>Home</a></div>" + inner))
    assert found.startswith("Title Paragraph 0, with") and found.endswith("counts as a good one. Short closing paragraph. One Two End here.")


@pytest.mark.parametrize(
    "page, text",
    [("", ""), ("plain  text\n here", "plain text here"), ("<article><p>hi", "hi"), ("</div></p>x<", "x<"), ("<script>a", ""), ("<!-- c", ""), ("&eacute; <b>b</b>c", "é bc")],
)
def test_broken_pages(page, text):
    assert html_text.main_text(page) == text


def test_pages_table(spark):
    rows = [(1, None, PAGE), (2, "u", None), (2, "u", "<p>" * 3000 + "deep")]
    found = html_text.extracted(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert [(r["page_id"], r["url"], r["n_chars"]) for r in found] == [(1, None, 119), (2, "u", 0), (2, "u", 4)]


def test_shards_move_only_to_the_new_one(spark, docs, empty):
    ids = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    rows = shards.sharded(ids, 24).collect()
    moved = [r for r in rows if r["shard"] != r["grown_shard"]]
    assert {r["grown_shard"] for r in moved} == {24} and 100 < len(moved) < 230
    for shard in range(24):
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))
    assert shards.sharded(ids, 1).agg(F.max("shard")).first()[0] == 0
    found = shards.sharded(docs).collect()
    assert sorted(r["size"] for r in found)[:2] == [8, 8] and len(found) == 10
    assert all(r["text_crc32"] == 0 for r in found if r["doc_id"] in (3, 4)) and shards.sharded(empty).count() == 0


def test_code_lengths_are_best_and_limited():
    counts = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 55])
    free = token_files.code_lengths(counts)
    assert sorted(free.tolist()) == [1, 2, 3, 4, 5, 6, 7, 8, 9, 9]
    tight = token_files.code_lengths(counts, 4)
    assert tight.max() == 4 and sum(2.0 ** -tight.astype(float)) <= 1
    assert token_files.code_lengths(np.array([7])).tolist() == [1]


def test_blocks_round_trip():
    rng = np.random.default_rng(1)
    ids = np.arange(3000)
    code = token_files.Code(ids, token_files.code_lengths((1e9 / (ids + 1) ** 2).astype(np.int64) + 1))
    rows = [rng.integers(0, 3000, n).astype(np.uint32) for n in (1, 2, 1023, 1024, 1025, 7000)]
    blocks = [code.encode(r) for r in rows]
    back = code.decode([b[0] for b in blocks], [b[1] for b in blocks], [len(r) for r in rows])
    assert np.array_equal(back, np.concatenate(rows))


def test_pieces_encode_as_the_whole_text():
    encoder, known = token_files.Encoder(public_tokenizers.path(token_files.VOCABULARY)), library(token_files.VOCABULARY)
    texts = odd_texts(600)
    for text, ids in zip(texts, encoder.encode([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == known.encode(text, add_special_tokens=False).ids


def test_units_are_learned_once_whatever_stands_beside_them(monkeypatch):
    """The library gets each word once, not again for every mark, line or doubled blank beside it."""
    encoder, known = token_files.Encoder(public_tokenizers.path(token_files.VOCABULARY)), library(token_files.VOCABULARY)
    words, marks = [f"w{chr(97 + k % 26)}rd{chr(97 + k // 26)}n" for k in range(200)], [".", ",", "!?", "\n", ".\n", "  ", " \n", " - "]
    texts = [" " + mark.join(words) + mark for mark in [" ", *marks]] + [f" {w}{m} {w}" for w in words for m in marks]
    asked, alone = [], encoder.alone
    monkeypatch.setattr(encoder, "alone", lambda text: asked.append(len(text)) or alone(text))
    for again in (texts, texts[::-1]):
        for text, ids in zip(again, encoder.encode([t.encode() for t in again]), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == known.encode(text, add_special_tokens=False).ids, text
    assert sum(asked) < 2.5 * sum(len(f" {w}") for w in words)


def test_units_of_mixed_texts_encode_as_the_whole_text(monkeypatch):
    """White space, apostrophes, other scripts and texts that begin or end anywhere; a table that is full again and again."""
    monkeypatch.setattr(token_files, "REMEMBERED", 50)
    encoder, known = token_files.Encoder(public_tokenizers.path(token_files.VOCABULARY)), library(token_files.VOCABULARY)
    rng = random.Random(6)
    letters = list(" \n\t'sSretvlldma09é×ñª.,!— \u00a0\u3000\u2009\u180e\u200b\x85\x1c\x00漢字я\u0301😀 \n' a")
    for _ in range(5):
        texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(500)]
        for text, ids in zip(texts, encoder.encode([t.encode() for t in texts]), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == known.encode(text, add_special_tokens=False).ids, text


def test_rows_of_blocks_are_those_of_one_row_each():
    ids = np.arange(300)
    code = token_files.Code(ids, token_files.code_lengths((1e9 / (ids + 1) ** 3).astype(np.int64) + 1))
    rng = np.random.default_rng(3)
    rows = [rng.integers(0, 300, n).astype(np.uint32) for n in (1, 5, 3000, 2, 1024, 1, 64)]
    blocks = code.encode_rows(rows)
    assert [b[0] for b in blocks] == [code.encode(r)[0] for r in rows]
    assert np.array_equal(code.decode([b[0] for b in blocks], [b[1] for b in blocks], [len(r) for r in rows]), np.concatenate(rows))


def test_token_files(spark, docs, empty):
    path, known = new_path(spark, "test-ids"), library(token_files.VOCABULARY)
    token_files.write_ids(docs, path)
    expected = {(r["doc_id"], tuple([*known.encode(r["text"] or "", add_special_tokens=False).ids, 0])) for r in docs.collect()}
    assert {(r["doc_id"], tuple(r["ids"])) for r in token_files.read_ids(spark, path).collect()} == expected
    found = sorted(token_files.read_digests(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in found] == [None, 1, 2, 3, 4, 6, 6, 7, 8, 9]
    ends = [r["start"] + r["n_tokens"] for r in found]
    assert [r["start"] for r in found] == [0, *ends[:-1]]
    assert found[3]["ids_crc32"] == zlib.crc32(np.array([0], "<u4").tobytes())
    other = new_path(spark, "test-ids")
    token_files.write_ids(empty, other)
    assert token_files.read_digests(spark, other).count() == 0


def test_code_lengths_of_the_language_model():
    """Every gram has the length that the escapes spell out."""
    text = b"abracadabra abracadabra"
    gram, _ = language_id.grams(*language_id.folded([text]))
    values, counts = np.unique(gram, return_counts=True)
    model = language_id.freeze(["x"], np.zeros(len(values), np.int64), values, counts)

    def bits(context, byte):
        if context is None:
            return 8.0
        seen = [int(g) & 255 for g in gram if int(g) >> 8 & (256 ** len(context) - 1) == int.from_bytes(context)]
        below = bits(context[1:] if context else None, byte)
        if not seen:
            return below
        total, kinds = len(seen), len(set(seen))
        return -np.log2(seen.count(byte) / (total + kinds)) if byte in seen else -np.log2(kinds / (total + kinds)) + below

    for probe in (b"abra", b"zbra", b"abrz", b"zzzz", b"  ab"):
        found = model.lengths(np.array([int.from_bytes(probe)], np.uint32))[0, 0]
        assert found == pytest.approx(bits(probe[:3], probe[3]), abs=1e-4)


def test_languages(docs, empty):
    model = language_id.train(docs)
    found = {r["doc_id"]: r for r in language_id.identify(docs, model, [F.col("doc_id")]).collect()}
    assert (found[None]["lang_pred"], found[9]["lang_pred"], found[1]["lang_pred"]) == ("fr", "de", "en")
    assert all(found[k]["lang_pred"] == "und" and found[k]["score"] == 0 for k in (3, 4, 7))
    kept = language_id.accepted(docs, model)
    assert kept.columns == docs.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 6, 6, 8, 9]
    nothing = language_id.train(empty)
    assert {r["lang_pred"] for r in language_id.identify(docs, nothing, []).collect()} == {"und"}
    assert language_id.identify(empty, model, []).count() == 0


def test_fingerprints(docs, empty):
    rows = fingerprints.fingerprinted(docs).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    order = [9, 8, 7, 6, 4, 3, 2, 1, None]
    after = dict(zip(order, [*order[1:], 9], strict=True))
    assert len(rows) == 10
    for r in rows:
        text, more = texts[r["doc_id"]], texts[after[r["doc_id"]]]
        edited = text[: len(text) - len(text) // 3] + more[: len(text) // 3]
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and r["n_chars"] == len(text)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["fingerprint"] == by_id[2]["fingerprint"] and by_id[2]["near_next"] == 1
    assert by_id[3]["fingerprint"] == "" and by_id[9]["near_edited"] > 0.3 > by_id[9]["near_next"]
    assert fingerprints.fingerprinted(empty).count() == 0


def test_anchors_are_closed_syncmers(spark):
    """A run is an anchor wherever it stands: those of a text are among those of any text around it."""
    inner = " ".join(f"w{k * k % 89}" for k in range(80))
    rows = spark.createDataFrame([(inner,), (f"one two three {inner} four five",)], "text string")
    small, large = (r[0] for r in rows.select(fingerprints.anchors(F.col("text"))).collect())
    assert small and set(small) <= set(large)


def test_fingerprints_are_comparable_at_every_length(spark):
    """Long texts without blanks, and pairs on both sides of 256 code points."""
    rng = random.Random(4)
    han = lambda n: "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(n))
    word = lambda n: " ".join(f"w{rng.randrange(10**4)}" for _ in range(n))[:n]
    base, line = han(900), word(260)
    texts = [word(40), word(300), base, base[:400] + "x" + base[400:], line, line[:250], han(7), han(3), han(2000).lower() + " a"]
    rows = fingerprints.fingerprinted(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()
    found = {r["doc_id"]: r for r in rows}
    assert all(found[k]["near_edited"] > 0.3 for k in (1, 2, 3, 4, 5))
    assert found[3]["near_next"] > 0.9 and found[5]["near_next"] > 0.9 and found[4]["near_next"] < 0.1
    edited = [(k, t[: len(t) - len(t) // 3] + texts[k - 1][: len(t) // 3]) for k, t in enumerate(texts)]
    frame = spark.createDataFrame(edited, "doc_id int, text string")
    for r in frame.select("doc_id", fingerprints.printed(fingerprints.anchors(F.col("text")))).collect():
        assert found[r[0]]["edited_fingerprint"] == r[1]


def test_anchors_of_a_text_are_worked_out_once(docs):
    """Texts are split into units in two places of the plan: whole texts, and the seams of edited ones."""
    plan = fingerprints.fingerprinted(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == 2


@pytest.mark.parametrize("n", [1, 2, 4, 5, 33])
def test_fingerprints_of_stretches_are_those_of_plain_rows(spark, monkeypatch, n):
    """Every document meets its next one, also across stretches and around the end; repeated rows each get their row."""
    monkeypatch.setattr(fingerprints, "TOGETHER", 4)
    rng = random.Random(n)
    words = lambda k: " ".join(f"w{rng.randrange(40)}" for _ in range(k))
    rows = [(3 * k, rng.choice([words(rng.randrange(30)), words(2)[:7], "", None])) for k in range(n)]
    rows += [(None, "null id")] * 2 + rows[:1] * 2 if n > 4 else []
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    texts = {d: t or "" for d, t in rows}
    order = sorted(texts, key=lambda d: -1 if d is None else d, reverse=True)
    after = dict(zip(order, [*order[1:], order[0]], strict=True))
    edited = {d: t[: len(t) - len(t) // 3] + texts[after[d]][: len(t) // 3] for d, t in texts.items()}
    plain = spark.createDataFrame([(t,) for t in {*texts.values(), *edited.values()}], "text string")
    anchors = {r["text"]: r["a"] for r in plain.select("text", fingerprints.anchors(F.col("text")).alias("a")).collect()}
    shown = lambda t: "".join(f"{a & 0xFFFFFFFF:08X}" for a in anchors[t])
    alike = lambda a, b: len({*anchors[a]} & {*anchors[b]}) / (len({*anchors[a]} | {*anchors[b]}) or 1) if anchors[a] or anchors[b] else 1
    found = fingerprints.fingerprinted(frame).collect()
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(d) for d, _ in rows)
    for r in found:
        d, text = r["doc_id"], texts[r["doc_id"]]
        assert r["next_doc_id"] == after[d] and r["n_chars"] == len(text)
        assert (r["fingerprint"], r["edited_fingerprint"]) == (shown(text), shown(edited[d]))
        assert r["edited_sha256"] == hashlib.sha256(edited[d].encode()).hexdigest()
        assert (r["near_edited"], r["near_next"]) == (alike(text, edited[d]), alike(text, texts[after[d]]))


def test_languages_without_any_text_to_learn_from(spark, docs):
    """Labelled texts that are all empty teach nothing."""
    empty = spark.createDataFrame([("", "en"), ("", "fr")], "text string, lang string")
    model = language_id.train(empty)
    assert {r["lang_pred"] for r in language_id.identify(docs, model, []).collect()} == {"und"}


def test_copies_teach_once(spark):
    rows = [("the cat and the dog", "en")] * 50 + [("le chat et le chien", "fr")]
    model = language_id.train(spark.createDataFrame(rows, "text string, lang string"))
    once = language_id.train(spark.createDataFrame(rows[49:], "text string, lang string"))
    assert all(np.array_equal(a, b) for a, b in zip(model.bits, once.bits, strict=True))


def test_stages_take_tables_with_their_own_names(spark, docs):
    """Columns named as what a stage adds or works with: replaced or kept as the docstrings say."""
    from tideline.llm import decontaminate

    clash = docs.selectExpr("*", "'i' AS ids", "'d' AS decoded", "'l' AS __live", "'s' AS __spans", "'n' AS __id", "'h' AS __hash")
    first = lexicon_bpe.encoded(clash.where("doc_id = 1"))
    back = lexicon_bpe.decoded(first).first()
    assert first.columns == [*[c for c in clash.columns if c != "ids"], "ids"] and "quick</w> brown</w>" in back["decoded"]
    kept = secret_scan.without_secrets(clash)
    assert kept.columns == clash.columns and {(r["__live"], r["__spans"], r["__id"]) for r in kept.collect()} == {("l", "s", "n")}
    named = docs.withColumnRenamed("text", "body").withColumn("text", F.lit("x"))
    items = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog near the river bank today.")], "item_id long, text string")
    found = decontaminate.clean(named, items, text="body")
    assert found.columns == named.columns and {r["text"] for r in found.collect()} == {"x"}
    assert not {1, 2} & {r["doc_id"] for r in found.collect()}


def plain_spans(text):
    """Base and candidate spans by the patterns, one after the other."""
    base = []
    for kind, pattern, least in (("assign", secret_scan.ASSIGN, secret_scan.VALUE), ("access", secret_scan.ACCESS, 0), ("hex", secret_scan.HEX, 0)):
        for m in re.finditer(pattern, text):
            if len(m.group(m.lastindex or 0)) >= least:
                base.append((m.start(), secret_scan.KINDS.index(kind), m.end()))
    more = []
    for m in re.finditer(rf"[A-Za-z0-9_-]{{{secret_scan.RUN},}}", text):
        mixed = re.search("[0-9]", m.group()) and re.search("[A-Za-z]", m.group())
        if mixed and not any(b[0] < m.end() and m.start() < b[2] for b in base):
            more.append((m.start(), secret_scan.KINDS.index("owned"), m.end()))
    return sorted(base), more


def plain_mask(text, spans):
    out, at = [], 0
    for begin, _, end in sorted(spans):
        if begin >= at:
            out += [text[at:begin], secret_scan.MASK]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_spans_that_meet_each_other(spark):
    rng = random.Random(4)
    parts = ["password=", 'Token: "', "api_key", "=", " ", '"', "AKIA" + "AB12" * 5, "0123456789abcdef" * 2, "x-y_z", "é", "😀", "a1b2c3d4e5" * 2, "Q7", "\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(400)]
    texts += ["", "😀" * 3000 + " password=abcdefgh " + "é" * 2500 + "0123456789abcdef" * 2]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    text = F.col("text")
    found = rows.select("text", secret_scan.base_spans(text).alias("base"))
    found = found.withColumn("more", secret_scan.candidate_spans(text, F.col("base")))
    found = found.withColumn("masked", secret_scan.masked(text, F.concat("base", "more")))
    for r in found.collect():
        base, more = plain_spans(r["text"])
        assert [(s["start"], s["kind"], s["end"]) for s in r["base"]] == base
        assert [(s["start"], s["kind"], s["end"]) for s in r["more"]] == more
        assert r["masked"] == plain_mask(r["text"], base + more)


def test_a_text_of_very_many_spans(spark):
    rng = random.Random(6)
    many = " ".join(f"{rng.getrandbits(128):032x}" for _ in range(40_000))
    long_run = "-" * 2_000_000
    rows = spark.createDataFrame([(1, many), (2, long_run)], "doc_id long, text string")
    text = F.col("text")
    found = rows.select("doc_id", secret_scan.base_spans(text).alias("base"), "text")
    found = found.withColumn("more", secret_scan.candidate_spans(text, F.col("base")))
    found = found.select("doc_id", F.size("base").alias("n"), F.size("more").alias("m"), secret_scan.masked(text, F.concat("base", "more")).alias("masked"))
    first, second = found.orderBy("doc_id").collect()
    assert (first["n"], first["m"], first["masked"]) == (40_000, 0, " ".join([secret_scan.MASK] * 40_000))
    assert (second["n"], second["m"], second["masked"]) == (0, 0, long_run)


ARTICLE = "<p>Paragraph one, with commas, and so many words that it counts.</p>" * 3
WORDS = " ".join(["Paragraph one, with commas, and so many words that it counts."] * 3)


@pytest.mark.parametrize(
    "page, text",
    [
        ("<head><title>T</title><body><article>" + ARTICLE, WORDS),
        ("<head><title>T</title><p>Start, " + ARTICLE, "Start, " + WORDS),
        ("<head>Text, with a comma, at once, and long enough to be a paragraph of its own.", "Text, with a comma, at once, and long enough to be a paragraph of its own."),
        ("<article><svg class=i/>" + ARTICLE + "</article>", WORDS),
        ('<article><svg class="i"><path d="M0"/><text>no</text></svg>' + ARTICLE, WORDS),
        ("<article><svg><circle>" + ARTICLE, WORDS),
        ("<article><math/>" + ARTICLE, WORDS),
        ("<article><p>Area is <math><mi>x</mi><mo>+</mo><mn>2</mn><annotation>x+2</annotation></math>, as said.</p>", "Area is x+2, as said."),
        ("<article><p data-x=it's>One two three.</p><p>Two more's here.</p></article>", "One two three. Two more's here."),
        ('<article><p class="a"">Text of the paragraph.</p></article>', "Text of the paragraph."),
        ("<article><a title='a > b' href=x>Go</a> on</article>", "Go on"),
        ("<article><!-->" + ARTICLE + "<!-- x --><!--->!</article>", WORDS + " !"),
        ("<article><label>Name</label> <p>Text</p></article>", "Name Text"),
        ("<article><p>A<script>'</scripty>'</script >b</p></article>", "Ab"),
    ],
)
def test_pages_that_browsers_read_whole(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("name", ["class=related-work", "id=legal", "class='social-issues of today'", "class=tags"])
def test_topics_are_no_furniture(name):
    part = f"<section {name}>{ARTICLE}</section>"
    assert html_text.main_text(f"<article>{ARTICLE}{part}</article>") == f"{WORDS} {WORDS}"
    links = f"<div {name}>" + "<a href=x>Another page of this site, with a long title</a>" * 9 + "</div>"
    assert html_text.main_text(f"<article>{ARTICLE}{links}<div {name}>Share</div></article>") == WORDS


@pytest.mark.parametrize("name", ["topnav", "commentlist", "comments-area", "main-navigation", "cookie-bar", "ad", "leftsidebar"])
def test_furniture_by_name_goes_whatever_its_length(name):
    for page in ("<article>{0}<div class={1}>{0}</div></article>", "<div class=story>{0}</div><ol id={1}><li>{0}</ol>"):
        assert html_text.main_text(page.format(ARTICLE, name)) == WORDS


@pytest.mark.parametrize("page", ["<p>x" + "<b>" * 30_000, "<i><div>" + "<b>" * 15_000 + "</i>" * 15_000, "<b>" * 15_000 + "<div></div>" * 15_000, "<" * 60_000, "<p " + 'a"' * 30_000])
def test_deep_and_odd_pages_take_time_in_proportion(page):
    began = time.perf_counter()
    html_text.main_text(page)
    assert time.perf_counter() - began < 20


def test_anchors_are_those_of_a_plain_loop(spark):
    """Closed syncmers by the definition: the least inner hash of a run is its first or its last."""
    rng = random.Random(8)
    rows = ["".join(rng.choice("ab cé漢😀") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    frame = spark.createDataFrame(list(enumerate(rows)), "k int, text string")
    found = {r["k"]: [x["at"] for x in r["runs"]] for r in frame.select("k", fingerprints._runs(F.col("text")).alias("runs")).collect()}
    k, s = fingerprints.K, fingerprints.S
    for at, text in enumerate(rows):
        inner = []
        for i in range(len(text) - s + 1):
            hashed = 42
            for c in text[i : i + s]:
                hashed = xxhash.xxh64_intdigest(c.encode(), seed=hashed)
            inner.append(hashed - (1 << 64) if hashed >> 63 else hashed)
        runs = [inner[i : i + k - s + 1] for i in range(len(text) - k + 1)]
        assert found[at] == [i for i, run in enumerate(runs) if min(run) in (run[0], run[-1])]
