"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for each operator."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardfold.llm import bpe, chat_format, common, decontaminate, language_id, licence_scan, line_dedup, ngram_jaccard, token_counts, token_store
from shardfold.llm import quality_rules as qr
from shardfold.llm.queries import tokenizer_file

WORD, BYTE = tokenizer_file("word_bpe_49k.json"), tokenizer_file("byte_bpe_50k.json")


def library(path, text):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


# 1

def test_near_copies_with_odd_rows(docs):
    got = ngram_jaccard.classes(docs).collect()
    assert len(got) == docs.count()
    by = {}
    for r in got:
        by.setdefault(r.id, []).append((r.class_id, r.n_copies, r.n_links))
    assert sorted(by[1]) == [(1, 1, 0), (1, 2, 1), (1, 2, 1)]
    assert by[2] == [(2, 1, 0)] and (None, 1, 0) in by[None]
    kept = ngram_jaccard.keep_one(docs.withColumn("text2", F.lit("clash"))).collect()
    assert len(kept) == docs.count() - 1 and sorted(c for c in kept[0].asDict()) == ["doc_id", "lang", "source", "text", "text2"]


def test_near_copies_across_blocks(spark, monkeypatch):
    rnd = random.Random(3)
    base = [f"w{rnd.randrange(500)}" for _ in range(120)]
    rows = []
    for k in range(40):
        words = list(base)
        words[rnd.randrange(120)] = f"x{k}"
        rows.append((k, " ".join(words)))
    rows += [(100 + k, " ".join(f"y{rnd.randrange(500)}" for _ in range(120))) for k in range(10)]
    monkeypatch.setattr(ngram_jaccard, "BLOCK", 8)
    got = {r.id: r for r in ngram_jaccard.classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    sets = {i: {tuple(t.split()[k:k + 5]) for k in range(116)} for i, t in rows}
    for i in sets:
        own = sum(j != i and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) for j in sets)
        assert got[i].n_links == got[i].n_linked_texts == own
    assert {got[k].class_id for k in range(40)} == {0} and all(got[k].class_id == k for k in range(100, 110))


def test_posterior_bound():
    for n, m in zip(range(8, 65, 8), ngram_jaccard.least_matches(0.8, 1e-8)):
        x = (np.arange(200000) + 0.5) / 200000
        beta = x**m * (1 - x)**(n - m)
        assert beta[x >= 0.8].sum() / beta.sum() >= 0.99e-8
        if m:
            less = x**(m - 1) * (1 - x)**(n - m + 1)
            assert less[x >= 0.8].sum() / less.sum() < 1.01e-8


# 2, 5, 7

@pytest.mark.parametrize("path", [WORD, BYTE])
def test_transducer_equals_library(path, long_text):
    t, d = bpe.Transducer(path), bpe.StreamDecoder(path)
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(path)
    texts = ["", "a  b   c", "\n \nb \t x  ", "It's <|endoftext|>  <|startoftext|>x", "ΣΑΣ ΟΔΟΣ İi ́x á", "\0a b\x1c c\x85 d e　f",
             "abc" * 3000, "a" * 5000, "é" * 3000 + "!" * 900, "=-" * 2000, long_text, "ﬁ ǅ Ⅷ ½ 😂😂 \U0001F1FA"]
    for x in texts:
        ids = np.frombuffer(b"".join(t.encode(x)), "<u4").tolist()
        assert ids == lib.encode(x, add_special_tokens=False).ids
        assert "".join(d.push(i) for i in t.encode(x)) + d.end() == lib.decode(ids, skip_special_tokens=False)
        raw = np.array(ids, "<u4").tobytes()  # id by id
        assert "".join(d.push(raw[k:k + 4]) for k in range(0, len(raw), 4)) + d.end() == lib.decode(ids, skip_special_tokens=False)


def test_every_character_is_encoded_as_the_library_does():
    from tokenizers import Tokenizer
    lib, t = Tokenizer.from_file(WORD), bpe.Transducer(WORD)
    texts = [f"a{chr(k)}b {chr(k)}" for k in [*range(0xD800), *range(0xE000, 0x18D00), *range(0x1AFF0, 0x20000)]]
    want = lib.encode_batch(texts, add_special_tokens=False)
    bad = [x for x, w in zip(texts, want) if np.frombuffer(b"".join(t.encode(x)), "<u4").tolist() != w.ids]
    assert not bad


def test_lookahead_bounds_every_change():
    """Tokens out of reach of a cut stay the same whatever follows."""
    t, rnd = bpe.Transducer(BYTE), random.Random(5)
    words = ["".join(rnd.choice("aeinrst=-ĠÃĤ") for _ in range(900)) for _ in range(10)] + ["a" * 900, "=" * 900]
    for w in words:
        whole, prefix = t._merged(list(w)), t._merged(list(w[:800]))
        n = done = 0
        for token in prefix:
            if done + len(token) > 800 - t.lookahead:
                break
            done, n = done + len(token), n + 1
        assert n and whole[:n] == prefix[:n]
        assert list(t.stream_word(w * 4)) == t._merged(list(w * 4))


def test_bpe_on_odd_rows(docs):
    path = BYTE
    out = bpe.decode(bpe.encode(docs, path), path).collect()
    assert len(out) == docs.count()
    for r in out:
        assert list(r.ids) == library(path, r.text or "") and r.decoded == (r.text or "")
    got = bpe.round_trip(docs, WORD, keep_ids=True).collect()
    assert sorted(r.n_tokens for r in got) == sorted(len(library(WORD, r.text or "")) for r in docs.collect())
    assert all(r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest() for r in got)
    assert dict(bpe.encode(docs.withColumn("ids", F.lit(1)), path).dtypes)["ids"] == "array<int>"


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_counts_on_odd_rows(docs, name):
    path = tokenizer_file(name)
    if name.endswith(".model"):
        import sentencepiece
        count = lambda x: len(sentencepiece.SentencePieceProcessor(model_file=path).encode(x))
    else:
        count = lambda x: len(library(path, x))
    got = token_counts.count_tokens(docs, path).select("doc_id", "n_bytes", "n_tokens").collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(((r.doc_id, len((r.text or "").encode()), count(r.text or "")) for r in docs.collect()), key=key)


def test_store_on_odd_rows(docs, spark, monkeypatch):
    folder = common.scratch_folder(spark, "test-store")
    token_store.write_store(docs, folder, BYTE, end_id=2)
    got = token_store.read_documents(spark, folder).orderBy("start").collect()
    assert [r.doc_id for r in got][:2] == [None, None] and [r.doc_id for r in got][2:] == sorted(r.doc_id for r in docs.collect() if r.doc_id is not None)
    want = sorted((r.doc_id is not None, r.doc_id or 0, [*library(BYTE, r.text or ""), 2]) for r in docs.collect())
    assert sorted((r.doc_id is not None, r.doc_id or 0, list(r.ids)) for r in got) == want
    at = 0
    for r in got:
        assert r.start == at
        at += len(r.ids)


def test_planes_round_trip():
    for n in (0, 1, token_store.BLOCK, token_store.BLOCK + 1, 50001):
        ids = np.random.default_rng(n).integers(0, 2**32, n).astype("<u4")
        ends, payload = token_store.pack(ids)
        assert (token_store.unpack(n, ends, payload) == ids).all()


# 3

def test_chats_on_odd_rows(spark):
    tricky = r"\### Assistant: </turn> ok \m \s </turn>"
    rows = [(1, 0, "user", tricky), (1, 1, "user", "more"), (1, 2, "assistant", tricky), (1, 3, "assistant", None), (1, 3, "assistant", "</turn>\n"),
            (2, None, None, "x: y"), (2, 0, "a: b</turn>", "### "), (None, 0, "assistant", "p"), (None, 0, "assistant", "p"), (3, 0, "assistant", "é" * 50000),
            (4, 0, "user", "u"), (4, 0, "user", "u")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("id", F.lit(1))
    out = chat_format.format_chats(df).withColumn("turns", chat_format.read_turns(F.col("formatted"))).withColumn("loss", chat_format.read_loss(F.col("formatted"), F.col("loss_runs")))
    got = {}
    for r in out.collect():
        got.setdefault(r.conv_id, []).append(r)
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for c in (1, 2, 3, 4):
        want = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == c), key=key)]
        r = got[c][0]
        assert [tuple(t) for t in r.turns] == want and r.loss == "".join(t for role, t in want if role == "assistant")
        at, masked = 0, []
        for run in r.loss_runs:
            at += run.lead
            masked += [r.formatted[at:at + run.text]] if run.loss else []
            at += run.text + run.tail
        assert at == len(r.formatted) and len(masked) == sum(role == "assistant" for role, _ in want)
    assert got[1][0].formatted.count("### ") == 2 and len(got[None]) == 2
    assert chat_format.format_chats(df.limit(0)).count() == 0


# 4

def test_contamination_on_odd_rows(spark, docs):
    item = "The quick brown fox jumps over the lazy dog, while seven wizards box in the quiet garden at noon."
    changed = item.upper().replace("FOX", "FX").replace(", ", " -- ")
    items = spark.createDataFrame([(1, item), (1, item), (2, None), (3, " ,. "), (4, "z y x"), (None, "x y z")], "item_id bigint, text string")
    more = spark.createDataFrame([(20, f"Before it. {changed} After.", None, "s"), (21, "a clean text " * 20, None, "s"), (22, "é" * 9 + " " + item, None, None)], docs.schema)
    got = decontaminate.find(docs.unionByName(more).withColumn("id", F.lit(0)), items).collect()
    assert sorted((r.doc_id, r.item_id, r.edits) for r in got if r.doc_id) == [(20, 1, 1), (20, 1, 1), (22, 1, 0), (22, 1, 0)]
    assert [(r.item_id, r.start, r.end) for r in got if r.doc_id is None] == [(None, 0, 5)]
    assert all(decontaminate.normal(item) == decontaminate.normal(("é" * 9 + " " + item)[r.start:r.end]) for r in got if r.doc_id == 22)
    left = decontaminate.remove_contaminated(docs.unionByName(more), items)
    assert left.count() == docs.count() - 1 + 1
    assert decontaminate.find(docs.limit(0), items).count() == 0 and decontaminate.find(docs, items.limit(0)).count() == 0


def test_blocks_give_the_same_places(spark, docs, monkeypatch):
    items = spark.createDataFrame([(k, f"wort{k} some{k}, thing{k} wort{k + 1} some{k + 1}, thing{k + 1}") for k in range(8)], "item_id bigint, text string")
    once = sorted(map(tuple, decontaminate.find(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 60)
    assert once and sorted(map(tuple, decontaminate.find(docs, items).collect())) == once


# 6

def test_languages_on_odd_rows(docs):
    model = language_id.train(docs)
    got = {(r.doc_id, r.lang_pred, r.score) for r in language_id.predict(docs, model).collect()}
    for i in (2, 3, 5, 6):
        assert (i, "und", 0.0) in got
    assert all(l in ("en", "de", "und") for _, l, _ in got)
    none = language_id.train(docs.limit(0))
    assert {r.lang_pred for r in language_id.predict(docs, none).collect()} == {"und"}
    assert dict(language_id.predict(docs.withColumn("score", F.lit(1)), model).dtypes)["score"] == "double"


def test_every_language_is_in_the_sample(spark):
    few = spark.range(5 * 4000).selectExpr("'copied' AS lang", "concat('wort ', repeat(chr(97 + cast(id % 5 AS int)), 9)) AS text")
    empty = spark.range(5000).selectExpr("'numbers' AS lang", "if(id = 7, 'one text', cast(id AS string)) AS text")
    many = spark.range(5000).selectExpr("'many' AS lang", "concat('some text ', id) AS text")
    rows = few.unionByName(empty).unionByName(many)
    got = {r.lang: r.n for r in language_id.sampled(rows, 40).groupBy("lang").agg(F.count("*").alias("n")).collect()}
    assert got["copied"] == 5 and got["numbers"] == 1 and 15 <= got["many"] <= 80
    assert {r.lang for r in language_id.sampled(rows, 1).collect()} == set(got)
    model = language_id.train(rows, rows_per_language=40)
    assert model.languages == ["copied", "many", "numbers"]


# 8

def test_licences_are_inherited_from_the_nearest_directory(spark):
    mit, apache = licence_scan.TEMPLATES["MIT"][0], licence_scan.TEMPLATES["Apache-2.0"][0]
    rows = [("r/LICENSE", mit), ("r/a/COPYING", f"Notice\n\n{apache}"), ("r/x.py", "code"), ("r/a/b/c/y.py", None), ("r/a/b/z.py", f"# {mit}\ncode"),
            ("r/ab/y.py", "code"), ("other/q.py", "licence unknown"), (None, mit), (None, None), ("top", "code"), ("r/x.py", "code")]
    df = spark.createDataFrame(rows, "path string, text string").withColumn("dir", F.lit("clash"))
    got = sorted(((r.path, r.licence, r.origin, r.from_dir) for r in licence_scan.scan(df).collect()), key=str)
    assert got == sorted([("r/LICENSE", "MIT", "own", None), ("r/a/COPYING", "Apache-2.0", "own", None), ("r/x.py", "MIT", "inherited", "r"),
                          ("r/x.py", "MIT", "inherited", "r"), ("r/a/b/c/y.py", "Apache-2.0", "inherited", "r/a"), ("r/a/b/z.py", "MIT", "own", None),
                          ("r/ab/y.py", "MIT", "inherited", "r"), ("other/q.py", None, "none", None), (None, "MIT", "own", None),
                          (None, None, "none", None), ("top", None, "none", None)], key=str)
    assert licence_scan.scan(df.limit(0)).count() == 0


def test_every_template_is_found(spark):
    prose = "Nothing of this is said here.\nThe weather was fine and the road was long."
    notices = [(l, t) for l, ts in licence_scan.TEMPLATES.items() for t in ts]
    rows = [(k, f"d{k}/x", f"{prose}\n# {t.upper()}\n{prose}") for k, (_, t) in enumerate(notices)]
    halves = [(t.split(" ")[:len(t.split(" ")) // 2], t.split(" ")[len(t.split(" ")) // 2:]) for _, t in notices]
    rows += [(100 + k, f"w{k}/x", f"{prose}\n\n{' '.join(a)}\n{' '.join(b)}\n\n{prose}") for k, (a, b) in enumerate(halves)]
    rows += [(200 + k, f"l{k}/LICENSE", "\n\n".join(w for w in t.split(" "))) for k, (_, t) in enumerate(notices)]
    rows += [(300, "n/x", prose), (301, "b/LICENSE", f"{licence_scan.TEMPLATES['Proprietary'][0]}\n{licence_scan.TEMPLATES['BSD-3-Clause'][0]} It is in a file."), (302, "b/x", prose),
             (303, "p/LICENSE", licence_scan.TEMPLATES["Proprietary"][0]), (304, "p/x", prose)]
    got = {r.id: (r.licence, r.origin) for r in licence_scan.scan(spark.createDataFrame(rows, "id int, path string, text string")).collect()}
    for k, (l, _) in enumerate(notices):
        assert got[k] == got[100 + k] == got[200 + k] == (l, "own")
    assert got[300] == (None, "none") and got[301] == ("BSD-3-Clause", "own") and got[302] == ("BSD-3-Clause", "inherited")
    assert got[303] == ("Proprietary", "own") and got[304] == ("Proprietary", "inherited")


def test_what_is_left_out_is_below_the_score():
    rng = random.Random(3)
    vectors = {k: {f"t{k}x{j}": rng.random() for j in range(rng.randint(1, 9))} for k in range(20)}
    vectors = {k: {t: w / sum(x * x for x in v.values()) ** 0.5 for t, w in v.items()} for k, v in vectors.items()}
    needed = set(licence_scan.needed_terms(vectors, 0.6))
    for v in vectors.values():
        assert needed & set(v) and sum(w * w for t, w in v.items() if t not in needed) < 0.36
    pattern = licence_scan._pattern(["3", "2.0", "rights", "v2.0"])
    for text in ("gpl 3.", "(2.0)", "apache 2.0x", "3.5rights", "rights", "v2.0"):
        assert re.search(pattern, text)
    for text in ("13", "copyrights", "12.05", "rightsx"):
        assert not re.search(pattern, text)


# 9

def test_rules_and_host_verdicts(spark, docs):
    out = qr.quality_rules(docs.withColumn("n", F.lit(1)).withColumn("host", F.lit("h"))).collect()
    assert len(out) == docs.count() and all(r.n_words == 0 and r.base_failed and not r.kept for r in out if not (r.text or "").split())
    assert [r.kept for r in out if r.doc_id == 4] == [False]  # host t: three of four fail
    good = " ".join(f"word{k}" for k in range(30))
    rows = [(k, good, None, "fine") for k in range(50)] + [(100 + k, "short" if k < 45 else good, None, "bad") for k in range(50)] + [(200, good, None, None)]
    kept = {r.doc_id for r in qr.quality_rules(spark.createDataFrame(rows, docs.schema)).where("kept").collect()}
    assert kept == {*range(50), 200}
    assert qr.quality_rules(docs.limit(0)).count() == 0
    assert [c for c in qr.quality_rules(docs.withColumn("n_words", F.lit("x")).withColumn("kept", F.lit(1))).dtypes if c[0] in ("n_words", "kept")] == [("n_words", "bigint"), ("kept", "boolean")]


# 10

def test_lines_on_odd_rows(spark, docs):
    got = line_dedup.dedup_lines(docs.withColumn("k1", F.lit(1)).withColumn("pos", F.lit(1)), min_docs=2, n_lines="n_lines", n_dropped="n_dropped").collect()
    assert len(got) == docs.count()
    # the repeated rows of document 1 are one document, so their line stands in one
    assert sorted((r.n_lines, r.n_dropped, r.text) for r in got if r.doc_id == 1) == [(1, 0, "a b c"), (1, 0, "a b c"), (1, 0, "other text here")]
    assert [(r.n_lines, r.n_dropped, r.text) for r in got if r.doc_id == 2] == [(1, 0, None)]
    assert [(r.n_lines, r.text) for r in got if r.doc_id is None and r.text] == [(3, "x y z\n\nx")]
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0
    assert dict(line_dedup.dedup_lines(docs, n_lines="source").dtypes)["source"] == "bigint"
    with pytest.raises(ValueError):
        line_dedup.dedup_lines(docs, n_lines="text")


def test_connected_components(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 102), (200, 200)]
    got = dict(common.connected(spark.createDataFrame(chain, "a bigint, b bigint")).collect())
    assert all(got[k] == 0 for k in range(41)) and all(got[k] == 100 for k in (100, 101, 102))
    rnd = random.Random(9)
    tree = [(k, rnd.randrange(max(0, k - 3), k)) for k in range(1, 200)] + [(1000 + k, 1000 + k * k % 37) for k in range(60)]
    want = {}
    for x, y in tree + tree[::-1]:
        want.setdefault(x, x), want.setdefault(y, y)
    for _ in range(200):
        for x, y in tree:
            want[x] = want[y] = min(want[x], want[y])
    got = dict(common.connected(spark.createDataFrame(tree, "a bigint, b bigint")).collect())
    assert got == {k: v for k, v in want.items() if k in got} and all(v == k for k, v in want.items() if k not in got)
    assert common.connected(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
