"""Queries with SQL equal DuckDB's result; the others equal a brute-force version on the smallest tables."""

import hashlib
import os
import re
import sys
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

import __spark_entry__ as E  # noqa: E402
import corpus_pipeline  # noqa: E402
from oracle_check import TABLES, norm  # noqa: E402
from shardfold.llm import decontaminate, licence_scan, queries  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def texts(con):
    return {i: t or "" for i, t in con.execute("SELECT doc_id, text FROM documents").fetchall()}


def rows(spark, name):
    return E.queries()[name](spark, SF).collect()


def test_all_operators_are_registered():
    names = set(E.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, con, name):
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert Counter(tuple(norm(r[c]) for c in cols) for r in df.collect()) == Counter(tuple(map(norm, r)) for r in res.fetchall())


def brute_classes(texts):
    """Per document: class id, copies, linked texts, links."""
    by = defaultdict(list)
    for i, t in texts.items():
        by[" ".join(re.findall(r"[^\x20\x09-\x0d]+", t.lower()))].append(i)
    words = [w.split(" ") for w in by if w]
    sets = [frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) for w in words]
    groups = [by[w] for w in by if w]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    label = list(range(len(sets)))
    for _ in label:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    out = {i: (i, 1, 0, 0) for i in by.get("", [])}
    for k, g in enumerate(groups):
        own = [b if a == k else a for a, b in links if k in (a, b)]
        first = min(min(groups[x]) for x in range(len(groups)) if label[x] == label[k])
        out |= {i: (first, len(g), len(own), len(g) - 1 + sum(len(groups[x]) for x in own)) for i in g}
    return out


def test_op1_equals_brute_force(spark, texts):
    got = {r.doc_id: (r.class_id, r.n_copies, r.n_linked_texts, r.n_links) for r in rows(spark, "op1_ngram_jaccard")}
    assert got == brute_classes(texts)


def test_op2_equals_library(spark, texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(queries.tokenizer_file("word_bpe_49k.json"))
    for r in rows(spark, "op2_bpe_round_trip"):
        ids = t.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_op4_equals_brute_force(spark, con, texts):
    items = {i: decontaminate.normal(t or "") for i, t in con.execute("SELECT item_id, text FROM benchmark").fetchall()}
    got = rows(spark, "op4_decontaminate")
    plain = {i: decontaminate.normal(t) for i, t in texts.items()}
    assert {(r.doc_id, r.item_id) for r in got} >= {(d, i) for d, t in plain.items() for i, x in items.items() if x in t}
    for r in got:
        place = decontaminate.normal(texts[r.doc_id][r.start:r.end])
        assert edits(place, items[r.item_id]) == r.edits <= decontaminate.RATE * len(items[r.item_id])


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_op5_equals_library(spark, texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(queries.tokenizer_file("word_bpe_49k.json"))
    for r in rows(spark, "op5_token_counts"):
        n = len(t.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 2048)


def test_op6_is_right_on_held_out_rows(spark, con):
    lang = dict(con.execute("SELECT doc_id, lang FROM documents").fetchall())
    got = rows(spark, "op6_language_id")
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and lang[r.doc_id]]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.9 * len(held)


def test_op7_equals_library(spark, texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(queries.tokenizer_file("byte_bpe_50k.json"))
    want, start = {}, 0
    for i in sorted(texts):
        ids = [*t.encode(texts[i], add_special_tokens=False).ids, 2]
        want[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows(spark, "op7_token_store")} == want


def test_op8_finds_the_declared_licences(spark, texts):
    declared = {t[0]: l for l, t in licence_scan.TEMPLATES.items()}
    for r in rows(spark, "op8_licence_scan"):
        own = {declared[x] for x in texts[r.doc_id].split("\n") if x in declared}
        assert (r.licence in own and r.score > 0.99 and r.origin == "own") if own else r.origin != "own"


def test_pipeline_equals_brute_force(spark, con, texts):
    kept = {r.doc_id for r in rows(spark, "op9_quality_rules") if r.kept}
    key = lambda line: line.strip(" \t\n\v\f\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    seen = Counter(k for i in kept for k in {key(x) for x in texts[i].split("\n")} if k)
    docs = {i: "\n".join(x for x in texts[i].split("\n") if seen[key(x)] < 10) for i in kept}
    classes = brute_classes(docs)
    docs = {i: t for i, t in docs.items() if classes[i][0] == i}
    items = [decontaminate.normal(t or "") for t, in con.execute("SELECT text FROM benchmark").fetchall()]
    hold = decontaminate.Items(list(range(len(items))), items, decontaminate.Q, decontaminate.RATE)
    dirty = {i for i, t in docs.items() if any(x in decontaminate.normal(t) for x in items)}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert not dirty & set(got) and len(got) == len([r for r in got])
    assert all(next(hold.regions(decontaminate.normal(docs[i])), None) for i in set(docs) - set(got)) and set(got) <= set(docs)
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(queries.tokenizer_file("word_bpe_49k.json"))
    for i, r in got.items():
        ids = t.encode(docs[i], add_special_tokens=False).ids
        assert list(r.ids) == ids and r.n_tokens == len(ids)


def test_stages_keep_all_columns_and_take_odd_rows(spark, docs):
    real = queries.read(spark, SF, "documents")
    odd = docs.withColumn("n_chars", F.lit(None).cast("long")).unionByName(real.limit(30))
    odd = odd.withColumns({"n_words": F.lit("x"), "kept": F.lit(1), "row": F.lit(2), "ids": F.lit(3), "key": F.lit(4), "item_id": F.lit(5)})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for rows in (odd, odd.limit(0)):
            out = stage(spark, rows, SF)
            assert out.columns == odd.columns and out.count() <= rows.count()
    for rows in (odd, odd.limit(0)):
        assert corpus_pipeline.STAGES[-1][1](spark, rows, SF).count() == rows.count()
