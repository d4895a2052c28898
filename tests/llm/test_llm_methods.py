"""What the methods promise beyond the plain results: mask, bytes, distinct documents, constant memory, recall of near holdings."""

import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardfold.llm import bpe, chat_format, decontaminate, line_dedup, token_counts
from shardfold.llm.queries import tokenizer_file

WORD, BYTE = tokenizer_file("word_bpe_49k.json"), tokenizer_file("byte_bpe_50k.json")


# 2

@pytest.mark.parametrize("path", [WORD, BYTE])
def test_texts_without_spaces_take_constant_memory(path):
    from tokenizers import Tokenizer
    rnd = random.Random(3)
    t, lib = bpe.Transducer(path), Tokenizer.from_file(path)
    kinds = ["".join(chr(rnd.randrange(0x4E00, 0x9000)) for _ in range(200_000)), "ab" * 100_000, "é!" * 100_000, "漢。" * 80_000 + "<|endoftext|>" + "字" * 90_000,
             "x" * 150_000 + " y" + "z\n" * 100_000, "a\n" * 100_000, "\n" * 150_000 + "b", "  " * 90_000 + "c"]
    for text in kinds:
        assert np.frombuffer(b"".join(t.encode(text)), "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids
    peaks = []
    for n in (200_000, 800_000):
        text = kinds[0] * (n // 200_000)
        tracemalloc.start()
        for _ in t._long(text) if not t.drops_space else ():
            pass
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    if not t.drops_space:
        assert peaks[1] < 1.5 * peaks[0] + 4 * 800_000  # a copy of the text's characters at most


# 3

def test_loss_is_cut_out_by_the_mask(spark):
    rows = [(1, 0, "user", "a question"), (1, 1, "assistant", r"an \answer</turn> ###"), (1, 2, "assistant", ""), (1, 3, "user", "é😂"), (1, 4, "assistant", "last😂 one")]
    out = chat_format.format_chats(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    read = lambda runs: out.select(chat_format.read_loss(F.col("formatted"), runs)).first()[0]
    right = "".join(t for _, _, role, t in rows if role == "assistant")
    assert read(F.col("loss_runs")) == right
    moved = F.transform("loss_runs", lambda r: r.withField("lead", r["lead"] + 1))
    shorter = F.transform("loss_runs", lambda r: r.withField("text", F.greatest(r["text"] - 1, F.lit(0))))
    other = F.transform("loss_runs", lambda r: r.withField("loss", ~r["loss"]))
    assert len({right, read(moved), read(shorter), read(other)}) == 4 and read(other) == "a questioné😂"


# 4

def least_edits(item, text):
    """Least edits of the whole item against any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return min(row)


def changed(rnd, item, edits):
    for _ in range(edits):
        k, c = rnd.randrange(len(item)), rnd.choice("abcdefgh ")
        item = rnd.choice([item[:k] + item[k + 1:], item[:k] + c + item[k:], item[:k] + c + item[k + 1:]])
    return item


def test_near_holdings_are_all_found():
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7)))
    items = [decontaminate.normal(" ".join(word() for _ in range(n))) for n in [2, 2, 3, 3, 4, 4, 5, 6, 8, 12, 20, 30] * 3]
    items += ["abcdefghabcde", "abab " * 6 + "ab", "aaaaaaaaaaaaaaaaaaaaa", "a b c d e f g h"]
    block = decontaminate.Items(list(range(len(items))), items, decontaminate.Q, decontaminate.RATE)
    found_some = 0
    for _ in range(60):
        parts = [changed(rnd, rnd.choice(items), rnd.randint(0, 4)) if rnd.random() < 0.6 else " ".join(word() for _ in range(rnd.randint(0, 9))) for _ in range(rnd.randint(1, 5))]
        text = decontaminate.normal(" ".join(parts))
        got = {}
        for k, edits, start, end in block.regions(text):
            assert least_edits(items[k], text[start:end]) == edits <= decontaminate.RATE * len(items[k])
            got[k] = min(edits, got.get(k, 99))
        for k, item in enumerate(items):
            if len(item) >= decontaminate.Q:
                least = least_edits(item, text)
                assert got.get(k) == (least if least <= int(decontaminate.RATE * len(item)) else None), (item, text)
        found_some += len(got)
    assert found_some > 50


def test_a_short_item_with_one_edit_is_found(spark):
    docs = spark.createDataFrame([(1, "x yz Thirtean, chars. and"), (2, "thirteen char")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "thirteen chars")], "item_id bigint, text string")
    assert sorted((r.doc_id, r.edits) for r in decontaminate.find(docs, items).collect()) == [(1, 1), (2, 1)]


def test_repeated_grams_do_not_fill_a_band():
    item = "abcdefgh " + " ".join(f"w{k}x{k * 7}" for k in range(30))
    block = decontaminate.Items([1], [item], decontaminate.Q, decontaminate.RATE)
    assert not list(block.grams[0].bands(decontaminate._codes("abcdefgh " * 2000)))


# 5

def test_calls_are_balanced_by_bytes(monkeypatch):
    monkeypatch.setattr(token_counts, "CALL_BYTES", 3000)
    lib, seen = token_counts.Library(BYTE), []
    real = lib.batch
    lib.batch = lambda texts: seen.append(sum(len(t.encode()) for t in texts)) or real(texts)
    texts = ["".join(chr(0x4E00 + (k * 37 + j) % 9000) for j in range(30)) + f" a{k}" for k in range(400)]
    sizes = [len(t.encode()) for t in texts]
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(BYTE)
    assert lib.texts(texts, sizes) == [len(whole.encode(t, add_special_tokens=False).ids) for t in texts]
    assert max(seen) <= 2 * 3000 and len(seen) > 10


# 10

def test_a_line_of_repeated_rows_counts_its_documents(spark):
    rows = [(1, "shared\nown")] * 10 + [(2, "shared\nother")] + [(None, "nobody's")] * 3 + [(k, "common") for k in range(10, 13)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = lambda n: {r.doc_id: r.text for r in line_dedup.dedup_lines(df, min_docs=n).collect()}
    assert kept(3) == {1: "shared\nown", 2: "shared\nother", None: "", 10: "", 11: "", 12: ""}
    assert kept(2) == {1: "own", 2: "other", None: "", 10: "", 11: "", 12: ""}
    assert kept(4) == {1: "shared\nown", 2: "shared\nother", None: "nobody's", 10: "common", 11: "common", 12: "common"}


def test_pieces_behind_one_another_and_two_generations_equal_the_library(monkeypatch):
    """Run-on pieces are parted by the tokens' widths; a memory of a few pieces changes generations all the time."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from shardfold.llm import token_counts as tc

    monkeypatch.setattr(tc, "REMEMBERED", 40)
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    texts = [" ".join(f"word{k % 7}{'.,!$'[k % 4]} über{k * j} it's{k}\n\n  日本{k}" for k in range(60)) for j in range(1, 8)]
    texts += ["", " ", "  a  b ", "a <|endoftext|> b", "x᠎ y\x85 z  w", " a  b"]
    want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    lib, counts = tc.Library(path, True), tc.Library(path)
    for text, ids in [*zip(texts, want)] * 2:
        size = [tc.n_bytes(text)]
        assert lib.texts([text], size) == [b"".join(i.to_bytes(4, "little") for i in ids)]
        assert counts.texts([text], size) == [len(ids)]
    assert lib.older
