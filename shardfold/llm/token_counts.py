"""Token counts of whole texts, by the tokenizer's own library.

Arrow functions return lengths only.  Texts are split at boundaries where the
tokenizer always starts anew, so any text is counted piece by piece; pieces
that a worker has not met are encoded together in batches balanced by UTF-8 bytes,
and their lengths are remembered (a bounded number of them).  A text's count
is the sum over its pieces, which is exact because no token crosses a safe
boundary.  Ids of byte-level texts are put together without Python objects per
piece: boundaries come from byte classes, pieces are dictionary-encoded by
Arrow, and only a slice's different pieces are looked up.

Where a boundary is safe depends on the tokenizer file:

* word BPE that drops white space: every space and line feed;
* byte-level BPE: before a space behind a character that isn't white space
  (and, if no space is followed by white space, before every space); for ids,
  also where letters or digits and punctuation part, and behind a single line feed;
* SentencePiece models and other files: none, whole texts are encoded.

Defined cases: null text is empty and has no tokens; special strings inside
texts are handled as the library does by default; repeated rows are counted
each; an empty table gives an empty table; other columns pass through, but for
those named like an added one, which takes their place.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable
from functools import lru_cache
from itertools import chain
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .bpe import cut_before_spaces
from .common import prepare_python, fresh, sized_slices

#: UTF-8 bytes that one call of the library encodes at most (a longer single piece stands alone)
CALL_BYTES = 1 << 20
#: pieces that a worker remembers at most, and the longest that it remembers
REMEMBERED, LONGEST = 1_000_000, 64
#: pieces that share one string in a call, parted by a special token, and such as need nothing between them
JOINED, RUN_ON = 1024, 64
#: bytes whose boundaries are sought at a time
BLOCK_BYTES = 1 << 18
MAX_TOKENS = 2048

#: words and punctuation part here, whatever stands around them
_INNER = re.compile(r"(?<=[A-Za-z0-9])(?=[.,;:!?|\n])|(?<=[A-Za-z0-9.,;:!?|]\n)(?=[^\W\d_])")

#: classes of a byte: letter or digit, letter, printable but neither, such but not an apostrophe, printable and not a space, surely begins a character that isn't white space
_ALNUM, _LETTER, _MARK, _OPEN, _PLAIN, _SURE = (1 << k for k in range(6))


def _byte_class(b: int) -> int:
    if 0x21 <= b <= 0x7E:
        c = chr(b)
        return _PLAIN | _SURE | (_ALNUM | (_LETTER if c.isalpha() else 0) if c.isalnum() else _MARK | (_OPEN if c != "'" else 0))
    if chr(b) == "\n":
        return _MARK  # ends a word like punctuation
    return _SURE if 0xC3 <= b <= 0xDF or 0xE4 <= b <= 0xF4 else 0


_CLASSES = bytes(map(_byte_class, range(256)))


def piece_starts(data: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Ascending places in UTF-8 ``data`` at which byte-level words always part, among them the starts ``texts`` of its texts.

    A word holds a space only as its first character, so it parts before a
    space behind or before any other character than white space.  Letters and
    digits part from ASCII punctuation and line feeds behind them, ASCII
    letters from punctuation before them (but for apostrophes), and a single
    line feed from what follows.  Where white space is in question (control
    characters, leads of its multi-byte characters), nothing is cut.
    """
    out = []
    for a in range(0, len(data), BLOCK_BYTES):
        z = min(a + BLOCK_BYTES, len(data))
        # four bytes before the block and one behind it
        part = data[max(a - 4, 0):z + 1].tobytes()
        part = bytes(4 - min(a, 4)) + part + bytes(z + 1 > len(data))
        raw, kind = np.frombuffer(part, np.uint8), np.frombuffer(part.translate(_CLASSES), np.uint8)
        here, before = kind[4:-1], kind[3:-2]
        own = texts[np.searchsorted(texts, a):np.searchsorted(texts, z)] - a
        latin = (raw[2:-3] == 0xC3) & (raw[3:-2] & 0xDF != 0x97)  # À to ÿ but × and ÷
        cut = (before & _ALNUM != 0) | latin
        cut &= here & _MARK != 0
        cut |= (before & _OPEN != 0) & (here & _LETTER != 0)
        feeds = np.flatnonzero(raw[3:-2] == 10)
        cut[feeds[(here[feeds] & _SURE != 0) & (kind[2:-3][feeds] & _PLAIN != 0)]] = True
        spaces = np.flatnonzero(raw[4:-1] == 32)
        follows = kind[5:][spaces] & _SURE != 0
        ends = texts[np.searchsorted(texts, a + 1):np.searchsorted(texts, z, "right")] - a - 1
        follows &= ~np.isin(spaces, ends[raw[4:-1][ends] == 32])  # what follows is another text
        two, three, four = raw[2:-3][spaces], raw[1:-4][spaces], raw[:-5][spaces]
        behind = (before[spaces] & _PLAIN != 0) | (two >= 0xC3) & (two <= 0xDF) | (three >= 0xE4) & (three <= 0xEF) | (four >= 0xF0)
        cut[spaces[follows | behind]] = True
        cut[own] = True
        out.append(np.flatnonzero(cut) + a)
    return np.concatenate(out) if out else np.empty(0, np.int64)


def n_bytes(text: str) -> int:
    return len(text) if text.isascii() else len(text.encode("utf-8", "surrogatepass"))


class Library:
    """A tokenizer file in its library, with its lengths or ids per piece."""

    def __init__(self, path: str, ids: bool = False):
        # two generations: what is asked for again moves from the old one to the young one
        self.known: dict[str, object] = {}
        self.older: dict[str, object] = {}
        self.kind, self.want_ids = "whole", ids
        self.special: list[str] = []
        self.widths: np.ndarray | None = None
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.batch = lambda texts: model.encode(texts, num_threads=1)
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallelism
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            self.batch = lambda texts: [e.ids for e in model.encode_batch_fast(texts, add_special_tokens=False)]
            added = model.get_added_tokens_decoder()
            self.special, self.special_ids = [t.content for t in added.values()], list(added)
            self.kind = self._kind(path)
            if self.kind == "bytes":
                # a character of a byte-level token stands for one byte
                vocab = model.get_vocab(with_added_tokens=False)
                self.widths = np.zeros(max(vocab.values()) + 1, np.int64)
                self.widths[list(vocab.values())] = list(map(len, vocab))

    @staticmethod
    def _kind(path: str) -> str:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, post = spec["pre_tokenizer"] or {}, spec["post_processor"]
        steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [spec["normalizer"]] if spec["normalizer"] else [])]
        # an added token that takes in white space around it, or holds some, crosses boundaries
        if post or any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or re.search(r"\s", t["content"]) for t in spec["added_tokens"]):
            return "whole"
        if not steps and pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]:
            return "bytes"
        first = (pre.get("pretokenizers") or [{}])[0]
        if steps == ["NFC", "Replace", "Lowercase"] and first.get("type") == "Split" and first.get("invert") and first.get("behavior") == "Removed" and r"\s" in first["pattern"]["Regex"]:
            return "words"
        return "whole"

    def cut(self, text: str) -> list[str]:
        if self.kind == "words":
            return text.replace("\n", " ").split(" ")
        return cut_before_spaces(text) if self.kind == "bytes" else [text]

    def _encoded(self, pieces: list[str], special: bool) -> Iterable:
        """Ids or lengths of pieces; short ones share a call, parted by a special token, which the library finds first of all."""
        for a, b in sized_slices(list(map(n_bytes, pieces)), CALL_BYTES):
            if special or self.kind == "whole" or not self.special:
                for ids in self.batch(pieces[a:b]):
                    yield pack(f"<{len(ids)}I", *ids) if self.want_ids else len(ids)
                continue
            mark, mark_id = self.special[0], self.special_ids[0]
            for ids in self.batch([mark.join(pieces[k:min(k + JOINED, b)]) for k in range(a, b, JOINED)]):
                ids = np.array(ids, "<u4")
                marks = np.flatnonzero(ids == mark_id)
                starts, ends = np.append(0, marks + 1), np.append(marks, len(ids))
                if self.want_ids:
                    raw = ids.tobytes()
                    yield from (raw[x:y] for x, y in zip((4 * starts).tolist(), (4 * ends).tolist()))
                else:
                    yield from (ends - starts).tolist()

    def _run_on(self, pieces: list[str]) -> Iterable:
        """Ids or lengths of pieces that begin with a space and end in a character that isn't white space.

        One behind the other they part by themselves.  Byte-level tokens keep
        every byte, so their widths tell where a piece's tokens end.
        """
        sizes = list(map(n_bytes, pieces))
        for a, b in sized_slices(sizes, CALL_BYTES):
            ids = np.array(list(chain.from_iterable(self.batch(["".join(pieces[k:min(k + RUN_ON, b)]) for k in range(a, b, RUN_ON)]))), "<u4")
            at, ends = np.cumsum(self.widths[ids]), np.cumsum(sizes[a:b])
            last = np.searchsorted(at, ends)
            if at[-1] != ends[-1] or (at[last] != ends).any():
                yield from self._encoded(pieces[a:b], False)  # a tokenizer that drops bytes
            elif self.want_ids:
                raw, cuts = ids.tobytes(), [0, *(4 * last + 4).tolist()]
                yield from (raw[x:y] for x, y in zip(cuts, cuts[1:]))
            else:
                yield from np.diff(last, prepend=-1).tolist()

    def _recalled(self, pieces: Iterable[str]) -> dict:
        """What the old generation knows of ``pieces``, now in the young one; a full young one has become the old one."""
        if len(self.known) > REMEMBERED // 2:
            self.older, self.known = self.known, {}
        older = self.older
        again = {p: older[p] for p in pieces if p in older} if older else {}
        self.known.update(again)
        return again

    def _fetched(self, pieces: Iterable[str], special: bool) -> dict:
        """The library's values of pieces."""
        spaced = [] if special or self.widths is None else [p for p in pieces if p[:1] == " " != p[-1] and p[-1].isprintable()]
        rest = list(set(pieces).difference(spaced)) if len(spaced) < len(pieces) else []
        found = dict(zip(spaced, self._run_on(spaced)))
        found.update(zip(rest, self._encoded(rest, special)))
        return found

    def _keep(self, found: dict) -> None:
        self.known.update(found if max(map(len, found), default=0) <= LONGEST else {p: v for p, v in found.items() if len(p) <= LONGEST})

    def learn(self, pieces: set[str], special: bool) -> dict:
        """The values of pieces that aren't known, of which the short ones are remembered."""
        again = self._recalled(pieces)
        known, older, inner, todo = self.known, self.older, {}, set()
        pieces = pieces.difference(again)
        if special or self.kind == "whole":
            todo.update(pieces)
        else:
            for p in pieces:
                # behind its first character most pieces have letters and digits only, and nothing to part
                if p[1:].isalnum() or len(qs := _INNER.split(p)) == 1:
                    todo.add(p)
                else:
                    inner[p] = qs
                    for q in qs:
                        if q in known:
                            continue
                        if q in older:
                            known[q] = older[q]
                        else:
                            todo.add(q)
        found = self._fetched(todo, special)
        for p, qs in inner.items():
            parts = [found[q] if q in found else known[q] for q in qs]
            found[p] = b"".join(parts) if self.want_ids else sum(parts)
        self._keep(found)
        found.update(again)
        return found

    def texts(self, texts: list[str], sizes: list[int]) -> list:
        """Lengths, or ids as little-endian unsigned 32-bit integers, of whole texts of these UTF-8 sizes."""
        out = []
        for a, b in sized_slices(sizes, CALL_BYTES):
            some = texts[a:b]
            cut = [self.cut(t) for t in some]
            values = [list(map(self.known.get, pieces)) for pieces in cut]
            new = {p for pieces, vs in zip(cut, values) if None in vs for p, v in zip(pieces, vs) if v is None}
            if new:
                # special tokens are found in the raw text, so nothing may be cut within them
                found = self.learn(new, any(s in t for s in self.special for t in some))
                values = [[found[p] if v is None else v for p, v in zip(pieces, vs)] if None in vs else vs for pieces, vs in zip(cut, values)]
            out += map(b"".join if self.want_ids else sum, values)
        return out

    def ids(self, texts: pa.Array) -> list[bytes]:
        """Ids of whole texts, as little-endian unsigned 32-bit integers."""
        texts = texts.fill_null("").cast(pa.string())
        if self.kind != "bytes" or not self.want_ids:
            return self.texts(texts.to_pylist(), pa.compute.binary_length(texts).to_pylist())
        # special tokens are found in the raw text, so nothing may be cut within them: such texts go another way
        marked = np.zeros(len(texts), bool)
        for s in self.special:
            marked |= pa.compute.match_substring(texts, s).to_numpy(zero_copy_only=False)
        if not marked.any():
            return self._byte_ids(texts)
        apart = texts.filter(pa.array(marked))
        out = self._byte_ids(pa.compute.if_else(pa.array(marked), "", texts))
        for k, ids in zip(np.flatnonzero(marked).tolist(), self.texts(apart.to_pylist(), pa.compute.binary_length(apart).to_pylist())):
            out[k] = ids
        return out

    def _byte_ids(self, texts: pa.Array) -> list[bytes]:
        ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
        if ends[0] == ends[-1]:
            return [b""] * len(texts)
        data, at = np.frombuffer(texts.buffers()[2], np.uint8)[ends[0]:ends[-1]], ends - ends[0]
        bounds = np.append(piece_starts(data, at[:-1][at[:-1] < at[-1]]), at[-1]).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.string(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
        words = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        values = list(map(self.known.get, words))
        if None in values:
            new = [w for w, v in zip(words, values) if v is None]
            found = self._recalled(new)
            new = [w for w in new if w not in found] if found else new
            fetched = self._fetched(new, False)
            self._keep(fetched)
            found.update(fetched)
            values = [found[w] if v is None else v for w, v in zip(words, values)]
        ids = pa.array(values, pa.large_binary()).take(pieces.indices)
        raw = ids.buffers()[2].to_pybytes()
        cuts = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset + np.searchsorted(bounds, at)].tolist()
        return [raw[x:y] for x, y in zip(cuts, cuts[1:])]


@lru_cache(maxsize=4)
def library(path: str, ids: bool = False) -> Library:
    return Library(path, ids)


def count_tokens(docs: DataFrame, path: str, text_col: str = "text", bytes_col: str = "n_bytes", tokens_col: str = "n_tokens") -> DataFrame:
    """``docs`` without ``text_col``, with the text's UTF-8 bytes and tokens; texts go to Python, only lengths come back."""
    docs = fresh(docs, [bytes_col, tokens_col], [text_col])
    rest = [f for f in docs.schema.fields if f.name != text_col]
    prepare_python(docs.sparkSession)
    rows = docs.select(*[f.name for f in rest], text_col)

    def batches(it):
        lib = library(path)
        for batch in it:
            texts = batch.column(len(rest)).fill_null("")
            sizes = pa.compute.binary_length(texts).cast(pa.int64())
            counts = pa.array(lib.texts(texts.to_pylist(), sizes.to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], sizes, counts], [*batch.schema.names[:-1], bytes_col, tokens_col])

    return rows.mapInArrow(batches, T.StructType([*rest, T.StructField(bytes_col, T.LongType()), T.StructField(tokens_col, T.LongType())]))
