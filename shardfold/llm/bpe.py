"""BPE encoding and decoding as bounded-lookahead transducers.

:class:`Transducer` reads text piece by piece and emits token ids as soon as
no later input can change them.  How far later input can reach back follows
from the merge list alone (:func:`sufficient_lookahead`), so a word of any
length is encoded in a window of constant size.  :class:`StreamDecoder` turns
ids back into text with an incremental byte-to-text state machine.

Why the lookahead suffices.  Run the merges in rank order over a text and
over the same text with another ending.  Both runs agree on a prefix of
symbols, at first on all but the last byte (which may carry the end-of-word
mark).  Merge k = (a, b) can shorten that prefix only by its last symbol,
which must be ``a``, and only if the symbol behind it is ``b``.  That symbol
starts where the prefix was cut before, so the ``a`` of the cut before stands
on the left edge of ``b``'s derivation.  The longest chain of merges with
rising ranks that link in this way, weighted by the bytes of their ``a``,
bounds the reach.  A token boundary that is out of reach stays, and what
follows a boundary is encoded on its own.

Works for ``tokenizers`` files of two kinds: byte-level BPE whose words are
found by a pattern without normaliser, and BPE with word ends behind NFC,
white space and lower-case normalisers.

Defined cases: null text is empty and has no ids; special tokens inside a
text are found as the library finds them; repeated rows and ties are encoded
alike; an empty table gives an empty table; other columns pass through, but
for those named like the added one, which takes their place.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
import struct
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prepare_python, fresh

#: texts are read in stretches of so many characters, cut at spaces
STRETCH = 1 << 16
#: words of more characters give their ids token by token
LONG_WORD = 4096
#: remembered words and pieces a worker keeps at most
REMEMBERED = 200_000
#: fixed values: the word pattern of byte-level files that name none
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


@lru_cache(maxsize=1)
def newer_letters() -> frozenset[str]:
    """Letters and digits of a Unicode version that the pattern module knows and the library's pattern engine doesn't yet."""
    import regex
    from tokenizers import Regex, pre_tokenizers

    found = regex.findall(r"[\p{L}\p{N}]", "".join(chr(k) for k in range(0x110000) if not 0xD800 <= k < 0xE000))
    recent = "".join(c for c in found if unicodedata.category(c)[0] not in "LN")
    unknown = pre_tokenizers.Split(Regex(r"[\p{L}\p{N}]"), "removed").pre_tokenize_str(recent)
    return frozenset("".join(part for part, _ in unknown))


@lru_cache(maxsize=1)
def _library_normal():
    """NFC and lower case by the library, for characters that Python's own tables don't have yet."""
    from tokenizers import normalizers

    return normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])


def sufficient_lookahead(merges: list[tuple[str, str]], suffix: str = "") -> int:
    """Bytes behind a token boundary after which no further input can move that boundary."""
    def n_bytes(symbol: str) -> int:
        return len(symbol) - len(suffix) if suffix and symbol.endswith(suffix) else len(symbol)

    left_of = {a + b: a for a, b in reversed(merges)}
    reach: dict[str, int] = {}
    most = 0
    for a, b in merges:
        chain, edge = 0, b
        while edge is not None:
            chain = max(chain, reach.get(edge, 0))
            edge = left_of.get(edge)
        total = chain + n_bytes(a)
        if total > reach.get(a, 0):
            reach[a] = total
        most = max(most, total)
    return most + 1


class Transducer:
    """Text to ids for one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("unk_token") or model.get("ignore_merges"):
            raise ValueError(f"{path}: only plain BPE over bytes is read")
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.vocab = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.ranks = {m: k for k, m in enumerate(merges)}
        made = {a + b: k for k, (a, b) in reversed(list(enumerate(merges)))}
        if any(made.get(x, -1) >= k for k, m in enumerate(merges) for x in m):
            raise ValueError(f"{path}: a merge uses a symbol that a later merge makes")
        self.lookahead = sufficient_lookahead(merges, self.suffix)
        self.alphabet = byte_alphabet()
        self.table = dict(enumerate(self.alphabet))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] or re.search(r"\s", t["content"]) for t in spec["added_tokens"]):
            raise ValueError(f"{path}: added tokens with options aren't read")
        self.special_pattern = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self._read_steps(path, spec)
        self.pieces: dict[str, bytes] = {"": b""}
        self.words: dict[str, bytes] = {}

    def _read_steps(self, path: str, spec: dict) -> None:
        import regex

        steps = [n["type"] for n in (spec["normalizer"] or {"normalizers": []})["normalizers"]]
        pre = spec["pre_tokenizer"]
        if not steps and pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]:
            self.drops_space, pattern = False, BYTE_LEVEL_PATTERN
        elif steps == ["NFC", "Replace", "Lowercase"] and [p["type"] for p in pre["pretokenizers"]] == ["Split", "ByteLevel"]:
            self.drops_space, pattern = True, pre["pretokenizers"][0]["pattern"]["Regex"]
        else:
            raise ValueError(f"{path}: these normaliser and word-splitting steps aren't read")
        self.word_pattern = regex.compile(pattern)
        self.newer = newer_letters()

    # words

    def _merged(self, symbols: list[str]) -> list[str]:
        """``symbols`` after all merges, lowest rank first and from the left."""
        return self._merged_short(symbols) if len(symbols) <= 24 else self._merged_long(symbols)

    def _merged_short(self, s: list[str]) -> list[str]:
        rank, none = self.ranks.get, len(self.ranks)
        pairs = [rank(p, none) for p in zip(s, s[1:])]
        while pairs:
            best = min(pairs)
            if best == none:
                break
            i = pairs.index(best)
            s[i:i + 2] = [s[i] + s[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = rank((s[i - 1], s[i]), none)
            if i < len(pairs):
                pairs[i] = rank((s[i], s[i + 1]), none)
        return s

    def _merged_long(self, s: list[str]) -> list[str]:
        n, rank = len(s), self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, p) for i, p in enumerate(zip(s, s[1:])) if (r := rank(p)) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i] if s[i] is not None else n
            if j >= n or (s[i], s[j]) != pair:
                continue
            s[i], s[j] = s[i] + s[j], None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for x, y in ((before[i], i), (i, k)):
                if x >= 0 and y < n and (r := rank((s[x], s[y]))) is not None:
                    heapq.heappush(heap, (r, x, (s[x], s[y])))
        return [x for x in s if x is not None]

    def _n_bytes(self, symbol: str) -> int:
        return len(symbol) - len(self.suffix) if self.suffix and symbol.endswith(self.suffix) else len(symbol)

    def stream_word(self, symbols: Iterable[str]) -> Iterator[str]:
        """Tokens of one word, emitted once no later byte can change them; holds 4 lookaheads of bytes at most."""
        source, window = iter(symbols), []
        while True:
            window += islice(source, max(64, 4 * self.lookahead) - len(window) + 1)
            if len(window) <= max(64, 4 * self.lookahead):  # the word's end is in sight
                if window:
                    window[-1] += self.suffix
                yield from self._merged(window)
                return
            stable, done = len(window) - self.lookahead, 0
            for token in self._merged(list(window)):
                if done + len(token) > stable:
                    break
                done += len(token)
                yield token
            window = window[done:]

    def _word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            raw = word.encode("utf-8", "replace")
            ids = struct.pack(f"<{len(v)}I", *v) if (v := [self.vocab[t] for t in self.stream_word(self.alphabet[b] for b in raw)]) else b""
            if len(word) <= 64:
                _remember(self.words, word, ids)
        return ids

    # pieces

    def _normal(self, piece: str) -> str:
        if piece.isascii():
            return piece.lower()
        if "Cn" in map(unicodedata.category, piece):
            return _library_normal().normalize_str(piece)
        piece = unicodedata.normalize("NFC", piece)
        return piece.lower() if "Σ" not in piece else "".join(map(str.lower, piece))  # the library lowers each character alone

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece that may hold special tokens, as little-endian unsigned 32-bit integers."""
        out, at = [], 0
        marks = self.special_pattern.finditer(piece) if self.special_pattern else ()
        for m in marks:
            out += self._plain(piece[at:m.start()])
            out.append(struct.pack("<I", self.special[m[0]]))
            at = m.end()
        out += self._plain(piece[at:])
        ids = b"".join(out)
        if len(piece) <= 64:
            _remember(self.pieces, piece, ids)
        return ids

    def _plain(self, text: str) -> Iterator[bytes]:
        text = self._normal(text) if self.drops_space else text
        if self.newer.isdisjoint(text):
            return map(self._word, self.word_pattern.findall(text))
        as_symbols = "".join("☀" if c in self.newer else c for c in text)
        return (self._word(text[m.start():m.end()]) for m in self.word_pattern.finditer(as_symbols))

    def _next_cut(self, text: str, at: int) -> int:
        """The first place from ``at`` on where pieces part, or the text's end."""
        if self.drops_space:
            return min(k if k >= 0 else len(text) for k in (text.find(" ", at), text.find("\n", at)))
        m = _SAFE.search(text, at)
        return m.start() if m else len(text)

    def _cut(self, text: str) -> list[str]:
        """Pieces that are encoded alike alone and in ``text``."""
        if self.drops_space:
            return text.replace("\n", " ").split(" ")
        return cut_before_spaces(text)

    def _long(self, piece: str) -> Iterator[bytes]:
        """Ids of a long piece a few at a time: word by word, and a long word token by token."""
        at, held, size = 0, [], 0
        for m in [*(self.special_pattern.finditer(piece) if self.special_pattern else ()), None]:
            text = piece[at:m.start() if m else len(piece)]
            text = self._normal(text) if self.drops_space else text
            as_symbols = text if self.newer.isdisjoint(text) else "".join("☀" if c in self.newer else c for c in text)
            for w in self.word_pattern.finditer(as_symbols):
                if w.end() - w.start() <= LONG_WORD:
                    held.append(self._word(text[w.start():w.end()]))
                    size += len(held[-1])
                else:
                    for token in self.stream_word(self.alphabet[b] for c in range(w.start(), w.end()) for b in text[c].encode("utf-8", "replace")):
                        held.append(struct.pack("<I", self.vocab[token]))
                        size += 4
                        if size >= STRETCH:
                            yield b"".join(held)
                            held, size = [], 0
                if size >= STRETCH:
                    yield b"".join(held)
                    held, size = [], 0
            if m:
                held.append(struct.pack("<I", self.special[m[0]]))
                at = m.end()
        yield b"".join(held)

    def encode(self, text: str | None) -> Iterator[bytes]:
        """Ids of ``text`` in order, stretch by stretch; what is held beside the text doesn't grow with it."""
        for stretch in stretches(text or ""):
            if len(stretch) > 2 * STRETCH:  # no safe space for long
                at = 0
                while at < len(stretch):
                    end = self._next_cut(stretch, at + STRETCH)
                    yield from self._long(stretch[at:end])
                    at = end + (self.drops_space and end < len(stretch))
                continue
            pieces = self._cut(stretch)
            ids = list(map(self.pieces.get, pieces))
            if None in ids:
                ids = [self._piece(p) if i is None else i for p, i in zip(pieces, ids)]
            yield b"".join(ids)


def _remember(known: dict, key: str, value) -> None:
    if len(known) >= REMEMBERED:
        for k in list(islice(known, REMEMBERED // 2)):
            del known[k]
        known.setdefault("", b"")
    known[key] = value


#: a space that white space follows: only there can a cut before a space change the words around it
_AMBIGUOUS = re.compile(r" (?=\s)")
#: a space behind a character that isn't white space always starts a word
_SAFE = re.compile(r"(?<=[^\s\x1c-\x1f\x85᠎])(?= )")


def cut_before_spaces(text: str) -> list[str]:
    """Cut before each space at which byte-level words always part."""
    if "\0" in text or "<|" in text or _AMBIGUOUS.search(text):
        return _SAFE.split(text)
    return text.replace(" ", "\0 ").split("\0")


def stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    """``text`` in stretches of about ``size`` characters, cut before a space that stands behind a character that isn't white space."""
    at = 0
    while len(text) - at > size:
        m = _SAFE.search(text, at + size)
        if not m:
            break
        yield text[at:m.start()]
        at = m.start()
    yield text[at:] if at else text


class StreamDecoder:
    """Ids to text.  Bytes that don't yet make a character wait for the next ids; bytes that never will become U+FFFD."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        tokens = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
        kind = (spec["decoder"] or {"type": None})["type"]
        if kind not in (None, "ByteLevel"):
            raise ValueError(f"{path}: decoder {kind} isn't read")
        back = {c: b for b, c in enumerate(byte_alphabet())}
        self.between = b" " if kind is None else b""
        self.bytes: list[bytes] = [b""] * (max(tokens.values()) + 1)
        for t, i in tokens.items():
            self.bytes[i] = bytes(back[c] for c in t) if kind and all(c in back for c in t) else t.encode()
        self.reset()

    def reset(self) -> None:
        self.state = codecs.getincrementaldecoder("utf-8")("replace")
        self.lead = b""

    def push(self, ids: bytes) -> str:
        """Text that these further ids (little-endian unsigned 32-bit integers) complete."""
        if not ids:
            return ""
        raw = self.lead + self.between.join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        self.lead = self.between
        return self.state.decode(raw)

    def end(self) -> str:
        text = self.state.decode(b"", True)
        self.reset()
        return text


@lru_cache(maxsize=4)
def transducer(path: str) -> Transducer:
    return Transducer(path)


@lru_cache(maxsize=4)
def decoder(path: str) -> StreamDecoder:
    return StreamDecoder(path)


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the token ids of ``text_col`` as an array of integers."""
    docs = fresh(docs, [ids_col], [text_col])
    prepare_python(docs.sparkSession)

    def batches(it):
        t = transducer(path)
        for batch in it:
            at = batch.schema.get_field_index(text_col)
            ids, ends = [], [0]
            for text in batch.column(at):
                ids.append(b"".join(t.encode(text.as_py())))
                ends.append(ends[-1] + len(ids[-1]) // 4)
            flat = pa.array(np.frombuffer(b"".join(ids), "<u4").astype("<i4"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)], [*batch.schema.names, ids_col])

    return docs.mapInArrow(batches, T.StructType([*docs.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType()))]))


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its token ids; null ids are empty."""
    encoded = fresh(encoded, [out_col], [ids_col])
    prepare_python(encoded.sparkSession)

    def batches(it):
        d = decoder(path)
        for batch in it:
            at = batch.schema.get_field_index(ids_col)
            texts = []
            for ids in batch.column(at):
                raw = np.asarray(ids.as_py() or [], "<u4").tobytes()
                texts.append("".join(d.push(raw[k:k + 4 * STRETCH]) for k in range(0, len(raw), 4 * STRETCH)) + d.end())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out_col])

    return encoded.mapInArrow(batches, T.StructType([*encoded.schema.fields, T.StructField(out_col, T.StringType())]))


DIGESTS = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Encode and decode each text in one pass, stretch by stretch: ``id_col`` and DIGESTS, on request with the ids."""
    prepare_python(docs.sparkSession)
    rows = docs.select(F.col(id_col), F.col(text_col))
    schema = T.StructType([rows.schema[0], *T._parse_datatype_string(DIGESTS).fields, *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if keep_ids else [])])

    def batches(it):
        t, d = transducer(path), decoder(path)
        for batch in it:
            counts, shas, texts, kept, ends = [], [], [], [], [0]
            for text in batch.column(1):
                n, a, b = 0, hashlib.sha256(), hashlib.sha256()
                for ids in t.encode(text.as_py()):
                    n += len(ids) // 4
                    a.update(ids)
                    b.update(d.push(ids).encode())
                    if keep_ids:
                        kept.append(ids)
                b.update(d.end().encode())
                counts.append(n)
                shas.append(a.hexdigest())
                texts.append(b.hexdigest())
                ends.append(ends[-1] + n)
            out = [batch.column(0), pa.array(counts, pa.int64()), pa.array(shas, pa.string()), pa.array(texts, pa.string())]
            if keep_ids:
                out.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(kept), "<i4"))))
            yield pa.RecordBatch.from_arrays(out, schema.names)

    return rows.mapInArrow(batches, schema)
