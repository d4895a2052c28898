"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text is the average of the embeddings of its character 2- to 4-grams, which
share BUCKETS rows by hash; a linear layer and a softmax give a probability
per language.  Trained by stochastic gradient descent in numpy, then
calibrated on rows kept apart: one temperature for the scores, and the score
below which a prediction counts as rejected.

Training needs few rows, so it takes a bounded sample: about
``rows_per_language`` different texts of each language, chosen by a hash of the
text (the same in every run; copies count once), at least one of each language and
never more than twice that many over all languages.  Executors turn the sampled texts into sparse counts and the
driver gets those.  Prediction streams all rows, whole texts, through Arrow
functions with the broadcast model, whose size doesn't grow with the data.

Letters are lower-cased; runs of anything else are one space.  Defined cases:
a text that is null or has no letter is ``und`` with score 0 and rejected;
without any labelled row everything is ``und``; rows with a null label aren't
trained on; repeated rows are predicted each; an empty table gives an empty
table; other columns pass through, but for those named like an added one,
which takes their place.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, hash128, prepare_python

BUCKETS = 1 << 15
WIDTH = 16
GRAMS = (2, 3, 4)
ROWS_PER_LANGUAGE = 400
EPOCHS, RATE, BATCH = 25, 20.0, 8
#: share of the sample that calibrates, and of its right predictions that may be rejected
APART, REJECTED = 0.25, 0.005
UNKNOWN = "und"
#: a text without a match has no letter (Python may know letters that the JVM counts as unassigned)
SOME_LETTER = r"[\p{L}\p{Cn}]"
STRETCH = 1 << 18


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point its lower-case letter, or a space if it is no letter."""
    table = np.full(0x110000, 32, np.uint32)
    for k in range(0x110000):
        c = chr(k)
        if c.isalpha():
            table[k] = ord(c.lower()[0])
    return table


def gram_counts(text: str) -> np.ndarray | None:
    """Counts by bucket of the 2- to 4-grams of a text; None if it has no letter."""
    counts, any_letter = np.zeros(BUCKETS, np.int64), False
    for at in range(0, max(len(text), 1), STRETCH):
        # stretches overlap by the longest gram less one, so each gram is counted about once
        codes = _letters()[np.frombuffer(text[max(0, at - GRAMS[-1] + 1):at + STRETCH].encode("utf-32-le", "replace"), "<u4")]
        space = codes == 32
        any_letter |= not space.all()
        codes = np.concatenate(([32], codes[~(space & np.concatenate(([True], space[:-1])))], [32])).astype(np.uint64)
        run = codes
        for n in range(2, GRAMS[-1] + 1):
            if len(codes) < n:
                break
            run = run[:len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1:]
            if n in GRAMS:
                counts += np.bincount(((run + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - 15)).astype(np.int64), minlength=BUCKETS)
    return counts if any_letter else None


@dataclass
class Model:
    languages: list[str]
    embed: np.ndarray
    linear: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0

    def logits(self, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return (counts @ self.embed[buckets] / counts.sum()) @ self.linear + self.bias

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, calibrated score, whether it is rejected."""
        grams = gram_counts(text) if text and self.languages else None
        if grams is None:
            return UNKNOWN, 0.0, True
        at = np.flatnonzero(grams)
        p = softmax(self.logits(at, grams[at].astype(np.float64)) / self.temperature)
        k = int(p.argmax())
        return self.languages[k], float(p[k]), bool(p[k] < self.reject_below)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]], seed: int = 7) -> Model:
    """A model of (language, buckets, counts) rows."""
    rng = np.random.default_rng(seed)
    names = sorted({r[0] for r in rows})
    y = np.array([names.index(r[0]) for r in rows], int)
    model = Model(names, rng.uniform(-1, 1, (BUCKETS, WIDTH)) / WIDTH, rng.uniform(-1, 1, (WIDTH, len(names))) / WIDTH, np.zeros(len(names)))
    order = rng.permutation(len(rows))
    apart, train = np.split(order, [int(len(rows) * APART)])
    x = [(r[1], r[2] / r[2].sum()) for r in rows]
    steps = max(1, EPOCHS * len(train))
    done = 0
    for _ in range(EPOCHS):
        rng.shuffle(train)
        for k in range(0, len(train), BATCH):
            some = train[k:k + BATCH]
            hidden = np.stack([x[i][1] @ model.embed[x[i][0]] for i in some])
            off = softmax(hidden @ model.linear + model.bias)
            off[np.arange(len(some)), y[some]] -= 1
            rate = RATE * (1 - done / steps)
            back = off @ model.linear.T
            model.linear -= rate / len(some) * hidden.T @ off
            model.bias -= rate / len(some) * off.mean(0)
            for i, g in zip(some, back):
                model.embed[x[i][0]] -= rate / len(some) * np.outer(x[i][1], g)
            done += len(some)
    if len(apart):
        z = np.stack([model.logits(rows[i][1], rows[i][2]) for i in apart])
        def loss(t):
            return -np.log(np.maximum(softmax(z / t)[np.arange(len(apart)), y[apart]], 1e-12)).mean()
        model.temperature = min(np.geomspace(0.25, 16, 49), key=loss)
        p = softmax(z / model.temperature)
        right = p.max(1)[p.argmax(1) == y[apart]]
        model.reject_below = float(np.quantile(right, REJECTED)) if len(right) else 0.0
    return model


def sampled(rows: DataFrame, rows_per_language: int) -> DataFrame:
    """(lang, text): about ``rows_per_language`` different texts of each language, one of each that has any."""
    rows = rows.where("lang IS NOT NULL").where(F.col("text").rlike(SOME_LETTER))
    chance = F.pmod(F.xxhash64("text", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # copies share a hash, so they come all or not at all and count once
    texts = rows.select("lang", chance.alias("chance"), *hash128(F.col("text"))).distinct()
    known = texts.groupBy("lang").agg(F.count("*").alias("n"), F.min("chance").alias("least")).collect()  # one row per language
    if not known:
        return rows.select("lang", "text").limit(0)

    def of_lang(values):
        return F.element_at(F.create_map(*[F.lit(x) for lang, v in values for x in (lang, v)]), F.col("lang"))

    share = of_lang((r.lang, min(1.0, rows_per_language / r.n)) for r in known)
    least = of_lang((r.lang, r.least) for r in known)
    return (rows.where((chance < share) | (chance <= least)).dropDuplicates(["lang", "text"])
            .orderBy(chance > least, F.xxhash64("text", F.lit("sample"))).limit(max(len(known), 2 * rows_per_language * len(known))))


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", rows_per_language: int = ROWS_PER_LANGUAGE) -> Model:
    """A model of a bounded sample of ``labelled``."""
    prepare_python(labelled.sparkSession)
    sample = sampled(labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")), rows_per_language)

    def counted(it):
        for batch in it:
            found = [(l, g) for l, t in zip(batch.column(0).to_pylist(), batch.column(1)) if (g := gram_counts(t.as_py())) is not None]
            if found:
                at = [np.flatnonzero(g) for _, g in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([l for l, _ in found]), pa.array(at, pa.list_(pa.int32())),
                     pa.array([g[a] for a, (_, g) in zip(at, found)], pa.list_(pa.int32()))], ["lang", "at", "n"])

    got = sample.mapInArrow(counted, "lang string, at array<int>, n array<int>").toArrow().to_pylist()
    got.sort(key=lambda r: (r["lang"], r["at"], r["n"]))
    return fit([(r["lang"], np.array(r["at"]), np.array(r["n"], float)) for r in got])


def predict(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang_pred", score_col: str = "score", rejected_col: str = "rejected") -> DataFrame:
    """``docs`` without ``text_col``, with the predicted language, its score and whether it is rejected."""
    docs = fresh(docs, [lang_col, score_col, rejected_col], [text_col])
    rest = [f for f in docs.schema.fields if f.name != text_col]
    prepare_python(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = [T.StructField(lang_col, T.StringType()), T.StructField(score_col, T.DoubleType()), T.StructField(rejected_col, T.BooleanType())]

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            out = [shared.value.predict(t.as_py()) for t in batch.column(len(rest))]
            cols = [pa.array([o[k] for o in out], t) for k, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *cols], [f.name for f in [*rest, *added]])

    return docs.select(*[f.name for f in rest], text_col).mapInArrow(batches, T.StructType([*rest, *added]))


def fold(key: Column, folds: int = 4) -> Column:
    """crc32 of ``key`` as text, modulo ``folds``; a null key is the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds
