"""Quality rules with host verdicts.

Each document is measured by rules over its whole text.  Failures are summed
by host, a host's failure rate is shrunk towards the rate of all hosts by a
beta prior fitted to the hosts themselves (method of moments), and a host
whose shrunk rate passes ``max_rate`` in any rule is rejected with all its
documents.  A document is kept if it passes the base rules and its host
isn't rejected.

Native: DataFrame and SQL functions only.

* All measures of a text are computed within its row; nothing is exploded.
* Sums by host are partial on the map side, so a host with a third of all
  documents sends one row per task.  The prior is fitted from one row of sums.
* Verdicts go back by a join on the host.  Only rejected hosts are joined;
  the ``HEAVY`` largest of them (a fixed number of rows) are broadcast, and
  the others, none of which holds more than 1/HEAVY of the documents, are
  joined by key.

Defined cases: null text has no words and fails; a null host gets no verdict
and its documents are judged by their own rules; each row is a document;
an empty table gives an empty table; other columns pass through, but for
those named like an added one, which takes their place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, HEAVY, fresh, let, scratch_table

MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PCT = 30
MAX_SYMBOL_PCT = 30
MAX_DUP_LINES_PCT = 10
#: a host is rejected when its shrunk failure rate in a rule is higher
MAX_RATE = 0.5
#: the prior's weight in documents (alpha + beta) is held between these
MIN_PRIOR, MAX_PRIOR = 2.0, 1e6

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _words(text: Column) -> Column:
    inner = F.btrim(text, F.lit(BLANKS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"[\x20\x09-\x0D]+", -1))


def _window_hashes(words: Column) -> Column:
    """A 64-bit hash for each window of WINDOW words; compared only within one text."""
    def windows(ws):
        return F.transform(F.sequence(F.lit(1), F.size(ws) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(ws, i, WINDOW)))
    return F.when(F.size(words) >= WINDOW, let(F.transform(words, lambda x: F.xxhash64(x)), windows)).otherwise(F.array().cast("array<bigint>"))


def _covered(hashes: Column) -> Column:
    """Words in windows whose hash stands at two places or more.  Sorts, so it is n log n for any text."""
    def from_sorted(ps):
        same_next = F.zip_with(ps, F.slice(ps, F.lit(2), F.size(ps)), lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False)))
        def flags(nx):
            before = F.concat(F.array(F.lit(False)), F.slice(nx, F.lit(1), F.size(nx) - 1))
            return F.zip_with(nx, before, lambda a, b: a | b)
        starts = F.sort_array(F.filter(F.zip_with(ps, let(same_next, flags), lambda p, f: F.when(f, p["p"])), lambda p: p.isNotNull()))
        return let(starts, lambda st: F.aggregate(
            F.zip_with(st, F.slice(st, F.lit(2), F.size(st)), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW)))),
            F.lit(0), lambda acc, x: acc + x))
    pairs = F.sort_array(F.transform(hashes, lambda h, p: F.struct(h.alias("h"), p.alias("p"))))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), let(pairs, from_sorted)).otherwise(F.lit(0))


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the measures of the whole text and ``base_failed``."""
    docs = fresh(docs, [*MEASURES, "base_failed", "kept", "__qr_t", "__qr_w", "__qr_h"], [text_col])
    t = F.col("__qr_t")
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    out = (docs.withColumn("__qr_t", F.coalesce(F.col(text_col), F.lit("")))
           .withColumn("__qr_w", _words(t))
           .withColumn("__qr_h", _window_hashes(F.col("__qr_w"))))
    out = out.withColumns({
        "n_words": F.size("__qr_w").cast("long"),
        "word_chars": F.length(F.array_join("__qr_w", "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.regexp_replace(t, r"[#*$%&|<>]", ""))).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": _covered(F.col("__qr_h")).cast("long"),
    })
    return out.drop("__qr_t", "__qr_w", "__qr_h").withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words")))


def rules() -> dict[str, Column]:
    """The rules whose failures are summed by host: the base rules, symbols against word
    characters, and repeated lines against words (in percent)."""
    return {
        "base": F.col("base_failed"),
        "symbols": 100 * F.col("n_symbols") > MAX_SYMBOL_PCT * F.col("word_chars"),
        "dup_lines": 100 * F.col("n_dup_lines") > MAX_DUP_LINES_PCT * F.col("n_words"),
    }


def host_rates(measured: DataFrame, host_col: str = "source") -> DataFrame:
    """One row per host: documents ``n``, failures ``f_<rule>`` and shrunk rates ``rate_<rule>``."""
    names = list(rules())
    hosts = scratch_table(
        measured.where(F.col(host_col).isNotNull()).groupBy(F.col(host_col).alias("host"))
        .agg(F.count("*").alias("n"), *[F.sum(c.cast("long")).alias(f"f_{r}") for r, c in rules().items()]), "hosts")
    s = hosts.agg(F.sum("n").alias("n"), F.count("*").alias("k"),
                  *[F.sum(f"f_{r}").alias(f"f_{r}") for r in names],
                  *[F.sum(F.pow(F.col(f"f_{r}") / F.col("n"), 2)).alias(f"q_{r}") for r in names],
                  *[F.sum(F.col(f"f_{r}") / F.col("n")).alias(f"m_{r}") for r in names]).first()
    out = hosts
    for r in names:
        rate = (s[f"f_{r}"] / s["n"]) if s["n"] else 0.0
        mean = s[f"m_{r}"] / s["k"] if s["k"] else 0.0
        var = max(s[f"q_{r}"] / s["k"] - mean * mean, 0.0) if s["k"] else 0.0
        weight = min(max(rate * (1 - rate) / var - 1, MIN_PRIOR), MAX_PRIOR) if var > 0 else MAX_PRIOR
        out = out.withColumn(f"rate_{r}", (F.col(f"f_{r}") + F.lit(rate * weight)) / (F.col("n") + F.lit(weight)))
    return out


def rejected_hosts(rates: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """(host, n) of the hosts whose shrunk failure rate passes ``max_rate`` in some rule."""
    bad = F.lit(False)
    for r in rules():
        bad = bad | (F.col(f"rate_{r}") > max_rate)
    return rates.where(bad).select("host", "n")


def judge(measured: DataFrame, host_col: str = "source", max_rate: float = MAX_RATE) -> DataFrame:
    """Add ``kept`` to measured documents.  ``measured`` is read twice: pass a written table."""
    measured = fresh(measured, ["kept", "__qr_host", "__qr_hot", "__qr_bad", "__qr_join", "__qr_rest", "__qr_key"])
    bad = scratch_table(rejected_hosts(host_rates(measured, host_col), max_rate), "rejected-hosts")
    heavy = bad.orderBy(F.desc("n"), "host").limit(HEAVY).select(F.col("host").alias("__qr_host"), F.lit(True).alias("__qr_hot"))
    rest = bad.select(F.xxhash64("host").alias("__qr_join"), F.col("host").alias("__qr_rest"), F.lit(True).alias("__qr_bad"))
    out = measured.join(F.broadcast(heavy), F.col(host_col) == F.col("__qr_host"), "left")
    # rows that are decided or have no host are dealt by their measures, not by one key
    key = F.when(F.col("__qr_hot").isNull() & F.col(host_col).isNotNull(), F.xxhash64(host_col)).otherwise(F.xxhash64(*MEASURES))
    out = out.withColumn("__qr_key", key).join(rest, (F.col("__qr_key") == F.col("__qr_join")) & (F.col(host_col) == F.col("__qr_rest")), "left")
    kept = ~F.col("base_failed") & F.col("__qr_hot").isNull() & F.col("__qr_bad").isNull()
    return out.withColumn("kept", kept).select(*measured.columns, "kept")


def quality_rules(docs: DataFrame, host_col: str = "source", text_col: str = "text", max_rate: float = MAX_RATE) -> DataFrame:
    """``docs`` with its measures, ``base_failed`` and ``kept``.

    The measured documents are written once to the shared scratch folder, so
    the texts are measured once although hosts and verdicts both need them.
    """
    return judge(scratch_table(measure(docs, text_col), "measured"), host_col, max_rate)
