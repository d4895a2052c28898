"""Catalogue queries of the training-data operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from . import bpe, chat_format, decontaminate, language_id, licence_scan, line_dedup, ngram_jaccard, personal_data, spelling_variants, token_counts
from . import token_store, whitening
from . import quality_rules as qr
from .common import read, scratch_folder, scratch_table

QUERIES = {}
ORACLE = {}


def tokenizer_file(name: str) -> str:
    """Where a public tokenizer's file is; every executor has the same installation."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


@query
def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings, formatted, and digests read back from the formatted text."""
    tricky = r"\### Assistant: </turn> ok"
    turns = F.array(*[F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(tricky).alias("text"))
                      for i, r in enumerate(("user", "assistant"))])
    extra = spark.range(0, 1, 1, 1).select(F.inline(turns))
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    out = chat_format.format_chats(rows).withColumn("turns", chat_format.read_turns(F.col("formatted")))
    loss = chat_format.read_loss(F.col("formatted"), F.col("loss_runs"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.withColumn("loss", loss).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


ORACLE["op3_chat_format"] = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
t AS (
  SELECT *, row_number() OVER w AS i, lag(role) OVER w AS before,
    replace(replace(replace(text, '\', '\s'), '###', '\h'), '</turn>', '\e') AS body,
    replace(replace(replace(replace(role, '\', '\s'), '###', '\h'), '</turn>', '\e'), ':', '\c') AS head
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length(body) + CASE WHEN role = before THEN 2 ELSE 4 + length(head) + 2 + 8 END)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures, base rules and host verdicts of all documents."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    measured = qr.scratch_table(qr.measure(docs).drop("text"), "measures")
    return qr.judge(measured).drop("source").select("doc_id", *qr.MEASURES, "base_failed", "kept")


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_RULES = {"base": "base_failed", "symbols": "100 * n_symbols > 30 * word_chars", "dup_lines": "100 * n_dup_lines > 10 * n_words"}
#: measures of every document; {docs} has doc_id, source, text
MEASURE_SQL = rf"""
words AS (SELECT doc_id, source, coalesce(text, '') AS text, {_WORDS} AS w FROM {{docs}}),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM words)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
windows AS (
  SELECT doc_id, i, list_slice(w, i, i + 7) AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM words WHERE len(w) >= 8)),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
covered AS (SELECT doc_id, sum(least(8, coalesce(nx - i, 8))) AS n_repeat_words
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nx FROM again) GROUP BY doc_id),
measured AS (
  SELECT doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    len(w) < 20 OR 100 * coalesce(n_repeat_words, 0) > 30 * len(w) AS base_failed
  FROM words LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
hosts AS (SELECT source, count(*) AS n, {', '.join(f'sum(({c})::INT) AS f_{r}' for r, c in _RULES.items())}
  FROM measured WHERE source IS NOT NULL GROUP BY source),
sums AS (SELECT {', '.join(f'sum(f_{r}) / sum(n) AS p_{r}, avg((f_{r} / n) ** 2) - avg(f_{r} / n) ** 2 AS v_{r}' for r in _RULES)} FROM hosts),
prior AS (SELECT {', '.join(f'p_{r}, CASE WHEN v_{r} > 0 THEN least(greatest(p_{r} * (1 - p_{r}) / v_{r} - 1, 2), 1e6) ELSE 1e6 END AS k_{r}' for r in _RULES)} FROM sums),
bad AS (SELECT source FROM hosts, prior WHERE {' OR '.join(f'(f_{r} + p_{r} * k_{r}) / (n + k_{r}) > 0.5' for r in _RULES)}),
judged AS (
  SELECT *, NOT base_failed AND (source IS NULL OR source NOT IN (SELECT source FROM bad)) AS kept FROM measured)
"""
ORACLE["op9_quality_rules"] = f"""
WITH {MEASURE_SQL.format(docs="documents")}
SELECT doc_id, {', '.join(qr.MEASURES)}, base_failed, kept FROM judged
"""


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line counts, dropped lines and the digest of what stays, for all documents."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.dedup_lines(docs, n_lines="n_lines", n_dropped="n_dropped")
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


#: kept lines of every document; {docs} has doc_id, text
LINES_SQL = r"""
split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM {docs}),
placed AS (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM split),
keyed AS (
  SELECT doc_id, i, ls[i] AS line,
    translate(trim(ls[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM placed),
frequent AS (SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT keyed.*, frequent.k IS NOT NULL AS gone FROM keyed LEFT JOIN frequent USING (k))
"""
ORACLE["op10_line_dedup"] = f"""
WITH {LINES_SQL.format(docs="documents")}
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents and the text decoded from them, as digests."""
    return bpe.round_trip(read(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of all documents."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = token_counts.count_tokens(docs, tokenizer_file("word_bpe_49k.json"))
    return out.withColumn("over_limit", F.col("n_tokens") > token_counts.MAX_TOKENS)


@query
def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids written to a store, and what is read back from it."""
    folder = scratch_folder(spark, "token-store")
    token_store.write_store(read(spark, sf_dir, "documents"), folder, tokenizer_file("byte_bpe_50k.json"), end_id=2)
    return token_store.read_digests(spark, folder)


@query
def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and links of all documents, on five-word shingles at a similarity of 0.8."""
    found = ngram_jaccard.classes(read(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "class_id", F.lower(F.hex("text")).alias("text_id"), "n_copies", "n_linked_texts", "n_links")


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The places of all documents that hold a benchmark item with at most one edit in ten characters."""
    return decontaminate.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, learned from three quarters of them."""
    docs = read(spark, sf_dir, "documents").select("doc_id", (language_id.fold(F.col("doc_id")) == 2).alias("held_out"), "text", "lang")
    model = language_id.train(docs.where(~F.col("held_out")))
    return language_id.predict(docs.select("doc_id", "held_out", "text"), model)


@query
def op8_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence of all documents, as files of a tree: source, then thousands, hundreds and tens of ids.

    A document of which a notice is a tenth of the lines or more states the licence of its directory.
    """
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    steps = [F.floor(F.col("doc_id") / n).cast("string") for n in (1000, 100, 10, 1)]
    files = docs.select("doc_id", F.concat_ws("/", F.coalesce("source", F.lit("none")), *steps).alias("path"), "text")
    return licence_scan.scan(files, is_licence_file=F.lit(False), lines_per_notice=10).drop("path")


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, their near words, forms and roots."""
    return spelling_variants.group_variants(spelling_variants.words(read(spark, sf_dir, "documents").select("doc_id", "text")))


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight whitened components of every vector, scaled to integers; raises if a deviation is too large for a long."""
    k = 8
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    vectors = vectors.where(whitening.finite(F.col("embedding"))).select(
        "vec_id", F.transform("embedding", lambda c: F.floor(1024 * c.cast("double")) + 100000).alias("x"))
    vectors = whitening.usable(vectors, "x")
    model = whitening.fit(vectors, "x")
    rows = scratch_table(whitening.whiten(vectors, model, "x", k), "whitened")
    error = whitening.identity_error(rows, model, k)
    sums = F.array(*[F.lit(s).cast("long") for s in model.sums]).cast("array<bigint>")
    n = F.lit(model.n).cast("long")
    deviation = F.aggregate(F.zip_with("x", sums, lambda x, s: n * x - s), F.lit(0).cast("long"), lambda acc, d: acc + d * d)
    shares = F.array(*[F.lit(float(v / model.trace) if model.trace else None).cast("double") for v in model.values[:k]]).cast("array<double>")
    out = rows.select("vec_id", deviation.alias("deviation"), F.posexplode("whitened").alias("at", "whitened"))
    return out.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), n.alias("n"), "deviation", "whitened",
                      F.get(shares, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))


@query
def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of all documents: counts of the base kinds, their digest, and all spans."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = personal_data.find_personal_data(docs)
    base = [k.name for k in personal_data.KINDS if k.base]
    count = lambda name: F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")
    own = F.filter("spans", lambda s: s["kind"].isin(base))
    return out.select("doc_id", *[count(b) for b in base], F.sha2(personal_data.as_text(own), 256).alias("base_sha256"),
                      personal_data.as_text(F.col("spans")).alias("spans"))


#: kind, whether it is a base kind, pattern, what a match x must meet (d its digits, own its checksum's remainder), score without and with context, context
_PERSONAL = [
    ("email", True, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true", 0.8, "mail|contact|write to"),
    ("ip", True, r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
     "len(list_filter(string_split(x, '.'), lambda s: len(ltrim(s, '0')) > 3 OR coalesce(try_cast(ltrim(s, '0') AS INT), 0) > 255)) = 0", 0.6, "address|host|server|login"),
    ("card", True, r"[0-9](?:[\x20-]?[0-9])+", "len(d) BETWEEN 16 AND 19 AND luhn", 0.7, "card"),
    ("phone", True, r"\+[0-9][\x20().0-9-]+[0-9]", "len(d) BETWEEN 8 AND 15", 0.6, "phone"),
    ("iban", False, r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}\b", "len(c) BETWEEN 15 AND 34 AND mod97 = 1", 0.7, "iban"),
    ("ssn", False, r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", "NOT regexp_matches(x, '^(?:000|666|9)|-00-|-0000$')", 0.3, r"\bssn\b|social security|tax id"),
    ("shortcard", False, r"[0-9](?:[\x20-]?[0-9])+", "len(d) BETWEEN 13 AND 15 AND luhn", 0.45, "card|amex|credit|debit|karte|tarjeta|carte"),
]
_CUT = " UNION ALL ".join(
    f"SELECT doc_id, '{kind}' AS kind, {k} AS k, regexp_extract_all(text, '{p}') AS m, string_split_regex(text, '{p}') AS p FROM texts" for k, (kind, _, p, *_) in enumerate(_PERSONAL))
_TOLD = " ".join(f"WHEN '{kind}' THEN {test} AND ({base} OR {own} + CASE WHEN regexp_matches(near, '{context}') THEN 0.3 ELSE 0 END >= 0.5)"
                 for kind, base, _, test, own, context in _PERSONAL)
ORACLE["op13_personal_data"] = rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
cut AS ({_CUT}),
placed AS (SELECT doc_id, kind, k, m, p, unnest(range(1, len(m) + 1)) AS i FROM cut),
found AS (
  SELECT doc_id, kind, k, m[i] AS x,
    list_sum(list_transform(p[1:i], lambda s: length(s))) + coalesce(list_sum(list_transform(m[1:i-1], lambda s: length(s))), 0) AS start,
    lower(right(p[i], 40) || chr(10) || left(p[i + 1], 40)) AS near, regexp_replace(m[i], '[^0-9]', '', 'g') AS d, replace(m[i], ' ', '') AS c
  FROM placed),
checked AS (
  SELECT *, list_sum(list_transform(range(len(d)), lambda j: CASE WHEN j % 2 = 0 THEN d[len(d) - j]::INT ELSE (2 * d[len(d) - j]::INT) // 10 + (2 * d[len(d) - j]::INT) % 10 END)) % 10 = 0 AS luhn,
    CASE WHEN kind = 'iban' THEN list_reduce(list_concat([0], list_transform(string_split(c[5:] || c[:4], ''), lambda s: CASE WHEN s BETWEEN '0' AND '9' THEN ascii(s) - 48 ELSE ascii(s) - 55 END)),
      lambda a, v: CASE WHEN v > 9 THEN (a * 100 + v) % 97 ELSE (a * 10 + v) % 97 END) END AS mod97
  FROM found),
spans AS (SELECT doc_id, kind, k, start, kind || ':' || start::BIGINT || ':' || (start + length(x))::BIGINT AS s FROM checked WHERE CASE kind {_TOLD} END),
told AS (
  SELECT doc_id, {', '.join(f"count(*) FILTER (WHERE kind = '{kind}') AS n_{kind}" for kind, base, *_ in _PERSONAL if base)},
    string_agg(s, ',' ORDER BY k, start) FILTER (WHERE k < 4) AS base, string_agg(s, ',' ORDER BY k, start) AS spans
  FROM spans GROUP BY doc_id)
SELECT doc_id, {', '.join(f"coalesce(n_{kind}, 0)::BIGINT AS n_{kind}" for kind, base, *_ in _PERSONAL if base)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN told USING (doc_id)
"""
