"""Licence scan: notices by TF-IDF cosine to templates, then inheritance along the path.

Templates are titles, notices, paragraphs and short licences as a whole
(:mod:`.licence_texts`).  A file's own licence is read from its lines, its
paragraphs and its whole text.  Each is compared with the templates by the
cosine of sparse TF-IDF vectors; the best template counts from ``min_score``
on.  A term that occurs tf times counts 1 + log(tf) times, so that a long text
isn't judged by its articles.  Document frequencies of the templates' terms
are taken over all files; a term that no template has weighs as much as the
rarest.

No keyword decides what is compared.  A unit is left out only where its
cosine can't come to ``min_score`` for any template: first by a pattern of the
terms without which no template comes to it, then by a bound from the norm of
the template's shared terms and the weight of the unit's other terms.

A licence file covers its directory and what lies below.  A file without a
notice of its own takes the licence of the nearest ancestor directory that
has one.  Directories are joined with their ancestors once, however many
files they hold.

Native joins and aggregates.  Counts are partial on the map side.  Joins on
directories go through :func:`attach`: the directories that cover most are
broadcast (a fixed number of rows), the others are joined by key.

Defined cases: null text has no notice and can inherit; a null path neither
inherits nor covers anything; a licence file takes its own licence only from
its notice; several notices: the highest score, then the first licence by
name, but reserved rights (which stand above many a grant) only if nothing else
is declared, and a licence whose paragraphs stand in a longer one (two and
three clauses of BSD) only if that isn't declared too; several licence files in
a directory: the same; each row is a file, so repeated rows are reported each;
an empty table gives an empty table; other columns pass through, but for
those named like an added one, which takes their place.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import attach, fresh, hash128, let, scratch_table
from .licence_texts import EXTENDS, RESERVED, TEMPLATES

MIN_SCORE = 0.6
#: names of files that state the licence of their directory
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|copyright|unlicense|notice)([-._][^/]*)?$"


def terms(text: Column) -> Column:
    """Words and version numbers, lower-cased."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([a-z0-9]+(?:[.][0-9]+)*)"), F.lit(1))


def _tf() -> Column:
    return (1 + F.log(F.count("*"))).alias("tf")


def template_terms(spark, templates: dict[str, list[str]]) -> DataFrame:
    """(template, licence, term, tf): a fixed, small table."""
    rows = [(k, licence, text) for k, (licence, text) in enumerate((l, t) for l, ts in templates.items() for t in ts)]
    table = spark.createDataFrame(rows, "template int, licence string, t string")
    return table.select("template", "licence", F.explode(terms(F.col("t"))).alias("term")).groupBy("template", "licence", "term").agg(_tf())


def idf(files: DataFrame, words: list[str], text_col: str) -> tuple[DataFrame, float, dict[str, int]]:
    """(term, idf) of the templates' terms over all files, the weight of any other term, and the files that hold each."""
    vocabulary = F.split(F.lit(" ".join(words)), " ")
    own = F.array_append(F.array_intersect(terms(F.coalesce(F.col(text_col), F.lit(""))), vocabulary), F.lit(""))
    seen = files.select(F.explode(own).alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()  # one row per term of the templates
    df = {r.term: r.df for r in seen}
    n = df.pop("", 0)
    rest = F.lit(float(n + 1))
    spark = files.sparkSession
    table = spark.createDataFrame([(w, df.get(w, 0)) for w in words], "term string, df bigint")
    top = spark.range(1).select((F.log(rest) + 1).alias("x")).first().x
    return table.select("term", (F.log(rest / (F.col("df") + 1)) + 1).alias("idf")), top, df


def needed_terms(vectors: dict[int, dict[str, float]], min_score: float, common: dict[str, int] | None = None) -> list[str]:
    """Terms of which a text has at least one if its cosine to some template (term to normed weight) is ``min_score`` or more.

    Of each template those that the fewest files hold (``common``), the
    heaviest first, until the norm of the others is lower.
    """
    out = set()
    for weights in vectors.values():
        left = sum(w * w for w in weights.values())
        for term, w in sorted(weights.items(), key=lambda x: ((common or {}).get(x[0], 0), -x[1], x[0])):
            if left < _least(min_score):
                break
            out.add(term)
            left -= w * w
    return sorted(out)


def _least(min_score: float) -> float:
    """The square of ``min_score``, less what rounding may take from a score."""
    return max(min_score - 1e-6, 0.0) ** 2


def _any_of(words: list[str]) -> str:
    """A pattern of ``words`` that parts after each character, so that a text is not held against one word after the other."""
    by: dict[str, list[str]] = {}
    for w in words:
        by.setdefault(w[:1], []).append(w[1:])
    end = by.pop("", None)
    parts = [re.escape(c) + (re.escape(rest[0]) if len(rest) == 1 else _any_of(rest)) for c, rest in sorted(by.items())]
    return f"(?:{'|'.join(parts)})" + ("?" if end else "") if parts else ""


def _pattern(words: list[str]) -> str:
    """Matches any lower-cased text of which one of ``words`` is a term (a number in front of a term may end within a word)."""
    return "|".join(
        f"(?<!{start}){_any_of(some)}(?!{end})"
        for start, end, some in (("[a-z]", "[a-z0-9]", [w for w in words if not w[0].isdigit() and "." not in w]),
                                 ("[a-z]", "[0-9]", [w for w in words if not w[0].isdigit() and "." in w]),
                                 ("[a-z0-9]", "[a-z0-9]", [w for w in words if w[0].isdigit() and "." not in w]),
                                 ("[a-z0-9]", "[0-9]", [w for w in words if w[0].isdigit() and "." in w])) if some) or "(?!)"


def _sql_terms(weights: dict[str, float]) -> str:
    # terms are words and numbers, so need no quoting; SQL text is folded to a literal and takes one call
    return "array(" + ", ".join(f"named_struct('term', '{t}', 'w2', {w * w!r}D)" for t, w in sorted(weights.items())) + ")"


def _near(text: Column, vectors: dict[int, dict[str, float]], weight: dict[str, float], other: float, min_score: float) -> Column:
    """Whether ``text`` may come to ``min_score``.

    The cosine is at most the norm of the template's shared terms, times the
    share of the text's own norm that terms of any template can have: each of
    them occurs at most as often as the text repeats terms, and each other
    term weighs ``other`` or more.
    """
    table = F.expr(f"array({', '.join(_sql_terms(v) for v in vectors.values())})")
    known = F.expr(_sql_terms(weight))
    words = F.split(F.lit(" ".join(sorted(weight))), " ")

    def norm2(terms_of, own):
        return F.aggregate(terms_of, F.lit(0.0), lambda norm, x: norm + F.when(F.array_contains(own, x["term"]), x["w2"]).otherwise(0.0))

    def test(found, own):
        distinct = F.size(F.array_distinct(found))
        mine = F.pow(1 + F.log(F.size(found) - distinct + 1.0), 2) * norm2(known, own)
        rest = (distinct - F.size(own)) * other ** 2
        return let(mine / (mine + rest), lambda share: F.exists(table, lambda v: norm2(v, own) * share >= _least(min_score)))

    return let(terms(text), lambda found: let(F.array_intersect(found, words), lambda own: (F.size(own) > 0) & test(found, own)))


def _lines(text: Column) -> Column:
    """The lines of a text that aren't blank."""
    return F.filter(F.split(text, r"\n", -1), lambda x: F.trim(x) != "")


def _units(text: Column, near) -> Column:
    """(t, line, n): the lines of a text, its paragraphs of more than one line and the whole of it, so far as ``near`` says that they may declare a licence."""
    lines = F.filter(_lines(text), near)
    blocks = F.filter(F.array_distinct(F.concat(F.split(text, r"\n[ \t\r]*\n", -1), F.array(text))), lambda x: x.contains("\n") & near(x))
    return F.concat(F.transform(lines, lambda x: F.struct(x.alias("t"), F.lit(True).alias("line"), F.lit(1).alias("n"))),
                    F.transform(blocks, lambda x: F.struct(x.alias("t"), F.lit(False).alias("line"), F.size(_lines(x)).alias("n"))))


def _rank() -> Column:
    return F.struct((F.col("licence") == RESERVED).alias("r"), (-F.col("score")).alias("s"), "licence")


def _best() -> Column:
    return F.min(_rank())


def _chosen(told: Column) -> Column:
    """The best of a file's licences (an array of ranks, one for each licence), without those that another one extends."""
    names = F.transform(told, lambda x: x["licence"])
    extended = F.array_compact(F.array(*[F.when(F.array_contains(names, longer), shorter) for longer, shorter in EXTENDS.items()], F.lit(None).cast("string")))
    return F.array_min(F.filter(told, lambda x: ~F.array_contains(extended, x["licence"])))


def own_licences(files: DataFrame, text_col: str = "text", keys: tuple[str, str] = ("__ls_1", "__ls_2"),
                 templates: dict[str, list[str]] = TEMPLATES, min_score: float = MIN_SCORE) -> DataFrame:
    """(keys, licence, score, notices) of the files that declare a licence; ``notices`` is the number of lines that do."""
    spark = files.sparkSession
    vectors = template_terms(spark, templates)
    words = sorted(r.term for r in vectors.select("term").distinct().collect())
    weight, other, common = idf(files, words, text_col)
    weighted = vectors.join(F.broadcast(weight), "term").withColumn("w", F.col("tf") * F.col("idf"))
    norms = weighted.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    weighted = weighted.join(norms, "template").select("licence", "template", "term", (F.col("w") / F.col("norm")).alias("tw"))
    normed: dict[int, dict[str, float]] = {}
    for r in weighted.collect():  # the templates' terms
        normed.setdefault(r.template, {})[r.term] = r.tw
    text = F.col(text_col)
    pattern = _pattern(needed_terms(normed, min_score, common))
    weights = {r.term: r.idf for r in weight.collect()}  # the templates' terms

    def near(x):
        return F.lower(x).rlike(pattern) & _near(x, normed, weights, other, min_score)

    units = (files.where(F.lower(text).rlike(pattern)).select(*keys, F.posexplode(_units(text, near)).alias("unit", "u")))
    of = [*keys, "unit", "line", "n"]
    units = (units.select(*keys, "unit", "u.line", "u.n", F.explode(terms(F.col("u.t"))).alias("term")).groupBy(*of, "term").agg(_tf()))
    units = units.join(F.broadcast(weight), "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(other)))
    units = scratch_table(units.select(*of, "term", "w"), "notices")
    length = units.groupBy(*of).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = units.join(F.broadcast(weighted), "term").groupBy(*of, "licence", "template").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    scores = dots.join(length, of).withColumn("score", F.round(F.col("dot") / F.col("norm"), 9)).where(F.col("score") >= min_score)
    # the licence of each unit, then of each licence the best unit (few rows for a file), then the file's
    told = scores.groupBy(*of).agg(_best().alias("b")).groupBy(*keys, "b.licence").agg(
        F.min("b").alias("b"), F.sum(F.when(F.col("line"), 1).otherwise(0)).alias("lines"), F.max(F.when(F.col("line"), 0).otherwise(F.col("n"))).alias("block"))
    best = told.groupBy(*keys).agg(F.collect_list("b").alias("told"), F.greatest(F.sum("lines"), F.max("block")).alias("notices")).withColumn("b", _chosen(F.col("told")))
    return best.select(*keys, F.col("b.licence").alias("licence"), (-F.col("b.s")).alias("score"), "notices")


def directory(path: Column) -> Column:
    """The path without its last part; a file at the top lies in the empty directory."""
    parts = F.split(path, "/", -1)
    return let(parts, lambda p: F.array_join(F.slice(p, F.lit(1), F.size(p) - 1), "/"))


def ancestors(path: Column) -> Column:
    """A directory, the one above it, and so on up to the empty one."""
    parts = F.when(path == "", F.array().cast("array<string>")).otherwise(F.split(path, "/", -1))
    return let(parts, lambda p: F.transform(F.sequence(F.lit(0), F.size(p)), lambda n: F.array_join(F.slice(p, F.lit(1), n), "/")))


def nearest(dirs: DataFrame, covering: DataFrame) -> DataFrame:
    """(dir, licence, from_dir): for each of ``dirs`` (dir, files) the nearest ancestor in ``covering`` (dir, licence)."""
    up = dirs.select("dir", F.explode(ancestors(F.col("dir"))).alias("above"))
    below = up.groupBy("above").agg(F.count("*").alias("weight"))
    heads = scratch_table(covering.withColumnRenamed("dir", "above").join(below, "above"), "covering")
    found = attach(up, heads.select("above", "weight", "licence"), "above", "weight", F.xxhash64("dir")).where("licence IS NOT NULL")
    return (found.groupBy("dir").agg(F.max(F.struct(F.length("above").alias("n"), "above", "licence")).alias("b"))
            .select("dir", F.col("b.licence").alias("licence"), F.col("b.above").alias("from_dir")))


def scan(files: DataFrame, path_col: str = "path", text_col: str = "text", is_licence_file: Column | None = None,
         templates: dict[str, list[str]] = TEMPLATES, min_score: float = MIN_SCORE, lines_per_notice: int = 0) -> DataFrame:
    """``files`` without ``text_col``, with ``licence``, ``score`` (of its own notice), ``origin``
    (``own``, ``inherited`` or ``none``) and ``from_dir`` (of an inherited licence).

    A licence file is one by ``is_licence_file``, or by having ``lines_per_notice`` lines or fewer for each line of a notice.
    """
    files = fresh(files, ["licence", "score", "origin", "from_dir", "__ls_1", "__ls_2", "__ls_dir", "__ls_up", "__ls_own", "__ls_lines", "__ls_notices"], [path_col, text_col])
    k1, k2 = hash128(F.col(path_col), F.col(text_col))
    keyed = files.withColumns({"__ls_1": k1, "__ls_2": k2})
    own = own_licences(keyed, text_col, templates=templates, min_score=min_score).withColumnRenamed("notices", "__ls_notices")
    own = scratch_table(own, "own-licences")
    is_file = F.col(path_col).rlike(LICENCE_FILE) if is_licence_file is None else is_licence_file
    listed = keyed.withColumn("__ls_own", F.coalesce(is_file, F.lit(False))).withColumn("__ls_dir", directory(F.col(path_col)))
    listed = listed.withColumn("__ls_lines", F.size(_lines(F.col(text_col))) if lines_per_notice else F.lit(1)).drop(text_col)
    stated = F.coalesce(lines_per_notice * F.col("__ls_notices") >= F.col("__ls_lines"), F.lit(False))
    listed = scratch_table(listed.join(own, ["__ls_1", "__ls_2"], "left").withColumn("__ls_own", F.col("__ls_own") | stated).drop("__ls_notices", "__ls_lines"), "files")
    covering = (listed.where("__ls_own AND licence IS NOT NULL AND __ls_dir IS NOT NULL").groupBy(F.col("__ls_dir").alias("dir"))
                .agg(_best().alias("b")).select("dir", F.col("b.licence").alias("licence")))
    dirs = scratch_table(listed.where("__ls_dir IS NOT NULL").groupBy(F.col("__ls_dir").alias("dir")).agg(F.count("*").alias("files")), "directories")
    above = nearest(dirs, covering).join(dirs, "dir").select(F.col("dir").alias("__ls_dir"), "files", F.col("licence").alias("__ls_up"), "from_dir")
    out = attach(listed, scratch_table(above, "inherited"), "__ls_dir", "files", F.xxhash64("__ls_1", "__ls_2"))
    up = F.col("licence").isNull() & F.col("__ls_up").isNotNull()
    return out.select(*[c for c in files.columns if c != text_col], F.coalesce("licence", "__ls_up").alias("licence"), "score",
                      F.when(F.col("licence").isNotNull(), "own").when(up, "inherited").otherwise("none").alias("origin"),
                      F.when(up, F.col("from_dir")).alias("from_dir"))
