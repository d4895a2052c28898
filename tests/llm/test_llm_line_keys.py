"""Line deduplication computes each line's key once and compares no pairs of lines."""

from collections import defaultdict

from pyspark.sql import functions as F

from shardfold.llm import line_dedup

BLANKS = " \t\n\v\f\r"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_a_key_is_computed_once(spark):
    docs = spark.range(1).select(F.col("id").alias("doc_id"), F.concat(F.lit("É A\n"), F.col("id").cast("string")).alias("text"))
    plan = docs.select(line_dedup._keys(F.col("text"), 1).alias("k"))._jdf.queryExecution().optimizedPlan().toString()
    # once for ASCII texts and once for others, which exclude each other
    assert plan.count("translate(") == 1 and plan.count("lower(") == 1 and plan.count("trim(") == 1


def test_lines_of_a_document_are_not_compared_in_pairs(spark):
    docs = spark.createDataFrame([(1, "a\nb\nA\n a\nb"), (2, None), (3, "")], "doc_id long, text string")
    assert "array_distinct" not in line_dedup.frequent_lines(docs)._jdf.queryExecution().optimizedPlan().toString()
    own = docs.select("doc_id", line_dedup._different(line_dedup._keys(F.col("text"), 1)).alias("k"))
    assert {r.doc_id: (len(r.k), len(set(r.k))) for r in own.collect()} == {1: (2, 2), 2: (0, 0), 3: (0, 0)}


def test_odd_lines_equal_brute_force(spark):
    lines = ["É", "é", "É A", "É a", "K", "k", "K", "İx", "ΑΣ", "ας", " \t\v\f\r", "", "\xa0a", "a", " B", " b\r", "B", "\x1cB", "日本 X", "日本 x", "😀Z", "😀z", "same Line\t", "\tSAME line"]
    texts = [None, "", "\n", *["\n".join(lines[k:k + 5] + lines[k:k + 1]) for k in range(len(lines))], *["\n".join(lines[k::3]) for k in range(3)]]
    key = lambda x: x.strip(BLANKS).translate(FOLD)
    split = [(t or "").split("\n") for t in texts]
    for min_docs, min_chars in ((2, 1), (7, 1), (8, 2)):
        holders = defaultdict(set)
        for i, ls in enumerate(split):
            for x in ls:
                holders[key(x)].add(i)
        gone = {k for k, ids in holders.items() if len(k) >= min_chars and len(ids) >= min_docs}
        want = {i: (len(ls), sum(key(x) in gone for x in ls), "\n".join(x for x in ls if key(x) not in gone)) for i, ls in enumerate(split)}
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        got = line_dedup.dedup_lines(docs, min_docs=min_docs, min_chars=min_chars, n_lines="n", n_dropped="d").collect()
        assert {r.doc_id: (r.n, r.d, r.text or "") for r in got} == want
