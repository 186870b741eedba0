import json

import pytest
from pyspark.sql import functions as F

from quarryloom.functions import text as T
from quarryloom.functions import vectors as V
from quarryloom.operators import encoders, ground_truth, mining, order, ranking, retrieval, rings, statistics
from quarryloom.sources import crawl, readers, writers
from quarryloom.streaming import events as stream


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_text_functions(spark):
    assert one(spark, T.url_slug(F.lit("https://a.b/c/Page.html?q=1#x"))) == "Page" and one(spark, T.url_slug(F.lit("https://a.b/"))) == "index"
    assert one(spark, T.repo_parts(F.lit("https://h/o/r.git"))).asDict() == {"owner": "o", "repo": "r", "branch": "main", "subpath": ""}
    assert one(spark, T.strip_numbering(F.lit("3.2 Example"))) == "Example" and one(spark, T.strip_numbering(F.lit("IV. Rome"))) == "Rome"
    assert one(spark, T.segments(F.lit("A > b >  > C "))) == ["a", "b", "c"]
    assert one(spark, T.sentinel_to_null(F.lit("False"))) is None
    assert one(spark, T.matches_spec(F.lit("The Cache fails"), "cache", ("fails",), ("x", "the"))) is True and one(spark, T.matches_spec(F.lit("a"))) is False
    assert one(spark, T.human_size(F.lit(1536))) == "1.5 KB" and one(spark, T.format_seconds(F.lit(75.0))) == "1m 15s"
    assert one(spark, T.model_parts(F.lit("local:m:1"))).asDict() == {"backend": "local", "model": "m:1"}
    assert one(spark, T.shares_scope(T.segments(F.lit("a > b > c")), T.segments(F.lit("a > b > d")))) is True


def test_vector_functions(spark):
    a = F.array(F.lit(3.0), F.lit(4.0))
    assert one(spark, V.norm(a)) == 5.0 and abs(one(spark, V.cosine(a, a)) - 1) < 1e-12
    assert one(spark, V.cosine(a, F.array(F.lit(1.0)))) is None and one(spark, V.cosine(a, F.array(F.lit(0.0), F.lit(0.0)))) == 0.0
    assert one(spark, V.parse(F.lit("[1, 2.5 3]"))) == [1.0, 2.5, 3.0] and one(spark, V.parse(F.lit("[1, x]"))) is None
    assert one(spark, V.bucket_size(F.lit(85))) == 88 and one(spark, V.bucket_size(F.lit(16))) == 16
    assert one(spark, V.valid(F.array(F.lit(1.0), F.lit(float("nan"))), 2)) is False and one(spark, V.valid(F.lit(None).cast("array<float>"), 2)) is False


def test_order_operators_match_python(spark):
    rows = [(f"i{n:03d}", "f" if n % 3 else "g", (n * 7) % 50) for n in range(50)]
    df = spark.createDataFrame(rows, "id string, filename string, pos bigint")
    ids = [r[0] for r in sorted(rows, key=lambda r: (r[2], r[0]))]
    got = {r.id: (r.prev, r.next) for r in order.link_prev_next(df, "corpus").collect()}
    assert got == {x: (ids[i - 1] if i else None, ids[i + 1] if i + 1 < len(ids) else None) for i, x in enumerate(ids)}
    assert {r.id: r.n for r in order.enumerate_rows(df, ["pos", "id"], "n").collect()} == {x: i + 1 for i, x in enumerate(ids)}
    split = ranking.split_rows(df, ["filename"], "id", 0.8).collect()
    for f in "fg":
        own = [r for r in split if r.filename == f]
        assert sum(r.split == "train" for r in own) == int(len(own) * 0.8)
    assert order.enumerate_rows(df.limit(0), ["id"], "n").count() == 0


def test_trimmed_mean(spark):
    values = [1.0, 2.0, 2.0, 3.0, 100.0, None]
    df = spark.createDataFrame([("a", v) for v in values], "k string, v double")
    assert abs(statistics.trimmed_mean(df, ["k"], "v", 0.2).first().trimmed - 7 / 3) < 1e-9


def test_balance_keeps_largest_remainder_shares(spark):
    df = spark.createDataFrame([(f"{c}{i}", c) for c, n in (("a", 50), ("b", 30), ("c", 100), ("d", 9)) for i in range(n)], "id string, c string")
    got = {r.c: r["count"] for r in mining.balance(df, "c", {"a": 0.25, "b": 0.35, "c": 0.4}, ["id"]).groupBy("c").count().collect()}
    assert got == {"a": 21, "b": 30, "c": 34}
    assert mining.balance(df, "c", {"a": 0.5, "zzz": 0.5}, ["id"]).count() == df.count()


def test_mining_and_metrics(spark):
    rows = [(f"n{i}", i, f"f{i % 2}", f"n{i - 1}" if i % 4 else None, "ab"[i % 2], ["h" + str(i % 2), f"s{i % 3}"], f"H{i}", ["w", f"x{i % 5}"], "h" + str(i % 2)) for i in range(40)]
    c = spark.createDataFrame(rows, "id string, pos bigint, filename string, parent_id string, category string, path array<string>, heading string, words array<string>, top string").withColumn("chunk_type", F.lit("heading"))
    assert mining.parent_child(c).count() == 30
    assert mining.pairs_within(c, F.col("filename"), 3, "x").count() == 6
    tops = {r[0]: r[-1] for r in rows}
    easy = mining.easy_negatives(c, c).collect()
    assert len(easy) == 40 and all(tops[r.anchor] != tops[r.negative] for r in easy)
    medium = mining.medium_negatives(c, c).collect()
    assert medium and all(tops[r.anchor] == tops[r.negative] and r.anchor != r.negative for r in medium)
    hard = mining.hard_negatives(c, c).collect()
    assert {r.anchor for r in hard} == set(tops) and all(tops[r.anchor] == tops[r.negative] for r in hard) and max(r.choice for r in hard) == mining.CHOICES
    lone = c.where("id = 'n0'")
    assert mining.easy_negatives(lone, lone).count() == 0 and mining.medium_negatives(lone, lone).count() == 0 and mining.hard_negatives(lone, lone).count() == 0
    assert mining.easy_negatives(c.limit(0), c.limit(0)).count() == 0
    pairs = mining.parent_child(c)
    extra = mining.negative_pairs(pairs, c).collect()
    assert len(extra) == 60 and all(r.negative not in (r.anchor, r.positive) for r in extra)
    mix = mining.same_source_mix(pairs, c).collect()
    assert all(r.same_taken + r.cross_taken + r.backfilled == r.pairs for r in mix)
    p = spark.createDataFrame([("e", "q", "a", 1, 0.9), ("e", "q", "b", 0, 0.1), ("e", "q2", "a", 1, None), ("e", "q2", "b", 0, 0.5), ("e", "q3", "a", 0, 0.5)], "difficulty string, query_id string, candidate_id string, label int, s double")
    m = retrieval.ranking_metrics(p, "s").first()
    assert (m.queries, m.pairs, m.top1, m.mrr, m.pair_accuracy) == (2, 4, 0.5, 0.75, 0.5)


def test_bm25_against_formula(spark):
    import math

    docs = spark.createDataFrame([(1, "a b a"), (2, "b c"), (3, None)], "d bigint, t string")
    q = spark.createDataFrame([(7, "a b b")], "q bigint, t string")
    got = {r.doc: r.score for r in retrieval.bm25(q, docs, "q", "t", "d", "t").collect()}
    n, avg = 3, 5 / 3
    idf = lambda df: math.log(1 + (n - df + 0.5) / (df + 0.5))
    w = lambda tf, dl: tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avg))
    assert abs(got[1] - (idf(1) * w(2, 3) + 2 * idf(2) * w(1, 3))) < 1e-9 and abs(got[2] - 2 * idf(2) * w(1, 2)) < 1e-9 and 3 not in got


def test_first_fitting_goes_round_the_ring(spark):
    """Against a full scan, with a condition that few rows fit."""
    rows = spark.createDataFrame([(f"i{n:03d}", "g" if n < 150 else "h", n % 97) for n in range(200)], "id string, scope string, x int")
    r = rings.ring(rows, "scope").cache()
    got = {a.anchor: (a.negative, a.tier) for a in rings.first_fitting(r, r, "scope", lambda a, c: F.when(F.col(f"{c}.x") == 5, 1).when(F.col(f"{c}.x") > 90, 2)).collect()}
    place = {x.id: x for x in r.collect()}
    assert sorted(x.rn for x in place.values() if x.scope == "g") == list(range(1, 151))
    for a in place.values():
        fits = [((1 if c.x == 5 else 2), (c.rn - a.rn) % a.n, c.id) for c in place.values() if c.scope == a.scope and c.id != a.id and (c.x == 5 or c.x > 90)]
        assert got.get(a.id) == ((min(fits)[2], min(fits)[0]) if fits else None)


def test_top_k_in_tasks_equals_all_scores(spark):
    import random

    rng = random.Random(2)
    word = lambda: f"w{int(rng.expovariate(0.3))}"
    docs = spark.createDataFrame([(n, " ".join(word() for _ in range(rng.randrange(12))) or None) for n in range(300)] + [(900 + n, "w1 w2") for n in range(9)], "d bigint, t string").repartition(5)
    q = spark.createDataFrame([(n, " ".join(word() for _ in range(4))) for n in range(30)] + [(99, None), (98, "nowhere")], "q bigint, t string")
    want = retrieval.top_k(retrieval.bm25(q, docs, "q", "t", "d", "t").withColumn("score", F.round("score", 6)), 4)
    got = retrieval.bm25_top_k(q, docs, "q", "t", "d", "t", 4, block=7)
    key = lambda df: {(r.query, r.doc, r["rank"], r.score) for r in df.collect()}
    assert key(got) == key(want)
    assert retrieval.bm25_top_k(q.limit(0), docs, "q", "t", "d", "t", 4).count() == 0 and retrieval.bm25_top_k(q, docs.limit(0), "q", "t", "d", "t", 4).count() == 0
    vectors = [(n, [rng.gauss(0, 1) for _ in range(5)]) for n in range(60)] + [(70, [0.0] * 5), (71, None), (72, [1.0, 0.0, 0.0, 0.0, 0.0]), (73, [2.0, 0.0, 0.0, 0.0, 0.0])]
    v = spark.createDataFrame(vectors, "i bigint, v array<double>").repartition(3)
    near = {(r.query, r["rank"]): r.doc for r in retrieval.dense_top_k(v.where("i % 3 = 0"), v, "i", "v", "i", "v", 3, block=8).collect()}
    full = {i: x for i, x in vectors if x and any(x)}
    cos = lambda a, b: round(sum(x * y for x, y in zip(a, b, strict=True)) / (sum(x * x for x in a) * sum(x * x for x in b)) ** 0.5, 6)
    for i in (n for n in full if n % 3 == 0):
        assert [near[i, k] for k in (1, 2, 3)] == [j for _, j in sorted((-cos(full[i], full[j]), j) for j in full if j != i)[:3]]


def test_filters_with_several_clauses(spark):
    spec = "array<struct<field:string,fields:array<string>,contains:string,contains_all:array<string>,contains_any:array<string>,max_matches:int>>"
    rows = [("a", [(None, ["heading", "content"], "cache", None, ["open", "shut"], None)]), ("b", [("content", None, "", ["x", "y"], None, 1)]), ("c", [("content", None, " ", None, None, 5), ("nofield", None, "cache", None, None, 5)]), ("d", [(None, None, "sum", None, None, None)])]
    q = spark.createDataFrame([(i, None, f) for i, f in rows], f"query_id string, positives array<string>, positive_filters {spec}")
    c = spark.createDataFrame([("k1", 1, "Cache", "open the cache"), ("k2", 2, "The CACHE is shut", "x y"), ("k3", 3, None, "y, then x"), ("k4", None, "open", "cache")], "id string, pos bigint, heading string, content string").selectExpr(
        "*", "'' concat_header_path", "'' category", "'' title", "CASE WHEN id = 'k3' THEN 'The sum' END chunk_summary", "'' filename")
    assert {tuple(r) for r in ground_truth.ground_truth(q, c).collect()} == {("a", "k1"), ("a", "k2"), ("b", "k2"), ("d", "k3")}


def test_quantiles_and_rows_of_csv(spark):
    values = [5.0, 1.0, 1.0, 9.0, 2.0, 2.0, 2.0, None]
    df = spark.createDataFrame([(k, v) for k in ("a", None) for v in values] + [("z", None)], "k string, n double")
    import numpy as np

    full = [v for v in values if v is not None]
    for r in statistics.quantiles(df, ["k"], "n", {"q1": 0.25, "q9": 0.9, "all": 1.0}).collect():
        assert np.allclose((r.q1, r.q9, r["all"]), np.quantile(full, (0.25, 0.9, 1.0)))
    assert statistics.quantiles(df.limit(0), ["k"], "n", {"q": 0.5}).count() == 0
    assert one(spark, writers.csv_row(F.array(F.lit("a,b"), F.lit('say "x"'), F.lit(None), F.lit("c"), F.lit("l\nm")))) == '"a,b","say ""x""",,c,"l\nm"'
    assert one(spark, writers.format_rate(F.lit(2e-5))) == "2e-5" and one(spark, writers.format_rate(F.lit(0.0))) == "0.000000" and one(spark, writers.format_rate(F.lit(0.01))) == "0.010000"


def test_crawl_stays_within_site_and_depth(spark):
    pages = spark.createDataFrame([("https://a.b/1", '<a href="/2">x</a> [y](/3#top) <a href="https://c.d/9">z</a>'), ("https://a.b/2", "[w](/4)"), ("https://a.b/4", "[w](/5) [v](/1)"), ("https://a.b/7", None)], "url string, html string")
    got = {tuple(r) for r in crawl.crawl(pages, pages.where("url LIKE '%1'").select("url"), 2).collect()}
    assert got == {("https://a.b/1", 0), ("https://a.b/2", 1), ("https://a.b/3", 1), ("https://a.b/4", 2)}
    assert crawl.crawl(pages, pages.select("url").limit(0)).count() == 0
    assert {r.url for r in crawl.crawl(pages, pages.where("url LIKE '%1'").select("url"), 2, r"/[34]$").collect()} == {"https://a.b/1", "https://a.b/3"}


def test_scorers_and_stats(spark, tmp_path):
    df = spark.createDataFrame([("a B c", "b x"), (None, "b"), ("a", None)], "q string, t string")
    assert [round(r.s, 6) for r in encoders.score_pairs(df, "q", "t", "s").collect()] == [0.333333, 0.0, 0.0]
    with pytest.raises(ValueError):
        encoders.score_pairs(df, "q", "t", "s", "unknown")
    assert readers.read_stats(spark, str(tmp_path / "none.json")) == {}
    (tmp_path / "s.json").write_text('{"rows": 3}')
    assert readers.read_stats(spark, str(tmp_path / "s.json")) == {"rows": 3}


def test_ground_truth(spark):
    q = spark.createDataFrame([("q1", ["A "], [("heading", "cache", 1)]), ("q2", None, None)], "query_id string, positives array<string>, positive_filters array<struct<field:string,contains:string,max_matches:int>>")
    c = spark.createDataFrame([("x", 2, "Cache b"), ("y", 1, "The cache")], "id string, pos bigint, heading string").selectExpr("*", "'' content", "'' concat_header_path", "'' category", "'' title", "'' chunk_summary", "'' filename")
    assert {tuple(r) for r in ground_truth.ground_truth(q, c).collect()} == {("q1", "a"), ("q1", "y")}


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"chunks": [{"id": "a", "content": "x", "chunk_summary": "false"}, {"id": "b", "content": " "}]}))
    c = readers.read_chunks(spark, str(tmp_path / "c.json"))
    assert [r.id for r in c.orderBy("pos").collect()] == ["a", "b"] and c.where("chunk_summary is not null").count() == 0
    assert [tuple(r) for r in readers.corpus_texts(c).collect()] == [("a", "x")]
    (tmp_path / "q.jsonl").write_text('{"query": "one"}\n{"query": " "}\n{"id": "z", "text": "two"}\n')
    assert [r.query_id for r in readers.read_queries(spark, str(tmp_path / "q.jsonl")).orderBy("query_id").collect()] == ["q0001", "z"]
    md = tmp_path / "docs" / "sub"
    md.mkdir(parents=True)
    (md / "a.md").write_text("# A\n")
    (md / "b.txt").write_text("x")
    assert readers.read_markdown_source(spark, str(tmp_path / "docs")).count() == 1
    (tmp_path / "docs" / "docs.md").write_text("# Whole\n")
    assert readers.read_markdown_source(spark, str(tmp_path / "docs")).first().text == "# Whole\n"
    (tmp_path / "log.csv").write_text('Token count analysis\n====\na,b\n1,"x, ""y"""\n')
    assert [r.cells for r in readers.read_grid(spark, str(tmp_path / "log.csv")).orderBy("line").collect()] == [["a", "b"], ["1", 'x, "y"']]
    writers.write_chunks(c, str(tmp_path / "out"), {"title": "T"}, "p")
    assert spark.read.json(str(tmp_path / "out")).first().title == "T"
    v = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [1.0]), ("c", None)], "id string, embedding array<float>")
    writers.write_vectors(v, str(tmp_path / "v"), 2)
    assert [r.id for r in readers.read_vectors(spark, str(tmp_path / "v")).collect()] == ["a"]
    with pytest.raises(ValueError):
        readers.read_vectors(spark, _parquet(spark, tmp_path))
    with pytest.raises(LookupError):
        readers.catalogue_row(spark.createDataFrame([("1", "x")], "ID string, BASE_DIR string"), "2")
    assert readers.difficulty_order(None, "hard") == ["hard", "easy", "medium"]
    up = writers.upsert(v, spark.createDataFrame([("a", [9.0]), (None, [1.0])], "id string, embedding array<float>"), "id")
    assert {r.id: r.embedding for r in up.collect()} == {"a": [9.0], "b": [1.0], "c": None}
    assert {tuple(r) for r in writers.upsert(up, up, "id").select("id").collect()} == {("a",), ("b",), ("c",)}


def _parquet(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "bad"))
    return str(tmp_path / "bad")


def test_stream_equals_batch_and_late_rows_go(spark, tmp_path):
    import datetime as dt

    base = dt.datetime(2024, 1, 1)
    rows = [(i, base + dt.timedelta(minutes=7 * i), i % 3, "t", 1.0, "{}") for i in range(40)]
    df = spark.createDataFrame([*rows, rows[0]], stream.SCHEMA)
    df.write.parquet(str(tmp_path / "in"))
    s = stream.read_stream(spark, str(tmp_path / "in"))
    for name, f in (("t", stream.tumbling), ("d", stream.deduplicated)):
        q = f(s).writeStream.format("memory").queryName(f"mem_{name}").outputMode("append").option("checkpointLocation", str(tmp_path / f"cp{name}")).trigger(availableNow=True).start()
        q.awaitTermination(120)
    assert spark.table("mem_d").count() == 40
    batch = {(r.start, r.events) for r in stream.tumbling(df).collect()}
    assert {(r.start, r.events) for r in spark.table("mem_t").collect()} <= batch
    q = stream.running_totals(s).writeStream.format("memory").queryName("mem_r").outputMode("update").option("checkpointLocation", str(tmp_path / "cpr")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("mem_r").agg(F.sum("events")).first()[0] == 41
    q = s.writeStream.foreachBatch(stream.upsert_batches(str(tmp_path / "up"), "event_id", "ts")).option("checkpointLocation", str(tmp_path / "cpu")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert stream.read_store(spark, str(tmp_path / "up")).count() == 40
    run = stream.upsert_batches(str(tmp_path / "store"), "event_id", "ts", 4)
    first = spark.createDataFrame(rows[:10], stream.SCHEMA)
    again = spark.createDataFrame([(3, base + dt.timedelta(days=9), 0, "new", 2.0, "{}"), (None, base, 0, "t", 1.0, "{}")], stream.SCHEMA)
    for batch, number in ((first, 0), (again, 1), (again, 1), (again.limit(0), 2)):
        run(batch, number)
    kept = {r.event_id: r.event_type for r in stream.read_store(spark, str(tmp_path / "store")).collect()}
    assert kept == {i: "new" if i == 3 else "t" for i in range(10)}
    assert len(list((tmp_path / "store" / "v1").glob("bucket=*"))) == 1
