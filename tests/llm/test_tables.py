import random

import numpy as np
import pytest

from quarryloom.llm import bits, budget, leakage, mixing, neighbours, overlap
from quarryloom.llm.words import plain_words, words

QUERY = "query_id string, text string, positives array<string>, split string, source string, labelled_at timestamp"


def test_words():
    assert words("Ｃaché's — ÉTÉ don’t_x") == ["caches", "ete", "dont", "x"] and words(None) == []
    assert plain_words("Été, l’an 2") == ["été", "lan", "2"]


def test_overlap_matches_brute_force(spark):
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(30)] + ["the"] * 10
    rows = []
    for i in range(150):
        if rows and rng.random() < 0.6:
            t = rng.choice(rows)[1].split()
            for _ in range(rng.randint(0, 3)):
                k = rng.randrange(len(t))
                t[k] = rng.choice(vocab)
            rng.shuffle(t)
        else:
            t = [rng.choice(vocab) for _ in range(rng.randint(3, 9))]
        rows.append((f"q{i:03d}", " ".join(t).upper() if i % 2 else " ".join(t) + "!", [rng.choice("AB ") + "x" for _ in range(2)], rng.choice(["Train ", "test", "VALIDATION", None, "other"]), "s", None))
    df = spark.createDataFrame([*rows, ("q000", None, None, None, None, None), ("e", "", [], "test", None, None), ("n", None, None, "test", None, None), (None, "a b c", ["x"], "test", None, None)], QUERY).selectExpr("*", "'a' as side", "'b' as cls", "'c' as qid")
    got = {tuple(r) for r in overlap.overlapping_pairs(df).collect()}
    from collections import Counter

    want = set()
    latest = {r[0]: r for r in rows}
    keep = {r.qid: r for r in overlap.normalise_queries(df).collect()}
    for a in keep:
        for b in keep:
            if a < b and (keep[a].side == "train") != (keep[b].side == "train"):
                x, y = Counter(words(latest[a][1])), Counter(words(latest[b][1]))
                n = max(sum(x.values()), sum(y.values()))
                if n - sum((x & y).values()) <= 2 and n - 2 >= 1 and {p.strip().lower() for p in latest[a][2]} & {p.strip().lower() for p in latest[b][2]}:
                    want.add((a, b))
    assert got == want and want
    assert sum(r.queries for r in overlap.overlap_report(df).collect()) == sum(r.side == "eval" for r in keep.values())
    assert overlap.overlapping_pairs(df.limit(0)).count() == 0 and overlap.overlap_report(df.limit(0)).count() == 0


def test_leaks_match_brute_force(spark):
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(60)}"
    items = [(k, " ".join(word() for _ in range(40))) for k in range(6)] + [(6, "too short"), (7, None), (8, "")]
    docs = []
    for k in range(40):
        body = [word() for _ in range(80)]
        if k % 3 == 0:
            t = items[k % 6][1].split()
            a = rng.randrange(20)
            body[30:30] = t[a : a + rng.randint(8, 20)]
        docs.append((k, ", ".join(body).upper() if k % 2 else "\n".join(body)))
    docs += [(100, None), (101, ""), (102, items[0][1] * 3), (103, items[0][1] * 3)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 as item_id", "'g' as gram", "0 as pos")
    i = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "'x' as doc_id")
    got = {tuple(r) for r in leakage.leaked_documents(d, i).collect()}
    want = set()
    for k, t in docs:
        w = plain_words(t)
        for j, s in items:
            v = plain_words(s)
            if {tuple(w[x : x + 12]) for x in range(len(w) - 11)} & {tuple(v[x : x + 12]) for x in range(len(v) - 11)}:
                want.add((k, j))
    assert got == want and len(want) > 5
    assert leakage.leaked_documents(d.limit(0), i).count() == 0 and leakage.leaked_documents(d, i.limit(0)).count() == 0


def test_edited_copies_are_aligned(spark):
    """Words replaced, added and dropped: no run of twelve is left, the alignment tells."""
    rng = random.Random(3)
    items = [(k, " ".join(f"w{rng.randrange(5000)}" for _ in range(60))) for k in range(8)]

    def edit(text: str, how: str) -> str:
        out = []
        for n, w in enumerate(text.split()):
            if n % 9 == 8:
                out += {"replace": [f"z{n}"], "add": [w, f"z{n}"], "drop": []}[how]
            else:
                out.append(w)
        return " ".join(out)

    filler = lambda: " ".join(f"f{rng.randrange(5000)}" for _ in range(80))
    docs, wanted = [], set()
    for k, text in items:
        for h, how in enumerate(("replace", "add", "drop")):
            docs.append((10 * k + h, f"{filler()} {edit(text, how)} {filler()}"))
            wanted.add((10 * k + h, k))
        docs.append((10 * k + 5, text if k % 2 else filler()))
        wanted |= {(10 * k + 5, k)} if k % 2 else set()
    d, i = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    found = {(r.doc_id, r.item_id): r for r in leakage.leaks(d, i).collect()}
    assert set(found) == wanted
    assert all(r.share > 0.6 for r in found.values())
    assert {(r.doc_id, r.item_id) for r in leakage.leaked_documents(d, i).collect()} == {p for p in wanted if p[0] % 10 == 5}


def test_bit_table_loses_no_key(spark):
    keys = spark.range(5000).selectExpr("xxhash64(id) AS k")
    table = bits.bit_table(keys, "k").value
    own = np.array([r.k for r in keys.collect()])
    assert len(bits.maybe(table, own)) == 5000
    assert len(bits.maybe(table, own ^ 0x5555555555555)) < 50
    rows = spark.range(1000).selectExpr("id", "id % 3 AS x")
    kept = bits.only_maybe(rows, "id", rows.where("id < 10"))
    assert kept.where("id < 10").count() == 10 and kept.count() < 30 and kept.columns == ["id", "x"]


def test_smith_waterman_against_full_table():
    rng = np.random.default_rng(1)
    for _ in range(40):
        a, b = rng.integers(0, 5, rng.integers(1, 15)), rng.integers(0, 5, rng.integers(1, 15))
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        run = np.zeros_like(h)
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                s = leakage.MATCH if a[i - 1] == b[j - 1] else leakage.MISMATCH
                h[i, j] = max(0, h[i - 1, j - 1] + s, h[i - 1, j] + leakage.GAP, h[i, j - 1] + leakage.GAP)
                run[i, j] = run[i - 1, j - 1] + 1 if a[i - 1] == b[j - 1] else 0
        score, same, longest = leakage.align(a, b)
        assert score == h.max() and longest == run.max() and 2 * same >= score


def test_token_counts_with_hot_and_cold_pieces(spark):
    texts = [("a", "the cat the", 3, "EN-us", " X "), ("b", "", 1, None, None), ("c", None, None, "", "x"), ("d", "the\u00a0dog\tthe\x1cend " * 50, 200, "Sh", "Y"), ("d", "the\u00a0dog\tthe\x1cend " * 50, 200, "Sh", "Y")]
    df = spark.createDataFrame(texts, "id string, content string, token_count int, language string, category string").selectExpr("*", "1 as tokens", "'p' as piece", "2 as df")
    want = {"a": 3, "b": 0, "c": 0, "d": 200}
    for hot in (0, 1, 1000):
        got = budget.token_counts(df, "id", "content", [], hot_pieces=hot).collect()
        assert {r.id: r.tokens for r in got} == want and len(got) == 4
    assert {tuple(r) for r in budget.stale_token_counts(df).collect()} == {("b", "unknown", "und"), ("c", "x", "und")}
    total = {(r.category, r.language): (r.rows, r.tokens) for r in budget.token_budget(budget.chunk_tokens(df), ["category", "language"]).collect()}
    assert total["x", "en"] == (1, 3) and total["y", "bash"] == (1, 200)
    assert budget.stale_token_counts(df.limit(0)).count() == 0


def test_byte_bpe_counts_equal_the_tokenizer(spark):
    P = pytest.importorskip("public_tokenizers")
    import base64

    import tiktoken

    path = P.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in open(path, "rb") if x.strip())}
    enc = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [("a", "Hello  world, it's 2024!\n\n  naïve"), ("b", "größe <|endoftext|>"), ("c", "")]
    df = spark.createDataFrame(texts, "id string, content string")
    got = {r.id: r.tokens for r in budget.token_counts(df, "id", "content", [], budget.byte_bpe(path, P.PATTERN), hot_pieces=3).collect()}
    assert got == {i: len(enc.encode_ordinary(t)) for i, t in texts}


def test_mix_meets_budgets(spark):
    rng = random.Random(8)
    rows = [(i, "w " * rng.randint(1, 30), rng.choice(["A ", "a", "b", "c"])) for i in range(400)] + [(900, "x y", None), (901, None, "a"), (902, "", "b"), (903, "x", "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").selectExpr("*", "1 as tokens", "'k' as key", "'s' as src")
    targets = spark.createDataFrame([("a", 0.2, 2), ("B", 0.5, 3), ("c", 0.2, 1), ("gone", 0.1, 4)], "source string, target_share double, max_repeats int")
    mix, report = mixing.mix_sources(docs, targets)
    size = {}
    for _, t, s in rows:
        if s and s.strip():
            size[s.strip().lower()] = size.get(s.strip().lower(), 0) + len((t or "").split())
    total = sum(size.values())
    got = {r.source: r for r in report.collect()}
    for s, share, most in (("a", 0.2, 2), ("b", 0.5, 3), ("c", 0.2, 1)):
        want = next((k for k in range(1, most + 1) if k * size[s] >= share * total), most)
        assert got[s].repeats == want
        assert got[s].mixed_tokens == (size[s] * most if most * size[s] < share * total else got[s].mixed_tokens)
        if most * size[s] >= share * total:
            assert 0 <= got[s].mixed_tokens - share * total < 30
    assert got["gone"].docs == 0 and got["gone"].repeats == 0
    per = {}
    for r in mix.collect():
        per[r.source] = per.get(r.source, 0) + r.tokens * r.copies
        assert r.copies <= got[r.source].repeats
    assert all(per[s] == got[s].mixed_tokens for s in per)
    assert mixing.mix_sources(docs.limit(0), targets)[0].count() == 0


def _vectors(seed, n):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, 48))
    for i in range(0, n - 5, 10):
        for k in range(1, 4):
            y = rng.standard_normal(48)
            c = rng.uniform(0.94, 0.999)
            u = x[i] / np.linalg.norm(x[i])
            y -= (y @ u) * u
            x[i + k] = (c * u + np.sqrt(1 - c * c) * y / np.linalg.norm(y)) * rng.uniform(0.5, 2)
    return x.astype(np.float32)


def test_similar_pairs_recall_against_brute_force(spark):
    x = _vectors(3, 1500)
    ids = [f"v{i:04d}" for i in range(len(x))]
    bad = [("n1", None), ("n2", []), ("n3", [1.0] * 47), ("n4", [0.0] * 48), ("n5", [float("nan")] * 48), (None, x[0].tolist())]
    rows = [(i, v.tolist()) for i, v in zip(ids, x, strict=True)] + bad + [(ids[0], x[0].tolist())]
    df = spark.createDataFrame(rows, "id string, embedding array<float>").selectExpr("*", "'f' as field", "1 as row", "'u' as unit", "cast(null as array<float>) as embedding_summary_chunk")
    got = {(r.id_a, r.id_b) for r in neighbours.similar_pairs(df).collect()}
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1)[:, None]
    s = u @ u.T
    np.fill_diagonal(s, -1)
    want = set()
    for i, top in enumerate(np.argsort(-s, 1)[:, :10]):
        want |= {(ids[min(i, j)], ids[max(i, j)]) for j in top if s[i, j] >= 0.93}
    assert len(got & want) / len(want) >= 0.95 and not got - want
    assert neighbours.similar_pairs(df.limit(0)).count() == 0


def test_many_equal_vectors_stay_bounded(spark):
    v = _vectors(1, 1)[0].tolist()
    df = spark.createDataFrame([(f"e{i:03d}", v) for i in range(400)], "id string, embedding array<float>")
    rows = neighbours.similar_pairs(df).collect()
    assert {i for r in rows for i in (r.id_a, r.id_b)} == {f"e{i:03d}" for i in range(400)} and len(rows) <= 400 * 10


def test_nearest_of_every_vector_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 250)
    x = _vectors(5, 900)
    x[100:130] = x[100]  # more equals than k
    x[200:203] = x[200]
    ids = [f"v{i:04d}" for i in range(len(x))]
    bad = [("n1", None), ("n3", [1.0] * 47), ("n4", [0.0] * 48), ("n5", [float("nan")] * 48), (None, x[0].tolist())]
    rows = [(i, v.tolist()) for i, v in zip(ids, x, strict=True)] + bad + [(ids[0], x[0].tolist())]
    few = [[1.0] + [0.1 * i] * 47 for i in range(4)]
    df = spark.createDataFrame([(i, v, few[k] if k < 4 else None) for k, (i, v) in enumerate(rows)], "id string, embedding array<float>, embedding_summary_page array<float>")
    got = {}
    for r in neighbours.nearest(df).collect():
        got.setdefault((r.field, r.id), {})[r.rank] = (r.neighbour, r.cosine)
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1)[:, None]
    s = u.astype(np.float32).astype(np.float64)
    s = s @ s.T
    for i in range(len(x)):
        s[i, (x == x[i]).all(1)] = 1
        s[i, i] = -2
        want = sorted(range(len(x)), key=lambda j: (-s[i, j], j))[:10]
        mine = got["embedding", ids[i]]
        assert [mine[k + 1][0] for k in range(10)] == [ids[j] for j in want] and len(mine) == 10
        assert np.allclose([mine[k + 1][1] for k in range(10)], s[i, want])
    assert {k: len(v) for k, v in got.items() if k[0] != "embedding"} == {("embedding_summary_page", i): 3 for i in ids[:4]} and len(got) == len(x) + 4
    assert neighbours.nearest(df.limit(0)).count() == 0


def test_similar_pairs_in_a_dense_group_are_the_nearest(spark):
    rng = np.random.default_rng(9)
    u = rng.standard_normal(48)
    u /= np.linalg.norm(u)
    y = rng.standard_normal((600, 48))
    y -= (y @ u)[:, None] * u
    c = rng.uniform(0.985, 0.999, 600)[:, None]
    x = (c * u + np.sqrt(1 - c * c) * y / np.linalg.norm(y, axis=1)[:, None]).astype(np.float32)
    x = np.concatenate([x, x[:40]])
    ids = [f"v{i:03d}" for i in range(len(x))]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x, strict=True)], "id string, embedding array<float>")
    got = {(r.id_a, r.id_b) for r in neighbours.similar_pairs(df).collect()}
    w = x.astype(np.float64)
    w /= np.linalg.norm(w, axis=1)[:, None]
    s = w @ w.T
    s[np.arange(40), np.arange(600, 640)] = s[np.arange(600, 640), np.arange(40)] = 1
    np.fill_diagonal(s, -1)
    want = {(ids[min(i, j)], ids[max(i, j)]) for i, row in enumerate(s) for j in np.argsort(-row)[:10]}
    assert len(got & want) / len(want) >= 0.99 and len(got - want) / len(got) <= 0.01


def test_overlap_of_texts_of_one_or_two_words(spark):
    rows = [("t1", "install guide", ["A"], "train"), ("t2", "Guide", ["B"], None), ("t3", "reset password", ["C"], "train"), ("t4", "one two three", ["C"], "train"),
            ("e1", "Install, guide!", [" a"], "test"), ("e2", "guide", ["b", "a"], "validation"), ("e3", "install guide", ["x"], "test"), ("e4", "login", ["c"], "test"), ("e5", "other words", ["x"], "test")]
    df = spark.createDataFrame([(*r, "s", None) for r in rows], QUERY)
    got = {tuple(r) for r in overlap.overlapping_pairs(df).collect()}
    assert got == {("e1", "t1"), ("e2", "t1"), ("e2", "t2"), ("e4", "t3")}
    report = {r.split: r for r in overlap.overlap_report(df).collect()}
    assert (report["test"].queries, report["test"].same_words, report["test"].near_same) == (4, 2, 1)
    assert (report["validation"].queries, report["validation"].same_words, report["validation"].near_same) == (1, 1, 0)
