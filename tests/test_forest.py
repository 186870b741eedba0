import random

from quarryloom.operators.forest import chunk_forest, descendants, hierarchy_defects, resolve_forest, resolve_locally

CHUNK = "id string, parent_id string, heading string, concat_header_path string, filename string, pos bigint, loaded_at timestamp"


def brute(parents):
    out = {}
    for i in parents:
        seen, at = [i], parents[i]
        while at and at in parents and at not in seen:
            seen.append(at)
            at = parents[at]
        if not at:
            out[i] = ("root", seen[-1], len(seen) - 1, list(reversed(seen)))
        elif at not in parents:
            out[i] = ("dangling", None, len(seen) - 1, list(reversed(seen)))
        else:
            out[i] = ("cycle" if at == i else "below_cycle", None, None, None)
    return out


def solve(spark, parents, per_task):
    rows = [(i, p, i.upper(), k) for k, (i, p) in enumerate(parents.items())]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "id string, parent_id string, heading string, pos bigint")
    f = resolve_forest(df, place_cols=("pos",), per_task=per_task).collect()
    assert len(f) == len(parents)
    return {r.id: (r.status, r.root, r.depth, list(r.path_ids) if r.path_ids is not None else None) for r in f}


def test_random_forests_match_brute_force_at_every_task_size(spark):
    rng = random.Random(5)
    ids = [f"n{i}" for i in range(120)]
    parents = {i: rng.choice([None, "", "gone", *ids, *ids, *ids]) for i in ids}
    want = brute(parents)
    for per_task in (1000, 30, 7):
        assert solve(spark, parents, per_task) == want


def test_long_chain_and_loop_over_fragments(spark):
    chain = {f"c{i:03d}": f"c{i - 1:03d}" if i else None for i in range(150)}
    loop = {f"l{i:02d}": f"l{(i + 1) % 40:02d}" for i in range(40)} | {"x": "l07", "y": "x", "self": "self"}
    parents = chain | loop
    assert solve(spark, parents, 11) == brute(parents)


def test_badly_placed_kin_end_without_larger_tasks(spark):
    """Kin far apart: no level's tasks may grow, yet it ends."""
    order = list(range(240))
    random.Random(8).shuffle(order)
    chain = {f"c{i:03d}": f"c{i - 1:03d}" if i else None for i in range(160)} | {f"s{i:02d}": "c159" for i in range(80)}
    rows = [(i, p, i.upper(), place) for (i, p), place in zip(chain.items(), order, strict=True)]
    df = spark.createDataFrame(rows, "id string, parent_id string, heading string, pos bigint")
    got = {r.id: (r.status, r.root, r.depth, list(r.path_ids)) for r in resolve_forest(df, place_cols=("pos",), per_task=40).collect()}
    assert got == brute(chain)


def test_local_resolution_visits_chains_once():
    nodes = {"a": (None, ["A"], ["a"]), "b": ("a", ["B"], ["b"]), "c": ("z", ["C"], ["c"])}
    got = {x[0]: x[1:4] for x in resolve_locally(nodes)}
    assert got == {"a": ("a", None, "root"), "b": ("a", None, "root"), "c": ("c", "z", "open")}


def test_nulls_empty_tables_repeats_and_extra_columns(spark):
    empty = spark.createDataFrame([], CHUNK)
    assert chunk_forest(empty).count() == 0 and hierarchy_defects(empty).count() == 0
    rows = [(None, None, "h", "h", "f", 0, None), ("a", None, None, "", "f", 1, None), ("a", None, None, "", "f", 1, None), ("b", "a", "B", None, None, None, None), ("c", "a", "C", " > C", "f", 2, None)]
    df = spark.createDataFrame(rows, CHUNK).selectExpr("*", "'x' as status", "1 as depth", "array('q') as labels", "'p' as place")
    assert {r.id: r.path for r in chunk_forest(df).collect()} == {"a": "", "b": " > B", "c": " > C"}
    assert {(r.id, r.defect) for r in hierarchy_defects(df).collect()} == {("b", "path")}
    assert {(r.ancestor, r.descendant, r.distance) for r in descendants(chunk_forest(df)).collect()} == {("a", "b", 1), ("a", "c", 1)}
