import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.operators import changelog, components, graph, keyed


def union_find(n, edges):
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("skew_edges", [0, 1 << 20])
@pytest.mark.parametrize("local", [4, 1 << 20])
def test_components_match_union_find(spark, monkeypatch, skew_edges, local):
    rng = np.random.default_rng(7)
    n = 400
    edges = [(int(a), int(b)) for a, b in rng.integers(0, n, size=(230, 2))]
    edges += [(0, i) for i in range(300, 380)] + [(i, i + 1) for i in range(200, 260)]  # a hub and a path
    monkeypatch.setattr(components, "LOCAL_EDGES", local)
    df = spark.createDataFrame(edges, "src bigint, dst bigint").repartition(3)
    roots = components.contract(df, "src", "dst", skew_edges=skew_edges)
    got = list(range(n))
    for r in roots.collect():
        got[r.id] = r.root
    assert got == union_find(n, edges)


def make(spark, n, edges):
    vertices = spark.createDataFrame([(i, 100 + i) for i in range(n)], "vid bigint, seg_id bigint")
    return graph.SegmentGraph(vertices, spark.createDataFrame(edges, "src bigint, dst bigint"))


def test_graph_api(spark, tmp_path):
    g = make(spark, 6, [(0, 1), (3, 4), (2, 2)])
    assert {r.seg_id for r in g.component_of(101).collect()} == {100, 101}
    with pytest.raises(ValueError):
        g.component_of(5)
    assert sorted(r.seg_id for r in g.isolated().collect()) == [105]
    labels = {r.seg_id: r.label for r in g.lookup().collect()}
    assert labels == {100: 90, 101: 90, 102: 91, 103: 92, 104: 92, 105: 93}
    stats = g.statistics().first()
    assert (stats.num_vertices, stats.num_edges, stats.num_components, stats.largest_component_size) == (6, 3, 4, 2)
    g.save(str(tmp_path / "g"))
    again = graph.SegmentGraph.load(spark, str(tmp_path / "g"))
    assert again.edges.count() == 3
    with pytest.raises(ValueError):
        graph.SegmentGraph.load(spark, str(tmp_path / "absent"))


def test_duplicate_segment_ids_last_vertex_wins(spark):
    vertices = spark.createDataFrame([(0, 7), (1, 7), (2, 8)], "vid bigint, seg_id bigint")
    g = graph.SegmentGraph(vertices, spark.createDataFrame([(1, 2)], "src bigint, dst bigint"))
    labels = {r.seg_id: r.label for r in g.lookup(prefixed=False).collect()}
    assert labels[7] == labels[8]


def replay(base, log, n):
    state, effective = dict(base), 0
    for op, a, b in log:
        if op not in "+-" or a is None or b is None or a >= n or b >= n:
            continue
        key = (min(a, b), max(a, b))
        c = state.get(key, 0)
        if op == "+" and c == 0:
            state[key], effective = 1, effective + 1
        elif op == "-" and c > 0:
            state[key], effective = c - 1, effective + 1
    return {k: v for k, v in state.items() if v}, effective


ids = st.one_of(st.none(), st.integers(0, 4))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    log=st.lists(st.tuples(st.sampled_from("+--+x"), ids, ids), min_size=1, max_size=40),
    base=st.dictionaries(st.sampled_from([(0, 1), (1, 2), (2, 2)]), st.integers(1, 3)),
)
def test_log_equals_sequential_replay(spark, log, base):
    n = 4
    vertices = spark.createDataFrame([(i, i) for i in range(n)], "vid bigint, seg_id bigint")
    edges = spark.createDataFrame([(*k, v) for k, v in base.items()], "src bigint, dst bigint, mult bigint")
    changes = spark.createDataFrame([(i, *row) for i, row in enumerate(log)], "line_no bigint, op string, v1 bigint, v2 bigint")
    state, effective = replay(base, log, n)
    got = changelog.apply_changes(edges, changes, vertices)
    assert {(r.src, r.dst): r.mult for r in got.collect()} == state
    lines = changelog.effective_changes(edges, changes, vertices, stretch=7)
    assert lines.where("effective").count() == effective


def test_lookup_join_hot_branch_equals_plain_join(spark):
    fact = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(5)).when(F.col("id") % 100 == 1, F.lit(None)).otherwise(F.col("id") % 700).alias("k"), "id"
    )
    dim = spark.range(0, 700, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    for how in ("left", "inner"):
        plain = sorted(map(repr, fact.join(dim, "k", how).collect()))
        assert sorted(map(repr, keyed.lookup_join(fact, dim, "k", how, broadcast_rows=10, hot_share=50).collect())) == plain


def test_with_index_is_global_and_ordered(spark):
    df = spark.range(5000).select(F.xxhash64("id").alias("a")).repartition(7)
    rows = keyed.with_index(df, ["a"], start=10).orderBy("index").collect()
    assert [r["index"] for r in rows] == list(range(10, 5010))
    assert [r.a for r in rows] == sorted(r.a for r in rows)


def test_leaves_wait_for_the_root_of_their_neighbour(spark):
    import random

    random.seed(3)
    # chains of hubs with many leaves each, and loose pairs; whole components within a range of ids, and across
    pairs = [(h * 50, (h + 1) * 50) for h in range(0, 60, 2)] + [(h * 50, h * 50 + k) for h in range(60) for k in range(1, 40)]
    pairs += [(random.randrange(4000, 4200), random.randrange(4000, 9000)) for _ in range(150)]
    parent = {v: v for p in pairs for v in p}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    expected = sorted((v, find(v)) for v in parent if find(v) != v)
    edges = spark.createDataFrame(pairs, "a long, b long")
    for skew in (0, 1 << 20):
        assert sorted(map(tuple, components.contract(edges, "a", "b", skew_edges=skew).collect())) == expected
    peeled, rest = components._leaves(edges.selectExpr("greatest(a, b) as u", "least(a, b) as v").where("u <> v"))
    assert peeled.count() > 2000 and rest.count() < 300
