"""The followed change log against a plain replay, batch by batch."""

import random

import pytest

from tessera.streaming import changelog as stream


def roots_of(n, edges):
    root = list(range(n))
    for _ in range(n):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    return root


def start(spark, path, n, edges):
    spark.createDataFrame([(i, i + 100) for i in range(n)], "vid bigint, seg_id bigint").write.parquet(f"{path}/vertices")
    spark.createDataFrame([(*e, m) for e, m in edges.items()], "src bigint, dst bigint, mult bigint").write.parquet(f"{path}/edges")


def test_states_equal_a_replay_and_rows_written_follow_the_batch(spark, tmp_path):
    rng, n = random.Random(3), 30
    state = {(i, i + 1): 1 + i % 2 for i in range(0, 20, 2)}
    graph, folder = str(tmp_path / "g"), tmp_path / "log"
    start(spark, graph, n, state)
    folder.mkdir()
    batches, at = [], dict(state)
    for number in range(4):
        lines = []
        for _ in range(0 if number == 3 else 12):
            op, a, b = rng.choice("+--x"), rng.randrange(n), rng.randrange(n)
            if op == "-" and at and rng.random() < 0.7:
                a, b = rng.choice(sorted(at))
            lines.append(f"{op}\t{a + 100}\t{b + 100}")
            key, c = (min(a, b), max(a, b)), at.get((min(a, b), max(a, b)), 0)
            at[key] = max(c, 1) if op == "+" else max(c - 1, 0) if op == "-" else c
            at = {k: v for k, v in at.items() if v}
        lines += ["", "+\t5", "-\t100\t9999"]
        batches.append((lines, dict(at)))
    for number, (lines, _) in enumerate(batches):
        (folder / f"{number}.tsv").write_text("\n".join(lines) + "\n")
        stream.follow_changes(spark, str(folder), graph, str(tmp_path / "cp"), compact_every=2).awaitTermination(180)
    for number, (lines, expected) in enumerate(batches):
        assert {(r.src, r.dst): r.mult for r in stream.edges_at(spark, graph, number).collect()} == expected
        want = roots_of(n, expected)
        assert {r.vid: r.root for r in stream.roots_at(spark, graph, number).collect()} == dict(enumerate(want))
        assert spark.read.parquet(f"{graph}/deltas/batch={number}").count() <= len(lines)
        earlier = roots_of(n, batches[number - 1][1] if number else state)
        assert spark.read.parquet(f"{graph}/roots/batch={number}").count() == sum(a != b for a, b in zip(earlier, want))
        assert spark.read.parquet(f"{graph}/rejects/batch={number}").count() == 2 + sum(x.startswith("x") for x in lines)
    assert stream._batches(f"{graph}/compact_edges") and stream._base(f"{graph}/compact_edges", 2) == 1


def test_a_batch_that_runs_again_gives_the_same(spark, tmp_path):
    graph = str(tmp_path / "g")
    start(spark, graph, 4, {(0, 1): 2})
    stream.prepare(spark, graph)
    batch = spark.createDataFrame([(0, "-", 100, 101), (1, "+", 102, 103), (2, "-", 100, 101)], "line_no bigint, op string, v1 bigint, v2 bigint")
    for _ in range(2):
        stream.advance(batch, 0, graph)
        assert [tuple(r) for r in stream.edges_at(spark, graph, 0).collect()] == [(2, 3, 1)]
        assert sorted((r.vid, r.root) for r in stream.roots_at(spark, graph, 0).collect()) == [(0, 0), (1, 1), (2, 2), (3, 2)]


def test_a_batch_reads_lines_and_states_few_times(spark, tmp_path):
    def rows_read():
        jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        found = spark.sparkContext._jsc.sc().statusStore().stageList(jvm.java.util.ArrayList(), False, False, gateway.new_array(jvm.double, 0), None)
        return {found.apply(i).stageId(): found.apply(i).inputRecords() + found.apply(i).shuffleReadRecords() for i in range(found.size())}

    graph, n = str(tmp_path / "g"), 20_000
    start(spark, graph, n, {(i, i + 1): 1 for i in range(0, n - 1, 2)})
    stream.prepare(spark, graph)
    batch = spark.createDataFrame([(i, "+-"[i % 4 == 0], 100 + i, 101 + i) for i in range(n - 1)], "line_no bigint, op string, v1 bigint, v2 bigint")
    before = rows_read()
    stream.advance(batch, 0, graph)
    assert sum(v for k, v in rows_read().items() if k not in before) < 50 * n
    assert spark.read.parquet(f"{graph}/deltas/batch=0").count() == n - 1
