"""Hard negatives, WARC archives and fill-in-the-middle against brute force and round trips."""

import hashlib
import uuid
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import infill, negatives, warc

# hard negatives


def brute(rows, is_anchor, positives=5, count=3):
    """Plain loops; ``rows`` are (id, label, vector)."""
    used = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        q = [int(np.floor(256.0 * np.float64(x))) for x in v]
        used[i] = min(used.get(i, (label, q)), (label, q))
    out = []
    for a, (label, q) in used.items():
        if not is_anchor(a):
            continue
        score = {i: sum(x * y for x, y in zip(q, w, strict=False)) for i, (_, w) in used.items()}
        best = sorted((i for i in used if i != a and used[i][0] == label), key=lambda i: (-score[i], i))[:positives]
        for p in best:
            found = sorted((i for i in used if used[i][0] != label and 50 * score[p] <= 100 * score[i] <= 95 * score[p]), key=lambda i: (-score[i], i))
            out += [(a, p, k + 1, n, score[p], score[n]) for k, n in enumerate(found[:count])]
    return sorted(out)


def mined(spark, rows, **options):
    frame = spark.createDataFrame([(*r, 0, "x") for r in rows], "vec_id long, label int, embedding array<float>, rank int, id string").repartition(3)
    got = negatives.mine(frame, anchors=F.col("vec_id") % 50 == 0, **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("block,anchor_block,wide", [(1024, 128, 1.0), (7, 2, 1.0), (40, 3, 3000.0)])
def test_negatives_against_brute_force(spark, block, anchor_block, wide):
    rng = np.random.default_rng(block)
    rows = []
    for i in range(260):
        dims = 13 if i % 9 else int(rng.integers(0, 20))
        v = (rng.integers(-3, 4, dims) / 8 if i % 2 else rng.normal(0.2, 0.4, dims)).astype(np.float32) * np.float32(wide)  # many ties
        rows.append((i, int(rng.integers(4)), v.tolist()))
    hot = [0.5, -0.25, 0.5] * 4
    rows += [(1000 + i, i % 2, hot) for i in range(60)]
    rows += [(2000, 1, None), (2001, None, hot), (2050, 1, [1.0, None]), (2100, 1, [float("nan")]), (2101, 1, [float("inf")]), (None, 1, hot), (2150, 9, hot), (2200, 7, [])]
    rows += [(1001, 1, hot), (1001, 1, hot), (1050, 3, hot), (100, 0, hot)]  # repeated rows, and one key with several contents
    assert mined(spark, rows, block=block, anchor_block=anchor_block) == brute(rows, lambda i: i % 50 == 0)


def test_negatives_of_nothing(spark):
    assert mined(spark, []) == [] and mined(spark, [(0, 1, [1.0])]) == [] and mined(spark, [(1, 1, [1.0]), (2, 1, [1.0])]) == []


@pytest.mark.parametrize("low,high,dims", [(-256, 256, 64), (-1, 0, 9), (0, 1, 8), (-(1 << 36), 1 << 19, 24), (5, 6, 3)])
def test_scores_are_exact(low, high, dims):
    rng = np.random.default_rng(dims)
    width = -(-dims // 8) * 8
    a, c = (np.zeros((n, w), np.int64) for n, w in ((17, width), (33, width + 8)))
    a[:, :dims], c[:, : dims + 2] = rng.integers(max(low, -(1 << 19)), high, (17, dims)), rng.integers(low, high, (33, dims + 2))
    assert (negatives.scores(negatives.bit_planes(c), negatives.subset_sums(a)) == c[:, :width] @ a.T).all()


def test_scores_beyond_64_bits_are_errors(spark):
    with pytest.raises(ValueError):
        negatives.scores(negatives.bit_planes(np.full((2, 8), 1 << 50)), negatives.subset_sums(np.full((2, 8), 1 << 50)))
    with pytest.raises(Exception, match="beyond"):
        mined(spark, [(0, 1, [3e38]), (1, 1, [1.0])])


# archives

FAKE = warc.VERSION + "WARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
LONG = "x" * 2000
PAGES = [
    (1, "http://a/\r\nX: y" + warc.VERSION, LONG), (2, "u", FAKE), (3, None, "a" + FAKE * 3 + warc.VERSION), (4, None, None), (5, "u", LONG), (6, "u", LONG), (6, "u", LONG),
    (None, "u", LONG), (7, "u", warc.VERSION * 50 + "tail\r\n\r\n"), (8, "ü", "\r\n\r\n" + "é" * 700), (9, "u", "short"), (10, "u", "short"), (11, "u", FAKE * 20), (12, "u", FAKE * 20), (-5, "u", ""),
    *[(100 + i, f"http://p/{i}", f"pay{i} " * (i % 90) + (FAKE if i % 7 == 0 else "") + "W" * (i % 13)) for i in range(90)],
]


def expected(pages):
    same, out = defaultdict(list), []
    for k, _, html in pages:
        same[html or ""].append(k)
    for k, _, html in pages:
        data = (html or "").encode()
        known = [x for x in same[html or ""] if x is not None]
        to = max(known) if len(data) >= 1000 and len(same[html or ""]) > 1 else k
        out.append((k, len(data), hashlib.sha1(data).hexdigest(), "response" if to == k else "revisit", None if to == k else to))
    return sorted(map(repr, out))


def archive(tmp_path, *contents):
    folder = tmp_path / uuid.uuid4().hex
    folder.mkdir()
    for i, data in enumerate(contents):
        (folder / f"part-{i}.txt").write_bytes(data.encode())
    return str(folder)


@pytest.fixture
def splits(spark):
    def cut(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield cut
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("size", ["128m", "20000"])
def test_archive_round_trip(spark, tmp_path, splits, size):
    pages = spark.createDataFrame([(*p, "x", 1) for p in PAGES], "page_id long, url string, html string, record_type string, offset long").repartition(2)
    folder = str(tmp_path / uuid.uuid4().hex)
    warc.write(pages, folder)
    splits(size)
    records = warc.read(spark, folder)
    assert sorted(repr(tuple(r)) for r in warc.digest(records).collect()) == expected(PAGES)
    uris = {r.record_id: r.uri for r in records.collect()}
    assert uris["<urn:page:1>"] == "http://a/%0D%0AX: y" + warc.VERSION.replace("\r\n", "%0D%0A") and uris["<urn:page:8>"] == "ü" and uris["<urn:page:4>"] == ""


def test_archive_of_no_pages(spark, tmp_path):
    folder = str(tmp_path / "none")
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), folder)
    assert warc.digest(warc.read(spark, folder)).collect() == []


def record(name, body, length=None):
    return f"{warc.VERSION}WARC-Type: resource\r\nWARC-Record-ID: <urn:page:{name}>\r\ncontent-length: {len(body) if length is None else length}\r\n\r\n{body}\r\n\r\n"


@pytest.mark.parametrize("size", ["128m", "4000"])
def test_only_records_on_the_chain_from_the_start_count(spark, tmp_path, splits, size):
    good = "".join(record(i, "b" * i) for i in range(1, 30))
    damaged = record(31, "ok") + record(32, "short", length=9) + record(33, "lost")
    truncated = record(41, "ok") + record(42, "cut")[:-9]
    folder = archive(tmp_path, good, "junk" + record(21, "late"), damaged, truncated, "", record(51, "x" + record(52, "in") + record(53, "in") + "y") + record(54, "end"))
    splits(size)
    found = {int(r.record_id[10:-1]): r for r in warc.read(spark, folder).collect()}
    assert set(found) == {*range(1, 30), 31, 32, 41, 51, 54}
    assert all(found[i].payload_bytes == i and found[i].payload_sha1 == hashlib.sha1(b"b" * i).hexdigest() for i in range(1, 30))
    assert found[51].payload_sha1 == hashlib.sha1(("x" + record(52, "in") + record(53, "in") + "y").encode()).hexdigest()


# fill-in-the-middle

TEXTS = [None, "", "a", "é", "😀", "ab", "x\r\n y\x85z", "keep <P> whole", "<S>", "a<M>b", "<<P <S M> $1 \\ $", "😀é\n" * 333, "z" * 63, "z" * 64, "z" * 65, "word " * 20_000]


def test_fill_in_middle_against_slices(spark):
    keys = [None, 0, 1, 7, -3, *range(100, 140)]
    rows = [(k, t, 5, "x", "y") for t in TEXTS for k in keys] + [(7, "again", 1, "x", "y")] * 2
    frame = spark.createDataFrame(rows, "doc_id long, text string, n int, form string, a string").repartition(3)
    want = []
    for k, t, *_ in rows:
        t, h = t or "", hashlib.sha256(f"1:{'' if k is None else k}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
        a, b = sorted((h1 % (len(t) + 1), h2 % (len(t) + 1)))
        form = "plain" if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90 else "spm" if h4 % 100 < 20 else "psm"
        out = {"plain": t, "psm": f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}", "spm": f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}"}[form]
        lengths = (None, None) if form == "plain" else (a, b - a)
        want.append(repr((k, len(t), form, *lengths, *(hashlib.sha256(x.encode()).hexdigest() for x in (out, t)))))
    moved = infill.transform(frame)
    assert moved.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = [repr(tuple(r)) for r in infill.digest(moved).collect()]
    assert sorted(got) == sorted(want) and {"psm", "spm", "plain"} == {r.form for r in moved.select("form").distinct().collect()}
    assert infill.digest(infill.transform(frame.limit(0))).count() == 0


def test_fill_in_middle_has_no_python(spark, sf_dir):
    plan = infill.digest(infill.transform(spark.read.parquet(f"{sf_dir}/documents.parquet")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_best_of_rows_with_ties():
    rng = np.random.default_rng(8)
    for type_, most in ((np.int32, 3), (np.int64, 5), (np.int32, 50)):
        none = np.iinfo(type_).min
        values = rng.integers(-3, 4, (40, 17)).astype(type_)
        values[rng.random(values.shape) < 0.3] = none
        values[5] = none
        expected = []
        for row, v in enumerate(values):
            ranked = sorted((-int(x), place) for place, x in enumerate(v) if x != none)
            expected += [(row, place) for _, place in ranked[:most]]
        row, place = negatives._best(values.copy(), most)
        assert [*zip(row.tolist(), place.tolist())] == expected
    assert [len(x) for x in negatives._best(np.zeros((0, 4), np.int32), 3)] == [0, 0]


def test_finds_of_a_pair_leave_together():
    class Pairs:
        def mapInArrow(self, run, schema):
            return run

    # ten windows of one pair of blocks: one batch, not ten
    run = negatives._scored(Pairs(), lambda pair: ((np.array([k]), np.array([pair["x"]])) for k in range(10)), ["window", "x"])
    batches = [*run(iter([pa.record_batch({"x": [4, 5]})]))]
    assert [b.num_rows for b in batches] == [10, 10] and batches[1].to_pydict() == {"window": [*range(10)], "x": [5] * 10}
