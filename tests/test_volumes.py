"""Hand-made volumes with known results, and brute-force comparisons on small random ones."""

import heapq
import itertools
from collections import deque

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import distance, fuse, heights, morphology, shape, watershed
from tessera.session import materialize


def frame(spark, array, value="seg_id"):
    rows = [(*map(int, c), int(array[tuple(c)])) for c in np.argwhere(array)]
    return spark.createDataFrame(rows, f"z bigint, y bigint, x bigint, {value} bigint")


def array(df, size, value="seg_id"):
    out = np.zeros(size, dtype=np.int64)
    for r in df.collect():
        assert out[r.z, r.y, r.x] == 0, "a cell came twice"
        out[r.z, r.y, r.x] = r[value]
    return out


def steps(connectivity):
    reach = {6: 1, 18: 2, 26: 3}[connectivity]
    return [s for s in itertools.product((-1, 0, 1), repeat=3) if 0 < sum(map(abs, s)) <= reach]


def flood(mask, connectivity):
    """Components by breadth-first search, numbered in C order."""
    labels, count = np.zeros(mask.shape, int), 0
    for start in map(tuple, np.argwhere(mask)):
        if labels[start]:
            continue
        count += 1
        labels[start], queue = count, deque([start])
        while queue:
            cell = queue.popleft()
            for s in steps(connectivity):
                n = tuple(np.add(cell, s))
                if all(0 <= a < b for a, b in zip(n, mask.shape)) and mask[n] and not labels[n]:
                    labels[n] = count
                    queue.append(n)
    return labels, count


@pytest.fixture(scope="module")
def random_volume():
    rng = np.random.default_rng(5)
    return rng.choice([0, 1, 2, 3], p=[0.35, 0.4, 0.15, 0.1], size=(9, 11, 10))


@pytest.mark.parametrize("connectivity", [6, 18, 26])
@pytest.mark.parametrize("edge", [4, 32])
def test_components_match_search(spark, random_volume, connectivity, edge):
    got = morphology.voxel_components(frame(spark, random_volume), random_volume.shape[1:], connectivity, edge=edge)
    got = array(got.withColumn("component", F.col("component") + 1), random_volume.shape, "component")
    for label in (1, 2, 3):
        mask = random_volume == label
        labels, count = flood(mask, connectivity)
        assert len(np.unique(got[mask])) == count
        for i in range(1, count + 1):
            cells = labels == i
            assert set(got[cells]) == {np.flatnonzero(cells)[0] + 1}


def test_corner_touch_depends_on_connectivity(spark):
    v = np.zeros((4, 4, 4), int)
    v[:2, :2, :2] = v[2:, 2:, 2:] = 7
    counts = {
        c: morphology.connectivity_by_label(morphology.voxel_components(frame(spark, v), (4, 4), c)).first()["components"]
        for c in (6, 18, 26)
    }
    assert counts == {6: 2, 18: 2, 26: 1}
    with pytest.raises(ValueError):
        morphology.voxel_components(frame(spark, v), (4, 4), 8)


def test_no_background_keeps_the_smallest_label(spark):
    v = np.ones((2, 3, 3), int)
    v[1] = 2
    stats = morphology.connectivity_stats(morphology.connectivity_by_label(morphology.voxel_components(frame(spark, v), (3, 3))))
    assert stats.first().asDict() == {
        "total_objects": 2, "total_components": 2, "multi_part_objects": 0, "average_components_per_object": 1.0
    }


@pytest.mark.parametrize("edge", [4, 32])
@pytest.mark.parametrize("iterations", [1, 2])
def test_erosion_and_dilation(spark, edge, iterations):
    rng = np.random.default_rng(1)
    v = np.where(rng.random((9, 9, 9)) < 0.97, 1, 2)
    v[:, :, 6:] = np.where(rng.random((9, 9, 3)) < 0.9, 2, 0)
    df = frame(spark, v)
    for connectivity in (6, 18, 26):
        expected = v.copy()
        for _ in range(iterations):
            keep = expected.copy()
            for c in map(tuple, np.argwhere(expected)):
                for s in steps(connectivity):
                    n = tuple(np.add(c, s))
                    if not all(0 <= a < 9 for a in n) or expected[n] != expected[c]:
                        keep[c] = 0
            expected = keep
        eroded = morphology.erode(df, iterations, connectivity, edge=edge)
        assert np.array_equal(array(eroded, v.shape), expected)
        grown = expected.copy()
        for _ in range(iterations):
            for c in map(tuple, np.argwhere(grown)):
                for s in steps(connectivity):
                    n = tuple(np.add(c, s))
                    if all(0 <= a < 9 for a in n) and v[n] == v[c]:
                        grown[n] = -v[c]
            grown = np.abs(grown)
        assert np.array_equal(array(morphology.dilate(eroded, df, iterations, connectivity, edge=edge), v.shape), grown)


def dumbbell(v, at, label):
    z, y, x = at
    v[z : z + 5, y : y + 5, x : x + 5] = v[z : z + 5, y : y + 5, x + 6 : x + 11] = label
    v[z + 2, y + 2, x + 5] = label


@pytest.mark.parametrize("edge", [5, 32])
def test_erosion_split_gives_unique_new_labels(spark, edge):
    v = np.zeros((7, 14, 13), int)
    dumbbell(v, (1, 1, 1), 4)
    dumbbell(v, (1, 8, 1), 9)
    out = morphology.split_by_erosion(frame(spark, v), v.shape[1:], 1, 6, min_size=20, edge=edge)
    got = array(out, v.shape, "new_label")
    assert set(np.unique(got)) == {0, 4, 9, 10, 11}
    assert (got[1:6, 1:6, 1:6][1:4, 1:4, 1:4] == 4).all() and (got[1:6, 1:6, 7:12][1:4, 1:4, 1:4] == 10).all()
    assert (got[2:5, 9:12, 8:11] == 11).all()


@pytest.mark.parametrize("edge", [5, 32])
@pytest.mark.parametrize("task_saddles", [0, 1 << 16])
def test_watershed_splits_a_dumbbell(spark, edge, task_saddles, monkeypatch):
    v = np.zeros((8, 15, 14), int)
    dumbbell(v, (1, 1, 1), 4)
    dumbbell(v, (1, 8, 1), 9)
    monkeypatch.setattr(watershed, "TASK_SADDLES", task_saddles)
    maxima, regions = watershed.watershed_regions(frame(spark, v), v.shape, 1.0, 1, 6, edge, task_saddles)
    assert sorted(map(tuple, maxima.collect())) == [(4, 2), (9, 2)]
    sizes = sorted(r["count"] for r in regions.groupBy("seg_id", "region").count().collect())
    assert sum(sizes) == np.count_nonzero(v) and sizes[0] >= 125
    out, outcome = watershed.split_by_watershed(frame(spark, v), v.shape, 1.0, 50, 1, edge)
    got = array(out, v.shape, "new_label")
    assert set(np.unique(got)) == {0, 4, 9, 10, 11}
    assert (got[1:6, 1:6, 1:6] == 4).all() and (got[1:6, 1:6, 7:12] == 10).all()
    assert all(r.accepted and r.valid_regions == 2 for r in outcome.collect())


def test_watershed_elongation_splits_components_and_gates(spark):
    v = np.zeros((8, 22, 14), int)
    dumbbell(v, (1, 1, 1), 4)
    v[1:6, 8:13, 1:6] = v[1:6, 8:13, 8:13] = 5  # two pieces, nothing between
    v[1:6, 15:20, 1:6] = 6  # compact
    out, changes = watershed.split_by_watershed_elongation(frame(spark, v), v.shape, 26, 50, h=1.0)
    assert {r.seg_id: r.type for r in changes.collect()} == {4: "watershed_split", 5: "multi_component"}
    got = array(out, v.shape, "new_label")
    assert set(np.unique(got)) == {0, 4, 5, 6, 7, 8}
    assert (got[1:6, 8:13, 1:6] == 5).all() and (got[1:6, 8:13, 8:13] == 8).all()


def brute_h_maxima(field, h):
    """Reconstruction of field - h under field, by iteration over the full neighbourhood."""
    rec = field - h
    while True:
        padded = np.pad(rec, 1, constant_values=-np.inf)
        best = rec.copy()
        for s in steps(26):
            best = np.maximum(best, padded[tuple(slice(1 + d, 1 + d + n) for d, n in zip(s, field.shape))])
        best = np.minimum(best, field)
        if np.array_equal(best, rec):
            return field - rec >= h - 1e-12
        rec = best


@pytest.mark.parametrize("task_saddles", [0, 1 << 16])
@pytest.mark.parametrize("h", [1, 2, 4])
def test_h_maxima_match_reconstruction(spark, h, task_saddles):
    rng = np.random.default_rng(h)
    field = rng.integers(1, 9, size=(6, 7, 8))
    df = frame(spark, field, "val").withColumn("label", F.lit(1).cast("bigint")).withColumn("val", F.col("val").cast("double"))
    basins = watershed.Basins(materialize(df), (7, 8), 26, edge=4)
    tops = watershed.h_maxima(basins, h, task_saddles)
    on_top = basins.nodes.join(tops.withColumnRenamed("val", "_top"), ["label", "peak"])
    cells = basins.cells.join(on_top.selectExpr("label", "node as to", "_top"), ["label", "to"]).where("val = _top")
    got = np.zeros(field.size, bool)
    got[[r.cell for r in cells.collect()]] = True
    expected = brute_h_maxima(np.pad(field.astype(float), 1), h)[1:-1, 1:-1, 1:-1]
    assert np.array_equal(got.reshape(field.shape), expected)


@pytest.mark.parametrize("edge", [4, 32])
def test_distance_and_smoothing(spark, random_volume, edge):
    v = random_volume
    squared = distance.squared_distance(frame(spark, v), v.shape)
    got = {(r.z, r.y, r.x): r.val for r in squared.collect()}
    cells = np.indices(v.shape).reshape(3, -1).T
    for c in map(tuple, np.argwhere(v)):
        other = cells[v.ravel() != v[c]]
        assert got[c] == ((other - c) ** 2).sum(axis=1).min()
    field = squared.withColumn("val", F.sqrt("val"))
    smoothed = {(r.seg_id, r.z, r.y, r.x): r.val for r in distance.smooth(field, v.shape, 0.6, edge=edge).collect()}
    w = distance.gaussian_weights(0.6)
    for label in (1, 2, 3):
        dense = np.zeros(v.shape)
        for c in map(tuple, np.argwhere(v == label)):
            dense[c] = got[c] ** 0.5
        for axis in range(3):
            padded = np.pad(dense, [(len(w) // 2,) * 2 if i == axis else (0, 0) for i in range(3)], mode="edge")
            dense = np.apply_along_axis(lambda line: np.convolve(line, w, "valid"), axis, padded)
        mine = np.zeros(v.shape)
        for (s, *c), val in smoothed.items():
            if s == label:
                mine[tuple(c)] = val
        assert np.abs(mine - dense).max() < 1e-8


def brute_fill(v):
    out = v.copy()
    for label in sorted(set(v[v > 0])):
        mask = np.pad(v == label, 1)
        outside = flood(~mask, 6)[0] == 1
        filled = ~outside[1:-1, 1:-1, 1:-1]
        if (filled & (v != label)).any():
            out[filled] = label
    return out


@pytest.mark.parametrize("edge", [4, 32])
def test_fill_holes_nested(spark, edge):
    v = np.zeros((11, 11, 11), int)
    v[1:10, 1:10, 1:10] = 3
    v[2:9, 2:9, 2:9] = 0
    v[3:8, 3:8, 3:8] = 5  # a shell inside the hole, with a hole and a core of its own
    v[4:7, 4:7, 4:7] = 0
    v[5, 5, 5] = 2
    assert np.array_equal(array(morphology.fill_holes(frame(spark, v), v.shape, edge=edge), v.shape), brute_fill(v))


def test_fill_holes_random(spark):
    rng = np.random.default_rng(3)
    v = rng.choice([0, 1, 2, 3], p=[0.15, 0.6, 0.15, 0.1], size=(7, 8, 9))
    assert np.array_equal(array(morphology.fill_holes(frame(spark, v), v.shape, edge=4), v.shape), brute_fill(v))


def test_elongation_of_a_line_is_infinite(spark):
    v = np.zeros((1, 1, 9), int)
    v[0, 0] = 3
    assert shape.elongation(frame(spark, v)).first()["elongation"] == float("inf")


def test_elongation_matches_eigenvalues(spark):
    rng = np.random.default_rng(0)
    v = (rng.random((6, 9, 12)) < 0.5).astype(int)
    c = np.argwhere(v)
    cov = np.cov(c.T, bias=True)
    tensor = np.trace(cov) * np.eye(3) - cov
    low, _, high = np.linalg.eigvalsh(tensor)
    assert shape.elongation(frame(spark, v)).first()["elongation"] == pytest.approx(high / low, rel=1e-9)


def test_surface_of_a_cube(spark):
    v = np.zeros((5, 5, 5), int)
    v[1:4, 1:4, 1:4] = 8
    assert shape.surface_area(frame(spark, v), edge=3).first()["surface"] == 54


def test_cubic_lines_match_dense_solution():
    n, m = 13, 5
    system = np.zeros((n, n))
    for k in range(n):
        system[k, k] += 4 / 6
        for side in (k - 1, k + 1):
            system[k, abs(side) if side < n else 2 * (n - 1) - side] += 1 / 6
    line = np.random.default_rng(2).random(n)
    coefficients = np.linalg.solve(system, line)
    expected = []
    for i in range(m):
        s = i * (n - 1) / (m - 1)
        terms = [(k, fuse._cubic(np.array(s - k))) for k in range(int(s) - 2, int(s) + 4)]
        expected.append(sum(w * coefficients[abs(k) if k < n else 2 * (n - 1) - k] for k, w in terms))
    assert np.allclose(fuse.cubic_lines(line[None], m)[0], expected, atol=1e-12)


def test_nuclei_shape_mismatch_raises(spark):
    v = frame(spark, np.ones((2, 2, 2), int))
    with pytest.raises(ValueError):
        fuse.merge_nuclei(v, v, 2, (8, 8, 8), (4, 4, 3))


def test_levels_by_task_and_by_rounds_agree_on_tied_saddles(spark):
    rng = np.random.default_rng(3)
    edges, marked = [], []
    for label in range(60):
        n = int(rng.integers(4, 12))
        pairs = {(min(a, b), max(a, b)) for a, b in rng.integers(0, n, (3 * n, 2)).tolist() if a != b}
        edges += [(label, a, b, float(rng.integers(1, 4)), int(rng.integers(0, 3))) for a, b in sorted(pairs)]
        marked += [(label, int(a)) for a in rng.choice(n, 2, replace=False)]
    edges = spark.createDataFrame(edges, "label bigint, a bigint, b bigint, saddle double, at bigint")
    marked = spark.createDataFrame(marked, "label bigint, a bigint")
    in_task = sorted(map(tuple, watershed._levels_in_task(edges, marked).collect()))
    assert len(in_task) > 250
    assert in_task == sorted(map(tuple, watershed._levels_in_rounds(edges, marked).select("label", "peak", "saddle", "at").collect()))


def queue_flood(field, markers):
    """Regions of one object by a priority queue of cells: the highest first, of equal ones the lowest number."""
    region, queue = dict(markers), []
    for cell in markers:
        heapq.heappush(queue, (-field[cell], cell))
    while queue:
        _, cell = heapq.heappop(queue)
        for s in steps(6):
            n = tuple(np.add(cell, s).tolist())
            if n in field and n not in region:
                region[n] = region[cell]
                heapq.heappush(queue, (-field[n], n))
    return region


@pytest.mark.parametrize("edge", [3, 32])
@pytest.mark.parametrize("task_saddles", [0, 1 << 16])
@pytest.mark.parametrize("heights", [3, 1000])
def test_flood_matches_a_priority_queue(spark, edge, task_saddles, heights):
    rng = np.random.default_rng(heights + edge)
    size = (6, 8, 9)
    rows, markers, want = [], [], {}
    for label in (1, 2, 3):
        cells = [tuple(c) for c in np.argwhere(rng.random(size) < 0.8).tolist()]
        field = {c: float(rng.integers(0, heights)) for c in cells}
        rows += [(label, *c, v) for c, v in field.items()]
        number = lambda c: (c[0] * size[1] + c[1]) * size[2] + c[2]
        # markers of several cells, on peaks or not, touching each other or not
        told = {cells[i]: 100 + k % 5 for k, i in enumerate(rng.choice(len(cells), 12, replace=False).tolist())} if label < 3 else {cells[0]: 7}
        markers += [(label, number(c), m) for c, m in told.items()]
        want |= {(label, number(c)): m for c, m in queue_flood(field, told).items()}
    field = materialize(spark.createDataFrame(rows, "label bigint, z bigint, y bigint, x bigint, val double"))
    told = materialize(spark.createDataFrame(markers, "label bigint, cell bigint, marker bigint"))
    got = watershed.flood(field, size[1:], told, edge, task_saddles).collect()
    assert len(got) == len(want) and {(r.label, r.cell): r.region for r in got} == want


def test_distance_along_lines_of_many_runs():
    rng = np.random.default_rng(6)
    for _ in range(100):
        labels = np.repeat(rng.integers(0, 3, (rng.integers(1, 6), rng.integers(1, 20))), rng.integers(1, 5), axis=1)
        squared = np.where(rng.random(labels.shape) < 0.4, np.inf, rng.integers(1, 60, labels.shape) ** rng.integers(1, 3)).astype(float)
        got = distance.nearest_along(labels, squared)
        at = np.arange(labels.shape[1])
        for line, p in np.ndindex(labels.shape):
            height = np.where(labels[line] == labels[line, p], squared[line], 0)
            want = ((at - p) ** 2 + height).min() if labels[line, p] else np.nan
            assert np.array_equal(got[line, p], want, equal_nan=True)


def test_distance_pushes_each_cell_once():
    """A line whose parabolas hide each other one after the other, far longer than a quadratic pass would bear."""
    n = 20_000
    squared = (np.arange(n, dtype=float)[::-1] * 3.0)[None, :]
    got = distance.nearest_along(np.ones((1, n), int), squared)
    assert got[0, -1] == 0 and (got <= squared).all()


@pytest.mark.parametrize("shape", [(4, 5, 3), (1, 4, 2)])
def test_upsampling(spark, shape):
    v = np.random.default_rng(2).integers(0, 4, shape)
    factors = (0.5, 0.4, 2)
    sizes = [max(1, int(n / f)) for n, f in zip(shape, factors)]
    at = [np.arange(m) * ((n - 1) / (m - 1) if m > 1 else 1.0) for n, m in zip(shape, sizes)]
    nearest = v[np.ix_(*[np.floor(a + 0.5).astype(int) for a in at])]
    got = np.zeros(sizes, int)
    for r in fuse.resample(frame(spark, v), shape, factors, "nearest").collect():
        got[r.z, r.y, r.x] += r.seg_id
    assert (got == nearest).all()
    linear = v.astype(float)
    for axis, a in enumerate(at):
        low = np.floor(a).astype(int)
        high, part = np.minimum(low + 1, shape[axis] - 1), (a - low).reshape([-1 if i == axis else 1 for i in range(3)])
        linear = linear.take(low, axis) * (1 - part) + linear.take(high, axis) * part
    got = np.zeros(sizes)
    for r in fuse.resample(frame(spark, v), shape, factors, "linear", "seg_id").collect():
        got[r.z, r.y, r.x] = r.seg_id
    assert np.abs(got - linear).max() < 1e-9
    with pytest.raises(ValueError):
        fuse.resample(frame(spark, v), shape, (0, 1, 1))


def test_an_object_inside_a_block_leaves_nothing_to_the_graph():
    rng = np.random.default_rng(4)
    field = rng.integers(0, 7, (8, 9, 7)).astype(float)
    cells = np.argwhere(field > 0)
    order = np.arange(len(cells))
    got = heights.maxima(np.full(len(cells), 5), list((cells + 9).T), field[tuple(cells.T)], [0, 0, 0], [32, 32, 32], (99, 99, 99), None, 2.0)
    assert set(got["kind"].tolist()) == {heights.MAXIMUM} and set(got["label"].tolist()) == {5}
    expected = brute_h_maxima(np.where(field > 0, field, -1e9), 2.0) & (field >= 2)
    found = np.stack(np.unravel_index(got["a"], (99, 99, 99)), axis=1) - 9
    assert sorted(map(tuple, found.tolist())) == sorted(map(tuple, np.argwhere(expected).tolist())) and len(order) > 300


@pytest.mark.parametrize("cut", [3, 5])
def test_blocks_settle_peaks_as_the_whole_does(cut):
    """What the blocks on both sides of a cut decide alone holds in the whole object; what is left says the rest."""
    for seed in range(30):
        rng = np.random.default_rng(seed)
        field = rng.integers(1, 6, (9, 4, 4)).astype(float)
        cells, shape = np.argwhere(field > 0), field.shape
        whole = heights.maxima(np.ones(len(cells), int), list(cells.T), field[tuple(cells.T)], [0, 0, 0], list(shape), shape, None, 1.5)
        want, undecided = set(whole["a"].tolist()), 0
        for low, high in ((0, cut), (cut, 9)):
            near = cells[(cells[:, 0] >= low - 1) & (cells[:, 0] <= high)]
            got = heights.maxima(np.ones(len(near), int), list(near.T), field[tuple(near.T)], [low, 0, 0], [high, 4, 4], shape, None, 1.5)
            sure = set(got["a"][got["kind"] == heights.MAXIMUM].tolist())
            open_ = set(got["a"][got["kind"] == heights.LEVEL_CELL].tolist())
            own = {c for c in want if low * 16 <= c < high * 16}
            assert sure <= own <= sure | open_
            undecided += (got["kind"] == heights.PEAK).sum()
        assert undecided


def test_components_inside_blocks_are_flooded_there(spark, monkeypatch):
    rng = np.random.default_rng(8)
    size, rows, markers, want = (5, 6, 7), [], [], {}
    for label in (1, 2):
        cells = [tuple(c) for c in np.argwhere(rng.random(size) < 0.6).tolist()]
        field = {c: float(rng.integers(0, 5)) for c in cells}
        rows += [(label, *c, v) for c, v in field.items()]
        number = lambda c: (c[0] * size[1] + c[1]) * size[2] + c[2]
        told = {cells[i]: 100 + k for k, i in enumerate(rng.choice(len(cells), 6, replace=False).tolist())}
        markers += [(label, number(c), m) for c, m in told.items()]
        want |= {(label, number(c)): m for c, m in queue_flood(field, told).items()}
    field = spark.createDataFrame(rows, "label bigint, z bigint, y bigint, x bigint, val double")
    told = spark.createDataFrame(markers, "label bigint, cell bigint, marker bigint")
    monkeypatch.setattr(watershed, "_flood_across", None)
    assert {(r.label, r.cell): r.region for r in watershed.flood(field, size[1:], told).collect()} == want


@pytest.mark.parametrize("solid", [False, True])
def test_planes_that_go_whole_give_the_same_regions(spark, solid, monkeypatch):
    """A long thin volume in pieces; a solid stretch has distances that no piece sees."""
    rng = np.random.default_rng(1)
    v = np.where(rng.random((700, 3, 4)) < 0.8, 1 + np.arange(700)[:, None, None] // 9 % 3, 0)
    v[290:300] = 0
    if solid:
        v[300:560] = 4
    asked = []
    real = watershed.squared_distance
    monkeypatch.setattr(watershed, "squared_distance", lambda *a: asked.append(1) or real(*a))

    def run():
        maxima, regions = watershed.watershed_regions(frame(spark, v), v.shape, 0.2, 1, 6)
        return sorted(map(tuple, maxima.collect())), sorted(map(tuple, regions.select("z", "y", "x", "seg_id", "region").collect()))

    got = run()
    assert len(asked) == solid and len(got[1]) > 1000
    monkeypatch.setattr(watershed, "GROUP_CELLS", 0)
    assert run() == got
