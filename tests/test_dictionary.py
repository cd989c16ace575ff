"""Lookups through block dictionaries against plain loops over cells."""

import numpy as np
import pytest

from tessera.operators import convert, dictionary, proof
from tessera.sources import blocks, zarr2

SHAPE, CHUNK = (10, 9, 7), (4, 4, 4)


@pytest.fixture
def volume():
    rng = np.random.default_rng(4)
    cells = rng.choice(np.array([0, 1, 2, 3, 70_000, 2**40, 2**62], np.uint64), SHAPE, p=[0.3, 0.3, 0.1, 0.1, 0.1, 0.05, 0.05])
    cells[:4, :4, :4] = 2  # a block of one id, without background
    cells[4:8, :4, :4] = 0
    return cells


def stored(spark, cells, path):
    zarr2.create(path, SHAPE, CHUNK, cells.dtype.name)
    rows = []
    for idx in np.ndindex(*[-(-n // c) for n, c in zip(SHAPE, CHUNK)]):
        starts = [i * c for i, c in zip(idx, CHUNK)]
        part = np.ascontiguousarray(cells[tuple(slice(s, s + c) for s, c in zip(starts, CHUNK))])
        if part.any():
            rows.append(([*map(int, idx)], starts, list(part.shape), part.dtype.name, part.tobytes()))
    frame = spark.createDataFrame(rows, blocks.BLOCK_SCHEMA)
    zarr2.write_blocks(frame, path)
    return zarr2.read_blocks(spark, path)


def dense(frame, dtype):
    out = np.zeros(SHAPE, dtype)
    for row in frame.collect():
        assert row.dtype == np.dtype(dtype).name
        cells = np.frombuffer(row.data, row.dtype).reshape([*row.shape])
        assert cells.any()
        out[tuple(slice(s, s + n) for s, n in zip(row.starts, row.shape))] = cells
    return out


@pytest.mark.parametrize("small", [500_000, 0])
def test_relabel_keep_and_mask(spark, tmp_path, volume, small):
    cells = stored(spark, volume, str(tmp_path / "seg"))
    labels = {1: 10, 2: 2**32 - 1, 2**40: 30, 0: 99, 555: 1}
    lookup = spark.createDataFrame([*labels.items(), (None, 5), (3, None)], "seg_id bigint, label bigint")
    valid = spark.createDataFrame([(10,), (30,), (30,), (None,)], "label bigint")
    both = dictionary.relabel_blocks(cells, lookup, valid, small)
    expected = np.vectorize(lambda v: labels.get(int(v), 0) if v else 0)(volume)
    assert (dense(dictionary.one_output(both, "label"), "uint32") == expected).all()
    assert (dense(dictionary.one_output(both, "filtered"), "uint32") == np.where(np.isin(expected, [10, 30]), expected, 0)).all()
    ids = spark.createDataFrame([(2,), (2**62,), (0,), (2,), (None,)], "id bigint")
    masked = dictionary.one_output(dictionary.mask_blocks(cells, ids, small), "mask")
    assert (dense(masked, "uint8") == np.isin(volume, [2, 2**62])).all()
    kept = dictionary.one_output(dictionary.keep_blocks(cells, ids, "uint64", small), "filtered")
    assert (dense(kept, "uint64") == np.where(np.isin(volume, [2, 2**62]), volume, 0)).all()
    none = dictionary.relabel_blocks(cells, lookup.limit(0), None, small)
    assert none.count() == cells.count() and dictionary.one_output(none, "label").isEmpty()
    assert dictionary.relabel_blocks(cells.limit(0), lookup, valid, small).count() == 0
    with pytest.raises(Exception, match="outside uint32"):
        dictionary.keep_blocks(cells, ids, "uint32", small).collect()
    with pytest.raises(Exception, match="outside uint32"):
        dictionary.relabel_blocks(cells, lookup.selectExpr("seg_id", "label + 1 as label"), None, small).collect()


def test_codes_are_narrow(spark, tmp_path, volume):
    rows = dictionary.coded_blocks(stored(spark, volume, str(tmp_path / "seg"))).collect()
    assert {r.code_type for r in rows} == {"uint8"}
    for r in rows:
        part = volume[tuple(slice(s, s + n) for s, n in zip(r.starts, r.shape))]
        assert r.ids[0] == 0 and (np.array(r.ids)[np.frombuffer(r.codes, r.code_type)] == part.ravel()).all()


def test_small_lookups_need_no_exchange_and_one_scan(spark, tmp_path, volume):
    cells = stored(spark, volume, str(tmp_path / "seg"))
    lookup = spark.createDataFrame([(1, 10)], "seg_id bigint, label bigint")
    plan = dictionary.relabel_blocks(cells, lookup, lookup.select("label"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("BatchScan") == 1


def test_mask_array(spark, tmp_path, volume):
    stored(spark, volume, str(tmp_path / "seg"))
    done = convert.mask_array(spark, str(tmp_path / "seg"), str(tmp_path / "mask"), spark.createDataFrame([(2**40,)], "id bigint"))
    assert (dense(zarr2.read_blocks(spark, str(tmp_path / "mask")), "uint8") == (volume == 2**40)).all()
    assert done["chunks_written"] <= done["chunks_total"]


def test_points_open_only_their_chunks(spark, tmp_path, volume):
    path = tmp_path / "seg"
    stored(spark, volume, str(path))
    for name in ("2.2.1", "1.1.0"):
        (path / name).write_bytes(b"broken")
    points = [(1, 1, 1), (1, 1, 1), (5, 1, 1), (9, 2, 6), (10, 0, 0), (-1, 0, 0), (0, 8, 6), (None, 0, 0)]
    table = spark.createDataFrame([(i, {"x": x, "y": y, "z": z} if z is not None else None) for i, (z, y, x) in enumerate(points)], "i int, Mapped_Coordinates struct<x:bigint,y:bigint,z:bigint>")
    lookup = spark.createDataFrame([(2, 20)], "seg_id bigint, label bigint")
    got = {r.i: (r.target_id, r.label) for r in proof.point_lookup_array(table, str(path), lookup).collect()}
    label = lambda v: 20 if v == 2 else -1
    for i, point in enumerate(points):
        known = None not in point and all(0 <= p < n for p, n in zip(point, SHAPE))
        value = int(volume[point]) if known else -1
        assert got[i] == (value, label(value))
    assert proof.point_lookup_array(table.limit(0), str(path), lookup).count() == 0
