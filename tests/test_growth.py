"""What grows with a volume: rows shuffled, partitions of a scan, cells of a group."""


import numpy as np
import pyarrow as pa
import pytest

from tessera.operators import distance, fuse, stencil
from tessera.sources import arrays, blocks, chunkfiles, zarr2


def dense(spark, n, plane=(4, 4)):
    """A volume whose cells are all stored."""
    cells = spark.range(n * plane[0] * plane[1])
    y, x = plane
    return cells.selectExpr(f"id div {y * x} as z", f"id div {x} % {y} as y", f"id % {x} as x", "id * 7 % 11 + 1 as seg_id")


def shuffled_rows(spark, df) -> int:
    """Rows that all stages of this job hand to a shuffle."""
    def stages():
        jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        none, store = jvm.java.util.ArrayList(), spark.sparkContext._jsc.sc().statusStore()
        found = store.stageList(none, False, False, gateway.new_array(jvm.double, 0), none)
        return {found.apply(i).stageId(): found.apply(i).shuffleWriteRecords() for i in range(found.size())}

    before = stages()
    df.write.format("noop").mode("overwrite").save()
    return sum(n for k, n in stages().items() if k not in before)


def test_upsampling_shuffles_cells_not_shares(spark):
    volume = dense(spark, 64, (16, 16))
    out = fuse.resample(volume, (64, 16, 16), (0.5, 0.5, 0.4), "linear", "seg_id")
    assert shuffled_rows(spark, out) < 3 * 64 * 16 * 16


def test_strong_downsampling_reads_only_cells_it_needs(spark):
    volume = dense(spark, 301, (2, 2))
    out = fuse.resample(volume, (301, 2, 2), (100, 1, 1), "linear", "seg_id").orderBy("z", "y", "x")
    values = {(r.z, r.y, r.x): r.seg_id for r in volume.collect()}
    expected = [(z, y, x, float(values[z * 150, y, x])) for z in range(3) for y in range(2) for x in range(2)]
    assert [tuple(r) for r in out.collect()] == expected


def test_scans_have_runs_of_chunks(spark, tmp_path):
    path = str(tmp_path / "a.npy")
    np.save(path, np.arange(1, 40_001, dtype=np.uint32).reshape(10_000, 2, 2))
    arrays.register(spark)
    found = spark.read.format("npy").option("chunk", "1,2,1").load(path)
    assert found.rdd.getNumPartitions() <= 2 * blocks.LEAST_PARTITIONS
    cells = blocks.to_voxels(found)
    assert cells.where("seg_id <> z * 4 + y * 2 + x + 1").isEmpty() and cells.count() == 40_000
    # large chunks, and grids of few, are dealt one by one
    assert blocks.chunks_together(10**5, 64 << 20) == 2 and blocks.chunks_together(100, 8) == 1 and blocks.chunks_together(10**6, 2048) == 1024


@pytest.mark.parametrize("big", [True, False])
def test_page_headers_written_by_tasks(spark, tmp_path, big):
    path, n = str(tmp_path / "a.tif"), arrays.PAGES_TOGETHER + 5
    volume = spark.createDataFrame([(0, 0, 0, 1), (arrays.PAGES_TOGETHER, 1, 2, 1), (n - 1, 1, 1, 1)], "z long, y long, x long, seg_id long")
    arrays.write_mask_tiff(blocks.to_blocks(volume, [n, 2, 3], [64, 2, 3], "uint8"), path, [n, 2, 3], big=big)
    places = arrays.tiff_places(path)
    assert len(places) == n and len(set(np.diff(places).tolist())) == 1
    arrays.register(spark)
    read = blocks.to_voxels(spark.read.format("tiffstack").option("chunk", "7,1,2").load(path), "val").orderBy("z")
    assert [tuple(r) for r in read.collect()] == [(0, 0, 0, 255.0), (arrays.PAGES_TOGETHER, 1, 2, 255.0), (n - 1, 1, 1, 255.0)]


def test_distance_along_cut_lines(spark):
    rng = np.random.default_rng(5)
    # long runs, some of them beyond the halo, and one line of a single label
    ids = np.repeat(rng.integers(0, 3, (30, 3, 2)), 9, axis=0)
    ids[:, 0, 0], ids[100:260] = 1, 2
    volume = spark.createDataFrame([(int(z), int(y), int(x), int(ids[z, y, x])) for z, y, x in zip(*np.nonzero(ids))], "z long, y long, x long, seg_id long")
    rows = lambda df: sorted(map(tuple, df.collect()))
    whole = rows(distance.squared_distance(volume, ids.shape))
    assert rows(distance.squared_distance(volume, ids.shape, piece=16, halo=4)) == whole and len(whole) == np.count_nonzero(ids)


@pytest.mark.parametrize("factor", [0.4, 1, 3, 50])
def test_cubic_along_cut_lines(spark, factor):
    volume = dense(spark, 411, (2, 2)).where("z % 5 <> 1 and z < 390")
    cells = lambda piece: {(r.z, r.y, r.x): r.seg_id for r in fuse.resample(volume, (411, 2, 2), (factor, 1, 1), "cubic", "seg_id", piece).collect()}
    whole, cut = cells(1000), cells(16)
    assert max(abs(whole.get(k, 0) - cut.get(k, 0)) for k in whole | cut) < 1e-9


def test_groups_of_a_pass_are_bounded(spark):
    volume = dense(spark, 6000, (8, 8)).selectExpr("z", "y", "x", "cast(seg_id as double) as val")
    cells = stencil.line_pass(volume, "z", lambda lines: np.full((len(lines), 1), float(lines.size)), 6000, {"val": 0.0})
    assert cells.where(f"val > {stencil.GROUP_CELLS}").isEmpty() and cells.count() == 64


def test_small_chunks_share_batches(spark, tmp_path):
    shape, chunk = [64, 8, 8], [1, 2, 2]
    volume = dense(spark, 64, (8, 8)).where("z % 3 > 0 or y < 2")
    expected = sorted(map(tuple, volume.collect()))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # blocks go on in the next batch
    try:
        cells = blocks.to_blocks(volume, shape, chunk, "uint32").persist()
        cells.count()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    path = str(tmp_path / "a")
    zarr2.create(path, shape, chunk, "uint32")
    stored = len({(z, y // 2, x // 2) for z, y, x, _ in expected})
    assert zarr2.write_blocks(cells, path).count() == cells.count() == stored
    cells.unpersist()
    reader = zarr2.ZarrReader(path, zarr2.read_blocks(spark, path).schema)
    sizes = [[b.num_rows for b in reader.read(p)] for p in reader.partitions()]
    assert max(map(len, sizes)) == 1 and sum(map(sum, sizes)) == stored
    assert sorted(map(tuple, blocks.to_voxels(zarr2.read_blocks(spark, path)).collect())) == expected
    # large blocks leave one by one
    rows = [([0], [0], [1], "uint8", bytes(blocks.BATCH_BYTES))] * 3
    assert [b.num_rows for b in blocks.in_batches(rows, blocks.BLOCK_ARROW)] == [1, 1, 1]


def test_tasks_write_in_folders_of_their_own(tmp_path, monkeypatch):
    system, folder = chunkfiles.open_folder(str(tmp_path / "a"))
    opened = []

    class Watched:
        def open_output_stream(self, path):
            opened.append(path.rpartition("/")[0])
            return system.open_output_stream(path)

        def __getattr__(self, name):
            return getattr(system, name)

    monkeypatch.setattr(chunkfiles, "open_folder", lambda path: (Watched(), folder))
    files = {f"{k}.0": bytes([k] * 9) for k in range(20)} | {"deep/0/1": b"x"}
    for _ in range(2):  # a repeated task does no harm
        chunkfiles.ChunkWriter(folder, "run").write(iter([pa.record_batch({"name": [*files], "data": [*files.values()]})]))
    # the shared folder holds no partial file at any time, and none is left
    assert folder not in opened and len(set(opened)) == 3
    assert {n: chunkfiles.read_file(folder, n) for n in files} == files
    assert [p for p in (tmp_path / "a" / "_partial").rglob("*")] == []
    assert len([*(tmp_path / "a" / "_finished" / "run").iterdir()]) == 2
