import gzip
import json
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera import cli
from tessera.functions import grid, scalars
from tessera.operators import convert, fetch, proof, tasks
from tessera.sources import arrays, blocks, precomputed, text, xlsx, zarr2
from tessera.streaming.changelog import edges_at, follow_changes


def dense(df, shape, dtype="int64"):
    out = np.zeros(shape, dtype)
    for r in df.collect():
        part = blocks.as_array(r)
        out[tuple(slice(int(s), int(s) + n) for s, n in zip(r.starts, part.shape))] = part
    return out


@pytest.fixture(scope="module")
def volume():
    return np.random.default_rng(4).integers(0, 5, size=(5, 7, 9)).astype("uint16")


def stored(spark, volume, path, chunk=(2, 3, 4), compressor=None):
    np.save(f"{path}.npy", volume)
    arrays.register(spark)
    df = spark.read.format("npy").option("chunk", ",".join(map(str, chunk))).load(f"{path}.npy")
    zarr2.create(path, volume.shape, list(chunk), volume.dtype.name, compressor)
    zarr2.write_blocks(df, path).count()
    return path


@pytest.mark.parametrize("compressor", [None, {"id": "zlib", "level": 2}, {"id": "gzip", "level": 1}, {"id": "zstd", "level": 1}])
def test_zarr_round_trip(spark, volume, tmp_path, compressor):
    path = stored(spark, volume, str(tmp_path / "v"), compressor=compressor)
    assert np.array_equal(dense(zarr2.read_blocks(spark, path), volume.shape), volume)
    assert zarr2.read_blocks(spark, path, box=[(0, 2), (3, 6), (8, 9)]).count() == 1


def test_npy_odd_axes_are_copied_whole(spark, volume, tmp_path):
    np.save(tmp_path / "a.npy", volume)
    result = convert.npy_to_array(spark, str(tmp_path / "a.npy"), str(tmp_path / "z"), chunk=(2, 7, 5))
    assert result["chunks_written"] == result["chunks_total"] == 6
    df = zarr2.read_blocks(spark, str(tmp_path / "z"))
    assert np.array_equal(dense(df, volume.shape), volume)
    arrays.write_npy(df, str(tmp_path / "b.npy"), list(volume.shape), "uint16")
    assert np.array_equal(np.load(tmp_path / "b.npy"), volume)


def test_tiff_round_trip(spark, volume, tmp_path):
    mask = (volume > 2).astype("uint8")
    path = stored(spark, mask, str(tmp_path / "m"))
    arrays.write_mask_tiff(zarr2.read_blocks(spark, path), str(tmp_path / "m.tif"), list(mask.shape))
    convert.tiff_to_array(spark, str(tmp_path / "m.tif"), str(tmp_path / "back"), chunk=(2, 3, 9))
    assert np.array_equal(dense(zarr2.read_blocks(spark, str(tmp_path / "back")), mask.shape), mask * 255)


def test_blocks_to_voxels_and_back(spark, volume, tmp_path):
    path = stored(spark, volume, str(tmp_path / "v"))
    voxels = blocks.to_voxels(zarr2.read_blocks(spark, path))
    assert voxels.count() == np.count_nonzero(volume)
    again = blocks.to_blocks(voxels, list(volume.shape), [4, 4, 4], "uint16")
    assert np.array_equal(dense(again, volume.shape), volume)
    again = blocks.rechunk(zarr2.read_blocks(spark, path), list(volume.shape), [3, 7, 5])
    assert np.array_equal(dense(again, volume.shape), volume)
    with pytest.raises(Exception, match="outside uint8"):
        blocks.to_blocks(voxels.withColumn("seg_id", F.lit(300)), [5, 7, 9], [4, 4, 4], "uint8").count()


def test_catalog_and_resolve(spark, volume, tmp_path):
    stored(spark, volume, str(tmp_path / "img"))
    (tmp_path / ".zgroup").write_text("{}")
    rows = zarr2.catalog(spark, str(tmp_path)).collect()
    assert [(r.path, r.shape, r.dtype, r.layer) for r in rows] == [("img", [5, 7, 9], "uint16", "segmentation")]
    assert zarr2.resolve(str(tmp_path), "img").endswith("img")
    with pytest.raises(ValueError):
        zarr2.resolve(str(tmp_path))
    with pytest.raises(KeyError):
        zarr2.resolve(str(tmp_path), "nothing")


def test_precomputed_files(spark, volume, tmp_path):
    path = stored(spark, volume, str(tmp_path / "v"))
    out = convert.array_to_precomputed(spark, path, str(tmp_path / "pre"), voxel_offset=(10, 0, 0))
    assert (out["written"], out["failed"]) == (27, 0)
    info = json.loads((tmp_path / "pre" / "info").read_text())
    assert info["type"] == "segmentation" and info["scales"][0]["size"] == [9, 7, 5]
    raw = gzip.decompress((tmp_path / "pre" / "8_8_8" / "14-18_3-6_0-2.gz").read_bytes())
    assert np.array_equal(np.frombuffer(raw, "<u2").reshape(2, 3, 4), volume[0:2, 3:6, 4:8])
    assert precomputed.layer("uint8") == precomputed.layer("float32") == "image"


def test_normalize_resample_relabel_arrays(spark, tmp_path):
    raw = np.random.default_rng(0).integers(34000, 37000, size=(4, 6, 6)).astype("uint16")
    path = stored(spark, raw, str(tmp_path / "raw"), chunk=(2, 3, 3))
    convert.normalize_array(spark, path, str(tmp_path / "u8"), chunks=(4, 4, 4))
    expected = ((np.clip(raw.astype(float), 34939, 36096) - 34939) / (36096 - 34939) * 255).astype("uint8")
    assert np.array_equal(dense(zarr2.read_blocks(spark, str(tmp_path / "u8")), raw.shape), expected)
    convert.resample_array(spark, path, str(tmp_path / "half"), (2, 2, 2))
    pick = [np.floor(np.arange(m) * (n - 1) / (m - 1) + 0.5).astype(int) for n, m in ((4, 2), (6, 3), (6, 3))]
    assert np.array_equal(dense(zarr2.read_blocks(spark, str(tmp_path / "half")), (2, 3, 3)), raw[np.ix_(*pick)])
    seg = stored(spark, (raw % 4).astype("uint32"), str(tmp_path / "seg"), chunk=(2, 3, 3))
    lookup = spark.createDataFrame([(1, 10), (2, 20)], "seg_id bigint, label bigint")
    valid = spark.createDataFrame([(20,)], "label bigint")
    convert.relabel_array(spark, seg, str(tmp_path / "lab"), str(tmp_path / "fil"), lookup, valid)
    assert np.array_equal(dense(zarr2.read_blocks(spark, str(tmp_path / "lab")), raw.shape), np.array([0, 10, 20, 0])[raw % 4])
    assert np.array_equal(dense(zarr2.read_blocks(spark, str(tmp_path / "fil")), raw.shape), np.array([0, 0, 20, 0])[raw % 4])


def test_failing_chunks_fail_the_job_unless_tolerated(spark):
    def service(offset, size, mag):
        if offset[2] >= 4:
            raise OSError("gone")
        return np.full([s // mag for s in size[::-1]], 3)

    with pytest.raises(Exception, match="could not be fetched"):
        fetch.fetch_volume(spark, (8, 4, 4), (4, 4, 2), service, mag=2).collect()
    df = fetch.fetch_volume(spark, (8, 4, 4), (4, 4, 2), service, mag=2, tolerant=True)
    got = dense(df.where("error is null").drop("error"), (4, 2, 2))
    assert (got[:2] == 3).all() and (got[2:] == 0).all()
    failed = df.where("error is not null").collect()
    assert len(failed) == 2 and all(r.starts[0] == 2 and r.data is None and "gone" in r.error for r in failed)
    with pytest.raises(ValueError):
        fetch.fetch_volume(spark, (5, 4, 4), (4, 4, 2), service, mag=2)


def test_map_blocks_with_two_outputs(spark, volume, tmp_path):
    df = zarr2.read_blocks(spark, stored(spark, volume, str(tmp_path / "v")))
    out = tasks.map_blocks(df, {"twice": lambda a: a * 2, "mask": lambda a: a > 1})
    row = out.where("idx = array(0L, 0L, 0L)").first()
    part = volume[:2, :3, :4]
    assert np.array_equal(np.frombuffer(row.twice_data, row.twice_dtype).reshape(part.shape), part * 2)
    assert np.array_equal(np.frombuffer(row.mask_data, row.mask_dtype).reshape(part.shape), part > 1)


def test_run_tasks_logs_and_reruns(spark):
    chunks = grid.chunk_grid(spark, [10], [3])

    def work(row):
        if row["chunk_id"] == 2:
            raise ValueError("broken")

    log = tasks.run_tasks(chunks, work).persist()
    assert {r.task_id: r.status for r in log.collect()} == {0: "completed", 1: "completed", 2: "failed", 3: "completed"}
    assert [r.chunk_id for r in tasks.pending(chunks, log).collect()] == [2]
    assert [r.chunk_id for r in tasks.failed(chunks, log).collect()] == [2]
    assert tasks.summary(chunks, log).first().asDict() == {
        "total_tasks": 4, "completed_tasks": 3, "failed_tasks": 1, "pending_tasks": 0
    }


def test_chunk_grid_tiles_exactly(spark):
    shape, chunk = [5, 7, 9], [2, 3, 4]
    seen = np.zeros(shape, int)
    rows = grid.chunk_grid(spark, shape, chunk).orderBy("chunk_id").collect()
    for r, idx in zip(rows, np.ndindex(3, 3, 3)):
        assert tuple(r.idx) == idx
        seen[tuple(slice(a, b) for a, b in zip(r.starts, r.stops))] += 1
    assert (seen == 1).all()


@pytest.mark.parametrize(
    "raw, point", [("1,2,3", (1, 2, 3)), (" 4, 5 ,6 px", (4, 5, 6)), ("-7,0,2um", (-7, 0, 2)), ("1,2", None), ("a,b,c", None), (None, None)]
)
def test_coordinates(spark, raw, point):
    df = spark.createDataFrame([(raw,)], "c string")
    row = df.select(scalars.parse_coordinate(F.col("c"), strict=False).alias("p")).first()
    assert (tuple(row.p) if row.p else None) == point
    if point is None:
        with pytest.raises(Exception, match="invalid coordinate"):
            df.select(scalars.parse_coordinate(F.col("c"))).collect()
    else:
        half = df.select(scalars.downsample_point(scalars.parse_coordinate(F.col("c")), 2).alias("p")).first()
        assert tuple(half.p) == tuple(v // 2 for v in point)


def workbook(path, sheets):
    def cell(i, j, v):
        ref = f"{chr(65 + j)}{i + 1}"
        return f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>' if isinstance(v, str) else f'<c r="{ref}"><v>{v}</v></c>' if v is not None else ""

    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    with zipfile.ZipFile(path, "w") as book:
        names = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets))
        book.writestr("xl/workbook.xml", f"<workbook {main} {rel}><sheets>{names}</sheets></workbook>")
        links = "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(len(sheets)))
        book.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{links}</Relationships>")
        for i, rows in enumerate(sheets.values()):
            data = "".join(f"<row>{''.join(cell(r, c, v) for c, v in enumerate(row))}</row>" for r, row in enumerate(rows))
            book.writestr(f"xl/worksheets/s{i}.xml", f"<worksheet {main}><sheetData>{data}</sheetData></worksheet>")


def test_workbook_to_processed_table(spark, tmp_path):
    path = str(tmp_path / "proof.xlsx")
    header = ["redmine number", "Cell Name", "coordinate", "client status"]
    workbook(path, {"A": [header, [1, "n1", "4,5,6", "complete"], [2, "n2", "1,1,1 px", "Complete"]], "B": [["coordinate"], ["1,2,3"]],
                    "C": [["coordinate", "client status"], ["7,8,9um", "complete"]]})
    sheets = xlsx.read_workbook(spark, path)
    table = proof.filter_client(spark, sheets, ["C", "A", "B", "missing"])
    rows = {r["Zone Info"]: r for r in table.collect()}
    assert set(rows) == {"A", "C"} and rows["A"]["Redmine Number"] == "1" and rows["C"]["Cell Name"] is None
    voxels = spark.createDataFrame([(6, 5, 4, 11)], "z bigint, y bigint, x bigint, seg_id bigint")
    lookup = spark.createDataFrame([(11, 901)], "seg_id bigint, label bigint")
    done = proof.point_lookup(proof.map_coordinates(table), voxels, lookup)
    assert {r["Zone Info"]: (r.target_id, r.label) for r in done.collect()} == {"A": (11, 901), "C": (-1, -1)}
    out = proof.save_table(proof.downsample_coordinates(done), str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(out).where("Downsampled_Coordinate_2 = '(2, 2, 3)'").count() == 1
    with pytest.raises(ValueError):
        proof.save_table(proof.filter_client(spark, sheets, ["B"]), str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        xlsx.read_workbook(spark, str(tmp_path / "no.xlsx"))


def test_text_sources(spark, tmp_path):
    (tmp_path / "c.tsv").write_text("+\t1\t2\n-\t\t3\nx\t4\t5\n")
    rows = text.read_changelog(spark, str(tmp_path / "c.tsv")).orderBy("line_no").collect()
    assert [tuple(r) for r in rows] == [(0, "+", 1, 2), (1, "-", None, 3), (2, "x", 4, 5)]
    (tmp_path / "m.txt").write_text("1 0 0 10 11\n0 0 0\n\n\n2 0 0 11 12\n0 0 0\n\n\n")
    got = {r.sub_id: r.obj_id for r in text.read_mergelist(spark, str(tmp_path / "m.txt")).collect()}
    assert got == {10: 1, 11: 2, 12: 2}
    (tmp_path / "i.txt").write_text("5 6\n\n 6 7\n")
    assert sorted(r.seg_id for r in text.read_id_list(spark, str(tmp_path / "i.txt")).collect()) == [5, 6, 7]


def test_line_numbers_over_many_splits(spark, tmp_path):
    (tmp_path / "big.tsv").write_text("".join(f"+\t{i}\t{i + 1}\n" for i in range(20000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert spark.read.text(str(tmp_path / "big.tsv")).rdd.getNumPartitions() > 4
        lines = text.read_changelog(spark, str(tmp_path / "big.tsv"))
        assert lines.where("line_no = v1").count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_followed_log(spark, tmp_path):
    graph, folder = str(tmp_path / "g"), tmp_path / "log"
    folder.mkdir()
    spark.createDataFrame([(i, i) for i in range(5)], "vid bigint, seg_id bigint").write.parquet(f"{graph}/vertices")
    spark.createDataFrame([(0, 1, 1)], "src bigint, dst bigint, mult bigint").write.parquet(f"{graph}/edges")
    for number, lines in enumerate(["+\t1\t2\n-\t0\t1\n", "+\t3\t4\n-\t1\t2\n"]):
        (folder / f"{number}.tsv").write_text(lines)
        query = follow_changes(spark, str(folder), graph, str(tmp_path / "cp"))
        query.awaitTermination(120)
    assert [tuple(r) for r in edges_at(spark, graph, 0).collect()] == [(1, 2, 1)]
    assert [tuple(r) for r in edges_at(spark, graph, 1).collect()] == [(3, 4, 1)]


def test_command_line(spark, tmp_path, capsys):
    v = np.zeros((6, 6, 6), "uint32")
    v[1:5, 1:5, 1:5] = 7
    v[2, 2, 2] = 0
    path = stored(spark, v, str(tmp_path / "seg"), chunk=(3, 3, 3))
    assert cli.main(["fix", path, str(tmp_path / "fixed"), "--method", "none", "--fill-holes", "--remove-small", "5"]) == 0
    assert json.loads(capsys.readouterr().out)["final_objects"] == 1
    assert dense(zarr2.read_blocks(spark, str(tmp_path / "fixed")), v.shape)[2, 2, 2] == 7
    assert cli.main(["bbox", path, str(tmp_path / "boxes")]) == 0
    assert spark.read.parquet(str(tmp_path / "boxes" / "boxes")).first()["z1"] == 5
    assert cli.main(["info", str(tmp_path)]) == 0
    assert cli.main(["convert", "normalize", str(tmp_path / "nope"), str(tmp_path / "o")]) == 1
    with pytest.raises(SystemExit):
        cli.main(["convert", "resample", path, "o", "--factors", "a,b"])
