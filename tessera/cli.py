"""Command line: ``python -m tessera <command>``; exit status 0 or 1."""

from __future__ import annotations

import argparse
import json
import sys

from .operators.tasks import timed


def numbers(text: str) -> tuple[int, ...]:
    try:
        return tuple(int(part) for part in text.split(","))
    except ValueError as exc:
        raise argparse.ArgumentTypeError(f"expected integers separated by commas, got {text!r}") from exc


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tessera", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    convert = commands.add_parser("convert", help="convert between array formats")
    convert.add_argument("kind", choices=["normalize", "resample", "precomputed", "npy", "tiff"])
    convert.add_argument("input")
    convert.add_argument("output")
    convert.add_argument("--chunk-size", type=numbers)
    convert.add_argument("--low", type=int)
    convert.add_argument("--high", type=int)
    convert.add_argument("--factors", type=numbers, default=(2, 2, 2))
    convert.add_argument("--method", default="nearest")
    convert.add_argument("--encoding", choices=["raw", "compressed_segmentation"], default="raw")
    convert.add_argument("--resolution", type=numbers, default=(8, 8, 8))
    convert.add_argument("--voxel-offset", type=numbers, default=(0, 0, 0))

    process = commands.add_parser("process", help="relabel and filter an array")
    for name in ("input", "output", "filtered"):
        process.add_argument(name)
    process.add_argument("--lookup", required=True, help="Parquet with seg_id, label")
    process.add_argument("--labels", required=True, help="Parquet whose first column lists valid labels")

    bbox = commands.add_parser("bbox", help="bounding boxes and adjacency of the labels")
    bbox.add_argument("input")
    bbox.add_argument("output")
    bbox.add_argument("--labels", help="Parquet whose first column lists the wanted labels")

    fix = commands.add_parser("fix", help="repair a segmentation")
    fix.add_argument("input")
    fix.add_argument("output")
    fix.add_argument("--method", choices=["erosion", "watershed", "watershed_elongation", "none"], default="watershed_elongation")
    fix.add_argument("--connectivity", type=int, choices=[6, 18, 26], default=26)
    fix.add_argument("--min-size", type=int, default=100)
    fix.add_argument("--iterations", type=int, default=1)
    fix.add_argument("--h-min", type=float, default=3)
    fix.add_argument("--smoothing", type=float, default=1)
    fix.add_argument("--remove-small", type=int, metavar="SIZE")
    fix.add_argument("--fill-holes", action="store_true")

    merge = commands.add_parser("merge-nuclei", help="cell labels where nuclei are present")
    for name in ("cells", "nuclei", "output"):
        merge.add_argument(name)
    merge.add_argument("--factor", type=int, default=2)

    info = commands.add_parser("info", help="arrays of a store and how a viewer would show them")
    info.add_argument("input")
    return parser


def _convert(spark, args):
    from .operators import convert

    if args.kind == "normalize":
        limits = {k: v for k, v in (("low", args.low), ("high", args.high)) if v is not None}
        return convert.normalize_array(spark, args.input, args.output, chunks=args.chunk_size, **limits)
    if args.kind == "resample":
        return convert.resample_array(spark, args.input, args.output, args.factors, args.method, args.chunk_size)
    if args.kind == "precomputed":
        return convert.array_to_precomputed(spark, args.input, args.output, args.resolution, args.voxel_offset, args.encoding)
    run = convert.npy_to_array if args.kind == "npy" else convert.tiff_to_array
    return run(spark, args.input, args.output, args.chunk_size)


def _process(spark, args):
    from .operators import convert

    return convert.relabel_array(
        spark, args.input, args.output, args.filtered, spark.read.parquet(args.lookup), spark.read.parquet(args.labels)
    )


def _voxels(spark, path):
    from .sources import zarr2
    from .sources.blocks import to_voxels

    return to_voxels(zarr2.read_blocks(spark, path)), zarr2.read_meta(path)


def _bbox(spark, args):
    from .operators import morphology, shape
    from .session import materialize

    voxels, _ = _voxels(spark, args.input)
    voxels = materialize(voxels)
    only = spark.read.parquet(args.labels) if args.labels else None
    shape.bounding_boxes(voxels, only=only).write.mode("overwrite").parquet(f"{args.output}/boxes")
    morphology.label_adjacency(voxels).write.mode("overwrite").parquet(f"{args.output}/adjacency")
    return {"output_path": args.output}


def _fix(spark, args):
    from .operators import convert, morphology, watershed
    from .session import materialize

    voxels, meta = _voxels(spark, args.input)
    voxels, size = materialize(voxels), tuple(meta["shape"])
    before = voxels.select("seg_id").distinct().count()
    if args.method == "erosion":
        split = morphology.split_by_erosion(voxels, size[1:], args.iterations, args.connectivity, args.min_size)
    elif args.method == "watershed":
        split = watershed.split_by_watershed(voxels, size, args.h_min, args.min_size, args.smoothing)[0]
    elif args.method == "watershed_elongation":
        split = watershed.split_by_watershed_elongation(
            voxels, size, args.connectivity, args.min_size, h=args.h_min, smoothing=args.smoothing
        )[0]
    else:
        split = voxels.withColumnRenamed("seg_id", "new_label")
    fixed = split.where("new_label <> 0").selectExpr("z", "y", "x", "new_label as seg_id")
    if args.remove_small:
        fixed = morphology.remove_small(materialize(fixed), args.remove_small)
    if args.fill_holes:
        fixed = morphology.fill_holes(materialize(fixed), size)
    fixed = materialize(fixed)
    after = fixed.select("seg_id").distinct().count()
    result = convert.voxels_to_array(fixed, args.output, size, meta["chunks"], "uint32")
    return {**result, "initial_objects": before, "final_objects": after, "objects_added": after - before}


def _merge(spark, args):
    from .operators import convert

    return convert.merge_nuclei_arrays(spark, args.cells, args.nuclei, args.output, args.factor)


def _info(spark, args):
    from .sources import zarr2

    return [row.asDict() for row in zarr2.catalog(spark, args.input).collect()]


COMMANDS = {"convert": _convert, "process": _process, "bbox": _bbox, "fix": _fix, "merge-nuclei": _merge, "info": _info}


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    from .session import build_session

    try:
        with timed(args.command, lambda line: print(line, file=sys.stderr)):
            print(json.dumps(COMMANDS[args.command](build_session(), args), default=str))
    except Exception as exc:
        print(f"{args.command} failed: {exc}", file=sys.stderr)
        return 1
    return 0
