"""The registered queries and, where SQL can say it, the same result in SQL."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import grid, scalars
from ..operators import changelog, convert, dictionary, distance, fuse, graph, morphology, proof, relabel, shape, tasks, watershed
from ..session import configure, materialize, work_dir
from ..sources import arrays, blocks, precomputed, text, zarr2
from ..streaming import changelog as stream
from . import fixtures as fx
from . import flood_sql

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


class Tables:
    """The driver tables of one directory, and SQL-derived sets over them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = configure(spark), sf_dir

    def __call__(self, text: str) -> DataFrame:
        """Run SQL text whose table names mean this directory's Parquet files."""
        def scan(match):
            return f"{match[1]} parquet.`{self.sf_dir}/{match[2]}.parquet`"

        return self.spark.sql(re.sub(rf"\b(from|join)\s+({'|'.join(TABLES)})\b", scan, text))


def query(check: str | None = None):
    """Register a function ``f(tables)`` under its own name, with its check in SQL."""

    def register(function):
        name = function.__name__
        QUERIES[name] = lambda spark, sf_dir: function(Tables(spark, sf_dir))
        if check:
            CHECKS[name] = check
        return function

    return register


# --- relabelling and filtering -------------------------------------------------

_RELABELLED = f"""with vox as ({fx.VOXELS}), lk as ({fx.LOOKUP}), ok as ({fx.VALID_LABELS})
select z, y, x, vox.seg_id, coalesce(lk.label, 0) as label, coalesce(ok.label, 0) as filtered
from vox left join lk on vox.seg_id = lk.seg_id left join ok on lk.label = ok.label"""


@query(_RELABELLED)
def relabel_filter(t: Tables) -> DataFrame:
    return relabel.relabel_and_filter(t(fx.VOXELS), t(fx.LOOKUP), t(fx.VALID_LABELS))


@query(f"select z, y, x, seg_id, label from ({_RELABELLED}) r")
def relabel_only(t: Tables) -> DataFrame:
    return relabel.relabel(t(fx.VOXELS), t(fx.LOOKUP))


@query(f"""with ok as ({fx.VALID_LABELS}) select z, y, x, v.label, coalesce(ok.label, 0) as filtered
from (select z, y, x, 900 + seg_id % 50 as label from ({fx.VOXELS}) s) v left join ok on v.label = ok.label""")
def label_filter(t: Tables) -> DataFrame:
    voxels = t(fx.VOXELS).select("z", "y", "x", (900 + F.col("seg_id") % 50).alias("label"))
    return relabel.keep_labels(voxels, t(fx.VALID_LABELS))


@query(f"""select z, y, x, v.seg_id, case when i.seg_id is not null and v.seg_id <> 0 then 1 else 0 end as mask
from ({fx.VOXELS}) v left join ({fx.ID_LIST}) i on v.seg_id = i.seg_id""")
def mask_from_ids(t: Tables) -> DataFrame:
    return relabel.mask_from_ids(t(fx.VOXELS), t(fx.ID_LIST))


@query(f"select count(distinct z) as done, max(z) + 1 as total from ({fx.SEGMENTS}) s")
def relabel_progress(t: Tables) -> DataFrame:
    voxels = t(fx.SEGMENTS)
    shape = morphology.extent(voxels)
    return relabel.relabel_progress(voxels, list(shape), [1, 16, 16])


# --- proofreading --------------------------------------------------------------

ZONES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "no such sheet"]
_ZONES_SQL = ", ".join(f"'{z}'" for z in ZONES)


def _sheets(t: Tables) -> dict[str, DataFrame]:
    """One frame per sheet, as a workbook would give them."""
    rows = t(fx.SHEETS)
    names = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    return {
        name: rows.where(F.col("zone") == name).select(
            F.col("redmine").alias("redmine number"),
            F.col("cell").alias("Cell Name"),
            "coordinate",
            F.col("client_status").alias("client status"),
            F.col("qa_status").alias("qa status"),
        )
        for name in names
    }


def _plain(table: DataFrame) -> DataFrame:
    """Snake-case names, so that both engines spell the columns alike."""
    return table.toDF(*[c.lower().replace(" ", "_") for c in table.columns])


@query(f"""select redmine as redmine_number, cell as cell_name, coordinate, client_status, zone as zone_info
from ({fx.SHEETS}) s where client_status = 'complete' and zone in ({_ZONES_SQL})""")
def proof_filter_client(t: Tables) -> DataFrame:
    return _plain(proof.filter_client(t.spark, _sheets(t), ZONES))


@query(f"""select redmine as redmine_number, cell as cell_name, coordinate, qa_status, zone as zone_info
from ({fx.SHEETS}) s where qa_status = 'QA is completed' and zone in ({_ZONES_SQL})""")
def proof_filter_qa(t: Tables) -> DataFrame:
    return _plain(proof.filter_qa(t.spark, _sheets(t), ZONES, "qa status"))


_PARSED = f"""select redmine, coordinate, case when len(p) = 3 then cast(trim(p[1]) as bigint) end as px,
case when len(p) = 3 then cast(trim(p[2]) as bigint) end as py, case when len(p) = 3 then cast(trim(p[3]) as bigint) end as pz
from (select redmine, coordinate, string_split(trim(regexp_replace(coordinate, '[^\\d,\\s]+$', '')), ',') as p from ({fx.SHEETS}) s) q"""


def _parsed(t: Tables) -> DataFrame:
    table = t(fx.SHEETS).select("redmine", F.col("coordinate").alias("Coordinate"))
    return proof.map_coordinates(table, strict=False)


@query(_PARSED)
def coord_parse(t: Tables) -> DataFrame:
    point = F.col("Mapped_Coordinates")
    return _parsed(t).select(
        "redmine", F.col("Coordinate").alias("coordinate"), *[point[a].alias(f"p{a}") for a in "xyz"]
    )


@query(
    "select redmine, "
    + ", ".join(f"cast(floor(p{a} / {f}.0) as bigint) as {a}_{f}" for f in (2, 3, 4, 5) for a in "xyz")
    + f" from ({_PARSED}) p"
)
def coord_downsample(t: Tables) -> DataFrame:
    table = proof.downsample_coordinates(_parsed(t))
    return table.select(
        "redmine",
        *[F.col(f"Downsampled_Coordinate_{f}")[a].alias(f"{a}_{f}") for f in (2, 3, 4, 5) for a in "xyz"],
    )


_POINTS = """select o_orderkey as cell, o_custkey % 16 as px, cast(floor(o_totalprice) as bigint) % 16 as py,
cast(floor(o_orderkey / 60.0) as bigint) as pz from orders"""


@query(f"""with vox as ({fx.SEGMENTS}), lk as ({fx.LOOKUP}), p as ({_POINTS})
select cell, coalesce(vox.seg_id, -1) as target_id, coalesce(lk.label, -1) as label from p
left join vox on pz = z and py = y and px = x left join lk on lk.seg_id = vox.seg_id""")
def point_lookup(t: Tables) -> DataFrame:
    point = F.struct(*[F.col(f"p{a}").alias(a) for a in "xyz"]).alias("Mapped_Coordinates")
    cells = t(_POINTS).select("cell", point)
    return proof.point_lookup(cells, t(fx.SEGMENTS), t(fx.LOOKUP)).select("cell", "target_id", "label")


# --- scalars and grids ---------------------------------------------------------


@query(f"""select z, y, x, cast(floor((least(greatest(cast(val as double), 34939.0::double), 36096.0::double) - 34939.0::double)
/ 1157.0::double * 255.0::double) as smallint) as val from ({fx.INTENSITY}) i""")
def normalize_u8(t: Tables) -> DataFrame:
    return t(fx.INTENSITY).withColumn("val", scalars.normalize_u8(F.col("val")))


@query(f"""select array_id, dtype, cast(floor(nz * ny * nx * case dtype when 'uint8' then 1 when 'uint16' then 2 else 4 end * 3.0) as bigint) as bytes,
case when dtype in ('uint16', 'uint32') then 'segmentation' else 'image' end as layer from ({fx.ARRAYS}) a""")
def memory_estimate(t: Tables) -> DataFrame:
    return t(fx.ARRAYS).select(
        "array_id",
        "dtype",
        scalars.memory_estimate(F.array("nz", "ny", "nx"), F.col("dtype")).alias("bytes"),
        scalars.layer_type(F.col("dtype")).alias("layer"),
    )


@query("""select part_id, cast(list_extract(p, 1) as int) as a, cast(list_extract(p, 2) as int) as b, cast(list_extract(p, 3) as int) as c from (
select p_partkey as part_id, string_split(concat(cast(p_partkey as varchar), ', ', cast(p_size as varchar), ',', cast(p_size * 2 as varchar)), ',') as p from part) q""")
def parse_tuples(t: Tables) -> DataFrame:
    text = F.concat_ws(",", F.col("p_partkey"), F.concat(F.lit(" "), F.col("p_size")), F.col("p_size") * 2)
    values = scalars.parse_tuple(text)
    rows = t("select p_partkey, p_size from part").select(F.col("p_partkey").alias("part_id"), values.alias("v"))
    return rows.select("part_id", *[F.col("v")[i].alias(n) for i, n in enumerate("abc")])


_GRID = """with n as (select max(l_orderkey) + 1 as sz from lineitem), z as (select cast(unnest(range(0, cast(ceil(sz / 100.0) as bigint))) as bigint) as i, sz from n),
y as (select cast(unnest(range(0, 3)) as bigint) as j), x as (select cast(unnest(range(0, 2)) as bigint) as k)
select i * 6 + j * 2 + k as chunk_id, i as iz, j as iy, k as ix, i * 100 as z0, j * 7 as y0, k * 9 as x0,
least((i + 1) * 100, sz) as z1, least((j + 1) * 7, 16) as y1, least((k + 1) * 9, 16) as x1 from z, y, x"""


def _grid(t: Tables) -> tuple[list[int], list[int]]:
    top = t("select max(l_orderkey) + 1 as n from lineitem").first()[0]
    return [top, 16, 16], [100, 7, 9]


@query(_GRID)
def chunk_grid(t: Tables) -> DataFrame:
    rows = grid.chunk_grid(t.spark, *_grid(t))
    pick = lambda c, p, s="": [F.col(c)[i].alias(f"{p}{a}{s}") for i, a in enumerate("zyx")]
    bounds = [F.col(c)[i].alias(f"{a}{s}") for c, s in (("starts", 0), ("stops", 1)) for i, a in enumerate("zyx")]
    return rows.select("chunk_id", *pick("idx", "i"), *bounds)


@query("""select cast(floor(s / 128.0) as bigint) as batch, s as start, least(s + 128, n) as stop from (
select cast(unnest(range(0, n, 128)) as bigint) as s, n from (select count(*) as n from orders) c) r""")
def batch_ranges(t: Tables) -> DataFrame:
    return grid.batch_ranges(t.spark, t("select count(*) as n from orders").first()[0], 128)


_CHUNKS = [32, 12, 12]
_PROBE = """with v as ({src}), n as (select max(z) + 1 as sz from v), g as (select cast(unnest(range(0, cast(ceil(sz / 32.0) as bigint) * 4)) as bigint) as chunk_id from n)
select chunk_id, exists (select 1 from v where cast(floor(z / 32.0) * 4 + floor(y / 12.0) * 2 + floor(x / 12.0) as bigint) = chunk_id {cond}) as done from g"""


@query(_PROBE.format(src=f"select * from ({fx.SEGMENTS}) s where seg_id > 1", cond="and z % 32 < 10 and y % 12 < 10 and x % 12 < 10"))
def chunk_done_probe(t: Tables) -> DataFrame:
    voxels = t(fx.SEGMENTS).where("seg_id > 1")
    return grid.chunk_done_probe(voxels, list(morphology.extent(voxels)[:1]) + [16, 16], _CHUNKS)


@query(_PROBE.format(src=f"select * from ({fx.SEGMENTS}) s where seg_id > 1", cond=""))
def chunk_done_whole(t: Tables) -> DataFrame:
    voxels = t(fx.SEGMENTS).where("seg_id > 1")
    return grid.chunk_done_probe(voxels, list(morphology.extent(voxels)[:1]) + [16, 16], _CHUNKS, whole=True)


# --- tasks and logs ------------------------------------------------------------


@query(f"""select chunk_id from ({fx.TASKS}) t where not exists (
select 1 from ({fx.TASK_LOG}) l where l.task_id = t.chunk_id and l.status = 'completed')""")
def pending_tasks(t: Tables) -> DataFrame:
    return tasks.pending(t(fx.TASKS), t(fx.TASK_LOG))


@query(f"""select chunk_id from ({fx.TASKS}) t where exists (select 1 from ({fx.TASK_LOG}) l where l.task_id = t.chunk_id)
and not exists (select 1 from ({fx.TASK_LOG}) l where l.task_id = t.chunk_id and l.status = 'completed')""")
def failed_tasks(t: Tables) -> DataFrame:
    return tasks.failed(t(fx.TASKS), t(fx.TASK_LOG))


@query(f"""select count(*) as total_tasks, count(*) filter (where s = 'completed') as completed_tasks,
count(*) filter (where s = 'failed') as failed_tasks, count(*) filter (where s is null) as pending_tasks
from ({fx.TASKS}) t left join (select task_id, min(status) as s from ({fx.TASK_LOG}) l group by 1) m on task_id = chunk_id""")
def run_summary(t: Tables) -> DataFrame:
    return tasks.summary(t(fx.TASKS), t(fx.TASK_LOG))


_S = r"slice\((\d+), (\d+), None\)"
_RE = rf"\[{_S}, {_S}, {_S}\]"


@query(
    "select "
    + ", ".join(f"cast(regexp_extract(value, '{_RE}', {i + 1}) as bigint) as {n}" for i, n in enumerate("a0 a1 b0 b1 c0 c1".split()))
    + f""" from ({fx.ERROR_LOG}) l where (value like '%Error processing chunk%' or value like '%Failed to load segment%')
and regexp_matches(value, '{_RE}')"""
)
def retry_log_parse(t: Tables) -> DataFrame:
    return tasks.retry_list(t(fx.ERROR_LOG))


# --- change log ----------------------------------------------------------------

_LOG = f"""select line_no, op, v1, v2, a.vid as va, b.vid as vb from ({fx.CHANGES}) c
left join ({fx.LOG_VERTICES}) a on a.seg_id = v1 left join ({fx.LOG_VERTICES}) b on b.seg_id = v2"""
_LOG_VALID = f"""select line_no, op, least(va, vb) as src, greatest(va, vb) as dst from ({_LOG}) l
where op in ('+', '-') and va is not null and vb is not null"""
_LOG_BASE = f"""select least(src, dst) as src, greatest(src, dst) as dst, cast(sum(mult) as bigint) as base from ({fx.LOG_EDGES}) e
where src in (select vid from ({fx.LOG_VERTICES}) v) and dst in (select vid from ({fx.LOG_VERTICES}) v) group by 1, 2"""
# an actual fold over each edge's ordered operations
_LOG_FOLD = f"""select src, dst, list_reduce(list_prepend(base, ops), lambda c, o: case when o > 0 then greatest(c, 1) else greatest(c - 1, 0) end) as mult
from (select coalesce(l.src, e.src) as src, coalesce(l.dst, e.dst) as dst, cast(coalesce(base, 0) as bigint) as base, coalesce(ops, []) as ops from
(select src, dst, list(cast(case op when '+' then 1 else -1 end as bigint) order by line_no) as ops from ({_LOG_VALID}) v group by 1, 2) l
full join ({_LOG_BASE}) e on l.src = e.src and l.dst = e.dst) f"""


def _log(t: Tables):
    vertices = t(fx.LOG_VERTICES)
    return graph.known_edges(t(fx.LOG_EDGES), vertices), t(fx.CHANGES), vertices


@query(f"select src, dst, mult from ({_LOG_FOLD}) m where mult > 0")
def changelog_state(t: Tables) -> DataFrame:
    return changelog.apply_changes(*_log(t))


@query(f"""with recursive ops as (select src, dst, op, row_number() over (partition by src, dst order by line_no) as i from ({_LOG_VALID}) v),
run as (select o.src, o.dst, cast(0 as bigint) as i, cast(coalesce(base, 0) as bigint) as c, false as effective
from (select distinct src, dst from ops) o left join ({_LOG_BASE}) b on o.src = b.src and o.dst = b.dst
union all select r.src, r.dst, o.i, case when o.op = '+' then greatest(r.c, 1) else greatest(r.c - 1, 0) end,
case when o.op = '+' then r.c = 0 else r.c > 0 end from run r join ops o on o.src = r.src and o.dst = r.dst and o.i = r.i + 1)
select count(*) filter (where effective) as operations from run""")
def changelog_effective_count(t: Tables) -> DataFrame:
    lines = changelog.effective_changes(*_log(t), stretch=1000)
    return lines.agg(F.count_if("effective").alias("operations"))


@query(f"""select line_no, op, v1, v2, case when op not in ('+', '-') then 'invalid operation' when v1 is null or v2 is null then 'missing vertex id'
else 'unknown vertex id' end as reason from ({_LOG}) l where op not in ('+', '-') or va is null or vb is null""")
def changelog_rejects(t: Tables) -> DataFrame:
    _, changes, vertices = _log(t)
    return changelog.rejects(changes, vertices)


_G_VERTICES = fx.VERTICES
_G_EDGES = f"select src, dst, mult from ({fx.EDGES}) e where src in (select o_orderkey from orders) and dst in (select o_orderkey from orders)"


def _graph(t: Tables) -> graph.SegmentGraph:
    vertices = t(fx.VERTICES)
    return graph.SegmentGraph(vertices, materialize(graph.known_edges(t(fx.EDGES), vertices)))


@query(f"""with base as (select least(src, dst) as src, greatest(src, dst) as dst, cast(sum(mult) as bigint) as mult from ({_G_EDGES}) g group by 1, 2),
extra as (select distinct least(o_orderkey, o_custkey) as src, greatest(o_orderkey, o_custkey) as dst from orders)
select coalesce(b.src, x.src) as src, coalesce(b.dst, x.dst) as dst, coalesce(b.mult, 1) as mult
from base b full join extra x on b.src = x.src and b.dst = x.dst""")
def mergelist_apply(t: Tables) -> DataFrame:
    vertices = t(fx.VERTICES)
    return changelog.apply_mergelist(graph.known_edges(t(fx.EDGES), vertices), t(fx.MERGELIST), vertices)


# --- graph ---------------------------------------------------------------------

# smallest reachable vertex, found by repeated relaxation
_ROOTS = f"""with recursive links as materialized (select src as a, dst as b from ({_G_EDGES}) e where src <> dst union select dst, src from ({_G_EDGES}) e where src <> dst),
cc(vid, root) using key (vid) as (select o_orderkey, o_orderkey from orders
union select l.b, min(cc.root) from cc join links l on l.a = cc.vid join recurring.cc as old on old.vid = l.b where cc.root < old.root group by l.b)"""
_LABELS = f"""{_ROOTS}, ranked as (select vid, root, dense_rank() over (order by root) - 1 as component from cc),
total as (select count(distinct root) as n from cc)"""


@query(f"""{_LABELS} select vid * 2 + 1 as seg_id, cast(9 * power(10, length(cast(n as varchar))) as bigint) + component as label from ranked, total""")
def component_labels(t: Tables) -> DataFrame:
    return _graph(t).lookup()


@query(f"{_LABELS} select vid * 2 + 1 as seg_id, component as label from ranked")
def component_numbers(t: Tables) -> DataFrame:
    return _graph(t).lookup(prefixed=False)


@query(f"{_ROOTS} select vid * 2 + 1 as seg_id from cc where root = (select root from cc where vid = 777)")
def component_of(t: Tables) -> DataFrame:
    return _graph(t).component_of(777 * 2 + 1)


@query(f"""{_ROOTS}, sizes as (select root, count(*) as s from cc group by 1)
select (select count(*) from cc) as num_vertices, (select cast(sum(mult) as bigint) from ({_G_EDGES}) g) as num_edges, (select count(*) from sizes) as num_components,
(select max(s) from sizes) as largest_component_size,
2.0::double * (select cast(sum(mult) as double) from ({_G_EDGES}) g) / ((select cast(count(*) as double) from cc) * (select count(*) - 1.0::double from cc)) as density""")
def graph_stats(t: Tables) -> DataFrame:
    return _graph(t).statistics()


@query(f"{_ROOTS} select size, count(*) as components from (select root, count(*) as size from cc group by 1) s group by 1")
def component_size_hist(t: Tables) -> DataFrame:
    return _graph(t).size_histogram()


@query(f"""select o_orderkey * 2 + 1 as seg_id from orders where not exists (
select 1 from ({_G_EDGES}) e where src = o_orderkey or dst = o_orderkey)""")
def isolated(t: Tables) -> DataFrame:
    return _graph(t).isolated()


# --- volumes -------------------------------------------------------------------

_ONE_STEP = " union all ".join(
    f"select {z} as dz, {y} as dy, {x} as dx" for z, y, x in ((1, 0, 0), (-1, 0, 0), (0, 1, 0), (0, -1, 0), (0, 0, 1), (0, 0, -1))
)
_NEAR = f"v.z + dz = w.z and v.y + dy = w.y and v.x + dx = w.x"


def _steps26() -> str:
    reach = "(select unnest([-1, 0, 1]) as {0})"
    return f"select dz, dy, dx from {reach.format('dz')} a, {reach.format('dy')} b, {reach.format('dx')} c where not (dz = 0 and dy = 0 and dx = 0)"


def _segments(t: Tables) -> DataFrame:
    return materialize(t(fx.SEGMENTS))


@query(f"select seg_id, count(*) as size from ({fx.SEGMENTS}) v group by 1")
def object_sizes(t: Tables) -> DataFrame:
    return morphology.object_sizes(t(fx.SEGMENTS))


@query(f"select z, y, x, seg_id from (select *, count(*) over (partition by seg_id) as n from ({fx.SEGMENTS}) v) s where n >= 320")
def remove_small(t: Tables) -> DataFrame:
    return morphology.remove_small(_segments(t), min_size=320)


@query(f"""select count(*) as total_objects, count(*) filter (where n < 320) as objects_removed, count(*) filter (where n >= 320) as objects_kept,
cast(320 as bigint) as min_size from (select seg_id, count(*) as n from ({fx.SEGMENTS}) v group by 1) s""")
def removal_stats(t: Tables) -> DataFrame:
    return morphology.removal_stats(morphology.object_sizes(t(fx.SEGMENTS)), 320)


@query(f"""with vox as ({fx.SEGMENTS}), s as ({_ONE_STEP}) select v.z, v.y, v.x, v.seg_id from vox v, s, vox w
where {_NEAR} and v.seg_id = w.seg_id group by 1, 2, 3, 4 having count(*) = 6""")
def erode_once(t: Tables) -> DataFrame:
    return morphology.erode(t(fx.SEGMENTS), 1, 6)


_CORE26 = f"""with recursive vox as ({fx.SOLID}), s26 as ({_steps26()}), core as (select v.z, v.y, v.x, v.seg_id from vox v, s26, vox w
where {_NEAR} and v.seg_id = w.seg_id group by 1, 2, 3, 4 having count(*) = 26)"""


@query(f"{_CORE26} select * from core")
def erode_once_26(t: Tables) -> DataFrame:
    return morphology.erode(t(fx.SOLID), 1, 26)


@query(f"""{_CORE26} select distinct w.z, w.y, w.x, w.seg_id from core v, (select * from s26 union all select 0, 0, 0) s, vox w
where {_NEAR} and v.seg_id = w.seg_id""")
def dilate_once(t: Tables) -> DataFrame:
    voxels = materialize(t(fx.SOLID))
    return morphology.dilate(morphology.erode(voxels, 1, 26), voxels, 1, 26)


_PLANE = fx.SEGMENT_PLANE
_CC = """{head}, links as materialized (select (v.z * 16 + v.y) * 16 + v.x as a, (w.z * 16 + w.y) * 16 + w.x as b from {cells} v, {steps} s, {cells} w
where v.z + dz = w.z and v.y + dy = w.y and v.x + dx = w.x and v.seg_id = w.seg_id),
cc(id, root) using key (id) as (select (z * 16 + y) * 16 + x, (z * 16 + y) * 16 + x from {cells}
union select l.b, min(cc.root) from cc join links l on l.a = cc.id join recurring.cc as old on old.id = l.b where cc.root < old.root group by l.b)"""
_CC6 = _CC.format(head=f"with recursive vox as ({fx.SEGMENTS}), s6 as ({_ONE_STEP})", cells="vox", steps="s6")
_CC26 = _CC.format(head=f"with recursive vox as ({fx.SEGMENTS}), s26 as ({_steps26()})", cells="vox", steps="s26")
_CC_ROWS = "select z, y, x, seg_id, root as component from vox join cc on id = (z * 16 + y) * 16 + x"


@query(f"{_CC6} {_CC_ROWS}")
def voxel_components(t: Tables) -> DataFrame:
    return morphology.voxel_components(t(fx.SEGMENTS), _PLANE, 6)


@query(f"{_CC26} {_CC_ROWS}")
def voxel_components_26(t: Tables) -> DataFrame:
    return morphology.voxel_components(t(fx.SEGMENTS), _PLANE, 26)


_BY_LABEL = f"{_CC6}, parts as (select seg_id, count(distinct root) as components from ({_CC_ROWS.replace('root as component', 'root')}) r group by 1)"


@query(f"{_BY_LABEL} select * from parts")
def connectivity_by_label(t: Tables) -> DataFrame:
    return morphology.connectivity_by_label(morphology.voxel_components(t(fx.SEGMENTS), _PLANE, 6))


@query(f"""{_BY_LABEL} select count(*) as total_objects, cast(sum(components) as bigint) as total_components,
count(*) filter (where components > 1) as multi_part_objects, cast(sum(components) as double) / count(*) as average_components_per_object from parts""")
def connectivity_stats(t: Tables) -> DataFrame:
    parts = morphology.connectivity_by_label(morphology.voxel_components(t(fx.SEGMENTS), _PLANE, 6))
    return morphology.connectivity_stats(parts)


@query(f"""{_CC6}, rows as ({_CC_ROWS}), parts as (select seg_id, component, count(*) as n from rows group by 1, 2),
multi as (select seg_id, min(component) as first from parts group by 1 having count(*) filter (where n >= 20) > 1 and sum(n) >= 20),
fresh as (select p.component, (select max(seg_id) from vox) + row_number() over (order by p.seg_id, p.component) as new
from parts p join multi m on p.seg_id = m.seg_id where n >= 20 and p.component <> first)
select z, y, x, seg_id, coalesce(new, seg_id) as new_label from rows left join fresh on rows.component = fresh.component""")
def split_disconnected(t: Tables) -> DataFrame:
    components = materialize(morphology.voxel_components(t(fx.SEGMENTS), _PLANE, 6))
    return morphology.split_disconnected(components, min_size=20)


# one erosion, components of what is left, two constrained growth steps, then relabelling
_SPLIT = _CC.format(
    head=f"""with recursive vox as ({fx.SEGMENTS}), s6 as ({_ONE_STEP}),
big as (select seg_id from vox group by 1 having count(*) >= 8),
core as (select v.z, v.y, v.x, v.seg_id from vox v, s6, vox w where {_NEAR} and v.seg_id = w.seg_id and v.seg_id in (select seg_id from big)
group by 1, 2, 3, 4 having count(*) = 6)""",
    cells="core",
    steps="s6",
) + f""", g0 as (select z, y, x, seg_id, root from core join cc on id = (z * 16 + y) * 16 + x),
g1 as (select distinct w.z, w.y, w.x, w.seg_id, v.root from g0 v, (select * from s6 union all select 0, 0, 0) s, vox w where {_NEAR} and v.seg_id = w.seg_id),
g2 as (select distinct w.z, w.y, w.x, w.seg_id, v.root from g1 v, (select * from s6 union all select 0, 0, 0) s, vox w where {_NEAR} and v.seg_id = w.seg_id),
parts as (select seg_id, root, count(*) as n from g2 group by 1, 2 having count(*) >= 8),
split as (select seg_id, min(root) as first from parts group by 1 having count(*) > 1),
named as (select root, seg_id as new from parts p join split using (seg_id) where root = first union all
select root, (select max(seg_id) from vox) + row_number() over (order by seg_id, root) from parts join split using (seg_id) where root <> first),
won as (select z, y, x, arg_max(new, root) as new from g2 join named using (root) group by 1, 2, 3)
select v.z, v.y, v.x, v.seg_id, case when v.seg_id in (select seg_id from split) then coalesce(new, 0) else v.seg_id end as new_label
from vox v left join won on v.z = won.z and v.y = won.y and v.x = won.x"""


@query(_SPLIT)
def erosion_split(t: Tables) -> DataFrame:
    return morphology.split_by_erosion(_segments(t), _PLANE, 1, 6, min_size=8)


_SPLIT_PAIRS = _SPLIT.replace("select v.z, v.y, v.x, v.seg_id, case", ", pairs as (select distinct v.seg_id, case") + ")"


@query(f"""{_SPLIT_PAIRS} select count(distinct seg_id) as initial_objects, count(distinct new_label) filter (where new_label <> 0) as final_objects,
count(distinct new_label) filter (where new_label <> 0) - count(distinct seg_id) as objects_added,
(select count(*) from (select seg_id from pairs where new_label <> 0 group by 1 having count(*) > 1) m) as labels_modified from pairs""")
def erosion_split_summary(t: Tables) -> DataFrame:
    return morphology.split_summary(morphology.split_by_erosion(_segments(t), _PLANE, 1, 6, min_size=8))


@query(f"{_SPLIT_PAIRS} select seg_id, count(*) as new_components from pairs where new_label <> 0 group by 1 having count(*) > 1")
def erosion_split_details(t: Tables) -> DataFrame:
    return morphology.split_details(morphology.split_by_erosion(_segments(t), _PLANE, 1, 6, min_size=8))


@query(f"""with vox as ({fx.SEGMENTS}), s as ({_ONE_STEP}) select distinct v.seg_id as a, w.seg_id as b from vox v, s, vox w
where {_NEAR} and v.seg_id < w.seg_id""")
def label_adjacency(t: Tables) -> DataFrame:
    return morphology.label_adjacency(t(fx.SEGMENTS))


# flood of the free cells around each object, from outside its padded box
_HOLES = f"""with recursive vox as ({fx.SOLID}), s6 as ({_ONE_STEP}),
box as (select seg_id as o, min(z) - 1 as z0, max(z) + 1 as z1, min(y) - 1 as y0, max(y) + 1 as y1, min(x) - 1 as x0, max(x) + 1 as x1 from vox group by 1),
free as (select o, z, y, x, z = z0 and y = y0 and x = x0 as corner from (select *, unnest(range(z0, z1 + 1)) as z from box) a,
lateral (select unnest(range(y0, y1 + 1)) as y) b, lateral (select unnest(range(x0, x1 + 1)) as x) c
where not exists (select 1 from vox v where v.seg_id = o and v.z = a.z and v.y = b.y and v.x = c.x)),
reached as (select o, z, y, x from free where corner union
select f.o, f.z, f.y, f.x from reached r, s6, free f where f.o = r.o and f.z = r.z + dz and f.y = r.y + dy and f.x = r.x + dx),
holes as (select o, z, y, x from free except select o, z, y, x from reached),
writes as (select z, y, x, o from holes union all select z, y, x, seg_id from vox where seg_id in (select o from holes)),
last as (select z, y, x, max(o) as o from writes group by 1, 2, 3)"""


@query(f"""{_HOLES} select coalesce(v.z, l.z) as z, coalesce(v.y, l.y) as y, coalesce(v.x, l.x) as x, coalesce(o, seg_id) as seg_id
from vox v full join last l on v.z = l.z and v.y = l.y and v.x = l.x""")
def fill_holes(t: Tables) -> DataFrame:
    voxels = materialize(t(fx.SOLID))
    return morphology.fill_holes(voxels, morphology.extent(voxels))


@query(f"{_HOLES} select o as owner, count(*) as hole_voxels from holes group by 1")
def hole_counts(t: Tables) -> DataFrame:
    voxels = materialize(t(fx.SOLID))
    _, regions, closed = morphology.enclosed_regions(voxels, morphology.extent(voxels))
    return morphology.hole_counts(regions, closed)


# --- shape ---------------------------------------------------------------------

_MOMENTS = f"""select seg_id, count(*) as volume, var_pop(z) as zz, var_pop(y) as yy, var_pop(x) as xx,
-covar_pop(z, y) as zy, -covar_pop(z, x) as zx, -covar_pop(y, x) as yx from ({fx.SEGMENTS}) v group by 1"""
_ELONGATION = f"""select seg_id, volume, round((q + 2 * p * cos(a)) / (q + 2 * p * cos(a + 2 * pi() / 3)), 6) as elongation from (
select *, acos(least(greatest((dz * (dy * dx - yx * yx) - zy * (zy * dx - yx * zx) + zx * (zy * yx - dy * zx)) / (2 * p * p * p), -1), 1)) / 3 as a from (
select *, sqrt((dz * dz + dy * dy + dx * dx + 2 * (zy * zy + zx * zx + yx * yx)) / 6) as p from (
select *, yy + xx - q as dz, zz + xx - q as dy, zz + yy - q as dx from (select *, (zz + yy + xx) * 2 / 3 as q from ({_MOMENTS}) m) a) b) c) d"""


@query(_ELONGATION)
def elongation(t: Tables) -> DataFrame:
    return shape.elongation(t(fx.SEGMENTS)).withColumn("elongation", F.round("elongation", 6))


_BBOX = f"""select seg_id, min(z) as z0, min(y) as y0, min(x) as x0, max(z) + 1 as z1, max(y) + 1 as y1, max(x) + 1 as x1,
count(*) as voxels from ({fx.SEGMENTS}) v group by 1"""


@query(_BBOX)
def bbox(t: Tables) -> DataFrame:
    return shape.bounding_boxes(t(fx.SEGMENTS))


@query(f"select b.* from ({_BBOX}) b where seg_id in (select label - 900 from ({fx.VALID_LABELS}) ok)")
def bbox_of_labels(t: Tables) -> DataFrame:
    only = t(fx.VALID_LABELS).select(F.col("label") - 900)
    return shape.bounding_boxes(t(fx.SEGMENTS), only=only)


@query(f"""select v.z - z0 as z, v.y - y0 as y, v.x - x0 as x, v.seg_id from ({fx.SEGMENTS}) v join ({_BBOX}) b on v.seg_id = b.seg_id
where v.seg_id = (select max(seg_id) from ({fx.SEGMENTS}) m)""")
def subvolume(t: Tables) -> DataFrame:
    voxels = _segments(t)
    value = morphology.max_label(voxels)
    box = shape.bounding_boxes(voxels.where(F.col("seg_id") == value)).first().asDict()
    return shape.subvolume(voxels, value, box)


@query(f"""{_BY_LABEL}, inner_faces as (select v.seg_id, count(*) as n from vox v, s6, vox w where {_NEAR} and v.seg_id = w.seg_id group by 1),
basic as (select seg_id, count(*) as volume, max(z) - min(z) + 1 as z_size, max(y) - min(y) + 1 as y_size, max(x) - min(x) + 1 as x_size,
round(avg(z), 6) as z_mean, round(avg(y), 6) as y_mean, round(avg(x), 6) as x_mean from vox group by 1)
select basic.*, components, 6 * volume - coalesce(n, 0) as surface, elongation from basic join parts using (seg_id)
left join inner_faces using (seg_id) join (select seg_id, elongation from ({_ELONGATION}) e) el using (seg_id)""")
def morphology_metrics(t: Tables) -> DataFrame:
    voxels = _segments(t)
    parts = morphology.connectivity_by_label(morphology.voxel_components(voxels, _PLANE, 6))
    out = shape.morphology(voxels, parts)
    return out.withColumns({c: F.round(c, 6) for c in ("z_mean", "y_mean", "x_mean", "elongation")})


@query(f"""with overlap as (select n.seg_id as organelle, c.seg_id as cell, count(*) as overlap from ({fx.NUCLEI}) n
join (select floor(z / 2.0) as z, floor(y / 2.0) as y, floor(x / 2.0) as x, seg_id from ({fx.SEGMENTS}) s where z % 2 = 0 and y % 2 = 0 and x % 2 = 0) c
on n.z = c.z and n.y = c.y and n.x = c.x group by 1, 2)
select organelle, cell, overlap from (select *, row_number() over (partition by organelle order by overlap desc, cell) as i from overlap) r where i = 1""")
def organelle_assign(t: Tables) -> DataFrame:
    return shape.assign_by_overlap(t(fx.NUCLEI), fuse.stride(t(fx.SEGMENTS), 2))


# --- blocks --------------------------------------------------------------------


@query(f"select z, y, x, 2 * seg_id + 1 as seg_id from ({fx.SEGMENTS}) v")
def block_kernel(t: Tables) -> DataFrame:
    voxels = _segments(t)
    size = [morphology.extent(voxels)[0], 16, 16]
    packed = blocks.rechunk(blocks.to_blocks(voxels, size, [8, 16, 16], "uint32"), size, [32, 8, 8])
    return blocks.to_voxels(tasks.map_blocks(packed, lambda cells: np.where(cells > 0, 2 * cells + 1, 0)))


# --- resampling and fusion -----------------------------------------------------


@query(f"""select cast(floor(z / 2.0) as bigint) as z, cast(floor(y / 2.0) as bigint) as y, cast(floor(x / 2.0) as bigint) as x, seg_id
from ({fx.SEGMENTS}) v where z % 2 = 0 and y % 2 = 0 and x % 2 = 0""")
def strided_downsample(t: Tables) -> DataFrame:
    return fuse.stride(t(fx.SEGMENTS), 2)


@query(f"""select n.z, n.y, n.x, c.seg_id from ({fx.SEGMENTS}) c join ({fx.NUCLEI}) n on c.z = 2 * n.z and c.y = 2 * n.y and c.x = 2 * n.x
where c.seg_id > 0 and n.seg_id > 0""")
def cell_nuclei_merge(t: Tables) -> DataFrame:
    return fuse.merge_nuclei(t(fx.SEGMENTS), t(fx.NUCLEI))


# output cell i takes input position i * (n - 1) / (m - 1)
_AXES_OUT = f"""with recursive vox as ({fx.SEGMENTS}), n as (select max(z) + 1 as n from vox), m as (select n, cast(floor(n / 3.0) as bigint) as m from n),
oz as (select i, i * (cast(n - 1 as double) / (m - 1)) as s from (select n, m, unnest(range(0, m)) as i from m) r),
oy as (select i, i * (15.0::double / 7) as s from (select unnest(range(0, 8)) as i) r), ox as (select i, i * (15.0::double / 4) as s from (select unnest(range(0, 5)) as i) r)"""


@query(f"""{_AXES_OUT} select oz.i as z, oy.i as y, ox.i as x, seg_id from vox join oz on floor(oz.s + 0.5) = z
join oy on floor(oy.s + 0.5) = y join ox on floor(ox.s + 0.5) = x""")
def resample_nearest(t: Tables) -> DataFrame:
    voxels = _segments(t)
    return fuse.resample(voxels, morphology.extent(voxels)[:1] + (16, 16), (3, 2, 3), "nearest")


@query(f"""{_AXES_OUT}, w as (select oz.i as z, oy.i as y, ox.i as x, (1 - abs(oz.s - v.z)) * (1 - abs(oy.s - v.y)) * (1 - abs(ox.s - v.x)) as w, seg_id
from vox v join oz on v.z in (floor(oz.s), floor(oz.s) + 1) join oy on v.y in (floor(oy.s), floor(oy.s) + 1) join ox on v.x in (floor(ox.s), floor(ox.s) + 1))
select z, y, x, round(sum(w * seg_id), 6) as val from w where w > 0 group by 1, 2, 3""")
def resample_linear(t: Tables) -> DataFrame:
    voxels = _segments(t)
    out = fuse.resample(voxels, morphology.extent(voxels)[:1] + (16, 16), (3, 2, 3), "linear", "seg_id")
    return out.select("z", "y", "x", F.round("seg_id", 6).alias("val"))


# per axis, the weight of every input cell in every output cell: B-spline basis times the
# inverse sampling filter sqrt(3) * pole^|j|, positions mirrored at both ends
_CUBIC_AXIS = """{o}k as (select i, case when mod(p, 2 * (n - 1)) < n then mod(p, 2 * (n - 1)) else 2 * (n - 1) - mod(p, 2 * (n - 1)) end as src, sum(w) as w from (
select i, n, abs(cast(floor(s) as bigint) + t - j) as p, sqrt(3) * power(sqrt(3) - 2, abs(j)) * case when abs(s - floor(s) - t) < 1
then (4 - 6 * power(abs(s - floor(s) - t), 2) + 3 * power(abs(s - floor(s) - t), 3)) / 6 when abs(s - floor(s) - t) < 2
then power(2 - abs(s - floor(s) - t), 3) / 6 else 0 end as w
from (select i, s, {n} as n from {o}) q, (select unnest(range(-1, 3)) as t) tt, (select unnest(range(-36, 37)) as j) jj) r group by 1, 2)"""
_CUBIC_AXES = ", ".join(_CUBIC_AXIS.format(o=o, n=n) for o, n in (("oz", "(select max(z) + 1 from vox)"), ("oy", "16"), ("ox", "16")))


@query(f"""{_AXES_OUT}, {_CUBIC_AXES}, c1 as (select i as z, y, x, sum(w * seg_id) as val from vox join ozk on src = z group by 1, 2, 3),
c2 as (select z, i as y, x, sum(w * val) as val from c1 join oyk on src = y group by 1, 2, 3),
c3 as (select z, y, i as x, round(sum(w * val), 6) as val from c2 join oxk on src = x group by 1, 2, 3) select * from c3 where val <> 0""")
def resample_cubic(t: Tables) -> DataFrame:
    voxels = _segments(t)
    out = fuse.resample(voxels, morphology.extent(voxels)[:1] + (16, 16), (3, 2, 3), "cubic", "seg_id")
    return out.select("z", "y", "x", F.round("seg_id", 6).alias("val")).where("val <> 0")


# twice as many planes and rows, and 40 columns out of 16
_AXES_UP = f"""with vox as ({fx.SEGMENTS}), n as (select cast(max(z) + 1 as bigint) as n from vox),
oz as (select i, i * (cast(n - 1 as double) / (2 * n - 1)) as s from (select n, unnest(range(0, 2 * n)) as i from n) r),
oy as (select i, i * (15.0::double / 31) as s from (select unnest(range(0, 32)) as i) r), ox as (select i, i * (15.0::double / 39) as s from (select unnest(range(0, 40)) as i) r)"""


@query(f"""{_AXES_UP} select oz.i as z, oy.i as y, ox.i as x, seg_id from vox join oz on floor(oz.s + 0.5) = z
join oy on floor(oy.s + 0.5) = y join ox on floor(ox.s + 0.5) = x""")
def upsample_nearest(t: Tables) -> DataFrame:
    voxels = _segments(t)
    return fuse.resample(voxels, morphology.extent(voxels)[:1] + (16, 16), (0.5, 0.5, 0.4), "nearest")


@query(f"""{_AXES_UP}, w as (select oz.i as z, oy.i as y, ox.i as x, (1 - abs(oz.s - v.z)) * (1 - abs(oy.s - v.y)) * (1 - abs(ox.s - v.x)) as w, seg_id
from vox v join oz on v.z in (floor(oz.s), floor(oz.s) + 1) join oy on v.y in (floor(oy.s), floor(oy.s) + 1) join ox on v.x in (floor(ox.s), floor(ox.s) + 1))
select z, y, x, round(sum(w * seg_id), 6) as val from w where w > 0 group by 1, 2, 3""")
def upsample_linear(t: Tables) -> DataFrame:
    voxels = _segments(t)
    out = fuse.resample(voxels, morphology.extent(voxels)[:1] + (16, 16), (0.5, 0.5, 0.4), "linear", "seg_id")
    return out.select("z", "y", "x", F.round("seg_id", 6).alias("val"))


# --- distance and watershed ----------------------------------------------------


# the nearest cell of another label in the own row bounds how far a cell has to look
_DISTANCE = f"""with vox as materialized ({fx.SOLID}), grid as (select a.z, b.y, c.x from (select unnest(range(0, (select max(z) + 1 from vox))) as z) a,
(select unnest(range(0, 16)) as y) b, (select unnest(range(0, 16)) as x) c),
cells as materialized (select g.z, g.y, g.x, coalesce(seg_id, 0) as seg_id from grid g left join vox v on g.z = v.z and g.y = v.y and g.x = v.x),
bound as materialized (select v.z, v.y, v.x, v.seg_id, min((c.x - v.x) * (c.x - v.x)) as most from vox v join cells c on c.z = v.z and c.y = v.y where c.seg_id <> v.seg_id group by 1, 2, 3, 4),
d as (select unnest(range(-a, a + 1)) as d from (select cast(ceil(sqrt(max(most))) as bigint) as a from bound) m),
reach as materialized (select dz.d as dz, dy.d as dy, dx.d as dx, dz.d * dz.d + dy.d * dy.d + dx.d * dx.d as r from d dz, d dy, d dx where dz.d * dz.d + dy.d * dy.d + dx.d * dx.d > 0),
moved as materialized (select v.z, v.y, v.x, v.seg_id, v.z + dz as cz, v.y + dy as cy, v.x + dx as cx, r from bound v join reach on r <= most),
dist as materialized (select m.z, m.y, m.x, m.seg_id, cast(min(r) as double) as val from moved m join cells c on c.z = cz and c.y = cy and c.x = cx
where c.seg_id <> m.seg_id group by 1, 2, 3, 4)"""


@query(f"{_DISTANCE} select * from dist")
def squared_distance(t: Tables) -> DataFrame:
    voxels = materialize(t(fx.SOLID))
    return distance.squared_distance(voxels, morphology.extent(voxels))


# kernel tables per axis: reading beyond the border means reading the border cell
_SMOOTH_AXIS = """{a}k as materialized (select p, least(greatest(p + k, 0), n - 1) as src, sum(w) as w from (select unnest(range(0, n)) as p, n from (select {n} as n) q) g,
(select k, exp(-0.5 * k * k) / sum(exp(-0.5 * k * k)) over () as w from (select unnest(range(-4, 5)) as k) kk) ww group by 1, 2)"""
_SMOOTH_AXES = ", ".join(_SMOOTH_AXIS.format(a=a, n=n) for a, n in (("z", "(select max(z) + 1 from vox)"), ("y", "16"), ("x", "16")))


@query(f"""{_DISTANCE}, {_SMOOTH_AXES}, s1 as materialized (select seg_id, p as z, y, x, sum(w * sqrt(val)) as val from dist join zk on src = z group by 1, 2, 3, 4),
s2 as materialized (select seg_id, z, p as y, x, sum(w * val) as val from s1 join yk on src = y group by 1, 2, 3, 4),
s3 as materialized (select seg_id, z, y, p as x, round(sum(w * val), 9) as val from s2 join xk on src = x group by 1, 2, 3, 4)
select s3.*, v.seg_id is not null as inside from s3 left join vox v on v.z = s3.z and v.y = s3.y and v.x = s3.x and v.seg_id = s3.seg_id""")
def smooth_distance(t: Tables) -> DataFrame:
    voxels = materialize(t(fx.SOLID))
    shape_ = morphology.extent(voxels)
    field = distance.squared_distance(voxels, shape_).withColumn("val", F.sqrt("val"))
    return distance.smooth(field, shape_, 1.0)


# every segment cut across at half its height
_HALVES = f"select *, z % 8 >= 4 as upper from ({fx.SEGMENTS}) s"


@query(f"""with halves as ({_HALVES}), r as ({flood_sql.elongation("halves", "seg_id, upper")}),
mean as (select seg_id, count(*) as n, sum(elongation * volume) / sum(volume) as mean from r where volume >= 20 group by 1)
select seg_id from mean join ({flood_sql.elongation("halves", "seg_id")}) w using (seg_id) where n >= 2 and mean < elongation * 1.2""")
def elongation_gate(t: Tables) -> DataFrame:
    halves = materialize(t(_HALVES))
    return shape.elongation_gate(shape.elongation(halves, ["seg_id", "upper"]), shape.elongation(halves), 20, gain=1.2)


@query(f"with recursive vox as ({fx.SOLID}), {flood_sql.heights('(select max(z) + 1 from vox)')}, {flood_sql.maxima(0.2)} select z, y, x, seg_id, val from top")
def h_maxima(t: Tables) -> DataFrame:
    voxels = materialize(t(fx.SOLID))
    shape_ = morphology.extent(voxels)
    field = distance.smooth(distance.squared_distance(voxels, shape_).withColumn("val", F.sqrt("val")), shape_, 1.0)
    tops = watershed.maximum_cells(materialize(field.withColumnRenamed("seg_id", "label")), shape_[1:], 0.2)
    return tops.withColumnRenamed("label", "seg_id")


@query(f"with recursive {flood_sql.split(fx.SEGMENTS, 0.2, 10)} {flood_sql.labels('region')}")
def watershed_split(t: Tables) -> DataFrame:
    voxels = materialize(t(fx.SEGMENTS))
    return watershed.split_by_watershed(voxels, morphology.extent(voxels), h=0.2, min_size=10)[0]


@query(f"""with recursive {flood_sql.split(fx.SEGMENTS, 0.2, 10)}
select seg_id, num_maxima, coalesce(valid_regions, 0) as valid_regions, coalesce(valid_regions, 0) > 1 as accepted from counts left join per using (seg_id)""")
def watershed_outcome(t: Tables) -> DataFrame:
    voxels = materialize(t(fx.SEGMENTS))
    return watershed.split_by_watershed(voxels, morphology.extent(voxels), h=0.2, min_size=10)[1]


@query(f"with recursive {flood_sql.split_by_shape(fx.SEGMENTS, 0.2, 20)} {flood_sql.labels('owner')}")
def watershed_elongation(t: Tables) -> DataFrame:
    voxels = materialize(t(fx.SEGMENTS))
    return watershed.split_by_watershed_elongation(voxels, morphology.extent(voxels), h=0.2, min_size=20)[0]


# --- sources and sinks: what the tables give, written and read again ------------


def _folder(t: Tables) -> str:
    # sinks of single files take plain paths
    return f"{work_dir(t.spark).removeprefix('file://').rstrip('/')}/tessera/{uuid.uuid4().hex}"


def _segment_blocks(t: Tables, chunk: tuple[int, int, int] = (8, 8, 8), dtype: str = "uint32") -> tuple[DataFrame, list[int]]:
    voxels = materialize(t(fx.SEGMENTS))
    shape_ = list(morphology.extent(voxels))
    return blocks.to_blocks(voxels, shape_, list(chunk), dtype), shape_


def _stored_segments(t: Tables, chunk: tuple[int, int, int] = (8, 8, 8), compressor: dict | None = None) -> str:
    cells, shape_ = _segment_blocks(t, chunk)
    path = _folder(t)
    zarr2.create(path, shape_, list(chunk), "uint32", compressor)
    zarr2.write_blocks(cells, path)
    return path


_CODECS = {
    "none": None, "zlib": {"id": "zlib", "level": 1}, "gzip": {"id": "gzip", "level": 1}, "zstd": {"id": "zstd", "level": 1},
    "blosc": {"id": "blosc", "cname": "lz4", "clevel": 5, "shuffle": 1},
}


@query(f"select codec, v.* from ({fx.SEGMENTS}) v, (values {', '.join(f"('{c}')" for c in _CODECS)}) c(codec)")
def zarr_codecs(t: Tables) -> DataFrame:
    read = [blocks.to_voxels(zarr2.read_blocks(t.spark, _stored_segments(t, compressor=c))).withColumn("codec", F.lit(name)) for name, c in _CODECS.items()]
    return reduce(DataFrame.unionByName, read)


@query(f"select * from ({fx.SEGMENTS}) v where z >= 8 and z < 40 and x < 8")
def zarr_box(t: Tables) -> DataFrame:
    return blocks.to_voxels(zarr2.read_blocks(t.spark, _stored_segments(t), box=[(11, 33), (7, 9), (2, 5)]))


@query(f"select count(*) as chunks from (select distinct floor(z / 8.0), floor(y / 8.0), floor(x / 8.0) from ({fx.SEGMENTS}) v) c")
def zarr_resume(t: Tables) -> DataFrame:
    cells, shape_ = _segment_blocks(t)
    path = _folder(t)
    zarr2.create(path, shape_, [8, 8, 8], "uint32")
    zarr2.write_blocks(cells.where(F.get("idx", 0) % 3 == 0), path)  # a run that got this far
    return zarr2.write_blocks(cells, path, resume=True).agg(F.count(F.lit(1)).alias("chunks"))


@query(fx.SEGMENTS)
def npy_store(t: Tables) -> DataFrame:
    cells, shape_ = _segment_blocks(t)
    path = f"{_folder(t)}.npy"
    arrays.write_npy(cells, path, shape_, "uint32")
    arrays.register(t.spark)
    return blocks.to_voxels(t.spark.read.format("npy").option("chunk", "5,16,7").load(path))


@query(f"select z, y, x, cast(255 as double) as val from ({fx.SEGMENTS}) v where seg_id = 1")
def tiff_mask_store(t: Tables) -> DataFrame:
    voxels = materialize(t(fx.SEGMENTS))
    shape_ = list(morphology.extent(voxels))
    cells = blocks.to_blocks(voxels.where("seg_id = 1"), shape_, [8, 16, 16], "uint8")
    path = f"{_folder(t)}.tif"
    arrays.write_mask_tiff(cells, path, shape_)
    arrays.register(t.spark)
    return blocks.to_voxels(t.spark.read.format("tiffstack").option("chunk", "4,8,16").load(path), "val")


@query(fx.SEGMENTS)
def precomputed_store(t: Tables) -> DataFrame:
    cells, shape_ = _segment_blocks(t)
    path = _folder(t)
    precomputed.write_precomputed(cells, path, shape_, [8, 8, 8], "uint32", voxel_offset=(5, 0, 100))
    return blocks.to_voxels(precomputed.read_precomputed(t.spark, path))


@query(fx.SEGMENTS)
def precomputed_palette(t: Tables) -> DataFrame:
    cells, shape_ = _segment_blocks(t, (20, 12, 9))
    path = _folder(t)
    precomputed.write_precomputed(cells, path, shape_, [20, 12, 9], "uint32", encoding=precomputed.PALETTE)
    return blocks.to_voxels(precomputed.read_precomputed(t.spark, path))


@query(f"select z, y, x, cast(255 as double) as val from ({fx.SEGMENTS}) v where seg_id = 1")
def bigtiff_mask_store(t: Tables) -> DataFrame:
    voxels = materialize(t(fx.SEGMENTS))
    shape_ = list(morphology.extent(voxels))
    path = f"{_folder(t)}.tif"
    arrays.write_mask_tiff(blocks.to_blocks(voxels.where("seg_id = 1"), shape_, [8, 16, 16], "uint8"), path, shape_, big=True)
    arrays.register(t.spark)
    return blocks.to_voxels(t.spark.read.format("tiffstack").option("chunk", "4,8,16").load(path), "val")


@query(f"""with lk as ({fx.LOOKUP}), ok as ({fx.VALID_LABELS})
select z, y, x, lk.label, coalesce(ok.label, 0) as filtered from ({fx.SEGMENTS}) v join lk on v.seg_id = lk.seg_id left join ok on lk.label = ok.label""")
def relabel_filter_array(t: Tables) -> DataFrame:
    source, labelled, filtered = _stored_segments(t, compressor=_CODECS["blosc"]), _folder(t), _folder(t)
    convert.relabel_array(t.spark, source, labelled, filtered, t(fx.LOOKUP), t(fx.VALID_LABELS))
    both = [blocks.to_voxels(zarr2.read_blocks(t.spark, path), "label") for path in (labelled, filtered)]
    return both[0].join(both[1].withColumnRenamed("label", "filtered"), ["z", "y", "x"], "left").fillna(0, ["filtered"])


# as relabel_filter_array, but as if no lookup were small: blocks are coded and their distinct ids joined
@query(CHECKS["relabel_filter_array"])
def relabel_filter_coded(t: Tables) -> DataFrame:
    cells, _ = _segment_blocks(t)
    both = materialize(dictionary.relabel_blocks(cells, t(fx.LOOKUP), t(fx.VALID_LABELS), broadcast_rows=0))
    labelled, filtered = (blocks.to_voxels(dictionary.one_output(both, name), "label") for name in ("label", "filtered"))
    return labelled.join(filtered.withColumnRenamed("label", "filtered"), ["z", "y", "x"], "left").fillna(0, ["filtered"])


@query(f"select z, y, x, seg_id from ({fx.SEGMENTS}) v where seg_id in (select seg_id from ({fx.ID_LIST}) i)")
def keep_labels_blocks(t: Tables) -> DataFrame:
    cells, _ = _segment_blocks(t)
    return blocks.to_voxels(dictionary.one_output(dictionary.keep_blocks(cells, t(fx.ID_LIST)), "filtered"))


@query(f"select z, y, x, cast(1 as double) as val from ({fx.SEGMENTS}) v where seg_id in (select seg_id from ({fx.ID_LIST}) i)")
def mask_array(t: Tables) -> DataFrame:
    source, target = _stored_segments(t, compressor=_CODECS["zstd"]), _folder(t)
    convert.mask_array(t.spark, source, target, t(fx.ID_LIST))
    return blocks.to_voxels(zarr2.read_blocks(t.spark, target), "val")


# inside the array an empty cell is background, outside it nothing is known
@query(f"""with vox as ({fx.SEGMENTS}), lk as ({fx.LOOKUP}), p as ({_POINTS})
select cell, coalesce(vox.seg_id, case when pz <= (select max(z) from vox) then 0 else -1 end) as target_id, coalesce(lk.label, -1) as label from p
left join vox on pz = z and py = y and px = x left join lk on lk.seg_id = vox.seg_id""")
def point_lookup_array(t: Tables) -> DataFrame:
    point = F.struct(*[F.col(f"p{a}").alias(a) for a in "xyz"]).alias("Mapped_Coordinates")
    cells = t(_POINTS).select("cell", point)
    return proof.point_lookup_array(cells, _stored_segments(t), t(fx.LOOKUP)).select("cell", "target_id", "label")


@query(f"select row_number() over (order by line_no) - 1 as line_no, op, v1, v2 from ({fx.CHANGES}) c")
def changelog_file(t: Tables) -> DataFrame:
    path = _folder(t)
    lines = t(fx.CHANGES).orderBy("line_no").select(F.concat(F.col("op"), *[F.concat(F.lit("\t"), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in ("v1", "v2")]))
    lines.write.text(path)
    return text.read_changelog(t.spark, path)


def _followed_log(t: Tables) -> tuple[str, int]:
    """A graph that has followed the log through three files; the number of its last batch."""
    path, folder = _folder(t), _folder(t)
    edges, changes, vertices = _log(t)
    vertices.write.parquet(f"{path}/vertices")
    edges.write.parquet(f"{path}/edges")
    last = changes.agg(F.max("line_no")).first()[0]
    lines = changes.select("line_no", F.concat(F.col("op"), *[F.concat(F.lit("\t"), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in ("v1", "v2")]).alias("value"))
    for k in range(3):
        part = lines.where((F.col("line_no") * 3 > last * k) if k else F.lit(True)).where(F.col("line_no") * 3 <= last * (k + 1))
        part.repartition(1).sortWithinPartitions("line_no").select("value").write.mode("append").text(folder)
    stream.follow_changes(t.spark, folder, path, f"{path}/checkpoint", files_per_batch=1, compact_every=2).awaitTermination()
    return path, 2


@query(CHECKS["changelog_state"])
def changelog_stream(t: Tables) -> DataFrame:
    return stream.edges_at(t.spark, *_followed_log(t))


@query(f"""with recursive state as materialized (select src, dst from ({_LOG_FOLD}) m where mult > 0),
links as materialized (select src as a, dst as b from state where src <> dst union select dst, src from state where src <> dst),
cc(vid, root) using key (vid) as (select vid, vid from ({fx.LOG_VERTICES}) v
union select l.b, min(cc.root) from cc join links l on l.a = cc.vid join recurring.cc as old on old.vid = l.b where cc.root < old.root group by l.b)
select vid, root from cc""")
def components_stream(t: Tables) -> DataFrame:
    return stream.roots_at(t.spark, *_followed_log(t))


@query(fx.MERGELIST)
def mergelist_file(t: Tables) -> DataFrame:
    path = _folder(t)
    records = t(fx.MERGELIST).groupBy("obj_id").agg(F.concat_ws(" ", F.sort_array(F.collect_list("sub_id"))).alias("subs"))
    head = F.concat(F.col("obj_id").cast("string"), F.lit(" 0 0 "), F.col("subs"))
    lines = records.select("obj_id", F.posexplode(F.array(head, F.lit("1 2 3"), F.lit("axon"), F.lit(""))).alias("i", "value"))
    lines.orderBy("obj_id", "i").select("value").write.text(path)
    return text.read_mergelist(t.spark, path)


@query(fx.ID_LIST)
def id_list_file(t: Tables) -> DataFrame:
    path = _folder(t)
    t(fx.ID_LIST).groupBy((F.col("seg_id") % 100).alias("k")).agg(F.concat_ws("  ", F.collect_list("seg_id")).alias("value")).select("value").write.text(path)
    return text.read_id_list(t.spark, path)


@query(f"select vid, seg_id, src, dst, mult from ({fx.VERTICES}) v join ({fx.EDGES}) e on v.vid = e.src")
def graph_store(t: Tables) -> DataFrame:
    saved = graph.SegmentGraph(t(fx.VERTICES), t(fx.EDGES)).save(_folder(t))
    loaded = graph.SegmentGraph.load(t.spark, saved)
    return loaded.vertices.join(loaded.edges, F.col("vid") == F.col("src"))


@query(f"""select zone, redmine, cell, client_status, concat('(', cast(o_orderkey as varchar(20)), ', ', cast(o_custkey as varchar(20)), ', 7)') as "at"
from ({fx.SHEETS}) s join orders on redmine = cast(o_orderkey as varchar(20))""")
def proof_csv(t: Tables) -> DataFrame:
    point = "named_struct('x', o_orderkey, 'y', o_custkey, 'z', 7) as at"
    table = t(f"select zone, redmine, cell, client_status, {point} from ({fx.SHEETS}) s join orders on redmine = cast(o_orderkey as varchar(20))")
    path = proof.save_table(table, _folder(t))
    return t.spark.read.option("header", True).csv(path)
