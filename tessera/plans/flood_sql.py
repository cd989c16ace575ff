"""SQL for the watershed queries: smoothed heights to labels, by keyed recursion over cells.

Volumes are ``16`` cells wide in y and x. Each function returns common table expressions that follow ``with recursive``.
"""

from __future__ import annotations

_REACH = """d as (select unnest(range(-5, 6)) as d),
reach as materialized (select dz.d as dz, dy.d as dy, dx.d as dx, dz.d * dz.d + dy.d * dy.d + dx.d * dx.d as r from d dz, d dy, d dx where dz.d * dz.d + dy.d * dy.d + dx.d * dx.d between 1 and 30),
step26 as materialized (select dz, dy, dx from reach where greatest(abs(dz), abs(dy), abs(dx)) = 1), step6 as materialized (select dz, dy, dx from reach where r = 1)"""

# kernel tables per axis: reading beyond the border means reading the border cell
_AXIS = """{a}k as materialized (select p, least(greatest(p + k, 0), n - 1) as src, sum(w) as w from (select unnest(range(0, n)) as p, n from (select {n} as n) q) g,
(select k, exp(-0.5 * k * k) / sum(exp(-0.5 * k * k)) over () as w from (select unnest(range(-4, 5)) as k) kk) ww group by 1, 2)"""


def near(name: str, cells: str, steps: str) -> str:
    """``name(seg_id, c, u)``: neighbouring cells of one object."""
    return f"""{name}_to as materialized (select seg_id, id as c, z + dz as z, y + dy as y, x + dx as x from {cells}, {steps}),
{name} as materialized (select a.seg_id, a.c, b.id as u from {name}_to a join {cells} b using (seg_id, z, y, x))"""


def parts(name: str, cells: str, steps: str) -> str:
    """``name(seg_id, id, m)``: the least cell number of each cell's component."""
    return f"""{near(f"{name}_n", cells, steps)},
{name}(seg_id, id, m) using key (seg_id, id) as (select seg_id, id, id from {cells} union
select n.seg_id, n.c, min(t.m) from {name} t join {name}_n n on n.seg_id = t.seg_id and n.u = t.id join recurring.{name} k on k.seg_id = n.seg_id and k.id = n.c
where t.m < k.m group by 1, 2)"""


def heights(height: str) -> str:
    """``f(seg_id, id, z, y, x, val)``: smoothed distances of the objects in ``vox``, in a volume of ``height`` layers."""
    axes = ", ".join(_AXIS.format(a=a, n=n) for a, n in (("z", height), ("y", "16"), ("x", "16")))
    return f"""{_REACH},
grid as (select a.z, b.y, c.x from (select unnest(range(0, {height})) as z) a, (select unnest(range(0, 16)) as y) b, (select unnest(range(0, 16)) as x) c),
cells as materialized (select g.z, g.y, g.x, coalesce(seg_id, 0) as seg_id from grid g left join vox v on g.z = v.z and g.y = v.y and g.x = v.x),
moved as (select v.z, v.y, v.x, v.seg_id, v.z + dz as cz, v.y + dy as cy, v.x + dx as cx, r from vox v, reach),
dist as materialized (select m.z, m.y, m.x, m.seg_id, cast(min(r) as double) as val from moved m join cells c on c.z = cz and c.y = cy and c.x = cx where c.seg_id <> m.seg_id group by 1, 2, 3, 4),
{axes}, s1 as materialized (select seg_id, p as z, y, x, sum(w * sqrt(val)) as val from dist join zk on src = z group by 1, 2, 3, 4),
s2 as materialized (select seg_id, z, p as y, x, sum(w * val) as val from s1 join yk on src = y group by 1, 2, 3, 4),
f as materialized (select seg_id, (z * 16 + y) * 16 + p as id, z, y, p as x, round(sum(w * val), 9) as val from s2 join xk on src = x group by seg_id, z, y, p)"""


def maxima(h: float) -> str:
    """``top``: the cells of ``f`` that its reconstruction from ``f - h`` leaves ``h`` below it."""
    return f"""{near("n26", "f", "step26")},
rec(seg_id, id, r) using key (seg_id, id) as (select seg_id, id, val - {h} from f union
select n.seg_id, n.c, max(least(f.val, t.r)) from rec t join n26 n on n.seg_id = t.seg_id and n.u = t.id join f on f.seg_id = n.seg_id and f.id = n.c
join recurring.rec k on k.seg_id = n.seg_id and k.id = n.c where least(f.val, t.r) > k.r group by 1, 2),
top as materialized (select f.* from f join rec on rec.seg_id = f.seg_id and rec.id = f.id where r <= val - {h} and val >= {h})"""


def regions(connectivity: int) -> str:
    """``counts(seg_id, num_maxima, first_m)`` and ``region(seg_id, id, region)`` by a flood from the components of ``top``.

    Cells of an object are ranked by height and number. A cell's level is the worst rank of the best path from a marker; it
    goes to the cell of that rank, or if that is itself, to the level of its neighbour with the best one.
    """
    return f"""{parts("comp", "top", f"step{connectivity}")},
counts as materialized (select seg_id, count(distinct m) as num_maxima, min(m) as first_m from comp group by 1 having count(distinct m) > 1),
g as materialized (select f.*, row_number() over (partition by f.seg_id order by f.val desc, f.id) as k from f join vox v on v.seg_id = f.seg_id and v.z = f.z and v.y = f.y and v.x = f.x where f.seg_id in (select seg_id from counts)),
{near("n6", "g", "step6")},
nk as materialized (select n6.seg_id, a.k as c, b.k as u from n6 join g a on a.seg_id = n6.seg_id and a.id = c join g b on b.seg_id = n6.seg_id and b.id = u),
mk as materialized (select g.seg_id, k, m from g join comp on comp.seg_id = g.seg_id and comp.id = g.id),
lev(seg_id, k, e) using key (seg_id, k) as (select g.seg_id, g.k, case when m is null then 1000000000 else g.k end from g left join mk on mk.seg_id = g.seg_id and mk.k = g.k union
select n.seg_id, n.c, min(greatest(n.c, t.e)) from lev t join nk n on n.seg_id = t.seg_id and n.u = t.k join recurring.lev o on o.seg_id = n.seg_id and o.k = n.c
where t.e < 1000000000 and greatest(n.c, t.e) < o.e group by 1, 2),
best as materialized (select n.seg_id, n.c as k, min(e) as e from nk n join lev on lev.seg_id = n.seg_id and lev.k = n.u group by 1, 2),
nxt as materialized (select l.seg_id, l.k, case when mk.k is not null then l.k when l.e > l.k then l.e else best.e end as nx
from lev l left join mk on mk.seg_id = l.seg_id and mk.k = l.k left join best on best.seg_id = l.seg_id and best.k = l.k where l.e < 1000000000),
walk(seg_id, k, cur) as (select seg_id, k, nx from nxt union all select w.seg_id, w.k, n.nx from walk w join nxt n on n.seg_id = w.seg_id and n.k = w.cur where n.nx <> w.cur),
region as materialized (select w.seg_id, g.id, mk.m as region from walk w join mk on mk.seg_id = w.seg_id and mk.k = w.cur join g on g.seg_id = w.seg_id and g.k = w.k)"""


def elongation(source: str, keys: str) -> str:
    """``keys, volume, elongation`` of the cells in ``source``: largest by smallest eigenvalue of the inertia tensor."""
    return f"""select {keys}, volume, case when small > 1e-9 * large then large / small else cast('inf' as double) end as elongation from (
select *, q + 2 * p * cos(a) as large, q + 2 * p * cos(a + 2 * pi() / 3) as small from (
select *, case when p = 0 then 0 else acos(least(greatest((dz * (dy * dx - yx * yx) - zy * (zy * dx - yx * zx) + zx * (zy * yx - dy * zx)) / (2 * p * p * p), -1), 1)) / 3 end as a from (
select *, sqrt((dz * dz + dy * dy + dx * dx + 2 * (zy * zy + zx * zx + yx * yx)) / 6) as p from (
select *, yy + xx - q as dz, zz + xx - q as dy, zz + yy - q as dx from (select *, (zz + yy + xx) * 2 / 3 as q from (
select {keys}, count(*) as volume, var_pop(z) as zz, var_pop(y) as yy, var_pop(x) as xx, -covar_pop(z, y) as zy, -covar_pop(z, x) as zx, -covar_pop(y, x) as yx
from {source} group by {keys}) m0) m1) m2) m3) m4) m5"""


def split(volume: str, h: float, min_size: int) -> str:
    """Up to ``region``, ``counts``, and ``per`` and ``fresh`` of the split that goes by size."""
    return f"""allvox as materialized ({volume}), vox as materialized (select * from allvox where seg_id in (select seg_id from allvox group by 1 having count(*) >= {2 * min_size})),
{heights("(select max(z) + 1 from allvox)")}, {maxima(h)}, {regions(6)},
valid as materialized (select seg_id, region from region group by 1, 2 having count(*) >= {min_size}),
per as materialized (select seg_id, count(*) as valid_regions, min(region) as first_r from valid group by 1),
fresh as (select seg_id, region, row_number() over (order by seg_id, region) + (select max(seg_id) from allvox) as new from valid join per using (seg_id) where valid_regions > 1 and region <> first_r)"""


def split_by_shape(volume: str, h: float, min_size: int) -> str:
    """The same for the split that goes by components first, and by elongation after."""
    return f"""allvox as materialized ({volume}),
big as materialized (select *, (z * 16 + y) * 16 + x as id from allvox where seg_id in (select seg_id from allvox group by 1 having count(*) >= {min_size})),
b26 as (select z.d as dz, y.d as dy, x.d as dx from (values (-1), (0), (1)) z(d), (values (-1), (0), (1)) y(d), (values (-1), (0), (1)) x(d)),
{parts("piece", "big", "b26")},
sized as materialized (select seg_id, m, count(*) as n from piece group by 1, 2),
about as materialized (select seg_id, count(*) as pieces, count(*) filter (where n >= {min_size}) as significant, min(m) as first_m from sized group by 1),
vox as materialized (select z, y, x, seg_id from big where seg_id in (select seg_id from about where pieces = 1)),
{heights("(select max(z) + 1 from allvox)")}, {maxima(h)}, {regions(26)},
placed as (select r.*, z, y, x from region r join f using (seg_id, id)),
mean as (select seg_id, count(*) as n, sum(elongation * volume) / sum(volume) as mean from ({elongation("placed", "seg_id, region")}) e where volume >= {min_size} group by 1),
gate as (select seg_id from mean join ({elongation("vox", "seg_id")}) w using (seg_id) where n >= 2 and mean < elongation * 0.8),
cut as (select seg_id, region as part from region join counts using (seg_id) where seg_id in (select seg_id from gate) and region <> first_m group by 1, 2 having count(*) >= {min_size}),
loose as (select seg_id, m as part from sized join about using (seg_id) where pieces > 1 and significant > 1 and m <> first_m and n >= {min_size}),
fresh as (select seg_id, part as region, row_number() over (order by seg_id, part) + (select max(seg_id) from allvox) as new from (select * from cut union all select * from loose) p),
owner as (select seg_id, id, region from region union all select seg_id, id, m from piece where seg_id in (select seg_id from about where pieces > 1))"""


def labels(owner: str) -> str:
    """Every voxel with its label after the split."""
    return f"""select v.z, v.y, v.x, v.seg_id, coalesce(new, v.seg_id) as new_label from allvox v left join {owner} o on o.seg_id = v.seg_id and o.id = (v.z * 16 + v.y) * 16 + v.x
left join fresh n on n.seg_id = o.seg_id and n.region = o.region"""
