"""Volumes, graphs and tables derived from the driver tables.

Each text is plain SQL that Spark and DuckDB read alike, so a query and its check
start from the same rows. Every derived set grows with the tables.
"""

# one voxel per line item; parts are the segments
VOXELS = """select l_orderkey as z, cast(l_linenumber as bigint) as y, l_suppkey as x, l_partkey + 1 as seg_id
from lineitem"""

# part -> label; some parts have none
LOOKUP = """select p_partkey + 1 as seg_id, cast(900 + p_size as bigint) as label
from part where p_brand <> 'Brand#7'"""

VALID_LABELS = "select distinct cast(900 + n_nationkey as bigint) as label from nation where n_regionkey in (1, 3)"

ID_LIST = "select distinct p_partkey + 1 as seg_id from part where p_size <= 25"

# proofreading rows: five sheets, statuses that differ in case, junk after some coordinates
SHEETS = """select o_orderpriority as zone, cast(o_orderkey as varchar(20)) as redmine, concat('cell ', cast(o_custkey as varchar(20))) as cell,
case o_orderstatus when 'F' then 'complete' when 'O' then 'Complete' else null end as client_status,
case when o_totalprice < 200000 then 'QA is completed' else 'open' end as qa_status,
concat(cast(o_orderkey as varchar(20)), ',', cast(1 + o_custkey % 7 as varchar(20)), case when o_orderstatus = 'P' then '' else concat(', ', cast(o_custkey - 700 as varchar(20))) end,
case when o_totalprice > 400000 then ' px' else '' end) as coordinate
from orders"""

INTENSITY = """select l_orderkey as z, cast(l_linenumber as bigint) as y, l_suppkey as x,
cast(34000 + floor(l_extendedprice) % 2500 as int) as val from lineitem"""

# a dense volume, 16 x 16 x (orders / 64): two in three 8^3 cells are a segment of
# their own, all others belong to segment 1, which thus holds a third of all voxels
SEGMENTS = """select z, y, x, cast(case when b % 3 = 0 then 1 else 2 + b end as bigint) as seg_id from (
select z, y, x, cast(floor(z / 8.0) * 4 + floor(y / 8.0) * 2 + floor(x / 8.0) as bigint) as b from (
select distinct cast(floor(l_orderkey / 64.0) as bigint) as z, l_partkey % 16 as y, (l_suppkey * 7 + l_linenumber) % 16 as x
from lineitem) cells) blocks"""
SEGMENT_PLANE = (16, 16)

# a nearly solid volume, 16 x 16 x (orders / 256): 8^3 bodies with single missing cells
# inside and small inclusions of another label; again one body label holds a third
SOLID = """select z, y, x, cast(case when line >= 4 then 2 * b + 3 when b % 3 = 0 then 1 else 2 * b + 2 end as bigint) as seg_id from (
select z, y, x, line, cast(floor(z / 8.0) * 4 + floor(y / 8.0) * 2 + floor(x / 8.0) as bigint) as b from (
select cast(floor(l_orderkey / 256.0) as bigint) as z, l_partkey % 16 as y, (l_suppkey * 7 + l_linenumber) % 16 as x, min(l_linenumber) as line
from lineitem group by 1, 2, 3) cells) blocks"""

# half-resolution companion of SEGMENTS
NUCLEI = """select z, y, x, cast(1 + floor(z / 4.0) * 4 + floor(y / 4.0) * 2 + floor(x / 4.0) as bigint) as seg_id from (
select distinct cast(floor(l_orderkey / 128.0) as bigint) as z, l_suppkey % 8 as y, (l_partkey + l_linenumber) % 8 as x
from lineitem) cells"""

VERTICES = "select o_orderkey as vid, o_orderkey * 2 + 1 as seg_id from orders"

# every line item is an edge: first lines link two orders of one 256-wide band, all others are self-loops
EDGES = """select l_orderkey as src, case when l_linenumber = 1
then cast(floor(l_orderkey / 256.0) as bigint) * 256 + (l_partkey * 7 + l_suppkey) % 256 else l_orderkey end as dst,
count(*) as mult from lineitem group by 1, 2"""

LOG_VERTICES = "select distinct user_id as vid, user_id + 10 as seg_id from events"

LOG_EDGES = "select s_suppkey as src, s_suppkey + s_nationkey as dst, cast(1 + s_nationkey % 3 as bigint) as mult from supplier"

CHANGES = """select event_id as line_no, case event_type when 'view' then '+' when 'click' then '-' when 'signup' then '+'
when 'error' then '-' else 'merge' end as op, user_id + 10 as v1,
case when value < 1 then null else user_id + 10 + cast(floor(value / 25) as bigint) end as v2 from events"""

MERGELIST = "select o_orderkey * 2 + 1 as sub_id, o_custkey * 2 + 1 as obj_id from orders"

# one task per order; the log is what the event stream says about them
TASKS = "select o_orderkey as chunk_id from orders"
TASK_LOG = """select cast(floor(event_id / 2.0) as bigint) as task_id, case when event_type = 'error' then 'failed' else 'completed' end as status,
case when event_type = 'error' then props else null end as error from events"""

ERROR_LOG = """select concat(case event_type when 'error' then 'Error processing chunk ' when 'view' then 'Failed to load segment '
else 'Processed chunk ' end, case when user_id % 2 = 0 then concat('[slice(', cast(event_id as varchar(20)), ', ', cast(event_id + 64 as varchar(20)),
', None), slice(0, ', cast(user_id as varchar(20)), ', None), slice(64, 128, None)]') else 'at unknown place' end, ': ', props) as value from events"""

ARRAYS = """select s_suppkey as array_id, case s_nationkey % 4 when 0 then 'uint8' when 1 then 'uint16' when 2 then 'uint32' else 'float32' end as dtype,
cast(1000 + s_suppkey as bigint) as nz, cast(512 + s_nationkey as bigint) as ny, cast(700 as bigint) as nx from supplier"""
