"""SELECT shapes admitted by guarded SQL: one query per shape, over attached layers."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundsheet.layer import Layer
from groundsheet.operators import guarded, intervals, quantiles
from groundsheet.plans import derived
from groundsheet.plans.catalog import query

NAMES = [*derived.TABLES, *derived.SQL]


def run(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Attach the layers the text names, whole, and run it through the guard.

    Texts with geometry names are heavy per row, so their layers use all cores.
    """
    heavy = "ST_" in sql
    words = set(re.findall(r"[a-z_]+", sql.lower()))
    items = []
    for name in NAMES:
        if name in words:
            make = derived.table if name in derived.TABLES else derived.layer
            items.append(guarded.Attach(name, Layer(name, make(spark, sf_dir, name, spread=heavy)), max_records=None))
    return guarded.spatial_sql(spark, sql, items, max_rows=None).df


def shape(name: str, sql: str, oracle: str | None = None, layers: tuple[str, ...] = ()) -> None:
    """Register a guarded query; the check runs the same text unless told otherwise."""
    text = oracle or sql
    if layers:
        head = derived.ctes(*layers)
        body = text.strip()
        text = head + (", " + body[5:] if body.lower().startswith("with ") else body)
    query(name, text)(lambda spark, sf_dir: run(spark, sf_dir, sql))


shape(
    "e1_guarded_sql",
    """select z.name as zone, count(*) as sites, round(sum(s.acctbal), 2) as balance
       from sites s join zones z on z.x0 = cast(floor((s.lon + 180) / 72) * 72 - 180 as double)
         and z.y0 = cast(floor((s.lat + 80) / 32) * 32 - 80 as double)
       where s.segment <> 'BUILDING' group by z.name""",
    layers=("sites", "zones"),
)

# Web Mercator written out, for the check
_METRES = "6378137 * radians({p}.lon) as mx, 6378137 * ln(tan(pi() / 4 + radians({p}.lat) / 2)) as my"

shape(
    "e1_spatial_sql",
    """select s.id as id, d.id as depot, s.name as name from sites s join depots d
         on ST_DWithin(ST_Transform(ST_Point(s.lon, s.lat), 'EPSG:4326', 'EPSG:3857'),
                       ST_Transform(ST_Point(d.lon, d.lat), 'EPSG:4326', 'EPSG:3857'), 400000)
       where s.acctbal > d.acctbal""",
    f"""select s.id as id, d.id as depot, s.name as name
        from (select *, {_METRES.format(p="sites")} from sites) s
        join (select *, {_METRES.format(p="depots")} from depots) d
          on sqrt((s.mx - d.mx) * (s.mx - d.mx) + (s.my - d.my) * (s.my - d.my)) <= 400000
        where s.acctbal > d.acctbal""",
    layers=("sites", "depots"),
)

shape(
    "e1_buffer_join",
    """with b as (select id, ST_Buffer(ST_Point(lon, lat), 2.995) as buf from depots)
       select b.id as id, z.id as zone, z.name as name
       from b join zones z on ST_Intersects(b.buf, ST_MakeEnvelope(z.x0, z.y0, z.x1, z.y1))""",
    """with b as (select * from depots),
       far as (select b.id as id, z.id as zone, z.name as name,
                      greatest(z.x0 - lon, lon - z.x1, 0) as dx, greatest(z.y0 - lat, lat - z.y1, 0) as dy from b, zones z)
       select id, zone, name from far where sqrt(dx * dx + dy * dy) <= 2.995""",
    layers=("depots", "zones"),
)

shape(
    "e1_outer_join",
    """select d.id as id, f.id as footprint, f.segment as segment
       from depots d left join footprints f
         on ST_Intersects(ST_MakeEnvelope(f.x0, f.y0, f.x1, f.y1), ST_Point(d.lon, d.lat)) and f.segment <> 'BUILDING'""",
    """select d.id as id, f.id as footprint, f.segment as segment
       from depots d left join footprints f on d.lon between f.x0 and f.x1 and d.lat between f.y0 and f.y1 and f.segment <> 'BUILDING'""",
    layers=("depots", "footprints"),
)

shape(
    "e2_sql_collecting_names",
    """select segment, ST_GeometryType(ST_Collect(ST_Point(x0, y0))) as kind, ST_NPoints(ST_Collect(ST_Point(x0, y0))) as points,
         ST_XMin(ST_Extent(ST_MakeEnvelope(x0, y0, x1, y1))) as west, ST_YMax(ST_Extent(ST_MakeEnvelope(x0, y0, x1, y1))) as north,
         round(sum(ST_Length(ST_MakeLine(ST_Point(x0, y0), ST_Point(x1, y1)))), 4) as diagonals,
         round(sum(ST_Area(ST_GeomFromWKB(ST_AsWKB(ST_MakeEnvelope(x0, y0, x1, y1))))), 4) as area
       from footprints group by segment""",
    """select segment, 'GEOMETRYCOLLECTION' as kind, cast(count(*) as int) as points, min(x0) as west, max(y1) as north,
         round(sum(sqrt((x1-x0)*(x1-x0)+(y1-y0)*(y1-y0))), 4) as diagonals, round(sum((x1-x0)*(y1-y0)), 4) as area
       from footprints group by segment""",
    layers=("footprints",),
)

shape(
    "p1_projection",
    """select distinct l_returnflag as flag, upper(l_linestatus) as status,
         case when l_quantity < 10 then 'small' when l_quantity < 30 then 'medium' else 'large' end as size
       from lineitem""",
)

shape(
    "p2_filters",
    """select o_orderkey, o_orderpriority, o_totalprice from orders
       where o_totalprice between 50000 and 250000 and o_orderstatus in ('F', 'O')
         and o_orderpriority like '%-%' and o_orderpriority not like '5%'
         and o_orderpriority ilike '%h%' and o_custkey is not null""",
)

shape(
    "p3_inner_join",
    """select c.c_mktsegment as segment, o.o_orderstatus as status, count(*) as n, round(sum(o.o_totalprice), 2) as total
       from orders o join customer c on o.o_custkey = c.c_custkey
       group by c.c_mktsegment, o.o_orderstatus""",
)

shape(
    "p4_outer_joins",
    """with s as (select s_nationkey as k, count(*) as suppliers from supplier where s_acctbal > 5000 group by s_nationkey),
            c as (select c_nationkey as k, count(*) as customers from customer where c_acctbal > 9500 group by c_nationkey)
       select n.n_name as nation, coalesce(x.k, -1) as k, coalesce(x.suppliers, 0) as suppliers, coalesce(x.customers, 0) as customers
       from (select coalesce(s.k, c.k) as k, s.suppliers, c.customers from s full outer join c on s.k = c.k) x
       right join nation n on n.n_nationkey = x.k""",
)

shape(
    "p4_left_join",
    """select c.c_custkey as custkey, count(o.o_orderkey) as orders, round(coalesce(sum(o.o_totalprice), 0), 2) as total
       from customer c left join orders o on o.o_custkey = c.c_custkey and o.o_orderstatus = 'P'
       group by c.c_custkey""",
)

shape(
    "p5_semi_join",
    """select c_custkey, c_name from customer c
       where exists (select 1 from orders o where o.o_custkey = c.c_custkey and o.o_totalprice > 400000)
         and c_nationkey in (select n_nationkey from nation where n_regionkey in (1, 2))""",
)

shape(
    "p5_anti_join",
    """select p_partkey, p_name from part p
       where not exists (select 1 from lineitem l where l.l_partkey = p.p_partkey and l.l_quantity > 45)""",
)

shape(
    "p8_grouping",
    """select l_returnflag, l_linestatus, count(*) as n, count(distinct l_suppkey) as suppliers,
         count(*) filter (where l_discount > 0.05) as discounted, round(avg(l_extendedprice), 3) as price
       from lineitem group by l_returnflag, l_linestatus having count(*) > 100""",
)

shape(
    "p9_rollup",
    """select l_returnflag, l_linestatus, count(*) as n, round(sum(l_quantity), 2) as qty
       from lineitem group by rollup(l_returnflag, l_linestatus)""",
)

shape(
    "p9_cube",
    """select o_orderstatus, o_orderpriority, count(*) as n, cast(grouping(o_orderstatus) as int) as all_status
       from orders group by cube(o_orderstatus, o_orderpriority)""",
)

shape(
    "p9_grouping_sets",
    """select c_mktsegment, c_nationkey, count(*) as n, round(sum(c_acctbal), 2) as balance
       from customer group by grouping sets ((c_mktsegment), (c_nationkey), ())""",
)

shape(
    "p10_ranking",
    """select o_orderkey, row_number() over w as rn, rank() over w as rk, dense_rank() over w as drk,
         ntile(4) over (partition by o_custkey order by o_totalprice desc, o_orderkey) as quartile
       from orders window w as (partition by o_custkey order by o_totalprice desc, o_orderkey)""",
)

shape(
    "p10_top_per_group",
    """select segment, custkey, balance from (
         select c_mktsegment as segment, c_custkey as custkey, c_acctbal as balance,
           row_number() over (partition by c_mktsegment order by c_acctbal desc, c_custkey) as rn
         from customer) t where rn <= 5""",
)

shape(
    "p11_analytic",
    """select event_id, user_id,
         round(lag(value) over w, 3) as before, round(lead(value, 2) over w, 3) as after,
         first_value(event_type) over w as first_type,
         round(sum(value) over (partition by user_id order by event_id rows between 3 preceding and current row), 3) as moving,
         count(*) over (partition by user_id order by event_id range between 50 preceding and 50 following) as near
       from events window w as (partition by user_id order by event_id)""",
)

shape(
    "p12_topk",
    """select l_orderkey, l_linenumber, l_extendedprice from lineitem
       order by l_extendedprice desc, l_orderkey, l_linenumber, l_partkey limit 100 offset 20""",
)

shape(
    "p13_union_all",
    """select c_nationkey as k, 'customer' as kind from customer where c_acctbal < 0
       union all select s_nationkey, 'supplier' from supplier where s_acctbal < 0""",
)

shape(
    "p13_set_operations",
    """select k, 'both' as part from (select c_nationkey as k from customer intersect select s_nationkey from supplier) a
       union select k, 'orders only' from (select o_custkey % 97 as k from orders except select c_custkey % 89 from customer) b""",
)

shape(
    "p14_subqueries",
    """with big as (select o_custkey as k, sum(o_totalprice) as total from orders group by o_custkey)
       select c.c_custkey as custkey, round(b.total, 2) as total,
         (select count(*) from orders o where o.o_custkey = c.c_custkey and o.o_orderstatus = 'F') as done
       from customer c join big b on b.k = c.c_custkey
       where b.total > (select avg(total) from big)""",
)

shape(
    "p14_recursive",
    """with recursive weeks(k) as (
         select 0 as k union all select k + 1 from weeks where k < 12)
       select w.k as k, count(o.o_orderkey) as n, round(coalesce(sum(o.o_totalprice), 0), 2) as total
       from weeks w left join orders o on o.o_orderkey % 13 = w.k group by w.k""",
)

shape(
    "p15_strings",
    """select p_partkey, replace(p_name, ' ', '_') as name, concat(p_brand, '/', lower(p_type)) as code,
         trim(concat('  ', p_name, ' ')) as trimmed, substr(p_name, 1, 3) as head, length(p_name) as chars,
         regexp_replace(p_brand, '[^0-9]', '') as digits, upper(left(p_type, 4)) as kind,
         position('e' in p_name) as at_e, reverse(p_type) as back, lpad(p_brand, 12, '.') as padded
       from part""",
    """select p_partkey, replace(p_name, ' ', '_') as name, concat(p_brand, '/', lower(p_type)) as code,
         trim(concat('  ', p_name, ' ')) as trimmed, substr(p_name, 1, 3) as head, length(p_name) as chars,
         regexp_replace(p_brand, '[^0-9]', '', 'g') as digits, upper(left(p_type, 4)) as kind,
         position('e' in p_name) as at_e, reverse(p_type) as back, lpad(p_brand, 12, '.') as padded
       from part""",
)

shape(
    "p16_dates",
    """select cast(date_trunc('month', o_orderdate) as date) as month, extract(year from o_orderdate) as y,
         count(*) as n, max(datediff(cast('2002-01-01' as date), cast(o_orderdate as date))) as age,
         min(cast(date_add(cast(o_orderdate as date), 30) as date)) as due
       from orders group by cast(date_trunc('month', o_orderdate) as date), extract(year from o_orderdate)""",
    """select cast(date_trunc('month', o_orderdate) as date) as month, extract(year from o_orderdate) as y,
         count(*) as n, max(date_diff('day', cast(o_orderdate as date), cast('2002-01-01' as date))) as age,
         min(cast(cast(o_orderdate as date) + 30 as date)) as due
       from orders group by cast(date_trunc('month', o_orderdate) as date), extract(year from o_orderdate)""",
)

shape(
    "p17_math",
    """select id, round(sqrt(abs(acctbal)), 3) as root, round(sin(radians(lat)), 6) as s, round(cos(radians(lon)), 6) as c,
         round(power(lat / 10, 2), 3) as p, round(ln(1 + abs(acctbal)), 6) as l, floor(lon) as f, ceil(lat) as u,
         sign(acctbal) as sg, round(exp(lat / 100), 6) as e, id % 7 as m, greatest(lon, lat) as g
       from sites""",
    """select id, round(sqrt(abs(acctbal)), 3) as root, round(sin(radians(lat)), 6) as s, round(cos(radians(lon)), 6) as c,
         round(power(lat / 10, 2), 3) as p, round(ln(1 + abs(acctbal)), 6) as l, cast(floor(lon) as bigint) as f,
         cast(ceil(lat) as bigint) as u, cast(sign(acctbal) as double) as sg, round(exp(lat / 100), 6) as e,
         id % 7 as m, greatest(lon, lat) as g
       from sites""",
    layers=("sites",),
)

shape(
    "p18_nested",
    """select vec_id, v.pos as pos, round(v.x, 5) as x from (
         select vec_id, posexplode(transform(embedding, e -> cast(e as double) * 2)) as (pos, x) from embeddings) v""",
    """select vec_id, cast(pos as int) as pos, round(x, 5) as x from (
         select vec_id, unnest(list_transform(embedding, lambda e: cast(e as double) * 2)) as x,
           unnest(range(len(embedding))) as pos from embeddings) v""",
)

shape(
    "p18_structs_and_maps",
    """select m['k'] as event_type, s.u as user_id, size(m) as entries, round(s.v, 3) as v
       from (select map('k', event_type, 'id', cast(event_id as string)) as m, named_struct('u', user_id, 'v', value) as s
             from events) t""",
    """select event_type, user_id, cast(2 as int) as entries, round(value, 3) as v from events""",
)

shape(
    "p19_json",
    """select event_type, cast(get_json_object(props, '$.k') as int) as k, count(*) as n, round(sum(value), 2) as total
       from events group by event_type, cast(get_json_object(props, '$.k') as int)""",
    """select event_type, cast(json_extract_string(props, '$.k') as int) as k, count(*) as n, round(sum(value), 2) as total
       from events group by event_type, cast(json_extract_string(props, '$.k') as int)""",
)

shape(
    "p20_quantiles",
    """select l_returnflag, round(percentile(l_quantity, 0.5), 4) as median, round(percentile(l_quantity, 0.9), 4) as p90,
         round(percentile(l_discount, 0.25), 4) as q1
       from lineitem group by l_returnflag""",
    """select l_returnflag, round(quantile_cont(l_quantity, 0.5), 4) as median, round(quantile_cont(l_quantity, 0.9), 4) as p90,
         round(quantile_cont(l_discount, 0.25), 4) as q1
       from lineitem group by l_returnflag""",
)

shape(
    "p20_histogram",
    """select least(10, cast(floor(l_quantity / 5) as int)) as bin, count(*) as n, min(l_quantity) as lo, max(l_quantity) as hi
       from lineitem group by least(10, cast(floor(l_quantity / 5) as int))""",
)

shape(
    "p20_mode",
    """select c_nationkey, mode() within group (order by c_mktsegment) as usual, count(*) as n from (
         select c_nationkey, min(c_mktsegment) as c_mktsegment from customer group by c_nationkey, c_custkey) t
       group by c_nationkey""",
    """with counts as (select c_nationkey, c_mktsegment, count(*) as n from customer group by c_nationkey, c_mktsegment),
         best as (select *, row_number() over (partition by c_nationkey order by n desc, c_mktsegment) as rn,
                    sum(n) over (partition by c_nationkey) as total from counts)
       select c_nationkey, c_mktsegment as usual, cast(total as bigint) as n from best where rn = 1""",
)

shape(
    "e2_sql_geometry_names",
    """select id, round(ST_Area(ST_MakeEnvelope(x0, y0, x1, y1)), 6) as area,
         round(ST_Perimeter(ST_MakeEnvelope(x0, y0, x1, y1)), 6) as perimeter,
         ST_Intersects(ST_MakeEnvelope(x0, y0, x1, y1), ST_MakeEnvelope(cast(-20 as double), cast(-20 as double), cast(40 as double), cast(40 as double))) as meets,
         ST_Contains(ST_MakeEnvelope(cast(-20 as double), cast(-20 as double), cast(40 as double), cast(40 as double)), ST_MakeEnvelope(x0, y0, x1, y1)) as inside,
         ST_Within(ST_Point((x0 + x1) / 2, (y0 + y1) / 2), ST_MakeEnvelope(x0, y0, x1, y1)) as middle,
         ST_X(ST_Point(x0, y1)) as x, ST_Y(ST_Point(x0, y1)) as y,
         round(ST_Distance(ST_Point(x0, y0), ST_Point(x1, y1)), 6) as diagonal,
         ST_DWithin(ST_Point(x0, y0), ST_Point(x1, y1), 6.0) as small,
         round(ST_Length(ST_GeomFromText(concat('LINESTRING (', x0, ' ', y0, ', ', x1, ' ', y0, ')'))), 6) as width,
         ST_AsText(ST_GeomFromText('POINT (1 2.5)')) as sample
       from footprints""",
    """select id, round((x1-x0)*(y1-y0), 6) as area, round(2*((x1-x0)+(y1-y0)), 6) as perimeter,
         x0 <= 40 and x1 >= -20 and y0 <= 40 and y1 >= -20 as meets,
         x0 >= -20 and x1 <= 40 and y0 >= -20 and y1 <= 40 as inside, true as middle, x0 as x, y1 as y,
         round(sqrt((x1-x0)*(x1-x0)+(y1-y0)*(y1-y0)), 6) as diagonal,
         sqrt((x1-x0)*(x1-x0)+(y1-y0)*(y1-y0)) <= 6.0 as small, round(x1-x0, 6) as width, 'POINT (1 2.5)' as sample
       from footprints""",
    layers=("footprints",),
)


# --- shapes Spark SQL has no own join for ---------------------------------------------------


@query(
    "p6_range_join",
    """select o.o_orderkey as o_orderkey, e.event_id as event_id
       from orders o join events e
         on e.value * 1000 between o.o_totalprice - 20 and o.o_totalprice + 20""",
)
def range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bands around prices, and the events whose value lies in them."""
    orders = derived.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        (F.col("o_totalprice") - 20).alias("lo"),
        (F.col("o_totalprice") + 20).alias("hi"),
    )
    events = derived.table(spark, sf_dir, "events").select("event_id", (F.col("value") * 1000).alias("v"))
    return intervals.range_join(orders, events, "lo", "hi", "v").select("o_orderkey", "event_id")


@query(
    "p7_asof_join",
    """select p.event_id as event_id, p.user_id as user_id, c.event_id as click_id, round(c.value, 3) as click_value
       from (select * from events where event_type <> 'click') p
       asof left join (select * from events where event_type = 'click') c
         on p.user_id = c.user_id and p.ts >= c.ts""",
)
def asof_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest click at or before every other event of the user."""
    events = derived.table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value")
    clicks, others = events.where("event_type = 'click'"), events.where("event_type <> 'click'")
    found = intervals.asof_join(others, clicks, ["user_id"], "ts", "ts", "event_id")
    return found.select(
        "event_id", "user_id",
        F.col("match.event_id").alias("click_id"), F.round("match.value", 3).alias("click_value"),
    )


@query(
    "p20_group_quantiles",
    """select l_suppkey, p, round(case p when 0.1 then a[1] when 0.5 then a[2] else a[3] end, 4) as price from (
         select l_suppkey, quantile_cont(cast(l_extendedprice as double), [0.1, 0.5, 0.99]) as a from lineitem group by l_suppkey) t,
         (select unnest([0.1e0, 0.5e0, 0.99e0]) as p) ps""",
)
def group_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    found = quantiles.group_quantiles(lines, ["l_suppkey"], "l_extendedprice", [0.1, 0.5, 0.99])
    return found.select("l_suppkey", "p", F.round("value", 4).alias("price"))
