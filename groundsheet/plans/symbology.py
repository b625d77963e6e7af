"""Class breaks and colours as data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundsheet.operators import breaks
from groundsheet.plans.catalog import query
from groundsheet.plans.derived import table

# Sample ramps and thresholds for the queries (fixed values).
RAMP = ["#fee5d9", "#fcae91", "#fb6a4a", "#de2d26", "#a50f15"]
MANUAL = [
    {"min": 0, "max": 100000, "color": RAMP[0]},
    {"min": 100000, "max": 200000, "color": RAMP[1]},
    {"min": None, "max": None, "color": "#000000"},
    {"min": 200000, "max": 400000, "color": RAMP[2]},
    {"min": 400000, "max": None, "color": RAMP[3]},
]
STATUS = [{"value": "F", "color": "#1b9e77"}, {"value": "O", "color": "#d95f02"}]


def _rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _class_rows(edges: list[str], source: str) -> str:
    rows = [
        f"select {i + 1} as class, round({a}, 4) as lo, round({b}, 4) as hi from s"
        for i, (a, b) in enumerate(zip(edges, edges[1:]))
    ]
    return f"with s as ({source}) " + " union all ".join(rows)


@query(
    "s1_distribution",
    """with s as (select count(o_totalprice) as n, min(o_totalprice) as lo, max(o_totalprice) as hi,
                    avg(o_totalprice) as mean, stddev(o_totalprice) as sd,
                    quantile_cont(o_totalprice, [0.05, 0.25, 0.5, 0.75, 0.95]) as q from orders)
       select 'stat' as part, 'count' as item, round(cast(n as double), 3) as value from s
       union all select 'stat', 'min', round(lo, 3) from s union all select 'stat', 'max', round(hi, 3) from s
       union all select 'stat', 'avg', round(mean, 3) from s union all select 'stat', 'stddev', round(sd, 3) from s
       union all select 'percentile', 'p5', round(q[1], 3) from s union all select 'percentile', 'p25', round(q[2], 3) from s
       union all select 'percentile', 'p50', round(q[3], 3) from s union all select 'percentile', 'p75', round(q[4], 3) from s
       union all select 'percentile', 'p95', round(q[5], 3) from s
       union all select 'bin', cast(least(10, cast(floor((o_totalprice - lo) / ((hi - lo) / 10)) as int) + 1) as varchar),
                        cast(count(*) as double) from orders, s group by 2""",
)
def distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(breaks.distribution(table(spark, sf_dir, "orders"), "o_totalprice"), 3)


@query(
    "s2_breaks_quantile",
    _class_rows(
        [f"q[{i}]" for i in range(1, 7)],
        "select quantile_cont(l_extendedprice, [0, 0.2, 0.4, 0.6, 0.8, 1]) as q from lineitem",
    ),
)
def breaks_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(breaks.breaks_quantile(table(spark, sf_dir, "lineitem"), "l_extendedprice", 5))


@query(
    "s3_breaks_equal_interval",
    _class_rows([f"lo + (hi - lo) * {i} / 6" for i in range(7)], "select min(c_acctbal) as lo, max(c_acctbal) as hi from customer"),
)
def breaks_equal_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(breaks.breaks_equal_interval(table(spark, sf_dir, "customer"), "c_acctbal", 6))


def _natural(rows: str, k: int) -> str:
    """The optimum over all distinct values of ``rows`` (v), by dynamic programming."""
    cost = "greatest(e.q - b.q - (e.s - b.s) * (e.s - b.s) / (e.w - b.w), 0)"
    best = "c1 as (select e.i as j, e.q - e.s * e.s / e.w as cost, 0::bigint as cut from p e where e.i > 0)"
    for c in range(2, k + 1):
        best += f""", c{c} as (select e.i as j, min(l.cost + {cost}) as cost, arg_min(b.i, l.cost + {cost}) as cut
            from p e join p b on b.i < e.i join c{c - 1} l on l.j = b.i group by e.i)"""
    cuts = f"k{k} as (select max(i) as j from p)"
    for c in range(k, 1, -1):
        cuts += f", k{c - 1} as (select cut as j from c{c} join k{c} using (j))"
    ends = " union all ".join(f"select {c} as class, j from k{c}" for c in range(1, k + 1))
    return f"""with raw as ({rows}),
        d as (select v, count(*) as n, (v - (select min(v) from raw)) / (select max(v) - min(v) from raw) as x from raw group by v),
        p as (select row_number() over (order by v) as i, v, sum(n * x) over o as s, sum(n * x * x) over o as q, sum(n) over o as w
              from d window o as (order by v) union all select 0, null, 0, 0, 0),
        {best}, {cuts}, ends as ({ends})
        select class::int as class, round(coalesce(lag(v) over (order by class), (select min(v) from raw)), 6) as lo, round(v, 6) as hi
        from ends join p on p.i = ends.j"""


FAR = "case when o_orderkey = 1 then 1e9::double else round(o_totalprice / 100) end"


@query("s4_breaks_jenks", _natural(f"select {FAR} as v from orders", 5))
def breaks_jenks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thousands of distinct values and one far off."""
    far = F.when(F.col("o_orderkey") == 1, 1e9).otherwise(F.round(F.col("o_totalprice") / 100))
    return _rounded(breaks.breaks_jenks(table(spark, sf_dir, "orders").select(far.alias("v")), "v", 5))


@query("s4_breaks_jenks_few", _natural("select o_custkey % 7 * (o_custkey % 7) + 0.5e0 as v from orders", 3))
def breaks_jenks_few(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = F.col("o_custkey") % 7
    return _rounded(breaks.breaks_jenks(table(spark, sf_dir, "orders").select((rest * rest + 0.5).alias("v")), "v", 3))


@query(
    "s5_breaks_stddev",
    _class_rows(
        ["lo", *[f"least(hi, greatest(lo, mean + ({i} - 2.5) * sd))" for i in range(1, 5)], "hi"],
        "select min(o_totalprice) as lo, max(o_totalprice) as hi, avg(o_totalprice) as mean, stddev(o_totalprice) as sd from orders",
    ),
)
def breaks_stddev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(breaks.breaks_stddev(table(spark, sf_dir, "orders"), "o_totalprice", 5))


@query("s6_categories", "select p_brand as value, count(*) as count from part group by p_brand")
def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return breaks.categories(table(spark, sf_dir, "part"), "p_brand")


@query(
    "s7_classify_graduated",
    f"""select o_orderkey, case when o_totalprice >= 400000 then '{RAMP[3]}' when o_totalprice >= 200000 then '{RAMP[2]}'
          when o_totalprice >= 100000 then '{RAMP[1]}' else '{RAMP[0]}' end as color from orders""",
)
def classify_graduated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return breaks.classify(table(spark, sf_dir, "orders"), "o_totalprice", MANUAL).select("o_orderkey", "color")


@query(
    "s7_classify_categorized",
    """select o_orderkey, case o_orderstatus when 'F' then '#1b9e77' when 'O' then '#d95f02' else '#cccccc' end as color
       from orders""",
)
def classify_categorized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return breaks.classify(table(spark, sf_dir, "orders"), "o_orderstatus", STATUS).select("o_orderkey", "color")


@query(
    "s8_legend",
    f"""with q as (select quantile_cont(o_totalprice, [0, 0.2, 0.4, 0.6, 0.8, 1]) as q from orders),
        c as (select unnest([1, 2, 3, 4, 5]) as class, unnest(q[1:5]) as lo, unnest(q[2:6]) as hi,
                unnest(['{"', '".join(RAMP)}']) as color from q),
        n as (select case when o_totalprice >= q[5] then 5 when o_totalprice >= q[4] then 4 when o_totalprice >= q[3] then 3
                       when o_totalprice >= q[2] then 2 else 1 end as class, count(*) as n from orders, q group by 1)
        select c.class as class, round(lo, 3) as lo, round(hi, 3) as hi, color, n from c join n on c.class = n.class""",
)
def legend(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    classes = breaks.spec_classes(breaks.breaks_quantile(orders, "o_totalprice", 5), RAMP)
    return _rounded(breaks.legend(orders, "o_totalprice", classes), 3).drop("label")
