import pytest

from groundsheet.layer import Layer
from groundsheet.operators import guard, guarded

NAMES = {"wells", "t"}

# One text for each part of Spark's query grammar.
ACCEPTED = [
    "select depth from wells", "\n(select 2 as n)", "select 7;", "with deep as (select * from wells where depth > 90) select count(*) from deep",
    "/* why */ select upper(owner) o, 'insert into t' as quoted -- end\nfrom wells",
    "with recursive step(n) as (select 0 union all select n + 5 from step where n < 40) select max(n) from step",
    "select w.* except (owner) from wells w left join t using (id) where w.id not in (select id from t) or not exists (select 1 from t where t.id = w.id)",
    "select owner, sum(depth) filter (where depth is not null) from wells group by rollup (owner) having count(*) >= 2 order by 2 desc nulls last limit 9 offset 3",
    "select rank() over (partition by owner order by depth rows between 1 preceding and current row) from wells",
    "select lag(a) over u from t window u as (order by b)", "select k, v from t lateral view outer explode(m) x as k, v",
    "select case a when 1 then 'x' else cast(b as string) end, c between 1 and 2, d like 'p%', -e, f[0], g.h from t",
    "select transform(xs, x -> x * 2) from t", "select a from t union all select a from wells", "select a from t except select a from wells",
    "select a from t intersect select a from wells", "select * from t tablesample (20 percent)", "select * from range(4)",
    "select * from (values (1, 'a'), (2, 'b')) as v(n, s)", "select * from t pivot (max(a) for b in ('x', 'y'))", "select /*+ merge(t) */ 1 from t",
]
REFUSED = [
    "", "values (1)", "explain select 1", "show tables", "describe wells", "set spark.sql.ansi.enabled = false", "use other",
    "truncate table wells", "alter table wells add column x int", "create view v as select 1", "drop view wells", "cache table wells",
    "insert overwrite wells select * from t", "merge into wells using t on wells.id = t.id when matched then delete",
    "select 1; select 2", "select 1 /* ; */; drop view t", "from wells insert into t select *",
    "select * from other_view", "select * from spark_catalog.default.wells", "select * from json.`/data/x.json`",
    "select (select max(id) from other_view) from t", "with a as (select * from other_view) select * from a",
    "select * from identifier('other_view')", "select * from identifier('oth' || 'er_view') i join t", "select identifier('reflect')('java.lang.System', 'lineSeparator')",
    "select identifier('depth') from wells", "select reflect('java.lang.System', 'lineSeparator')", "select try_reflect('java.lang.System', 'lineSeparator') from t",
    "select transform(owner) using 'wc -l' from wells", "select * from read_files('/data')", "select * from wells version as of 3",
    "select * from t lateral view reflect('java.lang.System', 'lineSeparator') x", "select :p from t", "select " + "a + " * 6000 + "a from t",
]


@pytest.mark.parametrize("sql", ACCEPTED)
def test_accepted(spark, sql):
    guard.check_query(spark, sql, NAMES)


@pytest.mark.parametrize("sql", REFUSED, ids=range(len(REFUSED)))
def test_refused(spark, sql):
    with pytest.raises(guard.Refused):
        guard.check_query(spark, sql, NAMES)


@pytest.mark.parametrize("text", ["true", "depth <= 12.5 or owner ilike '%; drop%'", "coalesce(size(tags), 0) = 2", "owner in ('a', 'b') and not dry"])
def test_fragment_accepted(spark, text):
    guard.check_fragment(spark, text)


@pytest.mark.parametrize(
    "text",
    [
        "true; drop view t", "depth > (select avg(depth) from t)", "depth in (select 1)", "exists (select 1)", "true union select 1",
        "java_method('java.lang.System', 'lineSeparator') = ''", "identifier('reflect')('java.lang.System', 'lineSeparator') = ''", ":p = 1",
    ],
)
def test_fragment_refused(spark, text):
    with pytest.raises(guard.Refused):
        guard.check_fragment(spark, text)


@pytest.mark.parametrize("name, ok", [("wells", True), ("W_3", True), ("_", True), ("3w", False), ("w-x", False), ("w.x", False), ("w'", False), (" ", False)])
def test_names(name, ok):
    assert guard.is_name(name) is ok


def test_caps_and_flags(spark):
    layer = Layer("numbers", spark.range(50).toDF("id"))
    item = guarded.Attach("numbers", layer, "id >= 10", max_records=20)
    result = guarded.spatial_sql(spark, "select id from numbers", [item], max_rows=15)
    answer = result.fetch()
    assert (answer["row_count"], answer["truncated"]) == (15, True)
    assert len(answer["rows"]) == 15 and result.df.count() == 15
    assert result.attached[0].truncated()
    whole = guarded.spatial_sql(spark, "select id from numbers", [guarded.Attach("numbers", layer)], max_rows=100)
    assert whole.fetch()["truncated"] is False and not whole.attached[0].truncated()
    assert guarded.spatial_sql(spark, "select id from numbers", [guarded.Attach("numbers", layer)]).df.count() == 50
