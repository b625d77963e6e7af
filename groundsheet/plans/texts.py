"""Text folding and ranked search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundsheet.functions import text
from groundsheet.operators import lineage, search
from groundsheet.plans.catalog import query
from groundsheet.plans.derived import table

# Unicode white space for DuckDB's regular expressions (fixed values).
SPACE = (
    r"[\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)


def sql_normalize(c: str) -> str:
    fold = f"translate(lower({c}), '{text.FOLD_FROM + text.DROPPED}', '{text.FOLD_TO}')"
    one = f"case when regexp_matches(lower({c}), '{text.ARABIC_BLOCK}') then {fold} else lower({c}) end"
    return f"trim(regexp_replace({one}, '{SPACE}', ' ', 'g'))"


def sql_tokens(c: str) -> str:
    words = rf"list_filter(regexp_split_to_array({c}, '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"
    return (
        f"list_transform({words}, lambda w: case when length(w) > 4 and starts_with(w, '{text.ARTICLE}') "
        "then substr(w, 3) else w end)"
    )


# Every customer gets an Arabic place name with marks, long strokes and Arabic digits.
ARABIC = "concat(' وَاحَــةُ  الأندلسية ', translate(cast(c_custkey as varchar(20)), '0123456789', '٠١٢٣٤٥٦٧٨٩'), ' ', c_name)"


@query(
    "t1_normalize",
    f"""select 'doc' as source, doc_id as id, md5({sql_normalize("text")}) as folded from documents
        union all select 'customer', c_custkey, md5({sql_normalize("label")})
        from (select c_custkey, {ARABIC} as label from customer) c""",
)
def normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", spread=True).select(F.lit("doc").alias("source"), F.col("doc_id").alias("id"), "text")
    names = table(spark, sf_dir, "customer").select(F.lit("customer"), "c_custkey", F.expr(ARABIC))
    return docs.union(names).select("source", "id", F.md5(text.normalize("text")).alias("folded"))


@query(
    "t2_match_normalized",
    f"""select c_custkey, {sql_normalize("label")} as folded from (select c_custkey, {ARABIC} as label from customer) c
        where {sql_normalize("label")} like concat('%', {sql_normalize("'الاندلسيه ١'")}, '%')""",
)
def match_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "customer").select("c_custkey", F.expr(ARABIC).alias("label"))
    hits = text.match_normalized(names, "label", "الاندلسيه ١", like=True)
    return hits.select("c_custkey", text.normalize("label").alias("folded"))


@query(
    "t3_tokenize",
    f"""select doc_id, len(words) as n, md5(array_to_string(words, ' ')) as words
        from (select doc_id, {sql_tokens(sql_normalize("text"))} as words from documents) d""",
)
def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", spread=True).select("doc_id", text.tokenize(text.normalize("text")).alias("words"))
    return docs.select(
        "doc_id", F.size("words").cast("long").alias("n"), F.md5(F.array_join("words", " ")).alias("words")
    )


WORDS = f"""words as (select doc_id as doc, {sql_tokens(sql_normalize("text"))} as words from documents),
    postings as (select doc, term, dl, count(*) as tf from (select doc, len(words) as dl, unnest(words) as term from words) w
                 group by doc, term, dl),
    terms as (select term, count(*) as df from postings group by term),
    totals as (select count(*) as n, avg(len(words)) as avgdl from words)"""


@query(
    "t4_bm25_index",
    f"""with {WORDS} select p.term as term, max(t.df) as df, cast(sum(p.tf) as bigint) as uses,
          max(s.n) as n, round(max(s.avgdl), 6) as avgdl
        from postings p join terms t on p.term = t.term, totals s group by p.term""",
)
def bm25_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index tables, summed up per term for the check."""
    index = search.bm25_index(
        table(spark, sf_dir, "documents", spread=True), lineage.scratch_path(spark, "index")
    )
    uses = index.postings.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("uses"))
    total = lambda c: index.totals.select(c).scalar()
    return uses.withColumns({"n": total("n"), "avgdl": F.round(total("avgdl"), 6)})



@query(
    "t5_bm25_search",
    rf"""with {WORDS},
        q as (select item_id, term, count(*) as times from (
                select item_id, unnest({sql_tokens(sql_normalize("text"))}) as term
                from benchmark) b group by item_id, term),
        scored as (select q.item_id as item_id, p.doc as doc,
            sum(q.times * ln((s.n - t.df + 0.5) / (t.df + 0.5) + 1.0) * p.tf * 2.5
                / (p.tf + 1.5 * (0.25 + 0.75 * p.dl / greatest(s.avgdl, 1)))) as score
          from q join postings p on p.term = q.term join terms t on t.term = q.term, totals s group by q.item_id, p.doc),
        ranked as (select *, row_number() over (partition by item_id order by round(score, 9) desc, doc) as rank
                   from scored where score > 0)
        select item_id, doc, round(score, 6) as score, rank from ranked where rank <= 10""",
)
def bm25_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = search.bm25_index(
        table(spark, sf_dir, "documents", spread=True), lineage.scratch_path(spark, "index")
    )
    asked = table(spark, sf_dir, "benchmark").select("item_id", "text")
    hits = search.bm25_search(index, asked, 10, query="item_id")
    return hits.select("item_id", "doc", F.round("score", 6).alias("score"), "rank")


@query(
    "t6_translate_fallback",
    """with labels as (select source as key, lang as locale, min(text) as label from documents group by source, lang),
         keys as (select distinct source as key from documents)
       select k.key as key, coalesce(f.label, e.label) as label, f.label is null as is_fallback
       from keys k left join labels f on f.key = k.key and f.locale = 'es'
       left join labels e on e.key = k.key and e.locale = 'en'""",
)
def translate_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = docs.groupBy(F.col("source").alias("key"), F.col("lang").alias("locale")).agg(
        F.min("text").alias("label")
    )
    keys = docs.select(F.col("source").alias("key")).distinct()
    out = text.translate_fallback(keys, labels, "es")
    return out.withColumn("is_fallback", F.coalesce("is_fallback", F.lit(True)))
