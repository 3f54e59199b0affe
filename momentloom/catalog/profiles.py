"""Loading, profiles, histograms, counts, correlations, generated rows."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from momentloom.catalog.common import TEXT_SQL, rounded, significant, text_measures
from momentloom.catalog.registry import analysis
from momentloom.catalog.sqltext import hash32, normal, rd, rs, uniform
from momentloom.operators import linear, profile, schema
from momentloom.operators.moments import gram
from momentloom.operators.splits import hashed_fold
from momentloom.session import ensure_checkpoint_dir
from momentloom.sources import generate
from momentloom.sources.tables import grid, load, load_wide_csv_checked

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@analysis("S1", "select count(*) as n_rows, min(o_orderkey) as first_key, max(o_orderkey) as last_key from orders")
def load_orders(spark, folder):
    return load(spark, folder, "orders").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key")
    )


def _describe_sql(table, columns, digits=8):
    parts = []
    for name, kind in columns:
        if kind in ("string", "timestamp_ntz"):
            parts.append(
                f"select '{name}' as variable, null::double as mean, null::double as min, min({name})::varchar as min_text, null::double as median, "
                f"null::double as max, max({name})::varchar as max_text, count(*) filter ({name} is null) as nmissing, '{kind}' as eltype from {table}"
            )
        else:
            parts.append(
                f"select '{name}' as variable, {rs(f'avg({name})', digits)} as mean, {rs(f'min({name})', digits)} as min, null::varchar as min_text, "
                f"{rs(f'quantile_cont({name}::double, 0.5)', digits)} as median, {rs(f'max({name})', digits)} as max, null::varchar as max_text, "
                f"count(*) filter ({name} is null) as nmissing, '{kind}' as eltype from {table}"
            )
    return " union all ".join(parts)


LINEITEM_TYPES = [
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"), ("l_quantity", "double"),
    ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"),
]


@analysis("A1 P13", _describe_sql("lineitem", LINEITEM_TYPES))
def describe_lineitem(spark, folder):
    return significant(profile.describe(load(spark, folder, "lineitem")))


@analysis("A1 P13", _describe_sql("customer", [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"), ("c_mktsegment", "string")]))
def describe_customer(spark, folder):
    return significant(profile.describe(load(spark, folder, "customer")))


@analysis(
    "A2 A10",
    " union all ".join(
        f"select '{c}' as variable, {rs(f'avg({c})')} as mean, {rs(f'stddev_samp({c})')} as std, {rs(f'var_samp({c})')} as var, '{t}' as eltype from part"
        for c, t in [("p_partkey", "bigint"), ("p_size", "int"), ("p_retailprice", "double")]
    )
    + " union all select 'p_brand', null, null, null, 'string'",
)
def describe_chosen(spark, folder):
    table = load(spark, folder, "part").select("p_partkey", "p_size", "p_retailprice", "p_brand")
    return significant(profile.describe(table, ["mean", "std", "var", "eltype"]))


@analysis("A3", f"select {rd('avg(l_extendedprice)', 4)} as mean, {rd('stddev_samp(l_extendedprice)', 4)} as std from lineitem")
def mean_and_deviation(spark, folder):
    return rounded(profile.mean_std(load(spark, folder, "lineitem"), "l_extendedprice"), 4)


def _summary_sql(table, cols):
    return " union all ".join(
        f"select '{c}' as variable, count({c}) as n, count(*) filter ({c} is null) as nmissing, {rs(f'avg({c})')} as mean, {rs(f'min({c})')} as min, "
        f"{rs(f'quantile_cont({c}::double, 0.25)')} as q25, {rs(f'quantile_cont({c}::double, 0.5)')} as median, "
        f"{rs(f'quantile_cont({c}::double, 0.75)')} as q75, {rs(f'max({c})')} as max from {table}"
        for c in cols
    )


@analysis("A4 A5", _summary_sql("lineitem", LINE_NUMBERS))
def summary_lineitem(spark, folder):
    return significant(profile.summary_statistics(load(spark, folder, "lineitem"), LINE_NUMBERS))


@analysis("A4", _summary_sql("events", ["value"]))
def summary_events(spark, folder):
    return significant(profile.summary_statistics(load(spark, folder, "events"), ["value"]))


def _histogram_sql(source, col, bins, density=False):
    extra = f", {rd('coalesce(c.n, 0)/(e.total*e.w)', 9)} as density" if density else ""
    return f"""with e as (select min({col}) as lo, max({col}) as hi, (max({col})-min({col}))/{bins}e0 as w, count({col})::double as total from {source}),
    c as (select least(floor(({col}-lo)/w), {bins - 1})::int as bin, count(*) as n from {source}, e group by 1)
    select b.bin::int as bin, {rd('e.lo + b.bin*e.w', 4)} as low, {rd('e.lo + (b.bin+1)*e.w', 4)} as high, coalesce(c.n, 0)::bigint as n{extra}
    from (select unnest(range({bins})) as bin) b cross join e left join c on c.bin = b.bin"""


@analysis("A6", _histogram_sql("orders", "o_totalprice", 25))
def histogram_prices(spark, folder):
    return rounded(profile.histogram(load(spark, folder, "orders"), "o_totalprice", 25), 4)


@analysis("A7", _histogram_sql("customer", "c_acctbal", 20, True))
def density_balances(spark, folder):
    made = profile.histogram(load(spark, folder, "customer"), "c_acctbal", 20, normalize=True)
    return rounded(made, 4, density=9)


@analysis(
    "A7 P11",
    "with m as (select regr_slope(p_retailprice, p_partkey) as b, regr_intercept(p_retailprice, p_partkey) as a from part), "
    "r as (select a + b*p_partkey - p_retailprice as residual from part, m) "
    + _histogram_sql("r", "residual", 12, True).replace("with e as", ", e as", 1),
)
def residual_density(spark, folder):
    table = load(spark, folder, "part")
    model = linear.linear_regression(table, "p_retailprice", ["p_partkey"])
    errors = schema.residuals(model.predict(table), "prediction", "p_retailprice")
    return rounded(profile.histogram(errors, "residual", 12, normalize=True), 4, density=9)


@analysis("A8", "select l_returnflag, count(*) as n from lineitem group by l_returnflag")
def count_returnflags(spark, folder):
    return profile.countmap(load(spark, folder, "lineitem"), "l_returnflag")


@analysis("O6 U3 A13", "select distinct o_orderpriority from orders")
def priority_levels(spark, folder):
    return profile.levels(load(spark, folder, "orders"), "o_orderpriority")


def _corr_sql(source, cols, digits):
    cell = lambda i, j: f"select {i + 1} as i, {j + 1} as j, '{cols[i]}' as col_i, '{cols[j]}' as col_j, {rd('corr(' + cols[i] + ',' + cols[j] + ')', digits)} as r from {source}"
    return cell


_line_corr = _corr_sql("lineitem", LINE_NUMBERS, 6)
_text = ["n_chars", "n_spaces", "n_lines", "n_e"]
_text_corr = _corr_sql("t", _text, 6)


@analysis("A9", " union all ".join(_line_corr(i, j) for i in range(4) for j in range(4)))
def correlations_lineitem(spark, folder):
    return rounded(profile.corr_matrix(load(spark, folder, "lineitem"), LINE_NUMBERS))


@analysis("A9 P15", f"with t as {TEXT_SQL} " + " union all ".join(_text_corr(i, j) for i in range(4) for j in range(i, 4)))
def correlations_text_triangle(spark, folder):
    return rounded(profile.upper_triangle(profile.corr_matrix(text_measures(spark, folder), _text)))


@analysis(
    "A9 F3",
    f"with t as {TEXT_SQL} " + " union all ".join(_corr_sql("t", _text, 6)(i, j).replace(rd(f"corr({_text[i]},{_text[j]})", 6), rs(f"corr({_text[i]},{_text[j]})", 1)) for i in range(4) for j in range(4)),
)
def correlations_one_digit(spark, folder):
    return significant(profile.corr_matrix(text_measures(spark, folder), _text), 1)


_gram_cols = ["l_quantity", "l_discount", "l_tax"]


@analysis(
    "A11 R7",
    f"with t as (select *, floor({hash32('l_orderkey', 7)}*5/4294967296e0)::int as fold from lineitem) "
    + " union all ".join(
        f"select fold, '{a}' as i, '{b}' as j, {rs(f'sum({a}*{b})')} as value from t group by fold"
        for i, a in enumerate(_gram_cols)
        for b in _gram_cols[i:]
    ),
)
def gram_by_fold(spark, folder):
    table = load(spark, folder, "lineitem").withColumn("fold", hashed_fold("l_orderkey", 5, 7))
    return significant(gram(table, _gram_cols, by="fold"))


@analysis(
    "A11",
    f"""with e as (select label, embedding::double[] as v from embeddings), k as (select unnest(range(1, 65)) as a)
    select label, 'v' || i.a as i, 'v' || j.a as j, {rd('sum(v[i.a]*v[j.a])', 5)} as value from e, k i, k j where i.a <= j.a group by label, i.a, j.a""",
)
def embedding_gram_by_label(spark, folder):
    """Products of all 64 components of the embeddings for each label."""
    names = [f"v{k}" for k in range(1, 65)]
    table = load(spark, folder, "embeddings").select("label", *[F.col("embedding")[k].cast("double").alias(n) for k, n in enumerate(names)])
    return rounded(gram(table, names, by="label"), 5)


@analysis(
    "S4 J5",
    f"""with e as (select min(o_totalprice) as lo, max(o_totalprice) as hi from orders)
    select s::int as step, {rd('lo + (hi-lo)*s/99e0', 4)} as o_totalprice from e, (select unnest(range(100)) as s)""",
)
def grid_over_extent(spark, folder):
    return rounded(grid(load(spark, folder, "orders"), "o_totalprice", 100), 4)


@analysis(
    "S5",
    "select o_orderkey, " + ", ".join(f"{rd(uniform('o_orderkey', f'21.{j}'), 9)} as u{j + 1}" for j in range(4)) + " from orders",
)
def uniform_rows(spark, folder):
    drawn = generate.uniform(load(spark, folder, "orders"), "o_orderkey", 4, 21)
    return rounded(drawn.select("o_orderkey", *[F.col("u")[j].alias(f"u{j + 1}") for j in range(4)]), 9)


@analysis("S5 A8", f"select floor({uniform('o_orderkey', 22)}*10)::int as digit, count(*) as n from orders group by 1")
def uniform_digits(spark, folder):
    return profile.countmap(generate.digits(load(spark, folder, "orders"), "o_orderkey", 22), "digit")


_gumbel = f"(select -ln(-ln({uniform('o_orderkey', 1234)})) as x from orders)"


@analysis("S6 A3", f"select {rd('avg(x)')} as mean, {rd('stddev_samp(x)')} as std from {_gumbel}")
def gumbel_moments(spark, folder):
    return rounded(profile.mean_std(generate.gumbel(load(spark, folder, "orders"), "o_orderkey", 1234), "x"))


@analysis("S6 A6", f"with x as {_gumbel} " + _histogram_sql("x", "x", 30).replace("with e as", ", e as", 1))
def gumbel_histogram(spark, folder):
    return rounded(profile.histogram(generate.gumbel(load(spark, folder, "orders"), "o_orderkey", 1234), "x", 30), 4)


@analysis(
    "S6",
    f"""with x as (select -ln(-ln((o_orderkey + 0.5e0)/(select count(*) from orders))) as x from orders)
    select {rd('avg(x)')} as mean, {rd('stddev_samp(x)')} as std from x""",
)
def gumbel_quantile_grid(spark, folder):
    # Order keys are dense from 0, so they are the grid's index.
    made = generate.gumbel_grid(load(spark, folder, "orders"), "o_orderkey")
    return rounded(profile.mean_std(made, "x"))


_linear = ", ".join(f"{normal('o_orderkey', f'31x{j}')} as x{j}" for j in (1, 2, 3))
LINEAR_SQL = f"""(select o_orderkey, x1, x2, x3, 0.1e0 + 0.5e0*x1 - 0.3e0*x2 + 0e0*x3 + e as y
  from (select o_orderkey, {_linear}, {normal('o_orderkey', '31e')} as e from orders))"""
BETA = [0.1, 0.5, -0.3, 0.0]


@analysis("S7", f"select o_orderkey, {rd('x1')} as x1, {rd('x2')} as x2, {rd('x3')} as x3, {rd('y')} as y from {LINEAR_SQL}")
def linear_model_rows(spark, folder):
    return rounded(generate.linear(load(spark, folder, "orders"), "o_orderkey", BETA, 1.0, 31))


_middle = "(select (min(c_custkey)+max(c_custkey))/2e0 from customer)"
SPIRAL_SQL = f"""(select c_custkey as seq_id, label, step, r*cos(a) as x, r*sin(a) as y from (
  select c_custkey, label, step, (step+1)/40e0 as r,
    start + (case when label = 0 then -1e0 else 1e0 end)*12.566370614359172e0*step/40e0 as a
  from (select c_custkey, case when c_custkey < {_middle} then 0 else 1 end as label,
          6.283185307179586e0*{uniform('c_custkey', 'spiral')} as start, unnest(range(40))::int as step from customer)))"""


@analysis("S8", f"select seq_id, label, step, {rd('x')} as x, {rd('y')} as y from {SPIRAL_SQL}")
def spiral_points(spark, folder):
    return rounded(generate.spirals(load(spark, folder, "customer"), "c_custkey", 40))


@analysis(
    "S2",
    f"""select label, count(*) as good, 0::bigint as bad, {rd('sum(embedding[1]::double)', 4)} as first, {rd('sum(embedding[64]::double)', 4)} as last from embeddings group by 1
    union all select -1, 0, count(*), null, null from embeddings where vec_id % 50 = 0""",
)
def wide_csv_read_back(spark, folder):
    """All embeddings written as CSV of 65 columns, with broken copies of some rows, and read back with those told apart."""
    columns = [f"v{i}" for i in range(64)]
    rows = load(spark, folder, "embeddings")
    line = F.concat_ws(",", F.col("label").cast("string"), F.col("embedding").cast("array<double>").cast("array<string>"))
    broken = rows.where("vec_id % 50 = 0").select(F.concat(F.lit("?,"), line).alias("value"))
    ensure_checkpoint_dir(spark)
    place = f"{spark.sparkContext.getCheckpointDir()}/wide-{uuid4().hex}"
    header = spark.range(1).select(F.lit(",".join(["label", *columns])).alias("value"))
    numbered = rows.select(F.col("label").cast("int").alias("label"), *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(columns)])
    numbered.write.option("header", True).csv(place)
    # A file of its own for the broken rows, under the same header.
    header.unionByName(broken).coalesce(1).write.mode("append").text(place)
    good, bad = load_wide_csv_checked(spark, place, "label", columns)
    counted = good.groupBy("label").agg(
        F.count(F.lit(1)).alias("good"), F.lit(0).cast("long").alias("bad"),
        F.sum(F.col("values")[0]).alias("first"), F.sum(F.col("values")[63]).alias("last"),
    )
    refused = bad.agg(F.lit(-1).alias("label"), F.lit(0).cast("long").alias("good"), F.count(F.lit(1)).alias("bad"), F.lit(None).cast("double").alias("first"), F.lit(None).cast("double").alias("last"))
    return rounded(counted.unionByName(refused), 4)
