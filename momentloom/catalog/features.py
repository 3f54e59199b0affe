"""Projections, filters, types, key alignment, scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from momentloom.catalog.common import FLAGS, RULE_SQL, SCORE_SQL, rounded, rule_predictions, score_expression, significant
from momentloom.catalog.registry import analysis
from momentloom.catalog.sqltext import rd, rs
from momentloom.functions import arrays, scalars
from momentloom.operators import linear, metrics, profile, schema
from momentloom.sources.tables import load, param_grid


@analysis("P1", "select p_partkey, p_retailprice from part")
def keep_columns(spark, folder):
    return load(spark, folder, "part").select("p_partkey", "p_retailprice")


@analysis("P2", "select * exclude (o_orderdate, o_orderpriority) from orders")
def leave_out_columns(spark, folder):
    return load(spark, folder, "orders").drop("o_orderdate", "o_orderpriority")


@analysis("P3 A3", f"select count(*) as n, {rd('avg(s_suppkey)')} as mean, {rd('stddev_samp(s_suppkey)')} as std from supplier")
def column_by_position(spark, folder):
    table = load(spark, folder, "supplier")
    first = table.select(table.columns[0])
    name = first.columns[0]
    return rounded(first.agg(F.count(name).alias("n"), F.avg(name).alias("mean"), F.stddev_samp(name).alias("std")))


@analysis(
    "P4",
    f"select {rd('avg(p_retailprice)', 4)} as target_mean, count(p_retailprice) as n, 'p_partkey,p_name,p_brand,p_type,p_size' as features, count(distinct p_brand) as n_brands from part",
)
def target_and_features(spark, folder):
    y, x = schema.split_target(load(spark, folder, "part"), lambda c: c == "p_retailprice")
    (target,) = y.columns
    both = y.agg(F.avg(target).alias("target_mean"), F.count(target).alias("n"))
    brands = x.select(F.count_distinct("p_brand")).scalar()
    return rounded(both.select("*", F.lit(",".join(x.columns)).alias("features"), brands.alias("n_brands")), 4)


@analysis("P6", "select o_orderkey, o_totalprice from orders where o_orderdate < timestamp '1998-01-01 00:00:00'")
def rows_before_date(spark, folder):
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    return load(spark, folder, "orders").where(early).select("o_orderkey", "o_totalprice")


@analysis(
    "P7 P8 U4",
    f"""select l_returnflag, {rs('sum(l_extendedprice*l_discount)')} as interaction_sum, {rs('avg(l_extendedprice*l_discount)')} as interaction_mean
    from lineitem group by l_returnflag""",
)
def interaction_column(spark, folder):
    made = schema.interaction(load(spark, folder, "lineitem"), "l_extendedprice", "l_discount", "x1")
    made = made.withColumnRenamed("x1", "interaction")
    return significant(
        made.groupBy("l_returnflag").agg(F.sum("interaction").alias("interaction_sum"), F.avg("interaction").alias("interaction_mean"))
    )


@analysis("P9", "select p_partkey, " + ", ".join(f"{rs(f'pow(p_size, {i})', 10)} as hp{i}" for i in (1, 2, 3)) + " from part")
def powers_of_size(spark, folder):
    return significant(schema.powers(load(spark, folder, "part").select("p_partkey", "p_size"), "p_size", 3, "hp").drop("p_size"), 10)


@analysis(
    "P10",
    "select p_partkey, " + ", ".join(f"{rs(f'pow({c}::double, {d})', 10)} as {c}_{d}" for c in ("p_size", "p_retailprice") for d in (1, 2, 3)) + " from part",
)
def polynomial_features(spark, folder):
    return significant(schema.poly_features(load(spark, folder, "part"), ["p_size", "p_retailprice"], 3, keep=["p_partkey"]), 10)


@analysis(
    "P11 P16 L2",
    f"""with m as (select regr_slope(p_retailprice, p_partkey) as b, regr_intercept(p_retailprice, p_partkey) as a from part)
    select p_partkey, {rd('a + b*p_partkey', 5)} as prediction, {rd('a + b*p_partkey - p_retailprice', 5)} as residual from part, m""",
)
def predictions_and_residuals(spark, folder):
    table = load(spark, folder, "part")
    model = linear.linear_regression(table, "p_retailprice", ["p_partkey"])
    made = schema.residuals(model.predict(table), "prediction", "p_retailprice")
    return rounded(made.select("p_partkey", "prediction", "residual"), 5)


@analysis(
    "P12",
    "select l_returnflag, l_linenumber, l_linestatus, count(*) as n from (select case l_returnflag when 'A' then 0 when 'N' then 1 when 'R' then 2 end::int as l_returnflag, "
    "l_linenumber::double as l_linenumber, case l_linestatus when 'F' then 0 when 'O' then 1 end::int as l_linestatus from lineitem) group by all",
)
def reinterpreted_types(spark, folder):
    table = load(spark, folder, "lineitem").select("l_returnflag", "l_linenumber", "l_linestatus")
    typed = schema.coerce(table, {"l_returnflag": FLAGS, "l_linenumber": "continuous", "l_linestatus": ["F", "O"]})
    return typed.groupBy(*typed.columns).agg(F.count(F.lit(1)).alias("n"))


@analysis("P12", f"select 'double' as size_type, {rd('avg(p_size)')} as size_mean, {rs('sum(p_partkey::double)', 10)} as key_sum from part")
def whole_numbers_as_double(spark, folder):
    made = schema.discrete_to_continuous(load(spark, folder, "part"))
    kind = dict(made.dtypes)["p_size"]
    return rounded(made.agg(F.lit(kind).alias("size_type"), F.avg("p_size").alias("size_mean"), F.sum("p_partkey").alias("key_sum")))


@analysis("P13", "select count(*) as n_rows, 11 as n_cols from lineitem")
def table_shape(spark, folder):
    return schema.shape(load(spark, folder, "lineitem"))


@analysis(
    "P13",
    " union all ".join(
        f"select '{c}' as variable, count(*) filter ({c} is null) as nmissing, '{t}' as eltype from events"
        for c, t in [("event_id", "bigint"), ("ts", "timestamp"), ("user_id", "bigint"), ("event_type", "string"), ("value", "double"), ("props", "string")]
    ),
)
def column_types(spark, folder):
    table = load(spark, folder, "events")
    kinds = {f.name: f.dataType.simpleString().replace("timestamp_ntz", "timestamp") for f in table.schema.fields}
    made = profile.describe(table, ["nmissing"])
    return made.select("variable", "nmissing", F.create_map(*[F.lit(v) for kv in kinds.items() for v in kv])[F.col("variable")].alias("eltype"))


@analysis(
    "P14 F7",
    f"select l_linenumber, count(*) as n, {rs('sum(l_quantity + l_extendedprice + l_discount + l_tax)')} as entries from lineitem group by l_linenumber",
)
def vector_totals(spark, folder):
    made = schema.to_vector(load(spark, folder, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return significant(made.groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("n"), F.sum(arrays.total("features")).alias("entries")))


@analysis(
    "J1 M7",
    f"""select lang, count(*) as n, {rd('avg(((n_chars > 1000)::int = quality)::int)')} as accuracy
    from labels join documents using (doc_id) group by lang""",
)
def aligned_predictions(spark, folder):
    guess = load(spark, folder, "documents").select("doc_id", "lang", (F.col("n_chars") > 1000).cast("int").alias("pred"))
    both = schema.align(load(spark, folder, "labels").select("doc_id", "quality"), guess, "doc_id")
    return rounded(both.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), metrics.accuracy("quality", "pred").alias("accuracy")))


@analysis("J2", "select doc_id, lang, n_chars from documents where doc_id in (select doc_id from labels)")
def rows_of_index_set(spark, folder):
    return schema.take_rows(load(spark, folder, "documents"), load(spark, folder, "labels"), "doc_id").select("doc_id", "lang", "n_chars")


@analysis("J3 U2", "select doc_id, lang, n_chars from documents where doc_id not in (select doc_id from labels)")
def rows_outside_index_set(spark, folder):
    return schema.drop_rows(load(spark, folder, "documents"), load(spark, folder, "labels"), "doc_id").select("doc_id", "lang", "n_chars")


DISCOUNT_CUTS, QUANTITY_CUTS = [0.02, 0.04, 0.06, 0.08], [10.0, 25.0, 40.0]


@analysis(
    "J4 M7",
    f"""with g as (select discount_cut, quantity_cut, (i*{len(QUANTITY_CUTS)}+j)::int as candidate from
      (select unnest({DISCOUNT_CUTS})::double as discount_cut, unnest(range({len(DISCOUNT_CUTS)})) as i),
      (select unnest({QUANTITY_CUTS})::double as quantity_cut, unnest(range({len(QUANTITY_CUTS)})) as j))
    select candidate, discount_cut, quantity_cut,
      {rd("avg(((l_discount > discount_cut and l_quantity < quantity_cut) = (l_returnflag = 'R'))::int)")} as accuracy
    from lineitem, g group by all""",
)
def param_grid_scores(spark, folder):
    """Every threshold pair scored in one scan: one average per candidate, not one row per pair."""
    table = load(spark, folder, "lineitem")
    right = []
    for d in DISCOUNT_CUTS:
        for q in QUANTITY_CUTS:
            hit = (F.col("l_discount") > d) & (F.col("l_quantity") < q)
            right.append(F.avg((hit == (F.col("l_returnflag") == "R")).cast("double")))
    scores = table.agg(F.array(*right).alias("scores")).select(F.posexplode("scores").alias("candidate", "accuracy"))
    grid = param_grid(spark, discount_cut=DISCOUNT_CUTS, quantity_cut=QUANTITY_CUTS)
    return rounded(grid.join(F.broadcast(scores), "candidate"))


@analysis(
    "U1",
    f"select o_orderstatus, count(*) as n, {rs('sum(o_totalprice)')} as total from (select * from orders where o_orderstatus = 'F' union all select * from orders where o_orderstatus <> 'F') group by 1",
)
def stacked_rows(spark, folder):
    table = load(spark, folder, "orders")
    both = table.where(F.col("o_orderstatus") == "F").unionByName(table.where(F.col("o_orderstatus") != "F"))
    return significant(both.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total")))


@analysis(
    "F1",
    f"select l_linenumber, {rs('sum(pow(l_quantity, 6))')} as sixth, {rs('sum(sqrt(l_extendedprice))')} as root, {rs('sum(pow(l_quantity, 0.5))')} as half_power, {rs('sum(l_discount + l_tax)')} as added from lineitem group by 1",
)
def powers_and_roots(spark, folder):
    return significant(
        load(spark, folder, "lineitem")
        .groupBy("l_linenumber")
        .agg(
            F.sum(F.pow("l_quantity", F.lit(6.0))).alias("sixth"),
            F.sum(F.sqrt("l_extendedprice")).alias("root"),
            F.sum(F.pow("l_quantity", F.lit(0.5))).alias("half_power"),
            F.sum(F.col("l_discount") + F.col("l_tax")).alias("added"),
        )
    )


@analysis(
    "F2 F3",
    f"select o_orderkey, {rd('o_totalprice/7', 2)} as two_decimals, {rs('o_totalprice/7', 3)} as three_digits, {rs('o_totalprice/1e9', 1)} as one_digit from orders",
)
def rounded_values(spark, folder):
    p = F.col("o_totalprice")
    return load(spark, folder, "orders").select(
        "o_orderkey",
        scalars.round_digits(p / 7, 2).alias("two_decimals"),
        scalars.round_significant(p / 7, 3).alias("three_digits"),
        scalars.round_significant(p / 1e9, 1).alias("one_digit"),
    )


@analysis(
    "F4",
    """select o_orderkey, (o_orderkey // 7)::bigint as quotient, (o_orderkey % 7)::bigint as remainder, (((o_orderkey - 1) % 7 + 7) % 7 + 1)::bigint as wrapped,
    ceil(o_orderkey/7e0)::bigint as ceiling from orders""",
)
def integer_arithmetic(spark, folder):
    k = F.col("o_orderkey")
    return load(spark, folder, "orders").select(
        "o_orderkey",
        scalars.integer_quotient(k, 7).alias("quotient"),
        F.pmod(k, F.lit(7)).cast("bigint").alias("remainder"),
        scalars.wrap_one_based(k, 7).cast("bigint").alias("wrapped"),
        scalars.ceil_quotient(k, 7).alias("ceiling"),
    )


@analysis(
    "F17",
    f"select l_linestatus, {rd('avg(1e0/(1e0+exp(-(l_discount*20e0 - 1e0))))')} as mean_sigmoid, {rd('avg(greatest(l_discount*20e0 - 1e0, 0e0))')} as mean_relu from lineitem group by 1",
)
def activations(spark, folder):
    x = F.col("l_discount") * 20.0 - 1.0
    made = load(spark, folder, "lineitem").groupBy("l_linestatus")
    return rounded(made.agg(F.avg(scalars.sigmoid(x)).alias("mean_sigmoid"), F.avg(scalars.relu(x)).alias("mean_relu")))


@analysis(
    "F19",
    "select p_partkey, rpad(p_type, greatest(12, length(p_type))::int, ' ') || ':' as padded_right, lpad(p_size::varchar, 8, ' ') as padded_left, "
    f"printf('%.2f', {rd('p_retailprice/3', 2)}) as fixed, 'part ' || p_partkey || ' costs ' || printf('%.1f', {rd('p_retailprice', 1)}) as sentence from part",
)
def padded_text(spark, folder):
    return load(spark, folder, "part").select(
        "p_partkey",
        F.concat(scalars.pad_right("p_type", 12), F.lit(":")).alias("padded_right"),
        scalars.pad_left(F.col("p_size").cast("string"), 8).alias("padded_left"),
        scalars.fixed_text(F.col("p_retailprice") / 3, 2).alias("fixed"),
        F.format_string("part %d costs %s", F.col("p_partkey"), scalars.fixed_text("p_retailprice", 1)).alias("sentence"),
    )


@analysis(
    "F21 F22",
    f"""select l_returnflag, {rd(f'100*avg(({SCORE_SQL} > 0.5e0)::int)', 4)} as percent_above, count(*) filter ({SCORE_SQL} > 0.5e0 and l_tax < 0.04e0) as both_masks
    from lineitem group by 1""",
)
def masks_and_percent(spark, folder):
    above = score_expression() > 0.5
    made = load(spark, folder, "lineitem").groupBy("l_returnflag")
    return rounded(
        made.agg(scalars.percent(F.avg(above.cast("double"))).alias("percent_above"), F.count_if(above & (F.col("l_tax") < 0.04)).alias("both_masks")), 4
    )


@analysis("A13", f"select count(distinct {RULE_SQL}) as predicted_classes, count(distinct l_returnflag) as true_classes from lineitem")
def class_counts(spark, folder):
    rows = rule_predictions(spark, folder)
    return rows.agg(F.count_distinct("pred").alias("predicted_classes"), F.count_distinct("y").alias("true_classes"))
