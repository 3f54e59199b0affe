"""Array functions on the embeddings, read as 8 x 8 images stored column by column."""

from __future__ import annotations

from pyspark.sql import functions as F

from momentloom.catalog.common import rounded
from momentloom.catalog.registry import analysis
from momentloom.catalog.sqltext import rd, total
from momentloom.functions import arrays
from momentloom.sources.tables import load

DIGITS = list(range(10))


def entries(df, name="value"):
    """One row per array entry, so that results compare value by value."""
    return rounded(df.select("vec_id", F.posexplode("a").alias("pos", name)))


def entries_sql(expression):
    return f"""select vec_id, (pos - 1)::int as pos, {rd('v')} as value from
    (select vec_id, unnest(a) as v, unnest(range(1, len(a)+1)) as pos from (select vec_id, {expression} as a from embeddings))"""


E = "embedding::double[]"


def weight_rows(outputs, inputs, shift=0):
    """Fixed weights by formula, for scores that need no training."""
    return [[((c * 7 + j * 3 + shift * 5) % 11 - 5) / 10.0 for j in range(inputs)] for c in range(outputs)]


def dense_sql(source, inputs, outputs, shift=0, relu=False):
    """The same layer as one list per output, written with list functions."""
    unit = lambda c: total(f"list_transform(range({inputs}), lambda j: ({source})[j+1] * (((({c}*7 + j*3 + {shift * 5}) % 11) - 5)/10e0))")
    cells = [f"{unit(c)} + {c / 10.0!r}e0" for c in range(outputs)]
    if relu:
        cells = [f"greatest({c}, 0e0)" for c in cells]
    return "[" + ", ".join(cells) + "]"


def fixed_layer(source, inputs, outputs, shift=0, activation=None):
    return arrays.dense(source, weight_rows(outputs, inputs, shift), [c / 10.0 for c in range(outputs)], activation)


def softmax_sql(a):
    shifted = f"list_transform({a}, lambda x: exp(x - list_max({a})))"
    return f"list_transform({shifted}, lambda x: x / list_sum({shifted}))"


@analysis(
    "F5",
    f"select vec_id, len(embedding)::int as n, (len(embedding)+1)::int as last_index, {rd('(list_append(embedding::double[], 7e0))[65]')} as last_value, 'array<float>' as kind from embeddings",
)
def appended_arrays(spark, folder):
    longer = F.array_append(arrays.doubles("embedding"), F.lit(7.0))
    return rounded(
        load(spark, folder, "embeddings").select(
            "vec_id", F.size("embedding").alias("n"), F.size(longer).alias("last_index"), F.element_at(longer, -1).alias("last_value"), F.typeof("embedding").alias("kind")
        )
    )


@analysis("F6", entries_sql(f"list_transform({E}, lambda x: x + 5e0)"))
def array_plus_scalar(spark, folder):
    return entries(load(spark, folder, "embeddings").select("vec_id", arrays.add_scalar("embedding", 5.0).alias("a")))


@analysis("F6", entries_sql(f"list_transform({E}, lambda x: x * x)"))
def array_products(spark, folder):
    return entries(load(spark, folder, "embeddings").select("vec_id", arrays.multiply("embedding", "embedding").alias("a")))


@analysis("F7 A12", f"select vec_id, {rd(f'list_sum({E})')} as total, {rd(f'list_avg({E})')} as mean from embeddings")
def array_totals(spark, folder):
    return rounded(load(spark, folder, "embeddings").select("vec_id", arrays.total("embedding").alias("total"), arrays.mean("embedding").alias("mean")))


@analysis("F8", entries_sql("list_transform(range(64), lambda k: embedding[((k % 8)*8 + k//8 + 1)::bigint]::double)"))
def transposed_matrices(spark, folder):
    return entries(load(spark, folder, "embeddings").select("vec_id", arrays.transpose(arrays.doubles("embedding"), 8, 8).alias("a")))


@analysis(
    "F9",
    f"""select vec_id, {rd('embedding[9]')} as cell_1_2, {rd('list_sum(embedding[9:16]::double[])')} as column_2, 8 as n_rows, 8 as n_cols,
    {rd('list_sum(list_transform(range(8), lambda c: embedding[(1 + c*8)::bigint]::double))')} as row_1,
    {rd('embedding[1]::double + embedding[2] + embedding[9] + embedding[10]')} as corner from embeddings""",
)
def matrix_cells(spark, folder):
    a = arrays.doubles("embedding")
    return rounded(
        load(spark, folder, "embeddings").select(
            "vec_id",
            arrays.cell(a, 1, 2, 8).alias("cell_1_2"),
            arrays.total(arrays.matrix_column(a, 2, 8)).alias("column_2"),
            arrays.total(arrays.matrix_row(a, 1, 8, 8)).alias("row_1"),
            arrays.total(arrays.block(a, [1, 2], [1, 2], 8)).alias("corner"),
            F.lit(8).alias("n_rows"),
            F.floor(F.size(a) / 8).cast("int").alias("n_cols"),
        )
    )


@analysis("F10", entries_sql(f"list_transform({E}, lambda x: x / 255e0)").replace(rd("v"), rd("v", 9)))
def scaled_pixels(spark, folder):
    made = load(spark, folder, "embeddings").select("vec_id", arrays.scale("embedding", 255).alias("a"))
    return rounded(made.select("vec_id", F.posexplode("a").alias("pos", "value")), 9)


@analysis("F11", entries_sql("list_transform(range(64), lambda k: embedding[((7 - k % 8)*8 + k//8 + 1)::bigint]::double)"))
def upright_images(spark, folder):
    return entries(load(spark, folder, "embeddings").select("vec_id", arrays.upright(arrays.doubles("embedding"), 8, 8).alias("a")))


def _pool_sql(how):
    at = lambda i, j: f"embedding[((k//4)*16 + {j * 8} + (k%4)*2 + {i} + 1)::bigint]::double"
    parts = [at(0, 0), at(1, 0), at(0, 1), at(1, 1)]
    cell = f"({' + '.join(parts)})/4e0" if how == "mean" else f"greatest({', '.join(parts)})"
    return f"list_transform(range(16), lambda k: {cell})"


@analysis("F12 F13", entries_sql(_pool_sql("mean")))
def mean_pooled(spark, folder):
    return entries(load(spark, folder, "embeddings").select("vec_id", arrays.pool("embedding", 8, 8, 2, "mean").alias("a")))


@analysis("F12", entries_sql(_pool_sql("max")))
def max_pooled(spark, folder):
    return entries(load(spark, folder, "embeddings").select("vec_id", arrays.pool("embedding", 8, 8, 2, "max").alias("a")))


@analysis("F13", entries_sql("list_transform(range(64), lambda k: embedding[(k + 1)::bigint]::double)"))
def flattened_columns(spark, folder):
    """Cut into the 8 matrix columns and flattened again."""
    nested = F.array(*[arrays.matrix_column(arrays.doubles("embedding"), c, 8) for c in range(1, 9)])
    return entries(load(spark, folder, "embeddings").select("vec_id", F.flatten(nested).alias("a")))


@analysis("F14", entries_sql("list_transform(range(10), lambda c: case when c = label then 1e0 else 0e0 end)").replace(rd("v"), "v::int"))
def one_hot_labels(spark, folder):
    return load(spark, folder, "embeddings").select("vec_id", F.posexplode(arrays.one_hot("label", DIGITS)).alias("pos", "value"))


@analysis("F15", "select vec_id, (list_position(embedding, list_max(embedding)))::int as top_position, label as decoded from embeddings")
def decoded_labels(spark, folder):
    made = load(spark, folder, "embeddings")
    hot = arrays.one_hot("label", DIGITS)
    return made.select("vec_id", arrays.argmax("embedding").alias("top_position"), arrays.decode(hot, DIGITS).alias("decoded"))


@analysis("F16", f"with p as (select vec_id, {E} as a from embeddings) " + entries_sql(softmax_sql("a")).replace("from embeddings", "from p"))
def softmax_rows(spark, folder):
    return entries(load(spark, folder, "embeddings").select("vec_id", arrays.softmax("embedding").alias("a")))


@analysis("F18", entries_sql(dense_sql("embedding", 64, 10)))
def dense_scores(spark, folder):
    return entries(load(spark, folder, "embeddings").select("vec_id", fixed_layer("embedding", 64, 10).alias("a")))


@analysis(
    "F18 F12",
    f"""with p as (select vec_id, {_pool_sql('mean')} as x from embeddings), h as (select vec_id, {dense_sql('x', 16, 14, 1, relu=True)} as x from p),
    s as (select vec_id, {dense_sql('x', 14, 10, 2)} as a from h)
    select vec_id, (pos - 1)::int as pos, {rd('v')} as value from (select vec_id, unnest(a) as v, unnest(range(1, 11)) as pos from s)""",
)
def two_layer_scores(spark, folder):
    pooled = load(spark, folder, "embeddings").select("vec_id", arrays.pool("embedding", 8, 8).alias("x"))
    hidden = pooled.select("vec_id", fixed_layer("x", 16, 14, 1, "relu").alias("x"))
    return entries(hidden.select("vec_id", fixed_layer("x", 14, 10, 2).alias("a")))
