"""Queries on sources, projections, missing values, joins, aggregations, windows and sets."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.functions import scalar as S
from millrace.operators import features as ft
from millrace.operators import impute, joins, similarity, stats, text, windows
from millrace.operators.boost import BoostModel, NewtonBoost
from millrace.plans import views as v
from millrace.plans.registry import query
from millrace.session import scratch_path
from millrace.sources import text as src

R6 = v.rnd


# --- sources and sinks ---------------------------------------------------------------------
@query("read_csv_header", """SELECT c_custkey, c_name || ', "' || c_mktsegment || '"' AS title, c_nationkey,
       c_acctbal FROM customer""")
def _(spark, sf):
    path = scratch_path(spark, "csv")
    c = v.table(spark, sf, "customer")
    title = F.concat(F.col("c_name"), F.lit(', "'), F.col("c_mktsegment"), F.lit('"'))
    src.write_csv(c.select("c_custkey", title.alias("title"), "c_nationkey", "c_acctbal"), path)
    return src.read_csv_header(spark, path, "c_custkey bigint, title string, c_nationkey int, c_acctbal double")


@query("read_delimited", f"WITH {v.RATINGS} SELECT u, i, r FROM ratings")
def _(spark, sf):
    path = scratch_path(spark, "tsv")
    src.write_csv(v.ratings(spark, sf, write=False), path, header=False, sep="\t")
    return src.read_delimited(spark, path, "u bigint, i bigint, r double")


@query("read_whitespace_rows", """SELECT concat_ws('|', p_partkey::varchar, replace(p_name, ' ', '|'), p_brand) AS fields,
       p_type AS cls FROM part""")
def _(spark, sf):
    path = scratch_path(spark, "rows")
    v.table(spark, sf, "part").select(F.concat_ws("  ", "p_partkey", "p_name", "p_brand", "p_type")).write.text(path)
    return src.read_whitespace_rows(spark, path).select(F.array_join("fields", "|").alias("fields"), "cls")


def _doc_cells(spark, sf):
    return v.docs(spark, sf).select("doc_id", "quality", F.posexplode(F.array("n_chars", "n_words")).alias("idx", "val"))


@query("read_libsvm_long", f"""WITH {v.DOCS} SELECT quality::double AS label, idx, count(*) AS n, sum(val)::double AS total
       FROM (SELECT quality, 0 AS idx, n_chars AS val FROM docs UNION ALL SELECT quality, 1, n_words FROM docs)
       GROUP BY 1, 2""")
def _(spark, sf):
    path = scratch_path(spark, "libsvm")
    src.write_libsvm(_doc_cells(spark, sf), path, "doc_id", "quality", "idx", "val")
    return src.read_libsvm_long(spark, path).groupBy("label", "idx").agg(
        F.count(F.lit(1)).alias("n"), F.sum("val").alias("total"))


@query("write_libsvm", f"""WITH {v.DOCS} SELECT quality || ' 0:' || n_chars || ' 1:' || n_words AS value FROM docs""")
def _(spark, sf):
    path = scratch_path(spark, "libsvm")
    src.write_libsvm(_doc_cells(spark, sf), path, "doc_id", "quality", "idx", "val")
    return spark.read.text(path)


_TABLE_SQL = """SELECT n_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM customer
       JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
       WHERE r_name <> 'ASIA' GROUP BY n_name"""


@query("read_table_sql", _TABLE_SQL)
def _(spark, sf):
    tables = {t: f"{sf}/{t}.parquet" for t in ("customer", "nation", "region")}
    return src.read_table_sql(spark, tables, _TABLE_SQL)


@query("write_predictions", "SELECT o_orderkey, (o_totalprice > 200000)::int AS prediction FROM orders")
def _(spark, sf):
    path = scratch_path(spark, "pred")
    o = v.table(spark, sf, "orders").select("o_orderkey", (F.col("o_totalprice") > 200000).alias("prediction"))
    src.write_predictions(o, path, "o_orderkey", "prediction")
    return src.read_csv_header(spark, path, "o_orderkey bigint, prediction int")


@query("tokenize_corpus", f"""WITH {v.TOKENS} SELECT token, count(*) AS n, sum(pos)::bigint AS places,
       count(DISTINCT doc_id) AS docs FROM tokens GROUP BY token""")
def _(spark, sf):
    tokens = text.tokenize_corpus(v.documents(spark, sf), "doc_id", "text")
    return tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.sum("pos").alias("places"),
                                       F.countDistinct("doc_id").alias("docs"))


@query("save_load_model", "SELECT count(*) AS compared, 0::bigint AS differing FROM documents")
def _(spark, sf):
    d = v.docs(spark, sf)
    boost = NewtonBoost(objective="binary:logistic", num_round=2, max_depth=3)
    model = boost.fit(d, "doc_id", v.DOC_FEATURES, "quality")
    path = scratch_path(spark, "model")
    model.save(spark, path)
    again = BoostModel.load(spark, path)
    both = again.predict(model.predict(v.all_docs(spark, sf), out="a"), out="b")
    return both.agg(F.count(F.lit(1)).alias("compared"), F.count_if(F.col("a") != F.col("b")).alias("differing"))


# --- projections and scalar functions --------------------------------------------------------
@query("project_rename", "SELECT p_brand AS brand, p_partkey AS id, p_retailprice AS price FROM part")
def _(spark, sf):
    return ft.project_rename(v.table(spark, sf, "part"), {"p_brand": "brand", "p_partkey": "id", "p_retailprice": "price"})


@query("filter_predicate", """SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE (l_quantity BETWEEN 10 AND 20
       OR l_discount > 0.08) AND l_returnflag <> 'N' AND l_shipdate IS NOT NULL""")
def _(spark, sf):
    c = F.col
    cond = (c("l_quantity").between(10, 20) | (c("l_discount") > 0.08)) & (c("l_returnflag") != "N") & c("l_shipdate").isNotNull()
    return ft.filter_predicate(v.table(spark, sf, "lineitem"), cond).select("l_orderkey", "l_partkey", "l_quantity")


@query("nested_access", f"""WITH {v.CLICKS}, {v.PREFS} SELECT user_id::varchar AS id, (user_id % 2)::int AS gender,
       (18 + user_id % 50)::int AS age FROM prefs GROUP BY user_id""")
def _(spark, sf):
    p = v.profiles(spark, sf).withColumn("user", F.concat(F.lit("user:"), F.col("user_id")))
    return p.select(F.split("user", ":")[1].alias("id"), "basic_info.gender", "basic_info.age")


def _weights(name, k):
    return [R6(F.col(name)[j]).alias(f"w{j}") for j in range(k)]


_PIVOT = ", ".join(f"coalesce(max(CASE WHEN rk = {j + 1} THEN round(v, 6) END), 0) + 0.0::double AS w{j}" for j in range(4))


@query("map_topk_weights_by_prefix", f"""WITH {v.CLICKS}, {v.PREFS}, ranked AS (SELECT event_id, v, row_number() OVER
       (PARTITION BY event_id ORDER BY v DESC) AS rk FROM clicks c LEFT JOIN prefs p ON c.user_id = p.user_id
       AND c.channel_id = p.channel_id) SELECT event_id, {_PIVOT} FROM ranked GROUP BY event_id""")
def _(spark, sf):
    events = v.clicks(spark, sf)
    # the weights are those of a user and channel, so the map is gone through once for each of them and not for each event
    met = events.select("user_id", "channel_id").distinct().join(v.profiles(spark, sf, events), "user_id", "left")
    w = S.map_topk_weights_by_prefix("preference_info", "channel_id", 4)
    met = met.select(F.col("user_id").alias("u"), F.col("channel_id").alias("c"), w.alias("w"))
    rows = events.join(met, F.col("user_id").eqNullSafe(F.col("u")) & F.col("channel_id").eqNullSafe(F.col("c")))
    return rows.select("event_id", *_weights("w", 4))


@query("map_topk_values", f"""WITH ranked AS (SELECT vec_id AS article_id, v, row_number() OVER (PARTITION BY vec_id
       ORDER BY v DESC) AS rk FROM (SELECT vec_id, abs(unnest(embedding)::double) AS v FROM embeddings))
       SELECT article_id, {_PIVOT} FROM ranked GROUP BY article_id""")
def _(spark, sf):
    a = v.articles(spark, sf)
    return a.select("article_id", S.map_topk_values("keywords", 4).alias("w")).select("article_id", *_weights("w", 4))


@query("array_to_feature_vector", """SELECT vec_id AS id, len(embedding)::bigint AS size,
       round(list_sum(embedding::double[]), 5) + 0.0 AS total FROM embeddings""")
def _(spark, sf):
    rows = ft.to_vector(v.vectors(spark, sf), "x").withColumn("back", vector_to_array("features"))
    total = F.aggregate("back", F.lit(0.0), lambda a, x: a + x)
    return rows.select("id", F.size("back").cast("bigint").alias("size"), R6(total, 5).alias("total"))


@query("assemble_features", """SELECT vec_id AS id, label::double AS first, round(embedding[1]::double, 6) + 0.0 AS second,
       (len(embedding) + 1)::bigint AS size FROM embeddings""")
def _(spark, sf):
    x = S.assemble_array(F.array(F.col("label").cast("double")), "x")
    rows = v.vectors(spark, sf).select("id", x.alias("a"))
    return rows.select("id", F.col("a")[0].alias("first"), R6(F.col("a")[1]).alias("second"),
                       F.size("a").cast("bigint").alias("size"))


def _person(spark, sf):
    """Names of the form ``Surname, Title. Number`` from customer rows."""
    titles = F.element_at(F.array(*[F.lit(t) for t in ("Mr", "Mrs", "Dr", "Miss")]), (F.col("c_custkey") % 4 + 1).cast("int"))
    name = F.concat(F.split_part("c_name", F.lit("#"), F.lit(1)), (F.col("c_custkey") % 100).cast("string"),
                    F.lit(", "), titles, F.lit(". "), F.col("c_mktsegment"))
    return v.table(spark, sf, "customer").withColumn("name", name)


_PERSON = """person AS (SELECT *, split_part(c_name, '#', 1) || (c_custkey % 100) || ', ' ||
       list_extract(['Mr', 'Mrs', 'Dr', 'Miss'], (c_custkey % 4 + 1)::int) || '. ' || c_mktsegment AS name FROM customer)"""


@query("extract_title", f"""WITH {_PERSON} SELECT c_custkey, regexp_extract(name, '([A-Za-z]+)\\.', 1) AS word,
       regexp_extract(name, ' ([A-Za-z]+)\\.', 1) AS spaced, trim(split_part(split_part(name, ',', 2), '.', 1)) AS between
       FROM person""".replace("AS between", 'AS "between"'))
def _(spark, sf):
    return _person(spark, sf).select("c_custkey", *[S.extract_title("name", m).alias(m) for m in ("word", "spaced", "between")])


@query("string_parts", f"""WITH {_PERSON} SELECT c_custkey, split_part(name, ',', 1) AS surname, name[1:1] AS initial,
       length(name)::bigint AS chars FROM person""")
def _(spark, sf):
    return _person(spark, sf).select("c_custkey", S.surname("name").alias("surname"), F.substring("name", 1, 1).alias("initial"),
                                     F.char_length("name").cast("bigint").alias("chars"))


@query("recode_values", """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'high' WHEN '2-HIGH' THEN 'high'
       ELSE o_orderpriority END AS kept, CASE o_orderpriority WHEN '1-URGENT' THEN 'high' WHEN '2-HIGH' THEN 'high' END AS nulled,
       CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 ELSE -1 END AS code FROM orders""")
def _(spark, sf):
    m = {"1-URGENT": "high", "2-HIGH": "high"}
    return v.table(spark, sf, "orders").select(
        "o_orderkey", S.recode_values("o_orderpriority", m).alias("kept"), S.recode_values("o_orderpriority", m, None).alias("nulled"),
        S.recode_values("o_orderstatus", {"F": 1, "O": 0}, -1).alias("code"))


@query("bucket_ranges", """SELECT p_partkey, CASE WHEN p_size BETWEEN 1 AND 10 THEN 0 WHEN p_size BETWEEN 11 AND 30 THEN 1
       WHEN p_size BETWEEN 31 AND 45 THEN 2 END AS bucket FROM part""")
def _(spark, sf):
    return v.table(spark, sf, "part").select(
        "p_partkey", S.bucket_ranges("p_size", [(1, 10, 0), (11, 30, 1), (31, 45, 2)]).alias("bucket"))


@query("derive_arithmetic", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_quantity + l_tax * 100 + 1, 4) AS size
       FROM lineitem""")
def _(spark, sf):
    size = F.round(F.col("l_quantity") + F.col("l_tax") * 100 + 1, 4)
    return v.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", size.alias("size"))


@query("one_hot", """SELECT o_orderkey, (o_orderstatus IS NOT NULL AND o_orderkey % 7 <> 0 AND o_orderstatus = 'F')::int AS status_F,
       (o_orderkey % 7 <> 0 AND o_orderstatus = 'O')::int AS status_O, (o_orderkey % 7 <> 0 AND o_orderstatus = 'P')::int AS status_P
       FROM orders""")
def _(spark, sf):
    o = v.table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus")).alias("status"))
    return ft.one_hot(o, ["status"]).drop("status")


@query("indicator_encode", """WITH long AS (SELECT p_partkey, 'p_brand' AS attr, p_brand AS value, 1 AS o FROM part UNION ALL
       SELECT p_partkey, 'p_type', p_type, 2 FROM part), dict AS (SELECT attr, value, (row_number() OVER (ORDER BY o, value) - 1)::int
       AS feature_id FROM (SELECT DISTINCT attr, value, o FROM long)) SELECT p_partkey, feature_id, 1.0::double AS val
       FROM long JOIN dict USING (attr, value)""")
def _(spark, sf):
    p = v.table(spark, sf, "part")
    attrs = ["p_brand", "p_type"]
    return ft.indicator_encode(p, "p_partkey", attrs, ft.feature_dictionary(p, attrs))


@query("sigmoid_threshold", """SELECT event_id, round(1 / (1 + exp(-(value - 10) / 5)), 6) AS prob,
       CASE WHEN 1 / (1 + exp(-(value - 10) / 5)) > 0.5 THEN 1 ELSE 0 END AS flag FROM events""")
def _(spark, sf):
    z = (F.col("value") - 10) / 5
    return v.table(spark, sf, "events").select("event_id", R6(S.sigmoid(z)).alias("prob"), S.sigmoid_threshold(z).alias("flag"))


@query("polynomial_features", """SELECT p_partkey, pow(p_size, 0)::double AS p_size_pow_0, pow(p_size, 1)::double AS p_size_pow_1,
       pow(p_size, 2)::double AS p_size_pow_2, pow(p_size, 3)::double AS p_size_pow_3 FROM part""")
def _(spark, sf):
    return v.table(spark, sf, "part").select("p_partkey", *S.polynomial_features("p_size", 3))


@query("zscore", """SELECT c_custkey, round((c_acctbal - avg(c_acctbal) OVER ()) / stddev_pop(c_acctbal) OVER (), 6) + 0.0 AS c_acctbal_z
       FROM customer""")
def _(spark, sf):
    c = v.table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return ft.ZScore(["c_acctbal"]).fit(c).transform(c).select("c_custkey", R6("c_acctbal_z").alias("c_acctbal_z"))


@query("l2_normalize", """SELECT vec_id AS id, round(list_sum(list_transform(y, lambda z: z / n)), 5) + 0.0 AS total FROM
       (SELECT vec_id, list_transform(embedding::double[], lambda z: z * 3) AS y,
       sqrt(list_sum(list_transform(embedding::double[], lambda z: 9 * z * z))) AS n FROM embeddings)""")
def _(spark, sf):
    rows = v.vectors(spark, sf).select("id", S.l2_normalize(F.transform("x", lambda z: z * 3)).alias("y"))
    return rows.select("id", R6(F.aggregate("y", F.lit(0.0), lambda a, z: a + z), 5).alias("total"))


@query("conditional_overwrite", """SELECT c_custkey, CASE WHEN k THEN 'X' ELSE c_mktsegment END AS c_mktsegment,
       CASE WHEN k THEN 0.0 ELSE c_acctbal END AS c_acctbal FROM (SELECT *, c_nationkey IN (SELECT n_nationkey FROM nation
       WHERE n_regionkey = 1) AS k FROM customer)""")
def _(spark, sf):
    c = v.table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal", "c_nationkey")
    keys = v.table(spark, sf, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("c_nationkey"))
    return ft.conditional_overwrite(c, keys, ["c_nationkey"], {"c_mktsegment": "X", "c_acctbal": 0.0}).drop("c_nationkey")


@query("replicate_rows", "SELECT s_suppkey, unnest(range(1, 6))::int AS copy FROM supplier")
def _(spark, sf):
    return ft.replicate_rows(v.table(spark, sf, "supplier").select("s_suppkey"), 5)


# --- missing values --------------------------------------------------------------------------
def _nullable(spark, sf):
    o = v.table(spark, sf, "orders")
    hole = F.col("o_orderkey") % 7 == 0
    return o.select("o_orderkey", F.when(~hole, F.col("o_totalprice")).alias("price"), "o_orderpriority",
                    F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")).alias("status"),
                    (F.col("o_custkey") % 97).cast("double").alias("c97"), F.month("o_orderdate").cast("double").alias("month"))


_NULLABLE = """nullable AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS price, o_orderpriority,
       CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS status FROM orders)"""


@query("fill_constant", f"WITH {_NULLABLE} SELECT o_orderkey, coalesce(price, 0) AS price, coalesce(status, 'U') AS status FROM nullable")
def _(spark, sf):
    return impute.fill_constant(_nullable(spark, sf).select("o_orderkey", "price", "status"), {"price": 0.0, "status": "U"})


@query("fill_median", f"""WITH {_NULLABLE} SELECT o_orderkey, round(coalesce(price, (SELECT quantile_cont(price, 0.5)
       FROM nullable)), 4) AS price FROM nullable""")
def _(spark, sf):
    n = _nullable(spark, sf).select("o_orderkey", "price")
    return impute.MedianFill(["price"]).fit(n).transform(n).withColumn("price", F.round("price", 4))


@query("fill_group_median", f"""WITH {_NULLABLE}, m AS (SELECT o_orderpriority, quantile_cont(price, 0.5) AS med FROM nullable
       GROUP BY 1) SELECT o_orderkey, round(coalesce(price, med), 4) AS price FROM nullable JOIN m USING (o_orderpriority)""")
def _(spark, sf):
    n = _nullable(spark, sf).select("o_orderkey", "price", "o_orderpriority")
    return impute.fill_group_median(n, ["o_orderpriority"], "price").select("o_orderkey", F.round("price", 4).alias("price"))


@query("fill_by_model")
def _(spark, sf):
    n = _nullable(spark, sf).select("o_orderkey", "price", "c97", "month")
    return impute.fill_by_model(n, "price", ["c97", "month"], trees=10, depth=4).select("o_orderkey", "price")


# --- joins -----------------------------------------------------------------------------------
@query("join_inner", """SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey""")
def _(spark, sf):
    o = v.table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return joins.join_inner(o, v.table(spark, sf, "customer"), ["c_custkey"]).select("o_orderkey", "c_name", "o_totalprice")


@query("join_left", f"""WITH {v.CLICKS}, {v.PREFS} SELECT event_id, n AS entries FROM clicks LEFT JOIN
       (SELECT user_id, count(*) AS n FROM prefs GROUP BY 1) USING (user_id)""")
def _(spark, sf):
    p = v.profiles(spark, sf).select("user_id", F.size("preference_info").cast("bigint").alias("entries"))
    return joins.join_left(v.clicks(spark, sf), p, ["user_id"]).select("event_id", "entries")


_USER_PAIRS = """pairs AS (SELECT x.u AS a, y.u AS b, count(*) AS n, sum(x.r * y.r) AS sab, sum((x.r - y.r) * (x.r - y.r)) AS d2,
       sum(x.r) AS sa, sum(y.r) AS sb, sum(x.r * x.r) AS saa, sum(y.r * y.r) AS sbb
       FROM ratings x JOIN ratings y ON x.i = y.i AND x.u < y.u GROUP BY 1, 2)"""


@query("self_join_common_items", f"""WITH {v.RATINGS}, {_USER_PAIRS} SELECT a, count(*) AS partners, sum(n)::bigint AS common,
       sum(sab) AS products, sum(sa) AS left_sum, sum(sbb) AS right_squares FROM pairs GROUP BY a""")
def _(spark, sf):
    m = similarity.common_item_moments(v.ratings(spark, sf))
    return m.groupBy("a").agg(F.count(F.lit(1)).alias("partners"), F.sum("n").alias("common"), F.sum("sab").alias("products"),
                              F.sum("sa").alias("left_sum"), F.sum("sbb").alias("right_squares"))


@query("anti_join_unseen", """SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey
       AND o_orderpriority = '1-URGENT')""")
def _(spark, sf):
    seen = v.table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.anti_join_unseen(v.table(spark, sf, "customer").select("c_custkey"), seen, ["c_custkey"])


@query("semi_join_in_set", """SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def _(spark, sf):
    keys = v.table(spark, sf, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return joins.semi_join_in_set(v.table(spark, sf, "orders"), keys, ["o_custkey"]).select("o_orderkey")


@query("attach_group_count", "SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey) AS group_size FROM orders")
def _(spark, sf):
    return joins.attach_group_count(v.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), ["o_custkey"]).drop("o_custkey")


NEAREST = f"""{v.VECTORS}, centers AS (SELECT (row_number() OVER (ORDER BY id) - 1)::int AS c, x AS cx FROM (SELECT * FROM vectors ORDER BY id LIMIT 4)),
       near AS (SELECT * FROM (SELECT id, x, c, {v.sql_d2('x', 'cx')} AS d2, row_number() OVER (PARTITION BY id ORDER BY {v.sql_d2('x', 'cx')}, c) AS rk
       FROM vectors, centers) WHERE rk = 1)"""


@query("nearest_center_join", f"WITH {NEAREST} SELECT id, c AS center, round(sqrt(d2), 6) AS dist FROM near")
def _(spark, sf):
    rows, names = v.coordinates(spark, sf)
    return joins.nearest_center_join(rows, v.first_vectors(spark, sf, 4), names).select(
        "id", "center", F.round("dist", 6).alias("dist"))


@query("epsilon_range_join", f"""WITH {v.POINTS} SELECT p.id AS a, q.id AS b, round(sqrt((p.x - q.x) * (p.x - q.x) +
       (p.y - q.y) * (p.y - q.y)), 6) AS dist FROM points p JOIN points q ON p.id < q.id AND
       sqrt((p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y)) <= 0.02""")
def _(spark, sf):
    return joins.epsilon_range_join(v.points2d(spark, sf), "id", ["x", "y"], 0.02).withColumn("dist", F.round("dist", 6))


# --- aggregations ------------------------------------------------------------------------------
@query("count_distinct", "SELECT count(DISTINCT l_partkey) AS n_l_partkey, count(DISTINCT l_suppkey) AS n_l_suppkey FROM lineitem")
def _(spark, sf):
    return stats.count_distinct(v.table(spark, sf, "lineitem"), ["l_partkey", "l_suppkey"])


@query("value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def _(spark, sf):
    return stats.value_counts(v.table(spark, sf, "events"), "event_type")


@query("group_mean_rate", f"WITH {v.CLICKS} SELECT channel_id, round(avg(click_flag), 6) AS rate, count(*) AS n FROM clicks GROUP BY 1")
def _(spark, sf):
    return stats.group_mean_rate(v.clicks(spark, sf), ["channel_id"], "click_flag").withColumn("rate", R6("rate"))


@query("two_way_count", """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O')
       AS "O", count(*) FILTER (o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1""")
def _(spark, sf):
    return stats.two_way_count(v.table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query("group_median", """SELECT l_returnflag, l_linestatus, round(quantile_cont(l_extendedprice, 0.5), 4) AS median FROM lineitem
       GROUP BY 1, 2""")
def _(spark, sf):
    return stats.group_median(v.table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice").withColumn(
        "median", F.round("median", 4))


_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("describe_table", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 5) AS mean, round(stddev_samp({c}), 5) AS std, min({c}) AS min,
    max({c}) AS max, round(quantile_cont({c}, 0.25), 5) AS q25, round(quantile_cont({c}, 0.5), 5) AS q50,
    round(quantile_cont({c}, 0.75), 5) AS q75 FROM lineitem""" for c in _NUMERIC))
def _(spark, sf):
    d = stats.describe_table(v.table(spark, sf, "lineitem"), _NUMERIC)
    return d.withColumns({c: R6(c, 5) for c in ("mean", "std", "q25", "q50", "q75")})


@query("null_profile", f"""WITH {_NULLABLE} SELECT 'o_orderkey' AS "column", count(o_orderkey) AS non_null, 'bigint' AS type FROM nullable
       UNION ALL SELECT 'price', count(price), 'double' FROM nullable UNION ALL SELECT 'status', count(status), 'string' FROM nullable""")
def _(spark, sf):
    return stats.null_profile(_nullable(spark, sf).select("o_orderkey", "price", "status"))


@query("nested_group_rate", """SELECT rate, count(*) AS groups FROM (SELECT o_custkey, round(avg((o_orderstatus = 'F')::int), 6) AS rate
       FROM orders GROUP BY 1) GROUP BY 1""")
def _(spark, sf):
    return stats.nested_group_rate(v.table(spark, sf, "orders"), ["o_custkey"], (F.col("o_orderstatus") == "F").cast("int"))


@query("pearson_corr", "SELECT round(corr(l_quantity, l_extendedprice), 6) AS corr FROM lineitem")
def _(spark, sf):
    return stats.pearson_corr(v.table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice").select(R6("corr").alias("corr"))


@query("corr_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round({'max(1.0::double)' if a == b else f'corr({a}, {b})'}, 6) + 0.0 AS corr FROM lineitem"
    for a in _NUMERIC for b in _NUMERIC))
def _(spark, sf):
    return stats.corr_matrix(v.table(spark, sf, "lineitem"), _NUMERIC).withColumn("corr", R6("corr"))


@query("corr_with_target", " UNION ALL ".join(
    f"SELECT '{a}' AS feature, round(corr({a}, l_extendedprice), 6) + 0.0 AS corr FROM lineitem" for a in ("l_quantity", "l_discount", "l_tax")))
def _(spark, sf):
    return stats.corr_with_target(v.table(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice").withColumn(
        "corr", R6("corr"))


@query("boxplot_stats", """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q0, quantile_cont(value, 0.5) AS q1,
       quantile_cont(value, 0.75) AS q2 FROM events GROUP BY 1), j AS (SELECT *, value BETWEEN q0 - 1.5 * (q2 - q0) AND
       q2 + 1.5 * (q2 - q0) AS ok FROM events JOIN q USING (event_type)) SELECT event_type, round(q0, 5) AS q0, round(q1, 5) AS q1,
       round(q2, 5) AS q2, min(value) FILTER (ok) AS whisker_low, max(value) FILTER (ok) AS whisker_high,
       count(*) FILTER (NOT ok) AS outliers FROM j GROUP BY event_type, q0, q1, q2""")
def _(spark, sf):
    b = stats.boxplot_stats(v.table(spark, sf, "events"), ["event_type"], "value")
    return b.withColumns({c: R6(c, 5) for c in ("q0", "q1", "q2")})


@query("boxplot_outliers", """WITH q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events)
       SELECT event_id, value FROM events, q WHERE value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a)""")
def _(spark, sf):
    return stats.boxplot_outliers(v.table(spark, sf, "events").select("event_id", "value"), [], "value")


@query("kde_density", f"""WITH b AS (SELECT event_type, count(*) AS n, stddev_samp(value) * pow(count(*), -0.2) AS h FROM events GROUP BY 1),
       g AS (SELECT p::int AS point, lo + (hi - lo) * p / 15 AS x FROM (SELECT min(value) AS lo, max(value) AS hi FROM events),
       range(16) t(p)) SELECT event_type, point, round(x, 6) AS x, round(sum(exp(-0.5 * pow((x - value) / h, 2))) /
       (any_value(n) * any_value(h) * {math.sqrt(2 * math.pi)}::double), 6) AS density FROM events JOIN b USING (event_type), g
       GROUP BY 1, 2, x""")
def _(spark, sf):
    k = stats.kde_density(v.table(spark, sf, "events"), ["event_type"], "value", 16)
    return k.select("event_type", "point", R6("x").alias("x"), R6("density").alias("density"))


@query("vocabulary_topn", f"""WITH {v.TOKENS}, c AS (SELECT token, count(*) AS n FROM tokens GROUP BY 1), t AS (SELECT token, n,
       row_number() OVER (ORDER BY n DESC, token) AS idx FROM c) SELECT token AS word, n, idx::int AS idx FROM t WHERE idx < 500 UNION ALL
       SELECT 'UNK', coalesce(sum(n), 0)::bigint, 0 FROM t WHERE idx >= 500""")
def _(spark, sf):
    return stats.vocabulary_topn(text.tokenize_corpus(v.documents(spark, sf), "doc_id", "text"), 500)


@query("encode_tokens", f"""WITH {v.TOKENS}, t AS (SELECT token, row_number() OVER (ORDER BY n DESC, token) AS idx FROM
       (SELECT token, count(*) AS n FROM tokens GROUP BY 1)) SELECT doc_id, count(*) AS tokens, sum(CASE WHEN idx < 500 THEN idx ELSE 0
       END)::bigint AS idx_sum FROM tokens JOIN t USING (token) GROUP BY 1""")
def _(spark, sf):
    tokens = text.tokenize_corpus(v.documents(spark, sf), "doc_id", "text")
    coded = stats.encode_tokens(tokens, stats.vocabulary_topn(tokens, 500))
    return coded.groupBy("doc_id").agg(F.count(F.lit(1)).alias("tokens"), F.sum("idx").alias("idx_sum"))


@query("entropy", """SELECT round(-sum(n / t * log2(n / t)), 6) AS entropy FROM (SELECT count(*)::double AS n,
       sum(count(*)) OVER ()::double AS t FROM orders GROUP BY o_orderpriority)""")
def _(spark, sf):
    return stats.entropy(v.table(spark, sf, "orders"), "o_orderpriority").select(R6("entropy").alias("entropy"))


_GAIN_ATTRS = ["lang", "source", "toxic"]
_GAIN = f"""WITH {v.DOCS}, long AS ({' UNION ALL '.join(f"SELECT '{a}' AS attr, {a}::varchar AS value, quality AS c FROM docs" for a in _GAIN_ATTRS)}),
       nv AS (SELECT attr, value, count(*)::double AS n FROM long GROUP BY 1, 2),
       nvc AS (SELECT attr, value, c, count(*)::double AS m FROM long GROUP BY 1, 2, 3),
       h AS (SELECT attr, value, any_value(n) AS n, -sum(m / n * log2(m / n)) AS h FROM nvc JOIN nv USING (attr, value) GROUP BY 1, 2),
       tot AS (SELECT count(*)::double AS t FROM docs),
       e AS (SELECT -sum(k / t * log2(k / t)) AS entropy FROM (SELECT quality, count(*)::double AS k FROM docs GROUP BY 1), tot),
       s AS (SELECT attr, sum(n / t * h) AS conditional, -sum(n / t * log2(n / t)) AS split_info FROM h, tot GROUP BY 1)
       SELECT attr, round(conditional, 6) + 0.0 AS conditional, round(split_info, 6) + 0.0 AS split_info,
       round((entropy - conditional) / split_info, 6) + 0.0 AS gain_ratio FROM s, e"""


@query("gain_ratio_table", _GAIN)
def _(spark, sf):
    g = stats.gain_ratio_table(v.docs(spark, sf), _GAIN_ATTRS, "quality")
    return g.select("attr", *[R6(c).alias(c) for c in ("conditional", "split_info", "gain_ratio")])


_ANOVA_FEATURES = ["n_chars", "n_words", "f2"]


@query("anova_f", f"""WITH {v.DOCS}, {', '.join(f"g_{f} AS (SELECT '{f}' AS feature, quality, count(*) AS n, avg({f}) AS m, sum(({f} - mm) * ({f} - mm)) AS w FROM docs JOIN (SELECT quality, avg({f}) AS mm FROM docs GROUP BY 1) USING (quality) GROUP BY 2)" for f in _ANOVA_FEATURES)},
       g AS ({' UNION ALL '.join(f'SELECT * FROM g_{f}' for f in _ANOVA_FEATURES)}),
       t AS (SELECT feature, sum(n * m) / sum(n) AS mean FROM g GROUP BY 1)
       SELECT feature, round((sum(n * (m - mean) * (m - mean)) / (count(*) - 1)) / (sum(w) / (sum(n) - count(*))), 4) AS f
       FROM g JOIN t USING (feature) GROUP BY 1""")
def _(spark, sf):
    return stats.anova_f(v.docs(spark, sf), _ANOVA_FEATURES, "quality").select("feature", R6("f", 4).alias("f"))


@query("select_k_best")
def _(spark, sf):
    return stats.select_k_best(v.docs(spark, sf), _ANOVA_FEATURES, "quality", 2)


# --- ranking, windows, sets ----------------------------------------------------------------------
@query("sort_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def _(spark, sf):
    return windows.sort_limit(v.table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 25)


_EUCLID = "e AS (SELECT a, b, n, 1 / (1 + sqrt(d2)) AS sim FROM pairs), both_ways AS (SELECT a, b, sim FROM e UNION ALL SELECT b, a, sim FROM e)"
_TOPN = "top AS (SELECT a, b, sim, row_number() OVER (PARTITION BY a ORDER BY sim DESC, b) AS rank FROM both_ways)"


@query("topn_similar_users", f"""WITH {v.RATINGS}, {_USER_PAIRS}, {_EUCLID}, {_TOPN} SELECT a, b, round(sim, 6) AS sim, rank::int AS rank
       FROM top WHERE rank <= 10""")
def _(spark, sf):
    t = similarity.topn_similar(similarity.euclid_similarity(v.ratings(spark, sf), both=True, nearest=10), 10, both=True)
    return t.select("a", "b", R6("sim").alias("sim"), "rank")


@query("topn_per_user", f"""WITH {v.RATINGS} SELECT u, i, score, rank::int AS rank FROM (SELECT u, i, r AS score, row_number() OVER
       (PARTITION BY u ORDER BY r DESC, i) AS rank FROM ratings) WHERE rank <= 5""")
def _(spark, sf):
    return windows.topn_per_user(v.ratings(spark, sf, write=False).withColumnRenamed("r", "score"), 5)


_SKIP = """SELECT t.token AS target, count(*) AS pairs, count(DISTINCT c.token) AS contexts, sum(c.pos)::bigint AS places
       FROM tokens t JOIN tokens c ON t.doc_id = c.doc_id AND c.pos BETWEEN t.pos - 2 AND t.pos + 2 AND c.pos <> t.pos GROUP BY 1"""


@query("skipgram_pairs", f"WITH {v.TOKENS} {_SKIP}")
def _(spark, sf):
    return text.context_counts(text.skipgram_pairs(v.documents(spark, sf), "doc_id", "text", 2))


@query("skipgram_sample", f"""WITH {v.TOKENS}, n AS (SELECT doc_id, count(*) AS n FROM tokens GROUP BY 1)
       SELECT doc_id, sum(least(2, least(pos, 2) + least(n - 1 - pos, 2)))::bigint AS pairs FROM tokens JOIN n USING (doc_id)
       GROUP BY 1 HAVING sum(least(2, least(pos, 2) + least(n - 1 - pos, 2))) > 0""")
def _(spark, sf):
    p = text.skipgram_pairs(v.documents(spark, sf), "doc_id", "text", 2, num_skips=2)
    return p.groupBy("doc_id").agg(F.count(F.lit(1)).alias("pairs"))


@query("nearest_words", f"""WITH {v.VECTORS}, p AS (SELECT a.id AS qid, b.id AS cid, list_sum(list_transform(list_zip(a.x, b.x),
       lambda z: z[1] * z[2])) / sqrt(list_sum(list_transform(a.x, lambda z: z * z)) * list_sum(list_transform(b.x, lambda z: z * z))) AS c
       FROM vectors a JOIN vectors b ON a.id <> b.id) SELECT qid, cid, round(c, 5) + 0.0 AS cosine, rank::int AS rank FROM (SELECT *,
       row_number() OVER (PARTITION BY qid ORDER BY c DESC, cid) AS rank FROM p) WHERE rank <= 8""")
def _(spark, sf):
    x = v.vectors(spark, sf).select("id", "x")
    return text.nearest_words(x, x, 8).withColumn("cosine", R6("cosine", 5))


@query("union_train_test", """SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS label, (o_orderkey % 3 <> 0)
       AS known FROM orders""")
def _(spark, sf):
    o = v.table(spark, sf, "orders")
    train = o.where("o_orderkey % 3 <> 0").select("o_orderkey", F.col("o_orderstatus").alias("label"))
    both = windows.union_train_test(train, o.where("o_orderkey % 3 = 0").select("o_orderkey"))
    known, unknown = windows.split_by_label(both, "label")
    return windows.union_train_test(known.withColumn("known", F.lit(True)), unknown.withColumn("known", F.lit(False)))


@query("intersect_items", """SELECT l_partkey AS part FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT l_partkey FROM lineitem
       WHERE l_discount = 0.1""")
def _(spark, sf):
    li = v.table(spark, sf, "lineitem").withColumnRenamed("l_partkey", "part")
    return windows.intersect_items(li.where("l_returnflag = 'R'"), li.where("l_discount = 0.1D"), ["part"])


@query("distinct_values", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def _(spark, sf):
    return windows.distinct_values(v.table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"])


# --- user functions --------------------------------------------------------------------------------
@query("with_row_function", "SELECT p_partkey, upper(p_name[1:1]) || lower(p_brand) AS code FROM part")
def _(spark, sf):
    def code(s: pd.Series) -> pd.Series:
        return s.str[0].str.upper() + s.str.split("|").str[1].str.lower()

    p = v.table(spark, sf, "part").select("p_partkey", F.concat_ws("|", "p_name", "p_brand").alias("raw"))
    return ft.with_row_function(p, "code", code, "raw", "string").drop("raw")


@query("map_partitions", """SELECT event_id, round(ln(1 + value), 6) AS logged FROM events WHERE value > 0""")
def _(spark, sf):
    import numpy as np

    def keep(batches):
        for pdf in batches:
            pdf = pdf[pdf["value"] > 0]
            yield pd.DataFrame({"event_id": pdf["event_id"], "logged": np.log1p(pdf["value"])})

    out = ft.map_partitions(v.table(spark, sf, "events").select("event_id", "value"), keep, "event_id long, logged double")
    return out.withColumn("logged", R6("logged"))
