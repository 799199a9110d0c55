"""Queries on supervised models."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.functions.scalar import sigmoid
from millrace.operators import bayes, boost, c45, forest, linear, nearest, validate
from millrace.plans import views as v
from millrace.plans.registry import query
from millrace.plans.scoring import HASH
from millrace.session import cut, scratch_path

R6 = v.rnd
F3 = v.DOC_FEATURES
WITH_ONE = ["one", *F3]


# --- linear models -----------------------------------------------------------------------------
def _ascent_sql(cycles: int, alpha: float) -> str:
    steps = ["w0 AS (SELECT 1.0::double AS a, 1.0::double AS b, 1.0::double AS c, 1.0::double AS d)"]
    for n in range(cycles):
        err = "(quality - 1 / (1 + exp(-(a + b * f0 + c * f1 + d * f2))))"
        steps.append(f"w{n + 1} AS (SELECT any_value(a) + {alpha} * sum({err}) AS a, any_value(b) + {alpha} * sum(f0 * {err}) AS b, "
                     f"any_value(c) + {alpha} * sum(f1 * {err}) AS c, any_value(d) + {alpha} * sum(f2 * {err}) AS d FROM docs, w{n})")
    return f"WITH {v.DOCS}, {', '.join(steps)} "


@query("logreg_gradient_ascent", _ascent_sql(3, 0.001) + """SELECT unnest(['one', 'f0', 'f1', 'f2']) AS feature,
       unnest([round(a, 5), round(b, 5), round(c, 5), round(d, 5)]) + 0.0 AS weight FROM w3""")
def _(spark, sf):
    w = linear.logreg_gradient_ascent(cut(v.docs(spark, sf)), WITH_ONE, "quality", 0.001, 3)
    rows = spark.createDataFrame(list(zip(WITH_ONE, w)), "feature string, weight double")
    return rows.withColumn("weight", R6("weight", 5))


@query("logreg_fit")
def _(spark, sf):
    model = linear.logreg_fit(cut(v.docs(spark, sf)), F3, "quality")
    return spark.createDataFrame(linear.logreg_report(model, F3), "name string, value double")


def _minibatch_sql(opt: str, loss: str, reg: str, batches: int = 3, epochs: int = 2, rate: float = 0.05, strength: float = 0.001) -> str:
    """Every step unrolled: gradients of the step's batch, then the new weights (the bias is w3) and optimizer state."""
    start = 0.1 if opt == "ftrl" else 0.0
    parts = [f"s0 AS (SELECT {', '.join(f'0.0::double AS w{j}, {start}::double AS a{j}, 0.0::double AS b{j}' for j in range(4))})"]
    lines = []
    value, slope = (("greatest(z, 0) - z * y + ln(1 + exp(-abs(z)))", "p - y") if loss == "cross_entropy" else ("(y - p) * (y - p)", "2 * (p - y) * p * (1 - p)"))
    for k in range(batches * epochs):
        state = ", ".join(f"any_value({c}{j}) AS {c}{j}" for c in "wab" for j in range(4))
        pull = [f" + {strength}::double * {f'w{j}' if reg == 'l2' else f'sign(w{j})'}" if j < 3 else "" for j in range(4)]
        slopes = ", ".join(f"avg(s * {f'f{j}' if j < 3 else '1'}){pull[j].replace(f'w{j}', f'any_value(w{j})')} AS g{j}" for j in range(4))
        penalty = f"{strength}::double * ({' + '.join(f'0.5 * any_value(w{j}) * any_value(w{j})' if reg == 'l2' else f'abs(any_value(w{j}))' for j in range(3))})"
        parts.append(f"g{k} AS (SELECT avg({value}) + {penalty} AS loss, {slopes}, {state} FROM (SELECT *, {slope} AS s FROM (SELECT *, 1 / (1 + exp(-z)) AS p FROM (SELECT *, quality AS y, "
                     f"w3 + w0 * f0 + w1 * f1 + w2 * f2 AS z FROM docs, s{k} WHERE {v.hash_sql('doc_id', 0)} % {batches} = {k % batches}))))")
        new = []
        for j in range(4):
            if opt == "adam":
                a, b = f"(0.9::double * a{j} + 0.1::double * g{j})", f"(0.999::double * b{j} + 0.001::double * g{j} * g{j})"
                new.append(f"w{j} - {rate}::double * sqrt(1 - pow(0.999::double, {k + 1})) / (1 - pow(0.9::double, {k + 1})) * {a} / (sqrt({b}) + 1e-8) AS w{j}, {a} AS a{j}, {b} AS b{j}")
            else:
                a = f"(a{j} + g{j} * g{j})"
                b = f"(b{j} + g{j} - (sqrt({a}) - sqrt(a{j})) / {rate}::double * w{j})"
                new.append(f"-{b} * {rate}::double / sqrt({a}) AS w{j}, {a} AS a{j}, {b} AS b{j}")
        parts.append(f"s{k + 1} AS (SELECT {', '.join(new)} FROM g{k})")
        zero = " + ".join(f"(abs(w{j}) <= 1e-5)::int" for j in range(3))
        lines.append(f"SELECT '{opt}' AS opt, {k} AS step, round(loss, 5) AS loss, round((w0 + w1 + w2) / 3, 5) + 0.0 AS w_avg, round(({zero}) / 3, 5) AS w_zero_ratio FROM g{k}")
    return f"(WITH {', '.join(parts)} {' UNION ALL '.join(lines)})"


@query("logreg_minibatch", f"WITH {v.DOCS} SELECT * FROM {_minibatch_sql('adam', 'cross_entropy', 'l2')} UNION ALL SELECT * FROM {_minibatch_sql('ftrl', 'squared', 'l1')}")
def _(spark, sf):
    d = cut(v.docs(spark, sf))
    rows = []
    for opt, loss, reg in (("adam", "cross_entropy", "l2"), ("ftrl", "squared", "l1")):
        _, steps = linear.logreg_minibatch(d, "doc_id", F3, "quality", loss=loss, opt=opt, reg=reg, reg_param=0.001,
                                           rate=0.05, batches=3, epochs=2)
        rows += [(opt, s["step"], s["loss"], s["w_avg"], s["w_zero_ratio"]) for s in steps]
    out = spark.createDataFrame(rows, "opt string, step int, loss double, w_avg double, w_zero_ratio double")
    return out.select("opt", "step", *[R6(c, 5).alias(c) for c in ("loss", "w_avg", "w_zero_ratio")])


@query("linear_regression_fit", """SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice,
       l_quantity), 4) AS intercept, round(regr_r2(l_extendedprice, l_quantity), 6) AS r2 FROM lineitem""")
def _(spark, sf):
    out = linear.simple_regression(v.table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")
    return out.select(R6("slope", 4).alias("slope"), R6("intercept", 4).alias("intercept"), R6("r2").alias("r2"))


def _normal_equations_sql() -> str:
    """Least squares of the price on three columns: centred sums, solved by Cramer's rule."""
    x, y = ["l_quantity", "l_discount", "l_tax"], "l_extendedprice"
    sums = ", ".join([f"covar_pop({a}, {b}) AS s{i}{j}" for i, a in enumerate(x) for j, b in enumerate(x)] + [f"covar_pop({a}, {y}) AS r{i}" for i, a in enumerate(x)]
                     + [f"avg({a}) AS m{i}" for i, a in enumerate(x)] + [f"avg({y}) AS my", f"var_pop({y}) AS vy"])

    def det(m: list[list[str]]) -> str:
        (a, b, c), (d, e, f), (g, h, i) = m
        return f"({a} * ({e} * {i} - {f} * {h}) - {b} * ({d} * {i} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g}))"

    whole = [[f"s{i}{j}" for j in range(3)] for i in range(3)]
    solved = ", ".join(f"{det([[f'r{i}' if j == k else whole[i][j] for j in range(3)] for i in range(3)])} / {det(whole)} AS w{k}" for k in range(3))
    return f"""WITH s AS (SELECT {sums} FROM lineitem), w AS (SELECT *, {solved} FROM s)
       SELECT unnest(['l_quantity', 'l_discount', 'l_tax', 'intercept', 'r2']) AS name, unnest([round(w0, 3), round(w1, 3), round(w2, 3),
       round(my - w0 * m0 - w1 * m1 - w2 * m2, 3), round((w0 * r0 + w1 * r1 + w2 * r2) / vy, 3)]) + 0.0 AS value FROM w"""


@query("linear_regression_many", _normal_equations_sql())
def _(spark, sf):
    li = v.table(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_tax", "l_extendedprice")
    model = linear.linear_regression_fit(li, ["l_quantity", "l_discount", "l_tax"], "l_extendedprice")
    rows = [*zip(["l_quantity", "l_discount", "l_tax"], map(float, model.coefficients)), ("intercept", model.intercept),
            ("r2", model.summary.r2)]
    return spark.createDataFrame(rows, "name string, value double").withColumn("value", R6("value", 3))


# --- Bayes and neighbours ------------------------------------------------------------------------
@query("gaussian_nb_fit_predict", f"""WITH {v.VECTORS}, {v.LONG}, m AS (SELECT label, d, avg(v) AS m, var_pop(v) AS s FROM cells GROUP BY 1, 2),
       e AS (SELECT 1e-9 * max(s) AS e FROM (SELECT d, var_pop(v) AS s FROM cells GROUP BY 1)), p AS (SELECT label, ln(count(*) / (SELECT count(*)
       FROM vectors)) AS prior FROM vectors GROUP BY 1), s AS (SELECT c.id, m.label, any_value(prior) + sum(-0.5 * ln(2 * pi() * (s + e)) -
       (v - m) * (v - m) / (2 * (s + e))) AS score FROM cells c JOIN m USING (d) JOIN p ON p.label = m.label, e GROUP BY 1, 2)
       SELECT id, arg_max(label, score) AS pred FROM s GROUP BY 1""")
def _(spark, sf):
    rows = v.vectors(spark, sf)
    return bayes.GaussianNB().fit(rows, "x", "label").transform(rows, "x").select("id", "pred")


_TEST = f"{HASH.format(seed=0)} < {int(round(0.25 * v.HASH_PRIME))}"


@query("knn_classify", f"""WITH {v.VECTORS}, t AS (SELECT * FROM vectors WHERE {_TEST.replace('vec_id', 'id')}), r AS (SELECT * FROM vectors
       WHERE NOT {_TEST.replace('vec_id', 'id')}), n AS (SELECT t.id, r.label, row_number() OVER (PARTITION BY t.id ORDER BY
       {v.sql_d2('t.x', 'r.x')}, r.id) AS rk FROM t, r) SELECT id, label AS pred FROM n WHERE rk = 1""")
def _(spark, sf):
    train, test = validate.holdout_split(v.vectors(spark, sf), "id", 0.25)
    return nearest.knn_classify(train, test.select("id", "x"))


# --- forests ---------------------------------------------------------------------------------------
@query("random_forest_classifier")
def _(spark, sf):
    train, test = validate.holdout_split(v.vectors(spark, sf), "id", 0.25)
    model = forest.random_forest_classifier(train, "x", "label", trees=20, min_leaf=2)
    return model.transform(forest.with_features(test, "x")).select("id", F.col("prediction").cast("int").alias("pred"))


@query("gbt_classifier")
def _(spark, sf):
    train, test = validate.holdout_split(cut(v.docs(spark, sf)), "doc_id", 0.25)
    model = forest.gbt_classifier(train, F3, "quality", trees=5)
    return model.transform(forest.with_features(test, F3)).select("doc_id", F.col("prediction").cast("int").alias("pred"))


@query("ensemble_average", f"""WITH {v.ALL_DOCS}, p AS (SELECT doc_id, (3 / (1 + exp(-(f0 - 1))) + 1 / (1 + exp(-(f1 - 0.5)))) / 4 AS prob FROM docs)
       SELECT doc_id, round(prob, 6) AS prob, (prob > 0.5)::int AS pred FROM p""")
def _(spark, sf):
    d = v.all_docs(spark, sf)
    parts = [d.select("doc_id", sigmoid(F.col("f0") - 1).alias("prob")), d.select("doc_id", sigmoid(F.col("f1") - 0.5).alias("prob"))]
    return forest.ensemble_average(parts, "doc_id", [3.0, 1.0]).withColumn("prob", R6("prob"))


# --- boosting ----------------------------------------------------------------------------------------
def _boost_sql(rounds: int, depth: int, source: str = "docs", margin: str = "0.0::double", grads: str | None = None, eta: float = 0.3,
               features: tuple[str, ...] = ("f0", "f1", "f2"), bins: int = 32) -> str:
    """CTEs of an unrolled fit on ``source (doc_id, y, features)``: ``m{r} (doc_id, m)`` holds the margins after r rounds, ``train`` says which
    rows grow the trees. Cuts are the least value and ``bins - 1`` quantiles of a feature; a node may use those that begin a bin with rows of its own, and splits are the largest gain, then the first feature and cut."""
    steps = f"(SELECT unnest([{', '.join(f'{i} / {bins}.0::double' for i in range(1, bins))}]))"
    cells = " UNION ALL ".join(f"SELECT doc_id, {j} AS f, {c} AS x, train FROM src" for j, c in enumerate(features))
    parts = [f"src AS (SELECT * FROM {source})", f"cells AS MATERIALIZED ({cells})",
             f"cuts AS MATERIALIZED (SELECT DISTINCT f, x AS t FROM (SELECT f, min(x) AS x FROM cells WHERE train GROUP BY 1 UNION ALL SELECT f, v[greatest(ceil(p * len(v)), 1)::int] "
             f"FROM (SELECT f, list(x ORDER BY x) AS v FROM cells WHERE train GROUP BY 1), {steps} s(p)))",
             "bins AS MATERIALIZED (SELECT doc_id, f, max(t) AS t FROM cells JOIN cuts USING (f) WHERE t <= x GROUP BY 1, 2)",
             f"m0 AS MATERIALIZED (SELECT doc_id, {margin} AS m FROM src)"]
    for r in range(rounds):
        p = f"(1 / (1 + exp(-m)))"
        grad = grads.format(m=f"m{r}") if grads else f"SELECT doc_id, {p} - y AS g, greatest({p} * (1 - {p}), 1e-16) AS h FROM src JOIN m{r} USING (doc_id)"
        parts.append(f"gh{r} AS MATERIALIZED ({grad})")
        parts.append(f"n{r}_0 AS MATERIALIZED (SELECT doc_id, 0 AS node, train, false AS leaf FROM src)")
        for d in range(depth):
            at, k = f"n{r}_{d}", f"{r}_{d}"
            gain = "gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1)"
            parts.append(f"tot{k} AS MATERIALIZED (SELECT node, sum(g) AS g, sum(h) AS h FROM {at} JOIN gh{r} USING (doc_id) WHERE train AND NOT leaf GROUP BY 1)")
            parts.append(f"left{k} AS MATERIALIZED (SELECT node, f, t, sum(gh.g) AS gl, sum(gh.h) AS hl FROM {at} JOIN gh{r} gh USING (doc_id) JOIN (SELECT doc_id, f, x FROM cells) USING (doc_id) "
                         f"JOIN cuts USING (f) WHERE x < t AND {at}.train AND NOT leaf GROUP BY 1, 2, 3)")
            parts.append(f"best{k} AS MATERIALIZED (SELECT node, f, t FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain::float DESC, f, t) AS rk FROM (SELECT node, f, t, {gain} AS gain "
                         f"FROM left{k} JOIN tot{k} USING (node) SEMI JOIN (SELECT node, f, t FROM {at} JOIN bins USING (doc_id) WHERE train) USING (node, f, t) WHERE hl >= 1 AND h - hl >= 1)) WHERE rk = 1 AND gain > 1e-6)")
            parts.append(f"n{r}_{d + 1} AS MATERIALIZED (SELECT a.doc_id, CASE WHEN b.node IS NULL THEN a.node WHEN c.x < b.t THEN 2 * a.node + 1 ELSE 2 * a.node + 2 END AS node, a.train, "
                         f"b.node IS NULL AS leaf FROM {at} a LEFT JOIN best{k} b ON b.node = a.node AND NOT a.leaf LEFT JOIN cells c ON c.doc_id = a.doc_id AND c.f = b.f)")
        last = f"n{r}_{depth}"
        parts.append(f"w{r} AS MATERIALIZED (SELECT node, CASE WHEN sum(h) < 1 THEN 0 ELSE -sum(g) / (sum(h) + 1) * {eta}::double END AS w FROM {last} JOIN gh{r} USING (doc_id) WHERE train GROUP BY 1)")
        parts.append(f"m{r + 1} AS MATERIALIZED (SELECT doc_id, m + w AS m FROM m{r} JOIN {last} USING (doc_id) JOIN w{r} USING (node))")
    return ", ".join(parts)


_LEARN = "(SELECT *, quality AS y, true AS train FROM docs)"
_PRED = "SELECT doc_id, round(1 / (1 + exp(-m)), 6) AS pred FROM m{}"

_OBJECTIVES = {
    "reg:linear": ("m - y", "1.0::double"),
    "binary:logistic": ("1 / (1 + exp(-m)) - y", "1 / (1 + exp(-m)) * (1 - 1 / (1 + exp(-m)))"),
    "count:poisson": ("exp(m) - y", "exp(m + 0.7)"),
    "reg:gamma": ("1 - y / exp(m)", "y / exp(m)"),
    "reg:tweedie": ("exp(0.5 * m) - y * exp(-0.5 * m)", "0.5 * exp(0.5 * m) + 0.5 * y * exp(-0.5 * m)"),
}


@query("newton_boost_objectives", f"WITH {v.DOCS}, r AS (SELECT ln(1 + f0) - 1 AS m, quality AS y FROM docs) " + " UNION ALL ".join(
    f"SELECT '{k}' AS objective, round(sum({g}), 4) + 0.0 AS g, round(sum({h}), 4) + 0.0 AS h FROM r" for k, (g, h) in _OBJECTIVES.items()))
def _(spark, sf):
    rows = v.docs(spark, sf).select((F.log1p("f0") - 1).alias("m"), F.col("quality").alias("y"))
    pairs = {k: boost.gradients(k, F.col("m"), F.col("y")) for k in _OBJECTIVES}
    cells = F.array(*[F.struct(F.lit(k).alias("objective"), g.alias("g"), h.alias("h")) for k, (g, h) in pairs.items()])
    return rows.select(F.explode(cells).alias("c")).groupBy("c.objective").agg(
        R6(F.sum("c.g"), 4).alias("g"), R6(F.sum("c.h"), 4).alias("h"))


@query("softmax_gradients", f"""WITH {v.DOCS}, r AS (SELECT [f0, f1, f2] AS m, quality AS y FROM docs), p AS (SELECT y, c, exp(m[c + 1]) /
       (exp(m[1]) + exp(m[2]) + exp(m[3])) AS p FROM r, (SELECT unnest([0, 1, 2]) AS c)) SELECT c AS cls, round(sum(p - (y = c)::int), 4) + 0.0 AS g,
       round(sum(2 * p * (1 - p)), 4) + 0.0 AS h FROM p GROUP BY 1""")
def _(spark, sf):
    pairs = boost.softmax_gradients([F.col(f) for f in F3], F.col("quality"))
    cells = F.array(*[F.struct(F.lit(c).alias("cls"), g.alias("g"), h.alias("h")) for c, (g, h) in enumerate(pairs)])
    return v.docs(spark, sf).select(F.explode(cells).alias("c")).groupBy("c.cls").agg(
        R6(F.sum("c.g"), 4).alias("g"), R6(F.sum("c.h"), 4).alias("h"))


@query("pairwise_gradients", f"""WITH {v.DOCS}, r AS (SELECT doc_id, lang, quality AS y, floor(f0 * 4) / 4 AS m FROM docs), p AS (SELECT a.doc_id,
       CASE WHEN a.y > b.y THEN -1 ELSE 1 END AS s, 1 / (1 + exp(-CASE WHEN a.y > b.y THEN b.m - a.m ELSE a.m - b.m END)) AS p FROM r a JOIN r b
       ON a.lang = b.lang AND a.y <> b.y) SELECT r.doc_id, round(coalesce(sum(s * p), 0), 5) + 0.0 AS g, round(coalesce(sum(2 * p * (1 - p)), 0), 5)
       + 0.0 AS h FROM r LEFT JOIN p USING (doc_id) GROUP BY 1""")
def _(spark, sf):
    rows = v.docs(spark, sf).select("doc_id", "lang", F.col("quality").alias("y"), (F.floor(F.col("f0") * 4) / 4).alias("m"))
    return boost.pairwise_gradients(rows, "lang", "y", "m").select("doc_id", R6("g", 5).alias("g"), R6("h", 5).alias("h"))


def log_objective(margin, label):
    """A user objective: logistic loss on margins."""
    p = sigmoid(margin)
    return p - label, p * (1 - p)


@query("newton_boost_custom", f"""WITH {v.DOCS}, r AS (SELECT 1 / (1 + exp(-(f0 - f1))) AS p, quality AS y FROM docs) SELECT round(sum(p - y), 4) + 0.0 AS g,
       round(sum(p * (1 - p)), 4) AS h, round(avg(((p > 0.5)::int <> y)::int), 6) AS error FROM r""")
def _(spark, sf):
    g, h = boost.gradients(log_objective, F.col("f0") - F.col("f1"), F.col("quality"))
    wrong = ((F.col("f0") - F.col("f1") > 0).cast("int") != F.col("quality")).cast("double")
    return v.docs(spark, sf).agg(R6(F.sum(g), 4).alias("g"), R6(F.sum(h), 4).alias("h"), R6(F.avg(wrong)).alias("error"))


def _boosted(spark, sf, features=F3, label="quality", **params):
    d = cut(v.docs(spark, sf))
    tool = boost.NewtonBoost(**{"objective": "binary:logistic", "num_round": 3, "max_depth": 3, **params})
    return d, tool.fit(d, "doc_id", features, label)


@query("newton_boost_fit", f"WITH {v.DOCS}, {_boost_sql(3, 3, _LEARN)} {_PRED.format(3)}")
def _(spark, sf):
    d, model = _boosted(spark, sf)
    return model.predict(d).select("doc_id", R6("pred").alias("pred"))


@query("newton_boost_custom_fit", f"""WITH {v.DOCS}, {_boost_sql(2, 2, _LEARN, "0.5::double")} SELECT count(*) AS n, round(avg(((m > 0)::int <> y)::int), 6) AS error,
       round(avg(m), 5) + 0.0 AS margin FROM m2 JOIN src USING (doc_id)""")
def _(spark, sf):
    d = cut(v.docs(spark, sf))
    wrong = lambda df: df.agg(F.avg(((F.col("pred") > 0).cast("int") != F.col("label")).cast("double"))).first()[0]
    model = boost.NewtonBoost(objective=log_objective, num_round=2, max_depth=2).fit(d, "doc_id", F3, "quality", watch={"train": d}, metric=wrong)
    return model.predict(d, out="m").agg(F.count(F.lit(1)).alias("n"), R6(F.lit(model.history[-1]["train"])).alias("error"), R6(F.avg("m"), 5).alias("margin"))


def _one_class_sql(c: int) -> str:
    """One tree for class c; before the first round every class has probability 0.1."""
    names = tuple(f"x[{j + 1}]" for j in range(64))
    source = "(SELECT id AS doc_id, label, x, true AS train FROM vectors)"
    grads = f"SELECT doc_id, 0.1::double - (label = {c})::int AS g, 0.18::double AS h FROM src"
    return f"(WITH {_boost_sql(1, 3, source, '0.5::double', grads, features=names, bins=16)} SELECT doc_id AS id, {c} AS c, m FROM m1)"


@query("newton_boost_multiclass", f"""WITH {v.VECTORS}, m AS MATERIALIZED ({' UNION ALL '.join(f'SELECT * FROM {_one_class_sql(c)}' for c in range(10))})
       SELECT id, arg_max(c, (round(m, 9), -c))::int AS pred FROM m GROUP BY 1""")
def _(spark, sf):
    x = v.vectors(spark, sf).select("id", "label", *[F.col("x")[j].alias(f"x{j}") for j in range(64)])
    x = cut(x)
    names = [f"x{j}" for j in range(64)]
    model = boost.NewtonBoost(objective="multi:softmax", num_class=10, num_round=1, max_depth=3, max_bins=16).fit(x, "id", names, "label")
    # margins that differ in the order of summation only go to the first class
    m = F.transform("m", lambda a: F.round(a, 9))
    return model.predict(x, out="m", margin=True).select("id", (F.array_position(m, F.array_max(m)) - 1).cast("int").alias("pred"))


_PAIR_GRADS = """SELECT r.doc_id, coalesce(sum(s * p), 0) AS g, coalesce(sum(2 * p * (1 - p)), 0) AS h FROM src r LEFT JOIN (SELECT a.doc_id, CASE WHEN a.y > b.y THEN -1 ELSE 1 END AS s,
       1 / (1 + exp(-CASE WHEN a.y > b.y THEN k.m - j.m ELSE j.m - k.m END)) AS p FROM src a JOIN {m} j USING (doc_id) JOIN src b ON a.lang = b.lang AND a.y <> b.y
       JOIN {m} k ON k.doc_id = b.doc_id) q USING (doc_id) GROUP BY 1"""


@query("newton_boost_ranking", f"""WITH {v.DOCS}, {_boost_sql(2, 2, _LEARN, "0.5::double", _PAIR_GRADS)} SELECT doc_id, lang, round(m, 5) + 0.0 AS pred FROM m2 JOIN docs USING (doc_id)""")
def _(spark, sf):
    d = cut(v.docs(spark, sf))
    model = boost.NewtonBoost(objective="rank:pairwise", num_round=2, max_depth=2).fit(d, "doc_id", F3, "quality", group="lang")
    return model.predict(d, margin=True).select("doc_id", "lang", R6("pred", 5).alias("pred"))


@query("newton_boost_sampling")
def _(spark, sf):
    d, model = _boosted(spark, sf, subsample=0.7, colsample_bytree=0.7, colsample_bylevel=0.9, colsample_bynode=0.9)
    return model.predict(d).select("doc_id", "pred")


@query("boosted_random_forest")
def _(spark, sf):
    d = cut(v.docs(spark, sf))
    model = boost.boosted_random_forest(10, objective="binary:logistic", max_depth=4, colsample_bynode=0.7).fit(d, "doc_id", F3, "quality")
    return model.predict(d).select("doc_id", "pred")


@query("boosted_random_forest_regressor")
def _(spark, sf):
    d = cut(v.docs(spark, sf))
    model = boost.boosted_random_forest(10, max_depth=4, colsample_bynode=0.7).fit(d, "doc_id", ["f1", "f2", "quality"], "f0")
    return model.predict(d).select("doc_id", "f0", "pred")


@query("newton_boost_continue", f"WITH {v.DOCS}, {_boost_sql(2, 3, _LEARN)} {_PRED.format(2)}")
def _(spark, sf):
    d, first = _boosted(spark, sf, num_round=1)
    margin = first.predict(d, out="base", margin=True)
    again = boost.NewtonBoost(objective="binary:logistic", num_round=1, max_depth=3).fit(margin, "doc_id", F3, "quality", base_margin="base")
    return again.predict(margin, base=F.col("base")).select("doc_id", R6("pred").alias("pred"))


@query("newton_boost_saved", f"WITH {v.DOCS}, {_boost_sql(3, 3, _LEARN)} {_PRED.format(3)}")
def _(spark, sf):
    d, first = _boosted(spark, sf, num_round=1)
    path = scratch_path(spark, "model")
    first.save(spark, path)
    tool = boost.NewtonBoost(objective="binary:logistic", num_round=2, max_depth=3)
    model = tool.fit(d, "doc_id", F3, "quality", model=boost.BoostModel.load(spark, path))
    return model.predict(d).select("doc_id", R6("pred").alias("pred"))


_SPLIT_DOCS = f"(SELECT *, quality AS y, NOT ({_TEST.replace('vec_id', 'doc_id')}) AS train FROM docs)"


def _watch_sql(rounds: int) -> str:
    lines = " UNION ALL ".join(f"SELECT {r} AS round, train, avg(((m > 0)::int <> y)::int) AS error, avg(-(y * ln(1 / (1 + exp(-m))) + (1 - y) * ln(1 - 1 / (1 + exp(-m))))) AS loss "
                               f"FROM m{r + 1} JOIN src USING (doc_id) GROUP BY ALL" for r in range(rounds))
    return f"WITH {v.DOCS}, {_boost_sql(rounds, 2, _SPLIT_DOCS)}, lines AS ({lines})"


@query("newton_boost_metrics", _watch_sql(4) + """ SELECT round, round(any_value(error) FILTER (train), 6) AS train_error, round(any_value(loss) FILTER (train), 6) AS train_loss,
       round(any_value(error) FILTER (NOT train), 6) AS test_error, round(any_value(loss) FILTER (NOT train), 6) AS test_loss,
       (SELECT 1 + arg_min(round, (loss, round)) FROM lines WHERE NOT train)::int AS best_trees FROM lines GROUP BY 1""")
def _(spark, sf):
    train, test = validate.holdout_split(cut(v.docs(spark, sf)), "doc_id", 0.25)
    model = boost.NewtonBoost(objective="binary:logistic", num_round=4, max_depth=2).fit(
        train, "doc_id", F3, "quality", watch={"train": train, "test": test}, metric=["error", "logloss"])
    rows = [(i, *[h[f"{t}-{m}"] for t in ("train", "test") for m in ("error", "logloss")], model.best_trees()) for i, h in enumerate(model.history)]
    out = spark.createDataFrame(rows, "round int, train_error double, train_loss double, test_error double, test_loss double, best_trees int")
    return out.select("round", *[R6(c).alias(c) for c in out.columns[1:-1]], "best_trees")


@query("newton_boost_watch", _watch_sql(4) + """ SELECT round, round(any_value(error) FILTER (train), 6) AS train, round(any_value(error) FILTER (NOT train), 6) AS test FROM lines
       WHERE round <= coalesce((SELECT min(a.round) FROM lines a WHERE NOT a.train AND a.round - (SELECT arg_min(b.round, (b.error, b.round)) FROM lines b
       WHERE NOT b.train AND b.round <= a.round) >= 2), 99) GROUP BY 1""")
def _(spark, sf):
    train, test = validate.holdout_split(cut(v.docs(spark, sf)), "doc_id", 0.25)
    model = boost.NewtonBoost(objective="binary:logistic", num_round=4, max_depth=2).fit(
        train, "doc_id", F3, "quality", watch={"train": train, "test": test}, early_stop=2)
    out = spark.createDataFrame([(i, h["train"], h["test"]) for i, h in enumerate(model.history)], "round int, train double, test double")
    return out.select("round", R6("train").alias("train"), R6("test").alias("test"))


def _given(spark):
    """Two stored trees over (f0, f1)."""
    rows = [(0, 0, 0, 0, 1.0, 1, 2, 1, None, 9.0, 9.0), (0, 1, 0, 1, 0.1, 3, 4, 4, None, 9.0, 9.0), (0, 2, 0, None, None, None, None, None, -0.4, None, 9.0),
            (0, 3, 0, None, None, None, None, None, 0.6, None, 9.0), (0, 4, 0, None, None, None, None, None, 0.2, None, 9.0),
            (1, 0, 0, 1, 0.2, 1, 2, 2, None, 9.0, 9.0), (1, 1, 0, None, None, None, None, None, 0.3, None, 9.0),
            (1, 2, 0, None, None, None, None, None, -0.1, None, 9.0)]
    return spark.createDataFrame(rows, boost.NODE_SCHEMA)


@query("predict_first_n_trees", f"""WITH {v.ALL_DOCS}, t AS (SELECT doc_id, CASE WHEN f0 < 1 THEN CASE WHEN f1 < 0.1 THEN 0.6 ELSE 0.2 END ELSE -0.4 END AS a,
       CASE WHEN f1 < 0.2 THEN 0.3 ELSE -0.1 END AS b FROM docs) SELECT doc_id, round(1 / (1 + exp(-a)), 6) AS one, round(1 / (1 + exp(-(a + b))), 6)
       AS two, round(a + b, 6)::double + 0.0 AS margin FROM t""")
def _(spark, sf):
    model = boost.BoostModel(["f0", "f1"], boost.Params(objective="binary:logistic"), boost.trees_from_table(_given(spark)))
    out = model.predict(model.predict(v.all_docs(spark, sf), 1, "one"), 2, "two")
    return model.predict(out, 2, "margin", margin=True).select("doc_id", *[R6(c).alias(c) for c in ("one", "two", "margin")])


def _splits_sql(rounds: int, depth: int) -> str:
    return " UNION ALL ".join(f"SELECT {r} AS tree, * FROM best{r}_{d}" for r in range(rounds) for d in range(depth))


@query("dump_trees", f"""WITH {v.DOCS}, {_boost_sql(2, 3, _LEARN)}, nodes AS (SELECT tree, node, printf('%d:[%s<%.6f] yes=%d,no=%d,missing=%d', node, ['f0', 'f1', 'f2'][f + 1], t,
       2 * node + 1, 2 * node + 2, 2 * node + 1) AS line FROM ({_splits_sql(2, 3)}) UNION ALL SELECT tree, node, printf('%d:leaf=%.6f', node, w) FROM (SELECT 0 AS tree, * FROM w0
       UNION ALL SELECT 1, * FROM w1)) SELECT tree, node, repeat(chr(9), floor(log2(node + 1))::int) || line AS line FROM nodes""")
def _(spark, sf):
    _, model = _boosted(spark, sf, num_round=2)
    names = spark.createDataFrame([(i, f) for i, f in enumerate(F3)], "feature int, name string")
    return boost.dump_trees(model, spark, names)


@query("feature_importance", f"WITH {v.DOCS}, {_boost_sql(2, 3, _LEARN)} SELECT f AS feature, count(*) AS splits FROM ({_splits_sql(2, 3)}) GROUP BY 1")
def _(spark, sf):
    _, model = _boosted(spark, sf, num_round=2)
    return boost.feature_importance(model.node_table(spark))


@query("dart_boost")
def _(spark, sf):
    d, model = _boosted(spark, sf, dart=True, rate_drop=0.5, one_drop=True, num_round=3, max_depth=2)
    return model.predict(d).select("doc_id", "pred")


def _linear_boost_sql(rounds: int, lam: float, alpha: float) -> str:
    parts = ["w0 AS (SELECT 0.0::double AS w0, 0.0::double AS w1, 0.0::double AS w2, 0.0::double AS b)"]
    for k in range(rounds):
        sums = ", ".join(f"sum(g * f{j}) + {lam}::double * count(*) * any_value(w{j}) AS g{j}, sum(h * f{j} * f{j}) + {lam}::double * count(*) AS h{j}, any_value(w{j}) AS w{j}" for j in range(3))
        step = ", ".join(f"w{j} + 0.5::double / 3 * CASE WHEN h{j} < 1e-12 THEN 0 WHEN w{j} - g{j} / h{j} >= 0 THEN greatest(-(g{j} + al) / h{j}, -w{j}) "
                         f"ELSE least(-(g{j} - al) / h{j}, -w{j}) END AS w{j}" for j in range(3))
        parts.append(f"p{k} AS (SELECT *, 1 / (1 + exp(-(b + w0 * f0 + w1 * f1 + w2 * f2))) AS p FROM docs, w{k})")
        parts.append(f"s{k} AS (SELECT sum(g) AS g, sum(h) AS h, any_value(b) AS b, {alpha}::double * count(*) AS al, {sums} FROM (SELECT *, p - quality AS g, "
                     f"greatest(p * (1 - p), 1e-16) AS h FROM p{k}))")
        parts.append(f"w{k + 1} AS (SELECT {step}, b - 0.5::double * g / h AS b FROM s{k})")
    return f"""WITH {v.DOCS}, {", ".join(parts)} SELECT unnest(['f0', 'f1', 'f2', 'bias']) AS name, unnest([round(w0, 5), round(w1, 5), round(w2, 5), round(b, 5)]) + 0.0 AS weight
       FROM w{rounds}"""


@query("linear_boost", _linear_boost_sql(5, 0.01, 0.001))
def _(spark, sf):
    d = v.docs(spark, sf)
    model = boost.LinearBooster(num_round=5, reg_lambda=0.01, reg_alpha=0.001).fit(d, F3, "quality")
    rows = spark.createDataFrame([*zip(F3, model.weights), ("bias", model.bias)], "name string, weight double")
    return rows.withColumn("weight", R6("weight", 5))


@query("class_weight_scale", f"WITH {v.DOCS} SELECT round(count(*) FILTER (quality = 0) / count(*) FILTER (quality = 1), 6) AS scale_pos_weight FROM docs")
def _(spark, sf):
    return boost.class_weight_scale(v.docs(spark, sf), "quality").select(R6("scale_pos_weight").alias("scale_pos_weight"))


# --- C4.5 ------------------------------------------------------------------------------------------------
def _categorical(spark, sf):
    d = v.docs(spark, sf)
    return d.select("doc_id", "lang", "source", F.col("toxic").cast("string").alias("toxic"),
                    F.least(F.floor("f0"), F.lit(3)).cast("string").alias("size"), "quality")


C45_ATTRS = ["lang", "source", "toxic", "size"]


def _c45_sql(depth: int) -> str:
    """CTEs of ``depth`` unrolled levels: ``r{d}`` holds the rows with their node, ``tree`` all nodes."""
    names = ", ".join(f"'{a}'" for a in C45_ATTRS)
    parts = [f"""r0 AS MATERIALIZED (SELECT doc_id, quality AS cls, lang, source, toxic::varchar AS toxic, least(floor(f0), 3)::int::varchar AS size, 'root' AS node, NULL::varchar AS parent,
       NULL::varchar AS attr, NULL::varchar AS value, []::varchar[] AS used FROM docs)"""]
    tree = []
    entropy = "log2(sum({0})) - sum({0} * log2({0})) / sum({0})"
    for d in range(depth + 1):
        parts.append(f"""c{d} AS MATERIALIZED (SELECT node, parent, attr, value, sum(n)::bigint AS n, arg_min(cls, (-n, cls)) AS label FROM (SELECT node, parent, attr, value, cls, count(*) AS n FROM r{d}
       GROUP BY ALL) GROUP BY ALL)""")
        if d < depth:
            parts.append(f"""g{d} AS MATERIALIZED (SELECT node, a, v, cls, count(*) AS n FROM (SELECT node, cls, used, unnest([{names}]) AS a, unnest([lang, source, toxic, size]) AS v FROM r{d})
       WHERE NOT list_contains(used, a) GROUP BY ALL), v{d} AS (SELECT node, a, v, sum(n) AS n, {entropy.format('n')} AS h FROM g{d} GROUP BY ALL),
       i{d} AS (SELECT node, a, sum(n * h) / sum(n) AS c, {entropy.format('n')} AS s FROM v{d} GROUP BY ALL), k{d} AS (SELECT node, a, {entropy.format('n')} AS e FROM
       (SELECT node, a, cls, sum(n) AS n FROM g{d} GROUP BY ALL) GROUP BY ALL), b{d} AS MATERIALIZED (SELECT node, a AS split FROM (SELECT node, a, row_number() OVER (PARTITION BY node ORDER BY
       round((e - c) / s, 12) DESC, list_position([{names}], a)) AS rk FROM i{d} JOIN k{d} USING (node, a) WHERE round(s, 12) > 0 AND round((e - c) / s, 12) > 0) WHERE rk = 1),
       r{d + 1} AS MATERIALIZED (SELECT doc_id, cls, lang, source, toxic, size, concat_ws('/', node, concat_ws('=', split, val)) AS node, node AS parent, split AS attr, val AS value, list_append(used, split) AS used
       FROM (SELECT *, CASE split WHEN 'lang' THEN lang WHEN 'source' THEN source WHEN 'toxic' THEN toxic ELSE size END AS val FROM r{d} JOIN b{d} USING (node)))""")
            tree.append(f"SELECT c{d}.*, {d} AS depth, split FROM c{d} LEFT JOIN b{d} USING (node)")
        else:
            tree.append(f"SELECT *, {d} AS depth, NULL AS split FROM c{d}")
    return f"WITH {v.DOCS}, {', '.join(parts)}, tree AS MATERIALIZED ({' UNION ALL '.join(tree)})"


@query("c45_tree_fit", f"{_c45_sql(4)} SELECT node, parent, depth, attr, value, n, label, split AS split_attr FROM tree")
def _(spark, sf):
    return c45.c45_tree_fit(_categorical(spark, sf), C45_ATTRS, "quality")


@query("c45_tree_edges", f"""{_c45_sql(2)} SELECT parent, node AS child, value AS label FROM tree WHERE parent IS NOT NULL UNION ALL
       SELECT node, node || '/class', label::varchar FROM tree WHERE split IS NULL""")
def _(spark, sf):
    return c45.c45_tree_edges(c45.c45_tree_fit(_categorical(spark, sf), C45_ATTRS, "quality", 2))


@query("c45_predict", f"""{_c45_sql(2)} SELECT doc_id, label AS pred FROM (SELECT doc_id, arg_max(node, depth) AS node FROM (SELECT doc_id, node, 0 AS depth FROM r0 UNION ALL
       SELECT doc_id, node, 1 FROM r1 UNION ALL SELECT doc_id, node, 2 FROM r2) GROUP BY 1) JOIN tree USING (node)""")
def _(spark, sf):
    rows = cut(_categorical(spark, sf))
    return c45.c45_predict(rows, c45.c45_tree_fit(rows, C45_ATTRS, "quality", 2), C45_ATTRS, "doc_id")
