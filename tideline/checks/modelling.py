"""Evaluation tables, neighbours, resampling, learning."""

from pyspark.sql import functions as F

from tideline.checks.registry import big, check, r6
from tideline.operators import diff, evaluate, learn, neighbours, resample, sampling
from tideline.session import materialize

# -- evaluation -------------------------------------------------------------------

SCORED = "s AS (SELECT doc_id, quality AS y, lang, LEAST(n_chars / 20000.0, 1.0)::DOUBLE AS p FROM labels JOIN documents USING (doc_id))"
SALES = "s AS (SELECT l_orderkey * 8 + l_linenumber AS k, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, l_quantity / 50 AS p FROM lineitem)"


def scored(t):
    return t.labels.join(t.documents.select("doc_id", "lang", "n_chars"), "doc_id").select(
        "doc_id", F.col("quality").alias("y"), "lang", F.least(F.col("n_chars") / 20000.0, F.lit(1.0)).alias("p")
    )


def sales(t):
    """Every line scored by its quantity: 50 distinct scores, so ties everywhere."""
    return t.lineitem.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("k"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        (F.col("l_quantity") / 50).alias("p"),
    )


RATES = """tn, fp, fn, tp, ROUND((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy, ROUND(COALESCE(tp / NULLIF(tp + fp, 0), 0), 6) AS "precision",
       ROUND(COALESCE(tp / NULLIF(tp + fn, 0), 0), 6) AS recall, ROUND(COALESCE(2 * tp / NULLIF(2 * tp + fp + fn, 0), 0), 6) AS f1,
       ROUND((tp / (tp + fn) + tn / (tn + fp)) / 2, 6) AS roc_auc"""


@check(
    "confusion_metrics",
    f"""WITH {SCORED}, c AS (SELECT COUNT(*) FILTER (y = 0 AND p < 0.1) AS tn, COUNT(*) FILTER (y = 0 AND p >= 0.1) AS fp,
              COUNT(*) FILTER (y = 1 AND p < 0.1) AS fn, COUNT(*) FILTER (y = 1 AND p >= 0.1) AS tp FROM s) SELECT {RATES} FROM c""",
)
def confusion_metrics(t):
    row = evaluate.classification_metrics(scored(t), "y", "p", 0.1)
    return row.withColumns({c: F.round(c, 6) for c in ("accuracy", "precision", "recall", "f1", "roc_auc")})


@check(
    "class_report",
    f"""WITH {SALES}, h AS (SELECT y, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS q FROM s), c AS (SELECT unnest([0, 1]) AS class)
       SELECT class, ROUND(COUNT(*) FILTER (y = class AND q = class) / COUNT(*) FILTER (q = class), 6) AS "precision",
              ROUND(COUNT(*) FILTER (y = class AND q = class) / COUNT(*) FILTER (y = class), 6) AS recall,
              ROUND(2 * COUNT(*) FILTER (y = class AND q = class) / (COUNT(*) FILTER (q = class) + COUNT(*) FILTER (y = class)), 6) AS f1,
              COUNT(*) FILTER (y = class) AS support FROM h, c GROUP BY class""",
)
def class_report(t):
    rows = sales(t).withColumn("q", evaluate.hard_label(F.col("p")))
    return evaluate.class_report(rows, "y", "q").select("class", r6("precision"), r6("recall"), r6("f1"), big("support"))


AUC_SQL = """g AS (SELECT p, COUNT(*) FILTER (y = 1) AS a, COUNT(*) FILTER (y = 0) AS b FROM s GROUP BY p),
       c AS (SELECT a, b, SUM(a) OVER (ORDER BY p DESC ROWS UNBOUNDED PRECEDING) - a AS above FROM g)
       SELECT ROUND(SUM(b * (above + a / 2)) / (SUM(a) * SUM(b)), 6) AS roc_auc, SUM(a)::BIGINT AS positives, SUM(b)::BIGINT AS negatives FROM c"""


@check("roc_auc", f"WITH {SCORED}, {AUC_SQL}")
def roc_auc(t):
    return evaluate.roc_auc(scored(t), "y", "p").select(r6("roc_auc"), big("positives"), big("negatives"))


@check("roc_auc_ties", f"WITH {SALES}, {AUC_SQL}")
def roc_auc_ties(t):
    return evaluate.roc_auc(sales(t), "y", "p").select(r6("roc_auc"), big("positives"), big("negatives"))


CURVE_SQL = """g AS (SELECT p, COUNT(*) FILTER (y = 1) AS a, COUNT(*) FILTER (y = 0) AS b FROM s GROUP BY p),
       c AS (SELECT p, SUM(a) OVER w AS tp, SUM(b) OVER w AS fp, (SELECT SUM(a) FROM g) AS np, (SELECT SUM(b) FROM g) AS nn FROM g
             WINDOW w AS (ORDER BY p DESC ROWS UNBOUNDED PRECEDING))"""


@check(
    "curve_points",
    f"""WITH {SCORED}, {CURVE_SQL} SELECT ROUND(p, 6) AS threshold, tp::BIGINT AS tp, fp::BIGINT AS fp, ROUND(fp / nn, 6) AS fpr, ROUND(tp / np, 6) AS tpr,
              ROUND(tp / (tp + fp), 6) AS "precision", ROUND(tp / np, 6) AS recall FROM c""",
)
def curve_points(t):
    points = evaluate.curve_points(scored(t), "y", "p")
    return points.select(r6("threshold"), big("tp"), big("fp"), r6("fpr"), r6("tpr"), r6("precision"), r6("recall"))


@check(
    "mean_curves",
    """WITH s AS (SELECT l_returnflag AS run, CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS y, l_extendedprice AS p FROM lineitem),
       g AS (SELECT run, p, COUNT(*) FILTER (y = 1) AS a, COUNT(*) FILTER (y = 0) AS b FROM s GROUP BY run, p),
       c AS (SELECT run, SUM(a) OVER w AS tp, SUM(b) OVER w AS fp, SUM(a) OVER (PARTITION BY run) AS np, SUM(b) OVER (PARTITION BY run) AS nn FROM g
             WINDOW w AS (PARTITION BY run ORDER BY p DESC ROWS UNBOUNDED PRECEDING)),
       m AS (SELECT run, x, MAX(tp / np) AS tpr FROM c, (SELECT unnest(range(0, 21)) AS x) WHERE fp / nn <= x / 20 GROUP BY run, x)
       SELECT x / 20 AS fpr, ROUND(AVG(tpr), 6) AS tpr, COUNT(*) AS runs FROM m GROUP BY x""",
)
def mean_curves(t):
    """Curves of three score groups averaged on a grid of 20 steps."""
    rows = t.lineitem.select("l_returnflag", (F.col("l_linestatus") == "O").cast("int").alias("y"), F.col("l_extendedprice").alias("p"))
    parts = None
    for flag in ("A", "N", "R"):
        points = evaluate.curve_points(rows.where(F.col("l_returnflag") == flag), "y", "p").withColumn("run", F.lit(flag))
        parts = points if parts is None else parts.unionByName(points)
    return evaluate.mean_curves(parts, "run", 20).select("fpr", r6("tpr"), "runs")


@check(
    "threshold_sweep",
    f"""WITH {SALES}, h AS (SELECT unnest(range(4, 17)) / 20 AS threshold),
       c AS (SELECT threshold, COUNT(*) FILTER (y = 0 AND p < threshold) AS tn, COUNT(*) FILTER (y = 0 AND p >= threshold) AS fp,
                    COUNT(*) FILTER (y = 1 AND p < threshold) AS fn, COUNT(*) FILTER (y = 1 AND p >= threshold) AS tp FROM s, h GROUP BY threshold),
       a AS (SELECT *, (tp / (tp + fn) + tn / (tn + fp)) / 2 AS auc FROM c)
       SELECT threshold, {RATES}, CASE WHEN threshold = (SELECT threshold FROM a ORDER BY auc DESC, threshold LIMIT 1) THEN 1 ELSE 0 END AS best FROM a""",
)
def threshold_sweep(t):
    swept = evaluate.threshold_sweep(sales(t), "y", "p")
    return swept.withColumns({c: F.round(c, 6) for c in ("accuracy", "precision", "recall", "f1", "roc_auc")})


TOP_BOTTOM_SQL = """o AS (SELECT y, row_number() OVER (ORDER BY p DESC, {key}) AS r, COUNT(*) OVER () AS n FROM s),
       c AS (SELECT LEAST(200, MAX(n)) AS top_rows, CAST(floor(MAX(n) * 0.2) AS BIGINT) AS bottom_rows, SUM(y) AS g, SUM(CASE WHEN r <= 200 THEN y ELSE 0 END) AS a,
              SUM(CASE WHEN r > n - floor(n * 0.2) THEN y ELSE 0 END) AS b, SUM(CASE WHEN r > floor(n * 0.1) AND r <= floor(n * 0.9) THEN y ELSE 0 END) AS m FROM o)
       SELECT top_rows, bottom_rows, g::BIGINT AS positives, a::BIGINT AS top_hits, b::BIGINT AS bottom_hits, m::BIGINT AS middle_hits,
              ROUND(0.7 * (a / top_rows) + 0.3 * ((bottom_rows - b) / bottom_rows), 6) AS score,
              ROUND(0.7 * (a / top_rows) / (g / top_rows) + 0.3 * ((bottom_rows - b) / bottom_rows - (bottom_rows - g) / bottom_rows) / (1 - (bottom_rows - g) / bottom_rows), 6) AS normalized_score FROM c"""


@check("top_bottom", f"WITH {SCORED}, " + TOP_BOTTOM_SQL.format(key="doc_id"))
def top_bottom(t):
    row = evaluate.top_bottom(scored(t), "y", "p", "doc_id")
    return row.withColumns(
        {c: big(c) for c in ("top_rows", "bottom_rows", "positives", "top_hits", "bottom_hits", "middle_hits")}
    ).withColumn("normalized_score", F.round("normalized_score", 6))


@check(
    "score_histogram",
    f"""WITH {SALES}, b AS (SELECT y, LEAST(floor(p * 20), 19)::INTEGER AS bin FROM s)
       SELECT y, bin, bin / 20 AS low, COUNT(*) AS n, ROUND(COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY y), 6) AS share,
              ROUND(COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY y) * 20, 6) AS density FROM b GROUP BY y, bin""",
)
def score_histogram(t):
    return evaluate.score_histogram(sales(t), "y", "p").withColumns({c: F.round(c, 6) for c in ("share", "density")})


@check(
    "score_boxes",
    f"""WITH {SCORED} SELECT lang, ROUND(MIN(p), 6) AS minimum, ROUND(quantile_cont(p, 0.25), 6) AS q1, ROUND(median(p), 6) AS median,
              ROUND(quantile_cont(p, 0.75), 6) AS q3, ROUND(MAX(p), 6) AS maximum, ROUND(AVG(p), 6) AS mean, COUNT(p) AS n FROM s GROUP BY lang""",
)
def score_boxes(t):
    return evaluate.score_boxes(scored(t), "lang", "p").withColumns(
        {c: F.round(c, 6) for c in ("minimum", "q1", "median", "q3", "maximum", "mean")}
    )


# -- contributions, from a linear model of the lines -----------------------------------

LINEAR = """x AS (SELECT l_orderkey * 8 + l_linenumber AS k, l_partkey, l_suppkey, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, l_quantity / 100 AS a, -l_discount AS b, l_tax * 2 AS c FROM lineitem),
       l AS (SELECT k, y, a + b + c AS p, 'size_quantity' AS feature, a AS s FROM x UNION ALL SELECT k, y, a + b + c, 'price_discount', b FROM x
             UNION ALL SELECT k, y, a + b + c, 'price_tax', c FROM x)"""


def linear(t):
    """(contributions, outcomes) of a fixed linear score of every line."""
    rows = t.lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate").alias("row"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        (F.col("l_quantity") / 100).alias("size_quantity"),
        (-F.col("l_discount")).alias("price_discount"),
        (F.col("l_tax") * 2).alias("price_tax"),
    )
    names = ["size_quantity", "price_discount", "price_tax"]
    long = rows.unpivot(["row"], names, "feature", "contribution")
    outcomes = rows.select("row", "y", (F.col(names[0]) + F.col(names[1]) + F.col(names[2])).alias("p"))
    return long, outcomes, rows


@check(
    "prediction_and_error",
    f"""WITH {LINEAR} SELECT feature, ROUND(AVG(abs(s)), 6) AS prediction_contribution, ROUND(AVG(abs(y - p) - abs(y - (p - s))), 6) AS error_contribution FROM l GROUP BY feature""",
)
def prediction_and_error(t):
    long, outcomes, _ = linear(t)
    out = evaluate.prediction_and_error(long, outcomes, "row", "y", "p")
    return out.select("feature", r6("prediction_contribution"), r6("error_contribution"))


@check(
    "importance_table",
    f"""WITH {LINEAR} SELECT feature, ROUND(AVG(s), 6) AS mean_contribution, ROUND(AVG(abs(s)), 6) AS mean_abs_contribution FROM l GROUP BY feature""",
)
def importance_table(t):
    return evaluate.importance_table(linear(t)[0]).select("feature", r6("mean_contribution"), r6("mean_abs_contribution"))


@check(
    "contribution_roll_up",
    f"""WITH {LINEAR}, r AS (SELECT a AS size_, b + c AS price FROM x)
       SELECT 'size_quantity' AS feature, COUNT(*) AS n, ROUND(SUM(size_), 4) AS total, ROUND(SUM(abs(size_)), 4) AS absolute FROM r
       UNION ALL SELECT 'price', COUNT(*), ROUND(SUM(price), 4), ROUND(SUM(abs(price)), 4) FROM r""",
)
def contribution_roll_up(t):
    """Children summed to the parent per row, then totalled."""
    rolled = evaluate.roll_up(linear(t)[0], "row", ["price"])
    return rolled.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("contribution"), 4).alias("total"), F.round(F.sum(F.abs("contribution")), 4).alias("absolute")
    )


@check(
    "contribution_classes",
    f"""WITH {LINEAR} SELECT 'numerical' AS class, COUNT(*) AS n, ROUND(SUM(a + b + c), 4) AS total FROM x""",
)
def contribution_classes(t):
    from tideline.operators import profile

    long, _, rows = linear(t)
    classes = profile.profile(rows).select("column", F.col("feature_class").alias("class"))
    rolled = evaluate.roll_up_classes(long, "row", classes)
    return rolled.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("contribution"), 4).alias("total"))


@check(
    "contribution_values",
    f"""WITH {LINEAR} SELECT 'price_tax' AS feature, c::VARCHAR AS value, COUNT(*) AS n, ROUND(SUM(c), 4) AS total FROM x GROUP BY c""",
)
def contribution_values(t):
    long, _, rows = linear(t)
    table = evaluate.contribution_values(long, rows, "row", ["price_tax", "absent"])
    return table.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("contribution"), 4).alias("total"))


@check(
    "importance_diff",
    """WITH a AS (SELECT p_type AS f, AVG(p_size) AS i FROM part WHERE p_retailprice < 1000 GROUP BY 1), b AS (SELECT p_type AS f, AVG(p_size) AS i FROM part WHERE p_size > 10 AND p_type <> 'PROMO' GROUP BY 1)
       SELECT COALESCE(a.f, b.f) AS feature, ROUND(a.i, 6) AS left_importance, ROUND(b.i, 6) AS right_importance, ROUND(abs(a.i - b.i), 6) AS gap FROM a FULL JOIN b ON a.f = b.f""",
)
def importance_diff(t):
    def table(rows):
        return rows.groupBy(F.col("p_type").alias("feature")).agg(F.avg("p_size").alias("importance"))

    out = diff.importance_differences(table(t.part.where("p_retailprice < 1000")), table(t.part.where("p_size > 10 AND p_type <> 'PROMO'")))
    return out.select("feature", r6("left_importance"), r6("right_importance"), r6("gap"))


@check(
    "prediction_agreement",
    f"""WITH {SCORED} SELECT COUNT(*) AS n_rows, ROUND(AVG(CASE WHEN (p >= 0.05) = (p >= 0.2) THEN 1 ELSE 0 END), 6) AS match_ratio FROM s""",
)
def prediction_agreement(t):
    rows = scored(t)
    a, b = (rows.select("doc_id", evaluate.hard_label(F.col("p"), x).alias("called")) for x in (0.05, 0.2))
    return diff.agreement(a, b, "doc_id", "called").select("n_rows", r6("match_ratio"))


# -- neighbours ---------------------------------------------------------------------------

POINTS = "p AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, CASE WHEN label < 3 THEN 1 ELSE 0 END AS y FROM embeddings)"


def near_sql(k: int, left: str = "p", right: str = "p", name: str = "nn", other: str = "a.id <> b.id") -> str:
    return f"""{name} AS (SELECT id, nb, d, r FROM (SELECT a.id, b.id AS nb, list_distance(a.v, b.v) AS d,
       row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.v, b.v), b.id) AS r FROM {left} a JOIN {right} b ON {other}) WHERE r <= {k})"""


def points(t):
    return t.embeddings.select("vec_id", "embedding", (F.col("label") < 3).cast("int").alias("y"))


@check("knn_exact", f"WITH {POINTS}, {near_sql(5)} SELECT id, nb AS neighbour, ROUND(d, 6) AS distance, CAST(r AS INTEGER) AS rank FROM nn")
def knn_exact(t):
    near = neighbours.nearest_neighbours(t.embeddings, "vec_id", "embedding", 5)
    return near.select("id", "neighbour", r6("distance"), "rank")


@check("knn_pruned", f"WITH {POINTS}, {near_sql(3)} SELECT id, nb AS neighbour, ROUND(d, 6) AS distance, CAST(r AS INTEGER) AS rank FROM nn")
def knn_pruned(t):
    """The same search over several cells and blocks."""
    near = neighbours.nearest_neighbours(t.embeddings, "vec_id", "embedding", 3, block_rows=64, pivots=6)
    return near.select("id", "neighbour", r6("distance"), "rank")


@check(
    "label_degree",
    f"""WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
       d AS (SELECT i, stddev_pop(x) AS s FROM e GROUP BY i),
       p AS (SELECT vec_id AS id, list(x / (4 * s) ORDER BY i) AS v FROM e JOIN d USING (i) GROUP BY vec_id),
       y AS (SELECT vec_id AS id, CASE WHEN label < 3 THEN 1 ELSE 0 END AS y FROM embeddings), {near_sql(5)},
       c AS (SELECT nn.id, SUM(b.y)::BIGINT AS positives, abs(5 * MAX(a.y) - SUM(b.y))::BIGINT AS disagreeing FROM nn JOIN y a ON nn.id = a.id JOIN y b ON nn.nb = b.id GROUP BY nn.id)
       SELECT id, positives, disagreeing, CASE disagreeing WHEN 5 THEN 0.1 WHEN 4 THEN 0.25 WHEN 3 THEN 0.4 WHEN 2 THEN 0.6 WHEN 1 THEN 0.8 ELSE 1 END::DOUBLE AS degree FROM c""",
)
def label_degree(t):
    out = neighbours.label_degree(points(t), "vec_id", "embedding", "y")
    return out.select("id", big("positives"), big("disagreeing"), "degree")


LOF_SQL = """kd AS (SELECT id, MAX(d) AS k FROM nn GROUP BY id),
       ld AS (SELECT nn.id, 1 / (AVG(GREATEST(d, k)) + 1e-10) AS l FROM nn JOIN kd ON nn.nb = kd.id GROUP BY nn.id),
       lf AS (SELECT nn.id, -AVG(b.l) / MAX(a.l) AS f FROM nn JOIN ld a ON nn.id = a.id JOIN ld b ON nn.nb = b.id GROUP BY nn.id)"""


@check("lof", f"WITH {POINTS}, {near_sql(10)}, {LOF_SQL} SELECT id, ROUND(tanh(f), 6) AS lof FROM lf")
def lof(t):
    return neighbours.outlier_factor(t.embeddings, "vec_id", "embedding", 10, "tanh").select("id", r6("lof"))


@check(
    "lof_novelty",
    f"""WITH p AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings WHERE label < 5), q AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings WHERE label >= 5),
       {near_sql(10)}, {LOF_SQL}, {near_sql(10, "q", "p", "nq")},
       dq AS (SELECT nq.id, 1 / (AVG(GREATEST(d, k)) + 1e-10) AS l FROM nq JOIN kd ON nq.nb = kd.id GROUP BY nq.id)
       SELECT nq.id, ROUND(-AVG(ld.l) / MAX(dq.l) - (SELECT quantile_cont(f, 0.3) FROM lf), 6) AS lof FROM nq JOIN ld ON nq.nb = ld.id JOIN dq ON nq.id = dq.id GROUP BY nq.id""",
)
def lof_novelty(t):
    fitted, new = t.embeddings.where("label < 5"), t.embeddings.where("label >= 5")
    return neighbours.novelty_factor(fitted, new, "vec_id", "embedding", 10, 0.3).select("id", r6("lof"))


# -- resampling -----------------------------------------------------------------------------

SIZES = "z AS (SELECT CAST(SUM(y) AS BIGINT) AS a, CAST(COUNT(*) - SUM(y) AS BIGINT) AS b FROM p)"
MINORITY = "m AS (SELECT * FROM p WHERE y = 1)"
# Draws of (id, copies) in table c, using the minority neighbours nm.
DRAWS = """d AS (SELECT id, CAST(unnest(range(1, n + 1)) AS BIGINT) AS draw FROM c),
       h AS (SELECT id, draw, md5(id || '|' || draw || '|42') AS h FROM d),
       g AS (SELECT id, draw, ('0x' || substr(h, 1, 8))::BIGINT % 5 + 1 AS r, ('0x' || substr(h, 9, 8))::BIGINT / 4294967296.0 AS u FROM h)
       SELECT g.id, g.draw, nb AS neighbour, ROUND(a.v[1] + u::DOUBLE * (b.v[1] - a.v[1]), 6) AS first, ROUND(a.v[64] + u::DOUBLE * (b.v[64] - a.v[64]), 6) AS last
       FROM g JOIN nm ON g.id = nm.id AND g.r = nm.r JOIN p a ON g.id = a.id JOIN p b ON nm.nb = b.id"""
EVEN = "c AS (SELECT id, (b - a) // t + CASE WHEN row_number() OVER (ORDER BY md5(id || '|42')) <= (b - a) % t THEN 1 ELSE 0 END AS n FROM {rows}, z, (SELECT COUNT(*) AS t FROM {rows}))"


def synthetic(rows):
    return rows.select(
        "id", big("draw"), "neighbour", r6(F.col("vector")[0], "first"), r6(F.col("vector")[63], "last")
    )


@check("smote", f"WITH {POINTS}, {SIZES}, {MINORITY}, {near_sql(5, 'm', 'm', 'nm')}, {EVEN.format(rows='m')}, {DRAWS}")
def smote(t):
    return synthetic(resample.smote(points(t), "vec_id", "embedding", "y"))


@check(
    "borderline_smote",
    f"""WITH {POINTS}, {SIZES}, {MINORITY}, {near_sql(10)}, {near_sql(5, 'm', 'm', 'nm')},
       k AS (SELECT nn.id FROM nn JOIN p a ON nn.id = a.id AND a.y = 1 JOIN p b ON nn.nb = b.id GROUP BY nn.id HAVING 2 * SUM(1 - b.y) >= 10 AND SUM(1 - b.y) < 10),
       {EVEN.format(rows='k')}, {DRAWS}""",
)
def borderline_smote(t):
    return synthetic(resample.borderline_smote(points(t), "vec_id", "embedding", "y"))


@check(
    "adasyn",
    f"""WITH {POINTS}, {SIZES}, {MINORITY}, {near_sql(5)}, {near_sql(5, 'm', 'm', 'nm')},
       k AS (SELECT nn.id, AVG(1 - b.y) AS w FROM nn JOIN p a ON nn.id = a.id AND a.y = 1 JOIN p b ON nn.nb = b.id GROUP BY nn.id),
       c AS (SELECT id, CAST(ROUND(w / (SELECT SUM(w) FROM k) * (b - a)) AS BIGINT) AS n FROM k, z), {DRAWS}""",
)
def adasyn(t):
    return synthetic(resample.adasyn(points(t), "vec_id", "embedding", "y"))


# A differing category counts as much as the median of the minority's deviations.
MIXED = """e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings WHERE label < 3),
       w AS (SELECT median(s) AS w FROM (SELECT stddev_samp(x) AS s FROM e GROUP BY i)), l AS (SELECT vec_id AS id, 'g' || label AS kind FROM embeddings),
       nm AS (SELECT id, nb, r FROM (SELECT a.id, b.id AS nb, row_number() OVER (PARTITION BY a.id ORDER BY sqrt(power(list_distance(a.v, b.v), 2) + CASE WHEN x.kind <> y.kind THEN w * w ELSE 0 END), b.id) AS r
              FROM m a JOIN m b ON a.id <> b.id JOIN l x ON x.id = a.id JOIN l y ON y.id = b.id, w) WHERE r <= 5),
       k AS (SELECT id, kind FROM (SELECT nm.id, l.kind, row_number() OVER (PARTITION BY nm.id ORDER BY COUNT(*) DESC, l.kind) AS r FROM nm JOIN l ON l.id = nm.nb GROUP BY nm.id, l.kind) WHERE r = 1)"""


@check("smote_nc", f"WITH {POINTS}, {SIZES}, {MINORITY}, {MIXED}, {EVEN.format(rows='m')}, {DRAWS.replace('SELECT g.id', 'SELECT kind, g.id')} JOIN k ON k.id = g.id")
def smote_nc(t):
    """Synthetic rows whose category is the neighbours' most frequent one."""
    rows = points(t).join(t.embeddings.select("vec_id", F.concat(F.lit("g"), F.col("label").cast("string")).alias("kind")), "vec_id")
    out = resample.smote_nc(rows, "vec_id", "embedding", "y", ["kind"])
    return synthetic(out).join(out.select("id", "draw", "kind"), ["id", "draw"])


LINKS = f"""WITH {POINTS}, {near_sql(1)}, t AS (SELECT n.id, n.nb, a.y FROM nn n JOIN nn o ON n.nb = o.id AND o.nb = n.id JOIN p a ON n.id = a.id JOIN p b ON n.nb = b.id WHERE a.y <> b.y)"""


@check("tomek", f"{LINKS} SELECT id, nb AS neighbour, y AS label FROM t")
def tomek(t):
    return resample.tomek_links(points(t), "vec_id", "embedding", "y").select("id", "neighbour", "label")


@check("tomek_removed", f"{LINKS} SELECT id AS vec_id, y FROM p WHERE id NOT IN (SELECT id FROM t WHERE y = 0)")
def tomek_removed(t):
    return resample.resample(points(t), "TomekLinks", "vec_id", "embedding", "y").select("vec_id", "y")


@check(
    "enn",
    f"""WITH {POINTS}, {near_sql(3)} SELECT id AS vec_id, y FROM p WHERE y = 1 OR id NOT IN (SELECT nn.id FROM nn JOIN p b ON nn.nb = b.id WHERE b.y = 1)""",
)
def enn(t):
    return resample.resample(points(t), "EditedNearestNeighbours", "vec_id", "embedding", "y").select("vec_id", "y")


@check(
    "all_knn",
    f"""WITH {POINTS}, {near_sql(3)}, c AS (SELECT nn.id, i, SUM(b.y) AS w FROM nn JOIN p b ON nn.nb = b.id, (SELECT unnest([1, 2, 3]) AS i) WHERE nn.r <= i GROUP BY nn.id, i)
       SELECT id AS vec_id, y FROM p WHERE y = 1 OR id NOT IN (SELECT id FROM c WHERE 2 * w > i)""",
)
def all_knn(t):
    return resample.resample(points(t), "AllKNN", "vec_id", "embedding", "y", kind="mode").select("vec_id", "y")


@check(
    "neighbourhood_cleaning",
    f"""WITH {POINTS}, {near_sql(11)}, w AS (SELECT nn.id, a.y, SUM(CASE WHEN a.y <> b.y THEN 1 ELSE 0 END) AS o FROM nn JOIN p a ON nn.id = a.id JOIN p b ON nn.nb = b.id GROUP BY nn.id, a.y),
       g AS (SELECT id FROM w WHERE 2 * o > 11 AND y = 0 UNION SELECT nn.nb FROM nn JOIN w ON nn.id = w.id AND w.y = 1 AND 2 * w.o > 11 JOIN p b ON nn.nb = b.id AND b.y = 0)
       SELECT id AS vec_id, y FROM p WHERE id NOT IN (SELECT id FROM g)""",
)
def neighbourhood_cleaning(t):
    return resample.resample(points(t), "NeighbourhoodCleaningRule", "vec_id", "embedding", "y").select("vec_id", "y")


@check(
    "one_sided_selection",
    f"""WITH {POINTS}, s AS (SELECT id FROM p WHERE y = 0 ORDER BY md5(id || '|42') LIMIT 1), k AS (SELECT * FROM p WHERE y = 1 OR id IN (SELECT id FROM s)),
       q AS (SELECT * FROM p WHERE y = 0), {near_sql(1, 'q', 'k', 'nq', 'true')},
       c AS (SELECT * FROM p WHERE id IN (SELECT id FROM k) OR id IN (SELECT nq.id FROM nq JOIN p b ON nq.nb = b.id WHERE b.y = 1)),
       {near_sql(1, 'c', 'c')}, t AS (SELECT n.id FROM nn n JOIN nn o ON n.nb = o.id AND o.nb = n.id JOIN p a ON n.id = a.id JOIN p b ON n.nb = b.id WHERE a.y = 0 AND b.y = 1)
       SELECT id AS vec_id, y FROM c WHERE id NOT IN (SELECT id FROM t)""",
)
def one_sided_selection(t):
    return resample.resample(points(t), "OneSidedSelection", "vec_id", "embedding", "y").select("vec_id", "y")


@check(
    "near_miss",
    f"""WITH {POINTS}, {MINORITY}, q AS (SELECT * FROM p WHERE y = 0), {near_sql(3, 'q', 'm', 'nq')},
       w AS (SELECT id FROM nq GROUP BY id ORDER BY AVG(d), id LIMIT (SELECT COUNT(*) FROM m)) SELECT id AS vec_id, y FROM p WHERE y = 1 OR id IN (SELECT id FROM w)""",
)
def near_miss(t):
    return resample.resample(points(t), "NearMiss", "vec_id", "embedding", "y").select("vec_id", "y")


# Every minority row is drawn (b - a) // t times, the first by hash once more.
ALL_DRAWS = """c AS (SELECT id, (b - a) // t + CASE WHEN row_number() OVER (ORDER BY md5(id || '|42')) <= (b - a) % t THEN 1 ELSE 0 END AS n FROM m, z, (SELECT COUNT(*) AS t FROM m)),
       d AS (SELECT id, CAST(unnest(range(1, n + 1)) AS BIGINT) AS draw FROM c), h AS (SELECT id, draw, md5(id || '|' || draw || '|42') AS h FROM d),
       g AS (SELECT id, draw, ('0x' || substr(h, 1, 8))::BIGINT % 5 + 1 AS r, (('0x' || substr(h, 9, 8))::BIGINT / 4294967296.0)::DOUBLE AS u FROM h),
       w AS (SELECT g.id, g.draw, list_transform(range(1, 65), lambda i: a.v[i] + u * (b.v[i] - a.v[i])) AS v
             FROM g JOIN nm ON g.id = nm.id AND g.r = nm.r JOIN p a ON g.id = a.id JOIN p b ON nm.nb = b.id)"""
BALANCED_LINKS = f"""WITH {POINTS}, {SIZES}, {MINORITY}, {near_sql(5, 'm', 'm', 'nm')}, {ALL_DRAWS},
       both_ AS (SELECT id AS k, 0::BIGINT AS draw, v, y FROM p UNION ALL SELECT id, draw, v, 1 FROM w),
       f AS (SELECT row_number() OVER (ORDER BY draw, k) AS id, k, draw, v, y FROM both_), {near_sql(1, 'f', 'f', 'n1')},
       t AS (SELECT n.id FROM n1 n JOIN n1 o ON n.nb = o.id AND o.nb = n.id JOIN f a ON n.id = a.id JOIN f b ON n.nb = b.id WHERE a.y <> b.y)"""


@check(
    "smote_tomek",
    f"{BALANCED_LINKS} SELECT y AS label, COUNT(*) AS n, COUNT(*) FILTER (draw > 0) AS synthetic FROM f WHERE id NOT IN (SELECT id FROM t) GROUP BY y",
)
def smote_tomek(t):
    out = resample.resample(points(t), "SMOTETomek", "vec_id", "embedding", "y")
    return out.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("draw") > 0).alias("synthetic"))


# -- learning ---------------------------------------------------------------------------------

NUMBERS = ["n_chars", "n_words", "n_lines", "n_digits", "n_capitals"]
FEATURES = [*NUMBERS, "lang"]


def documents(t):
    """Labelled documents with counts over their whole text."""
    body = F.col("text")
    rows = t.labels.join(t.documents, "doc_id").select(
        "doc_id",
        F.col("quality").alias("y"),
        "lang",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split(body, r"\s+")).cast("double").alias("n_words"),
        F.size(F.split(body, "\n")).cast("double").alias("n_lines"),
        F.regexp_count(body, F.lit("[0-9]")).cast("double").alias("n_digits"),
        F.regexp_count(body, F.lit("[A-Z]")).cast("double").alias("n_capitals"),
    )
    return materialize(rows, "documents")


SMALL = {"max_iter": 5, "max_depth": 3}
N_LABELLED = "(SELECT COUNT(*) FROM labels JOIN documents USING (doc_id))"


@check("gbt_score", f"SELECT {N_LABELLED} AS n_rows, 1 AS in_range, 1 AS better_than_chance")
def gbt_score(t):
    """Boosted trees fitted on the training split and applied to every row."""
    rows = documents(t)
    train, _ = sampling.train_test(rows, "doc_id")
    out = materialize(learn.score(learn.fit_boosted(train, FEATURES, "y", **SMALL), rows), "scored")
    auc = evaluate.roc_auc(out, "y", "probability_1").select("roc_auc").scalar()
    p = F.col("probability_1")
    return out.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(((p >= 0) & (p <= 1)).cast("int")).alias("in_range"),
        F.max((F.lit(auc) > 0.5).cast("int")).alias("better_than_chance"),
    )


@check(
    "contributions",
    f"SELECT {N_LABELLED} AS n_rows, {N_LABELLED} * {len(FEATURES)} AS n_cells, 0.0::DOUBLE AS gap",
)
def contributions(t):
    """Bias plus contributions give back the model's probability on every row."""
    rows = documents(t)
    model = learn.fit_boosted(rows, FEATURES, "y", **SMALL)
    long = learn.contributions(model, rows, "doc_id")
    raw = long.groupBy("doc_id").agg((F.sum("contribution") + F.max("bias")).alias("raw"), F.count(F.lit(1)).alias("n"))
    both = learn.score(model, rows).join(raw, "doc_id")
    gap = F.abs(F.col("probability_1") - 1 / (1 + F.exp(-2 * F.col("raw"))))
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n").alias("n_cells"), F.round(F.max(gap), 6).alias("gap"))


@check("model_importances")
def model_importances(t):
    rows = documents(t)
    model = learn.fit_boosted(rows, FEATURES, "y", **SMALL)
    return evaluate.importance_table(learn.contributions(model, rows, "doc_id"), learn.split_table(model, t.spark))


@check("logistic_auc")
def logistic_auc(t):
    """Weighted logistic regression, area on both splits."""
    rows = documents(t).withColumn("weight", F.when(F.col("y") == 1, 1.0).otherwise(3.0))
    train, test = sampling.train_test(rows, "doc_id")
    return learn.fit_logistic(train, test, NUMBERS, "y", "weight")[1]


@check("rfe")
def rfe(t):
    """Rounds of feature elimination."""
    train, test = sampling.train_test(documents(t), "doc_id")
    return learn.eliminate_features(train, test, "doc_id", FEATURES, "y", min_features=3, max_iter=3, max_depth=2)[1]


@check("parameter_search")
def parameter_search(t):
    """Fold scores of every drawn parameter set."""
    grid = {"max_depth": [2, 3], "max_iter": [2, 4], "positive_weight": [0.5, 1.0]}
    return learn.search(documents(t), "doc_id", FEATURES, "y", grid, folds=3, draws=2)[1]


@check("model_comparison")
def model_comparison(t):
    """Cross-validated scores of two learners."""
    models = {
        "shallow": lambda d: learn.fit_boosted(d, FEATURES, "y", max_iter=2, max_depth=2),
        "deeper": lambda d: learn.fit_boosted(d, FEATURES, "y", max_iter=2, max_depth=4),
    }
    return learn.compare_models(documents(t), "doc_id", "y", models, 3)


@check("repeated_evaluation")
def repeated_evaluation(t):
    """Hold-out metrics averaged over split seeds."""
    runs = learn.repeat_evaluation(
        documents(t), "doc_id", "y", lambda d: learn.fit_boosted(d, FEATURES, "y", max_iter=2, max_depth=2), [1, 2]
    )
    return evaluate.average_metrics(runs, ["accuracy", "precision", "recall", "f1", "roc_auc", "tp", "tn", "fp", "fn"])


@check("bagged_score", f"SELECT {N_LABELLED} AS n_rows, 1 AS in_range")
def bagged_score(t):
    """Mean probability over balanced bootstrap models."""
    rows = documents(t)
    models = learn.fit_bags(rows, "doc_id", FEATURES, "y", 3, max_iter=2, max_depth=2)
    p = F.col("probability_1")
    return learn.score_bags(models, rows).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(((p >= 0) & (p <= 1)).cast("int")).alias("in_range")
    )


@check("batch_scoring", f"SELECT {N_LABELLED} AS n_rows, 1 AS in_range, 0.0::DOUBLE AS gap")
def batch_scoring(t):
    """A stored model scores rows aligned to its stored schema like the fitted one."""
    import uuid

    from tideline.session import work_dir
    from tideline.sources.files import load_schema, save_schema

    rows = documents(t)
    model = learn.fit_boosted(rows, FEATURES, "y", **SMALL)
    folder = f"{work_dir(t.spark)}/tideline/models-{uuid.uuid4().hex}"
    learn.save_model(model, folder, "final_stage", "Model", SMALL)
    save_schema(rows, f"{folder}/features", FEATURES)
    stored = learn.load_model(folder, "final_stage", "Model")
    batch = learn.score_batch(stored, rows.drop("y"), load_schema(t.spark, f"{folder}/features"), "doc_id")
    both = batch.join(learn.score(model, rows).select("doc_id", "probability_1"), "doc_id")
    p = F.col("probabilities")
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(((p >= 0) & (p <= 1)).cast("int")).alias("in_range"),
        F.round(F.max(F.abs(p - F.col("probability_1"))), 6).alias("gap"),
    )
