"""Neighbour search on its large path, models without a vocabulary, exact bags, buckets, and tests with their gates."""

import uuid

from pyspark.sql import functions as F

from tideline.checks.edges import STUMP
from tideline.checks.features import PRICES, UNPIVOTED, _prices
from tideline.checks.modelling import BALANCED_LINKS, near_sql, points
from tideline.checks.registry import big, check, r6
from tideline.checks.workload import JOINED, WIDE, _base, _countries, _prepared
from tideline.operators import diff, encode, evaluate, joins, learn, neighbours, profile, resample, sampling, stats
from tideline.plans import prepare, retrieve, train
from tideline.session import materialize, work_dir
from tideline.sources import files, tables

# -- neighbours -------------------------------------------------------------------------------

ORDER_POINTS = """o AS (SELECT o_orderkey AS id, o_totalprice / 1000 AS a, date_diff('day', DATE '1992-01-01', o_orderdate::DATE)::DOUBLE / 10 AS b,
       o_orderpriority = '1-URGENT' AS urgent FROM orders)"""


def order_points(t):
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date")) / 10
    return t.orders.select(
        F.col("o_orderkey").alias("id"), F.array((F.col("o_totalprice") / 1000).cast("double"), day.cast("double")).alias("v"), "o_orderpriority"
    )


@check(
    "knn_of_urgent_orders",
    f"""WITH {ORDER_POINTS}, n AS (SELECT q.id, min_by({{'nb': d.id, 'd': sqrt((q.a - d.a) * (q.a - d.a) + (q.b - d.b) * (q.b - d.b))}},
              {{'d': sqrt((q.a - d.a) * (q.a - d.a) + (q.b - d.b) * (q.b - d.b)), 'id': d.id}}, 3) AS near FROM o q, o d WHERE q.urgent AND NOT d.urgent GROUP BY q.id)
       SELECT id, unnest(near).nb AS neighbour, ROUND(unnest(near).d, 6) AS distance, unnest(range(1, 4))::INTEGER AS rank FROM n""",
)
def knn_of_urgent_orders(t):
    """The three other orders that are nearest in price and date to every urgent one, over several rings with default settings."""
    rows = order_points(t)
    urgent = F.col("o_orderpriority") == "1-URGENT"
    near = neighbours.nearest_neighbours(rows.where(~urgent), "id", "v", 3, rows.where(urgent))
    return near.select("id", "neighbour", r6("distance"), "rank")


@check("lsh_recall", "SELECT COUNT(*) * 5 AS wanted, 1 AS recall_at_least_90 FROM embeddings")
def lsh_recall(t):
    """How many of the exact five nearest the random-projection search finds."""
    exact = neighbours.nearest_neighbours(t.embeddings, "vec_id", "embedding", 5)
    found = neighbours.lsh_neighbours(t.embeddings, "vec_id", "embedding", 5, tables=48, bits=5)
    share = neighbours.recall(found, exact)
    return share.select("wanted", (F.col("recall") >= 0.9).cast("int").alias("recall_at_least_90"))


@check(
    "voted_degree",
    f"""WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i, label FROM embeddings),
       d AS (SELECT i, stddev_pop(x) AS s FROM e WHERE label < 5 GROUP BY i),
       v AS (SELECT vec_id AS id, list(x / (4 * s) ORDER BY i) AS v, label FROM e JOIN d USING (i) GROUP BY vec_id, label),
       p AS (SELECT id, v, CASE WHEN label < 3 THEN 1 ELSE 0 END AS y FROM v WHERE label < 5), q AS (SELECT id, v FROM v WHERE label >= 5),
       {near_sql(5, "q", "p", "nq", "true")}, c AS (SELECT nq.id, SUM(p.y)::BIGINT AS positives FROM nq JOIN p ON nq.nb = p.id GROUP BY nq.id)
       SELECT id, positives, CASE LEAST(positives, 5 - positives) WHEN 2 THEN 0.6 WHEN 1 THEN 0.8 ELSE 1 END::DOUBLE AS degree FROM c""",
)
def voted_degree(t):
    """The degree of rows of unknown label against the labelled ones."""
    known, new = t.embeddings.where("label < 5"), t.embeddings.where("label >= 5")
    out = neighbours.voted_degree(known.withColumn("y", (F.col("label") < 3).cast("int")), new, "vec_id", "embedding", "y")
    return out.select("id", big("positives"), "degree")


# -- resampling -------------------------------------------------------------------------------

@check("smote_tomek_rows", f"{BALANCED_LINKS} SELECT k AS id, draw, y AS label FROM f WHERE id NOT IN (SELECT id FROM t)")
def smote_tomek_rows(t):
    """Which original and synthetic rows are left after both rows of every link went."""
    out = resample.resample(points(t), "SMOTETomek", "vec_id", "embedding", "y")
    return out.select("id", big("draw"), "label")


# -- models without a vocabulary --------------------------------------------------------------


@check(
    "category_per_row_model",
    f"""{WIDE}, b AS (SELECT * FROM placed {JOINED}), s AS (SELECT AVG((s = 'F')::INT) AS a FROM b)
       SELECT deal_id, course_id, ROUND(1 / (1 + exp(-2 * CASE WHEN s = 'F' THEN 1 ELSE -1 END)), 6) AS p FROM b""",
)
def category_per_row_model(t):
    """A stage model with a text of its own in every row, through the plan: nothing is listed, and one split separates the classes."""
    base = _base(t)
    ready = _prepared(t, ["deal_id", "course_id"], base)
    keys = base.select("deal_id", "course_id", F.xxhash64("deal_id", "course_id").alias("row"), F.concat_ws(":", "deal_id", "course_id").alias("pair"))
    # Each side is written: two columns of a wide table look smaller than they are, and would be broadcast.
    labels, keys = materialize(ready.select("row", "target"), "labels"), materialize(keys.distinct(), "keys")
    rows = materialize(labels.join(keys, "row"), "rows")
    settings = train.TrainingSettings(test_ratio=0, tune=False, eliminate=False, fixed=STUMP)
    model = train.fit_stage(rows, "row", "target", "final_stage", ["pair"], settings)
    return model.score(rows).select("deal_id", "course_id", r6("probability_1", "p"))


@check(
    "sparse_logistic",
    """WITH s AS (SELECT (o_orderstatus = 'F')::INT AS y FROM orders), v AS (SELECT DISTINCT o_custkey || '-' || o_orderkey AS v FROM orders UNION SELECT DISTINCT o_orderpriority FROM orders)
       SELECT COUNT(*) AS n_rows, (SELECT COUNT(*) + 1 FROM v)::INTEGER AS width, ROUND(AVG(y), 3) AS mean_probability FROM s""",
)
def sparse_logistic(t):
    """A linear model on sparse vectors with a place for every row's own category: its mean probability is the share of positives."""
    rows = t.orders.select(
        "o_orderkey", F.concat_ws("-", "o_custkey", "o_orderkey").alias("clerk"), "o_orderpriority",
        (F.col("o_totalprice") / 500_000).alias("price"), (F.col("o_orderstatus") == "F").cast("int").alias("y"),
    )
    places = materialize(encode.fit_places(encode.vocabularies(rows, ["clerk", "o_orderpriority"])), "places")
    vectors = materialize(encode.sparse_vectors(rows, "o_orderkey", ["price"], places, ["clerk", "o_orderpriority"]), "vectors")
    model = learn.fit_sparse_logistic(vectors, "y", max_iter=100)
    return learn.score_vectors(model, vectors).agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(model.numFeatures).alias("width"), F.round(F.avg("probability_1"), 3).alias("mean_probability")
    )


@check(
    "prepared_places",
    f"""{WIDE}, b AS (SELECT * FROM placed {JOINED})
       SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (s = 'F') AS won, COUNT(*) FILTER (c_acctbal > 1000) AS price_reason, COUNT(*) FILTER (c_acctbal > 8000) AS with_industry,
              (SELECT COUNT(DISTINCT vertical_name) + MAX((vertical_name IS NULL)::INT) FROM b)::BIGINT AS verticals FROM b""",
)
def prepared_places(t):
    """The prepared table without a column per category: places in a table, popularities, label codes; stored and read back."""
    base = _base(t)
    folder = f"{work_dir(t.spark)}/tideline/{t.spark.sparkContext.applicationId}/state-{uuid.uuid4().hex}"
    prepare.fit(base, _countries(t), wide=False, career=True, codes=True).save(t.spark, folder)
    state = prepare.FittedState.load(t.spark, folder)
    ready = materialize(prepare.apply(base, state, _countries(t), ["deal_id", "course_id"]), "ready")
    places = state.tables["places"]
    price = places.where((F.col("column") == "reason_to_buy_short") & (F.col("value") == "Price (add notes)")).select(F.max("place")).scalar()
    verticals = places.where(F.col("column") == "vertical_name").select(F.count(F.lit(1))).scalar()
    return ready.agg(
        F.count(F.lit(1)).alias("n_rows"),
        big(F.sum("target"), "won"),
        F.count_if(F.array_contains("encoded", price)).alias("price_reason"),
        F.count("industry_popularity_all").alias("with_industry"),
        F.max(verticals).alias("verticals"),
    )


ENCODED = {
    "intake": "CASE WHEN p_size % 3 = 0 THEN 'Fall' ELSE 'Spring' END",
    "delivery_format": "CASE WHEN p_size % 2 = 0 THEN 'offline' ELSE '_NA_' END",
    "vertical_name": "COALESCE(replace(vertical_name, ' ', '_'), '_NA_')",
    "source_of_awareness_onboarding": "CASE WHEN c_acctbal > 5500 THEN 'google' ELSE 'unknown' END",
    "industry_enrichment": "CASE WHEN c_acctbal > 6000 THEN c_mktsegment ELSE '_NA_' END",
    "current_position_job_type": "CASE WHEN c_acctbal > 0 THEN 'True' ELSE '_NA_' END",
    "previous_position_job_type": "CASE WHEN c_acctbal > 7000 THEN 'False' ELSE '_NA_' END",
    "reason_to_buy_short": "unnest(CASE WHEN c_acctbal > 1000 THEN [c_mktsegment, 'Price'] ELSE [] END)",
}


@check(
    "prepared_categories",
    f"""{WIDE}, b AS (SELECT * FROM placed {JOINED.replace('WHERE', 'JOIN part ON p_partkey = course_id WHERE')}), n AS ("""
    + " UNION ALL ".join(f"SELECT '{c}_' || {value} AS n FROM b" if "unnest" not in value else f"SELECT '{c}_' || x AS n FROM (SELECT {value} AS x FROM b)" for c, value in ENCODED.items())
    + """) SELECT n AS "column", COUNT(*) AS total FROM n GROUP BY n""",
)
def prepared_categories(t):
    """How many rows have each category and list item, from the wide columns of the prepared table."""
    ready = _prepared(t)
    names = [c for c in ready.columns if c.startswith(tuple(f"{e}_" for e in ENCODED))]
    sums = ready.agg(*[F.sum(F.col(f"`{c}`")).cast("long").alias(f"s{i}") for i, c in enumerate(names)])
    return sums.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"s{i}").alias("total")) for i, c in enumerate(names)])))


@check(
    "stage_model_scores",
    f"""{WIDE}, b AS (SELECT (s = 'F')::INT AS y, (p_type = 'STANDARD')::INT AS x FROM placed {JOINED.replace('WHERE', 'JOIN part ON p_partkey = course_id WHERE')}),
       g AS (SELECT x, SUM(y) AS a, SUM(1 - y) AS n, AVG(y) AS leaf FROM b GROUP BY x),
       r AS (SELECT SUM(a.a * b.n * CASE WHEN a.leaf > b.leaf THEN 1 WHEN a.leaf = b.leaf THEN 0.5 ELSE 0 END) / (SUM(a.a) * SUM(b.n) / COUNT(DISTINCT b.x) / COUNT(DISTINCT a.x)) AS auc FROM g a, g b)
       SELECT stage, 1 AS n_features, ROUND(auc, 6) AS roc_auc FROM r, (VALUES ('init_stage'), ('mid_stage'), ('final_stage')) v(stage)""",
)
def stage_model_scores(t):
    """One model of one split per lifecycle stage, from the annotated profile to the area."""
    ready = _prepared(t, ["deal_id", "course_id"])
    name = F.col("column")
    table = prepare.updated_profile(ready.drop("row"), None).withColumns(
        {"stage": F.when(name == "type_Full_Time", 1).otherwise(0), "In use": name.isin("type_Full_Time", "target")}
    )
    settings = train.TrainingSettings(test_ratio=0, tune=False, eliminate=False, fixed=STUMP)
    models = train.fit_all(ready, materialize(table, "annotated"), "row", "target", settings)
    parts = []
    for stage, model in models.items():
        area = evaluate.roc_auc(model.score(ready), "target", "probability_1")
        parts.append(area.select(F.lit(stage).alias("stage"), F.lit(len(model.features)).alias("n_features"), r6("roc_auc")))
    return joins.union_all(parts)


@check(
    "elimination_of_noise",
    """WITH s AS (SELECT l_orderkey * 8 + l_linenumber AS k, (l_quantity > 25)::INT AS a, CASE WHEN l_linenumber % 7 = 0 THEN 1 - (l_quantity > 25)::INT ELSE (l_quantity > 25)::INT END AS y FROM lineitem),
       d AS (SELECT * FROM s WHERE substr(md5(CAST(k AS VARCHAR) || '|42'), 1, 8) < '33333334'),
       f AS (SELECT ROUND(2 * COUNT(*) FILTER (a = 1 AND y = 1) / (COUNT(*) FILTER (a = 1) + COUNT(*) FILTER (y = 1)), 6) AS f1 FROM d)
       SELECT round, n_features, f1, true AS accepted FROM f, (VALUES (0::INTEGER, 3::INTEGER), (1::INTEGER, 1::INTEGER)) v(round, n_features)""",
)
def elimination_of_noise(t):
    """Of three features, two of them noise, the one that carries the signal is left."""
    signal = (F.col("l_quantity") > 25).cast("int")
    rows = t.lineitem.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("long").alias("k"),
        signal.cast("double").alias("a"),
        (F.col("l_partkey") % 2).cast("double").alias("b"),
        (F.col("l_suppkey") % 2).cast("double").alias("c"),
        F.when(F.col("l_linenumber") % 7 == 0, 1 - signal).otherwise(signal).alias("y"),
    )
    fitted, test = sampling.train_test(rows, "k")
    _, rounds = learn.eliminate_features(fitted, test, "k", ["a", "b", "c"], "y", min_features=1, **STUMP)
    return rounds.select("round", "n_features", r6("f1"), "accepted")


# -- bags --------------------------------------------------------------------------------------


@check(
    "exact_bag_sizes",
    """WITH n AS (SELECT o_orderstatus AS status, COUNT(*) AS n FROM orders GROUP BY 1), b AS (SELECT unnest(range(0, 5))::INTEGER AS bag)
       SELECT bag, status, CASE WHEN n = (SELECT MAX(n) FROM n) THEN n ELSE (SELECT MIN(n) FROM n) END AS draws FROM n, b""",
)
def exact_bag_sizes(t):
    """Draws of every class in every bag, three classes, all but the largest brought down to the smallest."""
    drawn = sampling.bootstrap(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderkey", 5, 42, "o_orderstatus", "not majority")
    return drawn.groupBy("bag", F.col("o_orderstatus").alias("status")).agg(big(F.sum("weight"), "draws"))


@check("forest_of_bags", "SELECT COUNT(*) AS n_rows, 0.0::DOUBLE AS gap FROM labels JOIN documents USING (doc_id)")
def forest_of_bags(t):
    """Forty bags scored in one pass agree with the mean of forty models scored one after the other."""
    rows = materialize(
        t.labels.join(t.documents, "doc_id").select("doc_id", F.col("quality").alias("y"), "lang", "source", F.col("n_chars").cast("double").alias("n_chars")),
        "documents",
    )
    models = learn.fit_bags(rows, "doc_id", ["n_chars", "lang", "source"], "y", 40, shared=["source"], max_iter=1, max_depth=2)
    at_once = learn.score_bags(models, rows, "p")
    apart, names = rows.select("doc_id", "lang", "source", "n_chars"), [f"p{i}" for i in range(len(models))]
    # The forest against the models of the library, a block of them per plan.
    parts = []
    for start in range(0, len(models), 8):
        block = apart
        for i in range(start, min(start + 8, len(models))):
            block = learn.score(models[i], block, names[i])
        parts.append(materialize(block.select("doc_id", *names[start : start + 8]), "block"))
    both = at_once.select("doc_id", "p")
    for part in parts:
        both = both.join(part, "doc_id")
    mean = sum((F.col(n) for n in names), F.lit(0.0)) / len(names)
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.max(F.abs(F.col("p") - mean)), 6).alias("gap"))


# -- tests with their gates ------------------------------------------------------------------------

# At the level of 0.05: 1.358102 is the limit of the scaled largest gap, 1.959964 that of a normal deviate,
# 3.841459 that of a chi-square of one degree of freedom.
MOMENTS_SQL = """m AS (SELECT c, COUNT(*) FILTER (y = 0) AS n0, COUNT(*) FILTER (y = 1) AS n1, AVG(x) FILTER (y = 0) AS m0, AVG(x) FILTER (y = 1) AS m1,
              var_samp(x) FILTER (y = 0) AS v0, var_samp(x) FILTER (y = 1) AS v1 FROM u GROUP BY c),
       tt AS (SELECT c, n0, n1, (m0 - m1) / sqrt(((n0 - 1) * v0 + (n1 - 1) * v1) / (n0 + n1 - 2) * (1.0 / n0 + 1.0 / n1)) AS t FROM m)"""
GATES_SQL = f"""{MOMENTS_SQL},
       g AS (SELECT c, x, COUNT(*) FILTER (y = 0) AS a, COUNT(*) FILTER (y = 1) AS b FROM u GROUP BY c, x),
       k AS (SELECT c, abs(SUM(a) OVER w / SUM(a) OVER (PARTITION BY c) - SUM(b) OVER w / SUM(b) OVER (PARTITION BY c)) AS d FROM g WINDOW w AS (PARTITION BY c ORDER BY x ROWS UNBOUNDED PRECEDING)),
       ks AS (SELECT c, MAX(d) AS d FROM k GROUP BY c),
       zz AS (SELECT c, y, abs(x - median(x) OVER (PARTITION BY c, y)) AS z FROM u), lm AS (SELECT c, y, COUNT(*) AS n, AVG(z) AS m, var_pop(z) AS v FROM zz GROUP BY c, y),
       lg AS (SELECT c, SUM(n) AS n, SUM(n * m) / SUM(n) AS g, SUM(n * v) AS w FROM lm GROUP BY c),
       lv AS (SELECT lg.c, (MAX(lg.n) - 2) * SUM(lm.n * power(lm.m - lg.g, 2)) / MAX(lg.w) AS f FROM lg JOIN lm USING (c) GROUP BY lg.c)"""


@check(
    "gated_t_test_shown",
    f"""WITH r AS (SELECT l_extendedprice, l_quantity, l_discount, CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 END AS y FROM lineitem WHERE l_returnflag IN ('R', 'A')),
       u AS (SELECT 'l_quantity' AS c, l_quantity AS x, y FROM r UNION ALL SELECT 'shifted', l_quantity + 20 * y, y FROM r
             UNION ALL SELECT 'widened', CASE WHEN y = 1 THEN 25 + (l_quantity - 25) * 3 ELSE l_quantity END, y FROM r), {GATES_SQL}
       SELECT tt.c AS "column", CASE WHEN d * sqrt(n0 * n1 / (n0 + n1)) >= 1.358102 THEN 'N/A (different distributions)' WHEN f >= 3.841459 THEN 'N/A (unequal variances)' END AS withheld,
              CASE WHEN d * sqrt(n0 * n1 / (n0 + n1)) < 1.358102 AND f < 3.841459 THEN ROUND(t, 6) END AS t_statistic,
              CASE WHEN d * sqrt(n0 * n1 / (n0 + n1)) < 1.358102 AND f < 3.841459 THEN abs(t) > 1.959964 END AS significant FROM tt JOIN ks USING (c) JOIN lv USING (c)""",
)
def gated_t_test_shown(t):
    """Which t-tests the gates let through, their value, and whether they are significant."""
    rows = _prices(t).where(F.col("y").isNotNull())
    rows = rows.select(
        "y", "l_quantity", (F.col("l_quantity") + 20 * F.col("y")).alias("shifted"),
        F.when(F.col("y") == 1, 25 + (F.col("l_quantity") - 25) * 3).otherwise(F.col("l_quantity")).alias("widened"),
    )
    out = stats.gated_t_test(rows, "y", gated=True, explain=True)
    value, p = F.col("t_statistic").try_cast("double"), F.col("p_value").try_cast("double")
    return out.select("column", F.when(value.isNull(), F.col("t_statistic")).alias("withheld"), r6(value, "t_statistic"), (p < 0.05).alias("significant"))


@check(
    "profile_significance",
    f"""WITH {PRICES}, {UNPIVOTED}, {MOMENTS_SQL},
       x AS (SELECT l_linestatus AS v, CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 END AS y, COUNT(*) AS o FROM lineitem WHERE l_returnflag IN ('R', 'A') GROUP BY ALL),
       e AS (SELECT o, SUM(o) OVER (PARTITION BY v) * SUM(o) OVER (PARTITION BY y) / SUM(o) OVER () AS e, (SELECT COUNT(DISTINCT v) - 1 FROM x) AS dof FROM x),
       chi AS (SELECT SUM(CASE WHEN dof = 1 THEN power(abs(o - e) - LEAST(0.5, abs(o - e)), 2) / e ELSE power(o - e, 2) / e END) AS chi, MAX(dof) AS dof FROM e)
       SELECT c AS "column", ROUND(t, 6) AS t_statistic, NULL::DOUBLE AS chi_square, NULL::BIGINT AS degrees_of_freedom, CASE WHEN abs(t) > 1.959964 THEN 'Yes' ELSE 'No' END AS significance
       FROM tt WHERE c <> 'l_discount'
       UNION ALL SELECT 'l_linestatus', NULL, ROUND(CASE WHEN dof > 0 THEN chi ELSE 0 END, 6), dof, CASE WHEN dof > 0 AND chi > 3.841459 THEN 'Yes' ELSE 'No' END FROM chi""",
)
def profile_significance(t):
    """Test results in the profile, and which columns are marked."""
    y = F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "A", 0)
    rows = t.lineitem.where(F.col("l_returnflag").isin("R", "A")).select("l_extendedprice", "l_quantity", "l_linestatus", y.alias("y"))
    table = profile.profile(rows, ["l_extendedprice", "l_quantity", "l_linestatus"])
    out = profile.with_tests(table, stats.t_test(rows, "y"), stats.chi_square(rows, "y"))
    return out.select("column", r6("t_statistic"), r6("chi_square"), "degrees_of_freedom", "significance")


# -- tables ------------------------------------------------------------------------------------


@check(
    "bucketed_hand_off",
    "SELECT o_orderkey, o_totalprice, COUNT(*) AS lines FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL",
)
def bucketed_hand_off(t):
    """Two stages handed on in buckets of the deal meet without an exchange."""
    folder = f"{work_dir(t.spark)}/tideline/{t.spark.sparkContext.applicationId}"
    hand = lambda df, name: files.write_buckets(df, f"{name}_{uuid.uuid4().hex}", f"{folder}/{name}-{uuid.uuid4().hex}", ["o_orderkey"], 8)
    orders = hand(t.orders.select("o_orderkey", "o_totalprice"), "orders")
    lines = hand(t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber"), "lines")
    joined = orders.hint("merge").join(lines, "o_orderkey")
    return joined.groupBy("o_orderkey", "o_totalprice").agg(F.count(F.lit(1)).alias("lines"))


@check(
    "resolved_names",
    """SELECT o_orderstatus AS status, CASE o_orderstatus WHEN 'F' THEN 'prod_refined.deals' WHEN 'O' THEN 'refined.deals_v3' ELSE 'raw.deals_v3_latest' END AS source, COUNT(*) AS n_rows FROM orders GROUP BY ALL""",
)
def resolved_names(t):
    """Rows counted under the warehouse table each environment would read them from."""
    names = {
        "F": tables.resolve_name("refined", "deals_v3", "dev", True),
        "O": tables.resolve_name("refined", "deals_v3", "dev"),
        "P": tables.resolve_name("raw", "deals_v3_latest", "prod", True),
    }
    pairs = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return t.orders.groupBy(F.col("o_orderstatus").alias("status"), pairs[F.col("o_orderstatus")].alias("source")).agg(F.count(F.lit(1)).alias("n_rows"))


@check(
    "categorical_columns",
    """SELECT 'c_name' AS "column", COUNT(DISTINCT c_name) AS "distinct" FROM customer UNION ALL SELECT 'c_phone', COUNT(DISTINCT c_nationkey % 7) FROM customer""",
)
def categorical_columns(t):
    """The columns at the positions of plain categories, and their distinct values."""
    rows = t.customer.select("c_custkey", "c_name", "c_mktsegment", (F.col("c_nationkey") % 7).cast("string").alias("c_phone"), "c_acctbal")
    at = profile.categorical_positions(rows.schema, ["c_mktsegment"])
    return joins.union_all(
        [rows.agg(F.count_distinct(rows.columns[i]).alias("distinct")).select(F.lit(rows.columns[i]).alias("column"), "distinct") for i in at]
    )


@check("probe_of_schema", "SELECT 0::BIGINT AS c_custkey, 'unknown' AS c_name, 0::DOUBLE AS c_acctbal, MIN(1)::INTEGER AS one FROM customer, range(3) r(i) GROUP BY i")
def probe_of_schema(t):
    """Three constant rows of a table's schema."""
    rows = t.customer.select("c_custkey", "c_name", F.col("c_acctbal").cast("double").alias("c_acctbal"))
    return diff.probe_rows(t.spark, rows.schema, 3).withColumn("one", F.lit(1))


@check("equal_tables_diff", """SELECT 'o_custkey' AS "column", COUNT(*) AS compared, 0::BIGINT AS different FROM orders UNION ALL SELECT 'o_totalprice', COUNT(*), 0 FROM orders""")
def equal_tables_diff(t):
    """A table against itself in another order: no bucket differs, so no row is joined."""
    names = ["o_orderkey", "o_custkey", "o_totalprice"]
    other = t.orders.select(names).repartition(5, "o_custkey").sort("o_totalprice")
    return diff.column_differences(t.orders.select(names), other, "o_orderkey").select("column", "compared", "different")
