"""Missing values, long lists, many categories, and models whose result SQL can compute."""

from pyspark.sql import functions as F

from tideline.checks.modelling import TOP_BOTTOM_SQL
from tideline.checks.registry import big, check, r6
from tideline.checks.workload import crm_tables
from tideline.operators import diff, encode, evaluate, joins, learn, ranking, running, sampling
from tideline.plans import retrieve
from tideline.session import materialize
from tideline.sources import tables

HOLES = """s AS (SELECT l_orderkey * 8 + l_linenumber AS k, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
       CASE WHEN l_linenumber % 3 > 0 THEN l_extendedprice END AS p FROM lineitem)"""


def with_holes(t):
    """Every line scored by its price, a third of them without a score."""
    return t.lineitem.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("long").alias("k"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        F.when(F.col("l_linenumber") % 3 > 0, F.col("l_extendedprice")).alias("p"),
    )


@check(
    "rank_band_with_nulls",
    f"""WITH {HOLES} SELECT k, position FROM (SELECT k, row_number() OVER (ORDER BY p DESC NULLS LAST, k) AS position, COUNT(*) OVER () AS n FROM s)
       WHERE position - 1 >= floor(n * 0.1) AND position - 1 < floor(n * 0.9)""",
)
def rank_band_with_nulls(t):
    """Rows without a score rank behind all others."""
    return ranking.rank_band(with_holes(t), "p", ["k"]).select("k", "position")


@check("top_bottom_with_nulls", f"WITH {HOLES}, " + TOP_BOTTOM_SQL.replace("p DESC", "p DESC NULLS LAST").format(key="k"))
def top_bottom_with_nulls(t):
    row = evaluate.top_bottom(with_holes(t), "y", "p", "k")
    return row.withColumns(
        {c: big(c) for c in ("top_rows", "bottom_rows", "positives", "top_hits", "bottom_hits", "middle_hits")}
    ).withColumn("normalized_score", F.round("normalized_score", 6))


@check(
    "key_list_of_any_length",
    """SELECT 'long' AS list, COUNT(*) AS n_rows, CAST(SUM(l_linenumber) AS BIGINT) AS total FROM lineitem WHERE l_orderkey BETWEEN 1 AND 5000
       UNION ALL SELECT 'short', COUNT(*), CAST(SUM(l_linenumber) AS BIGINT) FROM lineitem WHERE l_orderkey BETWEEN 1 AND 5
       UNION ALL SELECT 'table', COUNT(*), CAST(SUM(l_linenumber) AS BIGINT) FROM lineitem WHERE l_orderkey BETWEEN 1 AND 5000""",
)
def key_list_of_any_length(t):
    """A list of 5000 keys, one of 5 and a table of keys filter alike, on a key of another number type too."""
    rows = t.lineitem.withColumn("l_orderkey", F.col("l_orderkey").cast("double"))
    lists = {"long": range(1, 5001), "short": range(1, 6), "table": t.spark.range(1, 5001)}
    parts = [
        tables.read_table(rows, filter_key="l_orderkey", filter_values=keys if name == "table" else list(keys)).agg(
            F.count(F.lit(1)).alias("n_rows"), big(F.sum("l_linenumber"), "total")
        ).select(F.lit(name).alias("list"), "n_rows", "total")
        for name, keys in lists.items()
    ]
    return joins.union_all(parts)


@check(
    "under_sample_three_classes",
    """WITH r AS (SELECT o_orderkey, o_orderstatus AS s FROM orders), n AS (SELECT s, COUNT(*) AS n FROM r GROUP BY s),
       big AS (SELECT s FROM n ORDER BY n DESC, s LIMIT 1)
       SELECT s AS status, COUNT(*) AS n_rows, MIN(o_orderkey) AS first_key FROM (SELECT *, row_number() OVER (PARTITION BY s ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '|42')) AS k FROM r)
       WHERE s <> (SELECT s FROM big) OR k <= floor((SELECT MIN(n) FROM n) / 0.5 + 1e-9) GROUP BY s""",
)
def under_sample_three_classes(t):
    """The largest class shrinks, the other two stay whole."""
    codes = F.create_map(*[F.lit(x) for pair in (("F", 0), ("O", 1), ("P", 2)) for x in pair])
    rows = t.orders.select("o_orderkey", codes[F.col("o_orderstatus")].alias("s"), "o_orderstatus")
    kept = sampling.under_sample(rows, "o_orderkey", "s", 0.5)
    return kept.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n_rows"), F.min("o_orderkey").alias("first_key"))


@check(
    "sort_rows",
    "SELECT c_custkey, row_number() OVER (ORDER BY c_mktsegment, c_acctbal DESC, c_custkey) AS position FROM customer",
)
def sort_rows(t):
    """Rows numbered in the order they were sorted in."""
    ordered = ranking.sort_rows(t.customer, "c_mktsegment", "c_acctbal", "c_custkey", descending=["c_acctbal"])
    placed = materialize(ranking.row_ids(ordered, "place"), "sorted")
    return running.row_numbers(placed, ["place"], "position").select("c_custkey", "position")


@check("head_rows", "SELECT LEAST(10, COUNT(*)) AS n_rows FROM orders")
def head_rows(t):
    return ranking.head(t.orders, 10).agg(F.count(F.lit(1)).alias("n_rows"))


@check(
    "column_sets",
    """SELECT 'left_only' AS side, 'c_address,c_mktsegment' AS names UNION ALL SELECT 'right_only', 's_extra'
       UNION ALL SELECT 'common', 'c_custkey,c_name' UNION ALL SELECT 'exactly_one', 'c_address,c_mktsegment,s_extra'""",
)
def column_sets(t):
    """Column names of two tables, compared."""
    left = t.customer.withColumn("c_address", F.lit("")).select("c_custkey", "c_name", "c_address", "c_mktsegment")
    right = t.customer.select("c_custkey", "c_name", F.col("c_acctbal").alias("s_extra"))
    found = joins.column_sets(left, right)
    return joins.union_all(
        [right.limit(1).select(F.lit(k).alias("side"), F.lit(",".join(v)).alias("names")) for k, v in found.items()]
    )


@check(
    "row_differences",
    """WITH a AS (SELECT l_suppkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R'), b AS (SELECT l_suppkey, l_linenumber FROM lineitem WHERE l_returnflag = 'A')
       SELECT *, 'left' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT *, 'right' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""",
)
def row_differences(t):
    """Rows that one of two tables has more often."""
    part = lambda flag: t.lineitem.where(F.col("l_returnflag") == flag).select("l_suppkey", "l_linenumber")
    return joins.row_differences(part("R"), part("A"))


@check(
    "moved_rows",
    """WITH a AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS r FROM orders),
       b AS (SELECT o_orderkey, row_number() OVER (ORDER BY round(o_totalprice, -4), o_orderkey) AS r FROM orders)
       SELECT COUNT(*) FILTER (a.o_orderkey <> b.o_orderkey) AS moved FROM a JOIN b USING (r)""",
)
def moved_rows(t):
    """How many places of two orders hold different rows."""
    rows = t.orders.select("o_orderkey", "o_totalprice", F.round("o_totalprice", -4).alias("coarse"))
    left = running.row_numbers(rows, ["o_totalprice", "o_orderkey"], "r")
    right = running.row_numbers(rows, ["coarse", "o_orderkey"], "r")
    return diff.same_order(left, right, "o_orderkey", "r")


@check(
    "consultancy_pivot",
    """SELECT deal_id, COUNT(DISTINCT id) AS meetings FROM (SELECT event_id AS id, event_id // 3 AS deal_id FROM events WHERE event_type = 'error' AND user_id % 8 <> 7) GROUP BY deal_id""",
)
def consultancy_pivot(t):
    """Meetings of the second kind per deal: the pivot by outcome adds up to their number."""
    wide = retrieve.meeting_pivot(retrieve.meetings(crm_tables(t)["meetings"]), "Consultancy")
    total = sum((F.coalesce(F.col(c), F.lit(0)) for c in wide.columns if c != "deal_id"), F.lit(0))
    return wide.select("deal_id", big(total, "meetings"))


# -- many categories --------------------------------------------------------------------------


@check(
    "sparse_encoding",
    """WITH v AS (SELECT 'c' AS col, c_name AS v FROM customer UNION SELECT 's', c_mktsegment FROM customer UNION SELECT 'w', unnest(string_split(c_name, '#')) FROM customer),
       p AS (SELECT col, v, row_number() OVER (ORDER BY col, v) - 1 AS place FROM v)
       SELECT c_custkey, a.place AS name_place, b.place AS segment_place, CAST(2 + len(list_distinct(string_split(c_name, '#'))) AS INTEGER) AS ones
       FROM customer JOIN p a ON a.col = 'c' AND a.v = c_name JOIN p b ON b.col = 's' AND b.v = c_mktsegment""",
)
def sparse_encoding(t):
    """A column with as many categories as rows, one with few, and a list, as places in one sparse vector."""
    rows = t.customer.select("c_custkey", F.col("c_name").alias("c"), F.col("c_mktsegment").alias("s"), F.col("c_name").alias("w"))
    vocabulary = encode.vocabularies(rows, ["c", "s"]).unionByName(encode.list_vocabularies(rows, ["w"], "#"))
    places = materialize(encode.fit_places(vocabulary), "places")
    out = encode.encode_sparse(rows, "c_custkey", places, ["c", "s"], ["w"], "#")
    return out.select(
        "c_custkey", F.get("encoded", F.lit(0)).alias("name_place"), F.get("encoded", F.lit(1)).alias("segment_place"), F.size("encoded").alias("ones")
    )


# -- models that SQL can compute ----------------------------------------------------------------
#
# One tree of depth one on a 0/1 feature has two leaves, the mean of 2y - 1 on either side, and a
# row's probability is 1 / (1 + exp(-2 leaf)).

FLAG = "s AS (SELECT l_orderkey * 8 + l_linenumber AS k, (l_returnflag = 'R')::INT AS y, (l_linestatus = 'O')::INT::DOUBLE AS x, (l_quantity > 25)::INT::DOUBLE AS z FROM lineitem)"
STUMP = {"max_iter": 1, "max_depth": 1}


def flags(t):
    return t.lineitem.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("long").alias("k"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        (F.col("l_linestatus") == "O").cast("double").alias("x"),
        (F.col("l_quantity") > 25).cast("double").alias("z"),
    )


@check("one_split_score", f"WITH {FLAG}, m AS (SELECT x, 2 * AVG(y) - 1 AS leaf FROM s GROUP BY x) SELECT k, ROUND(1 / (1 + exp(-2 * leaf)), 6) AS p FROM s JOIN m USING (x)")
def one_split_score(t):
    """The probabilities of a boosted model of one split."""
    rows = flags(t)
    return learn.score(learn.fit_boosted(rows, ["x"], "y", **STUMP), rows, "p").select("k", r6("p"))


def _folds(seed):
    return f"""f AS (SELECT *, (row_number() OVER (PARTITION BY y ORDER BY md5(CAST(k AS VARCHAR) || '|{seed}'), k) - 1) % 3 AS fold FROM s)"""


def _fold_scores(feature):
    """Accuracy of the one-split model on each fold, fitted on the others."""
    return f"""SELECT g.fold, AVG(((2 * m.a - 1 >= 0)::INT = g.y)::INT) AS score
       FROM f g JOIN (SELECT h.fold, i.{feature} AS v, AVG(i.y) AS a FROM (SELECT DISTINCT fold FROM f) h JOIN f i ON i.fold <> h.fold GROUP BY h.fold, i.{feature}) m
         ON m.fold = g.fold AND m.v = g.{feature} GROUP BY g.fold"""


@check(
    "search_scores",
    f"""WITH {FLAG}, {_folds(1042)}, b AS ({_fold_scores('x')})
       SELECT fold::INTEGER AS fold, step::DOUBLE AS step, ROUND(score, 6) AS score FROM b, (VALUES (0.1), (0.2)) v(step)""",
)
def search_scores(t):
    """Fold scores of every candidate: a single tree does not depend on the step."""
    best, table = learn.search(flags(t), "k", ["x"], "y", {"step": [0.1, 0.2], **{p: [v] for p, v in STUMP.items()}}, 3, None)
    return table.select("fold", F.get_json_object("params", "$.step").cast("double").alias("step"), r6("score"))


@check(
    "compared_models",
    f"""WITH {FLAG}, {_folds(42)}, a AS ({_fold_scores('x')}), b AS ({_fold_scores('z')})
       SELECT 'status' AS model, fold::INTEGER AS fold, ROUND(score, 6) AS score FROM a UNION ALL SELECT 'quantity', fold::INTEGER, ROUND(score, 6) FROM b""",
)
def compared_models(t):
    """Cross-validated scores of two models of one split each."""
    models = {name: lambda d, c=c: learn.fit_boosted(d, [c], "y", **STUMP) for name, c in (("status", "x"), ("quantity", "z"))}
    return learn.compare_models(flags(t), "k", "y", models, 3).select("model", "fold", r6("score"))


@check(
    "repeated_accuracy",
    f"""WITH {FLAG}, r AS (SELECT * FROM s, (VALUES (1), (2), (3)) v(seed)), d AS (SELECT *, substr(md5(CAST(k AS VARCHAR) || '|' || seed), 1, 8) < '33333334' AS test FROM r),
       m AS (SELECT seed, x, 2 * AVG(y) - 1 AS leaf FROM d WHERE NOT test GROUP BY seed, x)
       SELECT seed::INTEGER AS seed, ROUND(AVG(((leaf >= 0)::INT = y)::INT), 6) AS accuracy FROM d JOIN m USING (seed, x) WHERE test GROUP BY seed""",
)
def repeated_accuracy(t):
    """Hold-out accuracy of one learner for three splits."""
    runs = learn.repeat_evaluation(flags(t), "k", "y", lambda d: learn.fit_boosted(d, ["x"], "y", **STUMP), [1, 2, 3])
    return runs.select("seed", r6("accuracy"))


@check(
    "logistic_balance",
    """WITH s AS (SELECT (l_returnflag = 'R')::INT AS y, CASE WHEN l_linenumber % 4 > 0 THEN l_quantity END AS q, CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 3.0 END AS w FROM lineitem)
       SELECT COUNT(*) AS n_rows, COUNT(*) - COUNT(q) AS holes, ROUND((SUM(w * y) / SUM(w))::DOUBLE, 3) AS mean_probability FROM s""",
)
def logistic_balance(t):
    """On its own training rows the weighted mean probability of a logistic model equals the weighted share of positives,
    also where a feature has holes."""
    y = (F.col("l_returnflag") == "R").cast("int")
    rows = t.lineitem.select(
        y.alias("y"),
        F.when(F.col("l_linenumber") % 4 > 0, F.col("l_quantity").cast("double")).alias("q"),
        F.col("l_discount").cast("double").alias("d"),
        F.when(y == 1, 1.0).otherwise(3.0).alias("w"),
    )
    model, _ = learn.fit_logistic(rows, rows, ["q", "d"], "y", "w", max_iter=200)
    scored = learn.score(model, rows)
    mean = F.round(F.sum(F.col("w") * F.col("probability_1")) / F.sum("w"), 3)
    return scored.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("q").isNull()).alias("holes"), mean.alias("mean_probability"))


@check(
    "trained_on_many_categories",
    "SELECT COUNT(*) AS n_rows, COUNT(DISTINCT o_clerk) AS categories, 1 AS in_range FROM (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) || '-' || CAST(o_orderkey AS VARCHAR) AS o_clerk FROM orders)",
)
def trained_on_many_categories(t):
    """A text feature with a category per row goes in by hash."""
    rows = t.orders.select(
        F.concat_ws("-", "o_custkey", "o_orderkey").alias("clerk"), (F.col("o_orderstatus") == "F").cast("int").alias("y"), "o_totalprice"
    )
    model = learn.fit_boosted(rows, ["clerk", "o_totalprice"], "y", hashed=["clerk"], max_iter=2, max_depth=2)
    p = F.col("probability_1")
    return learn.score(model, rows).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("clerk").alias("categories"), F.min(((p >= 0) & (p <= 1)).cast("int")).alias("in_range")
    )
