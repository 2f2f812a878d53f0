"""Profiles, encoders, tests and samples."""

from pyspark.sql import functions as F

from tideline.checks.registry import big, check, r6
from tideline.functions.text import lower_trim
from tideline.operators import columns, encode, profile, ranking, running, sampling, stats

# -- profiles ------------------------------------------------------------------


def _profile_sql(table: str, columns: list[tuple[str, str, str, bool]], extended: bool = True) -> str:
    parts = []
    for name, kind, feature_class, is_number in columns:
        numbers = (
            f"ROUND(AVG({name}), 4) AS mean, ROUND(stddev_samp({name}), 4) AS std, CAST(MIN({name}) AS DOUBLE) AS min, CAST(MAX({name}) AS DOUBLE) AS max"
            if is_number
            else "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max"
        )
        parts.append(
            f"""SELECT '{name}' AS "column", COUNT(*) - COUNT({name}) AS missing, ROUND((COUNT(*) - COUNT({name})) / COUNT(*), 2) AS missing_share,
            COUNT({name}) AS "count", '{kind}' AS type, COUNT(DISTINCT {name}) AS "distinct", '{feature_class}' AS feature_class"""
            + (f", {numbers}" if extended else "")
            + f" FROM {table}"
        )
    return "\nUNION ALL ".join(parts)


HOLED = "(SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal, NULLIF(c_mktsegment, 'BUILDING') AS c_mktsegment FROM customer)"
CUSTOMER_COLUMNS = [
    ("c_custkey", "bigint", "numerical", True),
    ("c_name", "string", "categorical", False),
    ("c_nationkey", "int", "numerical", True),
    ("c_acctbal", "double", "numerical", True),
    ("c_mktsegment", "string", "categorical(onehot)", False),
]


def holed_customers(t):
    return t.customer.withColumns(
        {
            "c_acctbal": F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")),
            "c_mktsegment": F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")),
        }
    )


@check("profile_columns", _profile_sql(HOLED, CUSTOMER_COLUMNS))
def profile_columns(t):
    table = profile.profile(holed_customers(t), one_hot=["c_mktsegment"], extended=True).drop("most_popular")
    return table.withColumns({"mean": F.round("mean", 4), "std": F.round("std", 4)})


@check(
    "profile_modes",
    """SELECT 'o_orderstatus' AS "column", (SELECT o_orderstatus FROM orders GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1) AS most_popular
       UNION ALL SELECT 'o_custkey', (SELECT CAST(o_custkey AS VARCHAR) FROM orders GROUP BY o_custkey ORDER BY COUNT(*) DESC, o_custkey LIMIT 1)
       UNION ALL SELECT 'o_orderpriority', (SELECT o_orderpriority FROM orders GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1)""",
)
def profile_modes(t):
    rows = t.orders.select("o_orderstatus", "o_custkey", "o_orderpriority")
    return profile.profile(rows, extended=True).select("column", "most_popular")


@check(
    "describe_columns",
    """SELECT 'l_quantity' AS "column", COUNT(l_quantity) AS "count", ROUND(AVG(l_quantity), 4) AS mean, ROUND(stddev_samp(l_quantity), 4) AS std,
              MIN(l_quantity) AS min, MAX(l_quantity) AS max, COUNT(DISTINCT l_quantity) AS "distinct" FROM lineitem
       UNION ALL SELECT 'l_discount', COUNT(l_discount), ROUND(AVG(l_discount), 4), ROUND(stddev_samp(l_discount), 4), MIN(l_discount), MAX(l_discount), COUNT(DISTINCT l_discount) FROM lineitem""",
)
def describe_columns(t):
    table = profile.describe(t.lineitem.select("l_quantity", "l_discount", "l_returnflag"))
    return table.withColumns({"mean": F.round("mean", 4), "std": F.round("std", 4)})


PROFILE_MERGE_SQL = """
WITH new AS (SELECT 'o_custkey' AS "column", COUNT(*) FILTER (o_custkey IS NULL) AS missing, COUNT(DISTINCT o_custkey) AS "distinct" FROM orders
       UNION ALL SELECT 'o_orderstatus', 0, COUNT(DISTINCT o_orderstatus) FROM orders
       UNION ALL SELECT 'o_orderpriority_1', 0, COUNT(DISTINCT o_orderpriority) FROM orders
       UNION ALL SELECT 'o_orderpriority_2', 0, COUNT(DISTINCT o_totalprice) FROM orders),
     old AS (SELECT 'o_custkey' AS "column", '1' AS stage, 'true' AS in_use, CAST(0 AS BIGINT) AS missing, COUNT(DISTINCT o_custkey) AS "distinct" FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01'
       UNION ALL SELECT 'o_orderpriority_1', '2', 'true', 0, COUNT(DISTINCT o_orderpriority) FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01'
       UNION ALL SELECT 'o_orderkey', '3', 'false', 0, COUNT(DISTINCT o_orderkey) FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01')
SELECT COALESCE(n."column", o."column") AS "column", COALESCE(n.missing, o.missing) AS missing, COALESCE(n."distinct", o."distinct") AS "distinct",
       CASE WHEN n."column" = 'o_orderpriority_2' THEN '2' ELSE stage END AS stage,
       CASE WHEN n."column" = 'o_orderpriority_2' THEN 'true' ELSE in_use END AS in_use,
       CASE WHEN o."column" IS NULL THEN 'new' WHEN n."column" IS NULL THEN 'old' END AS only_in,
       CASE WHEN n."column" = 'o_orderstatus' THEN 1 ELSE 0 END AS to_fill
FROM new n FULL JOIN old o ON n."column" = o."column" """


@check("profile_merge", PROFILE_MERGE_SQL)
def profile_merge(t):
    """Profile of all orders merged over the annotated profile of the early ones."""
    early = t.orders.where(F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz"))
    now = t.orders.select(
        "o_custkey", "o_orderstatus", F.col("o_orderpriority").alias("o_orderpriority_1"), F.col("o_totalprice").alias("o_orderpriority_2")
    )
    before = early.select("o_custkey", F.col("o_orderpriority").alias("o_orderpriority_1"), "o_orderkey")
    name = F.col("column")
    old = profile.profile(before).withColumns(
        {
            "stage": F.when(name == "o_custkey", "1").when(name == "o_orderkey", "3").otherwise("2"),
            "In use": F.when(name == "o_orderkey", "false").otherwise("true"),
        }
    )
    new = profile.profile(now)
    merged = profile.inherit_annotations(profile.merge_profiles(new, old), ["o_orderpriority"])
    sides = profile.profile_sides(new, old)
    blanks = profile.empty_annotations(merged).select(F.col("column")).distinct().withColumn("to_fill", F.lit(1))
    joined = merged.join(sides, "column", "left").join(blanks, "column", "left")
    return joined.select(
        "column", "missing", "distinct", "stage", F.col("`In use`").alias("in_use"), "only_in",
        F.coalesce("to_fill", F.lit(0)).alias("to_fill"),
    )


@check(
    "stage_features",
    """SELECT * FROM (VALUES ('c_custkey', 'init_stage'), ('c_custkey', 'mid_stage'), ('c_custkey', 'final_stage'), ('c_nationkey', 'mid_stage'),
       ('c_nationkey', 'final_stage'), ('feat_init_balance', 'mid_stage')) v("column", stage_name)""",
)
def stage_features(t):
    """Feature rows per lifecycle stage, from an annotated profile of the customers."""
    wide = t.customer.withColumnsRenamed({"c_acctbal": "feat_init_balance"})
    name = F.col("column")
    stage = F.when(name == "c_custkey", 1).when(name.isin("c_nationkey", "feat_init_balance"), 2).when(name == "c_name", 0)
    annotated = profile.profile(wide).withColumns({"stage": stage, "In use": name != "c_mktsegment"})
    parts = [
        profile.stage_features(annotated, s).select("column", F.lit(s).alias("stage_name")) for s in profile.STAGE_LIMITS
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# -- encoders ----------------------------------------------------------------------


@check(
    "fill_scale",
    """WITH h AS (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS b, NULLIF(c_mktsegment, 'BUILDING') AS s FROM customer),
            m AS (SELECT median(b) AS md, MIN(b) AS lo, MAX(b) AS hi FROM h)
       SELECT c_custkey, ROUND((COALESCE(b, md) - lo) / (hi - lo), 6) AS c_acctbal, COALESCE(s, 'none') AS c_mktsegment,
              b IS NOT NULL AS c_acctbal_boolean, 0 AS absent FROM h, m""",
)
def fill_scale(t):
    rows = encode.presence_flags(holed_customers(t), ["c_acctbal"])
    fitted = encode.fit_fill(rows, {"c_acctbal": encode.MEDIAN, "c_mktsegment": "none", "absent": 0})
    filled = encode.apply_fill(rows, fitted)
    scaled = encode.apply_range(filled, encode.fit_range(filled, ["c_acctbal"]))
    return scaled.select("c_custkey", r6("c_acctbal"), "c_mktsegment", "c_acctbal_boolean", "absent")


@check(
    "exact_quantiles",
    """SELECT l_returnflag, ROUND(quantile_cont(l_extendedprice, 0.1), 4) AS p10, ROUND(median(l_extendedprice), 4) AS p50,
              ROUND(quantile_cont(l_extendedprice, 0.95), 4) AS p95 FROM lineitem GROUP BY l_returnflag""",
)
def exact_quantiles(t):
    out = running.exact_quantiles(t.lineitem, "l_extendedprice", {"p10": 0.1, "p50": 0.5, "p95": 0.95}, ["l_returnflag"])
    return out.withColumns({c: F.round(c, 4) for c in ("p10", "p50", "p95")})


@check(
    "enrich_coalesce",
    """WITH n AS (SELECT s_nationkey, MAX(s_acctbal) AS b FROM supplier GROUP BY 1)
       SELECT c_custkey, ROUND(b, 2) AS feat_init_balance, ROUND(COALESCE(CASE WHEN c_acctbal >= 5000 THEN c_acctbal END, b), 2) AS feat_final_balance,
              b IS NOT NULL AS enrichment_boolean FROM customer LEFT JOIN n ON c_nationkey = s_nationkey""",
)
def enrich_coalesce(t):
    best = t.supplier.groupBy("s_nationkey").agg(F.max("s_acctbal").alias("enrichment"))
    rows = t.customer.join(best, F.col("c_nationkey") == F.col("s_nationkey"), "left").select(
        "c_custkey", "enrichment", F.when(F.col("c_acctbal") >= 5000, F.col("c_acctbal")).alias("balance")
    )
    out = encode.enrich_pairs(rows, [("enrichment", "balance")])
    return out.withColumns({c: F.round(c, 2) for c in ("feat_init_balance", "feat_final_balance")})


@check(
    "onehot",
    """SELECT o_orderkey, """
    + ", ".join(
        f"CASE WHEN p = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"priority_{n}\""
        for v, n in [("1-URGENT", "1-URGENT"), ("2-HIGH", "2-HIGH"), ("3-MEDIUM", "3-MEDIUM"), ("4-NOT SPECIFIED", "4-NOT SPECIFIED"), ("<NA>", "_NA>")]
    )
    + " FROM (SELECT o_orderkey, COALESCE(NULLIF(o_orderpriority, '5-LOW'), '<NA>') AS p FROM orders)",
)
def onehot(t):
    rows = t.orders.select("o_orderkey", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"))
    return encode.apply_one_hot(rows, encode.fit_one_hot(rows, ["priority"]))


PART_WORDS = "anvil blue bolt cold gear gizmo hot large new old plate red ring rod small widget".split()


@check(
    "multihot",
    "SELECT p_partkey, "
    + ", ".join(f"CASE WHEN list_contains(string_split(p_name, ' '), '{w}') THEN 1 ELSE 0 END AS w_{w}" for w in PART_WORDS)
    + " FROM part",
)
def multihot(t):
    rows = t.part.select("p_partkey", F.replace("p_name", F.lit(" "), F.lit(";")).alias("w"))
    return encode.apply_multi_hot(rows, encode.fit_multi_hot(rows, ["w"]))


@check("multihot_vocabulary", "SELECT DISTINCT unnest(string_split(p_name, ' ')) AS item FROM part")
def multihot_vocabulary(t):
    rows = t.part.select(F.replace("p_name", F.lit(" "), F.lit(";")).alias("w"))
    found = encode.fit_multi_hot(rows, ["w"])["w"]
    return t.spark.createDataFrame([(w,) for w in found], "item string")


@check(
    "label_codes",
    """SELECT p_partkey, b.code AS p_brand, n.code AS p_name FROM part
       JOIN (SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS code FROM (SELECT DISTINCT p_brand FROM part)) b USING (p_brand)
       JOIN (SELECT p_name, row_number() OVER (ORDER BY p_name) - 1 AS code FROM (SELECT DISTINCT p_name FROM part)) n USING (p_name)""",
)
def label_codes(t):
    rows = t.part.select("p_partkey", "p_brand", "p_name")
    return encode.apply_codes(rows, encode.fit_codes(rows, ["p_brand", "p_name"]), ["p_brand", "p_name"])


RECENCY_SQL = """WITH a AS (SELECT l_orderkey, l_linenumber, o_orderkey, CAST(floor((epoch(l_shipdate) - epoch(o_orderdate)) / 86400) AS INT) AS d,
                   CASE WHEN l_returnflag = 'R' THEN CAST(floor((epoch(TIMESTAMP '1998-01-01') - epoch(l_shipdate)) / 86400) AS INT) END AS e,
                   l_partkey, l_suppkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
       p AS (SELECT *, CASE WHEN d <= 0 THEN 0.0 WHEN d <= 6 THEN 5 WHEN d <= 29 THEN 4 WHEN d <= 89 THEN 3 WHEN d <= 179 THEN 2 ELSE 1 END AS x,
                   CASE WHEN e IS NULL THEN NULL WHEN e <= 0 THEN 0.0 WHEN e <= 6 THEN 5 WHEN e <= 29 THEN 4 WHEN e <= 89 THEN 3 WHEN e <= 179 THEN 2 ELSE 1 END AS y FROM a)
       SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(x AS DOUBLE) AS time_since_ordered, CAST(y AS DOUBLE) AS time_since_returned, CAST(x + COALESCE(y, 0) AS DOUBLE) AS total FROM p"""


@check("recency_scores", RECENCY_SQL)
def recency_scores(t):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    ship = F.col("l_shipdate").cast("timestamp")
    # The second field is shifted so that its age is measured at the same anchor.
    shift = F.unix_seconds(ship) - F.unix_seconds(F.lit("1998-01-01").cast("timestamp"))
    returned = F.when(F.col("l_returnflag") == "R", F.timestamp_seconds(F.unix_seconds(ship) + shift))
    rows = joined.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", ship.alias("at"),
        F.col("o_orderdate").cast("timestamp").alias("ordered"), returned.alias("returned"),
    )
    return encode.recency_scores(rows, ["ordered", "returned"], "at", "total").drop("at", "ordered", "returned")


@check(
    "career_features",
    """WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, lower(trim(p_type)) AS industry, lower(p_brand) AS field, lower(p_name) AS prev,
                    lower(p_type) AS job, p_size * 9 AS size, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS target
                    FROM lineitem JOIN part ON l_partkey = p_partkey),
       n AS (SELECT COUNT(*) AS a, COUNT(*) FILTER (target = 1) AS w FROM r),
       i AS (SELECT industry, COUNT(*) / (SELECT a FROM n) AS pa, COUNT(*) FILTER (target = 1) / (SELECT w FROM n) AS pw FROM r GROUP BY 1),
       f AS (SELECT field, COUNT(*) FILTER (target = 1) / (SELECT w FROM n) AS pf FROM r GROUP BY 1)
       SELECT industry, field, size, MAX(CASE WHEN size < 50 THEN 1 WHEN size < 250 THEN 2 ELSE 3 END) AS company_size_category,
              ROUND(MAX(pw), 6) AS industry_popularity, ROUND(MAX(pa), 6) AS industry_popularity_all, ROUND(MAX(pf), 6) AS field_of_study_popularity,
              SUM(CASE WHEN prev <> job THEN 1 ELSE 0 END)::BIGINT AS progressed
       FROM r JOIN i USING (industry) JOIN f USING (field) GROUP BY 1, 2, 3""",
)
def career_features(t):
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat(F.lit(" "), "p_type").alias("current_company_industry"),
        F.col("p_brand").alias("feat_final_education_field"),
        F.col("p_name").alias("previous_position"),
        F.col("p_type").alias("feat_final_current_job"),
        (F.col("p_size") * 9).alias("current_company_size"),
        (F.col("l_returnflag") == "R").cast("int").alias("target"),
    )
    texts = ["current_company_industry", "feat_final_education_field", "previous_position", "feat_final_current_job"]
    out = encode.career_features(rows, texts)
    return out.groupBy(
        F.col("current_company_industry").alias("industry"), F.col("feat_final_education_field").alias("field"), F.col("current_company_size").alias("size")
    ).agg(
        F.max("company_size_category").alias("company_size_category"),
        r6(F.max("industry_popularity"), "industry_popularity"),
        r6(F.max("industry_popularity_all"), "industry_popularity_all"),
        r6(F.max("field_of_study_popularity"), "field_of_study_popularity"),
        F.sum("career_progression").alias("progressed"),
    )


@check(
    "country_names",
    """SELECT c_custkey, CASE WHEN c_nationkey = 4 THEN NULL WHEN c_nationkey < 20 THEN lower(n_name) ELSE 'unknown' END AS country_name
       FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def country_names(t):
    countries = t.nation.where("n_nationkey < 20").select(F.col("n_nationkey").cast("string").alias("code"), "n_name")
    rows = t.customer.select("c_custkey", F.nullif(F.col("c_nationkey").cast("string"), F.lit("4")).alias("country_code"))
    return encode.country_name(rows, countries).select("c_custkey", "country_name")


@check(
    "synonym_groups",
    """SELECT p_partkey, g AS word_group FROM part LEFT JOIN (SELECT p_name AS w, MIN(p_type) AS g FROM part WHERE p_size > 40 GROUP BY 1) ON p_name = w""",
)
def synonym_groups(t):
    listed = t.part.where("p_size > 40").select(F.col("p_type").alias("position"), F.col("p_type").alias("word_group"), F.upper("p_name").alias("synonym"))
    return encode.group_synonyms(t.part, "p_name", listed, "word_group").select("p_partkey", "word_group")


@check(
    "state_and_profile",
    """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN '2' WHEN 'MACHINERY' THEN '3' WHEN 'HOUSEHOLD' THEN '<NA>' ELSE c_mktsegment END AS deal_cooking_state,
              COALESCE(p, 0) AS combined_profile, p IS NOT NULL AS combined_profile_boolean
       FROM (SELECT *, CASE WHEN c_acctbal > 0 THEN c_custkey + CAST(c_nationkey AS DOUBLE) END AS p FROM customer)""",
)
def state_and_profile(t):
    segment = F.col("c_mktsegment")
    state = F.when(segment == "BUILDING", "Hot Lead").when(segment == "MACHINERY", "Cold Deal").when(segment != "HOUSEHOLD", segment)
    rows = t.customer.select(
        "c_custkey",
        encode.deal_state(state).alias("deal_cooking_state"),
        F.col("c_nationkey").cast("double").alias("professional_profile"),
        F.when(F.col("c_acctbal") > 0, F.col("c_custkey")).cast("double").alias("personal_profile"),
    )
    return encode.combined_profile(rows)


@check(
    "locations",
    """SELECT c_custkey, lower(COALESCE(s, r, '')) AS italian_region, lower(COALESCE(s, r, '')) || '_' || n AS location,
              n AS country_name FROM (SELECT c_custkey, NULLIF(c_mktsegment, 'BUILDING') AS s, CASE WHEN c_acctbal > 0 THEN 'Lazio' END AS r,
              CASE WHEN c_nationkey <> 3 THEN lower(n_name) END AS n FROM customer JOIN nation ON c_nationkey = n_nationkey)""",
)
def locations(t):
    rows = joinable(t).select(
        "c_custkey",
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("italian_region"),
        F.when(F.col("c_acctbal") > 0, "Lazio").alias("region_enrichment"),
        F.when(F.col("c_nationkey") != 3, lower_trim(F.col("n_name"))).alias("country_name"),
        F.lit("IT").alias("country_code"),
    )
    return encode.location(rows)


def joinable(t):
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))


# -- two-sample tests -----------------------------------------------------------------


@check(
    "chi_square",
    """WITH r AS (SELECT o_orderpriority, o_orderstatus, l_returnflag, l_linestatus, CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS y FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
       u AS (SELECT 'o_orderpriority' AS c, o_orderpriority AS v, y FROM r UNION ALL SELECT 'o_orderstatus', o_orderstatus, y FROM r
             UNION ALL SELECT 'l_returnflag', l_returnflag, y FROM r UNION ALL SELECT 'l_linestatus', l_linestatus, y FROM r),
       o AS (SELECT c, v, y, COUNT(*) AS o FROM u GROUP BY ALL),
       e AS (SELECT o.c, o.o, SUM(o.o) OVER (PARTITION BY o.c, o.v) * SUM(o.o) OVER (PARTITION BY o.c, o.y) / SUM(o.o) OVER (PARTITION BY o.c) AS e,
                    (SELECT COUNT(DISTINCT v) - 1 FROM o k WHERE k.c = o.c) AS dof FROM o)
       SELECT c AS "column", ROUND(SUM(CASE WHEN dof = 1 THEN power(abs(o - e) - LEAST(0.5, abs(o - e)), 2) / e ELSE power(o - e, 2) / e END), 6) AS chi_square,
              MAX(dof) AS dof, SUM(o)::BIGINT AS n_used FROM e GROUP BY c""",
)
def chi_square(t):
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_orderpriority", "o_orderstatus", "l_returnflag", "l_linestatus", (F.col("l_quantity") > 25).cast("int").alias("y")
    )
    return stats.chi_square(rows, "y", p_values=False).select("column", r6("chi_square"), "dof", big("n_used"))


def _prices(t):
    y = F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "A", 0)
    return t.lineitem.select("l_extendedprice", "l_quantity", "l_discount", y.alias("y"))


UNPIVOTED = """u AS (SELECT 'l_extendedprice' AS c, l_extendedprice AS x, y FROM r UNION ALL SELECT 'l_quantity', l_quantity, y FROM r UNION ALL SELECT 'l_discount', l_discount, y FROM r)"""
PRICES = "r AS (SELECT l_extendedprice, l_quantity, l_discount, CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 END AS y FROM lineitem WHERE l_returnflag IN ('R', 'A'))"


@check(
    "t_test",
    f"""WITH {PRICES}, {UNPIVOTED},
       m AS (SELECT c, COUNT(*) FILTER (y = 0) AS n0, COUNT(*) FILTER (y = 1) AS n1, AVG(x) FILTER (y = 0) AS m0, AVG(x) FILTER (y = 1) AS m1,
                    var_samp(x) FILTER (y = 0) AS v0, var_samp(x) FILTER (y = 1) AS v1 FROM u GROUP BY c)
       SELECT c AS "column", ROUND((m0 - m1) / sqrt(((n0 - 1) * v0 + (n1 - 1) * v1) / (n0 + n1 - 2) * (1.0 / n0 + 1.0 / n1)), 6) AS t_statistic,
              n0 + n1 - 2 AS dof FROM m""",
)
def t_test(t):
    return stats.t_test(_prices(t), "y", p_values=False).select("column", r6("t_statistic"), big("dof"))


@check(
    "ks_two_sample",
    f"""WITH {PRICES}, {UNPIVOTED},
       g AS (SELECT c, x, COUNT(*) FILTER (y = 0) AS n0, COUNT(*) FILTER (y = 1) AS n1 FROM u GROUP BY c, x),
       k AS (SELECT c, SUM(n0) OVER w / SUM(n0) OVER (PARTITION BY c) - SUM(n1) OVER w / SUM(n1) OVER (PARTITION BY c) AS d FROM g
             WINDOW w AS (PARTITION BY c ORDER BY x ROWS UNBOUNDED PRECEDING))
       SELECT c AS "column", ROUND(MAX(abs(d)), 6) AS ks_statistic FROM k GROUP BY c""",
)
def ks_two_sample(t):
    return stats.ks_test(_prices(t), "y", p_values=False).select("column", r6("ks_statistic"))


@check(
    "levene",
    f"""WITH {PRICES}, {UNPIVOTED},
       z AS (SELECT c, y, abs(x - median(x) OVER (PARTITION BY c, y)) AS z FROM u),
       m AS (SELECT c, y, COUNT(*) AS n, AVG(z) AS m, var_pop(z) AS v FROM z GROUP BY c, y),
       g AS (SELECT c, SUM(n) AS n, SUM(n * m) / SUM(n) AS g, SUM(n * v) AS w FROM m GROUP BY c)
       SELECT g.c AS "column", ROUND((MAX(g.n) - 2) * SUM(m.n * power(m.m - g.g, 2)) / MAX(g.w), 6) AS levene_statistic FROM g JOIN m ON g.c = m.c GROUP BY g.c""",
)
def levene(t):
    return stats.levene_test(_prices(t), "y", p_values=False).select("column", r6("levene_statistic"))


@check("gated_t_test")
def gated_t_test(t):
    """t-tests shown only where the preconditions hold, with the reason otherwise."""
    return stats.gated_t_test(_prices(t), "y", gated=True, explain=True)


@check("profile_with_tests")
def profile_with_tests(t):
    """Profile joined with test statistics and p-values."""
    y = F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "A", 0)
    rows = t.lineitem.select("l_extendedprice", "l_quantity", "l_linestatus", y.alias("y"))
    table = profile.profile(rows, extended=True)
    return profile.with_tests(table, stats.t_test(rows, "y"), stats.chi_square(rows, "y"))


# -- splits and samples ------------------------------------------------------------------


@check(
    "split_hash",
    """SELECT o_orderkey, CASE WHEN substr(md5(CAST(o_orderkey AS VARCHAR) || '|42'), 1, 8) < '33333334' THEN 'test' ELSE 'train' END AS part FROM orders""",
)
def split_hash(t):
    train, test = sampling.train_test(t.orders.select("o_orderkey"), "o_orderkey", 0.2, 42)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@check(
    "stratified_exact",
    """SELECT o_orderkey, target FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 ELSE 0 END AS target,
              row_number() OVER (PARTITION BY o_orderstatus = 'F' ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '|7')) AS r FROM orders)
       WHERE r <= CASE target WHEN 1 THEN (SELECT COUNT(*) FROM customer WHERE c_mktsegment = 'BUILDING')
                              ELSE (SELECT COUNT(*) FROM customer WHERE c_mktsegment <> 'BUILDING') END""",
)
def stratified_exact(t):
    small = columns.label_from_stage(t.customer, "c_mktsegment", ["BUILDING"])
    large = columns.label_from_stage(t.orders, "o_orderstatus", ["F"]).select("o_orderkey", "target")
    return sampling.balanced_subset(small, large, "o_orderkey", "target", 7)


@check(
    "under_sample",
    """WITH r AS (SELECT o_orderkey, CASE WHEN o_totalprice > 490000 THEN 1 ELSE 0 END AS target FROM orders)
       SELECT o_orderkey, target FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '|42')) AS k FROM r)
       WHERE target = 1 OR k <= 10 * (SELECT SUM(target) FROM r)""",
)
def under_sample(t):
    rows = t.orders.select("o_orderkey", (F.col("o_totalprice") > 490000).cast("int").alias("target"))
    return sampling.under_sample(rows, "o_orderkey", "target", 0.1)


@check(
    "over_sample",
    """WITH r AS (SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 1 ELSE 0 END AS target FROM orders),
       n AS (SELECT COUNT(*) FILTER (target = 1) AS p, COUNT(*) FILTER (target = 0) AS q FROM r), m AS (SELECT p < q AS small_is_one, LEAST(p, q) AS a, GREATEST(p, q) AS b FROM n),
       k AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '|42')) AS k FROM r)
       SELECT o_orderkey, target, CAST(unnest(range(1, 1 + CASE WHEN (target = 1) = small_is_one THEN b // a + CASE WHEN k <= b % a THEN 1 ELSE 0 END ELSE 1 END)) AS BIGINT) AS copy FROM k, m""",
)
def over_sample(t):
    rows = t.orders.select("o_orderkey", (F.col("o_totalprice") > 300000).cast("int").alias("target"))
    return sampling.over_sample(rows, "o_orderkey", "target").withColumn("copy", big("copy", "copy"))


@check(
    "kfold",
    """SELECT o_orderkey, o_orderstatus, CAST((row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '|42')) - 1) % 3 AS INTEGER) AS fold FROM orders""",
)
def kfold(t):
    return sampling.fold_stratified(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderkey", "o_orderstatus", 3, 42)


@check(
    "kfold_hash",
    """SELECT o_orderkey, CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|42'), 1, 8))::BIGINT % 5 AS INTEGER) AS fold FROM orders""",
)
def kfold_hash(t):
    return sampling.fold_hash(t.orders.select("o_orderkey"), "o_orderkey", 5, 42)


@check(
    "bootstrap",
    """WITH b AS (SELECT o_orderkey, bag, ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|' || bag || '|42'), 1, 8))::BIGINT / 4294967296.0 AS u
                  FROM orders, (SELECT unnest(range(0, 4)) AS bag)),
       p AS (SELECT unnest(range(0, 12)) AS k), q AS (SELECT k, SUM(exp(-1) / factorial(CAST(k AS INTEGER))) OVER (ORDER BY k) AS c FROM p)
       SELECT o_orderkey, bag::INTEGER AS bag, CAST((SELECT COUNT(*) FROM q WHERE u >= c) AS INTEGER) AS weight FROM b WHERE (SELECT COUNT(*) FROM q WHERE u >= c) > 0""",
)
def bootstrap(t):
    return sampling.bootstrap(t.orders.select("o_orderkey"), "o_orderkey", 4)


# -- ranking -----------------------------------------------------------------------------------


@check(
    "rank_band",
    """SELECT o_orderkey, position FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS position FROM orders)
       WHERE position - 1 >= floor((SELECT COUNT(*) FROM orders) * 0.1) AND position - 1 < floor((SELECT COUNT(*) FROM orders) * 0.9)""",
)
def rank_band(t):
    return ranking.rank_band(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", ["o_orderkey"]).select("o_orderkey", "position")


@check(
    "top_and_bottom_rows",
    """(SELECT 'top' AS side, o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25)
       UNION ALL (SELECT 'bottom', o_orderkey FROM orders ORDER BY o_totalprice, o_orderkey DESC LIMIT 25)""",
)
def top_and_bottom_rows(t):
    rows = t.orders.select("o_orderkey", "o_totalprice")
    top = ranking.top_n(rows, "o_totalprice", 25, ["o_orderkey"]).select(F.lit("top").alias("side"), "o_orderkey")
    bottom = ranking.bottom_n(rows, "o_totalprice", 25, ["o_orderkey"]).select(F.lit("bottom").alias("side"), "o_orderkey")
    return top.unionByName(bottom)


@check(
    "sorted_rows",
    """SELECT o_orderkey, o_orderstatus, row_number() OVER (ORDER BY o_orderstatus, o_totalprice DESC, o_orderkey) AS place FROM orders""",
)
def sorted_rows(t):
    """A global sort by several keys, checked through its dense positions."""
    rows = t.orders.select("o_orderkey", "o_orderstatus", (-F.col("o_totalprice")).alias("down"))
    return running.row_numbers(rows, ["o_orderstatus", "down", "o_orderkey"], "place").drop("down")


@check("row_ids", "SELECT COUNT(*) AS n_rows, COUNT(*) AS n_ids FROM orders")
def row_ids(t):
    return ranking.row_ids(t.orders).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("row_id").alias("n_ids"))


@check(
    "leaderboard",
    """SELECT n_name, ROUND(m, 4) AS mean_score, ROUND(s, 4) AS std_score, CAST(row_number() OVER (ORDER BY m DESC, n_name) AS INTEGER) AS rank FROM
       (SELECT n_name, AVG(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1 ORDER BY m DESC, n_name LIMIT 10)""",
)
def leaderboard(t):
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    board = ranking.leaderboard(rows, "n_name", "o_totalprice", 10)
    return board.select("n_name", F.round("mean_score", 4).alias("mean_score"), F.round("std_score", 4).alias("std_score"), "rank")


@check(
    "leaderboard_pct_change",
    """WITH r AS (SELECT r_regionkey, r_name, SUM(o_totalprice) AS revenue, AVG(o_totalprice) AS mean FROM orders JOIN customer ON o_custkey = c_custkey
                  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2)
       SELECT r_name, ROUND(revenue, 2) AS revenue, ROUND((revenue - (SELECT revenue FROM r WHERE r_regionkey = 0)) / (SELECT revenue FROM r WHERE r_regionkey = 0) * 100, 6) AS revenue_diff_pct,
              ROUND((mean - (SELECT mean FROM r WHERE r_regionkey = 0)) / (SELECT mean FROM r WHERE r_regionkey = 0) * 100, 6) AS mean_diff_pct FROM r""",
)
def leaderboard_pct_change(t):
    rows = joinable(t).join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).join(t.orders, F.col("o_custkey") == F.col("c_custkey"))
    metrics = rows.groupBy("r_regionkey", "r_name").agg(F.sum("o_totalprice").alias("revenue"), F.avg("o_totalprice").alias("mean"))
    out = ranking.percent_change(metrics, "r_regionkey", ["revenue", "mean"])
    return out.select("r_name", F.round("revenue", 2).alias("revenue"), r6("revenue_diff_pct"), r6("mean_diff_pct"))
