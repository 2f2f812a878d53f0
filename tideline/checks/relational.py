"""Scans, recodes, joins and aggregates."""

import uuid

from pyspark.sql import functions as F

from tideline.checks.registry import Tables, big, check, r6
from tideline.functions import dates, numeric, text
from tideline.operators import aggregates, columns, diff, joins, ranking, snapshots
from tideline.session import work_dir
from tideline.sources import files, tables


def scratch(t: Tables, label: str) -> str:
    return f"{work_dir(t.spark)}/tideline/checks/{label}-{uuid.uuid4().hex}"


# -- scans, sources, sinks ----------------------------------------------------


@check(
    "scan_project_filter",
    """SELECT o_orderkey AS order_id, o_orderpriority AS priority, o_totalprice FROM orders
       WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""",
)
def scan_project_filter(t):
    return tables.read_table(
        t.orders,
        columns=["o_orderkey", "o_orderpriority", "o_totalprice", "no_such_column"],
        filter_key="o_orderpriority",
        filter_values=["1-URGENT", "2-HIGH"],
        rename={"o_orderkey": "order_id", "o_orderpriority": "priority"},
    )


@check(
    "scan_where",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P' AND o_totalprice > 250000",
)
def scan_where(t):
    return tables.read_table(
        t.orders, columns=["o_orderkey", "o_orderstatus"], where="WHERE o_orderstatus <> 'P' AND o_totalprice > 250000"
    )


@check(
    "scan_key_table",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')",
)
def scan_key_table(t):
    keys = t.customer.where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    return tables.read_table(t.orders, columns=["o_orderkey", "o_custkey"], filter_key="o_custkey", filter_values=keys)


@check("scan_milliseconds", "SELECT event_id, CAST(epoch_us(ts) // 1000 * 1000 AS BIGINT) AS us FROM events")
def scan_milliseconds(t):
    cut = tables.read_table(t.events, columns=["event_id", "ts"], cut_timestamps=True)
    return cut.select("event_id", F.unix_micros("ts").alias("us"))


@check("probe_read", "SELECT COUNT(*) AS n_rows FROM (SELECT * FROM orders LIMIT 1)")
def probe_read(t):
    return tables.read_table(t.orders, limit=1).agg(F.count(F.lit(1)).alias("n_rows"))


@check("csv_round_trip", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def csv_round_trip(t):
    path = scratch(t, "csv")
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal")
    files.write_csv(rows, path)
    return files.read_csv(t.spark, path, rows.schema)


@check("stage_hand_off", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def stage_hand_off(t):
    rows = t.orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice")
    path = scratch(t, "stage")
    files.write_stage(rows, path)
    return tables.from_warehouse_or_file(t.spark, lambda: t.orders, path)


@check("record_files", "SELECT event_id, user_id, event_type FROM events")
def record_files(t):
    path = scratch(t, "records")
    records = t.events.select("event_id", "user_id", "event_type")
    records.select(F.to_json(F.struct(F.array(F.struct("*")).alias("data"))).alias("value")).write.text(path)
    return files.read_record_files(t.spark, path, records.schema)


@check(
    "align_schema",
    """SELECT CAST(c_acctbal AS VARCHAR) IS NOT NULL AS has_balance, CAST(c_custkey AS DOUBLE) AS c_custkey,
              0 AS absent, c_mktsegment FROM customer""",
)
def align_schema(t):
    wanted = t.customer.select(
        F.col("c_custkey").cast("double").alias("c_custkey"), F.lit(0).alias("absent"), "c_mktsegment", "c_acctbal"
    )
    path = scratch(t, "schema")
    files.save_schema(wanted, path)
    aligned = columns.align_to_schema(t.customer, files.load_schema(t.spark, path))
    return aligned.select(F.col("c_acctbal").isNotNull().alias("has_balance"), "c_custkey", "absent", "c_mktsegment")


# -- recodes and projections --------------------------------------------------


@check(
    "recode_map_default",
    """SELECT c_custkey,
              CASE c_mktsegment WHEN 'BUILDING' THEN 'Building' WHEN 'MACHINERY' THEN 'Machines' ELSE 'Unknown' END AS segment,
              COALESCE(r_name, 'none') AS region_name,
              CASE n_regionkey WHEN 0 THEN 'South' WHEN 1 THEN 'West' WHEN 3 THEN 'North' END AS side,
              ROUND(CASE WHEN c_mktsegment = 'MACHINERY' THEN c_acctbal * 0.134 ELSE c_acctbal END, 6) AS balance
       FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
       LEFT JOIN region ON n_regionkey = r_regionkey AND r_regionkey < 3""",
)
def recode_map_default(t):
    known = t.region.where("r_regionkey < 3")
    rows = joins.lookup(t.customer, t.nation, "c_nationkey", "n_nationkey", "n_regionkey", "regionkey")
    rows = joins.lookup(rows, known, "regionkey", "r_regionkey", "r_name", "region_name", "none")
    currency = F.when(F.col("c_mktsegment") == "MACHINERY", "DKK")
    return rows.select(
        "c_custkey",
        columns.recode(F.col("c_mktsegment"), {"BUILDING": "Building", "MACHINERY": "Machines"}).alias("segment"),
        "region_name",
        text.map_values(F.col("regionkey"), {0: "South", 1: "West", 3: "North"}).alias("side"),
        r6(numeric.krone_to_euro(F.col("c_acctbal"), currency), "balance"),
    )


@check(
    "label_from_stage",
    "SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'P') THEN 1 ELSE 0 END AS target FROM orders",
)
def label_from_stage(t):
    return columns.label_from_stage(t.orders, "o_orderstatus", ["F", "P"]).select("o_orderkey", "target")


@check(
    "rank_labels",
    """SELECT event_id, CASE event_type WHEN 'purchase' THEN '1. Purchase' WHEN 'signup' THEN '2. Signup' WHEN 'click' THEN '3. Click' END AS ranked,
              CASE WHEN event_type = 'error' THEN 'view' ELSE event_type END AS merged,
              CASE WHEN event_type IN ('purchase', 'signup') THEN 1 ELSE 0 END AS reached FROM events""",
)
def rank_labels(t):
    kind = F.col("event_type")
    return t.events.select(
        "event_id",
        text.map_values(kind, {"purchase": "1. Purchase", "signup": "2. Signup", "click": "3. Click"}).alias("ranked"),
        text.merge_value(kind, "error", "view").alias("merged"),
        columns.member_flag(kind, ["purchase", "signup"]).alias("reached"),
    )


@check(
    "scale_listed_keys",
    """SELECT o_orderkey, ROUND(CASE WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
              THEN o_totalprice * 0.134 ELSE o_totalprice END, 6) AS o_totalprice FROM orders""",
)
def scale_listed_keys(t):
    listed = t.customer.where("c_acctbal < 0").select("c_custkey")
    rows = joins.scale_listed(t.orders, "o_custkey", "o_totalprice", listed, numeric.KRONE_IN_EURO)
    return rows.select("o_orderkey", r6("o_totalprice"))


@check(
    "integers_only",
    """SELECT event_id, CAST(string_split(event_type || '|' || CAST(user_id AS VARCHAR), '|')[2] AS BIGINT) AS owner FROM events
       WHERE event_type <> 'error'""",
)
def integers_only(t):
    owner = F.when(F.col("event_type") == "error", "not a number").otherwise(F.col("user_id").cast("string"))
    return columns.integers_only(t.events.withColumn("owner", owner), "owner").select("event_id", "owner")


@check(
    "column_selection",
    """SELECT COUNT(*) AS n_rows, CAST(SUM(p_size) AS BIGINT) AS sizes, ROUND(SUM(p_retailprice), 2) AS prices FROM part""",
)
def column_selection(t):
    """Sparse, null and duplicate columns go; numeric ones stay."""
    part = t.part.withColumns({"empty": F.lit(None).cast("string"), "hole": F.nullif(F.col("p_size"), F.lit(1))})
    doubled = part.select("*", F.col("p_size"))
    kept = columns.drop_sparse(doubled, threshold=1, drop=["p_name", "no_such_column"])
    kept = columns.only_numeric(columns.without_null_columns(kept))
    kept = columns.select_present(kept, ["p_retailprice", "p_size", "hole", "empty", "p_name"])
    names = kept.columns
    assert names == ["p_retailprice", "p_size"], names
    return kept.agg(
        F.count(F.lit(1)).alias("n_rows"), big(F.sum("p_size"), "sizes"), F.round(F.sum("p_retailprice"), 2).alias("prices")
    )


@check(
    "column_names",
    "SELECT n_nationkey AS a_key, n_name AS a_key_1, n_regionkey AS region_, 0 AS expected FROM nation",
)
def column_names(t):
    odd = t.nation.toDF("a key", "a  key", "region%")
    clean = columns.sanitize_names(columns.ensure_columns(odd, ["expected", "a key"]))
    return columns.move_last(clean, ["a_key"])


@check(
    "type_changes",
    """SELECT event_id, CAST(floor(value) AS INTEGER) AS whole, TRY_CAST(event_type AS INTEGER) AS failed,
              CASE WHEN value > 50 THEN 1 ELSE 0 END AS large FROM events""",
)
def type_changes(t):
    rows = t.events.select(
        "event_id", F.floor("value").cast("string").alias("whole"), F.col("event_type").alias("failed"),
        (F.col("value") > 50).alias("large"),
    )
    return columns.booleans_to_int(columns.change_types(rows, {"whole": "int", "failed": "int"}))


STAGE_IDS = [("17-a", "Closed Won", "Learn"), ("18", "Closed Won", "Work"), ("19", "Closed Lost", None), ("20", "Closed Lost", "Work")]


@check(
    "stage_times",
    """WITH s AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS won_learn,
                         CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 1 DAY END AS won_work,
                         CASE WHEN o_orderstatus = 'O' THEN o_orderdate END AS lost_work,
                         CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE o_custkey * 3600000 END AS ms FROM orders)
       SELECT o_orderkey, CAST(epoch(COALESCE(won_learn, won_work)) AS BIGINT) AS won_at,
              CAST(epoch(lost_work) AS BIGINT) AS lost_at,
              ROUND(CASE WHEN ms > 0 THEN ms / 86400000.0 END, 6) AS closed_won_time_in_days FROM s""",
)
def stage_times(t):
    """Per-stage columns renamed by a lookup table and merged over pipelines."""
    status, day = F.col("o_orderstatus"), F.col("o_orderdate").cast("timestamp")
    raw = t.orders.select(
        "o_orderkey",
        F.when(status == "F", day).alias("hs_date_entered_17_a"),
        F.when(status != "O", day + F.expr("INTERVAL 1 DAY")).alias("hs_date_entered_18_9931"),
        F.when(status == "O", day).alias("hs_date_entered_20"),
        F.when(F.col("o_custkey") % 3 == 0, 0).otherwise(F.col("o_custkey") * 3_600_000).alias("hs_time_in_17_a"),
    )
    stages = t.spark.createDataFrame(STAGE_IDS, "stage_id string, stage_name string, pipeline_label string")
    merged = columns.merge_stage_columns(raw, stages)
    return merged.select(
        "o_orderkey",
        F.unix_seconds("closed_won_entered").alias("won_at"),
        F.unix_seconds("closed_lost_entered").alias("lost_at"),
        r6("closed_won_time_in_days"),
    )


# -- joins -------------------------------------------------------------------


@check(
    "join_suffixes",
    """SELECT o_orderkey, o_custkey, c_custkey, o_orderstatus AS tag, c_mktsegment AS tag_customer
       FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0""",
)
def join_suffixes(t):
    left = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderstatus").alias("tag"))
    right = t.customer.where("c_acctbal > 0").select("c_custkey", F.col("c_mktsegment").alias("tag"))
    return joins.join_with_suffix(left, right, "o_custkey", "c_custkey", suffixes=("", "_customer"))


@check(
    "fan_out_join",
    """SELECT o_orderkey, l_linenumber, p_brand, ROUND(l_quantity, 2) AS l_quantity FROM orders
       LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'R') ON o_orderkey = l_orderkey
       LEFT JOIN part ON l_partkey = p_partkey""",
)
def fan_out_join(t):
    lines = t.lineitem.where(F.col("l_returnflag") == "R").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    wide = joins.join_with_suffix(t.orders.select("o_orderkey"), lines, "o_orderkey", "l_orderkey")
    wide = joins.join_with_suffix(wide, t.part.select("p_partkey", "p_brand"), "l_partkey", "p_partkey")
    return wide.select("o_orderkey", "l_linenumber", "p_brand", F.round("l_quantity", 2).alias("l_quantity"))


@check(
    "semi_anti_exclusions",
    """SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)
       AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')
       AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = c_custkey)""",
)
def semi_anti_exclusions(t):
    big_orders = t.orders.where("o_totalprice > 300000").select("o_custkey")
    urgent = t.orders.where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'").select("o_custkey")
    kept = joins.keep_keys(t.customer, big_orders, "c_custkey")
    return joins.drop_keys(kept, "c_custkey", urgent, t.supplier.select("s_suppkey")).select("c_custkey", "c_name")


@check(
    "composite_semi",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ROUND(l_extendedprice, 2) AS price FROM lineitem
       WHERE (l_partkey, l_suppkey) IN (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_quantity > 49)""",
)
def composite_semi(t):
    pairs = t.lineitem.where("l_quantity > 49").select("l_partkey", "l_suppkey")
    rows = joins.keep_keys(t.lineitem, pairs, ["l_partkey", "l_suppkey"])
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round("l_extendedprice", 2).alias("price"))


@check(
    "key_sides",
    """SELECT COALESCE(a, b) AS custkey, CASE WHEN a IS NULL THEN 'right' WHEN b IS NULL THEN 'left' ELSE 'both' END AS side
       FROM (SELECT DISTINCT c_custkey AS a FROM customer WHERE c_acctbal > 0)
       FULL JOIN (SELECT DISTINCT o_custkey AS b FROM orders WHERE o_orderstatus = 'F') ON a = b""",
)
def key_sides(t):
    left = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("custkey"))
    right = t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("custkey"))
    return joins.compare_keys(left, right, "custkey")


@check(
    "common_keys",
    "SELECT s_nationkey AS nationkey FROM supplier INTERSECT SELECT c_nationkey FROM customer WHERE c_acctbal > 5000",
)
def common_keys(t):
    left = t.supplier.select(F.col("s_nationkey").alias("nationkey"))
    return joins.common_keys(left, t.customer.where("c_acctbal > 5000").select(F.col("c_nationkey").alias("nationkey")), "nationkey")


@check(
    "explode_ids",
    """SELECT DISTINCT TRY_CAST(string_split(item, ':')[1] AS BIGINT) AS id FROM
       (SELECT unnest(string_split(CAST(l_partkey AS VARCHAR) || ':17;' || CAST(l_suppkey AS VARCHAR) || ';x' || l_returnflag || ':1', ';')) AS item
        FROM lineitem) WHERE TRY_CAST(string_split(item, ':')[1] AS BIGINT) IS NOT NULL""",
)
def explode_ids(t):
    packed = F.concat(
        F.col("l_partkey").cast("string"), F.lit(":17;"), F.col("l_suppkey").cast("string"), F.lit(";x"), "l_returnflag", F.lit(":1")
    )
    return joins.split_ids(t.lineitem.select(packed.alias("ids")), "ids")


@check("explode_words", "SELECT DISTINCT unnest(string_split(p_name, ' ')) AS word FROM part")
def explode_words(t):
    return t.part.select(F.explode(text.list_items(F.col("p_name"), " ")).alias("word")).distinct()


@check(
    "union_sets",
    """SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_totalprice > 400000""",
)
def union_sets(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    parts = [rows.where("o_orderstatus = 'F'"), rows.where("o_totalprice > 400000").select(*reversed(rows.columns))]
    return joins.union_all(parts).drop("o_totalprice")


# -- snapshots and per-key rows ------------------------------------------------


@check(
    "latest_snapshot",
    "SELECT event_id, user_id, event_type FROM events WHERE CAST(ts AS DATE) = (SELECT MAX(CAST(ts AS DATE)) FROM events)",
)
def latest_snapshot(t):
    return snapshots.latest_snapshot(t.events, F.to_date("ts")).select("event_id", "user_id", "event_type")


@check(
    "rank_keep_ties",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(epoch(l_shipdate) AS BIGINT) AS shipped FROM
       (SELECT *, rank() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC) AS r FROM lineitem) WHERE r = 1""",
)
def rank_keep_ties(t):
    rows = snapshots.latest_with_ties(t.lineitem, "l_orderkey", "l_shipdate")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", dates.epoch_seconds(F.col("l_shipdate")).alias("shipped"))


@check(
    "latest_per_key",
    """SELECT o_custkey, o_orderkey, ROUND(o_totalprice, 2) AS o_totalprice FROM
       (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1""",
)
def latest_per_key(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    best = snapshots.latest_per_key(rows, ["o_custkey"], "o_orderdate", ["o_orderkey"])
    return best.select("o_custkey", "o_orderkey", F.round("o_totalprice", 2).alias("o_totalprice"))


@check("any_per_key", "SELECT user_id, MAX(event_type) AS event_type FROM events GROUP BY user_id")
def any_per_key(t):
    """One row per key, the same on every run."""
    return snapshots.any_per_key(t.events.select("user_id", "event_type"), ["user_id"])


NEAREST_SQL = """SELECT o_orderkey, o_custkey, anchor, shipped FROM
       (SELECT o_orderkey, o_custkey, a.t AS anchor, s.t AS shipped,
               row_number() OVER (PARTITION BY o_orderkey ORDER BY abs(a.t - s.t), s.t) AS r
        FROM (SELECT o_orderkey, o_custkey, CAST(epoch(o_orderdate) AS BIGINT) AS t FROM orders) a
        JOIN (SELECT DISTINCT l_orderkey, CAST(epoch(l_shipdate) AS BIGINT) AS t FROM lineitem) s ON o_orderkey = l_orderkey)
       WHERE r = 1"""


def _anchors(t):
    return t.orders.select(
        F.col("o_orderkey"), "o_custkey", dates.epoch_seconds(F.col("o_orderdate")).alias("anchor")
    )


@check("nearest_in_time", NEAREST_SQL)
def nearest_in_time(t):
    history = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), dates.epoch_seconds(F.col("l_shipdate")).alias("shipped"))
    return snapshots.nearest_snapshot(_anchors(t), history, "o_orderkey", "anchor", "shipped")


@check(
    "nearest_per_key",
    """WITH e AS (SELECT user_id, CAST(floor(epoch(ts)) AS BIGINT) AS t, event_type, event_id FROM events),
       a AS (SELECT user_id, t, event_id FROM e WHERE event_type = 'purchase'),
       s AS (SELECT DISTINCT user_id, t FROM e WHERE event_type = 'view')
       SELECT user_id, event_id, anchor, seen FROM (
         SELECT a.user_id, a.event_id, a.t AS anchor, s.t AS seen,
                row_number() OVER (PARTITION BY a.user_id ORDER BY abs(a.t - s.t), s.t, a.event_id) AS r
         FROM a JOIN s ON a.user_id = s.user_id) WHERE r = 1""",
)
def nearest_per_key(t):
    e = t.events.select("user_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("t"), "event_type", "event_id")
    purchases = e.where(F.col("event_type") == "purchase").select("user_id", "event_id", F.col("t").alias("anchor"))
    views = e.where(F.col("event_type") == "view").select("user_id", F.col("t").alias("seen"))
    return snapshots.nearest_snapshot(purchases, views, "user_id", "anchor", "seen", per="key", ties=["event_id"])


# -- aggregates and pivots -----------------------------------------------------


@check(
    "count_unique_filtered",
    "SELECT l_suppkey, COUNT(DISTINCT l_orderkey) AS n_orders FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 10 GROUP BY l_suppkey",
)
def count_unique_filtered(t):
    return aggregates.count_unique(t.lineitem, "l_suppkey", "l_orderkey", "n_orders", "l_returnflag = 'R' AND l_quantity > 10")


CALLS_SQL = """SELECT o_custkey, COUNT(DISTINCT l_orderkey) AS n_calls,
              NULLIF(COUNT(DISTINCT CASE WHEN l_returnflag = 'A' THEN l_orderkey END), 0) AS n_calls_positive_outcome,
              NULLIF(COUNT(DISTINCT CASE WHEN l_returnflag <> 'A' THEN l_orderkey END), 0) AS n_calls_negative_outcome,
              NULLIF(COUNT(DISTINCT CASE WHEN l_linestatus = 'F' THEN l_orderkey END), 0) AS n_inbound_calls,
              NULLIF(COUNT(DISTINCT CASE WHEN l_linestatus = 'O' THEN l_orderkey END), 0) AS n_outbound_calls,
              ROUND(AVG(l_quantity), 6) AS avg_call_duration, ROUND(COALESCE(SUM(l_quantity), 0), 6) AS total_call_duration
       FROM (SELECT *, rank() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC) AS r FROM lineitem)
       JOIN orders ON l_orderkey = o_orderkey WHERE r = 1 GROUP BY o_custkey"""


@check("calls_per_customer", CALLS_SQL)
def calls_per_customer(t):
    """Latest lines per order (ties kept), joined and reduced to one row per customer."""
    latest = snapshots.latest_with_ties(t.lineitem, "l_orderkey", "l_shipdate")
    linked = latest.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    out = aggregates.conditional_unique(
        linked,
        "o_custkey",
        "l_orderkey",
        {
            "n_calls": F.lit(True),
            "n_calls_positive_outcome": flag == "A",
            "n_calls_negative_outcome": flag != "A",
            "n_inbound_calls": status == "F",
            "n_outbound_calls": status == "O",
        },
        {"avg_call_duration": ("avg", "l_quantity"), "total_call_duration": ("sum", "l_quantity")},
    )
    return out.withColumns({c: F.round(c, 6) for c in ("avg_call_duration", "total_call_duration")})


@check(
    "conditional_distinct",
    """SELECT l_suppkey, NULLIF(COUNT(DISTINCT l_partkey), 0) AS parts,
              NULLIF(COUNT(DISTINCT CASE WHEN l_returnflag = 'R' AND l_quantity > 45 THEN l_partkey END), 0) AS returned,
              NULLIF(COUNT(DISTINCT CASE WHEN l_linestatus = 'O' THEN l_partkey END), 0) AS open,
              ROUND(AVG(l_extendedprice), 4) AS mean_price, ROUND(SUM(l_extendedprice), 2) AS sum_price
       FROM lineitem GROUP BY l_suppkey""",
)
def conditional_distinct(t):
    out = aggregates.conditional_unique(
        t.lineitem,
        "l_suppkey",
        "l_partkey",
        {
            "parts": F.lit(True),
            "returned": (F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45),
            "open": F.col("l_linestatus") == "O",
        },
        {"mean_price": ("avg", "l_extendedprice"), "sum_price": ("sum", "l_extendedprice")},
    )
    return out.withColumns({"mean_price": F.round("mean_price", 4), "sum_price": F.round("sum_price", 2)})


@check(
    "pivot_distinct",
    """SELECT user_id, COUNT(DISTINCT CASE WHEN event_type = 'click' THEN CAST(ts AS DATE) END) AS days_click,
              COUNT(DISTINCT CASE WHEN event_type = 'purchase' THEN CAST(ts AS DATE) END) AS days_purchase,
              COUNT(DISTINCT CASE WHEN event_type = 'signup' THEN CAST(ts AS DATE) END) AS days_signup,
              CAST(0 AS BIGINT) AS days_refund FROM events GROUP BY user_id""",
)
def pivot_distinct(t):
    rows = t.events.select("user_id", "event_type", F.to_date("ts").alias("day"))
    names = {k: f"days_{k}" for k in ("click", "purchase", "signup")}
    return aggregates.pivot_unique(rows, "user_id", "event_type", "day", names, always=["days_refund"])


@check(
    "pivot_sum",
    """SELECT user_id, ROUND(COALESCE(SUM(CASE WHEN event_type = 'click' THEN value END), 0), 4) AS click,
              ROUND(COALESCE(SUM(CASE WHEN event_type = 'view' THEN value END), 0), 4) AS view FROM events GROUP BY user_id""",
)
def pivot_sum(t):
    wide = aggregates.pivot_unique(t.events, "user_id", "event_type", "value", {"click": "click", "view": "view"}, reduce=F.sum)
    return wide.withColumns({c: F.round(c, 4) for c in ("click", "view")})


@check(
    "frequency_back",
    """WITH a AS (SELECT p_brand, COUNT(*) * 1.0 / (SELECT COUNT(*) FROM part) AS f FROM part GROUP BY 1),
            b AS (SELECT p_brand, COUNT(*) * 1.0 / (SELECT COUNT(*) FROM part WHERE p_size > 48) AS f FROM part WHERE p_size > 48 GROUP BY 1)
       SELECT p_partkey, ROUND(a.f, 6) AS popularity_all, ROUND(b.f, 6) AS popularity
       FROM part LEFT JOIN a USING (p_brand) LEFT JOIN b USING (p_brand)""",
)
def frequency_back(t):
    rows = aggregates.add_frequency(t.part, "p_brand", "popularity_all")
    rows = aggregates.add_frequency(rows, "p_brand", "popularity", F.col("p_size") > 48)
    return rows.select("p_partkey", r6("popularity_all"), r6("popularity"))


@check(
    "contingency",
    """SELECT o_orderpriority, COUNT(*) FILTER (o_orderstatus <> 'F') AS n_0, COUNT(*) FILTER (o_orderstatus = 'F') AS n_1
       FROM orders GROUP BY o_orderpriority""",
)
def contingency(t):
    rows = columns.label_from_stage(t.orders, "o_orderstatus", ["F"])
    return aggregates.contingency(rows, "o_orderpriority", "target")


@check(
    "class_balance",
    """SELECT n AS negatives, p AS positives, ROUND(p * 1.0 / (n + p), 6) AS positive_share, ROUND(p * 1.0 / n, 6) AS imbalance_ratio
       FROM (SELECT COUNT(*) FILTER (toxic = 1) AS p, COUNT(*) FILTER (toxic = 0) AS n FROM labels)""",
)
def class_balance(t):
    row = aggregates.class_balance(t.labels, "toxic")
    return row.select("negatives", "positives", r6("positive_share"), r6("imbalance_ratio"))


@check(
    "duplicate_report",
    """SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) AS duplicate_rows, COUNT(*) AS duplicate_keys
       FROM (SELECT l_orderkey * 10 + l_linenumber AS k, COUNT(*) AS n FROM lineitem GROUP BY 1 HAVING COUNT(*) > 1)""",
)
def duplicate_report(t):
    rows = t.lineitem.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"))
    return aggregates.duplicate_report(rows, "k").select(big("duplicate_rows"), big("duplicate_keys"))


@check(
    "duplicate_keys",
    "SELECT l_orderkey, COUNT(*) AS n_rows FROM lineitem GROUP BY 1 HAVING COUNT(*) > 1 ORDER BY n_rows DESC, l_orderkey LIMIT 5",
)
def duplicate_keys(t):
    return ranking.top_n(aggregates.duplicate_keys(t.lineitem, "l_orderkey"), "n_rows", 5, ["l_orderkey"])


# -- comparison of tables --------------------------------------------------------


def _changed_orders(t):
    """A copy of the orders with some rows missing and some cells changed."""
    key = F.col("o_orderkey")
    rows = t.orders.where(key % 50 != 7)
    return rows.withColumns(
        {
            "o_orderstatus": F.when(key % 20 == 3, "X").otherwise(F.col("o_orderstatus")),
            "o_totalprice": F.when(key % 33 == 1, None).otherwise(F.col("o_totalprice")),
        }
    )


FRAME_DIFF_SQL = """WITH b AS (SELECT o_orderkey AS k, o_custkey AS c, CASE WHEN o_orderkey % 20 = 3 THEN 'X' ELSE o_orderstatus END AS s,
                   CASE WHEN o_orderkey % 33 = 1 THEN NULL ELSE o_totalprice END AS p FROM orders WHERE o_orderkey % 50 <> 7),
       j AS (SELECT * FROM orders JOIN b ON o_orderkey = k)
       SELECT 'o_custkey' AS "column", COUNT(*) AS compared, COUNT(*) FILTER (o_custkey IS DISTINCT FROM c) AS different,
              MIN(o_orderkey) FILTER (o_custkey IS DISTINCT FROM c) AS first_key FROM j
       UNION ALL SELECT 'o_orderstatus', COUNT(*), COUNT(*) FILTER (o_orderstatus IS DISTINCT FROM s), MIN(o_orderkey) FILTER (o_orderstatus IS DISTINCT FROM s) FROM j
       UNION ALL SELECT 'o_totalprice', COUNT(*), COUNT(*) FILTER (o_totalprice IS DISTINCT FROM p), MIN(o_orderkey) FILTER (o_totalprice IS DISTINCT FROM p) FROM j"""


@check("frame_diff", FRAME_DIFF_SQL)
def frame_diff(t):
    names = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    return diff.column_differences(t.orders.select(names), _changed_orders(t).select(names), "o_orderkey")


@check(
    "cell_diff",
    """SELECT o_orderkey, 'o_orderstatus' AS "column", o_orderstatus AS left_value, 'X' AS right_value FROM orders
       WHERE o_orderkey % 50 <> 7 AND o_orderkey % 20 = 3""",
)
def cell_diff(t):
    names = ["o_orderkey", "o_custkey", "o_orderstatus"]
    return diff.cell_differences(t.orders.select(names), _changed_orders(t).select(names), "o_orderkey")


@check(
    "key_overlap",
    """SELECT COUNT(*) FILTER (o_orderkey % 50 <> 7) AS common, COUNT(*) FILTER (o_orderkey % 50 = 7) AS left_only,
              CAST(0 AS BIGINT) AS right_only FROM orders""",
)
def key_overlap(t):
    return diff.key_overlap(t.orders, _changed_orders(t), "o_orderkey")


@check("fingerprint")
def fingerprint(t):
    return diff.fingerprint(t.orders)


@check("fingerprint_same", "SELECT 1 AS same_rows, 1 AS same_hash")
def fingerprint_same(t):
    """Row order and partitioning do not change a fingerprint."""
    a = diff.fingerprint(t.orders)
    b = diff.fingerprint(t.orders.repartition(7, "o_custkey").sort("o_totalprice"))
    return a.select(
        (F.col("n_rows") == b.select("n_rows").scalar()).cast("int").alias("same_rows"),
        (F.col("hash_sum") == b.select("hash_sum").scalar()).cast("int").alias("same_hash"),
    )


# -- row functions -----------------------------------------------------------------


@check(
    "sanitize_text",
    """SELECT doc_id, replace(trim(regexp_replace(lower(source || ' - ' || lang || '!'), '[^a-z0-9]+', ' ', 'g')), ' ', '_') AS slug FROM documents""",
)
def sanitize_text(t):
    raw = F.concat("source", F.lit(" - "), "lang", F.lit("!"))
    return t.documents.select("doc_id", text.sanitize_text(raw).alias("slug"))


@check(
    "duration_text",
    """WITH s AS (SELECT event_id, CAST(floor(value * 1000000 / 1000) AS BIGINT) AS s FROM events),
       u AS (SELECT event_id, s // 86400 AS d, (s % 86400) // 3600 AS h, (s % 3600) // 60 AS m, s % 60 AS x FROM s)
       SELECT event_id, COALESCE(NULLIF(regexp_extract(concat_ws(' ',
           CASE WHEN d > 0 THEN d || ' days' END, CASE WHEN h > 0 THEN h || ' hours' END,
           CASE WHEN m > 0 THEN m || ' minutes' END, CASE WHEN x > 0 THEN x || ' seconds' END),
           '^[0-9]+ [a-z]+( [0-9]+ [a-z]+)?'), ''), '0 seconds') AS lasted
       FROM u""",
)
def duration_text(t):
    return t.events.select("event_id", text.human_duration(F.col("value") * 1_000_000).alias("lasted"))


@check(
    "date_arithmetic",
    """SELECT o_orderkey, CAST(floor((epoch(TIMESTAMP '1998-06-01 12:30:00') - epoch(o_orderdate)) / 86400) AS INTEGER) AS days,
              CAST(epoch(CASE WHEN o_orderstatus = 'F' THEN o_orderdate WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 2 DAY
                    ELSE o_orderdate + INTERVAL 13 HOUR END) AS BIGINT) AS anchored FROM orders""",
)
def date_arithmetic(t):
    day = F.col("o_orderdate").cast("timestamp")
    stage = F.when(F.col("o_orderstatus") == "F", "Closed Won").when(F.col("o_orderstatus") == "P", "Closed Lost")
    at = dates.anchor_date(stage, day, day + F.expr("INTERVAL 2 DAYS"), F.date_format(day, "yyyy-MM-dd"))
    # No stage at all falls through to the start date.
    return t.orders.select(
        "o_orderkey",
        dates.whole_days_between(F.lit("1998-06-01 12:30:00").cast("timestamp"), day).alias("days"),
        dates.epoch_seconds(at).alias("anchored"),
    )


@check(
    "row_functions",
    """SELECT p_partkey, CAST(substr(CAST(p_retailprice AS VARCHAR), 1, 1) AS INTEGER) AS digit,
              CASE WHEN p_size * 9 < 50 THEN 1 WHEN p_size * 9 < 250 THEN 2 ELSE 3 END AS band,
              CASE WHEN p_brand <> p_type THEN 1 ELSE 0 END AS changed,
              ROUND(tanh(p_size / 10.0), 6) AS squashed, ROUND(1 - 1 / (1 + exp(-p_size / 10.0)), 6) AS logistic,
              lower(trim(p_type)) || '_' || lower(p_brand) AS place, p_size + p_retailprice AS combined FROM part""",
)
def row_functions(t):
    size = F.col("p_size")
    return t.part.select(
        "p_partkey",
        text.leading_digit(F.col("p_retailprice")).alias("digit"),
        numeric.company_size_band(size * 9).alias("band"),
        numeric.changed_flag(F.col("p_brand"), F.col("p_type")).alias("changed"),
        r6(numeric.squash_tanh(size / 10), "squashed"),
        r6(numeric.squash_sigmoid(size / 10), "logistic"),
        text.location_key(text.lower_trim(F.col("p_type")), F.lit(None).cast("string"), F.col("p_brand")).alias("place"),
        numeric.sum_ignoring_nulls([size, F.col("p_retailprice")]).alias("combined"),
    )


@check(
    "replace_values",
    """SELECT c_custkey, CASE lower(c_mktsegment) WHEN 'building' THEN 'construction' WHEN 'machinery' THEN 'tools' ELSE lower(c_mktsegment) END AS c_mktsegment,
              CASE c_nationkey WHEN 3 THEN 300 ELSE c_nationkey END AS c_nationkey FROM customer""",
)
def replace_values(t):
    from tideline.operators import encode

    rows = encode.replace_in(
        t.customer, {"c_mktsegment": {"building": "Construction", "machinery": "TOOLS"}, "c_nationkey": {3: 300}}
    )
    return rows.select("c_custkey", "c_mktsegment", "c_nationkey")
