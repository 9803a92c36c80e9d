"""Keys, lookups and dimension loads."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from starmill.catalog.registry import query, table
from starmill.functions.dates import PRESENTED_STAMP
from starmill.functions.values import UNKNOWN_KEY, UNKNOWN_LABEL
from starmill.operators.dimensions import (
    Level,
    audit,
    calendar_between,
    code_list,
    flatten_chain,
    flatten_star,
    hierarchy,
    insert_unseen,
    merge,
    new_members,
    unknown_values,
    upsert,
    year_dimension,
)
from starmill.operators.lookups import (
    Lookup,
    flag_lookup,
    join_large,
    join_spreading_heavy,
    resolve,
    resolve_or_drop,
)
from starmill.operators.numbering import number_rows, with_unknown
from starmill.sources.tables import empty, stamped

STAMP = datetime(2024, 5, 1, 12, 30)


@query(
    "dense_keys",
    """
    SELECT row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR))) AS sk, o_orderkey
    FROM orders
    """,
)
def dense_keys(spark, folder):
    """Keys from 1 in the order of a hash, without one task seeing all rows."""
    orders = table(spark, folder, "orders").select("o_orderkey")
    coded = orders.withColumn("code", F.md5(F.col("o_orderkey").cast("string")))
    return number_rows(coded, ["code"], "sk").drop("code")


def _members(orders):
    """(customer, priority) pairs as member codes, with the day of each order."""
    code = F.concat_ws("/", F.col("o_custkey").cast("string"), "o_orderpriority")
    return orders.select(code.alias("code"), "o_custkey", "o_orderpriority", "o_orderdate")


@query(
    "append_new_members",
    """
    WITH pairs AS (
      SELECT CAST(o_custkey AS VARCHAR) || '/' || o_orderpriority AS code, o_custkey,
             min(o_orderdate) < TIMESTAMP '1998-01-01' AS was_known
      FROM orders GROUP BY ALL),
    numbered AS (
      SELECT *, row_number() OVER (ORDER BY NOT was_known, code) AS sk FROM pairs)
    SELECT sk, code, o_custkey FROM numbered
    """,
)
def append_new_members(spark, folder):
    """Members of all orders appended to a dimension that knows those up to 1997."""
    orders = table(spark, folder, "orders")
    members = _members(orders)
    before = members.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    known = number_rows(before.select("code", "o_custkey").distinct(), ["code"], "sk")
    added = new_members(known, members.select("code", "o_custkey"), "code", "sk")
    return known.select("sk", "code", "o_custkey").unionByName(
        added.select("sk", "code", "o_custkey")
    )


@query(
    "lookup_unknown",
    """
    SELECT o_orderkey,
           CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE -1 END AS BIGINT)
             AS status_key,
           CAST(CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 1 WHEN '2' THEN 2 WHEN '3' THEN 3
                ELSE -1 END AS BIGINT) AS priority_key
    FROM orders
    """,
)
def lookup_unknown(spark, folder):
    """Two lookups against short code lists, one of text and one of integer codes."""
    orders = table(spark, folder, "orders")
    statuses = code_list(
        spark, [("F", "Finished"), ("O", "Open")], "status_key bigint, code string, label string"
    )
    statuses = with_unknown(statuses, "status_key", {"code": "-1", "label": UNKNOWN_LABEL})
    priorities = code_list(spark, [(1,), (2,), (3,)], "priority_key bigint, code bigint")
    coded = orders.select(
        "o_orderkey", "o_orderstatus", F.substring("o_orderpriority", 1, 1).alias("priority")
    )
    keyed = resolve(
        coded,
        [
            Lookup(statuses, "o_orderstatus", "code", "status_key", "status_key"),
            Lookup(priorities, "priority", "code", "priority_key", "priority_key"),
        ],
    )
    return keyed.select("o_orderkey", "status_key", "priority_key")


@query(
    "inner_lookup",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, p_brand, CAST(l_quantity AS BIGINT) AS quantity
    FROM lineitem JOIN part ON l_partkey = p_partkey
    WHERE p_type IN ('ECONOMY', 'SMALL') AND l_returnflag <> 'A'
    """,
)
def inner_lookup(spark, folder):
    """Rows with a missing field leave, then rows whose part is not in the list."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.nullif(F.col("l_returnflag"), F.lit("A")).alias("flag"),
    )
    parts = table(spark, folder, "part").filter(F.col("p_type").isin("ECONOMY", "SMALL"))
    listed = Lookup(parts, "l_partkey", "p_partkey", "p_brand", "p_brand")
    return resolve_or_drop(lines.dropna("any").drop("flag"), listed)


@query(
    "flag_lookup",
    """
    WITH flags AS (
      SELECT s_nationkey, max(CASE WHEN s_acctbal > 9000 THEN 1 ELSE 0 END) AS flag
      FROM supplier GROUP BY 1)
    SELECT c_custkey, CAST(coalesce(flag, 0) AS INTEGER) AS is_rich
    FROM customer LEFT JOIN flags ON c_nationkey = s_nationkey
    """,
)
def flag_lookup_query(spark, folder):
    """Flag from a list in which a code repeats and some codes are absent."""
    suppliers = table(spark, folder, "supplier")
    flags = suppliers.select("s_nationkey", (F.col("s_acctbal") > 9000).cast("int").alias("rich"))
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    flagged = flag_lookup(customers, "c_nationkey", flags, "s_nationkey", "rich", "is_rich")
    return flagged.drop("c_nationkey")


@query(
    "heavy_key_join",
    """
    SELECT e.event_id, e.user_key, u.n_events, u.first_day
    FROM (SELECT event_id,
                 CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN -1 WHEN 'click' THEN -1
                      ELSE user_id END AS user_key FROM events) e
    LEFT JOIN (SELECT user_id, count(*) AS n_events, CAST(min(ts) AS DATE) AS first_day
               FROM events GROUP BY 1
               UNION ALL SELECT -1, 0, NULL) u
      ON e.user_key = u.user_id
    """,
)
def heavy_key_join(spark, folder):
    """Large join in which one key and the missing key hold most rows."""
    events = table(spark, folder, "events")
    kind = F.col("event_type")
    key = F.when(kind.isin("view", "click"), F.lit(-1)).when(kind != "error", F.col("user_id"))
    facts = events.select("event_id", key.cast("bigint").alias("user_key"))
    users = events.groupBy("user_id").agg(
        F.count("*").alias("n_events"), F.min(F.col("ts").cast("date")).alias("first_day")
    )
    users = with_unknown(users, "user_id", {"n_events": 0})
    return join_spreading_heavy(facts, users, "user_key", "user_id", ["event_id"])


def _catalogue(orders, first_day, last_day):
    """(customer, status) codes with the priority of the latest order in a period."""
    code = F.concat_ws("/", F.col("o_custkey").cast("string"), "o_orderstatus")
    day = F.col("o_orderdate")
    period = (day >= F.lit(first_day).cast("timestamp_ntz")) & (
        day < F.lit(last_day).cast("timestamp_ntz")
    )
    latest = F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey"))
    return orders.filter(period).groupBy(code.alias("code")).agg(latest.alias("label"))


_MERGE_SQL = """
    WITH coded AS (
      SELECT CAST(o_custkey AS VARCHAR) || '/' || o_orderstatus AS code, o_orderpriority,
             o_orderdate, o_orderkey,
             CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 't' ELSE 's' END AS side
      FROM orders),
    latest AS (
      SELECT side, code, o_orderpriority AS label FROM coded
      QUALIFY row_number() OVER (
        PARTITION BY side, code ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
    target AS (
      SELECT code, label, row_number() OVER (ORDER BY code) AS sk FROM latest WHERE side = 't'),
    source AS (SELECT code, label FROM latest WHERE side = 's'),
    merged AS (
      SELECT t.sk, t.code, coalesce(s.label, t.label) AS label,
             CASE WHEN s.label <> t.label THEN 'update' ELSE 'keep' END AS action
      FROM target t LEFT JOIN source s USING (code)
      UNION ALL
      SELECT (SELECT max(sk) FROM target) + row_number() OVER (ORDER BY code), code, label,
             'insert'
      FROM source WHERE code NOT IN (SELECT code FROM target))
"""


def _merged(spark, folder):
    orders = table(spark, folder, "orders")
    target = number_rows(_catalogue(orders, "1900-01-01", "1998-01-01"), ["code"], "sk")
    source = _catalogue(orders, "1998-01-01", "2100-01-01")
    return merge(target, source, "code", "sk", ["label"])


@query("merge_insert_update", _MERGE_SQL + "SELECT sk, code, label, action FROM merged")
def merge_insert_update(spark, folder):
    """Catalogue as of 1997 merged with what the later orders say."""
    return _merged(spark, folder)


@query("merge_audit", _MERGE_SQL + "SELECT action, count(*) AS n_rows FROM merged GROUP BY 1")
def merge_audit(spark, folder):
    return audit(_merged(spark, folder))


@query(
    "domain_insert_ignore",
    """
    WITH existing AS (
      SELECT code, row_number() OVER (ORDER BY code) AS sk, code || '!' AS label
      FROM (SELECT DISTINCT o_orderpriority AS code FROM orders))
    SELECT sk, code, label FROM existing
    UNION ALL SELECT (SELECT max(sk) FROM existing) + 1, '6-WHENEVER', 'Whenever'
    UNION ALL SELECT (SELECT max(sk) FROM existing) + 2, '7-NEVER', 'Never'
    UNION ALL SELECT -1, '-1', 'Não Informado'
    """,
)
def domain_insert_ignore(spark, folder):
    """Code list added to the codes in use; loaded twice, it changes nothing more."""
    orders = table(spark, folder, "orders")
    used = orders.select(F.col("o_orderpriority").alias("code")).distinct()
    existing = number_rows(used, ["code"], "sk").withColumn("label", F.concat("code", F.lit("!")))
    existing = existing.select("sk", "code", "label")
    rows = code_list(
        spark,
        [("1-URGENT", "Urgent"), ("6-WHENEVER", "Whenever"), ("7-NEVER", "Never")],
        "position bigint, code string, label string",
    ).drop("position")
    unknown = {"code": str(UNKNOWN_KEY), "label": UNKNOWN_LABEL}
    once = with_unknown(insert_unseen(existing, rows, "code", "sk"), "sk", unknown)
    return with_unknown(insert_unseen(once, rows, "code", "sk"), "sk", unknown)


@query(
    "domain_upsert",
    """
    WITH existing AS (
      SELECT row_number() OVER (ORDER BY code) AS sk, code, 'old' AS label
      FROM (SELECT DISTINCT c_mktsegment AS code FROM customer)),
    listed AS (
      SELECT * FROM (VALUES (1, 'CARS', 'Cars'), (2, 'HOUSES', 'Houses')) v(sk, code, label))
    SELECT CAST(sk AS BIGINT) AS sk, code, label FROM listed
    UNION ALL SELECT sk, code, label FROM existing WHERE sk NOT IN (SELECT sk FROM listed)
    UNION ALL SELECT -1, '-1', 'Não Informado'
    """,
)
def domain_upsert(spark, folder):
    """Code list keyed by position over the segments in use."""
    customers = table(spark, folder, "customer")
    used = customers.select(F.col("c_mktsegment").alias("code")).distinct()
    existing = number_rows(used, ["code"], "sk").withColumn("label", F.lit("old"))
    rows = code_list(
        spark, [("CARS", "Cars"), ("HOUSES", "Houses")], "sk bigint, code string, label string"
    )
    unknown = {"code": str(UNKNOWN_KEY), "label": UNKNOWN_LABEL}
    return with_unknown(upsert(existing, rows, "sk"), "sk", unknown)


@query(
    "hierarchy_build",
    """
    WITH regions AS (
      SELECT row_number() OVER (ORDER BY r_name) AS sk, r_regionkey AS code, r_name AS name,
             CAST(NULL AS BIGINT) AS parent_sk FROM region),
    nations AS (
      SELECT row_number() OVER (ORDER BY n_name) AS sk, n_nationkey AS code, n_name AS name,
             coalesce(r.sk, -1) AS parent_sk
      FROM nation LEFT JOIN regions r ON r.code = nullif(n_regionkey, 4)),
    towns AS (
      SELECT row_number() OVER (ORDER BY c_custkey) AS sk, c_custkey AS code, c_name AS name,
             n.sk AS parent_sk FROM customer JOIN nations n ON n.code = c_nationkey)
    SELECT 'region' AS level, sk, CAST(code AS BIGINT) AS code, name, parent_sk FROM regions
    UNION ALL SELECT 'nation', sk, code, name, parent_sk FROM nations
    UNION ALL SELECT 'customer', sk, code, name, parent_sk FROM towns
    UNION ALL SELECT 'region', -1, -1, 'Não Informado', NULL
    UNION ALL SELECT 'nation', -1, -1, 'Não Informado', -1
    UNION ALL SELECT 'customer', -1, -1, 'Não Informado', -1
    """,
)
def hierarchy_build(spark, folder):
    """Three levels; the nations of one region have no known parent."""
    regions = table(spark, folder, "region").select(
        F.col("r_regionkey").cast("bigint").alias("region_code"), F.col("r_name").alias("name")
    )
    nations = table(spark, folder, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("nation_code"),
        F.col("n_name").alias("name"),
        F.nullif(F.col("n_regionkey"), F.lit(4)).cast("bigint").alias("region_code"),
    )
    towns = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("town_code"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").cast("bigint").alias("nation_code"),
    )

    def none(columns):
        return empty(spark, columns)

    levels = [
        Level(
            regions,
            none("region_key bigint, region_code bigint, name string"),
            "region_code",
            "region_key",
            ["name"],
            order_by=["name"],
        ),
        Level(
            nations,
            none("nation_key bigint, nation_code bigint, name string, region_key bigint"),
            "nation_code",
            "nation_key",
            ["name"],
            parent_code="region_code",
            order_by=["name"],
        ),
        Level(
            towns,
            none("town_key bigint, town_code bigint, name string, nation_key bigint"),
            "town_code",
            "town_key",
            ["name"],
            parent_code="nation_code",
        ),
    ]
    result = None
    names = ["region", "nation", "customer"]
    parent_keys = [None, "region_key", "nation_key"]
    for name, parent, level, built in zip(names, parent_keys, levels, hierarchy(levels)):
        codes = [level.code] + ([parent] if parent else [])
        whole = with_unknown(built, level.key, unknown_values(codes, ["name"]))
        rows = whole.select(
            F.lit(name).alias("level"),
            F.col(level.key).alias("sk"),
            F.col(level.code).alias("code"),
            "name",
            (F.col(parent) if parent else F.lit(None).cast("bigint")).alias("parent_sk"),
        )
        result = rows if result is None else result.unionByName(rows)
    return result


@query(
    "copy_dimension",
    "SELECT s_suppkey, s_name, '01-05-2024 12:30' AS loaded FROM supplier",
)
def copy_dimension(spark, folder):
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_name")
    copied = stamped(suppliers, STAMP, "loaded")
    return copied.withColumn("loaded", F.date_format("loaded", PRESENTED_STAMP))


@query(
    "flatten_place",
    """
    SELECT c_custkey, c_name, n_nationkey, n_name, r_regionkey, r_name
    FROM customer JOIN nation ON c_nationkey = n_nationkey
                  JOIN region ON n_regionkey = r_regionkey
    """,
)
def flatten_place(spark, folder):
    towns = table(spark, folder, "customer").select(
        "c_custkey", "c_name", F.col("c_nationkey").alias("n_nationkey")
    )
    nations = table(spark, folder, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    regions = table(spark, folder, "region")
    flat = flatten_chain(towns, [(nations, "n_nationkey"), (regions, "r_regionkey")])
    return flat.select("c_custkey", "c_name", "n_nationkey", "n_name", "r_regionkey", "r_name")


@query(
    "flatten_person",
    """
    SELECT c_custkey, coalesce(n_name, 'Não Informado') AS nation_label,
           coalesce(n_nationkey, -1) AS nation_code,
           coalesce(segment, 'Não Informado') AS segment_label
    FROM customer
    LEFT JOIN nation ON n_nationkey = nullif(c_nationkey, 7) AND n_regionkey <> 0
    LEFT JOIN (SELECT DISTINCT c_mktsegment AS segment FROM customer
               WHERE c_mktsegment <> 'BUILDING') s
      ON segment = c_mktsegment
    """,
)
def flatten_person(spark, folder):
    """Attribute labels by left join; some keys are missing and some have no row."""
    customers = table(spark, folder, "customer")
    people = customers.select(
        "c_custkey",
        F.nullif(F.col("c_nationkey"), F.lit(7)).alias("nation_key"),
        F.col("c_mktsegment").alias("segment_key"),
    )
    nations = table(spark, folder, "nation").filter(F.col("n_regionkey") != 0)
    segments = customers.select("c_mktsegment").distinct().filter("c_mktsegment <> 'BUILDING'")
    flat = flatten_star(
        people,
        [
            (
                "nation_key",
                nations,
                "n_nationkey",
                {
                    "nation_label": ("n_name", UNKNOWN_LABEL),
                    "nation_code": ("n_nationkey", UNKNOWN_KEY),
                },
            ),
            (
                "segment_key",
                segments,
                "c_mktsegment",
                {"segment_label": ("c_mktsegment", UNKNOWN_LABEL)},
            ),
        ],
    )
    return flat.drop("nation_key", "segment_key")


@query(
    "role_play",
    """
    SELECT coalesce(a.n_name, 'Não Informado') AS sold_from,
           coalesce(b.n_name, 'Não Informado') AS sold_to, count(*) AS n_lines
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation a ON a.n_nationkey = nullif(s_nationkey, 24)
    LEFT JOIN nation b ON b.n_nationkey = nullif(c_nationkey, 24)
    GROUP BY 1, 2
    """,
)
def role_play(spark, folder):
    """One nation table in two roles, over counts per pair of keys."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    # Lines per (order, supplier's nation) first: the join with orders then moves counts.
    sold = (
        join_large(lines, suppliers, "l_suppkey", "s_suppkey", how="inner")
        .groupBy("l_orderkey", "s_nationkey")
        .agg(F.count("*").alias("n"))
    )
    buyers = join_large(orders, customers, "o_custkey", "c_custkey", ["o_orderkey"], "inner")
    pairs = (
        sold.join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(
            F.nullif(F.col("s_nationkey"), F.lit(24)).alias("from_key"),
            F.nullif(F.col("c_nationkey"), F.lit(24)).alias("to_key"),
        )
        .agg(F.sum("n").alias("n_lines"))
    )
    nations = table(spark, folder, "nation")
    flat = flatten_star(
        pairs,
        [
            ("from_key", nations, "n_nationkey", {"sold_from": ("n_name", UNKNOWN_LABEL)}),
            ("to_key", nations, "n_nationkey", {"sold_to": ("n_name", UNKNOWN_LABEL)}),
        ],
    )
    return flat.select("sold_from", "sold_to", "n_lines")


@query(
    "year_dimension",
    """
    SELECT row_number() OVER (ORDER BY year) AS year_key, year
    FROM (SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem)
    """,
)
def year_dimension_query(spark, folder):
    lines = table(spark, folder, "lineitem")
    return year_dimension(lines.select(F.year("l_shipdate").alias("year")), "year", "year_key")


@query(
    "calendar",
    """
    WITH ends AS (
      SELECT CAST(min(o_orderdate) AS DATE) AS first, CAST(max(o_orderdate) AS DATE) AS last
      FROM orders),
    days AS (
      SELECT first, CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS day
      FROM ends)
    SELECT CAST(date_diff('day', first, day) + 1 AS BIGINT) AS day_key, day,
           strftime(day, '%d') AS day_of_month, strftime(day, '%m') AS month,
           strftime(day, '%Y') AS year,
           strftime(day, '%d-%m') IN ('01-01', '21-04', '01-05', '07-09', '25-12') AS is_holiday
    FROM days
    """,
)
def calendar_query(spark, folder):
    """Calendar over the days of the orders; the holidays are a table of days."""
    orders = table(spark, folder, "orders")
    ends = orders.agg(
        F.min(F.col("o_orderdate").cast("date")).alias("first"),
        F.max(F.col("o_orderdate").cast("date")).alias("last"),
    )
    fixed = [(1, 1), (4, 21), (5, 1), (9, 7), (12, 25)]
    years = ends.select(F.explode(F.sequence(F.year("first"), F.year("last"))).alias("year"))
    holidays = years.select(
        F.explode(
            F.array(*[F.make_date("year", F.lit(month), F.lit(day)) for month, day in fixed])
        ).alias("holiday")
    )
    days = calendar_between(ends, "first", "last", holidays)
    return days
