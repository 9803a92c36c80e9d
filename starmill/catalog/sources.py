"""Files and stored tables: written from the given tables, read back whole."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmill.catalog.registry import query, table
from starmill.functions import locale_number, strip_footnote, whole_number
from starmill.sources import (
    FileLedger,
    Tables,
    absent_columns,
    period_of_path,
    read_delimited,
    read_table_export,
    scratch_folder,
    written,
)
from starmill.sources.delimited import LINE, REASON, SOURCE_PATH
from starmill.sources.tables import appended
from starmill.streaming import load_arrived_files, load_new_files


@query(
    "read_delimited",
    """
    SELECT o_orderkey AS order_code, o_orderstatus AS status, 'não ' || o_orderpriority AS label,
           CAST(year(o_orderdate) AS INTEGER) AS period
    FROM orders
    """,
)
def read_delimited_query(spark, folder):
    """One folder per year, latin-1 and ``;``; the period comes from the folder name."""
    orders = table(spark, folder, "orders")
    path = scratch_folder(spark, "delivered")
    orders.select(
        F.concat(F.lit("não "), "o_orderpriority").alias("rótulo"),
        F.col("o_orderkey").alias("CÓDIGO"),
        "o_orderstatus",
        F.concat(F.lit("orders_"), F.year("o_orderdate")).alias("delivery"),
    ).write.partitionBy("delivery").csv(path, sep=";", header=True, encoding="ISO-8859-1")
    names = {"CÓDIGO": "order_code", "o_orderstatus": "status", "rótulo": "label"}
    rows = read_delimited(spark, path, names, encoding="ISO-8859-1")
    return rows.select(
        whole_number(F.col("order_code")).alias("order_code"),
        "status",
        "label",
        period_of_path(F.col(SOURCE_PATH)).alias("period"),
    )


@query(
    "read_two_layouts",
    """
    SELECT s_suppkey AS code, s_name AS name, CAST(s_nationkey AS BIGINT) AS nation FROM supplier
    UNION ALL
    SELECT c_custkey, c_name, nullif(c_nationkey, 3) FROM customer
    """,
)
def read_two_layouts(spark, folder):
    """Two ``,`` deliveries with their columns in different order, one with blanks."""
    paths = [scratch_folder(spark, "suppliers"), scratch_folder(spark, "customers")]
    suppliers = table(spark, folder, "supplier")
    customers = table(spark, folder, "customer")
    suppliers.select(
        F.col("s_suppkey").alias("code"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"),
    ).write.csv(paths[0], header=True)
    customers.select(
        F.coalesce(F.nullif(F.col("c_nationkey"), F.lit(3)).cast("string"), F.lit("NA")).alias(
            "nation"
        ),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("unused"),
        F.col("c_custkey").alias("code"),
    ).write.csv(paths[1], header=True)
    rows = read_delimited(spark, paths, ["code", "name", "nation"], sep=",")
    return rows.select(
        whole_number(F.col("code")).alias("code"),
        "name",
        whole_number(F.col("nation")).alias("nation"),
    )


@query(
    "read_table_export",
    """
    SELECT c_custkey AS town, CAST(c_nationkey AS BIGINT) AS state,
           CAST(trunc(c_acctbal) AS BIGINT) AS quantity
    FROM customer WHERE c_mktsegment <> 'BUILDING'
    """,
)
def read_table_export_query(spark, folder):
    """A title, the header in row two, data, and notes that leave columns empty."""
    names = ["COD. UF", "COD. MUNIC", "POPULAÇÃO ESTIMADA"]
    path = scratch_folder(spark, "exported")
    customers = table(spark, folder, "customer")
    shown = F.translate(F.format_number("c_acctbal", 2), ",.", ".,")
    noted = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey").cast("string"))
    data = customers.select(
        F.col("c_nationkey").cast("string").alias(names[0]),
        noted.alias(names[1]),
        F.concat(shown, F.lit(" (2)")).alias(names[2]),
    )
    heading = spark.createDataFrame([("ESTIMATIVAS", None, None), tuple(names)], data.schema)
    heading.coalesce(1).unionByName(data).write.csv(path, sep=";")
    rows = read_table_export(spark, path, names)
    state, town, quantity = (F.col(f"`{n}`") for n in names)
    return rows.select(
        whole_number(town).alias("town"),
        whole_number(state).alias("state"),
        locale_number(strip_footnote(quantity)).alias("quantity"),
    )


@query(
    "full_refresh",
    """
    SELECT s_suppkey, upper(s_name) AS s_name, 'second' AS load FROM supplier
    UNION ALL SELECT c_custkey, c_name, 'added' FROM customer
    """,
)
def full_refresh(spark, folder):
    """Absent table read as empty, written, replaced from itself, and added to."""
    tables = Tables(spark, scratch_folder(spark, "tables"))
    schema = "s_suppkey bigint, s_name string, load string"
    suppliers = table(spark, folder, "supplier").select(
        "s_suppkey", "s_name", F.lit("first").alias("load")
    )
    first = tables.replace("supplier", appended(tables.read("supplier", schema), suppliers))
    tables.replace(
        "supplier",
        first.select(
            "s_suppkey", F.upper("s_name").alias("s_name"), F.lit("second").alias("load")
        ),
    )
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("s_suppkey"),
        F.col("c_name").alias("s_name"),
        F.lit("added").alias("load"),
    )
    tables.append("supplier", customers)
    return tables.read("supplier", schema)


@query(
    "incremental_replay",
    """
    SELECT event_id, event_type, strftime(ts, 'events_%Y%m%d') AS delivery,
           CASE WHEN day(ts) = 2 THEN 2 ELSE 1 END AS delivered
    FROM events
    """,
)
def incremental_replay(spark, folder):
    """All days delivered once, one of them again: the second replaces the first."""
    tables = Tables(spark, scratch_folder(spark, "tables"))
    events = table(spark, folder, "events").select(
        "event_id",
        "event_type",
        F.concat(F.lit("events_"), F.date_format("ts", "yyyyMMdd")).alias("delivery"),
    )
    tables.replace_deliveries("events", events.withColumn("delivered", F.lit(1)), "delivery")
    again = events.filter(F.col("delivery").endswith("02")).withColumn("delivered", F.lit(2))
    tables.replace_deliveries("events", again, "delivery")
    schema = "event_id bigint, event_type string, delivered int, delivery string"
    return tables.read("events", schema)


@query(
    "stream_new_files",
    """
    SELECT event_id, event_type, 'events_' || strftime(ts, '%d') AS delivery FROM events
    """,
)
def stream_new_files(spark, folder):
    """Each day's folder arrives in two runs, then all its files under a new checkpoint."""
    tables = Tables(spark, scratch_folder(spark, "tables"))
    path = scratch_folder(spark, "arrived")
    events = table(spark, folder, "events").select(
        "event_id",
        "event_type",
        (F.minute("ts") < 30).alias("early"),
        F.concat(F.lit("events_"), F.date_format("ts", "dd")).alias("delivery"),
    )

    def deliver(rows):
        rows.drop("early").write.mode("append").partitionBy("delivery").csv(
            path, sep=";", header=True
        )

    def load(batch):
        rows = batch.select(
            whole_number(F.col("event_id")).alias("event_id"),
            "event_type",
            F.col(SOURCE_PATH).alias("delivery"),
        )
        tables.replace_deliveries("events", rows, "delivery")

    def run(checkpoint):
        columns = {c: c for c in ("event_id", "event_type")}
        load_new_files(spark, path, columns, load, checkpoint)

    checkpoint = scratch_folder(spark, "stream")
    deliver(events.filter("early"))
    run(checkpoint)
    deliver(events.filter("NOT early"))
    run(checkpoint)
    run(scratch_folder(spark, "stream"))
    stored = tables.read("events", "event_id bigint, event_type string, delivery string")
    day = F.regexp_extract("delivery", r"delivery=([^/]*)/", 1)
    return stored.withColumn("delivery", day)


def _deliver(spark, lines, name, folder):
    """One file per name in a folder: written by Spark, then put in place under its own name,
    over the file that may be there."""
    path = scratch_folder(spark, "delivering")
    lines.repartition(name).write.partitionBy(name).text(path)
    jvm = spark._jvm
    files = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for part in files.globStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/{name}=*/part-*")):
        source = part.getPath()
        target = jvm.org.apache.hadoop.fs.Path(f"{folder}/{source.getParent().getName().split('=')[1]}")
        files.mkdirs(target.getParent())
        files.delete(target, False)
        files.rename(source, target)


def _file_of(rows, header, line, name):
    """One row per file, its text under a header. A file here holds one chunk of rows."""
    lines = F.array_join(F.sort_array(F.collect_list(line)), "\n")
    return rows.groupBy(name).agg(F.concat(F.lit(header + "\n"), lines).alias("value"))


@query(
    "read_ragged_rows",
    """
    WITH lines AS (
      SELECT *, year(o_orderdate) % 2 = 1 AS odd, CAST(o_orderkey AS VARCHAR) AS code,
             replace(o_orderpriority, '-', ';') AS spread
      FROM orders)
    SELECT o_orderkey AS code, o_orderstatus AS status,
           CASE WHEN odd THEN o_orderpriority ELSE spread END AS priority,
           CASE WHEN odd AND o_orderstatus = 'P' THEN 'missing fields'
                WHEN odd AND o_orderpriority = '5-LOW' THEN 'surplus fields'
                WHEN NOT odd AND o_orderstatus = 'F' THEN 'surplus fields' END AS reason,
           CASE WHEN odd AND o_orderstatus = 'P'
                THEN code || ';' || o_orderstatus || ';' || o_orderpriority
                WHEN odd AND o_orderpriority = '5-LOW'
                THEN code || ';' || o_orderstatus || ';' || o_orderpriority || ';' || o_custkey || ';x'
                WHEN NOT odd AND o_orderstatus = 'F'
                THEN '"' || spread || '";' || code || ';' || o_orderstatus || ';"a;b"' END AS line
    FROM lines
    """,
)
def read_ragged_rows(spark, folder):
    """Files of two layouts in one scan; rows of too few or too many fields are told apart."""
    path = scratch_folder(spark, "delivered")
    orders = table(spark, folder, "orders").withColumn(
        "file", F.concat(F.lit("orders_"), F.floor(F.col("o_orderkey") / 10_000), F.lit(".csv"))
    )
    odd = F.year("o_orderdate") % 2 == 1
    code = F.col("o_orderkey").cast("string")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    first = F.concat_ws(
        ";", code, status, priority,
        F.when(status != "P", F.col("o_custkey").cast("string")),
        F.when((status != "P") & (priority == "5-LOW"), "x"),
    )
    quoted = F.concat(F.lit('"'), F.translate(priority, "-", ";"), F.lit('"'))
    second = F.concat_ws(";", quoted, code, status, F.when(status == "F", '"a;b"'))
    _deliver(spark, _file_of(orders.filter(odd), "code;status;priority;customer", first, "file"), "file", path + "/a")
    _deliver(spark, _file_of(orders.filter(~odd), '"priority";code;status', second, "file"), "file", path + "/b")
    names = ["code", "status", "priority"]
    rows = read_delimited(spark, [path + "/a", path + "/b"], names, ragged="mark")
    return rows.select(
        whole_number(F.col("code")).alias("code"),
        "status",
        "priority",
        F.col(REASON).alias("reason"),
        F.col(LINE).alias("line"),
    )


@query(
    "stream_corrected_file",
    """
    SELECT event_id, CASE WHEN day(ts) = 2 THEN upper(event_type) ELSE event_type END AS event_type,
           strftime(ts, 'events_%d.csv') AS delivery
    FROM events WHERE day(ts) <> 3 AND (day(ts) <> 2 OR user_id % 2 = 0)
    """,
)
def stream_corrected_file(spark, folder):
    """A file per day, in two column orders; then one is corrected and one emptied under
    its path. Unchanged files are not read again."""
    tables = Tables(spark, scratch_folder(spark, "tables"))
    path = scratch_folder(spark, "arrived")
    ledger = FileLedger(spark, scratch_folder(spark, "ledger"))
    checkpoint = scratch_folder(spark, "stream")
    events = table(spark, folder, "events").withColumn("day", F.dayofmonth("ts")).withColumn(
        "file", F.date_format("ts", "'events_'dd'.csv'")
    )
    number, kind = F.col("event_id").cast("string"), F.col("event_type")

    def load(rows, delivered):
        typed = rows.select(
            whole_number(F.col("event_id")).alias("event_id"),
            "event_type",
            F.col(SOURCE_PATH).alias("delivery"),
        )
        typed = written(typed, "typed")
        left = {r[0] for r in typed.select("delivery").distinct().collect()}  # one row per file
        tables.replace_deliveries("events", typed, "delivery", set(delivered) - left)

    def run():
        columns = {c: c for c in ("event_id", "event_type")}
        return load_arrived_files(spark, path, columns, load, checkpoint, ledger)

    odd = F.col("day") % 2 == 1
    _deliver(spark, _file_of(events.filter(odd), "event_id;event_type", F.concat_ws(";", number, kind), "file"), "file", path)
    _deliver(spark, _file_of(events.filter(~odd), "event_type;event_id", F.concat_ws(";", kind, number), "file"), "file", path)
    run()
    corrected = events.filter("day = 2 AND user_id % 2 = 0")
    corrected = _file_of(corrected, "event_id;event_type", F.concat_ws(";", number, F.upper(kind)), "file")
    emptied = events.filter("day = 3").select("file", F.lit("event_id;event_type").alias("value")).distinct()
    _deliver(spark, corrected.unionByName(emptied), "file", path)
    changed = run()
    if len(changed) != 2 or run():
        raise AssertionError(f"read again: {changed}")
    stored = tables.read("events", "event_id bigint, event_type string, delivery string")
    return stored.withColumn("delivery", F.regexp_extract("delivery", "[^/]*$", 0))


@query(
    "required_columns",
    """
    SELECT DISTINCT 'orders_' || year(o_orderdate) || '.csv' AS file,
           unnest(CASE WHEN year(o_orderdate) % 3 = 0 THEN ['status', 'priority']
                       WHEN year(o_orderdate) % 3 = 1 THEN ['status'] ELSE [] END) AS column_name
    FROM orders
    """,
)
def required_columns(spark, folder):
    """Columns that the header of each yearly file lacks; reading such a file would stop."""
    path = scratch_folder(spark, "delivered")
    orders = table(spark, folder, "orders").withColumn("year", F.year("o_orderdate"))
    orders = orders.withColumn("file", F.concat(F.lit("orders_"), "year", F.lit(".csv")))
    code, priority = F.col("o_orderkey").cast("string"), F.col("o_orderpriority")
    headers = {0: "code", 1: "priority;code", 2: "code;status;priority"}
    values = {0: [code], 1: [priority, code], 2: [code, F.col("o_orderstatus"), priority]}
    for kind, header in headers.items():
        rows = orders.filter(F.col("year") % 3 == kind)
        _deliver(spark, _file_of(rows, header, F.concat_ws(";", *values[kind]), "file"), "file", path)
    lacking = absent_columns(spark, path, ["code", "status", "priority"])
    return lacking.select(F.regexp_extract(SOURCE_PATH, "[^/]*$", 0).alias("file"), "column_name")
