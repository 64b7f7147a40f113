"""Change feeds and merges.

The feed is made of the given tables. Orders are the full load, but those in progress arrive
as inserts on their day. Each line item is a change to its order: returned items delete it,
accepted ones update its price, new ones insert it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import changes
from millrace.operators.aggregates import count_by
from millrace.plans.registry import query
from millrace.session import new_folder
from millrace.sources.tables import stored, table

KEYS = ["ID"]
ORDER = ["cdcTime", "seq"]
BUCKETS = 16


def loaded_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") == "P", "I").alias("Op"),
        F.col("o_orderkey").alias("ID"),
        F.col("o_orderdate").alias("cdcTime"),
        F.lit(0).alias("seq"),
        F.col("o_orderpriority").alias("AKEY"),
        F.col("o_totalprice").alias("price"),
    )


def feed(spark, sf_dir):
    flag = F.col("l_returnflag")
    changed = table(spark, sf_dir, "lineitem").select(
        F.when(flag == "R", "D").when(flag == "A", "U").otherwise("I").alias("Op"),
        F.col("l_orderkey").alias("ID"),
        F.col("l_shipdate").alias("cdcTime"),
        F.col("l_linenumber").alias("seq"),
        F.col("l_linestatus").alias("AKEY"),
        F.col("l_extendedprice").alias("price"),
    )
    return loaded_orders(spark, sf_dir).unionByName(changed)


FEED_SQL = """feed AS (
    SELECT CASE WHEN o_orderstatus = 'P' THEN 'I' END AS op, o_orderkey AS id,
        o_orderdate AS cdctime, 0 AS seq, o_orderpriority AS akey, o_totalprice AS price
    FROM orders
    UNION ALL
    SELECT CASE l_returnflag WHEN 'R' THEN 'D' WHEN 'A' THEN 'U' ELSE 'I' END, l_orderkey,
        l_shipdate, l_linenumber, l_linestatus, l_extendedprice FROM lineitem)"""
COLUMNS_SQL = """op AS "Op", id AS "ID", cdctime AS "cdcTime", seq, akey AS "AKEY", price"""


def flat(df):
    fields = ["ID", "cdcTime", "seq", "AKEY", "price"]
    return df.select("Op", *[F.col(f"value.{c}").alias(c) for c in fields])


@query(f"""WITH {FEED_SQL} SELECT {COLUMNS_SQL},
        coalesce(CAST(op = 'D' AS VARCHAR), 'unknown') AS deleted, op IS NOT NULL AS changed
    FROM feed""")
def cdc_split(spark, sf_dir):
    load, changed = changes.split_feed(feed(spark, sf_dir), KEYS)
    both = load.withColumn("changed", F.lit(False)).unionByName(
        changed.withColumn("changed", F.lit(True))
    )
    # The flag has three values: true, false, and NULL where there is no operation.
    flag = F.coalesce(F.col("deleted").cast("string"), F.lit("unknown"))
    return both.select("Op", "value.*", "changed").withColumn("deleted", flag)


@query(f"""WITH {FEED_SQL} SELECT {COLUMNS_SQL} FROM feed WHERE op = 'U' QUALIFY row_number()
    OVER (PARTITION BY id ORDER BY cdctime DESC, seq DESC, akey DESC, price DESC) = 1""")
def cdc_latest_struct(spark, sf_dir):
    # ID is first in the struct and constant within a key, so cdcTime decides.
    return flat(changes.latest_by_struct(updates(spark, sf_dir)))


def updates(spark, sf_dir):
    _, changed = changes.split_feed(feed(spark, sf_dir), KEYS)
    return changed.filter(F.col("Op") == "U")


LATEST_UPDATES_SQL = f"""latest AS (SELECT * FROM feed WHERE op = 'U' QUALIFY row_number()
    OVER (PARTITION BY id ORDER BY cdctime DESC, seq DESC, akey DESC, price DESC) = 1)"""


@query(f"WITH {FEED_SQL}, {LATEST_UPDATES_SQL} SELECT {COLUMNS_SQL} FROM latest")
def cdc_latest_by_time(spark, sf_dir):
    return flat(changes.latest_by(updates(spark, sf_dir), ORDER))


def change_rows(spark, sf_dir):
    _, changed = changes.split_feed(feed(spark, sf_dir), KEYS)
    newest = changes.latest_by(changed.filter(F.col("Op") == "U"), ORDER)
    return changes.change_set(changed, newest, ORDER, ordered=True)


@query(f"""WITH {FEED_SQL}, {LATEST_UPDATES_SQL} SELECT {COLUMNS_SQL} FROM
    (SELECT * FROM latest UNION ALL SELECT * FROM feed WHERE op IN ('I', 'D'))""")
def cdc_changes(spark, sf_dir):
    return flat(change_rows(spark, sf_dir))


def merged(spark, sf_dir):
    load, changed = changes.split_feed(feed(spark, sf_dir), KEYS)
    return changes.merge_changes(load, changed, ORDER, on_conflict="latest")


# The changes of a key in feed order: nothing up to its last delete matters. Afterwards a row
# that is there takes its last update; a row that is not there starts with the first insert
# and takes the last update that follows it. At equal cdctime and seq a delete comes first,
# then inserts, then updates, each by akey and price.
MERGE_STEPS_SQL = """
    ordered AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY cdctime, seq,
            CASE op WHEN 'D' THEN 0 WHEN 'I' THEN 1 ELSE 2 END, akey, price) AS pos
        FROM feed WHERE op IS NOT NULL),
    marked AS (SELECT *, coalesce(max(pos) FILTER (WHERE op = 'D') OVER (PARTITION BY id), 0)
        AS gone FROM ordered),
    rest AS (SELECT * FROM marked WHERE pos > gone),
    start AS (
        SELECT op, id, cdctime, seq, akey, price, 0 AS pos FROM feed
        WHERE op IS NULL AND id NOT IN (SELECT id FROM marked WHERE gone > 0)
        UNION ALL
        SELECT op, id, cdctime, seq, akey, price, pos FROM rest
        WHERE op = 'I' AND (gone > 0 OR id NOT IN (SELECT id FROM feed WHERE op IS NULL))
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY pos) = 1),
    final_update AS (SELECT r.* FROM rest r JOIN start s ON r.id = s.id AND r.pos > s.pos
        WHERE r.op = 'U' QUALIFY row_number() OVER (PARTITION BY r.id ORDER BY r.pos DESC) = 1),
    merged AS (
        SELECT * EXCLUDE pos FROM start WHERE id NOT IN (SELECT id FROM final_update)
        UNION ALL
        SELECT s.op, u.id, u.cdctime, u.seq, u.akey, u.price
        FROM start s JOIN final_update u ON s.id = u.id)"""
MERGED_SQL = f"{FEED_SQL}, {MERGE_STEPS_SQL}"


@query(f"WITH {MERGED_SQL} SELECT {COLUMNS_SQL} FROM merged")
def cdc_merge(spark, sf_dir):
    return flat(merged(spark, sf_dir))


@query(f"WITH {MERGED_SQL} SELECT {COLUMNS_SQL} FROM merged")
def cdc_merge_buckets(spark, sf_dir):
    """The same merge into a table laid out by key, of which only changed buckets are rewritten."""
    load, changed = changes.split_feed(feed(spark, sf_dir), KEYS)
    path = new_folder(spark, "buckets")
    changes.write_buckets(load, path, BUCKETS)
    changes.merge_buckets(spark, path, changed, ORDER, BUCKETS, on_conflict="latest")
    return flat(changes.read_buckets(spark, path))


SUPPLIER_FEED_SQL = """feed AS (
    SELECT CASE WHEN s_suppkey % 3 = 0 THEN 'I' END AS op, s_suppkey AS id,
        TIMESTAMP '1970-01-01' AS cdctime, 0::BIGINT AS seq, s_name AS akey, s_acctbal AS price
    FROM supplier
    UNION ALL
    SELECT CASE l_returnflag WHEN 'R' THEN 'D' WHEN 'A' THEN 'U' ELSE 'I' END, l_suppkey,
        l_shipdate, l_orderkey * 8 + l_linenumber, l_linestatus, l_extendedprice FROM lineitem)"""


@query(f"WITH {SUPPLIER_FEED_SQL}, {MERGE_STEPS_SQL} SELECT {COLUMNS_SQL} FROM merged")
def cdc_merge_by_key(spark, sf_dir):
    """Few keys with many changes each: every line item changes its supplier.

    Each third supplier is not in the target but the first insert of the feed.
    """
    loaded = table(spark, sf_dir, "supplier").select(
        F.when(F.col("s_suppkey") % 3 == 0, "I").alias("Op"),
        F.col("s_suppkey").alias("ID"),
        F.lit("1970-01-01").cast("timestamp_ntz").alias("cdcTime"),
        F.lit(0).cast("long").alias("seq"),
        F.col("s_name").alias("AKEY"),
        F.col("s_acctbal").alias("price"),
    )
    flag = F.col("l_returnflag")
    changed = table(spark, sf_dir, "lineitem").select(
        F.when(flag == "R", "D").when(flag == "A", "U").otherwise("I").alias("Op"),
        F.col("l_suppkey").alias("ID"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("cdcTime"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("long").alias("seq"),
        F.col("l_linestatus").alias("AKEY"),
        F.col("l_extendedprice").alias("price"),
    )
    load, rows = changes.split_feed(loaded.unionByName(changed), KEYS)
    return flat(changes.merge_changes(load, rows, ORDER, on_conflict="latest"))


@query(f"WITH {MERGED_SQL} SELECT {COLUMNS_SQL} FROM merged WHERE akey = 'F'")
def cdc_view(spark, sf_dir):
    view = changes.newest_first(merged(spark, sf_dir), "cdcTime", F.col("value.AKEY") == "F")
    return view.drop("deleted")


@query(f"""WITH {MERGED_SQL} SELECT op AS "Op", count(*) AS count FROM merged GROUP BY op""")
def cdc_op_counts(spark, sf_dir):
    return count_by(merged(spark, sf_dir), "Op")


@query(
    """SELECT o_orderkey AS "ID", o_orderdate AS "cdcTime", o_orderpriority AS "AKEY" FROM orders"""
)
def feed_without_op(spark, sf_dir):
    """A feed without operations is a full load; it becomes the first snapshot."""
    plain = loaded_orders(spark, sf_dir).select("ID", "cdcTime", "AKEY")
    load, changed = changes.split_feed(plain, KEYS)
    assert changed is None
    return stored(load, "snapshot")
