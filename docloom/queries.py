"""One query for each operator over the analytic tables, and the same in SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalogs import engine, orders_with_items
from .engine import Engine
from .plans.errors import QueryError, ValidationError
from .plans.schema import Collection, Field, Global
from .sources.tables import Conflict

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

POLYGON = {"type": "Polygon", "coordinates": [[[-60, -40], [60, -40], [60, 40], [0, 10], [-60, 40], [-60, -40]], [[-10, -20], [10, -20], [10, 0], [-10, 0], [-10, -20]]]}
_KM = "2 * 6371008.8 * asin(least(1.0, sqrt(pow(sin((radians({b}) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians({b})) * pow(sin((radians({a}) - radians(lng)) / 2), 2))))"
_PLACES = "SELECT *, ((s_suppkey * 37) % 360)::DOUBLE - 180 AS lng, ((s_suppkey * 17) % 160)::DOUBLE - 80 AS lat FROM supplier"
_ITEMS = "SELECT *, l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR AS id FROM lineitem"
_TURNS = "SELECT conv_id, turn, role, text, turn = max(turn) OVER (PARTITION BY conv_id) AS latest FROM conversations"
_MAIN = "SELECT conv_id, turn, role, text FROM conversations WHERE turn = 0"


def query(name: str, sql: str) -> Callable:
    """Register a function of an engine as a query with its SQL."""
    def register(f: Callable[[Engine], DataFrame]) -> Callable:
        QUERIES[name] = lambda spark, folder: f(engine(spark, folder))
        ORACLES[name] = sql
        return f
    return register


def filtered(name: str, table: str, where: dict[str, Any], columns: str, condition: str, source: str | None = None) -> None:
    """A query that filters a table, with its SQL condition."""
    names = columns.split()
    query(name, f"SELECT {', '.join(names)} FROM {f'({source})' if source else table} WHERE {condition}")(lambda e: e.matching(table, where).select(*names))


# ------------------------------------------------------------------ leaf operators

O, L, P = "o_orderkey o_orderstatus", "id l_quantity", "p_partkey p_size"
filtered("f_equals", "orders", {"o_orderstatus": {"equals": "F"}}, O, "o_orderstatus = 'F'")
filtered("f_not_equals", "orders", {"o_orderstatus": {"not_equals": "F"}}, O, "o_orderstatus IS NULL OR o_orderstatus <> 'F'")
filtered("f_greater_than", "lineitem", {"l_quantity": {"greater_than": "30"}}, L, "l_quantity > 30", _ITEMS)
filtered("f_greater_than_equal", "lineitem", {"l_quantity": {"greater_than_equal": 30}}, L, "l_quantity >= 30", _ITEMS)
filtered("f_less_than", "lineitem", {"l_quantity": {"less_than": "0x10"}}, L, "l_quantity < 16", _ITEMS)
filtered("f_less_than_equal", "lineitem", {"l_quantity": {"less_than_equal": " 12 "}}, L, "l_quantity <= 12", _ITEMS)
filtered("f_date_string", "orders", {"o_orderdate": {"greater_than_equal": "1997-01-01"}}, O, "o_orderdate >= TIMESTAMP '1997-01-01'")
filtered("f_date_epoch", "orders", {"o_orderdate": {"less_than": 852076800000}}, O, "o_orderdate < TIMESTAMP '1997-01-01'")
filtered("f_exists_text", "customer", {"c_name": {"exists": "true"}}, "c_custkey c_name", "c_name IS NOT NULL AND c_name <> ''")
filtered("f_not_exists", "documents", {"title.fr": {"exists": False}}, "doc_id lang", "NOT (lang = 'fr' AND text IS NOT NULL AND text <> '')")
filtered("f_in_list", "part", {"p_size": {"in": "1, 5,9"}}, P, "p_size IN (1, 5, 9)")
filtered("f_in_empty", "part", {"or": [{"p_size": {"in": []}}, {"p_size": {"equals": 5}}]}, P, "p_size = 5")
filtered("f_not_in", "part", {"p_size": {"not_in": [1, 2, "3"]}}, P, "p_size IS NULL OR p_size NOT IN (1, 2, 3)")
filtered("f_not_in_empty", "part", {"p_size": {"not_in": [], "greater_than": 40}}, P, "p_size > 40")
filtered("f_like", "part", {"p_name": {"like": "E"}}, "p_partkey p_name", "contains(lower(p_name), 'e')")
filtered("f_not_like", "part", {"p_name": {"not_like": "A"}}, "p_partkey p_name", "p_name IS NULL OR NOT contains(lower(p_name), 'a')")
filtered("f_not_like_empty", "part", {"or": [{"p_name": {"not_like": ""}}, {"p_size": {"less_than": 4}}]}, "p_partkey p_name", "p_size < 4")
filtered("f_contains_number", "part", {"p_size": {"contains": "4"}}, P, "contains(p_size::VARCHAR, '4')")
filtered("f_contains_any", "customer", {"c_mktsegment": {"contains": ["auto", "MACH"]}}, "c_custkey c_mktsegment", "contains(lower(c_mktsegment), 'auto') OR contains(lower(c_mktsegment), 'mach')")
filtered("f_contains_relation", "orders", {"o_custkey": {"contains": "7"}}, "o_orderkey o_custkey", "o_custkey = 7")
filtered("f_type_mismatch", "lineitem", {"or": [{"l_quantity": {"equals": "many"}}, {"l_quantity": {"equals": "49"}}]}, L, "l_quantity = 49", _ITEMS)
filtered("f_negative_mismatch", "part", {"p_size": {"not_equals": "10d", "less_than_equal": 10}}, P, "p_size <= 10")
filtered("geo_near", "supplier", {"place": {"near": "13.4,20.5,6000000,500000"}}, "s_suppkey", f"{_KM.format(a=13.4, b=20.5)} BETWEEN 500000 AND 6000000", _PLACES)
_EDGES = "(CASE WHEN ({y1} > lat) <> ({y2} > lat) AND lng < ({x2} - {x1}) * (lat - {y1}) / ({y2} - {y1})::DOUBLE + {x1} THEN 1 ELSE 0 END)"


def _ring(ring: list) -> str:
    edges = [_EDGES.format(x1=f"({a[0]})", y1=f"({a[1]})", x2=f"({b[0]})", y2=f"({b[1]})") for a, b in zip(ring, ring[-1:] + ring[:-1]) if a[1] != b[1]]
    return f"(({' + '.join(edges)}) % 2 = 1)"


filtered("geo_within", "supplier", {"place": {"within": POLYGON}}, "s_suppkey", f"{_ring(POLYGON['coordinates'][0])} AND NOT {_ring(POLYGON['coordinates'][1])}", _PLACES)
filtered("geo_intersects", "supplier", {"place": {"intersects": {"type": "Point", "coordinates": [-106, -46]}}}, "s_suppkey", "lng = -106 AND lat = -46", _PLACES)

# ------------------------------------------------------------------ combinators and paths

filtered("b_and_or", "lineitem", {"or": [{"and": [{"l_returnflag": {"equals": "R"}}, {"l_quantity": {"greater_than": 40}}]}, {"l_discount": {"less_than": 0.01, "greater_than_equal": 0}}], "l_linestatus": {"not_equals": "O"}},
         "id l_returnflag", "((l_returnflag = 'R' AND l_quantity > 40) OR (l_discount < 0.01 AND l_discount >= 0)) AND l_linestatus <> 'O'", _ITEMS)
filtered("b_or_empty", "part", {"or": [], "and": [], "p_size": {"in": "7"}}, P, "p_size = 7")
filtered("path_list_greater", "embeddings", {"embedding": {"greater_than": 0.4}}, "vec_id label", "list_max(embedding) > 0.4")
filtered("path_json", "events", {"or": [{"props.k": {"greater_than": "50"}}, {"event_type": {"equals": "view"}}]}, "event_id event_type", "event_type = 'view'")
filtered("path_json_number", "events", {"props.k": {"greater_than": 50}, "event_type": {"not_equals": "view"}}, "event_id event_type", "CAST(props->>'k' AS INT) > 50 AND event_type <> 'view'")


def _orders(e: Engine, folder: str) -> Engine:
    return e.put("orders", lambda: orders_with_items(e.spark, folder))


def on_items(name: str, where: dict[str, Any], condition: str) -> None:
    """A query over orders with their items inside."""
    QUERIES[name] = lambda spark, folder: _orders(engine(spark, folder), folder).matching("orders", where).select("o_orderkey", "o_orderstatus")
    ORACLES[name] = f"SELECT o_orderkey, o_orderstatus FROM orders o WHERE {condition}"


_OF = "SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey"
on_items("path_items_any", {"items.quantity": {"greater_than": 49}}, f"EXISTS ({_OF} AND l_quantity > 49)")
on_items("path_items_none", {"items.flag": {"not_in": ["R", "A"]}}, f"NOT EXISTS ({_OF} AND l_returnflag IN ('R', 'A'))")
on_items("path_list_none", {"parts": {"not_in": [3, "7", 11]}}, f"NOT EXISTS ({_OF} AND l_partkey IN (3, 7, 11))")
on_items("path_items_all", {"items.flag": {"all": "R,A"}}, f"EXISTS ({_OF} AND l_returnflag = 'R') AND EXISTS ({_OF} AND l_returnflag = 'A')")
on_items("path_items_exists", {"items.flag": {"exists": False}}, f"NOT EXISTS ({_OF} AND l_returnflag IS NOT NULL)")
on_items("hop_through_list", {"items.part.p_size": {"equals": 7}}, "EXISTS (SELECT 1 FROM lineitem l JOIN part p ON p_partkey = l_partkey WHERE l_orderkey = o.o_orderkey AND p_size = 7)")
on_items("hop_has_many", {"or": [{"parts.p_size": {"equals": 3}}, {"o_totalprice": {"greater_than": 400000}}]}, "o_totalprice > 400000 OR EXISTS (SELECT 1 FROM lineitem l JOIN part p ON p_partkey = l_partkey WHERE l_orderkey = o.o_orderkey AND p_size = 3)")

# ------------------------------------------------------------------ relationships

filtered("hop_one", "orders", {"o_custkey.c_mktsegment": {"equals": "BUILDING"}}, O, "o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
filtered("hop_two", "customer", {"c_nationkey.n_regionkey.r_name": {"like": "asi"}}, "c_custkey c_name",
         "c_nationkey IN (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE contains(lower(r_name), 'asi'))")
filtered("hop_three", "lineitem", {"l_orderkey.o_custkey.c_nationkey.n_name": {"not_equals": "NATION_1"}, "l_quantity": {"greater_than": 48}}, L,
         "l_quantity > 48 AND l_orderkey IN (SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE n_name <> 'NATION_1')", _ITEMS)
filtered("hop_or", "orders", {"or": [{"o_custkey.c_acctbal": {"less_than": 0}}, {"o_totalprice": {"greater_than": 300000}}]}, O,
         "o_totalprice > 300000 OR o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
filtered("hop_id", "orders", {"o_custkey.id": {"in": "5,6,7"}}, O, "o_custkey IN (5, 6, 7)")
filtered("hop_negative", "orders", {"o_custkey.c_mktsegment": {"not_equals": "BUILDING"}}, O, "o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment IS NULL OR c_mktsegment <> 'BUILDING')")

# ------------------------------------------------------------------ join fields

query("join_topk", """SELECT o_custkey AS parent, rank, 'orders' AS "relationTo", o_orderkey::VARCHAR AS child FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey::VARCHAR DESC)::INT AS rank FROM orders) WHERE rank <= 2""")(
    lambda e: e.join_rows_df("customer", "orders", {"limit": 2}))
query("join_page", """SELECT o_custkey AS parent, rank, 'orders' AS "relationTo", o_orderkey::VARCHAR AS child FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey::VARCHAR)::INT AS rank FROM orders WHERE o_orderstatus <> 'P') WHERE rank > 3 AND rank <= 6""")(
    lambda e: e.join_rows_df("customer", "orders", {"limit": 3, "page": 2, "sort": "o_orderdate", "where": {"o_orderstatus": {"not_equals": "P"}}}))
query("join_count", """SELECT c_custkey, coalesce(n, 0)::BIGINT AS total, coalesce(n, 0) > 1 AS more, coalesce(top, '') AS first FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, arg_max(o_orderkey, o_totalprice)::VARCHAR AS top FROM orders WHERE o_totalprice > 100000 GROUP BY 1) ON c_custkey = o_custkey""")(
    lambda e: e._joined("customer", e.frame("customer"), {"orders": {"limit": 1, "count": True, "where": {"o_totalprice": {"greater_than": "100000"}}}}, None).select(
        "c_custkey", F.col("orders.totalDocs").alias("total"), F.col("orders.hasNextPage").alias("more"), F.coalesce(F.get("orders.docs", F.lit(0)).cast("string"), F.lit("")).alias("first")))
query("join_polymorphic", """WITH u AS (SELECT c_nationkey AS parent, 0 AS place, 'customer' AS r, c_custkey AS k, c_acctbal AS s FROM customer UNION ALL SELECT s_nationkey, 1, 'supplier', s_suppkey, s_acctbal FROM supplier),
    n AS (SELECT *, row_number() OVER (PARTITION BY parent ORDER BY place, s DESC, k::VARCHAR DESC)::INT AS rank FROM u) SELECT parent, rank, r AS "relationTo", k::VARCHAR AS child FROM n WHERE rank <= 60""")(
    lambda e: e.join_rows_df("nation", "partners", {"limit": 60}))
query("join_polymorphic_narrow", """WITH n AS (SELECT s_nationkey AS parent, s_suppkey AS k, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey::VARCHAR DESC)::INT AS rank FROM supplier) SELECT parent, rank, 'supplier' AS "relationTo", k::VARCHAR AS child FROM n WHERE rank <= 3""")(
    lambda e: e.join_rows_df("nation", "partners", {"where": {"relationTo": {"equals": "supplier"}}}))

# ------------------------------------------------------------------ sorting, distinct, counting

query("sort_page", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey::VARCHAR LIMIT 25 OFFSET 50")(
    lambda e: e.find_df("orders", {"o_orderstatus": {"equals": "O"}}, ["o_orderpriority", "-o_totalprice"], 25, 3).select("o_orderkey", "o_orderpriority", "o_totalprice"))
query("sort_default", "SELECT p_partkey, p_name FROM part ORDER BY p_partkey::VARCHAR LIMIT 10 OFFSET 10")(lambda e: e.find_df("part", page=2).select("p_partkey", "p_name"))
query("sort_ties_descending", "SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderstatus DESC, o_orderkey::VARCHAR DESC LIMIT 20")(lambda e: e.find_df("orders", sort="-o_orderstatus", limit=20).select("o_orderkey", "o_orderstatus"))
query("distinct_field", "SELECT DISTINCT o_orderpriority AS value FROM orders")(lambda e: e.distinct_df("orders", "o_orderpriority", limit=0))
query("distinct_where", "SELECT DISTINCT p_size AS value FROM part WHERE p_retailprice > 980 ORDER BY 1 DESC LIMIT 10")(lambda e: e.distinct_df("part", "p_size", {"p_retailprice": {"greater_than": 980}}, "-p_size"))
query("count_where", """SELECT count(*) AS "totalDocs" FROM lineitem WHERE l_shipdate < TIMESTAMP '1995-06-17' AND l_returnflag IN ('A', 'R')""")(
    lambda e: e.count_df("lineitem", {"l_shipdate": {"less_than": "1995-06-17"}, "l_returnflag": {"in": ["A", "R"]}}))
query("count_all", """SELECT count(*) AS "totalDocs" FROM lineitem""")(lambda e: e.count_df("lineitem"))
query("find_by_id", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey = 42")(lambda e: e.find_df("orders", {"id": {"equals": "42"}}).select("o_orderkey", "o_totalprice"))
query("find_ids", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (1, 2, 3, 99999999)")(lambda e: e.find_df("orders", {"id": {"in": "1,2,3,99999999"}}).select("o_orderkey", "o_totalprice"))
query("find_first", "SELECT c_custkey, c_name FROM customer WHERE c_acctbal < 0 ORDER BY c_custkey::VARCHAR LIMIT 1")(lambda e: e.first_df("customer", {"c_acctbal": {"less_than": 0}}).select("c_custkey", "c_name"))

# ------------------------------------------------------------------ versions, drafts, locales

query("versions_find", f"SELECT conv_id AS parent, turn FROM ({_TURNS}) WHERE role = 'user' AND turn > 1")(
    lambda e: e.find_versions_df("conversations", {"version.role": {"equals": "user"}, "version.turn": {"greater_than": "1"}}, limit=0).select("parent", "version.turn"))
query("versions_latest", f"SELECT conv_id AS parent, turn, role FROM ({_TURNS}) WHERE latest")(
    lambda e: e.latest_version_df("conversations").select("parent", "version.turn", "version.role"))
query("versions_count", f"""SELECT count(*) AS "totalDocs" FROM ({_TURNS}) WHERE latest AND role <> 'user'""")(
    lambda e: e.count_df("conversations_versions", {"latest": {"equals": "true"}, "version.role": {"not_equals": "user"}}))
query("drafts_overlay", f"SELECT conv_id, turn, role FROM ({_TURNS}) WHERE latest AND role = 'assistant' UNION ALL SELECT m.conv_id, turn, role FROM ({_MAIN}) m WHERE role = 'assistant' AND conv_id NOT IN (SELECT conv_id FROM conversations)")(
    lambda e: e.query_drafts_df("conversations", {"version.role": {"equals": "assistant"}}, limit=0).select("conv_id", "turn", "role"))
query("drafts_supplement", f"WITH m AS ({_MAIN}), f AS (SELECT conv_id, turn, role FROM m WHERE turn = 0 AND role = 'user') SELECT * FROM f UNION ALL SELECT conv_id, turn, role FROM ({_TURNS}) WHERE latest AND role = 'user' AND conv_id NOT IN (SELECT conv_id FROM f)")(
    lambda e: e.find_df("conversations", {"role": {"equals": "user"}}, limit=0).select("conv_id", "turn", "role"))
query("locale_default", "SELECT doc_id, lang FROM documents WHERE lang = 'en' AND contains(lower(text), 'the')")(lambda e: e.matching("documents", {"title": {"like": "The"}}).select("doc_id", "lang"))
query("locale_request", "SELECT doc_id, lang FROM documents WHERE lang = 'de' AND contains(lower(text), 'ein')")(lambda e: e.matching("documents", {"title": {"contains": "EIN"}}, "de").select("doc_id", "lang"))
query("locale_explicit", "SELECT doc_id, lang FROM documents WHERE lang = 'fr'")(lambda e: e.matching("documents", {"title.fr": {"exists": True}}, "es").select("doc_id", "lang"))

# ------------------------------------------------------------------ writes, as the tables that they would leave

_KEYS = "c_custkey c_name c_acctbal c_mktsegment".split()
query("w_update_many", """SELECT c_custkey, c_name, 1.5 AS c_acctbal, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING' ORDER BY customer.c_acctbal DESC, c_custkey::VARCHAR DESC LIMIT 20""")(
    lambda e: e.update_many_df("customer", _reved(e.frame("customer")), {"c_acctbal": 1.5}, {"c_mktsegment": {"equals": "BUILDING"}}, "-c_acctbal", 20).select(*_KEYS))
query("unique_conflicts", "SELECT 'c_mktsegment' AS path, c_mktsegment AS value, count(*) AS count FROM customer GROUP BY 2 HAVING count(*) > 1")(lambda e: _with_unique(e).unique_conflicts_df("customer"))


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see; only on one machine may the session leave it unnamed."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if top:
        return top
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors see")
    return "file:///tmp/checkpoints"


def stored(name: str, sql: str) -> Callable:
    """Register a function of an engine that writes to a folder of its own below the shared one."""
    def register(f: Callable[[Engine], DataFrame]) -> Callable:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return f(engine(spark, folder, root=f"{shared_folder(spark).rstrip('/')}/docloom-{name}-{uuid.uuid4().hex}"))
        QUERIES[name], ORACLES[name] = run, sql
        return f
    return register


@stored("w_create_upsert_delete", """SELECT * FROM (SELECT r_regionkey::BIGINT AS r_regionkey, CASE WHEN r_regionkey = 1 THEN 'changed' ELSE r_name END AS r_name FROM region WHERE r_regionkey <> 3 UNION ALL SELECT 77, 'made' UNION ALL SELECT 78, 'put')""")
def _written(e: Engine) -> DataFrame:
    e.create("region", {"r_name": "made"}, custom_id=77)
    e.upsert("region", {"r_name": "changed"}, {"id": {"equals": "1"}})
    e.upsert("region", {"id": 78, "r_name": "put"}, {"r_name": {"equals": "nothing like it"}})
    e.delete_one("region", {"id": {"equals": 3}})
    return e.frame("region").select("r_regionkey", "r_name")


@stored("w_new_version", f"SELECT conv_id AS parent, turn, latest AND conv_id <> 1 AS latest FROM ({_TURNS}) UNION ALL SELECT 1, 99, true")
def _new_version(e: Engine) -> DataFrame:
    e.create_version("conversations", {"turn": 99, "role": "user", "text": "again"}, parent="1")
    return e.frame("conversations_versions").select("parent", F.col("version.turn").cast("bigint").alias("turn"), "latest")


_ROWS = "SELECT c_custkey, c_name, {balance} AS c_acctbal, c_mktsegment FROM customer"


@stored("w_update_one", _ROWS.format(balance="CASE WHEN c_custkey = 5 THEN 7.5 WHEN c_custkey = (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_custkey <> 5 ORDER BY c_custkey::VARCHAR LIMIT 1) THEN -1.0 ELSE c_acctbal END"))
def _update_one(e: Engine) -> DataFrame:
    if e.update_one("customer", {"c_acctbal": 7.5}, id="5", returning=False) is not None:
        raise AssertionError("nothing is returned where nothing is wanted")
    e.update_one("customer", {"c_acctbal": -1}, where={"c_mktsegment": {"equals": "MACHINERY"}, "id": {"not_equals": 5}})
    return e.frame("customer").select(*_KEYS)


@stored("w_update_many_stored", f"""WITH t AS (SELECT c_custkey AS k FROM customer WHERE c_mktsegment = 'BUILDING' ORDER BY c_acctbal DESC, c_custkey::VARCHAR DESC LIMIT 20) {_ROWS.format(balance="CASE WHEN c_custkey IN (SELECT k FROM t) THEN 1.5 ELSE c_acctbal END")}""")
def _update_many(e: Engine) -> DataFrame:
    e.update_many("customer", {"c_acctbal": 1.5}, {"c_mktsegment": {"equals": "BUILDING"}}, "-c_acctbal", 20, returning=False)
    return e.frame("customer").select(*_KEYS)


@stored("w_update_many_rows", "SELECT c_custkey, 2.5 AS c_acctbal, true AS stamped FROM customer WHERE c_acctbal < 0")
def _update_many_rows(e: Engine) -> DataFrame:
    return e.update_many_rows("customer", {"c_acctbal": 2.5}, {"c_acctbal": {"less_than": 0}}).select("c_custkey", "c_acctbal", F.col("updatedAt").isNotNull().alias("stamped"))


@stored("w_delete_many", _ROWS.format(balance="c_acctbal") + " WHERE NOT (c_acctbal < 0)")
def _delete_many(e: Engine) -> DataFrame:
    e.delete_many("customer", {"c_acctbal": {"less_than": 0}})
    return e.frame("customer").select(*_KEYS)


@stored("w_versions", f"""SELECT conv_id AS parent, turn, CASE WHEN conv_id = 0 AND turn = 1 THEN 'de' ELSE '' END AS locale, latest FROM ({_TURNS}) WHERE turn <= 2""")
def _versions(e: Engine) -> DataFrame:
    e.update_version("conversations", {"publishedLocale": "de"}, id="0-1")
    e.delete_versions("conversations", where={"version.turn": {"greater_than": 2}})
    return e.frame("conversations_versions").select("parent", F.col("version.turn").cast("bigint").alias("turn"), F.coalesce("publishedLocale", F.lit("")).alias("locale"), "latest")


@stored("w_jobs", "SELECT o_orderkey::VARCHAR AS id, true AS busy, 'made,claimed' AS log FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderdate, o_orderkey::VARCHAR LIMIT 25")
def _jobs(e: Engine) -> DataFrame:
    jobs = Engine(e.spark, [Collection("jobs", (Field("queue"), Field("busy", "checkbox"), Field("log", "array", fields=(Field("message"),))))], root=e.tables.root)
    jobs.put("jobs", lambda: e.frame("orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderstatus").alias("queue"), F.lit(False).alias("busy"), F.col("o_orderdate").alias("createdAt"),
                                                      F.array(F.struct(F.lit("1").alias("id"), F.lit("made").alias("message"))).alias("log")))
    done = jobs.update_jobs_rows({"busy": True, "log": {"$push": {"message": "claimed"}}}, where={"queue": {"equals": "O"}, "busy": {"equals": "false"}}, sort="createdAt", limit=25)
    return done.select("id", "busy", F.array_join(F.transform("log", lambda x: x["message"]), ",").alias("log"))


@stored("w_global", """SELECT 'global' AS kind, 'orders' AS name, count(*)::DOUBLE AS n FROM orders UNION ALL SELECT 'latest', 'second', 2 UNION ALL SELECT 'versions', '', 2 UNION ALL SELECT 'absent', '', 0""")
def _global(e: Engine) -> DataFrame:
    site = Engine(e.spark, globals=[Global("summary", (Field("name"), Field("n", "number")), versions=True)], root=e.tables.root)
    absent = [site.find_global("summary"), site.update_global("summary", {"name": "none"})]
    site.create_global("summary", {"name": "first", "n": e.count("orders")["totalDocs"]})
    site.update_global("summary", {"name": "orders"})
    for k, name in enumerate(("first", "second")):
        site.create_global_version("summary", {"name": name, "n": k + 1})
    found = site.find_global("summary", {"name": {"equals": "orders"}})
    latest = site.latest_version_df("summary").select("version.name", "version.n").first()
    rows = [("global", found["name"], found["n"]), ("latest", latest["name"], latest["n"]), ("versions", "", float(site.count_global_versions("summary")["totalDocs"])), ("absent", "", float(sum(x is not None for x in absent)))]
    return e.spark.createDataFrame(rows, "kind string, name string, n double")


@stored("w_unique", "SELECT 'c_mktsegment' AS path, count(DISTINCT c_mktsegment) AS taken FROM customer")
def _unique(e: Engine) -> DataFrame:
    segments = [r["value"] for r in _with_unique(e).unique_conflicts_df("customer").select("value").collect()]
    paths = []
    for k, value in enumerate(segments):
        try:
            e.create("customer", {"c_mktsegment": value}, custom_id=10_000_000 + k)
        except ValidationError as error:
            paths += error.paths
    return e.spark.createDataFrame([(x,) for x in paths], "path string").groupBy("path").agg(F.count(F.lit(1)).alias("taken"))


@stored("w_conflict", "SELECT true AS second_fails, (SELECT count(*) FROM region) + 1 AS n")
def _conflict(e: Engine) -> DataFrame:
    store = e._store("region")
    n, row = store.version(), e.spark.createDataFrame([(50, "one")], "r_regionkey bigint, r_name string")
    store.change(row, None, n)
    try:
        store.change(row.withColumn("r_name", F.lit("two")), None, n)
        failed = False
    except Conflict:
        failed = True
    return e.frame("region").filter("r_name <> 'two'").agg(F.count(F.lit(1)).alias("n")).select(F.lit(failed).alias("second_fails"), "n")


query("w_scrub", "SELECT c_custkey, c_name, count(*) OVER () AS scanned, sum((c_acctbal < 0)::INT) OVER ()::BIGINT AS modified FROM customer")(lambda e: _scrubbed(e))
query("backfill", "SELECT 'customer.c_name' AS path, true AS ready, 0 AS conflicts UNION ALL SELECT 'customer.c_mktsegment', false, count(DISTINCT c_mktsegment) FROM customer")(lambda e: _backfilled(_with_unique(e, ("c_mktsegment", "c_name"))))

# ------------------------------------------------------------------ documents, pages and other forms of joins

query("find_documents", """SELECT o_orderkey::VARCHAR AS id, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000Z') AS date, 'o_custkey,o_orderdate,o_orderkey,o_orderpriority,o_orderstatus,o_totalprice' AS keys FROM orders WHERE o_orderstatus = 'P'""")(
    lambda e: e.documents_df("orders", {"o_orderstatus": {"equals": "P"}}, limit=0).select(
        F.get_json_object("document", "$.o_orderkey").alias("id"), F.get_json_object("document", "$.o_orderdate").alias("date"), F.array_join(F.array_sort(F.json_object_keys("document")), ",").alias("keys")))
query("find_one_draft", f"SELECT conv_id, turn, role FROM ({_TURNS}) WHERE latest AND turn > 0 ORDER BY conv_id::VARCHAR LIMIT 1")(
    lambda e: e.spark.createDataFrame([tuple((e.find_one("conversations", {"turn": {"greater_than": 0}}) or {}).get(k) for k in ("conv_id", "turn", "role"))], "conv_id bigint, turn bigint, role string"))
query("page_numbers", """SELECT 7 AS "limit", 3 AS page, count(*)::INT AS "totalDocs", ceil(count(*) / 7.0)::INT AS "totalPages", true AS "hasPrevPage", true AS "hasNextPage", 4 AS "nextPage", 2 AS "prevPage", 15 AS "pagingCounter" FROM orders WHERE o_orderstatus = 'F'""")(
    lambda e: _numbers(e, e.find("orders", {"o_orderstatus": {"equals": "F"}}, limit=7, page=3)))
query("page_numbers_distinct", """SELECT 4 AS "limit", 2 AS page, count(DISTINCT p_size)::INT AS "totalDocs", ceil(count(DISTINCT p_size) / 4.0)::INT AS "totalPages", true AS "hasPrevPage", true AS "hasNextPage", 3 AS "nextPage", 1 AS "prevPage", 5 AS "pagingCounter" FROM part""")(
    lambda e: _numbers(e, e.find_distinct("part", "p_size", limit=4, page=2)))
query("find_unpaged", """SELECT count(*) AS n, count(*) AS "totalDocs", false AS more FROM part WHERE p_size = 5""")(
    lambda e: (lambda r: e.spark.createDataFrame([(len(r["docs"]), r["totalDocs"], r["hasNextPage"])], "n bigint, totalDocs bigint, more boolean"))(e.find("part", {"p_size": {"equals": 5}}, limit=0, pagination=False)))
query("sort_locale", "SELECT doc_id, lang FROM documents ORDER BY CASE WHEN lang = 'de' THEN text END DESC NULLS LAST, doc_id::VARCHAR DESC LIMIT 40")(lambda e: e.find_df("documents", sort="-title", limit=40, locale="de").select("doc_id", "lang"))
query("path_unknown", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'P'")(
    lambda e: e.matching("orders", {"nothing.like.it": {"not_equals": 1, "exists": False}, "o_orderstatus": {"equals": "P"}}).select("o_orderkey", "o_orderstatus"))
query("f_unsupported", "SELECT 'operator ''matches'' on field ''o_orderstatus'' is not supported' AS message")(lambda e: _refused(e, {"and": [{"o_orderstatus": {"matches": "F"}}]}))
query("f_relation_null", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IS NULL OR o_custkey = 9")(lambda e: e.matching("orders", {"or": [{"o_custkey": {"equals": "null"}}, {"o_custkey": {"equals": "9"}}]}).select("o_orderkey", "o_custkey"))
query("f_relation_polymorphic", "SELECT event_id FROM events WHERE user_id = 7 AND event_id % 2 = 1")(lambda e: _watched(e).matching("events", {"subject": {"equals": {"relationTo": "supplier", "value": "7"}}}).select("event_id"))
query("join_polymorphic_on", """SELECT user_id AS parent, rank, 'events' AS "relationTo", event_id::VARCHAR AS child FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC NULLS LAST, event_id::VARCHAR DESC)::INT AS rank FROM events WHERE event_id % 2 = 0 AND user_id IN (SELECT c_custkey FROM customer)) WHERE rank <= 2""")(
    lambda e: _watched(e).join_rows_df("customer", "seen", {"limit": 2}))
QUERIES["join_has_many"] = lambda spark, folder: _with_join(_orders(engine(spark, folder), folder), "part", Field("orders", "join", collection="orders", on="parts", default_sort="-o_totalprice")).join_rows_df("part", "orders", {"limit": 2})
ORACLES["join_has_many"] = """WITH u AS (SELECT DISTINCT l_partkey AS p, o_orderkey AS o, o_totalprice AS t FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_partkey IN (SELECT p_partkey FROM part))
    SELECT p AS parent, rank, 'orders' AS "relationTo", o::VARCHAR AS child FROM (SELECT *, row_number() OVER (PARTITION BY p ORDER BY t DESC, o::VARCHAR DESC)::INT AS rank FROM u) WHERE rank <= 2"""
query("join_localized", "SELECT r_regionkey, coalesce(n, 0)::INT AS n, coalesce(n, 0) > 3 AS more FROM region LEFT JOIN (SELECT n_regionkey, count(*) AS n FROM nation GROUP BY 1) ON r_regionkey = n_regionkey")(
    lambda e: (lambda x: x._joined("region", x.frame("region"), {"nations": {"limit": 3}}, "de").select("r_regionkey", F.when(F.col("nations.de.hasNextPage"), F.lit(-1)).otherwise(F.size("nations.de.docs")).alias("_n"), F.col("nations.de.hasNextPage").alias("more"))
               .join(x.frame("nation").groupBy("n_regionkey").agg(F.count(F.lit(1)).cast("int").alias("c")), F.col("r_regionkey") == F.col("n_regionkey"), "left").select("r_regionkey", F.when(F.col("_n") < 0, F.col("c")).otherwise(F.col("_n")).alias("n"), "more"))(
        _with_join(e, "region", Field("nations", "join", collection="nation", on="n_regionkey", default_sort="n_name", localized=True))))
query("join_untouched", "SELECT r_regionkey, 'r_name,r_regionkey' AS columns FROM region")(lambda e: (lambda f: f.select("r_regionkey", F.lit(",".join(sorted(f.columns))).alias("columns")))(e.find_df("region", limit=0, joins={"nations": False, "none": {"limit": 1}})))


def _numbers(e: Engine, found: dict[str, Any]) -> DataFrame:
    names = ("limit", "page", "totalDocs", "totalPages", "hasPrevPage", "hasNextPage", "nextPage", "prevPage", "pagingCounter")
    return e.spark.createDataFrame([tuple(found[n] for n in names)], ", ".join(f"{n} {'boolean' if n.startswith('has') else 'int'}" for n in names))


def _refused(e: Engine, where: dict[str, Any]) -> DataFrame:
    try:
        e.matching("orders", where)
        message = "accepted"
    except QueryError as error:
        message = str(error).partition(";")[0]
    return e.spark.createDataFrame([(message,)], "message string")


def _scrubbed(e: Engine) -> DataFrame:
    raw = e.frame("customer").select("c_custkey", "c_name", "c_acctbal", F.when(F.col("c_acctbal") < 0, F.lit("x")).alias("password"))
    rows, report = e.scrub("customer", raw)
    if "password" in rows.columns:
        raise AssertionError("what the schema does not know must go")
    return rows.select("c_custkey", "c_name", *(F.lit(report[k]).cast("bigint").alias(k) for k in ("scanned", "modified")))


def _backfilled(e: Engine) -> DataFrame:
    report = e.backfill()
    counts = [f.groupBy("path").agg(F.count(F.lit(1)).alias("conflicts")).select(F.concat(F.lit(f"{slug}."), "path").alias("path"), F.lit(False).alias("ready"), "conflicts") for slug, f in report["conflicts"].items()]
    ready = e.spark.createDataFrame([(p, True, 0) for p in report["ready"]], "path string, ready boolean, conflicts bigint")
    return reduce(DataFrame.unionByName, counts, ready)


def _with_join(e: Engine, slug: str, field: Field) -> Engine:
    """The same engine with a join field more (or another in its place)."""
    c = e.catalog.collections[slug]
    e.catalog.collections[slug] = replace(c, fields=(*(f for f in c.fields if f.name != field.name), field))
    return e


def _watched(e: Engine) -> Engine:
    """Events whose subject is a customer or a supplier, and customers with the events that name them."""
    c = e.catalog.collections["events"]
    e.catalog.collections["events"] = replace(c, fields=(*c.fields, Field("subject", "relationship", relation_to=("customer", "supplier"))))
    rows = e.frame("events")
    e.put("events", rows.withColumn("subject", F.struct(F.when(F.col("event_id") % 2 == 0, F.lit("customer")).otherwise(F.lit("supplier")).alias("relationTo"), F.col("user_id").alias("value"))))
    return _with_join(e, "customer", Field("seen", "join", collection="events", on="subject", default_sort="-value"))


def _reved(frame: DataFrame) -> DataFrame:
    return frame.withColumns({"_rev": F.lit(1).cast("bigint"), "updatedAt": F.lit(None).cast("timestamp_ntz")})


def _with_unique(e: Engine, names: tuple[str, ...] = ("c_mktsegment",)) -> Engine:
    """The same engine with unique fields, which customers may break."""
    c = e.catalog.collections["customer"]
    e.catalog.collections["customer"] = replace(c, fields=tuple(replace(f, unique=f.name in names) for f in c.fields))
    return e
