"""Collections over the analytic tables that queries and benchmarks run on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .engine import Engine
from .plans.schema import Collection, Field, Localization
from .sources.tables import parquet_dir

N, S, D = "number", "text", "date"


def _fields(**kinds: str) -> tuple[Field, ...]:
    return tuple(Field(n, k) for n, k in kinds.items())


def _to(name: str, slug: str) -> Field:
    return Field(name, "relationship", relation_to=slug)


COLLECTIONS = (
    Collection("region", (Field("r_name"), Field("nations", "join", collection="nation", on="n_regionkey", default_sort="n_name")), id="r_regionkey", id_type=N),
    Collection("nation", (Field("n_name"), _to("n_regionkey", "region"), Field("customers", "join", collection="customer", on="c_nationkey", default_sort="-c_acctbal"),
                          Field("partners", "join", collection=("customer", "supplier"), on="nation", default_limit=3)), id="n_nationkey", id_type=N),
    Collection("supplier", (Field("s_name"), _to("s_nationkey", "nation"), Field("s_acctbal", N), _to("nation", "nation"), Field("place", "point")), id="s_suppkey", id_type=N, default_sort="-s_acctbal"),
    Collection("customer", (Field("c_name"), _to("c_nationkey", "nation"), Field("c_acctbal", N), Field("c_mktsegment", "select"), _to("nation", "nation"),
                            Field("orders", "join", collection="orders", on="o_custkey", default_sort="-o_totalprice")), id="c_custkey", id_type=N, default_sort="-c_acctbal"),
    Collection("part", _fields(p_name=S, p_brand=S, p_type=S, p_size=N, p_retailprice=N), id="p_partkey", id_type=N),
    Collection("orders", (_to("o_custkey", "customer"), *_fields(o_orderstatus="select", o_totalprice=N, o_orderdate=D, o_orderpriority="select"),
                          Field("items", "array", fields=(_to("part", "part"), *_fields(line=N, quantity=N, flag=S))), Field("parts", "relationship", relation_to="part", has_many=True)), id="o_orderkey", id_type=N),
    Collection("lineitem", (_to("l_orderkey", "orders"), _to("l_partkey", "part"), _to("l_suppkey", "supplier"),
                            *_fields(l_linenumber=N, l_quantity=N, l_extendedprice=N, l_discount=N, l_tax=N, l_returnflag="select", l_linestatus="select", l_shipdate=D)), id="id"),
    Collection("events", _fields(ts=D, user_id=N, event_type="select", value=N, props="json"), id="event_id", id_type=N),
    Collection("embeddings", (Field("embedding", N, has_many=True), Field("label", N)), id="vec_id", id_type=N),
    Collection("documents", (Field("title", "textarea", localized=True), *_fields(lang="select", source=S, n_chars=N)), id="doc_id", id_type=N),
    Collection("conversations", _fields(turn=N, role="select", text="textarea"), id="conv_id", id_type=N, versions=True, drafts=True),
)
LOCALES = Localization(("en", "de", "fr", "es"), "en")


def line_ids(frame: DataFrame) -> DataFrame:
    """Line items have no id of their own: order and line number make one."""
    return frame.withColumn("id", F.concat_ws("-", "l_orderkey", "l_linenumber"))


def orders_with_items(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with their line items as a list of objects, in line order, and the parts as a list of ids."""
    lines = parquet_dir(spark, folder, "lineitem").select("l_orderkey", F.struct(F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"), F.col("l_quantity").alias("quantity"), F.col("l_returnflag").alias("flag")).alias("item"))
    items = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("item")).alias("items"))
    orders = parquet_dir(spark, folder, "orders").join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")
    return orders.withColumn("parts", F.transform("items", lambda x: x["part"]))


def turns(spark: SparkSession, folder: str) -> DataFrame:
    """Turns of conversations as version rows; the last turn is the latest."""
    rows = parquet_dir(spark, folder, "conversations")
    last = rows.groupBy("conv_id").agg(F.max("turn").alias("_last"))
    return rows.join(last, "conv_id").select(
        F.concat_ws("-", "conv_id", "turn").alias("id"), F.col("conv_id").alias("parent"), (F.col("turn") == F.col("_last")).alias("latest"),
        F.struct("turn", "role", "text").alias("version"))


def first_turns(spark: SparkSession, folder: str) -> DataFrame:
    """The published state of conversations: the first turn of each."""
    return parquet_dir(spark, folder, "conversations").filter("turn = 0").select("conv_id", "turn", "role", "text")


def places(frame: DataFrame) -> DataFrame:
    """Suppliers on a made-up map: coordinates by arithmetic on the key."""
    lng = (F.col("s_suppkey") * 37 % 360).cast("double") - 180
    lat = (F.col("s_suppkey") * 17 % 160).cast("double") - 80
    return frame.withColumns({"place": F.array(lng, lat), "nation": F.col("s_nationkey")})


def translated(frame: DataFrame) -> DataFrame:
    """Documents with their whole text as the title in their own language."""
    titles = F.struct(*(F.when(F.col("lang") == code, F.col("text")).alias(code) for code in LOCALES.locales))
    return frame.withColumn("title", titles).drop("text")


def engine(spark: SparkSession, folder: str, root: str | None = None) -> Engine:
    """An engine over the tables of a folder."""
    e = Engine(spark, COLLECTIONS, localization=LOCALES, root=root)
    for slug in ("region", "nation", "part", "events", "embeddings", "orders"):
        e.put(slug, lambda s=slug: parquet_dir(spark, folder, s))
    e.put("customer", lambda: parquet_dir(spark, folder, "customer").withColumn("nation", F.col("c_nationkey")))
    e.put("supplier", lambda: places(parquet_dir(spark, folder, "supplier")))
    e.put("lineitem", lambda: line_ids(parquet_dir(spark, folder, "lineitem")))
    e.put("documents", lambda: translated(parquet_dir(spark, folder, "documents")))
    e.put("conversations", lambda: first_turns(spark, folder))
    e.put("conversations_versions", lambda: turns(spark, folder))
    return e
