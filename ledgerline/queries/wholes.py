"""Composite products, graphs and streams as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scores
from ..operators import graph
from ..plans import products
from ..sources import interim
from ..streaming import commits, incremental, restating
from .registry import lost_key, query, table

_EDGES = """e AS (SELECT s_nationkey AS src, c_nationkey AS dst, count(*) AS weight, CAST(max(l_linenumber) AS INTEGER) AS tier FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""


def _edges(spark, sf_dir):
    """Money between nations."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("src"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("dst"))
    rows = lines.join(o, "l_orderkey").join(s, "l_suppkey").join(c, "o_custkey")
    return rows.groupBy("src", "dst").agg(F.count("*").alias("weight"), F.max("l_linenumber").alias("tier"))


_CHAINS = """ch AS (SELECT o_orderkey AS prime, l_suppkey AS sub, l_partkey AS asset, s_nationkey AS place, l_extendedprice AS amount,
  round(least(CASE WHEN l_orderkey % 3 > 0 THEN 0.40 ELSE 0.25 END + 0.2 + CASE WHEN o_orderkey IS NOT NULL THEN 0.15 ELSE 0 END + 0.15 + CASE WHEN o_custkey % 2 = 0 THEN 0.05 ELSE 0 END + CASE WHEN l_suppkey % 2 = 0 THEN 0.05 ELSE 0 END, 1), 3) AS confidence
  FROM lineitem LEFT JOIN (SELECT o_custkey, CASE WHEN o_orderkey % 10 = 0 THEN -1 - o_orderkey ELSE o_orderkey END AS o_orderkey FROM orders) ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey)"""


def _chains(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(lost_key("o_orderkey", 10).alias("o_orderkey"), "o_custkey")
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey", "l_extendedprice").join(o, F.col("l_orderkey") == F.col("o_orderkey"), "left").join(s, "l_suppkey")
    true = F.lit(True)
    score = scores.link_confidence(F.col("l_orderkey") % 3 > 0, true, true, F.col("o_orderkey").isNotNull(), true, F.coalesce(F.col("o_custkey") % 2 == 0, F.lit(False)), F.col("l_suppkey") % 2 == 0)
    out = rows.select(F.col("o_orderkey").alias("prime"), F.col("l_suppkey").alias("sub"), F.col("l_partkey").alias("asset"), F.col("s_nationkey").alias("place"), F.col("l_extendedprice").alias("amount"), score.alias("confidence"))
    return out.withColumn("review", F.col("confidence") < 0.9)


@query(f"WITH {_CHAINS} SELECT prime, sub, asset, place, amount, CAST(confidence AS DOUBLE) AS confidence, confidence < 0.9 AS review FROM ch")
def execution_chain(spark, sf_dir):
    """Prime to subaward to asset to place, with confidence and review flag."""
    return _chains(spark, sf_dir)


@query(f"WITH {_CHAINS} SELECT CAST(place AS VARCHAR) AS place, count(*) AS chains, count(DISTINCT prime) AS primes, count(DISTINCT sub) AS subs, round(sum(amount), 2) AS obligation, round(avg(CASE WHEN confidence < 0.9 THEN 1 ELSE 0 END), 4) AS review_rate FROM ch GROUP BY 1")
def chain_rollup_muni(spark, sf_dir):
    return products.chain_rollup(_chains(spark, sf_dir), "place", "amount")


@query("""
WITH f AS (SELECT 'contract' AS k, 'obligation' AS a, CAST(o_custkey AS VARCHAR) AS source, CAST(o_orderkey AS VARCHAR) AS target, o_totalprice AS amount, CAST(o_orderdate AS DATE) AS day, CAST(o_orderkey AS VARCHAR) AS record FROM orders
 UNION ALL SELECT 'payment', 'outlay', CAST(user_id AS VARCHAR), event_type, value, CAST(ts AS DATE), CAST(event_id AS VARCHAR) FROM events WHERE event_type = 'purchase')
SELECT 'flow_' || substr(sha256(k || '|' || source || '|' || target || '|' || strftime(day, '%Y-%m-%d') || '|' || record), 1, 20) AS flow_id, k AS flow_type, a AS amount_type, source, target, round(amount, 2) AS amount, day FROM f
""")
def financial_flows(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("source"), F.col("o_orderkey").alias("target"), F.col("o_totalprice").alias("amount"), F.col("o_orderdate").alias("day"), F.col("o_orderkey").cast("string").alias("record"))
    e = table(spark, sf_dir, "events").filter("event_type = 'purchase'").select(F.col("user_id").alias("source"), F.col("event_type").alias("target"), F.col("value").alias("amount"), F.col("ts").alias("day"), F.col("event_id").cast("string").alias("record"))
    return products.flows({("contract", "obligation"): o, ("payment", "outlay"): e})


@query("""
SELECT c_custkey AS entity, coalesce(n, 0) AS awards, coalesce(total, 0) AS total, n IS NULL AS gap, coalesce(lines, 0) AS lines FROM customer
LEFT JOIN (SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1) a ON c_custkey = a.o_custkey
LEFT JOIN (SELECT o_custkey, count(*) AS lines FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1) b ON c_custkey = b.o_custkey
""")
def entity_profiles(spark, sf_dir):
    """Aggregates on a spine; entities without any are kept and marked."""
    o = table(spark, sf_dir, "orders")
    a = o.groupBy(F.col("o_custkey").alias("entity")).agg(F.count("*").alias("awards"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    b = o.select("o_orderkey", F.col("o_custkey").alias("entity")).join(lines, "o_orderkey").groupBy("entity").agg(F.sum("n").alias("lines"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entity"))
    p = c.join(a, "entity", "left").join(b, "entity", "left").withColumn("gap", F.col("awards").isNull())
    return p.fillna(0, ["awards", "total", "lines"])


@query(f"WITH {_EDGES}, x AS (SELECT src AS node, 1 AS o, weight, tier FROM e UNION ALL SELECT dst, 0, weight, tier FROM e) SELECT node, count(*) AS degree, CAST(sum(o) AS BIGINT) AS n_out, CAST(sum(1 - o) AS BIGINT) AS n_in, CAST(sum(weight) AS BIGINT) AS weight, max(tier) AS worst_tier FROM x GROUP BY node")
def edge_metrics(spark, sf_dir):
    return graph.node_metrics(_edges(spark, sf_dir))


@query(f"""WITH RECURSIVE {_EDGES}, p(origin, terminal, hops, path, seen) AS (SELECT src, dst, 1, src || ' > ' || dst, [src, dst] FROM e WHERE src <> dst
  UNION ALL SELECT origin, e.dst, hops + 1, path || ' > ' || e.dst, list_append(seen, e.dst) FROM p JOIN e ON p.terminal = e.src WHERE hops < 3 AND NOT list_contains(seen, e.dst))
SELECT origin, terminal, hops, path FROM p""")
def flow_paths(spark, sf_dir):
    """Simple paths of at most three hops from every origin."""
    e = _edges(spark, sf_dir)
    return graph.simple_paths(e, e.select(F.col("src").alias("node")).distinct(), 3)


@query()
def cycle_check(spark, sf_dir):
    """Nodes on cycles of any length."""
    return graph.cycles(_edges(spark, sf_dir))


@query(f"WITH {_EDGES}, x AS (SELECT src || '-' || (dst % 9) AS edge_id, src, dst FROM e) SELECT edge_id, 'orphan_src' AS fault FROM x WHERE src % 6 = 0 UNION ALL SELECT edge_id, 'orphan_dst' FROM x WHERE dst % 6 = 0 UNION ALL SELECT edge_id, 'self_loop' FROM x WHERE src = dst UNION ALL SELECT edge_id, 'duplicate' FROM x GROUP BY edge_id HAVING count(*) > 1")
def graph_faults(spark, sf_dir):
    e = _edges(spark, sf_dir).withColumn("edge_id", F.concat_ws("-", F.col("src").cast("string"), (F.col("dst") % 9).cast("string")))
    return graph.edge_faults(e, table(spark, sf_dir, "nation").select(lost_key("n_nationkey", 6).alias("node")))


@query()
def betweenness_sampled(spark, sf_dir):
    """Customers and suppliers that stand between others, by the shortest paths of 32 of them, and how far off that may be."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    e = lines.join(o, "l_orderkey").select((-1 - F.col("l_suppkey")).alias("src"), F.col("o_custkey").alias("dst"), F.lit(1.0).alias("weight"))
    return graph.sampled_betweenness(e, 32)


@query()
def pagerank(spark, sf_dir):
    """Converged ranks; tests hold them against a plain version."""
    return graph.pagerank(_edges(spark, sf_dir)).withColumn("rank", F.round("rank", 8))


@query()
def betweenness(spark, sf_dir):
    return graph.betweenness(_edges(spark, sf_dir)).withColumn("betweenness", F.round("betweenness", 6))


@query("""
SELECT p_name AS child, arg_min(p_brand, (p_partkey, p_brand)) AS parent, count(DISTINCT p_brand) AS n_parents, count(DISTINCT p_brand) > 1 AS conflict FROM part GROUP BY 1
""")
def parent_collapse(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_name").alias("child"), F.col("p_brand").alias("parent"), F.col("p_partkey").alias("ord"))
    return graph.collapse(p, "ord")


@query("""
SELECT coalesce(n_name, 'holder ' || s_suppkey) AS owner, count(*) AS positions, round(sum(s_acctbal), 2) AS value FROM supplier LEFT JOIN (SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN n_name END AS n_name FROM nation) ON s_nationkey = n_nationkey GROUP BY 1
""")
def ownership_rollup(spark, sf_dir):
    """Positions rolled up to the bound parent, else to the holder."""
    bound = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).alias("n_name"))
    rows = table(spark, sf_dir, "supplier").join(bound, "s_nationkey", "left")
    owner = F.coalesce("n_name", F.concat(F.lit("holder "), F.col("s_suppkey").cast("string")))
    return rows.groupBy(owner.alias("owner")).agg(F.count("*").alias("positions"), F.round(F.sum("s_acctbal"), 2).alias("value"))


@query("""
WITH d AS (SELECT event_id, user_id, event_type, date_diff('day', ts, TIMESTAMP '2024-01-31') AS lead, value FROM events WHERE event_type <> 'error')
SELECT event_id, round(least(1, greatest(1, 180 - lead) / 180 * (0.6 + 0.4 * ln(1 + value) / ln(1 + 1e6))), 4) AS score FROM d
""")
def lobby_timing(spark, sf_dir):
    e = table(spark, sf_dir, "events").filter("event_type <> 'error'")
    lead = F.datediff(F.lit("2024-01-31").cast("date"), F.to_date("ts"))
    return e.select("event_id", scores.lobby_timing(lead, F.col("value")).alias("score"))


@query("""
SELECT count(*) AS members, count(DISTINCT event_type) AS kinds, user_id, round(count(*) + 2 * count(DISTINCT event_type) + 1.5 * count(DISTINCT CAST(ts AS DATE)) + avg(value) / 100, 3) AS score FROM events GROUP BY user_id
""")
def continuity_clusters(spark, sf_dir):
    """Edges plus weighted kinds, days and mean confidence."""
    g = table(spark, sf_dir, "events").groupBy("user_id")
    s = F.count("*") + 2 * F.count_distinct("event_type") + 1.5 * F.count_distinct(F.to_date("ts")) + F.avg("value") / 100
    return g.agg(F.count("*").alias("members"), F.count_distinct("event_type").alias("kinds"), F.round(s, 3).alias("score"))


@query("""
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CASE WHEN value >= 90 THEN 'confirmed' WHEN value >= 75 THEN 'strong_probable' WHEN value >= 60 THEN 'probable' WHEN value >= 40 THEN 'needs_review' ELSE 'lead_only' END AS band FROM events
""")
def event_bands(spark, sf_dir):
    """Nested JSON fields, and score bands."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.from_json("props", "k long")["k"].alias("k"), scores.bands(F.col("value"), scores.NONPROFIT_BANDS, "lead_only").alias("band"))


def _streamed(spark, build, schema, mode="append", sink=commits.exactly_once, read=commits.committed):
    """Run a stream to its end and give the table that its sink left."""
    folder = interim.new_folder(spark, "stream")
    incremental.run_available(build, f"{folder}/state", sink(f"{folder}/out"), mode)
    out = read(spark, f"{folder}/out", schema)
    return out.select(*[F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c) for c, t in out.dtypes])


@query("""
SELECT time_bucket(INTERVAL 6 HOUR, ts) AS start, time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR AS "end", event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2, 3
""")
def stream_tumbling(spark, sf_dir):
    """Six-hour windows over the event files as a stream."""
    schema = table(spark, sf_dir, "events").schema
    stream = incremental.events(spark, f"{sf_dir}/events.parque[t]", schema)  # a pattern: one file is no folder
    out = incremental.windowed(stream, "ts", "event_type", "value", "6 hours")
    # each batch says how the windows that it touched stand now; the counts of a window only grow
    sink = lambda path: restating.restate_into(path, ["start", "end", "event_type"], "start", ["n"])
    return _streamed(spark, out, out.schema, "update", sink, restating.restated)


@query("""
WITH g AS (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 3 HOUR THEN 0 ELSE 1 END AS fresh FROM events),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g)
SELECT min(ts) AS start, max(ts) + INTERVAL 3 HOUR AS "end", user_id, count(*) AS n FROM s GROUP BY user_id, k
""")
def session_windows(spark, sf_dir):
    found = incremental.sessions(table(spark, sf_dir, "events"), "ts", "user_id", "3 hours")
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


@query("SELECT event_id, ts, user_id, event_type FROM events")
def stream_dedup(spark, sf_dir):
    """Each event once, though the stream holds every event twice."""
    schema = table(spark, sf_dir, "events").schema
    stream = incremental.events(spark, f"{sf_dir}/events.parque[t]", schema)  # a pattern: one file is no folder
    twice = stream.select("event_id", "ts", "user_id", "event_type").unionByName(stream.select("event_id", "ts", "user_id", "event_type"))
    out = incremental.deduplicated(twice, "event_id", "ts")
    return _streamed(spark, out, out.schema)
