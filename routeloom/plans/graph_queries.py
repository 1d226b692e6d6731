"""Registered queries of the route graph, with SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routeloom.operators import analysis, routes, trees
from routeloom.plans import graph_sql as sql
from routeloom.plans.delay_report import delay_report
from routeloom.sources.flights import read_flights, with_defaults, write_flights
from routeloom.sources.tables import (
    daily_hops,
    lineitem_flights,
    nation_lead_times,
    nation_routes,
    supplier_part_routes,
    table,
    user_hops,
)
from routeloom.workspace import freeze, new_path

FACTOR = sql.FACTOR


def nation_edges(spark: SparkSession, folder: str) -> DataFrame:
    return routes.average_edges(nation_routes(spark, folder))


def user_edges(spark: SparkSession, folder: str) -> DataFrame:
    return routes.average_edges(user_hops(spark, folder))


def daily_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Hops between users of one day: a component or more for each day."""
    return routes.average_edges(daily_hops(spark, folder))


def _spanned(spark, folder):
    """The nation graph and its spanning tree."""
    edges = freeze(nation_edges(spark, folder), "edges")
    return edges, trees.minimum_spanning_forest(edges)


def supplier_part_forest(spark, folder):
    return trees.minimum_spanning_forest(
        routes.average_edges(supplier_part_routes(spark, folder))
    )


def tree_complement(spark, folder):
    return analysis.tree_complement(*_spanned(spark, folder))


def complement_strength(spark, folder):
    return analysis.complement_strength(tree_complement(spark, folder))


def scaled_edges(spark, folder):
    edges, tree = _spanned(spark, folder)
    strength = analysis.complement_strength(analysis.tree_complement(edges, tree))
    worst = freeze(analysis.bottleneck(strength), "worst")
    return analysis.scale_vertex(edges, worst, FACTOR)


def _report(spark, folder, mode="mst"):
    return delay_report(nation_edges(spark, folder), FACTOR, mode)


def flight_csv_scan(spark, folder):
    path = new_path(spark, "flights")
    write_flights(lineitem_flights(spark, folder), path)
    return (
        read_flights(spark, path, strict=True)
        .groupBy("origin_id", "carrier")
        .agg(
            F.count("*").alias("flights"),
            F.sum("departure_delay").alias("departure_delay"),
            F.sum("arrival_delay").alias("arrival_delay"),
            F.sum("arrival_real_time").alias("arrival_time"),
        )
    )


def flight_defaults(spark, folder):
    joined = table(spark, folder, "documents").join(
        table(spark, folder, "labels"), "doc_id", "left"
    )
    return with_defaults(joined, {"quality": 0, "toxic": 0}).select("doc_id", "quality", "toxic")


def vertex_count(spark, folder):
    return routes.vertices(nation_routes(spark, folder)).agg(F.count("*").alias("vertices"))


def adjacency(spark, folder):
    trips = freeze(nation_routes(spark, folder), "routes")
    index = freeze(routes.vertex_index(routes.vertices(trips)), "index")
    return routes.adjacency(routes.average_edges(trips), index)


def unreached_neighbors(spark, folder):
    hops = freeze(user_hops(spark, folder), "routes")
    edges = freeze(routes.average_edges(hops), "edges")
    start = routes.default_source(edges).first()[0]
    return routes.unreached_neighbors(routes.vertices(hops), edges, start)


def spt_users_sparse(spark, folder):
    hops = freeze(daily_hops(spark, folder), "routes")
    edges = routes.average_edges(hops)
    return trees.shortest_path_tree(edges, vertices=routes.vertices(hops), keep_unreached=True)


def spt_compat(spark, folder):
    hops = freeze(daily_hops(spark, folder), "routes")
    edges = freeze(routes.average_edges(hops), "edges")
    source = routes.default_source(edges).first()[0]
    tree = trees.shortest_path_tree(edges, source, routes.vertices(hops), keep_unreached=True)
    return trees.reference_rows(tree, source)


def tree_weight(spark, folder):
    report = _report(spark, folder)
    named = [("before", report.before), ("after", report.after)]
    parts = [
        analysis.tree_weight(tree).select(
            F.lit(name).alias("tree"), F.round("total", 6).alias("total")
        )
        for name, tree in named
    ]
    return parts[0].unionByName(parts[1])


def report_rows(spark, folder, mode="mst"):
    rows = _report(spark, folder, mode).rows()
    summed = ~F.col("section").startswith("tree")
    return rows.withColumn("value", F.when(summed, F.round("value", 6)).otherwise(F.col("value")))


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("total", F.round("total", 6))


QUERIES = {
    "flight_csv_scan": flight_csv_scan,
    "flight_defaults": flight_defaults,
    "vertices": lambda s, d: routes.vertices(nation_routes(s, d)),
    "vertex_count": vertex_count,
    "vertex_index": lambda s, d: routes.vertex_index(routes.vertices(user_hops(s, d))),
    "route_dedup_sql": lambda s, d: routes.paired_delays_sql(s, nation_routes(s, d)),
    "route_avg_distinct": nation_edges,
    "route_avg_all": lambda s, d: routes.average_edges(nation_routes(s, d), distinct=False),
    "adjacency": adjacency,
    "unreached_neighbors": unreached_neighbors,
    "spt_nation": lambda s, d: trees.shortest_path_tree(nation_edges(s, d)),
    "spt_users": lambda s, d: trees.shortest_path_tree(user_edges(s, d)),
    "spt_users_sparse": spt_users_sparse,
    "spt_compat_rows": spt_compat,
    "mst_nation": lambda s, d: trees.minimum_spanning_forest(nation_edges(s, d)),
    "mst_users": lambda s, d: trees.minimum_spanning_forest(user_edges(s, d)),
    "msf_users_sparse": lambda s, d: trees.minimum_spanning_forest(daily_edges(s, d)),
    "msf_supplier_part": supplier_part_forest,
    "msf_supplier_part_size": lambda s, d: supplier_part_forest(s, d).agg(
        F.count("*").alias("edges")
    ),
    "mst_lead_times": lambda s, d: trees.minimum_spanning_forest(
        routes.average_edges(nation_lead_times(s, d))
    ),
    "tree_complement": tree_complement,
    "complement_strength": lambda s, d: _rounded(complement_strength(s, d)),
    "bottleneck": lambda s, d: _rounded(analysis.bottleneck(complement_strength(s, d))),
    "scaled_edges": scaled_edges,
    "mst_after": lambda s, d: _report(s, d, "mst").after,
    "spt_after": lambda s, d: _report(s, d, "spt").after,
    "tree_weight": tree_weight,
    "tree_diff": lambda s, d: _report(s, d).diff,
    "tree_diff_spt": lambda s, d: _report(s, d, "spt").diff,
    "delay_report": report_rows,
    "delay_report_spt": lambda s, d: report_rows(s, d, "spt"),
}

_NATION = (sql.NATION_ROUTES, sql.EDGES)
_USERS = (sql.USER_ROUTES, sql.EDGES)
_SPARSE = (sql.DAILY_ROUTES, sql.EDGES)
_MST_BEFORE = (*_NATION, sql.spanning("edges", "tree", 5), sql.relief("tree"))
_MST_AFTER = (*_MST_BEFORE, sql.spanning("scaled", "later", 5))
_SPT_AFTER = (
    *_NATION,
    sql.shortest("edges", "tree", 10),
    sql.relief("tree_edges"),
    sql.shortest("scaled", "later", 10),
)

_REPORT = """
    SELECT 'tree_before' AS section, src, dst, weight AS value FROM {before}
    UNION ALL SELECT 'total_before', NULL, NULL, round(sum(weight), 6) FROM {before}
    UNION ALL SELECT 'bottleneck', vertex, NULL, round(total, 6) FROM worst
    UNION ALL SELECT 'tree_after', src, dst, weight FROM {after}
    UNION ALL SELECT 'total_after', NULL, NULL, round(sum(weight), 6) FROM {after}"""

SQL = {
    "flight_csv_scan": """
        SELECT l_suppkey AS origin_id, l_returnflag AS carrier, count(*) AS flights,
               sum(l_quantity) AS departure_delay,
               sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS arrival_delay,
               sum(CASE WHEN l_linestatus = 'F' THEN 900 + l_quantity ELSE 0 END) AS arrival_time
        FROM lineitem GROUP BY l_suppkey, l_returnflag""",
    "flight_defaults": """
        SELECT doc_id, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic
        FROM documents LEFT JOIN labels USING (doc_id)""",
    "vertices": sql.query(sql.NATION_ROUTES, sql.VERTICES, select="SELECT id FROM ids"),
    "vertex_count": sql.query(
        sql.NATION_ROUTES, sql.VERTICES, select="SELECT count(*) AS vertices FROM ids"
    ),
    "vertex_index": sql.query(
        sql.USER_ROUTES,
        sql.VERTICES,
        select='SELECT id, row_number() OVER (ORDER BY id) AS "index" FROM ids',
    ),
    "route_dedup_sql": sql.query(
        sql.NATION_ROUTES,
        select="""
        SELECT DISTINCT least(origin_id, destination_id) AS origin_id,
               greatest(origin_id, destination_id) AS destination_id, departure_delay
        FROM routes WHERE origin_id <> destination_id""",
    ),
    "route_avg_distinct": sql.query(*_NATION, select="SELECT * FROM edges"),
    "route_avg_all": sql.query(
        sql.NATION_ROUTES, sql.ALL_EDGES, select="SELECT * FROM edges"
    ),
    "adjacency": sql.query(
        *_NATION,
        sql.VERTICES,
        """
numbered AS (SELECT id, row_number() OVER (ORDER BY id) AS i FROM ids),
rows_ AS (SELECT o.i AS oi, src, d.i AS di, dst, weight FROM edges
          JOIN numbered o ON o.id = src JOIN numbered d ON d.id = dst)""",
        select="""
        SELECT oi AS origin_index, src AS origin_id, di AS destination_index,
               dst AS destination_id, weight FROM rows_
        UNION ALL SELECT di, dst, oi, src, weight FROM rows_""",
    ),
    "unreached_neighbors": sql.query(
        *_USERS,
        sql.VERTICES,
        "start AS (SELECT min(least(src, dst)) AS v FROM edges)",
        select="""
        SELECT id FROM ids, start WHERE id <> v AND NOT EXISTS (
            SELECT 1 FROM edges WHERE (src = v AND dst = id) OR (dst = v AND src = id))""",
    ),
    "spt_nation": sql.query(
        *_NATION, sql.shortest("edges", "tree", 10), select="SELECT * FROM tree"
    ),
    "spt_users": sql.query(
        *_USERS, sql.shortest("edges", "tree", 16), select="SELECT * FROM tree"
    ),
    "spt_users_sparse": sql.query(
        *_SPARSE,
        sql.VERTICES,
        sql.shortest("edges", "tree", 16),
        select="""
        SELECT t.parent, i.id AS vertex, t.edge_weight, t.dist
        FROM ids i LEFT JOIN tree t ON t.vertex = i.id
        WHERE i.id IS DISTINCT FROM (SELECT vertex FROM tree_s0)""",
    ),
    "spt_compat_rows": sql.query(
        *_SPARSE,
        sql.VERTICES,
        sql.shortest("edges", "tree", 16),
        select=f"""
        SELECT CASE WHEN i.id = s.vertex THEN s.vertex ELSE coalesce(t.parent, -1) END
                   AS from_index,
               i.id AS "index",
               coalesce(t.dist, CAST({trees.UNREACHED!r} AS DOUBLE)) AS distance
        FROM ids i, tree_s0 s LEFT JOIN tree_all t ON t.vertex = i.id""",
    ),
    "mst_nation": sql.query(
        *_NATION, sql.spanning("edges", "tree", 5), select="SELECT * FROM tree"
    ),
    "mst_users": sql.query(
        *_USERS, sql.spanning("edges", "tree", 8), select="SELECT * FROM tree"
    ),
    "msf_users_sparse": sql.query(
        *_SPARSE, sql.spanning("edges", "tree", 8), select="SELECT * FROM tree"
    ),
    # A forest has as many edges as there are vertices less components.
    "msf_supplier_part_size": sql.query(
        sql.SUPPLIER_PART_ROUTES,
        sql.EDGES,
        sql.VERTICES,
        sql.components(8),
        select="SELECT count(*) - count(DISTINCT component) AS edges FROM c8",
    ),
    "mst_lead_times": sql.query(
        sql.LEAD_TIME_ROUTES,
        sql.EDGES,
        sql.spanning("edges", "tree", 5),
        select="SELECT * FROM tree",
    ),
    "tree_complement": sql.query(*_MST_BEFORE, select="SELECT * FROM complement"),
    "complement_strength": sql.query(
        *_MST_BEFORE, select="SELECT vertex, round(total, 6) AS total FROM strength"
    ),
    "bottleneck": sql.query(
        *_MST_BEFORE, select="SELECT vertex, round(total, 6) AS total FROM worst"
    ),
    "scaled_edges": sql.query(*_MST_BEFORE, select="SELECT * FROM scaled"),
    "mst_after": sql.query(*_MST_AFTER, select="SELECT * FROM later"),
    "spt_after": sql.query(*_SPT_AFTER, select="SELECT * FROM later"),
    "tree_weight": sql.query(
        *_MST_AFTER,
        select="""
        SELECT 'before' AS tree, round(sum(weight), 6) AS total FROM tree
        UNION ALL SELECT 'after', round(sum(weight), 6) FROM later""",
    ),
    "tree_diff": sql.query(*_MST_AFTER, select=sql.DIFF.format(before="tree", after="later")),
    "tree_diff_spt": sql.query(
        *_SPT_AFTER, select=sql.DIFF.format(before="tree_edges", after="later_edges")
    ),
    "delay_report": sql.query(
        *_MST_AFTER, select=_REPORT.format(before="tree", after="later")
    ),
    "delay_report_spt": sql.query(
        *_SPT_AFTER, select=_REPORT.format(before="tree_edges", after="later_edges")
    ),
}
