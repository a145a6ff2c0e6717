"""Queries on link ranks and ranked lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.operators import graph, retrieval
from rankloom.operators.metrics import l2_distance
from rankloom.plans.oracle import link as sql
from rankloom.plans.registry import Query, rounded, saved
from rankloom.plans.views import Views

VARIANTS = [f"C{i:02d}" for i in range(1, 11)]


def edges(v: Views) -> DataFrame:
    return saved(v, "edges", v.edges)


def global_ranks(v: Views, dangling: str = "reference") -> DataFrame:
    return saved(
        v, f"ranks-{dangling}",
        lambda: graph.pagerank_global(v.nodes(), edges(v), dangling=dangling),
    )


def topic_ranks(v: Views) -> DataFrame:
    return saved(
        v, "topic-ranks", lambda: graph.pagerank_topic(v.nodes(), edges(v), v.doc_topics())
    )


def personal(v: Views) -> DataFrame:
    return graph.mixture_scores(v.run(), topic_ranks(v), v.user_mix())


def by_query(v: Views) -> DataFrame:
    return graph.mixture_scores(v.run(), topic_ranks(v), v.query_mix())


def scored(v: Views) -> DataFrame:
    return retrieval.run_score_join(v.run(), global_ranks(v))


def _fused(variant: str) -> Query:
    return Query(
        lambda v: rounded(retrieval.fuse_cm(scored(v), variant).select("user_id", "query_id", "doc", "score")),
        sql.fuse_cm(variant),
    )


def _random_fusion(v: Views) -> DataFrame:
    return retrieval.fuse_cm(scored(v), "C00").select("user_id", "query_id", "doc", "score")


def _topic_docs(v: Views) -> DataFrame:
    """Members of each topic, one row each so that no group is held by one task, and their number."""
    sizes = v.doc_topics().groupBy("topic").agg(F.count(F.lit(1)).alias("docs"))
    return v.doc_topics().select("topic", "doc").distinct().join(sizes, "topic")


def _repeats(v: Views) -> DataFrame:
    """The run with every third document a second time, later and less relevant."""
    run = v.run()
    again = run.filter("doc % 3 = 1 AND doc % 2 = 0").withColumn("rel", F.col("rel") - 0.5)
    return run.withColumn("orig_rank", F.lit(1)).unionByName(again.withColumn("orig_rank", F.lit(2)))


def _step_distance(v: Views) -> DataFrame:
    """Distance between the two ways of handling dangling mass."""
    return rounded(l2_distance(global_ranks(v), global_ranks(v, "uniform"), "id", "rank"), 12)


QUERIES: dict[str, Query] = {
    "row_normalise_edges": Query(lambda v: rounded(graph.row_normalise_edges(edges(v))), sql.ROW_NORMALISE),
    "dangling_nodes": Query(lambda v: graph.dangling_nodes(v.nodes(), edges(v)), sql.DANGLING),
    "topic_teleport": Query(lambda v: rounded(graph.topic_teleport(v.doc_topics()), 12), sql.TELEPORT),
    "topic_doc_group": Query(_topic_docs, sql.TOPIC_GROUP),
    "spmv_join": Query(
        lambda v: rounded(
            graph.row_normalise_edges(edges(v))
            .join(graph.topic_teleport(v.doc_topics()).groupBy(F.col("doc").alias("src")).agg(F.sum("p").alias("x")), "src")
            .groupBy(F.col("dst").alias("id"))
            .agg(F.sum(F.col("p") * F.col("x")).alias("y")),
            12,
        ),
        sql.SPMV,
    ),
    "pagerank_global": Query(lambda v: rounded(global_ranks(v), 12), sql.global_result()),
    "pagerank_global_uniform": Query(
        lambda v: rounded(global_ranks(v, "uniform"), 12), sql.global_result("uniform")
    ),
    "pagerank_topic": Query(lambda v: rounded(topic_ranks(v), 12), sql.topic_result()),
    "pagerank_query": Query(lambda v: rounded(by_query(v), 12), sql.mixture_result("query_mix")),
    "pagerank_personal": Query(lambda v: rounded(personal(v), 12), sql.mixture_result("user_mix")),
    "l2_distance": Query(_step_distance, sql.distance()),
    "run_score_join": Query(
        lambda v: rounded(scored(v).select("user_id", "query_id", "doc", "rel", "rank"), 12), sql.scored_result()
    ),
    "score_range": Query(
        lambda v: rounded(retrieval.score_range(scored(v), ["rank", "rel"]), 12), sql.score_range()
    ),
    "l1_norms": Query(lambda v: rounded(retrieval.l1_norms(scored(v), "rel"), 6), sql.l1_norms()),
    "list_minmax": Query(
        lambda v: rounded(
            retrieval.list_minmax(scored(v), ["rank", "rel"]).select(
                "user_id", "query_id", "doc", "rank_unit", "rel_unit"
            ),
            9,
        ),
        sql.list_minmax(),
    ),
    "list_l1": Query(
        lambda v: rounded(
            retrieval.list_l1(scored(v), "rank", "share").select("user_id", "query_id", "doc", "share"), 9
        ),
        sql.list_l1(),
    ),
    "fuse_ns": Query(
        lambda v: rounded(retrieval.fuse_ns(scored(v)).select("user_id", "query_id", "doc", "score"), 12),
        sql.fuse_ns(),
    ),
    "fuse_ws": Query(
        lambda v: rounded(retrieval.fuse_ws(scored(v)).select("user_id", "query_id", "doc", "score"), 9),
        sql.fuse_ws(),
    ),
    **{f"fuse_cm_{c.lower()}": _fused(c) for c in VARIANTS},
    "fuse_cm_c00": Query(_random_fusion),
    "rank_run": Query(
        lambda v: retrieval.rank_run(retrieval.fuse_ws(scored(v))).select("user_id", "query_id", "doc", "position"),
        sql.ranked("global", "WS", with_score=False),
    ),
    "retrieve": Query(
        lambda v: rounded(retrieval.retrieve(v.run(), personal(v), "WS")), sql.ranked("user_mix", "WS")
    ),
    "retrieve_repeats": Query(
        lambda v: rounded(retrieval.retrieve(_repeats(v), personal(v), "WS")), sql.ranked("user_mix", "WS", repeats=True)
    ),
    "retrieve_query_cm": Query(
        lambda v: rounded(retrieval.retrieve(v.run(), by_query(v), "CM")), sql.ranked("query_mix", "CM")
    ),
    "retrieve_global_ns": Query(
        lambda v: rounded(retrieval.retrieve(v.run(), global_ranks(v), "NS")), sql.ranked("global", "NS")
    ),
}
