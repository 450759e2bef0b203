"""PageRank over an edge table ``(src, dst)``.

N counts pages with at least one link. Targets without links take part with rank 0 at the start;
their rank is not redistributed.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pagelode.operators import links
from pagelode.operators.joins import spread_join
from pagelode.session import materialise

DAMPING = 0.85
TOLERANCE = 1e-6
# Links of one page per block: a page with more links is shared by several tasks.
BLOCK_LINKS = 100_000
MATERIALISE_EVERY = 5


def initial_ranks(edges: DataFrame) -> DataFrame:
    """``id, rank``: 1/N for each page with links."""
    sources = edges.select(F.col("src").alias("id")).distinct()
    n = sources.agg(F.count(F.lit(1)).alias("n"))
    return sources.join(F.broadcast(n)).select("id", (1.0 / F.col("n")).alias("rank"))


def contributions(ranks: DataFrame, edges: DataFrame) -> DataFrame:
    """``src, dst, contrib``: rank over out-degree along every link."""
    share = ranks.withColumnRenamed("id", "src").join(links.out_degree(edges), "src")
    return spread_join(edges, share, ["src"], [F.col("dst")]).select("src", "dst", (F.col("rank") / F.col("n")).alias("contrib"))


class RankGraph:
    """Edges laid out for iteration: written once, partitioned by source block and kept in
    memory, so that an iteration moves ranks and contributions, never edges.

    Every page also has one row leading to itself in block -1. It carries the page's own state
    through the same join and aggregation as the contributions, so a step reads the old ranks once
    and a chain of steps stays a straight line."""

    def __init__(self, edges: DataFrame, damping: float = DAMPING):
        self.damping = damping
        edges = materialise(edges.select("src", "dst"), "edges")
        degrees = links.out_degree(edges)
        sources = degrees.select(
            F.col("src").alias("id"), "n", F.ceil(F.col("n") / BLOCK_LINKS).cast("int").alias("blocks")
        )
        targets = edges.select(F.col("dst").alias("id")).distinct()
        self.nodes = materialise(targets.join(sources, "id", "full"), "nodes")
        self.n_sources = self.nodes.filter("n IS NOT NULL").count()
        # Pages over the block size are few by definition: each holds that many edges.
        split = self.nodes.filter(F.col("blocks") > 1).select(F.col("id").alias("src"), "blocks")
        block = F.coalesce(F.pmod(F.xxhash64("dst"), F.col("blocks")), F.lit(0)).cast("int")
        links_out = edges.join(split, "src", "left").select("src", block.alias("block"), "dst")
        self_links = self.nodes.select(F.col("id").alias("src"), F.lit(-1).alias("block"), F.col("id").alias("dst"))
        self.edges = (
            links_out.unionByName(self_links).repartition("src", "block").persist(StorageLevel.MEMORY_AND_DISK)
        )

    def close(self) -> None:
        self.edges.unpersist()

    def start(self) -> DataFrame:
        first = F.when(F.col("n").isNull(), F.lit(0.0)).otherwise(F.lit(1.0 / max(self.n_sources, 1)))
        return self.nodes.select("id", "n", "blocks", first.alias("rank"))

    def step(self, ranks: DataFrame) -> DataFrame:
        """One Jacobi step over ``id, n, blocks, rank``; the old rank is kept as ``previous``.
        Contributions are summed map-side, so a page linked from most others is no hot spot."""
        sent = ranks.select(
            F.col("id").alias("src"),
            F.explode(F.sequence(F.lit(-1), F.coalesce("blocks", F.lit(0)) - 1)).alias("block"),
            "n",
            "blocks",
            "rank",
        )
        own = lambda c: F.max(F.when(F.col("block") == -1, F.col(c)))
        share = F.when(F.col("block") >= 0, F.col("rank") / F.col("n"))
        base = (1 - self.damping) / max(self.n_sources, 1)
        return (
            self.edges.join(sent, ["src", "block"])
            .groupBy(F.col("dst").alias("id"))
            .agg(
                own("n").alias("n"),
                own("blocks").alias("blocks"),
                F.sum(share).alias("received"),
                own("rank").alias("previous"),
            )
            .select(
                "id",
                "n",
                "blocks",
                (F.lit(base) + self.damping * F.coalesce("received", F.lit(0.0))).alias("rank"),
                "previous",
            )
        )


def pagerank_steps(edges: DataFrame, steps: int, damping: float = DAMPING) -> DataFrame:
    """A fixed number of iterations: ``id, rank``. Ranks are written every few steps to keep
    the lineage short."""
    graph = RankGraph(edges, damping)
    try:
        ranks = graph.start()
        for i in range(1, steps + 1):
            ranks = graph.step(ranks)
            if i % MATERIALISE_EVERY == 0 or i == steps:
                ranks = materialise(ranks, "ranks")
    finally:
        graph.close()
    return ranks.select("id", "rank")


def pagerank(
    edges: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE, max_steps: int = 1000
) -> DataFrame:
    """Iterate until no page moves by ``tolerance`` or more: ``id, rank``.

    Several iterations form one job that ends in a written table; the largest move of each is
    observed on the way. If an iteration inside the job was already still, the job is repeated
    up to it, so the result is that of stopping at the first still iteration. Ranks that are not still
    after ``max_steps`` raise an error."""
    graph = RankGraph(edges, damping)
    try:
        return _until_still(graph, tolerance, max_steps).select("id", "rank")
    finally:
        graph.close()


def _until_still(graph: RankGraph, tolerance: float, max_steps: int) -> DataFrame:
    ranks, done = graph.start(), 0
    while done < max_steps:
        steps = min(MATERIALISE_EVERY, max_steps - done)
        stepped, moves = ranks, []
        for _ in range(steps):
            moves.append(Observation())
            stepped = graph.step(stepped).observe(
                moves[-1], F.max(F.abs(F.col("rank") - F.col("previous"))).alias("move")
            )
        reached = materialise(stepped, "ranks")
        still = [i for i, move in enumerate(moves, 1) if (move.get["move"] or 0.0) < tolerance]
        if still and still[0] == steps:
            return reached
        if still:
            for _ in range(still[0]):
                ranks = graph.step(ranks)
            return materialise(ranks, "ranks")
        ranks, done = reached, done + steps
    raise RuntimeError(f"ranks still move by {tolerance} or more after {max_steps} steps")
