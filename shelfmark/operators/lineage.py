"""Lineage as a relation: what jobs read, write and compute inside, and what can be reached from a node.

Inputs are tables of facts: ``reads`` (job, source), ``writes`` (job, target, op) and ``inner``
(job, step, source) for named steps inside a job. The ``statement_*`` functions take such facts from a log of
SQL statements (job, sql_text), as ``statements`` gives it: a text is split into words, brackets and commas, and names are found by their
place among them. What a comment says counts for nothing.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.session import cut_lineage

FLOWS, WRITES = "FLOWS_TO", "WRITES_TO"

# What stands between words, the words before a table that is read, and those before one that is written.
COMMENT, WORD, SIGNS = r"(?s)/\*.*?\*/|--[^\n]*", r"[\w.]+|[(),]", ("(", ")", ",")
READING, WRITING = ("from", "join"), ("overwrite", "into", "table", "or", "replace", "external", "if", "not", "exists")

# Nodes of a round that each task of the next one holds in memory.
FEW = 500_000


def statements(log: DataFrame) -> DataFrame:
    """Words of every distinct statement of a job, and the names of the steps it defines: ``name AS (`` after WITH or a comma.

    Written once: later conditions are otherwise moved below the DISTINCT, and split each text again for each of its words.
    """
    text = F.lower(F.regexp_replace("sql_text", COMMENT, " "))
    words = cut_lineage(log.select("job", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words")).distinct())
    place = F.sequence(F.lit(2), F.greatest(F.size("words") - 2, F.lit(2)))
    at = lambda i: F.get("words", i - 1)
    opened = F.filter(place, lambda i: at(i - 1).isin("with", ",") & (at(i + 1) == "as") & (at(i + 2) == "(") & ~at(i).isin(*SIGNS))
    return words.withColumn("opened", opened).withColumn("defined", F.transform("opened", at))


def _read(words: Column) -> Column:
    """Names that follow FROM or JOIN."""
    after = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("name"), F.get(words, i - 1).alias("before"))), lambda x: x["before"].isin(*READING))
    return F.array_distinct(F.filter(F.transform(after, lambda x: x["name"]), lambda name: ~name.isin(*SIGNS)))


def statement_reads(said: DataFrame) -> DataFrame:
    """(job, source): tables that statements read, without the names of their own steps."""
    return said.select("job", F.explode(F.array_except(_read(F.col("words")), "defined")).alias("source")).distinct()


def statement_writes(said: DataFrame) -> DataFrame:
    """(job, target, op): tables that statements insert into or create."""
    words = F.col("words")
    after = lambda verb: F.slice(words, F.array_position(words, verb).cast("int") + 1, F.size(words))
    named = lambda verb: F.when(F.array_contains(words, verb), F.get(F.filter(after(verb), lambda w: ~w.isin(*WRITING)), F.lit(0)))
    kind = F.get(F.filter(after("create"), lambda w: ~w.isin("or", "replace", "external")), F.lit(0))
    inserted, created = named("insert"), F.when(kind == "table", named("create"))
    text = F.array_join(words, " ")
    op = (F.when(inserted.isNotNull(), "INSERT").when(text.contains(" as select "), "CTAS")
          .when(F.get(after("create"), F.lit(0)) == "or", "REPLACE").otherwise("CREATE"))
    return said.select("job", F.coalesce(inserted, created).alias("target"), op.alias("op")).filter("target is not null").distinct()


def statement_steps(said: DataFrame) -> DataFrame:
    """(job, step, source, of_step): what each step of a statement reads between its brackets; ``of_step`` if that is a step too."""
    words = F.col("words")
    steps = said.select("job", "words", "defined", F.explode("opened").alias("i"))
    rest = F.slice(words, F.col("i") + 3, F.size(words))
    depth = lambda s, w: s["depth"] + F.when(w == "(", 1).when(w == ")", -1).otherwise(0)
    inside = F.aggregate(
        rest, F.struct(F.lit(1).alias("depth"), F.lit(0).alias("n")),
        lambda s, w: F.when(s["depth"] == 0, s).otherwise(F.struct(depth(s, w).alias("depth"), (s["n"] + 1).alias("n"))))["n"]
    found = steps.select("job", "defined", F.get(words, F.col("i") - 1).alias("step"), F.explode(_read(F.slice(rest, F.lit(1), inside))).alias("source"))
    return found.select("job", "step", "source", F.array_contains("defined", F.col("source")).alias("of_step")).distinct()


def statement_edges(said: DataFrame) -> DataFrame:
    """``edges`` of a statement log; a step is named with its job."""
    own = lambda name: F.concat("job", F.lit("/"), name)
    steps = statement_steps(said).select(
        "job", own("step").alias("step"), F.when(F.col("of_step"), own("source")).otherwise(F.col("source")).alias("source"))
    return edges(statement_reads(said), statement_writes(said), steps)


def edges(reads: DataFrame, writes: DataFrame, inner: DataFrame) -> DataFrame:
    """Distinct (src, dst, kind, job, op) edges between datasets, inner steps and jobs."""
    none = F.lit(None).cast("string")
    flow = lambda rows, src, dst: rows.select(
        F.col(src).alias("src"), F.col(dst).alias("dst"), F.lit(FLOWS).alias("kind"), F.col("job"), none.alias("op"))
    written = writes.select(F.col("job").alias("src"), F.col("target").alias("dst"), F.lit(WRITES).alias("kind"), "job", "op")
    parts = [flow(reads, "source", "job"), written, flow(inner, "source", "step"), flow(inner, "step", "job")]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.distinct()


def reachable(links: DataFrame, start: str, upstream: bool = False) -> DataFrame:
    """Every node that can be reached from ``start``, with the least number of steps to it.

    Semi-naive closure: each round asks for the edges of the nodes found in the round before, and only
    those, and drops what was visited. It ends when a round finds nothing new, however long the paths
    are; cycles end too. While a round's nodes are few, they are sent to where the facts are read, so neither
    the edges nor anything else of the size of the graph is shuffled or written. Once they are many,
    the edges are written and joined by their nodes.
    """
    here, there = ("dst", "src") if upstream else ("src", "dst")
    spark, steps, found = links.sparkSession, None, 1
    visited = frontier = spark.range(1).select(F.lit(start).alias("node"), F.lit(0).alias("steps"))
    for number in itertools.count(1):
        asked = frontier.select(F.col("node").alias("here"))
        if found <= FEW and steps is None:
            met = links.join(F.broadcast(asked), F.col(here) == F.col("here"), "left_semi").select(F.col(there).alias("node"))
        else:
            steps = steps or cut_lineage(links.select(F.col(here).alias("here"), F.col(there).alias("node")).distinct())
            met = steps.join(asked, "here", "left_semi").select("node")
        new = met.distinct().join(visited.select("node"), "node", "left_anti")
        frontier = cut_lineage(new.withColumn("steps", F.lit(number)))
        found = frontier.count()
        if not found:
            return visited.filter(F.col("node") != start)
        visited = visited.unionByName(frontier)


def readers(links: DataFrame, name: str) -> DataFrame:
    """Jobs that read or write a dataset."""
    reads = links.filter((F.col("src") == name) & (F.col("dst") == F.col("job"))).select("job", F.lit("reads").alias("role"))
    writes = links.filter((F.col("dst") == name) & (F.col("kind") == WRITES)).select("job", F.lit("writes").alias("role"))
    return reads.unionByName(writes).distinct()


def layer_paths(links: DataFrame, lower: str, middle: str, upper: str) -> DataFrame:
    """Paths of datasets over two jobs, through the layers whose names start with the given prefixes."""
    moves = links.filter((F.col("kind") == FLOWS) & (F.col("dst") == F.col("job"))).select("src", "job").join(
        links.filter(F.col("kind") == WRITES).select("job", "dst"), "job").distinct()
    between = lambda first, second: F.col("src").startswith(first) & F.col("dst").startswith(second)
    up = moves.filter(between(lower, middle)).select(
        F.col("src").alias("lower"), F.col("job").alias("middle_job"), F.col("dst").alias("middle"))
    on = moves.filter(between(middle, upper)).select(
        F.col("src").alias("middle"), F.col("job").alias("upper_job"), F.col("dst").alias("upper"))
    return up.join(on, "middle").select("lower", "middle_job", "middle", "upper_job", "upper")


def hot_datasets(links: DataFrame) -> DataFrame:
    """Datasets read by more than one job."""
    reads = links.filter((F.col("kind") == FLOWS) & (F.col("dst") == F.col("job"))).join(
        links.filter(F.col("kind") == FLOWS).filter(F.col("dst") != F.col("job")).select(F.col("dst").alias("src")).distinct(), "src", "left_anti")
    # One row per dataset and job, counted in two steps, so a dataset with very many readers is no single task's work.
    counted = reads.select("src", "job").distinct().groupBy("src").agg(F.count(F.lit(1)).alias("job_count"))
    return counted.filter("job_count > 1").withColumnRenamed("src", "dataset")
