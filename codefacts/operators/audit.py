"""Audit analytics over the linked facts, SURVEY K1-K6 and P1.

Reachability is a frontier loop: each step joins the pairs found last with the
edge table and appends the pairs that are new. It ends when a step finds none.
Each step is written into the shared folder, so lineage stays short and a
lost executor recomputes one step, not the whole loop. The slice to effects
walks components of the call graph instead of functions, in their order, so
that each pair is found in one step and none has to be compared with all before.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from codefacts.operators.callgraph import call_base
from codefacts.session import checkpoint_dir, cut, shuffled, written

#: So many edges are taken into the memory of one task; more are treated in rounds of joins.
IN_ONE_TASK = 1_000_000


def base_edges(edges: DataFrame, match: str = "base") -> DataFrame:
    """``(src, dst)`` from call edges; ``match='base'`` links ``pkg.F`` to ``F``."""
    dst = call_base("callee") if match == "base" else F.col("callee")
    return edges.select(F.col("caller").alias("src"), dst.alias("dst")).distinct()


def _closure(start: DataFrame, edges: DataFrame) -> DataFrame:
    """``(source, node, depth)``: all nodes that ``edges(src, dst)`` lead to from
    the pairs ``start(source, node)``, with the least number of steps.

    Only the pairs found last are joined with the edges; pairs known already are
    taken off by an anti join, and each step writes its new pairs alone. Every 16
    steps the parts are written together, so plans of long chains stay short.
    """
    last = written(start.select("source", "node").distinct().withColumn("depth", F.lit(0)))
    seen, step = last, 0
    while not last.isEmpty():
        step += 1
        nxt = (last.join(shuffled(edges), last["node"] == edges["src"])
               .select("source", F.col("dst").alias("node")).distinct())
        last = written(nxt.join(shuffled(seen.select("source", "node")), ["source", "node"], "left_anti")
                       .withColumn("depth", F.lit(step)))
        seen = seen.unionByName(last)
        if step % 16 == 0:
            seen = written(seen)
    return seen


def reachable(edges: DataFrame, sources: DataFrame) -> DataFrame:
    """K1: ``(source, function_name, depth)``: functions reachable from each
    source (an entry point or effect), with the least number of steps.

    ``edges(src, dst)``; ``sources(source)``. Sources reach themselves at
    depth 0.
    """
    e = cut(edges.select("src", "dst").distinct())
    found = _closure(sources.select("source", F.col("source").alias("node")), e)
    return found.select("source", F.col("node").alias("function_name"), "depth")


def _graph(batches: Iterator[pa.RecordBatch]) -> tuple[list[str], np.ndarray, list[int], list[int]]:
    """The names of the nodes, the sources of the edges as numbers, and the nodes
    that each node ``v`` leads to: ``to[first[v]:first[v + 1]]``."""
    ends = [[], []]
    for b in batches:
        for side, column in zip(ends, ("src", "dst")):
            side.append(b.column(column).cast(pa.large_string()))
    coded = pa.chunked_array(ends[0] + ends[1], pa.large_string()).combine_chunks().dictionary_encode()
    src, dst = np.split(coded.indices.to_numpy(), 2)
    first = np.concatenate([[0], np.cumsum(np.bincount(src, minlength=len(coded.dictionary)))])
    return coded.dictionary.to_pylist(), src, first.tolist(), dst[np.argsort(src, kind="stable")].tolist()


def _components_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(node, component)`` of the edges in memory (Tarjan, without recursion)."""
    names, _, first, to = _graph(batches)
    found, low, place = [0] * len(names), [0] * len(names), first[:-1]
    open_, count, nodes, components = [], 0, [], []
    for root in range(len(names)):
        path = [] if found[root] else [root]
        while path:
            v = path[-1]
            if not found[v]:
                count += 1
                found[v] = low[v] = count
                open_.append(v)
            if place[v] < first[v + 1]:
                w = to[place[v]]
                place[v] += 1
                if not found[w]:
                    path.append(w)
                elif low[w]:                        # 0 marks the nodes whose component is known
                    low[v] = min(low[v], found[w])
                continue
            path.pop()
            least = low[v]
            if least == found[v]:
                members = []
                while not members or members[-1] != v:
                    members.append(open_.pop())
                    low[members[-1]] = 0
                if len(members) > 1:
                    texts = [names[m] for m in members]
                    nodes += texts
                    components += [min(texts)] * len(texts)
            if path and least < low[path[-1]]:
                low[path[-1]] = least
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.string()), pa.array(components, pa.string())],
                                     ["node", "component"])


def _turns_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(node, turn)`` of the edges in memory: the most steps that lead to a node
    (only nodes that lead on)."""
    names, src, first, to = _graph(batches)
    left = np.bincount(to, minlength=len(names)).tolist() if to else []
    rank = [0] * len(names)
    ready = [v for v, n in enumerate(left) if not n]
    for v in ready:                                 # grows on the way
        for w in to[first[v]:first[v + 1]]:
            rank[w] = max(rank[w], rank[v] + 1)
            left[w] -= 1
            if not left[w]:
                ready.append(w)
    on = np.unique(src).tolist()
    yield pa.RecordBatch.from_arrays([pa.array([names[v] for v in on], pa.string()),
                                      pa.array([rank[v] for v in on], pa.int32())], ["node", "turn"])


def _on_cycles(edges: DataFrame, few: int = 0) -> DataFrame:
    """The edges left when those from a node nobody leads to, or to a node that
    leads nowhere, are taken away again and again, until no more go or ``few``
    are left."""
    rest, n, before = edges, edges.count(), -1
    while n > few and n != before:
        led_to = rest.select(F.col("dst").alias("src")).distinct()
        leads = rest.select(F.col("src").alias("dst")).distinct()
        rest = cut(rest.join(shuffled(led_to), "src", "left_semi").join(shuffled(leads), "dst", "left_semi").select("src", "dst"))
        n, before = rest.count(), n
    return rest


def _smallest_before(edges: DataFrame) -> DataFrame:
    """``(node, root)``: the smallest node that leads to each node of ``edges``
    (the node itself included). A round passes on the roots that changed last."""
    nodes = edges.select(F.col("src").alias("node")).unionByName(edges.select(F.col("dst").alias("node"))).distinct()
    known = changed = cut(nodes.withColumn("root", F.col("node")))
    while not changed.isEmpty():
        offers = (changed.join(shuffled(edges), changed["node"] == edges["src"])
                  .groupBy(F.col("dst").alias("node")).agg(F.min("root").alias("offer")))
        changed = cut(known.join(shuffled(offers), "node").where("offer < root").select("node", F.col("offer").alias("root")))
        known = cut(known.join(shuffled(changed), "node", "left_anti").unionByName(changed))
    return known


def strong_components(edges: DataFrame, in_one_task: int = IN_ONE_TASK) -> DataFrame:
    """K1: ``(node, component)`` for the nodes of ``edges(src, dst)`` that call
    each other in a cycle: two of them share a component, named after its
    smallest node, if each leads to the other. Nodes that are not listed are
    alone in theirs; null ends count as no edge.

    Forward / backward colouring: every node takes the smallest node that leads
    to it as its colour; a node of its own colour is a root, and what leads back
    to the root inside the colour is the root's component. Edges between colours
    lie on no cycle. Found components go and the rest is coloured again, until
    ``in_one_task`` edges are left, which one task takes into its memory.
    """
    rest = cut(edges.where("src <> dst").select("src", "dst").distinct())
    out = rest.select(F.col("src").alias("node"), F.col("src").alias("component")).limit(0)
    while True:
        rest = _on_cycles(rest, in_one_task)
        if rest.count() <= in_one_task:
            last = rest.repartition(1).mapInArrow(_components_of, "node string, component string")
            return out.unionByName(written(last))
        colour = _smallest_before(rest)
        src, dst = (colour.select(F.col("node").alias(c), F.col("root").alias(c + "_root")) for c in ("src", "dst"))
        same = cut(rest.join(shuffled(src), "src").join(shuffled(dst), "dst").where("src_root = dst_root").select("src", "dst"))
        back = same.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
        roots = colour.where("node = root").select(F.col("node").alias("source"), "node")
        # colours do not touch, so each node is found from one root only
        found = cut(_closure(roots, back).select("node", F.col("source").alias("component")))
        sizes = found.groupBy("component").agg(F.count("*").alias("n")).where("n > 1").drop("n")
        out = out.unionByName(found.join(shuffled(sizes), "component", "left_semi").select("node", "component"))
        gone = found.select("node")
        rest = cut(same.join(shuffled(gone.select(F.col("node").alias("src"))), "src", "left_anti")
                   .join(shuffled(gone.select(F.col("node").alias("dst"))), "dst", "left_anti").select("src", "dst"))


def _in_component(df: DataFrame, column: str, components: DataFrame) -> DataFrame:
    """``df`` with the node in ``column`` replaced by its component."""
    c = components.select(F.col("node").alias(column), "component")
    return df.join(shuffled(c), column, "left").withColumn(column, F.coalesce("component", column)).drop("component")


def _turns(edges: DataFrame, in_one_task: int = IN_ONE_TASK) -> tuple[DataFrame, int]:
    """``(node, turn)`` for the nodes of an acyclic ``edges(src, dst)``, earlier for
    ``src`` than for ``dst`` on each edge, and the last turn, that of the nodes
    that lead nowhere. Nodes nobody leads to take the first turns and nodes that
    lead nowhere the last ones, in rounds, until ``in_one_task`` edges are left."""
    rest, step, early, late = edges, 0, [], []
    while rest.count() > in_one_task:
        led_to = rest.select(F.col("dst").alias("node")).distinct()
        leads = rest.select(F.col("src").alias("node")).distinct()
        early.append(written(leads.join(shuffled(led_to), "node", "left_anti").withColumn("turn", F.lit(step))))
        late.append(written(led_to.join(shuffled(leads), "node", "left_anti").withColumn("turn", F.lit(-step))))
        rest = written(rest.join(shuffled(led_to.withColumnRenamed("node", "src")), "src", "left_semi")
                       .join(shuffled(leads.withColumnRenamed("node", "dst")), "dst", "left_semi").select("src", "dst"))
        step += 1
    between = written(rest.repartition(1).mapInArrow(_turns_of, "node string, turn int")
                      .withColumn("turn", F.col("turn") + step))
    most = between.agg(F.max("turn")).first()[0]
    last = step + (step - 1 if most is None else most) + 1
    for part in early + [x.withColumn("turn", F.col("turn") + last) for x in late]:
        between = between.unionByName(part)
    # the other nodes come between the early and the late ones, and behind all that is in ``rest``
    nodes = edges.select(F.col("src").alias("node")).unionByName(edges.select(F.col("dst").alias("node"))).distinct()
    turns = nodes.join(shuffled(between), "node", "left").withColumn("turn", F.coalesce("turn", F.lit(last - step)))
    return written(turns), last


def _walk(starts: DataFrame, edges: DataFrame, turns: DataFrame, last: int) -> DataFrame:
    """``(start, node)``: all nodes that an acyclic ``edges(src, dst)`` lead to from
    ``starts(node)``, themselves included.

    ``turns(node, turn)`` gives ``src`` an earlier turn than ``dst`` on each edge;
    nodes of turn ``last`` and those without a turn lead nowhere. When a node's
    turn comes, all starts that lead to it are known: they are passed on to the
    folders of the turns of the next nodes. So a step reads its own turn only,
    and each pair is passed on once.
    """
    spark = edges.sparkSession
    folder = f"{checkpoint_dir(spark).rstrip('/')}/walk-{uuid.uuid4().hex}"

    def add(rows: DataFrame, name: str) -> None:
        # few files: a file per turn, more where a turn has many rows
        rows.hint("rebalance", "turn").write.mode("append").partitionBy("turn").parquet(f"{folder}/{name}")

    def read(name: str, schema: str, turn: int) -> DataFrame | None:
        try:
            return spark.read.schema(schema).parquet(f"{folder}/{name}/turn={turn}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    src, dst = (turns.select(F.col("node").alias(c), F.col("turn").alias(t)) for c, t in (("src", "turn"), ("dst", "next")))
    add(edges.join(shuffled(src), "src").join(shuffled(dst), "dst"), "edges")
    add(starts.join(shuffled(turns), "node", "left")
        .select("node", F.col("node").alias("start"), F.coalesce("turn", F.lit(last)).alias("turn")), "pairs")
    for turn in range(last):
        pairs, ways = read("pairs", "node string, start string", turn), read("edges", "src string, dst string, next int", turn)
        if pairs and ways:
            add(pairs.distinct().join(shuffled(ways), F.col("node") == F.col("src"))
                .select(F.col("dst").alias("node"), "start", F.col("next").alias("turn")), "pairs")
    return (spark.read.schema("node string, start string, turn int").parquet(f"{folder}/pairs")
            .select("start", "node").distinct())


def effect_slice(edges: DataFrame, sources: DataFrame, effects: DataFrame, in_one_task: int = IN_ONE_TASK) -> DataFrame:
    """K1: ``(source, function_name, kind, effect)``: every effect (a database
    access, an error message) that each source reaches, with the function that
    has it; a source's own effects included.

    ``edges(src, dst)``; ``sources(source)``; ``effects(function_name, kind,
    effect)``. Repeated rows count once, null names take no part.

    Functions that call each other in a cycle reach the same effects, so the
    walk runs over components. It starts at the side that has fewer of them, the
    sources or (walking back) the effects, and stays where the other side can be
    met. Sources, or effects, of one component share a walk.
    """
    e = cut(edges.where("src IS NOT NULL AND dst IS NOT NULL").select("src", "dst").distinct())
    comp = strong_components(e, in_one_task)
    dag = cut(_in_component(_in_component(e, "src", comp), "dst", comp).where("src <> dst").distinct())
    ends = cut(_in_component(effects.where("function_name IS NOT NULL").select("function_name", "kind", "effect")
                             .distinct().withColumn("node", F.col("function_name")), "node", comp))
    starts = cut(_in_component(sources.where("source IS NOT NULL").select("source").distinct()
                               .withColumn("node", F.col("source")), "node", comp))
    back = starts.select("node").distinct().count() >= ends.select("node").distinct().count()
    if back:
        dag = dag.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    begin, goal = (ends, starts) if back else (starts, ends)
    against = dag.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    live = cut(_closure(goal.select(F.lit(0).alias("source"), "node"), against).select("node"))
    walked = cut(dag.join(shuffled(live.select(F.col("node").alias("src"))), "src", "left_semi")
                 .join(shuffled(live.select(F.col("node").alias("dst"))), "dst", "left_semi").select("src", "dst"))
    turns, last = _turns(walked, in_one_task)
    reached = _walk(begin.select("node").distinct().join(shuffled(live), "node", "left_semi"), walked, turns, last)
    at, to = ("node", "start") if back else ("start", "node")
    pairs = reached.select(F.col(at).alias("node"), F.col(to).alias("end"))
    hits = starts.join(shuffled(pairs), "node").select("source", F.col("end").alias("node"))
    return hits.join(shuffled(ends), "node").select("source", "function_name", "kind", "effect")


def effects(calls: DataFrame) -> DataFrame:
    """``source``: the functions with an effect, a database access or an error,
    from classified calls (G4-G6)."""
    return (calls.where(F.col("kind").isin("db", "error")).select(F.col("function_name").alias("source")).distinct())


def backward_slice(edges: DataFrame, effects: DataFrame) -> DataFrame:
    """K2: callers (transitively) of each effect function: K1 on reversed edges."""
    rev = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return reachable(rev, effects)


def orphan_functions(functions: DataFrame, edges: DataFrame, entry_handlers: DataFrame) -> DataFrame:
    """K3: defined functions that nobody calls (by base name) and that are not
    entry handlers: ``(function_name)``."""
    names = functions.select("function_name").distinct()
    called = edges.select(F.col("dst").alias("function_name")).distinct()
    handlers = entry_handlers.select(F.col("handler_symbol").alias("function_name")).distinct()
    return names.join(shuffled(called), "function_name", "left_anti").join(shuffled(handlers), "function_name", "left_anti")


def endpoint_coverage(entry_points: DataFrame, ep_requirements: DataFrame) -> DataFrame:
    """K4: ``(mapped, total)`` endpoints with at least one requirement."""
    m = ep_requirements.select("ep_id").distinct().withColumn("_m", F.lit(True))
    e = entry_points.select("ep_id").distinct().join(shuffled(m), "ep_id", "left")
    return e.agg(F.count_if(F.col("_m").isNotNull()).cast("bigint").alias("mapped"),
                 F.count("*").cast("bigint").alias("total"))


def uncovered_endpoints(entry_points: DataFrame, ep_requirements: DataFrame) -> DataFrame:
    """K4: endpoints without any requirement."""
    return entry_points.select("ep_id").distinct().join(shuffled(ep_requirements.select("ep_id").distinct()), "ep_id", "left_anti")


def enum_consistency(consts: DataFrame, labels: DataFrame, options: DataFrame) -> DataFrame:
    """K5: every value seen as a constant, a display label key or a select
    option, with one flag per side (full outer join on the value)."""
    c = consts.where(F.col("value").isNotNull()).select("value").distinct().withColumn("in_consts", F.lit(True))
    lab = labels.select("value").distinct().withColumn("in_labels", F.lit(True))
    o = options.select("value").distinct().withColumn("in_options", F.lit(True))
    j = c.join(shuffled(lab), "value", "full_outer").join(shuffled(o), "value", "full_outer")
    return j.select("value", *[F.coalesce(F.col(x), F.lit(False)).alias(x)
                               for x in ("in_consts", "in_labels", "in_options")])


def requirement_counts(requirements: DataFrame) -> DataFrame:
    """K6: requirements per ``(domain, side)`` with subtotals per domain and a
    grand total (``rollup``); ``level`` is the grouping id: 0 = detail,
    1 = domain subtotal, 3 = grand total."""
    return (requirements.rollup("domain", "side")
            .agg(F.count("*").cast("bigint").alias("n"), F.grouping_id().alias("level"))
            .select("domain", "side", "level", "n"))


def phase_inventory(outputs: dict[str, DataFrame]) -> DataFrame:
    """One row per produced table: ``(artifact, n_rows, status)`` with
    status ``done`` (rows produced) or ``empty``."""
    out = None
    for name, df in outputs.items():
        x = df.agg(F.count("*").cast("bigint").alias("n_rows")).select(F.lit(name).alias("artifact"), "n_rows")
        out = x if out is None else out.unionByName(x)
    return out.withColumn("status", F.when(F.col("n_rows") > 0, "done").otherwise("empty"))


def run_phases(spark: SparkSession, phases: dict[str, tuple[Callable[[], DataFrame], tuple[str, ...]]],
               base: str) -> DataFrame:
    """Run each phase in order, write its table to ``<base>/<phase>`` and
    return one row per phase: ``(phase, state, n_rows, error)``.

    ``phases`` maps a name to ``(make, needs)``: ``make()`` gives the phase's
    rows, ``needs`` names phases it builds on. ``done``: written, with the rows
    counted in the write itself. ``skipped``: an input folder does not exist.
    ``failed``: a needed phase is not done, or the phase raised an error of
    Spark's, whose condition is ``error``; the phases that do not need it still
    run. Other errors are raised.
    """
    rows: dict[str, tuple] = {}
    for name, (make, needs) in phases.items():
        missing = [x for x in needs if x not in rows or rows[x][1] != "done"]
        if missing:
            rows[name] = (name, "failed", None, "NEEDS " + ", ".join(missing))
            continue
        written = Observation()
        try:
            (make().observe(written, F.count(F.lit(1)).alias("n_rows"))
             .write.parquet(f"{base.rstrip('/')}/{name}"))
            rows[name] = (name, "done", written.get.get("n_rows", 0), None)
        except PySparkException as e:
            condition = e.getCondition()
            state = "skipped" if condition == "PATH_NOT_FOUND" else "failed"
            rows[name] = (name, state, None, condition or type(e).__name__)
    return spark.createDataFrame(list(rows.values()), "phase string, state string, n_rows bigint, error string")
