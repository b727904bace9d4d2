"""Mixing sources to target weights by min-cost flow over membership patterns.

Documents are aggregated by membership pattern (the set of sources that hold them). Each pattern
offers its words once per allowed repetition, at convex costs, so that fresh words are routed
before second and third copies. Sources are numbered by a range sort, and their targets found by
rounds of one aggregate each, of which the driver sees a few sums. The flow to the sources' quotas
is solved in tasks, one connected set of overlapping sources at a time (a source that shares no
document is such a set alone): any number of sources passes. A set's flow takes rounds linear in its
patterns, at most some twice the number of its sources for each repetition. Seeded selection then takes, of each pattern, all documents for every full
repetition and for the rest a prefix in seeded order, found from a histogram of seeded buckets and
exact sums within the one boundary bucket of each pattern.

Defined results: null text has size 0 and is never short of its target; a null source is a source
of its own, last in order, and so is an array without any; rows that repeat a doc_id are documents of
their own; an empty table gives no rows; all columns of docs pass through untouched, helper-like names
included, but a column named like one of RESULT gives way to the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tillweave.llm.components import components
from tillweave.llm.shared import WORD, need, settled, ship, text_of

ship(__name__)

BUCKETS = 4096
RESULT = ("mix_size", "mix_source_size", "mix_target", "mix_copies", "mix_taken")


def numbered(sources: DataFrame) -> DataFrame:
    """source, size, no: the place of each source by code point, null last, without a window over all."""
    dealt = settled(sources.orderBy(F.col("source").asc_nulls_last()).withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    # one row per partition of the sort
    counts = dealt.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = counts.select("part", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return dealt.withColumn("part", part).join(before, "part").select("source", "size", (F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)).alias("no"))


def targets(sources: DataFrame, weights: list[int], repeats: int) -> DataFrame:
    """sources (source, size, no) with target: the sum of sizes shared by weight, weights repeating by no.

    What exceeds repeats * size goes to the others by weight. A round sets the shares of the sources
    that are free and counts those that exceed; shares only rise, so rounds end when none is new
    (whole-number weights: after some dozens of rounds at most, in practice two to five).
    """
    turns = sources.withColumn("turn", F.col("no") % len(weights))
    sums = {r.turn: (r.n, int(r.size)) for r in turns.groupBy("turn").agg(F.count("*").alias("n"), F.sum("size").alias("size")).collect()}
    total = sum(size for _, size in sums.values())
    left, weight = total, sum(weights[t] * n for t, (n, _) in sums.items())
    while True:
        shares = F.array(*(F.lit(left * w / weight if weight else float("inf")) for w in weights))
        turns = sources.withColumn("turn", F.col("no") % len(weights)).withColumn("share", F.get(shares, F.col("turn").cast("int")))
        over = F.col("share") > F.col("size") * repeats
        seen = turns.groupBy("turn").agg(F.count_if(~over).alias("free"), F.sum(F.when(over, F.col("size")).otherwise(0)).alias("full")).collect()
        now = total - repeats * sum(int(r.full) for r in seen), sum(weights[r.turn] * r.free for r in seen)
        if now == (left, weight) or not weight:
            break
        left, weight = now
    return turns.select("source", "size", "no", F.when(over, (F.col("size") * repeats).cast("double")).otherwise(F.col("share")).alias("target"))


def min_cost_flow(patterns: list[tuple[frozenset[int], int]], quotas: list[int], repeats: int) -> list[int]:
    """Words that each pattern gives at the least cost, copy r of a pattern costing r * r.

    Only the copies cost anything, so the cheapest way of a word more is one of the lowest copy that still finds a way:
    copy after copy the flow is made as large as it can be. A round measures every node's distance to the sources that are short,
    backwards, then pushes along falling distances until no way of these lengths is left; distances grow from round to
    round, and none passes twice the number of sources.
    """
    members = [sorted(m) for m, _ in patterns]
    flow = [[0] * len(m) for m in members]
    holders: list[list[tuple[int, int]]] = [[] for _ in quotas]
    for p, m in enumerate(members):
        for k, s in enumerate(m):
            holders[s].append((p, k))
    room, short = [0] * len(patterns), list(quotas)
    for _ in range(repeats):
        for p, (_, size) in enumerate(patterns):
            room[p] += size
        while True:
            far_p, far_s = _distances(members, holders, flow, short)
            open_ = [p for p, d in enumerate(far_p) if d and room[p] > 0]
            if not open_:
                break
            at_p, at_s = [0] * len(members), [0] * len(quotas)
            for p in open_:
                _push(p, members, holders, flow, room, short, far_p, far_s, at_p, at_s)
    return [sum(f) for f in flow]


def _distances(members: list[list[int]], holders: list[list[tuple[int, int]]], flow: list[list[int]], short: list[int]) -> tuple[list[int], list[int]]:
    """Steps from every pattern and source to a source that is short, 0 where there is no way."""
    far_p, far_s = [0] * len(members), [int(q > 0) for q in short]
    line = [s for s, d in enumerate(far_s) if d]
    while line:
        reached = []
        for s in line:
            for p, _ in holders[s]:
                if not far_p[p]:
                    far_p[p] = far_s[s] + 1
                    reached.append(p)
        line = []
        for p in reached:
            for s, f in zip(members[p], flow[p], strict=True):
                if f and not far_s[s]:
                    far_s[s] = far_p[p] + 1
                    line.append(s)
    return far_p, far_s


def _push(first, members, holders, flow, room, short, far_p, far_s, at_p, at_s) -> None:
    """Route what pattern first has left along falling distances; at_p and at_s remember the ways already found closed."""
    on_p, on_s = [first], []
    while room[first] > 0:
        if len(on_s) < len(on_p):
            p = on_p[-1]
            m, k = members[p], at_p[p]
            while k < len(m) and far_s[m[k]] + 1 != far_p[p]:
                k += 1
            at_p[p] = k
            if k < len(m):
                on_s.append(m[k])
                continue
            on_p.pop()
            if not on_p:
                return
            at_s[on_s[-1]] += 1
            continue
        s = on_s[-1]
        if short[s] > 0 and far_s[s] == 1:
            back = [holders[t][at_s[t]] for t in on_s[:-1]]
            amount = min(room[first], short[s], *(flow[q][k] for q, k in back))
            for p in on_p:
                flow[p][at_p[p]] += amount
            for q, k in back:
                flow[q][k] -= amount
            room[first] -= amount
            short[s] -= amount
            on_p, on_s = [first], []
            continue
        j, ways = at_s[s], holders[s]
        while j < len(ways) and not (flow[ways[j][0]][ways[j][1]] and far_p[ways[j][0]] + 1 == far_s[s]):
            j += 1
        at_s[s] = j
        if j < len(ways):
            on_p.append(ways[j][0])
        else:
            on_s.pop()
            at_p[on_p[-1]] += 1


def routed(repeats: int):
    """Task function: the flow of each connected set of patterns, one row per pattern."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, words, given, size, target = [], [], [], [], []
            for one in batch.column("patterns"):
                patterns, at, quotas = one.as_py(), {}, []
                for p in patterns:
                    for m in p["members"]:
                        if m["no"] not in at:
                            at[m["no"]] = len(quotas)
                            quotas.append(int(m["target"] + 0.5))
                given += min_cost_flow([(frozenset(at[m["no"]] for m in p["members"]), p["words"]) for p in patterns], quotas, repeats)
                for p in patterns:
                    held.append(p["held"]), words.append(p["words"])
                    size.append(sum(m["size"] for m in p["members"])), target.append(float(sum(m["target"] for m in p["members"])))
            long = pa.int64()
            yield pa.RecordBatch.from_arrays(
                [pa.array(held, pa.list_(pa.string())), pa.array(words, long), pa.array(given, long), pa.array(size, long), pa.array(target, pa.float64())],
                ["held", "words", "given", "size", "target"],
            )

    return solve


def routes(hist: DataFrame, weights: list[int], repeats: int, single: bool) -> DataFrame:
    """Per pattern (held): words, given, and the size and target of its sources; hist has held, words."""
    patterns = hist.groupBy("held").agg(F.sum("words").cast("long").alias("words"))
    each = patterns.select("held", "words", F.explode("held").alias("source"))
    sources = settled(targets(settled(numbered(each.groupBy("source").agg(F.sum("words").cast("long").alias("size")))), weights, repeats))
    member = F.struct("no", sources["size"].alias("size"), "target")
    told = each.join(sources, each["source"].eqNullSafe(sources["source"])).select("held", "words", member.alias("member"))
    told = told.groupBy("held").agg(F.first("words").alias("words"), F.sort_array(F.collect_list("member")).alias("members"))
    told = told.withColumn("lead", F.expr("members[0].no"))
    if not single:
        told = settled(told)
        sets = components(told.select(F.col("lead").alias("a"), F.explode("members.no").alias("b")))
        told = told.join(sets, F.col("lead") == F.col("node"), "left").withColumn("lead", F.coalesce("component", "lead"))
    sets = told.groupBy("lead").agg(F.sort_array(F.collect_list(F.struct("held", "words", "members"))).alias("patterns")).select("patterns")
    return sets.mapInArrow(routed(repeats), "held array<string>, words long, given long, size long, target double")


def mix(docs: DataFrame, sources: str = "source", weights=(1, 2, 3), repeats: int = 3, seed: int = 17) -> DataFrame:
    """docs with mix_size, mix_source_size, mix_target and mix_taken.

    sources names a string column, or an array column where sources overlap; then
    mix_source_size and mix_target are summed over the row's sources. Weights are whole numbers.
    """
    need(docs, "doc_id", "text", sources)
    single = dict(docs.dtypes)[sources] == "string"
    given_columns = docs.columns
    docs = docs.select(F.col("doc_id").alias("__mx_id"), F.col("text").alias("__mx_text"), F.col(sources).alias("__mx_sources"), *[F.col(f"`{c}`").alias(f"__in_{i}") for i, c in enumerate(given_columns)])
    none = F.array(F.lit(None).cast("string"))
    held = F.array("__mx_sources") if single else F.when(F.size("__mx_sources") > 0, F.sort_array(F.array_distinct("__mx_sources"))).otherwise(none)
    draw = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("__mx_id").cast("string"), F.lit("")))), 1, 15), 16, 10)
    sized = docs.withColumns(
        {"mix_size": F.regexp_count(text_of("__mx_text"), F.lit(WORD)).cast("long"), "__mx_held": held, "__mx_draw": draw.cast("long")}
    ).withColumn("__mx_bucket", F.expr(f"cast(__mx_draw div {2**60 // BUCKETS} as int)"))
    hist = settled(sized.groupBy("__mx_held", "__mx_bucket").agg(F.sum("mix_size").alias("words")))
    flow = routes(hist.select(F.col("__mx_held").alias("held"), "words"), list(weights), repeats, single)
    plan = settled(
        flow.select(
            F.col("held").alias("__mx_held"),
            F.col("size").alias("mix_source_size"),
            F.col("target").alias("mix_target"),
            F.expr("if(words = 0, 0, given div words)").alias("__mx_full"),
            F.expr("if(words = 0, 0, given % words)").alias("__mx_rest"),
        )
    )
    before = F.coalesce(F.sum("words").over(W.partitionBy("__mx_held").orderBy("__mx_bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    # the buckets that the remainder ends in: empty ones before the boundary change nothing
    edges = (
        hist.withColumn("__mx_before", before)
        .join(plan, "__mx_held")
        .filter("__mx_before <= __mx_rest")
        .groupBy("__mx_held")
        .agg(F.max_by(F.struct(F.col("__mx_bucket").alias("edge"), F.col("__mx_before").alias("before")), "__mx_bucket").alias("__mx_edge"))
    )
    plan = settled(plan.join(edges, "__mx_held").select(F.col("__mx_held").alias("__mx_key"), "mix_source_size", "mix_target", "__mx_full", "__mx_rest", "__mx_edge"))
    rows = sized.join(plan, F.col("__mx_held") == F.col("__mx_key"))
    clear = rows.filter("__mx_bucket != __mx_edge.edge").withColumn("__mx_more", F.expr("if(__mx_bucket < __mx_edge.edge, 1, 0)"))
    order = W.partitionBy("__mx_held").orderBy("__mx_draw", F.col("__mx_id").asc_nulls_last(), "mix_size").rowsBetween(W.unboundedPreceding, -1)
    tight = rows.filter("__mx_bucket = __mx_edge.edge").withColumn(
        "__mx_more", ((F.coalesce(F.sum("mix_size").over(order), F.lit(0)) + F.col("__mx_edge.before")) * 2 + F.col("mix_size") <= F.col("__mx_rest") * 2).cast("int")
    )
    copies = F.least(F.lit(repeats), F.col("__mx_full") + F.col("__mx_more")).cast("int")
    out = clear.unionByName(tight).withColumns({"mix_copies": copies, "mix_taken": F.col("mix_size") * copies})
    return out.select(*[F.col(f"__in_{i}").alias(c) for i, c in enumerate(given_columns) if c.lower() not in RESULT], *RESULT)
