"""Mixing sources to target weights, by min-cost flow over membership patterns.

A document may belong to several sources. Documents with the same set of
sources, their pattern, are alike to the mix, so they are summed to one row,
and the mix is a flow of words

    start -> pattern -> source -> end

Each pattern has an arc for each time its words may be taken, as wide as the
pattern and dearer from one to the next (a convex cost: everything is taken
once before anything is taken twice). Each source's arc to the end is as wide
as its target. The cheapest of the largest flows says how many words each
pattern gives.

Within a pattern every document is taken as many whole times as the flow holds
the pattern's words; the rest goes to the documents before a cut in a seeded
order. The cut is found by summing the order's next ten bits over the documents
that are still open, until few are. Documents as large as what is missing then
fill it up. So no group is sorted or collected as a whole: a pattern that holds
a third of all rows is summed in part where it is read.

Only sums per pattern and source, and the documents that fill a pattern up, come
to the driver; more than ``MAX_PATTERNS`` patterns are an error.
"""

from __future__ import annotations

import heapq
import itertools
import json
from collections import defaultdict
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed

MAX_PATTERNS = 100_000  # different sets of sources; beyond, an error
ORDER, BITS = 60, 10  # bits of the seeded order, and those summed at a time
FEW = 2_000  # open documents of a pattern that are ordered in one task
FILLS = 8  # documents at most that fill what the cut leaves missing
WORDS = "[^\\x20\\x09-\\x0D]+"


# -- targets --------------------------------------------------------------
def targets(sizes: dict, weights: dict, total: int, most: int) -> dict:
    """Shares of ``total`` by weight, none above ``most`` times its source's
    size; what a source can't take is shared again among the others."""
    out, open_, left = {}, [s for s in sizes if weights[s] > 0], Fraction(total)
    out.update({s: Fraction(0) for s in sizes if weights[s] <= 0})
    while open_:
        level = left / sum(weights[s] for s in open_)
        full = [s for s in open_ if weights[s] * level > most * sizes[s]]
        if not full:
            return out | {s: weights[s] * level for s in open_}
        for s in full:
            out[s] = Fraction(most * sizes[s])
            left -= out[s]
        open_ = [s for s in open_ if s not in out]
    return out


def quotas(wanted: dict) -> dict:
    """Whole numbers next to the targets, with the same sum if that is whole."""
    out = {s: int(t) for s, t in wanted.items()}
    short = int(sum(wanted.values())) - sum(out.values())
    by_rest = sorted(wanted, key=lambda s: (out[s] - wanted[s], s is None, s or ""))
    for s in by_rest[:short]:
        out[s] += 1
    return out


# -- flow -----------------------------------------------------------------
class Flow:
    """Min-cost flow by successive shortest paths with potentials."""

    def __init__(self):
        self.out, self.arcs = defaultdict(list), []

    def arc(self, a, b, capacity: int, cost: int) -> int:
        self.arcs += [[b, capacity, cost], [a, 0, -cost]]
        self.out[a].append(len(self.arcs) - 2)
        self.out[b].append(len(self.arcs) - 1)
        return len(self.arcs) - 2

    def taken(self, arc: int) -> int:
        return self.arcs[arc ^ 1][1]

    def run(self, start, end) -> None:
        potential, ticket = defaultdict(int), itertools.count()
        while True:
            distance, came, heap, done = {start: 0}, {}, [(0, next(ticket), start)], set()
            while heap:
                d, _, at = heapq.heappop(heap)
                if at in done:
                    continue
                done.add(at)
                for i in self.out[at]:
                    to, room, cost = self.arcs[i]
                    if room <= 0:
                        continue
                    new = d + cost + potential[at] - potential[to]
                    if to not in distance or new < distance[to]:
                        distance[to], came[to] = new, i
                        heapq.heappush(heap, (new, next(ticket), to))
            if end not in distance:
                return
            for node, d in distance.items():
                potential[node] += min(d, distance[end])
            path, at = [], end
            while at != start:
                path.append(came[at])
                at = self.arcs[came[at] ^ 1][0]
            width = min(self.arcs[i][1] for i in path)
            for i in path:
                self.arcs[i][1] -= width
                self.arcs[i ^ 1][1] += width


def _parts(patterns: list[tuple]) -> list[list[int]]:
    """Places of the patterns, those that share a source (by any chain) together."""
    top: dict = {}

    def find(s):
        while top.setdefault(s, s) != s:
            top[s] = top[top[s]]
            s = top[s]
        return s

    for p in patterns:
        for s in p[1:]:
            top[find(s)] = find(p[0])
    groups = defaultdict(list)
    for i, p in enumerate(patterns):
        if p:
            groups[find(p[0])].append(i)
    return list(groups.values())


def route(patterns: list[tuple], sizes: list[int], quota: dict, most: int) -> list[int]:
    """Words that each pattern gives: the cheapest of the largest flows, the k-th
    time a pattern's words are taken costing k - 1 each."""
    out = [0] * len(patterns)
    for part in _parts(patterns):
        flow, first = Flow(), {}
        for i in part:
            first[i] = [flow.arc("start", ("pattern", i), sizes[i], k) for k in range(most)]
            for s in patterns[i]:
                flow.arc(("pattern", i), ("source", s), most * sizes[i], 0)
        for s in dict.fromkeys(s for i in part for s in patterns[i]):
            flow.arc(("source", s), "end", quota[s], 0)
        flow.run("start", "end")
        for i in part:
            out[i] = sum(flow.taken(a) for a in first[i])
    return out


# -- selection ------------------------------------------------------------
def _cuts(units: DataFrame, missing: dict[int, int]) -> list[tuple[int, int, int, int]]:
    """(pattern, low, high, left): the units of a pattern that come before ``low``
    in the order are taken, and ``left`` more words of the few up to ``high``."""
    spark, done, shift = units.sparkSession, [], ORDER - BITS
    open_ = [(p, 0, m) for p, m in missing.items()]
    while open_:
        state = F.broadcast(spark.createDataFrame(open_, "p int, low long, missing long"))  # a row a pattern
        digit = F.shiftright(F.col("place") - F.col("low"), shift).alias("digit")
        held = units.join(state, (F.col("pattern") == F.col("p")) & F.col("place").between(F.col("low"), F.col("low") + ((1 << (shift + BITS)) - 1)))
        sums = held.groupBy("pattern", "missing", "low", digit).agg(F.sum("words").alias("words"), F.count("*").alias("n"))
        # 1,024 rows a pattern at most
        reached = Window.partitionBy("pattern").orderBy("digit").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sums = sums.withColumn("to", F.sum("words").over(reached)).where("to > missing")
        first = sums.groupBy("pattern", "missing", "low").agg(F.min(F.struct("digit", "to", "words", "n")).alias("c"))
        open_ = []
        for r in first.select("pattern", "missing", "low", "c.*").collect():
            low, left = r.low + (r.digit << shift), r.missing - (r.to - r.words)
            if r.n <= FEW or not shift:
                done.append((r.pattern, low, low + (1 << shift), left))
            else:
                open_.append((r.pattern, low, left))
        shift -= BITS
    return done


def _chosen(units: DataFrame, missing: dict[int, int]) -> DataFrame:
    """The units with extra: of how many of their rows the missing words are made."""
    cuts = _cuts(units, missing)
    if not cuts:
        return units.withColumn("extra", F.lit(0).cast("long"))
    state = F.broadcast(units.sparkSession.createDataFrame(cuts, "p int, low long, high long, left_ long"))  # a row a pattern
    rows = units.join(state, F.col("pattern") == F.col("p"), "left")
    inside = F.coalesce((F.col("place") >= F.col("low")) & (F.col("place") < F.col("high")), F.lit(False))
    others = rows.where(~inside).withColumn("extra", F.when(F.col("place") < F.col("low"), F.col("rows")).otherwise(0).cast("long"))
    # FEW rows a pattern, so this is no hot key
    upto = Window.partitionBy("pattern").orderBy("place", "uid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    room = F.col("left_") - (F.sum("words").over(upto) - F.col("words"))
    extra = F.least(F.greatest(F.floor(room / F.col("size")), F.lit(0)), F.col("rows")).cast("long")
    return others.unionByName(rows.where(inside).withColumn("extra", extra)).select(*units.columns, "extra")


def _filled(units: DataFrame, missing: dict[int, int]) -> DataFrame:
    """The units with up to FILLS rows more of each pattern: the largest that fit
    into what is missing, and at last a smallest one if the sum is nearer with it."""
    spark, found = units.sparkSession, []

    def best(order: Column, fits: Column) -> list:
        state = F.broadcast(spark.createDataFrame(list(missing.items()), "p int, missing long"))  # a row a pattern
        used = F.broadcast(spark.createDataFrame(found, "used long"))  # FILLS + 1 rows a pattern at most
        free = units.where("extra < rows").join(state, (F.col("pattern") == F.col("p")) & fits)
        free = free.join(used, F.col("uid") == F.col("used"), "left_anti")
        rows = free.groupBy("pattern").agg(F.min(F.struct(order.alias("o"), "place", "uid", "size")).alias("r")).select("pattern", "r.*").collect()
        found.extend((r.uid,) for r in rows)
        return rows

    for _ in range(FILLS):
        missing = {p: m for p, m in missing.items() if m > 0}
        rows = best(-F.col("size"), F.col("size") <= F.col("missing")) if missing else []
        if not rows:
            break
        for r in rows:
            missing[r.pattern] -= r.size
    missing = {p: m for p, m in missing.items() if m > 0}
    if missing:
        best(F.col("size"), F.col("size") < 2 * F.col("missing"))
    if not found:
        return units
    fills = F.broadcast(spark.createDataFrame(found, "used long"))
    more = F.when(F.col("used").isNotNull(), 1).otherwise(0)
    return units.join(fills, F.col("uid") == F.col("used"), "left").withColumn("extra", F.col("extra") + more).drop("used")


def mix(docs: DataFrame, sources: Column, weights: dict | tuple = (1, 2, 3), most: int = 3, share: float = 1.0, seed: int = 7) -> DataFrame:
    """A row for each row of ``docs`` (doc_id, text and any others, not returned):

    doc_id; size long, the words of its text (null: 0); members array<string>,
    its sources, once each, by code point, null last; source_size long and
    target double of the first of these; copies int, how often the mix takes the
    row, and taken long, its words then.

    ``sources`` is a row's array<string>. ``weights`` names each source's weight
    (1 if missing), or is a cycle that goes through the sources by code point,
    null last. The mix has ``share`` of all words; a target is at most ``most``
    times its source's size, what exceeds that is shared again, and no row is
    taken more often.

    A source's size counts every row that belongs to it. A null or empty array
    belongs to no source: its row is never taken, and source_size and target are
    null. Rows without words are never taken. Repeated rows (of one id, text and
    sources) count and are taken one by one. The order of documents follows from
    seed, doc_id and text, so reruns agree. An empty table gives no rows.
    """
    spark = docs.sparkSession
    read = docs.select(
        "doc_id",
        F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long").alias("size"),
        F.array_sort(F.array_distinct(F.coalesce(sources, F.array().cast("array<string>")))).alias("members"),
        F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), F.coalesce("text", F.lit(""))).bitwiseAND((1 << ORDER) - 1).alias("place"),
    )
    # equal rows become one, with their number; a null source is told from one named null
    units = read.withColumn("key", F.to_json("members")).groupBy("doc_id", "size", "members", "key", "place").agg(F.count("*").alias("rows"))
    units = checkpointed(units.withColumn("words", F.col("size") * F.col("rows")))

    sums = units.groupBy("key").agg(F.sum("words").alias("words")).limit(MAX_PATTERNS + 1).collect()
    if len(sums) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} different sets of sources")
    first = lambda s: (s is None, s or "")
    sums = sorted(((tuple(json.loads(r.key)), r.key, r.words) for r in sums), key=lambda f: [first(s) for s in f[0]])
    patterns, sizes = [p for p, _, _ in sums], [n for _, _, n in sums]
    by_source: dict = {}
    for p, n in zip(patterns, sizes, strict=True):
        for s in p:
            by_source[s] = by_source.get(s, 0) + n
    names = sorted(by_source, key=first)
    weight = {s: weights.get(s, 1) if isinstance(weights, dict) else weights[i % len(weights)] for i, s in enumerate(names)}
    total = int(Fraction(share) * sum(n for p, n in zip(patterns, sizes, strict=True) if p))
    wanted = targets({s: by_source[s] for s in names}, weight, total, most)
    given = route(patterns, sizes, quotas(wanted), most)

    state = [
        (key, i, given[i] // n if n else 0, by_source[p[0]] if p else None, float(wanted[p[0]]) if p else None)
        for i, (p, key, n) in enumerate(sums)
    ]
    state = F.broadcast(spark.createDataFrame(state, "key string, pattern int, base int, source_size long, target double"))  # a row a pattern
    units = checkpointed(units.join(state, "key").drop("key").withColumn("uid", F.monotonically_increasing_id()))
    missing = {i: given[i] % n for i, n in enumerate(sizes) if n and given[i] % n}
    units = checkpointed(_chosen(units.where("size > 0"), missing).unionByName(units.where("size = 0").withColumn("extra", F.lit(0).cast("long"))))
    taken = units.where("extra > 0").groupBy("pattern").agg(F.sum(F.col("extra") * F.col("size")).alias("words")).collect()
    for r in taken:
        missing[r.pattern] -= r.words
    units = _filled(units, missing)

    copies = F.when(F.col("size") > 0, F.col("base") + F.when(F.col("row") <= F.col("extra"), 1).otherwise(0)).otherwise(0).cast("int")
    rows = units.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), "rows"))).withColumn("copies", copies)
    return rows.select("doc_id", "size", "members", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
