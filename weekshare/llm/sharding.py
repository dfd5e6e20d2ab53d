"""Balanced label propagation into shards (operator 9), DataFrame functions only.

Documents with equal texts are linked. The linked groups start as even,
contiguous stretches of one hash order, so few groups are cut; then, round by
round, each group votes for the shard that holds most of its members and the
others ask to move there. Quotas per
(from, to) pair keep the sizes: opposite moves are exchanged one for one, the
rest only fills free room. A full shard that had to refuse is closed, so a
group larger than a shard fills the next one. Documents without links are
the ballast: they are placed last and make the counts exact.

The law kept is ``rows``: shard counts differ by one at most.

The state is one row per (group, shard) with a count, so a group of a third
of all rows is at most ``n_shards`` rows; only counts per pair of shards
reach the driver. Members are dealt to their group's shards by their number
in the group, counted over salted parts. Each round is written to the shared
folder, so a lost executor repeats one round at most.

Defined cases: a null text equals an empty one; null ids, repeated ids and
repeated rows are rows of their own; an empty table gives an empty result;
more columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import buckets_of, number_rows, offsets_before, read_table, staged

SALTS = 32          # parts of a group when its members are numbered
ROUNDS = 16         # at most; each ends earlier when nothing moves


def _quotas(asked: dict, room: list[int]) -> dict:
    """How many of the ``asked[(a, b)]`` moves may happen; ``room`` is used up."""
    allow = {(a, b): min(n, asked.get((b, a), 0)) for (a, b), n in asked.items()}
    changed = True
    while changed:
        changed = False
        for (a, b), n in sorted(asked.items(), key=lambda x: -x[1]):
            more = min(n - allow[a, b], room[b])
            if more > 0:
                allow[a, b] += more
                room[b] -= more
                room[a] += more
                changed = True
    return allow


def _case(column: str, values: dict) -> str:
    arms = " ".join(f"WHEN {k} THEN {v}" for k, v in values.items())
    return f"CASE {column} {arms} ELSE 0 END" if arms else "0"


def propagate(groups: DataFrame, targets: list[int], rounds: int = ROUNDS) -> tuple[DataFrame, list[int]]:
    """``groups`` (grp, n) -> staged (grp, shard, n), and the room left per shard."""
    spark, k = groups.sparkSession, len(targets)
    nb = buckets_of(spark)
    g = groups.withColumn("_b", F.pmod(F.xxhash64("grp"), F.lit(nb)))
    starts = offsets_before(g.groupBy("_b").agg(F.sum("n").alias("_n")), [], "_b", "_n").drop("_n")
    inside = Window.partitionBy("_b").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    linked = groups.agg(F.sum("n").alias("n")).first()["n"] or 0
    size, more = divmod(linked, k)
    state = (g.withColumn("_i", F.coalesce(F.sum("n").over(inside), F.lit(0)))
             .join(starts, "_b").withColumn("at", F.expr("before + _i"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
             .withColumn("lo", F.expr(f"shard * {size}L + least(shard, {more})"))
             .withColumn("hi", F.expr(f"lo + {size}L + if(shard < {more}, 1, 0)"))
             .selectExpr("grp", "shard", "least(at + n, hi) - greatest(at, lo) AS n").where("n > 0"))
    state = staged(state, "shard-state")
    load = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    room = [targets[s] - load.get(s, 0) for s in range(k)]
    closed: set[int] = set()
    for _ in range(rounds):
        is_open = f"shard NOT IN ({', '.join(map(str, closed))})" if closed else "true"
        vote = F.max(F.expr(f"CASE WHEN {is_open} THEN named_struct('n', n, 'h', "
                            "xxhash64(grp, shard), 'to', shard) END"))
        moves = (state.withColumn("v", vote.over(Window.partitionBy("grp")))
                 .where(f"v IS NOT NULL AND shard != v.to AND n <= v.n AND {is_open}")
                 .selectExpr("grp", "shard", "v.to AS to", "n",
                             f"pmod(xxhash64(grp), {nb}) AS _b"))
        sums = staged(moves.groupBy("shard", "to", "_b").agg(F.sum("n").alias("_n")), "shard-asked")
        asked = {(r["shard"], r["to"]): r["n"] for r in
                 sums.groupBy("shard", "to").agg(F.sum("_n").alias("n")).collect()}
        allow = _quotas(asked, room)
        refused = {b for (a, b), n in asked.items() if n > allow[a, b] and room[b] == 0}
        if sum(allow.values()):
            order = (Window.partitionBy("shard", "to", "_b").orderBy("grp")
                     .rowsBetween(Window.unboundedPreceding, -1))
            quota = _case(f"shard * {k} + to", {a * k + b: n for (a, b), n in allow.items()})
            taken = (moves.withColumn("_i", F.coalesce(F.sum("n").over(order), F.lit(0)))
                     .join(offsets_before(sums, ["shard", "to"], "_b", "_n").drop("_n"),
                           ["shard", "to", "_b"])
                     .withColumn("n", F.expr(f"least(n, {quota} - before - _i)")).where("n > 0"))
            flow = taken.selectExpr("grp", "inline(array(struct(shard AS shard, -n AS n), "
                                    "struct(to AS shard, n AS n)))")
            state = staged(state.unionByName(flow).groupBy("grp", "shard")
                           .agg(F.sum("n").alias("n")).where("n > 0"), "shard-state")
        elif not refused - closed:
            break
        closed |= refused
    return state, room


def shard_documents(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Every row with its shard and its gapless slot there (law ``rows``)."""
    text = f"coalesce(`{text_col}`, '')"
    rows = staged(docs.selectExpr(
        f"`{id_col}` AS doc_id", f"cast(octet_length({text}) + 1 AS long) AS size",
        f"crc32(cast({text} AS binary)) AS text_crc32", f"unhex(sha2({text}, 256)) AS grp",
        "monotonically_increasing_id() AS rid"), "shard-rows")
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("rid"), F.lit(SALTS)))
    total = rows.count()
    targets = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]

    whole = Window.partitionBy("grp")
    upto = whole.orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    parts = staged(rows.groupBy("grp", "salt").agg(F.count(F.lit(1)).alias("m"))
                   .withColumn("n", F.sum("m").over(whole))
                   .withColumn("before", F.coalesce(F.sum("m").over(upto), F.lit(0)))
                   .where("n > 1").drop("m"), "shard-parts")
    state, room = propagate(parts.groupBy("grp").agg(F.first("n").alias("n")), targets)

    each = [f"coalesce(sum(n) FILTER (WHERE shard = {s}), 0)" for s in range(n_shards)]
    ends = state.groupBy("grp").agg(F.expr(
        f"array({', '.join(' + '.join(each[:s + 1]) for s in range(n_shards))})").alias("ends"))
    placed = (rows.withColumn("_i", F.row_number().over(Window.partitionBy("grp", "salt").orderBy("rid")) - 1)
              .join(parts.drop("n").join(ends, "grp"), ["grp", "salt"], "left")
              .withColumn("shard", F.expr("CASE WHEN ends IS NOT NULL THEN "
                                          "size(filter(ends, e -> e <= before + _i)) END"))
              .select("rid", "doc_id", "size", "text_crc32", "shard"))
    placed = staged(placed, "shard-placed")
    free = [sum(room[:s + 1]) for s in range(n_shards)]
    single = (number_rows(placed.where("shard IS NULL").drop("shard"), [], "rid", "_k")
              .withColumn("shard", F.expr(f"size(filter(array({', '.join(f'{x}L' for x in free)}), "
                                          "e -> e <= _k))")).drop("_k"))
    done = staged(placed.where("shard IS NOT NULL").unionByName(single), "shard-done")
    return number_rows(done, ["shard"], "rid", "slot").selectExpr(
        "doc_id", "size", "text_crc32", "'rows' AS law", "cast(shard AS int) AS shard",
        "cast(slot AS long) AS slot", "cast(NULL AS int) AS grown_shard")


def op9_balanced_shards(spark, sf_dir: str) -> DataFrame:
    return shard_documents(read_table(spark, sf_dir, "documents"))
