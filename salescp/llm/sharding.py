"""Shards of even row counts that keep linked documents together: balanced label propagation.

Documents with equal texts are linked.  All documents are dealt to the shards in
turn; then, round by round, linked documents move to the shard that holds most of
their neighbours, as far as the shards' quotas allow.

Equal texts are interchangeable, so the state is one row for each group and shard
(a fragment: how many of the group's documents the shard holds), not a row per
document.  A round is:
- each fragment joins its group's fullest fragment in an open shard and, if that one
  is fuller, asks to go there (of equally full ones a hash of group and shard decides,
  so no two ever swap);
- the numbers asked for from shard to shard are cut until no shard gets more than it
  has room for and gives away (`flows`, a matrix of shards by shards);
- of each flow those who win most neighbours go first, the last fragment in part.
A shard that could let in nothing is closed until it has room again, so the next
round asks for others.  Every move wins neighbours, so the rounds end: when nothing
can move.  Documents without a neighbour have no wish; they fill up what the quotas
leave.  At the end documents take the places of their group's fragments by their
rank in the group.

Law `rows`: a shard holds floor(n / shards) or one more documents.  A group that is
larger than a shard, or finds no room, is split; no document is dropped.

Scale.  Rounds shuffle fragments, at most `shards` rows per group, never documents
or texts.  A group that a third of all rows share is ranked in cells of about `deal`
rows, whose counts are added up; singles and the places in a shard are cut in such
cells too, so no window holds more than a cell or one row per cell.  `deal` grows so
that there are at most `MOST_CELLS` cells, which bounds the broadcast list of groups
of more than `deal` rows; further broadcasts are the flows and the sizes of written
partitions.  The driver sees loads and flows, shards by shards numbers a round.

Defined results: a null text counts as empty (size 1, equal to the empty text); null
and repeated ids are placed like any other row, a place for each row; of texts of any
length only size, crc32 and hash (128 bits) are kept; an empty table gives no rows;
columns other than id and text are not read.  In a shard the documents of a group
have neighbouring slots, singles come last.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescp.session import Rounds, drop_materialized, materialize, materialize_counted, scratch

LEVELS = 64  # gains by powers of two
MOST_CELLS = 1_000_000


def _before(df: DataFrame, keys: list[str], order: list, n: str, start: str) -> DataFrame:
    """`df` with the sum of `n` over the rows of the same keys that come before."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(start, F.coalesce(F.sum(n).over(w), F.lit(0)))


def running(df: DataFrame, key: str, order: list[str], n: str, start: str, cells: int) -> DataFrame:
    """`df` with the sum of `n` before each row of its `key`, in the order of hash cells and then `order`.

    A window holds one cell, or one number per cell of a key.
    """
    dealt = df.withColumn("_cell", F.pmod(F.xxhash64(*order), F.lit(cells)).cast("int"))
    sums = dealt.groupBy(key, "_cell").agg(F.sum(n).alias("_n"))
    sums = _before(sums, [key], ["_cell"], "_n", "_ahead").drop("_n")
    inside = _before(dealt, [key, "_cell"], order, n, "_in")
    return (inside.join(sums, [key, "_cell"]).withColumn(start, F.col("_ahead") + F.col("_in"))
            .drop("_cell", "_ahead", "_in"))


def numbered(rows: DataFrame) -> tuple[DataFrame, int]:
    """(`rows` with `_at`: 0, 1, 2, .. over all partitions, their number)."""
    rows, seen = materialize_counted(rows.withColumn("_at", F.monotonically_increasing_id()), {"rows": F.count("*")})
    part = F.shiftright("_at", 33)
    sizes = _before(rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n")), [], ["_part"], "_n", "_first").drop("_n")
    return (rows.withColumn("_part", part).join(F.broadcast(sizes), "_part")  # a row for each written partition
            .withColumn("_at", F.col("_first") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_part", "_first"),
            seen["rows"])


def flows(asked: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """The largest shares of `asked` (from, to) -> n, cut evenly, by which no shard gains more than its room."""
    out = {k: n for k, n in asked.items() if n > 0}
    while True:
        over = {}
        for s, free in enumerate(room):
            gets = sum(n for (_, j), n in out.items() if j == s)
            extra = gets - sum(n for (i, _), n in out.items() if i == s) - free
            if extra > 0:
                over[s] = (gets, min(gets, extra))
        if not over:
            return {k: n for k, n in out.items() if n}
        for s, (gets, extra) in over.items():
            mine = sorted((k for k in out if k[1] == s), key=lambda k: (-out[k], k))
            left = gets - extra
            for k in mine:  # rounded down, then the rest to the largest
                out[k], gets, left = (share := out[k] * left // gets if gets else 0), gets - out[k], left - share


def wishes(held: DataFrame, closed: list[int]) -> DataFrame:
    """(k1, k2, shard, n, to, gain): where fragments (k1, k2, shard, n) ask to move."""
    own = held.withColumn("rank", F.struct("n", F.xxhash64("k1", "k2", "shard")))
    best = (own.where(~F.col("shard").isin(closed)).groupBy("k1", "k2")
            .agg(F.max("rank").alias("to_rank"), F.max_by("shard", "rank").alias("to")))
    # gain: neighbours there less those left
    return own.join(best, ["k1", "k2"]).where("rank < to_rank").select(
        "k1", "k2", "shard", "n", "to", (F.col("to_rank.n") - F.col("n") + 1).alias("gain"))


def loads(held: DataFrame, shards: int) -> list[int]:
    load = {r["shard"]: r["n"] for r in held.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    return [load.get(s, 0) for s in range(shards)]


def propagate(held: DataFrame, quota: list[int], rounds: int, cells: int) -> DataFrame:
    """Label propagation over written fragments (k1, k2, shard, n) until none can move; at most `rounds` rounds."""
    spark, shards = held.sparkSession, len(quota)
    closed: set[int] = set()
    written = Rounds(spark)
    for _ in range(rounds):
        room = [q - n for q, n in zip(quota, loads(held, shards))]
        closed = {s for s in closed if not room[s]}
        with scratch() as asking:
            asked = materialize(wishes(held, sorted(closed)))
        wanted = {(r["shard"], r["to"]): r["n"] for r in asked.groupBy("shard", "to").agg(F.sum("n").alias("n")).collect()}
        let = flows(wanted, room)
        shut = {j for _, j in wanted} - {j for _, j in let}
        closed |= shut
        if not let:
            drop_materialized(spark, asking)
            if not shut:
                break
            continue
        # gains from the highest level down; inside a level in hash cells
        level = F.lit(LEVELS - 1) - F.floor(F.log2("gain")).cast("int")
        asked = asked.withColumn("target", (F.col("shard") * shards + F.col("to")) * LEVELS + level)
        inside = running(asked, "target", ["k1", "k2"], "n", "ahead", cells)
        levels = _before(asked.groupBy("shard", "to", "target").agg(F.sum("n").alias("_n")), ["shard", "to"], ["target"],
                         "_n", "_ahead").drop("_n", "shard", "to")
        limits = spark.createDataFrame([(i, j, n) for (i, j), n in let.items()], "shard int, to int, most long")
        moved = (inside.join(F.broadcast(levels), "target").join(F.broadcast(limits), ["shard", "to"])  # shards x shards x levels
                 .select("k1", "k2", "shard", "to", F.least("n", F.col("most") - F.col("ahead") - F.col("_ahead")).alias("m"))
                 .where("m > 0"))
        change = moved.select("k1", "k2", F.explode(F.array(
            F.struct("shard", (-F.col("m")).alias("n")), F.struct(F.col("to").alias("shard"), F.col("m").alias("n")))).alias("c"))
        with written.next():
            held = materialize(held.unionByName(change.select("k1", "k2", "c.shard", "c.n"))
                               .groupBy("k1", "k2", "shard").agg(F.sum("n").alias("n")).where("n > 0"))
        drop_materialized(spark, asking)
    written.done()
    return held


def balanced_shards(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
                    rounds: int = 64, deal: int = 1 << 11) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard, k1, k2), one row per row; (k1, k2) tells equal texts."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows, total = numbered(docs.select(
        F.col(f"`{id_col}`").alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(7), text).alias("k2")))
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    deal = max(deal, -(-total // MOST_CELLS))
    cells = max(1, -(-total // deal))
    large = (rows.groupBy("k1", "k2").agg(F.count("*").alias("n")).where(F.col("n") > deal)
             .select("k1", "k2", F.ceil(F.col("n") / deal).alias("_deals")))
    rows = materialize(rows.join(F.broadcast(large), ["k1", "k2"], "left")  # at most rows / deal groups
                       .withColumn("cell", F.expr("pmod(xxhash64(_at), coalesce(_deals, 1L))")).drop("_deals"))
    dealt = materialize(rows.groupBy("k1", "k2", "cell", F.pmod("_at", F.lit(shards)).cast("int").alias("shard"))
                        .agg(F.count("*").alias("n")))
    cell = dealt.groupBy("k1", "k2", "cell").agg(F.sum("n").alias("n"))
    of_group = Window.partitionBy("k1", "k2")
    cell = materialize(_before(cell, ["k1", "k2"], ["cell"], "n", "start").withColumn("members", F.sum("n").over(of_group)))
    groups = cell.where("members > 1").select("k1", "k2").distinct()
    held = materialize(dealt.join(groups, ["k1", "k2"]).groupBy("k1", "k2", "shard").agg(F.sum("n").alias("n")))
    held = propagate(held, quota, rounds, cells)

    # places: a fragment's first slot in its shard and first rank in its group
    placed = running(_before(held, ["k1", "k2"], ["shard"], "n", "rank"), "shard", ["k1", "k2"], "n", "slot", cells)
    of_groups = placed.groupBy("k1", "k2").agg(F.collect_list(F.struct("rank", "n", "shard", "slot")).alias("places"))
    linked = cell.where("members > 1").join(of_groups, ["k1", "k2"]).select("k1", "k2", "cell", "start", "places")
    # singles, one after another, take what is left of each shard
    free, first = [], 0
    for s, (q, taken) in enumerate(zip(quota, loads(held, shards))):
        free.append((first, q - taken, s, taken))
        first += q - taken
    left = F.array(*[F.struct(*[F.lit(v).cast(t).alias(c) for v, t, c in zip(
        f, ("long", "long", "int", "long"), ("rank", "n", "shard", "slot"))]) for f in free])
    single = (running(cell.where("members = 1").withColumn("all", F.lit(0)), "all", ["k1", "k2"], "n", "before", cells)
              .select("k1", "k2", "cell", F.col("before").alias("start"), left.alias("places")))
    found = rows.join(materialize(linked.unionByName(single)), ["k1", "k2", "cell"])
    rank = F.row_number().over(Window.partitionBy("k1", "k2", "cell").orderBy("id", "_at")) - 1 + F.col("start")
    found = found.withColumn("rank", rank).withColumn(
        "place", F.expr("filter(places, p -> p.rank <= rank and rank < p.rank + p.n)[0]"))
    return found.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"),
                        F.col("place.shard").alias("shard"), (F.col("place.slot") + F.col("rank") - F.col("place.rank")).alias("slot"),
                        F.lit(None).cast("int").alias("grown_shard"), "k1", "k2")
