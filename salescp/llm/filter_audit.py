"""Audit of how document filters interact, over every order of applying them.

Each document gets one bit for each filter it fails; everything an order of the
filters does follows from how many documents have each combination of bits.

    A  fewer than `min_words` words            D  a character of `MARKS`
    B  distinct words under `distinct` % of words    E  the text of a smaller doc_id
    C  A-Z over `capitals` % of the code points

A to D are functions of the text.  E is an existential self-join: a left-semi join
on the text's hash, the exact text and a smaller id marks the documents that fail.
Their ids are united with those that fail another filter, the bits of an id are
put together, and the bit combinations of each part are counted.  For each part its
at most 32 combinations give the rows of all orders and steps.

Scale.  Texts are read twice and shuffled only where their hash occurs twice.  A
hash that a third of all documents share is salted: its rows are dealt by id, and
the one representative of each of its texts goes to every deal.  The list of
hashes that occur twice is broadcast when it has at most `broadcast_rows` rows
(counted while it is written), else it is joined by sort-merge.  What leaves that
is one row per combination.

Defined results: a null text counts as empty; an empty text fails A and no other
filter by its words or signs, and E if a smaller id has an empty or null text; a
null id is neither smaller nor larger than any other; rows that repeat an id are
documents of their own, none of them smaller; a null part is the empty one; of
labels that repeat an id one that says 1 is enough; a text of any length is read
whole; an empty table gives no rows; columns other than those named are not read.
DataFrame functions only.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescp.session import materialize

from .common import UPPER

FILTERS = "ABCDE"
BIT = {name: 1 << k for k, name in enumerate(FILTERS)}
MARKS = r"[#$%&*|]"
_WORDS = r"[\\x20\\x09-\\x0D]+"  # what stands between words, as a SQL literal


def text_bits(text: str, min_words: int, distinct: int, capitals: int) -> str:
    """SQL: the bits of the filters A to D that a text fails."""
    words = f"filter(split({text}, '{_WORDS}', -1), w -> w != '')"
    upper = f"(char_length({text}) - char_length(translate({text}, '{UPPER}', '')))"
    tests = (f"size(w) < {min_words}", f"100L * size(array_distinct(w)) < {distinct}L * size(w)",
             f"100L * {upper} > {capitals}L * char_length({text})", f"{text} rlike '{MARKS}'")
    bits = " + ".join(f"if({t}, {BIT[f]}, 0)" for f, t in zip(FILTERS, tests))
    return f"transform(array({words}), w -> {bits})[0]"  # the words are made once


def copies(docs: DataFrame, broadcast_rows: int, deal: int) -> DataFrame:
    """(id, h1, h2, part) of the rows of `docs` (id, h1, h2, part, text) whose text a smaller id has."""
    from salescp.operators.enrich import join_side
    from salescp.session import materialize_counted

    hashes = docs.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("id").alias("least")).where("n > 1 and least is not null")
    hashes, seen = materialize_counted(hashes, {"rows": F.count("*")})
    side = join_side(hashes, "checked", broadcast_rows, seen["rows"] <= broadcast_rows)
    several = materialize(docs.where("id is not null").join(side, ["h1", "h2"])
                          .withColumn("deals", F.expr(f"cast(ceil(n / {deal}) as int)")).drop("n"))
    later = (several.where("id > least")  # the smallest id of a hash has no smaller one with its text
             .withColumn("deal", F.expr("pmod(xxhash64(id), deals)")).drop("least", "deals"))
    first = (several.groupBy("h1", "h2", "text").agg(F.min("id").alias("first"), F.max("deals").alias("deals"))
             .withColumn("deal", F.explode(F.expr("sequence(0L, deals - 1L)"))).drop("deals"))
    a, b = later.alias("a"), first.alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("h1", "h2", "deal", "text")]
    return a.join(b, [*same, F.col("b.first") < F.col("a.id")], "left_semi").select("id", "h1", "h2", "part")


def combinations(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 part_col: str = "source", min_words: int = 50, distinct: int = 65, capitals: int = 5,
                 broadcast_rows: int = 1_000_000, deal: int = 1 << 14) -> DataFrame:
    """(part, bits, n, good, toxic): documents of each part by the filters they fail, and how many of them are labelled."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
                       F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"))
    hashed = rows.selectExpr("id", "xxhash64(text) as h1", "xxhash64(7, text) as h2", "part", "text")
    tested = materialize(hashed.selectExpr("id", "h1", "h2", "part",
                                           f"{text_bits('text', min_words, distinct, capitals)} as bits"))
    failing = (tested.select("*", F.lit(1).alias("n"))
               .unionByName(copies(hashed, broadcast_rows, deal).select("*", F.lit(BIT["E"]).alias("bits"), F.lit(0).alias("n"))))
    by_id = failing.groupBy("id", "h1", "h2", "part").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
    marked = labels.groupBy(F.col(id_col).alias("label_id")).agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic"))
    joined = by_id.join(marked, F.col("id") == F.col("label_id"), "left")
    return joined.groupBy("part", "bits").agg(
        F.sum("n").alias("n"), F.sum(F.expr("n * coalesce(good, 0)")).alias("good"),
        F.sum(F.expr("n * coalesce(toxic, 0)")).alias("toxic"))


def orders() -> list[tuple[str, int, int, int]]:
    """(order, step, bit of its filter, bits of the filters before it) for every order of the filters."""
    return [("".join(p), k + 1, BIT[f], sum(BIT[g] for g in p[:k])) for p in permutations(FILTERS) for k, f in enumerate(p)]


def audit(counted: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for `combinations`.

    A document that fails m filters is removed by each of them in 1 / m of all orders.
    """
    steps = ", ".join(f"struct('{o}' as o, {k} as k, {own} as own, {before} as before)" for o, k, own, before in orders())
    total = lambda what, test: (
        f"aggregate(filter(held, h -> {test}), 0L, (sum, h) -> sum + {what})")
    removed = "h.bits & s.own > 0 and h.bits & s.before = 0"
    n_orders = len(orders()) // len(FILTERS)
    parts = counted.groupBy("part").agg(F.collect_list(F.struct("bits", "n", "good", "toxic")).alias("held"))  # 32 at most
    return parts.select("part", "held", F.explode(F.expr(f"array({steps})")).alias("s")).selectExpr(
        "part", "s.o as filter_order", "s.k as step",
        total("h.n", "h.bits & (s.own | s.before) = 0") + " as kept",
        total("h.n", removed) + " as removed",
        total("h.n", "h.bits & s.own > 0 and h.bits & s.before > 0") + " as redundant",
        total("h.n", "h.bits = s.own") + " as unique_fails",
        total("h.good", removed) + " as good_lost", total("h.toxic", removed) + " as toxic_lost",
        total(f"h.n * ({n_orders}L div bit_count(h.bits))", "h.bits & s.own > 0") + " as shapley")
