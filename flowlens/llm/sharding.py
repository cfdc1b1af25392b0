"""Balanced label propagation of documents onto shards (DataFrame functions
only).  Law ``rows``: shard counts are at most one apart, always.

Documents of equal text are linked.  They start on shards by a deterministic
shuffle, counts one apart at most.  In each round every group counts its
documents per shard (one row per group and shard); its homes are the shards
holding most of it (ties by a hash of group and shard), one, or as many as a
group larger than a shard fills.  Documents elsewhere propose to move to a
home.  Moves obey quotas: shards swap equal numbers, and
where more documents come than leave, unlinked documents of the target shard
go the other way, in the order of :func:`common.positions`.  Counts therefore
never change, and the cut (linked documents apart) only shrinks.  Rounds go on
until none of a group's homes accepts a move.  What the
driver sees per round is one count per pair of shards.

A group too large for a shard fills several.  Edge cases: null texts are equal
to each other, of size 16 and crc 0; null or repeated ids and repeated rows are
rows like others; other columns are not read; an empty table gives an empty
result; ties are broken by hashes of the row's content, and rows equal in
``doc_id`` and text are interchangeable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import content_key, positions, saved

SHARDS = 40
SALT = 16


def _quotas(want: dict, free: dict, shards: int) -> tuple[dict, dict]:
    """Accepted moves per (from, to) and unlinked documents sent back per
    (from, to), from proposals ``want`` and unlinked counts ``free``."""
    take: dict = {}
    back: dict = {}
    left = dict(free)
    for (s, t), n in sorted(want.items()):
        even = min(n, want.get((t, s), 0))
        extra = min(n - even, left.get(t, 0))
        left[t] = left.get(t, 0) - extra
        if even + extra:
            take[s, t] = even + extra
        if extra:
            back[t, s] = extra
    return take, back


def _literal(rows: list, names: list[str], spark) -> DataFrame:
    return F.broadcast(spark.createDataFrame(rows, ", ".join(f"{n} bigint" for n in names)))


def round_of(df: DataFrame, rows: int, shards: int, turn: int) -> tuple[DataFrame | None, int]:
    """One round of moves over ``__g`` (group), ``__n`` (its size), ``shard``;
    None when no document may move; and the most homes a proposal chose from."""
    spark, own = df.sparkSession, df.columns
    full = -(-rows // shards)
    linked = df.where("__n > 1")
    here = linked.groupBy("__g", "__n", "shard").agg(F.count(F.lit(1)).alias("__c"))
    # A group's homes: the shards with most of it, as many as it fills.
    order = Window.partitionBy("__g").orderBy(F.desc("__c"), F.xxhash64("__g", "shard"), "shard")
    placed = here.withColumn("__home", F.row_number().over(order) <= F.ceil(F.col("__n") / F.lit(full)))
    homes = placed.where("__home").groupBy("__g").agg(F.sort_array(F.collect_list("shard")).alias("__homes"))
    moves = (placed.where("not __home").join(homes, "__g")
             .select(F.col("__g").alias("__mg"), F.col("shard").alias("__ms"), "__homes"))
    pick = F.pmod(F.pmod("__key", F.size("__homes")) + F.lit(turn), F.size("__homes")).cast("int")
    df = df.join(moves, (F.col("__g") == F.col("__mg")) & (F.col("shard") == F.col("__ms")), "left")
    df = df.withColumn("__to", F.get("__homes", pick)).withColumn("__of", F.size("__homes")).drop("__mg", "__ms", "__homes")
    state = saved(df)
    counts = state.groupBy("shard", "__to", (F.col("__n") > 1).alias("linked")).agg(
        F.count(F.lit(1)).alias("c"), F.max("__of").alias("of")).collect()
    homes_of = max((r["of"] for r in counts if r["__to"] is not None), default=0)
    want = {(r["shard"], r["__to"]): r["c"] for r in counts if r["__to"] is not None}
    free: dict = {}
    for r in counts:
        if not r["linked"]:
            free[r["shard"]] = free.get(r["shard"], 0) + r["c"]
    take, back = _quotas(want, free, shards)
    if not take:
        return None, homes_of
    go = positions(state.where("__to is not null"), ["shard", "__to"], ["__g", "__key"], "__p")
    quota = _literal([(s, t, n) for (s, t), n in take.items()], ["__qs", "__qt", "__q"], spark)
    go = go.join(quota, (F.col("shard") == F.col("__qs")) & (F.col("__to") == F.col("__qt")), "left")
    go = go.withColumn("shard", F.when(F.col("__p") < F.col("__q"), F.col("__to")).otherwise(F.col("shard")).cast("int"))
    stay = state.where("__to is null")
    if back:
        # Unlinked documents of t in order: the first back[t, s1] go to s1, the next to s2, ...
        steps, at = [], {}
        for (t, s), n in sorted(back.items()):
            steps.append((t, s, at.get(t, 0), at.get(t, 0) + n))
            at[t] = at.get(t, 0) + n
        ranges = _literal(steps, ["__qt", "__qs", "__lo", "__hi"], spark)
        free_rows = positions(stay.where("__n = 1"), ["shard"], ["__g", "__key"], "__p")
        free_rows = free_rows.join(ranges, (F.col("shard") == F.col("__qt")) & (F.col("__p") >= F.col("__lo"))
                                   & (F.col("__p") < F.col("__hi")), "left")
        free_rows = free_rows.withColumn("shard", F.coalesce(F.col("__qs"), F.col("shard")).cast("int"))
        out = stay.where("__n > 1").select(*own).unionByName(free_rows.select(*own))
    else:
        out = stay.select(*own)
    return saved(out.unionByName(go.select(*own))), homes_of


def shard(docs: DataFrame, shards: int = SHARDS, rounds: int | None = None) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot,
    grown_shard``; after ``rounds``, or when no move is left."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select("doc_id", (F.octet_length(text) + 16).cast("bigint").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), content_key().alias("__g"))
    base = saved(base.withColumn("__key", F.xxhash64(F.lit(5), "doc_id", "__g")))
    rows = base.count()
    sizes = base.groupBy("__g").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    # The join is salted: the rows of a hot group meet copies of its size in several tasks.
    sizes = sizes.select(F.col("__g").alias("__sg"), "__n", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("__ss"))
    df = base.withColumn("__s", F.pmod("__key", F.lit(SALT)).cast("int"))
    df = df.join(sizes, (F.col("__g") == F.col("__sg")) & (F.col("__s") == F.col("__ss")), "left")
    df = df.withColumn("__n", F.coalesce("__n", F.lit(1))).drop("__sg", "__ss", "__s")
    df = positions(df.withColumn("__all", F.lit(0)), ["__all"], ["__key", "doc_id"], "__p", rows)
    df = saved(df.withColumn("shard", F.pmod("__p", F.lit(shards)).cast("int")).drop("__p", "__all"))
    turn = idle = 0
    while rounds is None or turn < rounds:
        nxt, homes_of = round_of(df, rows, shards, turn)
        turn += 1
        idle = idle + 1 if nxt is None else 0
        if nxt is not None:
            df = nxt
        elif idle >= homes_of:  # every home was asked
            break
    out = positions(df, ["shard"], ["__key", "doc_id"], "slot", rows)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                      F.col("slot").cast("int").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
