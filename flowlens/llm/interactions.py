"""Filter interaction audit: what each order of the filters removes at each step,
and every filter's Shapley share, by path counting over the subset lattice.

A document is reduced to the set of filters it fails, a mask.  States of the
lattice are the sets of filters applied so far; what a state keeps is the number
of documents whose mask avoids it.  An edge applies one more filter and removes
the difference.  ``forward`` counts the orders that reach a state and
``backward`` those that lead on from it to the full set, both by one pass over
the lattice, so ``forward * backward`` orders use an edge and weigh its removals
in the Shapley sum; a step of one order is that same edge read once.  The
lattice has 2**k states and k * 2**(k-1) edges for k filters, whatever the
corpus: documents enter as one count per part and mask.

Plan: one pass over the texts writes a slim row per document (id, part, content
key, mask).  The last filter, "equal to the text of a smaller id", takes the least id
of each key by a partial aggregate and joins on (key, id), so that copies of
one text, however many, spread over all tasks.  Counts are pre-aggregated by
(part, mask) before they are shuffled.

Edge cases: a null text is empty (and equal to an empty one); a null ``source``
is the part ''; a null ``doc_id`` has no labels, is no smaller id and never fails
E; rows that share the least id of a text all pass E; several ``labels`` rows of an
id count once, as good or toxic if any of them says so; other columns are not
read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import content_key, stored, text_or_empty

COPY = "E"
MIN_WORDS, DISTINCT_PCT, CAPITAL_PCT = 50, 65, 5
_BLANKS = " \t\n\x0b\x0c\r"


def text_filters() -> dict[str, Column]:
    """The failure conditions on a text, by letter (``__text``, ``__words``)."""
    n = F.size("__words")
    return {"A": n < MIN_WORDS,
            "B": 100 * F.size(F.array_distinct("__words")) < DISTINCT_PCT * n,
            "C": 100 * F.regexp_count("__text", F.lit("[A-Z]")) > CAPITAL_PCT * F.length("__text"),
            "D": F.col("__text").rlike("[#$%&*|]")}


def masks(docs: DataFrame, filters: dict[str, Column] | None = None) -> tuple[DataFrame, str]:
    """``doc_id, part, __key, mask`` (bit i: fails the i-th of the text filters),
    and the letters of all filters, :data:`COPY` last."""
    filters = text_filters() if filters is None else filters
    base = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       text_or_empty("text").alias("__text"))
    base = base.withColumn("__trim", F.btrim("__text", F.lit(_BLANKS)))
    base = base.withColumn("__words", F.when(F.col("__trim") == "", F.array().cast("array<string>"))
                           .otherwise(F.split("__trim", "[ \\t\\n\\x0B\\f\\r]+")))
    mask = sum((F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(filters.values())), F.lit(0))
    slim = base.select("doc_id", "part", content_key("__text").alias("__key"), mask.cast("int").alias("mask"))
    return stored(slim, "masks"), "".join(filters) + COPY


def failures(docs: DataFrame, filters: dict[str, Column] | None = None) -> tuple[DataFrame, str]:
    """``doc_id, part, mask`` with the copy filter's bit, and the letters."""
    slim, letters = masks(docs, filters)
    known = slim.where("doc_id is not null")
    least = known.groupBy("__key").agg(F.min("doc_id").alias("__low")).withColumnRenamed("__key", "__of")
    first = (F.col("__key") == F.col("__of")) & (F.col("doc_id") == F.col("__low"))
    bit = 1 << (len(letters) - 1)
    flagged = known.join(least, first, "left").select(
        "doc_id", "part", F.when(F.col("__of").isNull(), F.col("mask") + bit).otherwise(F.col("mask")).alias("mask"))
    return flagged.unionByName(slim.where("doc_id is null").select("doc_id", "part", "mask")), letters


def counts(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents, and those labelled so."""
    said = (labels.where("doc_id is not null").groupBy("doc_id")
            .agg(F.max(F.expr("cast(quality = 1 as int)")).alias("__good"), F.max(F.expr("cast(toxic = 1 as int)")).alias("__toxic"))
            .withColumnRenamed("doc_id", "__id"))
    all_ = failed.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    told = (failed.join(said, F.col("doc_id") == F.col("__id")).groupBy("part", "mask")
            .agg(F.lit(0).alias("n"), F.coalesce(F.sum("__good"), F.lit(0)).alias("good"),
                 F.coalesce(F.sum("__toxic"), F.lit(0)).alias("toxic")))
    both = all_.unionByName(told).groupBy("part", "mask")
    return both.agg(*[F.sum(F.col(c).cast("bigint")).alias(c) for c in ("n", "good", "toxic")])


def paths(k: int) -> tuple[list[int], list[int]]:
    """Orders reaching every state from the empty one, and from it the full one."""
    full = (1 << k) - 1
    forward, backward = [0] * (full + 1), [0] * (full + 1)
    forward[0] = backward[full] = 1
    for s in range(full + 1):
        for f in range(k):
            if not s >> f & 1:
                forward[s | 1 << f] += forward[s]
    for s in range(full, -1, -1):
        for f in range(k):
            if not s >> f & 1:
                backward[s] += backward[s | 1 << f]
    return forward, backward


def kept_by_state(by_mask: np.ndarray) -> np.ndarray:
    """For counts by mask (last axis), what every state keeps: the sum over
    the masks that avoid it."""
    out = by_mask.copy()
    size = out.shape[-1]
    state = np.arange(size)
    for f in range(size.bit_length() - 1):
        has = state[state >> f & 1 == 1]
        out[..., has] += out[..., has ^ (1 << f)]
    return out[..., ::-1]


def _steps(letters: str):
    k = len(letters)
    forward, backward = paths(k)
    order = list(permutations(range(k)))
    bits = np.array(order)
    before = np.zeros((len(order), k), np.int64)
    before[:, 1:] = np.cumsum(1 << bits[:, :-1], axis=1)
    names = ["".join(letters[f] for f in o) for o in order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, cells in zip(batch["part"].to_pylist(), batch["cells"].to_pylist()):
                by = np.zeros((3, 1 << k), np.int64)
                for c in cells:
                    by[:, c["mask"]] = c["n"], c["good"], c["toxic"]
                kept = kept_by_state(by)
                after = before + (1 << bits)
                lost = kept[:, before] - kept[:, after]
                fails = np.array([kept[0, 0] - kept[0, 1 << f] for f in range(k)])
                shapley = np.array([sum(forward[s] * backward[s | 1 << f] * int(kept[0, s] - kept[0, s | 1 << f])
                                        for s in range(1 << k) if not s >> f & 1) for f in range(k)])
                alone = by[0, [1 << f for f in range(k)]]
                flat = [pa.array(x.reshape(-1)) for x in (kept[0, after], lost[0], fails[bits] - lost[0], alone[bits],
                                                          lost[1], lost[2], shapley[bits])]
                n = len(order) * k
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * n), pa.array(np.repeat(np.array(names, object), k)),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(order))), *flat],
                    ["part", "filter_order", "step", *COUNTS])
    return run


COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Column] | None = None) -> DataFrame:
    """One row per part, order and step.  All k! orders are listed, so k is
    for a handful of filters; the cells of a part are at most 2**k rows."""
    failed, letters = failures(docs, filters)
    cells = counts(stored(failed, "failures"), labels)
    wide = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    return wide.mapInArrow(_steps(letters), "part string, filter_order string, step int, "
                           + ", ".join(f"{c} bigint" for c in COUNTS))


SQL = """
with d as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents),
l as (
  select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as bad
  from labels where doc_id is not null group by doc_id),
m as (
  select d.part, coalesce(l.good, 0) as good, coalesce(l.bad, 0) as bad,
         (case when len(w) < 50 then 1 else 0 end) + (case when 100 * len(list_distinct(w)) < 65 * len(w) then 2 else 0 end)
         + (case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) then 4 else 0 end)
         + (case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end)
         + (case when d.doc_id > min(d.doc_id) over (partition by t) then 16 else 0 end) as mask
  from d left join l on d.doc_id = l.doc_id),
c as (select part, mask, count(*) as n, sum(good) as good, sum(bad) as bad from m group by part, mask),
f(x, b) as (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o as (
  select f1.x || f2.x || f3.x || f4.x || f5.x as filter_order, [f1.b, f2.b, f3.b, f4.b, f5.b] as bits
  from f f1, f f2, f f3, f f4, f f5 where f1.b + f2.b + f3.b + f4.b + f5.b = 31
  and len(list_distinct([f1.b, f2.b, f3.b, f4.b, f5.b])) = 5),
s as (
  select filter_order, step, bits[step] as bit, coalesce(list_sum(bits[1:step - 1]), 0)::integer as prior
  from o, (select unnest([1, 2, 3, 4, 5]) as step)),
r as (
  select part, filter_order, step, bit,
         sum(case when mask & (prior | bit) = 0 then n else 0 end) as kept,
         sum(case when mask & prior = 0 and mask & bit <> 0 then n else 0 end) as removed,
         sum(case when mask & prior <> 0 and mask & bit <> 0 then n else 0 end) as redundant,
         sum(case when mask = bit then n else 0 end) as unique_fails,
         sum(case when mask & prior = 0 and mask & bit <> 0 then good else 0 end) as good_lost,
         sum(case when mask & prior = 0 and mask & bit <> 0 then bad else 0 end) as toxic_lost
  from s, c group by all)
select part, filter_order, step::integer as step, kept::bigint as kept, removed::bigint as removed,
       redundant::bigint as redundant, unique_fails::bigint as unique_fails, good_lost::bigint as good_lost,
       toxic_lost::bigint as toxic_lost, (sum(removed) over (partition by part, bit))::bigint as shapley from r
"""
