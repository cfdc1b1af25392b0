"""Line-first quality rules (DataFrame functions only).

Every line with a word is judged by itself; failing lines are removed and a
document that loses more than half of its line characters is rejected.

Line rules (a line fails by the first that holds):

* boilerplate: a phrase of :data:`BOILERPLATE`, in any ASCII case;
* navigation: at least three separators ``| > » › •``;
* symbols: more than 30 % of its words hold a character of ``#*$%&|<>``;
* navigation again: up to three words without an end mark;
* punctuation: eight words or more, no end mark (``. ! ? : ; …`` or a sentence end
  of another script, as ``। ؟ ۔ 。``) at the end (quotes, brackets or symbols may
  follow it) and none before a space either.

Base counts (``n_words`` ...) are taken over the whole text before cleaning:
a document with fewer than 50 words, or with over half of its words inside
repeated 3-word windows, fails whatever its lines say.

Edge cases: a null text is empty, has no words and is rejected; null or
repeated ``doc_id`` and repeated rows are judged row by row; columns other than
``doc_id`` and ``text`` are not read; an empty table gives an empty result.
Repeated windows are found by a hash within one document, ordered by 39 hash
bits and the place; where two windows are equal in these but not in 64 bits,
that document's windows are sorted again in full width.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 50
WS = "[ \\t\\n\\x0B\\x0C\\r]+"
# Phrases of site furniture.
BOILERPLATE = ["all rights reserved", "cookie policy", "privacy policy", "terms of use",
               "terms of service", "enable javascript", "lorem ipsum", "click here",
               "sign up for our newsletter", "subscribe to our", "skip to content"]
# Code points that end a sentence in some script (Unicode property
# Sentence_Terminal, the marks of living scripts), colons and semicolons, and
# what may close a quotation after them.
ENDERS = ["0589", "061D", "061E", "061F", "06D4", "0700", "0701", "0702", "07F9", "0964", "0965", "104A", "104B", "1362",
          "1367", "1368", "166E", "17D4", "17D5", "1803", "1809", "203C", "203D", "2026", "2047", "2048", "2049", "3002",
          "A60E", "A6F3", "A6F7", "A92F", "AAF0", "ABEB", "FE52", "FE56", "FE57", "FF01", "FF0E", "FF1F", "FF61"]
COLONS = ["037E", "061B", "1365", "1366", "FF1A", "FF1B"]
CLOSERS = ["00BB", "2019", "201D", "203A", "300B", "300D", "300F", "3011", "FF09", "FF63"]


def _points(codes: list[str]) -> str:
    return "".join(f"\\x{{{c}}}" for c in codes)


END_MARK = f"[.!?:;{_points(ENDERS + COLONS)}][\"')\\]{_points(CLOSERS)}#*$%&]*$"
INNER_MARK = f"[.!?{_points(ENDERS)}] "
_SEPARATORS = "|>»›•"
_SYMBOLS = "#*$%&|<>"
_TRIM = "' \\t\\n\\u000B\\u000C\\r'"


def _q(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _trim(x: str) -> str:
    """SQL: ``x`` without white space at its ends, untouched where it has none."""
    blanks = ("' '", "'\\t'", "'\\n'", "'\\r'", "'\\u000B'", "'\\u000C'")
    has = " or ".join(f"{f}({x}, {b})" for f in ("endswith", "startswith") for b in blanks)
    return f"case when {has} then trim(both {_TRIM} from {x}) else {x} end"


def _line_rule(x: str) -> str:
    """SQL for the verdict of one trimmed line ``x``.  The document-wide
    flags ``d`` spare most lines the costly rules."""
    phrases = " or ".join(f"contains(l, {_q(p)})" for p in BOILERPLATE)
    ended = " or ".join([f"endswith({x}, '{m}')" for m in ".!?"] + [f"rlike({x}, {_q(END_MARK)})"])
    words = f"size(split({x}, {_q(WS)}))"
    return (f"case when {x} = '' then null "
            f"when d.boil and exists(array(lower({x})), l -> {phrases}) then 'boilerplate' "
            f"when d.sep and length({x}) - length(translate({x}, {_q(_SEPARATORS)}, '')) >= 3 then 'navigation' "
            f"when d.sym and exists(array(split({x}, {_q(WS)})), w -> 10 * size(filter(w, y -> "
            f"length(y) > length(translate(y, {_q(_SYMBOLS)}, '')))) > 3 * size(w)) then 'symbols' "
            f"when {ended} then '' when {words} <= 3 then 'navigation' "
            f"when {words} >= 8 and not rlike({x}, {_q(INNER_MARK)}) then 'punctuation' else '' end")


def judged_lines(docs: DataFrame, keep: list) -> DataFrame:
    """``keep`` columns plus ``__text``, the array ``__lines`` of all lines,
    ``__rules`` (the rule each line fails, '' if none, null without words) and
    ``__nsym``, the number of symbols."""
    base = docs.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__text"))
    base = base.withColumns({
        "__lines": F.split("__text", "\n"),
        "__low": F.lower("__text"),
        "__nsym": F.expr(f"cast(regexp_count(__text, '[{_SYMBOLS}]') as bigint)"),
        "__sep": F.expr(" or ".join(f"contains(__text, '{c}')" for c in _SEPARATORS))})
    base = base.withColumns({
        "__sym": F.expr("__nsym > 0"),
        "__boil": F.expr(" or ".join(f"contains(__low, {_q(p)})" for p in BOILERPLATE))})
    # Flags are bound as an argument: inside the lambda they would be computed per line.
    rules = (f"transform(array(struct(__boil as boil, __sep as sep, __sym as sym)), d -> "
             f"transform(transform(__lines, x -> {_trim('x')}), x -> {_line_rule('x')}))[0]")
    return base.withColumn("__rules", F.expr(rules))


def _repeat_words(df: DataFrame) -> DataFrame:
    """Adds ``__words`` and ``__rep``: the number of words inside 3-word
    windows that occur at least twice.

    A window is one long, 39 hash bits above 24 bits of place, so sorting the
    longs brings equal windows together."""
    mask = (1 << 24) - 1
    hashed = "xxhash64(__words[{0}], __words[{0} + 1], __words[{0} + 2])"
    df = df.withColumn("__trimmed", F.expr(_trim("__text")))
    df = df.withColumn("__words", F.expr(
        f"case when __trimmed = '' then cast(array() as array<string>) else split(__trimmed, {_q(WS)}) end"))
    df = df.withColumn("__s", F.expr(
        "sort_array(case when size(__words) < 4 then cast(array() as array<bigint>) else "
        f"transform(sequence(0, size(__words) - 3), i -> (shiftrightunsigned({hashed.format('i')}, 1) & ~{mask}L) "
        "| cast(i as bigint)) end)"))
    # Neighbours less than one place range apart: equal in the hash bits, or next to it.
    df = df.withColumn("__near", F.expr(
        "case when size(__s) < 2 then cast(array() as array<int>) else "
        f"filter(sequence(1, size(__s) - 1), i -> __s[i] - __s[i - 1] <= {mask}L) end"))
    df = df.withColumn("__near", F.expr(
        f"transform(__near, i -> struct(cast(__s[i - 1] & {mask}L as int) as a, cast(__s[i] & {mask}L as int) as b, "
        f"(__s[i] & ~{mask}L) = (__s[i - 1] & ~{mask}L) as same))"))
    df = df.withColumn("__mixed", F.expr(
        f"size(__words) > {mask} or exists(__near, p -> p.same and "
        f"{hashed.format('p.a')} <> {hashed.format('p.b')})"))
    # Equal in 39 bits only, or too many places: sort the full hashes.
    exact = (f"transform(array(array_sort(transform(sequence(0, size(__words) - 3), i -> "
             f"struct({hashed.format('i')} as h, i as i)))), s -> "
             "transform(filter(s, (x, j) -> (j > 0 and get(s, j - 1).h = x.h) or "
             "(j + 1 < size(s) and get(s, j + 1).h = x.h)), x -> x.i))[0]")
    df = df.withColumn("__p", F.expr(
        f"sort_array(case when __mixed then {exact} else "
        "array_distinct(flatten(transform(filter(__near, p -> p.same), p -> array(p.a, p.b)))) end)"))
    return df.withColumn("__rep", F.expr(
        "case when size(__p) = 0 then 0L else aggregate(sequence(1, size(__p)), 0L, (acc, i) -> acc + "
        "case when i = size(__p) then 3 else least(3, __p[i] - __p[i - 1]) end) end"))


def quality(docs: DataFrame) -> DataFrame:
    """One row per document: base counts, ``base_failed``, line counts by rule
    and the verdict ``kept``."""
    df = judged_lines(docs, ["doc_id"])
    df = df.withColumn("__filled", F.expr("filter(__lines, (x, i) -> __rules[i] is not null)"))
    df = _repeat_words(df)
    black = "__text"
    for c in (" ", "\\n", "\\t", "\\r", "\\u000B", "\\u000C"):
        black = f"replace({black}, '{c}', '')"
    count = lambda r: f"cast(size(filter(__rules, x -> x = '{r}')) as bigint)"
    cols = [
        F.col("doc_id"),
        F.expr("cast(size(__words) as bigint)").alias("n_words"),
        F.expr(f"cast(length({black}) as bigint)").alias("word_chars"),
        F.col("__nsym").alias("n_symbols"),
        F.expr("cast(size(__filled) - size(array_distinct(__filled)) as bigint)").alias("n_dup_lines"),
        F.col("__rep").alias("n_repeat_words"),
        F.expr("cast(size(__filled) as bigint)").alias("n_lines"),
        *[F.expr(count(r)).alias(a) for r, a in (("boilerplate", "n_boilerplate"), ("navigation", "n_navigation"),
                                             ("symbols", "n_symbol_lines"), ("punctuation", "n_punctuation"))],
        F.expr("aggregate(zip_with(__lines, __rules, (l, r) -> case when r is null then 0L "
               "else cast(length(l) as bigint) end), 0L, (a, x) -> a + x)").alias("line_chars"),
        F.expr("aggregate(zip_with(__lines, __rules, (l, r) -> case when r = '' then cast(length(l) as bigint) "
               "else 0L end), 0L, (a, x) -> a + x)").alias("kept_chars")]
    # Filters on the result stop at the generator: pushed below it they would
    # repeat the work above once per line or word.
    out = df.select(F.inline(F.array(F.struct(*cols))))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = out.withColumn("base_failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & (2 * F.col("kept_chars") >= F.col("line_chars")))


def clean(docs: DataFrame) -> DataFrame:
    """The kept documents, all columns, failing lines removed from ``text``
    and ``n_chars`` (if there) counted anew.  Lines without a word stay."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
                      F.col("text"), F.lit(0).alias("doc_id"))
    df = judged_lines(row, ["__row", "doc_id"])
    df = _repeat_words(df)
    df = df.withColumn("__good", F.expr("filter(__lines, (x, i) -> __rules[i] is null or __rules[i] = '')"))
    chars = ("aggregate(zip_with(__lines, __rules, (l, r) -> case when {0} then cast(length(l) as bigint) "
             "else 0L end), 0L, (a, x) -> a + x)")
    kept, total = chars.format("r = ''"), chars.format("r is not null")
    verdict = F.expr(f"size(__words) >= {MIN_WORDS} and 100 * __rep <= 50 * size(__words) and 2 * {kept} >= {total}")
    df = df.select(F.inline(F.array(F.struct("__row", F.array_join("__good", "\n").alias("__new"),
                                             verdict.alias("__kept"))))).where("__kept")
    cols = []
    for c in docs.columns:
        if c == "text":
            cols.append(F.col("__new").alias(c))
        elif c == "n_chars":
            cols.append(F.length("__new").cast(docs.schema[c].dataType).alias(c))
        else:
            cols.append(F.col("__row").getField(c).alias(c))
    return df.select(*cols)


_D_BOIL = " OR ".join(f"contains(lower(x), '{p}')" for p in BOILERPLATE)
_D_END = END_MARK.replace("'", "''")
_D_SYM = "[#*$%&|<>]"
SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
wi AS (SELECT rid, unnest(range(1, len(w) - 1)) AS i, w FROM w WHERE len(w) >= 3),
tri AS (SELECT rid, i, list_slice(w, i, i + 2) AS g FROM wi),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM tri) WHERE n > 1),
cov AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY rid),
l0 AS (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d),
l1 AS (SELECT rid, l, trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS x FROM l0),
l2 AS (SELECT rid, l, x, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS w FROM l1 WHERE x <> ''),
l3 AS (SELECT rid, l, CASE WHEN {_D_BOIL} THEN 'boilerplate'
    WHEN length(regexp_replace(x, '[^|>\x{{00BB}}\x{{203A}}\x{{2022}}]', '', 'g')) >= 3 THEN 'navigation'
    WHEN 10 * len(list_filter(w, lambda y: regexp_matches(y, '{_D_SYM}'))) > 3 * len(w) THEN 'symbols'
    WHEN len(w) <= 3 AND NOT regexp_matches(x, '{_D_END}') THEN 'navigation'
    WHEN len(w) >= 8 AND NOT regexp_matches(x, '{_D_END}') AND NOT regexp_matches(x, '{INNER_MARK}') THEN 'punctuation' ELSE '' END AS r FROM l2),
ln AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines,
    count(*) FILTER (r = 'boilerplate') AS n_boilerplate, count(*) FILTER (r = 'navigation') AS n_navigation,
    count(*) FILTER (r = 'symbols') AS n_symbols_l, count(*) FILTER (r = 'punctuation') AS n_punctuation,
    sum(length(l)) AS line_chars, coalesce(sum(length(l)) FILTER (r = ''), 0) AS kept_chars FROM l3 GROUP BY rid),
f AS (SELECT d.rid, doc_id, len(w.w)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
    coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_boilerplate, 0)::BIGINT AS n_boilerplate,
    coalesce(n_navigation, 0)::BIGINT AS n_navigation, coalesce(n_symbols_l, 0)::BIGINT AS n_symbol_lines,
    coalesce(n_punctuation, 0)::BIGINT AS n_punctuation, coalesce(line_chars, 0)::BIGINT AS line_chars,
    coalesce(kept_chars, 0)::BIGINT AS kept_chars
  FROM d JOIN w USING (rid) LEFT JOIN cov USING (rid) LEFT JOIN ln USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT * EXCLUDE (rid), NOT base_failed AND 2 * kept_chars >= line_chars AS kept FROM b
"""
