"""Secret scans: fixed patterns plus a randomness test battery.

Fixed kinds, leftmost and non-overlapping per kind: ``assign`` (a named value
of :data:`ASSIGN_MIN` characters or more), ``access`` (``AKIA...``, 20 or
more) and ``hex`` (lower-case hex, 24 or more).

The battery adds kind ``random``.  Candidates are maximal runs of
``[A-Za-z0-9+/_=-]`` of :data:`TOKEN_MIN` characters or more that touch no fixed
span.  Their encoding (hex, base32, base36, base64) is the smallest alphabet
that holds all symbols.  A candidate must not be rejected as uniform noise by
any of three tests at level :data:`GATE`: chi-squared over the alphabet, runs
above and below the middle of the alphabet, lag-1 serial correlation.  The
evidence against written text is the p-value of the first two statistics under
a written-text null (chi-squared with the index of coincidence of prose; few
changes between letters, capitals and digits), combined by Fisher's method.

False discoveries are controlled over the whole corpus and per length class
(powers of two): candidates are counted by class and p-value bin, and
Benjamini-Hochberg at :data:`FDR` sets each class's threshold.  The histogram
has at most classes x bins rows whatever the corpus size.

Spans are in code points, end exclusive.  Edge cases: null texts are empty;
repeated rows and ids are scanned row by row; further columns pass through;
empty tables give empty results; a token of any length is tested in full.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_batches, chunks, stored, utf8, word_spans

SHARD_BYTES = 8 << 20
ASSIGN_MIN, ACCESS_MIN, HEX_MIN, TOKEN_MIN = 6, 20, 24, 16
FDR, GATE = 0.01, 0.001
BIN_WIDTH, BINS = 0.25, 160  # of -log10 p
KINDS = ["assign", "access", "hex", "random"]

ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE)
_MAY_ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]"""


def _set(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_DIGIT, _LOW, _UP = b"0123456789", bytes(range(97, 123)), bytes(range(65, 91))
_HEX = _set(_DIGIT + b"abcdef")
_CAPS = _set(_UP + _DIGIT)
_TOKEN = _set(_UP + _LOW + _DIGIT + b"+/_=-")
#: name, alphabet, smallest first; a token takes the first that holds it.
_ALPHABETS = [("digits", _DIGIT), ("hex", _DIGIT + b"abcdef"), ("HEX", _DIGIT + b"ABCDEF"),
              ("base32", _UP + b"234567"), ("base36", _LOW + _DIGIT), ("base64", _UP + _LOW + _DIGIT + b"+/"),
              ("base64url", _UP + _LOW + _DIGIT + b"-_"), ("any", _UP + _LOW + _DIGIT + b"+/-_=")]
_CLASS = np.zeros(256, np.int64)
_CLASS[list(_LOW)], _CLASS[list(_UP)], _CLASS[list(_DIGIT)] = 1, 2, 3
#: Excess coincidence of written text over uniform noise, and its rate of class changes.
PROSE_EXCESS, PROSE_CHANGES = 0.73, 0.1


def _phi(z: np.ndarray) -> np.ndarray:
    """Upper tail of the normal distribution (Abramowitz and Stegun 7.1.26)."""
    a = np.abs(z) / np.sqrt(2)
    t = 1 / (1 + 0.3275911 * a)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    tail = np.maximum(0.5 * poly * np.exp(-a * a), 1e-40)
    return np.where(z >= 0, tail, 1 - tail)


def battery(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """-log10 of the p-value against written text for each token; 0 for a token
    that the uniformity gate or its encoding (digits only) rules out."""
    n = len(starts)
    if not n:
        return np.zeros(0)
    length = ends - starts
    tok = np.repeat(np.arange(n), length)
    at = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length) + np.repeat(starts, length)
    sym = raw[at]
    data = np.ones(len(sym), bool)  # '=' padding carries no information
    data[sym == 61] = False
    m = np.bincount(tok[data], minlength=n).astype(float)
    kind = np.full(n, len(_ALPHABETS) - 1)
    for i in range(len(_ALPHABETS) - 1, -1, -1):
        bad = np.bincount(tok[data & ~_set(_ALPHABETS[i][1])[sym]], minlength=n)
        kind[bad == 0] = i
    code = np.zeros((len(_ALPHABETS), 256), np.int64)
    for i, (_, a) in enumerate(_ALPHABETS):
        code[i, list(a)] = np.arange(len(a))
    k = np.array([len(a) for _, a in _ALPHABETS], float)[kind]
    value = code[kind[tok], sym]
    pair, count = np.unique(tok[data] * 128 + value[data], return_counts=True)
    square = np.bincount(pair // 128, weights=count.astype(float) ** 2, minlength=n)
    with np.errstate(divide="ignore", invalid="ignore"):
        chi = k / m * square - m
        # Uniformity gate.
        z_chi = (chi - (k - 1)) / np.sqrt(2 * (k - 1))
        high = value >= np.repeat(k, length) / 2
        mid = (value + 0.5) / np.repeat(k, length) - 0.5
        next_same = np.zeros(len(sym), bool)
        next_same[:-1] = (tok[1:] == tok[:-1]) & data[1:] & data[:-1]
        i = np.flatnonzero(next_same)
        pairs = np.maximum(np.bincount(tok[i], minlength=n), 1)
        changes = np.bincount(tok[i], weights=high[i] != high[i + 1], minlength=n)
        z_runs = (changes - pairs / 2) / np.sqrt(pairs / 4)
        serial = np.bincount(tok[i], weights=mid[i] * mid[i + 1], minlength=n) * 12
        z_serial = serial / np.sqrt(pairs)
        # Written-text null.
        mean = (k - 1) + m * PROSE_EXCESS
        z1 = (chi - mean) / np.sqrt(2 * (k - 1) + 4 * m * PROSE_EXCESS)
        cls = np.bincount(tok[i], weights=_CLASS[sym[i]] != _CLASS[sym[i + 1]], minlength=n)
        z2 = (cls - 0.5 - pairs * PROSE_CHANGES) / np.sqrt(pairs * PROSE_CHANGES * (1 - PROSE_CHANGES))
    p = np.maximum(_phi(-z1), 1e-40) * np.maximum(_phi(z2), 1e-40)
    log10 = -np.log10(np.maximum(p * (1 - np.log(p)), 1e-60))  # Fisher's method for two
    gate = (2 * _phi(np.abs(z_runs)) >= GATE) & (2 * _phi(np.abs(z_serial)) >= GATE) & (_phi(z_chi) >= GATE)
    return np.where(gate & (kind > 0) & (m >= TOKEN_MIN), np.nan_to_num(np.maximum(log10, 0)), 0.0)


def _fixed(raw: np.ndarray, off: np.ndarray, column) -> list[tuple[int, int, int, int]]:
    """(row, start byte, kind, end byte) of the fixed kinds in a shard."""
    out = []
    for kind, alphabet, least in ((2, _HEX, HEX_MIN), (1, _CAPS, ACCESS_MIN)):
        s, e, _ = word_spans(raw, off, alphabet)
        long = e - s >= least
        s, e = s[long], e[long]
        row = np.searchsorted(off, s, "right") - 1
        for r, a, b in zip(row.tolist(), s.tolist(), e.tolist()):
            if kind == 1:  # at the first AKIA that something follows
                at = raw[a:b - 1].tobytes().find(b"AKIA")
                if at < 0 or b - a - at < least:
                    continue
                a += at
            out.append((r, a, kind, b))
    for r in np.flatnonzero(pc.fill_null(pc.match_substring_regex(column, _MAY_ASSIGN), False).to_numpy(
            zero_copy_only=False)).tolist():
        base = int(off[r])
        for m in ASSIGN.finditer(raw[base:off[r + 1]].tobytes()):
            if m.end(2) - m.start(2) >= ASSIGN_MIN:
                out.append((r, base + m.start(), 0, base + m.end()))
    return sorted(out)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for tab in chunks(batches, SHARD_BYTES):
        col = tab["text"].combine_chunks()
        raw, off = utf8(col)
        fixed = _fixed(raw, off, col)
        s, e, _ = word_spans(raw, off, _TOKEN)
        long = e - s >= TOKEN_MIN
        s, e = s[long], e[long]
        if fixed:  # without those that touch a fixed span
            fs = np.array([x[1] for x in fixed])
            fe = np.maximum.accumulate(np.array([x[3] for x in fixed]))
            j = np.searchsorted(fs, e) - 1
            free = (j < 0) | (fe[np.maximum(j, 0)] <= s)
            s, e = s[free], e[free]
        score = battery(raw, s, e)
        row = np.searchsorted(off, s, "right") - 1
        cls = np.floor(np.log2(np.maximum(e - s, 1))).astype(np.int64)
        place = np.minimum((score / BIN_WIDTH).astype(np.int64), BINS - 1)
        spans: list[list] = [[] for _ in range(tab.num_rows)]
        cands: list[list] = [[] for _ in range(tab.num_rows)]
        counts: list[dict] = [{} for _ in range(tab.num_rows)]
        for r, a, kind, b in fixed:
            spans[r].append((a, kind, b))
        for r, c, p, a, b in zip(row.tolist(), cls.tolist(), place.tolist(), s.tolist(), e.tolist()):
            counts[r][(c, p)] = counts[r].get((c, p), 0) + 1
            if p:
                cands[r].append((a, b, c, p))
        out_spans, out_cands = [], []
        for r in range(tab.num_rows):
            if not spans[r] and not cands[r]:
                out_spans.append([])
                out_cands.append([])
                continue
            lead = np.concatenate([[0], np.cumsum((raw[off[r]:off[r + 1]] & 0xC0) != 0x80)])
            cp = lambda x, r=r, lead=lead: int(lead[x - off[r]])
            out_spans.append([{"start": cp(a), "kind": k, "end": cp(b)} for a, k, b in spans[r]])
            out_cands.append([{"start": cp(a), "end": cp(b), "cls": c, "bin": p} for a, b, c, p in cands[r]])
        tested = [[{"cls": c, "bin": p, "n": n} for (c, p), n in x.items()] for x in counts]
        for name, values in (("__fixed", out_spans), ("__cands", out_cands), ("__tested", tested)):
            at = tab.schema.get_field_index(name)
            tab = tab.set_column(at, tab.schema.field(at), pa.array(values, tab.schema.field(at).type))
        yield from tab.to_batches()


_FIXED = "array<struct<start:int,kind:int,end:int>>"
_CANDS = "array<struct<start:int,end:int,cls:int,bin:int>>"
_TESTED = "array<struct<cls:int,bin:int,n:bigint>>"


def thresholds(scanned: DataFrame) -> dict[int, int]:
    """Benjamini-Hochberg per length class: the lowest p-value bin that counts
    as a discovery.  A bin's p-value is that of its upper edge."""
    rows = (scanned.select(F.explode("__tested").alias("t")).groupBy("t.cls", "t.bin")
            .agg(F.sum("t.n").alias("n")).collect())
    out = {}
    for cls in sorted({r["cls"] for r in rows}):
        hist = {r["bin"]: r["n"] for r in rows if r["cls"] == cls}
        total, above = sum(hist.values()), 0
        for b in sorted(hist, reverse=True):
            above += hist[b]
            if b and 10 ** (-b * BIN_WIDTH) * total <= FDR * above:
                out[cls] = b
    return out


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` plus fixed spans, candidates and the counts of tested tokens."""
    arrow_batches(docs.sparkSession)
    df = docs.withColumns({"__fixed": F.array().cast(_FIXED), "__cands": F.array().cast(_CANDS),
                           "__tested": F.array().cast(_TESTED)})
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
    return df.mapInArrow(_scan, schema)


def decided(found: DataFrame) -> DataFrame:
    """The scan's result, stored once, with the spans that stand."""
    found = stored(found, "secrets")
    limit = thresholds(found)
    test = " or ".join(f"(x.cls = {c} and x.bin >= {b})" for c, b in limit.items()) or "false"
    return found.withColumn("__spans", F.expr(
        f"sort_array(concat(__fixed, transform(filter(__cands, x -> {test}), "
        f"x -> struct(x.start as start, 3 as kind, x.end as end))))"))


def _digest(spans: str) -> str:
    kinds = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return f"array_join(transform({spans}, x -> concat({kinds}[x.kind], ':', x.start, ':', x.end)), ',')"


def report(docs: DataFrame) -> DataFrame:
    """One row per document: counts by kind, the digest of the fixed spans and
    all spans."""
    found = decided(scan(docs.select("doc_id", "text")).drop("text"))
    count = lambda k: F.expr(f"cast(size(filter(__spans, x -> x.kind = {k})) as bigint)")
    return found.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
                        F.expr(f"sha2(cast({_digest('filter(__spans, x -> x.kind < 3)')} as binary), 256)").alias("base_sha256"),
                        F.expr(_digest("__spans")).alias("spans"))


MASK = "[SECRET]"


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span (overlaps merged) replaced by :data:`MASK`."""
    found = decided(scan(docs))
    merge = ("aggregate(__spans, cast(array() as array<struct<a:int,b:int>>), (acc, x) -> "
             "case when size(acc) > 0 and element_at(acc, -1).b >= x.start "
             "then concat(slice(acc, 1, size(acc) - 1), array(struct(element_at(acc, -1).a as a, "
             "greatest(element_at(acc, -1).b, x.end) as b))) "
             "else concat(acc, array(struct(x.start as a, x.end as b))) end)")
    found = found.withColumn("__merged", F.expr(f"case when size(__spans) = 0 then null else {merge} end"))
    found = found.withColumn("__new", F.expr(
        f"case when __merged is null then text else concat(array_join(transform(__merged, (m, i) -> "
        f"substring(text, 1 + case when i = 0 then 0 else __merged[i - 1].b end, "
        f"m.a - case when i = 0 then 0 else __merged[i - 1].b end)), '{MASK}'), '{MASK}', "
        f"substring(text, 1 + element_at(__merged, -1).b)) end"))
    out = []
    for c in docs.columns:
        if c == "text":
            out.append(F.col("__new").alias(c))
        elif c == "n_chars":
            out.append(F.when(F.col("__merged").isNull(), F.col(c)).otherwise(
                F.length("__new").cast(docs.schema[c].dataType)).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return found.select(*out)
