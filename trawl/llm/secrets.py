"""Secret scan with SQL functions only: fixed patterns, and a battery of randomness tests for other tokens.

Positions of matches come from the pieces between them: split() by the pattern gives the pieces, regexp_extract_all()
the matches; lengths are added up within stretches of STRETCH matches, and then over stretches, so that a text with very many
matches isn't quadratic. All positions are code points, ends exclusive.

Tokens of 12 characters or more (CANDIDATE) that touch no pattern's span are tested. The encoding is inferred from the characters
(digits, hex, base32, lower or upper letters with digits, base64); separators within a token, and capitals that begin a
word, don't count as a change. Three tests give p-values under the hypothesis that a token is written like text:
chi-squared against a uniform alphabet (text is further from uniform, as its pairs of characters coincide with chance IC),
runs of one character class (text changes class with chance TURN), and serial correlation (the mean square step
between neighbours, in places of an alphabet of letters and digits without regard to case, is about STEP in text and more where unrelated characters follow each other). Each p is LEAST at least, so that no
test decides alone. Fisher's method joins the three. Benjamini-Hochberg within bands of
length keeps the false discovery rate at ALPHA; it needs only a histogram of p-values, whose size is fixed.

Null texts count as empty and have no spans; an empty table gives an empty result; repeated rows are judged alike. Very long texts are
read whole. Overlapping spans of several kinds all stay; spans with one start are in the order of KINDS. Only key and text are read, so other columns' names can't clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import staged

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: As long as a match may not be retried from within, runs of the least length are what a filter by length leaves.
ACCESS, HEX = r"AKIA[A-Z0-9]{16,}", r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{12,}"
ALPHA = 0.01
#: Text: chance that two characters are the same, chance of a change of class between neighbours, mean square step, and its spread for one pair.
IC, TURN, STEP, SPREAD = 0.065, 0.08, 112.0, 140.0
LEAST = 1e-5
STRETCH = 256
#: Bands of 8 characters, quarter decades of p.
BANDS, BINS = 16, 80
_SPANS = "array<struct<s:int,k:int,e:int>>"


def _sql(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def find(pattern: str, kind: int, least: str = "true", group: int = 0, words: bool = False) -> str:
    """SQL for the spans (start, kind, end, with words the text) of a pattern's leftmost matches in column t. least: on x.g, the group's text."""
    shape = _SPANS.replace(">>", ",w:string>>") if words else _SPANS
    w, yw = (", x.w AS w", ", y.w AS w") if words else ("", "")
    p = _sql(pattern)
    group_of = f"regexp_extract(w, {p}, {group})" if group else "w"
    none = f"cast(array() as {shape})"
    cut = f"zip_with(transform(regexp_extract_all(t, {p}, 0), w -> struct(w AS w, {group_of} AS g)), split(t, {p}, -1), (x, y) -> struct(x.w AS w, x.g AS g, length(y) AS p))"
    part = f"""transform(sequence(0, size(all) - 1, {STRETCH}), i -> aggregate(slice(all, i + 1, {STRETCH}),
      cast(struct(0 AS pos, {none} AS arr) AS struct<pos:int,arr:{shape}>),
      (a, x) -> struct(a.pos + x.p + coalesce(length(x.w), 0) AS pos, CASE WHEN x.w IS NOT NULL AND {least} THEN concat(a.arr, array(struct(a.pos + x.p AS s, {kind} AS k, a.pos + x.p + length(x.w) AS e{w}))) ELSE a.arr END AS arr)))"""
    before = "aggregate(parts, cast(array(0) AS array<int>), (a, x) -> concat(a, array(element_at(a, -1) + x.pos)))"
    named = lambda value, name, then: f"transform(array({value}), {name} -> {then})[0]"
    joined = f"flatten(zip_with(parts, slice(starts, 1, size(parts)), (x, d) -> transform(x.arr, y -> struct(y.s + d AS s, y.k AS k, y.e + d AS e{yw}))))"
    return f"CASE WHEN t RLIKE {p} THEN {named(cut, 'all', named(part, 'parts', named(before, 'starts', joined)))} ELSE {none} END"


def _phi(z: str) -> str:
    """The normal distribution by a logistic form (fixed coefficients)."""
    return f"(1 / (1 + exp(-1.5976 * greatest(-8, least(8, {z})) - 0.07056 * pow(greatest(-8, least(8, {z})), 3))))"


def battery(w: str) -> str:
    """SQL for struct(p, n) of a token."""
    kind = lambda v: f"""CASE WHEN {v} RLIKE '^[0-9]+$' THEN '0123456789' WHEN {v} RLIKE '^[0-9a-f]+$' THEN '0123456789abcdef' WHEN {v} RLIKE '^[0-9A-F]+$' THEN '0123456789ABCDEF'
      WHEN {v} RLIKE '^[A-Z2-7]+$' THEN 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567' WHEN {v} RLIKE '^[a-z0-9]+$' THEN 'abcdefghijklmnopqrstuvwxyz0123456789' WHEN {v} RLIKE '^[A-Z0-9]+$' THEN 'ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789'
      ELSE 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+' END"""  # noqa: E731
    classes = f"translate(regexp_replace(z.v, '[A-Z](?=[a-z]{{2}})', 'a'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+', '{'A' * 26}{'a' * 26}{'0' * 10}+')"
    step = lambda of, name, then: f"transform(array(struct({of})), {name} -> {then})[0]"  # noqa: E731  a name for a value
    bare = f"translate({w}, '-_/=', '') AS v"
    first = f"z.v AS v, length(z.v) AS n, {kind('z.v')} AS abc, length(regexp_replace({classes}, '(.)\\\\1*', 'x')) - 1 AS turns"
    second = """a.n AS n, a.turns AS turns, length(a.abc) AS k,
      aggregate(array_distinct(split(a.v, '')), 0D, (acc, ch) -> acc + pow(a.n - length(replace(a.v, ch, '')), 2)) AS sq,
      transform(split(a.v, ''), ch -> cast(instr('abcdefghijklmnopqrstuvwxyz0123456789+', lower(ch)) AS double)) AS at"""
    third = "b.n AS n, b.turns AS turns, b.k AS k, b.sq AS sq, aggregate(zip_with(slice(b.at, 1, b.n - 1), slice(b.at, 2, b.n - 1), (x, y) -> (x - y) * (x - y)), 0D, (acc, v) -> acc + v) / (b.n - 1) AS step"
    # chi-squared is k * sq / n - n; in text, sq is n + n * (n - 1) * IC, give or take
    chi, chi_text, chi_sd = "(d.k * d.sq / d.n - d.n)", f"(d.k * (1 + (d.n - 1) * {IC}) - d.n)", f"(d.k * sqrt(2 * d.n * (d.n - 1) * {IC}) / d.n)"
    least = lambda p: f"-ln(greatest({LEAST}D, {p}))"
    tests = (
        least(_phi(f"(({chi} - {chi_text}) / {chi_sd})")),
        least(f"1 - {_phi(f'((d.turns - 0.5 - (d.n - 1) * {TURN}) / sqrt((d.n - 1) * {TURN * (1 - TURN)}))')}"),
        least(f"1 - {_phi(f'((d.step - {STEP}) / ({SPREAD} / sqrt(d.n)))')}"),
    )
    last = "struct(exp(-e.f) * (1 + e.f + e.f * e.f / 2) AS p, e.n AS n)"  # chi-squared with six degrees of freedom
    tested = step(bare, "z", step(first, "a", step(second, "b", step(third, "d", step(f"{' + '.join(tests)} AS f, d.n AS n", "e", last)))))
    return f"CASE WHEN length(translate({w}, '-_/=', '')) >= 12 THEN {tested} ELSE struct(1D AS p, 0 AS n) END"


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: key, spans (array of struct(s, k, e); k indexes KINDS) and base (without the tests' own)."""
    t = docs.select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("t"))
    base = f"concat({find(ASSIGN, 0, 'length(x.g) >= 6', 2)}, {find(ACCESS, 1)}, {find(HEX, 2)})"
    t = t.selectExpr("key", "t", f"array_sort({base}) AS base", f"{find(CANDIDATE, 3, words=True)} AS cand")
    # stretch by stretch, so that a text with many of both isn't quadratic
    near = "filter(base, b -> b.s < element_at(part, -1).e AND b.e > part[0].s)"
    free = f"transform(array({near}), near -> filter(part, c -> NOT exists(near, b -> b.s < c.e AND c.s < b.e)))[0]"
    free = f"flatten(transform(transform(sequence(0, size(cand) - 1, {2 * STRETCH}), i -> slice(cand, i + 1, {2 * STRETCH})), part -> {free}))"
    free = f"CASE WHEN size(base) > 0 AND size(cand) > 0 THEN {free} ELSE cand END"
    t = t.selectExpr("key", "base", f"{free} AS cand")
    tested = f"transform(cand, tok -> struct(tok.s AS s, tok.k AS k, tok.e AS e, {battery('tok.w')} AS f))"
    t = t.selectExpr("key", "base", f"transform({tested}, c -> struct(c.s AS s, c.k AS k, c.e AS e, c.f.p AS p, least(div(c.f.n, 8), {BANDS}) AS band)) AS cand")
    t = staged(t, "secrets")
    rows = t.where("size(cand) > 0").select(F.explode("cand").alias("c")).select("c.*")
    n_bins = rows.selectExpr("cast(band AS int) AS band", f"cast(least(floor(-log10(greatest(p, 1e-30)) * 4), {BINS}) AS int) AS bin").groupBy("band", "bin").count().collect()  # (BANDS + 1) * (BINS + 1) rows at most
    limits = {}
    for band in {r.band for r in n_bins}:
        total = sum(r["count"] for r in n_bins if r.band == band)
        for b in range(BINS + 1):  # the weakest bin at which the expected share of false ones is under ALPHA
            found = sum(r["count"] for r in n_bins if r.band == band and r.bin >= b)
            if found and total * 10 ** (-b / 4) / found <= ALPHA:
                limits[band] = 10 ** (-b / 4)
                break
    limit = "CASE " + " ".join(f"WHEN c.band = {k} THEN {v!r}D" for k, v in sorted(limits.items())) + " ELSE -1D END" if limits else "-1D"
    return t.selectExpr("key", "base", f"array_sort(concat(base, transform(filter(cand, c -> c.p <= {limit}), c -> struct(c.s AS s, c.k AS k, c.e AS e)))) AS spans").withColumnRenamed("key", key)


def written(spans: str) -> str:
    """SQL for kind:start:end, comma-joined."""
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return f"concat_ws(',', transform({spans}, x -> concat({names}[x.k], ':', x.s, ':', x.e)))"
