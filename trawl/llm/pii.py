"""Personal data: patterns, and a character-level BiLSTM-CRF that adds what they miss.

The patterns' spans are the labelled spans of the training: windows around digits and @, at most WINDOWS pieces from about SAMPLE texts (both
documented bounds; texts chosen by hash of their key, so that a copied text comes as often as its share, and equal pieces once). Most of them are rewritten in
ways that the patterns don't know: phones without plus, with 00, with dots or other separators; addresses with other separators; cards with dots or
slashes; blanks around the @. Numbers that are no personal data (dates, versions, sums, short phones) are put
in as spans of nothing. The trained tagger is sent to all tasks. Every span of these kinds
holds a digit or an @, so only stretches around such characters can hold one; they are cut into windows of WINDOW characters that overlap by half, decoded by
Viterbi, and reconciled over the whole text: a position has the tag of the window in whose middle it lies. Spans that
are cut at blanks and grown to whole words or addresses, read as their kind, or else as another one, and don't touch a pattern's span are added.

All positions are code points, ends exclusive. Null texts count as empty and have no spans. Repeated rows are judged alike. An empty table gives an
empty result; without a single labelled span nothing is added. Very long texts are read whole, their windows in batches. Spans with one start
are in the order of KINDS. Only key and text are read by scan(), and mask() keeps all columns, so other columns' names can't clash.
"""

from __future__ import annotations

import bisect
import re
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.bilstm import Tagger, coded
from trawl.llm.common import bounded_fraction, share, trimmed

KINDS = ("email", "ip", "card", "phone")
SAMPLE, WINDOWS, WINDOW, MARGIN = 800, 800, 64, 24
#: Times that a piece with spans is rewritten, and windows that are decoded at once.
REWRITES, AT_ONCE, EPOCHS = 2, 256, 6
_SPACED = re.compile(r"[A-Za-z0-9._%+-]+\x20?@\x20?[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP_GAPS = (".", "-", ",", " ", "[.]", "(.)", " . ")
_TRIGGER = re.compile("[0-9@]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches in linear time: from each @ back over the local part, then on over the domain."""
    out, at = [], 0
    while (p := text.find("@", at)) >= 0:
        start = p
        while start > at and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, p + 1) if start < p else None
        if m:
            out.append((start, m.end()))
        at = m.end() if m else p + 1
    return out


def base_spans(text: str) -> list[Span]:
    if not _TRIGGER.search(text):
        return []
    out = [(s, 0, e) for s, e in emails(text)]
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(int(x[-9:]) <= 255 and len(x.lstrip("0")) <= 3 for x in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(out)


def reads_as(kind: int, s: str) -> bool:
    """Whether a span that the tagger found reads as its kind."""
    d = _digits(s)
    if kind == 0:
        return bool(_SPACED.fullmatch(s))
    if kind == 1:
        parts = re.split(r"[^0-9]+", s)
        return len(parts) == 4 and all(p and len(p) <= 3 and int(p) <= 255 for p in parts) and len(gaps := set(re.findall(r"[^0-9]+", s))) == 1 and gaps <= set(_IP_GAPS)
    if kind == 2:
        return 14 <= len(d) <= 19 and d[0] != "0" and luhn(d) and len(s) <= 2 * len(d)
    if not (10 <= len(d) <= 15 and re.fullmatch(r"[0-9+(][0-9\x20().+/-]+[0-9]", s)):
        return False
    return s.startswith(("00", "+", "(")) or len(re.findall(r"[^0-9]+", s)) >= 2


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def windows(p: np.ndarray) -> np.ndarray:
    """Starts of the windows over all stretches within MARGIN of a digit or @."""
    hits = np.flatnonzero(((p >= 48) & (p < 58)) | (p == 64))
    if not len(hits):
        return hits
    cut = np.flatnonzero(np.diff(hits) > 2 * MARGIN)
    lo, hi = hits[np.concatenate([[0], cut + 1])] - MARGIN, hits[np.concatenate([cut, [len(hits) - 1]])] + MARGIN + 1
    out = [np.arange(a, max(a + 1, b - WINDOW // 2), WINDOW // 2) for a, b in zip(lo, hi, strict=True)]
    return np.maximum(np.concatenate(out), -MARGIN)


def cut(p: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Classes of the windows' characters; 0 beyond the text."""
    padded = np.concatenate([np.zeros(MARGIN, np.int64), coded(p), np.zeros(2 * WINDOW, np.int64)])
    return padded[(starts + MARGIN)[:, None] + np.arange(WINDOW)]


def tags_of(spans: list[Span], n: int) -> np.ndarray:
    """0 outside, 1 + 2 * kind at a span's start, 2 + 2 * kind inside it; the first span wins where two overlap."""
    y, end = np.zeros(n, np.int64), 0
    for s, k, e in spans:
        if s >= end:
            y[s:e] = 2 + 2 * k
            y[s] = 1 + 2 * k
            end = e
    return y


def tagged(model: Tagger, p: np.ndarray, starts: np.ndarray, tags: np.ndarray) -> list[Span]:
    """Spans of one text from its windows' tags: each position is tagged by the window in whose middle it lies."""
    where = starts[:, None] + np.arange(WINDOW)
    middle = np.minimum(np.arange(WINDOW), WINDOW - 1 - np.arange(WINDOW))
    ok = (where >= 0) & (where < len(p))
    w, t, m = where[ok], tags[ok], np.broadcast_to(middle, where.shape)[ok]
    order = np.lexsort([-m, w])
    w, t = w[order], t[order]
    first = np.concatenate([[True], w[1:] != w[:-1]]) if len(w) else np.zeros(0, bool)
    w, t = w[first], t[first]
    some = np.flatnonzero(t)
    out: list[Span] = []
    for i in some:
        k, begins = (int(t[i]) - 1) // 2, t[i] % 2 == 1
        if out and not begins and out[-1][1] == k and out[-1][2] == w[i]:
            out[-1] = (out[-1][0], k, int(w[i]) + 1)
        else:
            out.append((int(w[i]), k, int(w[i]) + 1))
    return out


_LEFT, _RIGHT = re.compile(r"[A-Za-z0-9+(]"), re.compile(r"[A-Za-z0-9]|[.-](?=[A-Za-z0-9])")


def whole(text: str, a: int, e: int) -> tuple[int, int]:
    """A tagged stretch without blanks at its ends, and grown to the ends of words that it cuts."""
    while a < e and text[a] in " \t\n":
        a += 1
    while a < e and not text[e - 1].isalnum():
        e -= 1
    low, high = a - WINDOW, e + WINDOW
    while a > max(0, low) and a < e and text[a].isalnum() and _LEFT.match(text[a - 1]):
        a -= 1
    while e < min(len(text), high) and a < e and _RIGHT.match(text, e):
        e += 1
    return a, e


def find(model: Tagger | None, texts: list[str | None]) -> list[tuple[list[Span], list[Span]]]:
    """(pattern spans, all spans) of each text."""
    out, rows, starts, cuts = [], [], [], []
    for i, t in enumerate(texts):
        base = base_spans(t) if t else []
        out.append((base, base))
        if model is not None and t and _TRIGGER.search(t):
            p = points(t)
            s = windows(p)
            rows.append((i, p))
            starts.append(s)
            cuts.append(cut(p, s))
    if rows:
        x = np.concatenate(cuts)
        tags = np.concatenate([model.decode(x[a : a + AT_ONCE]) for a in range(0, len(x), AT_ONCE)])
        at = 0
        for (i, p), s in zip(rows, starts, strict=True):
            base, more = out[i][0], []
            high = list(accumulate((b[2] for b in base), max))  # how far the spans up to each one reach
            for a, k, e in tagged(model, p, s, tags[at : at + len(s)]):
                a, e = whole(texts[i], a, e)
                if k == 0:  # the address that the tagged stretch is a part of
                    near = _SPACED.finditer(texts[i], max(0, a - WINDOW), e + WINDOW)
                    a, e = next((m.span() for m in near if m.start() < e and a < m.end()), (a, e))
                k = next((x for x in (k, 3, 1, 2, 0) if reads_as(x, texts[i][a:e])), -1)
                if k >= 0 and not ((n := bisect.bisect_left(base, (e,))) and high[n - 1] > a):
                    more.append((a, k, e))
            out[i] = (base, sorted(base + more))
            at += len(s)
    return out


def _other(kind: int, s: str, rng) -> str:
    """A span written another way, such that it still reads as its kind."""
    pick = lambda *x: x[rng.integers(len(x))]
    if kind == 0:
        return s.replace("@", pick(" @ ", " @ ", "@ ", " @"))
    if kind == 1:
        return s.replace(".", pick("-", "-", "-", *_IP_GAPS))
    d = _digits(s)
    if kind == 2:
        return pick(".", "/", "-", " ").join(d[i : i + 4] for i in range(0, len(d), 4))
    gap = pick(" ", ".", ".", "-", "/")
    cuts = sorted({int(x) for x in rng.integers(2, len(d) - 1, 4)} | {3, 6})
    body = gap.join(d[a:b] for a, b in zip([0, *cuts], [*cuts, len(d)]) if a < b)
    if rng.random() < 0.4:  # an international prefix in place of the plus
        return ("00" + body) if len(d) <= 13 else body
    if rng.random() < 0.3:
        return f"({body[:3]}){gap}{body[3:].lstrip(' ./-')}"
    return ("+" if rng.random() < 0.2 else "") + body


def _no_span(rng) -> str:
    """A number that is no personal data."""
    n = lambda k: "".join(str(rng.integers(10)) for _ in range(k))
    forms = (f"{n(4)}-{n(2)}-{n(2)}", f"{n(2)}.{n(2)}.{n(4)}", f"{n(1)}.{n(1)}.{n(2)}", f"{n(3)} {n(4)}", f"{n(2)}:{n(2)}", n(int(rng.integers(1, 9))), f"{n(2)},{n(3)},{n(3)}", f"{n(4)}/{n(2)}", f"${n(3)}.{n(2)}", f"@{'user' + n(2)}", f"{n(5)}-{n(3)}", f"{n(4)}-{n(4)}", f"{n(1)}. {n(2)} {n(3)}")
    return forms[rng.integers(len(forms))]


def _rewritten(text: str, spans: list[Span], rng) -> tuple[str, list[Span]]:
    """The text with its spans written in other ways, and the spans moved along; now and then a number of no kind in a span's place."""
    out, moved, at, length = [], [], 0, 0
    for s, k, e in spans:
        if s < at:
            continue
        none = rng.random() < 0.15
        new = _no_span(rng) if none else _other(k, text[s:e], rng)
        out += [text[at:s], new]
        length += s - at
        if not none:
            moved.append((length, k, length + len(new)))
        length += len(new)
        at = e
    return "".join([*out, text[at:]]), moved


def pieces_of(t: str) -> list[tuple[str, list[Span]]]:
    """A piece of text around each cluster of digits and @, with its spans; pieces that would cut a span are left out."""
    spans, out, last = base_spans(t), [], -1000
    for h in (m.start() for m in _TRIGGER.finditer(t)):
        if h - last > 2 * WINDOW:
            last = h
            a, b = max(0, h - WINDOW), min(len(t), h + WINDOW)
            if not any(s < b and e > a and not (a <= s and e <= b) for s, _, e in spans):
                out.append((t[a:b], [(s - a, k, e - a) for s, k, e in spans if a <= s and e <= b]))
    return out


def fit(docs: DataFrame, text: str = "text", key: str = "doc_id", epochs: int = EPOCHS) -> Tagger | None:
    """A tagger from the patterns' spans in a bounded sample of docs; None if there is no span."""
    some = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.col("text").rlike("[0-9@]"))
    n = some.count()
    chosen = some.where(share(F.col("key"), bounded_fraction(max(1, n), SAMPLE))).select("text")

    def cut_out(batches):
        for batch in batches:
            for t in batch.column(0).to_pylist():
                for piece, inside in pieces_of(t):
                    yield pa.RecordBatch.from_pydict({"piece": [piece], "spans": [[x for s in inside for x in s]]}, pa.schema([("piece", pa.string()), ("spans", pa.list_(pa.int32()))]))

    pieces = chosen.mapInArrow(cut_out, "piece string, spans array<int>")
    # exact copies would fill the sample
    rows = pieces.distinct().orderBy(F.xxhash64("piece")).limit(WINDOWS).collect()
    return train([(r.piece, [tuple(r.spans[i : i + 3]) for i in range(0, len(r.spans), 3)]) for r in rows], epochs)


def train(pieces: list[tuple[str, list[Span]]], epochs: int = EPOCHS) -> Tagger | None:
    """A tagger from labelled pieces of text, as they are and rewritten; None if there is no span."""
    rng = np.random.default_rng(5)
    xs, ys = [], []
    for piece, spans in pieces:
        for again in range(1 + REWRITES if spans else 1):
            t, s = (piece, spans) if not again else _rewritten(piece, spans, rng)
            p = points(t)
            y = np.concatenate([np.zeros(MARGIN, np.int64), tags_of(s, len(p)), np.zeros(2 * WINDOW, np.int64)])
            hits = windows(p)
            start = s[0][0] - int(rng.integers(0, WINDOW // 2)) if s else int(hits[rng.integers(len(hits))]) if len(hits) else 0
            start = max(-MARGIN, start)
            xs.append(cut(p, np.array([start]))[0])
            ys.append(y[start + MARGIN : start + MARGIN + WINDOW])
    if not xs or not any(y.any() for y in ys):
        return None
    model = Tagger(1 + 2 * len(KINDS))
    model.train(np.stack(xs), np.stack(ys), epochs, batch=64)
    return model


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, model: Tagger | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, base and spans, both as array of struct(s, kind, e)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    id_kind = docs.schema[key].dataType.simpleString()
    kind = pa.list_(pa.struct([("s", pa.int32()), ("kind", pa.string()), ("e", pa.int32())]))
    named = lambda spans: [{"s": s, "kind": KINDS[k], "e": e} for s, k, e in spans]

    def look(batches):
        model = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                found = find(model, part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([named(b) for b, _ in found], kind), pa.array([named(a) for _, a in found], kind)], ["doc_id", "base", "spans"])

    shape = "array<struct<s:int,kind:string,e:int>>"
    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(look, f"doc_id {id_kind}, base {shape}, spans {shape}")


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans become one."""
    out, at = [], 0
    for s, k, e in spans:
        if s < at:
            at = max(at, e)
            continue
        out += [text[at:s], f"<{KINDS[k].upper()}>"]
        at = e
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, model: Tagger | None, text: str = "text") -> DataFrame:
    """docs, with their columns, personal data in the text replaced."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def replace(batches):
        trimmed()
        model = sent.value
        for batch in batches:
            for a in range(0, batch.num_rows, 128):
                part = batch.slice(a, 128)
                texts = part.column(at).to_pylist()
                new = [None if t is None else masked(t, s) for t, (_, s) in zip(texts, find(model, texts), strict=True)]
                yield part.set_column(at, part.schema.field(at), pa.array(new, part.schema.field(at).type))

    return docs.mapInArrow(replace, docs.schema)
