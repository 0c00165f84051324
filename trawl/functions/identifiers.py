"""Identifiers of groups and accounts in pages (TXT-10)."""

from __future__ import annotations

import html
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf


class Rule(NamedTuple):
    """Group 1 of pattern is a value of this kind, sought in the plain text or in the raw page. It is refused where
    guard is found in the AHEAD characters from its start, or if it is one of stops."""

    kind: str
    pattern: str
    plain: bool = True
    guard: str = ""
    stops: tuple[str, ...] = ()


# Characters that a guard looks at, markup, numbers of members (no group numbers), words that are no account, and the patterns by kind.
AHEAD = 24
#: Pages whose hits are gathered in Python before they are a piece of the result.
SLICE = 64
BLOCKS, TAGS = r"(?is)<(script|style|noscript)[^>]*>.*?</\1\s*>", r"<[^>]+>"
MEMBERS = r"人\s*(聚集|加入|关注|收藏|浏览|在读|参与)"
NO_ACCOUNT = ("id", "号", "群", "二维码")
RULES = (
    Rule("qq_num", r"群\s*[号码]?\s*[:：]?\s*(\d{5,10})\b", guard=MEMBERS),
    Rule("qq_num", r"[QqＱｑ]\s*[Qq]\s*群\s*[:：]?\s*(\d{5,10})\b", guard=MEMBERS),
    Rule("qq_num", r"加\s*群\s*[:：]?\s*(\d{5,10})\b", guard=MEMBERS),
    Rule("qq_num", r"(\d{5,10})\s*[（(]?\s*[加入进].{0,4}群", guard=MEMBERS),
    Rule("qq_num", r"群\s*[:：]\s*(\d{5,10})\b", guard=MEMBERS),
    Rule("qq_num", r"搜索\s*[:：]?\s*(\d{5,10})\s*[加进]", guard=MEMBERS),
    Rule("qq_link", r"(jq\.qq\.com/\?[^\"'\s<>]*?k=[A-Za-z0-9_-]+)", plain=False),
    Rule("qq_link", r"(qm\.qq\.com/cgi-bin/qm/qr\?[^\"'\s<>]*?k=[A-Za-z0-9_-]+)", plain=False),
    Rule("qq_link", r"(qun\.qq\.com/[^\"'\s<>]{0,120})", plain=False),
    Rule("tg", r"(?:https?://)?t\.me/(?:joinchat/)?([A-Za-z0-9_+%-]{4,60})", plain=False),
    Rule("wx_hint", r"微信号?\s*[:：]\s*([A-Za-z][A-Za-z0-9_-]{4,29})", stops=NO_ACCOUNT),
    Rule("wx_hint", r"(?:添加|加)\s*(?:微信|V信|vx|VX)\s*[号]?\s*[:：]?\s*([A-Za-z][A-Za-z0-9_-]{4,29})", stops=NO_ACCOUNT),
    Rule("wx_hint", r"(?:微信|vx|VX)\s*[:：]\s*([A-Za-z][A-Za-z0-9_-]{4,29})", stops=NO_ACCOUNT),
)


def identifiers(page: Column, rules: tuple[Rule, ...] = RULES, window: int = 60) -> Column:
    """array of struct(kind, value, evidence): each (kind, value) once a page, at its first hit in the rules' order.

    Evidence is the text around it, window characters on each side, blanks squeezed. The plain text is the whole page without scripts, styles and
    tags, all entities replaced. A null page has none. Positions need Python's matcher: one Arrow-batched helper."""

    kind = pa.list_(pa.struct([(k, pa.string()) for k in ("kind", "value", "evidence")]))

    @arrow_udf("array<struct<kind: string, value: string, evidence: string>>")
    def seek(pages: pa.Array) -> pa.Array:
        tests = [(r, re.compile(r.pattern), re.compile(r.guard or r"(?!)")) for r in rules]

        def of(raw):
            plain, hits = html.unescape(re.sub(TAGS, " ", re.sub(BLOCKS, " ", raw))), {}
            for rule, pattern, guard in tests:
                text = plain if rule.plain else raw
                for m in pattern.finditer(text):
                    at, end = m.span(1)
                    if m[1].lower() not in rule.stops and not guard.search(text[at : at + AHEAD]):
                        hits.setdefault((rule.kind, m[1]), " ".join(text[max(0, at - window) : end + window].split()))
            return [{"kind": k, "value": v, "evidence": e} for (k, v), e in hits.items()]

        # one page at a time is a text in Python, beside the batch as it came
        done = [pa.array([of(raw.as_py() or "") for raw in pages[at : at + SLICE]], kind) for at in range(0, len(pages), SLICE)]
        return pa.concat_arrays(done) if done else pa.array([], kind)

    return seek(page)
