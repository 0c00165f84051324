"""Identifiers, log facts and next actions on hand-made inputs."""

import pytest
from pyspark.sql import functions as F

from trawl.functions import classify as C
from trawl.functions.identifiers import Rule, identifiers
from trawl.operators.logs import log_facts

PAGE = """<script>var g = "群号：99999999";</script><p>新生群，群号：119408121，QQ群：924058731。</p>这里还有更多的文字，说明怎样加入，请看下面的链接。群 55555 人聚集在这个小组
<a href="https://jq.qq.com/?_wv=1027&k=AbC-1_x">加群</a> https://t.me/joinchat/abcd_1 https://t.me/abcd_1 t.me/no
微信号：hello_w1，微信：id微信: QRcode1 &#32676;&#21495;&colon; 7654321 搜索 246810 加 群号 119408121"""


def test_identifiers(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, ""), (4, "x" * 300_000 + " 群:1234567")], "id int, page string")
    got = df.select("id", F.explode(identifiers(F.col("page"))).alias("x")).select("id", "x.*").collect()
    assert sorted((r.id, r.kind, r.value) for r in got) == [
        (1, "qq_link", "jq.qq.com/?_wv=1027&k=AbC-1_x"), (1, "qq_num", "119408121"), (1, "qq_num", "246810"), (1, "qq_num", "7654321"), (1, "qq_num", "924058731"),
        (1, "tg", "abcd_1"), (1, "wx_hint", "QRcode1"), (1, "wx_hint", "hello_w1"), (4, "qq_num", "1234567"),
    ]
    evidence = {r.value: r.evidence for r in got}
    assert evidence["119408121"].startswith("新生群，群号：119408121") and "  " not in evidence["119408121"]
    assert evidence["1234567"] == "x" * 57 + " 群:1234567"


def test_identifiers_with_own_rules(spark):
    df = spark.createDataFrame([("id=12 id=13 void, id=14",)], "page string")
    got = df.select(identifiers(F.col("page"), (Rule("id", r"id=(\d+)", guard=r"^\d+ void", stops=("14",)),), 3).alias("x")).first().x
    assert [(x.kind, x.value, x.evidence) for x in got] == [("id", "12", "id=12 id")]


LINES = [
    "细分 'A1' (total=120) -> 3子块 覆盖100 缺口20", "叶子 'B' total=5 唯一=4", "先抓 'C': 7 条落盘", "探测失败 2 字符，30s 后重试（轮 1）", "探测失败 'D'，跳过", "缺口 300（大），冷却",
    "=== 终局修复轮：6 个遗留缺口 ===", "[throttle] mode=slow interval=1.5s", "[throttle] up | interval=1.0->2.0s", "HTTP 429 q=x HTTP 500 q=y", "EXC OSError: no",
    "progress.json 不可用（缺失/空/损坏）→ 回退 progress.json.bak", "records 修复（最小丢弃）：损坏行 2 行", "records 全量反查重建：9 行有效记录", "一致性自愈：扫描 8 行有效记录", "容差 tolerance", "全部完成",
    "收敛：无新任务且无修复进展", "[conc] 条目异常 'E': KeyError", "HTTP 503 q=", "HTTP 404 q=z", "", None,
]


def test_log_facts(spark):
    df = spark.createDataFrame(list(enumerate(LINES)), "no int, line string")
    got = {r.name: (r.n, r.numeric, r.samples) for r in log_facts(df, "line", ["no"]).collect()}
    assert len(got) == 19
    assert got["branch"] == (1, 1, ["A1|120|3|100|20"])
    assert got["http_retry"] == (4, 4, ["429", "500", "503"])
    assert got["throttle_snapshot"] == (1, 1, ["slow|1.5"]) and got["probe_skip"] == (1, 0, ["D"])
    assert got["tolerance"] == (2, 0, ["容差", "tolerance"]) and got["exc"] == (1, 0, ["OSError"])
    assert log_facts(df.limit(0), "line", ["no"]).count() == 0


@pytest.mark.parametrize(("signed", "want"), [(True, "needs_reverse"), (False, "escalate_browser")])
def test_signature_error(spark, signed, want):
    step = C.next_action(F.lit("ok"), F.lit(200), F.lit(None).cast("string"), F.lit(True), F.lit(signed))
    assert spark.range(1).select(step.alias("s")).first().s.action == want
