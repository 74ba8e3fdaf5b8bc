"""Synthetic ticket files with the shape of the scoring input.

No row of the reference's sample is copied: values are generated from the
rule catalogue by index patterns, chosen so that the per-field counts of
blank / out-of-domain values equal the counts observed on the sample (see
``GOLDEN``), plus training rows with a label.
"""

from __future__ import annotations

from selfmend.plans import tickets as T

# Scoring-input header (53 columns, the sample's column order).
HEADER = [
    "序号", "问题触发时间", "地市", "区县", "网络类型", "问题对象名称", "cgi", "网元要素", "数据来源",
    "问题归类(一级)", "问题归类(二级)", "问题现象", "问题类型", "类别要素", "是否追加", "问题描述",
    "主指标(事件)", "主指标表征值", "处理优先级", "目前状态", "是否为FDD站点", "是否实时工单已派单",
    "是否指纹库智能分析系统运算", "是否列为白名单", "是否为性能交维站点", "是否质检通过", "是否自恢复",
    "资管生命周期状态", "最新劣化时间", "最新触发时间", "劣化次数", "告警触发次数", "日均流量(GB)",
    "业务要素", "触发要素", "场景要素", "覆盖类型", "覆盖场景", "二级场景", "时间维度", "中心经度",
    "中心维度", "关闭人", "关闭时间", "关闭原因", "问题点编号", "工单号", "工单类型", "验证时间",
    "验证通过测试LOG", "验证不通过事件信息", "验证结果", "TAC(LAC)",
]
N = 44

# Expected NULLs after the enforced check (fields not listed: none).
GOLDEN = {"日均流量(GB)": 37, "区县": 17, "网元要素": 11, "数据来源": 30, "处理优先级": 30,
          "资管生命周期状态": 21, "覆盖类型": 4, "覆盖场景": 21}
# Expected NULLs from the unenforced (extended) rules.
GOLDEN_EXTENDED = {"触发要素": 4, "中心经度": 11, "中心维度": 11, "主指标表征值": 35, "TAC(LAC)": 17,
                   "是否列为白名单": 27}


def _allowed(col: str, i: int) -> str:
    return T.RULES.rule(col).values[i % len(T.RULES.rule(col).values)]


def ticket_row(i: int) -> dict[str, str]:
    r = {c: "" for c in HEADER}
    r["序号"] = str(i + 1)
    r["问题触发时间"] = f"2017/11/{10 + i % 20}{i % 24}:{i % 60:02d}:00"
    r["问题点编号"] = f"{570 + i % 3}-P-171115-{100000 + i}"
    r["cgi"] = "" if i % 11 == 3 else f"460-00-{600000 + i * 7}-{i % 4 + 1}"
    r["问题对象名称"] = f"site-{i:03d}"
    for c in T.RULES.categorical:
        r[c] = _allowed(c, i)
    # enforced categories, counts as in GOLDEN
    r["区县"] = "" if i < 17 else _allowed("区县", i)
    r["网元要素"] = "路段" if i < 11 else _allowed("网元要素", i)
    r["数据来源"] = "路测数据" if i < 30 else _allowed("数据来源", i)
    r["处理优先级"] = "低" if i >= 14 else _allowed("处理优先级", i)
    r["资管生命周期状态"] = ("" if i < 17 else "工程" if i < 19 else "维护" if i < 21 else
                       _allowed("资管生命周期状态", i))
    r["覆盖类型"] = "" if i >= 40 else _allowed("覆盖类型", i)
    r["覆盖场景"] = "" if i >= 40 else "高速" if i < 17 else _allowed("覆盖场景", i)
    # numbers: 44 valid alarm counts summing to 54 (min 1, max 5); 7 traffic values summing to 1.33
    r["告警触发次数"] = "5" if i == 0 else "4" if i == 1 else "2" if i < 5 else "1"
    traffic = ["0.5", "0.3", "0.2", "0.15", "0.1", "0.05", "0.03"]
    r["日均流量(GB)"] = traffic[i] if i < 7 else ""
    # unenforced rules
    r["触发要素"] = "人工创建" if i < 4 else "劣于门限"
    r["中心经度"] = "" if i < 4 else "0" if i < 11 else f"{120 + (i % 10) / 10:.1f}"
    r["中心维度"] = "" if i < 4 else "0" if i < 11 else f"{29 + (i % 10) / 10:.1f}"
    r["主指标表征值"] = "" if i < 35 else str(-10 + i)
    r["TAC(LAC)"] = "" if i < 17 else str(22148 + i)
    r["是否列为白名单"] = "" if i < 27 else "否"
    r["网络类型"] = "4G"
    r["是否追加"] = "否"
    r["是否为FDD站点"] = "是"
    r["是否实时工单已派单"] = "否"
    r["是否为性能交维站点"] = "否"
    r["问题类型"] = f"type-{i % 5}"
    r["主指标(事件)"] = f"kpi-{i % 4}"
    r["二级场景"] = "" if i % 6 == 0 else f"scene-{i % 3}"
    r["问题描述"] = f"描述{i}；详见"
    r["是否自恢复"] = "否"
    return r


def ticket_lines() -> list[str]:
    """The scoring file as text lines: header first, no quoting."""
    return [",".join(HEADER)] + [",".join(ticket_row(i)[c] for c in HEADER) for i in range(N)]


def training_rows(n: int = 400) -> list[dict[str, str]]:
    """Labelled training rows over the 18 model columns; the label depends
    on the alarm count and the city so a forest can learn it."""
    rows = []
    for i in range(n):
        r = {c: _allowed(c, i + j) for j, c in enumerate(T.RULES.categorical)}
        alarms = 1 + (i * 13) % 40
        r["告警触发次数"] = str(alarms)
        r["日均流量(GB)"] = f"{(i * 37) % 500 / 10:.1f}"
        city_idx = T.RULES.rule("地市").values.index(r["地市"])
        r[T.LABEL] = "是" if (alarms < 12 or city_idx % 3 == 0) else "否"
        rows.append(r)
    return rows
