"""The ticket contract: columns, the rule catalogue and the model spec.

A ticket ("problem point") row has ~53 string columns; 2 numerics and 16
categories feed the model, the problem id is carried for joining, and the
label ``自恢复状态`` (self-recovered or not) exists in training files only.
"""

from __future__ import annotations

from selfmend.functions.rules import Free, OneOf, Range, RuleSet
from selfmend.plans.scoring import ScoringSpec

ID = "问题点编号"
LABEL = "自恢复状态"
TIME = "问题触发时间"
CELL = "cgi"

# ---------------------------------------------------------------------------
# FIXED VALUES -- must equal the reference's rule dictionary exactly, in its
# order: permitted values per category, inclusive [lo, hi] per number, and the
# free-text entries (no domain). Entries marked enforced=False are declared
# but were never applied by the reference's check; they are opt-in here.
# ---------------------------------------------------------------------------
CATALOGUE = (
    Free("问题触发时间"),
    OneOf("地市", ("杭州", "宁波", "温州", "绍兴", "嘉兴", "湖州", "丽水", "金华", "衢州", "台州", "舟山")),
    OneOf("区县", (
        "上城", "下城", "江干", "拱墅", "西湖", "滨江", "下沙", "萧山", "余杭", "建德", "富阳", "临安", "桐庐", "淳安",
        "海曙", "江北", "北仑", "镇海", "鄞州", "奉化", "余姚", "慈溪", "象山", "宁海",
        "鹿城", "龙湾", "瓯海", "洞头", "瑞安", "乐清", "永嘉", "平阳", "苍南", "文成", "泰顺",
        "越城", "绍兴", "上虞", "诸暨", "嵊州", "新昌",
        "吴兴", "南浔", "德清", "长兴", "安吉",
        "南湖", "秀洲", "海宁", "平湖", "桐乡", "嘉善", "海盐",
        "婺城", "金东", "兰溪", "东阳", "永康", "义乌", "武义", "浦江", "磐安",
        "柯城", "衢江", "江山", "常山", "开化", "龙游",
        "椒江", "黄岩", "路桥", "临海", "温岭", "玉环", "三门", "天台", "仙居",
        "莲都", "龙泉", "青田", "缙云", "遂昌", "松阳", "云和", "庆元", "景宁", "开发区",
        "定海", "普陀", "岱山", "嵊泗")),
    OneOf("网络类型", ("4G", "2G"), enforced=False),
    OneOf("网元要素", ("基站", "小区")),
    OneOf("数据来源", ("OTT智能定位平台", "LTE-MR", "SEQ", "北向性能")),
    OneOf("问题归类(一级)", ("干扰问题", "负荷问题", "结构问题", "VOLTE问题", "性能问题", "覆盖问题", "感知问题",
                        "互操作问题")),
    OneOf("问题归类(二级)", ("掉线质差", "接通质差", "切换质差", "语音MOS质差", "高负荷", "SRVCC切换质差", "重叠覆盖",
                        "VOLTE丢包质差", "上行SINR质量差", "弱覆盖", "过覆盖", "CSFB性能质差", "零流量", "高干扰",
                        "VOLTE接通质差", "VOLTE掉话质差", "低速率")),
    Free("问题类型"),
    OneOf("类别要素", ("互操作", "感知", "质量", "负荷", "结构")),
    OneOf("是否追加", ("是", "否"), enforced=False),
    Free("主指标(事件)"),
    Range("主指标表征值", -200, 900, enforced=False),
    OneOf("处理优先级", ("中", "高")),
    OneOf("目前状态", ("待接入", "归档", "人工关闭", "已接入")),
    OneOf("是否为FDD站点", ("是", "否"), enforced=False),
    OneOf("是否实时工单已派单", ("是", "否"), enforced=False),
    OneOf("是否指纹库智能分析系统运算", ("是", "否")),
    OneOf("是否列为白名单", ("是", "否"), enforced=False),
    OneOf("是否为性能交维站点", ("是", "否"), enforced=False),
    OneOf("是否质检通过", ("是", "否", "未质检")),
    OneOf("资管生命周期状态", ("现网", "在网")),
    Range("告警触发次数", 1, 500),
    Range("日均流量(GB)", 0.0, 1000),
    OneOf("业务要素", ("数据", "语音")),
    OneOf("触发要素", ("劣于门限", "异常事件", "人工创造"), enforced=False),
    OneOf("场景要素", ("室分", "普铁", "风景区", "室外", "地铁", "高校", "山区", "全网", "高流量",
                   "高速", "高铁", "美食街", "高层", "小微站", "海域")),
    OneOf("覆盖类型", ("室内", "室外")),
    OneOf("覆盖场景", ("普铁", "地铁", "乡镇", "集贸市场", "公墓", "高速公路", "高层居民区", "写字楼", "高校",
                   "低层居民区", "会展中心", "风景区", "边境小区", "中小学", "党政军机关", "国道省道",
                   "党政军宿舍", "武警军区", "别墅群", "体育场馆", "郊区道路", "医院", "商业中心", "航道",
                   "高铁", "企事业单位", "码头", "长途汽车站", "其他", "广场公园", "城区道路", "工业园区",
                   "火车站", "机场", "休闲娱乐场所", "城中村", "村庄", "近水近海域", "山农牧林", "星级酒店")),
    Free("二级场景"),
    Range("中心经度", 118.037, 123.143, enforced=False),
    Range("中心维度", 27.22, 31.18, enforced=False),
    Range("TAC(LAC)", 22148, 26840, enforced=False),
)
# ---------------------------------------------------------------------------

RULES = RuleSet(CATALOGUE, id=ID)

# Training file layout: the 16 categories and 2 numbers in this order (the
# numbers at positions 12 and 13), plus the label.
TRAINING_ORDER = (RULES.categorical[:12] + RULES.numeric + RULES.categorical[12:])
TRAINING_NUMERIC_POSITIONS = (12, 13)

# The model: 100 trees, depth 8, one third of the features per split, gini.
# The reference trained on unvalidated rows, so a vocabulary may exceed its rule's values.
SPEC = ScoringSpec(RULES, LABEL, num_trees=100, max_depth=8, subset="onethird", seed=10, max_categories=1000)
