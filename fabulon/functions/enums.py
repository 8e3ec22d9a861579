"""Closed value sets of the annotation contract."""

from __future__ import annotations

# fixed values: legal values by dimension
D01 = ["背景铺垫", "激励事件", "上升行动", "转折", "高潮", "下降行动", "结局", "过渡", "复合功能", "无法判断"]
D04_CORE = ["平静", "压抑", "焦虑", "悲伤", "愤怒", "恐惧", "喜悦", "希望", "绝望", "孤独", "信任", "屈辱", "嫉妒", "复仇", "悬疑", "释然", "羞耻", "惊讶", "渴望", "厌恶"]
D04_LEGACY = ["尊严", "背叛", "贪婪", "宽恕"]
POLARITY = ["positive", "negative", "neutral", "mixed"]
D07 = ["第一人称", "第二人称", "第三人称有限", "第三人称全知", "多视角", "不可靠叙述者", "客观叙事"]
D10 = ["推动情节", "揭示性格", "传递信息", "制造冲突", "营造氛围", "复合功能"]
D11 = ["环境描写", "心理描写", "动作描写", "外貌描写", "感官描写"]
D06 = ["揭示", "隐藏", "误导", "复合"]
D06_TECHNIQUES = ["延迟揭示", "选择性披露", "视角遮蔽", "不可靠叙述者误导", "信息过载", "误导性伏笔", "悬念留白"]
RELIABILITY = ["可靠", "部分不可靠", "不可靠", "无法判断"]
D08_TIME_TYPES = ["linear", "flashback", "flashforward", "analepsis", "prolepsis"]
D08_LEVELS = ["1", "2", "3+"]
D12 = ["场景", "概述", "停顿", "省略", "摘要"]
RHETORIC = ["比喻", "拟人", "排比", "反讽", "通感", "夸张", "对比", "象征"]
IMAGERY = ["自然意象", "器物意象", "人体意象", "色彩意象", "抽象意象"]
DICTION = ["动词", "形容词", "副词", "名词"]
SYNTAX = ["排比", "长短交替", "倒装", "独词句", "对偶", "设问"]
RELATIONS = ["伏笔-回收", "因果", "时序", "对比", "呼应"]
CONFIDENCE_METHODS = ["model_self_report", "consistency_check", "human_review"]
SECTIONS = ["frontmatter", "body", "epilogue"]
STATUS = ["tentative", "confirmed", "superseded"]
VERSIONS = ["2.5.0", "2.6.0", "2.7.0", "2.8.0", "2.9.0", "2.10.0"]
EMOTIONS = [
    "喜悦", "悲伤", "愤怒", "恐惧", "惊讶", "期待", "厌恶", "信任", "依恋", "眷恋", "温情", "甜蜜", "哀恸", "苍凉", "怅惘", "物哀", "悲悯", "怀旧", "心碎", "绝望",
    "宽慰", "安宁", "旷达", "释然", "崇敬", "敬畏", "震撼", "崇高感", "荒诞感", "漂泊感", "隐忍", "焦虑", "恐慌", "鄙夷", "疏离", "厌倦", "冷漠", "羞耻", "渴望", "嫉妒",
    "迷茫", "感动", "得意", "悲欣交集", "爱恨交织", "苦乐参半", "克制中的温情", "冷峻中的悲悯", "叙述性冷漠", "反讽性平静",
]
SEASONS = ["春", "夏", "秋", "冬"]

# fixed values: the class of an event by narrative function
EVENT_FUNCTION = {"背景铺垫": "开启", "激励事件": "开启", "上升行动": "发展", "过渡": "发展", "高潮": "高潮", "转折": "高潮", "下降行动": "收束", "结局": "收束"}
# fixed values: acts by narrative function
ACTS = {"背景铺垫": "exposition", "激励事件": "inciting_incident", "上升行动": "rising_action", "转折": "climax", "高潮": "climax", "下降行动": "falling_action", "结局": "resolution"}
ACT_ORDER = ["exposition", "inciting_incident", "rising_action", "climax", "falling_action", "resolution"]
# fixed values: beats as shares of a text
BEATS = [
    ("opening_image", 0.0, 0.05), ("theme_stated", 0.05, 0.10), ("setup", 0.0, 0.10), ("catalyst", 0.10, 0.15), ("debate", 0.15, 0.25), ("break_into_two", 0.25, 0.30), ("fun_and_games", 0.30, 0.55),
    ("midpoint", 0.45, 0.55), ("bad_guys_close_in", 0.55, 0.75), ("all_is_lost", 0.70, 0.80), ("dark_night_of_soul", 0.75, 0.85), ("break_into_three", 0.80, 0.90), ("finale", 0.85, 0.98), ("final_image", 0.95, 1.0),
]
# fixed values: edge types of relations and the confidence floor of each
EDGE_TYPES = {"因果": ("CAUSE", 0.75), "伏笔-回收": ("ENABLE", 0.65)}

# fixed values: key words of traits and their weight
TRAITS = {
    "责任感强": (1.0, ["必须", "责任", "担当", "配平", "保护", "守护"]), "勇敢": (1.0, ["冲", "不怕", "勇往直前", "牺牲", "冲锋"]), "懦弱": (1.0, ["怕", "退缩", "不敢", "逃避", "颤抖"]),
    "机智": (1.0, ["想办法", "灵机", "巧妙", "计策", "反应快"]), "谨慎": (1.0, ["小心", "仔细", "检查", "确认", "稳妥"]), "冲动": (1.0, ["二话不说", "直接", "贸然", "不顾", "急躁"]),
    "忠诚": (1.0, ["服从", "坚守", "不背叛", "信任", "追随"]), "善良": (1.0, ["心疼", "同情", "帮助", "温柔", "关心"]), "残忍": (1.0, ["冷酷", "无情", "残忍", "狠毒", "冷漠"]),
    "幽默": (0.8, ["笑", "调侃", "玩笑", "滑稽", "逗"]), "严肃": (0.8, ["严肃", "凝重", "沉重", "不苟言笑", "认真"]), "敏感": (0.8, ["在意", "多想", "敏感", "细腻", "察觉"]),
    "豁达": (0.8, ["无所谓", "看开", "洒脱", "不在乎", "释然"]), "固执": (0.8, ["坚持", "倔强", "不改", "认定", "顽固"]), "灵活": (0.8, ["随机应变", "变通", "灵活", "调整", "适应"]),
    "自信": (0.9, ["肯定", "确信", "自信", "胸有成竹", "没问题"]), "自卑": (0.9, ["不如", "差", "不行", "没用", "自卑"]), "冷静": (0.9, ["冷静", "镇定", "平静", "不慌", "沉稳"]),
    "焦虑": (0.9, ["焦虑", "紧张", "不安", "心慌", "着急"]), "果断": (0.9, ["果断", "立刻", "马上", "毫不犹豫", "决断"]), "犹豫": (0.9, ["犹豫", "迟疑", "纠结", "徘徊", "拿不定"]),
    "无私": (0.9, ["奉献", "牺牲", "为别人", "不计较", "付出"]), "自私": (0.9, ["只为自己", "自私", "不顾别人", "利己", "贪心"]), "温柔": (0.9, ["温柔", "柔和", "轻声", "温暖", "体贴"]),
    "冷酷": (0.9, ["冷酷", "冰冷", "冷淡", "无情", "刻薄"]), "热情": (0.9, ["热情", "热烈", "积极", "主动", "热心"]), "冷漠": (0.9, ["冷漠", "冷淡", "无所谓", "漠不关心", "疏离"]),
    "理想主义": (0.8, ["理想", "信念", "追求", "梦想", "执着"]), "现实主义": (0.8, ["现实", "实际", "务实", "利益", "权衡"]),
}
# fixed values: words of the five senses
SENSES = {
    "visual": ["看", "望", "瞧", "盯", "瞥", "瞪", "瞄", "注视", "凝视", "环视", "俯视", "仰视", "瞥见", "看清", "看见", "看到", "目光", "眼神", "眼睛", "眼", "视线", "颜色", "色彩", "光",
        "亮", "暗", "黑", "白", "红", "绿", "蓝", "黄", "灰", "金", "银", "紫", "橙", "影", "影子", "阴影", "光辉", "光芒", "闪烁", "闪耀", "耀眼", "刺眼", "模糊", "清晰"],
    "auditory": ["听", "闻", "声响", "声音", "声", "响", "叫", "喊", "吼", "啸", "鸣", "啼", "嚎", "哭", "笑", "叹", "哼", "呢喃", "低语", "耳语", "沉默", "寂静", "安静", "嘈杂",
        "喧闹", "喧哗", "震耳", "刺耳", "悦耳", "动听", "旋律", "节奏", "音调", "音色", "音量", "回声", "回音", "余音", "钟声", "鼓声", "琴声", "风声", "雨声", "雷声", "水声", "脚步声", "敲门声",
        "门响"],
    "tactile": ["摸", "触", "碰", "揉", "捏", "抓", "握", "拍", "打", "抚摸", "触摸", "触感", "粗糙", "光滑", "柔软", "坚硬", "冰冷", "冰凉", "温暖", "温热", "烫", "凉", "冷", "热",
        "暖", "刺痛", "疼痛", "痛", "痒", "麻", "酸", "胀", "沉重", "轻盈", "软", "硬", "湿", "干", "黏", "滑", "涩", "紧绷", "松弛"],
    "olfactory": ["闻", "嗅", "气味", "味道", "香", "臭", "芬芳", "芳香", "清香", "幽香", "醇香", "腥", "膻", "腐", "霉", "酸臭", "刺鼻", "浓郁", "淡雅", "香气", "臭味", "气息", "香味",
        "异味", "花香", "果香", "酒香", "茶香", "药香", "泥土气息", "海风气息"],
    "gustatory": ["尝", "吃", "喝", "咽", "嚼", "咬", "舔", "吞", "味道", "滋味", "口感", "酸", "甜", "苦", "辣", "咸", "涩", "鲜", "淡", "浓", "美味", "难吃", "甘甜", "苦涩", "辛辣",
        "酸甜", "咸鲜", "清淡", "油腻", "清爽", "醇厚", "干涩", "润滑", "酥脆", "软糯", "嚼劲", "回味", "余味"],
}
# fixed values: key words of genres
GENRES = {
    "科幻": ["科幻", "星际", "宇宙", "未来", "科技", "机器人", "AI", "人工智能", "外星", "太空", "文明", "星舰", "量子", "赛博", "末世", "末日", "外星人", "入侵", "能量", "飞船", "空间站", "虚拟", "赛博朋克", "宏原子", "球状闪电", "等离子", "高能物理", "实验装置", "粒子", "超导", "纳米", "基因", "克隆", "时空", "维度", "平行宇宙", "意识上传"],
    "言情": ["爱情", "恋爱", "言情", "情感", "暗恋", "告白", "分手", "婚姻", "暧昧", "痴情", "虐恋", "甜宠", "初恋", "相思", "情侣", "恋人", "表白", "失恋"],
    "悬疑": ["悬疑", "推理", "侦探", "谜团", "真相", "阴谋", "反转", "伏笔", "悬念", "揭秘", "凶案", "破案", "谜题", "线索"],
    "战争": ["战争", "军事", "战斗", "战役", "军队", "武器", "防御", "入侵", "保卫战", "前线", "战场", "士兵", "将军", "轰炸", "抵抗", "炮火", "弹药", "部队", "指挥官"],
    "历史": ["历史", "古代", "朝代", "传记", "回忆录", "年代", "世纪", "王朝", "宫廷", "史诗", "编年", "史料", "考古"],
    "奇幻": ["奇幻", "魔法", "玄幻", "修仙", "精灵", "龙族", "异世界", "巫师", "咒语", "神魔", "妖怪", "剑与魔法", "斗气"],
    "都市": ["都市", "城市", "职场", "生活", "日常", "社会", "白领", "打工", "北漂", "沪漂", "市井", "公寓", "地铁", "写字楼"],
    "成长": ["成长", "青春", "校园", "励志", "蜕变", "觉醒", "自我实现", "追梦", "迷茫", "顿悟", "成熟", "理想", "追求", "灵魂", "自由", "天才", "创作"],
    "现实": ["苦难", "命运", "死亡", "贫穷", "贫苦", "疾病", "饥荒", "家庭", "亲情", "乡土", "土地", "生存", "活着", "平凡", "生活", "离别", "生死", "回忆", "岁月", "劳动", "希望", "绝望", "悲欢", "人性", "时代"],
}


def all_sets() -> dict[str, list[str]]:
    """Every closed set by name."""
    return {k: v for k, v in globals().items() if k.isupper() and isinstance(v, list) and v and isinstance(v[0], str)}
