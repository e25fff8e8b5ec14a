"""Fixed values.

Word lists, lookup tables, rules and message formats that decide the results.
They are data, not logic: every operator takes them as parameters and only
falls back to these defaults.
"""

from __future__ import annotations


def _words(text: str) -> tuple[str, ...]:
    """Distinct words of a whitespace-separated list, first occurrence first."""
    return tuple(dict.fromkeys(text.split()))


# --- fixed values: stop words -------------------------------------------------

STOPWORDS_ZH = _words("""
    的 了 在 是 我 有 和 就 不 人 都 一 一个 上 也 很 到 说 要 去 你 会 着 没有 看 好 自己 这 他
    她 它 们 那 还 但 被 让 比 等 吧 吗 啊 呢 呀 哦 所以 如果 因为 虽然 但是 然而 而且 之 一些
    这个 那个 什么 怎么 为什么 可以 应该 觉得 感觉 知道 不能 可能 时候 已经 现在 还是 只是 然后
    以为 真的 其实 太 非常 最 更 过 啦 哈 嘛 噢 嗯 哎 哼 呵 嘻嘻 哈哈 无语 哦 噗 呵呵 嘿嘿 咳咳
    嗷 嘤 啊这 卧槽 牛逼 666 点 回复 赞 举报 举报者 来自 网页 链接 http https httpstco 转发
""")

STOPWORDS_EN = _words("""
    a an the and or but if while with without of to in on for from by at as is are was were be
    been being am do does did doing have has had having it its this that these those i you he
    she we they them his her their our my your me him who what when where why how not no so very
    just can could should would will all any some more most many much about into over also than
    then there here out up down video news people
""")

# --- fixed values: segmenter words (tag n, frequency 1000) ----------------------

CUSTOM_WORDS = _words("""
    特朗普 内塔尼亚胡 以色列 伊朗 中东 反战 停火 石油 航母 导弹 消耗战 认怂 无能 正义 自卫 反击
    合法 和平解决 世界和平 不支持
""")
CUSTOM_WORD_TAG = "n"
CUSTOM_WORD_FREQ = 1000

# part-of-speech tags kept by the tokenizer, matched by prefix
KEPT_TAGS = ("n", "v", "a", "ad", "an", "vn", "d", "vd")

# --- fixed values: entity words, vague words, boost words, word-cloud words -----

ENTITY_WORDS = _words("""
    中国 世界 伊朗 以色列 美国 特朗普 拜登 内塔尼亚胡 鱿鱼 导弹 航母 消耗战 中东 全球 石油 军事
    打击 国家 报道 敌人 神棍 生活 全世界 时候 继续 进入 出来 打工 要钱 击 打成 轰炸 攻击 袭击
    战争 局势 视频 评论 感觉 真的 已经 现在 这个 那个 他们 我们 你们 东西 问题 事情 认为 usa us
    america american americans iran iranian iranians israel israeli israelis china chinese
    middle east middleeast trump biden netanyahu government country countries world global
    international war conflict battle fight military army navy airforce missile missiles drone
    drones bomb bombs bombing attack attacks attacked strike strikes news media report reports
    reported video comment comments
""")

BOOST_WORDS = _words("""
    和平 支持 反对 担忧 正义 无能 认怂 加油 胜利 停火 残暴 人道 危机 谴责 霸权 双标 可笑 悲剧
    虚伪 胆敢 侵略 伟大 文明 守护 共赢 站队 置身事外 peace support ceasefire justice hope
    freedom humanitarian victory protect terrorist genocide massacre crime evil hate terrible
    disaster crisis
""")
BOOST_WEIGHT = 1.5
PLAIN_WEIGHT = 1.0

VAGUE_WORDS = _words("""
    没有 应该 可能 知道 还有 不会 需要 估计 看到 觉得 感觉 真的 可以 怎么 什么 为什么 这样 那样
    这个 那个 一些 很多 有点 比较 非常 很 了 还 是 有 说 想 做 去 来 看 让 会 能 要 没 不 都 也
    就 个 着 吗 吧 啊 呢 呀 上 下 人 这 不能 不住 不了 不用 看看 回复 不是 也是 还是 只是 可是
    总是 一样 这么 那么 出来 起来 过来 只能 才能 开始 结束 变成 看着 存在 think thinking thought
    know known see seen look watch say said tell told make made take took go going come coming
    get got give given want wanted need needed like really very maybe probably actually
    basically literally thing things something anything nothing someone everyone anyone people
    time day year years way point case side yes yeah nope ok okay please thanks thank lol lmao
    omg one even never always still back let must right
""")

CLOUD_WORDS = _words("""
    war 战争 conflict 冲突 iran israel usa us america american trump biden netanyahu 中东 军事
    military nuclear news media video comment comments think know see say make get want like
    people time year years one even still really very good right going 视频 评论 感觉 真的 已经
    现在 这个 那个 问题 事情 开始 只能 才能 看着 存在
""")

# share report of the keyword step: comments on peace and against war
STANCE_PHRASES = ("和平", "反对战争", "支持和平", "反战", "停火", "谴责")

# --- fixed values: sentiment lexicons -------------------------------------------

POSITIVE_ZH = _words("""
    支持 赞 和平 正义 加油 胜利 反战 人道 文明 守护 共赢 光明 合理 勇敢 棒 伟大 点赞 好 对 优秀
    美好 共赢 和平解决
""")
NEGATIVE_ZH = _words("""
    反对 谴责 霸权 侵略 屠杀 无能 认怂 愤怒 悲哀 无耻 暴行 邪恶 双标 可笑 荒唐 谴责 垃圾 烂 混蛋
    沙雕 无语 崩溃 绝望 毁灭
""")
NEGATIONS_ZH = ("不", "没", "无", "别")
POSITIVE_EN = _words("""
    peace peaceful support hope safe safety justice good great right brave victory protect
    ceasefire humanitarian freedom solution diplomacy
""")
NEGATIVE_EN = _words("""
    war attack attacks strike strikes bomb bombing killed kill dead death destroy destroyed
    terror terrorist genocide massacre crime evil hate horrible terrible disaster crisis suffer
    suffering civilians refugees children shame
""")

LABEL_POSITIVE = "正面"
LABEL_NEGATIVE = "负面"
LABEL_NEUTRAL = "中性"
POSITIVE_LABELS = ("positive", "正面")
NEGATIVE_LABELS = ("negative", "负面")

# --- fixed values: topic rules, first match wins --------------------------------

TOPIC_RULES = (
    ("和平反战", (
        "和平", "反战", "停火", "谈判", "结束战争",
        "peace", "ceasefire", "anti-war", "stop war", "negotiation",
    )),
    ("战争影响", (
        "影响", "经济", "油价", "生活", "物价", "后果", "危机",
        "economy", "oil", "price", "crisis", "impact", "consequence",
    )),
    ("势力评价", (
        "美国", "以色列", "伊朗", "特朗普", "内塔尼亚胡", "拜登", "政府",
        "america", "usa", "us", "israel", "iran", "trump", "biden", "government",
    )),
    ("中国态度", (
        "中国", "网友", "我们", "自己", "站队", "置身",
        "china", "chinese",
    )),
    ("军事行动", (
        "打击", "空袭", "导弹", "航母", "反击", "防御", "轰炸",
        "attack", "strike", "missile", "bomb", "bombing", "defense", "military",
    )),
    ("人道灾难", (
        "平民", "伤亡", "难民", "儿童", "医院", "人道", "死亡",
        "civilian", "civilians", "casualty", "casualties", "refugee", "refugees",
        "children", "hospital", "humanitarian", "death", "dead",
    )),
    ("媒体舆论", (
        "报道", "媒体", "新闻", "视频", "截图", "真实性",
        "media", "news", "report", "reported", "video", "truth",
    )),
)
TOPIC_OTHER = "其他"

# --- fixed values: columns and platforms ----------------------------------------

COLUMN_ALIASES = {
    "content": ("text", "comment", "body", "message"),
    "timestamp": ("time", "date", "created_at"),
    "user": ("username", "nick", "author"),
    "likes": ("like", "点赞", "fav"),
}
REQUIRED_COLUMNS = ("content", "timestamp")

PLATFORM_NAMES = {
    "bilibili_raw": "bilibili",
    "weibo_raw": "weibo",
    "youtube_comments": "youtube",
    "知乎_posts": "zhihu",
    "zhihu_posts": "zhihu",
}

COMMENT_COLUMNS = (
    "platform", "keyword", "comment_id", "user_name", "content",
    "publish_time", "like_count", "language", "source_url", "crawl_time",
)
VIDEO_COMMENT_COLUMNS = ("video_title", "video_id", "comment")

# --- fixed values: page lines ---------------------------------------------------

UI_LINES = _words("""
    评论 转发 赞 点赞 分享 收藏 登录 发布 写评论 查看更多 展开 收起 快来抢沙发 还没有人评论 热门
    认证用户 关注的人 投诉 回复 全部评论 按热度 按时间 加载中 查看更多评论
""")
UI_PHRASES = _words("""
    微博正文 相关推荐 热门微博 同时转发 查看更多评论 展开更多评论 加载中 暂无评论 登录后查看更多
    客户端下载 微博热搜 广告 举报 转发理由 后面还有 点击查看 条评论 同时转发到我的微博 认证用户
    关注的人 只看博主 相关讨论 打开微博 用微博扫码
""")
UI_WIDGET_PHRASES = ("相关推荐", "弹幕列表", "立即登录", "投稿", "充电")
NOT_NAME_PREFIXES = _words("""
    突发 快讯 消息 报道称 据悉 外媒 央视新闻 环球网 观察者网 人民日报 微博正文 编辑 来源 主持人
""")
NOT_NAME_MARKS = ("，", "。", "！", "？", "；", "、")
LIKE_BUTTON_LINES = ("赞", "点赞", "投诉", "回复", "评论")
TIME_PATTERNS = (
    r"\p{Nd}{2}月\p{Nd}{2}日 +\p{Nd}{2}:\p{Nd}{2}",
    r"\p{Nd}{1,2}月\p{Nd}{1,2}日 +\p{Nd}{1,2}:\p{Nd}{2}",
    r"\p{Nd}{2}-\p{Nd}{1,2}-\p{Nd}{1,2} +\p{Nd}{1,2}:\p{Nd}{2}",
    r"\p{Nd}{4}-\p{Nd}{2}-\p{Nd}{2}",
    r"\p{Nd}+分钟前",
    r"\p{Nd}+小时前",
    r"刚刚",
    r"昨天 +\p{Nd}{1,2}:\p{Nd}{2}",
    r"今天 +\p{Nd}{1,2}:\p{Nd}{2}",
)
FROM_WORD = "来自"

# --- fixed values: relevance of a post ------------------------------------------
# a term listed twice counts twice

COUNTRY_TERMS = (
    "美国", "美军", "以色列", "伊朗", "中东", "巴以", "以军", "德黑兰", "华盛顿", "以色列国防军",
)
CONFLICT_TERMS = (
    "战争", "冲突", "袭击", "空袭", "打击", "轰炸", "导弹", "反击", "军事行动", "开战", "局势", "停火",
    "报复", "防空", "核设施", "爆炸", "袭击",
)
COUNTRY_TERM_WEIGHT = 2
CONFLICT_TERM_WEIGHT = 1
RELEVANT_PAIRS = (("伊朗", "以色列"), ("美国", "伊朗"))
RELEVANT_SCORE = 3

# --- fixed values: limits of one landing run ------------------------------------

MAX_VIDEOS_PER_KEYWORD = 8
MAX_POSTS_PER_KEYWORD = 10
MAX_COMMENTS_PER_ITEM = 200
MAX_COMMENTS_PER_RUN = 1500
MAX_VIDEO_SEARCH_PAGES = 2
MAX_POST_SEARCH_PAGES = 3

# --- fixed values: web addresses ------------------------------------------------

VIDEO_URL_PREFIX = "https://www.bilibili.com/video/"
VIDEO_SEARCH_URL = "https://search.bilibili.com/video"
POST_HOST = "https://weibo.com"
POST_SEARCH_URL = "https://s.weibo.com/weibo"
MOBILE_DETAIL_MARK = "m.weibo.cn/detail/"
MOBILE_DETAIL_PREFIX = "https://m.weibo.cn/detail/"

# --- fixed values: wording of the findings --------------------------------------

SUBJECT = "美以伊战争"
FINDINGS_TITLE = "美以伊战争舆论分析结论"
MOOD_POSITIVE = "总体偏向正面"
MOOD_NEGATIVE = "总体偏向负面"
MOOD_NEUTRAL = "以中性为主"
LEVEL_HIGH = "略高于中性线，整体舆情偏正面"
LEVEL_LOW = "低于中性线，整体舆情偏负面"
LEVEL_MIDDLE = "接近中性线，舆情倾向不明显"
TREND_UP = "呈上升趋势，舆论态度正在改善"
TREND_DOWN = "呈下降趋势，舆论态度趋于负面"
TREND_FLAT = "整体保持平稳，未出现明显波动"
FINDING_FORMATS = {
    "mood": (
        "本次共分析{total}条关于{subject}的评论，其中正面评论占比{positive}%，"
        "负面评论占比{negative}%，中性评论占比{neutral}%。{mood}，"
        "反映出公众对该冲突的态度分布。"
    ),
    "platforms": (
        "在各平台中，{best}平台对{subject}的正面评价占比最高，"
        "而{worst}平台的负面倾向最为明显，"
        "不同平台的用户群体对该冲突的立场存在显著差异。"
    ),
    "level": (
        "全部评论的平均情感得分为{mean}（0-1范围），{level}，"
        "说明网民对{subject}的整体情绪处于该水平。"
    ),
    "trend": (
        "从时间维度来看，{subject}的舆情情感得分{trend}，"
        "覆盖了{days}天的数据周期。"
    ),
    "top_platform": (
        "{platform}是{subject}相关讨论最活跃的平台，"
        "共有{count}条评论，占总量的{share}%，"
        "是该议题舆论发酵的主阵地。"
    ),
    "top_topic": (
        "在{subject}的主题讨论中，【{topic}】是最受关注的主题，"
        "共{count}条评论（占比{share}%），"
        "反映出公众对该议题最为关切。"
    ),
    "closing": (
        "综合以上分析，{subject}的网络舆论呈现出多元化的特征，"
        "不同平台、不同时间段的舆论倾向各有差异。"
        "建议持续关注舆情变化，尤其是关键事件节点对情感走向的冲击。"
    ),
}
