"""Routing rules: which element contents an event must carry, and the code it gets."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Rule(NamedTuple):
    events: tuple[str, ...]  # empty: any event name
    codes: dict[str, str]  # element content -> code

    def event_match(self, event: Column) -> Column:
        return event.isin(*self.events) if self.events else F.lit(True)

    def match(self, event: Column, content: Column) -> Column:
        return self.event_match(event) & content.isin(*self.codes)

    def code(self, content: Column) -> Column:
        """Code of a content; NULL where the rule has none."""
        pairs = [F.lit(x) for item in self.codes.items() for x in item]
        return F.try_element_at(F.create_map(*pairs), content)


# Event names, element contents and codes of the tracked app.
PAGE_VISIT = Rule(
    ("LiveVisit", "NativeAppVisit", "NativeAppLeave", "NativeAppClick"),
    {
        "直播大厅_精彩回放_精彩回放列表": "enter_video",
        "发现_视频直播_常态视频区域": "enter_video",
        "首页_大家都在看_查看详情": "enter_video",
        "资讯_视频_大家都在看_视频": "enter_video",
        "资讯_点击视频tab": "enter_video",
        "首页_视频直播_内容模块": "enter_video",
        "快讯详情页访问": "globalnews",
        "视频页面离开_播放时长": "leave_video",
        "个股_个股详情页访问": "symbol",
    },
)
LIVE_VISIT = Rule(
    PAGE_VISIT.events,
    {"视频直播页访问": "enter_live", "视频直播播放": "on_video"},
)
DENIED_PARAMS = ("直播中", "直播", "视频直播")

TD_DETAIL = Rule(
    ("TDGZHVisit", "TDGZHClick", "TDVisit", "TDClick"),
    {
        "金股天下_菜单栏点击": "menu",
        "金股天下_推送点击": "push",
        "金股天下_文章点击": "artiClick",
        "金股天下_文章列表访问": "artiList",
        "金股天下_文章访问": "artiVisit",
    },
)
ARTICLE_READ = Rule(TD_DETAIL.events, {"金股天下_文章访问": "read"})

CONTENT_PLAY = Rule(
    ("NativeAppVisit",),
    {"视频_播放页面访问": "vedio", "动态详情页访问": "dynamic"},
)
SHARE = Rule(
    ("NativeAppClick", "H5Click"),
    {
        "观点详情页_页中分享按钮": "view_share",
        "观点详情页_底部栏_分享按钮": "view_share",
        "动态详情页_底部栏_分享按钮": "dynamic_share",
        "视频播放页面_分享按钮": "video_share",
        "视频播放详情页_分享按钮": "video_share",
    },
)
PUSH_OPEN = Rule(("LCSAppStart",), {"推送启动app": "push_open"})
MISSING_IDS = ("", "0", "(null)")

COURSE_BEHAVIOUR = Rule(
    ("CSH5Visit", "CSH5Click"),
    {
        content: "behaviour"
        for content in (
            "学籍注册页访问",
            "学籍注册页_学号页访问",
            "问卷填写页访问",
            "问卷完成页访问",
            "课程详情页访问",
            "课程内容页访问",
            "推广营销页访问",
            "课程详情页_购买",
            "课程详情页_章节",
            "课程详情页_tab",
            "视频直播_弹幕",
            "视频直播_点赞",
            "视频直播_悬浮广告",
        )
    },
)
COURSE_OPTION = Rule(
    COURSE_BEHAVIOUR.events,
    {"课程详情页访问": "option", "课程详情页_购买": "option"},
)
COURSE_WATCH = Rule(("CSH5Visit",), {"财商_课程_直播": "live", "财商_课程_回看": "play"})

ANSWER_CLICK = Rule(
    COURSE_BEHAVIOUR.events,
    {
        content: "click"
        for content in (
            "财商_题目解答页_选项点击",
            "财商_题目解答页_提交点击",
            "财商_题目解答页_回看课程点击",
            "财商_评分结果页_错题解析",
            "财商_评分结果页_全部解析",
            "财商_评分结果页_学习其他课程",
            "财商_评分结果页_我要打卡",
            "财商_评分结果页_重新答题",
        )
    },
)
ANSWER_PAGE = Rule(
    COURSE_BEHAVIOUR.events,
    {
        "财商_题目解答页访问": "enter_answer_page",
        "财商_评分结果页访问": "enter_score_page",
        "财商_图片打卡页访问": "enter_course_sign_page",
    },
)

COVER_ARTICLE = {
    "启见保_文章访问": "view_article",
    "启见保_视频页面往期点击": "video_past_click",
    "启见保_视频页面访问": "video_visit",
}
COVER_PLAN = {
    "展业助手_计划书详情页访问": "planbook_visit",
    "展业助手_计划书详情页_点击投保": "planbook_click",
    "视频直播H5访问": "live_h5_visit",
}
COVER_ASSESS = {"启见保_保障测评页面访问": "se_visit"}
COVER_CAMPAIGN = {
    "启见保_推广/营销活动页领取": "shanzhen_receive",
    "启见保_推广/营销活动页访问": "shanzhen_visit",
}
COVER_ACTIVITY_TYPE = "启见保_营销活动"
COVER_ACTIVITY = {"BXVisit": "activity_visit", "BXClick": "activity_click"}
COVER_PUSH_EVENT = "BXVisit"

LIVE_PLAY = ("LiveVisit", "视频直播播放")
IGNORED_EVENT = "NativeAppQuotLog"

# Label rules in order of precedence (flag, event, content, adviser must be listed).
LABEL_RULES = [
    ("is_visit_contractvarieties", "NativeAppVisit", "TD合约详情页", False),
    ("is_visit_marketprice", "NativeAppClick", "行情_T+D", False),
    ("is_visit_account", "H5Visit", "TD开户页", False),
    ("is_visit_lcspage", "NativeAppVisit", "理财师主页访问", True),
    ("is_visit_tdlive", "LiveVisit", "视频直播播放", True),
    ("is_visit_tdinformation", "NativeAppVisit", "新闻详情页访问", False),
]
# A flag is set above this count (others: above 0).
LABEL_THRESHOLDS = {"is_visit_tdlive": 3}
LABEL_FLAGS = [rule[0] for rule in LABEL_RULES]
