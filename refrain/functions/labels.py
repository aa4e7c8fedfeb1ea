"""The labels that appear in results. They must be spelled exactly like this."""

# Rank trend.
TREND_UP = "↑上升"
TREND_DOWN = "↓下降"
TREND_FLAT = "→持平"

# Recency / frequency / monetary segments.
SEGMENT_HIGH_VALUE = "高价值用户"
SEGMENT_NEW = "新用户"
SEGMENT_AT_RISK = "老客流失风险"
SEGMENT_SILENT = "沉默用户"
SEGMENT_GROWING = "成长用户"

# The four labels of the clustered segments, best first.
RFM_CLUSTERS = ["高价值用户", "成长用户", "沉默用户", "流失风险用户"]

# User types, most active first.
USER_TYPES = ["核心粉丝", "内容消费者", "轻度用户"]

# Weekly growth.
GROWTH_FASTER = "加速增长"
GROWTH_SLOWER = "增长放缓"
GROWTH_STEADY = "平稳"

# Funnel rows and their direction marks.
FUNNEL_LEVELS = ["Level1-发表评论", "Level2-获得点赞", "Level3-高赞(≥10)", "Level4-爆款(≥100赞)", "附-优质长评获赞"]
FUNNEL_DOWN = "↓"
FUNNEL_SIDE = "-"

# Periods of the day, days of the week from Monday, seasons.
DAY_PERIODS = ["凌晨", "上午", "下午", "晚上"]
WEEKDAYS = ["周一", "周二", "周三", "周四", "周五", "周六", "周日"]
SEASONS = ["春", "夏", "秋", "冬"]

# Hours by traffic.
PEAK_HIGH = "高峰"
PEAK_LOW = "低谷"
PEAK_NORMAL = "平峰"

# Lifecycle stages.
STAGE_GROWTH = "增长期"
STAGE_BURST = "爆发期"
STAGE_STABLE = "稳定期"
STAGE_DECLINE = "衰退期"

# Churn risk levels from low to high.
RISK_LEVELS = ["低", "中", "高"]

# Sentiment classes and the types of users by their mean sentiment.
POSITIVE = "positive"
NEUTRAL = "neutral"
NEGATIVE = "negative"
USER_POSITIVE = "积极型"
USER_NEUTRAL = "中性型"
USER_NEGATIVE = "消极型"

# Significance.
SIGNIFICANT = "显著"
NOT_SIGNIFICANT = "不显著"

# Fixed value: prefix of topic names.
TOPIC_PREFIX = "主题"

# Display names of the models.
MODEL_NAMES = {
    "XGBoost": "XGBoost 梯度提升",
    "LogisticRegression": "逻辑回归",
}

# Display names of the other models of this library.
MODEL_NAMES |= {"GradientBoosting": "梯度提升", "RandomForest": "随机森林"}

# Display names of the item features.
FEATURE_NAMES = {
    "total_comment_count": "歌曲累计评论数",
    "total_reply_count": "歌曲累计回复数",
    "total_like_total": "歌曲累计获赞数",
    "valid_comment_count": "有效评论数",
    "negative_ratio": "负面情感占比",
    "positive_ratio": "正面情感占比",
    "avg_heat_score": "平均热度分",
    "max_heat_score": "最高热度分",
    "days_since_release": "发行距今天数",
    "release_year": "发行年份",
    "artist_comment_count": "歌手累计评论数",
    "artist_reply_count": "歌手累计回复数",
    "artist_like_total": "歌手累计获赞数",
    "release_month": "发行月份",
    "topic_count": "主题覆盖数",
    "like_per_comment": "每条评论平均获赞",
    "reply_per_comment": "每条评论平均回复",
}
