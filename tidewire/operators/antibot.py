"""Classification of pages by signs of anti-bot measures; confidences are whole tenths."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values: (patterns, tenths for each), and the confidence to exceed.
DETECTORS = {
    "captcha": (5, ((3, ("captcha", "验证码", "recaptcha", "hcaptcha", "geetest", "slider.*verify", "puzzle.*verify")), (4, ("<img[^>]*captcha", "<canvas[^>]*captcha", "<div[^>]*captcha", "data-sitekey", "g-recaptcha")))),
    "js_challenge": (5, ((3, ("challenge.*js", "anti.*bot", "protection.*mode", "cloudflare", "ddos.*guard", "bot.*detection")), (2, (r"eval\s*\(", r"document\.write\s*\(", "setTimeout.*location", "challenge.*solve", "anti.*automation")))),
    "rate_limit": (5, ((4, ("rate.*limit", "too.*many.*requests", "请求过于频繁", "访问频率", "429")),)),
    "ip_block": (5, ((3, ("ip.*block", "access.*denied", "forbidden", "banned", "blocked", "ip.*禁止", "访问被拒绝")),)),
    "user_agent_check": (5, ((4, ("user.*agent.*invalid", "browser.*not.*supported", "please.*update.*browser", "浏览器不支持", "请更新浏览器")),)),
    "cookie_check": (5, ((4, ("enable.*cookie", "cookie.*disabled", "please.*enable.*cookie", "需要启用cookie", "请启用cookie")),)),
    "referer_check": (5, ((4, ("invalid.*referer", "referer.*required", "direct.*access.*not.*allowed", "非法来源", "需要来源页面")),)),
    "fingerprint": (4, ((2, ("fingerprint", "canvas.*fingerprint", "webgl.*fingerprint", "audio.*fingerprint", r"screen\.width", r"navigator\.platform", r"navigator\.plugins")),)),
    "honeypot": (3, ((3, (r"<a[^>]*style[^>]*display\s*:\s*none", r"<a[^>]*style[^>]*visibility\s*:\s*hidden", "<a[^>]*class[^>]*hidden")),)),
    "behavior_analysis": (3, ((2, ("mouse.*track", "click.*track", "scroll.*track", "behavior.*analysis", "user.*behavior", "interaction.*track")),)),
}
STATUS_TENTHS = {429: 8, 412: 7, 502: 3, 503: 3, 504: 3}
BLOCK_STATUS_TENTHS = {403: 4, 451: 4}


ACTIONS = {
    "captcha": "captcha_recognition", "js_challenge": "use_selenium", "rate_limit": "delay_request", "ip_block": "change_proxy", "user_agent_check": "update_user_agent",
    "cookie_check": "enable_cookies", "referer_check": "set_referer", "fingerprint": "randomize_fingerprint", "honeypot": "avoid_honeypot", "behavior_analysis": "simulate_human_behavior",
}
SUGGESTIONS = ("网站有多重反爬虫机制，建议使用综合解决方案", "建议使用Selenium + 验证码识别服务", "建议使用代理池 + 请求频率控制")


def found(low: Column, pattern: str) -> Column:
    """Whether a pattern (case aside) stands in lower-cased text; first, cheaply, whether its longest literal does. A dot stands for all but a line feed."""
    literal = max(re.split(r"\[\^>\]\*|\.\*|\\s\*|\\[.(]", pattern.lower()), key=len)
    holds = F.contains(low, F.lit(literal))
    return holds if literal == pattern.lower() else holds & low.rlike(f"(?id){pattern}")


def confidence(name: str, low: Column, status: Column, set_cookie: Column, retry_after: Column, url: Column) -> Column:
    """Tenths, at most 10, from the lower-cased body, the status and headers (null: absent)."""
    total = F.lit(0)
    for tenths, patterns in DETECTORS[name][1]:
        for p in patterns:
            total = total + F.when(found(low, p), tenths).otherwise(0)
    for code, tenths in {"rate_limit": STATUS_TENTHS, "ip_block": BLOCK_STATUS_TENTHS}.get(name, {}).items():
        total = total + F.when(status == code, tenths).otherwise(0)
    if name == "js_challenge":
        total = total + F.when((F.length(low) < 1000) & (F.regexp_count(low, F.lit("<script")) > 3), 4).otherwise(0)
    if name == "user_agent_check":
        total = total + F.when(F.contains(low, F.lit("upgrade")) & F.contains(low, F.lit("browser")), 3).otherwise(0)
    if name == "cookie_check":
        total = total + F.when(F.contains(F.lower(set_cookie), F.lit("test")), 3).otherwise(0)
    if name == "rate_limit":
        total = total + F.when(retry_after != "", 5).otherwise(0)
    if name == "honeypot":
        total = total + F.when(F.contains(url, F.lit("robots.txt")) & F.contains(low, F.lit("disallow")), 2).otherwise(0)
    return F.least(total, F.lit(10))


def detect(pages: DataFrame, body: str = "html", status: str = "status", set_cookie: str = "set_cookie", retry_after: str = "retry_after", url: str = "url") -> DataFrame:
    """A column of tenths for each detector, and the names of those over their threshold, in the order of the table."""
    text = pages.withColumn("__low", F.lower(F.coalesce(F.col(body), F.lit(""))))
    out = text.withColumns({n: confidence(n, F.col("__low"), F.col(status), F.col(set_cookie), F.col(retry_after), F.col(url)) for n in DETECTORS}).drop("__low")
    return out.withColumn("detected", F.array_compact(F.array(*[F.when(F.col(n) > least, F.lit(n)) for n, (least, _) in DETECTORS.items()])))


def actions(detected: Column) -> Column:
    """What to do against each detected measure, in order."""
    table = F.create_map(*[F.lit(x) for pair in ACTIONS.items() for x in pair])
    return F.transform(detected, lambda d: table[d])


def suggestions(detected: Column) -> Column:
    """Advice for combined measures."""
    both = lambda a, b: F.array_contains(detected, a) & F.array_contains(detected, b)
    return F.array_compact(F.array(F.when(F.size(detected) > 3, SUGGESTIONS[0]), F.when(both("captcha", "js_challenge"), SUGGESTIONS[1]), F.when(both("rate_limit", "ip_block"), SUGGESTIONS[2])))
