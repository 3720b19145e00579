from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from footfall.functions import clock
from footfall.functions.agents import with_agent
from footfall.functions.keys import row_key, visit_key
from footfall.functions.net import ip_number
from footfall.plans.derived import USER_AGENTS


@pytest.mark.parametrize("parts", [("a", "b"), ("", ""), ("é", "日本"), (None, "x"), (None, None)])
def test_row_key_is_the_unsigned_crc_of_the_joined_parts(spark, parts):
    rows = spark.createDataFrame([("20190130", *parts)], "day string, a string, b string")
    key = rows.select(row_key(F.col("day"), F.col("a"), F.col("b"))).first()[0]
    text = "".join("null" if p is None else p for p in parts)
    assert key == f"20190130_{zlib.crc32(text.encode())}"


def test_sha2_key(spark):
    rows = spark.createDataFrame([("a", "b")], "a string, b string")
    key = rows.select(row_key(F.lit("d"), F.col("a"), F.col("b"), digest="sha2")).first()[0]
    assert key == "d_" + hashlib.sha256(b"ab").hexdigest()
    with pytest.raises(ValueError):
        row_key(F.lit("d"), F.col("a"), digest="md5")


def test_visit_key_order(spark):
    rows = spark.createDataFrame([("R", "U", "I", "A")], "referer string, url string, ip string, ua string")
    assert rows.select(visit_key(F.lit("d"))).first()[0] == f"d_{zlib.crc32(b'RUIA')}"


@pytest.mark.parametrize(
    "text, number",
    [
        ("0.0.0.0", 0), ("255.255.255.255", 2**32 - 1), ("10.1.2.3", 0x0A010203), ("256.1.1.1", None), ("1.2.3", None),
        ("1.2.3.4.5", None), ("::1", None), ("", None), (None, None), ("a.b.c.d", None), ("1..2.3", None), ("-1.2.3.4", None),
    ],
)
def test_ip_number(spark, text, number):
    assert spark.createDataFrame([(text,)], "ip string").select(ip_number("ip")).first()[0] == number


WIN = "Mozilla/5.0 (Windows NT 10.0; Win64; x64)"
AGENTS = {
    USER_AGENTS[0]: ("Sogou Explorer", "2.X", "Windows", "10.0"),
    USER_AGENTS[1]: ("Chrome", "120.0.6099.71", "Mac OS X", "10_15_7"),
    USER_AGENTS[2]: ("swcd", "unknown", "Darwin", "21.4.0"),
    USER_AGENTS[3]: ("Crawler", "2.1", "unknown", "unknown"),
    USER_AGENTS[4]: ("Go-http-client", "2.0", "unknown", "unknown"),
    "Sogou web spider/4.0(+http://www.example.com)": ("Sogou web spider", "4.0", "unknown", "unknown"),
    f"{WIN} AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Safari/537.36 Edg/120.0.2210.91":
        ("Edge", "120.0.2210.91", "Windows", "10.0"),
    f"{WIN} AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Safari/537.36 OPR/106.0.0.0":
        ("Opera", "106.0.0.0", "Windows", "10.0"),
    f"{WIN} Gecko/20100101 Firefox/121.0": ("Firefox", "121.0", "Windows", "10.0"),
    "Mozilla/5.0 (Windows NT 6.1; WOW64; Trident/7.0; rv:11.0) like Gecko":
        ("Internet Explorer", "11.0", "Windows", "6.1"),
    "Mozilla/4.0 (compatible; MSIE 8.0; Windows NT 5.1)": ("Internet Explorer", "8.0", "Windows", "5.1"),
    "Mozilla/5.0 (iPhone; CPU iPhone OS 16_5 like Mac OS X) AppleWebKit/605.1.15 Version/12.0 Mobile/15E148 Safari/604.1":
        ("Safari", "12.0", "iOS", "16_5"),
    "Mozilla/5.0 (iPad; CPU OS 13_3 like Mac OS X) AppleWebKit/605.1.15 Version/13.0 Mobile/15E148 Safari/604.1":
        ("Safari", "13.0", "iOS", "13_3"),
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_14_3) AppleWebKit/605.1.15 Version/12.0.3 Safari/605.1.15":
        ("Safari", "12.0.3", "Mac OS X", "10_14_3"),
    "Mozilla/5.0 (Linux; Android 11; V1) AppleWebKit/537.36 Chrome/66.0.3359.126 Mobile Safari/537.36 MicroMessenger/7.0.3":
        ("WeChat", "7.0.3", "Android", "11"),
    "Mozilla/5.0 (compatible; Googlebot/2.1; +http://www.google.com/bot.html)": ("Googlebot", "2.1", "unknown", "unknown"),
    "Mozilla/5.0 (X11; Linux x86_64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/72.0.3626.81 Safari/537.36":
        ("Chrome", "72.0.3626.81", "Linux", "x86_64"),
    "SomeBot/9": ("Crawler", "9", "unknown", "unknown"),
    "App/1 CFNetwork/974.2.1 Darwin/18.0.0": ("CFNetwork", "974.2.1", "Darwin", "18.0.0"),
    "-": ("unknown",) * 4,
    "": ("unknown",) * 4,
    None: ("unknown",) * 4,
}


def test_agents(spark):
    rows = with_agent(spark.createDataFrame([(ua,) for ua in AGENTS], "ua string"))
    found = {r.ua: (r.browsername, r.browserversion, r.osname, r.osversion) for r in rows.collect()}
    assert found == AGENTS


def test_minutes_of_the_calendar(spark):
    """Against the formatter that reads timestamps, over all days of months and years of every kind."""
    texts = [f"{y}{m:02}{d:02}{rest}" for y in ("0000", "1900", "2000", "2023", "2024", "2100", "9999") for m in range(14) for d in range(33) for rest in ("0000", "2359")]
    texts += [f"20240229{h:02}{m:02}59" for h in (0, 9, 23, 24, 99) for m in (0, 59, 60, 99)]
    texts += ["2024022900", "20240229000", " 20240229000", "+20240229000", "2024022900.0", "٢٠٢٤٠٢٢٩٠٠٠٠", "", "x", None, "202402290000tail"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    head = F.substring("t", 1, 12)
    digits = (F.length(head) == 12) & (F.translate(head, "0123456789", "") == "")
    at = F.try_to_timestamp(F.concat(head, F.lit("+0000")), F.lit("yyyyMMddHHmmZ"))
    read = F.coalesce(digits & at.isNotNull(), F.lit(False))
    for row in rows.select("t", clock.is_minute(F.col("t")).alias("a"), read.alias("b")).collect():
        assert row.a == row.b, row.t
