import random
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from dugoutline.functions import timestamps as T

UTC = timezone.utc
ZONES = ("Asia/Tokyo", "America/New_York", "America/Los_Angeles", "Australia/Sydney", "Europe/London", "Asia/Kolkata")


def instant(text, zone=None, offset=None):
    e = T.to_epoch([text], [zone], [offset])[0]
    return None if e == T.UNREADABLE else datetime.fromtimestamp(int(e), UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


@pytest.mark.parametrize(
    ("text", "zone", "offset", "utc"),
    [
        ("2024-02-12T09:41:04+09:00", None, None, "2024-02-12T00:41:04Z"), ("1763147760", None, None, "2025-11-14T19:16:00Z"), ("1761999336209", "Asia/Tokyo", None, "2025-11-01T12:15:36Z"),
        ("2025年10月7日 27:53", None, None, "2025-10-07T18:53:00Z"), ("令和8年2月16日 午後7時53分", None, None, "2026-02-16T10:53:00Z"), ("令和元年5月1日", None, None, "2019-04-30T15:00:00Z"),
        ("[ 2026年7月27日 21:25 ]", None, None, "2026-07-27T12:25:00Z"), ("更新:2025年7月14日 22:51", None, None, "2025-07-14T13:51:00Z"), ("2/17/2025 01:05", "America/New_York", None, "2025-02-17T06:05:00Z"),
        ("Nov 2, 2025 1:39 AM", "America/New_York", "-05:00", "2025-11-02T06:39:00Z"), ("Nov 2, 2025 1:39 AM", "America/New_York", None, "2025-11-02T05:39:00Z"), ("Mar 9, 2025 2:50 AM", "America/New_York", None, "2025-03-09T07:50:00Z"),
        ("2024-11-02 01:49 EDT", "Asia/Tokyo", None, "2024-11-02T05:49:00Z"), ("2026/06/28 06:57 (UTC+09:00)", "America/New_York", None, "2026-06-27T21:57:00Z"), ("Sun Mar 10 16:46:42 2024", None, None, "2024-03-10T07:46:42Z"),
        ("20240809T144048-0330", None, None, "2024-08-09T18:10:48Z"), ("２０２４年１０月８日 ０１:５１", None, None, "2024-10-07T16:51:00Z"), ("25 September 2026", "Australia/Sydney", None, "2026-09-24T14:00:00Z"),
        ("2024年9月19日午後0時34分", None, None, "2024-09-19T03:34:00Z"), ("2024-07-31T14:28:29.999", "Nowhere/Else", None, "2024-07-31T05:28:29Z"), ("20261001", None, None, "2026-09-30T15:00:00Z"), ("2024.4.7 12:51", None, None, "2024-04-07T03:51:00Z"),
    ],
)
def test_notations(text, zone, offset, utc):
    assert instant(text, zone, offset) == utc
    assert instant(f" {text}\n", zone, offset) == utc


@pytest.mark.parametrize("text", [None, "", " ", "-", "n/a", "date", "昨日", "調整中", "0000-00-00", "2025-02-30", "13/45/2024", "2024-01-01 25", "2024-01-01 10:61", "Foo 3, 2024", "2024-01-01 10:00 QQQ", "9" * 200])
def test_unreadable(text):
    assert instant(text) is None


def test_zone_tables_against_zoneinfo():
    r = random.Random(4)
    for key in ZONES:
        table, zone = T.zone_table(key, "test"), ZoneInfo(key)
        for _ in range(400):
            local = datetime(1990, 1, 1) + timedelta(minutes=r.randrange(60 * 24 * 365 * 45))
            want = int(local.replace(tzinfo=zone).timestamp())
            seconds = int(local.replace(tzinfo=UTC).timestamp())
            import numpy as np

            assert int(table.to_utc(np.array([seconds]), np.array([10**9]))[0]) == want, (key, local)


def test_articles(spark):
    rows = [("a", "2025-01-01 00:00", '{"date": "n/a", "tz": "America/New_York"}', 1), ("b", "x", '{"date": 1763147760}', 1), ("c", "2025-01-01", "no json", 1), ("d", None, None, 1), ("e", "-", '{"date": "2025-03-01", "tz": null}', 1), ("b", "x", '{"date": 1763147760}', 1)]
    df = spark.createDataFrame(rows, "id string, published_at string, raw string, at int")
    got = sorted((r.article_id, r.published_utc) for r in T.article_instants(df).collect())
    assert got == [("a", "2025-01-01T05:00:00Z"), ("b", "2025-11-14T19:16:00Z"), ("b", "2025-11-14T19:16:00Z"), ("c", "2024-12-31T15:00:00Z"), ("e", "2025-02-28T15:00:00Z")]
    assert T.article_instants(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("text", "utc"),
    [
        ("2025-01-01 10:00 Europe/Berlin", "2025-01-01T09:00:00Z"), ("2025-01-01 10:00 America/New_York", "2025-01-01T15:00:00Z"), ("2025-01-01 10:00 America/Argentina/Buenos_Aires", "2025-01-01T13:00:00Z"), ("2025-01-01 10:00 +09", "2025-01-01T01:00:00Z"),
        ("2025-01-01T10:00:00−05:00", "2025-01-01T15:00:00Z"), ("2025-01-01 10:00 (utc+9)", "2025-01-01T01:00:00Z"), ("2025-01-01" + " " * 300 + "10:00 JST", "2025-01-01T01:00:00Z"), ("x" * 5000, None), ("2025-01-01 10:00 Nowhere/Else", None),
    ],
)
def test_zones_and_long_texts(text, utc):
    assert instant(text) == utc


def test_order_of_letter_cases_does_not_matter():
    texts = ["2025-01-01t10:00:00+09:00", "2025-01-01T10:00:00+09:00", "2025-13-01T10:00:00+09:00", "2025-01-01 10:00 XX/Y", "2025-01-01T10:00:00+09:00", "r7年1月1日 10:00", "R7年1月1日 10:00", "H7年1月1日 10:00"]
    want = [1735693200, 1735693200, T.UNREADABLE, T.UNREADABLE, 1735693200, 1735693200, 1735693200, 788922000]
    for order in (list(range(len(texts))), list(reversed(range(len(texts))))):
        T._PARSERS.clear()
        got = T.to_epoch([texts[i] for i in order], [None] * len(texts), [None] * len(texts))
        assert [int(x) for x in got] == [want[i] for i in order]


def test_one_mask_may_need_two_parsers(monkeypatch):
    monkeypatch.setattr(T, "mask", lambda t: "one")
    got = T.to_epoch(["junk", "2025-01-01 10:00", "also junk", "1763147760", "2025年1月1日"], [None] * 5, [None] * 5)
    assert [int(x) for x in got] == [T.UNREADABLE, 1735693200, T.UNREADABLE, 1763147760, 1735657200]
    assert T.database_version()
