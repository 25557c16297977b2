import datetime as dt

from broadsheet.functions import dates


def test_calendar_date_keeps_own_offset(values):
    texts = [
        "2026-01-13", "2026-01-13T23:30:00-05:00", "Tue, 13 Jan 2026 23:00:00 -0800",
        "January 5, 2026", "5 January 2026", "2026/1/7", "nothing", "2026-13-40", None,
    ]
    day = dt.date
    assert values(dates.calendar_date, texts) == [
        day(2026, 1, 13), day(2026, 1, 13), day(2026, 1, 13), day(2026, 1, 5), day(2026, 1, 5),
        day(2026, 1, 7), None, None, None,
    ]


def test_archived_ts_and_date(values):
    texts = ["2026-01-13", "2026-01-13T23:30:00-05:00", "2026-01-13T10:00:00Z",
             "Tue, 13 Jan 2026 10:00:00 GMT"]
    stamps = values(lambda c: dates.archived_ts(c).cast("string"), texts)
    assert stamps == ["2026-01-13 00:00:00", "2026-01-14 04:30:00", "2026-01-13 10:00:00",
                      "2026-01-13 10:00:00"]
    assert set(values(dates.archived_date, texts)) == {dt.date(2026, 1, 13)}


def test_other_layouts_of_a_day(values):
    texts = ["Jan 5 2026", "January 5 2026", "5-Jan-2026", "5.1.2026", "2026.1.5", "1/5/2026", "Jan 5, 2026"]
    assert set(values(dates.archived_date, texts)) == {dt.date(2026, 1, 5)}
    stamps = values(lambda c: dates.archived_ts(c).cast("string"), texts)
    assert set(stamps) == {"2026-01-05 00:00:00"}


def test_normalize_date_falls_back_to_text(values):
    texts = [" 2026-01-15T08:00:00Z ", "soon", "  ", None]
    assert values(dates.normalize_date, texts) == ["2026-01-15", "soon", None, None]


def test_epoch(values):
    texts = ["0", "1700000000", "x", None, "999999999999999"]
    assert values(dates.epoch_to_iso, texts) == [
        "1970-01-01T00:00:00+00:00", "2023-11-14T22:13:20+00:00", None, None, None,
    ]
