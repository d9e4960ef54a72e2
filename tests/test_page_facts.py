"""What pages tell, by hand."""

import pytest
from pyspark.sql import functions as F

from rollcall.functions import page_facts as P
from rollcall.functions import similarity


def told(spark, make, *texts):
    """make(html) for each text, in order."""
    df = spark.createDataFrame(list(enumerate(texts)), "id long, h string")
    return [r["out"] for r in df.select("id", make(F.col("h")).alias("out")).orderBy("id").collect()]


def test_headcounts_try_patterns_in_order_and_bounds(spark):
    texts = ["250+ average attendees", "Attendance: 120 and 30 members", "05 attend, members of 45", "a member 7", "80 people call us home", "We have about 1500", "99999 members", "", None]
    # 99999: the last four digits stand before the word
    assert told(spark, P.headcount, *texts) == [250, 120, 45, 0, 80, 1500, 9999, 0, 0]


def test_finances(spark):
    texts = ["Annual Report. Form 990, our budget and financial transparency: budget of $2,500", "raised $900", "goal: $12,000.50 and $3,000 budget", "need $1,000; campaign of $1,001", "", None]
    got = [(list(r["signs"]), r["amount"]) for r in told(spark, P.finances, *texts)]
    assert got == [(["annual report", "form 990", "budget"], 2500), ([], 0), ([], 3000), ([], 1001), ([], 0), ([], 0)]


def test_labels_keep_the_order_of_the_table(spark):
    assert told(spark, P.languages, "한국어 y Español", "latin", None) == [["spanish", "korean"], [], []]
    assert told(spark, P.activities, "VBS and Choir", "") == [["children", "worship_band", "music", "summer_camp"], []]
    assert told(spark, lambda h: P.mentions(h, {"b": ("x", "y"), "a": ("y",)}), "y", "x", "Y") == [["b", "a"], ["b"], []]


def test_affiliations_from_page_text_and_name(spark):
    rows = [("Southern <b>Baptist</b>", "Southern Baptist", "SBC Catholic Hall"), (None, None, "Old Orthodox"), ("ucc", None, None), (None, None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, h string, t string, n string")
    got = [r["a"] for r in df.select("id", P.affiliations(F.col("h"), F.col("t"), F.col("n")).alias("a")).orderBy("id").collect()]
    assert got == [["Southern Baptist", "Catholic (from name)"], ["Orthodox (from name)"], ["Congregational"], []]


def test_clergy_and_times(spark):
    assert told(spark, P.clergy, "Pastor John Smith and Pastor John Smith; Vicar - Eve Stone. Rev. J. Doe", "pastor john smith", None) == [["John Smith", "J. Doe", "Eve Stone"], [], []]
    assert told(spark, P.clergy, " ".join(f"Pastor A{c} Smith." for c in "abcdefg")) == [[f"A{c} Smith" for c in "abcde"]]
    texts = ["9:00 am - 10:15 AM,\n5:00 am, 5:30 am to 6:00 am", "Sundays at 7 pm, Sunday 3 am", "10 am - 11 am", "11:00 AM 11:00 AM", "", None]
    assert told(spark, P.meeting_times, *texts) == [["9:00 am - 10:15 AM", "5:30 am - 6:00 am"], ["7 pm"], [], ["11:00 AM - 11:00 AM"], [], []]


def test_profiles_giving_and_plants(spark):
    html = "<a HREF='https://www.facebook.com/a?b=1'> <img src=\"http://instagram.org/x\"> <a href=\"https://facebook.com/second\">"
    assert [tuple(r) for r in told(spark, P.profiles, html, None)] == [("https://www.facebook.com/a?b=1", "", "http://instagram.org/x"), ("", "", "")]
    assert told(spark, P.online_giving, "We TITHE", "<a href='/x'>", None) == [True, False, False]
    assert told(spark, P.new_plant, "Planting trees", "plant", None) == [True, False, False]


@pytest.mark.parametrize(
    ("name", "url", "title", "score"),
    [("Grace Hall", "", "Grace Hall - Home", 0.9), ("Grace of Hope", "http://gracehope.org", "qqq", 0.4), ("Zion", None, None, 0.0), (None, "http://x", "t", 0.0), ("of", "http://of.org", "", 0.0), ("Bethel", "http://BETHEL.org", None, 0.6)],
)
def test_result_score(spark, name, url, title, score):
    df = spark.createDataFrame([(name, url, title)], "n string, u string, t string")
    assert df.select(similarity.result_score(F.col("n"), F.col("u"), F.col("t"))).first()[0] == score
