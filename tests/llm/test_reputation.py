"""URL rules and host reputations."""

import pytest

from pyspark.sql import functions as F

from issuescope.llm.reputation import host_levels, host_name, host_reputations, judge_pages

LABELS = "doc_id long, quality int, toxic int"


def pages(spark, urls):
    rows = [(i, u, "x", "h") for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")


def judged(spark, urls, labels=()):
    got = judge_pages(pages(spark, urls), spark.createDataFrame(list(labels), LABELS))
    return [tuple(r)[1:5] for r in sorted(got.collect(), key=lambda r: r.page_id)]


def test_parts_and_rules(spark):
    urls = [
        "http://Example.COM/en/x?y#z", "https://www.example.com/en/", "https://a.www.example.com/en/q", "http://notexample.com/en/",
        "http://example.com", "http://a.net/es/1", "http://net/fr/", "http://a.net/ES/1", "http://a.net/es", None, "no scheme", "",
        "ftp://h?q=://x/y", "://only/path", "http://a.org/p://q/r", "http://user@a.com:80/x", "http://b.net/fr/1\n2", "mailto:x",
    ]
    assert judged(spark, urls) == [
        ("example.com", "/en/x", "example.com/en/", "block"),
        ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("a.www.example.com", "/en/q", "www.example.com/en/", "allow"),
        ("notexample.com", "/en/", "com/", "allow"),
        ("example.com", "", None, "allow"),
        ("a.net", "/es/1", "net/es/", "block"),
        ("net", "/fr/", "net/fr/", "block"),
        ("a.net", "/ES/1", None, "allow"),
        ("a.net", "/es", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("h", "", None, "allow"),
        ("only", "/path", None, "allow"),
        ("a.org", "/p://q/r", None, "allow"),
        ("user@a.com:80", "/x", None, "allow"),
        ("b.net", "/fr/1\n2", "net/fr/", "block"),
        ("", "", None, "allow"),
    ]


def test_bad_hosts_are_blocked_and_unknown_ones_take_their_domains_reputation(spark):
    urls = [f"http://bad.spam.org/{i}" for i in range(60)] + [f"http://good.fine.org/{100 + i}" for i in range(60)]
    urls += ["http://new.spam.org/x", "http://new.fine.org/x", "http://new.other.org/x", "http://x.io/y"]
    labels = [(i, 0, 1) for i in range(60)] + [(100 + i, 1, 0) for i in range(60)] + [(None, 0, 1), (100, None, 1)]
    verdicts = [r[3] for r in judged(spark, urls, labels)]
    assert verdicts[:60] == ["block"] * 60
    assert verdicts[60:] == ["allow"] * 60 + ["block", "allow", "allow", "allow"]


def test_few_outcomes_shrink_to_the_level_above(spark):
    outcomes = [("a.x.org", 1)] * 50 + [("b.x.org", 1)] * 50 + [("c.x.org", 0)]
    got = host_reputations(spark.createDataFrame(outcomes, "host string, good int")).collect()
    mean = {(r.level, r.name): r.a / (r.a + r.b) for r in got}
    assert mean["host", "c.x.org"] > 0.2  # one bad page of one is not 0
    assert mean["host", "c.x.org"] < mean["domain", "x.org"] < mean["host", "a.x.org"]


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)]])
def test_empty_tables(spark, labels):
    assert judged(spark, [], labels) == []
    assert judged(spark, ["http://a.org/1"], labels)[0][3] == "allow"


def test_names_ports_addresses_and_suffixes(spark):
    hosts = [
        "a.b.com:8080", "u:p@x.co.uk.", "10.0.0.1", "10.0.0.1:80", "[::1]:80", "[::ffff:1.2.3.4]", "localhost", "co.uk", "1.2.3",
        "a.k.kobe.jp",
    ]
    df = spark.createDataFrame([(h,) for h in hosts], "host string").select(host_name(F.col("host")).alias("h"))

    def levels(**more):
        return [tuple(r) for r in df.select("h", *host_levels(F.col("h"), **more)).collect()]

    assert levels() == [
        ("a.b.com", "b.com", "com"), ("x.co.uk", "x.co.uk", "co.uk"), ("10.0.0.1",) * 3, ("10.0.0.1",) * 3, ("[::1]",) * 3,
        ("[::ffff:1.2.3.4]",) * 3, ("localhost",) * 3, ("co.uk", "co.uk", "co.uk"), ("1.2.3", "2.3", "3"),
        ("a.k.kobe.jp", "kobe.jp", "jp"),
    ]
    assert levels(long_suffixes=["kobe.jp", "k.kobe.jp"])[-1] == ("a.k.kobe.jp", "a.k.kobe.jp", "k.kobe.jp")
    assert levels(long_suffixes=[])[1] == ("x.co.uk", "co.uk", "uk")


def test_ports_share_a_reputation_and_its_figures_are_returned(spark):
    urls = [f"http://bad.spam.org:{80 + i % 3}/{i}" for i in range(60)] + [f"http://ok.fine.org/{100 + i}" for i in range(60)]
    urls += ["https://bad.spam.org./x", "http://q.spam.org/x", "http://new.other.org", "http://10.0.0.1/y", "http://:80/x"]
    labels = [(i, 0, 1) for i in range(60)] + [(100 + i, 1, 0) for i in range(60)]
    got = judge_pages(pages(spark, urls), spark.createDataFrame(labels, LABELS)).collect()
    by_id = {r.page_id: r for r in got}
    assert [by_id[i].verdict for i in (0, 1, 2, 120, 121, 122, 123, 124)] == ["block"] * 5 + ["allow"] * 3
    assert [by_id[i].level for i in (0, 120, 121, 122, 123, 124)] == ["host", "host", "domain", "suffix", None, None]
    assert by_id[0].a == by_id[120].a and by_id[0].bound < 0.5 < by_id[60].bound
    assert by_id[123].bound is None and by_id[0].host == "bad.spam.org:80"
