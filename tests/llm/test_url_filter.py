from rowtide.llm import url_filter as U

from .helpers import frame, with_clashes


def judge(spark, urls, **kw):
    df = frame(spark, list(enumerate(urls)), "page_id long, url string")
    return {r.page_id: r for r in U.filter_urls(df, **kw).collect()}


def test_hosts_paths_and_rules(spark):
    urls = ["https://Www.Example.COM/en/a?b#c", "http://blog.example.com/en/", "https://x.net/es/1", "https://x.net/de/1",
            "http://notexample.com/en/", "http://example.com", None, "", "no scheme/path", "ftp://h?x://y/z", "http://ÄB.com/x"]
    got = judge(spark, urls)
    assert [(got[i].host, got[i].path, got[i].rule, got[i].verdict) for i in range(len(urls))] == [
        ("www.example.com", "/en/a", "www.example.com/en/", "allow"),
        ("blog.example.com", "/en/", "example.com/en/", "block"),
        ("x.net", "/es/1", "net/es/", "block"), ("x.net", "/de/1", None, "allow"),
        ("notexample.com", "/en/", "com/", "allow"), ("example.com", "", None, "allow"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("h", "", None, "allow"),
        ("Äb.com", "/x", "com/", "allow")]


def test_terms_need_boundaries_and_two_soft_ones(spark):
    urls = ["https://casino.org/", "https://casinos.org/", "https://free.org/free", "https://free-bets.org/", "https://my.org/CHEAP_pills?free",
            "https://sub.org/freebets", "https://a.org/x-porn"]
    got = judge(spark, urls)
    assert [got[i].verdict for i in range(7)] == ["block", "allow", "allow", "block", "block", "allow", "block"]
    assert (got[2].n_soft, got[3].soft_terms, got[0].strict_terms) == (1, "bets free", "casino")


def test_weights_and_own_lists(spark):
    got = judge(spark, ["https://a.org/heavy", "https://a.org/light"], strict=(), soft=("heavy", "light"), soft_weights={"heavy": 2.0}, rules=())
    assert [got[0].verdict, got[1].verdict] == ["block", "allow"]


def test_repeats_clashes_and_empty_table(spark):
    df = frame(spark, [(1, "https://casino.org/"), (1, "https://casino.org/"), (None, "https://a.org/")], "page_id long, url string")
    got = U.filter_urls(with_clashes(df))
    assert sorted((str(r.page_id), r.verdict) for r in got.collect()) == [("1", "block"), ("1", "block"), ("None", "allow")]
    assert U.filter_urls(df.limit(0)).count() == 0
    long = "https://a.org/" + "x" * 300_000 + "/casino"
    assert judge(spark, [long])[0].verdict == "block"
