"""The url filter's statistics come from all labelled rows, its training urls from both labels."""

from wayweave.llm.url_filter import judge_urls

RULES = [("block" if i % 2 else "allow", f"x.s{i}", "/r/") for i in range(24)]


def test_rates_of_all_rows(spark):
    # 24 suffixes tell the label; neither 30 training urls nor 4 common values hold them all
    urls = [(1000 * i + k, f"http://h{k}.x.s{i}/r/{k % 7}") for i in range(24) for k in range(40)]
    urls += [(-i - 1, f"http://h1.y.s{i}/r/1") for i in range(24)]
    table = spark.createDataFrame(urls, "page_id long, url string")
    got = {r.page_id: r for r in judge_urls(table, RULES, train_rows=30, suffixes=4).collect()}
    assert len(got) == len(urls)
    assert [got[-i - 1].rule for i in range(24)] == [None] * 24
    assert [got[-i - 1].verdict for i in range(24)] == ["block" if i % 2 else "allow" for i in range(24)]


def test_repeated_urls_are_one_training_url(spark):
    # copies of one url must not fill the training rows
    urls = [f"http://a.x.s0/r/{k % 40 + 10}" for k in range(800)] + [f"http://a.x.s1/r/{k + 10}" for k in range(4)]
    urls += ["http://a.y.s0/r/11", "http://a.y.s1/r/11"]
    table = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r for r in judge_urls(table, RULES, train_rows=10).collect()}
    assert got[len(urls) - 2].verdict == "allow" and got[len(urls) - 1].verdict == "block"
