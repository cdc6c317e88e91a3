from pyspark.sql import functions as F

from ragloom.llm import queries, url_filter

SF = "/root/testdata/sf0.001"


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    return host, path[:min([i for i in map(path.find, "?#") if i >= 0], default=len(path))]


def plain_rule(host, path):
    fit = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


CASES = [None, "", "no scheme", "http://", "http://net", "http://net/", "HTTP://WWW.A.Net/x", "http://a.example.net/en/1?q",
         "http://example.net/de/", "http://fakeexample.net/en/", "https://example.com/de", "https://example.com/de/x#y",
         "x://y.org/fr/?a=/b", "x://ÄB.org/fr/", "http://h?x/y", "http://h#x", "a://b://net/c", "http://ex.com/" + "a" * 20_000, "http://net\n/x"]


def test_parts_rules_and_edge_rows(spark):
    rows = [(i, u, "h", "v") for i, u in enumerate(CASES)] + [(None, "http://net/", "h", "v"), (0, None, "h", "v")]
    got = url_filter.judge(spark.createDataFrame(rows, "page_id int, url string, host string, _host string")).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.page_id is not None:
            host, path = plain(CASES[r.page_id])
            rule, verdict = plain_rule(host, path)
            assert (r.host, r.path, r.rule) == (host, path, rule)
            assert r.verdict == (verdict or ("block" if r.score >= 0.5 else "allow"))
    assert url_filter.judge(spark.createDataFrame([], "page_id int, url string")).collect() == []


def plain_ngrams(text, tag, sizes):
    marked = f"^{text}$"
    return [tag + marked[i:i + n] for n in sizes for i in range(len(marked) - n + 1)]


def test_ngrams_and_score_equal_a_plain_model(spark):
    """The features are the n-grams of host and path, and the score is the
    logistic of their hashed weights."""
    import math

    from pyspark.ml.feature import HashingTF

    cases = ["http://a.b/c", "http://cheap-tickets.example.org/en/12?x", "https://x", "", "nothing", "http://ÄÖ.example.com/日本/1"]
    host, path = url_filter.url_parts(F.col("url"))
    df = spark.createDataFrame([(i, u) for i, u in enumerate(cases)], "page_id int, url string")
    got = {r.page_id: r.g for r in df.select("page_id", url_filter.url_ngrams(host, path).alias("g")).collect()}
    model = url_filter.fit_urls(url_filter.labelled_urls(spark))
    weights, tf = model.coefficients.toArray(), HashingTF(numFeatures=url_filter.BUCKETS)
    scores = {r.page_id: r.score for r in url_filter.judge(df).collect()}
    for i, u in enumerate(cases):
        h, p = plain(u)
        grams = plain_ngrams(h, "h:", (3, 4, 5)) + plain_ngrams(p, "p:", (3,))
        assert sorted(got[i]) == sorted(grams)
        z = model.intercept + sum(weights[k] for k in {tf.indexOf(g) for g in grams})
        assert abs(scores[i] - 1 / (1 + math.exp(-z))) < 1e-9


# words and pairs that the labelled table does not have
ORDINARY = """acorn alpine amber anchor apple arrow basil beacon bench birch bloom brook cabin candle cedar cello chalk cloud clover compass copper coral
cotton cricket daisy delta drift eagle echo elm ember falcon feather fern fiddle flint fox frost gable glen granite grove harvest hazel heron indigo
iris ivory jasper juniper kite lantern lark linen lotus maple marble meadow mint moss""".split()


def test_unseen_hosts(spark):
    names = len(url_filter.BLOCKED_WORDS)
    spam = url_filter._urls(url_filter.BLOCKED_WORDS, (11, 31))[names:]
    fine = url_filter._urls(ORDINARY, (3,)) + url_filter._urls(url_filter.ALLOWED_WORDS, (13,))[len(url_filter.ALLOWED_WORDS):]
    seen = {plain(u)[0] for u, _ in url_filter.labelled_rows()}
    assert not seen & {plain(u)[0] for u in spam + fine}
    rows = url_filter.judge(spark.createDataFrame([(i, u) for i, u in enumerate(spam + fine)], "page_id int, url string")).collect()
    blocked = {r.page_id for r in rows if r.score >= 0.5}
    assert sum(i in blocked for i in range(len(spam))) >= 0.97 * len(spam)
    assert sum(i in blocked for i in range(len(spam), len(rows))) <= 0.04 * len(fine)


def test_query_hosts_are_not_labelled(spark):
    rows = queries.op1_url_filter(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/pages.parquet").count()
    labelled = {plain(u)[0] for u, _ in url_filter.labelled_rows()}
    for sf in ("sf0.001", "sf0.01", "sf0.1"):
        pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet").select("url").collect()
        assert not labelled & {plain(r.url)[0] for r in pages}


def test_plan_is_native(spark):
    plan = queries.op1_url_filter(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
