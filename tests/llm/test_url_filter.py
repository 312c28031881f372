import duckdb
import pytest

from holdfast.llm import url_filter as uf


@pytest.mark.parametrize(
    "url, host, path",
    [
        (None, "", ""),
        ("", "", ""),
        ("example.net/en/1", "", ""),
        ("http://EXAMPLE.net/En/1?x=/y", "example.net", "/En/1"),
        ("http://a.org?x", "a.org", ""),
        ("http://a.org#x/y", "a.org", ""),
        ("x://y://z/w", "y:", "//z/w"),
        ("://", "", ""),
    ],
)
def test_split(url, host, path):
    assert uf.split_url(url) == (host, path)


@pytest.mark.parametrize(
    "url, rule, verdict",
    [
        ("http://a.net/x", "net/", "block"),
        ("http://a.net", None, "allow"),
        ("http://planet/x", None, "allow"),
        ("http://b.example.net/en/x", "example.net/en/", "allow"),
        ("http://example.net/en", "net/", "block"),
        ("http://notexample.com/de/x", None, "allow"),
        ("http://m.example.com/de/casino", "example.com/de/", "block"),
        ("http://x.org/fr/casino", "org/fr/", "allow"),
        ("http://x.org/de/casino", None, "block"),
        ("http://x.org/casinos", None, "allow"),
        ("http://free-bets.org/", None, "block"),
        ("http://free.org/free", None, "allow"),
        ("http://FREE.org/?win=1", None, "block"),
        (None, None, "allow"),
        ("casino", None, "block"),
        ("http://x.org/caf\u00e9sex\u00e9", None, "allow"),
    ],
)
def test_judged(spark, url, rule, verdict):
    host, path = uf.split_url(url)
    found, said = uf.fitting_rule(host, path, uf.RULES)
    strict, soft = uf.hits(url or "", uf.automaton(uf.STRICT_TERMS, uf.SOFT_TERMS))
    assert found == rule
    assert (said or ("block" if strict or len(soft) >= uf.SOFT_LIMIT else "allow")) == verdict


def test_rows_like_sql(spark):
    urls = [None, "", "http://a.net/x", "http://x.org/casino", "HTTP://Free.Example.com/DE/win", "http://x/\u00e9sex", "a\n://b.net/c\nd", "http://a.net/x"]
    rows = [(i // 2, u, "h") for i, u in enumerate(urls)] + [(None, "http://porn.org/", "h")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string")
    names = ["page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_hits"]
    found = sorted((tuple(r[n] for n in names) for r in uf.judge_urls(df).collect()), key=repr)
    db = duckdb.connect()
    db.register("pages", df.toPandas().astype({"page_id": "Int64"}))
    assert found == sorted((r for r in db.execute(f"SELECT {', '.join(names)} FROM ({uf.SQL})").fetchall()), key=repr)
    assert uf.judge_urls(df.limit(0)).count() == 0
