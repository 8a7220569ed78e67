from pyspark.sql import functions as F

from lexmill.operators import monitor
from lexmill.sources import feeds


def page(laws):
    return "<LawSearch>" + "".join(f"<law><법령ID>{i}</법령ID><법령일련번호>{m}</법령일련번호><공포일자>{d}</공포일자></law>" for i, m, d in laws) + "</LawSearch>"


def test_order_of_pages_of_any_size(spark, tmp_path):
    filler = [(str(100 + k), f"x{k}", "20200101") for k in range(3000)]
    pages = {"page1": [("1", "first", "20260101"), ("2", "late", "20250101")], "page2": [*filler, ("1", "second", "20260101"), ("2", "early", "20250102")], "page10": [("1", "tenth", "20260101"), ("3", "only", "")] + filler[:10]}
    for name, laws in pages.items():
        (tmp_path / f"{name}.xml").write_text(page(laws), encoding="utf-8")
    feed = feeds.read_version_feed(spark, str(tmp_path))
    got = [r.mst for r in feed.orderBy("seq").collect()]
    assert got == [m for name in ("page1", "page2", "page10") for _, m, _ in pages[name]]
    latest = {r.law_id: r.mst for r in monitor.latest_version(feed).filter("law_id in ('1', '2', '3')").collect()}
    assert latest == {"1": "first", "2": "early", "3": "only"}


def test_natural_order(spark):
    names = ["a/p10.xml", "a/p9.xml", "a/p9b.xml", "a/p09.xml", "b/p1.xml", "a/p" + "9" * 25 + ".xml"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r.n for r in df.orderBy(feeds.natural_order(F.col("n")), "n").collect()]
    assert got[:4] == ["a/p09.xml", "a/p9.xml", "a/p9b.xml", "a/p10.xml"] and got[-1] == "b/p1.xml"
