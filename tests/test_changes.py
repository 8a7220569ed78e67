import random
import pytest
from pyspark.sql import functions as F

from lexmill.operators import changes as ch
from lexmill.operators import history, monitor, reconcile
from lexmill.sources import documents as src
from lexmill.sources import feeds, sinks


def doc(version, body, quote="", items="", date="2026-01-01"):
    return f"---\n제목: {quote}법{quote}\n법령ID: '1'\n법령MST: {version}\n공포일자: {date}\n첨부파일:\n{items}\n---\n{body}"


def item(no, branch, title, link="u"):
    return f"- 별표번호: '{no}'\n  별표가지번호: '{branch}'\n  별표구분: 별표\n  제목: {title}\n  파일링크: {link}"


def snapshots(spark, rows):
    make = lambda i: src.normalized(src.with_header(spark.createDataFrame([("law", path, pair[i]) for path, pair in rows.items() if pair[i] is not None], "kind string, path string, raw string")))
    return make(0), make(1)


def test_report(spark):
    body = "##### 제1조 (가)\nx\n##### 제2조\ny\n## 부칙\nz"
    rows = {
        "same-version": (doc(1, body), doc(1, body + " reworked", quote="'")),
        "amended": (doc(1, body, items=item("0001", "00", "old") + "\n" + item("0002", "00", "gone")), doc(2, "##### 제1조 (가)\nX\n##### 제2조의2 (새)\nn\n## 부칙\nzz", items=item("0001", "00", "new", "other") + "\n" + item("0003", "02", "added"))),
        "links-only": (doc(1, body, items=item("0001", "00", "t", "a")), doc(2, body, items=item("0001", "00", "t", "b"))),
        "new": (None, doc(1, body)), "gone": (doc(1, body), None), "no-version": (doc(1, body), doc("''", body)),
    }
    report = ch.amendment_report(*snapshots(spark, rows))
    got = {r.path: r for r in report.collect()}
    assert set(got) == {"amended", "links-only", "new"}
    r = got["amended"]
    assert (r.changed, r.added, r.removed, r.addenda_changed, r.old_version, r.new_version) == (["제1조"], ["제2조의2"], ["제2조"], True, "1", "2")
    assert [(a.no, a.branch, a.change) for a in r.attachments] == [("0001", "00", "retitled"), ("0002", "00", "removed"), ("0003", "02", "added")]
    assert got["links-only"].attachments is None and not got["links-only"].addenda_changed
    text = {r.path: r.markdown for r in sinks.render_markdown(report).collect()}["amended"]
    assert "제1조(가), 제2조의2(새) 신설, 제2조 삭제" in text and '별표1 [별표] 개정 — "old" → "new"' in text and "별표3의2 [별표] added — 신설" in text
    assert sinks.render_subject(report).first()[0].startswith("3건 개정")
    assert sinks.render_subject(report.limit(0)).first()[0] == "개정 없음"
    assert ch.amendment_report(*snapshots(spark, {"a": (doc(1, body), doc(1, body))})).count() == 0


def test_subject_takes_three_titles_without_collecting_all(spark):
    schema = "doc_title string, changed array<string>, added array<string>, removed array<string>, titles map<string, string>, attachments array<struct<kind: string, no: string, branch: string, change: string, old_title: string, new_title: string>>"
    report = spark.createDataFrame([(t, ["1"], [], [], {}, None) for t in ("d x", "b y", None, "c z", "a w", "e v")], schema)
    subject = sinks.render_subject(report)
    assert subject.first()[0] == "6건 개정 — a, b, c"
    assert "TakeOrderedAndProject" in subject._jdf.queryExecution().executedPlan().toString()


def test_diff_of_itself_is_empty_and_swaps(spark):
    a = spark.createDataFrame([(1, "##### 제1조\na\n##### 제10조\nb\n##### 제2조\nc\n##### 제2조\nagain")], "k long, body string")
    b = spark.createDataFrame([(1, "##### 제 2조\nagain\n#### 제3조 (t) tail\nd")], "k long, body string")
    same = ch.diff_articles(a, a, ["k"]).first()
    assert (same.changed, same.added, same.removed, same.addenda_changed, same.n_old) == ([], [], [], False, 3)
    one, two = ch.diff_articles(a, b, ["k"]).first(), ch.diff_articles(b, a, ["k"]).first()
    assert (one.changed, one.added, one.removed) == (["제2조"], ["제3조"], ["제1조", "제10조"])
    assert (two.changed, two.added, two.removed) == (one.changed, one.removed, one.added)


def test_line_diff(spark):
    df = spark.createDataFrame([("a\nb\nc", "a\nB\nc"), (None, "x"), ("x", "x")], "o string, n string")
    assert [r[0] for r in df.select(ch.line_diff("o", "n")).collect()] == [["-b", "+B"], ["+x"], []]


def test_files(spark):
    old = spark.createDataFrame([("a.hwp", "1"), ("b.HWPX", "1"), ("c.pdf", "1"), ("d.hwp", "1")], "path string, sha256 string")
    new = spark.createDataFrame([("a.hwp", "2"), ("c.pdf", "2"), ("d.hwp", "1"), ("e.hwp", "1")], "path string, sha256 string")
    diff = ch.diff_files(old, new)
    assert {tuple(r) for r in diff.collect()} == {("a.hwp", "M"), ("b.HWPX", "D"), ("e.hwp", "A")}
    assert {tuple(r) for r in ch.file_change_profile(diff).collect()} == {("M", "hwp", 1), ("D", "hwpx", 1), ("A", "hwp", 1)}


def test_fragments(spark):
    rows = [(1, "old", 0, "orphan"), (1, "old", 1, "<P>제48조(가)</P>"), (1, "old", 2, "tail"), (1, "old", 3, "<P>제48조의2(나)</P>"), (1, "old", 4, " "), (1, "new", 0, "제 48 조의 2 x")]
    df = spark.createDataFrame(rows, "mst long, side string, seq long, text string")
    grouped = reconcile.group_fragments(df, ["mst", "side"])
    assert {(r.side, r.article, r.seq) for r in grouped.collect()} == {("old", "제48조", 1), ("old", "제48조", 2), ("old", "제48조의2", 3), ("new", "제48조의2", 0)}
    aligned = {r.article: (r.old, r.new) for r in reconcile.align_old_new(grouped, ["mst"]).collect()}
    assert aligned["제48조"] == (["<P>제48조(가)</P>", "tail"], []) and len(aligned["제48조의2"][1]) == 1


def test_reconcile(spark):
    a = spark.createDataFrame([(1, "제1조"), (1, "제2조")], "mst long, article string")
    b = spark.createDataFrame([(1, "제2조"), (1, "제3조")], "mst long, article string")
    assert {(r.article, r.verdict) for r in reconcile.reconcile(a, b, ["mst"]).collect()} == {("제1조", "SELF_ONLY"), ("제2조", "AGREE"), ("제3조", "API_ONLY")}


def test_last_version_change(spark):
    rows = [("p", 1, "r1", "1"), ("p", 2, "r2", "1"), ("p", 3, "r3", "2"), ("p", 4, "r4", "2"), ("q", 1, "r1", "1")]
    df = spark.createDataFrame(rows, "path string, seq long, rev string, version string")
    assert [tuple(r) for r in reconcile.last_version_change(df).collect()] == [("p", "r2", "r3")]
    assert reconcile.last_version_change(df, limit=2).count() == 0


def test_freshness(spark):
    watch = spark.createDataFrame([(n, i, t, ["제4조"]) for n, i, t in [("sync", "1", "core"), ("stale", "2", "core"), ("side", "3", "peripheral"), ("pending", "4", "core"), ("missing", "5", "core"), ("noid", "", "core"), ("nofile", "7", "core"), ("unknown", "1234567", "core")]], "name string, law_id string, tier string, watch array<string>")
    ours = spark.createDataFrame([(n, v, d) for n, v, d in [("sync", "11", "2026-01-01"), ("stale", "20", "2026-01-01"), ("side", "30", "2026-01-01"), ("pending", "41", "2026-12-01"), ("missing", "x", "2026-12-01"), ("noid", "1", ""), ("unknown", "1", "")]], "name string, version_key string, promulgate_date string")
    feed = spark.createDataFrame([("000001", "11", "20260101", "현행", 0), ("000002", "21", "20260201", "시행예정", 0), ("000003", "31", "20260201", "", 0), ("000004", "40", "20260601", "", 0), ("000004", "42", "20260601", "", 1), ("000009", "41", "20260101", "", 0), ("000005", "51", "20260101", "", 0)], "law_id string, mst string, promulgate_date string, status string, seq long")
    got = {r.name: r.verdict for r in monitor.freshness(watch, ours, feed).collect()}
    assert got == {"sync": "SYNC", "stale": "STALE(시행예정)", "side": "REVIEW: 제4조", "pending": "SYNC_PENDING", "missing": "MISSING", "noid": "NO_ID", "nofile": "NO_FILE", "unknown": "LOOKUP_FAILED"}
    assert {r.law_id: r.mst for r in monitor.latest_version(feed).collect()}["000004"] == "40"


def test_history(spark):
    articles = spark.createDataFrame([("본문 <개정 2013.8.16, 2026. 7. 9> <신설 2020.1.2>",)], "text string")
    assert {(r.kind, str(r.date), r.n) for r in history.change_markers(articles).collect()} == {("amended", "2013-08-16", 1), ("amended", "2026-07-09", 1), ("inserted", "2020-01-02", 1)}
    docs = spark.createDataFrame([("s", "부칙 <제1호,2020.1.2>\nx\n부칙 <제2132호,2026.7.9>")], "stem string, body string")
    assert [(r.number, r.current) for r in history.addenda_history(docs).orderBy("pos").collect()] == [("1", False), ("2132", True)]


def test_feeds(spark, tmp_path):
    config = {"family": [{"act": "A", "watch_articles": ["제1조"], "members": [{"name": "a", "type": "법률", "law_id": "1"}, {"name": "b", "type": "시행령"}]}, {"act": "B", "tier": "peripheral", "members": [{"name": "c"}]}], "admrule": [{"name": "r", "kind": "고시"}]}
    members = feeds.watchlist_members(spark, config)
    assert [(r.name, r.family, r.tier, r.watch) for r in members.orderBy("name").collect()] == [("a", "A", "core", ["제1조"]), ("b", "A", "core", ["제1조"]), ("c", "B", "peripheral", [])]
    assert [r.name for r in monitor.fetch_list(members).orderBy("name").collect()] == ["a", "b"] and feeds.watchlist_rules(spark, config).first().kind == "고시"
    (tmp_path / "feed.xml").write_text("<r><law><법령ID>000001</법령ID><법령일련번호> 7 </법령일련번호></law><law><법령ID>000002</법령ID></law></r>", encoding="utf-8")
    assert [(r.law_id, r.mst) for r in feeds.read_version_feed(spark, str(tmp_path / "feed.xml")).orderBy("seq").collect()] == [("000001", "7"), ("000002", "")]
    (tmp_path / "c.json").write_text('{"corrections": {"s": {"reason": "r", "rules": [{"find": "a", "replace": "b", "expect": 1}]}}}', encoding="utf-8")
    row = feeds.read_corrections(spark, str(tmp_path / "c.json")).first()
    assert (row.stem, row.rules[0].find, row.rules[0].expect) == ("s", "a", 1)


def test_xml_records(spark):
    rule = "<AdmRulService><행정규칙기본정보><행정규칙명> 고시 </행정규칙명><행정규칙일련번호>9</행정규칙일련번호></행정규칙기본정보><조문내용>제1조</조문내용><조문내용> </조문내용><조문내용>제2조</조문내용><부칙><부칙내용>시행</부칙내용></부칙></AdmRulService>"
    got = feeds.rules_from_xml(spark.createDataFrame([(rule,)], "xml string")).first()
    assert (got.doc_title, got.version_key, got.body) == ("고시", "9", "제1조\n\n제2조\n\n## 부칙\n\n시행")
    compare = "<r><구조문_기본정보><법령일련번호>1</법령일련번호></구조문_기본정보><신조문_기본정보><법령일련번호>2</법령일련번호></신조문_기본정보><구조문목록><조문>제1조 a</조문><조문>b</조문></구조문목록><신조문목록><조문>제1조 A</조문></신조문목록></r>"
    fragments, infos = feeds.read_old_new(spark.createDataFrame([("2", compare)], "mst string, xml string"))
    assert {(r.side, r.seq, r.text) for r in fragments.collect()} == {("old", 0, "제1조 a"), ("old", 1, "b"), ("new", 0, "제1조 A")}
    assert {(r.side, r.side_mst) for r in infos.collect()} == {("old", "1"), ("new", "2")}
    three = "<r><삼단비교><법률조문><조번호>0121</조번호><조가지번호>02</조가지번호><조제목>t</조제목><시행령조문목록><시행령조문>013200제132조(건강)</시행령조문><시행령조문>없음</시행령조문></시행령조문목록></법률조문></삼단비교></r>"
    links = feeds.read_three_way(spark.createDataFrame([("2", three)], "mst string, xml string"))
    assert [tuple(r) for r in reconcile.three_way_edges(links, ["mst"]).collect()] == [("2", "제121조의2", "시행령", "제132조")]


def test_line_diff_keeps_lines_that_look_like_headings(spark):
    df = spark.createDataFrame([("a\n-- note\nb\n++x", "a\nb"), ("--- x", "+++ y\n@@")], "o string, n string")
    assert [r[0] for r in df.select(ch.line_diff("o", "n")).collect()] == [["--- note", "-++x"], ["---- x", "++++ y", "+@@"]]


def test_snapshots_by_their_whole_tree_path(spark, tmp_path):
    for state, version in (("law 1", "7"), ("law 2", "8")):
        rows = [("law/가 나+다.md", doc(version, "x")), ("law/law/b.md", doc(version, "y"))][: 2 if state == "law 1" else 1]
        assert sinks.write_tree(spark.createDataFrame(rows, "path string, raw string"), f"{tmp_path}/law/{state}") == len(rows)
    old, new = src.read_snapshots(spark, {"law": f"{tmp_path}/law/law 1"}, {"law": f"file:{tmp_path}/law/law 2"})
    key = lambda df: {(r.path, r.version_key) for r in df.collect()}
    assert key(old) == {("law/가 나+다.md", "7"), ("law/law/b.md", "7")} and key(new) == {("law/가 나+다.md", "8")}
    assert sinks.write_tree(spark.createDataFrame([], "path string, raw string"), str(tmp_path / "none")) == 0


def test_rule_articles_keep_their_digits(spark):
    rule = "<r>" + "".join(f"<조문내용> 제{k}조 {k}{k} </조문내용>" for k in range(5)) + "</r>"
    assert feeds.rules_from_xml(spark.createDataFrame([(rule,)], "xml string")).first().body == "\n\n".join(f"제{k}조 {k}{k}" for k in range(5))


def test_codes_pass_through(spark):
    from lexmill.functions import frontmatter as fm

    df = spark.createDataFrame([("보건복지부",), ("다른 곳",), (None,), ("",)], "m string")
    assert [r[0] for r in df.select(fm.map_codes("m", fm.MINISTRIES)).collect()] == ["MOHW", "다른 곳", None, ""]


@pytest.mark.parametrize("parts", [1, 2, 7, 64])
def test_long_records_are_filled_as_one_window_would(spark, parts):
    rng = random.Random(parts)
    rows = [(rng.choice(["hot", "hot", "hot", "a", "b", None]), k, rng.choice([None, None, None, None, f"v{k}"])) for k in range(400)]
    rows += [("empty", k, None) for k in range(50)] + [("first", 999 + k, "x" if k == 0 else None) for k in range(40)]
    df = spark.createDataFrame(rows, "k string, seq long, v string").repartition(5)
    want, last = set(), {}
    for k, seq, v in sorted(rows, key=lambda r: r[1]):
        last[k] = v if v is not None else last.get(k)
        want.add((k, seq, v, last[k]))
    for kind in ("bigint", "double", "string"):
        turned = df.withColumn("seq", F.col("seq").cast(kind) if kind != "string" else F.lpad(F.col("seq").cast("string"), 6, "0"))
        out = reconcile.carry_forward(turned, ["k"], "seq", F.col("v"), "filled", parts)
        assert {(r.k, int(r.seq), r.v, r.filled) for r in out.collect()} == want and out.count() == len(rows)
