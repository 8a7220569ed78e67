import pytest
from pyspark.sql import functions as F

from lexmill.functions import frontmatter as fm
from lexmill.functions import markup, text


def one(spark, column, **values):
    names = list(values)
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} {'array<array<string>>' if isinstance(values[n], list) else 'string'}" for n in names))
    return df.select(column).first()[0]


@pytest.mark.parametrize("given,want", [("2.58×10<sup>-5</sup>", "2.58e-5"), ("8 × 10 -1", "8e-1"), ("1E+09", "1e9"), ("1,000", "1000"), ("3.0 X 10^07", "3.0e7"), ("5×1000", "5e0"), ("2×10⁻³", "2e-3"), ("2×10−3", "2e-3"), (None, ""), ("4e-03", "4e-3")])
def test_canon(spark, given, want):
    assert one(spark, text.canon("x"), x=given) == want


def test_values_leave_dates_references_and_hangul_words(spark):
    strict = lambda s: one(spark, text.values("x"), x=s)
    assert strict("2026년 7월 9일 제12조 별표 3 50mSv") == ["50"]
    assert strict("약5 개월") == []
    assert strict("5 개월 1.2e-3") == ["1.2e-3", "5"]
    assert one(spark, text.values("x", strict=False), x="1.2 | 33 | 0.07") == ["1.2", "33", "0.07"]


def test_has_all_with_alternatives(spark):
    keys = [["차폐"], ["감시장치", "감시하는 장치"]]
    assert one(spark, text.has_all("x", "k"), x="차 폐와 감시하는 장치", k=keys)
    assert not one(spark, text.has_all("x", "k"), x="차폐", k=keys)
    assert one(spark, text.has_all("x", "k"), x="한도 1 × 10 9 Bq", k=[["1E+09"]])


def test_subsequence_and_names(spark):
    within = lambda a, b: one(spark, text.is_subsequence("a", "b"), a=a, b=b)
    assert within("의료분야방사선안전관리기술기준", "의료분야의방사선안전관리에관한기술기준")
    assert within("", "x") and not within("ab", "ba") and not within("aa", "a") and within("aa", "aba")
    assert one(spark, text.norm_name("x"), x="의료 법_·ㆍ(시행령)　 ") == "의료법시행령"


def test_strip_and_fill(spark):
    assert one(spark, text.strip("x"), x="　 a b \n") == "a b"
    assert one(spark, text.zero_fill("x", 6), x="0123456789") == "0123456789"
    assert one(spark, text.zero_fill("x", 6), x="42") == "000042"


def test_articles(spark):
    assert one(spark, text.norm_article("x"), x="제 4조의2 제6항") == "제4조의2"
    assert one(spark, text.article_from_parts("x", "y"), x="0121", y="02") == "제121조의2"
    assert one(spark, text.article_from_parts("x", "y"), x="", y=None) == ""
    assert one(spark, text.sorted_articles(F.split("x", ",")), x="제10조,제2조의3,제2조,부칙") == ["부칙", "제2조", "제2조의3", "제10조"]


def test_math_loss(spark):
    lost = lambda s: len(one(spark, text.math_loss("x"), x=s))
    assert lost("2.58×C/kg") == 1 and lost("2.58×10C") == 1 and lost("2.58×10 C") == 0
    assert not lost("(D×10)") and not lost("(D×1,000)") and not lost("2.58×10<sup>-5</sup>") and not lost("3 × 4")


def test_char_bag_and_numbers(spark):
    assert one(spark, text.char_bag_diff("a", "b"), a="<b>aab&amp;</b> 가", b="ab") == 2
    assert one(spark, text.num_set("x"), x="<td width=99>1,234 5 6.5 77</td>") == ["1234", "6.5", "77"]


HEADER = "---\n제목: '예시법'\n법령ID: '000001'\n빈값: ''\n소관부처:\n- 보건복지부\n- 질병관리청\n상태: 시행\n---\nbody\n"


def test_header(spark):
    head = F.lit(HEADER)
    got = spark.range(1).select(fm.header(head).alias("h"), fm.body(head).alias("b")).select("b", fm.fm_value("h", "제목"), fm.fm_value("h", "빈값"), fm.fm_list_first("h", "소관부처"), fm.fm_value("h", "소관부처"), fm.fm_list_first("h", "상태"), fm.fm_map("h")["법령ID"]).first()
    assert tuple(got) == ("body\n", "예시법", "", "보건복지부", "", "시행", "000001")
    assert one(spark, fm.header("x"), x="no header") == "" and one(spark, fm.body("x"), x="no header") == "no header"


def test_map_last_wins(spark):
    assert one(spark, fm.fm_map("x"), x="a: 1\n b: 2\na: '3'") == {"a": "3"}


@pytest.mark.parametrize("given,want", [("[별표 1의2] x", "별표1의2"), ("［별표 03］", "별표3"), ("\\[별표 4\\]", "별표4"), ("none", "별표"), (" " * 400 + "[별표 5]", "별표")])
def test_annex_number(spark, given, want):
    assert one(spark, fm.annex_number("x"), x=given) == want


def test_annex_meta(spark):
    meta = one(spark, fm.annex_meta("x"), x="[별표] 기준(제2조제4호, 제3조 관련)(예시법_시행령)")
    assert (meta.title, meta.parent, meta.articles) == ("기준(제2조제4호, 제3조 관련)", "예시법_시행령", ["제2조제4호", "제3조"])


def test_sniff_and_sanitize(spark):
    assert one(spark, fm.sniff_type(F.col("x").cast("binary"), F.lit("a.HWPX")), x="zz") == "hwpx"
    assert one(spark, fm.sniff_type(F.col("x").cast("binary"), F.lit("a")), x="%PDF-1") == "pdf"
    assert one(spark, fm.sniff_type(F.col("x").cast("binary"), F.lit("a.exe")), x="") == ""
    assert one(spark, fm.sanitize_name("x"), x='a/b:c*"' + "x" * 200) == ("a_b_c__" + "x" * 200)[:120]


def test_markup(spark):
    assert one(spark, markup.html_cell("x"), x="<b>a</b>&nbsp;\n b&eacute;") == "a bé"
    assert one(spark, markup.html_plain("x"), x="<p>a\n\n\n\nb</p>&lt;") == "a\n\nb<"
    assert one(spark, markup.html_table_rows("x"), x="<table><tr><td> a </td><th>b</th></tr><tr><td></td></tr></table>") == ["a | b"]
    assert one(spark, markup.clean_converted("x"), x="<table>\n<tbody><tr class='x'><td>in\n\n\n\nside</td></tr></tbody></table>\n") == "in\n\nside"
    assert one(spark, markup.clean_converted("x"), x="<colgroup><col/></colgroup> a <table></table>") == "a <table></table>"
