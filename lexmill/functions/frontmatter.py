"""Column functions for documents with a front-matter header."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.text import ARTICLE_WITH_PARTS, as_column, strip, text

#: Names and patterns of the default dialect (fixed values).
MANIFEST_KEY = "첨부파일"
ITEM = {"no": "별표번호", "branch": "별표가지번호", "kind": "별표구분", "title": "제목", "file_link": "파일링크", "pdf_link": "PDF링크"}
MINISTRIES = {"원자력안전위원회": "NSSC", "질병관리청": "KDCA", "보건복지부": "MOHW", "식품의약품안전처": "MFDS", "고용노동부": "MoEL", "과학기술정보통신부": "MSIT", "국무총리": "PMO"}
LEVELS = {"법률": "Act", "대통령령": "Decree", "총리령": "Rule", "보건복지부령": "Rule", "부령": "Rule", "고시": "Notification", "예규": "Notification", "훈령": "Notification"}
HEADER = r"(?s)^---\n(.*?)\n---\n?(.*)$"


def header(raw: Column | str) -> Column:
    """What stands between the first two --- lines, or ''."""
    return F.regexp_extract(text(raw), HEADER, 1)


def body(raw: Column | str) -> Column:
    """What follows the header, or the whole text."""
    raw = text(raw)
    return F.when(raw.rlike(HEADER), F.regexp_extract(raw, HEADER, 2)).otherwise(raw)


def fm_value(head: Column | str, key: str) -> Column:
    """A key's scalar without quotes, '' where absent. The value stays on the key's own line."""
    return strip(F.regexp_extract(text(head), rf"(?dm)^{key}:[ \t]*+['\"]?+([^'\"\n].*?)['\"]?[ \t]*$", 1))


def fm_list_first(head: Column | str, key: str) -> Column:
    """The first item of a key's list, or its scalar."""
    first = strip(F.regexp_extract(text(head), rf"(?dm)^{key}:[ \t]*\n\s*-\s*['\"]?([^'\"\n].*?)['\"]?[ \t]*$", 1))
    return F.when(first != "", first).otherwise(fm_value(head, key))


def fm_map(head: Column | str) -> Column:
    """All top-level pairs; the last one of a key wins."""
    lines = F.filter(F.split(text(head), "\n"), lambda line: line.rlike(r"^[^:\s][^:]*:"))
    pairs = F.transform(lines, lambda line: F.struct(strip(F.regexp_extract(line, r"^([^:]+):", 1)).alias("k"), F.regexp_replace(strip(F.regexp_extract(line, r"^[^:]+:(.*)$", 1)), r"^['\"]+|['\"]+$", "").alias("v")))
    numbered = F.transform(pairs, lambda p, i: F.struct(p["k"].alias("k"), p["v"].alias("v"), i.alias("i")))
    last = F.filter(numbered, lambda p: ~F.exists(numbered, lambda q: (q["k"] == p["k"]) & (q["i"] > p["i"])))
    return F.map_from_entries(F.transform(last, lambda p: F.struct(p["k"], p["v"])))


def explode_manifest(docs: DataFrame, head: str = "header", key: str = MANIFEST_KEY, item: dict[str, str] = ITEM) -> DataFrame:
    """A row (pos, no, branch, kind, title, file_link, pdf_link) for each attachment of a document.

    Every other column of docs stays. An item starts at `- <number key>`.
    """
    block = F.regexp_extract(text(head), rf"(?dsm)^{key}:[ \t]*\n(.*)\z", 1)
    pieces = F.filter(F.split(block, rf"(?dm)(?=^\s*-\s*{item['no']})"), lambda p: p.rlike(rf"^\s*-\s*{item['no']}"))
    rows = docs.select("*", F.posexplode(pieces).alias("pos", "_item"))
    field = lambda k: strip(F.regexp_extract("_item", rf"(?dm)(?:^|[\s-]){item[k]}:[ \t]*+['\"]?+([^'\"\n].*?)['\"]?[ \t]*$", 1))
    return rows.select("*", *(field(k).alias(k) for k in item)).drop("_item")


def map_codes(c: Column | str, mapping: dict[str, str]) -> Column:
    """The code of a name; a name without one stays."""
    c = as_column(c)
    return F.coalesce(F.create_map(*(F.lit(x) for pair in mapping.items() for x in pair))[c], c)


def annex_meta(stem: Column | str) -> Column:
    """(title, parent, articles) of an annex's file name; its last round brackets hold the parent."""
    s = F.regexp_replace(text(stem), r"(?U)^\[별표\]\s*", "")
    pattern = r"(?U)^(.*)\(([^()]*)\)\s*$"
    named = s.rlike(pattern)
    title = F.when(named, strip(F.regexp_extract(s, pattern, 1))).otherwise(strip(s))
    return F.struct(
        title.alias("title"),
        F.when(named, strip(F.regexp_extract(s, pattern, 2))).otherwise("").alias("parent"),
        F.array_distinct(F.regexp_extract_all(title, F.lit(ARTICLE_WITH_PARTS), F.lit(0))).alias("articles"),
    )


def annex_number(text_: Column | str) -> Column:
    """별표N or 별표N의M from the first 400 characters, with narrow or wide brackets; else 별표."""
    head = F.substring(text(text_), 1, 400)
    part = lambda g: F.regexp_extract(head, r"(?U)\\?[\[［]\s*별표\s*(\d+)(?:\s*의\s*(\d+))?\s*\\?[\]］]", g).try_cast("int").cast("string")
    return F.concat(F.lit("별표"), F.coalesce(part(1), F.lit("")), F.coalesce(F.concat(F.lit("의"), part(2)), F.lit("")))


def manifest_number(no: Column | str, branch: Column | str) -> Column:
    """'0004', '03' -> 4의3; '' where the number is none."""
    n, b = as_column(no).try_cast("int").cast("string"), F.coalesce(as_column(branch).try_cast("int"), F.lit(0))
    return F.when(n.isNull(), "").when(b != 0, F.concat(n, F.lit("의"), b.cast("string"))).otherwise(n)


def sanitize_name(c: Column | str) -> Column:
    """A safe file name of 120 characters at most; guards.name_collisions finds names that clash."""
    return F.substring(F.regexp_replace(text(c), r'[/\\:*?"<>|]', "_"), 1, 120)


def sniff_type(content: Column | str, name: Column | str, allowed: tuple[str, ...] = ("hwp", "hwpx", "doc", "docx", "pdf")) -> Column:
    """The extension of an allowed name, else the type that the first bytes show, else ''."""
    extension = F.lower(F.regexp_extract(text(name), r"\.([A-Za-z0-9]+)$", 1))
    magic = F.hex(F.substring(as_column(content), 1, 4))
    return F.when(extension.isin(*allowed), extension).when(magic == "25504446", "pdf").when(magic == "504B0304", "hwpx").when(magic == "D0CF11E0", "hwp").otherwise("")
