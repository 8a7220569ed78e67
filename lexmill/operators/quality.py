"""Checks of extracted text against a second text of the same document, and corrections."""

from __future__ import annotations

import io
import re
import zipfile
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.functions import text as t


def apply_corrections(docs: DataFrame, rules: DataFrame, key: str = "stem", body: str = "body") -> DataFrame:
    """docs with body corrected and correction in '', corrected, correction_stale.

    rules (key, rules array<struct<find, replace, expect>>): every literal must occur as often as
    expected, else none is applied.
    """
    joined = docs.join(rules.select(key, F.col("rules").alias("_rules")), key, "left")
    has = F.coalesce(F.size("_rules"), F.lit(0)) > 0
    fits = F.forall("_rules", lambda r: t.count_literal(F.col(body), r["find"]) == r["expect"])
    done = F.aggregate("_rules", F.col(body), lambda s, r: F.replace(s, r["find"], r["replace"]))
    out = joined.withColumn("correction", F.when(~has, "").when(fits, "corrected").otherwise("correction_stale"))
    return out.withColumn(body, F.when(F.col("correction") == "corrected", done).otherwise(F.col(body))).drop("_rules")


def num_set_diff(a: Column | str, b: Column | str) -> Column:
    """Numbers of a that b lacks, sorted."""
    return F.array_sort(F.array_except(t.num_set(a), t.num_set(b)))


def audit_extraction(pairs: DataFrame, body: str = "body", other: str = "pdf_text", correction: str | None = None) -> DataFrame:
    """Adds note ('+'-joined flags) and audited (the text to keep) for an extracted body and, where
    there is one, a second text (null: none)."""
    mine, theirs = t.text_len(body), t.text_len(other)
    only_chars = t.char_bag_diff(other, body)
    only_numbers = F.size(F.array_except(t.num_set(other), t.num_set(body)))
    measured = pairs.withColumns({"_mine": mine, "_theirs": theirs, "_chars": only_chars, "_total": F.length(t.content_chars(body)), "_numbers": only_numbers})
    second = F.col(other).isNotNull()
    flag = (
        F.when(second & (F.col("_theirs") > F.col("_mine") * 1.8) & (F.col("_theirs") - F.col("_mine") > 150), "pdf_fallback")
        .when(second & (F.col("_chars") > 120) & (F.col("_chars") > F.col("_total") * 0.15), "char_diverge")
        .when(second & (F.col("_numbers") >= 5), "num_diverge")
        .when(~second & (F.col("_mine") < 100), "short_no_pdf")
    )
    out = measured.withColumn("_flag", flag).withColumn("audited", F.when(F.col("_flag") == "pdf_fallback", F.col(other)).otherwise(F.col(body)))
    lost = F.when(F.size(t.math_loss("audited")) > 0, "math_loss")
    first = F.nullif(F.col(correction), F.lit("")) if correction else F.lit(None).cast("string")
    return out.withColumn("note", F.concat_ws("+", first, "_flag", lost)).drop("_mine", "_theirs", "_chars", "_total", "_numbers", "_flag")


def extraction_summary(audit: DataFrame, format_: str = "source_format", note: str = "note", body: str = "audited") -> DataFrame:
    """By source format: parsed, failed, counts of each flag, documents without a table, mean bytes."""
    has = lambda flag: F.count_if(F.array_contains(F.split(note, r"\+"), flag)).alias(f"n_{flag}")
    empty = t.text(body) == ""
    return audit.groupBy(F.col(format_).alias("source_format")).agg(
        F.count_if(~empty).alias("n_ok"), F.count_if(empty).alias("n_failed"),
        *(has(f) for f in ("pdf_fallback", "char_diverge", "num_diverge", "short_no_pdf", "math_loss", "corrected", "correction_stale")),
        F.count_if(~F.contains(t.text(body), F.lit("<table")) & ~F.contains(t.text(body), F.lit("|"))).alias("n_without_table"),
        F.avg(F.octet_length(t.text(body))).alias("mean_bytes"),
    )


# --- Open-XML office documents --------------------------------------------------------------------


def _name(e) -> str:
    return e.tag.rpartition("}")[2]


def _words(e) -> str:
    return "".join("".join(x.itertext()) for x in e.iter() if _name(x) == "t").strip()


def _blocks(e) -> list[str]:
    """Paragraph texts and HTML tables below an element, in order."""
    out: list[str] = []
    for child in e:
        if _name(child) == "tbl":
            out.append(_table(child))
        elif _name(child) == "p" and not any(_name(x) == "tbl" for x in child.iter()):
            out += [x] if (x := _words(child)) else []
        else:
            out += _blocks(child)
    return out


def _table(e) -> str:
    def cell(tc) -> str:
        span = next((x for x in tc if _name(x) == "cellSpan"), None)
        wide = {k: int(span.get(k, "1")) for k in ("colSpan", "rowSpan")} if span is not None else {}
        inside = next((x for x in tc if _name(x) == "subList"), [])
        return f"<td{''.join(f' {k.lower()}="{n}"' for k, n in wide.items() if n > 1)}>" + "\n".join(_blocks(inside)) + "</td>"

    rows = ["\n".join(["<tr>", *(cell(c) for c in tr if _name(c) == "tc"), "</tr>"]) for tr in e if _name(tr) == "tr"]
    return "\n".join(["<table>", *rows, "</table>"])


def office_text(data: bytes) -> str:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = sorted(n for n in z.namelist() if re.match(r"Contents/section\d+\.xml", n))
        blocks = [b for n in names for b in _blocks(ElementTree.fromstring(z.read(n)))]
    return re.sub(r"\n{3,}", "\n\n", "\n\n".join(blocks)).strip()


@F.pandas_udf(T.StructType().add("body", T.StringType()).add("error", T.StringType()))
def parse_ooxml_sections(content: pd.Series) -> pd.DataFrame:
    """Paragraphs and HTML tables of a zip of XML sections; a failure gives '' and its reason."""
    rows = []
    for data in content:
        try:
            rows.append((office_text(bytes(data)), None))
        except (zipfile.BadZipFile, ElementTree.ParseError, KeyError, ValueError, TypeError) as e:
            rows.append(("", f"{type(e).__name__}: {e}"[:200]))
    return pd.DataFrame(rows, columns=["body", "error"])
